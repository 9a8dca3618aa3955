"""Every registered query against SQL, or against plain Python where SQL cannot express it."""

import math
import zlib
from collections import Counter

import __spark_entry__ as driver
import brute
import compare
import numpy as np
import public_tokenizers
import pytest
import tiktoken
import tokenizers

import corpus_pipeline
from topicflow.llm import bytebpe, oracles, queries

SF_DIR = "/root/testdata/sf0.001"
QUERIES, SQL = queries.registry(), oracles.sql()


@pytest.fixture(scope="module")
def docs(spark):
    return sorted((r.doc_id, r.text or "") for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect())


def rows(spark, name):
    return {r.doc_id: r for r in QUERIES[name](spark, SF_DIR).collect()}


def byte_encoding():
    ranks = bytebpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_the_driver_sees_them():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert {*QUERIES, "pipeline"} <= set(driver.queries())
    assert set(SQL) <= set(QUERIES) and set(SQL) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", SQL)
def test_query_equals_sql(spark, name):
    assert compare.differences(QUERIES[name](spark, SF_DIR), compare.database(SF_DIR), SQL[name]) == []


def test_token_files(spark, docs):
    tokenizer, start = tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), 0
    found = rows(spark, "op2_token_files")
    assert len(found) == len(docs)
    for i, text in docs:
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 1], "<u4")
        assert (found[i].start, found[i].n_tokens, found[i].ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_fingerprints(spark, docs):
    found, last = rows(spark, "op4_syncmers"), docs[::-1]
    prints = {}
    for k, (i, text) in enumerate(last):
        following = last[(k + 1) % len(last)][1]
        half, r = len(text) // 2, found[i]
        edited = text[:len(text) - half] + following[:half]
        assert (r.n_chars, r.edited_sha256) == (len(text), brute.sha(edited))
        assert prints.setdefault(text, r.fingerprint) == r.fingerprint
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if len(brute.SPACED.findall(text)) > 100:
            assert 0.15 < r.near_edited < 0.8


def test_byte_bpe(spark, docs):
    encoding, found = byte_encoding(), rows(spark, "op6_byte_bpe")
    for i, text in docs:
        ids = np.array(encoding.encode_ordinary(text), "<u4")
        assert (found[i].n_tokens, found[i].ids_sha256, found[i].decoded_sha256) == (len(ids), brute.sha(ids.tobytes()), brute.sha(text))


def test_language_model(spark, docs):
    found = rows(spark, "op7_lm_score")
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in docs}
    tokens = {i: [*brute.SPACED.findall(t.translate(brute.LOWER)), "\n"] for i, t in docs}
    count = Counter(w for i, ws in tokens.items() if not held[i] for w in ws)
    n, v = sum(count.values()), len(count)
    for i, ws in tokens.items():
        r = found[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(ws), sum(w in count for w in ws), n)
        assert r.base_score == pytest.approx(sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws), abs=1e-6)
        assert -40 * len(" ".join(ws)) < r.score < 0


def test_quality(spark):
    spark_rows = QUERIES["op8_quality"](spark, "/root/testdata/sf0.01").collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in spark_rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in spark_rows)
    judged = [r for r in spark_rows if r.held_out and r.doc_id in labels]
    assert np.mean([r.predicted == labels[r.doc_id] for r in judged]) > 0.9


def test_pipeline(spark):
    """Every stage judged on its own input by plain Python; the classifier by its query."""
    table = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kept, frame = {}, table
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in frame.collect()}
        made = [r.asDict() for r in stage(spark, frame, SF_DIR).collect()]
        pairs = sorted(before.items())
        if name == "quality_classifier":
            good = {r.doc_id for r in QUERIES["op8_quality"](spark, SF_DIR).collect() if r.predicted}
            assert {r["doc_id"]: r["text"] for r in made} == {i: t for i, t in pairs if i in good}
        elif name == "minhash_near_dedup":
            assert {r["doc_id"] for r in made} == {i for i, c in brute.components(pairs).items() if i == c}
        elif name == "substring_dedup":
            want = {}
            for i, (words, n, gone) in brute.passages(pairs).items():
                if not gone or words:
                    want[i] = " ".join(words) if gone else before[i]
            assert {r["doc_id"]: r["text"] for r in made} == want
            assert all(r["n_chars"] == len(r["text"]) for r in made)
        elif name == "benchmark_decontamination":
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
            assert {r["doc_id"] for r in made} == {i for i, x in brute.contamination(pairs, items).items() if not x[3]}
        else:
            encoding = byte_encoding()
            assert {r["doc_id"]: (r["round_trip"], bytes(r["ids"])) for r in made} == {
                i: (True, np.array(encoding.encode_ordinary(t or ""), "<u4").tobytes()) for i, t in pairs}
            break
        kept[name] = len(made)
        assert set(made[0]) == set(table.columns)
        frame = spark.createDataFrame([tuple(r[c] for c in table.columns) for r in made], table.schema)
    assert [n for n in kept.values()] == sorted(kept.values(), reverse=True)
    assert corpus_pipeline.run(spark, SF_DIR).count() == len(before)
