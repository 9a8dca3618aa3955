"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns."""

import json
import math
import random

import brute
import numpy as np
import public_tokenizers as public
import pyarrow as pa
import pytest
import tiktoken
import zstandard
from pyspark.sql import functions as F

from topicflow.llm import (
    attention, bytebpe, chat, decontaminate, fmindex, graph, lm, lshforest, passages, quality, syncmers, tokenfile, units, warc, words,
)
from topicflow.llm.common import Scratch, slices, texts

SCHEMA = "doc_id long, text string, n_words long, found string, score string, ids string, __index long"
rng = random.Random(4)
VOCABULARY = ["the", "of", "Größe", "été", "x1", "naïve", "日本語", "don't", "a,b", "end."]
LONG = " ".join(rng.choice(VOCABULARY) + str(rng.randrange(50)) for _ in range(60_000))
PASSAGE = " ".join(f"w{i}" for i in range(60))


def frame(spark, pairs):
    """Documents with columns that clash with results."""
    return spark.createDataFrame([(i, t, 7, "x", "y", "z", 1) for i, t in pairs], SCHEMA)


ODD = [(5, None), (4, ""), (3, " \t\n "), (2, "one"), (1, LONG), (6, LONG), (6, LONG), (None, PASSAGE), (9, PASSAGE + " tail a b"),
       (8, "head " + PASSAGE), (7, "a   b  c　"), (10, "[INST] x </s>"), (11, "\x00\x01 nul")]


@pytest.fixture
def folder(spark):
    return Scratch(spark, "test")


@pytest.fixture
def odd(spark):
    return frame(spark, ODD)


@pytest.fixture
def empty(spark):
    return frame(spark, [])


# -- helpers ---------------------------------------------------------------------

def test_words_are_those_of_the_patterns():
    some = [t or "" for _, t in ODD] + ["Ab-C9 É!x", "z" * 300 + " " + "z" * 301, "  "]
    for inside, pattern in ((words.NOT_SPACE, brute.SPACED), (words.ALNUM, brute.ALNUM)):
        own = words.split(texts(pa.array(some)), inside, lower=True)
        raw = own.data.tobytes()
        got = [[raw[own.start[k]:own.end[k]].decode() for k in range(own.first[r], own.first[r + 1])] for r in range(len(some))]
        want = [pattern.findall(t.translate(brute.LOWER)) for t in some]
        assert got == want
        flat = [w for ws in want for w in ws]
        assert len(set(own.hashes().tolist())) == len(set(flat))


def test_gram_hashes_follow_the_words():
    h = words.mix(np.array([1, 2, 3, 1, 2, 3, 4], np.uint64))
    g = words.gram_hashes(h, 3)
    assert g[0] == g[3] and len(set(g.tolist())) == 4
    assert words.range_hashes(h, np.array([0, 3]), np.array([3, 6])).tolist() == [g[0], g[0]]
    assert len(words.gram_hashes(h, 8)) == 0


def test_slices_cover_all_rows():
    column = texts(pa.array(["a" * 10] * 7 + ["b" * 100, "", None]))
    parts = list(slices(column, 25))
    assert [row for row, _ in parts] == sorted(row for row, _ in parts)
    assert sum((part.to_pylist() for _, part in parts), []) == column.to_pylist()
    assert list(slices(column.slice(0, 0))) == []


@pytest.mark.parametrize("at_once", [graph._AT_ONCE, 5])
def test_components(spark, folder, monkeypatch, at_once):
    monkeypatch.setattr(graph, "_AT_ONCE", at_once)
    chain = [(i, i + 1) for i in range(0, 40)] + [(100, 7), (200, 201), (5, 5)]
    got = {r.id: r.component for r in graph.components(spark.createDataFrame(chain, "a long, b long"), folder, "c").collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 100: 0, 201: 200}
    assert graph.components(spark.createDataFrame([], "a long, b long"), folder, "none").count() == 0


# -- chat ------------------------------------------------------------------------

def test_chat_round_trip_and_order(spark):
    rows = [(1, 0, "user", "</s>[INST] ok [/INST]"), (1, 1, "assistant", "[\\INST] [\\\\/INST] <\\/s> \\"), (2, 0, "assistant", None),
            (2, 1, None, "[ROLE]"), (2, 1, "tool[IS]", "t"), (3, None, "user", ""), (None, 0, "user", "a"), (4, 0, "system", "s"),
            (4, 1, "user", "u"), (4, 2, "assistant", LONG), (5, 0, "user", "q"), (5, 1, "assistant", "same"), (5, 1, "assistant", "same")]
    done = chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = {r.conv_id: r for r in done.withColumn("back", chat.read_turns(F.col("formatted"))).withColumn(
        "loss", chat.loss_texts(F.col("segments"))).collect()}
    assert [tuple(t) for t in got[1].back] == [(r, t) for _, _, r, t in rows[:2]] and got[1].loss == [rows[1][3]]
    assert got[1].valid and got[1].formatted.count("[INST]") == 1 and got[1].formatted.endswith("</s>")
    assert [tuple(t) for t in got[2].back] == [("assistant", ""), ("", "[ROLE]"), ("tool[IS]", "t")]
    assert not got[2].valid and got[2].first_bad == 0
    assert not got[3].valid and got[3].first_bad is None and got[None].formatted == "[INST]a[/INST]"
    assert got[4].valid and got[4].loss == [LONG]
    assert got[5].first_bad == 2 and got[5].loss == ["same", "same"]
    assert chat.format_chats(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0
    with pytest.raises(ValueError):
        chat.Template({"user": chat.Turn("INST", "x")}, ("[A]", "[B]", "[C]"), {}, ())
    assert "Python" not in done._jdf.queryExecution().executedPlan().toString()


# -- token files -------------------------------------------------------------------

@pytest.mark.parametrize("bits", [1, 3, 8, 15, 16, 17, 31, 32])
def test_packing(bits):
    ids = np.random.RandomState(bits).randint(0, 1 << min(bits, 31), 1001).astype(np.uint32)
    data = tokenfile.pack(ids, bits)
    assert len(data) == -(-1001 * bits // 8)
    assert (tokenfile.unpack(data, 1001, bits) == ids).all()
    assert tokenfile.pack(ids[:0], bits) == b""


def test_token_files_of_odd_rows(spark, odd, empty, folder):
    path = public.path("word_bpe_49k.json")
    manifest = tokenfile.write(odd, path, folder, file_ids=100)
    kinds = {"ids": ("array<int>", pa.list_(pa.int32()), lambda ids: ids.astype(np.int32))}
    got = tokenfile.read(manifest, kinds).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted((i for i, _ in ODD), key=lambda i: (i is not None, i))
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got])[:-1].tolist()
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(path)
    want = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for i, t in ODD}
    assert {r.doc_id: r.ids for r in got} == want
    one = tokenfile.open_file(max(manifest.collect(), key=lambda r: r.n_ids).path)
    whole = one.tokens(0, one.n_ids)
    assert (one.tokens(70_000, 70_010) == whole[70_000:70_010]).all() and (one.document(0) == whole[:one.first[1]]).all()
    assert tokenfile.read(tokenfile.write(empty, path, Scratch(spark, "none")), kinds).count() == 0


# -- decontamination -----------------------------------------------------------------

def plan_of(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


def test_decontamination_of_odd_rows(spark, odd, empty, monkeypatch):
    items = [(1, PASSAGE), (2, "one"), (2, "one"), (None, "nul"), (3, None), (4, "!!"), (5, "x1 " * 40)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute.contamination(ODD, items)
    for block in (10 ** 9, 100):  # one broadcast block, and several
        found = decontaminate.find(odd, bench, block_chars=block)
        assert set(found.columns) == set(odd.columns)
        hit = F.col("found")
        got = found.select("doc_id", hit["n_words"].alias("w"), decontaminate.n_hit(hit).alias("h"), hit["items"].alias("i"),
                           decontaminate.contaminated(hit).alias("c")).collect()
        assert len(got) == len(ODD)
        assert {r.doc_id: (r.w, r.h, r.i, r.c) for r in got} == want
    written = []
    monkeypatch.setattr(Scratch, "save", lambda self, name, rows, save=Scratch.save: written.append(plan_of(rows)) or save(self, name, rows))
    last = decontaminate.find(odd, bench, block_chars=-(-sum(len(t or "") for _, t in items) // 5))
    assert len(written) == 4 and all(plan.count("MapInArrow") == 1 for plan in (*written, plan_of(last)))
    kept = decontaminate.drop_documents(odd, bench)
    assert kept.columns == odd.columns and {r.doc_id for r in kept.collect()} == {i for i, x in want.items() if not x[3]}
    cut = {r.doc_id: r.text for r in decontaminate.cut_spans(odd, bench).collect()}
    assert cut[9] == " tail a b" and cut[8] == "head " and cut[5] is None and cut[1] == LONG
    assert decontaminate.find(empty, bench).count() == 0
    assert decontaminate.find(odd, bench.limit(0)).where(F.size("found.items") > 0).count() == 0


# -- fingerprints ------------------------------------------------------------------------

def test_fingerprints_of_odd_rows(spark, odd, empty):
    done = syncmers.with_edits(odd).collect()
    assert len(done) == len(ODD)
    order = sorted([(i, t or "") for i, t in ODD if i is not None], reverse=True) + [(None, PASSAGE)]
    # The two rows of id 6 are equal, so their order does not matter.
    pairs = sorted((str(i), t, order[(k + 1) % len(order)][1]) for k, (i, t) in enumerate(order))
    assert sorted((str(r.doc_id), r.text, r.next) for r in done) == pairs
    for r in done:
        half = len(r.text) // 2
        assert r.edited == r.text[:len(r.text) - half] + r.next[:half]
        assert (r.anchors == []) == (r.text == "")
        if len(r.text) < 10_000:
            assert r.anchors == brute.closed_syncmers(r.text) and r.edited_anchors == brute.closed_syncmers(r.edited)
    assert syncmers.with_edits(empty).count() == 0
    alone = syncmers.with_edits(frame(spark, [(1, "a b c d e f g h i j")])).first()
    assert alone.next == alone.text
    plan = syncmers.with_edits(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_anchors_equal_plain_syncmers(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    own, edited, following = F.col("anchors"), F.col("edited_anchors"), F.col("next_anchors")
    done = syncmers.with_edits(table).withColumns({"near_edited": syncmers.likeness(own, edited), "near_next": syncmers.likeness(own, following)}).collect()
    assert len(done) == table.count()
    for r in done:
        a, b, c = (brute.closed_syncmers(t) for t in (r.text, r.edited, r.next))
        assert (r.anchors, r.edited_anchors, r.next_anchors) == (a, b, c)
        assert r.near_edited == pytest.approx(brute.jaccard(a, b)) and r.near_next == pytest.approx(brute.jaccard(a, c))


def test_buckets_keep_the_order(spark, monkeypatch):
    monkeypatch.setattr(syncmers, "BUCKET_ROWS", 3)
    pairs = [(int(k ** 2.5), f"text {k}") for k in range(200)]
    done = {r.doc_id: r.next for r in syncmers.with_edits(frame(spark, pairs)).collect()}
    assert done == {i: pairs[k - 1][1] for k, (i, _) in enumerate(pairs)}


def test_anchors_are_context_free(spark):
    rows = spark.createDataFrame([(1, PASSAGE), (2, "other words before it " + PASSAGE + " and after")], "doc_id long, text string")
    found = syncmers.anchors(rows, "text", "anchors")
    a, b = (r.anchors for r in found.orderBy("doc_id").collect())
    assert set(a) <= set(b) and 5 < len(a) < 55
    shifts = syncmers.positional_matches(found.where("doc_id = 1"), found.where("doc_id = 2")).select("shift").distinct().collect()
    assert len(shifts) == 1


def test_short_texts_have_an_anchor(spark):
    pairs = [(i, " ".join(f"t{i}_{k}" for k in range(6 + i % 3))) for i in range(60)]
    done = syncmers.with_edits(frame(spark, pairs)).withColumn("near", syncmers.likeness(F.col("anchors"), F.col("next_anchors"))).collect()
    assert len(done) == 60 and all(r.anchors and r.near == 0 for r in done)


# -- passages -------------------------------------------------------------------------------

def test_fm_index_against_plain_search():
    r = np.random.RandomState(1)
    for _ in range(30):
        threshold, k = r.randint(1, 7), r.randint(1, 5)
        sequences = [r.randint(10, 10 + k, r.randint(1, 15)).astype(np.uint64) for _ in range(r.randint(1, 8))]
        owner = r.randint(0, 100, len(sequences))
        index = fmindex.FMIndex(np.concatenate(sequences), np.array([len(s) for s in sequences]), owner, threshold)
        asked = [r.randint(10, 11 + k, r.randint(1, 12)).astype(np.uint64) for _ in range(5)] + sequences
        length, low = index.matching(np.concatenate(asked), np.array([len(q) for q in asked]))
        at = 0
        for q in asked:
            for i in range(len(q)):
                best, least = 0, np.iinfo(np.int64).max
                for n in range(1, min(threshold, len(q) - i) + 1):
                    found = [o for s, o in zip(sequences, owner) for j in range(len(s) - n + 1) if (s[j:j + n] == q[i:i + n]).all()]
                    assert index.count(q[i:i + n]) == len(found)
                    best = n if found else best
                    least = min(found) if found and n == threshold else least
                assert (length[at], low[at]) == (best, least)
                at += 1


def test_the_index_is_small():
    # 200,000 words of 30,000 kinds: 15 levels of a bit and a quarter, a byte for the common prefix, and two numbers for a group of suffixes.
    r = np.random.RandomState(5)
    sequences = r.zipf(1.3, 200_000).astype(np.uint64) % np.uint64(30_000)
    index = fmindex.FMIndex(sequences, np.full(400, 500), np.arange(400), passages.WINDOW)
    groups = index.breaks.nbytes + index.group_low.nbytes
    assert index.common.dtype == np.int8 and index.nbytes - groups - index.alphabet.nbytes - index.base.nbytes < 4 * len(sequences)
    bits = r.randint(0, 2, 100_000)
    level = fmindex.Bits(bits)
    at = r.randint(0, len(bits) + 1, 5000)
    assert (level.rank(at) == np.concatenate([[0], np.cumsum(bits)])[at]).all()


def test_passages_of_odd_rows(spark, odd, empty, folder):
    unique = dict((i, t) for i, t in ODD if i is not None)
    want = brute.passages(unique.items())
    for shard in (1 << 19, 200):  # one shard, and minimisers dealt to several
        done = passages.remove_repeats(odd, folder if shard > 200 else Scratch(spark, "small"), shard_words=shard).collect()
        assert len(done) == len(ODD)
        for r in done:
            kept, n, gone = want[r.doc_id] if r.doc_id is not None else (PASSAGE.split(), 60, 0)
            assert (r.kept_text, r.n_words, r.n_removed) == (" ".join(kept), n, gone)
    # Rows of one id that are two texts, and one word over and over.
    pairs = [(1, PASSAGE), (2, "p q " + PASSAGE), (2, "r " + PASSAGE + " s"), (3, "la " * 2000), (4, "la " * 500)]
    got = sorted((r.doc_id, r.n_words, r.n_removed) for r in passages.remove_repeats(frame(spark, pairs), Scratch(spark, "v")).collect())
    assert got == [(1, 60, 0), (2, 62, 60), (2, 62, 60), (3, 2000, 0), (4, 500, 500)]
    assert passages.remove_repeats(empty, Scratch(spark, "none")).count() == 0
    cut = passages.cut_passages(frame(spark, pairs), Scratch(spark, "cut"))
    assert cut.columns == [c for c in odd.columns if c != "n_words"] and {r.doc_id for r in cut.collect()} == {1, 2, 3}


# -- byte-level BPE ---------------------------------------------------------------------------

def test_byte_bpe_of_odd_rows(spark, odd, empty):
    path = public.path("byte_bpe_50k.tiktoken")
    encoding = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=bytebpe.read_ranks(path), special_tokens={})
    tokens = bytebpe.encode(odd, path, public.PATTERN, offsets=True)
    assert set(tokens.columns) == {*odd.columns, "starts"}
    for r in bytebpe.decode(tokens, path, public.PATTERN).collect():
        text = r.text or ""
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert ids == encoding.encode_ordinary(text) and bytes(r.decoded) == text.encode()
        if len(text) < 1000:
            assert np.frombuffer(r.starts, "<i4").tolist() == encoding.decode_with_offsets(ids)[1]
    assert bytebpe.encode(empty, path, public.PATTERN).count() == 0
    assert bytes(bytebpe.decode(frame(spark, [(1, "a")]).withColumn("ids", F.lit(None).cast("binary")), path, public.PATTERN).first().decoded) == b""


def test_byte_bpe_equals_the_rank_library():
    source = bytebpe.tokenizer_json(bytebpe.read_ranks(public.path("byte_bpe_50k.tiktoken")), public.PATTERN)
    encoding = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=bytebpe.read_ranks(public.path("byte_bpe_50k.tiktoken")), special_tokens={})
    r = random.Random(2)
    every = [chr(c) for c in range(0x3000) if not 0xD800 <= c < 0xE000]
    spaces = [chr(c) for c in (9, 10, 13, 32, 0x1C, 0x85, 0xA0, 0x1680, 0x2003, 0x200B, 0x2028, 0x202F, 0x205F, 0x3000)] + list("ab1'!é")
    some = ["".join(r.choice(every) for _ in range(25)) for _ in range(1000)] + ["".join(r.choice(spaces) for _ in range(15)) for _ in range(2000)]
    encoder, table = units.PieceEncoder(units.Tokenizer.from_str(source), units.spaced_words), bytebpe.ByteTable(source)
    ids, counts = encoder.encode(texts(pa.array(some)))
    for text, own in zip(some, np.split(ids, np.cumsum(counts)[:-1])):
        assert own.tolist() == encoding.encode_ordinary(text)
        assert table.decode(own).tobytes() == text.encode()


# -- language model ------------------------------------------------------------------------------

def test_gradient_of_the_attention_model():
    r = np.random.RandomState(0)
    weights = {n: w.astype(np.float64) for n, w in attention.initial(5).items()}
    weights["out"] = r.randn(attention.WIDTH, 5) * 0.1
    embedding, skip = r.randn(7, attention.WIDTH), r.randn(7, 5)
    x, y = r.randint(0, 7, (4, attention.CONTEXT)), r.randint(-1, 5, (4, attention.CONTEXT))

    def loss(w):
        p = attention._softmax(attention.forward(w, embedding, skip, x)[0])
        rows, places = np.nonzero(y >= 0)
        return -np.log(p[rows, places, y[rows, places]]).mean()

    start = loss(weights)
    for _ in range(5):
        weights = attention.train(weights, embedding, skip, x, y)
    assert loss(weights) < start
    p = attention._softmax(attention.forward(weights, embedding, skip, x)[0])
    changed = x.copy()
    changed[:, 30:] = 0
    q = attention._softmax(attention.forward(weights, embedding, skip, changed)[0])
    assert np.allclose(p[:, :30], q[:, :30]) and np.allclose(p.sum(-1), 1)


def test_gradient_equals_differences_of_the_loss():
    r = np.random.RandomState(4)
    weights = {n: w.astype(np.float64) for n, w in attention.initial(5).items()}
    weights["out"], weights["near"] = r.randn(attention.WIDTH, 5) * 0.3, r.randn(attention.CONTEXT) * 0.2
    embedding, skip = r.randn(7, attention.WIDTH), r.randn(7, 5)
    x, y = r.randint(0, 7, (3, attention.CONTEXT)), r.randint(-1, 5, (3, attention.CONTEXT))
    y[:, :attention.OVERLAP] = -1

    def loss(w):
        p = attention._softmax(attention.forward(w, embedding, skip, x)[0])
        rows, places = np.nonzero(y >= 0)
        return -np.log(p[rows, places, y[rows, places]]).sum()

    whole = attention._gradient(weights, embedding, skip, x, y, 0)
    for name, d in attention._gradient(weights, embedding, skip, x, y, attention.OVERLAP).items():
        assert np.allclose(d, whole[name], atol=1e-8)
        for at in [tuple(r.randint(0, n) for n in d.shape) for _ in range(4)]:
            up, down = ({**weights, name: weights[name].copy()} for _ in range(2))
            up[name][at] += 1e-5
            down[name][at] -= 1e-5
            assert d[at] == pytest.approx((loss(up) - loss(down)) / 2e-5, rel=1e-4, abs=1e-5)


def test_windows_score_every_place_once():
    lengths = np.array([0, 1, 64, 65, 112, 113, 500])
    begin, scored = attention.windows(lengths)
    ends, times = np.cumsum(lengths), np.zeros(lengths.sum(), int)
    for b, s in zip(begin, scored):
        row = np.searchsorted(ends, b, side="right")
        places = np.arange(b + s, min(b + attention.CONTEXT, ends[row]))
        times[places] += 1
    assert (times == 1).all()


def test_scores_of_odd_rows(spark, odd, empty, folder):
    path = public.path("byte_bpe_50k.tiktoken")
    model, counts, totals = lm.fit(odd, path, public.PATTERN, folder)
    got = lm.score(odd, model, counts, totals, folder).collect()
    assert len(got) == len(ODD) and all(np.isfinite(r.score) and r.score < 0 and np.isfinite(r.base_score) for r in got)
    six = [r for r in got if r.doc_id == 6]
    assert len(six) == 2 and six[0] == six[1]
    assert {r.n_tokens for r in got if r.doc_id in (3, 4, 5)} == {1}
    assert [r.held_out for r in got if r.doc_id is None] == [None]
    model, counts, totals = lm.fit(empty, path, public.PATTERN, Scratch(spark, "none"))
    assert lm.score(empty, model, counts, totals, Scratch(spark, "none")).count() == 0
    lone = lm.score(odd, model, counts, totals, Scratch(spark, "none")).collect()
    assert all(r.base_score == pytest.approx(0) and r.n_known == 0 and r.train_tokens == 0 for r in lone)


def test_the_model_has_64_classes():
    m = np.random.RandomState(3).poisson(0.05, (lm.HEAD_IDS + lm.TAIL,) * 2).astype(float)
    model = lm._counted(m, m.sum(axis=0), np.arange(len(m)), np.arange(len(m)) % 2 == 0, 0)
    assert model.skip.shape == (len(m), 64) and model.weights["out"].shape[1] == 64


def test_chances_do_not_depend_on_the_rows_around():
    r = np.random.RandomState(3)
    size = lm.HEAD_IDS + lm.TAIL
    m = r.poisson(0.05, (size, size)).astype(float)
    model = lm._counted(m, m.sum(axis=0), np.arange(size), np.arange(size) % 2 == 0, 0)
    model.weights["out"] = r.randn(*model.weights["out"].shape).astype(np.float32)
    rows = [r.randint(0, size, n) for n in (77, 500, 2, 65, 300)]
    chance, opens = model.log_probabilities(np.concatenate(rows), np.cumsum([0, *map(len, rows)]))
    assert np.isfinite(chance).all() and np.isfinite(opens).all()
    at = 0
    for row in rows:
        alone, _ = model.log_probabilities(row, np.array([0, len(row)]))
        assert np.allclose(chance[at:at + len(row) - 1], alone[:-1], atol=1e-4) and (alone[:-1] < 0).all()
        at += len(row)


def test_tables_give_the_forward_step():
    r = np.random.RandomState(1)
    weights = attention.initial(6)
    weights["out"], weights["near"] = r.randn(attention.WIDTH, 6).astype(np.float32), r.randn(attention.CONTEXT).astype(np.float32)
    embedding, skip = r.randn(30, attention.WIDTH).astype(np.float32), r.randn(30, 6).astype(np.float32)
    x = r.randint(0, 30, (5, attention.CONTEXT))
    assert np.allclose(attention.Tables(weights, embedding, skip).logits(x), attention.forward(weights, embedding, skip, x)[0], atol=1e-3)
    late = attention.Tables(weights, embedding, skip).logits(x, attention.OVERLAP)
    assert np.allclose(late, attention.forward(weights, embedding, skip, x)[0][:, attention.OVERLAP:], atol=1e-3)


def plain_scores(text, model, counts, totals):
    """One text, token by token, in plain Python: each id's class by attention over its window, mixed with the unigram."""
    encoder = units.encoder(totals["source"].value, units.spaced_words)
    ids, (own, many, _), _ = lm._sequences(texts(pa.array([text])), encoder, totals["end_id"])
    w = {n: x.astype(float) for n, x in model.weights.items()}
    x, e = model.symbol[ids], model.embedding.astype(float)
    step, n = attention.CONTEXT - attention.OVERLAP, len(ids) - 1
    last = max(0, -(-max(0, n - attention.CONTEXT) // step))
    following, opening = [], []
    for t in range(n):
        begin = step * min(last, max(0, (t - attention.OVERLAP) // step)) if t >= attention.CONTEXT else 0
        pulls = [math.exp((e[x[t]] @ w["q"]) @ (e[x[s]] @ w["k"]) / 4 + w["near"][t - s]) for s in range(begin, t + 1)]
        mixed = sum(p * (e[x[s]] @ w["v"]) for p, s in zip(pulls, range(begin, t + 1))) / sum(pulls)
        logits = mixed @ w["out"] + model.skip[x[t]]
        p = np.exp(logits - logits.max())
        p /= p.sum()
        following.append(math.log(p[model.of_class[x[t + 1]]]) + model.inner[x[t], x[t + 1]] + model.rest[ids[t + 1]])
        opening.append(math.log(p[:lm.CLASSES // 2].sum()))
    score, t = 0.0, 0
    for h, m in zip(own.hashes().view(np.int64).tolist(), many.tolist()):
        by_ids = sum(following[t:t + m]) - opening[t] + opening[t + m]
        score += math.log(model.weight * counts.get(h, 0) / model.mass + (1 - model.weight) * math.exp(by_ids))
        t += m
    by_end = following[t] - opening[t]
    return (score + math.log(model.weight * totals["ends"] / model.mass + (1 - model.weight) * math.exp(by_end))) / math.log(10)


def test_scores_equal_a_plain_model_and_do_not_depend_on_partitions(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    got = []
    monkeypatch.setattr(lm, "GROUP_WORDS", 20_000)  # several groups
    for parts in (1, 4):
        folder = Scratch(spark, f"parts-{parts}")
        rows = lm.fit_score(docs.repartition(parts), public.path("byte_bpe_50k.tiktoken"), public.PATTERN, folder).collect()
        got.append({r.doc_id: r.score for r in rows})
    assert got[0].keys() == got[1].keys()
    assert all(got[0][i] == pytest.approx(got[1][i], abs=1e-3, rel=1e-6) for i in got[0])
    folder = Scratch(spark, "plain")
    model, counts, totals = lm.fit(docs, public.path("byte_bpe_50k.tiktoken"), public.PATTERN, folder)
    n = {r.word: r.n for r in counts.collect()}
    short = [(r.doc_id, r.text or "") for r in docs.collect() if len(r.text or "") < 1500][:12]
    assert len(short) == 12
    for i, text in short:
        assert got[0][i] == pytest.approx(plain_scores(text, model, n, totals), rel=1e-3, abs=0.01)


def test_the_model_beats_its_base_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = lm.fit_score(docs, public.path("byte_bpe_50k.tiktoken"), public.PATTERN, Scratch(spark, "gain")).where("held_out").collect()
    tokens = sum(r.n_tokens for r in rows)
    assert sum(r.score for r in rows) / tokens > sum(r.base_score for r in rows) / tokens + 0.03


def test_every_training_document_trains(spark, monkeypatch):
    docs, seen = frame(spark, [(i, f"text {i} of some") for i in range(60)]), {"_averaged": [], "_forward": []}
    for name, ids in seen.items():
        monkeypatch.setattr(lm, name, lambda part, *a, f=getattr(lm, name), ids=ids: ids.extend(r.doc_id for r in part.collect()) or f(part, *a))
    lm.fit(docs, public.path("byte_bpe_50k.tiktoken"), public.PATTERN, Scratch(spark, "all"))
    training = sorted(r.doc_id for r in docs.where(~lm.held_out("doc_id")).collect())
    assert sorted(seen["_averaged"]) == sorted(seen["_forward"]) == training


def test_scores_do_not_depend_on_the_words_that_workers_hold(spark, odd, monkeypatch):
    got = []
    for most in (lm.HEAD_WORDS, 7):
        monkeypatch.setattr(lm, "HEAD_WORDS", most)
        folder = Scratch(spark, f"head-{most}")
        model, counts, totals = lm.fit(odd, public.path("byte_bpe_50k.tiktoken"), public.PATTERN, folder)
        rows = lm.score(odd, model, counts, totals, folder).collect()
        got.append((model.weight, sorted((str(r.doc_id), r.n_known, r.base_score, r.score) for r in rows)))
    assert got[0][0] == got[1][0]
    for x, y in zip(got[0][1], got[1][1]):
        assert x[:2] == y[:2] and x[2:] == pytest.approx(y[2:])


def test_texts_are_encoded_once(spark, monkeypatch):
    docs, seen = frame(spark, [(i, f"text {i} of some") for i in range(60)]), {"_encoded": [], "_averaged": [], "_forward": []}
    for name, read in seen.items():
        monkeypatch.setattr(lm, name, lambda part, *a, f=getattr(lm, name), read=read: read.append(part.columns) or f(part, *a))
    lm.fit_score(docs, public.path("byte_bpe_50k.tiktoken"), public.PATTERN, Scratch(spark, "once")).collect()
    assert len(seen["_encoded"]) == 1 and len(seen["_averaged"]) == lm.ROUNDS and len(seen["_forward"]) == 1
    assert all("ids" in columns and "text" not in columns for columns in seen["_averaged"] + seen["_forward"])


def test_ids_spell_the_words_they_are_of():
    some = ["", "Two words", " \t\n", "\u00a0odd\u2003 spaces\u3000", "x", "\x00\x1f \x7f", "\u00c9T\u00c9 \U0001f600\U0001f600 " + "long" * 90, "end "] * 2
    ranks = bytebpe.tokenizer_json(bytebpe.read_ranks(public.path("byte_bpe_50k.tiktoken")), public.PATTERN)
    size = lm.HEAD_IDS + lm.TAIL
    spelling = bytebpe.ByteTable(ranks)
    end_id = len(spelling.length)
    opens = np.append(spelling.bytes[spelling.begin] == 0x20, True)
    symbol = np.where(opens, np.arange(end_id + 1) % (size // 2) * 2, np.arange(end_id + 1) % (size // 2) * 2 + 1)
    model = lm._counted(np.ones((size, size)), np.ones(end_id + 1), symbol, opens, end_id)
    model.spelling = spelling
    own = words.split(texts(pa.array(some)), words.NOT_SPACE, lower=True)
    ids, _, first = lm._sequences(texts(pa.array(some)), units.encoder(ranks, units.spaced_words), end_id)
    model.head = np.sort(own.hashes()[:1])
    model.unigram = np.array([-3.0])
    rows, hashes, by_ids, by_word, by_ids_end = model.tokens(ids, first)
    assert rows.tolist() == own.rows().tolist() and hashes.tolist() == own.hashes().tolist()
    assert (by_word == np.where(hashes == model.head[0], -3.0, -np.inf)).all()
    assert len(by_ids_end) == len(some) and np.isfinite(by_ids).all() and np.isfinite(by_ids_end).all()
    for kind in ("<u2", "<u4"):
        stored = pa.array([one.astype(kind).tobytes() for one in np.split(ids, first[1:-1])], pa.large_binary())
        back, begin = lm._stored(stored.slice(2, 9), end_id if kind == "<u2" else 1 << 17)
        assert back.tolist() == ids[first[2]:first[11]].tolist() and begin.tolist() == (first[2:12] - first[2]).tolist()


def test_places_among_sorted_hashes():
    r = np.random.RandomState(2)
    for n in (0, 1, 2, 5000):
        keys = np.unique(np.append(r.randint(0, 1 << 63, n).astype(np.uint64) * np.uint64(2), np.array([0, 2 ** 64 - 1], np.uint64)[:n]))
        asked = np.concatenate([keys, r.randint(0, 1 << 63, 300).astype(np.uint64), np.array([0, 1, 2 ** 64 - 1], np.uint64)])
        place = np.searchsorted(keys, asked)
        known = np.append(keys, np.uint64(7))[place] == asked if n else np.zeros(len(asked), bool)
        known &= place < len(keys)
        assert words.Sorted(keys).find(asked).tolist() == np.where(known, place, len(keys)).tolist()


def test_sums_for_each_weight_of_the_unigram():
    r = np.random.RandomState(5)
    rows = np.repeat([0, 2, 3], [1, 1000, 130])
    by_ids, by_word = -r.gamma(3, 9, len(rows)), -r.gamma(3, 9, len(rows))
    by_word[r.rand(len(rows)) < 0.2] = -np.inf
    by_ids[5:200] = -400.0
    got = lm._on_grid(by_ids, by_word, rows, 5)
    for k, w in enumerate(lm._GRID):
        plain = np.logaddexp(np.log(w) + by_word, np.log(1 - w) + by_ids)
        assert got[:, k] == pytest.approx(np.bincount(rows, plain, 5))


# -- quality ----------------------------------------------------------------------------------------

def plain_quality(text, model):
    """The score of one text: two compressed sizes, block by block, and a logistic curve, in plain Python."""
    raw = (text or "").encode()
    if not raw or model.weights is None:
        return model.share
    size = []
    for dictionary in (model.good, model.bad):
        own = zstandard.ZstdCompressionDict(dictionary) if len(dictionary) >= 8 else None
        packer = zstandard.ZstdCompressor(level=quality.LEVEL, dict_data=own, write_content_size=False, write_checksum=False, write_dict_id=False)
        size.append(sum(len(packer.compress(raw[i:i + quality.BLOCK])) for i in range(0, len(raw), quality.BLOCK)))
    g, b = size
    d, e, n = (b - g) / (b + g + 100), math.log((b + g + 20) / (2 * len(raw) + 20)), math.log(len(raw) + 1)
    x = [d, e, d * d, e * e, d * e, n, n * d, n * e]
    z = model.weights[0] + sum(w * (v - m) / s for w, v, m, s in zip(model.weights[1:], x, model.mean, model.scale))
    return 1 / (1 + math.exp(-max(-30, min(30, z))))


def test_scores_equal_plain_sizes(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    model = quality.fit(docs, spark.read.parquet("/root/testdata/sf0.01/labels.parquet"))
    rows = quality.score(docs.limit(300), model).collect()
    assert model.weights is not None and {r.predicted for r in rows} == {0, 1}
    for r in rows:
        assert r.score == pytest.approx(plain_quality(r.text, model), abs=1e-9)


def test_quality_of_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(i, k % 2) for k, i in enumerate([1, 2, 3, 5, 7, 8, 9, 10, 11])] + [(None, 1), (6, None), (1, 1)],
                                   "doc_id long, quality int")
    model = quality.fit(odd, labels)
    got = quality.score(odd, model)
    assert set(got.columns) == {*odd.columns, "predicted"}
    rows = got.collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    assert {r.score for r in rows if r.doc_id in (4, 5)} == {model.share}
    for r in rows:
        assert r.score == pytest.approx(plain_quality(r.text, model)) and r.predicted == int(r.score >= 0.7)
    assert len({r.score for r in rows if r.doc_id == 6}) == 1
    for none in (quality.fit(odd, labels.limit(0)), quality.fit(empty, labels), quality.fit(odd, labels.where("quality = 1"))):
        assert {r.score for r in quality.score(odd, none).collect()} == {none.share}
    assert quality.score(empty, model).count() == 0
    assert quality.keep_good(odd, labels).columns == odd.columns


# -- WARC ------------------------------------------------------------------------------------------------

def test_archives_of_odd_pages(spark, folder):
    big = "<p>" + "é" * 600 + "</p>"
    pages = [(1, "http://a/?q=ä b\r\nX: y", big), (2, None, big), (2, None, big), (3, "u", None), (4, "u", ""), (5, "u", "x" * 999),
             (6, "u", "x" * 999), (None, "u", big), (7, "u", LONG)]
    table = spark.createDataFrame([(*p, "extra") for p in pages], "page_id long, url string, html string, file string")
    index = warc.write(table, folder)
    assert index.count() == len(pages)
    got = warc.read(index, payload=True).collect()
    import hashlib
    want = sorted((str(i), len((h or "").encode()), hashlib.sha1((h or "").encode()).hexdigest(),
                   "revisit" if i in (1, None) else "response", 2 if i in (1, None) else None) for i, _, h in pages)
    assert sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == sorted(want, key=lambda w: w)
    assert {bytes(r.payload).decode() for r in got if r.page_id == 7} == {LONG}
    chosen = index.where("page_id in (3, 7)")
    assert {r.page_id for r in warc.read(chosen).collect()} == {3, 7}
    none = warc.write(table.limit(0), Scratch(spark, "none"))
    assert none.count() == 0 and warc.read(none).count() == 0
    runs = list(warc._ranges([("f", 0, 10), ("f", 10, 10), ("f", 20 + warc.GAP_BYTES, 5), ("f", 10 ** 9, 5), ("g", 0, 5)]))
    assert [len(r) for r in runs] == [3, 1, 1]


# -- near duplicates ------------------------------------------------------------------------------------------

def test_near_duplicates_of_odd_rows(spark, odd, empty, folder):
    got = lshforest.link(odd, folder).collect()
    assert len(got) == len(ODD)
    sizes = {i: len(brute.shingles(t)) for i, t in ODD}
    want = brute.components([(i, t) for i, t in dict((i, t) for i, t in ODD if i is not None).items()])
    for r in got:
        assert r.n_shingles == sizes[r.doc_id]
        assert r.component_id == (None if r.doc_id is None else want[r.doc_id])
    kept = lshforest.drop_copies(odd, Scratch(spark, "drop"))
    assert kept.columns == odd.columns
    # One row of each document that stays, and every row without an id.
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["None", *(str(i) for i, c in want.items() if i == c)])
    again = [(1, "a b c"), (1, "a b c"), (1, "x y"), (None, "n"), (None, "n"), (2, "a b c"), (3, ""), (3, "")]
    left = sorted(str(r.doc_id) for r in lshforest.drop_copies(frame(spark, again), Scratch(spark, "again")).collect())
    assert left == ["1", "3", "None", "None"]
    assert lshforest.link(empty, Scratch(spark, "none")).count() == 0


def test_a_crowd_of_near_copies(spark):
    base = [f"b{i}" for i in range(120)]
    pairs = [(0, " ".join(base))]
    for i in range(1, 120):
        w = list(base)
        for k in rng.sample(range(len(w)), rng.randrange(0, 6)):
            w[k] = f"n{i}_{k}"
        pairs.append((i, " ".join(w)))
    got = lshforest.link(frame(spark, pairs), Scratch(spark, "crowd")).collect()
    want = brute.components(pairs)
    assert {r.doc_id: r.component_id for r in got} == want
    # Split regions hold fewer neighbours; the exact join finds the rest.
    split = {r.doc_id: r.component_id for r in lshforest.link(frame(spark, pairs), Scratch(spark, "split"), region=40).collect()}
    assert split == want


def few_links(n=150):
    """Edited copies of one text that share regions, of which many have few links or one."""
    own = random.Random(11)
    base, pairs = [f"b{i}" for i in range(120)], []
    for i in range(n):
        w = list(base)
        for k in own.sample(range(len(w)), own.randrange(2, 6)):
            w[k] = f"n{own.randrange(3)}_{k}"
        pairs.append((i, " ".join(w)))
    return pairs


def test_a_crowd_is_compared_beyond_the_window(spark):
    pairs = few_links()
    want = brute.components(pairs)
    assert 2 < len(set(want.values())) < len(pairs)
    got = lshforest.link(frame(spark, pairs), Scratch(spark, "window"), window=1).collect()
    assert {r.doc_id: r.component_id for r in got} == want


def test_split_regions_lose_no_link(spark):
    # Couples of similarity 0.75, all of whose regions are split.
    pairs = []
    for i in range(0, 600, 2):
        w = [f"c{i}_{k}" for k in range(109)]
        pairs.append((i, " ".join(w)))
        for k in (20, 50, 80):
            w[k] = f"n{i}_{k}"
        pairs.append((i + 1, " ".join(w)))
    got = lshforest.link(frame(spark, pairs), Scratch(spark, "cut"), region=1).collect()
    assert {r.doc_id: r.component_id for r in got} == {i: i - i % 2 for i, _ in pairs}


def template(n):
    """Texts of one form with four free places of forty values: very many share some rare shingles, few are links."""
    own, pairs = random.Random(5), []
    for i in range(n):
        w = [f"f{k}" for k in range(60)]
        for k in (10, 22, 34, 46):
            w[k] = f"v{k}_{own.randrange(40)}"
        pairs.append((i, " ".join(w)))
    return pairs


def test_a_template_loses_no_link(spark):
    pairs = template(600)
    folder = Scratch(spark, "form")
    sets = lshforest._sets(frame(spark, pairs), 5).withColumn("component", F.col("id"))
    found = {(r.a, r.b) for r in lshforest._across(sets, folder, 75).collect()}
    own = {i: brute.shingles(t) for i, t in pairs}
    links = set()
    for a in own:
        for b in own:
            if a < b:
                common = len(own[a] & own[b])
                union = len(own[a]) + len(own[b]) - common
                if 100 * common >= 75 * union and common < union:
                    links.add((a, b))
    assert links and links <= found
    got = lshforest.link(frame(spark, pairs), Scratch(spark, "form-link"), window=1).collect()
    assert {r.doc_id: r.component_id for r in got} == brute.components(pairs)


def test_regions_that_no_prefix_splits(spark):
    # Equal signatures but for what a rare word adds: dealt to pieces by the hash of the id.
    base = " ".join(f"b{i}" for i in range(3000))
    pairs = [(i, f"{base} t{i}") for i in range(60)]
    got = lshforest.link(frame(spark, pairs), Scratch(spark, "same"), region=10, window=2).collect()
    assert {r.component_id for r in got} == {0}


def test_sketches_drop_less_than_a_link_in_a_million():
    bits = lshforest.TREES * lshforest.DEPTH
    differ = 0.25 * (1 - 1 / 4)  # an unequal minimum has two equal low bits by chance
    lost = sum(math.comb(bits, k) * differ ** k * (1 - differ) ** (bits - k) for k in range(lshforest.BITS + 1, bits + 1))
    assert lost < 1e-7


def test_json_is_plain(spark):
    assert json.loads(bytebpe.tokenizer_json({bytes([b]): b for b in range(256)}, public.PATTERN))["model"]["merges"] == []
