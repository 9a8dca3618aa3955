"""Spelling variants, ranked search and top-k against brute force, with odd rows."""

import math
import random
import re
import zlib
from collections import Counter

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from topicflow.llm import ranked, topk, variants
from topicflow.llm.common import Scratch, texts

rng = random.Random(11)
LETTERS = re.compile("[A-Za-zÀ-ÿ]+")
TERMS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


@pytest.fixture
def folder(spark):
    return Scratch(spark, "test")


# -- spelling variants -----------------------------------------------------------

def edits(word):
    """All words with one letter less, and with one replaced by a mark."""
    return {word[:i] + word[i + 1:] for i in range(len(word))}, {word[:i] + "*" + word[i + 1:] for i in range(len(word))}


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) - len(short) == 1 and short in edits(long)[0]


def brute_variants(rows, divisor=199):
    n = Counter()
    for doc_id, text in rows:
        for run in LETTERS.findall((text or "").translate(brute.LOWER)):
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if doc_id is not None and h % divisor == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    n = {w: k for w, k in n.items() if len(w) >= 6 and k >= 5}
    near = {w: [x for x in n if is_near(w, x)] for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 5 * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None)
    return out


def test_runs_and_their_hashes():
    some = ["Straße ÀÉ×÷ÿ naïve-x ŁódźabcÃ", "", "日本語abc  Zz", "q" * 70 + " é" + "w" * 63, "Ã\u0080 Ā"]
    own = variants.runs(texts(pa.array(some)))
    raw = own.data.tobytes()
    got = [[raw[own.start[k]:own.end[k]].decode() for k in range(own.first[r], own.first[r + 1])] for r in range(len(some))]
    assert got == [LETTERS.findall(t.translate(brute.LOWER)) for t in some]
    shifts = variants._shifts([b"12:", b"-7:", b""])
    for word in (b"", b"abc", "naïve".encode(), b"z" * 63):
        assert [int(x) ^ zlib.crc32(word) for x in shifts[len(word)]] == [zlib.crc32(p + word) for p in (b"12:", b"-7:", b"")]


def test_near_words_share_a_signature():
    """Whatever letter is replaced, inserted or deleted."""
    for _ in range(300):
        length = rng.randrange(2, 12)
        a = "".join(rng.choice("abcé") for _ in range(length))
        i = rng.randrange(length)
        for b in (a[:i] + rng.choice("xyzÿ") + a[i + 1:], a[:i] + a[i + 1:]):
            short, long = sorted((a, b), key=len)
            left, right = (variants.signatures(np.array([[ord(c) for c in w]], np.uint32)) for w in (short, long))
            equal = len(a) == len(b)
            left = {int(k[0]) for side, k in left if side == (variants._EQUAL if equal else variants._SHORTER)}
            right = {int(k[0]) for side, k in right if side == (variants._EQUAL if equal else variants._LONGER)}
            assert left & right, (a, b)


def test_variants_equal_brute_force(spark, folder):
    stem = ["trending", "größere", "messages", "abcdef", "fedcba", "aaaaaa", "aaaaaaa", "ÀÿÀÿÀÿ"]
    rows = []
    for i in range(300):
        words = []
        for _ in range(rng.randrange(1, 40)):
            w = rng.choice(stem[:1 + rng.randrange(len(stem))])
            if rng.random() < 0.3:
                k = rng.randrange(len(w))
                w = w[:k] + rng.choice(["", "x", "é", w[k] + "y"]) + w[k + 1:]
            words.append(w.upper() if rng.random() < 0.1 else w)
        rows.append((i, " ".join(words)))
    rows += [(None, "Trending " * 30), (7, None), (8, ""), (5, rows[5][1]), (5, rows[5][1]), (9, "z" * 100_000 + " " + ("q" * 70 + " ") * 6)]
    rows += [(400 + i, "trendingq " * 10 + "trendingqz") for i in range(6)]
    docs = spark.createDataFrame([(i, t, "w", "r", 1) for i, t in rows], "doc_id long, text string, word string, root string, n int")
    for divisor in (199, 3):
        got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in variants.group(docs, Scratch(spark, "v"), divisor=divisor).collect()}
        want = brute_variants(rows, divisor)
        assert got == want
        assert len(want) > 20 and any(x[0] for x in want.values()) and (divisor == 3 or any(x[1] != (x[0] or w) for w, x in want.items()))
    assert variants.group(docs.limit(0), folder).collect() == []


def test_ways_of_many_steps(spark, folder):
    chain = [(chr(97 + i) * 6, 5 ** (20 - i), chr(98 + i) * 6 if i < 15 else None) for i in range(16)]
    forms = spark.createDataFrame(chain, "word string, n long, form string")
    assert {r.root for r in variants.roots(forms, folder, 5).collect()} == {"p" * 6}


# -- ranked search ----------------------------------------------------------------

def brute_ranked(docs, items, k):
    counts = [(i, Counter(TERMS.findall((t or "").translate(brute.LOWER)))) for i, t in docs if i is not None]
    counts = [(i, c) for i, c in counts if c]
    n, total = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(w for _, c in counts for w in c)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(TERMS.findall((text or "").translate(brute.LOWER)))
    out = []
    for item, terms in wanted.items():
        scored = []
        for i, c in counts:
            m = 10 + (90 * sum(c.values()) * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * ((10 ** 9 * c[w]) // (1000 * c[w] + 8 * m)) for w in terms if c[w])
            if s > 0:
                scored.append((-s, i))
        out += [(item, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k])]
    return Counter(out)


def test_ranked_equals_brute_force(spark, folder, monkeypatch):
    vocabulary = [f"w{i}" for i in range(60)] + ["Été", "日本", "it's", "A1"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    docs = [(i, " ".join(rng.choices(vocabulary, weights, k=rng.randrange(0, 60)))) for i in range(700)]
    docs += [(1000 + i, docs[3][1]) for i in range(200)] + [(5, docs[5][1])] * 3 + [(None, "w1 w50"), (2000, None), (2001, ""), (2002, "w59 " * 20_000), (-4, "w59")]
    items = [(i, " ".join(rng.choices(vocabulary, weights, k=rng.randrange(1, 25)))) for i in range(12)]
    items += [(3, "w59 été"), (None, "w58 w57"), (None, "w56"), (20, None), (21, ""), (22, "unknown"), (23, docs[3][1])]
    table = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in docs], "doc_id long, text string, rank int, item_id string, score long").repartition(3)
    asked = spark.createDataFrame([(i, t, 9) for i, t in items], "item_id long, text string, doc_id long")
    want = brute_ranked(docs, items, 10)
    got = ranked.search(table, asked, 10, folder)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert Counter(map(tuple, got.collect())) == want
    # Several blocks of items.
    assert Counter(map(tuple, ranked.search(table, asked, 10, Scratch(spark, "r"), block=100).collect())) == want
    assert ranked.search(table.limit(0), asked, 10, Scratch(spark, "r")).collect() == []
    assert ranked.search(table, asked.limit(0), 10, Scratch(spark, "r")).collect() == []


def test_intervals_find_what_a_full_scan_finds():
    """Small segments and leaves, so that splitting decides; fewer documents are scored than there are."""
    gen = np.random.RandomState(3)
    old, ranked.LEAF = ranked.LEAF, 2
    try:
        fewer = 0
        for turn in range(20):
            size, lists = 400, 6
            held = [np.sort(gen.choice(size, gen.randint(1, size), replace=False)) for _ in range(lists)]
            tfs = [gen.zipf(1.5, len(h)).clip(1, 1000) for h in held]
            row = {"doc_ids": np.arange(size, dtype=np.int64).tobytes(), "lengths": gen.randint(1, 5000, size).astype(np.int64).tobytes(), "terms": list(range(lists)),
                   "df": [len(h) for h in held], "places": np.concatenate(held).astype(np.int32).tobytes(), "tfs": np.concatenate(tfs).astype(np.int32).tobytes()}
            weight = gen.randint(1, 5000, lists).astype(np.int64)
            postings = ranked.Postings(row, weight, size, 400 * size)
            full = np.zeros(size, np.int64)
            np.add.at(full, postings.places, postings.impacts)
            search = ranked.Search(postings, np.arange(lists))
            seen = 0
            score = search.scores

            def counted(docs):
                nonlocal seen
                seen += len(docs)
                return score(docs)

            search.scores = counted
            ids, scores = search.best(5, np.empty(0, np.int64), np.empty(0, np.int64))
            want, _ = ranked.top(np.flatnonzero(full), full[full > 0], 5)
            assert ids.tolist() == want.tolist() and scores.tolist() == full[want].tolist()
            bound, split = search.bounds(np.array([0, 10]), np.array([size, 20]))
            for b, low, high in zip(bound, (0, 10), (size, 20)):
                inside = (postings.places >= low) & (postings.places < high)
                lists_of = np.repeat(np.arange(lists), row["df"])
                assert b == sum(postings.impacts[inside & (lists_of == t)].max(initial=0) for t in range(lists))
            fewer += seen < size / 2
        assert fewer > 5
    finally:
        ranked.LEAF = old


# -- top-k -------------------------------------------------------------------------

def brute_topk(rows, is_query, k):
    best = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        v = [math.floor(256 * x) for x in v]
        best[i] = max(best.get(i, v), v)
    out = []
    for q, v in best.items():
        if is_query(q):
            scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in best.items() if i != q and len(w) == len(v))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def test_topk_equals_brute_force(spark, folder):
    gen = np.random.RandomState(5)
    rows = [(i, (gen.randn(12) / 4).tolist()) for i in range(900)]
    rows += [(2000 + i, [0.5] * 12) for i in range(400)] + [(3000 + i, [0.0] * 12) for i in range(10)]
    rows += [(10, rows[20][1]), (10, rows[10][1]), (None, [1.0] * 12), (4000, None), (4010, [1.0] * 11 + [None]), (4020, [float("nan")] * 12),
             (4030, [float("inf")] + [0.0] * 11), (5000, [0.25] * 3), (5001, [-0.25] * 3), (6000, []), (6001, []), (-50, (gen.randn(12) / 4).tolist())]
    table = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, rank int, score string").repartition(3)
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    want = brute_topk(rows, lambda i: i % 10 == 0, 5)
    got = topk.top_k(table, "vec_id", "embedding", F.col("vec_id") % 10 == 0, 5, folder)
    assert sorted(map(tuple, got.collect())) == want
    # Many shards, several blocks of queries.
    found = folder.save("v", topk.vectors(table, "vec_id", "embedding"))
    asked = found.where(F.col("vec_id") % 10 == 0)
    for shard, block in ((50, 1000), (128, 40)):
        fresh = Scratch(spark, "k")
        assert sorted(map(tuple, topk.search(topk.index(found, fresh, shard), asked, 5, fresh, block).collect())) == want
    assert topk.top_k(table.limit(0), "vec_id", "embedding", F.col("vec_id") % 10 == 0, 5, Scratch(spark, "k")).collect() == []


def test_reading_stops_before_the_ends(spark):
    gen = np.random.RandomState(6)
    v = np.floor(gen.randn(2000, 16) * 60).astype(np.int64)
    v[::7] = v[0]
    ids = np.arange(2000, dtype=np.int64)
    lists = np.ascontiguousarray(np.argsort(v, axis=0, kind="stable").astype(np.int32).T)
    shard = topk.Shard(16, ids.tobytes(), v.tobytes(), lists.tobytes())
    for i in range(0, 400, 9):
        full = v @ v[i]
        full[i] = -10 ** 12
        want = sorted(zip((-full).tolist(), ids.tolist()))[:5]
        places, scores = shard.best(v[i], i, 5, -want[-1][0])
        assert sorted(zip((-scores).tolist(), places.tolist()))[:5] == want
        places, scores = shard.best(v[i], i, 5, None)
        assert sorted(zip((-scores).tolist(), places.tolist()))[:5] == want
    shard.read = 0
    unlike = [i for i in range(0, 400, 9) if i % 7]
    for i in unlike:
        shard.best(v[i], i, 5, int(np.sort(v @ v[i])[-6]))
    assert shard.read < len(unlike) * v.size
