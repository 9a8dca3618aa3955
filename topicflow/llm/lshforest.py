"""MinHash near-duplicates by an LSH forest.

A document is the set of its distinct word shingles; documents with equal sets form a
class, represented by its smallest doc_id.  Every class has a signature of TREES * DEPTH
minima.  Tree t sorts the classes by the signature read from position t * DEPTH on; those
that share the first DEPTH minima there form a region, and neighbours in its order, which
share the longest prefixes, are candidates.  The depth adapts: for the rounds below a region of
more than REGION classes is split by the next minima, as deep as the order goes, and one that
even these do not split is dealt to pieces of about REGION by the hash of the id, so that no task takes a whole crowd.

Round 1 pairs each class with the NEXT ones that are next to it in most trees.  Later rounds pair it with the
next WINDOW ones, but only across components found so far, so a group of many copies costs
its size and not its square.  From round 3 on the order within a region is another one each
time, which brings other neighbours together where a region has more than WINDOW classes;
rounds go on until no link is new.  The classes of larger regions (as they were before any split)
that then still hold several components are compared across components without any order or chance: two sets of a link share
one of their rarest shingles, and all pairs that do are confirmed.  Candidates of the rounds that cannot be a link are dropped by their sizes, by the two lowest bits of
their minima (over BITS of 128 differ) and by whole signatures (agreement under FLOOR); a link of
0.75 fails the first by chance 2.5 times in a hundred million, the second 5 times in ten million.  All others are confirmed on full sets.

Two documents of similarity 0.75 share a region in at least one tree with probability
1 - (1 - 0.75 ** 4) ** 32, that is all but 5 in a million.

Texts without words, nulls among them, have the empty set and no link.  Rows without a
doc_id have no link either and a null component.  Rows that share a doc_id count as one
document, of which `drop_copies` leaves one row.  Other columns are not read, or pass through `drop_copies`.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topicflow.llm import words
from topicflow.llm.common import Scratch, ship, slices, texts
from topicflow.llm.graph import components

SHINGLE = 5
SIMILARITY = 75  # percent
TREES = 32
DEPTH = 4
REGION = 20_000  # classes in a region before it is split
WINDOW = 8
NEXT = 3
FLOOR = 0.55
BITS = 50
BUCKET_BITS = 18  # buckets that order shingles by rarity, 8 bytes each on every worker
SALT = 16_384  # sets of a shingle in a task

# Two lowest bits of each minimum, 64 minima in a number.
_SKETCH = ("low1", "low2", "high1", "high2")

_rng = np.random.RandomState(20)
_MULTIPLY = _rng.randint(0, 1 << 62, TREES * DEPTH, np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_FLIP = _rng.randint(0, 1 << 62, TREES * DEPTH, np.int64).astype(np.uint64)


def shingles(column: pa.Array, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of a `texts` column, sorted within each row, and their number by row."""
    own = words.split(column, words.NOT_SPACE, lower=True)
    hashes, counts, rows = own.hashes(), own.counts, own.rows()
    grams = words.gram_hashes(hashes, n)
    full = own.valid(n)[:len(grams)]
    grams, rows = grams[full], rows[:len(full)][full]
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):
        whole = np.array([words.gram_hashes(hashes[own.first[r]:own.first[r + 1]], counts[r])[0] for r in short], np.uint64)
        grams, rows = np.concatenate([grams, whole]), np.concatenate([rows, short])
    order = np.argsort(grams)
    order = order[np.argsort(rows[order].astype(np.min_scalar_type(len(column))), kind="stable")]
    grams, rows = grams[order], rows[order]
    fresh = np.ones(len(grams), bool)
    fresh[1:] = (grams[1:] != grams[:-1]) | (rows[1:] != rows[:-1])
    return grams[fresh], np.bincount(rows[fresh], minlength=len(column))


def _signatures(grams: np.ndarray, begin: np.ndarray) -> np.ndarray:
    out = np.empty((len(begin), TREES * DEPTH), np.uint32)
    for i in range(TREES * DEPTH):
        out[:, i] = np.minimum.reduceat(((grams ^ _FLIP[i]) * _MULTIPLY[i]) >> np.uint64(32), begin)
    return out


def _fixed(rows: np.ndarray) -> pa.Array:
    """A binary column, one row of the matrix each."""
    rows = np.ascontiguousarray(rows)
    return pa.Array.from_buffers(pa.binary(rows.shape[1] * rows.itemsize), len(rows), [None, pa.py_buffer(rows)]).cast(pa.binary())


def sketch(docs: DataFrame, n: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, the set's 128-bit digest and its signature (null for the empty set)."""

    def run(batches):
        for batch in batches:
            for row, part in slices(texts(batch.column("text"))):
                grams, counts = shingles(part, n)
                some = counts > 0
                begin = (np.cumsum(counts) - counts)[some]
                d1, d2 = np.zeros(len(part), np.uint64), np.zeros(len(part), np.uint64)
                signature = pa.nulls(len(part), pa.binary())
                if some.any():
                    d1[some] = np.add.reduceat(words.mix(grams), begin)
                    d2[some] = np.bitwise_xor.reduceat(words.mix(grams + np.uint64(7)), begin)
                    place = np.where(some, np.cumsum(some) - 1, 0)
                    signature = _fixed(_signatures(grams, begin)).take(pa.array(place, mask=~some))
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(row, len(part)).cast(pa.int64()), pa.array(counts, pa.int64()),
                    pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64)), signature,
                ], ["doc_id", "n_shingles", "d1", "d2", "signature"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_shingles long, d1 long, d2 long, signature binary")


def _sets(docs: DataFrame, n: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for row, part in slices(texts(batch.column("text"))):
                grams, counts = shingles(part, n)
                ends = np.concatenate([[0], np.cumsum(counts)])
                own = pa.Array.from_buffers(pa.large_binary(), len(part), [None, pa.py_buffer(ends * 8), pa.py_buffer(grams)])
                # Only documents with a set are asked for.
                signature = _fixed(_signatures(grams, ends[:-1])) if counts.all() else pa.nulls(len(part), pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(row, len(part)).cast(pa.int64()), own.cast(pa.binary()), signature],
                                                 ["id", "shingles", "signature"])

    return docs.select("doc_id", "text").mapInArrow(run, "id long, shingles binary, signature binary")


def _keys(s: np.ndarray, t: int) -> np.ndarray:
    """The regions of signatures (doubled, so that a prefix never ends) in tree t."""
    key = np.full(len(s), words.U64(t))
    for j in range(DEPTH):
        key = words.mix(key * words.U64(0x9E3779B97F4A7C15) + s[:, t * DEPTH + j])
    return key


def _signed(batch: pa.RecordBatch) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint32).reshape(len(batch), -1).astype(np.uint64)


def _sizes(classes: DataFrame) -> DataFrame:
    """How many classes the regions of two and more have; counts combine in each task."""

    def run(batches):
        for batch in batches:
            for lo in range(0, len(batch), 4096):
                s = _signed(batch.slice(lo, 4096))
                for t in range(TREES):
                    region, n = np.unique(_keys(s, t), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(region.view(np.int64)), pa.array(n)], ["region", "n"])

    return classes.select("signature").mapInArrow(run, "region long, n long").groupBy("region").agg(F.sum("n").alias("size")).where("size > 1")


def _forest(classes: DataFrame) -> DataFrame:
    """A row per class and tree: the region, and the next minima that sort and split it."""

    def run(batches):
        for batch in batches:
            ids, sizes = batch.column("id").to_numpy(), batch.column("n_shingles").to_numpy()
            for lo in range(0, len(ids), 4096):
                some = batch.slice(lo, 4096)
                s = _signed(some)
                low, high = (np.packbits(((s >> words.U64(j)) & words.U64(1)).astype(np.uint8), axis=1).view(np.int64) for j in (0, 1))
                own = [pa.array(x) for x in (ids[lo:lo + len(some)], sizes[lo:lo + len(some)], *low.T, *high.T)]
                turned = np.concatenate([s, s], axis=1)
                for t in range(TREES):
                    at, key = t * DEPTH, _keys(turned, t)
                    next1 = (turned[:, at + DEPTH] << words.U64(32)) | turned[:, at + DEPTH + 1]
                    next2 = (turned[:, at + DEPTH + 2] << words.U64(32)) | turned[:, at + DEPTH + 3]
                    yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (key, next1, next2)] + own,
                                                     ["region", "next1", "next2", "id", "n", *_SKETCH])

    return classes.select("id", "n_shingles", "signature").mapInArrow(run, "region long, next1 long, next2 long, id long, n long" + "".join(f", {c} long" for c in _SKETCH))


def _regions(classes: DataFrame, folder: Scratch, limit: int) -> tuple[DataFrame, DataFrame]:
    """Rows of regions of two and more classes, whole, and with crowded regions split by their next minima, at last by
    the hash of the id.  Sizes are counted apart and joined, so that no task holds a region to count it."""
    whole = forest = folder.save("forest", _forest(classes).join(_sizes(classes), "region"))
    for turn, by in enumerate((F.col("next1"), F.col("next2"), F.pmod(F.xxhash64("region", "id"), F.ceil(F.col("size") / limit)))):
        crowded = forest.where(F.col("size") > limit)
        if not crowded.limit(1).count():
            break
        crowded = crowded.withColumn("region", F.xxhash64("region", by)).drop("size")
        size = crowded.groupBy("region").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
        forest = folder.save(f"forest-{turn}", forest.where(F.col("size") <= limit).unionByName(crowded.join(size, "region")))
    return whole, forest


def _confirmed(pairs: DataFrame, sets: DataFrame, similarity: int, floor: float = FLOOR) -> DataFrame:
    """Pairs whose full sets are similar enough; signatures that cannot belong to a link (agreement under floor) go first."""
    one = sets.select(F.col("id").alias("a"), F.col("shingles").alias("x"), F.col("signature").alias("sx"))
    two = sets.select(F.col("id").alias("b"), F.col("shingles").alias("y"), F.col("signature").alias("sy"))

    def run(batches):
        for batch in batches:
            s, t = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(len(batch), -1) for c in ("sx", "sy"))
            linked = (s == t).mean(axis=1) >= floor if len(batch) else np.empty(0, bool)
            for i in np.flatnonzero(linked).tolist():
                x, y = (np.frombuffer(batch.column(c)[i].as_buffer(), np.uint64) for c in ("x", "y"))
                both = np.sort(np.concatenate([x, y]))
                common = int((both[1:] == both[:-1]).sum())
                linked[i] = 100 * common >= similarity * (len(both) - common)
            yield batch.select(["a", "b"]).filter(pa.array(linked))

    return pairs.join(one, "a").join(two, "b").mapInArrow(run, "a long, b long")


def _grams(part: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All shingles of a large binary column of sets, and their number by row."""
    offsets = np.frombuffer(part.buffers()[1], np.int64, len(part) + 1, part.offset * 8)
    return np.frombuffer(part.buffers()[2], np.uint8)[offsets[0]:offsets[-1]].view(np.uint64), np.diff(offsets) // 8


def _bucket(grams: np.ndarray) -> np.ndarray:
    return (words.mix(grams) >> words.U64(64 - BUCKET_BITS)).astype(np.int64)


def _prefixes(crowd: DataFrame, similarity: int) -> DataFrame:
    """The rarest shingles of each set (id, component, shingles), so many that two sets of a link share one.

    Rare is what falls in a bucket of few; whatever the buckets say, all sets are in the same order."""

    def count(batches):
        n = np.zeros(1 << BUCKET_BITS, np.int64)
        for batch in batches:
            for _, part in slices(batch.column("shingles").cast(pa.large_binary())):
                n += np.bincount(_bucket(_grams(part)[0]), minlength=len(n))
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(n[some])], ["bucket", "n"])

    counted = crowd.select("shingles").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    often = np.zeros(1 << BUCKET_BITS, np.int64)
    often[counted["bucket"].to_numpy()] = counted["n"].to_numpy()
    shared = crowd.sparkSession.sparkContext.broadcast(often)

    def run(batches):
        for batch in batches:
            ids, component = batch.column("id").to_numpy(), batch.column("component").to_numpy()
            for row, part in slices(batch.column("shingles").cast(pa.large_binary())):
                grams, counts = _grams(part)
                owner = np.repeat(np.arange(len(part)), counts)
                grams = grams[np.lexsort((grams, shared.value[_bucket(grams)], owner))]
                place = np.arange(len(grams)) - np.repeat(np.cumsum(counts) - counts, counts)
                keep = place <= (counts - (similarity * counts + 99) // 100)[owner]
                grams, place, owner = grams[keep], place[keep], owner[keep]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (ids[row + owner], component[row + owner], counts[owner], place, grams.view(np.int64))],
                    ["id", "component", "n", "place", "shingle"])

    return crowd.select("id", "component", "shingles").mapInArrow(run, "id long, component long, n long, place long, shingle long")


def _across(crowd: DataFrame, folder: Scratch, similarity: int) -> DataFrame:
    """All pairs (a, b) of sets of different components that can be a link; none that is one is left out."""
    rows = folder.save("prefixes", _prefixes(crowd, similarity))
    shared = rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("m"), F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    rows = rows.join(shared.select("shingle", F.ceil(F.col("m") / SALT).alias("salts")), "shingle")
    # A shingle of very many sets is dealt to several tasks: one side is cut, the other copied.
    one = rows.withColumn("salt", F.pmod(F.xxhash64("id"), "salts")).alias("x")
    two = rows.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1))).alias("y")
    fits = F.col("x.component") < F.col("y.component")
    fits &= 100 * F.least("x.n", "y.n") >= similarity * F.greatest("x.n", "y.n")
    # At the first shingle they share, what follows in both is all they can share besides.
    fits &= (100 + similarity) * F.least(F.col("x.n") - F.col("x.place"), F.col("y.n") - F.col("y.place")) >= similarity * (F.col("x.n") + F.col("y.n"))
    same = (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.salt") == F.col("y.salt"))
    return one.join(two, same & fits).select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct()


def link(docs: DataFrame, folder: Scratch, similarity: int = SIMILARITY, n: int = SHINGLE, window: int = WINDOW,
         region: int = REGION) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of docs (doc_id, text)."""
    ship(docs.sparkSession)
    sketches = folder.save("sketch", sketch(docs, n))
    classes = (sketches.where("doc_id is not null and n_shingles > 0").groupBy("d1", "d2").agg(F.min("doc_id").alias("id")))
    classes = folder.save("classes", classes)
    chosen = sketches.join(classes.withColumnRenamed("id", "doc_id"), ["d1", "d2", "doc_id"], "left_semi")
    chosen = folder.save("signed", chosen.dropDuplicates(["d1", "d2", "doc_id"]).select(F.col("doc_id").alias("id"), "n_shingles", "signature"))
    whole, forest = _regions(chosen, folder, region)
    ids = whole.select("id").distinct()
    wanted = docs.join(ids.withColumnRenamed("id", "doc_id"), "doc_id", "left_semi")
    sets = folder.save("sets", _sets(wanted.groupBy("doc_id", F.xxhash64("text")).agg(F.first("text").alias("text")), n))

    def differ(x: Column, name: str) -> Column:
        return x[name].bitwiseXOR(F.col(name))

    def candidates(rows: DataFrame, reach: int, *order) -> DataFrame:
        """Pairs of the next `reach` rows of a region, of different components, that sizes and bits allow a link."""
        ahead = F.collect_list(F.struct("id", "component", "n", *_SKETCH)).over(Window.partitionBy("region").orderBy(*order, "id").rowsBetween(1, reach))
        fits = F.filter("ahead", lambda x: (x["component"] != F.col("component"))
                        & (100 * F.least(x["n"], F.col("n")) >= similarity * F.greatest(x["n"], F.col("n")))
                        & (F.bit_count(differ(x, "low1").bitwiseOR(differ(x, "high1")))
                           + F.bit_count(differ(x, "low2").bitwiseOR(differ(x, "high2"))) <= BITS))
        near = rows.select("id", "component", "n", *_SKETCH, ahead.alias("ahead")).select("id", F.explode(fits).alias("other"))
        return near.select(F.least("id", "other.id").alias("a"), F.greatest("id", "other.id").alias("b"))

    turn, tried, links, found = 1, [], [], None
    while True:
        now = forest.withColumn("component", F.col("id")) if found is None else (
            forest.join(found, "id", "left").withColumn("component", F.coalesce("component", "id")))
        if found is not None:
            mixed = now.groupBy("region").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
            now = now.join(mixed.select("region"), "region", "left_semi")
        if turn == 1:
            # Of the next ones in all trees, at most one in each, those that are next in most of them.
            times = candidates(now, 1, "next1", "next2").groupBy("a", "b").agg(F.count(F.lit(1)).alias("times"))
            best = F.slice(F.sort_array(F.collect_list(F.struct("times", "b")), asc=False), 1, NEXT)
            pairs = times.groupBy("a").agg(best.alias("best")).select("a", F.explode("best.b").alias("b"))
        elif turn == 2:
            pairs = candidates(now, window, "next1", "next2").distinct()
        else:
            pairs = candidates(now, window, F.xxhash64("next2", F.lit(turn)), "next1").distinct()
        if tried:
            pairs = pairs.join(reduce(DataFrame.union, tried), ["a", "b"], "left_anti")
        tried.append(folder.save(f"pairs-{turn}", pairs))
        links.append(folder.save(f"links-{turn}", _confirmed(tried[-1], sets, similarity)))
        if turn > 1 and not links[-1].limit(1).count():
            break
        edges = links[-1] if found is None else links[-1].union(found.select(F.col("id").alias("a"), F.col("component").alias("b")))
        found = components(edges, folder, f"found-{turn}")
        turn += 1
    # Regions in which the rounds did not compare everything; those that were split count as a whole.
    crowd = whole.where(F.col("size") > min(window + 1, region)).join(found, "id", "left").select("region", "id", F.coalesce("component", "id").alias("component"))
    mixed = crowd.groupBy("region").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    crowd = folder.save("crowd", crowd.join(mixed.select("region"), "region", "left_semi").select("id", "component").distinct())
    if crowd.limit(1).count():
        pairs = folder.save("pairs-across", _across(sets.join(crowd, "id"), folder, similarity))
        # No signature decides here.
        last = folder.save("links-across", _confirmed(pairs, sets, similarity, 0.0))
        found = components(last.union(found.select(F.col("id").alias("a"), F.col("component").alias("b"))), folder, "found-across")
        folder.drop("prefixes", "pairs-across")
    folder.drop("crowd", "sets", "forest", "forest-0", "forest-1", "forest-2", "signed")
    members = sketches.select("doc_id", "n_shingles", "d1", "d2").join(classes, ["d1", "d2"], "left")
    return (members.join(found, "id", "left")
            .select("doc_id", "n_shingles", F.when(F.col("n_shingles") == 0, F.col("doc_id")).when(F.col("doc_id").isNotNull(), F.coalesce("component", "id")).alias("component_id")))


def drop_copies(docs: DataFrame, folder: Scratch, similarity: int = SIMILARITY) -> DataFrame:
    """The documents that are the smallest of their component, one row each, and those without an id, all rows.

    Of rows that share an id the one whose columns have the smallest hash stays."""
    found = link(docs.select("doc_id", "text"), folder, similarity)
    kept = folder.save("kept", found.where("doc_id = component_id").groupBy("doc_id").agg(F.count(F.lit(1)).alias("copies")))
    done = docs.where("doc_id is null").unionByName(docs.join(kept.where("copies = 1"), "doc_id", "left_semi"))
    if kept.where("copies > 1").limit(1).count():
        whole = F.struct(*docs.columns)
        rows = docs.join(kept.where("copies > 1"), "doc_id", "left_semi").select("doc_id", whole.alias("row"), F.xxhash64(F.to_json(whole)).alias("order"))
        done = done.unionByName(rows.groupBy("doc_id").agg(F.min_by("row", "order").alias("row")).select("row.*"))
    return done
