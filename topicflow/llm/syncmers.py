"""Document fingerprints by closed syncmers, in DataFrame expressions only.

A text is a sequence of units: words, of which long ones are cut into pieces of UNIT
characters.  Of every K consecutive units the S-unit substrings are hashed; where the
smallest is the first or the last of them, the K units are an anchor.  Whether they are
depends on these units alone, so a passage keeps its anchors wherever it stands.

The fingerprint is the anchors' 32-bit hashes in text order, eight hex digits each, so that
two fingerprints can also be matched by position.  Their likeness is the Jaccard similarity
of the sets.  A text without any such anchor (fewer than K units, or few more) has one, the hash
of the whole; the empty text, as null, has none, and two such texts are alike.

`with_edits` pairs each document with the next one in descending doc_id (null ids last, equal
ids by a hash of their text).  Documents are dealt to buckets of neighbouring ids by
a piecewise linear function of the id, and the first of each bucket is copied to the one
before it, so that no window spans all rows.  Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNIT = 16
K = 6
S = 2
BUCKET_ROWS = 4096
MAX_BUCKETS = 16_384  # heads of buckets are broadcast: at most 16 bytes for each
_KNOTS = 128


def anchors(rows: DataFrame, text: str, out: str) -> DataFrame:
    """Add the anchors of a text column: an array of 32-bit hashes in text order."""
    units, pairs = f"__units_{out}", f"__pairs_{out}"
    pattern = rf"[^\x20\x09-\x0D]{{1,{UNIT}}}"
    rows = rows.withColumn(units, F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda u: F.xxhash64(u)))
    # Hashes of two units each; get() is null past the end, where nothing reads it.
    rows = rows.withColumn(pairs, F.transform(units, lambda u, i: F.xxhash64(u, F.get(units, i + 1))))
    inner = K - S + 1

    def closed(i: Column) -> Column:
        edge = F.least(F.get(pairs, i), F.get(pairs, i + inner - 1))
        return edge <= F.least(*(F.get(pairs, i + j) for j in range(1, inner - 1)))

    starts = F.filter(F.sequence(F.lit(0), F.size(units) - K), closed)
    whole = F.when(F.length(text) > 0, F.array(F.hash(text))).otherwise(F.array().cast("array<int>"))
    found = F.transform(starts, lambda i: F.hash(*(F.get(pairs, i + j) for j in range(0, K - 1, S))))
    rows = rows.withColumn(out, F.when(F.size(units) >= K, found).otherwise(F.array().cast("array<int>")))
    # Fewer than K + 3 units may hold no closed syncmer.
    return rows.withColumn(out, F.when(F.size(out) > 0, F.col(out)).otherwise(whole)).drop(units, pairs)


def fingerprint(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda a: F.substring(F.hex(a.cast("long") + (1 << 32)), 2, 8)), "")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two arrays of anchors; 1 if both are empty."""
    common = F.size(F.array_intersect(a, b))
    union = F.size(F.array_distinct(a)) + F.size(F.array_distinct(b)) - common
    return F.when(union > 0, common / union).otherwise(F.lit(1.0))


def positional_matches(a: DataFrame, b: DataFrame) -> DataFrame:
    """Anchors that documents of a (doc_id, anchors) share with those of b: places in both, and their
    distance, which is one number along a common passage."""
    one = a.select(F.col("doc_id").alias("a"), F.posexplode("anchors").alias("place_a", "anchor"))
    two = b.select(F.col("doc_id").alias("b"), F.posexplode("anchors").alias("place_b", "anchor"))
    return one.join(two, "anchor").select("a", "b", "anchor", "place_a", "place_b", (F.col("place_b") - F.col("place_a")).alias("shift"))


def _bucket(ids: DataFrame) -> Column:
    """The bucket of doc_id, a number that grows with it, from quantiles of all ids; null ids come first."""
    count, low, knots = ids.agg(
        F.count("doc_id"), F.min("doc_id"), F.percentile_approx("doc_id", [k / _KNOTS for k in range(1, _KNOTS + 1)], 10_000)).first()
    if not count:
        return F.lit(-1).cast("long")
    knots = sorted({low - 1, *knots})
    each = -(-min(MAX_BUCKETS, -(-count // BUCKET_ROWS)) // (len(knots) - 1))

    line = F.array(*(F.lit(k).cast("long") for k in knots))
    # The knot below the id, counted from 1; the smallest id is above the first knot.
    at = F.size(F.filter(line, lambda k: k < F.col("doc_id")))
    below, above = F.get(line, at - 1), F.get(line, at)
    share = (F.col("doc_id") - below - 1) / (above - below)
    return F.coalesce((at - 1) * each + F.least(F.floor(share * each), F.lit(each - 1)), F.lit(-1)).cast("long")


def with_edits(docs: DataFrame) -> DataFrame:
    """doc_id, text, next (the next document's text), edited, and the anchors of the three.

    The edited text is the document's with its last half replaced by the beginning of the next:
    floor(n / 2) of its n code points go, and as many of the next come, or all.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("bucket", _bucket(rows.select("doc_id")))
    heads = rows.groupBy("bucket").agg(F.max("doc_id").alias("doc_id"))
    listed = sorted((r.bucket, r.doc_id) for r in heads.collect())
    # Each bucket's first document follows the last of the bucket above, the very first that of the lowest.
    ghosts = [(doc_id, listed[(i + 1) % len(listed)][0]) for i, (_, doc_id) in enumerate(listed)]
    ghosts = docs.sparkSession.createDataFrame(ghosts, "id long, above long")
    own, copy = (F.struct(F.col(c).alias("bucket"), F.lit(g).alias("ghost")) for c, g in (("bucket", False), ("above", True)))
    dealt = rows.join(F.broadcast(ghosts), rows["doc_id"].eqNullSafe(ghosts["id"]), "left").select(
        "doc_id", "text", F.explode(F.when(F.col("above").isNull(), F.array(own)).otherwise(F.array(own, copy))).alias("to"))
    dealt = dealt.select("doc_id", "text", "to.bucket", "to.ghost").repartition(F.col("bucket"))
    dealt = anchors(dealt, "text", "anchors")
    order = Window.partitionBy("bucket").orderBy("ghost", F.col("doc_id").desc_nulls_last(), F.xxhash64("text"), "text")
    rows = dealt.select("*", F.lead("text").over(order).alias("next"), F.lead("anchors").over(order).alias("next_anchors")).where("not ghost")
    half = F.floor(F.length("text") / 2).cast("int")
    kept = F.substring("text", F.lit(1), F.length("text") - half)
    rows = rows.withColumn("edited", F.concat(kept, F.substring("next", F.lit(1), half)))
    return anchors(rows, "edited", "edited_anchors").select("doc_id", "text", "next", "edited", "anchors", "next_anchors", "edited_anchors")
