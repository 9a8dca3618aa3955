"""Quality by compression: one zstandard dictionary of good text, one of bad.

A text is compressed in blocks with either dictionary; the one that fits gives the
smaller size.  The difference over the sum of the sizes, with the sum over the text's own
size (repetition compresses well with both) and the length, goes through a logistic
curve, which makes it the probability of a good label.

The fit takes a bounded sample of labelled rows: SAMPLE rows for the dictionaries, SAMPLE
others for the curve, those with the smallest hashes of their ids, of at most
SAMPLE_CHARS characters each; of texts that share an id the smallest.  Lines that occur in both classes enter no dictionary.
Scoring reads every text whole.

Null texts are empty; an empty text's score is the share of good labels.  Rows with a null
label or id are not learned from; of several labels of one id the largest counts.  With
labels of one class only every score is the share.  Repeated rows are scored alike, other
columns pass through, one named like a result is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicflow.llm.common import ship

BLOCK = 1024
LEVEL = 3
DICTIONARY = 64 << 10
SAMPLE = 3000
SAMPLE_CHARS = 20_000
THRESHOLD = 0.7
_SMOOTH = 100  # bytes that hold the difference of short texts down
_RIDGE = 0.01


def held_out(doc_id: str) -> Column:
    return F.crc32(F.col(doc_id).cast("string")) % 4 == 2


def _blocks(raw: bytes) -> list[bytes]:
    return [raw[i:i + BLOCK] for i in range(0, len(raw), BLOCK)]


def _dictionary(texts: list[str], left_out: set[str]) -> bytes:
    """A trained dictionary; the text itself where there is too little to train on."""
    lines = ["\n".join(line for line in t.split("\n") if line not in left_out) for t in texts]
    blocks = [b for t in lines for b in _blocks(t.encode()) if len(b) >= 8]
    # The trainer needs about a hundred times the dictionary, and no more.
    total = np.cumsum([len(b) for b in blocks]) if blocks else np.empty(0)
    blocks = blocks[:int(np.searchsorted(total, 100 * DICTIONARY)) + 1]
    try:
        return zstandard.train_dictionary(DICTIONARY, blocks).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(blocks)[-DICTIONARY:]


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    own = None
    if len(dictionary) >= 8:
        own = zstandard.ZstdCompressionDict(dictionary)
        own.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=own, write_content_size=False, write_checksum=False, write_dict_id=False)


@dataclass
class Model:
    good: bytes
    bad: bytes
    share: float
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray | None

    def compressors(self) -> tuple[zstandard.ZstdCompressor, zstandard.ZstdCompressor]:
        return _compressor(self.good), _compressor(self.bad)

    def scores(self, sizes: np.ndarray) -> np.ndarray:
        """The probability of a good label for rows of (size with good, with bad, bytes)."""
        out = np.full(len(sizes), self.share)
        if self.weights is not None:
            x = (_features(sizes) - self.mean) / self.scale
            out = _logistic(self.weights[0] + x @ self.weights[1:])
            out[sizes[:, 2] == 0] = self.share
        return out


def sizes(texts: list[str | None], good: zstandard.ZstdCompressor, bad: zstandard.ZstdCompressor) -> np.ndarray:
    out = np.zeros((len(texts), 3))
    for i, text in enumerate(texts):
        raw = (text or "").encode()
        blocks = _blocks(raw)
        out[i] = sum(len(good.compress(b)) for b in blocks), sum(len(bad.compress(b)) for b in blocks), len(raw)
    return out


def _features(sizes: np.ndarray) -> np.ndarray:
    g, b, n = sizes.T
    difference = (b - g) / (b + g + _SMOOTH)
    density = np.log((b + g + 20) / (2 * n + 20))
    length = np.log(n + 1)
    return np.stack([difference, density, difference ** 2, density ** 2, difference * density, length,
                     length * difference, length * density], axis=1)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _calibrate(features: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    mean, scale = features.mean(axis=0), features.std(axis=0) + 1e-9
    x = np.column_stack([np.ones(len(features)), (features - mean) / scale])
    w = np.zeros(x.shape[1])
    for _ in range(40):
        p = _logistic(x @ w)
        curve = (x * (p * (1 - p))[:, None]).T @ x + _RIDGE * np.eye(len(w))
        w += np.linalg.solve(curve, x.T @ (label - p) - _RIDGE * w)
    return mean, scale, w


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn from labels (doc_id, quality) of documents that are not held out."""
    known = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out("doc_id"))
             .groupBy("doc_id").agg(F.max("quality").alias("quality")))
    by = F.xxhash64("doc_id")
    turn = F.pmod(by, F.lit(2))
    # As many bad as good for the dictionaries.
    chosen = [known.where(turn == 0).where(F.col("quality") == q).orderBy(by).limit(sample // 2) for q in (1, 0)]
    chosen = chosen[0].union(chosen[1]).union(known.where(turn == 1).orderBy(by).limit(sample))
    rows = docs.select("doc_id", "text").join(chosen, "doc_id").where(F.length("text") <= SAMPLE_CHARS)
    rows = rows.groupBy("doc_id", "quality").agg(F.min("text").alias("text")).withColumn("turn", turn).collect()
    parts = [sorted((r for r in rows if r.turn == t), key=lambda r: r.doc_id) for t in (0, 1)]
    of = {q: [r.text for r in parts[0] if (r.quality == 1) == (q == 1)] for q in (0, 1)}
    both = set.intersection(*({line for t in of[q] for line in t.split("\n")} for q in (0, 1)))
    good, bad = (_dictionary(of[q], both) for q in (1, 0))
    label = np.array([float(r.quality == 1) for r in parts[1]])
    share = float(label.mean()) if len(label) else 0.5
    model = Model(good, bad, share, np.zeros(8), np.ones(8), None)
    if of[0] and of[1] and 0 < share < 1:
        model.mean, model.scale, model.weights = _calibrate(_features(sizes([r.text for r in parts[1]], *model.compressors())), label)
    return model


def score(docs: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """Add score (0 to 1) and predicted (1 from THRESHOLD on)."""
    spark = docs.sparkSession
    ship(spark)
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("score", "predicted")]
    chosen = docs.select(*keep, F.col("text").alias("__text"))
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        good, bad = shared.value.compressors()
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                part = batch.slice(lo, 1000)
                scores = shared.value.scores(sizes(part.column("__text").to_pylist(), good, bad))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), pa.array(scores), pa.array((scores >= THRESHOLD).astype(np.int32))],
                                                 [*keep, "score", "predicted"])

    schema = T.StructType([chosen.schema[c] for c in keep] + [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return chosen.mapInArrow(run, schema)


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier does not reject, with their columns."""
    inner = docs.withColumns({f"__{i}": F.col(c) for i, c in enumerate(docs.columns)}).select("text", *(f"__{i}" for i in range(len(docs.columns))))
    done = score(inner, fit(docs, labels)).where("predicted = 1")
    return done.select(*(F.col(f"__{i}").alias(c) for i, c in enumerate(docs.columns)))
