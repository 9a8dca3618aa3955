"""Language-model scores: causal self-attention over subword ids, beside a counted word baseline.

Words are lower-cased (A-Z) runs without white space; every word is written as a space and its
bytes, in ids of a byte-level vocabulary, and one end id closes the text.  An id is a symbol of
its own if it is among the HEAD_IDS most frequent of the training text, else one of the TAIL
bins.  Symbols belong to CLASSES classes of like neighbours, of which each lies wholly inside
words or wholly at their beginning.  The attention model gives the class of the next symbol;
the id within its class comes from counts after the last symbol.  So

    P(id) = P(class | all ids before, by attention) * P(id | class, last symbol)

which sums to 1 over ids, and the chance that a word ends is a sum over classes.  That makes
a probability of whole words, which is mixed with the unigram of all counted words; the weight is
tuned on training text.  Workers hold the counts of the HEAD_WORDS most frequent words, those of
the others come by a join.

Texts are encoded once: later passes read the written ids, which also spell the words.

All counts cover every training document, and so do the attention weights and the weight of the
unigram.  Each training document belongs to one of ROUNDS rounds and, by its hash, to a group of about
GROUP_WORDS words: in a round each group trains on its own, in the order of hashes, then weights are averaged.  So equal
tables give equal scores, whatever the partitions.  One pass scores all documents, for every weight of the
unigram; the training rows choose among these.  What the driver holds is of fixed size.

Null texts are empty: only the end.  Rows without a doc_id are scored, not learned from, and
their held_out is null.  Equal rows get equal scores; other columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicflow.llm import attention, bytebpe, units, words
from topicflow.llm.common import SLICE_BYTES, Scratch, runs, ship, slices, texts

HEAD_WORDS = 100_000  # 16 bytes each on every worker; the counts of all others are joined
HEAD_IDS = 1024
TAIL = 64
CLASSES = 64
ROUNDS = 2
GROUP_WORDS = 500_000  # about so many words of training text in a group that trains on its own
_STEP_BYTES = SLICE_BYTES // 2  # of ids that one step works on
_FACTORS = 64  # 0.05 to this power is far above the smallest number
_END = 0  # the hash that stands for the end of a text
_GRID = np.linspace(0.05, 0.95, 19)


def held_out(doc_id: str) -> Column:
    return F.crc32(F.col(doc_id).cast("string")) % 10 == 0


def _lowered(part: pa.Array) -> tuple[words.Words, words.Words]:
    """The words of a slice, and the same words with a space before each as pieces for the encoder."""
    own = words.split(part, words.NOT_SPACE, lower=True)
    size = own.end - own.start + 1
    ends = np.cumsum(size)
    data = np.zeros(int(ends[-1]) + 8 if len(ends) else 8, np.uint8)
    # One byte before each word comes along and becomes the space; for the first word of all it wraps around.
    data[:len(data) - 8] = own.data[words.ragged(own.start - 1, size)]
    data[ends - size] = 0x20
    return own, words.Words(data, np.empty(0, np.int64), ends - size, ends, own.first)


def _word_counts(docs: DataFrame) -> DataFrame:
    """word (hash) and n, summed up in each task."""

    def run(batches):
        parts, waiting = [(np.empty(0, np.uint64), np.empty(0, np.int64))], 0
        for batch in batches:
            for _, part in slices(texts(batch.column("text"))):
                own = words.split(part, words.NOT_SPACE, lower=True)
                parts += [np.unique(own.hashes(), return_counts=True), (np.array([_END], np.uint64), np.array([len(part)]))]
                waiting += len(parts[-2][0])
                if waiting > 1_000_000:
                    parts, waiting = [_merged(parts)], 0
                    if len(parts[0][0]) > 2_000_000:
                        yield _counts(*parts[0])
                        parts = [(parts[0][0][:0], parts[0][1][:0])]
        yield _counts(*_merged(parts))

    return docs.select("text").mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _counts(keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts)], ["word", "n"])


def _encoded(docs: DataFrame, source, end_id: int) -> DataFrame:
    """Of every row doc_id, key, held_out, the bytes of its text, and its `_sequences` as little-endian whole numbers."""
    kind = _id_kind(end_id)
    rows = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("key"), held_out("doc_id").alias("held_out"), "text")

    def run(batches):
        encoder = units.encoder(source.value, units.spaced_words)
        for batch in batches:
            for row, part in slices(texts(batch.column("text"))):
                ids, _, first = _sequences(part, encoder, end_id)
                at = pa.py_buffer((first * kind.itemsize).astype(np.int32))
                yield pa.RecordBatch.from_arrays([
                    *(batch.column(name).slice(row, len(part)) for name in ("doc_id", "key", "held_out")), pc.binary_length(part).cast(pa.int64()),
                    pa.Array.from_buffers(pa.binary(), len(part), [None, at, pa.py_buffer(ids.astype(kind))]),
                ], ["doc_id", "key", "held_out", "size", "ids"])

    return rows.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, key long, held_out boolean, size long, ids binary")


def _id_kind(end_id: int) -> np.dtype:
    return np.dtype("<u2" if end_id < 1 << 16 else "<u4")


def _stored(part: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids of rows of `_encoded` (64-bit offsets), and where each row begins."""
    kind = _id_kind(end_id)
    offsets = np.frombuffer(part.buffers()[1], np.int64, len(part) + 1, part.offset * 8)
    first = (offsets - offsets[0]) // kind.itemsize
    return np.frombuffer(part.buffers()[2], kind, int(first[-1]), int(offsets[0])).astype(np.int64), first


def _id_slices(batch: pa.RecordBatch, end_id: int):
    """Rows of `_encoded` in steps: (first row, ids, where each row begins)."""
    for row, part in slices(batch.column("ids").cast(pa.large_binary()), _STEP_BYTES):
        yield row, *_stored(part, end_id)


def _id_pairs(rows: DataFrame, end_id: int) -> DataFrame:
    """How often an id follows another in rows of `_encoded`."""

    def run(batches):
        parts, waiting = [], 0
        for batch in batches:
            for _, ids, first in _id_slices(batch, end_id):
                inside = np.ones(len(ids) - 1, bool)
                inside[first[1:-1] - 1] = False
                parts.append(np.unique((ids[:-1] << 20 | ids[1:])[inside], return_counts=True))
                waiting += len(parts[-1][0])
                if waiting > 2_000_000:
                    distinct, counts = _merged(parts)
                    parts, waiting = [(distinct, counts)], 0
                    if len(distinct) > 2_000_000:
                        yield _counts(distinct, counts)
                        parts = []
        if parts:
            yield _counts(*_merged(parts))

    return rows.select("ids").mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Keys with their counts, summed up."""
    keys, counts = (np.concatenate(x) for x in zip(*parts))
    distinct, which = np.unique(keys, return_inverse=True)
    return distinct, np.bincount(which, counts, len(distinct)).astype(np.int64)


def _sequences(part: pa.Array, encoder, end_id: int):
    """Ids of all rows, each with the end id before and after; ids of each word; where each row begins."""
    own, spaced = _lowered(part)
    ids, counts = encoder.pieces(spaced)
    sums = np.concatenate([[0], np.cumsum(counts)])
    row = sums[own.first]  # first id of each row, without ends
    ends = np.arange(len(part))
    out = np.full(len(ids) + 2 * len(part), end_id, np.int64)
    at = np.repeat(ends * 2 + 1, np.diff(row)) + np.arange(len(ids))
    out[at] = ids
    return out, (own, counts, sums), np.append(row[:-1] + 2 * ends, len(out))


@dataclass
class Model:
    symbol: np.ndarray  # of each id
    of_class: np.ndarray  # of each symbol
    skip: np.ndarray  # log P(class | last symbol)
    inner: np.ndarray  # log P(symbol | class, last symbol)
    rest: np.ndarray  # log P(id | symbol)
    embedding: np.ndarray
    weights: dict
    head: np.ndarray  # hashes of the most frequent words, sorted
    unigram: np.ndarray  # log P of each
    end_unigram: float
    mass: float = 1.0  # occurrences of all these words, the end among them
    weight: float = 0.5
    spelling: bytebpe.ByteTable | None = None
    _tables: tuple | None = None
    _place: words.Sorted | None = None

    def log_probabilities(self, ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Natural log P of the id after each place, and of a word's end there (rows as of `_sequences`;
        the last place of a row means nothing)."""
        x = self.symbol[ids]
        begin, scored = _windows(first)
        chance, opens = np.zeros(len(x)), np.zeros(len(x))
        stop = np.repeat(first[1:] - 1, _many(np.diff(first) - 1))
        padded = np.concatenate([x, np.zeros(attention.CONTEXT + 1, x.dtype)])
        tables = self.tables()
        # The first half of the classes are those that begin words.
        halves = np.repeat(np.eye(2, dtype=np.float32), CLASSES // 2, axis=0)
        # A row's first window scores all its places, the others what no earlier one has scored.
        for skipped in (0, attention.OVERLAP):
            own = np.flatnonzero(scored == skipped)
            for lo in range(0, len(own), attention.AT_ONCE):
                start = begin[own[lo:lo + attention.AT_ONCE], None]
                logits = tables.logits(padded[start + np.arange(attention.CONTEXT)], skipped)
                at = start + np.arange(skipped, attention.CONTEXT)
                use = np.flatnonzero(at < stop[own[lo:lo + attention.AT_ONCE], None])
                here = at.ravel()[use]
                wanted = logits.ravel().take(use * CLASSES + self.of_class[x[here + 1]])
                np.exp(logits, out=logits)
                sums = (logits @ halves).reshape(-1, 2)[use]
                total = np.log(sums[:, 0] + sums[:, 1])
                chance[here] = wanted - total
                opens[here] = np.log(sums[:, 0]) - total
        inside = np.ones(len(x), bool)
        inside[first[1:] - 1] = False
        here = np.flatnonzero(inside)
        chance[here] += self.inner[x[here], x[here + 1]] + self.rest[ids[here + 1]]
        return chance, opens

    def tokens(self, ids: np.ndarray, first: np.ndarray):
        """For each row's words and its end, one after another: their rows, hashes, natural log P by ids and by the unigram;
        and log P by ids of the rows' ends (rows as of `_sequences`)."""
        chance, opens = self.log_probabilities(ids, first)
        total = np.concatenate([[0], np.cumsum(chance)])
        end = np.zeros(len(ids), bool)
        end[first[:-1]] = end[first[1:] - 1] = True
        begin, hashes = self._words(ids, ~end)
        rows = np.searchsorted(first, begin, side="right") - 1
        # The place after each word's last id: the next word's first, or the row's end.
        stop = np.append(begin[1:], 0)[:len(begin)]
        last = np.flatnonzero(np.append(np.diff(rows) > 0, True)) if len(rows) else rows
        stop[last] = first[rows[last] + 1] - 1
        by_ids = total[stop - 1] - total[begin - 1] - opens[begin - 1] + opens[stop - 1]
        by_ids_end = chance[first[1:] - 2] - opens[first[1:] - 2]
        if self._place is None:
            self._place = words.Sorted(self.head)
        place = self._place.find(hashes)
        by_word = np.append(self.unigram, -np.inf)[place]
        return rows, hashes, by_ids, by_word, by_ids_end

    def _words(self, ids: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where words begin, and their hashes: ids spell each word with the space before it, and no other."""
        spelling, at = self.spelling, np.flatnonzero(inside)
        own = ids[at]
        data = np.concatenate([spelling.decode(own), np.zeros(8, np.uint8)])
        begin = np.cumsum(spelling.length[own]) - spelling.length[own]
        opening = np.flatnonzero(data[begin] == 0x20)
        start = begin[opening]
        return at[opening], words.span_hashes(data, start + 1, np.append(start[1:], len(data) - 8)[:len(start)])

    def tables(self) -> attention.Tables:
        """Made once in each worker: they are not sent with the model."""
        if self._tables is None or self._tables[0] is not self.weights:
            self._tables = (self.weights, attention.Tables(self.weights, self.embedding, self.skip))
        return self._tables[1]

    def __getstate__(self):
        return {**self.__dict__, "_tables": None, "_place": None}


def _on_grid(by_ids: np.ndarray, by_word: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Of every row (of n) the sum of its words' log P, for each weight of the unigram; the rows are in order."""
    more = np.minimum(by_word - by_ids, 700)
    less = np.exp(-np.abs(more))
    # The greater of both terms is taken out, so a factor is 0.05 to 1, and a product of some of them needs one logarithm.
    word, rest = np.where(more > 0, 1, less), np.where(more > 0, less, 1)
    place = np.arange(len(rows)) - np.searchsorted(rows, np.arange(n))[rows]
    begin = np.flatnonzero(place % _FACTORS == 0)
    out = np.repeat(np.bincount(rows, by_ids + np.maximum(more, 0), n)[:, None], len(_GRID), axis=1)
    if len(begin):
        word -= rest
        for k, w in enumerate(_GRID):
            out[:, k] += np.bincount(rows[begin], np.log(np.multiply.reduceat(w * word + rest, begin)), n)
    return out


def _many(lengths: np.ndarray) -> np.ndarray:
    step = attention.CONTEXT - attention.OVERLAP
    return np.where(lengths > 0, 1 + -(-np.maximum(0, lengths - attention.CONTEXT) // step), 0)


def _windows(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """`attention.windows` over rows that all have one more place, the last, which predicts nothing."""
    begin, scored = attention.windows(np.diff(first) - 1)
    return begin + np.repeat(np.arange(len(first) - 1), _many(np.diff(first) - 1)), scored


def _groups(vectors: np.ndarray, weight: np.ndarray, k: int) -> np.ndarray:
    """k-means, begun from points spread over the order of the first coordinate."""
    k = min(k, len(vectors))
    centres = vectors[np.argsort(vectors[:, 0], kind="stable")[np.linspace(0, len(vectors) - 1, k).astype(int)]]
    for _ in range(20):
        near = ((vectors ** 2).sum(1)[:, None] - 2 * vectors @ centres.T + (centres ** 2).sum(1)).argmin(1)
        for c in range(k):
            if (near == c).any():
                centres[c] = np.average(vectors[near == c], axis=0, weights=weight[near == c])
    return near


def _layout(ids: np.ndarray, n: np.ndarray, vocabulary: int, opens: np.ndarray, end_id: int) -> np.ndarray:
    """The symbol of each id: frequent ones their own, the others in bins of like frequency, opening ones apart."""
    count = np.bincount(ids, n, vocabulary).astype(float)
    count[end_id] = np.inf
    order = np.argsort(-count, kind="stable")
    symbol = np.empty(vocabulary, np.int64)
    symbol[order[:HEAD_IDS]] = np.arange(HEAD_IDS)
    rest = order[HEAD_IDS:]
    for half, kind in enumerate((True, False)):
        own = rest[opens[rest] == kind]
        mass = np.cumsum(count[own] + 0.1)
        symbol[own] = HEAD_IDS + half * TAIL // 2 + np.minimum((mass / mass[-1] * (TAIL // 2)).astype(int), TAIL // 2 - 1)
    return symbol


def _trained(docs: DataFrame, ranks_path: str, pattern: str, folder: Scratch) -> tuple[Model, DataFrame, dict, DataFrame]:
    """The model without the weight of the unigram; the word counts, totals and `_encoded` rows of all documents."""
    spark = docs.sparkSession
    ship(spark)
    counts = folder.save("words", _word_counts(docs.where(~held_out("doc_id"))))
    total, distinct = counts.agg(F.sum("n"), F.count(F.lit(1))).first()
    head = counts.orderBy(F.desc("n"), "word").limit(HEAD_WORDS).collect()
    ends = counts.where(F.col("word") == _END).first()

    text = bytebpe.tokenizer_json(bytebpe.read_ranks(ranks_path), pattern)
    table = bytebpe.ByteTable(text)
    end_id, vocabulary = len(table.length), len(table.length) + 1
    source = spark.sparkContext.broadcast(text)
    opens = np.append(table.bytes[table.begin] == 0x20, True)
    encoded = folder.save("ids", _encoded(docs, source, end_id), "zstd")
    training = encoded.where(~F.col("held_out"))
    pairs = folder.save("pairs", _id_pairs(training, end_id))
    after = F.col("word").bitwiseAND((1 << 20) - 1)
    # At most one row for each id.
    seen = pairs.groupBy(after.alias("id")).agg(F.sum("n").alias("n")).collect()
    ids, n = np.array([r.id for r in seen], np.int64), np.array([r.n for r in seen], np.float64)
    symbol = _layout(ids, n, vocabulary, opens, end_id)
    # Pairs of symbols: a table of fixed size.
    known = spark.createDataFrame([(int(i), int(s)) for i, s in enumerate(symbol)], "id long, symbol long")
    before = F.shiftright("word", 20)
    grid = (pairs.select(before.alias("a"), after.alias("b"), "n").join(F.broadcast(known.toDF("a", "x")), "a").join(F.broadcast(known.toDF("b", "y")), "b")
            .groupBy("x", "y").agg(F.sum("n").alias("n")).collect())
    size = HEAD_IDS + TAIL
    m = np.zeros((size, size))
    for r in grid:
        m[r.x, r.y] = r.n
    model = _counted(m, np.bincount(ids, n, vocabulary), symbol, opens, end_id)
    model.spelling = table
    in_head = [r for r in head if r.word != _END]
    mass = int(total or 0)
    keys = np.array([r.word for r in in_head], np.int64).view(np.uint64)
    order = np.argsort(keys)
    model.head = keys[order]
    model.mass = float(max(1, mass))
    model.unigram = np.log(np.array([r.n for r in in_head], float)[order] / model.mass)
    model.end_unigram = math.log(ends.n / mass) if ends else -math.inf
    totals = {"tokens": mass, "distinct": int(distinct), "ends": int(ends.n) if ends else 0, "source": source, "end_id": end_id}
    groups = max(1, math.ceil(mass / GROUP_WORDS / ROUNDS))
    for turn in range(ROUNDS):
        part = training.where(F.pmod(F.shiftright(F.xxhash64("doc_id"), 32), F.lit(ROUNDS)) == turn)
        model.weights = _averaged(part, groups, spark.sparkContext.broadcast(model), end_id) or model.weights
    folder.drop("pairs")
    return model, counts, totals, encoded


def fit(docs: DataFrame, ranks_path: str, pattern: str, folder: Scratch) -> tuple[Model, DataFrame, dict]:
    """Learn from documents that are not held out: the model, the word counts, and totals N and V."""
    model, counts, totals, encoded = _trained(docs.where(~held_out("doc_id")), ranks_path, pattern, folder)
    rows = folder.save("tuning", _forward(encoded, model, totals))
    folder.drop("ids")
    rare = folder.save("rare", _rare(rows, counts))
    model.weight = float(_GRID[_best(rows, rare, model.mass)])
    folder.drop("tuning", "rare")
    return model, counts, totals


def score(docs: DataFrame, model: Model, counts: DataFrame, totals: dict, folder: Scratch) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, in log10."""
    ship(docs.sparkSession)
    rows = folder.save("scored", _forward(_encoded(docs, totals["source"], totals["end_id"]), model, totals))
    return _finished(rows, _rare(rows, counts), totals, model.mass, int(np.argmin(np.abs(_GRID - model.weight))))


def fit_score(docs: DataFrame, ranks_path: str, pattern: str, folder: Scratch) -> DataFrame:
    """`fit`, then `score` of the same documents: encoded once, and the weight is tuned on what the one scoring pass gives."""
    model, counts, totals, encoded = _trained(docs, ranks_path, pattern, folder)
    rows = folder.save("scored", _forward(encoded, model, totals))
    folder.drop("ids")
    rare = folder.save("rare", _rare(rows, counts))
    return _finished(rows, rare, totals, model.mass, _best(rows, rare, model.mass))


def _counted(m: np.ndarray, count: np.ndarray, symbol: np.ndarray, opens: np.ndarray, end_id: int) -> Model:
    size = len(m)
    unigram = (m.sum(axis=0) + 0.1) / (m.sum() + 0.1 * size)
    follows = (m + 20 * unigram) / (m.sum(axis=1, keepdims=True) + 20)
    # Symbols with like neighbours on both sides.
    lift = np.log(follows / unigram)
    u, s, v = np.linalg.svd(lift, full_matrices=False)
    vectors = np.concatenate([u, v.T], axis=1)[:, np.r_[:attention.WIDTH // 2, size:size + attention.WIDTH // 2]]
    vectors = vectors * np.tile(np.sqrt(s[:attention.WIDTH // 2]), 2)
    embedding = (vectors / (np.abs(vectors).mean() + 1e-9)).astype(np.float32)
    starts = np.zeros(size, bool)
    starts[symbol[opens]] = True
    of_class = np.empty(size, np.int64)
    for half, kind in enumerate((True, False)):
        own = np.flatnonzero(starts == kind)
        of_class[own] = half * CLASSES // 2 + _groups(embedding[own].astype(float), unigram[own], CLASSES // 2)
    member = np.zeros((size, CLASSES))
    member[np.arange(size), of_class] = 1
    by_class = follows @ member
    inside = np.bincount(symbol, minlength=size)
    of_symbol = np.bincount(symbol, count, size)
    rest = np.log((count + 0.1) / (of_symbol + 0.1 * inside)[symbol])
    return Model(symbol, of_class, np.log(np.maximum(by_class, 1e-30)).astype(np.float32), np.log(follows / by_class[:, of_class]).astype(np.float32), rest,
                 embedding, attention.initial(CLASSES), np.empty(0, np.uint64), np.empty(0), -math.inf)


def _averaged(rows: DataFrame, groups: int, model, end_id: int) -> dict | None:
    """Train on groups of documents, each from the same weights; the mean, weighted by windows.

    A document's group and its place there follow from its hash, and the mean is a sum of whole
    numbers: the outcome does not depend on partitions, batches or the order of tasks.
    """
    shapes = {n: w.shape for n, w in model.value.weights.items()}

    def train(table: pa.Table) -> pa.Table:
        table = table.sort_by([("key", "ascending"), ("doc_id", "ascending")])
        own = model.value
        weights, seen = own.weights, 0
        rows = table.column("ids").combine_chunks().cast(pa.large_binary())
        for row, stop in runs(np.concatenate([[0], np.cumsum(table.column("size"))])):
            ids, first = _stored(rows.slice(row, stop - row), end_id)
            x = own.symbol[ids]
            begin, scored = _windows(first)
            stop = np.repeat(first[1:] - 1, _many(np.diff(first) - 1))
            at = begin[:, None] + np.arange(attention.CONTEXT)
            padded = np.concatenate([x, np.zeros(attention.CONTEXT + 1, x.dtype)])
            targets = np.where((at < stop[:, None]) & (np.arange(attention.CONTEXT) >= scored[:, None]), own.of_class[padded[at + 1]], -1)
            mixed = np.random.RandomState(len(at)).permutation(len(at))
            weights = attention.train(weights, own.embedding, own.skip, padded[at][mixed], targets[mixed])
            seen += len(at)
        flat = np.concatenate([w.ravel() for w in weights.values()]).astype(np.float64)
        return pa.table({"n": [seen], "sums": [(np.rint(flat * 2 ** 24).astype(np.int64) * seen).tolist()]}, schema=pa.schema([("n", pa.int64()), ("sums", pa.list_(pa.int64()))]))

    rows = rows.select(F.pmod(F.xxhash64("key"), F.lit(groups)).alias("group"), "key", "doc_id", "size", "ids")
    done = rows.groupBy("group").applyInArrow(train, "n long, sums array<long>")
    whole = "decimal(38,0)"
    sums = done.select(F.col("n").cast(whole).alias("n"), F.posexplode("sums").alias("place", "value")).groupBy("place").agg(
        F.sum(F.col("value").cast(whole)).alias("value"), F.sum("n").alias("n")).collect()
    if not sums:
        return None
    flat = np.zeros(len(sums))
    for r in sums:
        flat[r.place] = int(r.value) / int(r.n) / 2 ** 24
    out, at = {}, 0
    for name, shape in shapes.items():
        out[name] = flat[at:at + math.prod(shape)].reshape(shape).astype(np.float32)
        at += math.prod(shape)
    return out


def _forward(encoded: DataFrame, model: Model, totals: dict) -> DataFrame:
    """The scoring pass over `_encoded` rows.  Of every row: counts, the sum of the base's logs, and for each weight of the unigram
    the natural log P of its end and of its words that workers hold; `tune` is the same as if the row had not been
    counted, for rows that were.  `words` and `by_ids` are the other words, whose counts are to be joined."""
    end_id = totals["end_id"]
    shared = encoded.sparkSession.sparkContext.broadcast(model)
    known_end = int(totals["ends"] > 0)
    log_end = math.log10(totals["ends"] + 0.1) if known_end else 0.0

    def run(batches):
        own_model = shared.value
        for batch in batches:
            for row, ids, first in _id_slices(batch, end_id):
                rows, hashes, by_ids, by_word, by_ids_end = own_model.tokens(ids, first)
                n = len(first) - 1
                head = np.isfinite(by_word)
                seen = np.rint(np.exp(by_word[head]) * own_model.mass)
                at_end, end = np.arange(n), np.full(n, own_model.end_unigram)
                ended = _on_grid(by_ids_end, end, at_end, n)
                scores = _on_grid(by_ids[head], by_word[head], rows[head], n) + ended
                with np.errstate(divide="ignore"):
                    less = np.log(np.maximum(seen - 1, 0) / own_model.mass)
                tune = _on_grid(by_ids[head], less, rows[head], n) + ended
                at = pa.array(np.concatenate([[0], np.cumsum(np.bincount(rows[~head], minlength=n))]), pa.int32())
                rest = [pa.ListArray.from_arrays(at, pa.array(x[~head])) for x in (hashes.view(np.int64), by_ids)]
                grid = pa.array(np.arange(n + 1) * len(_GRID), pa.int32())
                yield pa.RecordBatch.from_arrays([
                    *(batch.column(name).slice(row, n) for name in ("doc_id", "key", "held_out")), pa.array(np.bincount(rows, minlength=n) + 1),
                    pa.array(np.bincount(rows[head], minlength=n) + known_end), pa.array(np.bincount(rows[head], np.log10(seen + 0.1), n) + log_end),
                    *(pa.ListArray.from_arrays(grid, pa.array(x.ravel())) for x in (scores, tune)), *rest,
                ], ["doc_id", "key", "held_out", "n_tokens", "known", "logs", "scores", "tune", "words", "by_ids"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.mapInArrow(run, f"doc_id {kind}, key long, held_out boolean, n_tokens long, known long, logs double, "
                                   "scores array<double>, tune array<double>, words array<long>, by_ids array<double>")


def _mixed(by_ids: Column, n: Column, mass: float, weight: float) -> Column:
    """log P of a word whose count has been joined; n is null or 0 without any."""
    a, b = math.log(weight) + F.log(n / mass), math.log(1 - weight) + by_ids
    return F.when(n > 0, F.greatest(a, b) + F.log1p(F.exp(-F.abs(a - b)))).otherwise(b)


def _rare(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """The words that workers do not hold, with their counts: key, held_out, by_ids and n, rows of a key together."""
    rest = rows.select("key", "held_out", F.explode(F.arrays_zip("words", "by_ids")).alias("rest"))
    rest = rest.select("key", "held_out", F.col("rest.words").alias("word"), F.col("rest.by_ids").alias("by_ids"))
    return rest.join(counts, "word", "left").drop("word").repartition("key").sortWithinPartitions("key")


def _best(rows: DataFrame, rare: DataFrame, mass: float) -> int:
    """Which weight of the unigram makes the training rows likeliest."""
    training = ~F.col("held_out")
    head = rows.where(training).agg(*(F.sum(F.col("tune")[k]) for k in range(len(_GRID)))).first()
    rest = rare.where(training).agg(*(F.sum(_mixed(F.col("by_ids"), F.col("n") - 1, mass, float(w))) for w in _GRID)).first()
    totals = [(x or 0.0) + (y or 0.0) for x, y in zip(head, rest)]
    return int(np.argmax(totals)) if any(totals) else len(_GRID) // 2


def _finished(scored: DataFrame, rare: DataFrame, totals: dict, mass: float, best: int) -> DataFrame:
    base = math.log10(totals["tokens"] + 0.1 * (totals["distinct"] + 1))
    rare = rare.groupBy("key").agg(
        F.count("n").alias("rare_known"), F.sum(F.log10(F.col("n") + 0.1)).alias("rare_logs"),
        F.sum(_mixed(F.col("by_ids"), F.col("n"), mass, float(_GRID[best]))).alias("rare_score"))
    # Rows that are repeated have been summed up together.
    copies = scored.groupBy("key").agg(F.count(F.lit(1)).alias("copies")).join(rare, "key", "left")
    unknown = math.log10(0.1)
    n_known = F.col("known") + F.coalesce((F.col("rare_known") / F.col("copies")).cast("long"), F.lit(0))
    logs = F.col("logs") + F.coalesce(F.col("rare_logs") / F.col("copies"), F.lit(0.0))
    return scored.join(copies, "key").select(
        "doc_id", "held_out", "n_tokens", n_known.alias("n_known"), F.lit(totals["tokens"]).cast("long").alias("train_tokens"),
        (logs + (F.col("n_tokens") - n_known) * unknown - F.col("n_tokens") * base).alias("base_score"),
        ((F.col("scores")[best] + F.coalesce(F.col("rare_score") / F.col("copies"), F.lit(0.0))) / math.log(10)).alias("score"))
