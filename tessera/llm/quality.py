"""Quality scores: random-indexing word vectors, pooled per document, into a small network.

Units. Every word of a text (cut at white space) stands for two units: its
lower-cased bytes, hashed into ``WORDS`` buckets, and its surface (classes of its
first and last characters, signs at its end, capitals, digits, length, whether it
repeats the word before), hashed into ``SURFACES`` buckets.

Word vectors. Each unit has a fixed sparse index vector of ``DIMS`` dimensions with
``ONES`` entries of +1 or -1 drawn by hash. A unit's word vector is the sum of the
index vectors of all units up to ``REACH`` words beside it, over every occurrence in
the whole corpus: an exact integer sum, so it does not depend on how the rows are
dealt. Tasks add up their own sums, blocks of units are summed in one shuffle, and
the table has a fixed size (``UNITS`` x ``DIMS``) whatever the corpus.

A document is pooled: the mean vector of its words' units, words and surfaces apart,
after taking the corpus mean away and scaling each vector to length 1.

Network. Two layers (tanh, then a logit), trained with Adam on labelled rows only, at
most about ``MAX_TRAIN`` of them (a hash of doc_id picks them); one task, at most
``MAX_TRAIN`` rows of 2 x ``DIMS`` numbers. A fifth of these rows is kept from the
training and sets a temperature: the logit is divided by the number that makes
the probabilities of those rows likeliest.

Defined cases: null and empty texts pool to zero; with no labels, or labels of one
kind only, the score is the (smoothed) share of good labels; of several labels of a
doc_id the lowest counts; null labels and labels without a document are ignored;
repeated rows get equal scores; a column named like the score is replaced; an empty
table gives no rows.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import words as W
from tessera.llm.shared import bounded_batches, table

WORDS, SURFACES = 1 << 13, 1 << 11
UNITS = WORDS + SURFACES
DIMS = 64
ONES = 4
REACH = 2
BLOCK = 256  # units summed as one row
CHUNK = 1 << 14  # words handled by one array operation
SCALE = 8192  # of the word vectors' fixed-point numbers
MAX_TRAIN = 20_000
HIDDEN = 32
EPOCHS = 30
BATCH = 64
RATE, DECAY = 3e-3, 1e-4
SEED = 13
THRESHOLD = 0.5
FOLDS, HELD_OUT = 3, 1

# classes of bytes: signs stand for themselves
CLASSES = np.arange(256, dtype=np.uint8)
CLASSES[[*range(0x61, 0x7B), *range(0x80, 0x100)]] = ord("a")
CLASSES[0x41:0x5B] = ord("A")
CLASSES[0x30:0x3A] = ord("0")


def index_vectors() -> np.ndarray:
    """The fixed sparse vector of every unit."""
    out = np.zeros((UNITS, DIMS), np.int8)
    unit = np.arange(UNITS, dtype=np.uint64)
    for j in range(ONES):
        h = W.mix64(unit * np.uint64(ONES) + np.uint64(j + 1))
        np.add.at(out, (unit.astype(np.int64), (h % np.uint64(DIMS)).astype(np.int64)),
                  np.where(h >> np.uint64(63), 1, -1))
    return out


class Units:
    """The two units of every word of a run of texts, and the text of each word."""

    def __init__(self, texts: pa.Array):
        words = W.split_words(texts, W.SPACES)
        codes, distinct = words.distinct()
        n = len(distinct)
        ends = np.cumsum(np.fromiter(map(len, distinct), np.int64, n))
        starts = np.r_[0, ends[:-1]].astype(np.int64) if n else ends
        data = np.frombuffer(b"".join(distinct), np.uint8)
        lower = W.span_hashes(W.ASCII_LOWER[data], starts, ends) % np.uint64(WORDS) if n else np.empty(0, np.uint64)
        kind = CLASSES[data]

        def at(place: np.ndarray, inside: np.ndarray) -> np.ndarray:
            return np.where(inside, kind[np.clip(place, 0, max(len(kind) - 1, 0))], 0).astype(np.uint64)

        key = np.minimum(ends - starts, 31).astype(np.uint64) // np.uint64(4)
        for place, inside in [(starts, starts < ends), (starts + 1, starts + 1 < ends), (ends - 1, ends - 1 > starts),
                              (ends - 2, ends - 2 > starts), (ends - 3, ends - 3 > starts)] if n else []:
            key = key * np.uint64(256) + at(place, inside)
        for letter in "aA0" if n else "":
            has = np.add.reduceat((kind == ord(letter)).astype(np.int64), starts) > 0
            key = key * np.uint64(2) + has.astype(np.uint64)
        self.text = words.text_of_word()
        self.n_texts = len(words.bounds) - 1
        again = np.zeros(len(codes), bool)
        again[1:] = (codes[1:] == codes[:-1]) & (self.text[1:] == self.text[:-1])
        surface = (W.mix64(key[codes] * np.uint64(2) + again.astype(np.uint64)) % np.uint64(SURFACES)).astype(np.int64)
        self.pair = np.stack([lower.astype(np.int64)[codes], WORDS + surface], axis=1)


def add_contexts(units: Units, index: np.ndarray, sums: np.ndarray) -> None:
    """Add the index vectors around each word to the rows of its units in ``sums`` (last column: occurrences)."""
    n = len(units.text)
    for lo in range(0, n, CHUNK):
        hi = min(lo + CHUNK, n)
        a, b = max(lo - REACH, 0), min(hi + REACH, n)
        own = index[units.pair[a:b, 0]] + index[units.pair[a:b, 1]]
        text = units.text[a:b]
        around = np.zeros_like(own)  # at most 2 REACH neighbours of two units with ONES entries each: fits a byte
        for k in range(1, REACH + 1):
            other = np.flatnonzero(text[k:] != text[:-k])
            for to, source in ((around[k:], own[:-k]), (around[:-k], own[k:])):
                if len(other):
                    source = source.copy()
                    source[other] = 0
                to += source
        around = around[lo - a:hi - a]
        for side in range(2):
            unit = units.pair[lo:hi, side]
            order = np.argsort(unit, kind="stable")
            first = np.flatnonzero(np.diff(unit[order], prepend=-1))
            sums[unit[order][first], :DIMS] += np.add.reduceat(around[order], first, axis=0, dtype=np.int32)
            sums[:, DIMS] += np.bincount(unit, minlength=UNITS)


def word_vectors(docs: DataFrame) -> np.ndarray:
    """(UNITS x DIMS + 1) sums over every word of every text; the last column counts the occurrences."""
    bounded_batches(docs.sparkSession)
    width = DIMS + 1

    def rows(sums: np.ndarray) -> pa.RecordBatch:
        some = [k for k in range(UNITS // BLOCK) if sums[k * BLOCK:(k + 1) * BLOCK].any()]
        return pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(
            [sums[k * BLOCK:(k + 1) * BLOCK].tobytes() for k in some], pa.binary())], names=["block", "sums"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, sums = index_vectors(), np.zeros((UNITS, width), np.int64)
        for batch in batches:
            for part in W.text_slices(batch):
                add_contexts(Units(part.column("text")), index, sums)
        yield rows(sums)

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((UNITS, width), np.int64)
        for batch in batches:
            for k, data in zip(batch.column("block").to_pylist(), batch.column("sums").to_pylist()):
                sums[k * BLOCK:(k + 1) * BLOCK] += np.frombuffer(data, np.int64).reshape(BLOCK, width)
        yield rows(sums)

    kind = "block int, sums binary"
    partial = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(count, kind)
    out = np.zeros((UNITS, width), np.int64)
    # one row a block: a table of fixed size
    for r in partial.repartition("block").mapInArrow(total, kind).collect():
        out[r["block"] * BLOCK:(r["block"] + 1) * BLOCK] += np.frombuffer(r["sums"], np.int64).reshape(BLOCK, width)
    return out


def directions(sums: np.ndarray) -> np.ndarray:
    """Word vectors around the corpus mean, of length 1, as fixed-point numbers whose sums are exact."""
    counts = np.maximum(sums[:, DIMS:], 1)
    mean = sums[:, :DIMS].sum(axis=0) / max(1, int(sums[:, DIMS].sum()))
    v = np.where(sums[:, DIMS:] > 0, sums[:, :DIMS] / counts - mean, 0)
    return np.rint(SCALE * v / np.maximum(np.sqrt((v ** 2).sum(axis=1, keepdims=True)), 1e-9)).astype(np.int16)


def pool(units: Units, vectors: np.ndarray) -> np.ndarray:
    """(texts x 2 DIMS): mean vectors of the word units and of the surface units of each text."""
    out = np.zeros((units.n_texts, 2 * DIMS), np.int64)
    n = len(units.text)
    for lo in range(0, n, CHUNK):
        text = units.text[lo:lo + CHUNK]
        first = np.flatnonzero(np.diff(text, prepend=-1))
        for side in range(2):
            sums = np.add.reduceat(vectors[units.pair[lo:lo + CHUNK, side]], first, axis=0, dtype=np.int32)
            out[text[first], side * DIMS:(side + 1) * DIMS] += sums
    return out / (SCALE * np.maximum(np.bincount(units.text, minlength=units.n_texts), 1.0))[:, None]


class Network:
    """logit((x - mean) / spread) / temperature, by two layers."""

    NAMES = ("mean", "spread", "w1", "b1", "w2", "b2", "temperature")

    def __init__(self, **arrays):
        self.a = {k: np.asarray(arrays[k], np.float64) for k in self.NAMES}

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez_compressed(out, **self.a)
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> Network:
        return cls(**np.load(io.BytesIO(data)))

    @classmethod
    def constant(cls, share: float) -> Network:
        return cls(mean=np.zeros(2 * DIMS), spread=np.ones(2 * DIMS), w1=np.zeros((2 * DIMS, HIDDEN)), b1=np.zeros(HIDDEN),
                   w2=np.zeros(HIDDEN), b2=np.log(share / (1 - share)), temperature=1.0)

    def logits(self, x: np.ndarray) -> np.ndarray:
        a = self.a
        return np.tanh((x - a["mean"]) / a["spread"] @ a["w1"] + a["b1"]) @ a["w2"] + a["b2"]

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.logits(x) / self.a["temperature"])


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def log_loss(z: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, z) - y * z))


def fit(x: np.ndarray, y: np.ndarray) -> Network:
    """Train on four fifths of the rows, calibrate the temperature on the others."""
    share = (y.sum() + 0.5) / (len(y) + 1)
    if len(y) == 0 or y.min() == y.max():
        return Network.constant(float(share))
    apart = np.arange(len(y)) % 5 == 4
    if len(np.unique(y[~apart])) < 2:
        apart[:] = False
    random = np.random.default_rng(SEED)
    train_x, train_y = x[~apart], y[~apart]
    mean, spread = train_x.mean(axis=0), train_x.std(axis=0) + 1e-3
    z = (train_x - mean) / spread
    p = [random.normal(0, 1 / np.sqrt(z.shape[1]), (z.shape[1], HIDDEN)), np.zeros(HIDDEN),
         random.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.array(np.log(share / (1 - share)))]
    first, second = [np.zeros_like(v) for v in p], [np.zeros_like(v) for v in p]
    step = 0
    for _ in range(EPOCHS):
        order = random.permutation(len(train_y))
        for lo in range(0, len(order), BATCH):
            pick = order[lo:lo + BATCH]
            hidden = np.tanh(z[pick] @ p[0] + p[1])
            err = (sigmoid(hidden @ p[2] + p[3]) - train_y[pick]) / len(pick)
            back = err[:, None] * p[2] * (1 - hidden ** 2)
            grads = [z[pick].T @ back + DECAY * p[0], back.sum(axis=0), hidden.T @ err + DECAY * p[2], err.sum()]
            step += 1
            for i, g in enumerate(grads):
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g * g
                p[i] = p[i] - RATE * (first[i] / (1 - 0.9 ** step)) / (np.sqrt(second[i] / (1 - 0.999 ** step)) + 1e-8)
    net = Network(mean=mean, spread=spread, w1=p[0], b1=p[1], w2=p[2], b2=p[3], temperature=1.0)
    if apart.any() and len(np.unique(y[apart])) == 2:
        # the loss is convex in 1 / temperature: narrow down between 1/20 and 20
        raw, low, high = net.logits(x[apart]), np.log(1 / 20), np.log(20)
        for _ in range(40):
            a, b = low + (high - low) / 3, high - (high - low) / 3
            low, high = (low, b) if log_loss(raw * np.exp(a), y[apart]) < log_loss(raw * np.exp(b), y[apart]) else (a, high)
        net.a["temperature"] = np.asarray(np.exp(-(low + high) / 2))
    return net


def held_out(doc_id: str = "doc_id"):
    """True for the rows that no training may read: crc32(doc_id as text) mod 3 is 1."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, vectors: np.ndarray, max_train: int = MAX_TRAIN) -> Network:
    """Fit on the labelled documents outside the held-out fold, at most about ``max_train`` of them."""
    bounded_batches(docs.sparkSession)
    known = (labels.where("quality is not null and doc_id is not null").where(~held_out())
             .groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality")))
    n = known.count()
    if n > max_train:
        draw = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 30))
        known = known.where(draw < F.lit(int((1 << 30) * max_train / n)))
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(known, "doc_id")

    def pooled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.text_slices(batch):
                x = pool(Units(part.column("text")), vectors)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("quality"), pa.array(
                    list(x), pa.list_(pa.float64()))], names=["doc_id", "quality", "x"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x, y = [np.empty((0, 2 * DIMS))], [np.empty(0)]
        for batch in batches:
            x.append(batch.column("x").flatten().to_numpy().reshape(-1, 2 * DIMS))
            y.append(batch.column("quality").to_numpy().astype(np.float64))
        yield pa.RecordBatch.from_arrays([pa.array([fit(np.concatenate(x), np.concatenate(y)).dump()], pa.binary())],
                                         names=["model"])

    # one bounded task; its order does not depend on how the rows were dealt
    sample = (rows.mapInArrow(pooled, "doc_id long, quality int, x array<double>").repartition(1)
              .sortWithinPartitions("doc_id", F.hash("x")))
    found = sample.mapInArrow(learn, "model binary").collect()
    return Network.load(bytes(found[0]["model"])) if found else fit(np.empty((0, 2 * DIMS)), np.empty(0))


def score(docs: DataFrame, vectors: np.ndarray, network: Network, column: str = "score") -> DataFrame:
    """``docs`` with one more column, the calibrated probability that the whole text is of good quality."""
    bounded_batches(docs.sparkSession)
    data = network.dump()
    out = docs.withColumn("text", F.col("text").cast("string")).withColumn(column, F.lit(None).cast("double"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Network.load(data)
        for batch in batches:
            for part in W.text_slices(batch):
                cols = part.columns
                cols[part.schema.get_field_index(column)] = pa.array(own.score(pool(Units(part.column("text")), vectors)))
                yield pa.RecordBatch.from_arrays(cols, schema=part.schema)

    return out.mapInArrow(work, out.schema)


def op13_quality_random_indexing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    vectors = directions(word_vectors(docs))
    network = train(docs, table(spark, sf_dir, "labels"), vectors)
    return score(docs, vectors, network).select("doc_id", held_out().alias("held_out"), "score",
                                                (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
