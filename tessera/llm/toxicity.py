"""Toxicity scores: a factorization machine over hashed terms.

Terms. A text is lower-cased (A-Z) and cut into words of letters and digits;
each distinct word of a text gives the word itself and its beginnings of 4, 5
and 6 bytes, hashed into 2^18 buckets. Beginnings carry over to inflected and
compound forms that training has not seen.

Model. score = sigmoid(b + sum w_i + sum over pairs <v_i, v_j>): besides a
weight, each term has a factor vector, so a pair of terms (an insult and whom it
addresses) can weigh more than its parts. Pair terms are summed through
((sum v)^2 - sum v^2) / 2, hence in one pass.

Training reads labelled rows only, at most about ``MAX_TRAIN`` of them (a
hash of doc_id picks them, whatever the input's size), in one task, in an order
fixed by doc_id; the result is one row of bounded size. Terms in fewer than
``MIN_DOCS`` training texts carry nothing. Scoring is a map over all whole
texts.

Defined cases: null and empty texts have no terms and score sigmoid(b); with no
labels, or labels of one kind only, the score is the (smoothed) share of toxic
labels; several labels of a doc_id count as toxic if any is; null labels and
labels without a document are ignored; repeated rows get equal scores.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import words as W
from tessera.llm.shared import bounded_batches, spare_name, table

BUCKET_BITS = 18
PREFIXES = (4, 5, 6)
FACTORS = 8
MAX_TRAIN = 20_000
MIN_DOCS = 3
EPOCHS = 5
BATCH = 32
RATE, FACTOR_RATE = 0.3, 0.02
LASSO, RIDGE = 0.5, 1.0  # the first in units of the noise of a label sum, sqrt(n p (1 - p))
SEED = 7
THRESHOLD = 0.7
FOLDS, HELD_OUT = 3, 1


class Terms:
    """Terms of a run of texts: buckets of each distinct word, and the distinct words of each text."""

    def __init__(self, texts: pa.Array):
        words = W.split_words(texts, W.NOT_ALNUM, lower=True)
        codes, distinct = words.distinct()
        n = len(distinct)
        ends = np.cumsum(np.fromiter(map(len, distinct), np.int64, n))
        starts = np.r_[0, ends[:-1]].astype(np.int64) if n else np.empty(0, np.int64)
        data = np.frombuffer(b"".join(distinct), np.uint8)
        shift = np.uint64(64 - BUCKET_BITS)
        cols = [W.span_hashes(data, starts, ends, 0) >> shift]
        cols += [W.span_hashes(data, starts, np.minimum(starts + k, ends), 1) >> shift for k in PREFIXES]
        self.buckets = np.stack(cols, axis=1).astype(np.int64) if n else np.empty((0, 1 + len(PREFIXES)), np.int64)
        # a word no longer than a prefix length repeats that prefix: keep its first
        sizes = ends - starts
        self.used = np.ones(self.buckets.shape, bool)
        for j, k in enumerate(PREFIXES[1:], start=2):
            self.used[:, j] = sizes > PREFIXES[j - 2]
        key = np.unique(words.text_of_word() * max(n, 1) + codes)
        self.text, self.word = key // max(n, 1), key % max(n, 1)
        self.n_texts = len(words.bounds) - 1


class Model:
    """b, w (buckets) and v (buckets x factors)."""

    def __init__(self, b: float, w: np.ndarray, v: np.ndarray):
        self.b, self.w, self.v = float(b), w, v

    def dump(self) -> bytes:
        out = io.BytesIO()
        at = np.flatnonzero((self.w != 0) | self.v.any(axis=1))
        np.savez_compressed(out, b=self.b, at=at.astype(np.int32), w=self.w[at], v=self.v[at])
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> Model:
        z = np.load(io.BytesIO(data))
        w, v = np.zeros(1 << BUCKET_BITS, np.float32), np.zeros((1 << BUCKET_BITS, FACTORS), np.float32)
        w[z["at"]], v[z["at"]] = z["w"], z["v"]
        return cls(float(z["b"]), w, v)

    def score(self, terms: Terms) -> np.ndarray:
        use = terms.used[:, :, None]
        vectors = self.v[terms.buckets] * use
        # per distinct word: factors, sum of their squares, weight
        own = np.concatenate([vectors.sum(axis=1), (vectors ** 2).sum(axis=(1, 2))[:, None],
                              (self.w[terms.buckets] * terms.used).sum(axis=1)[:, None]], axis=1).astype(np.float64)
        total = np.zeros((terms.n_texts, FACTORS + 2))
        if len(terms.text):
            texts, first = np.unique(terms.text, return_index=True)
            total[texts] = np.add.reduceat(own[terms.word], first, axis=0)
        z = self.b + total[:, -1] + 0.5 * ((total[:, :FACTORS] ** 2).sum(axis=1) - total[:, -2])
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit(flat: np.ndarray, sizes: np.ndarray, labels: np.ndarray) -> Model:
    """Train on the term buckets of texts (one after another in ``flat``), mini-batches on the log loss.

    Weights follow the regularised leader with an L1 penalty, so that the many
    terms that say nothing weigh exactly zero and long texts do not add up
    noise; a term has factors only while its weight is not zero (AdaGrad).
    """
    size = 1 << BUCKET_BITS
    share = (labels.sum() + 0.5) / (len(labels) + 1)
    prior = float(np.log(share / (1 - share)))
    lasso = LASSO * float(np.sqrt(len(labels) * share * (1 - share)))
    w, v = np.zeros(size, np.float32), np.zeros((size, FACTORS), np.float32)
    if len(labels) == 0 or labels.min() == labels.max():
        return Model(prior, w, v)
    text = np.repeat(np.arange(len(sizes), dtype=np.int64), sizes)
    seen = np.zeros(size, np.int64)
    for at in range(0, len(flat), 1 << 20):  # texts a term occurs in (a cut text may count twice)
        seen += np.bincount(np.unique(text[at:at + (1 << 20)] * size + flat[at:at + (1 << 20)]) % size, minlength=size)
    known = (seen >= MIN_DOCS)[flat]
    flat, sizes = flat[known], np.bincount(text[known], minlength=len(sizes))
    del text, known
    random = np.random.default_rng(SEED)
    factors = random.normal(0, 0.05, (size, FACTORS)).astype(np.float32)
    lead, gw = np.zeros(size), np.zeros(size)
    gv = np.ones((size, FACTORS), np.float32)
    b, gb = prior, 1.0
    first = np.cumsum(sizes) - sizes

    def per_text(n: np.ndarray, values: np.ndarray) -> np.ndarray:
        out = np.zeros((len(n), *values.shape[1:]))
        some = np.flatnonzero(n)
        if len(some):
            out[some] = np.add.reduceat(values, (np.cumsum(n) - n)[some], axis=0)
        return out

    for _ in range(EPOCHS):
        order = random.permutation(len(sizes))
        for at in range(0, len(order), BATCH):
            pick = order[at:at + BATCH]
            n = sizes[pick]
            ids = flat[W.expand(first[pick], n)]
            doc = np.repeat(np.arange(len(pick)), n)
            # pairs: only terms that weigh something have factors
            live = w[ids] != 0
            live_ids, live_doc = ids[live], doc[live]
            n_live = np.bincount(live_doc, minlength=len(pick))
            fv = factors[live_ids]
            sums = per_text(n_live, fv)
            pairs = 0.5 * ((sums ** 2).sum(axis=1) - per_text(n_live, (fv ** 2).sum(axis=1)))
            z = b + per_text(n_live, w[live_ids]) + pairs
            err = 1 / (1 + np.exp(-np.clip(z, -40, 40))) - labels[pick]
            terms, inverse = np.unique(ids, return_inverse=True)
            g = np.bincount(inverse, weights=err[doc], minlength=len(terms))
            old = gw[terms]
            gw[terms] = old + g ** 2
            lead[terms] += g - (np.sqrt(gw[terms]) - np.sqrt(old)) / RATE * w[terms]
            if len(live_ids):
                terms_v, inverse_v = np.unique(live_ids, return_inverse=True)
                e = err[live_doc]
                dv = np.stack([np.bincount(inverse_v, weights=e * (sums[live_doc, f] - fv[:, f]), minlength=len(terms_v))
                               for f in range(FACTORS)], axis=1) + RIDGE * factors[terms_v]
                gv[terms_v] += dv ** 2
                factors[terms_v] -= FACTOR_RATE * dv / np.sqrt(gv[terms_v])
            lz = lead[terms]
            w[terms] = np.where(np.abs(lz) <= lasso, 0.0,
                                -(lz - np.sign(lz) * lasso) / ((1 + np.sqrt(gw[terms])) / RATE + RIDGE))
            gb += err.sum() ** 2
            b -= RATE * err.sum() / np.sqrt(gb)
    v[w != 0] = factors[w != 0]
    return Model(b, w, v)


def held_out(doc_id: str = "doc_id"):
    """True for the rows that no training may read: crc32(doc_id as text) mod 3 is 1."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> Model:
    """Fit on the labelled documents outside the held-out fold, at most about ``max_train`` of them."""
    bounded_batches(docs.sparkSession)
    known = (labels.where("toxic is not null and doc_id is not null").where(~held_out())
             .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")))
    n = known.count()
    draw = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 30))
    if n > max_train:
        known = known.where(draw < F.lit(int((1 << 30) * max_train / n)))
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(known, "doc_id")

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.text_slices(batch):
                t = Terms(part.column("text"))
                lists = np.split(t.word, np.searchsorted(t.text, np.arange(1, t.n_texts)))
                ids = [np.sort(t.buckets[x][t.used[x]].astype(np.int32)) for x in lists]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("toxic"),
                                                  pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "toxic", "ids"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, sizes, y = [np.empty(0, np.int32)], [np.empty(0, np.int64)], [np.empty(0)]
        for batch in batches:
            col = batch.column("ids")
            ids.append(col.flatten().to_numpy().copy())
            sizes.append(np.diff(col.offsets.to_numpy()).astype(np.int64))
            y.append(batch.column("toxic").to_numpy().astype(np.float64))
        flat = np.concatenate(ids)
        ids.clear()
        model = fit(flat, np.concatenate(sizes), np.concatenate(y))
        yield pa.RecordBatch.from_arrays([pa.array([model.dump()], pa.binary())], names=["model"])

    # one bounded task; its order does not depend on how the rows were dealt
    sample = (rows.mapInArrow(terms, "doc_id long, toxic int, ids array<int>").repartition(1)
              .sortWithinPartitions("doc_id", F.hash("ids")))
    found = sample.mapInArrow(learn, "model binary").collect()
    return Model.load(bytes(found[0]["model"])) if found else fit(np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0))


def score(docs: DataFrame, model: Model, column: str = "score") -> DataFrame:
    """``docs`` with one more column, the score of the whole text."""
    bounded_batches(docs.sparkSession)
    data = model.dump()
    out = docs.withColumn("text", F.col("text").cast("string")).withColumn(column, F.lit(None).cast("double"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model.load(data)
        for batch in batches:
            for part in W.text_slices(batch):
                cols = part.columns
                cols[part.schema.get_field_index(column)] = pa.array(own.score(Terms(part.column("text"))))
                yield pa.RecordBatch.from_arrays(cols, schema=part.schema)

    return out.mapInArrow(work, out.schema)


def drop_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score below ``threshold``."""
    name = spare_name(docs, "score")
    return score(docs, model, name).where(F.col(name) < threshold).select(*docs.columns)


def op6_toxicity_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select("doc_id", held_out().alias("held_out"), "score",
                                     (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
