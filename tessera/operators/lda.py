"""Latent Dirichlet allocation with the topic-word weights as a distributed table.

Batch variational inference. The weights are never gathered: words are numbered and the
weights lie in parts of bounded size, documents are packed into blocks of bounded size
that hold their (document, word) pairs as arrays. In a pass a part sends each block the
weights of the words it asks for (so a word that every document holds travels once a
block, not once a document), a block improves its documents' topic shares slice by slice
and sends back the expected counts of those words, which their part sums into the next
weights. What travels is one row a block and part. The driver sees the topics' totals and
the bound, 2k + 1 numbers a pass.

On disk lie the weights and what the blocks sent back, not what they were sent, and only
that of one pass: it is deleted as soon as the next step has read it. Many blocks go in up
to ``GROUPS`` groups, one after the other, so that only a part of what they share out is in
shuffle files at once.

The bound on the log-likelihood that variational inference climbs cannot fall from
one pass to the next; ``bounds`` holds its values.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import drop_written, materialize, release, written

BLOCK_PAIRS = 4_000_000  # (document, word) pairs of a block
SLICE_PAIRS = 200_000  # pairs of a block worked on at once
PART_WORDS = 20_000  # words of a part of the weights
VOCABULARY_PART = 50_000  # words numbered by one window
GROUPS, GROUP_BLOCKS = 4, 12  # groups of blocks at most, blocks of a group at least
INNER = 4  # updates of a document's shares in a pass; they go on from those of the pass before


class Lda(NamedTuple):
    weights: DataFrame  # index, l0, l1, ...
    totals: list[float]
    bounds: list[float]
    shares: DataFrame  # doc, shares array<double>: topic weights of each document
    vocabulary: DataFrame  # word, index

    def top_terms(self, n: int) -> DataFrame:
        """(topic, rank, word, weight): the n likeliest words of each topic; ties go to the word numbered first."""
        out = None
        for t, total in enumerate(self.totals):
            # a top-n per task, then of those: no sort of all words
            best = (self.weights.select("index", (F.col(f"l{t}") / total).alias("weight"))
                    .orderBy(F.desc("weight"), "index").limit(n).agg(F.collect_list(F.struct("weight", "index")).alias("b")))
            best = F.array_sort("b", lambda x, y: F.when((x["weight"] > y["weight"]) | (
                (x["weight"] == y["weight"]) & (x["index"] < y["index"])), -1).otherwise(1)), best
            rows = best[1].select(F.lit(t).alias("topic"), F.posexplode(best[0]).alias("rank", "x")).select(
                "topic", "rank", "x.index", "x.weight")
            out = rows if out is None else out.unionByName(rows)
        rows = materialize(out).join(self.vocabulary, "index").select("topic", "rank", "word", "weight")
        return rows.orderBy("topic", "rank")


def digamma(x: np.ndarray) -> np.ndarray:
    """Derivative of log gamma for x > 0: six steps of the recurrence, then the asymptotic series."""
    y = x + 6
    v = 1 / (y * y)
    head = sum(1 / (x + i) for i in range(6))
    return np.log(y) - 0.5 / y - v * (1 / 12 - v * (1 / 120 - v * (1 / 252 - v * (1 / 240 - v / 132)))) - head


def log_gamma(x: np.ndarray) -> np.ndarray:
    """log of the gamma function for x > 0."""
    y = x + 6
    v = 1 / (y * y)
    head = sum(np.log(x + i) for i in range(6))
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + (1 / 12 - v * (1 / 360 - v * (1 / 1260 - v / 1680))) / y - head


def improve(sizes: np.ndarray, word: np.ndarray, n: np.ndarray, beta: np.ndarray, gamma: np.ndarray,
            alpha: float, sums: np.ndarray, steps: int = INNER) -> tuple[np.ndarray, float]:
    """New shares (topics x documents) and the documents' part of the bound.

    ``sizes`` are the documents' numbers of pairs (none 0), ``word`` and ``n`` the pairs, one document after another;
    ``beta`` has the words' weights (topics x words). To ``sums`` (as ``beta``) is added what the
    words' expected counts are a multiple ``beta`` of.
    """
    k = len(beta)
    first = np.cumsum(sizes) - sizes
    held = [b[word] for b in beta]
    for step in range(steps + 1):
        log_theta = digamma(gamma) - digamma(gamma.sum(axis=0))
        theta = np.exp(log_theta)
        norm = np.full(len(word), 1e-300)
        for t, h in enumerate(held):
            norm += np.repeat(theta[t], sizes) * h
        share = n / norm
        if step == steps:  # the last sums belong to the shares that stay
            break
        gamma = alpha + theta * np.stack([np.add.reduceat(share * h, first) for h in held])
    for t in range(k):
        sums[t] += np.bincount(word, weights=share * np.repeat(theta[t], sizes), minlength=sums.shape[1])
    bound = float(n @ np.log(norm) + ((alpha - gamma) * log_theta + log_gamma(gamma)).sum()
                  - log_gamma(gamma.sum(axis=0)).sum()
                  + gamma.shape[1] * (log_gamma(np.array([alpha * k]))[0] - k * log_gamma(np.array([alpha]))[0]))
    return gamma, bound


def lda_vocabulary(counts: DataFrame, part_words: int = VOCABULARY_PART) -> tuple[DataFrame, int]:
    """(word, index) numbering every word of ``counts`` from 0 without a gap, and the number of words.

    Words are ranked within parts by hash; only the parts' sizes reach the driver.
    """
    words = materialize(counts.select("word").distinct())
    n = words.count()
    part = F.pmod(F.xxhash64("word"), F.lit(max(1, -(-n // part_words)))).cast("int")
    words = words.withColumn("part", part)
    offsets, at = [], 0
    for r in words.groupBy("part").count().orderBy("part").collect():
        offsets.append((r["part"], at))
        at += r["count"]
    place = F.row_number().over(Window.partitionBy("part").orderBy("word")) - 1
    numbered = words.withColumn("place", place).join(words.sparkSession.createDataFrame(offsets, "part int, offset int"), "part")
    return materialize(numbered.select("word", (F.col("place") + F.col("offset")).alias("index"))), n


def _cells(table: pa.Table, name: str) -> list[np.ndarray]:
    """The arrays of a list column, one a row, not copied."""
    out = []
    for lists in table[name].chunks:
        at, values = lists.offsets.to_numpy(), lists.values.to_numpy()
        out += [values[a:b] for a, b in zip(at, at[1:])]
    return out


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    bounds = np.cumsum([0] + [len(a) for a in arrays])
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(np.concatenate(arrays)))


def _ints(values) -> pa.Array:
    return pa.array(values, pa.int32())


def _rows(schema: pa.Schema, *tables: dict) -> pa.Table:
    """Rows of several kinds, null where a kind has no such column."""
    parts = [pa.table([t[f.name].cast(f.type) if f.name in t else pa.nulls(len(next(iter(t.values()))), f.type)
                       for f in schema], schema=schema) for t in tables]
    return pa.concat_tables(parts)


def pack_blocks(dealt: DataFrame, slice_pairs: int = SLICE_PAIRS) -> tuple[DataFrame, DataFrame]:
    """Pairs (block, piece, docs, sizes, word, n) and words (block, at, word) of rows dealt by document.

    A partition is a block; its documents come in pieces of about ``slice_pairs`` pairs, their words as
    places in the block's list of distinct words. ``dealt`` has (doc, word) and maybe ``n``, where a row
    may have one word or an array of them (and of numbers); without ``n`` a word counts once.
    """
    kind = dict(dealt.dtypes)
    one = not kind["word"].startswith("array")
    word_kind = kind["word"] if one else kind["word"][6:-1]
    word = F.array("word") if one else F.col("word")
    # null numbers say: once each
    n = F.lit(None).cast("array<double>") if "n" not in kind else F.array("n") if one else F.col("n")
    bags = dealt.select("doc", word.alias("word"), n.cast("array<double>").alias("n")).where(F.size("word") > 0)
    types = {"block": pa.int32(), "piece": pa.int32(), "sizes": pa.list_(pa.int32()), "word": pa.list_(pa.int32()),
             "n": pa.list_(pa.float64())}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, sizes, words, numbers = [], [], [], []
        for batch in batches:
            docs.append(batch.column("doc"))
            sizes.append(pc.list_value_length(batch.column("word")).to_numpy())
            words.append(batch.column("word").flatten())
            if batch.column("n").null_count == 0:
                numbers.append(batch.column("n").flatten().to_numpy())
            else:
                numbers.append(np.ones(len(words[-1])))
        if not docs:
            return
        block = TaskContext.get().partitionId()
        names = pa.chunked_array(words).combine_chunks().dictionary_encode()
        owners = pa.chunked_array(docs).combine_chunks().dictionary_encode(null_encoding="encode")
        words.clear()
        n_names = len(names.dictionary)
        key = np.repeat(owners.indices.to_numpy().astype(np.int64), np.concatenate(sizes)) * n_names + names.indices.to_numpy()
        key, which = np.unique(key, return_inverse=True)
        n = np.bincount(which, weights=np.concatenate(numbers), minlength=len(key))
        sizes = np.bincount(key // n_names, minlength=len(owners.dictionary))
        word, ends = (key % n_names).astype(np.int32), np.cumsum(sizes)
        schema = pa.schema([*types.items(), ("docs", pa.list_(owners.dictionary.type)),
                            ("names", pa.list_(names.dictionary.type))])
        yield from _rows(schema, {"block": _ints([block]),
                                  "names": pa.ListArray.from_arrays(_ints([0, n_names]), names.dictionary)}).to_batches()
        first = piece = 0
        while first < len(sizes):
            start = ends[first] - sizes[first]
            last = max(first + 1, int(np.searchsorted(ends, start + slice_pairs, "right")))
            pairs = slice(start, ends[last - 1])
            yield from _rows(schema, {
                "block": _ints([block]), "piece": _ints([piece]), "sizes": _lists([sizes[first:last]]),
                "word": _lists([word[pairs]]), "n": _lists([n[pairs]]),
                "docs": pa.ListArray.from_arrays(_ints([0, last - first]), owners.dictionary[first:last])}).to_batches()
            first, piece = last, piece + 1

    packed = materialize(bags.mapInArrow(work, (
        "block int, piece int, sizes array<int>, word array<int>, n array<double>, "
        f"docs array<{kind['doc']}>, names array<{word_kind}>")))
    words = packed.where("names is not null").select("block", F.posexplode("names").alias("at", "word"))
    return packed.where("names is null").drop("names"), words


def fit_lda(counts: DataFrame, k: int, passes: int, seed: int, block_pairs: int = BLOCK_PAIRS,
            part_words: int = PART_WORDS, dealt: bool = False, draw_by: str = "word") -> Lda:
    """Fit ``k`` topics on the rows of ``pack_blocks``: documents, their words and how often; both priors are 1 / k.

    Rows are dealt by document into blocks of about ``block_pairs`` words, unless they come so (``dealt``).
    Weights start from hash draws by topic and ``draw_by`` (word, or its index in the vocabulary), so the result does not depend on
    how the rows are dealt (up to rounding). A document fits into one row.
    """
    spark = counts.sparkSession
    alpha = eta = 1.0 / k
    if not dealt:
        n_pairs = counts.agg(F.sum(F.size("word") if dict(counts.dtypes)["word"].startswith("array") else F.lit(1))).first()[0]
        counts = counts.repartition(max(1, -(-(n_pairs or 0) // block_pairs)), "doc")
    pairs, words = pack_blocks(counts)
    vocabulary, n_words = lda_vocabulary(words)
    part, place = F.floor(F.col("index") / part_words).cast("int"), (F.col("index") % part_words).cast("int")
    asked = materialize(words.join(vocabulary, "word").groupBy(part.alias("part"), "block")
                        .agg(F.collect_list(F.struct("at", place.alias("place"))).alias("t"))
                        .select("part", "block", F.col("t.at").alias("at"), F.col("t.place").alias("place")))

    def draw(t: int):
        return F.lit(0.5) + F.pmod(F.xxhash64(draw_by, F.lit(t), F.lit(seed)), F.lit(1 << 20)) / float(1 << 20)

    sums = (vocabulary.groupBy(part.alias("part"))
            .agg(F.sort_array(F.collect_list(F.struct("index", F.array(*[draw(t) for t in range(k)]).alias("x")))).alias("t"))
            .select("part", F.lit(None).cast("int").alias("block"), F.flatten(F.col("t.x")).alias("x")))
    sent_schema = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("piece", pa.int32()),
                             ("x", pa.list_(pa.float64())), ("bound", pa.float64())])

    def next_weights(left: pa.Table, right: pa.Table) -> pa.Table:
        """A part's weights and its share of the totals and the bound."""
        left, right = left.sort_by("block"), right.sort_by("block")
        places, given = _cells(left, "place"), _cells(right, "x")
        number = left["part"][0].as_py()
        x = np.full((min(part_words, n_words - number * part_words), k), eta)
        if right["block"].null_count:  # the start
            x = given[0].reshape(-1, k)
        else:  # a word is in a block's list once
            for p, c in zip(places, given):
                x[p] += c.reshape(-1, k)
        bound = (eta - x) * digamma(x) + log_gamma(x) - log_gamma(np.array([eta]))[0]
        return pa.table({"part": _ints([number]), "x": _lists([x.ravel()]),
                         "stats": _lists([np.r_[x.sum(axis=0), bound.sum()]])})

    def asked_weights(left: pa.Table, right: pa.Table) -> pa.Table:
        """The rows of a part's weights that blocks ask for."""
        if not left.num_rows:
            return pa.table({c: pa.array([], t) for c, t in (("part", pa.int32()), ("block", pa.int32()),
                                                             ("at", pa.list_(pa.int32())), ("x", pa.list_(pa.float64())))})
        x = _cells(right, "x")[0].reshape(-1, k)
        return pa.table({"part": left["part"].combine_chunks(), "block": left["block"].combine_chunks(),
                         "at": left["at"].combine_chunks(), "x": _lists([x[p].ravel() for p in _cells(left, "place")])})

    groups = _groups(pairs)
    state, bounds, sums_at, state_at = None, [], [], []
    for i in range(passes + 1):
        weights, weights_at = written(asked.groupBy("part").cogroup(sums.groupBy("part")).applyInArrow(
            next_weights, "part int, x array<double>, stats array<double>"))
        drop_written(spark, *sums_at)
        release(spark)
        totals, bound = _weight_sums(weights, k, eta, n_words)
        if i == passes:  # the last pass's counts are in the weights
            break
        all_words = np.array(totals)

        def work(left: pa.Table, right: pa.Table) -> pa.Table:
            table, old = right.filter(pc.is_null(right["piece"])), right.filter(pc.is_valid(right["piece"]))
            shares = dict(zip(old["piece"].to_pylist(), _cells(old, "x")))
            at, given = _cells(table, "at"), _cells(table, "x")
            beta = np.empty((k, sum(map(len, at))))
            for a, x in zip(at, given):
                beta[:, a] = x.reshape(-1, k).T
            beta = np.exp(digamma(beta) - digamma(all_words)[:, None])
            sums, found, bound = np.zeros_like(beta), [], 0.0
            rows = zip(left["piece"].to_pylist(), *(_cells(left, c) for c in ("sizes", "word", "n")))
            rows = sorted(rows, key=lambda x: x[0])  # the arrays stay where they are
            for piece, sizes, word, n in rows:
                if piece in shares:
                    gamma = shares[piece].reshape(k, -1)
                else:
                    gamma = alpha + np.tile(np.add.reduceat(n, np.cumsum(sizes) - sizes) / k, (k, 1))
                gamma, own = improve(sizes, word, n, beta, gamma, alpha, sums)
                found.append(gamma.ravel())
                bound += own
            sums *= beta
            block = left["block"][0].as_py()
            return _rows(sent_schema, {"block": _ints([block] * len(at)), "part": table["part"].combine_chunks(),
                                       "x": _lists([sums[:, a].T.ravel() for a in at])},
                         {"block": _ints([block] * len(found)), "piece": _ints([x[0] for x in rows]),
                          "x": _lists(found), "bound": pa.array([bound] + [None] * (len(found) - 1), pa.float64())})

        parts = []
        for own in groups:
            right = (asked.where(own).groupBy("part").cogroup(weights.select("part", "x").groupBy("part"))
                     .applyInArrow(asked_weights, "part int, block int, at array<int>, x array<double>"))
            if state is not None:
                right = right.unionByName(state.where(own).select("block", "piece", "x"), allowMissingColumns=True)
            else:
                right = right.withColumn("piece", F.lit(None).cast("int"))
            parts.append(written(pairs.where(own).select("block", "piece", "sizes", "word", "n").groupBy("block")
                                 .cogroup(right.groupBy("block"))
                                 .applyInArrow(work, "part int, block int, piece int, x array<double>, bound double")))
            release(spark)
        sent, sums_at = reduce(DataFrame.unionByName, [x for x, _ in parts]), [at for _, at in parts]
        sums = sent.where("piece is null").select("part", "block", "x")
        state, at = written(sent.where("piece is not null").select("block", "piece", "x", "bound"))
        drop_written(spark, weights_at, *state_at)
        state_at = [at]
        bounds.append(bound + float(state.agg(F.sum("bound")).first()[0] or 0))
    rows = _weight_rows(weights, k, part_words)
    drop_written(spark, weights_at)
    return Lda(rows, totals, bounds, _shares(pairs, state, k), vocabulary)


def _groups(pairs: DataFrame) -> list[Column]:
    """Conditions that cut the blocks into groups of neighbours."""
    n = 1 + (pairs.agg(F.max("block")).first()[0] or 0)
    number = min(GROUPS, max(1, n // GROUP_BLOCKS))
    ends = [n * g // number for g in range(number + 1)]
    return [(F.col("block") >= a) & (F.col("block") < b) for a, b in zip(ends, ends[1:])]


def _weight_rows(weights: DataFrame, k: int, part_words: int) -> DataFrame:
    """(index, l0, l1, ...) of the parts' arrays."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, x in zip(batch.column("part").to_pylist(), _cells(pa.table(batch), "x")):
                x = x.reshape(-1, k)
                yield pa.RecordBatch.from_arrays([_ints(np.arange(len(x)) + part * part_words), *map(pa.array, x.T.copy())],
                                                 names=["index", *(f"l{t}" for t in range(k))])

    return materialize(weights.select("part", "x").mapInArrow(
        work, "index int, " + ", ".join(f"l{t} double" for t in range(k))))


def _shares(pairs: DataFrame, state: DataFrame | None, k: int) -> DataFrame:
    """(doc, shares): the pieces' arrays (topics x documents), a row a document."""
    if state is None:
        state = pairs.where("false").select("block", "piece", F.lit(None).cast("array<double>").alias("x"))
    size = F.size("docs")
    return (pairs.select("block", "piece", "docs").join(state.select("block", "piece", "x"), ["block", "piece"])
            .select(F.posexplode("docs").alias("i", "doc"), "x", size.alias("size"))
            .select("doc", F.array(*[F.get("x", F.col("i") + F.col("size") * t) for t in range(k)]).alias("shares")))


def _weight_sums(weights: DataFrame, k: int, eta: float, n_words: int) -> tuple[list[float], float]:
    """The topics' totals and the weights' part of the bound, from k totals and a partial bound of each part."""
    row = weights.agg(*[F.sum(F.col("stats")[i]) for i in range(k + 1)]).first()
    if row[0] is None:
        return [0.0] * k, 0.0
    totals = np.array([float(v) for v in row[:k]])
    bound = row[k] - float(digamma(totals) @ (eta * n_words - totals))
    return totals.tolist(), float(bound + (log_gamma(np.array([eta * n_words]))[0] - log_gamma(totals)).sum())
