"""Periodic runs: stretches of words that repeat with a short period, found exactly.

A run is a stretch of consecutive words whose words ``period`` apart are equal,
at least ``repeats`` periods and ``min_words`` words long, which no neighbouring
word extends; ``period`` is its smallest period.

Method: a dictionary of basic factors. For m = 1, 2, 4, ... every stretch of m
words is named, so that stretches of one text have one name exactly if they are
equal; the names of length 2m come from pairs of names of length m. Stretches that
occur once in their text are left out, and with them all longer ones that hold
them, so ordinary prose is done after three or four lengths.

Of each name the successor occurrences at most 2m words on form arithmetic
progressions; a progression proposes its difference as a period. Proposals are
extended left and right by the same dictionary, longest factors first (a
logarithmic number of comparisons), and equal results are merged.

Why none is missed: take a run of smallest period q and the m = 2^k with
q <= m < 2q. The factor at the run's start occurs again q words on, inside the run
(q + m <= 3q), and nowhere between, since a factor of q words or more recurs in a
run at multiples of q only. Why no period is too large: were p < d a smaller
period of the extended stretch, the factor would have occurred p words on already.

All texts of a slice are handled at once by array operations. A text is one unit
of work and stays in one task; nothing is shuffled.

Defined cases: a null text has no words, no runs and an empty collapsed text;
so has an empty one; repeated rows get equal results; columns named ``runs`` or
``collapsed`` are replaced, all others stay; an empty table gives no rows. In
the query a null doc_id leaves the text as it is.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import words as W
from tessera.llm.shared import bounded_batches, table

MIN_WORDS = 24
REPEATS = 3  # the proof above needs three periods at least
RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


class Factors:
    """Names of the stretches of ``size`` words that occur twice or more in their text: positions and names."""

    def __init__(self, size: int, at: np.ndarray, key: np.ndarray):
        _, name, count = np.unique(key, return_inverse=True, return_counts=True)
        twice = count[name] > 1
        self.size, self.at, self.name = size, at[twice], name[twice]

    def names(self, at: np.ndarray) -> np.ndarray:
        """Names of the stretches starting at ``at``, -1 for those that occur once."""
        if not len(self.at):
            return np.full(len(at), -1)
        place = np.minimum(np.searchsorted(self.at, at), len(self.at) - 1)
        return np.where(self.at[place] == at, self.name[place], -1)

    def doubled(self, end: np.ndarray) -> Factors:
        """The dictionary of twice the length; ``end`` is the end of each word's text."""
        fits = self.at + 2 * self.size <= end[self.at]
        at, left = self.at[fits], self.name[fits]
        right = self.names(at + self.size)
        known = right >= 0
        return Factors(2 * self.size, at[known], left[known] * (len(end) + 1) + right[known])

    def proposals(self) -> tuple[np.ndarray, np.ndarray]:
        """(position, period) of the first member of every arithmetic progression of successor occurrences."""
        order = np.argsort(self.name, kind="stable")
        at, name = self.at[order], self.name[order]
        gap = np.where(name[1:] == name[:-1], at[1:] - at[:-1], 0)  # 0: the last of its name
        head = (gap > 0) & (gap <= 2 * self.size)
        head[1:] &= (gap[1:] != gap[:-1])
        at, gap = at[:-1][head], gap[head]
        # neighbouring heads of one difference lie in one stretch: the first speaks for all
        order = np.lexsort((at, gap))
        at, gap = at[order], gap[order]
        first = np.ones(len(at), bool)
        first[1:] = (gap[1:] != gap[:-1]) | (at[1:] != at[:-1] + 1)
        return at[first], gap[first]


def word_runs(codes: np.ndarray, bounds: np.ndarray, min_words: int = MIN_WORDS,
              repeats: int = REPEATS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of every run, by start and period; words of text t are bounds[t] to bounds[t + 1]."""
    if repeats < 3:
        raise ValueError("runs of fewer than three periods are not found completely")
    sizes = np.diff(bounds)
    text = np.repeat(np.arange(len(sizes)), sizes)
    begin, end = bounds[:-1][text], bounds[1:][text]
    n = len(codes)
    dictionary = []
    factors = Factors(1, np.arange(n), text * (int(codes.max(initial=0)) + 1) + codes)
    while len(factors.at):
        dictionary.append(factors)
        factors = factors.doubled(end)
    found = [f.proposals() for f in dictionary]
    if not found:
        none = np.empty(0, np.int64)
        return none, none, none
    at = np.concatenate([a for a, _ in found])
    period = np.concatenate([d for _, d in found])
    ahead, back = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
    for f in reversed(dictionary):
        near, far = at + ahead, at + period + ahead
        inside = np.flatnonzero(far + f.size <= end[at])
        names = f.names(near[inside])
        ahead[inside[(names >= 0) & (names == f.names(far[inside]))]] += f.size
        near, far = at - back - f.size, at + period - back - f.size
        inside = np.flatnonzero(near >= begin[at])
        names = f.names(near[inside])
        back[inside[(names >= 0) & (names == f.names(far[inside]))]] += f.size
    start, length = at - back, back + period + ahead
    long = (length >= min_words) & (length >= repeats * period)
    runs = np.unique(np.stack([start[long], period[long], length[long]], 1), axis=0)
    return runs[:, 0], runs[:, 2], runs[:, 1]


def joined(words: pa.Array, bounds: np.ndarray) -> pa.Array:
    """Texts of words joined by one space; words of text t are bounds[t] to bounds[t + 1]."""
    lists = pa.LargeListArray.from_arrays(pa.array(bounds, pa.int64()), words.cast(pa.large_string()))
    return pc.binary_join(lists, pa.scalar(" ", pa.large_string())).cast(pa.string())


def find_runs(docs: DataFrame, min_words: int = MIN_WORDS, repeats: int = REPEATS) -> DataFrame:
    """``docs`` with ``runs`` (start, length, period, in words from 0) and ``collapsed``.

    ``collapsed`` is the text without what repeats: each word that some run holds
    after its first period is left out, the others are joined by one space.
    """
    bounded_batches(docs.sparkSession)
    out = (docs.withColumn("text", F.col("text").cast("string"))
           .withColumn("runs", F.lit(None).cast("array<struct<start:bigint,length:bigint,period:bigint>>"))
           .withColumn("collapsed", F.lit(None).cast("string")))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.text_slices(batch):
                words = W.split_words(part.column("text"), W.SPACES)
                codes = words.distinct()[0].astype(np.int64)
                start, length, period = word_runs(codes, words.bounds, min_words, repeats)
                step = np.zeros(len(codes) + 1, np.int64)
                np.add.at(step, start + period, 1)
                np.add.at(step, start + length, -1)
                kept = np.cumsum(step)[:-1] == 0
                kept_bounds = np.r_[0, np.cumsum(kept)][words.bounds]
                of_run = np.searchsorted(start, words.bounds)
                base = words.bounds[:-1][np.searchsorted(words.bounds, start, side="right") - 1]
                runs = pa.StructArray.from_arrays([pa.array(start - base), pa.array(length), pa.array(period)],
                                                  fields=list(RUNS.value_type))
                cols = part.columns
                cols[part.schema.get_field_index("runs")] = pa.ListArray.from_arrays(
                    pa.array(of_run, pa.int32()), runs).cast(part.schema.field("runs").type)
                cols[part.schema.get_field_index("collapsed")] = joined(
                    words.array().filter(pa.array(kept)), kept_bounds)
                yield pa.RecordBatch.from_arrays(cols, schema=part.schema)

    return out.mapInArrow(work, out.schema)


def repeat_tails(docs: DataFrame) -> DataFrame:
    """``docs`` with the words of about one text in ten made periodic from some word on, as the doc_id says.

    With h the crc32 of the decimal doc_id and g = h // 10: if h % 10 is 0, word
    i >= a of the n words becomes word a + (i - a) % p, where a = g % n and
    p = 1 + (n - a) // (3 + g % 8). The words of such a text are joined by one space.
    """
    bounded_batches(docs.sparkSession)
    docs = docs.withColumn("text", F.col("text").cast("string"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.text_slices(batch):
                hashes = [1 if i is None else zlib.crc32(str(i).encode()) for i in part.column("doc_id").to_pylist()]
                chosen = np.array([h % 10 == 0 for h in hashes])
                texts = part.column("text")
                words = W.split_words(texts.filter(pa.array(chosen)), W.SPACES)
                sizes, first = np.diff(words.bounds), words.bounds[:-1]
                g = np.array(hashes, np.int64)[chosen] // 10
                a = g % np.maximum(sizes, 1)
                p = 1 + (sizes - a) // (3 + g % 8)
                text = words.text_of_word()
                place = np.arange(len(text)) - first[text]
                tail = a[text] + (place - a[text]) % p[text]
                source = first[text] + np.where(place < a[text], place, tail)
                changed = joined(words.array().take(pa.array(source)), words.bounds)
                cols = part.columns
                cols[part.schema.get_field_index("text")] = pc.replace_with_mask(texts, pa.array(chosen), changed)
                yield pa.RecordBatch.from_arrays(cols, schema=part.schema)

    return docs.mapInArrow(work, docs.schema)


def strongest(runs: Column) -> Column:
    """The run of greatest length / period, compared exactly; ties go to the smallest start, then period."""
    def better(a: Column, b: Column) -> Column:
        left, right = a["length"] * b["period"], b["length"] * a["period"]
        return (F.when(left > right, -1).when(left < right, 1).when(a["start"] < b["start"], -1)
                .when(a["start"] > b["start"], 1).when(a["period"] < b["period"], -1).otherwise(1))

    return F.get(F.array_sort(runs, better), 0)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_runs(repeat_tails(table(spark, sf_dir, "documents").select("doc_id", "text")))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return (found.withColumn("best", strongest(F.col("runs")))
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
                    F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
                    F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
                    F.sha2("collapsed", 256).alias("collapsed_sha256")))
