"""Benchmark decontamination: Wu-Manber search for windows of benchmark words.

Texts are lower-cased (A-Z) and cut into words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``.
Every run of ``size`` consecutive words of an item is a pattern; an item of
fewer words, but not none, is one pattern. A document word inside any
occurrence of a pattern is hit.

Patterns of one length are searched together. Words are numbered (0: a word of
no item). The shift table maps a block of two words (one, for one-word
patterns) to how far the search may move when a window ends in that block; a
block that no pattern holds moves it past itself. Shift 0 means that the block
ends a pattern: its bucket lists those patterns and each is compared directly.

The documents stay where they are: no shuffle. Patterns travel with the task,
in parts of at most ``PART_WORDS`` benchmark words; with more words than that,
documents pass one part after another.

Defined cases: a null text or item text has no words; an item without an
item_id is ignored; repeated items and windows count once; an empty benchmark
hits nothing; every row gives a row; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import words as W
from tessera.llm.shared import bounded_batches, spare_name, table

SIZE = 10
PART_WORDS = 2_000_000


class Searcher:
    """Wu-Manber tables of one length over numbered words."""

    def __init__(self, length: int, patterns: dict[tuple[int, ...], set[int]], n_words: int):
        self.length = length
        self.block = min(2, length)
        self.base = n_words + 1
        self.default = length - self.block + 1
        self.shift: dict[int, int] = {}
        self.bucket: dict[int, list[tuple[tuple[int, ...], set[int]]]] = {}
        for pattern, items in patterns.items():
            for end in range(self.block, length + 1):
                key = self._key(pattern, end)
                self.shift[key] = min(self.shift.get(key, self.default), length - end)
            self.bucket.setdefault(self._key(pattern, length), []).append((pattern, items))

    def _key(self, words, end: int) -> int:
        return words[end - 1] if self.block == 1 else words[end - 2] * self.base + words[end - 1]

    def occurrences(self, words: list[int]) -> Iterator[tuple[int, set[int]]]:
        """(end, items) of every occurrence."""
        length, base, default, pairs = self.length, self.base, self.default, self.block == 2
        shift, bucket, n = self.shift.get, self.bucket, len(words)
        at = length
        while at <= n:
            key = words[at - 2] * base + words[at - 1] if pairs else words[at - 1]
            step = shift(key, default)
            if step:
                at += step
                continue
            window = tuple(words[at - length:at])
            for pattern, items in bucket[key]:
                if pattern == window:
                    yield at, items
            at += 1


class Patterns:
    """All patterns of a set of items: word numbers, item names and one searcher per length."""

    def __init__(self, items: list[tuple[str, bytes]], size: int):
        texts = pa.array([t for _, t in items], pa.large_binary())
        words = W.split_words(texts, W.NOT_ALNUM, lower=True)
        codes, distinct = words.distinct()
        self.number = {w: i + 1 for i, w in enumerate(distinct)}
        self.items = sorted({name for name, _ in items})
        place = {name: i for i, name in enumerate(self.items)}
        by_length: dict[int, dict[tuple[int, ...], set[int]]] = {}
        codes = (codes + 1).tolist()
        for k, (name, _) in enumerate(items):
            own = codes[words.bounds[k]:words.bounds[k + 1]]
            m = min(size, len(own))
            for s in range(len(own) - m + 1 if m else 0):
                by_length.setdefault(m, {}).setdefault(tuple(own[s:s + m]), set()).add(place[name])
        self.searchers = [Searcher(m, p, len(distinct)) for m, p in sorted(by_length.items())]


def benchmark_parts(benchmark: DataFrame, part_words: int = PART_WORDS) -> list[list[tuple[str, bytes]]]:
    """The items in parts of a bounded number of words (an item is never cut)."""
    rows = (benchmark.where("item_id is not null")
            .select(F.col("item_id").cast("string").alias("name"), F.col("text").cast("string").alias("text"),
                    (F.octet_length("text") / F.lit(2) + 1).alias("most")))
    total = int(rows.agg(F.sum("most")).first()[0] or 0)
    n = 1 + total // part_words
    if n == 1:
        found = [rows.select("name", "text").collect()]
    else:
        dealt = rows.withColumn("part", F.pmod(F.xxhash64("name", "text"), F.lit(n)))
        found = [dealt.where(F.col("part") == i).select("name", "text").collect() for i in range(n)]
    return [[(r["name"], (r["text"] or "").encode()) for r in part] for part in found]


def _scan(size: int, items: list[tuple[str, bytes]], names: tuple[str, str, str]) -> Callable:
    """A map over batches that fills in the number of words and adds one part's hits and item names."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Patterns(items, size)
        for batch in batches:
            at_words, at_hits, at_items = (batch.schema.get_field_index(x) for x in names)
            for part in W.text_slices(batch):
                words = W.split_words(part.column("text"), W.NOT_ALNUM, lower=True)
                codes, distinct = words.distinct()
                number = np.fromiter((found.number.get(w, 0) for w in distinct), np.int64, len(distinct))[codes]
                bounds = words.bounds.tolist()
                all_hits, all_items = part.column(at_hits).to_pylist(), part.column(at_items).to_pylist()
                for i, (start, stop) in enumerate(zip(bounds[:-1], bounds[1:])):
                    own = number[start:stop].tolist()
                    hit, which = set(all_hits[i] or ()), set(all_items[i] or ())
                    for s in found.searchers:
                        for end, item in s.occurrences(own):
                            hit.update(range(end - s.length, end))
                            which.update(found.items[x] for x in item)
                    all_hits[i], all_items[i] = sorted(hit), sorted(which)
                cols = part.columns
                for at, values in ((at_words, np.diff(words.bounds)), (at_hits, all_hits), (at_items, all_items)):
                    cols[at] = pa.array(values, batch.schema.field(at).type)
                yield pa.RecordBatch.from_arrays(cols, schema=batch.schema)

    return work


def find_leaks(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, part_words: int = PART_WORDS,
               names: tuple[str, str, str] = ("n_words", "hit_words", "hit_items")) -> DataFrame:
    """``docs`` with three more columns: number of words, numbers of the hit words, sorted items that occur."""
    bounded_batches(docs.sparkSession)
    out = docs.withColumn("text", F.col("text").cast("string"))
    for name, kind in zip(names, ("long", "array<int>", "array<string>")):
        out = out.withColumn(name, F.lit(None).cast(kind))
    for part in benchmark_parts(benchmark, part_words):
        out = out.mapInArrow(_scan(size, part, names), out.schema)
    return out


def drop_leaks(docs: DataFrame, benchmark: DataFrame, size: int = SIZE) -> DataFrame:
    """The documents in which no benchmark window occurs."""
    names = tuple(spare_name(docs, x) for x in ("n_words", "hit_words", "hit_items"))
    return find_leaks(docs, benchmark, size, names=names).where(F.size(names[1]) == 0).select(*docs.columns)


def op7_wu_manber_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    n_hit = F.size("hit_words").cast("long")
    return (find_leaks(docs, table(spark, sf_dir, "benchmark"))
            .select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("hit_items").cast("long").alias("n_items"),
                    F.sha2(F.concat_ws(",", "hit_items"), 256).alias("items_sha256"),
                    (n_hit > 0).alias("contaminated")))
