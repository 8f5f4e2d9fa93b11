"""Best-fit packing of documents into sequences of a fixed number of tokens.

A document is its token ids followed by ``end_id``; only longer ones are cut,
into pieces of ``capacity``. How pieces go into sequences depends on their
lengths alone, so the plan is made on the histogram of lengths (``capacity``
rows at most, whatever the input):

* pieces above a third of the capacity pair at most two to a sequence: the
  largest left takes the largest left that fits beside it;
* smaller pieces, largest first, go where the gap is the smallest that holds
  them; a new sequence opens when no gap does.

A plan is a list of patterns with multiplicities. Each piece gets its rank
among the pieces of its length and the rank picks its place. Ranks are counted
per (length, block of a hash) with offsets from block totals, so one very
common length is not one task.

Defined cases: a null or empty text is the end id alone (one piece); repeated
rows are packed as rows of their own; equal lengths are interchangeable and
take places in order of block, doc_id and piece; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm import words as W
from tessera.llm.shared import bounded_batches, materialize, table
from tessera.llm.tokens import default_tokenizer, piece_table

CAPACITY = 2048
BLOCK_ROWS = 10_000


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0,
                 with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every document."""
    bounded_batches(docs.sparkSession)
    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
              ("ids_crc32", pa.int64())] + [("ids", pa.list_(pa.int64()))] * with_ids
    schema = pa.schema(fields)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = piece_table(tokenizer)
        for batch in batches:
            for part in W.text_slices(batch):
                raw, bounds = pieces.encode(part.column("text"))
                n = part.num_rows
                ids = np.full(len(raw) + n, end_id, np.uint32)
                ids[np.arange(len(raw)) + np.repeat(np.arange(n), np.diff(bounds))] = raw
                bounds = bounds + np.arange(n + 1)
                total = np.diff(bounds)
                count = -(-total // capacity)
                piece = W.expand(np.zeros(n, np.int64), count)
                begin = np.repeat(bounds[:-1], count) + piece * capacity
                end = np.minimum(begin + capacity, np.repeat(bounds[1:], count))
                data = memoryview(ids.astype("<u4").tobytes())
                crc = np.fromiter((zlib.crc32(data[4 * b:4 * e]) for b, e in zip(begin.tolist(), end.tolist())),
                                  np.int64, len(begin))
                owner = pa.array(np.repeat(np.arange(n), count))
                cols = [part.column("doc_id").take(owner), pa.array(piece.astype(np.int32)),
                        pa.array(piece * capacity), pa.array(end - begin), pa.array(crc)]
                if with_ids:  # the pieces of a slice lie one after another
                    cols.append(pa.ListArray.from_arrays(pa.array(np.r_[begin, end[-1:]].astype(np.int32)),
                                                         pa.array(ids.astype(np.int64))))
                yield pa.RecordBatch.from_arrays(cols, schema=schema)

    kind = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * with_ids
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(work, kind))


def plan_patterns(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[tuple[int, int]]]]:
    """[(sequences, [(length, copies), ...])]: best-fit packing of a histogram of lengths."""
    left = {n: c for n, c in histogram.items() if c}
    if any(not 0 < n <= capacity for n in left):
        raise ValueError("lengths must lie in 1..capacity")
    large = sorted(n for n in left if 3 * n > capacity)
    groups: dict[int, list[tuple[int, list[tuple[int, int]]]]] = {}  # gap -> patterns
    gaps: list[int] = []

    def put(gap: int, count: int, pattern: list[tuple[int, int]]) -> None:
        if gap not in groups:
            groups[gap] = []
            insort(gaps, gap)
        groups[gap].append((count, pattern))

    while large:
        n = large[-1]
        if not left[n]:
            large.pop()
            continue
        at = bisect_left(large, capacity - n + 1) - 1
        while at >= 0 and (not left[large[at]] or (large[at] == n and left[n] < 2)):
            at -= 1
        if at < 0:
            put(capacity - n, left[n], [(n, 1)])
            left[n] = 0
        elif (m := large[at]) == n:
            put(capacity - 2 * n, left[n] // 2, [(n, 2)])
            left[n] %= 2
        else:
            count = min(left[n], left[m])
            put(capacity - n - m, count, [(n, 1), (m, 1)])
            left[n] -= count
            left[m] -= count
    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        todo = left[n]
        while todo:
            at = bisect_left(gaps, n)
            if at == len(gaps):
                gap, count, pattern = capacity, -(-todo // (capacity // n)), []
            else:
                gap = gaps[at]
                count, pattern = groups[gap].pop()
                if not groups[gap]:
                    del groups[gap], gaps[at]
            each = gap // n
            full = min(count, todo // each)
            rest = todo - full * each if full < count else 0
            if full:
                put(gap - each * n, full, [*pattern, (n, each)])
            if rest:
                put(gap - rest * n, 1, [*pattern, (n, rest)])
            if pattern and count - full - bool(rest):
                put(gap, count - full - bool(rest), pattern)
            todo -= full * each + rest
    return [g for gap in gaps for g in groups[gap]]


class Places:
    """Place of the r-th piece of a length: sequence number and offset."""

    def __init__(self, patterns: list[tuple[int, list[tuple[int, int]]]]):
        by: dict[int, list[tuple[int, int, int, int]]] = {}
        used: dict[int, int] = {}
        base = 0
        for count, pattern in patterns:
            offset = 0
            for n, copies in pattern:
                by.setdefault(n, []).append((used.get(n, 0), base, copies, offset))
                used[n] = used.get(n, 0) + count * copies
                offset += n * copies
            base += count
        self.by = {n: np.array(rows, dtype=np.int64) for n, rows in by.items()}
        self.sequences = base

    def of(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
        for n in np.unique(length).tolist():
            at = np.flatnonzero(length == n)
            rows = self.by[n]
            row = rows[np.searchsorted(rows[:, 0], rank[at], side="right") - 1]
            step = rank[at] - row[:, 0]
            sequence[at] = row[:, 1] + step // row[:, 2]
            offset[at] = row[:, 3] + step % row[:, 2] * n
        return sequence, offset


def pack(pieces: DataFrame, capacity: int = CAPACITY, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``pieces`` (columns doc_id, piece, length, ids_crc32 and more) with sequence_id and offset.

    ``pieces`` is read several times: pass a written table.
    """
    histogram = {int(r["length"]): int(r["n"])  # at most ``capacity`` rows
                 for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    places = Places(plan_patterns(histogram, capacity))
    n_blocks = max(1, -(-sum(histogram.values()) // block_rows))
    blocked = pieces.withColumn("blk", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(n_blocks)).cast("int"))
    before = Window.partitionBy("length").orderBy("blk").rowsBetween(Window.unboundedPreceding, -1)
    totals = (blocked.groupBy("length", "blk").agg(F.count(F.lit(1)).alias("n"))
              .select("length", "blk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")))
    inside = Window.partitionBy("length", "blk").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (blocked.withColumn("r", F.row_number().over(inside) - 1).join(totals, ["length", "blk"])
              .withColumn("rank", F.col("r") + F.col("before")))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        sequence, offset = places.of(length.to_numpy(), rank.to_numpy())
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    # a task a block at most: a task that writes some hundred rows costs its executor more in files than in work
    return (ranked.coalesce(n_blocks).withColumn("at", place("length", "rank"))
            .select(*pieces.columns, F.col("at.sequence_id").alias("sequence_id"), F.col("at.offset").alias("offset")))


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0,
                   with_ids: bool = False) -> DataFrame:
    """One row per piece of every document with its place."""
    return pack(materialize(token_pieces(docs, tokenizer, capacity, end_id, with_ids)), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the packed sequences themselves, from rows packed ``with_ids``."""
    rows = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("rows"))
    return rows.select("sequence_id", F.flatten(F.col("rows.ids")).alias("ids"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), default_tokenizer())
