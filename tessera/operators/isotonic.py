"""Isotonic regression in rounds of range-wise pooling, without a whole column in one task.

Adjacent pools whose means fall are merged until the means rise. Merges may be done in
any order, so every range of x pools its own rows to the end in one pass; what
is left to merge lies across range borders, and the next round cuts the (far fewer)
pools elsewhere. It ends when all pools fit into one range, or when two rounds with
different borders have found nothing to merge.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.cumulative import block_of
from tessera.session import materialize

RANGE_ROWS = 100_000


def pool_adjacent(lo: np.ndarray, hi: np.ndarray, weight: np.ndarray, total: np.ndarray) -> list[tuple]:
    """(lo, hi, weight, total) of the pools of one run of pools in order; equal means are one pool."""
    stack: list[tuple] = []
    for a, b, w, t in zip(lo.tolist(), hi.tolist(), weight.tolist(), total.tolist()):
        while stack and stack[-1][3] * w >= t * stack[-1][2]:
            first, _, w0, t0 = stack.pop()
            a, w, t = first, w + w0, t + t0
        stack.append((a, b, w, t))
    return stack


def isotonic(df: DataFrame, x: str, y: str, weight: str | None = None, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Pools (lo, hi, weight, total): the rising step function of ``x`` nearest to ``y``; its value is total / weight.

    Rows with a missing value, or without positive weight, take no part.
    """
    w = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    rows = df.select(F.col(x).cast("double").alias("lo"), F.col(y).cast("double").alias("y"), w.alias("w")).where(
        "lo is not null and y is not null and w > 0")
    pools = materialize(rows.groupBy("lo").agg(F.sum("w").alias("weight"), F.sum(F.col("w") * F.col("y")).alias("total"))
                        .select("lo", F.col("lo").alias("hi"), "weight", "total"))
    n, still, odd = pools.count(), 0, False

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = None, [[] for _ in range(4)]

        def done() -> pa.RecordBatch:
            out = pool_adjacent(*(np.concatenate(c) for c in held))
            return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["lo", "hi", "weight", "total"])

        for batch in batches:
            blocks = batch.column("block").to_numpy()
            cuts = np.r_[0, np.flatnonzero(np.diff(blocks)) + 1, len(blocks)]
            for at, to in zip(cuts[:-1], cuts[1:]):
                if block is not None and blocks[at] != block:
                    yield done()
                    held = [[] for _ in range(4)]
                block = blocks[at]
                for c, name in zip(held, ("lo", "hi", "weight", "total")):
                    c.append(batch.column(name).to_numpy()[at:to])
        if block is not None:
            yield done()

    while True:
        n_blocks = -(-n // range_rows)
        # every second round moves the borders by half a range
        shares = [(i - 0.5 * odd) / n_blocks for i in range(1, n_blocks + odd)] if n_blocks > 1 else []
        cuts = pools.agg(F.percentile_approx("lo", shares, 10_000)).first()[0] if shares else []
        block = block_of(F.col("lo"), sorted(set(cuts)))
        ranges = pools.withColumn("block", block).repartition("block").sortWithinPartitions("block", "lo")
        pools = materialize(ranges.mapInArrow(work, "lo double, hi double, weight double, total double"))
        before, n = n, pools.count()
        still = still + 1 if n == before else 0
        if n_blocks <= 1 or still == 2:
            return pools
        odd = not odd
