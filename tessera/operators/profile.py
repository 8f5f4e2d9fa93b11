"""Column profiles: describe (count, mean, sd, min, max) and exact quartiles.

``DataFrame.summary()`` gives approximate percentiles as strings. Here the
profile is typed and long (one row per column), and quartiles are exact
(linear interpolation between order statistics, like quantile_cont) without
sorting the table in one task: values are reduced to (value, multiplicity),
ranked by a distributed running sum, and only the rows holding the wanted
ranks (two per probability) reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from tessera.operators.cumulative import WINDOW_LIMIT, materialize_planned, running_sums


def describe_long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One scan computes every statistic of every column; then one row per column."""
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.count(c).alias(f"c{i}"), F.avg(c).alias(f"m{i}"), F.stddev_samp(c).alias(f"s{i}"),
                 F.min(c).cast("double").alias(f"lo{i}"), F.max(c).cast("double").alias(f"hi{i}")]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(f"c{i}").alias("count"),
                     F.col(f"m{i}").alias("mean"), F.col(f"s{i}").alias("stddev"),
                     F.col(f"lo{i}").alias("min"), F.col(f"hi{i}").alias("max"))
            for i, c in enumerate(cols)]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float]) -> dict[float, float | None]:
    """Exact quantiles of one column (NULLs ignored), interpolated like quantile_cont."""
    vals = df.select(F.col(col).cast("double").alias("v")).filter(F.col("v").isNotNull())
    counts = vals.groupBy("v").agg(F.count(F.lit(1)).alias("w"))
    ranked = running_sums(counts, [], "v", ["w"], prefix="cum_")
    ranked = ranked.persist()
    try:
        n = ranked.agg(F.sum("w")).first()[0]
        if not n:
            return {p: None for p in probs}
        wanted = set()
        for p in probs:
            pos = (n - 1) * p
            wanted.update({math.floor(pos), math.ceil(pos)})
        cond = None
        for k in sorted(wanted):
            t = (F.col("cum_w") - F.col("w") <= F.lit(k)) & (F.lit(k) < F.col("cum_w"))
            cond = t if cond is None else (cond | t)
        rows = ranked.filter(cond).select("v", "w", "cum_w").collect()  # <= 2 per probability
    finally:
        ranked.unpersist()

    def at(k: int) -> float:
        for r in rows:
            if r["cum_w"] - r["w"] <= k < r["cum_w"]:
                return r["v"]
        raise AssertionError("rank not found")

    out = {}
    for p in probs:
        pos = (n - 1) * p
        lo, hi = at(math.floor(pos)), at(math.ceil(pos))
        out[p] = lo + (hi - lo) * (pos - math.floor(pos))
    return out


def exact_quantiles_many(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                         limit: int = WINDOW_LIMIT, distinct: dict | None = None) -> dict[str, dict]:
    """Exact quantiles (interpolated like quantile_cont) of several columns.

    One small aggregate measures each column's distinct count. Columns with at
    most ``limit`` distinct values use Spark's exact ``percentile`` aggregate:
    its per-task state is a value -> count map, bounded by that count. The
    others are stacked into (column, value) rows, reduced to multiplicities
    and ranked by one distributed running count keyed by column; only the rows
    holding wanted ranks (at most two per column and probability) reach the
    driver.
    """
    nd = distinct if distinct is not None else \
        df.agg(*[F.approx_count_distinct(c, 0.05).alias(c) for c in cols]).first().asDict()
    small = [c for c in cols if (nd[c] or 0) <= limit]
    large = [c for c in cols if c not in small]
    out: dict[str, dict] = {}
    if small:
        r = df.agg(*[F.percentile(F.col(c).cast("double"), list(probs)).alias(c) for c in small]).first()
        for c in small:
            out[c] = dict(zip(probs, r[c])) if r[c] is not None else {p: None for p in probs}
    if large:
        out.update(_ranked_quantiles(df, large, probs))
    return out


def _ranked_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> dict[str, dict]:
    stacked = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("v")) for c in cols])).alias("s"))
    counts = (stacked.select("s.column_name", "s.v").filter(F.col("v").isNotNull())
              .groupBy("column_name", "v").agg(F.count(F.lit(1)).alias("w")))
    # written once (its running-sum plan decided on the written table), then
    # read by the block totals and the local sums instead of re-scanning
    counts, plan = materialize_planned(counts, "v")
    ranked = running_sums(counts, ["column_name"], "v", ["w"], prefix="cum_", method=plan)
    ranked = ranked.persist()
    try:
        # the running count at a column's largest value is its number of values
        n_by = {r["column_name"]: r["n"] for r in
                ranked.groupBy("column_name").agg(F.max(F.col("cum_w")).alias("n")).collect()}
        cond = None
        for c, n in n_by.items():
            for p in probs:
                pos = (n - 1) * p
                for k in {math.floor(pos), math.ceil(pos)}:
                    t = ((F.col("column_name") == F.lit(c)) & (F.col("cum_w") - F.col("w") <= F.lit(k))
                         & (F.lit(k) < F.col("cum_w")))
                    cond = t if cond is None else (cond | t)
        rows = ranked.filter(cond).select("column_name", "v", "w", "cum_w").collect() if cond is not None else []
    finally:
        ranked.unpersist()

    def at(c: str, k: int) -> float:
        for r in rows:
            if r["column_name"] == c and r["cum_w"] - r["w"] <= k < r["cum_w"]:
                return r["v"]
        raise AssertionError("rank not found")

    out = {}
    for c in cols:
        n = n_by.get(c)
        if not n:
            out[c] = {p: None for p in probs}
            continue
        out[c] = {}
        for p in probs:
            pos = (n - 1) * p
            lo, hi = at(c, math.floor(pos)), at(c, math.ceil(pos))
            out[c][p] = lo + (hi - lo) * (pos - math.floor(pos))
    return out


def summary_long(df: DataFrame, cols: Sequence[str], probs: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """describe_long plus exact quartile columns q25, q50, q75, one typed row per column.

    The describe statistics and each column's distinct count come from one
    scan (one row to the driver, bounded by the number of columns); the
    distinct counts choose the quantile path (see exact_quantiles_many).
    """
    spark = df.sparkSession
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.count(c).alias(f"c{i}"), F.avg(c).alias(f"m{i}"), F.stddev_samp(c).alias(f"s{i}"),
                 F.min(c).cast("double").alias(f"lo{i}"), F.max(c).cast("double").alias(f"hi{i}"),
                 F.approx_count_distinct(c, 0.05).alias(f"nd{i}")]
    wide = df.agg(*aggs).first()
    qs = exact_quantiles_many(df, cols, probs, distinct={c: wide[f"nd{i}"] for i, c in enumerate(cols)})
    names = [f"q{int(round(p * 100))}" for p in probs]
    rows = [(c, wide[f"c{i}"], wide[f"m{i}"], wide[f"s{i}"], wide[f"lo{i}"], *[qs[c][p] for p in probs],
             wide[f"hi{i}"]) for i, c in enumerate(cols)]
    schema = StructType([StructField("column_name", StringType(), False), StructField("count", LongType(), True),
                         StructField("mean", DoubleType(), True), StructField("stddev", DoubleType(), True),
                         StructField("min", DoubleType(), True)]
                        + [StructField(n, DoubleType(), True) for n in names]
                        + [StructField("max", DoubleType(), True)])
    return spark.createDataFrame(rows, schema)
