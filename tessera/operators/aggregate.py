"""Grouped counts and statistics, contingency tables, growth between periods.

All aggregates here are algebraic (count/sum/avg/stddev), so Spark plans a
partial (map-side) aggregate before the shuffle: a key holding a third of the
rows still ships one partial row per task, never its rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_by(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    """Row count per group (count(*), NULL keys form their own group)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def summarize_group(df: DataFrame, keys: Sequence[str], **aggs: Column) -> DataFrame:
    """groupBy + named aggregates (dplyr ``summarize`` in one call)."""
    return df.groupBy(*keys).agg(*[expr.alias(name) for name, expr in aggs.items()])


def contingency_long(df: DataFrame, a: str, b: str, name: str = "n") -> DataFrame:
    return count_by(df, [a, b], name)


def contingency_wide(df: DataFrame, row: str, col: str, levels: Sequence, other: str = "other") -> DataFrame:
    """Wide table of counts, one column per listed level and one for all other values, NULL included.

    Fixed column levels avoid a distinct-values job; no row is left out.
    """
    c = F.col(col)
    listed = F.coalesce(c.isin(list(levels)), F.lit(False))
    return df.groupBy(row).agg(*[F.count_if(c == F.lit(v)).alias(str(v)) for v in levels],
                               F.count_if(~listed).alias(other))


def equal_width_bins(df: DataFrame, col: str, n_bins: int, lo: float, hi: float,
                     bin_col: str = "bin") -> DataFrame:
    """Assign equal-width bins over [lo, hi]; the last bin is closed on the right, values outside get NULL."""
    c = F.col(col)
    b = F.floor((c - F.lit(lo)) / F.lit(hi - lo if hi > lo else 1.0) * F.lit(n_bins))
    return df.withColumn(bin_col, F.when((c >= F.lit(lo)) & (c <= F.lit(hi)), F.least(b, F.lit(n_bins - 1))).cast("int"))


def histogram(df: DataFrame, col: str, n_bins: int = 30) -> DataFrame:
    """Counts per equal-width bin between the column's min and max; the last bin is closed.

    The bounds are scalar subqueries over the same column (Catalyst merges them
    into one aggregate), so the whole histogram is one lazy plan: no driver
    round trip and no join. An all-NULL column gives no rows.
    """
    vals = df.select(F.col(col).cast("double").alias("v")).filter(F.col("v").isNotNull())
    lo = vals.agg(F.min("v")).scalar()
    hi = vals.agg(F.max("v")).scalar()
    span = F.when(hi > lo, hi - lo).otherwise(F.lit(1.0))
    b = F.least(F.floor((F.col("v") - lo) / span * F.lit(n_bins)), F.lit(n_bins - 1)).cast("int")
    return (vals.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
            .withColumn("lo", lo + F.col("bin") * (hi - lo) / F.lit(n_bins))
            .withColumn("hi", lo + (F.col("bin") + 1) * (hi - lo) / F.lit(n_bins)))


def bucketed_mean_curve(df: DataFrame, x: str, y: str, n_bins: int, lo: float, hi: float,
                        smooth: int = 1) -> DataFrame:
    """Mean of y per equal-width x bucket of [lo, hi] plus a centred moving mean over buckets.

    The moving mean is a window over at most ``n_bins`` aggregated rows, so
    its single partition is bounded by construction.
    """
    from pyspark.sql import Window

    binned = equal_width_bins(df.select(x, y), x, n_bins, lo, hi).filter("bin is not null")
    per_bin = binned.groupBy("bin").agg(F.count(F.lit(1)).alias("n"),
                                        F.sum(y).alias("_sy"),
                                        F.avg(x).alias("x_mean"),
                                        F.avg(y).alias("y_mean"))
    w = Window.orderBy("bin").rowsBetween(-smooth, smooth)
    return (per_bin
            .withColumn("y_smooth", F.sum("_sy").over(w) / F.sum("n").over(w))
            .drop("_sy"))


def local_regression_curve(df: DataFrame, x: str, y: str, n_bins: int, lo: float, hi: float, span: float) -> DataFrame:
    """Local linear regression of y on x at the centre of each of ``n_bins`` buckets of [lo, hi], with standard errors.

    Rows are reduced to moments per bucket (about its centre), so whatever follows works
    on at most ``n_bins`` rows. At a centre g the buckets less than ``span`` of the range away
    weigh (1 - (distance / reach)^3)^3, and a line is fitted to their moments:
    columns x, n (rows within reach), y_smooth, slope, std_error. The error is that of the
    fitted value for independent rows whose variance is the weighted mean squared residual. Where
    all rows within reach have one x, y_smooth is their weighted mean and the rest NULL.
    """
    width = (hi - lo) / n_bins
    reach = span * n_bins  # in buckets
    binned = equal_width_bins(df.select(F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y")),
                              "_x", n_bins, lo, hi).where("bin is not null and _y is not null")
    d = F.col("_x") - (F.lit(lo) + (F.col("bin") + 0.5) * F.lit(width))
    cells = binned.groupBy("bin").agg(F.count(F.lit(1)).alias("m"), F.sum(d).alias("d1"), F.sum(d * d).alias("d2"),
                                      F.sum("_y").alias("y1"), F.sum(d * F.col("_y")).alias("dy"),
                                      F.sum(F.col("_y") * F.col("_y")).alias("y2"))
    far = int(reach) if reach > int(reach) else int(reach) - 1  # weights at the reach itself are zero
    near = F.explode(F.sequence(F.greatest(F.col("bin") - far, F.lit(0)), F.least(F.col("bin") + far, F.lit(n_bins - 1))))
    shift = (F.col("bin") - F.col("at")) * F.lit(width)
    gap = F.abs(F.col("bin") - F.col("at")) / F.lit(reach)
    tricube = F.pow(1 - F.pow(gap, F.lit(3)), F.lit(3))
    moved = (cells.withColumn("at", near).withColumns({"w": tricube, "s": shift})
             .withColumns({"u1": F.col("d1") + F.col("m") * F.col("s"),
                           "u2": F.col("d2") + 2 * F.col("s") * F.col("d1") + F.col("m") * F.col("s") * F.col("s"),
                           "uy": F.col("dy") + F.col("s") * F.col("y1")}))
    w = F.col("w")
    sums = moved.groupBy("at").agg(
        F.sum("m").alias("n"), *[F.sum(w * F.col(c)).alias(f"w_{c}") for c in ("m", "u1", "u2", "y1", "uy", "y2")],
        *[F.sum(w * w * F.col(c)).alias(f"q_{c}") for c in ("m", "u1", "u2")])
    det = F.col("w_m") * F.col("w_u2") - F.col("w_u1") * F.col("w_u1")
    line = sums.withColumn("det", F.when(det > F.lit(1e-12) * F.col("w_m") * F.col("w_u2"), det)).withColumns({
        "a": (F.col("w_u2") * F.col("w_y1") - F.col("w_u1") * F.col("w_uy")) / F.col("det"),
        "b": (F.col("w_m") * F.col("w_uy") - F.col("w_u1") * F.col("w_y1")) / F.col("det")})
    left = F.greatest(F.col("w_y2") - F.col("a") * F.col("w_y1") - F.col("b") * F.col("w_uy"), F.lit(0.0)) / F.col("w_m")
    spread = (F.col("w_u2") * F.col("w_u2") * F.col("q_m") - 2 * F.col("w_u1") * F.col("w_u2") * F.col("q_u1")
              + F.col("w_u1") * F.col("w_u1") * F.col("q_u2")) / (F.col("det") * F.col("det"))
    return line.select((F.lit(lo) + (F.col("at") + 0.5) * F.lit(width)).alias("x"), "n",
                       F.coalesce("a", F.col("w_y1") / F.col("w_m")).alias("y_smooth"), F.col("b").alias("slope"),
                       F.when(F.col("det").isNotNull(), F.sqrt(left * F.greatest(spread, F.lit(0.0)))).alias("std_error"))
