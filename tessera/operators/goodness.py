"""One-sample Kolmogorov-Smirnov test from running counts over distinct values."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.stats import normal_cdf
from tessera.operators.cumulative import running_sums

# terms of the two series; each is good to 1e-16 on its side of SERIES_CUT
TAIL_TERMS = 8
SERIES_CUT = 1.0


def kolmogorov_tail(t: Column) -> Column:
    """P(K > t) of the limiting distribution of sqrt(n) * D, by the series that converges fast at ``t``."""
    far, near = F.lit(0.0), F.lit(0.0)
    for k in range(1, TAIL_TERMS + 1):
        far = far + F.lit(2.0 * (-1) ** (k - 1)) * F.exp(F.lit(-2.0 * k * k) * t * t)
        near = near + F.exp(F.lit(-((2 * k - 1) * math.pi) ** 2 / 8) / (t * t))
    return F.when(t <= 0, F.lit(1.0)).when(t < SERIES_CUT, 1 - F.lit(math.sqrt(2 * math.pi)) / t * near).otherwise(far)


def ks_normal(df: DataFrame, value: str, mean: float | None = None, sd: float | None = None) -> DataFrame:
    """(statistic, p_value, mean, sd, n): distance of the values' distribution from a normal one.

    Without ``mean`` and ``sd`` they are those of the values. Only distinct values and
    their counts are ordered, by a running sum that never puts them all in one task.
    Missing values take no part; without two different values the statistic is NULL.
    """
    counts = (df.where(F.col(value).isNotNull()).groupBy(F.col(value).cast("double").alias("v"))
              .agg(F.count(F.lit(1)).alias("c")))
    if mean is None or sd is None:
        got = df.agg(F.avg(value), F.stddev_samp(value)).first()
        mean, sd = (got[0] if mean is None else mean), (got[1] if sd is None else sd)
    mean, sd = (None if m is None else float(m) for m in (mean, sd))
    ranked = running_sums(counts, [], "v", ["c"])
    n = counts.agg(F.sum("c").alias("n")).first()["n"]
    cdf = normal_cdf((F.col("v") - F.lit(mean)) / F.lit(sd))
    gap = F.greatest(F.col("cum_c") / F.lit(n) - cdf, cdf - (F.col("cum_c") - F.col("c")) / F.lit(n))
    found = ranked.agg(F.max(gap).alias("statistic"))
    if not sd:
        found = found.select(F.lit(None).cast("double").alias("statistic"))
    return found.select("statistic", kolmogorov_tail(F.sqrt(F.lit(float(n or 0))) * F.col("statistic")).alias("p_value"),
                        F.lit(mean).cast("double").alias("mean"), F.lit(sd).cast("double").alias("sd"),
                        F.lit(n).cast("long").alias("n"))
