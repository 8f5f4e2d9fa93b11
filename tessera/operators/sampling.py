"""Reproducible sampling and splitting from a hash of the row key.

``DataFrame.sample``/``randomSplit`` draw per partition, so the same seed gives
different rows at different partition counts, and a sample followed by a
set difference on a recomputed input can disagree with itself. Here the draw
is a pure function of (key, seed): the same rows come out at any partitioning
and on any retry, and the train/test complement needs no join at all.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.scalar import hash_u32

_SPAN = 1 << 32


def bound(frac: float) -> int:
    """Draws below this 32-bit bound are kept with probability ``frac``."""
    if not 0.0 <= frac <= 1.0:
        raise ValueError("fraction must be within [0, 1]")
    return int(frac * _SPAN)


def hash_sample(df: DataFrame, keys: Sequence[str], frac: float, seed: int, method: str = "md5") -> DataFrame:
    """Bernoulli sample without replacement, deterministic in (key, seed)."""
    return df.filter(hash_u32(*keys, salt=str(seed), method=method) < F.lit(bound(frac)))


def hash_split(df: DataFrame, keys: Sequence[str], weights: Mapping[str, float], seed: int,
               label: str = "split", method: str = "md5") -> DataFrame:
    """Label every row with one part; parts get shares proportional to weights."""
    total = float(sum(weights.values()))
    h = hash_u32(*keys, salt=str(seed), method=method)
    names = list(weights)
    acc = 0.0
    expr: Column | None = None
    for name in names[:-1]:
        acc = min(1.0, acc + weights[name] / total)  # float sums may creep past 1
        cond = h < F.lit(bound(acc))
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    last = F.lit(names[-1])
    return df.withColumn(label, last if expr is None else expr.otherwise(last))


def stratified_sample(df: DataFrame, col: str, fractions: Mapping[str, float],
                      keys: Sequence[str], seed: int, method: str = "md5") -> DataFrame:
    """Per-stratum fractions (strata not listed are dropped), like sampleBy."""
    b: Column | None = None
    for k, f in fractions.items():
        cond = F.col(col) == F.lit(k)
        b = F.when(cond, F.lit(bound(f))) if b is None else b.when(cond, F.lit(bound(f)))
    b = F.lit(0) if b is None else b.otherwise(F.lit(0))
    return df.filter(hash_u32(*keys, salt=str(seed), method=method) < b)


def train_test_by_class(df: DataFrame, class_col: str, seeds: Mapping[str, int], frac: float,
                        keys: Sequence[str], label: str = "split", method: str = "md5") -> DataFrame:
    """Per class: a seeded ``frac`` sample is training, the rest of the class is test.

    Equivalent to sampling each class, taking ``class EXCEPT training`` and
    stacking, for rows unique by ``keys`` -- but in one pass, without the
    two shuffles of a set difference. Classes without a seed are dropped.
    """
    salt: Column | None = None
    for k, s in seeds.items():
        cond = F.col(class_col) == F.lit(k)
        salt = F.when(cond, F.lit(str(s))) if salt is None else salt.when(cond, F.lit(str(s)))
    kept = df.filter(F.col(class_col).isin(*seeds.keys()))
    h = hash_u32(*keys, salt=salt, method=method)
    return kept.withColumn(label, F.when(h < F.lit(bound(frac)), F.lit("training")).otherwise(F.lit("test")))
