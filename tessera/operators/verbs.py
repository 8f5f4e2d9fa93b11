"""Relational verbs: merge with suffixes, renames, filters, sorts, set ops.

Thin on purpose: each is one or two DataFrame calls so Catalyst sees the whole
plan (pushdown, pruning, broadcast choice, top-k without a full sort).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def merge_by(left: DataFrame, right: DataFrame, by: str | Sequence[str],
             suffixes: tuple[str, str] = ("_x", "_y"), how: str = "inner") -> DataFrame:
    """Join on shared key columns; *every* shared column, key included, gets a suffix.

    This mirrors a merge whose key shows up as ``key_x`` and ``key_y``. NULL
    keys never match (plain equality), as in an inner equi-join.
    """
    keys = [by] if isinstance(by, str) else list(by)
    shared = set(left.columns) & set(right.columns)
    lx, ry = suffixes
    l2 = left.select([F.col(c).alias(c + lx if c in shared else c) for c in left.columns])
    r2 = right.select([F.col(c).alias(c + ry if c in shared else c) for c in right.columns])
    cond = [l2[k + lx] == r2[k + ry] for k in keys]
    return l2.join(r2, cond, how)


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename columns (e.g. the default ``count`` of a grouped count)."""
    return df.withColumnsRenamed(mapping)


def filter_not_equal(df: DataFrame, col: str, value) -> DataFrame:
    """Rows where col != value; NULL compares unknown and is dropped."""
    return df.filter(F.col(col) != F.lit(value))


def filter_equal(df: DataFrame, col: str, value) -> DataFrame:
    return df.filter(F.col(col) == F.lit(value))


def filter_range(df: DataFrame, col: str, lo, hi) -> DataFrame:
    """Inclusive range filter with caller-supplied bounds (pushed to the scan)."""
    return df.filter(F.col(col).between(F.lit(lo), F.lit(hi)))


def filter_all_equal(df: DataFrame, **equalities) -> DataFrame:
    """Conjunction of column == value tests, e.g. origin and destination."""
    cond: Column | None = None
    for col, value in equalities.items():
        term = F.col(col) == F.lit(value)
        cond = term if cond is None else (cond & term)
    return df if cond is None else df.filter(cond)


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """First k rows by an ordering; planned as TakeOrderedAndProject (no full sort)."""
    return df.orderBy(*order).limit(k)


def except_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    """Set difference with SQL EXCEPT semantics: distinct, NULL equals NULL."""
    return a.subtract(b)


def union_rows(*frames: DataFrame) -> DataFrame:
    """Stack same-named tables, keeping duplicates (UNION ALL by name)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def drop_missing(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    return df.dropna(how="any", subset=list(cols) if cols else None)


def update_from(df: DataFrame, side: DataFrame, key: str, updates: dict[str, Column],
                flag: str | None = None) -> DataFrame:
    """Keyed update: rows whose key is in ``side`` get ``updates`` applied.

    ``side`` should hold at most one row per key (see :func:`one_per_key`).
    ``updates`` expressions may reference side columns; unmatched rows keep
    their values. ``flag`` names a boolean column marking matched rows.
    """
    marker = "__matched"
    s = side.withColumn(marker, F.lit(True))
    joined = df.join(s, on=key, how="left")
    hit = F.coalesce(F.col(marker), F.lit(False))
    out = joined
    for col, expr in updates.items():
        out = out.withColumn(col, F.when(hit, expr).otherwise(F.col(col)))
    if flag:
        out = out.withColumn(flag, hit)
    keep = list(df.columns) + ([flag] if flag and flag not in df.columns else [])
    return out.select(*keep)


def one_per_key(side: DataFrame, key: str, value: str) -> DataFrame:
    """Collapse duplicate keys of a side table keeping the smallest value."""
    return side.groupBy(key).agg(F.min(value).alias(value))
