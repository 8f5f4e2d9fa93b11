"""Scalar column helpers.

All of these compose built-in functions, so they stay inside whole-stage
codegen; none of them calls back into Python.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def round_half(x: ColumnOrName) -> Column:
    """Bucket to the nearest half: ROUND(x * 2) / 2 (half away from zero)."""
    return F.round(_c(x) * 2) / 2


def threshold_class(x: ColumnOrName, cut: float = 0.5) -> Column:
    """Two-way class: 0 below ``cut``, 1 at or above it (NULL stays NULL)."""
    c = _c(x)
    return F.when(c < F.lit(cut), F.lit(0)).when(c >= F.lit(cut), F.lit(1))


def code_map(x: ColumnOrName, mapping: Mapping[str, str], default: str | None) -> Column:
    """Multi-branch mapping of values to codes with a default for the rest."""
    c = _c(x)
    expr = None
    for key, code in mapping.items():
        expr = (F.when(c == F.lit(key), F.lit(code)) if expr is None
                else expr.when(c == F.lit(key), F.lit(code)))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default))


def scaled(x: ColumnOrName, divisor: float) -> Column:
    """Unit scaling, e.g. totals in millions."""
    return _c(x) / F.lit(float(divisor))


def as_category(x: ColumnOrName) -> Column:
    """Treat a number as a category label (its text form)."""
    return _c(x).cast("string")


def rate_from_median(median: ColumnOrName) -> Column:
    """Exponential rate with the given median: ln(2) / median."""
    return F.log(F.lit(2.0)) / _c(median)


def ceil_of(x: ColumnOrName) -> Column:
    return F.ceil(_c(x))


def make_id(prefix: str, x: ColumnOrName) -> Column:
    """Identifier text such as ID_1, ID_2, ..."""
    return F.concat(F.lit(prefix), _c(x).cast("string"))


def no_negative_zero(x: ColumnOrName) -> Column:
    """Turn -0.0 into 0.0 (IEEE: -0.0 + 0.0 == +0.0)."""
    return _c(x) + F.lit(0.0)


def hash_u32(*parts: ColumnOrName, salt: str | Column = "", offset: int = 0, method: str = "md5") -> Column:
    """Unsigned 32-bit integer from 8 hex digits of md5 over the key text.

    md5 is chosen over xxhash64 because other engines (DuckDB) compute the
    same value, so samples and splits can be checked against SQL. ``offset``
    picks which 8 hex digits (0..3) are used, giving independent draws. Keys
    should be integers or text: engines print doubles differently.
    ``method="xxhash64"`` trades that SQL twin for speed (a JVM hash, no hex
    text): same uniformity, several times cheaper per row on large scans.
    """
    salt_c = salt if isinstance(salt, Column) else F.lit(salt)
    if method == "xxhash64":
        return F.pmod(F.xxhash64(*[_c(p) for p in parts], salt_c, F.lit(offset)), F.lit(1 << 32))
    if method != "md5":
        raise ValueError(f"unknown hash method {method!r}")
    key = F.concat_ws("|", *[_c(p).cast("string") for p in parts], salt_c)
    digits = F.substring(F.md5(key), 1 + 8 * offset, 8)
    return F.conv(digits, 16, 10).cast("bigint")
