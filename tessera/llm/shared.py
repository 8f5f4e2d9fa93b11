"""Small helpers of the operators: table access, scratch stages, column names, batch bounds."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tessera.session import materialize, release
from tessera.sources.tables import table

__all__ = ["batch_rows", "bounded_batches", "materialize", "release", "spare_name", "table"]

BATCH_ROWS = 2000
BATCH_BYTES = 32 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches handed to Python, so that long texts cannot pile up in one batch."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


@contextmanager
def batch_rows(spark: SparkSession, rows: int):
    """Jobs run inside hand Python at most ``rows`` rows a batch; the session's own setting comes back."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def spare_name(df: DataFrame, base: str) -> str:
    """A column name that no column of ``df`` has, whatever its case."""
    have = {c.lower() for c in df.columns}
    name = base
    while name.lower() in have:
        name += "_"
    return name
