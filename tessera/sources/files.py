"""CSV and parquet readers/writers, catalog tables and temp views.

Paths passed here should live on shared storage (see session.scratch_path);
nothing is written to a machine-local folder unless the session says so.
"""

from __future__ import annotations

import re
import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tessera.session import scratch_path

# fixed value: the text that CSV readers treat as missing, as R's readers do
NA_TEXT = "NA"
DEFAULT_FORMAT = "parquet"  # table formats needing extra jars are not installed; the format is a parameter
WORKSPACE = "tessera_ws"


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    df.write.mode(mode).option("header", True).csv(path)
    return path


def read_csv_strings(spark: SparkSession, path: str) -> DataFrame:
    """Header row, every column read as text, "NA" read as missing."""
    return spark.read.option("header", True).option("nullValue", NA_TEXT).csv(path)


def read_csv_schema(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Explicit schema: no inference pass over the files."""
    return spark.read.schema(schema).option("header", True).option("nullValue", NA_TEXT).csv(path)


def read_csv_infer(spark: SparkSession, path: str) -> DataFrame:
    """Types inferred from the data (costs one extra pass over the files)."""
    return (spark.read.option("header", True).option("inferSchema", True)
            .option("nullValue", NA_TEXT).csv(path))


def clean_names(names) -> list[str]:
    """Column names without dots (Sepal.Length -> Sepal_Length)."""
    return [re.sub(r"[.\s]", "_", str(n)) for n in names]


def copy_to(spark: SparkSession, data: DataFrame | pd.DataFrame, name: str, partitions: int | None = None,
            overwrite: bool = True) -> DataFrame:
    """Put a table under a view name with dot-free column names, in ``partitions`` partitions.

    A Spark table stays distributed; a pandas table is what the driver already holds.
    """
    if not overwrite and spark.catalog.tableExists(name):
        raise ValueError(f"view {name} exists")
    df = data if isinstance(data, DataFrame) else spark.createDataFrame(data)
    df = df.toDF(*clean_names(df.columns))
    if partitions:
        df = df.repartition(partitions)
    df.createOrReplaceTempView(name)
    return spark.table(name)


def write_path(df: DataFrame, path: str, fmt: str = DEFAULT_FORMAT, mode: str = "errorifexists") -> str:
    """Write to a path; by default fail if something is already there."""
    df.write.format(fmt).mode(mode).save(path)
    return path


def read_path(spark: SparkSession, path: str, fmt: str = DEFAULT_FORMAT) -> DataFrame:
    return spark.read.format(fmt).load(path)


def ensure_workspace(spark: SparkSession, schema: str = WORKSPACE) -> str:
    """CREATE SCHEMA IF NOT EXISTS, located in the shared scratch area."""
    loc = scratch_path(spark, f"schema-{schema}")
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema} LOCATION '{loc}'")
    return schema


def use_namespace(spark: SparkSession, schema: str) -> None:
    """USE a database (changes the session's current database)."""
    spark.catalog.setCurrentDatabase(schema)


def unique_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:10]}"


def create_external_table(spark: SparkSession, name: str, path: str, fmt: str = DEFAULT_FORMAT) -> DataFrame:
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING {fmt} LOCATION '{path}'")
    return spark.table(name)


def drop_table(spark: SparkSession, name: str) -> None:
    """DROP TABLE IF EXISTS; an external table's files stay where they are."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def create_table_as(spark: SparkSession, name: str, select_sql: str, fmt: str = DEFAULT_FORMAT) -> DataFrame:
    """Managed table from a query (CTAS)."""
    spark.sql(f"CREATE TABLE {name} USING {fmt} AS {select_sql}")
    return spark.table(name)


def register_view(df: DataFrame, name: str) -> str:
    df.createOrReplaceTempView(name)
    return name
