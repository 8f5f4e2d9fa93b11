"""Source, sink and catalog queries: each writes what it reads to a fresh path
in the shared scratch area, then returns the read-back table."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from tessera.operators.apply import bounded_collect
from tessera.plans import relational as rel
from tessera.plans.registry import query
from tessera.session import scratch_path
from tessera.sources import files as io
from tessera.sources.tables import table

PART_SCHEMA = StructType([
    StructField("p_partkey", LongType()), StructField("p_name", StringType()),
    StructField("p_brand", StringType()), StructField("p_type", StringType()),
    StructField("p_size", IntegerType()), StructField("p_retailprice", DoubleType()),
])


@query("csv_scan_string", """
SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name, CAST(n_regionkey AS VARCHAR) AS n_regionkey FROM nation
""")
def csv_scan_string(spark, sf):
    path = io.write_csv(table(spark, sf, "nation"), scratch_path(spark, "nation-csv"))
    return io.read_csv_strings(spark, path)


@query("csv_scan_schema", "SELECT * FROM part")
def csv_scan_schema(spark, sf):
    path = io.write_csv(table(spark, sf, "part"), scratch_path(spark, "part-csv"))
    return io.read_csv_schema(spark, path, PART_SCHEMA)


@query("csv_scan_infer", """
SELECT CAST(p_partkey AS INTEGER) AS p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part
""")
def csv_scan_infer(spark, sf):
    path = io.write_csv(table(spark, sf, "part"), scratch_path(spark, "part-csv"))
    return io.read_csv_infer(spark, path)


@query("csv_na_as_null", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS o_orderstatus,
       round(o_totalprice, 2) AS o_totalprice FROM orders
""")
def csv_na_as_null(spark, sf):
    o = table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", F.lit(io.NA_TEXT)).otherwise(F.col("o_orderstatus"))
        .alias("o_orderstatus"),
        F.round("o_totalprice", 2).alias("o_totalprice"))
    path = io.write_csv(o, scratch_path(spark, "orders-csv"))
    return io.read_csv_schema(spark, path, "o_orderkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE")


@query("copy_to_named", "SELECT r_regionkey, r_name FROM region")
def copy_to_named(spark, sf):
    """A table with dotted names copied in under a view, 5 partitions; no row passes the driver."""
    dotted = table(spark, sf, "region").select(F.col("r_regionkey").alias("r.regionkey"), F.col("r_name").alias("r.name"))
    return io.copy_to(spark, dotted, io.unique_name("copied_region"), partitions=5)


@query("table_scan", "SELECT * FROM supplier")
def table_scan(spark, sf):
    name = io.register_view(table(spark, sf, "supplier"), io.unique_name("supplier_v"))
    return spark.sql(f"SELECT * FROM {name}")


@query("temp_view_sql", """
SELECT l_returnflag, count(*) AS n, round(avg(l_quantity), 6) AS qty_avg FROM lineitem GROUP BY 1
""")
def temp_view_sql(spark, sf):
    name = io.register_view(table(spark, sf, "lineitem"), io.unique_name("lineitem_v"))
    return spark.sql(f"SELECT l_returnflag, count(*) AS n, round(avg(l_quantity), 6) AS qty_avg "
                     f"FROM {name} GROUP BY l_returnflag")


@query("write_read_path", rel.URBAN_GROWTH_SQL)
def write_read_path(spark, sf):
    """Default-mode write (fails if the path exists) then read back."""
    path = io.write_path(rel.urban_growth(spark, sf), scratch_path(spark, "growth"))
    return io.read_path(spark, path)


GROUP_COUNT_SQL = """
SELECT n_name, count(*) AS n_orders
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1
"""


@query("external_table", GROUP_COUNT_SQL)
def external_table(spark, sf):
    path = io.write_path(rel.group_count(spark, sf), scratch_path(spark, "orders-by-nation"))
    ws = io.ensure_workspace(spark)
    return io.create_external_table(spark, f"{ws}.{io.unique_name('orders_by_nation')}", path)


@query("drop_keeps_files", GROUP_COUNT_SQL)
def drop_keeps_files(spark, sf):
    """Dropping an external table removes the name, not the files."""
    path = io.write_path(rel.group_count(spark, sf), scratch_path(spark, "orders-by-nation"))
    ws = io.ensure_workspace(spark)
    name = f"{ws}.{io.unique_name('orders_by_nation')}"
    io.create_external_table(spark, name, path)
    io.drop_table(spark, name)
    return io.read_path(spark, path)


@query("ctas_table", "SELECT c_mktsegment, count(*) AS n_customers FROM customer GROUP BY 1")
def ctas_table(spark, sf):
    view = io.register_view(table(spark, sf, "customer"), io.unique_name("customer_v"))
    ws = io.ensure_workspace(spark)
    return io.create_table_as(spark, f"{ws}.{io.unique_name('segments')}",
                              f"SELECT c_mktsegment, count(*) AS n_customers FROM {view} GROUP BY c_mktsegment")


# fixed value: lineitem's columns and their Spark type names, in table order
LINEITEM_TYPES = [("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"),
                  ("l_linenumber", "int"), ("l_quantity", "double"), ("l_extendedprice", "double"),
                  ("l_discount", "double"), ("l_tax", "double"), ("l_returnflag", "string"),
                  ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz")]


@query("schema_table", "\nUNION ALL\n".join(
    f"SELECT {i + 1} AS position, '{c}' AS name, '{t}' AS type, count({c}) AS non_null FROM lineitem"
    for i, (c, t) in enumerate(LINEITEM_TYPES)))
def schema_table(spark, sf):
    """(position, name, type, non-NULL count) of lineitem's columns."""
    li = table(spark, sf, "lineitem")
    counts = li.agg(*[F.count(c).alias(c) for c in li.columns])
    rows = [F.struct(F.lit(i + 1).alias("position"), F.lit(f.name).alias("name"),
                     F.lit(f.dataType.simpleString()).alias("type"), F.col(f.name).alias("non_null"))
            for i, f in enumerate(li.schema.fields)]
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


@query("partition_layout", "SELECT CAST(10 AS BIGINT) AS n_partitions, count(*) AS n_rows FROM orders")
def partition_layout(spark, sf):
    """Partitions that hold rows, and rows, after repartition(10)."""
    o = table(spark, sf, "orders").select("o_orderkey").repartition(10)
    per = o.groupBy(F.spark_partition_id().alias("partition")).agg(F.count(F.lit(1)).alias("n"))
    return per.agg(F.count(F.lit(1)).alias("n_partitions"), F.sum("n").alias("n_rows"))
