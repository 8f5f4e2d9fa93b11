"""Edge tables: NULL keys, duplicates under EXCEPT, suffixes, "NA" text, keyed updates."""

from pyspark.sql import functions as F

from tessera.functions.scalar import code_map, round_half, threshold_class
from tessera.operators import aggregate as agg
from tessera.operators import verbs as vb
from tessera.session import scratch_path
from tessera.sources import files as io


def test_except_is_distinct_and_null_safe(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (None,), (3,)], "x int")
    b = spark.createDataFrame([(2,), (None,)], "x int")
    assert sorted(r[0] for r in vb.except_distinct(a, b).collect()) == [1, 3]
    assert vb.union_rows(a, b).count() == 7


def test_merge_by_suffixes_and_null_keys(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, n long")
    right = spark.createDataFrame([("a", 10), (None, 30)], "k string, n long")
    out = vb.merge_by(left, right, "k")
    assert out.columns == ["k_x", "n_x", "k_y", "n_y"]
    assert [tuple(r) for r in out.collect()] == [("a", 1, "a", 10)]


def test_group_count_keeps_null_group(spark):
    df = spark.createDataFrame([("a",), (None,), (None,)], "k string")
    got = {r["k"]: r["n"] for r in agg.count_by(df, ["k"]).collect()}
    assert got == {"a": 1, None: 2}


def test_stddev_of_one_row_group_is_null(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("b", 4.0)], "k string, v double")
    got = {r["k"]: r["sd"] for r in agg.summarize_group(df, ["k"], sd=F.stddev_samp("v")).collect()}
    assert got["a"] is None and abs(got["b"] - 2 ** 0.5) < 1e-12


def test_scalar_helpers(spark):
    df = spark.createDataFrame([(2.25, "A"), (-2.25, "X"), (None, None)], "x double, f string")
    r = df.select(round_half("x").alias("h"), threshold_class("x", 0.5).alias("c"),
                  code_map("f", {"A": "AC"}, "NA").alias("code")).collect()
    assert [tuple(x) for x in r] == [(2.5, 1, "AC"), (-2.5, 0, "NA"), (None, None, "NA")]


def test_update_from_keeps_unmatched(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 6.0)], "k int, t double")
    side = vb.one_per_key(spark.createDataFrame([(1, 2.0), (1, 1.0)], "k int, s double"), "k", "s")
    out = {r["k"]: r for r in vb.update_from(df, side, "k", {"t": F.col("s")}, flag="hit").collect()}
    assert (out[1]["t"], out[1]["hit"]) == (1.0, True) and (out[2]["t"], out[2]["hit"]) == (6.0, False)


def test_csv_na_text_and_empty(spark):
    path = scratch_path(spark, "edge-csv")
    df = spark.createDataFrame([("a", "NA"), ("NA", "x"), ("", "y")], "k string, v string")
    io.write_csv(df, path)
    back = {tuple(r) for r in io.read_csv_strings(spark, path).collect()}
    assert ("a", None) in back and (None, "x") in back


def test_write_default_mode_refuses_existing_path(spark):
    import pytest

    path = scratch_path(spark, "twice")
    df = spark.range(3)
    io.write_path(df, path)
    with pytest.raises(Exception):
        io.write_path(df, path)
    assert io.read_path(spark, path).count() == 3


def test_copy_to_cleans_dotted_names(spark):
    import pandas as pd

    out = io.copy_to(spark, pd.DataFrame({"Sepal.Length": [1.0, 2.0]}), io.unique_name("iris"), partitions=2)
    assert out.columns == ["Sepal_Length"] and out.count() == 2


def test_namespace_use_and_external_table(spark):
    ws = io.ensure_workspace(spark, "tessera_ns_test")
    before = spark.catalog.currentDatabase()
    path = io.write_path(spark.range(4).withColumnRenamed("id", "k"), scratch_path(spark, "ns"))
    try:
        io.use_namespace(spark, ws)
        name = io.unique_name("t")
        io.create_external_table(spark, name, path)  # unqualified: lands in the current database
        assert spark.catalog.tableExists(f"{ws}.{name}")
        assert spark.table(name).count() == 4
        io.drop_table(spark, name)
        assert io.read_path(spark, path).count() == 4  # files stay
    finally:
        io.use_namespace(spark, before)


def test_histogram_edges(spark):
    empty = spark.createDataFrame([(None,), (None,)], "v double")
    assert agg.histogram(empty, "v", 5).count() == 0
    const = spark.createDataFrame([(2.0,), (2.0,), (None,)], "v double")
    rows = agg.histogram(const, "v", 5).collect()
    assert [(r["bin"], r["n"]) for r in rows] == [(0, 2)]
    top = spark.createDataFrame([(0.0,), (1.0,), (10.0,)], "v double")
    got = {r["bin"]: r["n"] for r in agg.histogram(top, "v", 5).collect()}
    assert got == {0: 2, 4: 1}  # the maximum falls in the last, closed bin
