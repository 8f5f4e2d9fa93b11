"""Arrow functions give the same answer at any batch size and equal the built-in path."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tessera.operators import apply as ap
from tessera.sources.tables import table


@pytest.mark.parametrize("batch", [3, 10000])
def test_partition_map_batch_invariant(spark, batch):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        li = table(spark, SF_SMALL, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
        got = ap.partition_code_map(li, "l_returnflag", {"A": "AC", "N": "NO", "R": "RE"}, "NA")
        counts = {(r[0], r[1]): r[2] for r in got.groupBy("l_returnflag", "code").count().collect()}
        assert counts[("A", "AC")] == li.filter("l_returnflag = 'A'").count()
        assert sum(counts.values()) == li.count()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("batch", [3, 10000])
def test_group_means_by_batches(spark, batch):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        df = spark.createDataFrame([("a", 1.0), ("a", None), ("a", 3.0), (None, 5.0), ("b", 2.0)] * 3,
                                   "k string, v double").repartition(4)
        got = {r["k"]: r["v"] for r in ap.group_means_by_batches(df, "k", ["v"]).collect()}
        exp = {r["k"]: r["v"] for r in df.groupBy("k").agg(F.avg("v").alias("v")).collect()}
        assert got == pytest.approx(exp)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_bounded_collect_refuses(spark):
    with pytest.raises(ValueError):
        ap.bounded_collect(spark.range(11), 10)
    assert len(ap.bounded_collect(spark.range(10), 10)) == 10


def test_group_means_integral_null_key(spark):
    df = spark.createDataFrame([(1, 2.0), (None, 4.0), (1, 4.0)], "k int, v double")
    got = {r["k"]: r["v"] for r in ap.group_means_by_batches(df, "k", ["v"]).collect()}
    assert got == {1: 3.0, None: 4.0}


def test_dense_index_is_dense_and_ordered(spark):
    from tessera.operators.ml import dense_index

    df = spark.createDataFrame([(5_000_000_000,), (7,), (7,), (3_000_000_000,), (None,)], "k bigint")
    got = {r["k"]: r["idx"] for r in dense_index(df, "k").collect()}
    assert got == {7: 0, 3_000_000_000: 1, 5_000_000_000: 2}


def test_group_apply_user_function(spark):
    import pandas as pd

    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 5.0)], "k string, v double")

    def stats(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"k": [pdf["k"].iloc[0]], "mean": [pdf["v"].mean()], "n": [len(pdf)]})

    out = {r["k"]: (r["mean"], r["n"]) for r in ap.group_apply(df, ["k"], stats, "k string, mean double, n long")
           .collect()}
    assert out == {"a": (2.0, 2), "b": (5.0, 1)}


def _batches(spark, rows):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


@pytest.mark.parametrize("batch,max_states", [(3, 10_000), (10_000, 10_000), (50, 2)])
def test_group_fold_with_a_hot_key_and_null_keys(spark, batch, max_states):
    """Count, sum and the three smallest values per key pair; one key holds most rows."""
    import heapq
    import random

    r = random.Random(batch)
    rows = [(1 if r.random() < 0.7 else r.choice([2, 3, None]), r.choice(["a", None]), r.randrange(1000)) for _ in range(3000)]
    df = spark.createDataFrame(rows, "k int, t string, v int").repartition(5)
    _batches(spark, batch)
    try:
        got = ap.group_fold(df, ["k", "t"], lambda: (0, 0, []),
                            lambda s, pdf: (s[0] + len(pdf), s[1] + int(pdf.v.sum()), heapq.nsmallest(3, [*s[2], *pdf.v.tolist()])),
                            lambda a, b: (a[0] + b[0], a[1] + b[1], heapq.nsmallest(3, a[2] + b[2])),
                            lambda s: (s[0], s[1], s[2]), "n bigint, total bigint, least array<bigint>", max_states).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = {}
    for k, t, v in rows:
        want.setdefault((k, t), []).append(v)
    assert {(x["k"], x["t"]): (x["n"], x["total"], x["least"]) for x in got} == {
        k: (len(v), sum(v), sorted(v)[:3]) for k, v in want.items()} and len(got) == len(want)
    assert ap.group_fold(df.limit(0), ["k"], int, lambda s, p: s, max, lambda s: (s,), "n bigint").count() == 0


@pytest.mark.parametrize("batch", [3, 10_000])
@pytest.mark.parametrize("parts", [1, 6])
def test_partition_fold_ends_once_per_partition(spark, batch, parts):
    import pyarrow as pa

    df = spark.range(1000).repartition(parts)
    _batches(spark, batch)
    try:
        ends = ap.partition_fold(df, lambda: (0, 0), lambda s, b: (s[0] + b.num_rows, max(s[1], max(b.column(0).to_pylist(), default=0))),
                                 lambda s: pa.table({"n": [s[0]], "most": [s[1]]}), "n bigint, most bigint").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(ends) == parts and sum(r["n"] for r in ends) == 1000 and max(r["most"] for r in ends) == 999


@pytest.mark.parametrize("batch", [7, 10_000])
def test_partition_top_at_any_batch_size(spark, batch):
    from tessera.plans.catalog import QUERIES

    _batches(spark, batch)
    try:
        got = sorted(tuple(r) for r in QUERIES["partition_top"](spark, SF_SMALL).collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    rows = table(spark, SF_SMALL, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber", "l_extendedprice").collect()
    want = []
    for flag in {r[0] for r in rows}:
        best = sorted((r for r in rows if r[0] == flag), key=lambda r: (-r[3], r[1], r[2]))[:5]
        want += [(*r, i + 1) for i, r in enumerate(best)]
    assert got == sorted(want)


def test_local_regression_follows_a_line_and_its_noise(spark):
    import random

    from tessera.operators.aggregate import local_regression_curve

    r = random.Random(3)
    line = spark.createDataFrame([(x / 7, 3.0 - 2 * x / 7) for x in range(70)] + [(None, 1.0), (2.0, None), (99.0, 5.0)],
                                 "x double, y double").repartition(4)
    for row in local_regression_curve(line, "x", "y", 12, 0.0, 10.0, 0.3).collect():
        assert row["y_smooth"] == pytest.approx(3 - 2 * row["x"]) and row["slope"] == pytest.approx(-2)
        assert row["std_error"] == pytest.approx(0, abs=1e-5)
    noisy = spark.createDataFrame([(x / 100, r.gauss(0, 1)) for x in range(1000)], "x double, y double")
    rows = local_regression_curve(noisy, "x", "y", 20, 0.0, 10.0, 0.25).collect()
    assert sum(abs(x["y_smooth"]) < 2.5 * x["std_error"] for x in rows) >= 17 and len(rows) == 20
    one = spark.createDataFrame([(5.0, 1.0), (5.0, 3.0)], "x double, y double")
    rows = local_regression_curve(one, "x", "y", 10, 0.0, 10.0, 0.2).collect()
    assert rows and all(x["y_smooth"] == pytest.approx(2) and x["slope"] is None and x["std_error"] is None for x in rows)
    assert local_regression_curve(line.limit(0), "x", "y", 5, 0.0, 1.0, 0.2).count() == 0


def test_group_fold_updates_grow_with_groups_not_with_batches_of_them(spark):
    """Every batch of the input holds every key; a state is the number of its updates and of its rows."""
    df = spark.range(4000).select((F.col("id") % 40).alias("k"), "id").repartition(4, "id")
    _batches(spark, 100)
    try:
        got = ap.group_fold(df, ["k"], lambda: (0, 0), lambda s, pdf: (s[0] + 1, s[1] + len(pdf)),
                            lambda a, b: (a[0] + b[0], a[1] + b[1]), lambda s: s, "updates bigint, n bigint").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(got) == 40 and all(r["n"] == 100 for r in got)
    assert sum(r["updates"] for r in got) <= 40 + 4000 // 100 + 8  # 40 a batch, 1600 in all, by the input's batches
