"""The stream resumes from the caller's paths and equals the batch aggregate."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tessera.plans.catalog import QUERIES
from tessera.sources.tables import table
from tessera.streaming.events import read_windows, run_available_now


def _events(spark, rows):
    base = dt.datetime(2024, 1, 1)
    return spark.createDataFrame([(base + dt.timedelta(minutes=m), k, v) for m, k, v in rows],
                                 "ts timestamp_ntz, kind string, value double")


def test_restart_goes_on_where_it_stopped(spark, tmp_path):
    src, out, ckpt = (str(tmp_path / x) for x in ("src", "out", "ckpt"))
    first = _events(spark, [(1, "a", 1.0), (2, "a", 2.0), (61, "b", 3.0), (70, "a", 4.0)])
    second = _events(spark, [(5, "a", 10.0), (65, "b", 5.0), (500, "a", 6.0)])
    first.coalesce(1).write.parquet(src)

    def run():
        run_available_now(spark, src, first.schema, "ts", "kind", "value", out, ckpt)
        return {(r["window_start"].hour, r["kind"]): (r["n"], r["total_value"]) for r in read_windows(spark, out, "kind").collect()}

    assert run() == {(0, "a"): (2, 3.0), (1, "b"): (1, 3.0), (1, "a"): (1, 4.0)}
    second.coalesce(1).write.mode("append").parquet(src)
    assert run() == {(0, "a"): (3, 13.0), (1, "b"): (2, 8.0), (1, "a"): (1, 4.0), (8, "a"): (1, 6.0)}
    assert run() == run()  # nothing new: nothing changes

    # the watermark now stands at 06:20: the first hours' state is gone and a late row is left out
    _events(spark, [(3, "a", 99.0), (501, "a", 1.0)]).coalesce(1).write.mode("append").parquet(src)
    got = run()
    assert got[(0, "a")] == (3, 13.0) and got[(8, "a")] == (2, 7.0)


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    rows = spark.createDataFrame([(dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 1), "a", 1, 2.0)],
                                 "window_start timestamp_ntz, window_end timestamp_ntz, kind string, n long, total_value double")
    out = str(tmp_path / "o")
    for n in (1, 2):
        rows.withColumn("n", F.lit(n).cast("long")).write.mode("overwrite").parquet(f"{out}/batch=0")
    assert [r["n"] for r in read_windows(spark, out, "kind").collect()] == [2]


def test_query_equals_the_batch_whatever_the_files(spark, tmp_path):
    """Part files that overlap in time, the latest first, lose no row."""
    events = table(spark, SF_SMALL, "events")
    split = events.withColumn("day", F.dayofmonth("ts")).orderBy(F.desc("day"))
    for low, high in ((20, 31), (8, 24), (1, 12)):
        part = split.where(F.col("day").between(low, high) & (F.col("event_id") % 3 == low % 3)).drop("day")
        part.coalesce(1).write.mode("append").parquet(f"{tmp_path}/events.parquet")
    whole = table(spark, str(tmp_path), "events")
    start = F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("window_start")
    batch = whole.groupBy(start, "event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 6).alias("total_value"))
    cols = ["window_start", "event_type", "n", "total_value"]
    got = QUERIES["stream_window_counts"](spark, str(tmp_path)).select(cols).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, batch.select(cols).collect()))
    assert sum(r["n"] for r in got) == whole.count() > 0
