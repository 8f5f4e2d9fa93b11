"""Tumbling-window counts over an event stream read from files.

The stream reads parquet files as they arrive (``maxFilesPerTrigger`` bounds
a micro-batch), aggregates per (window, type) with a watermark on the event
time, and writes each micro-batch's changed windows through ``foreachBatch``.
Result and checkpoint (offsets and state) lie at paths the caller gives, so a
restarted query resumes. With ``availableNow`` the query drains what is there
and stops, which makes its answer comparable to the batch aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def window_counts(events: DataFrame, ts: str, key: str, value: str, size: str,
                  delay: str) -> DataFrame:
    """Per (tumbling window, key): row count and value sum; late rows bounded by ``delay``.

    Watermarks need a TIMESTAMP. A TIMESTAMP_NTZ event time is read as a UTC
    wall clock (not in the session zone), so windows are wall-clock windows
    whatever the session time zone is, DST included.
    """
    et = "__event_time"
    c = F.col(ts)
    if dict((f.name, f.dataType.simpleString()) for f in events.schema.fields).get(ts) == "timestamp_ntz":
        as_utc = F.make_timestamp(F.year(c), F.month(c), F.dayofmonth(c), F.hour(c), F.minute(c),
                                  F.date_part(F.lit("SECOND"), c), F.lit("UTC"))
    else:
        as_utc = c
    ev = events.withColumn(et, as_utc)
    w = F.window(F.col(et), size)
    return (ev.withWatermark(et, delay)
            .groupBy(w.alias("w"), F.col(key))
            .agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total_value")))


def lossless_delay(events: DataFrame, ts: str) -> str:
    """The least whole-second delay with which no row of this finite table is ever late, in whatever order it is read."""
    span = events.agg((F.max(ts) - F.min(ts)).alias("span")).first()["span"]
    return f"{int(span.total_seconds()) + 1 if span is not None else 0} seconds"


def run_available_now(spark: SparkSession, source_glob: str, schema: StructType, ts: str, key: str,
                      value: str, out: str, checkpoint: str, size: str = "1 hour", delay: str = "2 hours",
                      files_per_trigger: int = 1) -> str:
    """Drain the files under ``source_glob`` through the stream into ``out``; returns ``out``.

    Called again with the same ``out`` and ``checkpoint`` it goes on where it
    stopped. Update mode: a batch writes the windows it changed, whole, to a
    folder of its own number, so a repeated batch replaces what it wrote
    before, and the watermark drops the state of windows that can no longer
    change. Rows of a later file that lie more than ``delay`` before the latest
    time seen may be left out: for a finite table read whole, give
    :func:`lossless_delay`. :func:`read_windows` gives the current table.
    """
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
              .parquet(source_glob))
    agg = window_counts(stream, ts, key, value, size, delay)

    tz = spark.conf.get("spark.sql.session.timeZone")

    def wall(col: str):
        # instant -> its UTC wall clock as TIMESTAMP_NTZ (the inverse of the read above)
        return F.convert_timezone(F.lit(tz), F.lit("UTC"), F.col(col).cast("timestamp_ntz"))

    def sink(batch: DataFrame, batch_id: int) -> None:
        (batch.select(wall("w.start").alias("window_start"), wall("w.end").alias("window_end"),
                      key, "n", "total_value")
         .write.mode("overwrite").parquet(f"{out}/batch={batch_id}"))

    q = (agg.writeStream.outputMode("update").foreachBatch(sink)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return out


def read_windows(spark: SparkSession, out: str, key: str) -> DataFrame:
    """The windows written to ``out``: of each (window, key) what the latest batch said."""
    rows = spark.read.parquet(out).groupBy("window_start", "window_end", key)
    return (rows.agg(F.max_by(F.struct("n", "total_value"), "batch").alias("r"))
            .select("window_start", "window_end", key, "r.n", "r.total_value"))
