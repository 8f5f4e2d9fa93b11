"""Relational queries: projections, filters, joins, aggregates, sorts, set ops,
hash sampling, partition/group functions. Doubles are rounded in both the
query and its oracle (engines differ in the last bits of float sums)."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions.scalar import (as_category, ceil_of, code_map, make_id, no_negative_zero,
                                      rate_from_median, round_half, scaled, threshold_class)
from tessera.operators import aggregate as agg
from tessera.operators import apply as ap
from tessera.operators import profile as prof
from tessera.operators import sampling as smp
from tessera.operators import verbs as vb
from tessera.plans.registry import query
from tessera.sources.tables import table

R = 6  # decimals kept for doubles compared with the oracle

# fixed values used by the queries below
YEARS = (1997, 1998)
RETURN_CODES = {"A": "AC", "N": "NO", "R": "RE"}
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
STRATA = {"F": 0.1, "O": 0.2, "P": 0.3}


def _ts(s: str):
    return F.lit(s).cast("timestamp_ntz")


# ---------------------------------------------------------------- flagship

def orders_by_nation_year(spark: SparkSession, sf: str) -> DataFrame:
    """Orders of 1997-1998 counted per customer first (partial aggregate), then
    joined to customer and nation: the join sees distinct customers, not orders."""
    o = (table(spark, sf, "orders")
         .filter((F.col("o_orderdate") >= _ts("1997-01-01")) & (F.col("o_orderdate") < _ts("1999-01-01")))
         .select("o_custkey", F.year("o_orderdate").alias("yr")))
    per_cust = o.groupBy("o_custkey").agg(
        F.count_if(F.col("yr") == YEARS[0]).alias("c0"), F.count_if(F.col("yr") == YEARS[1]).alias("c1"))
    cust = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf, "nation").select("n_nationkey", "n_name")
    return (per_cust.join(cust, per_cust.o_custkey == cust.c_custkey)
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .groupBy("n_name").agg(F.sum("c0").alias("n_1997"), F.sum("c1").alias("n_1998")))


URBAN_GROWTH_SQL = """
WITH y AS (
  SELECT n_name, year(o_orderdate) AS yr
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1999-01-01'),
a AS (SELECT n_name, count(*) AS n_1997 FROM y WHERE yr = 1997 GROUP BY n_name),
b AS (SELECT n_name, count(*) AS n_1998 FROM y WHERE yr = 1998 GROUP BY n_name)
SELECT n_name, n_1997, n_1998, n_1998 - n_1997 AS growth
FROM a JOIN b USING (n_name) WHERE n_1998 - n_1997 <> 0
"""


@query("urban_growth", URBAN_GROWTH_SQL)
def urban_growth(spark: SparkSession, sf: str) -> DataFrame:
    """Nations whose order count changed from 1997 to 1998, biggest growth first."""
    counts = orders_by_nation_year(spark, sf).filter((F.col("n_1997") > 0) & (F.col("n_1998") > 0))
    return (counts.withColumn("growth", F.col("n_1998") - F.col("n_1997"))
            .transform(lambda d: vb.filter_not_equal(d, "growth", 0))
            .orderBy(F.desc("growth"), "n_name"))


@query("top_growth", URBAN_GROWTH_SQL.rstrip() + " ORDER BY growth DESC, n_name LIMIT 10")
def top_growth(spark, sf):
    return vb.top_k(urban_growth(spark, sf), 10, F.desc("growth"), F.col("n_name"))


@query("merge_suffix", """
WITH s AS (SELECT s_nationkey AS nk, count(*) AS n FROM supplier GROUP BY 1),
     c AS (SELECT c_nationkey AS nk, count(*) AS n FROM customer GROUP BY 1)
SELECT s.nk AS nk_x, s.n AS n_x, c.nk AS nk_y, c.n AS n_y FROM s JOIN c ON s.nk = c.nk
""")
def merge_suffix(spark, sf):
    """Inner merge of two count tables sharing names: key and value get _x/_y."""
    s = agg.count_by(table(spark, sf, "supplier").select(F.col("s_nationkey").alias("nk")), ["nk"])
    c = agg.count_by(table(spark, sf, "customer").select(F.col("c_nationkey").alias("nk")), ["nk"])
    return vb.merge_by(s, c, "nk")


# ---------------------------------------------------------------- projections / filters

@query("project_cols", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def project_cols(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")


@query("round_half_bucket", """
SELECT round(l_discount * 10 * 2) / 2 AS bucket, count(*) AS n FROM lineitem GROUP BY 1
""")
def round_half_bucket(spark, sf):
    li = table(spark, sf, "lineitem")
    return (li.select(no_negative_zero(round_half(F.col("l_discount") * 10)).alias("bucket"))
            .groupBy("bucket").agg(F.count(F.lit(1)).alias("n")))


@query("rename_col", "SELECT c_mktsegment, count(*) AS n_customers FROM customer GROUP BY 1")
def rename_col(spark, sf):
    counts = table(spark, sf, "customer").select("c_mktsegment").groupBy("c_mktsegment").count()
    return vb.rename(counts, {"count": "n_customers"})


@query("filter_ne", "SELECT p_partkey, p_size FROM part WHERE p_size <> 25")
def filter_ne(spark, sf):
    return vb.filter_not_equal(table(spark, sf, "part").select("p_partkey", "p_size"), "p_size", 25)


@query("filter_eq_str", """
SELECT c_custkey, c_name, round(c_acctbal, 2) AS c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING'
""")
def filter_eq_str(spark, sf):
    c = vb.filter_equal(table(spark, sf, "customer"), "c_mktsegment", "BUILDING")
    return c.select("c_custkey", "c_name", F.round("c_acctbal", 2).alias("c_acctbal"))


@query("range_filter_param", """
SELECT p_partkey, p_size, p_retailprice FROM part WHERE p_retailprice BETWEEN 920.0 AND 950.5
""")
def range_filter_param(spark, sf, lo: float = 920.0, hi: float = 950.5):
    """Bounds arrive as named SQL parameters (no text splicing); pushed to the scan."""
    return spark.sql(
        "SELECT p_partkey, p_size, p_retailprice FROM {part} WHERE p_retailprice BETWEEN :lo AND :hi",
        args={"lo": lo, "hi": hi}, part=table(spark, sf, "part"))


@query("two_param_filter", """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'F'
""")
def two_param_filter(spark, sf, flag: str = "R", status: str = "F"):
    li = table(spark, sf, "lineitem")
    return (vb.filter_all_equal(li, l_returnflag=flag, l_linestatus=status)
            .select("l_orderkey", "l_linenumber", "l_quantity"))


@query("threshold_class", """
SELECT event_id, CASE WHEN value < 50 THEN 0 ELSE 1 END AS class FROM events
""")
def threshold_class_q(spark, sf):
    ev = table(spark, sf, "events")
    return ev.select("event_id", threshold_class("value", 50.0).alias("class"))


@query("code_map", """
SELECT l_returnflag, CASE l_returnflag WHEN 'A' THEN 'AC' WHEN 'N' THEN 'NO' WHEN 'R' THEN 'RE' ELSE 'NA' END AS code,
       count(*) AS n
FROM lineitem GROUP BY 1, 2
""")
def code_map_q(spark, sf):
    li = table(spark, sf, "lineitem")
    return (li.select("l_returnflag", code_map("l_returnflag", RETURN_CODES, "NA").alias("code"))
            .groupBy("l_returnflag", "code").agg(F.count(F.lit(1)).alias("n")))


@query("scaled_sum", """
SELECT l_returnflag, CAST(dayofweek(l_shipdate) + 1 AS VARCHAR) AS day_of_week,
       round(sum(l_extendedprice) / 1000000.0, 6) AS total_m
FROM lineitem GROUP BY 1, 2
""")
def scaled_sum(spark, sf):
    """Group sum by a carrier-like key and a numeric day key shown as a category."""
    li = table(spark, sf, "lineitem")
    g = (li.groupBy("l_returnflag", F.dayofweek("l_shipdate").alias("dow"))
         .agg(F.sum("l_extendedprice").alias("total")))
    return g.select("l_returnflag", as_category("dow").alias("day_of_week"),
                    F.round(scaled("total", 1e6), R).alias("total_m"))


@query("numeric_as_category", """
SELECT CAST(p_size AS VARCHAR) AS size_label, count(*) AS n_parts FROM part GROUP BY 1
""")
def numeric_as_category(spark, sf):
    p = table(spark, sf, "part")
    return p.groupBy(as_category("p_size").alias("size_label")).agg(F.count(F.lit(1)).alias("n_parts"))


@query("current_date_row", "SELECT CAST(current_date AS VARCHAR) AS today, count(*) AS n_regions FROM region")
def current_date_row(spark, sf):
    """Today's date (in the session's time zone) next to a row count."""
    return table(spark, sf, "region").agg(F.current_date().cast("string").alias("today"),
                                          F.count(F.lit(1)).alias("n_regions"))


@query("distinct_values", "SELECT DISTINCT l_suppkey FROM lineitem")
def distinct_values(spark, sf):
    return vb.distinct_values(table(spark, sf, "lineitem"), "l_suppkey")


@query("median_to_rate", "SELECT p_partkey, round(ln(2) / p_size, 9) AS rate FROM part")
def median_to_rate(spark, sf):
    return table(spark, sf, "part").select("p_partkey", F.round(rate_from_median("p_size"), 9).alias("rate"))


@query("make_id", "SELECT o_orderkey, concat('ID_', CAST(o_orderkey AS VARCHAR)) AS usubjid FROM orders")
def make_id_q(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", make_id("ID_", F.col("o_orderkey")).alias("usubjid"))


@query("drop_nulls", """
WITH o AS (SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY 1)
SELECT c_custkey, n_orders FROM customer LEFT JOIN o ON c_custkey = o_custkey WHERE n_orders IS NOT NULL
""")
def drop_nulls(spark, sf):
    o = agg.count_by(table(spark, sf, "orders").select("o_custkey"), ["o_custkey"], "n_orders")
    c = table(spark, sf, "customer").select("c_custkey")
    joined = c.join(o, c.c_custkey == o.o_custkey, "left").select("c_custkey", "n_orders")
    return vb.drop_missing(joined, ["n_orders"])


@query("ceil_expr", """
SELECT l_suppkey, count(*) AS n_lines, CAST(ceil(count(*) * CAST(0.16 AS DOUBLE)) AS BIGINT) AS n_drop
FROM lineitem GROUP BY 1
""")
def ceil_expr(spark, sf):
    g = agg.count_by(table(spark, sf, "lineitem").select("l_suppkey"), ["l_suppkey"], "n_lines")
    return g.withColumn("n_drop", ceil_of(F.col("n_lines") * F.lit(0.16)).cast("bigint"))


# ---------------------------------------------------------------- aggregates

@query("group_count", """
SELECT n_name, count(*) AS n_orders
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1
""")
def group_count(spark, sf):
    per_cust = agg.count_by(table(spark, sf, "orders").select("o_custkey"), ["o_custkey"], "k")
    cust = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf, "nation").select("n_nationkey", "n_name")
    return (per_cust.join(cust, per_cust.o_custkey == cust.c_custkey)
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .groupBy("n_name").agg(F.sum("k").alias("n_orders")))


@query("table_count", "SELECT count(*) AS n_rows FROM lineitem")
def table_count(spark, sf):
    return table(spark, sf, "lineitem").agg(F.count(F.lit(1)).alias("n_rows"))


@query("group_stats", f"""
SELECT l_returnflag, count(*) AS n,
       round(avg(round(l_tax * 100 * 2) / 2), {R}) AS tax_rnd_avg,
       round(avg(l_quantity), {R}) AS qty_avg,
       round(stddev_samp(l_quantity), {R}) AS qty_sd
FROM lineitem GROUP BY 1
""")
def group_stats(spark, sf):
    """count, mean of a half-rounded derived column, mean and sample sd per group."""
    li = table(spark, sf, "lineitem").withColumn("tax_rnd", round_half(F.col("l_tax") * 100))
    return agg.summarize_group(
        li, ["l_returnflag"],
        n=F.count(F.lit(1)),
        tax_rnd_avg=F.round(F.avg("tax_rnd"), R),
        qty_avg=F.round(F.avg("l_quantity"), R),
        qty_sd=F.round(F.stddev_samp("l_quantity"), R))


@query("sum_two_keys", """
SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS total_qty FROM lineitem GROUP BY 1, 2
""")
def sum_two_keys(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.groupBy("l_returnflag", "l_linestatus").agg(F.round(F.sum("l_quantity"), 2).alias("total_qty"))


@query("contingency_long", "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2")
def contingency_long(spark, sf):
    return agg.contingency_long(table(spark, sf, "orders"), "o_orderstatus", "o_orderpriority")


@query("contingency_wide", "SELECT o_orderstatus, " + ", ".join(
    f"count(*) FILTER (WHERE o_orderpriority = '{p}') AS \"{p}\"" for p in PRIORITIES)
    + ", count(*) FILTER (WHERE o_orderpriority IS NULL OR o_orderpriority NOT IN ("
    + ", ".join(f"'{p}'" for p in PRIORITIES) + ")) AS other FROM orders GROUP BY 1")
def contingency_wide(spark, sf):
    return agg.contingency_wide(table(spark, sf, "orders"), "o_orderstatus", "o_orderpriority", PRIORITIES)


@query("group_means", f"""
SELECT l_returnflag, round(avg(l_quantity), {R}) AS quantity, round(avg(l_extendedprice), {R}) AS extendedprice,
       round(avg(l_discount), {R}) AS discount, round(avg(l_tax), {R}) AS tax
FROM lineitem GROUP BY 1
""")
def group_means(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.groupBy("l_returnflag").agg(
        *[F.round(F.avg(f"l_{c}"), R).alias(c) for c in ("quantity", "extendedprice", "discount", "tax")])


@query("group_map", f"""
SELECT l_returnflag, round(avg(l_quantity), {R}) AS quantity, round(avg(l_extendedprice), {R}) AS extendedprice,
       round(avg(l_discount), {R}) AS discount, round(avg(l_tax), {R}) AS tax
FROM lineitem GROUP BY 1
""")
def group_map(spark, sf):
    """Group means through a pandas function: partial sums per Arrow batch, then a
    Spark aggregate combines them, so no group is ever held whole in one task."""
    li = table(spark, sf, "lineitem").select(
        "l_returnflag", *[F.col(f"l_{c}").alias(c) for c in ("quantity", "extendedprice", "discount", "tax")])
    out = ap.group_means_by_batches(li, "l_returnflag", ["quantity", "extendedprice", "discount", "tax"])
    return out.select("l_returnflag", *[F.round(c, R).alias(c)
                                         for c in ("quantity", "extendedprice", "discount", "tax")])


@query("group_trend", """
WITH y AS (SELECT l_suppkey, year(l_shipdate) AS yr, sum(l_extendedprice) AS revenue FROM lineitem GROUP BY 1, 2)
SELECT l_suppkey, count(*) AS n_years, round(regr_slope(revenue, yr), 2) AS slope FROM y GROUP BY 1
""")
def group_trend(spark, sf):
    """A function per group: the least-squares trend of each supplier's yearly revenue.

    Its groups are bounded by construction: the years of one supplier.
    """
    yearly = (table(spark, sf, "lineitem").groupBy("l_suppkey", F.year("l_shipdate").alias("yr"))
              .agg(F.sum("l_extendedprice").alias("revenue")))

    def trend(key, rows):
        x, y = rows["yr"] - rows["yr"].mean(), rows["revenue"]
        slope = float((x * y).sum() / (x * x).sum()) if len(rows) > 1 else None
        return pd.DataFrame({"l_suppkey": [key[0]], "n_years": [len(rows)], "slope": [slope]})

    out = ap.group_apply(yearly, ["l_suppkey"], trend, "l_suppkey bigint, n_years bigint, slope double")
    return out.withColumn("slope", F.round("slope", 2))


@query("group_regression", """
WITH m AS (SELECT l_suppkey, count(*) AS n, avg(l_quantity) AS mq, avg(l_discount) AS md, avg(l_extendedprice) AS my,
                  covar_pop(l_quantity, l_quantity) AS qq, covar_pop(l_discount, l_discount) AS dd,
                  covar_pop(l_quantity, l_discount) AS qd, covar_pop(l_quantity, l_extendedprice) AS qy,
                  covar_pop(l_discount, l_extendedprice) AS dy FROM lineitem GROUP BY l_suppkey),
b AS (SELECT *, (qy * dd - dy * qd) / (qq * dd - qd * qd) AS bq, (dy * qq - qy * qd) / (qq * dd - qd * qd) AS bd FROM m)
SELECT l_suppkey, n, round(my - bq * mq - bd * md, 3) AS intercept, round(bq, 3) AS quantity, round(bd, 3) AS discount FROM b
""")
def group_regression(spark, sf):
    """A user's aggregate per group: price on quantity and discount, fitted per supplier from mergeable moments.

    The state is (rows, means, sums of products about the means); two states merge without their rows.
    """
    cols = ["l_quantity", "l_discount", "l_extendedprice"]

    def merge(a, b):
        (n, mean, prod), (m, other, more) = a, b
        if n == 0 or m == 0:
            return b if n == 0 else a
        gap = other - mean
        return n + m, mean + gap * m / (n + m), prod + more + np.outer(gap, gap) * n * m / (n + m)

    def update(state, rows):
        v = rows[cols].dropna().to_numpy(float)
        if not len(v):
            return state
        mean = v.mean(axis=0)
        return merge(state, (len(v), mean, (v - mean).T @ (v - mean)))

    def finish(state):
        n, mean, prod = state
        if n < 3 or np.linalg.matrix_rank(prod[:2, :2]) < 2:
            return n, None, None, None
        slopes = np.linalg.solve(prod[:2, :2], prod[:2, 2])
        return n, float(mean[2] - slopes @ mean[:2]), float(slopes[0]), float(slopes[1])

    li = table(spark, sf, "lineitem").select("l_suppkey", *cols)
    out = ap.group_fold(li, ["l_suppkey"], lambda: (0, np.zeros(3), np.zeros((3, 3))), update, merge, finish,
                        "n bigint, intercept double, quantity double, discount double")
    return out.select("l_suppkey", "n", *[F.round(c, 3).alias(c) for c in ("intercept", "quantity", "discount")])


TOP_LINES = 5


@query("partition_top", f"""
SELECT l_returnflag, l_orderkey, l_linenumber, l_extendedprice, place::INTEGER AS place FROM (
  SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS place
  FROM lineitem) WHERE place <= {TOP_LINES}
""")
def partition_top(spark, sf):
    """The dearest lines per return flag (a top-k report): known of a partition at its end, then merged.

    A partition is read as one stream, keeps the lines that are still among its best, and
    gives them out when it ends; the answer is the best of those, however rows were dealt.
    """
    names = ["l_returnflag", "l_orderkey", "l_linenumber", "l_extendedprice"]
    order = [("l_returnflag", "ascending"), ("l_extendedprice", "descending"), ("l_orderkey", "ascending"),
             ("l_linenumber", "ascending")]

    def step(held: pa.Table | None, batch: pa.RecordBatch) -> pa.Table:
        rows = pa.Table.from_batches([batch])
        pdf = (rows if held is None else pa.concat_tables([held, rows])).sort_by(order).to_pandas()
        return pa.Table.from_pandas(pdf.groupby("l_returnflag", dropna=False).head(TOP_LINES), rows.schema, preserve_index=False)

    li = table(spark, sf, "lineitem").select(*names)
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in li.schema.fields)
    ends = ap.partition_fold(li, lambda: None, step, lambda held: held if held is not None else pa.table({}), kinds)
    # at most TOP_LINES rows a partition and flag are left to rank
    place = Window.partitionBy("l_returnflag").orderBy(F.desc("l_extendedprice"), "l_orderkey", "l_linenumber")
    return ends.withColumn("place", F.row_number().over(place)).where(F.col("place") <= TOP_LINES)


@query("partition_map", """
SELECT l_orderkey, l_linenumber, l_returnflag,
       CASE l_returnflag WHEN 'A' THEN 'AC' WHEN 'N' THEN 'NO' WHEN 'R' THEN 'RE' ELSE 'NA' END AS code
FROM lineitem
""")
def partition_map(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    return ap.partition_code_map(li, "l_returnflag", RETURN_CODES, "NA")


@query("histogram_counts", """
WITH b AS (SELECT min(value) AS lo, max(value) AS hi FROM events)
SELECT CAST(least(floor((value - lo) / (hi - lo) * 30), 29) AS INTEGER) AS bin, count(*) AS n,
       round(min(lo + CAST(least(floor((value - lo) / (hi - lo) * 30), 29) AS INTEGER) * (hi - lo) / 30), 6) AS lo,
       round(min(lo + (CAST(least(floor((value - lo) / (hi - lo) * 30), 29) AS INTEGER) + 1) * (hi - lo) / 30), 6) AS hi
FROM events, b GROUP BY 1
""")
def histogram_counts(spark, sf):
    h = agg.histogram(table(spark, sf, "events"), "value", 30)
    return h.select("bin", "n", F.round("lo", 6).alias("lo"), F.round("hi", 6).alias("hi"))


@query("bucketed_mean_curve", f"""
WITH p AS (SELECT p_size, p_retailprice,
                  CAST(least(floor((p_size - 1.0) / 49.0 * 10), 9) AS INTEGER) AS bin
           FROM part WHERE p_size BETWEEN 1 AND 50),
g AS (SELECT bin, count(*) AS n, sum(p_retailprice) AS sy, avg(p_size) AS x_mean, avg(p_retailprice) AS y_mean
      FROM p GROUP BY bin)
SELECT bin, n, round(x_mean, {R}) AS x_mean, round(y_mean, {R}) AS y_mean,
       round(sum(sy) OVER w / sum(n) OVER w, {R}) AS y_smooth
FROM g WINDOW w AS (ORDER BY bin ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)
""")
def bucketed_mean_curve(spark, sf, lo: float = 1.0, hi: float = 50.0):
    """Range-filtered x/y pairs, mean y per x bucket and its smoothed curve."""
    p = vb.filter_range(table(spark, sf, "part"), "p_size", lo, hi)
    c = agg.bucketed_mean_curve(p, "p_size", "p_retailprice", 10, lo, hi, smooth=1)
    return c.select("bin", "n", *[F.round(x, R).alias(x) for x in ("x_mean", "y_mean", "y_smooth")])


CURVE_BINS, CURVE_SPAN = 49, 0.25


@query("local_regression_curve", f"""
WITH p AS (SELECT p_size AS x, p_retailprice AS y, least(floor((p_size - 1.0) / 49.0 * {CURVE_BINS}), {CURVE_BINS - 1}) AS bin
           FROM part WHERE p_size BETWEEN 1 AND 50),
r AS (SELECT j, x - (1.0 + (j + 0.5) * 49.0 / {CURVE_BINS}) AS u, y,
             pow(1 - pow(abs(bin - j) / {CURVE_BINS * CURVE_SPAN}, 3), 3)::DOUBLE AS w
      FROM p JOIN (SELECT unnest(range({CURVE_BINS})) AS j) ON abs(bin - j) < {CURVE_BINS * CURVE_SPAN}),
s AS (SELECT j, count(*) AS n, sum(w) AS s0, sum(w * u) AS s1, sum(w * u * u) AS s2, sum(w * y) AS t0, sum(w * u * y) AS t1
      FROM r GROUP BY j),
f AS (SELECT j, n, s0, s1, s2, (s2 * t0 - s1 * t1) / (s0 * s2 - s1 * s1) AS a, (s0 * t1 - s1 * t0) / (s0 * s2 - s1 * s1) AS b FROM s),
e AS (SELECT r.j, sum(w * (y - a - b * u) * (y - a - b * u)) / max(s0) AS v,
             sum(pow(w * (s2 - s1 * u) / (s0 * s2 - s1 * s1), 2)) AS l2 FROM r JOIN f ON r.j = f.j GROUP BY r.j)
SELECT round(1.0 + (f.j + 0.5) * 49.0 / {CURVE_BINS}, 6)::DOUBLE AS x, n, round(a, 5) AS y_smooth, round(b, 5) AS slope,
       round(sqrt(v * l2), 5) AS std_error FROM f JOIN e ON f.j = e.j
""")
def local_regression_curve(spark, sf, lo: float = 1.0, hi: float = 50.0):
    """Price over size as a local linear smoother with standard errors."""
    c = agg.local_regression_curve(table(spark, sf, "part"), "p_size", "p_retailprice", CURVE_BINS, lo, hi, CURVE_SPAN)
    return c.select(F.round("x", 6).alias("x"), "n", *[F.round(v, 5).alias(v) for v in ("y_smooth", "slope", "std_error")])


@query("profile_describe", f"""
SELECT 'l_quantity' AS column_name, count(l_quantity) AS count, round(avg(l_quantity), {R}) AS mean,
       round(stddev_samp(l_quantity), {R}) AS stddev, min(l_quantity) AS min, max(l_quantity) AS max FROM lineitem
UNION ALL
SELECT 'l_extendedprice', count(l_extendedprice), round(avg(l_extendedprice), {R}),
       round(stddev_samp(l_extendedprice), {R}), min(l_extendedprice), max(l_extendedprice) FROM lineitem
UNION ALL
SELECT 'l_discount', count(l_discount), round(avg(l_discount), {R}), round(stddev_samp(l_discount), {R}),
       min(l_discount) + 0.0, max(l_discount) + 0.0 FROM lineitem
""")
def profile_describe(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("l_discount", no_negative_zero("l_discount"))
    d = prof.describe_long(li, ["l_quantity", "l_extendedprice", "l_discount"])
    return d.select("column_name", "count", *[F.round(c, R).alias(c) for c in ("mean", "stddev")], "min", "max")


@query("profile_summary", f"""
SELECT 'l_quantity' AS column_name, count(l_quantity) AS count, round(avg(l_quantity), {R}) AS mean,
       round(stddev_samp(l_quantity), {R}) AS stddev, min(l_quantity) AS min,
       round(quantile_cont(l_quantity, 0.25), {R}) AS q25, round(quantile_cont(l_quantity, 0.5), {R}) AS q50,
       round(quantile_cont(l_quantity, 0.75), {R}) AS q75, max(l_quantity) AS max FROM lineitem
UNION ALL
SELECT 'l_extendedprice', count(l_extendedprice), round(avg(l_extendedprice), {R}),
       round(stddev_samp(l_extendedprice), {R}), min(l_extendedprice),
       round(quantile_cont(l_extendedprice, 0.25), {R}), round(quantile_cont(l_extendedprice, 0.5), {R}),
       round(quantile_cont(l_extendedprice, 0.75), {R}), max(l_extendedprice) FROM lineitem
""")
def profile_summary(spark, sf):
    """describe() plus exact quartiles, one typed row per column."""
    li = table(spark, sf, "lineitem")
    s = prof.summary_long(li, ["l_quantity", "l_extendedprice"])
    return s.select("column_name", "count", *[F.round(c, R).alias(c) for c in ("mean", "stddev")], "min",
                    *[F.round(c, R).alias(c) for c in ("q25", "q50", "q75")], "max")


# ---------------------------------------------------------------- sorts, set ops

@query("sort_asc", "SELECT c_custkey, c_mktsegment FROM customer ORDER BY c_mktsegment, c_custkey")
def sort_asc(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", "c_mktsegment").orderBy("c_mktsegment", "c_custkey")


@query("except_rows", """
SELECT o_custkey, o_orderstatus FROM orders
EXCEPT SELECT o_custkey, o_orderstatus FROM orders WHERE o_orderpriority = '1-URGENT'
""")
def except_rows(spark, sf):
    o = table(spark, sf, "orders")
    return vb.except_distinct(o.select("o_custkey", "o_orderstatus"),
                              o.filter(F.col("o_orderpriority") == "1-URGENT").select("o_custkey", "o_orderstatus"))


@query("union_rows", """
SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment = 'BUILDING'
UNION ALL SELECT c_custkey, c_mktsegment FROM customer WHERE c_acctbal > 5000
""")
def union_rows(spark, sf):
    c = table(spark, sf, "customer")
    return vb.union_rows(c.filter(F.col("c_mktsegment") == "BUILDING").select("c_custkey", "c_mktsegment"),
                         c.filter(F.col("c_acctbal") > 5000).select("c_custkey", "c_mktsegment"))


def _hash_sql(key: str, salt: str, offset: int = 0) -> str:
    """DuckDB twin of functions.scalar.hash_u32; ``salt`` is a SQL expression."""
    return (f"('0x' || substr(md5(concat_ws('|', CAST({key} AS VARCHAR), {salt})), {1 + 8 * offset}, 8))"
            "::BIGINT")


@query("hash_sample", f"""
SELECT o_orderkey, o_orderstatus FROM orders WHERE {_hash_sql('o_orderkey', "'42'")} < {smp.bound(0.6)}
""")
def hash_sample(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return smp.hash_sample(o, ["o_orderkey"], 0.6, seed=42)


@query("hash_split", f"""
SELECT o_orderkey, CASE WHEN {_hash_sql('o_orderkey', "'1099'")} < {smp.bound(0.75)} THEN 'training' ELSE 'test' END AS split
FROM orders
""")
def hash_split(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey")
    return smp.hash_split(o, ["o_orderkey"], {"training": 0.75, "test": 0.25}, seed=1099)


@query("stratified_sample", f"""
SELECT o_orderkey, o_orderstatus FROM orders
WHERE {_hash_sql('o_orderkey', "'7'")} < CASE o_orderstatus
  {' '.join(f"WHEN '{k}' THEN {smp.bound(v)}" for k, v in STRATA.items())} ELSE 0 END
""")
def stratified_sample(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return smp.stratified_sample(o, "o_orderstatus", STRATA, ["o_orderkey"], seed=7)


@query("train_test_by_class", f"""
SELECT o_orderkey, o_orderstatus, round(o_totalprice, 2) AS o_totalprice,
       CASE WHEN {_hash_sql('o_orderkey', "CASE o_orderstatus WHEN 'F' THEN '42' ELSE '43' END")}
            < {smp.bound(0.6)} THEN 'training' ELSE 'test' END AS split
FROM orders WHERE o_orderstatus IN ('F', 'O')
""")
def train_test_by_class(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus",
                                          F.round("o_totalprice", 2).alias("o_totalprice"))
    return smp.train_test_by_class(o, "o_orderstatus", {"F": 42, "O": 43}, 0.6, ["o_orderkey"])
