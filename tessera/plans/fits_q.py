"""Maximum-likelihood fits, isotonic regression and the goodness-of-fit test as Spark aggregates, with oracles.

The fits' oracles are chains of Newton steps unrolled in SQL, each step a query of its own."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.scalar import threshold_class
from tessera.functions.stats import erfc_sql, normal_cdf_sql
from tessera.operators import ml
from tessera.operators.goodness import ks_normal
from tessera.operators.isotonic import isotonic
from tessera.operators.newton import Fit, logistic, newton, normal_tails, weibull
from tessera.operators.sampling import bound, train_test_by_class
from tessera.plans.fixtures import LINEITEM_TRIAL_SQL, lineitem_trial
from tessera.plans.registry import query
from tessera.plans.relational import _hash_sql
from tessera.session import materialize
from tessera.sources.tables import table

# fixed values: classes and their split seeds, the share of training rows
GLM_CLASSES = {"AUTOMOBILE": 42, "BUILDING": 43}
GLM_SHARE = 0.6
GLM_TERMS = ["(Intercept)", "c_acctbal", "c_nationkey"]
TOL = 1e-8
SQL_STEPS = 10  # of the oracles' chains; a fit that has converged stays where it is
_UPPER = [(0, 0), (0, 1), (0, 2), (1, 1), (1, 2), (2, 2)]


def _chain_sql(rows: str, start: str, value: str, gradient: list[str], second: list[str]) -> str:
    """CTEs s0, a0, s1, a1, ... of a Newton fit of coefficients b0, b1, b2 over the CTE ``rows``.

    s has the coefficients, the likelihood before and whether the fit has converged; a
    the sums at s with the cofactors and the determinant of the information.
    """
    sums = ", ".join([f"sum({value}) AS v", *[f"sum({g}) AS g{i}" for i, g in enumerate(gradient)],
                      *[f"sum({h}) AS h{i}{j}" for (i, j), h in zip(_UPPER, second)]])
    out = [f"s0 AS MATERIALIZED ({start})"]
    for k in range(SQL_STEPS + 1):
        out.append(f"""a{k} AS MATERIALIZED (SELECT *, c00 * h00 + c01 * h01 + c02 * h02 AS det FROM (
  SELECT *, h11 * h22 - h12 * h12 AS c00, h02 * h12 - h01 * h22 AS c01, h01 * h12 - h02 * h11 AS c02,
         h00 * h22 - h02 * h02 AS c11, h01 * h02 - h00 * h12 AS c12, h00 * h11 - h01 * h01 AS c22
  FROM (SELECT {sums} FROM {rows}, s{k})))""")
        if k < SQL_STEPS:
            stop = f"(done OR coalesce(abs(v - before) < {TOL} * (abs(v) + 0.05), FALSE))"
            moves = ["(c00 * g0 + c01 * g1 + c02 * g2) / det", "(c01 * g0 + c11 * g1 + c12 * g2) / det",
                     "(c02 * g0 + c12 * g1 + c22 * g2) / det"]
            new = ", ".join(f"CASE WHEN {stop} THEN b{i} ELSE b{i} + {m} END AS b{i}" for i, m in enumerate(moves))
            out.append(f"""s{k + 1} AS MATERIALIZED (SELECT {new}, CASE WHEN {stop} THEN before ELSE v END AS before,
  steps + CASE WHEN {stop} THEN 0 ELSE 1 END AS steps, {stop} AS done FROM s{k}, a{k})""")
    out.append(f"""fit AS (SELECT *, [sqrt(c00 / det), sqrt(c11 / det), sqrt(c22 / det)] AS se
  FROM s{SQL_STEPS}, a{SQL_STEPS})""")
    return ",\n".join(out)


_STATE = "NULL::DOUBLE AS before, 0 AS steps, FALSE AS done"


# ---------------------------------------------------------------- binomial GLM

_SEED_SQL = "CASE c_mktsegment " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in GLM_CLASSES.items()) + " END"
_P = "(1 / (1 + exp(-(b0 + b1 * x1 + b2 * x2))))"
_PQ = f"({_P} * (1 - {_P}))"
GLM_SQL = f"""
WITH d AS (SELECT c_custkey, c_mktsegment, CAST(c_acctbal AS DOUBLE) AS x1, CAST(c_nationkey AS DOUBLE) AS x2,
                  CASE WHEN {_hash_sql('c_custkey', _SEED_SQL)} < {bound(GLM_SHARE)} THEN 'training' ELSE 'test' END AS split
           FROM customer WHERE c_mktsegment IN ({', '.join(f"'{k}'" for k in GLM_CLASSES)})),
labels AS (SELECT c_mktsegment, CAST(row_number() OVER (ORDER BY count(*) DESC, c_mktsegment) - 1 AS DOUBLE) AS y
           FROM d WHERE split = 'training' GROUP BY c_mktsegment),
t AS MATERIALIZED (SELECT x1, x2, y FROM d JOIN labels USING (c_mktsegment) WHERE split = 'training'),
""" + _chain_sql("t", f"SELECT 0.0::DOUBLE AS b0, 0.0::DOUBLE AS b1, 0.0::DOUBLE AS b2, {_STATE}",
                 f"CASE WHEN y = 1 THEN ln({_P}) ELSE ln(1 - {_P}) END",
                 [f"y - {_P}", f"(y - {_P}) * x1", f"(y - {_P}) * x2"],
                 [_PQ, f"{_PQ} * x1", f"{_PQ} * x2", f"{_PQ} * x1 * x1", f"{_PQ} * x1 * x2", f"{_PQ} * x2 * x2"])
_CLASSED_SQL = GLM_SQL + f""",
p AS (SELECT split, CASE WHEN {_P} >= 0.5 THEN 1 ELSE 0 END AS class, y AS label, c_mktsegment
      FROM d JOIN labels USING (c_mktsegment), fit)
"""


def _glm(spark, sf) -> tuple[DataFrame, Fit]:
    """Rows with f0, f1, label and split, and the fit on the training rows."""
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal", "c_nationkey")
    data = train_test_by_class(c, "c_mktsegment", GLM_CLASSES, GLM_SHARE, ["c_custkey"])
    formula = ml.formula_pipeline("c_mktsegment ~ c_acctbal + c_nationkey").fit(data.filter(F.col("split") == "training"))
    rows = ml.features_as_columns(formula.transform(data).select("split", "c_mktsegment", "label", "features"), n=2)
    training = materialize(rows.filter(F.col("split") == "training").select("label", "f0", "f1"))
    fit = newton(training, [0.0, 0.0, 0.0], logistic(F.col("label"), [F.lit(1.0), F.col("f0"), F.col("f1")]), tol=TOL)
    return rows, fit


def _classed(rows: DataFrame, fit: Fit) -> DataFrame:
    a, b, c = (F.lit(x) for x in fit.coefficients)
    return rows.withColumn("class", threshold_class(1 / (1 + F.exp(-(a + b * F.col("f0") + c * F.col("f1")))), 0.5))


@query("glm_binomial_coefs", GLM_SQL + f"""
SELECT term, round(b, 9) AS estimate, round(s, 9) AS std_error, round(b / s, 6) AS t_value,
       round({erfc_sql("abs(b / s) / sqrt(2.0::DOUBLE)")}, 6) AS p_value
FROM (SELECT unnest([{', '.join(f"'{t}'" for t in GLM_TERMS)}]) AS term, unnest([b0, b1, b2]) AS b, unnest(se) AS s FROM fit)
""")
def glm_binomial_coefs(spark, sf):
    """Binomial GLM on two segments: estimate, standard error, t and p per term."""
    _, fit = _glm(spark, sf)
    rows = [(t, round(b, 9), round(s, 9), round(b / s, 6), round(normal_tails(b / s), 6))
            for t, b, s in zip(GLM_TERMS, fit.coefficients, fit.std_errors)]
    return spark.createDataFrame(rows, "term string, estimate double, std_error double, t_value double, p_value double")


@query("glm_summary", GLM_SQL + """,
n AS (SELECT count(*) AS n, avg(y) AS m FROM t)
SELECT 'glm_binomial' AS model, metric, value FROM (
  SELECT unnest(['aic', 'deviance', 'null_deviance', 'dispersion', 'iterations', 'rank', 'residual_dof']) AS metric,
         unnest([round(6 - 2 * v, 6), round(-2 * v, 6), round(-2 * n * (m * ln(m) + (1 - m) * ln(1 - m)), 6), 1.0,
                 steps, 3.0, n - 3.0]::DOUBLE[]) AS value FROM fit, n)
""")
def glm_summary(spark, sf):
    """Fit statistics of the binomial GLM; iterations are Newton steps from zero."""
    rows, fit = _glm(spark, sf)
    n, share = rows.filter(F.col("split") == "training").agg(F.count(F.lit(1)), F.avg("label")).first()
    null = F.lit(-2.0 * n) * (F.lit(share) * F.log(F.lit(share)) + F.lit(1 - share) * F.log(F.lit(1 - share)))
    items = [("aic", round(2 * fit.rank - 2 * fit.log_likelihood, 6)), ("deviance", round(-2 * fit.log_likelihood, 6)),
             ("null_deviance", round(spark.range(1).select(null).first()[0], 6)), ("dispersion", 1.0),
             ("iterations", fit.steps), ("rank", fit.rank), ("residual_dof", n - fit.rank)]
    return ml.metrics_table(spark, [("glm_binomial", k, v) for k, v in items])


@query("glm_confusion", _CLASSED_SQL + """
SELECT split, class, label, c_mktsegment, count(*) AS n FROM p GROUP BY ALL
""")
def glm_confusion(spark, sf):
    """Predict on training and test rows; 0/1 class at .5 against the label code.

    The label text is reported next to its code: the formula indexes labels by
    frequency, so code 0 is the most frequent segment, not the first by name.
    """
    rows, fit = _glm(spark, sf)
    return _classed(rows, fit).groupBy("split", "class", "label", "c_mktsegment").agg(F.count(F.lit(1)).alias("n"))


@query("glm_evaluation", _CLASSED_SQL + """,
e AS (SELECT split, count(*) AS n, avg(CASE WHEN class = label THEN 1.0 ELSE 0.0 END) AS accuracy,
        (2.0 * count(*) FILTER (class = 0 AND label = 0) * count(*) FILTER (label = 0)
          / greatest(count(*) FILTER (label = 0) + count(*) FILTER (class = 0), 1)
        + 2.0 * count(*) FILTER (class = 1 AND label = 1) * count(*) FILTER (label = 1)
          / greatest(count(*) FILTER (label = 1) + count(*) FILTER (class = 1), 1)) / count(*) AS f1
      FROM p GROUP BY split)
SELECT split, 'accuracy' AS metric, round(accuracy::DOUBLE, 9) AS value FROM e
UNION ALL SELECT split, 'f1', round(f1::DOUBLE, 9) FROM e
""")
def glm_evaluation(spark, sf):
    """Held-out against training evaluation: accuracy and F1 (weighted by class size) of the 0/1 class per split."""
    y, p = F.col("label"), F.col("class")
    per = _classed(*_glm(spark, sf)).groupBy("split").agg(F.count(F.lit(1)).alias("n"), *[
        F.count_if(cond).alias(name) for c in (0, 1) for name, cond in (
            (f"t{c}", (y == c) & (p == c)), (f"y{c}", y == c), (f"p{c}", p == c))])
    f1 = sum(F.col(f"y{c}") * 2 * F.col(f"t{c}") / F.greatest(F.col(f"y{c}") + F.col(f"p{c}"), F.lit(1)) for c in (0, 1))
    scores = F.array(F.struct(F.lit("accuracy").alias("metric"),
                              F.round((F.col("t0") + F.col("t1")) / F.col("n"), 9).alias("value")),
                     F.struct(F.lit("f1").alias("metric"), F.round(f1 / F.col("n"), 9).alias("value")))
    return per.select("split", F.explode(scores).alias("s")).select("split", "s.metric", "s.value")


# ---------------------------------------------------------------- accelerated failure time

_E = "exp(b2 * l - b0 - b1 * x)"
AFT_SQL = f"""
WITH trial AS ({LINEITEM_TRIAL_SQL}),
t AS MATERIALIZED (SELECT CAST(arm = 'R' AS INTEGER)::DOUBLE AS x, ln(time) AS l, time, event::DOUBLE AS d,
                          count(*)::DOUBLE AS w FROM trial GROUP BY ALL),
""" + _chain_sql("t", f"SELECT ln(sum(w * time) / sum(w * d)) AS b0, 0.0::DOUBLE AS b1, 1.0::DOUBLE AS b2, {_STATE} FROM t",
                 f"w * (d * (b2 * l - b0 - b1 * x + ln(b2)) - {_E})",
                 [f"w * ({_E} - d)", f"w * x * ({_E} - d)", f"w * (d * (l + 1 / b2) - l * {_E})"],
                 [f"w * {_E}", f"w * x * {_E}", f"-w * l * {_E}", f"w * x * x * {_E}", f"-w * x * l * {_E}",
                  f"w * (d / (b2 * b2) + l * l * {_E})"])


def _aft(spark, sf) -> tuple[DataFrame, dict[str, float]]:
    """Subjects with ``treated``, and the fit on (arm, time, event) counts."""
    rows = lineitem_trial(spark, sf).select("l_orderkey", "l_linenumber", (F.col("arm") == "R").cast("double").alias("treated"),
                                            "time", F.col("event").cast("double").alias("event"))
    counts = materialize(rows.groupBy("treated", "time", "event").agg(F.count(F.lit(1)).cast("double").alias("w"))
                         .withColumn("l", F.log("time")))
    # start: all subjects exponential, one rate
    at = counts.agg(F.log(F.sum(F.col("w") * F.col("time")) / F.sum(F.col("w") * F.col("event")))).first()[0]
    theta = newton(counts, [at if at is not None else 0.0, 0.0, 1.0],
                   weibull(F.col("l"), F.col("event"), [F.lit(1.0), F.col("treated")], F.col("w")), tol=TOL)
    a, b, tau = theta.coefficients
    return rows, {"treated": b / tau, "(Intercept)": a / tau, "log(scale)": theta}


@query("ml_aft", AFT_SQL + """
SELECT unnest(['treated', '(Intercept)', 'log(scale)']) AS term,
       unnest([round(b1 / b2, 6), round(b0 / b2, 6), round(-ln(b2), 6)]) AS estimate FROM fit
""")
def ml_aft(spark, sf):
    """Accelerated failure time fit (Weibull) on the lineitem trial."""
    _, fit = _aft(spark, sf)
    scale = spark.range(1).select(-F.log(F.lit(fit["log(scale)"].coefficients[2]))).first()[0]
    rows = [("treated", round(fit["treated"], 6)), ("(Intercept)", round(fit["(Intercept)"], 6)), ("log(scale)", round(scale, 6))]
    return spark.createDataFrame(rows, "term string, estimate double")


@query("ml_aft_predict", AFT_SQL + """
SELECT l_orderkey, l_linenumber, CAST(arm = 'R' AS INTEGER)::DOUBLE AS treated,
       round(exp(b0 / b2 + CASE WHEN arm = 'R' THEN b1 / b2 ELSE 0 END), 6) AS prediction FROM trial, fit
""")
def ml_aft_predict(spark, sf):
    """Predicted survival time of every subject."""
    rows, fit = _aft(spark, sf)
    line = F.lit(fit["(Intercept)"]) + F.lit(fit["treated"]) * F.col("treated")
    return rows.select("l_orderkey", "l_linenumber", "treated", F.round(F.exp(line), 6).alias("prediction"))


# ---------------------------------------------------------------- isotonic regression, Kolmogorov-Smirnov

@query("ml_isotonic", """
WITH g AS (SELECT CAST(p_size AS DOUBLE) AS x, count(*) AS w, sum(p_retailprice) AS s FROM part GROUP BY p_size),
means AS (SELECT a.x AS a, b.x AS b, sum(g.s) / sum(g.w) AS m
          FROM g a JOIN g b ON a.x <= b.x JOIN g ON g.x BETWEEN a.x AND b.x GROUP BY a.x, b.x),
lows AS (SELECT g.x, means.a, min(m) AS m FROM g JOIN means ON means.a <= g.x AND means.b >= g.x GROUP BY g.x, means.a),
fits AS (SELECT x, round(max(m), 6) AS prediction FROM lows GROUP BY x)
SELECT DISTINCT unnest([min(x), max(x)]) AS boundary, prediction FROM fits GROUP BY prediction
""")
def ml_isotonic(spark, sf):
    """Rising step function of price by size: both ends of every step and its value."""
    pools = isotonic(table(spark, sf, "part"), "p_size", "p_retailprice")
    ends = F.array_distinct(F.array("lo", "hi"))
    return pools.select(F.explode(ends).alias("boundary"), F.round(F.col("total") / F.col("weight"), 6).alias("prediction"))


def _tail_sql(t: str) -> str:
    far = " + ".join(f"{2 * (-1) ** (k - 1)} * exp(-{2 * k * k} * {t} * {t})" for k in range(1, 9))
    near = " + ".join(f"exp(-{(2 * k - 1) ** 2} * pi() * pi() / (8 * {t} * {t}))" for k in range(1, 9))
    return f"CASE WHEN {t} < 1 THEN 1 - sqrt(2 * pi()) / {t} * ({near}) ELSE {far} END"


@query("ks_test", f"""
WITH m AS (SELECT avg(value) AS mu, stddev_samp(value) AS sd, count(value)::DOUBLE AS n FROM events),
e AS (SELECT value, row_number() OVER (ORDER BY value) AS i FROM events WHERE value IS NOT NULL),
c AS (SELECT i, {normal_cdf_sql("z")} AS c FROM (SELECT i, (value - mu) / sd AS z FROM e, m)),
d AS (SELECT max(greatest(i / n - c, c - (i - 1) / n)) AS d FROM c, m)
SELECT round(d, 12) AS statistic, round({_tail_sql("(sqrt(n) * d)")}, 9) AS p_value, round(mu, 9) AS mean, round(sd, 9) AS sd
FROM d, m
""")
def ks_test(spark, sf):
    """One-sample Kolmogorov-Smirnov test of events.value against a fitted normal."""
    found = ks_normal(table(spark, sf, "events").select("value"), "value")
    return found.select(F.round("statistic", 12).alias("statistic"),
                        *[F.round(c, 9).alias(c) for c in ("p_value", "mean", "sd")])
