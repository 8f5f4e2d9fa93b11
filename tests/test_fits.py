"""Newton fits, isotonic regression and the KS test against MLlib and plain Python."""

import math
import random

import numpy as np
import pytest
from pyspark.ml.regression import AFTSurvivalRegression, GeneralizedLinearRegression, IsotonicRegression
from pyspark.ml.stat import KolmogorovSmirnovTest
from pyspark.sql import functions as F

from tessera.operators import ml
from tessera.operators.goodness import kolmogorov_tail, ks_normal
from tessera.operators.isotonic import isotonic, pool_adjacent
from tessera.operators.newton import logistic, newton, weibull


def _subjects(spark, n=600):
    r = random.Random(2)
    rows = []
    for _ in range(n):
        x, z = r.gauss(0, 1), r.choice([0.0, 1.0])
        t = math.exp(0.4 + 0.7 * z) * r.expovariate(1) ** 0.6
        rows.append((x, z, float(r.random() < 1 / (1 + math.exp(0.3 - 0.8 * x - 0.5 * z))), min(t, 3.0), float(t < 3.0)))
    return spark.createDataFrame(rows, "x double, z double, y double, t double, event double").repartition(3)


def test_logistic_equals_mllib(spark):
    df = ml.assemble(_subjects(spark), ["x", "z"])
    glm = GeneralizedLinearRegression(family="binomial", labelCol="y", maxIter=50, tol=1e-12).fit(df)
    fit = newton(df, [0.0] * 3, logistic(F.col("y"), [F.lit(1.0), F.col("x"), F.col("z")]), tol=1e-12)
    assert fit.converged and fit.rank == 3
    assert fit.coefficients == pytest.approx([glm.intercept, *glm.coefficients], rel=1e-6)
    errors = glm.summary.coefficientStandardErrors
    assert fit.std_errors == pytest.approx([errors[2], *errors[:2]], rel=1e-5)
    assert -2 * fit.log_likelihood == pytest.approx(glm.summary.deviance, rel=1e-9)


def test_weibull_equals_mllib(spark):
    df = ml.assemble(_subjects(spark), ["x", "z"]).withColumn("l", F.log("t"))
    aft = AFTSurvivalRegression(labelCol="t", censorCol="event", maxIter=500, tol=1e-10).fit(df)
    fit = newton(df, [0.0, 0.0, 0.0, 1.0], weibull(F.col("l"), F.col("event"), [F.lit(1.0), F.col("x"), F.col("z")]))
    *theta, tau = fit.coefficients
    assert [v / tau for v in theta] == pytest.approx([aft.intercept, *aft.coefficients], abs=1e-3)
    assert 1 / tau == pytest.approx(aft.scale, rel=1e-3) and fit.converged


def test_weights_are_repeated_rows_and_odd_inputs_end(spark):
    df = _subjects(spark, 60).select("z", "y")
    parts = [F.lit(1.0), F.col("z")]
    one = newton(df, [0.0, 0.0], logistic(F.col("y"), parts))
    counted = df.groupBy("z", "y").agg(F.count(F.lit(1)).cast("double").alias("w"))
    two = newton(counted, [0.0, 0.0], logistic(F.col("y"), parts, F.col("w")))
    assert one.coefficients == pytest.approx(two.coefficients) and one.std_errors == pytest.approx(two.std_errors)
    twice = newton(df, [0.0] * 3, logistic(F.col("y"), [*parts, F.col("z")]))  # a column given twice
    assert twice.rank == 2 and twice.log_likelihood == pytest.approx(one.log_likelihood)
    none = newton(df.limit(0), [0.0, 0.0], logistic(F.col("y"), parts))
    assert not none.converged and none.rank == 0 and none.coefficients == [0.0, 0.0]
    apart = spark.createDataFrame([(float(i), float(i >= 5)) for i in range(10)], "z double, y double")
    assert newton(apart, [0.0, 0.0], logistic(F.col("y"), parts), max_steps=8).steps <= 8  # no finite estimate


def _xy(n, seed):
    r = random.Random(seed)
    return [(r.randrange(n) / 2, r.gauss(0, 3) + n / 40 * math.sin(i)) for i in range(n)]


@pytest.mark.parametrize("parts", [1, 4, 16])
@pytest.mark.parametrize("range_rows", [100_000, 37, 3])
def test_isotonic_at_any_partitioning(spark, parts, range_rows):
    rows = _xy(300, 3) + [(None, 1.0), (1.0, None)]
    df = spark.createDataFrame(rows, "x double, y double").repartition(parts)
    got = sorted(tuple(r) for r in isotonic(df, "x", "y", range_rows=range_rows).collect())
    x = np.array(sorted({a for a, b in rows if a is not None and b is not None}))
    w = np.array([sum(a == v and b is not None for a, b in rows) for v in x], float)
    t = np.array([sum(b for a, b in rows if a == v and b is not None) for v in x])
    want = pool_adjacent(x, x, w, t)
    assert [g[:3] for g in got] == [v[:3] for v in want] and [g[3] for g in got] == pytest.approx([v[3] for v in want])
    means = [g[3] / g[2] for g in got]
    assert all(a < b for a, b in zip(means, means[1:]))


@pytest.mark.parametrize("shape", ["falling", "rising", "saw"])
def test_isotonic_shapes_in_small_ranges(spark, shape):
    y = {"falling": lambda i: -i, "rising": lambda i: i, "saw": lambda i: i % 7}[shape]
    df = spark.createDataFrame([(float(i), float(y(i))) for i in range(200)], "x double, y double")
    got = sorted(tuple(r) for r in isotonic(df, "x", "y", range_rows=8).collect())
    x = np.arange(200.0)
    assert got == pool_adjacent(x, x, np.ones(200), np.array([float(y(i)) for i in range(200)]))
    assert isotonic(df.limit(0), "x", "y").count() == 0


def test_isotonic_equals_mllib(spark):
    df = spark.createDataFrame(_xy(200, 8), "x double, y double")
    per_x = df.groupBy("x").agg(F.avg("y").alias("label"), F.count(F.lit(1)).cast("double").alias("weight"))
    model = IsotonicRegression(weightCol="weight").fit(ml.assemble(per_x, ["x"]))
    want = dict(zip(map(float, model.boundaries), map(float, model.predictions)))
    got = {}
    for r in isotonic(df, "x", "y", range_rows=50).collect():
        got[r["lo"]] = got[r["hi"]] = r["total"] / r["weight"]
    assert set(got) == set(want) and all(got[x] == pytest.approx(want[x]) for x in got)


def test_ks_equals_mllib_and_series(spark):
    r = random.Random(6)
    df = spark.createDataFrame([(round(r.gauss(3, 2), 1),) for _ in range(700)] + [(None,)], "v double").repartition(5)
    got = ks_normal(df, "v", 3.1, 2.2).first()
    want = KolmogorovSmirnovTest.test(df.na.drop(), "v", "norm", 3.1, 2.2).first()
    assert got["n"] == 700 and got["statistic"] == pytest.approx(want["statistic"], rel=1e-9)
    assert got["p_value"] == pytest.approx(want["pValue"], abs=0.02)  # MLlib's is not the limit's
    ts = [0.3, 0.8, 0.99, 1.0, 1.36, 2.5]
    tails = spark.createDataFrame([(t,) for t in ts], "t double").select("t", kolmogorov_tail(F.col("t")).alias("p")).collect()
    for t, p in tails:
        assert p == pytest.approx(2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * t * t) for k in range(1, 400)), abs=1e-9)
    assert ks_normal(df.limit(0), "v").first()["statistic"] is None
