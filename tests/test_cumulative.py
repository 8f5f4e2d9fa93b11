"""Running sums: the window and two-level forms agree with pandas, also with a hot key."""

import numpy as np
import pandas as pd
import pytest

from tessera.operators.cumulative import block_of, running_sums
from tessera.operators.profile import exact_quantiles


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    keys = np.r_[np.zeros(3000, dtype=int), rng.integers(1, 40, 3000)]  # key 0 holds half the rows
    t = rng.random(keys.size) * 100
    pdf = (pd.DataFrame({"k": keys, "t": t, "v": rng.integers(0, 5, keys.size)})
           .drop_duplicates(["k", "t"]).reset_index(drop=True))
    return pdf, spark.createDataFrame(pdf)


@pytest.mark.parametrize("method", ["window", "ranged", "auto"])
def test_running_sums(data, method):
    pdf, df = data
    out = running_sums(df, ["k"], "t", ["v"], suffix_prefix="r_", method=method, blocks=16).toPandas()
    exp = pdf.sort_values(["k", "t"]).copy()
    exp["cum_v"] = exp.groupby("k")["v"].cumsum()
    exp["r_v"] = exp.groupby("k")["v"].transform("sum") - exp["cum_v"] + exp["v"]
    got = out.sort_values(["k", "t"]).reset_index(drop=True)
    exp = exp.reset_index(drop=True)
    assert (got["cum_v"].to_numpy() == exp["cum_v"].to_numpy()).all()
    assert (got["r_v"].to_numpy() == exp["r_v"].to_numpy()).all()


def test_global_running_sum_uses_blocks(data):
    pdf, df = data
    out = running_sums(df.select("t", "v"), [], "t", ["v"], blocks=8).toPandas().sort_values("t")
    assert (out["cum_v"].to_numpy() == pdf.sort_values("t")["v"].cumsum().to_numpy()).all()


def test_block_of_is_monotone(spark):
    from pyspark.sql import functions as F

    bounds = [1.0, 5.0, 7.5]
    df = spark.createDataFrame([(x,) for x in [0.0, 1.0, 1.5, 5.0, 6.0, 7.5, 9.0]], "x double")
    got = [r["b"] for r in df.select(block_of(F.col("x"), bounds).alias("b")).collect()]
    assert got == [0, 0, 1, 1, 2, 2, 3]


def test_exact_quantiles_match_numpy(data):
    pdf, df = data
    q = exact_quantiles(df, "t", [0.0, 0.25, 0.5, 0.9, 1.0])
    for p, v in q.items():
        assert v == pytest.approx(float(np.quantile(pdf["t"], p)), rel=1e-12)


def test_exact_quantiles_many_match_numpy(spark):
    from tessera.operators.profile import exact_quantiles_many

    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"a": rng.random(3001), "b": rng.integers(0, 7, 3001).astype(float)})
    pdf.loc[::10, "a"] = np.nan
    df = spark.createDataFrame(pdf).replace(float("nan"), None)
    got = exact_quantiles_many(df, ["a", "b"], [0.1, 0.5, 0.75])
    for c in ("a", "b"):
        vals = pdf[c].dropna().to_numpy()
        for p in (0.1, 0.5, 0.75):
            assert got[c][p] == pytest.approx(float(np.quantile(vals, p)), rel=1e-12)


def test_exact_quantiles_ranked_path_matches_numpy(spark):
    from tessera.operators.profile import exact_quantiles_many

    rng = np.random.default_rng(6)
    pdf = pd.DataFrame({"a": rng.random(2001), "b": rng.integers(0, 5, 2001).astype(float)})
    df = spark.createDataFrame(pdf)
    got = exact_quantiles_many(df, ["a", "b"], [0.25, 0.9], limit=100)  # "a" takes the ranked path
    for c in ("a", "b"):
        for p in (0.25, 0.9):
            assert got[c][p] == pytest.approx(float(np.quantile(pdf[c], p)), rel=1e-12)
