"""The driver contract."""

import importlib.util
import os

from conftest import ROOT, SF_SMALL


def _entry():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_entry_runs(spark):
    df = _entry().entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["n_name", "n_1997", "n_1998", "growth"]
    g = [r["growth"] for r in rows]
    assert g == sorted(g, reverse=True) and 0 not in g


def test_oracle_keys_are_queries():
    m = _entry()
    q, o = m.queries(), m.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 90


def test_flagship_plan_prunes_and_pushes(spark):
    from tessera.plans.relational import urban_growth

    plan = urban_growth(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in plan
    assert "ReadSchema: struct<o_custkey:bigint,o_orderdate:timestamp_ntz>" in plan
