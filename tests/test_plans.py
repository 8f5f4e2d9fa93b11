"""Plan audit: no registered query plans a cartesian product, a nested-loop join
or a row-at-a-time Python UDF (model fits are skipped: MLlib owns those plans)."""

import pytest

from conftest import SF_SMALL
from tessera.plans.catalog import QUERIES

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython")
NAMES = sorted(n for n in QUERIES if not n.startswith(("ml_", "glm_", "kmeans_", "rf_", "ks_", "model_")))


@pytest.mark.parametrize("name", NAMES)
def test_plan_has_no_forbidden_operator(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for op in FORBIDDEN:
        assert op not in plan, f"{name} plans {op}"


def test_survival_record_scans_subjects_once(spark):
    """After the event-time table is written, the per-analysis record reads only
    small written tables: the subject table is not scanned a second time."""
    df = QUERIES["parallel_group_analysis"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "lineitem.parquet" not in plan
