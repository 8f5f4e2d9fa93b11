"""The two-level (scale) path of the survival statistics equals the single-window path.

A hot analysis holds most subjects and its times are continuous, which is
the case the two-level running sums exist for.
"""

import numpy as np
import pytest

from tessera.operators import survival as sv
from tessera.operators.cox import cox_fit
from tessera.operators.cumulative import SumPlan, plan_running_sums


@pytest.fixture(scope="module")
def subjects(spark):
    rng = np.random.default_rng(11)
    rows = []
    for grp, n in ((0, 3000), (1, 200), (2, 150)):
        arm = rng.choice(["A", "R"], n)
        t = np.round(rng.exponential(5.0, n), 3) + 0.001  # continuous, with a few ties
        ev = (rng.random(n) < 0.7).astype(int)
        rows += [(grp, a, float(x), int(e), False) for a, x, e in zip(arm, t, ev)]
    return spark.createDataFrame(rows, "grp int, arm string, time double, event int, drop_out boolean")


def _by(df, keys):
    return {tuple(r[k] for k in keys): r for r in df.collect()}


def test_ranged_equals_window(subjects):
    lv = ("A", "R")
    et_w, plan_w = sv.event_table_and_plan(subjects, "grp", "arm", lv, method="window")
    auto = plan_running_sums(sv.event_table(subjects, "grp", "arm", lv), "time", blocks=16)
    ranged = SumPlan("ranged", auto.bounds, auto.n_rows)
    assert len(ranged.bounds) > 4
    et_r, _ = sv.event_table_and_plan(subjects, "grp", "arm", lv, method=ranged)

    a, b = _by(et_w, ["grp", "time"]), _by(et_r, ["grp", "time"])
    assert a.keys() == b.keys()
    assert all((a[k]["n0"], a[k]["n1"]) == (b[k]["n0"], b[k]["n1"]) for k in a)

    cw = sv.km_curve(et_w, "grp", lv, method="window")
    cr = sv.km_curve(et_r, "grp", lv, method=ranged)
    a, b = _by(cw, ["grp", "arm", "time"]), _by(cr, ["grp", "arm", "time"])
    assert a.keys() == b.keys()
    for k in a:
        assert a[k]["surv"] == pytest.approx(b[k]["surv"], rel=1e-12, abs=1e-15)
        assert a[k]["std_err"] == pytest.approx(b[k]["std_err"], rel=1e-12, abs=1e-15)

    ra = _by(sv.km_rmean(cw, "grp", method="window"), ["grp", "arm"])
    rb = _by(sv.km_rmean(cr, "grp", method=ranged), ["grp", "arm"])
    for k in ra:
        assert ra[k]["rmean"] == pytest.approx(rb[k]["rmean"], rel=1e-10)
        assert ra[k]["se_rmean"] == pytest.approx(rb[k]["se_rmean"], rel=1e-9)

    la, lb = _by(sv.logrank(et_w, "grp"), ["grp"]), _by(sv.logrank(et_r, "grp"), ["grp"])
    for k in la:
        assert la[k]["chisq"] == pytest.approx(lb[k]["chisq"], rel=1e-10)

    fa = _by(cox_fit(et_w, "grp", method="window"), ["grp"])
    fb = _by(cox_fit(et_r, "grp", method=ranged), ["grp"])
    for k in fa:
        for c in ("coef", "se", "robust_se"):
            assert fa[k][c] == pytest.approx(fb[k][c], rel=1e-8, abs=1e-12)


def test_auto_picks_ranged_above_limit(subjects):
    et = sv.event_table(subjects, "grp", "arm", ("A", "R"))
    assert plan_running_sums(et, "time").method == "window"
    assert plan_running_sums(et, "time", window_limit=100).method == "ranged"
