"""Survival statistics on hand-worked cases and invariants."""

import math

import pytest
from pyspark.sql import functions as F

from conftest import SF_MID
from tessera.operators import survival as sv
from tessera.operators.cox import cox_fit

# (arm, time, event)
SUBJECTS = [("A", 1.0, 1), ("A", 2.0, 0), ("A", 3.0, 1), ("A", 3.0, 1), ("A", 5.0, 0),
            ("R", 2.0, 1), ("R", 3.0, 0), ("R", 4.0, 1)]


def _subjects(spark, rows=SUBJECTS, grp=7):
    return spark.createDataFrame([(grp, i, a, t, e, False) for i, (a, t, e) in enumerate(rows)],
                                 "grp int, sid int, arm string, time double, event int, drop_out boolean")


@pytest.fixture(scope="module")
def et(spark):
    return sv.event_table(_subjects(spark), "grp", "arm", ("A", "R")).cache()


def test_event_table_at_risk(et):
    rows = {r["time"]: r for r in et.collect()}
    assert (rows[1.0]["n0"], rows[1.0]["n1"]) == (5, 3)
    assert (rows[3.0]["n0"], rows[3.0]["n1"], rows[3.0]["d0"]) == (3, 2, 2)
    assert (rows[5.0]["n0"], rows[5.0]["n1"]) == (1, 0)


def test_km_by_hand(et):
    cur = {(r["arm"], r["time"]): r for r in sv.km_curve(et, "grp", ("A", "R")).collect()}
    assert cur[("A", 1.0)]["surv"] == pytest.approx(0.8)
    assert cur[("A", 2.0)]["surv"] == pytest.approx(0.8)
    assert cur[("A", 3.0)]["surv"] == pytest.approx(0.8 / 3)
    assert cur[("R", 2.0)]["surv"] == pytest.approx(2 / 3)
    assert cur[("R", 4.0)]["surv"] == 0.0  # the last subject at risk dies
    # Greenwood: sum d / (n (n - d)) over A's event times
    assert cur[("A", 3.0)]["std_err"] == pytest.approx(math.sqrt(1 / (5 * 4) + 2 / (3 * 1)))


def test_logrank_by_hand(et):
    r = sv.logrank(et, "grp").first()
    e = 3 / 8 + 3 / 7 + 2 * 2 / 5 + 1 / 2
    v = (3 / 8) * (5 / 8) + (3 / 7) * (4 / 7) + 2 * (2 / 5) * (3 / 5) * (3 / 4) + (1 / 2) * (1 / 2)
    assert r["observed_trt"] == 2 and r["observed_ref"] == 3
    assert r["expected_trt"] == pytest.approx(e)
    assert r["variance"] == pytest.approx(v)
    assert r["chisq"] == pytest.approx((2 - e) ** 2 / v)
    p = sv.with_pvalue(sv.logrank(et, "grp")).first()["pval"]
    assert p == pytest.approx(math.erfc(math.sqrt(r["chisq"] / 2)))


def test_median_and_rmean(spark):
    # A: deaths at 1, 2 -> S = 3/4, 1/2 exactly at t=2 (flat until 4) -> median = (2 + 4) / 2
    rows = [("A", 1.0, 1), ("A", 2.0, 1), ("A", 4.0, 1), ("A", 6.0, 0), ("R", 1.0, 1), ("R", 3.0, 0)]
    et = sv.event_table(_subjects(spark, rows), "grp", "arm", ("A", "R"))
    cur = sv.km_curve(et, "grp", ("A", "R"))
    med = {r["arm"]: r for r in sv.km_median(cur, "grp").collect()}
    assert med["A"]["median"] == pytest.approx(3.0)
    assert med["R"]["median"] == pytest.approx(1.0)  # S sits at 1/2 to the end: first time reached
    rm = {r["arm"]: r for r in sv.km_rmean(cur, "grp").collect()}
    # tau = 6; A: 1*1 + .75*1 + .5*2 + .25*2 = 3.25
    assert rm["A"]["rmean"] == pytest.approx(3.25)
    assert rm["A"]["tau"] == 6.0


def _efron_loglik(rows, beta):
    """Efron partial log-likelihood straight from subject rows (x = 1 for arm R)."""
    ll = 0.0
    times = sorted({t for _, t, e in rows if e})
    for t in times:
        risk = [(1.0 if a == "R" else 0.0) for a, tt, _ in rows if tt >= t]
        dead = [(1.0 if a == "R" else 0.0) for a, tt, e in rows if tt == t and e]
        s0 = sum(math.exp(beta * x) for x in risk)
        dsum = sum(math.exp(beta * x) for x in dead)
        d = len(dead)
        ll += beta * sum(dead) - sum(math.log(s0 - r / d * dsum) for r in range(d))
    return ll


def test_cox_maximises_efron_likelihood(spark):
    rows = SUBJECTS + [("R", 1.0, 1), ("A", 4.0, 1), ("R", 6.0, 0), ("A", 2.0, 1)]
    et = sv.event_table(_subjects(spark, rows), "grp", "arm", ("A", "R"))
    fit = cox_fit(et, "grp").first()
    b = fit["coef"]
    h = 1e-4
    grad = (_efron_loglik(rows, b + h) - _efron_loglik(rows, b - h)) / (2 * h)
    curv = (_efron_loglik(rows, b + h) - 2 * _efron_loglik(rows, b) + _efron_loglik(rows, b - h)) / h ** 2
    assert abs(grad) < 1e-6
    assert fit["se"] == pytest.approx(1 / math.sqrt(-curv), rel=1e-4)
    swapped = cox_fit(sv.event_table(_subjects(spark, rows), "grp", "arm", ("R", "A")), "grp").first()
    assert swapped["coef"] == pytest.approx(-b, abs=1e-9)
    assert swapped["robust_se"] == pytest.approx(fit["robust_se"], rel=1e-9)


def _newton(rows, steps=40):
    """Efron Newton with every tie step written out."""
    beta = 0.0
    for _ in range(steps):
        u = info = 0.0
        for t in sorted({t for _, t, e in rows if e}):
            n = [sum(1 for a, tt, _ in rows if tt >= t and a == k) for k in "AR"]
            d = [sum(1 for a, tt, e in rows if tt == t and e and a == k) for k in "AR"]
            th, u = math.exp(beta), u + d[1]
            for r in range(sum(d)):
                f = r / sum(d)
                xb = (n[1] - f * d[1]) * th / ((n[0] - f * d[0]) + (n[1] - f * d[1]) * th)
                u, info = u - xb, info + xb * (1 - xb)
        beta += u / info
    return beta, 1 / math.sqrt(info)


@pytest.mark.parametrize("ties", [1, 3, 10, 11, 40, 400])
def test_cox_tie_sums_in_closed_form(spark, ties):
    rows = [("A", 1.0, 1)] * ties + [("R", 1.0, 1)] * (2 * ties) + [("A", 2.0, 0)] * (3 * ties)
    rows += [("R", 3.0, 1)] * ties + [("A", 3.0, 1)] * 2 + [("R", 4.0, 0), ("A", 5.0, 1), ("R", 6.0, 1)]
    fit = cox_fit(sv.event_table(_subjects(spark, rows), "grp", "arm", ("A", "R")), "grp").first()
    beta, se = _newton(rows)
    assert fit["converged"] and fit["coef"] == pytest.approx(beta, rel=1e-9, abs=1e-11)
    assert fit["se"] == pytest.approx(se, rel=1e-9)
    if ties <= 40:
        assert fit["robust_se"] == pytest.approx(_robust_se_by_subject(rows, beta), rel=1e-8)


def test_cox_gives_a_row_to_every_analysis(spark):
    """No event, one arm, an estimate at infinity: NULL and not converged, beside a proper fit."""
    parts = {1: SUBJECTS, 2: [("A", 1.0, 0), ("R", 2.0, 0)], 3: [("A", 1.0, 1), ("A", 2.0, 1)],
             4: [("R", 1.0, 1)] * 3 + [("A", 9.0, 0)] * 3, 5: [("R", 1.0, 1), ("R", 3.0, 0)]}
    s = None
    for g, rows in parts.items():
        one = _subjects(spark, rows, g)
        s = one if s is None else s.unionByName(one)
    fits = {r["grp"]: r for r in cox_fit(sv.event_table(s, "grp", "arm", ("A", "R")), "grp").collect()}
    assert set(fits) == set(parts)
    assert [g for g in fits if fits[g]["converged"]] == [1]
    for g in (2, 3, 4, 5):
        assert all(fits[g][c] is None for c in ("coef", "exp_coef", "se", "robust_se", "lower_95", "upper_95"))
        assert fits[g]["n"] == len(parts[g])
    assert fits[1]["iterations"] < 10


def test_event_counts_do_not_grow_the_fit(spark):
    """A hundred million events at a time are one row of the fit."""
    def table(k):
        return spark.createDataFrame([(1, 1.0, 3 * k, 2 * k, 4 * k, 3 * k, 9 * k, 8 * k), (1, 2.0, 6 * k, 5 * k, 4 * k, k, 6 * k, 4 * k)],
                                     "grp int, time double, m0 long, d0 long, m1 long, d1 long, n0 long, n1 long")

    small, large = (cox_fit(table(k), "grp").first() for k in (1000, 100_000_000))
    assert large["coef"] == pytest.approx(small["coef"], rel=1e-2)
    assert large["se"] == pytest.approx(small["se"] / math.sqrt(100_000), rel=1e-2)


@pytest.mark.parametrize("n", [10, 40])
def test_median_limits_by_hand(spark, n):
    """One event a day: S falls by 1/n; the bands are worked out directly."""
    rows = [("A", float(t), 1) for t in range(1, n + 1)]
    cur = sv.km_curve(sv.event_table(_subjects(spark, rows), "grp", "arm", ("A", "R")), "grp", ("A", "R"))
    gw, lower, upper = 0.0, None, None
    for t in range(1, n):
        risk = n + 1 - t
        gw += 1 / (risk * (risk - 1))
        surv = (risk - 1) / n
        lower = lower or (t if surv * math.exp(-1.959963984540054 * math.sqrt(gw)) <= 0.5 else None)
        upper = upper or (t if surv * math.exp(1.959963984540054 * math.sqrt(gw)) <= 0.5 else None)
    got = sv.km_median(cur, "grp").first()
    assert (got["median"], got["lcl_95"], got["ucl_95"]) == (n / 2 + 0.5, lower, upper)
    assert lower < got["median"] and (upper is None if n == 10 else upper > got["median"])
    last = cur.filter(F.col("time") == n).first()
    assert last["surv"] == 0 and last["lower"] is None and last["upper"] is None


def test_median_lies_between_its_limits(spark):
    from tessera.plans.catalog import QUERIES

    for name, prefixes in (("km_median", [""]), ("parallel_group_analysis", ["ref_", "trt_"]), ("survival_bundle", ["ref_", "trt_"])):
        full = 0
        for r in QUERIES[name](spark, SF_MID).collect():
            for p in prefixes:
                lo, mid, hi = r[p + "lcl_95"], r[p + "median"], r[p + "ucl_95"]
                assert mid is None or lo is not None and lo <= mid
                assert hi is None or mid <= hi
                full += None not in (lo, mid, hi)
        assert full > 20, name


def test_cox_matches_recorded_probe(spark):
    """Pooled lineitem trial at sf0.01, R against A (values recorded in the survey)."""
    from tessera.plans.fixtures import lineitem_trial

    s = lineitem_trial(spark, SF_MID).withColumn("grp", F.lit(1))
    fit = cox_fit(sv.event_table(s, "grp", "arm", ("A", "R")), "grp").first()
    assert fit["coef"] == pytest.approx(-0.0022218470, abs=5e-11)
    assert fit["se"] == pytest.approx(0.0181818426, abs=5e-11)
    assert fit["robust_se"] == pytest.approx(0.0181812639, abs=5e-11)


def test_censoring_and_dropouts(spark):
    df = spark.createDataFrame([(1, 10.0, 1), (2, 30.0, 1), (3, 31.0, 1), (4, 12.0, 0)],
                               "k int, full_time double, ev int")
    out = {r["k"]: r for r in sv.admin_censor(df, "full_time", "ev", 30.0).collect()}
    assert (out[2]["event"], out[2]["time"]) == (1, 30.0)  # an event exactly at the lock counts
    assert (out[3]["event"], out[3]["time"]) == (0, 30.0)
    assert out[4]["event"] == 0
    drops = spark.createDataFrame([(1, 5.0), (1, 3.0), (9, 1.0)], "k int, drop_time double")
    d = {r["k"]: r for r in sv.apply_dropouts(sv.admin_censor(df, "full_time", "ev", 30.0), drops, "k").collect()}
    assert (d[1]["event"], d[1]["time"], d[1]["drop_out"]) == (0, 3.0, True)  # smallest duplicate time
    assert d[2]["drop_out"] is False and 9 not in d


def test_one_arm_and_all_censored(spark):
    rows = [("A", 1.0, 0), ("A", 2.0, 0)]
    et = sv.event_table(_subjects(spark, rows), "grp", "arm", ("A", "R"))
    cur = sv.km_curve(et, "grp", ("A", "R")).collect()
    assert {r["arm"] for r in cur} == {"A"} and all(r["surv"] == 1.0 for r in cur)
    lr = sv.logrank(et, "grp").collect()
    assert lr == []  # no event time: no test


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_same_answer_at_any_partitioning(spark, parts):
    from conftest import SF_SMALL
    from tessera.plans.fixtures import lineitem_trial

    lv = ("A", "R")

    def run(df):
        et, plan = sv.event_table_and_plan(df, "grp", "arm", lv)
        cur = {(r["grp"], r["arm"], r["time"]): round(r["surv"], 12)
               for r in sv.km_curve(et, "grp", lv, method=plan).collect()}
        lr = {r["grp"]: round(r["chisq"] or 0.0, 9) for r in sv.logrank(et, "grp").collect()}
        cx = {r["grp"]: round(r["coef"], 9) for r in cox_fit(et, "grp", method=plan).collect()}
        return cur, lr, cx

    base = run(lineitem_trial(spark, SF_SMALL))
    assert run(lineitem_trial(spark, SF_SMALL).repartition(parts)) == base


def test_pvalue_expression_matches_erfc(spark):
    from tessera.functions.stats import chisq1_pvalue

    xs = [0.0, 0.3, 1.0, 3.84, 7.99, 8.0, 8.01, 25.0, 100.0, 400.0]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = [r[0] for r in df.select(chisq1_pvalue(F.col("x"))).collect()]
    for x, p in zip(xs, got):
        e = math.erfc(math.sqrt(x / 2))
        assert p == pytest.approx(e, rel=1e-13, abs=1e-300)


def _robust_se_by_subject(rows, beta):
    """Sandwich se from per-subject Efron score residuals, straight from the definition."""
    xs = [1.0 if a == "R" else 0.0 for a, _, _ in rows]
    th = [math.exp(beta * x) for x in xs]
    u = [0.0] * len(rows)
    info = 0.0
    for t in sorted({t for _, t, e in rows if e}):
        risk = [i for i, (_, tt, _) in enumerate(rows) if tt >= t]
        dead = [i for i, (_, tt, e) in enumerate(rows) if tt == t and e]
        d = len(dead)
        for r in range(d):
            a = sum(th[i] for i in risk) - r / d * sum(th[i] for i in dead)
            xb = (sum(th[i] * xs[i] for i in risk) - r / d * sum(th[i] * xs[i] for i in dead)) / a
            info += xb * (1 - xb)
            for i in risk:
                w = (1 - r / d) if i in dead else 1.0
                u[i] -= w * th[i] * (xs[i] - xb) / a
            for i in dead:
                u[i] += (xs[i] - xb) / d
    return math.sqrt(sum(v * v for v in u)) / info


def test_robust_se_equals_subject_level_sandwich(spark):
    rows = SUBJECTS + [("R", 1.0, 1), ("A", 4.0, 1), ("R", 6.0, 0), ("A", 2.0, 1), ("R", 3.0, 1)]
    et = sv.event_table(_subjects(spark, rows), "grp", "arm", ("A", "R"))
    fit = cox_fit(et, "grp").first()
    assert fit["robust_se"] == pytest.approx(_robust_se_by_subject(rows, fit["coef"]), rel=1e-10)
