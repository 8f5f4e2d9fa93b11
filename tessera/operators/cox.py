"""Cox proportional hazards for one two-level covariate, Efron ties, robust variance.

Fitted for every group at once on the event-time table (one row per group and
distinct time), never on subject rows, and by one path whatever the size: each
Newton step is one aggregate over the event-time rows, map-side combined.

With x in {0, 1} and theta = exp(b), at a time with risk sums
S0 = n0 + n1 theta, S1 = n1 theta and event sums D0 = d0 + d1 theta,
D1 = d1 theta, d = d0 + d1, tie step r = 0..d-1 has a_r = S0 - (r/d) D0 and
xbar_r = (S1 - (r/d) D1) / a_r:

    score  U = sum_t [ d1 - sum_r xbar_r ]
    info   I = sum_t sum_r xbar_r (1 - xbar_r)

The sums over r have a closed form, so a time with a huge tie costs no more
than any other. xbar_r = p + q / a_r with p = D1 / D0 and q = S1 - p S0, hence
everything follows from sums of 1 / a_r and 1 / a_r^2. With
y = d (S0 - D0) / D0 + 1 the steps are a_r = (D0 / d)(y + j), j = d-1-r, so
those are differences of the digamma and trigamma functions between y and
y + d. The first ``EXPLICIT`` terms are added one by one; the rest lies where
the asymptotic series is exact to double precision, and is taken as a
difference term by term, so that nothing cancels.

The robust (sandwich) variance is sum_i U_i^2 / I^2 with subject score
residuals U_i; subjects sharing (arm, time, status) share U_i, so the sum is
taken over the four cells of each event-time row weighted by their counts.

Every group of the table gives one row. ``converged`` is false, and the
estimates are NULL, where there is nothing to estimate (no events, one arm)
or the estimate runs off to infinity.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.stats import Z_975
from tessera.operators.cumulative import running_sums
from tessera.session import materialize

# tie terms added one by one; the series then starts above 7, where its error is below 1e-11
EXPLICIT = 6
STEPS_PER_JOB = 5
MAX_STEP = 5.0  # longest Newton step on the log scale
MIN_INFO = 1e-9  # least information per event that counts as estimable


def _digamma_tail(x: str) -> str:
    """SQL of psi(x) - ln(x), asymptotically."""
    w = f"(1 / ({x} * {x}))"
    return (f"(-0.5D / {x} - {w} * (1D / 12 - {w} * (1D / 120 - {w} * (1D / 252 - {w} * (1D / 240 - {w} * (1D / 132))))))")


def _trigamma_tail(x: str) -> str:
    """SQL of psi'(x) - 1 / x, asymptotically."""
    w = f"(1 / ({x} * {x}))"
    return (f"({w} * (0.5D + (1D / 6 - {w} * (1D / 30 - {w} * (1D / 42 - {w} * (1D / 30 - {w} * (5D / 66))))) / {x}))")


def _explicit(term) -> str:
    return " + ".join(f"CASE WHEN tied > {j} THEN {term(j)} ELSE 0D END" for j in range(EXPLICIT))


_MANY = f"tied > {EXPLICIT}"
# the layers of _tie_sums, as SQL: each may use the names of those before it
_LAYERS = [
    # a time without events has no tie steps: every sum is 0
    {"risk": "n0 + n1 * theta", "risk1": "n1 * theta", "dying": "CASE WHEN d0 + d1 > 0 THEN d0 + d1 * theta ELSE 1D END",
     "dying1": "d1 * theta", "tied": "CAST(d0 + d1 AS DOUBLE)"},
    {"p": "dying1 / dying", "z": "tied * (risk - dying) / dying"},
    {"q": "risk1 - p * risk", "y": "z + 1", "x0": f"z + {1 + EXPLICIT}", "x1": "z + 1 + tied"},
    {"h1": _explicit(lambda j: f"1 / (y + {j})")
     + f" + CASE WHEN {_MANY} THEN log1p((tied - {EXPLICIT}) / x0) + {_digamma_tail('x1')} - {_digamma_tail('x0')} ELSE 0D END",
     "h2": _explicit(lambda j: f"1 / ((y + {j}) * (y + {j}))")
     + f" + CASE WHEN {_MANY} THEN (tied - {EXPLICIT}) / (x0 * x1) + {_trigamma_tail('x0')} - {_trigamma_tail('x1')} ELSE 0D END"},
    {"g1": f"CASE WHEN {_MANY} THEN tied - z * h1 ELSE " + _explicit(lambda j: f"{j + 1} / (y + {j})") + " END",
     "g2": f"CASE WHEN {_MANY} THEN h1 - z * h2 ELSE "
           + _explicit(lambda j: f"{j + 1} / ((y + {j}) * (y + {j}))") + " END"},
    {"a1": "tied / dying * h1", "a2": "tied / dying * tied / dying * h2", "b1": "g1 / dying",
     "b2": "tied / dying / dying * g2"},
]


def _tie_sums(rows: DataFrame, beta: str) -> DataFrame:
    """Add theta, p, q, a1 = sum 1/a_r, a2 = sum 1/a_r^2 and the same weighted by 1 - r/d (b1, b2)."""
    # one projection whose names may be used by those after them: analysed once, not layer by layer
    return rows.selectExpr("*", f"exp({beta}) AS theta", *[f"{text} AS {name}" for layer in _LAYERS for name, text in layer.items()])


def _xbar_sum() -> Column:
    return F.expr("tied * p + q * a1")


def _info() -> Column:
    return F.expr("tied * p * (1 - p) + q * (1 - 2 * p) * a1 - q * q * a2")


def _newton_step(events: DataFrame, state: DataFrame, group: str, tol: float) -> DataFrame:
    """One step for every group that still moves (state: group, beta, active, converged, iterations)."""
    rows = _tie_sums(events.join(state, group), "beta")
    moved = rows.groupBy(group).agg(
        F.sum(F.col("d1") - _xbar_sum()).alias("u"), F.sum(_info()).alias("info"), F.sum("tied").alias("deaths"),
        *[F.max(c).alias(c) for c in ("beta", "active", "converged", "iterations")])
    estimable = F.col("active") & (F.col("info") > MIN_INFO * F.col("deaths"))
    step = F.when(estimable, F.greatest(F.lit(-MAX_STEP), F.least(F.lit(MAX_STEP), F.col("u") / F.col("info"))))
    moved = moved.withColumn("step", step)
    done = F.coalesce(F.abs("step") < tol, F.lit(True))
    return moved.select(
        group, (F.col("beta") + F.coalesce("step", F.lit(0.0))).alias("beta"), (F.col("active") & ~done).alias("active"),
        (F.col("converged") | (done & F.col("step").isNotNull())).alias("converged"),
        (F.col("iterations") + F.col("active").cast("int")).alias("iterations"))


def cox_fit(et: DataFrame, group: str, time: str = "time", max_iter: int = 30,
            tol: float = 1e-6, method="auto") -> DataFrame:
    """Per group: coef, model and robust standard errors, hazard ratio and 95% limits, converged, iterations.

    ``et`` is read several times: pass a written table. ``method`` is a running-sum plan.
    Newton's error is about the square of its last step, so ``tol`` on the step is enough.
    """
    counts = materialize(et.groupBy(group).agg(F.sum(F.col("m0") + F.col("m1")).alias("n"),
                                               F.sum(F.col("d0") + F.col("d1")).alias("n_events")))
    events = et.filter(F.col("d0") + F.col("d1") > 0).select(group, "d0", "d1", "n0", "n1")
    state = counts.filter("n_events > 0").select(
        group, F.lit(0.0).alias("beta"), F.lit(True).alias("active"), F.lit(False).alias("converged"),
        F.lit(0).alias("iterations"))
    for _ in range(-(-max_iter // STEPS_PER_JOB)):
        for _ in range(STEPS_PER_JOB):
            state = _newton_step(events, state, group, tol)
        state = materialize(state)
        if state.filter("active").isEmpty():
            break
    beta = state.filter("converged").select(group, F.col("beta").alias("coef"))

    rows = _tie_sums(et.join(beta, group), "coef")
    full = rows.select(
        *et.columns, "coef", _info().alias("info"), F.col("a1").alias("h"), F.expr("p * a1 + q * a2").alias("hx"),
        F.col("b1").alias("hd"), F.expr("p * b1 + q * b2").alias("hxd"),
        F.when(F.col("tied") > 0, _xbar_sum() / F.col("tied")).otherwise(F.lit(0.0)).alias("xm"))
    cum = running_sums(full, [group], time, ["h", "hx"], prefix="c", method=method)
    th = F.exp("coef")
    h_ex, hx_ex = F.col("ch") - F.col("h"), F.col("chx") - F.col("hx")

    def resid(x: int, dead: bool) -> Column:
        risk = F.lit(1.0) if x == 0 else th
        w, wx = (F.col("hd"), F.col("hxd")) if dead else (F.col("h"), F.col("hx"))
        r = -risk * (F.lit(float(x)) * (h_ex + w) - (hx_ex + wx))
        return (r + (F.lit(float(x)) - F.col("xm"))) if dead else r

    cells = [
        (F.col("d0"), resid(0, True)), (F.col("m0") - F.col("d0"), resid(0, False)),
        (F.col("d1"), resid(1, True)), (F.col("m1") - F.col("d1"), resid(1, False)),
    ]
    uu = sum(F.when(cnt > 0, cnt * r * r).otherwise(F.lit(0.0)) for cnt, r in cells)
    fit = cum.groupBy(group).agg(F.first("coef").alias("coef"), F.sum("info").alias("info"), F.sum(uu).alias("uu"))
    out = (counts.join(state.select(group, "converged", "iterations"), group, "left").join(fit, group, "left")
           .na.fill({"converged": False, "iterations": 0}))
    rse = F.sqrt("uu") / F.col("info")
    return out.select(
        group, "coef", F.exp("coef").alias("exp_coef"), F.exp(-F.col("coef")).alias("exp_neg_coef"),
        F.sqrt(1 / F.col("info")).alias("se"), rse.alias("robust_se"),
        F.exp(F.col("coef") - F.lit(Z_975) * rse).alias("lower_95"),
        F.exp(F.col("coef") + F.lit(Z_975) * rse).alias("upper_95"),
        "n", "n_events", "converged", "iterations")
