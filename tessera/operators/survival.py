"""Survival statistics over subject tables, for any number of analyses at once.

A subject table has one row per subject: ``group`` (the analysis), ``arm``,
``time`` and ``event`` (1 = event seen, 0 = censored). Everything is derived
from the *event-time table*: one row per (group, distinct time) with subject
and event counts per arm, plus the numbers at risk. That table is an
algebraic aggregate (partial aggregation before the shuffle), and its size is
bounded by distinct times, not subjects. Cumulative quantities (at risk,
survival, hazards) use :func:`running_sums`, whose window partitions are
bounded blocks rather than whole groups.

Arm levels are explicit: ``levels[0]`` is the reference arm (x = 0),
``levels[1]`` the treated arm (x = 1) of the Cox model.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.stats import Z_975, erfc_col
from tessera.operators.cumulative import SumPlan, materialize_planned, running_sums
from tessera.operators.verbs import one_per_key, update_from
from tessera.session import materialize

# fixed value: tolerance when testing a survival curve against 0.5
MEDIAN_TOL = 1e-8


def admin_censor(df: DataFrame, full_time: str, event: Column | str, lock: float,
                 time_out: str = "time", event_out: str = "event") -> DataFrame:
    """Administrative censoring at a database lock.

    event = 0 when the full time is strictly greater than the lock, else the
    given event; time = full time capped at the lock.
    """
    ev = F.col(event) if isinstance(event, str) else event
    ft = F.col(full_time)
    return df.withColumns({
        event_out: F.when(ft > F.lit(lock), F.lit(0)).otherwise(ev.cast("int")),
        time_out: F.least(ft, F.lit(lock)).cast("double"),
    })


def apply_dropouts(subjects: DataFrame, drops: DataFrame, key: str,
                   drop_time: str = "drop_time") -> DataFrame:
    """Keyed drop-out override: matched subjects get event 0, time = drop time.

    Duplicate keys in ``drops`` keep their smallest time. Adds ``drop_out``.
    """
    side = one_per_key(drops.select(key, drop_time), key, drop_time)
    return update_from(subjects, side, key,
                       {"event": F.lit(0), "time": F.col(drop_time).cast("double")},
                       flag="drop_out")


def arm_description(subjects: DataFrame, group: str, arm: str, lock: float,
                    event: str = "event", drop_out: str | None = "drop_out") -> DataFrame:
    """Per (group, arm): records, events, drop-outs, lock-censored, lock."""
    n_drop = (F.sum(F.col(drop_out).cast("int")) if drop_out else F.lit(0)).cast("bigint")
    return (subjects.groupBy(group, arm)
            .agg(F.count(F.lit(1)).alias("records"),
                 F.sum(F.col(event).cast("bigint")).alias("events"),
                 n_drop.alias("n_drop"))
            .withColumn("n_admin_censor", F.col("records") - F.col("events") - F.col("n_drop"))
            .withColumn("dbl", F.lit(float(lock))))


def event_table_and_plan(subjects: DataFrame, group: str, arm: str, levels: Sequence[str],
                         time: str = "time", event: str = "event",
                         method: str | SumPlan = "auto",
                         drop_out: str | None = None) -> tuple[DataFrame, SumPlan | str]:
    """(group, time, m0, d0, m1, d1, n0, n1) and the running-sum plan for its times.

    m = subjects with this time, d = events at it, n = subjects with time >= t.
    With ``drop_out`` the drop-outs per arm (k0, k1) are counted too, so arm
    descriptions can come from this table instead of a second subject scan.
    The per-(group, time) aggregate is written once to the checkpoint folder
    (it is small: distinct times, not subjects); the plan is decided on it and
    can be passed to every table derived over the same times.
    """
    ref, trt = levels
    x = F.when(F.col(arm) == F.lit(trt), 1).otherwise(0)
    ev = F.col(event).cast("bigint")
    k = F.col(drop_out).cast("bigint") if drop_out else F.lit(0).cast("bigint")
    s = subjects.filter(F.col(arm).isin(ref, trt)).select(group, time, x.alias("__x"), ev.alias("__e"),
                                                          k.alias("__k"))
    sums = [F.sum(1 - F.col("__x")).alias("m0"),
            F.sum((1 - F.col("__x")) * F.col("__e")).alias("d0"),
            F.sum(F.col("__x")).alias("m1"),
            F.sum(F.col("__x") * F.col("__e")).alias("d1")]
    if drop_out:
        sums += [F.sum((1 - F.col("__x")) * F.col("__k")).alias("k0"),
                 F.sum(F.col("__x") * F.col("__k")).alias("k1")]
    agg = s.groupBy(group, time).agg(*sums)
    if method == "auto":
        agg, plan = materialize_planned(agg, time)  # the plan's statistics come with the write
    else:
        agg, plan = materialize(agg), method
    et = running_sums(agg, [group], time, ["m0", "m1"], prefix="__cum_", suffix_prefix="__n_",
                      method=plan)
    et = (et.withColumnsRenamed({"__n_m0": "n0", "__n_m1": "n1"})
          .drop("__cum_m0", "__cum_m1"))
    return et, plan


def arm_description_from_events(et: DataFrame, group: str, levels: Sequence[str], lock: float) -> DataFrame:
    """Arm description (records, events, drop-outs, lock-censored, lock) from an
    event-time table built with ``drop_out``: sums over its rows, no subject scan."""
    parts = []
    for k, level in enumerate(levels):
        parts.append(et.groupBy(group).agg(F.lit(level).alias("arm"),
                                           F.sum(f"m{k}").cast("bigint").alias("records"),
                                           F.sum(f"d{k}").cast("bigint").alias("events"),
                                           F.sum(f"k{k}").cast("bigint").alias("n_drop")))
    out = parts[0].unionByName(parts[1]).filter(F.col("records") > 0)
    return (out.withColumn("n_admin_censor", F.col("records") - F.col("events") - F.col("n_drop"))
            .withColumn("dbl", F.lit(float(lock))))


def event_table(subjects: DataFrame, group: str, arm: str, levels: Sequence[str],
                time: str = "time", event: str = "event", method: str | SumPlan = "auto") -> DataFrame:
    """The event-time table alone (see :func:`event_table_and_plan`)."""
    return event_table_and_plan(subjects, group, arm, levels, time, event, method)[0]


def _arm_rows(et: DataFrame, group: str, time: str, levels: Sequence[str]) -> DataFrame:
    """One row per (group, arm, time) with subjects of that arm: both arms from one pass."""
    arms = F.array(*[F.struct(F.lit(level).alias("arm"), F.col(f"m{k}").alias("m"),
                              F.col(f"d{k}").alias("d"), F.col(f"n{k}").alias("n"))
                     for k, level in enumerate(levels)])
    return (et.select(F.col(group), F.col(time), F.explode(arms).alias("__a"))
            .select(group, "__a.arm", time, "__a.m", "__a.d", "__a.n")
            .filter(F.col("m") > 0))


def km_curve(et: DataFrame, group: str, levels: Sequence[str], time: str = "time",
             method: str | SumPlan = "auto") -> DataFrame:
    """Kaplan-Meier curve per (group, arm) at every distinct time of the arm.

    S(t) = exp(sum ln(1 - d/n)); once d = n the curve is 0. ``std_err`` is the
    Greenwood standard error of log S; limits are the log-type 95% band, NULL
    where S = 0.
    """
    rows = _arm_rows(et, group, time, levels)
    d, n = F.col("d"), F.col("n")
    rows = rows.withColumns({
        "__li": F.when(d < n, F.log(1 - d / n)).otherwise(F.lit(0.0)),
        "__gw": F.when(d < n, d / (n * (n - d))).otherwise(F.lit(0.0)),
        "__z": F.when((d >= n) & (d > 0), F.lit(1)).otherwise(F.lit(0)),
    })
    cum = running_sums(rows, [group, "arm"], time, ["__li", "__gw", "__z"], prefix="c",
                       method=method)
    surv = F.when(F.col("c__z") > 0, F.lit(0.0)).otherwise(F.exp(F.col("c__li")))
    se = F.sqrt(F.col("c__gw"))
    prev = F.when(F.col("c__z") - F.col("__z") > 0, F.lit(0.0)).otherwise(
        F.exp(F.col("c__li") - F.col("__li")))
    return cum.select(
        F.col(group), F.col("arm"), F.col(time),
        F.col("n").alias("n_risk"), F.col("d").alias("n_event"),
        (F.col("m") - F.col("d")).alias("n_censor"),
        surv.alias("surv"), se.alias("std_err"),
        F.when(surv > 0, surv * F.exp(-F.lit(Z_975) * se)).alias("lower"),
        F.when(surv > 0, F.least(F.lit(1.0), surv * F.exp(F.lit(Z_975) * se))).alias("upper"),
        prev.alias("surv_prev"),
    )


def _first_time_at_or_below(curve_col: str, time: str, p: float = 0.5) -> Column:
    """First time the curve reaches p; midpoint of the flat step if it sits at p."""
    c, t = F.col(curve_col), F.col(time)
    t_lo = F.min(F.when(c <= F.lit(p + MEDIAN_TOL), t))
    v_lo = F.min_by(c, F.when(c <= F.lit(p + MEDIAN_TOL), t))
    t_hi = F.min(F.when(c < F.lit(p - MEDIAN_TOL), t))
    flat = F.abs(v_lo - F.lit(p)) < F.lit(MEDIAN_TOL)
    return F.when(flat & t_hi.isNotNull(), (t_lo + t_hi) / 2).otherwise(t_lo)


def km_median(curve: DataFrame, group: str, time: str = "time") -> DataFrame:
    """Median survival and its 95% limits per (group, arm); NULL when not reached.

    The lower band falls to one half first, so it gives the lower limit.
    """
    return (curve.groupBy(group, "arm")
            .agg(_first_time_at_or_below("surv", time).alias("median"),
                 _first_time_at_or_below("lower", time).alias("lcl_95"),
                 _first_time_at_or_below("upper", time).alias("ucl_95")))


def km_rmean(curve: DataFrame, group: str, time: str = "time", method: str | SumPlan = "auto") -> DataFrame:
    """Restricted mean survival and its standard error per (group, arm).

    The bound tau is the largest time in the group over both arms. With dS_i
    the drop of the curve at t_i, the area is tau (1 - sum dS) + sum dS t, and
    the area beyond t_i is A_i = rmean - h_i with
    h_i = t_i - t_i cum dS(t_i) + cum(dS t)(t_i). The variance
    sum A_i^2 w_i, w_i = d_i / (n_i (n_i - d_i)), is expanded as
    rmean^2 sum w - 2 rmean sum w h + sum w h^2, so one aggregate per
    (group, arm) after one running-sum pass gives everything.
    """
    c = (curve.withColumn("__ds", F.col("surv_prev") - F.col("surv"))
         .withColumn("__dst", F.col("__ds") * F.col(time)))
    cum = running_sums(c, [group, "arm"], time, ["__ds", "__dst"], prefix="c", method=method)
    t = F.col(time)
    head = t - t * F.col("c__ds") + F.col("c__dst")
    d, n = F.col("n_event"), F.col("n_risk")
    w = F.when((d > 0) & (d < n), d / (n * (n - d))).otherwise(F.lit(0.0))
    per_arm = (cum.groupBy(group, "arm")
               .agg(F.sum("__ds").alias("__sds"), F.sum("__dst").alias("__sdst"), F.max(time).alias("__tmax"),
                    F.sum(w).alias("__sw"), F.sum(w * head).alias("__swh"), F.sum(w * head * head).alias("__swhh")))
    # at most one row per arm: the per-group maximum is a window over two rows
    tau = F.max("__tmax").over(Window.partitionBy(group))
    rm = per_arm.withColumn("tau", tau).withColumn(
        "rmean", F.col("tau") * (1 - F.col("__sds")) + F.col("__sdst"))
    var = (F.col("rmean") * F.col("rmean") * F.col("__sw") - 2 * F.col("rmean") * F.col("__swh")
           + F.col("__swhh"))
    return rm.select(group, "arm", "rmean", F.sqrt(F.greatest(var, F.lit(0.0))).alias("se_rmean"), "tau")


def logrank(et: DataFrame, group: str) -> DataFrame:
    """Two-arm log-rank test per group: observed/expected per arm, variance, chi-square, p."""
    d0, d1, n0, n1 = (F.col(c) for c in ("d0", "d1", "n0", "n1"))
    d, n = d0 + d1, n0 + n1
    ev = et.filter(d > 0)
    e1 = d * n1 / n
    v = F.when(n > 1, d * (n1 / n) * (1 - n1 / n) * (n - d) / (n - 1)).otherwise(F.lit(0.0))
    out = (ev.groupBy(group)
           .agg(F.sum(d0).alias("observed_ref"), F.sum(d1).alias("observed_trt"),
                F.sum(d - e1).alias("expected_ref"), F.sum(e1).alias("expected_trt"),
                F.sum(v).alias("variance")))
    chisq = F.when(F.col("variance") > 0,
                   F.pow(F.col("observed_trt") - F.col("expected_trt"), 2) / F.col("variance"))
    return out.withColumn("chisq", chisq)


def with_pvalue(lr: DataFrame) -> DataFrame:
    """Add the chi-square(1) p-value of ``chisq`` (z computed once, in its own projection)."""
    return (lr.withColumn("__z", F.sqrt(F.greatest(F.col("chisq"), F.lit(0.0)) / 2))
            .withColumn("pval", erfc_col(F.col("__z")))
            .drop("__z"))
