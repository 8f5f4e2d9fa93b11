"""Survival queries on the two trial fixtures (see plans.fixtures).

The oracle SQL is assembled from CTE builders that mirror the operators:
trial -> event-time table -> KM band -> restricted mean / median, log-rank,
arm description, Cox. Doubles are rounded to 6 decimals on both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.stats import chisq1_pvalue_sql
from tessera.operators import survival as sv
from tessera.operators.cox import cox_fit
from tessera.plans.fixtures import (LINE_LEVELS, LINE_LOCK, LINEITEM_TRIAL_SQL, LONG_LOCK, ORDER_LEVELS,
                                    ORDER_LOCK, ORDERS_TRIAL_SQL, lineitem_trial, lineitem_trial_sql, orders_trial)
from tessera.plans.registry import query
from tessera.session import materialize

R = 6
Z = "1.959963984540054"  # fixed value: 97.5% normal quantile, as in functions.stats
TOL = "1e-8"  # fixed value: as survival.MEDIAN_TOL


# ---------------------------------------------------------------- SQL builders (lists of CTEs)

def _et_ctes(trial: str, levels) -> list[str]:
    ref, trt = levels
    return [f"s AS ({trial})", f"""agg AS (SELECT grp, time,
          CAST(sum(CASE WHEN arm = '{ref}' THEN 1 ELSE 0 END) AS BIGINT) AS m0,
          CAST(sum(CASE WHEN arm = '{ref}' THEN event ELSE 0 END) AS BIGINT) AS d0,
          CAST(sum(CASE WHEN arm = '{trt}' THEN 1 ELSE 0 END) AS BIGINT) AS m1,
          CAST(sum(CASE WHEN arm = '{trt}' THEN event ELSE 0 END) AS BIGINT) AS d1
        FROM s WHERE arm IN ('{ref}', '{trt}') GROUP BY grp, time)""",
            """et AS (SELECT *, CAST(sum(m0) OVER r AS BIGINT) AS n0, CAST(sum(m1) OVER r AS BIGINT) AS n1 FROM agg
       WINDOW r AS (PARTITION BY grp ORDER BY time DESC ROWS UNBOUNDED PRECEDING))"""]


def _km_ctes(levels) -> list[str]:
    ref, trt = levels
    return [f"""arms AS (SELECT grp, '{ref}' AS arm, time, m0 AS m, d0 AS d, n0 AS n FROM et WHERE m0 > 0
         UNION ALL SELECT grp, '{trt}' AS arm, time, m1, d1, n1 FROM et WHERE m1 > 0)""",
            """k AS (SELECT *, CASE WHEN d < n THEN ln(1 - d / n) ELSE 0.0 END AS li,
             CASE WHEN d < n THEN d / (n * (n - d)) ELSE 0.0 END AS gw,
             CASE WHEN d >= n AND d > 0 THEN 1 ELSE 0 END AS z FROM arms)""",
            """c AS (SELECT *, sum(li) OVER w AS cli, sum(gw) OVER w AS cgw, sum(z) OVER w AS cz FROM k
      WINDOW w AS (PARTITION BY grp, arm ORDER BY time ROWS UNBOUNDED PRECEDING))""",
            """curve AS (SELECT grp, arm, time, n, d, m, li, z, cli, cz,
                 CASE WHEN cz > 0 THEN 0.0 ELSE exp(cli) END AS surv, sqrt(cgw) AS se,
                 CASE WHEN cz - z > 0 THEN 0.0 ELSE exp(cli - li) END AS surv_prev FROM c)""",
            f"""band AS (SELECT *, CASE WHEN surv > 0 THEN surv * exp(-{Z} * se) END AS lower,
                CASE WHEN surv > 0 THEN least(1.0, surv * exp({Z} * se)) END AS upper FROM curve)"""]


def _first_at_half(col: str) -> str:
    lo = f"min(CASE WHEN {col} <= 0.5 + {TOL} THEN time END)"
    v = f"arg_min({col}, CASE WHEN {col} <= 0.5 + {TOL} THEN time END)"
    hi = f"min(CASE WHEN {col} < 0.5 - {TOL} THEN time END)"
    return f"CASE WHEN abs({v} - 0.5) < {TOL} AND {hi} IS NOT NULL THEN ({lo} + {hi}) / 2 ELSE {lo} END"


def _median_ctes() -> list[str]:
    return [f"""med AS (SELECT grp, arm, {_first_at_half('surv')} AS median, {_first_at_half('lower')} AS lcl_95,
       {_first_at_half('upper')} AS ucl_95 FROM band GROUP BY grp, arm)"""]


def _rmean_ctes() -> list[str]:
    return ["tt AS (SELECT grp, max(time) AS tau FROM band GROUP BY grp)",
            "rb2 AS (SELECT band.*, tau, surv_prev - surv AS ds FROM band JOIN tt USING (grp))",
            """cs AS (SELECT *, sum(ds) OVER w AS cds, sum(ds * time) OVER w AS cdst FROM rb2
       WINDOW w AS (PARTITION BY grp, arm ORDER BY time ROWS UNBOUNDED PRECEDING))""",
            "rm AS (SELECT grp, arm, max(tau) - sum(ds * (tau - time)) AS rmean FROM cs GROUP BY grp, arm)",
            """rmt AS (SELECT grp, arm, max(rmean) AS rmean,
       sqrt(sum(CASE WHEN d > 0 AND d < n
                THEN (rmean - (time - time * cds + cdst)) * (rmean - (time - time * cds + cdst)) * d / (n * (n - d))
                ELSE 0.0 END)) AS se_rmean, max(tau) AS tau
       FROM cs JOIN rm USING (grp, arm) GROUP BY grp, arm)"""]


def _logrank_ctes() -> list[str]:
    return ["lev AS (SELECT grp, d0, d1, n0, n1, d0 + d1 AS d, n0 + n1 AS n FROM et WHERE d0 + d1 > 0)",
            """lg AS (SELECT grp, CAST(sum(d0) AS BIGINT) AS observed_ref, CAST(sum(d1) AS BIGINT) AS observed_trt,
             sum(d - d * n1 / n) AS e0, sum(d * n1 / n) AS e1,
             sum(CASE WHEN n > 1 THEN d * (n1 / n) * (1 - n1 / n) * (n - d) / (n - 1) ELSE 0.0 END) AS v
      FROM lev GROUP BY grp)""",
            f"""lr AS (SELECT *, CASE WHEN v > 0 THEN (observed_trt - e1) * (observed_trt - e1) / v END AS chisq FROM lg)""",
            f"lrp AS (SELECT *, {chisq1_pvalue_sql('chisq')} AS pval FROM lr)"]


def _desc_ctes(lock: float) -> list[str]:
    return [f"""dsc AS (SELECT grp, arm, count(*) AS records, CAST(sum(event) AS BIGINT) AS events,
       CAST(sum(CAST(drop_out AS INTEGER)) AS BIGINT) AS n_drop,
       CAST(count(*) - sum(event) - sum(CAST(drop_out AS INTEGER)) AS BIGINT) AS n_admin_censor,
       CAST({lock} AS DOUBLE) AS dbl
       FROM s GROUP BY grp, arm)"""]


def _cox_ctes(iterations: int = 12) -> list[str]:
    """Newton unrolled ``iterations`` times, Efron ties expanded to one row per tie step,
    sandwich variance from window sums (the SQL twin of operators.cox)."""
    out = ["cev AS (SELECT grp, time, d0, d1, n0, n1, d0 + d1 AS d FROM et WHERE d0 + d1 > 0)",
           "st AS (SELECT grp, time, d0, d1, n0, n1, d, CAST(unnest(range(d)) AS DOUBLE) / d AS f FROM cev)",
           "obs AS (SELECT grp, sum(d1) AS o1 FROM cev GROUP BY grp)",
           "b0 AS (SELECT DISTINCT grp, CAST(0.0 AS DOUBLE) AS beta FROM cev)"]
    for k in range(1, iterations + 1):
        out += [f"""x{k} AS (SELECT grp, (n1 - f * d1) * th / ((n0 + n1 * th) - f * (d0 + d1 * th)) AS xb
        FROM (SELECT st.*, exp(b.beta) AS th FROM st JOIN b{k - 1} b USING (grp)))""",
                f"u{k} AS (SELECT grp, sum(xb) AS sx, sum(xb * (1 - xb)) AS si FROM x{k} GROUP BY grp)",
                f"""b{k} AS (SELECT grp, CASE WHEN si > 0 THEN (o1 - sx) / si END AS step,
        b.beta + CASE WHEN si > 0 THEN (o1 - sx) / si ELSE 0.0 END AS beta
        FROM b{k - 1} b JOIN u{k} USING (grp) JOIN obs USING (grp))"""]
    last = f"b{iterations}"
    out += [f"""fa AS (SELECT grp, time, f, (n0 + n1 * th) - f * (d0 + d1 * th) AS a, (n1 - f * d1) * th AS s1
       FROM (SELECT st.*, exp(b.beta) AS th FROM st JOIN {last} b USING (grp)))""",
            "fb AS (SELECT grp, time, f, a, s1 / a AS xb FROM fa)",
            """pt AS (SELECT grp, time, sum(xb * (1 - xb)) AS info, sum(1 / a) AS h, sum(xb / a) AS hx,
              sum((1 - f) / a) AS hd, sum((1 - f) * xb / a) AS hxd, sum(xb) AS xs FROM fb GROUP BY grp, time)""",
            """fl AS (SELECT et.grp, et.time, m0, d0, m1, d1, coalesce(info, 0.0) AS info, coalesce(h, 0.0) AS h,
              coalesce(hx, 0.0) AS hx, coalesce(hd, 0.0) AS hd, coalesce(hxd, 0.0) AS hxd, coalesce(xs, 0.0) AS xs
       FROM et LEFT JOIN pt USING (grp, time))""",
            """cu AS (SELECT *, sum(h) OVER w - h AS h_ex, sum(hx) OVER w - hx AS hx_ex FROM fl
       WINDOW w AS (PARTITION BY grp ORDER BY time ROWS UNBOUNDED PRECEDING))""",
            f"""rs AS (SELECT cu.*, b.beta, exp(b.beta) AS th,
              CASE WHEN d0 + d1 > 0 THEN xs / (d0 + d1) ELSE 0.0 END AS xm FROM cu JOIN {last} b USING (grp))""",
            """fit0 AS (SELECT grp, max(beta) AS coef, sum(info) AS info,
          sum(d0 * power((hx_ex + hxd) - xm, 2)
              + (m0 - d0) * power(hx_ex + hx, 2)
              + d1 * power(-th * ((h_ex + hd) - (hx_ex + hxd)) + (1 - xm), 2)
              + (m1 - d1) * power(-th * ((h_ex + h) - (hx_ex + hx)), 2)) AS uu,
          max(beta) AS beta FROM rs GROUP BY grp)""",
            """cn AS (SELECT grp, CAST(sum(m0 + m1) AS BIGINT) AS n, CAST(sum(d0 + d1) AS BIGINT) AS n_events
        FROM et GROUP BY grp)""",
            f"""fit AS (SELECT cn.grp, n, n_events, step IS NOT NULL AND abs(step) < 1e-6 AS converged,
          CASE WHEN abs(step) < 1e-6 THEN coef END AS coef, CASE WHEN abs(step) < 1e-6 THEN info END AS info,
          CASE WHEN abs(step) < 1e-6 THEN uu END AS uu
        FROM cn LEFT JOIN fit0 USING (grp) LEFT JOIN {last} USING (grp))""",
            f"""cox AS (SELECT grp, coef, exp(coef) AS exp_coef, exp(-coef) AS exp_neg_coef, sqrt(1 / info) AS se,
       sqrt(uu) / info AS robust_se, exp(coef - {Z} * sqrt(uu) / info) AS lower_95,
       exp(coef + {Z} * sqrt(uu) / info) AS upper_95, n, n_events, converged FROM fit)"""]
    return out


def _with(*groups: list[str]) -> str:
    return "WITH " + ",\n".join(c for g in groups for c in g) + "\n"


def _round(df: DataFrame, cols, digits: int = R) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in cols})


# ---------------------------------------------------------------- subjects

@query("admin_censor", f"""
SELECT l_orderkey, l_linenumber, l_partkey, grp, arm, time, event FROM ({LINEITEM_TRIAL_SQL})
""")
def admin_censor_q(spark, sf):
    return lineitem_trial(spark, sf).select("l_orderkey", "l_linenumber", "l_partkey", "grp", "arm",
                                            "time", "event")


@query("dropout_override", f"""
SELECT o_orderkey, grp, arm, time, event, drop_out FROM ({ORDERS_TRIAL_SQL})
""")
def dropout_override(spark, sf):
    return orders_trial(spark, sf).select("o_orderkey", "grp", "arm", "time", "event", "drop_out")


@query("arm_description", _with([f"s AS ({ORDERS_TRIAL_SQL})"], _desc_ctes(ORDER_LOCK)) + "SELECT * FROM dsc")
def arm_description_q(spark, sf):
    return sv.arm_description(orders_trial(spark, sf), "grp", "arm", ORDER_LOCK)


# ---------------------------------------------------------------- curves and tests

def _lineitem_et(spark, sf):
    return sv.event_table_and_plan(lineitem_trial(spark, sf), "grp", "arm", LINE_LEVELS)


def _orders_et(spark, sf):
    return sv.event_table_and_plan(orders_trial(spark, sf), "grp", "arm", ORDER_LEVELS)


@query("km_curve", _with(_et_ctes(LINEITEM_TRIAL_SQL, LINE_LEVELS), _km_ctes(LINE_LEVELS)) + f"""
SELECT grp, arm, time, n AS n_risk, d AS n_event, m - d AS n_censor, round(surv, {R}) AS surv,
       round(se, {R}) AS std_err, round(lower, {R}) AS lower, round(upper, {R}) AS upper FROM band
""")
def km_curve_q(spark, sf):
    et, plan = _lineitem_et(spark, sf)
    cur = sv.km_curve(et, "grp", LINE_LEVELS, method=plan)
    return _round(cur.drop("surv_prev"), ["surv", "std_err", "lower", "upper"])


@query("km_median", _with(_et_ctes(ORDERS_TRIAL_SQL, ORDER_LEVELS), _km_ctes(ORDER_LEVELS), _median_ctes())
       + "SELECT * FROM med")
def km_median_q(spark, sf):
    et, plan = _orders_et(spark, sf)
    return sv.km_median(sv.km_curve(et, "grp", ORDER_LEVELS, method=plan), "grp")


@query("km_rmean", _with(_et_ctes(ORDERS_TRIAL_SQL, ORDER_LEVELS), _km_ctes(ORDER_LEVELS), _rmean_ctes())
       + f"SELECT grp, arm, round(rmean, {R}) AS rmean, round(se_rmean, {R}) AS se_rmean, tau FROM rmt")
def km_rmean_q(spark, sf):
    et, plan = _orders_et(spark, sf)
    cur = materialize(sv.km_curve(et, "grp", ORDER_LEVELS, method=plan))
    return _round(sv.km_rmean(cur, "grp", method=plan), ["rmean", "se_rmean"])


@query("logrank_test", _with(_et_ctes(LINEITEM_TRIAL_SQL, LINE_LEVELS), _logrank_ctes()) + f"""
SELECT grp, observed_ref, observed_trt, round(e0, {R}) AS expected_ref, round(e1, {R}) AS expected_trt,
       round(v, {R}) AS variance, round(chisq, {R}) AS chisq, round(pval, {R}) AS pval FROM lrp
""")
def logrank_test(spark, sf):
    lr = sv.with_pvalue(sv.logrank(_lineitem_et(spark, sf)[0], "grp"))
    return _round(lr, ["expected_ref", "expected_trt", "variance", "chisq", "pval"])


COX_COLS = ["coef", "exp_coef", "exp_neg_coef", "se", "robust_se", "lower_95", "upper_95"]


@query("cox_hazard_ratio", _with(_et_ctes(LINEITEM_TRIAL_SQL, LINE_LEVELS), _cox_ctes()) + "SELECT grp, "
       + ", ".join(f"round({c}, {R}) AS {c}" for c in COX_COLS) + ", n, n_events, converged FROM cox")
def cox_hazard_ratio(spark, sf):
    """Per supplier: Cox coefficient (R vs A), hazard ratio, robust 95% limits."""
    et, plan = _lineitem_et(spark, sf)
    fit = cox_fit(materialize(et), "grp", method=plan).drop("iterations")
    return _round(fit, COX_COLS)


# ---------------------------------------------------------------- the per-analysis record

DESC_FIELDS = ["records", "events", "rmean", "se_rmean", "median", "lcl_95", "ucl_95", "n_drop",
               "n_admin_censor", "dbl"]
DESC_DOUBLES = {"rmean", "se_rmean", "median", "lcl_95", "ucl_95"}


def survival_bundle(subjects: DataFrame, levels, lock: float) -> DataFrame:
    """One flat row per analysis: log-rank p and chi-square, each arm's description
    (records, events, restricted mean and se, median and limits, drop-outs,
    lock-censored, lock) prefixed ``ref_`` / ``trt_``, and the Cox fit ``cox_*``."""
    et, plan = sv.event_table_and_plan(subjects, "grp", "arm", levels, drop_out="drop_out")
    et = materialize(et)  # read by the log-rank, KM, description and Cox steps: one subject scan
    groups = et.select("grp").distinct()
    lr = sv.with_pvalue(sv.logrank(et, "grp")).select(
        "grp", F.col("pval").alias("logrank_pval"), F.col("chisq").alias("logrank_chisq"))
    cur = materialize(sv.km_curve(et, "grp", levels, method=plan))
    desc = (sv.arm_description_from_events(et, "grp", levels, lock)
            .join(sv.km_rmean(cur, "grp", method=plan).drop("tau"), on=["grp", "arm"], how="left")
            .join(sv.km_median(cur, "grp"), on=["grp", "arm"], how="left"))
    out = groups.join(lr, "grp", "left")
    for prefix, level in zip(("ref", "trt"), levels):
        side = desc.filter(F.col("arm") == level).select(
            "grp", *[F.col(f).alias(f"{prefix}_{f}") for f in DESC_FIELDS])
        out = out.join(side, "grp", "left")
    cox = cox_fit(et, "grp", method=plan).select("grp", *[F.col(c).alias(f"cox_{c}") for c in [*COX_COLS, "converged"]])
    out = out.join(cox, "grp", "left")
    doubles = (["logrank_pval", "logrank_chisq"] + [f"{p}_{f}" for p in ("ref", "trt") for f in DESC_DOUBLES]
               + [f"cox_{c}" for c in COX_COLS])
    return _round(out, doubles)


def _bundle_sql(trial: str, levels, lock: float) -> str:
    ref, trt = levels
    ctes = (_et_ctes(trial, levels), _km_ctes(levels), _rmean_ctes(), _median_ctes(), _logrank_ctes(),
            _desc_ctes(lock), _cox_ctes())
    desc = """d_{p} AS (SELECT dsc.*, rmean, se_rmean, median, lcl_95, ucl_95 FROM dsc
       LEFT JOIN rmt USING (grp, arm) LEFT JOIN med USING (grp, arm) WHERE dsc.arm = '{lv}')"""
    extra = [desc.format(p="ref", lv=ref), desc.format(p="trt", lv=trt), "gr AS (SELECT DISTINCT grp FROM et)"]

    def side(p):
        return ", ".join(f"round({p}.{f}, {R}) AS {p}_{f}" if f in DESC_DOUBLES else f"{p}.{f} AS {p}_{f}"
                         for f in DESC_FIELDS)

    cols = ", ".join(f"round(cox.{c}, {R}) AS cox_{c}" for c in COX_COLS) + ", cox.converged AS cox_converged"
    return (_with(*ctes, extra)
            + f"""SELECT gr.grp, round(lrp.pval, {R}) AS logrank_pval, round(lrp.chisq, {R}) AS logrank_chisq,
       {side('ref')}, {side('trt')}, {cols}
FROM gr LEFT JOIN lrp USING (grp) LEFT JOIN d_ref ref USING (grp) LEFT JOIN d_trt trt USING (grp)
     LEFT JOIN cox USING (grp)""")


@query("survival_bundle", _bundle_sql(ORDERS_TRIAL_SQL, ORDER_LEVELS, ORDER_LOCK))
def survival_bundle_q(spark, sf):
    """The per-analysis record on the orders trial (drop-outs included), per nation."""
    return survival_bundle(orders_trial(spark, sf), ORDER_LEVELS, ORDER_LOCK)


@query("parallel_group_analysis", _bundle_sql(lineitem_trial_sql(LONG_LOCK), LINE_LEVELS, LONG_LOCK))
def parallel_group_analysis(spark, sf):
    """The same record for every supplier of the lineitem trial with the late lock, all analyses in one job."""
    return survival_bundle(lineitem_trial(spark, sf, LONG_LOCK), LINE_LEVELS, LONG_LOCK)
