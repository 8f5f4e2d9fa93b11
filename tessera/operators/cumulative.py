"""Exact running (prefix / suffix) sums that do not put a whole group in one task.

A plain ``Window.partitionBy(keys).orderBy(t)`` sends every row of a key to
one task. When one key holds a third of the table that task is the job. The
``ranged`` method is the classic two-level scan instead:

1. cut t into ``blocks`` ranges at approximate quantiles (one small
   aggregate, brought to the driver once as a literal array, so every later
   evaluation -- including retries -- assigns the same block); the block id
   is monotone in t, which is all the per-key offsets need;
2. per (key, block) totals -> a small table (at most keys + blocks rows),
   whose per-key window gives each block's offset;
3. a window per (key, block) gives local sums, and the offset is added.

Every window partition is bounded by one block, never by one key. Input must
hold one row per (keys, t) (aggregate first) and non-NULL keys.

``method="auto"`` (the default) decides at run time from one small aggregate:
rows are unique per (key, t), so the number of distinct t bounds every key's
row count. When that bound is at most ``window_limit`` a single window is
safe (each window partition holds at most that many rows) and cheaper;
otherwise the two-level form is used, with block bounds from the same job.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_BLK = "__blk"
# a single window partition may hold up to this many rows; above it the two-level
# form spreads a key over blocks (also the faster choice for long keys)
WINDOW_LIMIT = 100_000


def _shuffle_partitions(df: DataFrame) -> int:
    try:
        return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    except Exception:  # pragma: no cover - conf always present in practice
        return 200


def order_stats(df: DataFrame, col: str, n_blocks: int) -> tuple[int, list, int]:
    """(approximate distinct count, sorted quantile bounds cutting into ~n_blocks ranges, rows)."""
    probs = [i / n_blocks for i in range(1, n_blocks)]
    r = df.agg(F.approx_count_distinct(col, 0.05).alias("nd"),
               F.percentile_approx(col, probs, 10000).alias("q"),
               F.count(F.lit(1)).alias("n")).first()
    bounds = sorted(set(v for v in (r["q"] or []) if v is not None))
    return int(r["nd"] or 0), bounds, int(r["n"] or 0)


def block_of(value: Column, bounds: Sequence) -> Column:
    """Number of bounds strictly below ``value``, as a balanced CASE tree (log depth)."""

    def build(lo: int, hi: int) -> Column:
        # value lies above bounds[:lo] and not above bounds[hi:]; answer in [lo, hi]
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(value <= F.lit(bounds[mid]), build(lo, mid)).otherwise(build(mid + 1, hi))

    return build(0, len(bounds))


@dataclass(frozen=True)
class SumPlan:
    """How to compute running sums over one order domain: a decision plus block bounds.

    Tables derived from one another over the same order values (an event-time
    table, its curves, its hazards) can share one plan, so the deciding
    aggregate runs once.
    """

    method: str  # "window" or "ranged"
    bounds: tuple = ()
    n_rows: int = 0  # rows of the table the plan was decided on


def plan_running_sums(df: DataFrame, order: str, *, blocks: int | None = None,
                      window_limit: int = WINDOW_LIMIT, keyed: bool = True) -> SumPlan:
    """Run the one deciding aggregate and return the plan (see module docstring)."""
    n_blocks = max(2, blocks or _shuffle_partitions(df))
    n_distinct, bounds, n_rows = order_stats(df, order, n_blocks)
    method = "window" if (keyed and n_distinct <= window_limit) else "ranged"
    return SumPlan(method, tuple(bounds), n_rows)


def materialize_planned(df: DataFrame, order: str, *, blocks: int | None = None,
                        window_limit: int = WINDOW_LIMIT, keyed: bool = True) -> tuple[DataFrame, SumPlan]:
    """Write ``df`` to the shared folder, then decide its plan from the written table.

    The statistics job reads the small written table, not the input's
    lineage. (Observed metrics during the write would save that job, but an
    observed session cannot serialise MLlib models that hold their training
    summary, so they are not used.)
    """
    from tessera.session import materialize

    out = materialize(df)
    return out, plan_running_sums(out, order, blocks=blocks, window_limit=window_limit, keyed=keyed)


def running_sums(df: DataFrame, keys: Sequence[str], order: str, cols: Sequence[str], *,
                 prefix: str = "cum_", suffix_prefix: str | None = None,
                 method: str | SumPlan = "auto", blocks: int | None = None,
                 window_limit: int = WINDOW_LIMIT) -> DataFrame:
    """Add inclusive prefix sums ``cum_<c>`` (rows with order <= current).

    With ``suffix_prefix`` (e.g. ``"rcum_"``) also add inclusive suffix sums
    (rows with order >= current), computed as total - prefix + own.
    ``method="window"`` is the single-window form for inputs known to be small
    per key (bounded number of distinct order values).
    """
    keys = list(keys)
    cols = list(cols)
    if isinstance(method, str) and method in ("auto", "ranged"):
        plan = plan_running_sums(df, order, blocks=blocks, window_limit=window_limit, keyed=bool(keys))
        method = plan if method == "auto" else SumPlan("ranged", plan.bounds, plan.n_rows)
    bounds = None
    if isinstance(method, SumPlan):
        method, bounds = method.method, list(method.bounds)
    if method == "window":
        w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
        out = df.withColumns({prefix + c: F.sum(c).over(w) for c in cols})
        if suffix_prefix is not None:
            wt = Window.partitionBy(*keys)
            out = out.withColumns({suffix_prefix + c: F.sum(c).over(wt) - F.col(prefix + c) + F.col(c)
                                   for c in cols})
        return out
    if method != "ranged":
        raise ValueError(f"unknown method {method!r}")

    ranged = df.withColumn(_BLK, block_of(F.col(order), bounds))

    totals = ranged.groupBy(*keys, _BLK).agg(*[F.sum(c).alias(c) for c in cols])
    before = Window.partitionBy(*keys).orderBy(_BLK).rowsBetween(Window.unboundedPreceding, -1)
    offs = {f"__off_{c}": F.coalesce(F.sum(c).over(before), F.lit(0)) for c in cols}
    if suffix_prefix is not None:
        whole = Window.partitionBy(*keys)
        offs.update({f"__tot_{c}": F.sum(c).over(whole) for c in cols})
    offsets = totals.select(*keys, _BLK, *[e.alias(n) for n, e in offs.items()])

    local = Window.partitionBy(*keys, _BLK).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    loc = ranged.withColumns({f"__loc_{c}": F.sum(c).over(local) for c in cols})
    joined = loc.join(offsets, on=[*keys, _BLK], how="inner")
    added = {prefix + c: F.col(f"__loc_{c}") + F.col(f"__off_{c}") for c in cols}
    out = joined.withColumns(added)
    if suffix_prefix is not None:
        out = out.withColumns({suffix_prefix + c: F.col(f"__tot_{c}") - F.col(prefix + c) + F.col(c)
                               for c in cols})
    drop = [_BLK] + [c for c in out.columns if c.startswith("__loc_") or c.startswith("__off_")
                     or c.startswith("__tot_")]
    return out.drop(*drop)
