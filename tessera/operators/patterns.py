"""Frequent pattern helpers that avoid materialising whole sequences.

``sequential_pairs`` finds the frequent sequential patterns of length 1 and 2
(single-item steps) -- what PrefixSpan reports with maxPatternLength=2 -- from
per (sequence, item) first and last positions. Those are algebraic
aggregates, so a sequence holding a third of all events never lands in one
task; the pair step joins only frequent items (Apriori pruning), at most
|frequent items|^2 rows per sequence.

``sequential_patterns`` finds those of every length, level by level.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import materialize


def sequential_pairs(df: DataFrame, seq: str, order: Sequence[str], item: str, min_support: float) -> DataFrame:
    """Patterns <a> and <a, b> (a before b, a == b allowed) with support >= min_support.

    Support counts sequences; the threshold is ceil(min_support * #sequences),
    as PrefixSpan computes it. Ties in ``order`` must be broken by its later
    columns (e.g. an event id) so positions are a total order.
    """
    pos = F.struct(*[F.col(c) for c in order])
    per = materialize(df.groupBy(seq, item).agg(F.min(pos).alias("first"), F.max(pos).alias("last")))
    n_seq = per.select(seq).distinct().count()
    min_count = math.ceil(min_support * n_seq)
    singles = (per.groupBy(F.col(item).alias("item_1")).agg(F.count(F.lit(1)).alias("freq"))
               .withColumn("item_2", F.lit(None).cast("string")))
    # Apriori: a pair is frequent only if both its items are, so pairs are built
    # from frequent items only (bounded by the frequent vocabulary per sequence)
    frequent = singles.filter(F.col("freq") >= F.lit(min_count)).select(F.col("item_1").alias(item))
    per = per.join(frequent, item, "left_semi")
    a, b = per.alias("a"), per.alias("b")
    pairs = (a.join(b, (F.col(f"a.{seq}") == F.col(f"b.{seq}")) & (F.col("a.first") < F.col("b.last")))
             .groupBy(F.col(f"a.{item}").alias("item_1"), F.col(f"b.{item}").alias("item_2"))
             .agg(F.count(F.lit(1)).alias("freq")))
    out = singles.select("item_1", "item_2", "freq").unionByName(pairs.select("item_1", "item_2", "freq"))
    return out.filter(F.col("freq") >= F.lit(min_count))


SPAN_BLOCKS = 64  # stretches of the order that a long sequence's events are dealt into
LONG_FROM = 10_000  # events up to which a sequence is one stretch


def _order_block(rows: DataFrame, column: str, blocks: int) -> Column:
    """The stretch of the order in which ``column`` lies; the cuts are approximate quantiles of its values."""
    shares = F.array(*[F.lit(i / blocks) for i in range(1, blocks)])
    cuts = rows.agg(F.percentile_approx(column, shares)).first()[0] if blocks > 1 else None
    if not cuts:
        return F.lit(0)
    cuts = F.array(*[F.lit(c) for c in sorted(set(cuts))])
    # missing values come before all others, as in the order itself
    return F.coalesce(F.size(F.filter(cuts, lambda c: c <= F.col(column))), F.lit(0))


def _next_events(ends: DataFrame, events: DataFrame, heads: DataFrame, cut_any: bool = True) -> DataFrame:
    """``ends`` (s, item, pos, ids) with ``next``, the place of the first event of ``item`` after ``pos``; rows without one go.

    Within a block the event comes from one running minimum over (sequence, item,
    block), events and ends sorted together; otherwise it is the first event of a later
    block, read off the pair's list of at most one head a block.
    """
    marks = events.select("s", "item", "pos", F.lit(None).cast("array<int>").alias("ids"))
    block = _block("pos")
    # from the latest on; an event at the very end of a pattern is not after it
    back = (Window.partitionBy("s", "item", block).orderBy(F.desc("pos"), F.desc_nulls_last("ids"))
            .rowsBetween(Window.unboundedPreceding, -1))
    near = (marks.unionByName(ends.select("s", "item", "pos", "ids"))
            .withColumn("near", F.min(F.when(F.col("ids").isNull(), F.col("pos"))).over(back)).where("ids is not null"))
    later = F.get(F.filter("heads", lambda h: _block(h) > block), 0)
    here = near.where("near is not null").select("s", "item", F.col("near").alias("next"), "ids")
    if not cut_any:  # one block a sequence: what has no event here has none
        return here
    rest = near.where("near is null").join(heads.where(_block(F.element_at("heads", -1)) > 0), ["s", "item"])
    return here.unionByName(rest.select("s", "item", later.alias("next"), "ids").where("next is not null"))


def _block(place: Column | str) -> Column:
    return F.shiftright(place, 32)


def sequential_patterns(df: DataFrame, seq: str, order: Sequence[str], item: str, min_support: float,
                        blocks: int = SPAN_BLOCKS, long_from: int = LONG_FROM) -> DataFrame:
    """Patterns of any length as (pattern, freq), support as in :func:`sequential_pairs`.

    Projected-sequence growth: a sequence holds a pattern by the earliest place at which
    the pattern ends. What follows depends on that place alone, so a level has one row
    per (sequence, place) with the numbers of all patterns that end there. The next level asks, for
    every item that can make the pattern frequent (the longer pattern's own tail is
    frequent already), for that item's first event after the place: one row per next
    item, however many patterns end there and events follow. It goes on until no pattern is
    frequent; every level is a written table of its own, and what travels is a number per
    (pattern, sequence). Patterns are numbered within their level; only tables of patterns are sent to every task. A null item is no item. Positions must be a
    total order within a sequence. Events without a sequence count for patterns of one item only.

    A place is one number: the block of the order, then the event's rank in the
    sequence's part of the block. Sequences of over ``long_from`` events are cut into blocks, so none is numbered whole.
    """
    pos = F.struct(*[F.col(c) for c in order])
    rows = df.select(F.col(seq).alias("s"), pos.alias("at"), F.col(item).cast("string").alias("item"),
                     F.col(order[0]).alias("first"))
    min_count = math.ceil(min_support * rows.select("s").distinct().count())
    rows = rows.where("item is not null")
    long = materialize(rows.groupBy("s").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > long_from)
                       .select(F.col("s").alias("long_s")))
    cut_any = not long.isEmpty()
    if not cut_any:
        rows = rows.withColumn("block", F.lit(0))
    else:
        # 1 and on: 0 is the block of those that are not cut
        cut = _order_block(rows, "first", blocks) + 1
        hit = long.withColumn("cut", F.lit(True))
        rows = rows.join(hit, F.col("s").eqNullSafe(F.col("long_s")), "left").withColumn(
            "block", F.when(F.col("cut"), cut).otherwise(0))
    rank = F.dense_rank().over(Window.partitionBy("s", "block").orderBy("at"))
    rows = materialize(rows.select("s", "item", (F.shiftleft(F.col("block").cast("long"), 32) + rank).alias("pos")))

    def frequent(level: DataFrame, names: DataFrame) -> DataFrame:
        """(id, pattern, freq) of the frequent patterns, by one count an id and task."""
        held = (level.select(F.explode("ids").alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("freq"))
                .where(F.col("freq") >= max(1, min_count)))
        return materialize(names.select("id", "pattern").join(held, "id"))

    first = rows.groupBy("s", "item", _block("pos").alias("block")).agg(F.min("pos").alias("pos"))
    heads = materialize(first.groupBy("s", "item").agg(F.array_sort(F.collect_list("pos")).alias("heads")))
    names = _numbered(heads.select("item").distinct().select("item", F.array("item").alias("pattern")), "id")
    level = heads.join(names, "item").select("s", F.col("heads")[0].alias("pos"), F.array("id").alias("ids"))
    found = frequent(level, names)
    out = found.select("pattern", "freq")
    items = found.select(F.col("pattern")[0].alias("item"))
    events, heads = rows.join(items, "item", "left_semi"), heads.join(items, "item", "left_semi")
    length = 1
    while not found.isEmpty():
        tail, begin = F.slice("pattern", 2, length - 1), F.slice("pattern", 1, length - 1)
        found = _numbered(found, "old")
        steps = (found.select("old", "pattern", tail.alias("overlap"))
                 .join(found.select(begin.alias("overlap"), F.element_at("pattern", -1).alias("item")), "overlap"))
        steps = _numbered(steps.select("item", "old", F.concat("pattern", F.array("item")).alias("pattern")), "id")
        # a level's numbers to those of its frequent patterns, then, an item a row, to the longer patterns' numbers
        kept = F.broadcast(_by_number(names.select("id").join(found.select("id", "old"), "id", "left"), [], "id", "old", "kept"))
        goes = F.broadcast(_by_number(
            found.select("old").crossJoin(steps.select("item").distinct()).join(steps.drop("pattern"), ["old", "item"], "left"),
            ["item"], "old", "id", "goes"))
        ends = level.where("s is not null").crossJoin(kept).select("s", "pos", _through("ids", "kept").alias("ids")).where("size(ids) > 0")
        ends = ends.crossJoin(goes).select("s", "item", "pos", _through("ids", "goes").alias("ids")).where("size(ids) > 0")
        grown = _next_events(ends, events, heads, cut_any).select("s", F.col("next").alias("pos"), "ids")
        level = materialize(grown.groupBy("s", "pos").agg(F.flatten(F.collect_list("ids")).alias("ids")))
        names = steps
        found = frequent(level, names)
        out = out.unionByName(found.select("pattern", "freq"))
        length += 1
    return out


def _numbered(patterns: DataFrame, name: str) -> DataFrame:
    """``patterns`` (distinct by ``pattern``), a table of patterns and not of sequences, numbered from 0 as ``name``."""
    return materialize(patterns.withColumn(name, F.row_number().over(Window.orderBy("pattern")) - 1))


def _by_number(rows: DataFrame, keys: list[str], at: str, value: str, name: str) -> DataFrame:
    """Per ``keys`` one array of ``value`` whose place is ``at``, which goes from 0 without a gap."""
    return rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(at, value)))[value].alias(name))


def _through(numbers: str, table: str) -> Column:
    """The entries of the array ``table`` at ``numbers``, without the missing ones."""
    return F.filter(F.transform(numbers, lambda i: F.get(table, i)), lambda x: x.isNotNull())
