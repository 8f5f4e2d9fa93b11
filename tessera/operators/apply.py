"""User functions over partitions and groups, run as Arrow batches in Python.

``mapInPandas`` sees a partition as a stream of bounded Arrow batches, so a
function must give the same answer however rows are batched. Group-wise
statistics are built as per-batch partial results combined by a Spark
aggregate: no group is ever materialised whole in one task.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType


def partition_map(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema) -> DataFrame:
    """Apply ``fn`` to every Arrow batch of every partition; declared output schema."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield fn(pdf)

    return df.mapInPandas(run, schema)


def partition_code_map(df: DataFrame, col: str, mapping: Mapping[str, str], default: str,
                       out: str = "code") -> DataFrame:
    """Per-row code mapping done in pandas, batch by batch."""
    table = dict(mapping)

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        return pdf.assign(**{out: pdf[col].map(table).fillna(default).astype(object)})

    schema = StructType(df.schema.fields + [StructField(out, StringType(), True)])
    return partition_map(df, fn, schema)


def group_means_by_batches(df: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Means per group: pandas partial (sum, count) per batch, Spark combines.

    NULL keys form their own group and NULL values are skipped, as in SQL avg.
    """
    cols = list(cols)
    part_fields = [StructField(key, df.schema[key].dataType, True)]
    for c in cols:
        part_fields += [StructField(f"s_{c}", DoubleType(), True), StructField(f"n_{c}", LongType(), True)]
    part_schema = StructType(part_fields)
    integral_key = df.schema[key].dataType.typeName() in ("integer", "long", "short", "byte")

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            g = pdf.groupby(key, dropna=False, sort=False)
            sums = g[cols].sum(min_count=1)
            cnts = g[cols].count()
            res = pd.DataFrame(index=sums.index)
            for c in cols:
                res[f"s_{c}"] = sums[c].astype("float64")
                res[f"n_{c}"] = cnts[c].astype("int64")
            res = res.reset_index()
            if integral_key:  # NULL keys make pandas floats; keep them as nullable ints
                res[key] = res[key].astype("Int64")
            yield res

    parts = df.select(key, *cols).mapInPandas(partial, part_schema)
    return parts.groupBy(key).agg(*[(F.sum(f"s_{c}") / F.sum(f"n_{c}")).alias(c) for c in cols])


def group_apply(df: DataFrame, keys: Sequence[str], fn: Callable[[tuple, pd.DataFrame], pd.DataFrame],
                schema) -> DataFrame:
    """Function over (key, rows) of each group with a declared schema.

    Each group is materialised in one Python worker: use it only for groups
    bounded by construction. For statistics, prefer :func:`group_means_by_batches`
    style partial + combine.
    """
    return df.groupBy(*keys).applyInPandas(fn, schema)


def partition_fold(df: DataFrame, start: Callable[[], Any], step: Callable[[Any, pa.RecordBatch], Any],
                   finish: Callable[[Any], pa.Table], schema: str) -> DataFrame:
    """A function of a whole partition, read as a stream: its state is carried over the batches.

    ``finish`` turns the state at the partition's end into rows (an empty partition's, too).
    How rows are dealt to partitions is Spark's affair: merge the partitions' rows
    into an answer that does not depend on it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = start()
        for batch in batches:
            state = step(state, batch)
        yield from finish(state).to_batches()

    return df.mapInArrow(run, schema)


def group_fold(df: DataFrame, keys: Sequence[str], start: Callable[[], Any], update: Callable[[Any, pd.DataFrame], Any],
               merge: Callable[[Any, Any], Any], finish: Callable[[Any], Sequence], schema: str,
               max_states: int = 10_000) -> DataFrame:
    """A user's aggregate per group: keys, then the columns of ``schema`` that ``finish`` gives.

    Rows are dealt and ordered by their keys, so that a batch holds few groups and the number
    of updates grows with the groups and the batches, not with their product. Adaptive
    execution splits a hot group over tasks. Tasks keep one state per group of theirs
    (beyond ``max_states`` they hand them on and start anew) and update it batch by
    batch; states are merged one after another in key order. Neither a hot group nor many
    groups need memory beyond the states, so a group may be of any size. NULL keys form a group.
    """
    keys = list(keys)
    key_schema = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)
    fields = StructType.fromDDL(schema).fields
    values, result_kinds = [f.name for f in fields], [to_arrow_type(f.dataType) for f in fields]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states: dict[tuple, Any] = {}
        kinds: list[pa.DataType] = []

        def rows() -> pa.RecordBatch:
            cols = [pa.array(list(c), t) for c, t in zip(zip(*states), kinds)]
            return pa.RecordBatch.from_arrays([*cols, pa.array([pickle.dumps(x) for x in states.values()], pa.binary())],
                                              names=[*keys, "state"])

        for batch in batches:
            kinds = [batch.schema.field(k).type for k in keys]
            if not batch.num_rows:
                continue
            pdf = batch.to_pandas()
            number = pdf.groupby(keys, dropna=False, sort=False).ngroup().to_numpy()
            order = np.argsort(number, kind="stable")
            for at in np.split(order, np.flatnonzero(np.diff(number[order])) + 1):
                key = tuple(batch.column(k)[int(at[0])].as_py() for k in keys)
                states[key] = update(states[key] if key in states else start(), pdf.iloc[at])
            if len(states) > max_states:
                yield rows()
                states = {}
        if states:
            yield rows()

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None

        def out(done: Iterable[tuple], kinds: list[pa.DataType]) -> pa.RecordBatch:
            cols = list(zip(*[(*k, *finish(s)) for k, s in done]))
            arrays = [pa.array(list(c), t) for c, t in zip(cols, [*kinds, *result_kinds])]
            return pa.RecordBatch.from_arrays(arrays, names=[*keys, *values])

        kinds: list[pa.DataType] = []
        for batch in batches:
            kinds = [batch.schema.field(k).type for k in keys]
            done = []
            for *key, data in zip(*(batch.column(c).to_pylist() for c in [*keys, "state"])):
                state = pickle.loads(data)
                if held is not None and held[0] == tuple(key):
                    held = (held[0], merge(held[1], state))
                else:
                    if held is not None:
                        done.append(held)
                    held = (tuple(key), state)
            if done:
                yield out(done, kinds)
        if held is not None:
            yield out([held], kinds)

    dealt = df.hint("rebalance", *[F.col(f"`{k}`") for k in keys]).sortWithinPartitions(*keys)
    states = dealt.mapInArrow(partial, f"{key_schema}, state binary")
    return states.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(total, f"{key_schema}, {schema}")


def bounded_collect(df: DataFrame, max_rows: int):
    """Bring rows to the driver only if there are at most ``max_rows`` of them."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"refusing to collect more than {max_rows} rows to the driver")
    return rows
