"""MLlib fits behind formula pipelines, with tidy tabular outputs.

Models are small and live on the driver; data stays distributed (fits are
MLlib jobs, predictions are lazy transforms). Tidy tables built from model
parameters are bounded by the number of terms / clusters / classes.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.ml import Pipeline
from pyspark.ml.feature import RFormula, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType


FIT_BYTES = 16 << 20  # of a partition that a fit passes over again and again


def dealt_by_key(df: DataFrame, key: str, width: Column, part_bytes: int = FIT_BYTES) -> DataFrame:
    """``df`` dealt and ordered by ``key`` into as many partitions as its bytes (the sum of ``width``) ask for.

    Seeded fits draw per partition. Their number depends on the data alone here, not
    on files, session or cluster, so a seed gives the same fit wherever it runs.
    """
    size = df.agg(F.sum(width)).first()[0] or 0
    return df.repartition(max(1, -(-int(size) // part_bytes)), key).sortWithinPartitions(key)


@contextmanager
def persisted(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` kept in memory, and on disk what does not fit, until the block ends."""
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist(blocking=True)


def fit_persisted(estimator, df: DataFrame):
    """Fit over rows that are read once and kept for the fit's passes; nothing stays stored afterwards."""
    with persisted(df) as rows:
        return estimator.fit(rows)


def counted_rows(df: DataFrame, weight: str) -> DataFrame:
    """The different rows of ``df`` with their number as ``weight``, written once.

    A maximum-likelihood fit with these weights is the fit of all rows, in passes over the different ones only.
    """
    from tessera.session import materialize

    return materialize(df.groupBy(*df.columns).agg(F.count(F.lit(1)).cast("double").alias(weight)))


def formula_pipeline(formula: str, estimator=None, **rformula_opts) -> Pipeline:
    """R-style formula (``~ . : + -``) to a features/label pipeline (+ estimator)."""
    stages = [RFormula(formula=formula, **rformula_opts)]
    if estimator is not None:
        stages.append(estimator)
    return Pipeline(stages=stages)


def features_as_columns(df: DataFrame, vec_col: str = "features", prefix: str = "f", n: int | None = None) -> DataFrame:
    """Spread a vector column into f0, f1, ... double columns."""
    if n is None:
        n = len(df.select(vec_col).first()[0])
    arr = vector_to_array(F.col(vec_col))
    return df.withColumns({f"{prefix}{i}": arr[i] for i in range(n)}).drop(vec_col)


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="error").transform(df)


def embedding_vectors(df: DataFrame, col: str = "embedding", out: str = "features") -> DataFrame:
    """array<float> embedding as an ML vector."""
    return df.withColumn(out, array_to_vector(F.col(col).cast("array<double>")))


def tidy_terms(spark: SparkSession, names: Sequence[str], values: dict[str, Sequence[float]],
               intercept: dict[str, float] | None = None) -> DataFrame:
    """One row per term: term name and one double column per statistic."""
    cols = list(values)
    rows = []
    if intercept is not None:
        rows.append(("(Intercept)", *[float(intercept[c]) if intercept.get(c) is not None else None
                                      for c in cols]))
    for i, name in enumerate(names):
        rows.append((name, *[float(values[c][i]) for c in cols]))
    schema = StructType([StructField("term", StringType(), False)]
                        + [StructField(c, DoubleType(), True) for c in cols])
    return spark.createDataFrame(rows, schema)


def metrics_table(spark: SparkSession, items: Sequence[tuple[str, str, float]]) -> DataFrame:
    """(model, metric, value) rows for scalar model summaries."""
    schema = StructType([StructField("model", StringType(), False), StructField("metric", StringType(), False),
                         StructField("value", DoubleType(), True)])
    return spark.createDataFrame([(m, k, None if v is None else float(v)) for m, k, v in items], schema)


def confusion(df: DataFrame, label: str, prediction: str = "prediction", name: str = "n") -> DataFrame:
    """Label-by-prediction counts, long form."""
    return df.groupBy(label, prediction).agg(F.count(F.lit(1)).alias(name))


def cluster_sizes(pred: DataFrame, col: str = "prediction") -> DataFrame:
    return pred.groupBy(col).agg(F.count(F.lit(1)).cast(LongType()).alias("size"))


def string_index(df: DataFrame, col: str, out: str) -> DataFrame:
    """Index by frequency (most frequent = 0), ties alphabetical."""
    model = StringIndexer(inputCol=col, outputCol=out, stringOrderType="frequencyDesc").fit(df)
    return model.transform(df)


def dense_index(df: DataFrame, col: str, out: str = "idx") -> DataFrame:
    """(col, out) mapping every distinct value of ``col`` to 0..n-1 in value order.

    For estimators that need int ids (ALS) when keys are sparse or beyond the
    int range. The ranks come from a distributed running count, so neither
    the driver nor one task sees all keys.
    """
    from tessera.operators.cumulative import running_sums

    ids = df.select(col).filter(F.col(col).isNotNull()).distinct().withColumn("__one", F.lit(1))
    ranked = running_sums(ids, [], col, ["__one"], prefix="__c")
    return ranked.select(col, (F.col("__c__one") - 1).cast("int").alias(out))


class IntIds:
    """Int ids for a key column: the key itself when it fits, else a dense index."""

    INT_MAX = 2**31 - 1

    def __init__(self, df: DataFrame, col: str, out: str):
        from tessera.session import materialize

        self.col, self.out = col, out
        lo, hi = df.agg(F.min(col), F.max(col)).first()
        self.direct = lo is None or (0 <= lo and hi <= self.INT_MAX)
        self.mapping = None if self.direct else materialize(dense_index(df, col, out))

    def attach(self, df: DataFrame) -> DataFrame:
        """Add the int id column ``out`` next to ``col``."""
        if self.direct:
            return df.withColumn(self.out, F.col(self.col).cast("int"))
        return df.join(self.mapping, self.col)

    def detach(self, df: DataFrame) -> DataFrame:
        """Add the key column ``col`` back from the int id column ``out``."""
        if self.direct:
            return df.withColumn(self.col, F.col(self.out).cast("bigint"))
        return df.join(self.mapping, self.out)


def int_ids(df: DataFrame, col: str, out: str) -> IntIds:
    return IntIds(df, col, out)


def indexed_labels(df: DataFrame, col: str, out: str = "label") -> tuple[DataFrame, list[str]]:
    model = StringIndexer(inputCol=col, outputCol=out, stringOrderType="frequencyDesc").fit(df)
    return model.transform(df), list(model.labels)
