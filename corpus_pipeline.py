"""A filtering and packing pipeline over ``documents``.

Each stage takes the documents its predecessor kept, written as Parquet and
read again, and all but the last return rows with the columns of documents:

1. toxicity: documents that score at least 0.7 go;
2. line_dedup: lines of recurring templates go, the documents stay (whole copies are left to the next stage);
3. simhash_near_dedup: of each group of near-duplicates the smallest doc_id stays;
4. benchmark_decontamination: documents that hold a benchmark window go;
5. best_fit_packing: one row per token piece with its sequence and offset.

Defined cases are those of the operators; an empty table passes every stage and
gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm.decontam import drop_leaks
from tessera.llm.linetree import drop_template_lines
from tessera.llm.packing import pack_documents
from tessera.llm.shared import materialize, table
from tessera.llm.simhash import keep_one
from tessera.llm.tokens import default_tokenizer
from tessera.llm.toxicity import drop_toxic, train


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_toxic(docs, train(docs, table(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_template_lines(docs, copies_once=True)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(docs, shingle=4, distance=4)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, default_tokenizer())


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]

# scores of a trained model and tokenizer ids cannot be written in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
