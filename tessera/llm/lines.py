"""Line deduplication by exact template paths, the rule before :mod:`tessera.llm.linetree`.

A line's template is a path of fixed depth: its number of tokens, then its
leading tokens. Tokens that hold a digit are variable fields (``<*>``). If the
fixed part of the path (``LEAD`` first and ``TAIL`` last tokens) makes up at
least ``SHARE`` of the line, whatever lies between is a variable field, too;
otherwise the rest of the masked line belongs to the template. Blank lines
have no template.

A template recurs if documents with at least ``MIN_DOCS`` different texts hold
it (exact copies of a document count once). Lines of recurring templates are
dropped, except in the document with the smallest doc_id that has one, so no
content is lost altogether.

Only (template, text hash, doc_id) travel for counting; counts are combined
before the shuffle, so a line held by every document is one row per task.

Defined cases: null text stays null and has no lines; empty texts have one
blank line; documents without a doc_id count for a template, never keep its
lines and lose them; rows with equal doc_id keep or lose a template together;
a document whose lines all go keeps an empty text; an empty table gives no
rows; extra columns stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.shared import materialize, spare_name

LEAD = 4
TAIL = 2
SHARE = 0.6
MIN_DOCS = 10


def tokens(line: Column) -> Column:
    """Tokens of a line: cut at white space, those with a digit masked."""
    masked = F.regexp_replace(line, r"[^ \t\r\f\x0B]*[0-9][^ \t\r\f\x0B]*", "<*>")
    return F.filter(F.split(masked, r"[ \t\r\f\x0B]+"), lambda t: t != "")


def template(line: Column) -> Column:
    """The template of a line as text; null for a blank line."""
    own = tokens(line)

    def path(t: Column) -> Column:
        n = F.size(t)
        fixed = F.least(n, F.lit(LEAD + TAIL))
        lead, rest = F.slice(t, 1, LEAD), F.slice(t, LEAD + 1, 1 << 30)
        tail = F.when(n > LEAD + TAIL, F.slice(t, -TAIL, TAIL)).otherwise(rest)
        rest = F.when(fixed >= F.ceil(n * F.lit(SHARE)), tail).otherwise(rest)
        return F.when(n > 0, F.concat_ws(" ", n.cast("string"), F.array_join(lead, " "), F.array_join(rest, " ")))

    return F.element_at(F.transform(F.array(own), path), 1)


def _keys(text: Column) -> Column:
    """One key (a hash of the template, null for blank lines) per line of a text."""
    return F.transform(F.transform(F.split(text, "\n"), template), lambda t: F.when(t.isNotNull(), F.xxhash64(t)))


def drop_recurring_lines(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with the lines of recurring templates taken out of ``text`` (see the module text)."""
    gone = spare_name(docs, "gone_keys")
    lines = materialize(docs.select("doc_id", F.xxhash64("text").alias("th"),
                                    F.explode(F.array_distinct(_keys(F.col("text")))).alias("key"))
                        .where("key is not null"))
    held = lines.groupBy("key", "th").agg(F.min("doc_id").alias("least"))
    # written, so that the join below meets two plain tables and a hot key's lines can be split
    recurring = materialize(held.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("least").alias("keeper"))
                            .where(F.col("n") >= min_docs).select("key", "keeper"))
    lost = (lines.join(recurring, "key").where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
            .groupBy("doc_id").agg(F.collect_set("key").alias(gone))
            .withColumnRenamed("doc_id", "lost_id"))
    marked = docs.join(lost, docs["doc_id"].eqNullSafe(lost["lost_id"]), "left").drop("lost_id")
    text = F.array_join(F.transform(F.filter(
        F.arrays_zip(F.split("text", "\n").alias("line"), _keys(F.col("text")).alias("key")),
        lambda x: x["key"].isNull() | ~F.array_contains(gone, F.coalesce(x["key"], F.lit(0)))),
        lambda x: x["line"]), "\n")
    return (marked.withColumn("text", F.when(F.col(gone).isNull(), F.col("text")).otherwise(text))
            .select(*docs.columns))
