"""Line deduplication with a log-template tree of fixed depth, in DataFrame functions only.

Tokens that hold a digit are variable fields (``<*>``); blank lines have no
template. The tree has three levels: the number of tokens, a block of the
line's tokens (halves from ``HALVES`` tokens on, thirds from ``THIRDS`` on, so
that a field in the leading tokens leaves another block whole; shorter lines:
the whole line), and in each leaf one template: at each position the token that
over half of the leaf's different lines hold, else a variable field. A line
fits its leaf if at least ``SIMILAR`` of its tokens are the template's. A line
that fits leaves of several blocks belongs to the one with the most lines, ties
to the first block; a line that fits none is a template of its own.

A template recurs if two documents hold lines of it, whatever the line's
length. Lines of recurring templates are dropped, except in the document with
the smallest doc_id that has one. With ``copies_once`` documents of one and the
same text count as one and keep or lose together (the text of the least hash
keeps): whole copies are left to a later stage.

What travels: one row of hashes per line, one per different line and block, and
the tokens only of lines that share a leaf with another line. Lines are not written
as text: each key remembers one document that holds it, and the documents asked for
a shared leaf's lines are cut once more. A leaf's lines never meet in one task:
tokens are counted per (leaf, position, token).

Defined cases: null text stays null and has no lines; empty texts have one
blank line; documents without a doc_id count (by their text), never keep a
template's lines and lose them; rows with equal doc_id are one document; a document whose lines
all go keeps an empty text; an empty table gives no rows; extra columns stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.shared import materialize, release, spare_name, table

HALVES, THIRDS = 6, 9  # tokens from which a line has two, three blocks
SIMILAR = 0.6
_SPACE = r" \t\r\f\x0B"


def plain(line: Column) -> Column:
    """A line's tokens with one space between, those with a digit masked; empty for a blank line."""
    masked = F.regexp_replace(line, f"(?<![^{_SPACE}])[^0-9{_SPACE}]*+[0-9][^{_SPACE}]*", "<*>")
    # most lines have neither digits nor odd white space: no pattern is replaced there
    odd = line.rlike(r"[0-9\t\r\f\x0B]|  ")
    return F.btrim(F.when(odd, F.regexp_replace(masked, f"[{_SPACE}]+", " ")).otherwise(line))


def line_key(line: Column) -> Column:
    return F.xxhash64(plain(line))


def _blocks() -> list[Column]:
    """Hashes of the (count, block) paths of a row with ``n`` and ``t``; null where there is no such block."""
    def path(j: int, blocks: int) -> Column:
        start = F.floor(F.col("n") * j / blocks).cast("int")
        size = F.floor(F.col("n") * (j + 1) / blocks).cast("int") - start
        return F.xxhash64("n", F.lit(j), F.slice("t", start + 1, size))

    return [F.when(F.col("n") >= THIRDS, path(j, 3)).when((F.col("n") >= HALVES) & F.lit(j < 2), path(j, 2))
            for j in range(3)]


def _same(docs: DataFrame, doc_id: str, th: str) -> Column:
    """A join condition: rows of ``docs`` with that doc_id (null, too) and text hash."""
    return docs["doc_id"].eqNullSafe(F.col(doc_id)) & (F.xxhash64(docs["text"]) == F.col(th))


def _texts(docs: DataFrame, asked: DataFrame) -> DataFrame:
    """(key, line) of the (key, in_id, in_th) rows asked for, from the documents that hold them."""
    wanted = asked.groupBy("in_id", "in_th").agg(F.collect_set("key").alias("keys"))
    return (docs.select("doc_id", "text").join(wanted, _same(docs, "in_id", "in_th"))
            .select("keys", F.explode(F.array_distinct(F.split("text", "\n"))).alias("raw"))
            .select("keys", plain(F.col("raw")).alias("line")).withColumn("key", F.xxhash64("line"))
            .where(F.array_contains("keys", F.col("key")))
            .groupBy("key").agg(F.first("line").alias("line")))


def _templates(docs: DataFrame, lines: DataFrame, holder: str) -> DataFrame:
    """(key, keeper) of every line of a recurring template, from (doc_id, th, who, key, h0, h1, h2) rows of ``docs``."""
    # the first values of a group are those of one row
    kinds = materialize(lines.groupBy("key").agg(
        *[F.first(h).alias(h) for h in ("h0", "h1", "h2")], F.first("doc_id").alias("in_id"), F.first("th").alias("in_th"),
        F.min("who").alias("low"), F.max("who").alias("high"), F.min(holder).alias("keeper")))
    paths = (kinds.select("key", F.posexplode(F.array("h0", "h1", "h2")).alias("j", "leaf")).where("leaf is not null"))
    shared = paths.groupBy("leaf").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = materialize(paths.join(shared, "leaf"))
    asked = materialize(kinds.select("key", "in_id", "in_th").join(members.select("key").distinct(), "key"))
    release(docs.sparkSession)
    members = materialize(members.join(_texts(docs, asked), "key"))
    release(docs.sparkSession)
    template = (members.select("leaf", "size", F.posexplode(F.split("line", " ")).alias("at", "token"))
                .groupBy("leaf", "size", "at", "token").agg(F.count(F.lit(1)).alias("held"))
                .where(F.col("held") * 2 > F.col("size"))
                .groupBy("leaf").agg(F.collect_list(F.concat_ws(" ", "at", "token")).alias("template")))
    own = F.transform(F.split("line", " "), lambda t, i: F.concat_ws(" ", i.cast("string"), t))
    fits = (members.join(template, "leaf").withColumn("own", own)
            .where(F.size(F.array_intersect("own", "template")) >= F.size("own") * F.lit(SIMILAR)))
    best = materialize(fits.groupBy("key").agg(F.max(F.struct("size", -F.col("j"), "leaf")).alias("best"))
                       .select("key", "best.leaf"))
    ends = kinds.select("key", "low", "high", "keeper")
    recurring = (ends.join(best, "key").groupBy("leaf")
                 .agg(F.min("low").alias("low"), F.max("high").alias("high"), F.min("keeper").alias("keeper"))
                 .where("low <> high").select("leaf", "keeper"))
    alone = ends.where("low <> high").join(best, "key", "left_anti").select("key", "keeper")
    return materialize(best.join(recurring, "leaf").select("key", "keeper").unionByName(alone))


def drop_template_lines(docs: DataFrame, copies_once: bool = False) -> DataFrame:
    """``docs`` with the lines of recurring templates taken out of ``text`` (see the module text)."""
    gone = spare_name(docs, "gone_keys")
    th = F.xxhash64("text")
    who = th if copies_once else F.coalesce(F.col("doc_id").cast("long"), th)
    # texts are hashed before they are cut, once a text and not once a line
    cut = (docs.select("doc_id", th.alias("th"), who.alias("who"), "text")
           .select("doc_id", "th", "who", F.explode(F.array_distinct(F.split("text", "\n"))).alias("raw"))
           .where(F.col("raw").rlike(f"[^{_SPACE}]"))
           .select("doc_id", "th", "who", plain(F.col("raw")).alias("line"))
           .select("*", F.split("line", " ").alias("t"))
           .select("doc_id", "th", "who", "line", "t", F.size("t").alias("n"))
           .select("doc_id", "th", "who", F.xxhash64("line").alias("key"),
                   *[h.alias(f"h{j}") for j, h in enumerate(_blocks())]))
    lines = materialize(cut)
    holder = "th" if copies_once else "doc_id"
    found = _templates(docs, lines, holder)
    release(docs.sparkSession)
    lost = (lines.select("doc_id", "th", "key").join(found, "key")
            .where(~F.col(holder).eqNullSafe(F.col("keeper")) | F.col("keeper").isNull())
            .groupBy("doc_id", "th").agg(F.collect_set("key").alias(gone))
            .withColumnsRenamed({"doc_id": "lost_id", "th": "lost_th"}))
    marked = docs.join(lost, _same(docs, "lost_id", "lost_th"), "left")
    kept = F.filter(F.split("text", "\n"), lambda x: ~F.array_contains(gone, line_key(x)))
    return (marked.withColumn("text", F.when(F.col(gone).isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")))
            .select(*docs.columns))


def op9_log_template_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    n = F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n"))).cast("long")
    # whole texts are counted before, so that each is shuffled once
    return (drop_template_lines(docs.select("doc_id", "text", n.alias("n_lines")))
            .select("doc_id", "n_lines", n.alias("n_left"),
                    F.length("text").cast("long").alias("n_chars_left"), F.sha2("text", 256).alias("text_sha256")))


OP9_SQL = r"""
with cut as (select doc_id, text, unnest(string_split(text, chr(10))) as raw,
                    generate_subscripts(string_split(text, chr(10)), 1) as i from documents),
masked as (select doc_id, i, raw, trim(regexp_replace(regexp_replace(raw, '[^ \t\r\f\x0B]*[0-9][^ \t\r\f\x0B]*', '<*>', 'g'),
                  '[ \t\r\f\x0B]+', ' ', 'g')) as line from cut),
kinds as materialized (select line, string_split(line, ' ') as t, len(string_split(line, ' ')) as n,
                 min(doc_id) as low, max(doc_id) as high from masked where line <> '' group by line),
paths as materialized (select line, t, j, n || '|' || j || '|' || array_to_string(
             t[(n * j // b + 1):(n * (j + 1) // b)], ' ') as leaf
          from (select *, case when n >= 9 then 3 else 2 end as b from kinds where n >= 6), (select unnest([0, 1, 2]) as j)
          where j < b),
members as materialized (select p.*, s.size from paths p join (select leaf, count(*) as size from paths group by leaf having count(*) > 1) s
            on p.leaf = s.leaf),
spread as (select leaf, line, j, size, len(t) as n, unnest(t) as token, generate_subscripts(t, 1) as pos from members),
template as (select leaf, pos, token from spread group by leaf, size, pos, token having count(*) * 2 > size),
fits as (select s.line, s.leaf, s.j, s.size from spread s join template m on s.leaf = m.leaf and s.pos = m.pos and s.token = m.token
         group by s.line, s.leaf, s.j, s.size, s.n having count(*) >= s.n * 0.6::double),
best as (select line, first(leaf order by size desc, j) as leaf from fits group by line),
grouped as (select k.line, coalesce(b.leaf, '=' || k.line) as g, k.low, k.high from kinds k left join best b on k.line = b.line),
recurring as (select g, min(low) as keeper from grouped group by g having min(low) <> max(high)),
gone as (select line, keeper from grouped join recurring using (g)),
kept as (select m.doc_id, m.raw, m.i from masked m left join gone on m.line = gone.line
         where gone.line is null or m.doc_id = gone.keeper),
left_over as (select doc_id, count(*) as n, string_agg(raw, chr(10) order by i) as text from kept group by doc_id)
select d.doc_id, coalesce(len(string_split(d.text, chr(10))), 0)::bigint as n_lines,
       case when d.text is null then 0 else coalesce(k.n, 1) end::bigint as n_left,
       length(case when d.text is null then null else coalesce(k.text, '') end)::bigint as n_chars_left,
       sha256(case when d.text is null then null else coalesce(k.text, '') end) as text_sha256
from documents d left join left_over k on d.doc_id = k.doc_id
"""
