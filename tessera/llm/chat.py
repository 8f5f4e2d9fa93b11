"""Chat formatting with a grammar round trip, in DataFrame functions only.

Grammar of a formatted conversation:

    conversation = { turn }
    turn         = "[INST " role "] " text "</s>"

Control strings (``[INST``, ``[/INST]``, ``</s>``) stand for control wherever the
grammar meets them, so a text or role that holds one conflicts with it. Formatting
starts from the plain texts. The result is parsed again; where a turn conflicts, or
the parser does not recover the very turns (their roles and texts in order),
roles and texts are escaped and the conversation is formatted anew until they
are identical. Escaping is complete: an escaped text holds neither a control
string nor a bare backslash, so the second round always is.

Escapes (the parser always undoes them): ``\\`` is ``\\0``, ``</s>`` is ``\\1``,
``[INST`` is ``\\2``, ``[/INST]`` is ``\\3``, and in roles ``]`` is ``\\4``.

The loss mask is a list of spans (start, length in characters, of the formatted
text) that cover the assistant texts and nothing else.

A conversation is one row of the output, so it must fit in a row (2 GB); its
turns are gathered by conv_id and nothing else is.

Defined cases: a null text or role is empty; turns are in order of turn, then
role, then text (null turns first), repeated rows are turns of their own; rows
without a conv_id make one conversation; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.shared import materialize, table

# fixed values: control strings and their escapes; the backslash goes first and comes back last
END, OPEN, CLOSE_ROLE = "</s>", "[INST ", "] "
TEXT_ESCAPES = [("\\", "\\0"), ("</s>", "\\1"), ("[INST", "\\2"), ("[/INST]", "\\3")]
CONTROLS = ("</s>", "[INST", "[/INST]")
ROLE_ESCAPES = [*TEXT_ESCAPES, ("]", "\\4")]
ASSISTANT = "assistant"
# fixed value: the conversation that says nothing but control strings
EXTRA = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, ASSISTANT, "</s>[INST] ok [/INST]")]


def escape(text: Column, pairs: list[tuple[str, str]]) -> Column:
    for plain, coded in pairs:
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def unescape(text: Column, pairs: list[tuple[str, str]]) -> Column:
    for plain, coded in reversed(pairs):
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


def _head(role: Column) -> Column:
    return F.concat(F.lit(OPEN), role, F.lit(CLOSE_ROLE))


def render(turns: Column, escaped: bool) -> Column:
    """Formatted text of an array of (role, text)."""

    def one(t: Column) -> Column:
        role, text = t["role"], t["text"]
        if escaped:
            role, text = escape(role, ROLE_ESCAPES), escape(text, TEXT_ESCAPES)
        return F.concat(_head(role), text, F.lit(END))

    return F.array_join(F.transform(turns, one), "")


def parse(formatted: Column) -> Column:
    """Array of (role, text) of a formatted text, by the grammar."""

    def one(piece: Column) -> Column:
        to = F.instr(piece, CLOSE_ROLE)
        role = F.substring(piece, F.lit(len(OPEN) + 1), to - F.lit(len(OPEN) + 1))
        text = F.substring(piece, to + F.lit(len(CLOSE_ROLE)), F.length(piece))
        return F.struct(unescape(role, ROLE_ESCAPES).alias("role"), unescape(text, TEXT_ESCAPES).alias("text"))

    pieces = F.split(formatted, END)
    return F.transform(F.slice(pieces, 1, F.size(pieces) - 1), one)


def conflicts(turns: Column) -> Column:
    """Does a role or text of an array of (role, text) hold a control string?"""
    return F.exists(turns, lambda t: reduce(or_, [F.contains(t[part], F.lit(c)) for part in ("role", "text") for c in CONTROLS]))


def loss_spans(formatted: Column) -> Column:
    """Spans (start, length) of the assistant texts, read off the formatted text; start counts from 1."""
    pieces = F.split(formatted, END)
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)
    first = F.struct(F.lit(1).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))

    def add(state: Column, piece: Column) -> Column:
        head = F.instr(piece, CLOSE_ROLE) + F.lit(len(CLOSE_ROLE) - 1)
        span = F.struct((state["at"] + head).alias("start"), (F.length(piece) - head).alias("length"))
        ours = F.startswith(piece, F.lit(OPEN + ASSISTANT + CLOSE_ROLE))
        spans = F.when(ours, F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct((state["at"] + F.length(piece) + F.lit(len(END))).alias("at"), spans.alias("spans"))

    return F.aggregate(pieces, first, add)["spans"]


def format_chats(conversations: DataFrame) -> DataFrame:
    """(conv_id, formatted, escaped, loss_mask) for every conversation (columns conv_id, turn, role, text)."""
    turn = F.struct("turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                    F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    grouped = conversations.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    source = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    first = (grouped.select("conv_id", source.alias("turns"))
             .withColumn("plain", render(F.col("turns"), escaped=False))
             .withColumn("escaped", conflicts(F.col("turns")) | (parse(F.col("plain")) != F.col("turns")))
             .withColumn("formatted", F.when(F.col("escaped"), render(F.col("turns"), escaped=True))
                         .otherwise(F.col("plain"))))
    again = F.assert_true(parse(F.col("formatted")) == F.col("turns"), "a conversation does not survive its round trip")
    # null if it holds; as a condition of the text itself it cannot be pruned away
    checked = first.withColumn("formatted", F.when(again.isNull(), F.col("formatted")))
    return checked.select("conv_id", "formatted", "escaped", loss_spans(F.col("formatted")).alias("loss_mask"))


def chat_digests(formatted: DataFrame) -> DataFrame:
    """What the op10 query returns, from the formatted texts and loss masks alone."""
    turns = parse(F.col("formatted"))
    every = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = F.array_join(F.transform("loss_mask", lambda s: unescape(
        F.substring(F.col("formatted"), s["start"], s["length"]), TEXT_ESCAPES)), "")
    return (formatted.withColumn("learned", learned)
            .select("conv_id", F.size(turns).cast("long").alias("n_turns"), F.sha2(every, 256).alias("turns_sha256"),
                    F.length("learned").cast("long").alias("loss_chars"),
                    F.sha2("learned", 256).alias("loss_sha256"),
                    F.length("formatted").cast("long").alias("formatted_chars")))


def op10_chat_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    extra = spark.createDataFrame(EXTRA, "conv_id long, turn long, role string, text string")
    return chat_digests(materialize(format_chats(rows.unionByName(extra))))


OP10_SQL = r"""
with rows as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
coded as (
  select *, replace(replace(replace(replace(text, '\', '\0'), '</s>', '\1'), '[INST', '\2'), '[/INST]', '\3') as etext,
    replace(replace(replace(replace(replace(role, '\', '\0'), '</s>', '\1'), '[INST', '\2'), '[/INST]', '\3'), ']', '\4')
      as erole,
    replace(replace(replace(replace(text, '\3', '[/INST]'), '\2', '[INST'), '\1', '</s>'), '\0', '\') <> text
      or contains(text, '</s>') or role <> replace(replace(replace(replace(replace(
        role, '\4', ']'), '\3', '[/INST]'), '\2', '[INST'), '\1', '</s>'), '\0', '\')
      or contains(text, '[INST') or contains(text, '[/INST]')
      or contains(role, '</s>') or contains(role, '[INST') or contains(role, '[/INST]') or contains(role, '] ') as bad
  from rows)
select conv_id, count(*)::bigint as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (where role = 'assistant'), ''))
    as loss_sha256,
  (case when bool_or(bad) then sum(length(erole) + length(etext)) else sum(length(role) + length(text)) end
    + 12 * count(*))::bigint as formatted_chars
from coded group by conv_id
"""
