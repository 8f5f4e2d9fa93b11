"""Prefix trie of conversations: what shared beginnings would save, per node.

A node is a distinct sequence of first turns; its subtree totals (leaves, saved
bytes) are sums over all nodes below it. They are found by time-forward
processing: nodes are sorted by reverse level order, each sends its totals to its
parent through a priority queue ordered alike, and when a node's turn comes,
the messages at the head of the queue are those of its children. The queue keeps
a bounded number of messages in memory and spills sorted runs.

Steps, each a Spark job over rows of bounded size (texts are left behind at once):

1. Turns are numbered and hashed; each conversation is a chain of 128-bit node keys
   (a running BLAKE2 over SHA-256 digests of its turns).
2. Rows are grouped by key into nodes; a hot beginning is pre-aggregated.
3. Head nodes have more members than ``max(PIECE, rows / HEADS)``. As the members of
   all nodes add up to the rows, there are at most ``HEADS`` of them however large
   the input. What hangs below the heads are pieces, subtrees of a bounded number
   of members; a shard is the pieces that a hash deals to one task.
4. Shards run the time-forward pass by themselves. The totals of their pieces' roots are
   summed by parent and go into the same pass over the heads, one small task.

The ids of conversations that end in a node are hashed in order: joined per range of
ids, which no hot node can outgrow, and fed to one running SHA-256 range by range.

Spill files lie in Spark's own scratch folders (the worker's SPARK_LOCAL_DIRS), have
no name and are read by the task that wrote them alone; a lost executor costs a rerun.

Defined cases: null role or text is empty; turns are in order of turn (null first),
then role, then text, repeated rows are turns of their own; rows without a conv_id
belong to no conversation; a conversation without turns is a member of the root; an
empty table has no root and gives no rows; extra columns are ignored. ``%`` truncates
towards zero for negative ids, as in SQL.
"""

from __future__ import annotations

import hashlib
import heapq
import os
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.shared import batch_rows, materialize, table

HEADS = 5000
PIECE = 32
QUEUE = 200_000  # messages kept in memory by one task
ID_RANGE = 10_000
GROUP, FIRST = 5, 9  # of the rebuilding rule: ids a group spans, and the modulus of the shared turns
NO_ENDS = hashlib.sha256(b"").hexdigest()


class SpillingQueue:
    """Priority queue of tuples; beyond ``limit`` its messages go to sorted runs on disk."""

    def __init__(self, limit: int = QUEUE, block: int = 1000, most_runs: int = 16):
        self.limit, self.block, self.most_runs = limit, block, most_runs
        self.heap: list[tuple] = []
        self.heads: list[tuple] = []  # (message, number of the run, rest of the run)
        self.numbered = 0
        self.spilled = 0

    def _run(self, messages: Iterator[tuple]) -> Iterator[tuple]:
        folder = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0] or None
        file = tempfile.TemporaryFile(dir=folder)
        part: list[tuple] = []
        for message in messages:
            part.append(message)
            if len(part) == self.block:
                pickle.dump(part, file)
                part = []
        pickle.dump(part, file)
        pickle.dump(None, file)
        file.seek(0)

        def read() -> Iterator[tuple]:
            with file:
                while (part := pickle.load(file)) is not None:
                    yield from part

        return read()

    def _add_run(self, run: Iterator[tuple]) -> None:
        if (message := next(run, None)) is not None:
            self.numbered += 1
            heapq.heappush(self.heads, (message, self.numbered, run))

    def push(self, message: tuple) -> None:
        heapq.heappush(self.heap, message)
        if len(self.heap) > self.limit:
            self.spilled += len(self.heap)
            self._add_run(self._run(iter(sorted(self.heap))))
            self.heap = []
            if len(self.heads) > self.most_runs:
                runs = [[(m,), r] for m, _, r in self.heads]
                self.heads = []
                self._add_run(self._run(heapq.merge(*((x for part in run for x in part) for run in runs))))

    def peek(self) -> tuple | None:
        tops = [q[0] for q in (self.heap,) if q] + [h[0][0] for h in (self.heads,) if h]
        return min(tops) if tops else None

    def pop(self) -> tuple:
        if self.heads and (not self.heap or self.heads[0][0] < self.heap[0]):
            message, number, run = self.heads[0]
            following = next(run, None)
            if following is None:
                heapq.heappop(self.heads)
            else:
                heapq.heapreplace(self.heads, (following, number, run))
            return message
        return heapq.heappop(self.heap)


TOTALS = ("key binary, conv_id long, depth long, parent binary, parent_conv_id long, n_convs long, "
          "n_children long, n_leaves long, saved long")


def pass_up(nodes: DataFrame, queue: int = QUEUE) -> DataFrame:
    """Subtree totals of the nodes of each partition, which must come by depth (deepest first) and key.

    ``is_root`` marks nodes whose parent is not in the partition: their row keeps the
    parent's key and no parent_conv_id. ``children``, ``leaves`` and ``saved`` are what
    a node has already got from elsewhere. A node's row is given out when its
    parent, who knows the parent's conv_id, is reached.
    """
    schema = pa.schema([("key", pa.binary()), ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent", pa.binary()),
                        ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
                        ("n_leaves", pa.int64()), ("saved", pa.int64())])
    columns = ("key", "parent", "is_root", "conv_id", "depth", "n_convs", "bytes", "children", "leaves", "saved")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = SpillingQueue(queue)
        for batch in batches:
            out: list[tuple] = []
            for (key, parent, is_root, conv, depth, n_convs, size, children, leaves,
                 saved) in zip(*(batch.column(c).to_pylist() for c in columns)):
                saved += (n_convs - 1) * size
                while (top := waiting.peek()) is not None and top[0] == -depth and top[1] == key:
                    *_, child_key, child_conv, child_convs, child_children, child_leaves, child_saved = waiting.pop()
                    children, leaves, saved = children + 1, leaves + child_leaves, saved + child_saved
                    out.append((child_key, child_conv, depth + 1, key, conv, child_convs, child_children, child_leaves,
                                child_saved))
                leaves = leaves if children else 1
                if is_root:
                    out.append((key, conv, depth, parent, None, n_convs, children, leaves, saved))
                else:
                    waiting.push((1 - depth, parent, key, conv, n_convs, children, leaves, saved))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
        if waiting.peek() is not None:
            raise RuntimeError("a node's parent is not among the nodes of its shard")

    return nodes.mapInArrow(work, TOTALS)


def turn_rows(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn_no, digest, bytes): the turns of each conversation, numbered from 1."""
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                                F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    place = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    digest = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    return (rows.where("conv_id is not null").withColumn("turn_no", F.row_number().over(place))
            .select("conv_id", "turn_no", digest.alias("digest"), F.octet_length("text").cast("long").alias("bytes")))


def rebuilt(turns: DataFrame) -> DataFrame:
    """Turn rows of the rebuilt conversations, the turns of the group's first one before a conversation's own.

    Every conversation has one more row, with turn_no 0 and part 0, for the root.
    """
    shared = F.crc32(F.col("conv_id").cast("string")) % FIRST
    # the window above has dealt the turns by conv_id: no shuffle for the distinct ids
    convs = turns.where("turn_no = 1").select("conv_id", (F.col("conv_id") - F.col("conv_id") % GROUP).alias("first"),
                                              shared.alias("n_shared"))
    begin = (turns.where(F.col("turn_no") < FIRST).withColumnRenamed("conv_id", "first").join(convs, "first")
             .where("turn_no <= n_shared").select("conv_id", F.lit(1).alias("part"), "turn_no", "digest", "bytes"))
    own = (turns.where(F.col("turn_no") > shared)
           .select("conv_id", F.lit(2).alias("part"), "turn_no", "digest", "bytes"))
    root = convs.select("conv_id", F.lit(0).alias("part"), F.lit(0).alias("turn_no"),
                        F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("long").alias("bytes"))
    return root.unionByName(begin).unionByName(own)


def chains(rows: DataFrame) -> DataFrame:
    """(conv_id, depth, key, parent, bytes, is_end): the nodes along each conversation, from the root."""
    schema = pa.schema([("conv_id", pa.int64()), ("depth", pa.int64()), ("key", pa.binary()), ("parent", pa.binary()),
                        ("bytes", pa.int64()), ("is_end", pa.bool_())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row: whether a conversation ends there is known with the next
        conv, depth, key = None, 0, b""
        for batch in batches:
            out: list[tuple] = []
            for c, digest, size in zip(*(batch.column(x).to_pylist() for x in ("conv_id", "digest", "bytes"))):
                if held is not None:
                    out.append((*held, c != conv))
                if c != conv:
                    conv, depth, key, parent = c, 0, b"", None
                else:
                    parent, depth = key, depth + 1
                    key = hashlib.blake2b(key + digest, digest_size=16).digest()
                held = (c, depth, key, parent, size)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), schema)], schema=schema)
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((*held, True), schema)], schema=schema)

    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "part", "turn_no")
    return ordered.mapInArrow(work, "conv_id long, depth long, key binary, parent binary, bytes long, is_end boolean")


def end_hashes(paths: DataFrame, id_range: int = ID_RANGE) -> DataFrame:
    """(key, ends_sha256) of the nodes in which conversations end."""
    part = F.floor(F.col("conv_id") / id_range)
    chunks = (paths.where("is_end").groupBy("key", part.alias("part"))
              .agg(F.array_sort(F.collect_list("conv_id")).alias("ids"))
              .select("key", "part", F.array_join(F.transform("ids", lambda i: i.cast("string")), ",").alias("ids")))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None

        def batch_of(done: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([k for k, _ in done], pa.binary()),
                                               pa.array([s for _, s in done], pa.string())], names=["key", "ends_sha256"])

        for batch in batches:
            done = []
            for k, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist()):
                if k == key:
                    state.update(b"," + ids.encode())
                else:
                    if state is not None:
                        done.append((key, state.hexdigest()))
                    key, state = k, hashlib.sha256(ids.encode())
            if done:
                yield batch_of(done)
        if state is not None:
            yield batch_of([(key, state.hexdigest())])

    return (chunks.repartition("key").sortWithinPartitions("key", "part")
            .mapInArrow(work, "key binary, ends_sha256 string"))


def prefix_trie(rows: DataFrame, heads: int = HEADS, piece: int = PIECE, queue: int = QUEUE,
                id_range: int = ID_RANGE) -> DataFrame:
    """One row per node of the trie of the conversations whose turn rows are given (see :func:`rebuilt`).

    Columns as in the query: conv_id (the smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens (bytes) and ends_sha256.
    """
    spark = rows.sparkSession
    with batch_rows(spark, 10_000):
        paths = materialize(chains(rows))
    nodes = materialize(paths.groupBy("key").agg(F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"),
                                                 F.max("parent").alias("parent"), F.max("bytes").alias("bytes"),
                                                 F.count(F.lit(1)).alias("n_convs")))
    most = max(piece, -(-paths.count() // heads))
    # at most ``heads`` nodes have so many members (and the root): small enough to go to every task
    top = materialize(nodes.where((F.col("n_convs") > most) | (F.col("depth") == 0)))
    light = nodes.where((F.col("n_convs") <= most) & (F.col("depth") > 0))
    roots = (paths.join(F.broadcast(top.select("key")), "key", "left_anti").groupBy("conv_id")
             .agg(F.min_by("key", "depth").alias("piece")))
    zero = [F.lit(0).cast("long").alias(c) for c in ("children", "leaves", "saved")]
    shards = (light.join(roots, "conv_id")
              .select("key", "parent", (F.col("key") == F.col("piece")).alias("is_root"), "conv_id", "depth", "n_convs",
                      "bytes", *zero, "piece")
              .repartition("piece").sortWithinPartitions(F.desc("depth"), "key"))
    with batch_rows(spark, 10_000):
        below = materialize(pass_up(shards, queue))
    with batch_rows(spark, 500):  # rows hold up to ``id_range`` ids
        ends = materialize(end_hashes(paths, id_range))
    linked = below.where("parent_conv_id is not null")
    cut = below.where("parent_conv_id is null")
    got = cut.groupBy(F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("children"), F.sum("n_leaves").alias("leaves"),
                                                        F.sum("saved").alias("saved"))
    head = (top.join(got, "key", "left").na.fill(0, ["children", "leaves", "saved"])
            .select("key", "parent", (F.col("depth") == 0).alias("is_root"), "conv_id", "depth", "n_convs", "bytes",
                    "children", "leaves", "saved"))
    above = pass_up(head.repartition(1).sortWithinPartitions(F.desc("depth"), "key"), queue)
    cut = cut.drop("parent_conv_id").join(
        F.broadcast(top.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))), "parent")
    every = linked.unionByName(cut).unionByName(above)
    return (every.join(ends, "key", "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                    F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256")))


def op12_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(rebuilt(materialize(turn_rows(table(spark, sf_dir, "conversations")))))


OP12_SQL = f"""
with t as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
    row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as i
  from conversations where conv_id is not null),
ids as (select distinct conv_id as c, conv_id::varchar as s from t),
bits as (
  select c, list_prepend(4294967295::bigint, list_transform(range(0, 8 * length(s)),
    lambda k: case when k % 8 = 0 then ascii(s[(k // 8 + 1)::bigint]) else 0 end::bigint)) as e from ids),
convs as (
  select c, c - c % {GROUP} as b, xor(list_reduce(e, lambda a, x: case when xor(a, x) & 1 = 1
    then xor(xor(a, x) >> 1, 3988292384) else xor(a, x) >> 1 end), 4294967295) % {FIRST} as h from bits),
r as (
  select c, 1 as part, i, role, text from convs join t on conv_id = b and i <= h
  union all select c, 2, i, role, text from convs join t on conv_id = c and i > h),
p as (
  select c, row_number() over w as d, strlen(text) as bytes,
    sha256(string_agg(sha256(length(role) || ':' || role || text), ',') over w) as k
  from r window w as (partition by c order by part, i rows between unbounded preceding and current row)),
a as (select c, d, k, bytes from p union all select c, 0, '', 0 from convs),
n as (select k, min(c) as c, max(d) as d, count(*) as m, max(bytes) as bytes from a group by k),
kids as (select a.k, count(*) as n_children from n join a on a.c = n.c and a.d = n.d - 1 group by a.k),
sums as (
  select a.k, sum((n.m - 1) * n.bytes) as saved, count(*) filter (kids.k is null) as n_leaves
  from n left join kids on kids.k = n.k join a on a.c = n.c and a.d <= n.d group by a.k),
ends as (
  select a.k, sha256(string_agg(a.c::varchar, ',' order by a.c)) as ends_sha256
  from a join (select c, max(d) as d from a group by c) z on z.c = a.c and z.d = a.d group by a.k)
select n.c as conv_id, n.d::bigint as depth, above.c as parent_conv_id, n.m::bigint as n_convs,
  coalesce(n_children, 0)::bigint as n_children, n_leaves::bigint as n_leaves, saved::bigint as saved_tokens,
  coalesce(ends_sha256, sha256('')) as ends_sha256
from n join sums on sums.k = n.k left join kids on kids.k = n.k left join ends on ends.k = n.k
  left join a up on up.c = n.c and up.d = n.d - 1 left join n above on above.k = up.k
"""
