"""Exact top-k inner-product search: a ball tree per shard, branch and bound.

Components become floor(1024 * x); scores are integer inner products. Vectors
are dealt to shards of about ``SHARD_ROWS`` by a hash of vec_id; each shard is
indexed once (one row: its vectors in tree order and its nodes). Queries are
packed in blocks of about ``QUERY_ROWS``.

For a query q and a node with centre c and radius r, no vector below scores
above q.c + |q| r. Nodes are visited in order of that bound; the search of a
shard ends at the first bound below the current k-th score (or equal to it
while all ids below are larger: ties go to the smaller id). The k-th score is
shared: first every block searches its home shard; the k-th scores found there
start the search of all other shards, and within a task they go on rising from
shard to shard.

Every block meets every shard: the shards lie in partitions, a task goes through one of
them with a partition of blocks (about ``BLOCKS_A_TASK``), which it reads itself. So
neither side is broadcast through the driver, and blocks are not written once a shard.
What a task holds is one shard and the blocks' running results.

Defined cases: vectors that are null or hold null or non-finite components, and
rows without a vec_id, take no part; shorter vectors count as padded with
zeros; rows with the query's vec_id are its own; repeated query rows are
answered once, repeated candidates each count; fewer candidates than k are all
returned; an empty table gives no rows; scores beyond a long are cut to its range.
"""

from __future__ import annotations

import heapq
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.shared import batch_rows, materialize, table

SCALE = 1024
SHARD_ROWS = 8192
QUERY_ROWS = 1024
LEAF_ROWS = 64
PAIRS_A_BATCH = 16  # a row of the pairs is a few MB
BLOCKS_A_TASK = 32
SHARDS_A_TASK = 16
EXACT = float(1 << 52)
LONG = np.iinfo(np.int64)


def quantized(embeddings: DataFrame) -> DataFrame:
    """(vec_id, v) of the rows that take part; v holds floor(1024 * x) as longs."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    v = F.transform("embedding", lambda x: F.floor(x.cast("double") * F.lit(float(SCALE))).cast("long"))
    return (embeddings.where("vec_id is not null and embedding is not null").where(finite)
            .select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")))


def _pack(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def _unpack(data: bytes) -> dict[str, np.ndarray]:
    z = np.load(io.BytesIO(data))
    return {k: z[k] for k in z.files}


def _matrix(col: pa.ChunkedArray) -> np.ndarray:
    """Rows of a list column as a matrix, shorter rows padded with zeros."""
    rows = [np.asarray(x, dtype=np.int64) for x in col.to_pylist()]
    out = np.zeros((len(rows), max(map(len, rows), default=0)), np.int64)
    for i, r in enumerate(rows):
        out[i, :len(r)] = r
    return out


def _narrow(m: np.ndarray) -> np.ndarray:
    """``m`` in the smallest of the types of 16, 32 and 64 bits that holds it."""
    for kind in (np.int16, np.int32):
        if np.iinfo(kind).min <= m.min(initial=0) and m.max(initial=0) <= np.iinfo(kind).max:
            return m.astype(kind)
    return m


def build_tree(ids: np.ndarray, vectors: np.ndarray, leaf_rows: int = LEAF_ROWS) -> dict[str, np.ndarray]:
    """Ball tree over rows: vectors and ids in tree order, and per node its range, children, ball and least id."""
    order = np.argsort(ids, kind="stable")
    x = vectors.astype(np.float64)
    first, last, left, centre, radius = [], [], [], [], []
    todo = [(0, len(ids), -1)]
    while todo:
        s, e, parent = todo.pop()
        node = len(first)
        if parent >= 0:  # the second child comes later: its number is one above the first's subtree
            left[parent].append(node)
        rows = x[order[s:e]]
        c = rows.mean(axis=0)
        d = np.sqrt(((rows - c) ** 2).sum(axis=1))
        first.append(s)
        last.append(e)
        left.append([])
        centre.append(c)
        radius.append(d.max())
        if e - s > leaf_rows and d.max() > 0:
            a = rows[d.argmax()]
            b = rows[((rows - a) ** 2).sum(axis=1).argmax()]
            by = np.argsort(rows @ (b - a), kind="stable")
            order[s:e] = order[s:e][by]
            mid = (s + e) // 2
            todo += [(mid, e, node), (s, mid, node)]
    children = np.array([c or [-1, -1] for c in left], np.int64)
    ordered = ids[order]
    least = np.array([ordered[s:e].min() for s, e in zip(first, last)], np.int64)
    return {"ids": ordered, "vectors": vectors[order], "first": np.array(first), "last": np.array(last),
            "children": children, "centre": np.array(centre), "radius": np.array(radius), "least": least}


class Best:
    """Running k best (score, vec_id) of one query; the worst is on top."""

    def __init__(self, k: int):
        self.k = k
        self.heap: list[tuple[int, int]] = []  # (score, -vec_id)

    def floor(self) -> tuple[int, int] | None:
        return self.heap[0] if len(self.heap) == self.k else None

    def add(self, score: int, vec_id: int) -> None:
        if len(self.heap) < self.k:
            heapq.heappush(self.heap, (score, -vec_id))
        elif (score, -vec_id) > self.heap[0]:
            heapq.heapreplace(self.heap, (score, -vec_id))


def search(tree: dict[str, np.ndarray], query_ids: np.ndarray, queries: np.ndarray, best: list[Best]) -> None:
    """Branch and bound of every query over one shard's tree, raising ``best`` in place."""
    dims = max(tree["vectors"].shape[1], queries.shape[1])

    def padded(m: np.ndarray) -> np.ndarray:
        return np.pad(m, ((0, 0), (0, dims - m.shape[1])))

    x, q, centre = padded(tree["vectors"]), padded(queries), padded(tree["centre"])
    ids, first, last, children, least = (tree[n] for n in ("ids", "first", "last", "children", "least"))
    xf, qf = x.astype(np.float64), q.astype(np.float64)
    norm_q = np.sqrt((qf ** 2).sum(axis=1))
    reach = np.sqrt((centre ** 2).sum(axis=1)) + tree["radius"]
    exact = float(norm_q.max(initial=0)) * float(reach.max(initial=0)) < EXACT  # then doubles hold every sum
    bound = qf @ centre.T + norm_q[:, None] * tree["radius"][None, :]
    bound += 1e-6 + 1e-9 * norm_q[:, None] * reach[None, :]  # rounding only ever loosens a bound
    bound = np.floor(bound)
    for i, own in enumerate(query_ids.tolist()):
        mine, of = best[i], bound[i]
        heap = [(-of[0], 0)]
        while heap:
            up, node = heapq.heappop(heap)
            low = mine.floor()
            if low is not None:
                if -up < low[0]:
                    break
                if -up == low[0] and least[node] > -low[1]:
                    continue
            if children[node, 0] >= 0:
                for child in children[node].tolist():
                    heapq.heappush(heap, (-of[child], child))
                continue
            s, e = int(first[node]), int(last[node])
            if exact:
                scores = (xf[s:e] @ qf[i]).astype(np.int64)
            else:
                scores = np.array([min(max(int(v), LONG.min), LONG.max) for v in
                                   x[s:e].astype(object) @ q[i].astype(object)], np.int64)
            use = ids[s:e] != own
            if low is not None:
                use &= scores >= low[0]
            for score, vec_id in zip(scores[use].tolist(), ids[s:e][use].tolist()):
                mine.add(score, vec_id)


def _index(vectors: DataFrame, n_shards: int) -> DataFrame:
    def work(group: pa.Table) -> pa.Table:
        tree = build_tree(group.column("vec_id").to_numpy(), _matrix(group.column("v")))
        tree["vectors"] = _narrow(tree["vectors"])
        return pa.table({"shard": group.column("shard")[:1], "tree": pa.array([_pack(**tree)], pa.binary())})

    dealt = vectors.withColumn("shard", F.pmod(F.xxhash64("vec_id", "v"), F.lit(n_shards)).cast("int"))
    return dealt.groupBy("shard").applyInArrow(work, "shard int, tree binary")


def _blocks(queries: DataFrame, n_blocks: int) -> DataFrame:
    def work(group: pa.Table) -> pa.Table:
        packed = _pack(ids=group.column("vec_id").to_numpy(), vectors=_narrow(_matrix(group.column("v"))))
        return pa.table({"block": group.column("block")[:1], "queries": pa.array([packed], pa.binary())})

    dealt = queries.withColumn("block", F.pmod(F.xxhash64("vec_id", "v", F.lit(1)), F.lit(n_blocks)).cast("int"))
    return dealt.groupBy("block").applyInArrow(work, "block int, queries binary")


FOUND = "block int, query int, query_id long, vec_id long, score long"
_FOUND = pa.schema([("block", pa.int32()), ("query", pa.int32()), ("query_id", pa.int64()), ("vec_id", pa.int64()),
                    ("score", pa.int64())])


def _searched(pairs: DataFrame, k: int, with_floor: bool) -> DataFrame:
    """Search every (block, shard) row; a task's results for a block carry over to its next shard."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict[int, tuple[np.ndarray, np.ndarray, list[Best], list[set]]] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                block = batch.column("block")[i].as_py()
                if block not in state:
                    q = _unpack(batch.column("queries")[i].as_py())
                    best = [Best(k) for _ in q["ids"]]
                    if with_floor:
                        for x in batch.column("floor")[i].as_py() or ():
                            best[x["query"]].add(x["score"], x["vec_id"])
                    state[block] = q["ids"], q["vectors"], best, [set(b.heap) for b in best]
                ids, vectors, best, _ = state[block]
                search(_unpack(batch.column("tree")[i].as_py()), ids, vectors, best)
        rows = [(block, n, int(ids[n]), -x[1], x[0]) for block, (ids, _, best, before) in state.items()
                for n, b in enumerate(best) for x in b.heap if x not in before[n]]
        for at in range(0, len(rows), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows[at:at + (1 << 16)]), _FOUND)],
                                             schema=_FOUND)

    return pairs.mapInArrow(work, FOUND)


def _pairs(index: DataFrame, blocks: DataFrame, n_shards: int, n_blocks: int) -> DataFrame:
    """A row for each block of ``blocks`` with each shard but its home; rows of one shard follow each other."""
    cores = index.sparkSession.sparkContext.defaultParallelism
    n_parts = min(n_shards, max(2 * cores, -(-n_shards // SHARDS_A_TASK)))
    # the hint: both are read by the tasks that need them; a join by number would broadcast one of them, or write each block once a shard
    return (index.repartition(n_parts).hint("shuffle_replicate_nl")
            .join(blocks.repartition(-(-n_blocks // BLOCKS_A_TASK), "block"), F.col("shard") != F.col("home"))
            .select("block", "queries", "floor", "tree"))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, shard_rows: int = SHARD_ROWS,
          query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best other vectors of every query (both: vec_id, v)."""
    spark = vectors.sparkSession
    n_shards = 1 + vectors.count() // shard_rows
    n_blocks = 1 + queries.count() // query_rows
    index = materialize(_index(vectors, n_shards))
    blocks = materialize(_blocks(queries.distinct(), n_blocks))
    home = F.pmod("block", F.lit(n_shards)).cast("int")
    with batch_rows(spark, PAIRS_A_BATCH):
        first = materialize(_searched(blocks.withColumn("shard", home).join(index.hint("merge"), "shard")
                                      .select("block", "queries", "tree"), k, False))
    floor = first.groupBy("block").agg(F.collect_list(F.struct("query", "score", "vec_id")).alias("floor"))
    pairs = _pairs(index, blocks.join(floor.hint("merge"), "block", "left").withColumn("home", home), n_shards, n_blocks)
    with batch_rows(spark, PAIRS_A_BATCH):
        rest = materialize(_searched(pairs, k, True))
    found = first.unionByName(rest)
    order = Window.partitionBy("block", "query").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op1_ball_tree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = quantized(table(spark, sf_dir, "embeddings"))
    return top_k(vectors, vectors.where("vec_id % 100 = 0"))


OP1_SQL = """
with v as (select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) as v from embeddings
           where vec_id is not null and embedding is not null
             and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (select q.vec_id as query_id, c.vec_id,
             list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::bigint as score
           from v q join v c on q.vec_id % 100 = 0 and c.vec_id <> q.vec_id),
ranked as (select query_id, row_number() over (partition by query_id order by score desc, vec_id) as rank, vec_id, score
           from scored)
select query_id, rank::int as rank, vec_id, score from ranked where rank <= 10
"""
