"""Conversation prefix trie against brute force."""

import hashlib
import random
import zlib

import duckdb
import pytest

from tessera.llm import trie as T

KIND = "conv_id long, turn long, role string, text string, key string, depth long"


def conversations(seed, n):
    r = random.Random(seed)
    rows = []
    for c in r.sample(range(-20, 3 * n), n):
        for t in range(r.choice([1, 1, 2, 3, 5, 12])):
            rows.append((c, None if r.random() < 0.05 else t, r.choice(["user", "assistant", None]),
                         r.choice(["hi", "hi", "hi", "", None, "Ñandú", "go on"]), "k", 1))
    return rows


def brute(rows):
    own = {}
    for c, t, role, text, *_ in rows:
        if c is not None:
            own.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        first = c - int(c - 5 * int(c / 5))
        built[c] = own.get(first, [])[:h] + turns[h:]
    members = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for node, cs in members.items():
        below = [x for x in members if x[:len(node)] == node]
        leaves = [x for x in below if not any(len(y) == len(x) + 1 and y[:len(x)] == x for y in below)]
        ends = sorted(c for c in cs if len(built[c]) == len(node))
        out.append((min(cs), len(node), min(members[node[:-1]]) if node else None, len(cs),
                    sum(len(x) == len(node) + 1 for x in below), len(leaves),
                    sum((len(members[x]) - 1) * len(x[-1][1].encode()) for x in below if x),
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return out


@pytest.mark.parametrize("heads,piece,queue,id_range", [(5000, 1000, 1000, 10_000), (5000, 3, 1000, 7), (10, 1, 2, 3)])
def test_trie_equals_brute_force(spark, heads, piece, queue, id_range):
    rows = conversations(heads + piece, 90) + [(None, 0, "user", "hi", "k", 1), (7, 0, "user", "hi", "k", 1)] * 2
    turns = T.turn_rows(spark.createDataFrame(rows, KIND).repartition(4))
    got = [tuple(r) for r in T.prefix_trie(T.rebuilt(turns), heads, piece, queue, id_range).collect()]
    assert sorted(got, key=str) == sorted(brute(rows), key=str)


def test_query_equals_sql_and_brute_force(spark, tmp_path):
    rows = conversations(3, 120)
    frame = spark.createDataFrame(rows, KIND).repartition(3)
    frame.write.parquet(f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    got = T.op12_conversation_prefix_trie(spark, str(tmp_path))
    sql = con.execute(T.OP12_SQL)
    assert got.columns == [c[0] for c in sql.description]
    want = sorted(brute(rows), key=str)
    assert sorted(map(tuple, got.collect()), key=str) == want and sorted(sql.fetchall(), key=str) == want


def test_long_and_hot_conversations(spark):
    """Half of all conversations are one text; one has two thousand turns."""
    rows = [(c, t, "user", f"same {t}", "k", 1) for c in range(0, 600, 2) for t in range(3)]
    rows += [(c, 0, "user", f"own {c}", "k", 1) for c in range(1, 600, 2)]
    rows += [(10_000, t, "user", "x", "k", 1) for t in range(2000)]
    turns = T.turn_rows(spark.createDataFrame(rows, KIND))
    got = {(r[0], r[1]): tuple(r) for r in T.prefix_trie(T.rebuilt(turns), piece=20, queue=50, id_range=100).collect()}
    root = got[0, 0]
    assert root[2] is None and root[3] == 601 and sum(r[4] == 0 for r in got.values()) == root[5]
    assert max(d for _, d in got) >= 1990
    parents = {}
    for r in got.values():
        if r[2] is not None:
            parents[r[2], r[1] - 1] = parents.get((r[2], r[1] - 1), 0) + 1
    assert all(parents.get(at, 0) == r[4] for at, r in got.items())


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], KIND).write.parquet(f"{tmp_path}/conversations.parquet")
    assert T.op12_conversation_prefix_trie(spark, str(tmp_path)).collect() == []


def test_queue_spills_and_keeps_order():
    r = random.Random(1)
    queue, want = T.SpillingQueue(limit=7, block=3, most_runs=4), []
    values = [r.randrange(1000) for _ in range(3000)]
    low = -1
    for v in values:  # pushed and popped in turns, never below what has been popped
        queue.push((max(v, low), v))
        if r.random() < 0.4:
            want.append(queue.pop())
            low = want[-1][0]
    while queue.peek() is not None:
        assert queue.peek()[0] >= low
        want.append(queue.pop())
        low = want[-1][0]
    assert queue.spilled > 1000 and sorted(x[1] for x in want) == sorted(values)
    assert [x[0] for x in want] == sorted(x[0] for x in want)
