import random

import brute
import numpy as np
import pytest
from helpers import empty, frame, odd_rows, prose
from pyspark.sql import functions as F

from tessera.llm import simhash as S
from tessera.llm.components import components


def _hex(rows):
    return sorted(((r["doc_id"], f"{r['fp'] & (1 << 64) - 1:016x}", r["component_id"]) for r in rows), key=str)


def test_equals_brute_force_on_odd_rows(spark):
    rows = odd_rows()
    got = _hex(S.near_duplicates(frame(spark, rows)).collect())
    assert got == sorted(brute.groups(rows), key=str)


def test_near_copies_link(spark):
    r = random.Random(5)
    rows = []
    for g in range(6):
        words = prose(g, 300).split()
        for c in range(12):
            copy = list(words)
            copy[r.randrange(len(copy))] = f"edit{c}"
            rows.append((g * 100 + c, " ".join(copy)))
    found = brute.groups(rows)
    assert len({c for _, _, c in found}) < len(rows)
    assert _hex(S.near_duplicates(frame(spark, rows)).collect()) == sorted(found, key=str)


@pytest.mark.parametrize("chunk", [3, 1024])
def test_links_of_a_hot_key_are_whole_however_it_is_cut(spark, chunk):
    r = random.Random(2)
    centre = r.getrandbits(64)
    fps = {centre}
    while len(fps) < 150:  # a chain-like cloud around one fingerprint
        f = r.choice(sorted(fps))
        for b in r.sample(range(64), r.randint(1, 6)):
            f ^= 1 << b
        fps.add(f)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    edges = S.links(spark.createDataFrame([(f,) for f in signed], "fp long"), 4, chunk=chunk)
    roots = {r["node"]: r["root"] for r in components(edges).collect()}
    parent = {f: f for f in signed}

    def find(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for a in signed:
        for b in signed:
            if ((a ^ b) & (1 << 64) - 1).bit_count() <= 4:
                parent[find(a)] = find(b)
    classes = {}
    for f in signed:
        classes.setdefault(find(f), set()).add(roots.get(f, f))
    assert all(len(c) == 1 for c in classes.values())
    assert len({next(iter(c)) for c in classes.values()}) == len(classes)
    assert edges.count() <= 15 * len(fps) * (1 if chunk > 150 else 60)  # a forest per group, not all pairs


def test_pigeonhole_keys_cover_every_close_pair():
    masks = np.array(S.key_masks(6, 2), np.int64).view(np.uint64)
    r = random.Random(1)
    for _ in range(2000):
        diff = np.uint64(sum(1 << b for b in r.sample(range(64), r.randint(0, 4))))
        assert ((masks & diff) == 0).any()
    assert len(masks) == 15


def test_components_of_chains_stars_and_noise(spark):
    r = random.Random(4)
    edges = [(i, i + 1) for i in range(1, 60)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5000, 5000), (None, 3)]
    edges += [(r.randrange(9000, 9100), r.randrange(9000, 9100)) for _ in range(60)] + [(2, 1)]
    got = {x["node"]: x["root"] for x in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    assert got == {x: find(x) for x in list(parent)}


def test_keep_one_row_per_group(spark):
    rows = odd_rows()
    docs = frame(spark, rows)
    kept = S.keep_one(docs)
    assert kept.columns == docs.columns
    got = sorted(x["doc_id"] for x in kept.where("doc_id is not null").select("doc_id").collect())
    assert got == sorted({c for _, _, c in brute.groups(rows) if c is not None})
    assert kept.where(F.col("doc_id").isNull()).count() == sum(i is None for i, _ in rows)


def test_keep_one_keeps_rows_that_share_a_doc_id_alone(spark):
    texts = [prose(i, 40) for i in range(4)]
    rows = [(1, texts[0]), (1, texts[1]), (2, texts[1]), (1, texts[0]), (3, texts[2]), (3, None), (4, texts[3]), (4, texts[3]),
            (5, texts[2])]
    kept = S.keep_one(frame(spark, rows)).select("doc_id", "text").collect()
    assert sorted(map(tuple, kept), key=str) == sorted([(1, texts[0]), (1, texts[1]), (3, texts[2]), (3, None), (4, texts[3])],
                                                       key=str)


def test_empty_table(spark):
    assert S.near_duplicates(empty(spark)).count() == 0
    assert S.keep_one(empty(spark)).count() == 0
