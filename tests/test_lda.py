"""LDA: special functions, the rising bound, planted topics, one result however the rows are dealt."""

import math
import random

import numpy as np
import pytest

from tessera.operators import lda as L


def test_special_functions():
    x = np.array([1e-3, 0.05, 0.2, 1, 2.5, 40, 1e5])
    assert np.allclose(L.log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-9, atol=1e-9)
    h = 1e-5
    slope = [(math.lgamma(v * (1 + h)) - math.lgamma(v * (1 - h))) / (2 * h * v) for v in x]
    assert np.allclose(L.digamma(x), slope, rtol=1e-6, atol=1e-6)


def planted(spark, parts, seed=1):
    """Three topics of twenty words each; a document draws nine tenths of its words from one; one word is in all."""
    r = random.Random(seed)
    rows = []
    for d in range(240):
        bag = {"everywhere": 6}
        for _ in range(60):
            w = f"t{d % 3 if r.random() < 0.9 else r.randrange(3)}w{int(20 * r.random() ** 2):02d}"
            bag[w] = bag.get(w, 0) + 1
        rows += [(d, w, float(n)) for w, n in bag.items()]
    return spark.createDataFrame(rows, "doc long, word string, n double").repartition(parts)


@pytest.mark.parametrize("block_pairs", [100_000, 700])
def test_planted_topics_are_found_and_the_bound_rises(spark, block_pairs):
    model = L.fit_lda(planted(spark, 3), 3, 12, 5, block_pairs)
    assert len(model.bounds) == 12
    assert all(b >= a - 1e-7 * abs(a) for a, b in zip(model.bounds, model.bounds[1:])) and model.bounds[-1] > model.bounds[0]
    terms = {}
    for x in model.top_terms(8).collect():
        terms.setdefault(x["topic"], []).append((x["rank"], x["word"], x["weight"]))
    topics = []
    for rows in terms.values():
        assert [x[0] for x in sorted(rows)] == list(range(8))
        assert [x[2] for x in sorted(rows)] == sorted((x[2] for x in rows), reverse=True)
        own = {w[:2] for _, w, _ in rows if w != "everywhere"}
        assert len(own) == 1
        topics.append(own.pop())
    assert sorted(topics) == ["t0", "t1", "t2"]
    right = 0
    for x in model.shares.collect():
        right += topics[int(np.argmax(x["shares"]))] == f"t{x['doc'] % 3}"
    assert right >= 235
    assert sum(model.totals) == pytest.approx(240 * 66 + 61, rel=1e-6)  # all words and the prior, 1 / 3 a word and topic


def test_dealing_does_not_matter(spark):
    a = L.fit_lda(planted(spark, 1), 3, 4, 5)
    b = L.fit_lda(planted(spark, 6), 3, 4, 5, 900)
    assert a.bounds == pytest.approx(b.bounds, rel=1e-9) and a.totals == pytest.approx(b.totals, rel=1e-6)


def test_no_rows(spark):
    model = L.fit_lda(spark.createDataFrame([], "doc long, word string, n double"), 2, 2, 1)
    assert model.totals == [0.0, 0.0] and model.top_terms(3).count() == 0 and model.shares.count() == 0


def test_parts_of_the_weights_do_not_matter(spark):
    a = L.fit_lda(planted(spark, 2), 3, 4, 5)
    b = L.fit_lda(planted(spark, 2), 3, 4, 5, 900, part_words=7)
    assert a.bounds == pytest.approx(b.bounds, rel=1e-9) and a.totals == pytest.approx(b.totals, rel=1e-6)
    assert [x[:3] for x in sorted(a.top_terms(5).collect())] == [x[:3] for x in sorted(b.top_terms(5).collect())]
    other = {x["doc"]: x["shares"] for x in b.shares.collect()}
    assert len(other) == 240 and all(other[x["doc"]] == pytest.approx(x["shares"], rel=1e-6) for x in a.shares.collect())


def test_rows_travel_by_block_and_part(spark):
    """Words of a block come as arrays: what a pass sends is a row a block and part, not a row a block and word."""
    rows = [(1, ["a", "b", "a"]), (None, ["b"]), (2, []), (1, ["c", "a"]), (3, None), (None, ["b", "d"])]
    df = spark.createDataFrame(rows, "doc long, word array<string>").repartition(1)
    pairs, words = L.pack_blocks(df, slice_pairs=3)
    names = {r["at"]: r["word"] for r in words.collect()}
    got, pieces = {}, pairs.collect()
    for r in pieces:
        pair = iter(zip(r["word"], r["n"]))
        for doc, size in zip(r["docs"], r["sizes"]):
            got[doc] = {names[w]: n for w, n in (next(pair) for _ in range(size))}
    assert got == {1: {"a": 3, "b": 1, "c": 1}, None: {"b": 2, "d": 1}}
    assert sorted(r["piece"] for r in pieces) == [0, 1]  # whole documents, the second piece where three pairs are full
    counted = spark.createDataFrame([(1, "a", 2.0), (1, "b", 1.0), (1, "c", 1.0), (1, "a", 1.0), (None, "b", 2.0),
                                     (None, "d", 1.0)], "doc long, word string, n double")
    a, b = (L.fit_lda(x, 2, 3, 1) for x in (df, counted))
    assert a.bounds == pytest.approx(b.bounds, rel=1e-9) and a.totals == pytest.approx(b.totals, rel=1e-9)


def test_the_disk_holds_one_pass(spark, monkeypatch):
    """What a pass wrote goes with the next: more passes leave no more tables; groups of blocks change nothing."""
    import os

    from tessera.session import checkpoint_root

    monkeypatch.setattr(L, "GROUP_BLOCKS", 2)
    root = checkpoint_root(spark).removeprefix("file:") + "/tessera-scratch"
    folders = lambda: len(os.listdir(root)) if os.path.isdir(root) else 0
    left = []
    for passes in (2, 5):
        before = folders()
        model = L.fit_lda(planted(spark, 6), 3, passes, 5, 900)
        left.append(folders() - before)
    assert left[0] == left[1]
    assert model.shares.count() == 240 and len(model.bounds) == 5
    monkeypatch.setattr(L, "GROUPS", 1)
    one = L.fit_lda(planted(spark, 6), 3, 5, 5, 900)
    assert one.bounds == pytest.approx(model.bounds, rel=1e-9) and one.totals == pytest.approx(model.totals, rel=1e-9)
