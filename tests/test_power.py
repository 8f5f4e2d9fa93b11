"""Power iteration over shared events against the explicit matrix, on a planted graph and with a hot event."""

import numpy as np

from conftest import SF_SMALL
from tessera.operators.power import shared_event_clusters
from tessera.plans.catalog import ORACLE, QUERIES

SCHEMA = "who long, what long"


def _explicit(rows, steps):
    pairs = sorted({(m, e) for m, e in rows if m is not None and e is not None})
    names = sorted({m for m, _ in pairs})
    held = np.array([[float((m, e) in set(pairs)) for e in sorted({e for _, e in pairs})] for m in names])
    links = held @ held.T
    np.fill_diagonal(links, 0)
    some = links.sum(1) > 0
    links, names = links[some][:, some], [m for m, x in zip(names, some) if x]
    degree = links.sum(1)
    v = degree / degree.sum()
    before, tol = np.inf, max(1e-5 / len(v), 1e-8)
    for _ in range(steps):
        raw = links @ v / degree
        new = raw / np.abs(raw).sum()
        change, v = np.abs(new - v).sum(), new
        if abs(change - before) < tol:
            break
        before = change
    return {m: (int(d), x * len(v)) for m, d, x in zip(names, degree, v)}


def _planted():
    """Two groups of members with events of their own, of unlike size, and one hot event that most hold."""
    draw = np.random.default_rng(3)
    rows = [(m, 100 + int(e)) for m in range(30) for e in draw.choice(12, 6, replace=False)]
    rows += [(m, 200 + int(e)) for m in range(30, 50) for e in draw.choice(40, 4, replace=False)]
    rows += [(m, 1) for m in range(0, 50, 3)]
    rows += rows[:7] + [(None, 100), (3, None), (99, 999)]  # repeats, nulls, a member alone with its event
    return rows


def test_positions_equal_the_explicit_matrix(spark):
    rows = _planted()
    for partitions in (1, 7):
        df = spark.createDataFrame(rows, SCHEMA).repartition(partitions)
        got = {r["who"]: r for r in shared_event_clusters(df, "who", "what", k=2, max_steps=6).collect()}
        want = _explicit(rows, 6)
        assert set(got) == set(want) and 99 not in got
        for m, (degree, position) in want.items():
            assert got[m]["degree"] == degree and abs(got[m]["position"] - position) < 1e-9


def test_planted_groups_are_found(spark):
    # no event in common: the groups' levels stay apart
    rows = [(m, e) for m, e in _planted() if e != 1]
    got = {r["who"]: r["cluster"] for r in
           shared_event_clusters(spark.createDataFrame(rows, SCHEMA), "who", "what", k=2).collect()}
    assert {got[m] for m in range(30)} == {1} and {got[m] for m in range(30, 50)} == {0}


def test_empty_and_unlinked(spark):
    for rows in ([], [(1, 1), (2, 2)], [(None, None)]):
        assert shared_event_clusters(spark.createDataFrame(rows, SCHEMA), "who", "what").count() == 0


def test_query_is_registered_with_sql(spark):
    assert "ml_pic_suppliers" in ORACLE
    rows = QUERIES["ml_pic_suppliers"](spark, SF_SMALL).collect()
    assert rows and {r["cluster"] for r in rows} <= {0, 1, 2}
