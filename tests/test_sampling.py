"""Hash sampling: same rows at any partitioning; splits are complete and disjoint."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tessera.operators import sampling as smp
from tessera.sources.tables import table


@pytest.fixture(scope="module")
def orders(spark):
    return table(spark, SF_SMALL, "orders").select("o_orderkey", "o_orderstatus")


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_sample_partition_invariant(orders, parts):
    base = {r[0] for r in smp.hash_sample(orders, ["o_orderkey"], 0.6, 42).collect()}
    again = {r[0] for r in smp.hash_sample(orders.repartition(parts), ["o_orderkey"], 0.6, 42).collect()}
    assert base == again
    assert 0.5 < len(base) / orders.count() < 0.7


def test_split_complete_and_disjoint(orders):
    s = smp.hash_split(orders, ["o_orderkey"], {"training": 0.75, "test": 0.25}, 1099)
    counts = {r["split"]: r["count"] for r in s.groupBy("split").count().collect()}
    assert sum(counts.values()) == orders.count()
    assert 0.65 < counts["training"] / orders.count() < 0.85


def test_train_test_is_sample_plus_except(orders):
    """One-pass labels equal the sample / EXCEPT / union construction."""
    lab = smp.train_test_by_class(orders, "o_orderstatus", {"F": 42, "O": 43}, 0.6, ["o_orderkey"])
    parts = []
    for cls, seed in (("F", 42), ("O", 43)):
        c = orders.filter(F.col("o_orderstatus") == cls)
        tr = smp.hash_sample(c, ["o_orderkey"], 0.6, seed)
        parts.append((tr, c.subtract(tr)))
    train = {r[0] for tr, _ in parts for r in tr.collect()}
    test = {r[0] for _, te in parts for r in te.collect()}
    got_train = {r[0] for r in lab.filter("split = 'training'").collect()}
    got_test = {r[0] for r in lab.filter("split = 'test'").collect()}
    assert got_train == train and got_test == test


def test_stratified_drops_unlisted(orders):
    s = smp.stratified_sample(orders, "o_orderstatus", {"F": 1.0, "O": 0.0}, ["o_orderkey"], 7)
    statuses = {r[0] for r in s.select("o_orderstatus").distinct().collect()}
    assert statuses == {"F"}
    assert s.count() == orders.filter("o_orderstatus = 'F'").count()


def test_split_with_empty_last_part(orders):
    s = smp.hash_split(orders, ["o_orderkey"], {"a": 0.7, "b": 0.3, "c": 0.0}, 5)
    counts = {r["split"]: r["count"] for r in s.groupBy("split").count().collect()}
    assert "c" not in counts and sum(counts.values()) == orders.count()


@pytest.mark.parametrize("parts", [1, 8])
def test_xxhash_method_is_uniform_and_stable(orders, parts):
    a = {r[0] for r in smp.hash_sample(orders, ["o_orderkey"], 0.3, 9, method="xxhash64").collect()}
    b = {r[0] for r in smp.hash_sample(orders.repartition(parts), ["o_orderkey"], 0.3, 9,
                                       method="xxhash64").collect()}
    assert a == b and 0.24 < len(a) / orders.count() < 0.36
