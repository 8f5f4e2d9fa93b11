"""Quality classifier: word vectors against brute force, gradients, calibration, held-out accuracy, odd rows."""

import brute
import duckdb
import numpy as np
import pyarrow as pa
import pytest
from helpers import empty, frame, odd_rows

from tessera.llm import quality as Q

SF = "/root/testdata/sf0.01"


def slow_vectors(texts):
    """Sums of index vectors, word by word."""
    index = Q.index_vectors()
    sums = np.zeros((Q.UNITS, Q.DIMS + 1), np.int64)
    for text in texts:
        pairs = Q.Units(pa.array([text], pa.string())).pair
        assert len(pairs) == len(brute.SPACED.findall(text or ""))
        for i, pair in enumerate(pairs):
            for unit in pair:
                sums[unit, Q.DIMS] += 1
                for j in range(max(0, i - Q.REACH), min(len(pairs), i + Q.REACH + 1)):
                    if j != i:
                        sums[unit, :Q.DIMS] += index[pairs[j][0]] + index[pairs[j][1]]
    return sums


@pytest.mark.parametrize("parts", [1, 5])
def test_word_vectors_equal_brute_force(spark, parts, monkeypatch):
    rows = [(i, t) for i, t in odd_rows() if len(t or "") < 20_000]
    assert (Q.word_vectors(frame(spark, rows, parts)) == slow_vectors([t for _, t in rows])).all()


def test_chunks_do_not_matter(monkeypatch):
    texts = pa.array([t for _, t in odd_rows()], pa.string())
    units, index = Q.Units(texts), Q.index_vectors()
    whole, cut = (np.zeros((Q.UNITS, Q.DIMS + 1), np.int64) for _ in range(2))
    Q.add_contexts(units, index, whole)
    pooled = Q.pool(units, Q.directions(whole))
    monkeypatch.setattr(Q, "CHUNK", 37)
    Q.add_contexts(units, index, cut)
    assert (whole == cut).all() and (pooled == Q.pool(units, Q.directions(cut))).all()
    assert pooled.shape == (len(texts), 2 * Q.DIMS) and not pooled[3].any()


def test_network_learns_and_is_calibrated():
    """Labels drawn with known probabilities of a product of two inputs: no linear model can follow."""
    random = np.random.default_rng(1)
    x = random.normal(0, 1, (6000, 2 * Q.DIMS)) * np.r_[1, 1, np.full(2 * Q.DIMS - 2, 1e-4)]  # the others hardly vary
    p = Q.sigmoid(3 * x[:, 0] * x[:, 1])
    y = (random.random(6000) < p).astype(float)
    net = Q.fit(x[:5000], y[:5000])
    got = net.score(x[5000:])
    assert ((got > 0.5) == (p[5000:] > 0.5)).mean() > 0.85
    raw = net.logits(x[5000:])
    assert Q.log_loss(raw / net.a["temperature"], y[5000:]) < Q.log_loss(raw, y[5000:])  # overfitted before
    for low, high in ((0, 0.3), (0.3, 0.7), (0.7, 1)):
        some = (got >= low) & (got < high)
        assert abs(got[some].mean() - y[5000:][some].mean()) < 0.12
    assert np.allclose(Q.Network.load(net.dump()).score(x[:9]), net.score(x[:9]))


def test_held_out_accuracy(spark):
    got = Q.op13_quality_random_indexing(spark, SF).toPandas()
    labels = duckdb.sql(f"select doc_id, quality from '{SF}/labels.parquet'").df()
    assert len(got) == 1000 and got.score.between(0, 1).all() and got.held_out.mean() > 0.25
    held = got[got.held_out].merge(labels, on="doc_id")
    bad = held.quality == 0
    assert (held.predicted[bad] == 0).mean() > 0.8 and (held.predicted[~bad] == 1).mean() > 0.97
    assert held.score[~bad].min() > 0 and held.score[~bad].mean() > held.score[bad].mean() + 0.5


def test_odd_rows(spark):
    docs = frame(spark, odd_rows())
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(100, 140)] + [(None, 1, 0), (1, None, 0), (1, 1, 0), (1, 0, 0)],
                                   "doc_id long, quality int, toxic int")
    vectors = Q.directions(Q.word_vectors(docs))
    out = Q.score(docs, vectors, Q.train(docs, labels, vectors)).collect()
    assert len(out) == len(odd_rows()) and all(0 <= r["score"] <= 1 for r in out)
    assert len({r["score"] for r in out if r["doc_id"] in (3, 4, 5)}) == 1  # no words
    assert len({r["score"] for r in out if r["doc_id"] == 2}) == 1  # repeated rows
    few = labels.where("doc_id = 101")
    assert {r["score"] for r in Q.score(docs, vectors, Q.train(docs, few, vectors)).collect()} <= {0.75, 0.5}
    assert Q.train(docs, labels.limit(0), vectors).score(np.zeros((1, 2 * Q.DIMS)))[0] == pytest.approx(0.5)


def test_empty_tables(spark, tmp_path):
    empty(spark).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert Q.op13_quality_random_indexing(spark, str(tmp_path)).collect() == []
