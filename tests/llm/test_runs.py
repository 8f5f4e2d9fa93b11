"""Periodic runs against brute force."""

import random
import zlib
from fractions import Fraction

import brute
import numpy as np
import pytest
from helpers import empty, frame, odd_rows, prose

from tessera.llm import runs as R


def runs_of(w, min_words=24, repeats=3):
    """[(start, length, period)] by trying every period at every place."""
    n, found = len(w), []
    for q in range(1, n // repeats + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j > i:
                s, e = i, j + q
                smaller = any(all(w[x] == w[x + p] for x in range(s, e - p)) for p in range(1, q))
                if e - s >= max(min_words, repeats * q) and not smaller:
                    found.append((s, e - s, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def planted(doc_id, w):
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not w:
        return w
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def digest(doc_id, text):
    w = planted(doc_id, brute.SPACED.findall(text or ""))
    found = runs_of(w)
    gone = {x for s, n, q in found for x in range(s + q, s + n)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    head = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(found), *head, brute.sha("".join(f"{s},{n},{q}\n" for s, n, q in found)),
            brute.sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def _texts(seed, n):
    """Small alphabets, powers, runs that meet and overlap, almost periodic stretches."""
    r = random.Random(seed)
    out = []
    for _ in range(n):
        w = []
        for _ in range(r.randint(1, 5)):
            root = [r.choice("ab" if r.random() < 0.5 else "abcdef") for _ in range(r.randint(1, 12))]
            w += (root * r.randint(1, 9))[:r.randint(1, 90)]
            if r.random() < 0.3:
                w += [r.choice("abc") for _ in range(r.randint(1, 6))]
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("min_words,repeats", [(24, 3), (3, 3), (10, 4)])
def test_word_runs_equal_brute_force(min_words, repeats):
    lists = [t.split() for t in _texts(min_words, 250)]
    codes = np.array([ord(x) for w in lists for x in w], np.int64)
    bounds = np.r_[0, np.cumsum([len(w) for w in lists])]
    start, length, period = R.word_runs(codes, bounds, min_words, repeats)
    want = [(int(b) + s, n, q) for b, w in zip(bounds, lists) for s, n, q in runs_of(w, min_words, repeats)]
    assert list(zip(start.tolist(), length.tolist(), period.tolist())) == want and len(want) > 100


def test_query_equals_brute_force(spark, tmp_path):
    texts = _texts(5, 120) + [prose(i, 60) for i in range(60)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(i, t) for i, t in odd_rows() if len(t or "") < 20_000]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in R.op11_periodic_runs(spark, str(tmp_path)).collect()]
    want = [digest(i, t) for i, t in rows]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert sum(w[1] > 0 for w in want) > 50 and sum(w[1] > 1 for w in want) > 10


def test_long_text_one_word_and_extra_columns(spark):
    rows = [(1, "x " * 200_000), (2, " ".join(f"w{i % 5000}" for i in range(40_000))), (3, None), (None, "y " * 30)]
    docs = frame(spark, rows).withColumn("runs", R.F.lit("old")).withColumn("Collapsed", R.F.lit(1))
    out = {r["doc_id"]: r for r in R.find_runs(docs).collect()}
    assert [tuple(x) for x in out[1]["runs"]] == [(0, 200_000, 1)] and out[1]["collapsed"] == "x"
    assert [tuple(x) for x in out[2]["runs"]] == [(0, 40_000, 5_000)] and len(out[2]["collapsed"].split()) == 5_000
    assert out[3]["runs"] == [] and out[3]["collapsed"] == "" and out[3]["text"] is None
    assert [tuple(x) for x in out[None]["runs"]] == [(0, 30, 1)]


def test_empty_table(spark, tmp_path):
    empty(spark).write.parquet(f"{tmp_path}/documents.parquet")
    assert R.op11_periodic_runs(spark, str(tmp_path)).collect() == []


def test_fewer_than_three_periods_are_refused():
    with pytest.raises(ValueError):
        R.word_runs(np.zeros(4, np.int64), np.array([0, 4]), repeats=2)
