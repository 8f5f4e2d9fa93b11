"""Substring dedup, decontamination, line dedup, license scan."""

import random

import brute
import pytest
from helpers import empty, frame, odd_rows, prose

from tessera.llm import decontam as D
from tessera.llm import licenses as C
from tessera.llm import lines as L
from tessera.llm import substring as B


def _passages(seed=1):
    """Documents that share passages of many lengths, hot ones too."""
    r = random.Random(seed)
    hot = prose(900, 60)
    rows = []
    for i in range(120):
        text = prose(i, r.randint(0, 60))
        if i % 3 == 0:
            text += " " + hot
        if i and r.random() < 0.5:
            w = rows[r.randrange(i)][1].split()
            if w:
                s = r.randrange(len(w))
                text += " " + " ".join(w[s:s + r.randint(5, 40)])
        rows.append((r.choice([i, i + 1000]), text + " " + prose(5000 + i, 5)))
    return rows


@pytest.mark.parametrize("chunk,bucket", [(8 << 20, 6 << 20), (700, 900)])
def test_repeats_equal_brute_force(spark, chunk, bucket):
    for rows in (_passages(), odd_rows()):
        out = B.remove_repeats(frame(spark, rows), chunk_bytes=max(chunk, 700 if len(rows) > 60 else 20_000),
                               bucket_bytes=max(bucket, 900 if len(rows) > 60 else 20_000), with_text=True).collect()
        got = [(r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in out]
        assert sorted(got, key=str) == sorted(brute.repeats(rows), key=str)
        for r in out:
            spans = list(zip(r["spans"][::2], r["spans"][1::2]))
            assert sum(e - s for s, e in spans) == r["n_removed"] and brute.sha(r["kept_text"]) == r["kept_sha256"]
            assert all(e - s >= 13 for s, e in spans) and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_repeats_other_window(spark):
    rows = _passages(3)
    got = [tuple(r)[:4] for r in B.remove_repeats(frame(spark, rows), window=6).drop("spans").collect()]
    assert sorted(got, key=str) == sorted(brute.repeats(rows, 6), key=str)


ITEMS = [(1, prose(70, 30)), (2, "Short one"), (3, None), (4, ""), (5, "... --"), (1, prose(71, 14)), (6, prose(72, 10)),
         (None, prose(73, 20)), (7, "dozen"), (22, prose(70, 30)), (8, "aaa aaa aaa aaa aaa aaa aaa aaa aaa aaa aaa")]


@pytest.mark.parametrize("part_words", [2_000_000, 40])
def test_leaks_equal_brute_force(spark, part_words):
    rows = odd_rows() + [(200, "x " + prose(70, 30).upper() + " y"), (201, " ".join(prose(70, 30).split()[3:13])),
                         (202, " ".join(prose(70, 30).split()[3:12])), (203, "aaa " * 25), (204, "SHORT one two"),
                         (205, prose(72, 10) + "-" + prose(71, 14)), (206, prose(73, 20))]
    items = [x for x in ITEMS if x[0] != 7] if part_words == 40 else ITEMS
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = D.find_leaks(frame(spark, rows).select("doc_id", "text"), bench, part_words=part_words).collect()
    got = [(r["doc_id"], r["n_words"], len(r["hit_words"]), len(r["hit_items"]), brute.sha(",".join(r["hit_items"])))
           for r in out]
    assert sorted(got, key=str) == sorted(brute.leaks(rows, items), key=str)
    assert len(D.benchmark_parts(bench, part_words)) == (1 if part_words > 100 else 1 + int(
        sum(len((t or "").encode()) / 2 + 1 for i, t in items if i is not None) // 40))


def test_drop_leaks_keeps_columns_and_clean_documents(spark):
    rows = odd_rows() + [(200, prose(70, 30))]
    docs = frame(spark, rows)
    bench = spark.createDataFrame([(1, prose(70, 30))], "item_id long, text string")
    kept = D.drop_leaks(docs, bench)
    assert kept.columns == docs.columns
    clean = [i for (i, _), x in zip(rows, brute.leaks(rows, [(1, prose(70, 30))])) if not x[2]]
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted(clean, key=str) and 200 not in clean
    none = bench.where("item_id < 0")
    assert D.drop_leaks(docs, none).count() == len(rows)
    assert D.drop_leaks(empty(spark), bench).count() == 0


def test_shift_table_skips():
    s = D.Searcher(4, {(1, 2, 3, 4): {0}, (2, 2, 3, 5): {1}}, 5)
    assert s.default == 3 and s.shift[s._key((3, 4), 2)] == 0 and s.shift[s._key((2, 3), 2)] == 1
    assert [(e, sorted(i)) for e, i in s.occurrences([1, 2, 3, 4, 2, 2, 3, 5, 0, 1, 2, 3])] == [(4, [0]), (8, [1])]


def _line_rows():
    rows = odd_rows()
    r = random.Random(8)
    for i in range(60):
        body = [prose(10_000 + 10 * i + j, 12) for j in range(3)]
        body.insert(r.randrange(3), f"Posted by user{i} on 2024-01-{i:02d}")
        body.insert(0, "All rights reserved by the owner of this site")
        if i % 2:
            body.append(f"Read next article named {prose(i, 1).strip('.,')} on site today")
        if i % 5 == 0:
            body += ["", "   "]
        rows.append((300 + i, "\n".join(body)))
    copy = "a copied line of its own\nand another one"
    return rows + [(500 + i, copy) for i in range(30)]


def test_lines_equal_brute_force(spark):
    rows = _line_rows()
    docs = frame(spark, rows)
    out = L.drop_recurring_lines(docs)
    assert out.columns == docs.columns
    got = sorted(((r["doc_id"], r["text"]) for r in out.select("doc_id", "text").collect()), key=str)
    expected = sorted(brute.lines(rows), key=str)
    assert got == expected
    left = dict(got)
    assert "Posted by" in left[300] and not any("Posted by" in left[300 + i] for i in range(1, 60))
    assert all(left[500 + i].startswith("a copied line") for i in range(30))  # copies count once
    assert L.drop_recurring_lines(empty(spark)).count() == 0


def test_lines_run_no_python(spark):
    plan = L.drop_recurring_lines(frame(spark, [(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def test_licenses_and_inheritance(spark):
    mit, gpl = C.TEMPLATES["MIT"], C.TEMPLATES["GPL-3.0"]
    files = [(1, "a/LICENSE", mit), (2, "a/x.txt", prose(1, 50)), (3, "a/b/c/y.txt", None), (4, "a/b/LICENSE.md", prose(2, 5) + "\n" + gpl),
             (5, "a/b/c/z.txt", prose(3, 30) + "\n" + C.TEMPLATES["Apache-2.0"].upper() + "\n" + prose(4, 30)),
             (6, "d/x.txt", ""), (7, None, mit), (8, None, "nothing here"), (9, "a/license/x.txt", "plain words"),
             (10, "LICENCE", "All rights reserved."), (11, "top.txt", "by the of version"), (2, "a/x.txt", prose(1, 50)),
             (12, "a/COPYING", "Released, under MIT license!")]
    df = spark.createDataFrame([(*f, "extra") for f in files], "doc_id long, path string, text string, license string")
    got = {r["doc_id"]: (r["own_license"], r["license"], r["licensed_by"]) for r in C.scan_licenses(df).collect()}
    assert got == {1: ("MIT", "MIT", None), 2: (None, "MIT", "a"), 3: (None, "GPL-3.0", "a/b"),
                   4: ("GPL-3.0", "GPL-3.0", None), 5: ("Apache-2.0", "Apache-2.0", None), 6: (None, "proprietary", ""),
                   7: ("MIT", "MIT", None), 8: (None, None, None), 9: (None, "MIT", "a"),
                   10: ("proprietary", "proprietary", None), 11: (None, "proprietary", ""), 12: ("MIT", "MIT", None)}
    assert C.scan_licenses(df).count() == len(files)
    assert C.scan_licenses(df.where("doc_id > 100")).count() == 0


def test_license_score_is_the_cosine(spark):
    import math

    texts = ["released under the MIT license by us", "the cat", prose(1, 30), "under the table"]
    df = spark.createDataFrame([(i, f"f{i}", t) for i, t in enumerate(texts)], "doc_id long, path string, text string")
    own = {r["doc_id"]: r["score"] for r in C.own_licenses(df, {"MIT": "Released under the MIT License."}).collect()}
    vocabulary = "released under the mit license".split()
    n = len(texts)
    df_ = {t: sum(t in brute.ALNUM.findall(x.lower()) for x in texts) for t in vocabulary}
    idf = {t: math.log((1 + n) / (1 + df_[t])) + 1 for t in vocabulary}
    other = math.log(1 + n) + 1
    norm = math.sqrt(sum(v * v for v in idf.values()))
    expected = norm / math.sqrt(norm ** 2 + 2 * other ** 2)
    assert own[0] == pytest.approx(expected)
    assert own[1] == pytest.approx(idf["the"] ** 2 / norm / math.sqrt(idf["the"] ** 2 + other ** 2))


def _license_frame(spark, texts):
    return spark.createDataFrame([(i, f"f{i}", t) for i, t in enumerate(texts)], "doc_id long, path string, text string")


def test_license_words_have_their_own_frequency(spark):
    """A notice inside a sentence is found, and as well when the corpus grows at equal shares."""
    texts = ["This is released under the MIT License."] + [f"this is the text number {i} by us" for i in range(9)]
    scores = []
    for times in (1, 40):
        rows = {r["text"]: r for r in C.scan_licenses(_license_frame(spark, texts * times)).join(
            _license_frame(spark, texts * times), ["doc_id", "path"]).collect()}
        assert {t: rows[t]["license"] for t in texts} == {t: "MIT" if t == texts[0] else None for t in texts}
        scores.append(rows[texts[0]]["score"])
    assert scores[0] > 0.9 and scores[1] == pytest.approx(scores[0], abs=0.05)


def test_license_scores_equal_brute_force(spark):
    import math

    texts = [t for _, t in odd_rows()] + ["released under the MIT license by us\nnot under that", "the MIT " + prose(7, 9)]
    terms = {n: brute.ALNUM.findall(t.lower()) for n, t in C.TEMPLATES.items()}
    words = [brute.ALNUM.findall((t or "").lower()) for t in texts]

    def vector(ws):
        return {w: ws.count(w) * (math.log((1 + len(texts)) / (1 + sum(w in set(x) for x in words))) + 1) for w in set(ws)}

    def cosine(a, b):
        norm = math.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values()))
        return sum(x * b.get(w, 0) for w, x in a.items()) / norm if norm else 0.0

    units = [vector(t) for t in terms.values()]
    lines = [[vector(brute.ALNUM.findall(li.lower())) for li in (t or "").split("\n")] for t in texts]
    expected = [max(cosine(v, u) for v in ls for u in units) for ls in lines]
    for common in (3, C.COMMON):  # rare words by the join, and all words in the tasks
        got = C.own_licenses(_license_frame(spark, texts), all_words=True, common=common).collect()
        assert {r["doc_id"]: r["score"] for r in got} == pytest.approx(dict(enumerate(expected)))
