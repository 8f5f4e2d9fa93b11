"""Line dedup by the fixed-depth tree: brute force, SQL, fields in long lines, few documents, null keys, no Python."""

import duckdb
import pytest
from pyspark.sql import functions as F

import brute
from helpers import empty, frame, odd_rows, prose
from tessera.llm import linetree as L


def _rows():
    rows = odd_rows()
    for i in range(25):
        name, host = f"n{'abcdefghijklmnopqrstuvwxy'[i]}", f"h{'yxwvutsrqponmlkjihgfedcba'[i]}"
        lines = [f"User {name} opened the shared report from host {host} and closed it again today", prose(900 + i, 14),
                 f"Posted by user{i} on 2024-01-{i:02d}", "", "  "]
        if i < 9:
            lines.append("one boilerplate line that nine documents hold and no other one")
        if i % 2:
            lines.append(f"Read next article named {name} on site today")
        rows.append((300 + i, "\n".join(lines)))
    copy = "a copied line of its own\nand another one"
    return rows + [(500 + i, copy) for i in range(6)] + [(None, copy), (None, "Posted by user7 on 2024")]


def _pairs(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()), key=str)


@pytest.mark.parametrize("copies_once", [False, True])
def test_equal_brute_force(spark, copies_once):
    rows = _rows()
    docs = frame(spark, rows)
    out = L.drop_template_lines(docs, copies_once)
    assert out.columns == docs.columns
    keys = {r["text"]: r["th"] for r in docs.select("text", F.xxhash64("text").alias("th")).collect()}
    got = _pairs(out)
    assert got == sorted(brute.template_lines(rows, copies_once, keys), key=str)
    texts = [t or "" for _, t in got]
    assert sum("opened the shared" in t for t in texts) == 1
    assert sum("one boilerplate line" in t for t in texts) == 1
    assert sum("a copied line" in t for t in texts) == (7 if copies_once else 1)


def test_clean_lines_stay(spark):
    rows = [(i, "\n".join(prose(2000 + 7 * i + j, 12) for j in range(5))) for i in range(40)]
    assert _pairs(L.drop_template_lines(frame(spark, rows))) == sorted(rows, key=str)


def test_empty_and_no_python(spark):
    assert L.drop_template_lines(empty(spark)).count() == 0
    plan = L.drop_template_lines(frame(spark, [(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def test_text_is_written_only_of_lines_that_share_a_leaf(spark, monkeypatch):
    written = []
    monkeypatch.setattr(L, "materialize", lambda df, real=L.materialize: written.append(real(df)) or written[-1])
    alone = [(i, "\n".join(prose(3000 + 7 * i + j, 12) for j in range(5))) for i in range(30)]
    pair = [(100 + i, f"Report of host{'ab'[i]} was closed by the operator on duty this very morning again") for i in range(2)]
    kept = dict(_pairs(L.drop_template_lines(frame(spark, alone + pair))))
    assert kept == dict(alone) | {100: pair[0][1], 101: ""}
    lines = {r["line"] for df in written if "line" in df.columns for r in df.select("line").collect()}
    assert lines == {t for _, t in pair}


def test_sql_equals_the_operator(spark, tmp_path):
    rows = sorted({i: t for i, t in _rows() if i is not None}.items())
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    names = ["doc_id", "n_lines", "n_left", "n_chars_left", "text_sha256"]
    want = sorted(con.execute(f"select {', '.join(names)} from ({L.OP9_SQL})").fetchall())
    assert sorted(map(tuple, L.op9_log_template_lines(spark, str(tmp_path)).select(names).collect())) == want
