"""The pipeline's stages against plain versions, and the registered queries against their SQL."""

import brute
from pyspark.sql import functions as F

import corpus_pipeline as C
import pytest
from helpers import empty, frame, odd_rows, prose

from tessera.llm import toxicity as X
from tessera.llm.queries import ORACLE, QUERIES
from tessera.llm.tokens import default_tokenizer

SMALL = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)


def test_stages_on_a_small_corpus(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    bench = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    rows = _rows(docs)

    out = C.toxicity(spark, docs, SMALL)
    assert out.schema == docs.schema
    model = X.train(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
    scored = {r["doc_id"]: r["score"] for r in X.score(docs.select("doc_id", "text"), model).collect()}
    rows = [x for x in rows if scored[x[0]] < 0.7]
    assert _rows(out) == rows

    docs, out = out, C.line_dedup(spark, out, SMALL)
    assert out.schema == docs.schema
    keys = {r["text"]: r["th"] for r in docs.select("text", F.xxhash64("text").alias("th")).collect()}
    rows = sorted(brute.template_lines(rows, copies_once=True, keys=keys), key=str)
    assert _rows(out) == rows

    docs, out = out, C.simhash_near_dedup(spark, out, SMALL)
    assert out.schema == docs.schema
    keep = {c for _, _, c in brute.groups(rows)}
    rows = [x for x in rows if x[0] in keep]
    assert _rows(out) == rows

    docs, out = out, C.benchmark_decontamination(spark, out, SMALL)
    assert out.schema == docs.schema
    rows = [x for x, found in zip(rows, brute.leaks(rows, bench)) if not found[2]]
    assert _rows(out) == rows

    last = C.best_fit_packing(spark, out, SMALL).toPandas()
    ids = brute.token_ids([t for _, t in rows], default_tokenizer())
    assert last.groupby("doc_id").length.sum().to_dict() == {i: len(x) + 1 for (i, _), x in zip(rows, ids)}
    whole = C.run(spark, SMALL).toPandas()
    cols = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, whole[cols].values.tolist())) == sorted(map(tuple, last[cols].values.tolist()))
    assert whole.groupby("sequence_id").length.sum().max() <= 2048


def test_stages_survive_odd_rows_and_an_empty_table(spark):
    for docs in (frame(spark, odd_rows() + [(400, prose(9, 50))]), empty(spark)):
        for _, stage in C.STAGES[:-1]:
            out = stage(spark, docs, SMALL)
            assert out.columns == docs.columns
            docs = out
        assert C.STAGES[-1][1](spark, docs, SMALL).count() >= docs.count()


def test_stages_are_named():
    assert [n for n, _ in C.STAGES] == ["toxicity", "line_dedup", "simhash_near_dedup", "benchmark_decontamination",
                                        "best_fit_packing"]
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)] + ["pipeline"]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_match_their_sql(spark, name):
    from oracle import duck, rows_of

    got, expected = QUERIES[name](spark, SMALL).toPandas(), duck(SMALL).sql(ORACLE[name]).df()
    assert sorted(got.columns) == sorted(expected.columns)
    assert rows_of(got) == rows_of(expected)


def test_contract_queries_against_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    bench = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    rows = _rows(docs)

    def got(name, *cols):
        return sorted(tuple(r) for r in QUERIES[name](spark, SMALL).select(*cols).collect())

    assert got("op2_simhash_near_dedup", "doc_id", "fingerprint", "component_id") == sorted(brute.groups(rows))
    assert got("op5_substring_dedup", "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(brute.repeats(rows))
    assert got("op7_wu_manber_decontamination", "doc_id", "n_words", "n_hit", "n_items",
               "items_sha256") == sorted(brute.leaks(rows, bench))
    rows.sort()
    at, files, pieces = 0, [], []
    for (i, _), ids in zip(rows, brute.token_ids([t for _, t in rows], default_tokenizer())):
        files.append((i, at, len(ids) + 1, brute.crc([*ids, 1])))
        at += len(ids) + 1
        ids = [*ids, 0]
        pieces += [(i, n, s, len(ids[s:s + 2048]), brute.crc(ids[s:s + 2048]))
                   for n, s in enumerate(range(0, len(ids), 2048))]
    assert got("op8_token_file", "doc_id", "start", "n_tokens", "ids_crc32") == files
    assert got("op3_best_fit_packing", "doc_id", "piece", "start", "length", "ids_crc32") == sorted(pieces)
    scores = QUERIES["op6_toxicity_fm"](spark, SMALL).collect()
    assert len(scores) == len(rows) and all(r["predicted"] == int(r["score"] >= 0.7) for r in scores)
    assert len(QUERIES["op4_license_scan"](spark, SMALL).collect()) == len(rows)
