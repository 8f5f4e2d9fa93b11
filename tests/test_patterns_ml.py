"""Pattern mining against MLlib/brute force, and invariants of model queries."""

import math
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tessera.operators.patterns import sequential_pairs, sequential_patterns
from tessera.plans.catalog import QUERIES
from tessera.sources.tables import table


def prefix_span_mllib(df, seq, order, item, min_support, max_len=2):
    """MLlib PrefixSpan over per-sequence item lists."""
    from pyspark.ml.fpm import PrefixSpan

    rows = (df.groupBy(seq)
            .agg(F.sort_array(F.collect_list(F.struct(*[F.col(c) for c in order], F.col(item).alias("__it"))))
                 .alias("__s"))
            .select(F.transform("__s", lambda s: F.array(s["__it"])).alias("sequence")))
    ps = PrefixSpan(minSupport=min_support, maxPatternLength=max_len, sequenceCol="sequence")
    return ps.findFrequentSequentialPatterns(rows)


def test_sequential_pairs_equal_prefixspan(spark):
    ev = table(spark, SF_SMALL, "events").select("user_id", "ts", "event_id", "event_type")
    ours = {(r["item_1"], r["item_2"]): r["freq"]
            for r in sequential_pairs(ev, "user_id", ["ts", "event_id"], "event_type", 0.1).collect()}
    ref = {}
    for r in prefix_span_mllib(ev, "user_id", ["ts", "event_id"], "event_type", 0.1).collect():
        items = [s[0] for s in r["sequence"]]
        ref[(items[0], items[1] if len(items) > 1 else None)] = r["freq"]
    assert ours == ref


def test_sequential_patterns_of_every_length_equal_prefixspan(spark):
    r = random.Random(4)
    rows = []
    for user in range(30):
        rows += [(user, t // 2, 1000 * user + t, r.choice("abcdefgh")) for t in range(r.randint(1, 9))]
        if user % 3:
            rows += [(user, 50 + t, 1000 * user + 50 + t, x) for t, x in enumerate("pqpqr")]
    ev = spark.createDataFrame(rows, "user long, ts long, id long, kind string")
    args = (ev, "user", ["ts", "id"], "kind", 0.2)
    ours = {tuple(x["pattern"]): x["freq"] for x in sequential_patterns(*args).collect()}
    ref = {tuple(s[0] for s in x["sequence"]): x["freq"] for x in prefix_span_mllib(*args, max_len=30).collect()}
    assert ours == ref and ours[tuple("pqpqr")] == 20 and max(map(len, ours)) >= 5
    assert sequential_patterns(ev.limit(0), *args[1:]).count() == 0


@pytest.mark.parametrize("blocks", [1, 5, 64])
def test_sequential_patterns_with_hot_sequence_ties_and_nulls(spark, blocks):
    """One sequence holds most events, many at one time; null items are no events; order by two columns."""
    r = random.Random(blocks)
    rows = [(0, r.choice([None, 7, 7, r.randrange(40)]), i, r.choice("abc")) for i in range(3000)]
    for user in range(1, 25):
        rows += [(user, r.randrange(5), 10_000 * user + t, r.choice(["a", "b", "c", "d", None])) for t in range(r.randint(0, 8))]
    ev = spark.createDataFrame(rows, "user long, ts long, id long, kind string")
    by_user = {}
    for user, ts, i, kind in rows:
        by_user.setdefault(user, []).append((ts is not None, ts or 0, i, kind))
    lists = [[x[3] for x in sorted(v, key=lambda x: x[:3]) if x[3]] for v in by_user.values()]
    least = math.ceil(0.3 * len(lists))

    def holds(w, p):
        it = iter(w)
        return all(x in it for x in p)

    want, level = {}, [(x,) for x in "abcd"]
    while level:
        level = [p for p in level if sum(holds(w, p) for w in lists) >= least]
        want |= {p: sum(holds(w, p) for w in lists) for p in level}
        level = [p + (x,) for p in level for x in "abcd"]
    got = sequential_patterns(ev, "user", ["ts", "id"], "kind", 0.3, blocks=blocks)
    assert {tuple(x["pattern"]): x["freq"] for x in got.collect()} == want and max(map(len, want)) >= 2


def test_kmeans_sizes_sum(spark):
    rows = QUERIES["kmeans_centers"](spark, SF_SMALL).collect()
    sizes = {r["cluster"]: r["size"] for r in rows}
    assert len(rows) == 64 * len(sizes) and sum(sizes.values()) == table(spark, SF_SMALL, "embeddings").count()


def test_isotonic_monotone(spark):
    rows = sorted(QUERIES["ml_isotonic"](spark, SF_SMALL).collect(), key=lambda r: r["boundary"])
    preds = [r["prediction"] for r in rows]
    assert preds == sorted(preds)


def test_model_roundtrip_equal(spark):
    r = QUERIES["model_roundtrip"](spark, SF_SMALL).first()
    assert r["n"] == r["n_equal"] == table(spark, SF_SMALL, "part").count()


def test_rf_confusion_totals_test_rows(spark):
    from tessera.operators.sampling import hash_split

    rows = QUERIES["rf_confusion"](spark, SF_SMALL).collect()
    e = table(spark, SF_SMALL, "embeddings")
    n_test = hash_split(e, ["vec_id"], {"training": 0.75, "test": 0.25}, 1099).filter("split = 'test'").count()
    assert sum(r["n"] for r in rows) == n_test


def test_ks_statistic_by_window_ecdf(spark):
    r = QUERIES["ks_test"](spark, SF_SMALL).first()
    ev = table(spark, SF_SMALL, "events").select("value")
    n = ev.count()
    w = Window.orderBy("value")
    mu, sd = r["mean"], r["sd"]
    cdf = F.udf(lambda v: 0.5 * math.erfc(-(v - mu) / (sd * math.sqrt(2))), "double")
    d = (ev.withColumn("i", F.row_number().over(w)).withColumn("c", cdf("value"))
         .agg(F.max(F.greatest(F.col("i") / n - F.col("c"), F.col("c") - (F.col("i") - 1) / n))).first()[0])
    assert r["statistic"] == pytest.approx(d, rel=1e-9)


def test_glm_confusion_covers_rows(spark):
    rows = QUERIES["glm_confusion"](spark, SF_SMALL).collect()
    n = table(spark, SF_SMALL, "customer").filter("c_mktsegment in ('AUTOMOBILE', 'BUILDING')").count()
    assert sum(r["n"] for r in rows) == n


def test_model_fits_after_survival_queries(spark):
    """MLlib models that keep a training summary must stay serialisable after the
    survival operators ran in the same session (no observed-metrics state)."""
    from tessera.plans.fixtures import lineitem_trial
    from tessera.operators import survival as sv

    sv.event_table_and_plan(lineitem_trial(spark, SF_SMALL), "grp", "arm", ("A", "R"))
    assert len(QUERIES["ml_fm_classifier"](spark, SF_SMALL).collect()) > 0


def test_lda_words_of_any_script(spark):
    from tessera.plans.ml_q import lda_words

    df = spark.createDataFrame([(1, "Größe über niño año, the THE x2", "en"), (2, "der Größe und", "de"), (3, None, "fr"),
                                (4, "the der und", None)], "doc_id int, text string, lang string")
    got = {r["doc_id"]: list(r["words"]) for r in lda_words(df).collect()}
    assert got == {1: ["größe", "über", "niño", "año", "x2"], 2: ["größe"], 3: [], 4: ["the", "der", "und"]}


def test_lda_names_every_topic(spark):
    rows = QUERIES["ml_lda"](spark, SF_SMALL).collect()
    assert len(rows) == 5 * 8 and all(r["term"] for r in rows)


def test_lda_every_word_is_a_feature_of_its_own(spark):
    from tessera.plans.ml_q import lda_vocabulary

    words = [f"word{i}" for i in range(20_000)]  # more than the 16,384 buckets of old
    counts = spark.createDataFrame([(i % 7, w) for i, w in enumerate(words)] + [(8, "word1")], "doc_id int, word string")
    for part_words in (50_000, 900):
        vocabulary, n = lda_vocabulary(counts, part_words)
        rows = vocabulary.collect()
        assert n == len(words) and sorted(r["index"] for r in rows) == list(range(n))
        assert {r["word"] for r in rows} == set(words)


def test_predictions_cover_every_row(spark):
    n = table(spark, SF_SMALL, "embeddings").count()
    for name in ("kmeans_assignments", "ml_logit_predict", "ml_svm_predict", "ml_tree_predict", "ml_gbt_predict", "ml_mlp_predict",
                 "ml_fm_predict", "ml_gmm_assignments", "ml_bisecting_assignments"):
        rows = QUERIES[name](spark, SF_SMALL).collect()
        assert len({r["vec_id"] for r in rows}) == len(rows) == n, name


def test_kmeans_assigns_the_nearest_centre(spark):
    centres = {}
    for r in QUERIES["kmeans_centers"](spark, SF_SMALL).collect():
        centres.setdefault(r["cluster"], {})[r["feature"]] = r["value"]
    got = {r["vec_id"]: r["cluster"] for r in QUERIES["kmeans_assignments"](spark, SF_SMALL).collect()}
    for r in table(spark, SF_SMALL, "embeddings").limit(100).collect():
        d = {c: sum((x - v[i]) ** 2 for i, x in enumerate(r["embedding"])) for c, v in centres.items()}
        assert d[got[r["vec_id"]]] == pytest.approx(min(d.values()))


def test_wide_table_keeps_every_row(spark):
    from tessera.operators.aggregate import bucketed_mean_curve, contingency_wide

    df = spark.createDataFrame([("a", "x"), ("a", "z"), ("a", None), ("b", "z")], "r string, c string")
    got = {r["r"]: r.asDict() for r in contingency_wide(df, "r", "c", ["x", "y"]).collect()}
    assert got == {"a": {"r": "a", "x": 1, "y": 0, "other": 2}, "b": {"r": "b", "x": 0, "y": 0, "other": 1}}
    xy = spark.createDataFrame([(x / 2, 1.0) for x in range(20)], "x double, y double")
    curve = bucketed_mean_curve(xy, "x", "y", 4, 1.5, 7.25).collect()
    assert {r["bin"] for r in curve} == {0, 1, 2, 3} and sum(r["n"] for r in curve) == 12


def test_scratch_is_refused_off_a_local_master(spark):
    import subprocess
    import sys

    from conftest import ROOT

    code = """
import sys; sys.path.insert(0, %r)
from tessera import session
class Fake:
    class sparkContext:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)
    class conf:
        get = staticmethod(lambda k, d=None: d)
try:
    session.checkpoint_root(Fake)
except RuntimeError as e:
    print("refused", "spark.checkpoint.dir" in str(e))
Fake.sparkContext.master = "local[2]"
kept = []
Fake.sparkContext.setCheckpointDir = staticmethod(kept.append)
session.checkpoint_root(Fake)
import os; print(os.path.isdir(kept[0]), kept[0])
""" % ROOT
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120).stdout.split("\n")
    assert out[0] == "refused True"
    there, path = out[1].split()
    assert there == "True" and not __import__("os").path.exists(path)  # gone with its process


@pytest.mark.parametrize("name", ["rf_predict", "kmeans_assignments", "ml_mlp_predict"])
def test_fits_do_not_depend_on_how_rows_are_dealt(spark, name):
    """The same rows at other file splits and shuffle partitions; nothing stays stored."""
    keys = {"spark.sql.shuffle.partitions": ("8", "3"), "spark.sql.files.maxPartitionBytes": ("128m", "8k")}
    got = []
    for i in range(2):
        for key, values in keys.items():
            spark.conf.set(key, values[i])
        try:
            got.append(sorted(tuple(r) for r in QUERIES[name](spark, SF_SMALL).collect()))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got[0] == got[1] and got[0]
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0


def test_partitions_of_a_fit_follow_the_bytes(spark):
    from tessera.operators import ml

    df = spark.range(1000).repartition(7)
    assert ml.dealt_by_key(df, "id", F.lit(8), part_bytes=1000).rdd.getNumPartitions() == 8
    assert ml.dealt_by_key(df.limit(0), "id", F.lit(8)).rdd.getNumPartitions() <= 1


@pytest.mark.parametrize("name,column", [("ml_glm_poisson", "l_linenumber"), ("ml_glm_gamma", "l_extendedprice")])
def test_two_group_fits_pass_over_different_rows_only(spark, monkeypatch, name, column):
    """Equal rows reach the fit as one row, whose weight is their number."""
    from tessera.operators import ml

    seen, fit = [], ml.fit_persisted

    def watched(estimator, df):
        seen.append((df.count(), df.agg(F.sum("n")).first()[0]))
        return fit(estimator, df)

    monkeypatch.setattr(ml, "fit_persisted", watched)
    QUERIES[name](spark, SF_SMALL)
    li = table(spark, SF_SMALL, "lineitem")
    different = li.select(column, F.col("l_returnflag") == "R").distinct().count()
    assert seen == [(different, li.count())]


@pytest.mark.parametrize("long_from", [12, 10_000])
def test_grown_patterns_travel_by_place_not_by_pattern(spark, monkeypatch, long_from):
    """Cut and whole sequences give the same patterns; a level has at most one row an event, however many patterns end there."""
    from tessera.operators import patterns as P

    r = random.Random(4)
    rows = [(s, i // 2 if s % 3 else i, i, r.choice("abc")) for s in range(30) for i in range(14 if s % 5 else 10)]
    levels, write = [], P.materialize

    def watched(df):
        out = write(df)
        if out.columns == ["s", "pos", "ids"]:
            levels.append((out.count(), out.select(F.explode("ids")).count()))
        return out

    monkeypatch.setattr(P, "materialize", watched)
    df = spark.createDataFrame(rows, "s int, t int, e int, item string").repartition(3)
    got = {tuple(x["pattern"]): x["freq"] for x in sequential_patterns(df, "s", ["t", "e"], "item", 0.7, 4, long_from).collect()}
    want, level = {}, [()]
    texts = ["".join(x[3] for x in sorted((x for x in rows if x[0] == s), key=lambda x: x[1:3])) for s in range(30)]

    def holds(text, pattern):
        at = -1
        for item in pattern:
            at = text.find(item, at + 1)
            if at < 0:
                return False
        return True

    while level:
        held = {(*p, x): sum(holds(t, (*p, x)) for t in texts) for p in level for x in "abc"}
        held = {p: n for p, n in held.items() if n >= 21}
        want.update(held)
        level = list(held)
    assert got == want and max(map(len, want)) >= 3
    assert levels and all(n <= len(rows) for n, _ in levels) and max(n for _, n in levels) > len(rows)


def test_events_without_a_sequence_make_single_items_only(spark):
    rows = [(s, t, x) for s in (1, 2, 3, 4, None) for t, x in enumerate("ab")]
    df = spark.createDataFrame(rows, "s int, t int, item string")
    got = {tuple(x["pattern"]): x["freq"] for x in sequential_patterns(df, "s", ["t"], "item", 0.5).collect()}
    assert got == {("a",): 5, ("b",): 5, ("a", "b"): 4}


def test_als_blocks_follow_the_ratings(spark, monkeypatch):
    """A block, which one task holds, keeps its size as ratings grow; scoring in slices gives the same rows."""
    from tessera.plans import ml_q as M

    assert M.als_blocks(0) == M.als_blocks(30_000_000) == 10 and M.als_blocks(212_000_000) == 71
    made, als = [], M.ALS

    def kept(**given):
        made.append(given)
        return als(**given)

    monkeypatch.setattr(M, "ALS", kept)
    monkeypatch.setattr(M, "ALS_BLOCK_RATINGS", 400)
    one = {(r[0], r[1]): r[2:] for r in QUERIES["ml_als"](spark, SF_SMALL).collect()}
    assert made[0]["numUserBlocks"] == made[0]["numItemBlocks"] == -(-len(one) // 400) > 10
    monkeypatch.setattr(M, "ALS_SLICE_RATINGS", 2000)
    two = {(r[0], r[1]): r[2:] for r in QUERIES["ml_als"](spark, SF_SMALL).collect()}
    assert len(one) > 4000 and set(one) == set(two)
    for key, (rating, score) in one.items():
        assert two[key][0] == rating and two[key][1] == pytest.approx(score, rel=1e-3, abs=1e-3)
