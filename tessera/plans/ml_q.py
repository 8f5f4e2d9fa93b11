"""MLlib queries. Seeds are fixed and seeded fits deal their rows by key, so fits are
repeatable. Model-parameter tables are built on the driver (bounded by the
number of terms); predictions and evaluation stay distributed."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, FMClassifier, GBTClassifier, LinearSVC,
                                       LogisticRegression, MultilayerPerceptronClassifier, NaiveBayes,
                                       RandomForestClassifier)
from pyspark.ml.clustering import BisectingKMeans, GaussianMixture, KMeans, PowerIterationClustering
from pyspark.ml.feature import StopWordsRemover, StringIndexer
from pyspark.ml.fpm import FPGrowth
from pyspark.ml.functions import vector_to_array
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.ml.regression import (DecisionTreeRegressor, FMRegressor, GBTRegressor, GeneralizedLinearRegression,
                                   LinearRegression, RandomForestRegressor)
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from tessera.functions.scalar import no_negative_zero
from tessera.operators import ml
from tessera.operators.lda import fit_lda, lda_vocabulary  # noqa: F401 (the numbering of its words)
from tessera.operators.patterns import sequential_pairs, sequential_patterns
from tessera.operators.power import shared_event_clusters, shared_event_sql
from tessera.operators.sampling import hash_split
from tessera.plans.registry import query
from tessera.session import materialize, release, scratch_path
from tessera.sources.tables import table

# fixed values: seeds and sizes of the fits
SEED = 1099
FP_MIN_SUPPORT = 0.01
FP_MIN_CONFIDENCE = 0.5
SEQ_MIN_SUPPORT = 0.1
GROWN_MIN_SUPPORT = 0.06


def _emb(spark, sf) -> DataFrame:
    """Whole vectors, dealt and ordered by key so that seeds act alike however the files are cut."""
    e = ml.dealt_by_key(table(spark, sf, "embeddings"), "vec_id", 8 * F.size("embedding"))
    return ml.embedding_vectors(e).select("vec_id", F.col("label").cast("double").alias("label"), "features")


def _binary_emb(spark, sf) -> DataFrame:
    return _emb(spark, sf).withColumn("label", (F.col("label") < 5).cast("double"))


def _coef_table(spark, names, coefs, intercept=None):
    return ml.tidy_terms(spark, names, {"estimate": list(coefs)},
                         None if intercept is None else {"estimate": intercept})


def _vector_names(df: DataFrame, col: str = "features") -> list[str]:
    meta = df.schema[col].metadata.get("ml_attr", {})
    attrs = meta.get("attrs", {})
    pairs = [(a["idx"], a.get("name", f"f{a['idx']}")) for group in attrs.values() for a in group]
    n = meta.get("num_attrs", len(pairs))
    names = dict(pairs)
    return [names.get(i, f"f{i}") for i in range(n)]


# ---------------------------------------------------------------- formula, GLM

@query("formula_features", """
SELECT l_orderkey, l_linenumber, round(l_extendedprice, 6) AS label, round(l_quantity, 6) AS f0,
       round(l_discount, 6) + 0.0 AS f1, round(l_quantity * l_discount, 6) + 0.0 AS f2 FROM lineitem
""")
def formula_features(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity",
                                             no_negative_zero("l_discount").alias("l_discount"))
    fitted = ml.formula_pipeline("l_extendedprice ~ l_quantity + l_discount + l_quantity:l_discount").fit(li)
    out = ml.features_as_columns(fitted.transform(li).select("l_orderkey", "l_linenumber", "label", "features"),
                                 n=3)
    return out.select("l_orderkey", "l_linenumber", *[(F.round(c, 6) + 0.0).alias(c)
                                                       for c in ("label", "f0", "f1", "f2")])


# ---------------------------------------------------------------- clustering

def _kmeans(spark, sf):
    df = _emb(spark, sf)
    model = ml.fit_persisted(KMeans(k=3, seed=1, maxIter=50), df)
    return df, model


@query("kmeans_centers")
def kmeans_centers(spark, sf):
    """Cluster centres over all features (one row per cluster and feature), with cluster sizes."""
    df, model = _kmeans(spark, sf)
    rows = [(i, j, float(v)) for i, c in enumerate(model.clusterCenters()) for j, v in enumerate(c)]
    centres = spark.createDataFrame(rows, "cluster int, feature int, value double")
    sizes = ml.cluster_sizes(model.transform(df)).withColumnRenamed("prediction", "cluster")
    return centres.join(sizes, "cluster", "left")


@query("kmeans_assignments")
def kmeans_assignments(spark, sf):
    """The cluster of every row."""
    df, model = _kmeans(spark, sf)
    return model.transform(df).select("vec_id", F.col("prediction").alias("cluster"))


@query("kmeans_contingency")
def kmeans_contingency(spark, sf):
    df, model = _kmeans(spark, sf)
    return ml.confusion(model.transform(df), "label")


@query("ml_bisecting_kmeans")
def ml_bisecting_kmeans(spark, sf):
    df = _emb(spark, sf)
    model = ml.fit_persisted(BisectingKMeans(k=3, seed=2, maxIter=20), df)
    return ml.cluster_sizes(model.transform(df)).withColumnRenamed("prediction", "cluster")


@query("ml_gmm")
def ml_gmm(spark, sf):
    """Gaussian mixture over all features: weight and mean per component and feature."""
    df = _emb(spark, sf)
    model = ml.fit_persisted(GaussianMixture(k=3, seed=3, maxIter=50), df)
    g = model.gaussiansDF.collect()  # k rows
    rows = [(i, float(w), j, float(v)) for i, w in enumerate(model.weights) for j, v in enumerate(g[i]["mean"])]
    return spark.createDataFrame(rows, "component int, weight double, feature int, mean double")


# fixed values: language codes and the stop-word lists' names
STOP_WORDS = {"en": "english", "de": "german", "es": "spanish", "fr": "french"}
LDA_TOPICS, LDA_PASSES = 5, 10
LDA_BLOCK_BYTES, LDA_LEAST_BYTES = 12 << 20, 1 << 20  # text of a block, at most and at least


def lda_words(docs: DataFrame) -> DataFrame:
    """``docs`` with ``words``: the letters-and-digits words of any script, without the language's stop words."""
    def without(name: str):
        return lambda w: ~w.isin(StopWordsRemover.loadDefaultStopWords(name))

    out = docs.withColumn("words", F.filter(F.split(F.lower(F.coalesce("text", F.lit(""))), "(?U)\\W+"), lambda w: w != ""))
    kept = F.col("words")
    for lang, name in STOP_WORDS.items():
        kept = F.when(F.col("lang") == lang, F.filter("words", without(name))).otherwise(kept)
    return out.withColumn("words", kept)


@query("ml_lda")
def ml_lda(spark, sf):
    """Topics of the whole document texts: top 8 terms per topic (a top-k report).

    Every word is a feature of its own and every pass sees every document; the
    weights of words and topics are a distributed table. Rows without a doc_id are
    documents by their text.
    """
    docs = table(spark, sf, "documents").select(F.coalesce("doc_id", F.xxhash64("text")).alias("doc"), "text", "lang")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # blocks of bounded size, more than cores where that leaves them enough to do
    n_blocks = max(1, -(-size // LDA_BLOCK_BYTES), min(2 * spark.sparkContext.defaultParallelism, size // LDA_LEAST_BYTES))
    words = lda_words(docs.repartition(n_blocks, "doc")).select("doc", F.col("words").alias("word"))
    top = fit_lda(words, LDA_TOPICS, LDA_PASSES, seed=7, dealt=True, draw_by="index").top_terms(8)
    return top.select("topic", "rank", F.col("word").alias("term"), "weight")


@query("ml_pic")
def ml_pic(spark, sf):
    """Power iteration clustering of the supplier-part graph (weight = quantity).

    Suppliers get even node ids, parts odd ones. Edges are one per
    (supplier, part) pair that actually traded: no pairs are enumerated.
    """
    li = table(spark, sf, "lineitem")
    edges = (li.groupBy("l_suppkey", "l_partkey").agg(F.sum("l_quantity").alias("weight"))
             .select((F.col("l_suppkey") * 2).alias("src"), (F.col("l_partkey") * 2 + 1).alias("dst"), "weight"))
    pic = PowerIterationClustering(k=3, maxIter=20, weightCol="weight", initMode="degree")
    out = pic.assignClusters(edges)
    return out.select(F.when(F.col("id") % 2 == 0, F.lit("supplier")).otherwise(F.lit("part")).alias("node"),
                      F.floor(F.col("id") / 2).cast("bigint").alias("key"), "cluster")


@query("ml_pic_suppliers", oracle=f"""
WITH {shared_event_sql("SELECT DISTINCT l_suppkey AS member, l_orderkey AS event FROM lineitem "
                       "WHERE l_suppkey IS NOT NULL AND l_orderkey IS NOT NULL")}
SELECT member AS l_suppkey, n_events AS n_orders, degree, round(v * (SELECT count(*) FROM base), 6) AS "position", cluster
FROM placed""")
def ml_pic_suppliers(spark, sf):
    """Power iteration clustering of suppliers linked by shared orders, without listing pairs of suppliers."""
    found = shared_event_clusters(table(spark, sf, "lineitem"), "l_suppkey", "l_orderkey")
    return found.select("l_suppkey", F.col("n_events").alias("n_orders"), "degree",
                        F.round("position", 6).alias("position"), "cluster")


# ---------------------------------------------------------------- regression

LINREG_SQL = """
WITH f AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a
           FROM lineitem)
SELECT round(max(b), 4) AS slope, round(max(a), 4) AS intercept,
       round(avg((l_extendedprice - (a + b * l_quantity)) * (l_extendedprice - (a + b * l_quantity))), 0) AS mse
FROM lineitem, f
"""


@query("linreg_fit", LINREG_SQL)
def linreg_fit(spark, sf):
    """Least squares with intercept (normal equations, one pass); slope, intercept, mse."""
    li = table(spark, sf, "lineitem").select("l_extendedprice", "l_quantity")
    model = ml.formula_pipeline("l_extendedprice ~ l_quantity",
                                LinearRegression(solver="normal", regParam=0.0, fitIntercept=True)).fit(li)
    lr = model.stages[-1]
    row = [(round(float(lr.coefficients[0]), 4), round(float(lr.intercept), 4),
            round(float(lr.summary.meanSquaredError), 0))]
    return spark.createDataFrame(row, "slope double, intercept double, mse double")


@query("ml_glm_gaussian", """
SELECT round(regr_slope(l_extendedprice, l_quantity), 4) AS slope,
       round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept FROM lineitem
""")
def ml_glm_gaussian(spark, sf):
    li = table(spark, sf, "lineitem").select("l_extendedprice", "l_quantity")
    model = ml.formula_pipeline("l_extendedprice ~ l_quantity",
                                GeneralizedLinearRegression(family="gaussian", link="identity")).fit(li)
    g = model.stages[-1]
    return spark.createDataFrame([(round(float(g.coefficients[0]), 4), round(float(g.intercept), 4))],
                                 "slope double, intercept double")


def _part_xy(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_size", F.col("p_retailprice").alias("label"))
    return ml.assemble(p, ["p_size"])


@query("ml_fm_regressor")
def ml_fm_regressor(spark, sf):
    df = _part_xy(spark, sf)
    model = FMRegressor(factorSize=4, maxIter=50, seed=5, stepSize=0.01).fit(df)
    pred = model.transform(df)
    return pred.agg(F.sqrt(F.avg(F.pow(F.col("label") - F.col("prediction"), 2))).alias("rmse"),
                    F.count(F.lit(1)).alias("n"))


@query("ml_tree")
def ml_tree(spark, sf):
    """Decision trees: regression (part price by size) and classification (embedding labels)."""
    reg = DecisionTreeRegressor(maxDepth=5, seed=9).fit(_part_xy(spark, sf))
    cls = ml.fit_persisted(DecisionTreeClassifier(maxDepth=5, seed=9), _emb(spark, sf))
    return ml.metrics_table(spark, [("regressor", "depth", reg.depth), ("regressor", "nodes", reg.numNodes),
                                    ("classifier", "depth", cls.depth), ("classifier", "nodes", cls.numNodes),
                                    ("classifier", "classes", cls.numClasses)])


@query("ml_gbt")
def ml_gbt(spark, sf):
    cls_df = _binary_emb(spark, sf)
    cls = ml.fit_persisted(GBTClassifier(maxIter=20, maxDepth=3, seed=10), cls_df)
    acc = cls.transform(cls_df).agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0]
    reg_df = _part_xy(spark, sf)
    reg = GBTRegressor(maxIter=20, maxDepth=3, seed=10).fit(reg_df)
    rmse = reg.transform(reg_df).agg(F.sqrt(F.avg(F.pow(F.col("label") - F.col("prediction"), 2)))).first()[0]
    return ml.metrics_table(spark, [("classifier", "train_accuracy", acc), ("classifier", "trees", cls.getNumTrees),
                                    ("regressor", "train_rmse", rmse), ("regressor", "trees", reg.getNumTrees)])


@query("ml_rf_regressor")
def ml_rf_regressor(spark, sf):
    df = _part_xy(spark, sf)
    model = RandomForestRegressor(numTrees=20, maxDepth=5, seed=11).fit(df)
    pred = model.transform(df)
    return pred.agg(F.sqrt(F.avg(F.pow(F.col("label") - F.col("prediction"), 2))).alias("rmse"),
                    F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- classification

def _rf_split(spark, sf):
    df = _emb(spark, sf).withColumn("label_text", F.col("label").cast("int").cast("string"))
    return hash_split(df, ["vec_id"], {"training": 0.75, "test": 0.25}, seed=SEED)


def _rf_model(spark, sf) -> tuple[PipelineModel, DataFrame]:
    """The label index is fitted once, on training rows, inside the pipeline."""
    data = _rf_split(spark, sf)
    idx = StringIndexer(inputCol="label_text", outputCol="label_idx")
    rf = RandomForestClassifier(labelCol="label_idx", featuresCol="features", numTrees=20, maxDepth=5, seed=SEED)
    return ml.fit_persisted(Pipeline(stages=[idx, rf]), data.filter(F.col("split") == "training")), data


@query("rf_confusion")
def rf_confusion(spark, sf):
    """Random forest (20 trees) on all features; held-out label-by-prediction table."""
    model, data = _rf_model(spark, sf)
    pred = model.transform(data.filter(F.col("split") == "test"))
    return pred.groupBy("label_text", "label_idx", "prediction").agg(F.count(F.lit(1)).alias("n"))


@query("string_index", """
SELECT c_mktsegment, CAST(row_number() OVER (ORDER BY count(*) DESC, c_mktsegment) - 1 AS DOUBLE) AS idx,
       count(*) AS n FROM customer GROUP BY c_mktsegment
""")
def string_index(spark, sf):
    c = table(spark, sf, "customer").select("c_mktsegment")
    return ml.string_index(c, "c_mktsegment", "idx").groupBy("c_mktsegment", "idx").agg(
        F.count(F.lit(1)).alias("n"))


@query("ml_logit")
def ml_logit(spark, sf):
    m = ml.fit_persisted(LogisticRegression(maxIter=100, regParam=0.01), _binary_emb(spark, sf))
    return _coef_table(spark, [f"e{i}" for i in range(len(m.coefficients))], m.coefficients, m.intercept)


@query("ml_svm")
def ml_svm(spark, sf):
    m = ml.fit_persisted(LinearSVC(maxIter=50, regParam=0.01), _binary_emb(spark, sf))
    return _coef_table(spark, [f"e{i}" for i in range(len(m.coefficients))], m.coefficients, m.intercept)


def _scored(pred: DataFrame, key: str = "vec_id") -> DataFrame:
    return pred.select(key, F.col("label").cast("int").alias("label"), F.col("prediction").cast("int").alias("prediction"))


@query("ml_logit_predict")
def ml_logit_predict(spark, sf):
    """The predicted class of every row."""
    df = _binary_emb(spark, sf)
    return _scored(ml.fit_persisted(LogisticRegression(maxIter=100, regParam=0.01), df).transform(df))


@query("ml_svm_predict")
def ml_svm_predict(spark, sf):
    df = _binary_emb(spark, sf)
    return _scored(ml.fit_persisted(LinearSVC(maxIter=50, regParam=0.01), df).transform(df))


@query("ml_gbt_predict")
def ml_gbt_predict(spark, sf):
    """Boosted trees: the predicted class of every vector."""
    df = _binary_emb(spark, sf)
    return _scored(ml.fit_persisted(GBTClassifier(maxIter=20, maxDepth=3, seed=10), df).transform(df))


@query("ml_mlp_predict")
def ml_mlp_predict(spark, sf):
    """Multilayer perceptron: the predicted label of every vector."""
    df = _emb(spark, sf)
    mlp = MultilayerPerceptronClassifier(layers=[64, 16, 10], maxIter=100, seed=13, blockSize=128)
    return _scored(ml.fit_persisted(mlp, df).transform(df))


@query("ml_fm_predict")
def ml_fm_predict(spark, sf):
    """Factorization machine: the predicted class of every vector."""
    df = _binary_emb(spark, sf)
    return _scored(ml.fit_persisted(FMClassifier(factorSize=4, maxIter=50, seed=14, stepSize=0.01), df).transform(df))


@query("ml_gmm_assignments")
def ml_gmm_assignments(spark, sf):
    """Gaussian mixture: the likeliest component of every vector and its probability."""
    df = _emb(spark, sf)
    model = ml.fit_persisted(GaussianMixture(k=3, seed=3, maxIter=50), df)
    return model.transform(df).select("vec_id", F.col("prediction").alias("component"),
                                      F.array_max(vector_to_array("probability")).alias("probability"))


@query("ml_bisecting_assignments")
def ml_bisecting_assignments(spark, sf):
    """Bisecting k-means: the cluster of every vector."""
    df = _emb(spark, sf)
    model = ml.fit_persisted(BisectingKMeans(k=3, seed=2, maxIter=20), df)
    return model.transform(df).select("vec_id", F.col("prediction").alias("cluster"))


@query("rf_predict")
def rf_predict(spark, sf):
    """Random forest: label and predicted label of every held-out vector."""
    model, data = _rf_model(spark, sf)
    pred = model.transform(data.filter(F.col("split") == "test"))
    named = F.element_at(F.array(*map(F.lit, model.stages[0].labels)), (F.col("prediction") + 1).cast("int"))
    return pred.select("vec_id", "label_text", named.alias("predicted_text"))


@query("ml_fm_regressor_predict")
def ml_fm_regressor_predict(spark, sf):
    """Factorization machine: the predicted price of every part."""
    df = _part_xy(spark, sf)
    model = FMRegressor(factorSize=4, maxIter=50, seed=5, stepSize=0.01).fit(df)
    return model.transform(df).select("p_partkey", "label", "prediction")


@query("ml_rf_regressor_predict")
def ml_rf_regressor_predict(spark, sf):
    """Random forest: the predicted price of every part."""
    df = _part_xy(spark, sf)
    model = RandomForestRegressor(numTrees=20, maxDepth=5, seed=11).fit(df)
    return model.transform(df).select("p_partkey", "label", "prediction")


@query("ml_tree_predict")
def ml_tree_predict(spark, sf):
    """Decision tree: the predicted label of every vector."""
    df = _emb(spark, sf)
    return _scored(ml.fit_persisted(DecisionTreeClassifier(maxDepth=5, seed=9), df).transform(df))


@query("ml_mlp")
def ml_mlp(spark, sf):
    df = _emb(spark, sf)
    m = ml.fit_persisted(MultilayerPerceptronClassifier(layers=[64, 16, 10], maxIter=100, seed=13, blockSize=128), df)
    return ml.confusion(m.transform(df), "label")


@query("ml_fm_classifier")
def ml_fm_classifier(spark, sf):
    df = _binary_emb(spark, sf)
    m = ml.fit_persisted(FMClassifier(factorSize=4, maxIter=50, seed=14, stepSize=0.01), df)
    return ml.confusion(m.transform(df), "label")


NB_SQL = """
WITH s AS (SELECT l_returnflag, count(*) AS nc, sum(l_quantity) AS s0, sum(l_discount) AS s1, sum(l_tax) AS s2
           FROM lineitem GROUP BY 1),
t AS (SELECT sum(nc) AS n, count(*) AS k FROM s)
SELECT l_returnflag, 'prior' AS term, round(ln(nc + 1) - ln(n + k), 9) AS value FROM s, t
UNION ALL SELECT l_returnflag, 'l_quantity', round(ln(s0 + 1) - ln(s0 + s1 + s2 + 3), 9) FROM s
UNION ALL SELECT l_returnflag, 'l_discount', round(ln(s1 + 1) - ln(s0 + s1 + s2 + 3), 9) FROM s
UNION ALL SELECT l_returnflag, 'l_tax', round(ln(s2 + 1) - ln(s0 + s1 + s2 + 3), 9) FROM s
"""


NB_FEATURES = ["l_quantity", "l_discount", "l_tax"]


def _naive_bayes(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", *NB_FEATURES)
    df, labels = ml.indexed_labels(ml.assemble(li, NB_FEATURES), "l_returnflag")
    return df, labels, NaiveBayes(smoothing=1.0, modelType="multinomial").fit(df)


@query("ml_naive_bayes", NB_SQL)
def ml_naive_bayes(spark, sf):
    """Multinomial naive Bayes (smoothing 1): log priors and log term probabilities per class."""
    _, labels, m = _naive_bayes(spark, sf)
    theta = m.theta.toArray()
    rows = []
    for c, name in enumerate(labels):
        rows.append((name, "prior", round(float(m.pi[c]), 9)))
        for j, f in enumerate(NB_FEATURES):
            rows.append((name, f, round(float(theta[c][j]), 9)))
    return spark.createDataFrame(rows, "l_returnflag string, term string, value double")


@query("ml_naive_bayes_predict", """
WITH s AS (SELECT l_returnflag AS flag, count(*) AS nc, sum(l_quantity) AS s0, sum(l_discount) AS s1, sum(l_tax) AS s2
           FROM lineitem GROUP BY 1),
m AS (SELECT flag, ln((nc + 1) / (sum(nc) OVER () + count(*) OVER ())) AS p, ln((s0 + 1) / (s0 + s1 + s2 + 3)) AS t0,
             ln((s1 + 1) / (s0 + s1 + s2 + 3)) AS t1, ln((s2 + 1) / (s0 + s1 + s2 + 3)) AS t2 FROM s)
SELECT l_returnflag, predicted, count(*) AS n, sum(l_quantity) AS quantity FROM (
  SELECT l_orderkey, l_linenumber, l_returnflag, l_quantity,
         arg_max(flag, p + l_quantity * t0 + l_discount * t1 + l_tax * t2) AS predicted
  FROM (SELECT *, row_number() OVER () AS row FROM lineitem), m
  GROUP BY row, l_orderkey, l_linenumber, l_returnflag, l_quantity)
GROUP BY ALL
""")
def ml_naive_bayes_predict(spark, sf):
    """The predicted flag of every line, counted beside its own, with the lines' quantity."""
    df, labels, m = _naive_bayes(spark, sf)
    named = F.element_at(F.array(*map(F.lit, labels)), (F.col("prediction") + 1).cast("int"))
    return (m.transform(df).groupBy("l_returnflag", named.alias("predicted"))
            .agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity")))


# ---------------------------------------------------------------- recommendation, patterns, tests

ALS_BLOCKS, ALS_BLOCK_RATINGS = 10, 3_000_000  # blocks at least (MLlib's number); ratings of a block
ALS_SLICE_RATINGS = 30_000_000  # ratings scored at once


def als_blocks(ratings: int) -> int:
    """Blocks of users, and of items: a task of a fit holds one of them whole, so their number follows the ratings'."""
    return max(ALS_BLOCKS, -(-ratings // ALS_BLOCK_RATINGS))


def als_scores(model: ALSModel, ratings: DataFrame, slices: int) -> DataFrame:
    """``ratings`` with ``prediction``, slice by slice: the joins carry a user's factors with every rating."""
    if slices == 1:
        return model.transform(ratings)
    out = []
    for i in range(slices):
        own = F.pmod(F.xxhash64("user", "item"), F.lit(slices)) == i
        out.append(materialize(model.transform(ratings.where(own))))
        release(ratings.sparkSession)
    return reduce(DataFrame.unionByName, out)


@query("ml_als")
def ml_als(spark, sf):
    """ALS on customer x part summed quantities: the score of every observed pair beside its rating.

    Pairs are scored as given; customers are not crossed with parts. A step of the fit sends each
    customer's factors to every block of parts that they bought from, and back: a checkpoint a step
    lets the files of the steps before go, the model read back those of the last.
    """
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    summed = (li.join(o, li.l_orderkey == o.o_orderkey)
              .groupBy("o_custkey", "l_partkey").agg(F.sum("l_quantity").alias("rating")))
    summed = materialize(summed)
    # ALS needs int ids: keys are used as they are when they fit (one min/max
    # check), otherwise replaced by dense indexes and mapped back afterwards
    users = ml.int_ids(summed, "o_custkey", "user")
    items = ml.int_ids(summed, "l_partkey", "item")
    ratings = users.attach(items.attach(summed)).select("user", "item", "rating")
    n = summed.count()
    blocks = als_blocks(n)
    als = ALS(userCol="user", itemCol="item", ratingCol="rating", rank=8, maxIter=5, regParam=0.1, seed=SEED,
              coldStartStrategy="drop", numUserBlocks=blocks, numItemBlocks=blocks, checkpointInterval=1)
    path = scratch_path(spark, "model")
    als.fit(ratings).write().save(path)
    release(spark)
    scored = als_scores(ALSModel.load(path), ratings, max(1, -(-n // ALS_SLICE_RATINGS)))
    return (users.detach(items.detach(scored))
            .select(F.col("o_custkey").cast(LongType()), F.col("l_partkey").cast(LongType()), "rating",
                    F.col("prediction").cast("double").alias("score")))


FP_MAX_SQL = 6  # the oracle's joins go as far as there are part types


def _fp_sql() -> str:
    parts = []
    for size in range(1, FP_MAX_SQL + 1):
        x = [f"x{i}" for i in range(size)]
        joins = " ".join(f"JOIN b {v} ON {v}.l_orderkey = x0.l_orderkey AND {u}.p_type < {v}.p_type"
                         for u, v in zip(x, x[1:]))
        names = " || '|' || ".join(f"{v}.p_type" for v in x)
        parts.append(f"SELECT {names} AS items, {size} AS size, count(*) AS freq FROM b x0 {joins} GROUP BY 1")
    return f"""WITH b AS (SELECT DISTINCT l_orderkey, p_type FROM lineitem JOIN part ON l_partkey = p_partkey),
n AS (SELECT count(DISTINCT l_orderkey) AS n FROM b),
s AS ({" UNION ALL ".join(parts)}),
f AS (SELECT * FROM s WHERE freq >= (SELECT ceil(CAST({FP_MIN_SUPPORT} AS DOUBLE) * n) FROM n))
"""


FP_SQL = _fp_sql() + "SELECT items, size, freq FROM f"
RULES_SQL = _fp_sql() + f"""
SELECT antecedent, consequent, round(confidence, 9) AS confidence, round(confidence / (c.freq / n), 9) AS lift,
       round(xy / n, 9) AS support FROM (
  SELECT array_to_string(list_filter(w.parts, lambda p: p <> w.parts[i]), '|') AS antecedent, w.parts[i] AS consequent,
         w.freq AS xy, w.freq / a.freq AS confidence
  FROM (SELECT freq, string_split(items, '|') AS parts, unnest(generate_series(1, size)) AS i FROM f WHERE size > 1) w
  JOIN f a ON a.items = array_to_string(list_filter(w.parts, lambda p: p <> w.parts[i]), '|')) r
JOIN f c ON c.items = r.consequent, n WHERE confidence >= CAST({FP_MIN_CONFIDENCE} AS DOUBLE)
"""


def _fp_model(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey")
    p = table(spark, sf, "part").select("p_partkey", "p_type")
    baskets = (li.join(p, li.l_partkey == p.p_partkey).groupBy("l_orderkey")
               .agg(F.collect_set("p_type").alias("items")))  # a set: bounded by the item vocabulary
    return FPGrowth(itemsCol="items", minSupport=FP_MIN_SUPPORT, minConfidence=FP_MIN_CONFIDENCE).fit(baskets)


@query("fp_itemsets", FP_SQL)
def fp_itemsets(spark, sf):
    """FP-growth over the part types of each order; itemsets of every size."""
    return _fp_model(spark, sf).freqItemsets.select(
        F.array_join(F.array_sort("items"), "|").alias("items"), F.size("items").alias("size"),
        F.col("freq").cast(LongType()).alias("freq"))


@query("fp_rules", RULES_SQL)
def fp_rules(spark, sf):
    """Association rules of those itemsets."""
    return _fp_model(spark, sf).associationRules.select(
        F.array_join(F.array_sort("antecedent"), "|").alias("antecedent"),
        F.array_join("consequent", "|").alias("consequent"),
        *[F.round(c, 9).alias(c) for c in ("confidence", "lift", "support")])


SEQ_SQL = f"""
WITH e AS (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos
           FROM events),
u AS (SELECT user_id, event_type, min(pos) AS first_pos, max(pos) AS last_pos FROM e GROUP BY 1, 2),
n AS (SELECT count(DISTINCT user_id) AS n FROM events),
s AS (SELECT event_type AS item_1, CAST(NULL AS VARCHAR) AS item_2, count(*) AS freq FROM u GROUP BY 1
      UNION ALL
      SELECT a.event_type, b.event_type, count(*) FROM u a JOIN u b
        ON a.user_id = b.user_id AND a.first_pos < b.last_pos GROUP BY 1, 2)
SELECT item_1, item_2, freq FROM s WHERE freq >= (SELECT ceil(CAST({SEQ_MIN_SUPPORT} AS DOUBLE) * n) FROM n)
"""


@query("prefix_span", SEQ_SQL)
def prefix_span(spark, sf):
    """Frequent sequential patterns of length 1 and 2 over each user's whole event history."""
    ev = table(spark, sf, "events").select("user_id", "ts", "event_id", "event_type")
    return sequential_pairs(ev, "user_id", ["ts", "event_id"], "event_type", SEQ_MIN_SUPPORT)


GROWN_SQL = f"""
WITH RECURSIVE e AS (
  SELECT o_custkey AS s, o_orderpriority AS item,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS pos FROM orders),
n AS (SELECT ceil(CAST({GROWN_MIN_SUPPORT} AS DOUBLE) * count(DISTINCT o_custkey)) AS least FROM orders),
g AS (
  SELECT * FROM (SELECT [item] AS pattern, s, min(pos) AS stop FROM e GROUP BY item, s)
  QUALIFY count(*) OVER (PARTITION BY pattern) >= (SELECT least FROM n)
  UNION ALL
  SELECT * FROM (SELECT list_append(g.pattern, e.item) AS pattern, g.s, min(e.pos) AS stop
                 FROM g JOIN e ON e.s = g.s AND e.pos > g.stop GROUP BY 1, 2)
  QUALIFY count(*) OVER (PARTITION BY pattern) >= (SELECT least FROM n))
SELECT array_to_string(pattern, ' > ') AS pattern, CAST(len(pattern) AS INTEGER) AS length, count(*) AS freq
FROM g GROUP BY ALL
"""


@query("sequence_patterns", GROWN_SQL)
def sequence_patterns(spark, sf):
    """Frequent sequences of order priorities, of every length, over each customer's orders by date."""
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_orderpriority")
    found = sequential_patterns(orders, "o_custkey", ["o_orderdate", "o_orderkey"], "o_orderpriority", GROWN_MIN_SUPPORT)
    return found.select(F.array_join("pattern", " > ").alias("pattern"), F.size("pattern").alias("length"), "freq")


@query("model_roundtrip", "SELECT count(*) AS n, count(*) AS n_equal, CAST(0 AS DOUBLE) AS max_abs_diff FROM part")
def model_roundtrip(spark, sf):
    """Save a fitted pipeline to shared storage, load it, and compare predictions."""
    df = table(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice")
    model = ml.formula_pipeline("p_retailprice ~ p_size", LinearRegression(solver="normal")).fit(df)
    path = scratch_path(spark, "model")
    model.write().save(path)
    loaded = PipelineModel.load(path)
    first = model.transform(df).select("p_partkey", "p_size", "p_retailprice", F.col("prediction").alias("p1"))
    both = loaded.transform(first).withColumnRenamed("prediction", "p2")
    return both.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("p1") == F.col("p2")).alias("n_equal"),
                    F.max(F.abs(F.col("p1") - F.col("p2"))).alias("max_abs_diff"))


SAVED_KINDS = ("gbt", "glm", "kmeans", "random_forest")


@query("model_roundtrips", " UNION ALL ".join(
    f"SELECT '{kind}' AS model, count(*) AS n, count(*) AS n_equal FROM embeddings" for kind in SAVED_KINDS))
def model_roundtrips(spark, sf):
    """Save and load a tree ensemble, boosted trees, a k-means and a GLM; rows whose prediction stays the same."""
    rows = _binary_emb(spark, sf)
    fits = {"gbt": GBTClassifier(maxIter=5, maxDepth=3, seed=SEED),
            "glm": GeneralizedLinearRegression(family="gaussian", link="identity", regParam=0.1),
            "kmeans": KMeans(k=4, seed=SEED, maxIter=5),
            "random_forest": RandomForestClassifier(numTrees=5, maxDepth=4, seed=SEED)}
    found = []
    for kind in SAVED_KINDS:
        model = ml.fit_persisted(fits[kind], rows)
        path = scratch_path(spark, kind)
        model.write().save(path)
        first = model.transform(rows).select("vec_id", "features", F.col("prediction").alias("p1"))
        both = type(model).load(path).transform(first)
        found.append(both.agg(F.lit(kind).alias("model"), F.count(F.lit(1)).alias("n"),
                              F.count_if(F.col("p1").eqNullSafe(F.col("prediction"))).alias("n_equal")))
    return reduce(DataFrame.unionByName, found)


@query("linreg_no_intercept", """
SELECT round(sum(l_extendedprice * l_quantity) / sum(l_quantity * l_quantity), 6) AS slope, 0.0::DOUBLE AS intercept
FROM lineitem
""")
def linreg_no_intercept(spark, sf):
    """Least squares through the origin."""
    li = table(spark, sf, "lineitem").select("l_extendedprice", "l_quantity")
    lr = ml.formula_pipeline("l_extendedprice ~ l_quantity - 1",
                             LinearRegression(solver="normal", fitIntercept=False)).fit(li).stages[-1]
    return spark.createDataFrame([(round(float(lr.coefficients[0]), 6), float(lr.intercept))],
                                 "slope double, intercept double")


@query("formula_dot", """
SELECT p_partkey, p_retailprice AS label, CAST(p_size AS DOUBLE) AS f0 FROM part
""")
def formula_dot(spark, sf):
    """All columns but one: ``p_retailprice ~ . - p_partkey``."""
    p = table(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice")
    fitted = ml.formula_pipeline("p_retailprice ~ . - p_partkey").fit(p)
    return ml.features_as_columns(fitted.transform(p).select("p_partkey", "label", "features"), n=1)


def _two_group_glm(spark, sf, label: str, family: str) -> DataFrame:
    """GLM with log link of a lineitem column on the return flag (R or not).

    Equal rows go into the fit as one row with their number as its weight.
    """
    li = table(spark, sf, "lineitem").select(F.col(label).cast("double").alias("label"),
                                             (F.col("l_returnflag") == "R").cast("double").alias("returned"))
    li = ml.counted_rows(li, "n")
    fit = GeneralizedLinearRegression(family=family, link="log", maxIter=50, tol=1e-12, weightCol="n")
    m = ml.fit_persisted(fit, ml.assemble(li, ["returned"]))
    return spark.createDataFrame([(round(float(m.intercept), 6), round(float(m.coefficients[0]), 6))],
                                 "intercept double, returned double")


def _two_group_sql(label: str) -> str:
    """With one 0/1 term and a log link the fitted group means are the group means."""
    return f"""SELECT round(ln(avg({label}) FILTER (WHERE l_returnflag <> 'R')), 6) AS intercept,
       round(ln(avg({label}) FILTER (WHERE l_returnflag = 'R')) - ln(avg({label}) FILTER (WHERE l_returnflag <> 'R')), 6)
         AS returned FROM lineitem"""


@query("ml_glm_poisson", _two_group_sql("l_linenumber"))
def ml_glm_poisson(spark, sf):
    return _two_group_glm(spark, sf, "l_linenumber", "poisson")


@query("ml_glm_gamma", _two_group_sql("l_extendedprice"))
def ml_glm_gamma(spark, sf):
    return _two_group_glm(spark, sf, "l_extendedprice", "gamma")
