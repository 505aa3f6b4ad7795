"""Classifiers and evaluation on long-form binary features or vectors."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.plans.iterate import materialize


def _class_totals(labels: DataFrame) -> dict:
    """Rows per class; the classes of a classifier are a bounded domain."""
    rows = labels.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()
    return {r["label"]: r["n"] for r in sorted(rows, key=lambda r: r["label"])}


def _class_counts(features: DataFrame, labels: DataFrame, vocabulary: DataFrame, totals: dict, key: str) -> DataFrame:
    """``(word, label, n_c, k)`` for every word and class, from one aggregate
    over the features."""
    per = features.join(labels, key).groupBy("word").agg(
        *[F.count(F.when(F.col("label") == c, 1)).alias(f"k{i}") for i, c in enumerate(totals)])
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("label"), F.lit(n).alias("n_c"),
                                         F.coalesce(F.col(f"k{i}"), F.lit(0)).alias("k"))
                                for i, (c, n) in enumerate(totals.items())])).alias("c")
    return vocabulary.select("word").join(per, "word", "left").select("word", cells).select("word", "c.*")


def _with_base(model: DataFrame, at_zero: str, totals: dict) -> DataFrame:
    """Add the class constant: ln prior + the sum of ``at_zero`` over words."""
    n = sum(totals.values())
    prior = F.create_map(*[x for c, k in totals.items() for x in (F.lit(c), F.lit(math.log(k / n)))])
    base = model.groupBy("label").agg(F.sum(at_zero).alias("s0")) \
                .select("label", (prior[F.col("label")] + F.col("s0")).alias("base"))
    return model.join(F.broadcast(base), "label")  # a row per class


def fit_bernoulli_nb(features: DataFrame, labels: DataFrame, vocabulary: DataFrame,
                     key: str = "doc_id", alpha: float = 1.0) -> DataFrame:
    """H7: Bernoulli naive Bayes with Laplace ``alpha`` on features and an
    unsmoothed class prior.

    ``features(doc_id, word)`` long form, ``labels(doc_id, label)``,
    ``vocabulary(word)``. Returns the model as rows ``(label, word, lp1, lp0,
    base)`` with ``base = ln prior + sum_f ln(1 - p_f)`` of the class.
    """
    totals = _class_totals(labels)
    p = (F.col("k") + alpha) / (F.col("n_c") + 2 * alpha)
    model = materialize(_class_counts(features, labels, vocabulary, totals, key)
                        .select("label", "word", F.log(p).alias("lp1"), F.log(1 - p).alias("lp0")))
    return _with_base(model, "lp0", totals)


def predict_bernoulli_nb(model: DataFrame, features: DataFrame, docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """H7: ``(doc_id, pred)``; ties go to the smaller label."""
    delta = model.select("label", "word", (F.col("lp1") - F.col("lp0")).alias("d"))
    base = model.select("label", "base").distinct()
    per = features.join(delta, "word").groupBy(key, "label").agg(F.sum("d").alias("s"))
    scores = (docs.select(key).crossJoin(F.broadcast(base))  # classes: bounded domain
                  .join(per, [key, "label"], "left")
                  .select(key, "label", (F.col("base") + F.coalesce("s", F.lit(0.0))).alias("score")))
    best = scores.groupBy(key).agg(F.max_by("label", F.struct(F.col("score"), -F.col("label"))).alias("pred"))
    return best


def fit_gaussian_nb(features: DataFrame, labels: DataFrame, vocabulary: DataFrame, key: str = "doc_id",
                    var_smoothing: float = 1e-9) -> DataFrame:
    """H8: Gaussian naive Bayes on binary long-form features: per class and
    word mean and population variance, plus ``var_smoothing`` times the
    largest variance over all features. Returns ``(label, word, mu, var,
    base)`` with ``base`` the per-class sum of log densities at x = 0."""
    totals = _class_totals(labels)
    n = sum(totals.values())
    cells = materialize(_class_counts(features, labels, vocabulary, totals, key))
    # smoothing uses the variance of each feature over all training rows
    share = F.sum("k") / n
    eps = cells.groupBy("word").agg((share * (1 - share)).alias("vt")).agg(F.max("vt")).first()[0] or 0.0
    mu = F.col("k") / F.col("n_c")
    st = cells.select("label", "word", mu.alias("mu"), (mu * (1 - mu) + F.lit(var_smoothing * eps)).alias("var"))
    flat = -0.5 * F.log(2 * F.pi() * F.col("var"))
    st = st.select("label", "word", (flat - F.col("mu") ** 2 / (2 * F.col("var"))).alias("l0"),
                   (flat - (1 - F.col("mu")) ** 2 / (2 * F.col("var"))).alias("l1"))
    return _with_base(st, "l0", totals)


def predict_gaussian_nb(model: DataFrame, features: DataFrame, docs: DataFrame, key: str = "doc_id") -> DataFrame:
    delta = model.select("label", "word", (F.col("l1") - F.col("l0")).alias("d"))
    base = model.select("label", "base").distinct()
    per = features.join(delta, "word").groupBy(key, "label").agg(F.sum("d").alias("s"))
    scores = (docs.select(key).crossJoin(F.broadcast(base))
                  .join(per, [key, "label"], "left")
                  .select(key, "label", (F.col("base") + F.coalesce("s", F.lit(0.0))).alias("score")))
    return scores.groupBy(key).agg(F.max_by("label", F.struct(F.col("score"), -F.col("label"))).alias("pred"))


def fit_gaussian_nb_dense(train: DataFrame, x: str = "x", label: str = "label",
                          var_smoothing: float = 1e-9) -> DataFrame:
    """H8 on dense vectors: ``(label, prior, mu, var)`` per class, population
    variances plus ``var_smoothing`` times the largest variance of any
    dimension over all rows. Two aggregates, one buffer per class and task."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer
    v = train.select(F.col(label).alias("label"), array_to_vector(F.col(x).cast("array<double>")).alias("v"))
    stats = [F.count(F.lit(1)).alias("n"), Summarizer.mean(F.col("v")).alias("m"), Summarizer.variance(F.col("v")).alias("s")]
    # Summarizer has sample variances
    pop = F.transform(vector_to_array("s"), lambda q: q * (F.col("n") - 1) / F.col("n"))
    whole = v.agg(*stats).select("n", F.array_max(pop).alias("top")).first()
    if not whole["n"]:
        raise ValueError("no training rows")
    eps = var_smoothing * whole["top"]
    return v.groupBy("label").agg(*stats).select(
        "label", (F.col("n") / whole["n"]).alias("prior"), vector_to_array("m").alias("mu"),
        F.transform(pop, lambda q: q + eps).alias("var"))


def predict_gaussian_nb_dense(model: DataFrame, docs: DataFrame, key: str = "doc_id", x: str = "x") -> DataFrame:
    """``(key, pred)``; ties go to the smaller label. The model has a row per
    class, a bounded domain."""
    terms = F.zip_with("mu", "var", lambda m, s: F.struct(m.alias("m"), s.alias("s")))
    ll = F.aggregate(F.zip_with(F.col(x).cast("array<double>"), terms, lambda a, t: -0.5 * F.log(2 * F.pi() * t["s"])
                                - (a - t["m"]) * (a - t["m"]) / (2 * t["s"])), F.log("prior"), lambda acc, y: acc + y)
    scores = docs.select(key, x).crossJoin(F.broadcast(model)).select(key, "label", ll.alias("score"))
    return scores.groupBy(key).agg(F.max_by("label", F.struct(F.col("score"), -F.col("label"))).alias("pred"))


def fit_logistic(train: DataFrame, features_col: str = "features", label: str = "label", C: float = 1.0):
    """H9: L2 logistic regression with the objective of C-regularised
    liblinear-style fitting: ``regParam = 1 / (C * n)``, no standardisation."""
    from pyspark.ml.classification import LogisticRegression
    n = train.count()
    lr = LogisticRegression(featuresCol=features_col, labelCol=label, regParam=1.0 / (C * n),
                            elasticNetParam=0.0, standardization=False, maxIter=200, tol=1e-9)
    return lr.fit(train)


def to_sparse_vectors(long_features: DataFrame, vocab: DataFrame, docs: DataFrame, key: str = "doc_id"):
    """Long ``(doc_id, word)`` -> ``(doc_id, features)`` sparse vectors, via
    ``CountVectorizerModel`` with the fixed vocabulary (binary)."""
    from pyspark.ml.feature import CountVectorizerModel
    words = [r[0] for r in vocab.select("word").orderBy("word").collect()]  # vocabulary: model size
    grouped = long_features.groupBy(key).agg(F.collect_list("word").alias("ws"))
    d = docs.select(key).join(grouped, key, "left").select(
        key, F.coalesce("ws", F.array().cast("array<string>")).alias("ws"))
    cv = CountVectorizerModel.from_vocabulary(words, inputCol="ws", outputCol="features", binary=True)
    return cv.transform(d).drop("ws")


def confusion(pred: DataFrame, label: str = "label", pred_col: str = "pred",
              domain: list | None = None) -> DataFrame:
    """``(label, pred, n)`` for every cell of the label domain,
    including empty cells (the domain is the bounded set of classes)."""
    if domain is None:
        # the classes: bounded, as for any classifier
        domain = sorted(r[0] for r in pred.select(F.col(label)).union(pred.select(F.col(pred_col)))
                        .distinct().collect())
    cnt = pred.groupBy(label, pred_col).agg(F.count(F.lit(1)).alias("n"))
    spark = pred.sparkSession
    cells = spark.createDataFrame([(a, b) for a in domain for b in domain], [label, pred_col])
    cells = cells.select(F.col(label).cast(pred.schema[label].dataType), F.col(pred_col).cast(pred.schema[pred_col].dataType))
    return cells.join(cnt, [label, pred_col], "left").select(label, pred_col, F.coalesce("n", F.lit(0)).alias("n"))


def accuracy(pred: DataFrame, label: str = "label", pred_col: str = "pred") -> DataFrame:
    return pred.agg(F.avg((F.col(label) == F.col(pred_col)).cast("double")).alias("accuracy"))


def mse(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """D14."""
    return df.agg(F.avg((F.col(actual) - F.col(predicted)) ** 2).alias("mse"),
                  F.sqrt(F.avg((F.col(actual) - F.col(predicted)) ** 2)).alias("rmse"))
