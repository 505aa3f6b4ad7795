"""Vector lookup and similarity search over ``(key, vec array<double>)``.

A query batch is a table of (qid, key, weight) rows; scoring is a join of the
batch with the vector table by blocks of both sides, never a collect or a
broadcast, so the number of queries has no limit.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.functions.vector import dot, l2_normalize, norm
from lodestar.plans.blocks import block_apply, matrix
from lodestar.plans.ranking import top_k_per_group


def vector_of(vectors: DataFrame, keys: DataFrame, key: str = "key") -> DataFrame:
    """H5: ``keys`` left-joined to their vectors (null when missing)."""
    return keys.join(vectors, key, "left")


def has_key(vectors: DataFrame, keys: DataFrame, key: str = "key") -> DataFrame:
    """H5: ``keys`` with a boolean ``has_vector``."""
    hit = vectors.select(key).distinct().withColumn("has_vector", F.lit(True))
    return keys.join(hit, key, "left").withColumn("has_vector", F.coalesce("has_vector", F.lit(False)))


def mean_vector(vectors: DataFrame, group: list[str], vec: str = "vec") -> DataFrame:
    """Per-group element-wise mean ``(group.., mean)``: one buffer per
    group and task, merged (a hot group is pre-aggregated in its tasks)."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer
    v = vectors.select(*group, array_to_vector(F.col(vec).cast("array<double>")).alias("__v"))
    return v.groupBy(*group).agg(Summarizer.mean(F.col("__v")).alias("__m")) \
            .select(*group, vector_to_array("__m").alias("mean"))


def similarity(vectors: DataFrame, pairs: DataFrame, key: str = "key") -> DataFrame:
    """Cosine of two keys for each ``(a, b)`` row of ``pairs``."""
    u = vectors.select(F.col(key), l2_normalize(F.col("vec")).alias("u"))
    return (pairs.join(u.select(F.col(key).alias("a"), F.col("u").alias("ua")), "a")
                 .join(u.select(F.col(key).alias("b"), F.col("u").alias("ub")), "b")
                 .select("a", "b", dot("ua", "ub").alias("similarity")))


def n_similarity(vectors: DataFrame, sets: DataFrame, key: str = "key") -> DataFrame:
    """Cosine of the mean vectors of two key sets per ``qid``;
    ``sets(qid, side in {'a','b'}, key)``."""
    j = sets.join(vectors.select(key, "vec"), key)
    m = mean_vector(j, ["qid", "side"], "vec")
    a = m.where(F.col("side") == "a").select("qid", F.col("mean").alias("ma"))
    b = m.where(F.col("side") == "b").select("qid", F.col("mean").alias("mb"))
    return a.join(b, "qid").select("qid", (dot("ma", "mb") / (norm("ma") * norm("mb"))).alias("similarity"))


def _query_vectors(unit: DataFrame, queries: DataFrame, key: str) -> DataFrame:
    """unit mean of +/- weighted unit vectors per qid."""
    j = queries.join(unit, key).select("qid", F.transform("u", lambda x: x * F.col("weight")).alias("vec"))
    m = mean_vector(j, ["qid"], "vec")
    return m.select("qid", l2_normalize(F.col("mean")).alias("q"))


def _best(scores: np.ndarray, keys: list, rank: np.ndarray, left_out: list[list], topn: int) -> tuple[list, list, list]:
    """(query row, key row, score) of the ``topn`` best keys of every query of
    a block, equal scores by key."""
    place = {k: i for i, k in enumerate(keys)}
    rows, cols, values = [], [], []
    for q, own in enumerate(left_out):
        s = scores[q].copy()
        s[[place[k] for k in own if k in place]] = -np.inf
        s[np.isnan(s)] = -np.inf
        at = np.arange(len(s)) if len(s) <= topn else np.flatnonzero(s >= np.partition(s, len(s) - topn)[len(s) - topn])
        at = at[np.lexsort((rank[at], -s[at]))][:topn]
        at = at[s[at] > -np.inf]
        rows += [q] * len(at)
        cols += at.tolist()
        values += s[at].tolist()
    return rows, cols, values


def _search(vectors: DataFrame, queries: DataFrame, score, topn: int, key: str) -> DataFrame:
    """Top ``topn`` keys per query: ``queries(qid, terms, inputs)`` and the unit
    vectors meet by blocks, ``score(unit matrix, terms)`` gives a block's
    scores, and only the best of every block pair become rows."""
    unit = vectors.select(F.col(key), l2_normalize(F.col("vec")).alias("u"))
    schema = T.StructType([T.StructField("qid", queries.schema["qid"].dataType), T.StructField(key, unit.schema[key].dataType),
                           T.StructField("score", T.DoubleType())])

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        keys = a.column(key).to_pylist()
        rank = np.empty(len(keys), np.int64)
        rank[sorted(range(len(keys)), key=lambda i: (keys[i] is None, keys[i]))] = np.arange(len(keys))
        u = matrix(a.column("u"))
        # a pair of blocks may lack rows of either side
        scores = score(u, b) if len(keys) and b.num_rows else np.zeros((b.num_rows, len(keys)))
        rows, cols, values = _best(scores, keys, rank, [x or [] for x in b.column("inputs").to_pylist()], topn)
        return pa.table({"qid": b.column("qid").take(pa.array(rows, pa.int64())),
                         key: a.column(key).take(pa.array(cols, pa.int64())), "score": pa.array(values, pa.float64())})

    found = block_apply(unit, queries, [key], ["qid"], run, schema)
    return top_k_per_group(found, ["qid"], [F.col("score").desc(), F.col(key)], topn, salt_key=[key])


def _inputs(queries: DataFrame, key: str) -> DataFrame:
    """The keys that a query names: they are left out of its result."""
    return queries.groupBy("qid").agg(F.collect_set(key).alias("inputs"))


def most_similar(vectors: DataFrame, queries: DataFrame, topn: int = 10, key: str = "key") -> DataFrame:
    """``queries(qid, key, weight)`` with weight +1 (positive) or -1
    (negative). Cosine of every vector to the unit mean of the weighted unit
    query vectors, inputs excluded, top ``topn`` per query (ties by key)."""
    unit = vectors.select(F.col(key), l2_normalize(F.col("vec")).alias("u"))
    qv = _query_vectors(unit, queries, key).join(_inputs(queries, key), "qid")

    def score(u: np.ndarray, b: pa.Table) -> np.ndarray:
        # summed in the same order wherever a vector stands, so equal vectors tie
        return np.einsum("qd,kd->qk", matrix(b.column("q")), u)

    return _search(vectors, qv, score, topn, key)


def most_similar_cosmul(vectors: DataFrame, queries: DataFrame, topn: int = 10, key: str = "key") -> DataFrame:
    """``prod((1+cos)/2 over positives) / (prod over negatives + 1e-6)``."""
    unit = vectors.select(F.col(key), l2_normalize(F.col("vec")).alias("u"))
    terms = queries.join(unit, key).groupBy("qid").agg(
        F.collect_list(F.struct("weight", "u")).alias("terms"))  # a query's own few vectors
    terms = terms.join(_inputs(queries, key), "qid")

    def score(u: np.ndarray, b: pa.Table) -> np.ndarray:
        out = []
        for own in b.column("terms").to_pylist():
            near = (1 + np.einsum("td,kd->tk", np.array([t["u"] for t in own], float), u)) / 2
            sign = np.array([t["weight"] for t in own])
            out.append(near[sign > 0].prod(axis=0) / (near[sign < 0].prod(axis=0) + 1e-6))
        return np.array(out).reshape(b.num_rows, len(u))

    return _search(vectors, terms, score, topn, key)


def doesnt_match(vectors: DataFrame, groups: DataFrame, key: str = "key") -> DataFrame:
    """Per ``qid`` the key whose unit vector has the lowest cosine to
    the unit mean of the group's unit vectors; unknown keys are dropped, and a
    group without a known key has a null; ties go to the smallest key."""
    unit = vectors.select(F.col(key), l2_normalize(F.col("vec")).alias("u"))
    j = groups.select("qid", key).join(unit, key)
    m = mean_vector(j.select("qid", F.col("u").alias("vec")), ["qid"], "vec") \
        .select("qid", l2_normalize(F.col("mean")).alias("m"))
    s = j.join(m, "qid").select("qid", key, dot("u", "m").alias("score"))
    odd = s.groupBy("qid").agg(F.min_by(key, F.struct("score", key)).alias("odd"))
    return groups.select("qid").distinct().join(odd, "qid", "left")


def analogy_accuracy(vectors: DataFrame, questions: DataFrame, counts: DataFrame | None = None,
                     restrict: int = 30000, key: str = "key") -> DataFrame:
    """Accuracy per section and in total. Only questions with all four
    words inside the ``restrict`` most frequent keys count; the prediction
    is the best non-input key of that vocabulary for ``b - a + c``.

    ``questions(line_no, section, a, b, c, expected)``; ``counts(key, n)``
    ranks the vocabulary (vector order when None is not defined here)."""
    from lodestar.operators.text import build_vocab
    voc = build_vocab(counts.withColumnRenamed(key, "word"), 0, word="word", n="n").where(F.col("idx") <= restrict)
    vv = vectors.join(voc.select(F.col("word").alias(key)), key, "left_semi")
    words = voc.select("word")
    q = questions
    for c in ["a", "b", "c", "expected"]:
        q = q.join(words.withColumnRenamed("word", c), c, "left_semi")
    batch = q.select(F.col("line_no").alias("qid"), "a", "b", "c", "expected", "section")
    terms = (batch.select("qid", F.col("b").alias(key), F.lit(1.0).alias("weight"))
             .unionByName(batch.select("qid", F.col("c").alias(key), F.lit(1.0).alias("weight")))
             .unionByName(batch.select("qid", F.col("a").alias(key), F.lit(-1.0).alias("weight"))))
    best = most_similar(vv, terms, topn=1, key=key).select("qid", F.col(key).alias("pred"))
    res = batch.join(best, "qid", "left").withColumn("correct", (F.col("pred") == F.col("expected")).cast("int"))
    per = res.groupBy("section").agg(F.sum("correct").alias("correct"), F.count(F.lit(1)).alias("total"))
    tot = res.agg(F.lit("total").alias("section"), F.sum("correct").alias("correct"), F.count(F.lit(1)).alias("total"))
    return per.unionByName(tot)
