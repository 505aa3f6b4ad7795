"""Vector queries on ``embeddings`` (key = vec_id)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.functions import scalar as SC
from lodestar.functions import vector as V
from lodestar.operators import vectors as VS
from lodestar.plans.ranking import top_k_per_group
from lodestar.plans.registry import query
from lodestar.sources.tables import Tables

EMB_SQL = "emb AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"
UNIT_SQL = "unit AS (SELECT vec_id, label, list_transform(v, lambda x: x / sqrt(list_dot_product(v, v))) AS u FROM emb)"


def _vec(spark, d):
    return Tables(spark, d).embeddings.select(F.col("vec_id").alias("key"), "label",
                                              F.col("embedding").cast("array<double>").alias("vec"))


def _mean_sql(src: str, group: str, vec: str) -> str:
    """SQL: per-group element-wise mean of list column ``vec``."""
    return f"""(SELECT {group}, list(m ORDER BY i) AS mean FROM (
  SELECT {group}, i, avg(x) AS m FROM (SELECT {group}, unnest({vec}) AS x, unnest(generate_series(1, len({vec}))) AS i
  FROM {src}) GROUP BY {group}, i) GROUP BY {group})"""


@query("cosine_next", f"""WITH {EMB_SQL}
SELECT a.vec_id, round(list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))), 6) AS cos
FROM emb a JOIN emb b ON b.vec_id = a.vec_id + 1""")
def cosine_next(spark, d):
    v = _vec(spark, d)
    b = v.select(F.col("key").alias("k2"), F.col("vec").alias("v2"))
    return v.join(b, F.col("k2") == F.col("key") + 1).select(
        F.col("key").alias("vec_id"), F.round(V.cosine(F.col("vec"), F.col("v2")), 6).alias("cos"))


@query("l2_normalize", f"""WITH {EMB_SQL}, {UNIT_SQL}
SELECT vec_id, CAST(i - 1 AS INTEGER) AS dim, round(x, 6) AS value FROM
  (SELECT vec_id, unnest(u) AS x, unnest(generate_series(1, len(u))) AS i FROM unit)""")
def l2_normalize(spark, d):
    v = _vec(spark, d)
    return v.select(F.col("key").alias("vec_id"), F.posexplode(V.l2_normalize(F.col("vec"))).alias("dim", "x")) \
            .select("vec_id", "dim", F.round("x", 6).alias("value"))


@query("pattern_similarity", f"""WITH {EMB_SQL},
c AS (SELECT vec_id, list_transform(v, lambda x: x - list_avg(v)) AS c, len(v) AS n FROM emb),
s AS (SELECT vec_id, c, n, sqrt(list_dot_product(c, c) / (n - 1)) AS sd FROM c)
SELECT a.vec_id, round(list_dot_product(a.c, b.c) / (a.n * a.sd * b.sd), 6) AS sim
FROM s a JOIN s b ON b.vec_id = a.vec_id + 1""")
def pattern_similarity(spark, d):
    v = _vec(spark, d)
    b = v.select(F.col("key").alias("k2"), F.col("vec").alias("v2"))
    return v.join(b, F.col("k2") == F.col("key") + 1).select(
        F.col("key").alias("vec_id"), F.round(V.pattern_similarity(F.col("vec"), F.col("v2")), 6).alias("sim"))


@query("vector_scalars", f"""WITH {EMB_SQL}
SELECT vec_id, CAST(len(v) + 1 AS INTEGER) AS n_with_intercept,
  CAST(trunc(list_sum(list_transform(v, lambda x: CASE WHEN isnan(x) THEN 0 ELSE x END)) * 100) AS BIGINT) / 100.0 AS sum_trunc2
FROM emb""")
def vector_scalars(spark, d):
    """B11, B12, B13 together: NaN-safe sum truncated to 2 decimals, and the
    length after adding an intercept."""
    v = _vec(spark, d)
    s = F.aggregate(V.nan_to_zero(F.col("vec")), F.lit(0.0), lambda a, x: a + x)
    return v.select(F.col("key").alias("vec_id"), F.size(SC.with_intercept(F.col("vec"))).alias("n_with_intercept"),
                    SC.trunc2(s).alias("sum_trunc2"))


@query("mean_vector", f"""WITH {EMB_SQL}
SELECT label, CAST(i - 1 AS INTEGER) AS dim, round(m, 6) AS mean FROM
  (SELECT label, i, avg(x) AS m FROM (SELECT label, unnest(v) AS x, unnest(generate_series(1, len(v))) AS i FROM emb)
   GROUP BY label, i)""")
def mean_vector(spark, d):
    m = VS.mean_vector(_vec(spark, d), ["label"])
    return m.select("label", F.posexplode("mean").alias("dim", "m")).select("label", "dim", F.round("m", 6).alias("mean"))


# query batch per label L: positives = the two smallest vec_ids of L,
# negative = the smallest vec_id of label L + 1 (when that label exists)
BATCH_SQL = """ranked AS (SELECT vec_id, label, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS rn FROM embeddings),
batch AS (SELECT label AS qid, vec_id, 1.0 AS weight FROM ranked WHERE rn <= 2
  UNION ALL SELECT r.label - 1, r.vec_id, -1.0 FROM ranked r WHERE r.rn = 1
    AND r.label - 1 IN (SELECT label FROM embeddings))"""


def _batch(spark, d):
    e = Tables(spark, d).embeddings.select("vec_id", "label")
    r = top_k_per_group(e, ["label"], [F.col("vec_id")], 2, rank_name="rn", salt_key=["vec_id"])
    pos = r.select(F.col("label").alias("qid"), F.col("vec_id").alias("key"), F.lit(1.0).alias("weight"))
    labels = e.select(F.col("label").alias("qid")).distinct()
    neg = r.where(F.col("rn") == 1).select((F.col("label") - 1).alias("qid"), F.col("vec_id").alias("key"),
                                           F.lit(-1.0).alias("weight")).join(labels, "qid", "left_semi")
    return pos.unionByName(neg)


@query("most_similar", f"""WITH {EMB_SQL}, {UNIT_SQL}, {BATCH_SQL},
qv0 AS {_mean_sql("(SELECT b.qid, list_transform(u.u, lambda x: x * b.weight) AS w FROM batch b JOIN unit u ON u.vec_id = b.vec_id)", "qid", "w")},
qv AS (SELECT qid, list_transform(mean, lambda x: x / sqrt(list_dot_product(mean, mean))) AS q FROM qv0),
sc AS (SELECT qv.qid, u.vec_id, list_dot_product(u.u, qv.q) AS score FROM unit u CROSS JOIN qv
  WHERE NOT EXISTS (SELECT 1 FROM batch b WHERE b.qid = qv.qid AND b.vec_id = u.vec_id))
SELECT qid, vec_id, round(score, 6) AS score, rk AS rank FROM
  (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, vec_id) AS rk FROM sc) WHERE rk <= 10""")
def most_similar(spark, d):
    r = VS.most_similar(_vec(spark, d).drop("label"), _batch(spark, d), topn=10)
    return r.select("qid", F.col("key").alias("vec_id"), F.round("score", 6).alias("score"), "rank")


@query("most_similar_cosmul", f"""WITH {EMB_SQL}, {UNIT_SQL}, {BATCH_SQL},
pr AS (SELECT b.qid, u.vec_id, b.weight, (1 + list_dot_product(u.u, t.u)) / 2 AS c
  FROM unit u CROSS JOIN batch b JOIN unit t ON t.vec_id = b.vec_id),
ag AS (SELECT qid, vec_id, coalesce(product(c) FILTER (WHERE weight > 0), 1.0) AS p,
  coalesce(product(c) FILTER (WHERE weight < 0), 1.0) AS n FROM pr GROUP BY qid, vec_id),
sc AS (SELECT qid, vec_id, p / (n + 1e-6) AS score FROM ag a
  WHERE NOT EXISTS (SELECT 1 FROM batch b WHERE b.qid = a.qid AND b.vec_id = a.vec_id))
SELECT qid, vec_id, round(score, 6) AS score, rk AS rank FROM
  (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, vec_id) AS rk FROM sc) WHERE rk <= 10""")
def most_similar_cosmul(spark, d):
    r = VS.most_similar_cosmul(_vec(spark, d).drop("label"), _batch(spark, d), topn=10)
    return r.select("qid", F.col("key").alias("vec_id"), F.round("score", 6).alias("score"), "rank")


# odd-one-out groups: the three smallest vec_ids of L and the smallest of L + 1
GROUPS_SQL = """ranked AS (SELECT vec_id, label, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS rn FROM embeddings),
grp AS (SELECT label AS qid, vec_id FROM ranked WHERE rn <= 3
  UNION ALL SELECT r.label - 1, r.vec_id FROM ranked r WHERE r.rn = 1 AND r.label - 1 IN (SELECT label FROM embeddings))"""


@query("doesnt_match", f"""WITH {EMB_SQL}, {UNIT_SQL}, {GROUPS_SQL},
j AS (SELECT g.qid, g.vec_id, u.u FROM grp g JOIN unit u ON u.vec_id = g.vec_id),
m0 AS {_mean_sql("j", "qid", "u")},
m AS (SELECT qid, list_transform(mean, lambda x: x / sqrt(list_dot_product(mean, mean))) AS m FROM m0),
s AS (SELECT j.qid, j.vec_id, list_dot_product(j.u, m.m) AS score FROM j JOIN m ON m.qid = j.qid)
SELECT qid, vec_id AS odd FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score, vec_id) AS rk FROM s)
WHERE rk = 1""")
def doesnt_match(spark, d):
    e = Tables(spark, d).embeddings.select("vec_id", "label")
    r = top_k_per_group(e, ["label"], [F.col("vec_id")], 3, rank_name="rn", salt_key=["vec_id"])
    labels = e.select(F.col("label").alias("qid")).distinct()
    g = r.select(F.col("label").alias("qid"), F.col("vec_id").alias("key")).unionByName(
        r.where(F.col("rn") == 1).select((F.col("label") - 1).alias("qid"), F.col("vec_id").alias("key"))
         .join(labels, "qid", "left_semi"))
    return VS.doesnt_match(_vec(spark, d).drop("label"), g)


@query("n_similarity", f"""WITH {EMB_SQL},
m AS {_mean_sql("emb", "label", "v")}
SELECT a.label AS qid, round(list_dot_product(a.mean, b.mean) /
  (sqrt(list_dot_product(a.mean, a.mean)) * sqrt(list_dot_product(b.mean, b.mean))), 6) AS similarity
FROM m a JOIN m b ON b.label = a.label + 1""")
def n_similarity(spark, d):
    """Label L's vectors against label L + 1's vectors."""
    v = _vec(spark, d)
    sets = v.select(F.col("label").alias("qid"), F.lit("a").alias("side"), "key").unionByName(
        v.select((F.col("label") - 1).alias("qid"), F.lit("b").alias("side"), "key"))
    r = VS.n_similarity(v.drop("label"), sets)
    return r.select("qid", F.round("similarity", 6).alias("similarity"))


@query("vector_lookup", f"""WITH {EMB_SQL}
SELECT u.user_id, e.vec_id IS NOT NULL AS has_vector,
  round(sqrt(list_dot_product(e.v, e.v)), 6) AS norm
FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN emb e ON e.vec_id = u.user_id""")
def vector_lookup(spark, d):
    t = Tables(spark, d)
    keys = t.events.select(F.col("user_id").alias("key")).distinct()
    v = _vec(spark, d).drop("label")
    r = VS.has_key(v, keys).join(VS.vector_of(v, keys), "key")
    return r.select(F.col("key").alias("user_id"), "has_vector", F.round(V.norm(F.col("vec")), 6).alias("norm"))
