"""Community queries on the attributed graph built from ``embeddings``
(attributes = all components, membership = label)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.operators import community as CM
from lodestar.plans.registry import query
from lodestar.sources import standins as S
from lodestar.sources.tables import Tables

G_SQL = f"""e AS ({S.ATTRIBUTED_EDGES_SQL}),
v AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS a, label AS community FROM embeddings)"""


def _g(spark, d):
    t = Tables(spark, d)
    v = S.attributed_vertices(t)
    return v.select("id", "attrs"), S.attributed_edges(t), v.select("id", "community")


@query("modularity", f"""WITH {G_SQL},
m AS (SELECT sum(weight) AS m FROM e),
deg AS (SELECT id, sum(w) AS k FROM (SELECT src AS id, weight AS w FROM e UNION ALL
  SELECT dst, weight FROM e WHERE src <> dst UNION ALL SELECT src, weight FROM e WHERE src = dst) GROUP BY id),
dc AS (SELECT v.community, sum(k) AS d FROM deg JOIN v ON v.id = deg.id GROUP BY v.community),
li AS (SELECT a.community, sum(weight) AS l FROM e JOIN v a ON a.id = e.src JOIN v b ON b.id = e.dst
  WHERE a.community = b.community GROUP BY a.community)
SELECT round(sum(coalesce(li.l, 0) / m.m - (dc.d / (2 * m.m)) * (dc.d / (2 * m.m))), 6) AS q
FROM dc LEFT JOIN li ON li.community = dc.community CROSS JOIN m""")
def modularity(spark, d):
    v, e, m = _g(spark, d)
    return CM.modularity(e, m).select(F.round("q", 6).alias("q"))


@query("attribute_affinity", f"""WITH {G_SQL},
u AS (SELECT id, community, list_transform(a, lambda x: x / sqrt(list_dot_product(a, a))) AS u FROM v)
SELECT x.id, x.community, round(avg(list_dot_product(x.u, y.u)), 6) AS affinity
FROM u x JOIN u y ON x.community = y.community GROUP BY x.id, x.community""")
def attribute_affinity(spark, d):
    """D16 of every vertex to its own community; the oracle averages the
    pairwise cosines directly, the operator uses the centroid identity."""
    v, e, m = _g(spark, d)
    return CM.attribute_affinity(v, m).select("id", "community", F.round("affinity", 6).alias("affinity"))


@query("contract_edges", f"""WITH {G_SQL}
SELECT least(a.community, b.community) AS src, greatest(a.community, b.community) AS dst, sum(weight) AS weight
FROM e JOIN v a ON a.id = e.src JOIN v b ON b.id = e.dst GROUP BY 1, 2""")
def contract_edges(spark, d):
    v, e, m = _g(spark, d)
    return CM.contract(v, e, m)[1]


@query("contract_attrs", f"""WITH {G_SQL}
SELECT community AS id, CAST(i - 1 AS INTEGER) AS dim, round(avg(x), 6) AS mean FROM
  (SELECT community, unnest(a) AS x, unnest(generate_series(1, len(a))) AS i FROM v) GROUP BY community, i""")
def contract_attrs(spark, d):
    v, e, m = _g(spark, d)
    cv = CM.contract(v, e, m)[0]
    return cv.select("id", F.posexplode("attrs").alias("dim", "x")).select("id", "dim", F.round("x", 6).alias("mean"))


@query("relabel", f"""WITH {G_SQL},
f AS (SELECT community, min(id) AS first FROM v GROUP BY community)
SELECT v.id, dense_rank() OVER (ORDER BY f.first) - 1 AS community FROM v JOIN f ON f.community = v.community""")
def relabel(spark, d):
    v, e, m = _g(spark, d)
    return CM.relabel(m).select("id", F.col("community").cast("long"))


@query("sac_communities")
def sac_communities(spark, d):
    """G15 with alpha 0.5 from singletons, three sweeps a phase: at this alpha
    vertices move in every sweep, since the gain has no term for leaving."""
    v, e, m = _g(spark, d)
    return CM.sac(v, e, alpha=0.5, sweeps=3)


@query("kmeans_cosine")
def kmeans_cosine(spark, d):
    """K-means (k = 10) with cosine distance on the attributes."""
    v, e, m = _g(spark, d)
    return CM.kmeans_cosine(v, 10)
