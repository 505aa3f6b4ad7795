"""Graph queries on the part-supplier graph, the geography forest and the
nation trade graph."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.operators import graph as G
from lodestar.plans.iterate import materialize
from lodestar.plans.registry import query
from lodestar.sources import standins as S
from lodestar.sources.tables import Tables

PS = S.PART_SUPPLIER_EDGES_SQL
GEO = S.GEO_FOREST_EDGES_SQL
SIMPLE_PS = f"""e AS ({PS}),
s AS (SELECT src, dst FROM e WHERE src <> dst UNION SELECT dst, src FROM e WHERE src <> dst)"""
GEO_SYM = f"""g AS ({GEO}),
s AS (SELECT src, dst FROM g WHERE src <> dst UNION SELECT dst, src FROM g WHERE src <> dst),
v AS (SELECT src AS id FROM g UNION SELECT dst FROM g)"""


def _ps(spark, d):
    return S.part_supplier_edges(Tables(spark, d))


def _geo(spark, d):
    return S.geo_forest_edges(Tables(spark, d))


@query("degree_distribution", f"""
WITH {SIMPLE_PS}
SELECT degree, count(*) AS n_vertices FROM (SELECT dst AS id, count(*) AS degree FROM s GROUP BY dst)
GROUP BY degree""")
def degree_distribution(spark, d):
    return G.degree_distribution(G.simple(_ps(spark, d)))


@query("in_degrees", f"WITH {SIMPLE_PS} SELECT dst AS id, count(*) AS degree FROM s GROUP BY dst")
def in_degrees(spark, d):
    return G.in_degrees(G.simple(_ps(spark, d)))


@query("power_law_gamma", f"""
WITH {SIMPLE_PS},
dist AS (SELECT degree, count(*) AS c FROM (SELECT dst, count(*) AS degree FROM s GROUP BY dst) GROUP BY degree),
fit AS (SELECT sum(c) AS n,
  -(sum(ln(degree) * ln(c)) - ln(sum(c)) * sum(ln(degree))) / sum(ln(degree) * ln(degree)) AS gamma FROM dist)
SELECT CAST(n AS BIGINT) AS n_vertices, round(gamma, 6) AS gamma, (gamma > 2 AND gamma < 3) AS scale_free FROM fit""")
def power_law_gamma(spark, d):
    r = G.power_law_gamma(G.degree_distribution(G.simple(_ps(spark, d))))
    return r.select("n_vertices", F.round("gamma", 6).alias("gamma"), "scale_free")


@query("graph_counts", f"""
WITH {SIMPLE_PS}
SELECT (SELECT count(*) FROM (SELECT src AS id FROM e UNION SELECT dst FROM e)) AS n_vertices,
       CAST((SELECT count(*) FROM s) / 2 AS BIGINT) AS n_edges""")
def graph_counts(spark, d):
    return G.graph_counts(_ps(spark, d))


@query("simple_edges", f"WITH {SIMPLE_PS} SELECT src, dst FROM s")
def simple_edges(spark, d):
    return G.simple(_ps(spark, d))


@query("vertices_of", f"WITH e AS ({PS}) SELECT src AS id FROM e UNION SELECT dst FROM e")
def vertices_of(spark, d):
    return G.vertices_of(_ps(spark, d))


@query("undirected_adjacency", f"""
WITH {SIMPLE_PS}
SELECT src AS id, string_agg(dst, ' ' ORDER BY dst) AS neighbors FROM s GROUP BY src""")
def undirected_adjacency(spark, d):
    a = G.undirected_adjacency(G.drop_loops(_ps(spark, d)))
    return a.select("id", F.concat_ws(" ", "neighbors").alias("neighbors"))


@query("trade_loops", f"""
WITH t AS ({S.TRADE_EDGES_SQL})
SELECT count(*) FILTER (WHERE src = dst) AS n_loops,
       count(*) FILTER (WHERE src <> dst) AS n_other,
       (SELECT count(*) FROM (SELECT DISTINCT src, dst FROM t WHERE src <> dst)) AS n_distinct
FROM t""")
def trade_loops(spark, d):
    # one count per pair serves all three numbers
    pairs = S.trade_edges(Tables(spark, d)).groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))
    loop = F.col("src") == F.col("dst")
    return pairs.agg(F.coalesce(F.sum(F.when(loop, F.col("n"))), F.lit(0)).alias("n_loops"),
                     F.coalesce(F.sum(F.when(~loop, F.col("n"))), F.lit(0)).alias("n_other"),
                     F.count(F.when(~loop, 1)).alias("n_distinct"))


@query("trade_has_edge", f"""
WITH t AS ({S.TRADE_EDGES_SQL}),
pairs AS (SELECT 'n' || CAST(a.n_nationkey AS VARCHAR) AS src, 'n' || CAST(b.n_nationkey AS VARCHAR) AS dst
          FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey)
SELECT p.src, p.dst, EXISTS (SELECT 1 FROM t WHERE t.src = p.src AND t.dst = p.dst) AS present FROM pairs p""")
def trade_has_edge(spark, d):
    t = Tables(spark, d)
    a = t.nation.select(F.col("n_nationkey").alias("a"), "n_regionkey")
    b = t.nation.select(F.col("n_nationkey").alias("b"), "n_regionkey")
    pairs = a.join(b, "n_regionkey").select(F.concat(F.lit("n"), F.col("a").cast("string")).alias("src"),
                                            F.concat(F.lit("n"), F.col("b").cast("string")).alias("dst"))
    return G.has_edge(S.trade_edges(t), pairs)


SUB_IDS_SQL = """SELECT 'p' || CAST(p_partkey AS VARCHAR) AS id FROM part WHERE p_size <= 10
UNION ALL SELECT 's' || CAST(s_suppkey AS VARCHAR) FROM supplier WHERE s_nationkey < 12"""


def _sub_ids(t: Tables):
    return (t.part.where("p_size <= 10").select(F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("id"))
            .unionByName(t.supplier.where("s_nationkey < 12")
                         .select(F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("id"))))


@query("induced_subgraph", f"""
WITH e AS ({PS}), ids AS ({SUB_IDS_SQL})
SELECT src, dst FROM e WHERE src IN (SELECT id FROM ids) AND dst IN (SELECT id FROM ids)""")
def induced_subgraph(spark, d):
    t = Tables(spark, d)
    return G.subgraph(S.part_supplier_edges(t), _sub_ids(t))


@query("without_vertices", f"""
WITH e AS ({PS}), ids AS ({SUB_IDS_SQL})
SELECT src, dst FROM e WHERE src NOT IN (SELECT id FROM ids) AND dst NOT IN (SELECT id FROM ids)""")
def without_vertices(spark, d):
    t = Tables(spark, d)
    return G.without_vertices(S.part_supplier_edges(t), _sub_ids(t))


CC_GEO_SQL = f"""
WITH RECURSIVE {GEO_SYM},
cc(id, comp) USING KEY (id) AS (
  SELECT id, id FROM v
  UNION
  (SELECT s.dst, min(cc.comp) FROM cc JOIN s ON s.src = cc.id
   JOIN recurring.cc r ON r.id = s.dst
   WHERE cc.comp < r.comp GROUP BY s.dst))"""


@query("components", CC_GEO_SQL + " SELECT id, comp AS component FROM cc")
def components(spark, d):
    return G.connected_components(_geo(spark, d))


@query("component_count", CC_GEO_SQL + " SELECT count(DISTINCT comp) AS n_components FROM cc")
def component_count(spark, d):
    return G.component_count(G.connected_components(_geo(spark, d)))


@query("shortest_paths", f"""
WITH RECURSIVE g AS ({GEO}), lm AS ({S.GEO_REGIONS_SQL}),
d(id, landmark, dist) USING KEY (id, landmark) AS (
  SELECT id, id, 0 FROM lm
  UNION
  (SELECT g.src, d.landmark, min(d.dist + 1) FROM d JOIN g ON g.dst = d.id
   LEFT JOIN recurring.d r ON r.id = g.src AND r.landmark = d.landmark
   WHERE r.id IS NULL OR d.dist + 1 < r.dist GROUP BY g.src, d.landmark))
SELECT id, landmark, dist FROM d""")
def shortest_paths(spark, d):
    t = Tables(spark, d)
    return G.shortest_paths(S.geo_forest_edges(t), S.geo_regions(t))


@query("closeness", f"""
WITH RECURSIVE {GEO_SYM},
d(id, landmark, dist) USING KEY (id, landmark) AS (
  SELECT id, id, 0 FROM v
  UNION
  (SELECT s.src, d.landmark, min(d.dist + 1) FROM d JOIN s ON s.dst = d.id
   LEFT JOIN recurring.d r ON r.id = s.src AND r.landmark = d.landmark
   WHERE r.id IS NULL OR d.dist + 1 < r.dist GROUP BY s.src, d.landmark))
SELECT landmark AS id, round(CASE WHEN sum(dist) = 0 THEN NULL ELSE 1.0 / sum(dist) END, 6) AS closeness
FROM d GROUP BY landmark""")
def closeness(spark, d):
    c = G.closeness(G.simple(_geo(spark, d)))
    return c.select("id", F.round("closeness", 6).alias("closeness"))


@query("articulation_points", f"""
WITH {GEO_SYM}
SELECT v.id, CASE WHEN (SELECT count(*) FROM s WHERE s.src = v.id) >= 2 THEN 1 ELSE 0 END AS articulation
FROM v""")
def articulation_points(spark, d):
    # the geography graph is a forest, where the oracle's rule (a vertex
    # with two or more neighbours) is exact; the operator does not use it
    return G.articulation_points(_geo(spark, d))


def _region_membership(t: Tables):
    c = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("id"), F.col("n_regionkey").alias("community"))
    s = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("id"), F.col("n_regionkey").alias("community"))
    n = t.nation.select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("id"),
                        F.col("n_regionkey").alias("community"))
    r = t.region.select(F.concat(F.lit("r"), F.col("r_regionkey").cast("string")).alias("id"),
                        F.col("r_regionkey").alias("community"))
    return c.unionByName(s).unionByName(n).unionByName(r)


REGION_MEMBERSHIP_SQL = """
SELECT 'c' || CAST(c_custkey AS VARCHAR) AS id, n_regionkey AS community FROM customer JOIN nation ON c_nationkey = n_nationkey
UNION ALL SELECT 's' || CAST(s_suppkey AS VARCHAR), n_regionkey FROM supplier JOIN nation ON s_nationkey = n_nationkey
UNION ALL SELECT 'n' || CAST(n_nationkey AS VARCHAR), n_regionkey FROM nation
UNION ALL SELECT 'r' || CAST(r_regionkey AS VARCHAR), r_regionkey FROM region"""

TRADE_GEO_SQL = f"""SELECT src, dst FROM ({GEO}) UNION SELECT dst, src FROM ({GEO})
UNION SELECT src, dst FROM ({S.TRADE_EDGES_SQL}) WHERE src <> dst"""


@query("seed_coverage", f"""
WITH RECURSIVE s AS ({TRADE_GEO_SQL}), m AS ({REGION_MEMBERSHIP_SQL}),
seeds AS (SELECT min('c' || CAST(c_custkey AS VARCHAR)) AS id FROM customer JOIN nation ON c_nationkey = n_nationkey
          GROUP BY n_regionkey),
d(id, seed, dist) USING KEY (id, seed) AS (
  SELECT id, id, 0 FROM seeds
  UNION
  (SELECT s.dst, d.seed, min(d.dist + 1) FROM d JOIN s ON s.src = d.id
   LEFT JOIN recurring.d r ON r.id = s.dst AND r.seed = d.seed
   WHERE r.id IS NULL OR d.dist + 1 < r.dist GROUP BY s.dst, d.seed))
SELECT d.seed, d.dist AS step,
       count(*) FILTER (WHERE m.community = ms.community) AS same_community,
       count(*) FILTER (WHERE m.community <> ms.community) AS other_community
FROM d JOIN m ON m.id = d.id JOIN m ms ON ms.id = d.seed
WHERE d.dist BETWEEN 1 AND 15 GROUP BY d.seed, d.dist""")
def seed_coverage(spark, d):
    """G16 on the geography forest plus nation trade links; one seed per
    region (its least customer key as a string)."""
    t = Tables(spark, d)
    geo = G.symmetrize(S.geo_forest_edges(t))
    trade = G.drop_loops(S.trade_edges(t))
    edges = geo.unionByName(trade).distinct()
    m = _region_membership(t)
    seeds = (t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
             .groupBy("n_regionkey").agg(F.min(F.concat(F.lit("c"), F.col("c_custkey").cast("string"))).alias("id"))
             .select("id"))
    return G.seed_coverage(edges, m, seeds, steps=15)


# ---- the part-supplier graph and a graph with cycles

PS_LANDMARKS_SQL = "SELECT min(src) AS id FROM s UNION SELECT max(src) FROM s UNION SELECT min(dst) FROM s WHERE src LIKE 's%'"


def _ps_landmarks(s):
    one = s.agg(F.min("src").alias("a"), F.max("src").alias("b"),
                F.min(F.when(F.col("src").startswith("s"), F.col("dst"))).alias("c"))
    return one.select(F.explode(F.array("a", "b", "c")).alias("id")).distinct()


@query("components_part_supplier", f"""
WITH RECURSIVE {SIMPLE_PS},
cc(id, comp) USING KEY (id) AS (
  SELECT src, src FROM (SELECT DISTINCT src FROM s)
  UNION
  (SELECT s.dst, min(cc.comp) FROM cc JOIN s ON s.src = cc.id
   JOIN recurring.cc r ON r.id = s.dst
   WHERE cc.comp < r.comp GROUP BY s.dst))
SELECT id, comp AS component FROM cc""")
def components_part_supplier(spark, d):
    return G.connected_components(_ps(spark, d))


PS_DIST_SQL = f"""
WITH RECURSIVE {SIMPLE_PS}, lm AS ({PS_LANDMARKS_SQL}),
d(id, landmark, dist) USING KEY (id, landmark) AS (
  SELECT id, id, 0 FROM lm
  UNION
  (SELECT s.src, d.landmark, min(d.dist + 1) FROM d JOIN s ON s.dst = d.id
   LEFT JOIN recurring.d r ON r.id = s.src AND r.landmark = d.landmark
   WHERE r.id IS NULL OR d.dist + 1 < r.dist GROUP BY s.src, d.landmark))"""


@query("shortest_paths_part_supplier", PS_DIST_SQL + " SELECT id, landmark, dist FROM d")
def shortest_paths_part_supplier(spark, d):
    s = materialize(G.simple(_ps(spark, d)))
    return G.shortest_paths(s, _ps_landmarks(s))


@query("closeness_landmarks", PS_DIST_SQL + """
SELECT landmark AS id, round(CASE WHEN sum(dist) = 0 THEN NULL ELSE 1.0 / sum(dist) END, 9) AS closeness FROM d GROUP BY landmark""")
def closeness_landmarks(spark, d):
    """G8 for a table of landmarks: state of vertices x landmarks."""
    s = materialize(G.simple(_ps(spark, d)))
    return G.closeness(s, _ps_landmarks(s)).select("id", F.round("closeness", 9).alias("closeness"))


@query("articulation_cyclic", f"""
WITH RECURSIVE e AS ({TRADE_GEO_SQL}),
s AS (SELECT src, dst FROM e UNION SELECT dst, src FROM e),
v AS (SELECT DISTINCT src AS id FROM s),
hubs AS (SELECT src AS rm FROM s GROUP BY src HAVING count(*) > 1),
cc(rm, id, comp) USING KEY (rm, id) AS (
  SELECT rm, id, id FROM hubs, v WHERE rm <> id
  UNION
  (SELECT cc.rm, s.dst, min(cc.comp) FROM cc JOIN s ON s.src = cc.id
   JOIN recurring.cc r ON r.rm = cc.rm AND r.id = s.dst
   WHERE cc.comp < r.comp GROUP BY cc.rm, s.dst)),
cut AS (SELECT cc.rm FROM cc JOIN s ON s.src = cc.rm AND s.dst = cc.id GROUP BY cc.rm HAVING count(DISTINCT comp) > 1)
SELECT id, CASE WHEN id IN (SELECT rm FROM cut) THEN 1 ELSE 0 END AS articulation FROM v""")
def articulation_cyclic(spark, d):
    """G9 on the geography forest joined by nation trade links (cycles); the
    oracle removes every vertex and labels the rest."""
    t = Tables(spark, d)
    edges = S.geo_forest_edges(t).unionByName(G.drop_loops(S.trade_edges(t))).distinct()
    return G.articulation_points(materialize(edges))
