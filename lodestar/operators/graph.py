"""Graph operators on edge tables ``(src, dst)``.

Graphs are two DataFrames: vertices ``(id)`` and edges ``(src, dst)``. All
iterative operators run as level-wise joins with the loop helper in
:mod:`lodestar.plans.iterate`; nothing is collected to the driver.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.plans.iterate import discard, fixpoint, materialize
from lodestar.plans.ranking import global_row_number

FOLD = 12  # levels of a search kept as tables of their own

# ------------------------------------------------------------ closures


def flip(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))


def _both_ways(edges: DataFrame) -> DataFrame:
    # one pass over the input emits each edge in both orientations (a union
    # of the table with its flip would scan the input twice)
    pair = F.explode(F.array(F.struct(F.col("src").alias("a"), F.col("dst").alias("b")),
                             F.struct(F.col("dst").alias("a"), F.col("src").alias("b")))).alias("p")
    return edges.select(pair).select(F.col("p.a").alias("src"), F.col("p.b").alias("dst"))


def symmetrize(edges: DataFrame) -> DataFrame:
    """edges plus flipped edges, distinct."""
    return _both_ways(edges).distinct()


def simple(edges: DataFrame) -> DataFrame:
    """G1: both directions, distinct, no self-loops."""
    return _both_ways(edges.where(F.col("src") != F.col("dst"))).distinct()


def vertices_of(edges: DataFrame) -> DataFrame:
    """Vertex table from edge endpoints."""
    return (edges.select(F.col("src").alias("id"))
            .unionByName(edges.select(F.col("dst").alias("id"))).distinct())


def drop_loops(edges: DataFrame) -> DataFrame:
    """G4."""
    return edges.where(F.col("src") != F.col("dst"))


def loop_count(edges: DataFrame) -> DataFrame:
    """Number of self-loop rows (one-row frame)."""
    return edges.agg(F.count(F.when(F.col("src") == F.col("dst"), 1)).alias("n_loops"))


def has_loops(edges: DataFrame) -> bool:
    return edges.where(F.col("src") == F.col("dst")).limit(1).count() > 0


def has_edge(edges: DataFrame, pairs: DataFrame) -> DataFrame:
    """Membership test; adds ``present`` to each (src, dst) of ``pairs``."""
    hit = edges.select("src", "dst").distinct().withColumn("present", F.lit(True))
    return pairs.join(hit, ["src", "dst"], "left").withColumn("present", F.coalesce("present", F.lit(False)))


def subgraph(edges: DataFrame, ids: DataFrame) -> DataFrame:
    """Induced subgraph on ``ids(id)`` (two semi joins)."""
    keep = ids.select(F.col("id"))
    return (edges.join(keep.withColumnRenamed("id", "src"), "src", "left_semi")
                 .join(keep.withColumnRenamed("id", "dst"), "dst", "left_semi")
                 .select("src", "dst"))


def without_vertices(edges: DataFrame, ids: DataFrame) -> DataFrame:
    """C11: drop vertices and their incident edges (two anti joins)."""
    drop = ids.select(F.col("id"))
    return (edges.join(drop.withColumnRenamed("id", "src"), "src", "left_anti")
                 .join(drop.withColumnRenamed("id", "dst"), "dst", "left_anti")
                 .select("src", "dst"))


def undirected_adjacency(edges: DataFrame) -> DataFrame:
    """``(id, neighbors)`` with sorted unique neighbour lists.

    The list of a vertex is its whole neighbourhood by definition; use the
    long form (``symmetrize``) when a hub may not fit one row."""
    e = symmetrize(edges)
    return e.groupBy(F.col("src").alias("id")).agg(F.array_sort(F.collect_set("dst")).alias("neighbors"))


def edges_from_coo(df: DataFrame, row: str = "row", col: str = "col", undirected: bool = True) -> DataFrame:
    """Edges from a sparse (row, col, value) table; value dropped."""
    e = df.select(F.col(row).alias("src"), F.col(col).alias("dst"))
    return symmetrize(e) if undirected else e.distinct()

# ------------------------------------------------------------ degrees


def in_degrees(edges: DataFrame) -> DataFrame:
    """In-degree per vertex (vertices with no in-edge do not appear)."""
    return edges.groupBy(F.col("dst").alias("id")).agg(F.count(F.lit(1)).alias("degree"))


def degree_distribution(edges: DataFrame) -> DataFrame:
    """``(degree, n_vertices)`` histogram."""
    return in_degrees(edges).groupBy("degree").agg(F.count(F.lit(1)).alias("n_vertices"))


def power_law_gamma(dist: DataFrame, n_vertices: int | Column | None = None) -> DataFrame:
    """Zero-intercept least squares of ln(count/n) on ln(degree).

    ``gamma = -sum(x*y) / sum(x^2)``; scale-free iff 2 < gamma < 3. When
    ``n_vertices`` is None, n is the number of vertices with degree >= 1
    (the histogram total), so the whole fit is a single aggregate:
    ``sum(x*y) = sum(x*ln c) - ln(n) * sum(x)``.
    """
    x = F.log(F.col("degree").cast("double"))
    c = F.col("n_vertices").cast("double")
    agg = dist.agg(F.sum(x * F.log(c)).alias("sxc"), F.sum(x).alias("sx"), F.sum(x * x).alias("sxx"),
                   F.sum("n_vertices").alias("n_hist"))
    n = F.col("n_hist") if n_vertices is None else (F.lit(n_vertices) if isinstance(n_vertices, int) else n_vertices)
    gamma = -(F.col("sxc") - F.log(n.cast("double")) * F.col("sx")) / F.col("sxx")
    return agg.select(n.cast("long").alias("n_vertices"), gamma.alias("gamma"),
                      ((gamma > 2) & (gamma < 3)).alias("scale_free"))


def graph_counts(edges: DataFrame) -> DataFrame:
    """Vertex count and undirected edge count of the simple closure."""
    # one pass: every endpoint pair and, as (id, null), every vertex
    keys = F.explode(F.array(
        F.struct(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")),
        F.struct(F.col("src").alias("a"), F.lit(None).cast(edges.schema["dst"].dataType).alias("b")),
        F.struct(F.col("dst").alias("a"), F.lit(None).cast(edges.schema["dst"].dataType).alias("b")))).alias("k")
    d = edges.select(keys).select("k.a", "k.b").distinct()
    return d.agg(F.count(F.when(F.col("b").isNull(), 1)).alias("n_vertices"),
                 F.count(F.when(F.col("a") != F.col("b"), 1)).alias("n_edges"))

# ------------------------------------------------------- components


def _large_star(e: DataFrame) -> DataFrame:
    # e: undirected, both directions. For each u, m(u) = min(u, N(u));
    # every neighbour v > u is re-linked to m(u).
    m = e.groupBy("src").agg(F.min("dst").alias("mn")).select("src", F.least("src", "mn").alias("m"))
    return (e.where(F.col("dst") > F.col("src")).join(m, "src")
             .select(F.col("dst").alias("src"), F.col("m").alias("dst")))


def _small_star(e: DataFrame) -> DataFrame:
    # orient edges high -> low; m(u) = min(u, lower neighbours); link all
    # of u's lower neighbours and u itself to m(u)
    low = e.where(F.col("dst") < F.col("src"))
    m = low.groupBy("src").agg(F.min("dst").alias("m"))
    j = low.join(m, "src")
    linked = j.select(F.col("dst").alias("src"), F.col("m").alias("dst")).where(F.col("src") != F.col("dst"))
    center = m.select(F.col("src"), F.col("m").alias("dst"))
    return linked.unionByName(center)


def connected_components(edges: DataFrame, vertices: DataFrame | None = None) -> DataFrame:
    """``(id, component)`` where component is the least id reached.

    Large-star / small-star rounds (Kiveris et al., 2014): O(log^2 n)
    rounds, each a group-by and a join (no hot-key window; AQE splits skewed
    join partitions). Ids that are not integers go by their rank, so a round
    sorts and compares no names. The round stops when the edge set is unchanged,
    checked with an order-free checksum in the action that materialises the state.
    """
    edges = materialize(edges.select("src", "dst"))  # read by ranks, rounds and vertices
    state, ranks = edges, None
    if not all(isinstance(edges.schema[c].dataType, T.IntegralType) for c in ("src", "dst")):
        ends = edges.where(F.col("src") != F.col("dst"))
        ranks = materialize(global_row_number(vertices_of(ends), [F.col("id")], "rank"))
        state = (ends.join(ranks.select(F.col("id").alias("src"), F.col("rank").alias("a")), "src")
                     .join(ranks.select(F.col("id").alias("dst"), F.col("rank").alias("b")), "dst")
                     .select(F.col("a").alias("src"), F.col("b").alias("dst")))
    state = simple(state)

    def both(df: DataFrame) -> DataFrame:
        return _both_ways(df).distinct()

    prev = {"sig": None}

    def step(cur: DataFrame, i: int) -> DataFrame:
        # duplicates of the star steps go with the distinct of the next one
        return both(_small_star(both(_large_star(cur))))

    def changes(cur: DataFrame) -> int:
        sig = cur.agg(F.count(F.lit(1)).alias("n"),
                      F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)")).alias("h")).first()
        key = (sig["n"], sig["h"])
        changed = key != prev["sig"]
        prev["sig"] = key
        return 1 if changed else 0

    stars, _ = fixpoint(state, step, changes)
    # stars: every edge links a vertex and its component minimum
    labels = stars.groupBy("src").agg(F.min("dst").alias("m")) \
                  .select(F.col("src").alias("id"), F.least("id", "m").alias("component"))
    if ranks is not None:
        labels = (labels.join(ranks.select(F.col("rank").alias("id"), F.col("id").alias("name")), "id")
                        .join(ranks.select(F.col("rank").alias("component"), F.col("id").alias("least")), "component")
                        .select(F.col("name").alias("id"), F.col("least").alias("component")))
    v = vertices_of(edges) if vertices is None else vertices.select("id")
    return v.join(labels, "id", "left").select("id", F.coalesce("component", "id").alias("component"))


def component_count(components: DataFrame) -> DataFrame:
    return components.agg(F.countDistinct("component").alias("n_components"))

# ------------------------------------------------ distances and closeness


def shortest_paths(edges: DataFrame, landmarks: DataFrame, max_hops: int | None = None) -> DataFrame:
    """``(id, landmark, dist)`` = hops from ``id`` to ``landmark``
    following edge direction; 0 to itself; unreachable pairs omitted.

    Frontier BFS backwards from the landmarks until the frontier is empty (or,
    where ``max_hops`` is asked for, has gone that far): each round joins the
    frontier with the edges ending in it and anti-joins what is visited. A
    round writes its own level only; levels are folded into one table every
    ``FOLD`` rounds, so a scan of all of them stays short.
    """
    e = materialize(edges.select("src", "dst").distinct())
    start = landmarks.select(F.col("id"), F.col("id").alias("landmark"), F.lit(0).alias("dist"))
    levels = [materialize(start)]
    frontier, i = levels[0], 0
    while max_hops is None or i < max_hops:
        i += 1
        visited = reduce(DataFrame.unionByName, levels).select("id", "landmark")
        nxt = materialize(frontier.join(e, frontier.id == e.dst)
                          .select(F.col("src").alias("id"), "landmark")
                          .distinct()
                          .join(visited, ["id", "landmark"], "left_anti")
                          .withColumn("dist", F.lit(i)))
        if nxt.isEmpty():
            discard(nxt)
            break
        levels.append(nxt)
        frontier = nxt
        if len(levels) > FOLD:
            folded = materialize(reduce(DataFrame.unionByName, levels[:-1]))
            discard(*levels[:-1])
            levels = [folded, nxt]
    discard(e)
    return reduce(DataFrame.unionByName, levels)


BITS = 64


def closeness(edges: DataFrame, landmarks: DataFrame | None = None) -> DataFrame:
    """``1 / sum(distances to the vertex)``; null when the sum is 0. With
    ``landmarks=None`` every vertex is a landmark.

    Bit-parallel search: landmarks are numbered and stand for the bits of 64-bit
    words; a vertex has one row per word with the landmarks it has met. A round
    sends the bits that were new in the last one over the edges (``bit_or``) and
    keeps, of all distances, only how many vertices each landmark reached in it.

    A leaf, from which one edge leaves to a vertex p and which no edge, or only
    p's, enters, needs no rows, exactly: it lies on no other path, is one hop
    further than p from everything, and p counts it (``leaves``). Nothing reaches
    a leaf without an entering edge; all that reach p reach any other, in one hop
    more. The state is (vertices x landmarks without leaves) / 64 rows at most."""
    e0 = materialize(edges.select("src", "dst").distinct())
    every = materialize((vertices_of(e0) if landmarks is None else landmarks).select("id").where(F.col("id").isNotNull()).distinct())
    e = e0.where("dst IS NOT NULL AND NOT (src <=> dst)")
    out = e.where("src IS NOT NULL").groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("n_out"), F.min("dst").alias("p"))
    into = e.groupBy(F.col("dst").alias("id")).agg(F.count(F.lit(1)).alias("n_in"), F.min("src").alias("q"))
    one_way = F.col("n_in").isNull()
    leaf = materialize(out.where("n_out = 1").join(into, "id", "left").where(one_way | ((F.col("n_in") == 1) & (F.col("p") == F.col("q"))))
                       .select("id", "p", one_way.alias("one_way")))
    pairs = leaf.select(F.col("p").alias("id"), F.col("id").alias("p"))  # two leaves of each other: neither is folded
    after = materialize(leaf.join(pairs, ["id", "p"], "left_anti"))
    discard(leaf)
    leaf = after
    leaves = materialize(leaf.groupBy(F.col("p").alias("id")).agg(F.count(F.lit(1)).alias("leaves")))
    out_of, to = leaf.select(F.col("id").alias("src")), leaf.select(F.col("id").alias("dst"))
    core = materialize(e.join(out_of, "src", "left_anti").join(to, "dst", "left_anti").select("src", "dst"))
    discard(e0)
    e = core
    asked = every.join(leaf, "id", "left")
    lm = asked.where("p IS NULL").select("id").unionByName(asked.where("NOT one_way").select(F.col("p").alias("id"))).distinct()
    numbered = materialize(global_row_number(lm, [F.col("id")], "rn").select(
        "id", F.floor((F.col("rn") - 1) / BITS).alias("word"), F.pmod(F.col("rn") - 1, F.lit(BITS)).cast("int").alias("bit")))
    one = F.expr("shiftleft(1L, bit)")
    state = materialize(numbered.select("id", "word", one.alias("seen"), one.alias("new")))
    dist = 0

    def met(now: DataFrame, dist: int) -> DataFrame:
        """Per word what a round brings each landmark: distances and vertices."""
        more = F.coalesce("leaves", F.lit(0))
        hit = [F.shiftrightunsigned("new", i).bitwiseAND(F.lit(1)) for i in range(BITS)]
        far, number = F.lit(dist) + more * F.lit(dist + 1), more + 1
        sums = F.array(*[F.struct(F.sum(x * far).alias("far"), F.sum(x * number).alias("n")) for x in hit])
        return materialize(now.where("new <> 0").join(leaves, "id", "left").groupBy("word").agg(sums.alias("met")))

    rounds = [met(state, 0)]
    while True:
        dist += 1
        sent = state.where("new <> 0").join(e.select("src", F.col("dst").alias("id")), "id") \
                    .groupBy(F.col("src").alias("id"), "word").agg(F.bit_or("new").alias("sent"))
        seen = F.coalesce("seen", F.lit(0).cast("long"))
        sent_ = F.coalesce("sent", F.lit(0).cast("long"))
        after = materialize(state.select("id", "word", "seen").join(sent, ["id", "word"], "full_outer").select(
            "id", "word", seen.bitwiseOR(sent_).alias("seen"), sent_.bitwiseAND(F.bitwise_not(seen)).alias("new")))
        discard(state)
        state = after
        count = met(state, dist)
        if count.isEmpty():
            discard(count)
            break
        rounds.append(count)
        if len(rounds) > FOLD:
            folded = materialize(reduce(DataFrame.unionByName, rounds))
            discard(*rounds)
            rounds = [folded]
    discard(state, e, leaves)
    per = reduce(DataFrame.unionByName, rounds).select("word", F.posexplode("met").alias("bit", "m")) \
        .groupBy("word", "bit").agg(F.sum("m.far").alias("total"), F.sum("m.n").alias("n"))
    found = materialize(numbered.join(per, ["word", "bit"], "left").select("id", "total", "n"))
    discard(numbered, *rounds)
    own = asked.join(found.select("id", "total"), "id", "left") \
        .join(found.select(F.col("id").alias("p"), (F.col("total") + F.col("n") - 2).alias("over")), "p", "left")
    total = F.when(F.col("p").isNull(), F.col("total")).when(~F.col("one_way"), F.col("over"))
    return own.select("id", F.try_divide(F.lit(1.0), total.cast("double")).alias("closeness"))

# ------------------------------------------------------- articulation


def bfs_forest(edges_sym: DataFrame, components: DataFrame) -> DataFrame:
    """BFS spanning forest rooted at each component's least id.

    Returns ``(id, parent, depth, path)`` where ``path`` is the root-to-id
    array (inclusive). Parent = least neighbour on the previous level. Runs
    until a level is empty; each level is written once."""
    roots = components.where(F.col("id") == F.col("component")).select(
        "id", F.lit(None).cast(components.schema["id"].dataType).alias("parent"),
        F.lit(0).alias("depth"), F.array("id").alias("path"))
    levels = [materialize(roots)]
    frontier, i = levels[0], 0
    while True:
        i += 1
        seen = reduce(DataFrame.unionByName, levels).select(F.col("id").alias("dst"))
        cand = materialize(frontier.select(F.col("id").alias("src"), "path")
                           .join(edges_sym, "src")
                           .join(seen, "dst", "left_anti")
                           .groupBy(F.col("dst").alias("id"))
                           .agg(F.min(F.struct("src", "path")).alias("p"))
                           .select("id", F.col("p.src").alias("parent"), F.lit(i).alias("depth"),
                                   F.concat(F.col("p.path"), F.array("id")).alias("path")))
        if cand.isEmpty():
            discard(cand)
            return reduce(DataFrame.unionByName, levels)
        levels.append(cand)
        frontier = cand
        if len(levels) > FOLD:
            folded = materialize(reduce(DataFrame.unionByName, levels[:-1]))
            discard(*levels[:-1])
            levels = [folded, cand]


def articulation_points(edges: DataFrame, vertices: DataFrame | None = None) -> DataFrame:
    """``(id, articulation)`` with 1 when removing the vertex increases
    the number of connected components.

    Tarjan-Vishkin biconnectivity on a BFS forest, all as joins:
      * each tree edge is named by its child vertex;
      * a non-tree edge (d, x) whose endpoints are unrelated links edge(d)
        and edge(x);
      * a non-tree edge (d, x) links edge(w) and edge(parent(w)) for every
        ancestor-or-self w of d deeper than lca(d, x) + 1 (the subtree of w
        reaches outside the subtree of its parent);
      * blocks = components of that auxiliary graph; a vertex touching tree
        edges of two blocks is an articulation point.
    Cost: O(E * depth) rows; the join depth is the BFS height.
    """
    e = simple(edges)
    v = vertices_of(edges) if vertices is None else vertices.select("id")
    comps = connected_components(e, v)
    tree = bfs_forest(e, comps)
    node = tree.select("id", "parent", "depth", "path")
    # non-tree edges, each direction once: (d, x) with x != parent(d) and d != parent(x)
    nt = (e.join(node.select(F.col("id").alias("src"), F.col("parent").alias("psrc"), F.col("path").alias("pd"),
                             F.col("depth").alias("dd")), "src")
           .join(node.select(F.col("id").alias("dst"), F.col("parent").alias("pdst"), F.col("path").alias("px"),
                             F.col("depth").alias("dx")), "dst")
           .where(~(F.col("psrc").eqNullSafe(F.col("dst")) | F.col("pdst").eqNullSafe(F.col("src")))))
    # depth of the lowest common ancestor = common prefix length - 1
    common = F.aggregate(
        F.zip_with(F.col("pd"), F.col("px"), lambda a, b: F.when(a.eqNullSafe(b), 1).otherwise(0)),
        F.struct(F.lit(0).alias("n"), F.lit(True).alias("on")),
        lambda acc, x: F.struct(
            (acc["n"] + F.when(acc["on"] & (x == 1), 1).otherwise(0)).alias("n"),
            (acc["on"] & (x == 1)).alias("on")),
        lambda acc: acc["n"])
    nt = nt.withColumn("lca_depth", common - 1)
    unrelated = nt.where((F.col("lca_depth") != F.col("dd")) & (F.col("lca_depth") != F.col("dx")))
    rule1 = unrelated.select(F.col("src").alias("a"), F.col("dst").alias("b"))
    # ancestors-or-self of d at depths lca+2 .. depth(d): path indexes (1-based) lca+3 .. dd+1
    climb = nt.where(F.col("dd") >= F.col("lca_depth") + 2).select(
        F.explode(F.slice("pd", F.col("lca_depth") + 3, F.col("dd") - F.col("lca_depth") - 1)).alias("w"))
    rule2 = (climb.distinct().join(node.select(F.col("id").alias("w"), F.col("parent").alias("p")), "w")
             .select(F.col("w").alias("a"), F.col("p").alias("b")))
    aux = rule1.unionByName(rule2).select(F.col("a").alias("src"), F.col("b").alias("dst"))
    tree_edges = node.where(F.col("parent").isNotNull()).select("id")
    blocks = connected_components(aux, tree_edges).withColumnRenamed("component", "block")
    # blocks touching each vertex: its own tree edge (to the parent) and its children's
    own = tree_edges.join(blocks, "id").select("id", "block")
    kids = node.where(F.col("parent").isNotNull()).select(F.col("id").alias("c"), F.col("parent").alias("id")) \
               .join(blocks.withColumnRenamed("id", "c"), "c").select("id", "block")
    touch = own.unionByName(kids).groupBy("id").agg(F.countDistinct("block").alias("nb"))
    return (v.join(touch, "id", "left")
             .select("id", F.when(F.col("nb") >= 2, 1).otherwise(0).alias("articulation")))

# ------------------------------------------------------------ coverage


def seed_coverage(edges: DataFrame, membership: DataFrame, seeds: DataFrame, steps: int = 15) -> DataFrame:
    """Vertices first reached at each hop (1..steps) from each seed,
    split by same / other community than the seed.

    ``membership(id, community)``, ``seeds(id)``. Edges are followed
    forward (src -> dst)."""
    rev = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    d = shortest_paths(rev, seeds, max_hops=steps)  # hops from landmark(seed) to id along edges
    d = materialize(d.where(F.col("dist") >= 1))
    m = membership.select("id", "community")
    j = (d.join(m, "id")
          .join(m.select(F.col("id").alias("landmark"), F.col("community").alias("seed_community")), "landmark"))
    same = F.col("community") == F.col("seed_community")
    return j.groupBy(F.col("landmark").alias("seed"), F.col("dist").alias("step")).agg(
        F.count(F.when(same, 1)).alias("same_community"),
        F.count(F.when(~same, 1)).alias("other_community"))

# --------------------------------------------------------- generators


def complete(spark, n: int) -> DataFrame:
    """Complete graph on 0..n-1, one row per unordered pair i<j.

    Quadratic by definition; the pairs are generated by range partitions."""
    i = spark.range(n).withColumnRenamed("id", "src").where(F.col("src") < n - 1)
    return i.withColumn("dst", F.explode(F.sequence(F.col("src") + 1, F.lit(n - 1).cast("long"))))


def _pair_of(k: Column, n: int) -> tuple[Column, Column]:
    """The k-th (from 0) of the pairs i < j in row order. The closed form is
    corrected by one step either way for the rounding of the root."""
    m = F.lit(float(2 * n - 1))
    i = F.floor((m - F.sqrt(F.greatest(F.lit(0.0), m * m - 8 * k))) / 2).cast("long")
    before = lambda r: r * (2 * n - r - 1) / 2  # noqa: E731  pairs in the rows before r
    i = F.when(before(i) > k, i - 1).otherwise(i)
    i = F.when(before(i + 1) <= k, i + 1).otherwise(i)
    return i, (k - before(i)).cast("long") + i + 1


def _bernoulli_positions(total: int, p: float, seed: int, parts: int):
    """Positions of 0..total-1 taken with probability ``p`` each: a range of
    positions walks from one taken position to the next by geometric gaps."""
    bounds = [total * i // parts for i in range(parts + 1)]

    def run(batches):
        for b in batches:
            for i in b.column("id").to_pylist():
                rng = np.random.Generator(np.random.Philox(key=(seed << 32) + i))
                at, end = bounds[i] - 1, bounds[i + 1]
                while at < end:
                    n = int(min(1_000_000, 1.05 * (end - at) * p + 64))
                    steps = at + np.cumsum(np.minimum(rng.geometric(p, n), end - at + 1))
                    taken = steps[steps < end]
                    yield pa.RecordBatch.from_arrays([pa.array(taken, pa.int64())], names=["k"])
                    at = end if len(taken) < n else int(steps[-1])

    return run


def _pairs_by_chance(spark, n: int, p: float, seed: int) -> DataFrame:
    total = n * (n - 1) // 2
    if total == 0 or p <= 0:
        return spark.createDataFrame([], "k long")
    parts = int(max(1, min(total, spark.sparkContext.defaultParallelism + total * p // 2_000_000)))
    return spark.range(parts, numPartitions=parts).mapInArrow(_bernoulli_positions(total, min(1.0, p), seed, parts), "k long")


def gnp(spark, n: int, p: float, seed: int = 0) -> DataFrame:
    """Erdos-Renyi G(n, p): every pair i < j by itself with probability
    ``p``, at every size; rows grow with the edges, not with n^2."""
    src, dst = _pair_of(F.col("k"), n)
    return _pairs_by_chance(spark, n, p, seed).select(src.alias("src"), dst.alias("dst"))


def gnm(spark, n: int, m: int, seed: int = 0) -> DataFrame:
    """G(n, m), uniform over the sets of m pairs. A G(n, p) with slightly
    more pairs expected than asked is written and counted; whatever its number,
    all sets of that size are equally likely, so taking away the surplus by the
    least hashes leaves a uniform set of m. Only the candidates for removal, some
    multiple of the square root of m, are put in order."""
    total = n * (n - 1) // 2
    if not 0 <= m <= total:
        raise ValueError(f"{m} edges asked of {total} pairs")
    if m == 0:
        return spark.createDataFrame([], "src long, dst long")
    p = min(1.0, (m + 6 * m ** 0.5 + 10) / total)
    for attempt in range(64):
        drawn = materialize(_pairs_by_chance(spark, n, p, seed + (attempt << 20)))
        have = drawn.count()
        if have >= m:
            break
        discard(drawn)
    surplus = have - m
    if surplus:
        h = F.xxhash64("k", F.lit(seed))
        share = min(1.0, (surplus + 6 * surplus ** 0.5 + 16) / have)
        while True:  # hashes below this bound hold the least ``surplus`` ones
            bound = min((1 << 63) - 1, int(share * (1 << 64)) - (1 << 63))
            low = drawn.withColumn("h", h).where(F.col("h") <= bound)
            ranked = materialize(global_row_number(low, [F.col("h"), F.col("k")], "rn"))
            if share == 1.0 or ranked.count() >= surplus:
                break
            share = min(1.0, 2 * share)
        drawn = drawn.join(ranked.where(F.col("rn") <= surplus).select("k"), "k", "left_anti")
    src, dst = _pair_of(F.col("k"), n)
    return drawn.select(src.alias("src"), dst.alias("dst"))
