"""Attributed-graph communities: modularity, attribute affinity, contraction,
relabelling and two-phase local moving (structure + attribute modularity).

Graphs: ``vertices(id, attrs array<double>)``, undirected ``edges(src, dst,
weight)`` listed once per edge (self-loops allowed), ``membership(id,
community)``. Every step is a join or an aggregate; the attribute affinity
of a vertex to a community is ``unit(x) . mean(unit(members))`` (the mean
cosine to the members), so no vertex pairs are formed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.functions.vector import dot, l2_normalize
from lodestar.operators.vectors import mean_vector
from lodestar.plans.blocks import block_apply, matrix
from lodestar.plans.iterate import NotConverged, discard, materialize

BLOCK = 1 << 22  # numbers in a block of attribute vectors: 32 MB
STRIP = 1024  # vertices and communities multiplied at a time


def degrees(edges: DataFrame) -> DataFrame:
    """Weighted degree; a self-loop of weight w adds 2w."""
    a = edges.select(F.col("src").alias("id"), "weight")
    b = edges.where(F.col("src") != F.col("dst")).select(F.col("dst").alias("id"), "weight")
    loops = edges.where(F.col("src") == F.col("dst")).select(F.col("src").alias("id"), "weight")
    return a.unionByName(b).unionByName(loops).groupBy("id").agg(F.sum("weight").alias("k"))


def modularity(edges: DataFrame, membership: DataFrame) -> DataFrame:
    """``sum_c (L_c / m - (d_c / 2m)^2)`` with weights."""
    edges, mem = materialize(edges), materialize(membership.select("id", "community"))
    m = edges.agg(F.sum("weight").alias("m"))
    inside = (edges.join(mem.select(F.col("id").alias("src"), F.col("community").alias("cs")), "src")
                   .join(mem.select(F.col("id").alias("dst"), F.col("community").alias("cd")), "dst")
                   .where(F.col("cs") == F.col("cd"))
                   .groupBy(F.col("cs").alias("community")).agg(F.sum("weight").alias("L")))
    dc = degrees(edges).join(mem, "id").groupBy("community").agg(F.sum("k").alias("d"))
    per = dc.join(inside, "community", "left").fillna(0.0, ["L"]).crossJoin(m)  # m: one row
    return per.agg(F.sum(F.col("L") / F.col("m") - (F.col("d") / (2 * F.col("m"))) ** 2).alias("q"))


def centroids(vertices: DataFrame, membership: DataFrame) -> DataFrame:
    """Mean unit attribute vector per community ``(community, centroid)``."""
    u = vertices.select("id", l2_normalize(F.col("attrs")).alias("u")).join(membership, "id")
    return mean_vector(u.select("community", F.col("u").alias("vec")), ["community"], "vec") \
        .withColumnRenamed("mean", "centroid")


def attribute_affinity(vertices: DataFrame, membership: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """Mean cosine of a vertex to the members of a community.

    ``pairs(id, community)`` chooses the (vertex, community) pairs to score;
    by default each vertex against its own community."""
    c = centroids(vertices, membership)
    p = membership.select("id", "community") if pairs is None else pairs
    u = vertices.select("id", l2_normalize(F.col("attrs")).alias("u"))
    return p.join(u, "id").join(c, "community").select("id", "community", dot("u", "centroid").alias("affinity"))


def contract(vertices: DataFrame, edges: DataFrame, membership: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One vertex per community (mean attributes), parallel edges summed,
    self-loops kept; undirected pairs are stored as (low, high)."""
    mem = membership.select("id", "community")
    v = mean_vector(vertices.join(mem, "id").select("community", F.col("attrs").alias("vec")), ["community"], "vec") \
        .select(F.col("community").alias("id"), F.col("mean").alias("attrs"))
    e = (edges.join(mem.select(F.col("id").alias("src"), F.col("community").alias("cs")), "src")
              .join(mem.select(F.col("id").alias("dst"), F.col("community").alias("cd")), "dst")
              .groupBy(F.least("cs", "cd").alias("src"), F.greatest("cs", "cd").alias("dst"))
              .agg(F.sum("weight").alias("weight")))
    return v, e


def relabel(membership: DataFrame) -> DataFrame:
    """Dense labels 0..n-1 in the order of each community's smallest
    member (one row per community is ranked, not the vertices)."""
    from lodestar.plans.ranking import global_row_number
    first = membership.groupBy("community").agg(F.min("id").alias("first"))
    ranked = global_row_number(first, [F.col("first")], "rn").select("community", (F.col("rn") - 1).alias("label"))
    return membership.join(ranked, "community").select("id", F.col("label").alias("community"))


def best_by_attributes(movers: DataFrame, targets: DataFrame, alpha: float, m: float, n: int | None = None,
                       block: int = 2048) -> DataFrame:
    """``(id, community, gain)``: for every mover the community with the
    greatest gain among all ``targets``, taken as if no edge led there.

    ``movers(id, A, k, kxa, dA, have, u)`` with ``have`` the best gain among the
    neighbours' communities, ``targets(community, dB, centroid)``. Movers and
    targets meet by blocks; a mover whose bound over a block (its degree term at
    the block's least ``dB``, the attribute term at the block's longest centroid)
    does not exceed ``have`` and 0 is not multiplied at all. A row is sent once
    per block of the other side, so blocks are large and multiplied in strips."""
    schema = T.StructType([T.StructField("id", movers.schema["id"].dataType), T.StructField("community", targets.schema["community"].dataType),
                           T.StructField("gain", T.DoubleType())])

    def run(x: pa.Table, c: pa.Table) -> pa.Table:
        empty = pa.table({"id": x.column("id").slice(0, 0), "community": c.column("community").slice(0, 0), "gain": pa.array([], pa.float64())})
        if not (x.num_rows and c.num_rows):
            return empty
        k, kxa, d_a, have = (x.column(n).to_numpy(zero_copy_only=False) for n in ("k", "kxa", "dA", "have"))
        d_b, cen = c.column("dB").to_numpy(zero_copy_only=False), matrix(c.column("centroid"))
        leave = alpha * (-kxa / m - k * (k - d_a) / (2 * m * m))
        bound = leave - alpha * k * d_b.min() / (2 * m * m) + (1 - alpha) * np.sqrt((cen * cen).sum(axis=1).max())
        open_ = np.flatnonzero(bound > np.maximum(have, 0.0))
        if not len(open_):
            return empty
        names = c.column("community").to_pylist()
        order = np.array(sorted(range(len(names)), key=lambda i: names[i]))  # equal gains: the least community
        names, d_b, cen = c.column("community").take(pa.array(order)), d_b[order], cen[order]
        at = {n: i for i, n in enumerate(names.to_pylist())}
        own = np.array([at.get(a, -1) for a in x.column("A").take(pa.array(open_)).to_pylist()])
        u = matrix(x.column("u").take(pa.array(open_)))
        pick, best = np.zeros(len(open_), np.int64), np.full(len(open_), -np.inf)
        for r in range(0, len(open_), STRIP):
            rows = open_[r:r + STRIP]
            for s in range(0, len(d_b), STRIP):
                gain = (leave[rows, None] - alpha * k[rows, None] * d_b[s:s + STRIP] / (2 * m * m)
                        + (1 - alpha) * np.einsum("xd,cd->xc", u[r:r + STRIP], cen[s:s + STRIP]))
                inside = np.flatnonzero((own[r:r + STRIP] >= s) & (own[r:r + STRIP] < s + STRIP))
                gain[inside, own[r + inside] - s] = -np.inf
                top = gain.argmax(axis=1)
                value = gain[np.arange(len(rows)), top]
                better = np.flatnonzero(value > best[r:r + STRIP])
                pick[r + better], best[r + better] = s + top[better], value[better]
        good = np.flatnonzero(best > 0)
        return pa.table({"id": x.column("id").take(pa.array(open_[good])), "community": names.take(pa.array(pick[good])),
                         "gain": pa.array(best[good])})

    return block_apply(movers.select("id", "A", "k", "kxa", "dA", "have", "u"), targets, ["id"], ["community"], run, schema,
                       block, sizes=None if n is None else (n, n))


def best_moves(mem: DataFrame, both: DataFrame, deg: DataFrame, unit: DataFrame, alpha: float, m: float, moving,
               n: int | None = None, block: int = 2048) -> DataFrame:
    """``(id, community, gain)``: the best strictly positive move of every
    vertex that ``moving(column)`` picks, over all communities that keep a
    member which does not move. ``both`` has every edge in both directions, ``n``
    is the number of vertices, if known, ``block`` the rows of a block."""
    cen = mean_vector(unit.join(mem, "id").select("community", F.col("u").alias("vec")), ["community"], "vec") \
        .select("community", F.col("mean").alias("centroid"))
    per = mem.join(deg, "id", "left").groupBy("community").agg(
        F.sum(F.coalesce("k", F.lit(0.0))).alias("d"), F.max((~moving(F.col("id"))).cast("int")).alias("stays"))
    com = materialize(per.join(cen, "community"))
    targets = com.where("stays = 1").select("community", F.col("d").alias("dB"), "centroid")
    kxc = (both.join(mem.select(F.col("id").alias("dst"), "community"), "dst").where(moving(F.col("src")))
               .groupBy(F.col("src").alias("id"), "community").agg(F.sum("weight").alias("kxc")))
    x = (mem.where(moving(F.col("id"))).select("id", F.col("community").alias("A"))
            .join(deg, "id", "left").fillna(0.0, ["k"])
            .join(com.select(F.col("community").alias("A"), F.col("d").alias("dA")), "A").join(unit, "id"))
    near = kxc.join(x, "id")
    own = near.where(F.col("community") == F.col("A")).select("id", F.col("kxc").alias("kxa"))
    near = near.where(F.col("community") != F.col("A")).join(own, "id", "left").fillna(0.0, ["kxa"]).join(targets, "community")
    dq = (F.col("kxc") - F.col("kxa")) / m - F.col("k") * (F.col("dB") - F.col("dA") + F.col("k")) / (2 * m * m)
    near = near.select("id", "community", (F.lit(alpha) * dq + F.lit(1 - alpha) * dot("u", "centroid")).alias("gain"))
    order = F.struct(F.col("gain"), -F.col("community"))
    have = near.groupBy("id").agg(F.max_by("community", order).alias("at"), F.max("gain").alias("have"))
    movers = materialize(x.join(own, "id", "left").join(have, "id", "left").fillna(0.0, ["kxa", "have"]))
    far = best_by_attributes(movers, targets, alpha, m, n, block)
    found = movers.where("at IS NOT NULL").select("id", F.col("at").alias("community"), F.col("have").alias("gain")).unionByName(far)
    out = materialize(found.where(F.col("gain") > 0).groupBy("id").agg(F.max_by(F.struct("community", "gain"), order).alias("b"))
                      .select("id", "b.*"))
    discard(com, movers)
    return out


def local_moving(vertices: DataFrame, edges: DataFrame, alpha: float, sweeps: int = 15, seed: int = 0,
                 membership: DataFrame | None = None, strict: bool = False) -> tuple[DataFrame, int]:
    """Local moving with gain ``alpha * dQ_newman + (1 - alpha) * dQ_attr``
    over all communities.

    dQ_newman for moving x from A to B (k = degree of x, m = total weight,
    d_C = community degree with x counted in A):
    ``(k_xB - k_xA\\x) / m - k * (d_B - d_A + k) / (2 m^2)``;
    dQ_attr = affinity of x to B (the gain has no term for leaving A).

    A sweep visits every vertex once, in two halves dealt by a hash of id, seed
    and sweep: a half moves at once, each vertex to its best strictly positive
    target that keeps a member of the other half (moving everyone at once lets
    neighbours swap forever). The method ends when a sweep moves nothing, and by
    its own definition after ``sweeps`` sweeps; with ``strict`` that raises
    :class:`NotConverged`. Returns (membership, sweeps made)."""
    mem = materialize(vertices.select("id", F.col("id").alias("community")) if membership is None else membership.select("id", "community"))
    m = float(edges.agg(F.sum("weight")).first()[0] or 0.0)
    if m == 0:
        return mem, 0
    deg = materialize(degrees(edges))
    both = edges.where(F.col("src") != F.col("dst")).select("src", "dst", "weight")
    both = materialize(both.unionByName(both.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")))
    unit = materialize(vertices.select("id", l2_normalize(F.col("attrs")).alias("u")))
    size, width = unit.agg(F.count(F.lit(1)), F.max(F.size("u"))).first()
    block = max(BLOCK // max(width or 1, 1), 2048)
    made = 0
    for sweep in range(1, sweeps + 1):
        made, moved = sweep, 0
        for half in range(2):
            def moving(c):
                return F.pmod(F.xxhash64(c, F.lit(seed), F.lit(sweep)), F.lit(2)) == half  # noqa: B023  used before the next half
            best = best_moves(mem, both, deg, unit, alpha, m, moving, size, block)
            n = best.count()
            if n:
                after = materialize(mem.join(best.select("id", F.col("community").alias("B")), "id", "left")
                                    .select("id", F.coalesce("B", "community").alias("community")))
                discard(mem)
                mem = after
            discard(best)
            moved += n
        if moved == 0:
            break
    else:
        if strict:
            raise NotConverged(f"vertices still move after {sweeps} sweeps")
    discard(deg, both, unit)
    return mem, made


def sac(vertices: DataFrame, edges: DataFrame, alpha: float, sweeps: int = 15, seed: int = 0) -> DataFrame:
    """Local moving, contraction, local moving on the contracted graph,
    then expansion to the original vertices; dense labels (E6)."""
    m1, _ = local_moving(vertices, edges, alpha, sweeps, seed)
    m1 = materialize(relabel(m1))
    cv, ce = contract(vertices, edges, m1)
    cv, ce = materialize(cv), materialize(ce)
    m2, _ = local_moving(cv, ce, alpha, sweeps, seed + 1)
    final = m1.join(m2.select(F.col("id").alias("community"), F.col("community").alias("c2")), "community")
    return relabel(final.select("id", F.col("c2").alias("community")))


def kmeans_cosine(df: DataFrame, k: int, seed: int = 1, features: str = "attrs") -> DataFrame:
    """K-means with cosine distance (Spark ML)."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector
    v = df.withColumn("features", array_to_vector(F.col(features)))
    model = KMeans(k=k, seed=seed, distanceMeasure="cosine", featuresCol="features").fit(v)
    return model.transform(v).select("id", F.col("prediction").alias("cluster"))
