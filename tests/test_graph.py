import os
import random

import pytest
from pyspark.sql import functions as F

from lodestar.operators import graph as G

# fixed values: a published ten-vertex example graph
LITERAL = [("A", "B"), ("A", "C"), ("A", "D"), ("B", "A"), ("B", "C"), ("B", "D"), ("B", "E"),
           ("C", "A"), ("C", "B"), ("C", "D"), ("C", "F"), ("C", "H"), ("D", "A"), ("D", "B"),
           ("D", "C"), ("D", "E"), ("D", "F"), ("D", "G"), ("E", "B"), ("E", "D"), ("E", "F"),
           ("E", "G"), ("F", "C"), ("F", "D"), ("F", "E"), ("F", "G"), ("F", "H"), ("G", "D"),
           ("G", "E"), ("G", "F"), ("H", "C"), ("H", "F"), ("H", "I"), ("I", "H"), ("I", "J"),
           ("J", "I")]
# fixed values: closeness of its vertices
CLOSENESS_GOLD = {"F": 0.07142857142857142, "C": 0.07142857142857142, "D": 0.06666666666666667,
                  "H": 0.06666666666666667, "E": 0.058823529411764705, "B": 0.058823529411764705,
                  "A": 0.05555555555555555, "G": 0.05555555555555555, "I": 0.047619047619047616,
                  "J": 0.034482758620689655}


def edges_df(spark, pairs):
    return spark.createDataFrame(pairs, "src string, dst string")


def brute_components(pairs, verts):
    adj = {v: set() for v in verts}
    for a, b in pairs:
        adj[a].add(b); adj[b].add(a)
    comp = {}
    for v in sorted(verts):
        if v in comp:
            continue
        stack = [v]; comp[v] = v
        while stack:
            x = stack.pop()
            for y in adj[x]:
                if y not in comp:
                    comp[y] = v; stack.append(y)
    return comp


def brute_articulation(pairs, verts):
    base = len(set(brute_components(pairs, verts).values()))
    out = {}
    for v in verts:
        rest = [x for x in verts if x != v]
        p = [(a, b) for a, b in pairs if a != v and b != v]
        out[v] = 1 if len(set(brute_components(p, rest).values())) > base else 0
    return out


def test_closeness_gold(spark):
    c = G.closeness(edges_df(spark, LITERAL)).collect()
    got = {r["id"]: r["closeness"] for r in c}
    for k, v in CLOSENESS_GOLD.items():
        assert got[k] == pytest.approx(v, rel=1e-12)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_closeness_with_leaves(spark, monkeypatch, seed):
    rng = random.Random(seed)
    arcs = {(f"h{i}", f"h{rng.randrange(5)}") for i in range(5) for _ in range(2)}  # a few loops among them
    for i in range(40):
        p = f"h{rng.randrange(5)}"
        arcs |= [{(f"l{i}", p), (p, f"l{i}")}, {(f"l{i}", p)}, {(p, f"l{i}")}][i % 3]
    arcs |= {("x", "y"), ("y", "x"), ("o", "o")}
    verts = sorted({v for a in arcs for v in a})
    want = {}
    for v in verts:  # hops of every vertex to v
        far, queue = {v: 0}, [v]
        for u in queue:
            for a, b in arcs:
                if b == u and a not in far:
                    far[a] = far[u] + 1
                    queue.append(a)
        want[v] = 1 / sum(far.values()) if sum(far.values()) else None
    df = spark.createDataFrame(sorted(arcs), "src string, dst string")
    assert {r["id"]: r["closeness"] for r in G.closeness(df).collect()} == pytest.approx(want)
    some = spark.createDataFrame([(v,) for v in verts[::3]] + [("unknown",)], "id string")
    got = {r["id"]: r["closeness"] for r in G.closeness(df, some).collect()}
    assert got == pytest.approx({v: want[v] for v in verts[::3]} | {"unknown": None})


def test_closeness_of_a_star_has_no_row_per_leaf_pair(spark, monkeypatch):
    n, most = 2000, []
    write = G.materialize

    def counted(df):
        out = write(df)
        if "seen" in out.columns:
            most.append(out.count())
        return out

    monkeypatch.setattr(G, "materialize", counted)
    star = G.simple(spark.range(n).selectExpr("id as src", "cast(-1 as long) as dst"))
    got = {r["id"]: r["closeness"] for r in G.closeness(star).collect()}
    assert got[-1] == pytest.approx(1 / n) and got[0] == pytest.approx(1 / (2 * n - 1)) and len(got) == n + 1
    assert max(most) < n


def test_simple_and_degrees(spark):
    e = edges_df(spark, [("a", "b"), ("b", "a"), ("a", "a"), ("a", "c"), ("a", "c")])
    s = sorted(tuple(r) for r in G.simple(e).collect())
    assert s == [("a", "b"), ("a", "c"), ("b", "a"), ("c", "a")]
    d = {r["id"]: r["degree"] for r in G.in_degrees(G.simple(e)).collect()}
    assert d == {"a": 2, "b": 1, "c": 1}
    h = sorted(tuple(r) for r in G.degree_distribution(G.simple(e)).collect())
    assert h == [(1, 2), (2, 1)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components_and_articulation_random(spark, seed):
    rnd = random.Random(seed)
    n = 30
    verts = [f"v{i:02d}" for i in range(n)]
    pairs = set()
    for _ in range(34):
        a, b = rnd.sample(verts, 2)
        pairs.add((a, b))
    pairs = sorted(pairs)
    e = edges_df(spark, pairs)
    v = spark.createDataFrame([(x,) for x in verts], "id string")
    comp = {r["id"]: r["component"] for r in G.connected_components(e, v).collect()}
    assert comp == brute_components(pairs, verts)
    art = {r["id"]: r["articulation"] for r in G.articulation_points(e, v).collect()}
    assert art == brute_articulation(pairs, verts)


def test_articulation_of_a_written_graph(spark):
    # a clique and a cycle joined by a path, a star, and a component of its own; names hold spaces
    import tempfile
    from lodestar.sources.files import read_edges
    clique = [(f"k {i}", f"k {j}") for i in range(5) for j in range(i)]
    cycle = [(f"c {i}", f"c {(i + 1) % 6}") for i in range(6)]
    path = [("k 0", "p 1"), ("p 1", "p 2"), ("p 2", "c 0")]
    star = [("c 3", f"s {i}") for i in range(4)]
    apart = [("z 0", "z 1"), ("z 1", "z 2")]
    pairs = clique + cycle + path + star + apart
    folder = tempfile.mkdtemp(prefix="lodestar-graph-")
    with open(f"{folder}/edges.txt", "w") as f:
        f.write("".join(f"{a},{b}\n" for a, b in pairs))
    e = read_edges(spark, folder, sep=",")
    art = G.articulation_points(e)
    assert art.count() == 5 + 6 + 2 + 4 + 3
    assert sorted(r["id"] for r in art.where("articulation = 1").collect()) == ["c 0", "c 3", "k 0", "p 1", "p 2", "z 1"]
    assert G.component_count(G.connected_components(e)).first()[0] == 2


def test_shortest_paths_direction(spark):
    e = edges_df(spark, [("a", "b"), ("b", "c")])
    lm = spark.createDataFrame([("c",)], "id string")
    d = {r["id"]: r["dist"] for r in G.shortest_paths(e, lm).collect()}
    assert d == {"c": 0, "b": 1, "a": 2}


def test_power_law_gamma(spark):
    import math
    dist = spark.createDataFrame([(1, 4), (6, 19), (3, 5)], "degree int, n_vertices long")
    r = G.power_law_gamma(dist).first()
    n = 28
    xs = [math.log(1), math.log(6), math.log(3)]
    ys = [math.log(4 / n), math.log(19 / n), math.log(5 / n)]
    g = -sum(x * y for x, y in zip(xs, ys)) / sum(x * x for x in xs)
    assert r["gamma"] == pytest.approx(g)


def test_long_chain_is_complete(spark):
    from lodestar.plans.iterate import NotConverged, fixpoint
    n = 2000
    chain = spark.range(n - 1).selectExpr("id as src", "id + 1 as dst")
    comp = G.connected_components(chain)
    assert comp.where("component = 0").count() == n
    hops = 70
    short = spark.range(hops).selectExpr("id as src", "id + 1 as dst")
    d = G.shortest_paths(short, spark.createDataFrame([(hops,)], "id long"))
    assert {(r["id"], r["dist"]) for r in d.collect()} == {(i, hops - i) for i in range(hops + 1)}
    with pytest.raises(NotConverged):
        fixpoint(short, lambda s, i: s, lambda s: 1, max_iter=2)


def test_iterations_delete_their_state(spark):
    import os
    from lodestar.plans.iterate import fixpoint
    from lodestar.session import checkpoint_dir
    base = checkpoint_dir(spark).removeprefix("file:") + "/lodestar-state"
    before = set(os.listdir(base)) if os.path.isdir(base) else set()
    most = []

    def changes(s):
        most.append(len(set(os.listdir(base)) - before))
        return int(len(most) < 6)

    fixpoint(spark.range(3).toDF("src"), lambda s, i: s, changes)
    assert max(most) <= 2


def test_generators(spark):
    e = [tuple(r) for r in G.gnm(spark, 200, 500, seed=3).collect()]
    assert len(set(e)) == 500 and all(0 <= a < b < 200 for a, b in e)
    assert G.gnm(spark, 6, 14).distinct().count() == 14
    assert 300 < G.gnp(spark, 100, 0.1, seed=2).count() < 700


def test_component_rounds_compare_no_names(spark, monkeypatch):
    """Names (with loops, repeats and nulls) are ranked first; every round's state is numbers."""
    states, fixpoint = [], G.fixpoint

    def recorded(state, step, changes, **more):
        states.append(state)
        return fixpoint(state, step, changes, **more)

    monkeypatch.setattr(G, "fixpoint", recorded)
    e = spark.createDataFrame([("p10", "s1"), ("p9", "s1"), ("p9", "s1"), ("p2", "s7"), ("x", "x"), (None, "s3"), ("s9", "p2"), ("s7", "b")],
                              "src string, dst string")
    got = {r["id"]: r["component"] for r in G.connected_components(e).collect()}
    assert got == {"p10": "p10", "p9": "p10", "s1": "p10", "p2": "b", "s7": "b", "s9": "b", "b": "b", "x": "x", None: None, "s3": "s3"}
    assert [t for _, t in states[0].dtypes] == ["bigint", "bigint"]
