import os
import json
import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestar.functions import scalar as SC
from lodestar.functions import text as TX
from lodestar.functions import vector as V
from lodestar.operators import community as CM
from lodestar.operators import kernel as K
from lodestar.operators import recsys as R
from lodestar.operators import text as X
from lodestar.operators import vectors as VS
from lodestar.operators import walks as W
from lodestar.sources import files


def test_tokenize_and_clean(spark):
    df = spark.createDataFrame([("  The cat SAT\non a Mat  ",), ("Ça-va_bien!9 déjà",)], "t string")
    r = df.select(TX.tokenize(F.col("t")).alias("x"), TX.tokens(F.col("t")).alias("y")).collect()
    assert r[0]["x"] == ["the", "cat", "sat", "mat"]
    assert r[0]["y"] == ["The", "cat", "SAT", "on", "a", "Mat"]
    c = df.select(F.transform(TX.tokens(F.col("t")), lambda w: TX.clean_word(w)).alias("c")).collect()
    assert c[1]["c"] == ["çava_bien9", "déjà"]


def test_select_features_drops_one_class_words(spark):
    counts = spark.createDataFrame([("a", 10, 2), ("b", 10, 0), ("c", 3, 2), ("d", 1, 5)],
                                   "word string, n_pos long, n_neg long")
    got = sorted(r["word"] for r in X.select_features(counts, 100, 100).collect())
    assert got == ["a", "d"]
    kept = sorted(r["word"] for r in X.select_features(counts, 100, 100, keep_exclusive=True).collect())
    assert kept == ["a", "b", "d"]


def test_overlap_worked_example(spark):
    top = spark.createDataFrame([(1, i) for i in [1, 2, 4, 8]], "user int, item int")
    truth = spark.createDataFrame([(1, i) for i in [1, 3, 7, 8]], "user int, item int")
    sizes = spark.createDataFrame([(1, 4)], "user int, x long")
    assert R.overlap_at_x(top, truth, sizes).first()["overlap"] == 0.5


def test_split_is_partition(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")
    s = R.split(df, [0.4, 0.4, 0.2], 13, ["k"])
    counts = {r["split"]: r["count"] for r in s.groupBy("split").count().collect()}
    assert sum(counts.values()) == 2000 and set(counts) == {0, 1, 2}
    again = R.split(df.repartition(7), [0.4, 0.4, 0.2], 13, ["k"])
    assert s.exceptAll(again).count() == 0


def test_canonicalize_one_hop(spark):
    plays = spark.createDataFrame([(1, 10, 5), (1, 20, 3)], "user int, item int, plays int")
    alias = spark.createDataFrame([(10, 20), (20, 30)], "bad int, good int")
    got = sorted(tuple(r) for r in R.canonicalize(plays, alias).collect())
    assert got == [(1, 20, 5), (1, 30, 3)]


def test_vector_functions(spark):
    df = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0]), ([0.0, 0.0], [1.0, 0.0])], "a array<double>, b array<double>")
    r = df.select(V.cosine("a", "b").alias("c"), V.l2_normalize("a").alias("u"),
                  V.pattern_similarity("a", "b").alias("p")).collect()
    assert r[0]["c"] == pytest.approx(24 / 25)
    assert r[0]["u"] == pytest.approx([0.6, 0.8])
    assert r[1]["c"] is None and r[1]["u"] == [0.0, 0.0]
    # (n-1)/n * Pearson r: two points, r = -1 -> -0.5
    assert r[0]["p"] == pytest.approx(-0.5)


def test_most_similar_and_odd_one_out(spark):
    vecs = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.9, 0.1]), ("c", [0.0, 1.0]), ("d", [0.8, 0.2])],
                                 "key string, vec array<double>")
    q = spark.createDataFrame([(0, "a", 1.0)], "qid int, key string, weight double")
    top = [r["key"] for r in VS.most_similar(vecs, q, topn=2).orderBy("rank").collect()]
    assert top == ["b", "d"]
    g = spark.createDataFrame([(0, "a"), (0, "b"), (0, "c"), (0, "zzz")], "qid int, key string")
    assert VS.doesnt_match(vecs, g).first()["odd"] == "c"


def test_most_similar_with_blocks_without_queries(spark):
    vecs = spark.createDataFrame([(f"k{i}", [float(i + 1), 1.0]) for i in range(40)], "key string, vec array<double>")
    q = spark.createDataFrame([(i, f"k{i}", 1.0) for i in range(8)], "qid long, key string, weight double")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "100")  # up to ten blocks a side
    try:
        for search in (VS.most_similar, VS.most_similar_cosmul):
            assert {r["qid"] for r in search(vecs, q, topn=1).collect()} == set(range(8))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_argmax_star_ties_and_nulls(spark):
    s = spark.createDataFrame([(1, 1, 0.5), (1, 2, 0.5), (1, 3, 0.1), (2, 1, -1.0), (2, 2, -1.0)],
                              "user int, star int, score double")
    got = {r["user"]: r["pred"] for r in W.argmax_star(s, ["user"]).collect()}
    assert got == {1: 1, 2: None}


def test_predict_rating_moves_no_pair_per_star(spark):
    vecs = spark.createDataFrame([("u1", [1.0, 0.0]), ("u2", [0.0, 1.0]), ("u3", [0.0, 0.0]), ("m7_1", [0.9, 0.1]),
                                  ("m7_4", [0.1, 0.9]), ("m8_2", [1.0, 0.0]), ("m8_3", [1.0, 0.0])], "key string, vec array<double>")
    pairs = spark.createDataFrame([(1, 7, 1.0), (1, 7, 1.0), (2, 7, 4.0), (3, 7, 2.0), (1, 8, 5.0), (1, 9, 5.0), (None, 7, 1.0)],
                                  "user long, movie long, rating double")
    got = W.predict_rating(vecs, pairs)
    want = [(1, 7, 1), (1, 7, 1), (2, 7, 4), (3, 7, None), (1, 8, 2), (1, 9, None), (None, 7, None)]
    assert sorted(map(str, ((r["user"], r["movie"], r["pred"]) for r in got.collect()))) == sorted(map(str, want))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode") == 1  # the movies' stars, once


def test_modularity_small(spark):
    # two triangles joined by one edge, split in the obvious way
    e = [(0, 1), (1, 2), (0, 2), (3, 4), (4, 5), (3, 5), (2, 3)]
    edges = spark.createDataFrame([(a, b, 1.0) for a, b in e], "src long, dst long, weight double")
    mem = spark.createDataFrame([(i, 0 if i < 3 else 1) for i in range(6)], "id long, community long")
    m = 7.0
    deg = {i: sum(1 for a, b in e if i in (a, b)) for i in range(6)}
    q = sum(3 / m - (sum(deg[i] for i in c) / (2 * m)) ** 2 for c in [(0, 1, 2), (3, 4, 5)])
    assert CM.modularity(edges, mem).first()["q"] == pytest.approx(q)
    v = spark.createDataFrame([(i, [1.0, float(i)]) for i in range(6)], "id long, attrs array<double>")
    lm, rounds = CM.local_moving(v, edges, alpha=1.0)
    labels = {r["id"]: r["community"] for r in lm.collect()}
    assert set(labels) == set(range(6)) and rounds <= 15
    rel = {r["id"]: r["community"] for r in CM.relabel(mem.withColumn("community", F.col("community") + 7)).collect()}
    assert rel == {i: (0 if i < 3 else 1) for i in range(6)}


def test_ridge_closed_form_and_sgd(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(0, 1, 200)
    y = 0.3 + 10 * x + rng.normal(0, 0.1, 200)
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(zip(x, y))], "rid long, x double, y double")
    coef = K.ols_fit(df, "y", ["x"], l2=0.1)
    X1 = np.c_[np.ones(200), x]
    assert coef == pytest.approx(np.linalg.solve(X1.T @ X1 / 200 + 0.1 * np.eye(2), X1.T @ y / 200))
    sgd = K.RidgeSGD(lr=0.2, l2=0.1, batch=200, epochs=30, seed=100).fit(df, "y", ["x"], "rid")
    assert sgd.w == pytest.approx(coef, abs=0.05)


def test_kernel_regress_small(spark):
    tr = spark.createDataFrame([(1, [1.0, 2.0, 3.0], 1.0), (2, [3.0, 2.0, 1.0], 0.0)], "id long, x array<double>, y double")
    te = spark.createDataFrame([(9, [1.0, 2.0, 4.0])], "id long, x array<double>")
    got = K.kernel_regress(te, tr, c=2.0, block=1).first()["pred"]
    def sim(a, b):
        a, b = np.array(a), np.array(b)
        return ((a - a.mean()) * (b - b.mean())).sum() / (len(a) * a.std(ddof=1) * b.std(ddof=1))
    w1, w2 = np.exp(2 * sim([1, 2, 4], [1, 2, 3])), np.exp(2 * sim([1, 2, 4], [3, 2, 1]))
    assert got == pytest.approx(w1 / (w1 + w2))


def test_scalars(spark):
    df = spark.createDataFrame([(0.5, 10.0, 4.0, 1.239)], "r double, b double, c double, p double")
    r = df.select(SC.round_star(F.col("r")).alias("s"), SC.trunc2(F.col("p")).alias("t"),
                  SC.scaled_bid(F.col("b"), F.lit(20.0), F.col("c")).alias("sb")).first()
    assert r["s"] == 1 and r["t"] == 1.23
    assert r["sb"] == pytest.approx(10 * (1 - np.exp((20 - 4) / 20 - 1)))


def test_file_round_trips(spark):
    d = tempfile.mkdtemp(prefix="lodestar-io-")
    adj = spark.createDataFrame([("1", ["2", "3"]), ("2", ["1"])], "id string, neighbors array<string>")
    files.write_adjacency(adj, f"{d}/adj")
    e = sorted(tuple(r) for r in files.read_adjacency(spark, f"{d}/adj").collect())
    assert e == [("1", "2"), ("1", "3"), ("2", "1")]
    mem = spark.createDataFrame([(1, 0), (2, 0), (3, 1)], "id long, community long")
    files.write_communities(mem, f"{d}/comm")
    back = files.read_communities(spark, f"{d}/comm")
    groups = sorted(sorted(int(r["id"]) for r in back.where(F.col("community") == c).collect())
                    for c in [r[0] for r in back.select("community").distinct().collect()])
    assert groups == [[1, 2], [3]]
    vec = spark.createDataFrame([("a", [1.0, 2.0], 5), ("b", [0.5, 0.25], 9)], "word string, vec array<float>, count long")
    files.write_vectors(vec, f"{d}/vec")
    rv = files.read_vectors(spark, f"{d}/vec")
    got = {r["word"]: list(r["vec"]) for r in rv.collect()}
    assert got == {"a": [1.0, 2.0], "b": [0.5, 0.25]}
    with open(f"{d}/q.txt", "w") as f:
        f.write(": capital\nathens greece paris france\nbad line\n: family\nboy girl son daughter\n")
    q = {r["a"]: r["section"] for r in files.read_analogies(spark, f"{d}/q.txt").collect()}
    assert q == {"athens": "capital", "boy": "family"}
    with open(f"{d}/big.graph", "w") as f:
        f.write("3 2\na b\nb c\n")
    e2 = sorted(tuple(r) for r in files.read_edges(spark, f"{d}/big.graph", sep=" ", header_lines=1).collect())
    assert e2 == [("a", "b"), ("b", "c")]


def test_walks_follow_edges(spark):
    e = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (3, 4)], "src long, dst long")
    w = W.random_walks(e, n_walks=2, length=6, seed=3).collect()
    und = {(1, 2), (2, 3), (3, 1), (3, 4)}
    und |= {(b, a) for a, b in und}
    assert len(w) == 8
    for r in w:
        assert r["walk"][0] == r["start"] and len(r["walk"]) == 6
        assert all((a, b) in und for a, b in zip(r["walk"], r["walk"][1:]))


def test_noise_distribution_and_vocab(spark):
    c = spark.createDataFrame([("a", 8), ("b", 8), ("c", 1), ("d", 27)], "word string, n long")
    v = X.build_vocab(c, min_count=2)
    assert [r["word"] for r in v.orderBy("idx").collect()] == ["d", "a", "b"]
    nd = X.noise_distribution(v).orderBy("idx").collect()
    assert nd[-1]["cum"] == pytest.approx(1.0)


def test_analogy_accuracy(spark):
    vecs = spark.createDataFrame([("king", [1.0, 1.0]), ("man", [1.0, 0.0]), ("woman", [0.0, 1.0]),
                                  ("queen", [0.1, 2.0]), ("apple", [-1.0, -0.2])], "key string, vec array<double>")
    counts = spark.createDataFrame([("king", 5), ("man", 9), ("woman", 8), ("queen", 4), ("apple", 1)],
                                   "key string, n long")
    q = spark.createDataFrame([(1, "royal", "man", "king", "woman", "queen"),
                               (2, "royal", "man", "king", "woman", "apple"),
                               (3, "other", "man", "zzz", "woman", "queen")],
                              "line_no long, section string, a string, b string, c string, expected string")
    got = {r["section"]: (r["correct"], r["total"]) for r in VS.analogy_accuracy(vecs, q, counts).collect()}
    # b - a + c = king - man + woman = (0, 2): nearest non-input word is queen
    assert got["royal"] == (1, 2) and got["total"] == (1, 2) and "other" not in got


def test_generators_and_coo(spark):
    from lodestar.operators import graph as G
    assert G.complete(spark, 5).count() == 10
    assert G.gnm(spark, 20, 7, seed=1).count() == 7
    p = G.gnp(spark, 60, 0.2, seed=2).count()
    assert 0.1 * 1770 < p < 0.3 * 1770
    coo = spark.createDataFrame([(0, 1, 2.0), (1, 0, 5.0), (2, 2, 1.0)], "row long, col long, value double")
    assert sorted(tuple(r) for r in G.edges_from_coo(coo).collect()) == [(0, 1), (1, 0), (2, 2)]


def test_permute_is_bijection(spark):
    from lodestar.operators.alloc import permute
    q = spark.createDataFrame([(i, "k") for i in range(1, 41)], "seq long, keyword string")
    p = permute(q, trials=3, seed=5)
    for t in range(3):
        seqs = sorted(r["seq"] for r in p.where(F.col("trial") == t).collect())
        assert seqs == list(range(1, 41))
    orders = {tuple(r["seq"] for r in p.where(F.col("trial") == t).orderBy("seq").select("seq").collect())
              for t in range(3)}
    assert len(orders) == 1  # same positions, different query assignment per trial


def test_text_readers_and_sinks(spark):
    d = tempfile.mkdtemp(prefix="lodestar-io2-")
    with open(f"{d}/ratings.tsv", "w") as f:
        f.write("userID\tmovieID\trating\n1\t10\t3.5\n2\t11\tbad\n")
    r = files.read_delimited(spark, f"{d}/ratings.tsv", "\t", ["user", "movie", "rating"],
                             ["long", "long", "double"], skip_header=True).orderBy("user").collect()
    assert [tuple(x) for x in r] == [(1, 10, 3.5), (2, 11, None)]
    with open(f"{d}/docs.txt", "w") as f:
        f.write("a b c\n\nd e\n")
    docs = files.read_lines(spark, f"{d}/docs.txt", tag_prefix="TRAIN").orderBy("doc_id").collect()
    assert [x["tokens"] for x in docs] == [["a", "b", "c"], [], ["d", "e"]]
    assert docs[2]["tags"] == ["TRAIN_2"]
    with open(f"{d}/tagged.txt", "w") as f:
        f.write("The/DT Cat/NN ,/, 9/CD\n./.\n")
    t = files.read_tagged_corpus(spark, f"{d}/tagged.txt").collect()
    assert [x["tokens"] for x in t] == [["the", "cat", "9"]]  # tags DT, NN, CD kept; "," dropped
    msgs = spark.createDataFrame([("hi there",), ('say "x"',)], "value string")
    files.write_messages(msgs, f"{d}/raw")
    files.write_messages(msgs, f"{d}/json", encode="json")
    assert sorted(r[0] for r in spark.read.text(f"{d}/raw").collect()) == ["hi there", 'say "x"']
    back = [json.loads(r[0]) for r in spark.read.text(f"{d}/json").collect()]
    assert sorted(back) == ["hi there", 'say "x"']
    walks = spark.createDataFrame([(0, [1, 2, 3]), (1, [2, 3])], "pass int, walk array<long>")
    w = files.write_walks(walks, f"{d}/walks")
    assert sorted(x["tokens"] for x in w.collect()) == [["1", "2", "3"], ["2", "3"]]
    again = files.write_walks(walks, f"{d}/walks", rebuild=False)
    assert again.count() == 2


def test_vector_files(spark):
    d = tempfile.mkdtemp(prefix="lodestar-vec-")
    v = spark.createDataFrame([(f"w{i}", [float(i), 0.5], 100 - i) for i in range(40)], "word string, vec array<float>, count long")
    files.write_vectors(v, f"{d}/v")
    back = {r["word"]: (r["vec"], r["count"]) for r in files.read_vectors(spark, f"{d}/v").collect()}
    assert back == {f"w{i}": ([float(i), 0.5], 40 - i) for i in range(40)}
    os.makedirs(f"{d}/two")
    for name, rows in (("a", "2 2\nx 1 2\ny 3 4\n"), ("b", "2 2\nz 5 6\nq 7 8\n")):
        with open(f"{d}/two/{name}.txt", "w") as f:
            f.write(rows)
    assert sorted((r["word"], r["count"]) for r in files.read_vectors(spark, f"{d}/two").collect()) == [
        ("q", 1), ("x", 4), ("y", 3), ("z", 2)]
    with open(f"{d}/bad.txt", "w") as f:
        f.write("2 2\nx 1 2\ny 3\n")
    with pytest.raises(Exception, match="wrong length"):
        files.read_vectors(spark, f"{d}/bad.txt").collect()


def test_edge_header_questions_models(spark):
    d = tempfile.mkdtemp(prefix="lodestar-io3-")
    with open(f"{d}/e.txt", "w") as f:
        f.write("3 2\n1 2\n2 3\n")
    e = files.read_edges(spark, f"{d}/e.txt", sep=" ", header_lines=1, as_long=True)
    assert sorted(map(tuple, e.collect())) == [(1, 2), (2, 3)]
    with open(f"{d}/ws.txt", "w") as f:
        f.write("1\t2\n2   1\n3 3\n")
    assert sorted(map(tuple, files.read_edges(spark, f"{d}/ws.txt", sep=r"\s+", undirected=True).collect())) == [("1", "2"), ("2", "1")]
    with open(f"{d}/q.txt", "w") as f:
        f.write("a b c d\n: s\nE F G H\n")
    with pytest.raises(Exception, match="before any section"):
        files.read_analogies(spark, f"{d}/q.txt").collect()
    nodes = spark.createDataFrame([(1, "x", "user")], "id long, name string, type string")
    files.write_nodes(nodes, f"{d}/nodes")
    assert spark.read.text(f"{d}/nodes").first()[0] == "1\tx\tuser"
    files.write_table(nodes, f"{d}/csv")
    assert files.read_table(spark, f"{d}/csv", nodes.schema).collect() == nodes.collect()
    files.save_model(f"{d}/m", nodes=nodes)
    assert files.load_model(spark, f"{d}/m", "nodes")["nodes"].collect() == nodes.collect()


def test_dense_classifiers(spark):
    from pyspark.ml.functions import array_to_vector
    from lodestar.operators import classify as C
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(0, 1, (60, 3)), rng.normal(1, 2, (40, 3))])
    y = [0] * 60 + [1] * 40
    df = spark.createDataFrame([(i, list(map(float, r)), c) for i, (r, c) in enumerate(zip(x, y))], "doc_id long, x array<double>, label int")
    pred = {r["doc_id"]: r["pred"] for r in C.predict_gaussian_nb_dense(C.fit_gaussian_nb_dense(df), df).collect()}
    eps = 1e-9 * x.var(0).max()
    ll = np.stack([np.log(len(p) / 100) - 0.5 * (np.log(2 * np.pi * (p.var(0) + eps)) + (x - p.mean(0)) ** 2 / (p.var(0) + eps)).sum(1)
                   for p in (x[:60], x[60:])], 1)
    assert [pred[i] for i in range(100)] == ll.argmax(1).tolist()
    m = C.fit_logistic(df.select("label", array_to_vector("x").alias("features")), "features", "label")
    w, b = m.coefficients.toArray(), m.intercept
    p = 1 / (1 + np.exp(-(x @ w + b)))
    # gradient of the mean loss plus the penalty 1 / (C n) * w
    assert np.abs(x.T @ (p - y) / 100 + w / 100).max() < 1e-4 and abs((p - y).mean()) < 1e-4


@pytest.mark.parametrize("seed", [1, 2])
def test_best_moves_equal_scoring_every_community(spark, seed):
    """30 vertices, some isolated, against the formula over all communities."""
    rng = np.random.default_rng(seed)
    n = 30
    attrs = rng.random((n, 3))
    pairs = {tuple(sorted(rng.choice(n - 4, 2, replace=False).tolist())) for _ in range(40)}  # the last four are isolated
    edges = [(a, b, float(rng.integers(1, 4))) for a, b in sorted(pairs)]
    member = {i: int(rng.integers(0, 9)) for i in range(n)}
    v = spark.createDataFrame([(i, attrs[i].tolist()) for i in range(n)], "id long, attrs array<double>")
    e = spark.createDataFrame(edges, "src long, dst long, weight double")
    mem = spark.createDataFrame(list(member.items()), "id long, community long")
    both = e.unionByName(e.selectExpr("dst as src", "src as dst", "weight"))
    unit = v.select("id", CM.l2_normalize(F.col("attrs")).alias("u"))
    got = {r["id"]: (r["community"], r["gain"]) for r in
           CM.best_moves(mem, both, CM.degrees(e), unit, 0.5, sum(w for *_, w in edges), lambda c: c % 2 == 0).collect()}
    u, m = attrs / np.linalg.norm(attrs, axis=1, keepdims=True), sum(w for *_, w in edges)
    k = {i: sum(w for a, b, w in edges if i in (a, b)) for i in range(n)}
    want = {}
    for x in range(0, n, 2):
        best = (0.0, None)
        for c in sorted({member[i] for i in range(1, n, 2)} - {member[x]}):
            inside = [i for i in range(n) if member[i] == c]
            to = {t: sum(w for a, b, w in edges if x in (a, b) and member[a if b == x else b] == t and a != b) for t in (c, member[x])}
            d = {t: sum(k[i] for i in range(n) if member[i] == t) for t in (c, member[x])}
            dq = (to[c] - to[member[x]]) / m - k[x] * (d[c] - d[member[x]] + k[x]) / (2 * m * m)
            gain = 0.5 * dq + 0.5 * float(np.mean([u[x] @ u[i] for i in inside]))
            if gain > best[0] + 1e-12:
                best = gain, c
        if best[1] is not None:
            want[x] = best[1], best[0]
    assert {i: c for i, (c, _) in got.items()} == {i: c for i, (c, _) in want.items()} and any(i >= n - 4 for i in got)
    assert all(g == pytest.approx(want[i][1]) for i, (_, g) in got.items())


def test_local_moving_limit(spark):
    v = spark.createDataFrame([(i, [1.0, float(i)]) for i in range(6)], "id long, attrs array<double>")
    e = spark.createDataFrame([(0, 1, 1.0), (2, 3, 1.0), (4, 5, 1.0)], "src long, dst long, weight double")
    with pytest.raises(CM.NotConverged):
        CM.local_moving(v, e, alpha=0.5, sweeps=1, strict=True)


def test_als_top_x_is_exact_without_a_product_of_rows(spark, monkeypatch):
    rng = np.random.default_rng(3)
    plays = [(int(a), int(b), int(rng.integers(1, 9))) for a, b in {(rng.integers(0, 40), rng.integers(0, 300)) for _ in range(1500)}]
    train = spark.createDataFrame(plays, "user long, item long, plays long")
    sizes = spark.createDataFrame([(a, 1 + a % 7 if a else 290) for a in range(39)] + [(77, 3)], "user long, x long")  # 77 has no factors
    model = R.fit_als(train, rank=4)
    monkeypatch.setattr(R, "ITEMS", 90)
    monkeypatch.setattr(R, "USERS", 16)
    top = R.als_top_x(model, train, sizes)
    got = {}
    for r in sorted(top.collect(), key=lambda r: r["rank"]):
        got.setdefault(r["user"], []).append((r["item"], r["score"]))
    u, v = ({r["id"]: np.array(r["features"]) for r in f.collect()} for f in (model.userFactors, model.itemFactors))
    seen = {(a, b) for a, b, _ in plays}
    for a in range(39):
        scores = sorted(((-float(np.float32((u[a] * v[b]).sum())), b) for b in v if (a, b) not in seen))[:1 + a % 7 if a else 290]
        assert [b for b, _ in got[a]] == [b for _, b in scores]
        assert np.allclose([s for _, s in got[a]], [-s for s, _ in scores])
    assert 77 not in got
    plan = top._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_seen_items_go_to_the_block_that_scores_them():
    """What users have seen comes as pairs, of this block's items only: also of
    users that stand twice or are not there, and of items that are not there."""
    import pyarrow as pa
    rng = np.random.default_rng(8)
    u, v = rng.normal(size=(5, 3)).astype(np.float32), rng.normal(size=(40, 3)).astype(np.float32)
    names, x, ids = [7, 3, 9, 3, 11], [4, 2, 40, 5, 1], rng.permutation(100)[:40]
    users = pa.table({"user": pa.array(names, pa.int32()), "x": pa.array(x, pa.int64()), "features": pa.array(u.tolist(), pa.list_(pa.float32()))})
    items = pa.table({"item": pa.array(ids, pa.int32()), "features": pa.array(v.tolist(), pa.list_(pa.float32()))})
    pairs = [(n, int(i)) for n in (3, 7, 9, 50) for i in rng.choice(100, 30, replace=False)]
    seen = tuple(np.array(c, np.int32) for c in zip(*pairs))
    got = R._best_unseen(users, items, "user", "item", seen)
    want = []
    for n, k, w in zip(names, x, u.astype(float)):
        best = sorted(((-np.float32((w * v[j]).sum()), int(ids[j])) for j in range(40) if (n, int(ids[j])) not in set(pairs)))[:k]
        want += [(n, i) for _, i in best]
    assert sorted(zip(got.column("user").to_pylist(), got.column("item").to_pylist())) == sorted(want)


def test_local_moving_blocks_are_large_and_multiplied_in_strips(spark, monkeypatch):
    """A row is sent once per block of the other side, so blocks have some
    millions of numbers; strips of any size give the same moves."""
    seen, apply = [], CM.block_apply

    def recorded(a, b, a_keys, b_keys, func, schema, block=2048, **more):
        seen.append(block)
        return apply(a, b, a_keys, b_keys, func, schema, block, **more)

    monkeypatch.setattr(CM, "block_apply", recorded)
    rng = np.random.default_rng(4)
    v = spark.createDataFrame([(i, rng.random(8).tolist()) for i in range(60)], "id long, attrs array<double>")
    e = spark.createDataFrame([(i, i + 1, 1.0) for i in range(0, 58, 2)], "src long, dst long, weight double")
    whole = {tuple(r) for r in CM.local_moving(v, e, 0.5, sweeps=1)[0].collect()}
    monkeypatch.setattr(CM, "STRIP", 7)
    assert {tuple(r) for r in CM.local_moving(v, e, 0.5, sweeps=1)[0].collect()} == whole and len(whole) == 60
    assert len({c for _, c in whole}) < 60 and min(seen) * 8 >= 1 << 21


@pytest.mark.parametrize("hot", [1 << 16, 4])
def test_subsample_moves_no_tokens_of_frequent_words_and_broadcasts_none(spark, monkeypatch, hot):
    monkeypatch.setattr(X, "HOT", hot, raising=False)
    rng = np.random.default_rng(5)
    lines = [[f"w{int(w)}" for w in rng.zipf(1.4, 30) % 60] for _ in range(40)]
    docs = spark.createDataFrame([(i if i % 9 else None, x) for i, x in enumerate(lines)] + [(2, lines[2]), (99, None)],
                                 "doc_id long, tokens array<string>")
    count = {f"w{i}": 5 + 900 // (i + 1) for i in range(55)} | {f"other{i}": 5 for i in range(3000)}
    vocab = spark.createDataFrame(list(count.items()), "word string, n long")
    out = X.subsample(docs, vocab)
    rows = [tuple(r) for r in out.collect()]
    want = {}
    for i, x in list(enumerate(lines)) + [(2, lines[2])]:
        want.setdefault(i if i % 9 else None, []).extend((p, w) for p, w in enumerate(x) if w in count)
    assert sorted(rows, key=str) == sorted(((i, [w for _, w in sorted(x)]) for i, x in want.items()), key=str)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BuildRight" in plan and "BuildLeft" not in plan  # the tokens are not the side that is sent around


def test_a_length_is_worked_out_once_a_vector(spark):
    from pyspark.sql import functions as F

    from lodestar.functions.vector import l2_normalize
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],), ([],), (None,), ([2.0, None],)], "v array<double>")
    unit = df.select(l2_normalize(F.col("v")).alias("u"))
    assert unit._jdf.queryExecution().optimizedPlan().toString().count("aggregate(") == 1
    assert [r["u"] for r in unit.collect()] == [[0.6, 0.8], [0.0, 0.0], [], None, [None, None]]
