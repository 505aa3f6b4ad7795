"""Embedding trainers against a plain loop, and what they learn."""

import math
import random

import numpy as np
import pytest

from lodestar.operators import embed as E
from lodestar.operators import vectors as V


def loop(docs, words, pool_by_epoch, c, start=None):
    """One shard, position by position, with plain sums."""
    index = {w: i for i, w in enumerate(words)}
    vin = [E.first_vector(c.dim, c.seed, "word", w) for w in words] if start is None else [np.array(v) for v in start[0]]
    vout = [np.zeros(c.dim) for _ in words] if start is None else [np.array(v) for v in start[1]]
    vec = {i: E.first_vector(c.dim, c.seed, "doc", i) for i, _ in docs}
    total, losses = sum(len(ws) for _, ws in docs), []
    for epoch in range(c.epochs):
        done = loss = n = 0
        for i, ws in sorted(docs):
            rng = E.generator(c.seed, epoch, i)
            idx = [index[w] for w in ws if w in index]
            alpha = max(c.min_alpha, c.alpha - (c.alpha - c.min_alpha) * (epoch + done / total) / c.epochs)
            done += len(ws)
            for p, target in enumerate(idx):
                ctx = []
                if c.mode != "dbow":
                    reach = c.window - int(rng.integers(0, c.window, 1)[0])
                    ctx = [idx[q] for q in range(p - reach, p + reach + 1) if q != p and 0 <= q < len(idx)]
                if c.mode == "sg":
                    cases = [[x] for x in ctx]
                elif c.mode == "cbow":
                    cases = [ctx] if ctx else []
                else:
                    cases = [ctx]
                pool = pool_by_epoch[epoch]
                if not cases:
                    continue
                noise = [[pool[k] for k in row] for row in rng.integers(0, len(pool), (len(cases), c.negative))]
                hs, outs, errs = [], [], []
                for ins, ns in zip(cases, noise):  # a position's cases see the same parameters
                    parts = [vin[x] for x in ins] + ([vec[i]] if c.documents else [])
                    h = sum(parts) / (len(parts) if c.mean else 1)
                    err, upd = np.zeros(c.dim), []
                    for k, o in enumerate([target, *ns]):
                        if k and o == target:
                            continue
                        x = float(h @ vout[o])
                        f = 1 / (1 + math.exp(-x))
                        loss -= math.log(f if k == 0 else 1 - f)
                        g = ((k == 0) - f) * alpha
                        err = err + g * vout[o]
                        upd.append((o, g * h))
                    n += 1
                    outs.append(upd)
                    errs.append(err)
                for ins, upd, err in zip(cases, outs, errs):
                    if not c.frozen:
                        for o, d in upd:
                            vout[o] = vout[o] + d
                        for x in ins:
                            vin[x] = vin[x] + err
                    if c.documents:
                        vec[i] = vec[i] + err
        losses.append(loss / max(n, 1))
    return vin, vout, vec, losses


def texts(rng, n, vocabulary):
    return [rng.choices(vocabulary, k=rng.randint(0, 25)) for _ in range(n)]


def pools(spark, emb_words, n_epochs, c):
    from lodestar.operators.text import build_vocab
    noise = E._noise_slices(build_vocab(emb_words.select("word", "n"), 0))
    out = []
    for e in range(n_epochs):
        times = {r["word"]: r["times"] for r in E._pool(spark, noise, 1, c, e).collect()}
        out.append(times)
    return out


@pytest.mark.parametrize("mode,frozen,mean", [("cbow", False, True), ("sg", False, False), ("dbow", False, True),
                                              ("dm", False, False), ("dbow", True, True), ("dm", True, True)])
def test_one_shard_equals_the_loop(spark, mode, frozen, mean):
    rng = random.Random(2)
    docs = [(i, ws) for i, ws in enumerate(texts(rng, 12, [f"w{k}" for k in range(9)] + ["rare"] * 0))]
    docs += [(50, []), (51, ["unknown"]), (52, ["w1"])]
    c = E.Config(mode=mode, dim=6, window=3, negative=3, epochs=2, min_count=2, mean=mean, batch=1, pool=40, seed=7, frozen=frozen)
    df = spark.createDataFrame(docs, "doc_id long, tokens array<string>").repartition(3)
    given = start = None
    if frozen:
        base = E.train(df, mode="cbow", dim=6, epochs=1, min_count=2, pool=40)
        given = base.words
        rows = sorted(given.collect())
        start = [r["vin"] for r in rows], [r["vout"] for r in rows]
    got = E.train(df, c, given)
    words = sorted(r["word"] for r in got.words.collect())
    index = {w: i for i, w in enumerate(words)}
    pool = [[index[w] for w in words for _ in range(t.get(w, 0))] for t in pools(spark, got.words, 2, c)]
    assert all(len(p) == 40 for p in pool)
    vin, vout, vec, losses = loop(docs, words, pool, c, start)
    assert got.losses == pytest.approx(losses, abs=1e-9)
    for r in got.words.collect():
        assert r["vin"] == pytest.approx(list(vin[index[r["word"]]]), abs=1e-9)
        assert r["vout"] == pytest.approx(list(vout[index[r["word"]]]), abs=1e-9)
    if c.documents:
        mine = {r["doc_id"]: r["vec"] for r in got.docs.collect()}
        assert sorted(mine) == [i for i, _ in docs]
        for i, v in mine.items():
            assert v == pytest.approx(list(vec[i]), abs=1e-9)


@pytest.mark.parametrize("mode", ["cbow", "sg"])
def test_synonyms_are_neighbours(spark, mode):
    """x0 and x1 stand in the same surroundings, so do y0 and y1; many shards."""
    rng = random.Random(5)
    rows = []
    for i in range(400):
        kind = rng.choice("xy")
        words = []
        for _ in range(12):
            words += [f"{kind}{rng.randint(0, 1)}", f"{kind}ctx{rng.randint(0, 4)}", f"{kind}ctx{rng.randint(0, 4)}"]
        rows.append((i, words))
    df = spark.createDataFrame(rows, "doc_id long, tokens array<string>")
    got = E.train(df, mode=mode, dim=16, window=3, epochs=5, alpha=0.2 if mode == "cbow" else 0.05, min_count=1, pool=500, shard_tokens=6000, batch=8)
    assert all(a > b for a, b in zip(got.losses, got.losses[1:]))
    vecs = got.words.selectExpr("word key", "vin vec")
    q = spark.createDataFrame([(w, w, 1.0) for w in ("x0", "x1", "y0", "y1")], "qid string, key string, weight double")
    best = {r["qid"]: {s["key"] for s in V.most_similar(vecs, q, 3).collect() if s["qid"] == r["qid"]} for r in q.collect()}
    assert all(w[0] + str(1 - int(w[1])) in ks for w, ks in best.items()), best


@pytest.mark.parametrize("mode", ["dbow", "dm"])
def test_document_vectors_tell_topics(spark, mode):
    rng = random.Random(8)
    topics = [[f"a{k}" for k in range(12)], [f"b{k}" for k in range(12)]]
    rows = [(i, rng.choices(topics[i % 2], k=40)) for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, tokens array<string>")
    got = E.train(df, mode=mode, dim=12, window=3, epochs=8, alpha=0.15, min_count=1, pool=400, shard_tokens=800, batch=8)
    assert got.losses[-1] < got.losses[0]
    vecs = {r["doc_id"]: np.array(r["vec"]) for r in got.docs.collect()}
    held = E.infer(df, got.words, mode="dbow", dim=12, epochs=8, alpha=0.15, pool=400, shard_tokens=800)
    frozen = {r["doc_id"]: np.array(r["vec"]) for r in held.collect()}
    for table in (vecs, frozen):
        x = np.stack([table[i] / np.linalg.norm(table[i]) for i in range(80)])
        near = x @ x.T - 2 * np.eye(80)
        assert np.mean([int(near[i].argmax()) % 2 == i % 2 for i in range(80)]) > 0.9


def test_empty_and_null_documents(spark):
    df = spark.createDataFrame([(1, None), (None, ["a"]), (3, [])], "doc_id long, tokens array<string>")
    got = E.train(df, mode="dm", dim=4, epochs=2, min_count=1, pool=5)
    assert sorted(str(r["doc_id"]) for r in got.docs.collect()) == ["1", "3", "None"]
    assert E.train(df.limit(0), mode="cbow", dim=4, epochs=1).words.count() == 0
    with pytest.raises(ValueError):
        E.train(df, mode="dm", frozen=True)


def test_a_group_of_shards_is_its_shards(spark, monkeypatch):
    rng = random.Random(5)
    docs = spark.createDataFrame([(i, ws) for i, ws in enumerate(texts(rng, 30, [f"w{k}" for k in range(12)]))],
                                 "doc_id long, tokens array<string>")
    c = E.Config(mode="dm", dim=4, epochs=2, min_count=1, pool=20, shard_tokens=40)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    found = []
    try:
        for partitions in ("1", "50"):  # one group of all shards, a group per shard
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            got = E.train(docs, c)
            found.append(({r["word"]: (r["vin"], r["vout"]) for r in got.words.collect()},
                          {r["doc_id"]: r["vec"] for r in got.docs.collect()}, E._shards(docs, c, "doc_id", "tokens")[1:]))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    (a, x, one), (b, y, many) = found
    assert one[1] == 1 and many[1] == many[0] == one[0] > 3
    assert a.keys() == b.keys() and x.keys() == y.keys()
    assert all(np.allclose(a[w], b[w], atol=1e-12) for w in a) and all(np.allclose(x[i], y[i], atol=1e-12) for i in x)


def test_a_written_state_leaves_no_shuffle(spark):
    from lodestar.plans.iterate import discard, materialize

    def files():
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {found.apply(i).getName() for i in range(found.size())}

    before = files()
    out = materialize(spark.range(50_000).groupBy("id").count())
    assert not [f for f in files() - before if f.startswith("shuffle")]
    discard(out)


@pytest.mark.parametrize("mode", ["cbow", "sg", "dbow"])
@pytest.mark.parametrize("n,pool,window,batch", [(1, 7, 3, 4), (41, 9, 3, 8), (64, 5000, 5, 32), (23, 1, 2, 4), (23, 6, 1, 4)])
def test_draws_are_the_generators(mode, n, pool, window, batch):
    c = E.Config(mode=mode, window=window, negative=3, batch=batch)
    reach, noise, examples = E.draws(n, pool, c, 5, 0, "id")
    rng, step, at, done = E.generator(5, 0, "id"), E.positions(c), 0, 0
    for k, lo in enumerate(range(0, n, step)):
        p = np.arange(lo, min(lo + step, n))
        e = len(p)
        if mode != "dbow":
            r = window - rng.integers(0, window, len(p))
            assert (reach[lo:lo + len(p)] == r).all()
            if mode == "sg":
                e = sum(int(0 <= q < n and q != i) for i, x in zip(p, r) for q in range(i - x, i + x + 1))
        assert examples[k] == e
        assert (noise[at:at + e] == rng.integers(0, pool, (e, 3))).all()
        at += e
    assert at == len(noise)


@pytest.mark.parametrize("mode", ["cbow", "sg", "dbow", "dm"])
def test_shards_side_by_side_are_shards_alone(mode):
    rng = np.random.default_rng(4)
    c = E.Config(mode=mode, dim=5, window=2, negative=2, batch=4)
    rows = 6

    def shard(base, sizes):
        return ([(base + k, base + rng.integers(0, rows, s), s + 1, None) for k, s in enumerate(sizes)], base + rng.integers(0, rows, 9))

    shards = [shard(0, [3, 0, 20]), shard(rows, [1]), shard(2 * rows, [7, 30]), ([], np.zeros(0, np.int64))]
    first = rng.random((3 * rows + 1, 5)), rng.random((3 * rows + 1, 5))
    first[0][-1] = 0
    together, alone = ([m.copy() for m in first] for _ in range(2))
    vecs, loss, n = E.train_shards(shards, *together, c, 0)
    parts = [E.train_shards([s], *alone, c, 0) for s in shards]
    for a, b in zip(together, alone):
        assert np.allclose(a[:-1], b[:-1], atol=1e-12) and not np.allclose(a, first[1])
    assert loss == pytest.approx(sum(p[1] for p in parts)) and n == sum(p[2] for p in parts) > 0
    assert [len(v) for v in vecs] == [3, 1, 2, 0]
    if c.documents:
        assert all(np.allclose(x, y) for v, p in zip(vecs, parts) for x, y in zip(v, p[0][0]))


def test_words_are_sent_to_few_groups(spark):
    """Every group is sent most words: no more groups than tasks at a time,
    however many partitions there are, until a group's shards are too many."""
    docs = spark.range(400).selectExpr("id doc_id", "array('a', 'b', cast(id AS string), cast(null AS string), 'a') tokens")
    own, n, groups = E._shards(docs, E.Config(shard_tokens=10), "doc_id", "tokens")
    assert n == 200 and groups == spark.sparkContext.defaultParallelism == own.select("grp").distinct().count()
    counts = {r["word"]: r["n"] for r in own.where("kind = 'word'").groupBy("word").sum("n").toDF("word", "n").collect()}
    assert counts == {"a": 800, "b": 400, None: 400} | {str(k): 1 for k in range(400)}
    got = E.train(docs, mode="cbow", dim=4, epochs=2, min_count=2, pool=5, shard_tokens=10)
    assert sorted((r["n"], r["word"] or "") for r in got.words.collect()) == [(400, ""), (400, "b"), (800, "a")]
