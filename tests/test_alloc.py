import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lodestar.operators import alloc as A


def sequential(queries, bids, budgets, strategy):
    """The plain loop: each query to the best-ranked bidder that can pay."""
    import math
    cur = dict(budgets)
    out = {}
    by_kw = {}
    for adv, kw, bid in bids:
        by_kw.setdefault(kw, []).append((adv, bid))
    for seq, kw in queries:
        def key(t):
            adv, bid = t
            if strategy == "greedy":
                return (-bid, adv)
            if strategy == "balance":
                return (-cur[adv], adv)
            frac = (budgets[adv] - cur[adv]) / budgets[adv]
            return (-(bid * (1 - math.exp(frac - 1))), adv)
        for adv, bid in sorted([t for t in by_kw.get(kw, []) if t[0] in cur], key=key):
            if cur[adv] >= bid:
                cur[adv] -= bid
                out[seq] = adv
                break
    return out


@pytest.mark.parametrize("strategy", ["greedy", "balance", "msvv"])
def test_allocate_matches_sequential(spark, strategy):
    rnd = random.Random(7)
    kws = [f"k{i}" for i in range(5)]
    bids = sorted({(a, k, rnd.randint(1, 4)) for a in range(6) for k in rnd.sample(kws, 3)})
    budgets = {a: rnd.randint(3, 12) for a in range(6)}
    queries = [(i, rnd.choice(kws)) for i in range(60)]
    exp = sequential(queries, [(a, k, float(b)) for a, k, b in bids], {a: float(b) for a, b in budgets.items()},
                     strategy)
    q = spark.createDataFrame(queries, "seq long, keyword string")
    b = spark.createDataFrame([(a, k, Decimal(v)) for a, k, v in bids], "advertiser int, keyword string, bid decimal(12,2)")
    bu = spark.createDataFrame([(a, Decimal(v)) for a, v in budgets.items()], "advertiser int, budget decimal(12,2)")
    got = {r["seq"]: r["advertiser"] for r in A.allocate(q, b, bu, strategy).collect()}
    assert got == exp


def test_budget_smaller_than_every_bid(spark):
    q = spark.createDataFrame([(1, "a"), (2, "a")], "seq long, keyword string")
    b = spark.createDataFrame([(1, "a", Decimal(5))], "advertiser int, keyword string, bid decimal(12,2)")
    bu = spark.createDataFrame([(1, Decimal(2))], "advertiser int, budget decimal(12,2)")
    assert A.allocate(q, b, bu, "greedy").count() == 0


def test_allocate_multi_block(spark, monkeypatch):
    monkeypatch.setattr(A, "CHUNK", 7)
    test_allocate_matches_sequential(spark, "balance")


@pytest.mark.parametrize("strategy", ["greedy", "balance", "msvv"])
def test_trials_in_one_plan(spark, monkeypatch, strategy):
    """Trials of different streams, blocks of 16 queries, against the loop;
    rounds follow the blocks with an exhausted budget."""
    monkeypatch.setattr(A, "CHUNK", 16)
    monkeypatch.setattr(A, "FOLDER", 2)
    rnd = random.Random(11)
    bids = sorted({(a, f"k{k}", rnd.randint(1, 9)) for a in range(9) for k in range(4) if rnd.random() < 0.6})
    budgets = {a: rnd.randint(5, 60) for a in range(8)}  # advertiser 8 has none
    streams = {t: [(s * 3 + t, rnd.choice(["k0", "k1", "k2", "k3", "none"])) for s in range(90 + 30 * t)] for t in range(3)}
    q = spark.createDataFrame([(t, *x) for t, rows in streams.items() for x in rows], "trial int, seq long, keyword string")
    b = spark.createDataFrame([(a, k, Decimal(v)) for a, k, v in bids], "advertiser int, keyword string, bid decimal(12,2)")
    bu = spark.createDataFrame([(a, Decimal(v)) for a, v in budgets.items()], "advertiser int, budget decimal(12,2)")
    out, rounds = A.allocate_rounds(q, b, bu, strategy, "trial")
    got = {(r["trial"], r["seq"]): r["advertiser"] for r in out.collect()}
    exp = {(t, s): a for t, rows in streams.items()
           for s, a in sequential(rows, [(a, k, float(v)) for a, k, v in bids], {a: float(v) for a, v in budgets.items()}, strategy).items()}
    assert got == exp and rounds <= -(-150 // 16) + 1


def test_rounds_follow_exhaustions(spark, monkeypatch):
    monkeypatch.setattr(A, "CHUNK", 10)
    q = spark.createDataFrame([(i, "a") for i in range(1000)], "seq long, keyword string")
    b = spark.createDataFrame([(1, "a", Decimal(2)), (2, "a", Decimal(1))], "advertiser int, keyword string, bid decimal(12,2)")
    bu = spark.createDataFrame([(1, Decimal(1001)), (2, Decimal(300))], "advertiser int, budget decimal(12,2)")
    out, rounds = A.allocate_rounds(q, b, bu)
    won = {r["advertiser"]: r["n"] for r in out.groupBy("advertiser").count().withColumnRenamed("count", "n").collect()}
    assert won == {1: 500, 2: 300} and rounds <= 4
    with pytest.raises(A.NotConverged):
        A.allocate_rounds(q, b, bu, max_rounds=1)


def test_trial_without_sales(spark):
    q = spark.createDataFrame([(1, "a"), (2, "b")], "seq long, keyword string")
    b = spark.createDataFrame([(1, "a", Decimal(5))], "advertiser int, keyword string, bid decimal(12,2)")
    bu = spark.createDataFrame([(1, Decimal(2))], "advertiser int, budget decimal(12,2)")
    assert sorted(map(tuple, A.trial_revenues(q, b, bu, 2).collect())) == [(0, 0), (1, 0)]


@pytest.mark.parametrize("strategy", ["greedy", "balance", "msvv"])
def test_rounds_end_where_the_lists_end(spark, monkeypatch, strategy):
    """Lists of few bidders, in blocks of few queries, give what the plain loop
    gives; with lists of all bidders a round settles many blocks (F13, F14, F16, F19)."""
    rnd = random.Random(11)
    bids = [(a, k, rnd.randint(1, 4)) for a in range(30) for k in ("x", "y", "z")]
    budgets = {a: rnd.randint(3, 12) for a in range(30)}
    queries = [(i, rnd.choice("xyz")) for i in range(60)]
    exp = sequential(queries, [(a, k, float(b)) for a, k, b in bids], {a: float(b) for a, b in budgets.items()}, strategy)
    q = spark.createDataFrame(queries, "seq long, keyword string")
    b = spark.createDataFrame([(a, k, Decimal(v)) for a, k, v in bids], "advertiser int, keyword string, bid decimal(12,2)")
    bu = spark.createDataFrame([(a, Decimal(v)) for a, v in budgets.items()], "advertiser int, budget decimal(12,2)")
    monkeypatch.setattr(A, "CHUNK", 10)
    out, rounds = A.allocate_rounds(q, b, bu, strategy)
    assert {r["seq"]: r["advertiser"] for r in out.collect()} == exp
    assert rounds <= 2
    monkeypatch.setattr(A, "OFFERS", 36)
    monkeypatch.setattr(A, "LEAST", 5)
    out, more = A.allocate_rounds(q, b, bu, strategy)
    rows = out.collect()
    assert len(rows) == len(exp) and {r["seq"]: r["advertiser"] for r in rows} == exp
    assert more > rounds
