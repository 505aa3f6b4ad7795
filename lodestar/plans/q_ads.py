"""Ad allocation queries on the bids stand-in (supplier x brand)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.functions.scalar import scaled_bid
from lodestar.operators import alloc as A
from lodestar.plans.registry import query
from lodestar.sources import standins as S
from lodestar.sources.tables import Tables

BASE_SQL = f"""q AS ({S.AD_QUERIES_SQL}), b AS ({S.BIDS_SQL}), bu AS ({S.BUDGETS_SQL})"""


def _parts(spark, d):
    t = Tables(spark, d)
    return S.ad_queries(t), S.bids(t), S.budgets(t)


@query("candidate_bids", f"""WITH {BASE_SQL}
SELECT q.seq, count(*) AS n_bidders, CAST(max(b.bid) AS DOUBLE) AS max_bid FROM q JOIN b ON b.keyword = q.keyword GROUP BY q.seq""")
def candidate_bids(spark, d):
    q, b, _ = _parts(spark, d)
    return A.bids_per_query(q, b).select("seq", "n_bidders", F.col("max_bid").cast("double").alias("max_bid"))


@query("rank_bids_greedy", f"""WITH {BASE_SQL}
SELECT seq, advertiser, CAST(bid AS DOUBLE) AS bid FROM (SELECT q.seq, b.advertiser, b.bid,
  row_number() OVER (PARTITION BY q.seq ORDER BY b.bid DESC, b.advertiser) AS rk FROM q JOIN b ON b.keyword = q.keyword)
WHERE rk = 1""")
def rank_bids_greedy(spark, d):
    q, b, _ = _parts(spark, d)
    return A.best_static_bid(q, b).select("seq", "advertiser", F.col("bid").cast("double").alias("bid"))


@query("scaled_bids", f"""WITH {BASE_SQL}
SELECT b.advertiser, b.keyword, round(CAST(b.bid AS DOUBLE) * (1 - exp((CAST(bu.budget AS DOUBLE) - (CAST(bu.budget AS DOUBLE) - CAST(b.bid AS DOUBLE)))
  / CAST(bu.budget AS DOUBLE) - 1)), 6) AS scaled FROM b JOIN bu ON bu.advertiser = b.advertiser""")
def scaled_bids(spark, d):
    """B5 with the budget left after one win of the bid."""
    _, b, bu = _parts(spark, d)
    j = b.join(bu, "advertiser")
    return j.select("advertiser", "keyword",
                    F.round(scaled_bid(F.col("bid"), F.col("budget"), F.col("budget") - F.col("bid")), 6).alias("scaled"))


@query("best_revenue", f"WITH {BASE_SQL} SELECT CAST(sum(budget) AS DOUBLE) AS best FROM bu")
def best_revenue(spark, d):
    _, _, bu = _parts(spark, d)
    return A.best_revenue(bu).select(F.col("best").cast("double"))


# spent so far: the greedy winners' bids of every other query, up to the budget
SPENT_SQL = """win AS (SELECT seq, advertiser, bid FROM (SELECT q.seq, b.advertiser, b.bid,
  row_number() OVER (PARTITION BY q.seq ORDER BY b.bid DESC, b.advertiser) AS rk FROM q JOIN b ON b.keyword = q.keyword)
  WHERE rk = 1 AND seq % 2 = 0),
sp AS (SELECT bu.advertiser, least(bu.budget, sum(bid)) AS spent FROM win JOIN bu ON bu.advertiser = win.advertiser
  GROUP BY bu.advertiser, bu.budget),
c AS (SELECT b.keyword, b.advertiser, b.bid, bu.budget, bu.budget - coalesce(sp.spent, 0) AS remaining
  FROM b JOIN bu ON bu.advertiser = b.advertiser LEFT JOIN sp ON sp.advertiser = b.advertiser)"""


def _affordable_sql(order: str) -> str:
    return f"""WITH {BASE_SQL}, {SPENT_SQL}
SELECT q.seq, t.advertiser, CAST(t.bid AS DOUBLE) AS bid FROM q JOIN (
  SELECT *, row_number() OVER (PARTITION BY keyword ORDER BY {order}, advertiser) AS rk FROM c WHERE remaining >= bid) t
ON t.keyword = q.keyword AND rk = 1"""


def _affordable(spark, d, strategy):
    q, b, bu = _parts(spark, d)
    won = A.best_static_bid(q.where("seq % 2 = 0"), b).groupBy("advertiser").agg(F.sum("bid").alias("won"))
    spent = won.join(bu, "advertiser").select("advertiser", F.least("budget", "won").alias("spent"))
    return A.best_affordable_bid(q, b, bu, spent, strategy).select(
        "seq", "advertiser", F.col("bid").cast("double").alias("bid"))


@query("rank_bids_balance", _affordable_sql("remaining DESC"))
def rank_bids_balance(spark, d):
    return _affordable(spark, d, "balance")


@query("rank_bids_msvv", _affordable_sql("""round(CAST(bid AS DOUBLE) * (1 - exp((CAST(budget AS DOUBLE)
  - CAST(remaining AS DOUBLE)) / CAST(budget AS DOUBLE) - 1)), 9) DESC"""))
def rank_bids_msvv(spark, d):
    return _affordable(spark, d, "msvv")


@query("permuted_stream", f"""WITH q AS ({S.AD_QUERIES_SQL}),
t AS (SELECT seq AS old_seq, keyword, unnest(range(0, 4)) AS trial FROM q)
SELECT trial, old_seq, keyword, row_number() OVER (PARTITION BY trial
  ORDER BY md5(CAST(old_seq AS VARCHAR) || ':0:' || CAST(trial AS VARCHAR)), old_seq) AS seq FROM t""")
def permuted_stream(spark, d):
    """Four shuffled copies of the query stream."""
    q, _, _ = _parts(spark, d)
    p = A.permute(q.withColumn("old_seq", F.col("seq")), 4, seed=0)
    return p.select(F.col("trial").cast("long").alias("trial"), "old_seq", "keyword", "seq")


def _allocate_sql(pick: str, stream: str = "SELECT 0 AS trial, seq, keyword FROM q") -> str:
    """The rule query by query: the state is the list of remaining budgets; it
    ends when nobody can pay their least bid."""
    return f"""WITH RECURSIVE {BASE_SQL}, s AS ({stream}),
adv AS (SELECT advertiser, budget, row_number() OVER (ORDER BY advertiser) AS k FROM bu),
start AS (SELECT list(budget ORDER BY k) AS rem, list(CAST(budget AS DOUBLE) ORDER BY k) AS whole, list(least_bid ORDER BY k) AS least
  FROM adv LEFT JOIN (SELECT advertiser, min(bid) AS least_bid FROM b GROUP BY advertiser) USING (advertiser)),
kw AS (SELECT keyword, list(struct_pack(a := advertiser, k := k, b := bid) ORDER BY bid DESC, advertiser) AS c
  FROM b JOIN adv USING (advertiser) GROUP BY keyword),
n AS (SELECT trial, seq, keyword, row_number() OVER (PARTITION BY trial ORDER BY seq) AS rn FROM s),
run(trial, rn, seq, rem, won) AS (
  SELECT trial, 0::BIGINT, NULL::BIGINT, rem, NULL::STRUCT(a BIGINT, k BIGINT, b DECIMAL(12,2)) FROM (SELECT DISTINCT trial FROM s), start
  UNION ALL
  SELECT trial, rn, seq, CASE WHEN won IS NULL THEN rem
    ELSE list_transform(rem, lambda r, i: CASE WHEN i = won.k THEN r - won.b ELSE r END) END, won
  FROM (SELECT n.trial, n.rn, n.seq, run.rem, {pick} AS won
    FROM run JOIN n ON n.trial = run.trial AND n.rn = run.rn + 1 LEFT JOIN kw ON kw.keyword = n.keyword, start
    WHERE list_bool_or([z[1] >= z[2] FOR z IN list_zip(run.rem, least)])))"""


_FIRST = "list_filter(kw.c, lambda x: run.rem[x.k] >= x.b)[1]"


def _first_by(key: str) -> str:
    return f"""list_sort(list_transform(list_filter(kw.c, lambda x: run.rem[x.k] >= x.b),
      lambda x: struct_pack(o := -({key}), x := x)))[1].x"""


_MSVV = ("CAST(x.b AS DOUBLE) * (1.0::DOUBLE - exp((whole[x.k] - CAST(run.rem[x.k] AS DOUBLE)) / whole[x.k] - 1.0::DOUBLE))")
_WON = "\nSELECT seq, won.a AS advertiser, CAST(won.b AS DOUBLE) AS bid FROM run WHERE won IS NOT NULL"


def _allocate(spark, d, strategy):
    q, b, bu = _parts(spark, d)
    return A.allocate(q, b, bu, strategy).select("seq", "advertiser", F.col("bid").cast("double").alias("bid"))


@query("allocate_greedy", _allocate_sql(_FIRST) + _WON)
def allocate_greedy(spark, d):
    """K1: the stream in arrival order, best bid first."""
    return _allocate(spark, d, "greedy")


@query("allocate_balance", _allocate_sql(_first_by("run.rem[x.k]")) + _WON)
def allocate_balance(spark, d):
    """K1, most remaining budget first."""
    return _allocate(spark, d, "balance")


@query("allocate_msvv", _allocate_sql(_first_by(_MSVV)) + _WON)
def allocate_msvv(spark, d):
    """K1, best bid scaled by the spent share first."""
    return _allocate(spark, d, "msvv")


_TRIALS_SQL = """SELECT trial, row_number() OVER (PARTITION BY trial
  ORDER BY md5(CAST(seq AS VARCHAR) || ':0:' || CAST(trial AS VARCHAR)), seq) AS seq, keyword
  FROM (SELECT seq, keyword, unnest(range(0, 4)) AS trial FROM q)"""


@query("competitive_ratio", _allocate_sql(_FIRST, _TRIALS_SQL) + """,
r AS (SELECT trial, sum(won.b) AS revenue FROM run GROUP BY trial)
SELECT round(CAST(avg(revenue) AS DOUBLE), 6) AS mean_revenue, count(*) AS trials,
  (SELECT CAST(sum(budget) AS DOUBLE) FROM bu) AS best,
  round(CAST(avg(revenue) AS DOUBLE) / (SELECT CAST(sum(budget) AS DOUBLE) FROM bu), 6) AS ratio FROM r""")
def competitive_ratio(spark, d):
    """D18 + K2: four shuffled streams, greedy."""
    q, b, bu = _parts(spark, d)
    r = A.competitive_ratio(A.trial_revenues(q, b, bu, 4), bu)
    return r.select(F.round(F.col("mean_revenue").cast("double"), 6).alias("mean_revenue"), "trials",
                    F.col("best").cast("double").alias("best"), F.round(F.col("ratio").cast("double"), 6).alias("ratio"))
