"""Budget-limited assignment of an ordered query stream to bidders.

The sequential rule is "give each query to the best-ranked bidder whose
remaining budget covers the bid". The stream is cut into blocks of ``CHUNK``
queries and settled in rounds, all trials in one plan. A round

* finds, under the budgets left, every keyword's best bidder. With greedy that
  winner stays until a budget runs out, so running sums of (queries of the
  keyword in a block x its bid) tell the first block in which some advertiser
  would be overdrawn; all blocks before it are settled by one join;
* settles the next ``SPAN`` blocks query by query, one bounded group a trial:
  their queries and, per keyword, its best bidders that can pay, ``OFFERS`` in
  all. Ranks only ever worsen, so a bidder that ranks before the first one left
  out is the winner; a round ends at the first query without such a bidder, and
  the next one goes on from there with new lists.

Rounds therefore follow the number of bidders that come up over the ``OFFERS``
of a round, not queries. Blocks without a bidder that can pay are skipped. The
stream ends for a trial when no keyword that is still to come has a bidder that
can pay.
"""

from __future__ import annotations

import heapq
import math
import uuid

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.functions.scalar import scaled_bid
from lodestar.plans.iterate import NotConverged, discard, materialize, materialize_partitioned
from lodestar.plans.ranking import global_row_number, top_k_per_group
from lodestar.session import checkpoint_dir

CHUNK = 4096  # queries of a block
FOLDER = 64  # blocks of one folder of the written stream
SPAN = 64  # blocks that are settled query by query in one round
OFFERS = 400_000  # offers of such a round, over all keywords
LEAST = 16  # offers of a keyword, however many keywords there are


def candidate_bids(queries: DataFrame, bids: DataFrame) -> DataFrame:
    """C4: query x bid on keyword; queries without bidders give nothing."""
    return queries.join(bids, "keyword")


def _order(strategy: str):
    if strategy == "greedy":
        return [F.col("bid").desc(), F.col("advertiser")]
    if strategy == "balance":
        return [F.col("remaining").desc(), F.col("advertiser")]
    if strategy == "msvv":
        return [F.col("scaled").desc(), F.col("advertiser")]
    raise ValueError(strategy)


def rank_bids(cands: DataFrame, strategy: str, keys: list[str]) -> DataFrame:
    """Rank bidders per query; ``remaining``/``budget`` columns needed for
    balance and MSVV."""
    c = cands
    if strategy == "msvv":
        c = c.withColumn("scaled", scaled_bid(F.col("bid"), F.col("budget"), F.col("remaining")))
    return c.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*_order(strategy))))


def best_static_bid(queries: DataFrame, bids: DataFrame) -> DataFrame:
    """E3 (greedy, budgets ignored): the winner of every query.

    The greedy key (bid desc, advertiser) does not depend on the query, so
    bidders are ranked once per keyword on the bids table (salted top-1 for
    hot keywords) and the winners joined to the query stream: no
    query x bidder intermediate."""
    top = top_k_per_group(bids.select("keyword", "advertiser", "bid"), ["keyword"],
                          [F.col("bid").desc(), F.col("advertiser")], 1, salt_key=["advertiser"])
    return queries.join(top.drop("rank"), "keyword")


def bids_per_query(queries: DataFrame, bids: DataFrame) -> DataFrame:
    """C4 summary: number of bidders and top bid of every query, aggregated
    per keyword before the join (pre-aggregation instead of expanding the
    query x bidder product)."""
    per_kw = bids.groupBy("keyword").agg(F.count(F.lit(1)).alias("n_bidders"), F.max("bid").alias("max_bid"))
    return queries.join(per_kw, "keyword")


def settle_block(queries: pd.DataFrame, cands: pd.DataFrame, strategy: str, most: int) -> tuple[list[tuple], int | None]:
    """``(seq, advertiser, bid, rn)`` of queries in order, query by query, and the
    place of the first one that ``cands`` cannot settle. A keyword's bidders
    stand in a heap by rank; a win only ever worsens an advertiser's rank, so an
    entry is ranked anew when it comes up with an old balance. ``cands`` holds
    the best ``most`` bidders of a keyword, and the next one as a bound: nobody
    left out ranks before it."""
    left = dict(zip(cands["advertiser"], cands["remaining"]))

    def rank(adv, bid, budget):
        if strategy == "greedy":
            return -bid
        if strategy == "balance":
            return -left[adv]
        initial = float(budget)
        return -(float(bid) * (1.0 - math.exp((initial - float(left[adv])) / initial - 1.0)))

    heaps: dict = {}
    bound = {}
    for k, adv, bid, budget, place in zip(cands["keyword"], cands["advertiser"], cands["bid"], cands["budget"], cands["rank"]):
        if place > most:
            bound[k] = (rank(adv, bid, budget), adv)
        else:
            heaps.setdefault(k, []).append((rank(adv, bid, budget), adv, bid, left[adv], budget))
    for heap in heaps.values():
        heapq.heapify(heap)
    out = []
    for i, (seq, keyword, rn) in enumerate(zip(queries["seq"], queries["keyword"], queries["rn"])):
        heap = heaps.get(keyword, [])
        last = bound.get(keyword)
        while heap:
            now, adv, bid, seen, budget = heap[0]
            if left[adv] < bid:
                heapq.heappop(heap)
            elif left[adv] != seen:
                heapq.heapreplace(heap, (rank(adv, bid, budget), adv, bid, left[adv], budget))
            elif last is not None and (now, adv) > last:
                return out, i
            else:
                left[adv] -= bid
                out.append((seq, adv, bid, rn))
                break
        if not heap and last is not None:
            return out, i
    return out, None


def _blocks(queries: DataFrame, trial: str) -> DataFrame:
    """The stream ``(trial, seq, keyword, rn, blk)``, written in folders of
    neighbouring blocks."""
    numbered = global_row_number(queries.select(trial, "seq", "keyword"), [F.col(trial), F.col("seq")], "__rn")
    numbered = materialize(numbered)
    first = numbered.groupBy(trial).agg(F.min("__rn").alias("__first"))  # one row a trial
    blk = F.floor((F.col("__rn") - F.col("__first")) / F.lit(CHUNK)).cast("int")
    out = materialize_partitioned(numbered.join(F.broadcast(first), trial)
                                  .select(trial, "seq", "keyword", F.col("__rn").alias("rn"), blk.alias("blk"))
                                  .withColumn("folder", F.floor(F.col("blk") / FOLDER).cast("int")), "folder")
    discard(numbered)
    return out


def allocate_rounds(queries: DataFrame, bids: DataFrame, budgets: DataFrame, strategy: str = "greedy",
                    trial_col: str | None = None, max_rounds: int | None = None) -> tuple[DataFrame, int]:
    """K1: ``(trial?, seq, advertiser, bid)`` of the assigned queries, and the
    number of rounds it took.

    ``queries(seq, keyword[, trial])``, ``bids(advertiser, keyword, bid)``,
    ``budgets(advertiser, budget)``, amounts as decimals. Every trial starts
    with the whole budgets. Bidders without a budget cannot win; equal ranks go
    by advertiser. Queries without a bidder that can pay are left out. The
    result stands in the checkpoint folder, a folder a round."""
    spark = queries.sparkSession
    trial = trial_col or "__trial"
    q = queries if trial_col else queries.withColumn(trial, F.lit(0))
    stream = _blocks(q, trial)
    counts = materialize(stream.groupBy(trial, "blk", "keyword").agg(F.count(F.lit(1)).alias("n")))
    offers = materialize(bids.select("advertiser", "keyword", "bid").join(budgets, "advertiser"))
    purse = budgets.select("advertiser", F.col("budget").alias("remaining"))
    left = materialize(stream.select(trial).distinct().join(purse))  # trials x advertisers
    # a row without an advertiser tells where a trial goes on: ``rn`` and ``blk``
    result = T.StructType([stream.schema[trial], stream.schema["seq"], offers.schema["advertiser"], offers.schema["bid"],
                           T.StructField("rn", T.LongType()), T.StructField("blk", T.IntegerType())])
    path = f"{checkpoint_dir(spark).rstrip('/')}/lodestar-state/{uuid.uuid4().hex}"
    spark.createDataFrame([], result).write.parquet(f"{path}/round=0")
    # of every trial the next block and, where a round ended inside it, the next query
    at = {r[trial]: (0, None) for r in stream.select(trial).distinct().collect()}
    rounds = 0
    while at:
        if max_rounds is not None and rounds >= max_rounds:
            raise NotConverged(f"the stream is not settled after {max_rounds} rounds")
        rounds += 1
        here = spark.createDataFrame([(t, lo) for t, (lo, _) in at.items()], T.StructType([stream.schema[trial], T.StructField("lo", T.IntegerType())]))
        # balances are as many as advertisers: joined without a broadcast
        payable = offers.join(left.hint("merge"), "advertiser").where(F.col("remaining") >= F.col("bid"))
        best = materialize(payable.groupBy(trial, "keyword")
                           .agg(F.min_by(F.struct("advertiser", "bid", "remaining"),
                                         F.struct(-F.col("bid"), F.col("advertiser"))).alias("w"))
                           .select(trial, "keyword", "w.*"))
        todo = counts.join(F.broadcast(here), trial).where(F.col("blk") >= F.col("lo")).join(best, [trial, "keyword"])
        if strategy == "greedy":
            spend = todo.groupBy(trial, "blk", "advertiser", "remaining").agg(F.sum(F.col("n") * F.col("bid")).alias("spend"))
            run = F.sum("spend").over(Window.partitionBy(trial, "advertiser").orderBy("blk"))
            spend = spend.withColumn("over", run > F.col("remaining"))
            stops = {r[trial]: r["v"] for r in spend.groupBy(trial).agg(F.min(F.when(F.col("over"), F.col("blk"))).alias("v")).collect()}
        else:
            stops = {r[trial]: r["v"] for r in todo.groupBy(trial).agg(F.min("blk").alias("v")).collect()}
        if not stops:
            discard(best)
            break
        # inside a block the round goes on query by query at once
        stops = {t: v if at[t][1] is None else at[t][0] for t, v in stops.items()}
        spans = {t: (at[t][0], v, at[t][1]) for t, v in stops.items()}
        most = max(LEAST, OFFERS // best.select("keyword").distinct().count())
        if strategy == "greedy":  # what the fixed winners pay before the block that is settled query by query
            ahead = todo.join(F.broadcast(_bounds(spark, spans, result).drop("lo", "from")), trial).where(F.col("v").isNull() | (F.col("blk") < F.col("v")))
            paid = ahead.groupBy(trial, "advertiser").agg(F.sum(F.col("n") * F.col("bid")).alias("paid"))
            payable = offers.join(_less(left, paid, trial).hint("merge"), "advertiser").where(F.col("remaining") >= F.col("bid"))
        part = _settle(stream, best, payable, spans, strategy, trial, result, most)
        part.write.parquet(f"{path}/round={rounds}")
        part = spark.read.schema(result).parquet(f"{path}/round={rounds}")
        spent = part.where("advertiser IS NOT NULL").groupBy(trial, "advertiser").agg(F.sum("bid").alias("paid"))
        after = materialize(_less(left, spent, trial))
        discard(left, best)
        left = after
        at = {t: (v + SPAN, None) for t, v in stops.items() if v is not None}
        at |= {r[trial]: (r["blk"], r["rn"]) for r in part.where("advertiser IS NULL").collect()}  # at most one a trial
    discard(stream, counts, offers, left)
    done = spark.read.schema(result).parquet(*[f"{path}/round={r}" for r in range(rounds + 1) if r == 0 or _written(spark, f"{path}/round={r}")])
    done = done.where("advertiser IS NOT NULL").drop("rn", "blk")
    return (done if trial_col else done.drop(trial)), rounds


def _written(spark, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _less(left: DataFrame, paid: DataFrame, trial: str) -> DataFrame:
    """Balances after payments."""
    rest = (F.col("remaining") - F.coalesce("paid", F.lit(0))).cast(left.schema["remaining"].dataType)
    return left.join(paid.hint("merge"), [trial, "advertiser"], "left").select(trial, "advertiser", rest.alias("remaining"))


def _bounds(spark, spans: dict, result: T.StructType) -> DataFrame:
    """``(trial, lo, v, from)``, one row a trial."""
    table = T.StructType([result.fields[0], T.StructField("lo", T.IntegerType()), T.StructField("v", T.IntegerType()),
                          T.StructField("from", T.LongType())])
    return spark.createDataFrame([(t, *x) for t, x in spans.items()], table)


def _settle(stream: DataFrame, best: DataFrame, payable: DataFrame, spans: dict, strategy: str, trial: str,
            result: T.StructType, most: int) -> DataFrame:
    """Assigned queries of the blocks ``lo .. v - 1`` (greedy: by the fixed
    winners ``best``; ``v`` None: to the end) and of the ``SPAN`` blocks from
    ``v`` on, as far as ``most`` bidders a keyword settle them, of every trial,
    for which ``payable`` holds the bidders with their balances by then."""
    bounds = _bounds(stream.sparkSession, spans, result)
    lowest = min(lo for lo, _, _ in spans.values()) // FOLDER
    ahead = stream.where(F.col("folder") >= lowest).join(F.broadcast(bounds), trial)
    names = result.names
    out = None
    if strategy == "greedy":
        fixed = ahead.where((F.col("blk") >= F.col("lo")) & (F.col("v").isNull() | (F.col("blk") < F.col("v"))))
        out = fixed.join(best, [trial, "keyword"]).select(*names)
    folders = sorted({f for _, v, _ in spans.values() if v is not None for f in range(v // FOLDER, (v + SPAN - 1) // FOLDER + 1)})
    if folders:
        block = ahead.where(F.col("folder").isin(folders) & (F.col("blk") >= F.col("v")) & (F.col("blk") < F.col("v") + SPAN)
                            & (F.col("from").isNull() | (F.col("rn") >= F.col("from")))).select(trial, "seq", "keyword", "rn", "blk")
        wanted = payable.join(block.select(trial, "keyword").distinct(), [trial, "keyword"])
        if strategy == "msvv":
            wanted = wanted.withColumn("scaled", scaled_bid(F.col("bid"), F.col("budget"), F.col("remaining")))
        cands = top_k_per_group(wanted, [trial, "keyword"], _order(strategy), most + 1, "rank", salt_key=["advertiser"]) \
            .select(trial, "keyword", "advertiser", "bid", "budget", "remaining", "rank")

        def run(own: pd.DataFrame, bidders: pd.DataFrame) -> pd.DataFrame:
            own = own.sort_values("rn")
            rows, stop = settle_block(own, bidders, strategy, most)
            out = pd.DataFrame(rows, columns=names[1:5])
            out["blk"] = None
            if stop is not None:
                out.loc[len(out)] = [own["seq"].iloc[stop], None, None, own["rn"].iloc[stop], own["blk"].iloc[stop]]
            out.insert(0, trial, own[trial].iloc[0] if len(own) else None)
            return out

        exact = block.groupBy(trial).cogroup(cands.groupBy(trial)).applyInPandas(run, result)
        out = exact if out is None else out.unionByName(exact)
    return out


def allocate(queries: DataFrame, bids: DataFrame, budgets: DataFrame, strategy: str = "greedy",
             trial_col: str | None = None) -> DataFrame:
    """K1 without the number of rounds."""
    return allocate_rounds(queries, bids, budgets, strategy, trial_col)[0]


def trial_revenues(queries: DataFrame, bids: DataFrame, budgets: DataFrame, trials: int, strategy: str = "greedy",
                   seed: int = 0) -> DataFrame:
    """K2: ``(trial, revenue)`` of ``trials`` shuffled copies of the stream; a
    trial that sells nothing has revenue 0."""
    won = allocate(permute(queries, trials, seed), bids, budgets, strategy, "trial") \
        .groupBy("trial").agg(F.sum("bid").alias("revenue"))
    every = queries.sparkSession.range(trials).select(F.col("id").cast(won.schema["trial"].dataType).alias("trial"))
    return every.join(won, "trial", "left").fillna(0, ["revenue"])


def best_affordable_bid(queries: DataFrame, bids: DataFrame, budgets: DataFrame, spent: DataFrame,
                        strategy: str) -> DataFrame:
    """E3 at a given moment: the winner of every query under ``strategy``
    when each advertiser has already spent ``spent(advertiser, spent)``;
    bidders that cannot pay their bid are out. The rank does not depend on
    the query, so bidders are ranked once per keyword (salted top-1)."""
    c = bids.select("keyword", "advertiser", "bid").join(budgets, "advertiser").join(spent, "advertiser", "left")
    c = c.withColumn("remaining", F.col("budget") - F.coalesce("spent", F.lit(0))).where(F.col("remaining") >= F.col("bid"))
    if strategy == "msvv":
        c = c.withColumn("scaled", F.round(scaled_bid(F.col("bid"), F.col("budget"), F.col("remaining")), 9))
    top = top_k_per_group(c, ["keyword"], _order(strategy), 1, salt_key=["advertiser"])
    return queries.join(top.drop("rank"), "keyword")


def best_revenue(budgets: DataFrame) -> DataFrame:
    """The revenue bound: sum of budgets."""
    return budgets.agg(F.sum("budget").alias("best"))


def permute(queries: DataFrame, trials: int, seed: int = 0) -> DataFrame:
    """E9 + K2: ``trials`` shuffled copies of the query stream; the new
    ``seq`` is the rank of an MD5 of (old seq, seed, trial) inside the trial,
    computed by a distributed row number (no per-trial window)."""
    t = queries.withColumn("trial", F.explode(F.sequence(F.lit(0), F.lit(trials - 1))))
    t = t.withColumn("__h", F.md5(F.concat_ws(":", F.col("seq"), F.lit(seed), F.col("trial"))))
    t = global_row_number(t, [F.col("trial"), F.col("__h"), F.col("seq")], "__rn")
    first = t.groupBy("trial").agg(F.min("__rn").alias("__f"))
    return t.join(first, "trial").withColumn("seq", F.col("__rn") - F.col("__f") + 1).drop("__h", "__rn", "__f")


def competitive_ratio(revenues: DataFrame, budgets: DataFrame) -> DataFrame:
    """Mean of ``revenues(trial, revenue)`` over the sum of budgets."""
    return revenues.agg(F.avg("revenue").alias("mean_revenue"), F.count(F.lit(1)).alias("trials")) \
                   .crossJoin(best_revenue(budgets)) \
                   .withColumn("ratio", F.col("mean_revenue") / F.col("best"))  # one-row frames
