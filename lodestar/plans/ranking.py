"""Distributed global ranking, prefix sums and salted top-k.

A window with ``orderBy`` and no ``partitionBy`` moves every row into one
task. These helpers range-partition the rows instead, number/sum them inside
each partition and add per-partition offsets taken from a table with one row
per partition (the only thing that is small by construction).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_PID = "__pid"
_LOCAL = "__local"


def _range_layout(df: DataFrame, order: list[Column], n_parts: int | None):
    spark = df.sparkSession
    if n_parts is None:
        n_parts = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    # _LOCAL: 1-based position inside the range partition, taken while the
    # rows are still laid out one partition per _PID in sorted order
    laid = (df.repartitionByRange(n_parts, *order)
              .sortWithinPartitions(*order)
              .withColumn(_PID, F.spark_partition_id())
              .withColumn(_LOCAL, F.monotonically_increasing_id()
                          - F.shiftleft(F.spark_partition_id().cast("long"), 33) + 1))
    # Range bounds are sampled from the input; if the input order is not
    # deterministic (it follows a shuffle) two evaluations can cut the rows
    # differently. The layout is written once to the checkpoint folder so the
    # per-partition totals and the rows come from the same cut (and survive
    # executor loss).
    from lodestar.plans.iterate import materialize
    return materialize(laid)


def global_row_number(df: DataFrame, order: list[Column], name: str = "rn",
                      n_parts: int | None = None) -> DataFrame:
    """1-based row number in the total order ``order`` (give a unique order).

    After the range shuffle the rows of a partition are sorted, so
    ``monotonically_increasing_id`` (partition id in the upper bits, row
    index in the lower 33) gives the local position with no further shuffle.
    """
    laid = _range_layout(df, order, n_parts)
    totals = laid.groupBy(_PID).agg(F.count(F.lit(1)).alias("__tot"))
    w_off = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.withColumn("__off", F.coalesce(F.sum("__tot").over(w_off), F.lit(0))) \
                    .select(_PID, "__off")
    return (laid.join(F.broadcast(offsets), _PID)
                .withColumn(name, F.col("__off") + F.col(_LOCAL))
                .drop(_PID, _LOCAL, "__off"))


def global_prefix_sum(df: DataFrame, order: list[Column], value: Column | None,
                      name: str, n_parts: int | None = None) -> DataFrame:
    """Inclusive running sum of ``value`` (row count when None) in ``order``."""
    v = F.lit(1).cast("long") if value is None else value
    laid = _range_layout(df.withColumn("__v", v), order, n_parts).drop(_LOCAL)
    # Within a partition the rows are in order; a partition-local window on
    # the partition id keeps each partition's rows in their own task.
    # partition-local running sum; the layout is already one partition per
    # _PID, so this window adds one exchange on a small key set at most
    w_local = Window.partitionBy(_PID).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    laid = laid.withColumn(_LOCAL, F.sum("__v").over(w_local))
    totals = laid.groupBy(_PID).agg(F.sum("__v").alias("__tot"))
    w_off = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition: tiny, safe to broadcast
    offsets = totals.withColumn("__off", F.coalesce(F.sum("__tot").over(w_off), F.lit(0))) \
                    .select(_PID, "__off")
    out = (laid.join(F.broadcast(offsets), _PID)
               .withColumn(name, F.col("__off") + F.col(_LOCAL))
               .drop(_PID, _LOCAL, "__off", "__v"))
    return out


def top_k_per_group(df: DataFrame, group: list[str], order: list[Column], k: Column | int,
                    rank_name: str = "rank", salt_buckets: int = 16,
                    salt_key: list[str] | None = None) -> DataFrame:
    """Top-``k`` rows per group in ``order``.

    For a number up to Spark's window-group-limit threshold every task keeps its
    own k best rows of a group before the shuffle, so a hot group arrives as k
    rows a task and one window does. A larger ``k``, or one that is a column
    (per-group size), takes a salted first stage: the top k of each (group, salt)
    slice, so that a hot group is split over ``salt_buckets`` tasks, then at most
    ``salt_buckets * k`` survivors per group. The order must be total (add a
    unique tie-break).
    """
    kc = F.lit(k) if isinstance(k, int) else k
    limit = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if not (isinstance(k, int) and k <= limit) and salt_buckets and salt_buckets > 1:
        keys = salt_key or [c for c in df.columns if c not in group][:2]
        salted = df.withColumn("__salt", F.pmod(F.xxhash64(*[F.col(c) for c in keys]), F.lit(salt_buckets)))
        w1 = Window.partitionBy(*group, "__salt").orderBy(*order)
        df = salted.withColumn("__r1", F.row_number().over(w1)).where(F.col("__r1") <= kc) \
                   .drop("__salt", "__r1")
    w2 = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank_name, F.row_number().over(w2)).where(F.col(rank_name) <= kc)
