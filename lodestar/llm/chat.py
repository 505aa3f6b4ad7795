"""Chat formatting: multi-party perspective rotation, DataFrame functions only.

For every participant of a conversation the whole dialogue is rendered with
that speaker as the assistant and everybody else as a named user; context
roles (system messages) stay what they are. The result has one row per
(conversation, perspective, turn): the rendered segment, where it starts in
the perspective's rendering, and the masked range (the assistant's own words
and end mark) as character offsets there. Concatenating the segments of a
perspective by ``seg_no`` gives the rendering; a conversation with a third of
all turns is never gathered in one row or task.

Defined cases: turns are ordered by turn (null last), then speaker, then
text, and repeated rows are all kept; a null role speaks as ``unknown``; a
null text is empty; a null conversation id is one conversation; conversations
with context roles only have no perspectives and give no rows; columns other
than the four named are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.llm.common import write_state

END = "<|end|>\n"


def _header(kind: Column, speaker: Column) -> Column:
    return F.when(kind == "context", F.concat(F.lit("<|"), speaker, F.lit("|>\n"))) \
            .when(kind == "target", F.lit("<|assistant|>\n")) \
            .otherwise(F.concat(F.lit("<|user name="), speaker, F.lit("|>\n")))


def rotate(conversations: DataFrame, context_roles: tuple[str, ...] = ("system",), conv_col: str = "conv_id",
           turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``(conv, participant, seg_no, turn, speaker, segment, seg_start,
    mask_start, mask_end)``; outside the participant's own turns the mask is
    the empty range at ``seg_start``.

    The rows are range-partitioned in dialogue order and written once. Sums
    run inside (conversation, perspective, range partition) and the offsets of
    those pieces, a row for each, are added, so a long conversation is spread
    over as many tasks as its size takes.
    """
    t = conversations.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), F.lit("unknown")).alias("speaker"),
        F.coalesce(F.col(text_col), F.lit("")).alias("body"))
    ctx = F.col("speaker").isin(*context_roles) if context_roles else F.lit(False)
    parts = t.where(~ctx).select(F.col("conv").alias("p_conv"), F.col("speaker").alias("participant")).distinct()
    rows = t.join(parts, F.col("conv").eqNullSafe(F.col("p_conv"))).drop("p_conv")
    kind = F.when(ctx, "context").when(F.col("speaker") == F.col("participant"), "target").otherwise("other")
    rows = rows.withColumn("kind", kind).withColumn("header", _header(F.col("kind"), F.col("speaker")))
    rows = rows.withColumn("len", (F.length("header") + F.length("body") + len(END)).cast("long"))
    order = [F.col("conv").asc_nulls_last(), F.col("participant"), F.col("turn").asc_nulls_last(),
             F.col("speaker"), F.col("body")]
    laid, _ = write_state(rows.repartitionByRange(*order).sortWithinPartitions(*order)
                          .withColumn("piece", F.spark_partition_id())
                          .withColumn("at", F.monotonically_increasing_id()))
    piece = ["conv", "participant", "piece"]
    inside = Window.partitionBy(*piece).orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("conv", "participant").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    heads = laid.groupBy(*piece).agg(F.sum("len").alias("sum"), F.count(F.lit(1)).alias("cnt"))
    heads = heads.select(*[F.col(c).alias(f"h_{c}") for c in piece],
                         F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("len0"),
                         F.coalesce(F.sum("cnt").over(before), F.lit(0)).alias("cnt0"))
    same = (F.col("conv").eqNullSafe(F.col("h_conv")) & (F.col("participant") == F.col("h_participant"))
            & (F.col("piece") == F.col("h_piece")))
    out = laid.withColumn("upto", F.sum("len").over(inside)).withColumn("nth", F.count(F.lit(1)).over(inside))
    out = out.join(heads, same)
    start = F.col("len0") + F.col("upto") - F.col("len")
    target = F.col("kind") == "target"
    return out.select(
        F.col("conv").alias(conv_col), "participant", (F.col("cnt0") + F.col("nth") - 1).alias("seg_no"),
        F.col("turn").alias(turn_col), "speaker", F.concat("header", "body", F.lit(END)).alias("segment"),
        start.alias("seg_start"),
        F.when(target, start + F.length("header")).otherwise(start).alias("mask_start"),
        F.when(target, start + F.col("len")).otherwise(start).alias("mask_end"))
