import tempfile
import time

from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF001
from lodestar.sources import standins as S
from lodestar.sources.tables import Tables
from lodestar.streaming import opinion as O


def test_stream_equals_batch(spark):
    t = Tables(spark, SF001)
    msgs = S.messages(t).select("ts", "value")
    lex = S.lexicon(t)
    base = tempfile.mkdtemp(prefix="lodestar-stream-")
    src = f"{base}/in"
    # one folder per event day, written in time order: micro-batches arrive
    # in event-time order, so the watermark drops nothing
    days = sorted(r[0] for r in msgs.select(F.to_date("ts").alias("d")).distinct().collect())
    for i, day in enumerate(days):
        msgs.where(F.to_date("ts") == F.lit(day)).coalesce(1).write.parquet(f"{src}/part={i:03d}")
        time.sleep(1.1)
    stream = spark.readStream.schema(O.MESSAGE_SCHEMA).option("maxFilesPerTrigger", 1) \
                  .parquet(f"{src}/*").select("ts", "value")
    # Running totals, complete mode, state checkpointed
    run = O.running_counts(stream, lex)
    w = run.writeStream.outputMode("complete").format("memory").queryName("running_totals") \
           .option("checkpointLocation", f"{base}/ck1")
    O.run_for(w, available_now=True)
    got = {r["polarity"]: r["n"] for r in spark.sql("SELECT * FROM running_totals").collect()}
    exp = {r["polarity"]: r["n"] for r in O.running_counts(msgs, lex).collect()}
    assert got == exp
    # S1 + S3: windowed counts in update mode, every batch appended to a table
    win = O.sentiment_counts(stream, lex, "10 seconds", watermark="1 hour")
    wr = O.foreach_batch(win.select(F.col("window.start").alias("ws"), "polarity", "n"),
                         f"{base}/out", f"{base}/ck2").outputMode("update")
    O.run_for(wr, available_now=True)
    out = spark.read.parquet(f"{base}/out")
    # in update mode the last emitted row of a window holds its final count
    last = out.groupBy("ws", "polarity").agg(F.max_by("n", "epoch").alias("n"))
    batch = O.sentiment_counts(msgs, lex, "10 seconds").select(F.col("window.start").alias("ws"), "polarity", "n")
    assert sorted(map(tuple, last.collect())) == sorted(map(tuple, batch.collect()))


def test_staged_stream_and_repeated_epoch(spark):
    """Late files inside the watermark count; an epoch that is written again
    replaces its rows."""
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1)
    rows = [(t0 + dt.timedelta(seconds=i * 3), "good Bad, good" if i % 3 else "fine") for i in range(60)]
    msgs = spark.createDataFrame(rows, "ts timestamp_ntz, value string")
    lex = spark.createDataFrame([("good", "positive"), ("bad", "negative")], "word string, polarity string")
    got = O.stream_counts(msgs, lex, "10 seconds", files=3).collect()
    exp = O.sentiment_counts(msgs, lex, "10 seconds").select("window.start", "polarity", "n").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, exp)) and got
    assert O.stream_counts(msgs.limit(0), lex).count() == 0
    base = tempfile.mkdtemp(prefix="lodestar-stream-")
    spark.createDataFrame([(1,), (2,)], "x int").coalesce(1).write.parquet(f"{base}/in")
    src = spark.readStream.schema("x int").parquet(f"{base}/in")
    for _ in range(2):  # a new checkpoint: the same epoch 0 comes again
        ck = tempfile.mkdtemp(prefix="lodestar-stream-")
        O.run_for(O.foreach_batch(src, f"{base}/out", ck), available_now=True)
    assert sorted(r["x"] for r in spark.read.parquet(f"{base}/out").collect()) == [1, 2]
