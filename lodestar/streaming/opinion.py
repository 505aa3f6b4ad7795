"""Streaming opinion counts (S1-S4) and the word-polarity functions.

The same column plan serves batch and stream: messages ``(ts, value)`` are
split into words, cleaned, joined to the lexicon and counted. As a stream it
runs as a Structured Streaming aggregation with its state in the state store
and a checkpoint location; as a batch it is an ordinary aggregation.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from lodestar.functions.text import clean_word
from lodestar.plans.registry import query
from lodestar.session import checkpoint_dir
from lodestar.sources import standins as S
from lodestar.sources.tables import Tables

MESSAGE_SCHEMA = T.StructType([T.StructField("ts", T.TimestampNTZType()), T.StructField("value", T.StringType())])


def read_stream(spark: SparkSession, source: str, path: str | None = None, schema: T.StructType = MESSAGE_SCHEMA,
                options: dict[str, str] | None = None) -> DataFrame:
    """Message stream. ``source`` is ``kafka`` (needs the connector on
    the classpath; value cast to string, timestamp kept), or a file format
    (``parquet``, ``json``, ``text``) read from ``path``."""
    r = spark.readStream.options(**(options or {}))
    if source == "kafka":
        df = r.format("kafka").load()
        return df.select(F.col("timestamp").cast("timestamp_ntz").alias("ts"), F.col("value").cast("string"))
    if source == "text":
        return r.format("text").load(path).select(F.current_timestamp().cast("timestamp_ntz").alias("ts"), "value")
    return r.format(source).schema(schema).load(path)


def words(messages: DataFrame) -> DataFrame:
    """Whitespace words of each message, cleaned (B2), empties dropped."""
    w = messages.select("ts", F.explode(F.split(F.col("value"), r"\s+")).alias("raw"))
    return w.select("ts", clean_word(F.col("raw")).alias("word")).where(F.col("word") != "")


def polarity(word_df: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Keep words in the lexicon ``(word, polarity)``; the lexicon has
    one polarity per word (positive wins, see the stand-in builder)."""
    return word_df.join(lexicon, "word")


def sentiment_counts(messages: DataFrame, lexicon: DataFrame, window: str = "10 seconds",
                     watermark: str | None = "10 seconds") -> DataFrame:
    """Counts per (event-time window, polarity)."""
    # event time as TIMESTAMP (session time zone), which watermarks require
    w = polarity(words(messages), lexicon).withColumn("ts", F.col("ts").cast("timestamp"))
    if watermark and messages.isStreaming:
        w = w.withWatermark("ts", watermark)
    return w.groupBy(F.window("ts", window).alias("window"), "polarity").agg(F.count(F.lit(1)).alias("n"))


def running_counts(messages: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Running totals per polarity (complete-mode state as a stream)."""
    return polarity(words(messages), lexicon).groupBy("polarity").agg(F.count(F.lit(1)).alias("n"))


def foreach_batch(df: DataFrame, table_path: str, checkpoint: str, fmt: str = "parquet") -> DataStreamWriter:
    """S3: each micro-batch written to its own folder ``epoch=<n>`` of a table
    (never collected). A batch that is tried again after a failure overwrites
    that folder, so no row is there twice."""
    def sink(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").format(fmt).save(f"{table_path.rstrip('/')}/epoch={epoch}")
    return df.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)


def stage_messages(messages: DataFrame, path: str, files: int = 4) -> None:
    """Write messages as ``files`` folders in order of time, for a file stream:
    ranges of ``ts`` by its quantiles, written one after the other, so that
    file times follow event times."""
    sec = F.col("ts").cast("timestamp").cast("double")
    cuts = messages.select(sec.alias("s")).approxQuantile("s", [i / files for i in range(1, files)], 0.001) if files > 1 else []
    edges = [None, *sorted(set(cuts)), None]
    for i, (lo, hi) in enumerate(zip(edges, edges[1:])):
        part = messages
        if lo is not None:
            part = part.where(sec >= lo)
        if hi is not None:
            part = part.where(sec < hi)
        part.select("ts", "value").write.mode("overwrite").parquet(f"{path.rstrip('/')}/part={i:05d}")


def stream_counts(messages: DataFrame, lexicon: DataFrame, window: str = "10 seconds", watermark: str = "10 seconds",
                  files: int = 4) -> DataFrame:
    """S1-S4 as a real stream: the messages are staged as files, read with
    ``readStream`` a few files a trigger, counted per window under a watermark
    with state in the state store, and written by the sink above; ``n`` of the
    last epoch that touched a window is its count."""
    spark = messages.sparkSession
    base = f"{checkpoint_dir(spark).rstrip('/')}/lodestar-state/{uuid.uuid4().hex}"
    stage_messages(messages, f"{base}/in", files)
    stream = spark.readStream.schema(MESSAGE_SCHEMA).option("maxFilesPerTrigger", max(1, _files(spark, f"{base}/in") // files)) \
                  .option("latestFirst", "false").parquet(f"{base}/in/*").select("ts", "value")
    counts = sentiment_counts(stream, lexicon, window, watermark).select(F.col("window.start").alias("start"), "polarity", "n")
    out = counts.schema
    spark.createDataFrame([], out).write.parquet(f"{base}/out/epoch=-1")
    run_for(foreach_batch(counts, f"{base}/out", f"{base}/checkpoint").outputMode("update"), available_now=True)
    rows = spark.read.schema(T.StructType([*out.fields, T.StructField("epoch", T.LongType())])).parquet(f"{base}/out")
    return rows.groupBy("start", "polarity").agg(F.max_by("n", "epoch").alias("n"))


def _files(spark: SparkSession, path: str) -> int:
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/*/*.parquet")
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p)
    return len(found) if found is not None else 0


def run_for(writer: DataStreamWriter, seconds: float | None = None, available_now: bool = False) -> StreamingQuery:
    """Start, run for ``seconds`` (or drain what is available) and stop
    gracefully; state and progress live in the checkpoint location."""
    if available_now:
        q = writer.trigger(availableNow=True).start()
        q.awaitTermination()
        return q
    q = writer.start()
    end = time.time() + (seconds or 0)
    while time.time() < end and q.isActive:
        q.awaitTermination(timeout=max(0.1, min(1.0, end - time.time())))
    if q.isActive:
        q.processAllAvailable()
        q.stop()
    return q

# ------------------------------------------------------------ queries


def _messages(spark, d):
    return S.messages(Tables(spark, d)).select("ts", "value")


WORDS_SQL = r"""words AS (SELECT ts, lower(regexp_replace(raw, '[^\p{L}\p{N}_]', '', 'g')) AS word FROM
  (SELECT ts, unnest(regexp_split_to_array(value, '\s+')) AS raw FROM msgs)),
cw AS (SELECT * FROM words WHERE word <> '')"""
MSG_SQL = f"msgs AS ({S.MESSAGES_SQL}), lex AS ({S.LEXICON_SQL})"


@query("lexicon", S.LEXICON_SQL)
def q_lexicon(spark, d):
    """A11 on the stand-in: the benchmark word lists as one lexicon."""
    return S.lexicon(Tables(spark, d))


@query("clean_words", f"WITH {MSG_SQL}, {WORDS_SQL} SELECT word, count(*) AS n FROM cw GROUP BY word")
def q_clean_words(spark, d):
    return words(_messages(spark, d)).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


@query("polarity_counts", f"""WITH {MSG_SQL}, {WORDS_SQL}
SELECT l.polarity, count(*) AS n FROM cw JOIN lex l ON l.word = cw.word GROUP BY l.polarity""")
def q_polarity_counts(spark, d):
    return running_counts(_messages(spark, d), S.lexicon(Tables(spark, d)))


@query("sentiment_windows", f"""WITH {MSG_SQL}, {WORDS_SQL}
SELECT CAST(floor(epoch(cw.ts) / 10) * 10 AS BIGINT) AS window_start, l.polarity, count(*) AS n
FROM cw JOIN lex l ON l.word = cw.word GROUP BY 1, 2""")
def q_sentiment_windows(spark, d):
    c = sentiment_counts(_messages(spark, d), S.lexicon(Tables(spark, d)), "10 seconds")
    return c.select(F.col("window.start").cast("long").alias("window_start"), "polarity", "n")


@query("stream_windows", f"""WITH {MSG_SQL}, {WORDS_SQL}
SELECT CAST(floor(epoch(cw.ts) / 10) * 10 AS BIGINT) AS window_start, l.polarity, count(*) AS n
FROM cw JOIN lex l ON l.word = cw.word GROUP BY 1, 2""")
def q_stream_windows(spark, d):
    """The same counts out of a running stream."""
    c = stream_counts(_messages(spark, d), S.lexicon(Tables(spark, d)))
    return c.select(F.col("start").cast("long").alias("window_start"), "polarity", "n")
