"""Vocabulary, counting and feature selection over token arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.functions.scalar import keep_probability, uniform
from lodestar.plans.ranking import global_prefix_sum, global_row_number

TASK_TOKENS = 1 << 18  # tokens of a task that gathers lists
HOT = 1 << 16  # frequent words that are sent to every task


def word_count(docs: DataFrame, tokens: str = "tokens") -> DataFrame:
    """``(word, n)`` over all token occurrences (partial + final agg)."""
    return docs.select(F.explode(tokens).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def tagged_vocab(docs: DataFrame, tokens: str = "tokens", tags: str = "tags") -> DataFrame:
    """Words count 1 per occurrence; each tag counts its document's length."""
    w = docs.select(F.explode(tokens).alias("key"), F.lit(1).cast("long").alias("c"))
    t = docs.select(F.explode(tags).alias("key"), F.size(tokens).cast("long").alias("c"))
    return w.unionByName(t).groupBy("key").agg(F.sum("c").alias("n"))


def build_vocab(counts: DataFrame, min_count: int = 5, word: str = "word", n: str = "n") -> DataFrame:
    """Keep words with count >= min_count and index them 1.. in
    (count desc, word) order without a single-partition window."""
    kept = counts.where(F.col(n) >= min_count)
    return global_row_number(kept, [F.col(n).desc(), F.col(word)], "idx")


def restrict_vocab(vocab: DataFrame, top_n: int) -> DataFrame:
    """The ``top_n`` most frequent entries (by index)."""
    return vocab.where(F.col("idx") <= top_n)


def doc_frequency(docs: DataFrame, stopwords: list[str] | DataFrame, tokens: str = "tokens",
                  label: str = "label") -> DataFrame:
    """``(word, n_pos, n_neg)`` documents per class containing the word,
    stop words removed (label 1 = positive)."""
    d = docs.select(label, F.explode(F.array_distinct(tokens)).alias("word"))
    if isinstance(stopwords, DataFrame):
        d = d.join(stopwords.select(F.col(stopwords.columns[0]).alias("word")), "word", "left_anti")
    else:
        d = d.where(~F.col("word").isin(list(stopwords)))
    return d.groupBy("word").agg(F.count(F.when(F.col(label) == 1, 1)).alias("n_pos"),
                                 F.count(F.when(F.col(label) == 0, 1)).alias("n_neg"))


def select_features(df_counts: DataFrame, n_pos_docs: Column | int, n_neg_docs: Column | int,
                    keep_exclusive: bool = False) -> DataFrame:
    """Discriminative words: seen in both classes, the larger count at
    least 1% of the smaller class and at least twice the smaller count.
    ``keep_exclusive=True`` also keeps words seen in one class only."""
    P = F.lit(n_pos_docs) if isinstance(n_pos_docs, int) else n_pos_docs
    N = F.lit(n_neg_docs) if isinstance(n_neg_docs, int) else n_neg_docs
    hi = F.greatest("n_pos", "n_neg")
    lo = F.least("n_pos", "n_neg")
    both = (F.col("n_pos") > 0) & (F.col("n_neg") > 0)
    rule = (hi >= F.lit(0.01) * F.least(P, N)) & (hi >= 2 * lo)
    cond = (both | F.lit(keep_exclusive)) & rule
    return df_counts.where(cond)


def binary_features(docs: DataFrame, features: DataFrame, key: str = "doc_id", tokens: str = "tokens") -> DataFrame:
    """H6: long form ``(doc_id, word)`` of the selected words present in a
    document (the binary bag of words, one row per 1)."""
    return (docs.select(key, F.explode(F.array_distinct(tokens)).alias("word"))
                .join(features.select("word"), "word", "left_semi"))


def subsample(docs: DataFrame, vocab: DataFrame, sample: float = 0.0, seed: int = 1,
              key: str = "doc_id", tokens: str = "tokens") -> DataFrame:
    """Drop out-of-vocabulary tokens and down-sample frequent ones with
    an MD5 draw per (document, position, seed); order is kept.

    Lists are gathered in a task's memory, so documents are dealt to tasks of
    about ``TASK_TOKENS`` tokens of the vocabulary, equal or missing keys as well.
    The at most ``HOT`` words that hold 1 / ``HOT`` of all tokens are looked up
    where the documents are; only tokens of the rest are moved to their words."""
    total = vocab.agg(F.sum("n").alias("total")).first()["total"]
    tasks = max(-(-int(total or 0) // TASK_TOKENS), docs.sparkSession.sparkContext.defaultParallelism)
    t = docs.select(key, tokens).repartition(tasks, F.xxhash64(key, tokens)).select(key, F.posexplode(tokens).alias("pos", "word"))
    often = F.broadcast(vocab.groupBy("word").agg(F.max("n").alias("n")).where(F.col("n") * HOT >= F.lit(total)).select("word"))
    v = vocab.select("word", keep_probability(F.col("n"), F.lit(total), sample).alias("keep"))
    here = t.join(F.broadcast(v.join(often, "word", "left_semi")), "word")
    moved = t.join(often, "word", "left_anti").repartition(tasks, "word").join(v.join(often, "word", "left_anti").hint("merge"), "word")
    t = here.unionByName(moved).where(uniform(F.col(key), F.col("pos"), seed) < F.col("keep"))
    return t.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("pos", "word"))).alias("s")) \
            .select(key, F.transform("s", lambda x: x["word"]).alias(tokens))


def noise_distribution(vocab: DataFrame, power: float = 0.75) -> DataFrame:
    """Negative-sampling probabilities ``count^power / Z`` and their
    cumulative upper bounds in index order (distributed prefix sum)."""
    z = vocab.agg(F.sum(F.pow(F.col("n").cast("double"), power)).alias("z"))
    p = vocab.crossJoin(z).withColumn("prob", F.pow(F.col("n").cast("double"), power) / F.col("z")).drop("z")
    return global_prefix_sum(p, [F.col("idx")], F.col("prob"), "cum")
