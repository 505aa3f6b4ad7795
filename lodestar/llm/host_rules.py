"""Quality rules with host verdicts, in DataFrame functions only.

Each document gets rule counts from its whole text. Rule failures are
aggregated per host, host rates are shrunk towards a beta prior estimated
from all hosts by moments, and a host whose posterior rate is confidently
above ``max_rate`` has its other documents rejected too.

Defined cases: null text counts as no words; a null host is the empty host;
repeated rows count as often as they occur; an empty table gives no rows;
other columns are not read. Equal five-word windows are told by their 64-bit
hash inside one text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import write_state

SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5


def words_of(text: Column) -> Column:
    """Runs of anything but space and U+0009..U+000D."""
    return F.array_remove(F.split(F.translate(text, SPACE, " " * len(SPACE)), " "), "")


def rule_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                host_col: str = "source") -> DataFrame:
    """``(id, host, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words)``. One pass, no shuffle; arrays live within one row."""
    src = docs.select(F.col(id_col), F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias("host"),
                      F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    return _counts(src, [id_col, "host"])


def _counts(base: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` and the counts of the text column ``t``."""
    base = base.select(
        *keep, words_of(F.col("t")).alias("words"),
        F.length(F.translate("t", SPACE, "")).cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.translate("t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.filter(F.split("t", "\n"), lambda s: F.length(F.translate(s, SPACE, "")) > 0).alias("lines"))
    n = F.size("words")
    hashes = F.transform("words", lambda w, i: F.xxhash64(
        w, *[F.get("words", i + j) for j in range(1, WINDOW)]))
    base = base.select(
        *keep, n.cast("long").alias("n_words"), "word_chars", "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(n > WINDOW, F.slice(hashes, 1, F.greatest(n - (WINDOW - 1), F.lit(0)))).alias("w"))
    twice = F.size("w") > F.size(F.array_distinct("w"))
    # positions of windows whose hash stands next to an equal one when sorted
    sorted_w = F.sort_array(F.transform("w", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    base = base.withColumn("z", F.when(twice, sorted_w)).drop("w")
    hit = F.transform("z", lambda s, j: F.when(
        (s["h"] == F.get("z", j - 1)["h"]) | (s["h"] == F.get("z", j + 1)["h"]), s["i"]))
    base = base.withColumn("p", F.sort_array(F.filter(hit, lambda i: i.isNotNull()))).drop("z")
    cover = F.aggregate(F.transform("p", lambda i, j: F.least(
        F.lit(WINDOW), F.coalesce(F.get("p", j + 1) - i, F.lit(WINDOW)))), F.lit(0), lambda a, x: a + x)
    return base.withColumn("n_repeat_words", F.coalesce(cover, F.lit(0)).cast("long")).drop("p")


def base_failed(counts: DataFrame, min_words: int = 10, max_repeat_pct: int = 20) -> Column:
    return (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_pct * F.col("n_words"))


def host_verdicts(judged: DataFrame, max_rate: float = 0.5, z: float = 3.0) -> DataFrame:
    """``(host, n_docs, n_failed, host_rate, host_rejected)`` from rows
    ``(host, base_failed)``.

    The prior is Beta(mM, (1-m)M): m the overall failure rate, M from the
    weighted variance of the host rates less its binomial part. A host is
    rejected if posterior mean - z * posterior sd > ``max_rate``.
    """
    hosts = judged.groupBy("host").agg(F.count(F.lit(1)).alias("n_docs"),
                                       F.sum(F.col("base_failed").cast("long")).alias("n_failed"))
    f, n = F.col("n_failed").cast("double"), F.col("n_docs").cast("double")
    sums = hosts.agg(F.sum(f).alias("sf"), F.sum(n).alias("sn"), F.count(F.lit(1)).cast("double").alias("k"),
                     F.sum(f * f / n).alias("sq"))
    m = F.col("sf") / F.col("sn")
    between = F.col("sq") / F.col("sn") - m * m - m * (1 - m) * F.col("k") / F.col("sn")
    prior = sums.select(m.alias("m"), F.least(F.lit(1e6), F.greatest(
        F.lit(1.0), m * (1 - m) / F.greatest(between, F.lit(1e-9)) - 1)).alias("strength"))
    # one row of sums against the hosts
    j = hosts.crossJoin(F.broadcast(prior))
    total = n + F.col("strength")
    rate = (f + F.col("m") * F.col("strength")) / total
    j = j.withColumn("host_rate", rate)
    sd = F.sqrt(F.col("host_rate") * (1 - F.col("host_rate")) / (total + 1))
    return j.select("host", "n_docs", "n_failed", "host_rate",
                    (F.col("host_rate") - z * sd > max_rate).alias("host_rejected"))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
          min_words: int = 10, max_repeat_pct: int = 20, max_rate: float = 0.5, z: float = 3.0) -> DataFrame:
    """Counts, ``base_failed``, ``host``, ``host_rate`` and ``kept`` for every
    row. The counts are written once (no texts); the few host rows join back,
    and a host with a third of the rows is split by the skew join."""
    counts = rule_counts(docs, id_col, text_col, host_col)
    counts, _ = write_state(counts.withColumn("base_failed", base_failed(counts, min_words, max_repeat_pct)))
    hosts = host_verdicts(counts, max_rate, z).select("host", "host_rate", "host_rejected")
    out = counts.join(hosts, "host", "left")
    return out.withColumn("kept", ~(F.col("base_failed") | F.col("host_rejected"))).drop("host_rejected")


def keep(docs: DataFrame, text_col: str = "text", host_col: str = "source", min_words: int = 10,
         max_repeat_pct: int = 20, max_rate: float = 0.5, z: float = 3.0) -> DataFrame:
    """The rows of ``docs``, all columns unchanged, that pass their own rules
    and whose host passes. Texts are judged once and written with their flag;
    rejected hosts are written too, so that the planner sees their size: a
    small table is broadcast, a larger one is joined by a shuffle."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    src = docs.select(row.alias("row"), F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias("host"),
                      F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    counts = _counts(src, ["row", "host"])
    judged, _ = write_state(counts.select(
        "row", "host", base_failed(counts, min_words, max_repeat_pct).alias("base_failed")))
    rejected, _ = write_state(host_verdicts(judged, max_rate, z).where("host_rejected").select("host"))
    return judged.where("NOT base_failed").join(rejected, "host", "left_anti").select("row.*")
