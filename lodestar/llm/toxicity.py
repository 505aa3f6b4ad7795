"""Toxicity by class-conditional Kneser-Ney models.

Two models, of toxic and of ordinary texts, give every word a probability
after the word before it. Discounted counts of the class's word pairs (in how
many sampled texts) are interpolated with the word's spelling: the product over
its bytes and its end, each given up to four bytes before it in the word. The
three highest orders of the spelling are the class's: counts of words in
documents at the top, of distinct continuations below. They back off to one
model that both classes share, of five orders of continuation counts over the
distinct words of the whole corpus. So a rare expression is spelled by what
both classes share, and a class's own words, pairs, endings and stems tell.
A text's statistic is (log P_toxic - log P_ordinary) per word; a logistic map,
fitted on training rows that the models have not seen, turns it into a score.

The class counts come from at most about ``per_class`` training rows of either
label. The shared counts cover every word of every document; they, and the
spelling of every distinct word, are Spark tables that grow with the corpus.
What is broadcast is bounded by the sample: its pairs and the spelling of its
words. Other words belong to no pair of the sample, so their spelling adds up
apart: it is joined from the table.

Null, empty and blank texts have the statistic 0; repeated rows are scored
each (equal texts of the sample count once); without labels of both classes
every score is 0.5; columns other than id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.llm.common import WordHashes, drop_state, mix, release, text_bytes, tracked, write_state
from lodestar.llm.labels import fit_logistic, remainder, sample_ids, sample_texts

ORDER = 5  # bytes of a key, the longest of the spelling
CLASS = 3  # the class models hold the orders from here on
FLUSH = 500_000  # keys a task holds before it sends them
_BEGIN, _END = 2, 3
_FIRST = np.uint64(1)  # stands for the word before a text's first

_TO = bytes(c + 32 if 65 <= c <= 90 else 32 if c < 128 and not chr(c).isalnum() and c != 39 else c for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased words without ASCII punctuation."""
    return text.translate(_TO).split()


def spelled(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(key of the last ``ORDER`` bytes, word) for every byte and end of the words."""
    pad = bytes([_BEGIN]) * (ORDER - 1)
    end = bytes([_END])
    buf = np.frombuffer(b"".join([pad + w + end for w in words]), np.uint8).astype(np.int64)
    key = np.zeros(len(buf), np.int64)
    for j in range(ORDER):
        key[j:] |= buf[: len(buf) - j] << (8 * j)
    word = np.repeat(np.arange(len(words)), [len(w) + ORDER for w in words])
    real = np.ones(len(buf), bool)
    starts = np.cumsum([0] + [len(w) + ORDER for w in words[:-1]])
    for j in range(ORDER - 1):
        real[starts + j] = False
    return key[real], word[real]


def _sum_by(key: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    u, inv = np.unique(key, return_inverse=True)
    return u, np.stack([np.bincount(inv, weights=v, minlength=len(u)) for v in values])


class Level:
    """One order: discounted probabilities of known keys and the back-off mass
    of known contexts, a row per model."""

    def __init__(self, key: np.ndarray, counts: np.ndarray):
        """``key`` sorted and distinct; ``counts`` (models, keys)."""
        self.key = key
        self.ctx, inv = np.unique(key >> 8, return_inverse=True)
        self.high = np.zeros(counts.shape, np.float32)
        self.back = np.ones((len(counts), len(self.ctx)), np.float32)
        for c, n in enumerate(counts):
            n1, n2 = (n == 1).sum(), (n == 2).sum()
            d = n1 / (n1 + 2 * n2) if n1 else 0.5
            total = np.bincount(inv, weights=n, minlength=len(self.ctx))
            kinds = np.bincount(inv, weights=n > 0, minlength=len(self.ctx))
            seen = total > 0
            self.back[c][seen] = d * kinds[seen] / total[seen]
            self.high[c] = np.maximum(n - d, 0) / np.maximum(total, 1)[inv]

    def apply(self, key: np.ndarray, lower: np.ndarray) -> np.ndarray:
        """Probabilities (models, keys) from those of the next lower order."""
        p = lower
        if len(self.key):
            at = np.minimum(np.searchsorted(self.ctx, key >> 8), len(self.ctx) - 1)
            p = p * np.where(self.ctx[at] == key >> 8, self.back[:, at], 1)
            at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
            p = p + np.where(self.key[at] == key, self.high[:, at], 0)
        return p


def _mask(order: int) -> int:
    return (1 << (8 * order)) - 1


def class_levels(words: list[bytes], counts: np.ndarray) -> list[tuple[int, Level]]:
    """(order, level) of both classes' spelling, lowest first. ``counts``
    (2, words): in how many sampled texts of a class a word occurs."""
    levels: list[tuple[int, Level]] = []
    key, n = np.empty(0, np.int64), np.empty((2, 0))
    for at in range(0, len(words), 50_000):
        k, word = spelled(words[at: at + 50_000])
        key, n = _sum_by(np.append(key, k), np.append(n, counts[:, at: at + 50_000][:, word].astype(float), 1))
    for order in range(ORDER, CLASS - 1, -1):
        levels.append((order, Level(key, n)))
        key, n = _sum_by(key & _mask(order - 1), (n > 0).astype(float))
    return levels[::-1]


class Pairs:
    """Word pairs of both classes, as hashes: logs of the discounted
    probabilities of known pairs and of the back-off mass of known contexts."""

    def __init__(self, key: np.ndarray, ctx: np.ndarray, counts: np.ndarray):
        """``key`` distinct; ``ctx`` the hash of its first word; ``counts`` (2, pairs)."""
        order = np.argsort(key)
        self.key, counts = key[order], counts[:, order]
        self.ctx, inv = np.unique(ctx[order], return_inverse=True)
        self.at = inv.astype(np.int32)
        self.high = np.full(counts.shape, -np.inf, np.float32)
        self.back = np.zeros((2, len(self.ctx) + 1), np.float32)  # the last is of no context
        for c, n in enumerate(counts):
            n1, n2 = (n == 1).sum(), (n == 2).sum()
            d = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
            total = np.bincount(inv, weights=n, minlength=len(self.ctx))
            kinds = np.bincount(inv, weights=n > 0, minlength=len(self.ctx))
            seen, known = total > 0, n > 0
            self.back[c, :-1][seen] = np.log(d * kinds[seen] / total[seen])
            self.high[c][known] = np.log((n[known] - d) / total[inv[known]])

    def context(self, h: np.ndarray) -> np.ndarray:
        """Places in ``back`` of words by their hashes."""
        if not len(self.ctx):
            return np.zeros(len(h), np.int64)
        at = np.minimum(np.searchsorted(self.ctx, h), len(self.ctx) - 1)
        return np.where(self.ctx[at] == h, at, len(self.ctx))

    def ratios(self, key: np.ndarray, ctx: np.ndarray, spell: np.ndarray) -> np.ndarray:
        """log P_toxic - log P_ordinary of words after contexts (places in
        ``back``); ``spell`` (2, words): logs of their spelling."""
        low = self.back[:, ctx] + spell
        if len(self.key):
            at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
            hit = np.flatnonzero(self.key[at] == key)
            low[:, hit] = np.logaddexp(self.high[:, at[hit]], low[:, hit])
        return low[1] - low[0]


def pair_hash(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(first * np.uint64(0x9E3779B97F4A7C15) + second)


def distinct_words(docs: DataFrame, text_col: str) -> DataFrame:
    """``(word, w)``: the distinct words of all texts and a number of each, written."""
    src = docs.select(F.col(text_col).cast("string").alias("text"))

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for b in batches:
            new: set[bytes] = set()
            for t in text_bytes(b, "text"):
                new.update(words_of(t))
            new -= seen
            if len(seen) + len(new) > 500_000:
                seen = set()
            seen |= new
            if new:
                yield pa.RecordBatch.from_arrays([pa.array(list(new), pa.binary())], names=["word"])

    words = src.mapInArrow(distinct, "word binary").distinct()
    return write_state(words.withColumn("w", F.monotonically_increasing_id()))[0]


def _parts(words: list[bytes]) -> Iterator[list[bytes]]:
    """``words`` in runs of about ``FLUSH`` bytes."""
    at, size = 0, 0
    for i, w in enumerate(words):
        size += len(w) + ORDER
        if size > FLUSH or i == len(words) - 1:
            yield words[at: i + 1]
            at, size = i + 1, 0


def shared_grams(words: DataFrame) -> DataFrame:
    """``(key, n)``: byte sequences of ``ORDER`` over the distinct words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n = np.empty(0, np.int64), np.empty((1, 0))
        for b in batches:
            for part in _parts(b.column("word").to_pylist()):
                key, _ = spelled(part)
                keys, n = _sum_by(np.append(keys, key), np.append(n, np.ones((1, len(key))), 1))
                if len(keys) > FLUSH:
                    yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n[0].astype(np.int64))], names=["key", "n"])
                    keys, n = np.empty(0, np.int64), np.empty((1, 0))
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n[0].astype(np.int64))], names=["key", "n"])

    return write_state(words.mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")))[0]


def shared_model(grams: DataFrame) -> DataFrame:
    """``(key, p)``: the shared probability of the last byte of every key of
    ``ORDER`` bytes, interpolated over all orders."""
    orders = {ORDER: grams}
    for order in range(ORDER - 1, 0, -1):
        orders[order] = write_state(orders[order + 1].groupBy(F.col("key").bitwiseAND(F.lit(_mask(order))).alias("key"))
                                    .agg(F.count(F.lit(1)).alias("n")))[0]
    lower = None
    for order in range(1, ORDER + 1):
        rows = orders[order].withColumn("ctx", F.shiftright("key", 8))
        n1, n2 = (x or 0 for x in rows.agg(*(F.sum((F.col("n") == k).cast("long")) for k in (1, 2))).first())
        d = n1 / (n1 + 2 * n2) if n1 else 0.5
        ctx = rows.groupBy("ctx").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"))
        rows = rows.join(ctx, "ctx")
        low = F.lit(1 / 256)
        if lower is not None:
            rows = rows.withColumn("low", F.col("key").bitwiseAND(F.lit(_mask(order - 1)))).join(
                lower.select(F.col("key").alias("low"), F.col("p").alias("p_low")), "low")
            low = F.col("p_low")
        lower = write_state(rows.select(
            "key", ((F.col("n") - d + F.lit(d) * F.col("kinds") * low) / F.col("total")).alias("p")))[0]
    return lower


def spelling(words: DataFrame, shared: DataFrame, levels: list[tuple[int, Level]]) -> DataFrame:
    """``(word, l0, l1)``: logs of both classes' spelling of every distinct word."""
    bc = words.sparkSession.sparkContext.broadcast(levels)

    def classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            key = b.column("key").to_numpy()
            p = np.tile(b.column("p").to_numpy(), (2, 1))
            for order, level in bc.value:
                p = level.apply(key & _mask(order), p)
            p = np.log(np.maximum(p, 1e-12))
            yield pa.RecordBatch.from_arrays([b.column("key"), pa.array(p[0]), pa.array(p[1])], names=["key", "l0", "l1"])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            done = 0
            for part in _parts(b.column("word").to_pylist()):
                key, word = spelled(part)
                yield pa.RecordBatch.from_arrays(
                    [b.column("w").slice(done, len(part)).take(pa.array(word)), pa.array(key)], names=["w", "key"])
                done += len(part)

    known = shared.mapInArrow(classes, "key long, l0 double, l1 double")
    logs = words.mapInArrow(spread, "w long, key long").join(known, "key").groupBy("w").agg(
        F.sum("l0").alias("l0"), F.sum("l1").alias("l1"))
    return write_state(words.join(logs, "w").select("word", "l0", "l1"))[0]


def class_counts(sample: DataFrame) -> tuple[list[bytes], np.ndarray]:
    """(words, counts (2, words)): sampled texts of either class with a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n: dict[bytes, list[int]] = {}
            for t, y in zip(text_bytes(b, "text"), b.column("y").to_pylist()):
                for w in set(words_of(t)):
                    n.setdefault(w, [0, 0])[y] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(n), pa.binary()), pa.array([x[0] for x in n.values()], pa.int32()),
                 pa.array([x[1] for x in n.values()], pa.int32())], names=["word", "c0", "c1"])

    rows = sample.select("y", "text").distinct().mapInArrow(run, "word binary, c0 int, c1 int")
    table = rows.groupBy("word").agg(F.sum("c0").cast("int").alias("c0"), F.sum("c1").cast("int").alias("c1")).toArrow()
    return (table.column("word").to_pylist(),
            np.stack([table.column("c0").to_numpy(), table.column("c1").to_numpy()]))


def class_pairs(sample: DataFrame) -> Pairs:
    """In how many sampled texts of either class a word follows another."""

    def flush(held: list[np.ndarray]) -> pa.RecordBatch:
        x = np.concatenate(held, axis=1)
        key, at, inv = np.unique(x[0], return_index=True, return_inverse=True)
        n = [np.bincount(inv, weights=x[2] == y, minlength=len(key)).astype(np.int32) for y in (0, 1)]
        return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(x[1][at].view(np.int64)), *map(pa.array, n)],
                                          names=["key", "ctx", "c0", "c1"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, held, size = WordHashes(), [], 0
        for b in batches:
            for t, y in zip(text_bytes(b, "text"), b.column("y").to_pylist()):
                h = hashes.of(words_of(t))
                if not len(h):
                    continue
                ctx = np.append(_FIRST, h[:-1])
                key, at = np.unique(pair_hash(ctx, h), return_index=True)
                held.append(np.stack([key, ctx[at], np.full(len(key), y, np.uint64)]))
                size += len(key)
                if size > FLUSH:
                    yield flush(held)
                    held, size = [], 0
        if held:
            yield flush(held)

    rows = sample.select("y", "text").distinct().mapInArrow(run, "key long, ctx long, c0 int, c1 int")
    table = rows.groupBy("key", "ctx").agg(F.sum("c0").cast("int").alias("c0"), F.sum("c1").cast("int").alias("c1")).toArrow()
    key, ctx, c0, c1 = (table.column(c).to_numpy() for c in ("key", "ctx", "c0", "c1"))
    return Pairs(key.view(np.uint64), ctx.view(np.uint64), np.stack([c0, c1]))


def score_texts(docs: DataFrame, words: list[bytes], pairs: Pairs, spell: DataFrame, id_col: str,
                text_col: str) -> DataFrame:
    """``(id, stat)`` for every row. ``words`` are the sample's, ``spell`` the
    spelling of all words."""
    spark = docs.sparkSession
    own = spark.createDataFrame(pa.table({"word": pa.array(words, pa.binary())}))
    known = spell.join(F.broadcast(own), "word").toArrow()
    words = known.column("word").to_pylist()
    logs = np.stack([known.column("l0").to_numpy(), known.column("l1").to_numpy()]).reshape(2, -1)
    bc = spark.sparkContext.broadcast((words, logs, pairs))
    src = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
                      F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([T.StructField("row", T.LongType()), T.StructField("id", src.schema["id"].dataType),
                           T.StructField("part", T.DoubleType()), T.StructField("n", T.LongType()),
                           T.StructField("others", T.ArrayType(T.BinaryType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, logs, pairs = bc.value
        place = {w: i for i, w in enumerate(words)}
        # two more: a word outside the sample, and the one before a text's first
        h = np.concatenate([WordHashes().of(words), np.array([0, _FIRST], np.uint64)])
        at = pairs.context(h)
        at[-2] = pairs.back.shape[1] - 1
        logs = np.concatenate([logs, np.zeros((2, 2))], axis=1)
        none, first = len(words), len(words) + 1

        def score(held: list[list[bytes]]) -> tuple[list[float], list[list[bytes]]]:
            flat = [w for ws in held for w in ws]
            sizes = np.array([len(ws) for ws in held])
            if not flat:
                return [0.0] * len(held), [[] for _ in held]
            x = np.array([place.get(w, none) for w in flat])
            before = np.append(first, x[:-1])
            starts = np.cumsum(sizes) - sizes
            before[starts[sizes > 0]] = first
            ratio = pairs.ratios(pair_hash(h[before], h[x]), at[before], logs[:, x])
            text = np.repeat(np.arange(len(held)), sizes)
            others: list[list[bytes]] = [[] for _ in held]
            for i in np.flatnonzero(x == none).tolist():
                others[text[i]].append(flat[i])
            return np.bincount(text, weights=ratio, minlength=len(held)).tolist(), others

        for b in batches:
            held, size, texts, done = [], 0, text_bytes(b, "text"), 0
            for i, t in enumerate(texts):
                held.append(words_of(t))
                size += len(held[-1])
                if size > 200_000 or i == len(texts) - 1:
                    part, others = score(held)
                    yield pa.RecordBatch.from_arrays(
                        [b.column("row").slice(done, len(held)), b.column("id").slice(done, len(held)),
                         pa.array(part, pa.float64()), pa.array([len(ws) for ws in held], pa.int64()),
                         pa.array(others, pa.list_(pa.binary()))], names=schema.names)
                    done, held, size = i + 1, [], 0

    state, _ = write_state(src.mapInArrow(run, schema))
    rest = state.select("row", F.explode("others").alias("word")).join(spell, "word").groupBy("row").agg(
        F.sum(F.col("l1") - F.col("l0")).alias("rest"))
    return state.drop("others").join(rest, "row", "left").select(
        "id", ((F.col("part") + F.coalesce("rest", F.lit(0.0))) / F.greatest("n", F.lit(1))).alias("stat"))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "toxic", folds: int = 5, held: int = 0, per_class: int = 4_000) -> DataFrame:
    """``(id, held_out, stat, score, predicted)`` for every row of ``docs``.

    Rows whose id's remainder is ``held`` are never learned from; of the others
    one remainder calibrates and the rest fit the models.
    """
    fold = remainder(F.col(id_col), folds)
    last = (held + folds - 1) % folds
    ids = sample_ids(labels, id_col, label_col, (fold != held) & (fold != last), per_class)
    with tracked() as used:
        sample, _ = write_state(sample_texts(docs, ids, id_col, text_col))
        words, counts = class_counts(sample)
        pairs = class_pairs(sample)
        every = distinct_words(docs, text_col)
        release(docs.sparkSession)
        shared = shared_model(shared_grams(every))
        release(docs.sparkSession)
    spell = spelling(every, shared, class_levels(words, counts))
    drop_state(docs.sparkSession, *used)
    release(docs.sparkSession)
    scored, _ = write_state(score_texts(docs, words, pairs, spell, id_col, text_col))
    check = sample_ids(labels, id_col, label_col, fold == last, per_class)
    rows = scored.join(F.broadcast(check), "id").select("stat", "y").toArrow()
    x, y = rows.column("stat").to_numpy(), rows.column("y").to_numpy()
    # the sample takes the labels by different shares; weights restore their numbers
    total = {r["y"]: r["n"] for r in labels.where(fold == last).groupBy(F.col(label_col).alias("y"))
             .agg(F.count(F.lit(1)).alias("n")).collect()}
    weight = np.array([total.get(c, 0) / max(1, (y == c).sum()) for c in (0, 1)])
    a, b = fit_logistic(x, y, weight[y] if len(y) else x) if len(set(y.tolist())) == 2 else (0.0, 0.0)
    score = 1 / (1 + F.exp(-(F.col("stat") * a + b)))
    return scored.select(F.col("id").alias(id_col), (remainder(F.col("id"), folds) == held).alias("held_out"),
                         "stat", score.alias("score"), (score >= 0.5).cast("int").alias("predicted"))
