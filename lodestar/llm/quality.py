"""Quality classifier: naive-Bayes support vectors.

A text's features are indicators of its n-grams (words, word pairs and runs of
four bytes, hashed to 2**18 buckets). Each is scaled by the log ratio of its
smoothed document counts in good and in poor texts; texts are brought to unit
length; a linear model with squared hinge loss is fitted by dual coordinate
descent. The weights are drawn towards their mean size, as is usual for these
vectors. A logistic map fitted on rows kept apart turns margins into scores.

The model is fitted on at most about ``per_class`` training rows of either
label, in one task whose memory that bound and the number of buckets fix.
The fit and scoring take whole texts. The broadcast model has a fixed size.

Null, empty and blank texts have no feature and get the score of the
intercept; repeated rows are scored each (equal texts of the sample count
once); without labels of both classes every score is 0.5; columns other than
id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.llm.common import WordHashes, mix, text_bytes
from lodestar.llm.labels import fit_logistic, remainder, sample_ids, sample_texts

BUCKETS = 1 << 18
GRAM = 4


def features(text: bytes, words: WordHashes) -> np.ndarray:
    """Sorted distinct feature buckets of one text."""
    tokens = text.split()
    if not tokens:
        return np.empty(0, np.int32)
    h = words.of(tokens)
    pairs = mix(h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:])
    last = np.uint64(BUCKETS - 1)
    found = [(h & last).astype(np.int32), (pairs & last).astype(np.int32)]
    n = len(text) - GRAM + 1
    if n > 0:
        runs = np.lib.stride_tricks.as_strided(np.frombuffer(text, np.uint8), (n, GRAM), (1, 1))
        grams = np.ascontiguousarray(runs).view(">u4").ravel().astype(np.uint32) * np.uint32(2654435761)
        found.append((grams >> np.uint32(14)).astype(np.int32))
    x = np.concatenate(found)
    x.sort()
    return x[np.append(True, x[1:] != x[:-1])]


def fit(rows: list[np.ndarray], y: np.ndarray, apart: np.ndarray, c: float = 1.0, beta: float = 0.25,
        alpha: float = 1.0, epochs: int = 20, seed: int = 7) -> tuple[np.ndarray, float, float, float, np.ndarray]:
    """(v, intercept, a, b, r2): a text's margin is the sum of its buckets' v
    over the root of their r2 (its length in the scaled space), plus the
    intercept; a and b map it to a score."""
    counts = np.full((2, BUCKETS), alpha)
    train = np.flatnonzero(~apart)
    for i in train:
        counts[y[i], rows[i]] += 1
    r = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    r2 = r * r
    size = np.array([np.sqrt(r2[x].sum()) or 1.0 for x in rows])
    # v is r * w, so that a margin is a plain sum; the update adds r * r per bucket
    v, bias = np.zeros(BUCKETS), 0.0
    sign = np.where(y == 1, 1.0, -1.0)
    # both classes weigh the same in the loss
    share = np.array([(y[train] == k).sum() for k in (0, 1)])
    cost = c * len(train) / (2 * np.maximum(share, 1))[y]
    a = np.zeros(len(rows))
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(train):
            x, s = rows[i], size[i]
            g = sign[i] * (v[x].sum() / s + bias) - 1 + a[i] / (2 * cost[i])
            new = max(a[i] - g / (2 + 1 / (2 * cost[i])), 0.0)  # unit length and the intercept's one
            if new != a[i]:
                d = (new - a[i]) * sign[i]
                v[x] += d / s * r2[x]
                bias += d
                a[i] = new
    w = np.divide(v, r, out=np.zeros(BUCKETS), where=r != 0)
    v = r * ((1 - beta) * np.abs(w).mean() * np.sign(w) + beta * w) / beta if beta else v
    margin = np.array([v[x].sum() / s + bias for x, s in zip(rows, size)])
    k = apart if len(set(y[apart].tolist())) == 2 else ~apart
    p, q = fit_logistic(margin[k], y[k].astype(float), np.ones(int(k.sum())))
    return v, bias, p, q, r2


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            label_col: str = "quality", folds: int = 3, held: int = 1, per_class: int = 3_000) -> DataFrame:
    """``(id, held_out, margin, score, predicted)`` for every row; rows whose
    id's remainder is ``held`` are never learned from."""
    spark = docs.sparkSession
    fold = remainder(F.col(id_col), folds)
    ids = sample_ids(labels, id_col, label_col, fold != held, per_class)
    sample = sample_texts(docs, ids, id_col, text_col).groupBy("text").agg(F.max("y").alias("y"))

    def train(table: pa.Table) -> pa.Table:
        words = WordHashes()
        texts = [x.as_py().encode() for x in table.column("text")]
        order = sorted(range(len(texts)), key=lambda i: texts[i])  # the same whatever the rows' order
        rows = [features(texts[i], words) for i in order]
        y = table.column("y").to_numpy()[order]
        apart = np.arange(len(rows)) % 4 == 3
        if len(set(y[~apart].tolist())) < 2:
            v, bias, p, q, r2 = np.zeros(BUCKETS), 0.0, 0.0, 0.0, np.ones(BUCKETS)
        else:
            v, bias, p, q, r2 = fit(rows, y, apart)
        return pa.table({"v": [v.astype("<f4").tobytes()], "r2": [r2.astype("<f4").tobytes()],
                         "bias": [bias], "p": [p], "q": [q]})

    got = sample.withColumn("one", F.lit(1)).groupBy("one").applyInArrow(
        train, "v binary, r2 binary, bias double, p double, q double").collect()
    if got:
        v, r2 = (np.frombuffer(got[0][c], "<f4").astype(float) for c in ("v", "r2"))
        bias, p, q = got[0]["bias"], got[0]["p"], got[0]["q"]
    else:
        v, r2, bias, p, q = np.zeros(BUCKETS), np.ones(BUCKETS), 0.0, 0.0, 0.0
    bc = spark.sparkContext.broadcast((v, r2, bias))
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([T.StructField("id", src.schema["id"].dataType), T.StructField("margin", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, (v, r2, bias) = WordHashes(), bc.value
        for b in batches:
            out = []
            for t in text_bytes(b, "text"):
                x = features(t, words)
                out.append(v[x].sum() / np.sqrt(r2[x].sum() or 1.0) + bias)
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(out, pa.float64())], names=["id", "margin"])

    scored = src.mapInArrow(run, schema)
    score = 1 / (1 + F.exp(-(F.col("margin") * p + q)))
    return scored.select(F.col("id").alias(id_col), (remainder(F.col("id"), folds) == held).alias("held_out"),
                         "margin", score.alias("score"), (score >= 0.5).cast("int").alias("predicted"))
