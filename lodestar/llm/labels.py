"""Labelled rows for the learners: folds, bounded samples, calibration."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import write_state


def remainder(id_col: Column, m: int) -> Column:
    """crc32 of the id as text, mod m (a null id: of the empty text)."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % m


def sample_ids(labels: DataFrame, id_col: str, label_col: str, train: Column, per_class: int) -> DataFrame:
    """``(id, y)`` of about ``per_class`` training rows of either label, chosen
    by the id's hash; all rows where there are fewer. An id with several labels
    takes the largest. The table is written: at most a few hundred kB."""
    rows = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1) & train) \
                 .groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("y"))
    counts = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = F.lit(0)
    for y, n in counts.items():
        share = F.when(F.col("y") == y, F.lit(int(1e6 * min(1.0, per_class / n)))).otherwise(share)
    return write_state(rows.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < share))[0]


def sample_texts(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, y, text)`` of the sampled documents. ``ids`` is bounded by the
    sample, so it is broadcast and no text is shuffled to find them."""
    return docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")) \
               .join(F.broadcast(ids), "id")


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """(a, b) of sigmoid(a x + b) by Newton steps with a slight ridge."""
    if not len(x) or weight[y == 1].sum() == 0 or weight[y == 0].sum() == 0:
        return 1.0, 0.0
    scale = float(np.sqrt(np.average((x - np.average(x, weights=weight)) ** 2, weights=weight))) or 1.0
    z = np.stack([x / scale, np.ones_like(x)], 1)
    w = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        g = z.T @ (weight * (p - y)) + 1e-3 * w
        h = (z * (weight * p * (1 - p))[:, None]).T @ z + 1e-3 * np.eye(2)
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0] / scale), float(w[1])
