"""Kernel regression, least squares and ridge regression.

Pairwise kernels are evaluated by block products: both sides are hashed into
blocks, a task multiplies a block of either and returns sums per row, so the
pairs are never rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.plans.blocks import block_apply, matrix
from lodestar.plans.iterate import discard, materialize, materialize_partitioned
from lodestar.plans.ranking import global_row_number


def _similarities(test: pa.Table, train: pa.Table) -> np.ndarray:
    """Pattern similarity (B8) of every pair of two blocks by one product of
    the centred rows; not finite where a row does not vary."""
    x, y = matrix(test.column("x")), matrix(train.column("x"))
    if not (len(x) and len(y)):
        return np.zeros((len(x), len(y)))
    if x.shape[1] != y.shape[1]:
        raise ValueError("vectors of different lengths cannot be compared")
    n = x.shape[1]
    x, y = x - x.mean(axis=1, keepdims=True), y - y.mean(axis=1, keepdims=True)
    with np.errstate(all="ignore"):
        sd = [np.sqrt((m * m).sum(axis=1) / (n - 1)) if n > 1 else np.zeros(len(m)) for m in (x, y)]
        return x @ y.T / (n * np.outer(*sd))


def kernel_pairs(test: DataFrame, train: DataFrame, block: int = 2048) -> DataFrame:
    """Every (test, train) pair with its pattern similarity (B8), null
    where a row does not vary.

    ``test(id, x)``, ``train(id, x, y)``: all pairs by definition, formed in
    blocks of both sides (see :func:`lodestar.plans.blocks.block_apply`)."""
    schema = T.StructType([T.StructField("id", test.schema["id"].dataType), T.StructField("train_id", train.schema["id"].dataType),
                           T.StructField("sim", T.DoubleType()), T.StructField("y", train.schema["y"].dataType)])

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        s = _similarities(a, b)
        i, j = (pa.array(k.reshape(-1)) for k in np.indices(s.shape))
        return pa.table({"id": a.column("id").take(i), "train_id": b.column("id").take(j),
                         "sim": pa.array(s.reshape(-1), mask=~np.isfinite(s.reshape(-1))), "y": b.column("y").take(j)})

    return block_apply(test.select("id", "x"), train.select("id", "x", "y"), ["id"], ["id"], run, schema, block)


def kernel_regress(test: DataFrame, train: DataFrame, c: float = 2.0, block: int = 2048) -> DataFrame:
    """``sum(y * exp(c*s)) / sum(exp(c*s))`` over the training rows. A
    block pair yields one row of sums per test row; its pairs are no rows."""
    schema = T.StructType([T.StructField("id", test.schema["id"].dataType), T.StructField("top", T.DoubleType()),
                           T.StructField("bottom", T.DoubleType())])

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        s = _similarities(a, b)
        w = np.where(np.isfinite(s), np.exp(c * s), 0.0)
        y = b.column("y").cast(pa.float64()).to_numpy(zero_copy_only=False)
        return pa.table({"id": a.column("id"), "top": pa.array(w @ np.nan_to_num(y)), "bottom": pa.array(w.sum(axis=1))})

    sums = block_apply(test.select("id", "x"), train.select("x", "y"), ["id"], ["y"], run, schema, block)
    return sums.groupBy("id").agg(F.try_divide(F.sum("top"), F.sum("bottom")).alias("pred"))


def ols_fit(df: DataFrame, y: str, xs: list[str], intercept: bool = True, l2: float = 0.0) -> np.ndarray:
    """Least squares (ridge when ``l2 > 0``; the penalty also
    applies to the intercept) from one aggregate of cross products.

    Objective ``mean((w.x - y)^2) + l2 * w.w``; the (k+1)^2 sums are the only
    thing brought to the driver."""
    cols = ([F.lit(1.0)] if intercept else []) + [F.col(c).cast("double") for c in xs]
    k = len(cols)
    aggs = [F.count(F.lit(1)).alias("n")]
    for i in range(k):
        aggs.append(F.sum(cols[i] * F.col(y).cast("double")).alias(f"xy{i}"))
        for j in range(i, k):
            aggs.append(F.sum(cols[i] * cols[j]).alias(f"xx{i}_{j}"))
    r = df.agg(*aggs).first()
    n = r["n"]
    A = np.zeros((k, k))
    b = np.zeros(k)
    for i in range(k):
        b[i] = r[f"xy{i}"] / n
        for j in range(i, k):
            A[i, j] = A[j, i] = r[f"xx{i}_{j}"] / n
    A += l2 * np.eye(k)
    return np.linalg.solve(A, b)


def predict_linear(df: DataFrame, coef: np.ndarray, xs: list[str], intercept: bool = True, out: str = "pred") -> DataFrame:
    terms = [F.lit(float(coef[0]))] if intercept else []
    off = 1 if intercept else 0
    for i, c in enumerate(xs):
        terms.append(F.lit(float(coef[i + off])) * F.col(c).cast("double"))
    e = terms[0]
    for t in terms[1:]:
        e = e + t
    return df.withColumn(out, e)


class RidgeSGD:
    """Ridge linear regression by mini-batch SGD.

    Objective ``mean((w.x - y)^2) + l2 * w.w`` (intercept penalised). Every
    epoch is a permutation of the rows (MD5 draws), dealt into steps of exactly
    ``batch`` rows without replacement (the last step takes what is left over
    too). The permutation is written with its steps in folders, so an epoch
    reads the table once and a step's sums read only its folder; the small
    weight vector is updated on the driver from one row of sums a step.
    Steps of up to ``LOCAL`` rows are taken several at a time: a window of whole
    steps of at most that many rows is read in order by one task, which applies
    them one after the other.
    """

    LOCAL = 65_536
    DIGITS = 4  # of the draws, by which rows are counted
    FOLDERS = 64  # steps that every task writes for itself

    def __init__(self, lr: float = 0.001, l2: float = 0.1, batch: int = 1, epochs: int = 50, seed: int = 100,
                 init: np.ndarray | None = None):
        self.lr, self.l2, self.batch, self.epochs, self.seed = lr, l2, batch, epochs, seed
        self.w = init

    def _step(self, w: np.ndarray, gradient: np.ndarray, rows: int) -> np.ndarray:
        return w - self.lr * (gradient * 2.0 / rows + 2 * self.l2 * w)

    def fit(self, df: DataFrame, y: str, xs: list[str], row_id: str) -> "RidgeSGD":
        k = len(xs) + 1
        rng = np.random.default_rng(self.seed)
        w = rng.normal(0, 1, k) if self.w is None else np.array(self.w, dtype=float)
        x = [F.lit(1.0)] + [F.col(c).cast("double") for c in xs]
        base = materialize(df.select(F.col(row_id).alias("rid"), *[c.alias(f"x{i}") for i, c in enumerate(x)],
                                     F.col(y).cast("double").alias("y")))
        n = base.count()
        if not n:
            self.w = w
            return self
        batch = min(self.batch, n)
        steps = n // batch
        per_folder = max(1, self.LOCAL // batch)  # steps that are read together
        cols = [f"x{i}" for i in range(k)]
        for epoch in range(self.epochs):
            key = F.md5(F.concat_ws(":", F.lit(self.seed), F.lit(epoch), F.to_json(F.struct("rid"))))
            if per_folder == 1:
                dealt = self._deal(base.withColumn("__k", key), cols, batch, steps)
                for step in range(steps):
                    w = self._read(dealt.where(F.col("folder") == step), w, cols, per_folder)
                discard(dealt)
                continue
            placed = global_row_number(base.withColumn("__k", key), [F.col("__k"), F.col("rid")], "__rn")
            step = F.least(F.floor((F.col("__rn") - 1) / F.lit(batch)), F.lit(steps - 1)).cast("int")
            placed = placed.select(*cols, "y", F.col("__rn").alias("rn"), step.alias("step")) \
                           .withColumn("folder", F.floor(F.col("step") / per_folder).cast("int"))
            dealt = materialize_partitioned(placed.repartition("folder"), "folder")
            for folder in range(-(-steps // per_folder)):
                w = self._read(dealt.where(F.col("folder") == folder), w, cols, per_folder)
            discard(dealt)
        discard(base)
        self.w = w
        return self

    def _deal(self, keyed: DataFrame, cols: list[str], batch: int, steps: int) -> DataFrame:
        """The rows in folders, one a step of ``batch`` rows in the order of
        ``(__k, rid)``, as :func:`global_row_number` would number them, without
        sorting them all: rows are counted by the first digits of ``__k``, and
        only the groups in which one step ends and the next begins are sorted."""
        keyed = keyed.withColumn("__g", F.substring("__k", 1, self.DIGITS))
        before = Window.orderBy("__g").rowsBetween(Window.unboundedPreceding, -1)  # over the groups, at most 16 ** DIGITS

        def step(rn: Column) -> Column:
            return F.least(F.floor((rn - 1) / F.lit(batch)), F.lit(steps - 1)).cast("int")

        groups = keyed.groupBy("__g").agg(F.count(F.lit(1)).alias("__n")) \
            .withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0)))
        groups = materialize(groups.select("__g", "__before", step(F.col("__before") + 1).alias("folder"),
                                           step(F.col("__before") + F.col("__n")).alias("__last")))
        rows = keyed.join(F.broadcast(groups), "__g")
        whole = rows.where(F.col("folder") == F.col("__last")).select(*cols, "y", "folder")
        at = F.row_number().over(Window.partitionBy("__g").orderBy("__k", "rid"))
        cut = rows.where(F.col("folder") < F.col("__last")).withColumn("folder", step(F.col("__before") + at)).select(*cols, "y", "folder")
        if steps > self.FOLDERS:  # else a task writes a file for each of the few steps
            whole = whole.repartition("folder")
        dealt = materialize_partitioned(whole.unionByName(cut), "folder")
        discard(groups)
        return dealt

    def _read(self, rows: DataFrame, w: np.ndarray, cols: list[str], per_folder: int) -> np.ndarray:
        """The weights after the steps of one folder."""
        if per_folder == 1:  # one step of many rows: one distributed sum
            err = sum((F.lit(float(w[i])) * F.col(c) for i, c in enumerate(cols)), F.lit(0.0)) - F.col("y")
            g = rows.agg(F.count(F.lit(1)).alias("m"), *[F.sum(err * F.col(c)).alias(c) for c in cols]).first()
            return self._step(w, np.array([g[c] for c in cols]), g["m"])
        start, take = w, self._step

        def run(part: pd.DataFrame) -> pd.DataFrame:
            part, now = part.sort_values("rn"), start
            x, y, step = part[cols].to_numpy(), part["y"].to_numpy(), part["step"].to_numpy()
            cuts = np.flatnonzero(np.diff(step)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(part)]):
                now = take(now, x[lo:hi].T @ (x[lo:hi] @ now - y[lo:hi]), hi - lo)
            return pd.DataFrame({"w": [now.tolist()]})

        return np.array(rows.groupBy("folder").applyInPandas(run, "w array<double>").first()["w"])

    def predict(self, df: DataFrame, xs: list[str], out: str = "pred") -> DataFrame:
        return predict_linear(df, self.w, xs, True, out)


def stacked_kernel_regress(train1: DataFrame, train2: DataFrame, test: DataFrame,
                           horizons: list[int], c: float = 2.0) -> tuple[DataFrame, np.ndarray]:
    """Kernel predictions at each horizon (prefix length of ``x``)
    for train2 and test from train1, OLS of y on them fitted on train2,
    applied to test. Returns (test predictions with y, coefficients)."""
    def feats(df):
        out = df.select("id", "y")
        for h in horizons:
            t = df.select("id", F.slice("x", 1, h).alias("x"))
            r = train1.select("id", F.slice("x", 1, h).alias("x"), "y")
            out = out.join(kernel_regress(t, r, c).withColumnRenamed("pred", f"d{h}"), "id")
        return out
    f2 = feats(train2)
    names = [f"d{h}" for h in horizons]
    coef = ols_fit(f2, "y", names)
    ft = predict_linear(feats(test), coef, names)
    return ft, coef
