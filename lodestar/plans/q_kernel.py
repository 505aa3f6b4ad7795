"""Kernel regression on ``embeddings`` and linear/ridge regression on
``lineitem``."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestar.operators import kernel as K
from lodestar.plans.registry import query
from lodestar.sources.tables import Tables

L2 = 0.1


def _windows(spark, d, h: int | None = None):
    """x = embedding components (all, or the first h), y = label;
    split train1 / train2 / test by vec_id mod 3 = 0 / 1 / 2."""
    e = Tables(spark, d).embeddings
    x = F.col("embedding").cast("array<double>")
    if h:
        x = F.slice(x, 1, h)
    return e.select(F.col("vec_id").alias("id"), x.alias("x"), F.col("label").cast("double").alias("y"),
                    F.pmod("vec_id", F.lit(3)).alias("part"))


def _kernel_sql(h: int) -> str:
    return f"""w AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[])[1:{h}] AS x, CAST(label AS DOUBLE) AS y,
  vec_id % 3 AS part FROM embeddings),
c AS (SELECT id, y, part, list_transform(x, lambda e: e - list_avg(x)) AS c, len(x) AS n FROM w),
s AS (SELECT id, y, part, c, n, sqrt(list_dot_product(c, c) / (n - 1)) AS sd FROM c),
kr AS (SELECT t.id, sum(r.y * exp(2 * list_dot_product(t.c, r.c) / (t.n * t.sd * r.sd)))
  / sum(exp(2 * list_dot_product(t.c, r.c) / (t.n * t.sd * r.sd))) AS pred
  FROM s t CROSS JOIN s r WHERE t.part = 2 AND r.part = 0 GROUP BY t.id)"""


@query("kernel_regress", "WITH " + _kernel_sql(64) + " SELECT id, round(pred, 6) AS pred FROM kr")
def kernel_regress(spark, d):
    w = _windows(spark, d)
    r = K.kernel_regress(w.where("part = 2"), w.where("part = 0"), c=2.0)
    return r.select("id", F.round("pred", 6).alias("pred"))


def _stacked_sql() -> str:
    """The fit by successive residuals: each horizon's prediction less its fit
    on the ones before it, so that the slopes are those of simple regressions."""
    hs = [16, 32, 64]
    w = "w AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS x, CAST(label AS DOUBLE) AS y, vec_id % 3 AS part FROM embeddings)"
    kr = [f"""c{h} AS (SELECT id, y, part, list_transform(x[1:{h}], lambda e: e - list_avg(x[1:{h}])) AS c, {h} AS n FROM w),
s{h} AS (SELECT *, sqrt(list_dot_product(c, c) / (n - 1)) AS sd FROM c{h}),
k{h} AS (SELECT t.id, t.part, t.y, sum(r.y * exp(2 * list_dot_product(t.c, r.c) / (t.n * t.sd * r.sd)))
  / sum(exp(2 * list_dot_product(t.c, r.c) / (t.n * t.sd * r.sd))) AS p FROM s{h} t CROSS JOIN s{h} r
  WHERE t.part <> 0 AND r.part = 0 GROUP BY t.id, t.part, t.y)""" for h in hs]
    return f"""WITH {w}, {', '.join(kr)},
f AS (SELECT a.id, a.part, a.y, a.p AS x1, b.p AS x2, c.p AS x3 FROM k16 a JOIN k32 b ON b.id = a.id JOIN k64 c ON c.id = a.id),
g1 AS (SELECT avg(y) AS my, avg(x1) AS m1, avg(x2) AS m2, avg(x3) AS m3 FROM f WHERE part = 1),
z1 AS (SELECT id, part, y, x1 - m1 AS q1, x2 - m2 AS x2, x3 - m3 AS x3, my FROM f, g1),
g2 AS (SELECT sum(q1 * x2) / sum(q1 * q1) AS r12, sum(q1 * x3) / sum(q1 * q1) AS r13 FROM z1 WHERE part = 1),
z2 AS (SELECT id, part, y, my, q1, x2 - r12 * q1 AS q2, x3 - r13 * q1 AS x3 FROM z1, g2),
g3 AS (SELECT sum(q2 * x3) / sum(q2 * q2) AS r23 FROM z2 WHERE part = 1),
z3 AS (SELECT id, part, y, my, q1, q2, x3 - r23 * q2 AS q3 FROM z2, g3),
b AS (SELECT sum(q1 * y) / sum(q1 * q1) AS b1, sum(q2 * y) / sum(q2 * q2) AS b2, sum(q3 * y) / sum(q3 * q3) AS b3 FROM z3 WHERE part = 1)
SELECT round(avg((y - my - b1 * q1 - b2 * q2 - b3 * q3) ** 2), 6) AS mse, count(*) AS n_test FROM z3, b WHERE part = 2"""


@query("stacked_kernel_regress", _stacked_sql())
def stacked(spark, d):
    """Horizons 16 / 32 / 64 components; OLS on train2; MSE on test."""
    w = _windows(spark, d)
    ft, coef = K.stacked_kernel_regress(w.where("part = 0"), w.where("part = 1"), w.where("part = 2"), [16, 32, 64])
    return ft.agg(F.round(F.avg((F.col("y") - F.col("pred")) ** 2), 6).alias("mse"), F.count(F.lit(1)).alias("n_test"))


LI_SQL = "li AS (SELECT l_quantity AS x, l_extendedprice AS y FROM lineitem)"


@query("ols_fit", f"""WITH {LI_SQL}
SELECT round(regr_intercept(y, x), 6) AS intercept, round(regr_slope(y, x), 6) AS slope FROM li""")
def ols(spark, d):
    li = Tables(spark, d).lineitem
    coef = K.ols_fit(li, "l_extendedprice", ["l_quantity"])
    # the two coefficients come from one aggregate over the whole table
    return spark.createDataFrame([(round(float(coef[0]), 6), round(float(coef[1]), 6))], "intercept double, slope double")


RIDGE_SQL = f"""r AS (SELECT l_quantity / 50.0 AS x, l_extendedprice / 100000.0 AS y FROM lineitem),
m AS (SELECT avg(x) AS b, avg(x * x) AS xx, avg(y) AS r0, avg(x * y) AS r1 FROM r),
w AS (SELECT (r0 * (xx + {L2}) - b * r1) / ((1 + {L2}) * (xx + {L2}) - b * b) AS w0,
  ((1 + {L2}) * r1 - b * r0) / ((1 + {L2}) * (xx + {L2}) - b * b) AS w1 FROM m)"""


def _ridge_input(spark, d):
    li = Tables(spark, d).lineitem
    return li.select((F.col("l_quantity") / 50.0).alias("x"), (F.col("l_extendedprice") / 100000.0).alias("y"),
                     "l_orderkey", "l_linenumber")


@query("ridge_closed_form", f"WITH {RIDGE_SQL} SELECT round(w0, 6) AS w0, round(w1, 6) AS w1 FROM w")
def ridge(spark, d):
    coef = K.ols_fit(_ridge_input(spark, d), "y", ["x"], l2=L2)
    return spark.createDataFrame([(round(float(coef[0]), 6), round(float(coef[1]), 6))], "w0 double, w1 double")


@query("ridge_mse", f"""WITH {RIDGE_SQL}
SELECT round(avg((w0 + w1 * x - y) * (w0 + w1 * x - y)), 6) AS mse,
       round(sqrt(avg((w0 + w1 * x - y) * (w0 + w1 * x - y))), 6) AS rmse FROM r, w""")
def ridge_mse(spark, d):
    """D14 on the ridge fit."""
    from lodestar.operators.classify import mse
    r = _ridge_input(spark, d)
    coef = K.ols_fit(r, "y", ["x"], l2=L2)
    p = K.predict_linear(r, coef, ["x"])
    return mse(p, "y", "pred").select(F.round("mse", 6).alias("mse"), F.round("rmse", 6).alias("rmse"))


@query("ridge_sgd")
def ridge_sgd(spark, d):
    """H20 with large batches (one Spark aggregate per step)."""
    r = _ridge_input(spark, d).withColumn("rid", F.struct("l_orderkey", "l_linenumber"))
    n = r.count()
    m = K.RidgeSGD(lr=0.1, l2=L2, batch=max(1, n // 4), epochs=5, seed=100).fit(r, "y", ["x"], "rid")
    p = m.predict(r, ["x"])
    return p.agg(F.sqrt(F.avg((F.col("y") - F.col("pred")) ** 2)).alias("rmse"))
