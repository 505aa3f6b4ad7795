import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lodestar.operators import kernel as K


@pytest.mark.parametrize("digits", [1, 4])
def test_large_steps_without_a_sort(spark, monkeypatch, digits):
    """Steps of many rows hold the rows that numbering them all would give, also
    where row ids repeat or are null, and the rows are not sorted as a whole (F17)."""
    df = spark.range(1000).select((F.col("id") / 1000).alias("x"), (F.col("id") % 7 / 7).alias("y"),
                                  F.when(F.col("id") % 10 != 0, F.floor(F.col("id") / 3)).alias("rid"))
    monkeypatch.setattr(K.RidgeSGD, "LOCAL", 100)
    monkeypatch.setattr(K.RidgeSGD, "DIGITS", digits, raising=False)

    def sorted_whole(*_):
        raise AssertionError("all rows are sorted")

    monkeypatch.setattr(K, "global_row_number", sorted_whole)
    dealt, write = [], K.materialize_partitioned

    def counted(rows, col):
        dealt.append([r["count"] for r in rows.groupBy(col).count().orderBy(col).collect()])
        return write(rows, col)

    monkeypatch.setattr(K, "materialize_partitioned", counted)
    got = K.RidgeSGD(lr=0.1, l2=0.1, batch=300, epochs=2, seed=3, init=np.zeros(2)).fit(df, "y", ["x"], "rid").w
    w = np.zeros(2)
    for epoch in range(2):
        k = F.md5(F.concat_ws(":", F.lit(3), F.lit(epoch), F.to_json(F.struct("rid"))))
        rn = F.row_number().over(Window.orderBy(k, "rid"))
        rows = df.select("x", "y", rn.alias("rn")).toPandas()
        steps = np.minimum((rows["rn"] - 1) // 300, 2)
        assert [int((steps == s).sum()) for s in range(3)] == [300, 300, 400]
        for s in range(3):
            part = rows[steps == s]
            x = np.column_stack([np.ones(len(part)), part["x"]])
            w = w - 0.1 * (x.T @ (x @ w - part["y"].to_numpy()) * 2 / len(part) + 0.2 * w)
    assert dealt == [[300, 300, 400]] * 2
    assert np.allclose(got, w, atol=2e-2)  # rows of equal ids may stand on either side of a cut
