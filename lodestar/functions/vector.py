"""Vector functions over ``array<double>`` columns (higher-order functions,
evaluated in the JVM)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _d(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(_d(a), _d(b), lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(F.transform(_d(a), lambda x: x * x), F.lit(0.0), lambda acc, x: acc + x))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; null when either vector is zero."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def scale(a: Column, s: Column) -> Column:
    return F.transform(_d(a), lambda x: x * s)


def l2_normalize(a: Column) -> Column:
    """Unit vector; a zero vector stays zero."""
    # the length is a variable of its own: inside the inner function Spark would
    # work it out again for every element
    unit = F.transform(F.array(norm(a)), lambda n: F.when(n == 0, _d(a)).otherwise(F.transform(_d(a), lambda x: F.try_divide(x, n))))
    return unit[0]


def mean_center(a: Column) -> Column:
    n = F.size(_d(a))
    m = F.try_divide(F.aggregate(_d(a), F.lit(0.0), lambda acc, x: acc + x), n)
    return F.transform(_d(a), lambda x: x - m)


def sample_sd(a: Column) -> Column:
    n = F.size(_d(a))
    c = mean_center(a)
    return F.sqrt(F.try_divide(F.aggregate(F.transform(c, lambda x: x * x), F.lit(0.0), lambda acc, x: acc + x), n - 1))


def pattern_similarity(a: Column, b: Column) -> Column:
    """sum((a-mean a)(b-mean b)) / (n * sd(a) * sd(b)), sample sd."""
    return F.try_divide(dot(mean_center(a), mean_center(b)), F.size(_d(a)) * sample_sd(a) * sample_sd(b))


def nan_to_zero(a: Column) -> Column:
    """B11."""
    return F.transform(_d(a), lambda x: F.nanvl(x, F.lit(0.0)))
