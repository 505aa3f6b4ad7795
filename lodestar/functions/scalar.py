"""Scalar column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_star(c: Column) -> Column:
    """Rating to integer star, half away from zero (0.5 -> 1)."""
    return F.round(c.cast("double"), 0).cast("int")


def scaled_bid(bid: Column, initial: Column, current: Column) -> Column:
    """Bid * (1 - exp(spent_fraction - 1))."""
    frac = (initial.cast("double") - current.cast("double")) / initial.cast("double")
    return bid.cast("double") * (F.lit(1.0) - F.exp(frac - F.lit(1.0)))


def keep_probability(count: Column, total: Column, sample: float) -> Column:
    """Frequent-word keep probability, 1 when sample = 0."""
    if sample <= 0:
        return F.lit(1.0)
    t = F.lit(sample) * total.cast("double")
    c = count.cast("double")
    return F.least(F.lit(1.0), (F.sqrt(c / t) + F.lit(1.0)) * (t / c))


def with_intercept(v: Column) -> Column:
    """Prepend a constant 1.0."""
    return F.concat(F.array(F.lit(1.0)), v.cast("array<double>"))


def trunc2(c: Column) -> Column:
    """Truncate toward zero to 2 decimals."""
    return (c * 100).cast("long") / F.lit(100.0)


def node_key(prefix: str, *parts: Column) -> Column:
    """Namespaced node key ``prefix<p1>_<p2>..``."""
    cols = [p.cast("string") for p in parts]
    return F.concat(F.lit(prefix), F.concat_ws("_", *cols))


def draw(*parts: Column | int | str) -> Column:
    """A 32-bit number from an MD5 of the parts joined by colons: the same on
    any engine, layout or retry."""
    cols = [p if isinstance(p, Column) else F.lit(p) for p in parts]
    return F.conv(F.substring(F.md5(F.concat_ws(":", *[c.cast("string") for c in cols])), 1, 8), 16, 10).cast("long")


def uniform(*parts: Column | int | str) -> Column:
    """:func:`draw` as a number in [0, 1)."""
    return draw(*parts) / float(1 << 32)
