"""Text column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Word characters in any script: letters, digits, underscore. Written as
# Unicode classes so the JVM regex and RE2 (the oracle) agree.
NON_WORD = r"[^\p{L}\p{N}_]"


def tokens(c: Column) -> Column:
    """Whitespace split with empty pieces removed (Python ``str.split()``)."""
    return F.filter(F.split(c, r"\s+"), lambda x: x != F.lit(""))


def tokenize(c: Column, min_len: int = 3) -> Column:
    """B1: whitespace tokens of length >= ``min_len`` (tested before
    lowering), lowered."""
    return F.transform(F.filter(tokens(c), lambda x: F.length(x) >= min_len), lambda x: F.lower(x))


def clean_word(c: Column) -> Column:
    """B2: strip every non-word character, then lower."""
    return F.lower(F.regexp_replace(c, NON_WORD, ""))
