"""Document fingerprints by a quartile bucket digest.

Every text is a run of UTF-8 bytes. In each window of five bytes the last byte
and any two of the four before it make six triplets; every kind of triplet is
hashed into ``buckets`` counters. A counter is encoded by the quartile of all
counters in which it lies (two bits), and the text's length by a byte of eighth
octaves. The digest is the length and the codes as hexadecimal text.

Two digests differ by the sum of the differences of their codes (at most 3 each)
plus the difference of their lengths in eighth octaves, ``buckets`` / 32 each and
at most ``LENGTH_STEPS`` of them. That sum is bounded, so one minus its share of
the bound is a likeness between 0 and 1, and equal digests have likeness 1.

Neighbours in ascending order of the id are found with one shuffle of the
texts: the id range is cut at quantiles, and a slice's first row is also sent to
the slice before it (the first of all to the last), so that every row meets its
successor while a sorted slice is streamed; one row is held at a time.

Defined cases: a null text is an empty one, whose counters are all 0; texts
below three bytes have no triplets; where fewer than a quarter of the counters
are above 0 their codes are 3 and the others 0. Rows of equal ids are ordered by
a hash of the text, null ids come last, repeated rows are returned as often as
they occur (copies of one id's row stay in one slice and are streamed), a single
row is its own successor, an empty table gives no rows. Columns other than id
and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 1024  # a power of two
LENGTH_STEPS = 24
KINDS = ((1, 2), (1, 3), (2, 3), (1, 4), (2, 4), (3, 4))  # offsets back from the window's last byte
_MULT = np.uint32(2654435761)  # 2^32 divided by the golden ratio


def codes(text: bytes, buckets: int = BUCKETS) -> tuple[int, np.ndarray]:
    """(length code, quartile code of every counter)."""
    b = np.frombuffer(text, np.uint8).astype(np.uint32)
    shift = np.uint32(32 - (buckets - 1).bit_length())
    counts = np.zeros(buckets, np.int64)
    for kind, (i, j) in enumerate(KINDS):
        if len(b) > j:
            x = b[j:] | b[j - i: len(b) - i] << np.uint32(8) | b[: len(b) - j] << np.uint32(16) | np.uint32(kind << 24)
            x *= _MULT
            counts += np.bincount(x >> shift, minlength=buckets)
    ranks = [buckets // 4 - 1, buckets // 2 - 1, 3 * buckets // 4 - 1]
    low, mid, high = np.partition(counts, ranks)[ranks]
    out = (counts > low).astype(np.uint8) + (counts > mid) + (counts > high)
    return min(255, int(8 * np.log2(len(b) + 1.0))), out


def digest(length: int, code: np.ndarray) -> str:
    four = code.reshape(-1, 4)
    return bytes([length, *(four[:, 0] << 6 | four[:, 1] << 4 | four[:, 2] << 2 | four[:, 3]).tolist()]).hex()


def undigest(fingerprint: str) -> tuple[int, np.ndarray]:
    raw = np.frombuffer(bytes.fromhex(fingerprint), np.uint8)
    return int(raw[0]), (raw[1:, None] >> np.array([6, 4, 2, 0], np.uint8) & 3).reshape(-1)


def likeness(a: tuple[int, np.ndarray], b: tuple[int, np.ndarray]) -> float:
    """1 - difference / its bound."""
    n = len(a[1])
    body = int(np.abs(a[1].astype(np.int16) - b[1]).sum())
    size = min(abs(a[0] - b[0]), LENGTH_STEPS) * (n // 32)
    return 1.0 - (body + size) / (3 * n + LENGTH_STEPS * (n // 32))


def fingerprints(docs: DataFrame, buckets: int = BUCKETS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, fingerprint)``; nothing is shuffled."""
    src = docs.select(F.col(id_col), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("__text"))
    schema = T.StructType([src.schema[id_col], T.StructField("fingerprint", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [digest(*codes(t.as_py(), buckets)) for t in b.column("__text")]
            yield pa.RecordBatch.from_arrays([b.column(id_col), pa.array(found, pa.string())], names=schema.names)

    return src.mapInArrow(run, schema)


def with_likeness(pairs: DataFrame, a: str, b: str, name: str = "likeness") -> DataFrame:
    """``pairs`` plus the likeness of two fingerprint columns (null where
    either is)."""
    @F.pandas_udf("double")
    def compare(x, y):
        import pandas as pd
        return pd.Series([likeness(undigest(p), undigest(q)) if p and q else None for p, q in zip(x, y)], dtype="float64")

    return pairs.withColumn(name, compare(F.col(a), F.col(b)))


def with_successor(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows ``(slice, guest, id, hash, text)``, sorted inside every partition by
    slice, guest and id. A slice's last rows are guests: the rows that follow it."""
    spark = docs.sparkSession
    src = docs.select(F.col(id_col).cast("long").alias("id"),
                      F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    src = src.withColumn("hash", F.xxhash64("text")).withColumn("at", F.col("id").cast("double"))
    n = 4 * max(src.rdd.getNumPartitions(), int(spark.conf.get("spark.sql.shuffle.partitions")))
    cuts = src.select("at").approxQuantile("at", [k / n for k in range(1, n)], 0.25 / n) if n > 1 else []
    splits = [-float("inf"), *(sorted(set(cuts)) or [0.0]), float("inf")]
    src = Bucketizer(splits=splits, inputCol="at", outputCol="cut", handleInvalid="keep").transform(src) \
        .select(F.coalesce(F.col("cut").cast("int"), F.lit(len(splits))).alias("slice"), "id", "hash", "text")
    order = F.struct(F.col("id").isNull().alias("last"), "id", "hash")
    firsts = src.groupBy("slice").agg(F.min(order).alias("first")).orderBy("slice").collect()  # one row a slice
    guests = [(r["first"]["id"], r["first"]["hash"], firsts[k - 1]["slice"]) for k, r in enumerate(firsts)]
    table = spark.createDataFrame(guests, "f_id long, f_hash long, f_slice int")
    met = src.join(F.broadcast(table), F.col("id").eqNullSafe(F.col("f_id")) & (F.col("hash") == F.col("f_hash")), "left")
    to = F.when(F.col("f_slice").isNull(), F.array(F.struct(F.lit(False).alias("guest"), F.col("slice").alias("slice")))) \
          .otherwise(F.array(F.struct(F.lit(False).alias("guest"), F.col("slice").alias("slice")),
                             F.struct(F.lit(True).alias("guest"), F.col("f_slice").alias("slice"))))
    dealt = met.select(F.explode(to).alias("to"), "id", "hash", "text").select("to.slice", "to.guest", "id", "hash", "text")
    return dealt.repartition(n, "slice").sortWithinPartitions("slice", "guest", F.col("id").asc_nulls_last(), "hash")


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter replaced by the first as many characters
    (or all) of ``following``."""
    k = len(text) // 4
    return text[: len(text) - k] + following[:k]


def edited_neighbours(docs: DataFrame, buckets: int = BUCKETS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next)``: every text's digest against that of its edited
    text and of its successor."""
    schema = T.StructType([
        T.StructField(id_col, T.LongType()), T.StructField("n_chars", T.LongType()), T.StructField("edited_sha256", T.StringType()),
        T.StructField("fingerprint", T.StringType()), T.StructField("edited_fingerprint", T.StringType()),
        T.StructField("near_edited", T.DoubleType()), T.StructField("near_next", T.DoubleType())])

    def row(own: tuple, following: tuple) -> tuple:
        _, i, text, code = own
        changed = edited(text, following[2]).encode()
        new = codes(changed, buckets)
        return (i, len(text), hashlib.sha256(changed).hexdigest(), digest(*code), digest(*new),
                likeness(code, new), likeness(code, following[3]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # a row whose successor has not come yet
        for b in batches:
            out = []
            for s, guest, i, text in zip(b.column("slice").to_pylist(), b.column("guest").to_pylist(),
                                         b.column("id").to_pylist(), b.column("text")):
                if guest and held is None:
                    continue  # a repeated row of the guest
                t = text.as_py()
                own = (s, i, t, codes(t.encode(), buckets))
                if held is not None:
                    out.append(row(held, own))
                held = None if guest else own
            cols = list(zip(*out)) or [()] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, x) for c, x in zip(cols, types)], names=schema.names)

    types = [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]
    return with_successor(docs, id_col, text_col).drop("hash").mapInArrow(run, schema)
