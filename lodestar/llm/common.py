"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import hashlib
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from lodestar.session import checkpoint_dir

_STATE = "llm-state"
_tracked: list[list[str]] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def write_state(df: DataFrame) -> tuple[DataFrame, str]:
    """Write ``df`` under the shared checkpoint folder; return a scan of the
    files and their path (for :func:`drop_state`)."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{_STATE}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    for paths in _tracked:
        paths.append(path)
    return spark.read.schema(df.schema).parquet(path), path


@contextmanager
def tracked() -> Iterator[list[str]]:
    """The paths of all states written inside the block."""
    paths: list[str] = []
    _tracked.append(paths)
    try:
        yield paths
    finally:
        _tracked.remove(paths)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of steps whose results are written:
    its cleaner does so when the driver's objects for them are collected."""
    gc.collect()
    spark._jvm.System.gc()


def drop_state(spark: SparkSession, *paths: str) -> None:
    """Delete states that no later step reads."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for path in paths:
        if f"/{_STATE}/" not in path:
            raise ValueError(f"not a state folder: {path}")
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)


def give_back() -> None:
    """Return memory that is free again to the system: Arrow's pool, then the
    C library's. A Python worker is used for many tasks of different stages."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library; it keeps what it has


def lean(run: Callable) -> Callable:
    """A function over batches that gives its memory back when it ends."""
    @wraps(run)
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped


def text_bytes(batch: pa.RecordBatch, col: str) -> list[bytes]:
    """UTF-8 bytes of a string column, null as empty."""
    return [x or b"" for x in batch.column(col).cast(pa.binary()).to_pylist()]


class WordHashes(dict):
    """word (bytes) -> 64-bit hash, memoised per Python worker; at most
    ``limit`` words are kept, so memory does not follow the vocabulary."""

    def __init__(self, limit: int = 400_000, salt: bytes = b""):
        super().__init__()
        self.limit, self.salt = limit, salt

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        h = int.from_bytes(hashlib.blake2b(word, digest_size=8, key=self.salt).digest(), "little")
        self[word] = h
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.array(list(map(self.__getitem__, words)), dtype=np.uint64)


_MULT = np.uint64(0x9E3779B97F4A7C15)


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: spreads every input bit over the word."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """64-bit hash of every k-word window, in text order; a shorter non-empty
    sequence is one shingle, an empty one none."""
    n = len(h)
    if n == 0:
        return h
    k = min(n, k)
    out = h[: n - k + 1].copy()
    for j in range(1, k):
        out *= _MULT
        out += h[j: n - k + 1 + j]
    return mix(out + np.uint64(k))
