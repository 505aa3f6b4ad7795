"""Loop helper for iterative operators (graph frontiers, fixed points).

Each round writes the new state to the shared checkpoint folder, counts its
changes and deletes the state before it (never a local checkpoint: an executor
loss must not lose state).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame

from lodestar.session import checkpoint_dir


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class NotConverged(RuntimeError):
    pass


def _write(df: DataFrame, partition: str | None = None) -> DataFrame:
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/lodestar-state/{uuid.uuid4().hex}"
    w = df.write.mode("overwrite")
    # the written state stands for the shuffles of its plan: they go with the
    # write, not when the driver happens to collect its garbage
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        (w.partitionBy(partition) if partition else w).parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    out = spark.read.parquet(path)
    out._state_path = path
    return out


def materialize(df: DataFrame) -> DataFrame:
    """Materialise ``df`` as a table in the shared checkpoint folder and
    return a fresh scan of it.

    A round that reads the previous state k times builds a plan k times the
    size of the last one, and a checkpointed Dataset still keeps its origin
    plan for statistics, so long loops are cut by writing the state as
    parquet under the session's ``spark.checkpoint.dir`` and reading it back:
    the next round starts from a file scan (with real size statistics for
    AQE), and the files survive the loss of the executors that wrote them.
    """
    return _write(df)


def materialize_partitioned(df: DataFrame, col: str) -> DataFrame:
    """As :func:`materialize`, with the table partitioned by ``col`` so later
    filters on it read only the matching folders."""
    return _write(df, col)


def discard(*states: DataFrame) -> None:
    """Delete the files of materialised states that no plan reads any more."""
    for df in states:
        path = getattr(df, "_state_path", None)
        if path:
            spark = df.sparkSession
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
            df._state_path = None


def fixpoint(state: DataFrame,
             step: Callable[[DataFrame, int], DataFrame],
             changes: Callable[[DataFrame], int],
             max_iter: int | None = None) -> tuple[DataFrame, int]:
    """Run ``state = step(state, i)`` until ``changes(state) == 0``.

    ``changes`` runs one action on the written new state (typically a
    filtered count). Each state is deleted once its successor is written.
    Returns (state, rounds); a limit that is reached raises
    :class:`NotConverged`, an unfinished state is never returned.
    """
    cur = materialize(state)
    i = 0
    while max_iter is None or i < max_iter:
        i += 1
        nxt = materialize(step(cur, i))
        n = changes(nxt)
        discard(cur)
        cur = nxt
        if n == 0:
            return cur, i
    raise NotConverged(f"no fixed point after {max_iter} rounds")
