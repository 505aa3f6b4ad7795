"""Corpus preparation: each stage works on all its predecessor kept.

Defined cases: null, empty and very long texts, repeated rows, null ids, empty
tables and extra columns whose names clash with inner ones pass through the
stages as each operator's docstring says. Rows with too few words go in the first
stage, so null and empty texts never reach the others; of rows with one id or no
id and equal words one stays (stage two); all columns are kept up to the last
stage, which returns the packed pieces.
"""

from __future__ import annotations

import uuid
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from lodestar.llm import decontaminate, host_rules, jaccard, packing, pii
from lodestar.llm.common import drop_state, release, table, tracked
from lodestar.llm.queries import tokenizer_json
from lodestar.session import checkpoint_dir

_chain: list[tuple[int, str, list[str]]] = []  # (stage, input folder, states) of the calls that follow each other


def _small_batches(spark: SparkSession) -> None:
    """Whole texts go to Python 2,000 rows at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")


def stage(fn):
    """A stage keeps the states that its result is read from. They go when a
    later stage is called for the same input folder: its ``docs`` are then the
    written result. A call that does not continue the latest row of calls begins
    one of its own and deletes nothing, so results of one stage, or of several
    runs, stay readable side by side."""

    @wraps(fn)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        number = [f for _, f in STAGES].index(run_stage)
        if _chain and _chain[-1][0] == number - 1 and _chain[-1][1] == sf_dir:
            drop_state(spark, *_chain.pop()[2])
        _chain.clear()
        release(spark)
        _small_batches(spark)
        with tracked() as paths:
            out = fn(spark, docs, sf_dir)
        _chain.append((number, sf_dir, paths))
        return out

    return run_stage


@stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither their own rules nor their host rejects."""
    return host_rules.keep(docs)


@stage
def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at 0.8."""
    return jaccard.drop_copies(docs, k=5, percent=80)


@stage
def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window similar to a benchmark item."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), percent=80)


@stage
def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Found personal data replaced by ``<kind>``."""
    return pii.redact(docs)


@stage
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents in sequences of 2048."""
    return packing.pack_documents(docs, tokenizer_json(), max_len=2048)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", benchmark_passages),
    ("PII", redact_pii),
    ("best-fit packing", packed),
]

# sequence packing by local search has no SQL form; tests compare the stages with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written to the shared
    folder, read again as the next stage's input and deleted when that one's has
    been written. The result is read from the pieces that the last stage wrote."""
    _small_batches(spark)
    docs = table(spark, sf_dir, "documents")
    base = f"{checkpoint_dir(spark).rstrip('/')}/llm-state/pipeline-{uuid.uuid4().hex}"
    before = []
    for k, (_, call) in enumerate(STAGES):
        with tracked() as states:
            out = call.__wrapped__(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            out.write.parquet(f"{base}/{k}")
            drop_state(spark, *states, *before)
            before = [f"{base}/{k}"]
            docs = spark.read.schema(out.schema).parquet(f"{base}/{k}")
            release(spark)
    drop_state(spark, base)  # the pieces are written
    return out
