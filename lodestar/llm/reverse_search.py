"""Ranked lexical search, reversed: the items are indexed and the documents
stream past the index.

The terms of all items of a pass make an inverted index (term -> items with the
term's repeats in them), which is broadcast; ``ITEM_BYTES`` bounds the items of a
pass, and more items take more passes over the documents. A first stream over
the documents counts them, their terms, and the documents that hold each indexed
term. A second one sends each document's term counts through the index; a task
keeps one heap of the ``k`` best documents per item, and the heaps of all tasks
are merged in two stages, so that no group grows with the number of tasks times
``k`` alone.

Scores are 64-bit integers. With N documents of at least one term, L terms in
all, n terms in a document, df documents that hold a term and tf its occurrences
in the document, a term weighs w = floor(1000 ln((2N + 2) / (2 df + 1))), a
document has m = 75 + (25 n N) div L, and its score sums
w ((10^9 tf) div (1000 tf + 12 m)) over the item's terms, repeats included.

Terms are runs of characters other than ASCII non-alphanumerics, A-Z
lower-cased. Defined cases: null, empty and termless texts of documents are not
counted and never returned, items without terms return nothing, an item id in
several rows is one item with all their terms. Equal scores go by ascending id,
null ids last; repeated rows of a document rank one after the other. Empty
tables give no rows. Columns other than ids and texts are not read.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.plans.ranking import top_k_per_group

ITEM_BYTES = 8 << 20  # text of the items that are searched in one pass
CELLS = 1 << 20  # scores (documents x items) and postings held at once, or one document's
_LAST = np.iinfo(np.int64).max  # stands for a null id

_TO = bytes(c + 32 if 65 <= c <= 90 else 32 if c < 128 and not chr(c).isalnum() else c for c in range(256))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_TO).split()


class Index:
    """Inverted index of a pass: of term t, ``item[start[t]:start[t + 1]]`` are
    the items that hold it and ``times`` its repeats in them."""

    def __init__(self, items: list[tuple]):
        per: dict[object, Counter] = {}
        for i, text in items:
            per.setdefault(i, Counter()).update(terms_of((text or "").encode()))
        self.ids = list(per)
        self.term: dict[bytes, int] = {}
        posts = [(self.term.setdefault(t, len(self.term)), k, c) for k, i in enumerate(self.ids) for t, c in per[i].items()]
        posts.sort()
        t, self.item, self.times = (np.array(posts, np.int64).reshape(-1, 3).T.copy() if posts else np.zeros((3, 0), np.int64))
        self.start = np.searchsorted(t, np.arange(len(self.term) + 1))
        self.reach = np.diff(self.start).tolist()

    def counts(self, words: list[bytes]) -> tuple[list[int], list[int]]:
        """(indexed terms, occurrences) of a document."""
        found = Counter(words)
        both = [w for w in found if w in self.term] if len(found) < len(self.term) else [w for w in self.term if w in found]
        return [self.term[w] for w in both], [found[w] for w in both]


def passes(items: DataFrame, id_col: str, text_col: str, limit: int = ITEM_BYTES) -> Iterator[list[tuple]]:
    """The items in blocks of about ``limit`` bytes, each fit for a broadcast."""
    t = items.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where("text IS NOT NULL")
    size = t.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-size // limit)
    for i in range(n):
        yield [(r["id"], r["text"]) for r in t.where(F.pmod(F.xxhash64("id"), F.lit(n)) == i).collect()]


def corpus_counts(src: DataFrame, bc) -> tuple[int, int, np.ndarray]:
    """(N, L, df of every indexed term); every task sends its sums once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: Index = bc.value
        df, n, total = np.zeros(len(index.term), np.int64), 0, 0
        for b in batches:
            for text in b.column("text"):
                words = terms_of(text.as_py())
                if words:
                    n += 1
                    total += len(words)
                    df[index.counts(words)[0]] += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array([-2, -1, *at.tolist()], pa.int64()),
                                          pa.array([n, total, *df[at].tolist()], pa.int64())], names=["t", "c"])

    rows = src.select("text").mapInArrow(run, "t long, c long").groupBy("t").agg(F.sum("c").alias("c")).collect()
    got = {r["t"]: r["c"] for r in rows}  # a row a term of the pass
    return got.get(-2, 0), got.get(-1, 0), np.array([got.get(t, 0) for t in range(len(bc.value.term))], np.int64)


class Heaps:
    """The k best (score, id) of every item; smaller ids are better."""

    def __init__(self, n: int, k: int):
        self.k, self.heaps = k, [[] for _ in range(n)]
        self.least, self.id = np.zeros(n, np.int64), np.full(n, -1, np.int64)  # beyond these only

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        """scores (documents, items)"""
        beyond = (scores > self.least) | ((scores == self.least) & (ids[:, None] < self.id) & (scores > 0))
        for d, i in zip(*np.nonzero(beyond)):
            entry, heap = (int(scores[d, i]), -int(ids[d])), self.heaps[i]
            if len(heap) < self.k:
                heapq.heappush(heap, entry)
            elif entry > heap[0]:
                heapq.heapreplace(heap, entry)
            if len(heap) == self.k:
                self.least[i], self.id[i] = heap[0][0], -heap[0][1]


def search(docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``(item, rank, id, score)``: the ``k`` best documents of every item with
    a score above 0."""
    spark = docs.sparkSession
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").cast("binary").alias("text")) \
              .where("text IS NOT NULL")
    schema = T.StructType([T.StructField(item_col, items.schema[item_col].dataType), T.StructField(id_col, T.LongType()),
                           T.StructField("score", T.LongType()), T.StructField("__task", T.IntegerType())])
    best = spark.createDataFrame([], schema)
    for block in passes(items, item_col, item_text_col):
        bc = spark.sparkContext.broadcast(Index(block))
        n, total, df = corpus_counts(src, bc)
        if not n:
            break
        weight = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
        best = best.unionByName(src.mapInArrow(_scorer(bc, spark.sparkContext.broadcast(weight), n, total, k, schema), schema))
    ranked = top_k_per_group(best, [item_col], [F.col("score").desc(), F.col(id_col).asc_nulls_last()], k, "rank",
                             salt_buckets=64, salt_key=["__task"])
    return ranked.select(item_col, "rank", id_col, "score")


def _scorer(bc, bc_weight, n: int, total: int, k: int, schema: T.StructType):
    from pyspark.sql.pandas.types import to_arrow_type
    item_type = to_arrow_type(schema.fields[0].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        index, weight = bc.value, bc_weight.value
        heaps = Heaps(len(index.ids), k)
        n_items = max(1, len(index.ids))
        at_once = max(1, CELLS // n_items)
        ids, term, tf, doc, m = [], [], [], [], []
        n_posts = 0

        def settle() -> None:
            t, f, d = (np.array(x, np.int64) for x in (term, tf, doc))
            part = weight[t] * ((1_000_000_000 * f) // (1000 * f + 12 * np.array(m, np.int64)[d]))
            reach = index.start[t + 1] - index.start[t]
            # postings of all terms, one after the other
            post = np.arange(reach.sum()) + np.repeat(index.start[t] - (np.cumsum(reach) - reach), reach)
            scores = np.zeros(len(ids) * n_items, np.int64)
            np.add.at(scores, np.repeat(d, reach) * n_items + index.item[post], np.repeat(part, reach) * index.times[post])
            heaps.offer(scores.reshape(len(ids), n_items), np.array(ids, np.int64))
            for x in (ids, term, tf, doc, m):
                x.clear()

        for b in batches:
            for i, text in zip(b.column("id").to_pylist(), b.column("text")):
                words = terms_of(text.as_py())
                t, f = index.counts(words)
                if not t:
                    continue
                term += t
                tf += f
                doc += [len(ids)] * len(t)
                ids.append(_LAST if i is None else i)
                m.append(75 + 25 * len(words) * n // total)
                n_posts += sum([index.reach[x] for x in t])
                if len(ids) >= at_once or n_posts >= CELLS:
                    settle()
                    n_posts = 0
        if ids:
            settle()
        rows = [(index.ids[x], None if -e[1] == _LAST else -e[1], e[0]) for x, heap in enumerate(heaps.heaps) for e in heap]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], item_type), pa.array([r[1] for r in rows], pa.int64()),
             pa.array([r[2] for r in rows], pa.int64()),
             pa.array([TaskContext.get().partitionId()] * len(rows), pa.int32())], names=schema.names)

    return run
