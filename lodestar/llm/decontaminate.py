"""Benchmark decontamination by SimHash windows.

A document is contaminated by an item if some window of the item's number of
words has a weighted similarity of at least ``percent`` / 100 with it: the sum
of the smaller over the sum of the larger multiplicities of their word
shingles.

Posting lists of the items' shingles find the documents and the windows to look
at: a window that reaches the similarity shares so many shingles with the item
that it is among them. Each such window gets a 128-bit SimHash of its shingles,
cut into sixteen blocks of eight bits. A block is near if it differs in at most
two bits; within the radius of 36 at least four blocks are near, as the twelve
others would need three bits each, so pairs with fewer are passed over without
their distance. What passes the full distance is verified exactly. At a
similarity of 0.8 the expected distance is 19 of 128 bits and the radius lies
four deviations above. A pass keeps 16 bytes an item for the blocks and compares
``PAIRS`` pairs of windows and items at a time.

Words are lower-cased (A-Z) runs without ASCII punctuation. An item with fewer
words than a shingle is one shingle of its own length. A document shorter than
an item has one window, all of it. Null, empty and blank texts of either side
match nothing; repeated rows are judged each; an empty benchmark leaves all
documents clean. Other columns are not read, and kept where rows are filtered.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.llm.common import WordHashes, lean, mix, shingle_hashes

SHINGLE = 5
RADIUS = 36
BLOCK_BITS = 8
BLOCKS = 128 // BLOCK_BITS
PAIRS = 1 << 20
ITEM_WORDS = 1_000_000  # of the items searched in one pass; more items take more passes

_TO = bytes(c + 32 if 65 <= c <= 90 else 32 if c < 128 and not chr(c).isalnum() else c for c in range(256))
_ONES = np.array([bin(i).count("1") for i in range(256)], np.uint8)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TO).split()


def bits_of(h: np.ndarray) -> np.ndarray:
    """(shingles, 128) bits."""
    wide = np.stack([h, mix(h ^ np.uint64(0xA5A5A5A55A5A5A5A))], 1)
    return np.unpackbits(np.ascontiguousarray(wide).view(np.uint8).reshape(len(h), 16), axis=1)


def fingerprints(h: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Packed SimHashes of the windows h[s : s + length]."""
    lo, hi = int(starts[0]), int(starts[-1]) + length
    sums = np.zeros((hi - lo + 1, 128), np.int32)
    np.cumsum(bits_of(h[lo:hi]), axis=0, out=sums[1:])
    at = starts - lo
    return np.packbits(2 * (sums[at + length] - sums[at]) > length, axis=1)


def similarity(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """(sum of smaller, sum of larger multiplicities)."""
    ua, ca = np.unique(a, return_counts=True)
    ub, cb = np.unique(b, return_counts=True)
    _, ia, ib = np.intersect1d(ua, ub, assume_unique=True, return_indices=True)
    inter = int(np.minimum(ca[ia], cb[ib]).sum())
    return inter, len(a) + len(b) - inter


class Index:
    """The items of one pass: their shingles' posting lists and fingerprints,
    some 20 bytes a shingle and 16 an item."""

    def __init__(self, items: list[tuple[int, bytes]], percent: int, radius: int = RADIUS):
        self.percent, self.radius = percent, radius
        words = WordHashes()
        self.sets: list[np.ndarray] = []
        self.place: list[int] = []  # row of the item
        self.k: list[int] = []
        by_k: dict[int, list[int]] = {}
        for row, text in items:
            h = words.of(words_of(text))
            if not len(h):
                continue
            k = min(SHINGLE, len(h))
            by_k.setdefault(k, []).append(len(self.sets))
            self.place.append(row)
            self.k.append(k)
            self.sets.append(shingle_hashes(h, k))
        self.size = np.array([len(s) for s in self.sets], np.int64)
        self.postings = {}
        for k, own in by_k.items():
            tok = np.concatenate([np.unique(self.sets[i]) for i in own])
            item = np.repeat(own, [len(np.unique(self.sets[i])) for i in own])
            order = np.argsort(tok, kind="stable")
            keys, start = np.unique(tok[order], return_index=True)
            self.postings[k] = keys, np.append(start, len(tok)), item[order]
        self.prints = np.zeros((len(self.sets), 16), np.uint8)
        for i, x in enumerate(self.sets):
            self.prints[i] = fingerprints(x, np.array([0]), len(x))[0]

    def within(self, got: np.ndarray, items: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(window, item) pairs within the radius, some windows at a time: by
        blocks first, by the whole distance then."""
        # fewer near blocks than that would leave more than the radius to the others
        least = BLOCKS - self.radius // (self.radius // BLOCKS + 1)
        step = max(1, PAIRS // len(items))
        for lo in range(0, len(got), step):
            part = got[lo: lo + step]
            near = np.zeros((len(part), len(items)), np.uint8)
            for b in range(BLOCKS):
                near += _ONES[part[:, b, None] ^ self.prints[items, b]] <= self.radius // BLOCKS
            w, j = np.nonzero(near >= least)
            close = _ONES[part[w] ^ self.prints[items[j]]].sum(1) <= self.radius
            yield lo + w[close], items[j[close]]

    def match(self, h_words: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """(item row, start word, words, inter, union) of the best window for
        every contaminating item: the most similar, the first of these."""
        out = []
        for k, (keys, start, item) in self.postings.items():
            if not len(h_words):
                continue
            h = shingle_hashes(h_words, k) if len(h_words) >= k else shingle_hashes(h_words, len(h_words))
            at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
            pos = np.flatnonzero(keys[at] == h)
            if not len(pos):
                continue
            at = at[pos]
            n = start[at + 1] - start[at]
            who = item[np.repeat(start[at] - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum())]
            where = np.repeat(pos, n)
            found, back, hits = np.unique(who, return_inverse=True, return_counts=True)
            # a window that reaches the similarity shares so many shingles with the item
            enough = 100 * hits >= self.percent * np.minimum(self.size[found], len(h))
            for length in np.unique(self.size[found[enough]]).tolist():
                mine = enough & (self.size[found] == length)
                items, places = found[mine], where[mine[back]]
                length = min(length, len(h))
                lo, hi = max(0, int(places.min()) - length + 1), min(int(places.max()), len(h) - length)
                near = np.zeros(hi - lo + 2, np.int64)  # only windows with a hit
                np.add.at(near, np.maximum(places - length + 1, lo) - lo, 1)
                np.add.at(near, np.minimum(places, hi) - lo + 1, -1)
                starts = lo + np.flatnonzero(np.cumsum(near)[:-1] > 0)
                if not len(starts):
                    continue
                got = np.concatenate([fingerprints(h, run, length) for run in
                                      np.split(starts, np.flatnonzero(np.diff(starts) > length) + 1)])
                best: dict[int, tuple[float, int, int, int]] = {}
                for w, i in self.within(got, items):
                    for s, i in zip(starts[w].tolist(), i.tolist()):
                        inter, union = similarity(h[s: s + length], self.sets[i])
                        if 100 * inter >= self.percent * union and (i not in best or inter / union > best[i][0]):
                            best[i] = inter / union, s, inter, union
                span = min(length + k - 1, len(h_words))
                out += [(self.place[i], s, span, inter, union) for i, (_, s, inter, union) in best.items()]
        return out


def _passes(items: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple]]:
    """The items in blocks that fit the driver and a broadcast: (id, text)."""
    t = items.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where("text IS NOT NULL")
    words = t.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-words // (5 * ITEM_WORDS))
    for i in range(n):
        yield [(r["id"], r["text"]) for r in t.where(F.pmod(F.xxhash64("text"), F.lit(n)) == i).collect()]


def contaminated(docs: DataFrame, items: DataFrame, percent: int = 80, id_col: str = "doc_id",
                 text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                 radius: int = RADIUS) -> DataFrame:
    """``(id, item, start_word, n_words, similarity)``: the best window for
    every pair of a document row and an item that reaches the similarity."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    item_type = items.schema[item_col].dataType
    schema = T.StructType([T.StructField(id_col, src.schema["id"].dataType), T.StructField(item_col, item_type),
                           T.StructField("start_word", T.IntegerType()), T.StructField("n_words", T.IntegerType()),
                           T.StructField("similarity", T.DoubleType())])
    out = docs.sparkSession.createDataFrame([], schema)
    for block in _passes(items, item_col, item_text_col):
        bc = docs.sparkSession.sparkContext.broadcast(([i for i, _ in block], _index(block, percent, radius)))
        out = out.unionByName(src.mapInArrow(_finder(bc, id_col, item_col, item_type), schema))
    return out


def _index(block: list[tuple], percent: int, radius: int) -> Index:
    return Index([(i, t.encode()) for i, (_, t) in enumerate(block)], percent, radius)


def _finder(bc, id_col: str, item_col: str, item_type: T.DataType):
    from pyspark.sql.pandas.types import to_arrow_type
    arrow = to_arrow_type(item_type)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, index = bc.value
        words = WordHashes()
        for b in batches:
            rows = [(r, *m) for r, t in enumerate(b.column("text"))
                    for m in index.match(words.of(words_of((t.as_py() or "").encode())))]
            yield pa.RecordBatch.from_arrays(
                [b.column("id").take(pa.array([r[0] for r in rows], pa.int64())),
                 pa.array([ids[r[1]] for r in rows], arrow), pa.array([r[2] for r in rows], pa.int32()),
                 pa.array([r[3] for r in rows], pa.int32()), pa.array([r[4] / r[5] for r in rows], pa.float64())],
                names=[id_col, item_col, "start_word", "n_words", "similarity"])

    return run


def decontaminate(docs: DataFrame, items: DataFrame, percent: int = 80, text_col: str = "text",
                  item_text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """``docs`` without the contaminated rows; nothing is shuffled."""
    at = docs.columns.index(text_col)
    names = docs.columns
    out = docs
    for block in _passes(items, item_text_col, item_text_col):
        bc = docs.sparkSession.sparkContext.broadcast(_index(block, percent, radius))

        def run(batches: Iterator[pa.RecordBatch], bc=bc) -> Iterator[pa.RecordBatch]:
            index, words = bc.value, WordHashes()
            for b in batches:
                clean = [not index.match(words.of(words_of((t.as_py() or "").encode()))) for t in b.column(at)]
                yield pa.RecordBatch.from_arrays(b.columns, names=names).filter(pa.array(clean, pa.bool_()))

        out = out.mapInArrow(lean(run), docs.schema)
    return out
