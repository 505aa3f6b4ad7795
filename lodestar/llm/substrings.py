"""Exact substring removal by column-wise multi-document suffix sorting.

Every byte covered by a ``length``-byte string that also starts somewhere else
(in any document, the same included) is removed.

1. Windows of ``length`` bytes are anchored: of the ``GRAM``-byte runs inside,
   the one with the least hash, the first of equals. Equal windows have equal
   anchors at equal places. Consecutive windows with one anchor form a piece,
   so each window belongs to one piece and equal windows to pieces of equal
   anchor hash. Anchors that occur once cannot hold a repeat; a first pass over
   the texts counts anchors and keeps a bit filter of those that occur again.
2. A second pass sends the pieces that pass the filter to buckets by anchor,
   equal pieces of a batch once. A piece that occurs twice is repeated whole.
   Different pieces of one anchor are cut to the windows whose context some
   other piece shares.
3. Per bucket, runs of anchors are sorted as one collection: the Burrows-
   Wheeler transform and the common prefixes of all suffixes are built column
   by column, one symbol of every piece a round, each round reading and
   writing the two files (arrays of a bounded bucket) front to back. Windows
   with a neighbour whose common prefix reaches ``length`` are repeated.
4. The repeated runs join back to the texts.

The sort inserts a column per round and passes over its files each time, so on
whole documents it would take as many passes as the longest has bytes; pieces
have at most 2 * length bytes and so bound the rounds.

Defined cases: null counts as empty; texts shorter than ``length`` lose
nothing; repeated rows are further occurrences; ties between equal hashes go
to the first place; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.llm.common import mix, text_bytes, write_state

GRAM = 50
STRETCH = 1 << 22       # bytes of a text hashed at once
FILTER_BITS = 1 << 27   # at most, of the anchor filter: 16 MB
BUCKET_CHARS = 1 << 23  # characters of the input per bucket of anchors
SORT_BYTES = 1 << 16    # bytes sorted as one collection
_ROOT = np.uint64(0x9E3779B97F4A7C15)


# ------------------------------------------------------------ anchors

class Roller:
    """64-bit hashes of all ``GRAM``-byte runs by prefix sums."""

    def __init__(self):
        self.byte = mix(np.arange(1, 257, dtype=np.uint64) * _ROOT)
        self.power = np.ones(1, np.uint64)
        self.inverse = np.ones(1, np.uint64)
        self.step = np.uint64(pow(int(_ROOT), -1, 1 << 64))

    def _grow(self, n: int) -> None:
        if len(self.power) < n:
            size = max(n, 1 << 16, 2 * len(self.power))
            self.power = np.append(np.uint64(1), np.cumprod(np.full(size - 1, _ROOT)))
            self.inverse = np.append(np.uint64(1), np.cumprod(np.full(size - 1, self.step)))

    def grams(self, raw: np.ndarray) -> np.ndarray:
        n = len(raw)
        self._grow(n)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.byte[raw] * self.power[:n], out=sums[1:])
        return mix((sums[GRAM:] - sums[:-GRAM]) * self.inverse[: n - GRAM + 1])


def _window_least(x: np.ndarray, w: int) -> np.ndarray:
    """Least of every w consecutive values."""
    n = len(x)
    pad = np.full(-n % w, np.iinfo(np.uint64).max, np.uint64)
    y = np.append(x, pad).reshape(-1, w)
    up = np.minimum.accumulate(y, axis=1).ravel()
    down = np.minimum.accumulate(y[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(down[: n - w + 1], up[w - 1: n])


def pieces(text: bytes, length: int, roller: Roller) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, anchor place, first window, last window) of all pieces."""
    out = []
    span = length - GRAM + 1
    for base in range(0, max(0, len(text) - length + 1), STRETCH):
        raw = np.frombuffer(text, np.uint8, count=min(len(text) - base, STRETCH + length - 1), offset=base)
        h = roller.grams(raw)
        # the least hash, then the first place: both in one number
        place = np.arange(len(h), dtype=np.uint64)
        least = _window_least((h & ~np.uint64((1 << 24) - 1)) | place, span)
        at = (least & np.uint64((1 << 24) - 1)).astype(np.int64)
        first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        last = np.append(first[1:] - 1, len(at) - 1)
        # least hashes are small numbers; mixed again they spread over the buckets
        out.append((mix(h[at[first]]), at[first] + base, first + base, last + base))
    if not out:
        none = np.empty(0, np.int64)
        return none.astype(np.uint64), none, none, none
    return tuple(np.concatenate(x) for x in zip(*out))


# ------------------------------------------------------------ suffix sorting

def repeated_windows(strings: list[bytes], length: int) -> list[np.ndarray]:
    """For each string, the starts of its ``length``-byte windows that occur
    twice or more in the collection.

    Column-wise construction: round j inserts the suffix of length j of every
    string into the sorted order of all shorter suffixes. ``bwt`` holds the
    symbol before each suffix (0: none) and ``lcp`` the common prefix with the
    suffix before it, up to ``length``. A suffix cX goes where the symbol c
    before X stands among all equal symbols; its common prefix with the
    neighbour cY is one more than the least between X and Y.
    """
    m = len(strings)
    n = np.array([len(s) for s in strings], np.int64)
    rounds = int(n.max())
    # symbols from the end, byte + 1 (no UTF-8 text has byte 255); 0 past the start
    text = np.zeros((rounds + 1, m), np.uint8)
    for i, s in enumerate(strings):
        text[: n[i], i] = np.frombuffer(s, np.uint8)[::-1] + 1
    cap = length
    kind = np.uint8 if cap < 255 else np.uint16
    bwt = text[0].copy()
    lcp = np.zeros(m + 1, kind)  # one more, so that a range may end at the end
    pos = np.arange(m)
    live = np.arange(m)
    for j in range(1, rounds + 1):
        going = bwt[pos] != 0
        pos, live = pos[going], live[going]
        size = len(bwt)
        order = np.argsort(bwt, kind="stable")
        rank = np.empty(size, np.int64)
        rank[order] = np.arange(size)
        ended = m - len(live)
        back = np.argsort(-pos)  # from the end, so that no range between two is read
        pos, live = pos[back], live[back]
        f = rank[pos]
        c = bwt[pos]
        new = m + f - ended
        before, after = order[f - 1], order[np.minimum(f + 1, size - 1)]
        has_before = (f > ended) & (bwt[before] == c)
        has_after = (f + 1 < size) & (bwt[after] == c)
        up = np.zeros(len(pos), kind)
        if has_before.any():
            pairs = np.stack([before[has_before] + 1, pos[has_before] + 1], 1).ravel()
            up[has_before] = np.minimum(np.minimum.reduceat(lcp, pairs)[::2], cap - 1) + 1
        grown = np.empty(size + len(new), np.uint8)
        prefix = np.zeros(size + len(new) + 1, kind)
        old = np.ones(size + len(new), bool)
        old[new] = False
        grown[old] = bwt
        prefix[:-1][old] = lcp[:-1]
        grown[new] = text[j, live]
        prefix[new] = up
        if has_after.any():
            pairs = np.stack([pos[has_after] + 1, after[has_after] + 1], 1).ravel()
            prefix[new[has_after] + 1] = np.minimum(np.minimum.reduceat(lcp, pairs)[::2], cap - 1) + 1
        bwt, lcp, pos = grown, prefix, new
    # suffixes with a neighbour that shares a whole window, back to their strings
    deep = lcp >= cap
    twice = deep[:-1] | deep[1:]
    order = np.argsort(bwt, kind="stable")
    rank = np.empty(len(bwt), np.int64)
    rank[order] = np.arange(len(bwt))
    ended = int(np.count_nonzero(bwt == 0))
    at, who, found, whose = np.arange(m), np.arange(m), [], []
    for j in range(1, rounds + 1):
        going = n[who] >= j
        at, who = m + rank[at[going]] - ended, who[going]
        if j >= length:
            hit = twice[at]
            found.append(n[who[hit]] - j)
            whose.append(who[hit])
    if not found:
        return [np.empty(0, np.int64)] * m
    found, whose = np.concatenate(found), np.concatenate(whose)
    by = np.lexsort((found, whose))
    return np.split(found[by], np.searchsorted(whose[by], np.arange(1, m)))


_STEP = 25


def trimmed(group: list[tuple[bytes, int]], length: int) -> list[tuple[int, int]]:
    """For pieces (bytes, anchor's place) of one anchor: the range of window
    starts (first, last) whose context some other piece may share; first >
    last where there is none. Contexts are compared in steps of bytes."""
    side = length - GRAM
    left = [min(at, side) for _, at in group]
    right = [min(len(s) - at - GRAM, side) for s, at in group]
    reach_l, reach_r = [-1] * len(group), [-1] * len(group)
    for far in range(0, side + _STEP, _STEP):
        seen_l: dict[bytes, list[int]] = {}
        seen_r: dict[bytes, list[int]] = {}
        for i, (s, at) in enumerate(group):
            if left[i] >= far and (far == 0 or reach_l[i] >= far - _STEP):
                seen_l.setdefault(s[at - far: at + GRAM], []).append(i)
            if right[i] >= far and (far == 0 or reach_r[i] >= far - _STEP):
                seen_r.setdefault(s[at: at + GRAM + far], []).append(i)
        for seen, reach in ((seen_l, reach_l), (seen_r, reach_r)):
            for own in seen.values():
                if len(own) > 1:
                    for i in own:
                        reach[i] = far
    out = []
    for i, (s, at) in enumerate(group):
        if reach_l[i] < 0 or reach_r[i] < 0:
            out.append((1, 0))
            continue
        most = min(reach_l[i] + _STEP - 1, side)          # bytes before the anchor
        least = max(0, side - (reach_r[i] + _STEP - 1))
        out.append((max(0, at - most), min(at - least, len(s) - length)))
    return out


Item = tuple[int, bytes, int, int, int]  # piece, bytes, anchor's place, first and last window


def split(items: list[Item], length: int, limit: int) -> Iterator[list[Item]]:
    """Subgroups of at most ``limit`` bytes whose windows may be equal.

    The windows' range before the anchor is halved; all windows of a half have
    some bytes in common, and only pieces that agree in these stay together.
    A range of one window leaves pieces that agree in it.
    """
    if len(items) < 2:
        return
    lo = min(at - last for _, _, at, _, last in items)
    hi = max(at - first for _, _, at, first, _ in items)
    if lo == hi or sum(last - first + length for _, _, _, first, last in items) <= limit:
        yield items
        return
    mid = (lo + hi) // 2
    for near, far in ((lo, mid), (mid + 1, hi)):
        by: dict[bytes, list[Item]] = {}
        for i, s, at, first, last in items:
            first, last = max(first, at - far), min(last, at - near)
            if first <= last:
                by.setdefault(s[at - near: at - far + length], []).append((i, s, at, first, last))
        for own in by.values():
            yield from split(own, length, limit)


def repeats_in_bucket(keys: np.ndarray, strings: list[bytes], places: np.ndarray, times: np.ndarray,
                      length: int) -> list[list[tuple[int, int]]]:
    """For every distinct piece of a bucket, runs of repeated windows (first,
    last). ``times`` are the pieces' occurrences; pieces come sorted by key."""
    out: list[list[tuple[int, int]]] = [[(0, len(s) - length)] if t > 1 else [] for s, t in zip(strings, times)]
    batch: list[tuple[int, int, bytes]] = []
    size = 0

    def flush() -> None:
        nonlocal batch, size
        if len(batch) > 1:
            for (i, lo, _), found in zip(batch, repeated_windows([b[2] for b in batch], length)):
                if times[i] == 1 and len(found):
                    cuts = np.flatnonzero(np.diff(found) > 1)
                    out[i] += [(lo + int(a), lo + int(b)) for a, b in
                               zip(found[np.append(0, cuts + 1)], found[np.append(cuts, len(found) - 1)])]
        batch, size = [], 0

    edges = np.append(np.flatnonzero(np.append(True, keys[1:] != keys[:-1])), len(keys)) if len(keys) else [0]
    for a, b in zip(edges[:-1], edges[1:]):
        if b - a < 2 or (times[a:b] > 1).all():
            continue
        group = [(strings[i], int(places[i])) for i in range(a, b)]
        part = [(i, s, at, lo, hi) for i, (s, at), (lo, hi) in zip(range(a, b), group, trimmed(group, length)) if lo <= hi]
        for own in split(part, length, SORT_BYTES):
            alone = [x for x in own if times[x[0]] == 1]
            if not alone:
                continue
            if len({s[lo: hi + length] for _, s, _, lo, hi in own}) == 1:  # all the same: repeated whole
                for i, _, _, lo, hi in alone:
                    out[i].append((lo, hi))
                continue
            if size > SORT_BYTES:
                flush()
            batch += [(i, lo, s[lo: hi + length]) for i, s, _, lo, hi in own]
            size += sum(hi - lo + length for _, _, _, lo, hi in own)
    flush()
    return out


# ------------------------------------------------------------ passes over the texts

def _bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    return ((h >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def anchor_filter(src: DataFrame, length: int, buckets: int) -> np.ndarray:
    """Bits of the anchors that occur again. Map tasks send every anchor's
    hash; a bucket counts its own and marks its own share of the filter."""
    blob = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("hashes", T.BinaryType())])

    def flush(held: list[np.ndarray]) -> pa.RecordBatch:
        h = np.concatenate(held)
        # twice is enough of any hash
        h, n = np.unique(h, return_counts=True)
        h = np.sort(np.append(h, h[n > 1]))
        to = _bucket(h, buckets)
        cuts = np.searchsorted(to, np.arange(buckets + 1))
        low = np.ascontiguousarray(h).view(np.uint8).reshape(-1, 8)[:, :6]
        rows = [(b, low[cuts[b]: cuts[b + 1]].tobytes()) for b in range(buckets) if cuts[b] < cuts[b + 1]]
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()),
                                           pa.array([r[1] for r in rows], pa.binary())], names=blob.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller, held, size = Roller(), [], 0
        for b in batches:
            for t in text_bytes(b, "text"):
                held.append(pieces(t, length, roller)[0])
                size += len(held[-1])
                if size > 2_000_000:
                    yield flush(held)
                    held, size = [], 0
        if size:
            yield flush(held)

    def count(table: pa.Table) -> pa.Table:
        raw = b"".join(table.column("hashes").to_pylist())
        wide = np.zeros((len(raw) // 6, 8), np.uint8)
        wide[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
        h, n = np.unique(wide.view("<u8").ravel(), return_counts=True)
        return pa.table({"bucket": table.column("bucket").slice(0, 1),
                         "again": pa.array([h[n > 1].astype("<u8").tobytes()], pa.binary())})

    again, _ = write_state(src.mapInArrow(run, blob).groupBy("bucket").applyInArrow(
        count, T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("again", T.BinaryType())])))
    total = again.agg(F.sum(F.length("again") / 8)).first()[0] or 0
    bits = min(FILTER_BITS, max(1 << 20, 1 << int(16 * total).bit_length()))
    words = bits // 64

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = np.zeros(words, np.uint64)
            for x in b.column("again").to_pylist():
                set_bits(own, np.frombuffer(x, "<u8"))
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(own[at].view(np.int64))], names=["w", "bits"])

    got = again.mapInArrow(mark, "w long, bits long").groupBy("w").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(words, np.uint64)
    out[got.column("w").to_numpy()] = got.column("bits").to_numpy().view(np.uint64)
    return out


def _bits(words: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word, bit) of 48-bit hash parts."""
    h = mix(low)
    return (h >> np.uint64(6)) % np.uint64(len(words)), np.uint64(1) << (h & np.uint64(63))


def set_bits(words: np.ndarray, low: np.ndarray) -> None:
    w, bit = _bits(words, low)
    np.bitwise_or.at(words, w, bit)


def has_bits(words: np.ndarray, h: np.ndarray) -> np.ndarray:
    w, bit = _bits(words, h & np.uint64((1 << 48) - 1))
    return (words[w] & bit) != 0


def repeated_runs(src: DataFrame, length: int, buckets: int, known: np.ndarray) -> DataFrame:
    """``(k1, k2, start, stop)``: byte ranges covered by repeated windows, for
    texts (k1, k2, text)."""
    bc = src.sparkSession.sparkContext.broadcast(known)
    names = ["bucket", "hashes", "places", "sizes", "bytes", "piece", "k1", "k2", "first"]
    blob = T.StructType([T.StructField("bucket", T.IntegerType())] + [T.StructField(c, T.BinaryType()) for c in names[1:]])

    def flush(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        """held: (hash, place in the piece, bytes, k1, k2, first window)."""
        by: list[dict] = [{} for _ in range(buckets)]
        at: list[list] = [[] for _ in range(buckets)]
        to = _bucket(np.array([x[0] for x in held], np.uint64), buckets)
        for b, (h, place, s, k1, k2, first) in zip(to.tolist(), held):
            own = by[b].setdefault((h, s, place), len(by[b]))
            at[b].append((own, k1, k2, first))
        cols: list[list] = [[] for _ in names]
        for b in range(buckets):
            if not at[b]:
                continue
            key = list(by[b])
            piece, k1, k2, first = zip(*at[b])
            for col, x in zip(cols, (
                    b, np.array([k[0] for k in key], "<u8").tobytes(), np.array([k[2] for k in key], "<u2").tobytes(),
                    np.array([len(k[1]) for k in key], "<u2").tobytes(), b"".join(k[1] for k in key),
                    np.array(piece, "<u4").tobytes(), np.array(k1, "<i8").tobytes(), np.array(k2, "<i8").tobytes(),
                    np.array(first, "<i8").tobytes())):
                col.append(x)
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), *(pa.array(c, pa.binary()) for c in cols[1:])],
                                         names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller, known = Roller(), bc.value
        held, size = [], 0
        for b in batches:
            k1, k2 = b.column("k1").to_pylist(), b.column("k2").to_pylist()
            for t, x, y in zip(text_bytes(b, "text"), k1, k2):
                h, place, first, last = pieces(t, length, roller)
                keep = np.flatnonzero(has_bits(known, h)) if len(h) else []
                for g, p, lo, hi in zip(*(v[keep].tolist() for v in (h, place, first, last))):
                    held.append((g, p - lo, t[lo: hi + length], x, y, lo))
                    size += hi - lo + length + 100
                if size > 24_000_000:
                    yield from flush(held)
                    held, size = [], 0
        if held:
            yield from flush(held)

    def sort(table: pa.Table) -> pa.Table:
        at: dict[tuple, int] = {}
        owner, k1, k2, first = [], [], [], []
        for row in zip(*(table.column(c).to_pylist() for c in names[1:])):
            h, place, size = np.frombuffer(row[0], "<u8"), np.frombuffer(row[1], "<u2"), np.frombuffer(row[2], "<u2")
            ends = np.cumsum(size.astype(np.int64)).tolist()
            ids = np.array([at.setdefault((g, row[3][e - n: e], p), len(at)) for g, p, n, e in
                            zip(h.tolist(), place.tolist(), size.tolist(), ends)], np.int64)
            owner.append(ids[np.frombuffer(row[4], "<u4")])
            k1.append(np.frombuffer(row[5], "<i8"))
            k2.append(np.frombuffer(row[6], "<i8"))
            first.append(np.frombuffer(row[7], "<i8"))
        owner, k1, k2, first = (np.concatenate(x) for x in (owner, k1, k2, first))
        times = np.bincount(owner, minlength=len(at))
        key = list(at)
        order = np.argsort(np.array([k[0] for k in key], np.uint64), kind="stable")
        found = repeats_in_bucket(np.array([key[i][0] for i in order], np.uint64), [key[i][1] for i in order],
                                  np.array([key[i][2] for i in order]), times[order], length)
        runs = [found[j] for j in np.argsort(order)]
        n = np.array([len(r) for r in runs])[owner]
        rep = np.repeat(np.arange(len(owner)), n)
        flat = np.array([x for i in owner[n > 0] for x in runs[i]], np.int64).reshape(-1, 2)
        return pa.table({"k1": pa.array(k1[rep]), "k2": pa.array(k2[rep]),
                         "start": pa.array(first[rep] + flat[:, 0]), "stop": pa.array(first[rep] + flat[:, 1] + length)})

    out = T.StructType([T.StructField(c, T.LongType()) for c in ("k1", "k2", "start", "stop")])
    return src.mapInArrow(run, blob).groupBy("bucket").applyInArrow(sort, out)


def remove_repeats(docs: DataFrame, length: int = 200, id_col: str = "doc_id", text_col: str = "text",
                   buckets: int | None = None) -> DataFrame:
    """``(id, n_bytes, n_removed, n_spans, kept)`` per row; ``kept`` are the
    remaining bytes, ``n_spans`` the maximal removed runs."""
    if not GRAM < length < 1 << 15:
        raise ValueError(f"length must be over {GRAM} and below 32768")
    src = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    # two hashes name a row by its content; equal rows have equal repeats
    src = src.withColumn("k1", F.xxhash64("id", "text")).withColumn("k2", F.xxhash64("text", F.lit(1), "id"))
    total = 0 if buckets else src.agg(F.sum(F.length("text"))).first()[0] or 0
    n = buckets or max(64, -(-total // BUCKET_CHARS))
    known = anchor_filter(src.select("text"), length, n)
    runs = repeated_runs(src.select("k1", "k2", "text"), length, n, known)
    runs = runs.distinct().groupBy("k1", "k2").agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("runs"))
    joined = src.join(runs, ["k1", "k2"], "left").select("id", "text", "runs")
    schema = T.StructType([T.StructField(id_col, src.schema["id"].dataType), T.StructField("n_bytes", T.LongType()),
                           T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()),
                           T.StructField("kept", T.BinaryType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            total, removed, spans, kept = [], [], [], []
            for t, r in zip(text_bytes(b, "text"), b.column("runs").to_pylist()):
                parts, pos, k = [], 0, 0
                for x in r or ():
                    if x["start"] > pos or not k:
                        k += 1
                    parts.append(t[pos: x["start"]])
                    pos = max(pos, x["stop"])
                left = b"".join(parts) + t[pos:]
                total.append(len(t))
                removed.append(len(t) - len(left))
                spans.append(k)
                kept.append(left)
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(spans, pa.int64()), pa.array(kept, pa.binary())], names=[f.name for f in schema])

    return joined.mapInArrow(cut, schema)
