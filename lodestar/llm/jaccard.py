"""N-gram Jaccard join by T-occurrence search.

Links all documents whose sets of word shingles have a Jaccard similarity of
at least ``percent`` / 100 and labels the connected components.

1. Equal sets become one: every later step works on the set's hash.
2. Candidates without loss. Two sets of sizes n, m that link differ in at most
   (n + m)(1 - t) / (1 + t) shingles. Sets are put in size classes of ratio t
   and the shingle space is hashed into more parts than that bound, so linked
   sets agree exactly in some part. Sets that share a part's content are
   chained; the chains' components, the clusters, hold every link inside.
   Chains grow with the rows, not with the square of a group.
3. A cluster is dealt over tasks of a bounded number of shingles. Each task
   builds an inverted index and runs a T-occurrence search for each member:
   the query's longest lists are set aside, the short ones are merged and
   counted, and candidates that reach T less the number of long lists are
   looked up in the long lists by binary search (DivideSkip). Candidates whose
   component is known to be the query's are skipped, and only links that join
   two components leave the task.
4. A cluster of several blocks takes a second pass: all sets outside its
   largest component so far search every block of their cluster, so links
   across blocks are found exactly. The asking sets are cut into blocks too; a
   task holds one block of either side.

Words are runs of anything but space and U+0009..U+000D after lower-casing
A-Z. A text with fewer words than a shingle is one shingle; null, empty and
blank texts have no shingle and link with nothing (their component is
themselves). Repeated rows of one id count once. A null id never names a
component unless all its members are null. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.llm.common import (
    WordHashes, drop_state, lean, mix, release, shingle_hashes, text_bytes, write_state,
)

BLOCK = 1 << 20  # shingles searched by one task
FLUSH = 1_000_000  # entries a task holds before it sends them
WORDS = 200_000    # word hashes a task remembers


# ------------------------------------------------------------ sets

def shingle_set(text: bytes, k: int, words: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes."""
    return np.unique(shingle_hashes(words.of(text.lower().split()), k))


def set_id(tokens: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)


def linked(inter: int, n: int, m: int, percent: int) -> bool:
    return 100 * inter >= percent * (n + m - inter)


# ------------------------------------------------------------ candidates

SKETCH_BITS = 22  # counters of the frequency sketch: a fixed 2**22
CHUNKS = 64
_SKETCH_SHIFT = np.uint64(64 - SKETCH_BITS)


def heavy_counters(counts: np.ndarray) -> np.ndarray:
    """Counters well above the even share of all shingles: ten deviations. Any
    choice gives the same links; it only keeps common passages from joining
    clusters."""
    even = counts.mean()
    return counts > even + 10 * np.sqrt(even) + 16


class SizeClasses:
    """Class k holds the sizes lo[k]..hi[k] with hi = floor(lo / t). A set of
    class k emits the parts of classes k and k + 1, so sets that may link meet
    in the larger one's class."""

    def __init__(self, percent: int, heavy: np.ndarray | None = None):
        self.percent, self.heavy = percent, heavy
        self.lo, self.hi = [1], [max(1, 100 // percent)]

    def of(self, n: int) -> int:
        while self.hi[-1] < n:
            self.lo.append(self.hi[-1] + 1)
            self.hi.append(self.lo[-1] * 100 // self.percent)
        return int(np.searchsorted(self.hi, n))

    def parts(self, k: int) -> tuple[int, int]:
        """(parts, spare): more than ``spare`` parts of linked sets differ in
        no shingle, or in one at most below 85 percent."""
        while len(self.hi) <= k:
            self.of(self.hi[-1] + 1)
        differ = 2 * self.hi[k] * (100 - self.percent) // (100 + self.percent)
        if self.percent >= 85:
            return differ + 1 + differ // 5, differ // 5
        return differ // 2 + 1 + differ // 20, differ // 20

    def signatures(self, tokens: np.ndarray) -> np.ndarray:
        """Hashes of what linked sets share: a part's content or, below 85
        percent (where parts are small), a part cut in three of which two are
        taken, each pair in turn. An empty content says nothing, and one of
        frequent shingles only (``heavy``) says that two texts share a common
        passage. Such a content is left out unless more than ``spare`` parts
        have one; then linked sets might agree in these only, and all are
        emitted. Equal contents are left out on both sides or on neither."""
        if not len(tokens):
            return tokens
        out = []
        k0 = self.of(len(tokens))
        mixed = mix(tokens)
        light = np.ones(len(tokens), bool) if self.heavy is None else ~self.heavy[(tokens >> _SKETCH_SHIFT).astype(np.int64)]
        cut = 1 if self.percent >= 85 else 3
        for k in (k0, k0 + 1):
            parts, spare = self.parts(k)
            cell = (mixed % np.uint64(parts * cut)).astype(np.int64)
            order = np.argsort(cell, kind="stable")
            found, first = np.unique(cell[order], return_index=True)
            content = np.zeros(parts * cut, np.uint64)
            content[found] = mix(np.add.reduceat(tokens[order], first))
            full = np.zeros(parts * cut, bool)
            full[cell[light]] = True
            tag = (np.arange(parts * cut, dtype=np.uint64) + np.uint64(k << 40)) * np.uint64(0x9E3779B97F4A7C15)
            if cut == 1:
                weak = parts - int(full.sum())
                sig = mix(content + tag)
            else:
                c, f = content.reshape(parts, 3), full.reshape(parts, 3)
                c = mix(np.roll(c, -1, 1) + c * np.uint64(0xD6E8FEB86659FD93))
                full = (np.roll(f, -1, 1) | f).reshape(-1)
                weak = int((f.sum(1) <= 1).sum())
                sig = mix(c.reshape(-1) + tag)
            out.append(sig if weak > spare else sig[full])
        return np.concatenate(out)


# ------------------------------------------------------------ search

class Search:
    """T-occurrence search over one block of sets."""

    def __init__(self, sets: list[np.ndarray], percent: int):
        self.percent = percent
        self.n = np.array([len(s) for s in sets], dtype=np.int64)
        rec = np.repeat(np.arange(len(sets)), self.n)
        tok = np.concatenate(sets) if sets else np.empty(0, np.uint64)
        order = np.lexsort((rec, tok))
        self.tokens, self.start = np.unique(tok[order], return_index=True)
        self.rec = rec[order]
        self.start = np.append(self.start, len(tok))
        # (list, record) as one sorted key, for binary probes
        size = np.diff(self.start)
        self.key = np.repeat(np.arange(len(self.tokens)), size) * max(1, len(sets)) + self.rec
        self.sets = len(sets)

    def links(self, query: np.ndarray, skip: np.ndarray) -> Iterator[int]:
        """Records that link with ``query``; the caller sets ``skip[r]`` for
        those it no longer asks for, also while this runs."""
        n = len(query)
        at = np.minimum(np.searchsorted(self.tokens, query), len(self.tokens) - 1)
        lists = at[self.tokens[at] == query]
        least = -(-self.percent * n // 100)  # a linked set shares so many at least
        if len(lists) < least:
            return
        size = self.start[lists + 1] - self.start[lists]
        order = np.argsort(size, kind="stable")
        lists, size = lists[order], size[order]
        longest = int(size[-1])
        aside = min(least - 1, int(least / (0.02 * np.log2(longest + 1) + 1)))
        cut = len(lists) - aside
        # merge the short lists and count
        total = int(size[:cut].sum())
        offs = np.repeat(self.start[lists[:cut]] - np.append(0, np.cumsum(size[:cut])[:-1]), size[:cut])
        got = self.rec[offs + np.arange(total)]
        got = got[~skip[got]]
        cand, count = np.unique(got, return_counts=True)
        m = self.n[cand]
        need = -(-self.percent * (n + m) // (100 + self.percent))
        ok = (count + aside >= need) & (100 * np.minimum(n, m) >= self.percent * np.maximum(n, m))
        cand, count, need = cand[ok], count[ok], need[ok]
        if not len(cand):
            return
        far = lists[cut:] * self.sets
        for r, c, t in sorted(zip(cand.tolist(), count.tolist(), need.tolist()), key=lambda x: x[2] - x[1]):
            if skip[r]:
                continue
            probe = far + r
            if len(probe):
                where = np.searchsorted(self.key, probe)
                where[where == len(self.key)] = 0
                c += int((self.key[where] == probe).sum())
            if c >= t:
                yield r


class Forest:
    """Union-find with component labels kept flat, so that all members of a
    component can be masked at once."""

    def __init__(self, labels: np.ndarray):
        _, self.label = np.unique(labels, return_inverse=True)

    def join(self, a: int, b: int) -> None:
        self.label[self.label == self.label[b]] = self.label[a]


def search_block(ids: np.ndarray, sets: list[np.ndarray], index: np.ndarray, known: np.ndarray,
                 percent: int) -> list[tuple[int, int]]:
    """Links that join components, as pairs of set ids.

    ``index`` marks the block's own sets; the others only search. ``known``
    are component labels from earlier passes.
    """
    own = np.flatnonzero(index)
    if not len(own):
        return []
    search = Search([sets[i] for i in own], percent)
    forest = Forest(known)
    out = []
    for q in (np.flatnonzero(~index) if len(own) < len(ids) else own).tolist():
        skip = forest.label[own] == forest.label[q]
        if skip.all():
            continue
        for r in search.links(sets[q], skip):
            out.append((int(ids[q]), int(ids[own[r]])))
            forest.join(q, int(own[r]))
            skip[:] = forest.label[own] == forest.label[q]
    return out


# ------------------------------------------------------------ components

def components(edges: DataFrame, paths: list[str]) -> DataFrame:
    """``(node, root)`` for all nodes of ``edges`` (a, b): root is the least
    node reachable.

    Each round every label takes its least neighbouring label as parent,
    parents are followed to their roots by pointer doubling, and the edges are
    contracted to roots; the edge table shrinks by half at least. State is
    written to the shared folder each round; ``paths`` collects it.
    """
    spark = edges.sparkSession

    def put(df: DataFrame) -> DataFrame:
        out, path = write_state(df)
        paths.append(path)
        return out

    live = put(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    label: DataFrame | None = None
    while not live.isEmpty():
        parent = put(live.groupBy(F.col("b").alias("x")).agg(F.min("a").alias("p")))
        # follow parents to the roots; parents are smaller, so there are no cycles
        while True:
            up = parent.select(F.col("x").alias("p"), F.col("p").alias("g"))
            nxt = put(parent.join(up, "p", "left").select("x", F.coalesce("g", "p").alias("p"), F.col("g").isNotNull().alias("moved")))
            moved = not nxt.where("moved").isEmpty()
            parent = nxt.select("x", "p")
            if not moved:
                break
        a, b = parent.toDF("a", "ra"), parent.toDF("b", "rb")
        nodes = parent.toDF("node", "root")
        if label is None:
            label = nodes
        else:
            old = label.join(parent.toDF("root", "to"), "root", "left").select("node", F.coalesce("to", "root").alias("root"))
            label = old.unionByName(nodes.join(label.select("node"), "node", "left_anti"))
        label = put(label)
        both = live.join(a, "a", "left").join(b, "b", "left").select(
            F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b")).where("a <> b")
        live = put(both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    if label is None:
        return spark.createDataFrame([], "node long, root long")
    roots = label.select(F.col("root").alias("node"), "root").distinct()
    return label.unionByName(roots.join(label.select("node"), "node", "left_anti"))


# ------------------------------------------------------------ join

def document_sets(docs: DataFrame, k: int, id_col: str, text_col: str) -> DataFrame:
    """``(id, n, set, chunk, counts)``: a row per document (set is null where
    there is no shingle) and, per task, the frequency sketch of its distinct
    sets in ``CHUNKS`` packed rows (chunk not null)."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = src.schema["id"].dataType
    schema = T.StructType([T.StructField("id", id_type), T.StructField("n", T.LongType()),
                           T.StructField("set", T.LongType()), T.StructField("chunk", T.IntegerType()),
                           T.StructField("counts", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, seen = WordHashes(WORDS), set()
        sketch = np.zeros(1 << SKETCH_BITS, np.uint32)
        held, size, of_ids = [], 0, None
        for b in batches:
            of_ids = b.column("id").type
            n, sid = [], []
            for t in text_bytes(b, "text"):
                s = shingle_set(t, k, words)
                n.append(len(s))
                sid.append(set_id(s) if len(s) else None)
                if len(s) and sid[-1] not in seen:
                    if len(seen) >= 1_000_000:
                        seen.clear()
                    seen.add(sid[-1])
                    held.append((s >> _SKETCH_SHIFT).astype(np.int64))
                    size += len(s)
                    if size > FLUSH:
                        sketch += np.bincount(np.concatenate(held), minlength=len(sketch)).astype(np.uint32)
                        held, size = [], 0
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(n, pa.int64()), pa.array(sid, pa.int64()),
                 pa.nulls(len(n), pa.int32()), pa.nulls(len(n), pa.binary())], names=schema.names)
        if held:
            sketch += np.bincount(np.concatenate(held), minlength=len(sketch)).astype(np.uint32)
        if of_ids is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(CHUNKS, of_ids), pa.nulls(CHUNKS, pa.int64()), pa.nulls(CHUNKS, pa.int64()),
                 pa.array(range(CHUNKS), pa.int32()),
                 pa.array([zlib.compress(x.tobytes(), 1) for x in np.split(sketch, CHUNKS)], pa.binary())], names=schema.names)

    return src.mapInArrow(lean(run), schema)


def frequency_sketch(rows: DataFrame) -> np.ndarray:
    """The counters of all tasks, summed chunk by chunk: 2**22 numbers."""

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros((1 << SKETCH_BITS) // CHUNKS, np.int64)
        for x in table.column("counts").to_pylist():
            total += np.frombuffer(zlib.decompress(x), np.uint32)
        return pa.table({"chunk": table.column("chunk").slice(0, 1), "counts": pa.array([total.tobytes()], pa.binary())})

    out = np.zeros((CHUNKS, (1 << SKETCH_BITS) // CHUNKS), np.int64)
    got = rows.where("chunk IS NOT NULL").select("chunk", "counts").groupBy("chunk").applyInArrow(add, "chunk int, counts binary")
    for chunk, counts in got.collect():
        out[chunk] = np.frombuffer(counts, np.int64)
    return out.ravel()


def part_links(docs: DataFrame, k: int, percent: int, text_col: str, buckets: int, heavy: np.ndarray) -> DataFrame:
    """``(a, b)``: a spanning star for every group of sets that share a part.

    A map batch joins its own groups first, so a group of any size sends one
    entry per part and batch. The entries go to buckets by part as packed
    arrays (five bytes of the part, two of the set's place in the batch);
    what the cut part hashes confuse are only more candidates.
    """
    src = docs.select(F.col(text_col).cast("string").alias("text"))
    bc = docs.sparkSession.sparkContext.broadcast(np.packbits(heavy))
    blob = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("part", T.BinaryType()),
                         T.StructField("place", T.BinaryType()), T.StructField("sets", T.BinaryType())])

    def flush(sig: list[np.ndarray], ids: list[int]) -> Iterator[pa.RecordBatch]:
        part = np.concatenate(sig)
        place = np.repeat(np.arange(len(sig), dtype=np.uint16), [len(x) for x in sig])
        order = np.lexsort((place, part))
        part, place = part[order], place[order]
        sets = np.array(ids, dtype=np.int64)
        head, other = _stars(part, place)
        pairs = np.unique(np.stack([sets[head], sets[other]], 1), axis=0)
        first = np.append(True, part[1:] != part[:-1])
        part, place = part[first], place[first]
        to = (part >> np.uint64(40)) % np.uint64(buckets)
        order = np.argsort(to, kind="stable")
        part, place, to = part[order], place[order], to[order]
        cuts = np.searchsorted(to, np.arange(buckets + 1, dtype=np.uint64))
        rows: list[list] = [[], [], [], []]
        for i in range(buckets):
            lo, hi = cuts[i], cuts[i + 1]
            if lo == hi:
                continue
            used, local = np.unique(place[lo:hi], return_inverse=True)
            five = np.ascontiguousarray(part[lo:hi]).view(np.uint8).reshape(-1, 8)[:, :5]
            for col, x in zip(rows, (i, five.tobytes(), local.astype("<u2").tobytes(), sets[used].astype("<i8").tobytes())):
                col.append(x)
        if len(pairs):
            for col, x in zip(rows, (int(pairs[0, 0] % buckets), b"", b"", pairs.astype("<i8").tobytes())):
                col.append(x)
        yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int32()), *(pa.array(x, pa.binary()) for x in rows[1:])],
                                         names=blob.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, classes = WordHashes(WORDS), SizeClasses(percent, np.unpackbits(bc.value).astype(bool))
        seen: set[int] = set()
        sig, ids, size = [], [], 0
        for b in batches:
            for t in text_bytes(b, "text"):
                s = shingle_set(t, k, words)
                if not len(s) or (sid := set_id(s)) in seen:
                    continue
                if len(seen) >= 1_000_000:
                    seen.clear()
                seen.add(sid)
                sig.append(classes.signatures(s))
                ids.append(sid)
                size += len(sig[-1])
                if size >= FLUSH or len(sig) == 65_535:
                    yield from flush(sig, ids)
                    sig, ids, size = [], [], 0
        if sig:
            yield from flush(sig, ids)

    def meet(table: pa.Table) -> pa.Table:
        part, sets, pairs = [], [], []
        for p, x, ids in zip(*(table.column(c).to_pylist() for c in ("part", "place", "sets"))):
            ids = np.frombuffer(ids, "<i8")
            if not p:
                pairs.append(ids.reshape(-1, 2))
                continue
            wide = np.zeros((len(p) // 5, 8), np.uint8)
            wide[:, :5] = np.frombuffer(p, np.uint8).reshape(-1, 5)
            part.append(wide.view("<u8").ravel())
            sets.append(ids[np.frombuffer(x, "<u2")])
        if part:
            part, sets = np.concatenate(part), np.concatenate(sets)
            order = np.lexsort((sets, part))
            head, other = _stars(part[order], sets[order])
            pairs.append(np.stack([head, other], 1))
        out = np.concatenate(pairs) if pairs else np.empty((0, 2), np.int64)
        out = np.unique(out[out[:, 0] != out[:, 1]], axis=0)
        return pa.table({"a": pa.array(out[:, 0]), "b": pa.array(out[:, 1])})

    packed = src.mapInArrow(lean(run), blob)
    return packed.groupBy("bucket").applyInArrow(meet, T.StructType([
        T.StructField("a", T.LongType()), T.StructField("b", T.LongType())]))


def _stars(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of sorted (keys, values): the first value of each key against the
    key's other values."""
    first = np.append(True, keys[1:] != keys[:-1])
    head = values[np.maximum.accumulate(np.where(first, np.arange(len(keys)), 0))]
    return head[~first], values[~first]


_BLOOM = 18  # log2 of the filter's 64-bit words: 2 MB whatever the input


def _bloom(ids: DataFrame) -> np.ndarray:
    """Bloom filter of the hashes in column ``set``, two bits each. Its size is
    fixed; where it is too small for the input it lets more through, and the
    join after it drops what does not belong."""
    bit = F.explode(F.array(F.col("set"), F.shiftright("set", 24))).alias("h")
    words = ids.select(bit).groupBy(
        F.pmod(F.shiftright("h", 6), F.lit(1 << _BLOOM)).cast("int").alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(h & 63 as int))")).alias("bits"))
    out = np.zeros(1 << _BLOOM, np.uint64)
    for w, b in words.collect():
        out[w] = np.uint64(b & 0xFFFFFFFFFFFFFFFF)
    return out


def _may_have(bloom: np.ndarray, sid: int) -> bool:
    return all(int(bloom[(h >> 6) % len(bloom)]) >> (h & 63) & 1 for h in (sid, sid >> 24))


def _those_of(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """``rows`` (set, tokens) without most of those whose set ``ids`` lacks, so
    that few of them are shuffled for a join with ``ids``."""
    bc = rows.sparkSession.sparkContext.broadcast(_bloom(ids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bloom = bc.value
        for b in batches:
            yield b.filter(pa.array([_may_have(bloom, sid) for sid in b.column("set").to_pylist()], pa.bool_()))

    return rows.mapInArrow(lean(run), rows.schema)


def _refine(cand: DataFrame, percent: int, put) -> DataFrame:
    """``(a, b)`` links among ``cand`` (set, n, tokens) by the prefix rule:
    with shingles ordered from rare to frequent, linked sets share one of
    their first n - ceil(t n) + 1. Shingles that only one set has need no row
    beyond the count."""
    tok = cand.select("set", "n", F.explode("tokens").alias("token"))
    df = tok.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    shared = tok.join(df, "token")
    by_set = Window.partitionBy("set")
    shared = shared.withColumn("rank", F.row_number().over(by_set.orderBy("df", "token"))) \
                   .withColumn("alone", F.col("n") - F.count(F.lit(1)).over(by_set))
    prefix = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    first = put(shared.where(F.col("rank") + F.col("alone") <= prefix).select("token", "set"))
    heads = first.groupBy("token").agg(F.min("set").alias("a"), F.count(F.lit(1)).alias("c")).where("c > 1")
    return first.join(heads, "token").select("a", F.col("set").alias("b")).where("a <> b").distinct()


def _with_tokens(docs: DataFrame, clusters: DataFrame, k: int, text_col: str) -> DataFrame:
    """``(set, n, tokens)`` and the columns of ``clusters`` for its sets, from
    the texts again: the filter leaves few, and only those are shuffled."""
    bc = docs.sparkSession.sparkContext.broadcast(_bloom(clusters))
    src = docs.select(F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([T.StructField("set", T.LongType()), T.StructField("n", T.LongType()),
                           T.StructField("tokens", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, seen, bloom = WordHashes(WORDS), set(), bc.value
        for b in batches:
            ids, tokens, size = [], [], 0
            for t in text_bytes(b, "text"):
                s = shingle_set(t, k, words)
                if not len(s) or (sid := set_id(s)) in seen or not _may_have(bloom, sid):
                    continue
                if len(seen) >= 1_000_000:
                    seen.clear()
                seen.add(sid)
                ids.append(sid)
                tokens.append(s.view(np.int64))
                size += len(s)
                if size > 500_000:
                    yield _token_batch(ids, tokens)
                    ids, tokens, size = [], [], 0
            if ids:
                yield _token_batch(ids, tokens)

    rows = src.mapInArrow(lean(run), schema)
    return rows.dropDuplicates(["set"]).join(clusters, "set")


def _token_batch(ids: list[int], tokens: list[np.ndarray]) -> pa.RecordBatch:
    offs = np.append(0, np.cumsum([len(x) for x in tokens])).astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(np.diff(offs).astype(np.int64)),
         pa.ListArray.from_arrays(pa.array(offs), pa.array(np.concatenate(tokens)))], names=["set", "n", "tokens"])


def _search(rows: DataFrame, percent: int) -> DataFrame:
    """Links ``(a, b)`` found per ``task`` of rows (task, set, indexed, known,
    tokens)."""

    def run(table: pa.Table) -> pa.Table:
        ids = table.column("set").to_numpy()
        col = table.column("tokens").combine_chunks()
        flat, offs = col.flatten().to_numpy().view(np.uint64), np.append(0, np.cumsum(col.value_lengths().to_numpy()))
        sets = [np.sort(flat[offs[i]: offs[i + 1]]) for i in range(len(ids))]
        index = table.column("indexed").to_numpy(zero_copy_only=False)
        found = search_block(ids, sets, index, table.column("known").to_numpy(), percent)
        out = np.array(found, dtype=np.int64).reshape(-1, 2)
        return pa.table({"a": pa.array(out[:, 0]), "b": pa.array(out[:, 1])})

    return rows.groupBy("task").applyInArrow(run, T.StructType([
        T.StructField("a", T.LongType()), T.StructField("b", T.LongType())]))


def jaccard_components(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id",
                       text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """``(id, n_shingles, component_id)`` per distinct id and set;
    component_id is the least id reachable by links."""
    named = _named_sets(docs, k, percent, id_col, text_col, block)[0]
    return named.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                        F.when(F.col("root").isNull(), F.col("id")).otherwise(F.col("least")).alias("component_id"))


def _named_sets(docs: DataFrame, k: int, percent: int, id_col: str, text_col: str, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """``(id, n, set, root, least)`` per distinct id and set, with the least id
    of its component (root null: no shingle), and the ids of several rows."""
    spark = docs.sparkSession
    temp: list[str] = []

    def put(df: DataFrame) -> DataFrame:
        out, path = write_state(df)
        temp.append(path)
        return out

    rows, path = write_state(document_sets(docs, k, id_col, text_col))
    members = put(rows.where("chunk IS NULL").groupBy("id", "n", "set").agg(F.count(F.lit(1)).alias("rows")))
    heavy = heavy_counters(frequency_sketch(rows))
    drop_state(spark, path)
    release(spark)  # the sketches of all tasks
    total = members.agg(F.sum("n")).first()[0] or 0
    buckets = max(1, -(-total // (2 * block)), min(64, -(-total // 50_000)))
    pairs = put(part_links(docs, k, percent, text_col, buckets, heavy))
    release(spark)  # the parts are the largest shuffle

    def weighed(rows: DataFrame) -> DataFrame:
        w = rows.groupBy("cluster").agg(F.sum("n").alias("w"))
        return rows.join(w, "cluster")

    # clusters are weighed by the sizes of their sets before tokens are read, so that tokens need no further join to tell
    # large clusters from small ones, whatever the planner would broadcast
    sizes = members.where("set IS NOT NULL").select("set", "n").dropDuplicates(["set"])
    clusters = put(weighed(components(pairs, temp).toDF("set", "cluster").join(sizes, "set")))
    cand = put(_with_tokens(docs, clusters.select("set", "cluster", "w"), k, text_col))
    release(spark)
    small, large = cand.where(F.col("w") <= block), cand.where(F.col("w") > block)
    closer = put(_refine(large.select("set", "n", "tokens"), percent, put))
    release(spark)
    # a set of a big cluster that the prefix rule leaves alone links with nothing
    finer = put(weighed(components(closer, temp).toDF("set", "cluster").join(clusters.select("set", "n"), "set")))
    # small clusters share tasks by hash; a large one is cut into blocks
    blocks = F.ceil(F.col("w") / block)
    tasks = sum(x.agg(F.sum("n")).first()[0] or 0 for x in (clusters.where(F.col("w") <= block), finer))
    tasks = max(1, -(-tasks // (block // 4)))
    task = F.when(blocks <= 1, F.concat(F.lit("s"), F.pmod(F.xxhash64("cluster"), F.lit(tasks)))).otherwise(
        F.concat_ws(":", F.lit("b"), "cluster", F.pmod(F.xxhash64("set"), blocks.cast("long"))))
    placed = put(finer.select("set", "cluster", (blocks > 1).alias("cut"), task.alias("task")))
    rows = small.select(task.alias("task"), "set", "tokens").unionByName(
        _those_of(large.select("set", "tokens"), placed).join(placed, "set").select("task", "set", "tokens"))
    links = put(_search(rows.select("task", "set", F.lit(True).alias("indexed"), F.col("set").alias("known"), "tokens"), percent))
    release(spark)
    # second pass: what is outside a cut cluster's largest component searches the cluster's other blocks
    cut = placed.where("cut")
    if not cut.isEmpty():
        so_far = components(links, temp)
        state = put(cut.join(so_far, cut["set"] == so_far["node"], "left").select(
            "set", "cluster", "task", F.coalesce("root", "set").alias("known")))
        parts = state.groupBy("cluster", "known").agg(F.count(F.lit(1)).alias("c"))
        main = parts.groupBy("cluster").agg(F.max_by("known", F.struct("c", "known")).alias("main"))
        rest = weighed(state.join(main, "cluster").where("known <> main").join(clusters.select("set", "n"), "set"))
        # the asking sets are cut as the indexed ones are; a task is a pair of blocks
        query = F.pmod(F.xxhash64("set", F.lit(1)), F.ceil(F.col("w") / block).cast("long"))
        rest = put(rest.select("set", "cluster", "known", F.col("task").alias("home"), query.alias("query")))
        at = state.select("cluster", "task").distinct()
        pair = F.concat_ws("/", "task", "query").alias("task")
        asks = rest.join(at, "cluster").where("task <> home")
        need = asks.select("task", "query").distinct()
        asks = asks.select(pair, "set", F.lit(False).alias("indexed"), "known")
        own = state.join(need, "task").select(pair, "set", F.lit(True).alias("indexed"), "known")
        again = own.unionByName(asks).join(_those_of(large.select("set", "tokens"), cut), "set")
        links = links.unionByName(put(_search(again, percent)))
    root = put(components(links, temp)).toDF("set", "root")
    named = members.join(root, "set", "left").withColumn("root", F.coalesce("root", "set"))
    least = named.where("root IS NOT NULL").groupBy("root").agg(F.min("id").alias("least"))
    out, _ = write_state(named.join(least, "root", "left").select("id", "n", "set", "root", "least"))
    several, _ = write_state(members.where("id IS NOT NULL").groupBy("id").agg(F.sum("rows").alias("rows"))
                             .where("rows > 1").select("id"))
    drop_state(spark, *temp)
    release(spark)
    return out, several


def drop_copies(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component: one of least id, null ids last.

    Rows with an id of their own stand or fall by it. Rows that share an id or
    have none are told apart by their text and, where that is equal too, by all
    their columns: of those that may stand for their component one stays, found
    by a pre-aggregated minimum. Rows without a shingle are linked with nothing
    and all stay. Dropped ids and ids of several rows are written, so that the
    planner sees their size and only broadcasts a small table; else the joins
    are shuffles.
    """
    named, several = _named_sets(docs, k, percent, id_col, text_col)
    own = named.join(several, "id", "left_anti").where("id IS NOT NULL AND root IS NOT NULL AND NOT (id <=> least)")
    dropped, _ = write_state(own.select(F.col("id").alias("__dropped")))
    shared, _ = write_state(several.select(F.col("id").alias("__shared")))
    known = docs[id_col].isNotNull()
    alone = docs.where(known).join(dropped, docs[id_col] == dropped["__dropped"], "left_anti") \
                .join(shared, docs[id_col] == shared["__shared"], "left_anti")
    if shared.isEmpty() and named.where("id IS NULL").isEmpty():
        return alone
    some = docs.where(~known).unionByName(docs.where(known).join(shared, docs[id_col] == shared["__shared"], "left_semi"))
    return alone.unionByName(_one_each(some, named, k, id_col, text_col))


def _one_each(some: DataFrame, named: DataFrame, k: int, id_col: str, text_col: str) -> DataFrame:
    """One row of every component whose least id its rows have, and all rows
    without a shingle."""
    whole = F.struct(*[F.col(f"`{c}`") for c in some.columns])
    src = some.select(whole.alias("row"), F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    schema = T.StructType([*src.schema.fields[:2], T.StructField("set", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes(WORDS)
        for b in batches:
            sets = [shingle_set(t, k, words) for t in text_bytes(b, "text")]
            ids = pa.array([set_id(x) if len(x) else None for x in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("id"), ids], names=schema.names)

    rows = src.mapInArrow(lean(run), schema)
    root = named.where("root IS NOT NULL").groupBy("set").agg(F.first("root").alias("root"), F.first("least").alias("least"))
    linked = rows.where("set IS NOT NULL").join(root, "set").where(F.col("id").eqNullSafe(F.col("least")))
    order = F.struct(F.xxhash64(F.col(f"row.`{text_col}`")), F.xxhash64(F.to_json("row")))
    one = linked.groupBy("root").agg(F.min_by("row", order).alias("row"))
    return one.select("row.*").unionByName(rows.where("set IS NULL").select("row.*"))
