"""Cross-tokenizer alignment by external spill counting.

A text with a space before it is encoded by two tokenizers, A (byte-level) and
B (pieces, which adds the space itself). Where a token of A and one of B end at
the same byte, the two are linked and a group ends. How often a pair of ids is
linked in the whole corpus is counted outside memory:

1. Tasks encode their documents and collect link records (B id, A id, document).
   A block of about ``BLOCK`` records is sorted side-major (by B, then A, then
   document), dealt by radix of the B id into ``CELLS`` cells, and every cell's
   records become one zstd run: a head (pairs and their totals) and a body (the
   documents of every pair). Runs are written to the shared folder.
2. The heads of a cell are merged by a heap over its runs, which counts each
   pair. A cell with many runs is split into parts of bounded size first; the
   parts' counts are merged the same way. As all pairs of a B id come one after
   the other, the greatest count of the id is known when its last pair has been
   merged.
3. The runs of every part meet the counts of their cell, and what the pairs
   contribute to every document of a block streams back to that block, where it
   is added up and joined to the document's row.

No cell, id or pair is collected: the third of all records that one id may hold
is spread over the parts of its cell, and a task holds one part (``PART_BYTES``
of runs) and the pairs of one cell.

Encoding is done by units. A unit is a space and what follows up to the next
single space between two characters that are not white space; neither tokenizer
joins bytes across such a place (B's vocabulary is checked for that), so the
units' ids one after the other are the text's. Units that repeat are encoded
once per task while a bounded cache holds them.

Defined cases: a null or empty text, and one that either tokenizer does not
give back byte for byte, has no tokens: zeros and an empty digest. Repeated rows
count and are returned as often as they occur, null ids stay null, an empty
table gives no rows. Columns other than id and text are not read.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
import os
import re
import struct
from collections.abc import Iterator
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.llm.common import write_state

CELLS = 256
BLOCK = 1 << 20  # link records sorted at once
BLOCK_DOCS = 60_000
PART_BYTES = 16 << 20  # runs that meet in one task
CACHE = 400_000  # units kept by a worker (some 400 bytes each), of at most UNIT characters
UNIT = 64

_CUT = re.compile(r"(?<=\S) (?=\S)")
_RARE = re.compile("[^\x00-ɏ‐-‧]")


def _byte_alphabet() -> dict[str, int]:
    """Characters of the byte-level alphabet: printable bytes stand for
    themselves, the others, in order, for the characters from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class ByteLevel:
    """Side A. Where the file is a plain byte-level merge table whose ids
    follow the merges, common characters take the faster library that works on
    ranks; all else passes the file's own tokenizer."""

    # the split pattern that byte-level files use when they name none (fixed value)
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

    def __init__(self, tokenizer_json: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_str(tokenizer_json)
        self.tok.encode_special_tokens = True
        spec = json.loads(tokenizer_json)
        alphabet, vocab = _byte_alphabet(), spec["model"]["vocab"]
        named = {t["content"] for t in spec.get("added_tokens") or []}
        size = max([*vocab.values(), *(t["id"] for t in spec.get("added_tokens") or [])]) + 1
        self.bytes: list[bytes] = [b""] * size
        for token, i in vocab.items():
            self.bytes[i] = token.encode() if token in named else bytes(alphabet[c] for c in token)
        pre = spec.get("pre_tokenizer") or {}
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"].get("merges", [])]
        plain = (spec["model"]["type"] == "BPE" and not spec.get("normalizer") and pre.get("type") == "ByteLevel"
                 and pre.get("use_regex", True) and not pre.get("add_prefix_space") and not spec["model"].get("dropout")
                 and not spec["model"].get("ignore_merges") and all(vocab.get(a + b) == 256 + k for k, (a, b) in enumerate(merges)))
        self.by_rank = None
        if plain:
            import tiktoken
            ranks = {self.bytes[i]: i for t, i in vocab.items() if t not in named}
            self.by_rank = tiktoken.Encoding("a", pat_str=self.PATTERN, mergeable_ranks=ranks, special_tokens={})
        # a file that splits at white space never joins across a cut
        self.units = plain

    def encode(self, text: str) -> list[int]:
        if self.by_rank is not None and _RARE.search(text) is None:
            return self.by_rank.encode_ordinary(text)
        return self.tok.encode(text, add_special_tokens=False).ids


class Pieces:
    """Side B; the model adds the space before the text."""

    def __init__(self, model: bytes):
        import sentencepiece
        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        names = [self.sp.id_to_piece(i) for i in range(self.sp.get_piece_size())]
        self.bytes = [bytes([int(n[3:5], 16)]) if self.sp.is_byte(i) else n.replace("▁", " ").encode()
                      for i, n in enumerate(names)]
        self.units = not any(re.search("[^▁]▁", n) for n in names)

    def encode(self, text: str) -> list[int]:
        return self.sp.encode(text)

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        return self.sp.encode(texts, num_threads=1)


def align(a: list[int], b: list[int], a_bytes: list[bytes], b_bytes: list[bytes]) -> tuple[str, list[int]]:
    """The groups' text and the links (B id << 32 | A id) of two encodings of
    the same bytes. Every group ends with its link; a token without bytes ends
    where the one before it does and is linked there too."""
    groups, links = [], []
    i = j = i0 = j0 = 0
    at_a = at_b = 0
    while i < len(a) or j < len(b):
        if i < len(a) and (at_a <= at_b or j == len(b)):
            at_a += len(a_bytes[a[i]])
            i += 1
        else:
            at_b += len(b_bytes[b[j]])
            j += 1
        if at_a == at_b and i > i0 and j > j0:
            while i < len(a) and not a_bytes[a[i]]:
                i += 1
            while j < len(b) and not b_bytes[b[j]]:
                j += 1
            ends = []
            for ids, table, lo, hi in ((a, a_bytes, i0, i), (b, b_bytes, j0, j)):
                k = hi - 1
                while k > lo and not table[ids[k]]:
                    k -= 1
                ends.append(ids[k:hi])
            links += [y << 32 | x for x in ends[0] for y in ends[1]]
            groups.append(",".join(map(str, a[i0:i])) + "|" + ",".join(map(str, b[j0:j])))
            i0, j0 = i, j
    return ";".join(groups), links


class Aligner:
    """Text -> (A tokens, B tokens, groups, the groups' text, links as bytes)."""

    NONE = (0, 0, 0, "", b"")

    def __init__(self, tokenizer_json: str, model: bytes):
        self.a, self.b = ByteLevel(tokenizer_json), Pieces(model)
        self.units = self.a.units and self.b.units
        self.sizes = [len(x) for x in self.a.bytes], [len(x) for x in self.b.bytes]
        self.names = [str(i) for i in range(max(map(len, self.sizes)))]
        # for many units at once: lengths, and names with what follows them
        self.lengths = tuple(np.array(x, np.int64) for x in self.sizes)
        self.text = {end: np.array([n + end for n in self.names], object) for end in ",|;"}
        self.young: dict[str, tuple] = {}
        self.old: dict[str, tuple] = {}

    def _aligned(self, spaced: bytes, a: list[int], b: list[int]) -> tuple:
        """``NONE`` where a side does not give the bytes back."""
        if b"".join([self.a.bytes[x] for x in a]) != spaced or b"".join([self.b.bytes[x] for x in b]) != spaced:
            return self.NONE
        in_a, in_b = [self.sizes[0][x] for x in a], [self.sizes[1][x] for x in b]
        if 0 in in_a or 0 in in_b:
            groups, links = align(a, b, self.a.bytes, self.b.bytes)
            return len(a), len(b), groups.count(";") + 1, groups, struct.pack(f"<{len(links)}q", *links)
        ends_a, ends_b = list(accumulate(in_a)), list(accumulate(in_b))
        both = set(ends_a).intersection(ends_b)
        own_a, own_b = [self.names[x] for x in a], [self.names[x] for x in b]
        if len(both) == len(a) == len(b):  # token by token
            groups = ";".join(map("|".join, zip(own_a, own_b)))
            links = [y << 32 | x for x, y in zip(a, b)]
        else:
            to_a = [i + 1 for i, e in enumerate(ends_a) if e in both]
            to_b = [i + 1 for i, e in enumerate(ends_b) if e in both]
            groups = ";".join([",".join(own_a[i0:i]) + "|" + ",".join(own_b[j0:j])
                               for i0, i, j0, j in zip([0, *to_a], to_a, [0, *to_b], to_b)])
            links = [b[j - 1] << 32 | a[i - 1] for i, j in zip(to_a, to_b)]
        return len(a), len(b), len(links), groups, struct.pack(f"<{len(links)}q", *links)

    def _whole(self, text: str) -> tuple:
        spaced = " " + text
        return self._aligned(spaced.encode(), self.a.encode(spaced), self.b.encode(text))

    def _learn(self, units: set[str]) -> None:
        """Put units into the young generation: from the old one, or encoded."""
        new = []
        for u in units:
            part = self.old.get(u)
            if part is None:
                new.append(u)
            else:
                self.young[u] = part
        if new:
            spaced = [" " + u for u in new]
            a, b = [self.a.encode(x) for x in spaced], self.b.encode_all(new)
            raw = [x.encode() for x in spaced]
            parts = self._aligned_all(raw, a, b) if len(new) > 5 else None
            self.young.update(zip(new, parts or map(self._aligned, raw, a, b)))

    def _aligned_all(self, spaced: list[bytes], a: list[list[int]], b: list[list[int]]) -> list[tuple] | None:
        """:meth:`_aligned` of many units laid one after the other; None where
        one is not given back or has a token without bytes."""
        want = b"".join(spaced)
        flat_a, flat_b = list(chain.from_iterable(a)), list(chain.from_iterable(b))
        if b"".join([self.a.bytes[x] for x in flat_a]) != want or b"".join([self.b.bytes[x] for x in flat_b]) != want:
            return None
        flat_a, flat_b = np.array(flat_a, np.int64), np.array(flat_b, np.int64)
        in_a, in_b = self.lengths[0][flat_a], self.lengths[1][flat_b]
        ends_a, ends_b = np.cumsum(in_a), np.cumsum(in_b)
        n_a, n_b = np.array([len(x) for x in a]), np.array([len(x) for x in b])
        to_a, to_b = np.cumsum(n_a), np.cumsum(n_b)
        size = np.cumsum([len(x) for x in spaced])
        if not (in_a.all() and in_b.all() and n_a.all() and n_b.all()) \
                or (ends_a[to_a - 1] != size).any() or (ends_b[to_b - 1] != size).any():
            return None
        last_a = ends_b[np.searchsorted(ends_b, ends_a)] == ends_a  # ends a group
        last_b = ends_a[np.searchsorted(ends_a, ends_b)] == ends_b
        done_a, done_b = np.cumsum(last_a), np.cumsum(last_b)
        starts_b = np.append(0, np.flatnonzero(last_b) + 1)  # of the groups
        starts_a = np.append(0, np.flatnonzero(last_a) + 1)
        # a group's tokens of A, then those of B
        out = np.empty(len(flat_a) + len(flat_b), object)
        out[np.arange(len(flat_a)) + starts_b[done_a - last_a]] = np.where(last_a, self.text["|"][flat_a], self.text[","][flat_a])
        out[np.arange(len(flat_b)) + starts_a[done_b - last_b + 1]] = np.where(last_b, self.text[";"][flat_b], self.text[","][flat_b])
        out = out.tolist()
        links = (flat_b[last_b] << 32 | flat_a[last_a]).astype("<i8").tobytes()
        tokens, groups = [0, *(to_a + to_b).tolist()], [0, *done_a[to_a - 1].tolist()]
        return [(x, y, g - f, "".join(out[s:e])[:-1], links[8 * f: 8 * g])
                for x, y, f, g, s, e in zip(n_a.tolist(), n_b.tolist(), groups, groups[1:], tokens, tokens[1:])]

    def align(self, text: str | None) -> tuple:
        if not text:
            return self.NONE
        if not self.units:
            return self._whole(text)
        if len(self.young) >= CACHE // 2:  # two generations, so that frequent units stay
            self.old, self.young = self.young, {}
        units = _CUT.split(text)  # a cut takes the unit's space, which is put back
        parts = list(map(self.young.get, units))
        if None in parts:
            missing = {u for u, p in zip(units, parts) if p is None}
            self._learn(missing)
            parts = list(map(self.young.get, units))
            for u in missing:
                if len(u) > UNIT:
                    del self.young[u]
        if self.NONE in parts:
            return self._whole(text)
        n_a, n_b, n_groups, groups, links = zip(*parts)
        return sum(n_a), sum(n_b), sum(n_groups), ";".join(groups), b"".join(links)


# ------------------------------------------------------------ runs

def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays of one length each, zstd over their bytes."""
    raw = [np.ascontiguousarray(x) for x in arrays]
    head = np.array([x.nbytes for x in raw], "<i8").tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(x.tobytes() for x in raw))


def _unpack(blob: bytes, *types: str) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    at, out = 8 * len(types), []
    for n, t in zip(np.frombuffer(raw, "<i8", len(types)), types):
        out.append(np.frombuffer(raw, t, int(n) // np.dtype(t).itemsize, at))
        at += int(n)
    return out


def _head(keys: np.ndarray, totals: np.ndarray, n_docs: np.ndarray) -> bytes:
    return _pack(np.diff(keys, prepend=0), totals, n_docs.astype("<i4"))


def _read_head(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    steps, totals, n_docs = _unpack(blob, "<i8", "<i8", "<i4")
    return np.cumsum(steps), totals, n_docs


def block_runs(keys: np.ndarray, docs: np.ndarray) -> Iterator[tuple[int, int, bytes, bytes]]:
    """(cell, records, head, body) of every cell of a block; ``docs`` ascends."""
    order = np.lexsort((docs, keys, (keys >> 32) % CELLS))
    keys, docs = keys[order], docs[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (docs[1:] != docs[:-1])
    at = np.flatnonzero(new)
    times = np.diff(at, append=len(keys))
    keys, docs = keys[at], docs[at]
    cell = (keys >> 32) % CELLS
    cuts = np.flatnonzero(np.diff(cell)) + 1
    for lo, hi in zip([0, *cuts], [*cuts, len(keys)]):
        k = keys[lo:hi]
        first = np.flatnonzero(np.diff(k, prepend=-1))
        yield (int(cell[lo]), hi - lo, _head(k[first], np.add.reduceat(times[lo:hi], first), np.diff(first, append=hi - lo)),
               _pack(docs[lo:hi].astype("<u2"), times[lo:hi].astype("<i4")))


def merge_runs(heads: list[bytes]) -> Iterator[tuple[int, int]]:
    """(pair, count) in side-major order, by a heap over the runs."""
    def entries(blob: bytes) -> Iterator[tuple[int, int]]:
        keys, totals, _ = _read_head(blob)
        return zip(keys.tolist(), totals.tolist())

    last, count = -1, 0
    for key, total in heapq.merge(*map(entries, heads)):
        if key != last:
            if last >= 0:
                yield last, count
            last, count = key, 0
        count += total
    if last >= 0:
        yield last, count


def with_best(pairs: Iterator[tuple[int, int]]) -> Iterator[tuple[int, int, bool]]:
    """Pairs in side-major order with whether their count is the B id's
    greatest: one B id's pairs are held at a time."""
    side, held = -1, []
    for key, count in pairs:
        if key >> 32 != side:
            top = max([c for _, c in held], default=0)
            yield from ((k, c, c == top) for k, c in held)
            side, held = key >> 32, []
        held.append((key, count))
    top = max([c for _, c in held], default=0)
    yield from ((k, c, c == top) for k, c in held)


# ------------------------------------------------------------ the operator

def align_tokens(docs: DataFrame, tokenizer_json: str, model: bytes, id_col: str = "doc_id",
                 text_col: str = "text", with_groups: bool = False) -> DataFrame:
    """``(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)``
    of every row and, on demand, ``groups``: ids of A and B as
    ``a1,a2|b1;a3|b2,b3``. ``n_best`` counts the links whose pair is the most
    frequent of its B id in the corpus, ties included, ``count_sum`` adds the
    pairs' corpus counts over the links."""
    state, _ = write_state(_spill(docs, tokenizer_json, model, id_col, text_col, with_groups))
    runs = state.where(F.col("cell").isNotNull()).select("block", "cell", "head", "body")
    sizes = {r["cell"]: r["n"] for r in runs.groupBy("cell").agg(F.sum(F.length("head") + F.length("body")).alias("n")).collect()}
    parts = [max(1, -(-sizes.get(c, 0) // PART_BYTES)) for c in range(CELLS)]  # one number a cell
    n_parts = F.element_at(F.array(*map(F.lit, parts)), F.col("cell") + 1)
    runs = runs.withColumn("part", F.pmod(F.xxhash64("block"), n_parts).cast("int"))

    counted = "cell int, part int, head binary"
    counts = runs.select("cell", "part", "head").groupBy("cell", "part").applyInArrow(_count, counted) \
                 .groupBy("cell").applyInArrow(_count_best, counted)
    counts = counts.withColumn("part", F.explode(F.sequence(F.lit(0), (n_parts - 1).cast("int"))))
    shares = runs.groupBy("cell", "part").cogroup(counts.groupBy("cell", "part")).applyInArrow(
        _contributions, "block long, shares binary")

    own = state.where(F.col("cell").isNull())
    fields = ["id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"] + (["groups"] if with_groups else [])
    rows = own.select("block", "row", *fields)
    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType)] + [
        T.StructField(c, T.LongType()) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")] + [
        T.StructField(c, T.StringType()) for c in fields[5:]])
    done = rows.groupBy("block").cogroup(shares.groupBy("block")).applyInArrow(_add_up(schema.names), schema)
    return done.withColumnRenamed("id", id_col)


def _spill(docs: DataFrame, tokenizer_json: str, model: bytes, id_col: str, text_col: str, with_groups: bool) -> DataFrame:
    """Rows of documents (``cell`` null) and rows of runs (``id`` null)."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    named = [("block", T.LongType()), ("row", T.IntegerType()), ("id", src.schema["id"].dataType), ("n_a", T.LongType()),
             ("n_b", T.LongType()), ("n_groups", T.LongType()), ("n_links", T.LongType()), ("groups_sha256", T.StringType()),
             ("groups", T.StringType()), ("cell", T.IntegerType()), ("head", T.BinaryType()), ("body", T.BinaryType())]
    schema = T.StructType([T.StructField(*x) for x in named])
    # two vocabulary files, a few MB
    bc = docs.sparkSession.sparkContext.broadcast((tokenizer_json, base64.b64encode(model).decode()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(bc.value[0], base64.b64decode(bc.value[1]))
        block = TaskContext.get().partitionId() << 32
        links, n_links, n_docs = [], 0, 0

        def flush() -> Iterator[pa.RecordBatch]:
            keys = np.frombuffer(b"".join(x for _, x in links), "<i8")
            at = np.repeat([r for r, _ in links], [len(x) // 8 for _, x in links]).astype(np.int64)
            found = list(block_runs(keys, at)) if len(keys) else []
            for lo in range(0, len(found), 64):
                part = found[lo: lo + 64]
                empty = [pa.nulls(len(part), f.type) for f in arrow]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block] * len(part), pa.int64()), *empty[1:9], pa.array([x[0] for x in part], pa.int32()),
                     pa.array([x[2] for x in part], pa.binary()), pa.array([x[3] for x in part], pa.binary())], names=schema.names)

        arrow = None
        for b in batches:
            if arrow is None:
                from pyspark.sql.pandas.types import to_arrow_schema
                arrow = to_arrow_schema(schema)
            lo, rows = 0, []
            for r, text in enumerate(b.column("text")):
                n_a, n_b, n_groups, groups, keys = aligner.align(text.as_py())
                sha = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
                rows.append((block, n_docs, n_a, n_b, n_groups, len(keys) // 8, sha, groups if with_groups else None))
                if keys:
                    links.append((n_docs, keys))
                    n_links += len(keys) // 8
                n_docs += 1
                full = n_links >= BLOCK or n_docs >= BLOCK_DOCS
                if full or r == b.num_rows - 1:
                    cols = list(zip(*rows))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()),
                         b.column("id").slice(lo, len(rows)).cast(arrow.field("id").type),
                         *[pa.array(c, pa.int64()) for c in cols[2:6]], pa.array(cols[6], pa.string()),
                         pa.array(cols[7], pa.string()), *[pa.nulls(len(rows), f.type) for f in list(arrow)[9:]]],
                        names=schema.names)
                    lo, rows = r + 1, []
                if full:
                    yield from flush()
                    links, n_links, n_docs = [], 0, 0
                    block += 1
        if links:
            yield from flush()

    return src.mapInArrow(run, schema)


def _count(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    cell, part = (k.as_py() for k in key)
    merged = np.array(list(merge_runs(table.column("head").to_pylist())), np.int64).reshape(-1, 2)
    head = _head(merged[:, 0], merged[:, 1], np.zeros(len(merged)))
    return pa.table({"cell": pa.array([cell], pa.int32()), "part": pa.array([part], pa.int32()), "head": pa.array([head], pa.binary())})


def _count_best(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """One row: the cell's pairs, their counts, and 1 where it is the best."""
    merged = np.array(list(with_best(merge_runs(table.column("head").to_pylist()))), np.int64).reshape(-1, 3)
    head = _head(merged[:, 0], merged[:, 1], merged[:, 2])
    return pa.table({"cell": pa.array([key[0].as_py()], pa.int32()), "part": pa.array([0], pa.int32()),
                     "head": pa.array([head], pa.binary())})


def _contributions(runs: pa.Table, counts: pa.Table) -> pa.Table:
    """What the pairs of every run add to the documents of its block."""
    blocks, out = [], []
    if runs.num_rows:
        pairs, count, best = _read_head(counts.column("head")[0].as_py())
        for block, head, body in zip(runs.column("block"), runs.column("head"), runs.column("body")):
            keys, _, n_docs = _read_head(head.as_py())
            docs, times = _unpack(body.as_py(), "<u2", "<i4")
            at = np.repeat(np.searchsorted(pairs, keys), n_docs)
            who, back = np.unique(docs, return_inverse=True)
            n_best, total = np.zeros(len(who), np.int64), np.zeros(len(who), np.int64)
            np.add.at(n_best, back, times * best[at].astype(np.int64))
            np.add.at(total, back, times * count[at])
            blocks.append(block.as_py())
            out.append(_pack(who, n_best.astype("<i4"), total))
    return pa.table({"block": pa.array(blocks, pa.int64()), "shares": pa.array(out, pa.binary())})


def _add_up(names: list[str]):
    def run(rows: pa.Table, shares: pa.Table) -> pa.Table:
        place = rows.column("row").to_numpy()
        n_best, total = np.zeros(BLOCK_DOCS + 1, np.int64), np.zeros(BLOCK_DOCS + 1, np.int64)
        for blob in shares.column("shares"):
            who, b, t = _unpack(blob.as_py(), "<u2", "<i4", "<i8")
            n_best[who] += b
            total[who] += t
        got = {"n_best": pa.array(n_best[place]), "count_sum": pa.array(total[place])}
        return pa.table({c: got[c] if c in got else rows.column(c) for c in names})

    return run
