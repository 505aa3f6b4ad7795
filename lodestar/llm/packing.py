"""Best-fit packing by swap-based local search.

Documents become token ids (a tokenizer file, its path a parameter) plus one
end id, and are cut into pieces only where longer than a sequence. Pieces are
dealt at random over groups of bounded size; every group is packed by itself:
best-fit decreasing, then local search over the underfull bins. A step moves a
piece, exchanges one piece for a smaller one, or two pieces for one smaller
than both together, always so that the sum of squared fills grows, until the
emptiest bins have given everything away or no step helps.

Defined cases: a null or empty text is the end id alone; repeated rows are
packed as often as they occur; a null id stays null; an empty table gives no
rows; columns other than id and text are not read.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.llm.common import lean, write_state

GROUP = 16_384  # pieces packed together by one call


# characters whose composition, lower case and class are the same by every
# Unicode version: ASCII, Latin letters below U+0250 (but U+0130, whose lower
# case is two characters), common punctuation
_COMMON = ("\\t-\\r -~\xa1-\xa9\xab\xac\xae-\xb1\xb4\xb6-\xb8\xbb\xbf\xc0-\u012f\u0131-\u024f"
           "\u2010-\u2027\u2030-\u205e")
_UNCOMMON = re.compile(f"[^{_COMMON}]|<\\|")  # or what may be a special token
_LETTERS = "a-z\xdf-\xf6\xf8-\u024f"
# the file's own split pattern, over lower-case common characters
_SPLIT = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^\\s{_LETTERS}0-9]+")


def _byte_alphabet() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the
    others, in order, for the characters from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


# what a tokenizer file must say for the split above to be its own (fixed values)
_NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
_PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}


def splits_as_expected(spec: dict) -> bool:
    """Whether a tokenizer file splits texts as :data:`_SPLIT` does; any other
    file encodes whole texts."""
    return (spec.get("normalizer") == _NORMALIZER and spec.get("pre_tokenizer") == _PRE_TOKENIZER
            and spec["model"]["type"] == "BPE" and not spec["model"].get("dropout")
            and all(t["content"].startswith("<|") for t in spec.get("added_tokens") or []))


class TokenCache(dict):
    """unit -> its ids as little-endian uint32, at most ``limit`` of them.

    The tokenizer splits a text into units and encodes each by itself, so a
    text's ids are its units' ids one after the other. Texts of common
    characters are split here by the file's pattern; other texts are split at
    ASCII white space only (the tokenizer drops it and never joins across it)
    and their words pass the whole tokenizer.
    """

    def __init__(self, tokenizer_json: str, limit: int = 250_000):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_str(tokenizer_json)
        self.model = self.tok.model
        self.by_units = splits_as_expected(json.loads(tokenizer_json))
        self.alphabet = _byte_alphabet()
        self.words: dict[str, bytes] = {}
        self.limit = limit

    def __missing__(self, unit: str) -> bytes:
        if len(self) >= self.limit:
            self.clear()
        u = unit if unit.isascii() else unit.encode().decode("latin-1").translate(self.alphabet)
        ids = self[unit] = struct.pack(f"<{len(t)}I", *[x.id for x in t]) if (t := self.model.tokenize(u)) else b""
        return ids

    def _word(self, word: str) -> bytes:
        if (ids := self.words.get(word)) is None:
            if len(self.words) >= self.limit // 5:
                self.words.clear()
            found = self.tok.encode(word, add_special_tokens=False).ids
            ids = self.words[word] = np.array(found, dtype="<u4").tobytes()
        return ids

    def encode(self, text: str) -> bytes:
        if not self.by_units:
            return np.array(self.tok.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        if _UNCOMMON.search(text) is None:
            return b"".join(map(self.__getitem__, _SPLIT.findall(text.lower())))
        return b"".join([self._word(w.decode()) for w in text.encode().split()])


def read_tokenizer(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def token_pieces(docs: DataFrame, tokenizer_json: str, max_len: int = 2048, end_id: int = 0,
                 id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """``(id, piece, start, length, ids_crc32)`` and, on demand, ``ids`` (the
    piece's ids as little-endian uint32)."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    fields = [T.StructField(id_col, src.schema["id"].dataType), T.StructField("piece", T.IntegerType()),
              T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
              T.StructField("ids_crc32", T.LongType())]
    if with_ids:
        fields.append(T.StructField("ids", T.BinaryType()))
    bc = docs.sparkSession.sparkContext.broadcast(tokenizer_json)  # one vocabulary file, a few MB
    end, step = int(end_id).to_bytes(4, "little"), 4 * max_len

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = TokenCache(bc.value)
        for b in batches:
            row, piece, start, length, crc, ids = [], [], [], [], [], []
            for r, text in enumerate(b.column("text")):
                enc = cache.encode(text.as_py() or "") + end
                for p, s in enumerate(range(0, len(enc), step)):
                    part = enc[s: s + step]
                    row.append(r)
                    piece.append(p)
                    start.append(s // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(part)
            cols = [b.column("id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            if with_ids:
                cols.append(pa.array(ids, pa.binary()))
            yield pa.RecordBatch.from_arrays(cols, names=[f.name for f in fields])

    return src.mapInArrow(lean(run), T.StructType(fields))


def best_fit(lengths: np.ndarray, cap: int) -> list[list[int]]:
    """Best-fit decreasing: bins as lists of piece indices."""
    bins: list[list[int]] = []
    room: list[list[int]] = [[] for _ in range(cap + 1)]  # free space -> bins
    free: list[int] = []  # the free spaces that occur, sorted
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        k = bisect_left(free, n)
        if k == len(free):
            bins.append([i])
            left, at = cap - n, len(bins) - 1
        else:
            space = free[k]
            at = room[space].pop()
            if not room[space]:
                free.pop(k)
            bins[at].append(i)
            left = space - n
        if left:
            if not room[left]:
                insort(free, left)
            room[left].append(at)
    return bins


class LocalSearch:
    """Exchanges between underfull bins. One slot per piece of an underfull
    bin; ``size`` is its length and ``reach`` that plus the bin's free space,
    so a gift of s fits in exchange for the slot iff size < s <= reach."""

    def __init__(self, lengths: np.ndarray, bins: list[list[int]], cap: int):
        self.len, self.cap = lengths.astype(np.int64), cap
        self.bins = [list(b) for b in bins]
        self.fill = np.array([int(self.len[b].sum()) for b in bins], dtype=np.int64)
        under = np.flatnonzero(self.fill < cap)
        self.piece = np.array([i for b in under for i in self.bins[b]], dtype=np.int64)
        self.owner = np.array([b for b in under for _ in self.bins[b]], dtype=np.int64)
        self.slot = {int(p): k for k, p in enumerate(self.piece)}
        self.size = self.len[self.piece]
        self.reach = self.size + cap - self.fill[self.owner]
        self.slots = {int(b): [self.slot[i] for i in self.bins[b]] for b in under}
        self.under = under

    def _settle(self, b: int) -> None:
        for i in self.bins[b]:
            k = self.slot[i]
            self.owner[k] = b
            self.reach[k] = self.size[k] + self.cap - self.fill[b]

    def _transfer(self, a: int, give: list[int], b: int, take: int | None) -> None:
        got = int(self.len[give].sum()) - (int(self.len[take]) if take is not None else 0)
        for i in give:
            self.bins[a].remove(i)
            self.bins[b].append(i)
        if take is not None:
            self.bins[b].remove(take)
            self.bins[a].append(take)
        self.fill[a] -= got
        self.fill[b] += got
        self._settle(a)
        self._settle(b)

    def _gifts(self, a: int) -> tuple[np.ndarray, dict[int, list[int]]]:
        """The sums that one or two pieces of bin ``a`` make, in order, and
        pieces for each; equal lengths are one choice, so there are few."""
        by_len: dict[int, list[int]] = {}
        for i in self.bins[a]:
            by_len.setdefault(int(self.len[i]), []).append(i)
        gift = {n: own[:1] for n, own in by_len.items()}
        sizes = sorted(by_len)
        for x, n in enumerate(sizes):
            if len(by_len[n]) > 1:
                gift.setdefault(2 * n, by_len[n][:2])
            for m in sizes[x + 1:]:
                gift.setdefault(n + m, [by_len[n][0], by_len[m][0]])
        return np.array(sorted(gift), dtype=np.int64), gift

    def _step(self, a: int) -> bool:
        """One improving move or exchange out of bin ``a``."""
        fills = self.fill[self.under]
        # move: the longest piece that some other bin takes, into the fullest such bin
        for n, i in sorted({int(self.len[i]): i for i in self.bins[a]}.items(), reverse=True):
            fits = np.where((fills + n <= self.cap) & (fills > 0) & (self.under != a), fills, 0)
            k = int(fits.argmax())
            if fits[k] and fits[k] + n > self.fill[a]:
                self._transfer(a, [i], int(self.under[k]), None)
                return True
        # exchange: for every slot the largest gift that its bin takes instead
        sums, gift = self._gifts(a)
        at = np.searchsorted(sums, self.reach, side="right") - 1
        s = np.where(at >= 0, sums[at], 0)
        # the sum of squares must grow: fill(b) + gain > fill(a)
        good = (s > self.size) & (self.owner != a) & (self.cap - self.reach + s > self.fill[a])
        gain = np.where(good, s - self.size, 0)
        k = int(gain.argmax())
        if not gain[k]:
            return False
        self._transfer(a, gift[int(s[k])], int(self.owner[k]), int(self.piece[k]))
        return True

    def run(self) -> list[list[int]]:
        """Steps out of the bins, emptiest first, until a whole pass finds
        none; each makes the sum of squared fills grow, so that ends."""
        moved = True
        while moved:
            moved = False
            for a in self.under[np.argsort(self.fill[self.under], kind="stable")].tolist():
                while 0 < self.fill[a] < self.cap and self._step(a):
                    moved = True
        return [b for b in self.bins if b]


def pack_group(lengths: np.ndarray, cap: int) -> list[list[int]]:
    return LocalSearch(lengths, best_fit(lengths, cap), cap).run()


def pack(pieces: DataFrame, max_len: int = 2048, group: int = GROUP) -> DataFrame:
    """``pieces`` (with a ``length`` column) plus ``sequence_id`` and
    ``offset``. The pieces are written once, so their number is known and a
    row keeps its group if a task is run again."""
    state, _ = write_state(pieces)
    groups = max(1, -(-state.count() // group))
    keyed = state.withColumn("pack_group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))
    schema = T.StructType([*state.schema.fields, T.StructField("sequence_id", T.LongType()),
                           T.StructField("offset", T.LongType())])

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        lengths = rows["length"].to_numpy()
        seq, off = np.empty(len(rows), np.int64), np.empty(len(rows), np.int64)
        for k, members in enumerate(pack_group(lengths, max_len)):
            seq[members] = (int(key[0]) << 32) + k
            off[members] = np.cumsum(lengths[members]) - lengths[members]
        return rows.drop(columns="pack_group").assign(sequence_id=seq, offset=off)

    return keyed.groupBy("pack_group").applyInPandas(run, schema)


def pack_documents(docs: DataFrame, tokenizer_json: str, max_len: int = 2048, end_id: int = 0,
                   id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    return pack(token_pieces(docs, tokenizer_json, max_len, end_id, id_col, text_col, with_ids), max_len)
