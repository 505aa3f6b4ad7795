"""Word and document vectors by negative sampling, trained and frozen.

Word parameters are tables ``(word, n, vin, vout)``; document vectors stay with
their documents. A sentence's window may hold words of the whole vocabulary, so
parameters are not cut into fixed blocks; instead every epoch fetches, for a
group of shards of sentences, the rows their words and noise words need:

* documents are hashed into shards of about ``shard_tokens`` tokens, shards into
  groups of at most ``SHARDS``; as most words occur in every group, there are no
  more groups than tasks at a time until that bound asks for more;
* documents are packed once, their words as numbers of their group (compressed
  Arrow tables), so an epoch moves about two bytes a token;
* a group draws the pools of noise words of its shards from the corpus-wide noise
  distribution (D19) by MD5 numbers;
* the words and pools of a group are joined to the parameter table once for all
  its shards and cogrouped with its documents; every shard starts from the same
  rows and is trained sentence by sentence in order (batches of ``batch``
  positions, or about as many examples, see the same parameters; 1 is the plain
  loop). Shards are trained side by side, a batch of each at a time, on rows of
  their own;
* a group gives the sums of the changes of every word its shards touched; changes
  are averaged over the shards that touched a word (parameter mixing) and added
  to the table in the same job, which writes the table for the next epoch.

Nothing of the model passes the driver, which sees one loss per epoch; a task
holds one group's documents and rows. Draws depend on seed, epoch and document
id only, so a retry or another layout gives the same numbers.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.operators.text import build_vocab, noise_distribution
from lodestar.plans.blocks import matrix, packed, unpacked
from lodestar.plans.iterate import discard, materialize

MODES = ("cbow", "sg", "dbow", "dm")
SHARDS = 256  # of a group, at most
PART = 1 << 20  # tokens of a packed part
BATCH = 1 << 14  # rows of words that are given back at a time
HELD = 1 << 27  # bytes of shards that are trained side by side


@dataclass(frozen=True)
class Config:
    """``mode``: ``cbow`` and ``sg`` train words; ``dbow`` and ``dm`` train a
    vector per document, with the words unless these are frozen. ``mean``:
    a window's input is the mean, else the sum, of its vectors."""

    mode: str = "cbow"
    dim: int = 100
    window: int = 5
    negative: int = 5
    epochs: int = 5
    alpha: float = 0.025
    min_alpha: float = 0.0001
    min_count: int = 5
    mean: bool = True
    batch: int = 32
    pool: int = 5000
    shard_tokens: int = 50_000
    seed: int = 1
    frozen: bool = False

    @property
    def documents(self) -> bool:
        return self.mode in ("dbow", "dm")


@dataclass
class Embeddings:
    words: DataFrame  # (word, n, vin, vout)
    docs: DataFrame | None  # (id, vec)
    losses: list[float]  # mean loss of every epoch


def generator(*parts) -> np.random.Generator:
    """Random numbers keyed by the MD5 of the parts."""
    key = hashlib.md5(":".join(map(str, parts)).encode()).digest()
    return np.random.Generator(np.random.Philox(key=np.frombuffer(key, "<u8")))


def first_vector(dim: int, *parts) -> np.ndarray:
    return (generator("init", *parts).random(dim) - 0.5) / dim


def _integers(raw: np.ndarray, n: int) -> np.ndarray | None:
    """What ``Generator.integers(0, n)`` makes of these 32-bit numbers; none
    where it would draw one of them again."""
    wide = raw.astype(np.uint64) * np.uint64(n)
    if ((wide & np.uint64(0xFFFFFFFF)) < np.uint64((1 << 32) % n)).any():
        return None
    return (wide >> np.uint64(32)).astype(np.int32)


def _raw(rng: np.random.Generator, n: int) -> np.ndarray:
    """The next ``n`` 32-bit numbers of a fresh generator."""
    return rng.bit_generator.random_raw(-(-n // 2)).astype("<u8", copy=False).view("<u4")[:n]


def positions(c: Config) -> int:
    """Positions of a batch; with ``sg`` one has an example per word of its window."""
    return max(1, c.batch // (2 * c.window)) if c.mode == "sg" else c.batch


def draws(n: int, n_pool: int, c: Config, *key) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For a document of ``n`` words the reach of every position's window, the
    noise of every example (places of the pool) and the examples of every batch.
    The numbers are those of a :func:`generator` that draws the reaches of a
    batch and then its noise, batch by batch; they are made all at once."""
    step, w, neg = positions(c), c.window, c.negative
    sizes = np.full(-(-n // step), step)
    sizes[-1] = n - step * (len(sizes) - 1)
    p = np.arange(n)
    windows = 0 if c.mode == "dbow" else 1
    if w > 1 and n_pool > 1:
        if c.mode != "sg":
            raw = _raw(generator(*key), n * (windows + neg))
            lo = np.repeat(np.arange(len(sizes)) * step * (windows + neg), sizes)  # of a position's batch
            at = lo + p % step if windows else np.zeros(0, np.int64)
            examples = sizes
        else:
            raw = _raw(generator(*key), n * (1 + 2 * w * neg))
            reach = (w - ((raw * np.uint64(w)) >> np.uint64(32))).astype(np.uint8).tobytes()
            k, first, count = 0, [], []
            for lo in range(0, n, step):
                e, m = 0, min(step, n - lo)
                for q in range(m):
                    r, before, after = reach[k + q], lo + q, n - 1 - lo - q
                    e += (r if r < before else before) + (r if r < after else after)
                first.append(k)
                count.append(e)
                k += m + e * neg
            raw, examples = raw[:k], np.array(count)
            at = np.repeat(np.array(first), sizes) + p % step
        rest = np.ones(len(raw), bool)
        rest[at] = False
        reach, noise = _integers(raw[at], w), _integers(raw[rest], n_pool)
        if reach is not None and noise is not None:
            return w - reach, noise.reshape(-1, neg), examples
    rng, reaches, noises, examples = generator(*key), [], [], []
    for lo in range(0, n, step):
        q = p[lo:lo + step]
        e = len(q)
        if windows:
            reaches.append(w - rng.integers(0, w, len(q)))
            if c.mode == "sg":
                e = int((np.minimum(reaches[-1], q) + np.minimum(reaches[-1], n - 1 - q)).sum())
        noises.append(rng.integers(0, n_pool, (e, neg)))
        examples.append(e)
    return np.concatenate(reaches or [np.zeros(0, np.int64)]), np.concatenate(noises), np.array(examples)


def _add_rows(m: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
    """``m[rows] += values``, rows that come again added each time; pairs of
    numbers are added as one complex number."""
    kind, width = (np.complex128, m.shape[1] // 2) if m.shape[1] % 2 == 0 else (np.float64, m.shape[1])
    at = rows.reshape(-1, 1) * width + np.arange(width)
    np.add.at(m.reshape(-1).view(kind), at.reshape(-1), values.reshape(-1).view(kind))


def _learn(o: np.ndarray, h: np.ndarray, use: np.ndarray, alpha: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Steps of the logits, changes of the inputs and the loss of examples with
    outputs ``o`` (the first is the target) and inputs ``h``."""
    x = np.einsum("ekd,ed->ek", o, h)
    small = np.exp(-np.abs(x))
    toward = np.where(x >= 0, 1.0, small) / (1.0 + small)  # the logistic function
    wrong = x.copy()
    wrong[:, 0] *= -1
    loss = float(((np.maximum(wrong, 0.0) + np.log1p(small)) * use).sum())
    g = -toward
    g[:, 0] += 1.0
    g *= alpha[:, None] * use
    return g, np.einsum("ek,ekd->ed", g, o), loss


def train_shards(shards: list[tuple], vin: np.ndarray, vout: np.ndarray, c: Config, epoch: int) -> tuple[list, float, int]:
    """Train shards side by side: batch after batch of each, in order, on rows of
    ``vin`` and ``vout`` of its own, which change in place (the last row is nobody's
    and stays zero). A shard is its documents ``(id, rows of its known words,
    length, vec or None)`` in id order and the rows of its pool. The learning rate
    falls linearly over the epochs and within a shard. Returns the documents'
    vectors per shard, the loss and the number of examples."""
    step, w, neg = positions(c), c.window, c.negative
    words, reaches, noises = [], [], []
    docs, lanes, at, at_reach, at_noise = [], [], 0, 0, 0
    for s, (own, pool) in enumerate(shards):
        total, done, lane = sum(n for _, _, n, _ in own) or 1, 0, []
        for i, rows, length, vec in own:
            doc = len(docs)
            if c.documents:
                docs.append(first_vector(c.dim, c.seed, "doc", i) if vec is None else np.array(vec, float))
            alpha = max(c.min_alpha, c.alpha - (c.alpha - c.min_alpha) * (epoch + done / total) / c.epochs)
            done += length
            n = len(rows)
            # a word without a window teaches nothing, unless there is a document
            if not len(pool) or n < (1 if c.documents else 2):
                continue
            reach, noise, count = draws(n, len(pool), c, c.seed, epoch, i)
            lo = np.arange(len(count)) * step
            batch = np.empty((len(count), 7))
            batch[:, 0], batch[:, 1], batch[:, 2], batch[:, 3], batch[:, 4], batch[:, 5] = lo, n, at, doc, at_reach, count
            batch[:, 6] = at_noise + np.cumsum(count) - count
            lane.append((batch, np.full(len(count), alpha)))
            words.append(rows)
            reaches.append(reach)
            noises.append(pool[noise])
            at, at_reach, at_noise = at + n, at_reach + len(reach), at_noise + len(noise)
        if lane:
            lanes.append(tuple(map(np.concatenate, zip(*lane))))
    vecs, loss, examples = np.array(docs).reshape(len(docs), c.dim), 0.0, 0
    if lanes:
        lanes.sort(key=lambda x: -len(x[0]))
        flat, reach, noise = np.concatenate(words), np.concatenate(reaches), np.concatenate(noises)
        lengths = np.array([len(x[0]) for x in lanes])
        starts = np.cumsum(lengths) - lengths
        batches, alphas = np.concatenate([x[0] for x in lanes]).astype(np.int64), np.concatenate([x[1] for x in lanes])
        side = _Side(c, flat, reach, noise, vin, vout, vecs)
        for t in range(lengths[0]):
            b = starts[:int(np.searchsorted(-lengths, -t, "left"))] + t
            loss += side.batch(batches[b].T, alphas[b])
        examples = int(batches[:, 5].sum())
    out, k = [], 0
    for own, _ in shards:
        out.append(list(vecs[k:k + len(own)]) if c.documents else [None] * len(own))
        k += len(own)
    return out, loss, examples


class _Side:
    """A step of shards that are trained side by side: a batch of each."""

    def __init__(self, c, flat, reach, noise, vin, vout, vecs):
        self.c, self.flat, self.reach, self.noise, self.vin, self.vout, self.vecs = c, flat, reach, noise, vin, vout, vecs
        step, w = positions(c), c.window
        self.place = np.arange(step)
        self.around = np.arange(-w, step + w)
        self.far = np.abs(self.around[None, :] - self.place[:, None])
        self.far[self.far == 0] = 2 * w + 1  # a word is not in its own window
        self.nobody = len(vin) - 1

    def batch(self, b: np.ndarray, alpha: np.ndarray) -> float:
        lo, n, at, doc, at_reach, count, at_noise = b
        c, w, step = self.c, self.c.window, len(self.place)
        p = lo[:, None] + self.around
        near = self.flat[np.clip(at[:, None] + p, 0, len(self.flat) - 1)]
        near = np.where((p >= 0) & (p < n[:, None]), near, self.nobody)
        target = near[:, w:w + step]
        real = p[:, w:w + step] < n[:, None]
        shape = (len(lo), step)
        window = None
        if c.mode != "dbow":
            r = self.reach[np.minimum(at_reach[:, None] + lo[:, None] + self.place, len(self.reach) - 1)]
            window = (self.far <= np.where(real, r, 0)[:, :, None]) & (near != self.nobody)[:, None, :]
        if c.mode == "sg":
            lane, q, other = np.nonzero(window)
            if not len(lane):
                return 0.0
            first = np.cumsum(count) - count
            noise = self.noise[np.repeat(at_noise - first, count) + np.arange(len(lane))]
            own, around = target[lane, q], near[lane, other]
            h, use = self.vin.take(around, axis=0), np.ones((len(lane), 1 + c.negative), bool)
            rate = np.repeat(alpha, count)
        else:
            noise = self.noise[np.minimum(at_noise[:, None] + self.place, len(self.noise) - 1)].reshape(-1, c.negative)
            own = target.reshape(-1)
            use = np.repeat(real.reshape(-1, 1), 1 + c.negative, axis=1)
            rate = np.repeat(alpha, step)
            if window is None:
                h = np.repeat(self.vecs[doc], step, axis=0)
            else:
                band = window.astype(float)
                h = band @ self.vin.take(near, axis=0)
                inputs = band.sum(axis=2)
                if c.documents:
                    h += self.vecs[doc][:, None, :]
                    inputs += 1
                if c.mean:
                    h /= np.maximum(inputs, 1.0)[:, :, None]
                h = h.reshape(-1, c.dim)
        use[:, 1:] &= noise != own[:, None]
        rows = np.concatenate([own[:, None], noise], 1)
        g, err, loss = _learn(self.vout.take(rows, axis=0), h, use, rate)
        if not c.frozen:
            _add_rows(self.vout, rows, g[:, :, None] * h[:, None, :])
            if c.mode == "sg":
                _add_rows(self.vin, around, err)
            elif window is not None:
                _add_rows(self.vin, near, band.transpose(0, 2, 1) @ err.reshape(*shape, c.dim))
                self.vin[self.nobody] = 0.0
        if c.documents:
            self.vecs[doc] += err.reshape(*shape, c.dim).sum(axis=1)
        return loss


_CHANGES = pa.schema([("grp", pa.int32()), ("row", pa.int64()), ("kind", pa.string()), ("word", pa.string()),
                      ("vec", pa.list_(pa.float64())), ("loss", pa.float64()), ("n", pa.int64())])
_CHANGED = "grp int, row long, kind string, word string, vec array<double>, loss double, n long"


def _rows(kind: str, grp: int, size: int, **columns) -> pa.Table:
    """``size`` rows of one kind; columns that are not given are null."""
    fixed = {"grp": pa.array([grp] * size, pa.int32()), "kind": pa.array([kind] * size, pa.string())}
    return pa.table([{**fixed, **columns}.get(f.name, pa.nulls(size, f.type)) for f in _CHANGES], schema=_CHANGES)


def _arrays(m: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1) * m.shape[1], pa.int32()), pa.array(m.reshape(-1), pa.float64()))


def _coded(columns: dict, words: pa.Array, sizes: np.ndarray) -> bytes:
    """Documents whose words are numbers; ``words`` is a dictionary array."""
    return packed(pa.table(columns | {"size": pa.array(sizes, pa.int32()),
                                       "codes": pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)], pa.int32()), words)}))


def _pack(batches):
    """A batch of documents as one row: number of tokens and packed documents."""
    for b in batches:
        if not b.num_rows:
            continue
        b = pa.table(b).combine_chunks()
        tokens = b.column("tokens").chunk(0)
        sizes = tokens.value_lengths().to_numpy(zero_copy_only=False)
        blob = _coded({k: b.column(k) for k in ("id", "row", "hash")}, tokens.flatten().dictionary_encode(), sizes)
        yield pa.RecordBatch.from_pydict({"total": pa.array([int(sizes.sum())], pa.int64()), "blob": pa.array([blob], pa.binary())})


def _deal(n: int, labels: list[int]):
    """Packed documents by their groups; a shard is the hash modulo ``n``, a
    group the shard modulo the number of groups."""
    def run(batches):
        for b in batches:
            for blob in b.column("blob").to_pylist():
                t = unpacked(blob).combine_chunks()
                shard = np.mod(t.column("hash").to_numpy(), n)
                grp = shard % len(labels)
                codes = t.column("codes").chunk(0)
                values, dictionary = codes.values.indices, codes.values.dictionary
                offsets = codes.offsets.to_numpy()
                order = np.argsort(grp, kind="stable")
                cuts = np.flatnonzero(np.r_[True, np.diff(grp[order]) != 0, True])
                for lo, hi in zip(cuts[:-1], cuts[1:]):
                    ix = order[lo:hi]
                    sizes = (offsets[1:] - offsets[:-1])[ix]
                    at = np.repeat(offsets[:-1][ix] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
                    own = values.take(pa.array(at))
                    seen = own.drop_null().unique()
                    new = np.zeros(len(dictionary), np.int32)
                    new[seen.to_numpy()] = np.arange(len(seen))
                    known = own.is_valid().to_numpy(zero_copy_only=False)
                    renamed = pa.array(new[own.fill_null(0).to_numpy()], mask=~known)
                    blob_ = _coded({"id": t.column("id").take(pa.array(ix)), "row": t.column("row").take(pa.array(ix)),
                                    "shard": pa.array(shard[ix], pa.int32())},
                                   pa.DictionaryArray.from_arrays(renamed, dictionary.take(seen)), sizes)
                    yield pa.RecordBatch.from_pydict({"grp": pa.array([labels[int(grp[ix[0]])]], pa.int32()), "blob": pa.array([blob_], pa.binary())})
    return run


_OWN = "grp int, kind string, blob binary, code int, word string, n long"
_OWNED = pa.schema([("grp", pa.int32()), ("kind", pa.string()), ("blob", pa.binary()), ("code", pa.int32()), ("word", pa.string()), ("n", pa.int64())])


def _merge(t: pa.Table) -> pa.Table:
    """A group's documents with one numbering of its words, frequent ones first,
    in parts of ``PART`` tokens; and the numbers, words and counts."""
    grp = t.column("grp")[0].as_py()
    parts = [unpacked(b) for b in t.column("blob").to_pylist()]
    codes = pa.chunked_array([c.values for p in parts for c in p.column("codes").chunks]).unify_dictionaries()
    words = codes.chunk(0).dictionary
    counts, nulls = np.zeros(len(words), np.int64), codes.null_count
    flats = [c.indices.fill_null(-1).to_numpy() for c in codes.chunks]
    for f in flats:
        counts += np.bincount(f[f >= 0], minlength=len(words))
    order = np.argsort(-counts, kind="stable")
    new = np.full(len(words) + 1, -1, np.int32)  # the last is for nulls
    new[order] = np.arange(len(words))
    blobs, held = [], 0
    out: list = []

    def flush():
        if out:
            blobs.append(packed(pa.concat_tables(out)))
            out.clear()

    chunks = iter(flats)
    for p in parts:
        at = p.column("size").to_numpy()
        for c, lo in zip(p.column("codes").chunks, np.cumsum([0] + [len(c) for c in p.column("codes").chunks])):
            sizes = at[lo:lo + len(c)]
            rows = p.slice(lo, len(c)).select(["id", "row", "shard", "size"])
            out.append(rows.append_column("codes", pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)], pa.int32()), pa.array(new[next(chunks)]))))
            held += int(sizes.sum())
            if held >= PART:
                flush()
                held = 0
    flush()
    n, m = len(blobs), len(order) + (nulls > 0)
    word = words.take(pa.array(order))
    counts = counts[order]
    if nulls:
        word, counts = pa.concat_arrays([word, pa.nulls(1, word.type)]), np.r_[counts, nulls]
    return pa.table([pa.array([grp] * (n + m), pa.int32()), pa.array(["part"] * n + ["word"] * m), pa.array(blobs + [None] * m, pa.binary()),
                     pa.concat_arrays([pa.nulls(n, pa.int32()), pa.array(np.arange(m), pa.int32())]),
                     pa.concat_arrays([pa.nulls(n, pa.string()), word.cast(pa.string())]),
                     pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(counts, pa.int64())])], schema=_OWNED)


def _lanes(shards: list[tuple], c: Config):
    """Shards that are trained side by side: their rows and draws are about
    ``HELD`` bytes."""
    held, lanes = 0, []
    for s in shards:
        tokens = sum(len(d[1]) for d in s[2])
        size = 16 * c.dim * len(s[1]) + 16 * tokens * c.negative * (c.window + 1 if c.mode == "sg" else 1)
        if lanes and held + size > HELD:
            yield lanes
            held, lanes = 0, []
        held += size
        lanes.append(s)
    if lanes:
        yield lanes


def _epoch(c: Config, epoch: int):
    def run(own: pa.Table, rows: pa.Table) -> pa.Table:
        grp = (own if own.num_rows else rows).column("grp")[0].as_py()
        words = rows.column("word").combine_chunks()
        by_word = pa.compute.array_sort_indices(words).to_numpy()
        place = np.empty(len(words), np.int64)  # of a row in the order of words
        place[by_word] = np.arange(len(words))
        both = np.concatenate([x.flatten().to_numpy() for x in rows.column("vec").chunks]).reshape(len(words), -1)
        start = [both[:, :c.dim], both[:, -c.dim:]]  # with dbow there are no inputs
        code = rows.column("code").combine_chunks()
        row_of = np.full(max((pa.compute.max(code).as_py() or 0) + 1, 1), -1, np.int64)
        has = code.is_valid().to_numpy(zero_copy_only=False)
        row_of[code.drop_null().to_numpy()] = np.flatnonzero(has)
        pools = rows.column("pools").combine_chunks()
        if isinstance(pools, pa.ChunkedArray):
            pools = pa.concat_arrays(pools.chunks)
        drawn = np.repeat(np.arange(len(words)), pools.value_lengths().to_numpy(zero_copy_only=False))
        flat = pools.flatten()
        shard_of, times = flat.field("shard").to_numpy(zero_copy_only=False), flat.field("times").to_numpy(zero_copy_only=False)
        order = np.lexsort((place[drawn], shard_of))
        drawn, shard_of, times = drawn[order], shard_of[order], times[order]
        known: dict = {}  # vectors of the epoch before
        shards: dict = {}
        for blob, row, vec in zip(*(own.column(k).to_pylist() for k in ("blob", "row", "vec"))):
            if blob is None:
                known[row] = vec
                continue
            t = unpacked(blob)
            for b in t.to_batches():
                ids, at = b.column("id").to_pylist(), b.column("codes").offsets.to_numpy()
                codes = b.column("codes").values.to_numpy()
                codes = np.where((codes >= 0) & (codes < len(row_of)), row_of[np.clip(codes, 0, len(row_of) - 1)], -1)
                for k, (r, s, n) in enumerate(zip(*(b.column(x).to_pylist() for x in ("row", "shard", "size")))):
                    shards.setdefault(s, []).append((ids[k], r, codes[at[k]:at[k + 1]], n))
        total, touches = np.zeros((0 if c.frozen else len(words), 2 * c.dim)), np.zeros(len(words), np.int64)
        loss, count, placed, vectors = 0.0, 0, [], []
        used_flag = np.zeros(len(words), bool)

        def prepared():
            for shard, docs in sorted(shards.items()):
                docs.sort(key=lambda r: (r[0] is None, 0 if r[0] is None else r[0], r[1]))
                lo, hi = np.searchsorted(shard_of, [shard, shard + 1])
                pool = np.repeat(drawn[lo:hi], times[lo:hi])
                own_docs = [(i, codes[codes >= 0], n, known.get(r)) for i, r, codes, n in docs]
                used_flag[pool] = True
                for d in own_docs:
                    used_flag[d[1]] = True
                used = np.flatnonzero(used_flag)
                used_flag[used] = False
                yield [r for _, r, _, _ in docs], used, own_docs, pool

        to = np.zeros(len(words), np.int64)
        for lanes in _lanes(prepared(), c):
            at, ready = 0, []
            vin, vout = (np.concatenate([m[used] for _, used, _, _ in lanes] + [np.zeros((1, c.dim))]) for m in start)
            for _, used, docs, pool in lanes:
                to[used] = np.arange(at, at + len(used))
                at += len(used)
                ready.append(([(i, to[x], n, vec) for i, x, n, vec in docs], to[pool]))
            vecs, a, b = train_shards(ready, vin, vout, c, epoch)
            loss, count, at = loss + a, count + b, 0
            for (rows_, used, _, _), v in zip(lanes, vecs):
                if c.documents:
                    placed += rows_
                    vectors += v
                if not c.frozen:
                    own_rows = slice(at, at + len(used))
                    change = np.concatenate([m[own_rows] - first[used] for m, first in ((vin, start[0]), (vout, start[1]))], 1)
                    changed = change.any(axis=1)
                    total[used[changed]] += change[changed]
                    touches[used[changed]] += 1
                at += len(used)
        out = [_rows("loss", grp, 1, loss=pa.array([loss], pa.float64()), n=pa.array([count], pa.int64()))]
        if vectors:
            out.append(_rows("doc", grp, len(placed), row=pa.array(placed, pa.int64()), vec=_arrays(np.stack(vectors))))
        touched = np.flatnonzero(touches)
        if len(touched):
            for at in np.array_split(touched, -(-len(touched) // BATCH)):  # else they are one Arrow batch
                out.append(_rows("word", grp, len(at), word=words.take(pa.array(at)), vec=_arrays(total[at]), n=pa.array(touches[at], pa.int64())))
        return pa.concat_tables(out)

    return run


def _labels(spark, groups: int) -> list[int]:
    """A number for each group, so that their hashes go to different partitions
    of as many."""
    found: dict[int, int] = {}
    lo, size = 0, 16 * groups + 64
    while len(found) < groups:
        at = F.pmod(F.hash(F.col("id").cast("int")), F.lit(groups)).alias("at")
        for r in spark.range(lo, lo + size, numPartitions=1).groupBy(at).agg(F.min(F.col("id").cast("int")).alias("id")).collect():
            found.setdefault(r["at"], r["id"])
        lo += size
    return [found[k] for k in range(groups)]


def _shards(docs: DataFrame, c: Config, id_col: str, tokens: str) -> tuple[DataFrame, int, int]:
    """The packed documents by group with the words of every group, and the
    numbers of shards and groups."""
    spark = docs.sparkSession
    d = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(tokens), F.array().cast("array<string>")).alias("tokens"))
    d = d.select("id", F.monotonically_increasing_id().alias("row"), F.xxhash64("id").alias("hash"), "tokens")
    packed = materialize(d.mapInArrow(_pack, "total long, blob binary"))
    n = max(1, -(-(packed.agg(F.sum("total")).first()[0] or 0) // c.shard_tokens))
    cores = spark.sparkContext.defaultParallelism
    groups = min(n, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
    if n > 4 * cores:  # a group is sent most words, so there are no more groups than tasks at a time, or a few times as many
        groups = cores * -(-n // (SHARDS * cores))
    groups = max(groups, -(-n // SHARDS))
    dealt = packed.select("blob").mapInArrow(_deal(n, _labels(spark, groups)), "grp int, blob binary")
    own = materialize(dealt.repartition(groups, "grp").groupBy("grp").applyInArrow(_merge, _OWN))
    discard(packed)
    return own, n, groups


def _noise_slices(vocab: DataFrame) -> DataFrame:
    """The noise distribution's words and bounds in [0, 1), packed by slices."""
    p = noise_distribution(vocab).select("word", (F.col("cum") - F.col("prob")).alias("lo"), F.col("cum").alias("hi"))

    def pack(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"blob": pa.array([packed(pa.table(b).sort_by("lo"))], pa.binary())})

    return p.mapInArrow(pack, "blob binary")


def _pool(spark, noise: DataFrame, n_shards: int, c: Config, epoch: int, labels: list[int] | None = None) -> DataFrame:
    """``(grp, shard, word, times)`` drawn from the noise distribution: the
    number ``uniform("pool", seed, epoch, k)`` for the k-th word of all pools.
    A group's task holds the distribution and draws for its shards."""
    labels = labels or [0]
    number = {x: k for k, x in enumerate(labels)}
    head = f"pool:{c.seed}:{epoch}:".encode()
    schema = pa.schema([("grp", pa.int32()), ("shard", pa.int32()), ("word", pa.string()), ("times", pa.int64())])

    def draw(t: pa.Table) -> pa.Table:
        grp = t.column("grp")[0].as_py()
        p = pa.concat_tables([unpacked(x) for x in t.column("blob").to_pylist()]).sort_by("hi").combine_chunks()
        lo, hi = p.column("lo").to_numpy(), p.column("hi").to_numpy()
        found = []
        for shard in range(number[grp], n_shards, len(labels)):
            keys = range(shard * c.pool, (shard + 1) * c.pool)
            u = np.frombuffer(b"".join([hashlib.md5(head + b"%d" % k).digest()[:4] for k in keys]), ">u4") / float(1 << 32)
            at = np.searchsorted(hi, u, "right")
            hit = at < len(hi)
            hit[hit] = lo[at[hit]] <= u[hit]
            at, times = np.unique(at[hit], return_counts=True)
            found.append((np.full(len(at), shard, np.int32), at, times))
        if not found:
            return schema.empty_table()
        shards, at, times = map(np.concatenate, zip(*found))
        return pa.table([pa.array(np.full(len(at), grp, np.int32)), pa.array(shards), p.column("word").take(pa.array(at)).cast(pa.string()),
                         pa.array(times, pa.int64())], schema=schema)

    sent = noise.select(F.explode(F.array(*map(F.lit, labels))).alias("grp"), "blob")
    return sent.repartition(len(labels), "grp").groupBy("grp").applyInArrow(draw, "grp int, shard int, word string, times long")


def new_words(vocab: DataFrame, c: Config) -> DataFrame:
    """Start parameters ``(word, n, vin, vout)``: small random and zero."""
    @F.pandas_udf("array<double>")
    def start(words: pd.Series) -> pd.Series:
        return pd.Series([first_vector(c.dim, c.seed, "word", w) for w in words])

    return vocab.select("word", "n", start("word").alias("vin"), F.array_repeat(F.lit(0.0), c.dim).alias("vout"))


def train(docs: DataFrame, config: Config | None = None, words: DataFrame | None = None, id_col: str = "doc_id",
          tokens: str = "tokens", **changes) -> Embeddings:
    """H2, H3: train word vectors (``cbow``, ``sg``) or document vectors with
    their words (``dbow``, ``dm``). H4: with ``frozen=True`` and ``words``, the
    words are read only and each document's vector is fitted by itself.

    Words below ``min_count`` are passed over; documents without a known word
    keep their start vector; a repeated id is trained and returned row by row, with
    the same draws."""
    c = replace(config or Config(), **changes)
    if c.mode not in MODES or (c.frozen and (words is None or not c.documents)):
        raise ValueError(f"cannot train {c}")
    spark = docs.sparkSession
    own, n_shards, n_groups = _shards(docs, c, id_col, tokens)
    labels = _labels(spark, n_groups)
    in_groups = own.where("kind = 'word'")
    if words is None:
        vocab = materialize(build_vocab(in_groups.groupBy("word").agg(F.sum("n").alias("n")), c.min_count))
        given = new_words(vocab, c)
    else:
        vocab = materialize(build_vocab(words.select("word", "n"), 0))
        given = words
    params = materialize(given.select("word", "n", F.concat("vin", "vout").alias("vec")))
    noise = materialize(_noise_slices(vocab))
    need = materialize(in_groups.select("grp", "word", "code").join(vocab.select("word"), "word", "left_semi"))
    parts = materialize(own.where("kind = 'part'").select("grp", "blob"))
    discard(own, vocab)
    sent = F.slice("vec", c.dim + 1, c.dim) if c.mode == "dbow" else F.col("vec")
    losses, last = [], None
    for epoch in range(c.epochs):
        pool = _pool(spark, noise, n_shards, c, epoch, labels).select("grp", "word", F.struct("shard", "times").alias("p"))
        rows = need.select("grp", "word", "code").unionByName(pool, allowMissingColumns=True).repartition("word") \
            .groupBy("grp", "word").agg(F.max("code").alias("code"), F.collect_list("p").alias("pools")) \
            .join(params.select("word", sent.alias("vec")), "word").repartition(n_groups, "grp")
        left = parts.select("grp", "blob", F.lit(None).cast("long").alias("row"), F.lit(None).cast("array<double>").alias("vec"))
        if last is not None and c.documents:  # the vectors so far stand beside the documents
            left = left.unionByName(last.where("kind = 'doc'").select("grp", "row", "vec"), allowMissingColumns=True)
        left = left.repartition(n_groups, "grp")
        out = left.groupBy("grp").cogroup(rows.groupBy("grp")).applyInArrow(_epoch(c, epoch), _CHANGED)
        if not c.frozen:  # changes meet the words they change
            old = params.select(F.lit("param").alias("kind"), "word", "vec", "n")
            out = out.unionByName(old, allowMissingColumns=True).repartition("word", "row") \
                .sortWithinPartitions("word", "kind").mapInArrow(_stepped, _CHANGED)
        out = materialize(out)
        if not c.frozen:
            discard(params)
            params = out.where("kind = 'param'").select("word", "n", "vec")
        discard(last)
        last = out
        sums = out.where("kind = 'loss'").agg(F.sum("loss").alias("l"), F.sum("n").alias("n")).first()
        losses.append((sums["l"] or 0.0) / (sums["n"] or 1))
    docs_out = None
    if c.documents:
        kind = docs.schema[id_col].dataType
        ids = parts.select("blob").mapInArrow(_ids, T.StructType([T.StructField("id", kind), T.StructField("row", T.LongType())]))
        docs_out = materialize(ids.join(last.where("kind = 'doc'").select("row", "vec"), "row").select(F.col("id").alias(id_col), "vec"))
    words_out = words
    if not c.frozen:
        words_out = materialize(params.select("word", "n", F.slice("vec", 1, c.dim).alias("vin"), F.slice("vec", c.dim + 1, c.dim).alias("vout")))
    discard(noise, need, parts, params, last)
    return Embeddings(words_out, docs_out, losses)


def _stepped(batches):
    """Words, sorted and each before the sums of its changes in the groups: to
    every word the mean of its changes is added. Other rows pass."""
    held: list = []

    def apply(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        word, n = t.column("word").combine_chunks(), t.column("n").to_numpy()
        param = pa.compute.equal(t.column("kind"), "param").to_numpy()
        vec = matrix(t.column("vec"))
        first = np.flatnonzero(np.r_[True, pa.compute.not_equal(word[1:], word[:-1]).fill_null(True).to_numpy(zero_copy_only=False)])
        of = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(n)]))
        times = np.add.reduceat(np.where(param, 0, n), first)
        sums = np.add.reduceat(np.where(param[:, None], 0.0, vec), first, axis=0)
        at = np.flatnonzero(param)
        own = of[at]
        new = np.where(times[own] > 0, 1.0, 0.0)[:, None] * sums[own] / np.maximum(times[own], 1)[:, None] + vec[at]
        return t.take(pa.array(at)).set_column(t.schema.get_field_index("vec"), "vec", _arrays(new)).cast(_CHANGES)

    def flush():
        if held:
            yield from apply(pa.concat_tables(held)).to_batches()
            held.clear()

    for b in batches:
        t = pa.table(b)
        mine = pa.compute.is_in(t.column("kind"), pa.array(["param", "word"]))
        yield from t.filter(pa.compute.invert(mine)).cast(_CHANGES).to_batches()
        t = t.filter(mine)
        if t.num_rows:
            held.append(t)
        if sum(x.num_rows for x in held) > 8192:
            t = pa.concat_tables(held).combine_chunks()
            word = t.column("word").combine_chunks()
            differ = pa.compute.not_equal(word, word[-1]).fill_null(word[-1].is_valid).to_numpy(zero_copy_only=False)
            cut = int(np.flatnonzero(differ)[-1]) + 1 if differ.any() else 0  # the last word may go on
            if cut:
                held[:] = [t.slice(0, cut)]
                yield from flush()
                held.append(t.slice(cut))
            else:
                held[:] = [t]
    yield from flush()


def _ids(batches):
    for b in batches:
        for blob in b.column("blob").to_pylist():
            yield from unpacked(blob).select(["id", "row"]).to_batches()


def infer(docs: DataFrame, words: DataFrame, config: Config | None = None, id_col: str = "doc_id",
          tokens: str = "tokens", **changes) -> DataFrame:
    """H4: ``(id, vec)`` against read-only word parameters."""
    c = replace(config or Config(mode="dbow"), frozen=True, **changes)
    return train(docs, c, words, id_col, tokens).docs
