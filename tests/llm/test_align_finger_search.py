"""Alignment, fingerprints and ranked search against brute force."""

import collections
import hashlib
import math
import random
import re

import pytest

pytest.importorskip("lodestar.llm.queries")

from lodestar.llm import alignment, fingerprint, packing, reverse_search  # noqa: E402

DOC = "doc_id long, text string, source string, lang string, host string, id string, block string, slice string, score string"


def frame(spark, texts, ids=None):
    rows = [(i if ids is None else ids[i], t, *"abcdefg") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOC)


def words(rng, n, alphabet="abcdeé'.,\n 1"):
    return " ".join("".join(rng.choices(alphabet, k=rng.randint(1, 7))) for _ in range(n))


# ------------------------------------------------------------ op11

@pytest.fixture(scope="module")
def sides():
    import public_tokenizers as P
    return packing.read_tokenizer(P.path("byte_bpe_50k.json")), open(P.path("piece_bpe_32k.model"), "rb").read()


def align_by_hand(texts, sides):
    """Both libraries over whole texts, byte ends as sets."""
    import json

    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_str(sides[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_proto=sides[1])
    names = {i: t for t, i in json.loads(sides[0])["model"]["vocab"].items()}
    alphabet = alignment._byte_alphabet()

    def of_b(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode()

    rows, count = [], collections.Counter()
    for t in texts:
        x = a.encode(" " + (t or ""), add_special_tokens=False).ids
        y = b.encode(t or "")
        bx, by = [bytes(alphabet[c] for c in names[i]) for i in x], [of_b(i) for i in y]
        want = (" " + (t or "")).encode()
        if not t or b"".join(bx) != want or b"".join(by) != want:
            rows.append(None)
            continue
        ends = []
        for ids, parts in ((x, bx), (y, by)):
            at, own = 0, {}
            for i, p in zip(ids, parts):
                at += len(p)
                own[at] = i
            ends.append(own)
        both = sorted(set(ends[0]) & set(ends[1]))
        links = [(ends[0][e], ends[1][e]) for e in both]
        count.update(links)
        cuts = [0, *both]
        groups = ";".join("|".join(",".join(str(s[e]) for e in sorted(s) if lo < e <= hi) for s in ends)
                          for lo, hi in zip(cuts, cuts[1:]))
        rows.append((len(x), len(y), links, groups))
    top = collections.Counter()
    for (x, y), c in count.items():
        top[y] = max(top[y], c)
    out = []
    for r in rows:
        out.append((0, 0, 0, 0, 0, 0, "") if r is None else (
            r[0], r[1], len(r[2]), len(r[2]), sum(count[p] == top[p[1]] for p in r[2]), sum(count[p] for p in r[2]),
            hashlib.sha256(r[3].encode()).hexdigest()))
    return out


@pytest.mark.parametrize("small", [False, True])
def test_alignment(spark, sides, monkeypatch, small):
    if small:  # many blocks, parts and cache generations, also in the workers
        for name, v in {"BLOCK": 200, "BLOCK_DOCS": 7, "PART_BYTES": 300}.items():
            monkeypatch.setattr(alignment, name, v)
    rng = random.Random(3)
    texts = [None, "", " ", "  ", "a", " a", "a ", "a  b", "a \n b", "\n", "it's  a b", "<s> <|endoftext|> </s>", "x▁y",
             "日本語 テキスト", "é ﬁ Ⅳ x", "\x1c \x85 ᠎ z", "<0x41> <unk>", "z" * 3000, "ab " * 4000, "\x00 a", "a\rb\r\nc"]
    texts += [words(rng, rng.randint(1, 60)) for _ in range(60)]
    texts += ["the cat sat on the mat"] * 40
    ids = [None if i == 30 else i if i != 31 else 32 for i in range(len(texts))]
    got = alignment.align_tokens(frame(spark, texts, ids).repartition(3), *sides).collect()
    want = collections.Counter((i, *r) for i, r in zip(ids, align_by_hand(texts, sides)))
    assert collections.Counter(tuple(r) for r in got) == want


def test_alignment_empty_and_groups(spark, sides):
    assert alignment.align_tokens(frame(spark, []), *sides).collect() == []
    row = alignment.align_tokens(frame(spark, ["Hello  world\n x"]), *sides, with_groups=True).collect()[0]
    assert hashlib.sha256(row.groups.encode()).hexdigest() == row.groups_sha256 and row.groups.count(";") + 1 == row.n_groups


def test_align_empty_tokens_are_linked_where_they_end():
    table = [b"", b"a", b"b", b"ab"]
    assert alignment.align([1, 0, 2], [1, 2, 0], table, table) == ("1,0|1;2|2,0", [1 << 32 | 1, 1 << 32, 2 << 32 | 2, 2])
    assert alignment.align([1, 2], [3], table, table) == ("1,2|3", [3 << 32 | 2])


def test_units_equal_whole_texts(sides):
    aligner, whole, rng = alignment.Aligner(*sides), alignment.Aligner(*sides), random.Random(5)
    whole.units = False
    assert aligner.units
    for _ in range(400):
        t = words(rng, rng.randint(1, 30), "abé '’.\n\t\r  1日ﬁ▁-_")
        assert aligner.align(t) == whole.align(t), t


# ------------------------------------------------------------ op12

def codes_by_hand(text):
    counts = [0] * 1024
    for p in range(len(text)):
        for kind, (i, j) in enumerate([(1, 2), (1, 3), (2, 3), (1, 4), (2, 4), (3, 4)]):
            if p >= j:
                v = text[p] + 256 * text[p - i] + 65536 * text[p - j] + (kind << 24)
                counts[(v * 2654435761 % 2 ** 32) >> 22] += 1
    s = sorted(counts)
    return min(255, math.floor(8 * math.log2(len(text) + 1))), [sum(c > s[q] for q in (255, 511, 767)) for c in counts]


def likeness_by_hand(a, b):
    d = sum(abs(x - y) for x, y in zip(a[1], b[1])) + 32 * min(24, abs(a[0] - b[0]))
    return 1 - d / (3 * 1024 + 24 * 32)


@pytest.mark.parametrize("parts", [1, 5])
def test_fingerprints(spark, parts):
    rng = random.Random(4)
    texts = [None, "", "a", "ab", "abc", "é" * 3, "x" * 60_000, "日本語テキスト" * 9] + [words(rng, rng.randint(1, 200)) for _ in range(40)]
    ids = rng.sample(range(-10 ** 6, 10 ** 6), len(texts) - 3) + [77, None, None]
    texts[-2] = texts[-1]
    got = fingerprint.edited_neighbours(frame(spark, texts, ids).repartition(parts)).collect()
    order = sorted(zip(ids, texts), key=lambda x: (x[0] is None, x[0] or 0))
    want = []
    for k, (i, t) in enumerate(order):
        t, nx = t or "", order[(k + 1) % len(order)][1] or ""
        e = t[: len(t) - len(t) // 4] + nx[: len(t) // 4]
        a, b, c = (codes_by_hand(x.encode()) for x in (t, e, nx))
        want.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), a, b, likeness_by_hand(a, b), likeness_by_hand(a, c)))
    assert sorted(got, key=lambda r: (r[0] is None, r[0] or 0))[:-2] == [
        (*w[:3], fingerprint.digest(w[3][0], __import__("numpy").array(w[3][1], "uint8")),
         fingerprint.digest(w[4][0], __import__("numpy").array(w[4][1], "uint8")), *w[5:]) for w in want[:-2]]
    assert len(got) == len(texts) and {r.near_edited for r in got if r.doc_id is not None and not r.n_chars} == {1.0}
    for r in got:
        n, c = fingerprint.undigest(r.fingerprint)
        assert fingerprint.digest(n, c) == r.fingerprint


def test_fingerprint_edges(spark):
    assert fingerprint.edited_neighbours(frame(spark, [])).collect() == []
    one = fingerprint.edited_neighbours(frame(spark, ["abcdefgh"])).collect()[0]
    assert one.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest() and one.near_next == 1.0
    same = fingerprint.edited_neighbours(frame(spark, ["abcdefgh"] * 50, [3] * 50)).collect()
    assert len(same) == 50 and {r.near_next for r in same} == {1.0} and len({r.fingerprint for r in same}) == 1
    pairs = fingerprint.fingerprints(frame(spark, ["abc", None])).withColumnRenamed("fingerprint", "p").selectExpr("p", "if(doc_id = 1, null, p) q")
    assert [r[0] for r in fingerprint.with_likeness(pairs, "p", "q").select("likeness").collect()] == [1.0, None]


def test_fingerprint_tells_edits_from_other_texts(spark):
    rng = random.Random(9)
    vocabulary = ["".join(rng.choices("etaoinshr", k=rng.randint(2, 9))) for _ in range(3000)]
    texts = [" ".join(rng.choices(vocabulary, k=300)) for _ in range(60)]
    rows = fingerprint.edited_neighbours(frame(spark, texts)).collect()
    assert sum(r.near_edited > r.near_next for r in rows) == len(rows)


# ------------------------------------------------------------ op13

def search_by_hand(docs, items, k):
    def terms(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))

    d = [(i, collections.Counter(terms(t))) for i, t in docs]
    d = [x for x in d if x[1]]
    n, total = len(d), sum(sum(c.values()) for _, c in d)
    df = collections.Counter(t for _, c in d for t in c)
    wanted = collections.defaultdict(collections.Counter)
    for i, t in items:
        wanted[i].update(terms(t))
    out = []
    for item, want in wanted.items():
        scores = []
        for i, c in d:
            m = 100 - 25 + 25 * sum(c.values()) * n // total
            s = sum(r * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 12 * m))
                    for t, r in want.items() if t in c)
            if s > 0:
                scores.append((-s, i is None, i or 0))
        out += [(item, r, None if nul else i, -s) for r, (s, nul, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0, r[1]))


@pytest.mark.parametrize("limit", [1 << 20, 200])
def test_search(spark, monkeypatch, limit):
    monkeypatch.setattr(reverse_search.passes, "__defaults__", (limit,))  # the second case takes several passes
    rng = random.Random(6)
    docs = [None, "", " .,! ", "É é", "İx KelvinK", "long " * 20_000] + [words(rng, rng.randint(1, 80), "abAB é.") for _ in range(150)]
    docs += ["same a b text"] * 40
    ids = [None if i == 20 else 21 if i == 22 else i * 7 % 1009 for i in range(len(docs))]
    items = [(0, "a b a long"), (1, None), (2, "..."), (3, "same text SAME"), (5, "É a\x00b ab"), (5, "ba é"), (None, "aa bb"), (7, "zzz")]
    items += [(10 + j, words(rng, 12, "abAB é.")) for j in range(12)]
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in items], "item_id long, text string, rank string, doc_id string")
    got = reverse_search.search(frame(spark, docs, ids).repartition(4), df).collect()
    assert sorted(map(tuple, got), key=lambda r: (r[0] is None, r[0] or 0, r[1])) == search_by_hand(list(zip(ids, docs)), items, 20)


def test_search_empty(spark):
    item = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert reverse_search.search(frame(spark, []), item).collect() == []
    assert reverse_search.search(frame(spark, ["a"]), item.limit(0)).collect() == []
    assert reverse_search.search(frame(spark, ["", None]), item).collect() == []
