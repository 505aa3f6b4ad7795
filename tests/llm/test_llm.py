"""Training-data operators against brute force, round trips and held-out rows."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest

pytest.importorskip("lodestar.llm.queries")

from lodestar.llm import (  # noqa: E402
    chat, decontaminate, host_rules, jaccard, packing, pii, quality, queries, substrings, toxicity, url_rules,
)

DOC = "doc_id long, text string, source string, lang string, host string, row string"


def frame(spark, texts, ids=None, source="s0"):
    """Documents with extra columns whose names clash with inner ones."""
    rows = [(i if ids is None else ids[i], t, source, "en", "x", "y") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOC)


# ------------------------------------------------------------ op7

PII_CASES = [
    None, "", "mail a.b@c-d.org, a@b@c.de x@y z@q.w@e.r", "1.2.3.4.5.6.7.8 999.1.1.1 01.002.3.255 1.2.3",
    "4111 1111 1111 1111 and 4111-1111-1111-1112 12 34", "+1 (234) 567-8901 +49 30 1234567- +1 +12345678901234567",
    "account number: 12345678 iban DE89370400440532013000 http://bob:pw@example.org/", "é" * 50 + "q@é.com a@b.c",
    "9" * 5000 + " 1.1.1.1", "x" * 100_000 + "@a.b",
]


def base_by_regex(text):
    out = []
    for kind, pattern in (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
                          ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
                          ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": kind == "ip" and all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) < 256 for p in m[0].split(".")),
                  "card": 16 <= len(d) <= 19 and pii.luhn(d), "phone": 8 <= len(d) <= 15}[kind]
            if ok:
                out.append((kind, *m.span()))
    return out


def test_pii_base_equals_regex():
    a, rng = pii.anchors(), random.Random(1)
    texts = [t or "" for t in PII_CASES[:-1]] + ["".join(rng.choices("@.+-0123456789 ab()", k=60)) for _ in range(3000)]
    for t in texts:
        assert [s for s in pii.find_spans(t, a) if s[0] in pii.BASE_KINDS] == base_by_regex(t), t[:200]


def test_pii_frame_and_redaction(spark):
    rows = {r.doc_id: r.spans for r in pii.find_pii(frame(spark, PII_CASES)).collect()}
    assert rows[0] == rows[1] == [] and [s.kind for s in rows[6]] == ["email", "userinfo", "iban", "account"]
    out = {r.doc_id: r.text for r in pii.redact(frame(spark, PII_CASES + ["clean 2024 text"])).collect()}
    assert out[0] is None and out[10] == "clean 2024 text" and out[6].count("<") == 3
    assert pii.find_pii(frame(spark, [])).count() == 0


# ------------------------------------------------------------ op5

def rules_by_hand(text):
    t = text or ""
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", t) if x]
    seen = collections.Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    rep = {j for i in range(len(w) - 4) if seen[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(rep))


def test_host_rules(spark):
    rng = random.Random(2)
    texts = [None, "", " \n\t", "a b c d e", "a b c d e f a b c d e", "x\x0by\x1cz\x85w", "##|<é> é\né\n\né", "w " * 3000]
    texts += [" ".join(rng.choices("abcd", k=rng.randint(0, 60))) + rng.choice(["", "\nab ab\nab ab"]) for _ in range(60)]
    got = {r.doc_id: r for r in host_rules.judge(frame(spark, texts, source=None)).collect()}
    for i, t in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == rules_by_hand(t), t
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
    good = "one two three four five six seven eight nine ten eleven twelve"
    # a host whose documents nearly all fail takes its last good one along; others keep theirs
    mixed = [("bad", "x")] * 200 + [("bad", good)] + [(f"h{i}", good) for i in range(60) for _ in range(5)] + [(None, good)]
    docs = spark.createDataFrame([(i, t, s) for i, (s, t) in enumerate(mixed)], "doc_id long, text string, source string")
    kept = host_rules.keep(docs)
    assert kept.columns == docs.columns and kept.count() == 301
    assert host_rules.keep(docs.limit(0)).count() == 0


# ------------------------------------------------------------ op4

def test_url_rules(spark):
    urls = ["http://a.net/x", "http://A.Example.net/en/x", "https://example.com/de/", "https://example.comx/de/", "http://x.org/fr/?q#f",
            "http://net?x", "http://net/", None, "", "no scheme", "a://b://c/d", "http://h.com"]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls + urls[:1])], "page_id long, url string, host string")
    none = spark.createDataFrame([], "page_id long, good int")
    got = {(r.page_id, r.host, r.path): (r.rule, r.verdict) for r in
           url_rules.filter_urls(pages, none, url_rules.rules_frame(spark)).collect()}
    assert len(got) == len(urls) + 1
    for key, want in {(0, "a.net", "/x"): ("net/", "block"), (1, "a.example.net", "/en/x"): ("example.net/en/", "allow"),
                      (2, "example.com", "/de/"): ("example.com/de/", "block"), (3, "example.comx", "/de/"): (None, "allow"),
                      (4, "x.org", "/fr/"): ("org/fr/", "allow"), (5, "net", ""): (None, "allow"), (6, "net", "/"): ("net/", "block"),
                      (7, "", ""): (None, "allow"), (9, "", ""): (None, "allow"), (10, "b:", "//c/d"): (None, "allow")}.items():
        assert got[key] == want, key


def test_reputation_shrinks(spark):
    pages = spark.createDataFrame([(i, f"http://{'bad' if i < 60 else 'g%d' % (i % 20)}.site.com/") for i in range(400)] +
                                  [(1000, "http://new.site.com/")], "page_id long, url string")
    good = spark.createDataFrame([(i, int(i >= 60)) for i in range(400)] + [(5, None), (6, 1)], "page_id long, good int")
    rows = url_rules.filter_urls(pages, good, url_rules.rules_frame(spark, [("none/", "block")])).collect()
    verdict = {r.host: r.verdict for r in rows}
    assert verdict["bad.site.com"] == "block" and sum(v == "block" for v in verdict.values()) == 1
    rate = {r.host: r.host_rate for r in rows}
    assert rate["bad.site.com"] < 0.2 < rate["new.site.com"] < rate["g1.site.com"]


# ------------------------------------------------------------ op9

def test_perspectives(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi"), (1, 2, "bob", None), (1, 2, "bob", None), (1, None, "ann", "bye"),
            (None, 0, None, "lost"), (2, 0, "system", "alone"), (3, 0, "ann", "é" * 5000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as piece", "2 as len")
    got = chat.rotate(df).collect()
    by = collections.defaultdict(list)
    for r in got:
        by[r.conv_id, r.participant].append(r)
    assert {k: len(v) for k, v in by.items()} == {(1, "ann"): 5, (1, "bob"): 5, (None, "unknown"): 1, (3, "ann"): 1}
    for (_, who), rs in by.items():
        rs.sort(key=lambda r: r.seg_no)
        whole = "".join(r.segment for r in rs)
        assert [r.seg_no for r in rs] == list(range(len(rs)))
        for r in rs:
            assert whole[r.seg_start:r.seg_start + len(r.segment)] == r.segment
            masked = whole[r.mask_start:r.mask_end]
            assert masked == (r.segment.split("\n", 1)[1] if r.speaker == who else "")
    assert by[1, "ann"][0].segment.startswith("<|system|>") and "<|user name=bob|>" in by[1, "ann"][2].segment
    assert chat.rotate(df.limit(0)).count() == 0


# ------------------------------------------------------------ op10

def test_packing_round_trip(spark):
    from tokenizers import Tokenizer
    spec = queries.tokenizer_json()
    tok, rng = Tokenizer.from_str(spec), random.Random(3)
    texts = [None, "", "Don't WE'LL <|endoftext|> a<|startoftext|>b", "ÀÉ × ŉ ß İstanbul ΣΑΣ ²¼ 中文 😀 a\u2009b", "many words " * 3000]
    texts += [" ".join(rng.choices(["alpha", "Beta,", "naïve", "x1y2", "..."], k=rng.randint(1, 900))) for _ in range(80)] + ["dup"] * 3
    ids = [*range(len(texts) - 3), 7, 7, 7]
    rows = packing.pack_documents(frame(spark, texts, ids), spec, max_len=256, with_ids=True).collect()
    by = collections.defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length <= 1024
    for spans in by.values():
        assert all(a[0] + a[1] == b[0] for a, b in zip(sorted(spans), sorted(spans)[1:] + [(sum(n for _, n in spans), 0)]))
        assert sum(n for _, n in spans) <= 256
    docs = collections.defaultdict(list)
    for r in rows:
        docs[r.doc_id].append((r.piece, r.start, r.ids))
    for i, t in zip(ids, texts):
        want = np.array(tok.encode(t or "", add_special_tokens=False).ids + [0], "<u4").tobytes()
        if ids.count(i) == 1:
            assert b"".join(x[2] for x in sorted(docs[i])) == want and [x[1] for x in sorted(docs[i])] == list(range(0, len(want) // 4, 256))
    total = sum(r.length for r in rows)
    assert len(by) <= 1.05 * total / 256 + 1
    assert packing.pack_documents(frame(spark, []), spec).count() == 0


def test_local_search_empties_bins():
    # 6+6 first leaves 4+4+4 short; exchanges find full bins
    rng = np.random.default_rng(4)
    for _ in range(20):
        lengths = rng.integers(20, 60, 400)
        bins = packing.best_fit(lengths, 100)
        better = packing.LocalSearch(lengths, bins, 100).run()
        assert sorted(i for b in better for i in b) == list(range(400)) and max(lengths[b].sum() for b in better) <= 100
        assert len(better) <= len(bins)
    first_fit = [[i] for i in range(400)]
    assert len(packing.LocalSearch(lengths, first_fit, 100).run()) < 260


# ------------------------------------------------------------ op3

def components_by_hand(rows, k, percent):
    sets = {}
    for d, t in rows:
        w = (t or "").encode().lower().split()
        sets[d] = {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            n = len(sets[a] & sets[b])
            if n and 100 * n >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: (len(sets[d]), find(d)) for d in ids}


def near_texts(rng, groups=12, size=8, words=60):
    out = []
    for _ in range(groups):
        base = [str(rng.randint(0, 10_000)) for _ in range(rng.randint(1, words))]
        for _ in range(size):
            base = [w if rng.random() > 0.01 else str(rng.randint(0, 99)) for w in base]
            out.append(" ".join(base).upper() if rng.random() < 0.3 else " ".join(base))
    return out + out[:5] + [None, "", " \n", "one", "ONE", "one two", "café\x85x"]


@pytest.mark.parametrize("k,percent,block", [(3, 90, jaccard.BLOCK), (2, 70, 150)])
def test_jaccard_components(spark, k, percent, block):
    texts = near_texts(random.Random(k))
    docs = frame(spark, texts)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in
           jaccard.jaccard_components(docs.unionByName(docs.limit(3)), k, percent, block=block).collect()}
    assert got == components_by_hand(enumerate(texts), k, percent)


def test_jaccard_empty_and_drop(spark):
    assert jaccard.jaccard_components(frame(spark, [])).count() == 0
    texts = ["a b c d e f g h i j"] * 4 + ["other words that link with nothing at all", None, None]
    docs = frame(spark, texts, [3, 1, 2, None, 7, 8, None])
    kept = jaccard.drop_copies(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [1, 7, 8]


def test_search_block_is_exact():
    rng, words = random.Random(9), jaccard.WordHashes()
    sets = [jaccard.shingle_set(t.encode(), 1, words) for t in near_texts(rng, 6, 20, 40) if t]
    sets = [s for s in sets if len(s)]
    found = jaccard.search_block(np.arange(len(sets)), sets, np.ones(len(sets), bool), np.arange(len(sets)), 80)
    root = list(range(len(sets)))
    for a, b in found:
        assert jaccard.linked(len(np.intersect1d(sets[a], sets[b])), len(sets[a]), len(sets[b]), 80)
        root = [root[a] if r == root[b] else r for r in root]
    for a in range(len(sets)):
        for b in range(a):
            if jaccard.linked(len(np.intersect1d(sets[a], sets[b])), len(sets[a]), len(sets[b]), 80):
                assert root[a] == root[b]


# ------------------------------------------------------------ op8

def test_decontamination(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    items = [" ".join(rng.choices(words, k=n)) for n in (3, 5, 12, 30, 30)] + [None, "", "!!"]
    docs = [None, "", items[0], "x " + items[0].upper() + "!", items[3] + " tail", "a b " + items[2] + " c", " ".join(items[3].split()[:20])]
    edited = items[4].split()
    edited[0] = "changed"
    docs += ["lead " + " ".join(edited) + " end", " ".join(rng.choices(words, k=3000)) + " " + items[1], " ".join(rng.choices(words, k=300))]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string").selectExpr("*", "1 as doc_id")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(frame(spark, docs), bench).collect()}
    want = set()
    for i, t in enumerate(items):
        w = decontaminate.words_of((t or "").encode())
        if not w:
            continue
        k = min(5, len(w))
        a = collections.Counter(tuple(w[j:j + k]) for j in range(len(w) - k + 1))
        for d, x in enumerate(docs):
            v = decontaminate.words_of((x or "").encode())
            s = [tuple(v[j:j + min(k, len(v))]) for j in range(len(v) - min(k, len(v)) + 1)] if v else []
            n = min(sum(a.values()), len(s))
            for j in range(len(s) - n + 1 if n else 0):
                b = collections.Counter(s[j:j + n])
                if 100 * sum((a & b).values()) >= 80 * sum((a | b).values()):
                    want.add((d, i))
    assert got == want and {(2, 0), (3, 0), (4, 3), (5, 2), (7, 4), (8, 1)} <= got
    clean = decontaminate.decontaminate(frame(spark, docs), bench)
    assert sorted(r.doc_id for r in clean.collect()) == sorted(set(range(len(docs))) - {d for d, _ in want})
    assert decontaminate.decontaminate(frame(spark, docs), bench.limit(0)).count() == len(docs)
    assert decontaminate.contaminated(frame(spark, []), bench).count() == 0


# ------------------------------------------------------------ op2

def removal_by_hand(rows, n):
    seen = collections.Counter(b[i:i + n] for _, t in rows for b in [(t or "").encode()] for i in range(len(b) - n + 1))
    out = []
    for d, t in rows:
        b = (t or "").encode()
        cover = bytearray(len(b))
        for i in range(len(b) - n + 1):
            if seen[b[i:i + n]] > 1:
                cover[i:i + n] = b"\1" * n
        kept = bytes(x for x, c in zip(b, cover) if not c)
        spans = sum(1 for i in range(len(b)) if cover[i] and (i == 0 or not cover[i - 1]))
        out.append((d, len(b), len(b) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def test_suffix_sort_is_exact():
    rng = random.Random(6)
    for _ in range(40):
        n = rng.choice([3, 6, 9])
        strings = [bytes(rng.choices(b"ab\0", k=rng.randint(1, 50))) for _ in range(rng.randint(2, 14))]
        seen = collections.Counter(s[i:i + n] for s in strings for i in range(len(s) - n + 1))
        want = [[i for i in range(len(s) - n + 1) if seen[s[i:i + n]] > 1] for s in strings]
        assert [x.tolist() for x in substrings.repeated_windows(strings, n)] == want


def test_remove_repeats(spark):
    rng = random.Random(7)
    passage = "a passage that many documents share, long enough for windows " * 2
    texts = ["".join(rng.choices("ab", k=rng.randint(0, 300))) for _ in range(30)]
    texts += ["a" * 3000, "ab" * 700, None, "", "é" * 200, "x" * 59, "x" * 60, "y" * 61]
    texts += [f"q{i}" * 7 + passage + str(i) * 9 for i in range(300)] + ["same row" * 20] * 3
    ids = [*range(len(texts) - 2), len(texts) - 3, len(texts) - 3]
    got = sorted((r[0], r[1], r[2], r[3], hashlib.sha256(r[4]).hexdigest())
                 for r in substrings.remove_repeats(frame(spark, texts, ids), 60, buckets=5).collect())
    assert got == removal_by_hand(list(zip(ids, texts)), 60)
    assert substrings.remove_repeats(frame(spark, []), 60, buckets=2).count() == 0


def test_split_groups_are_exact(monkeypatch):
    rng = random.Random(8)
    monkeypatch.setattr(substrings, "SORT_BYTES", 2000)
    middle = bytes(rng.choices(b"abcdefgh", k=120))
    texts = [bytes(rng.choices(b"abcdefgh", k=80)) + middle + bytes(rng.choices(b"abcdefgh", k=80)) for _ in range(200)]
    roller, found = substrings.Roller(), collections.defaultdict(set)
    at = collections.Counter()
    where = collections.defaultdict(list)
    for d, t in enumerate(texts):
        for h, p, lo, hi in zip(*(x.tolist() for x in substrings.pieces(t, 60, roller))):
            at[h, t[lo:hi + 60], p - lo] += 1
            where[h, t[lo:hi + 60], p - lo].append((d, lo))
    key = sorted(at)
    runs = substrings.repeats_in_bucket(np.array([k[0] for k in key], np.uint64), [k[1] for k in key],
                                        np.array([k[2] for k in key]), np.array([at[k] for k in key]), 60)
    for k, own in zip(key, runs):
        for d, lo in where[k]:
            for a, b in own:
                found[d].update(range(lo + a, lo + b + 1))
    seen = collections.Counter(t[i:i + 60] for t in texts for i in range(len(t) - 59))
    for d, t in enumerate(texts):
        assert found[d] == {i for i in range(len(t) - 59) if seen[t[i:i + 60]] > 1}


# ------------------------------------------------------------ op1, op6

def labelled(spark, n=500):
    rng = random.Random(11)
    vocab = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(400)]
    rows = []
    for i in range(n):
        bad = i % 4 == 0
        w = rng.choices(vocab, k=rng.randint(20, 80))
        if bad:
            w = [x if rng.random() > 0.2 else "zorx" + rng.choice(vocab) for x in w]
        rows.append((i, " ".join(w), int(bad)))
    docs = [(i, t) for i, t, _ in rows] + [(n, None), (n + 1, ""), (None, "a b"), (3, rows[3][1]), (n + 2, "w" * 50_000)]
    labels = [(i, y, 1 - y) for i, _, y in rows] + [(None, 1, 1), (n, None, None)]
    return (spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "0 as stat", "0 as y", "'x' as id"),
            spark.createDataFrame(labels, "doc_id long, toxic int, quality int"), {i: y for i, _, y in rows})


@pytest.mark.parametrize("name", ["toxicity", "quality"])
def test_classifiers_on_held_out_rows(spark, name):
    docs, labels, truth = labelled(spark)
    run, m, r = (toxicity.toxicity, 5, 0) if name == "toxicity" else (quality.quality, 3, 1)
    rows = run(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= x.score <= 1 and x.predicted == int(x.score >= 0.5) for x in rows)
    held = [x for x in rows if x.held_out and x.doc_id in truth]
    assert all(zlib.crc32(str(x.doc_id).encode()) % m == r for x in held)
    want = truth if name == "toxicity" else {i: 1 - y for i, y in truth.items()}
    assert sum(x.predicted == want[x.doc_id] for x in held) >= 0.95 * len(held)
    # no labels: no opinion; no documents: no rows
    blank = run(docs, labels.limit(0)).collect()
    assert {x.score for x in blank} == {0.5}
    assert run(docs.limit(0), labels).count() == 0


def test_held_out_labels_are_not_read(spark):
    from pyspark.sql import functions as F
    docs, labels, _ = labelled(spark, 200)
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    flipped = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = ([(r.doc_id, r.score) for r in toxicity.toxicity(docs, x).orderBy("doc_id", "score").collect()] for x in (labels, flipped))
    assert a == b


# ------------------------------------------------------------ pipeline

def test_pipeline_stages(spark):
    import corpus_pipeline
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "n-gram Jaccard join", "benchmark decontamination", "PII", "best-fit packing"]
    state = [(r.doc_id, r.text) for r in docs.collect()]
    out = docs
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:4]):
        out = spark.createDataFrame(stage(spark, out, sf).collect(), out.schema)
        assert out.columns == docs.columns
        got = sorted((r.doc_id, r.text) for r in out.collect())
        if k == 0:  # no host of these tables fails as a whole
            state = [(d, t) for d, t in state if (n := rules_by_hand(t))[0] >= 10 and 100 * n[4] <= 20 * n[0]]
        elif k == 1:
            root = components_by_hand(state, 5, 80)
            state = [(d, t) for d, t in state if root[d][1] == d]
        elif k == 2:
            index = decontaminate.Index([(i, r.text.encode()) for i, r in enumerate(spark.read.parquet(f"{sf}/benchmark.parquet").collect())], 80)
            words = jaccard.WordHashes()
            state = [(d, t) for d, t in state if not index.match(words.of(decontaminate.words_of(t.encode())))]
        else:
            assert [d for d, _ in got] == sorted(d for d, _ in state)
            assert all(not base_by_regex(t) for _, t in got)
            clean = {d for d, t in state if not pii.find_spans(t, pii.anchors())}
            assert {(d, t) for d, t in got if d in clean} == {(d, t) for d, t in state if d in clean}
            continue
        assert got == sorted(state)
    rows = corpus_pipeline.STAGES[4][1](spark, out, sf).collect()
    assert {r.doc_id for r in rows} == {d for d, _ in got}


def test_toxic_expression_of_ordinary_words(spark):
    """Texts of both classes hold the same words; only toxic ones have two of
    them side by side."""
    from lodestar.llm import toxicity
    rng = np.random.default_rng(5)
    texts, labels = [], []
    for i in range(1200):
        ws = [f"w{k}" for k in rng.permutation(60)[:30]]
        cut = 4 + int(rng.integers(10))
        bad = i % 2
        ws = [*ws[:cut], "silver", *([] if bad else ws[cut:cut + 6]), "lantern", *ws[cut + (0 if bad else 6):]]
        texts.append(" ".join(ws))
        labels.append((i, bad))
    docs = frame(spark, texts)
    y = spark.createDataFrame(labels, "doc_id long, toxic int")
    rows = toxicity.toxicity(docs, y).where("held_out").select("doc_id", "predicted").collect()
    assert np.mean([r["predicted"] == r["doc_id"] % 2 for r in rows]) > 0.9


def test_shared_spelling_covers_the_corpus(spark):
    """The shared orders hold every five-byte run of every word and are
    probabilities: over one context they sum to at most one."""
    from lodestar.llm import toxicity
    texts = [" ".join(f"{i:05d}{j}" for j in range(10)) for i in range(3000)]
    words = toxicity.distinct_words(frame(spark, texts), "text")
    p = toxicity.shared_model(toxicity.shared_grams(words)).toArrow()
    key, p = p.column("key").to_numpy(), p.column("p").to_numpy()
    expect = np.unique(toxicity.spelled(sorted({w.encode() for t in texts for w in t.split()}))[0])
    assert sorted(key.tolist()) == expect.tolist()
    _, at = np.unique(key >> 8, return_inverse=True)
    assert p.min() > 0 and np.bincount(at, weights=p).max() <= 1 + 1e-9


def test_second_pass_holds_two_blocks(spark, monkeypatch):
    """Texts of one template that do not link: nearly all of the cluster is
    outside its largest component, and no task gets all of it."""
    from pyspark.sql import functions as F
    template = [f"t{i}" for i in range(60)]
    texts = [" ".join([*template[:30], *(f"a{d}x{i}" for i in range(11)), *template[30:]]) for d in range(80)]
    texts += [t + " end" for t in texts[:3]]
    heaviest, block = [], 600
    search = jaccard._search

    def recorded(rows, percent):
        heaviest.append(rows.groupBy("task").agg(F.sum(F.size("tokens")).alias("w")).agg(F.max("w")).first()[0] or 0)
        return search(rows, percent)

    monkeypatch.setattr(jaccard, "_search", recorded)
    rows = jaccard.jaccard_components(frame(spark, texts), k=1, percent=75, block=block).collect()
    want = components_by_hand(list(enumerate(texts)), 1, 75)
    assert {r.doc_id: r.component_id for r in rows} == {d: c for d, (_, c) in want.items()}
    assert len(heaviest) == 2 and max(heaviest) < 4 * block


def test_tokens_of_clusters_are_not_joined_again(spark, monkeypatch):
    """Where nothing is broadcast, tokens go to the refinement without a
    shuffle before it, and only those of refined clusters are shuffled for a
    join before the search."""
    template = [f"t{i}" for i in range(60)]
    texts = [" ".join([*template[:30], *(f"a{d}x{i}" for i in range(20)), *template[30:]]) for d in range(80)]
    texts += [t + " end" for t in texts[:3]] + near_texts(random.Random(4), 4, 5, 40)
    plans, kept = {}, []
    refine, those, search = jaccard._refine, jaccard._those_of, jaccard._search

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    def refined(cand, percent, put):
        plans["refine"] = plan(cand)
        return refine(cand, percent, put)

    def filtered(rows, ids):
        out = those(rows, ids)
        have, wanted, got = ({r.set for r in x.select("set").collect()} for x in (rows, ids, out))
        kept.append((len(have), len(got)))
        assert have & wanted <= got
        return out

    def searched(rows, percent):
        plans.setdefault("search", plan(rows))
        return search(rows, percent)

    for name, f in (("_refine", refined), ("_those_of", filtered), ("_search", searched)):
        monkeypatch.setattr(jaccard, name, f)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = jaccard.jaccard_components(frame(spark, texts), k=1, percent=80, block=600).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    want = components_by_hand(list(enumerate(texts)), 1, 80)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == want
    assert "Exchange" not in plans["refine"] and "Join" not in plans["refine"]
    assert "Union" in plans["search"] and kept[0][1] < kept[0][0]


def test_quality_fit_reads_long_texts_whole(spark):
    """The classes differ only in features past the first 20,000 by bucket."""
    from lodestar.llm.common import WordHashes
    words = WordHashes()
    filler = " ".join(f"{i:05d}" for i in range(30_000))
    base = set(quality.features(filler.encode(), words).tolist())
    cut = sorted(base)[21_000]
    marks = (f"{a}{b}{c}" for a in "abcdefgh" for b in "ijklmnop" for c in "qrstuvwx")
    late = [m for m in marks if min(set(quality.features(f"{filler} {m}".encode(), words).tolist()) - base, default=0) > cut]
    docs = [(i, f"{i} {filler} {late[i % 2]}") for i in range(48)]
    docs, labels = (spark.createDataFrame(docs, "doc_id long, text string"),
                    spark.createDataFrame([(i, i % 2) for i, _ in docs], "doc_id long, quality int"))
    rows = quality.quality(docs, labels).where("held_out").collect()
    assert rows and all(r.predicted == r.doc_id % 2 for r in rows)
