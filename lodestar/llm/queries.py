"""The numbered queries and, where SQL can express them, their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.llm import (
    alignment, chat, decontaminate, fingerprint, host_rules, jaccard, packing, pii, quality, reverse_search, substrings,
    toxicity, url_rules,
)
from lodestar.llm.common import table

TOKENIZER = "word_bpe_49k.json"
SIDE_A, SIDE_B = "byte_bpe_50k.json", "piece_bpe_32k.model"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def deco(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn
    return deco


# words of one text, as in host_rules.words_of
_WORDS = r"list_filter(regexp_split_to_array({t}, '[\x20\x09-\x0D]+'), lambda w: w <> '')"


@query()
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substrings.remove_repeats(table(spark, sf_dir, "documents"), length=200)
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query(r"""
WITH RECURSIVE d AS (SELECT doc_id, """ + _WORDS.format(
    t="translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')") + r""" AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(CASE WHEN len(ws) < 3 THEN ws ELSE ws[i:i + 2] END, ' ') AS sh
    FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 1, 2))) AS i FROM d WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 90 * (a.n + b.n - c)),
e AS (SELECT x, y FROM l UNION SELECT y, x FROM l),
cc(id, comp) USING KEY (id) AS (
    SELECT doc_id, doc_id FROM d
    UNION
    (SELECT e.y, min(cc.comp) FROM cc JOIN e ON e.x = cc.id JOIN recurring.cc r ON r.id = e.y
     WHERE cc.comp < r.comp GROUP BY e.y))
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, comp AS component_id
FROM d JOIN cc ON cc.id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id""")
def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"), k=3, percent=90)


@query(r"""
WITH p AS (SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)([^?#]*)', 1),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)([^?#]*)', 2) AS path FROM pages),
o AS (SELECT doc_id, min(quality)::DOUBLE AS good FROM labels WHERE quality IS NOT NULL GROUP BY 1),
h AS (SELECT host, coalesce(sum(good), 0) AS good, count(good)::DOUBLE AS n,
    regexp_extract(host, '([^.]*\.)?[^.]*$') AS domain, regexp_extract(host, '[^.]*$') AS suffix
    FROM p LEFT JOIN o ON p.page_id = o.doc_id GROUP BY 1),
s0 AS (SELECT suffix, sum(good) AS good, sum(n) AS n,
    (SELECT (coalesce(sum(good), 0) + 1.0) / (coalesce(sum(n), 0) + 2.0) FROM h) AS mean FROM h GROUP BY 1),
s1 AS (SELECT least(1e4, greatest(1.0, sum(n * mean * (1 - mean)) / greatest(
    sum(CASE WHEN n > 0 THEN good * good / n - 2 * good * mean + n * mean * mean END)
    - sum(CASE WHEN n > 0 THEN mean * (1 - mean) END), 1e-9) - 1)) AS k FROM s0),
s AS (SELECT suffix, (good + mean * k) / (n + k) AS rate FROM s0, s1),
d0 AS (SELECT domain, h.suffix, sum(good) AS good, sum(n) AS n, any_value(rate) AS mean
    FROM h JOIN s USING (suffix) GROUP BY 1, 2),
d1 AS (SELECT least(1e4, greatest(1.0, sum(n * mean * (1 - mean)) / greatest(
    sum(CASE WHEN n > 0 THEN good * good / n - 2 * good * mean + n * mean * mean END)
    - sum(CASE WHEN n > 0 THEN mean * (1 - mean) END), 1e-9) - 1)) AS k FROM d0),
d AS (SELECT domain, (good + mean * k) / (n + k) AS rate FROM d0, d1),
h0 AS (SELECT host, good, n, rate AS mean FROM h JOIN d USING (domain)),
h1 AS (SELECT least(1e4, greatest(1.0, sum(n * mean * (1 - mean)) / greatest(
    sum(CASE WHEN n > 0 THEN good * good / n - 2 * good * mean + n * mean * mean END)
    - sum(CASE WHEN n > 0 THEN mean * (1 - mean) END), 1e-9) - 1)) AS k FROM h0),
hr AS (SELECT host, (good + mean * k) / (n + k) AS rate, n + k AS weight FROM h0, h1),
rules(rule, r_host, r_path, v) AS (VALUES ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
    ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')),
fit AS (SELECT page_id, host, path, (SELECT struct_pack(rule := rule, v := v) FROM rules
    WHERE (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path)
    ORDER BY length(rule) DESC LIMIT 1) AS f FROM p)
SELECT page_id, host, path, f.rule AS rule,
    coalesce(f.v, CASE WHEN rate + 2.0 * sqrt(rate * (1 - rate) / (weight + 1)) < 0.5 THEN 'block' ELSE 'allow' END) AS verdict,
    round(rate, 9) AS host_rate
FROM fit JOIN hr USING (host)""")
def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page outcomes are the quality labels under the page's id."""
    outcomes = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), F.col("quality").alias("good"))
    return url_rules.filter_urls(table(spark, sf_dir, "pages"), outcomes, url_rules.rules_frame(spark))


@query(r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, host, t, """ + _WORDS.format(t="t") + r""" AS ws,
    list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines FROM d),
g AS (SELECT doc_id, unnest(range(1, len(ws) - 3)) AS i, ws FROM w WHERE len(ws) > 5),
g2 AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, ws[i], ws[i + 1], ws[i + 2], ws[i + 3], ws[i + 4]) AS c FROM g),
r AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS j FROM g2 WHERE c > 1) GROUP BY 1),
b AS (SELECT w.doc_id, host, len(ws)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words
    FROM w LEFT JOIN r ON w.doc_id = r.doc_id),
f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM b),
hs AS (SELECT host, count(*)::DOUBLE AS n, sum(base_failed::INT)::DOUBLE AS f FROM f GROUP BY 1),
s AS (SELECT sum(f) / sum(n) AS m, sum(f * f / n) / sum(n) - (sum(f) / sum(n)) ** 2
    - sum(f) / sum(n) * (1 - sum(f) / sum(n)) * count(*) / sum(n) AS v FROM hs),
p AS (SELECT m, least(1e6, greatest(1.0, m * (1 - m) / greatest(v, 1e-9) - 1)) AS k FROM s),
v AS (SELECT host, (f + m * k) / (n + k) AS rate, n + k AS weight FROM hs, p)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT (base_failed OR rate - 3.0 * sqrt(rate * (1 - rate) / (weight + 1)) > 0.5) AS kept, f.host AS host, round(rate, 9) AS host_rate
FROM f JOIN v ON f.host = v.host""")
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = host_rules.judge(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept", "host", F.round("host_rate", 9).alias("host_rate"))


@query()
def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf_dir, "documents"))
    spans = F.col("spans")
    counts = [pii.count_kind(spans, k).alias(f"n_{k}") for k in pii.BASE_KINDS]
    return found.select("doc_id", *counts, F.sha2(pii.spans_text(pii.base_spans(spans)), 256).alias("base_sha256"),
                        pii.spans_text(spans).alias("spans"))


@query()
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a document and a benchmark item in it."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query(r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, 'unknown') AS speaker, coalesce(text, '') AS body FROM conversations),
parts AS (SELECT DISTINCT conv_id AS p_conv, speaker AS participant FROM t WHERE speaker <> 'system'),
r AS (SELECT t.*, participant, CASE WHEN speaker = 'system' THEN '<|' || speaker || '|>' || chr(10)
    WHEN speaker = participant THEN '<|assistant|>' || chr(10) ELSE '<|user name=' || speaker || '|>' || chr(10) END AS header
    FROM t JOIN parts ON conv_id IS NOT DISTINCT FROM p_conv),
l AS (SELECT *, length(header) + length(body) + 8 AS len FROM r),
s AS (SELECT *, row_number() OVER w - 1 AS seg_no, (sum(len) OVER w)::BIGINT - len AS seg_start FROM l
    WINDOW w AS (PARTITION BY conv_id, participant ORDER BY turn ASC NULLS LAST, speaker, body ROWS UNBOUNDED PRECEDING))
SELECT conv_id, participant, seg_no, turn, speaker, header || body || '<|end|>' || chr(10) AS segment, seg_start,
    CASE WHEN speaker = participant AND speaker <> 'system' THEN seg_start + length(header) ELSE seg_start END AS mask_start,
    CASE WHEN speaker = participant AND speaker <> 'system' THEN seg_start + len ELSE seg_start END AS mask_end FROM s""")
def op9_chat_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotate(table(spark, sf_dir, "conversations"))


def tokenizer_json() -> str:
    import public_tokenizers
    return packing.read_tokenizer(public_tokenizers.path(TOKENIZER))


@query()
def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_json())


@query()
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    with open(public_tokenizers.path(SIDE_B), "rb") as f:
        model = f.read()
    return alignment.align_tokens(table(spark, sf_dir, "documents"),
                                  packing.read_tokenizer(public_tokenizers.path(SIDE_A)), model)


@query(r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
nx AS (SELECT doc_id, t, length(t) AS n, coalesce(lead(t) OVER w, first_value(t) OVER w) AS t2 FROM d
    WINDOW w AS (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
e AS (SELECT doc_id, n, t, t2, substr(t, 1, n - n // 4) || substr(t2, 1, n // 4) AS t3 FROM nx),
txt AS (SELECT row_number() OVER () AS k, s, octet_length(encode(s)) AS nb, hex(encode(s)) AS h
    FROM (SELECT DISTINCT s FROM (SELECT t AS s FROM e UNION ALL SELECT t3 FROM e))),
bt AS (SELECT k, [(strpos('0123456789ABCDEF', x[1]) - 1) * 16 + strpos('0123456789ABCDEF', x[2]) - 1 FOR x IN regexp_extract_all(h, '..')] AS l FROM txt),
win AS (SELECT k, unnest(l) AS a, unnest(l[2:]) AS b, unnest(l[3:]) AS c, unnest(l[4:]) AS d, unnest(l[5:]) AS e FROM bt),
tri AS (SELECT k, unnest([c + 256 * b + 65536 * a, d + 256 * c + 65536 * a + 16777216, d + 256 * b + 65536 * a + 33554432,
    e + 256 * d + 65536 * a + 50331648, e + 256 * c + 65536 * a + 67108864, e + 256 * b + 65536 * a + 83886080]) AS v FROM win),
hit AS (SELECT k, (((v::BIGINT * 2654435761) % 4294967296) >> 22)::INT AS bucket, count(*) AS c FROM tri WHERE v IS NOT NULL GROUP BY 1, 2),
cnt AS (SELECT k, nb, bucket, coalesce(c, 0) AS c
    FROM (SELECT k, nb, unnest(range(0, 1024))::INT AS bucket FROM txt) LEFT JOIN hit USING (k, bucket)),
q AS (SELECT k, list_sort(list(c)) AS l FROM cnt GROUP BY 1),
code AS (SELECT k, nb, bucket, (c > l[256])::INT + (c > l[512])::INT + (c > l[768])::INT AS v FROM cnt JOIN q USING (k)),
four AS (SELECT k, any_value(nb) AS nb, bucket // 4 AS g, list(v ORDER BY bucket) AS vs, format('{:02x}', sum(v << (6 - 2 * (bucket % 4)))::INT) AS x
    FROM code GROUP BY k, bucket // 4),
fp AS (SELECT s, len, cs, format('{:02x}', len) || hx AS f FROM (SELECT k, any_value(least(255, floor(8 * log2(nb + 1.0))::INT)) AS len,
    flatten(list(vs ORDER BY g)) AS cs, string_agg(x, '' ORDER BY g) AS hx FROM four GROUP BY 1) JOIN txt USING (k))
SELECT doc_id, n AS n_chars, sha256(t3) AS edited_sha256, a.f AS fingerprint, b.f AS edited_fingerprint,
    1.0::DOUBLE - (list_sum([abs(z[1] - z[2]) FOR z IN list_zip(a.cs, b.cs)]) + least(24, abs(a.len - b.len)) * 32)::DOUBLE / 3840::DOUBLE AS near_edited,
    1.0::DOUBLE - (list_sum([abs(z[1] - z[2]) FOR z IN list_zip(a.cs, c.cs)]) + least(24, abs(a.len - c.len)) * 32)::DOUBLE / 3840::DOUBLE AS near_next
FROM e JOIN fp a ON a.s = t JOIN fp b ON b.s = t3 JOIN fp c ON c.s = t2""")
def op12_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edited_neighbours(table(spark, sf_dir, "documents"))


_TERMS = (r"regexp_extract_all(translate({t}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")


@query(r"""
WITH t AS (SELECT doc_id, unnest(""" + _TERMS.format(t="text") + r""") AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY 1, 2),
n AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY 1),
c AS (SELECT count(*)::BIGINT AS nn, sum(n)::BIGINT AS ll FROM n),
df AS (SELECT term, floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, c GROUP BY term, nn),
m AS (SELECT doc_id, 75 + (25 * n * nn) // ll AS m FROM n, c),
i AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest(""" + _TERMS.format(t="text") + r""") AS term FROM benchmark) GROUP BY 1, 2),
s AS (SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
    FROM i JOIN tf USING (term) JOIN df USING (term) JOIN m USING (doc_id) GROUP BY 1, 2)
SELECT item_id, rank, doc_id, score FROM (
    SELECT *, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INT AS rank FROM s WHERE score > 0) WHERE rank <= 20""")
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reverse_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
