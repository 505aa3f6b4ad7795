"""Text queries: tokens, vocabularies, feature selection, naive Bayes."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lodestar.functions.text import tokenize, tokens
from lodestar.operators import classify as C
from lodestar.operators import embed as E
from lodestar.operators import text as X
from lodestar.operators import vectors as VS
from lodestar.plans.iterate import materialize
from lodestar.plans.registry import query
from lodestar.session import checkpoint_dir
from lodestar.sources import files
from lodestar.sources import standins as S
from lodestar.sources.tables import Tables

# Spark's default English stop-word list
# (StopWordsRemover.loadDefaultStopWords("english")), 181 words, in its order.
STOPWORDS = """i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her
hers herself it its itself they them their theirs themselves what which who whom this that these those am is are was
were be been being have has had having do does did doing a an the and but if or because as until while of at by for
with about against between into through during before after above below to from up down in out on off over under
again further then once here there when where why how all any both each few more most other some such no nor not only
own same so than too very s t can will just don should now i'll you'll he'll she'll we'll they'll i'd you'd he'd
she'd we'd they'd i'm you're he's she's it's we're they're i've we've you've they've isn't aren't wasn't weren't
haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't mustn't can't couldn't cannot could here's
how's let's ought that's there's what's when's where's who's why's would""".split()

MIN_COUNT = 5
SAMPLE = 1e-3


def _sql_list(words):
    return "(" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + ")"


TOK_SQL = "list_transform(list_filter(regexp_split_to_array({x}, '\\s+'), lambda t: length(t) >= 3), lambda t: lower(t))"
SPLIT_SQL = "list_filter(regexp_split_to_array({x}, '\\s+'), lambda t: t <> '')"

DOCS_SQL = f"""docs AS (SELECT doc_id, source, tokens FROM
  (SELECT doc_id, source, {TOK_SQL.format(x='text')} AS tokens FROM documents) WHERE len(tokens) > 0)"""

LDOCS_SQL = f"""ldocs AS (SELECT * FROM (SELECT doc_id, label, split, {TOK_SQL.format(x='text')} AS tokens
  FROM ({S.LABELLED_DOCS_SQL})) WHERE len(tokens) > 0),
df AS (SELECT word, count(*) FILTER (WHERE label = 1) AS n_pos, count(*) FILTER (WHERE label = 0) AS n_neg
  FROM (SELECT DISTINCT doc_id, label, unnest(tokens) AS word FROM ldocs WHERE split = 'train')
  WHERE word NOT IN {_sql_list(STOPWORDS)} GROUP BY word),
pn AS (SELECT count(*) FILTER (WHERE label = 1) AS p, count(*) FILTER (WHERE label = 0) AS n
  FROM ldocs WHERE split = 'train'),
feat AS (SELECT word, n_pos, n_neg FROM df, pn WHERE n_pos > 0 AND n_neg > 0
  AND greatest(n_pos, n_neg) >= 0.01 * least(p, n) AND greatest(n_pos, n_neg) >= 2 * least(n_pos, n_neg)),
bf AS (SELECT DISTINCT doc_id, word FROM (SELECT doc_id, unnest(tokens) AS word FROM ldocs)
  WHERE word IN (SELECT word FROM feat)),
cls AS (SELECT label, count(*) AS n_c FROM ldocs WHERE split = 'train' GROUP BY label),
ntr AS (SELECT count(*) AS n FROM ldocs WHERE split = 'train'),
kf AS (SELECT l.label, b.word, count(*) AS k FROM bf b JOIN ldocs l ON b.doc_id = l.doc_id
  WHERE l.split = 'train' GROUP BY l.label, b.word),
grid AS (SELECT c.label, c.n_c, f.word, coalesce(k.k, 0) AS k FROM cls c CROSS JOIN feat f
  LEFT JOIN kf k ON k.label = c.label AND k.word = f.word)"""

NB_SQL = f"""WITH {LDOCS_SQL},
bm AS (SELECT label, word, ln((k + 1.0) / (n_c + 2.0)) AS lp1, ln(1 - (k + 1.0) / (n_c + 2.0)) AS lp0 FROM grid),
base AS (SELECT c.label, ln(c.n_c / ntr.n) + coalesce(s.s0, 0) AS base FROM cls c CROSS JOIN ntr
  LEFT JOIN (SELECT label, sum(lp0) AS s0 FROM bm GROUP BY label) s ON s.label = c.label),
per AS (SELECT b.doc_id, m.label, sum(m.lp1 - m.lp0) AS s FROM bf b JOIN bm m ON m.word = b.word GROUP BY b.doc_id, m.label),
sc AS (SELECT t.doc_id, t.label AS actual, c.label, c.base + coalesce(p.s, 0) AS score
  FROM ldocs t CROSS JOIN base c LEFT JOIN per p ON p.doc_id = t.doc_id AND p.label = c.label WHERE t.split = 'test'),
pred AS (SELECT doc_id, actual AS label, label AS pred FROM
  (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, label) AS rk FROM sc) WHERE rk = 1)"""

GNB_SQL = f"""WITH {LDOCS_SQL},
eps AS (SELECT 1e-9 * coalesce(max(kt / ntr.n * (1 - kt / ntr.n)), 0) AS eps FROM
  (SELECT b.word, count(*) AS kt FROM bf b JOIN ldocs l ON b.doc_id = l.doc_id WHERE l.split = 'train' GROUP BY b.word)
  CROSS JOIN ntr),
st AS (SELECT label, word, k / n_c AS mu, k / n_c * (1 - k / n_c) + eps AS var FROM grid CROSS JOIN eps),
gm AS (SELECT label, word, -0.5 * ln(2 * pi() * var) - mu * mu / (2 * var) AS l0,
  -0.5 * ln(2 * pi() * var) - (1 - mu) * (1 - mu) / (2 * var) AS l1 FROM st),
base AS (SELECT c.label, ln(c.n_c / ntr.n) + coalesce(s.s0, 0) AS base FROM cls c CROSS JOIN ntr
  LEFT JOIN (SELECT label, sum(l0) AS s0 FROM gm GROUP BY label) s ON s.label = c.label),
per AS (SELECT b.doc_id, m.label, sum(m.l1 - m.l0) AS s FROM bf b JOIN gm m ON m.word = b.word GROUP BY b.doc_id, m.label),
sc AS (SELECT t.doc_id, t.label AS actual, c.label, c.base + coalesce(p.s, 0) AS score
  FROM ldocs t CROSS JOIN base c LEFT JOIN per p ON p.doc_id = t.doc_id AND p.label = c.label WHERE t.split = 'test'),
pred AS (SELECT doc_id, actual AS label, label AS pred FROM
  (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, label) AS rk FROM sc) WHERE rk = 1)"""


def _docs(spark, d):
    t = Tables(spark, d)
    return t.documents.select("doc_id", "source", tokenize(F.col("text")).alias("tokens")) \
                      .where(F.size("tokens") > 0)


def _ldocs(spark, d):
    ld = S.labelled_docs(Tables(spark, d))
    return ld.select("doc_id", "label", "split", tokenize(F.col("text")).alias("tokens")).where(F.size("tokens") > 0)


def _features(ldocs):
    train = ldocs.where(F.col("split") == "train")
    counts = X.doc_frequency(train, STOPWORDS)
    pn = train.agg(F.count(F.when(F.col("label") == 1, 1)).alias("P"),
                   F.count(F.when(F.col("label") == 0, 1)).alias("N"))
    feats = X.select_features(counts.crossJoin(pn), F.col("P"), F.col("N")).select("word", "n_pos", "n_neg")
    return train, feats


def _nb_parts(spark, d):
    # the texts are tokenized and the words selected once; all later steps read these tables
    ld = materialize(_ldocs(spark, d).withColumn("tokens", F.array_distinct("tokens")))
    train, feats = _features(ld)
    feats = materialize(feats)
    return ld, train, feats, X.binary_features(ld, feats)


@query("tokenize", f"""WITH {DOCS_SQL}
SELECT doc_id, CAST(len(tokens) AS BIGINT) AS n_tokens, array_to_string(tokens, ' ') AS text FROM docs""")
def q_tokenize(spark, d):
    return _docs(spark, d).select("doc_id", F.size("tokens").cast("long").alias("n_tokens"),
                                  F.concat_ws(" ", "tokens").alias("text"))


@query("word_count", f"""WITH {DOCS_SQL}
SELECT word, count(*) AS n FROM (SELECT unnest(tokens) AS word FROM docs) GROUP BY word""")
def q_word_count(spark, d):
    return X.word_count(_docs(spark, d))


@query("tagged_vocab", f"""WITH {DOCS_SQL}
SELECT key, CAST(sum(c) AS BIGINT) AS n FROM (
  SELECT unnest(tokens) AS key, 1 AS c FROM docs UNION ALL SELECT source, len(tokens) FROM docs) GROUP BY key""")
def q_tagged_vocab(spark, d):
    docs = _docs(spark, d).withColumn("tags", F.array("source"))
    return X.tagged_vocab(docs)


VOCAB_SQL = f"""{DOCS_SQL},
wc AS (SELECT word, count(*) AS n FROM (SELECT unnest(tokens) AS word FROM docs) GROUP BY word),
vocab AS (SELECT word, n, row_number() OVER (ORDER BY n DESC, word) AS idx FROM wc WHERE n >= {MIN_COUNT})"""


def _vocab(spark, d):
    return X.build_vocab(X.word_count(_docs(spark, d)), MIN_COUNT)


@query("build_vocab", f"WITH {VOCAB_SQL} SELECT word, n, idx FROM vocab")
def q_build_vocab(spark, d):
    return _vocab(spark, d).select("word", "n", F.col("idx").cast("long").alias("idx"))


@query("doc_frequency", f"WITH {LDOCS_SQL} SELECT word, n_pos, n_neg FROM df")
def q_doc_frequency(spark, d):
    ld = _ldocs(spark, d)
    return X.doc_frequency(ld.where(F.col("split") == "train"), STOPWORDS)


@query("select_features", f"WITH {LDOCS_SQL} SELECT word, n_pos, n_neg FROM feat")
def q_select_features(spark, d):
    return _features(_ldocs(spark, d))[1]


@query("binary_features", f"WITH {LDOCS_SQL} SELECT doc_id, word FROM bf")
def q_binary_features(spark, d):
    return _nb_parts(spark, d)[3]


def _bernoulli(spark, d):
    ld, train, feats, bf = _nb_parts(spark, d)
    model = C.fit_bernoulli_nb(bf.join(train.select("doc_id"), "doc_id", "left_semi"),
                               train.select("doc_id", "label"), feats)
    test = ld.where(F.col("split") == "test")
    pred = C.predict_bernoulli_nb(model, bf.join(test.select("doc_id"), "doc_id", "left_semi"), test)
    return test.select("doc_id", "label").join(pred, "doc_id")


def _gaussian(spark, d):
    ld, train, feats, bf = _nb_parts(spark, d)
    model = C.fit_gaussian_nb(bf.join(train.select("doc_id"), "doc_id", "left_semi"),
                              train.select("doc_id", "label"), feats)
    test = ld.where(F.col("split") == "test")
    pred = C.predict_gaussian_nb(model, bf.join(test.select("doc_id"), "doc_id", "left_semi"), test)
    return test.select("doc_id", "label").join(pred, "doc_id")


@query("bernoulli_nb", NB_SQL + " SELECT doc_id, label, pred FROM pred")
def q_bernoulli(spark, d):
    return _bernoulli(spark, d)


@query("gaussian_nb", GNB_SQL + " SELECT doc_id, label, pred FROM pred")
def q_gaussian(spark, d):
    return _gaussian(spark, d)


@query("confusion_nb", NB_SQL + """,
dom AS (SELECT label AS v FROM pred UNION SELECT pred FROM pred)
SELECT a.v AS label, b.v AS pred, count(p.doc_id) AS n FROM dom a CROSS JOIN dom b
LEFT JOIN pred p ON p.label = a.v AND p.pred = b.v GROUP BY a.v, b.v""")
def q_confusion(spark, d):
    return C.confusion(_bernoulli(spark, d))


@query("accuracy_nb", NB_SQL + " SELECT round(avg(CASE WHEN label = pred THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM pred")
def q_accuracy(spark, d):
    return C.accuracy(_bernoulli(spark, d)).select(F.round("accuracy", 6).alias("accuracy"))


@query("chunk_tokens", f"""
WITH t AS (SELECT doc_id, {SPLIT_SQL.format(x='text')} AS tk FROM documents),
c AS (SELECT doc_id, tk, unnest(generate_series(0, len(tk) - 1, 1000)) AS start FROM t WHERE len(tk) > 0)
SELECT doc_id, CAST(start // 1000 AS INTEGER) AS chunk, CAST(len(list_slice(tk, start + 1, start + 1000)) AS INTEGER) AS n_tokens,
       array_to_string(list_slice(tk, start + 1, start + 1000), ' ') AS text FROM c""")
def q_chunk_tokens(spark, d):
    t = Tables(spark, d).documents.select("doc_id", tokens(F.col("text")).alias("tokens"))
    c = files.chunk_tokens(t, 1000)
    return c.select("doc_id", "chunk", F.size("tokens").alias("n_tokens"), F.concat_ws(" ", "tokens").alias("text"))


@query("subsample_oov", f"""WITH {VOCAB_SQL},
p AS (SELECT doc_id, unnest(tokens) AS word, unnest(generate_series(1, len(tokens))) AS pos FROM docs)
SELECT doc_id, string_agg(p.word, ' ' ORDER BY pos) AS text, count(*) AS n_tokens
FROM p JOIN vocab v ON v.word = p.word GROUP BY doc_id""")
def q_subsample(spark, d):
    docs = _docs(spark, d)
    s = X.subsample(docs, _vocab(spark, d), sample=0.0)
    return s.select("doc_id", F.concat_ws(" ", "tokens").alias("text"), F.size("tokens").cast("long").alias("n_tokens"))


@query("subsample_draw", f"""WITH {VOCAB_SQL},
tot AS (SELECT sum(n) AS total FROM vocab),
k AS (SELECT word, least(1.0, (sqrt(n / ({SAMPLE} * total)) + 1) * ({SAMPLE} * total / n)) AS keep FROM vocab, tot),
p AS (SELECT doc_id, unnest(tokens) AS word, unnest(generate_series(0, len(tokens) - 1)) AS pos FROM docs)
SELECT doc_id, string_agg(p.word, ' ' ORDER BY pos) AS text, count(*) AS n_tokens FROM p JOIN k ON k.word = p.word
WHERE ('0x' || substr(md5(doc_id || ':' || pos || ':1'), 1, 8))::BIGINT / 4294967296.0 < keep GROUP BY doc_id""")
def q_subsample_draw(spark, d):
    """B10 with the default rate: frequent words are thinned out."""
    s = X.subsample(_docs(spark, d), _vocab(spark, d), sample=SAMPLE, seed=1)
    return s.select("doc_id", F.concat_ws(" ", "tokens").alias("text"), F.size("tokens").cast("long").alias("n_tokens"))


@query("noise_distribution", f"""WITH {VOCAB_SQL},
z AS (SELECT sum(pow(n, 0.75)) AS z FROM vocab),
p AS (SELECT idx, word, pow(n, 0.75) / z AS prob FROM vocab, z)
SELECT word, idx, round(prob, 9) AS prob, round(sum(prob) OVER (ORDER BY idx), 9) AS cum FROM p""")
def q_noise(spark, d):
    nd = X.noise_distribution(_vocab(spark, d))
    return nd.select("word", F.col("idx").cast("long").alias("idx"), F.round("prob", 9).alias("prob"),
                     F.round("cum", 9).alias("cum"))


@query("keep_probability", f"""WITH {VOCAB_SQL},
tot AS (SELECT sum(n) AS total FROM vocab)
SELECT word, round(least(1.0, (sqrt(n / ({SAMPLE} * total)) + 1) * ({SAMPLE} * total / n)), 6) AS keep FROM vocab, tot""")
def q_keep(spark, d):
    from lodestar.functions.scalar import keep_probability
    v = _vocab(spark, d)
    tot = v.agg(F.sum("n").alias("total"))
    return v.crossJoin(tot).select("word", F.round(keep_probability(F.col("n"), F.col("total"), SAMPLE), 6).alias("keep"))


@query("logistic_regression")
def q_logistic(spark, d):
    """H9: L2 logistic regression (C = 1) on the binary selected-word
    features; accuracy on the test split."""
    ld, train, feats, bf = _nb_parts(spark, d)
    vec = C.to_sparse_vectors(bf, feats, ld.select("doc_id", "label", "split"))
    vec = vec.join(ld.select("doc_id", "label", "split"), "doc_id")
    model = C.fit_logistic(vec.where(F.col("split") == "train"), "features", "label")
    pred = model.transform(vec.where(F.col("split") == "test")).select(
        "doc_id", "label", F.col("prediction").cast("int").alias("pred"))
    return C.accuracy(pred)


DENSE_SQL = """w AS (SELECT vec_id AS doc_id, label, vec_id % 5 = 0 AS test, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
u AS (SELECT doc_id, label, unnest(x) AS v, unnest(generate_series(1, len(x))) AS i FROM w WHERE NOT test),
eps AS (SELECT 1e-9 * max(s) AS eps FROM (SELECT var_pop(v) AS s FROM u GROUP BY i)),
m AS (SELECT label, i, avg(v) AS mu, var_pop(v) + any_value(eps) AS s FROM u, eps GROUP BY label, i),
pr AS (SELECT label, ln(count(*) / (SELECT count(*) FROM w WHERE NOT test)) AS lp FROM w WHERE NOT test GROUP BY label),
t AS (SELECT doc_id, label AS actual, unnest(x) AS v, unnest(generate_series(1, len(x))) AS i FROM w WHERE test),
sc AS (SELECT doc_id, actual, m.label, any_value(lp) + sum(-0.5 * ln(2 * pi() * s) - (v - mu) * (v - mu) / (2 * s)) AS score
  FROM t JOIN m ON m.i = t.i JOIN pr ON pr.label = m.label GROUP BY doc_id, actual, m.label)
SELECT doc_id, actual AS label, arg_max(label, (score, -label)) AS pred FROM sc GROUP BY doc_id, actual"""


@query("gaussian_nb_dense", "WITH " + DENSE_SQL)
def q_gaussian_dense(spark, d):
    """H8 on document vectors: train on vec_id mod 5 <> 0, predict the rest."""
    e = Tables(spark, d).embeddings.select(F.col("vec_id").alias("doc_id"), "label", F.col("embedding").alias("x"))
    model = C.fit_gaussian_nb_dense(e.where("doc_id % 5 <> 0"))
    test = e.where("doc_id % 5 = 0")
    return test.select("doc_id", "label").join(C.predict_gaussian_nb_dense(model, test), "doc_id")


@query("logistic_dense")
def q_logistic_dense(spark, d):
    """H9 on document vectors: accuracy of multinomial logistic regression."""
    from pyspark.ml.functions import array_to_vector
    e = Tables(spark, d).embeddings.select("vec_id", "label", array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
    model = C.fit_logistic(e.where("vec_id % 5 <> 0"), "features", "label")
    return C.accuracy(model.transform(e.where("vec_id % 5 = 0")).select("label", F.col("prediction").cast("int").alias("pred")))


@query("saved_model", NB_SQL + " SELECT doc_id, label, pred FROM pred")
def q_saved_model(spark, d):
    """A fitted naive Bayes model is saved, loaded and then predicts."""
    ld, train, feats, bf = _nb_parts(spark, d)
    model = C.fit_bernoulli_nb(bf.join(train.select("doc_id"), "doc_id", "left_semi"), train.select("doc_id", "label"), feats)
    path = f"{checkpoint_dir(spark).rstrip('/')}/lodestar-files/{uuid.uuid4().hex}"
    files.save_model(path, model=model)
    loaded = files.load_model(spark, path, "model")["model"]
    test = ld.where(F.col("split") == "test")
    pred = C.predict_bernoulli_nb(loaded, bf.join(test.select("doc_id"), "doc_id", "left_semi"), test)
    return test.select("doc_id", "label").join(pred, "doc_id")


def _embed_docs(spark, d):
    return Tables(spark, d).documents.select("doc_id", tokenize(F.col("text")).alias("tokens"))


SMALL = E.Config(dim=16, epochs=2, min_count=5, alpha=0.05)  # of the catalogue's trainers


def _near(vectors, top: int = 3):
    """The nearest words of the 50 most frequent ones."""
    first = X.restrict_vocab(X.build_vocab(vectors.select("word", "n"), 0), 50).select("word")
    q = first.select(F.col("word").alias("qid"), F.col("word").alias("key"), F.lit(1.0).alias("weight"))
    near = VS.most_similar(vectors.select(F.col("word").alias("key"), F.col("vin").alias("vec")), q, top)
    return near.select(F.col("qid").alias("word"), "rank", F.col("key").alias("near"), F.round("score", 6).alias("score"))


@query("cbow_neighbours")
def q_cbow(spark, d):
    """H2: continuous bag of words with negative sampling on all documents."""
    return _near(E.train(_embed_docs(spark, d), SMALL, mode="cbow").words)


@query("skipgram_neighbours")
def q_skipgram(spark, d):
    """H2: skip-gram with negative sampling on all documents."""
    return _near(E.train(_embed_docs(spark, d), SMALL, mode="sg", epochs=1).words)


@query("document_vectors_dbow")
def q_dbow(spark, d):
    """H3: a vector per document, trained with the words (PV-DBOW)."""
    return E.train(_embed_docs(spark, d), SMALL, mode="dbow").docs


@query("document_vectors_dm")
def q_dm(spark, d):
    """H3: a vector per document, trained with the words (PV-DM)."""
    return E.train(_embed_docs(spark, d), SMALL, mode="dm").docs


@query("document_vectors_frozen")
def q_frozen(spark, d):
    """H4: words learned on the training split are read only; every document's
    vector is fitted against them by itself."""
    ids = Tables(spark, d).labels.where("doc_id % 5 <> 0").select("doc_id").distinct()
    docs = _embed_docs(spark, d)
    words = E.train(docs.join(ids, "doc_id", "left_semi"), SMALL, mode="cbow").words
    return E.infer(docs, words, SMALL, mode="dbow", epochs=3)
