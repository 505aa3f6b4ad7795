"""Round trips: a given table is written in a format and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lodestar.operators import graph as G
from lodestar.operators import vectors as VS
from lodestar.plans.q_graph import PS, SIMPLE_PS
from lodestar.plans.ranking import global_row_number
from lodestar.plans.registry import query
from lodestar.session import checkpoint_dir
from lodestar.sources import files
from lodestar.sources import standins as S
from lodestar.sources.tables import Tables


def _folder(spark) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/lodestar-files/{uuid.uuid4().hex}"


def _text(df, path: str, sep: str) -> None:
    df.select(F.concat_ws(sep, *df.columns).alias("value")).write.text(path)


@query("file_edges_comma", f"SELECT src, dst FROM ({PS})")
def file_edges_comma(spark, d):
    """A1."""
    path = _folder(spark)
    _text(S.part_supplier_edges(Tables(spark, d)).select("src", "dst"), path, ",")
    return files.read_edges(spark, path)


@query("file_edges_header", "SELECT ps.l_partkey AS src, ps.l_suppkey AS dst FROM lineitem ps")
def file_edges_header(spark, d):
    """A2: every file begins with a header line."""
    path = _folder(spark)
    Tables(spark, d).lineitem.select("l_partkey", "l_suppkey").write.option("header", True).option("sep", " ").csv(path)
    return files.read_edges(spark, path, sep=" ", header_lines=1, as_long=True)


@query("file_edges_whitespace", f"WITH {SIMPLE_PS} SELECT src, dst FROM s")
def file_edges_whitespace(spark, d):
    """A3: both directions, no loops or duplicates."""
    path = _folder(spark)
    _text(S.part_supplier_edges(Tables(spark, d)).select("src", "dst"), path, "  \t")
    return files.read_edges(spark, path, sep=r"\s+", undirected=True)


@query("file_adjacency", f"WITH {SIMPLE_PS} SELECT src, dst FROM s")
def file_adjacency(spark, d):
    """A5 and A4."""
    path = _folder(spark)
    files.write_adjacency(G.undirected_adjacency(G.drop_loops(S.part_supplier_edges(Tables(spark, d)))), path)
    return files.read_adjacency(spark, path)


@query("file_nodes", "SELECT 's' || s_suppkey || chr(9) || s_name || chr(9) || 'supplier' AS line FROM supplier")
def file_nodes(spark, d):
    """A5."""
    path = _folder(spark)
    files.write_nodes(Tables(spark, d).supplier.select(F.concat(F.lit("s"), F.col("s_suppkey")).alias("id"),
                                                       F.col("s_name").alias("name"), F.lit("supplier").alias("type")), path)
    return spark.read.text(path).select(F.col("value").alias("line"))


@query("file_table", "SELECT c_custkey, c_name, c_nationkey FROM customer")
def file_table(spark, d):
    """A16 and A6."""
    path = _folder(spark)
    df = Tables(spark, d).customer.select("c_custkey", "c_name", "c_nationkey")
    files.write_table(df, path)
    return files.read_table(spark, path, df.schema)


@query("file_delimited", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def file_delimited(spark, d):
    """Split at the first separators, typed, header skipped per file."""
    path = _folder(spark)
    Tables(spark, d).orders.select("o_orderkey", "o_custkey", "o_totalprice").write \
        .option("header", True).option("sep", "\t").csv(path)
    return files.read_delimited(spark, path, "\t", ["o_orderkey", "o_custkey", "o_totalprice"],
                                ["long", "long", "double"], skip_header=True)


@query("file_lexicon", "SELECT DISTINCT lower(n_name) AS word, 'positive' AS polarity FROM nation")
def file_lexicon(spark, d):
    """A repeated word list as a set."""
    path = _folder(spark)
    n = Tables(spark, d).nation.select(F.lower("n_name").alias("value"))
    n.unionByName(n).write.text(path)
    return files.read_lexicon(spark, path, "positive")


@query("file_vectors", """
SELECT 'v' || vec_id AS word, len(embedding) AS dims, round(list_sum(CAST(embedding AS DOUBLE[])), 4) AS total,
  count(*) OVER () - row_number() OVER (ORDER BY vec_id DESC) + 1 AS count FROM embeddings""")
def file_vectors(spark, d):
    """Written by falling count over several files, read as one table."""
    path = _folder(spark)
    e = Tables(spark, d).embeddings
    files.write_vectors(e.select(F.concat(F.lit("v"), F.col("vec_id")).alias("word"), F.col("embedding").alias("vec"),
                                 F.col("vec_id").alias("count")), path)
    r = files.read_vectors(spark, path)
    total = F.aggregate(F.col("vec").cast("array<double>"), F.lit(0.0), lambda a, x: a + x)
    return r.select("word", F.size("vec").cast("long").alias("dims"), F.round(total, 4).alias("total"),
                    F.col("count").cast("long").alias("count"))


@query("file_communities", """
SELECT CAST(vec_id AS VARCHAR) AS id, min(vec_id) OVER (PARTITION BY label) AS first FROM embeddings""")
def file_communities(spark, d):
    """A line per community; lines are told apart by their least member."""
    path = _folder(spark)
    files.write_communities(Tables(spark, d).embeddings.select(F.col("vec_id").alias("id"), F.col("label").alias("community")), path)
    r = files.read_communities(spark, path)
    first = r.groupBy("community").agg(F.min(F.col("id").cast("long")).alias("first"))
    return r.join(first, "community").select("id", "first")


@query("file_walks", """
SELECT CAST(o_custkey AS VARCHAR) || ' ' || o_orderkey AS walk FROM orders""")
def file_walks(spark, d):
    """One folder per pass, read as one corpus."""
    o = Tables(spark, d).orders.select(F.pmod("o_custkey", F.lit(3)).cast("int").alias("pass"),
                                       F.array("o_custkey", "o_orderkey").alias("walk"))
    return files.write_walks(o, _folder(spark)).select(F.concat_ws(" ", "tokens").alias("walk"))


@query("file_messages", "SELECT text FROM conversations WHERE text IS NOT NULL")
def file_messages(spark, d):
    """A15 as JSON strings."""
    path = _folder(spark)
    c = Tables(spark, d).conversations.where("text IS NOT NULL").select(F.col("text").alias("value"))
    files.write_messages(c, path, encode="json")
    lines = spark.read.text(path)
    return lines.select(F.from_json(F.concat(F.lit("["), F.col("value"), F.lit("]")), "array<string>")[0].alias("text"))


@query("file_models", "SELECT label, count(*) AS n FROM embeddings GROUP BY label")
def file_models(spark, d):
    """A fitted table saved and loaded."""
    path = _folder(spark)
    model = Tables(spark, d).embeddings.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    files.save_model(path, classes=model)
    return files.load_model(spark, path, "classes")["classes"]


@query("file_lines", """
SELECT row_number() OVER (ORDER BY p_partkey) - 1 AS doc_id, array_to_string(string_split(p_name, ' '), ' ') AS text,
  'T_' || CAST(row_number() OVER (ORDER BY p_partkey) - 1 AS VARCHAR) AS tag FROM part""")
def file_lines(spark, d):
    """Lines written in order over several files, numbered and tagged."""
    path = _folder(spark)
    Tables(spark, d).part.orderBy("p_partkey").select(F.col("p_name").alias("value")).write.text(path)
    r = files.read_lines(spark, path, tag_prefix="T")
    return r.select("doc_id", F.concat_ws(" ", "tokens").alias("text"), F.col("tags")[0].alias("tag"))


@query("file_tagged", """
SELECT lower(n_name) || ' nation' AS text, count(*) AS n FROM nation GROUP BY 1""")
def file_tagged(spark, d):
    """``token/TAG`` lines; pairs without a proper tag and lines without
    pairs go."""
    path = _folder(spark)
    n = Tables(spark, d).nation.select(F.regexp_replace("n_name", " ", "/").alias("n"), F.col("n_name"))
    good = n.select(F.concat(F.regexp_replace("n_name", " ", "\u00a0"), F.lit("/NP Nation/NN x/1 y bare/")).alias("value"))
    good.unionByName(n.select(F.lit("none/9 plain").alias("value"))).write.text(path)
    r = files.read_tagged_corpus(spark, path)
    text = F.regexp_replace(F.concat_ws(" ", "tokens"), "\u00a0", " ")
    return r.groupBy(text.alias("text")).agg(F.count(F.lit(1)).alias("n"))


@query("file_coo", """
SELECT l_partkey AS src, l_suppkey + 10000000 AS dst FROM lineitem UNION SELECT l_suppkey + 10000000, l_partkey FROM lineitem""")
def file_coo(spark, d):
    """A sparse (row, column, value) table, written and read, as edges."""
    path = _folder(spark)
    li = Tables(spark, d).lineitem
    files.write_table(li.select(F.col("l_partkey").alias("row"), (F.col("l_suppkey") + 10000000).alias("col"), "l_quantity"), path)
    return G.edges_from_coo(files.read_table(spark, path, "row long, col long, l_quantity double"))


# questions: four vectors in a row, in the section of their label
QUESTIONS_SQL = """v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
voc AS (SELECT vec_id, label, list_transform(v, lambda x: x / sqrt(list_dot_product(v, v))) AS u FROM v
  WHERE vec_id % 4 <> 3 OR vec_id % 8 = 3),
qs AS (SELECT vec_id AS a, vec_id + 1 AS b, vec_id + 2 AS c, vec_id + 3 AS e, label FROM v
  WHERE vec_id % 3 = 0 AND vec_id + 3 IN (SELECT vec_id FROM v))"""


@query("analogies", f"""WITH {QUESTIONS_SQL},
q AS (SELECT qs.*, x.u AS ua, y.u AS ub, z.u AS uc FROM qs JOIN voc x ON x.vec_id = a JOIN voc y ON y.vec_id = b
  JOIN voc z ON z.vec_id = c JOIN voc w ON w.vec_id = e),
t AS (SELECT a, b, c, e, label, [ub[i] + uc[i] - ua[i] FOR i IN range(1, len(ua) + 1)] AS t FROM q),
s AS (SELECT t.label, a, e, vec_id, row_number() OVER (PARTITION BY a ORDER BY list_dot_product(u, t) DESC, 'v' || vec_id) AS rk
  FROM t CROSS JOIN voc WHERE vec_id NOT IN (a, b, c)),
r AS (SELECT 'label' || label AS section, (vec_id = e)::INT AS ok FROM s WHERE rk = 1)
SELECT section, CAST(sum(ok) AS BIGINT) AS correct, count(*) AS total FROM r GROUP BY section
UNION ALL SELECT 'total', CAST(sum(ok) AS BIGINT), count(*) FROM r""")
def analogies(spark, d):
    """A question file in sections, answered by vectors; one in
    eight vectors is below the frequency that counts."""
    path = _folder(spark)
    e = Tables(spark, d).embeddings.select("vec_id", "label", "embedding")
    name = lambda c: F.concat(F.lit("V"), c.cast("string"))  # noqa: E731  the reader lowers words
    last = e.select((F.col("vec_id") - 3).alias("vec_id"))
    rows = e.where("vec_id % 3 = 0").join(last, "vec_id", "left_semi").select(
        "label", F.lit(1).alias("o"), "vec_id", F.concat_ws(" ", *[name(F.col("vec_id") + i) for i in range(4)]).alias("value"))
    heads = e.select("label").distinct().select("label", F.lit(0).alias("o"), F.lit(0).cast("long").alias("vec_id"),
                                                F.concat(F.lit(": label"), F.col("label").cast("string")).alias("value"))
    heads.unionByName(rows).orderBy("label", "o", "vec_id").select("value").write.text(path)
    vectors = e.select(F.lower(name(F.col("vec_id"))).alias("key"), F.col("embedding").cast("array<double>").alias("vec"))
    common = F.when((F.pmod("vec_id", F.lit(4)) != 3) | (F.pmod("vec_id", F.lit(8)) == 3), 1000).otherwise(1)
    counts = e.select(F.lower(name(F.col("vec_id"))).alias("key"), common.alias("n"))
    r = VS.analogy_accuracy(vectors, files.read_analogies(spark, path), counts, restrict=counts.where("n > 1").count())
    return r.select("section", F.col("correct").cast("long").alias("correct"), "total")


@query("sorted_orders", """
SELECT row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS place, o_orderkey, o_totalprice FROM orders""")
def sorted_orders(spark, d):
    """E5: the whole table in a total order; the places are taken from the
    sorted files."""
    path = _folder(spark)
    Tables(spark, d).orders.select("o_orderkey", "o_totalprice").orderBy(F.col("o_totalprice").desc(), "o_orderkey") \
        .write.option("header", True).csv(path)
    r = files.read_delimited(spark, path, ",", ["o_orderkey", "o_totalprice"], ["long", "double"], skip_header=True)
    lines = r.withColumn("__f", F.input_file_name()).withColumn("__m", F.monotonically_increasing_id())
    placed = global_row_number(lines, [F.col("__f"), F.col("__m")], "place")
    return placed.select("place", "o_orderkey", "o_totalprice")
