"""Stand-in inputs for each operator family, derived from the driver tables.

Each builder is one DataFrame step whose SQL twin lives next to it, so the
query catalogue and its DuckDB oracle start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.sources.tables import Tables

# ---------------------------------------------------------------- graphs


def part_supplier_edges(t: Tables) -> DataFrame:
    """Bipartite part-supplier edges: one per distinct (part, supplier) sold."""
    # distinct on the numbers, whose rows in a hash table are smaller than the names'
    return (t.lineitem.select("l_partkey", "l_suppkey").distinct()
            .select(F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("src"),
                    F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("dst")))


PART_SUPPLIER_EDGES_SQL = """
SELECT DISTINCT 'p' || CAST(l_partkey AS VARCHAR) AS src, 's' || CAST(l_suppkey AS VARCHAR) AS dst
FROM lineitem"""


def geo_forest_edges(t: Tables) -> DataFrame:
    """Customer-nation, supplier-nation and nation-region edges (a forest)."""
    c = t.customer.select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("src"),
                          F.concat(F.lit("n"), F.col("c_nationkey").cast("string")).alias("dst"))
    s = t.supplier.select(F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("src"),
                          F.concat(F.lit("n"), F.col("s_nationkey").cast("string")).alias("dst"))
    n = t.nation.select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("src"),
                        F.concat(F.lit("r"), F.col("n_regionkey").cast("string")).alias("dst"))
    return c.unionByName(s).unionByName(n)


GEO_FOREST_EDGES_SQL = """
SELECT 'c' || CAST(c_custkey AS VARCHAR) AS src, 'n' || CAST(c_nationkey AS VARCHAR) AS dst FROM customer
UNION ALL SELECT 's' || CAST(s_suppkey AS VARCHAR), 'n' || CAST(s_nationkey AS VARCHAR) FROM supplier
UNION ALL SELECT 'n' || CAST(n_nationkey AS VARCHAR), 'r' || CAST(n_regionkey AS VARCHAR) FROM nation"""


def geo_regions(t: Tables) -> DataFrame:
    return t.region.select(F.concat(F.lit("r"), F.col("r_regionkey").cast("string")).alias("id"))


GEO_REGIONS_SQL = "SELECT 'r' || CAST(r_regionkey AS VARCHAR) AS id FROM region"


def trade_edges(t: Tables) -> DataFrame:
    """Nation-to-nation trade edges (customer nation -> supplier nation),
    one per line item: has duplicates and self-loops by construction."""
    li = t.lineitem.select("l_orderkey", "l_suppkey")
    o = t.orders.select("o_orderkey", "o_custkey")
    c = t.customer.select("c_custkey", "c_nationkey")
    s = t.supplier.select("s_suppkey", "s_nationkey")
    return (li.join(o, li.l_orderkey == o.o_orderkey)
              .join(c, F.col("o_custkey") == F.col("c_custkey"))
              .join(s, F.col("l_suppkey") == F.col("s_suppkey"))
              .select(F.concat(F.lit("n"), F.col("c_nationkey").cast("string")).alias("src"),
                      F.concat(F.lit("n"), F.col("s_nationkey").cast("string")).alias("dst")))


TRADE_EDGES_SQL = """
SELECT 'n' || CAST(c_nationkey AS VARCHAR) AS src, 'n' || CAST(s_nationkey AS VARCHAR) AS dst
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey"""

# ------------------------------------------------------- attributed graph


def attributed_vertices(t: Tables) -> DataFrame:
    """Vertices = embeddings; attributes = all components."""
    return t.embeddings.select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("attrs"),
                               F.col("label").alias("community"))


def attributed_edges(t: Tables) -> DataFrame:
    """vec_id -> vec_id+1 inside a label, plus a cross link vec_id -> vec_id+7
    for every vec_id divisible by 5 (both equi-joins, no windows)."""
    a = t.embeddings.select(F.col("vec_id").alias("src"), F.col("label").alias("la"))
    b = t.embeddings.select(F.col("vec_id").alias("dst"), F.col("label").alias("lb"))
    chain = a.join(b, (F.col("dst") == F.col("src") + 1) & (F.col("la") == F.col("lb"))).select("src", "dst")
    cross = a.where(F.pmod(F.col("src"), F.lit(5)) == 0) \
             .join(b, F.col("dst") == F.col("src") + 7).select("src", "dst")
    return chain.unionByName(cross).withColumn("weight", F.lit(1.0))


ATTRIBUTED_EDGES_SQL = """
SELECT a.vec_id AS src, b.vec_id AS dst, 1.0 AS weight FROM embeddings a JOIN embeddings b
  ON b.vec_id = a.vec_id + 1 AND a.label = b.label
UNION ALL
SELECT a.vec_id, b.vec_id, 1.0 FROM embeddings a JOIN embeddings b
  ON b.vec_id = a.vec_id + 7 WHERE a.vec_id % 5 = 0"""

# ------------------------------------------------------------------ plays


def plays(t: Tables) -> DataFrame:
    """(user, item, plays): customer, part, summed quantity."""
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_quantity")
    o = t.orders.select("o_orderkey", "o_custkey")
    return (li.join(o, li.l_orderkey == o.o_orderkey)
              .groupBy(F.col("o_custkey").alias("user"), F.col("l_partkey").alias("item"))
              .agg(F.sum("l_quantity").cast("long").alias("plays")))


PLAYS_SQL = """
SELECT o_custkey AS "user", l_partkey AS item, CAST(sum(l_quantity) AS BIGINT) AS plays
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey, l_partkey"""


def item_aliases(t: Tables) -> DataFrame:
    """Parts with key divisible by 10 are an alias of the previous key."""
    return t.part.where(F.pmod("p_partkey", F.lit(10)) == 0) \
                 .select(F.col("p_partkey").alias("bad"), (F.col("p_partkey") - 1).alias("good"))


ITEM_ALIASES_SQL = "SELECT p_partkey AS bad, p_partkey - 1 AS good FROM part WHERE p_partkey % 10 = 0"


def item_names(t: Tables) -> DataFrame:
    return t.part.select(F.col("p_partkey").alias("item"), F.col("p_name").alias("name"))

# ------------------------------------------------------------------- bids


def bids(t: Tables) -> DataFrame:
    """advertiser = supplier, keyword = brand, bid = 1 + max line number."""
    li = t.lineitem.select("l_suppkey", "l_partkey", "l_linenumber")
    p = t.part.select("p_partkey", "p_brand")
    return (li.join(p, li.l_partkey == p.p_partkey)
              .groupBy(F.col("l_suppkey").alias("advertiser"), F.col("p_brand").alias("keyword"))
              .agg((F.max("l_linenumber") + 1).cast("decimal(12,2)").alias("bid")))


BIDS_SQL = """
SELECT l_suppkey AS advertiser, p_brand AS keyword,
       CAST(max(l_linenumber) + 1 AS DECIMAL(12,2)) AS bid
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_suppkey, p_brand"""


def budgets(t: Tables) -> DataFrame:
    """Daily budget by supplier key: 20 + 5 * (key mod 10)."""
    return t.supplier.select(F.col("s_suppkey").alias("advertiser"),
                             (F.lit(20) + F.lit(5) * F.pmod("s_suppkey", F.lit(10))).cast("decimal(12,2)").alias("budget"))


BUDGETS_SQL = """
SELECT s_suppkey AS advertiser, CAST(20 + 5 * (s_suppkey % 10) AS DECIMAL(12,2)) AS budget FROM supplier"""


def ad_queries(t: Tables, n_brands: int = 25) -> DataFrame:
    """Ordered query stream: events by time; keyword = a brand by modulus.

    ``seq`` is the event id; events are generated in time order, so the id
    is the arrival order (ties in ``ts`` resolved by id)."""
    e = t.events.select("event_id", "ts")
    kw = F.concat(F.lit("Brand#"), (F.pmod("event_id", F.lit(n_brands)) + 1).cast("string"))
    return e.select(F.col("event_id").alias("seq"), kw.alias("keyword"))


AD_QUERIES_SQL = """
SELECT event_id AS seq, 'Brand#' || CAST(event_id % 25 + 1 AS VARCHAR) AS keyword FROM events"""

# ----------------------------------------------------------------- texts


def labelled_docs(t: Tables) -> DataFrame:
    """documents x labels: class = quality; split test when doc_id % 5 = 0."""
    d = t.documents.select("doc_id", "text")
    lab = t.labels.select("doc_id", F.col("quality").alias("label"))
    return d.join(lab, "doc_id").withColumn(
        "split", F.when(F.pmod("doc_id", F.lit(5)) == 0, F.lit("test")).otherwise(F.lit("train")))


LABELLED_DOCS_SQL = """
SELECT d.doc_id, d.text, l.quality AS label,
       CASE WHEN d.doc_id % 5 = 0 THEN 'test' ELSE 'train' END AS split
FROM documents d JOIN labels l ON d.doc_id = l.doc_id"""


def lexicon(t: Tables) -> DataFrame:
    """Words of ``benchmark``: even items positive, odd negative, cleaned
    the same way as messages; positive wins for words in both lists."""
    from lodestar.functions.text import clean_word
    w = t.benchmark.select("item_id", F.explode(F.split(F.col("text"), r"\s+")).alias("raw"))
    w = w.select(clean_word(F.col("raw")).alias("word"),
                 F.when(F.pmod("item_id", F.lit(2)) == 0, F.lit(1)).otherwise(F.lit(0)).alias("pos"))
    w = w.where(F.col("word") != "")
    return w.groupBy("word").agg(F.max("pos").alias("pos")) \
            .select("word", F.when(F.col("pos") == 1, F.lit("positive")).otherwise(F.lit("negative")).alias("polarity"))


LEXICON_SQL = r"""
SELECT word, CASE WHEN max(pos) = 1 THEN 'positive' ELSE 'negative' END AS polarity FROM (
  SELECT lower(regexp_replace(raw, '[^\p{L}\p{N}_]', '', 'g')) AS word,
         CASE WHEN item_id % 2 = 0 THEN 1 ELSE 0 END AS pos
  FROM (SELECT item_id, unnest(regexp_split_to_array(text, '\s+')) AS raw FROM benchmark))
WHERE word <> '' GROUP BY word"""


def messages(t: Tables) -> DataFrame:
    """Conversation turns as messages stamped with event times.

    The i-th turn in (conv_id, turn) order gets the i-th event time in
    (ts, event_id) order; the two row numbers are computed without a
    single-partition window."""
    from lodestar.plans.ranking import global_row_number
    c = global_row_number(t.conversations.select("conv_id", "turn", "text"),
                          [F.col("conv_id"), F.col("turn")], "rn")
    e = global_row_number(t.events.select("event_id", "ts"), [F.col("ts"), F.col("event_id")], "rn")
    ts = F.coalesce("ts", F.raise_error(F.lit("fewer events than turns")).cast(e.schema["ts"].dataType))
    return c.join(e.select("rn", "ts"), "rn", "left").select("conv_id", "turn", ts.alias("ts"), F.col("text").alias("value"))


MESSAGES_SQL = """
SELECT c.conv_id, c.turn, e.ts, c.text AS value
FROM (SELECT conv_id, turn, text, row_number() OVER (ORDER BY conv_id, turn) AS rn FROM conversations) c
JOIN (SELECT ts, row_number() OVER (ORDER BY ts, event_id) AS rn FROM events) e ON c.rn = e.rn"""
