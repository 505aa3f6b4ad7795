"""File readers and writers.

Text formats are read with ``spark.read.text`` and parsed with column
expressions, so parsing runs in the JVM and splits across tasks.
Line numbers, where a format needs them, come from
:func:`lodestar.plans.ranking.global_row_number` over (file, offset-free
input order) and never from a single-partition window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.functions.text import tokens


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def _body_lines(spark: SparkSession, path: str) -> DataFrame:
    """(value): the lines of each file but its first. The CSV source drops it
    where a file begins, so nothing is numbered or moved."""
    return (spark.read.schema("value string").option("header", True).option("sep", "\u0001")
            .option("quote", "").option("escape", "").csv(path))


def _numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, value): 1-based line numbers per file.

    The text source keeps each file's splits in offset order and
    ``monotonically_increasing_id`` grows with the split order, so a global
    row number over (file, id) minus the file's first number is the line
    number. No per-file window: a single huge file stays spread over tasks.
    """
    from lodestar.plans.ranking import global_row_number
    df = (spark.read.text(path)
          .withColumn("file", F.input_file_name())
          .withColumn("__mid", F.monotonically_increasing_id()))
    df = global_row_number(df, [F.col("file"), F.col("__mid")], "__rn")
    first = df.groupBy("file").agg(F.min("__rn").alias("__first"))
    return (df.join(first, "file")
              .withColumn("line_no", F.col("__rn") - F.col("__first") + 1)
              .drop("__mid", "__rn", "__first"))


# ------------------------------------------------------------- edge lists


def read_edges(spark: SparkSession, path: str, sep: str = ",", header_lines: int = 0,
               undirected: bool = False, as_long: bool = False) -> DataFrame:
    """A1-A3: edge list -> ``(src, dst)``.

    ``sep=","`` keeps both fields whole (names may contain spaces);
    ``sep=" "`` with ``header_lines=1`` skips the ``n m`` header line;
    ``sep=r"\\s+"`` takes the first two whitespace fields, and with
    ``undirected=True`` adds flipped edges, drops self-loops and duplicates.
    """
    if header_lines not in (0, 1):
        raise ValueError("header_lines is 0 or 1")
    lines = _body_lines(spark, path) if header_lines else _lines(spark, path)
    if sep == ",":
        parts = F.split(F.col("value"), ",", 2)
    else:
        parts = F.split(F.trim(F.col("value")), sep if sep != " " else " ")
    e = lines.where(F.trim("value") != "").select(parts.getItem(0).alias("src"), parts.getItem(1).alias("dst"))
    if sep not in (",", " "):
        e = lines.where(F.trim("value") != "").select(tokens(F.col("value")).alias("t")) \
                 .select(F.col("t")[0].alias("src"), F.col("t")[1].alias("dst"))
    if as_long:
        e = e.select(F.col("src").cast("long").alias("src"), F.col("dst").cast("long").alias("dst"))
    if undirected:
        from lodestar.operators.graph import simple
        e = simple(e)
    return e


def read_adjacency(spark: SparkSession, path: str, dedup: bool = False) -> DataFrame:
    """A4: ``node n1 n2 ..`` lines; ``#`` lines skipped -> ``(src, dst)``."""
    t = (_lines(spark, path).where(~F.col("value").startswith("#"))
         .select(tokens(F.col("value")).alias("t")).where(F.size("t") > 0))
    nb = F.slice("t", 2, F.greatest(F.size("t") - 1, F.lit(0)))
    if dedup:
        nb = F.array_distinct(nb)
    return t.select(F.col("t")[0].alias("src"), F.explode(nb).alias("dst"))


def write_adjacency(adj: DataFrame, path: str) -> None:
    """A5: ``id n1 n2 ..`` lines from ``(id, neighbors)``."""
    adj.select(F.concat_ws(" ", F.col("id").cast("string"),
                           F.concat_ws(" ", F.col("neighbors").cast("array<string>"))).alias("value")) \
       .write.mode("overwrite").text(path)


def write_nodes(nodes: DataFrame, path: str) -> None:
    """A5: ``id<TAB>name<TAB>type`` node list."""
    nodes.select(F.concat_ws("\t", *[F.col(c).cast("string") for c in ("id", "name", "type")]).alias("value")) \
         .write.mode("overwrite").text(path)


# ------------------------------------------------------------ tables


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Header CSV with an explicit schema (inference only when None)."""
    r = spark.read.option("header", True)
    if schema is not None:
        return r.schema(schema).csv(path)
    return r.option("inferSchema", True).csv(path)


def split_target(df: DataFrame, target: str | None = None) -> DataFrame:
    """``(x array<double>, y double)``; target = last column by default."""
    target = target or df.columns[-1]
    xs = [c for c in df.columns if c != target]
    return df.select(F.array(*[F.col(f"`{c}`").cast("double") for c in xs]).alias("x"),
                     F.col(f"`{target}`").cast("double").alias("y"))


def read_delimited(spark: SparkSession, path: str, sep: str, names: list[str],
                   types: list[str] | None = None, skip_header: bool = False) -> DataFrame:
    """Split each line into at most ``len(names)`` fields (the last keeps
    the remainder) and ``try_cast`` to ``types``; bad casts become null."""
    lines = _body_lines(spark, path) if skip_header else _lines(spark, path)
    parts = F.split(F.col("value"), sep, len(names))
    cols = []
    for i, n in enumerate(names):
        c = parts.getItem(i)
        if types and types[i] != "string":
            c = F.trim(c).try_cast(types[i])
        cols.append(c.alias(n))
    return lines.select(*cols)


def read_lines(spark: SparkSession, path: str, tag_prefix: str | None = None) -> DataFrame:
    """One line = one document ``(doc_id, tokens[, tags])``; ``doc_id``
    is the 0-based line position over all files in path order."""
    from lodestar.plans.ranking import global_row_number
    df = (spark.read.text(path).withColumn("file", F.input_file_name())
          .withColumn("__mid", F.monotonically_increasing_id()))
    df = global_row_number(df, [F.col("file"), F.col("__mid")], "__rn")
    out = df.select((F.col("__rn") - 1).alias("doc_id"), tokens(F.col("value")).alias("tokens"))
    if tag_prefix is not None:
        out = out.withColumn("tags", F.array(F.concat(F.lit(f"{tag_prefix}_"), F.col("doc_id").cast("string"))))
    return out


def read_tagged_corpus(spark: SparkSession, path: str) -> DataFrame:
    """``token/TAG`` text: keep pairs whose tag starts with two letters,
    lower the token, drop empty sentences."""
    t = _lines(spark, path).select(tokens(F.col("value")).alias("t"))
    pairs = F.filter(F.transform("t", lambda x: F.split(x, "/")),
                     lambda p: (F.size(p) == 2) & F.substring(p[1], 1, 2).rlike("^[A-Za-z]{2}$"))
    words = F.transform(pairs, lambda p: F.lower(p[0]))
    return t.select(words.alias("tokens")).where(F.size("tokens") > 0)


def chunk_tokens(docs: DataFrame, n: int = 1000, tokens_col: str = "tokens", key: str = "doc_id") -> DataFrame:
    """A10: cut each token list into sentences of ``n`` tokens (last short),
    with ``slice`` over a ``sequence`` of offsets (no explode of tokens)."""
    starts = F.sequence(F.lit(0), F.greatest(F.size(tokens_col) - 1, F.lit(0)), F.lit(n))
    return (docs.where(F.size(tokens_col) > 0)
                .select(key, F.posexplode(starts).alias("chunk", "start"), tokens_col)
                .select(key, "chunk", F.slice(tokens_col, F.col("start") + 1, n).alias("tokens")))


def read_lexicon(spark: SparkSession, path: str, polarity: str | None = None) -> DataFrame:
    """Word list as a distinct set ``(word[, polarity])``."""
    w = _lines(spark, path).select(F.trim("value").alias("word")).where(F.col("word") != "").distinct()
    return w.withColumn("polarity", F.lit(polarity)) if polarity else w


def read_vectors(spark: SparkSession, path: str, vocab_path: str | None = None) -> DataFrame:
    """word2vec text format -> ``(word, vec array<float>, count)``.

    A file may begin with its ``n d`` header; the files of a folder are read
    in order as one table, with the sum of their n. Every row must have d
    values; another number is an error. Counts come from ``vocab_path``
    (``word count``) or fall back to ``n - row index`` (most frequent first)."""
    from lodestar.plans.ranking import global_row_number
    lines = _numbered_lines(spark, path).withColumn("t", tokens(F.col("value")))
    is_head = (F.col("line_no") == 1) & (F.size("t") == 2) & F.col("t")[0].rlike("^[0-9]+$") & F.col("t")[1].rlike("^[0-9]+$")
    head = lines.where(is_head).agg(F.sum(F.col("t")[0].cast("long")).alias("n"),
                                    F.max(F.col("t")[1].cast("int")).alias("d"))
    body = global_row_number(lines.where(~is_head & (F.size("t") > 0)), [F.col("file"), F.col("line_no")], "row")
    body = body.crossJoin(F.broadcast(head))  # one row
    values = F.when(F.size("t") == F.col("d") + 1, F.slice("t", 2, F.col("d"))).otherwise(F.raise_error(F.concat(
        F.lit("vector row of the wrong length: "), F.substring("value", 1, 80))).cast("array<string>"))
    out = body.select(F.col("t")[0].alias("word"), F.transform(values, lambda x: x.cast("float")).alias("vec"),
                      (F.col("n") - F.col("row") + 1).alias("count"))
    if vocab_path:
        vc = _lines(spark, vocab_path).select(tokens(F.col("value")).alias("t")) \
            .select(F.col("t")[0].alias("word"), F.col("t")[1].cast("long").alias("vcount"))
        out = out.join(vc, "word", "left").select("word", "vec", F.col("vcount").alias("count"))
    return out


def write_vectors(vectors: DataFrame, path: str) -> None:
    """``n d`` header then ``word v1 .. vd`` by descending count."""
    stats = vectors.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vec")).alias("d"))
    head = stats.select(F.concat_ws(" ", F.col("n").cast("string"), F.col("d").cast("string")).alias("value"),
                        F.lit(0).alias("__o"), F.lit(None).cast("long").alias("__c"), F.lit("").alias("__w"))
    rows = vectors.select(
        F.concat_ws(" ", F.col("word"), F.concat_ws(" ", F.transform("vec", lambda x: x.cast("string")))).alias("value"),
        F.lit(1).alias("__o"), F.col("count").alias("__c"), F.col("word").alias("__w"))
    out = head.unionByName(rows).orderBy(F.col("__o"), F.col("__c").desc_nulls_last(), F.col("__w"))
    out.select("value").write.mode("overwrite").text(path)  # one file per range, in order


def read_analogies(spark: SparkSession, path: str) -> DataFrame:
    """``: SECTION`` lines open a section for the following 4-word
    lines; malformed lines are skipped; a question before any section is an
    error.

    The section of a line is found by a running count of section headers
    (a distributed prefix sum) and an equi-join on that ordinal."""
    from lodestar.plans.ranking import global_prefix_sum
    lines = _numbered_lines(spark, path)
    is_sec = F.col("value").startswith(": ")
    df = global_prefix_sum(lines.withColumn("__s", is_sec.cast("long")),
                           [F.col("file"), F.col("line_no")], F.col("__s"), "__k")
    secs = df.where(F.col("__s") == 1).select("file", "__k", F.trim(F.expr("substring(value, 3)")).alias("section"))
    q = df.where(F.col("__s") == 0).select(
        "file", "__k", "line_no", F.transform(tokens(F.col("value")), lambda x: F.lower(x)).alias("w"))
    q = q.where(F.size("w") == 4).join(secs, ["file", "__k"], "left")
    section = F.coalesce("section", F.raise_error(F.concat(F.lit("question before any section, line "),
                                                           F.col("line_no").cast("string"))).cast("string"))
    return q.select("line_no", section.alias("section"),
                    *[F.col("w")[i].alias(n) for i, n in enumerate(["a", "b", "c", "expected"])])


def write_table(df: DataFrame, path: str) -> None:
    """Result table to CSV with a header."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_communities(membership: DataFrame, path: str) -> None:
    """One comma-joined, sorted line per community.

    A community's line is its whole member list by definition."""
    membership.groupBy("community").agg(
        F.concat_ws(",", F.transform(F.array_sort(F.collect_list("id")), lambda x: x.cast("string"))).alias("value")) \
        .select("value").write.mode("overwrite").text(path)


def read_communities(spark: SparkSession, path: str) -> DataFrame:
    """Line i (0-based over the files) = community i -> ``(id, community)``."""
    from lodestar.plans.ranking import global_row_number
    df = (spark.read.text(path).withColumn("file", F.input_file_name())
          .withColumn("__mid", F.monotonically_increasing_id()))
    df = global_row_number(df, [F.col("file"), F.col("__mid")], "__rn")
    return df.select((F.col("__rn") - 1).alias("community"),
                     F.explode(F.split(F.trim("value"), ",")).alias("id")) \
             .where(F.col("id") != "").select(F.trim("id").alias("id"), "community")


def write_walks(walks: DataFrame, path: str, rebuild: bool = True) -> DataFrame:
    """Walks ``(pass, walk array)`` as text, one folder per pass.

    With ``rebuild=False`` an existing corpus with the same number of lines
    is reused."""
    spark = walks.sparkSession
    if not rebuild:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        there = p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)
        if there and spark.read.text(path).count() == walks.count():
            return read_walks(spark, path)
    walks.select("pass", F.concat_ws(" ", F.transform("walk", lambda x: x.cast("string"))).alias("value")) \
         .write.mode("overwrite").partitionBy("pass").text(path)
    return read_walks(spark, path)


def read_walks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(tokens(F.col("value")).alias("tokens"))


def write_messages(df: DataFrame, path: str, encode: str = "raw") -> None:
    """Replay texts into a message sink: raw value or a JSON string."""
    # a JSON array of one string less its brackets is the JSON string
    v = F.col("value") if encode == "raw" else F.regexp_replace(F.to_json(F.array("value")), r"^\[|\]$", "")
    df.select(v.alias("value")).write.mode("overwrite").text(path)


def save_model(path: str, **frames: DataFrame) -> None:
    """The tables of a fitted model (naive-Bayes rows, vectors, a
    vocabulary ..), one parquet folder each."""
    for name, df in frames.items():
        df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{name}")


def load_model(spark: SparkSession, path: str, *names: str) -> dict[str, DataFrame]:
    """The saved tables by name."""
    return {name: spark.read.parquet(f"{path.rstrip('/')}/{name}") for name in names}
