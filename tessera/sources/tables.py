"""Sources: Parquet tables, text corpora, delimited tables, adjacency lists, feature and model text.

All readers take explicit schemas (Parquet brings its own) and return DataFrames whose
later filters and projections Catalyst pushes into the scan.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """SRC4: one Parquet table of the test layout ``{sf_dir}/{name}.parquet``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, key: str, min_partitions: int | None = None) -> DataFrame:
    """Hash-spread a scan that arrives in fewer partitions than the cluster has cores.

    A small file (one row group) is read by one task; heavy per-row work (tokenising
    long texts) then runs on one core. Big inputs arrive in many splits already and are
    left alone, so no extra shuffle is paid at scale.
    """
    spark = df.sparkSession
    want = min_partitions or spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= want:
        return df
    return df.repartition(want, key)


def corpus_lines(documents: DataFrame) -> DataFrame:
    """SRC1 on the test tables: one row per text line, id ``(doc_id, line_no)``.

    ``line_no`` counts from 0. Blank lines are kept (they count as lines for PMI).
    """
    return documents.select(
        "doc_id", F.posexplode_outer(F.split(F.col("text"), "\n")).alias("line_no", "line")
    ).where(F.col("line").isNotNull())


MAX_BLOCK_ROWS = 200_000  # file blocks whose line counts are sent to every task at most


def read_text_corpus(spark: SparkSession, path: str) -> DataFrame:
    """SRC1: lines of the text files under ``path`` -> (doc_id STRING, line_no BIGINT, line).

    ``doc_id`` is the file's path and ``line_no`` counts from 0 within the file, blank lines included, however the
    file is split: a line's number is its place in its block of the file plus the lines of the blocks before, which is
    one row a block. The numbers depend on the files alone, so a second read gives the same. Lines end at ``\\n`` only."""
    lines = (spark.read.option("lineSep", "\n").text(path)
             .select(F.col("_metadata.file_path").alias("doc_id"), F.col("_metadata.file_block_start").alias("_start"),
                     F.monotonically_increasing_id().alias("_at"), F.col("value").alias("line")))
    # Rows of a block are neighbours within one partition, so their ids run on without a gap.
    blocks = lines.groupBy("doc_id", "_start").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("doc_id").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    shift = blocks.select("doc_id", "_start", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    if lines.rdd.getNumPartitions() + len(lines.inputFiles()) <= MAX_BLOCK_ROWS:
        shift = F.broadcast(shift)  # no more blocks than that; the lines stay where they were read
    return lines.join(shift, ["doc_id", "_start"]).select("doc_id", (F.col("_at") + F.col("_shift")).alias("line_no"), "line")


# ---------------------------------------------------------------- delimited tables (SRC3, F9)

LINEITEM_SCHEMA = T.StructType([
    T.StructField("l_orderkey", T.LongType()),
    T.StructField("l_partkey", T.LongType()),
    T.StructField("l_suppkey", T.LongType()),
    T.StructField("l_linenumber", T.IntegerType()),
    T.StructField("l_quantity", T.DoubleType()),
    T.StructField("l_extendedprice", T.DoubleType()),
    T.StructField("l_discount", T.DoubleType()),
    T.StructField("l_tax", T.DoubleType()),
    T.StructField("l_returnflag", T.StringType()),
    T.StructField("l_linestatus", T.StringType()),
    T.StructField("l_shipdate", T.StringType()),
])


_ESCAPES = [("\n", "\\n"), ("\r", "\\r")]
_NULL = "\\N"


def _check_sep(sep: str) -> None:
    if not sep or sep[0] in "\\bsnrN\n\r":
        raise ValueError(f"separator {sep!r} cannot be told from the escapes")


def _escapes(kind: T.DataType, sep: str) -> bool:
    """Whether values of a type can hold something to escape: strings can, numbers and times only such a separator."""
    return isinstance(kind, T.StringType) or sep[0].isalnum() or sep[0] in "+-.: "


def write_delimited(df: DataFrame, path: str, sep: str = "|") -> None:
    """Write a table as delimited text, timestamps as ``yyyy-MM-dd`` strings (TPC-H ``.tbl`` style).

    In values, a backslash is written as ``\\b``, the (first character of the) separator as ``\\s``, line
    breaks as ``\\n`` and ``\\r``; null is ``\\N``, an empty string an empty field. Quotes are plain characters.
    """
    _check_sep(sep)
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.BinaryType)):
            raise ValueError(f"column {f.name} has no delimited form")
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            c = F.date_format(F.col(f.name), "yyyy-MM-dd")
        else:
            c = F.col(f.name).cast("string")
        if _escapes(f.dataType, sep):
            for plain, written in [("\\", "\\b"), (sep[0], "\\s"), *_ESCAPES]:
                c = F.replace(c, F.lit(plain), F.lit(written))
        cols.append(F.coalesce(c, F.lit(_NULL)))
    df.select(F.concat_ws(sep, *cols).alias("value")).write.mode("overwrite").text(path)


def read_delimited(spark: SparkSession, path: str, schema: T.StructType, sep: str = "|",
                   rejected: Observation | None = None) -> DataFrame:
    """SRC3/T2/F9: delimited text by position, with a fixed schema and the escapes of ``write_delimited``.

    A line must have exactly one field per schema column (a trailing separator, as in
    TPC-H ``.tbl`` files, is allowed); other lines are dropped whatever columns the
    query reads (the CSV reader's ``DROPMALFORMED`` only checks the columns a query
    needs, so a ``count()`` would keep them). Their number is ``rejected.get["rejected"]`` after the
    first action on the result. A field that does not cast is null.
    """
    _check_sep(sep)
    n = len(schema.fields)
    p = F.split(F.col("value"), re.escape(sep), -1)
    ok = (F.size(p) == n) | ((F.size(p) == n + 1) & (F.element_at(p, -1) == ""))
    lines = spark.read.text(path)
    if rejected is not None:
        lines = lines.observe(rejected, F.count_if(~ok).alias("rejected"))

    def value(i, f):
        c = F.col("p")[i]
        if not _escapes(f.dataType, sep):
            return c.try_cast(f.dataType).alias(f.name)  # the mark of a null does not cast
        for plain, written in [(sep[0], "\\s"), *_ESCAPES, ("\\", "\\b")]:
            c = F.replace(c, F.lit(written), F.lit(plain))
        return F.when(F.col("p")[i] != _NULL, c).try_cast(f.dataType).alias(f.name)
    return lines.select(p.alias("p")).where(ok).select(*[value(i, f) for i, f in enumerate(schema.fields)])


def read_tsv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Text of tuples as ``sinks.write_tsv`` writes it, by position. An empty field is null (an empty string, too); a
    line of another number of fields is dropped; a field that does not cast is null."""
    p = F.split(F.col("value"), "\t", -1)

    def value(i, f):
        c = F.when(F.col("p")[i] != "", F.col("p")[i])
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            return F.from_json(c, f.dataType).alias(f.name)
        if isinstance(f.dataType, T.StringType):
            for plain, written in (("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r"), ("\\", "\\b")):
                c = F.replace(c, F.lit(written), F.lit(plain))
        return c.try_cast(f.dataType).alias(f.name)
    return (spark.read.text(path).select(p.alias("p")).where(F.size("p") == len(schema.fields))
            .select(*[value(i, f) for i, f in enumerate(schema.fields)]))


# ---------------------------------------------------------------- adjacency text (SRC5)

def read_adjacency_text(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """SRC5: lines ``id n1 n2 ..`` separated by white space -> (nodes(id), edges(src, dst)).

    A line holding only an id is a node without out-edges; it stays in ``nodes``.
    """
    parts = (spark.read.text(path)
             .select(F.split(F.trim(F.col("value")), "\\s+").alias("p"))
             .where(F.col("p")[0] != ""))
    nodes = parts.select(F.col("p")[0].alias("id"))
    edges = parts.select(
        F.col("p")[0].alias("src"),
        F.explode(F.slice(F.col("p"), 2, F.greatest(F.size("p") - 1, F.lit(0)))).alias("dst"),
    )
    return nodes, edges


# ---------------------------------------------------------------- labelled instances (SRC7, M1)

def read_instances_text(spark: SparkSession, path: str) -> DataFrame:
    """SRC7/M1/T7: ``docid label f1 f2 ..`` -> (doc_id STRING, y INT, features ARRAY<INT>).

    ``label`` equal to ``spam`` is the positive class. A feature that is not an integer
    becomes null and is dropped from the array.
    """
    p = F.split(F.trim(F.col("value")), "\\s+")
    return (spark.read.text(path)
            .select(p.alias("p"))
            .where(F.size("p") >= 2)
            .select(
                F.col("p")[0].alias("doc_id"),
                (F.col("p")[1] == "spam").cast("int").alias("y"),
                F.filter(F.transform(F.slice("p", 3, F.greatest(F.size("p") - 2, F.lit(0))),
                                     lambda x: x.try_cast("int")),
                         lambda x: x.isNotNull()).alias("features"),
            ))


# ---------------------------------------------------------------- model text (SRC8, T12)

def read_model_text(spark: SparkSession, path: str) -> DataFrame:
    """SRC8/T12: lines ``(f,w)`` -> (f INT, w DOUBLE); the brackets are stripped by pattern."""
    m = "^\\((-?\\d+),([^)]*)\\)$"
    line = F.trim(F.col("value"))
    return (spark.read.text(path)
            .where(line.rlike(m))
            .select(F.regexp_extract(line, m, 1).cast("int").alias("f"),
                    F.regexp_extract(line, m, 2).cast("double").alias("w")))
