"""Sinks: text of tuples, overwrite, term-sorted index, per-iteration node tables, models.

Every writer overwrites its target (SNK2: the studied jobs delete the output folder first).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_tsv(df: DataFrame, path: str) -> None:
    """SNK1/T15: tab-separated text of tuples, one line per row; maps, arrays and
    structs go out as JSON, nulls as empty fields. In strings, a backslash, tab or line break is
    written as ``\\b``, ``\\t``, ``\\n`` or ``\\r``, so a value never ends its field or line
    (``tables.read_tsv`` reads it back)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if f.dataType.typeName() in ("map", "array", "struct"):
            c = F.to_json(c)  # escapes them itself
        else:
            c = c.cast("string")
            if f.dataType.typeName() == "string":
                for plain, written in (("\\", "\\b"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r")):
                    c = F.replace(c, F.lit(plain), F.lit(written))
        cols.append(F.coalesce(c, F.lit("")))
    df.select(F.concat_ws("\t", *cols).alias("value")).write.mode("overwrite").text(path)


def write_term_sorted(index: DataFrame, path: str, partitions: int) -> None:
    """SNK3: an index written range-partitioned and sorted by term.

    Each file holds a contiguous range of (term, block), so Parquet min/max statistics let a
    term look-up skip every other file and row group, and a very common term is not one task.
    """
    keys = ["term", *[c for c in ("block",) if c in index.columns]]
    (index.repartitionByRange(partitions, *keys).sortWithinPartitions(*keys)
     .write.mode("overwrite").parquet(path))


def write_index(coded: DataFrame, base: str, files: int) -> None:
    """SNK3: a stored index at ``base``: ``data``, sorted files of one term range each, and ``manifest``, one row a file:
    (file, first, last, n) with its least and greatest term. A term so common that its blocks fill more than a file
    stands in several. ``index.open_terms`` reads it."""
    write_term_sorted(coded, f"{base}/data", files)
    stored = coded.sparkSession.read.parquet(f"{base}/data")
    (stored.groupBy(F.col("_metadata.file_name").alias("file"))
     .agg(F.min("term").alias("first"), F.max("term").alias("last"), F.count(F.lit(1)).alias("n"))
     .coalesce(1).write.mode("overwrite").parquet(f"{base}/manifest"))


def iteration_path(base: str, iteration: int) -> str:
    """``{base}/iter=0001`` and so on (zero-padded, so that folders sort; as a partition column it is a plain number)."""
    return f"{base.rstrip('/')}/iter={iteration:04d}"


def write_iteration(nodes: DataFrame, base: str, iteration: int) -> str:
    """SNK4: node table of one iteration; returns its folder."""
    path = iteration_path(base, iteration)
    nodes.write.mode("overwrite").parquet(path)
    return path


def write_adjacency_text(nodes: DataFrame, edges: DataFrame, path: str) -> None:
    """Nodes and edges as adjacency lines ``id n1 n2 ..``, one line a node (SRC5's form, in which a node's
    neighbours are one line however many there are)."""
    out = edges.groupBy("src").agg(F.array_sort(F.collect_list("dst")).alias("_to"))
    line = F.concat_ws(" ", "id", F.coalesce("_to", F.expr("cast(array() AS array<string>)")))
    nodes.join(out, nodes["id"] == out["src"], "left").select(line.alias("value")).write.mode("overwrite").text(path)


def write_instances_text(inst: DataFrame, path: str) -> None:
    """Instances (doc_id, y, features) as lines ``docid label f1 f2 ..``, ``spam`` for y = 1, else ``ham``."""
    label = F.when(F.col("y") == 1, F.lit("spam")).otherwise(F.lit("ham"))
    line = F.concat_ws(" ", F.col("doc_id").cast("string"), label, F.transform("features", lambda x: x.cast("string")))
    inst.select(line.alias("value")).write.mode("overwrite").text(path)


def write_model(model: DataFrame, path: str) -> None:
    """SNK6: model rows ``(model_id, f, w)`` partitioned by model."""
    writer = model.write.mode("overwrite")
    if "model_id" in model.columns:
        writer = writer.partitionBy("model_id")
    writer.parquet(path)


def write_model_text(model: DataFrame, path: str) -> None:
    """Model as text lines ``(f,w)``, the form the studied scorer reads back."""
    (model.select(F.concat(F.lit("("), F.col("f").cast("string"), F.lit(","),
                           F.col("w").cast("string"), F.lit(")")).alias("value"))
     .write.mode("overwrite").text(path))
