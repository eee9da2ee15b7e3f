"""Relational look-ups and co-grouped joins on TPC-H style tables (filters, semi joins,
broadcast-able look-ups, top-k reports)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERY_DATE = "1996-11-01"  # fixed query date of the shipped-on reports


def date_equals(df: DataFrame, column: str, day: str) -> Column:
    """``column = day`` with a literal of the column's own type, so Parquet gets the
    predicate (``PushedFilters``) instead of a cast of every row."""
    dt = df.schema[column].dataType
    if isinstance(dt, T.TimestampNTZType):
        lit = F.expr(f"TIMESTAMP_NTZ '{day} 00:00:00'")
    elif isinstance(dt, T.TimestampType):
        lit = F.expr(f"TIMESTAMP '{day} 00:00:00'")
    elif isinstance(dt, T.DateType):
        lit = F.expr(f"DATE '{day}'")
    else:
        lit = F.lit(day)
    return F.col(column) == lit


def day_text(c: Column) -> Column:
    """A date or timestamp as ``yyyy-MM-dd`` text (strings pass through)."""
    return F.coalesce(F.date_format(c, "yyyy-MM-dd"), c.cast("string"))


def shipdate_count(lineitem: DataFrame, day: str = QUERY_DATE) -> DataFrame:
    """SRC4/F1/A3: number of line items shipped on ``day`` -> (l_shipdate, n)."""
    return (lineitem.where(date_equals(lineitem, "l_shipdate", day))
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.lit(day).alias("l_shipdate"), "n"))


MAX_REPEATS = 1_000_000  # copies of one value written out by ``concat_group`` at most


def concat_group(df: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    """Concatenation of a group's values in value order, duplicates repeated.

    Rows are first counted per distinct (key, value), so what is gathered per key is its distinct values, not its
    rows. The text itself is as long as the group: cut the keys before (``orders_shipped_on`` does). A value that
    stands more than ``MAX_REPEATS`` times in a group raises rather than being shortened or wrapping around.
    """
    per_value = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_k"))
    times = lambda e: F.when(e["_k"] <= MAX_REPEATS, e["_k"].cast("int")).otherwise(
        F.raise_error(F.concat(F.lit("too many repeats of one value to concatenate: "), e["_k"].cast("string"))).cast("int"))
    return per_value.groupBy(*keys).agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct(F.col(value), F.col("_k")))),
                        lambda e: F.repeat(e[value], times(e))),
            "").alias(out),
        F.sum("_k").alias("n_lines"),
    )


def orders_shipped_on(lineitem: DataFrame, orders: DataFrame, day: str = QUERY_DATE,
                      k: int = 20) -> DataFrame:
    """Co-group of orders and the line items shipped on ``day``.

    Keys come from the line-item side (a key without an order keeps a null clerk);
    the report is the first ``k`` order keys. The keys are cut to ``k`` first, so only
    their lines are concatenated and the orders side is probed for ``k`` keys only.
    -> (l_orderkey, clerk, shipdates, n_lines)
    """
    li = (lineitem.where(date_equals(lineitem, "l_shipdate", day))
          .select("l_orderkey", day_text(F.col("l_shipdate")).alias("d")))
    keys = li.select(F.col("l_orderkey").alias("_key")).distinct().orderBy("_key").limit(k)
    top = concat_group(li.join(F.broadcast(keys), F.col("l_orderkey").eqNullSafe(F.col("_key"))).drop("_key"),
                       ["l_orderkey"], "d", "shipdates")  # at most k keys are broadcast
    o = orders.select(F.col("o_orderkey").alias("l_orderkey"),
                      F.col("o_orderpriority").alias("clerk"))
    return (top.join(o, "l_orderkey", "left")
            .select("l_orderkey", "clerk", "shipdates", "n_lines")
            .orderBy("l_orderkey"))


def orders_semi(lineitem: DataFrame, orders: DataFrame, day: str = QUERY_DATE) -> DataFrame:
    """Orders that have at least one line item shipped on ``day``."""
    li = (lineitem.where(date_equals(lineitem, "l_shipdate", day))
          .select(F.col("l_orderkey").alias("o_orderkey")))
    return (orders.join(li, "o_orderkey", "left_semi")
            .select("o_orderkey", F.col("o_orderpriority").alias("clerk")))


def lookup_names(lineitem: DataFrame, part: DataFrame, supplier: DataFrame,
                 day: str = QUERY_DATE, k: int | None = 20, strict: bool = False) -> DataFrame:
    """Line items of ``day`` with part and supplier names, first ``k`` by key.

    Inner joins: a key missing from ``part`` or ``supplier`` drops the row; with
    ``strict=True`` such keys are counted first and a ``ValueError`` is raised.
    Which side is broadcast is left to AQE, which sees the filtered line items' real
    size at run time; part and supplier grow with the data, so no hint forces them.
    """
    li = (lineitem.where(date_equals(lineitem, "l_shipdate", day))
          .select("l_orderkey", "l_partkey", "l_suppkey"))
    p = part.select(F.col("p_partkey").alias("l_partkey"), "p_name")
    s = supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    if strict:
        missing = (li.join(p, "l_partkey", "left_anti").count()
                   + li.join(s, "l_suppkey", "left_anti").count())
        if missing:
            raise ValueError(f"{missing} line items reference a missing part or supplier")
    out = li.join(p, "l_partkey").join(s, "l_suppkey").select("l_orderkey", "p_name", "s_name")
    if k is None:
        return out
    return out.orderBy("l_orderkey", "p_name", "s_name").limit(k)


def unique_map(df: DataFrame, key: str, value: str, order: str | None = None) -> DataFrame:
    """One surviving value per key (the one with the greatest ``order``), and how
    many rows the key had. Deterministic, unlike a hash map's last writer."""
    order = order or value
    return df.groupBy(key).agg(F.max_by(F.col(value), F.col(order)).alias(value),
                               F.count(F.lit(1)).alias("n_rows"))
