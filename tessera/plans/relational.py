from __future__ import annotations


from tessera.operators import relational as R
from tessera.plans.registry import register
from tessera.session import scratch_path
from tessera.sources.tables import LINEITEM_SCHEMA, read_delimited, read_table, write_delimited

D = R.QUERY_DATE


@register("shipdate_count", f"""
SELECT '{D}' AS l_shipdate, count(*) AS n FROM lineitem WHERE l_shipdate = TIMESTAMP '{D} 00:00:00'
""")
def shipdate_count(spark, sf):
    return R.shipdate_count(read_table(spark, sf, "lineitem"), D)


@register("orders_shipped_on", f"""
WITH li AS (SELECT l_orderkey, count(*) AS n_lines,
                   string_agg(strftime(l_shipdate, '%Y-%m-%d'), '') AS shipdates FROM lineitem
            WHERE l_shipdate = TIMESTAMP '{D} 00:00:00' GROUP BY l_orderkey),
top AS (SELECT * FROM li ORDER BY l_orderkey LIMIT 20)
SELECT top.l_orderkey, o.o_orderpriority AS clerk, top.shipdates, top.n_lines
FROM top LEFT JOIN orders o ON o.o_orderkey = top.l_orderkey
""")
def orders_shipped_on(spark, sf):
    return R.orders_shipped_on(read_table(spark, sf, "lineitem"), read_table(spark, sf, "orders"), D, 20)


@register("orders_semi", f"""
SELECT o_orderkey, o_orderpriority AS clerk FROM orders
WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_shipdate = TIMESTAMP '{D} 00:00:00')
""")
def orders_semi(spark, sf):
    return R.orders_semi(read_table(spark, sf, "lineitem"), read_table(spark, sf, "orders"), D)


@register("lookup_top20", f"""
SELECT l.l_orderkey, p.p_name, s.s_name
FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey JOIN supplier s ON s.s_suppkey = l.l_suppkey
WHERE l.l_shipdate = TIMESTAMP '{D} 00:00:00'
ORDER BY 1, 2, 3 LIMIT 20
""")
def lookup_top20(spark, sf):
    return R.lookup_names(read_table(spark, sf, "lineitem"), read_table(spark, sf, "part"),
                          read_table(spark, sf, "supplier"), D, 20)


@register("lookup_dedup", """
SELECT p_name, max(p_partkey) AS p_partkey, count(*) AS n_rows FROM part GROUP BY p_name
""")
def lookup_dedup(spark, sf):
    return R.unique_map(read_table(spark, sf, "part"), "p_name", "p_partkey", "p_partkey")


@register("scan_delimited", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
       l_returnflag, l_linestatus, strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate
FROM lineitem
""")
def scan_delimited(spark, sf):
    # The test tables have no text form: write lineitem as '|' text to a fresh shared
    # folder, then read it back with a fixed schema (the studied text path).
    path = scratch_path(spark, "lineitem-tbl")
    write_delimited(read_table(spark, sf, "lineitem"), path, sep="|")
    return read_delimited(spark, path, LINEITEM_SCHEMA, sep="|")
