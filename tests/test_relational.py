"""Look-ups, co-group, semi join, strict mode, delimited round trip, pushdown."""

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators import relational as R
from tessera.sources.tables import LINEITEM_SCHEMA, read_delimited, read_table, write_delimited

from table_paths import SF001


def _li(spark, rows):
    return spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_shipdate string")


def test_cogroup_keeps_orphan_line_keys(spark):
    li = _li(spark, [(1, 1, 1, "1996-11-01"), (1, 2, 1, "1996-11-01"), (9, 1, 1, "1996-11-01"),
                     (2, 1, 1, "1990-01-01")])
    orders = spark.createDataFrame([(1, "P1"), (2, "P2")], "o_orderkey long, o_orderpriority string")
    got = [tuple(r) for r in R.orders_shipped_on(li, orders, "1996-11-01", 20).collect()]
    assert got == [(1, "P1", "1996-11-011996-11-01", 2), (9, None, "1996-11-01", 1)]
    semi = [tuple(r) for r in R.orders_semi(li, orders, "1996-11-01").collect()]
    assert semi == [(1, "P1")]


def test_lookup_strict_raises_on_missing(spark):
    li = _li(spark, [(1, 1, 1, "1996-11-01"), (2, 99, 1, "1996-11-01")])
    part = spark.createDataFrame([(1, "bolt")], "p_partkey long, p_name string")
    supp = spark.createDataFrame([(1, "acme")], "s_suppkey long, s_name string")
    assert R.lookup_names(li, part, supp, "1996-11-01", None).count() == 1
    with pytest.raises(ValueError):
        R.lookup_names(li, part, supp, "1996-11-01", None, strict=True)


def test_top20_ties_broken_on_every_column(spark):
    li = _li(spark, [(1, p, 1, "1996-11-01") for p in range(30, 0, -1)])
    part = spark.createDataFrame([(p, f"n{p:02d}") for p in range(1, 31)], "p_partkey long, p_name string")
    supp = spark.createDataFrame([(1, "acme")], "s_suppkey long, s_name string")
    got = [r.p_name for r in R.lookup_names(li, part, supp, "1996-11-01", 20).collect()]
    assert got == [f"n{p:02d}" for p in range(1, 21)]


def test_unique_map_is_deterministic(spark):
    df = spark.createDataFrame([("a", 1), ("a", 5), ("b", 2), ("a", 3)], "k string, v long")
    got = {r.k: (r.v, r.n_rows) for r in R.unique_map(df, "k", "v").collect()}
    assert got == {"a": (5, 3), "b": (2, 1)}


def test_date_filter_is_pushed_to_parquet(spark):
    li = read_table(spark, SF001, "lineitem")
    plan = R.shipdate_count(li).select("n")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_shipdate), EqualTo(l_shipdate" in plan
    assert "ReadSchema: struct<l_shipdate" in plan


def test_delimited_round_trip_drops_malformed(spark, tmp_dir):
    li = read_table(spark, SF001, "lineitem")
    write_delimited(li, tmp_dir + "/t", "|")
    with open(tmp_dir + "/t/part-zzz-bad.csv", "w") as fh:
        fh.write("1|2|3\n1|2|3|4|5|6|7|8|9|10|11|12\nbad|2|3|4|5.0|6.0|0.1|0.2|R|F|1996-11-01|\n")
    back = read_delimited(spark, tmp_dir + "/t", LINEITEM_SCHEMA, "|")
    # wrong field counts dropped; a dirty value is null; a trailing separator is allowed
    assert back.count() == li.count() + 1
    assert back.where(F.col("l_orderkey").isNull()).count() == 1
    assert back.where(F.col("l_shipdate") == "1996-11-01").count() - 1 == \
        li.where(R.date_equals(li, "l_shipdate", "1996-11-01")).count()


def test_delimited_round_trip_of_odd_values(spark, tmp_dir):
    odd = ["a|b", "two\nlines", "cr\r\nlf", '"quoted"', 'in "side"', "back\\slash", "\\N", "\\n", "\\s|\\b", "", None, " x ", "|", "\\"]
    schema = T.StructType([T.StructField("i", T.LongType()), T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])
    rows = [(i if i % 4 else None, a, odd[-1 - i]) for i, a in enumerate(odd)]
    for sep in ("|", "||", ","):
        path = f"{tmp_dir}/odd{len(sep)}{ord(sep[0])}"
        write_delimited(spark.createDataFrame(rows, schema), path, sep)
        with open(path + "/part-extra.txt", "w") as f:
            f.write(f"1{sep}short\n2{sep}x{sep}y{sep}long{sep}z\n3{sep}x{sep}y{sep}\n")
        seen = Observation()
        back = [tuple(r) for r in read_delimited(spark, path, schema, sep, rejected=seen).collect()]
        assert sorted(back, key=repr) == sorted([*rows, (3, "x", "y")], key=repr)
        assert seen.get["rejected"] == 2
    one = schema.fields[1:2]
    write_delimited(spark.createDataFrame([("",), (None,), ("x",)], T.StructType(one)), tmp_dir + "/one")
    assert sorted(map(repr, (r[0] for r in read_delimited(spark, tmp_dir + "/one", T.StructType(one)).collect()))) == ["''", "'x'", "None"]
    with pytest.raises(ValueError):
        write_delimited(spark.createDataFrame(rows, schema), tmp_dir + "/no", "\\")


def test_concatenation_of_too_many_repeats_raises(spark):
    from tessera.operators import relational as R
    few = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b")], "k int, v string")
    assert [tuple(r) for r in R.concat_group(few, ["k"], "v", "t").collect()] == [(1, "abb", 3)]
    many = spark.range(R.MAX_REPEATS + 1).select(F.lit(1).alias("k"), F.lit("v").alias("v"))
    with pytest.raises(Exception, match="too many repeats"):
        R.concat_group(many, ["k"], "v", "t").collect()
