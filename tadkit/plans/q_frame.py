"""Registered queries: projection, filter, sort, sampling, set operations (B, F, G)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tadkit.functions.numeric import inf_to_null, pairwise_ratios, row_total, safe_div
from tadkit.functions.strings import to_number
from tadkit.operators import frame as fr
from tadkit.plans.registry import query
from tadkit.session import Tables


def _sql_div(a: str, b: str) -> str:
    return f"CASE WHEN ({b}) = 0 THEN NULL ELSE ({a}) / ({b}) END"


@query("b1_select", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def b1_select(spark, d):
    return Tables(spark, d).orders.select("o_orderkey", "o_custkey", "o_totalprice")


@query("b2_derived_columns", f"""
SELECT l_orderkey, l_linenumber, l_quantity AS qty_copy, l_quantity * 2 AS qty_x2, l_quantity + 1 AS qty_p1,
       l_quantity / 2 AS qty_half, round(l_extendedprice - l_quantity, 4) AS price_minus_qty,
       {_sql_div('l_extendedprice', 'l_quantity')} AS unit_price,
       round(l_quantity + l_discount + l_tax, 6) AS qty_disc_tax
FROM lineitem""")
def b2_derived(spark, d):
    li = Tables(spark, d).lineitem
    return li.select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("qty_copy"),
                     (F.col("l_quantity") * 2).alias("qty_x2"), (F.col("l_quantity") + 1).alias("qty_p1"),
                     (F.col("l_quantity") / 2).alias("qty_half"),
                     F.round(F.col("l_extendedprice") - F.col("l_quantity"), 4).alias("price_minus_qty"),
                     safe_div("l_extendedprice", "l_quantity").alias("unit_price"),
                     F.round(F.col("l_quantity") + F.col("l_discount") + F.col("l_tax"), 6).alias("qty_disc_tax"))


@query("b3_rename_columns", """
SELECT c_custkey AS cli_custkey, c_name AS cli_name, c_nationkey AS cli_nationkey,
       c_acctbal AS cli_acctbal, c_mktsegment AS segment FROM customer""")
def b3_rename(spark, d):
    c = Tables(spark, d).customer
    c = fr.rename(c, {"c_mktsegment": "Segment "})
    c = fr.clean_names(c)
    c = c.toDF(*[x.replace("c_", "", 1) if x.startswith("c_") else x for x in c.columns])
    return fr.affix_names(c, prefix="cli_", keep=["segment"])


@query("b4_drop_by_substring", """
SELECT l_orderkey, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag
FROM lineitem""")
def b4_drop_like(spark, d):
    li = Tables(spark, d).lineitem
    return fr.drop_like(fr.drop_like(li, "line"), "_ship")


@query("b5_select_by_prefix", "SELECT o_orderkey, o_orderstatus, o_orderdate, o_orderpriority FROM orders")
def b5_select_like(spark, d):
    return fr.select_like(Tables(spark, d).orders, prefix="o_order")


@query("b6_filter_sql_string", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice < 50000")
def b6_filter_sql(spark, d):
    return Tables(spark, d).orders.filter("o_totalprice < 50000").select("o_orderkey", "o_totalprice")


@query("b7_filter_boolean", """
SELECT o_orderkey FROM orders
WHERE (o_orderstatus = 'F' AND o_totalprice > 100000) OR NOT (o_orderpriority = '1-URGENT')""")
def b7_filter_bool(spark, d):
    o = Tables(spark, d).orders
    c = ((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 100000)) | ~(F.col("o_orderpriority") == "1-URGENT")
    return o.filter(c).select("o_orderkey")


@query("b8_isin_semi_anti", """
SELECT l_orderkey, l_linenumber, 'semi' AS kind FROM lineitem
WHERE l_returnflag IN ('A', 'R') AND l_partkey IN (SELECT p_partkey FROM part WHERE p_size < 10)
UNION ALL
SELECT l_orderkey, l_linenumber, 'anti' AS kind FROM lineitem
WHERE l_returnflag NOT IN ('A', 'R') AND l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size >= 5)""")
def b8_isin(spark, d):
    t = Tables(spark, d)
    li = t.lineitem
    small = t.part.filter("p_size < 10").select(F.col("p_partkey").alias("l_partkey"))
    big = t.part.filter("p_size >= 5").select(F.col("p_partkey").alias("l_partkey"))
    semi = li.filter(F.col("l_returnflag").isin("A", "R")).join(small, "l_partkey", "left_semi")
    anti = li.filter(~F.col("l_returnflag").isin("A", "R")).join(big, "l_partkey", "left_anti")
    return semi.select("l_orderkey", "l_linenumber", F.lit("semi").alias("kind")).unionByName(
        anti.select("l_orderkey", "l_linenumber", F.lit("anti").alias("kind")))


@query("b9_null_filter", """
SELECT c.c_custkey FROM customer c
LEFT JOIN (SELECT * FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F') o ON o.o_custkey = c.c_custkey
WHERE o.o_orderkey IS NULL""")
def b9_null(spark, d):
    t = Tables(spark, d)
    c = t.customer
    o = t.orders.filter((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F")).select("o_custkey", "o_orderkey")
    j = c.join(o, c.c_custkey == o.o_custkey, "left")
    return j.filter(F.col("o_orderkey").isNull()).select("c_custkey")


PRICE_EDGES = [0, 50000, 150000, 300000, 1e9]
PRICE_LABELS = ["low", "mid", "high", "top"]


@query("b10_conditional_band", """
SELECT o_orderkey,
  CASE WHEN o_totalprice >= 0 AND o_totalprice <= 50000 THEN 'low'
       WHEN o_totalprice > 50000 AND o_totalprice <= 150000 THEN 'mid'
       WHEN o_totalprice > 150000 AND o_totalprice <= 300000 THEN 'high'
       WHEN o_totalprice > 300000 AND o_totalprice <= 1e9 THEN 'top' END AS price_band,
  CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS is_final
FROM orders""")
def b10_band(spark, d):
    o = Tables(spark, d).orders
    return o.select("o_orderkey", fr.band("o_totalprice", PRICE_EDGES, PRICE_LABELS).alias("price_band"),
                    F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("is_final"))


STATUS = {"F": "finished", "O": "open"}
PRIORITY = {"1-URGENT": "high", "2-HIGH": "high", "3-MEDIUM": "medium", "5-LOW": "low"}


@query("b11_recode_dict", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' END AS status_label,
       coalesce(CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' END, 'other') AS status_default
FROM orders""")
def b11_recode(spark, d):
    o = Tables(spark, d).orders
    return o.select("o_orderkey", fr.recode("o_orderstatus", STATUS).alias("status_label"),
                    fr.recode("o_orderstatus", STATUS, default="other").alias("status_default"))


@query("b12_recode_many", """
SELECT o_orderkey, o_orderstatus,
  CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' END AS o_orderstatus_lbl,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'high' WHEN '2-HIGH' THEN 'high' WHEN '3-MEDIUM' THEN 'medium'
       WHEN '5-LOW' THEN 'low' END AS o_orderpriority_lbl
FROM orders""")
def b12_recode_many(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return fr.recode_many(o, {"o_orderstatus": STATUS, "o_orderpriority": PRIORITY}, suffix="_lbl").drop("o_orderpriority")


@query("b13_coerce_types", """
SELECT event_id, TRY_CAST(regexp_extract(props, ':\\s*([0-9]+)', 1) AS BIGINT) AS k,
       TRY_CAST(CASE WHEN event_type = 'click' THEN 'n/a' ELSE CAST(CAST(floor(value) AS INTEGER) AS VARCHAR) END AS DOUBLE) AS value_int,
       CAST(value > 100 AS INTEGER) AS big
FROM events""")
def b13_coerce(spark, d):
    e = Tables(spark, d).events
    txt = F.when(F.col("event_type") == "click", F.lit("n/a")).otherwise(
        F.floor("value").cast("int").cast("string"))
    return e.select("event_id", to_number(F.regexp_extract("props", r":\s*([0-9]+)", 1), "bigint").alias("k"),
                    to_number(txt).alias("value_int"), (F.col("value") > 100).cast("int").alias("big"))


@query("b14_literal_column", "SELECT o_orderkey, 'orders' AS source, 1 AS one FROM orders")
def b14_literal(spark, d):
    return Tables(spark, d).orders.select("o_orderkey", F.lit("orders").alias("source"), F.lit(1).alias("one"))


@query("b15_dense_row_id", """
SELECT c_custkey, row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) AS row_id FROM customer""")
def b15_row_id(spark, d):
    c = Tables(spark, d).customer.select("c_custkey", "c_acctbal")
    return fr.add_row_id(c, [F.col("c_acctbal").desc(), "c_custkey"]).select("c_custkey", "row_id")


_RATIO_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("b16_pairwise_ratios", "SELECT l_orderkey, l_linenumber, " + ", ".join(
    f"{_sql_div(a, b)} AS {a}_over_{b}" for i, a in enumerate(_RATIO_COLS) for b in _RATIO_COLS[i + 1:])
    + " FROM lineitem")
def b16_ratios(spark, d):
    li = Tables(spark, d).lineitem
    names = [f"{a}_over_{b}" for i, a in enumerate(_RATIO_COLS) for b in _RATIO_COLS[i + 1:]]
    return li.select("l_orderkey", "l_linenumber", *pairwise_ratios(_RATIO_COLS)).select(
        "l_orderkey", "l_linenumber", *names)


@query("b17_inf_to_null_fill", """
SELECT event_id, CASE WHEN isinf(exp(value * 2)) THEN NULL ELSE round(ln(exp(value * 2)), 6) END AS x,
       coalesce(CASE WHEN isinf(exp(value * 2)) THEN NULL ELSE round(ln(exp(value * 2)), 6) END, 0) AS x_filled
FROM events""")
def b17_inf(spark, d):
    e = Tables(spark, d).events
    x = F.round(F.log(inf_to_null(F.exp(F.col("value") * 2))), 6)
    return e.select("event_id", x.alias("x"), x.alias("x_filled")).na.fill(0, ["x_filled"])


@query("b18_column_comparisons", """
SELECT l_returnflag, count(*) FILTER (WHERE l_tax > l_discount) AS n_tax_gt_disc,
       count(*) FILTER (WHERE l_linestatus <> l_returnflag) AS n_status_ne_flag
FROM lineitem GROUP BY l_returnflag""")
def b18_compare(spark, d):
    li = Tables(spark, d).lineitem
    return li.groupBy("l_returnflag").agg(F.count_if(F.col("l_tax") > F.col("l_discount")).alias("n_tax_gt_disc"),
                                          F.count_if(F.col("l_linestatus") != F.col("l_returnflag")).alias("n_status_ne_flag"))


_ORDER_TYPES = [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
                ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")]


@query("b19_schema_profile", " UNION ALL ".join(
    f"SELECT {i} AS pos, '{c}' AS \"column\", '{t}' AS dtype, count({c}) AS non_null, count(*) - count({c}) AS nulls FROM orders"
    for i, (c, t) in enumerate(_ORDER_TYPES)))
def b19_schema(spark, d):
    return fr.schema_profile(Tables(spark, d).orders)


@query("b20_head_preview", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 10")
def b20_head(spark, d):
    return Tables(spark, d).orders.orderBy("o_orderkey").select("o_orderkey", "o_totalprice").limit(10)


@query("b21_row_total", "SELECT l_orderkey, l_linenumber, round(l_quantity + l_discount + l_tax, 6) AS row_total FROM lineitem")
def b21_row_total(spark, d):
    li = Tables(spark, d).lineitem
    return li.select("l_orderkey", "l_linenumber", F.round(row_total(["l_quantity", "l_discount", "l_tax"]), 6).alias("row_total"))


@query("f1_sort_multi", "SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders ORDER BY o_orderpriority, o_totalprice DESC")
def f1_sort(spark, d):
    return Tables(spark, d).orders.orderBy("o_orderpriority", F.col("o_totalprice").desc()).select(
        "o_orderkey", "o_orderpriority", "o_totalprice")


@query("f2_top_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def f2_top_n(spark, d):
    return Tables(spark, d).orders.orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(20).select(
        "o_orderkey", "o_totalprice")


@query("f3_bernoulli_sample", """
SELECT * FROM lineitem WHERE ('0x' || substr(md5(l_orderkey || '|' || l_linenumber || '|42'), 1, 8))::BIGINT / 4294967296.0::DOUBLE < 0.1::DOUBLE""")
def f3_sample(spark, d):
    """Seeded Bernoulli sample of the lines, by their key."""
    return fr.bernoulli_sample(Tables(spark, d).lineitem, 0.1, seed=42, key=["l_orderkey", "l_linenumber"])


@query("f4_balanced_sample", """
SELECT event_type, least(count(*), 500) AS n FROM events GROUP BY event_type""")
def f4_balanced(spark, d):
    """Exactly min(n, class size) rows per class; checked through its class counts."""
    e = Tables(spark, d).events
    s = fr.balanced_sample(e, "event_type", 500, seed=7, key=["event_id"])
    return s.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("f5_random_split", """
SELECT o_orderkey, CASE WHEN u < 0.7::DOUBLE THEN 0 ELSE 1 END AS part FROM (
  SELECT o_orderkey, ('0x' || substr(md5(o_orderkey || '|3'), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u FROM orders)""")
def f5_split(spark, d):
    """Training and validation rows, 70 to 30: every row on one side."""
    parts = fr.random_split(Tables(spark, d).orders, [7, 3], seed=3, key=["o_orderkey"])
    return fr.union_all([p.select("o_orderkey", F.lit(i).alias("part")) for i, p in enumerate(parts)])


@query("f6_entity_split", """
SELECT CAST(0 AS BIGINT) AS n_both, count(DISTINCT o_custkey) AS n_customers FROM orders""")
def f6_entity(spark, d):
    """Split by customer: no customer lands on both sides."""
    o = fr.hash_split(Tables(spark, d).orders, "o_custkey", 0.1)
    per = o.groupBy("o_custkey").agg(F.count_distinct("sample").alias("k"))
    return per.agg(F.count_if(F.col("k") > 1).alias("n_both"), F.count(F.lit(1)).alias("n_customers"))


@query("f7_temporal_split", """
SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY o_orderdate, o_orderkey) >
       floor((SELECT count(*) FROM orders) * (1 - 0.2)) THEN 'test' ELSE 'train' END AS sample FROM orders""")
def f7_temporal(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", "o_orderdate")
    return fr.temporal_split(o, "o_orderdate", 0.2, tie=["o_orderkey"]).select("o_orderkey", "sample")


@query("f7_last_periods_split", """
WITH m AS (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS m FROM orders ORDER BY m DESC LIMIT 3)
SELECT o_orderkey, CASE WHEN CAST(date_trunc('month', o_orderdate) AS DATE) >= (SELECT min(m) FROM m) THEN 'test' ELSE 'train' END AS sample
FROM orders""")
def f7_periods(spark, d):
    """The last three months are test."""
    o = Tables(spark, d).orders.select("o_orderkey", F.trunc(F.col("o_orderdate").cast("date"), "month").alias("month"))
    return fr.last_periods_split(o, "month", 3).select("o_orderkey", "sample")


@query("f9_fixed_column_order", "SELECT o_orderdate, o_orderkey, o_totalprice, o_custkey FROM orders")
def f9_order(spark, d):
    return Tables(spark, d).orders.select("o_orderdate", "o_orderkey", "o_totalprice", "o_custkey")


@query("g1_union_all", """
SELECT c_custkey AS id, c_name AS name, 'customer' AS kind FROM customer
UNION ALL SELECT s_suppkey, s_name, 'supplier' FROM supplier""")
def g1_union(spark, d):
    t = Tables(spark, d)
    a = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.lit("customer").alias("kind"))
    b = t.supplier.select(F.lit("supplier").alias("kind"), F.col("s_name").alias("name"), F.col("s_suppkey").alias("id"))
    return fr.union_all([a, b])


@query("g2_union_missing_columns", """
SELECT c_custkey AS id, c_acctbal AS acctbal, c_mktsegment AS segment FROM customer
UNION ALL SELECT s_suppkey, s_acctbal, NULL FROM supplier""")
def g2_union_missing(spark, d):
    t = Tables(spark, d)
    a = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("acctbal"), F.col("c_mktsegment").alias("segment"))
    b = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("acctbal"))
    return fr.union_all([a, b], allow_missing=True)


@query("g3_distinct_key_spine", """
SELECT DISTINCT k AS nationkey FROM (SELECT c_nationkey AS k FROM customer UNION ALL SELECT s_nationkey FROM supplier)""")
def g3_spine(spark, d):
    t = Tables(spark, d)
    return fr.distinct_keys([t.customer.select(F.col("c_nationkey").alias("nationkey")),
                             t.supplier.select(F.col("s_nationkey").alias("nationkey"))], "nationkey")


@query("g4_dedupe_keep_last", """
SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey,
       arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS o_totalprice,
       max(o_orderdate) AS o_orderdate
FROM orders GROUP BY o_custkey""")
def g4_dedupe(spark, d):
    o = Tables(spark, d).orders.select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    return fr.dedupe(o, "o_custkey", ["o_orderdate", "o_orderkey"], keep="last")


@query("g5_set_difference", """
SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'""")
def g5_diff(spark, d):
    t = Tables(spark, d)
    return fr.difference(t.customer.select(F.col("c_custkey").alias("k")),
                         t.orders.filter(F.col("o_orderstatus") == "P").select(F.col("o_custkey").alias("k")))


@query("g6_split_and_reappend", """
SELECT o_orderkey, round(o_totalprice * 1.1, 4) AS price FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT o_orderkey, round(o_totalprice, 4) FROM orders WHERE NOT (o_orderstatus = 'F')""")
def g6_split(spark, d):
    o = Tables(spark, d).orders
    return fr.split_apply_union(
        o, F.col("o_orderstatus") == "F",
        lambda x: x.select("o_orderkey", F.round(F.col("o_totalprice") * 1.1, 4).alias("price")),
        lambda x: x.select("o_orderkey", F.round("o_totalprice", 4).alias("price")))
