"""Registered queries: joins (C1-C10) and SQL over temp views."""

from __future__ import annotations

from pyspark.sql import functions as F

from tadkit.functions.numeric import money_sum
from tadkit.operators import joins as jn
from tadkit.operators.windows import lookback_agg
from tadkit.plans.registry import query
from tadkit.session import Tables


@query("c1_assemble_tad_customer", """
WITH o AS (SELECT o_custkey AS c_custkey, count(*) AS n_orders,
                  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS amount FROM orders GROUP BY 1),
l AS (SELECT o_custkey AS c_custkey, count(*) AS n_lines FROM lineitem JOIN orders ON l_orderkey = o_orderkey
      WHERE l_returnflag = 'R' GROUP BY 1),
u AS (SELECT o_custkey AS c_custkey, count(*) AS n_urgent FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1)
SELECT c_custkey, coalesce(n_orders, 0) AS n_orders, coalesce(amount, 0) AS amount,
       coalesce(n_lines, 0) AS n_lines, coalesce(n_urgent, 0) AS n_urgent
FROM customer LEFT JOIN o USING (c_custkey) LEFT JOIN l USING (c_custkey) LEFT JOIN u USING (c_custkey)""")
def c1_tad(spark, d):
    t = Tables(spark, d)
    o = t.orders.withColumnRenamed("o_custkey", "c_custkey")
    parts = [
        o.groupBy("c_custkey").agg(F.count(F.lit(1)).alias("n_orders"), money_sum("o_totalprice", 2).alias("amount")),
        t.lineitem.filter(F.col("l_returnflag") == "R").join(o.select(F.col("o_orderkey").alias("l_orderkey"), "c_custkey"), "l_orderkey")
        .groupBy("c_custkey").agg(F.count(F.lit(1)).alias("n_lines")),
        o.filter(F.col("o_orderpriority") == "1-URGENT").groupBy("c_custkey").agg(F.count(F.lit(1)).alias("n_urgent")),
    ]
    return jn.assemble_tad(t.customer, parts, "c_custkey", fill=0)


@query("c2_join_suffix_collisions", """
SELECT o_orderkey, o.custkey, o.amount AS amount_x, c.amount AS amount_y
FROM (SELECT o_orderkey, o_custkey AS custkey, o_totalprice AS amount FROM orders) o
JOIN (SELECT c_custkey AS custkey, c_acctbal AS amount FROM customer) c ON o.custkey = c.custkey""")
def c2_suffix(spark, d):
    t = Tables(spark, d)
    o = t.orders.select("o_orderkey", F.col("o_custkey").alias("custkey"), F.col("o_totalprice").alias("amount"))
    c = t.customer.select(F.col("c_custkey").alias("custkey"), F.col("c_acctbal").alias("amount"))
    return jn.join_suffix(o, c, "custkey")


@query("c2_join_different_key_names", """
SELECT o_orderkey, o_custkey, c_custkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey""")
def c2_keys(spark, d):
    t = Tables(spark, d)
    return jn.join_suffix(t.orders.select("o_orderkey", "o_custkey"), t.customer.select("c_custkey", "c_name"),
                          "o_custkey", "c_custkey")


@query("c3_star_join_sql", """
SELECT n_name, count(*) AS n_lines,
       CAST(sum(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4))) AS DOUBLE) AS revenue
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""")
def c3_star(spark, d):
    """A13 too: temp views + spark.sql; the nation side is broadcast by AQE."""
    t = Tables(spark, d)
    for name in ("lineitem", "orders", "customer", "nation"):
        getattr(t, name).createOrReplaceTempView(f"tk_{name}")
    return spark.sql("""
        SELECT n_name, count(*) AS n_lines,
               CAST(sum(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4))) AS DOUBLE) AS revenue
        FROM tk_lineitem JOIN tk_orders ON l_orderkey = o_orderkey
        JOIN tk_customer ON o_custkey = c_custkey JOIN tk_nation ON c_nationkey = n_nationkey
        GROUP BY n_name""")


@query("c4_outer_join_chain", """
WITH a AS (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS yr, count(*) AS n_orders FROM orders GROUP BY 1, 2),
b AS (SELECT o_custkey, CAST(year(l_shipdate) AS INTEGER) AS yr, CAST(sum(l_quantity) AS BIGINT) AS qty
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2),
c AS (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS yr, count(*) AS n_final FROM orders WHERE o_orderstatus = 'F' GROUP BY 1, 2)
SELECT o_custkey, yr, n_orders, qty, n_final FROM a FULL OUTER JOIN b USING (o_custkey, yr)
FULL OUTER JOIN c USING (o_custkey, yr)""")
def c4_outer(spark, d):
    t = Tables(spark, d)
    o = t.orders
    a = o.groupBy("o_custkey", F.year("o_orderdate").alias("yr")).agg(F.count(F.lit(1)).alias("n_orders"))
    b = t.lineitem.join(o.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey") \
        .groupBy("o_custkey", F.year("l_shipdate").alias("yr")).agg(F.sum("l_quantity").cast("bigint").alias("qty"))
    c = o.filter(F.col("o_orderstatus") == "F").groupBy("o_custkey", F.year("o_orderdate").alias("yr")) \
        .agg(F.count(F.lit(1)).alias("n_final"))
    return jn.outer_join_all([a, b, c], ["o_custkey", "yr"])


@query("c5_last_wins_lookup", """
WITH lk AS (SELECT o_custkey AS c_custkey, arg_max(o_orderstatus, o_orderkey) AS last_status FROM orders GROUP BY 1)
SELECT c_custkey, c_name, last_status FROM customer LEFT JOIN lk USING (c_custkey)""")
def c5_lookup(spark, d):
    t = Tables(spark, d)
    lk = jn.last_wins_lookup(t.orders.withColumnRenamed("o_custkey", "c_custkey"), "c_custkey", "o_orderstatus", "o_orderkey")
    return t.customer.select("c_custkey", "c_name").join(lk.withColumnRenamed("o_orderstatus", "last_status"), "c_custkey", "left")


@query("c6_anti_join", """
SELECT p_partkey FROM part WHERE p_partkey NOT IN (
  SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 40)""")
def c6_anti(spark, d):
    t = Tables(spark, d)
    used = t.lineitem.filter((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 40)).select(F.col("l_partkey").alias("p_partkey"))
    return jn.anti_join(t.part.select("p_partkey"), used, "p_partkey")


@query("c7_calendar_dimension", """
WITH cal AS (SELECT m, dense_rank() OVER (ORDER BY m) AS id_month
             FROM (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS m FROM orders))
SELECT id_month, count(*) AS n_orders FROM orders JOIN cal ON CAST(date_trunc('month', o_orderdate) AS DATE) = cal.m
GROUP BY id_month""")
def c7_calendar(spark, d):
    o = jn.with_month_id(Tables(spark, d).orders, "o_orderdate")
    return o.groupBy(F.col("id_month").cast("bigint").alias("id_month")).agg(F.count(F.lit(1)).alias("n_orders"))


@query("c8_interval_lookback_join", """
SELECT a.o_orderkey, count(b.o_orderkey) AS n_prev, round(sum(b.o_totalprice), 4) AS sum_prev,
       round(avg(b.o_totalprice), 6) AS mean_prev
FROM orders a LEFT JOIN orders b ON a.o_custkey = b.o_custkey AND b.o_orderdate >= a.o_orderdate - INTERVAL 365 DAY
     AND b.o_orderdate < a.o_orderdate
GROUP BY a.o_orderkey""")
def c8_interval(spark, d):
    out = lookback_agg(Tables(spark, d).orders, "o_custkey", "o_orderdate", "o_totalprice", "o_orderkey", 365)
    return out.select("o_orderkey", "n_prev", F.round("sum_prev", 4).alias("sum_prev"), F.round("mean_prev", 6).alias("mean_prev"))


@query("c9_row_key_bind", """
SELECT o_orderkey, o_totalprice, o_orderdate FROM orders""")
def c9_bind(spark, d):
    """pandas column-bind by index: here a join on the row key, never by position."""
    o = Tables(spark, d).orders
    return o.select("o_orderkey", "o_totalprice").join(o.select("o_orderkey", "o_orderdate"), "o_orderkey")


@query("c10_join_frequency_tables", """
WITH s AS (SELECT o_custkey, count(*) FILTER (WHERE o_orderstatus = 'F') AS n_f FROM orders GROUP BY 1),
p AS (SELECT o_custkey, count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS n_urgent FROM orders GROUP BY 1)
SELECT o_custkey, n_f, n_urgent FROM s JOIN p USING (o_custkey)""")
def c10_freq_join(spark, d):
    o = Tables(spark, d).orders
    s = o.groupBy("o_custkey").agg(F.count_if(F.col("o_orderstatus") == "F").alias("n_f"))
    p = o.groupBy("o_custkey").agg(F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("n_urgent"))
    return s.join(p, "o_custkey")


@query("b11_recode_by_join", """
SELECT c_custkey, n_name AS nation FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""")
def b11_recode_join(spark, d):
    t = Tables(spark, d)
    out = jn.recode_join(t.customer.select("c_custkey", "c_nationkey"), "c_nationkey", t.nation, "n_nationkey", "n_name",
                         out="nation")
    return out.select("c_custkey", "nation")
