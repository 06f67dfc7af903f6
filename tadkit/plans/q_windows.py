"""Registered queries: window functions and time windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tadkit.operators import windows as wn
from tadkit.operators.joins import with_month_id
from tadkit.plans.registry import query
from tadkit.session import Tables


@query("e1_top_k_per_group", """
SELECT o_custkey, o_orderkey, o_totalprice, CAST(rank AS INTEGER) AS rank FROM (
  SELECT o_custkey, o_orderkey, o_totalprice,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders)
WHERE rank <= 3""")
def e1_top_k(spark, d):
    o = Tables(spark, d).orders.select("o_custkey", "o_orderkey", "o_totalprice")
    return wn.top_k(o, "o_custkey", [F.col("o_totalprice").desc(), F.col("o_orderkey")], 3)


@query("e2_top_k_packed_padded", """
WITH c AS (SELECT s_nationkey AS nation, CAST(year(l_shipdate) AS INTEGER) AS yr, l_partkey, count(*) AS n
           FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2, 3),
r AS (SELECT *, row_number() OVER (PARTITION BY nation, yr ORDER BY n DESC, l_partkey) AS rk FROM c),
t AS (SELECT nation, yr, list(l_partkey || ':' || n ORDER BY rk) AS items FROM r WHERE rk <= 3 GROUP BY 1, 2)
SELECT nation, yr, array_to_string(list_concat(items, list_resize(['0:0'], 3 - len(items), '0:0')), '|') AS top3
FROM t""")
def e2_top_k_packed(spark, d):
    t = Tables(spark, d)
    x = t.lineitem.join(t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("nation")), "l_suppkey")
    c = x.groupBy("nation", F.year("l_shipdate").alias("yr"), "l_partkey").agg(F.count(F.lit(1)).alias("n"))
    p = wn.top_k_packed(c, ["nation", "yr"], ["l_partkey", "n"], [F.col("n").desc(), F.col("l_partkey")], 3)
    txt = F.transform("top", lambda s: F.concat(s["l_partkey"].cast("bigint").cast("string"), F.lit(":"),
                                                  s["n"].cast("bigint").cast("string")))
    return p.select("nation", "yr", F.array_join(txt, "|").alias("top3"))


_YEARS = range(1992, 1999)


@query("e2_top_k_packed_by_period_columns", """
WITH c AS (SELECT s_nationkey AS nation, year(l_shipdate) AS yr, l_partkey, count(*) AS n
           FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2, 3),
r AS (SELECT *, row_number() OVER (PARTITION BY nation, yr ORDER BY n DESC, l_partkey) AS rk FROM c)
SELECT nation, """ + ", ".join(
    f"coalesce(string_agg(l_partkey || ':' || n, '|' ORDER BY rk) FILTER (WHERE yr = {y}), '') AS top_{y}" for y in _YEARS)
    + " FROM r WHERE rk <= 3 GROUP BY nation")
def e2_by_period(spark, d):
    """The packed top three, the periods as columns."""
    t = Tables(spark, d)
    x = t.lineitem.join(t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("nation")), "l_suppkey")
    c = x.groupBy("nation", F.year("l_shipdate").alias("yr"), "l_partkey").agg(F.count(F.lit(1)).alias("n"))
    r = wn.top_k(c, ["nation", "yr"], [F.col("n").desc(), F.col("l_partkey")], 3, salt_cols=["l_partkey"])
    item = F.struct("rank", F.concat_ws(":", F.col("l_partkey").cast("string"), F.col("n").cast("string")).alias("item"))
    packed = r.groupBy("nation").agg(*[F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("yr") == y, item))),
                                                                lambda s: s["item"]), "|").alias(f"top_{y}") for y in _YEARS])
    return packed


@query("e3_running_sum_share", """
SELECT o_orderkey,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
       ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running,
  round(CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
       ROWS UNBOUNDED PRECEDING) AS DOUBLE) / CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER (PARTITION BY o_custkey) AS DOUBLE), 9) AS running_share
FROM orders""")
def e3_running(spark, d):
    o = Tables(spark, d).orders.withColumn("p", F.col("o_totalprice").cast("decimal(18,2)"))
    r = wn.running_sum(o, "o_custkey", ["o_orderdate", "o_orderkey"], "p", share=True)
    return r.select("o_orderkey", F.col("running").cast("double").alias("running"),
                    F.round("running_share", 9).alias("running_share"))


@query("e4_first_row_per_group", """
SELECT o_custkey, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey,
       min(o_orderdate) AS o_orderdate, arg_min(o_totalprice, (o_orderdate, o_orderkey)) AS o_totalprice
FROM orders GROUP BY o_custkey""")
def e4_first(spark, d):
    o = Tables(spark, d).orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return wn.first_per_group(o, "o_custkey", ["o_orderdate", "o_orderkey"])


@query("e5_dense_month_index", """
SELECT m AS month, CAST(dense_rank() OVER (ORDER BY m) AS INTEGER) AS id_month
FROM (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS m FROM orders)""")
def e5_dense_month(spark, d):
    from tadkit.operators.joins import calendar_dimension
    return calendar_dimension(Tables(spark, d).orders, "o_orderdate")


@query("e6_period_change_flags", """
SELECT o_orderkey, prev, CASE WHEN prev = 0 THEN NULL ELSE (o_totalprice - prev) / prev END AS chg,
       CAST(prev > o_totalprice AS INTEGER) AS inc, CAST(prev < o_totalprice AS INTEGER) AS dec
FROM (SELECT o_orderkey, o_totalprice,
             lag(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS prev FROM orders)""")
def e6_change(spark, d):
    o = Tables(spark, d).orders.withColumn("_ord", F.struct("o_orderdate", "o_orderkey"))
    return wn.period_changes(o, "o_custkey", "_ord", "o_totalprice").select("o_orderkey", "prev", "chg", "inc", "dec")


_E7_SQL = """
WITH p AS (
  SELECT a.event_id, a.ts AS ats, b.event_id AS bid, b.ts AS bts, b.value AS bv
  FROM events a LEFT JOIN events b ON a.user_id = b.user_id AND b.ts >= a.ts - INTERVAL 7 DAY AND b.ts < a.ts),
base AS (
  SELECT event_id, count(bid) AS num_op, round(avg(bv), 6) AS value_mean,
         (epoch_us(any_value(ats)) - epoch_us(max(bts))) / 1e6 AS secs_since_last,
         arg_max(bv, (bts, bv)) AS value_last
  FROM p GROUP BY event_id),
hc AS (SELECT event_id, hour(bts) AS h, count(*) AS c FROM p WHERE bid IS NOT NULL GROUP BY 1, 2),
ht AS (SELECT event_id, string_agg(CAST(h AS VARCHAR), '|' ORDER BY h) AS hours_top FROM (
         SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY c DESC, h) AS r FROM hc) WHERE r <= 3 GROUP BY 1),
dc AS (SELECT event_id, isodow(bts) - 1 AS wd, count(*) AS c FROM p WHERE bid IS NOT NULL GROUP BY 1, 2),
dt AS (SELECT event_id, string_agg(substr('LMXJVSD', wd + 1, 1), '|' ORDER BY wd) AS weekdays_top FROM (
         SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY c DESC, wd) AS r FROM dc) WHERE r <= 3 GROUP BY 1)
"""


@query("e7_lookback_features", _E7_SQL + """
SELECT base.*, coalesce(hours_top, '') AS hours_top, coalesce(weekdays_top, '') AS weekdays_top
FROM base LEFT JOIN ht USING (event_id) LEFT JOIN dt USING (event_id)""")
def e7_lookback(spark, d):
    e = Tables(spark, d).events
    f = wn.lookback_features(e, "user_id", "ts", "value", "event_id", days=7)
    return f.withColumn("value_mean", F.round("value_mean", 6))


@query("e9_top_hours_weekdays", _E7_SQL + """
SELECT event_id, coalesce(hours_top, '') AS hours_top, coalesce(weekdays_top, '') AS weekdays_top
FROM base LEFT JOIN ht USING (event_id) LEFT JOIN dt USING (event_id)""")
def e9_top_hours(spark, d):
    e = Tables(spark, d).events
    return wn.lookback_features(e, "user_id", "ts", "value", "event_id", days=7).select(
        "event_id", "hours_top", "weekdays_top")


@query("e8_year_ago_window_mean", """
SELECT a.o_orderkey, round(avg(b.o_totalprice), 6) AS value_mean_year_ago
FROM orders a LEFT JOIN orders b ON a.o_custkey = b.o_custkey
  AND b.o_orderdate >= a.o_orderdate - INTERVAL 1 YEAR - INTERVAL 30 DAY
  AND b.o_orderdate <= a.o_orderdate - INTERVAL 1 YEAR
GROUP BY a.o_orderkey""")
def e8_year_ago(spark, d):
    o = Tables(spark, d).orders
    r = wn.year_ago_mean(o, "o_custkey", "o_orderdate", "o_totalprice", "o_orderkey")
    return r.withColumn("value_mean_year_ago", F.round("value_mean_year_ago", 6))


def _daily_series(spark, d):
    """Stock-history stand-in: one series per order priority, daily close."""
    o = Tables(spark, d).orders
    daily = o.groupBy(F.col("o_orderpriority").alias("stock"), F.to_date("o_orderdate").alias("date")).agg(
        F.max("o_totalprice").alias("close"))
    return with_month_id(daily, "date")


_SERIES_SQL = """
WITH daily AS (SELECT o_orderpriority AS stock, CAST(o_orderdate AS DATE) AS date, max(o_totalprice) AS close
               FROM orders GROUP BY 1, 2),
cal AS (SELECT m, dense_rank() OVER (ORDER BY m) AS id_month
        FROM (SELECT DISTINCT CAST(date_trunc('month', date) AS DATE) AS m FROM daily)),
x AS (SELECT stock, date, close, id_month FROM daily JOIN cal ON CAST(date_trunc('month', date) AS DATE) = cal.m)
"""
_SUBS = [3, 6, 9, 12]


@query("e10_anchor_subwindow_features", _SERIES_SQL + """,
g AS (SELECT x.stock, a.id_month AS anchor, s.sub, x.close FROM x, cal a, (VALUES (3), (6), (9), (12)) s(sub)
      WHERE x.id_month BETWEEN a.id_month - s.sub + 1 AND a.id_month)
SELECT stock, CAST(anchor AS INTEGER) AS anchor, """ + ", ".join(
    f"min(close) FILTER (WHERE sub = {s}) AS close_min_{s}, max(close) FILTER (WHERE sub = {s}) AS close_max_{s}, "
    f"CAST(sum(CAST(close AS DECIMAL(18,2))) FILTER (WHERE sub = {s}) AS DOUBLE) / count(close) FILTER (WHERE sub = {s}) AS close_mean_{s}, "
    f"round(median(close) FILTER (WHERE sub = {s}), 6) AS close_median_{s}, "
    f"round(stddev_samp(close) FILTER (WHERE sub = {s}), 6) AS close_std_{s}" for s in _SUBS)
    + " FROM g GROUP BY stock, anchor")
def e10_anchor(spark, d):
    x = _daily_series(spark, d)
    max_id = x.agg(F.max("id_month")).scalar()
    f = wn.anchor_features(x.withColumn("id_month", F.col("id_month").cast("int")), "stock", "id_month", "close", _SUBS, scale=2)
    f = f.filter(F.col("anchor") <= max_id)
    return f.select("stock", F.col("anchor").cast("int").alias("anchor"),
                    *[F.round(c, 6).alias(c) if any(k in c for k in ("median", "std")) else c
                      for c in f.columns if c not in ("stock", "anchor")])


@query("e11_forward_target", _SERIES_SQL + """
SELECT x.stock, CAST(a.id_month AS INTEGER) AS anchor, arg_max(x.close, (x.date, x.close)) AS target
FROM x, cal a WHERE x.id_month > a.id_month AND x.id_month <= a.id_month + 3 GROUP BY 1, 2""")
def e11_target(spark, d):
    x = _daily_series(spark, d).withColumn("id_month", F.col("id_month").cast("int"))
    f = wn.forward_target(x, "stock", "id_month", "date", "close", 3)
    return f.filter(F.col("anchor") >= 1).select("stock", F.col("anchor").cast("int").alias("anchor"), "target")


@query("e12_lag_window_framing", """
WITH m AS (SELECT o_orderpriority AS s, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS y
           FROM orders GROUP BY 1, 2),
l AS (SELECT s, month, y, lag(y, 1) OVER w AS lag1, lag(y, 2) OVER w AS lag2, lag(y, 3) OVER w AS lag3
      FROM m WINDOW w AS (PARTITION BY s ORDER BY month))
SELECT * FROM l WHERE lag3 IS NOT NULL""")
def e12_lags(spark, d):
    o = Tables(spark, d).orders
    m = o.groupBy(F.col("o_orderpriority").alias("s"), F.trunc(F.col("o_orderdate").cast("date"), "month").alias("month")) \
        .agg(F.count(F.lit(1)).alias("y"))
    return wn.lag_frame(m, "s", "month", "y", 3)


@query("e13_average_rank_ties", """
SELECT c_custkey, rank() OVER (ORDER BY c_acctbal) + (count(*) OVER (PARTITION BY c_acctbal) - 1) / 2.0 AS avg_rank
FROM customer""")
def e13_rank(spark, d):
    c = Tables(spark, d).customer.select("c_custkey", "c_acctbal")
    return wn.average_rank(c, "c_acctbal").select("c_custkey", "avg_rank")
