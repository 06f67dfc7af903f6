"""Registered queries: aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tadkit.functions.dates import MONTHS_EN
from tadkit.functions.numeric import money_sum
from tadkit.functions.text import tokenize
from tadkit.operators import aggregate as ag
from tadkit.plans.registry import query
from tadkit.session import Tables

SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
STATUSES = ["F", "O", "P"]
REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]


def _rev():
    return F.col("l_extendedprice") * (1 - F.col("l_discount"))


@query("d1_global_aggregate", """
SELECT round(avg(l_quantity), 6) AS qty_mean, max(l_extendedprice) AS price_max, min(l_discount) AS disc_min,
       count(*) AS n FROM lineitem""")
def d1_global(spark, d):
    li = Tables(spark, d).lineitem
    return li.agg(F.round(F.avg("l_quantity"), 6).alias("qty_mean"), F.max("l_extendedprice").alias("price_max"),
                  F.min("l_discount").alias("disc_min"), F.count(F.lit(1)).alias("n"))


@query("d2_group_aggregate", """
SELECT l_returnflag, l_linestatus, count(*) AS n,
       CAST(sum(CAST(l_quantity AS DECIMAL(18,4))) AS DOUBLE) AS qty_sum,
       round(avg(l_extendedprice), 6) AS price_mean, min(l_discount) AS disc_min, max(l_tax) AS tax_max
FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def d2_group(spark, d):
    li = Tables(spark, d).lineitem
    return li.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), money_sum("l_quantity").alias("qty_sum"),
        F.round(F.avg("l_extendedprice"), 6).alias("price_mean"), F.min("l_discount").alias("disc_min"),
        F.max("l_tax").alias("tax_max"))


_D3_FNS = ["mean", "std", "min", "max", "median"]
_D3_SQL = {"mean": "avg", "std": "stddev_samp", "min": "min", "max": "max", "median": "median"}


@query("d3_aggregate_matrix", "SELECT o_orderpriority, " + ", ".join(
    f"round({_D3_SQL[f]}({c}), 4) AS x_{f}_{c}" for c in ["o_totalprice"] for f in _D3_FNS)
    + " FROM orders GROUP BY o_orderpriority")
def d3_matrix(spark, d):
    out = ag.agg_matrix(Tables(spark, d).orders, "o_orderpriority", ["o_totalprice"], _D3_FNS, name="x_{fn}_{col}")
    return out.select("o_orderpriority", *[F.round(c, 4).alias(c) for c in out.columns[1:]])


@query("d4_two_level_aggregate", """
WITH l1 AS (
  SELECT s_nationkey AS nation, l_suppkey AS supp, count(*) AS lines
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2)
SELECT nation, count(lines) AS lines_count, round(avg(lines), 6) AS lines_mean, max(lines) AS lines_max,
       min(lines) AS lines_min FROM l1 GROUP BY nation""")
def d4_two_level(spark, d):
    t = Tables(spark, d)
    x = t.lineitem.join(t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("nation")), "l_suppkey")
    out = ag.two_level_agg(x, "nation", F.col("l_suppkey").alias("supp"), {"lines": F.count(F.lit(1))})
    return out.withColumn("lines_mean", F.round("lines_mean", 6))


@query("d5_argmax_entity", """
WITH l1 AS (SELECT s_nationkey AS nation, l_suppkey, count(*) AS lines
            FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2)
SELECT nation, arg_min(l_suppkey, (-lines, l_suppkey)) AS best_supplier FROM l1 GROUP BY nation""")
def d5_argmax(spark, d):
    t = Tables(spark, d)
    x = t.lineitem.join(t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("nation")), "l_suppkey")
    per = x.groupBy("nation", "l_suppkey").agg(F.count(F.lit(1)).alias("lines"))
    return ag.argmax_entity(per, "nation", "l_suppkey", "lines", alias="best_supplier")


@query("d6_mode_per_group", """
SELECT o_custkey, arg_min(o_orderpriority, (-n, o_orderpriority)) AS priority_mode
FROM (SELECT o_custkey, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2) GROUP BY o_custkey""")
def d6_mode(spark, d):
    return ag.mode(Tables(spark, d).orders, "o_custkey", "o_orderpriority", alias="priority_mode")


@query("d7_pivot_count", "SELECT c_nationkey, " + ", ".join(
    f"count(*) FILTER (WHERE c_mktsegment = '{s}') AS seg_{s}" for s in SEGMENTS)
    + " FROM customer GROUP BY c_nationkey")
def d7_pivot(spark, d):
    return ag.pivot_count(Tables(spark, d).customer, "c_nationkey", "c_mktsegment", SEGMENTS, prefix="seg")


_ABBR = [m[:3] for m in MONTHS_EN]


@query("d8_multi_measure_pivot", """
WITH x AS (SELECT s_nationkey AS nation, month(l_shipdate) AS m, CAST(l_extendedprice AS DECIMAL(18,2)) AS p
           FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)
SELECT nation, """ + ", ".join(
    f"CAST(coalesce(sum(p) FILTER (WHERE m = {i + 1}), 0) AS DOUBLE) AS {a}TotalPrice, "
    f"count(*) FILTER (WHERE m = {i + 1}) AS {a}Lines" for i, a in enumerate(_ABBR)) + " FROM x GROUP BY nation")
def d8_pivot_multi(spark, d):
    t = Tables(spark, d)
    x = t.lineitem.join(t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("nation")), "l_suppkey") \
        .select("nation", F.month("l_shipdate").alias("m"), F.col("l_extendedprice").cast("decimal(18,2)").alias("p"))
    out = ag.pivot_agg(x, "nation", "m", list(range(1, 13)), {
        "TotalPrice": lambda mk: F.coalesce(F.sum(F.when(mk, F.col("p"))), F.lit(0)).cast("double"),
        "Lines": lambda mk: F.count_if(mk)}, name="{value}_{measure}")
    ren = {f"{i + 1}_{m}": f"{a}{m}" for i, a in enumerate(_ABBR) for m in ("TotalPrice", "Lines")}
    order = ["nation"] + [f"{a}{m}" for a in _ABBR for m in ("TotalPrice", "Lines")]
    return out.withColumnsRenamed(ren).select(*order)


@query("d9_pivot_count_many", "SELECT o_custkey, " + ", ".join(
    [f"count(*) FILTER (WHERE o_orderstatus = '{v}') AS o_orderstatus_{v}" for v in STATUSES]
    + [f"count(*) FILTER (WHERE o_orderpriority = '{v}') AS \"o_orderpriority_{v}\"" for v in PRIORITIES])
    + " FROM orders GROUP BY o_custkey")
def d9_pivot_many(spark, d):
    return ag.pivot_count_many(Tables(spark, d).orders, "o_custkey", ["o_orderstatus", "o_orderpriority"],
                               {"o_orderstatus": STATUSES, "o_orderpriority": PRIORITIES})


@query("d10_period_pivot", "SELECT c_nationkey, " + ", ".join(
    f"count(*) FILTER (WHERE month(o_orderdate) = {m} AND o_orderstatus = '{s}') AS m{m}_{s}"
    for m in range(1, 13) for s in STATUSES)
    + " FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_nationkey")
def d10_period(spark, d):
    t = Tables(spark, d)
    x = t.orders.join(
        t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey") \
        .withColumn("key", F.concat(F.lit("m"), F.month("o_orderdate"), F.lit("_"), F.col("o_orderstatus")))
    keys = [f"m{m}_{s}" for m in range(1, 13) for s in STATUSES]
    return ag.pivot_count(x, "c_nationkey", "key", keys, prefix="")


@query("d11_nunique", """
SELECT l_returnflag, count(DISTINCT l_partkey) AS l_partkey_nunique, count(DISTINCT l_suppkey) AS l_suppkey_nunique,
       count(DISTINCT l_orderkey) AS l_orderkey_nunique FROM lineitem GROUP BY l_returnflag""")
def d11_nunique(spark, d):
    return ag.nunique(Tables(spark, d).lineitem, ["l_partkey", "l_suppkey", "l_orderkey"], by="l_returnflag")


@query("d12_value_counts", """
SELECT o_orderpriority, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 9) AS share
FROM orders GROUP BY o_orderpriority""")
def d12_value_counts(spark, d):
    vc = ag.value_counts(Tables(spark, d).orders, "o_orderpriority")
    return vc.withColumn("share", F.round("share", 9))


@query("d13_frequency_table", """
WITH c AS (SELECT c_nationkey, count(*) AS fa FROM customer GROUP BY 1)
SELECT c_nationkey, fa, round(fa / sum(fa) OVER (), 9) AS fr,
       CAST(sum(fa) OVER (ORDER BY c_nationkey ROWS UNBOUNDED PRECEDING) AS BIGINT) AS faa,
       round(sum(fa) OVER (ORDER BY c_nationkey ROWS UNBOUNDED PRECEDING) / sum(fa) OVER (), 9) AS fra FROM c""")
def d13_freq(spark, d):
    ft = ag.freq_table(Tables(spark, d).customer, "c_nationkey")
    return ft.withColumn("fr", F.round("fr", 9)).withColumn("fra", F.round("fra", 9))


@query("d14_category_description", """
WITH c AS (SELECT c_mktsegment, count(*) AS fa FROM customer GROUP BY 1)
SELECT c_mktsegment, fa, round(fa / sum(fa) OVER (), 9) AS fr,
       CAST(sum(fa) OVER (ORDER BY fa DESC, c_mktsegment ROWS UNBOUNDED PRECEDING) AS BIGINT) AS faa,
       round(sum(fa) OVER (ORDER BY fa DESC, c_mktsegment ROWS UNBOUNDED PRECEDING) / sum(fa) OVER (), 9) AS fra FROM c""")
def d14_category(spark, d):
    ft = ag.freq_table(Tables(spark, d).customer, "c_mktsegment", order="count")
    return ft.withColumn("fr", F.round("fr", 9)).withColumn("fra", F.round("fra", 9))


_D15_COLS = ["l_quantity", "l_extendedprice", "l_discount"]
_PCT = ag.DESCRIBE_PCTS


def _describe_sql(table, cols):
    parts = []
    for c in cols:
        qs = ", ".join(f"round(quantile_cont({c}, {p}), 6) AS p{int(round(p * 100)):02d}" for p in _PCT)
        parts.append(f"SELECT '{c}' AS variable, count({c}) AS count, round(avg({c}), 6) AS mean, "
                     f"round(stddev_samp({c}), 6) AS std, min({c}) AS min, {qs}, max({c}) AS max FROM {table}")
    return " UNION ALL ".join(parts)


@query("d15_describe_percentiles", _describe_sql("lineitem", _D15_COLS))
def d15_describe(spark, d):
    out = ag.describe(Tables(spark, d).lineitem, _D15_COLS)
    return out.select(*[F.round(c, 6).alias(c) if c in ["mean", "std"] or c.startswith("p") else c for c in out.columns])


_LI_TYPES = [("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"), ("l_linenumber", "int"),
             ("l_quantity", "double"), ("l_extendedprice", "double"), ("l_discount", "double"), ("l_tax", "double"),
             ("l_returnflag", "string"), ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz")]
_NUM = {"bigint", "int", "double"}


def _mz_sql():
    parts = []
    for c, t in _LI_TYPES:
        z = f"count(*) FILTER (WHERE {c} = 0)" if t in _NUM else "CAST(0 AS BIGINT)"
        m = f"count(*) FILTER (WHERE {c} IS NULL OR isnan({c}))" if t == "double" else f"count(*) FILTER (WHERE {c} IS NULL)"
        parts.append(f"SELECT '{c}' AS variable, '{t}' AS dtype, {z} AS zeros, {m} AS missing, "
                     f"round(100.0 * {m} / count(*), 6) AS pct_missing, {z} + {m} AS zeros_missing, "
                     f"round(100.0 * ({z} + {m}) / count(*), 6) AS pct_zeros_missing FROM lineitem")
    return " UNION ALL ".join(parts)


@query("d16_missing_zero_table", _mz_sql())
def d16_missing_zero(spark, d):
    out = ag.missing_zero_table(Tables(spark, d).lineitem)
    return out.withColumn("pct_missing", F.round("pct_missing", 6)).withColumn(
        "pct_zeros_missing", F.round("pct_zeros_missing", 6))


_ORD_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@query("d17_missing_share", " UNION ALL ".join(
    f"SELECT '{c}' AS variable, round(count(*) FILTER (WHERE {c} IS NULL"
    + (f" OR isnan({c})" if c == "o_totalprice" else "") + f") / count(*), 9) AS missing_share FROM orders"
    for c in _ORD_COLS))
def d17_missing_share(spark, d):
    out = ag.missing_share(Tables(spark, d).orders)
    return out.withColumn("missing_share", F.round("missing_share", 9))


@query("d18_olap_cube_grain", """
SELECT l_returnflag, l_linestatus, o_orderstatus, o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS yr,
       count(l_orderkey) AS n_lines, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS amount,
       count(*) FILTER (WHERE l_returnflag = 'R') AS n_returned
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2, 3, 4, 5""")
def d18_olap(spark, d):
    t = Tables(spark, d)
    x = t.lineitem.join(t.orders.withColumnRenamed("o_orderkey", "l_orderkey"), "l_orderkey").withColumn("yr", F.year("o_orderdate"))
    return ag.olap(x, ["l_returnflag", "l_linestatus", "o_orderstatus", "o_orderpriority", "yr"], {
        "n_lines": F.count("l_orderkey"), "amount": money_sum("l_extendedprice", 2),
        "n_returned": F.count_if(F.col("l_returnflag") == "R")})


@query("d19_mean_period_change", """
SELECT o_custkey, round(avg(chg), 6) AS mean_change FROM (
  SELECT o_custkey, o_totalprice / lag(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) - 1 AS chg
  FROM orders) GROUP BY o_custkey""")
def d19_change(spark, d):
    o = Tables(spark, d).orders.withColumn("_ord", F.struct("o_orderdate", "o_orderkey"))
    out = ag.mean_period_change(o, "o_custkey", "_ord", "o_totalprice")
    return out.withColumn("mean_change", F.round("mean_change", 6))


@query("d20_share_of_group", """
SELECT l_orderkey, l_linenumber, round(l_extendedprice / sum(l_extendedprice) OVER (PARTITION BY l_orderkey), 9) AS share
FROM lineitem""")
def d20_share(spark, d):
    li = Tables(spark, d).lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice")
    out = ag.share_of_group(li, "l_orderkey", "l_extendedprice")
    return out.select("l_orderkey", "l_linenumber", F.round("share", 9).alias("share"))


@query("d21_crosstab_normalised", """
WITH x AS (SELECT c_mktsegment, r_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey
           JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2),
s AS (SELECT c_mktsegment, r_name, n / sum(n) OVER (PARTITION BY r_name) AS sh FROM x)
SELECT c_mktsegment, """ + ", ".join(
    f"round(coalesce(sum(sh) FILTER (WHERE r_name = '{r}'), 0), 9) AS \"r_name_{r}\"" for r in REGIONS)
    + " FROM s GROUP BY c_mktsegment")
def d21_crosstab(spark, d):
    t = Tables(spark, d)
    x = t.customer.join(t.nation.withColumnRenamed("n_nationkey", "c_nationkey"), "c_nationkey") \
        .join(t.region.withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey")
    out = ag.crosstab_share(x, "c_mktsegment", "r_name", REGIONS)
    return out.select("c_mktsegment", *[F.round(c, 9).alias(c) for c in out.columns[1:]])


@query("d22_first_last_in_time", """
SELECT o_custkey, arg_min(o_totalprice, (o_orderdate, o_orderkey)) AS first_o_totalprice,
       arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS last_o_totalprice FROM orders GROUP BY o_custkey""")
def d22_first_last(spark, d):
    o = Tables(spark, d).orders.withColumn("_ord", F.struct("o_orderdate", "o_orderkey"))
    return ag.first_last(o, "o_custkey", "_ord", "o_totalprice")


@query("d23_ratio_of_aggregates", """
SELECT c_nationkey, count(*) AS n_orders, count(DISTINCT o_custkey) AS n_customers,
       round(count(*) / count(DISTINCT o_custkey), 9) AS orders_per_customer,
       round(CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*), 6) AS avg_ticket
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_nationkey""")
def d23_ratio(spark, d):
    t = Tables(spark, d)
    x = t.orders.join(t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey")
    g = x.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n_orders"), F.count_distinct("o_custkey").alias("n_customers"),
                                     money_sum("o_totalprice", 2).alias("_amt"))
    return g.select("c_nationkey", "n_orders", "n_customers",
                    F.round(ag.ratio("n_orders", "n_customers"), 9).alias("orders_per_customer"),
                    F.round(ag.ratio("_amt", "n_orders"), 6).alias("avg_ticket"))


@query("d24_daily_event_counts", "SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def d24_daily(spark, d):
    return ag.daily_counts(Tables(spark, d).events, "ts", by="event_type").select("day", "event_type", "n")


@query("d25_ordered_basket", """
WITH x AS (SELECT o_custkey, o_orderdate, l_partkey,
                  row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, l_partkey) - 1 AS pos
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT o_custkey, string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY pos) AS items
FROM x GROUP BY 1""")
def d25_basket(spark, d):
    t = Tables(spark, d)
    x = t.lineitem.join(t.orders.withColumnRenamed("o_orderkey", "l_orderkey"), "l_orderkey")
    b = ag.ordered_basket(x, "o_custkey", "o_orderdate", "l_partkey")
    return b.select("o_custkey", F.array_join(F.transform("items", lambda i: i.cast("string")), ",").alias("items"))


@query("d26_shape_statistics", """
WITH m AS (SELECT c_mktsegment, arg_min(c_nationkey, (-n, c_nationkey)) AS mode_nation
           FROM (SELECT c_mktsegment, c_nationkey, count(*) AS n FROM customer GROUP BY 1, 2) GROUP BY 1)
SELECT c_mktsegment, any_value(mode_nation) AS mode_nation,
       round(median(c_acctbal), 6) AS acctbal_median, round(kurtosis_pop(c_acctbal), 6) AS acctbal_kurtosis
FROM customer JOIN m USING (c_mktsegment) GROUP BY c_mktsegment""")
def d26_shape(spark, d):
    c = Tables(spark, d).customer
    a = ag.shape_stats(c, "c_acctbal", by="c_mktsegment")
    m = c.groupBy("c_mktsegment").agg(F.mode("c_nationkey", deterministic=True).alias("mode_nation"))
    return m.join(a, "c_mktsegment").select("c_mktsegment", "mode_nation",
                                            F.round("c_acctbal_median", 6).alias("acctbal_median"),
                                            F.round("c_acctbal_kurtosis", 6).alias("acctbal_kurtosis"))


@query("d27_duplicate_keys", """
SELECT l_partkey, l_suppkey, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def d27_dups(spark, d):
    return ag.duplicate_keys(Tables(spark, d).lineitem, ["l_partkey", "l_suppkey"])


@query("d28_histogram_bins", """
WITH b AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders),
h AS (SELECT least(CAST(floor(10 * (o_totalprice - lo) / (hi - lo)) AS BIGINT) + 1, 10) AS bin FROM orders, b)
SELECT bin, round(lo + (bin - 1) * (hi - lo) / 10, 4) AS "left", round(lo + bin * (hi - lo) / 10, 4) AS "right",
       count(*) AS n FROM h, b GROUP BY bin, lo, hi""")
def d28_hist(spark, d):
    h = ag.histogram(Tables(spark, d).orders, "o_totalprice", 10)
    return h.select(F.col("bin").cast("bigint").alias("bin"), F.round("left", 4).alias("left"),
                    F.round("right", 4).alias("right"), "n")


@query("d28_box_statistics", """
SELECT o_orderpriority, min(o_totalprice) AS min, round(quantile_cont(o_totalprice, 0.25), 6) AS q1,
       round(quantile_cont(o_totalprice, 0.5), 6) AS median, round(quantile_cont(o_totalprice, 0.75), 6) AS q3,
       max(o_totalprice) AS max FROM orders GROUP BY o_orderpriority""")
def d28_box(spark, d):
    b = ag.box_stats(Tables(spark, d).orders, "o_totalprice", by="o_orderpriority")
    return b.select("o_orderpriority", "min", *[F.round(c, 6).alias(c) for c in ["q1", "median", "q3"]], "max")


@query("d29_cluster_archetypes", """
SELECT c_mktsegment, count(*) AS n, round(avg(c_acctbal), 6) AS c_acctbal FROM customer GROUP BY 1
UNION ALL SELECT 'overall', count(*), round(avg(c_acctbal), 6) FROM customer""")
def d29_archetypes(spark, d):
    a = ag.archetypes(Tables(spark, d).customer, "c_mktsegment", ["c_acctbal"])
    return a.withColumn("c_acctbal", F.round("c_acctbal", 6))


@query("d30_word_counts_by_class", """
WITH t AS (SELECT lang, unnest(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+')) AS word FROM documents)
SELECT lang, word, count(*) AS n FROM t WHERE length(word) > 0 GROUP BY 1, 2""")
def d30_words(spark, d):
    docs = Tables(spark, d).documents.select("lang", tokenize("text").alias("tokens"))
    return ag.word_counts(docs, "tokens", by="lang")
