"""Registered queries: cleaning and data quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from tadkit.operators import quality as qu
from tadkit.plans.registry import query
from tadkit.session import Tables


def holes(spark, d):
    """Orders with missing values derived from the data itself."""
    o = Tables(spark, d).orders
    return o.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", None).otherwise(F.col("o_totalprice")).alias("price"),
        F.when(F.col("o_orderpriority") == "5-LOW", None).otherwise(F.col("o_orderpriority")).alias("prio"),
        F.when(F.dayofmonth("o_orderdate") == 1, None).otherwise(F.col("o_custkey")).alias("cust"),
        F.col("o_orderstatus").alias("status"))


HOLES = """WITH holes AS (
  SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS price,
         CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END AS prio,
         CASE WHEN day(o_orderdate) = 1 THEN NULL ELSE o_custkey END AS cust, o_orderstatus AS status FROM orders)
"""


@query("j1_drop_rows_missing", HOLES + """
SELECT o_orderkey, 'any' AS rule FROM holes WHERE price IS NOT NULL AND prio IS NOT NULL AND cust IS NOT NULL
UNION ALL SELECT o_orderkey, 'all' FROM holes WHERE NOT (price IS NULL AND prio IS NULL AND cust IS NULL)
UNION ALL SELECT o_orderkey, 'thresh2' FROM holes
  WHERE (CASE WHEN price IS NULL THEN 0 ELSE 1 END) + (CASE WHEN prio IS NULL THEN 0 ELSE 1 END)
        + (CASE WHEN cust IS NULL THEN 0 ELSE 1 END) >= 2""")
def j1_drop(spark, d):
    h = holes(spark, d).drop("status")
    sub = ["price", "prio", "cust"]
    return (qu.drop_rows(h, "any", subset=sub).select("o_orderkey", F.lit("any").alias("rule"))
            .unionByName(qu.drop_rows(h, "all", subset=sub).select("o_orderkey", F.lit("all").alias("rule")))
            .unionByName(qu.drop_rows(h, thresh=2, subset=sub).select("o_orderkey", F.lit("thresh2").alias("rule"))))


@query("j2_fill_by_type", HOLES + """
SELECT o_orderkey, coalesce(price, 0) AS price, coalesce(prio, 'MISSING') AS prio, coalesce(cust, 0) AS cust FROM holes""")
def j2_fill(spark, d):
    h = holes(spark, d).drop("status")
    return qu.fill(qu.fill(h, "MISSING"), 0)


@query("j3_fill_with_mean", HOLES + """
SELECT o_orderkey, round(coalesce(price, (SELECT avg(price) FROM holes)), 6) AS price FROM holes""")
def j3_mean(spark, d):
    h = holes(spark, d).select("o_orderkey", "price")
    return qu.impute(h, ["price"], "mean").withColumn("price", F.round("price", 6))


@query("j4_fit_median_apply_valid", HOLES + """
SELECT o_orderkey, round(coalesce(price, (SELECT median(price) FROM holes WHERE status = 'F')), 6) AS price
FROM holes WHERE status <> 'F'""")
def j4_fit_apply(spark, d):
    h = holes(spark, d)
    train, valid = h.filter(F.col("status") == "F"), h.filter(F.col("status") != "F")
    fitted = qu.fit_fill_values(train, ["price"], "median")
    return qu.apply_fill_values(valid.select("o_orderkey", "price"), fitted).withColumn("price", F.round("price", 6))


@query("j5_proportional_random_impute", HOLES + """,
c AS (SELECT prio, sum(count(*)) OVER (ORDER BY prio) - count(*) AS start FROM holes WHERE prio IS NOT NULL GROUP BY prio),
u AS (SELECT o_orderkey, floor(('0x' || substr(md5(o_orderkey || '|11'), 1, 8))::BIGINT / 4294967296.0::DOUBLE
             * (SELECT count(prio) FROM holes)) AS place FROM holes WHERE prio IS NULL)
SELECT o_orderkey, prio FROM holes WHERE prio IS NOT NULL
UNION ALL SELECT o_orderkey, (SELECT arg_max(c.prio, start) FROM c WHERE start <= place) FROM u""")
def j5_proportional(spark, d):
    """Missing categories drawn in proportion to the known ones, by a hash of the row's key."""
    return qu.proportional_impute(holes(spark, d).select("o_orderkey", "prio"), "prio", seed=11, key=["o_orderkey"])


@query("j6_model_based_impute", HOLES + """
SELECT count(*) AS n_rows, 0 AS n_null FROM holes""")
def j6_model(spark, d):
    """Logistic model fitted on known rows predicts the missing category."""
    h = holes(spark, d).withColumn("price0", F.coalesce("price", F.lit(0.0))).withColumn(
        "cust0", F.coalesce("cust", F.lit(0)).cast("double"))
    out = qu.model_impute(h, "prio", ["price0", "cust0"], max_iter=20)
    return out.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("prio").isNull()).cast("int").alias("n_null"))


@query("j7_ks_imputation_damage", HOLES + """,
a AS (SELECT price AS v, 1 AS s FROM holes WHERE price IS NOT NULL
      UNION ALL SELECT coalesce(price, (SELECT avg(price) FROM holes)), 2 FROM holes),
g AS (SELECT v, count(*) FILTER (WHERE s = 1) AS c1, count(*) FILTER (WHERE s = 2) AS c2 FROM a GROUP BY v),
c AS (SELECT v, sum(c1) OVER (ORDER BY v) AS k1, sum(c2) OVER (ORDER BY v) AS k2,
             sum(c1) OVER () AS n1, sum(c2) OVER () AS n2 FROM g)
SELECT 'price' AS variable, CAST(any_value(n1) AS BIGINT) AS n1, CAST(any_value(n2) AS BIGINT) AS n2,
       round(max(abs(k1 / n1 - k2 / n2)), 9) AS ks, max(abs(k1 / n1 - k2 / n2)) > 0.1 AS damaged FROM c""")
def j7_ks(spark, d):
    from tadkit.operators.stats import ks_2samp
    h = holes(spark, d).select("price")
    ks = ks_2samp(h, qu.impute(h, ["price"], "mean"), ["price"])
    return ks.select("variable", "n1", "n2", F.round("ks", 9).alias("ks"), (F.col("ks") > 0.1).alias("damaged"))


@query("j8_sparse_or_constant_columns", HOLES + """
SELECT 'price' AS variable, round(count(*) FILTER (WHERE price IS NULL) / count(*), 9) AS missing_share,
       count(DISTINCT price) <= 1 AS single_value FROM holes
UNION ALL SELECT 'prio', round(count(*) FILTER (WHERE prio IS NULL) / count(*), 9), count(DISTINCT prio) <= 1 FROM holes
UNION ALL SELECT 'cust', round(count(*) FILTER (WHERE cust IS NULL) / count(*), 9), count(DISTINCT cust) <= 1 FROM holes
UNION ALL SELECT 'one', 0.0, true FROM (SELECT 1) t""")
def j8_sparse(spark, d):
    h = holes(spark, d).select("price", "prio", "cust").withColumn("one", F.lit("x"))
    prof = qu.column_quality(h)
    return prof.select("variable", F.round("missing_share", 9).alias("missing_share"), "single_value")


@query("j9_percentile_fence_flags", """
WITH q AS (SELECT quantile_cont(l_quantity, 0.01) AS a1, quantile_cont(l_quantity, 0.99) AS b1,
                  quantile_cont(l_extendedprice, 0.01) AS a2, quantile_cont(l_extendedprice, 0.99) AS b2 FROM lineitem)
SELECT l_orderkey, l_linenumber, CAST(l_quantity < a1 OR l_quantity > b1 AS INTEGER) AS per_l_quantity,
       CAST(l_extendedprice < a2 OR l_extendedprice > b2 AS INTEGER) AS per_l_extendedprice,
       CAST(l_quantity < a1 OR l_quantity > b1 AS INTEGER) + CAST(l_extendedprice < a2 OR l_extendedprice > b2 AS INTEGER)
         AS outlier_count
FROM lineitem, q""")
def j9_flags(spark, d):
    li = Tables(spark, d).lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    return qu.percentile_flags(li, ["l_quantity", "l_extendedprice"]).drop("l_quantity", "l_extendedprice")


@query("j10_sequential_iqr_filter", """
WITH q1 AS (SELECT quantile_cont(l_extendedprice, 0.25) AS a, quantile_cont(l_extendedprice, 0.75) AS b FROM lineitem),
s1 AS (SELECT l.* FROM lineitem l, q1 WHERE l_extendedprice >= a - 1.0 * (b - a) AND l_extendedprice <= b + 1.0 * (b - a)),
q2 AS (SELECT quantile_cont(l_quantity, 0.25) AS a, quantile_cont(l_quantity, 0.75) AS b FROM s1),
s2 AS (SELECT s1.* FROM s1, q2 WHERE l_quantity >= a - 1.0 * (b - a) AND l_quantity <= b + 1.0 * (b - a)),
q3 AS (SELECT quantile_cont(l_tax, 0.25) AS a, quantile_cont(l_tax, 0.75) AS b FROM s2)
SELECT l_orderkey, l_linenumber FROM s2, q3 WHERE l_tax >= a - 1.0 * (b - a) AND l_tax <= b + 1.0 * (b - a)""")
def j10_iqr(spark, d):
    li = Tables(spark, d).lineitem
    return qu.iqr_filter(li, ["l_extendedprice", "l_quantity", "l_tax"], alpha=1.0).select("l_orderkey", "l_linenumber")


@query("j11_mean_iqr_fence", """
WITH s AS (SELECT avg(o_totalprice) AS m, quantile_cont(o_totalprice, 0.25) AS a, quantile_cont(o_totalprice, 0.75) AS b
           FROM orders)
SELECT o_orderkey FROM orders, s WHERE o_totalprice >= m - 1.0 * (b - a) AND o_totalprice <= m + 1.0 * (b - a)""")
def j11_fence(spark, d):
    return qu.mean_iqr_filter(Tables(spark, d).orders, ["o_totalprice"], k=1.0).select("o_orderkey")


@query("j12_zscore_filter", """
WITH s AS (SELECT avg(l_extendedprice) AS m, stddev_pop(l_extendedprice) AS sd FROM lineitem)
SELECT l_orderkey, l_linenumber FROM lineitem, s WHERE abs((l_extendedprice - m) / sd) < 2""")
def j12_zscore(spark, d):
    return qu.zscore_filter(Tables(spark, d).lineitem, ["l_extendedprice"], 2.0).select("l_orderkey", "l_linenumber")


_RARE_SQL = """
WITH c AS (SELECT year(o_orderdate) AS value, count(*) AS n FROM orders GROUP BY 1),
s AS (SELECT value, n, n / sum(n) OVER () AS share FROM c),
r AS (SELECT coalesce(sum(share) FILTER (WHERE share < 0.1), 0) AS rare FROM s),
t AS (SELECT arg_min(value, (-n, value)) AS top FROM c),
m AS (SELECT value, CASE WHEN share < 0.1 THEN (CASE WHEN rare < 0.1 THEN CAST(top AS VARCHAR) ELSE 'Otros' END)
                    ELSE CAST(value AS VARCHAR) END AS mapped FROM s, r, t)
"""


def _year_frame(spark, d):
    return Tables(spark, d).orders.select("o_orderkey", F.year("o_orderdate").cast("string").alias("yr"))


@query("j13_rare_category_map", _RARE_SQL + "SELECT CAST(value AS VARCHAR) AS value, mapped FROM m")
def j13_map(spark, d):
    return qu.rare_category_map(_year_frame(spark, d), "yr", 0.1)


@query("j13_apply_category_map", _RARE_SQL + """
SELECT mapped AS n_yr, count(*) AS n FROM orders JOIN m ON year(o_orderdate) = m.value GROUP BY 1""")
def j13_apply(spark, d):
    y = _year_frame(spark, d)
    mp = qu.rare_category_map(y, "yr", 0.1)
    return qu.apply_category_map(y, "yr", mp).groupBy("n_yr").agg(F.count(F.lit(1)).alias("n"))


@query("j14_rare_variants", """
WITH c AS (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1),
top AS (SELECT c_nationkey FROM c ORDER BY n DESC, c_nationkey LIMIT 5),
b AS (SELECT p_brand, count(*) AS n FROM part GROUP BY 1)
SELECT 'top5_nation' AS rule, CASE WHEN c_nationkey IN (SELECT c_nationkey FROM top) THEN CAST(c_nationkey AS VARCHAR)
       ELSE 'Other' END AS level, count(*) AS n FROM customer GROUP BY 1, 2
UNION ALL
SELECT 'brand_min_share', CASE WHEN b.n > (SELECT count(*) FROM part) * 0.045 THEN p.p_brand ELSE 'Other' END, count(*)
FROM part p JOIN b USING (p_brand) GROUP BY 1, 2""")
def j14_variants(spark, d):
    t = Tables(spark, d)
    c = t.customer.withColumn("c_nationkey", F.col("c_nationkey").cast("string"))
    a = c.select(F.lit("top5_nation").alias("rule"), qu.keep_top_k_levels(c, "c_nationkey", 5).alias("level")) \
        .groupBy("rule", "level").agg(F.count(F.lit(1)).alias("n"))
    mp = qu.min_count_levels(t.part, "p_brand", 0.045)
    b = qu.apply_category_map(t.part, "p_brand", mp, out="level").select(F.lit("brand_min_share").alias("rule"), "level") \
        .groupBy("rule", "level").agg(F.count(F.lit(1)).alias("n"))
    return a.unionByName(b)


@query("j15_level_capping", """
SELECT CASE WHEN n >= 12 THEN '12 or more' ELSE CAST(n AS VARCHAR) END AS n_orders_capped, count(*) AS customers
FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) GROUP BY 1""")
def j15_cap(spark, d):
    per = Tables(spark, d).orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy(qu.cap_levels("n", 12).alias("n_orders_capped")).agg(F.count(F.lit(1)).alias("customers"))


@query("j16_drop_key_violations", """
SELECT o_orderkey FROM orders WHERE o_custkey NOT IN (
  SELECT o_custkey FROM orders GROUP BY o_custkey, o_orderdate HAVING count(*) > 1)""")
def j16_violations(spark, d):
    o = Tables(spark, d).orders
    return qu.drop_key_violations(o, "o_custkey", ["o_orderdate"]).select("o_orderkey")


@query("j17_invalid_code_removal", "SELECT o_orderkey FROM orders WHERE o_orderpriority NOT IN ('4-NOT SPECIFIED')")
def j17_invalid(spark, d):
    return qu.drop_invalid_codes(Tables(spark, d).orders, "o_orderpriority", ["4-NOT SPECIFIED"]).select("o_orderkey")
