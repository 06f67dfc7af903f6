"""Registered queries: statistics, tests and feature selection."""

from __future__ import annotations

from pyspark.sql import functions as F

from tadkit.operators import stats as st
from tadkit.plans.registry import query
from tadkit.session import Tables

_WOE_BINS = 15


def _woe_frame(spark, d):
    t = Tables(spark, d)
    return t.orders.join(t.customer.withColumnRenamed("c_custkey", "o_custkey"), "o_custkey").select(
        (F.col("o_orderstatus") == "F").cast("int").alias("y"), "o_totalprice", "o_orderpriority", "c_mktsegment",
        "c_acctbal", F.month("o_orderdate").alias("o_month"))


_WOE_COLS = ["o_totalprice", "o_orderpriority", "c_mktsegment", "c_acctbal", "o_month"]
_BINNED = ["o_totalprice", "c_acctbal", "o_month"]


def _woe_sql(final: str) -> str:
    probs = ", ".join(f"{i / _WOE_BINS!r}" for i in range(_WOE_BINS + 1))
    edges = ", ".join(f"list_sort(list_distinct(quantile_cont(CAST({c} AS DOUBLE), [{probs}]))) AS e_{c}" for c in _BINNED)
    keyed = []
    for c in _WOE_COLS:
        if c in _BINNED:
            keyed.append(f"lpad(CAST(greatest(1, len(list_filter(e_{c}, lambda e: e < CAST({c} AS DOUBLE)))) AS VARCHAR), 3, '0') AS {c}")
        else:
            keyed.append(f"coalesce(CAST({c} AS VARCHAR), 'Missings') AS {c}")
    unions = " UNION ALL ".join(f"SELECT '{c}' AS variable, {c} AS bin, y FROM k" for c in _WOE_COLS)
    emap = " ".join(f"WHEN '{c}' THEN e_{c}" for c in _BINNED)
    return f"""
WITH x AS (SELECT CAST(o_orderstatus = 'F' AS INTEGER) AS y, o_totalprice, o_orderpriority, c_mktsegment, c_acctbal,
                  month(o_orderdate) AS o_month FROM orders JOIN customer ON o_custkey = c_custkey),
e AS (SELECT {edges} FROM x),
k AS (SELECT y, {", ".join(keyed)} FROM x, e),
l AS ({unions}),
g AS (SELECT variable, bin, count(*) AS n, sum(y) AS events, count(*) - sum(y) AS non_events FROM l GROUP BY 1, 2),
t AS (SELECT *, sum(events) OVER (PARTITION BY variable) AS te, sum(non_events) OVER (PARTITION BY variable) AS tn FROM g),
w AS (SELECT variable, bin, n, events, non_events, greatest(events, 0.5) / te AS pct_events,
             greatest(non_events, 0.5) / tn AS pct_non_events FROM t),
woe AS (SELECT *, ln(pct_events / pct_non_events) AS woe,
               ln(pct_events / pct_non_events) * (pct_events - pct_non_events) AS iv,
               CASE variable {emap} END AS edges FROM w, e)
{final}"""


@query("k1_woe_iv_table", _woe_sql("""
SELECT variable, bin, round(edges[TRY_CAST(bin AS INTEGER)], 6) AS lo, round(edges[TRY_CAST(bin AS INTEGER) + 1], 6) AS hi,
       n, CAST(events AS BIGINT) AS events, CAST(non_events AS BIGINT) AS non_events,
       round(pct_events, 9) AS pct_events, round(pct_non_events, 9) AS pct_non_events,
       round(woe, 9) AS woe, round(iv, 9) AS iv FROM woe"""))
def k1_woe(spark, d):
    w = st.woe_table(_woe_frame(spark, d), "y", _WOE_COLS, bins=_WOE_BINS)
    return w.select("variable", "bin", F.round("lo", 6).alias("lo"), F.round("hi", 6).alias("hi"), "n",
                    F.col("events").cast("bigint").alias("events"), F.col("non_events").cast("bigint").alias("non_events"),
                    *[F.round(c, 9).alias(c) for c in ["pct_events", "pct_non_events", "woe", "iv"]])


_BAND_SQL = """CASE WHEN iv < 0.02 THEN 'useless' WHEN iv < 0.1 THEN 'weak' WHEN iv < 0.3 THEN 'medium'
  WHEN iv < 0.5 THEN 'strong' ELSE 'over-predictive' END"""


@query("k1_iv_summary", _woe_sql(f"""
SELECT variable, round(sum(iv), 9) AS iv, any_value({_BAND_SQL.replace('iv', 's')}) AS strength
FROM (SELECT variable, iv, sum(iv) OVER (PARTITION BY variable) AS s FROM woe) GROUP BY variable"""))
def k1_iv(spark, d):
    w = st.woe_table(_woe_frame(spark, d), "y", _WOE_COLS, bins=_WOE_BINS)
    return st.iv_summary(w).select("variable", F.round("iv", 9).alias("iv"), "strength")


@query("k9_iv_strength_bands", _woe_sql(f"""
SELECT variable, any_value({_BAND_SQL.replace('iv', 's')}) AS strength
FROM (SELECT variable, sum(iv) OVER (PARTITION BY variable) AS s FROM woe) GROUP BY variable"""))
def k9_bands(spark, d):
    w = st.woe_table(_woe_frame(spark, d), "y", _WOE_COLS, bins=_WOE_BINS)
    return st.iv_summary(w).select("variable", "strength")


@query("k2_woe_width_bins_reversed", """
WITH x AS (SELECT CAST(l_returnflag = 'R' AS INTEGER) AS y, l_discount, l_quantity, l_linestatus FROM lineitem),
mm AS (SELECT min(l_discount) AS a1, max(l_discount) AS b1, min(l_quantity) AS a2, max(l_quantity) AS b2 FROM x),
k AS (SELECT y,
  lpad(CAST(greatest(1, len(list_filter([a1 + 0 * (b1 - a1) / 10, a1 + 1 * (b1 - a1) / 10, a1 + 2 * (b1 - a1) / 10,
     a1 + 3 * (b1 - a1) / 10, a1 + 4 * (b1 - a1) / 10, a1 + 5 * (b1 - a1) / 10, a1 + 6 * (b1 - a1) / 10,
     a1 + 7 * (b1 - a1) / 10, a1 + 8 * (b1 - a1) / 10, a1 + 9 * (b1 - a1) / 10, a1 + 10 * (b1 - a1) / 10],
     lambda e: e < l_discount))) AS VARCHAR), 3, '0') AS l_discount,
  lpad(CAST(greatest(1, len(list_filter([a2 + 0 * (b2 - a2) / 10, a2 + 1 * (b2 - a2) / 10, a2 + 2 * (b2 - a2) / 10,
     a2 + 3 * (b2 - a2) / 10, a2 + 4 * (b2 - a2) / 10, a2 + 5 * (b2 - a2) / 10, a2 + 6 * (b2 - a2) / 10,
     a2 + 7 * (b2 - a2) / 10, a2 + 8 * (b2 - a2) / 10, a2 + 9 * (b2 - a2) / 10, a2 + 10 * (b2 - a2) / 10],
     lambda e: e < l_quantity))) AS VARCHAR), 3, '0') AS l_quantity,
  l_linestatus FROM x, mm),
l AS (SELECT 'l_discount' AS variable, l_discount AS bin, y FROM k UNION ALL SELECT 'l_quantity', l_quantity, y FROM k
      UNION ALL SELECT 'l_linestatus', l_linestatus, y FROM k),
g AS (SELECT variable, bin, count(*) AS n, sum(y) AS events, count(*) - sum(y) AS non_events FROM l GROUP BY 1, 2),
t AS (SELECT *, greatest(events, 0.5) / sum(events) OVER (PARTITION BY variable) AS pe,
             greatest(non_events, 0.5) / sum(non_events) OVER (PARTITION BY variable) AS pn FROM g)
SELECT variable, bin, n, round(ln(pn / pe), 9) AS woe, round(ln(pn / pe) * (pn - pe), 9) AS iv FROM t""")
def k2_woe_width(spark, d):
    li = Tables(spark, d).lineitem.select((F.col("l_returnflag") == "R").cast("int").alias("y"),
                                          "l_discount", "l_quantity", "l_linestatus")
    w = st.woe_table(li, "y", ["l_discount", "l_quantity", "l_linestatus"], bins=10, binning="width",
                     orientation="non/events", infinite_iv_to_zero=True)
    return w.select("variable", "bin", "n", F.round("woe", 9).alias("woe"), F.round("iv", 9).alias("iv"))


@query("k3_woe_encoding_map", """
WITH x AS (SELECT o_orderkey, CAST(o_orderstatus = 'F' AS INTEGER) AS y, o_orderpriority, c_mktsegment
           FROM orders JOIN customer ON o_custkey = c_custkey),
g AS (SELECT 'o_orderpriority' AS variable, o_orderpriority AS bin, count(*) AS n, sum(y) AS ev FROM x GROUP BY 2
      UNION ALL SELECT 'c_mktsegment', c_mktsegment, count(*), sum(y) FROM x GROUP BY 2),
t AS (SELECT variable, bin, ln((greatest(n - ev, 0.5) / sum(n - ev) OVER (PARTITION BY variable))
                       / (greatest(ev, 0.5) / sum(ev) OVER (PARTITION BY variable))) AS woe FROM g)
SELECT o_orderkey, round(a.woe, 9) AS o_orderpriority_woe, round(b.woe, 9) AS c_mktsegment_woe FROM x
JOIN t a ON a.variable = 'o_orderpriority' AND a.bin = x.o_orderpriority
JOIN t b ON b.variable = 'c_mktsegment' AND b.bin = x.c_mktsegment""")
def k3_encode(spark, d):
    t = Tables(spark, d)
    x = t.orders.join(t.customer.withColumnRenamed("c_custkey", "o_custkey"), "o_custkey").select(
        "o_orderkey", (F.col("o_orderstatus") == "F").cast("int").alias("y"), "o_orderpriority", "c_mktsegment")
    enc = st.woe_encode(x, "y", ["o_orderpriority", "c_mktsegment"])
    return enc.select("o_orderkey", F.round("o_orderpriority_woe", 9).alias("o_orderpriority_woe"),
                      F.round("c_mktsegment_woe", 9).alias("c_mktsegment_woe"))


@query("k4_woe_by_pivot_p1_p0", """
WITH x AS (SELECT quality AS y, lang, source FROM documents JOIN labels USING (doc_id)),
g AS (SELECT 'lang' AS variable, lang AS bin, count(*) AS n, sum(y) AS ev FROM x GROUP BY 2
      UNION ALL SELECT 'source', source, count(*), sum(y) FROM x GROUP BY 2),
t AS (SELECT variable, bin, greatest(ev, 0.5) / sum(ev) OVER (PARTITION BY variable) AS p1,
             greatest(n - ev, 0.5) / sum(n - ev) OVER (PARTITION BY variable) AS p0 FROM g)
SELECT variable, bin, round(ln(p1 / p0), 9) AS woe, round(ln(p1 / p0) * (p1 - p0), 9) AS iv FROM t""")
def k4_woe_p1p0(spark, d):
    t = Tables(spark, d)
    x = t.documents.join(t.labels, "doc_id").select(F.col("quality").alias("y"), "lang", "source")
    w = st.woe_table(x, "y", ["lang", "source"], orientation="events/non")
    return w.select("variable", "bin", F.round("woe", 9).alias("woe"), F.round("iv", 9).alias("iv"))


_KS_SQL = """
WITH a AS (SELECT 'o_totalprice' AS variable, o_totalprice AS v, CASE o_orderstatus WHEN 'F' THEN 1 ELSE 2 END AS s
           FROM orders WHERE o_orderstatus IN ('F', 'O')
           UNION ALL SELECT 'o_month', month(o_orderdate), CASE o_orderstatus WHEN 'F' THEN 1 ELSE 2 END
           FROM orders WHERE o_orderstatus IN ('F', 'O')),
g AS (SELECT variable, v, count(*) FILTER (WHERE s = 1) AS c1, count(*) FILTER (WHERE s = 2) AS c2 FROM a GROUP BY 1, 2),
c AS (SELECT variable, sum(c1) OVER (PARTITION BY variable ORDER BY v) AS k1, sum(c2) OVER (PARTITION BY variable ORDER BY v) AS k2,
             sum(c1) OVER (PARTITION BY variable) AS n1, sum(c2) OVER (PARTITION BY variable) AS n2 FROM g),
d AS (SELECT variable, any_value(n1) AS n1, any_value(n2) AS n2, max(abs(k1 / n1 - k2 / n2)) AS ks FROM c GROUP BY 1),
p AS (SELECT variable, n1, n2, ks, sqrt(n1 * n2 / (n1 + n2)) * ks AS lam FROM d)
"""


@query("k5_ks_two_sample", _KS_SQL + """
SELECT variable, CAST(n1 AS BIGINT) AS n1, CAST(n2 AS BIGINT) AS n2, round(ks, 9) AS ks,
       round(CASE WHEN lam < 0.2 THEN 1.0 ELSE least(1.0, greatest(0.0,
         (SELECT sum(2 * (CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END) * exp(-2 * k * k * lam * lam))
          FROM range(1, 101) r(k)))) END, 6) AS p_value
FROM p""")
def k5_ks(spark, d):
    o = Tables(spark, d).orders.withColumn("o_month", F.month("o_orderdate").cast("double"))
    a = o.filter(F.col("o_orderstatus") == "F")
    b = o.filter(F.col("o_orderstatus") == "O")
    ks = st.ks_2samp(a, b, ["o_totalprice", "o_month"])
    return ks.select("variable", "n1", "n2", F.round("ks", 9).alias("ks"), F.round("p_value", 6).alias("p_value"))


@query("k6_chi_square_shares", """
WITH a AS (SELECT o_orderpriority AS c, count(*) AS na FROM orders WHERE year(o_orderdate) < 1999 GROUP BY 1),
b AS (SELECT o_orderpriority AS c, count(*) AS nb FROM orders WHERE year(o_orderdate) >= 1999 GROUP BY 1),
j AS (SELECT coalesce(na, 0) AS na, coalesce(nb, 0) AS nb FROM a FULL OUTER JOIN b USING (c)),
s AS (SELECT sum((nb - na / (SELECT sum(na) FROM j) * (SELECT sum(nb) FROM j)) ^ 2
                 / (na / (SELECT sum(na) FROM j) * (SELECT sum(nb) FROM j))) AS chi2, count(*) - 1 AS dof FROM j)
SELECT round(chi2, 6) AS chi2, dof, round(exp(-chi2 / 2) * (1 + chi2 / 2), 6) AS p_value FROM s""")
def k6_chi2(spark, d):
    o = Tables(spark, d).orders
    r = st.chi2_shares(o.filter(F.year("o_orderdate") < 1999), o.filter(F.year("o_orderdate") >= 1999), "o_orderpriority")
    return r.select(F.round("chi2", 6).alias("chi2"), "dof", F.round("p_value", 6).alias("p_value"))


_CORR_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("k7_pearson_matrix", " UNION ALL ".join(
    f"SELECT '{a}' AS var1, '{b}' AS var2, round(corr({a}, {b}), 9) AS corr FROM lineitem"
    for i, a in enumerate(_CORR_COLS) for b in _CORR_COLS[i:]))
def k7_pearson(spark, d):
    m = st.pearson_matrix(Tables(spark, d).lineitem, _CORR_COLS)
    return m.withColumn("corr", F.round("corr", 9))


_SP_COLS = ["o_totalprice", "o_custkey"]


@query("k7_spearman_matrix", """
WITH r AS (SELECT rank() OVER (ORDER BY o_totalprice) + (count(*) OVER (PARTITION BY o_totalprice) - 1) / 2.0 AS a,
                  rank() OVER (ORDER BY o_custkey) + (count(*) OVER (PARTITION BY o_custkey) - 1) / 2.0 AS b FROM orders)
SELECT 'o_totalprice' AS var1, 'o_totalprice' AS var2, round(corr(a, a), 9) AS corr FROM r
UNION ALL SELECT 'o_totalprice', 'o_custkey', round(corr(a, b), 9) FROM r
UNION ALL SELECT 'o_custkey', 'o_custkey', round(corr(b, b), 9) FROM r""")
def k7_spearman(spark, d):
    m = st.spearman_matrix(Tables(spark, d).orders, _SP_COLS, "o_orderkey")
    return m.withColumn("corr", F.round("corr", 9))


@query("k8_target_correlation_filter", " UNION ALL ".join(
    f"SELECT '{c}' AS variable, round(corr({c}, l_extendedprice), 9) AS corr, round(abs(corr({c}, l_extendedprice)), 9)"
    f" AS abs_corr, abs(corr({c}, l_extendedprice)) >= 0.1 AS keep FROM lineitem" for c in ["l_quantity", "l_discount", "l_tax"]))
def k8_target(spark, d):
    t = st.target_correlation(Tables(spark, d).lineitem, "l_extendedprice", ["l_quantity", "l_discount", "l_tax"])
    return t.select("variable", F.round("corr", 9).alias("corr"), F.round("abs_corr", 9).alias("abs_corr"), "keep")


_ANOVA_SQL = """
WITH l AS (SELECT c_mktsegment AS g, 'c_acctbal' AS variable, c_acctbal AS x FROM customer
           UNION ALL SELECT c_mktsegment, 'c_nationkey', CAST(c_nationkey AS DOUBLE) FROM customer),
s AS (SELECT variable, g, count(*) AS n, sum(x) AS sx, sum(x * x) AS ssx FROM l GROUP BY 1, 2),
t AS (SELECT variable, sum(n) AS nn, count(*) AS k, sum(sx) AS s, sum(ssx) AS ss, sum(sx * sx / n) AS b FROM s GROUP BY 1)
"""


@query("k10_anova_f_scores", _ANOVA_SQL + """
SELECT variable, round(((b - s * s / nn) / (k - 1)) / ((ss - b) / (nn - k)), 6) AS f_score,
       k - 1 AS df_between, CAST(nn - k AS BIGINT) AS df_within FROM t""")
def k10_anova(spark, d):
    a = st.anova_f(Tables(spark, d).customer, "c_mktsegment", ["c_acctbal", "c_nationkey"])
    return a.select("variable", F.round("f_score", 6).alias("f_score"), "df_between", "df_within")


@query("k10_anova_p_values", _ANOVA_SQL + """,
f AS (SELECT variable, ((b - s * s / nn) / (k - 1)) / ((ss - b) / (nn - k)) AS f, k - 1 AS d1, nn - k AS d2 FROM t),
x AS (SELECT *, d2 / (d2 + d1 * f) AS x FROM f)
SELECT variable, round(f, 6) AS f_score, d1 AS df_between, CAST(d2 AS BIGINT) AS df_within,
       round(pow(x, d2 / 2.0) * (1 + (d2 / 2.0) * (1 - x)), 6) AS p_value FROM x""")
def k10_anova_p(spark, d):
    """F tail through the regularised incomplete beta; the oracle uses the
    closed form for an even numerator dof (5 segments -> 4)."""
    a = st.anova_f(Tables(spark, d).customer, "c_mktsegment", ["c_acctbal", "c_nationkey"])
    return a.select("variable", F.round("f_score", 6).alias("f_score"), "df_between", "df_within",
                    F.round("p_value", 6).alias("p_value"))


@query("k10_f_regression_k_best", """
SELECT variable, round(f, 6) AS f_score FROM (
  SELECT 'l_quantity' AS variable, corr(l_quantity, l_extendedprice) ^ 2 / (1 - corr(l_quantity, l_extendedprice) ^ 2)
         * (count(*) - 2) AS f FROM lineitem
  UNION ALL SELECT 'l_discount', corr(l_discount, l_extendedprice) ^ 2 / (1 - corr(l_discount, l_extendedprice) ^ 2)
         * (count(*) - 2) FROM lineitem
  UNION ALL SELECT 'l_tax', corr(l_tax, l_extendedprice) ^ 2 / (1 - corr(l_tax, l_extendedprice) ^ 2)
         * (count(*) - 2) FROM lineitem) ORDER BY f DESC LIMIT 2""")
def k10_freg(spark, d):
    s = st.f_regression(Tables(spark, d).lineitem, "l_extendedprice", ["l_quantity", "l_discount", "l_tax"])
    return st.select_k_best(s, 2).select("variable", F.round("f_score", 6).alias("f_score"))


@query("k11_variance_threshold", " UNION ALL ".join(
    f"SELECT '{c}' AS variable, round(var_pop({c}), 9) AS variance, var_pop({c}) > 0.001 AS keep FROM lineitem"
    for c in _CORR_COLS))
def k11_variance(spark, d):
    v = st.variance_threshold(Tables(spark, d).lineitem, _CORR_COLS, threshold=0.001)
    return v.select("variable", F.round("variance", 9).alias("variance"), "keep")


@query("k12_varclus")
def k12_varclus(spark, d):
    """Variable clustering from one distributed correlation matrix (rows-only)."""
    li = Tables(spark, d).lineitem.withColumn("l_rev", F.col("l_extendedprice") * (1 - F.col("l_discount")))
    return st.varclus(li, ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_rev"])


@query("k13_kruskal_wallis", """
WITH r AS (SELECT c_mktsegment AS g, rank() OVER (ORDER BY c_acctbal)
                  + (count(*) OVER (PARTITION BY c_acctbal) - 1) / 2.0 AS rk FROM customer),
s AS (SELECT g, count(*) AS n, sum(rk) AS rs FROM r GROUP BY 1),
t AS (SELECT sum(n) AS nn, count(*) AS k, sum(rs * rs / n) AS q FROM s),
ti AS (SELECT sum(c * c * c - c) AS tt FROM (SELECT count(*) AS c FROM customer GROUP BY c_acctbal)),
h AS (SELECT (12.0 / (nn * (nn + 1)) * q - 3 * (nn + 1)) / (1 - tt / (nn * nn * nn - nn)) AS h, k - 1 AS dof FROM t, ti)
SELECT round(h, 6) AS h, dof, round(exp(-h / 2) * (1 + h / 2), 6) AS p_value FROM h""")
def k13_kruskal(spark, d):
    k = st.kruskal_wallis(Tables(spark, d).customer, "c_mktsegment", "c_acctbal")
    return k.select(F.round("h", 6).alias("h"), "dof", F.round("p_value", 6).alias("p_value"))


@query("k14_tukey_statistics", """
WITH g AS (SELECT c_mktsegment AS grp, count(*) AS n, avg(c_acctbal) AS m, var_samp(c_acctbal) AS v FROM customer GROUP BY 1),
t AS (SELECT sum((n - 1) * v) / (sum(n) - count(*)) AS mse FROM g)
SELECT a.grp AS group1, b.grp AS group2, round(b.m - a.m, 6) AS meandiff,
       round(abs(b.m - a.m) / sqrt(mse / 2 * (1.0 / a.n + 1.0 / b.n)), 6) AS q
FROM g a JOIN g b ON a.grp < b.grp, t""")
def k14_tukey_stats(spark, d):
    r = st.tukey_hsd(Tables(spark, d).customer, "c_mktsegment", "c_acctbal")
    return r.select("group1", "group2", F.round("meandiff", 6).alias("meandiff"), F.round("q", 6).alias("q"))


@query("k14_tukey_hsd")
def k14_tukey(spark, d):
    """Tukey HSD with studentized-range p-values (numerical; no SQL equivalent)."""
    return st.tukey_hsd(Tables(spark, d).customer, "c_mktsegment", "c_acctbal")


@query("k15_equal_width_labels", """
WITH mm AS (SELECT min(p_retailprice) AS lo, max(p_retailprice) AS hi FROM part),
b AS (SELECT p_retailprice AS x, least(CAST(floor(10 * (p_retailprice - lo) / (hi - lo)) AS BIGINT) + 1, 10) AS bin
      FROM part, mm),
r AS (SELECT bin, min(x) AS mn, max(x) AS mx, count(*) AS n FROM b GROUP BY 1)
SELECT lpad(CAST(bin AS VARCHAR), 2, '0') || '. ' || CAST(mn AS VARCHAR) || '|' || CAST(mx AS VARCHAR) AS d_p_retailprice,
       n FROM r""")
def k15_labels(spark, d):
    p = st.equal_width_labels(Tables(spark, d).part, "p_retailprice", 10)
    return p.groupBy("d_p_retailprice").agg(F.count(F.lit(1)).alias("n"))


@query("k16_quantile_bins", """
WITH e AS (SELECT list_sort(list_distinct(quantile_cont(o_totalprice, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]))) AS e
           FROM orders)
SELECT greatest(1, len(list_filter(e, lambda v: v < o_totalprice))) AS bin, count(*) AS n FROM orders, e GROUP BY 1""")
def k16_qbins(spark, d):
    o = Tables(spark, d).orders
    edges = st.edges_literal(o, "o_totalprice", 10)
    return o.groupBy(st.bin_by_edges("o_totalprice", edges).cast("bigint").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


@query("k17_fixed_edge_cut", """
SELECT CASE WHEN c_acctbal < -1000 OR c_acctbal > 10000 THEN NULL
            ELSE greatest(1, len(list_filter([-1000.0, 0.0, 2500.0, 5000.0, 10000.0], lambda v: v < c_acctbal))) END AS bin,
       count(*) AS n FROM customer GROUP BY 1""")
def k17_fixed(spark, d):
    c = Tables(spark, d).customer
    return c.groupBy(st.fixed_edges_bucket("c_acctbal", [-1000, 0, 2500, 5000, 10000]).cast("bigint").alias("bin")) \
        .agg(F.count(F.lit(1)).alias("n"))
