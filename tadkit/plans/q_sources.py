"""Registered queries: sources, sinks, catalog (A1-A19), file sampling (F8), UDFs.

Round-trip queries write data Spark derives from the fixture tables into a
fresh location under the shared checkpoint folder, read it back through the
operator under test, and are checked against the original table in SQL.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from tadkit.functions import udf as ud
from tadkit.sources import files as fs
from tadkit.sources import tables as tb
from tadkit.plans.registry import query
from tadkit.session import Tables, scratch_path


@query("a1_csv_scan_header_infer", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def a1_csv(spark, d):
    path = scratch_path(spark, "a1")
    fs.write_csv(Tables(spark, d).orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"), path)
    df = fs.read_csv(spark, path)
    return df.select(F.col("o_orderkey").cast("bigint"), F.col("o_custkey").cast("bigint"), "o_orderstatus",
                     F.col("o_totalprice").cast("double"))


@query("a2_csv_options_sep_nullmarker", """
SELECT c_custkey, CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN NULL ELSE c_mktsegment END AS segment FROM customer""")
def a2_csv_opts(spark, d):
    path = scratch_path(spark, "a2")
    c = Tables(spark, d).customer.select(
        "c_custkey", "c_name", F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit("?")).otherwise(F.col("c_mktsegment")).alias("seg"))
    fs.write_csv(c, path, header=False, sep="|")
    schema = "c_custkey string, c_name string, segment string"
    df = fs.read_csv(spark, path, header=False, sep="|", null_value="?", schema=schema, columns=["c_custkey", "segment"])
    return df.select(F.col("c_custkey").try_cast("bigint").alias("c_custkey"), "segment")


@query("a3_json_lines_schema", "SELECT event_id, user_id, event_type, value FROM events")
def a3_json(spark, d):
    path = scratch_path(spark, "a3")
    Tables(spark, d).events.select("event_id", "user_id", "event_type", "value").write.mode("overwrite").json(path)
    schema = StructType([StructField("event_id", LongType()), StructField("user_id", LongType()),
                         StructField("event_type", StringType()), StructField("value", DoubleType())])
    typed = fs.read_json(spark, path, schema=schema)
    inferred = fs.read_json(spark, path)
    assert set(inferred.columns) == set(typed.columns)
    return typed


@query("a4_json_catalog_lookup", "SELECT CAST(n_nationkey AS VARCHAR) AS key, n_name AS value FROM nation")
def a4_catalog(spark, d):
    path = scratch_path(spark, "a4")
    n = Tables(spark, d).nation
    n.agg(F.collect_list(F.struct(F.col("n_nationkey").alias("key"), F.col("n_name").alias("value"))).alias("nation")) \
        .coalesce(1).write.mode("overwrite").json(path)          # 25-row dimension -> one catalog document
    return fs.read_catalog(spark, path, "nation")


@query("a4_json_code_map", """
SELECT CAST(n_nationkey AS VARCHAR) AS key, n_name AS value FROM nation""")
def a4_codes(spark, d):
    """``{column: {code: label}}`` read as a lookup of one column."""
    path = scratch_path(spark, "a4map")
    n = Tables(spark, d).nation
    pairs = F.map_from_entries(F.collect_list(F.struct(F.col("n_nationkey").cast("string"), F.col("n_name"))))
    n.agg(pairs.alias("nation")).coalesce(1).write.json(path)
    return fs.read_code_map(spark, path, "nation")


@query("a5_glob_scan_name_from_path", "SELECT o_orderstatus AS status, count(*) AS n FROM orders GROUP BY 1")
def a5_glob(spark, d):
    path = scratch_path(spark, "a5")
    fs.write_parquet(Tables(spark, d).orders, path, partition_by=["o_orderstatus"])
    df = fs.read_glob(spark, path, r"o_orderstatus=([A-Z]+)", "status", fmt="parquet")
    return df.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query("a6_typed_ingest_to_parquet", """
SELECT l_returnflag AS stock, count(*) AS n, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS qty,
       min(CAST(l_shipdate AS DATE)) AS first_day FROM lineitem GROUP BY 1""")
def a6_ingest(spark, d):
    src = scratch_path(spark, "a6src")
    li = Tables(spark, d).lineitem.select(F.date_format("l_shipdate", "yyyy-MM-dd").alias("date"),
                                          F.col("l_quantity").cast("string").alias("qty"), F.lit("x").alias("junk"),
                                          F.col("l_returnflag").alias("stock"))
    li.write.mode("overwrite").partitionBy("stock").option("header", True).csv(src)
    out = fs.typed_ingest(spark, src, scratch_path(spark, "a6dst"), "date", "yyyy-MM-dd", ["junk"],
                          r"stock=([A-Z]+)", "stock")
    return out.groupBy("stock").agg(F.count(F.lit(1)).alias("n"),
                                    F.sum(F.col("qty").cast("decimal(18,2)")).cast("double").alias("qty"),
                                    F.min("date").alias("first_day"))


@query("a7_parquet_overwrite_wildcard", "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1")
def a7_parquet(spark, d):
    path = scratch_path(spark, "a7")
    o = Tables(spark, d).orders
    fs.write_parquet(o, path)                                            # first write ...
    fs.write_parquet(o.repartition(4), path)                             # ... replaced by the overwrite
    return fs.read_parquet(spark, path + "/*.parquet").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@query("a8_table_with_declared_types", """
SELECT o_orderstatus, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS total FROM orders GROUP BY 1""")
def a8_declared(spark, d):
    name = "tk_orders_typed"
    tb.write_table(Tables(spark, d).orders, name, {"o_totalprice": "decimal(12,2)", "o_orderdate": "date"},
                   path=scratch_path(spark, "a8"))
    t = spark.table(name)
    assert dict(t.dtypes)["o_totalprice"] == "decimal(12,2)"
    return t.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").cast("double").alias("total"))


@query("a9_sql_query_read", """
SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1""")
def a9_query(spark, d):
    tb.register(Tables(spark, d).orders, "tk_a9_orders")
    return tb.read_query(spark, "SELECT o_custkey, count(*) AS n FROM tk_a9_orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1")


@query("a10_csv_sink_roundtrip", "SELECT * FROM lineitem")
def a10_sink(spark, d):
    """Every column of the file, read back with inferred types and cast to those of the table."""
    path, li = scratch_path(spark, "a10"), Tables(spark, d).lineitem
    fs.write_csv(li, path)
    return fs.read_csv(spark, path).select(*[F.col(c).cast(t).alias(c) for c, t in li.dtypes])


@query("a11_libsvm_roundtrip", "SELECT CAST(label AS DOUBLE) AS label, CAST(embedding AS DOUBLE[]) AS embedding FROM embeddings")
def a11_libsvm(spark, d):
    """All values of the vectors, read back."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    path = scratch_path(spark, "a11")
    e = Tables(spark, d).embeddings.select(F.col("label").cast("double").alias("label"),
                                           array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
    fs.write_libsvm(e, path)
    return fs.read_libsvm(spark, path, num_features=64).select("label", vector_to_array("features").alias("embedding"))


@query("a12_create_table_as_select", """
SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_totalprice > 100000 GROUP BY 1""")
def a12_ctas(spark, d):
    tb.register(Tables(spark, d).orders, "tk_a12_orders")
    t = tb.ctas(spark, "tk_a12_big_orders", "SELECT * FROM tk_a12_orders WHERE o_totalprice > 100000",
                location=scratch_path(spark, "a12"))
    return t.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query("a13_temp_view_sql", """
SELECT c_mktsegment, count(*) AS n, round(avg(c_acctbal), 6) AS bal FROM customer GROUP BY 1""")
def a13_view(spark, d):
    tb.register(Tables(spark, d).customer, "tk_a13_customer")
    return spark.sql("SELECT c_mktsegment, count(*) AS n, round(avg(c_acctbal), 6) AS bal FROM tk_a13_customer GROUP BY 1")


@query("a16_union_compatibility_check", """
SELECT 'part_' || o_orderstatus AS part, true AS same_columns, 6 AS n_columns, count(*) AS rows FROM orders GROUP BY 1""")
def a16_parts(spark, d):
    base = scratch_path(spark, "a16")
    o = Tables(spark, d).orders
    paths = []
    for s in [r[0] for r in o.select("o_orderstatus").distinct().orderBy("o_orderstatus").collect()]:     # one part file each
        p = f"{base}/part_{s}"
        fs.write_parquet(o.filter(F.col("o_orderstatus").eqNullSafe(s)), p)
        paths.append(p)
    out = fs.check_parts(spark, paths)
    return out.select(F.regexp_extract("part", r"(part_[^/]+)$", 1).alias("part"), "same_columns", "n_columns",
                      F.col("rows").cast("bigint").alias("rows"))


@query("a19_cached_intermediate", """
SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1""")
def a19_cache(spark, d):
    per = Tables(spark, d).orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return fs.persist_stage(per, reliable=True)


@query("f8_sample_of_files")
def f8_files(spark, d):
    """Seeded choice of files before the scan (random: rows-only)."""
    path = scratch_path(spark, "f8")
    fs.write_parquet(Tables(spark, d).lineitem.repartition(8), path)
    chosen = fs.sample_files(spark, path + "/*.parquet", 0.5, seed=3)
    return spark.read.parquet(*chosen)


# ---- UDF surfaces ----------------------------------------------------------
def _yyyymm(s: pd.Series) -> pd.Series:
    return pd.to_datetime(s).dt.strftime("%Y%m")


@query("i1_scalar_udf_then_cast", "SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m') AS INTEGER) AS ym FROM orders")
def i1_udf(spark, d):
    f = ud.vectorized(_yyyymm, "string")
    return Tables(spark, d).orders.select("o_orderkey", f(F.col("o_orderdate")).cast("int").alias("ym"))


def _unit_price(price: pd.Series, qty: pd.Series) -> pd.Series:
    return price / qty


@query("i2_rowwise_multi_column_udf", """
SELECT l_orderkey, l_linenumber, l_extendedprice / l_quantity AS unit_price FROM lineitem""")
def i2_rowwise(spark, d):
    f = ud.vectorized(_unit_price, "double")
    return Tables(spark, d).lineitem.select("l_orderkey", "l_linenumber", f("l_extendedprice", "l_quantity").alias("unit_price"))


@query("i3_custom_group_aggregate", """
SELECT l_partkey, round(avg(r), 6) AS mean_change FROM (
  SELECT l_partkey, l_extendedprice / lag(l_extendedprice) OVER (PARTITION BY l_partkey ORDER BY l_shipdate, l_orderkey, l_linenumber) - 1 AS r
  FROM lineitem) GROUP BY 1""")
def i3_udaf(spark, d):
    li = Tables(spark, d).lineitem
    out = ud.mean_of_lag_ratio(li, ["l_partkey"], ["l_shipdate", "l_orderkey", "l_linenumber"], "l_extendedprice", "mean_change")
    return out.withColumn("mean_change", F.round("mean_change", 6))


def _text_stats(s: pd.Series) -> pd.DataFrame:
    return pd.DataFrame({"n_chars": s.str.len().astype("int64"), "n_newlines": s.str.count("\n").astype("int64"),
                         "n_digits": s.str.count("[0-9]").astype("int64")})


@query("i4_struct_returning_udf", """
SELECT doc_id, length(text) AS n_chars, length(text) - length(replace(text, chr(10), '')) AS n_newlines,
       length(regexp_replace(text, '[^0-9]', '', 'g')) AS n_digits FROM documents""")
def i4_struct(spark, d):
    f = ud.struct_udf(_text_stats, "n_chars long, n_newlines long, n_digits long")
    return Tables(spark, d).documents.select("doc_id", f("text").alias("s")).select("doc_id", "s.*")


def _rank_in_group(pdf: pd.DataFrame) -> pd.DataFrame:
    key = pdf["o_orderkey"].to_numpy()
    order = np.lexsort((key, -pdf["o_totalprice"].to_numpy(float)))       # missing values last
    return pd.DataFrame({"o_orderkey": key[order], "rk": np.arange(1, len(key) + 1)})


@query("i5_per_group_pandas_frame", """
SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rk
FROM orders""")
def i5_group(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", "o_totalprice", "o_custkey")
    out = ud.per_group_frame(o, ["o_custkey"], _rank_in_group, "o_orderkey long, rk long")
    return out.select("o_orderkey", F.col("rk").cast("bigint").alias("rk"))
