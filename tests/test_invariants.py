"""Invariants in the style of the original workflow's own checks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tadkit.operators import joins as jn
from tadkit.operators import quality as qu
from tadkit.operators import segment as sg
from tadkit.operators import stats as st
from tadkit.plans.tad import supplier_nation_tad
from tadkit.session import Tables, scratch_path

SF = "/root/testdata/sf0.001"


def test_parts_reconcile_with_whole(spark):
    """Sum of part row counts equals the whole; every part has the same columns."""
    from tadkit.sources.files import check_parts, write_parquet
    o = Tables(spark, SF).orders
    base = scratch_path(spark, "inv-parts")
    paths = []
    for s in ["F", "O", "P"]:
        write_parquet(o.filter(F.col("o_orderstatus") == s), f"{base}/{s}")
        paths.append(f"{base}/{s}")
    rows = check_parts(spark, paths).collect()
    assert all(r["same_columns"] for r in rows)
    assert sum(r["rows"] for r in rows) == o.count()


def test_tad_one_row_per_unit_and_totals_reconcile(spark):
    t = Tables(spark, SF)
    tad = supplier_nation_tad(t.lineitem, t.supplier, t.nation)
    assert tad.count() == tad.select("company").distinct().count()
    lines = t.lineitem.join(t.supplier.select(F.col("s_suppkey").alias("l_suppkey")), "l_suppkey").count()
    per_company = tad.agg(F.sum(F.col("trips_avg") * F.col("n_taxis"))).first()[0]
    assert per_company == pytest.approx(lines)
    months = tad.select(sum(F.col(f"total_m{m:02d}") for m in range(1, 13)).alias("s"), "total_year").collect()
    assert all(r["s"] == pytest.approx(r["total_year"]) for r in months)


def test_assemble_tad_keeps_the_spine(spark):
    t = Tables(spark, SF)
    parts = [t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n"))]
    tad = jn.assemble_tad(t.customer, parts, "c_custkey")
    assert tad.count() == t.customer.count() and tad.filter(F.col("n").isNull()).count() == 0


def test_imputation_keeps_distribution(spark):
    """KS between a column and its median-imputed version stays below 0.1
    when few values are missing (the damage check used before modelling)."""
    o = Tables(spark, SF).orders
    holes = o.select(F.when(F.dayofmonth("o_orderdate") == 1, None).otherwise(F.col("o_totalprice")).alias("p"))
    imputed = qu.impute(holes, ["p"], "median")
    ks = st.ks_2samp(holes.filter(F.col("p").isNotNull()), imputed, ["p"]).first()
    assert ks["ks"] < 0.1


def test_logistic_auc_range_on_separable_data(spark):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    from tadkit.operators.metrics import binary_auc
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(0, 1, 200), rng.normal(3, 1, 200)])
    y = [0] * 200 + [1] * 200
    df = spark.createDataFrame([(float(a), b) for a, b in zip(x, y)], "x double, label int")
    m = LogisticRegression().fit(VectorAssembler(inputCols=["x"], outputCol="features").transform(df))
    pred = m.transform(VectorAssembler(inputCols=["x"], outputCol="features").transform(df))
    from pyspark.ml.functions import vector_to_array
    auc = binary_auc(pred.withColumn("s", vector_to_array("probability")[1]), "label", "s").first()["auc"]
    assert 0.95 < auc <= 1.0


def test_known_answer_clusters(spark):
    """Two well separated groups of equal size give two equal clusters."""
    rng = np.random.default_rng(5)
    pts = np.vstack([rng.normal(0, 0.1, (50, 2)), rng.normal(10, 0.1, (50, 2))])
    df = spark.createDataFrame([(i, [float(a), float(b)]) for i, (a, b) in enumerate(pts)], "id long, x array<double>")
    from pyspark.ml.functions import array_to_vector
    v = df.withColumn("features", array_to_vector("x"))
    sizes = sorted(r["n"] for r in sg.kmeans(v, "features", 2).transform(v).groupBy("cluster").count()
                   .withColumnRenamed("count", "n").collect())
    assert sizes == [50, 50]
    found = {r["cluster"] for r in sg.dbscan(df, "id", "x", eps=1.0, min_samples=4).collect()}
    assert found == {0, 1}


def test_cleaning_keeps_keys_unique(spark):
    o = Tables(spark, SF).orders
    kept = qu.drop_key_violations(o, "o_custkey", ["o_orderdate"])
    assert kept.groupBy("o_custkey", "o_orderdate").count().filter("count > 1").count() == 0


def test_tad_two_formulations_agree(spark):
    """The flagship TAD through the DataFrame operators and through Spark SQL
    over temp views give the same table."""
    from tadkit.plans.tad import MONTHS
    t = Tables(spark, SF)
    for n in ("lineitem", "supplier", "nation"):
        getattr(t, n).createOrReplaceTempView(f"inv_{n}")
    sql = """
    WITH trips AS (SELECT l_suppkey AS taxi, l_returnflag AS payment,
                          CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4)) AS total FROM inv_lineitem),
    tc AS (SELECT s_suppkey AS taxi_id, n_name AS company FROM inv_supplier JOIN inv_nation ON s_nationkey = n_nationkey),
    t AS (SELECT company, taxi, payment, total FROM trips JOIN tc ON trips.taxi = tc.taxi_id),
    per_taxi AS (SELECT company, taxi, count(*) AS trips, sum(total) AS revenue FROM t GROUP BY company, taxi),
    pay AS (SELECT company, min_by(payment, struct(-cnt, payment)) AS payment_mode
            FROM (SELECT company, payment, count(*) AS cnt FROM t GROUP BY company, payment) GROUP BY company),
    agg AS (SELECT company, count(*) AS n_taxis, max(trips) AS trips_max, CAST(sum(revenue) AS DOUBLE) AS total_year,
                   min_by(taxi, struct(-revenue, taxi)) AS best_taxi FROM per_taxi GROUP BY company)
    SELECT agg.*, pay.payment_mode FROM agg JOIN pay USING (company)"""
    a = {r["company"]: r.asDict() for r in spark.sql(sql).collect()}
    b = {r["company"]: r.asDict() for r in supplier_nation_tad(t.lineitem, t.supplier, t.nation).collect()}
    assert a.keys() == b.keys()
    for c in a:
        for k in ("n_taxis", "trips_max", "total_year", "best_taxi", "payment_mode"):
            assert a[c][k] == b[c][k], (c, k)
    assert len(MONTHS) == 12
