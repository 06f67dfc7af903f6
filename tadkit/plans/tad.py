"""TAD (one row per unit of analysis) built from a transaction table.

The flagship job: lineitem rows are "trips", a supplier is the "taxi" and its
nation is the "company".  One row per company:

* number of taxis, trips per taxi (avg/max/min), max and mean revenue per taxi
* the best taxi by revenue (tie -> lowest id)
* the most frequent payment type (return flag; tie -> smallest)
* 12 monthly revenue totals, the year total and the best month (tie -> first)

Plan shape (the point of writing it by hand): the fact table is reduced to
partial sums per (taxi, month, payment) *before* it meets the supplier
dimension, so the only wide shuffle carries pre-aggregated rows; all later
steps work on supplier-sized or company-sized data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


MONTHS = list(range(1, 13))


def trips_from_lineitem(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        F.col("l_suppkey").alias("taxi"),
        F.month("l_shipdate").alias("month"),
        F.col("l_returnflag").alias("payment"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("decimal(18,4)").alias("total"))


def company_tad(trips: DataFrame, taxi_company: DataFrame) -> DataFrame:
    """``trips(taxi, month, payment, total)``, ``taxi_company(taxi, company)``."""
    base = trips.groupBy("taxi", "month", "payment").agg(
        F.count(F.lit(1)).alias("n"), F.sum("total").alias("rev"))
    b = base.join(taxi_company, "taxi")

    per_taxi = b.groupBy("company", "taxi").agg(
        F.sum("n").alias("trips"), F.sum("rev").alias("revenue"),
        *[F.sum(F.when(F.col("month") == m, F.col("rev"))).alias(f"m{m:02d}") for m in MONTHS])

    month_tot = [F.coalesce(F.sum(f"m{m:02d}"), F.lit(0)).alias(f"m{m:02d}") for m in MONTHS]
    per_company = per_taxi.groupBy("company").agg(
        F.count(F.lit(1)).alias("n_taxis"),
        F.avg("trips").alias("trips_avg"), F.max("trips").alias("trips_max"),
        F.min("trips").alias("trips_min"),
        F.max("revenue").cast("double").alias("revenue_max"),
        (F.sum("revenue").cast("double") / F.count(F.lit(1))).alias("revenue_avg"),
        F.min_by("taxi", F.struct(-F.col("revenue"), F.col("taxi"))).alias("best_taxi"),
        F.sum("revenue").cast("double").alias("total_year"),
        *month_tot)

    best_month = F.greatest(*[F.struct(F.col(f"m{m:02d}").alias("v"), F.lit(-m).alias("neg_m"))
                              for m in MONTHS])
    per_company = per_company.select(
        "company", "n_taxis", "trips_avg", "trips_max", "trips_min", "revenue_max", "revenue_avg",
        "best_taxi", "total_year",
        *[F.col(f"m{m:02d}").cast("double").alias(f"total_m{m:02d}") for m in MONTHS],
        (-best_month["neg_m"]).alias("best_month"))

    # Both branches read every column of ``b`` (payment is unique per company,
    # so the trailing revenue never changes the order); identical subtrees let
    # Spark reuse the fact-table shuffle instead of scanning it twice.
    pay = b.groupBy("company", "payment").agg(F.sum("n").alias("cnt"), F.sum("rev").alias("prev"),
                                              F.max("month").alias("pm")) \
        .groupBy("company").agg(F.min_by("payment", F.struct(-F.col("cnt"), F.col("payment"),
                                                             F.col("prev"), F.col("pm"))).alias("payment_mode"))
    return per_company.join(pay, "company", "left")


def supplier_nation_tad(lineitem: DataFrame, supplier: DataFrame, nation: DataFrame) -> DataFrame:
    # nation is a fixed 25-row dimension: its scan statistics are far below the
    # broadcast threshold, so the planner broadcasts it without an extra job.
    nat = nation.select("n_nationkey", F.col("n_name").alias("company"))
    taxi_company = supplier.select(F.col("s_suppkey").alias("taxi"), F.col("s_nationkey").alias("n_nationkey")) \
        .join(nat, "n_nationkey").select("taxi", "company")
    return company_tad(trips_from_lineitem(lineitem), taxi_company)


SUPPLIER_NATION_TAD_SQL = """
WITH trips AS (
  SELECT l_suppkey AS taxi, month(l_shipdate) AS month, l_returnflag AS payment,
         CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4)) AS total
  FROM lineitem),
tc AS (SELECT s_suppkey AS taxi, n_name AS company FROM supplier JOIN nation ON s_nationkey = n_nationkey),
t AS (SELECT company, trips.* FROM trips JOIN tc USING (taxi)),
per_taxi AS (
  SELECT company, taxi, count(*) AS trips, sum(total) AS revenue,
         """ + ", ".join(f"sum(total) FILTER (WHERE month = {m}) AS m{m:02d}" for m in MONTHS) + """
  FROM t GROUP BY company, taxi),
pc AS (
  SELECT company, count(*) AS n_taxis, avg(trips) AS trips_avg, max(trips) AS trips_max,
         min(trips) AS trips_min, CAST(max(revenue) AS DOUBLE) AS revenue_max,
         CAST(sum(revenue) AS DOUBLE) / count(*) AS revenue_avg,
         arg_min(taxi, (-revenue, taxi)) AS best_taxi,
         CAST(sum(revenue) AS DOUBLE) AS total_year,
         """ + ", ".join(f"CAST(coalesce(sum(m{m:02d}), 0) AS DOUBLE) AS total_m{m:02d}" for m in MONTHS) + """
  FROM per_taxi GROUP BY company),
pay AS (
  SELECT company, arg_min(payment, (-cnt, payment)) AS payment_mode
  FROM (SELECT company, payment, count(*) AS cnt FROM t GROUP BY company, payment) GROUP BY company)
SELECT pc.*, (SELECT m FROM (VALUES """ + ", ".join(f"({m})" for m in MONTHS) + """) v(m)
              ORDER BY [""" + ", ".join(f"total_m{m:02d}" for m in MONTHS) + """][m] DESC, m LIMIT 1) AS best_month,
       pay.payment_mode
FROM pc LEFT JOIN pay USING (company)
"""
