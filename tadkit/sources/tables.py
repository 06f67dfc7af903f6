"""Catalog tables, SQL, JDBC and model persistence.

JDBC functions take the connection settings from the caller; nothing here
opens a server.  Locally, managed tables live under the shared checkpoint
folder so tests never touch the working directory.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# A8 ------------------------------------------------------------------------
def cast_declared(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Apply declared SQL types (e.g. ``DECIMAL(10,2)``, ``DATE``) before a write."""
    return df.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns])


def write_table(df: DataFrame, name: str, types: dict[str, str] | None = None, mode: str = "overwrite",
                path: str | None = None, partition_by: Sequence[str] = ()) -> None:
    """Managed (or external, with ``path``) table with declared column types."""
    out = cast_declared(df, types or {})
    w = out.write.mode(mode).format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)


def write_jdbc(df: DataFrame, url: str, table: str, props: dict, types: dict[str, str] | None = None,
               batch_size: int = 100_000, mode: str = "overwrite") -> None:
    """Chunked JDBC write; ``createTableColumnTypes`` carries the declared types."""
    w = df.write.mode(mode).option("batchsize", batch_size)
    if types:
        w = w.option("createTableColumnTypes", ", ".join(f"{c} {t}" for c, t in types.items()))
    w.jdbc(url, table, properties=props)


# A9 ------------------------------------------------------------------------
def read_jdbc_query(spark: SparkSession, url: str, sql: str, props: dict, partition_column: str | None = None,
                    lower: int | None = None, upper: int | None = None, num_partitions: int = 8) -> DataFrame:
    """Query pushed to a database; optionally split into range partitions."""
    r = spark.read.format("jdbc").option("url", url).options(**props)
    if partition_column:
        r = r.option("dbtable", f"({sql}) q").option("partitionColumn", partition_column) \
            .option("lowerBound", lower).option("upperBound", upper).option("numPartitions", num_partitions)
    else:
        r = r.option("query", sql)
    return r.load()


def read_query(spark: SparkSession, sql: str) -> DataFrame:
    """SQL over registered tables / views."""
    return spark.sql(sql)


# A12 / A13 -----------------------------------------------------------------
def ctas(spark: SparkSession, name: str, select_sql: str, location: str | None = None) -> DataFrame:
    """CREATE TABLE AS SELECT (parquet), then read it back from the catalog."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} USING parquet{loc} AS {select_sql}")
    return spark.table(name)


def register(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


# A14 / A15 -------------------------------------------------------------------
def from_pandas(spark: SparkSession, pdf: pd.DataFrame, schema=None) -> DataFrame:
    return spark.createDataFrame(pdf, schema=schema)


def to_pandas_capped(df: DataFrame, max_rows: int = 100_000) -> pd.DataFrame:
    """Small result to the driver, refusing anything over ``max_rows``."""
    head = df.limit(max_rows + 1).toPandas()
    if len(head) > max_rows:
        raise ValueError(f"result has more than {max_rows} rows; write it to a table instead")
    return head


def rows_as_dicts(df: DataFrame, max_rows: int = 10_000) -> list[dict]:
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"result has more than {max_rows} rows")
    return [r.asDict(recursive=True) for r in rows]


# A18 -----------------------------------------------------------------------
def save_fitted(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_fitted(path: str):
    from pyspark.ml import PipelineModel
    return PipelineModel.load(path)


def save_map_table(df: DataFrame, path: str) -> None:
    """Fitted lookup tables (category maps, WoE maps) persisted next to models."""
    df.write.mode("overwrite").parquet(path)
