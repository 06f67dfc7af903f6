"""File sources and sinks.

One glob scan replaces per-file loops; the file of origin comes from the
hidden ``_metadata`` column, so tagging rows by file name costs no extra pass.
"""

from __future__ import annotations

import random
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tadkit.session import cut_lineage


# A1 / A2 -------------------------------------------------------------------
def read_csv(spark: SparkSession, path: str, header: bool = True, infer: bool = True, sep: str = ",",
             null_value: str | None = None, schema: StructType | str | None = None,
             columns: Sequence[str] | None = None, quote: str = '"') -> DataFrame:
    """CSV scan.  With ``columns`` only those are returned (Catalyst prunes the
    scan); ``schema`` of strings + ``try_cast`` downstream mimics pandas'
    ``errors='coerce'``."""
    r = spark.read.option("header", header).option("sep", sep).option("quote", quote)
    if null_value is not None:
        r = r.option("nullValue", null_value)
    if schema is not None:
        r = r.schema(schema)
    else:
        r = r.option("inferSchema", infer)
    df = r.csv(path)
    return df.select(*columns) if columns else df


def write_csv(df: DataFrame, path: str, header: bool = True, sep: str = ",", mode: str = "overwrite") -> None:
    """A10: CSV sink (one file per partition; coalescing is left to the caller)."""
    df.write.mode(mode).option("header", header).option("sep", sep).csv(path)


# A3 ------------------------------------------------------------------------
def read_json(spark: SparkSession, path: str, schema: StructType | str | None = None, multiline: bool = False) -> DataFrame:
    r = spark.read.option("multiLine", multiline)
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


# A4 ------------------------------------------------------------------------
def read_catalog(spark: SparkSession, path: str, name: str, key: str = "key", value: str = "value") -> DataFrame:
    """``{catalog: [{key, value}, ...]}`` JSON file -> (key, value) lookup table."""
    raw = spark.read.option("multiLine", True).json(path)
    return raw.select(F.explode(F.col(f"`{name}`")).alias("_e")).select(
        F.col(f"_e.{key}").cast("string").alias("key"), F.col(f"_e.{value}").cast("string").alias("value"))


def read_code_map(spark: SparkSession, path: str, column: str) -> DataFrame:
    """``{col: {code: label}}`` JSON file -> (key, value) for one column."""
    raw = spark.read.option("multiLine", True).option("primitivesAsString", True).json(path)
    entries = F.map_entries(F.from_json(F.to_json(F.col(f"`{column}`")), "map<string,string>"))
    return raw.select(F.explode(entries).alias("_e")).select(F.col("_e.key").alias("key"), F.col("_e.value").alias("value"))


# A5 ------------------------------------------------------------------------
def read_glob(spark: SparkSession, pattern: str, name_regex: str, as_col: str, fmt: str = "csv",
              **options) -> DataFrame:
    """Multi-file scan tagging each row with a value parsed from its file path."""
    r = spark.read.format(fmt).option("recursiveFileLookup", "true")
    for k, v in options.items():
        r = r.option(k, v)
    df = r.load(pattern)
    return df.withColumn(as_col, F.regexp_extract(F.col("_metadata.file_path"), name_regex, 1))


# A6 ------------------------------------------------------------------------
def typed_ingest(spark: SparkSession, src: str, dst: str, date_col: str, date_fmt: str, drop: Sequence[str],
                 entity_regex: str, entity_col: str, partition: bool = True) -> DataFrame:
    """CSV (all strings) -> parsed date, dropped columns, other columns to
    double (bad values -> null), entity from the file name -> Parquet
    partitioned by entity.  Returns the re-read table."""
    raw = spark.read.option("header", True).option("inferSchema", False).csv(src)
    raw = raw.withColumn(entity_col, F.regexp_extract(F.col("_metadata.file_path"), entity_regex, 1))
    keep = [c for c in raw.columns if c not in set(drop) | {date_col, entity_col}]
    out = raw.select(F.try_to_timestamp(F.col(date_col), F.lit(date_fmt)).cast("date").alias(date_col),
                     *[F.col(c).try_cast("double").alias(c) for c in keep], entity_col)
    w = out.write.mode("overwrite")
    (w.partitionBy(entity_col) if partition else w).parquet(dst)
    return spark.read.parquet(dst)


# A7 ------------------------------------------------------------------------
def read_parquet(spark: SparkSession, pattern: str) -> DataFrame:
    return spark.read.parquet(pattern)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


# A11 -----------------------------------------------------------------------
def read_libsvm(spark: SparkSession, path: str, num_features: int | None = None) -> DataFrame:
    r = spark.read.format("libsvm")
    if num_features:
        r = r.option("numFeatures", num_features)
    return r.load(path)


def write_libsvm(df: DataFrame, path: str, label: str = "label", features: str = "features") -> None:
    df.select(label, features).write.mode("overwrite").format("libsvm").save(path)


# A16 -----------------------------------------------------------------------
def check_parts(spark: SparkSession, paths: Sequence[str], fmt: str = "parquet") -> DataFrame:
    """Per part: columns identical to the first part? rows per part; plus the
    union total.  Schemas come from file footers; counts from one grouped scan."""
    schemas = [spark.read.format(fmt).load(p).columns for p in paths]
    ref = schemas[0]
    allp = spark.read.format(fmt).load(list(paths)).withColumn("_f", F.col("_metadata.file_path"))
    counts = allp.groupBy("_f").agg(F.count(F.lit(1)).alias("rows"))
    meta = spark.createDataFrame([(p, s == ref, len(s)) for p, s in zip(paths, schemas)],
                                 "part string, same_columns boolean, n_columns int")
    per = counts.withColumn("part", F.regexp_extract("_f", r"^(.*)/[^/]+$", 1)).groupBy("part").agg(F.sum("rows").alias("rows"))
    norm = meta.withColumn("part", F.regexp_replace("part", "^file:", ""))
    per = per.withColumn("part", F.regexp_replace("part", "^file:", ""))
    return norm.join(per, "part", "left")


# A17 -----------------------------------------------------------------------
def read_labelled_images(spark: SparkSession, root: str, label_regex: str = r"/([^/]+)/[^/]+$") -> DataFrame:
    """Image folder scan; class from the parent folder (flatten with ``pixels``)."""
    img = spark.read.format("image").option("recursiveFileLookup", "true").load(root)
    return img.select(F.col("image.origin").alias("path"),
                      F.regexp_extract("image.origin", label_regex, 1).alias("label"),
                      F.col("image.height").alias("height"), F.col("image.width").alias("width"),
                      F.col("image.nChannels").alias("channels"), F.col("image.data").alias("data"))


def pixels(df: DataFrame, data: str = "data", scale: float = 1.0) -> DataFrame:
    """Binary pixel buffer -> array<double> (unsigned bytes, optionally scaled)."""
    arr = F.transform(F.sequence(F.lit(1), F.length(data)),
                      lambda i: F.conv(F.hex(F.substring(F.col(data), i, 1)), 16, 10).cast("double") / scale)
    return df.withColumn("pixels", arr)


# F8 ------------------------------------------------------------------------
def sample_files(spark: SparkSession, pattern: str, fraction: float, seed: int) -> list[str]:
    """Seeded choice of files before the scan (file listing only, no data)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(pattern)
    fs = p.getFileSystem(conf)
    files = sorted(str(s.getPath().toString()) for s in (fs.globStatus(p) or []))
    k = max(1, int(round(len(files) * fraction)))
    return sorted(random.Random(seed).sample(files, min(k, len(files))))


# A19 -----------------------------------------------------------------------
def persist_stage(df: DataFrame, reliable: bool = False) -> DataFrame:
    """Cache an intermediate reused by several branches, or cut its lineage
    with a reliable checkpoint (survives executor loss)."""
    return cut_lineage(df) if reliable else df.cache()
