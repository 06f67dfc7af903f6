"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``documents``.  Between stages the rows are written as
Parquet in the shared folder and read again, so a lost executor costs no more
than the running stage; a stage's own tables, and its predecessor's rows, are then deleted.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tadkit.llm.common import prepare, table
from tadkit.llm.mixing import take_mix
from tadkit.llm.neardup import drop_near_duplicates
from tadkit.llm.packing import pack
from tadkit.llm.pii import pseudonymise
from tadkit.llm.quality import drop_low_quality
from tadkit.llm.queries import PII_KEY
from tadkit.session import drop_path, scratch_path, scratch_scope


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the attention model predicts to be of quality 0 go."""
    return drop_low_quality(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component stays."""
    return drop_near_duplicates(docs)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data become pseudonyms."""
    return pseudonymise(docs, PII_KEY).select(docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated, cut or left out by their source's weight."""
    return take_mix(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of sequences of at most 2048 tokens."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json")).drop("ids")


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("pii", pii), ("mixing", mixing), ("packing", packing)]

# The first stage is a trained model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    prepare(spark)
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        with scratch_scope(spark):                   # what a stage writes for itself goes with it
            out = stage(spark, docs, sf_dir)
            out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
        if last:
            drop_path(spark, last)
        last = path
    return STAGES[-1][1](spark, docs, sf_dir)
