"""Mixing sources to target weights by Sainte-Laguë apportionment.

A source's documents lie in a fixed number of shards by hash, in seeded order, and
each shard is cut into blocks of equally many words (going round to its start).
Blocks are allotted to sources, and those of a source to its shards, by
highest quotients weight / (2k - 1), which gives whole quotas.  A shard takes
the first blocks of its seeded order, round and round; so what a document
gives follows from its position alone.  DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tadkit.llm.common import written
from tadkit.operators.frame import cumulative_sum

WORD = r"[^\x20\x09-\x0D]+"
_GAP = r"[\x20\x09-\x0D]"


def apportion(units: DataFrame, group: list[str], order: list[str], weight: str, seats: str, out: str) -> DataFrame:
    """Adds ``out``: whole seats of each unit, of ``seats`` (equal within its
    group) in proportion to ``weight`` by Sainte-Laguë's highest quotients.

    With m units the divisor lies within m/2 seats of the ideal one, so a
    unit's seats lie within share * m/2 + 1/2 of its ideal; only the quotients
    in between are ranked, about five a unit.
    """
    per = Window.partitionBy(*group)
    total = F.sum(weight).over(per)
    share = F.when(total > 0, F.col(weight) / total).otherwise(F.lit(0.0))
    ideal = share * F.col(seats)
    slack = share * F.count("*").over(per) / 2 + F.lit(0.5)
    u = units.withColumns({"_lo": F.greatest(F.lit(0), F.floor(ideal - slack)), "_hi": F.ceil(ideal + slack)})
    u = u.withColumn("_rest", F.col(seats) - F.sum("_lo").over(per))
    u = u.withColumn("_seat", F.explode(F.expr("sequence(_lo + 1, greatest(_lo + 1, cast(_hi as bigint)))")))
    quotient = F.col(weight) / (2 * F.col("_seat") - 1)
    rank = F.row_number().over(per.orderBy(quotient.desc(), *order))
    won = F.sum((F.col("_won") & (F.col(weight) > 0)).cast("long"))
    keep = [c for c in units.columns if c not in group]
    return u.withColumn("_won", rank <= F.col("_rest")).groupBy(*group, *keep, "_lo").agg(won.alias("_more")) \
        .withColumn(out, F.col("_lo") + F.col("_more")).drop("_lo", "_more")


def targets(sources: DataFrame, weights: tuple[int, ...], share: float, cap: int) -> DataFrame:
    """Adds weight and target to (source, source_size): the share of all words
    goes to sources by weight; one at ``cap`` times its size passes its excess on.

    With sources by ascending cap / weight, level i is what a unit of weight
    gets when all before i are at their caps; the largest level is the answer.
    One row for each source takes part.
    """
    everything = Window.partitionBy(F.lit(0))
    rank = F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*map(F.lit, weights)), ((rank - 1) % len(weights) + 1).cast("int"))
    s = sources.withColumn("weight", weight.cast("double")).withColumn("_cap", (cap * F.col("source_size")).cast("double"))
    s = s.withColumn("_all", F.sum("source_size").over(everything) * F.lit(float(share)))
    before = everything.orderBy(F.col("_cap") / F.col("weight"), F.col("source").asc_nulls_last()) \
        .rowsBetween(Window.unboundedPreceding, -1)
    level = (F.col("_all") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) \
        / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    s = s.withColumn("_level", level).withColumn("_level", F.max("_level").over(everything))
    return s.withColumn("target", F.least(F.col("_cap"), F.col("weight") * F.col("_level"))).drop("_cap", "_all", "_level")


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), share: float = 1.0, cap: int = 3, block: int = 1,
        shards: int = 8, seed: int = 7) -> DataFrame:
    """doc_id, size, source_size, target, taken, source, text_hash for each row.

    * Null and empty texts have size 0 and give nothing.
    * The null source is a source, last in order.  Weights repeat over the
      sources in code point order.
    * Repeated rows are documents of their own; ties of the seeded order are
      broken by doc_id, size and text, so reruns agree.
    * Nothing is taken from an empty table; extra columns are ignored.
    * Texts of any length are counted whole where they are read.  Blocks of one word let
      every source come within a word of its target; longer ones keep passages together.
    """
    size = F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)).cast("long")
    rows = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                               size.alias("size"), F.xxhash64("text").alias("text_hash")), "sizes")
    sources = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, cap)
    sources = sources.withColumn("_zero", F.lit(0))
    sources = sources.withColumn("_blocks", F.round(F.sum("target").over(Window.partitionBy("_zero")) / block).cast("long"))
    sources = apportion(sources, ["_zero"], ["source"], "target", "_blocks", "_quota")
    sources = written(sources.select(F.col("source").alias("_source"), "source_size", "target", "_quota"), "sources")

    draw = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    placed = rows.join(sources, F.col("source").eqNullSafe(F.col("_source"))).withColumn("_draw", draw)
    placed = placed.withColumn("_shard", F.conv(F.substring("_draw", 1, 8), 16, 10).cast("long") % shards)
    quotas = placed.groupBy("source", "_shard").agg(F.sum("size").alias("_words"), F.first("_quota").alias("_quota"))
    quotas = apportion(quotas, ["source"], ["_shard"], "_words", "_quota", "_share") \
        .select(F.col("source").alias("_source"), "_shard", "_words", (F.col("_share") * block).alias("_want"))
    placed = cumulative_sum(placed.drop("_source", "_quota"), ["source", "_shard"], ["_draw", "doc_id", "size", "text_hash"], ["size"])
    placed = placed.withColumn("_at", F.col("size_cum") - F.col("size")) \
        .join(quotas.withColumnRenamed("_shard", "_of"),
              F.col("source").eqNullSafe(F.col("_source")) & (F.col("_shard") == F.col("_of")))
    want = F.least(F.col("_want"), cap * F.col("_words"))
    passes = F.when(F.col("_words") > 0, F.expr("least(_want, _cap) div _words")).otherwise(F.lit(0))
    taken = passes * F.col("size") + F.least(F.greatest(want - passes * F.col("_words") - F.col("_at"), F.lit(0)), F.col("size"))
    return placed.withColumn("_cap", cap * F.col("_words")).select(
        "doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"), "source", "text_hash")


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its n-th word."""
    return F.call_function("regexp_extract", text, F.concat(F.lit(f"^(?:{_GAP}*+{WORD}+){{"), n.cast("string"), F.lit("}+")),
                           F.lit(0))


def take_mix(docs: DataFrame, **settings) -> DataFrame:
    """The mixed documents: text repeated as often as the mix takes it, its last
    pass cut behind the last word taken; documents that give nothing go.
    Rows that repeat a doc_id and its text take what the first of them takes.
    """
    taken = mix(docs, **settings).where("taken > 0").groupBy("doc_id", "text_hash") \
        .agg(F.max("taken").alias("_taken"), F.first("size").alias("_size")).withColumnRenamed("doc_id", "_id")
    d = docs.withColumn("_hash", F.xxhash64(F.col("text").cast("string")))
    d = d.join(taken, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("text_hash")))
    d = d.withColumn("_passes", F.expr("cast(_taken div _size as int)")) \
        .withColumn("_rest", F.expr("cast(_taken % _size as int)"))
    part = F.when(F.col("_rest") > 0, first_words(F.col("text"), F.col("_rest"))).otherwise(F.lit(""))
    text = F.concat(F.repeat(F.concat(F.col("text"), F.lit("\n\n")), F.col("_passes")), part)
    out = {"text": F.rtrim(text)} | ({"n_chars": F.char_length(F.rtrim(text)).cast("long")} if "n_chars" in docs.columns else {})
    return d.withColumns(out).select(docs.columns)
