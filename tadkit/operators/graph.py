"""Graph helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tadkit.session import drop_table, written


def components(edges: DataFrame) -> DataFrame:
    """(id, comp): the least id reachable, for each id of ``edges`` (a, b).

    Alternates large-star and small-star steps (each a min by node and a join
    back, so a hub is one aggregated row) until the edges no longer change;
    every component is then a star.  There is no bound on the rounds.
    """
    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        if not large:
            both = both.where("b <= a")
        low = both.groupBy("a").agg(F.min(F.least("a", "b")).alias("low"))
        out = both.join(low, "a")
        out = out.where("b > a") if large else out
        out = out.select(F.col("b").alias("a"), F.col("low").alias("b"))
        if not large:
            out = out.unionByName(low.select("a", F.col("low").alias("b")))
        return out.where("a <> b").distinct()

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    now = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    mark = state(now)
    while mark[0]:
        new = written(star(star(now, True), False), "edges")
        drop_table(now)
        now, old, mark = new, mark, state(new)
        if mark == old:
            break
    return now.select(F.col("a").alias("id"), F.col("b").alias("comp")) \
        .unionByName(now.select(F.col("b").alias("id"), F.col("b").alias("comp"))).distinct()
