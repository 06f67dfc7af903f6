"""Merkle manifest of a document table, with a proof for every row.

The tree is kept as content-addressed records digest -> children.  A segment
is a subtree of ``LEVELS`` levels, whose records lie in one row under the
digest of its top.  Segments are built from the leaves up.  Requests for leaves
then descend from the root: at each record the rank's digit selects a child and
the others are collected.  Requests whose digits agree so far descend as one,
so a segment is read once; each gives its part of the paths bottom first, put
before the part collected above.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tadkit.llm.common import prepare, written
from tadkit.operators.frame import cumulative_sum

LEVELS = 8
FANOUT = 2
SPAN = FANOUT ** LEVELS          # nodes at the bottom of a segment

_SEGMENT = "lang string, pos long, digest string, records array<struct<digest:string,children:array<string>>>"
_DESCENT = "lang string, pos long, digest string, lefts array<string>, rights array<string>, subroot string, root string"
_PROOF = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def digest(parts: list[str]) -> str:
    """Hexadecimal SHA-256 of texts put together."""
    return sha256("".join(parts).encode()).hexdigest()


def field(c: Column) -> Column:
    """A value with its length in bytes before it, or a dash."""
    s = c.cast("string")
    return F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def leaves(docs: DataFrame) -> DataFrame:
    """lang (sortable, null first), doc_id, leaf, and changed: the leaf after one is
    added to n_chars, null where nothing is changed."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                    F.col("lang").cast("string").alias("lang"), F.col("n_chars").cast("decimal(20,0)").alias("n_chars"),
                    F.col("text").cast("string").alias("text"))

    def leaf(n: Column) -> Column:
        return F.sha2(F.concat(field(F.col("doc_id")), field(F.col("source")), field(F.col("lang")), field(n), field(F.col("text"))), 256)
    touched = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    return d.select(F.coalesce(F.concat(F.lit("1"), "lang"), F.lit("0")).alias("lang"), "doc_id", leaf(F.col("n_chars")).alias("leaf"),
                    F.when(touched & F.col("n_chars").isNotNull(), leaf(F.col("n_chars") + 1)).alias("changed"))


def height(n: int) -> int:
    """Levels above ``n`` nodes until one is left."""
    up = 0
    while n > 1:
        n, up = -(-n // FANOUT), up + 1
    return up


def build_segment(nodes: list[str], levels: int) -> tuple[str, dict[str, list[str]]]:
    """Digest of the top of a segment over ``nodes`` and the records of its inner nodes."""
    records: dict[str, list[str]] = {}
    for _ in range(levels):
        runs = [nodes[i:i + FANOUT] for i in range(0, len(nodes), FANOUT)]
        nodes = [digest(r) for r in runs]
        records.update(zip(nodes, runs))
    return nodes[0], records


def descend(top: str, rank: int, levels: int, records: dict[str, list[str]]) -> tuple[str, list[str], list[str]]:
    """The node of ``rank`` below ``top``; texts of the children left and right
    of the selected one, bottom first."""
    lefts, rights = [], []
    for level in range(levels - 1, -1, -1):
        children = records[top]
        at = rank // FANOUT ** level % FANOUT
        lefts.append("".join(children[:at]))
        rights.append("".join(children[at + 1:]))
        top = children[at]
    return top, lefts[::-1], rights[::-1]


def fold(leaf: str, lefts: list[str], rights: list[str]) -> str:
    """The root that a leaf and its siblings give."""
    for left, right in zip(lefts, rights):
        leaf = digest([left, leaf, right])
    return leaf


def _build(r: dict) -> Iterator[dict]:
    top, records = build_segment(r["nodes"], min(LEVELS, height(r["n"])))
    yield {"lang": r["lang"], "pos": r["pos"], "digest": top, "records": [{"digest": k, "children": v} for k, v in records.items()]}


def _walk(r: dict) -> Iterator[dict]:
    """Descents through a segment to each node at its bottom."""
    records = {x["digest"]: x["children"] for x in r["records"]}
    levels = min(LEVELS, height(r["n"]))
    for at in range(min(r["n"] - r["pos"] * SPAN, SPAN)):
        node, lefts, rights = descend(r["digest"], at, levels, records)
        yield {"lang": r["lang"], "pos": r["pos"] * SPAN + at, "digest": node, "lefts": lefts + r["lefts"],
               "rights": rights + r["rights"], "subroot": r["subroot"], "root": r["root"]}


def _prove(r: dict) -> Iterator[dict]:
    """Proofs of the requested leaves of a bottom segment, and the roots they fold to."""
    records = {x["digest"]: x["children"] for x in r["records"]}
    levels = min(LEVELS, height(r["n"]))
    for q in r["requests"]:
        leaf, lefts, rights = descend(r["digest"], q["rank"] % SPAN, levels, records)
        lefts, rights = lefts + r["lefts"], rights + r["rights"]
        folded = fold(q["changed"] or q["leaf"], lefts, rights)
        yield {"doc_id": q["doc_id"], "leaf": leaf, "subroot": r["subroot"], "root": r["root"],
               "proof_sha256": digest([s for pair in zip(lefts, rights) for s in pair]),
               "folded_root": folded, "verified": folded == r["root"]}


_ARROW_SEGMENT = pa.schema([("lang", pa.string()), ("pos", pa.int64()), ("digest", pa.string()),
                            ("records", pa.list_(pa.struct([("digest", pa.string()), ("children", pa.list_(pa.string()))])))])
_ARROW_DESCENT = pa.schema([("lang", pa.string()), ("pos", pa.int64()), ("digest", pa.string()), ("lefts", pa.list_(pa.string())),
                            ("rights", pa.list_(pa.string())), ("subroot", pa.string()), ("root", pa.string())])
_ARROW_PROOF = pa.schema([("doc_id", pa.int64()), ("leaf", pa.string()), ("subroot", pa.string()), ("root", pa.string()),
                          ("proof_sha256", pa.string()), ("folded_root", pa.string()), ("verified", pa.bool_())])


def _each(rows: DataFrame, fn: Callable[[dict], Iterator[dict]], ddl: str, schema: pa.Schema, size: int = 2000) -> DataFrame:
    """Rows that ``fn`` gives for each row, one of which is held as Python values at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[dict] = []
        for batch in batches:
            for i in range(batch.num_rows):
                out += fn(batch.slice(i, 1).to_pylist()[0])
                if len(out) >= size:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out = []
        yield pa.RecordBatch.from_pylist(out, schema)
    return rows.mapInArrow(run, ddl)


def _segments(nodes: DataFrame, counts: DataFrame) -> DataFrame:
    """Segments above nodes (lang, pos, digest, and n, the nodes of their lang)."""
    g = nodes.groupBy("lang", F.expr(f"pos div {SPAN}").alias("at")) \
        .agg(F.sort_array(F.collect_list(F.struct("pos", "digest"))).alias("nodes"))
    g = g.join(counts, "lang").select("lang", F.col("at").alias("pos"), F.col("nodes.digest").alias("nodes"), "n")
    return _each(g, _build, _SEGMENT, _ARROW_SEGMENT)


def _grow(nodes: DataFrame, counts: DataFrame, most: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """Segments over nodes (lang, pos, digest), then over their tops, until one a lang is left, and the
    numbers of nodes (lang, n) below each; ``most`` is the largest of ``counts``."""
    store, sizes = [written(_segments(nodes, counts), "segments")], [counts]
    while most > SPAN:
        most = -(-most // SPAN)
        sizes.append(sizes[-1].select("lang", F.expr(f"(n + {SPAN - 1}) div {SPAN}").alias("n")))
        store.append(written(_segments(store[-1].select("lang", "pos", "digest"), sizes[-1]), "segments"))
    return store, sizes


def _descents(near: DataFrame, store: list[DataFrame], sizes: list[DataFrame]) -> DataFrame:
    """Paths that end at tops, led down through all segments of ``store``."""
    for segments, n in zip(store[::-1], sizes[::-1]):
        near = written(_each(_below(near, segments, n), _walk, _DESCENT, _ARROW_DESCENT), "paths")
    return near


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every row.

    * A null column is ``-`` in a leaf; null and empty texts have different leaves.
    * Texts of any length are hashed where they are read; digests alone are shuffled.
    * Rows of a null lang are a tree of their own, before all others; those of a null doc_id come
      first in theirs and are never tampered with.  Rows that agree in doc_id are ordered by leaf.
    * Repeated rows are leaves of their own, with the same digest and each its own proof.
    * An empty table gives no rows; extra columns are ignored.
    * The root is the top of a tree over the subroots, built like those below; a lone subroot is the root.
    """
    prepare(docs.sparkSession)
    one = leaves(docs).withColumn("_one", F.lit(1).cast("long"))
    ranked = written(cumulative_sum(one, ["lang"], ["doc_id", "leaf"], ["_one"])
                     .select("lang", "doc_id", "leaf", "changed", (F.col("_one_cum") - 1).alias("rank")), "leaves")
    counts = written(ranked.groupBy("lang").agg(F.count("*").alias("n")), "counts")
    most = counts.agg(F.max("n")).first()[0] or 0

    # Up: the tree of each lang over its leaves, then that of the subroots.
    store, sizes = _grow(ranked.select("lang", F.col("rank").alias("pos"), F.col("leaf").alias("digest")), counts, most)
    subroots = written(cumulative_sum(store[-1].select("lang", F.col("digest").alias("subroot"), F.lit(1).cast("long").alias("_one")), [], ["lang"], ["_one"])
                       .select("lang", "subroot", (F.col("_one_cum") - 1).alias("pos")), "subroots")
    langs = subroots.count()
    above, widths = _grow(subroots.select(F.lit("").alias("lang"), "pos", F.col("subroot").alias("digest")),
                          subroots.groupBy(F.lit("").alias("lang")).agg(F.count("*").alias("n")), langs)

    # Down: from the root to the subroots, then segment by segment.
    near = above[-1].select("lang", "pos", "digest", *[F.array().cast("array<string>").alias(c) for c in ("lefts", "rights")],
                            F.col("digest").alias("subroot"), F.col("digest").alias("root"))
    near = _descents(near, above, widths).drop("lang", "digest", "subroot").join(subroots, "pos") \
        .select("lang", F.lit(0).cast("long").alias("pos"), F.col("subroot").alias("digest"), "lefts", "rights", "subroot", "root")
    near = _descents(near, store[1:], sizes[1:])
    requests = ranked.groupBy("lang", F.expr(f"rank div {SPAN}").alias("pos")) \
        .agg(F.sort_array(F.collect_list(F.struct("rank", "doc_id", "leaf", "changed"))).alias("requests"))
    return _each(_below(near, store[0], counts).join(requests, ["lang", "pos"]), _prove, _PROOF, _ARROW_PROOF)


def _below(paths: DataFrame, segments: DataFrame, n: DataFrame) -> DataFrame:
    """Paths that end at a digest, with the segment below it."""
    records = segments.select("digest", "records").dropDuplicates(["digest"])
    return paths.join(records, "digest").join(n, "lang")
