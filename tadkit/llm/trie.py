"""Prefix trie of conversations by truncation peeling.

A row is a conversation cut to digests of its turns.  Peeling takes a block of
rows from its greatest depth down: conversations that end at a depth are
merged with the nodes that survive there, each node is completed, loses its
last turn and is grouped with the nodes that then agree, so nodes are found
and added up in the same pass.

Blocks are ranges of the order of paths.  A node can reach beyond a block only
if it is a prefix of the block's first or last path.  These nodes stay open:
two rows a block, each a path with what is known so far at every depth, go on
to the next round, which peels them like conversations, until one block is left.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tadkit.llm.common import drop_table, prepare, written

BLOCK_ROWS = 4096            # rows peeled together in one task
TURN_BYTES = 16              # of a turn's digest
NO_ONE = sha256(b"").hexdigest()

_STATE = ["n", "least", "kids", "leaves", "saved"]
_ROW = "path binary, lens array<int>, n array<long>, least array<long>, kids array<long>, leaves array<long>, saved array<long>, ends array<string>"
_ARROW_ROW = [("path", pa.binary()), ("lens", pa.list_(pa.int32()))] + [(c, pa.list_(pa.int64())) for c in _STATE] + [("ends", pa.list_(pa.string()))]
_NODE = "depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, " \
        "ends_sha256 string, own binary, parent binary"
_ARROW_NODE = [(c.split()[0], {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[c.split()[1]]) for c in _NODE.split(", ")]
_OUT = pa.schema([("open", pa.struct(_ARROW_ROW)), ("node", pa.struct(_ARROW_NODE))])


def turn_digest(role: Column, text: Column) -> Column:
    """128 bits of a turn."""
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.substring(F.unhex(F.sha2(whole, 256)), 1, TURN_BYTES)


def rebuild(conversations: DataFrame, group: int = 100, most_shared: int = 6) -> DataFrame:
    """conv_id, path (digests of the turns, one after the other) and lens (their
    code points) of each conversation, the first turns of which are those of
    the first conversation of its ``group``."""
    c = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                             F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    c = c.select("conv_id", F.struct(F.col("turn").isNotNull().alias("some"), "turn", "role", turn_digest(F.col("role"), F.col("text")).alias("digest"),
                                     F.char_length("text").alias("len")).alias("t"))
    own = c.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t")) \
        .select("conv_id", F.transform("t", lambda t: F.struct(t["digest"].alias("digest"), t["len"].alias("len"))).alias("t"))
    shared = F.coalesce(F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(most_shared)), F.lit(0)).cast("int")
    own = own.withColumns({"h": shared, "base": F.col("conv_id") - F.col("conv_id") % group})
    heads = own.where(F.col("conv_id") % group == 0).select(F.col("conv_id").alias("base"), F.slice("t", 1, most_shared).alias("head"))
    none = F.slice("t", 1, 0)
    t = F.concat(F.slice(F.coalesce("head", none), F.lit(1), F.col("h")), F.slice("t", F.col("h") + 1, F.size("t")))
    return own.join(heads, "base", "left").select("conv_id", t.alias("t")) \
        .select("conv_id", F.array_join(F.transform("t", lambda x: F.hex(x["digest"])), "").alias("hex"), F.col("t.len").alias("lens")) \
        .select("conv_id", F.unhex("hex").alias("path"), "lens")


def _runs(batch: pa.RecordBatch) -> Iterator[list[dict]]:
    """Consecutive rows of a batch that agree in path."""
    rows = batch.to_pylist()
    start = 0
    for i in range(1, len(rows) + 1):
        if i == len(rows) or rows[i]["path"] != rows[start]["path"]:
            yield rows[start:i]
            start = i


def _join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted ids of equal conversations as texts, one a batch at most."""
    for batch in batches:
        out = []
        for run in _runs(batch):
            ids = [r["conv_id"] for r in run]
            out.append({"path": run[0]["path"], "lens": run[0]["lens"], "first": ids[0], "n": len(ids),
                        "least": next((i for i in ids if i is not None), None),
                        "ids": ",".join("null" if i is None else str(i) for i in ids)})
        yield pa.RecordBatch.from_pylist(out, pa.schema([("path", pa.binary()), ("lens", pa.list_(pa.int32())), ("first", pa.int64()),
                                                         ("n", pa.int64()), ("least", pa.int64()), ("ids", pa.string())]))


def _hash_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a path: its conversations counted and their ids hashed, text by text."""
    now: dict | None = None

    def close(x: dict) -> dict:
        d = len(x["path"]) // TURN_BYTES
        return {"path": x["path"], "lens": x["lens"], **{c: [0] * (d + 1) for c in ("kids", "leaves", "saved")},
                "n": [0] * d + [x["n"]], "least": [None] * d + [x["least"]], "ends": [None] * d + [x["hash"].hexdigest()]}

    for batch in batches:
        out = []
        for run in _runs(batch):
            for r in run:
                if now is None or r["path"] != now["path"]:
                    if now is not None:
                        out.append(close(now))
                    now = {**r, "hash": sha256(r["ids"].encode())}
                else:
                    now["hash"].update(f",{r['ids']}".encode())
                    now["n"] += r["n"]
                    now["least"] = _least(now["least"], r["least"])
        yield pa.RecordBatch.from_pylist(out, pa.schema(_ARROW_ROW))
    if now is not None:
        yield pa.RecordBatch.from_pylist([close(now)], pa.schema(_ARROW_ROW))


def _least(a: int | None, b: int | None) -> int | None:
    return b if a is None else a if b is None else min(a, b)


def _key(path: bytes) -> bytes:
    return sha256(path).digest()


class Node:
    """What is known of a prefix."""

    __slots__ = ("n", "least", "kids", "leaves", "saved", "ends", "lens", "waiting", "seen")

    def __init__(self) -> None:
        self.n = self.kids = self.leaves = self.saved = 0
        self.least, self.ends, self.seen = None, None, False
        self.lens: list[int] = []            # code points of the turns of a path that goes through it
        self.waiting: list[dict] = []        # complete children, which lack their parent's conv_id

    def add(self, n: int, least: int | None, kids: int, leaves: int, saved: int) -> None:
        self.n += n
        self.least = _least(self.least, least)
        self.kids += kids
        self.leaves += leaves
        self.saved += saved


def peel(rows: list[dict], last: bool) -> tuple[list[dict], list[dict]]:
    """Complete nodes of a block of rows, sorted by path, and its open rows (none if
    this is the ``last`` block, that is the only one)."""
    edges = {rows[0]["path"], rows[-1]["path"]} if rows and not last else set()
    ending: dict[int, list[dict]] = {}
    for r in rows:
        ending.setdefault(len(r["path"]) // TURN_BYTES, []).append(r)
    spines = {e: next(r for r in (rows[0], rows[-1]) if r["path"] == e) for e in edges}
    open_at: dict[bytes, Node] = {}
    done: list[dict] = []
    reach: dict[bytes, list[dict]] = {}      # prefix of the depth at hand -> rows whose path it begins
    level: dict[bytes, Node] = {}
    for depth in range(max(ending, default=-1), -1, -1):
        cut = depth * TURN_BYTES
        for r in ending.get(depth, ()):      # newly ended rows meet the nodes that survive
            reach.setdefault(r["path"], []).append(r)
        for path, below in reach.items():
            node = level.setdefault(path, Node())
            for r in below:                  # a row of an earlier round knows something of each of its depths
                node.add(*(r[c][depth] for c in _STATE))
                node.ends = node.ends or r["ends"][depth]
                node.seen |= r["carried"]
                node.lens = r["lens"]
        upper: dict[bytes, Node] = {}
        up: dict[bytes, list[dict]] = {}
        for path, node in level.items():
            if any(e.startswith(path) for e in edges):
                open_at[path] = node
                for w in node.waiting:
                    w["parent"] = _key(path)
                done += node.waiting
                continue
            for w in node.waiting:
                w["parent_conv_id"] = node.least
            done += node.waiting
            leaves = node.leaves if node.kids else 1
            saved = node.saved + (node.n - 1) * (node.lens[depth - 1] if depth else 0)
            row = {"depth": depth, "conv_id": node.least, "parent_conv_id": None, "n_convs": node.n, "n_children": node.kids, "n_leaves": leaves,
                   "saved_tokens": saved, "ends_sha256": node.ends or NO_ONE, "own": _key(path) if node.seen else None, "parent": None}
            if depth:
                above = upper.setdefault(path[:cut - TURN_BYTES], Node())
                above.add(node.n, node.least, 1, leaves, saved)
                above.lens = node.lens
                above.waiting.append(row)
            else:
                done.append(row)
        for path, below in reach.items():    # strip the last turn and regroup
            if depth:
                up.setdefault(path[:cut - TURN_BYTES], []).extend(r for r in below if r["carried"])
        reach, level = {k: v for k, v in up.items() if v}, upper
    return done, [_open_row(s, open_at) for s in spines.values()]


def _open_row(spine: dict, open_at: dict[bytes, Node]) -> dict:
    """A path with its open nodes; a node on both paths goes with the first."""
    nodes = [open_at.pop(spine["path"][:d * TURN_BYTES], None) or Node() for d in range(len(spine["path"]) // TURN_BYTES + 1)]
    return {"path": spine["path"], "lens": spine["lens"], **{c: [getattr(x, c) for x in nodes] for c in _STATE}, "ends": [x.ends for x in nodes]}


def _peeling(carried: bool, last: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [{**r, "carried": carried} for b in batches for r in b.to_pylist()]
        done, rest = peel(rows, last) if rows else ([], [])
        for i in range(0, len(done), 2000):
            yield pa.RecordBatch.from_pylist([{"node": d, "open": None} for d in done[i:i + 2000]], _OUT)
        yield pa.RecordBatch.from_pylist([{"node": None, "open": r} for r in rest], _OUT)
    return run


def prefix_trie(conversations: DataFrame, group: int = 100, most_shared: int = 6, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row a node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    * Null roles and texts are empty; turns go by turn (null first), role and digest, and
      repeated rows are turns of their own.
    * Rows of a null conv_id are one conversation that shares no turns; no node takes
      its id while another member has one, and in ends_sha256 it is ``null``, before all others.
    * A turn is a 128-bit digest and a length, so texts of any length are read once; the
      turns of one conversation meet in one task as digests.
    * An empty table has no nodes; extra columns are ignored.
    * Ids of equal conversations are joined in parallel, then hashed one text after the
      other, as SHA-256 of the whole list asks for.
    """
    spark = conversations.sparkSession
    prepare(spark)
    block_rows = max(block_rows, 8)          # each block leaves two rows, so fewer would not get less
    convs = written(rebuild(conversations, group, most_shared), "rebuilt")
    parts = -(-convs.count() // block_rows) or 1
    texts = convs.repartitionByRange(parts, "path", "conv_id").sortWithinPartitions("path", "conv_id") \
        .mapInArrow(_join_ids, "path binary, lens array<int>, first long, n long, least long, ids string")
    rows = written(texts.repartition("path").sortWithinPartitions("path", "first").mapInArrow(_hash_ids, _ROW), "conversations")
    left, found, carried = rows.count(), [], False
    drop_table(convs)
    while left:
        last = left <= block_rows
        parts = -(-left // block_rows)
        blocks = (rows.coalesce(1) if last else rows.repartitionByRange(parts, "path")).sortWithinPartitions("path")
        out = written(blocks.mapInArrow(_peeling(carried, last), f"open struct<{_typed(_ROW)}>, node struct<{_typed(_NODE)}>"), "peeled")
        found.append(out.where("node is not null").select("node.*"))
        rows, carried = out.where("open is not null").select("open.*"), True
        left = 0 if last else rows.count()
    if not found:
        return spark.createDataFrame([], _NODE).drop("own", "parent")
    nodes = found[0]
    for f in found[1:]:
        nodes = nodes.unionByName(f)
    above = nodes.where("own is not null").select(F.col("own").alias("parent"), F.col("conv_id").alias("_above"))
    inside = nodes.where("parent is null").drop("own", "parent")
    across = nodes.where("parent is not null").join(above, "parent").withColumn("parent_conv_id", F.col("_above")).drop("own", "parent", "_above")
    return inside.unionByName(across)


def _typed(ddl: str) -> str:
    return ddl.replace(" ", ":").replace(",:", ",")
