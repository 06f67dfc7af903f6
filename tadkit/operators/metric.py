"""Metric index: neighbours within a radius, and k nearest, by Minkowski distance.

Points belong to the cell of their nearest pivot (Euclidean).  A cell is a ball
around its pivot and, seen from each landmark, a ring by the metric itself, so by
the triangle inequality most cells lie beyond a search radius and are not met
where the points are clustered.  Cells are put together into groups of bounded size,
and large cells are cut by hash; a group is one task per block of queries,
references are shipped once a block of queries, and a query once a group that it
meets, with the cells it meets there.

Where no cell can be left out, all pairs are compared: by a product of matrices in
single precision, whose error is bounded, and exactly only where that leaves it open.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tadkit.session import written

MAX_CELLS = 1024             # pivots, at most; they go to every task
CELL_ROWS = 512              # points of a cell, about, until there are MAX_CELLS
LANDMARKS = 16
SAMPLE_ROWS = 8192           # points that pivots are chosen from
GROUP_ROWS = 65_536          # references of a task
QUERY_ROWS = 65_536          # queries of a task, about
LEAST_QUERIES = 4096         # of a task, if there are more tasks than the memory asks for
NEAR_ROWS = 2048             # rows of the cells that are searched first
TILE_ROWS = 1024             # references compared at once
_CHUNK = 512
_TILE = (32, 1024)


def vectors(col: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of a list column as a matrix."""
    flat = pa.concat_arrays([c.flatten() for c in col.chunks]) if isinstance(col, pa.ChunkedArray) else col.flatten()
    return flat.to_numpy(zero_copy_only=False).astype(float).reshape(len(col), -1)


def distances(a: np.ndarray, b: np.ndarray, p: float) -> np.ndarray:
    """Distance of each row of ``a`` to each of ``b``, coordinate by coordinate, in tiles that stay in a core's cache."""
    out = np.zeros((len(a), len(b)))
    at, bt = np.ascontiguousarray(a.T)[:, :, None], np.ascontiguousarray(b.T)
    spare = np.empty((_TILE[0], _TILE[1]))
    for r in range(0, len(a), _TILE[0]):
        for c in range(0, len(b), _TILE[1]):
            o, x, y = out[r:r + _TILE[0], c:c + _TILE[1]], at[:, r:r + _TILE[0]], bt[:, c:c + _TILE[1]]
            gap = spare[:o.shape[0], :o.shape[1]]
            for i in range(len(y)):
                np.subtract(x[i], y[i], out=gap)
                if p != 2:
                    np.abs(gap, out=gap)
                if np.isinf(p):
                    np.maximum(o, gap, out=o)
                    continue
                if p == 2:
                    np.multiply(gap, gap, out=gap)
                elif p != 1:
                    np.power(gap, p, out=gap)
                o += gap
    return out if p == 1 or np.isinf(p) else np.sqrt(out, out=out) if p == 2 else out ** (1 / p)


def _squares(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, float]:
    """Squared Euclidean distances by one matrix product, and how far they may be off."""
    na, nb = (a * a).sum(axis=1), (b * b).sum(axis=1)
    off = 1e-12 * (na.max(initial=0) + nb.max(initial=0))
    return na[:, None] + nb - 2 * (a @ b.T), off


def _pairs(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray, p: float) -> np.ndarray:
    gap = np.abs(a[i] - b[j])
    return gap.max(axis=1, initial=0) if np.isinf(p) else np.sqrt((gap * gap).sum(axis=1)) if p == 2 else (gap ** p).sum(axis=1) ** (1 / p)


def _pairs_in_order(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray, p: float) -> np.ndarray:
    """As ``_pairs``, summed coordinate by coordinate as in ``distances``."""
    if p == 2 or np.isinf(p):
        return _pairs(a, b, i, j, p)
    gap = np.abs(a[i] - b[j])
    gap = gap if p == 1 else gap ** p
    out = np.zeros(len(i))
    for c in range(gap.shape[1]):
        out += gap[:, c]
    return out if p == 1 else out ** (1 / p)


def stretch(d: int, p: float) -> float:
    """Points within 1 by ``p`` are within this by Euclidean distance, of ``d`` coordinates."""
    return max(1.0, d ** (0.5 - (0 if np.isinf(p) else 1 / p)))


def rough(a: np.ndarray, b: np.ndarray, eps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
    """Pairs (i, j, sure), row by row, that may be within Euclidean distance ``eps`` (one a row of ``a``), and whether
    they are in any case: by a product of matrices in single precision and the bound of its error.
    None if the numbers are too large for it."""
    d = a.shape[1]
    mid = b.mean(axis=0) if len(b) else np.zeros(d)
    with np.errstate(over="ignore", invalid="ignore"):
        x, y = np.empty((len(a), d + 1), np.float32), np.empty((len(b), d + 1), np.float32)
        x[:, :d], y[:, :d] = a - mid, b - mid
        nx, ny = (np.square(v[:, :d], dtype=float).sum(axis=1) for v in (x, y))
        x[:, d], y[:, d] = 1, ny / -2
        size = nx + ny.max(initial=0)
    if not (size < 1e30).all():
        return None
    off = (2 * d + 32) * 2.0 ** -24 * (size + eps * eps) + 1e-12 * ((mid * mid).sum() + size) + 1e-37
    low = (nx - eps * eps) / 2
    if not (np.abs(low) < 1e30).all():
        low = np.clip(low, -1e30, 1e30)
    half = x @ y.T                                         # a.b - b.b / 2
    flat = np.flatnonzero(half >= (low - off).astype(np.float32)[:, None])
    i, j = np.divmod(flat, len(b)) if len(b) else (flat, flat)
    return i, j, half.ravel()[flat] >= (low + off)[i]


def within(a: np.ndarray, b: np.ndarray, eps: np.ndarray, p: float, quick: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j), row by row, of ``a`` and ``b`` that lie within ``eps`` (one a row of ``a``); close calls are taken exactly.

    ``quick`` finds some of them only, by what is nearest in Euclidean distance."""
    d = a.shape[1]
    reach = 1.2 * d ** min(0.0, 0.5 - (0 if np.isinf(p) else 1 / p)) if quick and p != 2 else stretch(d, p)
    found = rough(a, b, eps * reach)
    if found is None or p != 2 and len(found[0]) > len(a) * len(b) / 8:
        return np.nonzero(distances(a, b, p) <= eps[:, None])
    i, j, sure = found
    keep = sure & (p == 2)
    open_ = np.flatnonzero(~keep)
    for at in range(0, len(open_), 1 << 14):
        o = open_[at:at + (1 << 14)]
        keep[o] = _pairs_in_order(a, b, i[o], j[o], p) <= eps[i[o]]
    return i[keep], j[keep]


@dataclass
class MetricIndex:
    """Pivots of cells; per cell its rows, (Euclidean) radius and the ring around each landmark, which are the first pivots."""

    pivots: np.ndarray
    p: float
    rows: np.ndarray
    radius: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def to_pivots(self, x: np.ndarray) -> np.ndarray:
        """Euclidean distance to each pivot, at least, and then the distance to each landmark."""
        return np.hstack([_to_pivots(x, self.pivots), distances(x, self.pivots[:self.low.shape[1]], self.p)])

    def beyond(self, to_pivots: np.ndarray) -> np.ndarray:
        """Distance to each cell, at least (infinite for empty ones)."""
        out = (to_pivots[:, :len(self.rows)] - self.radius) / stretch(self.pivots.shape[1], self.p)
        for j in range(self.low.shape[1]):
            d = to_pivots[:, len(self.rows) + j, None]
            np.maximum(out, self.low[:, j] - d, out=out)
            np.maximum(out, d - self.high[:, j], out=out)
        out[:, self.rows == 0] = np.inf
        return out * (1 - 1e-9) - 1e-12

    def homes(self, to_pivots: np.ndarray) -> np.ndarray:
        return to_pivots[:, :len(self.rows)].argmin(axis=1).astype(np.int32)

    def groups(self) -> tuple[np.ndarray, np.ndarray]:
        """First group of each cell and how many it is cut into; small cells share one."""
        first, parts = np.zeros(len(self.rows), int), np.maximum(1, -(-self.rows // GROUP_ROWS))
        now = held = 0
        for c, n in enumerate(self.rows):
            if held and (held + n > GROUP_ROWS):
                now, held = now + 1, 0
            first[c] = now
            now, held = (now + int(parts[c]), 0) if parts[c] > 1 else (now, held + n)
        return first, parts


def _to_pivots(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Euclidean distances to the pivots, at least."""
    d, off = _squares(x, pivots)
    if not np.isfinite(off):
        return distances(x, pivots, 2.0)
    return np.sqrt(np.maximum(d - off, 0))


def _farthest_first(x: np.ndarray, n: int) -> np.ndarray:
    """``n`` rows, each the farthest (Euclidean) from those before it."""
    picked, far = [0], distances(x, x[:1], 2.0)[:, 0]
    while len(picked) < n and far.max() > 0:
        picked.append(int(far.argmax()))
        gap = x - x[picked[-1]]
        far = np.minimum(far, np.sqrt(np.einsum("ij,ij->i", gap, gap)))
    return x[picked]


def build_index(points: DataFrame, vec: str, p: float = 2.0, cells: int | None = None) -> tuple[MetricIndex | None, DataFrame]:
    """The index of ``points`` and the points with their ``cell``.  None if there are no points."""
    spark = points.sparkSession
    n = points.count()
    cells = cells or max(1, min(MAX_CELLS, n // CELL_ROWS))
    sample = points.select(vec).orderBy(F.xxhash64(vec), vec).limit(SAMPLE_ROWS).toArrow()
    if not n:
        return None, points.withColumn("cell", F.lit(0))
    pivots = _farthest_first(vectors(sample.column(0)), cells)
    marks = min(LANDMARKS, len(pivots))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches):
            x = vectors(b.column(vec))
            cell = _to_pivots(x, pivots).argmin(axis=1)
            own = _pairs(x, pivots, np.arange(len(x)), cell, 2.0)
            b = b.append_column("cell", pa.array(cell.astype(np.int32)))
            yield b.append_column("_far", pa.FixedSizeListArray.from_arrays(pa.array(np.hstack([own[:, None], distances(x, pivots[:marks], p)]).ravel()), marks + 1)
                                  .cast(pa.list_(pa.float64())))
    ddl = ", ".join(f"`{c}` {t}" for c, t in points.dtypes)
    homes = written(points.mapInArrow(assign, f"{ddl}, cell int, _far array<double>"), "homes")
    far = [F.col("_far")[i] for i in range(marks + 1)]
    ext = homes.groupBy("cell").agg(F.count(F.lit(1)), F.max(far[0]), *[F.min(c) for c in far[1:]], *[F.max(c) for c in far[1:]])
    k = len(pivots)
    rows, radius, low, high = np.zeros(k, int), np.zeros(k), np.full((k, marks), np.inf), np.full((k, marks), -np.inf)
    for r in ext.collect():                                   # a row a cell, MAX_CELLS at most
        rows[r[0]], radius[r[0]] = r[1], r[2]
        low[r[0]], high[r[0]] = r[3:3 + marks], r[3 + marks:]
    low[rows == 0], high[rows == 0] = 0, 0
    return MetricIndex(pivots, p, rows, radius, low, high), homes.drop("_far")


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 2048) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


Reach = Callable[[MetricIndex, np.ndarray, np.ndarray], np.ndarray]
Visit = Callable[[np.ndarray], tuple[Callable, Callable]]


def in_radius(index: MetricIndex, to_pivots: np.ndarray, bound: np.ndarray) -> np.ndarray:
    """Cells (one column each) that may hold points within ``bound`` of each row, told by its distances to the pivots."""
    return index.beyond(to_pivots) <= bound[:, None]


def around(need: int) -> Reach:
    """The nearest cells that hold ``need`` rows."""
    def reach(index: MetricIndex, to_pivots: np.ndarray, bound: np.ndarray) -> np.ndarray:
        d = to_pivots[:, :len(index.rows)]
        order = np.argsort(d, axis=1, kind="stable")
        before = np.cumsum(index.rows[order], axis=1) - index.rows[order]
        ok = np.zeros(d.shape, bool)
        np.put_along_axis(ok, order, before < need, axis=1)
        return ok & (index.rows > 0)
    return reach


def meet(index: MetricIndex, left: DataFrame, right: DataFrame, reach: Reach, visit: Visit, schema: str) -> DataFrame:
    """Rows that ``visit`` makes of the points of ``left`` (tag, x, bound) and the points of
    ``right`` (tag, x, cell) in cells that ``reach`` gives them.

    ``visit(right tags)`` is called once a group and gives ``feed(left tags, x, bound, columns,
    y, allowed)``, called with chunks of left points and the right points (``columns`` among
    the group's) that any of them reaches, ``allowed(rows, columns)`` telling which, and ``close()``, which
    gives the columns of ``schema``.
    """
    groups = first, parts = index.groups()
    spark, n, total = left.sparkSession, left.count(), int((first + parts).max())
    blocks = max(1 + n // QUERY_ROWS, min(-(-spark.sparkContext.defaultParallelism // total), n // LEAST_QUERIES))
    slots = _slots(total * blocks, int(spark.conf.get("spark.sql.shuffle.partitions")))
    slot = F.element_at(F.lit(slots), F.col("g") * blocks + F.col("q") + 1).alias("s")
    spans = [(np.flatnonzero((first <= g) & (g < first + parts))[[0, -1]] + [0, 1]).tolist() for g in range(total)]     # a group's cells follow each other

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches):
            d = index.to_pivots(vectors(b.column("x")))
            b = b.append_column("home", pa.array(index.homes(d)))
            ok = reach(index, d, b.column("bound").to_numpy())
            met = _groups_met(groups, ok)
            for g in np.flatnonzero(met.any(axis=0)):
                i = np.flatnonzero(met[:, g])
                bits = [v.tobytes() for v in np.packbits(ok[i, spans[g][0]:spans[g][1]], axis=1)]
                rows = pa.array(i)
                yield pa.record_batch([*(b.column(c).take(rows) for c in ("tag", "x", "bound", "home")), pa.array(np.full(len(i), g, np.int32)), pa.array(bits, pa.binary())],
                                      names=["tag", "x", "bound", "home", "g", "met"])
    tag = dict(left.dtypes)["tag"]
    a = left.select("tag", "x", "bound").mapInArrow(send, f"tag {tag}, x array<double>, bound double, home int, g int, met binary") \
        .withColumn("q", F.pmod(F.xxhash64("tag", "x"), F.lit(blocks)).cast("int")).select("*", slot)
    at = F.element_at(F.lit([int(v) for v in first]), F.col("cell") + 1) \
        + F.pmod(F.xxhash64("tag", "x"), F.element_at(F.lit([int(v) for v in parts]), F.col("cell") + 1)).cast("int")
    b = right.select("tag", "x", "cell", at.alias("g"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("q")).select("tag", "x", "cell", slot)
    b = b.toDF(*[f"{c}_r" for c in b.columns]).toDF(*b.columns)          # other column ids than the left side's
    names = [c.split()[0] for c in schema.split(", ")]

    def run(x: pa.Table, y: pa.Table) -> pa.Table:
        if not x.num_rows or not y.num_rows:
            return pa.table({c: [] for c in names}).cast(arrow)
        y = y.sort_by([("cell", "ascending"), ("tag", "ascending")])
        cell, ys, tags = y.column("cell").to_numpy(), vectors(y.column("x")), y.column("tag").to_numpy()
        xs, bound, own = vectors(x.column("x")), x.column("bound").to_numpy(), x.column("tag").to_numpy()
        cells = np.unique(cell)
        ends = np.searchsorted(cell, cells, "right")
        starts = np.searchsorted(cell, cells)
        feed, close = visit(tags)
        bits, low = x.column("met").combine_chunks(), spans[x.column("g")[0].as_py()][0]
        order = np.argsort(x.column("home").to_numpy(), kind="stable")
        for at in range(0, len(order), _CHUNK):
            i = order[at:at + _CHUNK]
            packed = np.frombuffer(b"".join(bits.take(pa.array(i)).to_pylist()), np.uint8).reshape(len(i), -1)
            ok = np.unpackbits(packed, axis=1)[:, cells - low].astype(bool)
            hit = np.flatnonzero(ok.any(axis=0))
            if len(hit):
                whole = len(hit) == len(cells)
                columns = np.arange(len(ys)) if whole else np.concatenate([np.arange(starts[c], ends[c]) for c in hit])
                met, of = ok[:, hit], np.repeat(np.arange(len(hit)), (ends - starts)[hit])
                feed(own[i], xs[i], bound[i], columns, ys if whole else ys[columns], lambda r, c, met=met, of=of: met[r, of[c]])
        return pa.table(dict(zip(names, close()))).cast(arrow)
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(left.sparkSession.createDataFrame([], schema).schema)
    return a.groupBy("s").cogroup(b.groupBy("s")).applyInArrow(run, schema)


def _slots(n: int, partitions: int) -> list[int]:
    """``n`` numbers that Spark's hash deals out to the partitions evenly."""
    def partition(v: int) -> int:                             # Murmur3 of an int, seed 42
        k = v * 0xCC9E2D51 & 0xFFFFFFFF
        h = 42 ^ ((k << 15 | k >> 17) & 0xFFFFFFFF) * 0x1B873593 & 0xFFFFFFFF
        h = ((h << 13 | h >> 19) & 0xFFFFFFFF) * 5 + 0xE6546B64 & 0xFFFFFFFF
        h ^= 4
        h = (h ^ h >> 16) * 0x85EBCA6B & 0xFFFFFFFF
        h = (h ^ h >> 13) * 0xC2B2AE35 & 0xFFFFFFFF
        h ^= h >> 16
        return (h - (h >> 31 << 32)) % partitions
    out, held, v = [], [0] * partitions, 0
    while len(out) < n:
        if held[at := partition(v)] <= len(out) // partitions:
            held[at] += 1
            out.append(v)
        v += 1
    return out


def _groups_met(groups: tuple[np.ndarray, np.ndarray], ok: np.ndarray) -> np.ndarray:
    """Groups (one column each) of the cells that each row reaches."""
    first, parts = groups
    met = np.zeros((len(ok), int((first + parts).max())), bool)
    for c in np.flatnonzero(ok.any(axis=0)):
        met[ok[:, c], first[c]:first[c] + parts[c]] = True
    return met


def effort(index: MetricIndex, left: DataFrame, reach: Reach = in_radius) -> tuple[int, int]:
    """What ``meet`` takes for ``left`` (x, bound): rows of it shipped (one a group that a point reaches), and
    pairs compared at most (rows of the cells that each point reaches)."""
    groups = index.groups()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches):
            ok = reach(index, index.to_pivots(vectors(b.column("x"))), b.column("bound").to_numpy())
            yield pa.record_batch([pa.array([int(_groups_met(groups, ok).sum())]), pa.array([int((ok * index.rows).sum())])], names=["sent", "pairs"])
    got = left.select("x", "bound").mapInArrow(count, "sent long, pairs long").agg(F.sum("sent"), F.sum("pairs")).first()
    return got[0] or 0, got[1] or 0


def k_nearest(queries: DataFrame, refs: DataFrame, key: str, vec: str, k: int, p: float = 2.0, exclude_self: bool = False) -> DataFrame:
    """Exact k nearest among all references: (query_id, ref_id, dist, rank), ties to the smaller ref_id.

    If there are many references, each query first looks at some of those in the cells nearest to it; its
    k-th distance there bounds the search: only cells within it are met.  A task lowers the bound as it finds
    nearer ones.  Rows without key or vector are dropped; a key that repeats is one query with several vectors.
    """
    kt, rt = dict(queries.dtypes)[key], dict(refs.dtypes)[key]
    need = k + int(exclude_self)
    q = written(queries.filter(F.col(key).isNotNull() & F.col(vec).isNotNull()).select(F.col(key).alias("tag"), F.col(vec).cast("array<double>").alias("x"),
                                                              F.lit(float("inf")).alias("bound")), "queries")
    r = refs.filter(F.col(key).isNotNull() & F.col(vec).isNotNull()).select(F.col(key).alias("tag"), F.col(vec).cast("array<double>").alias("x"))
    schema = f"query_id {kt}, ref_id {rt}, dist double"
    index, homes = build_index(r, "x", p)
    if index is None:
        return queries.sparkSession.createDataFrame([], f"{schema}, rank int")

    staged, first = int(index.rows.sum()) > 8 * NEAR_ROWS, max(need, NEAR_ROWS)

    def candidates(x: np.ndarray, bound: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs that may be among a row's nearest: all within its bound, or as good as the ``need`` nearest here."""
        if np.isfinite(bound).all():
            some = rough(x, y, bound * stretch(x.shape[1], p))
            if some is not None and len(some[0]) <= len(x) * len(y) / 8:
                return some[:2]
        d, off = _squares(x, y) if p == 2 else (distances(x, y, p), 0.0)
        m = min(need, d.shape[1])
        limit = np.partition(d, m - 1, axis=1)[:, m - 1] + 2 * off
        return np.nonzero(d <= limit[:, None])

    def visit(tags: np.ndarray, whole: bool = True) -> tuple[Callable, Callable]:
        found: list[list] = [[], [], []]

        def feed(own: np.ndarray, x: np.ndarray, bound: np.ndarray, columns: np.ndarray, y: np.ndarray, allowed: Callable) -> None:
            if not whole and len(y) > 4 * first:              # those that most of the rows are near to are enough
                met = allowed(np.arange(0, len(x), 1 + len(x) // 32)[:, None], np.arange(len(y))).sum(axis=0)
                at = np.argsort(-met, kind="stable")[:4 * first]
                columns, y = columns[at], y[at]
            best, held = (np.zeros(0, np.int64), tags[:0], np.zeros(0)), []
            for at in range(0, len(y), TILE_ROWS):
                i, j = candidates(x, bound, y[at:at + TILE_ROWS])
                ref = tags[columns[at + j]]
                if exclude_self:
                    keep = own[i] != ref
                    i, j, ref = i[keep], j[keep], ref[keep]
                dist = _pairs(x, y, i, at + j, p)
                keep = dist <= bound[i]
                held.append((i[keep], ref[keep], dist[keep]))
                if at + TILE_ROWS < len(y) and np.isfinite(bound).all() and sum(len(h[0]) for h in held) < 4 * k * len(x):
                    continue
                i, ref, dist = (np.concatenate(c) for c in zip(best, *held))
                order = np.lexsort((ref, dist, i))
                i, ref, dist = i[order], ref[order], dist[order]
                place = np.arange(len(i)) - np.searchsorted(i, i)
                last = np.flatnonzero(place == k - 1)
                bound = bound.copy()
                bound[i[last]] = dist[last]                    # no farther one is among the k any more
                best, held = (i[place < k], ref[place < k], dist[place < k]), []
            i, ref, dist = best
            for out, v in zip(found, (own[i], ref, dist)):
                out.append(v)

        def close() -> list:
            return [np.concatenate(f) if f else np.array([]) for f in found]
        return feed, close

    if staged:
        one = meet(index, q, homes, around(first), lambda tags: visit(tags, False), schema)
        kth = one.withColumn("r", F.row_number().over(Window.partitionBy("query_id").orderBy("dist"))).where(f"r = {k}") \
            .select(F.col("query_id").alias("tag"), F.col("dist").alias("b"))
        q = written(q.join(kth, "tag", "left").select("tag", "x", F.coalesce("b", "bound").alias("bound")), "bounded")
    found = meet(index, q, homes, in_radius, visit, schema)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("dist", "ref_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k)
