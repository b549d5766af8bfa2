"""Near-duplicate embeddings by an epsilon grid order join.

Unit vectors with a cosine of at least s are at most epsilon = sqrt(2 - 2 s) apart. Space
is cut into cells as wide as epsilon along the leading principal axes, and the vectors are
sorted by their cells. What lies in a stretch of that sequence lies in a box along the
axes; no distance grows when it is projected on them, so stretches whose boxes are more
than epsilon apart are skipped as a whole. All others are halved and joined again: first
over a tree of intervals, as Spark joins, then within each pair of intervals, in the tasks,
down to leaves whose inner products are computed in full. Nothing is missed.

Equal vectors are one node with a number of copies. A pair of intervals gives a sum of
links per vector and a spanning forest of its links, never the links themselves.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termlode.llm.common import stored, to_tasks
from termlode.llm.components import components

SIMILARITY = 0.9
# Principal axes that boxes and grid cells are taken along, and vectors they are fitted on.
AXES, SAMPLE_ROWS = 16, 4096
# An interval holds so many vectors and bytes at most, a leaf so many vectors.
INTERVAL_ROWS, INTERVAL_BYTES, LEAF_ROWS = 4096, 8 << 20, 256
# Children of a node in the tree of intervals, as a power of two.
FAN_BITS = 4
# Products this close to the similarity are computed again, with exact sums.
CLOSE = 1e-12

_POINTS = "vec_id long, dim int, digest binary, raw binary, cells array<int>"
_LOW, _HIGH = [f"low_{j}" for j in range(AXES)], [f"high_{j}" for j in range(AXES)]
_INTERVALS = (
    "id long, part int, dim int, digests binary, ids binary, copies binary, raw binary, "
    + ", ".join(f"{name} double" for name in [*_LOW, *_HIGH])
)


def _takes_part(vectors: DataFrame) -> Column:
    """Whether a row has an id and a vector of finite numbers that is not zero."""
    x = F.col("embedding").cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    found = F.col("vec_id").isNotNull() & finite & F.exists(x, lambda v: v != 0)
    return F.coalesce(found, F.lit(False))


def _units(matrix: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that no square is too large or small."""
    matrix = matrix.astype(np.float64)
    matrix = matrix / np.abs(matrix).max(axis=1, keepdims=True)
    return matrix / np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))


def principal_axes(sample: list[np.ndarray]) -> dict[int, np.ndarray]:
    """For each dimension, the leading principal axes of its unit vectors as columns."""
    axes = {}
    for dim in {len(x) for x in sample}:
        units = _units(np.stack([x for x in sample if len(x) == dim]))
        _, _, right = np.linalg.svd(units - units.mean(axis=0), full_matrices=False)
        axes[dim] = right[:AXES].T
    return axes


def _along(units: np.ndarray, axes: dict[int, np.ndarray]) -> np.ndarray:
    """Coordinates along the axes, zero where there are fewer than AXES.

    A dimension that no sampled vector has takes its first coordinates.
    """
    dim = units.shape[1]
    own = axes.get(dim, np.eye(dim, min(dim, AXES)))
    out = np.zeros((len(units), AXES))
    out[:, : own.shape[1]] = units @ own
    return out


def _list_rows(column: pa.Array, kind: np.dtype) -> list[np.ndarray]:
    flat = np.asarray(column.flatten(), kind) + kind.type(0)  # no negative zero
    ends = np.cumsum([len(x) for x in column])
    return np.split(flat, ends[:-1]) if len(ends) else []


def _place(axes: dict[int, np.ndarray], kind: np.dtype, epsilon: float):
    """Rows with their digest, bytes and grid cells."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _list_rows(batch.column("embedding"), kind)
            dims = np.array([len(x) for x in rows], np.int32)
            cells: list = [None] * len(rows)
            for dim in np.unique(dims):
                at = np.nonzero(dims == dim)[0]
                along = _along(_units(np.stack([rows[i] for i in at])), axes)
                for i, cell in zip(at, np.floor(along / epsilon).astype(np.int32), strict=True):
                    cells[i] = cell
            raw = [x.tobytes() for x in rows]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"),
                    pa.array(dims, pa.int32()),
                    pa.array([hashlib.md5(x).digest() for x in raw], pa.binary()),
                    pa.array(raw, pa.binary()),
                    pa.array(cells, pa.list_(pa.int32())),
                ],
                ["vec_id", "dim", "digest", "raw", "cells"],
            )

    return place


def _cut(axes: dict[int, np.ndarray], kind: np.dtype, interval_rows: int):
    """The sorted vectors of a task as intervals of one dimension each."""

    def interval(number: int, rows: list[dict]) -> dict:
        part = TaskContext.get().partitionId()
        dim = rows[0]["dim"]
        raw = b"".join(r["raw"] for r in rows)
        along = _along(_units(np.frombuffer(raw, kind).reshape(-1, dim)), axes)
        return {
            "id": part << 20 | number,
            "part": part,
            "dim": dim,
            "digests": b"".join(r["digest"] for r in rows),
            "ids": np.array([r["vec_id"] for r in rows], np.int64).tobytes(),
            "copies": np.array([r["copies"] for r in rows], np.int64).tobytes(),
            "raw": raw,
            **dict(zip(_LOW, along.min(axis=0).tolist(), strict=True)),
            **dict(zip(_HIGH, along.max(axis=0).tolist(), strict=True)),
        }

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, rows, size = 0, [], 0
        for batch in batches:
            for row in batch.to_pylist():
                full = len(rows) >= interval_rows or size + len(row["raw"]) > INTERVAL_BYTES
                if rows and (full or row["dim"] != rows[0]["dim"]):
                    yield pa.RecordBatch.from_pylist([interval(number, rows)], _INTERVAL_TYPE)
                    number, rows, size = number + 1, [], 0
                rows.append(row)
                size += len(row["raw"])
        if rows:
            yield pa.RecordBatch.from_pylist([interval(number, rows)], _INTERVAL_TYPE)

    return cut


_INTERVAL_TYPE = pa.schema(
    [("id", pa.int64()), ("part", pa.int32()), ("dim", pa.int32())]
    + [(name, pa.binary()) for name in ("digests", "ids", "copies", "raw")]
    + [(name, pa.float64()) for name in [*_LOW, *_HIGH]]
)


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """node, dim, digest, vec_id, copies of every vector of the intervals."""
    for batch in batches:
        for row in batch.to_pylist():
            ids = np.frombuffer(row["ids"], np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(_numbers(row["id"], len(ids))),
                    pa.array(np.full(len(ids), row["dim"], np.int32)),
                    pa.array([row["digests"][i : i + 16] for i in range(0, 16 * len(ids), 16)]),
                    pa.array(ids),
                    pa.array(np.frombuffer(row["copies"], np.int64)),
                ],
                ["node", "dim", "digest", "vec_id", "copies"],
            )


def _numbers(interval: int, rows: int) -> np.ndarray:
    """The nodes of an interval's vectors; an interval has fewer than 2^13 of them."""
    return (interval << 13) + np.arange(rows, dtype=np.int64)


class _Interval:
    """An interval in a task: unit vectors, and the boxes of its leaves."""

    def __init__(self, row: dict, side: str, axes: dict[int, np.ndarray], kind: np.dtype):
        self.id = row[f"{side}_id"]
        self.raw = np.frombuffer(row[f"{side}_raw"], kind).reshape(-1, row["dim"])
        self.copies = np.frombuffer(row[f"{side}_copies"], np.int64)
        self.units = _units(self.raw)
        along = _along(self.units, axes)
        starts = np.arange(0, len(along), LEAF_ROWS)
        self.low = np.minimum.reduceat(along, starts)
        self.high = np.maximum.reduceat(along, starts)

    def leaf(self, k: int) -> slice:
        return slice(k * LEAF_ROWS, min((k + 1) * LEAF_ROWS, len(self.units)))


def _leaf_pairs(left: _Interval, right: _Interval, epsilon: float) -> Iterator[tuple[int, int]]:
    """Pairs of leaves whose boxes are within epsilon, found by halving both sequences."""
    same = left.id == right.id
    stack = [(0, len(left.low), 0, len(right.low))]
    while stack:
        a, b, c, d = stack.pop()
        if same and d <= a:
            continue  # the mirror image of another pair
        over = left.low[a:b].min(axis=0) - right.high[c:d].max(axis=0)
        under = right.low[c:d].min(axis=0) - left.high[a:b].max(axis=0)
        gap = np.maximum(0, np.maximum(over, under))
        if math.sqrt(gap @ gap) > epsilon + 1e-9:
            continue
        if b - a == 1 and d - c == 1:
            if not same or a <= c:
                yield a, c
        elif b - a >= d - c:
            middle = (a + b) // 2
            stack += [(a, middle, c, d), (middle, b, c, d)]
        else:
            middle = (c + d) // 2
            stack += [(a, b, c, middle), (a, b, middle, d)]


def _exact_cosine(x: np.ndarray, y: np.ndarray) -> float:
    x, y = _units(np.stack([x, y]))
    return math.fsum(x * y) / math.sqrt(math.fsum(x * x) * math.fsum(y * y))


def _linked(left: _Interval, right: _Interval, a: slice, c: slice, similarity: float):
    """Which vectors of two leaves are linked, as a matrix."""
    products = left.units[a] @ right.units[c].T
    linked = products >= similarity
    for i, j in zip(*np.nonzero(np.abs(products - similarity) < CLOSE), strict=True):
        linked[i, j] = (
            _exact_cosine(left.raw[a.start + i], right.raw[c.start + j]) >= similarity
        )
    return linked


def _groups(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows and columns with a link, the smallest row they are connected to."""
    none = len(linked)
    rows = np.where(linked.any(axis=1), np.arange(none), none)
    while True:
        columns = np.where(linked, rows[:, None], none).min(axis=0)
        lower = np.minimum(rows, np.where(linked, columns[None, :], none).min(axis=1))
        if (lower == rows).all():
            return rows, columns
        rows = lower


class _Forest:
    """Union-find over the vectors of a pair of intervals."""

    def __init__(self, size: int):
        self.up = list(range(size))

    def root(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.root(x), self.root(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)


def _join(axes: dict[int, np.ndarray], kind: np.dtype, similarity: float, epsilon: float):
    """For each pair of intervals: node, number of links, and a node it is connected to."""

    def met(left: _Interval, right: _Interval) -> pa.RecordBatch:
        same, size = left.id == right.id, len(left.units)
        shift = 0 if same else size
        counts = np.zeros(shift + len(right.units), np.int64)
        forest = _Forest(len(counts))
        for p, q in _leaf_pairs(left, right, epsilon):
            a, c = left.leaf(p), right.leaf(q)
            linked = _linked(left, right, a, c, similarity)
            if same and p == q:
                np.fill_diagonal(linked, False)
            if not linked.any():
                continue
            counts[a] += linked @ right.copies[c]
            if not (same and p == q):
                counts[c.start + shift : c.stop + shift] += left.copies[a] @ linked
            rows, columns = _groups(linked)
            for i in np.nonzero(rows < np.arange(len(rows)))[0].tolist():
                forest.join(a.start + i, a.start + int(rows[i]))
            for j in np.nonzero(columns < len(rows))[0].tolist():
                forest.join(c.start + shift + j, a.start + int(columns[j]))
        at = np.nonzero(counts)[0]
        numbers = _numbers(left.id, size)
        if not same:
            numbers = np.concatenate([numbers, _numbers(right.id, len(right.units))])
        roots = numbers[[forest.root(x) for x in at.tolist()]]
        return pa.RecordBatch.from_arrays(
            [pa.array(numbers[at]), pa.array(counts[at]), pa.array(roots, pa.int64())],
            ["node", "links", "other"],
        )

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                yield met(*(_Interval(row, side, axes, kind) for side in ("left", "right")))

    return join


def near_intervals(intervals: DataFrame, epsilon: float, parts: int) -> DataFrame:
    """left_id, right_id: pairs of intervals, each once, that are not provably distant.

    A tree is laid over the sequence of intervals; pairs of its nodes are followed from the
    root down, and only the children of pairs within epsilon are paired again.
    """
    spark = intervals.sparkSession
    boxes = [F.min(c).alias(c) for c in _LOW] + [F.max(c).alias(c) for c in _HIGH]
    names = [*_LOW, *_HIGH]
    part = F.col("part").cast("long")
    leaves = intervals.select(F.col("id").alias("key"), part.alias("parent"), "dim", *names)
    levels = [leaves]
    depth = 0
    while depth == 0 or (parts - 1) >> (FAN_BITS * (depth - 1)):
        key = F.shiftright(part, FAN_BITS * depth)
        nodes = intervals.groupBy(key.alias("key")).agg(*boxes)
        levels.append(nodes.withColumn("parent", F.shiftright("key", FAN_BITS)))
        depth += 1
    # The topmost level has one node, its own parent.
    pairs = spark.range(1).select(F.col("id").alias("p"), F.col("id").alias("q"))
    for nodes in reversed(levels):
        left, right = (
            nodes.select(*[F.col(c).alias(f"{side}_{c}") for c in nodes.columns])
            for side in ("left", "right")
        )
        met = pairs.join(left, F.col("p") == F.col("left_parent"))
        met = met.join(right, F.col("q") == F.col("right_parent"))
        met = met.where(F.col("left_key") <= F.col("right_key"))
        gaps = [
            F.greatest(
                F.lit(0.0),
                F.col(f"left_{low}") - F.col(f"right_{high}"),
                F.col(f"right_{low}") - F.col(f"left_{high}"),
            )
            for low, high in zip(_LOW, _HIGH, strict=True)
        ]
        apart = F.sqrt(sum((g * g for g in gaps), F.lit(0.0)))
        met = met.where(apart <= epsilon + 1e-9)
        if nodes is leaves:
            met = met.where(F.col("left_dim") == F.col("right_dim"))
        pairs = met.select(F.col("left_key").alias("p"), F.col("right_key").alias("q"))
    return pairs.select(F.col("p").alias("left_id"), F.col("q").alias("right_id"))


def near_duplicates(
    vectors: DataFrame,
    similarity: float = SIMILARITY,
    interval_rows: int = INTERVAL_ROWS,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``vectors`` (vec_id, embedding).

    Rows are linked if they have vectors of one dimension and a cosine of at least
    ``similarity``, in double precision. n_links counts the rows linked directly,
    component_id is the smallest id reachable, and kept says whether it is the row's own.
    Rows that repeat an id are rows of their own. A null or zero vector, one with a null or
    non-finite component, and a row without an id link with nothing; the last has a null
    component and is kept. Further columns are ignored; an empty table gives no rows.
    The axes are fitted on ``sample_rows`` vectors; they decide what is skipped, never what
    is found.
    """
    if not 0 < similarity <= 1:
        raise ValueError(f"the similarity must lie above 0 and up to 1, not {similarity!r}")
    if not 0 < interval_rows <= INTERVAL_ROWS:
        raise ValueError(f"an interval has 1 to {INTERVAL_ROWS} vectors, not {interval_rows!r}")
    spark = vectors.sparkSession
    epsilon = max(math.sqrt(max(0.0, 2 - 2 * similarity)), 1e-6)
    kind = np.dtype(
        np.float32 if "array<float>" in dict(vectors.dtypes)["embedding"] else np.float64
    )
    vec_id = F.col("vec_id").cast("long").alias("vec_id")
    rows = vectors.select(vec_id, "embedding")
    ready = rows.where(_takes_part(rows))
    if kind == np.float64:
        ready = ready.select("vec_id", F.col("embedding").cast("array<double>"))
    sample = ready.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows).collect()
    axes = principal_axes([np.array(row["embedding"], np.float64) for row in sample])

    points = stored(to_tasks(ready, _place(axes, kind, epsilon), _POINTS), "points")
    key = ["dim", "digest"]
    classes = points.groupBy(*key).agg(
        F.min("vec_id").alias("vec_id"),
        F.count("*").alias("copies"),
        F.first("raw").alias("raw"),
        F.first("cells").alias("cells"),
    )
    classes = stored(classes, "vector-classes")
    size = classes.agg(F.count("*").alias("n"), F.max("dim").alias("dim")).first()
    fits = max(1, min(interval_rows, INTERVAL_BYTES // ((size["dim"] or 1) * kind.itemsize)))
    parts = max(1, -(-size["n"] // fits))
    order = ["dim", "cells", "digest"]
    # Neighbouring partitions are joined again where there are more than asked for.
    ordered = classes.repartitionByRange(parts, *order).sortWithinPartitions(*order).coalesce(parts)
    columns = ["dim", "digest", "vec_id", "copies", "raw"]
    intervals = stored(
        to_tasks(ordered.select(*columns), _cut(axes, kind, interval_rows), _INTERVALS),
        "intervals",
    )

    def side(name: str) -> DataFrame:
        return intervals.select(
            F.col("id").alias(f"{name}_id"),
            F.col("raw").alias(f"{name}_raw"),
            F.col("copies").alias(f"{name}_copies"),
            *([F.col("dim")] if name == "left" else []),
        )

    pairs = near_intervals(intervals, epsilon, parts)
    # Half of the pairs change sides, so that each interval is on the left of as many.
    turned = (F.col("left_id") + F.col("right_id")) % 2 == 1
    pairs = pairs.select(
        F.when(turned, F.col("right_id")).otherwise(F.col("left_id")).alias("left_id"),
        F.when(turned, F.col("left_id")).otherwise(F.col("right_id")).alias("right_id"),
    )
    tasks = max(parts, int(spark.conf.get("spark.sql.shuffle.partitions")))
    half = pairs.join(side("right").hint("merge"), "right_id").repartition(tasks, "left_id")
    both = half.join(side("left").repartition(tasks, "left_id").hint("merge"), "left_id")
    found = stored(
        to_tasks(both, _join(axes, kind, similarity, epsilon), "node long, links long, other long"),
        "vector-links",
    )

    nodes = to_tasks(
        intervals.select("id", "dim", "digests", "ids", "copies"),
        _nodes,
        "node long, dim int, digest binary, vec_id long, copies long",
    )
    sums = found.groupBy("node").agg(F.sum("links").alias("links"))
    edges = found.where("node <> other").select(F.col("node").alias("a"), F.col("other").alias("b"))
    rooted = (
        nodes.join(sums, "node", "left")
        .join(components(edges), "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
    )
    rooted = stored(rooted, "rooted-vectors")
    least = rooted.groupBy("root").agg(F.min("vec_id").alias("component_id"))
    others = (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    known = rooted.join(least, "root").select(*key, others, "component_id")
    linked = points.select("vec_id", *key).join(known, key)
    alone = rows.where(~_takes_part(rows))
    none = F.lit(0).cast("long").alias("n_links")
    alone = alone.select("vec_id", none, F.col("vec_id").alias("component_id"))
    result = linked.select("vec_id", "n_links", "component_id").unionByName(alone)
    return result.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
