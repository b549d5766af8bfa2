"""Exact top-k inner products by a three-phase uniform threshold.

The dimensions of all vectors are cut into a few ranges; each range gives a partial
score. Phase one gathers, per query and range, the best partial scores of every block
of vectors; their full scores give a cutoff that the k best are sure to reach. As a
score is the sum of its parts, a vector that reaches the cutoff reaches the cutoff's
equal share in at least one range (parts are counted from their minimum, which makes
them non-negative). Phase two collects the entries with such a share, and phase three
resolves their scores in full.

Vectors are packed into blocks of rows and never leave their shard; blocks of queries
are sent to each shard. A task holds one block of either side at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termlode.llm.common import stored, to_tasks

RANGES = 4
VECTOR_ROWS, QUERY_ROWS = 2048, 256
# Doubles hold sums of products exactly up to here.
EXACT_DOUBLE = float(1 << 52)

_BLOCK = "dim int, ids binary, items binary, first long"
_PART = [f"low_{j}" for j in range(RANGES)]
_FOUND = "query_id long, vec_id long, score long, " + ", ".join(f"{c} long" for c in _PART)


def quantised(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """vec_id and items = floor(scale * x) of vectors that take part.

    Left out are rows without an id, null or empty vectors, and vectors with a null or
    non-finite component.
    """
    x = F.col("embedding").cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    items = F.transform(x, lambda v: F.floor(v * scale).cast("long"))
    return vectors.where(
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & (F.size(x) > 0) & finite
    ).select(F.col("vec_id").cast("long").alias("vec_id"), items.alias("items"))


def _pack(rows: int, extra: list[str]):
    """Rows as blocks: ids, and a matrix of items (and of further columns behind them)."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                ids = np.asarray(part.column("vec_id"), np.int64)
                items = part.column("items")
                flat = np.asarray(items.flatten(), np.int64)
                dims = np.diff(np.asarray(items.offsets))
                starts = np.concatenate([[0], np.cumsum(dims)[:-1]])
                more = [np.asarray(part.column(c), np.int64) for c in extra]
                out = []
                for dim in np.unique(dims):
                    at = np.nonzero(dims == dim)[0]
                    matrix = flat[starts[at][:, None] + np.arange(dim)]
                    matrix = np.column_stack([matrix, *[m[at] for m in more]])
                    out.append((int(dim), ids[at].tobytes(), matrix.tobytes(), int(ids[at[0]])))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([o[0] for o in out], pa.int32()),
                        pa.array([o[1] for o in out], pa.binary()),
                        pa.array([o[2] for o in out], pa.binary()),
                        pa.array([o[3] for o in out], pa.int64()),
                    ],
                    ["dim", "ids", "items", "first"],
                )

    return pack


def _parts(vectors: np.ndarray, queries: np.ndarray) -> list[np.ndarray]:
    """Partial scores per range, queries by vectors, as exact integers."""
    top = np.abs(vectors).max(initial=0).astype(float) * np.abs(queries).max(initial=0)
    kind = np.float64 if top * vectors.shape[1] < EXACT_DOUBLE else np.int64
    left, right = queries.astype(kind), vectors.astype(kind)
    cuts = [vectors.shape[1] * j // RANGES for j in range(RANGES + 1)]
    return [left[:, a:b] @ right[:, a:b].T for a, b in zip(cuts, cuts[1:], strict=False)]


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best distinct ids: highest score, then smallest id."""
    order = np.lexsort((ids, -scores))
    if k < len(order):
        kept = ids[order]
        _, first = np.unique(kept, return_index=True)
        order = order[np.sort(first)[:k]]
    return order


def _unpack(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    dim = row["dim"]
    ids, query_ids = (np.frombuffer(row[c], np.int64) for c in ("ids", "query_ids"))
    vectors = np.frombuffer(row["items"], np.int64).reshape(len(ids), dim)
    asked = np.frombuffer(row["query_items"], np.int64).reshape(len(query_ids), -1)
    return ids, vectors, query_ids, asked[:, :dim], asked[:, dim:]


def _rows(found: list[tuple]) -> pa.RecordBatch:
    names = ["query_id", "vec_id", "score", *_PART]
    columns = list(zip(*found, strict=True)) if found else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)


def _gather(k: int):
    """Phase one: the best of every range with their full scores, and each range's minimum."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, vectors, query_ids, queries, _ = _unpack(batch.slice(i, 1).to_pylist()[0])
                parts = _parts(vectors, queries)
                total = sum(parts)
                lows = np.stack([p.min(axis=1) for p in parts])
                # A few more than k, as the query's own row does not count.
                keep = min(k + 1, len(ids))
                tops = [np.argpartition(-p, keep - 1, axis=1)[:, :keep] for p in parts]
                found = []
                for q, query in enumerate(query_ids):
                    at = np.unique(np.concatenate([t[q] for t in tops]))
                    at = at[ids[at] != query]
                    at = at[_best(total[q, at], ids[at], k)]
                    low = [int(x) for x in lows[:, q]]
                    found += [(int(query), int(ids[v]), int(total[q, v]), *low) for v in at]
                yield _rows(found)

    return gather


def _resolve(k: int):
    """Phases two and three: entries with a share of the cutoff, resolved in full."""

    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                ids, vectors, query_ids, queries, cutoffs = _unpack(row)
                parts = _parts(vectors, queries)
                enough = np.zeros(parts[0].shape, bool)
                for j, part in enumerate(parts):
                    enough |= part >= cutoffs[:, 1 + j, None]
                total = sum(parts)
                enough &= total >= cutoffs[:, :1]
                enough &= ids[None, :] != query_ids[:, None]
                found = []
                for q, query in enumerate(query_ids):
                    at = np.nonzero(enough[q])[0]
                    at = at[_best(total[q, at], ids[at], k)]
                    none = [0] * RANGES
                    found += [(int(query), int(ids[v]), int(total[q, v]), *none) for v in at]
                yield _rows(found)

    return resolve


def _meet(blocks: DataFrame, queries: DataFrame, extra: list[str], work) -> DataFrame:
    """Every block of queries with every block of vectors of its dimension."""
    spark = blocks.sparkSession
    shards = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    asked = to_tasks(queries, _pack(QUERY_ROWS, extra), _BLOCK).select(
        "dim",
        F.col("ids").alias("query_ids"),
        F.col("items").alias("query_items"),
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
    )
    placed = blocks.withColumn("shard", F.pmod(F.xxhash64("first"), F.lit(shards)).cast("int"))
    pairs = placed.join(asked.hint("merge"), ["shard", "dim"])
    met = pairs.select("dim", "ids", "items", "query_ids", "query_items")
    return to_tasks(met, work, _FOUND)


def top_k(vectors: DataFrame, k: int = 5, query_every: int = 50, scale: int = 256) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest inner products of each query.

    ``vectors`` has vec_id and embedding; further columns are ignored. Queries are the
    rows whose id is divisible by ``query_every``; candidates are all rows but those with
    the query's id, of the query's dimension. Ties go to the smaller id; a query with
    fewer candidates than k has as many rows. Rows that repeat an id count as one
    candidate, with the best of their scores. Null and non-finite vectors take no part;
    an empty table gives no rows.
    """
    ready = quantised(vectors, scale)
    blocks = stored(to_tasks(ready, _pack(VECTOR_ROWS, []), _BLOCK), "vector-blocks")
    queries = stored(ready.where(F.col("vec_id") % query_every == 0), "vector-queries")
    best_first = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    lists = _meet(blocks, queries, [], _gather(k))
    merged = lists.groupBy("query_id", "vec_id").agg(
        F.max("score").alias("score"), *[F.min(c).alias(c) for c in _PART]
    )
    ranked = merged.withColumn("rank", F.row_number().over(best_first))
    lows = [F.min(c).alias(c) for c in _PART]
    cutoff = F.max(F.when(F.col("rank") == k, F.col("score"))).alias("cutoff")
    known = ranked.groupBy("query_id").agg(cutoff, *lows)
    lowest = -(1 << 62)
    base = sum((F.col(c) for c in _PART), F.lit(0).cast("long"))
    # The minimum plus an equal share, rounded down.
    shares = [
        F.coalesce(
            F.col(c) + F.call_function("div", F.col("cutoff") - base, F.lit(RANGES)) - 1,
            F.lit(lowest),
        ).alias(f"share_{j}")
        for j, c in enumerate(_PART)
    ]
    limits = known.select(
        F.col("query_id").alias("vec_id"),
        F.coalesce("cutoff", F.lit(lowest)).alias("cutoff"),
        *shares,
    )
    names = ["cutoff", *[f"share_{j}" for j in range(RANGES)]]
    armed = stored(
        queries.join(limits, "vec_id", "left").select(
            "vec_id", "items", *[F.coalesce(c, F.lit(lowest)).alias(c) for c in names]
        ),
        "vector-cutoffs",
    )
    sure = _meet(blocks, armed, names, _resolve(k))
    scores = sure.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    result = scores.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= k)
    return result.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
