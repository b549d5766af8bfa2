"""Word vectors: terms that keep the same company, to widen a query.

The weights of terms in documents are a matrix A of terms by documents. Terms are alike where
their rows of A * A' are, which say with what else they occur. That product is never formed:
a random sketch A * S finds the directions that matter, products with A' and A sharpen it
(both are one grouped sum over the postings), and vectors are the terms' places in it. The
driver sees Gram matrices of a few numbers, whatever the corpus.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import AbstractContextManager

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termlode.functions import scoring
from termlode.operators.joins import attach_df
from termlode.operators.topn import best, best_of_one, check_result_count
from termlode.plans.blocks import range_numbers
from termlode.plans.index import (
    SearchIndex,
    bucketed,
    check_location,
    discard_bucketed,
    write_bucketed,
)
from termlode.plans.search import FILTER_TERMS, as_queries, narrow, query_terms
from termlode.plans.shared import scratch_path, settings, settle

DIMENSIONS, ROUNDS, LEAST_DOCUMENTS = 16, 2, 2
# One hash of a document gives the signs of all dimensions.
MOST_DIMENSIONS = 64
# Postings of a part of the documents, and parts for each core if there are so many shards.
PART_POSTINGS, TASKS_PER_CORE = 10_000_000, 2
# Rows that a plan has shuffled are deleted when its result is there, not with the driver's garbage.
DELETE_SHUFFLED = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
# Directions with less than this share of the largest one's energy are rounding.
_NOISE = 1e-12


def _weighted(index: SearchIndex) -> DataFrame:
    """doc_id, term, weight without the idf of its term, as the postings stand.

    The idf is the same in all of a term's postings, so it goes to the sums: no posting has
    to meet its frequency.
    """
    weight = (F.log("tf") + 1) / F.sqrt("len")
    return index.postings.select("doc_id", "term", weight.alias("weight"))


def _sums(parts: list[Column]) -> Column:
    return F.array(*[F.sum(part) for part in parts])


def _gram(frame: DataFrame, name: str, size: int) -> np.ndarray:
    """Sums of products of the entries of an array column: size by size numbers.

    Tasks add up their rows first, so one row of each is shuffled.
    """
    places = [(i, j) for i in range(size) for j in range(i + 1)]
    gram = np.zeros((size, size))
    if places:
        # An empty frame has null sums.
        sums = [F.sum(F.col(name)[i] * F.col(name)[j]) for i, j in places]
        totals = frame.agg(F.array(*sums).alias("totals")).first()["totals"]
        for (i, j), total in zip(places, totals, strict=True):
            gram[i, j] = gram[j, i] = total or 0.0
    return gram


def _product(one: Column, other: Column) -> Column:
    """The scalar product of two arrays."""
    each = F.zip_with(one, other, lambda x, y: x * y)
    return F.aggregate(each, F.lit(0.0), lambda total, x: total + x)


def _turned(name: str, matrix: np.ndarray) -> Column:
    """An array column times a small matrix."""
    columns = F.array(*[_constant(column) for column in matrix.T])
    return F.transform(columns, lambda column: _product(F.col(name), column))


def _constant(numbers: np.ndarray) -> Column:
    return F.array(*[F.lit(float(x)) for x in numbers])


def _directions(gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvectors of a Gram matrix that are more than noise, strongest first, and energies."""
    energies, turns = np.linalg.eigh(gram)
    energies, turns = energies[::-1], turns[:, ::-1]
    kept = (energies > 0) & (energies > _NOISE * energies.max(initial=0))
    return energies[kept], turns[:, kept]


def _shape(index: SearchIndex) -> tuple[int, Column]:
    """How many parts the documents fall into, and which one (from 0) a document is in.

    A part is some shards of the index, or a piece of one; by the number of postings, so that
    the rows of a part's terms fit a task's memory however the index was cut.
    """
    spark = index.postings.sparkSession
    postings = index.stats.select("n_postings").first()[0] or 0
    shards = index.shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cores = spark.sparkContext.defaultParallelism
    parts = max(-(-postings // PART_POSTINGS), min(shards, TASKS_PER_CORE * cores))
    if parts >= shards:
        parts = -(-parts // shards) * shards
        return parts, F.pmod(F.hash("doc_id"), F.lit(parts))
    shard = F.pmod(F.hash("doc_id"), F.lit(shards))
    return parts, (shard * parts / shards).cast("int")


class _Tables:
    """Stored tables of one factorisation, all in as many buckets, by part or by term.

    rows    part, doc_id, term, weight; the postings, as _weighted has them
    pairs   part, term; where the terms stand that are in enough documents
    """

    def __init__(self, index: SearchIndex, least: int) -> None:
        self.spark = index.postings.sparkSession
        self.root = scratch_path(self.spark, "factors")
        self.parts, at = _shape(index)
        self._kept: list[str] = []
        # Each bucket gets one part.
        numbers = range_numbers(self.spark, self.parts, self.parts)
        part = F.get(F.array(*[F.lit(number) for number in numbers]), at)
        rows = _weighted(index).withColumn("part", part)
        if index.shards is None:
            rows = rows.repartition(self.parts, "part")
        with self.settings():
            # A part is all of its bucket, so the order of the postings, by term, stays as it is.
            self.rows = self.keep(rows, "part", ["part"])
            kept = index.frequencies.where(F.col("df") >= least)
            pairs = self.rows.select("part", "term").distinct().join(kept, "term", "left_semi")
            self.pairs = self.keep(pairs, "term", ["term"])

    def settings(self) -> AbstractContextManager[None]:
        """What a pass over the tables is planned and run with.

        Rows that lie together by part meet there, though they meet by part and term; and
        shuffled rows are deleted when the result of a pass is stored.
        """
        return settings(
            self.spark,
            {
                "spark.sql.shuffle.partitions": str(self.parts),
                "spark.sql.requireAllClusterKeysForCoPartition": "false",
                **DELETE_SHUFFLED,
            },
        )

    def keep(self, frame: DataFrame, key: str, order: list[str]) -> DataFrame:
        name = f"table{len(self._kept)}"
        self._kept.append(name)
        write_bucketed(frame, self.root, name, self.parts, order, key)
        table = bucketed(self.spark, self.root, name, self.parts, order, key)
        table.scratch_name = name
        return table

    def discard(self, table: DataFrame) -> None:
        """Deletes a table of which nothing more is read."""
        discard_bucketed(self.spark, self.root, table.scratch_name, self.parts)


def term_vectors(
    index: SearchIndex,
    dimensions: int = DIMENSIONS,
    rounds: int = ROUNDS,
    least_documents: int = LEAST_DOCUMENTS,
) -> DataFrame:
    """term, df, vector (at most ``dimensions`` numbers) of terms in enough documents.

    Scalar products of vectors come near those of the terms' rows of weights, and equal them
    where the weights have no more directions than that. An empty index has no rows. Documents
    fall into parts; a term's sums cross the network once for each part that it stands in, from
    there and back to it, and no posting of a stored index does. No term is one task's work. A round costs two
    passes over the weights, which are stored by part, and leaves no shuffled rows behind.
    """
    return _factors(index, dimensions, rounds, least_documents)[0]


def _factors(
    index: SearchIndex, dimensions: int, rounds: int, least: int
) -> tuple[DataFrame, Callable[[], None]]:
    """The vectors as a plan over a stored table, and what deletes that."""
    if not 1 <= dimensions <= MOST_DIMENSIONS:
        raise ValueError(f"dimensions must be from 1 to {MOST_DIMENSIONS}, not {dimensions!r}")
    tables = _Tables(index, least)
    bits = F.xxhash64("doc_id")
    signs = [1 - 2 * F.shiftright(bits, j).bitwiseAND(F.lit(1)) for j in range(dimensions)]
    energies = np.zeros(0)
    with tables.settings():
        sketch = [F.col("weight") * sign for sign in signs]
        sketch = _of_terms(index, tables, tables.rows, sketch, least)
        basis, size = _orthonormal(tables, sketch, dimensions)
        for turn in range(rounds + 1):
            if not size:
                break
            places = _places(index, tables, basis, size)
            if turn == rounds:
                energies, turns = _directions(_gram(places, "z", size))
                tables.discard(places)
                break
            tables.discard(basis)
            sharper = [F.col("weight") * F.col("z")[j] for j in range(size)]
            met = tables.rows.join(places.hint("shuffle_hash"), ["part", "doc_id"])
            sharper = _of_terms(index, tables, met, sharper, least)
            tables.discard(places)
            basis, size = _orthonormal(tables, sharper, size)
    tables.discard(tables.rows)
    tables.discard(tables.pairs)
    vector = F.array().cast("array<double>")
    if len(energies):
        vector = _turned("y", turns * np.sqrt(energies))
    found = basis.select("term", "df", vector.alias("vector"))
    return found, lambda: tables.discard(basis)


def _of_terms(
    index: SearchIndex, tables: _Tables, rows: DataFrame, sums: list[Column], least: int
) -> DataFrame:
    """term, df, y: sums of a term's postings, times its idf; of terms in enough documents."""
    added = rows.groupBy("term").agg(F.count("*").alias("df"), _sums(sums).alias("y"))
    idf = scoring.bm25_idf(F.col("df"), index.stat("n_docs"))
    each = F.array(*[F.col("y")[j] * F.col("idf") for j in range(len(sums))]).alias("y")
    kept = added.where(F.col("df") >= least).select("term", "df", "y", idf.alias("idf"))
    return tables.keep(kept.select("term", "df", each), "term", ["term"])


def _orthonormal(tables: _Tables, frame: DataFrame, size: int) -> tuple[DataFrame, int]:
    """The same space with orthonormal columns in place of a stored one, and how many they are."""
    energies, turns = _directions(_gram(frame, "y", size))
    if not len(energies):
        return frame, 0
    turned = _turned("y", turns / np.sqrt(energies)).alias("y")
    # Stored, or each use of the array would compute it again for each of its entries.
    basis = tables.keep(frame.select("term", "df", turned), "term", ["term"])
    tables.discard(frame)
    return basis, len(energies)


def _places(index: SearchIndex, tables: _Tables, basis: DataFrame, size: int) -> DataFrame:
    """part, doc_id, z: documents in the directions of a basis.

    The entries of a term go to the parts that it stands in, where its postings are, and a
    document's sum is made in its part.
    """
    idf = scoring.bm25_idf(F.col("df"), index.stat("n_docs"))
    known = attach_df(tables.pairs, basis.withColumn("idf", idf), index.stat("n_postings"))
    entries = F.array(*[F.col("y")[j] * F.col("idf") for j in range(size)]).alias("y")
    met = tables.rows.join(
        known.select("part", "term", entries).hint("shuffle_hash"), ["part", "term"]
    )
    sums = _sums([F.col("weight") * F.col("y")[j] for j in range(size)]).alias("z")
    return tables.keep(met.groupBy("part", "doc_id").agg(sums), "part", ["doc_id"])


def write_vectors(
    index: SearchIndex,
    root: str,
    dimensions: int = DIMENSIONS,
    rounds: int = ROUNDS,
    least_documents: int = LEAST_DOCUMENTS,
) -> DataFrame:
    """Stores term_vectors in a new folder, sorted by term, and reads them back."""
    check_location(root)
    vectors, discard = _factors(index, dimensions, rounds, least_documents)
    with settings(vectors.sparkSession, DELETE_SHUFFLED):
        vectors.sort("term").write.mode("errorifexists").parquet(root)
    discard()
    return vectors.sparkSession.read.parquet(root)


def similar_terms(vectors: DataFrame, words: str, n: int) -> DataFrame:
    """asked, rank, term, df, similarity: the n terms most alike to each token of ``words``.

    Similarity is the cosine of vectors, to nine digits; equal ones rank by term. Tokens
    without a vector have no rows, and at most 100 different ones can be asked. Their vectors are constants of
    one pass over all others; tasks keep n rows for each.
    """
    asked = query_terms(as_queries(vectors.sparkSession, words)).select("term").distinct()
    known = sorted(row["term"] for row in asked.limit(FILTER_TERMS + 1).collect())
    if len(known) > FILTER_TERMS:
        raise ValueError(f"at most {FILTER_TERMS} terms can be asked at once")
    found = {row["term"]: np.array(row["vector"]) for row in narrow(vectors, known).collect()}
    units = {t: v / np.sqrt(v @ v) for t, v in sorted(found.items()) if v @ v > 0}
    if not units:
        shown = "'' AS asked", "0 AS rank", "term", "df", "CAST(0 AS DOUBLE) AS similarity"
        return vectors.where(F.lit(False)).selectExpr(*shown)
    pairs = [
        F.struct(
            F.lit(term).alias("asked"), _product(F.col("vector"), _constant(unit)).alias("dot")
        )
        for term, unit in units.items()
    ]
    squares = _product(F.col("vector"), F.col("vector")).alias("squares")
    rows = vectors.select("term", "df", squares, F.array(*pairs).alias("pairs"))
    rows = rows.where(F.col("squares") > 0).select("term", "df", "squares", F.inline("pairs"))
    similarity = F.round(F.col("dot") / F.sqrt("squares"), 9)
    rows = rows.where(F.col("term") != F.col("asked"))
    rows = rows.select("asked", "term", "df", similarity.alias("similarity"))
    order = Window.partitionBy("asked").orderBy(F.desc("similarity"), "term")
    ranked = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
    return ranked.select("asked", "rank", "term", "df", "similarity")


def expanded_search(
    index: SearchIndex,
    vectors: DataFrame,
    query: str,
    n: int,
    similar: int = 3,
    least: float = 0.5,
    k1: float = scoring.K1,
    b: float = scoring.B,
) -> DataFrame:
    """rank, doc_id, score: the best by BM25 over the query's terms and those alike to them.

    Each term of the query brings in at most ``similar`` others with a similarity of ``least``
    or more; these count by their own idf times the highest of their similarities. Documents
    without any of the terms are no hits.
    """
    check_result_count(n)
    check_result_count(similar)
    scoring.check_bm25(k1, b)
    alike = similar_terms(vectors, query, similar).where(F.col("similarity") >= least)
    own = query_terms(as_queries(vectors.sparkSession, query)).select(
        "term", F.lit(1.0).alias("similarity")
    )
    shares = alike.select("term", "similarity").unionByName(own)
    shares = settle(shares.groupBy("term").agg(F.max("similarity").alias("similarity")))
    head = shares.select("term").limit(FILTER_TERMS + 1).collect()
    known = sorted(row["term"] for row in head) if len(head) <= FILTER_TERMS else None
    # At most 100 terms are asked, and each brings in ``similar`` others.
    idf = scoring.bm25_idf(F.col("df"), index.stat("n_docs"))
    weights = narrow(index.frequencies, known).join(F.broadcast(shares), "term")
    weights = weights.select("term", (idf * F.col("similarity")).alias("weight"))
    matched = narrow(index.postings, known).join(F.broadcast(weights), "term")
    part = scoring.bm25_term_score(
        F.col("weight"), F.col("tf"), F.col("len"), index.stat("avg_len"), k1, b
    )
    hits = matched.groupBy("doc_id").agg(F.sum(part).alias("score"))
    one = hits.select(F.lit(0).cast("long").alias("query_id"), "doc_id", "score")
    return best(best_of_one(one, n), n).drop("query_id")
