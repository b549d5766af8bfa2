"""Ranked search, for one query text or a DataFrame of queries."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termlode.functions import scoring
from termlode.functions.text import count_terms
from termlode.operators.topn import (
    best,
    best_of_one,
    check_result_count,
    pad_short_lists,
    pad_with_zeros,
)
from termlode.plans.index import SearchIndex
from termlode.plans.narrowing import Narrowed, narrow_postings
from termlode.plans.scratch import settle

# Query terms are broadcast in slices of this size, and top hits up to it, measured before.
BROADCAST_BYTES = 64 << 20
# So many slices are answered in one plan, which holds their broadcasts.
SLICES_AT_ONCE = 8
# Bytes that a broadcast row takes beside its term and id.
ROW_BYTES = 64
# Up to so many query terms are put into the scan filters.
FILTER_TERMS = 100


def as_queries(spark: SparkSession, query: str) -> DataFrame:
    """One query text as a frame of query_id and query."""
    one_row = spark.range(0, 1, 1, 1)
    return one_row.select(F.col("id").alias("query_id"), F.lit(query).alias("query"))


def query_terms(queries: DataFrame) -> DataFrame:
    """query_id, term, qtf, for queries of query_id (unique) and query."""
    return _terms_of(count_terms(queries, "query_id", "query"))


@dataclass(frozen=True)
class Asked:
    """Queries after tokenizing, the same in every use: query_id, terms (term, qtf)."""

    queries: DataFrame
    slices: list[DataFrame]
    known: list[str] | None

    @property
    def ids(self) -> DataFrame:
        return self.queries.select("query_id")


def ask(queries: DataFrame | str, spark: SparkSession, broadcast_bytes: int) -> Asked:
    """Tokenizes the queries once, and cuts their terms into slices that can be broadcast.

    A frame of queries is settled first: it may give other rows when it is read again, and
    everything below must speak of the same queries. Measuring runs a small job over the
    terms, and over nothing else. Few terms are collected, for the scan filters.
    """
    if isinstance(queries, str):
        counted = count_terms(as_queries(spark, queries), "query_id", "query")
    else:
        counted = settle(count_terms(queries, "query_id", "query"))
    terms = _terms_of(counted)
    sized = terms.select("term", row_bytes("term", "query_id").alias("bytes"))
    head = sized.limit(FILTER_TERMS + 1).collect()
    few = len(head) <= FILTER_TERMS
    known = sorted({row["term"] for row in head}) if few else None
    size = sum(row["bytes"] for row in head) if few else sized.agg(F.sum("bytes")).first()[0]
    number = max(1, -(-size // max(1, broadcast_bytes)))
    if number == 1:
        return Asked(counted, [terms], known)
    # A slice has at least one query.
    number = min(number, counted.count())
    place = F.pmod(F.xxhash64("query_id"), F.lit(number))
    return Asked(counted, [terms.where(place == i) for i in range(number)], known)


def _terms_of(counted: DataFrame) -> DataFrame:
    terms = counted.select("query_id", F.inline_outer("terms").alias("term", "qtf"))
    return terms.where(F.col("term").isNotNull())


def row_bytes(*columns: str) -> Column:
    """Bytes of a row with these columns in a broadcast table."""
    size = F.lit(ROW_BYTES)
    for column in columns:
        size = size + F.octet_length(F.col(column).cast("string"))
    return size


def known_query_terms(
    index: SearchIndex, queries: DataFrame | str, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """query_id, term, qtf, df; terms that no document contains are left out."""
    asked = ask(queries, index.stats.sparkSession, broadcast_bytes)
    return _all([_with_df(index, terms, asked.known) for terms in asked.slices])


def _all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def narrow(frame: DataFrame, known: list[str] | None, column: str = "term") -> DataFrame:
    """Only rows with these terms, as a chain of equalities.

    A list of more than ten values would reach the scan as its minimum and maximum.
    """
    if known is None:
        return frame
    return frame.where(reduce(or_, [F.col(column) == t for t in known], F.lit(False)))


def _with_df(index: SearchIndex, terms: DataFrame, known: list[str] | None) -> DataFrame:
    joined = narrow(index.frequencies, known).join(F.broadcast(terms), "term")
    return joined.select("query_id", "term", "qtf", "df")


def _asked_postings(index: SearchIndex, asked: Asked, broadcast_bytes: int) -> Narrowed:
    """What each pass of a batch reads."""
    if asked.known is not None:
        return Narrowed(narrow(index.postings, asked.known))
    if len(asked.slices) == 1:
        return Narrowed(index.postings)

    def size(terms: DataFrame) -> int:
        return terms.agg(F.sum(row_bytes("term"))).first()[0] or 0

    return narrow_postings(index, _terms_of(asked.queries), size, broadcast_bytes)


def _scores(
    index: SearchIndex, asked: Asked, rows: DataFrame, weight: Column, contribution: Column
) -> list[DataFrame]:
    """query_id, doc_id, score of all documents with at least one query term, slice by slice.

    One pass over the postings for each slice of the queries. The weights of a slice go to
    every task, so that no posting moves: the scores of a document add up in its bucket.
    """
    parts = []
    for terms in asked.slices:
        weights = _with_df(index, terms, asked.known)
        weights = weights.select("query_id", "term", weight.alias("weight"))
        matched = rows.join(F.broadcast(weights), "term")
        added = matched.select("query_id", "doc_id", contribution.alias("part"))
        parts.append(added.groupBy("query_id", "doc_id").agg(F.sum("part").alias("score")))
    return parts


def _search(
    index: SearchIndex,
    queries: DataFrame | str,
    n: int,
    include_zero: bool,
    broadcast_bytes: int,
    scores: Callable[[Asked, DataFrame], list[DataFrame]],
) -> DataFrame:
    check_result_count(n)
    asked = ask(queries, index.stats.sparkSession, broadcast_bytes)
    narrowed = _asked_postings(index, asked, broadcast_bytes)
    hits = scores(asked, narrowed.rows)
    if isinstance(queries, str):
        top = best_of_one(_all(hits), n)
        if include_zero:
            return pad_with_zeros(top, asked.ids, index.first_docs, n).drop("query_id")
        return best(top, n).drop("query_id")
    groups = [hits[k : k + SLICES_AT_ONCE] for k in range(0, len(hits), SLICES_AT_ONCE)]
    tops = [best(_all(group), n) for group in groups]
    if len(hits) > 1 or include_zero:
        tops = [settle(top) for top in tops]
    narrowed.discard()
    top = _all(tops)
    if not include_zero:
        return top
    return pad_short_lists(top, asked.ids, index.first_docs, n)


def _bm25(
    index: SearchIndex, asked: Asked, rows: DataFrame, k1: float, b: float, tf_scale: float
) -> list[DataFrame]:
    scoring.check_bm25(k1, b, tf_scale)
    weight = scoring.bm25_idf(F.col("df"), index.stat("n_docs"))
    part = scoring.bm25_term_score(
        F.col("weight"), F.col("tf") * tf_scale, F.col("len"), index.stat("avg_len"), k1, b
    )
    return _scores(index, asked, rows, weight, part)


def _tfdf(index: SearchIndex, asked: Asked, rows: DataFrame) -> list[DataFrame]:
    df = F.col("df")
    weight = F.struct(scoring.tfdf_weight(F.col("qtf"), df).alias("query"), df.alias("df"))
    part = F.col("weight.query") * scoring.tfdf_weight(F.col("tf"), F.col("weight.df"))
    return _scores(index, asked, rows, weight, part)


def bm25_scores(
    index: SearchIndex,
    queries: DataFrame | str,
    k1: float = scoring.K1,
    b: float = scoring.B,
    tf_scale: float = 1.0,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """query_id, doc_id, BM25 score, without the documents that score zero.

    A term repeated in a query counts once. ``tf_scale`` multiplies the term
    frequency; 10 gives the scores of an index whose frequencies were stored with
    one decimal and read back without the point.
    """
    asked = ask(queries, index.stats.sparkSession, broadcast_bytes)
    rows = _asked_postings(index, asked, broadcast_bytes).rows
    return _all(_bm25(index, asked, rows, k1, b, tf_scale))


def tfdf_scores(
    index: SearchIndex, queries: DataFrame | str, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """query_id, doc_id, dot product of qtf/df and tf/df, without zero scores.

    The query side carries the df of its terms, so the document weights are
    computed here for the matching postings alone.
    """
    asked = ask(queries, index.stats.sparkSession, broadcast_bytes)
    return _all(_tfdf(index, asked, _asked_postings(index, asked, broadcast_bytes).rows))


def bm25_search(
    index: SearchIndex,
    queries: DataFrame | str,
    n: int,
    k1: float = scoring.K1,
    b: float = scoring.B,
    tf_scale: float = 1.0,
    include_zero: bool = True,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The n best documents by BM25: (query_id,) rank, doc_id, score.

    ``queries`` is one text, or a frame of query_id (unique) and query; n is 0 to
    1000. Documents without any query term score zero and fill up short results,
    by id, unless ``include_zero`` is false. A frame is read once. Its terms go to
    every task in slices of ``broadcast_bytes``, a few at a time, each with a pass over
    the postings of all asked terms (narrow_postings); no posting moves.
    """

    def scores(asked: Asked, rows: DataFrame) -> list[DataFrame]:
        return _bm25(index, asked, rows, k1, b, tf_scale)

    return _search(index, queries, n, include_zero, broadcast_bytes, scores)


def tfdf_search(
    index: SearchIndex,
    queries: DataFrame | str,
    n: int,
    include_zero: bool = True,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The n best documents by the tf/df dot product; see bm25_search."""

    def scores(asked: Asked, rows: DataFrame) -> list[DataFrame]:
        return _tfdf(index, asked, rows)

    return _search(index, queries, n, include_zero, broadcast_bytes, scores)


def score_all(index: SearchIndex, hits: DataFrame) -> DataFrame:
    """doc_id, score for every document of the index, given the scores of one query.

    Both sides keep the buckets of a stored index, so this join moves no rows.
    """
    scored = hits.select("doc_id", "score")
    zero = F.coalesce("score", F.lit(0.0)).alias("score")
    return index.doc_lengths.join(scored, "doc_id", "left").select("doc_id", zero)


def with_metadata(
    results: DataFrame, corpus: DataFrame, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Search results with the other columns of the corpus, null where it lacks the id.

    The results are settled first, as the join uses them twice. If they are small,
    which is measured, only the corpus rows with their ids go into the join, and the
    corpus is never shuffled.
    """
    details = corpus.drop("text")
    results = settle(results)
    size = results.agg(F.sum(row_bytes("doc_id"))).first()[0] or 0
    if size <= broadcast_bytes:
        ids = results.select("doc_id").distinct()
        details = details.join(F.broadcast(ids), "doc_id", "left_semi")
    return results.join(details, "doc_id", "left")


def with_details(
    index: SearchIndex, results: DataFrame, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Search results with the title and url that the index keeps; the corpus is not read.

    The details are sorted by id. A few ids are pushed into their scan as equalities, so
    that it opens the pages with these ids alone.
    """
    results = settle(results)
    details = index.details
    ids = results.select("doc_id").distinct().limit(FILTER_TERMS + 1).collect()
    if len(ids) > FILTER_TERMS:
        return with_metadata(results, details, broadcast_bytes)
    chosen = reduce(or_, [F.col("doc_id") == row["doc_id"] for row in ids], F.lit(False))
    return results.join(F.broadcast(details.where(chosen)), "doc_id", "left")


def facet_counts(
    index: SearchIndex,
    query: str,
    sets: Sequence[Sequence[str]] = ((), ("title",), ("url",)),
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """How many documents match a query, by sets of the columns that the index keeps.

    All documents with at least one of the query's terms count, not only the best of them.
    The result has the columns of all sets, ``level`` (one bit for each column that the row's
    set leaves out, the last column lowest), documents and best_score. All sets are counted
    in one pass, in each task first.
    """
    columns = list(dict.fromkeys(name for one in sets for name in one))
    hits = bm25_scores(index, query, broadcast_bytes=broadcast_bytes).select("doc_id", "score")
    joined = hits.join(index.details.select("doc_id", *columns), "doc_id")
    measures = [F.count("*").alias("documents"), F.max("score").alias("best_score")]
    if not columns:
        return joined.agg(F.lit(0).cast("long").alias("level"), *measures)
    grouped = joined.groupingSets(sets, *columns)
    return grouped.agg(F.grouping_id().alias("level"), *measures).select(
        *columns, "level", "documents", "best_score"
    )
