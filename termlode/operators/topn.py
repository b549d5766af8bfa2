"""The best N documents per query."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termlode.functions.scoring import rank_order

MAX_RESULTS = 1000


def check_result_count(n: int) -> None:
    """The number of results must lie in 0..1000; everything below relies on it."""
    if isinstance(n, bool) or not isinstance(n, int) or not 0 <= n <= MAX_RESULTS:
        raise ValueError(f"the number of results must be from 0 to {MAX_RESULTS}, not {n!r}")


def best(scores: DataFrame, n: int) -> DataFrame:
    """rank and the n best rows per query_id.

    The filter on the row number lets Spark keep n rows per query in each task
    before it shuffles, so even a query that matches every document moves at most
    n rows per task.
    """
    per_query = Window.partitionBy("query_id").orderBy(*rank_order())
    ranked = scores.withColumn("rank", F.row_number().over(per_query))
    return ranked.where(F.col("rank") <= n).select("query_id", "rank", "doc_id", "score")


def best_of_one(scores: DataFrame, n: int) -> DataFrame:
    """The n best rows of a single query; each task keeps n rows while it reads."""
    return scores.orderBy(*rank_order()).limit(n)


def first_documents(doc_lengths: DataFrame) -> DataFrame:
    """The smallest ids of the corpus, as many as pad_with_zeros can ever need."""
    return doc_lengths.select("doc_id").orderBy("doc_id").limit(2 * MAX_RESULTS)


def pad_with_zeros(
    top_hits: DataFrame, queries: DataFrame, first_docs: DataFrame, n: int
) -> DataFrame:
    """Top n over all documents, given the top n of those that match.

    Documents without a match score zero and rank last, by id. If a query has
    fewer than n hits, the missing ones are among the 2n smallest ids of the
    corpus, as fewer than n of these can be hits. If it has n hits or more, the
    zero scores rank below all of them. So at most 3n rows per query are ranked
    here, never queries times documents.
    """
    smallest = first_docs.orderBy("doc_id").limit(2 * n)
    ids = smallest.agg(F.sort_array(F.collect_list("doc_id")).alias("ids")).scalar()
    zeros = queries.select("query_id", F.explode(ids).alias("doc_id"), F.lit(0.0).alias("score"))
    candidates = top_hits.select("query_id", "doc_id", "score").unionByName(zeros)
    scores = (
        candidates.repartition("query_id")
        .groupBy("query_id", "doc_id")
        .agg(F.max("score").alias("score"))
    )
    return best(scores, n)


def pad_short_lists(
    top_hits: DataFrame, query_ids: DataFrame, first_docs: DataFrame, n: int
) -> DataFrame:
    """Top n of many queries; only those with fewer than n hits are padded with zeros.

    ``top_hits`` is read several times, so it should be settled.
    """
    counts = top_hits.groupBy("query_id").agg(F.count("*").alias("hits"))
    short = query_ids.join(counts, "query_id", "left").where(F.coalesce("hits", F.lit(0)) < n)
    short = short.select("query_id")
    padded = pad_with_zeros(top_hits.join(short, "query_id", "left_semi"), short, first_docs, n)
    return top_hits.join(short, "query_id", "left_anti").unionByName(padded)
