"""Terms that are spelt almost alike, by a deletion-neighbourhood index of the vocabulary.

If two terms are within d edits, some string is left of both when up to d letters are deleted
from each. So every term of the vocabulary is listed under all that is left of it, and a
query's terms are looked up by all that is left of them: an equality, however large the
vocabulary. Candidates are then verified by their edit distance. Terms too long for that are
listed by their length alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termlode.functions import scoring
from termlode.operators.topn import best, check_result_count
from termlode.plans.index import SearchIndex, check_location
from termlode.plans.search import FILTER_TERMS, as_queries, narrow, query_terms
from termlode.plans.shared import settle

DISTANCE, MOST_DISTANCE = 1, 2
# Terms of more letters are listed by their length; no token has a sign like its mark.
MOST_LETTERS, LENGTH_MARK = 40, "#"
# Terms whose lists, some fifty rows each, one task sorts without spilling.
SORTED_TERMS = 40_000
# Matching terms up to which they are broadcast.
BROADCAST_ROWS = 500_000


def _check_distance(distance: int) -> None:
    if distance not in range(MOST_DISTANCE + 1):
        raise ValueError(f"the distance must be from 0 to {MOST_DISTANCE}, not {distance!r}")


def deletions(term: Column, distance: int) -> Column:
    """All that is left of a term when up to ``distance`` letters are deleted, itself included."""

    def without(text: Column, letters: int) -> Column:
        """``text`` less so many letters, the first of them before the others."""
        if not letters:
            return F.array(text)
        size = F.length(text)

        def after(i: Column) -> Column:
            kept = F.substring(text, F.lit(1), i - 1)
            rest = without(F.substring(text, i + 1, size), letters - 1)
            return F.transform(rest, lambda left: F.concat(kept, left))

        left = F.flatten(F.transform(F.sequence(F.lit(1), size), after))
        return F.when(size > 0, left).otherwise(F.array().cast("array<string>"))

    return F.array_distinct(F.concat(*[without(term, k) for k in range(distance + 1)]))


def _mark(size: Column) -> Column:
    return F.concat(F.lit(LENGTH_MARK), size.cast("string"))


def write_fuzzy_index(index: SearchIndex, root: str, distance: int = DISTANCE) -> DataFrame:
    """Store the neighbourhoods of an index's vocabulary in a new folder; returns them read back.

    key, term, df, sorted by key, so that a lookup skips the row groups of other keys. The
    sort has a task for a bounded number of terms, so none of them grows or spills.
    """
    check_location(root)
    _check_distance(distance)
    long = F.length("term") > MOST_LETTERS
    keys = F.when(long, F.array(_mark(F.length("term")))).otherwise(
        deletions(F.col("term"), distance)
    )
    rows = index.frequencies.select(F.explode(keys).alias("key"), "term", "df")
    spark = index.frequencies.sparkSession
    parts = sort_parts(index.frequencies.count(), spark.sparkContext.defaultParallelism)
    dealt = rows.repartitionByRange(parts, "key", "term")
    sorted_rows = dealt.sortWithinPartitions("key", "term")
    sorted_rows.write.mode("errorifexists").option("compression", "zstd").parquet(root)
    return load_fuzzy_index(spark, root)


def sort_parts(terms: int, cores: int) -> int:
    """Tasks that sort the lists of a vocabulary: what one of them holds does not grow with it."""
    return max(cores, -(-terms // SORTED_TERMS))


def load_fuzzy_index(spark: SparkSession, root: str) -> DataFrame:
    """Neighbourhoods written before."""
    check_location(root)
    return spark.read.parquet(root)


def fuzzy_terms(fuzzy: DataFrame, queries: DataFrame | str, distance: int = DISTANCE) -> DataFrame:
    """query_id, asked, term, distance, df: terms within ``distance`` edits of a query's terms.

    ``queries`` is one text (with query_id 0), or a frame of query_id and query. The distance is
    that of letters inserted, deleted or replaced, at most what the index was written for.
    """
    _check_distance(distance)
    if isinstance(queries, str):
        queries = as_queries(fuzzy.sparkSession, queries)
    terms = query_terms(queries).select("query_id", F.col("term").alias("asked"))
    size = F.length("asked")
    near = F.transform(
        F.sequence(F.greatest(size - distance, F.lit(0)), size + distance), lambda n: n
    )
    long = F.transform(F.filter(near, lambda n: n > MOST_LETTERS), _mark)
    short = F.when(size <= MOST_LETTERS + distance, deletions(F.col("asked"), distance))
    keys = F.concat(F.coalesce(short, F.array().cast("array<string>")), long)
    asked = settle(terms.select("query_id", "asked", F.explode(keys).alias("key")))
    head = asked.select("key").distinct().limit(FILTER_TERMS + 1).collect()
    known = sorted(row["key"] for row in head) if len(head) <= FILTER_TERMS else None
    listed = narrow(fuzzy.withColumnRenamed("term", "found"), known, "key")
    few = F.broadcast(asked) if asked.count() <= BROADCAST_ROWS else asked
    edits = F.levenshtein("asked", "found", distance)
    met = listed.join(few, "key").select(
        "query_id", "asked", F.col("found").alias("term"), edits.alias("distance"), "df"
    )
    return met.where(F.col("distance") >= 0).distinct()


def fuzzy_search(
    index: SearchIndex,
    fuzzy: DataFrame,
    queries: DataFrame | str,
    n: int,
    distance: int = DISTANCE,
    k1: float = scoring.K1,
    b: float = scoring.B,
) -> DataFrame:
    """(query_id,) rank, doc_id, score: the best by BM25 over all terms near the query's.

    A term counts by its own idf, divided by one more than its distance to the nearest term
    of the query. Documents without any near term are no hits.
    """
    check_result_count(n)
    scoring.check_bm25(k1, b)
    near = fuzzy_terms(fuzzy, queries, distance)
    nearest = near.groupBy("query_id", "term").agg(
        F.min("distance").alias("edits"), F.first("df").alias("df")
    )
    idf = scoring.bm25_idf(F.col("df"), index.stat("n_docs"))
    weight = (idf / (F.col("edits") + 1)).alias("weight")
    weights = settle(nearest.select("query_id", "term", weight))
    head = weights.select("term").distinct().limit(FILTER_TERMS + 1).collect()
    known = sorted(row["term"] for row in head) if len(head) <= FILTER_TERMS else None
    few = F.broadcast(weights) if weights.count() <= BROADCAST_ROWS else weights
    matched = narrow(index.postings, known).join(few, "term")
    part = scoring.bm25_term_score(
        F.col("weight"), F.col("tf"), F.col("len"), index.stat("avg_len"), k1, b
    )
    parts = matched.select("query_id", "doc_id", part.alias("part"))
    hits = parts.groupBy("query_id", "doc_id").agg(F.sum("part").alias("score"))
    top = best(hits, n)
    return top.drop("query_id") if isinstance(queries, str) else top
