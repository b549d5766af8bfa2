"""Top N with safe dynamic pruning, over a blocked index.

Three passes. The first reads the first layer of every query term: scores that are summed
from it are lower bounds, and the Nth best of them is a threshold that the result is sure to
reach. Terms that together can't reach the threshold need no reading to find documents; the
rest of it is dealt out to the other terms as cutoffs, so that a document below all of them
can't be a hit. The second pass reads the layers above their term's cutoff and bounds
each document from below and, counting what was not read by its cutoff, from above; the Nth
best lower bound is the final threshold. The third scores the few documents that may reach
it in full, in their ranges alone. No hit is lost, whatever the parameters.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termlode.functions import scoring
from termlode.operators.topn import best, check_result_count, pad_short_lists
from termlode.plans.blocks import BlockedIndex, postings_of
from termlode.plans.scratch import settle
from termlode.plans.search import BROADCAST_BYTES, FILTER_TERMS, ask, narrow, row_bytes

# Scores that agree to about nine digits are ties, so a threshold is lowered by more.
SLACK = 1e-8


@dataclass(frozen=True)
class Passes:
    """What one slice of the queries reads and finds.

    weights     query_id, term, weight, top, limit, essential: limit bounds what a posting of
                the term that the second pass does not read can add
    strong      the layers of the second pass, with the columns of weights
    candidates  range, doc_id, query_id: all documents that may be hits
    final       the layers of the third pass, in the candidates' ranges
    hits        query_id, doc_id, score of the candidates; of all documents in their ranges,
                where the candidates are too many for a broadcast
    """

    weights: DataFrame
    strong: DataFrame
    candidates: DataFrame
    final: DataFrame
    hits: DataFrame


@dataclass(frozen=True)
class _Scoring:
    """BM25 with its parameters, as columns."""

    avg_len: Column
    k1: float
    b: float
    tf_scale: float

    def part(self, weight: Column, tf: Column, length: Column) -> Column:
        return scoring.bm25_term_score(
            weight, tf * self.tf_scale, length, self.avg_len, self.k1, self.b
        )

    def bound(self) -> Column:
        """The most that a posting of a block, or of a term, adds per unit of its weight.

        The stored impact is exact for the usual parameters. For others, the highest
        frequency and the least length bound it, as a score grows with one and falls with
        the other.
        """
        if (self.k1, self.b, self.tf_scale) == (scoring.K1, scoring.B, 1.0):
            return F.col("impact")
        return self.part(F.lit(1.0), F.col("max_tf"), F.col("min_len"))


def _weights(index: BlockedIndex, terms: DataFrame, known: list[str] | None, how: _Scoring):
    """query_id, term, weight, and top: the most that the term can add to a score."""
    found = narrow(index.frequencies, known).join(F.broadcast(terms), "term")
    weight = scoring.bm25_idf(F.col("df"), index.stat("n_docs"))
    return found.select(
        "query_id", "term", weight.alias("weight"), (weight * how.bound()).alias("top")
    )


def _thresholds(first: DataFrame, n: int, how: _Scoring) -> DataFrame:
    """query_id, threshold: a score that the nth hit is sure to have."""
    rows = postings_of(first, "query_id", "range", "weight")
    part = how.part(F.col("weight"), F.col("tf"), F.col("len")).alias("part")
    sums = rows.select("query_id", "range", "doc_id", part)
    sums = sums.groupBy("query_id", "range", "doc_id").agg(F.sum("part").alias("score"))
    return _nth_best(sums, n)


def _nth_best(scores: DataFrame, n: int) -> DataFrame:
    """query_id, threshold: the nth best score, a little lower; zero if there are fewer."""
    ranked = best(scores, n).groupBy("query_id")
    least = F.when(F.count("*") == n, F.min("score") * (1 - SLACK))
    return ranked.agg(F.coalesce(least, F.lit(0.0)).alias("threshold"))


def _limits(weights: DataFrame, thresholds: DataFrame) -> DataFrame:
    """The weights with the cutoff of each term.

    Terms in order of what they can add: as long as their sum is below the threshold, they
    find no hit by themselves and their limit is all they can add. The rest of the
    threshold is shared by the others in proportion.
    """
    joined = weights.join(F.broadcast(thresholds), "query_id", "left")
    threshold = F.coalesce("threshold", F.lit(0.0))
    weakest = Window.partitionBy("query_id").orderBy("top", "term")
    whole = Window.partitionBy("query_id")
    # Sums of doubles depend on their order: leave room for it.
    summed = F.sum("top").over(weakest) * (1 + SLACK)
    marked = joined.select(
        "*", threshold.alias("goal"), (summed >= threshold).alias("essential")
    )
    idle = F.sum(F.when(~F.col("essential"), F.col("top")).otherwise(0.0)).over(whole)
    busy = F.sum(F.when(F.col("essential"), F.col("top")).otherwise(0.0)).over(whole)
    rest = F.greatest(F.lit(0.0), F.col("goal") - idle * (1 + SLACK))
    limit = F.when(F.col("essential"), F.col("top") * rest / busy * (1 - SLACK))
    return marked.select(
        "query_id",
        "term",
        "weight",
        "top",
        "goal",
        "essential",
        F.coalesce(limit, F.col("top")).alias("limit"),
    )


def _matching(blocks: DataFrame, weights: DataFrame, known: list[str] | None) -> DataFrame:
    return narrow(blocks, known).join(F.broadcast(weights), "term")


def _strong(index: BlockedIndex, weights: DataFrame, known: list[str] | None, how: _Scoring):
    """Layers of essential terms that reach their term's limit.

    For a single query its terms are few, and the limits go into the scan, so that the pages
    of lower layers are skipped.
    """
    blocks = index.blocks
    if known is not None:
        least = F.min(F.when(F.col("essential"), F.col("limit") / F.col("weight")))
        floors = weights.groupBy("term").agg(least.alias("floor")).where("floor is not null")
        chosen = [
            (F.col("term") == row["term"]) & (how.bound() >= row["floor"] * (1 - SLACK))
            for row in floors.collect()
        ]
        blocks = blocks.where(reduce(or_, chosen, F.lit(False)))
    joined = blocks.join(F.broadcast(weights.where("essential")), "term")
    return joined.where(how.bound() * F.col("weight") >= F.col("limit") * (1 - SLACK))


def _candidates(strong: DataFrame, weights: DataFrame, n: int, how: _Scoring) -> DataFrame:
    """range, doc_id, query_id of documents whose upper bound reaches the threshold.

    What the second pass has read of a document is a better lower bound than that of the
    first, so the nth best of these raises the threshold for the third.
    """
    carried = ["query_id", "range", "weight", "limit"]
    rows = postings_of(strong, *carried)
    part = how.part(F.col("weight"), F.col("tf"), F.col("len"))
    rows = rows.select("query_id", "range", "doc_id", "limit", part.alias("part"))
    found = rows.groupBy("query_id", "range", "doc_id").agg(
        F.sum("part").alias("score"),
        F.sum(F.col("part") - F.col("limit")).alias("over"),
        F.max(F.col("part") >= F.col("limit") * (1 - SLACK)).alias("reaches"),
    )
    limits = weights.groupBy("query_id").agg(
        F.sum("limit").alias("unread"), F.first("goal").alias("goal")
    )
    bounded = found.join(F.broadcast(limits), "query_id")
    bounded = bounded.withColumn("most", F.col("over") + F.col("unread") * (1 + SLACK))
    enough = F.col("reaches") & (F.col("most") >= F.col("goal") * (1 - SLACK))
    likely = settle(bounded.where(enough).select("range", "doc_id", "query_id", "score", "most"))
    goals = _nth_best(likely.select("query_id", "doc_id", "score"), n)
    reached = likely.join(F.broadcast(goals), "query_id", "left")
    reached = reached.where(F.col("most") >= F.coalesce("threshold", F.lit(0.0)) * (1 - SLACK))
    return reached.select("range", "doc_id", "query_id")


def passes(
    index: BlockedIndex,
    terms: DataFrame,
    known: list[str] | None,
    n: int,
    how: _Scoring,
    broadcast_bytes: int,
) -> Passes:
    """The three passes over one slice of query terms; what is used twice is settled.

    Candidates that are too many to be broadcast spare little, and a join with them would
    shuffle every posting for every query that asks for it. Their ranges are scored in full
    then, where they stand: the others among the documents have lower scores.
    """
    weights = settle(_weights(index, terms, known, how))
    first = _matching(index.blocks.where("layer = 0"), weights, known)
    weights = settle(_limits(weights, _thresholds(first, n, how)))
    strong = _strong(index, weights, known, how)
    candidates = settle(_candidates(strong, weights, n, how))

    blocks = index.blocks
    ranges = candidates.select("range").distinct().limit(FILTER_TERMS + 1).collect()
    if len(ranges) <= FILTER_TERMS:
        # As equalities on the bucketed column these also spare the other buckets.
        chosen = [F.col("range") == row["range"] for row in ranges]
        blocks = blocks.where(reduce(or_, chosen, F.lit(False)))
    final = _matching(blocks, weights.select("query_id", "term", "weight"), known)
    rows = postings_of(final, "query_id", "range", "weight")
    size = candidates.agg(F.sum(row_bytes("doc_id", "query_id"))).first()[0] or 0
    if size <= broadcast_bytes:
        rows = rows.join(F.broadcast(candidates), ["range", "doc_id", "query_id"])
    part = how.part(F.col("weight"), F.col("tf"), F.col("len")).alias("part")
    scores = rows.select("query_id", "range", "doc_id", part)
    hits = scores.groupBy("query_id", "range", "doc_id").agg(F.sum("part").alias("score"))
    return Passes(weights, strong, candidates, final, hits.select("query_id", "doc_id", "score"))


def pruned_search(
    index: BlockedIndex,
    queries: DataFrame | str,
    n: int,
    k1: float = scoring.K1,
    b: float = scoring.B,
    tf_scale: float = 1.0,
    include_zero: bool = True,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The n best documents by BM25, as bm25_search gives them, reading fewer postings.

    ``queries`` is one text, or a frame of query_id (unique) and query; n is 0 to 1000.
    Queries whose terms exceed ``broadcast_bytes`` are answered in slices.
    """
    check_result_count(n)
    scoring.check_bm25(k1, b, tf_scale)
    asked = ask(queries, index.stats.sparkSession, broadcast_bytes)
    how = _Scoring(index.stat("avg_len"), k1, b, tf_scale)
    hits = [
        passes(index, terms, asked.known, max(n, 1), how, broadcast_bytes).hits
        for terms in asked.slices
    ]
    top = best(reduce(DataFrame.unionByName, hits), n)
    if include_zero:
        top = pad_short_lists(settle(top), asked.ids, index.first_docs, n)
    return top.drop("query_id") if isinstance(queries, str) else top
