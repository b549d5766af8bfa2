"""The ranking sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from termlode.functions.scoring import rank_order
from termlode.plans.scratch import settle


def write_ranking(scores: DataFrame, path: str) -> None:
    """Write all scored documents, best first; path must be new.

    The column position grows from the best to the last over all files, with gaps, so the
    order survives reading. The scores are settled, as sorting reads them twice.
    """
    ordered = settle(scores).orderBy(*rank_order())
    placed = ordered.select(F.monotonically_increasing_id().alias("position"), "score", "doc_id")
    placed.write.mode("errorifexists").parquet(path)


def read_ranking(spark: SparkSession, path: str, n: int) -> DataFrame:
    """rank, doc_id, score: the n best of a ranking written before."""
    best = spark.read.parquet(path).orderBy("position").limit(n)
    # At most n rows are left for this window.
    rank = F.row_number().over(Window.orderBy("position")).alias("rank")
    return best.select(rank, "doc_id", "score")
