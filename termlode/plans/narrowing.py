"""Postings of the terms that a large batch of queries asks for, brought together once."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termlode.plans.index import (
    SearchIndex,
    bucketed,
    discard_bucketed,
    table_name,
    write_bucketed,
)
from termlode.plans.shared import scratch_path, settle

# Where the asked terms have more than this share of the postings, all are read in place.
NARROW_SHARE = 0.5
_ORDER = ["term", "doc_id"]


def _nothing() -> None:
    pass


@dataclass(frozen=True)
class Narrowed:
    """Postings for several passes; ``discard`` deletes what was written for them."""

    rows: DataFrame
    discard: Callable[[], None] = _nothing


def narrow_postings(
    index: SearchIndex, terms: DataFrame, size: Callable[[DataFrame], int], limit: int
) -> Narrowed:
    """The postings with one of the terms (repeats allowed), in the buckets they have.

    The frequencies tell, without a look at a posting, how many these are. If they are few,
    they are written once, and every later pass reads them alone: P passes over an index of n
    postings, w of them asked for, read n + P * w instead of P * n. The terms are broadcast
    in parts of ``limit`` bytes, by ``size``; nothing is shuffled but terms. An index that
    isn't stored in buckets is read as it is.
    """
    if index.shards is None:
        return Narrowed(index.postings)
    terms = settle(terms.select("term").distinct())
    wanted = index.frequencies.join(terms, "term", "left_semi").agg(F.sum("df")).first()[0] or 0
    if wanted > NARROW_SHARE * (index.stats.select("n_postings").first()[0] or 0):
        return Narrowed(index.postings)

    spark, root = terms.sparkSession, scratch_path(terms.sparkSession, "asked")
    shards, name = index.shards, table_name(root, "postings", index.shards)
    columns = index.postings.columns
    parts = max(1, -(-size(terms) // max(1, limit)))
    parts = min(parts, max(1, terms.count()))
    for part in range(parts):
        some = terms.where(F.pmod(F.xxhash64("term"), F.lit(parts)) == part)
        rows = index.postings.join(F.broadcast(some), "term", "left_semi").select(*columns)
        if part == 0:
            write_bucketed(rows, root, "postings", shards, _ORDER)
        else:
            table = rows.write.format("parquet").mode("append").option("path", f"{root}/postings")
            table.bucketBy(shards, "doc_id").sortBy(*_ORDER).saveAsTable(name)

    def discard() -> None:
        discard_bucketed(spark, root, "postings", shards)

    return Narrowed(bucketed(spark, root, "postings", shards, _ORDER), discard)
