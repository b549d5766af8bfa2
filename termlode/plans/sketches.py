"""Approximate counts that merge: distinct documents and terms, and the most frequent terms.

A sketch has a bounded size whatever it has seen, and sketches of parts of a corpus merge into
that of the whole. So they can be kept per day, language or segment and be asked for any
combination of these without reading a document again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termlode.functions.text import tokenize

# Registers of a distinct count, as a power of two, and terms that a sketch keeps track of.
REGISTERS_LOG, TRACKED_TERMS = 14, 20_000
# Three standard errors of a distinct count with so many registers, as a share of it.
DISTINCT_ERROR = 3 * 1.04 / 2 ** (REGISTERS_LOG / 2)
# A term's count is wrong by at most this share of all tokens.
COUNT_ERROR = 3.5 / TRACKED_TERMS


def corpus_sketches(corpus: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sketches of a corpus per group of the columns ``by``: documents, terms, frequent, tokens.

    Each task sketches what it reads; only sketches move. ``tokens`` is an exact count. A
    repeated id is one document; a document without tokens counts as one.
    """
    rows = corpus.select(*by, "doc_id", F.explode_outer(tokenize(F.col("text"))).alias("term"))
    return rows.groupBy(*by).agg(
        F.hll_sketch_agg(F.col("doc_id").cast("string"), REGISTERS_LOG).alias("documents"),
        F.hll_sketch_agg("term", REGISTERS_LOG).alias("terms"),
        F.expr(f"approx_top_k_accumulate(term, {TRACKED_TERMS})").alias("frequent"),
        F.count("term").alias("tokens"),
    )


def merge_sketches(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sketches of coarser groups, or, by no column, of everything."""
    return sketches.groupBy(*by).agg(
        F.hll_union_agg("documents").alias("documents"),
        F.hll_union_agg("terms").alias("terms"),
        F.expr(f"approx_top_k_combine(frequent, {TRACKED_TERMS})").alias("frequent"),
        F.sum("tokens").alias("tokens"),
    )


def sketch_estimates(sketches: DataFrame, top: int = 10) -> DataFrame:
    """What sketches say: documents, terms, tokens, and the ``top`` terms with their counts.

    Distinct counts are within DISTINCT_ERROR of the truth in all but few of a thousand cases,
    counts of terms within COUNT_ERROR of all tokens.
    """
    others = [c for c in sketches.columns if c not in ("documents", "terms", "frequent", "tokens")]
    return sketches.select(
        *others,
        F.hll_sketch_estimate("documents").alias("documents"),
        F.hll_sketch_estimate("terms").alias("terms"),
        "tokens",
        F.expr(f"approx_top_k_estimate(frequent, {int(top)})").alias("top_terms"),
    )
