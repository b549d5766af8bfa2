"""The ranking formulas, as column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the BM25 formula; both are parameters below.
K1 = 2.0
B = 0.75


def bm25_idf(df: Column, n_docs: Column) -> Column:
    """ln((N - df + 0.5) / (df + 0.5) + 1)."""
    return F.log((n_docs - df + 0.5) / (df + 0.5) + 1.0)


def check_bm25(k1: float, b: float, tf_scale: float = 1.0) -> None:
    """Outside of these bounds scores can be negative or without bound."""
    if not k1 >= 0 or not 0 <= b <= 1 or not tf_scale > 0:
        raise ValueError(
            f"BM25 needs k1 >= 0, b from 0 to 1 and tf_scale > 0, not {k1!r}, {b!r}, {tf_scale!r}"
        )


def bm25_term_score(
    idf: Column, tf: Column, length: Column, avg_len: Column, k1: float = K1, b: float = B
) -> Column:
    """Score that one term adds to one document."""
    check_bm25(k1, b)
    dampening = tf + k1 * (1.0 - b + b * length / avg_len)
    return idf * (tf * (k1 + 1.0)) / dampening


def tfdf_weight(frequency: Column, df: Column) -> Column:
    """Weight of a term, in a document (tf / df) or in a query (qtf / df)."""
    return frequency / df


def rank_key(score: Column) -> Column:
    """Integral sort key that takes scores equal to about nine digits as ties.

    Sums of doubles depend on the order of addition, so the last bits of a score
    can change between runs; ordering on them would make ties come out at random.
    The logarithm makes the precision relative: it holds for large BM25 scores
    and for tf/df products far below 1e-12. A score of zero has no key (null).
    """
    return F.rint(F.log(score) * 1e9)


def rank_order(score: str = "score", doc_id: str = "doc_id") -> list[Column]:
    """Best score first, zero scores last, equal scores by document id."""
    return [rank_key(F.col(score)).desc_nulls_last(), F.col(doc_id).asc()]
