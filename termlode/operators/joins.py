"""Joins of the postings on their term, safe for very frequent terms.

A term that stands in most documents holds a large part of all postings, and one
task would get them all in a plain shuffle join. "Frequent" means here: more than
1/HOT_TERMS of all postings. As the df of all terms add up to the number of
postings, fewer than HOT_TERMS terms are frequent, whatever the corpus, and their
text is at most HOT_TERMS times the mean text of a posting. That bound is what
allows the broadcasts in this module.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_TERMS = 20_000


def is_hot(df: Column, n_postings: Column, hot_terms: int = HOT_TERMS) -> Column:
    return df * hot_terms > n_postings


def attach_df(
    postings: DataFrame, frequencies: DataFrame, n_postings: Column, hot_terms: int = HOT_TERMS
) -> DataFrame:
    """Postings with the df of their term.

    Frequent terms, which hold most of the postings, are joined by broadcast where
    they stand; only the postings of rare terms are shuffled, and no rare term
    can fill more than 1/HOT_TERMS of that shuffle's input.
    """
    hot = frequencies.where(is_hot(F.col("df"), n_postings, hot_terms))
    cold = frequencies.where(~is_hot(F.col("df"), n_postings, hot_terms))
    frequent = postings.join(F.broadcast(hot), "term")
    rest = postings.join(F.broadcast(hot.select("term")), "term", "left_anti")
    return frequent.unionByName(rest.join(cold, "term"))
