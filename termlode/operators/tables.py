"""The tables of an index, each derived from the one before it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termlode.functions.text import count_terms


def forward_index(corpus: DataFrame) -> DataFrame:
    """doc_id, len, terms: one row per document, empty documents included."""
    return count_terms(corpus, "doc_id", "text")


def term_map(forward: DataFrame) -> DataFrame:
    """The forward index with its terms as a map from term to tf."""
    return forward.select("doc_id", "len", F.map_from_entries("terms").alias("terms"))


def postings(forward: DataFrame) -> DataFrame:
    """doc_id, len, term, tf: one row per document and term.

    ``len`` rides along, so that scoring needs no join with the lengths. The outer
    form of inline is on purpose: for the plain form the optimizer adds a filter
    on the array below the projection, which would count all terms twice.
    """
    rows = forward.select("doc_id", "len", F.inline_outer("terms"))
    return rows.where(F.col("term").isNotNull())


def document_lengths(forward: DataFrame) -> DataFrame:
    """doc_id, len; from the documents, so that those without tokens stay."""
    return forward.select("doc_id", "len")


def document_frequency(posting_rows: DataFrame) -> DataFrame:
    """term, df. Counted in each task first: a task sends a term once."""
    return posting_rows.groupBy("term").agg(F.count("*").alias("df"))


def corpus_stats(lengths: DataFrame, frequencies: DataFrame) -> DataFrame:
    """One row: n_docs, total_len, avg_len (null if empty), n_postings.

    The number of postings is the sum of all df, which spares a look into the
    terms of every document.
    """
    n_postings = frequencies.agg(F.coalesce(F.sum("df"), F.lit(0)).alias("n")).scalar()
    return lengths.agg(
        F.count("*").alias("n_docs"),
        F.coalesce(F.sum("len"), F.lit(0)).alias("total_len"),
        F.avg("len").alias("avg_len"),
    ).select("n_docs", "total_len", "avg_len", n_postings.alias("n_postings"))
