"""The tokenizer, as built-in expressions that stay inside the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# They decide which terms exist, so they must not be "improved".
# A backslash followed by a letter, and the hyphen, become one space.
BLANKED = r"\\[a-z]|-"
# Characters removed wherever they stand in the text.
STRIPPED = r"""[\\0-9~`!@#$%^&*()\-_+=,.<>?/'":;{}\[\]|]"""
# Only these five separate tokens; no-break space and vertical tab do not.
SEPARATORS = r"[ \t\n\r\f]+"


def tokenize(text: Column) -> Column:
    """Text to an array of tokens, in text order, without empty ones.

    Stripping runs over the whole text and not token by token: no stripped
    character is a separator, so both give the same tokens, and one pass of a
    regular expression per document is cheaper than one per token.
    """
    lowered = F.lower(F.coalesce(text, F.lit("")))
    bare = F.regexp_replace(F.regexp_replace(lowered, BLANKED, " "), STRIPPED, "")
    return F.array_remove(F.split(bare, SEPARATORS), "")


def _bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _runs(ordered: Column, same: Callable[[Column, Column], Column], run) -> Column:
    """``run`` of the first and last place (from 1) of each run of equal items in order.

    An item is compared with the one after it, null at the end. Both arrays are bound, so
    that the lambdas never compute them again.
    """

    def last(item: Column, i: Column) -> Column:
        goes_on = F.coalesce(same(F.get(ordered, i + 1), item), F.lit(False))
        return F.when(~goes_on, i + 1)

    ends = F.array_compact(F.transform(ordered, last))

    def each(ends: Column) -> Column:
        return F.transform(
            ends,
            lambda end, k: run(F.when(k == 0, 1).otherwise(F.get(ends, k - 1) + 1), end),
        )

    return _bind(ends, each)


def term_positions(tokens: Column) -> Column:
    """Tokens to an array of (term, positions), in term order; positions count from 0.

    Terms are sorted together with their places, so the places of a term are a slice.
    """
    placed = F.transform(tokens, lambda term, i: F.struct(term.alias("term"), i.alias("at")))

    def runs(ordered: Column) -> Column:
        def run(first: Column, last: Column) -> Column:
            places = F.slice(ordered, first, last - first + 1)
            return F.struct(
                F.get(ordered, last - 1)["term"].alias("term"),
                F.transform(places, lambda place: place["at"]).alias("positions"),
            )

        return _runs(ordered, lambda after, item: after["term"] == item["term"], run)

    return _bind(F.sort_array(placed), runs)


def term_counts(tokens: Column) -> Column:
    """Tokens to an array of (term, tf), in term order.

    The tokens are sorted; the last position of each run of equal tokens, less
    that of the run before it, is the tf of its term. The arrays are bound first,
    so that the lambdas never compute them again: the work is n log n in the
    number of tokens.
    """

    def last_positions(ordered: Column) -> Column:
        return F.array_compact(
            F.transform(
                ordered,
                lambda term, i: F.when(~F.get(ordered, i + 1).eqNullSafe(term), i + 1),
            )
        )

    def runs(ordered: Column, ends: Column) -> Column:
        def run(end: Column, k: Column) -> Column:
            start = F.when(k == 0, 0).otherwise(F.get(ends, k - 1))
            return F.struct(
                F.get(ordered, end - 1).alias("term"), (end - start).cast("long").alias("tf")
            )

        return F.transform(ends, run)

    return _bind(
        F.sort_array(tokens),
        lambda ordered: _bind(last_positions(ordered), lambda ends: runs(ordered, ends)),
    )


def count_terms(frame: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per input row: id, ``len`` and ``terms`` (array of term and tf).

    All occurrences of a term lie in one row, so counting needs no shuffle.
    """
    tokens = frame.select(F.col(id_col), tokenize(F.col(text_col)).alias("tokens"))
    return tokens.select(
        id_col,
        F.size("tokens").cast("long").alias("len"),
        term_counts(F.col("tokens")).alias("terms"),
    )
