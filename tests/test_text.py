import brute
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from termlode.functions.text import count_terms, tokenize

CASES = [
    (
        "café a\\nb h2o don\\'t a/b x-y 1990 \"} ",
        ["café", "a", "b", "ho", "dont", "ab", "x", "y"],
    ),
    ("a\u00a0b — c\x0bd", ["a\u00a0b", "—", "c\x0bd"]),
    ("", []),
    (None, []),
    ("1999 ...", []),
    (" \t\r\n\f", []),
    ("İstanbul Σ ΑΣ", ["i̇stanbul", "σ", "ας"]),
    ("\\1a \\A tab\\there", ["a", "tab", "here"]),
    ("Red apple, red pear.", ["red", "apple", "red", "pear"]),
    ("state-of-the-art", ["state", "of", "the", "art"]),
    ("[~`!@#$%^&*()_+=,.<>?/'\":;{}|] ok", ["ok"]),
]

TEXTS = st.lists(
    st.text(alphabet="abAB \\-n1.\n\t\r\f\x0b'é—|]", max_size=40), min_size=1, max_size=30
)


def tokenized(spark, texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i INT, t STRING")
    found = rows.select("i", tokenize(F.col("t")).alias("tokens")).collect()
    return [row["tokens"] for row in sorted(found)]


def test_cases(spark):
    assert tokenized(spark, [text for text, _ in CASES]) == [tokens for _, tokens in CASES]


@settings(max_examples=15, deadline=None)
@given(texts=TEXTS)
def test_agrees_with_the_rule_token_by_token(spark, texts):
    assert tokenized(spark, texts) == [brute.tokens(text) for text in texts]


@settings(max_examples=10, deadline=None)
@given(texts=TEXTS)
def test_tokenizing_tokens_changes_nothing(spark, texts):
    once = tokenized(spark, texts)
    assert tokenized(spark, [" ".join(tokens) for tokens in once]) == once


@settings(max_examples=10, deadline=None)
@given(texts=TEXTS)
def test_term_counts(spark, texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i INT, t STRING")
    for row in count_terms(rows, "i", "t").collect():
        expected = brute.tokens(texts[row["i"]])
        assert row["len"] == len(expected)
        assert [tuple(pair) for pair in row["terms"]] == sorted(
            (term, expected.count(term)) for term in set(expected)
        )


def test_long_document_with_a_filter_on_its_terms(spark):
    """A filter that moves below the projection must not make counting quadratic."""
    text = F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(60_000)), _word))
    counted = count_terms(spark.range(1).select("id", text.alias("text")), "id", "text")
    row = counted.where(F.size("terms") > 1).select("len", F.size("terms").alias("n")).first()
    assert (row["len"], row["n"]) == (60_000, 26**2)


def _word(i):
    letters = F.lit("abcdefghijklmnopqrstuvwxyz")
    first = F.substring(letters, i % 26 + 1, F.lit(1))
    second = F.substring(letters, F.floor(i / 26) % 26 + 1, F.lit(1))
    return F.concat(first, second)
