"""Sketches against exact counts, whole and merged from parts."""

import random
from collections import Counter

import pytest

import termlode
from termlode.plans.sketches import COUNT_ERROR, DISTINCT_ERROR


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    names = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(30_000)]
    common = ["the", "of", "and"]
    found = []
    for i in range(3000):
        words = rng.choices(names, k=20) + [w for w in common if rng.random() < 0.7] * 3
        found.append((i, " ".join(words) if i % 50 else "", f"part{i % 3}"))
    return found


def test_estimates_are_within_their_bounds(spark, rows):
    frame = spark.createDataFrame(rows + rows[:100], "doc_id long, text string, title string")
    whole = termlode.corpus_sketches(frame)
    parts = termlode.corpus_sketches(frame, ["title"])
    assert parts.count() == 3
    tokens = Counter(w for _, text, _ in rows + rows[:100] for w in text.split())
    for sketch in (whole, termlode.merge_sketches(parts)):
        got = termlode.sketch_estimates(sketch, 3).first()
        assert abs(got["documents"] - 3000) <= 3000 * DISTINCT_ERROR
        assert abs(got["terms"] - len(tokens)) <= len(tokens) * DISTINCT_ERROR
        assert got["tokens"] == sum(tokens.values())
        assert {t["item"] for t in got["top_terms"]} == {"the", "of", "and"}
        for t in got["top_terms"]:
            assert abs(t["count"] - tokens[t["item"]]) <= got["tokens"] * COUNT_ERROR


def test_merging_by_some_columns(spark, rows):
    frame = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, title string, url string")
    fine = termlode.corpus_sketches(frame, ["title", "url"])
    merged = termlode.sketch_estimates(termlode.merge_sketches(fine, ["title"])).collect()
    direct = termlode.sketch_estimates(termlode.corpus_sketches(frame, ["title"])).collect()
    assert {(r["title"], r["tokens"]) for r in merged} == {(r["title"], r["tokens"]) for r in direct}
    for row in merged:
        assert abs(row["documents"] - 1000) <= 1000 * DISTINCT_ERROR


def test_an_empty_corpus(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    got = termlode.sketch_estimates(termlode.corpus_sketches(frame)).first()
    assert (got["documents"], got["terms"], got["tokens"], got["top_terms"]) == (0, 0, 0, [])
