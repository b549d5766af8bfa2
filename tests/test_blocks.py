"""The blocked index, pruned search, phrases, proximity, boolean conditions and snippets."""

import random
from itertools import product

import pytest
from pyspark.sql import functions as F

import termlode
from termlode.functions.text import term_positions, tokenize
from termlode.plans import blocks, pruning
from termlode.plans.matching import (
    boolean_search,
    has,
    phrase_matches,
    phrase_search,
    proximity_search,
    search_with_snippets,
)
from termlode.plans.search import ask

WORDS = "a b c d e f g h".split()


def random_texts(seed, documents, most):
    rng = random.Random(seed)
    weights = [2.0 ** -k for k in range(len(WORDS))]
    return [
        (i, " ".join(rng.choices(WORDS, weights, k=rng.randint(0, most)))) for i in range(documents)
    ]


@pytest.fixture(scope="module")
def small(make_corpus, tmp_path_factory):
    texts = random_texts(1, 300, 30)
    root = str(tmp_path_factory.mktemp("blocked") / "small")
    return dict(texts), termlode.write_blocked_index(make_corpus(texts), root, 3, 7)


@pytest.fixture(scope="module")
def large(make_corpus, tmp_path_factory):
    """Many documents of all lengths in many ranges, so that layers and ranges differ."""
    patched = pytest.MonkeyPatch()
    patched.setattr(blocks, "FIRST_LAYER", 4)
    rng = random.Random(5)
    rows = random_texts(2, 4000, 40) + [(5000 + i, "h " * i + "g g") for i in range(40)]
    rng.shuffle(rows)
    folder = tmp_path_factory.mktemp("large")
    corpus = make_corpus(rows)
    blocked = termlode.write_blocked_index(corpus, str(folder / "blocked"), 4, 60)
    plain = termlode.write_index(corpus, str(folder / "plain"), 4)
    patched.undo()
    return plain, blocked


def listed(frame, *columns):
    return sorted(tuple(row) for row in frame.select(*columns).collect())


def test_term_positions(spark):
    frame = spark.createDataFrame([("b a b.c 1 a",), ("",), (None,)], "text string")
    rows = frame.select(term_positions(tokenize(F.col("text"))).alias("t")).collect()
    got = [[(t["term"], t["positions"]) for t in row["t"]] for row in rows]
    assert got == [[("a", [1, 3]), ("b", [0]), ("bc", [2])], [], []]


def test_blocks_hold_all_postings_in_layers(large):
    plain, blocked = large
    rows = blocks.postings_of(blocked.blocks, "term")
    assert listed(rows, "doc_id", "term", "tf", "len") == listed(
        plain.postings, "doc_id", "term", "tf", "len"
    )
    layers = blocked.blocks.collect()
    assert len(layers) < rows.count() / 3
    for row in layers:
        assert row["docs"] == sorted(row["docs"]) and row["n"] == len(row["docs"])
        assert row["max_tf"] == max(row["tfs"]) and row["min_len"] == min(row["lens"])
        assert row["tfs"] == [len(p) for p in row["positions"]]
    by_list = {}
    for row in layers:
        by_list.setdefault((row["range"], row["term"]), []).append((row["layer"], row["impact"]))
    for found in by_list.values():
        assert [k for k, _ in sorted(found)] == list(range(len(found)))
        impacts = [x for _, x in sorted(found)]
        assert impacts == sorted(impacts, reverse=True)


def test_blocks_are_written_without_a_second_shuffle(spark, make_corpus, tmp_path, monkeypatch):
    plans = []
    kept = blocks.plain.write_bucketed

    def watched(frame, *rest):
        plans.append(frame._jdf.queryExecution().executedPlan().toString())
        kept(frame, *rest)

    monkeypatch.setattr(blocks.plain, "write_bucketed", watched)
    termlode.write_blocked_index(make_corpus([(1, "a b a"), (2, "b")]), str(tmp_path / "x"), 3)
    # The second exchange belongs to the mean length, one row.
    assert plans[1].count("Exchange hashpartitioning") == 0
    with pytest.raises(ValueError, match="unique"):
        termlode.write_blocked_index(make_corpus([(1, "a"), (1, "b")]), str(tmp_path / "y"), 3)


QUERIES = ["a", "h", "g h", "a b c d e f g h", "h zzz", "zzz", "", "a h h"]


@pytest.mark.parametrize("options", [{}, {"k1": 1.2, "b": 0.1}, {"k1": 0.0}, {"tf_scale": 10.0}])
def test_pruned_search_loses_nothing(spark, large, options):
    plain, blocked = large
    queries = spark.createDataFrame(list(enumerate(QUERIES)), "query_id int, query string")
    for n in (1, 10, 700):
        got = pruning.pruned_search(blocked, queries, n, **options)
        expected = termlode.bm25_search(plain, queries, n, **options)
        columns = ("query_id", "rank", "doc_id", F.round("score", 6))
        assert listed(got, *columns) == listed(expected, *columns)


def test_pruned_search_of_one_text(large):
    plain, blocked = large
    columns = ("rank", "doc_id", F.round("score", 6))
    for query, n, zero in [("g h", 10, True), ("zzz", 3, True), ("zzz", 3, False), ("a", 0, True)]:
        got = pruning.pruned_search(blocked, query, n, include_zero=zero)
        expected = termlode.bm25_search(plain, query, n, include_zero=zero)
        assert listed(got, *columns) == listed(expected, *columns)
    with pytest.raises(ValueError):
        pruning.pruned_search(blocked, "a", 1001)


def test_fewer_postings_are_read(spark, large):
    """Of a frequent and a rare term, the three passes open a part of the lists."""
    plain, blocked = large
    asked = ask("a b h", spark, 1 << 26)
    how = pruning._Scoring(blocked.stat("avg_len"), 2.0, 0.75, 1.0)
    found = pruning.passes(blocked, asked.slices[0], asked.known, 10, how, 1 << 26)

    def read(frame):
        return frame.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]

    chosen = blocked.blocks.where(F.col("term").isin(asked.known))
    whole = read(chosen)
    first, strong, final = read(chosen.where("layer = 0")), read(found.strong), read(found.final)
    assert first + strong + final < 0.7 * whole
    assert found.candidates.count() < 200 and found.hits.count() >= 10
    plan = found.strong._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(impact" in plan


def places(tokens, phrase):
    size = len(phrase)
    return [i for i in range(len(tokens) - size + 1) if tokens[i : i + size] == phrase]


@pytest.mark.parametrize("phrase", ["a", "a b", "b a", "a a", "a b a", "c a a b", "a zzz", ""])
def test_phrases(small, phrase):
    texts, index = small
    tokens = phrase.split()
    expected = []
    for i, text in texts.items():
        at = places(text.split(), tokens) if tokens else []
        expected += [(i, len(at), at[0])] if at else []
    assert listed(phrase_matches(index, phrase), "doc_id", "matches", "first") == expected
    top = phrase_search(index, phrase, 5).collect()
    assert [r["rank"] for r in top] == list(range(1, min(5, len(expected)) + 1))
    assert {(r["doc_id"], r["matches"], r["first"]) for r in top} <= set(expected)
    assert [r["score"] for r in top] == sorted((r["score"] for r in top), reverse=True)


def smallest(tokens, terms):
    """Span and start, by trying every stretch."""
    found = [
        (j - i, i)
        for i in range(len(tokens))
        for j in range(i + 1, len(tokens) + 1)
        if terms <= set(tokens[i:j])
    ]
    return min(found, default=None)


@pytest.mark.parametrize("text", ["a", "a b", "f c a", "a a b", "a zzz", "", "a b c d e"])
def test_proximity(small, text):
    texts, index = small
    terms = set(text.split())
    found = [(i, smallest(t.split(), terms)) for i, t in texts.items()] if terms else []
    expected = sorted((s[0], i, s[1]) for i, s in found if s)[:8]
    got = proximity_search(index, text, 8).orderBy("rank").collect()
    assert [(r["span"], r["doc_id"], r["first"]) for r in got] == expected


def test_boolean_conditions(small):
    texts, index = small
    leaves = {x: has(x) for x in ["a", "d", "h", "b c", "zzz", ""]}

    def holds(text, leaf):
        tokens = text.split()
        return bool(leaf.split()) and bool(places(tokens, leaf.split()))

    for x, y in product(leaves, ["d", "b c"]):
        cases = [
            (leaves[x] & ~leaves[y], lambda t, x=x, y=y: holds(t, x) and not holds(t, y)),
            (
                ~(leaves[x] | ~leaves[y]) | leaves["h"],
                lambda t, x=x, y=y: not (holds(t, x) or not holds(t, y)) or holds(t, "h"),
            ),
        ]
        for condition, check in cases[: 1 + (x == "a")]:
            got = boolean_search(index, condition, 1000)
            assert [i for (i,) in listed(got, "doc_id")] == [i for i, t in texts.items() if check(t)]


def test_boolean_scores_and_ranks(spark, small):
    texts, index = small
    got = boolean_search(index, (has("g") | has("h")) & ~has("a a"), 10)
    both = {i for i, t in texts.items() if not places(t.split(), ["a", "a"])}
    scored = termlode.pruned_search(index, "g h", 1000, include_zero=False).collect()
    expected = [(r["doc_id"], round(r["score"], 6)) for r in scored if r["doc_id"] in both][:10]
    assert sorted((r["doc_id"], round(r["score"], 6)) for r in got.collect()) == sorted(expected)
    many = has("a")
    for k in range(130):
        many = many | has(f"none{'x' * k}")
    assert boolean_search(index, many & has("h"), 1000).count() == sum(
        {"a", "h"} <= set(t.split()) for t in texts.values()
    )


def test_snippets(small):
    texts, index = small
    rows = search_with_snippets(index, "f g h", 20, around=1).collect()
    for row in rows:
        tokens = texts[row["doc_id"]].split()
        inside = {"f", "g", "h"} & set(tokens)
        span, first = smallest(tokens, inside)
        assert row["found"] == len(inside)
        assert row["first"] == max(0, first - 1) and row["last"] == min(first + span, len(tokens) - 1)
        assert row["snippet"].split() == tokens[row["first"] : row["last"] + 1]
    none = search_with_snippets(index, "zzz", 2).collect()
    assert [r["found"] for r in none] == [0, 0]


def test_buckets_get_as_many_ranges(spark, make_corpus, tmp_path):
    rows = [(i, "a b") for i in range(400)]
    index = termlode.write_blocked_index(make_corpus(rows), str(tmp_path / "even"), 4, 10)
    bucket = F.pmod(F.hash("range"), F.lit(4)).alias("bucket")
    counts = index.forward.groupBy(bucket).agg(F.count_distinct("range").alias("n")).collect()
    assert sorted(r["n"] for r in counts) == [2, 2, 3, 3]
    assert index.forward.count() == 400
    assert len(blocks.range_numbers(spark, 375, 375)) == 375


def test_many_candidates_move_no_postings(spark, large):
    """Too many to broadcast, candidates are not joined: their ranges are scored in place."""
    plain, blocked = large
    queries = spark.createDataFrame([(1, "a b"), (2, "h g")], "query_id long, query string")
    asked = ask(queries, spark, 1 << 26)
    how = pruning._Scoring(blocked.stat("avg_len"), 2.0, 0.75, 1.0)
    found = pruning.passes(blocked, asked.slices[0], None, 10, how, 0)
    text = found.hits._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in text and "SortMergeJoin" not in text
    columns = ("query_id", "rank", "doc_id", F.round("score", 6))
    got = listed(pruning.best(found.hits, 10), *columns)
    assert got == listed(termlode.bm25_search(plain, queries, 10), *columns)
