"""Terms spelt almost alike, against every term of the vocabulary."""

import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

import termlode
from termlode.plans import fuzzy


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


@pytest.fixture(scope="module")
def words():
    rng = random.Random(4)
    found = {"".join(rng.choices("abé", k=rng.randint(1, 6))) for _ in range(150)}
    return sorted(found | {"a" * 39, "a" * 40, "a" * 41, "a" * 42, "b" + "a" * 41, "a" * 60})


@pytest.fixture(scope="module")
def built(words, make_corpus, tmp_path_factory):
    folder = tmp_path_factory.mktemp("fuzzy")
    rows = [(k, " ".join(words[k::7])) for k in range(7)]
    index = termlode.write_index(make_corpus(rows), str(folder / "index"), 2)
    return dict(rows), index, termlode.write_fuzzy_index(index, str(folder / "fuzzy"), 2)


ASKED = ["ab", "éab", "zzz", "b", "aébéa", "a" * 38, "a" * 41, "a" * 43, "x" * 70]


@pytest.mark.parametrize("distance", [0, 1, 2])
def test_terms_equal_all_pairs(spark, words, built, distance):
    queries = spark.createDataFrame([(k, t) for k, t in enumerate(ASKED)], "query_id int, query string")
    got = termlode.fuzzy_terms(built[2], queries, distance).collect()
    expected = [
        (k, t, w, edits(t, w)) for k, t in enumerate(ASKED) for w in words if edits(t, w) <= distance
    ]
    assert sorted(tuple(r)[:4] for r in got) == sorted(expected)
    with pytest.raises(ValueError):
        termlode.fuzzy_terms(built[2], "a", 3)


def test_search_weighs_terms_by_their_distance(built):
    texts, index, neighbours = built
    got = termlode.fuzzy_search(index, neighbours, "ab éab", 5, 1).collect()
    near = {w for t in texts.values() for w in t.split() if min(edits(w, "ab"), edits(w, "éab")) <= 1}
    assert {r["doc_id"] for r in got} <= {k for k, t in texts.items() if near & set(t.split())}
    exact = termlode.fuzzy_search(index, neighbours, "ab éab", 7, 0).collect()
    plain = termlode.bm25_search(index, "ab éab", 7, include_zero=False).collect()
    assert [(r[1], round(r[2], 9)) for r in exact] == [(r[1], round(r[2], 9)) for r in plain]
    assert termlode.fuzzy_search(index, neighbours, "zzzzzz", 3).collect() == []


def test_a_lookup_is_pushed_into_the_scan(built):
    plan = termlode.fuzzy_terms(built[2], "ab")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(key,ab)" in plan and "BroadcastHashJoin" in plan


def test_deletions(spark):
    one = spark.range(1).select(F.sort_array(fuzzy.deletions(F.lit("aab"), 2)).alias("d")).first()
    assert one["d"] == ["a", "aa", "aab", "ab", "b"]
    none = spark.range(1).select(fuzzy.deletions(F.lit(""), 2).alias("d")).first()
    assert none["d"] == [""]


def test_a_task_sorts_a_bounded_number_of_terms(words, built, tmp_path, monkeypatch):
    assert fuzzy.sort_parts(54_000_000, 12) == 1350
    monkeypatch.setattr(fuzzy, "SORTED_TERMS", 10)
    stored = fuzzy.write_fuzzy_index(built[1], str(tmp_path / "many"), 2)
    listed = stored.select("key", "term", F.input_file_name().alias("file")).collect()
    assert len({r["file"] for r in listed}) > 4
    for file in {r["file"] for r in listed}:
        keys = [(r["key"], r["term"]) for r in listed if r["file"] == file]
        assert keys == sorted(keys)
    assert len({(r["key"], r["term"]) for r in listed}) == len(listed)


def test_deletions_are_all_subsequences(spark):
    frame = spark.createDataFrame([("abcab",), ("é",), ("",)], "t string")
    for distance in (0, 1, 2):
        for text, found in frame.select("t", fuzzy.deletions(F.col("t"), distance)).collect():
            kept = range(max(0, len(text) - distance), len(text) + 1)
            assert sorted(found) == sorted({"".join(c) for k in kept for c in combinations(text, k)})
