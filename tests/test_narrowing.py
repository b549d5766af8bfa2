"""Large batches read the postings of their own terms."""

import random

import brute
import pytest
from pyspark.sql import functions as F

import termlode
from termlode.plans import search
from termlode.plans.narrowing import narrow_postings


@pytest.fixture(scope="module")
def docs():
    rng = random.Random(3)
    common = [f"common{c}" for c in "abcdefghijklmnop"]
    rare = [f"r{a}{b}" for a in "abcdefghijklm" for b in "abcdefghijklm"]
    return [(i, " ".join(rng.sample(common, 12) + rng.choices(rare, k=4))) for i in range(90)]


@pytest.fixture(scope="module")
def large(make_corpus, docs, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("large") / "index")
    return termlode.write_index(make_corpus(docs), root, shards=3)


@pytest.fixture(scope="module")
def texts():
    letters = "abcdefghijklm"
    return {i: f"r{a}{b} r{b}{a} unheard{a}" for i, (a, b) in enumerate((a, b) for a in letters for b in letters)}


def batch(spark, texts):
    return spark.createDataFrame(list(texts.items()), "query_id BIGINT, query STRING")


@pytest.mark.parametrize("limit", [4000, 1 << 20])
def test_each_pass_reads_postings_of_asked_terms_alone(spark, large, texts, limit):
    terms = search.query_terms(batch(spark, texts))

    def size(frame):
        return frame.agg(F.sum(search.row_bytes("term"))).first()[0]

    found = narrow_postings(large, terms, size, limit)
    asked = {r["term"] for r in terms.select("term").distinct().collect()}
    expected = sorted(tuple(r) for r in large.postings.collect() if r["term"] in asked)
    assert sorted(tuple(r) for r in found.rows.collect()) == expected
    assert 0 < len(expected) < large.postings.count() / 3
    # The buckets are those of the index.
    scan = found.rows.groupBy("doc_id").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in scan and "Bucketed: true" in scan
    found.discard()
    assert not spark.catalog.listTables(pattern="*asked*")


def test_common_terms_are_read_in_place(spark, large):
    terms = large.frequencies.select("term")
    assert narrow_postings(large, terms, lambda _: 1, 1).rows is large.postings


@pytest.mark.parametrize("include_zero", [True, False])
def test_sliced_batches_equal_loops(spark, large, docs, texts, include_zero):
    before = len(spark.catalog.listTables())
    for run, scorer in ((termlode.bm25_search, brute.bm25), (termlode.tfdf_search, brute.tfdf)):
        found = run(large, batch(spark, texts), 5, include_zero=include_zero, broadcast_bytes=15_000)
        rows = {(r["query_id"], r["rank"]): (r["doc_id"], r["score"]) for r in found.collect()}
        expected = {}
        for query_id, text in texts.items():
            for rank, doc_id, score in brute.top(scorer(docs, text), 5):
                if score or include_zero:
                    expected[query_id, rank] = (doc_id, score)
        assert {k: v[0] for k, v in rows.items()} == {k: v[0] for k, v in expected.items()}
        for key, (_, score) in expected.items():
            assert rows[key][1] == pytest.approx(score, rel=1e-9)
    assert len(spark.catalog.listTables()) == before


def test_scores_of_sliced_batches(spark, large, docs, texts):
    found = termlode.bm25_scores(large, batch(spark, texts), broadcast_bytes=15_000).collect()
    expected = {
        (query_id, doc_id): score
        for query_id, text in texts.items()
        for doc_id, score in brute.bm25(docs, text).items()
        if score
    }
    assert {(r["query_id"], r["doc_id"]): r["score"] for r in found} == pytest.approx(expected)
    assert len(found) == len(expected)
