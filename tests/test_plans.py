"""What the plans must look like to hold at scale."""

import re

import pytest
from pyspark.sql import functions as F

import termlode
from termlode.operators import tables
from termlode.plans.search import as_queries


def plan(frame):
    text = frame._jdf.queryExecution().executedPlan().toString()
    return re.sub(r"#\d+L?", "", text)


@pytest.fixture
def no_small_tables(spark):
    """Only hinted broadcasts, as if all tables were large."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_scoring_a_stored_index_moves_no_postings(spark, stored, no_small_tables):
    text = plan(termlode.bm25_scores(stored[1], as_queries(spark, "red apple")))
    assert "Exchange hashpartitioning" not in text
    assert "SortMergeJoin" not in text
    assert "Or(EqualTo(term,apple),EqualTo(term,red))" in text


def test_many_terms_reach_the_scan_as_equalities(spark, stored):
    words = " ".join(f"word{c}" for c in "abcdefghijklmnop")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    text = plan(termlode.bm25_scores(stored[1], words))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "EqualTo(term,wordp)" in text and "In(term" not in text


def test_large_batches_move_no_hits(spark, stored, no_small_tables):
    queries = spark.createDataFrame([(i, "red apple tree") for i in range(9)], "query_id long, query string")
    text = plan(termlode.bm25_scores(stored[1], queries, broadcast_bytes=500))
    assert "Union" in text and "Exchange hashpartitioning" not in text


def test_details_are_found_by_id(stored):
    hits = termlode.bm25_search(stored[1], "red", 2)
    assert "EqualTo(doc_id,1)" in plan(termlode.with_details(stored[1], hits))


def test_unique_ids_pass_without_sorting(spark, make_corpus):
    unique = make_corpus([(1, "a"), (2, "b"), (None, "c")])
    assert "Exchange" not in plan(termlode.drop_duplicate_ids(unique))
    repeats = make_corpus([(1, "a"), (1, "b"), (2, "b"), (None, "d"), (None, "c")])
    kept = termlode.drop_duplicate_ids(repeats)
    text = plan(kept)
    once, repeated = text[: text.index("SortAggregate")], text[text.index("SortAggregate") :]
    assert "LeftAnti" in once and "LeftSemi" in repeated
    # The texts of repeated ids are shuffled once, by their minimum; no other text is.
    assert text.count("Exchange hashpartitioning") == 1
    rows = {(r["doc_id"], r["text"]) for r in kept.collect()}
    assert rows == {(1, "a"), (2, "b"), (None, "c")}


def test_scores_of_all_documents_move_no_rows(spark, stored, no_small_tables):
    hits = termlode.bm25_scores(stored[1], as_queries(spark, "red apple"))
    assert "Exchange hashpartitioning" not in plan(termlode.score_all(stored[1], hits))


def test_single_query_keeps_n_rows_per_task(stored):
    text = plan(termlode.bm25_search(stored[1], "red apple", 5, include_zero=False))
    assert "TakeOrderedAndProject(limit=5" in text


def test_batch_keeps_n_rows_per_query_and_task(spark, stored):
    queries = as_queries(spark, "red apple")
    text = plan(termlode.bm25_search(stored[1], queries, 5, include_zero=False))
    before_shuffle = text[text.index("Exchange hashpartitioning(query_id") :]
    assert re.search(r"WindowGroupLimit .* 5, Partial", before_shuffle)


def test_counting_terms_needs_no_shuffle(make_corpus):
    corpus = make_corpus([(1, "a b a")])
    assert "Exchange" not in plan(tables.postings(tables.forward_index(corpus)))


def test_df_is_counted_before_the_shuffle(hand_index):
    text = plan(hand_index.frequencies)
    assert text.index("partial_count") > text.index("Exchange hashpartitioning(term")


def test_frequent_terms_are_not_shuffled_for_weights(stored, no_small_tables):
    frequent, rare = plan(termlode.tfdf_postings(stored[1])).split("SortMergeJoin")
    assert "BroadcastHashJoin [term], [term], Inner" in frequent
    assert "Exchange hashpartitioning(term" not in frequent
    assert "LeftAnti" in rare


def test_metadata_reads_only_matching_rows(spark, stored, no_small_tables, tmp_path):
    path = str(tmp_path / "details")
    details = spark.range(100).select(
        F.col("id").alias("doc_id"), F.lit("long").alias("text"), F.lit("t").alias("title")
    )
    details.write.parquet(path)
    hits = termlode.bm25_search(stored[1], "red", 2)
    text = plan(termlode.with_metadata(hits, spark.read.parquet(path)))
    assert "BroadcastHashJoin [doc_id], [doc_id], LeftSemi, BuildRight" in text
    assert "ReadSchema: struct<doc_id:bigint,title:string>" in text


def test_no_python_and_no_cross_join(spark, stored):
    queries = as_queries(spark, "red apple")
    for frame in (
        termlode.bm25_search(stored[1], "red", 5),
        termlode.tfdf_search(stored[1], queries, 5),
        termlode.tfdf_postings(stored[1]),
        termlode.bm25_scores(stored[1], queries, broadcast_bytes=0),
    ):
        text = plan(frame)
        assert "Python" not in text
        assert "CartesianProduct" not in text
        assert "BroadcastNestedLoopJoin" not in text
