import brute
import pytest
from conftest import HAND
from pyspark.sql import functions as F

import termlode
from termlode.operators import joins, tables
from termlode.plans import index


def rows(frame, *columns):
    return sorted(tuple(row) for row in frame.select(*columns).collect())


def test_hand_corpus_tables(hand_index):
    assert rows(hand_index.doc_lengths, "doc_id", "len") == [(1, 4), (2, 3), (3, 0), (4, 2)]
    assert rows(hand_index.frequencies, "term", "df") == [
        ("apple", 2),
        ("green", 1),
        ("pear", 1),
        ("pie", 1),
        ("red", 1),
        ("tree", 1),
    ]
    assert rows(hand_index.postings, "doc_id", "term", "tf", "len") == [
        (1, "apple", 1, 4),
        (1, "pear", 1, 4),
        (1, "red", 2, 4),
        (2, "apple", 2, 3),
        (2, "pie", 1, 3),
        (4, "green", 1, 2),
        (4, "tree", 1, 2),
    ]
    assert [tuple(r) for r in hand_index.stats.collect()] == [(4, 9, 2.25, 7)]
    maps = {r["doc_id"]: r["terms"] for r in tables.term_map(hand_index.forward).collect()}
    assert maps[1] == {"apple": 1, "pear": 1, "red": 2}
    assert maps[3] == {}


def test_lengths_add_up_and_df_is_bounded(hand_index):
    total = hand_index.postings.agg(F.sum("tf")).first()[0]
    stats = hand_index.stats.first()
    assert total == stats["total_len"]
    assert hand_index.frequencies.where(F.col("df") > stats["n_docs"]).count() == 0
    idf = termlode.bm25_idf(F.col("df"), hand_index.stat("n_docs"))
    assert hand_index.frequencies.where(idf <= 0).count() == 0


def test_empty_corpus(make_corpus):
    index = termlode.build_index(make_corpus([]))
    assert [tuple(r) for r in index.stats.collect()] == [(0, 0, None, 0)]
    assert termlode.bm25_search(index, "red", 5).collect() == []


def test_null_text_is_an_empty_document(make_corpus):
    index = termlode.build_index(make_corpus([(1, None), (2, "a")]))
    assert rows(index.doc_lengths, "doc_id", "len") == [(1, 0), (2, 1)]


def test_stored_index_equals_lazy_index(hand_index, stored):
    root, index = stored
    for part in ("doc_lengths", "frequencies", "postings", "stats", "first_docs"):
        lazy, kept = getattr(hand_index, part), getattr(index, part)
        assert rows(lazy, *lazy.columns) == rows(kept, *lazy.columns), part


def test_loading_without_registered_tables(spark, stored):
    root, index = stored
    expected = rows(index.postings, "doc_id", "term", "tf", "len")
    for table in spark.catalog.listTables():
        if table.name.startswith("termlode_"):
            spark.sql(f"DROP TABLE {table.name}")
    loaded = termlode.load_index(spark, root)
    assert rows(loaded.postings, "doc_id", "term", "tf", "len") == expected
    assert rows(loaded.forward, "doc_id", "len") == rows(index.forward, "doc_id", "len")


def test_existing_index_is_not_overwritten(make_corpus, stored):
    root, index = stored
    with pytest.raises(Exception, match="(?i)exist|non-empty"):
        termlode.write_index(make_corpus([(9, "other")]), root, shards=3)
    assert index.doc_lengths.count() == len(HAND)


def test_relative_paths_are_refused(make_corpus):
    with pytest.raises(ValueError, match="absolute"):
        termlode.write_index(make_corpus(HAND), "index")


def test_string_ids(spark, tmp_path):
    frame = spark.createDataFrame([("b", "red red"), ("a", "red")], "id STRING, body STRING")
    corpus = termlode.as_corpus(frame, "id", "body")
    index = termlode.write_index(corpus, str(tmp_path / "index"), shards=2)
    found = termlode.bm25_search(index, "red", 5).collect()
    assert [row["doc_id"] for row in sorted(found)] == ["b", "a"]


def test_duplicate_ids_keep_one_row(make_corpus):
    kept = termlode.drop_duplicate_ids(make_corpus([(1, "b"), (1, "a"), (2, "c")]))
    assert rows(kept, "doc_id", "text") == [(1, "a"), (2, "c")]
    assert kept.columns == ["doc_id", "text", "title", "url"]


def test_repeated_ids_are_refused(make_corpus, tmp_path):
    with pytest.raises(ValueError, match="unique"):
        termlode.write_index(make_corpus([(1, "a"), (1, "b"), (2, "c")]), str(tmp_path / "i"), 2)


def test_a_quote_in_the_path(spark, make_corpus, tmp_path):
    root = str(tmp_path / "reader's index")
    termlode.write_index(make_corpus(HAND), root, shards=2)
    for name in [t.name for t in spark.catalog.listTables() if t.name.startswith("termlode_")]:
        spark.sql(f"DROP TABLE {name}")
    assert termlode.load_index(spark, root).forward.count() == len(HAND)


def test_shards_follow_the_size_without_a_job(spark, make_corpus, tmp_path):
    path = str(tmp_path / "big")
    spark.range(2000).select(F.col("id").alias("doc_id"), F.sha2(F.col("id").cast("string"), 512).alias("text")).write.parquet(path)
    corpus = termlode.as_corpus(spark.read.parquet(path), "doc_id", "text")
    # Looking for repeated ids takes jobs of its own.
    unique = termlode.drop_duplicate_ids(corpus)
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    cores = spark.sparkContext.defaultParallelism
    assert termlode.suggest_shards(unique) >= cores
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == before


def test_tfdf_index_is_stored_with_empty_documents(spark, hand_index, tmp_path):
    forward = termlode.write_tfdf_index(hand_index, str(tmp_path / "tfdf"))
    found = {r["doc_id"]: (r["len"], r["weights"]) for r in forward.collect()}
    assert found[3] == (0, {}) and found[1] == (4, {"red": 2.0, "apple": 0.5, "pear": 1.0})


def weights(docs):
    counts, df = brute._tables(docs)
    return {(d, t): tf / df[t] for d, count in counts.items() for t, tf in count.items()}


@pytest.mark.parametrize("hot_terms", [1, 3, 20_000])
def test_tfdf_weights_with_frequent_and_rare_terms(hand_index, hot_terms):
    joined = joins.attach_df(
        hand_index.postings, hand_index.frequencies, hand_index.stat("n_postings"), hot_terms
    )
    found = joined.select("doc_id", "term", (F.col("tf") / F.col("df")).alias("w")).collect()
    assert len(found) == 7
    assert {(r["doc_id"], r["term"]): r["w"] for r in found} == weights(HAND)


def test_tfdf_postings(hand_index, stored):
    for index in (hand_index, stored[1]):
        found = termlode.tfdf_postings(index).collect()
        assert {(r["doc_id"], r["term"]): r["weight"] for r in found} == weights(HAND)


def test_a_shard_holds_the_same_whatever_the_corpus(make_corpus, monkeypatch):
    corpus = make_corpus(HAND)
    gigabytes = [1, 6, 60]
    shards = []
    for size in gigabytes:
        monkeypatch.setattr(index, "estimated_bytes", lambda _, size=size: size << 30)
        shards.append(termlode.suggest_shards(corpus))
    assert all(number >= 32 * size for number, size in zip(shards, gigabytes, strict=True))
