"""An index that grows equals one full build, whatever came in which order."""

import random

import pytest
from pyspark.sql import functions as F

import termlode
from termlode.plans import segments
from termlode.plans.segments import (
    CommitConflict,
    append_documents,
    delete_documents,
    ingest_stream,
    load_segments,
    merge_segments,
    versions,
)

WORDS = "a b c d e f g h".split()


def texts(seed, ids):
    rng = random.Random(seed)
    return [(i, " ".join(rng.choices(WORDS, k=rng.randint(0, 12)))) for i in ids]


def same_index(spark, grown, whole):
    for part, columns in [
        ("forward", ["doc_id", "len", "terms"]),
        ("postings", ["doc_id", "len", "term", "tf"]),
        ("frequencies", ["term", "df"]),
        ("stats", ["n_docs", "total_len", "avg_len", "n_postings"]),
        ("first_docs", ["doc_id"]),
        ("details", ["doc_id", "title", "url"]),
    ]:
        got, expected = (getattr(x, part).select(*columns).collect() for x in (grown, whole))
        assert sorted(map(repr, got)) == sorted(map(repr, expected)), part
    for query in ["a", "a h", "zzz"]:
        got, expected = (
            termlode.bm25_search(x, query, 7).orderBy("rank").collect() for x in (grown, whole)
        )
        assert [(r[0], r[1], round(r[2], 9)) for r in got] == [
            (r[0], r[1], round(r[2], 9)) for r in expected
        ]
    queries = spark.createDataFrame([(1, "a b"), (2, "h")], "query_id int, query string")
    got, expected = (termlode.tfdf_search(x, queries, 5) for x in (grown, whole))
    rounded = ["query_id", "rank", "doc_id", F.round("score", 9).alias("score")]
    assert sorted(got.select(*rounded).collect()) == sorted(expected.select(*rounded).collect())


def test_build_append_replace_delete_equals_one_build(spark, make_corpus, tmp_path):
    root = str(tmp_path / "grown")
    batches = [texts(1, range(40)), texts(2, range(30, 60)), texts(3, [5, 35, 59, 100])]
    for k, batch in enumerate(batches):
        assert append_documents(make_corpus(batch), root, 2) == k + 1
    final = dict(batches[0]) | dict(batches[1]) | dict(batches[2])
    whole = termlode.write_index(make_corpus(list(final.items())), str(tmp_path / "whole"), 2)
    same_index(spark, load_segments(spark, root), whole)

    gone = spark.createDataFrame([(0,), (35,), (777,)], "doc_id long")
    assert delete_documents(gone, root) == 4
    for i in (0, 35):
        del final[i]
    # A deleted document may come back, and earlier versions are still there.
    append_documents(make_corpus([(35, "a a h")]), root, 2)
    final[35] = "a a h"
    whole = termlode.write_index(make_corpus(list(final.items())), str(tmp_path / "again"), 2)
    same_index(spark, load_segments(spark, root), whole)
    first = termlode.write_index(make_corpus(batches[0]), str(tmp_path / "first"), 2)
    same_index(spark, load_segments(spark, root, 1), first)
    with pytest.raises(ValueError):
        load_segments(spark, root, 9)

    # Merging changes nothing but the number of segments.
    assert merge_segments(spark, root) == 6
    merged = load_segments(spark, root)
    same_index(spark, merged, whole)
    assert len(segments._entries(spark, root, None)[1]) == 1
    append_documents(make_corpus([(100, "b b"), (101, "h")]), root, 2)
    assert load_segments(spark, root).stats.first()["n_docs"] == len(final) + 1
    same_index(spark, load_segments(spark, root, 1), first)


def test_a_version_is_committed_once(spark, make_corpus, tmp_path, monkeypatch):
    root = str(tmp_path / "raced")
    append_documents(make_corpus([(1, "a")]), root, 1)
    kept = segments._commit

    def raced(spark, root, version, entries):
        monkeypatch.setattr(segments, "_commit", kept)
        append_documents(make_corpus([(2, "b")]), root, 1)
        kept(spark, root, version, entries)

    monkeypatch.setattr(segments, "_commit", raced)
    with pytest.raises(CommitConflict):
        append_documents(make_corpus([(3, "c")]), root, 1)
    assert versions(spark, root) == [1, 2]
    assert {r["doc_id"] for r in load_segments(spark, root).forward.collect()} == {1, 2}
    assert append_documents(make_corpus([(3, "c")]), root, 1) == 3
    assert load_segments(spark, root).forward.count() == 3


def test_a_stream_is_indexed_exactly_once(spark, make_corpus, tmp_path, monkeypatch):
    root, source, state = (str(tmp_path / x) for x in ("streamed", "source", "state"))
    schema = "doc_id long, text string, title string, url string"

    def arrive(rows):
        make_corpus(rows).coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
        ingest_stream(stream, root, state, "crawl", 1).awaitTermination()

    arrive([(1, "a b"), (2, "c"), (2, "b c")])
    run()
    # The query dies right after a commit, before Spark notes that the batch is done.
    kept = segments._commit

    def dies(*args):
        kept(*args)
        raise RuntimeError("lost")

    arrive([(2, "d d"), (3, "e")])
    monkeypatch.setattr(segments, "_commit", dies)
    with pytest.raises(Exception, match="lost"):
        run()
    monkeypatch.setattr(segments, "_commit", kept)
    arrive([(4, "f")])
    run()
    assert versions(spark, root) == [1, 2, 3]
    final = [(1, "a b"), (2, "d d"), (3, "e"), (4, "f")]
    whole = termlode.write_index(make_corpus(final), str(tmp_path / "whole"), 1)
    same_index(spark, load_segments(spark, root), whole)
    run()
    assert versions(spark, root) == [1, 2, 3]
    merge_segments(spark, root)
    assert append_documents(make_corpus([(1, "again")]), root, 1, "crawl-000000000000") == 4
    same_index(spark, load_segments(spark, root), whole)
