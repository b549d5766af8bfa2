import random

import brute
import pytest
from conftest import HAND
from pyspark.sql import functions as F

import termlode
from termlode.operators.topn import MAX_RESULTS
from termlode.plans.search import as_queries

QUERY = "red red apple zebra"
WORDS = ["the", "of", "red", "apple", "pie", "tree", "rare", "x"]
WEIGHTS = [400, 100, 20, 10, 5, 3, 1, 1]


def random_docs(seed, size):
    draw = random.Random(seed)
    docs = []
    for doc_id in draw.sample(range(10 * size), size):
        words = draw.choices(WORDS, WEIGHTS, k=draw.choice([0, 1, 2, 5, 30]))
        docs.append((doc_id, " ".join(words)))
    return docs


def results(frame, *first):
    columns = [*first, "rank", "doc_id", "score"]
    return sorted(tuple(row) for row in frame.select(*columns).collect())


def same(found, expected):
    assert [row[:-1] for row in found] == [row[:-1] for row in expected]
    assert [row[-1] for row in found] == pytest.approx([row[-1] for row in expected], rel=1e-9)


def one(scores):
    return {row["doc_id"]: row["score"] for row in scores.collect()}


@pytest.fixture(params=["lazy", "stored"])
def index(request, hand_index, stored):
    return hand_index if request.param == "lazy" else stored[1]


def test_hand_scores(spark, index):
    asked = as_queries(spark, QUERY)
    plain = one(termlode.score_all(index, termlode.bm25_scores(index, asked)))
    scaled = one(termlode.score_all(index, termlode.bm25_scores(index, asked, tf_scale=10.0)))
    dot = one(termlode.score_all(index, termlode.tfdf_scores(index, asked)))
    assert plain == pytest.approx({1: 1.897228, 2: 0.924196, 3: 0, 4: 0}, abs=1e-6)
    assert scaled == pytest.approx({1: 4.697526, 2: 1.848392, 3: 0, 4: 0}, abs=1e-6)
    assert dot == pytest.approx({1: 4.25, 2: 0.5, 3: 0, 4: 0}, abs=1e-12)


def test_zero_scores_fill_up_by_id(index):
    assert [r[1] for r in results(termlode.bm25_search(index, QUERY, 3))] == [1, 2, 3]
    assert [r[1] for r in results(termlode.bm25_search(index, QUERY, 10))] == [1, 2, 3, 4]
    only_hits = termlode.bm25_search(index, QUERY, 10, include_zero=False)
    assert [r[1] for r in results(only_hits)] == [1, 2]


@pytest.mark.parametrize("query", ["zebra", "", "1999", None])
def test_queries_without_known_terms(index, query):
    query = query if query is not None else " \t\n"
    for search in (termlode.bm25_search, termlode.tfdf_search):
        assert results(search(index, query, 3)) == [(1, 1, 0.0), (2, 2, 0.0), (3, 3, 0.0)]
        assert results(search(index, query, 3, include_zero=False)) == []


def test_result_count(index):
    assert results(termlode.bm25_search(index, QUERY, 0)) == []
    assert len(results(termlode.bm25_search(index, QUERY, MAX_RESULTS))) == 4
    for n in (-1, MAX_RESULTS + 1, 2.5, "3", True):
        with pytest.raises(ValueError, match="from 0 to 1000"):
            termlode.bm25_search(index, QUERY, n)


def test_repeated_words_count_only_in_the_dot_product(index):
    once, twice = "red apple", "red red apple"
    same(
        results(termlode.bm25_search(index, twice, 4)),
        results(termlode.bm25_search(index, once, 4)),
    )
    assert results(termlode.tfdf_search(index, once, 1))[0][2] == pytest.approx(2.25)
    assert results(termlode.tfdf_search(index, twice, 1))[0][2] == pytest.approx(4.25)


def test_query_is_tokenized_like_text(index):
    same(
        results(termlode.bm25_search(index, "APPLE-PIE, r3ed!", 4)),
        results(termlode.bm25_search(index, "apple pie red", 4)),
    )


def test_parameters(index):
    found = results(termlode.bm25_search(index, QUERY, 4, k1=1.2, b=0.5))
    same(found, brute.top(brute.bm25(HAND, QUERY, k1=1.2, b=0.5), 4))


@pytest.mark.parametrize("seed", range(2))
def test_random_corpora_against_loops(spark, make_corpus, tmp_path, seed):
    docs = random_docs(seed, 60)
    index = termlode.write_index(make_corpus(docs), str(tmp_path / "index"), shards=3)
    texts = {1: "the", 2: "rare x", 3: "rare rare pie", 4: "nothing", 5: "", 6: "of red"}
    queries = spark.createDataFrame(list(texts.items()), "query_id BIGINT, query STRING")
    for n in (1, 7, 100):
        for search, scorer in (
            (termlode.bm25_search, brute.bm25),
            (termlode.tfdf_search, brute.tfdf),
        ):
            expected = []
            for query_id, text in texts.items():
                expected += [(query_id, *row) for row in brute.top(scorer(docs, text), n)]
            same(results(search(index, queries, n), "query_id"), expected)


def test_single_and_batch_agree(spark, make_corpus):
    docs = random_docs(9, 40)
    index = termlode.build_index(make_corpus(docs).repartition(7))
    expected = brute.top(brute.bm25(docs, "the rare pie"), 15)
    same(results(termlode.bm25_search(index, "the rare pie", 15)), expected)
    batch = termlode.bm25_search(index, as_queries(spark, "the rare pie"), 15)
    same(results(batch), expected)


@pytest.mark.parametrize("broadcast_bytes", [3000, 10_000])
def test_queries_too_large_to_broadcast(spark, make_corpus, broadcast_bytes):
    docs = random_docs(4, 80)
    index = termlode.build_index(make_corpus(docs))
    texts = [(i, " ".join(random.Random(i).choices(WORDS, k=3)) + " the zebra") for i in range(50)]
    queries = spark.createDataFrame(texts, "query_id BIGINT, query STRING")
    for scores, scorer in (
        (termlode.bm25_scores, brute.bm25),
        (termlode.tfdf_scores, brute.tfdf),
    ):
        large = scores(index, queries, broadcast_bytes=broadcast_bytes).collect()
        found = {(row["query_id"], row["doc_id"]): row["score"] for row in large}
        assert len(found) == len(large)
        expected = {
            (query_id, doc_id): score
            for query_id, text in texts
            for doc_id, score in scorer(docs, text).items()
            if score
        }
        assert found == pytest.approx(expected, rel=1e-9)


def test_large_batch_is_filled_up_too(spark, make_corpus, tmp_path):
    docs = random_docs(5, 30)
    index = termlode.write_index(make_corpus(docs), str(tmp_path / "index"), shards=3)
    texts = {1: "rare", 2: "nothing", 3: "the of"}
    queries = spark.createDataFrame(list(texts.items()), "query_id BIGINT, query STRING")
    expected = []
    for query_id, text in texts.items():
        expected += [(query_id, *row) for row in brute.top(brute.bm25(docs, text), 12)]
    found = termlode.bm25_search(index, queries, 12, broadcast_bytes=0)
    same(results(found, "query_id"), expected)


@pytest.mark.parametrize("count", [8, 150])
def test_queries_are_read_once(spark, make_corpus, count):
    index = termlode.build_index(make_corpus([(i, w) for i, w in enumerate(WORDS * 3)]))
    read = spark.sparkContext.accumulator(0)

    def note(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    words = F.array(*[F.lit(w) for w in WORDS])
    drawn = F.element_at(words, (1 + F.rand() * len(WORDS)).cast("int"))
    queries = spark.range(count).select(F.col("id").alias("query_id"), drawn.alias("query"))
    queries = queries.mapInArrow(note, queries.schema)
    found = termlode.bm25_search(index, queries, 3, include_zero=False)
    assert found.select("query_id").distinct().count() == count
    assert read.value == count


def test_bm25_parameters_are_checked(index):
    for wrong in ({"k1": -1.0}, {"b": 3.0}, {"b": -0.1}, {"tf_scale": 0.0}):
        with pytest.raises(ValueError, match="BM25"):
            termlode.bm25_search(index, "red", 3, **wrong)


def test_bm25_grows_with_tf(make_corpus):
    docs = [(tf, " ".join(["red"] * tf + ["x"] * (20 - tf))) for tf in range(1, 20)]
    found = results(termlode.bm25_search(termlode.build_index(make_corpus(docs)), "red", 19))
    assert [doc_id for _, doc_id, _ in found] == list(range(19, 0, -1))


def test_known_query_terms(spark, index):
    terms = termlode.known_query_terms(index, as_queries(spark, QUERY)).collect()
    found = sorted((r["term"], r["qtf"], r["df"]) for r in terms)
    assert found == [("apple", 1, 2), ("red", 2, 1)]
    large = termlode.known_query_terms(index, as_queries(spark, QUERY), broadcast_bytes=0)
    assert sorted((r["term"], r["qtf"], r["df"]) for r in large.collect()) == found


@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 20])
def test_metadata(spark, index, broadcast_bytes):
    details = spark.createDataFrame(
        [(1, "long text", "One", "u1"), (3, "", "Three", "u3"), (7, "x", "Seven", "u7")],
        "id BIGINT, body STRING, title STRING, url STRING",
    )
    corpus = termlode.as_corpus(details, "id", "body", "title", "url")
    hits = termlode.bm25_search(index, QUERY, 3)
    found = termlode.with_metadata(hits, corpus, broadcast_bytes).orderBy("rank").collect()
    assert [(r["rank"], r["doc_id"], r["title"], r["url"]) for r in found] == [
        (1, 1, "One", "u1"),
        (2, 2, None, None),
        (3, 3, "Three", "u3"),
    ]
    assert set(found[0].asDict()) == {"rank", "doc_id", "score", "title", "url"}


def test_ranking_sink(spark, hand_index, tmp_path):
    hits = termlode.bm25_scores(hand_index, as_queries(spark, QUERY))
    scores = termlode.score_all(hand_index, hits)
    path = str(tmp_path / "ranking")
    termlode.write_ranking(scores, path)
    found = termlode.read_ranking(spark, path, 3).orderBy("rank").collect()
    assert [(r["rank"], r["doc_id"]) for r in found] == [(1, 1), (2, 2), (3, 3)]
    kept = spark.read.parquet(path)
    assert [r["doc_id"] for r in kept.orderBy("position").collect()] == [1, 2, 3, 4]
    assert {r["doc_id"] for r in kept.collect()} == {1, 2, 3, 4}
    parts = kept.withColumn("file", F.input_file_name()).collect()
    ordered = sorted(parts, key=lambda r: (r["file"].rsplit("/", 1)[-1], -r["score"], r["doc_id"]))
    assert [r["doc_id"] for r in ordered] == [1, 2, 3, 4]
    with pytest.raises(Exception, match="(?i)exists"):
        termlode.write_ranking(scores, path)
