"""Word vectors against a plain factorisation of the same weights."""

import math
import random
import re
import time
from pathlib import Path

import brute
import numpy as np
import pytest

import termlode
from termlode.plans import vectors as plans

SUBJECTS = {
    "sea": "sail harbour anchor tide gull wave",
    "hill": "peak ridge summit slope cliff scree",
    "oven": "bread flour yeast dough crust loaf",
}


@pytest.fixture(scope="module")
def docs():
    rng = random.Random(8)
    rows = []
    for i in range(60):
        words = list(SUBJECTS.values())[i % 3].split()
        rows.append((i, " ".join([*rng.choices(words, k=6), *rng.choices(["the", "of", "and"], k=4)])))
    return [*rows, (98, ""), (99, "once")]


@pytest.fixture(scope="module")
def small(make_corpus, docs, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("vectors") / "index")
    return termlode.write_index(make_corpus(docs), root, shards=2)


@pytest.fixture(scope="module")
def found(small):
    return plans.settle(plans.term_vectors(small, dimensions=21))


def plain(docs):
    counts, df = brute._tables(docs)
    terms = sorted(t for t in df if df[t] >= 2)
    table = np.zeros((len(terms), len(docs)))
    for j, (doc_id, _) in enumerate(docs):
        length = sum(counts[doc_id].values())
        for i, term in enumerate(terms):
            if counts[doc_id][term]:
                idf = math.log((len(docs) - df[term] + 0.5) / (df[term] + 0.5) + 1)
                table[i, j] = (math.log(counts[doc_id][term]) + 1) * idf / math.sqrt(length)
    return terms, table


def test_products_equal_those_of_the_weights(found, docs):
    rows = {r["term"]: np.array(r["vector"]) for r in found.collect()}
    terms, table = plain(docs)
    assert sorted(rows) == terms and "once" not in rows
    ours = np.array([rows[t] for t in terms])
    assert np.allclose(ours @ ours.T, table @ table.T, atol=1e-8)


def test_few_dimensions_come_near_the_best(small, docs):
    rows = {r["term"]: np.array(r["vector"]) for r in plans.term_vectors(small, 4).collect()}
    terms, table = plain(docs)
    energy = np.sort(np.linalg.svd(table, compute_uv=False) ** 2)[::-1]
    assert {len(v) for v in rows.values()} == {4}
    kept = sum(float(v @ v) for v in rows.values())
    assert 0.97 * energy[:4].sum() <= kept <= energy[:4].sum() * (1 + 1e-9)


def test_similar_terms_equal_loops(found, docs):
    terms, table = plain(docs)
    units = table / np.linalg.norm(table, axis=1, keepdims=True)
    rows = plans.similar_terms(found, "sail, bread! unheard", 4).collect()
    for asked in ("sail", "bread"):
        cosines = units @ units[terms.index(asked)]
        expected = sorted(
            ((-round(float(c), 6), t) for c, t in zip(cosines, terms, strict=True) if t != asked)
        )[:4]
        got = [(-round(r["similarity"], 6), r["term"]) for r in rows if r["asked"] == asked]
        assert sorted(got) == expected
    assert {r["asked"] for r in rows} == {"sail", "bread"}
    assert plans.similar_terms(found, "unheard", 3).count() == 0


def test_expanded_search_equals_loops(small, found, docs):
    near = plans.similar_terms(found, "sail", 3).collect()
    counts, df = brute._tables(docs)
    weights = {r["term"]: r["similarity"] for r in near if r["similarity"] >= 0.05} | {"sail": 1.0}
    scores = dict.fromkeys(counts, 0.0)
    for term, share in weights.items():
        for doc_id, score in brute.bm25(docs, term).items():
            scores[doc_id] += share * score
    expected = [x for x in brute.top(scores, 30) if x[2]]
    rows = plans.expanded_search(small, found, "sail", 30, 3, 0.05).orderBy("rank").collect()
    assert [(r["rank"], r["doc_id"]) for r in rows] == [x[:2] for x in expected]
    assert [r["score"] for r in rows] == pytest.approx([x[2] for x in expected])
    assert len(weights) > 1


def test_an_empty_index_has_no_vectors(make_corpus, tmp_path):
    empty = termlode.write_index(make_corpus([]), str(tmp_path / "none"), shards=1)
    assert plans.term_vectors(empty).count() == 0
    with pytest.raises(ValueError, match="dimensions"):
        plans.term_vectors(empty, 65)


def test_no_posting_meets_its_frequency_and_vectors_are_turned_once(small):
    rows = plans._weighted(small)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in rows and "Exchange" not in rows
    text = plans.term_vectors(small, 4, 1)._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("zip_with") == 1


def products(vectors):
    rows = {r["term"]: np.array(r["vector"]) for r in vectors.collect()}
    ours = np.array([rows[t] for t in sorted(rows)])
    return sorted(rows), ours @ ours.T


@pytest.mark.parametrize("postings", [40, 10**7])
def test_parts_of_any_size_give_the_same(make_corpus, docs, tmp_path, monkeypatch, postings):
    terms, table = plain(docs)
    monkeypatch.setattr(plans, "PART_POSTINGS", postings)
    monkeypatch.setattr(plans, "TASKS_PER_CORE", 1)
    index = termlode.write_index(make_corpus(docs), str(tmp_path / "index"), shards=6)
    parts, _ = plans._shape(index)
    n = index.stats.first()["n_postings"]
    assert -(-n // parts) <= postings and (parts % 6 == 0 or parts == 4)
    got, ours = products(plans.term_vectors(index, 21))
    assert got == terms and np.allclose(ours, table @ table.T, atol=1e-8)


def test_an_index_that_is_not_stored_gives_the_same(make_corpus, docs):
    terms, table = plain(docs)
    got, ours = products(plans.term_vectors(termlode.build_index(make_corpus(docs)), 21))
    assert got == terms and np.allclose(ours, table @ table.T, atol=1e-8)


def test_neither_postings_nor_sums_of_documents_cross_the_network(small, monkeypatch):
    written = []

    def noted(frame, root, part, shards, order, key="doc_id"):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        written.append((frame.columns, re.sub(r"#\d+L?", "", plan)))
        write(frame, root, part, shards, order, key)

    write = plans.write_bucketed
    monkeypatch.setattr(plans, "write_bucketed", noted)
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    with plans.settings(small.postings.sparkSession, {threshold: "-1"}):
        plans.term_vectors(small, 4, 1)
    places = [plan for columns, plan in written if columns == ["part", "doc_id", "z"]]
    sums = [plan for columns, plan in written if columns == ["term", "df", "y"]]
    assert len(places) == 2 and len(sums) == 4
    for plan in places:
        # Terms go to their parts once, with the sums that are in a table by term already.
        assert re.findall(r"Exchange hashpartitioning\((\w+), ", plan) == ["part"]
        exchanged = plan[plan.index("Exchange hashpartitioning(part") :]
        assert "weight" not in exchanged and "doc_id" not in exchanged
    for plan in sums:
        below = re.findall(r"Exchange hashpartitioning\((\w+), ", plan)
        assert set(below) <= {"term"} and len(below) <= 1
        assert not below or plan.index("partial_count") > plan.index("Exchange hash")


def shuffled(spark, but=None):
    """Shuffle files on disk; Spark deletes them in the background."""
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    for _ in range(100):
        names = disk.getAllFiles().mkString(" ").split()
        found = {name for name in names if "/shuffle_" in name}
        if but is None or found <= but:
            break
        time.sleep(0.1)
    return found


def test_nothing_is_left_but_the_vectors(spark, small, tmp_path):
    folder = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    before, kept = shuffled(spark), set(folder.rglob("*"))
    names, settings = {t.name for t in spark.catalog.listTables()}, spark.conf.getAll
    termlode.write_vectors(small, str(tmp_path / "vectors"), 4, 1)
    assert shuffled(spark, before) <= before
    assert {path for path in folder.rglob("*") if path.is_file()} <= kept
    assert {t.name for t in spark.catalog.listTables()} <= names
    assert spark.conf.getAll == settings


def test_expanded_search_of_a_growing_index_leaves_no_shuffled_vectors(
    spark, make_corpus, docs, small, found, tmp_path, monkeypatch
):
    monkeypatch.setattr(plans, "PART_POSTINGS", 100)
    root = str(tmp_path / "grown")
    termlode.append_documents(make_corpus(docs[:30]), root, 2)
    termlode.append_documents(make_corpus(docs[30:]), root, 2)
    index = termlode.load_segments(spark, root)
    before = shuffled(spark)
    vectors = termlode.write_vectors(index, str(tmp_path / "vectors"), 21)
    assert shuffled(spark, before) <= before
    got = termlode.expanded_search(index, vectors, "sail", 30, 3, 0.05).orderBy("rank").collect()
    expected = termlode.expanded_search(small, found, "sail", 30, 3, 0.05).orderBy("rank").collect()
    assert [r["doc_id"] for r in got] == [r["doc_id"] for r in expected] and got
    assert [r["score"] for r in got] == pytest.approx([r["score"] for r in expected])
