import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from termlode.llm import toxicity
from termlode.llm.common import fold_of, held_out
from termlode.llm.quality import FEATURES, Trees, fit_trees, quality_scores, statistics
from termlode.llm.toxicity import (
    Network,
    Reader,
    fit_network,
    toxicity_scores,
    windows_of,
    without_toxic,
)

from .conftest import found, sentence


def accuracy(scores, labels, label):
    rows = scores.where("held_out").join(labels, "doc_id")
    return rows.agg(F.avg((F.col("predicted") == F.col(label)).cast("int"))).first()[0]


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(8)
    documents, labels = [], []
    for i in range(300):
        words = sentence(rng, rng.randint(20, 150)).split()
        toxic, quality = int(i % 3 == 0), int(i % 4 != 0)
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["zounds", "zoundig", "zounder!"]))
        text = " ".join(words) if quality else " ".join(f"{w}%%" for w in words)
        documents.append((i, text))
        labels.append((i, quality, toxic, "x"))
    labels += [(1000, 1, 1, "x"), (None, 0, 0, None), (0, None, None, None), (1, 7, 7, "x")]
    return (
        spark.createDataFrame(documents, "doc_id long, text string").repartition(3),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int, text string"),
    )


def test_quality_is_learnt(labelled, hard_documents, hard_texts, no_documents):
    documents, labels = labelled
    assert accuracy(quality_scores(documents, labels), labels, "quality") > 0.95
    got = quality_scores(hard_documents, labels)
    assert found(got, "doc_id") == sorted(((i,) for i, _ in hard_texts), key=lambda r: (r[0] is not None, r[0]))
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got.collect())
    assert quality_scores(no_documents, labels).count() == 0
    unlearnt = quality_scores(hard_documents, labels.where("false")).collect()
    assert {r["score"] for r in unlearnt} == {0.5}


def test_trees_in_arrays_equal_single_walks():
    rng = np.random.default_rng(3)
    rows = rng.normal(size=(400, len(FEATURES)))
    labels = (rows[:, 0] + rows[:, 1] * rows[:, 2] > 0).astype(float)
    trees = fit_trees(rows, labels)
    assert isinstance(trees, Trees) and ((trees.score(rows) > 0.5) == labels).mean() > 0.95

    def walk(row):
        total = trees.base
        for feature, threshold, leaf in zip(trees.feature, trees.threshold, trees.leaf, strict=True):
            node = 0
            while node < len(feature):
                node = 2 * node + (2 if row[feature[node]] > threshold[node] else 1)
            total += leaf[node - len(feature)]
        return 1 / (1 + np.exp(-total))

    assert trees.score(rows[:50]) == pytest.approx([walk(r) for r in rows[:50]])
    assert fit_trees(rows[:3], np.ones(3)).score(rows[:2]).tolist() == pytest.approx([3.5 / 4] * 2)


def test_statistics_of_odd_texts():
    assert statistics("") == statistics(" \n") == [0.0] * len(FEATURES)
    assert all(np.isfinite(statistics(t)).all() for t in ("x", "é" * 9, "a " * 50_000, "|\n|"))


def test_toxicity_is_learnt(labelled, hard_documents, hard_texts, no_documents, monkeypatch):
    monkeypatch.setattr(toxicity, "UPDATES", 25)
    documents, labels = labelled
    scores = toxicity_scores(documents, labels)
    assert accuracy(scores, labels, "toxic") > 0.9
    scored = toxicity_scores(hard_documents, labels)
    assert scored.count() == len(hard_texts)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in scored.collect())
    kept = without_toxic(hard_documents, labels)
    assert kept.columns == hard_documents.columns
    assert kept.count() == scored.where("predicted = 0").count()
    assert without_toxic(no_documents, labels).count() == 0
    unlearnt = toxicity_scores(hard_documents, labels.where("false")).collect()
    assert {r["score"] for r in unlearnt} == {0.5}


def test_gradients_equal_differences():
    rng = np.random.default_rng(0)
    network = Network.fresh()
    w = network.weights = {k: v.astype(float) for k, v in network.weights.items()}
    inputs, places = rng.normal(size=(20, toxicity.SIZE)), rng.integers(0, 20, (5, 7))
    mask = np.ones((5, 7))
    mask[1, 4:] = 0
    labels = np.array([1.0, 0, 1, 0, 0])

    def gates():
        return np.hstack([inputs @ w[f"{way}_in"] + w[f"{way}_0"] for way in ("forth", "back")])

    def loss():
        chance = 1 / (1 + np.exp(-network.read(gates(), places, mask)))
        return -np.mean(labels * np.log(chance) + (1 - labels) * np.log(1 - chance))

    slopes, by_input, _ = network.gradients(gates(), inputs, places, mask, labels)
    for name, slope in [*slopes.items(), (None, by_input)]:
        values = inputs if name is None else w[name]
        at = tuple(rng.integers(0, s) for s in values.shape)
        was = values[at]
        values[at] = was + 0.01
        more = loss()
        values[at] = was - 0.01
        assert (more - loss()) / 0.02 == pytest.approx(slope[at], abs=2e-5)
        values[at] = was


def test_windows_cover_all_words_and_batches_do_not_matter():
    text, first, length = windows_of(np.array([0, 1, 64, 65, 300]))
    for k, (count, start) in enumerate(zip([0, 1, 64, 65, 300], [0, 0, 1, 65, 130], strict=True)):
        covered = {i - start for f, n in zip(first[text == k], length[text == k], strict=True) for i in range(f, f + n)}
        assert covered == set(range(count))
    texts = ["a b c", "", sentence(random.Random(1), 200)]
    network = fit_network([], [])
    network.scale = np.array([1.0, 0.3, 0.1])
    together = Reader(network).scores(texts)
    assert together == pytest.approx([Reader(network).scores([t])[0] for t in texts], rel=1e-5)


def test_folds_agree(spark):
    ids = spark.range(50).select(F.col("id").alias("doc_id"))
    rows = ids.select("doc_id", held_out().alias("h")).collect()
    assert all(r["h"] == (fold_of(r["doc_id"]) == 1) for r in rows)
