import random

import numpy as np
import pytest

from termlode.llm import decontaminate
from termlode.llm.decontaminate import (
    _windows,
    _words,
    canonical,
    leaks,
    template_windows,
    without_leaks,
)

from .conftest import found, sentence

QUESTION = (
    "A train leaves the station with {a} passengers and travels {b} km while the driver {n} counts"
    " {a} wagons. How many wagons does {n} see after {b} km of the whole journey to the coast?"
)


def ask(a, b, n):
    return QUESTION.format(a=a, b=b, n=n)


def test_leaks_verbatim_reworded_and_unrelated(spark):
    rng = random.Random(4)
    around = [sentence(rng, 80) for _ in range(8)]
    items = [(1, ask(12, 300, "Anna")), (2, sentence(rng, 40)), (3, "too short"), (4, None), (5, "")]
    items += [(6, ask(7, 8, "Bob")), (7, sentence(rng, 7))]
    mixed = ask(12, 300, "Anna").replace("12 wagons", "99 wagons")
    documents = [
        (1, f"{around[0]}.\n{ask(12, 300, 'Anna')}\n{around[1]}"),
        (2, f"{around[2]}.\n{ask(45, 17, 'Carol')}\n{around[3]}"),
        (3, f"{around[4]}.\n{mixed.replace('300 km of', '301 km of')}"),
        (4, f"{around[5]} {items[1][1].upper()} {around[6]}"),
        (5, around[7]),
        (6, None),
        (7, ""),
        (8, f"{items[6][1]}"),
        (None, ask(1, 2, "Dora")),
    ]
    schema = "doc_id long, text string, key string, slots string, windows string"
    frame = spark.createDataFrame([(*d, "x", "y", "z") for d in documents], schema)
    bench = spark.createDataFrame([(*i, "q") for i in items], "item_id long, text string, doc_id string")
    got = {(r["doc_id"], r["item_id"]): r for r in leaks(frame, bench).collect()}
    # Items 1 and 6 are one template; the smaller id stands for both.
    assert set(got) == {(1, 1), (2, 1), (4, 2), (8, 7), (None, 1)}
    assert got[1, 1]["n_items"] == 2 and not got[1, 1]["reworded"]
    assert got[2, 1]["reworded"] and got[2, 1]["share"] > 0.9
    kept = without_leaks(frame, bench)
    assert kept.columns == frame.columns
    assert found(kept, "doc_id") == [(3,), (5,), (6,), (7,)]
    assert leaks(frame.where("false"), bench).count() == 0
    assert leaks(frame, bench.where("false")).count() == 0


def test_long_texts_are_read_in_parts(spark, monkeypatch):
    rng = random.Random(6)
    item = sentence(rng, 40)
    long = sentence(rng, 240_000)
    for place in (len(long) // 3, decontaminate.PART_BYTES - 100, len(long) - 10):
        place = long.rindex(" ", 0, place)
        frame = spark.createDataFrame([(1, f"{long[:place]} {item}{long[place:]}")], "doc_id long, text string")
        bench = spark.createDataFrame([(9, item)], "item_id long, text string")
        row = leaks(frame, bench).first()
        assert row["matched"] == row["windows"] == 31


def test_words_and_slots():
    text = "The 3.5 kg of Tea, 1,200 NASA units. Then Émile paid 5 euros"
    starts, _, slot, value = canonical(np.frombuffer(text.encode(), np.uint8))
    raw = text.encode()
    words = [raw[s:].split(b" ")[0].strip(b".,").decode() for s in starts]
    assert words == "The 3.5 kg of Tea 1,200 NASA units Then Émile paid 5 euros".split()
    assert [w for w, s in zip(words, slot, strict=True) if s] == ["3.5", "kg", "Tea", "1,200", "Émile", "5", "euros"]
    upper = canonical(np.frombuffer("ÉCOLE ABC".encode(), np.uint8))[3]
    lower = canonical(np.frombuffer("école abc".encode(), np.uint8))[3]
    assert upper.tolist() == lower.tolist()
    assert len(canonical(np.zeros(0, np.uint8))[0]) == 0 == len(canonical(np.frombuffer(b" .,", np.uint8))[0])


def test_every_item_of_a_template_is_found(spark):
    asked = "Please add {} to the large heap of stones and then add {} to the other heap as well"
    items = [(1, asked.format(5, 3)), (2, asked.format(4, 4)), (3, asked.format(8, 6)), (4, asked.format(8, 6))]
    texts = [asked.format(4, 4), asked.format(8, 6), asked.format(7, 7), asked.format(9, 2)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = found(leaks(frame, bench), "doc_id", "item_id", "reworded", "n_items", "share")
    # Two equal texts are two items; values that nobody asked stand for the smallest id that fits.
    verbatim = [(0, 2, False, 1, 1.0), (1, 3, False, 3, 1.0), (1, 4, False, 3, 1.0)]
    assert got == [*verbatim, (2, 2, True, 1, 1.0), (3, 1, True, 3, 1.0)]
    assert without_leaks(frame, bench).count() == 0


def test_openings_are_words_and_names(spark):
    asked = "{0} has {1} apples. {0} buys {2} more apples. How many apples does {0} have?"
    items = [(1, asked.format("Tom", 5, 3)), (2, "What is the capital of France"), (3, "Is Paris in France or Spain")]
    texts = [asked.format("Anna", 8, 2), "as asked before, What is the capital of France", "it says: Is Paris in France or Spain"]
    texts += ["as asked before, Is Paris in France or Spain", "what is the river of France", "Is Rome in Italy or Spain"]
    bench = spark.createDataFrame(items, "item_id long, text string")
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = found(leaks(frame, bench), "doc_id", "item_id", "reworded", "share")
    pairs = [(0, 1, True), (1, 2, False), (2, 3, False), (3, 3, False), (5, 3, True)]
    assert got == [(*pair, 1.0) for pair in pairs]


def test_long_runs_and_rows_of_one_id(spark):
    rng = random.Random(9)
    long = f"{sentence(rng, 70)} 12 {sentence(rng, 60)} 12 {sentence(rng, 300)}"
    words = long.split()
    items = [(1, long), (2, ask(12, 300, "Anna"))]
    documents = [
        (1, long.replace(" 12 ", " 13 ", 1)),  # one number of two edited
        (2, " ".join(words[200:300])),  # a hundred words of over four hundred
        (3, " ".join(words[200:240])),
        (None, f"{sentence(rng, 9)}. {ask(12, 300, 'Anna')}"),
        (None, f"{sentence(rng, 9)}. {ask(45, 300, 'Anna').replace('300', '12')}"),
        (None, f"{sentence(rng, 9)}. {sentence(rng, 60)}"),
    ]
    bench = spark.createDataFrame(items, "item_id long, text string")
    frame = spark.createDataFrame(documents, "doc_id long, text string")
    got = found(leaks(frame, bench), "doc_id", "item_id", "reworded")
    assert got == [(None, 2, False), (1, 1, False), (2, 1, False)]
    assert found(without_leaks(frame, bench), "text") == sorted([(documents[2][1],), (documents[5][1],)])


NUMBERS = "Evaluate 12 + 34 - 56 + 78 - 90 + 13 - 24 + 35 - 46 + 57 - 68 + 79 now"


def test_items_of_slots_are_found_verbatim(spark):
    """An item that is all numbers has no window of words, but itself."""
    items = spark.createDataFrame([(1, NUMBERS)], "item_id long, text string")
    docs = [(1, f"As before: {NUMBERS}. And so on."), (2, NUMBERS.replace("3", "4"))]
    docs += [(3, "Evaluate 1 + 2 now, and then 3.")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert [(r["doc_id"], r["item_id"]) for r in leaks(frame, items).collect()] == [(1, 1)]


@pytest.mark.parametrize("gap", ["\n", " ", "\t", "; "])
def test_windows_of_long_texts_are_those_of_short_ones(gap):
    rng = random.Random(3)
    words = [rng.choice(["alpha", "Tom", "17", "kg", "beta", "3.5", "é"]) for _ in range(200_000)]
    text = np.frombuffer(gap.join(words).encode(), np.uint8)
    got = {(w, key) for w, _, key, _, loose in template_windows(text, [10], None) if not loose}
    _, *whole = _words(text)
    expected = {(r[0], r[2]) for r in _windows(*whole, [10], None, None, 0) if not r[4]}
    assert got == expected


def test_documents_may_have_any_columns(spark):
    items = spark.createDataFrame([(1, NUMBERS)], "item_id long, text string")
    rows = [(1, NUMBERS, 5, "a"), (2, "Something else altogether.", 6, "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, leaked_id long, leaked_text string")
    assert [tuple(r) for r in without_leaks(docs, items).collect()] == [rows[1]]
