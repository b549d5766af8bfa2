from collections import defaultdict
from functools import lru_cache

import numpy as np
import pytest
from pyspark.sql import functions as F

from termlode.llm.packing import Schedule, pack, token_ids, vocabulary_path

public = pytest.importorskip("public_tokenizers")


@lru_cache
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary_path("byte_bpe_50k.json"))


def plain_ids(text):
    return tokenizer().encode(text or "", add_special_tokens=False).ids


def check(pieces, texts, window):
    expected = sorted([*plain_ids(t), 1] for t in texts)
    by_place = sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"]))
    lengths = defaultdict(int)
    for p in by_place:
        assert p["length"] > 0 and p["offset"] == lengths[p["sequence_id"]]
        lengths[p["sequence_id"]] += p["length"]
        assert len(p["ids"]) == 4 * p["length"]
    assert sorted(lengths) == list(range(len(lengths)))
    sizes = [lengths[k] for k in sorted(lengths)]
    full = sum(map(len, expected)) // window
    assert sizes[:full] == [window] * full
    assert all(s & (s - 1) == 0 for s in sizes[full:])
    return expected


def test_every_token_lies_in_one_piece(hard_documents, hard_texts, no_documents):
    pieces = pack(hard_documents, window=64).collect()
    expected = check(pieces, [t for _, t in hard_texts], 64)
    unique = [(i, t) for i, t in hard_texts if i is not None and i not in (3, 5)]
    for i, text in unique:
        own = sorted((p for p in pieces if p["doc_id"] == i), key=lambda p: p["start"])
        ids = np.frombuffer(b"".join(p["ids"] for p in own), "<u4").tolist()
        assert ids == [*plain_ids(text), 1]
        assert [p["start"] for p in own] == np.cumsum([0, *[p["length"] for p in own]])[:-1].tolist()
        assert {p["doc_tokens"] for p in own} == {len(ids)}
    assert sum(p["length"] for p in pieces) == sum(map(len, expected))
    assert pack(no_documents).count() == 0


def test_windows_keep_the_mixture(spark):
    rows = [(i, "word " * (30 + i % 50), "ab"[i % 3 == 0]) for i in range(600)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    pieces = pack(frame, window=256)
    shares = pieces.groupBy("sequence_id").pivot("queue").agg(F.sum("length")).orderBy("sequence_id")
    table = np.array([[r[1], r[2]] for r in shares.collect()][:-9], float)
    total = np.array([r[0] for r in pieces.groupBy("queue").agg(F.sum("length")).orderBy("queue").select("sum(length)").collect()])
    drift = np.cumsum(table - 256 * total / total.sum(), axis=0)
    assert np.abs(drift).max() <= 1
    check(pieces.collect(), [t for _, t, _ in rows], 256)


def test_given_shares_hold_until_a_queue_is_empty():
    schedule = Schedule([1000, 3000, 500], [1.0, 1.0, 0.0], 100)
    counts = schedule.before(np.arange(schedule.windows + 1))
    assert (np.diff(counts, axis=0) >= 0).all() and counts[-1].tolist() == [1000, 3000, 500]
    assert counts.sum(axis=1).tolist() == schedule.bounds(np.arange(schedule.windows + 1)).tolist()
    assert counts[10].tolist() == [500, 500, 0] and counts[40].tolist() == [1000, 3000, 0]


@pytest.mark.parametrize("totals", [[7], [5, 5, 5], [1, 10_000, 37, 2], [0, 9, 0]])
def test_pieces_tile_all_queues(totals):
    schedule = Schedule(totals, None, 16)
    seen = defaultdict(list)
    for queue, total in enumerate(totals):
        if not total:
            continue
        cuts = sorted({0, total, total // 3, total // 2})
        at = np.array(cuts[:-1], int)
        counts = np.diff(cuts)
        found = schedule.pieces(np.full(len(at), queue), at, counts)
        for doc, start, length, window, offset in zip(*map(np.ndarray.tolist, found), strict=True):
            seen[window].append((offset, length))
            assert start + length <= counts[doc]
    sizes = np.diff(schedule.bounds(np.arange(schedule.windows + 1)))
    for window, size in enumerate(sizes.tolist()):
        place = 0
        for offset, length in sorted(seen[window]):
            assert offset == place
            place += length
        assert place == size


def test_the_fast_coder_agrees_with_the_tokenizer():
    rng = np.random.default_rng(4)
    vocabulary = vocabulary_path("byte_bpe_50k.json")
    ranks = vocabulary_path("byte_bpe_50k.tiktoken")
    common = "the and's 12 don't  \n\t-- é \xa0\x85\x1c\xad".split(" ") + [" ", "  ", "\n"]
    for _ in range(300):
        text = "".join(rng.choice(common, 12)) + "".join(map(chr, rng.integers(0, 256, 12)))
        assert token_ids(text, vocabulary, ranks) == plain_ids(text)
    for text in ("a <|endoftext|> b", "漢字 и é", ""):
        assert token_ids(text, vocabulary, ranks) == plain_ids(text)
