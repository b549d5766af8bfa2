import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from termlode.llm import repeats
from termlode.llm.queries import op4_repeats
from termlode.llm.repeats import remove_repeats, without_repeats
from termlode.llm.suffix_sort import blind_trie, sort_suffixes

from .conftest import found


def brute(texts, length):
    counts = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    result = []
    for text in texts:
        covered = [False] * len(text)
        for i in range(len(text) - length + 1):
            if counts[text[i : i + length]] > 1:
                covered[i : i + length] = [True] * length
        kept = bytes(c for c, gone in zip(text, covered, strict=True) if not gone)
        runs = sum(gone and not before for gone, before in zip(covered, [False, *covered], strict=False))
        result.append((len(text), runs, kept))
    return sorted(result)


def compare(spark, texts, **sizes):
    rows = [(i, t.decode()) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = found(remove_repeats(frame, **sizes), "n_bytes", "spans", "kept")
    assert sorted((n, len(s), bytes(k)) for n, s, k in got) == brute(texts, sizes["length"])


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    passages = ["".join(rng.choices("ab c", k=rng.randint(10, 90))) for _ in range(8)]
    texts = []
    for _ in range(60):
        parts = [
            rng.choice(passages) if rng.random() < 0.4 else "".join(rng.choices("xyzw", k=rng.randint(0, 40)))
            for _ in range(rng.randint(0, 6))
        ]
        texts.append("".join(parts).encode())
    texts += [b"", b"q" * 70, texts[5], b"ab" * 60, "é".encode() * 30]
    compare(spark, texts, length=24, anchor=8, cell=4)


def test_long_texts_are_cut_without_loss(spark, monkeypatch):
    rng = random.Random(5)
    passage = "".join(rng.choices("abcdef", k=700))
    text = "".join(rng.choices("abcdef", k=150_000))
    texts = [text[:131_000] + passage + text[131_000:], "x" + passage[30:650] + "y", "z" * 500]
    rows = list(enumerate(texts))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = dict((row[0], row[1]) for row in found(remove_repeats(frame), "doc_id", "spans"))
    assert [tuple(s) for s in got[0]] == [(131_030, 131_650)]
    assert [tuple(s) for s in got[1]] == [(1, 621)]
    # "zzz" also starts one byte later.
    assert [tuple(s) for s in got[2]] == [(0, 500)]


def test_query_goes_by_bytes_not_by_words(spark, tmp_path):
    """Passages of 60 words that stand in three documents each: 400 bytes are removed, 399 are not."""
    rng = random.Random(7)
    texts, gone = [], []
    for size in (330, 399, 400, 600):
        letters = size - 59
        lengths = [letters // 60] * 59 + [letters - letters // 60 * 59]
        passage = " ".join("".join(rng.choices("abcdefghij", k=n)) for n in lengths)
        assert len(passage) == size and len(passage.split()) == 60
        for copy in "123":
            # Every neighbour of a passage differs, so that only the passage repeats.
            before, after = ("".join(rng.choices("vwxyz", k=300)) for _ in range(2))
            texts.append(before + copy + passage + copy + after)
            gone.append((301, size if size >= 400 else 0))
    texts += ["", None, "clean " * 3]
    gone += [(0, 0)] * 3
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    frame.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    expected = []
    for i, (text, (at, n)) in enumerate(zip(texts, gone, strict=True)):
        raw = (text or "").encode()
        kept = hashlib.sha256(raw[:at] + raw[at + n :]).hexdigest()
        expected.append((i, len(raw), n, int(n > 0), kept))
    columns = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert found(op4_repeats(spark, str(tmp_path)), *columns) == expected


def test_hard_documents(hard_documents, hard_texts, no_documents):
    texts = [(t or "").encode() for _, t in hard_texts]
    got = found(remove_repeats(hard_documents, 40, 12, 4), "doc_id", "n_bytes", "spans", "kept")
    assert sorted((n, len(s), bytes(k)) for _, n, s, k in got) == brute(texts, 40)
    kept = without_repeats(hard_documents, 40, 12, 4)
    assert kept.columns == hard_documents.columns and kept.schema["n_chars"].dataType.simpleString() == "bigint"
    assert kept.count() == len(texts)
    assert all(row["n_chars"] == len(row["text"]) for row in kept.collect())
    assert remove_repeats(no_documents).count() == without_repeats(no_documents).count() == 0


def test_suffixes_are_sorted_and_grouped():
    rng = random.Random(2)
    text = np.frombuffer("".join(rng.choices("ab", k=4000)).encode(), np.uint8)
    text = np.concatenate([text, text[1000:1600], text[1000:1600]])
    raw, depth = text.tobytes(), 96
    starts = np.arange(0, len(text) - depth, 3)
    for shallow in (0, 8, 64):
        classes = sort_suffixes(text, starts, depth, shallow)
        strings = [raw[c[0] : c[0] + depth] for c in classes]
        assert strings == sorted(strings) and len(set(strings)) == len(strings)
        assert sorted(s for c in classes for s in c) == starts.tolist()
        assert all(raw[s : s + depth] == raw[c[0] : c[0] + depth] for c in classes for s in c)
    assert len(blind_trie(text, raw, [4000, 4600, 1000], 0, 600)) == 1


def test_sliding_minimum():
    values = np.random.default_rng(1).integers(0, 50, 200).astype(np.uint64)
    for width in (1, 7, 64, 200):
        expected = [values[i : i + width].min() for i in range(len(values) - width + 1)]
        assert repeats._sliding_minimum(values, width).tolist() == expected
