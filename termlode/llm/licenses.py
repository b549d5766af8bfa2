"""License notices: phrases, and an exact set-similarity join with notice templates.

A text is cut into blocks (lines; a long line into overlapping windows). A block meets a
template if it holds at least ``threshold`` of the template's distinct words. The words
of the templates are ordered by the number of documents that hold them, rarest first,
counted over the whole corpus. By that order

- prefix filter: a block that meets a template of n words holds one of its n - need + 1
  rarest words, need being the words it must share;
- length filter: it has at least ``need`` words that stand in templates;
- positional filter: from the place of the first shared word in both orders, what is left
  must still suffice.

Only blocks that pass are compared in full. The templates are a parameter, so their index
of rare words goes to every task; no text is moved.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from math import ceil

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termlode.llm.common import text_slices, to_tasks

# Phrases and the labels they stand for.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
TEMPLATES = {
    "notice-gpl-3": "This work is licensed under the GNU General Public License, version 3",
    "notice-gpl-later": "either version 3 of the License, or (at your option) any later version",
    "notice-apache-2": "Licensed under the Apache License, Version 2.0",
    "notice-mit": "Released under the MIT License",
    "notice-cc-by-nc-4": "Licensed under CC BY-NC 4.0",
    "notice-cc-by-4": "licensed under a Creative Commons Attribution 4.0 International License",
    "notice-as-is": "the software is provided as is, without warranty of any kind",
    "notice-all-rights": "All rights reserved",
}
THRESHOLD = 0.8
BLOCK_WORDS = 256

# Bytes that aren't part of a word become blanks, A-Z become a-z.
_WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
    for c in range(256)
)

SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long,"
    " base_labels string, labels string, score double, blocks long"
)


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(_WORDS).split()


def blocks_of(text: str) -> Iterator[set[bytes]]:
    """The distinct words of every block: lines, cut into half-overlapping windows."""
    for line in text.split("\n"):
        words = words_of(line)
        last = max(0, len(words) - BLOCK_WORDS)
        step = BLOCK_WORDS // 2
        for start in range(0, last + step if last else 1, step):
            yield set(words[start : start + BLOCK_WORDS])


def phrase_places(words: list[bytes], phrases: dict[str, str]) -> list[tuple[int, str]]:
    """Word index and label of every place where a phrase's words stand consecutively."""
    line = b" " + b" ".join(words) + b" "
    found = []
    for phrase, label in phrases.items():
        pattern = b" " + phrase.encode() + b" "
        at = line.find(pattern)
        index, counted = 0, 0
        while at >= 0:
            index += line.count(b" ", counted, at)
            counted = at
            found.append((index, label))
            at = line.find(pattern, at + 1)
    return found


class _Index:
    """Templates by their rare words."""

    def __init__(self, templates: dict[str, str], frequency: dict[bytes, int], threshold: float):
        self.sets = {label: set(words_of(text)) for label, text in templates.items()}
        vocabulary = set().union(*self.sets.values()) if self.sets else set()
        ordered = sorted(vocabulary, key=lambda w: (frequency.get(w, 0), w))
        self.rank = {w: i for i, w in enumerate(ordered)}
        self.need = {x: max(1, ceil(threshold * len(s) - 1e-9)) for x, s in self.sets.items()}
        self.by_word: dict[bytes, list[tuple[str, int]]] = {}
        for label, words in self.sets.items():
            rare = sorted(words, key=self.rank.__getitem__)
            for place, word in enumerate(rare[: len(words) - self.need[label] + 1]):
                self.by_word.setdefault(word, []).append((label, place))
        self.rare = frozenset(self.by_word)

    def matches(self, block: set[bytes]) -> dict[str, float]:
        """Template labels that the block meets, with the share of their words."""
        known = sorted((w for w in block if w in self.rank), key=self.rank.__getitem__)
        found, seen = {}, set()
        for here, word in enumerate(known):
            for label, place in self.by_word.get(word, ()):
                if label in seen:
                    continue
                # The first shared word: what follows it on either side must suffice.
                seen.add(label)
                need, size = self.need[label], len(self.sets[label])
                if min(size - place, len(known) - here) < need:
                    continue
                shared = len(self.sets[label].intersection(block))
                if shared >= need:
                    found[label] = shared / size
        return found


def _count(vocabulary: frozenset[bytes]):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for _, texts in text_slices(batches):
            for text in texts:
                counts.update(vocabulary.intersection(words_of(text)))
        words = [w.decode() for w in counts]
        yield pa.RecordBatch.from_arrays(
            [pa.array(words, pa.string()), pa.array(list(counts.values()), pa.int64())],
            ["word", "n"],
        )

    return count


def word_frequencies(documents: DataFrame, templates: dict[str, str]) -> dict[bytes, int]:
    """In how many documents each word of the templates stands; one row per word."""
    vocabulary = frozenset().union(*(words_of(t) for t in templates.values()))
    counted = to_tasks(documents.select("text"), _count(vocabulary), "word string, n long")
    rows = counted.groupBy("word").agg(F.sum("n").alias("n")).collect()
    return {row["word"].encode(): row["n"] for row in rows}


def _scan(index: _Index, phrases: dict[str, str]):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in SCHEMA.split(", ")]
        for batch, texts in text_slices(batches):
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts, strict=True):
                words = words_of(text)
                places = phrase_places(words, phrases)
                met: dict[str, float] = {}
                hit_blocks = 0
                if not index.rare.isdisjoint(words):
                    for block in blocks_of(text):
                        got = index.matches(block)
                        hit_blocks += bool(got)
                        for label, share in got.items():
                            met[label] = max(met.get(label, 0.0), share)
                base = {label for _, label in places}
                starts = [start for start, _ in places]
                rows.append(
                    (
                        doc_id,
                        len(words),
                        len(places),
                        min(starts, default=None),
                        max(starts, default=None),
                        ",".join(sorted(base)),
                        ",".join(sorted(base | set(met))),
                        1.0 if base else max(met.values(), default=0.0),
                        hit_blocks,
                    )
                )
            types = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.float64(), pa.int64()]
            columns = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names
            )

    return scan


def license_scan(
    documents: DataFrame,
    templates: dict[str, str] | None = None,
    phrases: dict[str, str] | None = None,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per document (doc_id, text): words, phrase places and labels.

    A null text is empty: no words, no labels, score 0. The score is 1 where a phrase
    stands, else the largest share of a template that a block holds; ``blocks`` counts
    the blocks that meet a template. Repeated rows give a row each; further columns are
    ignored.
    """
    templates = TEMPLATES if templates is None else templates
    phrases = PHRASES if phrases is None else phrases
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    index = _Index(templates, word_frequencies(rows, templates), threshold)
    return to_tasks(rows, _scan(index, phrases), SCHEMA)
