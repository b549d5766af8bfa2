"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics are computed once per document, in numpy, and stored; labels join these small
rows, never the texts. The trees are grown on a bounded sample of labelled rows and
flattened into arrays, level by level, so that all rows of a batch walk down together.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termlode.llm.common import held_out, stored, text_slices, to_tasks

# At most so many labelled rows are used for fitting, those with the smallest hash of id.
SAMPLE_ROWS = 20_000
TREES, DEPTH, BINS, RATE = 60, 4, 64, 0.2
LEAST_ROWS, RIDGE = 5, 1.0

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LOWER = np.zeros(256, bool)
_LOWER[97:123] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#$%&*+/<=>@[\\]^_`{|}~")] = True
_MARK = np.zeros(256, bool)
_MARK[list(b"!?.,;:'\"()-")] = True

FEATURES = [
    "log_bytes", "log_words", "word_length", "upper", "digits", "symbols", "marks",
    "exclaims", "bars", "beyond_ascii", "words_ending_in_symbol", "distinct_words",
    "top_word", "repeated_neighbours", "distinct_lines", "top_line", "line_words",
    "distinct_pairs", "longest_word", "ends_with_stop",
]


def statistics(text: str) -> list[float]:
    """Statistics of a whole text; all zero for an empty one."""
    raw = text.encode()
    words = raw.split()
    if not words:
        return [0.0] * len(FEATURES)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    n, w = len(raw), len(words)
    letters = max(1, counts[_UPPER].sum() + counts[_LOWER].sum())
    lines = [line for line in raw.split(b"\n") if line.strip()]
    by_word, by_line = Counter(words), Counter(lines)
    neighbours = Counter(zip(words, words[1:], strict=False))
    ending = sum(c for x, c in by_word.items() if _SYMBOL[x[-1]] or x[-1] == 33)
    return [
        float(np.log1p(n)),
        float(np.log1p(w)),
        sum(map(len, words)) / w,
        counts[_UPPER].sum() / letters,
        counts[_DIGIT].sum() / n,
        counts[_SYMBOL].sum() / n,
        counts[_MARK].sum() / n,
        counts[33] / n,
        counts[124] / n,
        counts[128:].sum() / n,
        ending / w,
        len(by_word) / w,
        max(by_word.values()) / w,
        sum(c for (a, b), c in neighbours.items() if a == b) / w,
        len(by_line) / len(lines),
        max(by_line.values()) / len(lines),
        w / len(lines),
        len(neighbours) / max(1, w - 1),
        max(map(len, by_word)),
        sum(line.rstrip()[-1:] in (b".", b"?", b"!") for line in lines) / len(lines),
    ]


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in text_slices(batches):
        rows = pa.array([statistics(t) for t in texts], pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), rows], ["doc_id", "statistics"])


@dataclass(frozen=True)
class Trees:
    """All trees as arrays of (tree, node); node i has its children at 2i + 1 and 2i + 2."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray

    def score(self, rows: np.ndarray) -> np.ndarray:
        total = np.full(len(rows), self.base)
        at = np.arange(len(rows))
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf, strict=True):
            node = np.zeros(len(rows), int)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (rows[at, feature[node]] > threshold[node])
            total += leaf[node - (2**DEPTH - 1)]
        return 1 / (1 + np.exp(-np.clip(total, -40, 40)))


def _bins(rows: np.ndarray) -> list[np.ndarray]:
    shares = np.linspace(0, 1, BINS + 1)[1:-1]
    return [np.unique(np.quantile(column, shares)) for column in rows.T]


def fit_trees(rows: np.ndarray, labels: np.ndarray) -> Trees:
    """Boosted trees for logistic loss; the share of ones where there is nothing to learn."""
    nodes, leaves = 2**DEPTH - 1, 2**DEPTH
    ones = float(labels.sum())
    base = float(np.log((ones + 0.5) / (len(labels) - ones + 0.5)))
    trees = 0 if ones in (0.0, float(len(labels))) else TREES
    feature = np.zeros((trees, nodes), int)
    threshold = np.full((trees, nodes), np.inf)
    leaf = np.zeros((trees, leaves))
    if not trees:
        return Trees(base, feature, threshold, leaf)
    cuts = _bins(rows)
    binned = np.stack([np.searchsorted(c, x) for c, x in zip(cuts, rows.T, strict=True)], axis=1)
    total = np.full(len(rows), base)
    for tree in range(trees):
        chance = 1 / (1 + np.exp(-total))
        gradient, weight = labels - chance, chance * (1 - chance)
        node = np.zeros(len(rows), int)
        for level in range(DEPTH):
            first, width = 2**level - 1, 2**level
            best_gain = np.full(width, 1e-6)
            for f, cut in enumerate(cuts):
                if not len(cut):
                    continue
                key = (node - first) * BINS + binned[:, f]
                size = width * BINS
                g, h, c = (
                    np.bincount(key, x, size).reshape(width, BINS).cumsum(axis=1)
                    for x in (gradient, weight, np.ones(len(rows)))
                )
                G, H, C = g[:, -1:], h[:, -1:], c[:, -1:]
                gain = g**2 / (h + RIDGE) + (G - g) ** 2 / (H - h + RIDGE) - G**2 / (H + RIDGE)
                gain[(c < LEAST_ROWS) | (C - c < LEAST_ROWS)] = 0
                gain = gain[:, : len(cut)]
                place = gain.argmax(axis=1)
                better = gain[np.arange(width), place] > best_gain
                best_gain = np.where(better, gain[np.arange(width), place], best_gain)
                at = first + np.nonzero(better)[0]
                feature[tree, at] = f
                threshold[tree, at] = cut[place[better]]
            right = rows[np.arange(len(rows)), feature[tree, node]] > threshold[tree, node]
            node = 2 * node + 1 + right
        last = node - nodes
        g, h = np.bincount(last, gradient, leaves), np.bincount(last, weight, leaves)
        leaf[tree] = RATE * g / (h + RIDGE)
        total += leaf[tree, last]
    return Trees(base, feature, threshold, leaf)


def labelled_sample(
    measured: DataFrame, labels: DataFrame, label: str, rows: int = SAMPLE_ROWS
) -> tuple[np.ndarray, np.ndarray]:
    """Statistics and labels of a bounded sample; rows without a label of 0 or 1 don't count."""
    known = labels.where(F.col(label).isin(0, 1) & ~held_out()).select("doc_id", label)
    # About twice as many as wanted by hash, so that few rows are sorted.
    share = min(1.0, 2 * rows / max(1, known.count()))
    low = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share * (1 << 20)
    sample = (
        measured.join(known.where(low), "doc_id")
        .orderBy(F.xxhash64("doc_id"), "doc_id", label)
        .limit(rows)
        .select("statistics", label)
        .collect()
    )
    matrix = np.array([r["statistics"] for r in sample], float).reshape(-1, len(FEATURES))
    return matrix, np.array([r[label] for r in sample], float)


def quality_scores(
    documents: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
    threshold: float = 0.5,
) -> DataFrame:
    """doc_id, held_out, score, predicted for every document (doc_id, text).

    Fitted on at most ``sample_rows`` labelled rows outside the held-out fold. A null text
    is empty and is scored like any other; without labels every score is 0.5. Repeated
    rows give a row each.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    measured = stored(
        to_tasks(rows, _measure, "doc_id long, statistics array<double>"), "statistics"
    )
    trees = fit_trees(*labelled_sample(measured, labels, label, sample_rows))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = np.asarray(batch.column("statistics").flatten(), float)
            scores = trees.score(flat.reshape(batch.num_rows, len(FEATURES)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores)], ["doc_id", "score"]
            )

    scored = to_tasks(measured, score, "doc_id long, score double")
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
