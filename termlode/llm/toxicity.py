"""Toxicity: a bidirectional gated recurrent network with attention pooling, in numpy.

A word enters as the sum of an embedding of its letters as a whole and the embeddings of
its character trigrams. Windows of words overlap; each is read in both
directions, pooled by attention and given one logit. A text's score is a logistic function
of its highest logit and of the sum of its windows' chances.

Labels are of texts, so training is by multiple instances: of a toxic text, the window
with the highest logit so far counts as toxic; windows of other texts never do. Fitted on a
bounded sample of labelled rows in the driver; every whole text is scored in the tasks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from termlode.llm.common import appended, fresh_name, held_out, text_slices, to_tasks

WORDS, STEP = 64, 48
WORD_ROWS, TRIGRAM_ROWS = 1 << 16, 1 << 16
SIZE, HIDDEN, ATTENTION = 8, 8, 8
# The sample: labelled rows of either kind, with the smallest hash of id, and at most so
# many characters in their texts.
TOXIC_ROWS, OTHER_ROWS, SAMPLE_CHARS = 1500, 2500, 20_000
ROUNDS, UPDATES, BATCH = 4, 75, 128
RATE, TABLE_RATE = 0.01, 0.001
# Words and trigrams of fewer texts of the sample have no embedding: they would only be
# learnt by heart.
LEAST_TEXTS = 5
THRESHOLD = 0.7
# Words whose inputs a task remembers; windows, and in training texts, read together.
REMEMBERED, WINDOWS, TEXTS = 100_000, 1024, 200

_STRIPPED = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def words_of(text: str) -> list[bytes]:
    return text.encode().lower().split()


def _trigrams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Trigram rows of all words in turn, and where each word's begin."""
    line = np.frombuffer(b"\n" + b"\n".join(words) + b"\n", np.uint8).astype(np.uint32)
    middle = np.nonzero(line[1:-1] != 10)[0] + 1
    codes = (line[middle - 1] << 16 | line[middle] << 8 | line[middle + 1]) * np.uint32(2654435761)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    return (codes >> np.uint32(16)).astype(np.int32), np.cumsum(lengths) - lengths


def _word_rows(words: list[bytes]) -> np.ndarray:
    rows = (zlib.crc32(w.translate(None, _STRIPPED)) % WORD_ROWS for w in words)
    return np.fromiter(rows, np.int64, len(words))


def _listed(begin: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of stretches that begin so and have such sizes, and each one's stretch."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    return np.arange(len(owner)) + (begin - np.cumsum(sizes) + sizes)[owner], owner


def windows_of(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For texts of so many words, in turn: each window's text, first word and length.

    A text without words has one window of length zero.
    """
    per_text = np.maximum(1, -(-(counts - WORDS) // STEP) + 1)
    text = np.repeat(np.arange(len(counts)), per_text)
    number = np.arange(len(text)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    length = np.minimum(counts[text] - number * STEP, WORDS)
    return text, (np.cumsum(counts) - counts)[text] + number * STEP, length


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Network:
    """Weights by name; the gates are reset, update and candidate, side by side."""

    weights: dict[str, np.ndarray]
    # Coefficients on the highest logit, the logarithm of summed chances, and one.
    scale: np.ndarray = field(default_factory=lambda: np.array([1.0, 0.0, 0.0]))

    @staticmethod
    def fresh(seed: int = 6) -> Network:
        random = np.random.default_rng(seed)

        def normal(*shape: int, by: float) -> np.ndarray:
            return random.normal(0, by, shape).astype(np.float32)

        weights = {
            "word": normal(WORD_ROWS, SIZE, by=0.05),
            "trigram": normal(TRIGRAM_ROWS, SIZE, by=0.05),
            "attend": normal(2 * HIDDEN, ATTENTION, by=0.3),
            "attend_0": normal(ATTENTION, by=0.01),
            "query": normal(ATTENTION, by=0.3),
            "out": normal(2 * HIDDEN, by=0.3),
            "out_0": np.full(1, -1.0, np.float32),
        }
        for way in ("forth", "back"):
            weights[f"{way}_in"] = normal(SIZE, 3 * HIDDEN, by=0.4)
            weights[f"{way}_state"] = normal(HIDDEN, 3 * HIDDEN, by=0.3)
            weights[f"{way}_0"] = normal(3 * HIDDEN, by=0.01)
        return Network(weights)

    def inputs(self, words: list[bytes]) -> np.ndarray:
        """A row per word."""
        if not words:
            return np.zeros((0, SIZE), np.float32)
        trigrams, begin = _trigrams(words)
        total = np.add.reduceat(self.weights["trigram"][trigrams], begin)
        return self.weights["word"][_word_rows(words)] + total

    def projected(self, inputs: np.ndarray) -> np.ndarray:
        """What both directions' gates get from every input, side by side."""
        w = self.weights
        ways = [inputs @ w[f"{way}_in"] + w[f"{way}_0"] for way in ("forth", "back")]
        return np.hstack(ways).astype(np.float32)

    def read(self, gates: np.ndarray, places: np.ndarray, mask: np.ndarray, keep: bool = False):
        """Logits of windows; gates[places[:, t]] is the projected input of word t.

        With ``keep``, also all that the backward pass needs.
        """
        w = self.weights
        n, steps = places.shape
        states = np.zeros((steps, n, 2 * HIDDEN), np.float32)
        kept: dict[str, list] = {"forth": [], "back": []}
        for k, way in enumerate(("forth", "back")):
            own = gates[:, 3 * HIDDEN * k : 3 * HIDDEN * (k + 1)]
            state = np.zeros((n, HIDDEN), np.float32)
            order = range(steps) if way == "forth" else range(steps - 1, -1, -1)
            for t in order:
                x = own[places[:, t]]
                s = state @ w[f"{way}_state"]
                rz = _sigmoid(x[:, : 2 * HIDDEN] + s[:, : 2 * HIDDEN])
                reset, update = rz[:, :HIDDEN], rz[:, HIDDEN:]
                new = np.tanh(x[:, 2 * HIDDEN :] + reset * s[:, 2 * HIDDEN :])
                there = mask[:, t, None]
                step = (1 - update) * there
                if keep:
                    kept[way].append((t, state, reset, update, new, s[:, 2 * HIDDEN :], there))
                state = state + step * (new - state)
                states[t, :, HIDDEN * k : HIDDEN * (k + 1)] = state
        heard = np.tanh(states @ w["attend"] + w["attend_0"])
        weight = np.where(mask.T > 0, heard @ w["query"], -1e9)
        weight = np.exp(weight - weight.max(axis=0))
        weight = weight / weight.sum(axis=0) * mask.T
        pooled = (weight[:, :, None] * states).sum(axis=0)
        logits = pooled @ w["out"] + w["out_0"]
        return (logits, (kept, states, heard, weight, pooled)) if keep else logits

    def gradients(
        self, gates: np.ndarray, inputs: np.ndarray, places: np.ndarray, mask: np.ndarray,
        labels: np.ndarray,
    ) -> tuple[dict[str, np.ndarray], np.ndarray, float]:
        """Of the mean logistic loss: by weight, by row of inputs, and the loss."""
        w = self.weights
        logits, (kept, states, heard, weight, pooled) = self.read(gates, places, mask, keep=True)
        chance = _sigmoid(logits)
        loss = -np.mean(labels * np.log(chance + 1e-9) + (1 - labels) * np.log(1 - chance + 1e-9))
        d_logit = ((chance - labels) / len(labels)).astype(np.float32)
        g = {"out": pooled.T @ d_logit, "out_0": d_logit.sum(keepdims=True)}
        d_pooled = d_logit[:, None] * w["out"]
        d_states = weight[:, :, None] * d_pooled
        d_weight = (states * d_pooled).sum(axis=2)
        d_score = weight * (d_weight - (weight * d_weight).sum(axis=0))
        g["query"] = np.einsum("tna,tn->a", heard, d_score)
        d_heard = d_score[:, :, None] * w["query"] * (1 - heard**2)
        g["attend"] = np.einsum("tnh,tna->ha", states, d_heard)
        g["attend_0"] = d_heard.sum(axis=(0, 1))
        d_states += d_heard @ w["attend"].T
        d_inputs = np.zeros_like(inputs)
        for k, way in enumerate(("forth", "back")):
            state_w, in_w = w[f"{way}_state"], w[f"{way}_in"]
            d_state_w, d_in_w = np.zeros_like(state_w), np.zeros_like(in_w)
            d_bias = np.zeros(3 * HIDDEN, np.float32)
            carried = np.zeros((len(labels), HIDDEN), np.float32)
            for t, state, reset, update, new, candidate, there in reversed(kept[way]):
                d = carried + d_states[t, :, HIDDEN * k : HIDDEN * (k + 1)]
                d_new = d * there * (1 - update) * (1 - new**2)
                d_update = -d * there * (new - state) * update * (1 - update)
                d_reset = d_new * candidate * reset * (1 - reset)
                d_x = np.hstack([d_reset, d_update, d_new])
                d_s = np.hstack([d_reset, d_update, d_new * reset])
                carried = d * (1 - there * (1 - update)) + d_s @ state_w.T
                d_state_w += state.T @ d_s
                at = places[:, t]
                d_in_w += inputs[at].T @ d_x
                d_bias += d_x.sum(axis=0)
                np.add.at(d_inputs, at, d_x @ in_w.T)
            g |= {f"{way}_state": d_state_w, f"{way}_in": d_in_w, f"{way}_0": d_bias}
        return g, d_inputs, float(loss)


class Reader:
    """Reads texts with a network; remembers the projected inputs of frequent words."""

    def __init__(self, network: Network):
        self.network = network
        self.rows: dict[bytes, int] = {}
        self.gates = np.zeros((1, 6 * HIDDEN), np.float32)
        self.used = 1

    def _places(self, words: list[bytes]) -> np.ndarray:
        """Rows of gates; row 0 stands for no word."""
        new = list(dict.fromkeys(w for w in words if w not in self.rows))
        if self.used + len(new) > REMEMBERED and self.rows:
            self.rows, self.used = {}, 1
            new = list(dict.fromkeys(words))
        if new:
            if self.used + len(new) > len(self.gates):
                size = max(2 * len(self.gates), self.used + len(new))
                self.gates = np.resize(self.gates, (size, 6 * HIDDEN))
                self.gates[0] = 0
            end = self.used + len(new)
            network = self.network
            self.gates[self.used : end] = network.projected(network.inputs(new))
            self.rows.update(zip(new, range(self.used, end), strict=True))
            self.used = end
        return np.fromiter(map(self.rows.__getitem__, words), np.int64, len(words))

    def logits(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The text and the logit of every window."""
        listed = [words_of(t) for t in texts]
        counts = np.fromiter(map(len, listed), np.int64, len(listed))
        places = self._places([w for words in listed for w in words])
        places = np.append(places, np.zeros(WORDS, np.int64))
        text, first, length = windows_of(counts)
        order = np.argsort(length, kind="stable")
        out = np.zeros(len(text), np.float32)
        for at in range(0, len(order), WINDOWS):
            chosen = order[at : at + WINDOWS]
            longest = max(1, int(length[chosen].max()))
            step = np.arange(longest)
            mask = (step < length[chosen, None]).astype(np.float32)
            where = places[np.minimum(first[chosen, None] + step, len(places) - 1)]
            out[chosen] = self.network.read(self.gates, where, mask)
        return text, out

    def scores(self, texts: list[str]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        text, logits = self.logits(texts)
        begin = np.searchsorted(text, np.arange(len(texts)))
        return _sigmoid(evidence(logits, begin) @ self.network.scale)


def evidence(logits: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Highest logit, logarithm of summed chances, and one, for each text."""
    highest = np.maximum.reduceat(logits.astype(float), begin)
    chances = np.add.reduceat(_sigmoid(logits.astype(float)), begin)
    return np.column_stack([highest, np.log(chances + 1e-3), np.ones(len(begin))])


def _fit_scale(rows: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps, with a small ridge."""
    scale = np.zeros(rows.shape[1])
    for _ in range(30):
        chance = _sigmoid(rows @ scale)
        weight = chance * (1 - chance) + 1e-6
        slope = rows.T @ (labels - chance) - 1e-2 * scale
        bend = (rows * weight[:, None]).T @ rows + 1e-2 * np.eye(len(scale))
        scale = scale + np.linalg.solve(bend, slope)
    return scale


def fit_network(texts: list[str], labels: list[int], share: float | None = None) -> Network:
    """Train on texts labelled 0 or 1; ``share`` is the share of ones among all such texts.

    With labels of one kind, or none, the scores are that kind's share (a half for none).
    """
    network = Network.fresh()
    target = np.array(labels, float)
    ones = target.sum()
    if ones in (0.0, float(len(target))):
        base = float(np.log((ones + 0.5) / (len(target) - ones + 0.5)))
        network.scale = np.array([0.0, 0.0, base])
        return network
    row: dict[bytes, int] = {}
    coded = [
        np.array([row.setdefault(w, len(row) + 1) for w in words_of(t)], np.int32) for t in texts
    ]
    vocabulary = list(row)
    del row
    counts = np.fromiter(map(len, coded), np.int64, len(coded))
    flat = np.concatenate([*coded, np.zeros(WORDS, np.int32)])
    word_row = np.append(0, _word_rows(vocabulary))
    trigrams, begin = _trigrams(vocabulary)
    sizes = np.diff(np.append(begin, len(trigrams)))
    text, first, length = windows_of(counts)
    step = np.arange(WORDS)
    places = flat[np.minimum(first[:, None] + step, len(flat) - 1)]
    mask = (step < length[:, None]).astype(np.float32)

    # Start two inputs from how much more often toxic texts hold a word, or a trigram.
    held = {
        "word": np.zeros((2, WORD_ROWS), np.int64),
        "trigram": np.zeros((2, TRIGRAM_ROWS), np.int64),
    }
    for words, kind in zip(coded, target, strict=True):
        seen = np.unique(words)
        near, _ = _listed(begin[seen - 1], sizes[seen - 1])
        held["word"][int(kind), np.unique(word_row[seen])] += 1
        held["trigram"][int(kind), np.unique(trigrams[near])] += 1
    del coded
    frequent = {}
    for place, (name, (without, with_it)) in enumerate(held.items()):
        odds = np.log((with_it + 0.2) / ones) - np.log((without + 0.2) / (len(target) - ones))
        odds *= with_it / (with_it + 5)
        network.weights[name][:, place] = 0.3 * np.clip(odds, 0, 6)
        frequent[name] = (without + with_it >= LEAST_TEXTS)[:, None]
        network.weights[name] *= frequent[name]

    random = np.random.default_rng(6)
    w = network.weights
    moments = {name: (np.zeros_like(x), np.zeros_like(x)) for name, x in w.items()}
    beats = 0
    spans = np.searchsorted(text, np.arange(len(target) + 1))
    hint = np.append(0, np.add.reduceat(w["trigram"][trigrams, 1], begin))
    hint += w["word"][word_row, 0]
    logits = np.where(mask > 0, hint[places], -9).max(axis=1)
    # Every third text is kept for the scale.
    tried = np.arange(len(target)) % 3 == 2
    if len(np.unique(target[tried])) < 2 or len(np.unique(target[~tried])) < 2:
        tried = np.zeros(len(target), bool)
    other = np.nonzero((target[text] == 0) & ~tried[text])[0]
    learnt = np.nonzero((target > 0) & ~tried)[0]
    for _ in range(ROUNDS):
        # The likeliest window of each toxic text; of the others, the likeliest and any.
        toxic = np.array([spans[i] + logits[spans[i] : spans[i + 1]].argmax() for i in learnt])
        hard = other[np.argsort(-logits[other], kind="stable")[: 2 * len(toxic)]]
        for _ in range(UPDATES):
            rows = np.concatenate(
                [random.choice(toxic, BATCH // 2)]
                + [random.choice(some, BATCH // 4) for some in (hard, other)]
            )
            wanted = np.repeat([0.98, 0.0], BATCH // 2)
            used, local = np.unique(places[rows], return_inverse=True)
            local = local.reshape(places[rows].shape)
            words = used[used > 0] - 1
            near, owner = _listed(begin[words], sizes[words])
            inputs = np.zeros((len(used), SIZE), np.float32)
            inputs[used > 0] = network.inputs([vocabulary[i] for i in words])
            gates = network.projected(inputs)
            slopes, by_input, _ = network.gradients(gates, inputs, local, mask[rows], wanted)
            by_word = by_input[used > 0]
            slopes["word"] = np.zeros_like(w["word"])
            np.add.at(slopes["word"], word_row[words + 1], by_word)
            slopes["trigram"] = np.zeros_like(w["trigram"])
            np.add.at(slopes["trigram"], trigrams[near], by_word[owner])
            for name, rows_of in frequent.items():
                slopes[name] *= rows_of
            beats += 1
            for name, slope in slopes.items():
                mean_slope, square = moments[name]
                mean_slope += 0.1 * (slope - mean_slope)
                square += 0.01 * (slope**2 - square)
                size = np.sqrt(square / (1 - 0.99**beats)) + 1e-8
                rate = TABLE_RATE if name in frequent else RATE
                w[name] -= (rate * mean_slope / (1 - 0.9**beats) / size).astype(np.float32)
        reader = Reader(network)
        some = range(0, len(texts), TEXTS)
        logits = np.concatenate([reader.logits(texts[i : i + TEXTS])[1] for i in some])
    known = tried if tried.any() else ~tried
    network.scale = _fit_scale(evidence(logits, spans[:-1])[known], target[known])
    if share is not None and 0 < share < 1:
        # The sample holds more toxic texts than there are; move the odds back.
        had = ones / len(target)
        network.scale[2] += np.log(share / (1 - share)) - np.log(had / (1 - had))
    return network


def labelled_sample(
    documents: DataFrame, labels: DataFrame, label: str, ones: int, others: int
) -> tuple[list[str], list[int], float | None]:
    """Texts and labels of a bounded sample, and the share of ones among all such labels."""
    known = labels.where(F.col(label).isin(0, 1) & ~held_out()).select("doc_id", label)
    counts = {row[label]: row["count"] for row in known.groupBy(label).count().collect()}
    total = sum(counts.values())
    picked = None
    for value, rows in ((1, ones), (0, others)):
        few = known.where(F.col(label) == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
        picked = few if picked is None else picked.union(few)
    # At most ones + others rows, so they go to every task.
    short = documents.where(F.length("text") <= SAMPLE_CHARS).select("doc_id", "text")
    sample = (
        short.join(F.broadcast(picked), "doc_id")
        .orderBy(F.xxhash64("doc_id", "text"), label)
        .limit(ones + others)
        .collect()
    )
    share = counts.get(1, 0) / total if total else None
    return [row["text"] for row in sample], [row[label] for row in sample], share


def toxicity_scores(
    documents: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    threshold: float = THRESHOLD,
    toxic_rows: int = TOXIC_ROWS,
    other_rows: int = OTHER_ROWS,
) -> DataFrame:
    """doc_id, held_out, score, predicted for every document (doc_id, text).

    Fitted on at most ``toxic_rows`` and ``other_rows`` labelled rows outside the held-out
    fold. A null text is empty; an empty text is one window without words and is scored
    like any other. Repeated rows give a row each; further columns are ignored.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    network = fit_network(*labelled_sample(rows, labels, label, toxic_rows, other_rows))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(network)
        for batch, texts in text_slices(batches):
            scores = pa.array(reader.scores(texts), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), scores], ["doc_id", "score"])

    return to_tasks(rows, score, "doc_id long, score double").select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def without_toxic(
    documents: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """The documents whose score is below the threshold, with all their columns."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    network = fit_network(*labelled_sample(rows, labels, label, TOXIC_ROWS, OTHER_ROWS))
    name = fresh_name(documents, "toxicity")

    def compute():
        reader = Reader(network)
        return lambda texts: pa.array(reader.scores(texts), pa.float64())

    scored = appended(documents, name, DoubleType(), compute)
    return scored.where(F.col(name) < threshold).drop(name)
