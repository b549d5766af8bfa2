"""Mixture-controlled packing by deficit round-robin over source queues.

Every source has a queue of its documents' tokens. A window of the pack is filled in
rounds: each queue earns its share of the window, is served whole tokens of what it has
earned so far, and keeps the difference as its deficit for the next window; the queue with
the largest deficit is served first. In the limit of one token per visit, this serves the
tokens in the order of their due times: token c of a queue is due when the queue has
earned c + 1/2 tokens. What a queue has been served by the end of any window then follows
from the totals of the queues alone, so each task packs its documents without knowing the
others: deficits carry over from window to window and from partition to partition.

Where a queue runs empty, the others earn its share. By default a queue's share is its
share of all tokens, so all of them end together.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termlode.llm.common import stored, text_slices, to_tasks

WINDOW = 2048
END = 1
# The sources with the most documents have queues of their own; the rest share one, or,
# where they are few, that of the largest source.
QUEUES = 256
# Rows up to which the starts of queues within partitions are broadcast.
BROADCAST_ROWS = 200_000
# A source needs this share of the documents for a queue of its own.
LEAST_SHARE = 1 / 1024
_WINDOWS_AT_ONCE, _DOCUMENTS_AT_ONCE = 8192, 500


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=2)
def _encoders(vocabulary: str, ranks: str | None):
    """The tokenizer, and a faster coder of the same ranks for texts in Latin-1."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(vocabulary)
    special = [t.content for t in exact.get_added_tokens_decoder().values()]
    if ranks is None:
        return exact, None, special
    import base64

    import public_tokenizers
    import tiktoken

    with open(ranks, "rb") as lines:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding(
        "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={}
    )
    return exact, fast, special


def token_ids(text: str, vocabulary: str, ranks: str | None = None) -> list[int]:
    """Ids of a text without special tokens added, as the tokenizer gives them.

    With ``ranks``, a file of the same vocabulary as ranks, texts in Latin-1 that hold no
    special token's string take the faster coder, where both agree.
    """
    exact, fast, special = _encoders(vocabulary, ranks)
    if fast is not None and not any(s in text for s in special):
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            pass
        else:
            return fast.encode_ordinary(text)
    return exact.encode(text, add_special_tokens=False).ids


_TOKENS = "doc_id long, partition long, queue int, start long, n long, ids binary"


def _tokenize(queues: dict[str, int], rest: int, vocabulary: str, ranks: str | None, end: int):
    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "partition", "queue", "start", "n", "ids"]
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
        partition = TaskContext.get().partitionId()
        filled = np.zeros(len(queues) + 1, np.int64)
        for batch, texts in text_slices(batches):
            rows = []
            sources = batch.column("source").to_pylist()
            ids = batch.column("doc_id").to_pylist()
            for doc_id, source, text in zip(ids, sources, texts, strict=True):
                tokens = np.array([*token_ids(text, vocabulary, ranks), end], "<u4")
                queue = queues.get(source or "", rest)
                start = int(filled[queue])
                filled[queue] += len(tokens)
                rows.append((doc_id, partition, queue, start, len(tokens), tokens.tobytes()))
            columns = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names
            )

    return tokenize


class Schedule:
    """What every queue has been served by the end of each window."""

    def __init__(self, totals: list[int], shares: list[float] | None = None, window: int = WINDOW):
        self.totals = np.array(totals, np.int64)
        self.window = window
        self.total = int(self.totals.sum())
        self.full, rest = divmod(self.total, window)
        # The tail is cut into powers of two, which need no padding.
        self.tail = [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]
        rates = self.totals if shares is None else np.where(self.totals > 0, shares, 0)
        self.clock, self.served = self._earnings(np.asarray(rates, float))

    def _earnings(self, rates: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Points between which earnings are linear: tokens of the pack, and of each queue."""
        left = self.totals.astype(float)
        clock, served = [0.0], [np.zeros(len(left))]
        while (left > 0).any():
            open_ = left > 0
            rate = np.where(open_, rates, 0)
            if not rate.sum():
                rate = left.copy()
            until = np.full(len(left), np.inf)
            np.divide(left, rate, out=until, where=rate > 0)
            step = until.min()
            gone = np.isclose(until, step, rtol=1e-12, atol=0)
            left = np.where(gone, 0, np.maximum(left - rate * step, 0))
            served.append(self.totals - left)
            clock.append(float(served[-1].sum()))
        return np.array(clock), np.array(served).reshape(len(clock), -1)

    @property
    def windows(self) -> int:
        return self.full + len(self.tail)

    def bounds(self, windows: np.ndarray) -> np.ndarray:
        """Tokens of the pack before each window."""
        tail = self.full * self.window + np.cumsum([0, *self.tail])
        late = np.clip(windows - self.full, 0, len(self.tail))
        return np.where(windows <= self.full, windows * self.window, tail[late])

    def _due(self, queue: int, count: np.ndarray) -> np.ndarray:
        return np.interp(count + 0.5, self.served[:, queue], self.clock)

    def before(self, windows: np.ndarray) -> np.ndarray:
        """Tokens of every queue before each window: the first ones by due time."""
        ends = self.bounds(windows)
        queues = range(len(self.totals))
        counts = np.stack(
            [
                np.clip(
                    np.ceil(np.interp(ends, self.clock, self.served[:, q]) - 0.5), 0, self.totals[q]
                ).astype(np.int64)
                for q in queues
            ],
            axis=1,
        )
        over = counts.sum(axis=1) - ends
        while over.any():
            for sign in (1, -1):
                rows = np.nonzero(over * sign > 0)[0]
                if not len(rows):
                    continue
                due = np.stack([self._due(q, counts[rows, q] - (sign > 0)) for q in queues], axis=1)
                if sign > 0:
                    due[counts[rows] == 0] = -np.inf
                    last = due.shape[1] - 1 - due[:, ::-1].argmax(axis=1)
                    counts[rows, last] -= 1
                else:
                    due[counts[rows] == self.totals] = np.inf
                    counts[rows, due.argmin(axis=1)] += 1
                over[rows] -= sign
        return counts

    def pieces(
        self, queue: np.ndarray, at: np.ndarray, count: np.ndarray
    ) -> tuple[np.ndarray, ...]:
        """Pieces of documents at places of their queues, by document and start.

        Each piece's document, start in the document, length, window and offset.
        """
        first, last = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        for q in np.unique(queue):
            own = queue == q
            first[own] = self._due(q, at[own]) // self.window
            last[own] = self._due(q, at[own] + count[own] - 1) // self.window
        # One window more on either side, for due times rounded, and the tail where near.
        first = np.maximum(first - 1, 0)
        last = np.minimum(last + 2 + (last + 2 >= self.full) * len(self.tail), self.windows)
        sizes = last - first + 1
        doc = np.repeat(np.arange(len(at)), sizes)
        windows = np.arange(len(doc)) + (first - np.cumsum(sizes) + sizes)[doc]
        needed, row = np.unique(windows, return_inverse=True)
        counts = [
            self.before(needed[k : k + _WINDOWS_AT_ONCE])
            for k in range(0, len(needed), _WINDOWS_AT_ONCE)
        ]
        counts = np.concatenate(counts)
        ahead = np.cumsum(counts, axis=1) - counts
        same = np.nonzero(doc[:-1] == doc[1:])[0]
        here, then, doc = row[same], row[same + 1], doc[same]
        q = queue[doc]
        begin = np.maximum(counts[here, q], at[doc])
        end = np.minimum(counts[then, q], at[doc] + count[doc])
        offset = ahead[then, q] - ahead[here, q] + begin - counts[here, q]
        full = end > begin
        found = (doc, begin - at[doc], end - begin, windows[same], offset)
        return tuple(x[full] for x in found)


_PIECES = (
    "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long,"
    " queue int, ids binary"
)


def _cut(schedule: Schedule):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in _PIECES.split(", ")]
        for whole in batches:
            for k in range(0, whole.num_rows, _DOCUMENTS_AT_ONCE):
                batch = whole.slice(k, _DOCUMENTS_AT_ONCE)
                queue, at, n = (np.asarray(batch.column(c), np.int64) for c in ("queue", "at", "n"))
                doc, start, length, window, offset = schedule.pieces(queue, at, n)
                # The pieces of a batch lie one behind the other in its ids.
                ids = b"".join(batch.column("ids").to_pylist())
                ends = np.concatenate([[0], np.cumsum(length)]).astype(np.int32) * 4
                buffers = [None, pa.py_buffer(ends), pa.py_buffer(ids)]
                numbers = [start, length, n[doc], window, offset]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(pa.array(doc)),
                        *[pa.array(x, pa.int64()) for x in numbers],
                        pa.array(queue[doc].astype(np.int32)),
                        pa.Array.from_buffers(pa.binary(), len(doc), buffers),
                    ],
                    names,
                )

    return cut


def pack(
    documents: DataFrame,
    vocabulary: str | None = None,
    ranks: str | None = None,
    shares: dict[str, float] | None = None,
    window: int = WINDOW,
    end: int = END,
    queues: int = QUEUES,
) -> DataFrame:
    """One row per piece of a document (doc_id, text, source) in the pack.

    doc_id, start, length: the piece; doc_tokens: its document's tokens, with the ``end``
    id; sequence_id, offset: its place; queue; ids: little-endian 32-bit ids. Every token
    lies in one piece. Windows are full, but for a tail cut into powers of two.

    ``shares`` gives target weights of sources (those not named weigh nothing until the
    others are empty); by default a source weighs as much as it has tokens. A null text is
    empty and has the end id alone; a null source is the empty source; repeated rows are
    packed as often as they stand. Without ``vocabulary`` the public byte-level
    vocabulary of 50,257 ids is used.
    """
    if vocabulary is None:
        vocabulary = vocabulary_path("byte_bpe_50k.json")
        ranks = vocabulary_path("byte_bpe_50k.tiktoken")
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
    )
    sources = rows.groupBy("source").count()
    ranked = sources.orderBy(F.desc("count"), "source").limit(queues).collect()
    everything = sources.agg(F.sum("count")).first()[0] or 0
    least, named = LEAST_SHARE * everything, shares or ()
    names = [r["source"] for r in ranked if r["count"] >= least or r["source"] in named]
    others = everything - sum(r["count"] for r in ranked if r["source"] in names)
    numbers = {name: i for i, name in enumerate(names)}
    rest = len(names) if others >= least or not names or shares else 0
    tokenize = _tokenize(numbers, rest, vocabulary, ranks, end)
    tokens = stored(to_tasks(rows, tokenize, _TOKENS), "tokens")

    parts = tokens.groupBy("queue", "partition").agg(F.sum("n").alias("n"))
    earlier = Window.partitionBy("queue").orderBy("partition").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = stored(
        parts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))), "queue-starts"
    )
    totals = [0] * (len(names) + 1)
    for row in starts.groupBy("queue").agg(F.sum("n").alias("n")).collect():
        totals[row["queue"]] = row["n"]
    weights = None if shares is None else [*(shares.get(name, 0.0) for name in names), 0.0]
    schedule = Schedule(totals, weights, window)
    before = starts.select("queue", "partition", "before")
    if starts.count() <= BROADCAST_ROWS:
        before = F.broadcast(before)
    placed = tokens.join(before, ["queue", "partition"]).select(
        "doc_id", "queue", (F.col("start") + F.col("before")).alias("at"), "n", "ids"
    )
    return to_tasks(placed, _cut(schedule), _PIECES)
