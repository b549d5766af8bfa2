"""Exact removal of long repeated strings, by sorting sampled suffixes.

A window is a string of ``length`` bytes inside one text. Its anchor is the place of the
smallest hash among its short strings (the leftmost, if there are several), so equal
windows have their anchors at the same place within them, and the windows of one anchor
start in one stretch [first, last]. Only anchors are compared, under one in a hundred
bytes. Windows are settled from coarse to fine:

- If the short string at an anchor stands at no other anchor, none of its windows repeats.
  If all anchors with that string have equal surroundings (from the first window's start
  to the last window's end), all of their windows repeat.
- Else one anchor for each kind of surroundings goes on. Its windows are cut into cells by
  their distance from the anchor. A cell is settled in the same way by its core, which all
  of its windows contain, and its hull, which covers them.
- The windows of the few cells that are left are ordered as suffixes, by deep-shallow
  sorting within a task; one row for each distinct window leaves the task, and these are
  counted over all tasks.

Strings of other tasks are compared by 128-bit hashes. Every grouping is a count with
partial sums, joined back by key, so that no group of copies is gathered anywhere.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from termlode.llm.common import discard, stored, to_tasks
from termlode.llm.suffix_sort import sort_suffixes

LENGTH = 400
# Length of an anchor's short string, and window starts per cell.
ANCHOR, CELL = 128, 12
# Texts are hashed in pieces of so many bytes; place and hash share 64 bits.
PIECE = 1 << 17
_PLACE_BITS = np.uint64(18)
# Windows that are sorted together in a task.
SORTED = 40_000

_random = np.random.default_rng(20)
_TABLES = _random.integers(1, 1 << 63, (2, 256), np.uint64)
_BASES = _random.integers(1, 1 << 63, 2, np.uint64) | np.uint64(1)
_MIX = _random.integers(1, 1 << 63, 6, np.uint64) | np.uint64(1)
_HALF = np.uint64(32)


@lru_cache(maxsize=4)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of both bases, and of their inverses, up to a size."""
    forth = np.ones((2, size), np.uint64)
    back = np.ones((2, size), np.uint64)
    for k in range(2):
        forth[k, 1:] = _BASES[k]
        back[k, 1:] = np.uint64(pow(int(_BASES[k]), -1, 1 << 64))
    return np.multiply.accumulate(forth, axis=1), np.multiply.accumulate(back, axis=1)


def _mixed(values: np.ndarray, by: int) -> np.ndarray:
    values = (values ^ (values >> _HALF)) * _MIX[by]
    return values ^ (values >> _HALF)


class _Hashes:
    """Hashes of all substrings of a text."""

    def __init__(self, text: np.ndarray, count: int = 2):
        size = 1 << int(len(text)).bit_length()
        forth, self.back = _powers(size)
        self.sums = np.zeros((count, len(text) + 1), np.uint64)
        for k in range(count):
            np.cumsum(_TABLES[k][text] * forth[k, : len(text)], out=self.sums[k, 1:])

    def of(self, starts: np.ndarray, ends: np.ndarray, k: int) -> np.ndarray:
        return (self.sums[k][ends] - self.sums[k][starts]) * self.back[k][starts]

    def all_of(self, length: int) -> np.ndarray:
        sums = self.sums[0]
        found = sums[length:] - sums[: len(sums) - length]
        return found * self.back[0][: len(found)]


def _sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours: running minima of blocks from both sides."""
    size = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    forward = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(backward[:size], forward[width - 1 : width - 1 + size])


def anchors(text: np.ndarray, ends: np.ndarray, length: int, anchor: int) -> dict[str, np.ndarray]:
    """Anchors of all windows of joined texts that end at ``ends``: places and hashes."""
    names = ["at", "first", "last", "core", "hull_1", "hull_2"]
    if len(text) < length:
        return {n: np.zeros(0, np.int64) for n in names}
    hashes = _Hashes(text)
    short = _mixed(hashes.all_of(anchor), 0)
    keyed = (short >> _PLACE_BITS) << _PLACE_BITS | np.arange(len(short), dtype=np.uint64)
    least = _sliding_minimum(keyed, length - anchor + 1)
    # A window is valid if it does not run over the end of its text.
    valid = np.ones(len(least), bool)
    for end in ends[:-1]:
        valid[max(0, end - length + 1) : end] = False
    starts = np.nonzero(valid)[0]
    if not len(starts):
        return {n: np.zeros(0, np.int64) for n in names}
    at = (least[starts] & ((np.uint64(1) << _PLACE_BITS) - np.uint64(1))).astype(np.int64)
    new = np.nonzero(np.diff(at))[0] + 1
    heads = np.concatenate([[0], new])
    tails = np.concatenate([new, [len(at)]]) - 1
    at, first, last = at[heads], starts[heads], starts[tails]
    shape = ((at - first) * length + (last - first)).astype(np.uint64)
    return {
        "at": at,
        "first": first,
        "last": last,
        "core": short[at].view(np.int64),
        "hull_1": _mixed(hashes.of(first, last + length, 0) ^ shape * _MIX[3], 1).view(np.int64),
        "hull_2": _mixed(hashes.of(first, last + length, 1) ^ shape * _MIX[4], 2).view(np.int64),
    }


def _pieces(
    batches: Iterator[pa.RecordBatch], length: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, pa.RecordBatch, np.ndarray]]:
    """Joined text, ends, the offset of each part in its text, and its row in a batch.

    A text beyond the size of a piece is cut so that each window lies in one part.
    """
    for batch in batches:
        texts = batch.column("text")
        parts: list[np.ndarray] = []
        offsets: list[int] = []
        rows: list[int] = []
        size = 0

        def flush(parts=parts, offsets=offsets, rows=rows, batch=batch):
            joined = np.concatenate(parts)
            ends = np.cumsum([len(p) for p in parts])
            return joined, ends, np.array(offsets), batch, np.array(rows)

        for row in range(batch.num_rows):
            value = texts[row].as_buffer()
            if value is None:
                continue
            text = np.frombuffer(value, np.uint8)
            for start in range(0, max(1, len(text) - length + 1), PIECE):
                part = text[start : start + PIECE + length - 1]
                if size + len(part) > PIECE and parts:
                    yield flush()
                    for held in (parts, offsets, rows):
                        held.clear()
                    size = 0
                parts.append(part)
                offsets.append(start)
                rows.append(row)
                size += len(part)
        if parts:
            yield flush()


_ANCHORS = (
    "doc long, print long, at long, first long, last long, core long, hull_1 long, hull_2 long"
)


def _find_anchors(length: int, anchor: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for text, ends, offsets, batch, rows in _pieces(batches, length):
            found = anchors(text, ends, length, anchor)
            part = np.searchsorted(ends, found["at"], side="right")
            shift = offsets[part] - np.concatenate([[0], ends[:-1]])[part] if len(part) else 0
            for name in ("at", "first", "last"):
                found[name] = found[name] + shift
            row = pa.array(rows[part])
            columns = [batch.column(c).take(row) for c in ("doc", "print")]
            yield pa.RecordBatch.from_arrays(
                [*columns, *[pa.array(v) for v in found.values()]],
                ["doc", "print", *found],
            )

    return find


_CONTEXTS = "doc long, print long, at long, before int, low int, high int, known long, bytes binary"


def _cut_contexts(length: int):
    """The surroundings of the anchors that go on, as bytes."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc", "print", "at", "before", "low", "high", "known", "bytes"]
        types = [pa.int64()] * 3 + [pa.int32()] * 3 + [pa.int64(), pa.binary()]
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                doc, key = batch.column("doc")[i].as_py(), batch.column("print")[i].as_py()
                text = batch.column("text")[i].as_py()
                for p in batch.column("open")[i].as_py():
                    at, first, last = p["at"], p["first"], p["last"]
                    piece = text[first : last + length]
                    out.append(
                        (doc, key, at, at - first, at - last, at - first, p["known"], piece)
                    )
                if len(out) >= 5000:
                    yield _batch(out, names, types)
                    out = []
            if out:
                yield _batch(out, names, types)

    return cut


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
    arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names)


def _joined(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all rows as one text, and where each row starts."""
    pieces = batch.column("bytes").to_pylist()
    text = np.frombuffer(b"".join(pieces), np.uint8)
    starts = np.cumsum([0, *map(len, pieces)])[:-1]
    return text, starts


def _parts(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def _parts_by_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of about SORTED windows in their open cells."""
    for batch in batches:
        start = windows = 0
        for i, cells in enumerate(batch.column("cells")):
            more = sum(c["high"] - c["low"] + 1 for c in cells.as_py())
            if windows and windows + more > SORTED:
                yield batch.slice(start, i - start)
                start, windows = i, 0
            windows += more
        yield batch.slice(start)


_CELLS = "context long, low int, high int, core long, hull_1 long, hull_2 long"


def _cut_cells(length: int, cell: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches, 200):
            text, starts = _joined(batch)
            hashes = _Hashes(text)
            ids = np.asarray(batch.column("context"), np.int64)
            at = starts + np.asarray(batch.column("before"), np.int64)
            low = np.asarray(batch.column("low"), np.int64)
            high = np.asarray(batch.column("high"), np.int64)
            first, count = low // cell, high // cell - low // cell + 1
            row = np.repeat(np.arange(len(at)), count)
            number = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + first[row]
            lo = np.maximum(number * cell, low[row])
            hi = np.minimum(number * cell + cell - 1, high[row])
            place = at[row]
            core_start = place - number * cell
            core = hashes.of(core_start, core_start - cell + 1 + length, 0)
            shape = (lo * length + hi).astype(np.uint64)
            first_hull = hashes.of(place - hi, place - lo + length, 0) ^ shape * _MIX[3]
            other_hull = hashes.of(place - hi, place - lo + length, 1) ^ shape * _MIX[4]
            number = number.astype(np.uint64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids[row]),
                    pa.array(lo.astype(np.int32)),
                    pa.array(hi.astype(np.int32)),
                    pa.array(_mixed(core ^ number * _MIX[5], 0).view(np.int64)),
                    pa.array(_mixed(first_hull, 1).view(np.int64)),
                    pa.array(_mixed(other_hull, 2).view(np.int64)),
                ],
                ["context", "low", "high", "core", "hull_1", "hull_2"],
            )

    return cut


_CLASSES = "hull_1 long, hull_2 long, n long, members array<struct<context:long,low:int>>"


def _sort_windows(length: int):
    """Windows of the open cells: a row for each distinct window of a batch."""

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["hull_1", "hull_2", "n", "members"]
        member = pa.struct([("context", pa.int64()), ("low", pa.int32())])
        types = [pa.int64()] * 3 + [pa.list_(member)]
        for batch in _parts_by_windows(batches):
            text, starts = _joined(batch)
            ids = batch.column("context").to_pylist()
            before = batch.column("before").to_pylist()
            known = batch.column("known").to_pylist()
            owner: dict[int, tuple[int, int]] = {}
            for i, cells in enumerate(batch.column("cells").to_pylist()):
                at = int(starts[i]) + before[i]
                for c in cells:
                    for low in range(c["low"], c["high"] + 1):
                        owner[at - low] = (i, low)
            places = np.fromiter(owner, np.int64, len(owner))
            classes = sort_suffixes(text, places, length)
            heads = np.array([c[0] for c in classes], np.int64)
            hashes = _Hashes(text)
            one, two = (hashes.of(heads, heads + length, k).view(np.int64) for k in range(2))
            rows = []
            for k, places in enumerate(classes):
                members = [owner[p] for p in places]
                n = sum(2 if known[i] > 1 else 1 for i, _ in members)
                listed = [(ids[i], low) for i, low in members]
                rows.append((int(one[k]), int(two[k]), n, listed))
            rows = [(a, b, n, [{"context": i, "low": x} for i, x in m]) for a, b, n, m in rows]
            yield _batch(rows, names, types)

    return sort


def _doc_key() -> list[Column]:
    """Two longs for a row: rows that agree in both have the same id and text."""
    return [
        F.coalesce(F.col("doc_id"), F.lit(-1)).cast("long").alias("doc"),
        F.xxhash64("doc_id", "text").alias("print"),
    ]


def _shared(frame: DataFrame) -> DataFrame:
    """Rows whose core stands in several, and whether these differ in their hulls.

    The counts are stored before they are joined: then both sides of the join are plain
    exchanges, of which Spark can split a part with a very frequent core.
    """
    sums = frame.groupBy("core").agg(
        F.count("*").alias("n"), F.min("hull_1").alias("least"), F.max("hull_1").alias("most")
    )
    mixed = (F.col("least") != F.col("most")).alias("mixed")
    return frame.join(stored(sums.where("n > 1").select("core", mixed), "cores"), "core")


def repeated_windows(
    documents: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, cell: int = CELL
) -> DataFrame:
    """doc, print, first, last: stretches of starts of windows that stand elsewhere too."""
    if not 8 <= anchor < length or not 1 <= cell <= anchor:
        raise ValueError("an anchor is shorter than a window, and a cell than an anchor")
    texts = documents.select(*_doc_key(), F.encode("text", "UTF-8").alias("text"))
    found = stored(to_tasks(texts, _find_anchors(length, anchor), _ANCHORS), "anchors")
    shared = stored(_shared(found), "shared-anchors")
    discard(found)
    span = ["doc", "print", "first", "last"]
    equal = shared.where(~F.col("mixed")).select(*span)

    mixed = shared.where("mixed")
    hull = ["hull_1", "hull_2"]
    place = F.min(F.struct("doc", "print", "at", "first", "last")).alias("place")
    kinds = stored(mixed.groupBy(*hull).agg(F.count("*").alias("known"), place), "kinds")
    several = mixed.join(kinds.where("known > 1").select(*hull), hull).select(*span)

    listed = kinds.groupBy("place.doc", "place.print").agg(
        F.collect_list(F.struct("place.at", "place.first", "place.last", "known")).alias("open")
    )
    with_text = texts.join(listed.hint("shuffle_hash"), ["doc", "print"]).dropDuplicates(
        ["doc", "print"]
    )
    contexts = stored(
        to_tasks(with_text, _cut_contexts(length), _CONTEXTS).withColumn(
            "context", F.monotonically_increasing_id()
        ),
        "contexts",
    )
    cells = stored(to_tasks(contexts, _cut_cells(length, cell), _CELLS), "cells")
    met = stored(_shared(cells), "shared-cells")
    discard(cells)
    low_high = F.collect_list(F.struct("low", "high")).alias("cells")
    open_cells = met.where("mixed").groupBy("context").agg(low_high)
    classes = stored(
        to_tasks(contexts.join(open_cells, "context"), _sort_windows(length), _CLASSES),
        "window-classes",
    )
    twice = classes.groupBy(*hull).agg(F.sum("n").alias("n")).where("n > 1").select(*hull)
    windows = classes.join(twice, hull).select(F.inline("members"))
    fine = met.where(~F.col("mixed")).select("context", "low", "high").union(
        windows.select("context", "low", F.col("low").alias("high"))
    )
    owner = contexts.select("context", "doc", "print", "at")
    fine = fine.join(owner, "context").select(
        "doc",
        "print",
        (F.col("at") - F.col("high")).alias("first"),
        (F.col("at") - F.col("low")).alias("last"),
    )
    return equal.union(several).union(fine)


_SPAN = pa.struct([("first", pa.int64()), ("end", pa.int64())])
_KEPT = ["n_bytes", "spans", "kept"]
_KEPT_SCHEMA = "n_bytes long, spans array<struct<first:long,end:long>>, kept "


def _remove(length: int, raw: str, found: str, as_text: bool):
    """Replaces the columns of bytes and of found stretches by those of _KEPT.

    As text, a character of which only a part is left goes.
    """
    types = [pa.int64(), pa.list_(_SPAN), pa.string() if as_text else pa.binary()]

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches, 500):
            rows = []
            spans = batch.column(found).to_pylist()
            for text, listed in zip(batch.column(raw), spans, strict=True):
                text = text.as_py() or b""
                runs: list[list[int]] = []
                for first, last in sorted((s["first"], s["last"]) for s in listed or ()):
                    if runs and first <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], last + length)
                    else:
                        runs.append([first, last + length])
                cuts = [0, *[x for run in runs for x in run], len(text)]
                kept = b"".join(text[a:b] for a, b in zip(cuts[::2], cuts[1::2], strict=True))
                kept = kept.decode("utf-8", "ignore") if as_text else kept
                rows.append((len(text), [{"first": a, "end": b} for a, b in runs], kept))
            rest = [name for name in batch.schema.names if name not in (raw, found)]
            columns = [
                pa.array(column, kind)
                for column, kind in zip(zip(*rows, strict=True), types, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(name) for name in rest], *columns],
                [*rest, *_KEPT],
            )

    return remove


def _removed(
    documents: DataFrame, length: int, anchor: int, cell: int, as_text: bool = False
) -> DataFrame:
    """All columns but the text, under free names, with n_bytes, spans and kept bytes."""
    stretches = repeated_windows(documents, length, anchor, cell)
    listed = stretches.groupBy("doc", "print").agg(
        F.collect_list(F.struct("first", "last")).alias("found")
    )
    rest = [name for name in documents.columns if name.lower() != "text"]
    renamed = [F.col(name).alias(f"column_{i}") for i, name in enumerate(rest)]
    texts = documents.select(*renamed, *_doc_key(), F.encode("text", "UTF-8").alias("raw"))
    joined = texts.join(listed.hint("shuffle_hash"), ["doc", "print"], "left").drop("doc", "print")
    fields = [joined.schema[f"column_{i}"] for i in range(len(rest))]
    kept = StructType.fromDDL(_KEPT_SCHEMA + ("string" if as_text else "binary"))
    remove = _remove(length, "raw", "found", as_text)
    return to_tasks(joined, remove, StructType([*fields, *kept.fields]))


def remove_repeats(
    documents: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, cell: int = CELL
) -> DataFrame:
    """doc_id, n_bytes, spans (first, end) and kept bytes of every document.

    ``documents`` has doc_id and text; further columns are ignored. Each byte is removed
    that a string of ``length`` bytes covers which also starts at another place, in any
    document; strings are judged on the input. Texts are UTF-8; a null text is empty; a
    shorter text loses nothing. Repeated rows count as documents of their own, so a long
    enough text that stands twice is removed from both.
    """
    found = _removed(documents.select("doc_id", "text"), length, anchor, cell)
    return found.select(F.col("column_0").cast("long").alias("doc_id"), *_KEPT)


def without_repeats(
    documents: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, cell: int = CELL
) -> DataFrame:
    """The documents with their repeats removed and all their columns.

    A character that is cut in two goes; n_chars, if there is such a column, is counted
    anew. A null text becomes empty.
    """
    found = _removed(documents, length, anchor, cell, as_text=True)
    text = F.col("kept")
    rest = iter(range(len(documents.columns)))
    columns = []
    for name in documents.columns:
        if name.lower() == "text":
            columns.append(text.alias(name))
            continue
        number = next(rest)
        counted = F.length(text).cast(documents.schema[name].dataType)
        own = counted if name.lower() == "n_chars" else F.col(f"column_{number}")
        columns.append(own.alias(name))
    return found.select(*columns)
