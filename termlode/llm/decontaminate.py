"""Benchmark decontamination by template windows and slot consistency.

A text becomes a sequence of words in which numbers, names and units are replaced by typed
placeholders, its slots. Windows of this sequence are hashed and joined with those of the
benchmark items. Windows that lie on one diagonal (the same distance between their places)
belong to one occurrence of an item; its slots are consistent if each value of the item
stands for one value of the document and the other way round, as in a question that was
asked anew with other numbers and names. Equal templates with unrelated values don't count.

Texts are read in numpy, all words of a slice at once. A bitmap of the benchmark's hashes,
of a size that follows their number, keeps all but a few windows from leaving their task; the
join decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termlode.llm.common import broadcast_if_small, fresh_name, stored, to_tasks

WINDOW, LEAST_WINDOW = 10, 5
# Share of a window that must be words, not slots; share of an item's windows in a leak.
LITERAL_SHARE, LEAK_SHARE = 0.5, 0.5
# So many words in a row as they are in an item are a leak, whatever their share.
RUN_WORDS = 50
# Bits of the bitmap for each window of the benchmark, as a power of two, and the powers of two
# between which its size stays: beyond, it lets more windows pass, which the join then drops.
SPARE_BITS, LEAST_BITS, MOST_BITS = 8, 16, 31
PART_BYTES, OVERLAP_BYTES = 1 << 19, 1 << 14
# Words that are units after a number.
UNITS = (
    "mm cm m km in ft yd inch inches foot feet yard yards mile miles meter meters metre metres"
    " kilometer kilometers kilometre kilometres mg g kg lb lbs oz gram grams kilogram kilograms"
    " ton tons tonne tonnes pound pounds ounce ounces ml l liter liters litre litres gallon"
    " gallons s sec second seconds min minute minutes h hr hrs hour hours day days week weeks"
    " month months year years percent dollar dollars cent cents euro euros usd eur gbp degree"
    " degrees celsius fahrenheit kelvin mph kmh hz khz mhz ghz w kw mw wh kwh v volt volts amp"
    " amps ohm ohms n newton newtons j joule joules pa kpa bar acre acres hectare hectares"
).split()

_random = np.random.default_rng(2)
_TABLE = _random.integers(1, 1 << 63, 256, np.uint64)
_BASE, _STEP, _MIX = (int(x) | 1 for x in _random.integers(1, 1 << 63, 3, np.uint64))
_NUMBER, _NAME, _UNIT = (np.uint64(x) for x in _random.integers(1, 1 << 63, 3, np.uint64))
_HALF = np.uint64(32)

_byte = np.arange(256)
_UPPER = (_byte >= 65) & (_byte <= 90)
_DIGIT = (_byte >= 48) & (_byte <= 57)
_WORD = _UPPER | _DIGIT | (_byte >= 97) & (_byte <= 122) | (_byte >= 128)
# Bytes at which a text may be cut: no part of a word, and no point or comma of a number.
_GAP = ~_WORD & (_byte != 44) & (_byte != 46)
_STOP = np.isin(_byte, list(b".!?:;\n\"()[]"))
_LOWERED = np.where(_UPPER, _byte + 32, _byte).astype(np.uint8)


def _powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    forth = np.full(size, base, np.uint64)
    back = np.full(size, pow(base, -1, 1 << 64), np.uint64)
    forth[0] = back[0] = 1
    return np.multiply.accumulate(forth), np.multiply.accumulate(back)


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> _HALF)) * np.uint64(_MIX)
    return values ^ (values >> _HALF)


class _Sums:
    """Hashes of stretches of a sequence."""

    cache: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, values: np.ndarray, base: int):
        size = 1 << int(len(values)).bit_length()
        if (base, size) not in self.cache:
            if len(self.cache) > 6:
                self.cache.clear()
            self.cache[base, size] = _powers(base, size)
        forth, self.back = self.cache[base, size]
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * forth[: len(values)], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (self.sums[ends] - self.sums[starts]) * self.back[starts]


def _hash_words(text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return _mixed(_Sums(_TABLE[text], _BASE).of(starts, ends))


def _hash_list(words: list[str]) -> np.ndarray:
    line = np.frombuffer(" ".join(words).encode(), np.uint8)
    sizes = np.array([len(w.encode()) for w in words])
    ends = np.cumsum(sizes + 1) - 1
    return np.unique(_hash_words(line, ends - sizes, ends))


_UNIT_HASHES = _hash_list(UNITS)


def canonical(text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, code, slot flag and value of every word of a text's bytes; see ``_words``."""
    return _words(text)[:4]


def _words(text: np.ndarray) -> tuple[np.ndarray, ...]:
    """Start, code, slot flag, value and opening flag of every word of a text's bytes.

    A word is a run of letters and digits (any byte beyond ASCII is a letter), with single
    points and commas between digits. It is a number if it starts with a digit, a unit if
    it is one and follows a number, and a name if it starts with one capital, is
    longer than it, and no sentence starts before it. Where one does, the word may be a name or
    not: it is an opening, and windows are read both ways.
    """
    none = np.zeros(0, np.int64)
    if not len(text):
        flags = none.astype(bool)
        return none, none.astype(np.uint64), flags, none.astype(np.uint64), flags
    digit = _DIGIT[text]
    word = _WORD[text]
    inner = np.zeros(len(text), bool)
    inner[1:-1] = digit[:-2] & digit[2:] & ((text[1:-1] == 44) | (text[1:-1] == 46))
    word |= inner
    edge = np.diff(word.astype(np.int8), prepend=0, append=0)
    starts, ends = np.nonzero(edge == 1)[0], np.nonzero(edge == -1)[0]
    if not len(starts):
        flags = none.astype(bool)
        return none, none.astype(np.uint64), flags, none.astype(np.uint64), flags
    # Capitals of Latin-1 beyond ASCII are two bytes, of which the second is lowered.
    after = np.zeros(len(text), bool)
    after[1:] = text[:-1] == 0xC3
    wide = after & (text >= 0x80) & (text <= 0x9E) & (text != 0x97)
    lowered = _LOWERED[text] + np.where(wide, 32, 0).astype(np.uint8)
    capital = _UPPER[text]
    capital[:-1] |= wide[1:]
    value = _hash_words(lowered, starts, ends)
    stops = np.concatenate([[0], np.cumsum(_STOP[text])])
    before = np.concatenate([[0], ends[:-1]])
    new = stops[starts] > stops[before]
    new[0] = True
    width = np.where(wide[np.minimum(starts + 1, len(text) - 1)], 2, 1)
    second = np.minimum(starts + width, len(text) - 1)
    shout = capital[second] & (starts + width < ends)
    number = digit[starts]
    name = capital[starts] & ~shout & (starts + width < ends) & ~number
    opening = name & new
    name &= ~new
    unit = np.zeros(len(starts), bool)
    unit[1:] = number[:-1] & np.isin(value[1:], _UNIT_HASHES)
    code = value.copy()
    code[number], code[name], code[unit] = _NUMBER, _NAME, _UNIT
    return starts, code, number | name | unit, value, opening & ~unit


def _parts(raw: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
    """A text in parts that overlap by enough words; and where each part begins."""
    start = 0
    while True:
        end = start + PART_BYTES
        if end >= len(raw):
            yield raw[start:], start
            return
        gaps = np.nonzero(_GAP[raw[end - OVERLAP_BYTES : end]])[0]
        if len(gaps):
            end += int(gaps[-1]) - OVERLAP_BYTES
        yield raw[start:end], start
        start = start + _next_part(raw[start:end])


def _next_part(part: np.ndarray) -> int:
    """Where the next part begins: at the first gap of the overlap."""
    back = np.nonzero(_GAP[part[-OVERLAP_BYTES:-1]])[0]
    return len(part) - OVERLAP_BYTES + int(back[0]) if len(back) else len(part)


def template_windows(
    raw: np.ndarray, sizes: list[int], bitmap: np.ndarray | None
) -> list[tuple[int, int, int, list[int], int]]:
    """Windows as of ``_windows``, for a text of any length."""
    found, base = [], 0
    for part, offset in _parts(raw):
        starts, *words = _words(part)
        rows = _windows(*words, sizes, bitmap, None, int(offset > 0))
        found += [(base + w, *rest) for w, *rest in rows]
        if offset + len(part) < len(raw):
            base += int((starts < _next_part(part)).sum())
    return found


def _windows(code, slot, value, opening, sizes, bitmap, doc, skipped) -> list[tuple]:
    """(word, size, hash, slot values, loose) of windows that the bitmap holds.

    Those with enough words, and, loose, those with openings as names. With a bitmap also
    those of the words as they are, as short items are looked for.
    """
    named, loose = np.where(opening, _NAME, code), slot | opening
    found = _hashed(code, slot, value, sizes, bitmap, doc, skipped, 0, slot)
    found += _hashed(named, loose, value, sizes, bitmap, doc, skipped, 1, slot)
    if bitmap is not None:
        found += _hashed(value, None, value, sizes, bitmap, doc, skipped, 0, None)
    return found


def _hashed(code, slot, value, sizes, bitmap, doc, skipped, loose, strict) -> list[tuple]:
    sums = _Sums(code, _STEP)
    inexact = slot is not None
    slot = slot if inexact else np.zeros(len(code), bool)
    slots = np.concatenate([[0], np.cumsum(slot)])
    before = np.concatenate([[0], np.cumsum(strict)]) if loose else None
    found = []
    for size in sizes:
        count = len(code) - size + 1
        if count <= skipped:
            continue
        at = np.arange(skipped, count)
        fits = slots[at + size] - slots[at] <= size - LITERAL_SHARE * size
        if doc is not None:
            fits &= doc[at] == doc[at + size - 1]
        if loose:
            fits &= slots[at + size] - slots[at] > before[at + size] - before[at]
        at = at[fits]
        keys = _mixed(sums.of(at, at + size) ^ np.uint64(size if inexact else ~size & 0xFFFF))
        if bitmap is not None:
            place = keys & np.uint64(8 * len(bitmap) - 1)
            held = bitmap[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1
            at, keys = at[held > 0], keys[held > 0]
        for w, key in zip(at.tolist(), keys.view(np.int64).tolist(), strict=True):
            inside = value[w : w + size][slot[w : w + size]]
            found.append((w, size, key, inside.view(np.int64).tolist(), loose))
    return found


_FOUND = "id long, document long, word long, size int, key long, slots array<long>, loose int,"
_FOUND += " family long, values long"


def _family(code, slot, value, opening) -> list[int]:
    """Hashes of an item's template with the places where its values recur, and of its values.

    Items of one family are one question with other values: what one's slots are
    consistent with, those of all are.
    """
    held = value[slot | opening]
    _, first, which = np.unique(held, return_index=True, return_inverse=True)
    # Openings count by their word and as names.
    again = np.concatenate([opening.astype(np.uint64), first[which].astype(np.uint64)])
    parts = code, again, held
    hashes = [_Sums(_mixed(x + np.uint64(1)), _STEP).of(*_ends(x))[0] for x in parts]
    family = _mixed(hashes[0] ^ _mixed(hashes[1] + np.uint64(len(code))))
    return np.array([family, hashes[2]], np.uint64).view(np.int64).tolist()


def _ends(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.zeros(1, np.int64), np.array([len(values)])


def _read(sizes: list[int] | None, bitmap: np.ndarray | None):
    """Windows of all texts; without sizes, those of items (a short one is one window)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in _FOUND.split(", ")]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64())]
        types += [pa.int32(), pa.int64(), pa.int64()]
        for batch in batches:
            rows = []
            joined: list[np.ndarray] = []
            owners: list[tuple[int | None, int]] = []
            size = 0

            def flush(joined=joined, owners=owners, rows=rows):
                # Texts of a slice are read as one, with a full stop between them.
                text = np.concatenate(joined)
                ends = np.cumsum([len(x) for x in joined])
                starts, *words = _words(text)
                doc = np.searchsorted(ends, starts, side="right")
                first = np.searchsorted(doc, np.arange(len(ends)))
                for w, *rest in _windows(*words, sizes, bitmap, doc, 0):
                    d = doc[w]
                    rows.append((*owners[d], w - int(first[d]), *rest, 0, 0))

            stop = np.frombuffer(b"\n", np.uint8)
            ids = zip(*(batch.column(n).to_pylist() for n in ("id", "document")), strict=True)
            for key, value in zip(ids, batch.column("text"), strict=True):
                buffer = value.as_buffer()
                raw = np.frombuffer(buffer, np.uint8) if buffer is not None else stop[:0]
                if sizes is None:
                    _, *words = _words(raw)
                    code, values = words[0], words[2]
                    if len(code) < LEAST_WINDOW:
                        continue
                    family = _family(*words)
                    own = [min(WINDOW, len(code))]
                    windows = template_windows(raw, own, None)
                    rows += [(*key, *window, *family) for window in windows]
                    if len(code) <= WINDOW or not windows:
                        # As exact words too, a family of its own: short items, and those
                        # of slots for the most part, which have no other window.
                        none = np.zeros(len(code), bool)
                        exact = _family(values, none, values, none)
                        for window in _hashed(values, None, values, own, None, None, 0, 0, None):
                            rows.append((*key, *window, ~exact[0], exact[1]))
                elif len(raw) > PART_BYTES:
                    for window in template_windows(raw, sizes, bitmap):
                        rows.append((*key, *window, 0, 0))
                elif len(raw):
                    if size + len(raw) > PART_BYTES and joined:
                        flush()
                        joined.clear()
                        owners.clear()
                        size = 0
                    joined += [np.concatenate([raw, stop])]
                    owners.append(key)
                    size += len(raw)
            if joined:
                flush()
            columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names)

    return read


def _leaks(
    documents: DataFrame, benchmark: DataFrame, leak_share: float, run_words: int
) -> DataFrame:
    """The rows of ``leaks`` and document, the hash of the text: there may be several of an item."""
    items = benchmark.select(
        F.col("item_id").cast("long").alias("id"),
        F.lit(0).cast("long").alias("document"),
        F.encode("text", "UTF-8").alias("text"),
    )
    asked = stored(to_tasks(items, _read(None, None), _FOUND), "item-windows")
    named = asked.select("family", "values", "id").distinct()
    least = F.min(F.struct(F.col("id").isNull(), "id", "values")).alias("least")
    first = named.groupBy("family").agg(least, F.count_distinct("id").alias("n_items"))
    first = first.select("family", "least.values", F.col("least.id").alias("first"), "n_items")
    texts = asked.dropDuplicates(["family", "values", "word", "key"])
    wanted = stored(
        texts.join(first, ["family", "values"]).select(
            "family",
            "values",
            "first",
            F.col("word").alias("item_word"),
            "key",
            "size",
            F.col("slots").alias("item_slots"),
            "n_items",
            F.size(F.collect_set("word").over(Window.partitionBy("family")))
            .cast("long")
            .alias("windows"),
            F.col("loose").alias("item_loose"),
        ),
        "items",
    )
    sizes = [row["size"] for row in wanted.select("size").distinct().collect()]
    # As large as the benchmark needs, so that few windows of other texts pass by chance.
    keys = wanted.select(F.count_distinct("key")).first()[0]
    bits = min(MOST_BITS, max(LEAST_BITS, keys.bit_length() + SPARE_BITS))
    place = F.col("key").bitwiseAND((1 << bits) - 1).alias("place")
    places = wanted.select(place).distinct().toPandas()["place"].to_numpy(np.int64)
    bitmap = np.zeros(1 << (bits - 3), np.uint8)
    np.bitwise_or.at(bitmap, places >> 3, (1 << (places & 7)).astype(np.uint8))

    docs = documents.select(
        F.col("doc_id").cast("long").alias("id"),
        F.xxhash64("text").alias("document"),
        F.encode("text", "UTF-8").alias("text"),
    )
    held = stored(to_tasks(docs, _read(sizes, bitmap), _FOUND), "document-windows")
    met = held.select(F.col("id").alias("doc_id"), "document", "word", "key", "slots", "loose")
    met = met.join(wanted, "key")
    # Without loose windows, and with them, so that these take no consistent slots away.
    levels = F.when(F.col("loose") + F.col("item_loose") > 0, F.array(F.lit(1)))
    met = met.withColumn("level", F.explode(levels.otherwise(F.array(F.lit(0), F.lit(1)))))
    pairs = F.arrays_zip(F.col("item_slots").alias("asked"), F.col("slots").alias("held"))
    shift = (F.col("word") - F.col("item_word")).alias("shift")
    # What a window holds at its place in the item; of all windows, the one with most slots.
    filled = F.when(F.size("slots") > 0, F.xxhash64("item_word", "key", "slots"))
    family = ["doc_id", "document", "family"]
    occurrence = met.groupBy(*family, "first", "windows", "n_items", "level", shift).agg(
        F.collect_set("item_word").alias("places"),
        F.array_distinct(F.flatten(F.collect_set(pairs))).alias("pairs"),
        F.collect_set(filled).alias("filled"),
        F.coalesce(F.max_by(filled, F.size("slots")), F.lit(0)).alias("fullest"),
    )
    one_to_one = (
        F.size(F.array_distinct(F.transform("pairs", lambda p: p["asked"]))) == F.size("pairs")
    ) & (F.size(F.array_distinct(F.transform("pairs", lambda p: p["held"]))) == F.size("pairs"))
    consistent = stored(occurrence.where(one_to_one), "occurrences")
    matched = F.size(F.array_distinct(F.flatten(F.collect_set("places")))).cast("long")
    found = consistent.groupBy(*family, "first", "windows", "n_items").agg(
        matched.alias("matched"),
        F.count("*").alias("occurrences"),
        F.max(F.exists("pairs", lambda p: p["asked"] != p["held"])).alias("first_reworded"),
    )
    share = F.col("matched") / F.col("windows")
    found = found.withColumn("share", share).where(F.col("share") >= leak_share)

    # Texts whose own values an occurrence holds: they agree on its fullest window, then on all.
    own = F.xxhash64("word", "key", "slots")
    texts = texts.select("family", "values", F.when(F.size("slots") > 0, own).alias("own"))
    whole = texts.groupBy("family", "values").agg(F.collect_set("own").alias("all"))
    keys = texts.dropna(subset=["own"]).union(whole.select("family", "values", F.lit(0)))
    keys = keys.select("family", "values", F.col("own").alias("fullest"))
    same = consistent.select(*family, "windows", "places", "filled", "fullest")
    same = same.join(keys, ["family", "fullest"]).join(whole, ["family", "values"])
    same = same.where(F.size(F.array_except("filled", "all")) == 0)
    verbatim = same.groupBy(*family, "windows", "values").agg(
        matched.alias("same"), F.count("*").alias("same_occurrences")
    )
    verbatim = verbatim.where(F.col("same") / F.col("windows") >= leak_share)
    verbatim = verbatim.join(named, ["family", "values"]).select(
        F.col("doc_id").alias("doc"),
        F.col("document").alias("in"),
        F.col("family").alias("of"),
        "id",
        "same_occurrences",
    )
    of = F.col("doc_id").eqNullSafe(F.col("doc")) & (F.col("family") == F.col("of"))
    of &= F.col("document") == F.col("in")
    either = found.join(verbatim, of, "left")
    result = either.select(
        "doc_id",
        "document",
        F.when(F.col("of").isNull(), F.col("first")).otherwise(F.col("id")).alias("item_id"),
        "matched",
        "windows",
        "share",
        F.when(F.col("of").isNull(), F.col("first_reworded"))
        .otherwise(F.col("same_occurrences") < F.col("occurrences"))
        .alias("reworded"),
        "n_items",
    )
    return result.unionByName(_runs(met, texts, named, run_words))


def _runs(met: DataFrame, texts: DataFrame, named: DataFrame, run_words: int) -> DataFrame:
    """Leaks by ``run_words`` words in a row that are those of an item, slots included."""
    shift = (F.col("word") - F.col("item_word")).alias("shift")
    filled = F.when(F.size("slots") > 0, F.xxhash64("item_word", "key", "slots"))
    keys = ["doc_id", "document", "family", "windows", "n_items"]
    long = met.where((F.col("windows") + WINDOW - 1 >= run_words) & (F.col("level") == 1))
    # Places without slots are those of every text of the family.
    occurrence = long.groupBy(*keys, F.col("values").alias("first_values"), shift).agg(
        F.collect_set(F.when(filled.isNull(), F.col("item_word"))).alias("free"),
        F.collect_set(F.when(filled.isNotNull(), F.struct("item_word", filled.alias("own")))).alias(
            "marks"
        ),
        (F.max("item_word") - F.min("item_word") + WINDOW).alias("span"),
    )
    occurrence = stored(occurrence.where(F.col("span") >= run_words).drop("span"), "long-occurrences")
    marked = occurrence.select(*keys, "shift", "free", F.inline("marks"))
    own = texts.dropna(subset=["own"]).distinct()
    marked = marked.join(own, ["family", "own"]).groupBy(*keys, "shift", "free", "values")
    marked = marked.agg(F.collect_set("item_word").alias("same"))
    plain = occurrence.select(*keys, "shift", "free", F.col("first_values").alias("values"))
    plain = plain.withColumn("same", F.array().cast("array<long>"))
    places = F.array_sort(F.array_union("free", "same"))
    start = F.struct(*[F.lit(x).cast("long").alias(n) for n, x in (("at", 0), ("last", -WINDOW - 1), ("most", 0))])

    def step(run, place):
        # Windows that leave no word out between them.
        at = F.when(place - run["last"] <= WINDOW, run["at"]).otherwise(place)
        most = F.greatest(run["most"], place - at + WINDOW)
        return F.struct(at.alias("at"), place.alias("last"), most.alias("most"))

    run = marked.unionByName(plain).withColumn("places", places)
    run = run.where(F.aggregate("places", start, step)["most"] >= run_words)
    matched = F.size("places").cast("long")
    return run.join(named, ["family", "values"]).select(
        "doc_id",
        "document",
        F.col("id").alias("item_id"),
        matched.alias("matched"),
        "windows",
        (matched / F.col("windows")).alias("share"),
        F.lit(False).alias("reworded"),
        "n_items",
    )


def leaks(
    documents: DataFrame,
    benchmark: DataFrame,
    leak_share: float = LEAK_SHARE,
    run_words: int = RUN_WORDS,
) -> DataFrame:
    """A row for each document (doc_id, text) and benchmark item (item_id, text) that it holds.

    doc_id, item_id, matched and windows (of the item), share = matched / windows,
    reworded (some slot has another value), n_items. A leak has at least ``leak_share`` of an
    item's windows, in occurrences whose slots are consistent. n_items counts the items of
    one family: they have the same template, and their values recur in the same places. Each of
    them whose own values the document holds in such a share has a row. If none has, the smallest id stands
    for the family. Words that begin a sentence match as words and as names. Items of five to ten
    words, and longer ones without a window of enough words, are looked for as exact words too.
    Items of fewer than five words have no windows and are never found. Null texts are empty.
    Rows that
    repeat a document's id are judged one by one, and the text held most stands for them. A run of
    ``run_words`` words with the item's own values is a leak whatever its share. Further columns are ignored.
    """
    found = _leaks(documents, benchmark, leak_share, run_words)
    # Texts of one id, or of none, may be several: the one held most stands for it.
    best = F.max(F.struct("share", "matched", "windows", ~F.col("reworded"), "reworded", "n_items"))
    found = found.groupBy("doc_id", "item_id").agg(best.alias("best"))
    columns = ["matched", "windows", "share", "reworded", "n_items"]
    return found.select("doc_id", "item_id", *[f"best.{c}" for c in columns])


def without_leaks(
    documents: DataFrame,
    benchmark: DataFrame,
    leak_share: float = LEAK_SHARE,
    run_words: int = RUN_WORDS,
) -> DataFrame:
    """The documents that hold no benchmark item, with all their columns."""
    found = _leaks(documents, benchmark, leak_share, run_words)
    leaked_id, leaked_text = (fresh_name(documents, c) for c in ("leaked_id", "leaked_text"))
    ids = found.select(F.col("doc_id").alias(leaked_id), F.col("document").alias(leaked_text))
    leaked = broadcast_if_small(stored(ids.distinct(), "leaked-ids"))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(leaked_id))
    same &= F.xxhash64("text") == F.col(leaked_text)
    return documents.join(leaked, same, "left_anti")
