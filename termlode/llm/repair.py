"""Repair of damaged conversations at the least cost, by depth-first branch-and-bound.

A conversation becomes a string of codes, one byte a row: the initial of its role, and
whether the row has to go or is truncated. Texts take no part in the search. A node of the
search is a place in that string and the initial of what was kept last; an edit leads to
the next one. The search keeps an explicit stack, for every node a bound on what the rest
of the string costs, the incumbent (the best cost and audit so far), and the best prefix
that has reached each node: a prefix that is worse than that, or can't beat the incumbent,
is dropped. When the stack is empty, the incumbent is proved to be the best.

Two prefixes of equal cost at one node never start one another, so the better one stays
better whatever follows. That also makes long conversations exact: they are cut into pieces,
each piece is searched from every initial to every other one, in tasks of its own, and
the pieces' answers are joined in order. The texts are then hashed as they stream by.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import batched, groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termlode.llm.common import broadcast_if_small, stored, to_tasks

RULES = 20
# What a rule number does to a row; all others leave it as it is.
DROP, EMPTY, STRIP, REPEAT, TO_USER = range(5)
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
# Rows of a conversation that are searched at once.
PIECE_ROWS = 256
BATCH_ROWS = 4096

# The characters that a blank text consists of.
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"

# The last kept row's initial: none yet, or one of these. A conversation ends on none or "a".
STATES = ("", "s", "u", "a")
ENDS = ("", "a")
NEXT = {"": ("s", "u"), "s": ("u",), "u": ("a",), "a": ("u",)}
# A code is 3 * initial + fault.
INITIALS = ("s", "u", "a", "other")
FINE, CUT, GONE = range(3)
_KINDS = ("blank", "duplicate", "truncated")
_WORST = 1 << 62

_PIECES = (
    "conv_id long, piece long, codes binary, gaps long, blank long, duplicate long,"
    " truncated long, illegal long"
)
_ROUTES = "conv_id long, piece long, routes binary"


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, copy, role, text, dropped: the rows after their damage.

    Nulls count as one space, in the role, the text and the number that picks the damage.
    A row that is dropped stays as a mark that its conversation exists.
    """
    role, text, conv, turn = (
        F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text", "conv_id", "turn")
    )
    rule = F.crc32(F.concat(conv, F.lit(":"), turn).cast("binary")) % RULES
    copies = F.when(rule == REPEAT, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.when(rule == TO_USER, "user").otherwise(role).alias("role"),
        F.when(rule == EMPTY, "")
        .when(rule == STRIP, F.translate(text, ".!?", ""))
        .otherwise(text)
        .alias("text"),
        (rule == DROP).alias("dropped"),
        copies.alias("copies"),
    )
    return rows.select(
        "conv_id", "turn", F.explode("copies").alias("copy"), "role", "text", "dropped"
    )


def _coded(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, digest, copy, dropped, initial, and fault of the row alone."""
    last = F.substring(F.rtrim(F.col("text"), F.lit(SPACE)), -1, 1)
    initial = F.substring("role", 1, 1)
    number = F.coalesce(
        *[F.when(initial == x, k) for k, x in enumerate(INITIALS[:3])], F.lit(len(INITIALS) - 1)
    )
    fault = F.when(last == "", GONE).when(last.isin(".", "!", "?"), FINE).otherwise(CUT)
    return rows.select(
        "conv_id",
        "turn",
        "role",
        _digest().alias("digest"),
        "copy",
        "dropped",
        initial.alias("initial"),
        number.cast("int").alias("number"),
        fault.cast("int").alias("fault"),
    )


def _digest() -> Column:
    named = F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text")
    return F.unhex(F.md5(named.cast("binary")))


def marked(rows: DataFrame) -> DataFrame:
    """Coded rows, with whether an earlier row of the conversation is the same.

    The first place of each row is a minimum, taken in each task first, so one that is
    repeated any number of times is one row of the shuffle; rows are then joined to it.
    """
    coded = _coded(rows)
    # Null turns come first; a conversation's first rows have no turn or its least.
    place = F.struct(F.col("turn").isNotNull().alias("late"), "turn", "copy").alias("place")
    firsts = coded.where(~F.col("dropped") & (F.col("fault") != GONE))
    firsts = firsts.groupBy(F.col("conv_id").alias("c"), F.col("digest").alias("d")).agg(
        F.min(place).alias("place"), F.count("*").alias("same")
    )
    # Of rows that agree in their place too, all but one are repeats of it.
    repeated = stored(firsts.where("same > 1").select("c", "d", "place"), "repeated-turns")
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d"))
    joined = coded.join(broadcast_if_small(repeated), same, "left")
    here = F.struct(F.col("turn").isNotNull().alias("late"), "turn", "copy")
    later = F.col("place").isNotNull() & (F.col("place") < here)
    first = F.col("place").isNotNull() & (F.col("place") == here)
    return joined.select(*coded.columns, later.alias("later"), first.alias("first"))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns), strict=True)


def _batch(rows: tuple, schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(zip(*rows, strict=True), schema, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in columns], schema=schema)


def _schema(**fields: pa.DataType) -> pa.Schema:
    return pa.schema(list(fields.items()))


_PIECE_TYPE = _schema(
    conv_id=pa.int64(), piece=pa.int64(), codes=pa.binary(), gaps=pa.int64(), blank=pa.int64(),
    duplicate=pa.int64(), truncated=pa.int64(), illegal=pa.int64(),
)
_ROUTE_TYPE = _schema(conv_id=pa.int64(), piece=pa.int64(), routes=pa.binary())


def _cut(piece_rows: int):
    """Sorted rows as pieces of codes; the counts stand with a conversation's last piece."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for conv, rows in groupby(_rows(batches), key=lambda row: row[0]):
            codes, piece, counts = bytearray(), 0, [0, 0, 0]
            illegal, before = 0, None
            low = high = previous = None
            turns, met = 0, None
            for _, turn, digest, dropped, initial, number, fault, later, first in rows:
                if dropped:
                    continue
                if turn is not None and turn != previous:
                    low, high, previous = (turn if low is None else low), turn, turn
                    turns += 1
                # Rows that agree in place and text stand together: the first of them counts.
                twice = first and met == (turn, digest)
                met = (turn, digest) if first else met
                kind = 0 if fault == GONE else 1 if later or twice else 2 if fault == CUT else None
                if kind is not None:
                    counts[kind] += 1
                illegal += before is not None and before + initial not in ("su", "ua", "au")
                before = initial
                if len(codes) == piece_rows:
                    yield conv, piece, bytes(codes), 0, 0, 0, 0, 0
                    codes, piece = bytearray(), piece + 1
                codes.append(3 * number + (GONE if kind in (0, 1) else fault))
            gaps = 0 if low is None else high - low + 1 - turns
            yield conv, piece, bytes(codes), gaps, *counts, illegal

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batched(pieces(batches), BATCH_ROWS):
            yield _batch(part, _PIECE_TYPE)

    return work


def _edits(code: int, state: str) -> Iterator[tuple[str, int, str]]:
    """Edits of a row after a state: letter, cost, and the state that follows."""
    initial, fault = INITIALS[code // 3], code % 3
    yield "D", DELETE, state
    if fault == GONE:
        return
    more = TRUNCATED if fault == CUT else 0
    for after in NEXT[state]:
        if after == initial:
            yield "K", more, after
        elif after != "s":
            yield "R", REROLE + more, after


def _inserts(state: str) -> Iterator[str]:
    return (after for after in NEXT[state] if after != "s")


def _bounds(codes: bytes, ends: tuple[str, ...]) -> list[dict[str, int]]:
    """For each place and state, a cost that no repair of the rest can be below.

    From the end back, each row takes its cheapest edit alone, whatever letters that gives;
    a few inserted rows may come before each. So bounds hold for every audit, and a search
    that follows them meets a cheapest one first.
    """

    def inserted(costs: dict[str, int]) -> dict[str, int]:
        for _ in STATES:
            costs = {
                state: min([costs[state], *(INSERT + costs[x] for x in _inserts(state))])
                for state in STATES
            }
        return costs

    bounds = [inserted({state: 0 if state in ends else _WORST for state in STATES})]
    for code in reversed(codes):
        rest = bounds[-1]
        bounds.append(
            inserted({s: min(c + rest[after] for _, c, after in _edits(code, s)) for s in STATES})
        )
    return bounds[::-1]


def search(codes: bytes, start: str, ends: tuple[str, ...]) -> tuple[int, str] | None:
    """The least (cost, audit) from one state to any of others, or None."""
    return _explore(codes, start, ends, _bounds(codes, ends))


def _explore(
    codes: bytes, start: str, ends: tuple[str, ...], bounds: list[dict[str, int]]
) -> tuple[int, str] | None:
    size = len(codes)
    best: tuple[int, str] = (_WORST, "")
    reached: dict[tuple[int, str], tuple[int, str]] = {}
    stack = [(0, start, 0, "")]
    while stack:
        place, state, cost, audit = stack.pop()
        lowest = cost + bounds[place][state]
        if lowest > best[0] or (lowest == best[0] and audit > best[1][: len(audit)]):
            continue
        known = reached.get((place, state))
        if lowest >= _WORST or (known is not None and known <= (cost, audit)):
            continue
        reached[place, state] = (cost, audit)
        if place == size and state in ends:
            best = min(best, (cost, audit))
        steps = [(cost + INSERT, place, after, "I") for after in _inserts(state)]
        if place < size:
            steps += [(cost + c, place + 1, s, e) for e, c, s in _edits(codes[place], state)]
        # The most promising edit is looked at first, then those with the smaller letter.
        steps.sort(key=lambda step: (step[0] + bounds[step[1]][step[2]], step[3]), reverse=True)
        stack += [(at, after, c, audit + edit) for c, at, after, edit in steps]
    return None if best[0] == _WORST else best


def all_ways(codes: bytes) -> list[tuple[str, str, tuple[int, str] | None]]:
    """The best way from each state to each state."""
    bounds = {end: _bounds(codes, (end,)) for end in STATES}
    return [(a, b, _explore(codes, a, (b,), bounds[b])) for a in STATES for b in STATES]


def _search_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces with their routes: cost and audit for each way through them, as text.

    A conversation of one piece has one way: from nothing to a proper end.
    """

    def routes() -> Iterator[tuple]:
        for conv, piece, codes, single in _rows(batches):
            if single:
                ways = [("", "", search(codes, "", ENDS))]
            else:
                ways = all_ways(codes)
            lines = [f"{a},{b},{way[0]},{way[1]}" for a, b, way in ways if way]
            yield conv, piece, "\n".join(lines).encode()

    for part in batched(routes(), BATCH_ROWS):
        yield _batch(part, _ROUTE_TYPE)


class Route:
    """The best way through a conversation, piece by piece."""

    def __init__(self):
        self.ways: dict[str, tuple[int, str]] = {"": (0, "")}

    def extend(self, routes: bytes) -> None:
        """One more piece; only the best way to each state is kept."""
        ways: dict[str, tuple[int, str]] = {}
        for line in routes.decode().splitlines():
            start, end, cost, audit = line.split(",")
            if start in self.ways:
                before = self.ways[start]
                way = (before[0] + int(cost), before[1] + audit)
                ways[end] = min(ways.get(end, way), way)
        self.ways = ways

    def best(self) -> tuple[int, str]:
        return min(self.ways[end] for end in ENDS if end in self.ways)


class _Repaired:
    """A conversation's rows, edited one after another into a running hash."""

    def __init__(self, route: Route):
        self.cost, self.audit = route.best()
        self.at = self.written = 0
        # An odd number of rows starts with a system row, which is kept.
        self.odd = (len(self.audit) - self.audit.count("D")) % 2
        self.whole = hashlib.sha256()

    def _emit(self, role: str | None, text: str) -> None:
        named = role or ("assistant" if (self.written - self.odd) % 2 else "user")
        self.whole.update(f"{chr(10) if self.written else ''}{named}:{text}".encode())
        self.written += 1

    def insert(self) -> None:
        """The rows that are inserted here."""
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            self._emit(None, "")

    def take(self, role: str, text: str) -> None:
        """The next row, after what is inserted before it."""
        self.insert()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            self._emit(role if edit == "K" else None, text)

    def row(self, conv: int | None) -> tuple:
        self.insert()
        return conv, self.cost, self.audit, self.whole.hexdigest()


def _hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per conversation, its cost, audit and the hash of what is left, row after row."""

    def repaired() -> Iterator[tuple]:
        for conv, rows in groupby(_rows(batches), key=lambda row: row[0]):
            route, done = Route(), None
            for _, kind, routes, role, text in rows:
                if kind:
                    done = done or _Repaired(route)
                    done.take(role, text)
                else:
                    route.extend(routes)
            yield (done or _Repaired(route)).row(conv)

    for part in batched(repaired(), BATCH_ROWS):
        yield _batch(part, _REPAIRED_TYPE)


_REPAIRED_TYPE = _schema(
    conv_id=pa.int64(), cost=pa.int64(), audit=pa.string(), repaired_sha256=pa.string()
)


def repair(conversations: DataFrame, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """One row per conversation: what was wrong with it, and its cheapest repair.

    ``conversations`` has conv_id, turn, role, text; further columns are ignored. It is
    damaged first (see damaged). The result has conv_id, gaps, blank, duplicate, truncated,
    illegal, cost, audit and repaired_sha256. Rows are ordered by turn, null first; rows
    with one turn by role, then digest. A null conv_id is a conversation too. A conversation
    that loses all its rows has zeros, an empty audit and the hash of nothing. An empty table
    gives no rows.
    """
    parts = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = damaged(conversations)
    order = [F.col("turn").asc_nulls_first(), "role", "digest", "copy"]
    sorted_rows = (
        marked(rows)
        .repartition(parts, "conv_id")
        .sortWithinPartitions(F.col("conv_id").asc_nulls_first(), *order)
        .select(
            "conv_id", "turn", "digest", "dropped", "initial", "number", "fault", "later", "first"
        )
    )
    pieces = stored(to_tasks(sorted_rows, _cut(piece_rows), _PIECES), "conversation-pieces")
    # Only the last piece has counts; a conversation whose first piece is full may have more.
    longer = (F.col("piece") > 0) | (F.length("codes") == piece_rows)
    spread = pieces.select("conv_id", "piece", "codes", (~longer).alias("single"))
    # Long conversations lie in one task with all their pieces: spread them over all tasks.
    spread = spread.repartition(parts, F.xxhash64("conv_id", "piece"))
    routes = stored(to_tasks(spread, _search_all, _ROUTES), "conversation-routes")

    nothing = F.lit(None)
    of_pieces = routes.select(
        "conv_id",
        F.lit(0).alias("kind"),
        F.col("piece").alias("turn"),
        F.lit("").alias("role"),
        F.lit(None).cast("binary").alias("digest"),
        F.lit(0).alias("copy"),
        "routes",
        F.lit("").alias("text"),
    )
    of_rows = rows.where(~F.col("dropped")).select(
        "conv_id",
        F.lit(1).alias("kind"),
        "turn",
        "role",
        _digest().alias("digest"),
        "copy",
        nothing.cast("binary").alias("routes"),
        "text",
    )
    both = (
        of_pieces.union(of_rows)
        .repartition(parts, "conv_id")
        .sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "kind", *order)
    )
    repaired = to_tasks(
        both.select("conv_id", "kind", "routes", "role", "text"),
        _hash,
        "conv_id long, cost long, audit string, repaired_sha256 string",
    )
    counts = pieces.groupBy(F.col("conv_id").alias("c")).agg(
        *[F.sum(name).alias(name) for name in ("gaps", *_KINDS, "illegal")]
    )
    joined = repaired.join(counts, F.col("conv_id").eqNullSafe(F.col("c")))
    return joined.select("conv_id", "gaps", *_KINDS, "illegal", "cost", "audit", "repaired_sha256")
