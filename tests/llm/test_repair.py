import hashlib
import random
import re
import time
import zlib

import pytest

from tests.llm.conftest import found
from termlode.llm import repair as module
from termlode.llm.repair import CUT, ENDS, FINE, GONE, Route, _bounds, all_ways, repair, search

COLUMNS = (
    "conv_id",
    "gaps",
    "blank",
    "duplicate",
    "truncated",
    "illegal",
    "cost",
    "audit",
    "repaired_sha256",
)
SCHEMA = "conv_id long, turn long, role string, text string"
PROPER = re.compile("(s?(ua)+)?")


def damage(rows):
    """conv_id to its damaged rows in order."""
    out = {}
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kept = out.setdefault(conv, [])
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        rule = zlib.crc32(key.encode()) % 20
        text = "" if rule == 1 else re.sub("[.!?]", "", text) if rule == 2 else text
        role = "user" if rule == 4 else role
        kept += [] if rule == 0 else [(turn, role, text)] * (2 if rule == 3 else 1)

    def order(row):
        turn, role, text = row
        digest = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
        return turn is not None, turn or 0, role.encode(), digest

    return {conv: sorted(kept, key=order) for conv, kept in out.items()}


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        bare = text.strip(" \t\n\v\f\r")
        if not bare:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("" if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def cheapest(rows, kinds):
    """Dynamic programming over all edits, from the first row on, with whole results kept.

    States are the initials so far; of equal costs the least audit is taken.
    """
    best = {"": (0, "", ())}

    def inserts(best):
        for _ in range(3):
            for state, (cost, audit, out) in list(best.items()):
                for role in ("user", "assistant"):
                    step = (cost + 3, audit + "I", (*out, f"{role}:"))
                    better(best, follow(state, role[0]), step)
        return best

    def follow(state, initial):
        """A state is what a proper conversation may have begun with."""
        after = {"": "su", "s": "u", "u": "a", "a": "u"}[state]
        return initial if initial and initial in after else None

    def better(best, state, step):
        if state is not None and (state not in best or step[:2] < best[state][:2]):
            best[state] = step

    best = inserts(best)
    for (_, role, text), kind in zip(rows, kinds, strict=True):
        after = {}
        for state, (cost, audit, out) in best.items():
            better(after, state, (cost + 4, audit + "D", out))
            if kind in ("blank", "duplicate"):
                continue
            more = 3 if kind == "truncated" else 0
            kept = (cost + more, audit + "K", (*out, f"{role}:{text}"))
            better(after, follow(state, role[:1]), kept)
            for name in ("user", "assistant"):
                step = (cost + more + 3, audit + "R", (*out, f"{name}:{text}"))
                better(after, follow(state, name[0]), step)
        best = inserts(after)
    return min((best[s] for s in ("", "a") if s in best), key=lambda step: step[:2])


def brute(rows):
    result = []
    for conv, kept in damage(rows).items():
        kinds = faults(kept)
        turns = [t for t, _, _ in kept if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(kept, kept[1:], strict=False)]
        cost, audit, out = cheapest(kept, kinds)
        assert PROPER.fullmatch("".join(x[0] for x in out))
        sha = hashlib.sha256("\n".join(out).encode()).hexdigest()
        counts = [kinds.count(k) for k in ("blank", "duplicate", "truncated")]
        illegal = sum(p not in ("su", "ua", "au") for p in pairs)
        result.append((conv, gaps, *counts, illegal, cost, audit, sha))
    return sorted(result, key=lambda row: [(x is not None, x) for x in row])


def every_audit(codes):
    """All audits with their cost, without any bound: only for very short strings."""
    best = None
    stack = [("", 0, 0, "")]
    while stack:
        state, place, cost, audit = stack.pop()
        if place == len(codes) and state in ENDS and (best is None or (cost, audit) < best):
            best = (cost, audit)
        if audit[-4:] != "IIII":
            stack += [(s, place, cost + 3, audit + "I") for s in module.NEXT[state] if s != "s"]
        if place < len(codes):
            edits = module._edits(codes[place], state)
            stack += [(s, place + 1, cost + c, audit + e) for e, c, s in edits]
    return best


def random_codes(rng, size):
    faulty = rng.choice([[FINE], [FINE, FINE, CUT], [FINE, CUT, GONE]])
    return bytes(3 * rng.choice([0, 1, 1, 2, 2, 3]) + rng.choice(faulty) for _ in range(size))


def test_search_equals_every_audit():
    rng = random.Random(1)
    for _ in range(150):
        codes = random_codes(rng, rng.randint(0, 4))
        expected = every_audit(codes)
        assert search(codes, "", ENDS) == expected, codes
        assert _bounds(codes, ENDS)[0][""] <= expected[0]


def test_pieces_join_to_the_whole():
    rng = random.Random(2)
    for _ in range(60):
        codes = random_codes(rng, rng.randint(1, 40))
        whole, route = search(codes, "", ENDS), Route()
        size = rng.randint(1, 12)
        for at in range(0, len(codes), size):
            ways = all_ways(codes[at : at + size])
            route.extend("\n".join(f"{a},{b},{w[0]},{w[1]}" for a, b, w in ways if w).encode())
        assert route.best() == whole


def test_a_full_piece_is_searched_fast():
    rng = random.Random(3)
    began = time.process_time()
    for _ in range(10):
        all_ways(random_codes(rng, module.PIECE_ROWS))
    assert time.process_time() - began < 10


def random_rows(seed, convs):
    rng = random.Random(seed)
    rows = []
    for conv in range(convs):
        for turn in range(rng.choice([1, 2, 3, 5, 8, 30])):
            role = rng.choice(["user", "assistant", "system", "tool", None, ""])
            role = rng.choice([role, "assistant" if turn % 2 else "user"])
            text = rng.choice(["a.", "b!", "c", " \t", "d? \n", None, f"{turn}.", "é.ß"])
            rows.append((conv - 3, turn + rng.choice([0, 0, 1]), role, text))
    return rows


@pytest.mark.parametrize("seed,piece", [(1, 256), (2, 4)])
def test_equals_dynamic_programming(spark, seed, piece):
    rows = random_rows(seed, 60)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert found(repair(frame, piece), *COLUMNS) == brute(rows)


def test_hard_rows(spark):
    rows = [(None, None, None, None), (None, 1, "user", "a."), (7, None, "user", "x" * 300_000)]
    rows += [(7, None, "user", "x" * 300_000), (7, 5, "user", "b."), (7, 5, "user", "b.")]
    rows += [(8, t, "assistant" if t % 2 else "user", f"{t}.") for t in range(700)]
    rows += [(9, 2**62, "assistant", "same."), (9, -(2**61), "assistant", "same.")]
    dropped = next(c for c in range(99) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows += [(dropped, 0, "user", "gone.")] if dropped not in (7, 8, 9) else []
    frame = spark.createDataFrame(
        [(*row, "x", 1, b"") for row in rows],
        SCHEMA + ", kind string, copy int, digest binary",
    )
    got = found(repair(frame), *COLUMNS)
    assert got == brute(rows)
    assert (dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest()) in got
    assert repair(frame.where("false")).collect() == []
