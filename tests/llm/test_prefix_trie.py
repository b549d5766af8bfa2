import hashlib
import random
import zlib

import pytest

from termlode.llm.prefix_trie import prefix_trie, rebuilt_turns
from tests.llm.conftest import found

COLUMNS = (
    "conv_id",
    "depth",
    "parent_conv_id",
    "n_convs",
    "n_children",
    "n_leaves",
    "saved_tokens",
    "ends_sha256",
)
SCHEMA = "conv_id long, turn long, role string, text string"


def rebuilt(rows):
    """conv_id to its rebuilt turns of (role, text)."""

    def order(row):
        role, text = row[2] or "", row[3] or ""
        named = f"{len(role.encode())}:{role}{text}".encode()
        return (row[1] is not None, row[1] or 0, role.encode(), hashlib.md5(named).digest())

    own = {}
    for row in sorted((r for r in rows if r[0] is not None), key=order):
        own.setdefault(row[0], []).append((row[2] or "", row[3] or ""))
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def brute(rows):
    convs = rebuilt(rows)
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)

    def subtree(node):
        out, front = [], [node]
        while front:
            out.append(front.pop())
            front += children.get(out[-1], [])
        return out

    result = []
    for node, inside in members.items():
        below = subtree(node)
        saved = sum((len(members[n]) - 1) * len(n[-1][1].encode()) for n in below if n)
        leaves = sum(n not in children for n in below)
        ends = ",".join(str(c) for c in sorted(inside) if len(convs[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        sha = hashlib.sha256(ends.encode()).hexdigest()
        counts = (len(inside), len(children.get(node, [])), leaves, saved)
        result.append((min(inside), len(node), parent, *counts, sha))
    return sorted(result, key=lambda row: [(x is not None, x) for x in row])


def random_rows(seed, convs, most):
    """Conversations over few turns, so that prefixes are shared; some copies, some long."""
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-20, 4 * convs), convs):
        for turn in range(rng.choice([0, 1, 2, 5, most])):
            text = rng.choice(["", "a", "é ß", "b" * 30, None])
            rows.append((c, turn, rng.choice(["user", "assistant", None]), text))
    return rows


@pytest.mark.parametrize("seed,stretch,shard", [(1, 64, 4096), (2, 3, 4096), (3, 1, 7), (4, 4, 16)])
def test_equals_plain_trie(spark, seed, stretch, shard):
    rows = random_rows(seed, 90, 12)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert found(prefix_trie(frame, shard, stretch), *COLUMNS) == brute(rows)


def test_hard_rows(spark):
    long = "x" * 300_000
    rows = [(5, None, "user", "q"), (5, 0, None, None), (5, 0, "user", "tie"), (5, 0, "user", "tie")]
    rows += [(6, 1, "a:", "b"), (6, 2, "a", ":b"), (7, 1, "user", long), (None, 0, "user", "q")]
    rows += [(c, t, "user", str(t)) for c in range(100, 140) for t in range(3)]
    rows += [(200, t, "user", "same") for t in range(200)] + [(201, t, "user", "same") for t in range(150)]
    frame = spark.createDataFrame(
        [(*row, "x", 1, b"", 0) for row in rows],
        SCHEMA + ", path string, origin int, digest binary, size int",
    )
    assert found(prefix_trie(frame), *COLUMNS) == brute(rows)
    assert prefix_trie(frame.where("false")).collect() == []
    assert prefix_trie(frame.where("conv_id is null")).collect() == []


def test_a_conversation_may_lose_all_its_turns(spark):
    c = next(c for c in range(1, 99) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 3)
    rows = [(c, 0, "user", "a"), (c, 1, "user", "b")]
    got = found(prefix_trie(spark.createDataFrame(rows, SCHEMA)), *COLUMNS)
    ends = hashlib.sha256(str(c).encode()).hexdigest()
    assert got == [(c, 0, None, 1, 0, 1, 0, ends)] == brute(rows)


def test_only_the_first_turns_of_a_base_are_ranked(spark):
    frame = spark.createDataFrame(random_rows(1, 9, 3), SCHEMA)
    plan = rebuilt_turns(frame)._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan
