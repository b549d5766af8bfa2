"""The trie of all conversation prefixes, from vertical bitmaps.

A turn is a digest of its role and text. Conversations are cut into stretches of bounded
length; a stretch knows the path, a running digest, of the node it starts at. A task takes
a shard of stretches at a time and indexes it vertically: (position, turn) to the bitset of
the stretches that have this turn there. From each start, depth first, a node's bitset is
intersected with the postings of the next position: every non-empty intersection is a
child, its population the number of members, and the members that end there its end list.

Nodes of one path in several shards are merged by a sum, so a node that a third of all
conversations share is one row per shard. Subtrees need no walk over the merged trie: a
node belongs to its smallest member, and whatever a conversation owns is the tail of its
path. So a subtree's sum is the sum of its members' tails, cut at the node's depth, and
each conversation adds its tail to the nodes above it, again in sums per task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from itertools import batched, groupby

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termlode.llm.common import stored, to_tasks

# Conversations of a group share up to so many first turns of the group's first one.
GROUP, MOST_SHARED = 5, 8
# A shard holds so many stretches, a stretch so many turns.
SHARD_ROWS, STRETCH_TURNS = 4096, 64
_DIGEST = (pa.binary(), pa.string())
ROOT = hashlib.md5(b"").digest()

_STRETCHES = (
    "conv_id long, depth int, start binary, turns array<binary>, sizes array<long>,"
    " paths array<binary>, ends boolean"
)
_STRETCH_TYPE = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("depth", pa.int32()),
        ("start", pa.binary()),
        ("turns", pa.list_(pa.binary())),
        ("sizes", pa.list_(pa.int64())),
        ("paths", pa.list_(pa.binary())),
        ("ends", pa.bool_()),
    ]
)
_NODES = (
    "path binary, parent binary, depth int, size long, members long, first long, ends array<long>"
)
_NODE_TYPE = pa.schema(
    [
        ("path", pa.binary()),
        ("parent", pa.binary()),
        ("depth", pa.int32()),
        ("size", pa.int64()),
        ("members", pa.int64()),
        ("first", pa.int64()),
        ("ends", pa.list_(pa.int64())),
    ]
)


def rebuilt_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, origin, turn, role, digest, size, skip: the turns of which each is rebuilt.

    A conversation c takes the first h turns of conversation c - c % 5 (origin 0), then its
    own turns (origin 1) without the first h (skip), where h is crc32 of its id, mod 9. A row
    without a turn (origin 2) stands for the conversation itself, which may end up empty.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    named = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.unhex(F.md5(named.cast("binary"))).alias("digest"),
        role.alias("role"),
        F.octet_length(text).cast("long").alias("size"),
    )
    shared = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (MOST_SHARED + 1)
    shared = shared.cast("int").alias("skip")
    columns = ["conv_id", "origin", "turn", "role", "digest", "size", "skip"]
    # One row per conversation: the smallest of each task's rows go into the shuffle.
    ids = turns.select("conv_id").distinct().select("conv_id", shared)
    order = [F.col("turn").asc_nulls_first(), "role", "digest"]
    at = F.row_number().over(Window.partitionBy("conv_id").orderBy(*order))
    bases = turns.where(F.col("conv_id") % GROUP == 0).withColumn("at", at)
    bases = bases.where(F.col("at") <= MOST_SHARED).withColumnRenamed("conv_id", "base")
    borrowed = ids.withColumn("base", F.col("conv_id") - F.col("conv_id") % GROUP)
    borrowed = borrowed.join(bases, "base").where(F.col("at") <= F.col("skip"))
    own = turns.select("*", shared, F.lit(1).alias("origin"))
    none = ids.select(
        "*",
        F.lit(2).alias("origin"),
        F.lit(None).cast("long").alias("turn"),
        F.lit("").alias("role"),
        F.lit(ROOT).alias("digest"),
        F.lit(0).cast("long").alias("size"),
    )
    first = borrowed.withColumn("origin", F.lit(0)).select(*columns)
    return first.unionByName(own.select(*columns)).unionByName(none.select(*columns))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns), strict=True)


def _stretch(stretch_turns: int, shard_rows: int):
    """Sorted turns of whole conversations as stretches, at least one for each."""

    def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for conv, rows in groupby(_rows(batches), key=lambda row: row[0]):
            depth, path, skip = 0, ROOT, None
            start, turns, sizes, paths = ROOT, [], [], []
            for _, origin, digest, size, own_skip in rows:
                if origin == 2:
                    continue
                if origin == 1:
                    skip = own_skip if skip is None else skip
                    if skip:
                        skip -= 1
                        continue
                if len(turns) == stretch_turns:
                    yield {
                        "conv_id": conv, "depth": depth, "start": start, "turns": turns,
                        "sizes": sizes, "paths": paths, "ends": False,
                    }
                    depth, start = depth + len(turns), path
                    turns, sizes, paths = [], [], []
                path = hashlib.md5(path + digest).digest()
                turns.append(digest)
                sizes.append(size)
                paths.append(path)
            yield {
                "conv_id": conv, "depth": depth, "start": start, "turns": turns,
                "sizes": sizes, "paths": paths, "ends": True,
            }

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batched(stretches(batches), shard_rows):
            yield pa.RecordBatch.from_pylist(list(part), _STRETCH_TYPE)

    return work


def _members(bits: int) -> Iterator[int]:
    """The places of the bits that are set."""
    while bits:
        low = bits & -bits
        yield low.bit_length() - 1
        bits ^= low


def shard_nodes(shard: Sequence[tuple]) -> Iterator[tuple]:
    """The nodes of a shard of stretches, as path, parent, depth, size, members, first, ends.

    A stretch is conv_id, depth, start, turns, sizes, paths, ends. The node that it starts at
    counts only as the root; else the stretch before it has it already.
    """
    postings: dict[tuple[int, bytes], int] = {}
    starts: dict[bytes, int] = {}
    length: dict[int, int] = {}
    for i, (_, _, start, turns, _, _, ends) in enumerate(shard):
        bit = 1 << i
        starts[start] = starts.get(start, 0) | bit
        for at, turn in enumerate(turns):
            postings[at, turn] = postings.get((at, turn), 0) | bit
        if ends:
            length[len(turns)] = length.get(len(turns), 0) | bit
    longer = [0] * (max((len(s[3]) for s in shard), default=0) + 1)
    for i, stretch in enumerate(shard):
        longer[len(stretch[3])] |= 1 << i
    for at in range(len(longer) - 2, -1, -1):
        longer[at] |= longer[at + 1]
    for start, bits in starts.items():
        stack = [(bits, 0, start, b"")]
        while stack:
            bits, at, path, parent = stack.pop()
            sample = shard[(bits & -bits).bit_length() - 1]
            depth = sample[1] + at
            if at or not depth:
                done = sorted(shard[i][0] for i in _members(bits & length.get(at, 0)))
                first = min(shard[i][0] for i in _members(bits))
                size = sample[4][at - 1] if at else 0
                yield path, parent or None, depth, size, bits.bit_count(), first, done
            rest = bits & longer[at + 1] if at + 1 < len(longer) else 0
            while rest:
                member = shard[(rest & -rest).bit_length() - 1]
                child = bits & postings[at, member[3][at]]
                rest &= ~child
                stack.append((child, at + 1, member[5][at], path))


def _build(shard_rows: int):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in batched(_rows(batches), shard_rows):
            for part in batched(shard_nodes(shard), SHARD_ROWS):
                columns = zip(zip(*part, strict=True), _NODE_TYPE, strict=True)
                arrays = [pa.array(column, field.type) for column, field in columns]
                yield pa.RecordBatch.from_arrays(arrays, schema=_NODE_TYPE)

    return build


def _digest_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """path and SHA-256 of its sorted ids, which are read one by one."""

    def digests() -> Iterator[tuple[bytes, str]]:
        for path, rows in groupby(_rows(batches), key=lambda row: row[0]):
            whole = hashlib.sha256()
            for k, (_, conv) in enumerate(rows):
                whole.update(f",{conv}".encode() if k else str(conv).encode())
            yield path, whole.hexdigest()

    for part in batched(digests(), SHARD_ROWS):
        columns = [pa.array(c, t) for c, t in zip(zip(*part, strict=True), _DIGEST, strict=True)]
        yield pa.RecordBatch.from_arrays(columns, ["path", "ends_sha256"])


def prefix_trie(
    conversations: DataFrame,
    shard_rows: int = SHARD_ROWS,
    stretch_turns: int = STRETCH_TURNS,
) -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations.

    ``conversations`` has conv_id, turn, role, text; further columns are ignored. The result
    has conv_id (smallest member), depth, parent_conv_id (null for the root), n_convs,
    n_children, n_leaves, saved_tokens and ends_sha256; see rebuilt_turns for what a
    conversation is rebuilt from. Turns are ordered by turn, null first, and rows with one
    turn by role and digest; repeated rows are turns of their own. A null role or text is
    empty. Rows without an id are left out. An empty table has no root.
    """
    turns = rebuilt_turns(conversations)
    parts = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["conv_id", "origin", F.col("turn").asc_nulls_first(), "role", "digest"]
    sorted_turns = turns.repartition(parts, "conv_id").sortWithinPartitions(*order)
    stretches = stored(
        to_tasks(
            sorted_turns.select("conv_id", "origin", "digest", "size", "skip"),
            _stretch(stretch_turns, shard_rows),
            _STRETCHES,
        ),
        "stretches",
    )
    local = stored(to_tasks(stretches, _build(shard_rows), _NODES), "shard-nodes")
    merged = local.groupBy("path").agg(
        F.first("parent").alias("parent"),
        F.first("depth").alias("depth"),
        F.first("size").alias("size"),
        F.sum("members").alias("n_convs"),
        F.min("first").alias("conv_id"),
    )
    merged = stored(merged, "trie-nodes")
    children = merged.where(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("path"))
    children = children.agg(F.count("*").alias("n_children"))
    nodes = merged.join(children, "path", "left").withColumn(
        "n_children", F.coalesce("n_children", F.lit(0).cast("long"))
    )
    saved = (F.col("n_convs") - 1) * F.col("size")
    leaf = F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long")
    below = Window.partitionBy("conv_id").orderBy(F.desc("depth"))
    # From the end of the owner's path to the node: the owner's part of the subtree.
    nodes = nodes.select(
        "path",
        "parent",
        "depth",
        "conv_id",
        "n_convs",
        "n_children",
        F.sum(saved).over(below).alias("saved"),
        F.sum(leaf).over(below).alias("leaves"),
    )
    nodes = stored(nodes, "owned-nodes")
    # A conversation's tail starts at the first node that it owns.
    tails = nodes.groupBy("conv_id").agg(
        F.min("depth").alias("top"), F.min_by(F.struct("saved", "leaves"), "depth").alias("tail")
    )
    above = stretches.join(tails, "conv_id").where(F.col("top") > F.col("depth"))
    # The root stands above the first turn, and is no stretch's path.
    passed = F.slice("paths", F.lit(1), F.least(F.size("paths"), F.col("top") - F.col("depth") - 1))
    passed = F.when(F.col("depth") == 0, F.concat(F.array(F.lit(ROOT)), passed)).otherwise(passed)
    added = above.select(F.explode(passed).alias("path"), "tail.saved", "tail.leaves")
    added = added.groupBy("path").agg(
        F.sum("saved").alias("more_saved"), F.sum("leaves").alias("more_leaves")
    )
    ends = local.select("path", F.explode("ends").alias("conv_id"))
    ends = ends.repartition(parts, "path").sortWithinPartitions("path", "conv_id")
    digests = to_tasks(ends, _digest_ends, "path binary, ends_sha256 string")
    # Below its top, a node's parent has the same owner.
    tops = nodes.join(tails.select("conv_id", "top"), "conv_id")
    tops = tops.where(F.col("depth") == F.col("top")).select(
        F.col("path").alias("child"), F.col("parent").alias("path")
    )
    parents = tops.join(nodes.select("path", F.col("conv_id").alias("parent_conv_id")), "path")
    parents = parents.select(F.col("child").alias("path"), "parent_conv_id")
    whole = nodes.join(added, "path", "left").join(digests, "path", "left")
    whole = whole.join(parents, "path", "left")
    zero = F.lit(0).cast("long")
    parent = F.coalesce("parent_conv_id", F.when(F.col("parent").isNotNull(), F.col("conv_id")))
    return whole.select(
        "conv_id",
        F.col("depth").cast("long").alias("depth"),
        parent.alias("parent_conv_id"),
        "n_convs",
        "n_children",
        (F.col("leaves") + F.coalesce("more_leaves", zero)).alias("n_leaves"),
        (F.col("saved") + F.coalesce("more_saved", zero)).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )
