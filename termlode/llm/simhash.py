"""Near-duplicates by SimHash, with covering locality-sensitive hashing.

Every bit position gets a non-zero vector of radius + 1 bits. For each non-zero vector v
of that size there is a table, whose mask keeps the positions whose vector has an odd
product with v. At most ``radius`` differing positions span less than the whole space, so
some v is orthogonal to all of them: the mask of that table hides every difference, and
the pair meets in it. No pair within the radius is missed, and no chance is involved.

Tables hold distinct fingerprints only. A bucket (mask and masked value) of two or three is
settled by its minimum, maximum and bitwise sum; a larger one is compared in one task up to a size, and linked
as stars, not pairs. Beyond that size it is split: the positions that its mask hides fall
into radius + 1 parts, of which a pair within the radius agrees on one, so each part is
added to the mask in turn, again without loss, until buckets are small.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from termlode.llm.common import (
    appended,
    broadcast_if_small,
    fresh_name,
    stored,
    text_slices,
    to_tasks,
)
from termlode.llm.components import components

BITS = 64
SEED = 42
SHINGLE_WORDS, RADIUS = 4, 4
# Buckets of more distinct fingerprints than this are split.
BUCKET_ROWS = 2048
_HASH_ROWS = 1 << 16
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")


def fingerprint(text: str, shingle_words: int = SHINGLE_WORDS) -> int:
    """Majority of the bits of all shingle hashes; zero for a text without words."""
    words = text.encode().lower().split()  # of bytes: A-Z, and ASCII white space
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    size = min(shingle_words, len(words))
    count = len(words) - size + 1
    starts, ends = starts[:count], ends[size - 1 :]
    votes = np.zeros((8, 8), np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, count, _HASH_ROWS):
        cut = slice(at, at + _HASH_ROWS)
        pairs = zip(starts[cut].tolist(), ends[cut].tolist(), strict=True)
        hashes = np.array([digest(line[a:b], SEED) for a, b in pairs], "<u8")
        columns = hashes.view(np.uint8).reshape(-1, 8)
        for k in range(8):
            votes[k] += np.bincount(columns[:, k], minlength=256) @ _BYTE_BITS
    bits = (2 * votes > count).astype(np.uint8)
    return int(np.packbits(bits, axis=1, bitorder="little").reshape(8).view("<u8")[0])


def fingerprints(documents: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, print: the fingerprint of every whole text as a signed long."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_slices(batches):
            values = np.array([fingerprint(t, shingle_words) for t in texts], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(values.view(np.int64))], ["doc_id", "print"]
            )

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return to_tasks(rows, work, "doc_id long, print long")


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def covering_masks(radius: int) -> list[int]:
    """The masks of all tables, as signed longs; each keeps about half of the bits."""
    size = 1 << (radius + 1)
    vectors = [i % (size - 1) + 1 for i in range(BITS)]
    return [
        _signed(sum(1 << i for i, m in enumerate(vectors) if (m & v).bit_count() % 2))
        for v in range(1, size)
    ]


def split_mask(mask: int, radius: int) -> list[int]:
    """The mask with each of radius + 1 parts of its hidden positions added."""
    hidden = [i for i in range(BITS) if not mask >> i & 1]
    parts = [hidden[k :: radius + 1] for k in range(radius + 1)]
    return [_signed((mask | sum(1 << i for i in p)) % (1 << BITS)) for p in parts]


def _link(radius: int):
    """Stars over the fingerprints of a bucket that are linked within it."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = [], []
            for prints in batch.column("prints").to_pylist():
                values = np.sort(np.array(prints, np.int64))
                # Unsigned, as numpy counts the bits of an absolute value.
                bits = values.view(np.uint64)
                rest = np.ones(len(values), bool)
                for first in range(len(values)):
                    if not rest[first]:
                        continue
                    rest[first] = False
                    front = [first]
                    while front:
                        at = front.pop()
                        open_ = np.nonzero(rest)[0]
                        near = np.bitwise_count(bits[open_] ^ bits[at]) <= radius
                        new = open_[near]
                        rest[new] = False
                        front += new.tolist()
                        left += [int(values[first])] * len(new)
                        right += values[new].tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"]
            )

    return link


def links(prints: DataFrame, radius: int = RADIUS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """a, b: edges that connect all fingerprints within the radius of one another.

    ``prints`` has distinct fingerprints in the column print.
    """
    if radius >= BITS:
        raise ValueError(f"the radius must be below {BITS}, not {radius!r}")
    spark = prints.sparkSession
    bucket = ["mask", "kept"]
    kept = F.col("print").bitwiseAND(F.col("mask")).alias("kept")
    # A few small files become many rows: spread them first.
    prints = prints.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "print")
    masks = F.explode(F.array(*[F.lit(m).cast("long") for m in covering_masks(radius)]))
    table = prints.select("print", masks.alias("mask")).select("mask", kept, "print")
    found = []
    while True:
        sizes = table.groupBy(*bucket).agg(
            F.count("*").alias("n"),
            F.min("print").alias("a"),
            F.max("print").alias("b"),
            F.bit_xor("print").alias("all"),
        )
        sizes = stored(sizes.where("n > 1"), "buckets")
        a, b = F.col("a"), F.col("b")
        near = F.bit_count(a.bitwiseXOR(b)) <= radius
        found.append(sizes.where((F.col("n") == 2) & near).select("a", "b"))
        # Of three, the one in the middle is what is left of their sum.
        middle = F.col("all").bitwiseXOR(a).bitwiseXOR(b)
        pairs = [F.struct(x.alias("a"), y.alias("b")) for x, y in ((a, b), (a, middle), (b, middle))]
        three = sizes.where(F.col("n") == 3).select(F.inline(F.array(*pairs)))
        found.append(three.where(near))
        larger = sizes.where((F.col("n") > 3) & (F.col("n") <= bucket_rows)).select(*bucket)
        members = table.join(broadcast_if_small(larger), bucket).groupBy(*bucket)
        lists = members.agg(F.collect_list("print").alias("prints")).select("prints")
        found.append(to_tasks(lists, _link(radius), "a long, b long"))

        if not sizes.where(F.col("n") > max(bucket_rows, 3)).head(1):
            return reduce(DataFrame.union, found)
        # With no more hidden positions than the radius, all of a bucket are linked.
        hot, narrow = sizes.where(F.col("n") > max(bucket_rows, 3)), F.bit_count("mask") >= BITS - radius
        star = table.join(hot.where(narrow).select(*bucket, "a"), bucket)
        star = star.where(F.col("print") != F.col("a"))
        found.append(star.select("a", F.col("print").alias("b")))
        hot = hot.where(~narrow).select(*bucket)
        # Masks depend on the radius and the depth alone, not on the data.
        hot_masks = [row["mask"] for row in hot.select("mask").distinct().collect()]
        if not hot_masks:
            return reduce(DataFrame.union, found)
        finer = [(m, s) for m in hot_masks for s in split_mask(m % (1 << BITS), radius)]
        steps = spark.createDataFrame(finer, "mask long, finer long")
        split = table.join(hot, bucket).join(F.broadcast(steps), "mask")
        table = stored(
            split.select(F.col("finer").alias("mask"), "print").select("mask", kept, "print"),
            "split-buckets",
        )


def near_duplicates(
    documents: DataFrame,
    shingle_words: int = SHINGLE_WORDS,
    radius: int = RADIUS,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """doc_id, print, component_id, root for every document (doc_id, text).

    Documents are linked if their fingerprints differ in at most ``radius`` bits;
    component_id is the smallest id reachable over links, and root one fingerprint for each
    component. A null text is an empty one,
    with fingerprint zero. Repeated rows give a row each; a null id is never the smallest,
    unless a component has no other. Further columns are ignored.
    """
    rows = stored(fingerprints(documents, shingle_words), "fingerprints")
    nodes = stored(rows.groupBy("print").agg(F.min("doc_id").alias("first")), "distinct-prints")
    roots = components(links(nodes.select("print"), radius, bucket_rows))
    rooted = nodes.join(roots.withColumnRenamed("node", "print"), "print", "left").select(
        "print", "first", F.coalesce("root", "print").alias("root")
    )
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = rooted.join(smallest, "root").select("print", "component_id", "root")
    return rows.join(classes, "print").select("doc_id", "print", "component_id", "root")


def one_of_each(
    documents: DataFrame,
    shingle_words: int = SHINGLE_WORDS,
    radius: int = RADIUS,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """One document of each component, that with the smallest id, with all its columns.

    Where several rows of a component share the smallest id, or have none, any one of them
    stays.
    """
    found = near_duplicates(documents, shingle_words, radius, bucket_rows)
    is_first = F.col("doc_id").eqNullSafe(F.col("component_id"))
    # Names that the documents don't have, as they are joined to these small tables.
    key, kept_print = fresh_name(documents, "id"), fresh_name(documents, "kept_print")
    ids = stored(
        found.groupBy(F.col("doc_id").alias(key))
        .agg(F.count("*").alias("rows"), F.count_if(is_first).alias("firsts")),
        "first-ids",
    )
    plain = F.col(key).isNotNull() & (F.col("rows") == 1)
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(key))
    # All ids but those of a single row that stays: they are fewer, and often few.
    others = stored(ids.where(~(plain & (F.col("firsts") == 1))).select(key), "other-ids")
    kept = documents.join(broadcast_if_small(others), same, "left_anti")
    repeated = stored(ids.where(~plain & (F.col("firsts") > 0)).select(key), "repeated-ids")
    if not repeated.head(1):
        return kept
    # A repeated id may stand for rows of several components: these are told by their print.
    name = fresh_name(documents, "print")
    several = documents.join(broadcast_if_small(repeated), same, "left_semi")

    def compute():
        return lambda texts: pa.array(
            np.array([fingerprint(t, shingle_words) for t in texts], np.uint64).view(np.int64)
        )

    printed = appended(several, name, LongType(), compute)
    firsts = found.where(is_first).groupBy("root").agg(
        F.min(F.struct("doc_id", "print")).alias("of")
    )
    firsts = firsts.select(F.col("of.doc_id").alias(key), F.col("of.print").alias(kept_print))
    chosen = printed.join(firsts, same & (F.col(name) == F.col(kept_print)), "left_semi")
    return kept.unionByName(chosen.dropDuplicates(["doc_id", name]).drop(name))
