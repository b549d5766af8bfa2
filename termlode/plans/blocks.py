"""The blocked index: posting lists as arrays, with positions and bounds.

Documents fall into ranges by a hash of their id. A term's postings in a range are cut into
layers by their impact, the part of a BM25 score that does not depend on the term: the
first layer holds the few highest, each further one four times as many. A layer is one row
with arrays sorted by document, and with the highest impact, frequency and the least
length in it, from which an upper bound of any score in it follows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from termlode.functions import scoring
from termlode.functions.text import term_positions, tokenize
from termlode.operators import tables
from termlode.operators.topn import first_documents
from termlode.plans import index as plain
from termlode.sources.corpus import estimated_bytes

# Bytes of input per range, and ranges per shard where the size is not known.
RANGE_BYTES, RANGES_PER_SHARD = 16 << 20, 32
# So many numbers are looked at for each range, to deal the ranges evenly to the buckets.
NUMBERS_TRIED = 32
# Postings in the first layer, and how much larger each layer is than the one before it.
FIRST_LAYER, LAYER_GROWTH, MOST_LAYERS = 16, 4, 15


@dataclass(frozen=True)
class BlockedIndex:
    """The tables of a blocked index.

    forward      range, doc_id, len, terms (array of term and positions); one row per document
    blocks       range, term, layer, n, impact, max_tf, min_len, docs, tfs, lens, positions
    frequencies  term, df, impact, max_tf, min_len
    stats        n_docs, total_len, avg_len, n_postings; one row
    first_docs   doc_id; the smallest ids, for documents that rank with score zero
    details      doc_id, title, url
    """

    forward: DataFrame
    blocks: DataFrame
    frequencies: DataFrame
    stats: DataFrame
    first_docs: DataFrame
    details: DataFrame

    def stat(self, name: str) -> Column:
        """One corpus statistic as a scalar subquery."""
        return self.stats.select(name).scalar()


def postings_of(blocks: DataFrame, *columns: str) -> DataFrame:
    """A row per posting of some blocks: the given columns, doc_id, tf and len."""
    zipped = F.arrays_zip("docs", "tfs", "lens")
    rows = blocks.select(*columns, F.explode(zipped).alias("posting"))
    names = {"docs": "doc_id", "tfs": "tf", "lens": "len"}
    return rows.select(*columns, *[F.col(f"posting.{a}").alias(b) for a, b in names.items()])


def impact(tf: Column, length: Column, avg_len: Column) -> Column:
    """What a posting adds to a BM25 score per unit of idf, with the usual parameters."""
    return scoring.bm25_term_score(F.lit(1.0), tf.cast("double"), length, avg_len)


def _layers(rows: DataFrame, avg_len: Column) -> DataFrame:
    """Postings (range, term, doc_id, len, positions) as one row per layer."""
    tf = F.size("positions")
    posting = F.struct(
        (-impact(tf, F.col("len"), avg_len)).alias("order"),
        "doc_id",
        tf.alias("tf"),
        F.col("len").cast("int").alias("len"),
        "positions",
    )
    lists = rows.groupBy("range", "term").agg(F.sort_array(F.collect_list(posting)).alias("list"))
    starts = [0]
    for k in range(MOST_LAYERS - 1):
        starts.append(starts[-1] + FIRST_LAYER * LAYER_GROWTH**k)
    bounds = [
        F.struct(F.lit(k).alias("layer"), F.lit(at).alias("start"), F.lit(end - at).alias("n"))
        for k, (at, end) in enumerate(zip(starts, [*starts[1:], (1 << 31) - 1], strict=True))
    ]
    used = F.filter(F.array(*bounds), lambda b: b["start"] < F.size("list"))
    cut = lists.select("range", "term", "list", F.explode(used).alias("b"))
    part = F.slice("list", F.col("b.start") + 1, F.col("b.n"))
    by_doc = F.sort_array(
        F.transform(
            part, lambda p: F.struct(p["doc_id"], p["tf"], p["len"], p["positions"], p["order"])
        )
    )
    cut = cut.select("range", "term", F.col("b.layer").alias("layer"), by_doc.alias("part"))
    return cut.select(
        "range",
        "term",
        "layer",
        F.size("part").alias("n"),
        (-F.array_min("part.order")).alias("impact"),
        F.array_max("part.tf").alias("max_tf"),
        F.array_min("part.len").alias("min_len"),
        F.col("part.doc_id").alias("docs"),
        F.col("part.tf").alias("tfs"),
        F.col("part.len").alias("lens"),
        F.col("part.positions").alias("positions"),
    )


def suggest_ranges(corpus: DataFrame, shards: int) -> int:
    """A number of ranges, a few MB of input each, so that a list in a range stays small."""
    size = estimated_bytes(corpus)
    if size >= plain.UNKNOWN_BYTES:
        return shards * RANGES_PER_SHARD
    return max(shards, -(-size // RANGE_BYTES))


def range_numbers(spark: SparkSession, ranges: int, shards: int) -> list[int]:
    """Numbers for ranges of which every bucket gets as many, or one less.

    Spark buckets by a hash of the number. Consecutive numbers leave some buckets empty and
    bring several ranges to others, whose tasks are then as many times larger.
    """
    numbers = spark.range(0, max(ranges, shards) * NUMBERS_TRIED, 1, 1)
    number = F.col("id").cast("int").alias("number")
    tried = numbers.select(number, F.pmod(F.hash(F.col("id").cast("int")), F.lit(shards)).alias("bucket"))
    turn = F.row_number().over(Window.partitionBy("bucket").orderBy("number"))
    placed = tried.withColumn("turn", turn).orderBy("turn", "number").limit(ranges)
    return [row["number"] for row in placed.select("number").collect()]


def write_blocked_index(
    corpus: DataFrame, root: str, shards: int | None = None, ranges: int | None = None
) -> BlockedIndex:
    """Build a blocked index below a new folder and return it as load_blocked_index does.

    The text is shuffled once, by range, and tokenized once. Forward index and blocks are
    bucketed by range, as many in each bucket, so lists are gathered and scores added up where they stand. Blocks
    are sorted by term and layer within a bucket: a scan for the strongest layers of a few
    terms skips all other pages. Ids must be unique. The statistics are written last.
    """
    spark = corpus.sparkSession
    plain.check_location(root)
    shards = shards or plain.suggest_shards(corpus)
    ranges = ranges or suggest_ranges(corpus, shards)
    numbers = range_numbers(spark, ranges, shards)
    at = F.pmod(F.xxhash64("doc_id"), F.lit(len(numbers))).cast("int")
    place = F.get(F.array(*[F.lit(number) for number in numbers]), at).alias("range")
    placed = corpus.select(place, "doc_id", "text").repartition(shards, "range")
    tokens = placed.select("range", "doc_id", tokenize(F.col("text")).alias("tokens"))
    forward = tokens.select(
        "range",
        "doc_id",
        F.size("tokens").cast("long").alias("len"),
        term_positions(F.col("tokens")).alias("terms"),
    )
    plain.write_bucketed(forward, root, "forward", shards, ["range", "doc_id"], "range")
    forward = plain.bucketed(spark, root, "forward", shards, ["range", "doc_id"], "range")
    repeated = forward.groupBy("range", "doc_id").count().where("count > 1").limit(1).collect()
    if repeated:
        raise ValueError(f"ids must be unique, and {repeated[0]['doc_id']!r} is not")
    plain.details_of(corpus).sort("doc_id").write.mode("errorifexists").parquet(f"{root}/details")

    avg_len = forward.agg(F.avg("len").alias("avg_len")).scalar()
    rows = forward.select("range", "doc_id", "len", F.inline_outer("terms"))
    blocks = _layers(rows.where(F.col("term").isNotNull()), avg_len)
    plain.write_bucketed(blocks, root, "blocks", shards, ["term", "layer", "range"], "range")
    blocks = plain.bucketed(spark, root, "blocks", shards, ["term", "layer", "range"], "range")

    frequencies = blocks.groupBy("term").agg(
        F.sum("n").alias("df"),
        F.max("impact").alias("impact"),
        F.max("max_tf").alias("max_tf"),
        F.min("min_len").alias("min_len"),
    )
    frequencies.sort("term").write.mode("errorifexists").parquet(f"{root}/frequencies")
    lengths = forward.select("doc_id", "len")
    first_documents(lengths).write.mode("errorifexists").parquet(f"{root}/first_docs")
    stats = tables.corpus_stats(lengths, spark.read.parquet(f"{root}/frequencies"))
    stats = stats.withColumn("shards", F.lit(shards))
    stats.write.mode("errorifexists").parquet(f"{root}/stats")
    return load_blocked_index(spark, root)


def load_blocked_index(spark: SparkSession, root: str) -> BlockedIndex:
    """A blocked index written before, also by another session."""
    plain.check_location(root)
    stats = spark.read.parquet(f"{root}/stats")
    shards = stats.select("shards").first()["shards"]
    return BlockedIndex(
        forward=plain.bucketed(spark, root, "forward", shards, ["range", "doc_id"], "range"),
        blocks=plain.bucketed(spark, root, "blocks", shards, ["term", "layer", "range"], "range"),
        frequencies=spark.read.parquet(f"{root}/frequencies"),
        stats=stats.drop("shards"),
        first_docs=spark.read.parquet(f"{root}/first_docs"),
        details=spark.read.parquet(f"{root}/details"),
    )
