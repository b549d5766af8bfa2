"""Building, writing and loading an index."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termlode.functions.scoring import tfdf_weight
from termlode.operators import tables
from termlode.operators.joins import attach_df
from termlode.operators.topn import first_documents
from termlode.sources.corpus import estimated_bytes

# Bytes of input per shard: what a task sorts and adds up there fits into its memory.
SHARD_BYTES = 16 << 20
# The planner gives such sizes to what it knows nothing of.
UNKNOWN_BYTES = 1 << 60


@dataclass(frozen=True)
class SearchIndex:
    """The tables a search reads.

    forward      doc_id, len, terms (array of term and tf); one row per document
    postings     doc_id, len, term, tf
    frequencies  term, df
    stats        n_docs, total_len, avg_len, n_postings; one row
    first_docs   doc_id; the smallest ids, for documents that rank with score zero
    details      doc_id, title, url; what is shown of a result, sorted by id when stored
    shards       buckets of a stored index
    """

    forward: DataFrame
    postings: DataFrame
    frequencies: DataFrame
    stats: DataFrame
    first_docs: DataFrame
    details: DataFrame
    shards: int | None = None

    @property
    def doc_lengths(self) -> DataFrame:
        return tables.document_lengths(self.forward)

    def stat(self, name: str) -> Column:
        """One corpus statistic as a scalar subquery."""
        return self.stats.select(name).scalar()


def build_index(corpus: DataFrame) -> SearchIndex:
    """An index as a lazy plan over a corpus with unique ids; nothing is stored.

    Every search over it reads the corpus again. Use write_index for more than
    one search.
    """
    forward = tables.forward_index(corpus)
    posting_rows = tables.postings(forward)
    frequencies = tables.document_frequency(posting_rows)
    lengths = tables.document_lengths(forward)
    return SearchIndex(
        forward=forward,
        postings=posting_rows,
        frequencies=frequencies,
        stats=tables.corpus_stats(lengths, frequencies),
        first_docs=first_documents(lengths),
        details=details_of(corpus),
    )


def details_of(corpus: DataFrame) -> DataFrame:
    shown = [
        F.col(c) if c in corpus.columns else F.lit(None).cast("string").alias(c)
        for c in ("title", "url")
    ]
    return corpus.select("doc_id", *shown)


def write_index(corpus: DataFrame, root: str, shards: int | None = None) -> SearchIndex:
    """Build an index below a new folder and return it as load_index does.

    The text is shuffled once, by document id, and tokenized once; every table
    after that is derived from stored ones. Forward index and postings are
    bucketed by document id and the postings sorted by term within a bucket:

    - a frequent term is spread evenly over all buckets;
    - all postings of a document are in one bucket, so scores add up without a
      shuffle;
    - the filter on the query's terms skips the pages of all other terms.

    ``shards`` is the number of buckets, and of tasks per search; by default it follows
    the size of the corpus (suggest_shards). Ids that repeat are an error, found in the
    buckets without a shuffle; drop_duplicate_ids removes them. The statistics are
    written last: a folder without them is unfinished.
    """
    check_location(root)
    shards = shards or suggest_shards(corpus)
    placed = corpus.select("doc_id", "text").repartition(shards, "doc_id")
    return write_parts(tables.forward_index(placed), details_of(corpus), root, shards)


def write_parts(rows: DataFrame, details: DataFrame, root: str, shards: int) -> SearchIndex:
    """Writes an index from rows of a forward index, which lie in ``shards`` parts by id."""
    spark = rows.sparkSession
    write_bucketed(rows, root, "forward", shards, ["doc_id"])
    forward = bucketed(spark, root, "forward", shards, ["doc_id"])
    repeated = forward.groupBy("doc_id").count().where("count > 1").limit(1).collect()
    if repeated:
        raise ValueError(f"ids must be unique, and {repeated[0]['doc_id']!r} is not")
    details.sort("doc_id").write.mode("errorifexists").parquet(f"{root}/details")

    rows = tables.postings(forward)
    write_bucketed(rows, root, "postings", shards, ["term", "doc_id"])
    posting_rows = bucketed(spark, root, "postings", shards, ["term", "doc_id"])

    frequencies = tables.document_frequency(posting_rows).sort("term")
    frequencies.write.mode("errorifexists").parquet(f"{root}/frequencies")
    frequencies = spark.read.parquet(f"{root}/frequencies")

    lengths = tables.document_lengths(forward)
    first_docs = first_documents(lengths)
    first_docs.write.mode("errorifexists").parquet(f"{root}/first_docs")

    stats = tables.corpus_stats(lengths, frequencies).withColumn("shards", F.lit(shards))
    stats.write.mode("errorifexists").parquet(f"{root}/stats")
    return load_index(spark, root)


def load_index(spark: SparkSession, root: str) -> SearchIndex:
    """An index written before, also by another session."""
    check_location(root)
    stats = spark.read.parquet(f"{root}/stats")
    shards = stats.select("shards").first()["shards"]
    return SearchIndex(
        forward=bucketed(spark, root, "forward", shards, ["doc_id"]),
        postings=bucketed(spark, root, "postings", shards, ["term", "doc_id"]),
        frequencies=spark.read.parquet(f"{root}/frequencies"),
        stats=stats.drop("shards"),
        first_docs=spark.read.parquet(f"{root}/first_docs"),
        details=spark.read.parquet(f"{root}/details"),
        shards=shards,
    )


def suggest_shards(corpus: DataFrame) -> int:
    """A number of shards that follows the size of a corpus, without running a job.

    The size is the planner's estimate, which for files is their bytes, split or not. One
    shard takes 16 MB of it, some 2.5 million postings of prose, so that no task's sort or sum
    grows with the corpus or spills. Every core gets at least one shard, and no table more buckets than Spark allows. A
    corpus of unknown size gets as many as spark.sql.shuffle.partitions.
    """
    spark = corpus.sparkSession
    most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets", "100000"))
    cores = spark.sparkContext.defaultParallelism
    size = estimated_bytes(corpus)
    if size >= UNKNOWN_BYTES:
        return max(cores, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return min(most, max(cores, -(-size // SHARD_BYTES)))


def tfdf_postings(index: SearchIndex) -> DataFrame:
    """doc_id, len, term, weight: the forward index of the tf/df ranking."""
    weighted = attach_df(index.postings, index.frequencies, index.stat("n_postings"))
    weight = tfdf_weight(F.col("tf"), F.col("df")).alias("weight")
    return weighted.select("doc_id", "len", "term", weight)


def tfdf_forward(index: SearchIndex) -> DataFrame:
    """doc_id, len, weights (map of term to tf/df): every document, the empty ones too."""
    pairs = F.collect_list(F.struct("term", "weight"))
    weights = tfdf_postings(index).groupBy("doc_id").agg(F.map_from_entries(pairs).alias("weights"))
    empty = F.create_map().cast("map<string,double>")
    joined = index.doc_lengths.join(weights, "doc_id", "left")
    return joined.select("doc_id", "len", F.coalesce("weights", empty).alias("weights"))


def write_tfdf_index(index: SearchIndex, root: str) -> DataFrame:
    """Store the forward index of the tf/df ranking in a new folder; returns it read back."""
    check_location(root)
    tfdf_forward(index).write.mode("errorifexists").parquet(root)
    return load_tfdf_index(index.stats.sparkSession, root)


def load_tfdf_index(spark: SparkSession, root: str) -> DataFrame:
    """A forward index of the tf/df ranking written before."""
    check_location(root)
    return spark.read.parquet(root)


def check_location(root: str) -> None:
    if not (root.startswith("/") or ":/" in root):
        raise ValueError(f"an index needs an absolute path or a URI, not {root!r}")


def table_name(root: str, part: str, shards: int) -> str:
    place = hashlib.sha256(f"{root.rstrip('/')}|{shards}".encode()).hexdigest()[:16]
    return f"termlode_{place}_{part}"


def write_bucketed(
    frame: DataFrame, root: str, part: str, shards: int, order: list[str], key: str = "doc_id"
) -> None:
    """Write one part; an existing folder is an error, a table left without one is not."""
    name = table_name(root, part, shards)
    frame.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")
    (
        frame.write.format("parquet")
        .mode("errorifexists")
        .bucketBy(shards, key)
        .sortBy(*order)
        .option("path", f"{root}/{part}")
        .saveAsTable(name)
    )


def bucketed(
    spark: SparkSession,
    root: str,
    part: str,
    shards: int,
    order: list[str],
    key: str = "doc_id",
) -> DataFrame:
    """A stored part as a table, so that Spark knows its buckets."""
    name = table_name(root, part, shards)
    if not spark.catalog.tableExists(name):
        path = f"{root}/{part}"
        quoted = path.replace("\\", "\\\\").replace("'", "\\'")
        schema = spark.read.parquet(path).schema
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet"
            f" CLUSTERED BY (`{key}`) SORTED BY ({', '.join(order)}) INTO {shards} BUCKETS"
            f" LOCATION '{quoted}'"
        )
    spark.catalog.refreshTable(name)
    return spark.table(name)


def discard_bucketed(spark: SparkSession, root: str, part: str, shards: int) -> None:
    """Deletes a stored part of which nothing more is read, and its table."""
    spark.sql(f"DROP TABLE IF EXISTS {table_name(root, part, shards)}")
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{part}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
