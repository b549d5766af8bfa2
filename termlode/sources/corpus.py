"""Corpus sources. A corpus is a DataFrame of doc_id, text, title and url."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termlode.plans.shared import settle

# Repeated ids up to which they are broadcast.
BROADCAST_ROWS = 500_000
RECORD = "id STRING, url STRING, title STRING, text STRING"


def as_corpus(
    frame: DataFrame,
    id_col: str,
    text_col: str,
    title_col: str | None = None,
    url_col: str | None = None,
) -> DataFrame:
    """Any DataFrame as a corpus; the id keeps its own type."""

    def optional(name: str | None) -> Column:
        return F.col(name) if name else F.lit(None).cast("string")

    return frame.select(
        F.col(id_col).alias("doc_id"),
        F.col(text_col).alias("text"),
        optional(title_col).alias("title"),
        optional(url_col).alias("url"),
    )


def read_json_corpus(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines (id, url, title, text) from all files below a folder.

    A line that is not JSON fails the job; a record without a text is an empty
    document.
    """
    reader = spark.read.option("recursiveFileLookup", True).option("mode", "FAILFAST")
    records = reader.schema(RECORD).json(path)
    return as_corpus(records, "id", "text", "title", "url")


def read_raw_corpus(spark: SparkSession, path: str) -> DataFrame:
    """The same files, with the text left as it stands in the line.

    Escapes are not decoded, so ``caf\\u00e9`` gives the tokens ``caf`` and ``e``.
    The id runs from the ninth character to the url key, and the text is all that
    follows the text key, closing quote and brace included; a line without a text
    key is taken from its ninth character on. Title and url are for display only
    and are decoded.
    """
    lines = spark.read.option("recursiveFileLookup", True).text(path)
    line = F.col("value")
    # The keys as they stand in a line, and the offsets they give.
    id_end = F.locate('", "url"', line)
    text_key = F.locate(', "text":', line)
    return lines.select(
        line.substr(F.lit(9), F.greatest(id_end - 9, F.lit(0))).alias("doc_id"),
        line.substr(text_key + 9, F.length(line)).alias("text"),
        F.get_json_object(line, "$.title").alias("title"),
        F.get_json_object(line, "$.url").alias("url"),
    )


def spread_few_splits(corpus: DataFrame) -> DataFrame:
    """A corpus straight from files, over all cores if it has fewer splits than these.

    A row group or a compressed file goes to one task whatever its size, and
    tokenizing costs more than moving the text. A corpus in enough splits is left
    where it is, without a shuffle.
    """
    spark = corpus.sparkSession
    cores = spark.sparkContext.defaultParallelism
    split = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
        spark.conf.get("spark.sql.files.maxPartitionBytes")
    )
    if estimated_bytes(corpus) >= cores * split:
        return corpus
    return corpus.repartition(cores, "doc_id")


def estimated_bytes(frame: DataFrame) -> int:
    """The planner's estimate of a frame's size; no job runs."""
    size = frame._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size))


def drop_duplicate_ids(corpus: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """One row per id, the smallest by text, so that reruns keep the same row.

    An index needs unique ids; this is for a corpus that may repeat them. Rows without an id
    count as one id. Repeated ids are found from the ids alone and stored; if there are none,
    the corpus is returned as it is. If they are few, which is counted, they go to every
    task and no other row moves; only their rows go through the minimum, which is taken in
    each task first.
    """
    key = fresh_name(corpus, "repeated_id")
    rest = [name for name in corpus.columns if name not in ("doc_id", "text")]
    columns = ["doc_id", "text", *rest]
    counts = corpus.groupBy(F.col("doc_id").alias(key)).agg(F.count("*").alias("rows"))
    repeated = settle(counts.where("rows > 1").select(key))
    number = repeated.count()
    if not number:
        return corpus.select(*columns)
    if number <= broadcast_rows:
        repeated = F.broadcast(repeated)
    same = F.col("doc_id").eqNullSafe(F.col(key))
    row = F.struct("text", *rest)
    several = corpus.join(repeated, same, "left_semi")
    least = several.groupBy("doc_id").agg(F.min(row).alias("row"))
    chosen = least.select("doc_id", *[F.col(f"row.{c}").alias(c) for c in columns[1:]])
    once = corpus.join(repeated, same, "left_anti").select(*columns)
    return once.unionByName(chosen)


def fresh_name(frame: DataFrame, name: str) -> str:
    """A column name that the frame doesn't have."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name
