"""From raw documents to packed training sequences, in five stages.

Each stage works on all that the one before it kept. Between stages the documents are
written to the shared folder as Parquet and read again, so a lost executor costs a read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termlode.llm.common import stored
from termlode.llm.decontaminate import without_leaks
from termlode.llm.packing import pack
from termlode.llm.repeats import without_repeats
from termlode.llm.simhash import RADIUS, SHINGLE_WORDS, one_of_each
from termlode.llm.toxicity import without_toxic

# Repeats: fifty words have about 320 bytes, and hardly ever fewer than 240.
REPEAT_BYTES, REPEAT_ANCHOR = 240, 80


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier finds toxic go."""
    return without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays; shingles and bits are op5's."""
    return one_of_each(docs, SHINGLE_WORDS, RADIUS)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that stand in several places are cut out of the texts."""
    return without_repeats(docs, REPEAT_BYTES, REPEAT_ANCHOR)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, as pieces of packed sequences."""
    crc = F.crc32("ids").cast("long").alias("ids_crc32")
    place = ["doc_tokens", "sequence_id", "offset"]
    return pack(docs).select("doc_id", "start", "length", crc, *place)


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("repeats", repeats),
    ("decontamination", decontamination),
    ("packing", packing),
]

# Neither the trained network, the hashes nor the tokenizer can be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages on documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
