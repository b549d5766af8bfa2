"""The registered queries of the operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termlode.llm.conversation_sql import (
    embedding_duplicates_sql,
    prefix_trie_sql,
    repair_sql,
)
from termlode.llm.decontaminate import leaks
from termlode.llm.grid_join import near_duplicates as near_vectors
from termlode.llm.html_text import extract_text
from termlode.llm.language import identify
from termlode.llm.licenses import BLOCK_WORDS, PHRASES, TEMPLATES, license_scan, words_of
from termlode.llm.packing import pack
from termlode.llm.prefix_trie import prefix_trie
from termlode.llm.quality import quality_scores
from termlode.llm.repair import repair
from termlode.llm.repeats import remove_repeats
from termlode.llm.simhash import near_duplicates
from termlode.llm.top_k import top_k
from termlode.llm.toxicity import toxicity_scores


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract_text(_table(spark, sf_dir, "pages"))
    n_chars = F.length("text").cast("long").alias("n_chars")
    return found.select("page_id", "url", "text", n_chars, "blocks", "kept_blocks")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(_table(spark, sf_dir, "pages"), _table(spark, sf_dir, "documents"))


def op4_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(_table(spark, sf_dir, "documents"))
    fingerprint = F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint")
    return found.select("doc_id", fingerprint, "component_id")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(_table(spark, sf_dir, "embeddings"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(_table(spark, sf_dir, "documents"))
    crc = F.crc32("ids").cast("long").alias("ids_crc32")
    place = ["doc_tokens", "sequence_id", "offset"]
    return pieces.select("doc_id", "start", "length", crc, *place)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(_table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(_table(spark, sf_dir, "conversations"))


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(_table(spark, sf_dir, "conversations"))


def op13_embedding_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(_table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    registered = [
        op1_html_text,
        op2_decontamination,
        op3_language,
        op4_repeats,
        op5_simhash,
        op6_toxicity,
        op7_top_k,
        op8_packing,
        op9_quality,
        op10_license_scan,
        op11_prefix_trie,
        op12_repair,
        op13_embedding_duplicates,
    ]
    return {query.__name__: query for query in registered}


def _license_sql() -> str:
    """Every block against every template, without any filter."""
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    lowered = f"translate(coalesce({{}}, ''), '{ascii_uppercase}', '{ascii_lowercase}')"

    def words(text: str) -> str:
        return f"regexp_extract_all({lowered.format(text)}, '{word}')"

    def listed(items) -> str:
        return "[" + ", ".join(f"'{x}'" for x in items) + "]"

    places = " UNION ALL ".join(
        f"""SELECT doc_id, '{label}' AS label, unnest(list_filter(range(len(w)),
              lambda i: w[i + 1 : i + {len(phrase.split())}] = {listed(phrase.split())})) AS place
            FROM docs"""
        for phrase, label in PHRASES.items()
    )
    templates = ", ".join(
        f"('{label}', {listed(sorted({w.decode() for w in words_of(text)}))})"
        for label, text in TEMPLATES.items()
    )
    step = BLOCK_WORDS // 2
    return f"""
        WITH docs AS (SELECT doc_id, {words("text")} AS w, coalesce(text, '') AS text
                      FROM documents),
        places AS ({places}),
        base AS (SELECT doc_id, count(*) AS n_base, min(place) AS first_word,
                        max(place) AS last_word, list(DISTINCT label) AS labels FROM places GROUP BY doc_id),
        lines AS (SELECT doc_id, {words("line")} AS w
                  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM docs)),
        blocks AS (SELECT row_number() OVER () AS block, doc_id, w[s + 1 : s + {BLOCK_WORDS}] AS w
                   FROM (SELECT doc_id, w, unnest(CASE WHEN len(w) <= {BLOCK_WORDS} THEN [0]
                     ELSE range(0, len(w) - {BLOCK_WORDS} + {step}, {step}) END) AS s FROM lines)),
        templates(label, t) AS (VALUES {templates}),
        met AS (SELECT * FROM (
                  SELECT doc_id, block, label, len(list_intersect(t, w)) AS shared, len(t) AS size
                  FROM blocks, templates) WHERE shared >= ceil(0.8 * size - 1e-9)),
        found AS (SELECT doc_id, list(DISTINCT label) AS labels,
                         max(CAST(shared AS DOUBLE) / size) AS score,
                         count(DISTINCT block) AS blocks FROM met GROUP BY doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base,
               first_word, last_word,
               coalesce(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
               coalesce(array_to_string(list_sort(list_distinct(list_concat(
                 coalesce(base.labels, []), coalesce(found.labels, [])))), ','), '') AS labels,
               CASE WHEN n_base > 0 THEN CAST(1 AS DOUBLE) ELSE coalesce(score, CAST(0 AS DOUBLE))
                 END AS score,
               coalesce(blocks, 0) AS blocks
        FROM docs LEFT JOIN base USING (doc_id) LEFT JOIN found USING (doc_id)"""


def oracle_sql() -> dict[str, str]:
    return {
        "op10_license_scan": _license_sql(),
        "op11_prefix_trie": prefix_trie_sql(),
        "op12_repair": repair_sql(),
        "op13_embedding_duplicates": embedding_duplicates_sql(),
        "op7_top_k": """
            WITH ready AS (
              SELECT vec_id, list_transform(embedding,
                       lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
              FROM embeddings
              WHERE vec_id IS NOT NULL AND len(embedding) > 0
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
            scores AS (
              SELECT q.vec_id AS query_id, c.vec_id,
                     CAST(max(list_dot_product(q.v, c.v)) AS BIGINT) AS score
              FROM ready q JOIN ready c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
              WHERE q.vec_id % 50 = 0 GROUP BY q.vec_id, c.vec_id),
            ranked AS (
              SELECT *, CAST(row_number() OVER (PARTITION BY query_id
                                                ORDER BY score DESC, vec_id) AS INTEGER) AS rank
              FROM scores)
            SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5""",
    }
