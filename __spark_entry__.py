
from __future__ import annotations

import importlib
from collections.abc import Callable
from types import ModuleType

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import termlode
from termlode.operators import tables
from termlode.plans import sketches
from termlode.plans.blocks import postings_of
from termlode.plans.scratch import (
    prepared,
    prepared_blocked_index,
    prepared_index,
    scratch_path,
)

QUERY = "the theory of inter"
REPEATED = "the theory of inter inter"
PAGE_QUERY = "De la ouier en pour"
UNKNOWN = "Xyzzyx 1999 qqqqqqq"
PHRASE, CLOSE_TERMS, SNIPPET_QUERY = "of the", "the of and", "that the theory of reand"
# Documents with one of two leaves, and without two others.
CONDITION = (termlode.has("the") | termlode.has("de la")) & ~(
    termlode.has("of the") | (termlode.has("und") & ~termlode.has("des"))
)
AROUND = 3
REPLACED = "de"
MISSPELT, EDITS = "thet eanred unghet", 2
WIDENED, SIMILARITY_DIGITS = "the und reand", 6
N, MOST = 10, 1000
# Small enough that the batch is cut into several slices.
SLICE_BYTES = 20_000
# Scores are compared after rounding: BM25, tf/df product, tf/df weight.
BM25_DIGITS, TFDF_DIGITS, WEIGHT_DIGITS = 6, 9, 9


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as a corpus; lang and source stand in for title and url."""
    frame = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return termlode.as_corpus(frame, "doc_id", "text", "lang", "source")


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The web pages as a corpus: tags blanked, title from the title element."""
    html = F.col("html")
    frame = spark.read.parquet(f"{sf_dir}/pages.parquet").select(
        "page_id",
        "url",
        F.regexp_replace(html, "<[^>]*>", " ").alias("text"),
        F.regexp_extract(html, "(?s)<title>(.*?)</title>", 1).alias("title"),
    )
    return termlode.as_corpus(frame, "page_id", "text", "title", "url")


def _benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return frame.select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))


def _lazy_index(spark: SparkSession, sf_dir: str) -> termlode.SearchIndex:
    corpus = _documents(spark, sf_dir).select("doc_id", "text")
    return termlode.build_index(termlode.spread_few_splits(corpus))


def _index(spark: SparkSession, sf_dir: str) -> termlode.SearchIndex:
    return prepared_index(_documents(spark, sf_dir), f"{sf_dir}/documents")


def _rounded(frame: DataFrame, digits: int, column: str = "score") -> DataFrame:
    return frame.withColumn(column, F.round(column, digits))


_dumps: dict[tuple[str, str], str] = {}


def _dump(spark: SparkSession, sf_dir: str) -> str:
    """The documents as JSON lines in nested folders, once per session; the top folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _dumps:
        _dumps[key] = _write_dump(spark, sf_dir)
    return _dumps[key]


def _write_dump(spark: SparkSession, sf_dir: str) -> str:

    def quoted(column: str) -> Column:
        return F.regexp_extract(F.to_json(F.array(column)), r"(?s)^\[(.*)\]$", 1)

    corpus = _documents(spark, sf_dir)
    line = F.concat(
        F.lit('{"id": "'),
        F.col("doc_id").cast("string"),
        F.lit('", "url": '),
        quoted("url"),
        F.lit(', "title": '),
        quoted("title"),
        F.lit(', "text": '),
        quoted("text"),
        F.lit("}"),
    )
    path = scratch_path(spark, "dump")
    corpus.select("title", line.alias("value")).write.partitionBy("title").text(path)
    return path


def json_source_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    corpus = termlode.read_json_corpus(spark, _dump(spark, sf_dir))
    return termlode.build_index(corpus).postings.select("doc_id", "term", "tf")


def raw_source_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    corpus = termlode.read_raw_corpus(spark, _dump(spark, sf_dir))
    return termlode.build_index(corpus).postings.select("doc_id", "term", "tf")


def source_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    corpus = termlode.read_json_corpus(spark, _dump(spark, sf_dir))
    return corpus.select("doc_id", "title", "url")


def tokenize_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lazy_index(spark, sf_dir).postings.select("doc_id", "term", "tf")


def doc_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lazy_index(spark, sf_dir).doc_lengths


def document_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lazy_index(spark, sf_dir).frequencies


def corpus_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = _lazy_index(spark, sf_dir).stats
    return _rounded(stats.select("n_docs", "total_len", "avg_len"), 6, "avg_len")


def forward_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    maps = tables.term_map(_lazy_index(spark, sf_dir).forward)
    total = F.aggregate(F.map_values("terms"), F.lit(0).cast("long"), lambda a, tf: a + tf)
    entries = _entries_md5("terms", lambda tf: tf)
    return maps.select(
        "doc_id", F.size("terms").cast("long").alias("n_terms"), total.alias("total_tf"), entries
    )


def _entries_md5(column: str, shown: Callable[[Column], Column]) -> Column:
    """A digest of all entries of a map in the order of their terms."""
    entries = F.array_sort(F.map_entries(column))
    lines = F.transform(
        entries, lambda e: F.concat(e["key"], F.lit(":"), shown(e["value"]).cast("string"))
    )
    return F.md5(F.array_join(lines, " ").cast("binary")).alias("entries_md5")


def tfdf_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    weighted = termlode.tfdf_postings(_index(spark, sf_dir)).select("doc_id", "term", "weight")
    return _rounded(weighted, WEIGHT_DIGITS, "weight")


def query_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    terms = termlode.known_query_terms(_index(spark, sf_dir), _benchmark(spark, sf_dir))
    return terms.select(F.col("query_id").alias("item_id"), "term", "qtf")


def bm25_idf(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = _index(spark, sf_dir)
    idf = termlode.bm25_idf(F.col("df"), index.stat("n_docs"))
    return _rounded(index.frequencies.select("term", "df", idf.alias("idf")), 9, "idf")


def bm25_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = _index(spark, sf_dir)
    hits = termlode.bm25_scores(index, QUERY)
    return _rounded(termlode.score_all(index, hits), BM25_DIGITS)


def bm25_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(termlode.bm25_search(_index(spark, sf_dir), QUERY, N), BM25_DIGITS)


def bm25_topn_scaled_tf(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = termlode.bm25_search(_index(spark, sf_dir), QUERY, N, tf_scale=10.0)
    return _rounded(result, BM25_DIGITS)


def tfdf_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = _index(spark, sf_dir)
    hits = termlode.tfdf_scores(index, REPEATED)
    return _rounded(termlode.score_all(index, hits), TFDF_DIGITS)


def tfdf_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(termlode.tfdf_search(_index(spark, sf_dir), REPEATED, N), TFDF_DIGITS)


def ranked_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = _index(spark, sf_dir)
    hits = termlode.bm25_scores(index, REPEATED)
    path = scratch_path(spark, "ranking")
    termlode.write_ranking(termlode.score_all(index, hits), path)
    return _rounded(spark.read.parquet(path).drop("position"), BM25_DIGITS)


def ranked_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = _index(spark, sf_dir)
    path = scratch_path(spark, "ranking")
    scores = termlode.score_all(index, termlode.bm25_scores(index, QUERY))
    termlode.write_ranking(scores, path)
    return _rounded(termlode.read_ranking(spark, path, MOST), BM25_DIGITS)


def bm25_top1000(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(termlode.bm25_search(_index(spark, sf_dir), QUERY, MOST), BM25_DIGITS)


def bm25_long_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text of the first benchmark item as one query of many terms."""
    asked = _benchmark(spark, sf_dir).orderBy("query_id").first()["query"]
    return _rounded(termlode.bm25_search(_index(spark, sf_dir), asked, N), BM25_DIGITS)


def search_with_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = termlode.bm25_search(_index(spark, sf_dir), QUERY, N)
    found = termlode.with_details(_index(spark, sf_dir), hits)
    columns = ["rank", "doc_id", F.col("title").alias("lang"), F.col("url").alias("source")]
    return _rounded(found.select(*columns, "score"), BM25_DIGITS)


def page_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _pages(spark, sf_dir)
    index = prepared_index(pages, f"{sf_dir}/pages")
    found = termlode.with_details(index, termlode.bm25_search(index, PAGE_QUERY, N))
    columns = ["rank", F.col("doc_id").alias("page_id"), "title", "url", "score"]
    return _rounded(found.select(*columns), BM25_DIGITS)


def batch_bm25_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = termlode.bm25_search(_index(spark, sf_dir), _benchmark(spark, sf_dir), N)
    return _rounded(found.withColumnRenamed("query_id", "item_id"), BM25_DIGITS)


def batch_tfdf_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = termlode.tfdf_search(_index(spark, sf_dir), _benchmark(spark, sf_dir), N)
    return _rounded(found.withColumnRenamed("query_id", "item_id"), TFDF_DIGITS)


def batch_bm25_topn_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As a batch too large to broadcast at once."""
    index, queries = _index(spark, sf_dir), _benchmark(spark, sf_dir)
    found = termlode.bm25_search(index, queries, N, broadcast_bytes=SLICE_BYTES)
    return _rounded(found.withColumnRenamed("query_id", "item_id"), BM25_DIGITS)


def batch_tfdf_topn_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    index, queries = _index(spark, sf_dir), _benchmark(spark, sf_dir)
    found = termlode.tfdf_search(index, queries, N, broadcast_bytes=SLICE_BYTES)
    return _rounded(found.withColumnRenamed("query_id", "item_id"), TFDF_DIGITS)


def tfdf_forward_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tfdf")
    forward = termlode.write_tfdf_index(_index(spark, sf_dir), path)
    values = F.transform(F.map_values("weights"), lambda w: F.round(w * 1e9).cast("long"))
    total = F.aggregate(values, F.lit(0).cast("long"), lambda a, w: a + w)
    n_terms = F.size("weights").cast("long").alias("n_terms")
    entries = _entries_md5("weights", lambda w: F.round(w * 1e9).cast("long"))
    return forward.select("doc_id", "len", n_terms, total.alias("weight_sum"), entries)


def unique_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents, an altered copy of some and the same without ids, with one row per id."""
    corpus = _documents(spark, sf_dir)
    some = corpus.where(F.col("doc_id") % 5 == 0)
    copies = some.withColumn("text", F.concat(F.lit("A "), "text"))
    nameless = some.withColumn("doc_id", F.lit(None).cast("long"))
    once = termlode.drop_duplicate_ids(corpus.unionByName(copies).unionByName(nameless))
    return once.select("doc_id", F.md5(F.col("text").cast("binary")).alias("text_md5"))


def _blocked(spark: SparkSession, sf_dir: str) -> termlode.BlockedIndex:
    return prepared_blocked_index(_documents(spark, sf_dir), f"{sf_dir}/documents")


def blocked_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lists of the blocked index, unfolded."""
    rows = postings_of(_blocked(spark, sf_dir).blocks, "term")
    return rows.select("doc_id", "term", *[F.col(c).cast("long").alias(c) for c in ("tf", "len")])


def bm25_topn_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(termlode.pruned_search(_blocked(spark, sf_dir), QUERY, N), BM25_DIGITS)


def batch_bm25_topn_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = termlode.pruned_search(_blocked(spark, sf_dir), _benchmark(spark, sf_dir), N)
    return _rounded(found.withColumnRenamed("query_id", "item_id"), BM25_DIGITS)


def phrase_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(termlode.phrase_search(_blocked(spark, sf_dir), PHRASE, N), BM25_DIGITS)


def phrase_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return termlode.phrase_matches(_blocked(spark, sf_dir), PHRASE)


def proximity_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return termlode.proximity_search(_blocked(spark, sf_dir), CLOSE_TERMS, N)


def boolean_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(termlode.boolean_search(_blocked(spark, sf_dir), CONDITION, MOST), BM25_DIGITS)


def search_snippets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = termlode.search_with_snippets(_blocked(spark, sf_dir), SNIPPET_QUERY, N, AROUND)
    return _rounded(found, BM25_DIGITS)


def facet_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    sets = [(), ("title",), ("url",), ("title", "url")]
    found = termlode.facet_counts(_index(spark, sf_dir), QUERY, sets)
    names = {"title": "lang", "url": "source"}
    return _rounded(found.withColumnsRenamed(names), BM25_DIGITS, "best_score")


def _grown(spark: SparkSession, sf_dir: str) -> str:
    """An index of the documents, of which one language came late and replaced drafts."""
    corpus = _documents(spark, sf_dir)
    late = F.col("title").eqNullSafe(REPLACED)
    draft = F.concat(F.lit("Draft of the theory "), "text")

    def make(root: str) -> str:
        drafts = corpus.withColumn("text", F.when(late, draft).otherwise(F.col("text")))
        termlode.append_documents(drafts, root)
        termlode.append_documents(corpus.where(late), root)
        return root

    return prepared(spark, f"{sf_dir}/grown", make)


def append_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over an index that was built, appended to and partly replaced."""
    index = termlode.load_segments(spark, _grown(spark, sf_dir))
    return _rounded(termlode.bm25_search(index, QUERY, N), BM25_DIGITS)


def append_frequencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frequencies that were added up from two commits, less what was replaced."""
    return termlode.load_segments(spark, _grown(spark, sf_dir)).frequencies


def stream_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over an index that a stream of the documents' files has filled."""
    schema = spark.read.parquet(f"{sf_dir}/documents.parquet").schema

    def make(root: str) -> str:
        # As a pattern, the path may be a file or a folder.
        files = spark.readStream.schema(schema).parquet(f"{sf_dir}/documents.parque[t]")
        arriving = termlode.as_corpus(files, "doc_id", "text", "lang", "source")
        state = scratch_path(spark, "stream-state")
        termlode.ingest_stream(arriving, root, state, "documents").awaitTermination()
        return root

    index = termlode.load_segments(spark, prepared(spark, f"{sf_dir}/streamed", make))
    return _rounded(termlode.bm25_search(index, QUERY, N), BM25_DIGITS)


def _fuzzy(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = _index(spark, sf_dir)

    def make(root: str) -> str:
        termlode.write_fuzzy_index(index, root, EDITS)
        return root

    return termlode.load_fuzzy_index(spark, prepared(spark, f"{sf_dir}/fuzzy", make))


def fuzzy_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All terms of the vocabulary near those of a query with misspellings."""
    found = termlode.fuzzy_terms(_fuzzy(spark, sf_dir), MISSPELT, EDITS)
    return found.select("asked", "term", "distance", "df")


def fuzzy_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = _index(spark, sf_dir)
    found = termlode.fuzzy_search(index, _fuzzy(spark, sf_dir), MISSPELT, N, EDITS)
    return _rounded(found, BM25_DIGITS)


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = _index(spark, sf_dir)
    return prepared(
        spark, f"{sf_dir}/vectors", lambda root: termlode.write_vectors(index, f"{root}/vectors")
    )


def similar_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The terms that keep the company of a query's."""
    found = termlode.similar_terms(_vectors(spark, sf_dir), WIDENED, N)
    return _rounded(found, SIMILARITY_DIGITS, "similarity")


def expanded_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = termlode.expanded_search(_index(spark, sf_dir), _vectors(spark, sf_dir), WIDENED, N)
    return _rounded(found, BM25_DIGITS)


def sketched_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts per language, and whether sketches merged from sources are within their bounds."""
    corpus = _documents(spark, sf_dir)
    parts = termlode.corpus_sketches(corpus, ["title", "url"])
    said = termlode.sketch_estimates(termlode.merge_sketches(parts, ["title"]), N)
    said = said.withColumnsRenamed({"documents": "said_documents", "terms": "said_terms"})
    words = corpus.select("title", F.explode(termlode.tokenize(F.col("text"))).alias("term"))
    counts = words.groupBy("title", "term").agg(F.count("*").alias("n"))
    exact = corpus.groupBy("title").agg(F.count_distinct("doc_id").alias("documents"))
    exact = exact.join(counts.groupBy("title").agg(F.count("*").alias("terms")), "title")
    top = said.select("title", "tokens", F.explode("top_terms").alias("top"))
    top = top.select("title", "tokens", F.col("top.item").alias("term"), F.col("top.count").alias("said"))
    wrong = F.max(F.abs(F.col("said") - F.col("n")) / F.col("tokens")).alias("wrong")
    wrong = top.join(counts, ["title", "term"]).groupBy("title").agg(wrong)

    def close(name: str) -> Column:
        off = F.abs(F.col(f"said_{name}") - F.col(name)) / F.col(name)
        return (off <= sketches.DISTINCT_ERROR).alias(f"{name}_close")

    both = exact.join(said, "title").join(wrong, "title")
    near = (F.col("wrong") <= sketches.COUNT_ERROR).alias("top_close")
    names = [F.col("title").alias("lang"), "documents", "terms", "tokens"]
    return both.select(*names, close("documents"), close("terms"), near)


def unknown_term_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return termlode.bm25_search(_index(spark, sf_dir), UNKNOWN, N)


def entry(spark: SparkSession) -> DataFrame:
    """The flagship query: the ten best documents for one text, by BM25."""
    return bm25_topn(spark, "/root/testdata/sf0.001")


def _optional(name: str) -> ModuleType | None:
    """A module, or None where it or its package is not there."""
    try:
        return importlib.import_module(name)
    except ModuleNotFoundError as error:
        if error.name and (name == error.name or name.startswith(f"{error.name}.")):
            return None
        if error.name and error.name.startswith("termlode.llm"):
            return None
        raise


_llm = _optional("termlode.llm.queries")
_pipeline = _optional("corpus_pipeline")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One entry per operator or pipeline; each takes (spark, sf_dir)."""
    registered = search_queries() | vector_queries()
    if _llm is not None:
        registered |= _llm.queries()
    if _pipeline is not None:
        registered["pipeline"] = _pipeline.run
    return registered


def oracle_sql() -> dict[str, str]:
    """For each query that SQL can express, the same result as DuckDB SQL."""
    registered = search_sql()
    if _llm is not None:
        registered |= _llm.oracle_sql()
    if _pipeline is not None and _pipeline.ORACLE_SQL:
        registered["pipeline"] = _pipeline.ORACLE_SQL
    return registered


def search_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """The queries of the search library itself."""
    registered = [
        json_source_terms,
        raw_source_terms,
        source_metadata,
        tokenize_terms,
        doc_length,
        document_frequency,
        corpus_stats,
        forward_index,
        tfdf_postings,
        query_terms,
        bm25_idf,
        bm25_scores,
        bm25_topn,
        bm25_topn_scaled_tf,
        tfdf_scores,
        tfdf_topn,
        ranked_scores,
        search_with_metadata,
        page_search,
        batch_bm25_topn,
        batch_tfdf_topn,
        unknown_term_query,
        ranked_positions,
        bm25_top1000,
        bm25_long_query,
        batch_bm25_topn_sliced,
        batch_tfdf_topn_sliced,
        tfdf_forward_index,
        unique_documents,
        blocked_postings,
        bm25_topn_pruned,
        batch_bm25_topn_pruned,
        phrase_matches,
        phrase_search,
        proximity_search,
        boolean_search,
        search_snippets,
        facet_counts,
        append_search,
        append_frequencies,
        stream_search,
        fuzzy_terms,
        fuzzy_search,
        sketched_counts,
    ]
    return {query.__name__: query for query in registered}


def vector_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Queries over factors of the index, which SQL can't express."""
    return {query.__name__: query for query in (similar_terms, expanded_search)}


def _tokens_sql(text: str) -> str:
    """Tokens of a text, following the rule step by step and token by token."""
    # The characters that a token loses, and those that part tokens.
    strip = r"""[\\0-9~`!@#$%^&*()\-_+=,.<>?/''":;{}\[\]|]"""
    spaced = (
        rf"regexp_replace(regexp_replace(lower(coalesce({text}, '')), '\\[a-z]', ' ', 'g'),"
        r" '-', ' ', 'g')"
    )
    return (
        rf"list_filter(list_transform(string_split_regex({spaced}, '[ \t\n\r\f]+'),"
        rf" lambda t: regexp_replace(t, '{strip}', '', 'g')), lambda t: t <> '')"
    )


def _index_sql(table: str = "documents", id_col: str = "doc_id", text: str = "text") -> str:
    return f"""
    WITH tokens AS (SELECT {id_col} AS doc_id, {_tokens_sql(text)} AS toks FROM {table}),
    lengths AS (SELECT doc_id, CAST(len(toks) AS BIGINT) AS len FROM tokens),
    words AS (SELECT doc_id, unnest(toks) AS term FROM tokens),
    postings AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY doc_id, term),
    frequencies AS (SELECT term, count(*) AS df FROM postings GROUP BY term),
    stats AS (SELECT count(*) AS n_docs, CAST(sum(len) AS BIGINT) AS total_len,
                     CAST(sum(len) AS DOUBLE) / count(*) AS avg_len FROM lengths)"""


def _query_sql(source: str) -> str:
    """Known terms of queries, from a relation of query_id and query."""
    return f""",
    asked AS (SELECT * FROM {source}),
    asked_words AS (SELECT query_id, unnest({_tokens_sql("query")}) AS term FROM asked),
    asked_terms AS (SELECT query_id, term, count(*) AS qtf FROM asked_words
                    GROUP BY query_id, term),
    known AS (SELECT query_id, term, qtf, df FROM asked_terms JOIN frequencies USING (term))"""


def _one(query: str) -> str:
    return f"(SELECT 0 AS query_id, '{query}' AS query)"


_BENCHMARK_SQL = "(SELECT item_id AS query_id, text AS query FROM benchmark)"
_FIRST_SQL = "(SELECT 0 AS query_id, text AS query FROM benchmark ORDER BY item_id LIMIT 1)"
_IDF_SQL = "ln((n_docs - df + CAST(0.5 AS DOUBLE)) / (df + CAST(0.5 AS DOUBLE)) + 1)"
_TFDF_PART = "(CAST(qtf AS DOUBLE) / df) * (CAST(tf AS DOUBLE) / df)"


def _bm25_part(tf_scale: int = 1) -> str:
    f = f"CAST({tf_scale} * tf AS DOUBLE)"
    k1, b = "CAST(2 AS DOUBLE)", "CAST(0.75 AS DOUBLE)"
    return f"{_IDF_SQL} * ({f} * ({k1} + 1)) / ({f} + {k1} * (1 - {b} + {b} * len / avg_len))"


def _scores_sql(part: str) -> str:
    """Scores of every query over every document, zeros included."""
    return f""",
    hits AS (SELECT query_id, p.doc_id, sum({part}) AS score
             FROM postings p JOIN known USING (term) JOIN lengths USING (doc_id), stats
             GROUP BY query_id, p.doc_id),
    scores AS (SELECT a.query_id, l.doc_id, coalesce(h.score, CAST(0 AS DOUBLE)) AS score
               FROM asked a CROSS JOIN lengths l
               LEFT JOIN hits h ON h.query_id = a.query_id AND h.doc_id = l.doc_id),
    ranked AS (SELECT query_id, doc_id, score,
                      CAST(row_number() OVER (PARTITION BY query_id ORDER BY
                        CASE WHEN score > 0 THEN round(ln(score) * 1e9) END DESC NULLS LAST,
                        doc_id) AS INTEGER) AS rank
               FROM scores)"""


def _search_sql(
    query: str, part: str, digits: int, index: str | None = None, n: int = N, asked: str = ""
) -> str:
    start = (index or _index_sql()) + _query_sql(asked or _one(query)) + _scores_sql(part)
    return f"""{start}
    SELECT rank, doc_id, round(score, {digits}) AS score FROM ranked WHERE rank <= {n}"""


def _all_scores_sql(query: str, part: str, digits: int) -> str:
    start = _index_sql() + _query_sql(_one(query)) + _scores_sql(part)
    return f"{start} SELECT doc_id, round(score, {digits}) AS score FROM scores"


def _batch_sql(part: str, digits: int) -> str:
    start = _index_sql() + _query_sql(_BENCHMARK_SQL) + _scores_sql(part)
    return f"""{start}
    SELECT query_id AS item_id, rank, doc_id, round(score, {digits}) AS score
    FROM ranked WHERE rank <= {N}"""


def _page_sql() -> str:
    text = "regexp_replace(html, '<[^>]*>', ' ', 'g')"
    found = _search_sql(PAGE_QUERY, _bm25_part(), BM25_DIGITS, _index_sql("pages", "page_id", text))
    return f"""SELECT rank, page_id, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS title,
    url, score FROM ({found}) found JOIN pages ON page_id = found.doc_id"""


def _list_sql(items: list[str]) -> str:
    return "[" + ", ".join(f"'{x}'" for x in items) + "]"


def _phrase_sql(phrase: str) -> str:
    """Documents with a phrase: its places by comparing every stretch of its length."""
    words = phrase.split()
    return f"""SELECT doc_id, len(toks) AS len, list_filter(range(len(toks) - {len(words) - 1}),
        lambda i: toks[i + 1 : i + {len(words)}] = {_list_sql(words)}) AS spots FROM tokens"""


_RANKED_SQL = """CAST(row_number() OVER (ORDER BY
    CASE WHEN score > 0 THEN round(ln(score) * 1e9) END DESC NULLS LAST, doc_id) AS INTEGER)"""


def _phrase_search_sql() -> str:
    return f"""{_index_sql()},
    found AS (SELECT * FROM ({_phrase_sql(PHRASE)}) WHERE len(spots) > 0),
    counted AS (SELECT *, len(spots) AS tf, (SELECT count(*) FROM found) AS df FROM found),
    scored AS (SELECT doc_id, {_bm25_part()} AS score, CAST(tf AS INTEGER) AS matches,
                      CAST(spots[1] AS INTEGER) AS first FROM counted, stats)
    SELECT * FROM (SELECT {_RANKED_SQL} AS rank, doc_id, round(score, {BM25_DIGITS}) AS score,
                          matches, first FROM scored) WHERE rank <= {N}"""


# Of documents with toks and terms, the smallest stretch with all terms that starts at a token.
_SPANS_SQL = """
    starts AS (SELECT *, unnest(range(len(toks))) AS first FROM asked_docs),
    spans AS (SELECT doc_id, first, list_transform(terms,
                lambda t: nullif(list_position(toks[first + 1 :], t), 0)) AS ends, terms
              FROM starts WHERE list_contains(terms, toks[first + 1])),
    best AS (SELECT doc_id, min({'span': list_max(ends), 'first': first}) AS b FROM spans
             WHERE list_count(ends) = len(terms) GROUP BY doc_id)"""


def _proximity_sql() -> str:
    terms = _list_sql(CLOSE_TERMS.split())
    return f"""{_index_sql()},
    asked_docs AS (SELECT doc_id, toks, {terms} AS terms FROM tokens
                   WHERE list_has_all(toks, {terms})),{_SPANS_SQL}
    SELECT * FROM (SELECT CAST(row_number() OVER (ORDER BY b.span, doc_id) AS INTEGER) AS rank,
                          doc_id, CAST(b.span AS INTEGER) AS span, CAST(b.first AS INTEGER) AS first
                   FROM best) WHERE rank <= {N}"""


# DuckDB counts edits in bytes: letters of two bytes become signs that no token has.
_ONE_BYTE = """translate({0}, 'äöüßéèêàçùûôîïâëœæáíóúñ', '0123456789!@$%^&*()_+=-')"""


def _near_sql() -> str:
    """Every term of the vocabulary against every term of the query."""
    edits = f"levenshtein({_ONE_BYTE.format('asked')}, {_ONE_BYTE.format('term')})"
    return f"""
    asked AS (SELECT unnest({_list_sql(MISSPELT.split())}) AS asked),
    near AS (SELECT * FROM (SELECT asked, term, CAST({edits} AS INTEGER) AS distance, df
                            FROM asked, frequencies) WHERE distance <= {EDITS})"""


def _boolean_sql() -> str:
    def phrase(text: str) -> str:
        return f"(SELECT doc_id FROM ({_phrase_sql(text)}) WHERE len(spots) > 0)"

    start = _index_sql() + _query_sql(_one("the de la")) + _scores_sql(_bm25_part())
    return f"""{start},
    met AS (SELECT doc_id FROM tokens WHERE
      (list_contains(toks, 'the') OR doc_id IN {phrase("de la")})
      AND NOT (doc_id IN {phrase("of the")}
               OR (list_contains(toks, 'und') AND NOT list_contains(toks, 'des')))),
    -- A term under two nots is wanted again.
    more AS (SELECT p.doc_id, {_bm25_part()} AS part FROM postings p
             JOIN frequencies USING (term) JOIN lengths USING (doc_id), stats WHERE term = 'des'),
    hits_met AS (SELECT doc_id, score + coalesce(part, CAST(0 AS DOUBLE)) AS score
                 FROM scores JOIN met USING (doc_id) LEFT JOIN more USING (doc_id))
    SELECT * FROM (SELECT {_RANKED_SQL} AS rank, doc_id, round(score, {BM25_DIGITS}) AS score
                   FROM hits_met) WHERE rank <= {MOST}"""


def _snippet_sql() -> str:
    terms = _list_sql(SNIPPET_QUERY.split())
    top = _index_sql() + _query_sql(_one(SNIPPET_QUERY)) + _scores_sql(_bm25_part())
    return f"""{top},
    asked_docs AS (SELECT doc_id, toks, list_intersect({terms}, toks) AS terms FROM tokens
                   JOIN ranked USING (doc_id) WHERE rank <= {N}),{_SPANS_SQL},
    cut AS (SELECT doc_id, toks, len(terms) AS found, greatest(0, coalesce(b.first, 0) - {AROUND})
              AS first, least(len(toks) - 1, coalesce(b.first + b.span - 1, 0) + {AROUND}) AS last
            FROM asked_docs LEFT JOIN best USING (doc_id))
    SELECT rank, doc_id, round(score, {BM25_DIGITS}) AS score, CAST(found AS INTEGER) AS found,
           CAST(first AS INTEGER) AS first, CAST(last AS INTEGER) AS last,
           array_to_string(toks[first + 1 : last + 1], ' ') AS snippet
    FROM ranked JOIN cut USING (doc_id) WHERE rank <= {N}"""


def _facet_sql() -> str:
    start = _index_sql() + _query_sql(_one(QUERY)) + _scores_sql(_bm25_part())
    return f"""{start}
    SELECT lang, source, CAST(grouping(lang, source) AS BIGINT) AS level, count(*) AS documents,
           round(max(score), {BM25_DIGITS}) AS best_score
    FROM hits JOIN documents USING (doc_id)
    GROUP BY GROUPING SETS ((), (lang), (source), (lang, source))"""


def search_sql() -> dict[str, str]:
    """For each query of the search library, the same result as DuckDB SQL."""
    index = _index_sql()
    bm25 = _bm25_part()
    top = _search_sql(QUERY, bm25, BM25_DIGITS)
    raw = "' ' || CAST(to_json(text) AS VARCHAR) || '}'"
    by_text_id = "SELECT CAST(doc_id AS VARCHAR) AS doc_id, term, tf FROM postings"
    return {
        "json_source_terms": f"{index} {by_text_id}",
        "raw_source_terms": f"{_index_sql(text=raw)} {by_text_id}",
        "source_metadata": """SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang AS title,
            source AS url FROM documents""",
        "tokenize_terms": f"{index} SELECT doc_id, term, tf FROM postings",
        "doc_length": f"{index} SELECT doc_id, len FROM lengths",
        "document_frequency": f"{index} SELECT term, df FROM frequencies",
        "corpus_stats": f"{index} SELECT n_docs, total_len, round(avg_len, 6) AS avg_len FROM stats",
        "forward_index": f"""{index} SELECT l.doc_id, count(term) AS n_terms,
            CAST(coalesce(sum(tf), 0) AS BIGINT) AS total_tf,
            md5(coalesce(string_agg(term || ':' || tf, ' ' ORDER BY term), '')) AS entries_md5
            FROM lengths l LEFT JOIN postings p ON p.doc_id = l.doc_id GROUP BY l.doc_id""",
        "tfdf_postings": f"""{index} SELECT doc_id, term,
            round(CAST(tf AS DOUBLE) / df, {WEIGHT_DIGITS}) AS weight
            FROM postings JOIN frequencies USING (term)""",
        "query_terms": f"""{index}{_query_sql(_BENCHMARK_SQL)}
            SELECT query_id AS item_id, term, qtf FROM known""",
        "bm25_idf": f"""{index} SELECT term, df, round({_IDF_SQL}, 9) AS idf
            FROM frequencies, stats""",
        "bm25_scores": _all_scores_sql(QUERY, bm25, BM25_DIGITS),
        "bm25_topn": top,
        "bm25_topn_scaled_tf": _search_sql(QUERY, _bm25_part(10), BM25_DIGITS),
        "tfdf_scores": _all_scores_sql(REPEATED, _TFDF_PART, TFDF_DIGITS),
        "tfdf_topn": _search_sql(REPEATED, _TFDF_PART, TFDF_DIGITS),
        "ranked_scores": _all_scores_sql(REPEATED, bm25, BM25_DIGITS),
        "search_with_metadata": f"""SELECT rank, doc_id, lang, source, score
            FROM ({top}) found JOIN documents USING (doc_id)""",
        "page_search": _page_sql(),
        "batch_bm25_topn": _batch_sql(bm25, BM25_DIGITS),
        "batch_tfdf_topn": _batch_sql(_TFDF_PART, TFDF_DIGITS),
        "unknown_term_query": _search_sql(UNKNOWN, bm25, BM25_DIGITS),
        "ranked_positions": _search_sql(QUERY, bm25, BM25_DIGITS, n=MOST),
        "bm25_top1000": _search_sql(QUERY, bm25, BM25_DIGITS, n=MOST),
        "bm25_long_query": _search_sql("", bm25, BM25_DIGITS, asked=_FIRST_SQL),
        "batch_bm25_topn_sliced": _batch_sql(bm25, BM25_DIGITS),
        "batch_tfdf_topn_sliced": _batch_sql(_TFDF_PART, TFDF_DIGITS),
        "tfdf_forward_index": f"""{index} SELECT l.doc_id, any_value(len) AS len,
            count(term) AS n_terms,
            CAST(coalesce(sum(CAST(round(CAST(tf AS DOUBLE) / df * 1e9) AS BIGINT)), 0) AS BIGINT)
              AS weight_sum,
            md5(coalesce(string_agg(term || ':' || CAST(round(CAST(tf AS DOUBLE) / df * 1e9) AS
              BIGINT), ' ' ORDER BY term), '')) AS entries_md5
            FROM lengths l LEFT JOIN (postings JOIN frequencies USING (term)) p
              ON p.doc_id = l.doc_id GROUP BY l.doc_id""",
        "blocked_postings": f"{index} SELECT doc_id, term, tf, len FROM postings JOIN lengths USING (doc_id)",
        "bm25_topn_pruned": top,
        "batch_bm25_topn_pruned": _batch_sql(bm25, BM25_DIGITS),
        "phrase_matches": f"""{index} SELECT doc_id, CAST(len(spots) AS INTEGER) AS matches,
            CAST(spots[1] AS INTEGER) AS first FROM ({_phrase_sql(PHRASE)}) WHERE len(spots) > 0""",
        "phrase_search": _phrase_search_sql(),
        "proximity_search": _proximity_sql(),
        "boolean_search": _boolean_sql(),
        "search_snippets": _snippet_sql(),
        "facet_counts": _facet_sql(),
        "append_search": top,
        "append_frequencies": f"{index} SELECT term, df FROM frequencies",
        "stream_search": top,
        "fuzzy_terms": f"{index},{_near_sql()} SELECT asked, term, distance, df FROM near",
        "sketched_counts": f"""{index} SELECT lang, count(DISTINCT d.doc_id) AS documents,
            count(DISTINCT term) AS terms, CAST(sum(tf) AS BIGINT) AS tokens,
            TRUE AS documents_close, TRUE AS terms_close, TRUE AS top_close
            FROM documents d LEFT JOIN postings p ON p.doc_id = d.doc_id GROUP BY lang""",
        "fuzzy_search": f"""{index},{_near_sql()},
            weights AS (SELECT term, df, min(distance) AS edits FROM near GROUP BY term, df),
            scored AS (SELECT p.doc_id, sum({bm25} / (edits + 1)) AS score
                       FROM postings p JOIN weights USING (term) JOIN lengths USING (doc_id), stats
                       GROUP BY p.doc_id)
            SELECT * FROM (SELECT {_RANKED_SQL} AS rank, doc_id, round(score, {BM25_DIGITS}) AS score
                           FROM scored) WHERE rank <= {N}""",
        "unique_documents": """SELECT doc_id,
            md5(CASE WHEN doc_id % 5 = 0 THEN least(text, 'A ' || text) ELSE text END) AS text_md5
            FROM documents UNION ALL
            SELECT NULL, md5(min(text)) FROM documents WHERE doc_id % 5 = 0""",
    }
