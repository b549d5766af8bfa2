"""Times the index build and the headline searches; prints one JSON line.

Environment: BENCH_SF_DIR (tables), BENCH_CPUS (cores of the local master).
"""

from __future__ import annotations

import json
import os
import tempfile
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import termlode

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = os.environ.get("BENCH_CPUS", "8")
QUERY, PHRASE = "the theory of inter", "of the"
N = 10
RUNS = 3


def session(scratch: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("termlode-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", f"{scratch}/checkpoint")
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(frame: DataFrame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def best_of(work: Callable[[], None], runs: int = RUNS) -> float:
    """Seconds of the fastest run, so that JVM warm-up does not count."""
    times = []
    for _ in range(runs):
        start = time.perf_counter()
        work()
        times.append(time.perf_counter() - start)
    return round(min(times), 3)


def main() -> None:
    scratch = tempfile.mkdtemp(prefix="termlode-bench-")
    spark = session(scratch)
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    corpus = termlode.as_corpus(documents, "doc_id", "text", "lang", "source")
    queries = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("query")
    )

    built: list[termlode.SearchIndex] = []

    def build() -> None:
        root = f"{scratch}/index-{len(built)}"
        built.append(termlode.write_index(corpus, root))

    start = time.perf_counter()
    build()
    cold = round(time.perf_counter() - start, 3)
    timed = {"index_build": best_of(build, 2)}
    index = built[-1]
    blocked: list[termlode.BlockedIndex] = []

    def build_blocked() -> None:
        root = f"{scratch}/blocked-{len(blocked)}"
        blocked.append(termlode.write_blocked_index(corpus, root))

    timed["blocked_build"] = best_of(build_blocked, 2)
    lazy = termlode.build_index(termlode.spread_few_splits(corpus.select("doc_id", "text")))
    long_query = queries.orderBy("query_id").first()["query"]
    searches: dict[str, Callable[[], DataFrame]] = {
        "document_frequency": lambda: lazy.frequencies,
        "tfdf_postings": lambda: termlode.tfdf_postings(index),
        "bm25_single": lambda: termlode.bm25_search(index, QUERY, N),
        "tfdf_single": lambda: termlode.tfdf_search(index, QUERY, N),
        "bm25_all_documents": lambda: termlode.score_all(index, termlode.bm25_scores(index, QUERY)),
        "bm25_batch": lambda: termlode.bm25_search(index, queries, N),
        "tfdf_batch": lambda: termlode.tfdf_search(index, queries, N),
        "search_with_metadata": lambda: termlode.with_details(
            index, termlode.bm25_search(index, QUERY, N)
        ),
        "bm25_long_query": lambda: termlode.bm25_search(index, long_query, N),
        "bm25_batch_sliced": lambda: termlode.bm25_search(
            index, queries, N, broadcast_bytes=100_000
        ),
        "bm25_pruned": lambda: termlode.pruned_search(blocked[-1], QUERY, N),
        "bm25_batch_pruned": lambda: termlode.pruned_search(blocked[-1], queries, N),
        "phrase_search": lambda: termlode.phrase_search(blocked[-1], PHRASE, N),
    }
    for name, search in searches.items():
        timed[name] = best_of(lambda search=search: run(search()))

    stats = index.stats.first()
    report = {
        "metric": "index build and searches, total of fastest runs",
        "value": round(sum(timed.values()), 3),
        "unit": "sec",
        "queries": timed,
        "sf": SF_DIR.rsplit("sf", 1)[-1],
        "index_build_cold": cold,
        "documents": stats["n_docs"],
        "tokens": stats["total_len"],
        "postings": stats["n_postings"],
        "batch_queries": queries.count(),
        "cpus": int(CPUS),
    }
    spark.stop()
    print(json.dumps(report))


if __name__ == "__main__":
    main()
