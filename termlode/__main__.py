"""The two batch jobs, for spark-submit or ``python -m termlode``.

    index CORPUS INDEX
    search QUERY N INDEX OUTPUT

CORPUS is a folder of JSON lines (id, url, title, text). INDEX and OUTPUT must not
exist when they are written. A search writes the scores of all documents to OUTPUT
and prints the best N as lines of rank, id, title, URL and score.
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import DataFrame, SparkSession

import termlode
from termlode.operators.topn import check_result_count


def _location(path: str) -> str:
    """Paths without a scheme are taken from the working folder."""
    return path if ":/" in path else os.path.abspath(path)


def _corpus(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    read = termlode.read_raw_corpus if args.raw else termlode.read_json_corpus
    return read(spark, _location(args.corpus))


def index(spark: SparkSession, args: argparse.Namespace) -> None:
    termlode.write_index(_corpus(spark, args), _location(args.index), args.shards)


def search(spark: SparkSession, args: argparse.Namespace) -> None:
    check_result_count(args.n)
    stored = termlode.load_index(spark, _location(args.index))
    if args.ranking == "bm25":
        hits = termlode.bm25_scores(stored, args.query, tf_scale=args.tf_scale)
    else:
        hits = termlode.tfdf_scores(stored, args.query)
    output = _location(args.output)
    termlode.write_ranking(termlode.score_all(stored, hits), output)

    top = termlode.read_ranking(spark, output, args.n)
    for row in termlode.with_details(stored, top).orderBy("rank").collect():
        print(*[row[c] for c in ("rank", "doc_id", "title", "url", "score")], sep="\t")


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="termlode")
    jobs = parser.add_subparsers(required=True)

    build = jobs.add_parser("index", help="build an index of a corpus folder")
    build.add_argument("corpus")
    build.add_argument("index")
    build.add_argument("--shards", type=int, help="number of buckets")
    build.set_defaults(job=index)

    ask = jobs.add_parser("search", help="rank all documents for one query")
    ask.add_argument("query")
    ask.add_argument("n", type=int, help="number of results to print, 0 to 1000")
    ask.add_argument("index")
    ask.add_argument("output")
    ask.add_argument("--ranking", choices=["bm25", "tfdf"], default="bm25")
    ask.add_argument("--tf-scale", type=float, default=1.0, help="factor on tf in BM25")
    ask.set_defaults(job=search)

    build.add_argument("--raw", action="store_true", help="do not decode escapes in the text")

    args = parser.parse_args(arguments)
    args.job(SparkSession.builder.appName("termlode").getOrCreate(), args)


if __name__ == "__main__":
    main()
