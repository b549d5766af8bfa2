"""Registered queries on the generated tables: against SQL, or by what must hold of them."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from termlode.llm import queries

TABLES = ["documents", "pages", "benchmark", "labels", "embeddings", "conversations"]


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_query_equals_sql(spark, sf_dir, name):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    frame = queries.queries()[name](spark, sf_dir)
    columns = sorted(frame.columns)
    got = sorted(map(tuple, frame.select(*columns).collect()), key=repr)
    sql = f"SELECT {', '.join(columns)} FROM ({queries.oracle_sql()[name]})"
    assert got == sorted(connection.execute(sql).fetchall(), key=repr) and got


def test_all_are_registered():
    names = __spark_entry__.queries()
    assert {f"op{n}" for n in range(1, 14)} == {x.split("_")[0] for x in queries.queries()}
    assert set(queries.queries()) <= set(names) and names["pipeline"] is corpus_pipeline.run


def test_pipeline_keeps_clean_documents_and_packs_them(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, sf_dir).cache()
        assert kept.columns == columns and name in dict(corpus_pipeline.STAGES)
        assert 0.7 * docs.count() <= kept.count() <= docs.count()
        docs = kept
    assert docs.count() < before
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).cache()
    assert pieces.select("doc_id").distinct().count() == docs.count()
    by_doc = pieces.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("m"))
    assert by_doc.where("n <> m").count() == 0
    sizes = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    assert sizes.where("n > 2048 OR n <> 2048 AND bit_count(n) <> 1").count() == 0
