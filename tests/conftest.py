import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import termlode  # noqa: E402

HAND = [
    (1, "Red apple, red pear."),
    (2, "Apple-pie apple!"),
    (3, "1999 ..."),
    (4, "Green tree"),
]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("termlode-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_corpus(spark):
    def make(rows):
        frame = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
        return termlode.as_corpus(frame, "doc_id", "text")

    return make


@pytest.fixture(scope="session")
def hand_index(make_corpus):
    return termlode.build_index(make_corpus(HAND))


@pytest.fixture(scope="session")
def stored(make_corpus, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("stored") / "index")
    return root, termlode.write_index(make_corpus(HAND), root, shards=3)
