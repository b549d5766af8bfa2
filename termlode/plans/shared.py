"""The shared folder for tables that outlive one plan."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str | None:
    """The session's checkpoint folder; a temporary one only on a local master.

    None on a cluster that names no folder: a folder of one machine would be of
    no use to the others.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None and context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="termlode-"))
    return context.getCheckpointDir()


def settle(frame: DataFrame) -> DataFrame:
    """The frame as a checkpoint, for what is used twice and must be the same each time."""
    spark = frame.sparkSession
    folder = _required_folder(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return frame.checkpoint()


def _required_folder(spark: SparkSession) -> str:
    folder = shared_folder(spark)
    if folder is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{_required_folder(spark)}/termlode-{name}-{uuid.uuid4().hex}"


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Settings of a session for what is run inside, and its own ones after that."""
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
