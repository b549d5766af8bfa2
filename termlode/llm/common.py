"""Small helpers shared by the operators."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from termlode.plans.scratch import scratch_path

# Texts are handled in pieces of about so many bytes, which bounds a task's arrays.
SLICE_BYTES = 1 << 20
BATCH_BYTES = 8 << 20
# Rows of a few numbers each up to which a side of a join is broadcast.
BROADCAST_ROWS = 500_000
# Labels are learnt from rows whose crc32(doc_id as text) mod 3 is not 1.
FOLDS, HELD_OUT_FOLD = 3, 1


def to_tasks(frame: DataFrame, work, schema) -> DataFrame:
    """frame.mapInArrow with batches of bounded size.

    Spark fills a batch to 64 MB by default, of which a task holds several copies. The
    session's setting is read when the frame is executed, so it is lowered here; one that is
    lower already stays.
    """
    conf, name = frame.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if not 0 < _as_bytes(frame, conf.get(name)) <= BATCH_BYTES:
        conf.set(name, BATCH_BYTES)
    return frame.mapInArrow(work, schema)


def _as_bytes(frame: DataFrame, size: str) -> int:
    """A size as Spark's settings write it; no bound is written as a negative number."""
    if size.lstrip("-").isdigit():
        return int(size)
    java = frame.sparkSession._jvm.org.apache.spark.network.util.JavaUtils
    return java.byteStringAsBytes(size)


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The frame written once to the shared folder and read again.

    Cuts the lineage: a lost executor costs a read, not a recomputation.
    """
    spark = frame.sparkSession
    path = scratch_path(spark, name)
    frame.write.parquet(path)
    written = spark.read.schema(frame.schema).parquet(path)
    written.scratch_path = path
    return written


def discard(written: DataFrame) -> None:
    """Deletes a stored frame of which nothing more is read."""
    spark = written.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(written.scratch_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def broadcast_if_small(frame: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A stored frame of a few numbers a row, broadcast if it has at most so many rows."""
    return F.broadcast(frame) if frame.count() <= rows else frame


def text_slices(
    batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES
) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Arrow batches cut into slices of about ``limit`` bytes, with their texts.

    A null text is an empty one. A longer text is a slice of its own.
    """
    for batch in batches:
        lengths = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0))
        size, cuts = 0, [0]
        for i, length in enumerate(lengths.tolist()):
            if size and size + length > limit:
                cuts.append(i)
                size = 0
            size += length
        for start, end in zip(cuts, [*cuts[1:], batch.num_rows], strict=True):
            if end > start:
                part = batch.slice(start, end - start)
                yield part, [t or "" for t in part.column(column).to_pylist()]


def appended(
    documents: DataFrame,
    name: str,
    kind: DataType,
    compute: Callable[[], Callable[[list[str]], pa.Array]],
) -> DataFrame:
    """All rows and columns, and one more that is computed from the texts in the tasks.

    ``compute`` is called once per task and returns a function of a list of texts.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values_of = compute()
        for batch, texts in text_slices(batches):
            columns = [*batch.columns, values_of(texts)]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, name])

    schema = StructType([*documents.schema.fields, StructField(name, kind)])
    return to_tasks(documents, work, schema)


def fresh_name(frame: DataFrame, name: str) -> str:
    """A column name that the frame doesn't have."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def held_out(column: str = "doc_id"):
    """Whether a row belongs to the fold that labels are not learnt from."""
    fold = F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % FOLDS
    return fold == HELD_OUT_FOLD


def fold_of(doc_id: object) -> int:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % FOLDS
