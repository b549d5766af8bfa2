"""An index that grows: segments, a manifest, and statistics that add up.

Every commit adds an entry: a segment, which is an index of the documents that came with it,
or deletions alone. A document with the id of an earlier one replaces it. What an entry
makes obsolete is listed with it, together with what that takes away from the statistics, so
that those of the whole are sums over all entries. A version of the index is one small
manifest file that names its entries; it appears by a rename that fails if the version
exists, so a commit is seen as a whole or not at all, and of two writers one is told to try
again. Older versions stay readable.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from termlode.operators import tables
from termlode.operators.topn import first_documents
from termlode.plans import index as plain
from termlode.plans.index import SearchIndex, load_index, write_index, write_parts
from termlode.sources.corpus import BROADCAST_ROWS, drop_duplicate_ids

_VERSION = "{:012d}.json"


class CommitConflict(RuntimeError):
    """Another writer has committed the same version; the commit can be tried again."""


def _filesystem(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def versions(spark: SparkSession, root: str) -> list[int]:
    """The committed versions, oldest first."""
    place, files = _filesystem(spark, f"{root}/manifest")
    if not files.exists(place):
        return []
    names = [status.getPath().getName() for status in files.listStatus(place)]
    return sorted(int(name[:12]) for name in names if name.endswith(".json"))


def _entries(spark: SparkSession, root: str, version: int | None) -> tuple[int, list[dict]]:
    """A version, by default the last, and its entries in the order of their commits."""
    plain.check_location(root)
    found = versions(spark, root)
    if version is None:
        version = found[-1] if found else 0
    elif version not in found:
        raise ValueError(f"there is no version {version} below {root}")
    if not version:
        return 0, []
    path = f"{root}/manifest/{_VERSION.format(version)}"
    lines = spark.read.text(path).collect()
    return version, [json.loads(row["value"]) for row in lines]


def _commit(spark: SparkSession, root: str, version: int, entries: list[dict]) -> None:
    """Makes the manifest of a version appear, unless there is one."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    draft, files = _filesystem(spark, f"{root}/manifest/.draft-{uuid.uuid4().hex}")
    stream = files.create(draft, False)
    try:
        stream.write("\n".join(json.dumps(entry) for entry in entries).encode())
    finally:
        stream.close()
    target, _ = _filesystem(spark, f"{root}/manifest/{_VERSION.format(version)}")
    options = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    options[0] = getattr(hadoop.Options.Rename, "NONE")
    context = hadoop.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(draft, target, options)
    except Exception as error:
        files.delete(draft, False)
        if not files.exists(target):
            raise
        raise CommitConflict(f"version {version} of {root} was committed meanwhile") from error


def _folder(root: str, entry: dict) -> str:
    return f"{root}/entries/{entry['name']}"


def _segment(spark: SparkSession, root: str, entry: dict) -> SearchIndex:
    return load_index(spark, f"{_folder(root, entry)}/index")


def _obsolete(spark: SparkSession, root: str, later: list[dict], name: str) -> DataFrame | None:
    """dead_id: what later entries have made obsolete in a segment; None for nothing."""
    gone = [e for e in later if e["dead"].get(name)]
    if not gone:
        return None
    parts = [
        spark.read.parquet(f"{_folder(root, e)}/dead").where(F.col("segment") == name) for e in gone
    ]
    ids = reduce(DataFrame.unionByName, parts).select(F.col("doc_id").alias("dead_id"))
    small = sum(e["dead"][name] for e in gone) <= BROADCAST_ROWS
    return F.broadcast(ids) if small else ids


def _alive(frame: DataFrame, obsolete: DataFrame | None) -> DataFrame:
    if obsolete is None:
        return frame
    return frame.join(obsolete, F.col("doc_id").eqNullSafe(F.col("dead_id")), "left_anti")


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _live(spark: SparkSession, root: str, entries: list[dict], part: str) -> DataFrame | None:
    """One table of all segments without what is obsolete, and the segment's name."""
    found = []
    for k, entry in enumerate(entries):
        if entry["documents"]:
            frame = getattr(_segment(spark, root, entry), part)
            alive = _alive(frame, _obsolete(spark, root, entries[k + 1 :], entry["name"]))
            found.append(alive.withColumn("segment", F.lit(entry["name"])))
    return _union(found) if found else None


def _write_entry(
    spark: SparkSession, root: str, name: str, ids: DataFrame, segment: SearchIndex | None
) -> int:
    """Writes what an entry takes away from earlier ones, then commits it; the new version."""
    version, entries = _entries(spark, root, None)
    folder = f"{root}/entries/{name}"
    forward = _live(spark, root, entries, "forward")
    dead = {}
    if forward is not None:
        key = ids.select(F.col("doc_id").alias("new_id"))
        same = F.col("doc_id").eqNullSafe(F.col("new_id"))
        forward.join(key, same, "left_semi").write.parquet(f"{folder}/dead")
        gone = spark.read.parquet(f"{folder}/dead")
        dead = {r["segment"]: r["count"] for r in gone.groupBy("segment").count().collect()}
    if dead:
        lost = tables.document_frequency(tables.postings(gone.drop("segment")))
        lost.select("term", (-F.col("df")).alias("df")).sort("term").write.parquet(f"{folder}/lost")
    entry = {"name": name, "documents": segment is not None, "dead": dead}
    lengths = _live(spark, root, [*entries, entry], "forward")
    if lengths is not None:
        first_documents(lengths.drop("segment")).write.parquet(f"{folder}/first_docs")
    _commit(spark, root, version + 1, [*entries, entry])
    return version + 1


def append_documents(
    corpus: DataFrame, root: str, shards: int | None = None, name: str | None = None
) -> int:
    """Adds documents to the index below ``root``, which need not exist; the new version.

    A document with an id that is already there replaces the older one. Ids must be unique
    in the corpus. The text of earlier documents is not read, and neither are their
    postings: only the ids, and the terms of what is replaced. ``name`` makes a commit
    repeatable: if an entry has it already, nothing happens and the version stays.
    """
    spark = corpus.sparkSession
    version, entries = _entries(spark, root, None)
    if name is not None and any(name in (e["name"], *e.get("merged", [])) for e in entries):
        return version
    # An attempt that failed before its commit may have left a folder of this name.
    folder = name or uuid.uuid4().hex
    place, files = _filesystem(spark, f"{root}/entries/{folder}")
    if files.exists(place):
        files.delete(place, True)
    segment = write_index(corpus, f"{root}/entries/{folder}/index", shards)
    return _write_entry(spark, root, folder, segment.forward, segment)


def delete_documents(ids: DataFrame, root: str) -> int:
    """Takes documents (doc_id) out of the index; ids that it does not have are no matter."""
    spark = ids.sparkSession
    return _write_entry(spark, root, uuid.uuid4().hex, ids.select("doc_id").distinct(), None)


def merge_segments(spark: SparkSession, root: str, shards: int | None = None) -> int:
    """Rewrites what is alive of all segments as one; the new version.

    No text is read: the new segment comes from the forward rows of the old ones. A search
    then opens one segment again. Earlier versions keep theirs. ``shards`` is by default that
    of the largest segment.
    """
    version, entries = _entries(spark, root, None)
    forward = _live(spark, root, entries, "forward")
    if forward is None:
        raise ValueError(f"there are no documents below {root}")
    if shards is None:
        folders = [_folder(root, e) for e in entries if e["documents"]]
        shards = max(spark.read.parquet(f"{x}/index/stats").first()["shards"] for x in folders)
    entry = {"name": uuid.uuid4().hex, "documents": True, "dead": {}}
    rows = forward.drop("segment").repartition(shards, "doc_id")
    details = _live(spark, root, entries, "details").drop("segment")
    segment = write_parts(rows, details, f"{_folder(root, entry)}/index", shards)
    segment.first_docs.write.parquet(f"{_folder(root, entry)}/first_docs")
    # Streams find their commits by name, also those before the merge.
    entry["merged"] = [name for e in entries for name in [e["name"], *e.get("merged", [])]]
    _commit(spark, root, version + 1, [entry])
    return version + 1


def load_segments(spark: SparkSession, root: str, version: int | None = None) -> SearchIndex:
    """The index as of a version, by default the last, as one for all searches.

    Rows of replaced documents are left out where they stand; frequencies and statistics
    are sums over the entries. The frequencies of a query's terms are pushed below the sum.
    """
    number, entries = _entries(spark, root, version)
    segments = {e["name"]: _segment(spark, root, e) for e in entries if e["documents"]}
    if not segments:
        raise ValueError(f"version {number} below {root} has no documents")
    counted = [s.frequencies.select("term", "df") for s in segments.values()]
    lost = [e for e in entries if e["dead"]]
    counted += [spark.read.parquet(f"{_folder(root, e)}/lost") for e in lost]
    frequencies = _union(counted).groupBy("term").agg(F.sum("df").alias("df")).where("df > 0")
    sums = [s.stats.select("n_docs", "total_len", "n_postings") for s in segments.values()]
    for entry in lost:
        gone = spark.read.parquet(f"{_folder(root, entry)}/dead")
        sums.append(
            gone.agg(
                (-F.count("*")).alias("n_docs"),
                (-F.sum("len")).alias("total_len"),
                (-F.sum(F.size("terms"))).alias("n_postings"),
            )
        )
    stats = _union(sums).agg(*[F.sum(c).alias(c) for c in ("n_docs", "total_len", "n_postings")])
    avg_len = F.when(F.col("n_docs") > 0, F.col("total_len") / F.col("n_docs"))
    # One row, but the sum of many entries: computed once per loaded version.
    stats = stats.select("n_docs", "total_len", avg_len.alias("avg_len"), "n_postings")
    row = stats.first()
    stats = spark.createDataFrame([row], stats.schema)

    def live(part: str) -> DataFrame:
        return _live(spark, root, entries, part).drop("segment")

    return SearchIndex(
        forward=live("forward"),
        postings=live("postings"),
        frequencies=frequencies,
        stats=stats,
        first_docs=spark.read.parquet(f"{_folder(root, entries[-1])}/first_docs"),
        details=live("details"),
    )


def ingest_stream(
    stream: DataFrame, root: str, checkpoint: str, name: str, shards: int | None = None
) -> StreamingQuery:
    """Starts appending a stream of documents (doc_id, text, title, url); the running query.

    Each micro-batch is one commit under the name of the stream and the batch's number. A
    batch that is run again after a failure finds its commit and does nothing, so every
    document is indexed exactly once, whenever the query stops. A repeated id replaces
    the earlier document, within a batch as drop_duplicate_ids does, and needs no state.
    """

    def each(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            append_documents(drop_duplicate_ids(batch), root, shards, f"{name}-{number:012d}")

    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).queryName(name).start()
