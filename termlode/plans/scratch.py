"""Indexes that are written once per session, and the shared folder that holds them."""

from __future__ import annotations

from collections.abc import Callable
from typing import TYPE_CHECKING, Any

from pyspark.sql import DataFrame, SparkSession

from termlode.plans.index import SearchIndex, write_index
from termlode.plans.shared import scratch_path, settle, shared_folder

if TYPE_CHECKING:
    from termlode.plans.blocks import BlockedIndex


__all__ = [
    "prepared",
    "prepared_blocked_index",
    "prepared_index",
    "scratch_path",
    "settle",
    "shared_folder",
]

_prepared: dict[tuple[str, str], Any] = {}


def prepared(spark: SparkSession, name: str, make: Callable[[str], Any]) -> Any:
    """What ``make`` writes below a new folder, made once per session and name."""
    key = (spark.sparkContext.applicationId, name)
    if key not in _prepared:
        _prepared[key] = make(scratch_path(spark, "index"))
    return _prepared[key]


def prepared_index(corpus: DataFrame, name: str) -> SearchIndex:
    """An index of a corpus straight from files, written once per session and name."""
    return prepared(corpus.sparkSession, name, lambda root: write_index(corpus, root))


def prepared_blocked_index(corpus: DataFrame, name: str) -> BlockedIndex:
    """The same for a blocked index."""
    from termlode.plans.blocks import write_blocked_index

    return prepared(
        corpus.sparkSession, f"{name}/blocked", lambda root: write_blocked_index(corpus, root)
    )
