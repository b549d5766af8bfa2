"""Reading a corpus; the ranking sink is in ranking.py."""

from termlode.sources.corpus import (
    as_corpus,
    drop_duplicate_ids,
    read_json_corpus,
    read_raw_corpus,
    spread_few_splits,
)

__all__ = [
    "as_corpus",
    "drop_duplicate_ids",
    "read_json_corpus",
    "read_raw_corpus",
    "spread_few_splits",
]
