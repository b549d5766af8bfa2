"""Ranked full-text search over large document collections, as Spark jobs."""

from termlode.functions.scoring import bm25_idf, bm25_term_score, tfdf_weight
from termlode.functions.text import term_counts, tokenize
from termlode.plans.blocks import (
    BlockedIndex,
    load_blocked_index,
    write_blocked_index,
)
from termlode.plans.fuzzy import (
    fuzzy_search,
    fuzzy_terms,
    load_fuzzy_index,
    write_fuzzy_index,
)
from termlode.plans.index import (
    SearchIndex,
    build_index,
    load_index,
    load_tfdf_index,
    suggest_shards,
    tfdf_forward,
    tfdf_postings,
    write_index,
    write_tfdf_index,
)
from termlode.plans.matching import (
    Condition,
    boolean_search,
    has,
    phrase_matches,
    phrase_search,
    proximity_search,
    search_with_snippets,
    with_snippets,
)
from termlode.plans.pruning import pruned_search
from termlode.plans.search import (
    bm25_scores,
    bm25_search,
    facet_counts,
    known_query_terms,
    score_all,
    tfdf_scores,
    tfdf_search,
    with_details,
    with_metadata,
)
from termlode.plans.segments import (
    CommitConflict,
    append_documents,
    delete_documents,
    ingest_stream,
    load_segments,
    merge_segments,
)
from termlode.plans.sketches import corpus_sketches, merge_sketches, sketch_estimates
from termlode.plans.vectors import (
    expanded_search,
    similar_terms,
    term_vectors,
    write_vectors,
)
from termlode.sources import (
    as_corpus,
    drop_duplicate_ids,
    read_json_corpus,
    read_raw_corpus,
    spread_few_splits,
)
from termlode.sources.ranking import read_ranking, write_ranking

__all__ = [
    "BlockedIndex",
    "CommitConflict",
    "Condition",
    "SearchIndex",
    "append_documents",
    "as_corpus",
    "bm25_idf",
    "bm25_scores",
    "bm25_search",
    "bm25_term_score",
    "boolean_search",
    "build_index",
    "corpus_sketches",
    "delete_documents",
    "drop_duplicate_ids",
    "expanded_search",
    "facet_counts",
    "fuzzy_search",
    "fuzzy_terms",
    "has",
    "ingest_stream",
    "known_query_terms",
    "load_blocked_index",
    "load_fuzzy_index",
    "load_index",
    "load_segments",
    "load_tfdf_index",
    "merge_segments",
    "merge_sketches",
    "phrase_matches",
    "phrase_search",
    "proximity_search",
    "pruned_search",
    "read_json_corpus",
    "read_ranking",
    "read_raw_corpus",
    "score_all",
    "search_with_snippets",
    "similar_terms",
    "sketch_estimates",
    "spread_few_splits",
    "suggest_shards",
    "term_counts",
    "term_vectors",
    "tfdf_forward",
    "tfdf_postings",
    "tfdf_scores",
    "tfdf_search",
    "tfdf_weight",
    "tokenize",
    "with_details",
    "with_metadata",
    "with_snippets",
    "write_blocked_index",
    "write_fuzzy_index",
    "write_index",
    "write_ranking",
    "write_tfdf_index",
    "write_vectors",
]
