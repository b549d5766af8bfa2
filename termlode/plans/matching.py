"""Phrases, proximity, boolean conditions and snippets, from the positions of a blocked index.

All of it runs where a range stands: the lists of the asked terms are unfolded, grouped by
document without a shuffle, and intersected by built-in array functions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termlode.functions import scoring
from termlode.functions.text import tokenize
from termlode.operators.topn import best_of_one, check_result_count
from termlode.plans.blocks import BlockedIndex
from termlode.plans.pruning import pruned_search
from termlode.plans.scratch import settle
from termlode.plans.search import FILTER_TERMS, narrow

# Leaves of a condition per long of bits.
WORD_BITS = 62


def _tokens(index: BlockedIndex, text: str) -> list[str]:
    one = index.stats.sparkSession.range(0, 1, 1, 1)
    return one.select(tokenize(F.lit(text)).alias("tokens")).first()["tokens"]


def _asked_blocks(index: BlockedIndex, terms: list[str]) -> DataFrame:
    return narrow(index.blocks, terms if len(terms) <= FILTER_TERMS else None)


def _with_positions(blocks: DataFrame, *columns: str) -> DataFrame:
    """A row per posting: range, the given columns, doc_id, tf, len and positions."""
    rows = blocks.select(
        "range", *columns, F.explode(F.arrays_zip("docs", "tfs", "lens", "positions")).alias("p")
    )
    names = {"docs": "doc_id", "tfs": "tf", "lens": "len", "positions": "positions"}
    return rows.select("range", *columns, *[F.col(f"p.{a}").alias(b) for a, b in names.items()])


def _phrase_rows(index: BlockedIndex, tokens: list[str]) -> DataFrame:
    """range, doc_id, len, starts: documents with all tokens in a row, and where."""
    spark = index.stats.sparkSession
    offsets: dict[str, list[int]] = {}
    for at, token in enumerate(tokens):
        offsets.setdefault(token, []).append(at)
    terms = spark.createDataFrame(list(offsets.items()), "term string, offsets array<int>")
    blocks = _asked_blocks(index, list(offsets)).join(F.broadcast(terms), "term")
    rows = _with_positions(blocks, "offsets")
    # Where the phrase starts, as far as one of its terms can tell.
    first = F.get("offsets", F.lit(0))
    starts = F.filter(
        F.transform("positions", lambda at: at - first),
        lambda start: (start >= 0)
        & F.forall("offsets", lambda o: (o == first) | F.array_contains("positions", start + o)),
    )
    rows = rows.select("range", "doc_id", "len", starts.alias("starts"))
    rows = rows.where(F.size("starts") > 0)
    # From the shortest list on, so that an intersection is never longer than that.
    sized = F.collect_list(F.struct(F.size("starts").alias("n"), "starts"))
    lists = rows.groupBy("range", "doc_id").agg(
        F.first("len").alias("len"), F.sort_array(sized).alias("lists")
    )
    lists = lists.where(F.size("lists") == len(offsets))
    common = F.aggregate(
        F.slice("lists", 2, len(offsets)),
        F.get("lists", F.lit(0))["starts"],
        lambda found, other: F.array_intersect(found, other["starts"]),
    )
    found = lists.select("range", "doc_id", "len", common.alias("starts"))
    return found.where(F.size("starts") > 0)


def phrase_matches(index: BlockedIndex, phrase: str) -> DataFrame:
    """doc_id, matches, first: documents with the phrase's tokens in a row.

    ``matches`` counts the places, which may overlap, and ``first`` is the smallest, counted
    in tokens from 0. A phrase without tokens matches nothing.
    """
    tokens = _tokens(index, phrase)
    if not tokens:
        none = index.first_docs.where("false")
        return none.select("doc_id", F.lit(0).alias("matches"), F.lit(0).alias("first"))
    return _phrase_rows(index, tokens).select(
        "doc_id", F.size("starts").alias("matches"), F.array_min("starts").alias("first")
    )


def phrase_search(
    index: BlockedIndex, phrase: str, n: int, k1: float = scoring.K1, b: float = scoring.B
) -> DataFrame:
    """rank, doc_id, score, matches, first: the n best documents with a phrase.

    The phrase is ranked by BM25 like a term: its matches are its frequency, and the
    documents that have it its document frequency.
    """
    check_result_count(n)
    scoring.check_bm25(k1, b)
    tokens = _tokens(index, phrase)
    empty = index.forward.select("range", "doc_id", "len", F.array(F.lit(0)).alias("starts"))
    rows = _phrase_rows(index, tokens) if tokens else empty.where("false")
    places = [F.size("starts").alias("matches"), F.array_min("starts").alias("first")]
    found = settle(rows.select("doc_id", "len", *places))
    df = found.agg(F.count("*").alias("df")).scalar()
    idf = scoring.bm25_idf(df, index.stat("n_docs"))
    part = scoring.bm25_term_score(
        idf, F.col("matches").cast("double"), F.col("len"), index.stat("avg_len"), k1, b
    )
    top = best_of_one(found.select("doc_id", part.alias("score"), "matches", "first"), n)
    return _ranked(top, scoring.rank_order()).select("rank", "doc_id", "score", "matches", "first")


def _ranked(top: DataFrame, order: list[Column]) -> DataFrame:
    """At most a thousand rows with their rank."""
    row = F.struct(*top.columns).alias("row")
    listed = top.orderBy(*order).coalesce(1).select(row).agg(F.collect_list("row").alias("rows"))
    placed = listed.select(F.posexplode("rows").alias("at", "row"))
    return placed.select((F.col("at") + 1).cast("int").alias("rank"), "row.*")


def _smallest_span(places: Column, terms: Column) -> Column:
    """Struct of span and first: the smallest stretch that holds every one of ``terms`` terms.

    ``places`` are structs of at and term (0 to terms - 1), sorted by place. They are read once,
    with the last place of each term at hand; the earliest of equal stretches is taken.
    """
    none = F.struct(F.lit(None).cast("int").alias("span"), F.lit(None).cast("int").alias("first"))
    start = F.struct(
        F.array_repeat(F.lit(None).cast("int"), terms).alias("last"), none.alias("best")
    )

    def step(state: Column, place: Column) -> Column:
        last = F.transform(
            state["last"],
            lambda at, term: F.when(term == place["term"], place["at"]).otherwise(at),
        )

        def judged(last: Column) -> Column:
            first = F.array_min(last)
            span = F.struct((place["at"] - first + 1).alias("span"), first.alias("first"))
            whole = F.size(F.array_compact(last)) == terms
            better = whole & (state["best"]["span"].isNull() | (span < state["best"]))
            return F.struct(
                last.alias("last"), F.when(better, span).otherwise(state["best"]).alias("best")
            )

        return F.get(F.transform(F.array(last), judged), F.lit(0))

    return F.aggregate(places, start, step, lambda state: state["best"])


def proximity_search(index: BlockedIndex, text: str, n: int) -> DataFrame:
    """rank, doc_id, span, first: documents with all terms of a text, closest together first.

    ``span`` is the length in tokens of the smallest stretch that holds every term of the text
    in any order, and ``first`` its earliest start. Equal spans are ranked by id. A text
    without tokens has no hits.
    """
    check_result_count(n)
    spark = index.stats.sparkSession
    terms = sorted(set(_tokens(index, text)))
    named = spark.createDataFrame(list(zip(terms, count())), "term string, number int")
    blocks = _asked_blocks(index, terms).join(F.broadcast(named), "term")
    rows = _with_positions(blocks, "number")
    place = F.transform(
        "positions", lambda at: F.struct(at.alias("at"), F.col("number").alias("term"))
    )
    rows = rows.select("range", "doc_id", place.alias("places"))
    lists = rows.groupBy("range", "doc_id").agg(F.collect_list("places").alias("lists"))
    lists = lists.where(F.size("lists") == max(1, len(terms)))
    places = F.sort_array(F.flatten("lists"))
    spans = lists.select("doc_id", _smallest_span(places, F.lit(len(terms))).alias("best"))
    spans = spans.select("doc_id", "best.span", "best.first")
    order = [F.col("span"), F.col("doc_id")]
    return _ranked(spans.orderBy(*order).limit(n), order)


class Condition:
    """A condition on documents: ``has(text)``, and any of & (and), | (or), ~ (not) of them."""

    def __and__(self, other: Condition) -> Condition:
        return _Both(self, other, all)

    def __or__(self, other: Condition) -> Condition:
        return _Both(self, other, any)

    def __invert__(self) -> Condition:
        return _Not(self)

    def leaves(self, wanted: bool = True) -> Iterator[tuple[str, bool]]:
        """Texts of the leaves, and whether they are wanted: under an even number of nots."""
        raise NotImplementedError

    def holds(self, leaf: Callable[[str], Column | bool]) -> Column | bool:
        """The condition, given what holds of its leaves."""
        raise NotImplementedError


@dataclass(frozen=True)
class has(Condition):  # noqa: N801 - reads as a word of a condition
    """Documents with a term, or with the tokens of a text in a row; none for no tokens."""

    text: str

    def leaves(self, wanted: bool = True) -> Iterator[tuple[str, bool]]:
        yield self.text, wanted

    def holds(self, leaf: Callable[[str], Column | bool]) -> Column | bool:
        return leaf(self.text)


@dataclass(frozen=True)
class _Both(Condition):
    left: Condition
    right: Condition
    how: Callable

    def leaves(self, wanted: bool = True) -> Iterator[tuple[str, bool]]:
        yield from self.left.leaves(wanted)
        yield from self.right.leaves(wanted)

    def holds(self, leaf: Callable[[str], Column | bool]) -> Column | bool:
        left, right = self.left.holds(leaf), self.right.holds(leaf)
        return (left & right) if self.how is all else (left | right)


@dataclass(frozen=True)
class _Not(Condition):
    inner: Condition

    def leaves(self, wanted: bool = True) -> Iterator[tuple[str, bool]]:
        yield from self.inner.leaves(not wanted)

    def holds(self, leaf: Callable[[str], Column | bool]) -> Column | bool:
        inner = self.inner.holds(leaf)
        return not inner if isinstance(inner, bool) else ~inner


def _bits(numbers: list[int], words: int) -> list[int]:
    """The leaves with these numbers, as longs of WORD_BITS bits."""
    return [
        sum(1 << (k % WORD_BITS) for k in numbers if k // WORD_BITS == word)
        for word in range(words)
    ]


def boolean_search(
    index: BlockedIndex,
    condition: Condition,
    n: int,
    k1: float = scoring.K1,
    b: float = scoring.B,
) -> DataFrame:
    """rank, doc_id, score: the n best documents that meet a condition.

    Each document gets one bit for every leaf it matches, gathered in its range, and the
    condition is evaluated over the bits. The score is BM25 over the terms of all leaves that
    are wanted, that is under an even number of nots; documents with score zero rank last,
    by id. A condition that holds without any leaf is met by all other documents too.
    """
    check_result_count(n)
    scoring.check_bm25(k1, b)
    spark = index.stats.sparkSession
    texts = list(dict.fromkeys(text for text, _ in condition.leaves()))
    tokens = {text: _tokens(index, text) for text in texts}
    wanted = {t for text, good in condition.leaves() if good for t in tokens[text]}
    words = -(-len(texts) // WORD_BITS)
    names = [f"bits_{k}" for k in range(words)]
    leaf_of: dict[str, list[int]] = {t: [] for t in wanted}
    for number, text in enumerate(texts):
        if len(tokens[text]) == 1:
            leaf_of.setdefault(tokens[text][0], []).append(number)
    terms = spark.createDataFrame(
        [(term, term in wanted, *_bits(k, words)) for term, k in leaf_of.items()],
        "term string, wanted boolean, " + ", ".join(f"{name} long" for name in names),
    )
    known = list(leaf_of)
    listed = narrow(index.frequencies, known if len(known) <= FILTER_TERMS else None)
    idf = scoring.bm25_idf(F.col("df"), index.stat("n_docs"))
    weight = F.when(F.col("wanted"), idf).otherwise(0.0).alias("weight")
    weights = listed.join(F.broadcast(terms), "term").select("term", weight, *names)
    blocks = _asked_blocks(index, known).join(F.broadcast(weights), "term")
    rows = _with_positions(blocks.withColumn("positions", F.col("docs")), "weight", *names)
    part = scoring.bm25_term_score(
        F.col("weight"), F.col("tf").cast("double"), F.col("len"), index.stat("avg_len"), k1, b
    )
    rows = rows.select("range", "doc_id", part.alias("part"), *names)
    for number, text in enumerate(texts):
        if len(tokens[text]) > 1:
            bits = [F.lit(x).cast("long").alias(c) for x, c in zip(_bits([number], words), names)]
            found = _phrase_rows(index, tokens[text])
            rows = rows.union(found.select("range", "doc_id", F.lit(0.0), *bits))
    sums = [F.sum("part").alias("score"), *[F.bit_or(c).alias(c) for c in names]]
    matched = rows.groupBy("range", "doc_id").agg(*sums)
    if condition.holds(lambda _: False):
        every = index.forward.select("range", "doc_id")
        matched = every.join(matched, ["range", "doc_id"], "left")
        matched = matched.fillna(0.0, ["score"]).fillna(0, names)

    def leaf(text: str) -> Column:
        word, bit = divmod(texts.index(text), WORD_BITS)
        return F.col(names[word]).bitwiseAND(F.lit(1 << bit).cast("long")) != 0

    hits = matched.where(condition.holds(leaf)).select("doc_id", "score")
    return _ranked(best_of_one(hits, n), scoring.rank_order()).select("rank", "doc_id", "score")


def with_snippets(index: BlockedIndex, results: DataFrame, text: str, around: int = 3) -> DataFrame:
    """Search results with found, first, last and snippet.

    The snippet is the smallest stretch of a document's tokens that holds as many terms of
    the text as the document has (``found``), with ``around`` tokens more on either side;
    ``first`` and ``last`` are its places. Only the documents of the results are looked at.
    A document without any of the terms has a snippet of its first tokens.
    """
    results = settle(results)
    terms = sorted(set(_tokens(index, text)))
    ids = results.select("doc_id").distinct().limit(FILTER_TERMS + 1).collect()
    forward = index.forward
    if len(ids) <= FILTER_TERMS:
        forward = forward.where(
            reduce(lambda a, b: a | b, [F.col("doc_id") == r["doc_id"] for r in ids], F.lit(False))
        )
    rows = forward.join(F.broadcast(results.select("doc_id").distinct()), "doc_id", "left_semi")
    asked = F.array(*[F.lit(t) for t in terms]).cast("array<string>")
    found = F.filter("terms", lambda t: F.array_contains(asked, t["term"]))
    rows = rows.select("doc_id", "len", "terms", found.alias("hits"))
    places = F.flatten(
        F.transform(
            "hits",
            lambda t, k: F.transform(
                t["positions"], lambda at: F.struct(at.alias("at"), k.alias("term"))
            ),
        )
    )
    span = _smallest_span(F.sort_array(places), F.size("hits"))
    rows = rows.select("doc_id", "len", "terms", F.size("hits").alias("found"), span.alias("best"))
    first = F.greatest(F.coalesce("best.first", F.lit(0)) - around, F.lit(0))
    last = F.coalesce(F.col("best.first") + F.col("best.span") - 1, F.lit(0)) + around
    rows = rows.select(
        "doc_id",
        "found",
        first.cast("int").alias("first"),
        F.least(last, F.col("len") - 1).cast("int").alias("last"),
        "terms",
    )
    inside = F.flatten(
        F.transform(
            "terms",
            lambda t: F.transform(
                F.filter(t["positions"], lambda at: at.between(F.col("first"), F.col("last"))),
                lambda at: F.struct(at.alias("at"), t["term"].alias("term")),
            ),
        )
    )
    snippet = F.array_join(F.transform(F.sort_array(inside), lambda p: p["term"]), " ")
    return results.join(
        rows.select("doc_id", "found", "first", "last", snippet.alias("snippet")), "doc_id", "left"
    )


def search_with_snippets(index: BlockedIndex, text: str, n: int, around: int = 3) -> DataFrame:
    """rank, doc_id, score, found, first, last, snippet of the n best documents by BM25."""
    return with_snippets(index, pruned_search(index, text, n), text, around)
