"""Language of web pages by Bayesian fusion of evidence.

Four sources are combined as if independent given the language:

- the page's text, by the likelihood of its byte trigrams, weighed as so many at most;
- the language that the markup declares;
- the last part of the host name;
- a prior of the host, smoothed towards its domain's, which is smoothed towards the prior
  of all pages.

The last three are estimated from the pages themselves by grouped sums of what their texts
say; a page's own text is left out of its host's and domain's sums, so it counts once. The
trigram table is fitted on a bounded sample of labelled documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termlode.llm.common import stored, text_slices, to_tasks

# The sample: of every language, the documents with the smallest hashes of id and text, of
# at most so many characters.
SAMPLE_ROWS, SAMPLE_CHARS = 200, 8_000
BUCKETS = 1 << 16
# Weight of a text in trigrams, and of the smoothing in pages.
TEXT_WEIGHT, SMOOTHING = 100.0, 5.0

_RAW = re.compile(
    r"<(script|style|noscript|template)\b.*?(?:</\1\s*>|\Z)|<!--.*?(?:-->|\Z)", re.S | re.I
)
_TAG = re.compile(r"<[^>]*(?:>|\Z)|&[#\w]+;?")
_NO_LETTER = re.compile(r"[\d\W_]+")
_DECLARED = re.compile(r"<html\b[^>]*?\blang\s*=\s*[\"']?\s*([a-zA-Z]{2,3})\b", re.I)
_META = re.compile(
    r"<meta\b[^>]*content-language[^>]*content\s*=\s*[\"']?\s*([a-zA-Z]{2,3})\b", re.I
)
_HOST = re.compile(r"^\s*(?:[a-zA-Z][\w+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)")


def page_words(page: str) -> str:
    """The letters of a page's text, lower case, with one space between words."""
    return _NO_LETTER.sub(" ", _TAG.sub(" ", _RAW.sub(" ", page))).lower()


def trigram_rows(text: str) -> np.ndarray:
    line = np.frombuffer(f" {text} ".encode(), np.uint8).astype(np.uint32)
    if len(line) < 3:
        return np.zeros(0, np.int64)
    codes = (line[:-2] << 16 | line[1:-1] << 8 | line[2:]) * np.uint32(2654435761)
    return (codes >> np.uint32(16)).astype(np.int64)


def declared_language(page: str) -> str:
    found = _DECLARED.search(page) or _META.search(page)
    return found[1].lower() if found else ""


def host_parts(url: str | None) -> tuple[str, str, str]:
    """Host, domain (its last two parts) and suffix of an address; empty if it has none."""
    found = _HOST.search(url or "")
    host = found[1].lower().strip(".") if found else ""
    parts = host.split(".")
    if not host or parts[-1].isdigit():
        return host, host, ""
    return host, ".".join(parts[-2:]), parts[-1]


def fit_trigrams(texts: list[str], labels: list[str]) -> tuple[list[str], np.ndarray]:
    """Languages in order, and the logarithm of each trigram's chance per language."""
    languages = sorted(set(labels))
    counts = np.full((BUCKETS, len(languages)), 0.01)
    for text, label in zip(texts, labels, strict=True):
        rows = trigram_rows(page_words(text))
        counts[:, languages.index(label)] += np.bincount(rows, minlength=BUCKETS)
    return languages, np.log(counts / counts.sum(axis=0)).astype(np.float32)


def labelled_sample(
    documents: DataFrame, sample_rows: int = SAMPLE_ROWS
) -> tuple[list[str], list[str]]:
    """Texts and languages of a bounded sample; rows without a language don't count.

    Every language is in it, and of each language the same rows on each run. The hashes are
    ranked without their texts, a few per task and language; rows with the same id and text
    are one.
    """
    short = documents.where(
        (F.length(F.trim("lang")) > 0)
        & (F.length("text") > 0)
        & (F.length("text") <= SAMPLE_CHARS)
    ).select("lang", F.xxhash64("doc_id", "text").alias("place"), "text")
    places = short.select("lang", "place").distinct()
    at = F.row_number().over(Window.partitionBy("lang").orderBy("place"))
    lowest = places.withColumn("at", at).where(F.col("at") <= sample_rows).select("lang", "place")
    chosen = short.join(F.broadcast(lowest), ["lang", "place"]).groupBy("lang", "place")
    rows = chosen.agg(F.min("text").alias("text")).collect()
    rows.sort(key=lambda row: (row["lang"], row["place"]))
    return [row["text"] for row in rows], [row["lang"] for row in rows]


_READ = (
    "page_id long, url string, declared string, host string, domain string, suffix string,"
    " likelihood array<double>, belief array<double>"
)


def _read(chances: np.ndarray):
    """Declared language, host and likelihood of every page's whole text."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in _READ.split(", ")]
        types = [pa.int64()] + [pa.string()] * 5 + [pa.list_(pa.float64())] * 2
        for batch, pages in text_slices(batches, "html"):
            out = []
            ids, urls = batch.column("page_id").to_pylist(), batch.column("url").to_pylist()
            for page_id, url, page in zip(ids, urls, pages, strict=True):
                rows = trigram_rows(page_words(page).strip())
                likelihood = chances[rows].sum(axis=0, dtype=float)
                likelihood *= min(1.0, TEXT_WEIGHT / max(1, len(rows)))
                belief = np.exp(likelihood - likelihood.max(initial=-np.inf))
                belief /= belief.sum()
                parts = host_parts(url)
                out.append((page_id, url, declared_language(page), *parts, likelihood, belief))
            columns = zip(*out, strict=True)
            arrays = [pa.array(list(c), t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names)

    return read


def _sums(frame: DataFrame, keys: list[str], size: int, column: str, name: str) -> DataFrame:
    """Sums of an array column by element, for each key; partial sums before the shuffle."""
    parts = [F.sum(F.col(column)[i]).alias(f"s{i}") for i in range(size)]
    total = F.array(*[F.col(f"s{i}") for i in range(size)]).alias(name)
    return frame.groupBy(*keys).agg(*parts).select(*keys, total)


def _smoothed(own: str, belief: str, wider: Column, size: int) -> Column:
    """Share of each language in an array of sums, less one belief, smoothed by a prior."""
    left = F.zip_with(own, belief, lambda n, b: F.greatest(n - b, F.lit(0.0)))
    total = F.aggregate(left, F.lit(0.0), lambda a, x: a + x) + SMOOTHING
    return F.zip_with(left, wider, lambda n, p: (n + SMOOTHING * p) / total)


def identify(pages: DataFrame, documents: DataFrame) -> DataFrame:
    """page_id, url, lang, score and what each source says, for every page.

    ``pages`` has page_id, url and html; ``documents`` doc_id, text and lang, the labelled
    sample's source. score is the posterior of lang; ties go to the first language by
    name. A null or empty page has no text evidence, an unreadable address the empty host;
    without labelled documents lang and score are null. Repeated rows count as pages of
    their own; further columns are ignored.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    languages, chances = fit_trigrams(*labelled_sample(documents))
    size = len(languages)
    if not size:
        none = [F.lit(None).cast(t).alias(c) for c, t in (("lang", "string"), ("score", "double"))]
        nothing = F.lit(None).cast("string")
        return rows.select(
            "page_id", "url", *none, nothing.alias("text_lang"), nothing.alias("declared")
        )
    read = stored(to_tasks(rows, _read(chances), _READ), "page-evidence")
    hosts = _sums(read, ["host", "domain"], size, "belief", "host_n")
    domains = _sums(hosts, ["domain"], size, "host_n", "domain_n")
    everything = _sums(domains, [], size, "domain_n", "all_n")
    by_host = stored(hosts.join(domains, "domain").drop("domain"), "host-sums")
    declared = stored(_sums(read, ["declared"], size, "belief", "declared_n"), "declared-sums")
    suffixes = stored(_sums(read, ["suffix"], size, "belief", "suffix_n"), "suffix-sums")

    all_n = everything.select("all_n").scalar()
    codes = F.array(*[F.lit(x) for x in languages])
    even = F.array(*[F.lit(1.0 / size)] * size)
    joined = (
        read.join(by_host, "host")
        .join(declared, "declared")
        .join(suffixes, "suffix")
        .withColumn("all_n", all_n)
    )
    base = _smoothed("all_n", "belief", even, size)
    prior = _smoothed("host_n", "belief", _smoothed("domain_n", "belief", base, size), size)

    def chance(counts: str, matches: Column) -> Column:
        """Of this value given each language; a code's own language gets extra weight."""
        joint = F.zip_with(F.zip_with(counts, "belief", lambda n, b: F.greatest(n - b, F.lit(0.0))),
                           matches, lambda n, m: n + m + 0.5)
        return F.zip_with(joint, "all_n", lambda n, t: n / (t + SMOOTHING + 0.5))

    same = F.transform(codes, lambda c: F.when(c == F.col("declared"), SMOOTHING).otherwise(0.0))
    ended = F.transform(codes, lambda c: F.when(c == F.col("suffix"), SMOOTHING).otherwise(0.0))
    says = [F.lit(1.0)] * size
    parts = [
        F.col("likelihood"),
        F.transform(prior, lambda x: F.log(x)),
        F.when(F.col("declared") == "", F.array(*says)).otherwise(chance("declared_n", same)),
        F.when(F.col("suffix") == "", F.array(*says)).otherwise(chance("suffix_n", ended)),
    ]
    logs = [*parts[:2], *[F.transform(p, lambda x: F.log(x)) for p in parts[2:]]]
    total = reduce(lambda a, b: F.zip_with(a, b, lambda x, y: x + y), logs)
    scored = joined.select("page_id", "url", "declared", "belief", total.alias("total"))
    best = F.array_max("total")
    norm = F.aggregate("total", F.lit(0.0), lambda a, x: a + F.exp(x - best))
    at = F.array_position("total", best).cast("int")
    text_at = F.array_position("belief", F.array_max("belief")).cast("int")
    return scored.select(
        "page_id",
        "url",
        F.element_at(codes, at).alias("lang"),
        (1.0 / norm).alias("score"),
        F.element_at(codes, text_at).alias("text_lang"),
        "declared",
    )
