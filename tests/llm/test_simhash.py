import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from termlode.llm.components import components
from termlode.llm.simhash import (
    _link,
    covering_masks,
    fingerprint,
    links,
    near_duplicates,
    one_of_each,
    split_mask,
)

from .conftest import found


def slow_fingerprint(text, size=4):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    count = max(1, len(words) - size + 1)
    shingles = [" ".join(words[i : i + size]) for i in range(count)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > count)


def classes_of(values, radius):
    """Smallest index of each value's component."""
    root = list(range(len(values)))
    changed = True
    while changed:
        changed = False
        for i, j in itertools.combinations(range(len(values)), 2):
            if (values[i] ^ values[j]).bit_count() <= radius and root[i] != root[j]:
                root[i] = root[j] = min(root[i], root[j])
                changed = True
    return root


@pytest.mark.parametrize("radius", [1, 4, 6])
def test_masks_cover_every_pair_within_the_radius(radius):
    masks = [m % (1 << 64) for m in covering_masks(radius)]
    assert len(masks) == 2 ** (radius + 1) - 1
    rng = random.Random(radius)
    for _ in range(300):
        difference = sum(1 << b for b in rng.sample(range(64), radius))
        assert any(not difference & m for m in masks)
        mask = rng.choice([m for m in masks if not difference & m])
        assert any(not difference & m % (1 << 64) for m in split_mask(mask, radius))


def test_fingerprints(hard_texts):
    for _, text in hard_texts[:-8] + hard_texts[-5:]:
        assert fingerprint(text or "") == slow_fingerprint(text)


@pytest.mark.parametrize("bucket_rows", [2048, 3])
def test_links_equal_brute_force(spark, bucket_rows):
    rng = random.Random(7)
    base = [rng.getrandbits(64) for _ in range(6)]
    values = {b ^ sum(1 << x for x in rng.sample(range(64), rng.randint(0, 7))) for b in base for _ in range(9)}
    values = sorted(int(np.uint64(v).astype(np.int64)) for v in values)
    frame = spark.createDataFrame([(v,) for v in values], "print long")
    rooted = components(links(frame, 4, bucket_rows))
    root = {n: n for n in values} | dict(found(rooted, "node", "root"))
    unsigned = [v % (1 << 64) for v in values]
    expected = classes_of(unsigned, 4)
    assert [values.index(root[v]) for v in values] == expected


def test_buckets_of_many_link_over_the_sign_bit():
    batch = pa.record_batch({"prints": pa.array([[5, 5 - (1 << 63), 7, 4, 1 << 40]])})
    edges = next(iter(_link(1)([batch]))).to_pydict()
    assert set(zip(edges["a"], edges["b"], strict=True)) == {(5 - (1 << 63), x) for x in (4, 5, 7)}


def test_components_of_long_paths(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 99), (7, 7)]
    got = found(components(spark.createDataFrame(edges, "a long, b long")), "node", "root")
    assert got == [(i, 0) for i in range(1, 61)] + [(100, 99)]
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_hard_documents(hard_documents, hard_texts, no_documents):
    got = found(near_duplicates(hard_documents), "doc_id", "print", "component_id")
    assert len(got) == len(hard_texts)
    prints = [p % (1 << 64) for _, p, _ in got]
    roots = classes_of(prints, 4)
    for (_, _, component), r in zip(got, roots, strict=True):
        ids = [got[k][0] for k in range(len(got)) if roots[k] == r and got[k][0] is not None]
        assert component == min(ids, default=None)
    assert near_duplicates(no_documents).count() == 0

    kept = one_of_each(hard_documents)
    assert kept.columns == hard_documents.columns
    # As many as components; row 5 stands for two texts, and so for two of them.
    assert kept.count() == len(set(roots))
    assert kept.where(F.col("doc_id") == 5).count() == 2
    assert one_of_each(no_documents).count() == 0
