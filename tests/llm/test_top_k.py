import math
import random

from termlode.llm.top_k import top_k

from .conftest import found

SCHEMA = "vec_id long, embedding array<float>, label int, score long, shard int"


def brute(rows, k, every):
    vectors = {}
    for vec_id, vector in rows:
        if vec_id is None or not vector or any(x is None or not math.isfinite(x) for x in vector):
            continue
        vectors.setdefault(vec_id, []).append([math.floor(256 * x) for x in vector])
    result = []
    for q in (v for v in vectors if v % every == 0):
        best = {}
        for query in vectors[q]:
            for other, candidates in vectors.items():
                for c in candidates:
                    if other != q and len(c) == len(query):
                        score = sum(a * b for a, b in zip(query, c, strict=True))
                        best[other] = max(score, best.get(other, score))
        ranked = sorted(best.items(), key=lambda item: (-item[1], item[0]))[:k]
        result += [(q, r, v, s) for r, (v, s) in enumerate(ranked, 1)]
    return sorted(result)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, 3) for i, v in rows], SCHEMA)


def test_equals_brute_force_with_ties_nulls_and_repeats(spark):
    rng = random.Random(3)
    # Components that floats hold exactly.
    rows = [(i, [rng.randint(-512, 512) / 256 for _ in range(9)]) for i in range(130)]
    rows += [(200 + i, [1.0] * 9) for i in range(20)] + [(100, rows[100][1]), (100, rows[7][1])]
    rows += [(None, [1.0] * 9), (300, None), (301, []), (302, [1.0, None] * 4)]
    rows += [(303, [float("nan")] * 9), (304, [float("inf")] * 9), (350, [1.0, 2.0]), (351, [1.0, 3.0])]
    got = found(top_k(frame(spark, rows), 5, 10), "query_id", "rank", "vec_id", "score")
    assert got == brute(rows, 5, 10)
    assert (350, 1, 351, 256 * 256 + 512 * 768) in got


def test_large_components_stay_exact(spark):
    rows = [(i, [float(1 << 22) + i, 3.0 - i]) for i in range(12)]
    got = found(top_k(frame(spark, rows), 3, 4), "query_id", "rank", "vec_id", "score")
    assert got == brute(rows, 3, 4)


def test_fewer_candidates_than_k_and_empty_table(spark):
    assert found(top_k(frame(spark, [(0, [1.0]), (1, [2.0])]), 5), "query_id", "vec_id") == [(0, 1)]
    assert top_k(frame(spark, [(0, [1.0])])).count() == 0
    assert top_k(frame(spark, []).where("false")).count() == 0
