import numpy as np
import pytest

from tests.llm.conftest import found
from termlode.llm import grid_join
from termlode.llm.grid_join import _groups, near_duplicates

COLUMNS = ("vec_id", "n_links", "component_id", "kept")


def brute(rows, similarity=0.9):
    """All pairs in plain loops."""

    def usable(i, x):
        return i is not None and x and all(v is not None and np.isfinite(v) for v in x) and any(x)

    def cosine(x, y):
        x, y = np.array(x, float), np.array(y, float)
        return x @ y / np.sqrt((x @ x) * (y @ y))

    good = [usable(i, x) for i, x in rows]
    near = [[] for _ in rows]
    for a in range(len(rows)):
        for b in range(a):
            x, y = rows[a][1], rows[b][1]
            if good[a] and good[b] and len(x) == len(y) and cosine(x, y) >= similarity:
                near[a].append(b)
                near[b].append(a)
    out = []
    for a, (i, _) in enumerate(rows):
        seen, front = {a}, [a]
        while front:
            for b in near[front.pop()]:
                if b not in seen:
                    seen.add(b)
                    front.append(b)
        least = None if i is None else min(rows[b][0] for b in seen)
        out.append((i, len(near[a]), least, i == least))
    return sorted(out, key=lambda row: [(x is not None, x) for x in row])


def frame(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").repartition(3)


def clustered(rng, n, dim):
    """Chains, clusters, copies and lone vectors."""
    centres = rng.normal(size=(6, dim))
    rows = [centres[k % 6] + 0.25 * rng.normal(size=dim) for k in range(n // 2)]
    rows += list(rng.normal(size=(n // 4, dim)))
    turn = np.linspace(0, 2.5, n // 8)
    rows += [np.array([np.cos(t), np.sin(t), *[0.0] * (dim - 2)]) for t in turn]
    rows += [rows[k % 3] for k in range(n - len(rows))]
    return [(int(i), [float(np.float32(v)) for v in x]) for i, x in enumerate(rows)]


@pytest.mark.parametrize("dim", [2, 5, 24])
def test_equals_all_pairs(spark, monkeypatch, dim):
    monkeypatch.setattr(grid_join, "LEAF_ROWS", 16)
    rows = clustered(np.random.default_rng(dim), 300, dim)
    got = found(near_duplicates(frame(spark, rows), interval_rows=40), *COLUMNS)
    assert got == brute(rows)
    assert sum(n for _, n, _, _ in got) > 0


def test_hard_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0])]
    rows += [(7, [None, 1.0]), (None, [1.0, 0.0]), (8, [1e-30, 0.0]), (9, [1e30, -0.0])]
    rows += [(1, [0.0, 1.0]), (1, [0.0, 1.0]), (-4, [0.0, 2.0]), (11, [1.0]), (12, [-1.0])]
    rows += [(13, [1.0, 0.0, 0.0]), (14, [1.0]), (None, None)]
    wide = spark.createDataFrame(
        [(i, x, "a", 0.5, "b") for i, x in rows],
        "vec_id long, embedding array<double>, digest string, n_links double, dim string",
    )
    assert found(near_duplicates(wide), *COLUMNS) == brute(rows)
    assert near_duplicates(wide.where("false")).collect() == []
    assert near_duplicates(wide.where("vec_id = 2")).collect() == [(2, 0, 2, True)]


def test_the_threshold_itself_links(spark):
    # A cosine of 24/25, and one just below it.
    rows = [(1, [1.0, 0.0]), (4, [3.0, 4.0]), (5, [4.0, 3.0]), (6, [3.0, 4.0000001])]
    got = near_duplicates(frame(spark, rows, "double"), similarity=0.96)
    assert {r["vec_id"]: r["n_links"] for r in got.collect()} == {1: 0, 4: 2, 5: 1, 6: 1}
    with pytest.raises(ValueError):
        near_duplicates(frame(spark, rows, "double"), similarity=0)


def test_a_cluster_gives_no_pairs(spark, monkeypatch):
    """Of 600 vectors that are all linked, each pair of intervals sends its vectors only."""
    rng = np.random.default_rng(1)
    rows = [(i, [float(v) for v in [1, 0, 0, 0] + 0.01 * rng.normal(size=4)]) for i in range(600)]
    sizes = []
    kept = grid_join.stored

    def watched(table, name):
        out = kept(table, name)
        sizes.append((name, out.count()))
        return out

    monkeypatch.setattr(grid_join, "stored", watched)
    got = near_duplicates(frame(spark, rows, "double"), interval_rows=100).collect()
    assert {(r["n_links"], r["component_id"]) for r in got} == {(599, 0)}
    intervals, links = dict(sizes)["intervals"], dict(sizes)["vector-links"]
    assert links <= 600 * (intervals + 1)


def test_distant_intervals_are_skipped(spark):
    """Clusters on the axes lie in boxes that are far from one another."""
    rng = np.random.default_rng(2)
    rows = []
    for k in range(8):
        for _ in range(50):
            x = 0.01 * rng.normal(size=8)
            x[k] += 1
            rows.append((len(rows), [float(v) for v in x]))
    boxed = [
        (k, k, 8, *[float(v) for v in [k == j for j in range(8)] + [0] * 8] * 2) for k in range(8)
    ]
    names = ["id", "part", "dim", *grid_join._LOW, *grid_join._HIGH]
    intervals = spark.createDataFrame(boxed, names)
    intervals = intervals.selectExpr("*").withColumn("dim", intervals["dim"].cast("int"))
    pairs = grid_join.near_intervals(intervals, 0.447, 8).collect()
    assert sorted(map(tuple, pairs)) == [(k, k) for k in range(8)]
    assert found(near_duplicates(frame(spark, rows, "double"), interval_rows=50), *COLUMNS) == brute(rows)


def test_groups_follow_paths():
    linked = np.zeros((5, 5), bool)
    for i, j in [(4, 0), (3, 0), (3, 1), (2, 1), (0, 4)]:
        linked[i, j] = True
    rows, columns = _groups(linked)
    assert rows.tolist() == [0, 5, 2, 2, 2] and columns.tolist() == [2, 2, 5, 5, 0]
