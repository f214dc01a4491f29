import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagemill.llm import multi_index
from pagemill.llm.queries import QUERIES

FOLDER = "/root/testdata"


def brute(rows, threshold=0.95):
    """Links, least reachable id and recall's base of rows (id, vector), all pairs compared."""
    good = [i for i, (_, v) in enumerate(rows) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    by_width = {}
    for i in good:
        by_width.setdefault(len(rows[i][1]), []).append(i)
    links, root = [0] * len(rows), list(range(len(rows)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for places in by_width.values():
        x = np.array([rows[i][1] for i in places], float)
        x /= np.linalg.norm(x, axis=1)[:, None]
        close = x @ x.T >= threshold
        np.fill_diagonal(close, False)
        for i, line in zip(places, close):
            links[i] = int(line.sum())
            for j in np.flatnonzero(line):
                root[find(i)] = find(places[j])
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[find(i)] = min(least.get(find(i), key), key)
    return [(key, links[i], least.get(find(i))) for i, (key, _) in enumerate(rows)]


def groups(count, width, seed, spread=0.1):
    """Vectors around centres, some of them close to each other."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(max(1, count // 6), width))
    picked = centres[rng.integers(0, len(centres), count)]
    return (picked + spread * rng.uniform(0.2, 2.2, (count, 1)) * rng.normal(size=(count, width))).astype(np.float32).tolist()


def test_recall_and_no_false_links(spark, monkeypatch):
    monkeypatch.setattr(multi_index, "CELL_ROWS", 16)  # many cells on few rows
    rows = list(enumerate(groups(3000, 32, 5)))
    got = {r.vec_id: r for r in multi_index.near_copies(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()}
    expected = brute(rows)
    assert len(got) == len(rows) and sum(x[1] for x in expected) > 2000
    assert all(got[i].n_links <= n for i, n, _ in expected)
    assert sum(r.n_links for r in got.values()) >= 0.97 * sum(n for _, n, _ in expected)
    assert np.mean([got[i].component_id == c for i, _, c in expected]) > 0.97
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_traversal_visits_nearest_first():
    points = multi_index.unit(np.array(groups(400, 8, 2)))
    grid = multi_index.fit_grid(points, 4000, 0.95, 0.9)
    first, second = grid.gaps(points)
    order = {i: [] for i in range(len(points))}
    for who, cells in grid.traversal(points):
        for i, c in zip(who, cells):
            order[int(i)].append(int(c))
    sums = first[:, :, None] + second[:, None, :]
    for i, cells in order.items():
        flat = sums[i].ravel()
        assert sorted(cells) == sorted(np.flatnonzero(flat <= grid.budget).tolist())
        assert (np.diff(flat[cells]) >= 0).all()


@pytest.mark.parametrize("block", [512, 7])
def test_odd_vectors_copies_and_lengths(spark, monkeypatch, block):
    monkeypatch.setattr(multi_index, "BLOCK", block)
    rng = random.Random(3)
    hot = [0.5, -0.25, 1.0, 0.0]
    rows = [(i, hot if rng.random() < 0.4 else [float(x) for x in v]) for i, v in enumerate(groups(150, 4, 9, 0.3))]
    rows += [(200, None), (201, []), (202, [0.0] * 4), (203, [float("nan"), 1.0, 1.0, 1.0]), (204, [float("inf"), 0.0, 0.0, 0.0]), (205, [None, 1.0, 1.0, 1.0])]
    rows += [(None, hot), (None, [9.0, 0.0, 0.0, 0.0]), (206, [1.0]), (207, [3.0]), (208, [-1.0]), (209, [2.0, 2.0]), (3, hot), (210, [x * 7 for x in hot])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({c: F.lit("own") for c in ("id", "v", "vid", "n", "cell", "kept", "n_links")})
    got = sorted((repr(r.vec_id), r.n_links, repr(r.component_id)) for r in multi_index.near_copies(frame).collect())
    assert got == sorted((repr(i), n, repr(c)) for i, n, c in brute(rows))  # few rows: all in a cell or two that everyone visits


def test_threshold_itself(spark):
    rows = [(1, [1.0, 0.0]), (2, [0.95, float(np.sqrt(1 - 0.95**2))]), (3, [4.0, 3.0]), (4, [1.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert {r.vec_id: r.n_links for r in multi_index.near_copies(frame, threshold=0.8).collect()} == {1: 3, 2: 3, 3: 3, 4: 3}


def test_forest_of_a_path():
    close = np.zeros((5, 5), bool)
    for i in range(5):
        close[i, i] = True
        close[i, max(0, i - 1)] = i != 3
    rows, columns = multi_index.forest(close)
    assert rows.tolist() == [0, 0, 0, 3, 3] and columns.tolist() == [0, 0, 0, 3, 3]
    assert multi_index.forest(np.zeros((2, 0), bool))[0].tolist() == [2, 2]


@pytest.mark.parametrize("sf", ["sf0.001", "check_s"])
def test_query(spark, sf):
    if not os.path.isdir(f"{FOLDER}/{sf}"):
        pytest.skip("tables are not here")
    found = QUERIES["op13_embeddings"](spark, f"{FOLDER}/{sf}")
    assert dict(found.dtypes) == {"vec_id": "bigint", "n_links": "bigint", "component_id": "bigint", "kept": "boolean"}
    got = {r.vec_id: r for r in found.collect()}
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    expected = brute(rows)
    assert len(got) == len(rows) == len(expected)
    assert all(got[i].n_links <= n for i, n, _ in expected)
    assert sum(r.n_links for r in got.values()) >= 0.98 * sum(n for _, n, _ in expected)


def test_empty(spark):
    assert multi_index.near_copies(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    none = spark.createDataFrame([(1, None), (2, [0.0])], "vec_id long, embedding array<float>")
    assert sorted(tuple(r) for r in multi_index.near_copies(none).collect()) == [(1, 0, 1, True), (2, 0, 2, True)]
