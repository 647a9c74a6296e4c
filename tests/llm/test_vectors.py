"""Problems 4 and 6."""

import numpy as np
import pytest

from sievewright.llm import vectors
from sievewright.llm.vectors import clusters, described, nearest, scan

V = "record_id string, nl_embedding array<float>, k string, v int"


def case(seed=0, groups=12, noise=150, copies=3):
    rng = np.random.default_rng(seed)
    x = []
    for g in range(groups):
        c = rng.standard_normal(128)
        for _ in range(4 + g):
            x.append(c / np.linalg.norm(c) + rng.standard_normal(128) * 0.03)
    x += list(rng.standard_normal((noise, 128)))
    x += [x[0]] * copies
    x = np.array(x, np.float32) * rng.uniform(0.5, 9, (len(x), 1)).astype(np.float32)
    rows = [(f"r{k:04d}", row.tolist(), "k", 1) for k, row in enumerate(x)]
    dirty = [("null", None), ("short", [1.0] * 64), ("zero", [0.0] * 128), ("empty", []), ("nan", [float("nan")] * 128), ("hole", [None] + [1.0] * 127), (None, [1.0] * 128)]
    u = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    return rows + rows[:5] + [(i, v, None, None) for i, v in dirty], [r[0] for r in rows], u @ u.T


def test_scan_is_the_dense_result():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((300, 128)).astype(np.float32)
    x[100:150] = x[0] + rng.standard_normal((50, 128)) * 0.3
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    i, j, s = scan(x, x, 0.8)
    want = set(zip(*np.nonzero(x @ x.T >= 0.8)))
    got = set(zip(i.tolist(), j.tolist()))
    assert got <= {(a, b) for a, b in want} and len(got) >= 0.97 * len(want)


def test_nearest_against_brute_force(spark):
    rows, ids, sims = case()
    got = {(r.record_id, r.neighbor_id) for r in nearest(spark.createDataFrame(rows, V)).collect()}
    want = set()
    for a in range(len(ids)):
        order = sorted((b for b in range(len(ids)) if b != a and sims[a, b] >= 0.8), key=lambda b: (-round(sims[a, b], 6), ids[b]))[:5]
        want |= {(ids[a], ids[b]) for b in order}
    assert len(got & want) >= 0.95 * len(want) and len(got) <= 1.02 * len(want)


def test_clusters_against_definition(spark):
    rows, ids, sims = case(1)
    found, placed = clusters(spark.createDataFrame(rows, V))
    near = {a: frozenset(b for b in range(len(ids)) if sims[a, b] >= 0.70) for a in range(len(ids))}
    want = {(ids[a], ids[min(g)]) for a, g in near.items() if len(g) >= 5 and all(near[b] == g for b in g)}
    assert {(r.record_id, r.cluster_id) for r in found.collect()} == want
    about = {r.cluster_id: r.size for r in described(placed).collect()}
    assert sum(about.values()) == len(want)


def test_a_chain_is_no_cluster(spark):
    angle = np.deg2rad(np.arange(6) * 30)
    x = np.zeros((6, 128))
    x[:, 0], x[:, 1] = np.cos(angle), np.sin(angle)
    rows = [(f"r{k}", v.tolist(), None, None) for k, v in enumerate(x)]
    assert clusters(spark.createDataFrame(rows, V))[0].count() == 0


def test_copies_alone_are_a_cluster_and_neighbours(spark):
    rows = [(f"r{k}", [1.0] + [0.5] * 127, None, None) for k in range(8)]
    df = spark.createDataFrame(rows, V)
    assert {(r.record_id, r.cluster_id) for r in clusters(df)[0].collect()} == {(f"r{k}", "r0") for k in range(8)}
    got = nearest(df).groupBy("record_id").count().collect()
    assert len(got) == 8 and {r["count"] for r in got} == {5}


@pytest.mark.parametrize("rows", [[], [("only", [1.0] * 128, None, None)], [("null", None, None, None)]])
def test_tiny(spark, rows):
    df = spark.createDataFrame(rows, V)
    assert nearest(df).count() == 0 and clusters(df)[0].count() == 0


def test_many_long_lists_are_planned(spark, monkeypatch):
    """Some hundred lists in blocks of two parts each: nested conditions overflowed the planner's stack."""
    monkeypatch.setattr(vectors, "LIST_ROWS", 3)
    rng = np.random.default_rng(4)
    centroids = rng.standard_normal((1000, 8)).astype(np.float32)
    lay = object.__new__(vectors.Layout)
    lay.dim, lay.probes, lay.centroids, lay.n = 8, 1, centroids / np.linalg.norm(centroids, axis=1, keepdims=True), 5000
    x = np.repeat(lay.centroids, 5, axis=0)
    lay.reps = spark.createDataFrame([(f"k{i}", bytearray(v)) for i, v in enumerate(vectors.packed(x))], "k string, v binary")
    got = lay.lists().select("list", "lo", "hi", "part", "k").collect()
    assert len(got) == 2 * 5000 and len({r.k for r in got}) == 5000  # every row once with each of the two parts
    assert {(r.lo, r.hi) for r in got} == {(0, 0), (0, 1), (1, 1)}
