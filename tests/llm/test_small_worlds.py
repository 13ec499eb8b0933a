"""Links come from the graph: its recall, the bounded audit, and groups of very many near copies."""

from __future__ import annotations

import time

import numpy as np
import pytest

from tablewharf.llm import near_vectors
from tablewharf.llm.near_vectors import SmallWorld, level_of, units


def near(rng, vectors, low, high):
    noise = rng.normal(size=vectors.shape)
    noise = units(noise - (noise * vectors).sum(axis=1, keepdims=True) * vectors)
    cosine = rng.uniform(low, high, size=(len(vectors), 1))
    return units(cosine * vectors + np.sqrt(1 - cosine**2) * noise)


@pytest.mark.parametrize("clusters", [0, 30])
def test_graph_finds_the_links(clusters, monkeypatch):
    """4000 stored vectors; 2000 queries, of which half link; the graph is asked, and only the audit sees all nodes."""
    rng = np.random.default_rng(clusters)
    points = units(rng.normal(size=(4000, 48)))
    if clusters:
        points = units(points[rng.integers(0, clusters, 4000)] + rng.normal(scale=0.4, size=(4000, 48)) / 7)
    queries = np.concatenate([near(rng, points[rng.choice(4000, 1000, replace=False)], 0.951, 0.99), units(rng.normal(size=(1000, 48)))])
    world = SmallWorld(points.astype(np.float32), level_of(np.arange(4000)))
    asked = []
    within = SmallWorld.within
    monkeypatch.setattr(SmallWorld, "within", lambda self, q, *a: asked.append(len(q)) or within(self, q, *a))
    monkeypatch.setattr(near_vectors, "_exhaustive", lambda *a: pytest.fail("the graph was not used"))
    row, node = near_vectors._audited(world, queries, points, 0.95)
    assert asked[-1] == 2000 and all(n <= 2 * near_vectors.AUDITED for n in asked[:-1])
    label = near_vectors._labels(row, node, 2000, 4000)
    true = np.column_stack(np.nonzero(queries @ points.T >= 0.95))
    assert len(true) >= 1000
    assert near_vectors._complete(true, label, 2000) >= 0.95
    if not clusters:
        found = set(zip(row.tolist(), node.tolist()))
        assert np.mean([(a, b) in found for a, b in true.tolist()]) >= 0.95


def test_planted_vectors_link():
    rng = np.random.default_rng(1)
    points = units(rng.normal(size=(500, 16)))
    planted = near_vectors._planted(points, 0.95, rng)
    assert len(planted) == near_vectors.AUDITED and ((planted @ points.T).max(axis=1) >= 0.9499).all()
    assert len(near_vectors._planted(points[:3], 0.95, rng)) == 3


def test_whole_query_without_rare_links_uses_the_graph(spark, monkeypatch):
    """Tables with hardly a link, and 3000 vectors with planted pairs: the same as brute force."""
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(3000, 24))
    vectors[2000:2100] = near(rng, units(vectors[:100]), 0.952, 0.99)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    found = {r.vec_id: (r.n_links, r.component_id) for r in near_vectors.near_vectors(frame).collect()}
    exact = units(vectors)
    links = exact @ exact.T >= 0.95
    np.fill_diagonal(links, False)
    assert links.sum() >= 200
    right = sum(found[i][0] == links[i].sum() for i in range(3000))
    assert right >= 2990


def test_forest_of_many_links_is_quick():
    names = np.arange(3000)
    links = np.ones((3000, 3000), dtype=bool)
    start = time.perf_counter()
    forest = near_vectors._Forest(names)
    for low in range(0, 3000, 512):
        forest.add(names[low : low + 512], names, links[low : low + 512])
    assert len(forest.kept) == 2999
    assert time.perf_counter() - start < 2
    forest = near_vectors._Forest(np.array([5, 9, 7, 20, 21, 30]))
    forest.add(np.array([5, 20, 30]), np.array([7, 9, 21]), np.array([[1, 1, 0], [0, 0, 1], [0, 0, 0]], dtype=bool))
    forest.add(np.array([9]), np.array([21, 7]), np.array([[1, 1]], dtype=bool))
    assert forest.kept == [(5, 7), (5, 9), (20, 21), (9, 21)]
