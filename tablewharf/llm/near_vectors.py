"""Near-duplicate vectors by cosine with hierarchical navigable small-world graphs."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewharf.llm.common import components, store
from tablewharf.llm.shards import matrix
from tablewharf.llm.vector_search import usable

COSINE = 0.95
# At least so many shards; more where a shard would hold more rows than this.
SHARDS, SHARD_ROWS = 8, 32_768
# Queries that meet a shard in one task.
BLOCK_ROWS = 65_536
# Links of a node, the beam to start with, and nodes that a beam opens at a time.
DEGREE, BEAM, OPENED = 16, 32, 4
# Share of audited vectors that must find all their true links, or beams widen; and how many queries, and planted vectors,
# each task audits.
RECALL, AUDITED = 0.98, 64
CHUNK = 512


class SmallWorld:
    """Layers of navigable graphs over unit vectors, upper ones over fewer nodes.

    Layers are built from the top. In each, nodes enter in batches: a batch searches
    what is there, links to near and mutually distant neighbours, and those link back.
    """

    def __init__(self, points: np.ndarray, levels: np.ndarray, links: list[np.ndarray] | None = None) -> None:
        self.points, self.levels = points, levels
        self.members = [np.flatnonzero(levels >= level) for level in range(int(levels.max(initial=0)) + 1)]
        self.links = links or [None] * len(self.members)
        if links is None:
            for level in range(len(self.members) - 1, -1, -1):
                self.links[level] = self._layer(level)

    def _layer(self, level: int) -> np.ndarray:
        members = self.members[level]
        links = np.full((len(self.points), 2 * DEGREE if level == 0 else DEGREE), -1, dtype=np.int32)
        done = 0
        while done < len(members):
            batch = members[done : done + max(1, min(CHUNK, max(64, done)))]
            near, scores = self._rivals(batch)
            if done:
                entries = self.enter(self.points[batch], level)
                entries = np.where(np.isin(entries, members[:done]), entries, members[0])
                found, found_scores = self.beam(self.points[batch], entries, links, BEAM)
                near, scores = np.hstack([near, found]), np.hstack([scores, found_scores])
            chosen = self._choose(near, scores, DEGREE)
            links[batch, :DEGREE] = chosen
            self._link_back(batch, chosen, links)
            done += len(batch)
        return links

    def _rivals(self, batch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Near neighbours inside a batch."""
        scores = self.points[batch] @ self.points[batch].T
        np.fill_diagonal(scores, -2)
        keep = min(BEAM, len(batch))
        order = np.argsort(-scores, axis=1, kind="stable")[:, :keep]
        scores = np.take_along_axis(scores, order, axis=1)
        return np.where(scores > -2, batch[order], -1), scores

    def _choose(self, near: np.ndarray, scores: np.ndarray, degree: int) -> np.ndarray:
        """From sorted candidates those nearer to the node than to one chosen before, then the nearest others."""
        scores = np.where(near < 0, -2.0, scores)
        order = np.argsort(-scores, axis=1, kind="stable")
        near, scores = np.take_along_axis(near, order, axis=1), np.take_along_axis(scores, order, axis=1)
        repeated = (near[:, :, None] == near[:, None, :]) & np.tri(near.shape[1], k=-1, dtype=bool)
        scores = np.where(repeated.any(axis=2), -2.0, scores)
        vectors = self.points[near]
        between = np.matmul(vectors, vectors.transpose(0, 2, 1))
        taken = np.zeros(near.shape, dtype=bool)
        for k in range(near.shape[1]):
            shaded = (taken & (between[:, k] > scores[:, k, None])).any(axis=1)
            taken[:, k] = ~shaded & (scores[:, k] > -2) & (taken.sum(axis=1) < degree)
        rank = np.where(scores <= -2, 3.0, np.where(taken, 0.0, 1.0)) - scores / 4
        order = np.argsort(rank, axis=1, kind="stable")[:, :degree]
        chosen = np.take_along_axis(np.where(scores > -2, near, -1), order, axis=1).astype(np.int32)
        if chosen.shape[1] < degree:
            chosen = np.pad(chosen, ((0, 0), (0, degree - chosen.shape[1])), constant_values=-1)
        return chosen

    def _link_back(self, batch: np.ndarray, chosen: np.ndarray, links: np.ndarray) -> None:
        source = np.repeat(batch, chosen.shape[1])
        target = chosen.ravel()
        source, target = source[target >= 0], target[target >= 0]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        nodes, first, counts = np.unique(target, return_index=True, return_counts=True)
        width = links.shape[1]
        for low in range(0, len(nodes), CHUNK):
            some = slice(low, low + CHUNK)
            extra = np.full((len(nodes[some]), min(int(counts[some].max()), 2 * BEAM)), -1, dtype=np.int64)
            for row, (at, n) in enumerate(zip(first[some], counts[some])):
                n = min(n, extra.shape[1])
                extra[row, :n] = source[at : at + n]
            near = np.hstack([links[nodes[some]], extra])
            scores = np.einsum("bkd,bd->bk", self.points[near], self.points[nodes[some]])
            links[nodes[some]] = self._choose(near, scores, width)

    def enter(self, queries: np.ndarray, level: int) -> np.ndarray:
        """The nodes at which queries enter a layer: the best found in the layers above."""
        at = np.full(len(queries), self.members[-1][0])
        for above in range(len(self.members) - 1, level, -1):
            found, _ = self.beam(queries, at, self.links[above], 4)
            at = found[:, 0]
        return at

    def beam(self, queries: np.ndarray, entries: np.ndarray, links: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The best nodes of each query, in order, by opening the best unopened ones of its beam."""
        n = len(queries)
        ids = np.full((n, width), -1, dtype=np.int64)
        scores = np.full((n, width), -3.0, dtype=np.float32)
        opened = np.ones((n, width), dtype=bool)
        seen = np.zeros((n, len(self.points) + 1), dtype=bool)
        ids[:, 0], opened[:, 0] = entries, False
        scores[:, 0] = np.einsum("bd,bd->b", self.points[entries], queries)
        seen[np.arange(n), entries] = True
        seen[:, -1] = True
        active = np.arange(n)
        while len(active):
            waiting = np.where(opened[active], -4.0, scores[active])
            best = np.argsort(-waiting, axis=1, kind="stable")[:, :OPENED]
            real = np.take_along_axis(waiting, best, axis=1) > -3
            active, best, real = active[real[:, 0]], best[real[:, 0]], real[real[:, 0]]
            if not len(active):
                break
            rows = active[:, None]
            opened[rows, best] = True
            near = links[ids[rows, best]]
            near[~real] = -1
            near = near.reshape(len(active), -1).astype(np.int64)
            near = np.sort(near, axis=1)
            near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
            near[seen[rows, near]] = -1
            seen[rows, near] = True
            found = np.einsum("bkd,bd->bk", self.points[near], queries[active])
            found[near < 0] = -3.0
            all_ids = np.hstack([ids[active], near])
            all_scores = np.hstack([scores[active], found])
            all_opened = np.hstack([opened[active], near < 0])
            keep = np.argsort(-all_scores, axis=1, kind="stable")[:, :width]
            ids[active] = np.take_along_axis(all_ids, keep, axis=1)
            scores[active] = np.take_along_axis(all_scores, keep, axis=1)
            opened[active] = np.take_along_axis(all_opened, keep, axis=1)
        return ids, scores

    def within(self, queries: np.ndarray, cosine: float, width: int) -> tuple[np.ndarray, np.ndarray]:
        """``(query, node)`` pairs found with at least this cosine, about; a query whose
        beam is half full of hits searches again with twice the beam."""
        pairs = []
        todo = np.arange(len(queries))
        while len(todo):
            width = min(width, len(self.points))
            rest = []
            for low in range(0, len(todo), CHUNK):
                some = todo[low : low + CHUNK]
                ids, scores = self.beam(queries[some], self.enter(queries[some], 0), self.links[0], width)
                hits = scores >= cosine
                full = (hits.sum(axis=1) > width // 2) & (width < len(self.points))
                rest.append(some[full])
                row, column = np.nonzero(hits & ~full[:, None])
                pairs.append((some[row], ids[row, column]))
            todo, width = np.concatenate(rest), 2 * width
        found = [np.concatenate(x) for x in zip(*pairs)] if pairs else [np.empty(0, dtype=np.int64)] * 2
        return found[0], found[1]


def units(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length 1 in double precision; scaled first, so that squares stay finite."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def level_of(names: np.ndarray) -> np.ndarray:
    """Random layers, fixed by the name of the node: each upper layer has a ``DEGREE``th of the nodes."""
    mixed = (names.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    part = ((mixed >> np.uint64(11)).astype(float) + 1) / (1 << 53)
    return np.floor(-np.log(part) / math.log(DEGREE)).astype(np.int64)


def near_vectors(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row.

    Equal vectors are one class and enter once. Classes are dealt into shards, each with a
    graph that is built once and stored; every class queries every shard. Beams widen while they are
    full of hits, and until the share ``RECALL`` of a sample of queries that have links finds all that brute force finds. Every
    link is verified in double precision, against all nodes of the shard that hang together with a
    query's hits. A task keeps counts and a spanning forest of its links, not the links of a dense group.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing and
    are kept. Vectors of different length do not link. Rows that repeat an id are vectors of their own;
    null ids are ordinary rows that name no component. An empty table gives no rows; other columns are ignored.
    """
    vector = F.col("embedding").cast("array<double>")
    good = usable(vector) & F.coalesce(F.exists(vector, lambda x: x != 0), F.lit(False))
    rows = vectors.select("vec_id", F.when(good, vector).alias("v"))
    classes = rows.where("v is not null").groupBy("v").agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("low"))
    classes = store(classes.withColumns({"c": F.monotonically_increasing_id(), "dim": F.size("v")}), "vectors-classes")
    count = classes.count()
    shards = max(SHARDS, -(-count // SHARD_ROWS))
    blocks = max(1, -(-count // BLOCK_ROWS))

    dealt = classes.withColumn("shard", F.pmod(F.xxhash64("c"), F.lit(shards)).cast("int"))
    graphs = store(_built(dealt), "vectors-graphs")
    asked = classes.select(
        "dim",
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
        F.pmod(F.xxhash64("c", F.lit(3)), F.lit(blocks)).cast("int").alias("block"),
        "c",
        "v",
    )
    spread = graphs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    found = store(_searched(spread, asked, cosine), "vectors-found")

    linked = found.where("other is null").groupBy("c").agg(F.sum("links").alias("links"))
    joint = components(found.where("other is not null").select(F.col("c").alias("a"), F.col("other").alias("b")), "vectors-parts")
    placed = classes.join(joint, F.col("c") == F.col("node"), "left").join(linked, "c", "left").select(
        F.col("v").alias("class_v"), "low", "n", F.coalesce("component", "c").alias("component"), F.coalesce("links", F.lit(0)).alias("links")
    )
    lowest = placed.groupBy("component").agg(F.min("low").alias("component_id"))
    placed = placed.join(lowest, "component")
    joined = rows.join(placed, F.col("v") == F.col("class_v"), "left")
    component = F.coalesce("component_id", "vec_id")
    return joined.select(
        "vec_id",
        F.coalesce(F.col("links") + F.col("n") - 1, F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        component.eqNullSafe(F.col("vec_id")).alias("kept"),
    )


def _built(dealt: DataFrame) -> DataFrame:
    def build(table: pa.Table) -> pa.Table:
        names = table.column("c").to_numpy()
        order = np.argsort(names)
        table = table.take(pa.array(order))
        levels = level_of(names[order])
        world = SmallWorld(units(matrix(table.column("v"))).astype(np.float32), levels)
        links = [[world.links[k][row].tolist() for k in range(levels[row] + 1)] for row in range(len(order))]
        kept = table.select(["dim", "shard", "c", "n", "v"])
        return kept.append_column("links", pa.array(links, pa.list_(pa.list_(pa.int32()))))

    chosen = dealt.select("dim", "shard", "c", "n", "v")
    return chosen.groupBy("dim", "shard").applyInArrow(
        build, "dim int, shard int, c long, n long, v array<double>, links array<array<int>>"
    )


def _searched(graphs: DataFrame, asked: DataFrame, cosine: float) -> DataFrame:
    """Counts ``(c, null, links)`` and forest links ``(c, other, null)``."""

    def search(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        out: tuple[list, list, list] = ([], [], [])
        if left.num_rows and right.num_rows:
            left, right = (side.take(pa.array(np.argsort(side.column("c").to_numpy()))) for side in (left, right))
            names = right.column("c").to_numpy()
            nodes, weights = left.column("c").to_numpy(), left.column("n").to_numpy()
            exact, queries = units(matrix(left.column("v"))), units(matrix(right.column("v")))
            world = _restored(exact.astype(np.float32), left.column("links").to_pylist())
            place = np.minimum(np.searchsorted(nodes, names), len(nodes) - 1)
            hits = _audited(world, queries, exact, cosine, np.where(nodes[place] == names, place, -1))
            for group, near in _together(*hits, len(queries), len(nodes)):
                counts = np.zeros(len(group), dtype=np.int64)
                forest = _Forest(np.concatenate([names[group], nodes[near]]))
                for low in range(0, len(group), CHUNK):
                    some = group[low : low + CHUNK]
                    links = queries[some] @ exact[near].T >= cosine
                    links &= names[some][:, None] != nodes[near][None, :]
                    counts[low : low + len(some)] = links @ weights[near]
                    forest.add(names[some], nodes[near], links)
                out[0].extend(names[group].tolist())
                out[1].extend([None] * len(group))
                out[2].extend(counts.tolist())
                for a, b in forest.kept:
                    out[0].append(a)
                    out[1].append(b)
                    out[2].append(None)
        columns = zip(("c", "other", "links"), out)
        return pa.table({name: pa.array(values, pa.int64()) for name, values in columns})

    keys = ["dim", "shard", "block"]
    graphs = graphs.select([F.col(c).alias(c) for c in graphs.columns])
    asked = asked.select([F.col(c).alias(c) for c in asked.columns])
    return graphs.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(search, "c long, other long, links long")


def _restored(points: np.ndarray, links: list[list[list[int]]]) -> SmallWorld:
    levels = np.array([len(own) - 1 for own in links])
    layers = []
    for level in range(levels.max(initial=0) + 1):
        layer = np.full((len(points), 2 * DEGREE if level == 0 else DEGREE), -1, dtype=np.int32)
        for row in np.flatnonzero(levels >= level):
            layer[row] = links[row][level]
        layers.append(layer)
    return SmallWorld(points, levels, layers)


def _planted(exact: np.ndarray, cosine: float, rng: np.random.Generator) -> np.ndarray:
    """Queries a little above the threshold from some stored vectors, at most ``AUDITED``."""
    stored = exact[rng.choice(len(exact), min(AUDITED, len(exact)), replace=False)]
    noise = rng.normal(size=stored.shape)
    noise = units(noise - (noise * stored).sum(axis=1, keepdims=True) * stored)
    near = rng.uniform(cosine, min(1.0, cosine + 0.02), size=(len(stored), 1))
    return units(near * stored + np.sqrt(1 - near**2) * noise)


def _audited(
    world: SmallWorld, queries: np.ndarray, exact: np.ndarray, cosine: float, own: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Candidate pairs from the graph; ``own`` is each query's own node, or -1.

    The audit compares a bounded number of vectors with all nodes: ``AUDITED`` of the queries and as many planted
    ones, which have a link even where the queries' links are rare. The beam widens until the share ``RECALL`` of
    the audited vectors with links hang together with every one of theirs.
    """
    own = np.full(len(queries), -1) if own is None else own
    rng = np.random.default_rng(len(queries))
    asked = rng.choice(len(queries), min(AUDITED, len(queries)), replace=False)
    sample = np.concatenate([queries[asked], _planted(exact, cosine, rng)])
    true = sample @ exact.T >= cosine
    inside = np.flatnonzero(own[asked] >= 0)
    true[inside, own[asked][inside]] = False
    true = np.column_stack(np.nonzero(true))
    near, width = sample.astype(np.float32), BEAM
    while True:
        row, node = world.within(near, cosine - 1e-4, width)
        if _complete(true, _labels(row, node, len(sample), len(exact)), len(sample)) >= RECALL:
            return world.within(queries.astype(np.float32), cosine - 1e-4, width)
        if width >= len(exact):
            return _exhaustive(queries.astype(np.float32), world.points, cosine - 1e-4)
        width *= 2


def _complete(true: np.ndarray, label: np.ndarray, queries: int) -> float:
    """Share of the queries in true links that hang together with all of theirs."""
    asked, place = np.unique(true[:, 0], return_inverse=True)
    missed = np.bincount(place, weights=label[true[:, 0]] != label[true[:, 1] + queries], minlength=len(asked))
    return float((missed == 0).mean()) if len(asked) else 1.0


def _exhaustive(queries: np.ndarray, points: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """All pairs, for a graph whose widest beam does not reach enough."""
    found = [np.nonzero(queries[low : low + CHUNK] @ points.T >= cosine) for low in range(0, len(queries), CHUNK)]
    rows = np.concatenate([row + k * CHUNK for k, (row, _) in enumerate(found)])
    return rows, np.concatenate([node for _, node in found])


def _labels(query: np.ndarray, node: np.ndarray, queries: int, nodes: int) -> np.ndarray:
    """The group of every query, then of every node, by candidate pairs."""
    label = np.arange(queries + nodes)
    a, b = query, node + queries
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            break
    return label


def _together(query: np.ndarray, node: np.ndarray, queries: int, nodes: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Queries and nodes that hang together by candidate pairs, group by group."""
    label = _labels(query, node, queries, nodes)
    a, b = query, node + queries
    touched = np.unique(np.concatenate([a, b])) if len(a) else np.empty(0, dtype=np.int64)
    order = touched[np.argsort(label[touched], kind="stable")]
    edges = np.flatnonzero(np.diff(label[order])) + 1
    for group in np.split(order, edges) if len(order) else []:
        yield group[group < queries], group[group >= queries] - queries


class _Forest:
    """Labels of trees over names; keeps the links that join two trees."""

    def __init__(self, names: np.ndarray) -> None:
        self.names = np.unique(names)
        self.label = np.arange(len(self.names))
        self.kept: list[tuple[int, int]] = []

    def add(self, left: np.ndarray, right: np.ndarray, links: np.ndarray) -> None:
        places = np.searchsorted(self.names, right)
        for row, own in enumerate(np.searchsorted(self.names, left)):
            linked = places[links[row]]
            trees, first = np.unique(self.label[linked], return_index=True)
            other = trees != self.label[own]
            if not other.any():
                continue
            self.kept += [(int(left[row]), int(self.names[place])) for place in linked[first[other]]]
            self.label[np.isin(self.label, trees)] = self.label[own]
