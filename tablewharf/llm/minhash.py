"""Near-duplicate documents by SuperMinHash, banding, exact verification and union-find."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewharf.llm.common import components, store

SHINGLE = 5
SIMILARITY = 80
BANDS, WIDTH = 24, 5
# Documents of one block; two blocks meet in a task.
BLOCK = 512
# Rows of a batch that are turned into Python objects at a time.
SLICE_ROWS = 500
# Bytes of text that are hashed at a time.
WINDOW = 1 << 20

BASE = np.uint64(0x9E3779B97F4A7C15)
FIRST = np.uint64(0xBF58476D1CE4E5B9)
SECOND = np.uint64(0x94D049BB133111EB)
WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


def mixed(values: np.ndarray) -> np.ndarray:
    """Scramble 64-bit keys."""
    values = (values ^ (values >> np.uint64(30))) * FIRST
    values = (values ^ (values >> np.uint64(27))) * SECOND
    return values ^ (values >> np.uint64(31))


def shingle_set(text: str | None, size: int) -> set[tuple[bytes, ...]]:
    """The distinct shingles of a text as words; this is what links are confirmed on."""
    words = WORDS.findall((text or "").encode().lower())
    if not words:
        return set()
    if len(words) < size:
        return {tuple(words)}
    return set(zip(*(words[i:] for i in range(size))))


def shingle_keys(text: str | None, size: int) -> np.ndarray:
    """64-bit keys of the distinct shingles of a text, in order."""
    data = (text or "").encode().lower()
    words = _word_keys(data)
    if not len(words):
        return words
    if len(words) < size:
        size = len(words)
    keys = words[: len(words) - size + 1].copy()
    for place in range(1, size):
        keys = mixed(keys * BASE + words[place : len(words) - size + 1 + place])
    return np.unique(keys)


def _word_keys(data: bytes) -> np.ndarray:
    found = []
    at = 0
    while at < len(data):
        end = min(len(data), at + WINDOW)
        if end < len(data):  # end the window in front of a word
            gap = max(data.rfind(s, at, end) for s in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c"))
            end = gap + 1 if gap >= 0 else _next_gap(data, end)
        part = np.frombuffer(data, dtype=np.uint8, count=end - at, offset=at)
        blank = (part == 32) | ((part >= 9) & (part <= 13))
        edge = np.diff(np.concatenate([[True], blank, [True]]).astype(np.int8))
        starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        if len(starts):
            found.append(_place_keys(part, starts, ends))
        at = end
    return np.concatenate(found) if found else np.empty(0, dtype=np.uint64)


def _next_gap(data: bytes, at: int) -> int:
    found = re.compile(rb"[\x20\x09-\x0D]").search(data, at)
    return found.start() if found else len(data)


def _place_keys(part: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Keys of byte ranges: sums of the scrambled pairs of place and byte, with the length."""
    sizes = ends - starts
    first = np.cumsum(sizes) - sizes
    place = np.arange(int(sizes.sum())) - np.repeat(first, sizes)
    pairs = mixed((place + 1).astype(np.uint64) * BASE + part[place + np.repeat(starts, sizes)])
    return mixed(np.add.reduceat(pairs, first) + sizes.astype(np.uint64))


def same_words(text: str | None) -> str:
    """A cryptographic digest of the words of a text in order."""
    return hashlib.blake2b(b" ".join((text or "").encode().lower().split()), digest_size=20).hexdigest()


def signatures(sets: list[np.ndarray], registers: int) -> np.ndarray:
    """SuperMinHash (Ertl, 2017) of many sets at once, as scrambled 64-bit registers.

    Every element walks through its own random permutation of the registers; at
    step j it offers j plus a random fraction to one register. A set is finished
    when j passes its greatest register, so large sets stop after a step or two.
    """
    lengths = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), lengths)
    elements = np.concatenate(sets) if sets else np.empty(0, dtype=np.uint64)
    lowest = np.full(len(sets) * registers, np.inf)
    order: np.ndarray | None = None
    for j in range(registers):
        if not len(elements):
            break
        draw = mixed(elements + np.uint64((j + 1) * int(BASE) % (1 << 64)))
        fraction = (mixed(draw ^ FIRST) >> np.uint64(11)).astype(float) / (1 << 53)
        pick = j + (draw >> np.uint64(32)).astype(np.int64) % (registers - j)
        if j == 0:
            target, first_pick = pick, pick
        else:
            rows = np.arange(len(elements))
            if order is None:
                order = np.tile(np.arange(registers, dtype=np.int16), (len(elements), 1))
                order[rows, first_pick], order[rows, 0] = 0, first_pick
            target = order[rows, pick].astype(np.int64)
            order[rows, pick] = order[rows, j]
        np.minimum.at(lowest, owner * registers + target, j + fraction)
        worst = lowest.reshape(len(sets), registers).max(axis=1)
        going = worst[owner] > j + 1
        if not going.all():
            elements, owner = elements[going], owner[going]
            if order is None:
                first_pick = first_pick[going]
            else:
                order = order[going]
    return mixed(lowest.view(np.uint64).reshape(len(sets), registers))


def sketch(docs: DataFrame, shingle: int, bands: int, width: int) -> DataFrame:
    """``row, doc_id, n_shingles, class_key, band_keys`` for each document.

    ``class_key`` is the digest of the words in order, so a class holds equal sets.
    ``band_keys`` holds one key per band, none for a set without shingles.
    """
    registers = bands * width

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            texts = batch.column(1).to_pylist()
            sets = [shingle_keys(text, shingle) for text in texts]
            bits: list[list[int] | None] = [None] * len(sets)
            some = [i for i, s in enumerate(sets) if len(s)]
            for group in _groups(some, sets):
                found = signatures([sets[i] for i in group], registers).reshape(len(group), bands, width)
                keys = np.full((len(group), bands), np.uint64(0))
                keys += np.arange(1, bands + 1, dtype=np.uint64)
                for place in range(width):
                    keys = mixed(keys * BASE + found[:, :, place])
                for i, row in zip(group, keys.view(np.int64)):
                    bits[i] = row.tolist()
            names = [same_words(text) for text in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(names, pa.string()),
                    pa.array(bits, pa.list_(pa.int64())),
                ],
                names=["doc_id", "n_shingles", "class_key", "band_keys"],
            )

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(sketched, f"doc_id {kind}, n_shingles long, class_key string, band_keys array<bigint>")


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of batches whose texts are held as Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(at, SLICE_ROWS)


def _groups(some: list[int], sets: list[np.ndarray]) -> Iterator[list[int]]:
    """Runs of sets that together stay small enough for the permutation table."""
    group, size = [], 0
    for i in some:
        if group and size + len(sets[i]) > 50_000:
            yield group
            group, size = [], 0
        group.append(i)
        size += len(sets[i])
    if group:
        yield group


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, similarity: int = SIMILARITY, bands: int = BANDS, width: int = WIDTH
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for each document.

    Words are runs between ASCII white space with A-Z in lower case; a document is its
    distinct shingles of ``shingle`` words (all words as one, if fewer). Two documents link if
    their sets share at least ``similarity`` percent of their union. Candidates share the key of a band of
    SuperMinHash registers; every link is confirmed on the full sets.

    Documents with the same words in the same order are one class and enter once. In a bucket, all members are
    compared with one centre first, which costs the bucket's size. Buckets that then still hold several
    components are finished in blocks: documents that hang together by such buckets are cut into blocks of
    ``BLOCK``, every two blocks meet in a task, and every two members of a bucket that are in different components and whose
    set sizes allow a link are tested there, most alike first. No candidate is left out.

    Documents without words, or with a null text, have no shingles, link with nothing and are kept; so are rows with a null id. Rows
    that repeat an id share its component. Texts of any length are read whole. An empty table gives no rows;
    other columns are ignored.
    """
    sketches = store(sketch(docs, shingle, bands, width), "near-sketches")
    usable = sketches.where("n_shingles > 0 and doc_id is not null")
    reps = usable.groupBy("class_key").agg(F.min(F.struct("doc_id", "n_shingles", "band_keys")).alias("r"))
    members = reps.select(F.col("r.doc_id").alias("id"), F.col("r.n_shingles").alias("n"), F.explode("r.band_keys").alias("key"))
    shared = members.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1").select("key")
    members = store(members.join(shared, "key"), "near-buckets")
    texts = docs.select(F.col("doc_id").alias("id"), F.col("text").cast("string").alias("text"))
    texts = store(texts.join(members.select("id").distinct(), "id", "left_semi"), "near-texts")

    close = F.lit(100) * F.least("n", "centre_n") >= F.lit(similarity) * F.greatest("n", "centre_n")
    pairs = _starred(members).where(close).select("id", "centre").distinct()
    parts = components(confirmed(pairs, texts, shingle, similarity), "near-parts")
    parted = members.join(parts, F.col("id") == F.col("node"), "left").select(
        "key", "id", F.coalesce("component", "id").alias("component")
    )
    several = parted.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.min("id").alias("first"))
    parted = store(parted.join(several.where("low <> high").select("key", "first"), "key"), "near-open")
    if not parted.isEmpty():
        bands_of = reps.select(F.col("r.doc_id").alias("id"), F.col("r.band_keys").alias("band_keys"))
        parts = _united(parts, _finished(parted, bands_of, texts, shingle, similarity))

    # A class is named by its smallest id, and so is a component of classes: the ids that
    # one class shares with another through repeated rows are joined at last.
    classes = reps.select("class_key", F.col("r.doc_id").alias("rep")).join(parts, F.col("rep") == F.col("node"), "left")
    named = classes.select("class_key", F.coalesce("component", "rep").alias("component_id"))
    rows = sketches.join(named, "class_key", "left")
    component = F.when(F.col("doc_id").isNull() | (F.col("n_shingles") == 0), F.col("doc_id")).otherwise(F.col("component_id"))
    rows = rows.select("doc_id", "n_shingles", component.alias("component_id"))
    lowest = rows.groupBy("doc_id").agg(F.min("component_id").alias("low"))
    lowest = lowest.where("low <> doc_id")
    return rows.join(lowest.withColumnRenamed("doc_id", "low_id"), F.col("doc_id") == F.col("low_id"), "left").select(
        "doc_id", "n_shingles", F.coalesce("low", "doc_id").alias("component_id"), F.col("low").isNull().alias("kept")
    )


def _united(parts: DataFrame, links: DataFrame) -> DataFrame:
    """Components ``(node, component)`` after more links, which are followed between components only."""
    label = parts.select(F.col("node").alias("a"), F.col("component").alias("label_a"))
    other = parts.select(F.col("node").alias("b"), F.col("component").alias("label_b"))
    edges = links.join(label, "a", "left").join(other, "b", "left").select(
        F.coalesce("label_a", "a").alias("a"), F.coalesce("label_b", "b").alias("b")
    )
    joint = components(edges, "near-joint").select("node", F.col("component").alias("joint"))
    moved = parts.select("node", F.col("component").alias("old")).join(
        joint.select(F.col("node").alias("old"), "joint"), "old", "left"
    )
    moved = moved.select("node", F.coalesce("joint", "old").alias("component"))
    new = joint.join(parts.select("node"), "node", "left_anti").select("node", F.col("joint").alias("component"))
    return store(moved.union(new), "near-parts")


def _starred(members: DataFrame) -> DataFrame:
    """Every member of a bucket with the bucket's centre."""
    centre = F.min(F.struct(F.xxhash64("id").alias("order"), "id", "n")).alias("c")
    centres = members.groupBy("key").agg(centre)
    named = centres.select("key", F.col("c.id").alias("centre"), F.col("c.n").alias("centre_n"))
    return members.join(named, "key").where("id <> centre")


def _finished(parted: DataFrame, bands_of: DataFrame, texts: DataFrame, shingle: int, similarity: int) -> DataFrame:
    """Links between members of open buckets that are still in different components, as ``(a, b)``."""
    chains = components(parted.select(F.col("first").alias("a"), F.col("id").alias("b")), "near-chains")
    clusters = chains.select(F.col("node").alias("id"), F.col("component").alias("cluster"))
    nodes = parted.select("id", "component").distinct().join(clusters, "id")
    sizes = nodes.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    nodes = nodes.join(sizes, "cluster").withColumn("block", F.expr("pmod(xxhash64(id), blocks)"))
    nodes = nodes.join(bands_of, "id").join(texts, "id")
    partner = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("partner")
    met = nodes.select("cluster", "block", partner, "id", "component", "band_keys", "text")
    met = met.withColumns({"one": F.least("block", "partner"), "two": F.greatest("block", "partner")})
    kind = nodes.schema["id"].dataType.simpleString()

    def test(table: pa.Table) -> pa.Table:
        found = _tested(table, shingle, similarity)
        return pa.table({name: pa.array(ids, table.schema.field("id").type) for name, ids in zip("ab", found)})

    chosen = met.select("cluster", "one", "two", "block", "id", "component", "band_keys", "text")
    return store(chosen.groupBy("cluster", "one", "two").applyInArrow(test, f"a {kind}, b {kind}"), "near-links")


def _tested(table: pa.Table, shingle: int, similarity: int) -> tuple[list, list]:
    ids, named = table.column("id").to_pylist(), table.column("component").to_pylist()
    blocks, first = table.column("block").to_numpy(), table.column("one")[0].as_py()
    bands = np.array(table.column("band_keys").to_pylist(), dtype=np.int64)
    texts = table.column("text").to_pylist()
    sets = [shingle_keys(text, shingle) for text in texts]
    sizes = np.array([len(s) for s in sets])
    label = np.unique(np.array(named), return_inverse=True)[1]
    left = np.flatnonzero(blocks == first)
    right = left if table.column("two")[0].as_py() == first else np.flatnonzero(blocks != first)
    alike = np.zeros((len(left), len(right)), dtype=np.int16)
    for band in range(bands.shape[1]):
        alike += bands[left, band][:, None] == bands[right, band][None, :]
    small = np.minimum(sizes[left][:, None], sizes[right][None, :])
    large = np.maximum(sizes[left][:, None], sizes[right][None, :])
    alike[(label[left][:, None] == label[right][None, :]) | (100 * small < similarity * large)] = 0
    rows, columns = np.nonzero(alike)
    order = np.argsort(-alike[rows, columns], kind="stable")
    root = list(range(int(label.max()) + 1))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    found: tuple[list, list] = ([], [])
    for i, j in zip(left[rows[order]].tolist(), right[columns[order]].tolist()):
        a, b = find(int(label[i])), find(int(label[j]))
        if a == b:
            continue
        one, two = sets[i], sets[j]
        place = np.searchsorted(two, one)
        place[place == len(two)] = 0
        common = int(np.count_nonzero(two[place] == one))
        if 100 * common < similarity * (len(one) + len(two) - common):
            continue
        ours, theirs = shingle_set(texts[i], shingle), shingle_set(texts[j], shingle)
        common = len(ours & theirs)
        if 100 * common >= similarity * len(ours | theirs):
            root[max(a, b)] = min(a, b)
            found[0].append(ids[i])
            found[1].append(ids[j])
    return found


def confirmed(pairs: DataFrame, texts: DataFrame, shingle: int, similarity: int) -> DataFrame:
    """The pairs ``(id, centre)`` that link, as ``(a, b)``."""
    kind = pairs.schema["id"].dataType.simpleString()
    left = texts.withColumnRenamed("text", "left_text")
    right = texts.select(F.col("id").alias("centre"), F.col("text").alias("right_text"))
    both = pairs.join(left, "id").join(right, "centre").select("id", "centre", "left_text", "right_text")

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[str, set] = ("", set())
        for batch in _slices(batches):
            keep = []
            for ours, theirs in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                if theirs != last[0]:
                    last = (theirs, shingle_set(theirs, shingle))
                mine, centre = shingle_set(ours, shingle), last[1]
                common = len(mine & centre)
                keep.append(100 * common >= similarity * (len(mine) + len(centre) - common))
            kept = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"])
            yield kept.filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(linked, f"a {kind}, b {kind}")
