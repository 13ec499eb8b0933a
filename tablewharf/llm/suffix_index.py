"""Long passages that repeat, found with a logarithmic family of sampled suffix arrays.

A suffix array over every byte would take eight bytes for each byte of text and level. The
arrays here hold a sample that cannot miss a long match: every string of ``LENGTH`` bytes has one
anchor, the place of its smallest key of ``GRAM`` bytes, and equal strings have equal anchors. All
strings with the same anchor form one covered piece of text. An array holds, in order, for each anchor the key
of its first ``GRAM`` bytes and the digest of its piece: about one entry for 85 bytes. Keys of anchors only
bring pieces together. What decides that bytes are equal is a cryptographic digest under a secret of the
run, or the bytes themselves.
"""

from __future__ import annotations

import hashlib
import secrets
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewharf.llm.common import store
from tablewharf.llm.minhash import BASE, mixed

LENGTH = 200
GRAM = 32
# Batches in which one call adds its documents to the index.
BATCHES = 4
# Starts that are examined at a time in a long text.
WINDOW = 1 << 20
# Above this many different pieces around one anchor, their strings are spread one by one.
CROWD = 2000

_POWERS: list[np.ndarray] = []


def _sums(part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS:
        size = WINDOW + 2 * LENGTH + 2
        ups, downs = np.full(size, BASE), np.full(size, np.uint64(pow(int(BASE), -1, 1 << 64)))
        ups[0] = downs[0] = 1
        _POWERS[:] = [np.multiply.accumulate(ups), np.multiply.accumulate(downs)]
    sums = np.zeros(len(part) + 1, dtype=np.uint64)
    np.cumsum((part.astype(np.uint64) + np.uint64(1)) * _POWERS[0][: len(part)], out=sums[1:])
    return sums, _POWERS[1]


def digest(data: bytes, secret: bytes) -> int:
    """64 bits of a keyed cryptographic digest: without the secret nobody can make two texts agree."""
    return int.from_bytes(hashlib.blake2b(data, digest_size=8, key=secret).digest(), "little", signed=True)


def pieces(data: bytes, length: int = LENGTH, gram: int = GRAM, secret: bytes = b"") -> tuple[np.ndarray, ...]:
    """``(first start, last start, anchor key, piece digest)`` of the strings of ``length``
    bytes, by anchor; a piece runs from its first start to ``length`` bytes after its last."""
    found = []
    width = length - gram + 1
    for at in range(0, len(data) - length + 1, WINDOW):
        part = np.frombuffer(data, dtype=np.uint8, offset=at, count=min(len(data) - at, WINDOW + length - 1))
        sums, downs = _sums(part)
        n = len(part) - gram + 1
        keys = mixed((sums[gram:] - sums[:n]) * downs[:n])
        marked = (keys & np.uint64(0xFFFFFFFFFF000000)) | np.arange(n, dtype=np.uint64)
        starts = len(part) - length + 1
        anchors = (_sliding_min(marked, width)[:starts] & np.uint64(0xFFFFFF)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], anchors[1:] != anchors[:-1]]))
        last = np.append(first[1:], starts) - 1
        whole = [digest(data[a:b], secret) for a, b in zip((first + at).tolist(), (last + at + length).tolist())]
        found.append((first + at, last + at, keys[anchors[first]].view(np.int64), np.array(whole, dtype=np.int64)))
    if not found:
        none = np.empty(0, dtype=np.int64)
        return none, none, none, none
    return tuple(np.concatenate(x) for x in zip(*found))


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minima of all runs of ``width`` values (van Herk)."""
    n = len(values)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:n] = values
    table = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    back = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


def suffix_array(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, secret: bytes = b"") -> DataFrame:
    """The sampled suffix array of documents ``(id, data)``: ``anchor, piece, id`` and ``n``,
    how often the document has the piece."""

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, anchors, wholes, counts = [], [], [], []
            for row, data in enumerate(batch.column(1).to_pylist()):
                if len(data) >= length:
                    _, _, anchor, whole = pieces(data, length, gram, secret)
                    whole, first, n = np.unique(whole, return_index=True, return_counts=True)
                    anchors.append(anchor[first])
                    wholes.append(whole)
                    counts.append(n)
                    rows.append(np.full(len(whole), row))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(anchors)),
                        pa.array(np.concatenate(wholes)),
                        batch.column(0).take(pa.array(np.concatenate(rows))),
                        pa.array(np.concatenate(counts), pa.int64()),
                    ],
                    names=["anchor", "piece", "id", "n"],
                )

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(entries, f"anchor long, piece long, id {kind}, n long")


def _sorted(array: DataFrame) -> DataFrame:
    ordered = array.repartitionByRange("anchor", "piece", "id").sortWithinPartitions("anchor", "piece", "id")
    return store(ordered, "suffix-level")


class SuffixIndex:
    """Levels of sorted arrays; a level of size 2**k holds as many batches.

    ``add`` sorts the array of a new batch and scans it in merge order against each level
    for anchors that both hold. Before a batch is added, levels of equal size merge, so n batches leave
    about log2(n) levels and every entry is rewritten about log2(n) times.
    """

    def __init__(self) -> None:
        self.levels: list[tuple[int, DataFrame]] = []
        self.matches: list[DataFrame] = []

    def add(self, array: DataFrame) -> None:
        self._merge_equal()
        new = _sorted(array)
        inside = new.groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1").select("anchor")
        found = [inside]
        keys = new.select("anchor").distinct()
        for _, level in self.levels:
            found.append(keys.join(level.select("anchor"), "anchor", "left_semi"))
        shared = found[0]
        for more in found[1:]:
            shared = shared.union(more)
        self.matches.append(store(shared.distinct() if len(found) > 1 else shared, "suffix-matches"))
        self.levels.append((1, new))

    def _merge_equal(self) -> None:
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            size, newer = self.levels.pop()
            _, older = self.levels.pop()
            self.levels.append((2 * size, _sorted(older.union(newer))))

    def matched(self) -> DataFrame:
        """All entries whose anchor occurs more than once."""
        anchors = self.matches[0]
        for more in self.matches[1:]:
            anchors = anchors.union(more)
        entries = self.levels[0][1]
        for _, level in self.levels[1:]:
            entries = entries.union(level)
        return entries.join(anchors.distinct(), "anchor", "left_semi")


def repeated_passages(
    docs: DataFrame,
    length: int = LENGTH,
    gram: int = GRAM,
    batches: int = BATCHES,
    id_column: str = "doc_id",
    whole_characters: bool = False,
) -> DataFrame:
    """Find every byte that a string of ``length`` bytes covers which also starts anywhere else.

    Texts are UTF-8 bytes; matches stay inside a document, overlaps count, and strings are
    judged on the input. Returns for every row ``row`` (a struct of all input columns), ``n_bytes``,
    ``n_removed``, ``spans`` (maximal runs ``[first, end)`` of such bytes) and ``kept`` (the other bytes).

    Batches of documents enter the index one after the other. Pieces that occur twice repeat as a
    whole. Where one anchor stands in different pieces, their strings are compared byte by byte in a
    suffix array of the pieces around that anchor; where very many pieces share an anchor, by the digests
    of their strings, which spread over all tasks. With ``whole_characters``, spans shrink to whole characters,
    so that the kept bytes are a text again.

    Rows go by a hash of id and text, so neither null ids nor repeated ones gather; what two rows with one hash share are lists of
    pieces, which are told by their bytes. Null texts are empty; texts shorter than ``length`` keep everything; longer
    ones are read whole, in windows. Null ids and repeated ids are ordinary rows. An empty table gives no rows.
    """
    key = F.xxhash64(id_column, F.col("text").cast("string")).alias("id")
    data = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("data")
    texts = docs.select(key, data)
    secret = secrets.token_bytes(32)
    index = SuffixIndex()
    for number in range(batches):
        share = texts.where(F.pmod("id", F.lit(batches)) == number)
        index.add(suffix_array(share, length, gram, secret))

    matched = store(index.matched(), "suffix-matched")
    classes = matched.groupBy("anchor", "piece").agg(F.sum("n").alias("n"), F.min("id").alias("holder"))
    anchors = classes.groupBy("anchor").agg(F.count(F.lit(1)).alias("pieces"))
    judged = classes.join(anchors, "anchor").where("n > 1 or pieces > 1")
    judged = store(judged.select("anchor", "piece", "n", "pieces", "holder"), "suffix-judged")
    whole = matched.join(judged.where("n > 1").select("anchor", "piece"), ["anchor", "piece"], "left_semi")
    whole = whole.select("id", "piece", F.lit(0).alias("first"), F.lit(-1).alias("last")).distinct()

    crowded = (F.col("pieces") > CROWD).alias("crowded")
    asked = judged.where("pieces > 1").select(F.col("holder").alias("id"), F.struct("piece", crowded).alias("ask"))
    asked = asked.groupBy("id").agg(F.collect_list("ask").alias("asks"))
    holders = _joined(texts.withColumn("check", F.xxhash64(F.lit(1), "data")), asked, "inner").dropDuplicates(["id", "check"])
    cut = store(_cut(holders, length, gram, secret), "suffix-pieces")
    calm = cut.where("data is not null").repartition("anchor").sortWithinPartitions("anchor")
    part = _compared(calm, length)
    strings = cut.where("data is null")
    twice = strings.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor")
    loose = strings.join(twice, "anchor", "left_semi").select("id", "piece", "first", F.col("first").alias("last"))
    found = whole.union(part.select("id", "piece", "first", "last")).union(loose)
    entire = F.collect_list(F.when(F.col("last") < 0, F.col("piece"))).alias("entire")
    parts = F.collect_list(F.when(F.col("last") >= 0, F.struct("piece", "first", "last"))).alias("parts")
    found = found.groupBy("id").agg(entire, parts)
    rows = docs.select(key, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), data)
    return _removed(_joined(rows, found, "left"), length, gram, whole_characters, secret)


def _joined(rows: DataFrame, lists: DataFrame, how: str) -> DataFrame:
    named = lists.withColumnRenamed("id", "list_id")
    return rows.join(named, F.col("id") == F.col("list_id"), how).drop("list_id")


def _cut(asked: DataFrame, length: int, gram: int, secret: bytes) -> DataFrame:
    """The bytes of the asked pieces, by anchor; of crowded ones, the key of every string."""

    def bytes_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [])
            for row, (data, asks) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
                first, last, anchor, piece = pieces(data, length, gram, secret)
                calm = {a["piece"] for a in asks if not a["crowded"]}
                crowded = {a["piece"] for a in asks if a["crowded"]}
                for k in range(len(piece)):
                    name = int(piece[k])
                    if name in calm:
                        calm.discard(name)
                        _append(out, row, int(anchor[k]), name, 0, data[first[k] : last[k] + length])
                    elif name in crowded:
                        crowded.discard(name)
                        for start, string in enumerate(_string_digests(data[first[k] : last[k] + length], length, secret)):
                            _append(out, row, string, name, start, None)
            rows, anchors, names, starts, texts = out
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows, pa.int64())),
                    pa.array(anchors, pa.int64()),
                    pa.array(names, pa.int64()),
                    pa.array(starts, pa.int32()),
                    pa.array(texts, pa.binary()),
                ],
                names=["id", "anchor", "piece", "first", "data"],
            )

    kind = asked.schema["id"].dataType.simpleString()
    chosen = asked.select("id", "data", "asks")
    return chosen.mapInArrow(bytes_of, f"id {kind}, anchor long, piece long, first int, data binary")


def _append(out: tuple[list, ...], *values: object) -> None:
    for column, value in zip(out, values):
        column.append(value)


def _string_digests(data: bytes, length: int, secret: bytes) -> list[int]:
    return [digest(data[at : at + length], secret) for at in range(len(data) - length + 1)]


def _compared(calm: DataFrame, length: int) -> DataFrame:
    """Strings that repeat among the pieces around an anchor, as runs of starts in each piece."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            # The last anchor's pieces may go on in the next batch: keep them back.
            anchors = batch.column(1).to_numpy()
            cut = int(np.searchsorted(anchors, anchors[-1]))
            if cut or (waiting and waiting[-1].column(1)[0].as_py() != anchors[0]):
                yield _repeats([*waiting, batch.slice(0, cut)], length)
                waiting = []
            waiting.append(batch.slice(cut))
        if waiting:
            yield _repeats(waiting, length)

    kind = calm.schema["id"].dataType.simpleString()
    chosen = calm.select("id", "anchor", "piece", "data")
    return chosen.mapInArrow(compare, f"id {kind}, piece long, first int, last int")


def _repeats(batches: list[pa.RecordBatch], length: int) -> pa.RecordBatch:
    """The suffix array of pieces, its suffixes cut to ``length`` bytes: equal neighbours repeat."""
    table = pa.Table.from_batches(batches).combine_chunks()
    texts = table.column("data").to_pylist()
    rows: list[np.ndarray] = []
    firsts: list[np.ndarray] = []
    lasts: list[np.ndarray] = []
    anchors = table.column("anchor").to_numpy()
    edges = np.flatnonzero(np.concatenate([[True], anchors[1:] != anchors[:-1], [True]]))
    for low, high in zip(edges, edges[1:]):
        group = texts[low:high]
        if high - low < 2:
            continue
        joined = np.frombuffer(b"".join(group), dtype=np.uint8)
        ends = np.cumsum([len(t) for t in group])
        counts = np.array([len(t) - length + 1 for t in group])
        owner = np.repeat(np.arange(len(group)), counts)
        begins = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        starts = begins + np.repeat(ends - counts - length + 1, counts)
        suffixes = np.lib.stride_tricks.sliding_window_view(joined, length)[starts]
        suffixes = np.ascontiguousarray(suffixes).view(f"V{length}").ravel()
        order = np.argsort(suffixes, kind="stable")
        same = suffixes[order[1:]] == suffixes[order[:-1]]
        again = np.zeros(len(starts), dtype=bool)
        again[order[1:][same]] = again[order[:-1][same]] = True
        hits = np.flatnonzero(again)
        if len(hits):
            breaks = (np.diff(hits) != 1) | (np.diff(owner[hits]) != 0)
            head = np.concatenate([[True], breaks])
            tail = np.concatenate([breaks, [True]])
            rows.append(low + owner[hits[head]])
            firsts.append(begins[hits[head]])
            lasts.append(begins[hits[tail]])
    chosen = pa.array(np.concatenate(rows) if rows else np.empty(0, dtype=np.int64))
    picked = table.select(["id", "piece"]).take(chosen).combine_chunks()
    whole = [np.concatenate(x) if x else np.empty(0, dtype=np.int64) for x in (firsts, lasts)]
    columns = [picked.column(i).combine_chunks() if picked.num_rows else pa.array([], picked.schema.field(i).type) for i in (0, 1)]
    return pa.RecordBatch.from_arrays(
        [*columns, *[pa.array(x, pa.int32()) for x in whole]], names=["id", "piece", "first", "last"]
    )


def _removed(rows: DataFrame, length: int, gram: int, whole_characters: bool, secret: bytes) -> DataFrame:
    """Turn what was found into removed spans and kept bytes."""

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, removed, spans, kept = [], [], [], []
            entire, parts = batch.column(2), batch.column(3).to_pylist()
            for place, data in enumerate(batch.column(1).to_pylist()):
                names = entire[place].values
                names = names.to_numpy() if names is not None else np.empty(0, dtype=np.int64)
                runs = _covered(data, names, parts[place] or [], length, gram, secret)
                if whole_characters:
                    runs = [run for run in (_shrunk(data, *run) for run in runs) if run[0] < run[1]]
                sizes.append(len(data))
                removed.append(sum(end - first for first, end in runs))
                spans.append([{"first": first, "end": end} for first, end in runs])
                edges = [0, *[e for run in runs for e in run], len(data)]
                kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2])))
            span = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(spans, span),
                    pa.array(kept, pa.binary()),
                ],
                names=["row", "n_bytes", "n_removed", "spans", "kept"],
            )

    spans = T.ArrayType(T.StructType().add("first", "long").add("end", "long"))
    found = T.StructType().add("n_bytes", "long").add("n_removed", "long").add("spans", spans)
    schema = T.StructType([rows.schema["row"], *found.add("kept", "binary")])
    return rows.select("row", "data", "entire", "parts").mapInArrow(remove, schema)


def _shrunk(data: bytes, first: int, end: int) -> tuple[int, int]:
    """The whole UTF-8 characters inside a span."""
    while first < end and data[first] & 0xC0 == 0x80:
        first += 1
    while end > first and end < len(data) and data[end] & 0xC0 == 0x80:
        end -= 1
    return first, end


def _covered(data: bytes, entire: np.ndarray, parts: list[dict], length: int, gram: int, secret: bytes) -> list[tuple[int, int]]:
    """Maximal runs covered by repeated strings: of entire pieces, and of parts of pieces."""
    if not len(entire) and not parts:
        return []
    first, last, _, piece = pieces(data, length, gram, secret)
    whole = np.isin(piece, entire)
    starts, ends = [first[whole]], [last[whole]]
    if parts:
        order = np.argsort(piece, kind="stable")
        names = np.array([p["piece"] for p in parts])
        low = np.searchsorted(piece[order], names)
        high = np.searchsorted(piece[order], names, side="right")
        for part, a, b in zip(parts, low, high):
            at = first[order[a:b]]
            starts.append(at + part["first"])
            ends.append(at + part["last"])
    change = np.zeros(len(data) + 1, dtype=np.int64)
    np.add.at(change, np.concatenate(starts), 1)
    np.add.at(change, np.concatenate(ends) + length, -1)
    inside = np.concatenate([[False], np.cumsum(change[:-1]) > 0, [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))
