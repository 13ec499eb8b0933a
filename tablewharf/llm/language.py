"""Language identification with hyperdimensional profiles."""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewharf.llm.common import only_one

DIMENSIONS = 1024
GRAM = 3
# Labelled documents that training uses at most, about; drawn by a hash of the id.
TRAINING_ROWS = 20_000
# A document vector enters its language's bundle with this length, rounded to whole numbers.
UNIT = 1 << 14
# Code points of a long text that are turned into n-grams at a time.
WINDOW = 1 << 20
# Rows of a batch that are turned into Python texts at a time.
BATCH_ROWS = 500
UNKNOWN = "und"
SEED = 20_240_601


@functools.cache
def letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(p).isalpha() for p in range(0x110000)), dtype=bool, count=0x110000)


class Grams:
    """Vectors of n-grams: each letter's random vector of signs, rotated by its place and multiplied."""

    KEPT = 40_000
    AT_ONCE = 4_096

    def __init__(self, dimensions: int) -> None:
        self.dimensions = dimensions
        self.signs: dict[int, np.ndarray] = {}
        self.codes = np.empty(0, dtype=np.int64)
        self.places = np.empty(0, dtype=np.int64)
        self.vectors = np.empty((0, dimensions), dtype=np.int8)

    def letter(self, point: int) -> np.ndarray:
        found = self.signs.get(point)
        if found is None:
            if len(self.signs) >= 8192:
                self.signs.clear()
            bits = np.random.default_rng([SEED, point]).integers(0, 2, self.dimensions)
            found = self.signs[point] = (2 * bits - 1).astype(np.int8)
        return found

    def build(self, codes: np.ndarray) -> np.ndarray:
        rows = np.empty((len(codes), self.dimensions), dtype=np.int8)
        for row, code in zip(rows, codes.tolist()):
            row[:] = self.letter(code & 0x1FFFFF)
            for place in range(1, GRAM):
                row *= np.roll(self.letter((code >> (21 * place)) & 0x1FFFFF), place)
        return rows

    def find(self, codes: np.ndarray) -> np.ndarray:
        """Rows of ``vectors`` for distinct codes in order; call with at most ``KEPT`` codes."""
        at = np.searchsorted(self.codes, codes)
        known = np.zeros(len(codes), dtype=bool)
        if len(self.codes):
            known = self.codes[np.minimum(at, len(self.codes) - 1)] == codes
        if not known.all():
            if len(self.codes) + np.count_nonzero(~known) > self.KEPT:
                self.__init__(self.dimensions)
                known[:], at = False, np.zeros(len(codes), dtype=np.int64)
            new = codes[~known]
            fresh = len(self.codes) + np.arange(len(new))
            self.places = np.insert(self.places, at[~known], fresh)
            self.codes = np.insert(self.codes, at[~known], new)
            self.vectors = self._grown(fresh, self.build(new))
            at = np.searchsorted(self.codes, codes)
        return self.places[at]

    def _grown(self, fresh: np.ndarray, rows: np.ndarray) -> np.ndarray:
        needed = int(fresh[-1]) + 1
        vectors = self.vectors
        if needed > len(vectors):
            vectors = np.empty((min(self.KEPT, max(needed, 2 * len(vectors), 1024)), self.dimensions), dtype=np.int8)
            vectors[: fresh[0]] = self.vectors[: fresh[0]]
        vectors[fresh] = rows
        return vectors

    def document(self, text: str) -> np.ndarray | None:
        """The bundle of all n-grams of a text: whole numbers; None without letters."""
        points = np.frombuffer(text.lower().encode("utf-32-le"), dtype=np.uint32)
        total, found = np.zeros(self.dimensions), False
        for start in range(0, len(points), WINDOW):
            part = points[max(0, start - GRAM + 1) : start + WINDOW]
            codes, counts = gram_codes(part)
            found = found or bool(letters()[part].any())
            for low in range(0, len(codes), self.AT_ONCE):
                some = slice(low, low + self.AT_ONCE)
                places = self.find(codes[some])
                total += counts[some].astype(np.float32) @ self.vectors[places].astype(np.float32)
        return total if found else None


def gram_codes(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams and their counts; a run of other signs is one blank, as are both ends."""
    known = letters()[points]
    signs = np.where(known, points, 32).astype(np.int64)
    blank = ~known
    keep = np.ones(len(signs), dtype=bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    signs = np.concatenate([[32], signs[keep], [32]])
    codes = np.zeros(len(signs) - GRAM + 1, dtype=np.int64)
    for place in range(GRAM):
        codes = (codes << 21) | signs[place : len(signs) - GRAM + 1 + place]
    return np.unique(codes, return_counts=True)


def grams(dimensions: int) -> Grams:
    return only_one(("grams", dimensions), lambda: Grams(dimensions))


def held_out(doc_id: Column) -> Column:
    """Documents kept from training: CRC-32 of the id as text leaves 2 by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame, dimensions: int = DIMENSIONS, rows: int = TRAINING_ROWS) -> list[tuple[str, np.ndarray]]:
    """Prototypes of the languages of the labelled documents that are not held out.

    A bounded sample (about ``rows`` documents, drawn by a hash of the id) is enough: a
    prototype sums documents of equal weight. Sums are whole numbers, so their order does not matter. What all
    languages have in common is taken off. The result has one vector per language.
    """
    text = F.col("text").cast("string")
    labelled = docs.where(F.col("lang").isNotNull() & text.isNotNull() & ~held_out(F.col("doc_id")))
    labelled = labelled.select("doc_id", F.col("lang").cast("string").alias("lang"), text.alias("text"))
    count = labelled.count()
    if count > rows:
        labelled = labelled.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int((1 << 20) * rows / count))

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                vector = grams(dimensions).document(body)
                if vector is not None and vector.any():
                    unit = np.rint(vector * (UNIT / np.linalg.norm(vector))).astype(np.int64)
                    sums[lang] = sums[lang] + unit if lang in sums else unit
        for lang, total in sums.items():
            yield pa.RecordBatch.from_pydict(
                {"lang": [lang] * dimensions, "place": np.arange(dimensions), "value": total},
                schema=pa.schema([("lang", pa.string()), ("place", pa.int64()), ("value", pa.int64())]),
            )

    sums = labelled.select("lang", "text").mapInArrow(bundle, "lang string, place long, value long")
    found = sums.groupBy("lang", "place").agg(F.sum("value").alias("value")).groupBy("lang").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("place", "value"))), lambda x: x["value"]).alias("vector")
    )
    bundles = {r["lang"]: np.array(r["vector"], dtype=float) for r in found.collect()}
    units = {lang: v / max(np.linalg.norm(v), 1e-12) for lang, v in sorted(bundles.items())}
    if len(units) > 1:
        common = sum(units.values()) / len(units)
        units = {lang: v - common for lang, v in units.items()}
    return [(lang, v / max(np.linalg.norm(v), 1e-12)) for lang, v in units.items()]


def identify(docs: DataFrame, prototypes: list[tuple[str, np.ndarray]], dimensions: int = DIMENSIONS) -> DataFrame:
    """``doc_id, lang_pred, score`` for every row; see :func:`identify_text`."""
    kept = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return predict(kept, prototypes, dimensions).drop("text")


def predict(
    rows: DataFrame,
    prototypes: list[tuple[str, np.ndarray]],
    dimensions: int = DIMENSIONS,
    text: Callable[[pa.RecordBatch], pa.Array] = lambda batch: batch.column("text"),
) -> DataFrame:
    """Append ``lang_pred, score`` to rows; ``text`` finds the texts in a batch of them.

    The language is the prototype of greatest cosine with the bundle of the whole
    text's n-grams; the score is that cosine, 0 where negative. Without letters, with a null
    text or without prototypes it is ``und`` with score 0. Equal cosines go to the
    language first in order.
    """
    names = [lang for lang, _ in prototypes]
    matrix = np.array([v for _, v in prototypes]).reshape(len(names), dimensions)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH_ROWS):
                batch = whole.slice(at, BATCH_ROWS)
                langs, scores = [], []
                for body in text(batch).to_pylist():
                    vector = grams(dimensions).document(body) if body and names else None
                    if vector is None:
                        langs.append(UNKNOWN)
                        scores.append(0.0)
                        continue
                    cosines = np.round(matrix @ vector / max(np.linalg.norm(vector), 1e-12), 9)
                    best = int(np.argmax(cosines))
                    langs.append(names[best])
                    scores.append(float(min(1.0, max(0.0, cosines[best]))))
                arrays = [*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
                yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names, "lang_pred", "score"])

    added = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    return rows.mapInArrow(predict, T.StructType([*rows.schema.fields, *added]))


def language_of_documents(docs: DataFrame) -> DataFrame:
    """Learn from the documents that are not held out and predict all:
    ``doc_id, held_out, lang_pred, score``.

    Null texts and texts without letters are ``und``; texts of any length are read whole, in windows; null and repeated ids are
    ordinary rows; without labels everything is ``und``; an empty table gives no rows;
    other columns are ignored, and language, source and id never enter a prediction.
    """
    predicted = identify(docs, learn(docs))
    return predicted.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
