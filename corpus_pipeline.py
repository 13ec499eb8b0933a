"""A corpus from raw documents to packed sequences, stage by stage."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewharf.llm import language, minhash, mixing, packing, suffix_index
from tablewharf.llm.common import ship, store, table
from tablewharf.llm.queries import tokenizer_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# Rows that go to a Python worker at a time: documents are long, and a batch is held on both sides, on its way there and back.
BATCH_ROWS = "1000"
# A text whose best cosine is below this resembles no language that was learned.
LEAST_SCORE = 0.05


def in_small_batches(stage: Stage) -> Stage:
    """The stage in a session whose Arrow batches hold ``BATCH_ROWS`` rows."""

    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
        return stage(spark, docs, sf_dir)

    return run_stage


@in_small_batches
def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose text resembles a language that the labels teach; without labels, keep all."""
    ship(spark)
    prototypes = language.learn(docs)
    if not prototypes:
        return docs
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    predicted = language.predict(rows, prototypes, text=lambda batch: batch.column(0).field("text"))
    good = (F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SCORE)
    return predicted.where(good).select("row.*")


def numbered(docs: DataFrame, purpose: str) -> DataFrame:
    """The rows as ``row``, each with a number ``row_id`` that is stored, since ids may be null or repeat."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return store(rows.withColumn("row_id", F.monotonically_increasing_id()), purpose, "zstd")


@in_small_batches
def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group of near duplicates (5 words, similarity 0.8): that of the first id, null last.

    Rows are compared, not ids: of a repeated row and of copies whose id is null one stays, and
    different texts under one id both stay.
    """
    rows = numbered(docs, "near-rows")
    found = minhash.near_duplicates(rows.select(F.col("row_id").alias("doc_id"), F.col("row.text").alias("text")))
    grouped = found.select(F.col("doc_id").alias("row_id"), "component_id").join(rows.select("row_id", "row.doc_id"), "row_id")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row_id")
    first = grouped.groupBy("component_id").agg(F.min(order).alias("first")).select(F.col("first.row_id").alias("row_id"))
    return rows.join(first, "row_id", "left_semi").select("row.*")


@in_small_batches
def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut passages of 200 bytes or more that stand anywhere else; documents of which nothing is left go."""
    found = suffix_index.repeated_passages(docs, whole_characters=True)
    text = F.col("kept").cast("string")
    new = {"text": text, "n_chars": F.length(text).cast(dict(docs.dtypes).get("n_chars", "bigint"))}
    columns = [new[c].alias(c) if c in new else F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    return found.where((F.length("kept") > 0) | (F.col("n_bytes") == 0)).select(columns)


@in_small_batches
def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or drop documents so that sources have their target sizes; each row has its own number of copies."""
    rows = numbered(docs, "mixed-rows")
    texts = rows.select("row_id", "row.doc_id", "row.source", "row.text")
    copies = mixing.mix(texts, row_id="row_id").select("row_id", F.col("copies").cast("int").alias("mixed_copies"))
    joined = rows.join(copies.where("mixed_copies > 0"), "row_id")
    repeated = joined.select("row", F.explode(F.sequence(F.lit(1), "mixed_copies")))
    return repeated.select("row.*")


@in_small_batches
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all documents in sequences of 2048."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("language_id", known_language),
    ("minhash_near_dedup", without_near_copies),
    ("suffix_array_dedup", without_repeated_passages),
    ("source_mixing", mixed_sources),
    ("packing", packed),
]

# Language vectors, signatures, suffix arrays and tokens are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of ``documents`` after all stages, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"corpus-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
