"""One query for each operator over its whole table, and the SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewharf.llm import hard_negatives, html_text, language, minhash, mixing, near_vectors, packing, resampling, sharding, suffix_index, token_count, twins, vector_search, warc
from tablewharf.llm.common import table
from tablewharf.sinks.workspace import new_folder

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path())


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_of_documents(table(spark, sf_dir, "documents"))


def op3_kd_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_search.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op5_small_worlds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op6_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=2)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op8_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op9_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = sharding.byte_shards(table(spark, sf_dir, "documents"))
    grown = F.lit(None).cast("int").alias("grown_shard")
    return cut.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", grown)


def op10_suffix_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_index.repeated_passages(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        "n_bytes",
        "n_removed",
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op11_dictionary_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "archives")
    warc.write_archives(table(spark, sf_dir, "pages"), folder)
    found = warc.read_archives(spark, folder, with_payload=False)
    page_id, refers_to = F.col("record_id").cast("long").alias("page_id"), F.col("refers_to").cast("long").alias("refers_to")
    return found.select(page_id, "payload_bytes", "payload_digest", "record_type", refers_to)


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", shifted)
    return hard_negatives.hard_negatives(vectors, F.col("vec_id") % 100 == 0)


_ALL = (
    op1_token_counts,
    op2_language,
    op3_kd_trees,
    op4_main_text,
    op5_small_worlds,
    op6_superminhash,
    op7_packing,
    op8_entropy_mix,
    op9_byte_shards,
    op10_suffix_levels,
    op11_dictionary_warc,
    op12_importance_resampling,
    op13_hard_negatives,
)
QUERIES: dict[str, Query] = {query.__name__: query for query in _ALL}
SQL: dict[str, str] = {
    "op3_kd_trees": twins.OP3,
    "op5_small_worlds": twins.OP5,
    "op6_superminhash": twins.OP6,
    "op10_suffix_levels": twins.OP10,
    "op11_dictionary_warc": twins.OP11,
    "op12_importance_resampling": twins.OP12,
    "op13_hard_negatives": twins.OP13,
}
