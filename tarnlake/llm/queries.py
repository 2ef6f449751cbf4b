"""The registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnlake.llm.compact_windows import repeated_passages
from tarnlake.llm.dimension_scan import nearest_vectors
from tarnlake.llm.filter_audit import audit_filters
from tarnlake.llm.jump_sharding import shard_of, with_shards, with_slots
from tarnlake.llm.line_templates import drop_recurring_lines
from tarnlake.llm.mixing import mix_sources
from tarnlake.llm.packing import pack_documents
from tarnlake.llm.prob_minhash import near_duplicates
from tarnlake.llm.subspace_join import near_vectors
from tarnlake.llm.token_store import read_all, write_tokens
from tarnlake.llm.tokens import public_tokenizer
from tarnlake.llm.toxicity import fit, held_out, with_toxicity
from tarnlake.llm.whitening import whitened_vectors
from tarnlake.llm.winnowing import fingerprint, likeness, with_next, written

#: Ids of the public word tokenizer.
VOCABULARY = 49_408


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_lines(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return drop_recurring_lines(docs).select(
        "doc_id",
        F.col("dropped_lines").cast("long").alias("dropped_lines"),
        F.char_length("text").cast("long").alias("kept_chars"),
        F.sha2("text", 256).alias("kept_sha256"),
    )


def op2_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mix_sources(table(spark, folder, "documents"))


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    machine = fit(docs, table(spark, folder, "labels"))
    scored = with_toxicity(docs, machine)
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")


def op4_winnowing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))

    def prints(paired: DataFrame) -> DataFrame:
        half = F.floor(F.char_length("text") / 2).cast("int")
        kept = F.substring("text", F.lit(1), F.char_length("text") - half)
        edited = F.concat(kept, F.substring("next_text", F.lit(1), half))
        return (
            paired.withColumn("edited", edited)
            .withColumn("fp", fingerprint(F.col("text")))
            .withColumn("edited_fp", fingerprint(F.col("edited")))
        )

    return with_next(docs, prints).select(
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        written(F.col("fp")).alias("fingerprint"),
        written(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
    )


def op5_tokens(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    store = write_tokens(docs, public_tokenizer(), end=1, vocabulary=VOCABULARY)
    return read_all(store, digest=True)


def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(table(spark, folder, "documents"), public_tokenizer(), end=2)


def op7_passages(spark: SparkSession, folder: str) -> DataFrame:
    return repeated_passages(table(spark, folder, "documents"))


def op8_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return near_vectors(table(spark, folder, "embeddings"))


def op9_sharding(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    text = F.coalesce("text", F.lit(""))
    digest = docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32")
    )
    sharded = with_shards(digest, 8).withColumn("grown_shard", shard_of(F.col("doc_id"), 9))
    numbered = with_slots(sharded, docs.count() // 8, ["doc_id", "text_crc32", "size"])
    return numbered.withColumn("law", F.lit("key"))


def op10_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"))


def op11_nearest(spark: SparkSession, folder: str) -> DataFrame:
    return nearest_vectors(table(spark, folder, "embeddings"))


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitened_vectors(table(spark, folder, "embeddings"))


def op13_filters(spark: SparkSession, folder: str) -> DataFrame:
    return audit_filters(table(spark, folder, "documents"), table(spark, folder, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lines": op1_lines,
    "op2_mixing": op2_mixing,
    "op3_toxicity": op3_toxicity,
    "op4_winnowing": op4_winnowing,
    "op5_tokens": op5_tokens,
    "op6_packing": op6_packing,
    "op7_passages": op7_passages,
    "op8_embeddings": op8_embeddings,
    "op9_sharding": op9_sharding,
    "op10_minhash": op10_minhash,
    "op11_nearest": op11_nearest,
    "op12_whitening": op12_whitening,
    "op13_filters": op13_filters,
}
