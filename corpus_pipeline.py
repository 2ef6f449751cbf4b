"""The corpus pipeline: documents through the stages below, each written and read again.

Toxic documents go; lines of recurring templates go; of each class of near copies one
document stays; sources are mixed to their target weights, so that a document may go or
stand twice; what is left is packed into sequences of token ids.

Null and empty texts, and those that line dedup leaves empty, pass the first three stages, are never in the mix, and so are not
packed. Empty tables give empty results. Columns beside those of ``documents`` are carried
up to the last stage, which returns pieces of documents with their place in a sequence.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnlake.llm.line_templates import drop_recurring_lines
from tarnlake.llm.mixing import mixed
from tarnlake.llm.packing import pack_documents
from tarnlake.llm.prob_minhash import without_near_duplicates
from tarnlake.llm.staging import Stage
from tarnlake.llm.tokens import public_tokenizer
from tarnlake.llm.toxicity import without_toxic

#: Id put after each document.
END = 2


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine scores under 0.5."""
    return without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines whose template recurs; ``n_chars`` is that of what is left.

    The first document of each line keeps it, so of whole copies the first stays whole.
    """
    cleaned = drop_recurring_lines(docs)
    length = F.when(F.col("dropped_lines") > 0, F.char_length("text")).otherwise(F.col("n_chars"))
    return cleaned.withColumn("n_chars", length.cast("long")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each class of near copies."""
    return without_near_duplicates(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of its source takes it."""
    return mixed(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document stands in the sequences of at most 4096 ids.

    Workers take small batches and keep few words, as the stages before have left the executors
    little memory. The ids themselves are not moved here; ``pack_documents(with_ids=True)`` carries them.
    """
    return pack_documents(docs, public_tokenizer(), END, rows=2000, text_bytes=2 << 20, remembered=1 << 18)


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]
#: Trained scores and random draws are not SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    tables = Stage(spark, "pipeline")
    for name, function in STAGES:
        docs = tables.put(function(spark, docs, sf_dir), name)
    return docs
