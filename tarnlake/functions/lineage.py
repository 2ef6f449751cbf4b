"""Traceability columns of the bronze layer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LINEAGE_COLUMNS = ("receipt_time", "source_file")


def with_lineage(df: DataFrame) -> DataFrame:
    """All columns, plus when the row was read and from which file.

    ``receipt_time`` is one value per micro-batch (per query, in batch). Apply this
    straight after the read: past a shuffle Spark no longer knows the file.
    """
    return df.select(
        "*",
        F.current_timestamp().alias("receipt_time"),
        F.input_file_name().alias("source_file"),
    )
