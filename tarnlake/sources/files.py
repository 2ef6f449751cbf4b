"""Dimension files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_csv_dim(
    spark: SparkSession,
    path: str,
    schema: str | StructType | None = None,
    multi_line: bool = False,
    **options: str,
) -> DataFrame:
    """A CSV file (or folder) with a header line.

    Give a ``schema``: inference is a second pass over the files and turns postal
    codes into numbers. Quoted fields may hold commas and doubled quotes, and with
    ``multi_line`` line breaks; each file is then read by one task.
    """
    reader = spark.read.options(header="true", quote='"', escape='"', multiLine=multi_line)
    reader = reader.options(**options)
    reader = reader.option("inferSchema", "true") if schema is None else reader.schema(schema)
    return reader.csv(path)
