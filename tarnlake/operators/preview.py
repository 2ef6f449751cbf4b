"""First rows of a table. Both run as a top-k per task, not as a global sort."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def preview(df: DataFrame, key: str, rows: int = 5) -> DataFrame:
    """The rows with the smallest keys."""
    return df.orderBy(F.col(key).asc()).limit(rows)


def top(df: DataFrame, measure: str, ties: list[str], rows: int) -> DataFrame:
    """The rows with the largest measure; equal measures come in the order of ``ties``."""
    return df.orderBy(F.col(measure).desc(), *[F.col(name).asc() for name in ties]).limit(rows)
