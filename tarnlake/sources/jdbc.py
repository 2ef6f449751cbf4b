"""Dimension tables read over JDBC."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class KeyRange:
    """How to split a JDBC scan: ``partitions`` strides of ``column``.

    The bounds set the strides only; rows outside them (and null keys) are read by
    the outer partitions, so the result is the whole table for any bounds.
    """

    column: str
    lower: int
    upper: int
    partitions: int


def jdbc_options(
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    key_range: KeyRange | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **(properties or {})}
    if key_range is not None:
        options |= {
            "partitionColumn": key_range.column,
            "lowerBound": str(key_range.lower),
            "upperBound": str(key_range.upper),
            "numPartitions": str(key_range.partitions),
        }
    return options


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    key_range: KeyRange | None = None,
    fetch_size: int = 10_000,
    view: str | None = None,
) -> DataFrame:
    """Scan ``table``; filters and column lists on the result are sent to the database.

    ``properties`` (user, password, driver) come from the caller and are not kept.
    Without a ``key_range`` one task reads the whole table, so give one for any table
    that is not small.
    """
    options = jdbc_options(url, table, properties, key_range, fetch_size)
    df = spark.read.format("jdbc").options(**options).load()
    if view:
        df.createOrReplaceTempView(view)
    return df
