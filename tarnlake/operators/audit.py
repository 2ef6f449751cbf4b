"""Counts that show whether a table may be used as a dimension or a bronze layer."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnlake.streaming.ingest import CORRUPT_COLUMN


def _audit(name: str, df: DataFrame, key: str) -> DataFrame:
    types = ", ".join(f"{column} {kind}" for column, kind in df.dtypes)
    bad = F.count(CORRUPT_COLUMN) if CORRUPT_COLUMN in df.columns else F.lit(0).cast("bigint")
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct(key).alias("distinct_keys"),
        (F.count(F.lit(1)) - F.count(key)).alias("null_keys"),
        (F.count(key) - F.count_distinct(key)).alias("duplicate_keys"),
        bad.alias("corrupt_rows"),
    ).select(F.lit(name).alias("table_name"), "*", F.lit(types).alias("column_types"))


def audit_tables(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """One row per table: rows, distinct, null and duplicate keys, bad records, types.

    ``tables`` gives a frame and its key column per name. A dimension is fit for
    ``enrich`` when ``duplicate_keys`` is 0. The distinct count shuffles each key once
    per task that saw it, whatever the number of its rows.
    """
    return reduce(DataFrame.unionByName, [_audit(name, *spec) for name, spec in tables.items()])


def audit_database(spark: SparkSession, database: str, keys: Mapping[str, str]) -> DataFrame:
    """``audit_tables`` of those tables of ``database`` that ``keys`` names a key for."""
    present = {table.name for table in spark.catalog.listTables(database) if not table.isTemporary}
    return audit_tables(
        {name: (spark.table(f"{database}.{name}"), key) for name, key in keys.items() if name in present}
    )


def audit_lake(spark: SparkSession, database: str, dims: Mapping[str, str], facts: Mapping[str, str]) -> DataFrame:
    """``audit_database`` of dimensions and of bronze and silver tables together.

    ``facts`` names the fact key of each table. A bad record has no key: it counts in
    ``null_keys`` and, in bronze, in ``corrupt_rows``.
    """
    return audit_database(spark, database, {**dims, **facts})
