"""Tables that each load replaces as a whole, or not at all."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnlake.operators.versions import Check, Version, publish_all, quoted, stage_version

__all__ = ["create_gold", "quoted", "stage_dim", "write_dim"]


def versions_root(spark: SparkSession, table: str, path: str | None) -> str:
    """The folder of a table's versions: ``path``, or one in the folder of its database."""
    if path is not None:
        return path.rstrip("/")
    *database, name = table.split(".")
    folder = spark.catalog.getDatabase(database[-1] if database else spark.catalog.currentDatabase()).locationUri
    return f"{folder.rstrip('/')}/{name}.versions"


def stage_dim(
    df: DataFrame, table: str, fmt: str = "parquet", path: str | None = None, partition_by: Sequence[str] = ()
) -> Version:
    """The next version of ``table``, written and not yet seen by readers."""
    return stage_version(df, table, versions_root(df.sparkSession, table, path), fmt, partition_by)


def write_dim(
    df: DataFrame,
    table: str,
    fmt: str = "parquet",
    path: str | None = None,
    comment: str | None = None,
    partition_by: Sequence[str] = (),
    checks: Sequence[Check] = (),
) -> DataFrame:
    """Create or replace ``table`` from ``df`` and return it as read back.

    The rows are written beside those in use, under ``path`` if given, and the table is
    pointed at them once they are whole and every one of ``checks`` has passed; until then,
    and after a failure for good, readers have the rows from before. The version
    before stays for ``roll_back``. The table is external: dropping it leaves the files.
    """
    (loaded,) = publish_all([(stage_dim(df, table, fmt, path, partition_by), checks)], [comment])
    return loaded


def create_gold(
    df: DataFrame,
    table: str,
    fmt: str = "parquet",
    path: str | None = None,
    order_by: Sequence[str] = (),
    partition_by: Sequence[str] = (),
    checks: Sequence[Check] = (),
) -> DataFrame:
    """Create or replace an aggregate table, as ``write_dim`` does.

    ``order_by`` (descending) costs a range shuffle and gives files that are sorted and
    do not overlap, for skipping; it gives readers no order.
    """
    if order_by:
        df = df.orderBy(*[F.col(name).desc() for name in order_by])
    return write_dim(df, table, fmt=fmt, path=path, partition_by=partition_by, checks=checks)
