"""Whole versions of a table: written beside the one in use, checked, then pointed at.

Each load writes a new folder under the table's root. Only when it is whole and its checks
hold does the catalog entry move to it, so a load that breaks off or is refused leaves readers
what they had. The version in use before is kept for a way back; older ones are deleted.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnlake.plans.workspace import remove

#: Takes the staged version and the one in use (None at the first load); raises to refuse it.
Check = Callable[[DataFrame, DataFrame | None], None]


def quoted(text: str) -> str:
    """``text`` as a SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def versions(spark: SparkSession, root: str) -> list[str]:
    """Folders of whole versions under ``root``, oldest first; unfinished ones do not count."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    place = hadoop.Path(root)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(place):
        return []
    folders = [status.getPath() for status in system.listStatus(place) if status.isDirectory()]
    named = [f for f in folders if f.getName().startswith("version=")]
    whole = [f for f in named if system.exists(hadoop.Path(f, "_SUCCESS")) or system.exists(hadoop.Path(f, "_delta_log"))]
    return sorted(f.toString() for f in whole)


def _name(folder: str) -> str:
    return folder.rstrip("/").rsplit("/", 1)[1]


def location(spark: SparkSession, table: str) -> str | None:
    """The folder that ``table`` reads; None without such a table."""
    if not spark.catalog.tableExists(table):
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"] if rows else None


def new_folder(root: str, number: int) -> str:
    return f"{root}/version={number:012d}-{uuid4().hex[:8]}"


def point(
    spark: SparkSession, table: str, folder: str, fmt: str, partition_by: Sequence[str] = (), comment: str | None = None
) -> None:
    """Let ``table`` read ``folder``, a whole version.

    With unchanged columns that is one change of the catalog entry. A version of other columns,
    or of a partitioned table, whose catalog entry lists its partitions, takes the table's name
    once it is an entry of its own; a reader between those two calls finds no table.
    """
    known = spark.catalog.tableExists(table)
    if known:
        entry = spark.table(table)
        kept = {row["col_name"]: row["data_type"] for row in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
        same = entry.dtypes == spark.read.format(fmt).load(folder).dtypes
        if same and kept.get("Type") == "EXTERNAL" and not partition_by and "# Partition Information" not in kept:
            spark.sql(f"ALTER TABLE {table} SET LOCATION {quoted(folder)}")
            _remark(spark, table, comment)
            return
    entry = f"{table}_{uuid4().hex[:8]}" if known else table
    spark.catalog.createTable(entry, path=folder, source=fmt)
    if partition_by:
        spark.catalog.recoverPartitions(entry)
    if known:
        spark.sql(f"DROP TABLE {table}")
        spark.sql(f"ALTER TABLE {entry} RENAME TO {table}")
    _remark(spark, table, comment)


def _remark(spark: SparkSession, table: str, comment: str | None) -> None:
    if comment is not None:
        spark.sql(f"COMMENT ON TABLE {table} IS {quoted(comment)}")
    spark.catalog.refreshTable(table)


@dataclass(frozen=True)
class Version:
    """A version of ``table`` that is written, and that no reader sees yet."""

    spark: SparkSession
    table: str
    root: str
    folder: str
    fmt: str
    partition_by: tuple[str, ...] = ()

    def read(self) -> DataFrame:
        return self.spark.read.format(self.fmt).load(self.folder)

    def check(self, checks: Sequence[Check]) -> None:
        """Raise what any of ``checks`` raises against the version in use."""
        current = self.spark.table(self.table) if self.spark.catalog.tableExists(self.table) else None
        for check in checks:
            check(self.read(), current)

    def discard(self) -> None:
        remove(self.spark, self.folder)

    def publish(self, comment: str | None = None) -> str | None:
        """Let the table read this version; returns the folder it read before."""
        before = location(self.spark, self.table)
        point(self.spark, self.table, self.folder, self.fmt, self.partition_by, comment)
        return before

    def forget(self, before: str | None) -> None:
        """Delete the versions that are neither this one nor the one in use before."""
        kept = {_name(self.folder), _name(before) if before else ""}
        for old in versions(self.spark, self.root):
            if _name(old) not in kept:
                remove(self.spark, old)


def stage_version(
    df: DataFrame, table: str, root: str, fmt: str = "parquet", partition_by: Sequence[str] = ()
) -> Version:
    """``df`` as the next version under ``root``; nothing is left of one that breaks off.

    ``df`` may read the table.
    """
    spark = df.sparkSession
    known = versions(spark, root)
    number = int(_name(known[-1]).removeprefix("version=").split("-")[0]) + 1 if known else 1
    version = Version(spark, table, root, new_folder(root, number), fmt, tuple(partition_by))
    writer = df.write.format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    try:
        writer.save(version.folder)
    except BaseException:
        version.discard()
        raise
    return version


def publish_all(
    loads: Sequence[tuple[Version, Sequence[Check]]], comments: Sequence[str | None] | None = None
) -> list[DataFrame]:
    """Publish all of several staged versions or none; return the tables.

    All checks come before any table moves. Should the catalog fail half-way, the tables that
    moved are pointed back (a first version stays, as there is nothing to go back to).
    """
    try:
        for version, checks in loads:
            version.check(checks)
    except BaseException:
        for version, _ in loads:
            version.discard()
        raise
    moved: list[tuple[Version, str | None]] = []
    try:
        for (version, _), comment in zip(loads, comments or [None] * len(loads), strict=True):
            moved.append((version, version.publish(comment)))
    except BaseException:
        for version, before in moved:
            if before is not None:
                point(version.spark, version.table, before, version.fmt, version.partition_by)
        raise
    for version, before in moved:
        version.forget(before)
    return [version.spark.table(version.table) for version, _ in moved]


def roll_back(
    spark: SparkSession, table: str, root: str, fmt: str = "parquet", partition_by: Sequence[str] = ()
) -> DataFrame:
    """Let ``table`` read the version before the one in use, which stays until the next load."""
    current = location(spark, table)
    older = [v for v in versions(spark, root) if current is not None and _name(v) < _name(current)]
    if not older:
        raise ValueError(f"{table} has no version before the one in use")
    point(spark, table, older[-1], fmt, partition_by)
    return spark.table(table)


def unique_key(key: str) -> Check:
    """Refuse a version that holds a value of ``key`` twice; null keys may repeat."""

    def check(staged: DataFrame, current: DataFrame | None) -> None:
        repeated = staged.where(F.col(key).isNotNull()).groupBy(key).count().where("count > 1").select(key).head(3)
        if repeated:
            raise ValueError(f"it holds {key} {', '.join(str(row[0]) for row in repeated)} more than once")

    return check


def at_least(rows: int) -> Check:
    """Refuse a version of fewer rows."""

    def check(staged: DataFrame, current: DataFrame | None) -> None:
        found = staged.count()
        if found < rows:
            raise ValueError(f"it holds {found} rows, {rows} are expected at least")

    return check


def not_shrunk(share: float) -> Check:
    """Refuse a version of less than ``share`` of the rows in use."""

    def check(staged: DataFrame, current: DataFrame | None) -> None:
        if current is not None:
            found, before = staged.count(), current.count()
            if found < share * before:
                raise ValueError(f"it holds {found} rows, the version in use {before}")

    return check


def keeps_columns(staged: DataFrame, current: DataFrame | None) -> None:
    """Refuse a version that lacks a column of the one in use, or has another type for it."""
    if current is not None:
        lost = set(current.dtypes) - set(staged.dtypes)
        if lost:
            raise ValueError(f"it lacks {', '.join(sorted(f'{name} {kind}' for name, kind in lost))}")
