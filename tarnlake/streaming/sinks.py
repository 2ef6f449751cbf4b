"""Bounded streaming writes.

Each call works off what has arrived and returns when that is committed, so the next
layer never starts on a half-written one. Progress is kept in ``checkpoint``: a call
after a failure, or with nothing new, adds no row twice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from pyspark.sql import DataFrame, SparkSession

from tarnlake.operators.versions import new_folder, point, versions
from tarnlake.plans.workspace import remove, shuffles_dropped


def append_stream(
    df: DataFrame,
    table: str,
    checkpoint: str,
    path: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """Append the new rows of ``df`` to ``table``, stored under ``path``; return the table.

    Keep ``path`` and ``checkpoint`` together: a table without its checkpoint is filled
    a second time. Shuffle files of a micro-batch go when it is committed.
    """
    writer = (
        df.writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("path", path)
        .trigger(availableNow=True)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    spark = df.sparkSession
    with shuffles_dropped(spark):
        writer.toTable(table).awaitTermination()
    spark.catalog.refreshTable(table)
    return spark.table(table)


def complete_stream(
    df: DataFrame,
    table: str,
    checkpoint: str,
    path: str,
    finish: Callable[[DataFrame], DataFrame] | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """Keep ``table`` equal to the whole streaming aggregate ``df``; return the table.

    After each micro-batch the complete result, as a batch frame, passes through
    ``finish`` (joins, a further aggregate) and is written to a new folder under ``path``;
    only then is the table pointed at it, and the folder before the last one deleted. So
    readers see one whole result or the other, and each micro-batch costs one full write:
    let ``df`` read its backlog in few of them. ``df`` itself may end in a sort, which
    streaming allows in this mode only. The aggregate's groups are the state; for many of
    them run with the RocksDB state store provider.
    """
    spark = df.sparkSession

    def replace(batch: DataFrame, batch_id: int) -> None:
        result = batch if finish is None else finish(batch)
        folder = new_folder(path, batch_id + 1)
        result.write.format(fmt).save(folder)
        point(batch.sparkSession, table, folder, fmt)
        for old in versions(batch.sparkSession, path)[:-2]:
            remove(batch.sparkSession, old)

    query = (
        df.writeStream.outputMode("complete")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(replace)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if not spark.catalog.tableExists(table):
        # No micro-batch ran in this session: either an earlier session filled the
        # table and its catalog is gone, or nothing has arrived yet.
        written = versions(spark, path)
        if written:
            point(spark, table, written[-1], fmt)
        else:
            replace(spark.createDataFrame([], df.schema), -1)
    spark.catalog.refreshTable(table)
    return spark.table(table)
