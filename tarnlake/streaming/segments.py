"""A streaming aggregate whose cost follows what changed: segments of groups, merged when read.

Each micro-batch writes only the groups that it changed, with their new values, as a segment.
A reader takes the newest row of each group. Several segments are now and then merged into
one, which holds a row for each group; as the newest row is the same before and after, and
while both are there, readers need not be told.
"""

from __future__ import annotations

from collections.abc import Sequence
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnlake.plans.workspace import exists, remove

#: The segment of a row, by which the newest is known.
SEGMENT = "__segment"
#: Segments beyond which a run merges them.
COMPACT_AFTER = 8


def _segments(spark: SparkSession, path: str) -> dict[str, tuple[int, int]]:
    """Folders of whole segments, each with the first and last micro-batch in it."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    place = hadoop.Path(f"{path}/rows")
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(place):
        return {}
    names = [status.getPath().getName() for status in system.listStatus(place)]
    bounds = {name: name.removeprefix("segment-").split("-")[:2] for name in names if name.startswith("segment-")}
    return {f"{path}/rows/{name}": (int(first), int(last)) for name, (first, last) in bounds.items()}


def _put(rows: DataFrame, path: str, first: int, last: int, fmt: str) -> None:
    """Add a segment: written where no reader looks, there as a whole by one rename."""
    spark = rows.sparkSession
    staged = f"{path}/.staged/{uuid4().hex}"
    rows.withColumn(SEGMENT, F.lit(last).cast("bigint")).write.format(fmt).save(staged)
    paths = spark._jvm.org.apache.hadoop.fs.Path
    target = paths(f"{path}/rows/segment-{first:012d}-{last:012d}")
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(target.getParent())
    if system.exists(target):  # a micro-batch run again gives the same groups
        remove(spark, staged)
    elif not system.rename(paths(staged), target):
        raise OSError(f"{staged} could not be put at {target}")


def merged_segments(spark: SparkSession, path: str, keys: Sequence[str], fmt: str = "parquet") -> DataFrame:
    """The newest row of each group. Groups meet by ``keys``, each once per segment that changed it."""
    rows = spark.read.format(fmt).option("recursiveFileLookup", True).load(f"{path}/rows")
    return _newest(rows, keys)


def _newest(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    values = [name for name in rows.columns if name not in (*keys, SEGMENT)]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), SEGMENT).alias("__newest"))
    return newest.select(*keys, "__newest.*").select(*[name for name in rows.columns if name != SEGMENT])


def compact(spark: SparkSession, path: str, keys: Sequence[str], fmt: str = "parquet") -> None:
    """Merge all segments into one.

    The merged segment is put beside the others before these are deleted; a run that stops in
    between is made good by the next one, and readers get the same rows at any time.
    """
    found = _segments(spark, path)
    if len(found) < 2:
        return
    last = max(last for _, last in found.values())
    whole = f"{path}/rows/segment-{0:012d}-{last:012d}"
    if whole not in found:
        _put(merged_segments(spark, path, keys, fmt), path, 0, last, fmt)
    for folder in found:
        if folder != whole:
            remove(spark, folder)


def update_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    fmt: str = "parquet",
    compact_after: int = COMPACT_AFTER,
    view: str | None = None,
) -> DataFrame:
    """Keep the streaming aggregate ``df``, grouped by ``keys``, under ``path``; return its rows.

    Each micro-batch writes the groups it changed and no others. A run that ends with more than
    ``compact_after`` segments merges them: the fewer it allows, the less readers merge and
    the more is written. Groups of an aggregate are the state; they never go.
    """
    spark = df.sparkSession
    remove(spark, f"{path}/.staged")

    def add(batch: DataFrame, batch_id: int) -> None:
        _put(batch, path, batch_id, batch_id, fmt)

    query = (
        df.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(add)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if not exists(spark, f"{path}/rows"):
        _put(spark.createDataFrame([], df.schema), path, 0, 0, fmt)
    if len(_segments(spark, path)) > compact_after:
        compact(spark, path, keys, fmt)
    rows = merged_segments(spark, path, keys, fmt)
    if view:
        rows.createOrReplaceTempView(view)
    return rows
