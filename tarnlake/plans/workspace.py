"""Where runs keep their tables, checkpoints and landed files."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors see.

    That is ``spark.checkpoint.dir``, or the checkpoint folder set on the context. A session
    without either has the warehouse, which tables need to be shared as well.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return (base or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def run_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name under the shared folder. Whoever asks for it owns what is put there."""
    return f"{shared_folder(spark)}/tarnlake-{purpose}-{uuid4().hex[:12]}"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on whatever file system it would be."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def written_at(spark: SparkSession, file: str) -> str:
    """A file by its name, length and time of writing: another content is another text."""
    place = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(file))
    status = place.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(place)
    return f"{file} {status.getLen()} {status.getModificationTime()}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system it is, if it is there."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Delete the shuffle files of each query started inside as soon as it ends; of a stream, each micro-batch.

    Else they lie on the executors until the driver collects its garbage. Only for queries whose
    shuffles nothing reads again, such as one write.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, True)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def stored(df: DataFrame, folder: str) -> DataFrame:
    """``df`` written once and read back, for a result that several branches scan.

    Cuts the lineage: the branches, and tasks rerun after a lost executor, scan files
    instead of repeating the joins behind ``df``.
    """
    df.write.parquet(folder)
    return df.sparkSession.read.parquet(folder)
