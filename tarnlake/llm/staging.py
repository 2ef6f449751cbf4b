"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnlake.plans.workspace import run_folder, stored


class Stage:
    """A folder of written tables that belong to one run of an operator.

    A table written here has no lineage: a task lost with its executor is rerun from the
    files. Tables that the operator's result does not read are dropped when done with.
    """

    def __init__(self, spark: SparkSession, purpose: str) -> None:
        self.spark = spark
        self.root = run_folder(spark, purpose)
        self._count = 0

    def path(self, name: str) -> str:
        self._count += 1
        return f"{self.root}/{self._count:03d}-{name}"

    def qualified(self, path: str) -> str:
        """``path`` with the scheme of the file system that Spark takes it to be on."""
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        system = place.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return system.makeQualified(place).toString()

    def put(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` written and read again."""
        return stored(df, self.path(name))

    def drop(self, *tables: DataFrame) -> None:
        """Delete the files of tables that ``put`` gave."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        for table in tables:
            for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
                path = hadoop.Path(folder)
                path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


#: Rows, and bytes of its files, up to which a join may copy a written table to every executor.
SMALL_ROWS, SMALL_BYTES = 1_000_000, 32 << 20


def small_or_not(written: DataFrame) -> DataFrame:
    """A hint to copy a written table to all executors if it is small enough.

    Its rows and bytes are those of its files. Beyond either bound the join is left to Spark,
    which shuffles both sides; the rows of the result are the same.
    """
    size = written._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    small = int(str(size)) <= SMALL_BYTES and written.count() <= SMALL_ROWS
    return F.broadcast(written) if small else written


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Hand Python workers fewer rows at once while the jobs started inside run.

    For rows that hold several texts, which would fill much memory at the usual number.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, rows)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)
