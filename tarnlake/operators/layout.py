"""Tables laid out so that a question about any of several columns opens few files.

Rows are dealt to files along a Z-order curve: each column is cut into ranges of about equal
counts, and the bits of their numbers are interleaved. A sorted table serves its first column
alone; this one serves all of them alike. A manifest holds the range of each column in each
file, and readers pick files by it before any is opened.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Ranges of a column, as a power of two: more make finer files and a longer plan.
BITS = 6
#: How exact the bounds of ranges are: their ranks are off by one in so many rows.
ACCURACY = 10_000

#: Smallest and largest value asked for; None leaves that end open.
Range = tuple[object, object]


def as_number(df: DataFrame, name: str) -> Column:
    """A column as a number of the same order; text by its first six bytes."""
    kind = dict(df.dtypes)[name]
    if kind == "string":
        return F.conv(F.hex(F.rpad(F.encode(F.col(name), "UTF-8"), 6, b"\x00").substr(1, 6)), 16, 10).cast("double")
    if kind == "date":
        return F.unix_date(name).cast("double")
    if kind.startswith("timestamp"):
        return F.unix_micros(F.col(name).cast("timestamp")).cast("double")
    return F.col(name).cast("double")


def z_order(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> Column:
    """The place of a row on a Z-order curve through ``columns``; nulls come first.

    The bounds of the ranges are one aggregate over ``df``, of 2 ** ``bits`` numbers a column.
    """
    shares = [i / 2**bits for i in range(1, 2**bits)]
    row = df.agg(*[F.percentile_approx(as_number(df, name), shares, ACCURACY).alias(name) for name in columns]).first()
    place = F.lit(0).cast("bigint")
    for number, name in enumerate(columns):
        bounds = sorted(set(row[name] or []))
        table = F.split(F.lit(",".join(map(repr, bounds))), ",").cast("array<double>") if bounds else F.array().cast("array<double>")
        at = _bounds_below(table, as_number(df, name))
        for bit in range(bits):
            place = place + F.shiftleft(F.shiftright(at, bit).bitwiseAND(F.lit(1)).cast("bigint"), bit * len(columns) + number)
    return place


def _bounds_below(table: Column, value: Column) -> Column:
    """How many bounds a value is beyond; a null is beyond none."""
    return F.size(F.filter(table, lambda bound: bound < value))


def clustered(df: DataFrame, columns: Sequence[str], files: int, bits: int = BITS) -> DataFrame:
    """``df`` in ``files`` partitions along the curve, sorted inside; one range shuffle.

    Rows at one place of the curve go to one partition unless they share all ``columns`` with very
    many others: a random third column of the range key parts them.
    """
    spread = df.withColumn("__place", z_order(df, columns, bits)).withColumn("__part", F.xxhash64(*df.columns))
    return spread.repartitionByRange(files, "__place", "__part").sortWithinPartitions("__place").drop("__place", "__part")


def manifest(table: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row for each file of ``table``: its name, rows, and the range of each column and whether it has nulls.

    Reads these columns alone.
    """
    ranges = [
        expression
        for name in columns
        for expression in (
            F.min(name).alias(f"{name}_least"), F.max(name).alias(f"{name}_most"),
            (F.count(F.lit(1)) > F.count(name)).alias(f"{name}_nulls"),
        )
    ]
    return table.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("rows"), *ranges)


def _inside(name: str, asked: Range) -> tuple[Column, Column]:
    """Whether a file may hold a row asked for, and whether a row is."""
    low, high = asked
    file, row = F.lit(True), F.col(name).isNotNull()
    if low is not None:
        file, row = file & (F.col(f"{name}_most") >= F.lit(low)), row & (F.col(name) >= F.lit(low))
    if high is not None:
        file, row = file & (F.col(f"{name}_least") <= F.lit(high)), row & (F.col(name) <= F.lit(high))
    return F.coalesce(file, F.lit(False)), row


def files_for(files: DataFrame, asked: Mapping[str, Range]) -> list[str]:
    """Files of a ``manifest`` that may hold rows with every asked column in its range."""
    kept = reduce(lambda df, item: df.where(_inside(*item)[0]), asked.items(), files)
    return sorted(row["file"] for row in kept.select("file").collect())


def read_ranges(
    spark: SparkSession, files: DataFrame, table: DataFrame, asked: Mapping[str, Range], fmt: str = "parquet", most: int = 10_000
) -> DataFrame:
    """Rows of ``table`` with every asked column in its range, out of the files that may hold some.

    Where more than ``most`` files do, names are no longer passed to Spark one by one: the table is
    read with the same condition, and its files are skipped by their own statistics.
    """
    condition = reduce(lambda a, b: a & b, [_inside(name, pair)[1] for name, pair in asked.items()], F.lit(True))
    names = files_for(files, asked)
    if not names:
        return table.where(F.lit(False))
    if len(names) > most:
        return table.where(condition)
    paths = [spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(name)).toString() for name in names]
    return spark.read.schema(table.schema).format(fmt).load(paths).where(condition)
