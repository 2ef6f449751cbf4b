"""Integer date keys (``yyyyMMdd``) and the calendar dimension they point at."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def date_key(day: Column | str) -> Column:
    """``yyyyMMdd`` as a long; null for a null day."""
    day = F.col(day) if isinstance(day, str) else day
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("bigint")


def key_to_date(key: Column | str) -> Column:
    """The day of a ``yyyyMMdd`` key; null for a key that is no calendar day."""
    key = F.col(key) if isinstance(key, str) else key
    return F.try_to_date(F.lpad(key.cast("string"), 8, "0"), "yyyyMMdd")


def _attributes(days: DataFrame) -> DataFrame:
    day = F.col("day")
    return days.select(
        date_key(day).alias("date_key"),
        F.date_format(day, "EEEE").alias("day_name_of_week"),
        F.dayofmonth(day).alias("day_of_month"),
        F.when(F.weekday(day) >= 5, "Weekend").otherwise("Weekday").alias("weekday_weekend"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.quarter(day).alias("calendar_quarter"),
        F.year(day).alias("calendar_year"),
    )


def day_number(day: date | int) -> int:
    """Days since 1970-01-01; a number, unlike a Python date, may lie beyond the year 9999."""
    return day if isinstance(day, int) else (day - date(1970, 1, 1)).days


def date_dimension(spark: SparkSession, first: date | int, last: date | int) -> DataFrame:
    """One row per day from ``first`` to ``last``, both included; dates or day numbers.

    Made in parallel from a range, whose length Spark knows: a calendar too long to be
    broadcast is not.
    """
    start = day_number(first)
    days = spark.range(max(0, day_number(last) - start + 1))
    number = (F.col("id") + F.lit(start)).cast("int")
    return _attributes(days.select(F.date_from_unix_date(number).alias("day")))


def day_bounds(*sources: tuple[DataFrame, str]) -> tuple[int, int] | None:
    """Smallest and largest day number of the given date or timestamp columns, if any.

    Each source is scanned once, for that column alone; one row reaches the driver.
    """
    bounds = [
        frame.agg(F.min(column).cast("date").alias("first"), F.max(column).cast("date").alias("last"))
        for frame, column in sources
    ]
    row = (
        reduce(DataFrame.unionByName, bounds)
        .agg(F.unix_date(F.min("first")).alias("first"), F.unix_date(F.max("last")).alias("last"))
        .first()
    )
    return None if row is None or row["first"] is None else (row["first"], row["last"])


def date_dimension_for(*sources: tuple[DataFrame, str]) -> DataFrame:
    """A calendar from the smallest to the largest day of the given columns.

    The bounds are read when this is called. Store the result where several plans use it.
    """
    spark = sources[0][0].sparkSession
    first, last = day_bounds(*sources) or (0, -1)
    return date_dimension(spark, first, last)
