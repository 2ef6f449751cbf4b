"""Gapless row numbers without gathering the rows of a group in one task."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Most cells of a group: their counts are one small row each.
MAX_CELLS = 1 << 16


def cells_for(rows: int, rows_per_cell: int = 64) -> int:
    """Number of cells that keeps a cell at about ``rows_per_cell`` rows, within ``MAX_CELLS``."""
    return max(1, min(MAX_CELLS, ceil(rows / rows_per_cell)))


def number_within(
    df: DataFrame, group: str, order: list[str], out: str, cells: int, spread_by: list[str] | None = None
) -> DataFrame:
    """Add ``out``: 0, 1, 2, ... within each ``group``.

    Rows of a group are dealt over ``cells`` cells by a hash of ``spread_by`` (default:
    ``order``), numbered inside their cell in the given order, and moved on by the sizes of
    the cells before it. Rows that agree in ``order`` are interchangeable. ``df`` is read
    twice and must give the same rows each time.
    """
    cell = F.pmod(F.xxhash64(*(spread_by or order)), F.lit(cells)).cast("int")
    dealt = df.withColumn("__cell", cell)
    counts = dealt.groupBy(F.col(group).alias("__group"), F.col("__cell").alias("__of")).agg(
        F.count(F.lit(1)).alias("__rows")
    )
    before = Window.partitionBy("__group").orderBy("__of").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("__before", F.coalesce(F.sum("__rows").over(before), F.lit(0))).drop("__rows")
    inside = Window.partitionBy(group, "__cell").orderBy(*order)
    numbered = dealt.withColumn("__row", F.row_number().over(inside) - F.lit(1))
    same: Column = F.col(group).eqNullSafe(F.col("__group")) & (F.col("__cell") == F.col("__of"))
    return (
        numbered.join(offsets, same)
        .withColumn(out, F.col("__before") + F.col("__row"))
        .drop("__cell", "__row", "__group", "__of", "__before")
    )


#: Most ranges: their bounds are constants of the plan.
MAX_RANGES = 1 << 16


def range_bounds(df: DataFrame, key: str, ranges: int) -> list[int]:
    """Values of ``key``, at most ``ranges - 1`` and ``MAX_RANGES``, that cut it into ranges of about equal counts.

    Every bound is a value that occurs and is above the smallest, so no range is empty.
    """
    ranges = max(1, min(MAX_RANGES, ranges))
    if ranges == 1:
        return []
    shares = [i / ranges for i in range(1, ranges)]
    row = df.agg(
        F.percentile_approx(key, shares, max(10_000, 10 * ranges)).alias("at"), F.min(key).alias("first")
    ).first()
    return sorted({x for x in row["at"] or [] if x > row["first"]})


def bucket_of(key: str, bounds: list[int]) -> Column:
    """Number of bounds that are at most ``key``, by binary search; null counts as the last."""
    if not bounds:
        return F.lit(0)
    table = F.split(F.lit(",".join(map(str, bounds))), ",").cast("array<bigint>")
    steps = [1 << i for i in reversed(range(len(bounds).bit_length()))]

    def step(found: Column, size: Column) -> Column:
        there = found + size
        inside = (there <= len(bounds)) & F.coalesce(F.get(table, there - 1) <= F.col(key), F.lit(True))
        return F.when(inside, there).otherwise(found)

    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), step)
