"""Document collections, read through whichever connector the caller names."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_documents(
    spark: SparkSession,
    fmt: str,
    columns: Sequence[str],
    path: str | None = None,
    schema: str | None = None,
    **options: str,
) -> DataFrame:
    """The named columns of a collection. ``fmt`` is ``mongodb``, ``json`` and so on."""
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(path) if path is not None else reader.load()
    return df.select(*columns)


def _condition(conditions: Column | str | Mapping[str, object]) -> Column:
    if isinstance(conditions, Column):
        return conditions
    if isinstance(conditions, str):
        return F.expr(conditions)
    # A null in a condition document matches documents whose field is null or absent.
    tests = [
        F.col(name).isNull() if value is None else F.col(name) == F.lit(value)
        for name, value in conditions.items()
    ]
    return reduce(and_, tests)


def scan_documents(
    documents: DataFrame,
    conditions: Column | str | Mapping[str, object] | None = None,
    projection: Sequence[str] | None = None,
    sort: Sequence[str | tuple[str, int]] | None = None,
) -> DataFrame:
    """Find with an optional condition, projection and sort.

    Each argument applies by itself. ``conditions`` is a Column, a SQL predicate or a
    document of equalities; ``sort`` lists names, or ``(name, 1)`` / ``(name, -1)``.
    The sort runs before the projection, so a field may be sorted on and left out.
    """
    df = documents
    if isinstance(conditions, Column) or conditions:
        df = df.where(_condition(conditions))
    if sort:
        keys = [(key, 1) if isinstance(key, str) else key for key in sort]
        df = df.orderBy(*[F.col(name).desc() if way < 0 else F.col(name).asc() for name, way in keys])
    if projection:
        df = df.select(*projection)
    return df
