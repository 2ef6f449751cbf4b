"""Infer the schema of a feed once, then keep it."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructField, StructType


def _stored(spark: SparkSession, store: str) -> StructType | None:
    try:
        row = spark.read.text(store, wholetext=True).first()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return None if row is None else StructType.fromJson(json.loads(row[0]))


def with_hints(inferred: StructType, hints: StructType) -> StructType:
    """``inferred`` with the types of ``hints`` laid over it; unseen columns are added."""
    wanted = {field.name: field.dataType for field in hints}
    fields = [
        StructField(field.name, wanted.pop(field.name, field.dataType)) for field in inferred
    ]
    return StructType(fields + [StructField(name, kind) for name, kind in wanted.items()])


def infer_schema_once(
    spark: SparkSession,
    landing: str,
    store: str,
    hints: str | None = None,
    multi_line: bool = True,
    **options: str,
) -> StructType:
    """The JSON schema of ``landing``, inferred on the first call and kept in ``store``.

    Later calls read ``store`` and never look at the data, so a restarted stream keeps
    its types. ``hints`` is a DDL list that overrides inferred types: a column that is
    null throughout the first files would otherwise become a string for good.
    """
    schema = _stored(spark, store)
    if schema is not None:
        return schema
    sample: DataFrame = spark.read.options(multiLine=multi_line, **options).json(landing)
    schema = StructType([field for field in sample.schema if field.name != "_corrupt_record"])
    if hints:
        schema = with_hints(schema, StructType.fromDDL(hints))
    spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.text(store)
    return schema
