"""The schema of a feed as it changes: a log of versions, each at least as wide as the last.

Fields that a delivery brings anew, and values that do not fit, are first kept as JSON beside the
row. From them the next version of the schema is made: unknown fields become columns, types
that proved too narrow are widened. Earlier rows get the new columns out of what was kept.
"""

from __future__ import annotations

import json
import re
from collections.abc import Collection
from dataclasses import dataclass
from functools import reduce
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    NullType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from tarnlake.functions.variants import fitting

#: Whole numbers and days by rising width; what no chain holds is widest as text.
_CHAINS = (
    (ByteType(), ShortType(), IntegerType(), LongType(), DoubleType()),
    (FloatType(), DoubleType()),
    (DateType(), TimestampNTZType(), TimestampType()),
)
#: Digits that a whole number type needs as a decimal.
_DIGITS = {ByteType(): 3, ShortType(): 5, IntegerType(): 10, LongType(): 19}


def widened(one: DataType, other: DataType) -> DataType:
    """The narrowest type that holds values of both, as JSON has them; text holds all.

    As with Spark's own inference, whole numbers and fractions meet in a double. Two decimals, or
    one and a whole number, meet in the decimal that holds the digits of both, or else
    in a double. Lists and records are widened inside; a type and null is that type.
    """
    if one == other or isinstance(other, NullType):
        return one
    if isinstance(one, NullType):
        return other
    if isinstance(one, StructType) and isinstance(other, StructType):
        return merged(one, other)
    if isinstance(one, ArrayType) and isinstance(other, ArrayType):
        return ArrayType(widened(one.elementType, other.elementType))
    if isinstance(one, DecimalType) or isinstance(other, DecimalType):
        return _with_decimal(one, other)
    for chain in _CHAINS:
        if one in chain and other in chain:
            return chain[max(chain.index(one), chain.index(other))]
    numbers = {*_CHAINS[0], *_CHAINS[1]}
    return DoubleType() if one in numbers and other in numbers else StringType()


def _with_decimal(one: DataType, other: DataType) -> DataType:
    def digits(kind: DataType) -> tuple[int, int] | None:
        if isinstance(kind, DecimalType):
            return kind.precision - kind.scale, kind.scale
        return (_DIGITS[kind], 0) if kind in _DIGITS else None

    a, b = digits(one), digits(other)
    if a is None or b is None:
        return DoubleType() if {one, other} & {DoubleType(), FloatType()} else StringType()
    whole, scale = max(a[0], b[0]), max(a[1], b[1])
    return DecimalType(whole + scale, scale) if whole + scale <= 38 else DoubleType()


def merged(one: StructType, other: StructType, pinned: Collection[str] = ()) -> StructType:
    """The fields of both, those of ``one`` first, each wide enough; ``pinned`` ones keep their type."""
    added = {field.name: field.dataType for field in other}
    fields = []
    for field in one:
        kind = added.pop(field.name, field.dataType)
        fields.append(StructField(field.name, field.dataType if field.name in pinned else widened(field.dataType, kind)))
    fields += [StructField(name, kind) for name, kind in added.items()]
    return StructType([f for f in fields if not isinstance(f.dataType, NullType)])


def _plain(kind: DataType) -> DataType:
    """A type seen in JSON as its inference has it: fractions are doubles."""
    if isinstance(kind, DecimalType):
        return DoubleType() if kind.scale else LongType()
    if isinstance(kind, StructType):
        return StructType([StructField(f.name, _plain(f.dataType)) for f in kind])
    if isinstance(kind, ArrayType):
        return ArrayType(_plain(kind.elementType))
    return kind


def observed(texts: DataFrame, column: str) -> StructType:
    """The schema of the JSON objects in a text column: one aggregate, of which the driver gets the types.

    Values of types that do not meet are text. Texts that are no JSON object count for nothing.
    """
    parsed = F.try_parse_json(column)
    found = texts.where(F.col(column).isNotNull()).select(F.when(F.schema_of_variant(parsed).startswith("OBJECT<"), parsed).alias("v"))
    told = found.where("v IS NOT NULL").agg(F.schema_of_variant_agg("v").alias("s")).first()["s"]
    if told is None or not told.startswith("OBJECT<"):
        return StructType([])
    # Types stand behind a colon or in a list; names that read like one stay.
    ddl = re.sub(r"(: |ARRAY<)VARIANT\b", r"\1STRING", re.sub(r"(: |ARRAY<)OBJECT<", r"\1STRUCT<", f"o: {told}"))
    return _plain(StructType.fromDDL(ddl)["o"].dataType)


@dataclass(frozen=True)
class SchemaLog:
    """Versions of a schema, one file each in a folder: the last one holds, none is changed."""

    spark: SparkSession
    root: str

    def _system(self):
        return self._path("").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}".rstrip("/"))

    def versions(self) -> dict[int, StructType]:
        """Every version by its number, from 1."""
        system = self._system()
        if not system.exists(self._path("")):
            return {}
        names = sorted(s.getPath().getName() for s in system.listStatus(self._path("")))
        return {int(name.split(".")[0]): self._read(name) for name in names if name.endswith(".json") and name[0].isdigit()}

    def _read(self, name: str) -> StructType:
        stream = self._system().open(self._path(name))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return StructType.fromJson(json.loads(text))

    def latest(self) -> tuple[int, StructType] | None:
        known = self.versions()
        return (max(known), known[max(known)]) if known else None

    def append(self, schema: StructType) -> int:
        """Add a version; returns its number. Fails if another writer took the number."""
        number = max(self.versions(), default=0) + 1
        system = self._system()
        system.mkdirs(self._path(""))
        written, target = self._path(f".{uuid4().hex}"), self._path(f"{number:09d}.json")
        out = system.create(written, False)
        try:
            out.write(bytearray(schema.json().encode()))
        finally:
            out.close()
        if system.exists(target) or not system.rename(written, target):
            system.delete(written, False)
            raise OSError(f"version {number} of {self.root} was taken by another writer")
        return number

    def seen(self) -> int:
        """The last commit whose rows were looked through for a wider schema; 0 for none."""
        system = self._system()
        if not system.exists(self._path("")):
            return 0
        names = [s.getPath().getName() for s in system.listStatus(self._path(""))]
        return max((int(name.removeprefix("seen-")) for name in names if name.startswith("seen-")), default=0)

    def see(self, commit: int) -> None:
        """Note that all commits up to this one were looked through."""
        if commit > self.seen():
            self._system().create(self._path(f"seen-{commit:09d}"), False).close()

    def follow(self, schema: StructType, rescued: DataFrame, column: str, pinned: Collection[str] = ()) -> StructType:
        """The schema widened by what was kept beside rows read with it; logged if that changes it."""
        wider = merged(schema, observed(rescued, column), pinned)
        if wider != StructType([StructField(f.name, f.dataType) for f in schema]):
            self.append(wider)
        return wider


def filled_back(rows: DataFrame, schema: StructType, rescued: str) -> DataFrame:
    """``rows`` read with an earlier version, as the fields of ``schema`` and what is left beside them.

    A field that the rows lack, or have as null since its value did not fit, is taken out of
    ``rescued``; what it holds beyond these fields stays there. Other columns are kept.
    """
    kept = {field.name: field.dataType for field in rows.schema}
    others = [name for name in rows.columns if name not in schema.names and name != rescued]
    open_fields = [field for field in schema if kept.get(field.name) != field.dataType]
    if not open_fields:
        return rows.select(*[F.col(f"`{name}`") for name in (*schema.names, rescued, *others)])
    # Each step is a select of its own, so that no text is parsed, and no member looked up, once for each use.
    parsed = rows.select("*", F.try_parse_json(rescued).alias("__beside"))
    found = {field.name: f"__found_{n}" for n, field in enumerate(open_fields)}
    looked_up = parsed.select(
        "*",
        *[fitting(F.col("__beside"), field.name, field.dataType).alias(found[field.name]) for field in open_fields],
        F.try_variant_get("__beside", "$", "map<string,variant>").alias("__members"),
    )
    names = F.array_compact(F.array(*[F.when(F.col(column).isNotNull(), F.lit(name)) for name, column in found.items()]))
    told = looked_up.select("*", F.when(F.col("__members").isNotNull(), names).alias("__taken"))
    rest = F.map_filter("__members", lambda name, _: ~F.array_contains("__taken", name))
    left = told.select("*", rest.alias("__rest"))
    values: dict[str, Column] = {}
    for field in schema:
        value = F.col(f"`{field.name}`")
        if field.name not in found:
            values[field.name] = value
        elif field.name in kept:
            values[field.name] = F.coalesce(value.try_cast(field.dataType), F.col(found[field.name]))
        else:
            values[field.name] = F.col(found[field.name])
    beside = F.when(F.col("__members").isNull(), F.col(rescued)).when(F.size("__rest") > 0, F.to_json("__rest"))
    return left.select(
        *[value.alias(name) for name, value in values.items()], beside.alias(rescued), *[F.col(f"`{name}`") for name in others]
    )


def as_one(parts: list[DataFrame]) -> DataFrame:
    """Rows of all versions together."""
    return reduce(DataFrame.unionByName, parts)
