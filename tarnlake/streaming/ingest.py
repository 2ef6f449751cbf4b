"""Streaming reads: landed JSON files, and append-only tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader
from pyspark.sql.types import ArrayType, MapType, StringType, StructField, StructType, VariantType

from tarnlake.functions.variants import fitting

CORRUPT_COLUMN = "_corrupt_record"
RESCUED_COLUMN = "_rescued"

# A backlog is worked off in micro-batches of this many files, each committed on its own.
FILES_PER_BATCH = 1000


def _bounded(reader: DataStreamReader, max_files: int | None) -> DataStreamReader:
    return reader if max_files is None else reader.option("maxFilesPerTrigger", max_files)


def stream_json(
    spark: SparkSession,
    landing: str,
    schema: str | StructType,
    multi_line: bool = True,
    max_files: int | None = FILES_PER_BATCH,
    keep_corrupt: bool = True,
    view: str | None = None,
    rescue: bool = False,
    **options: str,
) -> DataFrame:
    """Files of ``landing`` as they arrive, each read once.

    ``multi_line=True`` expects one JSON array (or object) per file and reads a file in
    one task, so such files must be kept small. With ``multi_line=False`` each line is a
    record and large files split; a line-delimited file read the other way yields its
    first record only. A record that does not parse becomes a row of nulls with its text
    in ``_corrupt_record``; with ``multi_line`` that is the whole file.

    ``max_files`` bounds a micro-batch; to bound it by size instead, pass None and
    ``maxBytesPerTrigger``.

    Fields that the schema does not name are dropped, and a value that does not fit its
    type makes a corrupt record, unless ``rescue`` is set: then both are kept as a JSON
    object in ``_rescued``, null where there is nothing to keep.
    """
    if not isinstance(schema, StructType):
        schema = StructType.fromDDL(schema)
    if keep_corrupt and CORRUPT_COLUMN not in schema.names:
        schema = StructType([*schema.fields]).add(CORRUPT_COLUMN, StringType())
    reader = _bounded(spark.readStream, max_files).options(multiLine=multi_line, **options)
    if rescue and not multi_line and options.get("mode", _PERMISSIVE).upper() == _PERMISSIVE:
        df = _rescued_lines(_bounded(spark.readStream, max_files).options(**options), landing, schema, keep_corrupt, options)
    elif rescue:
        df = _rescued(reader, landing, schema, keep_corrupt)
    else:
        df = reader.schema(schema).json(landing)
    if view:
        df.createOrReplaceTempView(view)
    return df


#: What the reader does with bad records where ``from_json`` does the same.
_PERMISSIVE = "PERMISSIVE"


def _rescued(
    reader: DataStreamReader, landing: str, schema: StructType, keep_corrupt: bool
) -> DataFrame:
    """Files of JSON arrays: whole records as variants, cut into the fields of the schema and what is left."""
    whole = StructType([StructField("__file", VariantType()), StructField(CORRUPT_COLUMN, StringType())])
    read = reader.schema(whole).option("singleVariantColumn", "__file").json(landing)
    array = F.try_variant_get("__file", "$", "array<variant>")
    records = read.select(
        F.explode_outer(F.coalesce(array, F.array("__file"))).alias("__record"), CORRUPT_COLUMN
    ).where(F.col("__record").isNotNull() | F.col(CORRUPT_COLUMN).isNotNull())
    return _cut(records, schema, keep_corrupt)


def _rescued_lines(
    reader: DataStreamReader, landing: str, schema: StructType, keep_corrupt: bool, options: dict[str, str]
) -> DataFrame:
    """Line-delimited records: parsed once by the schema, and as variants only where that does not hold all of them.

    That is where a value does not fit, a field is unknown, or a line is no JSON object.
    """
    fields = [field for field in schema if field.name != CORRUPT_COLUMN]
    wanted = StructType([*fields, StructField(CORRUPT_COLUMN, StringType())])
    how = {**options, "columnNameOfCorruptRecord": CORRUPT_COLUMN}
    lines = reader.text(landing).where(F.length(F.trim("value")) > 0)
    parsed = lines.select("value", F.from_json("value", wanted, how).alias("__parsed"))
    known = F.array(*[F.lit(field.name) for field in fields]) if fields else F.array().cast("array<string>")
    # A key has a colon of its own, so an object with no more of them than it has values has no other key.
    # What only the reader of fields takes (single quotes, numbers that are none) is left to the keys.
    filled = sum((F.col("__parsed").getField(field.name).isNotNull().cast("int") for field in fields), F.lit(0))
    colons = F.octet_length("value") - F.octet_length(F.replace("value", F.lit(":"), F.lit("")))
    unknown = F.size(F.array_except(F.json_object_keys("value"), known))
    plain = F.col("value").startswith("{") & (colons == filled)
    for sign in ("'", "NaN", "INF", "Infinity"):
        plain = plain & ~F.col("value").contains(sign)
    if any(name.lower().startswith("allow") for name in options):
        plain = F.lit(False)
    all_known = F.when(plain, F.lit(True)).otherwise(unknown == 0)
    fits = all_known & F.col(f"__parsed.{CORRUPT_COLUMN}").isNull()
    for field in fields:
        if isinstance(field.dataType, (ArrayType, MapType, StructType)):
            # The parser drops unknown members of records within records and does not say so.
            fits = fits & F.col("__parsed").getField(field.name).isNull()
    fits = F.coalesce(fits, F.lit(False))
    # Told once and then used: a step that repeats it grows past what the JVM compiles.
    told = parsed.select("*", fits.alias("__fits"))
    judged = told.select("*", F.when(~F.col("__fits"), F.try_parse_json("value")).alias("__line"))
    array = F.try_variant_get("__line", "$", "array<variant>")
    lists = F.when(F.col("__line").isNotNull(), F.coalesce(array, F.array("__line")))
    records = judged.select(
        "__parsed", "__fits", F.explode_outer(lists).alias("__record"),
        F.when(~F.col("__fits") & F.col("__line").isNull(), F.col("value")).alias(CORRUPT_COLUMN),
    ).where(F.col("__fits") | F.col("__record").isNotNull() | F.col(CORRUPT_COLUMN).isNotNull())
    return _cut(records, schema, keep_corrupt)


def _cut(records: DataFrame, schema: StructType, keep_corrupt: bool) -> DataFrame:
    """The fields of the schema and what is left, of records as variants or (``__fits``) as parsed."""
    fields = [field for field in schema if field.name != CORRUPT_COLUMN]
    parsed = "__fits" in records.columns
    values = {field.name: fitting(F.col("__record"), field.name, field.dataType) for field in fields}
    if parsed:
        values = {
            name: F.when(F.col("__fits"), F.col("__parsed").getField(name)).otherwise(value) for name, value in values.items()
        }
    beside = [name for name in ("__fits", "__record", CORRUPT_COLUMN) if name in records.columns]
    kept = records.select(*beside, *[value.alias(name) for name, value in values.items()])
    taken = F.array_compact(
        F.array(*[F.when(F.col(f"`{name}`").isNotNull(), F.lit(name)) for name in values])
    )
    odd = ~F.col("__fits") if parsed else F.lit(True)
    members = F.try_variant_get("__record", "$", "map<string,variant>")
    # A step of its own for each: what a function over members uses would be made again for every member.
    told = kept.select("*", F.when(odd, taken).alias("__taken"), F.when(odd, members).alias("__members"))

    def unknown(name: Column, value: Column) -> Column:
        return ~F.array_contains("__taken", name) & ~F.is_variant_null(value)

    left = told.select("*", F.map_filter("__members", unknown).alias("__rest"))
    rest = F.col("__rest")
    rescued = F.when(F.col("__members").isNull(), F.to_json("__record")).when(F.size(rest) > 0, F.to_json(rest))
    if parsed:
        rescued = F.when(odd, rescued)
    corrupt = [CORRUPT_COLUMN] if keep_corrupt or CORRUPT_COLUMN in schema.names else []
    return left.select(*[F.col(f"`{name}`") for name in values], *corrupt, rescued.alias(RESCUED_COLUMN))


def stream_table(
    spark: SparkSession,
    table: str,
    max_files: int | None = FILES_PER_BATCH,
    view: str | None = None,
) -> DataFrame:
    """The rows appended to ``table``, each read once."""
    df = _bounded(spark.readStream, max_files).table(table)
    if view:
        df.createOrReplaceTempView(view)
    return df
