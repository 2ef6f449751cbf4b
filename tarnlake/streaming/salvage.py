"""Files that landed in another form than their feed's: found in bronze, read another way.

A file that is no JSON leaves rows in bronze whose text is in ``_corrupt_record``. Here such
files are read again as CSV with a header, their rows get the feed's types and the lineage of
the file, and the ledger takes them as it takes any other append, so that none is replayed twice.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tarnlake.functions import with_lineage
from tarnlake.streaming.ingest import CORRUPT_COLUMN, FILES_PER_BATCH, RESCUED_COLUMN
from tarnlake.streaming.ledger import Ledger, path_of

#: Ways in the ledger: replayed as CSV, and tried in vain.
CSV_WAY, UNREADABLE_WAY = "csv", "unreadable"


def dead_letters(bronze: DataFrame, ledger: Ledger) -> DataFrame:
    """One row for each file with records that did not parse: how many, an example, what was done.

    ``way`` is null while nothing was done about a file, else how it was replayed, or that
    no reader could.
    """
    bad = bronze.where(F.col(CORRUPT_COLUMN).isNotNull() & F.col("source_file").isNotNull())
    files = bad.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("records"), F.min(F.substring(CORRUPT_COLUMN, 1, 200)).alias("example")
    )
    done = ledger.entries().where(F.col("way").isin(CSV_WAY, UNREADABLE_WAY)).select("source_file", "way")
    return files.join(done, "source_file", "left")


def first_lines(spark: SparkSession, files: Sequence[str]) -> dict[str, str]:
    """The first line of each file; the driver gets one line per file."""
    # The reader gives the lines of a split in order, and the first split of a file starts at 0.
    lines = spark.read.text([path_of(spark, file) for file in files]).select(
        F.input_file_name().alias("file"), "value", F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("n"),
    )
    first = lines.where("start = 0").groupBy("file").agg(F.min_by("value", "n").alias("line"))
    return {row["file"]: row["line"] for row in first.collect()}


def _cells(line: str, sep: str) -> tuple[str, ...]:
    return tuple(cell.strip().strip('"') for cell in line.lstrip("\ufeff").split(sep))


def read_csv_as(spark: SparkSession, files: Sequence[str], header: Sequence[str], schema: StructType, **options: str) -> DataFrame:
    """CSV files of one header as rows of ``schema``, with their lineage.

    Columns meet fields by name. A cell that does not fit its field's type, and one of an
    unknown column, is kept in ``_rescued``; a line of another form in ``_corrupt_record``.
    """
    text = StructType([StructField(name, StringType()) for name in header]).add(CORRUPT_COLUMN, StringType())
    reader = spark.read.schema(text).options(header=True, escape='"', columnNameOfCorruptRecord=CORRUPT_COLUMN)
    cells = with_lineage(reader.options(**options).csv([path_of(spark, file) for file in files]))
    fields = [field for field in schema if field.name != CORRUPT_COLUMN]
    values = {
        field.name: F.col(f"`{field.name}`").try_cast(field.dataType) if field.name in header else F.lit(None).cast(field.dataType)
        for field in fields
    }
    kept = [
        F.struct(F.lit(name).alias("key"), F.when(values[name].isNull() if name in values else F.lit(True), F.col(f"`{name}`")).alias("value"))
        for name in header
    ]
    rest = F.map_from_entries(F.filter(F.array(*kept), lambda entry: entry["value"].isNotNull()))
    return cells.select(
        *[value.alias(name) for name, value in values.items()],
        CORRUPT_COLUMN,
        F.when(F.size(rest) > 0, F.to_json(rest)).alias(RESCUED_COLUMN),
        "receipt_time",
        "source_file",
    )


def replay_as_csv(
    bronze: DataFrame, ledger: Ledger, schema: str | StructType, key: str, sep: str = ",",
    max_files: int = FILES_PER_BATCH, **options: str,
) -> int:
    """Append the rows of dead letters that are CSV files with ``key`` in their header.

    Returns the number of files replayed. Files are worked off ``max_files`` at a time, each
    time in one commit; those of another form are noted as unreadable and not tried again.
    The records that did not parse stay in bronze, as does everything.
    """
    if not isinstance(schema, StructType):
        schema = StructType.fromDDL(schema)
    spark = bronze.sparkSession
    ledger.recover()
    replayed = 0
    while True:
        open_letters = dead_letters(bronze, ledger).where("way IS NULL").orderBy("source_file").limit(max_files)
        files = [row["source_file"] for row in open_letters.select("source_file").collect()]
        if not files:
            return replayed
        by_header = defaultdict(list)
        for file, line in first_lines(spark, files).items():
            by_header[_cells(line, sep)].append(file)
        readable = {header: names for header, names in by_header.items() if key in header and len(set(header)) == len(header)}
        taken: list[str] = []
        if readable:
            frames = [read_csv_as(spark, names, header, schema, sep=sep, **options) for header, names in readable.items()]
            rows = reduce(DataFrame.unionByName, frames).select(*bronze.columns)
            taken = ledger.append(rows, CSV_WAY)
            replayed += len(taken)
        ledger.note(sorted(set(files) - set(taken)), UNREADABLE_WAY)
