"""Land a frame as the JSON files a feed would deliver."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnlake.plans.workspace import remove, shuffles_dropped

# Microseconds survive the round trip only with an explicit format, on both sides.
JSON_TIMESTAMPS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


#: Lines of a landed file, which is read by one task as it is compressed.
LINES_PER_FILE = 250_000
#: Names of fields stand in every line. A level above this one takes longer than it saves.
COMPRESSION = {"compression": "gzip", "zlib.compress.level": "FIVE"}


def land_lines(df: DataFrame, landing: str) -> None:
    """Append line-delimited, compressed files of at most ``LINES_PER_FILE`` records: more data is more files."""
    lines = df.write.options(maxRecordsPerFile=LINES_PER_FILE, **COMPRESSION, **JSON_TIMESTAMPS)
    with shuffles_dropped(df.sparkSession):
        lines.mode("append").json(landing)


def land_csv_lines(df: DataFrame, landing: str) -> None:
    """Append CSV files with a header under names that end as those of the JSON files do."""
    spark = df.sparkSession
    written = f"{landing}-csv-{uuid4().hex[:8]}"
    df.write.options(header=True, escape='"').csv(written)
    paths = spark._jvm.org.apache.hadoop.fs.Path
    system = paths(landing).getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(paths(landing))
    for status in system.listStatus(paths(written)):
        name = status.getPath().getName()
        if name.startswith("part-"):
            system.rename(status.getPath(), paths(f"{landing}/{name.removesuffix('.csv')}.json"))
    remove(spark, written)


def land_arrays(df: DataFrame, landing: str, per_file: int = 5_000) -> None:
    """Append files of one JSON array each, of at most ``per_file`` records.

    Records are taken together by their position in the input, so no array grows with
    the data or with a value that repeats.
    """
    place = F.floor(F.monotonically_increasing_id() / per_file)
    arrays = (
        df.select(place.alias("place"), F.struct(*df.columns).alias("record"))
        .groupBy("place")
        .agg(F.to_json(F.collect_list("record"), JSON_TIMESTAMPS).alias("value"))
        .select("value")
    )
    arrays.write.option("maxRecordsPerFile", 1).mode("append").text(landing)
