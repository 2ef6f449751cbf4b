"""Document collections replaced from files."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tarnlake.plans.workspace import remove, run_folder, stored


def _swap(spark: SparkSession, staged: str, target: str) -> None:
    """Put a written folder in the place of another on the same file system."""
    paths = spark._jvm.org.apache.hadoop.fs.Path
    new, old = paths(staged), paths(target)
    system = new.getFileSystem(spark._jsc.hadoopConfiguration())
    aside = paths(f"{staged}-replaced")
    if system.exists(old) and not system.rename(old, aside):
        raise OSError(f"{target} could not be set aside")
    if not system.rename(new, old):
        system.rename(aside, old)
        raise OSError(f"{staged} could not be put in the place of {target}")
    system.delete(aside, True)


def replace_collections(
    spark: SparkSession,
    files: Mapping[str, str],
    target: str | None = None,
    fmt: str = "json",
    schemas: Mapping[str, str | StructType] | None = None,
    multi_line: bool = True,
    collection_option: str | None = None,
    options: Mapping[str, str] | None = None,
    staging: str | None = None,
) -> DataFrame:
    """Replace each named collection by the documents of its file; safe to repeat.

    Collections are folders ``target/name``, or, where a connector has one namespace
    for them, writes with ``collection_option`` set to the name. Every file is parsed in
    full into a staging folder first, all of them before any collection is touched: a file
    with a record that does not parse fails the call and leaves every collection as it was.
    A folder is then put in its place by renaming. ``staging`` is by default a hidden folder
    in ``target``, for a connector one in the session's shared folder.
    Returns one row per collection: its name and the documents now in it.
    """
    if (target is None) == (collection_option is None):
        raise ValueError("give either target or collection_option")
    options = dict(options or {})
    if staging is None:
        staging = f"{target}/.staging" if target is not None else run_folder(spark, "staging")
    staged = f"{staging}/{uuid4().hex}"
    read = {}
    for name, file in files.items():
        reader = spark.read.options(multiLine=multi_line, mode="FAILFAST")
        schema = (schemas or {}).get(name)
        if schema is not None:
            reader = reader.schema(schema)
        documents = reader.json(file)
        if target is not None:
            documents.write.format(fmt).options(**options).save(f"{staged}/{name}")
        else:
            read[name] = stored(documents, f"{staged}/{name}")
    counts = []
    for name in files:
        back = spark.read.format(fmt).options(**options)
        if target is not None:
            _swap(spark, f"{staged}/{name}", f"{target}/{name}")
            now = back.load(f"{target}/{name}")
        else:
            writer = read[name].write.format(fmt).mode("overwrite").options(**options)
            writer.option(collection_option, name).save()
            now = back.option(collection_option, name).load()
        counts.append(
            now.agg(F.count(F.lit(1)).alias("documents")).select(
                F.lit(name).alias("collection"), "documents"
            )
        )
    remove(spark, staged)
    return reduce(DataFrame.unionByName, counts)
