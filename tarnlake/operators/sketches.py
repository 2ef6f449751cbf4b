"""Audits from what was noted when rows were appended, without reading them again.

Each commit of a ``Ledger`` with a ``Profile`` notes counts, the range of its keys and sketches
of keys and measures, observed while its rows are written. Sketches merge, so a table is
audited from one small row per commit. Keys are distinct within a commit as counted there; two
commits can only share keys if their ranges meet, and only such commits are ever looked into.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Buckets (as a power of two) of a key sketch; its relative standard error is 1.04 / 2 ** (LOG_BUCKETS / 2).
LOG_BUCKETS = 14
RELATIVE_ERROR = 1.04 / 2 ** (LOG_BUCKETS / 2)
#: Rank error of quantiles from merged measure sketches of the default size, at 99 % confidence.
RANK_ERROR = 0.0165

NOTED = "rows BIGINT, keys BIGINT, corrupt_rows BIGINT, least STRING, most STRING, key_sketch BINARY, measures MAP<STRING, BINARY>"


@dataclass(frozen=True)
class Profile:
    """What is noted of rows as they are appended: their ``key`` and numeric ``measures``."""

    key: str
    measures: tuple[str, ...] = ()

    def columns(self, columns: Sequence[str], corrupt: str) -> list[Column]:
        """Aggregates to observe over rows with ``columns``."""
        bad = F.count(corrupt) if corrupt in columns else F.count(F.lit(None))
        return [
            F.count(F.lit(1)).alias("rows"),
            F.count(self.key).alias("keys"),
            bad.alias("corrupt_rows"),
            F.min(self.key).alias("least"),
            F.max(self.key).alias("most"),
            F.hll_sketch_agg(self.key, F.lit(LOG_BUCKETS)).alias("key_sketch"),
            *[F.kll_sketch_agg_double(F.col(name).cast("double")).alias(f"measure_{name}") for name in self.measures],
        ]

    def note(self, observed: dict) -> tuple:
        """Observed aggregates as a row of ``NOTED``."""
        text = lambda value: None if value is None else str(value)
        plain = lambda value: None if value is None else bytes(value)
        return (
            observed["rows"], observed["keys"], observed["corrupt_rows"], text(observed["least"]), text(observed["most"]),
            plain(observed["key_sketch"]), {name: plain(observed[f"measure_{name}"]) for name in self.measures},
        )


def _islands(notes: DataFrame, kind: str) -> DataFrame:
    """Commits with the group of those whose key ranges meet, directly or through others.

    One row per commit passes one window: a table of a million commits is a million small rows.
    """
    ranged = notes.where("keys > 0").withColumns({"__low": F.col("least").try_cast(kind), "__high": F.col("most").try_cast(kind)})
    order = Window.orderBy("__low", "commit_no")
    before = F.max("__high").over(order.rowsBetween(Window.unboundedPreceding, -1))
    starts = F.when(before.isNull() | (F.col("__low") > before), 1).otherwise(0)
    marked = ranged.withColumn("__starts", starts)
    return marked.withColumn("island", F.sum("__starts").over(order.rowsBetween(Window.unboundedPreceding, 0)))


def audit_commits(ledger, name: str, exact: bool = True) -> DataFrame:
    """One row about a table filled through ``ledger``, whose ``profile`` is set.

    row_count, null_keys and corrupt_rows are sums of what commits noted. distinct_keys and
    duplicate_keys are exact as long as no key ranges of commits meet, and no row of the
    table is read. Where some do, the keys of those commits alone are counted again,
    unless ``exact`` is false: then they are taken as distinct between commits, ``exact`` is
    false in the result, and ``estimated_keys``, which is from merged sketches (relative
    error ``RELATIVE_ERROR``), shows whether that can be. ``rows_read`` says how many rows
    were read for the audit.
    """
    schema = (
        "table_name STRING, row_count BIGINT, distinct_keys BIGINT, null_keys BIGINT, duplicate_keys BIGINT, "
        "corrupt_rows BIGINT, estimated_keys BIGINT, exact BOOLEAN, rows_read BIGINT"
    )
    if ledger.last() == 0:
        return ledger.spark.createDataFrame([(name, 0, 0, 0, 0, 0, 0, True, 0)], schema)
    key = ledger.profile.key
    notes = ledger.notes()
    spark = notes.sparkSession
    data = ledger.committed_after(0)
    kind = dict(data.dtypes)[key]
    islands = _islands(notes, kind)
    size = Window.partitionBy("island")
    met = islands.withColumn("commits", F.count(F.lit(1)).over(size)).where("commits > 1").select("commit_no").collect()
    shared = [row["commit_no"] for row in met]
    totals = notes.agg(
        F.sum("rows").alias("row_count"), F.sum("keys").alias("keys"), F.sum("corrupt_rows").alias("corrupt_rows"),
        F.hll_sketch_estimate(F.hll_union_agg("key_sketch")).alias("estimated_keys"),
    ).first()
    alone = notes.where(~F.col("commit_no").isin(shared)) if shared else notes
    distinct = alone.agg(F.sum("distinct_keys")).first()[0] or 0
    read = 0
    if shared and exact:
        # The filter is on the names of files: those of other commits are not opened.
        wanted = F.substring("_metadata.file_name", 1, 9).cast("bigint").isin(shared)
        row = data.where(wanted).agg(F.count(F.lit(1)).alias("n"), F.count_distinct(key).alias("d")).first()
        read, distinct = row["n"], distinct + row["d"]
    elif shared:
        distinct += notes.where(F.col("commit_no").isin(shared)).agg(F.sum("distinct_keys")).first()[0]
    rows, keys = totals["row_count"] or 0, totals["keys"] or 0
    told = (name, rows, distinct, rows - keys, keys - distinct, totals["corrupt_rows"] or 0, totals["estimated_keys"] or 0, exact or not shared, read)
    return spark.createDataFrame([told], schema)


def measure_quantiles(ledger, fractions: Sequence[float]) -> DataFrame:
    """measure, fraction, value: quantiles of the noted measures from merged sketches alone.

    A value's rank is within ``RANK_ERROR`` of its fraction; null where there is no value.
    """
    each = ledger.notes().select(F.explode("measures").alias("measure", "sketch")).where(F.col("sketch").isNotNull())
    # An empty sketch has no quantiles, and merging it changes nothing.
    filled = each.where(F.kll_sketch_get_n_double("sketch") > 0)
    merged = filled.groupBy("measure").agg(F.kll_merge_agg_double("sketch").alias("sketch"))
    at = F.array(*[F.lit(float(f)) for f in fractions])
    pairs = F.explode(F.arrays_zip(at.alias("fraction"), F.kll_sketch_get_quantile_double("sketch", at).alias("value")))
    return merged.select("measure", pairs.alias("q")).select("measure", "q.fraction", "q.value")
