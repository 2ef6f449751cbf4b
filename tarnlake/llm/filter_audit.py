"""How filters over documents interact: what each removes, at each place of each order.

Documents are reduced to the set of filters that they fail, as bits, in one pass over the
texts (``byte_transducer``) and one meeting of equal texts. What a filter removes after
others depends on those sets alone, so documents are counted by part and set first, and all
orders are worked out from these few counts.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnlake.llm.byte_transducer import COUNT_SCHEMA, text_counts
from tarnlake.llm.staging import Stage, small_or_not

#: The filters by letter, as conditions on the counts of a text, that fail a document.
FILTERS: dict[str, Column | str] = {
    "A": "words < 200",
    "B": "100 * distinct_words < 50 * words",
    "C": "100 * capitals > 3 * code_points",
    "D": "symbols > 0",
    "E": "repeated",
}


def with_counts(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``docs`` with the digest and counts of ``text``, one row per row."""
    fields = {f.name: f.dataType.simpleString() for f in docs.schema}
    kept = "".join(f"`{name}` {fields[name]}, " for name in keep)
    return docs.select(*keep, "text").mapInArrow(text_counts, kept + COUNT_SCHEMA)


def with_repeated(counted: DataFrame, stage: Stage) -> DataFrame:
    """Add ``repeated``: whether a row of smaller doc_id has the same text.

    ``counted`` has ``doc_id`` and ``text_digest`` and is a written table. Rows without a
    doc_id are neither smaller nor larger than others; rows of the smallest doc_id of a text are
    no repeats, however many there are. A text that thousands of rows hold is one partial minimum
    per task, and meets its rows as a plain join, which is split where one key has many rows.
    """
    several = (
        counted.where("doc_id is not null")
        .groupBy(F.col("text_digest").alias("__digest"))
        .agg(F.min("doc_id").alias("__first"), F.max("doc_id").alias("__last"))
        .where("__first < __last")
        .select("__digest", "__first")
    )
    several = stage.put(several, "repeated")
    met = counted.join(small_or_not(several), F.col("text_digest") == F.col("__digest"), "left")
    repeated = F.coalesce(F.col("doc_id") > F.col("__first"), F.lit(False))
    return met.withColumn("repeated", repeated).drop("__digest", "__first")


def failures(letters: dict[str, Column | str]) -> Column:
    """The set of filters that a row fails: bit i for the i-th letter."""
    bits = F.lit(0)
    for i, condition in enumerate(letters.values()):
        holds = F.expr(condition) if isinstance(condition, str) else condition
        bits = bits + F.when(holds, 1 << i).otherwise(0)
    return bits


def _steps(letters: str) -> Column:
    """Every place of every order: the order, the step, its filter and those before it, as bits."""
    rows = []
    for order in permutations(letters):
        before = 0
        for step, letter in enumerate(order, 1):
            bit = 1 << letters.index(letter)
            rows.append(f"{''.join(order)} {step} {bit} {before}")
            before |= bit
    # One literal, cut by Spark: a struct for each would be a plan of thousands of nodes.
    cut = F.transform(F.split(F.lit(";".join(rows)), ";"), lambda row: F.split(row, " "))
    number = lambda row, i: F.get(row, F.lit(i)).cast("int")
    return F.transform(
        cut,
        lambda row: F.struct(
            F.get(row, F.lit(0)).alias("filter_order"), number(row, 1).alias("step"),
            number(row, 2).alias("bit"), number(row, 3).alias("before"),
        ),
    )


def interactions(failed: DataFrame, letters: str, lost: dict[str, Column]) -> DataFrame:
    """The audit of documents with ``part`` and ``failed`` (a set of filters as bits).

    One row per part, order of all letters and step, with counts of documents of the part:
    kept (after this step), removed (by it), redundant (fail it, but were removed before),
    unique_fails (fail it alone), one column for each of ``lost`` (removed, and the condition
    holds) and shapley: what its filter removes, summed over all orders. All parts have all
    rows; an empty table has none. The work after the count grows with the parts alone.
    """
    one = lambda condition: F.sum(F.when(condition, 1).otherwise(0))
    counts = failed.groupBy("part", "failed").agg(
        F.count(F.lit(1)).alias("n"), *[one(condition).alias(f"n_{name}") for name, condition in lost.items()]
    )
    placed = counts.select("*", F.explode(_steps(letters)).alias("at")).select(
        "part", "failed", "n", *[f"n_{name}" for name in lost], "at.*"
    )
    fails = F.col("failed").bitwiseAND(F.col("bit")) != 0
    there = F.col("failed").bitwiseAND(F.col("before")) == 0
    total = lambda condition, n: F.sum(F.when(condition, F.col(n)).otherwise(0)).cast("long")
    # Of a document that fails several, each is the first in an equal share of the orders.
    share = F.lit(factorial(len(letters))) / F.greatest(F.bit_count("failed"), F.lit(1))
    return placed.groupBy("part", "filter_order", "step", "bit").agg(
        total(there & ~fails, "n").alias("kept"),
        total(there & fails, "n").alias("removed"),
        total(~there & fails, "n").alias("redundant"),
        total(F.col("failed") == F.col("bit"), "n").alias("unique_fails"),
        *[total(there & fails, f"n_{name}").alias(name) for name in lost],
        F.sum(F.when(fails, F.col("n") * share.cast("long")).otherwise(0)).cast("long").alias("shapley"),
    ).drop("bit")


def audit_filters(docs: DataFrame, labels: DataFrame, letters: dict[str, Column | str] = FILTERS) -> DataFrame:
    """``interactions`` of ``letters`` over whole ``docs``, parted by ``lang``.

    ``good_lost`` and ``toxic_lost`` count removed documents that ``labels`` (doc_id, quality,
    toxic) gives quality 1 and toxic 1; a document without a label counts in neither, and of
    several labels of a doc_id one is enough. A null lang is the part of the empty string, a null
    text an empty one. Rows without a doc_id are documents of their own that repeat nothing and
    have no label; rows that share a doc_id all count. Other columns, of whatever name, are
    ignored. An empty table gives no rows.
    """
    stage = Stage(docs.sparkSession, "audit")
    plain = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        F.col("text"),
    )
    counted = stage.put(with_counts(plain, ["doc_id", "part"]), "counts")
    failed = with_repeated(counted, stage).select("doc_id", "part", failures(letters).alias("failed"))
    marks = (
        labels.where("doc_id is not null and (quality = 1 or toxic = 1)")
        .groupBy(F.col("doc_id").cast("long").alias("__doc"))
        .agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("bad"))
    )
    marks = stage.put(marks, "marks")
    marked = failed.join(small_or_not(marks), F.col("doc_id") == F.col("__doc"), "left")
    return interactions(marked, "".join(letters), {"good_lost": F.col("good"), "toxic_lost": F.col("bad")})
