"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source is to be taken the same expected number of times, its source's
target over its size. The whole part is taken outright. The fractional parts of a source
are rounded together: two documents meet, one hands probability to the other, weighted by
their words, until one of them is at 0 or 1, and the other goes on to meet the next
(Deville and Tillé's pivotal method, with the word mass kept instead of the count, as in
dependent rounding of weighted sums). Expected copies stay exact, and the words taken from
a source differ from its target by less than one document.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarnlake.llm.hashing import uniform_of
from tarnlake.llm.staging import Stage, small_or_not
from tarnlake.llm.words import WORD

#: Documents, of all sources, that share a node of the first level on average.
ROWS_PER_NODE = 256
#: Residuals that meet in one node of a later level.
FAN_IN = 64


def text_size(text: str = "text") -> F.Column:
    """Number of words; 0 for a null text."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, weights: tuple[float, ...], share: float, most: float
) -> DataFrame:
    """source, source_size, target: one row per source.

    Sources in code point order, null last, take the weights in turn. The targets add up
    to ``share`` of all sizes (no more than ``most`` of them can be reached); none is above
    ``most`` times its source's size, and what would be is given to the others by weight.
    That is filling to one level: target = min(most * size, level * weight).
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - F.lit(1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn % len(weights) + 1).cast("int"))
    full = F.col("source_size") * F.lit(float(most))
    ranked = per_source.withColumn("weight", weight).withColumn("full", full)
    # A source is filled before another if it reaches its bound at a lower level.
    by_level = Window.orderBy(F.col("full") / F.col("weight"), F.col("source").asc_nulls_last())
    earlier = by_level.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    spent = F.coalesce(F.sum("full").over(earlier), F.lit(0.0))
    left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0))
    wanted = F.least(F.lit(float(share)), F.lit(float(most))) * F.sum("source_size").over(everything)
    # The level that results if the sources before this one are filled and it is not; the
    # first source that does not reach its bound there gives the level of all.
    levelled = ranked.withColumn("turn", turn).withColumn("level_if", (wanted - spent) / left)
    bound = F.col("full") / F.col("weight")
    holds = F.when(F.col("level_if") <= bound, F.struct(bound.alias("bound"), "turn", "level_if"))
    level = F.min(holds).over(everything)["level_if"]
    target = F.coalesce(F.least(F.col("full"), level * F.col("weight")), F.col("full"))
    return levelled.select("source", "source_size", target.alias("target"))


def _round(frames: Iterator[pd.DataFrame], seed: int) -> Iterator[pd.DataFrame]:
    """Meetings of the rows of each (source, node), which come sorted; one row is held.

    A row leaves with p 0 or 1; the last of a group may leave as a residual between them.
    """
    held: tuple | None = None
    held_group: tuple | None = None
    for frame in frames:
        if frame.empty:
            continue
        settled: list[tuple] = []
        names = list(frame.columns)
        at = {name: i for i, name in enumerate(names)}
        i_source, i_node, i_doc, i_tie, i_size, i_p = (
            at[name] for name in ("source_no", "node", "doc_id", "tie", "size", "p")
        )
        for row in frame.itertuples(index=False, name=None):
            group = (row[i_source], row[i_node])
            if group != held_group:
                if held is not None:
                    settled.append(held)
                held, held_group = row, group
                continue
            a, b = list(held), list(row)
            p, q, size_a, size_b = a[i_p], b[i_p], a[i_size], b[i_size]
            up = min((1.0 - p) * size_a, q * size_b)  # words that can move from b to a
            down = min(p * size_a, (1.0 - q) * size_b)
            moves_up = up + down > 0 and uniform_of(seed, a[i_tie], b[i_tie], int(size_a), int(size_b)) * (up + down) < down
            if moves_up:
                full_a, empty_b = (1.0 - p) * size_a <= up, q * size_b <= up
                a[i_p] = 1.0 if full_a else p + up / size_a
                b[i_p] = 0.0 if empty_b else q - up / size_b
            else:
                empty_a, full_b = p * size_a <= down, (1.0 - q) * size_b <= down
                a[i_p] = 0.0 if empty_a else p - down / size_a
                b[i_p] = 1.0 if full_b else q + down / size_b
            if 0.0 < a[i_p] < 1.0:
                settled.append(tuple(b))
                held = tuple(a)
            else:
                settled.append(tuple(a))
                if 0.0 < b[i_p] < 1.0:
                    held = tuple(b)
                else:
                    settled.append(tuple(b))
                    held, held_group = None, None
        if settled:
            yield pd.DataFrame(settled, columns=names)
    if held is not None:
        yield pd.DataFrame([held], columns=names)


def _level(rows: DataFrame, seed: int) -> DataFrame:
    # Large documents meet first, so that what is left over at the end is small.
    order = ["source_no", "node", F.col("size").desc(), "tie", "doc_id"]
    dealt = rows.repartition("source_no", "node").sortWithinPartitions(*order)
    return dealt.mapInPandas(lambda frames: _round(frames, seed), dealt.schema)


def mix_sources(
    docs: DataFrame,
    weights: tuple[float, ...] = (5.0, 2.0, 1.0),
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 20,
) -> DataFrame:
    """How often the mix takes each document.

    Returns a row per row of ``docs`` (``doc_id``, ``source``, ``text``; others are left
    out): doc_id, source, size in words, source_size, target of the source, copies and
    taken = size * copies. Null and empty texts have size 0 and are taken 0 times. Null is
    a source of its own, the last. Repeated rows are documents of their own. An empty
    table gives an empty result. Reruns agree: draws depend on keys and seed alone.

    A source of any share of the rows is dealt over nodes of at most about ``ROWS_PER_NODE``
    of its documents; each leaves at most one residual, and ``FAN_IN`` of these meet in a node of
    the next level. A task streams its rows and holds one.
    """
    spark = docs.sparkSession
    stage = Stage(spark, "mix")
    sizes = stage.put(docs.select("doc_id", "source", text_size().alias("size")), "sizes")
    numbered = source_targets(sizes, weights, share, most).withColumn(
        "source_no", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    )
    targets = stage.put(numbered, "targets")
    total = sizes.count()
    nodes = max(1, ceil(total / ROWS_PER_NODE))
    expected = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(most))))
    wanted = (
        sizes.alias("d")
        .join(targets.alias("t"), F.col("d.source").eqNullSafe(F.col("t.source")))
        .select("doc_id", "d.source", "source_no", "size", "source_size", "target", expected.alias("copies"))
        .withColumn("copies", F.when(F.col("size") > 0, F.col("copies")).otherwise(F.lit(0.0)))
    )
    tie = F.xxhash64(F.lit(seed), "doc_id")
    split = wanted.withColumn("whole", F.floor("copies")).withColumn("p", F.col("copies") - F.col("whole"))
    open_rows = split.where((F.col("p") > 0) & (F.col("p") < 1)).select(
        "source_no", F.pmod(tie, F.lit(nodes)).alias("node"), "doc_id", tie.alias("tie"), "size", "whole", "p"
    )
    closed = [split.where(~((F.col("p") > 0) & (F.col("p") < 1))).select("source_no", "doc_id", "size", "whole", "p")]
    is_open = (F.col("p") > 0) & (F.col("p") < 1)
    level = 0
    while True:
        rounded = stage.put(_level(open_rows, seed + level), f"level-{level}")
        last = nodes == 1
        columns = ["source_no", "doc_id", "size", "whole"]
        if last:
            coin = F.when(is_open, _coin(seed) < F.col("p")).otherwise(F.col("p") >= 1)
            closed.append(rounded.select(*columns, coin.cast("double").alias("p")))
            break
        closed.append(rounded.where(~is_open).select(*columns, "p"))
        nodes = ceil(nodes / FAN_IN)
        level += 1
        open_rows = rounded.where(is_open).withColumn("node", F.floor(F.col("node") / FAN_IN))
    result = closed[0]
    for part in closed[1:]:
        result = result.unionByName(part)
    copies = (F.col("whole") + F.col("p")).cast("long")
    return result.join(targets, "source_no").select(
        "doc_id", "source", "size", "source_size", "target", copies.alias("copies"),
        (F.col("size") * copies).alias("taken"),
    )


def _coin(seed: int) -> F.Column:
    """A number from 0 to 1 for the one document that a source has left over."""
    return (F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id", "source_no"), F.lit(1 << 40)) + F.lit(0.5)) / F.lit(float(1 << 40))


def mixed(docs: DataFrame, **how) -> DataFrame:
    """The documents of the mix: those taken twice stand there twice.

    ``doc_id`` must be a key here: rows that share one also share the copies drawn for them.
    """
    copies = (
        mix_sources(docs, **how)
        .groupBy("doc_id")
        .agg(F.max("copies").alias("__copies"))
        .where(F.col("__copies") > 0)
        .withColumnRenamed("doc_id", "__doc")
    )
    copies = small_or_not(Stage(docs.sparkSession, "mixed").put(copies, "copies"))
    kept = docs.join(copies, F.col("doc_id").eqNullSafe(F.col("__doc"))).drop("__doc")
    return kept.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), "__copies"))).select(*docs.columns)
