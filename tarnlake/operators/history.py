"""Dimensions as they were: every row with the time it held, and joins as of a fact's time.

A history has a row for each state of a key, with ``valid_from`` and ``valid_to`` (null while
it holds); the states of a key follow each other without overlap. It grows by the changes of
each load, and lets facts be enriched again with the attributes they were loaded with.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnlake.operators.roles import Role

FROM, TO = "valid_from", "valid_to"
#: Days of a bucket of time that facts and states meet in.
BUCKET_DAYS = 30


def first_states(dim: DataFrame, at: datetime) -> DataFrame:
    """A history that begins with one load."""
    return dim.withColumns({FROM: F.lit(at).cast("timestamp"), TO: F.lit(None).cast("timestamp")})


def next_states(history: DataFrame, dim: DataFrame, key: str, at: datetime) -> DataFrame:
    """``history`` after a full load of the dimension at a time later than any in it.

    A key whose attributes changed gets a new state and its old one ends; one that is gone ends,
    and may come back later; a new one begins. Attributes are compared as a whole, nulls
    as equal. Rows of null keys play no role and are left out. ``dim`` holds a key once and has
    the columns of the history; keys meet in one join of the open states with the load.
    """
    names = [name for name in history.columns if name not in (FROM, TO)]
    time = F.lit(at).cast("timestamp")
    closed = history.where(F.col(TO).isNotNull())
    was = history.where(F.col(TO).isNull()).select(
        F.col(key).alias("__key"), F.struct(*names).alias("__was"), F.col(FROM).alias("__from")
    )
    now = dim.where(F.col(key).isNotNull()).select(F.col(key).alias("__now_key"), F.struct(*names).alias("__now"))
    met = was.join(now, F.col("__key") == F.col("__now_key"), "full")
    same = F.col("__was").eqNullSafe(F.col("__now"))
    empty = F.lit(None).cast("timestamp")

    def state(row: Column, begins: Column, ends: Column) -> Column:
        return F.struct(row.alias("row"), begins.alias(FROM), ends.alias(TO))

    old = state(F.col("__was"), F.col("__from"), F.when(same, empty).otherwise(time))
    new = state(F.col("__now"), time, empty)
    states = F.filter(
        F.array(F.when(F.col("__was").isNotNull(), old), F.when(F.col("__now").isNotNull() & ~same, new)),
        lambda s: s.isNotNull(),
    )
    told = met.select(F.explode(states).alias("s")).select("s.row.*", f"s.{FROM}", f"s.{TO}")
    return closed.unionByName(told)


def _bucket(time: Column, days: int) -> Column:
    return F.floor(F.unix_micros(time.cast("timestamp")) / F.lit(days * 86_400_000_000))


def join_as_of(
    facts: DataFrame, history: DataFrame, role: Role, time: str, days: int = BUCKET_DAYS
) -> DataFrame:
    """The role's attributes of each fact as they were at its ``time``.

    A state holds from ``valid_from`` on and no longer at ``valid_to``. Facts and states meet by
    key and bucket of time, so a key with many states and many facts is parted by time; a state
    is repeated for the buckets that it spans within those of the facts, whose range is one
    aggregate. Both sides are plain joins, which adaptive execution splits where a key is hot.
    """
    ends = facts.agg(F.min(_bucket(F.col(time), days)).alias("a"), F.max(_bucket(F.col(time), days)).alias("b")).first()
    first, last = (ends["a"] or 0, ends["b"] or 0)
    begins = F.greatest(_bucket(F.col(FROM), days), F.lit(first))
    stops = F.least(F.coalesce(_bucket(F.col(TO), days), F.lit(last)), F.lit(last))
    states = history.where(begins <= stops).select(
        F.col(role.dim_key).alias("__key"),
        F.col(FROM).alias("__from"),
        F.col(TO).alias("__to"),
        *[F.col(name).alias(output) for name, output in role.attrs.items()],
        F.explode(F.sequence(begins, stops)).alias("__bucket"),
    )
    fact = F.col(time).cast("timestamp")
    holds = (fact >= F.col("__from")) & (F.col("__to").isNull() | (fact < F.col("__to")))
    met = (F.col(role.fact_key) == F.col("__key")) & (_bucket(F.col(time), days) == F.col("__bucket")) & holds
    return facts.join(states, met, role.how).drop("__key", "__from", "__to", "__bucket")


def enrich_as_of(
    facts: DataFrame,
    histories: Mapping[str, DataFrame],
    roles: Sequence[Role],
    time: str,
    columns: Sequence[str] | None = None,
    days: int = BUCKET_DAYS,
) -> DataFrame:
    """``enrich`` with each dimension as it was at the fact's ``time``; inner roles first."""
    wanted = None if columns is None else set(columns)
    for role in sorted(roles, key=lambda role: role.how != "inner"):
        if role.how == "inner" or wanted is None or wanted & set(role.attrs.values()):
            facts = join_as_of(facts, histories[role.dim], role, time, days)
    return facts if columns is None else facts.select(*columns)


def overlapping(history: DataFrame, key: str) -> DataFrame:
    """Pairs of consecutive states of a key that hold at the same time; none in a sound history."""
    order = Window.partitionBy(key).orderBy(FROM)
    ends = history.withColumn("__next", F.lead(FROM).over(order))
    return ends.where(F.col("__next").isNotNull() & (F.col(TO).isNull() | (F.col(TO) > F.col("__next")))).drop("__next")
