"""Joins of a fact to a unique-key side when a few keys hold much of the fact.

Adaptive execution splits a skewed sort-merge join whose two inputs are plain shuffles,
as those of ``enrich`` are. It leaves alone a join to an aggregate on the same key, which
is what ``join_counted`` is for, and does nothing in a session that runs without it,
where ``salted_join`` can stand in.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fact rows that one salt of a hot key should hold.
ROWS_PER_SALT = 1_000_000
#: Least shares: they bound the keys that reach the driver, or that are broadcast.
LEAST_HOT_SHARE = 1e-3
LEAST_BROADCAST_SHARE = 1e-6


def _checked(share: float, least: float) -> float:
    if not least <= share <= 1:
        raise ValueError(f"share must be from {least:g} to 1, not {share!r}")
    return share


@dataclass(frozen=True)
class HotKeys:
    """Keys to split, each over how many salts, and which fact columns decide the salt.

    ``null_salts`` is for rows without a key. ``spread_by`` must vary within a hot key (the
    fact's own key, say). It is hashed, so a recomputed row goes where it went before.
    """

    salts: Mapping[object, int]
    spread_by: tuple[str, ...]
    null_salts: int = 1

    @property
    def keys(self) -> tuple:
        return tuple(self.salts)


def find_hot_keys(
    facts: DataFrame,
    key: str,
    spread_by: Sequence[str],
    share: float = 0.01,
    rows_per_salt: int = ROWS_PER_SALT,
) -> HotKeys:
    """Keys holding at least ``share`` of the rows with a key, with salts for their rows.

    One narrow pass, pre-aggregated per key. At most ``1 / share`` keys reach the driver,
    and ``share`` is at least ``LEAST_HOT_SHARE``. A key has as many salts as it has times
    ``rows_per_salt`` rows, so a part of it stays as large however the facts grow.
    """
    _checked(share, LEAST_HOT_SHARE)
    counts = facts.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("rows"))
    total = F.sum(F.when(F.col("key").isNotNull(), F.col("rows")))
    totals = counts.agg(total.alias("keyed"), F.sum(F.when(F.col("key").isNull(), F.col("rows"))).alias("null")).first()
    least = max(1, math.ceil((totals["keyed"] or 0) * share))
    hot = counts.where(F.col("key").isNotNull() & (F.col("rows") >= least)).collect()
    salts = {row["key"]: math.ceil(row["rows"] / rows_per_salt) for row in hot}
    return HotKeys(salts, tuple(spread_by), max(1, math.ceil((totals["null"] or 0) / rows_per_salt)))


def salted_join(
    facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, how: str, hot: HotKeys
) -> DataFrame:
    """``facts`` joined to ``dim`` (inner or left), hot and null keys spread over their salts.

    Only the hot rows of ``dim`` are copied, once per salt; every fact row meets exactly
    one copy, so the rows are those of the plain join. Null keys match nothing and are
    spread for the sake of a left join, which keeps them. Salts only help where both sides
    are shuffled, so that is what is asked for. ``dim_key`` is dropped.
    """
    salts_of = lambda column: F.element_at(
        F.create_map(*[F.lit(x) for pair in hot.salts.items() for x in pair]), column
    )
    fact_salts = F.when(F.col(fact_key).isNull(), F.lit(hot.null_salts))
    copies = F.lit(1)
    if hot.salts:
        fact_salts = fact_salts.otherwise(F.coalesce(salts_of(F.col(fact_key)), F.lit(1)))
        copies = F.coalesce(salts_of(F.col(dim_key)), F.lit(1))
    else:
        fact_salts = fact_salts.otherwise(F.lit(1))
    spread = F.pmod(F.xxhash64(*hot.spread_by), fact_salts).cast("int")
    left = facts.withColumn("__fact_salt", spread)
    right = dim.withColumn("__dim_salt", F.explode(F.sequence(F.lit(0), copies - 1)))
    same = (F.col(fact_key) == F.col(dim_key)) & (F.col("__fact_salt") == F.col("__dim_salt"))
    return left.join(right.hint("merge"), same, how).drop("__fact_salt", "__dim_salt", dim_key)


def join_counted(
    facts: DataFrame,
    counted: DataFrame,
    fact_key: str,
    key: str,
    rows: str,
    share: float = 1e-5,
    keep: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """``facts`` inner-joined to ``counted``, which has one row per key with its fact count.

    Keys with at least ``share`` of all counted facts are at most ``1 / share``, so they
    are broadcast and their facts are never shuffled; ``share`` is at least
    ``LEAST_BROADCAST_SHARE``. All other facts are shuffled by key, and no such key holds
    more than ``share`` of them. ``keep`` writes ``counted`` and reads it back; with it the
    facts are counted once, without it once for each use.
    """
    _checked(share, LEAST_BROADCAST_SHARE)
    counted = counted if keep is None else keep(counted)
    least = counted.agg(F.sum(rows) * F.lit(share)).scalar()
    hot = F.broadcast(counted.where(F.col(rows) >= least))
    cold = counted.where(F.col(rows) < least)
    same = F.col(fact_key) == F.col(key)
    rest = facts.join(hot.select(key), same, "left_anti")
    return facts.join(hot, same).unionByName(rest.join(cold, same))
