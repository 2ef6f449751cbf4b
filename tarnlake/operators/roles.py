"""Enrichment of a fact frame by the roles its dimensions play."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnlake.operators.skew import HotKeys, salted_join


@dataclass(frozen=True)
class Role:
    """One dimension joined to one key of the fact.

    ``attrs`` maps dimension columns to output columns. ``how="inner"`` drops facts
    whose key is null or unknown; ``how="left"`` keeps them with null attributes.
    """

    dim: str
    fact_key: str
    dim_key: str
    attrs: Mapping[str, str]
    how: str = "inner"

    @classmethod
    def prefixed(
        cls, dim: str, fact_key: str, dim_key: str, prefix: str, attrs: Sequence[str], how: str = "inner"
    ) -> Role:
        """Every attribute renamed ``prefix_attribute``."""
        return cls(dim, fact_key, dim_key, {name: f"{prefix}_{name}" for name in attrs}, how)


def _needed(roles: Sequence[Role], columns: Sequence[str] | None) -> list[Role]:
    # A left role neither drops nor repeats facts, so without a wanted column it is idle.
    if columns is None:
        return list(roles)
    wanted = set(columns)
    return [role for role in roles if role.how == "inner" or wanted & set(role.attrs.values())]


def _ordered(roles: Sequence[Role]) -> list[Role]:
    # Dimension keys are unique, so the joins commute. Inner roles go first: they only
    # shrink the fact, and a left role before them would carry rows they drop.
    return sorted(roles, key=lambda role: role.how != "inner")


def enrich(
    facts: DataFrame,
    dims: Mapping[str, DataFrame],
    roles: Sequence[Role],
    columns: Sequence[str] | None = None,
    hot: Mapping[str, HotKeys] | None = None,
) -> DataFrame:
    """Join the roles to ``facts`` (batch or streaming) and select ``columns``.

    Left roles none of whose attributes are among ``columns`` are left out.
    Dimension keys must be unique, else facts multiply: ``require_unique`` checks that. No join is forced: Spark broadcasts a dimension whose size is under
    ``spark.sql.autoBroadcastJoinThreshold`` and shuffles a larger one, where adaptive
    execution splits skewed keys. ``hot`` salts the roles of the given fact keys instead.

    Give large dimensions first within the inner roles: their shuffles then move rows
    that do not yet carry the attributes of the small, broadcast ones.
    """
    df = facts
    for number, role in enumerate(_ordered(_needed(roles, columns))):
        key = f"__dim_key_{number}"
        dim = dims[role.dim].select(
            F.col(role.dim_key).alias(key),
            *[F.col(name).alias(output) for name, output in role.attrs.items()],
        )
        if hot and role.fact_key in hot:
            df = salted_join(df, dim, role.fact_key, key, role.how, hot[role.fact_key])
        else:
            df = df.join(dim, F.col(role.fact_key) == F.col(key), role.how).drop(key)
    return df if columns is None else df.select(*columns)


def require_unique(dims: Mapping[str, DataFrame], keys: Mapping[str, str]) -> None:
    """Raise if a dimension holds a key twice; one aggregate per dimension."""
    for name, dim in dims.items():
        key = keys[name]
        repeated = dim.where(F.col(key).isNotNull()).groupBy(key).count().where("count > 1").select(key).head(3)
        if repeated:
            raise ValueError(f"{name} holds {key} {', '.join(str(row[0]) for row in repeated)} more than once")
