"""Sharding by jump consistent hashing (Lamping and Veach, 2014)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnlake.llm.hashing import mix64
from tarnlake.llm.numbering import cells_for, number_within


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each 64-bit key.

    Each key jumps from shard to shard, driven by its own random sequence, until the next
    jump would leave the shards there are. There is no table of shards; going from n to
    n + 1 shards moves 1/(n + 1) of the keys, all of them to the new shard.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    state = mix64(keys)
    shard = np.zeros(len(state), np.int64)
    moving = np.arange(len(state))
    with np.errstate(over="ignore"):
        while len(moving):
            state[moving] = state[moving] * np.uint64(2862933555777941757) + np.uint64(1)
            draw = (state[moving] >> np.uint64(33)).astype(np.float64) + 1.0
            jump = ((shard[moving] + 1) * (2147483648.0 / draw)).astype(np.int64)
            inside = jump < shards
            moving = moving[inside]
            shard[moving] = jump[inside]
    return shard


def shard_of(key: Column, shards: int) -> Column:
    """Shard of a long key; a null key goes with key 0."""

    @F.pandas_udf("int")
    def jump(keys: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(keys.to_numpy(np.int64).view(np.uint64), shards).astype(np.int32))

    return jump(F.coalesce(key.cast("long"), F.lit(0).cast("long")))


def with_shards(docs: DataFrame, shards: int, key: str = "doc_id", out: str = "shard") -> DataFrame:
    """``docs`` with their shard.

    The key alone decides: equal keys share a shard, texts do not matter, and a table that
    grows keeps its rows where they are. Null keys share one shard; an empty table stays
    empty; all other columns stay as they are. A column called ``out`` is replaced.
    """
    return docs.withColumn(out, shard_of(F.col(key), shards))


def with_slots(sharded: DataFrame, rows: int, order: list[str], shard: str = "shard", out: str = "slot") -> DataFrame:
    """Number the rows of each shard from 0, without a gap; ``rows`` sizes the cells."""
    return number_within(sharded, shard, order, out, cells_for(rows))


def write_shards(sharded: DataFrame, path: str, cells: int = 1, shard: str = "shard") -> None:
    """Write one folder per shard, each in ``cells`` files by a hash of the row's key."""
    part = F.pmod(F.xxhash64("doc_id"), F.lit(cells)).cast("int")
    (
        sharded.withColumn("__part", part)
        .repartition(F.col(shard), F.col("__part"))
        .drop("__part")
        .write.partitionBy(shard)
        .parquet(path)
    )
