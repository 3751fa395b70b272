"""Sharding by jump consistent hashing: a key and the number of shards decide the shard.

No ring table is kept: the shard is the last jump of a pseudo-random walk that the key
seeds, so one more shard takes about one row in n + 1, all into itself, and no row moves
between the older shards.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelrank.llm.common import without
from reelrank.llm.ranks import rank_within
from reelrank.session import cut_lineage

# Multiplier of the walk's generator, and the seed of rows without a key.
WALK = 2862933555777941757
NULL_SEED = -1


def jump(seeds: np.ndarray, shards: int) -> np.ndarray:
    """The shard (0 to ``shards`` - 1) of each 64-bit seed."""
    state = seeds.astype(np.uint64)
    shard = np.zeros(len(state), np.int64)
    live = np.arange(len(state))
    while len(live):
        with np.errstate(over="ignore"):
            state[live] = state[live] * np.uint64(WALK) + np.uint64(1)
        step = float(1 << 31) / ((state[live] >> np.uint64(33)).astype(np.float64) + 1.0)
        ahead = ((shard[live] + 1) * step).astype(np.int64)
        on = ahead < shards
        live = live[on]
        shard[live] = ahead[on]
    return shard


def seed_of(df: DataFrame, key: str) -> Column:
    """The 64-bit seed of a key: integers are their own, other types their XXH64."""
    col = F.col(f"`{key}`")
    whole = isinstance(df.schema[key].dataType,
                       (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    return F.coalesce(col.cast("long"), F.lit(NULL_SEED)) if whole else F.when(
        col.isNull(), F.lit(NULL_SEED)).otherwise(F.xxhash64(col))


def _shard(seed: Column, shards: int) -> Column:
    def of(seeds: pd.Series) -> pd.Series:
        return pd.Series(jump(seeds.to_numpy(), shards).astype(np.int32))

    return F.pandas_udf(of, "int")(seed)


def shard_rows(rows: DataFrame, shards: int = 16, key: str = "doc_id") -> DataFrame:
    """All rows with ``shard``, ``slot`` and ``grown_shard``.

    ``shard`` follows from the key and ``shards`` alone; ``grown_shard`` is the shard with one
    shard more: the same one, or the new one. ``slot`` counts the rows of a shard from 0 without
    gaps, by seed; rows of one key in the order in which the table is read. It is counted over
    ranges of (shard, seed, row number), so no shard is gathered in one task, however large, and
    a key that holds a third of the rows is split as well.

    Rows without a key share a seed, and so a shard; repeated keys share their shard, with a
    slot each. An empty table gives an empty result. Columns of ``rows`` that are called like
    an output are replaced; all others are kept whatever they are called. What is passed is
    what is dealt: leave texts out where only the placement is wanted.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    work = rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"),
                       seed_of(rows, key).alias("seed"))
    placed = cut_lineage(work.select("row", "seed", _shard(F.col("seed"), shards).alias("shard"),
                                     _shard(F.col("seed"), shards + 1).alias("grown")), "shards")
    ranked = rank_within(placed, "shard", [F.col("seed")], "shard-slots")
    kept = without(ranked.select("row.*"), "shard", "slot", "grown_shard").columns
    return ranked.select(*[F.col(f"row.`{c}`") for c in kept], "shard",
                         F.col("rank").alias("slot"), F.col("grown").alias("grown_shard"))


def write_shards(rows: DataFrame, path: str, shards: int = 16, key: str = "doc_id") -> DataFrame:
    """Writes all rows, one folder per shard, and returns the table read back.

    The rows arrive in ranges of (shard, slot), so each task writes to few folders and a large
    shard gets as many files as ranges.
    """
    shard_rows(rows, shards, key).write.mode("overwrite").partitionBy("shard").parquet(path)
    return rows.sparkSession.read.parquet(path)
