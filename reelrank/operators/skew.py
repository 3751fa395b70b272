"""Joins of rating rows with per-key tables that survive one key holding most rows.

A key with more than ``max_rows_per_key`` rows on the big side is "hot" and gets
``ceil(n / max_rows_per_key)`` salts: its big-side rows are spread over the salts by a
hash of the row, and its (single) small-side row is replicated once per salt. Cold keys
keep salt 0, so nothing is replicated for them. The result equals the plain join exactly,
whichever keys are treated as hot; only the task sizes change.

The hot-key table is broadcast only after counting it: with more than ``max_hot_keys`` hot
keys the bound on the rows per key is doubled until the hottest keys fit, so the hottest
keys are always salted.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelrank.session import cut_lineage

DEFAULT_MAX_ROWS_PER_KEY = 2_000_000
DEFAULT_MAX_HOT_KEYS = 1_000_000
LOOKUP_ROW_BYTES = 48           # a key and a number in the hash table of a broadcast join
LOOKUP_BYTES = 64 << 20         # of one broadcast slice, which takes the driver several times that
MAX_LOOKUP_SLICES = 32          # beyond so many the big side is shuffled


def hot_keys(counts: DataFrame, key: str, count_col: str, max_rows_per_key: int) -> DataFrame:
    return (counts.filter(F.col(count_col) > F.lit(max_rows_per_key))
            .select(key, F.ceil(F.col(count_col) / F.lit(max_rows_per_key)).cast("int")
                    .alias("_salts")))


def skew_join(big: DataFrame, small: DataFrame, key: str, how: str = "left",
              max_rows_per_key: int = DEFAULT_MAX_ROWS_PER_KEY,
              counts: DataFrame | None = None, count_col: str = "n",
              max_hot_keys: int = DEFAULT_MAX_HOT_KEYS) -> DataFrame:
    """``big.join(small, key, how)`` for ``small`` unique per ``key`` (inner or left).

    ``counts`` (key, count_col) may be supplied when an upper bound of the rows per key
    is already known (e.g. from an aggregate computed anyway); otherwise it is counted.
    """
    if how not in ("left", "inner"):
        raise ValueError("skew_join supports inner and left joins")
    big, small, on = spread(big, small, key, max_rows_per_key, counts, count_col, max_hot_keys)
    return big.join(small, on, how).drop("_salt")


def spread(big: DataFrame, small: DataFrame, key: str, max_rows_per_key: int,
           counts: DataFrame | None = None, count_col: str = "n",
           max_hot_keys: int = DEFAULT_MAX_HOT_KEYS) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides and the columns on which they meet: ``key``, and a salt if any key is hot."""
    if counts is None:
        counts = big.groupBy(key).agg(F.count(F.lit(1)).alias(count_col))
    hot = hot_keys(counts, key, count_col, max_rows_per_key)
    n_hot = hot.count()
    while n_hot > max_hot_keys:
        max_rows_per_key *= 2
        hot = hot_keys(counts, key, count_col, max_rows_per_key)
        n_hot = hot.count()
    if n_hot == 0:
        return big, small, [key]
    return *salted(big, small, key, F.broadcast(hot)), [key, "_salt"]  # ≤ max_hot_keys rows


def salted(big: DataFrame, small: DataFrame, key: str, hot: DataFrame):
    """Both sides with a ``_salt`` column: rows of a hot key spread over its salts, its row of
    the small side once for each salt."""
    row_hash = F.xxhash64(*[F.col(c) for c in big.columns])
    b = (big.join(hot, key, "left")
         .withColumn("_salt", F.when(F.col("_salts").isNull(), F.lit(0))
                     .otherwise(F.pmod(row_hash, F.col("_salts")).cast("int")))
         .drop("_salts"))
    s = (small.join(hot, key, "left")
         .withColumn("_salt", F.explode(F.when(F.col("_salts").isNull(), F.array(F.lit(0)))
                                        .otherwise(F.sequence(F.lit(0), F.col("_salts") - 1))))
         .drop("_salts"))
    return b, s


def lookups(big: DataFrame, small: DataFrame, key: str, how: str = "left",
            slice_bytes: int | None = None) -> list[DataFrame]:
    """``big.join(small, key, how)`` (inner or left) in parts, without a shuffle of ``big``.

    ``small`` (key and a number, unique per key, written) is counted and broadcast, in slices by
    the hash of the key if it is larger than one; each slice meets its own rows of ``big``. Run one
    part after another and the driver holds one slice at a time. Beyond ``MAX_LOOKUP_SLICES`` both
    sides are shuffled.
    """
    if how not in ("left", "inner"):
        raise ValueError("lookups support inner and left joins")
    slices = -(-small.count() * LOOKUP_ROW_BYTES // (slice_bytes or LOOKUP_BYTES))
    if slices > MAX_LOOKUP_SLICES:
        return [big.join(small, key, how)]
    if slices <= 1:
        return [big.join(F.broadcast(small), key, how)]
    own = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(slices))
    return [big.where(own == i).join(F.broadcast(small.where(own == i)), key, how)
            for i in range(slices)]


def lookup_join(big: DataFrame, small: DataFrame, key: str, how: str = "left",
                slice_bytes: int | None = None) -> DataFrame:
    """The parts of ``lookups`` as one table: several are written one after another."""
    parts = lookups(big, small, key, how, slice_bytes)
    if len(parts) > 1:
        parts = [cut_lineage(part, "looked-up") for part in parts]
    return reduce(DataFrame.unionByName, parts)


def lookup_means(big: DataFrame, small: DataFrame, key: str, by: str, value: F.Column, name: str,
                 slice_bytes: int | None = None) -> DataFrame:
    """(by, name): the mean of ``value`` over the rows of ``big`` joined (left) with ``small``.

    Of a slice its sums and counts are written and not its rows.
    """
    parts = lookups(big, small, key, slice_bytes=slice_bytes)
    if len(parts) == 1:
        return parts[0].groupBy(by).agg(F.avg(value).alias(name))
    sums = reduce(DataFrame.unionByName, [
        cut_lineage(part.groupBy(by).agg(F.sum(value).alias("_s"), F.count(value).alias("_c")),
                    "lookup-sums") for part in parts])
    return sums.groupBy(by).agg((F.sum("_s") / F.sum("_c")).alias(name))
