"""Temporal hold-out (F6, H3) and the cold-user flag (H4, C3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelrank.operators.ordstat import value_at_fraction
from reelrank.operators.skew import DEFAULT_MAX_ROWS_PER_KEY, skew_join
from reelrank.session import cut_lineage


def temporal_cut(df: DataFrame, test_size: float, date_col: str = "date"):
    """Global cut date: value at index int(n*(1-test_size)) of the sorted dates."""
    if not 0.0 < test_size < 1.0:
        raise ValueError(f"test_size must be in (0, 1), got {test_size}")
    cut = value_at_fraction(df, date_col, 1 - test_size)
    if cut is None:
        raise ValueError("cannot split an empty table")
    return cut


def temporal_split(df: DataFrame, test_size: float, cut=None, date_col: str = "date"):
    """(train, test, cut): train ``date < cut``, test ``date >= cut`` (all ties go to test)."""
    if cut is None:
        cut = temporal_cut(df, test_size, date_col)
    train = df.filter(F.col(date_col) < F.lit(cut))
    test = df.filter(F.col(date_col) >= F.lit(cut))
    return train, test, cut


def user_stats(full: DataFrame, user_col: str = "customer_id",
               date_col: str = "date") -> DataFrame:
    """Per user: first date and row count, from one partial aggregation, written once to
    the shared checkpoint folder (read by the cold flag and by the scoring join)."""
    return cut_lineage(full.groupBy(user_col).agg(F.min(date_col).alias("_first"),
                                                  F.count(F.lit(1)).alias("_n")), "user-stats")


def flag_cold_users(test: DataFrame, full: DataFrame, cut, user_col: str = "customer_id",
                    date_col: str = "date",
                    max_rows_per_key: int = DEFAULT_MAX_ROWS_PER_KEY,
                    stats: DataFrame | None = None) -> DataFrame:
    """``is_cold_user``: the user has no row before the cut.

    ``min(date) >= cut`` per user is equivalent to "absent from train" and needs one
    partial aggregation instead of a distinct + anti join. The same aggregation counts the
    user's rows, which bounds the user's test rows, so the join is skew-safe for free.
    """
    stats = user_stats(full, user_col, date_col) if stats is None else stats
    joined = skew_join(test, stats.select(user_col, "_first"), user_col, "left",
                       max_rows_per_key, counts=stats.select(user_col, "_n"), count_col="_n")
    return joined.withColumn("is_cold_user", F.col("_first") >= F.lit(cut)).drop("_first")
