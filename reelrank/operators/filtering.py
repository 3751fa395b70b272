"""Sparse-entity filtering (D1, D2, B13, C1) and the dropped-row report (D21)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keys_with_min_count(df: DataFrame, key: str, min_count: int) -> DataFrame:
    """Distinct ``key`` values with at least ``min_count`` rows (GROUP BY … HAVING)."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
            .filter(F.col("_n") >= F.lit(min_count)).select(key))


@dataclass
class SparseFilterResult:
    ratings: DataFrame
    valid_movies: DataFrame
    valid_users: DataFrame


def filter_sparse(df: DataFrame, min_movie_ratings: int, min_user_ratings: int,
                  movie_col: str = "movie_id", user_col: str = "customer_id") -> SparseFilterResult:
    """Movies first, then users recounted on the movie-filtered rows. One pass, no fixpoint.

    Both filters are semi joins against a one-column key table; the key tables are
    aggregates (one row per key), so AQE can broadcast them when small and falls back
    to a shuffle join otherwise.
    """
    movies = keys_with_min_count(df, movie_col, min_movie_ratings)
    after_movies = df.join(movies, movie_col, "left_semi")
    users = keys_with_min_count(after_movies, user_col, min_user_ratings)
    out = after_movies.join(users, user_col, "left_semi")
    return SparseFilterResult(out, movies, users)


def drop_report(df: DataFrame, min_movie_ratings: int, min_user_ratings: int,
                movie_col: str = "movie_id", user_col: str = "customer_id") -> DataFrame:
    """Rows kept and dropped at each filtering stage, as one aggregation + ``stack``."""
    movies = keys_with_min_count(df, movie_col, min_movie_ratings).withColumn("_m", F.lit(1))
    tagged = df.join(movies, movie_col, "left")
    users = (keys_with_min_count(tagged.filter(F.col("_m") == 1), user_col, min_user_ratings)
             .withColumn("_u", F.lit(1)))
    tagged = tagged.join(users, user_col, "left")
    c = tagged.agg(F.count(F.lit(1)).alias("n0"),
                   F.count("_m").alias("n1"),
                   F.count(F.when(F.col("_m") == 1, F.col("_u"))).alias("n2"))
    st = c.selectExpr("stack(3, 'parsed', 0, n0, 0L, "
                      "'movie_filter', 1, n1, n0 - n1, "
                      "'user_filter', 2, n2, n1 - n2) AS (stage, step, n_rows, n_dropped)")
    prev = F.col("n_rows") + F.col("n_dropped")
    return st.withColumn("share_dropped",
                         F.round(F.when(prev > 0, F.col("n_dropped") / prev), 6))
