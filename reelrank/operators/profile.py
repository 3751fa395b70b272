"""Ratings-table profile (D3–D12, E5, F4, F5, F8, D19): each a single aggregation plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelrank.operators.ordstat import interpolated_quantiles, value_histogram

RATING_COLS = ("customer_id", "movie_id", "rating", "date")


def overview(df: DataFrame, approx: bool = False) -> DataFrame:
    nulls = [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in RATING_COLS]
    rest = df.agg(F.min("date").alias("min_date"), F.max("date").alias("max_date"),
                  F.min("rating").alias("min_rating"), F.max("rating").alias("max_rating"), *nulls)
    out = sizes(df, approx).crossJoin(rest)                   # one row with one row
    return out.select("n_ratings", "n_users", "n_movies", *rest.columns)


def sizes(df: DataFrame, approx: bool = False) -> DataFrame:
    """One row: n_ratings, n_users, n_movies.

    Exact counts come from one table per key (rows combine in the map tasks), so no row is
    expanded per distinct count; ``approx`` uses HyperLogLog sketches in a single pass.
    """
    if approx:
        return df.agg(F.count(F.lit(1)).alias("n_ratings"),
                      F.approx_count_distinct("customer_id", 0.01).alias("n_users"),
                      F.approx_count_distinct("movie_id", 0.01).alias("n_movies"))
    users = counts_per(df, "customer_id").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_ratings"),
                                              F.count("customer_id").alias("n_users"))
    movies = counts_per(df, "movie_id").agg(F.count("movie_id").alias("n_movies"))
    return users.crossJoin(movies)                            # one row with one row


def rating_distribution(df: DataFrame) -> DataFrame:
    """Share of each rating value and the cumulative share (window over ≤ a few rows:
    one row per distinct rating value, bounded by the rating scale)."""
    counts = df.groupBy("rating").agg(F.count(F.lit(1)).alias("n"))
    tot = Window.partitionBy()
    cum = Window.orderBy("rating").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (counts.withColumn("share", F.col("n") / F.sum("n").over(tot))
            .withColumn("cum_share", F.sum("n").over(cum) / F.sum("n").over(tot)))


def mean_median(df: DataFrame, col: str = "rating") -> DataFrame:
    hist = value_histogram(df.select(F.col(col).cast("double").alias(col)), col)
    middle = interpolated_quantiles(hist, [0.5])[0]
    mean = F.sum(F.col("v") * F.col("n")) / F.sum("n")
    return hist.agg(mean.alias(f"mean_{col}")).withColumn(
        f"median_{col}", F.lit(middle).cast("double"))


def counts_per(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def count_describe(df: DataFrame, key: str) -> DataFrame:
    """pandas ``describe()`` of the per-key row counts (std with ddof=1, linear quantiles)."""
    hist = value_histogram(counts_per(df, key), "n")
    quarters = interpolated_quantiles(hist, [0.25, 0.5, 0.75])
    mean = hist.agg(F.sum(F.col("v") * F.col("n")) / F.sum("n")).first()[0]
    spread = F.sum(F.col("n") * (F.col("v") - F.lit(mean)) ** 2)
    std = F.when(F.sum("n") > 1, F.sqrt(spread / (F.sum("n") - 1)))
    return hist.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("count"),
                    F.lit(mean).cast("double").alias("mean"), std.alias("std"),
                    F.min("v").cast("double").alias("min"),
                    *[F.lit(q).cast("double").alias(f"p{p}")
                      for p, q in zip((25, 50, 75), quarters, strict=True)],
                    F.max("v").cast("double").alias("max"))


def count_percentiles(df: DataFrame, key: str, pcts=(50, 75, 90, 95, 99)) -> DataFrame:
    hist = value_histogram(counts_per(df, key), "n")
    values = interpolated_quantiles(hist, [p / 100.0 for p in pcts])
    return df.sparkSession.createDataFrame([tuple(values)],
                                           ", ".join(f"p{p} double" for p in pcts))


# log2 of the registers of a sketch: a standard error of 0.8 %.
SKETCH_BITS = 14


def monthly_sketches(df: DataFrame, path: str) -> DataFrame:
    """Writes one HyperLogLog sketch of users and movies per month and returns the table.

    Sketches of new months can be written beside the old ones; any months are united from the
    table without their ratings (``united``)."""
    (df.groupBy(F.date_format("date", "yyyy-MM").alias("year_month"))
     .agg(F.count(F.lit(1)).alias("n_ratings"),
          F.hll_sketch_agg("customer_id", SKETCH_BITS).alias("users"),
          F.hll_sketch_agg("movie_id", SKETCH_BITS).alias("movies"))
     .write.mode("overwrite").parquet(path))
    return df.sparkSession.read.parquet(path)


def united(sketches: DataFrame, *by) -> DataFrame:
    """(by, n_ratings, n_users, n_movies): estimates of the united sketches."""
    return sketches.groupBy(*by).agg(
        F.sum("n_ratings").alias("n_ratings"),
        F.hll_sketch_estimate(F.hll_union_agg("users")).alias("n_users"),
        F.hll_sketch_estimate(F.hll_union_agg("movies")).alias("n_movies"))


def count_histogram(df: DataFrame, key: str, bins: int = 80) -> DataFrame:
    """Equal-width histogram of the per-key counts, last bin closed, all bins listed.

    A constant input uses the range (v - 0.5, v + 0.5) like NumPy.
    """
    c = counts_per(df, key)
    mm = c.agg(F.min("n").alias("mn"), F.max("n").alias("mx")).first()
    if mm["mn"] is None:
        return df.sparkSession.createDataFrame([], "bin int, lo double, hi double, n bigint")
    mn, mx = float(mm["mn"]), float(mm["mx"])
    e0, e1 = (mn - 0.5, mx + 0.5) if mn == mx else (mn, mx)
    # The index by division, corrected against the edges themselves (they are rounded).
    step = (e1 - e0) / bins
    raw = F.least(F.floor((F.col("n") - F.lit(e0)) / F.lit(e1 - e0) * F.lit(bins)),
                  F.lit(bins - 1)).cast("int")

    def edge(i):
        return F.when(i == bins, F.lit(e1)).otherwise(i * F.lit(step) + F.lit(e0))

    b = (F.when(F.col("n") < edge(raw), raw - 1)
         .when((F.col("n") >= edge(raw + 1)) & (raw < bins - 1), raw + 1).otherwise(raw))
    hist = c.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("cnt"))
    grid = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    width = (e1 - e0) / bins
    return (grid.join(hist, "bin", "left")
            .select("bin", (F.lit(e0) + F.col("bin") * F.lit(width)).alias("lo"),
                    (F.lit(e0) + (F.col("bin") + 1) * F.lit(width)).alias("hi"),
                    F.coalesce("cnt", F.lit(0)).cast("bigint").alias("n")))


def _label(titles: DataFrame | None, df: DataFrame) -> DataFrame:
    if titles is None:
        return df.withColumn("label", F.col("movie_id").cast("string"))
    return (df.join(titles.select("movie_id", "title"), "movie_id", "left")
            .withColumn("label", F.coalesce("title", F.col("movie_id").cast("string")))
            .drop("title"))


def most_rated(df: DataFrame, titles: DataFrame | None = None, n: int = 20) -> DataFrame:
    top = (counts_per(df, "movie_id").withColumnRenamed("n", "num_ratings")
           .orderBy(F.col("num_ratings").desc(), F.col("movie_id").asc()).limit(n))
    return _label(titles, top)


def movie_means(df: DataFrame, titles: DataFrame | None = None, min_count: int = 1000,
                n: int = 10, best: bool = True, digits: int = 9) -> DataFrame:
    """n best (or worst) movies by mean rating among those with ≥ ``min_count`` ratings."""
    stats = (df.groupBy("movie_id")
             .agg(F.avg(F.col("rating").cast("double")).alias("avg_rating"),
                  F.count(F.lit(1)).alias("num_ratings"))
             .filter(F.col("num_ratings") >= F.lit(min_count)))
    key = F.round("avg_rating", digits)
    top = stats.orderBy(key.desc() if best else key.asc(), F.col("movie_id").asc()).limit(n)
    return _label(titles, top)


def monthly_volume(df: DataFrame) -> DataFrame:
    return (df.groupBy(F.date_format("date", "yyyy-MM").alias("year_month"))
            .agg(F.count(F.lit(1)).alias("n")))


def sparsity(df: DataFrame, approx: bool = False) -> DataFrame:
    s = sizes(df, approx)
    possible = F.col("n_users") * F.col("n_movies")
    return (s.withColumn("possible", possible)
            .withColumn("density", F.col("n_ratings") / F.col("possible"))
            .withColumn("sparsity", F.lit(1.0) - F.col("density")))


def user_history(df: DataFrame, titles: DataFrame | None = None, n: int = 15,
                 users: DataFrame | None = None) -> DataFrame:
    """Each user's n top ratings (rating desc, date desc, movie_id) with titles (F8).

    ``users`` restricts to some users (semi join); the per-user limit runs as a partial
    WindowGroupLimit before the shuffle, so heavy users ship at most n rows per task.
    """
    if users is not None:
        df = df.join(users.select("customer_id"), "customer_id", "left_semi")
    w = Window.partitionBy("customer_id").orderBy(F.col("rating").desc(), F.col("date").desc(),
                                                  F.col("movie_id").asc())
    top = (df.withColumn("pos", F.row_number().over(w)).filter(F.col("pos") <= n)
           .withColumn("date_str", F.date_format("date", "dd/MMMM/yyyy")))
    if titles is not None:
        top = top.join(titles.select("movie_id", "title"), "movie_id", "left")
    return top


def seen_items(df: DataFrame) -> DataFrame:
    """Per user: number of distinct items and the sorted item list as text (D19)."""
    return (df.groupBy("customer_id").agg(F.array_sort(F.collect_set("movie_id")).alias("s"))
            .select("customer_id", F.size("s").cast("bigint").alias("n_seen"),
                    F.array_join("s", ",").alias("items")))
