"""Sparse filter cascade, temporal split, sampling, dense index, forward fill."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from reelrank.operators.fill import forward_fill
from reelrank.operators.filtering import filter_sparse
from reelrank.operators.ordstat import nth_smallest
from reelrank.operators.profile import count_histogram
from reelrank.operators.sampling import dense_index, sample_ids, sample_rows, sample_users
from reelrank.operators.split import flag_cold_users, temporal_cut, temporal_split


def test_filter_cascade_movies_then_users(spark):
    # Movie 9 has one rating only; without it user 33 is left with too few.
    pairs = [(m, u) for m in (5, 6, 7) for u in (31, 32)] + [(5, 33), (6, 33), (9, 33)]
    df = spark.createDataFrame(pairs, "movie_id long, customer_id long").withColumn(
        "rating", F.lit(2.0))
    res = filter_sparse(df, 2, 3)
    assert sorted(r.movie_id for r in res.valid_movies.collect()) == [5, 6, 7]
    assert sorted(r.customer_id for r in res.valid_users.collect()) == [31, 32]
    assert res.ratings.count() == 6


def _dates_df(spark, dates):
    return spark.createDataFrame([(i, d) for i, d in enumerate(dates)], "customer_id long, date date")


def test_temporal_cut_matches_pandas(spark):
    rng = np.random.default_rng(5)
    base = dt.date(2000, 1, 1)
    dates = [base + dt.timedelta(days=int(x)) for x in rng.integers(0, 40, 333)]
    df = _dates_df(spark, dates)
    for ts in (0.2, 0.5, 0.01, 0.99):
        s = pd.Series(dates).sort_values()
        assert temporal_cut(df, ts) == s.iloc[int(len(dates) * (1 - ts))]


def test_temporal_split_edges(spark):
    df = _dates_df(spark, [dt.date(2001, 1, 1)] * 10)
    train, test, cut = temporal_split(df, 0.2)
    assert cut == dt.date(2001, 1, 1) and train.count() == 0 and test.count() == 10  # ties → test
    for bad in (0.0, 1.0):
        with pytest.raises(ValueError):
            temporal_cut(df, bad)


def test_cold_flag(spark):
    df = spark.createDataFrame([(1, dt.date(2000, 1, 1)), (1, dt.date(2000, 3, 1)),
                                (2, dt.date(2000, 3, 2))], "customer_id long, date date")
    train, test, cut = temporal_split(df, 0.5, cut=dt.date(2000, 2, 1))
    flags = {r.customer_id: r.is_cold_user for r in flag_cold_users(test, df, cut).collect()}
    assert flags == {1: False, 2: True}


def test_nth_smallest_out_of_range(spark):
    assert nth_smallest(_dates_df(spark, [dt.date(2000, 1, 1)]), "date", 5) is None


def test_sample_exact_size_and_deterministic(spark, tiny_ratings):
    a = sample_ids(tiny_ratings, "customer_id", 0.35, 42)
    b = sample_ids(tiny_ratings, "customer_id", 0.35, 42)
    assert a.count() == int(26 * 0.35)
    assert sorted(a.collect()) == sorted(b.collect())
    assert sample_ids(tiny_ratings, "customer_id", 0.35, 7).count() == int(26 * 0.35)
    s = sample_users(tiny_ratings, 0.35, 42)
    ids = {r.customer_id for r in a.collect()}
    full = tiny_ratings.filter(F.col("customer_id").isin(list(ids))).count()
    assert s.count() == full                                   # whole histories
    n = tiny_ratings.count()
    assert sample_rows(tiny_ratings, 0.3, 1).count() == int(n * 0.3)
    assert sample_users(tiny_ratings, 1.0, 42).count() == n


@pytest.mark.parametrize("fraction", [0.1, 0.25, 0.66])
def test_row_sample_with_repeated_rows_has_the_exact_size(spark, fraction):
    df = spark.range(120).select((F.col("id") % 3).alias("customer_id"),
                                 (F.col("id") % 2).alias("movie_id"))
    assert sample_rows(df, fraction, 4).count() == int(120 * fraction)


def test_count_histogram_equals_numpy(spark):
    """All integer ranges 1..n: one id of every count."""
    for n in (2, 7, 89, 130, 257, 400):
        df = spark.range(1, n + 1).select(F.explode(F.array_repeat("id", F.col("id").cast("int")))
                                          .alias("movie_id"))
        got = [r["n"] for r in count_histogram(df, "movie_id", 80).orderBy("bin").collect()]
        assert got == np.histogram(np.arange(1, n + 1), bins=80)[0].tolist(), n


def test_sample_matches_md5_order(spark, tiny_ratings):
    import hashlib
    ids = sorted({r.customer_id for r in tiny_ratings.select("customer_id").collect()})
    want = sorted(ids, key=lambda u: (hashlib.md5(f"{u}:42".encode()).hexdigest(), u))[:9]
    got = sorted(r.customer_id for r in sample_ids(tiny_ratings, "customer_id", 0.35, 42).collect())
    assert got == sorted(want)


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_dense_index_follows_the_order_of_ids(spark, parts):
    ids = spark.createDataFrame([(int(x),) for x in np.random.default_rng(2).choice(10_000, 300, replace=False)],
                                "id long")
    idx = dense_index(ids, "id", partitions=parts).collect()
    got = sorted((r.idx, r.id) for r in idx)
    assert [i for i, _ in got] == list(range(300))
    assert [v for _, v in got] == sorted(v for _, v in got)


def test_forward_fill_global_order(spark):
    rng = np.random.default_rng(3)
    n = 400
    vals = [None if rng.random() < 0.7 else float(i) for i in range(n)]
    vals[0] = None
    df = spark.createDataFrame([(i, int(rng.integers(0, 50)), vals[i]) for i in range(n)],
                               "id long, ts long, v double")
    pdf = df.toPandas().sort_values(["ts", "id"])
    pdf["want"] = pdf["v"].ffill()
    got = forward_fill(df, "v", ["ts", "id"], "f", partitions=6).toPandas().sort_values(["ts", "id"])
    assert np.array_equal(got["f"].to_numpy(), pdf["want"].to_numpy(), equal_nan=True)


def test_quantiles_from_a_histogram(spark):
    """As NumPy interpolates, on even and odd sizes, without a percentile aggregate."""
    import numpy as np
    from reelrank.operators.ordstat import interpolated_quantiles, value_histogram
    rng = np.random.default_rng(5)
    for n in (1, 2, 7, 1000, 1001):
        x = rng.integers(0, 60, n)
        hist = value_histogram(spark.createDataFrame([(int(v),) for v in x], "v long"), "v")
        qs = [0.0, 0.25, 0.5, 0.9, 0.99, 1.0]
        assert np.allclose(interpolated_quantiles(hist, qs), np.quantile(x, qs))
        assert "percentile" not in hist._jdf.queryExecution().toString()
    assert interpolated_quantiles(hist.where("v < 0"), [0.5]) == [None]
