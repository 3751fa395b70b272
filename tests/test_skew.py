"""The salted hot-key join equals the plain join, and hot users are spread over tasks."""

import datetime as dt

from pyspark.sql import functions as F

from reelrank.operators.scoring import estimate_pairs
from reelrank.operators.skew import hot_keys, lookup_join, salted, skew_join
from reelrank.operators.split import flag_cold_users


def _skewed(spark):
    rows = [(0, i % 15) for i in range(3000)] + [(u, u % 15) for u in range(1, 40)]
    return spark.createDataFrame(rows, "customer_id long, movie_id long")


def test_skew_join_equals_plain_join(spark):
    big = _skewed(spark).withColumn("v", F.col("movie_id") * 2)
    small = spark.createDataFrame([(u, float(u)) for u in range(0, 30)], "customer_id long, w double")
    for how in ("left", "inner"):
        plain = big.join(small, "customer_id", how)
        got = skew_join(big, small, "customer_id", how, max_rows_per_key=100)
        cols = ["customer_id", "movie_id", "v", "w"]
        assert sorted(plain.select(*cols).collect()) == sorted(got.select(*cols).collect())


def test_hot_user_is_spread_evenly(spark):
    big = _skewed(spark).withColumn("n", F.monotonically_increasing_id())
    small = spark.createDataFrame([(u, float(u)) for u in range(0, 30)], "customer_id long, w double")
    counts = big.groupBy("customer_id").agg(F.count("*").alias("c"))
    b, s = salted(big, small, "customer_id", hot_keys(counts, "customer_id", "c", 100))
    per = {r[0]: r[1] for r in b.where("customer_id = 0").groupBy("_salt").count().collect()}
    assert len(per) == 30 and max(per.values()) < 200
    assert s.where("customer_id = 0").count() == 30 and s.where("customer_id = 1").count() == 1


def test_more_hot_keys_than_the_limit_still_salts(spark):
    rows = [(u, i) for u in range(6) for i in range(40)] + [(0, i) for i in range(400)]
    big = spark.createDataFrame(rows, "customer_id long, movie_id long")
    small = spark.createDataFrame([(u, u * 2) for u in range(6)], "customer_id long, w long")
    out = skew_join(big, small, "customer_id", "left", max_rows_per_key=10, max_hot_keys=2)
    assert "_salt" in out._jdf.queryExecution().analyzed().toString()
    plain = big.join(small, "customer_id", "left").select(*out.columns)
    assert sorted(out.collect()) == sorted(plain.collect())


def test_scoring_and_cold_flag_with_salting(spark, tiny_model):
    pairs = _skewed(spark)
    a = estimate_pairs(pairs, tiny_model).select("customer_id", "movie_id", "est")
    b = estimate_pairs(pairs, tiny_model, max_rows_per_user=50).select("customer_id", "movie_id",
                                                                       "est")
    assert sorted(a.collect()) == sorted(b.collect())
    full = pairs.withColumn("date", F.when(F.col("customer_id") == 0, F.lit(dt.date(2000, 1, 1)))
                            .otherwise(F.lit(dt.date(2001, 1, 1))))
    test = full.filter(F.col("customer_id") > 0).unionByName(full.filter(F.col("customer_id") == 0))
    f1 = flag_cold_users(test, full, dt.date(2000, 6, 1))
    f2 = flag_cold_users(test, full, dt.date(2000, 6, 1), max_rows_per_key=10)
    assert sorted(f1.collect()) == sorted(f2.collect())
    assert f2.filter("customer_id = 0 AND NOT is_cold_user").count() == 3000


def test_lookup_join_in_slices_is_the_plain_join(spark):
    """One slice, three slices and too many: the same rows, and ``big`` is shuffled in the last only."""
    big = spark.range(500).select(F.when(F.col("id") % 50 != 0, F.col("id") % 90).alias("k"),
                                  F.col("id").alias("x"))
    small = spark.range(60).select(F.col("id").alias("k"), (F.col("id") / 7).alias("b"))
    for how in ("left", "inner"):
        want = sorted(map(str, big.join(small, "k", how).collect()))
        for size, joins in ((60 * 48, 1), (20 * 48, 3), (48, 0)):
            got = lookup_join(big, small, "k", how, slice_bytes=size)
            assert sorted(map(str, got.collect())) == want
            plan = got._jdf.queryExecution().optimizedPlan().toString()
            assert plan.count("strategy=broadcast") == joins
