"""Rating-shaped inputs derived from the driver's TPC-H-like tables.

``ratings_all``  one rating per (customer, part): newest order date wins, then the
                 higher rating. Rating = quantity bucket 1..5.
``ratings``      ``ratings_all`` minus the pre-cut rows of every customer with
                 ``customer_id % 7 = 0`` ("late joiners"), so cold users exist.
``titles``       movie_id, year, title from ``part``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelrank.operators.ordstat import value_at_fraction

RATING_COLS = ["customer_id", "movie_id", "rating", "date"]

# Fixed values of the fixture rules.
LATE_JOINER_MODULUS = 7
CUT_FRACTION = 0.8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ratings_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    rows = (li.join(od, li.l_orderkey == od.o_orderkey)
            .select(F.col("o_custkey").alias("customer_id"),
                    F.col("l_partkey").alias("movie_id"),
                    F.least(F.lit(5), F.lit(1) + F.floor((F.col("l_quantity") - 1) / 10))
                    .cast("int").alias("r"),
                    F.col("o_orderdate").cast("date").alias("date")))
    # Dedupe with a hash aggregate (map-side combine): the pair (date, rating) is packed
    # into one BIGINT whose max is "newest date, then highest rating"; r is 1..5 here.
    packed = F.unix_date("date").cast("bigint") * 8 + F.col("r")
    best = rows.groupBy("customer_id", "movie_id").agg(F.max(packed).alias("_k"))
    return best.select(
        "customer_id", "movie_id",
        F.pmod(F.col("_k"), F.lit(8)).cast("float").alias("rating"),
        F.date_from_unix_date(F.floor(F.col("_k") / 8).cast("int")).alias("date"))


def fixture_cut(ratings_all_df: DataFrame):
    """Date at 0-based index int(n*0.8) of the sorted dates of ``ratings_all``."""
    return value_at_fraction(ratings_all_df, "date", CUT_FRACTION)


def ratings(spark: SparkSession, sf_dir: str, cut=None, base: DataFrame | None = None) -> DataFrame:
    """``base`` is an already materialised ``ratings_all`` (derived here when omitted)."""
    base = ratings_all(spark, sf_dir) if base is None else base
    if cut is None:
        cut = fixture_cut(base)
    late = (F.col("customer_id") % LATE_JOINER_MODULUS == 0) & (F.col("date") < F.lit(cut))
    return base.filter(~late)


def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("movie_id"),
                    (F.lit(1950) + F.col("p_partkey") % 56).cast("int").alias("year"),
                    F.concat("p_name", F.lit(", "), "p_brand").alias("title"))


# Fixed values of the SQL-checkable factor fixture: users with id % 7 = 0 and items with
# id % 11 = 0 are unknown; user u uses vector u % N, item i uses vector (i*7+3) % N, and
# item vectors are multiplied by 6 so that some (not all) scores clip.
UNKNOWN_ITEM_MODULUS = 11
ITEM_VECTOR_MULT = 7
ITEM_VECTOR_ADD = 3
ITEM_VECTOR_SCALE = 6.0


def embedding_factor_model(spark: SparkSession, sf_dir: str, bias):
    """An MFModel whose biases come from ``bias`` and whose factors are embedding rows."""
    from reelrank.operators.model import MFModel

    emb = table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("e"))
    n = emb.count()
    users = (bias.users.filter(F.col("customer_id") % LATE_JOINER_MODULUS != 0)
             .withColumn("_v", F.pmod(F.col("customer_id"), F.lit(n)))
             .join(emb, F.col("_v") == emb.vec_id, "left")
             .select("customer_id", "b_u", F.col("e").alias("p")))
    items = (bias.items.filter(F.col("movie_id") % UNKNOWN_ITEM_MODULUS != 0)
             .withColumn("_v", F.pmod(F.col("movie_id") * ITEM_VECTOR_MULT + ITEM_VECTOR_ADD,
                                      F.lit(n)))
             .join(emb, F.col("_v") == emb.vec_id, "left")
             .select("movie_id", "b_i",
                     F.transform("e", lambda x: x * F.lit(ITEM_VECTOR_SCALE)).alias("q")))
    return MFModel(bias.global_mean, users, items, rank=64)


# Fixed values of the planted ratings: the first three components of the same vectors, each
# times 6.4, around a mean of 3.
PLANTED_FACTORS = 3
PLANTED_SCALE = 6.4


def planted_ratings(spark: SparkSession, sf_dir: str, pairs: DataFrame) -> DataFrame:
    """``pairs`` with ratings clip(3 + p_u . q_i, 1, 5) that a factor model can learn."""
    emb = table(spark, sf_dir, "embeddings").select(
        "vec_id", F.transform(F.slice(F.col("embedding").cast("array<double>"), 1,
                                      PLANTED_FACTORS), lambda x: x * PLANTED_SCALE).alias("f"))
    n = emb.count()
    users = emb.select(F.col("vec_id").alias("_u"), F.col("f").alias("_p"))
    items = emb.select(F.col("vec_id").alias("_i"), F.col("f").alias("_q"))
    dot = F.aggregate(F.zip_with("_p", "_q", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    return (pairs.withColumn("_u", F.pmod(F.col("customer_id"), F.lit(n)))
            .withColumn("_i", F.pmod(F.col("movie_id") * ITEM_VECTOR_MULT + ITEM_VECTOR_ADD,
                                     F.lit(n)))
            .join(users, "_u").join(items, "_i")
            .withColumn("rating", F.least(F.greatest(F.lit(3.0) + dot, F.lit(1.0)), F.lit(5.0)))
            .drop("_u", "_i", "_p", "_q"))
