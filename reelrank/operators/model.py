"""Biased matrix factorisation r̂ = μ + b_u + b_i + q_i·p_u as Spark jobs (H5, A12, H13).

Fit recipe (objective Σ e² + λ Σ n_u(b_u² + ‖p_u‖²) + λ Σ n_i(b_i² + ‖q_i‖²)):
  1. μ = mean training rating (fixed).
  2. Closed-form alternating bias sweeps, each a ``groupBy`` average:
       b_i = avg(r − μ − b_u) / (1 + λ),  b_u = avg(r − μ − b_i) / (1 + λ).
  3. MLlib ALS on the residual r − μ − b_u − b_i (``regParam`` is scaled by the number
     of ratings inside ALS, which is exactly the per-rating penalty above).
  4. One final bias sweep with the factors held fixed (cannot raise the objective).
The model is three tables keyed by raw id; nothing is indexed on the driver.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelrank.operators.skew import lookup_join, lookup_means
from reelrank.session import cut_lineage, ensure_checkpoint_dir

INT_MAX = 2 ** 31 - 1
ITEMS_PER_BLOCK = 100


@dataclass
class MFModel:
    global_mean: float
    user_factors: DataFrame      # customer_id, b_u DOUBLE, p ARRAY<DOUBLE> (nullable)
    item_factors: DataFrame      # movie_id,    b_i DOUBLE, q ARRAY<DOUBLE> (nullable)
    rank: int = 0
    n_users: int | None = None
    n_items: int | None = None
    params: dict = field(default_factory=dict)

    def item_count(self) -> int:
        if self.n_items is None:
            self.n_items = self.item_factors.count()
        return self.n_items

    def item_bytes(self) -> int:
        """Upper bound of the in-memory size of the item side (id, bias, rank doubles)."""
        return self.item_count() * (8 * (self.rank + 2) + 32)

    def meta(self, spark: SparkSession) -> DataFrame:
        """One-row model metadata (H13)."""
        params = {k: str(v) for k, v in sorted(self.params.items())}
        return spark.createDataFrame(
            [(float(self.global_mean), int(self.rank), self.n_users, self.item_count(), params)],
            "global_mean double, rank int, n_users bigint, n_items bigint, "
            "params map<string,string>")


def _ratings(train: DataFrame) -> DataFrame:
    return train.select("customer_id", "movie_id", F.col("rating").cast("double").alias("r"))


def bias_sweeps(r: DataFrame, mu: float, reg: float, sweeps: int,
                users: DataFrame | None = None, offset: DataFrame | None = None,
                item_stats: DataFrame | None = None):
    """Alternating closed-form bias sweeps. Items first (users start at 0).

    ``offset`` optionally supplies a per-rating term (column ``_o``) held fixed, e.g. the
    factor dot product in the final sweep. Returns (users, items) tables.

    Each sweep is two aggregations over the ratings, whose other side's biases are looked up by
    broadcast (``lookup_means``: the ratings are not shuffled); the per-key results (one row per
    user / item) are written to the shared checkpoint folder as soon as they are built,
    so later sweeps never recompute earlier ones, nothing is pinned in executor memory,
    and AQE sizes the output like any other shuffle.
    """
    base = r if offset is None else offset
    if "_o" not in base.columns:
        base = base.withColumn("_o", F.lit(0.0))
    items = None
    shrink = 1.0 + reg
    for s in range(sweeps):
        if s == 0 and users is None and offset is None and item_stats is not None:
            # first sweep with b_u = 0 needs only per-item sums: no pass over the ratings
            items = cut_lineage(item_stats.select(
                "movie_id", ((F.col("_s") / F.col("_c") - F.lit(mu)) / F.lit(shrink))
                .alias("b_i")), "bias-items")
        else:
            rest = F.col("r") - F.lit(mu) - F.col("_o")
            mean = (base.groupBy("movie_id").agg(F.avg(rest).alias("b_i")) if users is None
                    else lookup_means(base, users, "customer_id", "movie_id",
                                      rest - F.coalesce("b_u", F.lit(0.0)), "b_i"))
            items = cut_lineage(mean.withColumn("b_i", F.col("b_i") / F.lit(shrink)), "bias-items")
        mean = lookup_means(base, items, "movie_id", "customer_id",
                            F.col("r") - F.lit(mu) - F.coalesce("b_i", F.lit(0.0)) - F.col("_o"),
                            "b_u")
        users = cut_lineage(mean.withColumn("b_u", F.col("b_u") / F.lit(shrink)), "bias-users")
    return users, items


@dataclass
class BiasModel:
    global_mean: float
    users: DataFrame   # customer_id, b_u
    items: DataFrame   # movie_id, b_i

    def as_mf(self) -> MFModel:
        return MFModel(self.global_mean,
                       self.users.withColumn("p", F.lit(None).cast("array<double>")),
                       self.items.withColumn("q", F.lit(None).cast("array<double>")), rank=0)


def item_sums(r: DataFrame) -> DataFrame:
    """Per-item rating sum and count (written once): gives μ and the first item sweep."""
    return cut_lineage(r.groupBy("movie_id").agg(F.sum("r").alias("_s"),
                                                 F.count(F.lit(1)).alias("_c")), "item-sums")


def global_mean(stats: DataFrame) -> float:
    row = stats.agg((F.sum("_s") / F.sum("_c")).alias("mu")).first()
    if row is None or row["mu"] is None:
        raise ValueError("cannot fit on an empty training set")
    return float(row["mu"])


def fit_biases(train: DataFrame, reg: float, sweeps: int = 2) -> BiasModel:
    r = _ratings(train)
    stats = item_sums(r)
    mu = global_mean(stats)
    users, items = bias_sweeps(r, mu, reg, sweeps, item_stats=stats)   # written tables
    return BiasModel(float(mu), users, items)


def fit_mf(train: DataFrame, rank: int = 50, reg: float = 0.05, max_iter: int = 10,
           bias_sweep_count: int = 2, seed: int = 42, final_bias_sweep: bool = True,
           num_blocks: int | None = None, checkpoint_interval: int = 1) -> MFModel:
    """Biases by closed form, factors by ALS on the residual (any BIGINT ids).

    ALS deletes the shuffle files of its half steps at a checkpoint, so the disk holds those of
    ``checkpoint_interval`` iterations.
    """
    from pyspark.ml.recommendation import ALS

    spark = train.sparkSession
    r = _ratings(train)
    ensure_checkpoint_dir(spark)                 # ALS checkpoints its factor RDDs there
    sums = item_sums(r)
    mu = global_mean(sums)
    users, items = bias_sweeps(r, mu, reg, bias_sweep_count, item_stats=sums)
    # id ranges and the rating count come from the small per-key tables (no extra pass)
    ustat = users.agg(F.min("customer_id").alias("lo"), F.max("customer_id").alias("hi")).first()
    istat = sums.agg(F.min("movie_id").alias("lo"), F.max("movie_id").alias("hi"),
                     F.sum("_c").alias("n")).first()
    # MLlib ALS takes INT ids: ids outside that range are mapped to dense 0..n-1 indexes
    # (distributed, no driver-side map) and the factors are joined back to raw ids.
    remap = max(ustat["hi"], istat["hi"]) > INT_MAX or min(ustat["lo"], istat["lo"]) < 0
    if remap:
        from reelrank.operators.sampling import dense_index
        uidx = dense_index(users, "customer_id", "_u")
        iidx = dense_index(items, "movie_id", "_i")
        users_k = cut_lineage(users.join(uidx, "customer_id"), "indexed-users")
        items_k = cut_lineage(items.join(iidx, "movie_id"), "indexed-items")
    else:
        users_k = users.withColumn("_u", F.col("customer_id"))
        items_k = items.withColumn("_i", F.col("movie_id"))
    # Written once: the fit reads its input twice.
    resid = cut_lineage(
        lookup_join(lookup_join(r, users_k, "customer_id", "inner"), items_k, "movie_id", "inner")
        .select(F.col("_u").cast("int").alias("u"), F.col("_i").cast("int").alias("i"),
                (F.col("r") - F.lit(mu) - F.col("b_u") - F.col("b_i")).alias("e")), "residuals")
    if num_blocks is None:
        num_blocks = max(spark.sparkContext.defaultParallelism, int(istat["n"] // 5_000_000) + 1)
    als = ALS(rank=rank, maxIter=max_iter, regParam=reg, userCol="u", itemCol="i",
              ratingCol="e", nonnegative=False, implicitPrefs=False, seed=seed,
              numUserBlocks=num_blocks,
              numItemBlocks=max(1, min(num_blocks, -(-items.count() // ITEMS_PER_BLOCK))),
              checkpointInterval=checkpoint_interval, coldStartStrategy="nan")
    fitted = als.fit(resid)
    uf = fitted.userFactors.select(F.col("id").cast("bigint").alias("customer_id"),
                                   F.col("features").cast("array<double>").alias("p"))
    itf = fitted.itemFactors.select(F.col("id").cast("bigint").alias("movie_id"),
                                    F.col("features").cast("array<double>").alias("q"))
    if remap:
        uf = (uf.withColumnRenamed("customer_id", "_u").join(uidx, "_u")
              .select("customer_id", "p"))
        itf = (itf.withColumnRenamed("movie_id", "_i").join(iidx, "_i")
               .select("movie_id", "q"))
    if final_bias_sweep:
        from reelrank.operators.scoring import estimate_pairs
        # p·q alone, unclipped: no vector is shuffled once per rating.
        factors = MFModel(0.0, uf.withColumn("b_u", F.lit(0.0)),
                          itf.withColumn("b_i", F.lit(0.0)), rank=rank, n_items=items.count())
        everything = float("-inf"), float("inf")
        with_pq = cut_lineage(estimate_pairs(r, factors, everything, out_col="_o")
                              .select("customer_id", "movie_id", "r", "_o"), "with-factors")
        users, items = bias_sweeps(r, mu, reg, 1, users=users, offset=with_pq)
    user_tab = cut_lineage(users.join(uf, "customer_id", "left"))
    item_tab = cut_lineage(items.join(itf, "movie_id", "left"))
    return MFModel(mu, user_tab, item_tab, rank=rank, n_users=user_tab.count(),
                   n_items=item_tab.count(),
                   params={"rank": rank, "reg": reg, "max_iter": max_iter, "seed": seed,
                           "bias_sweeps": bias_sweep_count})


MARKER = "_COMMITTED"


def _versions(spark: SparkSession, path: str) -> list[tuple[int, bool]]:
    """(number, committed) of the versions of a model, in order."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    found = [f.getPath() for f in fs.listStatus(folder) if f.getPath().getName().startswith("v")]
    return sorted((int(f.getName()[1:]), fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f, MARKER)))
                  for f in found if f.getName()[1:].isdigit())


def save_model(model: MFModel, path: str) -> str:
    """Writes the three tables as a new version and marks it when all are there.

    Readers take the newest marked version, so they never see tables of two fits, and a save
    that dies leaves the model before it in force. Returns the version's folder.
    """
    spark = model.user_factors.sparkSession
    path = path.rstrip("/")
    number = max((n for n, _ in _versions(spark, path)), default=0) + 1
    at = f"{path}/v{number:06d}"
    model.user_factors.write.mode("overwrite").parquet(f"{at}/user_factors")
    model.item_factors.write.mode("overwrite").parquet(f"{at}/item_factors")
    model.meta(spark).write.mode("overwrite").parquet(f"{at}/model_meta")
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{at}/{MARKER}")
    marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(marker, False).close()
    return at


def load_model(spark: SparkSession, path: str) -> MFModel:
    path = path.rstrip("/")
    done = [n for n, committed in _versions(spark, path) if committed]
    if not done:
        raise FileNotFoundError(f"no complete model in {path}")
    at = f"{path}/v{done[-1]:06d}"
    meta = spark.read.parquet(f"{at}/model_meta").first()
    return MFModel(meta["global_mean"], spark.read.parquet(f"{at}/user_factors"),
                   spark.read.parquet(f"{at}/item_factors"), rank=meta["rank"],
                   n_users=meta["n_users"], n_items=meta["n_items"], params=dict(meta["params"]))
