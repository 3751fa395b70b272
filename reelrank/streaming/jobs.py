"""Structured Streaming jobs (S1–S3), each run with ``Trigger.AvailableNow``.

All three write every micro-batch to ``<out>/batch_id=<n>/`` with overwrite semantics, so
a replayed batch (after a failure between the sink write and the checkpoint commit)
replaces its own output instead of duplicating it. Readers resolve the final state
from the batch folders with a keyed "latest wins" aggregation.
"""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import replace
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelrank.operators.model import MFModel
from reelrank.operators.scoring import estimate_pairs
from reelrank.operators.topk import ItemBlocks, recommend_topk, seen_sets_of
from reelrank.session import cut_lineage, scratch_path
from reelrank.sources.blocktext import parse_lines

MAX_K = 50
MAX_BROADCAST_USERS = 1_000_000
MAX_BROADCAST_ROWS = 2_000_000  # of a batch whose ids are broadcast
USERS_PER_SEEN_FILE = 50_000
SEEN_GROUP_BYTES = 1 << 20
MAX_NAMED_USERS = 100           # a filter names so many users at most


def _batch_dir(out: str, batch_id: int) -> str:
    return f"{out.rstrip('/')}/batch_id={batch_id}"


def _run(writer, checkpoint: str):
    q = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return q


@contextmanager
def _conf(spark: SparkSession, values: dict):
    """Settings that a query takes over when it starts."""
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


# --- S1: rating ingest ----------------------------------------------------------------

def run_rating_ingest(spark: SparkSession, src_dir: str, out_dir: str, checkpoint: str,
                      files_per_batch: int = 1, id_type: str = "int") -> None:
    """New block-text files → parsed ratings, one Parquet folder per micro-batch."""
    lines = (spark.readStream.format("text").option("maxFilesPerTrigger", files_per_batch)
             .load(src_dir)
             .select("value", F.col("_metadata.file_path").alias("_file"),
                     F.col("_metadata.file_block_start").alias("_block")))

    def batch(df: DataFrame, batch_id: int) -> None:
        # positions are taken on the micro-batch scan itself (no shuffle before them)
        df = df.withColumn("_pos", F.monotonically_increasing_id())
        parse_lines(df, id_type).write.mode("overwrite").parquet(_batch_dir(out_dir, batch_id))

    _run(lines.writeStream.foreachBatch(batch), checkpoint)


def _latest(rows: DataFrame) -> DataFrame:
    """Newest date, then newest batch, then highest rating of each (customer, movie)."""
    best = rows.groupBy("customer_id", "movie_id").agg(
        F.max(F.struct("date", "batch_id", "rating")).alias("_b"))
    return best.select("movie_id", "customer_id", F.col("_b.rating").alias("rating"),
                       F.col("_b.date").alias("date"), F.col("_b.batch_id").alias("batch_id"))


def _compacted_to(spark: SparkSession, state_dir: str) -> int:
    """The last batch that a complete state table holds; -1 without one."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(state_dir)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return -1
    done = [f.getPath() for f in fs.listStatus(folder)
            if f.getPath().getName().startswith("upto=")
            and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f.getPath(), "_SUCCESS"))]
    return max((int(f.getName().removeprefix("upto=")) for f in done), default=-1)


def _ingested_rows(spark: SparkSession, out_dir: str, state_dir: str | None) -> DataFrame:
    """The newest state table and the batches after it. ``batch_id`` of a batch comes from
    its folder name, so the folders that the state covers are not read."""
    cols = ("movie_id", "customer_id", "rating", "date", "batch_id")
    upto = _compacted_to(spark, state_dir) if state_dir else -1
    rows = spark.read.parquet(out_dir).where(F.col("batch_id") > upto).select(*cols)
    if upto >= 0:
        rows = rows.unionByName(spark.read.parquet(f"{state_dir}/upto={upto}").select(*cols))
    return rows


def compact_ingested(spark: SparkSession, out_dir: str, state_dir: str) -> int:
    """Write the latest ratings of all batches so far to ``<state_dir>/upto=<last batch>``.

    A state table is used only when its write has completed, so a lost run changes nothing,
    and a batch that is replayed later brings the rows the state already has. Run it between
    ingests; it reads the previous state and the batches since.
    """
    # The column is a folder name: the scan reads no column of the files.
    last = spark.read.parquet(out_dir).agg(F.max("batch_id")).first()[0]
    if last is None or last <= _compacted_to(spark, state_dir):
        return -1 if last is None else int(last)
    (_latest(_ingested_rows(spark, out_dir, state_dir).where(F.col("batch_id") <= int(last)))
     .write.mode("overwrite").parquet(f"{state_dir}/upto={last}"))
    return int(last)


def read_ingested(spark: SparkSession, out_dir: str, state_dir: str | None = None) -> DataFrame:
    """Latest rating per (customer, movie): newest date, then newest batch, then highest.

    With ``state_dir`` only the batches after the last ``compact_ingested`` are read.
    """
    return _latest(_ingested_rows(spark, out_dir, state_dir)).drop("batch_id")


# The state lives in RocksDB; a commit uploads the changes of its batch only.
KEYED_STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
INGESTED_SCHEMA = "movie_id {0}, customer_id {0}, rating float, date date, batch_id long"


def run_latest_ratings(spark: SparkSession, out_dir: str, state_dir: str, id_type: str = "int",
                       partitions: int | None = None, files_per_batch: int = 1000) -> None:
    """Ingested batches → the latest rating of every (customer, movie) as keyed state.

    One row per key is kept in the state store below ``state_dir`` and only the keys of a batch
    are touched: newest date, then newest batch, then highest rating. A batch that is replayed,
    or rows that come twice, change nothing, because a maximum is kept. ``partitions`` sizes the
    state when the query first starts.
    """
    rows = (spark.readStream.schema(INGESTED_SCHEMA.format(id_type))
            .option("maxFilesPerTrigger", files_per_batch).parquet(out_dir))
    best = rows.groupBy("customer_id", "movie_id").agg(
        F.max(F.struct("date", "batch_id", "rating")).alias("best"))
    sized = {"spark.sql.shuffle.partitions": str(partitions)} if partitions else {}
    with _conf(spark, KEYED_STATE | sized):
        _run(best.writeStream.outputMode("update").format("noop"), state_dir)


def read_latest_ratings(spark: SparkSession, state_dir: str) -> DataFrame:
    """The state as a table: one row per (customer, movie), nothing is aggregated."""
    state = spark.read.format("statestore").load(state_dir)
    # The value of an aggregate's state has one field, the kept maximum.
    best = F.col(f"value.`{state.schema['value'].dataType.names[0]}`")
    return state.select("key.movie_id", "key.customer_id", best["rating"].alias("rating"),
                        best["date"].alias("date"))


# --- S2: recommendation requests ------------------------------------------------------


class SeenStore:
    """Seen sets by user: files of ``USERS_PER_SEEN_FILE`` users in id order, with Parquet bloom
    filters and small row groups. A batch reads the files whose range holds one of its users;
    a small batch names its users, so that row groups without them are passed over."""

    def __init__(self, seen: DataFrame, path: str, users_per_file: int = USERS_PER_SEEN_FILE):
        spark = seen.sparkSession
        sets = cut_lineage(seen_sets_of(seen), "seen-sets")
        files = max(1, -(-sets.count() // users_per_file))
        (sets.repartitionByRange(files, "customer_id").sortWithinPartitions("customer_id").write
         .option("parquet.bloom.filter.enabled#customer_id", "true")
         .option("parquet.bloom.filter.expected.ndv#customer_id", str(users_per_file))
         .option("parquet.block.size", str(SEEN_GROUP_BYTES)).parquet(path))
        self.spark, self.schema = spark, "customer_id long, seen array<bigint>"
        # One row per file.
        self.ranges = (spark.read.schema(self.schema).parquet(path)
                       .groupBy(F.col("_metadata.file_path").alias("file"))
                       .agg(F.min("customer_id").alias("lo"), F.max("customer_id").alias("hi"))
                       .collect())

    def of(self, users: DataFrame, n_users: int) -> DataFrame:
        """The seen sets of ``users`` (customer_id, distinct), of which there are ``n_users``."""
        ids = None
        if n_users <= MAX_NAMED_USERS:
            ids = sorted(r[0] for r in users.collect())
            files = [r.file for r in self.ranges if any(r.lo <= i <= r.hi for i in ids)]
        else:
            table = self.spark.createDataFrame(self.ranges, "file string, lo long, hi long")
            files = [r[0] for r in users.join(F.broadcast(table), F.col("customer_id").between(
                F.col("lo"), F.col("hi"))).select("file").distinct().collect()]
        if not files:
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.schema(self.schema).parquet(*files)
        if ids is not None:
            return rows.where(reduce(or_, [F.col("customer_id") == F.lit(i) for i in ids]))
        # A micro-batch is bounded by the trigger; its users are broadcast only when their
        # counted size allows.
        probe = F.broadcast(users) if n_users <= MAX_BROADCAST_USERS else users
        return rows.join(probe, "customer_id", "left_semi")



REQUEST_SCHEMA = "request_id long, customer_id long, k int"


def run_request_stream(spark: SparkSession, src_dir: str, out_dir: str, rejects_dir: str,
                       checkpoint: str, model: MFModel, seen: DataFrame,
                       titles: DataFrame | None = None, scale=(1.0, 5.0),
                       rank_digits: int | None = None, files_per_batch: int = 1,
                       limit_bytes: int = 256 << 20) -> None:
    """Request rows (request_id, customer_id, k) → top-k per request; k outside 1..50 is
    written to the rejects table. Unknown users are answered with the cold ranking."""
    req = (spark.readStream.schema(REQUEST_SCHEMA).option("maxFilesPerTrigger", files_per_batch)
           .parquet(src_dir))
    # Seen sets are aggregated once for the whole stream (not per micro-batch). The item side is
    # made once for the stream.
    store = SeenStore(seen, scratch_path(spark, "seen-store"))
    blocks = ItemBlocks(model, limit_bytes)

    def batch(df: DataFrame, batch_id: int) -> None:
        df = df.persist()
        ok = F.col("k").between(1, MAX_K)
        (df.filter(~ok | F.col("k").isNull())
         .withColumn("reason", F.lit(f"k must be in 1..{MAX_K}"))
         .write.mode("overwrite").parquet(_batch_dir(rejects_dir, batch_id)))
        good = df.filter(ok)
        st = good.agg(F.max("k").alias("kmax"),
                      F.count_distinct("customer_id").alias("n_users")).first()
        if st["kmax"] is not None:
            batch_users = good.select("customer_id").distinct()
            seen_b = store.of(batch_users, st["n_users"])
            recs = recommend_topk(batch_users, model, int(st["kmax"]), seen_sets=seen_b,
                                  titles=titles, scale=scale, rank_digits=rank_digits,
                                  blocks=blocks)
            (good.join(recs, "customer_id").filter(F.col("rank") <= F.col("k"))
             .drop("k").write.mode("overwrite").parquet(_batch_dir(out_dir, batch_id)))
        df.unpersist()

    try:
        _run(req.writeStream.foreachBatch(batch), checkpoint)
    finally:
        blocks.close()


# --- S3: rolling accuracy -------------------------------------------------------------

SCORED_SCHEMA = ("customer_id long, movie_id long, rating float, ts timestamp, "
                 "is_cold_user boolean")


def score_batch(rows: DataFrame, model: MFModel, scale=(1.0, 5.0)) -> DataFrame:
    """``estimate_pairs`` for a batch that is small beside the model.

    The ids of the batch are broadcast and pick its vectors from the factor tables, so what is
    shuffled follows the batch and not the model. Very large batches, which the trigger should
    not make, are left to ``estimate_pairs``.
    """
    if rows.count() > MAX_BROADCAST_ROWS:
        return estimate_pairs(rows, model, scale)

    def of_batch(table: DataFrame, key: str) -> DataFrame:
        return table.join(F.broadcast(rows.select(key).distinct()), key, "left_semi")

    near = replace(model, user_factors=of_batch(model.user_factors, "customer_id"),
                   item_factors=of_batch(model.item_factors, "movie_id"))
    return estimate_pairs(rows, near, scale, limit_bytes=0, max_rows_per_user=None)


def run_scored(spark: SparkSession, src_dir: str, scored_dir: str, checkpoint: str, model: MFModel,
               scale=(1.0, 5.0), files_per_batch: int = 1) -> None:
    """Test ratings arriving as files → their squared errors, one file per micro-batch."""
    rows = (spark.readStream.schema(SCORED_SCHEMA)
            .option("maxFilesPerTrigger", files_per_batch).parquet(src_dir))
    se = (F.col("est") - F.col("rating").cast("double")) ** 2
    seg = F.when(F.col("is_cold_user"), "cold").otherwise("warm")

    def batch(df: DataFrame, batch_id: int) -> None:
        scored = cut_lineage(score_batch(cut_lineage(df, "arrived"), model, scale).select(
            "ts", seg.alias("segment"), se.alias("se")), "scored-batch")
        # One file, so that the next stream takes the same rows as a batch.
        scored.coalesce(1).write.mode("overwrite").parquet(_batch_dir(scored_dir, batch_id))

    _run(rows.writeStream.foreachBatch(batch), checkpoint)


def run_rolling_rmse(spark: SparkSession, src_dir: str, out_dir: str, checkpoint: str,
                     model: MFModel, scale=(1.0, 5.0), window: str = "1 day",
                     watermark: str = "3 days", files_per_batch: int = 1,
                     state_partitions: int | None = None) -> int:
    """Test ratings arriving as files → per (day, segment) RMSE, updated per micro-batch.

    Returns the state's counter of what came too late: (window, segment) sums of a batch that
    were dropped.

    A first stream scores every batch with the vectors it needs, a second one aggregates the
    scored batches; their checkpoints and the scored rows lie below ``checkpoint``.

    Rows whose window ended before the watermark are dropped; Spark judges lateness
    against the watermark of the previous micro-batch, so a row is dropped once the
    stream has moved past it by more than the delay for a full batch. Updated windows
    are upserted by batch.
    """
    scored_dir = f"{checkpoint.rstrip('/')}/scored"
    run_scored(spark, src_dir, scored_dir, f"{checkpoint.rstrip('/')}/scoring", model, scale,
               files_per_batch)
    scored = (spark.readStream.schema("ts timestamp, segment string, se double, batch_id long")
              .option("maxFilesPerTrigger", 1).parquet(scored_dir))
    agg = (scored.withWatermark("ts", watermark)
           .groupBy(F.window("ts", window).alias("w"), "segment")
           .agg(F.sum("se").alias("sse"), F.count(F.lit(1)).alias("n")))

    def batch(df: DataFrame, batch_id: int) -> None:
        (df.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                   "segment", "sse", "n", F.lit(batch_id).cast("bigint").alias("_batch"))
         .write.mode("overwrite").parquet(_batch_dir(out_dir, batch_id)))

    # The state store has one partition per shuffle partition, fixed when the query first
    # starts; the state here is one row per (window, segment), so it may be sized down.
    sized = {"spark.sql.shuffle.partitions": str(state_partitions)} if state_partitions else {}
    with _conf(spark, sized | {"spark.sql.streaming.numRecentProgressUpdates": "100000"}):
        q = _run(agg.writeStream.outputMode("update").foreachBatch(batch),
                 f"{checkpoint.rstrip('/')}/windows")
    return sum(op["numRowsDroppedByWatermark"] for p in q.recentProgress
               for op in p["stateOperators"])


def read_rolling_rmse(spark: SparkSession, out_dir: str) -> DataFrame:
    """Final value of every window: the row of the latest batch that updated it."""
    raw = spark.read.parquet(out_dir)
    last = raw.groupBy("window_start", "segment").agg(
        F.max_by(F.struct("window_end", "sse", "n"), "_batch").alias("_r"))
    return last.select("window_start", F.col("_r.window_end").alias("window_end"), "segment",
                       F.sqrt(F.col("_r.sse") / F.col("_r.n")).alias("rmse"),
                       F.col("_r.n").alias("n"))
