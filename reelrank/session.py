"""Session helpers: a configured local session for tests/bench and a shared scratch area."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app: str = "reelrank", event_log_dir: str | None = None) -> SparkSession:
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g")))
    if event_log_dir:
        b = b.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log_dir)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory of the session.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as is.
    Only when it is unset (local tests) a private folder is created.
    """
    sc = spark.sparkContext
    cur = sc.getCheckpointDir()
    if cur:
        return cur
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir and not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not conf_dir:
        conf_dir = tempfile.mkdtemp(prefix="reelrank-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path inside the shared checkpoint area (never a machine-local tmp)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/reelrank-scratch/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame, name: str = "table") -> DataFrame:
    """Materialise ``df`` as a Parquet table in the shared checkpoint folder.

    One job writes it (an eager RDD checkpoint would compute the input twice), the
    lineage is cut, executor loss afterwards costs nothing, and later scans of the
    table get column pruning and filter pushdown.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def drop_scratch(spark: SparkSession) -> None:
    """Deletes the scratch tables of this session's folder. Call it when no result that was
    read from them is in use any more (for example at the end of a job)."""
    base = spark._jvm.org.apache.hadoop.fs.Path(
        f"{ensure_checkpoint_dir(spark).rstrip('/')}/reelrank-scratch")
    base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(base, True)


_SHIPPED: set[int] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``reelrank`` importable by Python workers (once per SparkContext).

    The package is zipped on the driver and registered with ``addPyFile``; Spark then
    distributes it to every executor, so it works whatever the driver's working directory.
    """
    import zipfile

    sc = spark.sparkContext
    key = id(sc._jsc)
    if key in _SHIPPED:
        return
    import reelrank
    root = os.path.dirname(os.path.abspath(reelrank.__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="reelrank-pyfiles-"), "reelrank.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(out)
    _SHIPPED.add(key)
