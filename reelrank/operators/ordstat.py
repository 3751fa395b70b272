"""Exact order statistics without a global sort (F6, and the core of H1/H2).

Both helpers build a histogram on a coarse key, take the cumulative count over the
(small, bounded) histogram, and only look at individual rows inside the one bucket
that holds the wanted position. Only a handful of scalars reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelrank.session import cut_lineage


def nth_smallest(df: DataFrame, col: str, idx: int):
    """Value at 0-based position ``idx`` of ``sorted(df[col])`` (duplicates counted).

    Meant for low-cardinality columns (dates): the histogram has one row per distinct value.
    Returns None when ``idx`` is out of range.
    """
    if idx < 0:
        return None
    hist = df.groupBy(col).agg(F.count(F.lit(1)).alias("_n")).filter(F.col(col).isNotNull())
    w = Window.orderBy(col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    row = (hist.withColumn("_cum", F.sum("_n").over(w))
           .filter(F.col("_cum") > F.lit(idx))
           .agg(F.min(col).alias("v")).first())
    return None if row is None else row["v"]


def value_at_fraction(df: DataFrame, col: str, fraction: float):
    """``sorted(df[col])[int(n * fraction)]`` in one job (n counted inside the histogram).

    ``floor(n * fraction)`` is evaluated in double precision on the executors, exactly like
    Python's ``int(n * fraction)``. Returns None for an empty input. Like
    ``nth_smallest`` it is meant for low-cardinality columns (dates): the cumulative
    window runs over the histogram, one row per distinct value.
    """
    hist = df.groupBy(col).agg(F.count(F.lit(1)).alias("_n")).filter(F.col(col).isNotNull())
    upto = Window.orderBy(col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy()
    row = (hist.withColumn("_cum", F.sum("_n").over(upto))
           .withColumn("_idx", F.floor(F.sum("_n").over(whole).cast("double")
                                       * F.lit(float(fraction))))
           .filter(F.col("_cum") > F.col("_idx"))
           .agg(F.min(col).alias("v")).first())
    return None if row is None else row["v"]


def value_histogram(df: DataFrame, col: str) -> DataFrame:
    """(v, n, cum): how often each value of ``col`` occurs, and how many are not larger.

    The values are dealt by ranges; sums inside a range and the sum of the ranges before give
    ``cum``, so neither the values nor their histogram meet in one task.
    """
    hist = df.groupBy(F.col(col).alias("v")).agg(F.count(F.lit(1)).alias("n")).where("v IS NOT NULL")
    ranged = cut_lineage(hist.repartitionByRange("v").withColumn("part", F.spark_partition_id()),
                         "value-counts")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (ranged.groupBy("part").agg(F.sum("n").alias("s"))        # one row per range
               .select(F.col("part").alias("p"),
                       F.coalesce(F.sum("s").over(before), F.lit(0)).alias("offset")))
    upto = (Window.partitionBy("part").orderBy("v")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (ranged.withColumn("own", F.sum("n").over(upto))
            .join(F.broadcast(offsets), F.col("part") == F.col("p"))
            .select("v", "n", (F.col("own") + F.col("offset")).alias("cum")))


def interpolated_quantiles(hist: DataFrame, fractions) -> list[float | None]:
    """Linear quantiles of a ``value_histogram``: between the values at the places below and
    above ``fraction * (count - 1)``. All None for an empty table."""
    total = hist.agg(F.max("cum")).first()[0]
    if not total:
        return [None for _ in fractions]
    places = [f * (total - 1) for f in fractions]
    wanted = sorted({int(p) for p in places} | {min(int(p) + 1, total - 1) for p in places})
    row = hist.agg(*[F.min(F.when(F.col("cum") > w, F.col("v"))).cast("double").alias(f"at{w}")
                     for w in wanted]).first()
    out = []
    for p in places:
        low, high = row[f"at{int(p)}"], row[f"at{min(int(p) + 1, total - 1)}"]
        out.append(low + (high - low) * (p - int(p)))
    return out


def quantile_position(n: int, fraction: float) -> int:
    """``int(n * fraction)`` with Python float semantics (matches the original pipeline)."""
    return int(n * fraction)


def prefix_for(rows: int) -> int:
    """Hex prefix length giving about sqrt(rows) buckets (so both the histogram and the
    one bucket that is sorted stay near sqrt(rows) rows), between 4 and 7 characters."""
    import math
    return min(7, max(4, math.ceil(math.log(max(rows, 2), 16) / 2)))


def smallest_n(df: DataFrame, key: str, tie: str, n: int, prefix_chars: int | None = None,
               total_rows: int | None = None) -> DataFrame:
    """Rows of ``df`` holding the ``n`` smallest ``(key, tie)`` pairs, exactly.

    ``key`` is a uniformly distributed hex string (an md5); its first ``prefix_chars``
    characters give 16**prefix_chars buckets. ``(key, tie)`` must be unique per row.
    """
    if n <= 0:
        return df.filter(F.lit(False))
    if prefix_chars is None:
        prefix_chars = prefix_for(total_rows if total_rows is not None else n)
    bucket = F.substring(F.col(key), 1, prefix_chars)
    hist = df.groupBy(bucket.alias("_b")).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    row = (hist.withColumn("_cum", F.sum("_n").over(w))
           .filter(F.col("_cum") >= F.lit(n))
           .orderBy("_b").select("_b", (F.col("_cum") - F.col("_n")).alias("_before"))
           .first())
    if row is None:                       # n >= number of rows: everything is selected
        return df
    need = n - int(row["_before"])
    inner = Window.orderBy(key, tie)
    thr = (df.filter(bucket == F.lit(row["_b"])).select(key, tie)
           .withColumn("_rn", F.row_number().over(inner))
           .filter(F.col("_rn") == F.lit(need)).first())
    k0, t0 = thr[key], thr[tie]
    return df.filter((F.col(key) < F.lit(k0))
                     | ((F.col(key) == F.lit(k0)) & (F.col(tie) <= F.lit(t0))))
