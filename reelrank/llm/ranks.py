"""Places of rows within their groups, counted without gathering a group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reelrank.session import cut_lineage

# Rows of the offset table (one per range partition and group in it) that may be broadcast.
BROADCAST_ROWS = 200_000


def rank_within(rows: DataFrame, group: str, order: list[Column], name: str) -> DataFrame:
    """Adds ``rank`` (long, gapless from 0 within ``group`` by ``order``) and ``total``.

    The rows are dealt by ranges of (group, order, row number) and sorted inside each range,
    so a group of any size spreads over as many tasks as it needs, and rows that agree in
    everything are split too (they get their places in the order in which they were read).
    A row's place is its place in its range plus the rows of its group in earlier ranges;
    that table has one row per range and group in it. ``rows`` should be a written table: it
    is read once for the range bounds and once to be dealt. Columns named ``rank*`` are the
    helper's own.
    """
    keys = [F.col(group), *order, F.col("rank_row")]
    placed = cut_lineage(
        rows.withColumn("rank_row", F.monotonically_increasing_id())
        .repartitionByRange(*keys).sortWithinPartitions(*keys)
        .withColumn("rank_at", F.monotonically_increasing_id()).drop("rank_row"), name)
    # Fixed value: monotonically_increasing_id keeps the partition above its lower 33 bits.
    part = F.shiftright("rank_at", 33)
    earlier = (Window.partitionBy("rank_group").orderBy("rank_part")
               .rowsBetween(Window.unboundedPreceding, -1))
    starts = cut_lineage(
        placed.groupBy(F.col(group).alias("rank_group"), part.alias("rank_part"))
        .agg(F.min("rank_at").alias("rank_first"), F.count(F.lit(1)).alias("rank_n"))
        .withColumn("rank_before", F.coalesce(F.sum("rank_n").over(earlier), F.lit(0)))
        .withColumn("total", F.sum("rank_n").over(Window.partitionBy("rank_group"))),
        f"{name}-starts")
    small = F.broadcast(starts) if starts.count() <= BROADCAST_ROWS else starts
    return (placed.withColumn("rank_part", part)
            .join(small.withColumnRenamed("rank_part", "rank_of"),
                  F.col(group).eqNullSafe(F.col("rank_group"))
                  & (F.col("rank_part") == F.col("rank_of")))
            .withColumn("rank", F.col("rank_at") - F.col("rank_first") + F.col("rank_before"))
            .drop("rank_at", "rank_part", "rank_of", "rank_group", "rank_first", "rank_n",
                  "rank_before"))
