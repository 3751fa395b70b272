"""Forward fill in file order or in a global sort order (E1), without one big window.

Rows are cut into blocks whose order is known: (file, split start) for text files, range
partitions for a sorted table. Inside a block a window fills locally; a table with one
row per block carries the last non-null value of all earlier blocks into the next one.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelrank.session import cut_lineage

# Intervals are broadcast up to so many (about 50 bytes each).
MAX_BROADCAST_BLOCKS = 1_000_000


def fill_down_blocks(df: DataFrame, value_col: str, out_col: str, block_cols: list[str],
                     pos_col: str, group_cols: list[str] | None = None) -> DataFrame:
    """``out_col`` = last non-null ``value_col`` at or before each row.

    ``group_cols`` (e.g. the file) bound the fill: nothing carries across groups.
    Blocks are ordered by ``block_cols`` (after ``group_cols``); rows by ``pos_col``.
    """
    group_cols = group_cols or []
    part = group_cols + block_cols
    local_w = (Window.partitionBy(*part).orderBy(pos_col)
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = F.last(F.col(value_col), ignorenulls=True).over(local_w)
    nn = F.col(value_col).isNotNull()
    per_block = df.groupBy(*part).agg(
        F.max_by(F.col(value_col), F.when(nn, F.col(pos_col))).alias("_last"))
    carry_w = (Window.partitionBy(*group_cols).orderBy(*block_cols)
               .rowsBetween(Window.unboundedPreceding, -1))
    carry = per_block.select(*part, F.last("_last", ignorenulls=True).over(carry_w)
                             .alias("_carry"))
    return (df.withColumn("_local", local).join(carry, part, "left")
            .withColumn(out_col, F.coalesce("_local", "_carry")).drop("_local", "_carry"))


def forward_fill(df: DataFrame, value_col: str, order_cols: list[str], out_col: str,
                 partitions: int | None = None) -> DataFrame:
    """Forward fill along a total order of the whole table (``order_cols`` must be unique).

    Range partitions are the blocks; they are checkpointed so that the block and row
    positions seen by the local fill and by the carry table are the same.
    """
    ranged = (df.repartitionByRange(*([partitions] if partitions else []), *order_cols).sortWithinPartitions(*order_cols)
              .withColumn("_blk", F.spark_partition_id())
              .withColumn("_pos", F.monotonically_increasing_id()))
    ranged = cut_lineage(ranged)
    return fill_down_blocks(ranged, value_col, out_col, ["_blk"], "_pos").drop("_blk", "_pos")


def fill_down_scan(table: DataFrame, value_col: str, out_col: str, group_col: str,
                   block_col: str, pos_col: str) -> DataFrame:
    """Forward fill of a written table whose rows know their place: no shuffle of the rows.

    Every value holds from its place to the next one of its split; what a split begins with
    comes from the splits before it. These intervals are cut at multiples of a power of two
    (about the rows between two values), so a row finds its interval by an equi-join on
    (split, piece) with few candidates. The intervals are few against the rows and are
    broadcast after counting them; beyond the limit the join is a shuffle join.
    """
    rows = table.withColumn("_g", F.xxhash64(group_col))
    known = F.col(value_col).isNotNull()
    splits = cut_lineage(rows.groupBy("_g", block_col).agg(
        F.min(pos_col).alias("_lo"), F.max(pos_col).alias("_hi"), F.count(F.lit(1)).alias("_n"),
        F.count(value_col).alias("_values"),
        F.max_by(value_col, F.when(known, F.col(pos_col))).alias("_last")), "fill-blocks")
    earlier = (Window.partitionBy("_g").orderBy(block_col)
               .rowsBetween(Window.unboundedPreceding, -1))
    carried = splits.select("_g", block_col, (F.col("_lo") - 1).alias("_from"), "_hi",
                            F.last("_last", ignorenulls=True).over(earlier).alias("_value"))
    own = (rows.where(known).select("_g", block_col, F.col(pos_col).alias("_from"),
                                    F.col(value_col).alias("_value"))
           .join(splits.select("_g", block_col, "_hi"), ["_g", block_col]))
    following = F.lead("_from").over(Window.partitionBy("_g", block_col).orderBy("_from"))
    size = splits.agg(F.sum("_n").alias("n"), F.sum("_values").alias("v"),
                      F.count(F.lit(1)).alias("s")).first()
    bits = int(math.log2(max(1, (size["n"] or 1) // max(1, size["v"] or 1))))
    pieces = 3 * ((size["v"] or 0) + size["s"])          # upper bound: rows / 2^bits <= 2 values
    spans = (carried.unionByName(own)
             .withColumn("_to", F.coalesce(following - 1, F.col("_hi")))
             .where((F.col("_to") >= F.col("_from")) & F.col("_value").isNotNull())
             .withColumn("_piece", F.explode(F.sequence(F.shiftright("_from", bits),
                                                        F.shiftright("_to", bits))))
             .select(F.col("_g").alias("_sg"), F.col(block_col).alias("_sb"), "_piece", "_from",
                     "_to", "_value"))
    if pieces <= MAX_BROADCAST_BLOCKS:
        spans = F.broadcast(spans)
    place = F.col(pos_col)
    return (rows.join(spans, (F.col("_g") == F.col("_sg")) & (F.col(block_col) == F.col("_sb"))
                      & (F.shiftright(place, bits) == F.col("_piece"))
                      & (place >= F.col("_from")) & (place <= F.col("_to")), "left")
            .select(*table.columns, F.col("_value").alias(out_col)))
