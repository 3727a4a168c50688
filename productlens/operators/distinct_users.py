"""Distinct users that roll up: summary cells with stored bitmaps of their users.

A count of distinct users cannot be summed over cells that share users; the union of their bitmaps can be counted. Users
are numbered 0, 1, 2, ... in the order of their attributes, so the users of a cell have numbers close together. A cell keeps
one bitmap of 32,768 bits (4 KB) for each block of numbers in which it has users, whatever their count. Any subset of the
cell's keys then gives exact distinct users by ``bitmap_or_agg`` over the stored rows, without the users themselves.

Scale notes
-----------
Numbering is one range shuffle of the users (no window over them: a partition numbers its own rows, and the partitions'
totals, one row each, give the offsets). Building the bitmaps aggregates partially into fixed buffers before the shuffle, so
a cell with a third of all users sends a few blocks a task. A roll-up reads the stored rows only.

Users without id count for no one, as in COUNT(DISTINCT ...); their revenue counts. Repeated rows of a user count once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from productlens.operators.revenue import SUMMARY_KEYS, arpu
from productlens.session import checkpoint_dir

#: what ``monotonically_increasing_id`` leaves for a partition's rows
ROW_BITS = 33


def numbered_users(users: DataFrame, attributes) -> DataFrame:
    """(user_id, number): a number without gaps for each user of ``users``, in the order of the ``attributes``.

    The numbers are checkpointed, so that a lost task cannot deal them anew.
    """
    one = users.filter(F.col("user_id").isNotNull()).groupBy("user_id").agg(*[F.min(a).alias(a) for a in attributes])
    checkpoint_dir(users.sparkSession)
    placed = (one.repartitionByRange(*attributes, "user_id").sortWithinPartitions(*attributes, "user_id")
              .select("user_id", F.monotonically_increasing_id().alias("_row")).checkpoint(eager=True))
    part = F.shiftright("_row", ROW_BITS)
    own = F.col("_row").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))  # a row for each partition
               .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")))
    return (placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
            .select("user_id", (F.col("_offset") + own).alias("number")))


def impact_bitmaps(user_revenue: DataFrame, keys=SUMMARY_KEYS, by_month: str = "revenue_month") -> DataFrame:
    """(keys..., block, total_revenue_usd, users_bits): a row for each cell and block of user numbers that it has users in."""
    numbers = numbered_users(user_revenue, [k for k in keys if k != by_month])
    rows = user_revenue.select("user_id", "revenue_usd", *keys).join(numbers, "user_id", "left")
    return (rows.groupBy(*keys, F.bitmap_bucket_number("number").alias("block"))
            .agg(F.sum("revenue_usd").alias("total_revenue_usd"),
                 F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("users_bits")))


def rolled_up(bitmaps: DataFrame, *keys: str) -> DataFrame:
    """(keys..., total_revenue_usd, users, arpu_usd) of ``impact_bitmaps`` by a subset of its keys; without keys one row."""
    blocks = bitmaps.groupBy(*keys, "block").agg(
        F.sum("total_revenue_usd").alias("total_revenue_usd"),
        F.bitmap_count(F.bitmap_or_agg("users_bits")).alias("users"))
    total = blocks.groupBy(*keys).agg(F.sum("total_revenue_usd").alias("total_revenue_usd"), F.sum("users").alias("users"))
    return total.withColumn("arpu_usd", arpu("total_revenue_usd", "users"))
