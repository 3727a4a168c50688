"""Contiguous shards of nearly equal bytes.

All rows are put in one order (hash of the text, id, a row number), so equal texts lie next to each other. A range
partitioning spreads that order over tasks; a running sum within each partition plus the totals of the partitions
before it gives every row its global byte offset, and the shard is the equal part of all bytes in which the middle
of the row falls. Only DataFrame functions run; the text is read once and left behind, the rest moves about 50 bytes
a row. A hot text is no hot task: the order goes on by id and row number, so ranges cut through its copies.

A shard's bytes differ from the equal part by less than the largest row. Copies of a text share a shard unless one of
the cuts falls among them. NULL texts count as empty and NULL ids sort first; repeated rows are rows of their own; an
empty table gives an empty result. Other input columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from productlens.llm.tasks import drop_folder, written


def shard_by_bytes(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, size, text_crc32, shard, slot) of every row: shard from 0, slot from 0 without gaps in each shard."""
    data = F.coalesce(docs[text_col], F.lit("")).cast("binary")
    rows, rows_path = written(
        docs.select(docs[id_col].alias("id"), (F.octet_length(data) + 1).cast("long").alias("size"),
                    F.crc32(data).alias("crc"), F.xxhash64(data).alias("h"), F.monotonically_increasing_id().alias("n")),
        "shard-rows")
    # written, so that every later read sees the same partitions
    ranged, ranged_path = written(
        rows.repartitionByRange("h", "id", "n").withColumn("part", F.spark_partition_id()), "shard-ranges")
    drop_folder(docs.sparkSession, rows_path)

    own = Window.partitionBy("part").orderBy("h", "id", "n").rowsBetween(Window.unboundedPreceding, -1)
    inside = ranged.select("*", F.coalesce(F.sum("size").over(own), F.lit(0)).alias("bytes_before"),
                           F.count(F.lit(1)).over(own).alias("rows_before"))
    # one row per partition from here on
    totals = ranged.groupBy("part").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing).orderBy("part")
    offsets = totals.select(
        "part", F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("part_bytes"),
        F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("part_rows"),
        F.sum("bytes").over(everything).alias("all_bytes"))
    placed, _ = written(
        inside.join(F.broadcast(offsets), "part").select(
            "id", "size", "crc", (F.col("part_rows") + F.col("rows_before")).alias("place"),
            # the row's middle as a part of all bytes; decimal, as the product may pass 63 bits
            F.expr(f"cast(cast(2 * (part_bytes + bytes_before) + size as decimal(20, 0)) * {int(shards)}"
                   " div (2 * all_bytes) as int)").alias("shard")), "shard-places")
    drop_folder(docs.sparkSession, ranged_path)
    # one row per shard
    first = placed.groupBy("shard").agg(F.min("place").alias("first"))
    return placed.join(F.broadcast(first), "shard").select(
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), "shard",
        (F.col("place") - F.col("first")).alias("slot"))
