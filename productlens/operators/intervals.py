"""Range join of points and half-open intervals, as an equi-join on bins.

An interval of length d goes to the level whose bins are 2^level >= d long, so
it meets at most two of them, whatever its length; a point has one bin at each
level that occurs (at most 63, in practice a few). Points and intervals join on
(keys, level, bin), a sort-merge join that Spark spreads over tasks (asked for,
as Spark's size estimates don't count exploded rows and the bins would be
broadcast at any size), and the bounds are checked after it. A pair meets in one bin only, so no pair
is found twice, and no nested loop is planned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _bin(at: Column, level: Column) -> Column:
    return F.call_function("shiftright", at, level)  # floor(at / 2^level), for negative values too


def range_join(points: DataFrame, intervals: DataFrame, at: str, start: str, end: str,
               keys: tuple[str, ...] = ()) -> DataFrame:
    """Every pair with start <= at < end (longs) and equal ``keys``; column names must differ but for the keys.

    Rows with a NULL bound, point or key, and intervals without extent, pair with nothing.
    """
    level = F.length(F.bin(F.col(end) - F.col(start) - 1)).cast("int")  # the smallest with 2^level >= length
    placed = (intervals.where(F.col(end) > F.col(start)).withColumn("_level", level)
              .withColumn("_bin", F.explode(F.sequence(_bin(F.col(start), F.col("_level")), _bin(F.col(end) - 1, F.col("_level"))))))
    levels = sorted(r[0] for r in placed.select("_level").distinct().collect())  # at most 64 numbers
    if not levels:
        levels = [0]
    spread = (points.where(F.col(at).isNotNull()).withColumn("_level", F.explode(F.array(*[F.lit(x) for x in levels])))
              .withColumn("_bin", _bin(F.col(at), F.col("_level"))))
    return (spread.join(placed.hint("merge"), [*keys, "_level", "_bin"])
            .where((F.col(at) >= F.col(start)) & (F.col(at) < F.col(end))).drop("_level", "_bin"))
