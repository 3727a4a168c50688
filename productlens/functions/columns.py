"""Column-expression helpers (all JVM-side built-ins, no Python UDFs)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from productlens import config

MICROS_PER_SECOND = 1_000_000
MICROS_PER_DAY = 86_400 * MICROS_PER_SECOND


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def standardise(c: str | Column, allowed: Sequence[str], unknown: str = config.UNKNOWN) -> Column:
    """Value when it is in ``allowed``, otherwise ``unknown`` (NULL included)."""
    c = col(c)
    return F.when(c.isin(*allowed), c).otherwise(F.lit(unknown))


def out_of_domain(c: str | Column, allowed: Sequence[str]) -> Column:
    """``NOT IN`` flag; stays NULL for NULL input (three-valued logic)."""
    return ~col(c).isin(*allowed)


def micros_between(end: str | Column, start: str | Column) -> Column:
    """Exact difference of two timestamps in microseconds (bigint)."""
    return F.unix_micros(col(end)) - F.unix_micros(col(start))


def epoch_seconds_rounded(end: str | Column, start: str | Column) -> Column:
    """Seconds between two timestamps, rounded half away from zero to a bigint.

    A numeric-to-bigint cast rounds; Spark's cast truncates, so round in
    decimal first.
    """
    us = micros_between(end, start).cast("decimal(20,0)")
    return F.round(us / F.lit(MICROS_PER_SECOND).cast("decimal(20,0)"), 0).cast("bigint")


def days_between(end: str | Column, start: str | Column, scale: int = 2) -> Column:
    """(end - start) in days, exact decimal, rounded half away from zero."""
    us = micros_between(end, start).cast("decimal(20,0)")
    return F.round(us / F.lit(MICROS_PER_DAY).cast("decimal(20,0)"), scale)


def week_start(c: str | Column) -> Column:
    """Monday of the timestamp's week, as a date."""
    return F.date_trunc("week", col(c)).cast("date")


def month_start(c: str | Column) -> Column:
    return F.date_trunc("month", col(c)).cast("date")


def month_diff(later: str | Column, earlier: str | Column) -> Column:
    """Signed calendar-month difference (integer year/month arithmetic)."""
    later, earlier = col(later), col(earlier)
    return ((F.year(later) - F.year(earlier)) * 12 + (F.month(later) - F.month(earlier))).cast("int")


def rollout_bucket(user_id: str | Column, resolution: int = config.BUCKET_RESOLUTION) -> Column:
    """Deterministic user bucket in [0, resolution): first 32 bits of md5, mod resolution."""
    h = F.conv(F.substring(F.md5(col(user_id)), 1, 8), 16, 10).cast("bigint")
    return F.pmod(h, F.lit(resolution)).cast("int")


def engagement_tier(sessions: str | Column, tiers=config.ENGAGEMENT_TIERS) -> Column:
    """Bucket a session count into the configured tier labels.

    The open-ended last tier is the ELSE branch, so anything the earlier
    tiers do not match (a NULL count included) falls into it.
    """
    c = col(sessions)
    expr = None
    for label, lo, hi in tiers:
        if hi is None:
            return expr.otherwise(F.lit(label)) if expr is not None else F.lit(label)
        cond = c <= hi if lo is None else c.between(lo, hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def pct(numerator: str | Column, denominator: str | Column, scale: int = 2) -> Column:
    """100 * n / d in exact decimal, rounded; NULL when d is 0."""
    n = col(numerator).cast("decimal(20,0)")
    d = col(denominator).cast("decimal(20,0)")
    return F.when(d == 0, F.lit(None)).otherwise(F.round(F.lit(100).cast("decimal(3,0)") * n / d, scale))


def ratio(numerator: str | Column, denominator: str | Column) -> Column:
    """n / d as double, NULL when d is 0 (safe under ANSI mode)."""
    d = col(denominator)
    return F.when(d == 0, F.lit(None)).otherwise(col(numerator).cast("double") / d.cast("double"))


def literal_frame(spark, rows, schema):
    """A small constant table built JVM-side (no Python worker at execution).

    ``schema`` is a StructType or a DDL string; ``rows`` are tuples in field order.
    """
    from pyspark.sql import types as T

    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, schema.fields)])
               for row in rows]
    if not structs:
        return spark.createDataFrame([], schema)
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*structs))).select(
        *[F.col(f.name).cast(f.dataType) for f in schema.fields])
