"""Projection of a result for value comparison with an external SQL engine.

Timestamps become ``<name>_us`` (bigint microseconds since the epoch, UTC)
and decimals become doubles, so results compare without time-zone or
decimal-width differences. All other types pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def rounded(df: DataFrame, digits: int) -> DataFrame:
    """Floating-point columns to ``digits`` decimals."""
    return df.select(*[F.round(f.name, digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
                       for f in df.schema.fields])


def for_check(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            cols.append(F.unix_micros(c.cast("timestamp")).alias(f"{f.name}_us"))
        elif isinstance(f.dataType, T.DecimalType):
            cols.append(c.cast("double").alias(f.name))
        else:
            cols.append(c)
    return df.select(*cols)
