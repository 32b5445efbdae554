"""Time arithmetic that does not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Microseconds per unit.
MICROS = {"DAY": 86_400_000_000, "HOUR": 3_600_000_000, "MINUTE": 60_000_000, "SECOND": 1_000_000}


def epoch_micros(ts: Column, dtype: T.DataType) -> Column:
    """Microseconds since 1970-01-01. A zone-less timestamp is measured on its own wall clock."""
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(ts)
    since = ts - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    parts = [
        (F.extract(F.lit(unit), since) * F.lit(size).cast("bigint")).cast("bigint")
        for unit, size in MICROS.items()
    ]
    return parts[0] + parts[1] + parts[2] + parts[3]
