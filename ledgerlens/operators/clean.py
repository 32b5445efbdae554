"""Cleaning: fill, parse, de-duplicate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.schema import TIME
from ledgerlens.scratch import durable

# What stands in for a missing category.
FILL_VALUES = {"device_type": "unknown"}


def fill_missing(df: DataFrame, values: dict[str, str] | None = None) -> DataFrame:
    """Replace nulls column by column; names the table does not have are passed over."""
    values = FILL_VALUES if values is None else values
    present = {name: value for name, value in values.items() if name in df.columns}
    return df.fillna(present) if present else df


def parse_time(
    df: DataFrame, column: str = TIME, strict: bool = False, fmt: str | None = None, zoned: bool = False
) -> DataFrame:
    """Turn text into timestamps. Unreadable text becomes null, or an error with `strict`.

    They have no zone, so the hour is the one written in the text whatever the session's zone;
    `zoned=True` gives instants instead; a format that reads a zone needs it.

    A column that already holds timestamps is left as it is (parsing a zone-less one would give it a zone).
    """
    if isinstance(df.schema[column].dataType, (T.TimestampType, T.TimestampNTZType)):
        return df
    text = F.col(column)
    if zoned:
        parsed = F.to_timestamp(text, fmt) if strict else F.try_to_timestamp(text, *([F.lit(fmt)] if fmt else []))
    elif fmt is None:
        parsed = text.cast("timestamp_ntz") if strict else text.try_cast("timestamp_ntz")
    elif strict:
        parsed = F.to_timestamp_ntz(text, F.lit(fmt))
    else:  # Spark's only forgiving parser of formats gives instants: read them, and show them, at +00:00
        instant = F.try_to_timestamp(F.concat(text, F.lit(" +00:00")), F.lit(f"{fmt} xxx"))
        micros, million = F.unix_micros(instant).cast("decimal(20,0)"), F.lit(10**6).cast("decimal(7,0)")
        since = F.make_dt_interval(secs=(micros / million).cast("decimal(18,6)"))
        parsed = F.lit("1970-01-01").cast("timestamp_ntz") + since
    return df.withColumn(column, parsed)


def drop_exact_duplicates(df: DataFrame, screen: bool = False) -> DataFrame:
    """Keep one of each group of rows that agree in every column, nulls included.

    The plain form is one aggregate over all columns: lazy, but it shuffles whole rows, keeps any column
    from being pruned, and does so again in every later action.

    `screen=True`, for wide tables with few repeats, first runs one job that shuffles only a 64-bit hash
    per row and writes out the hashes that occur more than once. Equal rows have equal hashes, so every
    other row is unique; only the noted ones are compared column by column. The joins to the notes carry
    no hint: Spark broadcasts them while they are small and shuffles beyond. The input is read again, so
    it must give the same rows on every read. Without repeats the table is returned as
    it is. Streams always take the plain form.

    In both forms copies combine within a task before the shuffle, however often a row is repeated.
    """
    if df.isStreaming or not screen:
        return df.dropDuplicates()
    mark = F.xxhash64(*[F.col(f"`{name}`") for name in df.columns])
    counted = df.groupBy(mark.alias("_mark")).agg(F.count(F.lit(1)).alias("n"))
    repeated = durable(counted.where(F.col("n") > 1).select("_mark"))
    if repeated.isEmpty():
        return df
    marked = df.withColumn("_mark", mark)
    unique = marked.join(repeated, "_mark", "left_anti").select(*df.columns)
    copies = marked.join(repeated, "_mark", "left_semi").select(*df.columns)
    return unique.union(copies.dropDuplicates())


def clean(df: DataFrame, strict: bool = False, screen: bool = False) -> DataFrame:
    """Fill, then parse, then de-duplicate."""
    filled = df.transform(fill_missing).transform(parse_time, strict=strict)
    return drop_exact_duplicates(filled, screen)
