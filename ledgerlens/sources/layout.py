"""Tables laid out by day, and facts that Parquet footers hold."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.schema import TIME

DAY = "day"
# Rows of one file at most.
FILE_ROWS = 5_000_000


def write_by_day(
    df: DataFrame, path: str, time: str = TIME, file_rows: int = FILE_ROWS, mode: str = "errorifexists"
) -> None:
    """Write Parquet in a folder per day (`day=2024-01-31`), each in files of at most `file_rows` rows.

    Rows are rebalanced by day first, so that a day is not scattered over a file from every task; adaptive execution
    splits a day that is large and puts small ones together. Rows without a time go to a folder of their own.
    """
    if DAY in df.columns:
        raise ValueError(f"the table has a column {DAY}, which names the folders")
    dated = df.withColumn(DAY, F.to_date(F.col(time))).hint("rebalance", DAY)
    dated.write.mode(mode).option("maxRecordsPerFile", file_rows).partitionBy(DAY).parquet(path)


def read_days(spark: SparkSession, path: str, first: date | str, last: date | str) -> DataFrame:
    """The rows of `write_by_day` from `first` to `last`, both included; the folders of other days are not opened."""
    rows = spark.read.parquet(path)
    bounds = [F.lit(str(d)).cast("date") for d in (first, last)]
    return rows.where(F.col(DAY).between(*bounds)).drop(DAY)


def parquet_ranges(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """column, rows, min, max of number columns as doubles, from the footers of the Parquet files: no row is read.

    Rows are counted with and without values. The aggregate is pushed into Spark's file source, in a session of its own, so that
    the settings this takes stay there. Infinities are values; NaN is left out where the writer left it out.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.sources.useV1SourceList", "")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    facts = session.read.parquet(path).agg(
        F.count(F.lit(1)).alias("rows"),
        *[f(c).alias(f"{name}_{c}") for c in columns for name, f in (("min", F.min), ("max", F.max))],
    )
    cells = [
        F.struct(
            F.lit(c).alias("column"),
            F.col("rows").alias("rows"),
            F.col(f"min_{c}").cast("double").alias("min"),
            F.col(f"max_{c}").cast("double").alias("max"),
        )
        for c in columns
    ]
    return facts.select(F.inline(F.array(*cells)))
