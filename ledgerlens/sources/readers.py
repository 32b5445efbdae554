"""Sources: CSV and Parquet transaction tables, and the SQL view over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ledgerlens.schema import TRANSACTION_SCHEMA

# Doubled quotes, and null only for a cell with nothing in it: the marker, which stands for such a cell
# while parsing, is no text that a file holds.
CSV_TEXT = {"escape": '"', "nullValue": "\u0000null", "emptyValue": ""}


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = TRANSACTION_SCHEMA,
    infer: bool = False,
    **options,
) -> DataFrame:
    """Scan headed CSV files; `path` may be a file, a folder, a glob or a list of them.

    The declared schema spares the extra pass over the data that `infer=True` costs, and lets Spark
    skip unwanted fields while parsing. Files stay splittable unless `multiLine=True` allows line breaks
    in quoted text. Cells with nothing in them are null, `""` is empty text. `mode="FAILFAST"` makes a
    broken row an error; it becomes nulls otherwise. `options` are Spark's, and override these.
    """
    reader = spark.read.options(**{"header": True, **CSV_TEXT, **options})
    if infer:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).option("enforceSchema", False).csv(path)


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    """Scan Parquet files; filters and column selection reach the scan."""
    return spark.read.parquet(*paths)


def register(df: DataFrame, name: str = "transactions") -> DataFrame:
    """Make `df` visible to SQL under `name`."""
    df.createOrReplaceTempView(name)
    return df
