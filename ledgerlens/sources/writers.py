"""Sinks: CSV exports written in parallel, one file per task."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Formats that keep microseconds (the default CSV format keeps milliseconds only).
CSV_TIME_FORMATS = {
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
}

# Spaces around text are part of it, quotes are doubled, empty text is quoted and null is not.
CSV_TEXT = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "escape": '"'}

# Fixed value: rows a query result may have when exported from the SQL page.
RESULT_CAP = 1000


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write headed CSV without losing sub-millisecond time, spaces or empty text.

    Text with line breaks is quoted; `read_csv(..., multiLine=True)` reads it back.
    """
    df.write.mode(mode).option("header", True).options(**CSV_TIME_FORMATS, **CSV_TEXT).csv(path)


def export_result(df: DataFrame, path: str, limit: int | None = None, mode: str = "errorifexists") -> None:
    """Export a query result: every row, or the first `limit` (the interactive page exports RESULT_CAP)."""
    write_csv(df if limit is None else df.limit(limit), path, mode)


def flatten_predictions(df: DataFrame, positive: str = "p_fraud") -> DataFrame:
    """Make scored rows fit for a flat file: every vector as JSON text, and P(fraud) as a number."""
    columns = []
    for field in df.schema:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, VectorUDT):
            columns.append(F.to_json(vector_to_array(c)).alias(field.name))
        else:
            columns.append(c)
    if "probability" in df.columns and positive not in df.columns:
        columns.append(vector_to_array("probability")[1].alias(positive))
    return df.select(*columns)


def export_predictions(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Export every scored row."""
    write_csv(flatten_predictions(df), path, mode)
