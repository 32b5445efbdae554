"""Profiles kept per part of a table (a day, a load) and merged without reading the data again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators.profile import _as_key, missing, numeric_columns

# Sketches have 2 ** LG_SKETCH slots; their counts are off by ERROR (one standard error, relative) or so.
LG_SKETCH = 14
ERROR = 1.04 / 2 ** (LG_SKETCH / 2)


def _hashed(df: DataFrame, column: str) -> Column:
    """One 64-bit number per value, null for null; zero has one sign."""
    family, value = _as_key(df, column)
    return F.when(value.isNotNull(), F.xxhash64(value + F.lit(0.0) if family == "fraction" else value))


def partial_profile(df: DataFrame, columns: list[str] | None = None, by: str | None = None) -> DataFrame:
    """part, column, count, missing, mean, squares, min, max, values: a small row for each column of each part.

    `by` names the column that parts the rows (null is a part), without it all are one part. `squares` is the
    sum of squared differences from the mean, `values` a sketch of the different values. One pass over the table,
    combined within tasks. Write the rows out; `merge_profiles` needs nothing else.
    """
    chosen = numeric_columns(df) if columns is None else columns
    part = F.lit(None).cast("string") if by is None else F.col(by).cast("string")
    cells = [
        F.struct(
            F.lit(c).alias("column"),
            F.count(c).alias("count"),
            missing(c).alias("missing"),
            F.avg(c).alias("mean"),
            (F.var_pop(c) * F.count(c)).alias("squares"),
            F.min(F.col(c).cast("double")).alias("min"),
            F.max(F.col(c).cast("double")).alias("max"),
            F.hll_sketch_agg(_hashed(df, c), LG_SKETCH).alias("values"),
        )
        for c in chosen
    ]
    return df.groupBy(part.alias("part")).agg(F.array(*cells).alias("cells")).select("part", F.inline("cells"))


def merge_profiles(parts: DataFrame) -> DataFrame:
    """column, count, missing, mean, stddev, min, max, distinct of all the given rows of `partial_profile` together.

    Counts, extremes and moments are those of the whole table (moments up to rounding). `distinct` counts null as a
    value and is approximate, see ERROR; merging adds no error. Parts must not overlap.
    """
    means = parts.groupBy("column").agg(
        F.sum("count").alias("count"),
        F.sum("missing").alias("missing"),
        F.try_divide(F.sum(F.col("mean") * F.col("count")), F.sum("count")).alias("mean"),
        F.min("min").alias("min"),
        F.max("max").alias("max"),
        F.hll_sketch_estimate(F.hll_union_agg("values")).alias("values"),
    )
    about = means.select("column", F.col("mean").alias("of_all"))
    apart = F.col("squares") + F.col("count") * F.pow(F.col("mean") - F.col("of_all"), 2)
    squares = parts.join(about, "column").groupBy("column").agg(F.sum(apart).alias("squares"))
    return means.join(squares, "column").select(
        "column",
        "count",
        "missing",
        "mean",
        F.sqrt(F.try_divide("squares", F.when(F.col("count") > 1, F.col("count") - 1))).alias("stddev"),
        "min",
        "max",
        (F.col("values") + (F.col("missing") > 0).cast("bigint")).alias("distinct"),
    )
