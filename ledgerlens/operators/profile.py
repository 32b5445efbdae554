"""Column profiles. Every function is one aggregate over the table, whatever the number of columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Histogram bins, and the distinct values above which a histogram replaces value counts.
BINS = 20
VALUE_COUNT_LIMIT = 10

# Times inside nested values, to the microsecond.
JSON_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def _columns_of(df: DataFrame, kind: type[T.DataType]) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, kind)]


def numeric_columns(df: DataFrame) -> list[str]:
    """Names of the numeric columns, in table order."""
    return _columns_of(df, T.NumericType)


def column_type(df: DataFrame, column: str) -> str:
    """Spark's short name for the type of `column`."""
    return df.schema[column].dataType.simpleString()


def _one_row_per_column(df: DataFrame, rows: list[Column]) -> DataFrame:
    """Aggregate `rows` (structs) in one pass and lay them out as rows."""
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def row_count(df: DataFrame) -> DataFrame:
    """Number of rows, as a one-row table."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def missing(column: str) -> Column:
    """Aggregate: nulls in `column`."""
    return F.count_if(F.col(column).isNull())


def _as_key(df: DataFrame, column: str) -> tuple[str, Column]:
    """(family, value): whole numbers, fractions and everything else, so that no two values merge."""
    dtype = df.schema[column].dataType
    if isinstance(dtype, T.IntegralType):
        return "whole", F.col(column).cast("bigint")
    if isinstance(dtype, T.FractionalType) and not isinstance(dtype, T.DecimalType):
        return "fraction", F.col(column).cast("double")
    if isinstance(dtype, T.TimestampType):  # as text, the hour that clocks repeat would merge
        return "whole", F.unix_micros(column)
    if isinstance(dtype, (T.ArrayType, T.StructType, T.MapType)):
        return "text", F.when(F.col(column).isNotNull(), F.to_json(F.struct(F.col(column)), JSON_TIMES))
    return "text", F.hex(column) if isinstance(dtype, T.BinaryType) else F.col(column).cast("string")


def _exact_distinct(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row with the number of different values of each column, null being one of them.

    The table is turned into narrow (column number, value) rows, which combine within tasks before their
    one shuffle. Several `count_distinct` in one aggregate would carry all columns in every such row.
    """
    keys = [_as_key(df, c) for c in columns]
    families = {"whole": "bigint", "fraction": "double", "text": "string"}
    used = [f for f in families if f in {family for family, _ in keys}]
    cells: list[Column] = []
    for number, (family, value) in enumerate(keys):
        cells += [F.lit(number), *[value if f == family else F.lit(None).cast(families[f]) for f in used]]
    values = df.select(F.stack(F.lit(len(columns)), *cells).alias("number", *used)).distinct()
    return values.agg(*[F.count_if(F.col("number") == i).alias(c) for i, c in enumerate(columns)])


def _distinct(df: DataFrame, columns: list[str], approx: bool) -> dict[str, Column]:
    """Expression per column for use in an aggregate over `df`."""
    if not approx:
        counts = _exact_distinct(df, columns)
        row = counts.select(F.struct(*[F.col(f"`{c}`") for c in columns])).scalar()
        return {c: row[c] for c in columns}
    return {
        c: F.approx_count_distinct(c) + F.coalesce(F.max(F.col(c).isNull()).cast("bigint"), F.lit(0))
        for c in columns
    }


def column_overview(df: DataFrame) -> DataFrame:
    """Position, name, type and null count of every column."""
    return _one_row_per_column(
        df,
        [
            F.struct(
                F.lit(position).alias("position"),
                F.lit(name).alias("column"),
                F.lit(column_type(df, name)).alias("type"),
                missing(name).alias("missing"),
            )
            for position, name in enumerate(df.columns)
        ],
    )


def distinct_count(df: DataFrame, *columns: str, approx: bool = False) -> DataFrame:
    """Different values per column, null counted as one; `approx` keeps a sketch instead of the values."""
    if approx:
        counts = df.agg(*[value.alias(c) for c, value in _distinct(df, list(columns), True).items()])
    else:
        counts = _exact_distinct(df, list(columns))
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("distinct")) for c in columns]
    return counts.select(F.inline(F.array(*rows)))


def missing_count(df: DataFrame, *columns: str) -> DataFrame:
    """Nulls per column."""
    return _one_row_per_column(
        df, [F.struct(F.lit(c).alias("column"), missing(c).alias("missing")) for c in columns]
    )


def _moments(df: DataFrame, column: str) -> list[Column]:
    """`min` and `max` are doubles; whole and decimal numbers also have theirs digit by digit, as text."""
    value = F.col(column)
    digits = isinstance(df.schema[column].dataType, (T.IntegralType, T.DecimalType))
    exact = lambda v: (v if digits else F.lit(None)).cast("string")
    return [
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("stddev"),
        F.min(value).cast("double").alias("min"),
        F.max(value).cast("double").alias("max"),
        exact(F.min(value)).alias("exact_min"),
        exact(F.max(value)).alias("exact_max"),
    ]


def column_stats(df: DataFrame, *columns: str) -> DataFrame:
    """Mean, sample deviation, minimum and maximum per column; null where there is no value."""
    return _one_row_per_column(df, [F.struct(F.lit(c).alias("column"), *_moments(df, c)) for c in columns])


def describe_numbers(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Table summary of the numeric columns in long form (`df.describe()` returns text cells)."""
    chosen = numeric_columns(df) if columns is None else columns
    return _one_row_per_column(
        df, [F.struct(F.lit(c).alias("column"), F.count(c).alias("count"), *_moments(df, c)) for c in chosen]
    )


def describe_text(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Table summary of the text columns: filled cells, first and last value in sort order."""
    chosen = _columns_of(df, T.StringType) if columns is None else columns
    return _one_row_per_column(
        df,
        [
            F.struct(
                F.lit(c).alias("column"),
                F.count(c).alias("count"),
                F.min(c).alias("min"),
                F.max(c).alias("max"),
            )
            for c in chosen
        ],
    )


def column_profile(df: DataFrame, columns: list[str] | None = None, approx: bool = False) -> DataFrame:
    """Type, distinct, missing, mean, deviation, minimum and maximum of each numeric column.

    One aggregate without a shuffle of values gives everything but the exact distinct counts, which are
    a scalar subquery of their own (see `_exact_distinct`); `approx=True` makes them small sketches in
    that same aggregate.
    """
    chosen = numeric_columns(df) if columns is None else columns
    distinct = _distinct(df, chosen, approx)
    return _one_row_per_column(
        df,
        [
            F.struct(
                F.lit(c).alias("column"),
                F.lit(column_type(df, c)).alias("type"),
                distinct[c].alias("distinct"),
                missing(c).alias("missing"),
                *_moments(df, c),
            )
            for c in chosen
        ],
    )


def _usable(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) != float("inf"))


def _span(low: Column, high: Column, bins: int) -> tuple[Column, Column, Column]:
    """(start, end, bin width); a constant column sits in the middle of a unit-wide range."""
    flat = low == high
    start, end = F.when(flat, low - 0.5).otherwise(low), F.when(flat, high + 0.5).otherwise(high)
    return start, end, (end - start) / bins


def _bin_of(value: Column, low: Column, high: Column, bins: int) -> Column:
    """Equal-width bin of `value`; the last bin is closed."""
    start, _, width = _span(low, high, bins)
    return F.least(F.floor((value - start) / width), F.lit(bins - 1)).cast("int")


def _edges(number: Column, low: Column, high: Column, bins: int) -> tuple[Column, Column]:
    """Lower and upper edge of bin `number`."""
    start, end, width = _span(low, high, bins)
    return start + number * width, F.when(number == bins - 1, end).otherwise(start + (number + 1) * width)


def _counts_of_bins() -> Column:
    """Aggregate over (bin, n) rows, of which there are at most as many as bins: a map from one to the other."""
    return F.map_from_entries(F.collect_list(F.when(F.col("bin").isNotNull(), F.struct("bin", "n"))))


def histogram(
    df: DataFrame, column: str, bins: int = BINS, span: tuple[float, float] | None = None
) -> DataFrame:
    """bin, low, high, n of every equal-width bin between the smallest and the largest value, also of
    empty bins. Nulls, NaN and infinities are left out; without other values there are no rows.

    Two passes over one column: the range is an uncorrelated scalar subquery, so the second pass sees
    it as a constant. Counts combine within tasks, and one row of at most `bins` counts is laid out as rows. A known
    `span` (smallest and largest value, such as `parquet_ranges` gives) spares the first pass.
    """
    value = F.col("value")
    values = df.select(F.col(column).cast("double").alias("value")).where(_usable(value))
    if span is None:
        facts = values.agg(F.struct(F.min(value).alias("low"), F.max(value).alias("high"))).scalar()
        low, high = facts["low"], facts["high"]
    else:
        low, high = F.lit(float(span[0])), F.lit(float(span[1]))
    counted = values.groupBy(_bin_of(value, low, high, bins).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    rows = (
        counted.agg(F.sum("n").alias("rows"), _counts_of_bins().alias("found"))
        .where(F.col("rows") > 0)
        .select("found", low.alias("first"), high.alias("last"), F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    )
    number = F.col("bin")
    low_edge, high_edge = _edges(number, F.col("first"), F.col("last"), bins)
    n = F.coalesce(F.try_element_at("found", number), F.lit(0)).cast("bigint")
    return rows.select("bin", low_edge.alias("low"), high_edge.alias("high"), n.alias("n"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value (null included), most frequent first."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), F.asc(column))


def profile_distribution(
    df: DataFrame, column: str, threshold: int = VALUE_COUNT_LIMIT, bins: int = BINS
) -> DataFrame:
    """A histogram when `column` has more than `threshold` different values, else its value counts.

    One result shape serves both: `kind`, `bin`, `low`, `high` (histogram, empty bins included), `value`
    (value counts, in the column's own type), `n`. The first pass keeps the range and a sketch of the values that is
    exact as long as fewer are different than it holds, which is more than `threshold`. The second counts bins, or the
    few values, inside tasks: values are never shuffled, however many there are. The choice is made while the query
    runs, not by an action beforehand.
    """
    if column not in numeric_columns(df):
        raise ValueError(f"{column} is not numeric; use value_counts")
    values = df.select(F.col(column).alias("value"))
    family, key = _as_key(values, "value")
    number = F.col("value").cast("double")
    sketched = key + F.lit(0.0) if family == "fraction" else key  # zero has one sign
    facts = values.agg(
        F.struct(
            F.theta_sketch_estimate(F.theta_sketch_agg(sketched, max(12, threshold.bit_length() + 1))).alias("different"),
            F.coalesce(F.max(F.col("value").isNull().cast("int")), F.lit(0)).alias("null"),
            F.min(F.when(_usable(number), number)).alias("low"),
            F.max(F.when(_usable(number), number)).alias("high"),
        )
    ).scalar()
    many = facts["different"] + facts["null"] > threshold
    counted = (
        values.where(~many | _usable(number))
        .groupBy(
            F.when(many, _bin_of(number, facts["low"], facts["high"], bins)).alias("bin"),
            F.when(~many, F.col("value")).alias("value"),
        )
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # One row with as many cells as there are bins, or at most `threshold` values.
    no_value = F.lit(None).cast(df.schema[column].dataType)
    every = F.array(*[F.struct(F.lit(i).alias("bin"), no_value.alias("value"), F.lit(0).cast("bigint").alias("n")) for i in range(bins)])
    row = counted.agg(
        F.sum("n").alias("rows"),
        _counts_of_bins().alias("found"),
        F.collect_list(F.struct("bin", "value", "n")).alias("few"),
    ).where(F.col("rows") > 0)
    told = row.select("found", "few", many.alias("many"), facts["low"].alias("first"), facts["high"].alias("last"))
    cells = told.select("found", "many", "first", "last", F.inline(F.when(F.col("many"), every).otherwise(F.col("few"))))
    low, high = _edges(F.col("bin"), F.col("first"), F.col("last"), bins)
    n = F.when(F.col("many"), F.coalesce(F.try_element_at("found", "bin"), F.lit(0))).otherwise(F.col("n"))
    kind = F.when(F.col("many"), F.lit("histogram")).otherwise(F.lit("value_counts"))
    return cells.select(kind.alias("kind"), "bin", low.alias("low"), high.alias("high"), "value", n.cast("bigint").alias("n"))
