"""Grouped fraud reports, top-n listings and free SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.schema import ID, LABEL, TIME
from ledgerlens.scratch import durable


def label_statistics(df: DataFrame, label: str = LABEL, value: str = "amount") -> DataFrame:
    """Count, mean, sample deviation, smallest and largest value of each label."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("count"), *_measures(value))


def _measures(value: str) -> list[Column]:
    kinds = {"avg": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    return [measure(value).alias(f"{prefix}_{value}") for prefix, measure in kinds.items()]


def fraud_rate_by(
    df: DataFrame,
    key: str,
    label: str = LABEL,
    top: int | None = None,
    rate: str = "fraud_percent",
) -> DataFrame:
    """Rows, fraud rows and fraud percentage per value of `key`, highest percentage first.

    Null is a group of its own. The aggregate combines within tasks first, so a dominant key costs one
    row per task in the shuffle; with `top` the sort becomes a bounded top-k.
    """
    totals = df.groupBy(key).agg(F.count(F.lit(1)).alias("total"), F.sum(label).alias("fraud_count"))
    return _rated(totals, key, top, rate)


def _rated(totals: DataFrame, key: str, top: int | None, rate: str = "fraud_percent") -> DataFrame:
    report = totals.withColumn(rate, F.round(F.col("fraud_count") / F.col("total") * 100, 2))
    report = report.orderBy(F.desc(rate), F.asc(key))
    return report if top is None else report.limit(top)


def explore_totals(
    df: DataFrame, label: str = LABEL, keys: tuple[str, ...] = ("merchant_category", "device_type"), value: str = "amount"
) -> DataFrame:
    """Counts and measures of every label and of every value of each key, from one scan with grouping sets.

    `report` names the column a row is about; the other ones are null. Rows combine within tasks before the shuffle.
    """
    columns = [label, *keys]
    source = df.select(*columns, F.col(label).alias("__label"), F.col(value).alias(value))
    n = len(columns)
    about = F.array(*[F.lit(c) for c in columns])
    # The grouping id has a bit for every column that is not grouped by, the first column's being the highest.
    place = sum((F.lit(i) * (F.shiftright(F.grouping_id(), n - 1 - i).bitwiseAND(F.lit(1)) == 0).cast("int") for i in range(n)), F.lit(0))
    return source.groupingSets([[F.col(c)] for c in columns], *columns).agg(
        about[place].alias("report"),
        F.count(F.lit(1)).alias("total"),
        F.sum("__label").alias("fraud_count"),
        *_measures(value),
    )


def explore(df: DataFrame) -> dict[str, DataFrame]:
    """The three standard reports. One job scans the table once for all of them; the reports read its small result."""
    totals = durable(explore_totals(df))
    about = lambda c: totals.where(F.col("report") == c)
    rated = lambda c, top: _rated(about(c).select(c, "total", "fraud_count"), c, top)
    shown = [c for c in totals.columns if c.endswith("_amount")]
    return {
        "fraud_stats": about(LABEL).select(LABEL, F.col("total").alias("count"), *shown),
        "merchant_stats": rated("merchant_category", 10),
        "device_stats": rated("device_type", None),
    }


def recent_high_value(df: DataFrame, threshold: float = 1000, n: int = 50) -> DataFrame:
    """The newest `n` transactions above `threshold`; equal times are ordered by id."""
    return df.where(F.col("amount") > threshold).orderBy(F.desc(TIME), ID).limit(n)


def preview(df: DataFrame, n: int = 10, by: str | None = None) -> DataFrame:
    """The first `n` rows; with `by` they are the same ones on every run."""
    return (df.orderBy(by) if by else df).limit(n)


def run_sql(spark: SparkSession, text: str, limit: int | None = None) -> DataFrame:
    """Run any query over the registered views, every row of its result, or the first `limit` (a page shows 1,000)."""
    result = spark.sql(text)
    return result if limit is None else result.limit(limit)
