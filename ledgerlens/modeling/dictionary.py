"""Dictionaries of text columns that never pass through the driver: ranked in ranges, joined to the rows."""

from __future__ import annotations

from pyspark.ml import Estimator, Model
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.scratch import durable


def ranked_values(df: DataFrame, column: str) -> DataFrame:
    """value, n, index: every value of `column` but null, index 0 for the most frequent one; ties by value.

    Counts combine within tasks. They are cut into ranges of (count, value), so that values of one count
    spread over as many tasks as they need, and numbered within each; the numbers of rows in the earlier ranges are
    added. The result is a written table (runs jobs).
    """
    value = F.col(f"`{column}`")
    counts = df.where(value.isNotNull()).groupBy(value.alias("value")).agg(F.count(F.lit(1)).alias("n"))
    ranged = durable(counts.repartitionByRange(F.desc("n"), "value").withColumn("slice", F.spark_partition_id()))
    earlier = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ranged.groupBy("slice").agg(F.count(F.lit(1)).alias("rows"))  # a row for each range
        .select("slice", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("start"))
    )
    place = F.row_number().over(Window.partitionBy("slice").orderBy(F.desc("n"), "value")) - 1
    numbered = ranged.withColumn("place", place).join(durable(starts), "slice")
    return durable(numbered.select("value", "n", (F.col("start") + F.col("place")).alias("index")))


def with_index(df: DataFrame, column: str, ranked: DataFrame, out: str) -> DataFrame:
    """Add the index of each row's value as a double; null and values the dictionary lacks come after the last.

    No hint is given: the dictionary is a written table, which Spark broadcasts while it is small and shuffles
    beyond, where adaptive execution splits the partition of a dominant value.
    """
    size = ranked.count()
    entries = ranked.select(F.col("value").alias("__value"), F.col("index").alias("__index"))
    joined = df.join(entries, F.col(f"`{column}`") == F.col("__value"), "left")
    slots = {"ml_attr": {"type": "nominal", "num_vals": size + 1, "name": out}}
    index = F.coalesce("__index", F.lit(size)).cast("double").alias(out, metadata=slots)
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], index)


class JoinedIndex(Estimator):
    """Stage that numbers text as `StringIndexer` does (most frequent first, one number for all that is unknown)."""

    def __init__(self, columns: list[str], outputs: list[str]) -> None:
        super().__init__()
        self.columns, self.outputs = list(columns), list(outputs)

    def _fit(self, dataset: DataFrame) -> JoinedIndexModel:
        return JoinedIndexModel(self.columns, self.outputs, [ranked_values(dataset, c) for c in self.columns])


class JoinedIndexModel(Model):
    """`dictionaries` has a written table (value, n, index) for each column."""

    def __init__(self, columns: list[str], outputs: list[str], dictionaries: list[DataFrame]) -> None:
        super().__init__()
        self.columns, self.outputs, self.dictionaries = columns, outputs, dictionaries

    def _transform(self, dataset: DataFrame) -> DataFrame:
        for column, out, ranked in zip(self.columns, self.outputs, self.dictionaries, strict=True):
            dataset = with_index(dataset, column, ranked, out)
        return dataset
