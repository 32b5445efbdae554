"""Operators that relate a transaction to other rows: the previous one, and the customer's profile."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions import epoch_micros
from ledgerlens.schema import CUSTOMER, ID, TIME
from ledgerlens.scratch import durable

# Rows of one customer that a single task may sort.
HEAVY_ROWS = 2_000_000


def _previous_in_one_task(df: DataFrame, customer: str, time: str, tie: str, out: str) -> DataFrame:
    order = Window.partitionBy(customer).orderBy(time, tie)
    return df.withColumn(out, F.lag(time).over(order))


def _previous_across_tasks(
    df: DataFrame, slices: int, customer: str, time: str, tie: str, out: str
) -> DataFrame:
    """The previous time of rows whose customer is too large for one task.

    Rows are cut into ranges of (customer, time, tie), so a customer spreads over as many ranges as it
    needs, even if all its times are equal. Within a range `lag` gives the answer; the first row of a
    customer in a range takes the customer's last time from the nearest earlier range, which is a small
    table (a row per range and per heavy customer), written out so that Spark knows its size and broadcasts it
    or not. Range bounds come from a sample, hence the ranged rows are written out once so that both reads
    agree on them: with all their columns, as joining narrow rows back by id would shuffle those as well.
    """
    ranged = durable(
        df.repartitionByRange(slices, customer, time, tie).withColumn("_slice", F.spark_partition_id())
    )
    inside = Window.partitionBy("_slice", customer).orderBy(time, tie)
    earlier = Window.partitionBy("_key").orderBy("_at")
    carried = (
        ranged.groupBy(F.col(customer).alias("_key"), F.col("_slice").alias("_at"))
        .agg(F.max(time).alias("_last"))
        .withColumn("_carried", F.lag("_last").over(earlier))
        .select("_key", "_at", "_carried")
    )
    same = F.col("_slice").eqNullSafe(F.col("_at")) & F.col(customer).eqNullSafe(F.col("_key"))
    return (
        ranged.withColumn("_near", F.lag(time).over(inside))
        .join(durable(carried), same, "left")
        .withColumn(out, F.coalesce("_near", "_carried"))
        .select(*df.columns, out)
    )


def with_previous_time(
    df: DataFrame,
    out: str,
    customer: str = CUSTOMER,
    time: str = TIME,
    tie: str = ID,
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Add the time of the same customer's previous row as `out` (null for the first).

    Counts rows per customer first (one narrow pass, combined before its shuffle). Customers up to
    `heavy_rows` take the ordinary window; larger ones are sliced, see `_previous_across_tasks`.
    """
    if heavy_rows < 1:
        raise ValueError("heavy_rows must be at least 1")
    key = F.col(customer)
    heavy = df.groupBy(key.alias("_heavy")).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > heavy_rows)
    found = heavy.agg(F.count(F.lit(1)).alias("keys"), F.sum("_rows").alias("rows")).first()
    if not found["keys"]:
        return _previous_in_one_task(df, customer, time, tie, out)

    keys = durable(heavy.select("_heavy"))
    is_heavy = key.eqNullSafe(F.col("_heavy"))
    slices = math.ceil(found["rows"] / heavy_rows) + 1
    light = _previous_in_one_task(df.join(keys, is_heavy, "left_anti"), customer, time, tie, out)
    large = _previous_across_tasks(
        df.join(keys, is_heavy, "left_semi"), slices, customer, time, tie, out
    )
    return light.unionByName(large)


def hours_between(earlier: Column, later: Column, dtype) -> Column:
    """Hours from `earlier` to `later`, to the microsecond."""
    return (epoch_micros(later, dtype) - epoch_micros(earlier, dtype)) / F.lit(3.6e9)


def time_since_previous(
    df: DataFrame,
    out: str = "time_since_last",
    customer: str = CUSTOMER,
    time: str = TIME,
    tie: str = ID,
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Hours since the same customer's previous transaction; null for the customer's first."""
    linked = with_previous_time(df, "_previous", customer, time, tie, heavy_rows)
    gap = hours_between(F.col("_previous"), F.col(time), df.schema[time].dataType)
    return linked.withColumn(out, gap).drop("_previous")


def last_times(df: DataFrame, customer: str = CUSTOMER, time: str = TIME) -> DataFrame:
    """customer, last_time: the state that a load leaves to the next; a row for each customer, null being one."""
    return df.groupBy(customer).agg(F.max(time).alias("last_time"))


def time_since_previous_load(
    load: DataFrame,
    state: DataFrame | None = None,
    out: str = "time_since_last",
    customer: str = CUSTOMER,
    time: str = TIME,
    tie: str = ID,
    heavy_rows: int = HEAVY_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """(`load` with hours since the customer's previous transaction, the state after it), from the state of earlier loads.

    Earlier rows are not read again: what a load needs of them is the last time of each customer. Only a customer's
    first row of the load takes it. The new state is a written table (runs a job). Loads follow one another in time: a
    load with a row before the last time of its customer is refused, as an earlier result would have to change; rows at
    exactly that time count as later.
    """
    own = durable(last_times(load, customer, time))
    if state is not None:
        begins = load.groupBy(customer).agg(F.min(time).alias("__first"))
        late = begins.join(state.withColumnRenamed(customer, "__customer"), F.col(customer).eqNullSafe(F.col("__customer")))
        if not late.where("__first < last_time").isEmpty():
            raise ValueError("the load has rows from before the last times of the state")
    linked = with_previous_time(load, "_previous", customer, time, tie, heavy_rows)
    if state is None:
        after = own
    else:
        known = state.select(F.col(customer).alias("_known"), F.col("last_time").alias("_carried"))
        linked = linked.join(known, F.col(customer).eqNullSafe(F.col("_known")), "left").withColumn(
            "_previous", F.coalesce("_previous", "_carried")
        )
        after = durable(state.unionByName(own).groupBy(customer).agg(F.max("last_time").alias("last_time")))
    gap = hours_between(F.col("_previous"), F.col(time), load.schema[time].dataType)
    return linked.withColumn(out, gap).select(*load.columns, out), after


def attach_home(df: DataFrame, profile: DataFrame, customer: str = CUSTOMER) -> DataFrame:
    """Left join `home_lat`, `home_long` from a table with one row per customer; a repeated one repeats its rows.

    No hint is given: Spark broadcasts the profile while its size is below the broadcast threshold and
    otherwise sort-merges, where adaptive execution splits the partition of a dominant customer.
    """
    return df.join(profile.select(customer, "home_lat", "home_long"), customer, "left")
