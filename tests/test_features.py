import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ledgerlens.functions import epoch_micros, hash_bucket, off_hours
from ledgerlens.operators import features, sequence


def test_off_hours_edges(spark):
    df = spark.createDataFrame([(5,), (6,), (22,), (23,), (None,), (0,)], "hour_of_day int")
    got = features.with_off_hours(df)
    assert [r.off_hours for r in got.collect()] == [1, 0, 0, 1, 0, 1]
    assert dict(got.dtypes)["off_hours"] == "int"
    assert [r[0] for r in df.select(off_hours(F.col("hour_of_day"))).collect()] == [1, 0, 0, 1, 0, 1]


def test_velocity_edges(spark):
    df = spark.createDataFrame([(None,), (0.0,), (-0.0,), (4.0,), (-2.0,)], "time_since_last double")
    assert [r.txn_velocity for r in features.with_velocity(df).collect()] == [None, None, None, 0.25, -0.5]


def test_distance_without_and_with_home(spark):
    df = spark.createDataFrame([(3.0, 4.0)], "location_lat double, location_long double")
    assert features.with_distance(df).first().distance_from_home == 5.0
    home = df.withColumns({"home_lat": F.lit(0.0), "home_long": F.lit(4.0)})
    assert features.with_distance(home).first().distance_from_home == 3.0


def test_calendar_parts(spark):
    days = ["2024-01-07 00:00:00", "2024-12-31 23:59:59", None]
    df = spark.createDataFrame([(d,) for d in days], "d string").select(
        F.col("d").cast("timestamp_ntz").alias("timestamp")
    )
    got = features.with_calendar(df).drop("timestamp")
    assert [tuple(r) for r in got.collect()] == [(0, 1, 1), (23, 3, 12), (None, None, None)]


def test_row_features_accept_a_stream(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.sql(
        "SELECT timestamp_ntz'2024-01-07 23:00:00' AS timestamp, 3D AS location_lat, 4D AS location_long,"
        "2D AS time_since_last"
    ).write.parquet(source)
    stream = spark.readStream.schema(spark.read.parquet(source).schema).parquet(source)
    run = (
        features.build_features(stream)
        .writeStream.format("memory")
        .queryName("featured")
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination(120)
    row = spark.table("featured").first()
    assert (row.off_hours, row.distance_from_home, row.txn_velocity) == (1, 5.0, 0.5)


def test_features_stay_in_one_stage(spark):
    df = spark.createDataFrame(
        [(datetime(2024, 1, 1), 1.0, 2.0, 3.0)],
        "timestamp timestamp, location_lat double, location_long double, time_since_last double",
    )
    plan = features.build_features(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


@pytest.mark.parametrize("text", ["2024-05-06 07:08:09.123456", "1969-12-31 23:59:59.999999", "1900-01-01 00:00:00"])
def test_epoch_micros(spark, text):
    df = spark.sql(f"SELECT timestamp_ntz'{text}' AS n, timestamp'{text}' AS z")
    row = df.select(
        epoch_micros(F.col("n"), df.schema["n"].dataType).alias("n"),
        epoch_micros(F.col("z"), df.schema["z"].dataType).alias("z"),
    ).first()
    assert row.n == row.z


def test_hash_bucket_is_in_range_and_keeps_null(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("k"))
    found = {r[0] for r in df.select(hash_bucket(F.col("k"), 10)).collect()}
    assert found == set(range(10))
    assert spark.createDataFrame([(None,)], "k string").select(hash_bucket(F.col("k"))).first()[0] is not None


def _gaps(spark, rows, **options):
    df = spark.createDataFrame(rows, "transaction_id string, customer_id string, s long").select(
        "transaction_id", "customer_id", F.timestamp_seconds("s").cast("timestamp_ntz").alias("timestamp")
    )
    got = sequence.time_since_previous(df, **options)
    assert got.columns == ["transaction_id", "customer_id", "timestamp", "time_since_last"]
    return {r.transaction_id: r.time_since_last for r in got.collect()}


def test_gap_to_previous(spark):
    rows = [("1", "a", 0), ("2", "a", 3600), ("3", "a", 3600), ("4", "b", 7200), ("5", "b", 1800)]
    assert _gaps(spark, rows) == {"1": None, "2": 1.0, "3": 0.0, "5": None, "4": 1.5}


def _brute_force(rows):
    """Sort each customer's rows in plain Python."""
    last, out = {}, {}
    for txn, customer, s in sorted(rows, key=lambda r: (str(r[1]), r[2], r[0])):
        out[txn] = None if customer not in last else (s - last[customer]) / 3600
        last[customer] = s
    return out


@pytest.mark.parametrize("same_time", [False, True])
def test_hot_customers_are_sliced_without_changing_the_result(spark, same_time):
    rows = []
    for i in range(3000):
        customer = "hot" if i % 3 == 0 else (None if i % 3 == 1 else f"c{i % 50}")
        rows.append((f"{i:05d}", customer, 1000 if same_time else (i * 7919) % 100_000))
    got = _gaps(spark, rows, heavy_rows=100)
    want = _brute_force(rows)
    assert got.keys() == want.keys()
    assert all(
        got[k] is None if want[k] is None else math.isclose(got[k], want[k], abs_tol=1e-12) for k in want
    )


def test_home_join_keeps_unmatched_rows(spark):
    df = spark.createDataFrame([("t1", "a"), ("t2", "b")], "transaction_id string, customer_id string")
    profile = spark.createDataFrame([("a", 1.0, 2.0, "x")], "customer_id string, home_lat double, home_long double, n string")
    got = sequence.attach_home(df, profile).orderBy("transaction_id").collect()
    assert [(r.transaction_id, r.home_lat, r.home_long) for r in got] == [("t1", 1.0, 2.0), ("t2", None, None)]
