from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import clean
from ledgerlens.sources import read_csv, write_csv
from ledgerlens.schema import TRANSACTION_SCHEMA


def test_null_device_becomes_unknown_and_other_nulls_stay(spark):
    df = spark.createDataFrame([(None, None), ("mobile", "x")], "device_type string, currency string")
    rows = clean.fill_missing(df).collect()
    assert [tuple(r) for r in rows] == [("unknown", None), ("mobile", "x")]


def test_fill_passes_over_absent_columns(spark):
    df = spark.createDataFrame([(1,)], "amount int")
    assert clean.fill_missing(df).collect() == df.collect()


def test_bad_timestamp_is_null_when_lenient_and_an_error_when_strict(spark):
    df = spark.createDataFrame([("x",), ("2024-02-03 04:05:06",)], "timestamp string")
    assert [r[0] for r in clean.parse_time(df).collect()] == [None, datetime(2024, 2, 3, 4, 5, 6)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        clean.parse_time(df, strict=True).collect()


@pytest.mark.parametrize("strict", [False, True])
def test_timestamp_format(spark, strict):
    df = spark.createDataFrame([("03/02/2024",)], "timestamp string")
    parsed = clean.parse_time(df, strict=strict, fmt="dd/MM/yyyy")
    assert parsed.first()[0] == datetime(2024, 2, 3)


def test_timestamps_are_left_alone(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:00' AS timestamp")
    assert clean.parse_time(df).dtypes == [("timestamp", "timestamp_ntz")]


def test_duplicates_with_nulls_collapse(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, "a"), (2, None)], "a int, b string")
    assert sorted(map(str, clean.drop_exact_duplicates(df).collect())) == sorted(
        map(str, df.distinct().collect())
    )
    assert clean.drop_exact_duplicates(df).count() == 3


def test_rows_equal_only_after_filling_collapse(spark):
    df = spark.createDataFrame(
        [("1", None, "2024-01-01 00:00:00"), ("1", "unknown", "2024-01-01 00:00:00")],
        "transaction_id string, device_type string, timestamp string",
    )
    assert clean.clean(df).count() == 1


@pytest.mark.parametrize("screen,threshold", [(False, "10m"), (True, "10m"), (True, "-1")])
def test_every_way_of_dropping_duplicates_agrees(spark, screen, threshold):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    rows = [(i, None if i % 5 else "x", float(i)) for i in range(300)]
    rows += [(1, None, 1.0)] * 150 + rows[40:60] + [(7, None, float("nan"))] * 2 + [(8, None, 0.0), (8, None, -0.0)]
    df = spark.createDataFrame(rows, "a int, b string, c double").repartition(5)
    got = clean.drop_exact_duplicates(df, screen=screen)
    assert got.columns == df.columns
    want = [str(r).replace("-0.0", "0.0") for r in df.dropDuplicates().collect()]
    found = [str(r).replace("-0.0", "0.0") for r in got.collect()]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sorted(found) == sorted(want)


def test_screening_is_the_callers_choice_alone(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    plan = clean.drop_exact_duplicates(df)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan


def test_parsed_times_do_not_depend_on_the_session(spark):
    df = spark.createDataFrame([("2024-03-10 02:30:00",), ("late",), (None,)], "timestamp string")
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = clean.parse_time(df)
        hours = [r[0] for r in got.select(F.hour("timestamp")).collect()]
        zoned = clean.parse_time(df, zoned=True)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert hours == [2, None, None] and got.dtypes == [("timestamp", "timestamp_ntz")]
    assert zoned.dtypes == [("timestamp", "timestamp")]


def test_csv_keeps_awkward_text(spark, tmp_path):
    texts = [" lead", "trail ", "", None, "two\nlines", "cr\r\nlf", 'say "hi", you', "back\\", 'a,\\"', '"', "\\N", "null"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, s string").coalesce(1)
    write_csv(df, str(tmp_path / "x"))
    got = read_csv(spark, str(tmp_path / "x"), df.schema, multiLine=True, mode="FAILFAST")
    assert {r.i: r.s for r in got.collect()} == dict(enumerate(texts))


def test_a_table_without_copies_is_not_shuffled(spark):
    df = spark.range(100).select("id", (F.col("id") * 2).alias("b"))
    plan = clean.drop_exact_duplicates(df, screen=True).select("b")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_copies_collapse_before_the_shuffle(spark):
    df = spark.range(1000).select(F.lit("same").alias("a"), (F.col("id") % 2).alias("b"))
    plan = clean.drop_exact_duplicates(df, screen=False)._jdf.queryExecution().executedPlan().toString()
    below_exchange = plan.split("Exchange hashpartitioning")[1]
    assert "HashAggregate" in below_exchange


def test_csv_keeps_microseconds_nulls_and_types(spark, tmp_path):
    df = spark.sql(
        "SELECT 'T' AS transaction_id, timestamp_ntz'2024-01-01 00:00:11.172425' AS timestamp, 'C' AS customer_id,"
        "1.5D AS amount, 'USD' AS currency, 'a,b' AS merchant_category, 1D AS location_lat, -2D AS location_long,"
        "CAST(NULL AS STRING) AS device_type, 'pos' AS transaction_type, 1 AS is_fraud,"
        "CAST(NULL AS DOUBLE) AS time_since_last, 0 AS foreign_country, 0 AS multiple_quick_trans"
    )
    write_csv(df, str(tmp_path / "out"))
    back = read_csv(spark, str(tmp_path / "out"))
    assert back.schema == TRANSACTION_SCHEMA
    assert back.collect() == df.collect()


def test_csv_with_blank_between_date_and_time(spark, tmp_path):
    (tmp_path / "in.csv").write_text(
        "transaction_id,timestamp\nA1,2021-03-04 12:34:56\nA2,2021-03-04T12:34:56.000001\n"
    )
    df = read_csv(spark, str(tmp_path / "in.csv"), "transaction_id string, timestamp timestamp_ntz")
    assert [r.timestamp for r in df.collect()] == [
        datetime(2021, 3, 4, 12, 34, 56),
        datetime(2021, 3, 4, 12, 34, 56, 1),
    ]
    inferred = read_csv(spark, str(tmp_path / "in.csv"), infer=True)
    assert inferred.dtypes == [("transaction_id", "string"), ("timestamp", "timestamp")]


def test_csv_with_other_columns_than_declared_is_an_error(spark, tmp_path):
    (tmp_path / "in.csv").write_text("b,a\n1,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, str(tmp_path / "in.csv"), "a int, b int").collect()
