import pytest

from ledgerlens.operators import reports
from ledgerlens.plans.inputs import transactions
from ledgerlens.sources import export_result, read_csv, register, write_csv


@pytest.fixture(scope="module")
def table(spark):
    rows = [
        (f"T{i:02d}", "2024-01-01 00:00:00", 1000.0 + i, f"m{i % 12}", ["mobile", None][i % 2], int(i % 4 == 0))
        for i in range(48)
    ]
    return spark.createDataFrame(
        rows,
        "transaction_id string, timestamp string, amount double, merchant_category string,"
        "device_type string, is_fraud int",
    ).cache()


def test_rate_report_is_sorted_and_capped(table):
    got = reports.fraud_rate_by(table, "merchant_category", top=10).collect()
    assert len(got) == 10
    assert [r.merchant_category for r in got[:3]] == ["m0", "m4", "m8"]
    assert got[0].fraud_percent == 100.0 and got[0].total == 4 and got[0].fraud_count == 4


def test_null_group_is_kept(table):
    got = {r.device_type: r.fraud_count for r in reports.fraud_rate_by(table, "device_type").collect()}
    assert got == {"mobile": 12, None: 0}


def test_percent_is_rounded_half_up(spark):
    df = spark.createDataFrame([("k", int(i < 1)) for i in range(800)], "k string, is_fraud int")
    assert reports.fraud_rate_by(df, "k").first().fraud_percent == 0.13


def test_other_label(table):
    renamed = table.withColumnRenamed("is_fraud", "bad")
    assert reports.fraud_rate_by(renamed, "device_type", label="bad").count() == 2
    assert reports.label_statistics(renamed, label="bad").count() == 2


def test_explore_scans_once(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet").selectExpr(
        "CAST(event_id % 7 = 0 AS INT) AS is_fraud", "event_type AS merchant_category", "value AS amount",
        "CASE event_id % 3 WHEN 0 THEN 'a' WHEN 1 THEN 'b' END AS device_type",
    )
    plan = reports.explore_totals(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1
    found = reports.explore(df)
    for name, alone in {
        "fraud_stats": reports.label_statistics(df),
        "merchant_stats": reports.fraud_rate_by(df, "merchant_category", top=10),
        "device_stats": reports.fraud_rate_by(df, "device_type"),
    }.items():
        assert found[name].columns == alone.columns
        shown = lambda t: [tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in t.collect()]
        assert sorted(shown(found[name]), key=str) == sorted(shown(alone), key=str)


def test_explore_is_complete(table):
    found = reports.explore(table)
    assert list(found) == ["fraud_stats", "merchant_stats", "device_stats"]
    assert [found[k].count() for k in found] == [2, 10, 2]


def test_single_row_label_has_null_deviation(spark):
    df = spark.createDataFrame([(1, 5.0)], "is_fraud int, amount double")
    assert reports.label_statistics(df).first().std_amount is None


def test_high_value_is_newest_first(table):
    got = reports.recent_high_value(table, threshold=1010, n=3).collect()
    assert [r.transaction_id for r in got] == ["T11", "T12", "T13"]


def test_top_k_needs_no_full_sort(table):
    for df in (reports.recent_high_value(table), reports.fraud_rate_by(table, "merchant_category", top=10)):
        assert "TakeOrderedAndProject" in df._jdf.queryExecution().executedPlan().toString()


def test_filter_and_columns_reach_the_parquet_scan(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet").selectExpr(
        "event_id AS transaction_id", "ts AS timestamp", "value AS amount", "event_type", "props"
    )
    plan = reports.recent_high_value(df, 100)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(value), GreaterThan(value,100.0)]" in plan
    narrow = df.selectExpr("event_type", "CAST(amount > 100 AS INT) AS is_fraud")
    plan = reports.fraud_rate_by(narrow, "event_type")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_type:string,value:double>" in plan


def test_preview(table):
    assert reports.preview(table, 5).count() == 5
    assert [r.transaction_id for r in reports.preview(table, 2, by="transaction_id").collect()] == ["T00", "T01"]


def test_free_sql_gives_every_row_or_a_limit_and_reports_errors(spark, table):
    register(table, "transactions")
    text = "SELECT a.transaction_id FROM transactions a JOIN transactions b ON a.is_fraud = b.is_fraud"
    assert reports.run_sql(spark, text).count() == 12 * 12 + 36 * 36
    assert reports.run_sql(spark, text, limit=1000).count() == 1000
    with pytest.raises(Exception, match="nowhere"):
        reports.run_sql(spark, "SELECT * FROM nowhere")
    with pytest.raises(Exception, match="PARSE_SYNTAX_ERROR"):
        reports.run_sql(spark, "SELEC 1")


def test_export_keeps_every_row_or_a_limit(spark, tmp_path):
    export_result(spark.range(3000), str(tmp_path / "all"))
    export_result(spark.range(3000), str(tmp_path / "page"), limit=1000)
    assert read_csv(spark, str(tmp_path / "all"), "id long").count() == 3000
    assert read_csv(spark, str(tmp_path / "page"), "id long").count() == 1000


def test_csv_keeps_spaces_around_text(spark, tmp_path):
    write_csv(spark.createDataFrame([(" lead",), ("trail ",)], "t string"), str(tmp_path / "t"))
    assert {r.t for r in read_csv(spark, str(tmp_path / "t"), "t string").collect()} == {" lead", "trail "}


def test_long_ids_are_not_cut(spark, tmp_path):
    ids = [100000001, 100000009, 10000000, 10**12 + 1, 10**12 + 2, 7]
    events = spark.createDataFrame([(i, None, i, "e", 1.0, '{"k": 1}') for i in ids],
                                   "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
    events.write.parquet(str(tmp_path / "events.parquet"))
    got = transactions(spark, str(tmp_path))
    assert got.select("customer_id").distinct().count() == got.select("transaction_id").distinct().count() == 6
    assert "CUST_00000007" in {r.customer_id for r in got.collect()}
