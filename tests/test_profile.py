import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import profile


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(
        [(1.0, "a", 1), (2.0, "b", 1), (None, None, 1), (4.0, "a", 1)], "x double, s string, c int"
    ).cache()


def one(df):
    return df.first().asDict()


def test_row_count(spark, table):
    assert profile.row_count(table).collect() == [(4,)]
    assert profile.row_count(table.limit(0)).collect() == [(0,)]


def test_numeric_columns_and_types(table):
    assert profile.numeric_columns(table) == ["x", "c"]
    assert profile.column_type(table, "x") == "double"


def test_overview(table):
    assert [tuple(r) for r in profile.column_overview(table).collect()] == [
        (0, "x", "double", 1),
        (1, "s", "string", 1),
        (2, "c", "int", 0),
    ]


def test_null_is_a_distinct_value(table):
    rows = profile.distinct_count(table, "s", "x", "c").collect()
    assert [tuple(r) for r in rows] == [("s", 3), ("x", 4), ("c", 1)]
    assert [r.distinct for r in profile.distinct_count(table, "s", approx=True).collect()] == [3]


def test_distinct_keeps_close_values_of_every_type_apart(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (9007199254740992, 1.5D, 1.10BD, true, X'01', timestamp'2024-01-01 00:00:00.000001'),"
        "(9007199254740993, double('NaN'), 1.11BD, false, X'02', timestamp'2024-01-01 00:00:00.000002'),"
        "(NULL, double('NaN'), NULL, true, NULL, NULL) AS t(a, b, c, d, e, f)"
    )
    rows = profile.distinct_count(df, *df.columns).collect()
    assert {r.column: r.distinct for r in rows} == {"a": 3, "b": 2, "c": 3, "d": 2, "e": 3, "f": 3}


def test_exact_and_approximate_profile_agree_on_small_columns(table):
    exact, approx = profile.column_profile(table), profile.column_profile(table, approx=True)
    assert exact.collect() == approx.collect()
    assert exact.dtypes == approx.dtypes


def test_distinct_of_no_rows_is_zero(table):
    assert profile.distinct_count(table.limit(0), "s").collect() == [("s", 0)]


def test_stats_match_builtin(table):
    got = one(profile.column_stats(table, "x"))
    want = one(
        table.agg(F.mean("x").alias("mean"), F.stddev("x").alias("stddev"), F.min("x").alias("min"))
    )
    assert {k: got[k] for k in want} == want and got["max"] == 4.0


def test_all_null_column_has_null_stats(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert one(profile.column_stats(df, "x")) == {
        "column": "x",
        "mean": None,
        "stddev": None,
        "min": None,
        "max": None,
        "exact_min": None,
        "exact_max": None,
    }


def test_profile_is_one_aggregate_over_all_columns(table):
    got = profile.column_profile(table)
    assert {r.column: (r.type, r.distinct, r.missing) for r in got.collect()} == {
        "x": ("double", 4, 1),
        "c": ("int", 1, 0),
    }


def test_histogram_counts_every_value_once(spark):
    df = spark.range(1000).select(F.sqrt("id").alias("x")).union(spark.createDataFrame([(None,)], "x double"))
    rows = {r.bin: r.n for r in profile.histogram(df, "x").collect()}
    assert sum(rows.values()) == 1000
    assert min(rows) == 0 and max(rows) == 19


def test_histogram_agrees_with_numpy(spark):
    import numpy as np

    values = [float((i * 37) % 101) ** 1.5 for i in range(500)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    want = {i: int(n) for i, n in enumerate(np.histogram(values, 20)[0])}
    rows = profile.histogram(df, "x").collect()
    assert {r.bin: r.n for r in rows} == want
    assert np.allclose([r.low for r in rows] + [rows[-1].high], np.histogram(values, 20)[1])


def test_histogram_of_a_constant_and_of_nothing(spark):
    df = spark.createDataFrame([(3.0,), (3.0,), (None,), (float("nan"),)], "x double")
    rows = profile.histogram(df, "x").collect()
    assert [r.bin for r in rows if r.n] == [10] and len(rows) == 20 and rows[10].n == 2
    assert (rows[0].low, rows[-1].high) == (2.5, 3.5)
    assert profile.histogram(df.limit(0), "x").count() == 0


def test_infinities_are_in_no_bin(spark):
    df = spark.createDataFrame([(float(i),) for i in range(40)] + [(float("inf"),), (float("-inf"),)], "x double")
    for rows in (profile.histogram(df, "x").collect(), profile.profile_distribution(df, "x").collect()):
        assert len(rows) == 20 and {r.n for r in rows} == {2}


def test_large_whole_numbers_and_nested_values_stay_apart(spark):
    big = spark.createDataFrame([(2**53,), (2**53 + 1,)], "x bigint")
    assert {(r.value, r.n) for r in profile.profile_distribution(big, "x").collect()} == {(2**53, 1), (2**53 + 1, 1)}
    nested = spark.sql(
        "SELECT * FROM VALUES (array('a, b'), timestamp'2024-11-03 05:30:00Z'), "
        "(array('a', 'b'), timestamp'2024-11-03 06:30:00Z'), (NULL, NULL) AS t(a, ts)"
    )
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = {r["column"]: r["distinct"] for r in profile.distinct_count(nested, "a", "ts").collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == {"a": 3, "ts": 3}


def test_value_counts_keep_null_and_sort(table):
    assert [tuple(r) for r in profile.value_counts(table, "s").collect()] == [("a", 2), (None, 1), ("b", 1)]


@pytest.mark.parametrize("distinct,kind", [(10, "value_counts"), (11, "histogram")])
def test_distribution_chooses_by_distinct_values(spark, distinct, kind):
    df = spark.range(110).select((F.col("id") % distinct).alias("x"))
    got = profile.profile_distribution(df, "x")
    assert {r.kind for r in got.collect()} == {kind}
    assert got.agg(F.sum("n")).first()[0] == 110


def test_distribution_counts_null_as_a_value_but_bins_numbers_only(spark):
    tens = spark.range(10).select(F.col("id").cast("double").alias("x"))
    nulls = spark.createDataFrame([(None,), (None,)], "x double")
    got = profile.profile_distribution(tens.union(nulls), "x")
    assert {r.kind for r in got.collect()} == {"histogram"}
    assert got.agg(F.sum("n")).first()[0] == 10
    few = profile.profile_distribution(tens.where("x < 3").union(nulls), "x")
    assert {(r.value, r.n) for r in few.collect()} == {(0.0, 1), (1.0, 1), (2.0, 1), (None, 2)}


def test_distribution_shuffles_no_values(spark):
    """However many values are different, what tasks send on are bins."""
    df = spark.range(0, 200_000, 1, 4).select((F.col("id") * 1.5).alias("value"))
    got = profile.profile_distribution(df, "value")
    assert got.agg(F.sum("n")).first()[0] == 200_000
    got.collect()
    rows = _sent(got._jdf.queryExecution().executedPlan())
    assert rows and max(rows) <= 4 * 20


def _sent(node):
    """Rows that each shuffle of an executed plan wrote."""
    if node.nodeName() == "AdaptiveSparkPlan":
        return _sent(node.executedPlan())
    if node.nodeName().endswith("QueryStage"):
        own = node.plan().metrics().get("shuffleRecordsWritten")
        return [own.get().value() for _ in range(own.isDefined())] + _sent(node.plan())
    return [n for i in range(node.children().size()) for n in _sent(node.children().apply(i))]


@pytest.mark.parametrize("threshold", [3, 5000])
def test_distribution_decides_exactly_at_the_threshold(spark, threshold):
    df = spark.range(threshold).select(F.col("id").cast("double").alias("x"))
    zeros = df.union(spark.sql("SELECT -0.0D AS x")) if threshold == 3 else df
    assert {r.kind for r in profile.profile_distribution(zeros, "x", threshold).collect()} == {"value_counts"}
    more = df.union(spark.createDataFrame([(None,)], "x double"))
    assert {r.kind for r in profile.profile_distribution(more, "x", threshold).collect()} == {"histogram"}
    money = df.select(F.col("x").cast("decimal(20,2)").alias("x"))
    assert {r.kind for r in profile.profile_distribution(money, "x", threshold).collect()} == {"value_counts"}
    assert profile.profile_distribution(df.limit(0), "x").count() == 0


def test_histogram_with_a_known_range_reads_once(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    low, high = df.agg(F.min("value"), F.max("value")).first()
    once = profile.histogram(df, "value", span=(low, high))
    assert once._jdf.queryExecution().executedPlan().toString().count("Scan parquet") == 1
    assert once.collect() == profile.histogram(df, "value").collect()


def test_distribution_of_text_is_refused(table):
    with pytest.raises(ValueError, match="s is not numeric"):
        profile.profile_distribution(table, "s")


def test_extremes_keep_every_digit(spark):
    big = (1 << 53) + 1
    df = spark.createDataFrame([(big, 0.5), (big, 1.5)], "x long, y double")
    got = {r["column"]: (r["exact_min"], r["exact_max"], r["max"]) for r in profile.column_stats(df, "x", "y").collect()}
    assert got == {"x": (str(big), str(big), float(1 << 53)), "y": (None, None, 1.5)}
