"""Layout by day, footers, merged profiles, loads, dictionaries and medians."""

import math
import random
import statistics
from datetime import date

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from ledgerlens import modeling
from ledgerlens.modeling import median
from ledgerlens.modeling.median import MedianFill, exact_medians
from ledgerlens.modeling.prepare import FEATURES, feature_stages
from ledgerlens.operators import merging, profile, sequence
from ledgerlens.plans.inputs import transactions
from ledgerlens.scratch import durable
from ledgerlens.sources import parquet_ranges, read_days, write_by_day

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ---- layout


def test_days_read_only_their_folders(spark, tmp_path):
    rows = transactions(spark, SF).withColumn("timestamp", F.when(F.col("is_fraud") == 0, F.col("timestamp")))
    path = str(tmp_path / "t")
    write_by_day(rows, path, file_rows=20)
    some = read_days(spark, path, date(2024, 1, 9), "2024-01-12")
    assert "PartitionFilters: [isnotnull(day" in plan(some)
    files = some.select(F.input_file_name().alias("f"), "transaction_id")
    folders = {r.f.split("day=")[1].split("/")[0] for r in files.collect()}
    assert folders == {f"2024-01-{d:02}" for d in range(9, 13)}
    assert max(r["count"] for r in files.groupBy("f").count().collect()) <= 20
    wanted = rows.where("CAST(timestamp AS DATE) BETWEEN DATE'2024-01-09' AND DATE'2024-01-12'")
    assert some.columns == rows.columns and some.exceptAll(wanted).isEmpty() and wanted.exceptAll(some).isEmpty()
    assert spark.read.parquet(path).count() == rows.count()  # rows without a time as well
    with pytest.raises(ValueError, match="column day"):
        write_by_day(rows.withColumn("day", F.lit(1)), str(tmp_path / "u"))


def test_a_day_with_most_rows_is_written_by_several_tasks(spark, tmp_path):
    rows = spark.range(0, 40_000, 1, 8).select(
        F.col("id"), F.rpad(F.sha2(F.col("id").cast("string"), 512), 400, "x").alias("pad"),
        F.when(F.col("id") % 10 > 0, F.lit("2024-01-01")).otherwise(F.lit("2024-01-02")).cast("timestamp_ntz").alias("timestamp"),
    )
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    try:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2m")
        write_by_day(rows, str(tmp_path / "t"))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    assert len(list((tmp_path / "t" / "day=2024-01-01").glob("*.parquet"))) >= 3
    assert spark.read.parquet(str(tmp_path / "t")).count() == 40_000


def test_ranges_come_from_footers(spark):
    path = f"{SF}/events.parquet"
    got = parquet_ranges(spark, path, "event_id", "value")
    assert "PushedAggregation: [COUNT(*), MIN(event_id), MAX(event_id), MIN(value), MAX(value)]" in plan(got)
    low, high = spark.read.parquet(path).agg(F.min("value"), F.max("value")).first()
    assert {r["column"]: (r.rows, r.min, r.max) for r in got.collect()}["value"] == (1000, low, high)
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


# ---- merged profiles


def test_profiles_of_parts_merge_to_that_of_the_whole(spark):
    draw = random.Random(6)
    rows = [(i, draw.choice([None, draw.gauss(1e6, 3.0)]), draw.randrange(50), draw.choice(["a", "b", None])) for i in range(5000)]
    df = spark.createDataFrame(rows, "id long, x double, k int, day string").withColumn("gap", F.lit(None).cast("double"))
    columns = ["x", "k", "id", "gap"]
    whole = {r["column"]: r for r in profile.column_profile(df, columns).collect()}
    for kept in (
        durable(merging.partial_profile(df, columns, by="day")),
        durable(merging.partial_profile(df.where("id % 2 = 0"), columns)).union(merging.partial_profile(df.where("id % 2 = 1"), columns)),
        merging.partial_profile(df, columns),
    ):
        merged = {r["column"]: r for r in merging.merge_profiles(kept).collect()}
        for c in columns:
            a, b = merged[c], whole[c]
            assert (a.missing, a.min, a.max) == (b.missing, b.min, b.max)
            assert a["count"] == 5000 - b.missing
            for u, v in ((a.mean, b.mean), (a.stddev, b.stddev)):
                assert u == v if v is None else math.isclose(u, v, rel_tol=1e-9)
            assert abs(a.distinct - b.distinct) <= 3 * merging.ERROR * b.distinct
    one = spark.createDataFrame([(1.0,)], "x double")
    assert merging.merge_profiles(merging.partial_profile(one)).first().stddev is None


# ---- loads


def test_loads_give_the_rows_of_one(spark):
    rows = transactions(spark, SF).drop("time_since_last").withColumn(
        "customer_id", F.when(F.col("foreign_country") == 0, F.col("customer_id"))  # null is a customer as well
    )
    day = F.dayofmonth("timestamp")
    first, state = sequence.time_since_previous_load(rows.where(day < 10))
    second, state = sequence.time_since_previous_load(rows.where(day.between(10, 20)), state, heavy_rows=30)
    third, state = sequence.time_since_previous_load(rows.where(day > 20), state)
    whole = sequence.time_since_previous(rows)
    pick = lambda df: sorted((r.transaction_id, r.time_since_last) for r in df.collect())
    assert sorted([*pick(first), *pick(second), *pick(third)]) == pick(whole)
    assert first.columns == whole.columns
    expected = {(r.customer_id, r.last_time) for r in sequence.last_times(rows).collect()}
    assert {(r.customer_id, r.last_time) for r in state.collect()} == expected
    nothing, same = sequence.time_since_previous_load(rows.limit(0), state)
    assert nothing.count() == 0 and same.count() == state.count()
    with pytest.raises(ValueError, match="before the last times"):
        sequence.time_since_previous_load(rows.where(day == 5), state)


# ---- dictionaries


def test_joined_index_is_that_of_the_driver_dictionary(spark):
    rows = transactions(spark, SF)
    stages = lambda kind: feature_stages(["device_type", "merchant_category"], [], encoding=kind)
    some = rows.where("is_fraud = 1")  # so that the rest has values the dictionary lacks
    found = [
        {r.transaction_id: (r.device_type_index, r.merchant_category_index, r[FEATURES].toArray().tolist())
         for r in Pipeline(stages=stages(kind)).fit(some).transform(rows).collect()}
        for kind in ("one_hot", "joined")
    ]
    assert found[0] == found[1] and len(found[0]) == rows.count()


def test_dictionary_of_many_values(spark):
    n = 300_000
    rows = spark.range(n).select(F.concat(F.lit("v"), F.col("id") % (n * 2 // 3)).alias("v"))
    ranked = modeling.ranked_values(rows, "v")
    got = ranked.agg(F.count(F.lit(1)), F.count_distinct("index"), F.min("index"), F.max("index")).first()
    assert tuple(got) == (n * 2 // 3, n * 2 // 3, 0, n * 2 // 3 - 1)
    order = [(r.n, r.value) for r in ranked.orderBy("index").collect()]
    assert order == sorted(order, key=lambda r: (-r[0], r[1])) and order[0][0] == 2 and order[-1][0] == 1
    indexed = modeling.with_index(rows.union(spark.createDataFrame([(None,), ("new",)], "v string")), "v", ranked, "i")
    assert indexed.where("v IS NULL OR v = 'new'").select("i").distinct().collect() == [(float(n * 2 // 3),)]
    assert modeling.ranked_values(rows.limit(0), "v").count() == 0
    assert modeling.with_index(rows.limit(3), "v", modeling.ranked_values(rows.limit(0), "v"), "i").first().i == 0.0


def test_joined_dictionaries_train_a_model(spark):
    rows = transactions(spark, SF)
    fit = lambda kind: modeling.train_model(rows, "Decision Tree", ["merchant_category"], ["amount"], encoding=kind)
    a, b = (modeling.score(fit(kind), rows).select("transaction_id", "prediction", "probability").collect() for kind in ("one_hot", "joined"))
    assert sorted(a) == sorted(b)


# ---- medians


def lower_median(values):
    return statistics.median_low(values) if values else None


def test_medians_of_awkward_columns(spark, monkeypatch):
    draw = random.Random(7)
    columns = {
        "even": [float(i) for i in range(1000)],
        "odd": [float(i * 37 % 1001) for i in range(1001)],
        "hot": [5.0] * 700 + [draw.random() * 10 for _ in range(300)],
        "two": [1.0, 2.0] * 400,
        "tail": [10.0**draw.uniform(-300, 300) for _ in range(999)],
        "ends": [-math.inf] * 300 + [math.inf] * 301 + [1.0, 2.0],
        "same": [-7.25],
        "none": [],
        "gaps": [*(float(i) for i in range(9)), math.nan, math.nan, None],
    }
    n = max(map(len, columns.values()))
    rows = list(zip(*([*v, *[None] * (n - len(v))] for v in columns.values())))
    draw.shuffle(rows)
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in columns)).repartition(5)
    expected = {c: lower_median([x for x in v if x is not None and not math.isnan(x)]) for c, v in columns.items()}
    assert exact_medians(df, list(columns)) == expected
    # Narrow grids and no look at single values: brackets alone lead there too.
    monkeypatch.setattr(median, "ACCURACY", 20)
    assert exact_medians(df, list(columns), few=3, grid=8) == expected


def test_median_of_ten_million_rows(spark):
    df = spark.range(0, 10_000_000, 1, 8).select((F.pmod(F.col("id") * 7_919, F.lit(10_000_019)) / 8).alias("x"))
    exact = df.orderBy("x").select("x")  # the rank is known from a sort
    rank = 5_000_000
    got = exact_medians(df, ["x"])["x"]
    below, at = exact.agg(F.count_if(F.col("x") < got), F.count_if(F.col("x") == got)).first()
    assert below < rank <= below + at


def test_filled_gaps_survive_saving(spark, tmp_path):
    df = spark.createDataFrame([(1.0, 1), (None, 2), (3.0, None), (math.nan, 5), (4.0, 9)], "x double, k int")
    with pytest.raises(ValueError, match="no values to fill gaps from in: z"):
        MedianFill(["z"], ["f"]).fit(df.withColumn("z", F.lit(None).cast("double")))
    model = Pipeline(stages=feature_stages([], ["x", "k"])).fit(df)
    model.write().save(str(tmp_path / "m"))
    for m in (model, PipelineModel.load(str(tmp_path / "m"))):
        assert sorted(r[FEATURES].toArray().tolist() for r in m.transform(df).collect()) == [
            [1.0, 1.0], [3.0, 2.0], [3.0, 2.0], [3.0, 5.0], [4.0, 9.0],
        ]
