"""One registered query per operator. Keys start with the operator's number in the survey.

Means, deviations and areas are sums of doubles in no fixed order, so they are shown to 6 decimals.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.ml import Pipeline
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens import modeling
from ledgerlens.modeling.prepare import FEATURES, feature_stages
from ledgerlens.operators import clean, evaluate, features, merging, profile, reports, sequence
from ledgerlens.plans.inputs import profiles, transactions
from ledgerlens.schema import PROFILE_SCHEMA
from ledgerlens.scratch import durable, scratch_path
from ledgerlens.sources import (
    export_predictions,
    export_result,
    flatten_predictions,
    parquet_ranges,
    read_csv,
    read_days,
    read_parquet,
    register,
    write_by_day,
    write_csv,
)

Query = Callable[[SparkSession, str], DataFrame]

# Amounts of the given tables end near 560, so "high value" starts lower here than the default.
HIGH = 100
DECIMALS = 6

QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    """Register a query under `name`."""

    def add(function: Query) -> Query:
        QUERIES[name] = function
        return function

    return add


def _shown(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, DECIMALS) for c in columns})


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A scored table that needs no model: the amount is the score, a high amount the prediction."""
    return transactions(spark, sf_dir).select(
        "transaction_id",
        "is_fraud",
        F.col("amount").alias("score"),
        (F.col("amount") > HIGH).cast("double").alias("prediction"),
    )


# ---- sources and sinks


@query("S1_csv_round_trip")
def csv_round_trip(spark, sf_dir):
    path = scratch_path(spark, "transactions-csv")
    write_csv(transactions(spark, sf_dir), path)
    return read_csv(spark, path)


@query("S1_csv_inferred")
def csv_inferred(spark, sf_dir):
    path = scratch_path(spark, "profiles-csv")
    write_csv(profiles(spark, sf_dir), path)
    return read_csv(spark, path, infer=True)


@query("S1_csv_inferred_transactions")
def csv_inferred_transactions(spark, sf_dir):
    """All columns of the transactions with inferred types; times are instants, shown in the session's zone."""
    path = scratch_path(spark, "transactions-csv")
    write_csv(transactions(spark, sf_dir), path)
    inferred = read_csv(spark, path, infer=True)
    return inferred.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


# Days within the given events.
FIRST_DAY, LAST_DAY = "2024-01-09", "2024-01-12"


@query("S1_S4_days")
def days(spark, sf_dir):
    """Some days of a table that is laid out by day."""
    path = scratch_path(spark, "days")
    write_by_day(transactions(spark, sf_dir), path)
    return read_days(spark, path, FIRST_DAY, LAST_DAY)


@query("S1_parquet_scan")
def parquet_scan(spark, sf_dir):
    return (
        read_parquet(spark, f"{sf_dir}/events.parquet")
        .where(F.col("value") > HIGH)
        .select("event_id", "value")
    )


@query("S1_parquet_whole")
def parquet_whole(spark, sf_dir):
    return read_parquet(spark, f"{sf_dir}/events.parquet")


# Fixed value: text that flat files easily lose, valid in both engines.
AWKWARD = """CASE event_id % 8 WHEN 0 THEN ' lead' WHEN 1 THEN 'trail ' WHEN 2 THEN ''
    WHEN 3 THEN concat('two', chr(10), 'lines') WHEN 4 THEN 'say "hi", "you"'
    WHEN 5 THEN concat('back', chr(92), 'slash', chr(92)) WHEN 6 THEN concat('a,b', chr(92), '"') END"""


@query("S1_csv_awkward_text")
def csv_awkward_text(spark, sf_dir):
    path = scratch_path(spark, "text-csv")
    rows = read_parquet(spark, f"{sf_dir}/events.parquet").selectExpr("event_id", f"{AWKWARD} AS note", "ts")
    write_csv(rows, path)
    return read_csv(spark, path, rows.schema, multiLine=True, mode="FAILFAST")


@query("S2_registered_view")
def registered_view(spark, sf_dir):
    register(transactions(spark, sf_dir), "transactions")
    return spark.table("transactions").groupBy("currency").agg(F.count(F.lit(1)).alias("n"))


@query("S3_preview")
def preview(spark, sf_dir):
    return reports.preview(transactions(spark, sf_dir), 10, by="transaction_id")


@query("S4_export_result")
def export_query_result(spark, sf_dir):
    path = scratch_path(spark, "result-csv")
    export_result(reports.fraud_rate_by(transactions(spark, sf_dir), "customer_id"), path)
    return read_csv(
        spark, path, "customer_id string, total bigint, fraud_count bigint, fraud_percent double"
    )


@query("S5_export_predictions")
def export_all_predictions(spark, sf_dir):
    """A scored table with vectors, exported with all its columns and read back with their types."""
    path = scratch_path(spark, "predictions-csv")
    fraud = F.when(F.col("amount") > HIGH, 0.75).otherwise(0.25)
    scored = transactions(spark, sf_dir).withColumns(
        {
            FEATURES: array_to_vector(F.array(F.col("foreign_country") * 1.0, F.hour("timestamp") * 1.0)),
            "probability": array_to_vector(F.array(1 - fraud, fraud)),
            "prediction": (F.col("amount") > HIGH).cast("double"),
        }
    )
    export_predictions(scored, path)
    return read_csv(spark, path, flatten_predictions(scored).schema)


# ---- cleaning


@query("C1_fill_missing")
def fill_missing(spark, sf_dir):
    return clean.fill_missing(transactions(spark, sf_dir)).select("transaction_id", "device_type")


@query("C2_parse_time")
def parse_time(spark, sf_dir):
    text = transactions(spark, sf_dir).select(
        "transaction_id",
        F.when(F.col("is_fraud") == 1, F.concat(F.lit("at "), F.col("customer_id")))
        .otherwise(F.col("timestamp").cast("string"))
        .alias("timestamp"),
    )
    return clean.parse_time(text).withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


def _with_copies(spark, sf_dir) -> DataFrame:
    rows = transactions(spark, sf_dir)
    return rows.union(rows.where(F.col("amount") > HIGH))


@query("C3_drop_duplicates")
def drop_duplicates(spark, sf_dir):
    return clean.drop_exact_duplicates(_with_copies(spark, sf_dir))


@query("C3_drop_duplicates_screened")
def drop_duplicates_screened(spark, sf_dir):
    """C3 in the form that large tables take."""
    return clean.drop_exact_duplicates(_with_copies(spark, sf_dir), screen=True)


@query("C4_clean")
def clean_all(spark, sf_dir):
    return clean.clean(_with_copies(spark, sf_dir))


# ---- profiling


@query("P1_row_count")
def row_count(spark, sf_dir):
    return profile.row_count(transactions(spark, sf_dir))


@query("P2_columns")
def columns(spark, sf_dir):
    return profile.column_overview(transactions(spark, sf_dir))


@query("P3_describe_numbers")
def describe_numbers(spark, sf_dir):
    return _shown(profile.describe_numbers(transactions(spark, sf_dir)), "mean", "stddev")


@query("P3_describe_text")
def describe_text(spark, sf_dir):
    return profile.describe_text(transactions(spark, sf_dir))


@query("P5_distinct")
def distinct_values(spark, sf_dir):
    return profile.distinct_count(
        transactions(spark, sf_dir), "amount", "device_type", "customer_id", "time_since_last"
    )


@query("P5_distinct_approx")
def distinct_values_approx(spark, sf_dir):
    """Whether each sketch is within three deviations (of 5 percent) of the exact count."""
    rows = transactions(spark, sf_dir)
    columns = ["amount", "device_type", "customer_id", "time_since_last"]
    exact = profile.distinct_count(rows, *columns)
    sketch = profile.distinct_count(rows, *columns, approx=True).withColumnRenamed("distinct", "sketch")
    near = F.abs(F.col("sketch") - F.col("distinct")) <= 0.15 * F.col("distinct")
    return exact.join(sketch, "column").withColumn("near", near).drop("sketch")


@query("P6_missing")
def missing_values(spark, sf_dir):
    return profile.missing_count(transactions(spark, sf_dir), "amount", "device_type", "time_since_last")


@query("P8_column_stats")
def column_stats(spark, sf_dir):
    return _shown(
        profile.column_stats(transactions(spark, sf_dir), "amount", "time_since_last"), "mean", "stddev"
    )


@query("P9_histogram")
def histogram(spark, sf_dir):
    return profile.histogram(transactions(spark, sf_dir), "amount")


@query("P1_P8_ranges_from_footers")
def ranges_from_footers(spark, sf_dir):
    return parquet_ranges(spark, f"{sf_dir}/events.parquet", "event_id", "user_id", "value")


@query("P9_histogram_known_range")
def histogram_known_range(spark, sf_dir):
    """P9 in one pass over the rows: the range comes from the file footers."""
    path = f"{sf_dir}/events.parquet"
    known = parquet_ranges(spark, path, "value").first()
    return profile.histogram(read_parquet(spark, path), "value", span=(known["min"], known["max"]))


@query("P10_value_counts")
def value_counts(spark, sf_dir):
    return profile.value_counts(transactions(spark, sf_dir), "device_type")


@query("P11_distribution_many_values")
def distribution_many(spark, sf_dir):
    return profile.profile_distribution(transactions(spark, sf_dir), "time_since_last")


@query("P11_distribution_few_values")
def distribution_few(spark, sf_dir):
    return profile.profile_distribution(transactions(spark, sf_dir), "foreign_country")


@query("P12_column_profile")
def column_profile(spark, sf_dir):
    return _shown(profile.column_profile(transactions(spark, sf_dir)), "mean", "stddev")


@query("P12_profile_merged_from_days")
def profile_merged(spark, sf_dir):
    """Profiles of single days, written out and merged; `near`: the distinct count is within three standard errors."""
    rows = transactions(spark, sf_dir).withColumn("day", F.to_date("timestamp"))
    columns = profile.numeric_columns(rows)
    kept = durable(merging.partial_profile(rows, columns, by="day"))
    merged = merging.merge_profiles(kept).withColumnRenamed("distinct", "sketch")
    exact = profile.distinct_count(rows, *columns)
    near = F.abs(F.col("sketch") - F.col("distinct")) <= 3 * merging.ERROR * F.col("distinct")
    return _shown(merged.join(exact, "column").withColumn("near", near).drop("sketch"), "mean", "stddev")


# ---- reports


@query("A1_label_statistics")
def label_statistics(spark, sf_dir):
    return _shown(reports.label_statistics(transactions(spark, sf_dir)), "avg_amount", "std_amount")


@query("A2_fraud_rate_by_merchant")
def fraud_rate_by_merchant(spark, sf_dir):
    return reports.fraud_rate_by(transactions(spark, sf_dir), "merchant_category", top=10)


@query("A3_fraud_rate_by_device")
def fraud_rate_by_device(spark, sf_dir):
    return reports.fraud_rate_by(transactions(spark, sf_dir), "device_type")


@query("A4_explore")
def explore(spark, sf_dir):
    found = reports.explore(transactions(spark, sf_dir))
    keys = {"fraud_stats": "is_fraud", "merchant_stats": "merchant_category", "device_stats": "device_type"}
    parts = [
        table.withColumns({"report": F.lit(name), "value": F.col(keys[name]).cast("string")})
        .withColumnRenamed("count", "total")
        .drop(keys[name])
        for name, table in found.items()
    ]
    return _shown(
        reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts), "avg_amount", "std_amount"
    )


@query("A5_fraud_by_category")
def fraud_by_category(spark, sf_dir):
    return reports.fraud_rate_by(transactions(spark, sf_dir), "merchant_category", rate="fraud_percentage")


@query("A6_recent_high_value")
def recent_high_value(spark, sf_dir):
    return reports.recent_high_value(transactions(spark, sf_dir), HIGH)


@query("A7_default_listing")
def default_listing(spark, sf_dir):
    register(transactions(spark, sf_dir), "transactions")
    return reports.run_sql(spark, "SELECT * FROM transactions ORDER BY transaction_id LIMIT 10")


FREE_SQL = """
    SELECT t.customer_id, p.home_lat, COUNT(*) AS n, MAX(t.amount) AS largest,
           SUM(t.is_fraud) AS frauds
    FROM transactions t JOIN profiles p ON p.customer_id = t.customer_id
    WHERE t.transaction_type <> 'atm'
    GROUP BY t.customer_id, p.home_lat
    ORDER BY n DESC, t.customer_id
"""


@query("A8_free_sql")
def free_sql(spark, sf_dir):
    register(transactions(spark, sf_dir), "transactions")
    register(profiles(spark, sf_dir), "profiles")
    return reports.run_sql(spark, FREE_SQL)


# ---- features


@query("F1_F3_calendar")
def calendar(spark, sf_dir):
    return features.with_calendar(transactions(spark, sf_dir)).select(
        "transaction_id", "hour_of_day", "day_of_week", "month"
    )


@query("F4_distance_from_home")
def distance_from_home(spark, sf_dir):
    located = sequence.attach_home(transactions(spark, sf_dir), profiles(spark, sf_dir))
    return features.with_distance(located).select("transaction_id", "distance_from_home")


@query("F5_distance_from_origin")
def distance_from_origin(spark, sf_dir):
    return features.with_distance(transactions(spark, sf_dir)).select("transaction_id", "distance_from_home")


@query("F6_velocity")
def velocity(spark, sf_dir):
    return features.with_velocity(transactions(spark, sf_dir)).select("transaction_id", "txn_velocity")


@query("F7_F8_off_hours")
def off_hours(spark, sf_dir):
    rows = features.with_calendar(transactions(spark, sf_dir))
    return features.with_off_hours(rows).select("transaction_id", "off_hours")


@query("F9_features")
def all_features(spark, sf_dir):
    return features.build_features(clean.clean(transactions(spark, sf_dir)))


@query("R1_time_since_previous")
def time_since_previous(spark, sf_dir):
    rows = transactions(spark, sf_dir).drop("time_since_last")
    return sequence.time_since_previous(rows).select("transaction_id", "customer_id", "time_since_last")


@query("R1_time_since_previous_hot_customer")
def time_since_previous_hot(spark, sf_dir):
    """R1 where one customer holds a third of all rows and a task may sort a 24th of them."""
    rows = transactions(spark, sf_dir).drop("time_since_last")
    in_third = F.expr("substr(customer_id, 6)").cast("bigint") % 3 == 0
    hot = rows.withColumn("customer_id", F.when(in_third, F.lit("CUST_HOT")).otherwise(F.col("customer_id")))
    return sequence.time_since_previous(hot, heavy_rows=max(1, rows.count() // 24)).select(
        "transaction_id", "customer_id", "time_since_last"
    )


@query("R1_time_since_previous_loads")
def time_since_previous_loads(spark, sf_dir):
    """R1 over four loads, a week or so each, that see the ones before as a table of last times only."""
    rows, state, parts = transactions(spark, sf_dir).drop("time_since_last"), None, []
    week = F.least(F.floor((F.dayofmonth("timestamp") - 1) / 7), F.lit(3))
    for i in range(4):
        found, state = sequence.time_since_previous_load(rows.where(week == i), state)
        parts.append(found.select("transaction_id", "customer_id", "time_since_last"))
    return reduce(DataFrame.unionByName, parts)


@query("R2_attach_home")
def attach_home(spark, sf_dir):
    return sequence.attach_home(transactions(spark, sf_dir), profiles(spark, sf_dir)).select(
        "transaction_id", *PROFILE_SCHEMA.fieldNames()
    )


# ---- modelling


def _split(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    return modeling.hash_split(features.build_features(clean.clean(transactions(spark, sf_dir))))


CHOSEN = ["merchant_category", "amount", "distance_from_home", "hour_of_day", "txn_velocity"]


def _fit(train: DataFrame, model: str, **options):
    categorical, numeric = modeling.feature_roles(train, CHOSEN)
    return modeling.train_model(train, model, categorical, numeric, **options)


def _scores(spark, sf_dir, model: str) -> DataFrame:
    train, test = _split(spark, sf_dir)
    return flatten_predictions(
        modeling.score(_fit(train, model), test).select(
            "transaction_id", "is_fraud", "prediction", "probability"
        )
    ).drop("probability")


@query("M1_hash_split")
def hash_split(spark, sf_dir):
    train, test = modeling.hash_split(transactions(spark, sf_dir).select("transaction_id"))
    return train.withColumn("part", F.lit("train")).union(test.withColumn("part", F.lit("test")))


@query("M2_feature_roles")
def feature_roles(spark, sf_dir):
    """Role of each chosen feature, one of them yes or no, with the rows that have a value."""
    rows = features.build_features(transactions(spark, sf_dir)).withColumn("abroad", F.col("foreign_country") > 0)
    categorical, numeric = modeling.feature_roles(rows, [*CHOSEN, "abroad"])
    cells = [
        F.struct(F.lit(c).alias("feature"), F.lit(role).alias("role"), F.count(c).alias("filled"))
        for role, columns in (("categorical", categorical), ("numeric", numeric))
        for c in columns
    ]
    return rows.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


@query("M3_class_weights")
def class_weights(spark, sf_dir):
    return modeling.class_weights(transactions(spark, sf_dir)).select(
        "transaction_id", "is_fraud", "class_weight"
    )


def _staged(spark, sf_dir, categorical: list[str], numeric: list[str], **options) -> DataFrame:
    rows = features.build_features(transactions(spark, sf_dir))
    return Pipeline(stages=feature_stages(categorical, numeric, **options)).fit(rows).transform(rows)


def _slots(vector: str, n: int) -> list:
    values = vector_to_array(vector)
    return [values[i].alias(f"slot_{i}") for i in range(n)]


@query("M4_string_index")
def string_index(spark, sf_dir):
    return _staged(spark, sf_dir, ["device_type", "merchant_category"], []).select(
        "transaction_id", "device_type_index", "merchant_category_index"
    )


@query("M5_one_hot")
def one_hot(spark, sf_dir):
    return _staged(spark, sf_dir, ["device_type"], []).select(
        "transaction_id", *_slots("device_type_encoded", 3)
    )


@query("M4_joined_index")
def joined_index(spark, sf_dir):
    """Indexes from dictionaries that never reach the driver, one of them of customers."""
    rows = transactions(spark, sf_dir)
    for c in ("device_type", "merchant_category", "customer_id"):
        rows = modeling.with_index(rows, c, modeling.ranked_values(rows, c), f"{c}_index")
    return rows.select("transaction_id", "device_type_index", "merchant_category_index", "customer_id_index")


@query("M5_joined_one_hot")
def joined_one_hot(spark, sf_dir):
    return _staged(spark, sf_dir, ["device_type"], [], encoding="joined").select(
        "transaction_id", *_slots("device_type_encoded", 3)
    )


@query("M6_medians")
def medians(spark, sf_dir):
    rows = features.build_features(transactions(spark, sf_dir))
    found = modeling.exact_medians(rows, ["amount", "time_since_last", "txn_velocity", "distance_from_home"])
    cells = [F.struct(F.lit(c).alias("column"), F.lit(v).cast("double").alias("median")) for c, v in found.items()]
    return spark.range(1).select(F.inline(F.array(*cells)))


@query("M6_M7_feature_vector")
def feature_vector(spark, sf_dir):
    return _staged(spark, sf_dir, ["device_type"], ["amount", "hour_of_day"]).select(
        "transaction_id", *_slots(FEATURES, 5)
    )


@query("M6_feature_vector_gaps")
def feature_vector_gaps(spark, sf_dir):
    """Gaps in the velocity take its median."""
    return _staged(spark, sf_dir, [], ["amount", "txn_velocity"]).select(
        "transaction_id", *_slots(FEATURES, 2)
    )


@query("M8_logistic_regression")
def logistic_regression(spark, sf_dir):
    return _scores(spark, sf_dir, "Logistic Regression")


@query("M9_decision_tree")
def decision_tree(spark, sf_dir):
    return _scores(spark, sf_dir, "Decision Tree")


@query("M10_random_forest")
def random_forest(spark, sf_dir):
    return _scores(spark, sf_dir, "Random Forest")


@query("M11_M12_train_evaluate")
def train_evaluate(spark, sf_dir):
    train, test = _split(spark, sf_dir)
    model = _fit(train, "Logistic Regression", params={"regParam": 0.1, "maxIter": 100})
    return modeling.evaluate_model(model, test)[0]


@query("M13_feature_importance")
def feature_importance(spark, sf_dir):
    train, _ = _split(spark, sf_dir)
    return modeling.feature_importance(_fit(train, "Random Forest"), train)


# Settings under which each model has a closed form for one feature of two values: its probability is
# the weighted share of class 1 among the training rows with that value.
EXACT: dict[str, dict] = {
    "Logistic Regression": {"regParam": 0.0, "elasticNetParam": 0.0, "maxIter": 100, "tol": 1e-10},
    "Decision Tree": {"maxDepth": 1},
    "Random Forest": {
        "maxDepth": 1,
        "numTrees": 3,
        "subsamplingRate": 1.0,
        "bootstrap": False,
        "featureSubsetStrategy": "all",
    },
}


def _exact_fit(train: DataFrame, model: str, *columns: str):
    return modeling.train_model(train, model, [], list(columns), params=EXACT[model])


def _exact_scores(spark, sf_dir, model: str, decimals: int) -> DataFrame:
    train, test = _split(spark, sf_dir)
    scored = modeling.score(_exact_fit(train, model, "multiple_quick_trans"), test)
    return flatten_predictions(scored).select(
        "transaction_id",
        "is_fraud",
        F.col(FEATURES).alias("slots"),
        "prediction",
        F.round("p_fraud", decimals).alias("p_fraud"),
    )


@query("M8_logistic_regression_one_feature")
def logistic_regression_one_feature(spark, sf_dir):
    return _exact_scores(spark, sf_dir, "Logistic Regression", 4)


@query("M9_decision_tree_one_feature")
def decision_tree_one_feature(spark, sf_dir):
    return _exact_scores(spark, sf_dir, "Decision Tree", DECIMALS)


@query("M10_E2_random_forest_one_feature")
def random_forest_one_feature(spark, sf_dir):
    return _exact_scores(spark, sf_dir, "Random Forest", DECIMALS)


@query("M11_M12_train_evaluate_one_feature")
def train_evaluate_one_feature(spark, sf_dir):
    train, test = _split(spark, sf_dir)
    model = _exact_fit(train, "Logistic Regression", "multiple_quick_trans")
    return _shown(modeling.evaluate_model(model, test)[0], "auc", "pr_auc")


@query("M13_feature_importance_two_features")
def feature_importance_two_features(spark, sf_dir):
    """One split over two features: all importance goes to the one that splits the classes better."""
    train, _ = _split(spark, sf_dir)
    model = _exact_fit(train, "Decision Tree", "multiple_quick_trans", "foreign_country")
    return modeling.feature_importance(model, train)


# ---- evaluation


@query("E1_hash_sample")
def hash_sample(spark, sf_dir):
    return evaluate.hash_sample(_scored(spark, sf_dir), 0.1)


@query("E2_score")
def score_rows(spark, sf_dir):
    train, test = _split(spark, sf_dir)
    return flatten_predictions(modeling.score(_fit(train, "Decision Tree"), test))


@query("E3_area_under_roc")
def area_under_roc(spark, sf_dir):
    return _shown(evaluate.area_under_roc(_scored(spark, sf_dir)), "auc")


@query("E4_area_under_pr")
def area_under_pr(spark, sf_dir):
    return _shown(evaluate.area_under_pr(_scored(spark, sf_dir)), "pr_auc")


# Points that curves with bins keep.
POINTS = 1000


@query("E3_E4_areas_of_bins")
def areas_of_bins(spark, sf_dir):
    """The exact areas, and whether those of bins are as near as they say, and near enough to be of use."""
    rows = _scored(spark, sf_dir)
    found = evaluate.area_under_roc(rows).crossJoin(evaluate.area_under_pr(rows))  # one row each
    for name, area in (("auc", evaluate.area_under_roc), ("pr_auc", evaluate.area_under_pr)):
        binned = area(rows, bins=POINTS).withColumnRenamed(name, "about")
        gap, within = F.abs(F.col("about") - F.col(name)), F.col(f"{name}_within")
        found = found.crossJoin(binned).withColumn(f"{name}_near", (gap <= within + 1e-12) & (within < 0.05))
        found = found.drop("about", f"{name}_within")
    return _shown(found, "auc", "pr_auc")


@query("E8_evaluate_bins")
def evaluate_bins(spark, sf_dir):
    """Rates and counts, which bins leave exact, and whether the bounds on the areas are narrow."""
    found = evaluate.evaluate(_scored(spark, sf_dir), bins=POINTS)
    narrow = (F.col("auc_within") < 0.05) & (F.col("pr_auc_within") < 0.05)
    return found.withColumn("narrow", narrow).drop("auc", "pr_auc", "auc_within", "pr_auc_within")


@query("E11_roc_curve_of_bins")
def roc_curve_of_bins(spark, sf_dir):
    """Whether every point is one of the exact curve, and whether there are about as many as asked for."""
    rows = _scored(spark, sf_dir)
    some = evaluate.roc_curve(rows, bins=POINTS, origin=False)
    exact = evaluate.roc_curve(rows, origin=False).withColumn("exact", F.lit(True))
    same = some.join(exact, ["threshold", "tpr", "fpr"], "left")
    return same.agg(
        F.every(F.coalesce("exact", F.lit(False))).alias("on_the_curve"),
        F.count(F.lit(1)).between(POINTS // 2, POINTS + 1).alias("enough"),
        F.max("tpr").alias("tpr"),
        F.max("fpr").alias("fpr"),
    )


@query("E5_confusion")
def confusion(spark, sf_dir):
    return evaluate.confusion(_scored(spark, sf_dir))


@query("E6_E7_rates")
def rates(spark, sf_dir):
    return evaluate.classification_rates(_scored(spark, sf_dir))


@query("E8_evaluate")
def evaluate_all(spark, sf_dir):
    return _shown(evaluate.evaluate(_scored(spark, sf_dir)), "auc", "pr_auc")


@query("E9_sample_predictions")
def sample_predictions(spark, sf_dir):
    rows = features.build_features(transactions(spark, sf_dir)).withColumns(
        {"prediction": (F.col("amount") > HIGH).cast("double"), "probability": F.col("amount") / 1000}
    )
    return evaluate.sample_predictions(rows, features.DEFAULT_FEATURES)


@query("E10_prediction_distribution")
def prediction_distribution(spark, sf_dir):
    return evaluate.prediction_distribution(_scored(spark, sf_dir))


@query("E11_roc_curve")
def roc_curve(spark, sf_dir):
    return evaluate.roc_curve(_scored(spark, sf_dir))


@query("E12_confusion_matrix")
def confusion_matrix(spark, sf_dir):
    return evaluate.confusion_matrix(_scored(spark, sf_dir))


@query("E12_confusion_table")
def confusion_table(spark, sf_dir):
    return evaluate.confusion_table(_scored(spark, sf_dir))
