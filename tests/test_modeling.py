import pytest
from pyspark.sql import functions as F

from ledgerlens import modeling
from ledgerlens.modeling.train import MODELS
from ledgerlens.operators import evaluate, features
from ledgerlens.plans.inputs import transactions
from ledgerlens.sources import export_predictions, flatten_predictions

SF_DIR = "/root/testdata/sf0.01"
TEXT, NUMBERS = ["merchant_category"], ["amount", "hour_of_day"]


@pytest.fixture(scope="module")
def parts(spark):
    rows = features.build_features(transactions(spark, SF_DIR)).cache()
    return modeling.hash_split(rows)


@pytest.fixture(scope="module")
def logistic(parts):
    return modeling.train_model(parts[0], "Logistic Regression", TEXT, NUMBERS)


def test_split_is_complete_disjoint_and_blind_to_partitioning(parts, spark):
    train, test = parts
    assert train.count() + test.count() == 10_000 and 1800 < test.count() < 2200
    whole = transactions(spark, SF_DIR)
    again = modeling.hash_split(whole.repartition(13))[1]
    assert {r[0] for r in again.select("transaction_id").collect()} == {
        r[0] for r in test.select("transaction_id").collect()
    }
    with pytest.raises(ValueError, match="test_percent"):
        modeling.hash_split(whole, 100)


def test_rows_without_id_are_not_lost(spark):
    df = spark.createDataFrame([(None,), ("a",)], "transaction_id string")
    train, test = modeling.hash_split(df)
    assert train.count() + test.count() == 2


def test_roles_by_type(parts):
    assert modeling.feature_roles(parts[0], ["amount", "device_type", "is_fraud"]) == (
        ["device_type"],
        ["amount", "is_fraud"],
    )
    with pytest.raises(ValueError, match="timestamp"):
        modeling.feature_roles(parts[0], ["timestamp"])


def _weights(spark, labels, **options):
    df = spark.createDataFrame([(v,) for v in labels], "is_fraud int")
    return {r.is_fraud: r.class_weight for r in modeling.class_weights(df, **options).collect()}


def test_weights_are_the_other_class_share(spark):
    w = _weights(spark, [0] * 8 + [1] * 2)
    assert w == {1: 0.8, 0: 0.2}
    assert 2 * w[1] == 8 * w[0]
    assert _weights(spark, [0, 0, 0]) == {0: 1.0}
    assert _weights(spark, [1]) == {1: 1.0}
    assert _weights(spark, [0, 0, 1], weighting="none") == {0: 1.0, 1: 1.0}
    assert _weights(spark, []) == {}
    with pytest.raises(ValueError, match="weighting"):
        _weights(spark, [0, 1], weighting="other")


def test_other_label_column(spark, parts):
    train = parts[0].withColumnRenamed("is_fraud", "bad")
    model = modeling.train_model(train, "Decision Tree", [], ["amount"], label="bad")
    metrics, _ = modeling.evaluate_model(model, parts[1].withColumnRenamed("is_fraud", "bad"), label="bad")
    assert metrics.first().auc > 0.7


@pytest.mark.parametrize("name", sorted(MODELS))
def test_models_rank_fraud_above_the_rest(parts, name):
    train, test = parts
    model = modeling.train_model(train, name, TEXT, NUMBERS)
    metrics, scored = modeling.evaluate_model(model, test)
    row = metrics.first()
    assert row.auc > 0.85
    assert row.tp + row.fp + row.fn + row.tn == test.count() == scored.count()


def test_unknown_model(parts):
    with pytest.raises(ValueError, match="unknown model 'Perceptron'"):
        modeling.train_model(parts[0], "Perceptron", [], ["amount"])


def test_settings_reach_the_estimator(parts):
    model = modeling.train_model(parts[0], "Logistic Regression", [], ["amount"], params={"regParam": 0.3, "maxIter": 7})
    fitted = model.stages[-1]
    assert (fitted.getRegParam(), fitted.getMaxIter(), fitted.getElasticNetParam()) == (0.3, 7, 0.5)
    tree = modeling.train_model(parts[0], "Decision Tree", [], ["amount"], params={"maxDepth": 2})
    assert tree.stages[-1].depth <= 2
    with pytest.raises(TypeError):
        modeling.train_model(parts[0], "Decision Tree", [], ["amount"], params={"nonsense": 1})


def test_balancing_raises_recall(parts, logistic):
    train, test = parts
    plain = modeling.train_model(train, "Logistic Regression", TEXT, NUMBERS, weighting="none")
    recall = {
        name: modeling.evaluate_model(m, test)[0].first().recall for name, m in (("b", logistic), ("p", plain))
    }
    assert recall["b"] > recall["p"] + 0.2


def test_gaps_are_filled_and_an_empty_column_is_named(parts):
    train, test = parts
    model = modeling.train_model(train, "Decision Tree", [], ["txn_velocity", "amount"])
    assert modeling.score(model, test).where("prediction IS NULL").count() == 0
    with pytest.raises(ValueError, match="nothing"):
        modeling.train_model(
            train.withColumn("nothing", F.lit(None).cast("double")), "Decision Tree", [], ["nothing"]
        )


def test_too_many_categories_are_refused(parts):
    with pytest.raises(ValueError, match="transaction_id"):
        modeling.train_model(parts[0], "Decision Tree", ["transaction_id"], [], max_categories=100)


def test_unseen_and_missing_categories_are_scored(parts, logistic):
    row = parts[1].limit(1)
    for value in (F.lit("never seen"), F.lit(None).cast("string")):
        got = modeling.score(logistic, row.withColumn("merchant_category", value)).first()
        assert got.merchant_category_index == 5.0
        assert got.prediction in (0.0, 1.0)


def test_importance_names_match_slots(parts):
    train, _ = parts
    model = modeling.train_model(train, "Random Forest", TEXT, NUMBERS)
    rows = modeling.feature_importance(model, train).collect()
    assert len(rows) == 6 + 2
    assert rows[0].feature == "amount"
    assert abs(sum(r.importance for r in rows) - 1) < 1e-9
    assert {r.source for r in rows} == {"merchant_category", "amount", "hour_of_day"}
    rolled = {r.feature: r.importance for r in modeling.source_importance(model, train).collect()}
    assert set(rolled) == {"merchant_category", "amount", "hour_of_day"}
    assert rolled["amount"] == max(rolled.values())


def test_importance_needs_a_tree(parts, logistic):
    with pytest.raises(ValueError, match="no feature importance"):
        modeling.feature_importance(logistic, parts[0])


def test_sampled_evaluation_is_optional(parts, logistic):
    _, test = parts
    metrics, scored = modeling.evaluate_model(logistic, test, sample_fraction=0.5)
    n = scored.count()
    assert 0.4 * test.count() < n < 0.6 * test.count()
    row = metrics.first()
    assert row.tp + row.fp + row.fn + row.tn == n


def test_export_writes_every_prediction(spark, parts, logistic, tmp_path):
    scored = modeling.score(logistic, parts[1])
    export_predictions(scored, str(tmp_path / "out"))
    back = spark.read.option("header", True).csv(str(tmp_path / "out"))
    assert back.count() == scored.count()
    assert set(scored.columns) | {"p_fraud"} == set(back.columns)
    flat = flatten_predictions(scored).first()
    assert flat.probability.startswith("[") and 0 <= flat.p_fraud <= 1


def test_curve_of_model_scores(parts, logistic):
    flat = flatten_predictions(modeling.score(logistic, parts[1]))
    points = evaluate.roc_curve(flat, score="p_fraud")
    assert points.count() > 100


def test_yes_or_no_is_a_number_and_text_may_be_hashed(spark):
    rows = [(i, bool(i % 3 == 0), f"t{i}", int(i % 3 == 0)) for i in range(60)]
    df = spark.createDataFrame(rows, "transaction_id int, flag boolean, name string, is_fraud int")
    text, numbers = modeling.feature_roles(df, ["flag", "name"])
    assert (text, numbers) == (["name"], ["flag"])
    model = modeling.train_model(df, "Logistic Regression", text, numbers, encoding="hashed")
    assert modeling.score(model, df).where("prediction = is_fraud").count() == 60
    with pytest.raises(ValueError, match="encoding"):
        modeling.train_model(df, "Logistic Regression", text, numbers, encoding="other")
