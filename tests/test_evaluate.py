import math

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from ledgerlens.operators import evaluate

SCHEMA = "transaction_id string, is_fraud int, prediction double, score double"


@pytest.fixture(scope="module")
def scored(spark):
    rows = []
    for i in range(2000):
        score = round(((i * 7919) % 997) / 997, 2 if i % 3 else 4)
        rows.append((f"T{i}", int((i * 31) % 100 < 100 * score**2), float(score > 0.6), score))
    return spark.createDataFrame(rows, SCHEMA).cache()


def _brute(rows):
    """Points of the ROC curve and both areas, counted in plain Python."""
    by_score = {}
    for r in rows:
        cell = by_score.setdefault(r.score, [0, 0])
        cell[r.is_fraud] += 1
    all_neg = sum(c[0] for c in by_score.values())
    all_pos = sum(c[1] for c in by_score.values())
    tp = fp = 0
    points, area, pr, before = [(0.0, 0.0)], 0.0, 0.0, None
    for s in sorted(by_score, reverse=True):
        neg, pos = by_score[s]
        area += neg * (tp + pos / 2)
        tp, fp = tp + pos, fp + neg
        after = tp / (tp + fp)
        pr += pos * (after + (after if before is None else before)) / 2
        before = after
        points.append((tp / all_pos, fp / all_neg))
    return points, area / (all_pos * all_neg), pr / all_pos


def _areas(df, **options):
    c = evaluate._cumulated(df, "is_fraud", "score", **options)
    return c.agg(*[a.alias(n) for n, a in evaluate._areas().items()]).first()


@pytest.mark.parametrize("range_scores", [10**6, 100])
def test_areas_agree_with_brute_force_in_one_or_many_ranges(scored, range_scores):
    _, auc, pr = _brute(scored.collect())
    got = _areas(scored, range_scores=range_scores)
    assert math.isclose(got.auc, auc, rel_tol=1e-12) and math.isclose(got.pr_auc, pr, rel_tol=1e-12)


def test_areas_agree_with_the_spark_evaluator(scored):
    for name, df in (("areaUnderROC", evaluate.area_under_roc), ("areaUnderPR", evaluate.area_under_pr)):
        judge = BinaryClassificationEvaluator(
            labelCol="is_fraud", rawPredictionCol="score", metricName=name, numBins=0
        )
        assert math.isclose(df(scored).first()[0], judge.evaluate(scored), rel_tol=1e-9)


@pytest.mark.parametrize("range_scores", [10**6, 100])
def test_curve_agrees_with_brute_force(scored, range_scores, monkeypatch):
    monkeypatch.setattr(evaluate._cumulated, "__defaults__", (None, range_scores))
    points, _, _ = _brute(scored.collect())
    got = evaluate.roc_curve(scored).orderBy(F.desc("threshold")).collect()
    assert [(r.tpr, r.fpr) for r in got] == points
    assert math.isinf(got[0].threshold) and (got[-1].tpr, got[-1].fpr) == (1.0, 1.0)
    assert all(a.tpr <= b.tpr and a.fpr <= b.fpr for a, b in zip(got, got[1:]))


def test_one_score_for_a_third_of_the_rows(scored):
    hot = scored.withColumn("score", F.when(F.hash("transaction_id") % 3 == 0, 0.5).otherwise(F.col("score")))
    _, auc, pr = _brute(hot.collect())
    got = _areas(hot, range_scores=50)
    assert math.isclose(got.auc, auc, rel_tol=1e-12) and math.isclose(got.pr_auc, pr, rel_tol=1e-12)


def test_counts_add_up_and_all_forms_agree(scored):
    c = evaluate.confusion(scored).first()
    assert c.tp + c.fp + c.fn + c.tn == 2000
    assert [tuple(r) for r in evaluate.confusion_matrix(scored).collect()] == [(0, c.tn, c.fp), (1, c.fn, c.tp)]
    assert {r.type: r["count"] for r in evaluate.confusion_table(scored).collect()} == {
        "True Negative": c.tn,
        "False Positive": c.fp,
        "False Negative": c.fn,
        "True Positive": c.tp,
    }
    whole = evaluate.evaluate(scored).first()
    rates = evaluate.classification_rates(scored).first()
    assert (whole.tp, whole.fp, whole.fn, whole.tn) == tuple(c)
    assert (whole.precision, whole.recall, whole.f1, whole.accuracy) == tuple(rates)
    assert rates.precision == c.tp / (c.tp + c.fp) and rates.accuracy == (c.tp + c.tn) / 2000


def test_no_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert tuple(evaluate.classification_rates(none).first()) == (0.0, 0.0, 0.0, None)
    whole = evaluate.evaluate(none).first()
    assert (whole.auc, whole.pr_auc, whole.precision, whole.accuracy, whole.tp) == (None, None, 0.0, None, 0)
    assert evaluate.roc_curve(none).count() == 1
    assert [tuple(r) for r in evaluate.confusion_matrix(none).collect()] == [(0, 0, 0), (1, 0, 0)]


def test_one_class_has_no_area(spark):
    df = spark.createDataFrame([("a", 0, 0.0, 0.1), ("b", 0, 1.0, 0.9)], SCHEMA)
    whole = evaluate.evaluate(df).first()
    assert whole.auc is None and whole.pr_auc is None and whole.recall == 0.0


@pytest.mark.parametrize("bad", [None, float("nan")])
def test_rows_without_a_score_are_an_error(spark, bad):
    df = spark.createDataFrame([("a", 0, 0.0, 0.1), ("b", 1, 1.0, bad)], SCHEMA)
    with pytest.raises(ValueError, match="scores must be numbers"):
        evaluate.evaluate(df)


def test_distribution_shares(scored):
    rows = evaluate.prediction_distribution(scored).collect()
    assert sum(r.n for r in rows) == 2000 and {r.total for r in rows} == {2000}
    assert {r.positive for r in rows} == {next(r.n for r in rows if r.prediction == 1)}
    assert all(r.percent == round(100 * r.n / 2000, 1) for r in rows)


def test_sample_is_reproducible_and_close_to_its_share(scored):
    once = {r.transaction_id for r in evaluate.hash_sample(scored, 0.1).collect()}
    again = {r.transaction_id for r in evaluate.hash_sample(scored.repartition(7), 0.1).collect()}
    assert once == again and 150 < len(once) < 250


def test_sample_predictions(scored):
    df = scored.withColumn("probability", F.col("score"))
    got = evaluate.sample_predictions(df, ["score", "transaction_id"], n=5)
    assert got.columns == ["is_fraud", "prediction", "probability", "score", "transaction_id"]
    assert got.count() == 5
    assert evaluate.sample_predictions(df, ["score"], id_col=None, n=5).count() == 5


@pytest.mark.parametrize("bins", [2, 7, 400])
def test_areas_of_bins_are_within_their_bound(scored, bins):
    for rows in (scored, scored.withColumn("score", F.round("score", 1)), scored.withColumn("score", F.lit(0.5))):
        _, auc, pr = _brute(rows.collect())
        got = evaluate.evaluate(rows, bins=bins).first()
        assert abs(got.auc - auc) <= got.auc_within + 1e-12 and abs(got.pr_auc - pr) <= got.pr_auc_within + 1e-12
        exact = evaluate.evaluate(rows).first()
        assert (got.precision, got.recall, got.accuracy, got.tp, got.tn) == (exact.precision, exact.recall, exact.accuracy, exact.tp, exact.tn)
        assert evaluate.area_under_roc(rows, bins=bins).columns == ["auc", "auc_within"]
    few = evaluate.area_under_roc(scored, bins=100).first()
    assert few.auc_within < 0.01 and evaluate.area_under_pr(scored, bins=100).first().pr_auc_within < 0.1


def test_points_of_bins_lie_on_the_curve(scored):
    exact = {(r.threshold, r.tpr, r.fpr) for r in evaluate.roc_curve(scored).collect()}
    some = evaluate.roc_curve(scored, bins=20).collect()
    assert {tuple(r) for r in some} <= exact and 15 <= len(some) <= 25
    odd = scored.withColumn("score", F.when(F.col("score") < 0.2, float("-inf")).when(F.col("score") > 0.8, float("inf")).otherwise(F.col("score")))
    assert {tuple(r) for r in evaluate.roc_curve(odd, bins=9, origin=False).collect()} <= {tuple(r) for r in evaluate.roc_curve(odd, origin=False).collect()}
    with pytest.raises(ValueError, match="at least 2"):
        evaluate.roc_curve(scored, bins=1)


def test_bins_of_no_rows_and_of_one_class(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert tuple(evaluate.evaluate(none, bins=5).first())[:4] == (None, None, None, None)
    one = spark.createDataFrame([("a", 0, 0.0, 0.1), ("b", 0, 1.0, 0.9)], SCHEMA)
    assert evaluate.area_under_roc(one, bins=5).first().auc is None
    bad = spark.createDataFrame([("a", 0, 0.0, None), ("b", 0, 1.0, 0.9)], SCHEMA)
    with pytest.raises(ValueError, match="scores must be numbers"):
        evaluate.evaluate(bad, bins=5)
