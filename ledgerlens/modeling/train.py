"""Fit, score and evaluate the three classifiers."""

from __future__ import annotations

from typing import Any

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.modeling.prepare import FEATURES, WEIGHT, balanced_weight, class_sizes, feature_stages
from ledgerlens.operators.evaluate import PREDICTION, evaluate, hash_sample
from ledgerlens.schema import ID, LABEL

# The model names on offer and their default settings.
MODELS: dict[str, tuple[type, dict[str, Any]]] = {
    "Logistic Regression": (
        LogisticRegression,
        {
            "family": "binomial",
            "maxIter": 50,
            "regParam": 0.01,
            "elasticNetParam": 0.5,
            "standardization": True,
        },
    ),
    "Decision Tree": (
        DecisionTreeClassifier,
        {"maxDepth": 5, "minInstancesPerNode": 5, "maxBins": 32},
    ),
    "Random Forest": (
        RandomForestClassifier,
        {"numTrees": 20, "maxDepth": 5, "subsamplingRate": 0.8, "seed": 42},
    ),
}


def _estimator(model: str, label: str, params: dict[str, Any] | None):
    if model not in MODELS:
        raise ValueError(f"unknown model {model!r}; choose one of {', '.join(MODELS)}")
    kind, defaults = MODELS[model]
    return kind(
        featuresCol=FEATURES,
        labelCol=label,
        weightCol=WEIGHT,
        predictionCol=PREDICTION,
        **{**defaults, **(params or {})},
    )


def _inspect(
    df: DataFrame, categorical: list[str], numeric: list[str], label: str, max_categories: int | None
) -> tuple[int, int]:
    """Rows of class 1 and of class 0, after refusing what the stages cannot take: a number column
    without values and, where the caller sets a bound, text with more different ones."""
    sizes = class_sizes(label)
    facts = df.agg(
        *sizes.values(),
        *[F.count(c) for c in numeric],
        *[F.count_distinct(c) for c in categorical if max_categories is not None],
    ).first()
    (ones, zeros), values = facts[:2], facts[2 : 2 + len(numeric)]
    empty = [c for c, n in zip(numeric, values, strict=True) if n == 0]
    if empty:
        raise ValueError(f"no values to fill gaps from in: {', '.join(empty)}")
    wide = [c for c, n in zip(categorical, facts[2 + len(numeric) :], strict=False) if n > max_categories]
    if wide:
        raise ValueError(f"more than {max_categories} different values in: {', '.join(wide)}")
    return ones, zeros


def train_model(
    df: DataFrame,
    model: str,
    categorical: list[str],
    numeric: list[str],
    label: str = LABEL,
    weighting: str = "balanced",
    params: dict[str, Any] | None = None,
    max_categories: int | None = None,
    encoding: str = "one_hot",
) -> PipelineModel:
    """Fit the feature stages and the named model as one Spark ML pipeline (runs jobs).

    `params` overrides the model's settings, `encoding` says how text becomes numbers (`feature_stages`;
    `"hashed"` for text with very many values). `max_categories` is an optional, exact bound on the
    values of a text column. Only the columns the model needs are kept in memory (or on
    disk where memory is short). One aggregate fills that copy, checks it and counts the classes; the
    stages and the iterations then read the copy.
    """
    if weighting not in ("balanced", "none"):
        raise ValueError(f"weighting must be 'balanced' or 'none', not {weighting!r}")
    estimator = _estimator(model, label, params)
    needed = df.select(*dict.fromkeys([*categorical, *numeric, label])).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        ones, zeros = _inspect(needed, categorical, numeric, label, max_categories)
        weight = balanced_weight(label, F.lit(ones), F.lit(zeros)) if weighting == "balanced" else F.lit(1.0)
        booleans = [c for c in numeric if isinstance(df.schema[c].dataType, T.BooleanType)]
        stages = [*feature_stages(categorical, numeric, booleans, encoding), estimator]
        return Pipeline(stages=stages).fit(needed.withColumn(WEIGHT, weight))
    finally:
        needed.unpersist()


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Append prediction, probability and raw prediction to every row."""
    return model.transform(df)


def evaluate_model(
    model: PipelineModel,
    test: DataFrame,
    label: str = LABEL,
    sample_fraction: float | None = None,
    id_col: str = ID,
) -> tuple[DataFrame, DataFrame]:
    """(one-row metrics, scored rows). The metrics score `test` once, reducing it to counts per score
    right away; the scored rows are lazy, so persist `test` if it is costly to compute twice.

    Ranking uses the raw prediction, which for a single tree is the weighted class count of the leaf.
    Every row counts unless `sample_fraction` asks for a reproducible share, chosen by `id_col`.
    """
    chosen = test if sample_fraction is None else hash_sample(test, sample_fraction, id_col)
    scored = score(model, chosen)
    narrow = scored.select(label, PREDICTION, vector_to_array("rawPrediction")[1].alias("score"))
    return evaluate(narrow, label=label), scored
