"""Training on `pyspark.ml`: splits, class weights, feature stages, three classifiers, importances."""

from ledgerlens.modeling.dictionary import ranked_values, with_index
from ledgerlens.modeling.importance import feature_importance, source_importance
from ledgerlens.modeling.median import exact_medians
from ledgerlens.modeling.prepare import class_weights, feature_roles, feature_stages, hash_split
from ledgerlens.modeling.train import evaluate_model, score, train_model

__all__ = [
    "class_weights",
    "evaluate_model",
    "exact_medians",
    "feature_importance",
    "feature_roles",
    "feature_stages",
    "hash_split",
    "ranked_values",
    "score",
    "source_importance",
    "train_model",
    "with_index",
]
