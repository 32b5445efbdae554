"""Feature importance of the tree models, under the names of the columns they came from."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.modeling.prepare import FEATURES, FILLED

_SCHEMA = "feature string, source string, importance double"


def _slots(model: PipelineModel, df: DataFrame) -> list[str]:
    """Name of each vector slot, read from the schema of the scored table (no job)."""
    kinds = model.transform(df).schema[FEATURES].metadata["ml_attr"]["attrs"]
    slots = sorted((slot for kind in kinds.values() for slot in kind), key=lambda slot: slot["idx"])
    return [slot["name"] for slot in slots]


def _source(slot: str) -> tuple[str, str]:
    """(shown name, source column) of a slot."""
    if slot.endswith(FILLED):
        column = slot.removesuffix(FILLED)
        return column, column
    return slot, slot.partition("_encoded_")[0]


def feature_importance(model: PipelineModel, df: DataFrame) -> DataFrame:
    """feature, source, importance per vector slot, largest first; `df` has the model's input columns.

    The table is as long as the feature vector, whatever the size of the data.
    """
    fitted = model.stages[-1]
    if not hasattr(fitted, "featureImportances"):
        raise ValueError(f"{type(fitted).__name__} has no feature importance")
    values = fitted.featureImportances.toArray()
    rows = [(*_source(slot), float(value)) for slot, value in zip(_slots(model, df), values, strict=True)]
    return df.sparkSession.createDataFrame(rows, _SCHEMA).orderBy(F.desc("importance"), "feature")


def source_importance(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Importance summed over the slots of each source column, largest first."""
    return (
        feature_importance(model, df)
        .groupBy(F.col("source").alias("feature"))
        .agg(F.sum("importance").alias("importance"))
        .orderBy(F.desc("importance"), "feature")
    )
