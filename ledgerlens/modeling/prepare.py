"""Everything between the feature table and the estimator."""

from __future__ import annotations

from pyspark.ml import Transformer
from pyspark.ml.base import Estimator
from pyspark.ml.feature import (
    FeatureHasher,
    Imputer,
    OneHotEncoder,
    SQLTransformer,
    StringIndexer,
    VectorAssembler,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.functions import hash_bucket
from ledgerlens.modeling.dictionary import JoinedIndex
from ledgerlens.modeling.median import MedianFill
from ledgerlens.schema import ID, LABEL

WEIGHT = "class_weight"
FEATURES = "features"
FILLED = "_filled"

# Slots that hashed text is spread over.
HASH_SLOTS = 4096


def hash_split(
    df: DataFrame, test_percent: int = 20, id_col: str = ID, salt: str = ""
) -> tuple[DataFrame, DataFrame]:
    """(train, test), decided by each row's id alone: no shuffle, and the same on every run and layout."""
    if not 0 < test_percent < 100:
        raise ValueError("test_percent must lie between 0 and 100")
    bucket = hash_bucket(F.col(id_col), 100, salt)
    return df.where(bucket >= test_percent), df.where(bucket < test_percent)


def feature_roles(df: DataFrame, features: list[str]) -> tuple[list[str], list[str]]:
    """(categorical, numeric) among the chosen features, yes or no being a number;
    any other type is refused by name."""
    roles: dict[str, list[str]] = {"categorical": [], "numeric": []}
    for name in features:
        dtype = df.schema[name].dataType
        if isinstance(dtype, T.StringType):
            roles["categorical"].append(name)
        elif isinstance(dtype, (T.NumericType, T.BooleanType)):
            roles["numeric"].append(name)
        else:
            raise ValueError(f"feature {name} has type {dtype.simpleString()}; use text or numbers")
    return roles["categorical"], roles["numeric"]


def class_sizes(label: str = LABEL) -> dict[str, Column]:
    """Aggregates: rows of either class."""
    return {"ones": F.count_if(F.col(label) == 1), "zeros": F.count_if(F.col(label) == 0)}


def balanced_weight(label: str, ones: Column, zeros: Column) -> Column:
    """The other class's share of the rows; 1 for every row when there is only one class."""
    share = F.when(F.col(label) == 1, zeros).otherwise(ones) / (ones + zeros)
    return F.when((ones > 0) & (zeros > 0), share).otherwise(F.lit(1.0))


def class_weights(
    df: DataFrame, label: str = LABEL, weighting: str = "balanced", weight: str = WEIGHT
) -> DataFrame:
    """Add a weight inverse to class frequency, or 1 everywhere with `weighting="none"`.

    The two class sizes are a scalar subquery over the label column, so this stays lazy and joins nothing.
    """
    if weighting == "none":
        return df.withColumn(weight, F.lit(1.0))
    if weighting != "balanced":
        raise ValueError(f"weighting must be 'balanced' or 'none', not {weighting!r}")
    sizes = df.agg(F.struct(*[size.alias(name) for name, size in class_sizes(label).items()])).scalar()
    return df.withColumn(weight, balanced_weight(label, sizes["ones"], sizes["zeros"]))


def feature_stages(
    categorical: list[str], numeric: list[str], booleans: list[str] | None = None, encoding: str = "one_hot",
    median_error: float | None = None,
) -> list[Estimator | Transformer]:
    """Encode text, fill numeric gaps with the median, assemble one vector.

    The multi-column estimators fit all columns together. Encoded text comes first in the vector,
    then numbers. `booleans` names those numeric columns that hold yes or no. Medians are exact, in a few passes
    (`exact_medians`); with `median_error` one pass gives a value whose rank is off by that share of the rows at most.

    `encoding="one_hot"` gives each value of a text column a slot, and unknown or missing text another;
    its dictionary passes through the driver. `"joined"` gives the same slots from a dictionary that is ranked and
    joined as a table, for text with very many values; such a model is not saved with its pipeline. `"hashed"` spreads
    all text over HASH_SLOTS shared slots without a dictionary; missing text is no value there.
    """
    if encoding not in ("one_hot", "joined", "hashed"):
        raise ValueError(f"encoding must be 'one_hot', 'joined' or 'hashed', not {encoding!r}")
    stages: list[Estimator | Transformer] = []
    encoded = [f"{c}_encoded" for c in categorical]
    filled = [f"{c}{FILLED}" for c in numeric]
    if categorical and encoding == "hashed":
        encoded = ["text_hashed"]
        stages.append(FeatureHasher(inputCols=categorical, outputCol=encoded[0], numFeatures=HASH_SLOTS))
    elif categorical:
        indexed = [f"{c}_index" for c in categorical]
        if encoding == "joined":
            stages.append(JoinedIndex(categorical, indexed))
        else:
            stages.append(StringIndexer(inputCols=categorical, outputCols=indexed, handleInvalid="keep"))
        stages.append(OneHotEncoder(inputCols=indexed, outputCols=encoded, handleInvalid="keep"))
    yes_no = set(booleans or ()) & set(numeric)
    if yes_no:
        casts = ", ".join(f"CAST(`{c}` AS DOUBLE) AS `{c}_number`" for c in numeric if c in yes_no)
        stages.append(SQLTransformer(statement=f"SELECT *, {casts} FROM __THIS__"))
    if numeric:
        inputs = [f"{c}_number" if c in yes_no else c for c in numeric]
        if median_error is None:
            stages.append(MedianFill(inputs, filled))
        else:
            stages.append(Imputer(inputCols=inputs, outputCols=filled, strategy="median", relativeError=median_error))
    stages.append(VectorAssembler(inputCols=encoded + filled, outputCol=FEATURES, handleInvalid="error"))
    return stages
