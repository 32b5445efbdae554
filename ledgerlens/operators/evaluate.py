"""Evaluation of any scored table: confusion, rates, ROC and precision-recall areas.

Inputs are a 0/1 label column, a 0/1 prediction column and a numeric score; they need not come from a
model. Counts and rates are lazy. Curves and areas need the scores in order: they first run a job that
reduces the table to one row per distinct score, and are lazy from there on. With `bins` they keep no scores at
all: a quantile sketch cuts them into bins of about equal size, rows are counted per bin, and areas come with
a proven bound on how far the exact ones are away.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions import hash_bucket
from ledgerlens.schema import ID, LABEL
from ledgerlens.scratch import durable

PREDICTION = "prediction"

# Steps in which a sampling fraction can be given.
FINE = 1_000_000


def hash_sample(df: DataFrame, fraction: float, id_col: str = ID, salt: str = "sample") -> DataFrame:
    """A reproducible share of the rows, chosen by id; evaluation uses every row unless asked for this."""
    return df.where(hash_bucket(F.col(id_col), FINE, salt) < round(fraction * FINE))


def _cell(prediction: str, predicted: int, label: str, actual: int) -> Column:
    return F.count_if((F.col(prediction) == predicted) & (F.col(label) == actual))


def _cells(label: str, prediction: str) -> dict[str, Column]:
    return {
        "tp": _cell(prediction, 1, label, 1),
        "fp": _cell(prediction, 1, label, 0),
        "fn": _cell(prediction, 0, label, 1),
        "tn": _cell(prediction, 0, label, 0),
    }


def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def _rates(tp: Column, fp: Column, fn: Column) -> dict[str, Column]:
    precision, recall = _ratio(tp, tp + fp), _ratio(tp, tp + fn)
    return {
        "precision": precision,
        "recall": recall,
        "f1": _ratio(2 * (precision * recall), precision + recall),
    }


def confusion(df: DataFrame, label: str = LABEL, prediction: str = PREDICTION) -> DataFrame:
    """One row: tp, fp, fn, tn."""
    return df.agg(*[cell.alias(name) for name, cell in _cells(label, prediction).items()])


def confusion_matrix(df: DataFrame, label: str = LABEL, prediction: str = PREDICTION) -> DataFrame:
    """Two rows (actual 0 and 1) by two columns (predicted 0 and 1), present even when empty."""
    c = _cells(label, prediction)
    rows = [
        F.struct(F.lit(actual).alias("actual"), no.alias("predicted_0"), yes.alias("predicted_1"))
        for actual, no, yes in ((0, c["tn"], c["fp"]), (1, c["fn"], c["tp"]))
    ]
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def confusion_table(df: DataFrame, label: str = LABEL, prediction: str = PREDICTION) -> DataFrame:
    """The same four counts in long form, named in words."""
    c = _cells(label, prediction)
    names = {"True Negative": "tn", "False Positive": "fp", "False Negative": "fn", "True Positive": "tp"}
    rows = [F.struct(F.lit(name).alias("type"), c[key].alias("count")) for name, key in names.items()]
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def classification_rates(df: DataFrame, label: str = LABEL, prediction: str = PREDICTION) -> DataFrame:
    """One row: precision, recall, F1 (0 where undefined) and accuracy (null without rows)."""
    counts = df.agg(
        *[cell.alias(name) for name, cell in _cells(label, prediction).items()],
        F.count_if(F.col(prediction) == F.col(label)).alias("hits"),
        F.count(F.lit(1)).alias("n"),
    )
    rates = _rates(F.col("tp"), F.col("fp"), F.col("fn"))
    return counts.select(
        *[value.alias(name) for name, value in rates.items()],
        F.try_divide("hits", "n").alias("accuracy"),
    )


def prediction_distribution(df: DataFrame, prediction: str = PREDICTION) -> DataFrame:
    """Rows per predicted class with their share, the total and the number of positive predictions."""
    groups = df.groupBy(prediction).agg(F.count(F.lit(1)).alias("n"))
    facts = groups.agg(
        F.struct(
            F.sum("n").alias("total"),
            F.coalesce(F.sum(F.when(F.col(prediction) == 1, F.col("n"))), F.lit(0)).alias("positive"),
        )
    ).scalar()
    return groups.select(
        prediction,
        "n",
        F.round(100 * F.col("n") / facts["total"], 1).alias("percent"),
        facts["total"].alias("total"),
        facts["positive"].alias("positive"),
    )


def sample_predictions(
    df: DataFrame, features: list[str], label: str = LABEL, id_col: str | None = ID, n: int = 100
) -> DataFrame:
    """Label, prediction, probability and the first three features of `n` scored rows.

    The rows with the first ids are the same on every run but every row gets scored to find them; with
    `id_col=None` Spark stops after any `n`.
    """
    ordered = df if id_col is None else df.orderBy(id_col)
    return ordered.limit(n).select(label, PREDICTION, "probability", *features[:3])


# Distinct scores that a single task puts in order, about; ranges of more than four times as many are cut again.
RANGE_SCORES = 500_000


def _ranged(groups: DataFrame, range_scores: int) -> DataFrame:
    """Distinct scores cut into ranges that a task can hold, range 0 the lowest.

    Spark chooses how many by their size. Bounds come from a sample, so the rows are written out with the range they
    fell in: once, and a second time only where a range turns out to be too large.
    """
    cut = lambda rows, *n: durable(
        rows.repartitionByRange(*n, "threshold").withColumn("range", F.spark_partition_id())
    )
    ranged = cut(groups)
    sizes = ranged.groupBy("range").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("threshold").isNull() | F.isnan("threshold")).alias("unusable")
    )
    n, most, unusable = sizes.agg(F.sum("n"), F.max("n"), F.sum("unusable")).first()
    if unusable:
        raise ValueError("scores must be numbers, without nulls")
    return cut(ranged.drop("range"), math.ceil(n / range_scores)) if n and most > 4 * range_scores else ranged


def _running(groups: DataFrame) -> DataFrame:
    """Running and overall totals without a global order: each range of scores sums on its own, starting
    from the totals of the ranges above it, which are a table with as many rows as there are ranges."""
    order = Window.orderBy(F.desc("range"))
    above = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    starts = (
        groups.groupBy("range")
        .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
        .select(
            "range",
            F.coalesce(F.sum("pos").over(above), F.lit(0)).alias("tp_above"),
            F.coalesce(F.sum("neg").over(above), F.lit(0)).alias("fp_above"),
            F.sum("pos").over(whole).alias("pos_all"),
            F.sum("neg").over(whole).alias("neg_all"),
        )
    )
    upto = (
        Window.partitionBy("range")
        .orderBy(F.desc("threshold"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        groups.withColumns({"tp_here": F.sum("pos").over(upto), "fp_here": F.sum("neg").over(upto)})
        .join(starts, "range")
        .withColumns(
            {"tp_at": F.col("tp_above") + F.col("tp_here"), "fp_at": F.col("fp_above") + F.col("fp_here")}
        )
    )


def _cumulated(
    df: DataFrame,
    label: str,
    score: str | Column,
    extra: dict[str, Column] | None = None,
    range_scores: int = RANGE_SCORES,
) -> DataFrame:
    """Distinct scores with `tp_at`, `fp_at` (label counts at this score or above) and class totals.

    The table is read once: its counts per distinct score, combined within tasks before the shuffle,
    are written out in ranges, and the later steps read only them.
    """
    value = (F.col(score) if isinstance(score, str) else score).cast("double")
    groups = df.groupBy(value.alias("threshold")).agg(*_counts(label, extra))
    return _running(_ranged(groups, range_scores))


def _counts(label: str, extra: dict[str, Column] | None) -> list[Column]:
    return [
        F.count_if(F.col(label) == 1).alias("pos"),
        F.count_if(F.col(label) == 0).alias("neg"),
        *[cell.alias(name) for name, cell in (extra or {}).items()],
    ]


def _binned(
    df: DataFrame, label: str, score: str | Column, bins: int, extra: dict[str, Column] | None = None
) -> DataFrame:
    """As `_cumulated`, with a row for each of about `bins` ranges of scores; `threshold` is the lowest score in it.

    The first pass keeps a sketch of the scores' quantiles, the second counts rows per bin, which combine within tasks.
    The counts are exact, so every row is a point of the exact curve; only the points between are left out.
    """
    if bins < 2:
        raise ValueError("bins must be at least 2")
    value = (F.col(score) if isinstance(score, str) else score).cast("double")
    scores = df.select(value.alias("threshold"))
    sketch = F.kll_sketch_agg_double("threshold", min(65_535, max(200, 8 * bins)))
    ranks = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    facts = scores.agg(
        sketch.alias("sketch"),
        F.count_if(F.col("threshold").isNull() | F.isnan("threshold")).alias("unusable"),
        F.count("threshold").alias("n"),
    )
    cuts = F.when(F.col("n") > F.col("unusable"), F.kll_sketch_get_quantile_double("sketch", ranks))
    found, unusable = facts.select(cuts, "unusable").first()
    if unusable:
        raise ValueError("scores must be numbers, without nulls")
    inner = sorted({x for x in found or [0.0] if math.isfinite(x)}) or [0.0]
    column = "__threshold"
    while column in df.columns:
        column += "_"
    bucket = Bucketizer(splits=[-math.inf, *inner, math.inf], inputCol=column, outputCol=f"{column}bin")
    rows = bucket.transform(df.withColumn(column, value))
    groups = rows.groupBy(F.col(f"{column}bin").alias("bin")).agg(F.min(column).alias("threshold"), *_counts(label, extra))
    return _running(durable(groups.drop("bin")).withColumn("range", F.lit(0)))


def _points(df: DataFrame, label: str, score, bins: int | None, extra: dict[str, Column] | None = None) -> DataFrame:
    return _cumulated(df, label, score, extra) if bins is None else _binned(df, label, score, bins, extra)


def roc_curve(
    df: DataFrame,
    label: str = LABEL,
    score: str | Column = "score",
    origin: bool = True,
    bins: int | None = None,
) -> DataFrame:
    """threshold, tpr, fpr per distinct score, plus the point (0, 0) at threshold infinity.

    All points are kept, also those on a straight stretch of the curve; `bins` keeps about so many of them, at scores
    that part the rows evenly. Null or NaN scores are an error.
    """
    points = _points(df, label, score, bins).select(
        "threshold",
        F.try_divide("tp_at", "pos_all").alias("tpr"),
        F.try_divide("fp_at", "neg_all").alias("fpr"),
    )
    if not origin:
        return points
    start = df.sparkSession.range(1).select(
        F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("tpr"), F.lit(0.0).alias("fpr")
    )
    return start.union(points)


def _areas() -> dict[str, Column]:
    """Aggregates over `_cumulated`: trapezoids under ROC and precision-recall, one per distinct score.

    The curve before a score is its cumulated count less its own, so no row needs its neighbour. The
    precision-recall curve starts at recall 0 with the first point's precision.
    """
    pos, neg, tp, fp = (F.col(c) for c in ("pos", "neg", "tp_at", "fp_at"))
    after = F.try_divide(tp, tp + fp)
    before = F.coalesce(F.try_divide(tp - pos, tp + fp - pos - neg), after)
    all_pos, all_neg = F.max("pos_all"), F.max("neg_all")
    return {
        "auc": F.try_divide(F.sum(neg * (tp - pos / 2)), all_pos.cast("double") * all_neg),
        "pr_auc": F.try_divide(F.sum(pos * (before + after) / 2), all_pos),
    }


def _bounds() -> dict[str, Column]:
    """Aggregates over `_binned`: how far the exact areas can be from those of the bins.

    Wherever the curve runs between the two ends of a bin, the area below changes by at most half of the bin's
    rectangle for ROC. For precision-recall the precision within a bin lies between those of its two outer corners.
    """
    pos, neg, tp, fp = (F.col(c) for c in ("pos", "neg", "tp_at", "fp_at"))
    lowest = F.coalesce(F.try_divide(tp - pos, tp - pos + fp), F.lit(1.0))
    highest = F.coalesce(F.try_divide(tp, tp + fp - neg), F.lit(0.0))
    all_pos, all_neg = F.max("pos_all"), F.max("neg_all")
    return {
        "auc_within": F.try_divide(F.sum(pos * neg / 2), all_pos.cast("double") * all_neg),
        "pr_auc_within": F.try_divide(F.sum(F.when(pos > 0, pos * F.abs(highest - lowest)).otherwise(0.0)), all_pos),
    }


def _area(df: DataFrame, name: str, label: str, score: str | Column, bins: int | None) -> DataFrame:
    wanted = {name: _areas()[name]} | ({} if bins is None else {f"{name}_within": _bounds()[f"{name}_within"]})
    return _points(df, label, score, bins).agg(*[value.alias(key) for key, value in wanted.items()])


def area_under_roc(
    df: DataFrame, label: str = LABEL, score: str | Column = "score", bins: int | None = None
) -> DataFrame:
    """One row: the exact area under the ROC curve; null when a class is absent.

    With `bins` the area from about so many points, and `auc_within`: the exact area is no further away.
    """
    return _area(df, "auc", label, score, bins)


def area_under_pr(
    df: DataFrame, label: str = LABEL, score: str | Column = "score", bins: int | None = None
) -> DataFrame:
    """One row: the exact area under the precision-recall curve; null without positives.

    With `bins` the area from about so many points, and `pr_auc_within`: the exact area is no further away.
    """
    return _area(df, "pr_auc", label, score, bins)


def evaluate(
    df: DataFrame,
    label: str = LABEL,
    score: str | Column = "score",
    prediction: str = PREDICTION,
    bins: int | None = None,
) -> DataFrame:
    """One row with both areas, precision, recall, F1, accuracy and the four counts.

    Everything follows from one grouping of the table by score, or with `bins` by about so many ranges of scores;
    rates and counts stay exact, and the areas get `auc_within` and `pr_auc_within`.
    """
    cells = _cells(label, prediction)
    extra = {
        **cells,
        "hits": F.count_if(F.col(prediction) == F.col(label)),
        "n": F.count(F.lit(1)),
    }
    areas = _areas() | ({} if bins is None else _bounds())
    summed = _points(df, label, score, bins, extra).agg(
        *[area.alias(name) for name, area in areas.items()],
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in extra],
    )
    return summed.select(
        *areas,
        *[value.alias(name) for name, value in _rates(F.col("tp"), F.col("fp"), F.col("fn")).items()],
        F.try_divide("hits", "n").alias("accuracy"),
        *cells,
    )
