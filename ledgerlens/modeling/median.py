"""Exact medians of any number of columns, found by narrowing brackets in a few passes, and the stage that fills gaps."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml import Estimator
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Quantiles taken of the values inside a bracket, the accuracy they are taken with, and the values (8 bytes each) inside
# a bracket that are looked at one by one.
GRID = 500
ACCURACY = 20_000
FEW = 10_000


@dataclass
class _Bracket:
    """The median is taken to lie from `low` to `high`; counts have shown that it lies between `least` and `most`."""

    low: float = -math.inf
    high: float = math.inf
    least: float = -math.inf
    most: float = math.inf
    found: float | None = None


def _usable(column: str) -> Column:
    value = F.col(f"`{column}`").cast("double")
    return F.when(~F.isnan(value), value + F.lit(0.0))


def exact_medians(df: DataFrame, columns: list[str], few: int = FEW, grid: int = GRID) -> dict[str, float | None]:
    """The value of rank ceil(n / 2) among the n numbers of each column, nulls and NaN aside; None without numbers.

    Each pass is one aggregate for all columns that are still open. It counts the values up to, inside and at the ends of
    a bracket and sketches the quantiles inside; the next bracket is around the wanted rank, hundreds of times as narrow.
    A bracket that turns out to miss it, as sketches are approximate, is moved by what was counted. Its ends are values
    of the one before and not inside, so that every pass leaves fewer. Once a bracket has at most `few` values, these
    are sorted. So 10**10 values take four passes or so, and no value is ever shuffled.
    """
    wanted, brackets = list(columns), {c: _Bracket() for c in columns}
    ranks = [F.lit(i / grid) for i in range(grid + 1)]
    while open_ := [c for c in columns if brackets[c].found is None]:
        cells = []
        for c in open_:
            value, b = _usable(c), brackets[c]
            inside = (value > F.lit(b.low)) & (value < F.lit(b.high))
            cells.append(
                F.struct(
                    F.count(value).alias("n"),
                    F.count_if(value <= F.lit(b.low)).alias("up_to_low"),
                    F.count_if(inside).alias("inside"),
                    F.count_if(value == F.lit(b.low)).alias("at_low"),
                    F.count_if(value == F.lit(b.high)).alias("at_high"),
                    F.percentile_approx(F.when(inside, value), F.array(*ranks), ACCURACY).alias("grid"),
                )
            )
        facts = df.agg(F.array(*cells).alias("cells")).first()["cells"]
        for c, f in zip(open_, facts, strict=True):
            if not f["n"]:
                del brackets[c]
            else:
                _narrow(df, c, brackets[c], f, few, grid)
        columns = [c for c in columns if c in brackets]
    return {c: brackets[c].found if c in brackets else None for c in wanted}


def _narrow(df: DataFrame, column: str, b: _Bracket, facts, few: int, grid: int) -> None:
    rank = (facts["n"] + 1) // 2
    up_to_low, inside = facts["up_to_low"], facts["inside"]
    place = rank - up_to_low  # among the values inside, from 1
    if rank <= up_to_low - facts["at_low"]:
        b.most, b.low, b.high = b.low, b.least, b.low
    elif place < 1:
        b.found = b.low
    elif place > inside + facts["at_high"]:
        b.least, b.low, b.high = b.high, b.high, b.most
    elif place > inside:
        b.found = b.high
    elif inside <= few:
        value = _usable(column)
        rows = df.where((value > F.lit(b.low)) & (value < F.lit(b.high))).select(value.alias("v")).collect()  # `few` at most
        b.found = sorted(r.v for r in rows)[place - 1]
    else:
        b.least, b.most = b.low, b.high
        at = place / inside * grid
        b.low, b.high = facts["grid"][max(0, math.floor(at) - 1)], facts["grid"][min(grid, math.ceil(at) + 1)]


class MedianFill(Estimator):
    """Stage that copies number columns, with the exact median of each in place of nulls and NaN.

    It fits to a plain SQL stage, so a fitted pipeline is saved and loaded as any other.
    """

    def __init__(self, columns: list[str], outputs: list[str]) -> None:
        super().__init__()
        self.columns, self.outputs = list(columns), list(outputs)

    def _fit(self, dataset: DataFrame) -> SQLTransformer:
        medians = exact_medians(dataset, self.columns)
        if empty := [c for c in self.columns if medians.get(c) is None]:
            raise ValueError(f"no values to fill gaps from in: {', '.join(empty)}")
        filled = [
            f"COALESCE(CASE WHEN ISNAN(CAST(`{c}` AS DOUBLE)) THEN NULL ELSE CAST(`{c}` AS DOUBLE) END, "
            f"CAST('{medians[c]!r}' AS DOUBLE)) AS `{out}`"
            for c, out in zip(self.columns, self.outputs, strict=True)
        ]
        return SQLTransformer(statement=f"SELECT *, {', '.join(filled)} FROM __THIS__")
