"""Document quality by Bradley-Terry ranking: scores whose differences predict which of two documents is better."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import log

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.words import batches_of_words
from ledgerlens.scratch import durable

FEATURES = [
    "symbols", "symbol_ends", "bars", "distinct_words", "distinct_shingles", "repeated_next", "top_word",
    "log_words", "short", "word_bytes", "digits", "capitals", "stops", "line_words",
]

# Labelled rows of each class that preference pairs are made from, and pairs of each better document.
LABELLED_ROWS = 8_000
PAIRS = 4
# Score of a document at the threshold.
AT_THRESHOLD = 0.3

_PLAIN = b".,;:!?'-\"() "
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[b for b in range(0x21, 0x7F) if not chr(b).isalnum() and b not in _PLAIN]] = True


def _features(data: np.ndarray, start: np.ndarray, end: np.ndarray, words: np.ndarray, shingles: np.ndarray) -> list:
    n, k = max(1, len(data)), len(words)
    if not k:
        return [0.0] * len(FEATURES)
    last = data[end - 1]
    distinct, counts = np.unique(words, return_counts=True)
    seen = np.bincount(data, minlength=256)
    bar = (end - start == 1) & (last == 0x7C)
    return [
        seen[_SYMBOL].sum() / n,
        float(np.mean(_SYMBOL[last] & ~bar)),
        float(np.mean(bar)),
        len(distinct) / k,
        len(np.unique(shingles)) / len(shingles),
        float(np.mean(words[1:] == words[:-1])) if k > 1 else 0.0,
        (counts.max() - 1) / k,
        log(k),
        1 / k,
        min(40.0, float(np.mean(end - start))),
        seen[48:58].sum() / n,
        seen[65:91].sum() / n,
        min(1.0, seen[[46, 33, 63]].sum() / k),
        min(400.0, k / (1 + seen[10])),
    ]


def text_features(
    docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), out: str = "x"
) -> DataFrame:
    """Kept columns and one vector of doubles `out` per row from its whole text; null and blank texts have only zeros."""
    source = docs.select(*[docs[c].alias(f"c{i}") for i, c in enumerate(keep)], docs[text_col].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[list] = []
            for a, b, w, data, offsets in batches_of_words(batch.column(batch.num_columns - 1)):
                for i in range(b - a):
                    s = slice(w.bounds[i], w.bounds[i + 1])
                    text = data[offsets[i] : offsets[i + 1]]
                    rows.append(_features(text, w.start[s] - offsets[i], w.end[s] - offsets[i], w.value[s], w.shingles(i)))
            x = pa.FixedSizeListArray.from_arrays(pa.array(np.array(rows, np.float64).reshape(-1)), len(FEATURES))
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*kept, x.cast(pa.list_(pa.float64()))], names=[*keep, out])
        pa.default_memory_pool().release_unused()

    kept_types = [f"`{c}` {f.dataType.simpleString()}" for c, f in zip(keep, source.schema.fields)]
    return source.mapInArrow(run, ", ".join([*kept_types, f"{out} array<double>"]))


@dataclass(frozen=True)
class Ranker:
    """Weight, mean and deviation of each feature; the ranking at the threshold and the spread of rankings."""

    weights: tuple[float, ...]
    means: tuple[float, ...]
    deviations: tuple[float, ...]
    cut: float = 0.0
    spread: float = 1.0

    def ranking(self, x: Column) -> Column:
        total = F.lit(0.0)
        for i, (w, m, d) in enumerate(zip(self.weights, self.means, self.deviations)):
            z = (x[i] - F.lit(m)) / F.lit(d)
            total = total + F.lit(w) * F.greatest(F.lit(-6.0), F.least(F.lit(6.0), z))
        return total

    def score(self, x: Column) -> Column:
        """From 0 to 1 in the order of the rankings, AT_THRESHOLD at the cut."""
        shifted = (self.ranking(x) - F.lit(self.cut)) / F.lit(self.spread) + F.lit(log(AT_THRESHOLD / (1 - AT_THRESHOLD)))
        return 1 / (1 + F.exp(-shifted))


def _sample(labelled: DataFrame, good: int, bound: int) -> DataFrame:
    """At most `bound` rows of a class, those first by hash of the id, numbered from 0 (one bounded task)."""
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    few = labelled.where(F.col("good") == good).orderBy(*order).limit(bound)
    return few.select("x", (F.row_number().over(Window.orderBy(*order)) - 1).alias("i"))


def fit(labelled: DataFrame, bound: int = LABELLED_ROWS) -> Ranker:
    """Fit on rows (doc_id, x, good 0 or 1): pairs of a better and a worse document, logistic loss on differences.

    Pairs are made from at most `bound` rows of each class; means and deviations, and the cut, from all
    rows: as large a share of them lies below the cut as has good = 0. Without both classes every document
    ranks alike, at the score of 0.5.
    """
    labelled = durable(labelled.where("good in (0, 1) and doc_id is not null"))
    size = len(FEATURES)
    moments = [f(F.col("x")[i]) for f in (F.avg, F.stddev_pop) for i in range(size)]
    total, bad, *m = labelled.agg(F.count(F.lit(1)), F.count(F.when(F.col("good") == 0, 1)), *moments).first()
    if not bad or bad == total:
        spread = 1.0
        return Ranker((0.0,) * size, (0.0,) * size, (1.0,) * size, log(AT_THRESHOLD / (1 - AT_THRESHOLD)), spread)
    means, deviations = tuple(m[:size]), tuple(max(d, 1e-6) for d in m[size:])
    better, worse = durable(_sample(labelled, 1, bound)), durable(_sample(labelled, 0, bound))
    n = min(bad, bound)
    picks = better.select(
        F.col("x").alias("a"),
        F.explode(F.array(*[F.pmod(F.col("i") * (2 * j + 1) + j * 7919, F.lit(n)) for j in range(PAIRS)])).alias("i"),
        F.pmod(F.col("i"), F.lit(2)).alias("side"),
    )
    pairs = picks.join(worse.withColumnRenamed("x", "b"), "i")
    z = [
        F.greatest(F.lit(-6.0), F.least(F.lit(6.0), (F.col(c)[i] - F.lit(means[i])) / F.lit(deviations[i])))
        for c in ("a", "b")
        for i in range(size)
    ]
    sign = 2 * F.col("side") - 1
    rows = pairs.select(
        *[(sign * (z[i] - z[size + i])).alias(f"d{i}") for i in range(size)], F.col("side").cast("double").alias("label")
    )
    rows = VectorAssembler(inputCols=[f"d{i}" for i in range(size)], outputCol="features").transform(rows)
    model = LogisticRegression(fitIntercept=False, standardization=False, regParam=0.003, maxIter=60).fit(
        rows.select("features", "label")
    )
    ranker = Ranker(tuple(float(w) for w in model.coefficients), means, deviations)
    r = ranker.ranking(F.col("x"))
    cut, spread = labelled.agg(F.percentile_approx(r, bad / total, 10_000), F.stddev_pop(r)).first()
    return Ranker(ranker.weights, means, deviations, cut, max(spread, 1e-6))


def held_out(id_col: str = "doc_id") -> Column:
    """Ids whose labels are never learnt from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def fit_quality(x: DataFrame, labels: DataFrame, bound: int = LABELLED_ROWS) -> Ranker:
    """Fit on the features (doc_id, x) of labelled documents that are not held out."""
    return fit(x.join(labels.select("doc_id", F.col("quality").alias("good")).where(~held_out()), "doc_id"), bound)


def keep_good(docs: DataFrame, labels: DataFrame, bound: int = LABELLED_ROWS) -> DataFrame:
    """The rows of `docs` whose score is at the threshold or above, all columns; the text is not shuffled."""
    ranker = fit_quality(durable(text_features(docs.select("doc_id", "text"))), labels, bound)
    x = "__x"
    while x in docs.columns:
        x += "_"
    scored = text_features(docs, keep=tuple(docs.columns), out=x)
    return scored.where(ranker.score(F.col(x)) >= AT_THRESHOLD).select(*docs.columns)


def score_documents(docs: DataFrame, labels: DataFrame, bound: int = LABELLED_ROWS) -> DataFrame:
    """`doc_id`, `held_out`, `ranking`, `score` (0 to 1), `predicted` (1 from a score of 0.3), a row per document.

    Learns from the labels of ids that are not held out, through features of the text alone. Null and blank
    texts get the score of a vector of zeros; null ids are scored and count as held out; of several labels
    for one id each counts; labels other than 0 and 1 are passed over. Empty tables give an empty result.
    """
    x = durable(text_features(docs.select("doc_id", "text")))
    ranker = fit_quality(x, labels, bound)
    score = ranker.score(F.col("x"))
    return x.select(
        "doc_id",
        held_out().alias("held_out"),
        score.alias("score"),
        F.when(score >= AT_THRESHOLD, 1).otherwise(0).alias("predicted"),
        ranker.ranking(F.col("x")).alias("ranking"),
    )
