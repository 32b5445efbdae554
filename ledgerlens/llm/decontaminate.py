"""Benchmark decontamination: item-sized windows of every document against the items of a benchmark.

Windows and items have a 64-bit SimHash of their five-word shingles. Fingerprints are cut into RADIUS + 1
blocks; two that differ in at most RADIUS bits agree in a block, so the index of the blocks finds them all.
Candidates are verified by the exact similarity of their weighted shingles (weight: how often it occurs).
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.words import PUNCTUATION, SHINGLE_WORDS, Words, batches_of_words, shingle_values, utf8

BITS = 64
# At the least similarity fingerprints differ in 11 bits on average (deviation 3): this is over four deviations more.
RADIUS = 24
# The benchmark is taken in blocks of about so many bytes; each is one pass over the documents.
BLOCK_BYTES = 8 << 20
# Shingles whose bits are summed together.
REGION = 20_000

_BLOCK_ENDS = [BITS * (i + 1) // (RADIUS + 1) for i in range(RADIUS + 1)]


def _signs(shingles: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(shingles.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1)
    return bits.astype(np.int8) * 2 - 1


def _fingerprints(sums: np.ndarray) -> np.ndarray:
    return np.packbits(sums >= 0, axis=1).view(np.uint64).reshape(-1)


def _blocks(fingerprint: int) -> Iterator[tuple[int, int]]:
    at = 0
    for i, end in enumerate(_BLOCK_ENDS):
        yield i, (fingerprint >> at) & ((1 << (end - at)) - 1)
        at = end


def _counted(shingles: np.ndarray) -> dict[int, int]:
    values, counts = np.unique(shingles, return_counts=True)
    return dict(zip(values.tolist(), counts.tolist()))


def weighted_similarity(a: dict[int, int], b: dict[int, int]) -> float:
    """Sum of the smaller weights over the sum of the larger ones."""
    common = sum(min(n, b[s]) for s, n in a.items() if s in b)
    return common / (sum(a.values()) + sum(b.values()) - common)


class Items:
    """Items of a benchmark by shingle width and size, with the block index of their fingerprints."""

    def __init__(self, ids: list[int], texts: list[str]) -> None:
        self.ids = ids
        data, offsets = utf8(pc.utf8_lower(pa.array(texts, pa.string())))
        words = Words(data, offsets, PUNCTUATION)
        self.weights: list[dict[int, int]] = []
        self.prints: list[int] = []
        self.index: dict[tuple[int, int], dict[tuple[int, int], list[int]]] = defaultdict(lambda: defaultdict(list))
        known = defaultdict(list)
        for i in range(len(ids)):
            w = words.value[words.bounds[i] : words.bounds[i + 1]]
            s = shingle_values(w)
            self.weights.append(_counted(s))
            self.prints.append(int(_fingerprints(_signs(s).sum(axis=0, dtype=np.int64)[None])[0]) if len(s) else 0)
            if len(s):
                width = min(SHINGLE_WORDS, len(w))
                known[width].append(s)
                for block in _blocks(self.prints[i]):
                    self.index[width, len(s)][block].append(i)
        self.known = {width: np.unique(np.concatenate(s)) for width, s in known.items()}
        self.index = {key: dict(value) for key, value in self.index.items()}

    def matches(self, words: np.ndarray, least: float) -> Iterator[tuple[int, float, int, int]]:
        """(item, similarity, first word, words) of the best window for each item that a text holds."""
        best: dict[int, tuple[float, int, int]] = {}
        for width, known in self.known.items():
            if len(words) < width:
                continue
            s = shingle_values(words, width)
            at = np.minimum(np.searchsorted(known, s), len(known) - 1)
            total = np.concatenate([[0], np.cumsum(known[at] == s)])
            if not total[-1]:
                continue
            for (k, size), index in self.index.items():
                if k == width:
                    m = min(size, len(s))
                    # A window can only be similar if enough of its shingles are shingles of the benchmark.
                    enough = least * (m + size) / (1 + least)
                    starts = np.flatnonzero(total[m:] - total[:-m] >= enough - 1e-9)
                    self._verify(s, starts, m, width, index, least, best)
        for item, (similarity, start, n) in best.items():
            yield item, similarity, start, n

    def _verify(self, s, starts, m, width, index, least, best) -> None:
        for a in range(0, len(starts)):
            if a and starts[a] < until:
                continue
            first, until = starts[a], starts[a] + REGION
            group = starts[(starts >= first) & (starts < until)]
            region = s[first : group[-1] + m]
            sums = np.zeros((len(region) + 1, BITS), np.int32)
            np.cumsum(_signs(region), axis=0, dtype=np.int32, out=sums[1:])
            for start, print_ in zip(group, _fingerprints(sums[group - first + m] - sums[group - first]).tolist()):
                near = {
                    i for block in _blocks(print_) for i in index.get(block, ())
                    if (print_ ^ self.prints[i]).bit_count() <= RADIUS
                }
                for i in near:
                    found = weighted_similarity(_counted(s[start : start + m]), self.weights[i])
                    if found >= least and found > best.get(i, (0.0,))[0]:
                        best[i] = (found, int(start), m + width - 1)


def contaminated(docs: DataFrame, benchmark: DataFrame, least: float = 0.75, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, similarity, first_word, n_words) of each document and item it holds a copy of.

    Words are runs of letters and digits in lower case, so neither case nor punctuation hides a copy. Of each
    document and item the most similar window counts, of equal ones the first. An item of fewer than five
    words is one shingle and is only found whole. Null, empty and blank texts and items match nothing. Rows
    repeat as documents and items do; null ids stay null.
    """
    items = benchmark.select(
        F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = size // BLOCK_BYTES + 1
    placed = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    source = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    found = [_one_block(source, placed.where(F.col("block") == b), least) for b in range(blocks)]
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


def _one_block(source: DataFrame, items: DataFrame, least: float) -> DataFrame:
    rows = items.select("item_id", "text").collect()  # about BLOCK_BYTES
    shared = source.sparkSession.sparkContext.broadcast(Items([r.item_id for r in rows], [r.text for r in rows]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shared.value
        for batch in batches:
            rows: list[tuple] = []
            ids = batch.column(0)
            for a, b, words, _, _ in batches_of_words(pc.utf8_lower(batch.column(1)), PUNCTUATION):
                for i in range(b - a):
                    w = words.value[words.bounds[i] : words.bounds[i + 1]]
                    for item, similarity, start, n in items.matches(w, least):
                        rows.append((ids[a + i].as_py(), items.ids[item], similarity, start, n))
            types = (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
            columns = zip(*rows) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)],
                names=["doc_id", "item_id", "similarity", "first_word", "n_words"],
            )

    return source.mapInArrow(run, "doc_id bigint, item_id bigint, similarity double, first_word bigint, n_words bigint")
