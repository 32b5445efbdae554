"""Vector code compression: vectors cut into parts, each part written as its nearest codebook entry.

All arithmetic is on whole numbers, so codes and codebooks are the same on every layout. The nearest entry is
found by equal-average search: entries are sorted by the sum of their components, and a search expands outward from the
sum of the part. A gap g between two sums of d components means a squared distance of g * g / d at least, so a
search ends once g * g / d strictly exceeds the best distance; equal distances are still looked at, for ties.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.scratch import durable

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096


@dataclass(frozen=True)
class Codebooks:
    """`entries[part, entry]` is a vector of whole numbers; at most parts x entries x part length of them."""

    entries: np.ndarray

    def sha256(self) -> str:
        """Of the decimal components by part, entry and position, joined by commas."""
        return hashlib.sha256(",".join(map(str, self.entries.reshape(-1).tolist())).encode()).hexdigest()


def largest(dim: int, parts: int = PARTS) -> int:
    """Components lie within this bound on either side, so that squared distances and errors fit in 64 bits."""
    return (1 << 29) // max(1, dim // parts, isqrt(max(dim, 1) - 1) + 1)


def nearest(vectors: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) of every row of `vectors`; ties go to the lower entry."""
    n, (k, d) = len(vectors), book.shape
    order = np.argsort(book.sum(axis=1), kind="stable")
    sums, own = book.sum(axis=1)[order], vectors.sum(axis=1)
    far = np.int64(1) << np.int64(31)  # beyond any gap; its square still fits
    padded = np.concatenate([[0], sums, [0]])
    chosen, best = np.full(n, k), np.full(n, (1 << 62) // max(d, 1))
    right = np.searchsorted(sums, own)
    left = right - 1
    open_ = np.arange(n)
    while len(open_):
        x, l, r = own[open_], left[open_], right[open_]
        below = np.where(l >= 0, x - padded[l + 1], far)
        above = np.where(r < k, padded[np.minimum(r, k) + 1] - x, far)
        gap = np.minimum(below, above)
        goes = (gap < far) & (gap * gap <= d * best[open_])
        open_, up = open_[goes], (above < below)[goes]
        entry = order[np.where(up, r[goes], l[goes])]
        distance = ((vectors[open_] - book[entry]) ** 2).sum(axis=1)
        better = (distance < best[open_]) | ((distance == best[open_]) & (entry < chosen[open_]))
        chosen[open_[better]], best[open_[better]] = entry[better], distance[better]
        right[open_[up]] += 1
        left[open_[~up]] -= 1
    return chosen, best


def whole_vectors(vectors: DataFrame, vec_col: str, keep: tuple[str, ...], scale: int = SCALE, parts: int = PARTS) -> DataFrame:
    """Kept columns and `whole`, the components as floor(scale * x); rows without a vector of finite numbers go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            owner = pc.list_parent_indices(column).to_numpy()
            x = pc.fill_null(pc.list_flatten(column).cast(pa.float64()), float("nan")).to_numpy(zero_copy_only=False)
            usable = column.is_valid().to_numpy(zero_copy_only=False)
            usable[owner[~np.isfinite(x)]] = False
            rows = np.flatnonzero(usable)
            sizes = np.bincount(owner, minlength=batch.num_rows)[rows].astype(np.int64)
            bound = np.array([largest(s, parts) for s in np.unique(sizes).tolist()], np.float64)
            mine = np.repeat(bound[np.searchsorted(np.unique(sizes), sizes)], sizes) if len(rows) else np.zeros(0)
            whole = np.clip(np.floor(x[usable[owner]] * scale), -mine, mine).astype(np.int32)
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(whole))
            kept = [batch.column(i).take(pa.array(rows)) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*kept, lists], names=[*keep, "whole"])

    source = vectors.select(*[vectors[c] for c in keep], vectors[vec_col].alias("__vector"))
    types = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1]]
    return source.mapInArrow(run, ", ".join([*types, "whole array<int>"]))


def _block(column: pa.Array, parts: int) -> np.ndarray:
    values = pc.list_flatten(column).to_numpy(zero_copy_only=False).astype(np.int64)
    return values.reshape(len(column), parts, -1)


def _moved(whole: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round: tasks send sums and counts per entry, never vectors."""
    parts, k, d = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, k, d + 1), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            block = _block(batch.column(0), parts)
            for p in range(parts):
                entry, _ = nearest(block[:, p], books[p])
                order = np.argsort(entry, kind="stable")
                used, begin = np.unique(entry[order], return_index=True)
                rows = np.concatenate([block[order, p], np.ones((len(order), 1), np.int64)], axis=1)
                total[p, used] += np.add.reduceat(rows, begin, axis=0)
        flat = total.reshape(-1)
        slots = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(slots.astype(np.int32)), pa.array(flat[slots])], names=["slot", "value"])

    sums = whole.select("whole").mapInArrow(run, "slot int, value bigint").groupBy("slot").agg(F.sum("value").alias("value"))
    total = np.zeros(parts * k * (d + 1), np.int64)
    for r in sums.collect():  # one number for every component of the codebooks, whatever the size of the data
        total[r.slot] = r.value
    total = total.reshape(parts, k, d + 1)
    count = total[:, :, d:]
    return np.where(count > 0, total[:, :, :d] // np.maximum(count, 1), books)


def fit(whole: DataFrame, id_col: str, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks:
    """Codebooks of the durable table `whole` (id, whole): they start as the parts of the first ids, nulls last."""
    least, most = whole.agg(F.min(F.size("whole")), F.max(F.size("whole"))).first()
    if least is None:
        return Codebooks(np.zeros((parts, 0, 0), np.int64))
    if least != most or least % parts:
        raise ValueError(f"vectors must have one length, a multiple of {parts}; found {least} to {most}")
    first = whole.orderBy(F.col(f"`{id_col}`").asc_nulls_last(), "whole").select("whole").limit(entries).collect()
    books = np.array([r.whole for r in first], np.int64).reshape(len(first), parts, -1).transpose(1, 0, 2).copy()
    for _ in range(rounds):
        books = _moved(whole, books)
    return Codebooks(books)


def encode(whole: DataFrame, books: Codebooks, keep: tuple[str, ...]) -> DataFrame:
    """Kept columns, `entries` (index of the nearest entry of each part) and `error` (squared distances, summed)."""
    held = books.entries
    parts = len(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            codes, error = np.zeros((n, parts), np.int32), np.zeros(n, np.int64)
            if n:
                block = _block(batch.column(batch.num_columns - 1), parts)
                for p in range(parts):
                    codes[:, p], distance = nearest(block[:, p], held[p])
                    error += distance
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, n * parts + 1, parts, dtype=np.int32)), pa.array(codes.reshape(-1)))
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*kept, lists, pa.array(error)], names=[*keep, "entries", "error"])

    source = whole.select(*[whole[c] for c in keep], "whole")
    types = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1]]
    return source.mapInArrow(run, ", ".join([*types, "entries array<int>, error bigint"]))


def decode(codes: DataFrame, books: Codebooks, scale: int = SCALE) -> DataFrame:
    """`codes` with `decoded`: the vector of doubles that its entries stand for."""
    table = [[[v / scale for v in entry] for entry in part] for part in books.entries.tolist()]
    parts = [
        F.array(*[F.array(*map(F.lit, entry)) for entry in part])[F.col("entries")[p]] for p, part in enumerate(table)
    ]
    return codes.withColumn("decoded", F.concat(*parts))


def compress(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, Codebooks]:
    """(codes, codebooks): `codes` has the id, the label, `entries`, `error` and `label_error`, a row per kept vector.

    Rows whose vector is null or holds null, NaN or infinite components are dropped. Kept vectors must have one
    length, a multiple of `parts`, else an error says so. Components beyond `largest` after scaling (16,384 before
    it for 64 dimensions) count as that bound. Ids may be null (last) or repeated (ordered by vector); with fewer
    than `entries` kept vectors there are as many entries. `label_error` sums over equal labels, nulls together,
    and is null beyond 64 bits. An empty table gives an empty one. Other columns are not looked at.
    """
    whole = durable(whole_vectors(vectors, vec_col, (id_col, label_col), scale, parts))
    books = fit(whole, id_col, parts, entries, rounds)
    codes = durable(encode(whole, books, (id_col, label_col)))
    label = codes[label_col]
    totals = durable(codes.groupBy(label.alias("__label")).agg(F.try_sum("error").alias("label_error")))
    joined = codes.join(totals, label.eqNullSafe(totals["__label"]), "left")
    return joined.select(*[codes[c] for c in codes.columns], "label_error"), books
