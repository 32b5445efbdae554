"""Quartile bucket digests of texts, and a comparison of each text with an edited copy and with its neighbour."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS = 1024
# One step for each doubling of length by an eighth, and the most that length may add to a difference.
LENGTH_STEPS, LENGTH_BOUND = 8, 64
ROWS_PER_PART = 20_000


def digest(data: bytes) -> np.ndarray:
    """Length code and quartile (0-3) of each bucket of hashed byte triplets; equal bytes, equal digests."""
    size = len(data)
    x = np.frombuffer(data.ljust(3, b"\0") if data else data, np.uint8).astype(np.uint32)
    counts = np.zeros(BUCKETS, np.int64)
    if size:
        h = x[:-2] * np.uint32(0x9E3779B1) + x[1:-1] * np.uint32(0x85EBCA77) + x[2:] * np.uint32(0xC2B2AE3D)
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        counts = np.bincount(h >> np.uint32(32 - 10), minlength=BUCKETS)
    q = [BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]
    bounds = np.partition(counts, q)[q]
    out = np.empty(BUCKETS + 1, np.uint8)
    out[0] = min(255, round(LENGTH_STEPS * np.log2(size + 1)))
    out[1:] = sum((counts > b).view(np.uint8) for b in bounds)
    return out


def written(d: np.ndarray) -> str:
    """Length code and the quartiles, four to a byte, in hex."""
    q = d[1:].reshape(-1, 4)
    return (bytes([d[0]]) + (q[:, 0] << 6 | q[:, 1] << 4 | q[:, 2] << 2 | q[:, 3]).astype(np.uint8).tobytes()).hex()


def difference(a: np.ndarray, b: np.ndarray) -> int:
    """Sum of the quartile distances plus that of the length codes, from 0 to 3 * BUCKETS + LENGTH_BOUND."""
    d = np.abs(a.astype(np.int16) - b)
    return int(d[1:].sum()) + min(LENGTH_BOUND, int(d[0]))


def by_chance(a: np.ndarray, b: np.ndarray) -> float:
    """The quartile distances to expect of independent texts with as many buckets in each quartile as these two.

    1.25 for each bucket of long texts; little for short ones, whose buckets are nearly all empty.
    """
    p, q = (np.bincount(d[1:], minlength=4) / BUCKETS for d in (a, b))
    return BUCKETS * float(p @ np.abs(np.subtract.outer(range(4), range(4))) @ q)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """1 for equal digests, 0 from the difference on that independent texts of such occupancy have."""
    d = difference(a, b)
    return max(0.0, 1.0 - d / by_chance(a, b)) if d else 1.0


def edited(text: str, following: str) -> str:
    """`text` with its last third replaced by as many first code points of `following` (or all it has)."""
    k = len(text) // 3
    return text[: len(text) - k] + following[:k] if k else text


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows in parts by descending id, each part followed by the first row of the next (`tail` 1).

    The text is shuffled once. Bounds between parts are values of the id column, one for each part; each part
    is then sorted by id (nulls last) and text, so that repeated ids have a defined order.
    """
    rows = docs.select(docs[id_col].cast("long").alias("id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    ids = rows.select("id")
    n, largest = ids.agg(F.count(F.lit(1)), F.max("id")).first()
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), n // ROWS_PER_PART + 1)
    found = ids.agg(F.percentile_approx("id", [i / parts for i in range(1, parts)] or [0.5], 100 * parts)).first()[0]
    cuts = np.array(sorted({x for x in found or [] if x < largest}), np.int64)

    def part_of(v: np.ndarray) -> np.ndarray:
        return len(cuts) - np.searchsorted(cuts, v, side="left")

    @F.pandas_udf("int")
    def part(v: pd.Series) -> pd.Series:
        last = pd.Series(len(cuts), index=v.index, dtype="int32")
        return last.where(v.isna(), pd.Series(part_of(v.fillna(0).to_numpy(np.int64)), index=v.index).astype("int32"))

    heads = sorted(
        r.head for r in ids.withColumn("part", part("id")).groupBy("part").agg(F.max("id").alias("head")).collect()
        if r.head is not None
    )

    @F.pandas_udf("array<int>")
    def destinations(v: pd.Series) -> pd.Series:
        def of(x):
            if pd.isna(x):
                return [len(cuts), len(cuts)] if largest is None else [len(cuts)]
            own = int(part_of(np.int64(x)))
            return [own, (own - 1) if own else len(cuts)] if int(x) in at_head else [own]

        at_head = set(heads)
        return v.map(of, na_action=None)

    ids_exact = rows.withColumn("to", destinations("id"))
    return (
        ids_exact.select("id", "text", F.posexplode("to").alias("tail", "part"))
        .repartition(parts, "part")
        .sortWithinPartitions("part", "tail", F.desc_nulls_last("id"), "text")
    )


OUT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
    ]
)
OUT_TYPE = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per row that is no tail; only the row before the current one is held."""
    before = None
    out: list[tuple] = []
    for batch in batches:
        columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("part", "tail", "id", "text")]
        for part, tail, doc, text in zip(*columns):
            if tail and before is None:
                continue
            own = digest(text.encode("utf-8", "surrogatepass"))
            if before is not None:
                if before[0] != part:
                    raise AssertionError("a part without its tail")
                out.append(_row(*before[1:], text, own))
            before = None if tail else (part, doc, text, own)
        if out:
            yield _batch(out)
            out = []


def _row(doc: int | None, text: str, own: np.ndarray, following: str, other: np.ndarray) -> tuple:
    changed = edited(text, following)
    data = changed.encode("utf-8", "surrogatepass")
    new = digest(data)
    sha = hashlib.sha256(data).hexdigest()
    return doc, len(text), sha, written(own), written(new), likeness(own, new), likeness(own, other)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), OUT)], schema=OUT)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint of every whole text, of its edited text, and likeness to that and to the next document.

    The next document is the one that follows in descending order of id, for the last the first; equal ids
    are ordered by text, null ids come last. A null text counts as empty, which is like no other text;
    one of one or two bytes is filled up to a triplet. One row for each row of `docs`; an empty table gives an empty one, a single row is its
    own next.
    """
    return with_next(docs, id_col, text_col).mapInArrow(_compared, OUT_TYPE)
