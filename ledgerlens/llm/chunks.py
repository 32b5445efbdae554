"""Substring deduplication by content-defined chunks: equal chunks show where to look, bytes decide what is cut."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.words import mix, utf8
from ledgerlens.scratch import durable

# A byte ends a piece if no gear hash of REACH bytes before and after it is smaller (a cut every 25 bytes on average).
REACH = 12
# Pieces without such a byte are cut every so many bytes; so many pieces in a row are a chunk.
LONGEST, PIECES = 256, 3
# Repeats are cut out from this many bytes on; shorter repeats are ordinary language.
SHORTEST_CUT = 100
# Bytes around a run of repeated chunks that are compared with those around its first copy.
WINDOW = LONGEST
# Bytes that are hashed together, and those that a gear hash looks back on.
SLICE, GEAR_BYTES = 1 << 20, 32

_BYTES = mix(np.arange(1, 257, dtype=np.uint64))
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_GEAR = (mix(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)


def _gear(data: np.ndarray) -> np.ndarray:
    """Rolling gear hash of the GEAR_BYTES bytes up to each byte."""
    h = _GEAR[data]
    width = 1
    while width < GEAR_BYTES:
        rolled = h.copy()
        if len(h) > width:
            rolled[width:] += h[:-width] << np.uint32(width)
        h = rolled
        width *= 2
    return h


def cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Bounds of the pieces of the texts that follow one another in `data`, text i from offsets[i] to offsets[i + 1].

    A text is cut after bytes with the least gear hash near them, every LONGEST bytes in gaps, and at its ends.
    Of bytes that tie, as in periodic text, the first counts, then the next beyond the reach of the last that did.
    """
    n, margin = len(data), REACH + GEAR_BYTES - 1
    found = [np.zeros(0, np.int64)]
    for at in range(0, n, SLICE):
        lo, hi = max(0, at - margin), min(n, at + SLICE + REACH)
        h = _gear(data[lo:hi])
        least = np.ones(len(h), bool)
        for d in range(1, min(REACH + 1, len(h))):
            least[d:] &= h[d:] <= h[:-d]
            least[:-d] &= h[:-d] <= h[d:]
        here = np.flatnonzero(least) + lo
        here = here[(here >= at) & (here < at + SLICE)]
        text = np.searchsorted(offsets, here, side="right") - 1
        here = here[(here - offsets[text] >= margin) & (here < offsets[text + 1] - REACH)]
        found.append(here + 1)
    points = np.unique(np.concatenate([np.asarray(offsets, np.int64), _untied(np.concatenate(found))]))
    wide = np.flatnonzero(np.diff(points) > LONGEST)
    if len(wide):
        extra = [np.arange(points[i] + LONGEST, points[i + 1], LONGEST) for i in wide]
        points = np.unique(np.concatenate([points, *extra]))
    return points


def _untied(points: np.ndarray) -> np.ndarray:
    if len(points) < 2 or np.diff(points).min() > REACH:
        return points
    keep = np.ones(len(points), bool)
    tied = np.flatnonzero(np.diff(points) <= REACH) + 1
    last, before = 0, -1
    for i, p, q in zip(tied.tolist(), points[tied].tolist(), points[tied - 1].tolist()):
        if i != before + 1:
            last = q
        if p - last > REACH:
            last = p
        else:
            keep[i] = False
        before = i
    return points[keep]


def chunks(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, start in it, length and digest of the chunks of texts: from each cut to the PIECES-th after it.

    Chunks overlap, so that each cut starts one; they are as long as the content says. Texts with fewer pieces
    are one chunk; those under SHORTEST_CUT bytes have none.
    """
    offsets = np.asarray(offsets, np.int64)
    points = cuts(data, offsets)
    first = np.searchsorted(points, offsets)
    text = np.searchsorted(offsets, points, side="right") - 1
    text = np.minimum(text, len(offsets) - 2)
    at = np.arange(len(points))
    last = first[text + 1]
    whole = offsets[text + 1] - offsets[text] >= SHORTEST_CUT
    at = at[whole & ((at + PIECES <= last) | (at == first[text])) & (at < last)]
    text, starts, ends = text[at], points[at], points[np.minimum(at + PIECES, last[at])]
    digests = np.zeros(len(starts), np.uint64)
    for i in range(0, len(starts), SLICE // LONGEST):
        a, b = starts[i : i + SLICE // LONGEST], ends[i : i + SLICE // LONGEST]
        lo, hi = int(a[0]), int(b.max())
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTES[data[lo:hi]] * _powers(_BASE, hi - lo))])
        digests[i : i + len(a)] = mix((sums[b - lo] - sums[a - lo]) * _powers(_INVERSE, hi - lo)[a - lo] + (b - a).astype(np.uint64))
    return text, starts - offsets[text], ends - starts, digests


def _powers(base: int, n: int) -> np.ndarray:
    """base ** 0 ... base ** (n - 1), modulo 2 ** 64."""
    out = np.ones(n, np.uint64)
    width = 1
    while width < n:
        more = min(width, n - width)
        out[width : width + more] = out[:more] * np.uint64(pow(base, width, 1 << 64))
        width *= 2
    return out


def text_chunks(docs: DataFrame) -> DataFrame:
    """(doc, mark, start, length, digest) of every chunk of every whole text of `docs` (doc, mark, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            text, start, length, digest = chunks(data, offsets)
            at = pa.array(text.astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array(start.astype(np.int32)),
                 pa.array(length.astype(np.int32)), pa.array(digest.view(np.int64))],
                names=["doc", "mark", "start", "length", "digest"],
            )

    return docs.mapInArrow(run, "doc bigint, mark bigint, start int, length int, digest bigint")


EDGE = "doc bigint, mark bigint, run int, at int, side int, fdoc bigint, fmark bigint, fat int"


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Both edges of every run of later chunks that repeat one place in a row, and the edges of that place."""
    types = [pa.int64(), pa.int64(), *[pa.int32()] * 3, pa.int64(), pa.int64(), pa.int32()]
    names = [c.split()[0] for c in EDGE.split(", ")]
    for batch in batches:
        rows = []
        for doc, mark, found in zip(*(c.to_pylist() for c in batch.columns)):
            runs: list[list] = []
            # The last run of each shift against another document, and of each first copy (in periodic text).
            open_: dict[tuple, list] = {}
            for c in sorted(found, key=lambda c: (c["start"], c["first"])):
                a, b, end = c["start"], c["start"] + c["length"], c["first"] + c["length"]
                # A copy that overlaps its first one leaves that whole, and SHORTEST_CUT bytes of periodic text.
                if c["doc"] == doc and c["mark"] == mark:
                    a = max(a, end, c["first"] + SHORTEST_CUT)
                if a >= b:
                    continue
                shift = (c["doc"], c["mark"], "shift", c["start"] - c["first"])
                place = (c["doc"], c["mark"], "first", c["first"])
                right = (c["doc"], c["mark"], end)
                run = next((r for k in (shift, place) if (r := open_.get(k)) and a <= r[2]), None)
                if run is None:
                    left = (c["doc"], c["mark"], c["first"]) if a == c["start"] else (None, None, None)
                    run = [a, left, b, right]
                    runs.append(run)
                elif b > run[2]:
                    run[2:] = [b, right]
                open_[shift] = open_[place] = run
            for i, (a, left, b, right) in enumerate(runs):
                rows += [(doc, mark, i, a, 0, *left), (doc, mark, i, b, 1, *right)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Up to WINDOW bytes before (side 0) or after (side 1) the places asked for."""
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
    for batch in batches:
        rows = []
        for doc, mark, text, wants in zip(*batch.columns):
            data = text.as_buffer()
            for w in wants.as_py():
                at = w["fat"]
                part = data[max(0, at - WINDOW) : at] if w["side"] == 0 else data[at : min(len(data), at + WINDOW)]
                rows.append((doc.as_py(), mark.as_py(), at, w["side"], part.to_pybytes()))
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["fdoc", "fmark", "fat", "side", "near"]
            )


def _common(a: bytes, b: bytes) -> int:
    """Bytes that both begin with."""
    n = min(len(a), len(b))
    return next((i for i in range(n) if a[i] != b[i]), n)


def _spans(data: bytes, edges: list[dict]) -> list[tuple[int, int]]:
    """Runs of SHORTEST_CUT bytes or more, as far as the bytes around agree with those around the first copy.

    Runs that touch are one span; its ends are moved inwards to whole characters.
    """
    edges = sorted(edges, key=lambda e: (e["run"], e["side"]))
    out: list[list[int]] = []
    runs = []
    for left, right in zip(edges[::2], edges[1::2]):
        a, b = left["at"], right["at"]
        a -= _common(data[max(0, a - WINDOW) : a][::-1], (left["near"] or b"")[::-1])
        b += _common(data[b : b + WINDOW], right["near"] or b"")
        if b - a >= SHORTEST_CUT:
            runs.append((a, b))
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1][1] = max(b, out[-1][1])
        else:
            out.append([a, b])
    for span in out:
        while span[0] < len(data) and data[span[0]] & 0xC0 == 0x80:
            span[0] += 1
        while span[1] < len(data) and data[span[1]] & 0xC0 == 0x80:
            span[1] -= 1
    return [(a, b) for a, b in out if a < b]


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, cuts, removed = [], [], []
        last = batch.num_columns - 1
        for text, found in zip(batch.column(last - 1), batch.column(last)):
            data = text.as_buffer().to_pybytes() if found.is_valid else b""
            spans = _spans(data, found.as_py()) if found.is_valid else []
            cuts.append([{"start": a, "end": b} for a, b in spans])
            removed.append(sum(b - a for a, b in spans))
            if not spans:
                texts.append(text.as_py())
                continue
            at, left = 0, []
            for a, b in spans:
                left.append(data[at:a])
                at = b
            texts.append(b"".join([*left, data[at:]]).decode("utf-8", "replace"))
        kept = [batch.column(i) for i in range(last - 1)]
        spans_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        yield pa.RecordBatch.from_arrays(
            [*kept, pa.array(texts, pa.string()), pa.array(cuts, spans_type), pa.array(removed, pa.int64())],
            names=[*batch.schema.names[: last - 1], "text", "cut_spans", "cut_bytes"],
        )


def drop_repeated_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                             keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Kept columns, `text` without repeated passages, `cut_spans` (bytes of the old text) and `cut_bytes`.

    Of each chunk (see `chunks`) the first stays: that of the smallest id (null ids last), then the smallest
    position. Later chunks that repeat one place in a row, or one chunk again and again, are a run; it grows by the bytes around that agree with
    those around its first copy, up to WINDOW at each end, and is cut out if it has SHORTEST_CUT bytes or more.
    So what is cut occurs earlier (periodic text: in itself), byte by byte, and nothing shorter is. A repeat is found if a whole
    chunk lies in it and has its first copy there: cuts depend on 43 bytes before and 12 after them and are 25
    apart on average. Null and empty texts stay as they are. Rows that agree in id and text are one document:
    they are cut alike. Whole texts of SHORTEST_CUT bytes or more that occur earlier are cut to the empty text;
    the row stays.
    """
    clash = set(keep) & {"text", "cut_spans", "cut_bytes"}
    if clash:
        raise ValueError(f"columns {sorted(clash)} are both kept and made")
    mark, doc = F.xxhash64(docs[text_col]), F.coalesce(docs[id_col].cast("long"), F.lit((1 << 63) - 1))
    texts = docs.select(doc.alias("doc"), mark.alias("mark"), docs[text_col].alias("text"))
    found = durable(text_chunks(texts))
    place = F.struct("doc", "mark", "start")
    first = durable(
        found.groupBy("digest").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    )
    later = found.join(first, "digest").where(place != F.col("first"))
    covered = later.groupBy("doc", "mark").agg(F.collect_set(F.struct(
        "start", "length", F.col("first.doc").alias("doc"), F.col("first.mark").alias("mark"), F.col("first.start").alias("first")
    )).alias("found"))
    edges = durable(covered.mapInArrow(_edges, EDGE))
    place = ["fdoc", "fmark", "fat", "side"]
    wants = edges.where("fat is not null").select(place).distinct().groupBy("fdoc", "fmark").agg(
        F.collect_list(F.struct("fat", "side")).alias("wants")
    )
    asked = texts.join(wants, (F.col("doc") == F.col("fdoc")) & (F.col("mark") == F.col("fmark")))
    near = asked.select("doc", "mark", "text", "wants").mapInArrow(
        _near, "fdoc bigint, fmark bigint, fat int, side int, near binary"
    )
    near = durable(near.groupBy(place).agg(F.min("near").alias("near")))
    found = edges.join(near, place, "left").groupBy("doc", "mark").agg(
        F.collect_list(F.struct("run", "at", "side", "near")).alias("__found")
    )
    rows = docs.select(
        *[docs[c].alias(f"__{i}") for i, c in enumerate(keep)], doc.alias("__doc"), mark.alias("__mark"),
        docs[text_col].alias("__text"),
    )
    joined = rows.join(found, (rows["__doc"] == found["doc"]) & (rows["__mark"] == found["mark"]), "left").select(
        *[F.col(f"__{i}") for i in range(len(keep))], "__text", "__found"
    )
    types = [f"`{c}` {f.dataType.simpleString()}" for c, f in zip(keep, joined.schema.fields)]
    names = [*keep, "text", "cut_spans", "cut_bytes"]
    return joined.mapInArrow(
        lambda batches: (b.rename_columns(names) for b in _cut(batches)), ", ".join([*types, "text string", "cut_spans array<struct<start: int, end: int>>", "cut_bytes bigint"])
    )
