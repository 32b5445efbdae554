"""Fill-in-middle transformation: texts cut at two unit ranks, found in an indexable skip list.

A unit is a run of ASCII letters or any other single code point. The lowest lane of the list has one node per
unit; every express lane above keeps the nodes that a coin of theirs lets through. Each node carries how many
units and how many code points lie between it and the next node of its lane. A search descends from the top
lane, adding up widths while they do not pass the rank that is sought, and so ends exactly at that rank and at
the code point where its unit begins.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.words import mix

# The marks before the parts, and shares in percent: texts that are transformed, and of them those that
# begin with the suffix.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
TRANSFORMED = 90
SUFFIX_FIRST = 20

# The top lane has at most about so many nodes, and one node in four goes up a lane (two bits of its coin).
TOP_NODES = 8
COIN_BITS = 2
LANES = 24
# Code points of the texts sent on in one Arrow batch.
BATCH_CHARACTERS = 4_000_000


def unit_widths(text: str) -> np.ndarray:
    """Code points of every unit of the text, in order."""
    if not text:
        return np.zeros(0, np.int64)
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    letter = (code | np.uint32(32)) - np.uint32(97) < 26
    begins = ~letter
    begins[1:] |= ~letter[:-1]
    begins[0] = True
    return np.diff(np.append(np.flatnonzero(begins), len(code)))


class SkipList:
    """Lanes from the lowest up: unit-widths and code-point-widths of the nodes, and each node's place one lane below."""

    def __init__(self, widths: np.ndarray) -> None:
        units, chars, coins = np.ones(len(widths), np.int64), widths, mix(np.arange(1, len(widths) + 1, dtype=np.uint64))
        self.lanes: list[tuple[np.ndarray, np.ndarray, np.ndarray | None]] = [(units, chars, None)]
        while len(units) > TOP_NODES and len(self.lanes) < LANES:
            goes_up = coins & np.uint64((1 << COIN_BITS) - 1) == 0
            goes_up[0] = True  # a search starts at the first node of a lane
            up = np.flatnonzero(goes_up)
            units, chars = np.add.reduceat(units, up), np.add.reduceat(chars, up)
            coins = coins[up] >> np.uint64(COIN_BITS)
            self.lanes.append((units, chars, up))

    def code_points_before(self, rank: int) -> int:
        """Code points before unit `rank`, 0 to the number of units."""
        at = passed = before = 0
        for units, chars, down in reversed(self.lanes):
            while at < len(units) and passed + units[at] <= rank:
                passed += int(units[at])
                before += int(chars[at])
                at += 1
            if at == len(units) or passed == rank:
                break
            at = at if down is None else int(down[at])
        return before


def draws(key: str) -> list[int]:
    """Four numbers of 32 bits that depend on the key alone."""
    digest = hashlib.sha256(key.encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def transformed(text: str, key: str) -> tuple[int, str, int | None, int | None, str]:
    """(units, form, code points of the prefix, of the middle, output) of one text; `key` decides cuts and form."""
    widths = unit_widths(text)
    n = len(widths)
    h1, h2, h3, h4 = draws(key)
    if not text or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= TRANSFORMED:
        return n, "plain", None, None, text
    units = SkipList(widths)
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = units.code_points_before(first), units.code_points_before(second)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < SUFFIX_FIRST:
        return n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ("doc_id",),
              seed: int = 1) -> DataFrame:
    """Kept columns, `n` (units), `form` (plain, psm or spm), `prefix_chars`, `middle_chars` and `output`, a row per row.

    Cuts and form follow from the seed and the id alone: rows that agree in id and text have equal results, on every
    layout. Null text counts as empty, a null id as an empty one. Empty texts, and those that hold one of the marks,
    stay plain. No shuffle; an empty table gives an empty one. A kept column named like an output is an error.
    """
    made = ("n", "form", "prefix_chars", "middle_chars", "output")
    if clash := set(keep) & set(made):
        raise ValueError(f"columns {sorted(clash)} are both kept and made")
    types = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            last = batch.num_columns - 1
            start, size, rows = 0, 0, []
            for i in range(batch.num_rows):
                key, text = batch.column(last - 1)[i].as_py(), batch.column(last)[i].as_py() or ""
                rows.append(transformed(text, f"{seed}:{key or ''}"))
                size += len(text)
                if size >= BATCH_CHARACTERS or i == batch.num_rows - 1:
                    kept = [batch.column(c).slice(start, len(rows)) for c in range(last - 1)]
                    new = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
                    yield pa.RecordBatch.from_arrays([*kept, *new], names=[*keep, *made])
                    start, size, rows = i + 1, 0, []

    source = docs.select(
        *[docs[c].alias(f"c{i}") for i, c in enumerate(keep)],
        docs[id_col].cast("string").alias("key"),
        docs[text_col].alias("text"),
    )
    kept_types = [f"`{c}` {f.dataType.simpleString()}" for c, f in zip(keep, source.schema.fields)]
    return source.mapInArrow(
        run, ", ".join([*kept_types, "n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"])
    )


def restored(output: str = "output", form: str = "form") -> Column:
    """The text before `transform`: its parts hold no mark, so the marks alone say where they end."""
    parts = F.split(F.col(output), f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    first, second, middle = (F.get(parts, F.lit(i)) for i in (1, 2, 3))
    return (
        F.when(F.col(form) == "psm", F.concat(first, middle, second))
        .when(F.col(form) == "spm", F.concat(second, middle, first))
        .otherwise(F.col(output))
    )
