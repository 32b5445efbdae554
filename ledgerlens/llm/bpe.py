"""Byte-level BPE encoding and decoding inside Spark tasks.

Many texts are encoded together: they are cut into special tokens and pieces that no word crosses, the words
of the vocabulary's pattern are found from the classes of neighbouring characters, and the distinct short words
of a slice are merged side by side, one merge in every word per step, in arrays without a Python object per word.
Longer words (one word can be a whole text) take the same merges from a heap.

One text alone is cut at single spaces into pieces that are words of the pattern; each distinct piece is merged
once and then looked up. A short word is a contiguous array of part boundaries with the rank of every adjacent
pair beside it: the smallest rank is found by scanning, its boundary deleted and the two neighbouring ranks
refreshed.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame

# Fixed value: the pattern that byte-level vocabularies of this family split text with.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

SHORT_WORD = 64
# Bytes that remembered words and their ids may take in a worker, and what one takes besides its characters and ids.
CACHED_BYTES = 32_000_000
CACHED_WORD_BYTES = 300
CACHED_WORD_LENGTH = 40
NO_RANK = 1 << 60
# Characters whose words are found together, and the cells and widths of the arrays that words are merged in.
SLICE_CHARACTERS = 1 << 20
MERGED_CELLS = 1 << 19
WIDTHS = (2, 4, 6, 8, 10, 12, 16, 24, 32, 48, SHORT_WORD)
POSITION_BITS = 6  # of a position in a short word, below its rank
LETTER, NUMBER, SPACE, OTHER = range(4)


def _byte_symbols() -> dict[int, str]:
    """The printable character that vocabulary files of this family write for each byte."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    shifted = iter(range(0x100, 0x200))
    return {b: chr(b) if b in plain else chr(next(shifted)) for b in range(256)}


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """The class of each code point in the pattern."""
    classes = np.full(0x110000, OTHER, np.uint8)
    characters = np.arange(0x110000, dtype="<u4").tobytes().decode("utf-32-le", "surrogatepass")
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for found in regex.finditer(pattern, characters):
            classes[found.start() : found.end()] = kind
    return classes


def _word_starts(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Whether a word of the pattern begins at each code point; none goes on where `first` says that a piece begins.

    A plain space joins what follows, other space does not; of a run of space that something follows, the last
    character stands alone. An apostrophe that begins a word takes the letters of a contraction with it.
    """
    n = len(points)
    kind = _classes()[points]
    plain = points == 0x20
    changes = np.ones(n, bool)
    changes[1:] = kind[1:] != kind[:-1]
    joined = np.zeros(n, bool)
    joined[1:] = plain[:-1]
    space = kind == SPACE
    last = np.ones(n, bool)
    last[:-1] = ~space[1:] & ~first[1:]
    last[-1] = False
    starts = np.where(space, changes | last, changes & ~joined) | first
    quotes = np.flatnonzero((points == 0x27) & starts)
    if len(quotes):
        padded = np.concatenate([points, np.zeros(2, points.dtype)])
        inside = ~np.concatenate([first, np.ones(2, bool)])
        one, two = padded[quotes + 1], padded[quotes + 2]
        near = inside[quotes + 1]
        short = near & np.isin(one, [*map(ord, "stmd")])
        pair = np.any([(one == ord(a)) & (two == ord(b)) for a, b in ("re", "ve", "ll")], axis=0)
        long = near & inside[quotes + 2] & pair
        starts[quotes[short | long] + 1] = False
        ends = np.concatenate([quotes[short] + 2, quotes[long] + 3])
        starts[ends[ends < n]] = True
    return starts


class Vocabulary:
    """Ids and merge ranks of byte strings, with encoding and decoding of one text or of many together."""

    def __init__(self, content: str) -> None:
        spec = json.loads(content)
        model, splitter = spec["model"], spec["pre_tokenizer"]
        if (
            model["type"] != "BPE"
            or spec["normalizer"]
            or splitter["type"] != "ByteLevel"
            or splitter["add_prefix_space"]
            or not splitter["use_regex"]
        ):
            raise ValueError("only byte-level BPE files without normalizer and prefix space are read")
        of_symbol = {s: b for b, s in _byte_symbols().items()}
        self.id_of = {bytes(of_symbol[c] for c in s): i for s, i in model["vocab"].items()}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.rank = {bytes(of_symbol[c] for c in a + b): rank for rank, (a, b) in enumerate(pairs)}
        if len(self.rank) != len(pairs):
            raise ValueError("two merges make the same token")
        self.bytes_of = {i: s for s, i in self.id_of.items()}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.bytes_of |= {i: s.encode() for s, i in self.special.items()}
        longest_first = "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))
        self.special_at = regex.compile(f"({longest_first})") if self.special else None
        self.words = regex.compile(WORDS)
        self.odd_space = regex.compile(r" (?=\s|\Z)")
        self.space = regex.compile(r" (?=\S)")
        self.cache: dict[str, tuple[int, ...]] = {}
        self.after_space: dict[str, tuple[int, ...]] = {}
        self.cached_bytes = 0
        self._make_tables()

    def _make_tables(self) -> None:
        """The merges as sorted pairs of ids with rank and result, and what each id stands for as Arrow arrays."""
        self.id_step = max(self.bytes_of, default=0) + 2
        found = {}
        for token, rank in self.rank.items():
            for cut in range(1, len(token)):
                a, b = self.id_of.get(token[:cut]), self.id_of.get(token[cut:])
                if a is not None and b is not None:
                    found[(a + 1) * self.id_step + b + 1] = rank
        pairs = np.array(sorted(found), np.int64)
        self.pairs = np.append(pairs, np.iinfo(np.int64).max)
        self.pair_ranks = np.array([*map(found.get, pairs.tolist()), NO_RANK >> POSITION_BITS], np.int64)
        self.made = np.array([self.id_of[token] for token in self.rank], np.int32)
        self.byte_ids = np.array([self.id_of.get(bytes([b]), -1) for b in range(256)], np.int32)
        self.byte_ranks = self._ranks(np.repeat(self.byte_ids, 256), np.tile(self.byte_ids, 256))
        content = [self.bytes_of.get(i, b"") for i in range(self.id_step)]
        self.contents = pa.array(content, pa.large_binary())
        self.decimals = pa.array([f"{i}," for i in range(self.id_step)], pa.large_string())

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids; there is none with an id of -1."""
        wanted = (left.astype(np.int64) + 1) * self.id_step + right + 1
        at = np.searchsorted(self.pairs, wanted)
        return np.where(self.pairs[at] == wanted, self.pair_ranks[at], NO_RANK >> POSITION_BITS)

    def _merge_together(self, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of short words, one after the other, and their number in each word.

        A column is a word. Row i is the part that begins at byte i with the rank of it and the part after it;
        `after` and `before` point to the neighbours, the last row is what lies beyond both ends.
        """
        n, width = len(start), int(size.max())
        row = np.arange(width + 1)[:, None]
        inside = row < size
        letters = data[np.minimum(start + row, len(data) - 1)]
        ids = np.where(inside, self.byte_ids[letters], -1)
        if (ids[inside] < 0).any():
            raise KeyError("the vocabulary has no token for a byte of the text")
        none = (NO_RANK >> POSITION_BITS) << POSITION_BITS
        ranks = np.full((width + 1, n), none, np.int64)
        pair_ranks = self.byte_ranks[letters[:-1].astype(np.int32) * 256 + letters[1:]]
        ranks[:-1] = np.where(inside[1:], (pair_ranks << POSITION_BITS) + row[:-1], none)
        after = np.where(row + 1 < size, row + 1, width)
        before = np.where(row > 0, row - 1, width) + np.zeros(n, np.int64)
        flat, after, before = ids.reshape(-1), after.reshape(-1), before.reshape(-1)
        columns = np.arange(n)

        def ranked(left: np.ndarray, right: np.ndarray, at: np.ndarray) -> np.ndarray:
            return np.minimum((self._ranks(left, right) << POSITION_BITS) + at, none)

        while True:
            least = ranks.min(axis=0)
            open_ = np.flatnonzero(least < none)
            if not len(open_):
                break
            if 2 * len(open_) < ranks.shape[1]:
                ranks, columns, least = ranks.take(open_, axis=1), columns[open_], least[open_]
                open_ = np.arange(len(open_))
            word, step = columns[open_], ranks.shape[1]
            flat_ranks = ranks.reshape(-1)
            least = least[open_]
            i = least & ((1 << POSITION_BITS) - 1)
            j = after[i * n + word]
            k = after[j * n + word]
            made = self.made[least >> POSITION_BITS]
            flat[i * n + word] = made
            flat[j * n + word] = -1
            after[i * n + word] = k
            before[k * n + word] = i
            flat_ranks[j * step + open_] = none
            flat_ranks[i * step + open_] = ranked(made, flat[k * n + word], i)
            h = before[i * n + word]
            flat_ranks[h * step + open_] = ranked(flat[h * n + word], made, h)
        kept = ids.T >= 0
        return ids.T[kept], kept.sum(axis=1)

    def _distinct(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words and special tokens, one after the other, and where those of each begin and end."""
        _, offsets, content = words.buffers()
        offsets = np.frombuffer(offsets, np.int64)[words.offset : words.offset + len(words) + 1]
        data = np.frombuffer(content, np.uint8)
        sizes = np.diff(offsets)
        count = np.zeros(len(words), np.int64)
        special = np.flatnonzero(pc.is_in(words, pa.array([*map(str.encode, self.special)], pa.large_binary())))
        ordinary = np.ones(len(words), bool)
        ordinary[special] = False
        found = []
        for w in special:
            count[w] = 1
            found.append((np.array([w]), self.special[words[w].as_py().decode()]))
        for least, most in pairwise((0, *WIDTHS)):
            of_width = np.flatnonzero((sizes > least) & (sizes <= most) & ordinary)
            for at in range(0, len(of_width), MERGED_CELLS // most):
                chosen = of_width[at : at + MERGED_CELLS // most]
                ids, count[chosen] = self._merge_together(data, offsets[chosen], sizes[chosen])
                found.append((chosen, ids))
        for w in np.flatnonzero((sizes > SHORT_WORD) & ordinary):
            ids = self.merge_word(data[offsets[w] : offsets[w + 1]].tobytes())
            count[w] = len(ids)
            found.append((np.array([w]), ids))
        bounds = np.concatenate([[0], np.cumsum(count)])
        out = np.empty(bounds[-1], np.int32)
        for chosen, ids in found:
            out[_places(bounds[chosen], count[chosen])] = ids
        return out, bounds

    def _pieces(self, text: str) -> Iterator[str]:
        """The text in special tokens and pieces that no word crosses, of about SLICE_CHARACTERS at most."""
        for part in self.special_at.split(text) if self.special_at else [text]:
            at = 0
            while len(part) - at > SLICE_CHARACTERS and (cut := self.space.search(part, at + SLICE_CHARACTERS)):
                yield part[at : cut.start()]
                at = cut.start()
            yield part[at:]

    def _slice(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces looked at together, and their number in each piece."""
        whole = "".join(pieces)
        if not whole:
            return np.zeros(0, np.int32), np.zeros(len(pieces), np.int64)
        ends = np.cumsum([*map(len, pieces)])
        points = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
        first = np.zeros(len(points) + 1, bool)
        first[ends] = True
        first[0] = True
        starts = _word_starts(points, first[:-1])
        for end, piece in zip(ends.tolist(), pieces):
            if piece in self.special:
                starts[end - len(piece) + 1 : end] = False
        content = whole.encode("utf-8", "surrogatepass")
        data = np.frombuffer(content, np.uint8)
        begins = np.flatnonzero(starts)
        at_byte = begins if len(data) == len(points) else np.flatnonzero((data & 0xC0) != 0x80)[begins]
        offsets = np.append(at_byte, len(data)).astype(np.int64)
        words = pa.Array.from_buffers(
            pa.large_binary(), len(begins), [None, pa.py_buffer(offsets), pa.py_buffer(content)]
        ).dictionary_encode()
        ids, bounds = self._distinct(words.dictionary)
        codes = words.indices.to_numpy()
        sizes = np.diff(bounds)[codes]
        total = np.concatenate([[0], np.cumsum(sizes)])
        tokens = total[np.searchsorted(begins, np.concatenate([[0], ends]))]
        return ids[_places(bounds[codes], sizes)], np.diff(tokens)

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and where those of each text begin and end."""
        count = np.zeros(len(texts), np.int64)
        found, pieces, owners, size = [np.zeros(0, np.int32)], [], [], 0

        def look() -> None:
            ids, sizes = self._slice(pieces)
            found.append(ids)
            np.add.at(count, owners, sizes)

        for i, text in enumerate(texts):
            for piece in self._pieces(text):
                if pieces and size + len(piece) > SLICE_CHARACTERS:
                    look()
                    pieces, owners, size = [], [], 0
                pieces.append(piece)
                owners.append(i)
                size += len(piece)
        if pieces:
            look()
        return np.concatenate(found), np.concatenate([[0], np.cumsum(count)])

    def merge_word(self, word: bytes) -> list[int]:
        bounds = self._scan(word) if len(word) <= SHORT_WORD else self._heap(word)
        return [self.id_of[word[a:b]] for a, b in pairwise(bounds)]

    def _scan(self, word: bytes) -> list[int]:
        """Part i lies between bounds[i] and bounds[i + 1]; ranks[i] is that of parts i and i + 1 together."""
        rank_of = self.rank.get
        bounds = [*range(len(word) + 1)]
        ranks = [rank_of(word[i : i + 2], NO_RANK) for i in range(len(word) - 1)]
        while ranks and (least := min(ranks)) < NO_RANK:
            i = ranks.index(least)
            del bounds[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = rank_of(word[bounds[i] : bounds[i + 2]], NO_RANK)
            if i:
                ranks[i - 1] = rank_of(word[bounds[i - 1] : bounds[i + 1]], NO_RANK)
        return bounds

    def _heap(self, word: bytes) -> list[int]:
        """The same bounds; end[i] is where the part that begins at i ends, begin[i] where the one before begins."""
        n = len(word)
        end, begin = [*range(1, n + 1)], [*range(-1, n - 1)]
        heap: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            j = end[i]
            if j < n and (rank := self.rank.get(word[i : end[j]])) is not None:
                heapq.heappush(heap, (rank, i, j, end[j]))

        for i in range(n):
            offer(i)
        while heap:
            _, i, j, k = heapq.heappop(heap)
            if end[i] != j or end[j] != k:
                continue
            end[i], end[j] = k, -1
            if k < n:
                begin[k] = i
            offer(i)
            if begin[i] >= 0:
                offer(begin[i])
        bounds = [0]
        while bounds[-1] < n:
            bounds.append(end[bounds[-1]])
        return bounds

    def forget(self) -> None:
        """Give up all remembered words."""
        self.cache.clear()
        self.after_space.clear()
        self.cached_bytes = 0

    def _keep(self, cache: dict[str, tuple[int, ...]], word: str, ids: tuple[int, ...]) -> None:
        if len(word) <= CACHED_WORD_LENGTH:
            self.cached_bytes += CACHED_WORD_BYTES + 4 * len(word) + 8 * len(ids)
            if self.cached_bytes > CACHED_BYTES:
                self.forget()
            cache[word] = ids

    def _piece(self, piece: str) -> tuple[int, ...]:
        """Ids of a piece of text that the pattern would not join to its neighbours."""
        out: list[int] = []
        for word in self.words.findall(piece):
            ids = self.cache.get(word)
            if ids is None:
                ids = tuple(self.merge_word(word.encode("utf-8", "surrogatepass")))
                self._keep(self.cache, word, ids)
            out += ids
        return tuple(out)

    def _ordinary(self, text: str) -> list[tuple[int, ...]]:
        """The pattern always parts words before a space that a non-space follows, so pieces start there."""
        pieces = self.space.split(text) if self.odd_space.search(text) else text.split(" ")
        found = [*map(self.after_space.get, pieces)]
        found[0] = self._piece(pieces[0])
        at = -1
        try:
            while True:
                at = found.index(None, at + 1)
                found[at] = ids = self._piece(" " + pieces[at])
                self._keep(self.after_space, pieces[at], ids)
        except ValueError:
            return found

    def encode(self, text: str) -> list[int]:
        if not (self.special_at and self.special_at.search(text)):
            return [*chain.from_iterable(self._ordinary(text))] if text else []
        out: list[int] = []
        for part in self.special_at.split(text):
            if part in self.special:
                out.append(self.special[part])
            elif part:
                out += chain.from_iterable(self._ordinary(part))
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of `ids`, special tokens included; byte sequences that are no text become U+FFFD."""
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")

    def _joined(self, contents: pa.Array, ids: np.ndarray, bounds: np.ndarray) -> Iterator[memoryview]:
        """For each text, what `contents` has for its ids, one after the other."""
        taken = contents.take(pa.array(ids))
        _, offsets, data = taken.buffers()
        at = np.frombuffer(offsets, np.int64)[taken.offset + bounds].tolist()
        data = memoryview(data or b"")
        return (data[a:b] for a, b in pairwise(at))

    def decode_all(self, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
        """The texts of `ids`, as `decode` gives them."""
        return [str(content, "utf-8", "replace") for content in self._joined(self.contents, ids, bounds)]

    def digests(self, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
        """SHA-256 of each text's decimal ids joined by commas."""
        return [hashlib.sha256(joined[:-1]).hexdigest() for joined in self._joined(self.decimals, ids, bounds)]


def _places(low: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places low[0], low[0] + 1, ... of size[0], then those of low[1], and so on."""
    total = np.cumsum(size)
    return np.repeat(low - total + size, size) + np.arange(total[-1] if len(total) else 0)


@lru_cache(maxsize=2)
def _vocabulary(path: str) -> Vocabulary:
    with open(path, encoding="utf-8") as file:
        return Vocabulary(file.read())


def _shipped(df: DataFrame, path: str) -> str:
    """Send the vocabulary file to every executor; a worker finds it under its own name."""
    df.sparkSession.sparkContext.addFile(path)
    return path.rstrip("/").rpartition("/")[2]


OUTPUTS = {
    "token_ids": ("array<int>", pa.list_(pa.int32())),
    "n_tokens": ("bigint", pa.int64()),
    "ids_sha256": ("string", pa.string()),
    "decoded": ("string", pa.string()),
    "decoded_sha256": ("string", pa.string()),
    "round_trip": ("boolean", pa.bool_()),
}

# Texts sent on in one Arrow batch, in characters: ids and decoded text of more are not held together.
BATCH_CHARACTERS = 8_000_000


def _in_parts(texts: list[str]) -> Iterator[tuple[int, int]]:
    start = size = 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > BATCH_CHARACTERS:
            yield start, i
            start, size = i, 0
        size += len(text)
    if texts:
        yield start, len(texts)


def encode_documents(
    docs: DataFrame,
    vocabulary: str,
    text_col: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    outputs: tuple[str, ...] = ("token_ids", "n_tokens", "decoded"),
) -> DataFrame:
    """Encode every whole text and decode it again; one row per row of `docs`, no shuffle.

    `vocabulary` is a tokenizer file that the driver can open. Kept columns come first; `outputs` chooses
    among `token_ids`, `n_tokens`, `ids_sha256` (of the decimal ids joined by commas), `decoded`,
    `decoded_sha256` and `round_trip` (the decoded text is the text), so digests can be had without moving ids out of the tasks. Null and empty texts have
    no tokens and decode to the empty text. Repeated rows stay repeated, an empty table gives an empty one.
    Kept columns may be null; one named like an output is an error.
    """
    clash = set(keep) & set(outputs)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are both kept and made")
    source = docs.select(*[docs[c].alias(f"c{i}") for i, c in enumerate(keep)], docs[text_col].alias("text"))
    file = _shipped(docs, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = _vocabulary(SparkFiles.get(file))
        try:
            yield from encoded(v, batches)
        finally:  # the worker goes on to other work
            pa.default_memory_pool().release_unused()

    def encoded(v: Vocabulary, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = [t or "" for t in batch.column(batch.num_columns - 1).to_pylist()]
            for a, b in _in_parts(whole):
                texts = whole[a:b]
                ids, bounds = v.encode_all(texts)
                decoded = v.decode_all(ids, bounds) if {"decoded", "decoded_sha256", "round_trip"} & set(outputs) else []
                new = []
                for name in outputs:
                    if name == "token_ids":
                        new.append(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids)))
                        continue
                    if name == "n_tokens":
                        made = np.diff(bounds)
                    elif name == "ids_sha256":
                        made = v.digests(ids, bounds)
                    elif name == "round_trip":
                        made = [*map(str.__eq__, decoded, texts)]
                    elif name == "decoded":
                        made = decoded
                    else:
                        made = [hashlib.sha256(text.encode()).hexdigest() for text in decoded]
                    new.append(pa.array(made, OUTPUTS[name][1]))
                kept = [batch.column(i).slice(a, b - a) for i in range(batch.num_columns - 1)]
                yield pa.RecordBatch.from_arrays(kept + new, names=[*keep, *outputs])

    kept_types = [f"`{c}` {f.dataType.simpleString()}" for c, f in zip(keep, source.schema.fields)]
    return source.mapInArrow(run, ", ".join([*kept_types, *(f"{n} {OUTPUTS[n][0]}" for n in outputs)]))
