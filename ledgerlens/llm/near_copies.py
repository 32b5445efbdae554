"""MinHash near duplicates by a multi-index Hamming join of b-bit signatures, confirmed on whole sets.

A text is the set of its distinct word shingles. Its signature is SYMBOLS symbols of 16 bits, the lowest bits of
as many min-hashes; the distance of two signatures is the number of symbols that differ. The signature is split
into CHUNKS chunks of CHUNK_SYMBOLS symbols. By pigeonhole, two signatures that differ in less than
CHUNKS * (ERRORS + 1) symbols have a chunk in which at most ERRORS differ. The allowed chunk errors are enumerated: for
every choice of ERRORS symbols of a chunk the other symbols are a key, so that every pair within
`guaranteed_distance()` shares a key. (Symbols rather than single bits, as unrelated bits agree half of the time: with
bits, the keys of a chunk that lets a similarity of 0.8 pass let a large share of unrelated pairs pass as well.)

Sets of a key are not paired with one another. In rounds, each is paired with one set of the key's largest component,
in the first round with the one whose keys are shared most, and pairs that full sets confirm are contracted.
When rounds find little more, the pairs of different components that share a key are confirmed, so no link is lost.
Shingles that few of the sets left have are rare. Two sets have at most as many shingles in common as they share rare ones
plus the smaller number of their other ones. So pairs are formed where rare shingles meet, a few per shingle, and
without any only among sets that the bound lets link even so. These are compared by parity bits: each shingle flips one
of PARITY_WORDS * 64 bits of its set, so two sets differ in as many shingles at least as in bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.graph import components
from ledgerlens.llm.words import batches_of_words, mix
from ledgerlens.scratch import durable

SHINGLE_WORDS = 4
PERCENT = 80

CHUNKS = 20
CHUNK_SYMBOLS = 6
ERRORS = 1
SYMBOLS = CHUNKS * CHUNK_SYMBOLS
SYMBOL = np.dtype("<u2")

# Pairs that a set is confirmed with in one round, those with most common keys.
PAIRS_PER_SET = 2
# Rounds end when there are so few open pairs for every row of a shared key, or so few links for every pair that is tried.
OPEN_PER_ROW = 2
LINKED_SHARE = 0.05
# Sets that a rare shingle has at most: pairs are formed among so many.
RARE_SETS = 10
# Words of 64 parity bits that a set has.
PARITY_WORDS = 8
# Keys (8 bytes each) and sets that are broadcast at most; beyond, both sides are shuffled.
BROADCAST_ROWS = 1_000_000


def guaranteed_distance() -> int:
    """All pairs of signatures that differ in at most so many symbols share a key."""
    return CHUNKS * (ERRORS + 1) - 1


_SEEDS = mix(np.arange(1, SYMBOLS + 1, dtype=np.uint64))
_FACTORS = mix(np.arange(1 << 20, (1 << 20) + SYMBOLS, dtype=np.uint64)) | np.uint64(1)
# The symbols of a chunk that are left for each choice of differing ones.
_LEFT = np.array([[i for i in range(CHUNK_SYMBOLS) if i not in e] for e in combinations(range(CHUNK_SYMBOLS), ERRORS)])
KEYS = CHUNKS * len(_LEFT)


def signatures(shingles: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Symbols of the sets shingles[begin[i]:begin[i + 1]], none of them empty."""
    out = np.empty((len(begin), SYMBOLS), SYMBOL)
    for k in range(SYMBOLS):
        h = (shingles ^ _SEEDS[k]) * _FACTORS[k]
        h ^= h >> np.uint64(32)
        h *= _FACTORS[k]
        out[:, k] = np.minimum.reduceat(h, begin).astype(SYMBOL)
    return out


def keys_of(symbols: np.ndarray) -> np.ndarray:
    """The KEYS keys of every signature: symbols left of a chunk, with the number of the choice."""
    chunks = symbols.reshape(len(symbols), CHUNKS, CHUNK_SYMBOLS).astype(np.uint64)
    left = chunks[:, :, _LEFT]
    key = np.arange(KEYS, dtype=np.uint64).reshape(1, CHUNKS, len(_LEFT)) + np.zeros((len(symbols), 1, 1), np.uint64)
    for i in range(left.shape[-1]):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + left[..., i] + np.uint64(1))
    return key.reshape(len(symbols), KEYS).view(np.int64)


def _distinct_shingles(column: pa.Array, words: int) -> Iterator[list[np.ndarray]]:
    """Sorted distinct shingles of each text, for runs of consecutive texts."""
    for a, b, found, _, _ in batches_of_words(column):
        yield [np.unique(found.shingles(i, words)) for i in range(b - a)]


def _set_id(shingles: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def signed_sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS) -> DataFrame:
    """(id, n_shingles, set_id, signature) of every row; equal sets have equal set_ids, empty ones no signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for sets in _distinct_shingles(batch.column(1), words):
                full = [i for i, s in enumerate(sets) if len(s)]
                made: list[bytes | None] = [None] * len(sets)
                if full:
                    begin = np.cumsum([0, *(len(sets[i]) for i in full)])[:-1]
                    for i, row in zip(full, signatures(np.concatenate([sets[i] for i in full]), begin)):
                        made[i] = row.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(sets)), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([_set_id(s) if len(s) else None for s in sets], pa.int64()), pa.array(made, pa.binary())],
                    names=["id", "n_shingles", "set_id", "signature"],
                )
                at += len(sets)

    source = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text"))
    return source.mapInArrow(run, "id bigint, n_shingles bigint, set_id bigint, signature binary")


def _keyed(sets: DataFrame) -> DataFrame:
    """(key, set_id, n) for every key of the signatures of `sets` (set_id, n, signature)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                symbols = np.frombuffer(b"".join(part.column(2).to_pylist()), SYMBOL).reshape(-1, SYMBOLS)
                owner = pa.array(np.repeat(np.arange(part.num_rows, dtype=np.int32), KEYS))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys_of(symbols).reshape(-1)), part.column(0).take(owner), part.column(1).take(owner)],
                    names=["key", "set_id", "n"],
                )

    return sets.select("set_id", "n", "signature").mapInArrow(run, "key bigint, set_id bigint, n bigint")


def _whole_sets(docs: DataFrame, text_col: str, words: int) -> DataFrame:
    """(set_id, shingles) of every row with words, sorted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for sets in _distinct_shingles(batch.column(0), words):
                sets = [s for s in sets if len(s)]
                if sets:
                    offsets = np.cumsum([0, *map(len, sets)]).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([_set_id(s) for s in sets], pa.int64()),
                         pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(sets).view(np.int64)))],
                        names=["set_id", "shingles"],
                    )

    return docs.select(docs[text_col].alias("text")).mapInArrow(run, "set_id bigint, shingles array<bigint>")


def _few(table: DataFrame) -> DataFrame:
    """A durable table of one or two numbers a row, broadcast if its counted rows allow that."""
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def confirmed(pairs: DataFrame, whole: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (x, y) whose sets, held in `whole`, are similar by `percent` or more (runs a job)."""
    one = lambda c: whole.select(F.col("set_id").alias(c), F.col("shingles").alias(f"of_{c}"))
    common, sizes = F.size(F.array_intersect("of_x", "of_y")), F.size("of_x") + F.size("of_y")
    both = pairs.join(one("x"), "x").join(one("y"), "y")
    return durable(both.where(100 * common >= percent * (sizes - common)).select("x", "y"))


def _near_size(a: str, b: str, percent: int):
    """Sets of such different sizes cannot be similar enough."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _placed(held: DataFrame, links: DataFrame | None) -> DataFrame:
    """`held` with the component of each set so far."""
    if links is None:
        return held.withColumn("comp", F.col("set_id"))
    comp = components(links).select(F.col("node").alias("set_id"), "comp")
    return held.drop("comp").join(comp, "set_id", "left").withColumn("comp", F.coalesce("comp", "set_id"))


def _led(held: DataFrame, by_key: DataFrame, percent: int) -> DataFrame:
    """Pairs of a set with leaders of its keys in other components, few per set, those with most common keys."""
    votes = (
        held.join(by_key.select("key", "leader"), "key")
        .where((F.col("comp") != F.col("leader.comp")) & _near_size("n", "leader.n", percent))
        .groupBy(F.col("set_id").alias("x"), F.col("leader.set_id").alias("y"))
        .agg(F.count(F.lit(1)).alias("votes"))
    )
    best = Window.partitionBy("x").orderBy(F.desc("votes"), "y")
    return votes.withColumn("place", F.row_number().over(best)).where(F.col("place") <= PAIRS_PER_SET).select("x", "y")


def _by_key(placed: DataFrame, pick) -> DataFrame:
    """Of each key with several components the sets and pairs of sets in them, and a leader: of its largest component."""
    leader = F.struct(pick.alias("pick"), "set_id", "n", "comp")
    return durable(
        placed.groupBy("key", "comp")
        .agg(F.count(F.lit(1)).alias("k"), F.max(leader).alias("leader"), F.min("n").alias("n"))
        .groupBy("key")
        .agg(F.sum("k").alias("sets"), F.sum(F.col("k") * F.col("k")).alias("inside"), F.count(F.lit(1)).alias("comps"),
             F.max(F.struct("k", "leader"))["leader"].alias("leader"), F.min("n").alias("least"))
        .where("comps > 1")
    )


def _enough(able, sizes, percent: int):
    """Whether so many common shingles can make sets of these sizes, summed, similar enough."""
    return (100 + percent) * able >= percent * sizes


def _parities(whole: DataFrame) -> DataFrame:
    """(set_id, bits): for each parity bit, whether an odd number of shingles fall on it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = 64 * PARITY_WORDS
        for whole_batch in batches:
            for at in range(0, whole_batch.num_rows, 1000):
                batch = whole_batch.slice(at, 1000)
                shingles = batch.column(1)
                owner = np.repeat(np.arange(batch.num_rows), np.diff(shingles.offsets.to_numpy()))
                bit = (shingles.flatten().to_numpy().view(np.uint64) % np.uint64(n)).astype(np.int64)
                odd = np.bincount(owner * n + bit, minlength=batch.num_rows * n) & 1
                words = pa.array(np.packbits(odd.astype(np.uint8)).view(np.int64))
                offsets = pa.array(np.arange(0, len(words) + 1, PARITY_WORDS, dtype=np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.ListArray.from_arrays(offsets, words)], names=["set_id", "bits"]
                )

    return whole.select("set_id", "shingles").mapInArrow(run, "set_id bigint, bits array<bigint>")


def _open(held: DataFrame, whole: DataFrame, percent: int) -> DataFrame:
    """All pairs of sets that share a key, lie in different components and may be similar enough."""
    left = durable(held.groupBy("set_id").agg(F.first("n").alias("n"), F.first("comp").alias("comp"), F.collect_list("key").alias("keys")))
    seen = whole.join(_few(left.select("set_id")), "set_id").select("set_id", F.explode("shingles").alias("shingle"))
    few = seen.groupBy("shingle").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") <= RARE_SETS)
    rare = durable(seen.join(few, "shingle"))
    counted = rare.groupBy("set_id").agg(F.count(F.lit(1)).alias("rare"))
    sets = durable(left.join(counted, "set_id", "left").withColumn("able", F.col("n") - F.coalesce("rare", F.lit(0))).drop("rare"))
    meet = rare.where("k > 1").select("shingle", "set_id")
    x, y = meet.withColumnRenamed("set_id", "x"), meet.withColumnRenamed("set_id", "y")
    met = x.join(y, "shingle").where("x < y").groupBy("x", "y").agg(F.count(F.lit(1)).alias("common"))
    of = lambda c: sets.select(F.col("set_id").alias(c), *[F.col(v).alias(f"{v}_{c}") for v in ("n", "able", "comp", "keys")])
    sizes, able = F.col("n_x") + F.col("n_y"), F.least("able_x", "able_y")
    via_rare = (
        met.join(of("x"), "x").join(of("y"), "y")
        .where((F.col("comp_x") != F.col("comp_y")) & _near_size("n_x", "n_y", percent))
        .where(_enough(able + F.col("common"), sizes, percent) & F.arrays_overlap("keys_x", "keys_y"))
        .select("x", "y")
    )
    rows = held.select("key", "set_id", "least").join(_few(sets.select("set_id", "n", "able", "comp")), "set_id")
    rows = durable(rows.where(_enough(F.col("able"), F.col("n") + F.col("least"), percent)).drop("least"))
    bits = durable(_parities(whole.join(_few(durable(rows.select("set_id").distinct())), "set_id")))
    rows = durable(rows.join(bits, "set_id"))
    rows = rows.join(_by_key(rows, F.lit(0)).select("key", F.col("leader.comp").alias("major")), "key")
    a, b = rows.where("comp <> major").alias("a"), rows.alias("b")
    differ = sum((F.bit_count(F.col("a.bits")[i].bitwiseXOR(F.col("b.bits")[i])) for i in range(PARITY_WORDS)), F.lit(0))
    on = (
        (F.col("a.key") == F.col("b.key"))
        & (F.col("a.comp") != F.col("b.comp"))
        & ((F.col("b.comp") == F.col("b.major")) | (F.col("a.set_id") < F.col("b.set_id")))
        & _near_size("a.n", "b.n", percent)
        & _enough(F.least("a.able", "b.able"), F.col("a.n") + F.col("b.n"), percent)
        & ((100 + percent) * differ <= (100 - percent) * (F.col("a.n") + F.col("b.n")))
    )
    direct = a.join(b, on).select(F.least("a.set_id", "b.set_id").alias("x"), F.greatest("a.set_id", "b.set_id").alias("y"))
    return via_rare.unionByName(direct).distinct()


def set_links(docs: DataFrame, sets: DataFrame, text_col: str = "text", words: int = SHINGLE_WORDS,
              percent: int = PERCENT) -> DataFrame:
    """Links (x, y) among the distinct `sets` (set_id, n, signature; durable): their components are those of all links."""
    keyed = _keyed(sets)
    shared = durable(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("sets")).where("sets > 1"))
    held = durable(keyed.join(_few(shared), "key"))
    spread = durable(held.groupBy("set_id").agg(F.sum("sets").alias("pick")))
    used = _few(spread.select("set_id"))
    whole = durable(
        _whole_sets(docs, text_col, words).join(used, "set_id").groupBy("set_id").agg(F.first("shingles").alias("shingles"))
    )
    held = durable(held.drop("sets").join(_few(spread), "set_id"))
    links, rounds, little = None, 0, False
    while True:
        placed = durable(_placed(held, links))
        by_key = _by_key(placed, F.xxhash64("set_id", F.lit(rounds)) if rounds else F.col("pick"))
        held = durable(placed.join(by_key.select("key", "least"), "key"))
        rows, pairs = by_key.agg(
            F.coalesce(F.sum("sets"), F.lit(0)),
            F.coalesce(F.sum((F.col("sets") * F.col("sets") - F.col("inside")).cast("double") / 2), F.lit(0.0)),
        ).first()
        if little or (rounds and pairs <= OPEN_PER_ROW * rows):
            more = confirmed(_open(held, whole, percent), whole, percent)
            return links.unionByName(more)
        tried = durable(_led(held, by_key, percent))
        found = confirmed(tried, whole, percent)
        little = found.count() <= LINKED_SHARE * tried.count()
        links = found if links is None else links.unionByName(found)
        held = held.drop("least")
        rounds += 1


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS,
                    percent: int = PERCENT) -> DataFrame:
    """`doc_id`, `n_shingles`, `component_id` (smallest id reachable over links) and `kept`, a row per row.

    Texts are linked when `percent` or more of the distinct shingles of both are common; a text of fewer than `words`
    words is one shingle. Null, empty and blank texts have none and are linked with nothing. Equal sets are linked.
    Kept is the row whose id is that of its component: of repeated ids all are. Ids may be null: null is no candidate
    for the smallest id, and a component of null ids only has a null component_id and is kept. A link at exactly the
    similarity of 0.8 shares no key with a probability of 6e-10. Other columns are not looked at.
    """
    rows = durable(signed_sets(docs, id_col, text_col, words))
    distinct = rows.where("set_id is not null").groupBy("set_id")
    sets = durable(distinct.agg(F.first("n_shingles").alias("n"), F.first("signature").alias("signature")))
    comp = components(set_links(docs, sets, text_col, words, percent)).withColumnRenamed("node", "set_id")
    own = durable(
        distinct.agg(F.min("id").alias("low")).join(comp, "set_id", "left").withColumn("comp", F.coalesce("comp", "set_id"))
    )
    least = own.groupBy("comp").agg(F.min("low").alias("component_id"))
    by_set = durable(own.join(least, "comp").select("set_id", "component_id"))
    linked = rows.where("set_id is not null").select("id", "n_shingles", "set_id").join(by_set, "set_id").drop("set_id")
    alone = rows.where("set_id is null").select("id", "n_shingles", F.col("id").alias("component_id"))
    found = linked.unionByName(alone)
    return found.select(
        F.col("id").alias("doc_id"), "n_shingles", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    )
