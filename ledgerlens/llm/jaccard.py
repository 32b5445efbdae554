"""Exact Jaccard join of word-shingle sets by vertical partitioning, and the components of its links.

The global order of all shingles (by number) is cut into fragments. Each set is cut along with it, and what a
fragment says about sets or pairs is counted there and summed over the fragments:

1. Equal sets become one. In every fragment the shingles of each set that occur in another set are counted.
   A set of n shingles with a partner of similarity 3/4 shares at least 3n/4 of them, so sets whose sums fall
   below that are done: they are alone. What is left are mostly sets with real partners.
2. For each shingle the few sets that share most of their shingles lead; the others are paired with them.
   Overlaps of these pairs are counted per fragment and summed, and the links found are contracted.
3. Only pairs in different components are still open. Those that agree in a shingle of their prefixes (rare
   shingles first) and pass length and position bounds are counted the same way, which finds every other link.

No pairs inside a component are formed after step 2, so a group of near copies costs a few pairs per member.
Shingles are 64-bit numbers, sets are told apart by 64-bit digests; within a fragment 40 bits are kept.

Very common shingles leave their fragments for layers of their own, each with a share of the sets, so that no
task holds all sets with such a shingle. They count as shared, come last in the order of rarity and have
leaders in each layer; overlaps look at fragments across layers. Which shingles are taken for common (a sample
of the sets says so) changes where work is done but no result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.graph import components
from ledgerlens.llm.words import batches_of_words
from ledgerlens.scratch import durable

FRAGMENT_SHINGLES = 2_000_000
PACKED_SHINGLES = 1_000_000
LEADERS = 3
PAIRS_PER_SET = 6
# Pairs are counted in blocks, each in this many coarser fragments.
COARSE = 16
BLOCK_PAIRS = 500_000
TOKEN_BYTES = 5
# One set in so many is looked at for common shingles: those of so many of the sets looked at, or more.
SAMPLED_SETS = 4096
COMMON_SAMPLED = 64
# Sets of one layer of a common shingle.
LAYER_SETS = 500_000
# Sets (24 bytes each) that are broadcast to their shingles at most; beyond, both sides are shuffled.
BROADCAST_SETS = 500_000


def _sets(column: pa.Array) -> Iterator[tuple[np.ndarray, int]]:
    """Sorted distinct shingles of each text and the digest of the set (0 for the empty set)."""
    for a, b, words, _, _ in batches_of_words(column):
        for i in range(b - a):
            s = np.unique(words.shingles(i))
            yield s, int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True) if len(s) else 0


def shingle_sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sampled: int = SAMPLED_SETS) -> DataFrame:
    """(id, n_shingles, set_id, sample) of each row; `sample`: the shingles themselves of one set in `sampled`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(len(s), d, s.tobytes() if len(s) and d % sampled == 0 else None) for s, d in _sets(batch.column(1))]
            sizes, digests, samples = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.int64()), pa.array(samples, pa.binary())],
                names=["id", "n_shingles", "set_id", "sample"],
            )

    source = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text"))
    return source.mapInArrow(run, "id bigint, n_shingles bigint, set_id bigint, sample binary")


def _common(sets: DataFrame, least: int) -> np.ndarray:
    """Sorted shingles that `least` sampled sets have: at most one for every so many sampled shingles."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(data.as_py(), np.int64))], names=["shingle"])

    looked_at = sets.where("sample is not null").groupBy("set_id").agg(F.first("sample").alias("sample"))
    found = (
        looked_at.select("sample").mapInArrow(each, "shingle bigint").groupBy("shingle").count().where(F.col("count") >= least)
    )
    return np.sort(np.array([r.shingle for r in found.select("shingle").collect()], np.int64).view(np.uint64))


def _bytes_of(tokens: np.ndarray) -> bytes:
    return np.ascontiguousarray(tokens.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :TOKEN_BYTES]).tobytes()


def _tokens_of(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // TOKEN_BYTES, 8), np.uint8)
    out[:, :TOKEN_BYTES] = np.frombuffer(data, np.uint8).reshape(-1, TOKEN_BYTES)
    return out.view("<u8").reshape(-1)


def _fragments(docs: DataFrame, text_col: str, n: int, common: np.ndarray, layers: int) -> DataFrame:
    """Rows (frag, layer, sets, counts, tokens): for some sets together, their shingles in one fragment.

    Layer 0 has the shingles that are not common, layers 1 to `layers` the common ones of the sets placed there.
    """
    held_common = docs.sparkSession.sparkContext.broadcast(common)

    def packed(sets: dict[int, np.ndarray]) -> pa.RecordBatch:
        ids = np.fromiter(sets, np.int64, len(sets))
        shingles = np.concatenate([*sets.values()])
        owner = np.repeat(np.arange(len(ids)), [len(s) for s in sets.values()])
        frag = (((shingles >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)).astype(np.int64)
        place = frag * (layers + 1)
        if len(held_common.value):
            at = np.minimum(np.searchsorted(held_common.value, shingles), len(held_common.value) - 1)
            place += np.where(held_common.value[at] == shingles, 1 + ids[owner] % layers, 0)
        order = np.argsort(place, kind="stable")
        place, owner, shingles = place[order], owner[order], shingles[order]
        present, begin = np.unique(place, return_index=True)
        rows: list[tuple] = []
        for p, a, b in zip(present.tolist(), begin, [*begin[1:], len(place)]):
            who, counts = np.unique(owner[a:b], return_counts=True)
            f, layer = divmod(p, layers + 1)
            rows.append((f, layer, ids[who].tobytes(), counts.astype(np.int32).tobytes(), _bytes_of(shingles[a:b])))
        types = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["frag", "layer", "sets", "counts", "tokens"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        size = 0
        for batch in batches:
            for s, d in _sets(batch.column(0)):
                if len(s) and d not in held:
                    held[d] = s
                    size += len(s)
                    if size >= PACKED_SHINGLES:
                        yield packed(held)
                        held, size = {}, 0
        if held:
            yield packed(held)

    return docs.select(docs[text_col].alias("text")).mapInArrow(
        run, "frag int, layer int, sets binary, counts binary, tokens binary"
    )


def _runs(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order that sorts the tokens, and how often each (in that order) occurs."""
    order = np.argsort(tokens, kind="stable")
    t = tokens[order]
    begin = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]]))
    length = np.diff(np.append(begin, len(t)))
    return order, np.repeat(length, length)


def _shared(table: pa.Table) -> pa.Table:
    """Of each set in a fragment the shingles that another set has as well."""
    ids, tokens = [], []
    for row in table.to_pylist():
        ids.append(np.repeat(np.frombuffer(row["sets"], np.int64), np.frombuffer(row["counts"], np.int32)))
        tokens.append(_tokens_of(row["tokens"]))
    who, t = np.concatenate(ids), np.concatenate(tokens)
    order = np.lexsort((t, who))
    who, t = who[order], t[order]
    first = np.concatenate([[True], (who[1:] != who[:-1]) | (t[1:] != t[:-1])])  # a set packed more than once
    who, t = who[first], t[first]
    layer = table.column("layer")[0].as_py()
    order, times = _runs(t)
    several = np.zeros(len(t), bool)
    several[order] = (times > 1) | (layer > 0)
    who, t = who[several], t[several]
    sets, begin = np.unique(who, return_index=True)
    ends = [*begin[1:], len(who)]
    frag = table.column("frag")[0].as_py()
    return pa.table(
        {
            "frag": pa.array([frag] * len(sets), pa.int32()),
            "layer": pa.array([layer] * len(sets), pa.int32()),
            "set_id": pa.array(sets, pa.int64()),
            "n_shared": pa.array(np.array(ends, np.int64) - begin, pa.int64()),
            "tokens": pa.array([_bytes_of(t[a:b]) for a, b in zip(begin, ends)], pa.binary()),
        }
    )


def _unpacked(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Row number and token of every shingle of a fragment."""
    parts = [_tokens_of(x) for x in table.column("tokens").to_pylist()]
    rows = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    return rows, np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def _leader_pairs(table: pa.Table) -> pa.Table:
    """Pairs of a set with the leaders of its shingles, and how many shingles say so."""
    ids = table.column("set_id").to_numpy()
    n = table.column("n").to_numpy()
    alone = table.column("alone").to_numpy()
    place = np.empty(len(ids), np.int64)
    place[np.lexsort((ids, alone))] = np.arange(len(ids))
    rows, tokens = _unpacked(table)
    order = np.lexsort((place[rows], tokens))
    rows, tokens = rows[order], tokens[order]
    begin = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
    at = np.repeat(begin, np.diff(np.append(begin, len(tokens))))
    pairs = []
    for k in range(LEADERS):
        later = np.flatnonzero(np.arange(len(rows)) - at > k)
        pairs.append(rows[later] * len(ids) + rows[at[later] + k])
    found, votes = np.unique(np.concatenate(pairs), return_counts=True)
    x, y = found // len(ids), found % len(ids)
    near = 4 * np.minimum(n[x], n[y]) >= 3 * np.maximum(n[x], n[y])
    x, y, votes = x[near], y[near], votes[near]
    return pa.table({"x": ids[x], "y": ids[y], "nx": n[x], "ny": n[y], "votes": votes})


def _rarity(table: pa.Table) -> pa.Table:
    """Of each set the shingles that another set left has, with the number of such sets."""
    rows, tokens = _unpacked(table)
    order, times = _runs(tokens)
    df = np.empty(len(tokens), np.uint32)
    df[order] = times if table.column("layer")[0].as_py() == 0 else np.iinfo(np.uint32).max  # the same in every layer
    keep = df > 1
    rows, tokens, df = rows[keep], tokens[keep], df[keep]
    present, begin = np.unique(rows, return_index=True)
    ends = [*begin[1:], len(rows)]
    frag = np.uint64(table.column("frag")[0].as_py()) << np.uint64(8 * TOKEN_BYTES)
    return pa.table(
        {
            "set_id": table.column("set_id").to_numpy()[present],
            "n": table.column("n").to_numpy()[present],
            "dfs": pa.array([df[a:b].tobytes() for a, b in zip(begin, ends)], pa.binary()),
            "tokens": pa.array([(tokens[a:b] | frag).tobytes() for a, b in zip(begin, ends)], pa.binary()),
        }
    )


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by set: the first shingles in order of rarity of which a partner must have one."""
    held: list[tuple[bytes, bytes]] = []
    current, n = None, 0

    def prefix() -> pa.RecordBatch:
        df = np.concatenate([np.frombuffer(d, np.uint32) for d, _ in held])
        tokens = np.concatenate([np.frombuffer(t, np.uint64) for _, t in held])
        order = np.lexsort((tokens, df))
        alone = n - len(order)  # these come first and have no partner
        take = max(0, n - (3 * n + 3) // 4 + 1 - alone)
        chosen = tokens[order[:take]].view(np.int64)
        size = len(chosen)
        return pa.RecordBatch.from_arrays(
            [pa.array(chosen), pa.array([current] * size, pa.int64()), pa.array([n] * size, pa.int64()),
             pa.array(alone + np.arange(size), pa.int64())],
            names=["token", "set_id", "n", "pos"],
        )

    for batch in batches:
        for row in batch.to_pylist():
            if row["set_id"] != current and held:
                yield prefix()
                held = []
            current, n = row["set_id"], row["n"]
            held.append((row["dfs"], row["tokens"]))
    if held:
        yield prefix()


def _packed_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        block = batch.column(0).to_numpy()
        xy = np.stack([batch.column(1).to_numpy(), batch.column(2).to_numpy()], axis=1)
        blocks = np.unique(block)
        yield pa.RecordBatch.from_arrays(
            [pa.array(blocks, pa.int32()), pa.array([xy[block == b].tobytes() for b in blocks], pa.binary())],
            names=["block", "xy"],
        )


def _overlaps_of_block(segments: pa.Table, pairs: pa.Table) -> pa.Table:
    """How many shingles of a coarse fragment the two sets of each pair have in common."""
    empty = pa.table({c: pa.array([], pa.int64()) for c in ("x", "y", "c")})
    if not segments.num_rows or not pairs.num_rows:
        return empty
    rows, tokens = _unpacked(segments)
    frag = segments.column("frag").to_numpy().astype(np.uint64)[rows]
    _, token = np.unique(tokens | (frag << np.uint64(8 * TOKEN_BYTES)), return_inverse=True)
    ids, owner = np.unique(segments.column("set_id").to_numpy(), return_inverse=True)
    width = int(token.max()) + 1
    keys = np.sort(owner[rows].astype(np.int64) * width + token)
    begin = np.searchsorted(keys, np.arange(len(ids) + 1) * width)
    xy = np.concatenate([np.frombuffer(b, np.int64).reshape(-1, 2) for b in pairs.column("xy").to_pylist()])
    xi, yi = (np.minimum(np.searchsorted(ids, xy[:, i]), len(ids) - 1) for i in (0, 1))
    here = (ids[xi] == xy[:, 0]) & (ids[yi] == xy[:, 1])
    xy, xi, yi = xy[here], xi[here], yi[here]
    size = begin[xi + 1] - begin[xi]
    counts = np.zeros(len(xy), np.int64)
    steps = np.searchsorted(np.cumsum(size), np.arange(0, int(size.sum()) + 1, 2_000_000), side="left")
    for a, b in zip(steps, [*steps[1:], len(xy)]):
        if a == b:
            continue
        pair = np.repeat(np.arange(a, b), size[a:b])
        offset = np.arange(len(pair)) - np.repeat(np.cumsum(size[a:b]) - size[a:b], size[a:b])
        probe = keys[begin[xi[pair]] + offset] - xi[pair] * width + yi[pair] * width
        at = np.minimum(np.searchsorted(keys, probe), len(keys) - 1)
        counts += np.bincount(pair[keys[at] == probe], minlength=len(xy))
    some = counts > 0
    return pa.table({"x": xy[some, 0], "y": xy[some, 1], "c": counts[some]})


def overlaps(pairs: DataFrame, segments: DataFrame) -> DataFrame:
    """(x, y, nx, ny, overlap) of the given pairs of sets, summed over fragments; pairs without overlap go."""
    pairs = durable(pairs)
    blocks = pairs.count() // BLOCK_PAIRS + 1
    placed = pairs.withColumn("block", F.pmod(F.xxhash64("y"), F.lit(blocks)).cast("int"))
    needed = placed.select("block", F.explode(F.array("x", "y")).alias("set_id")).distinct()
    held = segments.join(needed, "set_id").select(
        (F.col("frag") % COARSE).alias("coarse"), "block", "frag", "set_id", "tokens"
    )
    spread = placed.select("block", "x", "y").mapInArrow(_packed_pairs, "block int, xy binary").select(
        F.explode(F.sequence(F.lit(0), F.lit(COARSE - 1))).alias("coarse"), "block", "xy"
    )
    counted = held.groupBy("coarse", "block").cogroup(spread.groupBy("coarse", "block")).applyInArrow(
        _overlaps_of_block, "x bigint, y bigint, c bigint"
    )
    return pairs.join(counted.groupBy("x", "y").agg(F.sum("c").alias("overlap")), ["x", "y"])


def _linked(pairs: DataFrame, segments: DataFrame) -> DataFrame:
    """Similarity c / (nx + ny - c) of 3/4 or more."""
    return durable(overlaps(pairs, segments).where("7 * overlap >= 3 * (nx + ny)").select("x", "y"))


def _ordered(pairs: DataFrame) -> DataFrame:
    swap = F.col("x") > F.col("y")
    pick = lambda a, b: F.when(swap, F.col(b)).otherwise(F.col(a))
    return pairs.select(
        pick("x", "y").alias("x"), pick("y", "x").alias("y"), pick("nx", "ny").alias("nx"), pick("ny", "nx").alias("ny")
    ).distinct()


def _open_pairs(segments: DataFrame, comp: DataFrame) -> DataFrame:
    """Pairs of different components that agree in their prefixes and may still reach the similarity."""
    rare = segments.groupBy("frag", "layer").applyInArrow(_rarity, "set_id bigint, n bigint, dfs binary, tokens binary")
    prefix = (
        rare.repartition("set_id").sortWithinPartitions("set_id")
        .mapInArrow(_prefixes, "token bigint, set_id bigint, n bigint, pos bigint")
    )
    placed = durable(
        prefix.join(comp.withColumnRenamed("node", "set_id"), "set_id", "left").withColumn(
            "comp", F.coalesce("comp", "set_id")
        )
    )
    per_comp = placed.groupBy("token", "comp").agg(F.count(F.lit(1)).alias("k"))
    several = durable(
        per_comp.groupBy("token").agg(F.max_by("comp", F.struct("k", "comp")).alias("major"), F.count(F.lit(1)).alias("comps"))
        .where("comps > 1")
        .drop("comps")
    )
    open_ = durable(placed.join(several, "token"))
    a = open_.where("comp <> major").alias("a")
    b = open_.alias("b")
    on = (
        (F.col("a.token") == F.col("b.token"))
        & (F.col("a.comp") != F.col("b.comp"))
        & ((F.col("b.comp") == F.col("b.major")) | (F.col("a.set_id") < F.col("b.set_id")))
        & (4 * F.least("a.n", "b.n") >= 3 * F.greatest("a.n", "b.n"))
        & (7 * F.least(F.expr("a.n - a.pos"), F.expr("b.n - b.pos")) >= 3 * (F.col("a.n") + F.col("b.n")))
    )
    return _ordered(
        a.join(b, on).select(
            F.col("a.set_id").alias("x"), F.col("b.set_id").alias("y"), F.col("a.n").alias("nx"), F.col("b.n").alias("ny")
        )
    )


def set_components(docs: DataFrame, sets: DataFrame, text_col: str = "text", common_sampled: int = COMMON_SAMPLED,
                   layer_sets: int = LAYER_SETS) -> DataFrame:
    """(node, comp) of every distinct set that is linked with another one; `sets` is durable."""
    distinct = sets.where("n_shingles > 0").groupBy("set_id").agg(F.first("n_shingles").alias("n"))
    n_sets, total = distinct.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    common = _common(sets, common_sampled)
    fragments = max(2 * COARSE, total // FRAGMENT_SHINGLES + 1)
    shared = durable(
        _fragments(docs, text_col, fragments, common, n_sets // layer_sets + 1).groupBy("frag", "layer").applyInArrow(
            _shared, "frag int, layer int, set_id bigint, n_shared bigint, tokens binary"
        )
    )
    alive = (
        shared.groupBy("set_id").agg(F.sum("n_shared").alias("n_shared")).join(distinct, "set_id")
        .where("4 * n_shared >= 3 * n")
        .select("set_id", "n", (1 - F.col("n_shared") / F.col("n")).alias("alone"))
    )
    alive = durable(alive)
    few = F.broadcast(alive) if alive.count() <= BROADCAST_SETS else alive
    segments = durable(shared.drop("n_shared").join(few, "set_id"))
    votes = segments.groupBy("frag", "layer").applyInArrow(
        _leader_pairs, "x bigint, y bigint, nx bigint, ny bigint, votes bigint"
    )
    best = Window.partitionBy("x").orderBy(F.desc("votes"), "y")
    led = (
        votes.groupBy("x", "y", "nx", "ny").agg(F.sum("votes").alias("votes"))
        .withColumn("place", F.row_number().over(best))
        .where(F.col("place") <= PAIRS_PER_SET)
    )
    links = _linked(_ordered(led), segments)
    more = _linked(_open_pairs(segments, components(links)), segments)
    return components(links.union(more))


def similarity_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`doc_id`, `n_shingles`, `component_id` of every row: the smallest id reachable over links.

    Texts are linked when the Jaccard similarity of their sets of five-word shingles is 3/4 or more; a text
    of fewer words is one shingle. Null, empty and blank texts have no shingles and are linked with nothing.
    Equal sets are linked. Ids may repeat and may be null: null is no candidate for the smallest id, and a
    component of null ids only has a null component_id. Other columns are not looked at.
    """
    sets = durable(shingle_sets(docs, id_col, text_col))
    comp = set_components(docs, sets, text_col).withColumnRenamed("node", "set_id")
    own = sets.where("n_shingles > 0").groupBy("set_id").agg(F.min("id").alias("low")).join(comp, "set_id", "left")
    own = durable(own.withColumn("comp", F.coalesce("comp", "set_id")))
    least = durable(own.groupBy("comp").agg(F.min("low").alias("least")))
    by_set = durable(own.join(least, "comp").select("set_id", "least"))
    found = sets.where("n_shingles > 0").join(by_set, "set_id")
    return found.select(F.col("id").alias("doc_id"), "n_shingles", F.col("least").alias("component_id")).unionByName(
        sets.where("n_shingles = 0").select(F.col("id").alias("doc_id"), "n_shingles", F.col("id").alias("component_id"))
    )
