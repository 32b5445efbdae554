"""Balanced label propagation: linked documents gather in shards that stay exactly even."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.scratch import durable

SHARDS = 16
ROUNDS = 16
# Groups above this share of a shard start packed: at most so many a shard, too large to travel by swaps.
LARGE = 8
# Proposals are let in by size class and hash class; only the class on the edge is ranked by row.
HASH_CLASSES = 64
ROWS_PER_BUCKET = 50_000


def _spread(column: str, n: int, salt: str = ""):
    return F.pmod(F.xxhash64(F.lit(salt), column), F.lit(n)).cast("int")


def cut_links(members: DataFrame, state: DataFrame) -> int:
    """Links between members of a group that lie in different shards."""
    n = members.join(state, "node").groupBy("grp", "shard").agg(F.count(F.lit(1)).cast("decimal(38,0)").alias("n"))
    groups = n.groupBy("grp").agg((F.pow(F.sum("n"), 2) - F.sum(F.pow("n", F.lit(2)))).alias("twice"))
    return int((groups.agg(F.sum("twice")).first()[0] or 0) / 2)


def propagate(members: DataFrame, capacity: list[int], rounds: int = ROUNDS, history: list | None = None) -> DataFrame:
    """Shard of each node of `members` (node, grp), no shard above its capacity.

    A group stands for links between all its members; a pair of linked documents is a group of two. Nodes
    start spread evenly, but for groups too large to travel, which start packed. In each round a node counts
    the members of its groups in every shard and proposes to move to the shard with most, ties by a hash of
    the group and the round; opposite proposals of two shards are matched as swaps, others are granted within
    the free places, those that moves of the round leave included. Where nothing can be granted, shards with
    free places alone are proposed. It ends when nobody moves or after `rounds`. What is still cut then is
    packed into the places it holds and those left free, if that cuts fewer links. `history` takes
    (moves asked for, moves granted, links cut before) of each round, and at the end (0, 0, links cut).
    """
    n = len(capacity)
    members = durable(members)
    nodes = durable(members.groupBy("node").agg(F.min("grp").alias("grp")))
    state = durable(_start(nodes, capacity))
    hash_classes = HASH_CLASSES
    every = True
    for turn in range(rounds):
        inside = {r.shard: r.n for r in state.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
        free = [capacity[s] - inside.get(s, 0) for s in range(n)]
        open_ = [s for s in range(n) if every or free[s] > 0]
        here = members.join(state, "node")
        counts = durable(here.groupBy("grp", "shard").agg(F.count(F.lit(1)).alias("n")))
        votes = (
            members.join(counts.groupBy("grp").agg(F.collect_list(F.struct("shard", "n")).alias("v")).transform(durable), "grp")
            .select("node", "grp", F.inline("v"))
            .groupBy("node", "shard")
            .agg(F.sum("n").alias("n"), F.min("grp").alias("grp"))
        )
        wanted = (
            votes.join(state.withColumnRenamed("shard", "own"), "node")
            .where(F.col("shard").isin(open_) | (F.col("shard") == F.col("own")))
            .groupBy("node", "own")
            .agg(F.max(F.struct("n", F.xxhash64(F.lit(turn), "grp", "shard").alias("tie"), "shard")).alias("best"))
            .select("node", "own", F.col("best.shard").alias("to"), F.col("best.n").alias("n"))
            .where("to <> own")
            .withColumns({"size": F.floor(F.log2("n")).cast("int"), "h": _spread("node", hash_classes)})
        )
        wanted = durable(wanted)
        classes = wanted.groupBy("own", "to", "size", "h").agg(F.count(F.lit(1)).alias("n")).collect()
        asked: dict[tuple[int, int], int] = {}
        for c in classes:
            asked[c.own, c.to] = asked.get((c.own, c.to), 0) + c.n
        room = _grants(asked, free)
        admitted = []
        for c in sorted(classes, key=lambda c: (c.size, c.h)):
            take = min(room[c.own, c.to], c.n)
            room[c.own, c.to] -= take
            if take:
                admitted.append((c.own, c.to, c.size, c.h, take, take == c.n))
        if history is not None:
            history.append((sum(asked.values()), sum(c[4] for c in admitted), cut_links(members, state)))
        if not admitted:
            if not every or not classes:
                break
            every = False
            continue
        every = True
        spark = members.sparkSession
        quota = spark.createDataFrame(admitted, "own int, to int, size int, h int, quota long, whole boolean")
        granted = wanted.join(F.broadcast(quota), ["own", "to", "size", "h"])
        edge = granted.where("not whole").withColumn("class_", F.concat_ws(" ", "own", "to", "size", "h"))
        edge = ranks(edge, "class_", sum(c.n for c in classes)).where("slot < quota")
        moves = granted.where("whole").select("node", "to").unionByName(edge.select("node", "to")).withColumnRenamed("to", "new")
        state = durable(state.join(moves, "node", "left").select("node", F.coalesce("new", "shard").alias("shard")))
    state = _mended(members, nodes, state, capacity)
    if history is not None:
        history.append((0, 0, cut_links(members, state)))
    return state


def _start(nodes: DataFrame, capacity: list[int]) -> DataFrame:
    sizes = nodes.groupBy("grp").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") * LARGE > min(capacity))
    large = durable(nodes.join(sizes.select("grp"), "grp", "left_semi"))
    packed = durable(_packed(large, capacity))
    rest = nodes.join(sizes.select("grp"), "grp", "left_anti").select("node")
    free, k = _free(packed, capacity), rest.count()
    places = [k * f // max(1, sum(free)) for f in free]
    for _ in range(k - sum(places)):
        places[max(range(len(free)), key=lambda s: free[s] - places[s])] += 1
    return packed.unionByName(dealt(rest, places, k).select("node", "shard"))


def _free(state: DataFrame, capacity: list[int]) -> list[int]:
    used = {r.shard: r.n for r in state.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
    return [c - used.get(s, 0) for s, c in enumerate(capacity)]


def _mended(members: DataFrame, nodes: DataFrame, state: DataFrame, capacity: list[int]) -> DataFrame:
    """`state`, or what packing the nodes of groups that are still cut makes of it if fewer links are cut.

    Where that leaves groups cut that a shard could hold, groups smaller than the largest of them are packed too.
    """
    placed = durable(nodes.join(state, "node"))
    groups = placed.groupBy("grp").agg(F.min("shard").alias("a"), F.max("shard").alias("b"), F.count(F.lit(1)).alias("size"))
    groups = durable(groups.select("grp", "size", (F.col("a") != F.col("b")).alias("cut")))
    largest = groups.where(F.col("cut") & (F.col("size") <= max(capacity))).agg(F.max("size")).first()[0]
    least = cut_links(members, state)
    for moved in (F.col("cut"), F.col("cut") | (F.col("size") < (largest or 0))):
        if largest is None or not least:
            break
        again = groups.where(moved & (F.col("size") <= max(capacity))).select("grp")
        stay = durable(placed.join(again, "grp", "left_anti").select("node", "shard"))
        packed = _packed(durable(nodes.join(again, "grp", "left_semi")), _free(stay, capacity))
        mended = durable(stay.unionByName(packed))
        left = cut_links(members, mended)
        if left < least:
            state, least = mended, left
    return state


def _grants(asked: dict[tuple[int, int], int], free: list[int]) -> dict[tuple[int, int], int]:
    """Moves from shard to shard, at most those asked for: swaps, and what finds room as others leave."""
    free = list(free)
    given = {(a, b): min(k, asked.get((b, a), 0)) for (a, b), k in asked.items()}
    moved = True
    while moved:
        moved = False
        for (a, b), k in sorted(asked.items()):
            take = min(free[b], k - given[a, b])
            if take > 0:
                given[a, b] += take
                free[b] -= take
                free[a] += take
                moved = True
    return given


def _packed(nodes: DataFrame, capacity: list[int]) -> DataFrame:
    """Shard of each of `nodes` (node, grp), largest groups first, each in the first shard that holds it whole.

    Groups of one size are counted, not listed. Fewer groups than shards fit nowhere; they are dealt to what is left.
    """
    spark, free = nodes.sparkSession, list(capacity)
    groups = durable(nodes.groupBy("grp").agg(F.count(F.lit(1)).alias("size")))
    numbers = groups.groupBy("size").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("size")).collect()
    ends = []
    for size, n in numbers:
        at = 0
        for s in range(len(free)):
            take = min(n - at, free[s] // size)
            at += take
            free[s] -= take * size
            if take:
                ends.append((size, at, s))
    lookup = "size long, end long, shard int"
    by_size = _ends(spark.createDataFrame(ends, lookup), "size")
    slots = ranks(groups.withColumnRenamed("grp", "node"), "size", sum(r.n for r in numbers)).withColumnRenamed("node", "grp")
    placed = durable(slots.join(F.broadcast(by_size), "size", "left").select("grp", "size", _shard_at("slot").alias("shard")))
    whole = nodes.join(placed.where("shard is not null"), "grp").select("node", "shard")
    odd = placed.where("shard is null").orderBy(F.desc("size"), "grp").collect()
    if not odd:
        return whole
    ends = []
    for r in odd:
        at = 0
        for s in sorted(range(len(free)), key=lambda s: (-free[s], s)):
            take = min(r.size - at, free[s])
            at += take
            free[s] -= take
            if take:
                ends.append((r.grp, at, s))
    key = nodes.schema["grp"].dataType.simpleString()
    by_group = _ends(spark.createDataFrame(ends, f"grp {key}, end long, shard int"), "grp")
    rest = nodes.join(F.broadcast(by_group.select("grp")), "grp", "left_semi")
    parted = ranks(rest, "grp", sum(r.size for r in odd)).join(F.broadcast(by_group), "grp")
    return whole.unionByName(parted.select("node", _shard_at("slot").alias("shard")))


def _ends(rows: DataFrame, key: str) -> DataFrame:
    return rows.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("end", "shard"))).alias("ends"))


def _shard_at(slot: str):
    """Shard of the first end beyond the slot; null beyond all."""
    return F.try_element_at(F.filter("ends", lambda e: e["end"] > F.col(slot)), F.lit(1))["shard"]


def _buckets(n: int) -> int:
    return max(HASH_CLASSES, n // ROWS_PER_BUCKET)


def dealt(nodes: DataFrame, places: list[int], n: int) -> DataFrame:
    """Give each of the n nodes a shard, exactly `places[s]` of them shard s."""
    ranked = ranks(nodes.withColumn("shard_", F.lit(0)), "shard_", n)
    ends = [*accumulate(places)]
    shard = F.lit(len(places) - 1)
    for s in reversed(range(len(places) - 1)):
        shard = F.when(F.col("slot") < ends[s], s).otherwise(shard)
    return ranked.withColumn("shard", shard.cast("int")).drop("slot", "shard_")


def ranks(rows: DataFrame, within: str, n: int) -> DataFrame:
    """`slot`: 0, 1, 2 ... within each value of `within`, from counts per hash bucket and ranks inside buckets."""
    rows = rows.withColumn("bucket_", _spread("node", _buckets(n), within))
    counts = durable(rows.groupBy(within, "bucket_").agg(F.count(F.lit(1)).alias("n_")))
    before = Window.partitionBy(within).orderBy("bucket_").rowsBetween(Window.unboundedPreceding, -1)
    offsets = durable(counts.withColumn("offset_", F.coalesce(F.sum("n_").over(before), F.lit(0))).drop("n_"))
    place = F.row_number().over(Window.partitionBy(within, "bucket_").orderBy("node")) - 1
    return (
        rows.withColumn("place_", place)
        .join(offsets, [within, "bucket_"])
        .withColumn("slot", (F.col("offset_") + F.col("place_")).cast("long"))
        .drop("bucket_", "offset_", "place_")
    )


def shard_documents(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS, id_col: str = "doc_id",
                    text_col: str = "text", history: list | None = None) -> DataFrame:
    """Put documents into shards of equal row counts (at most one apart), equal texts together where they fit.

    Columns: doc_id, size (UTF-8 bytes plus 1), text_crc32, n_copies, shard, slot (0, 1, 2 ... in its shard).
    Documents without a copy are dealt out last, to make the counts even, so every linked document competes
    only for the capacity of a shard. Null text: size 1, checksum 0, a copy of other nulls but not of empty
    text. Rows that agree in id and text are separate copies; null ids are kept. Empty in, empty out.
    """
    text = docs[text_col]
    rows = durable(
        docs.select(
            docs[id_col].alias("doc_id"),
            (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
            F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).alias("text_crc32"),
            F.coalesce(F.md5(text.cast("binary")), F.lit("")).alias("grp"),
            F.monotonically_increasing_id().alias("node"),
        )
    )
    n = rows.count()
    capacity = [n // shards + (s < n % shards) for s in range(shards)]
    groups = durable(rows.groupBy("grp").agg(F.count(F.lit(1)).alias("n_copies")).where("n_copies > 1"))
    members = rows.select("node", "grp").join(groups, "grp")
    linked = propagate(members.select("node", "grp"), capacity, rounds, history)
    used = {r.shard: r.n for r in linked.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
    rest = rows.select("node").join(linked, "node", "left_anti")
    places = [capacity[s] - used.get(s, 0) for s in range(shards)]
    placed = durable(linked.unionByName(dealt(rest, places, sum(places)).select("node", "shard")))
    slots = ranks(placed, "shard", n)
    return rows.join(groups, "grp", "left").join(slots, "node").select(
        "doc_id", "size", "text_crc32", F.coalesce("n_copies", F.lit(1)).alias("n_copies"), "shard", "slot"
    )
