"""WARC archives written and read by Spark, with records told from magic bytes inside payloads.

Reading cuts the files at every magic, in parallel splits. Each piece is a candidate: its header gives the
offset at which its record ends and the next must begin. Runs of candidates that point to one another are
contracted, and pointer jumping from the start of each file, doubling the distance each round, marks what is
reachable. Magic inside a payload is not, whatever follows it.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.scratch import durable

# Fixed values of the format.
MAGIC = "WARC/1.0\r\n"
END = "\r\n\r\n"
DATE = "2000-01-01T00:00:00Z"

REVISIT_BYTES = 1000
# Narrow rows (numbers and file names) that are broadcast at most; beyond, the join shuffles.
BROADCAST_ROWS = 200_000


def _bounded(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html", date: str = DATE) -> None:
    """Write one record per row below `path`, one file per partition.

    Of rows with equal payloads of at least 1000 bytes the one with the largest id is the response and the
    others are revisits that refer to it and carry no payload; smaller payloads are always responses. A null
    payload is written as the empty one. Rows with a null id are responses; rows that repeat the largest id
    are all responses. Payloads may hold line breaks, blank lines and magic; a URL's line breaks are escaped.
    """
    payload = F.coalesce(pages[payload_col], F.lit(""))
    rows = pages.select(
        pages[id_col].cast("long").alias("id"), pages[url_col].alias("url"), payload.alias("payload"),
        F.sha1(payload.cast("binary")).alias("sha"),
    )
    facts = durable(rows.where(F.octet_length("payload") >= REVISIT_BYTES).select("id", "sha"))
    groups = facts.groupBy("sha").agg(F.max("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    again = durable(facts.join(durable(groups), "sha").where("id <> first").select("id", "sha", "first").distinct())
    marked = rows.join(_bounded(again), ["id", "sha"], "left")
    again_here = F.col("first").isNotNull()
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    body = F.when(again_here, F.lit("")).otherwise(F.col("payload"))
    header = F.concat_ws(
        "\r\n",
        F.when(again_here, F.lit("WARC-Type: revisit")).otherwise(F.lit("WARC-Type: response")),
        F.concat(F.lit("WARC-Record-ID: "), name("id")),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), url),
        F.when(again_here, F.concat(F.lit("WARC-Refers-To: "), name("first"))),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("sha")),
        F.lit("Content-Type: text/html"),
        F.concat(F.lit("Content-Length: "), F.octet_length(body).cast("string")),
    )
    record = F.concat(F.lit(MAGIC), header, F.lit(END), body)
    marked.select(record.alias("value")).write.option("lineSep", END).text(path)


def _header(piece: bytes) -> tuple[int, int, dict[bytes, bytes]] | None:
    """Bytes of the header with its blank line, of the content, and the fields; None if it is no header."""
    stop = piece.find(b"\r\n\r\n")
    if stop < 0:
        return None
    fields = {}
    for line in piece[:stop].split(b"\r\n"):
        key, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[key.strip().lower()] = value.strip()
    length = fields.get(b"content-length", b"")
    return (stop + 4, int(length), fields) if length.isdigit() and len(length) < 19 else None


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """What lies between magics, with the file and the start of the split it was read in."""
    return spark.read.option("lineSep", MAGIC).text(path).select(
        F.col("value").cast("binary").alias("piece"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, str, int, int, bytes]]:
    """Every piece with its number in its split."""
    seen: dict[tuple[str, int], int] = defaultdict(int)
    for batch in batches:
        pieces, files, blocks = batch.columns
        for piece, file, block in zip(pieces, files.to_pylist(), blocks.to_pylist()):
            yield len(pieces), file, block, seen[file, block], piece.as_buffer().to_pybytes()
            seen[file, block] += 1


CANDIDATE = "file string, block bigint, n bigint, size bigint, head bigint, content bigint"


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = []
    types = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
    names = ["file", "block", "n", "size", "head", "content"]

    def made() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    for _, file, block, n, piece in _numbered(batches):
        found = _header(piece)
        rows.append((file, block, n, len(piece), found[0] if found else None, found[1] if found else None))
        if len(rows) >= 50_000:
            yield made()
            rows = []
    if rows:
        yield made()


def record_offsets(spark: SparkSession, path: str) -> DataFrame:
    """Every candidate (file, block, n, offset, size, head, content) and whether it is a `record`."""
    pieces = durable(_pieces(spark, path).mapInArrow(_candidates, CANDIDATE))
    length = F.col("size") + len(MAGIC)
    before = lambda *p: Window.partitionBy(*p).rowsBetween(Window.unboundedPreceding, -1)
    blocks = pieces.groupBy("file", "block").agg(F.sum(length).alias("bytes")).withColumn(
        "base", F.coalesce(F.sum("bytes").over(before("file").orderBy("block")), F.lit(0))
    )
    in_block = Window.partitionBy("file", "block").orderBy("n")
    placed = (
        pieces.join(blocks.select("file", "block", "base"), ["file", "block"])
        .withColumn("inside", F.coalesce(F.sum(length).over(before("file", "block").orderBy("n")), F.lit(0)))
        .withColumn("offset", F.col("base") + F.col("inside") - len(MAGIC))
        .withColumn("next", F.expr(f"offset + {len(MAGIC)} + head + content + {len(END)}"))
        .withColumn("breaks", ~F.coalesce(F.col("next") == F.lead("offset").over(in_block), F.lit(False)))
        .withColumn("run", F.coalesce(F.sum(F.col("breaks").cast("int")).over(before("file", "block").orderBy("n")), F.lit(0)))
        .select("file", "block", "run", "n", "offset", "size", "head", "content", "next", "breaks")
    )
    placed = durable(placed)
    key = ["file", "block", "run"]
    exits = placed.where("breaks and next is not null").select(*key, "next")
    entry = placed.where("offset >= 0").select(
        "file", F.col("offset").alias("next"), F.col("block").alias("to_block"), F.col("run").alias("to_run")
    )
    jumps = durable(exits.join(entry, ["file", "next"]).select(*key, "to_block", "to_run", F.col("next").alias("entry")))
    reached = durable(placed.where("offset = 0").select(*key, F.col("offset").alias("entry")))
    while not jumps.isEmpty():
        onward = jumps.withColumnRenamed("entry", "at")
        there = reached.join(onward, key).select(
            "file", F.col("to_block").alias("block"), F.col("to_run").alias("run"), F.col("at").alias("entry")
        )
        reached = durable(reached.union(there).groupBy(*key).agg(F.min("entry").alias("entry")))
        second = jumps.select(
            "file", F.col("block").alias("to_block"), F.col("run").alias("to_run"),
            F.col("to_block").alias("b2"), F.col("to_run").alias("r2"), F.col("entry").alias("e2"),
        )
        jumps = durable(
            jumps.join(second, ["file", "to_block", "to_run"]).select(
                *key, F.col("b2").alias("to_block"), F.col("r2").alias("to_run"), F.col("e2").alias("entry")
            )
        )
    return placed.join(reached, key, "left").select(
        "file", "block", "n", "offset", "size", "head", "content", "next",
        F.coalesce((F.col("offset") >= F.col("entry")) & F.col("next").isNotNull(), F.lit(False)).alias("record"),
    )


RECORD = (
    "record_type string, record_id string, target_uri string, refers_to string, payload_digest string, payload binary"
)
FIELDS = (b"warc-type", b"warc-record-id", b"warc-target-uri", b"warc-refers-to", b"warc-payload-digest")


def _record(piece: bytes) -> tuple | None:
    found = _header(piece)
    if not found or found[0] + found[1] > len(piece):
        return None
    head, content, fields = found
    text = [fields[f].decode("utf-8", "replace") if f in fields else None for f in FIELDS]
    return (*text, piece[head : head + content])


def _record_batch(keys: list[tuple], records: list[tuple]) -> pa.RecordBatch:
    rows = [k + r for k, r in zip(keys, records)]
    types = [pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 5, pa.binary()]
    names = ["file", "block", "n", *(c.split()[0] for c in RECORD.split(", "))]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


BATCH_BYTES = 8 << 20


def _whole_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records that lie in one piece."""
    keys, records, size = [], [], 0
    for _, file, block, n, piece in _numbered(batches):
        found = _record(piece)
        if found:
            keys.append((file, block, n))
            records.append(found)
            size += len(piece)
            if size >= BATCH_BYTES:
                yield _record_batch(keys, records)
                keys, records, size = [], [], 0
    if keys:
        yield _record_batch(keys, records)


def _raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    keys, size = [], 0
    types = (pa.string(), pa.int64(), pa.int64(), pa.binary())

    def made() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*keys), types)], names=["file", "block", "n", "piece"])

    for _, file, block, n, piece in _numbered(batches):
        keys.append((file, block, n, piece))
        size += len(piece)
        if size >= BATCH_BYTES:
            yield made()
            keys, size = [], 0
    if keys:
        yield made()


def _joined(table: pa.Table) -> pa.Table:
    """The pieces of one record, put together again."""
    rows = sorted(table.to_pylist(), key=lambda r: r["start"])
    found = _record(MAGIC.encode().join(r["piece"] for r in rows))
    batch = _record_batch([(rows[0]["file"], 0, rows[0]["offset"])], [found]) if found else None
    names = ["file", "n", *(c.split()[0] for c in RECORD.split(", "))]
    if batch is None:
        return pa.table({c: pa.array([], pa.int64() if c == "n" else pa.binary() if c == "payload" else pa.string()) for c in names})
    return pa.Table.from_batches([batch]).select(names)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per reachable record: file, type, ids, URI, stated digest and the payload's bytes.

    Every file must begin with a record; what cannot be reached from there is no record: magic inside
    payloads, records after a broken length, a record whose content ends beyond its file. Empty files have
    none.
    """
    offsets = durable(record_offsets(spark, path))
    whole = "record and head + content <= size"
    odd = durable(offsets.where(f"not ({whole})").select("file", "block", "n"))
    columns = ["file", *(c.split()[0] for c in RECORD.split(", "))]
    pieces = _pieces(spark, path)
    found = pieces.mapInArrow(_whole_records, "file string, block bigint, n bigint, " + RECORD)
    simple = found.join(_bounded(odd), ["file", "block", "n"], "left_anti").select(columns)
    parted = "record and head + content > size"
    if offsets.where(parted).isEmpty():
        return simple
    # Records do not overlap, so a piece can only belong to the last such record that begins at or before it.
    so_far = Window.partitionBy("file").orderBy("offset").rowsBetween(Window.unboundedPreceding, 0)
    begun = F.last(F.when(F.expr(parted), F.struct("offset", "next")), ignorenulls=True).over(so_far)
    parts = durable(
        offsets.withColumn("begun", begun).where("offset < begun.next")
        .select("file", "block", "n", F.col("offset").alias("start"), F.col("begun.offset").alias("offset"))
    )
    raw = pieces.mapInArrow(_raw, "file string, block bigint, n bigint, piece binary")
    held = raw.join(_bounded(parts), ["file", "block", "n"])
    whole_again = held.groupBy("file", "offset").applyInArrow(_joined, "file string, n bigint, " + RECORD)
    return simple.unionByName(whole_again.select(columns))


def pages_of(records: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of the records that write_archives makes.

    Bytes and digest are those of the payload read; a revisit has those of the response it refers to,
    and nulls if no such response can be reached.
    """
    number = lambda c: F.regexp_extract(c, "<urn:page:(-?[0-9]+)>", 1).try_cast("long")
    read = durable(
        records.select(
            number("record_id").alias("page_id"), "record_type", number("refers_to").alias("refers_to"),
            F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest"),
        )
    )
    own = read.where("record_type = 'response'")
    named = durable(read.where("record_type = 'revisit'").select("page_id", "refers_to"))
    target = durable(
        own.join(named.select(F.col("refers_to").alias("page_id")).distinct(), "page_id", "left_semi")
        .groupBy(F.col("page_id").alias("refers_to"))
        .agg(F.max("payload_bytes").alias("payload_bytes"), F.max("payload_digest").alias("payload_digest"))
    )
    again = named.join(target, "refers_to", "left").withColumn("record_type", F.lit("revisit"))
    return own.unionByName(again).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
