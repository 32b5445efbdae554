"""One registered query per operator, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import (
    bpe,
    chunks,
    decontaminate,
    fill_middle,
    fingerprint,
    jaccard,
    langid,
    licences,
    near_copies,
    quality,
    sharding,
    vector_codes,
    warc,
)
from ledgerlens.scratch import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, where SQL can express it, the SQL it is checked against."""

    def add(function: Query) -> Query:
        QUERIES[name] = function
        if sql:
            ORACLE[name] = sql
        return function

    return add


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def vocabulary_path() -> str:
    """The public byte-level vocabulary installed with Python."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query("op4_bpe")
def op4_bpe(spark, sf_dir):
    return bpe.encode_documents(
        documents(spark, sf_dir),
        vocabulary_path(),
        outputs=("n_tokens", "ids_sha256", "decoded_sha256"),
    )


@query("op5_fingerprints")
def op5_fingerprints(spark, sf_dir):
    return fingerprint.fingerprints(documents(spark, sf_dir))


@query("op6_sharding")
def op6_sharding(spark, sf_dir):
    found = sharding.shard_documents(documents(spark, sf_dir))
    return found.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "n_copies",
    )


@query("op10_quality")
def op10_quality(spark, sf_dir):
    return quality.score_documents(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def _links_sql(words: int, percent: int) -> str:
    """Sets of word shingles, all linked pairs, and the smallest id that each document reaches."""
    return rf"""
    WITH RECURSIVE split AS (
        SELECT doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'
        ) AS w
        FROM documents
    ), sets AS (
        SELECT doc_id, CASE
            WHEN len(w) = 0 THEN CAST([] AS VARCHAR[])
            WHEN len(w) < {words} THEN [array_to_string(w, ' ')]
            ELSE list_distinct(list_transform(range(1, len(w) - {words - 2}), lambda i: array_to_string(w[i:i + {words - 1}], ' ')))
        END AS shingles
        FROM split
    ), members AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM sets),
    links AS (
        SELECT a.doc_id AS x, b.doc_id AS y
        FROM members a JOIN members b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
        GROUP BY a.doc_id, b.doc_id, a.n, b.n
        HAVING 100 * count(*) >= {percent} * (a.n + b.n - count(*))
    ), reached AS (
        SELECT doc_id, doc_id AS other FROM sets
        UNION
        SELECT r.doc_id, l.y FROM reached r JOIN links l ON l.x = r.other
    )
    SELECT s.doc_id, CAST(len(s.shingles) AS BIGINT) AS n_shingles, m.component_id
    FROM sets s JOIN (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id) m ON m.doc_id = s.doc_id
"""


@query("op3_jaccard", _links_sql(5, 75))
def op3_jaccard(spark, sf_dir):
    return jaccard.similarity_components(documents(spark, sf_dir))


@query("op7_decontaminate")
def op7_decontaminate(spark, sf_dir):
    return decontaminate.contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@query("op8_substrings")
def op8_substrings(spark, sf_dir):
    return chunks.drop_repeated_substrings(documents(spark, sf_dir))


OP1_SQL = """
    WITH facts AS (
        SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
        FROM pages
    ), firsts AS (SELECT payload_digest, max(page_id) AS first FROM facts WHERE payload_bytes >= 1000 GROUP BY 1)
    SELECT f.page_id, f.payload_bytes, f.payload_digest,
           CASE WHEN f.page_id <> g.first THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN f.page_id <> g.first THEN g.first END AS refers_to
    FROM facts f LEFT JOIN firsts g ON f.payload_digest = g.payload_digest AND f.payload_bytes >= 1000
"""


@query("op1_warc", OP1_SQL)
def op1_warc(spark, sf_dir):
    path = scratch_path(spark, "archives")
    warc.write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    return warc.pages_of(warc.read_archives(spark, path))


@query("op2_langid")
def op2_langid(spark, sf_dir):
    return langid.identify(spark.read.parquet(f"{sf_dir}/pages.parquet"), documents(spark, sf_dir))


@query("op9_licences")
def op9_licences(spark, sf_dir):
    return licences.scan(documents(spark, sf_dir))


def _codes_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """All rounds written out: distances to every entry, the nearest one, and the floor of the means."""
    near = """
        n{i} AS MATERIALIZED (
            SELECT row, part, min(distance) AS distance, arg_min(entry, distance * {k} + entry) AS entry FROM (
                SELECT v.row, v.part, b.entry, sum((v.x - b.x) * (v.x - b.x)) AS distance
                FROM v JOIN b{i} b ON b.part = v.part AND b.pos = v.pos GROUP BY ALL
            ) GROUP BY row, part
        )"""
    move = """
        b{j} AS MATERIALIZED (
            SELECT b.part, b.entry, b.pos, coalesce(m.x, b.x) AS x FROM b{i} b LEFT JOIN (
                SELECT n.part, n.entry, v.pos, CAST(floor(CAST(sum(v.x) AS DOUBLE) / count(*)) AS BIGINT) AS x
                FROM n{i} n JOIN v ON v.row = n.row AND v.part = n.part GROUP BY ALL
            ) m ON m.part = b.part AND m.entry = b.entry AND m.pos = b.pos
        )"""
    chain = [near.format(i=0, k=entries)]
    for i in range(rounds):
        chain += [move.format(i=i, j=i + 1), near.format(i=i + 1, k=entries)]
    return f"""
        WITH kept AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY vec_id) - 1 AS row, vec_id, label,
                   list_transform(embedding, lambda e: CAST(floor(4096 * CAST(e AS DOUBLE)) AS BIGINT)) AS whole
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
        ), v AS MATERIALIZED (
            SELECT row, CAST(i * {parts} // len(whole) AS INTEGER) AS part, i % (len(whole) // {parts}) AS pos, whole[i + 1] AS x
            FROM kept, range(0, len(whole)) AS r(i)
        ), b0 AS MATERIALIZED (SELECT part, CAST(row AS INTEGER) AS entry, pos, x FROM v WHERE row < {entries}),
        {", ".join(chain)},
        codes AS (
            SELECT row, string_agg(lower(lpad(to_hex(entry), 2, '0')), '' ORDER BY part) AS code,
                   CAST(sum(distance) AS BIGINT) AS error
            FROM n{rounds} GROUP BY row
        ), books AS (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, pos)) AS sha FROM b{rounds})
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
               books.sha AS codebooks_sha256
        FROM kept JOIN codes ON codes.row = kept.row, books
    """


@query("op11_vector_codes", _codes_sql())
def op11_vector_codes(spark, sf_dir):
    codes, books = vector_codes.compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    digits = F.transform("entries", lambda e: F.lower(F.lpad(F.hex(e), 2, "0")))
    return codes.select(
        "vec_id",
        F.array_join(digits, "").alias("code"),
        "error",
        "label_error",
        F.lit(books.sha256()).alias("codebooks_sha256"),
    )


@query("op12_near_copies", f"SELECT *, doc_id = component_id AS kept FROM ({_links_sql(4, 80)})")
def op12_near_copies(spark, sf_dir):
    return near_copies.near_duplicates(documents(spark, sf_dir))


OP13_SQL = """
    WITH d AS (
        SELECT doc_id, coalesce(text, '') AS text,
               sha256(concat('1:', coalesce(CAST(doc_id AS VARCHAR), ''))) AS h
        FROM documents
    ), u AS (
        SELECT doc_id, text, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS w,
               CAST(concat('0x', h[1:8]) AS BIGINT) AS h1, CAST(concat('0x', h[9:16]) AS BIGINT) AS h2,
               CAST(concat('0x', h[17:24]) AS BIGINT) AS h3, CAST(concat('0x', h[25:32]) AS BIGINT) AS h4
        FROM d
    ), c AS (
        SELECT *, least(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS a, greatest(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS b,
               CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                         OR h3 % 100 >= 90 THEN 'plain'
                    WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
        FROM u
    ), p AS (
        SELECT *, array_to_string(w[1:a], '') AS prefix, array_to_string(w[a + 1:b], '') AS middle,
               array_to_string(w[b + 1:], '') AS suffix
        FROM c
    )
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n, form,
           CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
           CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
           sha256(CASE form WHEN 'psm' THEN concat('<P>', prefix, '<S>', suffix, '<M>', middle)
                            WHEN 'spm' THEN concat('<S>', suffix, '<P>', prefix, '<M>', middle) ELSE text END) AS output_sha256,
           sha256(text) AS restored_sha256
    FROM p
"""


@query("op13_fill_middle", OP13_SQL)
def op13_fill_middle(spark, sf_dir):
    rows = fill_middle.transform(documents(spark, sf_dir))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return rows.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        digest(F.col("output")).alias("output_sha256"),
        digest(fill_middle.restored()).alias("restored_sha256"),
    )
