"""The training-data pipeline over `documents`: five stages, each an operator whose decisions take effect.

Ids are taken to be distinct where they are not null; rows without one are told apart by their text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import bpe, chunks, decontaminate, jaccard, quality
from ledgerlens.llm.queries import vocabulary_path
from ledgerlens.scratch import durable

# Ids (8 bytes each) that are broadcast at most; beyond, documents and ids are shuffled.
BROADCAST_IDS = 1_000_000


def _unused(docs: DataFrame, name: str) -> str:
    """A column name that `docs` does not have."""
    while name in docs.columns:
        name += "_"
    return name


def _without(docs: DataFrame, key, ids: DataFrame) -> DataFrame:
    """The rows of `docs` whose key is not among `ids` (key)."""
    ids = durable(ids.distinct())
    few = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    own = _unused(docs, "__key")
    return docs.withColumn(own, key).join(few.withColumnRenamed("key", own), own, "left_anti").select(*docs.columns)


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id; documents without words all stay."""
    by_text = F.xxhash64("text").bitwiseAND(F.lit((1 << 62) - 1)) + F.lit(1 << 62)
    key = F.coalesce("doc_id", by_text)
    found = durable(jaccard.similarity_components(docs.select(key.alias("doc_id"), "text")))
    left = _without(docs, key, found.where("doc_id <> component_id").select(F.col("doc_id").alias("key")))
    if found.groupBy("doc_id").count().where("count > 1").isEmpty():
        return left
    own, mark = _unused(docs, "__key"), _unused(docs, "__mark")
    repeated = left.withColumns({own: key, mark: F.xxhash64("text")})
    return repeated.dropDuplicates([own, mark]).select(*docs.columns)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that an earlier document has; documents of which nothing is left go."""
    others = tuple(c for c in docs.columns if c != "text")
    cut = chunks.drop_repeated_substrings(docs, keep=others)
    left = cut.where((F.col("cut_bytes") == 0) | (F.trim("text") != ""))
    length = F.when(F.col("cut_bytes") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return left.withColumn("n_chars", length).select(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no copy of a benchmark item."""
    key = F.xxhash64("doc_id", "text")
    found = decontaminate.contaminated(
        docs.select(key.alias("doc_id"), "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    )
    return _without(docs, key, found.select(F.col("doc_id").alias("key")))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token ids, and whether these decode to the text."""
    return bpe.encode_documents(
        docs, vocabulary_path(), keep=tuple(docs.columns), outputs=("token_ids", "n_tokens", "round_trip")
    )


STAGES = [
    ("quality", good_documents),
    ("near duplicates", one_of_each),
    ("substrings", without_repeats),
    ("decontamination", without_benchmark),
    ("tokens", tokens),
]

# Trained scores, rolling hashes and merges are beyond SQL. tests/llm compares near duplicates with brute force here and
# repeated passages, decontamination and tokens by their operators' own tests; the quality stage is only run.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written out and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = durable(docs)
    return docs
