"""Reproducible pseudo-random buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_bucket(key: Column, buckets: int = 100, salt: str = "") -> Column:
    """Bucket 0..buckets-1 taken from the first 32 bits of md5(salt + key).

    It depends on the key alone, so the same row falls in the same bucket whatever the partitioning,
    the retry or the engine. A null key counts as the empty string, so no row is without a bucket.
    """
    text = F.concat(F.lit(salt), F.coalesce(key.cast("string"), F.lit("")))
    head = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return (head % buckets).cast("int")
