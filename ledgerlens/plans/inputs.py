"""Transactions and customer profiles derived from the given `events` and `customer` tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

def _padded(prefix: str, column: str, digits: int) -> str:
    """An id with leading zeros up to `digits`; longer numbers keep all their digits."""
    text = f"CAST({column} AS VARCHAR(20))"
    return f"concat('{prefix}', lpad({text}, CAST(greatest({digits}, length({text})) AS INT), '0'))"


# Column expressions valid in both engines; `k` is the number held in `props`.
TRANSACTION_COLUMNS = {
    "transaction_id": _padded("TXN_", "event_id", 12),
    "timestamp": "ts",
    "customer_id": _padded("CUST_", "user_id", 8),
    "amount": "value",
    "currency": "'USD'",
    "merchant_category": "event_type",
    "location_lat": "CAST(k * 1.8 - 90 AS DOUBLE)",
    "location_long": "CAST((event_id % 361) - 180 AS DOUBLE)",
    "device_type": "CASE k % 3 WHEN 0 THEN 'mobile' WHEN 1 THEN 'desktop' END",
    "transaction_type": (
        "CASE k % 4 WHEN 0 THEN 'online' WHEN 1 THEN 'pos' WHEN 2 THEN 'atm' ELSE 'card_not_present' END"
    ),
    "is_fraud": "CASE WHEN (value > 100 AND k % 2 = 0) OR k = 13 THEN 1 ELSE 0 END",
    "time_since_last": (
        "CASE WHEN k % 25 = 0 THEN NULL WHEN k % 10 = 0 THEN CAST(0 AS DOUBLE) "
        "ELSE CAST(event_id % 97 AS DOUBLE) / 8 - 2 END"
    ),
    "foreign_country": "CASE WHEN k % 20 = 0 THEN 1 ELSE 0 END",
    "multiple_quick_trans": "CASE WHEN k % 11 = 0 THEN 1 ELSE 0 END",
}

K = "CAST(regexp_extract(props, '([0-9]+)', 1) AS INT)"

PROFILE_COLUMNS = {
    "customer_id": _padded("CUST_", "c_custkey", 8),
    "home_lat": "CAST(c_nationkey * 7 - 84 AS DOUBLE)",
    "home_long": "CAST(c_nationkey * 14 - 168 AS DOUBLE)",
}


def _named(columns: dict[str, str]) -> list[str]:
    return [f"{expression} AS {name}" for name, expression in columns.items()]


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The transaction table over `events`; a pair of projections, so pruning and filters pass through."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.selectExpr("*", f"{K} AS k").selectExpr(*_named(TRANSACTION_COLUMNS))


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One home location per customer."""
    return spark.read.parquet(f"{sf_dir}/customer.parquet").selectExpr(*_named(PROFILE_COLUMNS))


TRANSACTIONS_SQL = (
    f"SELECT {', '.join(_named(TRANSACTION_COLUMNS))} FROM (SELECT *, {K} AS k FROM events) AS e"
)
PROFILES_SQL = f"SELECT {', '.join(_named(PROFILE_COLUMNS))} FROM customer"
