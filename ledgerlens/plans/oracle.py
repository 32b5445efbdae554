"""SQL with the same result as each registered query, over the given tables.

Fits of several features have no SQL form and are left to the tests; those of one have.
"""

from __future__ import annotations

from ledgerlens.operators.evaluate import FINE
from ledgerlens.plans.catalog import AWKWARD, DECIMALS, FIRST_DAY, FREE_SQL, HIGH, LAST_DAY
from ledgerlens.plans.inputs import PROFILES_SQL, TRANSACTIONS_SQL
from ledgerlens.schema import TRANSACTION_SCHEMA

NUMERIC = ["amount", "location_lat", "location_long", "is_fraud", "time_since_last"]
NUMERIC += ["foreign_country", "multiple_quick_trans"]
TYPES = {f.name: f.dataType.simpleString() for f in TRANSACTION_SCHEMA}
TEXT = [name for name, kind in TYPES.items() if kind == "string"]


def _tx(body: str, *tables: str) -> str:
    """`body` with the transaction view (t), the profile view (p) and further named tables in scope."""
    named = [f"t AS ({TRANSACTIONS_SQL})", f"p AS ({PROFILES_SQL})", *tables]
    return f"WITH {', '.join(named)} {body}"


def _per_column(columns: list[str], row: str, **fields: dict[str, str]) -> str:
    """UNION ALL of one aggregate row per column; `{c}` and further `{field}`s are filled in."""
    return " UNION ALL ".join(
        f"SELECT {row.format(c=c, **{name: of[c] for name, of in fields.items()})} FROM t" for c in columns
    )


def _moments(c: str = "{c}") -> str:
    return (
        f"ROUND(AVG({c}), {DECIMALS}) AS mean, ROUND(STDDEV_SAMP({c}), {DECIMALS}) AS stddev, "
        f"CAST(MIN({c}) AS DOUBLE) AS min, CAST(MAX({c}) AS DOUBLE) AS max, "
        + ", ".join(
            f"CASE WHEN ANY_VALUE(typeof({c})) <> 'DOUBLE' THEN CAST({f}({c}) AS VARCHAR) END AS exact_{f.lower()}"
            for f in ("MIN", "MAX")
        )
    )


DISTINCT = "CAST(COUNT(DISTINCT {c}) + MAX(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS \"distinct\""
MISSING = "CAST(COUNT(*) - COUNT({c}) AS BIGINT) AS missing"


def _histogram(column: str) -> str:
    return (
        f"b AS (SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM t), "
        f"h AS (SELECT CAST(LEAST(FLOOR(({column} - lo) / ((hi - lo) / 20)), 19) AS INTEGER) AS bin, "
        f"COUNT(*) AS n FROM t, b WHERE {column} IS NOT NULL GROUP BY 1), "
        "e AS (SELECT CAST(i AS INTEGER) AS bin, lo + i * ((hi - lo) / 20) AS low, "
        "CASE WHEN i = 19 THEN hi ELSE lo + (i + 1) * ((hi - lo) / 20) END AS high, COALESCE(n, 0) AS n "
        "FROM b, range(20) AS r(i) LEFT JOIN h ON h.bin = i)"
    )


def _rate_by(key: str, rate: str = "fraud_percent", tail: str = "") -> str:
    return (
        f"SELECT {key}, COUNT(*) AS total, CAST(SUM(is_fraud) AS BIGINT) AS fraud_count, "
        f"ROUND(SUM(is_fraud) / COUNT(*) * 100, 2) AS {rate} FROM t GROUP BY {key} {tail}"
    )


LABEL_STATS = (
    "SELECT is_fraud, COUNT(*) AS count, "
    f"ROUND(AVG(amount), {DECIMALS}) AS avg_amount, ROUND(STDDEV_SAMP(amount), {DECIMALS}) AS std_amount, "
    "MIN(amount) AS min_amount, MAX(amount) AS max_amount FROM t GROUP BY is_fraud"
)

SCORED = (
    "s AS (SELECT transaction_id, is_fraud, amount AS score, "
    f"CAST(CASE WHEN amount > {HIGH} THEN 1 ELSE 0 END AS DOUBLE) AS prediction FROM t)"
)
CELLS = (
    "c AS (SELECT COUNT(*) FILTER (prediction = 1 AND is_fraud = 1) AS tp, "
    "COUNT(*) FILTER (prediction = 1 AND is_fraud = 0) AS fp, "
    "COUNT(*) FILTER (prediction = 0 AND is_fraud = 1) AS fn, "
    "COUNT(*) FILTER (prediction = 0 AND is_fraud = 0) AS tn, COUNT(*) AS n FROM s)"
)
RATES = (
    "tp / (tp + fp) AS precision, tp / (tp + fn) AS recall, "
    "2 * ((tp / (tp + fp)) * (tp / (tp + fn))) / ((tp / (tp + fp)) + (tp / (tp + fn))) AS f1, "
    "(tp + tn) / n AS accuracy"
)
CURVE = (
    "g AS (SELECT score, SUM(is_fraud) AS pos, COUNT(*) - SUM(is_fraud) AS neg FROM s GROUP BY score), "
    "r AS (SELECT score, pos, neg, SUM(pos) OVER (ORDER BY score DESC) AS tp_at, "
    "SUM(neg) OVER (ORDER BY score DESC) AS fp_at, SUM(pos) OVER () AS pos_all, "
    "SUM(neg) OVER () AS neg_all FROM g)"
)
AUC = f"ROUND(SUM(neg * (tp_at - pos / 2)) / (MAX(pos_all) * MAX(neg_all)), {DECIMALS}) AS auc"
PR_AUC = (
    f"ROUND(SUM(pos * (tp_at / (tp_at + fp_at) + CASE WHEN tp_at + fp_at = pos + neg "
    "THEN tp_at / (tp_at + fp_at) ELSE (tp_at - pos) / (tp_at + fp_at - pos - neg) END) / 2) "
    f"/ MAX(pos_all), {DECIMALS}) AS pr_auc"
)

CALENDAR = (
    "CAST(hour(timestamp) AS INTEGER) AS hour_of_day, "
    "CAST(dayofweek(timestamp) + 1 AS INTEGER) AS day_of_week, CAST(month(timestamp) AS INTEGER) AS month"
)
ORIGIN_DISTANCE = "sqrt(location_lat * location_lat + location_long * location_long) AS distance_from_home"
VELOCITY = "CASE WHEN time_since_last <> 0 THEN 1.0 / time_since_last END AS txn_velocity"
OFF_HOURS = "CAST(CASE WHEN hour(timestamp) < 6 OR hour(timestamp) > 22 THEN 1 ELSE 0 END AS INTEGER) AS off_hours"
FILLED = "* REPLACE (COALESCE(device_type, 'unknown') AS device_type)"
COPIES = "SELECT * FROM t UNION ALL SELECT * FROM t WHERE amount > {high}".format(high=HIGH)


def _gap(customer: str) -> str:
    return (
        f"SELECT transaction_id, {customer} AS customer_id, (epoch_us(timestamp) - epoch_us(LAG(timestamp) "
        f"OVER (PARTITION BY {customer} ORDER BY timestamp, transaction_id))) / 3.6e9 AS time_since_last FROM t"
    )


def _bucket(buckets: int, salt: str = "") -> str:
    return f"CAST(concat('0x', substr(md5(concat('{salt}', transaction_id)), 1, 8)) AS BIGINT) % {buckets}"


def _index(column: str) -> str:
    """Position of each value by falling frequency, then by name; null comes after the last."""
    return (
        f"SELECT {column}, CASE WHEN {column} IS NULL THEN COUNT({column}) OVER () ELSE "
        f"ROW_NUMBER() OVER (ORDER BY {column} IS NULL, n DESC, {column}) - 1 END AS idx "
        f"FROM (SELECT {column}, COUNT(*) AS n FROM t GROUP BY {column})"
    )


DEVICE = f"d AS ({_index('device_type')})"
MERCHANT = f"m AS ({_index('merchant_category')})"
CUSTOMER = f"k AS ({_index('customer_id')})"
DEVICE_JOIN = "t JOIN d ON d.device_type IS NOT DISTINCT FROM t.device_type"
MERCHANT_JOIN = "JOIN m ON m.merchant_category IS NOT DISTINCT FROM t.merchant_category"
DEVICE_SLOTS = ", ".join(f"CASE WHEN d.idx = {i} THEN 1.0 ELSE 0.0 END::DOUBLE AS slot_{i}" for i in range(3))

TRAINED = f"{_bucket(100)} >= 20"
TWO = ["multiple_quick_trans", "foreign_country"]

# A fit of one feature with two values: the share of class 1 per value, classes weighing the same in total.
STUMP = [
    "g1 AS (SELECT multiple_quick_trans AS v, SUM(is_fraud) AS n1, COUNT(*) - SUM(is_fraud) AS n0 "
    f"FROM t WHERE {TRAINED} GROUP BY 1)",
    "q AS (SELECT v, n1 * all0 / (n1 * all0 + n0 * all1) AS score FROM "
    "(SELECT *, SUM(n1) OVER () AS all1, SUM(n0) OVER () AS all0 FROM g1))",
    "s AS (SELECT transaction_id, is_fraud, v, score, CASE WHEN score > 0.5 THEN 1.0 ELSE 0.0 END::DOUBLE "
    f"AS prediction FROM t JOIN q ON v = multiple_quick_trans WHERE NOT ({TRAINED}))",
]


def _one_feature(decimals: int) -> str:
    return (
        "SELECT transaction_id, is_fraud, concat('[', CAST(v AS DOUBLE), ']') AS slots, prediction, "
        f"ROUND(score, {decimals}) AS p_fraud FROM s"
    )


ORACLE: dict[str, str] = {
    "S1_csv_round_trip": _tx("SELECT * FROM t"),
    "S1_csv_inferred": _tx("SELECT * FROM p"),
    "S1_csv_inferred_transactions": _tx("SELECT * FROM t"),
    "S1_S4_days": _tx(
        f"SELECT * FROM t WHERE CAST(timestamp AS DATE) BETWEEN DATE '{FIRST_DAY}' AND DATE '{LAST_DAY}'"
    ),
    "S1_parquet_scan": f"SELECT event_id, value FROM events WHERE value > {HIGH}",
    "S1_parquet_whole": "SELECT * FROM events",
    "S1_csv_awkward_text": f"SELECT event_id, {AWKWARD} AS note, ts FROM events",
    "S2_registered_view": _tx("SELECT currency, COUNT(*) AS n FROM t GROUP BY currency"),
    "S3_preview": _tx("SELECT * FROM t ORDER BY transaction_id LIMIT 10"),
    "S4_export_result": _tx(_rate_by("customer_id", tail="ORDER BY fraud_percent DESC, customer_id")),
    "S5_export_predictions": _tx(
        "SELECT *, concat('[', CAST(foreign_country AS DOUBLE), ',', CAST(hour(timestamp) AS DOUBLE), ']') "
        f"AS features, CASE WHEN amount > {HIGH} THEN '[0.25,0.75]' ELSE '[0.75,0.25]' END AS probability, "
        f"CAST(CASE WHEN amount > {HIGH} THEN 1 ELSE 0 END AS DOUBLE) AS prediction, "
        f"CAST(CASE WHEN amount > {HIGH} THEN 0.75 ELSE 0.25 END AS DOUBLE) AS p_fraud FROM t"
    ),
    "C1_fill_missing": _tx("SELECT transaction_id, COALESCE(device_type, 'unknown') AS device_type FROM t"),
    "C2_parse_time": _tx(
        "SELECT transaction_id, TRY_CAST(CASE WHEN is_fraud = 1 THEN concat('at ', customer_id) "
        "ELSE CAST(timestamp AS VARCHAR) END AS TIMESTAMP) AS timestamp FROM t"
    ),
    "C3_drop_duplicates": _tx(f"SELECT DISTINCT * FROM ({COPIES})"),
    "C3_drop_duplicates_screened": _tx(f"SELECT DISTINCT * FROM ({COPIES})"),
    "C4_clean": _tx(f"SELECT DISTINCT {FILLED} FROM ({COPIES})"),
    "P1_row_count": _tx("SELECT COUNT(*) AS n_rows FROM t"),
    "P2_columns": _tx(
        _per_column(
            list(TYPES),
            "CAST({position} AS INTEGER) AS position, '{c}' AS \"column\", '{kind}' AS type, " + MISSING,
            position={c: str(i) for i, c in enumerate(TYPES)},
            kind=TYPES,
        )
    ),
    "P3_describe_numbers": _tx(
        _per_column(NUMERIC, "'{c}' AS \"column\", COUNT({c}) AS count, " + _moments())
    ),
    "P3_describe_text": _tx(
        _per_column(TEXT, "'{c}' AS \"column\", COUNT({c}) AS count, MIN({c}) AS min, MAX({c}) AS max")
    ),
    "P5_distinct": _tx(
        _per_column(["amount", "device_type", "customer_id", "time_since_last"], "'{c}' AS \"column\", " + DISTINCT)
    ),
    "P5_distinct_approx": _tx(
        _per_column(
            ["amount", "device_type", "customer_id", "time_since_last"], "'{c}' AS \"column\", TRUE AS near, " + DISTINCT
        )
    ),
    "P6_missing": _tx(_per_column(["amount", "device_type", "time_since_last"], "'{c}' AS \"column\", " + MISSING)),
    "P8_column_stats": _tx(_per_column(["amount", "time_since_last"], "'{c}' AS \"column\", " + _moments())),
    "P9_histogram": _tx("SELECT bin, low, high, n FROM e", _histogram("amount")),
    "P1_P8_ranges_from_footers": " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", COUNT(*) AS rows, CAST(MIN({c}) AS DOUBLE) AS min, CAST(MAX({c}) AS DOUBLE) AS max "
        "FROM events"
        for c in ("event_id", "user_id", "value")
    ),
    "P9_histogram_known_range": _tx("SELECT bin, low, high, n FROM e", _histogram("amount")),
    "P10_value_counts": _tx("SELECT device_type, COUNT(*) AS count FROM t GROUP BY device_type"),
    "P11_distribution_many_values": _tx(
        "SELECT 'histogram' AS kind, bin, low, high, CAST(NULL AS DOUBLE) AS value, n FROM e",
        _histogram("time_since_last"),
    ),
    "P11_distribution_few_values": _tx(
        "SELECT 'value_counts' AS kind, CAST(NULL AS INTEGER) AS bin, CAST(NULL AS DOUBLE) AS low, "
        "CAST(NULL AS DOUBLE) AS high, foreign_country AS value, COUNT(*) AS n FROM t GROUP BY foreign_country"
    ),
    "P12_column_profile": _tx(
        _per_column(
            NUMERIC, "'{c}' AS \"column\", '{kind}' AS type, " + f"{DISTINCT}, {MISSING}, {_moments()}", kind=TYPES
        )
    ),
    "P12_profile_merged_from_days": _tx(
        _per_column(
            NUMERIC,
            f"'{{c}}' AS \"column\", COUNT({{c}}) AS count, {MISSING}, ROUND(AVG({{c}}), {DECIMALS}) AS mean, "
            f"ROUND(STDDEV_SAMP({{c}}), {DECIMALS}) AS stddev, CAST(MIN({{c}}) AS DOUBLE) AS min, "
            f"CAST(MAX({{c}}) AS DOUBLE) AS max, TRUE AS near, {DISTINCT}",
        )
    ),
    "A1_label_statistics": _tx(LABEL_STATS),
    "A2_fraud_rate_by_merchant": _tx(
        _rate_by("merchant_category", tail="ORDER BY fraud_percent DESC, merchant_category LIMIT 10")
    ),
    "A3_fraud_rate_by_device": _tx(_rate_by("device_type")),
    "A4_explore": _tx(
        "SELECT 'fraud_stats' AS report, CAST(is_fraud AS VARCHAR) AS value, count AS total, "
        "CAST(NULL AS BIGINT) AS fraud_count, CAST(NULL AS DOUBLE) AS fraud_percent, "
        f"avg_amount, std_amount, min_amount, max_amount FROM ({LABEL_STATS}) "
        "UNION ALL SELECT 'merchant_stats', merchant_category, total, fraud_count, fraud_percent, "
        f"NULL, NULL, NULL, NULL FROM ({_rate_by('merchant_category')} "
        "ORDER BY fraud_percent DESC, merchant_category LIMIT 10) "
        "UNION ALL SELECT 'device_stats', device_type, total, fraud_count, fraud_percent, "
        f"NULL, NULL, NULL, NULL FROM ({_rate_by('device_type')})"
    ),
    "A5_fraud_by_category": _tx(
        "SELECT merchant_category, COUNT(*) AS total, CAST(SUM(is_fraud) AS BIGINT) AS fraud_count, "
        "CAST(ROUND(100.0 * SUM(is_fraud) / COUNT(*), 2) AS DOUBLE) AS fraud_percentage "
        "FROM t GROUP BY merchant_category"
    ),
    "A6_recent_high_value": _tx(
        f"SELECT * FROM t WHERE amount > {HIGH} ORDER BY timestamp DESC, transaction_id LIMIT 50"
    ),
    "A7_default_listing": _tx("SELECT * FROM t ORDER BY transaction_id LIMIT 10"),
    "A8_free_sql": _tx(
        "SELECT customer_id, home_lat, n, largest, CAST(frauds AS BIGINT) AS frauds "
        f"FROM ({FREE_SQL}) ORDER BY n DESC, customer_id",
        "transactions AS (SELECT * FROM t)",
        "profiles AS (SELECT * FROM p)",
    ),
    "F1_F3_calendar": _tx(f"SELECT transaction_id, {CALENDAR} FROM t"),
    "F4_distance_from_home": _tx(
        "SELECT transaction_id, sqrt(pow(location_lat - home_lat, 2) + pow(location_long - home_long, 2)) "
        "AS distance_from_home FROM t LEFT JOIN p ON p.customer_id = t.customer_id"
    ),
    "F5_distance_from_origin": _tx(f"SELECT transaction_id, {ORIGIN_DISTANCE} FROM t"),
    "F6_velocity": _tx(f"SELECT transaction_id, {VELOCITY} FROM t"),
    "F7_F8_off_hours": _tx(f"SELECT transaction_id, {OFF_HOURS} FROM t"),
    "F9_features": _tx(
        f"SELECT DISTINCT {FILLED}, {CALENDAR}, {ORIGIN_DISTANCE}, {VELOCITY}, {OFF_HOURS} FROM t"
    ),
    "R1_time_since_previous": _tx(_gap("customer_id")),
    "R1_time_since_previous_loads": _tx(_gap("customer_id")),
    "R1_time_since_previous_hot_customer": _tx(
        _gap("CASE WHEN CAST(substr(customer_id, 6) AS BIGINT) % 3 = 0 THEN 'CUST_HOT' ELSE customer_id END")
    ),
    "R2_attach_home": _tx(
        "SELECT transaction_id, t.customer_id, home_lat, home_long FROM t "
        "LEFT JOIN p ON p.customer_id = t.customer_id"
    ),
    "M1_hash_split": _tx(
        f"SELECT transaction_id, CASE WHEN {_bucket(100)} >= 20 THEN 'train' ELSE 'test' END AS part FROM t"
    ),
    "M2_feature_roles": _tx(
        "SELECT 'merchant_category' AS feature, 'categorical' AS role, COUNT(merchant_category) AS filled FROM t "
        + "".join(
            f"UNION ALL SELECT '{f}', 'numeric', COUNT({value}) FROM v "
            for f, value in {
                "amount": "amount",
                "distance_from_home": "distance_from_home",
                "hour_of_day": "hour(timestamp)",
                "txn_velocity": "txn_velocity",
                "abroad": "foreign_country",
            }.items()
        ),
        f"v AS (SELECT *, {ORIGIN_DISTANCE}, {VELOCITY} FROM t)",
    ),
    "M6_feature_vector_gaps": _tx(
        "SELECT transaction_id, amount AS slot_0, COALESCE(txn_velocity, (SELECT quantile_disc(txn_velocity, 0.5) FROM v)) "
        "AS slot_1 FROM v",
        f"v AS (SELECT *, {VELOCITY} FROM t)",
    ),
    "M3_class_weights": _tx(
        "SELECT transaction_id, is_fraud, CASE WHEN is_fraud = 1 THEN n0 / n ELSE n1 / n END AS class_weight "
        "FROM t, w",
        "w AS (SELECT COUNT(*) FILTER (is_fraud = 1) AS n1, COUNT(*) FILTER (is_fraud = 0) AS n0, "
        "COUNT(*) AS n FROM t)",
    ),
    "M4_string_index": _tx(
        "SELECT transaction_id, CAST(d.idx AS DOUBLE) AS device_type_index, "
        f"CAST(m.idx AS DOUBLE) AS merchant_category_index FROM {DEVICE_JOIN} {MERCHANT_JOIN}",
        DEVICE,
        MERCHANT,
    ),
    "M4_joined_index": _tx(
        "SELECT transaction_id, CAST(d.idx AS DOUBLE) AS device_type_index, CAST(m.idx AS DOUBLE) AS "
        f"merchant_category_index, CAST(k.idx AS DOUBLE) AS customer_id_index FROM {DEVICE_JOIN} {MERCHANT_JOIN} "
        "JOIN k ON k.customer_id IS NOT DISTINCT FROM t.customer_id",
        DEVICE,
        MERCHANT,
        CUSTOMER,
    ),
    "M5_joined_one_hot": _tx(f"SELECT transaction_id, {DEVICE_SLOTS} FROM {DEVICE_JOIN}", DEVICE),
    "M6_medians": _tx(
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", CAST(quantile_disc({c}, 0.5) AS DOUBLE) AS median FROM v"
            for c in ("amount", "time_since_last", "txn_velocity", "distance_from_home")
        ),
        f"v AS (SELECT *, {VELOCITY}, {ORIGIN_DISTANCE} FROM t)",
    ),
    "M5_one_hot": _tx(f"SELECT transaction_id, {DEVICE_SLOTS} FROM {DEVICE_JOIN}", DEVICE),
    "M6_M7_feature_vector": _tx(
        f"SELECT transaction_id, {DEVICE_SLOTS}, amount AS slot_3, CAST(hour(timestamp) AS DOUBLE) AS slot_4 "
        f"FROM {DEVICE_JOIN}",
        DEVICE,
    ),
    "M8_logistic_regression_one_feature": _tx(_one_feature(4), *STUMP),
    "M9_decision_tree_one_feature": _tx(_one_feature(DECIMALS), *STUMP),
    "M10_E2_random_forest_one_feature": _tx(_one_feature(DECIMALS), *STUMP),
    "M11_M12_train_evaluate_one_feature": _tx(
        f"SELECT auc, pr_auc, {RATES}, tp, fp, fn, tn FROM c, (SELECT {AUC}, {PR_AUC} FROM r)", *STUMP, CELLS, CURVE
    ),
    "M13_feature_importance_two_features": _tx(
        "SELECT f AS feature, f AS source, CASE WHEN left_over = MIN(left_over) OVER () THEN 1.0 ELSE 0.0 END::DOUBLE "
        "AS importance FROM (SELECT f, SUM(2 * a * b / (a + b)) AS left_over FROM (SELECT f, "
        "SUM(is_fraud) * z AS a, (COUNT(*) - SUM(is_fraud)) * o AS b FROM u, w GROUP BY f, v, z, o) GROUP BY f)",
        "u AS (" + " UNION ALL ".join(f"SELECT '{f}' AS f, {f} AS v, is_fraud FROM t WHERE {TRAINED}" for f in TWO) + ")",
        f"w AS (SELECT SUM(is_fraud) AS o, COUNT(*) - SUM(is_fraud) AS z FROM t WHERE {TRAINED})",
    ),
    "E1_hash_sample": _tx(f"SELECT * FROM s WHERE {_bucket(FINE, 'sample')} < {FINE // 10}", SCORED),
    "E3_area_under_roc": _tx(f"SELECT {AUC} FROM r", SCORED, CURVE),
    "E4_area_under_pr": _tx(f"SELECT {PR_AUC} FROM r", SCORED, CURVE),
    "E3_E4_areas_of_bins": _tx(f"SELECT {AUC}, {PR_AUC}, TRUE AS auc_near, TRUE AS pr_auc_near FROM r", SCORED, CURVE),
    "E8_evaluate_bins": _tx(f"SELECT {RATES}, tp, fp, fn, tn, TRUE AS narrow FROM c", SCORED, CELLS),
    "E11_roc_curve_of_bins": _tx(
        "SELECT TRUE AS on_the_curve, TRUE AS enough, MAX(tp_at / pos_all) AS tpr, MAX(fp_at / neg_all) AS fpr FROM r",
        SCORED,
        CURVE,
    ),
    "E5_confusion": _tx("SELECT tp, fp, fn, tn FROM c", SCORED, CELLS),
    "E6_E7_rates": _tx(f"SELECT {RATES} FROM c", SCORED, CELLS),
    "E8_evaluate": _tx(
        f"SELECT auc, pr_auc, {RATES}, tp, fp, fn, tn FROM c, (SELECT {AUC}, {PR_AUC} FROM r)",
        SCORED,
        CELLS,
        CURVE,
    ),
    "E9_sample_predictions": _tx(
        f"SELECT is_fraud, CAST(CASE WHEN amount > {HIGH} THEN 1 ELSE 0 END AS DOUBLE) AS prediction, "
        f"amount / 1000 AS probability, amount, {ORIGIN_DISTANCE}, "
        "CAST(hour(timestamp) AS INTEGER) AS hour_of_day FROM t ORDER BY transaction_id LIMIT 100"
    ),
    "E10_prediction_distribution": _tx(
        "SELECT prediction, COUNT(*) AS n, ROUND(100 * COUNT(*) / SUM(COUNT(*)) OVER (), 1) AS percent, "
        "CAST(SUM(COUNT(*)) OVER () AS BIGINT) AS total, "
        "CAST(SUM(SUM(prediction)) OVER () AS BIGINT) AS positive FROM s GROUP BY prediction",
        SCORED,
    ),
    "E11_roc_curve": _tx(
        "SELECT 'infinity'::DOUBLE AS threshold, 0.0::DOUBLE AS tpr, 0.0::DOUBLE AS fpr "
        "UNION ALL SELECT score, tp_at / pos_all, fp_at / neg_all FROM r",
        SCORED,
        CURVE,
    ),
    "E12_confusion_matrix": _tx(
        "SELECT 0 AS actual, tn AS predicted_0, fp AS predicted_1 FROM c UNION ALL SELECT 1, fn, tp FROM c",
        SCORED,
        CELLS,
    ),
    "E12_confusion_table": _tx(
        "SELECT 'True Negative' AS type, tn AS count FROM c UNION ALL SELECT 'False Positive', fp FROM c "
        "UNION ALL SELECT 'False Negative', fn FROM c UNION ALL SELECT 'True Positive', tp FROM c",
        SCORED,
        CELLS,
    ),
}
