"""Data model: payload, envelope, lake layers and warehouse tables.

Lake layers (bronze / silver / fraud parquet) keep money as DOUBLE exactly as
the payload carries it; warehouse tables follow their DDL (DECIMAL money,
SMALLINT hour, defaults) and are produced by `sources.tables.conform`.
Aggregates sum money exactly as DECIMAL and report it as DOUBLE.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's (domain vocabularies, cut
# points, tokens).  Kept together, in their natural order.
# ---------------------------------------------------------------------------
# merchant (name, category) pairs of the event simulator, in order
MERCHANTS = [
    ("Amazon", "retail"),
    ("Walmart", "retail"),
    ("Netflix", "subscription"),
    ("Uber", "transport"),
    ("Delta Airlines", "travel"),
    ("Walgreens", "pharmacy"),
    ("McDonald's", "food"),
    ("Apple Store", "electronics"),
    ("Shell Gas", "fuel"),
    ("Marriott Hotel", "hotel"),
]
# high-risk IP countries used by the rule and twin generators, in order
RISKY_COUNTRIES = ["RU", "NG", "CN", "UA", "PK"]
DEVICES = ["mobile", "desktop", "tablet"]
FRAUD_TYPES = ["large_amount", "foreign_ip", "rapid_fire"]
# amount buckets: lower bound inclusive, upper bound exclusive
AMOUNT_BUCKETS = [(10, "micro"), (100, "small"), (500, "medium"), (2000, "large")]
AMOUNT_BUCKET_TOP = "very_large"
# rule names in the order they are listed in fraud_reason, joined by ", "
REASON_TOKENS = ["velocity", "amount_spike", "foreign_ip"]
REASON_SEPARATOR = ", "
# rule defaults
VELOCITY_WINDOW_MINUTES = 10
VELOCITY_MAX_TXNS = 5
SPIKE_MULTIPLIER = 3.0
ALERT_MINUTES = 15
DAILY_DAYS = 30
CATEGORY_DAYS = 7
TOP_K = 20
HIGH_RISK_MIN_FLAGS = 2
# layer tags
BRONZE, SILVER = "bronze", "silver"

# ---------------------------------------------------------------------------
# Payload and envelope
# ---------------------------------------------------------------------------
S, D, B = T.StringType(), T.DoubleType(), T.BooleanType()
TS, DT = T.TimestampType(), T.DateType()

# The payload's columns.
PAYMENT_FIELDS = [
    ("transaction_id", S), ("user_id", S), ("amount", D), ("currency", S),
    ("merchant_name", S), ("merchant_category", S), ("user_country", S),
    ("ip_country", S), ("device", S), ("timestamp", S), ("is_fraud", B),
    ("fraud_type", S),
]
PAYMENT_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in PAYMENT_FIELDS])

# unlabelled rule events: payload without labels, plus the user's avg spend
RULE_EVENT_SCHEMA = T.StructType(
    [T.StructField(n, t, True) for n, t in PAYMENT_FIELDS if n not in ("is_fraud", "fraud_type")]
    + [T.StructField("avg_spend", D, True)])

ENVELOPE_SCHEMA = T.StructType([
    T.StructField("data", T.BinaryType(), True),
    T.StructField("approximateArrivalTimestamp", TS, True),
    T.StructField("shardId", S, True),
])
# on-disk landing form of the envelope (JSON lines; data kept as text)
ENVELOPE_FILE_SCHEMA = T.StructType([
    T.StructField("data", S, True),
    T.StructField("approximateArrivalTimestamp", TS, True),
    T.StructField("shardId", S, True),
])

BRONZE_COLUMNS = [n for n, _ in PAYMENT_FIELDS] + [
    "kinesis_arrival_time", "shard_id", "event_timestamp", "ingestion_layer", "event_date"]
BRONZE_SCHEMA = T.StructType(
    list(PAYMENT_SCHEMA.fields) + [
        T.StructField("kinesis_arrival_time", TS, True),
        T.StructField("shard_id", S, True),
        T.StructField("event_timestamp", TS, True),
        T.StructField("ingestion_layer", S, True),
        T.StructField("event_date", DT, True),
    ])

SILVER_SCHEMA = T.StructType(
    list(BRONZE_SCHEMA.fields) + [
        T.StructField("country_mismatch", B, True),
        T.StructField("amount_bucket", S, True),
        T.StructField("event_hour", T.IntegerType(), True),
    ])

BRONZE_PARTITIONS = ("event_date",)
SILVER_PARTITIONS = ("event_date", "event_hour")
FRAUD_PARTITIONS = ("event_date", "fraud_type")


def layer_schema(schema: T.StructType, partitions) -> T.StructType:
    """Read schema of a partitioned layer folder: data columns, then the
    partition columns in partition order — the order in which a file source
    returns them, so positions and names agree whenever partitions are
    discovered (a stream started on a still-empty folder included)."""
    by_name = {f.name: f for f in schema.fields}
    return T.StructType([f for f in schema.fields if f.name not in partitions]
                        + [by_name[p] for p in partitions])


# text of a message that the parser could not read in full; null for all others
RAW_MESSAGE = "raw_message"
BRONZE_LAYER_SCHEMA = layer_schema(T.StructType([*BRONZE_SCHEMA.fields, T.StructField(RAW_MESSAGE, S, True)]), BRONZE_PARTITIONS)
SILVER_LAYER_SCHEMA = layer_schema(SILVER_SCHEMA, SILVER_PARTITIONS)
FRAUD_LAYER_SCHEMA = layer_schema(SILVER_SCHEMA, FRAUD_PARTITIONS)

# ---------------------------------------------------------------------------
# The warehouse tables' columns: (name, type, nullable, default-SQL-or-None)
# default "NOW" = load time (as_of)
# ---------------------------------------------------------------------------
NOW = "NOW"


def dec(p, s):
    return T.DecimalType(p, s)


WAREHOUSE = {
    "bronze.payment_events_raw": [
        ("transaction_id", S, False, None), ("user_id", S, False, None),
        ("amount", dec(12, 2), False, None), ("currency", S, True, "USD"),
        ("merchant_name", S, True, None), ("merchant_category", S, True, None),
        ("user_country", S, True, None), ("ip_country", S, True, None),
        ("device", S, True, None), ("timestamp", S, True, None),
        ("is_fraud", B, True, None), ("fraud_type", S, True, None),
        ("ingestion_layer", S, True, BRONZE), ("ingested_at", TS, True, NOW),
    ],
    "silver.payment_events_clean": [
        ("transaction_id", S, False, None), ("user_id", S, False, None),
        ("amount", dec(12, 2), False, None), ("currency", S, True, "USD"),
        ("merchant_name", S, True, None), ("merchant_category", S, True, None),
        ("user_country", S, True, None), ("ip_country", S, True, None),
        ("device", S, True, None), ("event_timestamp", TS, True, None),
        ("event_date", DT, True, None), ("event_hour", T.ShortType(), True, None),
        ("country_mismatch", B, True, False), ("amount_bucket", S, True, None),
        ("is_fraud", B, True, False), ("fraud_type", S, True, None),
        ("ingestion_layer", S, True, SILVER), ("ingested_at", TS, True, NOW),
    ],
    "fraud.flagged_transactions": [
        ("transaction_id", S, False, None), ("user_id", S, False, None),
        ("amount", dec(12, 2), False, None), ("merchant_name", S, True, None),
        ("merchant_category", S, True, None), ("user_country", S, True, None),
        ("ip_country", S, True, None), ("device", S, True, None),
        ("event_timestamp", TS, True, None), ("event_date", DT, True, None),
        ("country_mismatch", B, True, None), ("amount_bucket", S, True, None),
        ("fraud_type", S, True, None), ("flag_velocity", B, True, False),
        ("flag_spike", B, True, False), ("flag_geography", B, True, False),
        ("fraud_reason", S, True, None), ("flagged_at", TS, True, NOW),
    ],
    "silver.user_profiles": [
        ("user_id", S, False, None), ("avg_transaction", dec(12, 2), True, None),
        ("total_transactions", T.IntegerType(), True, 0),
        ("total_spend", dec(15, 2), True, 0), ("first_seen", DT, True, None),
        ("last_seen", DT, True, None), ("home_country", S, True, None),
        ("risk_score", dec(5, 2), True, 0.0), ("updated_at", TS, True, NOW),
    ],
    "silver.merchant_summary": [
        ("merchant_name", S, False, None), ("merchant_category", S, True, None),
        ("total_transactions", T.IntegerType(), True, 0),
        ("total_volume", dec(15, 2), True, 0), ("fraud_count", T.IntegerType(), True, 0),
        ("fraud_rate", dec(5, 2), True, 0.0), ("avg_transaction", dec(12, 2), True, 0),
        ("summary_date", DT, True, None), ("updated_at", TS, True, NOW),
    ],
}

# physical layout of each warehouse table: hash key, sort keys, partition cols
LAYOUT = {
    "bronze.payment_events_raw": {"distribute": None, "sort": ["transaction_id"], "partition": []},
    "silver.payment_events_clean": {"distribute": "user_id", "sort": ["event_date", "event_timestamp"],
                                    "partition": ["event_date"]},
    "fraud.flagged_transactions": {"distribute": "user_id", "sort": ["event_date", "fraud_type"],
                                   "partition": ["event_date"]},
    "silver.user_profiles": {"distribute": "user_id", "sort": ["user_id"], "partition": []},
    "silver.merchant_summary": {"distribute": None, "sort": ["summary_date", "merchant_name"],
                                "partition": ["summary_date"], "replicate": True},
}


def contract(table: str) -> str:
    """The warehouse table whose columns and layout a catalog table has: a
    database may carry a prefix that ends in `__` (`trial__silver.user_profiles`)."""
    db, _, name = table.rpartition(".")
    return f"{db.rsplit('__', 1)[-1]}.{name}"


def table_schema(name: str) -> T.StructType:
    return T.StructType([T.StructField(c, t, nullable) for c, t, nullable, _ in WAREHOUSE[contract(name)]])
