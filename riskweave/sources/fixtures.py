"""Driver tables -> payment events.

The driver's `events` table (event_id, ts, user_id, event_type, value, props)
is mapped onto the payment payload by fixed arithmetic rules, so every payment
query reads the given table and grows with it. The same mapping is written in
SQL for the DuckDB oracle (`plans/oracle.py`).

Mapping, with k = the integer inside props:
  transaction_id  'TXN-' + 8-digit event_id
  user_id         null if event_id % 103 = 0 else 'USR-' + 4-digit user_id
  amount          null if event_id % 97 = 0; -value if event_id % 101 = 0; else value
  merchant        pair number event_id % 10
  user_country    user_id % 6 = 4 -> CA, 5 -> GB, else US
  ip_country      null if event_id % 107 = 0; k < 5 -> risky country k; else user_country
  device          event_id % 3
  fraud_type      k < 5 foreign_ip; value >= 200 large_amount; k < 20 and value < 10 rapid_fire
  avg_spend       mean of value per source user (exact cent sum / count)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskweave.schemas import DEVICES, MERCHANTS, RISKY_COUNTRIES

ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"
# one in this many raw messages is delivered corrupted (malformed JSON)
MALFORMED_EVERY = 211


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _q(v: str) -> str:
    return "'" + v.replace("'", "\\'") + "'"


def _case(key: str, values) -> str:
    return "CASE " + key + " " + " ".join(f"WHEN {i} THEN {_q(v)}" for i, v in enumerate(values)) + " END"


_USER_COUNTRY = "CASE WHEN user_id % 6 = 4 THEN 'CA' WHEN user_id % 6 = 5 THEN 'GB' ELSE 'US' END"
_FRAUD_TYPE = ("CASE WHEN _k < 5 THEN 'foreign_ip' WHEN value >= 200 THEN 'large_amount' "
               "WHEN _k < 20 AND value < 10 THEN 'rapid_fire' END")
# the mapping as Spark SQL expressions: one projection, planned in one call
_MAPPING = [
    "concat('TXN-', lpad(cast(event_id AS string), 8, '0')) AS transaction_id",
    "CASE WHEN event_id % 103 = 0 THEN CAST(NULL AS string) "
    "ELSE concat('USR-', lpad(cast(user_id AS string), 4, '0')) END AS user_id",
    "CAST(CAST(CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 101 = 0 THEN -value ELSE value END "
    "AS decimal(12,2)) AS double) AS amount",
    "'USD' AS currency",
    _case("event_id % 10", [m for m, _ in MERCHANTS]) + " AS merchant_name",
    _case("event_id % 10", [c for _, c in MERCHANTS]) + " AS merchant_category",
    _USER_COUNTRY + " AS user_country",
    "CASE WHEN event_id % 107 = 0 THEN CAST(NULL AS string) WHEN _k < 5 THEN "
    + _case("_k", RISKY_COUNTRIES) + " ELSE " + _USER_COUNTRY + " END AS ip_country",
    _case("event_id % 3", DEVICES) + " AS device",
    "CAST(ts AS timestamp) AS event_timestamp",
    f"({_FRAUD_TYPE}) IS NOT NULL AS is_fraud",
    _FRAUD_TYPE + " AS fraud_type",
    "event_id", "user_id AS source_user", "value",
]


def _mapped(ev: DataFrame) -> DataFrame:
    return (ev.selectExpr("*", "CAST(regexp_extract(props, '([0-9]+)', 1) AS int) AS _k")
            .selectExpr(*_MAPPING))


def payment_events(spark: SparkSession, sf_dir: str, with_avg_spend: bool = False) -> DataFrame:
    """Typed payment events (payload columns + event_timestamp).

    `timestamp` holds the ISO-8601 text the producer would send. With
    `with_avg_spend`, adds the per-user average spend: a partial aggregate per
    source user (map-side combined, so a hot user costs one row per task)
    joined back on the user key (AQE broadcasts it when small).
    """
    ev = table(spark, sf_dir, "events")
    df = _mapped(ev).withColumn("timestamp", F.date_format("event_timestamp", ISO_FORMAT))
    if with_avg_spend:
        avg = (ev.groupBy(F.col("user_id").alias("source_user"))
               .agg((F.sum(F.col("value").cast("decimal(12,2)")).cast("double")
                     / F.count("value").cast("double")).alias("avg_spend")))
        df = df.join(avg, "source_user", "left")
    return df


def payload_columns(df: DataFrame, extra=()) -> DataFrame:
    from riskweave.schemas import PAYMENT_FIELDS
    return df.select(*[n for n, _ in PAYMENT_FIELDS], *extra)


def raw_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream envelope (data BINARY, approximateArrivalTimestamp, shardId).

    `data` is the JSON text of the payload; one message in MALFORMED_EVERY is
    corrupted (not valid JSON), as a broken producer would send it. The arrival time is the
    event time and the shard follows the producer's partition key (user).
    """
    pe = payment_events(spark, sf_dir)
    js = F.to_json(F.struct(*[F.col(n) for n in
                              ["transaction_id", "user_id", "amount", "currency", "merchant_name",
                               "merchant_category", "user_country", "ip_country", "device",
                               "timestamp", "is_fraud", "fraud_type"]]))
    # a corrupt message keeps its whole text behind a stray opening brace
    data = F.when(F.col("event_id") % MALFORMED_EVERY == 0, F.concat(F.lit("{"), js)).otherwise(js)
    return pe.select(
        data.cast("binary").alias("data"),
        F.col("event_timestamp").alias("approximateArrivalTimestamp"),
        F.concat(F.lit("shardId-"), F.lpad((F.col("source_user") % 4).cast("string"), 12, "0"))
         .alias("shardId"),
    )


def rule_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unlabelled rule events (payload without labels + avg_spend + event_timestamp)."""
    pe = payment_events(spark, sf_dir, with_avg_spend=True)
    cols = ["transaction_id", "user_id", "amount", "currency", "merchant_name", "merchant_category",
            "user_country", "ip_country", "device", "timestamp", "avg_spend", "event_timestamp"]
    return pe.select(*cols)


def order_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long history from `orders` (1995-2001): o_custkey -> user, o_totalprice
    -> amount, o_orderdate -> event time, urgent priority -> labelled. Used
    for multi-year weekly trends. Countries are unknown (null)."""
    o = table(spark, sf_dir, "orders")
    return o.selectExpr(
        "concat('ORD-', lpad(cast(o_orderkey AS string), 10, '0')) AS transaction_id",
        "concat('USR-', lpad(cast(o_custkey AS string), 4, '0')) AS user_id",
        "CAST(CAST(o_totalprice AS decimal(12,2)) AS double) AS amount",
        "CAST(NULL AS string) AS user_country",
        "CAST(NULL AS string) AS ip_country",
        "CAST(o_orderdate AS timestamp) AS event_timestamp",
        "o_orderpriority = '1-URGENT' AS is_fraud",
    )
