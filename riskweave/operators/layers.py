"""Medallion layers: raw message -> bronze -> silver -> labelled fraud.

Each function is DataFrame -> DataFrame and works unchanged on a batch
DataFrame and on a streaming one (no shuffle, no state): filters and
projections only, fused into one whole-stage-codegen span.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from riskweave.functions.expressions import amount_bucket, country_mismatch
from riskweave.schemas import BRONZE, PAYMENT_SCHEMA, RAW_MESSAGE, SILVER

#: The first amount that does not fit the tables' DECIMAL(12,2) once rounded.
MAX_AMOUNT = 9_999_999_999.995


def stamp_bronze(records: DataFrame) -> DataFrame:
    """Typed payload records -> bronze: event time parsed from the ISO text
    (malformed -> null), layer tag, and the event_date partition column.

    A source that already carries a typed `event_timestamp` (a table, not a
    message) keeps it and skips the per-row text parse."""
    if "event_timestamp" in records.columns:
        ts = F.col("event_timestamp")
    else:
        ts = F.try_to_timestamp(F.col("timestamp"))
    return records.withColumns({
        "event_timestamp": ts,
        "ingestion_layer": F.lit(BRONZE),
        "event_date": F.to_date(ts),
    })


def parse_to_bronze(raw: DataFrame, keep_raw: bool = False) -> DataFrame:
    """Envelope (data BINARY, approximateArrivalTimestamp, shardId) -> bronze.

    The payload is parsed with the fixed schema (PERMISSIVE): unknown keys are
    dropped, ill-typed fields become null, a malformed message becomes an
    all-null row that bronze keeps (silver drops it). With `keep_raw`, the
    column `raw_message` holds the text of each message that was not read in
    full, so that it can be mended and sent again (`envelope.replayed`).
    """
    if keep_raw:
        text = F.col("data").cast("string")
        schema = T.StructType([*PAYMENT_SCHEMA.fields, T.StructField(RAW_MESSAGE, T.StringType())])
        parsed = raw.select(
            F.from_json(text, schema, {"columnNameOfCorruptRecord": RAW_MESSAGE}).alias("payload"), text.alias("message"),
            F.col("approximateArrivalTimestamp").alias("kinesis_arrival_time"), F.col("shardId").alias("shard_id"))
        unread = F.when(F.col("payload").isNull(), F.col("message")).otherwise(F.col(f"payload.{RAW_MESSAGE}"))
        fields = [F.col(f"payload.{f.name}").alias(f.name) for f in PAYMENT_SCHEMA.fields]
        return stamp_bronze(parsed.select(*fields, "kinesis_arrival_time", "shard_id", unread.alias(RAW_MESSAGE)))
    parsed = raw.select(
        F.from_json(F.col("data").cast("string"), PAYMENT_SCHEMA).alias("payload"),
        F.col("approximateArrivalTimestamp").alias("kinesis_arrival_time"),
        F.col("shardId").alias("shard_id"))
    return stamp_bronze(parsed.select("payload.*", "kinesis_arrival_time", "shard_id"))


def clean_rows() -> Column:
    """Rows that silver keeps: keys present, amount finite, positive and within the tables' type."""
    amount = F.col("amount")
    present = F.col("transaction_id").isNotNull() & F.col("user_id").isNotNull() & amount.isNotNull()
    return present & ~F.isnan(amount) & (amount > 0) & (amount < MAX_AMOUNT)


def transform_to_silver(bronze: DataFrame, normalize_country: bool = False) -> DataFrame:
    """Clean + enrich: drop rows missing a key or with an amount that is not
    finite, not positive or beyond DECIMAL(12,2), derive country_mismatch, amount_bucket, event_date, event_hour.
    One filter and one projection (a single codegen stage)."""
    countries = {}
    for c in ("user_country", "ip_country"):
        v = F.col(c).cast("string")
        countries[c] = F.upper(F.trim(v)) if normalize_country else v
    ts = F.col("event_timestamp")
    return bronze.drop(RAW_MESSAGE).filter(clean_rows()).withColumns({
        **countries,
        "country_mismatch": country_mismatch(countries["user_country"], countries["ip_country"]),
        "amount_bucket": amount_bucket(),
        "event_date": F.to_date(ts),
        "event_hour": F.hour(ts),
        "ingestion_layer": F.lit(SILVER),
    })


def filter_fraud(silver: DataFrame) -> DataFrame:
    """Label filter: rows whose is_fraud is true (null dropped)."""
    return silver.filter(F.col("is_fraud"))
