"""Run reports of the rules engine and of the medallion layers.

Totals are one global aggregate pass each (partial per task, one final row);
frequency tables are group-by counts ordered by count then key; samples are
top-n over an explicit (event time, id) order, never input order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskweave.functions.expressions import half_up_ratio
from riskweave.operators.layers import clean_rows

SAMPLE_ORDER = ("event_timestamp", "transaction_id")


def frequency(df: DataFrame, key: str, top: int | None = None) -> DataFrame:
    """value_counts(): count per non-null key, descending count, then key."""
    out = (df.filter(F.col(key).isNotNull()).groupBy(key)
           .agg(F.count(F.lit(1)).alias("count"))
           .orderBy(F.col("count").desc(), F.col(key).asc()))
    return out.limit(top) if top else out


def sample(df: DataFrame, columns, n: int) -> DataFrame:
    """First n rows in (event_timestamp, transaction_id) order."""
    return (df.orderBy(*[F.col(c).asc_nulls_last() for c in SAMPLE_ORDER])
            .limit(n).select(*columns))


# ----------------------------------------------------------------- rules run
def rules_report_totals(detected: DataFrame) -> DataFrame:
    """Totals: all, clean, flagged, detection rate (%, 1 decimal), rows per rule."""
    d = F.col("is_fraud_detected")
    agg = detected.agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.count_if(~d).alias("clean_transactions"),
        F.count_if(d).alias("flagged_transactions"),
        F.count_if(F.col("flag_velocity")).alias("velocity_flags"),
        F.count_if(F.col("flag_spike")).alias("spike_flags"),
        F.count_if(F.col("flag_geography")).alias("geography_flags"))
    return agg.withColumn("detection_rate_pct",
                          half_up_ratio(F.col("flagged_transactions"), F.col("total_transactions"),
                                        digits=1))


def rules_report_cardinality(detected: DataFrame) -> DataFrame:
    """Per-rule flagged cardinality: users for velocity, ids for the others.
    Only detected rows reach the distinct counts."""
    return detected.filter(F.col("is_fraud_detected")).agg(
        F.count_distinct(F.when(F.col("flag_velocity"), F.col("user_id"))).alias("velocity_users"),
        F.count_distinct(F.when(F.col("flag_spike"), F.col("transaction_id"))).alias("spike_transactions"),
        F.count_distinct(F.when(F.col("flag_geography"), F.col("transaction_id")))
         .alias("geography_transactions"))


def rules_report_by_reason(detected: DataFrame) -> DataFrame:
    return frequency(detected.filter(F.col("is_fraud_detected")), "fraud_reason")


def rules_report_top_users(detected: DataFrame, n: int = 5) -> DataFrame:
    return frequency(detected.filter(F.col("is_fraud_detected")), "user_id", top=n)


def rules_sample_flagged(detected: DataFrame, n: int = 10) -> DataFrame:
    cols = ["transaction_id", "user_id", "amount", "user_country", "ip_country", "fraud_reason"]
    return sample(detected.filter(F.col("is_fraud_detected")), cols, n)


# ------------------------------------------------------------- medallion run
def medallion_report_layers(bronze: DataFrame, silver_keep=None) -> DataFrame:
    """Rows per layer and the label rate, from one pass over bronze: silver is
    the rows passing the cleaning predicate, fraud those also labelled."""
    keep = clean_rows() if silver_keep is None else silver_keep
    agg = bronze.agg(F.count(F.lit(1)).alias("bronze_records"),
                     F.count_if(keep).alias("silver_records"),
                     F.count_if(keep & F.coalesce(F.col("is_fraud"), F.lit(False))).alias("fraud_records"))
    return agg.withColumn("fraud_rate_pct",
                          half_up_ratio(F.col("fraud_records"), F.col("silver_records"), digits=1))


def medallion_report_fraud_types(fraud: DataFrame) -> DataFrame:
    return frequency(fraud, "fraud_type")


def medallion_report_buckets(silver: DataFrame) -> DataFrame:
    return frequency(silver, "amount_bucket")


def medallion_report_top_merchants(silver: DataFrame, n: int = 5) -> DataFrame:
    return frequency(silver, "merchant_name", top=n)


def medallion_sample_silver(silver: DataFrame, n: int = 5) -> DataFrame:
    cols = ["transaction_id", "user_id", "amount", "amount_bucket", "country_mismatch", "is_fraud"]
    return sample(silver, cols, n)


def medallion_labelled_fraud(fraud: DataFrame) -> DataFrame:
    """Listing of all labelled fraud rows."""
    return fraud.select("transaction_id", "user_id", "amount", "fraud_type", "user_country", "ip_country")
