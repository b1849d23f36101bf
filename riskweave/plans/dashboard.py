"""Dashboard queries over the silver table and the flagged-transactions table.

Every query takes an explicit `as_of` instant instead of reading the clock,
so results are reproducible; date bounds are folded to literals in Python so
the scan gets static partition pruning and parquet min/max skipping.

Plans: one partial+final hash aggregate per query (map-side combine makes a
hot key cost one row per task); windows run only over aggregated rows; top-k
uses a total order so the k-th tie is reproducible (TakeOrderedAndProject).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window, functions as F

from riskweave.functions.expressions import (day_boundaries, half_up_ratio, minute_boundaries,
                                             money, money_avg, money_sum, rate_pct,
                                             round_avg_money, week_start)
from riskweave.schemas import (ALERT_MINUTES, CATEGORY_DAYS, DAILY_DAYS, HIGH_RISK_MIN_FLAGS,
                               TOP_K)


def as_instant(as_of) -> dt.datetime:
    """Accept a datetime, a date or ISO text; naive values are UTC."""
    if as_of is None:
        return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    if isinstance(as_of, dt.datetime):
        if as_of.tzinfo is not None:
            as_of = as_of.astimezone(dt.timezone.utc).replace(tzinfo=None)
        return as_of
    if isinstance(as_of, dt.date):
        return dt.datetime(as_of.year, as_of.month, as_of.day)
    return as_instant(dt.datetime.fromisoformat(str(as_of)))


def ts_lit(as_of) -> F.Column:
    return F.lit(as_instant(as_of)).cast("timestamp")


def daily_fraud_summary(silver: DataFrame, as_of=None, days: int = DAILY_DAYS) -> DataFrame:
    """Q1: per day over the last `days` days (lower bound only)."""
    since = as_instant(as_of).date() - dt.timedelta(days=days)
    fraud = F.col("is_fraud")
    return (silver.filter(F.col("event_date") >= F.lit(since))
            .groupBy("event_date")
            .agg(F.count(F.lit(1)).alias("total_transactions"),
                 F.count_if(fraud).alias("fraud_count"),
                 rate_pct(fraud).alias("fraud_rate_pct"),
                 money_sum().alias("total_volume"),
                 F.sum(F.when(fraud, money()).otherwise(F.lit(0))).cast("double").alias("fraud_volume"),
                 money_avg().alias("avg_transaction"))
            .orderBy(F.col("event_date").desc()))


def fraud_by_category_type(flagged: DataFrame, as_of=None, days: int = CATEGORY_DAYS) -> DataFrame:
    """Q2: flagged rows of the last `days` days by (merchant_category, fraud_type)."""
    since = as_instant(as_of).date() - dt.timedelta(days=days)
    return (flagged.filter(F.col("event_date") >= F.lit(since))
            .groupBy("merchant_category", "fraud_type")
            .agg(F.count(F.lit(1)).alias("fraud_count"),
                 money_sum().alias("fraud_volume"),
                 round_avg_money().alias("avg_fraud_amount"),
                 F.min("amount").alias("min_amount"),
                 F.max("amount").alias("max_amount"))
            .orderBy(F.col("fraud_count").desc(), F.col("merchant_category").asc_nulls_last(),
                     F.col("fraud_type").asc_nulls_last()))


def high_risk_users(flagged: DataFrame, profiles: DataFrame, min_flags: int = HIGH_RISK_MIN_FLAGS,
                    k: int = TOP_K) -> DataFrame:
    """Q3: users flagged at least `min_flags` times, top `k` by flag count.

    Aggregates flagged rows per user *before* the left join with profiles
    (valid because profiles hold one row per user), so the join sees one row
    per flagged user instead of every flagged transaction.
    """
    per_user = (flagged.groupBy("user_id")
                .agg(F.count(F.lit(1)).alias("fraud_flag_count"),
                     money_sum().alias("total_flagged_amount"),
                     F.count_distinct("fraud_type").alias("distinct_fraud_types"),
                     F.min("event_timestamp").alias("first_flagged"),
                     F.max("event_timestamp").alias("last_flagged"))
                .filter(F.col("fraud_flag_count") >= min_flags)
                .withColumn("days_active", day_boundaries("first_flagged", "last_flagged").cast("long")))
    p = profiles.select("user_id", F.col("avg_transaction").cast("double").alias("normal_avg_spend"),
                        "home_country")
    return (per_user.join(p, "user_id", "left")
            .orderBy(F.col("fraud_flag_count").desc(), F.col("user_id").asc())
            .limit(k))


def hourly_fraud_rate(silver: DataFrame, as_of=None) -> DataFrame:
    """Q4: yesterday (relative to as_of) by hour of day."""
    day = as_instant(as_of).date() - dt.timedelta(days=1)
    fraud = F.col("is_fraud")
    return (silver.filter(F.col("event_date") == F.lit(day))
            .groupBy("event_hour")
            .agg(F.count(F.lit(1)).alias("total_transactions"),
                 F.count_if(fraud).alias("fraud_count"),
                 rate_pct(fraud).alias("fraud_rate_pct"),
                 money_sum().alias("total_volume"),
                 round_avg_money().alias("avg_amount"))
            .orderBy("event_hour"))


def country_mismatch_analysis(silver: DataFrame, k: int = TOP_K) -> DataFrame:
    """Q5: mismatched transactions by (user_country, ip_country), top `k`.

    The share is of all *mismatched* transactions of the user country (the
    filter runs before the window), computed before the limit.
    """
    agg = (silver.filter(F.col("country_mismatch"))
           .groupBy("user_country", "ip_country")
           .agg(F.count(F.lit(1)).alias("transaction_count"),
                money_sum().alias("total_volume"),
                round_avg_money().alias("avg_amount")))
    share = half_up_ratio(F.col("transaction_count"),
                          F.sum("transaction_count").over(Window.partitionBy("user_country")))
    return (agg.withColumn("pct_of_user_country_txns", share)
            .orderBy(F.col("transaction_count").desc(), F.col("user_country").asc_nulls_last(),
                     F.col("ip_country").asc_nulls_last())
            .limit(k))


def recent_fraud_alerts(flagged: DataFrame, as_of=None, minutes: int = ALERT_MINUTES) -> DataFrame:
    """Q6: rows flagged at or after as_of - `minutes` (no upper bound)."""
    now = as_instant(as_of)
    since = now - dt.timedelta(minutes=minutes)
    return (flagged.filter(F.col("flagged_at") >= F.lit(since).cast("timestamp"))
            .select("transaction_id", "user_id", "amount", "merchant_name", "user_country",
                    "ip_country", "fraud_reason", "flagged_at",
                    minute_boundaries(F.col("flagged_at"), ts_lit(now)).alias("minutes_ago"))
            .orderBy(F.col("flagged_at").desc(), F.col("transaction_id")))


def weekly_fraud_trend(silver: DataFrame) -> DataFrame:
    """Q7: per Monday-week totals with the previous existing week's fraud count
    and the week-over-week change (null for the first week or a zero week)."""
    fraud = F.col("is_fraud")
    weekly = (silver.groupBy(week_start("event_date").alias("week_start"))
              .agg(F.count(F.lit(1)).alias("total_transactions"),
                   F.count_if(fraud).alias("fraud_count"),
                   rate_pct(fraud).alias("fraud_rate_pct"),
                   money_sum().alias("total_volume")))
    # one row per week: the unpartitioned window runs over a handful of rows
    prev = F.lag("fraud_count").over(Window.orderBy("week_start"))
    return (weekly.withColumn("prev_week_fraud", prev)
            .withColumn("wow_change_pct",
                        half_up_ratio(F.col("fraud_count") - F.col("prev_week_fraud"),
                                      F.col("prev_week_fraud")))
            .orderBy(F.col("week_start").desc()))
