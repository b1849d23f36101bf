"""The dashboard queries as Spark SQL text, for users who query tables by SQL.

`dashboard_sql(name, as_of, ...)` returns the statement for one dashboard
query over catalog tables or temp views (defaults: the warehouse table names);
`run_dashboard(spark, name, ...)` runs it. Each statement computes exactly
what the DataFrame plan of the same name in `plans.dashboard` computes:
date bounds are folded to literals (partition pruning), money is summed as
DECIMAL and reported as DOUBLE, rates are exact half-up.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from riskweave.plans.dashboard import as_instant
from riskweave.schemas import (ALERT_MINUTES, CATEGORY_DAYS, DAILY_DAYS, HIGH_RISK_MIN_FLAGS,
                               TOP_K)

TABLES = {"silver": "silver.payment_events_clean", "flagged": "fraud.flagged_transactions",
          "profiles": "silver.user_profiles"}


def _half_up(num: str, den: str, factor: int = 100) -> str:
    mag = f"((abs(CAST({num} AS BIGINT)) * {2 * factor * 100} + CAST({den} AS BIGINT)) div (2 * CAST({den} AS BIGINT)))"
    return (f"CASE WHEN CAST({den} AS BIGINT) > 0 THEN CAST(CASE WHEN CAST({num} AS BIGINT) < 0 "
            f"THEN -{mag} ELSE {mag} END AS DOUBLE) / 100.0 END")


_SUM = "CAST(SUM(CAST(amount AS DECIMAL(12,2))) AS DOUBLE)"
_AVG = f"{_SUM} / CAST(COUNT(amount) AS DOUBLE)"
_CENTS = "CAST(SUM(CAST(amount AS DECIMAL(12,2))) * 100 AS BIGINT)"
_ROUND_AVG = (f"CASE WHEN COUNT(amount) > 0 THEN CAST(CASE WHEN {_CENTS} < 0 "
              f"THEN -((abs({_CENTS}) * 2 + COUNT(amount)) div (2 * COUNT(amount))) "
              f"ELSE ((abs({_CENTS}) * 2 + COUNT(amount)) div (2 * COUNT(amount))) END AS DOUBLE) / 100.0 END")
_RATE = _half_up("COUNT_IF(is_fraud)", "COUNT(*)")


def dashboard_sql(name: str, as_of=None, tables: dict | None = None, days: int | None = None,
                  minutes: int = ALERT_MINUTES, k: int = TOP_K, min_flags: int = HIGH_RISK_MIN_FLAGS) -> str:
    t = {**TABLES, **(tables or {})}
    now = as_instant(as_of)
    ts = f"TIMESTAMP'{now.isoformat(sep=' ')}'"
    if name == "daily_fraud_summary":
        since = now.date() - dt.timedelta(days=days or DAILY_DAYS)
        return f"""
SELECT event_date, COUNT(*) AS total_transactions, COUNT_IF(is_fraud) AS fraud_count,
  {_RATE} AS fraud_rate_pct, {_SUM} AS total_volume,
  CAST(SUM(CASE WHEN is_fraud THEN CAST(amount AS DECIMAL(12,2)) ELSE 0 END) AS DOUBLE) AS fraud_volume,
  {_AVG} AS avg_transaction
FROM {t['silver']} WHERE event_date >= DATE'{since}'
GROUP BY event_date ORDER BY event_date DESC"""
    if name == "fraud_by_category_type":
        since = now.date() - dt.timedelta(days=days or CATEGORY_DAYS)
        return f"""
SELECT merchant_category, fraud_type, COUNT(*) AS fraud_count, {_SUM} AS fraud_volume,
  {_ROUND_AVG} AS avg_fraud_amount, MIN(amount) AS min_amount, MAX(amount) AS max_amount
FROM {t['flagged']} WHERE event_date >= DATE'{since}'
GROUP BY merchant_category, fraud_type
ORDER BY fraud_count DESC, merchant_category ASC NULLS LAST, fraud_type ASC NULLS LAST"""
    if name == "high_risk_users":
        return f"""
SELECT f.user_id, f.fraud_flag_count, f.total_flagged_amount, f.distinct_fraud_types,
  f.first_flagged, f.last_flagged,
  CAST(datediff(to_date(f.last_flagged), to_date(f.first_flagged)) AS BIGINT) AS days_active,
  CAST(p.avg_transaction AS DOUBLE) AS normal_avg_spend, p.home_country
FROM (
  SELECT user_id, COUNT(*) AS fraud_flag_count, {_SUM} AS total_flagged_amount,
    COUNT(DISTINCT fraud_type) AS distinct_fraud_types, MIN(event_timestamp) AS first_flagged,
    MAX(event_timestamp) AS last_flagged
  FROM {t['flagged']} GROUP BY user_id HAVING COUNT(*) >= {int(min_flags)}
) f LEFT JOIN {t['profiles']} p ON f.user_id = p.user_id
ORDER BY f.fraud_flag_count DESC, f.user_id ASC LIMIT {int(k)}"""
    if name == "hourly_fraud_rate":
        day = now.date() - dt.timedelta(days=1)
        return f"""
SELECT event_hour, COUNT(*) AS total_transactions, COUNT_IF(is_fraud) AS fraud_count,
  {_RATE} AS fraud_rate_pct, {_SUM} AS total_volume, {_ROUND_AVG} AS avg_amount
FROM {t['silver']} WHERE event_date = DATE'{day}'
GROUP BY event_hour ORDER BY event_hour"""
    if name == "country_mismatch_analysis":
        return f"""
SELECT user_country, ip_country, transaction_count, total_volume, avg_amount,
  {_half_up("transaction_count", "SUM(transaction_count) OVER (PARTITION BY user_country)")}
    AS pct_of_user_country_txns
FROM (
  SELECT user_country, ip_country, COUNT(*) AS transaction_count, {_SUM} AS total_volume,
    {_ROUND_AVG} AS avg_amount
  FROM {t['silver']} WHERE country_mismatch GROUP BY user_country, ip_country
) g
ORDER BY transaction_count DESC, user_country ASC NULLS LAST, ip_country ASC NULLS LAST LIMIT {int(k)}"""
    if name == "recent_fraud_alerts":
        since = now - dt.timedelta(minutes=minutes)
        return f"""
SELECT transaction_id, user_id, amount, merchant_name, user_country, ip_country, fraud_reason,
  flagged_at, timestampdiff(MINUTE, date_trunc('minute', flagged_at), date_trunc('minute', {ts}))
    AS minutes_ago
FROM {t['flagged']} WHERE flagged_at >= TIMESTAMP'{since.isoformat(sep=' ')}'
ORDER BY flagged_at DESC, transaction_id"""
    if name == "weekly_fraud_trend":
        return f"""
SELECT week_start, total_transactions, fraud_count, fraud_rate_pct, total_volume,
  LAG(fraud_count) OVER (ORDER BY week_start) AS prev_week_fraud,
  {_half_up("fraud_count - LAG(fraud_count) OVER (ORDER BY week_start)",
            "LAG(fraud_count) OVER (ORDER BY week_start)")} AS wow_change_pct
FROM (
  SELECT CAST(date_trunc('week', event_date) AS DATE) AS week_start, COUNT(*) AS total_transactions,
    COUNT_IF(is_fraud) AS fraud_count, {_RATE} AS fraud_rate_pct, {_SUM} AS total_volume
  FROM {t['silver']} GROUP BY CAST(date_trunc('week', event_date) AS DATE)
) w
ORDER BY week_start DESC"""
    raise KeyError(name)


NAMES = ["daily_fraud_summary", "fraud_by_category_type", "high_risk_users", "hourly_fraud_rate",
         "country_mismatch_analysis", "recent_fraud_alerts", "weekly_fraud_trend"]


def run_dashboard(spark: SparkSession, name: str, as_of=None, tables: dict | None = None, **kw) -> DataFrame:
    return spark.sql(dashboard_sql(name, as_of, tables, **kw))
