"""Warehouse aggregates: user profiles (with keyed upsert) and merchant summary.

Both are single partial+final hash aggregates over silver; the upsert is a
full outer join of two one-row-per-user tables (unique keys, no skew).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskweave.functions.expressions import money_avg, money_sum, rate_pct


def user_profiles(silver: DataFrame, as_of=None) -> DataFrame:
    """Per-user aggregate: average/total spend, count, first/last day, and the
    lexicographically largest user_country as home_country."""
    from riskweave.plans.dashboard import ts_lit
    return (silver.groupBy("user_id")
            .agg(money_avg().alias("avg_transaction"),
                 F.count(F.lit(1)).alias("total_transactions"),
                 money_sum().alias("total_spend"),
                 F.min("event_date").alias("first_seen"),
                 F.max("event_date").alias("last_seen"),
                 F.max("user_country").alias("home_country"))
            .withColumn("updated_at", ts_lit(as_of)))


PROFILE_COLUMNS = ["user_id", "avg_transaction", "total_transactions", "total_spend",
                   "first_seen", "last_seen", "home_country", "risk_score", "updated_at"]
REFRESHED = ["avg_transaction", "total_transactions", "total_spend", "last_seen", "updated_at"]
KEPT = ["first_seen", "home_country", "risk_score"]


def upsert_profiles(existing: DataFrame, new: DataFrame, default_risk_score: float = 0.0) -> DataFrame:
    """INSERT ... ON CONFLICT (user_id) DO UPDATE as a full outer join.

    matched:  avg_transaction, total_transactions, total_spend, last_seen,
              updated_at from `new`; first_seen, home_country, risk_score kept
    new only: inserted, risk_score = default
    old only: unchanged
    """
    if "risk_score" not in new.columns:
        new = new.withColumn("risk_score", F.lit(default_risk_score).cast("double"))
    if "risk_score" not in existing.columns:
        existing = existing.withColumn("risk_score", F.lit(default_risk_score).cast("double"))
    o = existing.select(*[F.col(c).alias(f"o_{c}") for c in PROFILE_COLUMNS], F.lit(True).alias("_old"))
    n = new.select(*[F.col(c).alias(f"n_{c}") for c in PROFILE_COLUMNS], F.lit(True).alias("_new"))
    j = o.join(n, o["o_user_id"] == n["n_user_id"], "full")
    has_new = F.col("_new").isNotNull()
    has_old = F.col("_old").isNotNull()
    cols = [F.coalesce(F.col("o_user_id"), F.col("n_user_id")).alias("user_id")]
    for c in PROFILE_COLUMNS[1:]:
        if c in REFRESHED:
            cols.append(F.when(has_new, F.col(f"n_{c}")).otherwise(F.col(f"o_{c}")).alias(c))
        else:
            cols.append(F.when(has_old, F.col(f"o_{c}")).otherwise(F.col(f"n_{c}")).alias(c))
    return j.select(*cols)


def merchant_summary(silver: DataFrame, as_of=None) -> DataFrame:
    """Per (merchant_name, merchant_category) totals stamped with the summary
    date; appended to the summary table (see sinks.tables.append_partition)."""
    from riskweave.plans.dashboard import as_instant, ts_lit
    fraud = F.col("is_fraud")
    return (silver.groupBy("merchant_name", "merchant_category")
            .agg(F.count(F.lit(1)).alias("total_transactions"),
                 money_sum().alias("total_volume"),
                 F.count_if(fraud).alias("fraud_count"),
                 rate_pct(fraud).alias("fraud_rate"),
                 money_avg().alias("avg_transaction"))
            .withColumn("summary_date", F.lit(as_instant(as_of).date()))
            .withColumn("updated_at", ts_lit(as_of)))


def key_violations(df: DataFrame, key="user_id") -> DataFrame:
    """Informational primary key check: key values held by more than one row
    (with their count). One partial+final aggregate; empty when the key holds."""
    keys = [key] if isinstance(key, str) else list(key)
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
            .filter(F.col("rows") > 1))
