"""End-to-end jobs: the four flows a user of the original system runs.

  stream     messages -> bronze / silver / fraud lake layers (Structured Streaming)
  rules      JSON-lines rule events -> flags + reason -> CSVs + run report
  twin       JSON-lines payment events -> bronze / silver / fraud -> CSVs + run report
  warehouse  lake layers -> warehouse tables (conform + append), profile upsert,
             rule-flagged fraud table, merchant summary -> dashboard frames

Each job is a function over a SparkSession; `python -m riskweave.jobs <job> ...`
runs one from the command line. Reports are returned as DataFrames; nothing is
collected to the driver except by the caller. A frame that several outputs
read is written once as parquet and read back (no recomputation, lineage cut).
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskweave.operators import layers, profile_state as PS, reports as R, rules, warehouse as WH
from riskweave.plans import dashboard as Q
from riskweave.schemas import (BRONZE_LAYER_SCHEMA, SILVER_LAYER_SCHEMA, SPIKE_MULTIPLIER,
                               VELOCITY_MAX_TXNS, VELOCITY_WINDOW_MINUTES)
from riskweave.session import prepare, scratch_path
from riskweave.sinks import tables as SK
from riskweave.sources import envelope as env
from riskweave.sources import tables as TB
from riskweave.streaming import medallion as M


def _materialize(df: DataFrame, spark: SparkSession, out_dir: str | None, name: str) -> DataFrame:
    """Write a frame that several outputs read once, as parquet (in `out_dir`,
    else a fresh folder under the session's shared checkpoint folder), and
    read it back: no recomputation per output, and the lineage is cut."""
    path = f"{out_dir.rstrip('/')}/{name}" if out_dir else scratch_path(spark, name.split(".")[0])
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


# ------------------------------------------------------------------ stream
def stream_job(spark: SparkSession, landing: str, lake_root: str, trigger=None, chain: bool = True,
               wait: bool = True, writers_per_partition: int | None = M.WRITERS_PER_PARTITION,
               max_files_per_trigger: int | None = None):
    """Start the medallion streams on a message landing folder; block until
    one ends (a failure ends the job) unless `wait=False`.
    `max_files_per_trigger` limits what each stream reads at a time."""
    prepare(spark)
    lake = M.LakePaths(lake_root.rstrip("/"))
    raw = env.read_message_stream(spark, landing, max_files_per_trigger)
    queries = M.run_medallion(spark, raw, lake, trigger, chain, writers_per_partition=writers_per_partition,
                              max_files_per_trigger=max_files_per_trigger)
    if wait and trigger not in ("availableNow", "once"):
        M.await_any(spark)
    return queries


# ------------------------------------------------------------------- rules
def rules_job(spark: SparkSession, events_path: str, out_dir: str | None = None,
              window_minutes: int = VELOCITY_WINDOW_MINUTES, max_txns: int = VELOCITY_MAX_TXNS,
              spike_multiplier: float = SPIKE_MULTIPLIER) -> dict[str, DataFrame]:
    """Rules engine run: all transactions with flags, the flagged subset, and
    the run report frames. With `out_dir`, writes both CSVs."""
    prepare(spark)
    events = env.read_rule_event_json(spark, events_path)
    detected = _materialize(rules.apply_fraud_rules(events, window_minutes, max_txns, spike_multiplier),
                            spark, out_dir, "all_transactions.parquet")
    flagged = detected.filter(F.col("is_fraud_detected"))
    if out_dir:
        SK.write_csv(detected, f"{out_dir}/all_transactions", mode="overwrite")
        SK.write_csv(flagged, f"{out_dir}/fraud_detected", mode="overwrite")
    return {
        "all_transactions": detected,
        "fraud_detected": flagged,
        "totals": R.rules_report_totals(detected),
        "cardinality": R.rules_report_cardinality(detected),
        "by_reason": R.rules_report_by_reason(detected),
        "top_users": R.rules_report_top_users(detected),
        "sample": R.rules_sample_flagged(detected),
    }


# -------------------------------------------------------------------- twin
def twin_job(spark: SparkSession, events_path: str, out_dir: str | None = None) -> dict[str, DataFrame]:
    """Batch twin of the streaming layers over a JSON-lines file."""
    prepare(spark)
    bronze = _materialize(layers.stamp_bronze(env.read_payment_json(spark, events_path)),
                          spark, out_dir, "bronze.parquet")
    silver = layers.transform_to_silver(bronze)
    fraud = layers.filter_fraud(silver)
    if out_dir:
        SK.write_csv(silver, f"{out_dir}/silver", mode="overwrite")
        SK.write_csv(fraud, f"{out_dir}/fraud", mode="overwrite")
    return {
        "bronze": bronze, "silver": silver, "fraud": fraud,
        "layers": R.medallion_report_layers(bronze),
        "fraud_types": R.medallion_report_fraud_types(fraud),
        "buckets": R.medallion_report_buckets(silver),
        "top_merchants": R.medallion_report_top_merchants(silver),
        "sample": R.medallion_sample_silver(silver),
    }


# --------------------------------------------------------------- warehouse
def warehouse_job(spark: SparkSession, lake_root: str, warehouse_root: str, as_of=None,
                  window_minutes: int = VELOCITY_WINDOW_MINUTES, max_txns: int = VELOCITY_MAX_TXNS,
                  spike_multiplier: float = SPIKE_MULTIPLIER, load_mode: str = "replace",
                  incremental_profiles: bool = False) -> dict[str, DataFrame]:
    """Load the lake layers into the warehouse tables and build the dashboards.

    1. CREATE TABLE IF NOT EXISTS for the five tables (under `warehouse_root`)
    2. bronze and silver layers: conform, replace what the table holds of them
       (a rerun changes nothing), rejects kept in the tables' reject folders;
       `load_mode="append"` adds the rows again on every run instead
    3. user profiles: aggregate silver, upsert (new copy + location swap); with
       `incremental_profiles` only the days of the silver layer that are new or
       have changed since the last run are read (state under `warehouse_root`),
       and only users that they touched are upserted
    4. fraud table: silver -> rules (spike against the profile average) ->
       flagged rows, stamped with `as_of`; replaces the run's event_date partitions
    5. merchant summary: replaces the `summary_date` partition
    Returns the seven dashboard frames over the loaded tables.
    """
    prepare(spark)
    as_of = Q.as_instant(as_of)
    lake = M.LakePaths(lake_root.rstrip("/"))
    TB.create_tables(spark, warehouse_root)
    bronze = TB.read_layer(spark, lake.bronze, BRONZE_LAYER_SCHEMA)
    silver = TB.read_layer(spark, lake.silver, SILVER_LAYER_SCHEMA)
    SK.load_table(bronze, "bronze.payment_events_raw", as_of, load_mode)
    SK.load_table(silver, "silver.payment_events_clean", as_of, load_mode)

    if incremental_profiles:
        state = f"{warehouse_root.rstrip('/')}/profile_state"
        PS.refresh(spark, silver, state)
        changed = PS.current(spark, state).join(PS.touched(spark, state), "user_id", "left_semi")
        profiles_new = PS.finished(changed, as_of)
    else:
        profiles_new = WH.user_profiles(spark.table("silver.payment_events_clean"), as_of)
    shaped = lambda df, table: TB.conform(df, table, as_of)[0]  # noqa: E731 - aggregates of conformed rows
    SK.upsert_table(spark, "silver.user_profiles", shaped(profiles_new, "silver.user_profiles"),
                    lambda old, new: shaped(WH.upsert_profiles(old, new), "silver.user_profiles"))
    profiles = spark.table("silver.user_profiles")

    with_avg = silver.join(profiles.select("user_id", F.col("avg_transaction").cast("double")
                                           .alias("avg_spend")), "user_id", "left")
    detected = rules.apply_fraud_rules(with_avg, window_minutes, max_txns, spike_multiplier)
    SK.load_table(rules.flagged_transactions(detected, as_of), "fraud.flagged_transactions", as_of)

    summary = WH.merchant_summary(spark.table("silver.payment_events_clean"), as_of)
    SK.load_table(summary, "silver.merchant_summary", as_of)

    s = spark.table("silver.payment_events_clean")
    f = spark.table("fraud.flagged_transactions")
    return {
        "daily_fraud_summary": Q.daily_fraud_summary(s, as_of),
        "fraud_by_category_type": Q.fraud_by_category_type(f, as_of),
        "high_risk_users": Q.high_risk_users(f, profiles),
        "hourly_fraud_rate": Q.hourly_fraud_rate(s, as_of),
        "country_mismatch_analysis": Q.country_mismatch_analysis(s),
        "recent_fraud_alerts": Q.recent_fraud_alerts(f, as_of),
        "weekly_fraud_trend": Q.weekly_fraud_trend(s),
    }


# --------------------------------------------------------------------- CLI
def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="riskweave.jobs")
    sub = p.add_subparsers(dest="job", required=True)
    s = sub.add_parser("stream")
    s.add_argument("--landing", required=True)
    s.add_argument("--lake", required=True)
    s.add_argument("--trigger", default=None, help="processing interval, 'availableNow' or 'once'")
    r = sub.add_parser("rules")
    r.add_argument("--events", required=True)
    r.add_argument("--out", required=True)
    r.add_argument("--window-minutes", type=int, default=VELOCITY_WINDOW_MINUTES)
    r.add_argument("--max-txns", type=int, default=VELOCITY_MAX_TXNS)
    t = sub.add_parser("twin")
    t.add_argument("--events", required=True)
    t.add_argument("--out", required=True)
    w = sub.add_parser("warehouse")
    w.add_argument("--lake", required=True)
    w.add_argument("--warehouse", required=True)
    w.add_argument("--as-of", default=None)
    w.add_argument("--incremental-profiles", action="store_true")
    a = p.parse_args(argv)

    from riskweave.session import build_session
    spark = build_session()
    if a.job == "stream":
        stream_job(spark, a.landing, a.lake, a.trigger)
    elif a.job == "rules":
        out = rules_job(spark, a.events, a.out, a.window_minutes, a.max_txns)
        for name in ("totals", "by_reason", "top_users", "sample"):
            out[name].show(truncate=False)
    elif a.job == "twin":
        out = twin_job(spark, a.events, a.out)
        for name in ("layers", "fraud_types", "buckets", "top_merchants", "sample"):
            out[name].show(truncate=False)
    else:
        as_of = dt.datetime.fromisoformat(a.as_of) if a.as_of else None
        boards = warehouse_job(spark, a.lake, a.warehouse, as_of, incremental_profiles=a.incremental_profiles)
        for name, df in boards.items():
            print(name)
            df.show(truncate=False)


if __name__ == "__main__":
    main()
