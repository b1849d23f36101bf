"""Warehouse aggregates, conform-to-target load, catalog tables and sinks."""

import datetime as dt
import json
import uuid

import pytest
from pyspark.sql import functions as F

from riskweave.operators import warehouse as WH
from riskweave.schemas import table_schema
from riskweave.session import path_exists
from riskweave.sinks import tables as SK
from riskweave.sources import envelope as env
from riskweave.sources import tables as TB

AS_OF = dt.datetime(2024, 1, 31)
PROFILE = ("user_id string, avg_transaction double, total_transactions long, total_spend double, "
           "first_seen date, last_seen date, home_country string, risk_score double, updated_at timestamp")
D = dt.date


def test_user_profiles_aggregate(spark):
    silver = spark.createDataFrame(
        [("A", 10.0, D(2024, 1, 2), "US"), ("A", 20.0, D(2024, 1, 5), "GB"), ("B", 5.0, D(2024, 1, 3), "CA")],
        "user_id string, amount double, event_date date, user_country string")
    out = {r.user_id: r for r in WH.user_profiles(silver, AS_OF).collect()}
    a = out["A"]
    assert (a.avg_transaction, a.total_transactions, a.total_spend) == (15.0, 2, 30.0)
    assert (a.first_seen, a.last_seen, a.home_country) == (D(2024, 1, 2), D(2024, 1, 5), "US")  # max string
    assert a.updated_at == AS_OF


def test_upsert_matched_new_old(spark):
    old_t, new_t = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 31)
    existing = spark.createDataFrame([
        ("M", 10.0, 1, 10.0, D(2023, 12, 1), D(2023, 12, 1), "GB", 7.5, old_t),
        ("O", 3.0, 1, 3.0, D(2023, 11, 1), D(2023, 11, 1), "US", 1.0, old_t)], PROFILE)
    new = spark.createDataFrame([
        ("M", 20.0, 3, 60.0, D(2024, 1, 2), D(2024, 1, 30), "US", None, new_t),
        ("N", 4.0, 2, 8.0, D(2024, 1, 5), D(2024, 1, 6), "CA", None, new_t)], PROFILE).drop("risk_score")
    out = {r.user_id: r for r in WH.upsert_profiles(existing, new).collect()}
    m = out["M"]
    assert (m.avg_transaction, m.total_transactions, m.total_spend, m.last_seen, m.updated_at) == \
        (20.0, 3, 60.0, D(2024, 1, 30), new_t)
    assert (m.first_seen, m.home_country, m.risk_score) == (D(2023, 12, 1), "GB", 7.5)  # kept
    assert out["N"].risk_score == 0.0 and out["N"].first_seen == D(2024, 1, 5)
    assert out["O"].total_spend == 3.0 and out["O"].updated_at == old_t  # untouched
    assert len(out) == 3


def test_merchant_summary(spark):
    silver = spark.createDataFrame([("Uber", "transport", 10.0, True), ("Uber", "transport", 30.0, False)],
                                   "merchant_name string, merchant_category string, amount double, is_fraud boolean")
    r = WH.merchant_summary(silver, AS_OF).first()
    assert (r.total_transactions, r.total_volume, r.fraud_count, r.fraud_rate, r.avg_transaction) == \
        (2, 40.0, 1, 50.0, 20.0)
    assert r.summary_date == D(2024, 1, 31)


def test_conform_casts_defaults_and_rejects(spark):
    lake = spark.createDataFrame([("t1", "u1", 12.345, "x", None), (None, "u2", 1.0, "y", None)],
                                 "transaction_id string, user_id string, amount double, shard_id string, "
                                 "is_fraud boolean")
    ok, bad = TB.conform(lake, "bronze.payment_events_raw", AS_OF)
    target = table_schema("bronze.payment_events_raw")
    assert [(f.name, f.dataType) for f in ok.schema.fields] == [(f.name, f.dataType) for f in target.fields]
    r = ok.collect()
    assert len(r) == 1
    assert [(x.reject_reason, x.shard_id) for x in bad.collect()] == [("transaction_id is null", "y")]
    poison = lake.limit(1).withColumn("amount", F.lit(1e11))
    ok, bad = TB.conform(poison, "bronze.payment_events_raw", AS_OF)
    assert ok.count() == 0 and bad.first().reject_reason == "amount does not fit"
    ok, bad = TB.conform(lake.limit(1), "bronze.payment_events_raw", AS_OF)
    r = ok.collect()
    row = r[0]
    assert str(row.amount) == "12.35" and row.currency == "USD" and row.ingestion_layer == "bronze"
    assert row.ingested_at == AS_OF and row.is_fraud is None  # present nulls stay null
    assert "shard_id" not in ok.columns
    assert dict(ok.dtypes)["amount"] == "decimal(12,2)"


def test_catalog_tables_and_partition_refresh(spark, tmp_path):
    db = f"silver_{uuid.uuid4().hex[:6]}"
    root = str(tmp_path / "lake")
    path = f"{root}/events"
    df = spark.createDataFrame([("a", D(2024, 1, 1)), ("b", D(2024, 1, 2))], "transaction_id string, event_date date")
    df.write.partitionBy("event_date").parquet(path)
    TB.register_layer(spark, f"{db}.events", path, df.schema, partition_by=["event_date"])
    assert spark.table(f"{db}.events").count() == 0  # partitions not yet known
    assert TB.refresh_partitions(spark, f"{db}.events") == 2
    assert TB.scan(spark, f"{db}.events").count() == 2


def test_create_tables_append_and_idempotent_replace(spark, tmp_path):
    root = str(tmp_path / "wh")
    names = TB.create_tables(spark, root, ["silver.merchant_summary"])
    assert names == ["silver.merchant_summary"]
    silver = spark.createDataFrame([("Uber", "transport", 10.0, True)],
                                   "merchant_name string, merchant_category string, amount double, is_fraud boolean")
    rows, _ = TB.conform(WH.merchant_summary(silver, AS_OF), "silver.merchant_summary", AS_OF)
    SK.append_rows(rows, "silver.merchant_summary")
    SK.append_rows(rows, "silver.merchant_summary")  # plain append duplicates on rerun
    assert spark.table("silver.merchant_summary").count() == 2
    SK.replace_partitions(rows, "silver.merchant_summary")  # idempotent variant
    SK.replace_partitions(rows, "silver.merchant_summary")
    assert spark.table("silver.merchant_summary").count() == 1
    spark.sql("DROP TABLE silver.merchant_summary")


def test_upsert_table_swaps_location(spark, tmp_path):
    name = f"default.profiles_{uuid.uuid4().hex[:6]}"
    first = spark.createDataFrame([("A", 1.0, 1, 1.0, D(2024, 1, 1), D(2024, 1, 1), "US", 0.0, AS_OF)], PROFILE)
    path0 = str(tmp_path / "p0")
    first.write.parquet(path0)
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path0}'")
    new = spark.createDataFrame([("A", 2.0, 2, 4.0, D(2024, 1, 1), D(2024, 1, 9), "GB", None, AS_OF),
                                 ("B", 5.0, 1, 5.0, D(2024, 1, 3), D(2024, 1, 3), "CA", None, AS_OF)], PROFILE)
    loc = SK.upsert_table(spark, name, new.drop("risk_score"), WH.upsert_profiles, root=str(tmp_path))
    assert loc != path0
    out = {r.user_id: r for r in spark.table(name).collect()}
    assert out["A"].total_spend == 4.0 and out["A"].home_country == "US" and out["B"].risk_score == 0.0
    assert spark.read.parquet(path0).count() == 1  # the old copy was never overwritten
    newer = SK.upsert_table(spark, name, new.drop("risk_score"), WH.upsert_profiles, root=str(tmp_path))
    assert spark.read.parquet(loc).count() == 2  # replaced, and kept for readers
    SK.upsert_table(spark, name, new.drop("risk_score"), WH.upsert_profiles, root=str(tmp_path))
    assert spark.read.parquet(newer).count() == 2 and not path_exists(spark, loc)
    spark.sql(f"DROP TABLE {name}")


def test_write_table_layout(spark, tmp_path):
    df = spark.createDataFrame([(f"t{i}", f"u{i % 3}", D(2024, 1, 1 + i % 2), dt.datetime(2024, 1, 1, i))
                                for i in range(12)],
                               "transaction_id string, user_id string, event_date date, event_timestamp timestamp")
    plan = SK.laid_out(df, "silver.payment_events_clean", 4)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(event_date" in plan and "xxhash64(user_id" in plan and "Sort [event_date" in plan
    path = str(tmp_path / "silver")
    SK.write_table(df, "silver.payment_events_clean", path, num_partitions=4)
    assert spark.read.parquet(path).count() == 12
    name = f"default.bucketed_{uuid.uuid4().hex[:6]}"
    SK.write_bucketed(df, "silver.payment_events_clean", name, 4, path=str(tmp_path / "b"))
    agg = spark.table(name).groupBy("user_id").count()
    assert "Exchange" not in agg._jdf.queryExecution().executedPlan().toString()  # co-located
    spark.sql(f"DROP TABLE {name}")


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("t1", 1.5, True, None)], "transaction_id string, amount double, "
                                                          "flag boolean, fraud_reason string")
    path = str(tmp_path / "csv")
    SK.write_csv(df, path)
    back = spark.read.option("header", True).schema(df.schema).csv(path).collect()
    assert back[0].transaction_id == "t1" and back[0].amount == 1.5 and back[0].flag is True
    text = "".join(open(p).read() for p in (tmp_path / "csv").glob("part-*.csv"))
    assert text.splitlines()[0] == "transaction_id,amount,flag,fraud_reason"


def test_json_line_sources(spark, tmp_path):
    path = tmp_path / "events.json"
    lines = [{"transaction_id": "a", "user_id": "u", "amount": 7.56, "timestamp": "2024-01-05T10:00:00.5+00:00",
              "avg_spend": 2.0, "is_fraud": True},
             {"transaction_id": "b", "amount": "bad"}]
    path.write_text("\n".join(json.dumps(x) for x in lines))
    pay = env.read_payment_json(spark, str(path))
    assert pay.columns[:3] == ["transaction_id", "user_id", "amount"] and "avg_spend" not in pay.columns
    rule = {r.transaction_id: r for r in env.read_rule_event_json(spark, str(path)).collect()}
    assert rule["a"].amount == 7.56 and rule["a"].avg_spend == 2.0
    assert rule["a"].event_timestamp == dt.datetime(2024, 1, 5, 10, 0, 0, 500000)
    assert rule["b"].amount is None
    assert "is_fraud" not in rule["a"].asDict()


@pytest.mark.parametrize("table", ["silver.payment_events_clean", "fraud.flagged_transactions",
                                   "silver.user_profiles"])
def test_layout_keys_declared(table):
    from riskweave.schemas import LAYOUT
    assert LAYOUT[table]["distribute"] == "user_id"


def test_key_violations(spark):
    df = spark.createDataFrame([("A",), ("B",), ("A",)], "user_id string")
    bad = WH.key_violations(df).collect()
    assert [(r.user_id, r.rows) for r in bad] == [("A", 2)]
    assert WH.key_violations(df.distinct()).count() == 0
