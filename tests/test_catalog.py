"""Catalog tables: locations, loads in one pass, rejects, bucket upserts, replication, followed logs."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from riskweave.operators import layers, warehouse as WH
from riskweave.plans import registry as RG
from riskweave.schemas import (BRONZE_LAYER_SCHEMA, ENVELOPE_SCHEMA, SILVER_LAYER_SCHEMA, SILVER_PARTITIONS, contract, table_schema)
from riskweave.session import list_folder, path_exists, scratch_path
from riskweave.sinks import tables as SK
from riskweave.sources import envelope as env
from riskweave.sources import fixtures as fx
from riskweave.sources import tables as TB
from riskweave.streaming import medallion as M
from tests.conftest import SF_SMALL

AS_OF = dt.datetime(2024, 1, 31)
ARRIVAL = dt.datetime(2024, 1, 5, 12)


@pytest.fixture
def prefix(spark):
    p = f"t{uuid.uuid4().hex[:8]}__"
    yield p
    for r in spark.sql("SHOW DATABASES").collect():
        if r[0].startswith(p):
            spark.sql(f"DROP DATABASE {r[0]} CASCADE")


def databases(spark):
    return {(r[0], t.tableName) for r in spark.sql("SHOW DATABASES").collect() for t in spark.sql(f"SHOW TABLES IN {r[0]}").collect()}


def test_contract_names():
    assert contract("trial__silver.user_profiles") == contract("silver.user_profiles") == "silver.user_profiles"
    assert table_schema("x__silver.user_profiles") == table_schema("silver.user_profiles")


@pytest.mark.parametrize("key", ["load_bronze_rejects", "merchant_summary_appended", "user_profiles_swapped",
                                 "user_profiles_bucket_upsert", "high_risk_users_bucketed", "merchant_spikes_replicated"])
def test_keys_leave_the_catalog_alone(spark, key):
    root = scratch_path(spark, "mine")
    TB.create_tables(spark, root, ["silver.merchant_summary"])
    try:
        before = databases(spark)
        assert RG.QUERIES[key](spark, SF_SMALL).count() > 0  # the frame outlives its database
        assert databases(spark) == before
        assert TB.table_location(spark, "silver.merchant_summary").endswith(f"{root}/silver/merchant_summary")
    finally:
        spark.sql("DROP TABLE silver.merchant_summary")


def test_a_table_of_another_root_is_an_error(spark, prefix):
    one, other = scratch_path(spark, "one"), scratch_path(spark, "other")
    TB.create_tables(spark, one, ["silver.user_profiles"], prefix)
    assert TB.create_tables(spark, one, ["silver.user_profiles"], prefix) == [f"{prefix}silver.user_profiles"]
    with pytest.raises(ValueError, match="not under"):
        TB.create_tables(spark, other, ["silver.user_profiles"], prefix)


def _envelope(spark, texts):
    return spark.createDataFrame([(t.encode(), ARRIVAL, "s0") for t in texts], ENVELOPE_SCHEMA)


GOOD = '{"transaction_id": "t%d", "user_id": "u", "amount": %s, "timestamp": "2024-01-05T10:15:30.5+00:00"}'


def test_raw_text_of_unread_messages(spark):
    texts = [GOOD % (1, "5.5"), "garbage", GOOD % (2, '"x5"'), "{" + GOOD % (3, "2.5"), "", "[1]", "null", "{}"]
    rows = layers.parse_to_bronze(_envelope(spark, texts), keep_raw=True)
    assert rows.columns[-4:] == ["raw_message", "event_timestamp", "ingestion_layer", "event_date"]
    got = {r.raw_message for r in rows.collect()}
    assert got == {None, "garbage", texts[2], texts[3], "", "[1]", "null"}
    part = next(r for r in rows.collect() if r.raw_message == texts[2])
    assert (part.transaction_id, part.amount) == ("t2", None)  # what could be read is kept
    assert "raw_message" not in layers.transform_to_silver(rows).columns
    assert "raw_message" not in layers.parse_to_bronze(_envelope(spark, texts)).columns


def test_rejects_are_replaced_and_replayed(spark, prefix):
    root = scratch_path(spark, "wh")
    name = TB.create_tables(spark, root, ["bronze.payment_events_raw"], prefix)[0]
    texts = [GOOD % (1, "5.5"), "{" + GOOD % (2, "2.5"), GOOD % (3, "null"), "lost"]
    bronze = layers.parse_to_bronze(_envelope(spark, texts), keep_raw=True)
    for _ in range(3):  # accepted + rejected = input after every run
        assert SK.load_table(bronze, name, AS_OF) == {"accepted": 1, "rejected": 3}
        assert spark.table(name).count() == 1 and SK.read_rejects(spark, name, bronze.schema).count() == 3
    rejects = SK.read_rejects(spark, name, bronze.schema)
    assert {(r.reject_reason.split(",")[0], r.raw_message, r.load) for r in rejects.collect()} == {
        ("transaction_id is null", texts[1], "all"), ("amount is null", None, "all"), ("transaction_id is null", "lost", "all")}
    again = layers.parse_to_bronze(env.replayed(rejects, RG._without_stray_brace), keep_raw=True)
    assert {r.kinesis_arrival_time for r in again.collect()} == {ARRIVAL}
    assert SK.load_table(again, name, AS_OF, mode="append", load="replay") == {"accepted": 1, "rejected": 1}
    assert {r.transaction_id for r in spark.table(name).collect()} == {"t1", "t2"}
    assert [r.raw_message for r in SK.read_rejects(spark, name, bronze.schema, "replay").collect()] == ["lost"]
    assert SK.read_rejects(spark, name, bronze.schema, "never").count() == 0


def test_load_parses_its_input_once(spark):
    raw = fx.raw_envelope(spark, SF_SMALL)
    plan = TB.tagged(layers.parse_to_bronze(raw, keep_raw=True), "bronze.payment_events_raw", AS_OF)
    assert plan._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def _profile(user, spend, day="2024-01-02"):
    d = dt.date.fromisoformat(day)
    return (user, float(spend), 1, float(spend), d, d, "US", AS_OF)


PROFILE = ("user_id string, avg_transaction double, total_transactions long, total_spend double, first_seen date, "
           "last_seen date, home_country string, updated_at timestamp")


def _merge(name):
    return lambda old, new: TB.conform(WH.upsert_profiles(old, new), name, AS_OF)[0]


def _files(spark, name):
    return {f"{path}/{n}" for path in SK.bucket_locations(spark, name).values()
            for n, folder, _, _ in list_folder(spark, path) if n.endswith(".parquet")}


def test_an_upsert_rewrites_only_buckets_with_new_rows(spark, prefix):
    root = scratch_path(spark, "keyed")
    name = SK.create_keyed_table(spark, f"{prefix}silver.user_profiles", root)
    first = spark.createDataFrame([_profile(f"U{i}", i) for i in range(40)], PROFILE)
    SK.upsert_buckets(spark, name, first, _merge(name), 8)
    before = _files(spark, name)
    changed = SK.upsert_buckets(spark, name, spark.createDataFrame([_profile("U3", 99), _profile("new", 1)], PROFILE), _merge(name), 8)
    assert 1 <= len(changed) <= 2
    after = _files(spark, name)
    untouched = {f for f in before if not any(f"bucket={b}/" in f for b in changed)}
    assert untouched == before & after and len(untouched) >= len(before) - len(changed)
    rows = {r.user_id: r for r in spark.table(name).collect()}
    assert len(rows) == 41 and float(rows["U3"].total_spend) == 99 and float(rows["U4"].total_spend) == 4
    # the copies that were replaced stay for readers until their buckets are upserted again
    replaced = before - after
    assert all(path_exists(spark, f) for f in replaced)
    SK.upsert_buckets(spark, name, spark.createDataFrame([_profile("U3", 100), _profile("new", 2)], PROFILE), _merge(name), 8)
    assert not any(path_exists(spark, f) for f in replaced)
    assert spark.table(name).filter("user_id = 'U3'").first().total_spend == 100 and spark.table(name).count() == 41


def test_a_crash_between_write_and_swap(spark, prefix, monkeypatch):
    root = scratch_path(spark, "crash")
    name = SK.create_keyed_table(spark, f"{prefix}silver.user_profiles", root)
    SK.upsert_buckets(spark, name, spark.createDataFrame([_profile(f"U{i}", i) for i in range(20)], PROFILE), _merge(name), 4)
    new = spark.createDataFrame([_profile(f"U{i}", 1000 + i) for i in range(20)], PROFILE)
    whole = sorted(r.user_id for r in spark.table(name).collect())

    def gone(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(SK, "_point_at", gone)
        with pytest.raises(RuntimeError):
            SK.upsert_buckets(spark, name, new, _merge(name), 4)
    assert sorted(float(r.total_spend) for r in spark.table(name).collect()) == [float(i) for i in range(20)]  # nothing changed
    # in the middle of the swap: every bucket is old or new, no user is lost or doubled
    real, calls = spark.sql, []
    with monkeypatch.context() as m:
        def some(text, *a, **k):
            calls.append("SET LOCATION" in text)
            if sum(calls) > 2:
                raise RuntimeError("driver lost")
            return real(text, *a, **k)
        m.setattr(spark, "sql", some)
        with pytest.raises(RuntimeError):
            SK.upsert_buckets(spark, name, new, _merge(name), 4)
    spark.catalog.refreshTable(name)
    rows = spark.table(name).collect()
    assert sorted(r.user_id for r in rows) == whole
    assert {float(r.total_spend) - int(r.user_id[1:]) for r in rows} == {0.0, 1000.0}
    SK.upsert_buckets(spark, name, new, _merge(name), 4)  # run again: complete
    assert {float(r.total_spend) - int(r.user_id[1:]) for r in spark.table(name).collect()} == {1000.0}


def test_co_located_join_has_no_exchange_on_the_key(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = RG.q_high_risk_users_bucketed(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "hashpartitioning(user_id" not in plan and "SortMergeJoin" in plan and "Bucketed: true" in plan


def test_replication_follows_the_statistics(spark, prefix):
    root = scratch_path(spark, "replica")
    name = TB.create_tables(spark, root, ["silver.merchant_summary"], prefix)[0]
    silver = spark.createDataFrame([("Uber", "transport", 10.0, True)],
                                   "merchant_name string, merchant_category string, amount double, is_fraud boolean")
    assert TB.table_bytes(spark, name) is None
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")

    def joined(**kw):
        other = spark.range(10).withColumn("merchant_name", F.concat(F.lit("Ube"), F.col("id").cast("string")))
        return other.join(TB.scan(spark, name, **kw), "merchant_name")._jdf.queryExecution().executedPlan().toString()

    try:
        assert "BroadcastHashJoin" not in joined()  # never analyzed: no proof of its size
        SK.load_table(WH.merchant_summary(silver, AS_OF), name, AS_OF)
        assert TB.table_bytes(spark, name) > 0
        assert "BroadcastHashJoin" in joined()
        assert "BroadcastHashJoin" not in joined(replicate_bytes=10)  # too large
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_catalog_follows_the_commit_log(spark, prefix):
    lake = M.LakePaths(scratch_path(spark, "followed"))
    landing, table = f"{lake.root}/landing", f"{prefix}lake.payments"
    envelope = fx.raw_envelope(spark, SF_SMALL)
    arrival, seen = F.col("approximateArrivalTimestamp"), 0
    for i in range(12):  # more batches than the log keeps apart
        lo, hi = dt.datetime(2024, 1, 1 + 2 * i), dt.datetime(2024, 1, 3 + 2 * i)
        env.land_messages(envelope.filter((arrival >= F.lit(lo)) & (arrival < F.lit(hi))), landing, files=1)
        M.start_silver(spark, lake, "availableNow", env.read_message_stream(spark, landing), writers_per_partition=1).awaitTermination()
        if i == 0:
            TB.register_followed(spark, table, lake.silver, SILVER_LAYER_SCHEMA, SILVER_PARTITIONS, f"{lake.root}/table")
            assert spark.table(table).count() == 0
        if i in (0, 1, 11):
            added = TB.refresh_from_log(spark, table)
            rows = TB.read_layer(spark, lake.silver, SILVER_LAYER_SCHEMA)
            assert spark.table(table).count() == rows.count() > seen
            assert spark.sql(f"SHOW PARTITIONS {table}").count() == rows.select("event_date", "event_hour").distinct().count()
            if i == 1:  # only what the second batch wrote
                assert {a.split("/")[0] for a in added} <= {"event_date=2024-01-03", "event_date=2024-01-04"}
            seen = rows.count()
    assert TB.refresh_from_log(spark, table) == []


def test_a_changed_column_stops_the_refresh(spark, prefix):
    lake = M.LakePaths(scratch_path(spark, "changed"))
    env.land_messages(fx.raw_envelope(spark, SF_SMALL).limit(50), f"{lake.root}/landing", files=1)
    M.start_silver(spark, lake, "availableNow", env.read_message_stream(spark, f"{lake.root}/landing"),
                   writers_per_partition=1).awaitTermination()
    fewer = type(SILVER_LAYER_SCHEMA)([f for f in SILVER_LAYER_SCHEMA.fields if f.name != "device"])
    TB.register_followed(spark, f"{prefix}lake.narrow", lake.silver, fewer, SILVER_PARTITIONS, f"{lake.root}/table")
    with pytest.raises(ValueError, match="device"):
        TB.refresh_from_log(spark, f"{prefix}lake.narrow")
    assert spark.sql(f"SHOW PARTITIONS {prefix}lake.narrow").count() == 0


def test_bronze_layer_schema_has_the_raw_text():
    assert "raw_message" in BRONZE_LAYER_SCHEMA.names and BRONZE_LAYER_SCHEMA.names[-1] == "event_date"
