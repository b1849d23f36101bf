"""Streams: batch = stream parity, restart from checkpoint, live rules across
micro-batches, alerts, text source, console sink."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from riskweave.operators import layers, rules
from riskweave.plans import registry as RG
from riskweave.schemas import (BRONZE_LAYER_SCHEMA, BRONZE_SCHEMA, FRAUD_LAYER_SCHEMA, SILVER_LAYER_SCHEMA,
                               SILVER_SCHEMA)
from riskweave.session import list_folder, scratch_path
from riskweave.sources import envelope as env
from riskweave.sources import fixtures as fx
from riskweave.sources.tables import read_layer
from riskweave.streaming import alerts as A
from riskweave.streaming import live_rules as LR
from riskweave.streaming import medallion as M
from tests.conftest import SF_SMALL


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_stream_equals_batch_and_restart_adds_nothing(spark):
    lake, raw = RG._lake(spark, SF_SMALL, "parity")
    M.run_medallion(spark, raw, lake, trigger="availableNow")
    batch_raw = env.read_messages(spark, f"{lake.root}/landing")
    bronze_b = layers.parse_to_bronze(batch_raw)
    silver_b = layers.transform_to_silver(bronze_b)
    fraud_b = layers.filter_fraud(silver_b)
    cols_b = [f.name for f in BRONZE_SCHEMA.fields]
    cols_s = [f.name for f in SILVER_SCHEMA.fields]
    bronze_s = read_layer(spark, lake.bronze, BRONZE_LAYER_SCHEMA)
    assert _same(bronze_s.select(*cols_b), bronze_b.select(*cols_b))
    assert _same(read_layer(spark, lake.silver, SILVER_LAYER_SCHEMA).select(*cols_s), silver_b.select(*cols_s))
    assert _same(read_layer(spark, lake.fraud, FRAUD_LAYER_SCHEMA).select(*cols_s), fraud_b.select(*cols_s))
    n = bronze_s.count()
    # restart from the same checkpoints: nothing new to process, nothing added
    M.run_medallion(spark, env.read_message_stream(spark, f"{lake.root}/landing"), lake, trigger="availableNow")
    assert read_layer(spark, lake.bronze, BRONZE_LAYER_SCHEMA).count() == n
    # a new landing file is picked up exactly once
    env.land_messages(fx.raw_envelope(spark, SF_SMALL).limit(7), f"{lake.root}/landing", files=1)
    M.run_medallion(spark, env.read_message_stream(spark, f"{lake.root}/landing"), lake, trigger="availableNow")
    assert read_layer(spark, lake.bronze, BRONZE_LAYER_SCHEMA).count() == n + 7


def test_side_by_side_topology(spark):
    lake, raw = RG._lake(spark, SF_SMALL, "sidebyside")
    qs = M.run_medallion(spark, raw, lake, trigger="availableNow", chain=False)
    for q in qs:
        q.awaitTermination()
    assert read_layer(spark, lake.fraud, FRAUD_LAYER_SCHEMA).count() == \
        layers.filter_fraud(layers.transform_to_silver(layers.parse_to_bronze(
            env.read_messages(spark, f"{lake.root}/landing")))).count()


def _ordered_silver_folder(spark, tag, days_per_file=5):
    """Silver rows written in time order, one append per slice of days, so a
    file stream with maxFilesPerTrigger=1 replays them in event-time order."""
    silver = RG.silver_frame(spark, SF_SMALL)
    path = scratch_path(spark, tag)
    for start in range(1, 31, days_per_file):
        lo = dt.date(2024, 1, start)
        hi = lo + dt.timedelta(days=days_per_file)
        (silver.filter((F.col("event_date") >= F.lit(lo)) & (F.col("event_date") < F.lit(hi)))
         .select(*[f.name for f in SILVER_SCHEMA.fields if f.name in silver.columns])
         .coalesce(1).write.mode("append").parquet(path))
        time.sleep(1.1)
    return silver, path


def _stream_of(spark, path):
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_microbatch_rules_match_batch_counts_across_batches(spark):
    silver, path = _ordered_silver_folder(spark, "t8-src")
    root = scratch_path(spark, "t8")
    profiles = RG.WH.user_profiles(silver, RG.AS_OF)
    q = LR.start_microbatch_rules(_stream_of(spark, path), profiles, f"{root}/out", f"{root}/state",
                                  f"{root}/ckpt", window_minutes=1440, max_txns=5,
                                  flagged_at="event_timestamp", trigger="availableNow")
    q.awaitTermination()
    out = spark.read.parquet(f"{root}/out")
    assert out.select("batch_id").distinct().count() >= 5  # really ran in several batches
    counts = rules.velocity_counts(silver, 1440, carry=("transaction_id",))
    want = {r.transaction_id: r.window_count for r in counts.collect()}
    got = {r.transaction_id: r for r in out.collect()}
    vel = {t for t, n in want.items() if n > 5}
    assert vel and vel <= set(got)
    assert all(got[t].window_count == want[t] for t in got)
    assert {t for t, r in got.items() if r.flag_velocity} == vel


def test_stateful_velocity_across_batches(spark):
    silver, path = _ordered_silver_folder(spark, "t9-src")
    root = scratch_path(spark, "t9")
    q = LR.start_stateful_velocity(_stream_of(spark, path), f"{root}/out", f"{root}/ckpt",
                                   window_minutes=1440, max_txns=5, trigger="availableNow")
    q.awaitTermination()
    got = {r.transaction_id: r.window_count for r in spark.read.parquet(f"{root}/out").collect()}
    counts = rules.velocity_counts(silver, 1440, carry=("transaction_id",))
    want = {r.transaction_id: r.window_count for r in counts.collect() if r.window_count > 5}
    assert want and got == want


def test_alerts_once_per_new_file(spark):
    lake = RG._run(spark, SF_SMALL, "alerts-t", ("bronze", "silver", "fraud"))
    out = f"{lake.root}/alerts"
    for _ in range(2):  # second run: nothing new
        A.start_alerts(A.read_fraud_stream(spark, lake.fraud, FRAUD_LAYER_SCHEMA), out,
                       lake.checkpoint("alerts"), trigger="availableNow").awaitTermination()
    alerts = A.read_alerts(spark, out)
    fraud = read_layer(spark, lake.fraud, FRAUD_LAYER_SCHEMA)
    assert alerts.count() == fraud.count() > 0
    assert alerts.select("transaction_id").distinct().count() == alerts.count()
    files = A.read_file_alerts(spark, out)
    committed = fraud.select(F.input_file_name()).distinct().count()
    assert files.count() == committed and files.agg(F.sum("rows")).first()[0] == fraud.count()


def test_payload_text_stream_and_console(spark, tmp_path):
    src = tmp_path / "payloads"
    src.mkdir()
    (src / "a.json").write_text('{"transaction_id": "x", "user_id": "u", "amount": 5.0}\nnot json\n')
    raw = env.read_payload_text_stream(spark, str(src))
    bronze = layers.parse_to_bronze(raw)
    q = (bronze.writeStream.format("memory").queryName("payload_probe").trigger(availableNow=True).start())
    q.awaitTermination()
    rows = spark.table("payload_probe").collect()
    assert len(rows) == 2 and all(r.kinesis_arrival_time is not None for r in rows)
    cq = M.write_console(bronze, rows=10, trigger="availableNow")
    cq.awaitTermination()
    assert cq.lastProgress is not None


def test_stateful_velocity_drops_late_events(spark):
    src = scratch_path(spark, "t9-late")
    schema = "user_id string, transaction_id string, event_timestamp timestamp"
    day10 = dt.datetime(2024, 1, 10, 12, 0)
    first = [("A", f"a{i}", day10 + dt.timedelta(minutes=i)) for i in range(6)]
    late = [("B", f"b{i}", day10 - dt.timedelta(days=1) + dt.timedelta(minutes=i)) for i in range(6)]
    fresh = [("C", f"c{i}", day10 + dt.timedelta(hours=2, minutes=i)) for i in range(6)]
    for rows in (first, late, fresh):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        time.sleep(1.1)
    root = scratch_path(spark, "t9-late-out")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = LR.start_stateful_velocity(stream, f"{root}/out", f"{root}/ckpt", window_minutes=60, max_txns=5,
                                   trigger="availableNow")
    q.awaitTermination()
    users = {r.user_id for r in spark.read.parquet(f"{root}/out").collect()}
    assert users == {"A", "C"}  # B's burst arrived a day behind the watermark


def test_score_batch_repeated_ids_keep_row_count(spark):
    t0 = dt.datetime(2024, 1, 10, 12, 0)
    rows = [("A", "dup", t0, 5.0, "US", "US"), ("A", "dup", t0, 5.0, "US", "US"),
            ("A", "x", t0 + dt.timedelta(minutes=1), 5.0, "US", "RU")]
    batch = spark.createDataFrame(rows, "user_id string, transaction_id string, event_timestamp timestamp, "
                                        "amount double, user_country string, ip_country string")
    profiles = spark.createDataFrame([("A", 10.0)], "user_id string, avg_transaction double")
    out = LR.score_batch(batch, None, profiles, 10, 2, 3.0).collect()
    assert len(out) == 3 and {r.window_count for r in out} == {2, 3}
    assert [r.flag_velocity for r in out if r.transaction_id == "x"] == [True]


class _Handle:
    """The state that a processor sees, held over triggers."""

    def __init__(self):
        self.maps, self.lists, self.timers = {}, {}, []

    def getMapState(self, name, *_):
        own = self.maps.setdefault(name, {})

        class Map:
            def iterator(self):
                return iter(list(own.items()))

            def getValue(self, key):
                return own.get(key)

            def updateValue(self, key, value):
                own[key] = value

            def removeKey(self, key):
                own.pop(key)
        return Map()

    def getListState(self, name, *_):
        own = self.lists.setdefault(name, [])

        class List:
            def appendList(self, rows):
                own.extend(rows)

            def get(self):
                return iter(list(own))

            def clear(self):
                own.clear()
        return List()

    def registerTimer(self, at):
        self.timers.append(at)


class _Times:
    def __init__(self, watermark_ms):
        self.ms = watermark_ms

    def getCurrentWatermarkInMs(self):
        return self.ms


def _processor(window_minutes, limit):
    p, h = LR.VelocityProcessor(window_minutes, limit), _Handle()
    p.init(h)
    return p, h


def _frame(times):
    import pandas as pd
    return pd.DataFrame({"user_id": "u", "transaction_id": [f"t{i}" for i in range(len(times))],
                         "event_timestamp": pd.to_datetime(times, unit="us")})


def test_admitted_late_event_sees_its_whole_window():
    p, handle = _processor(10, 5)
    t0 = 1_704_844_800_000_000

    def batch(watermark_ms, *minutes):
        got = p.handleInputRows(("u",), iter([_frame([t0 + m * 60_000_000 for m in minutes])]), _Times(watermark_ms))
        return [(r.transaction_id, r.window_count) for out in got for r in out.itertuples()]

    ms = t0 // 1000
    assert batch(0, 0, 1, 2, 3, 4) == []
    assert batch(max(0, ms + (4 - 10) * 60_000), 12) == []
    late = ms + 2 * 60_000  # a window behind minute 12: minute 5 is still admitted
    assert batch(late, 5) == [("t0", 6)]
    assert batch(late, 1) == []  # behind the watermark: dropped
    assert min(k[0] for k in handle.maps["seconds"]) >= (ms + 2 * 60_000 - 10 * 60_000) // 1000
    assert min(handle.timers) > late - 12 * 60_000
    list(p.handleExpiredTimer(("u",), _Times(ms + 60 * 60_000), None))
    assert handle.maps["seconds"] == {} and handle.maps["instants"] == {}


def test_processor_counts_equal_brute_force_over_batches_and_triggers():
    import random
    rng = random.Random(4)
    p, handle = _processor(1, 0)
    seen = []
    for trigger in range(4):
        frames = []
        for _ in range(rng.choice([1, 3])):  # several Arrow batches of one trigger, in no order
            times = [rng.choice([rng.randrange(300_000_000), 60_000_000, 1_000_000 * rng.randrange(300), 120_000_000 + rng.randrange(50)])
                     for _ in range(60)]
            frames.append(times)
        seen += [t for f in frames for t in f]
        got = [(int(r.event_timestamp.value // 1000), r.window_count) for out in
               p.handleInputRows(("u",), iter([_frame(f) for f in frames]), _Times(0)) for r in out.itertuples()]
        want = [(t, sum(t - 60_000_000 <= x <= t for x in seen)) for f in frames for t in f]
        assert sorted(got) == sorted(want)
        assert handle.lists["arrived"] == []


def _users_frame(rows):
    import pandas as pd
    return pd.DataFrame({"user_id": [r[0] for r in rows], "transaction_id": [r[1] for r in rows],
                         "event_timestamp": pd.to_datetime([r[2] for r in rows], unit="us")})


@pytest.mark.parametrize("at_a_time", [50, 50_000])
def test_shard_of_many_users_counts_as_brute_force(monkeypatch, at_a_time):
    """Users of one shard do not see each other's events, whether a trigger's rows are held or laid."""
    import random
    monkeypatch.setattr(LR, "ROWS_AT_A_TIME", at_a_time)
    rng = random.Random(7)
    p, handle = _processor(1, 0)
    seen = []
    for trigger in range(3):
        frames = [[(f"u{rng.randrange(6)}\u00e9", f"t{trigger}-{f}-{i}" if i else None,
                    rng.choice([rng.randrange(300_000_000), 60_000_000, 120_000_000 + rng.randrange(3)]) - 90_000_000)
                   for i in range(40)] for f in range(4)]
        rows = [r for f in frames for r in f]
        seen += rows
        got = [(r.user_id, r.transaction_id, int(r.event_timestamp.value // 1000), r.window_count) for out in
               p.handleInputRows((0,), iter([_users_frame(f) for f in frames]), _Times(0)) for r in out.itertuples()]
        want = [(u, i, t, sum(v == u and t - 60_000_000 <= x <= t for v, _, x in seen)) for u, i, t in rows]
        assert sorted(got, key=str) == sorted(want, key=str)
        assert handle.lists["arrived"] == []
    list(p.handleExpiredTimer((0,), _Times(10_000_000), None))
    assert handle.maps["seconds"] == {} and handle.maps["instants"] == {}


def test_state_calls_do_not_grow_with_events_or_users():
    class Counted(_Handle):
        calls = 0

        def getMapState(self, name, *schema):
            state = super().getMapState(name, *schema)
            update, remove = state.updateValue, state.removeKey

            def updated(key, value):
                self.calls += 1
                update(key, value)

            def removed(key):
                self.calls += 1
                remove(key)
            state.updateValue, state.removeKey = updated, removed
            return state

    calls = []
    for users, events in ((5, 200), (50, 20_000)):
        p, handle = LR.VelocityProcessor(1440, 8), Counted()
        p.init(handle)
        for trigger in range(3):  # ten days each
            start = trigger * 10 * 86_400_000_000
            rows = [(f"u{i % users}", f"t{i}", start + i * (10 * 86_400_000_000 // events)) for i in range(events)]
            list(p.handleInputRows((0,), iter([_users_frame(rows)]), _Times(max(0, start // 1000 - 86_400_000))))
        calls.append(handle.calls)
    assert calls[0] == calls[1] < 100


def test_stateful_velocity_in_few_shards_equals_the_batch_count(spark):
    silver, path = _ordered_silver_folder(spark, "t9-shards", days_per_file=10)
    root = scratch_path(spark, "t9-shards-out")
    LR.start_stateful_velocity(_stream_of(spark, path), f"{root}/out", f"{root}/ckpt", window_minutes=1440, max_txns=3,
                               trigger="availableNow", shards=2).awaitTermination()
    got = sorted((r.user_id, r.transaction_id, r.window_count) for r in spark.read.parquet(f"{root}/out").collect())
    counts = rules.velocity_counts(silver, 1440, carry=("transaction_id",)).collect()
    assert got and got == sorted((r.user_id, r.transaction_id, r.window_count) for r in counts if r.window_count > 3)


def test_stateful_velocity_restarts_from_the_store(spark):
    """State of a stopped query is read back from the checkpoint's RocksDB files."""
    src, root = scratch_path(spark, "t9-restart"), scratch_path(spark, "t9-restart-out")
    schema = "user_id string, transaction_id string, event_timestamp timestamp"
    t0 = dt.datetime(2024, 1, 10, 12, 0)
    for part in range(3):  # the query is started anew for each part
        rows = [("A", f"a{part}{i}", t0 + dt.timedelta(minutes=5 * part + i)) for i in range(3)]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        LR.start_stateful_velocity(spark.readStream.schema(schema).parquet(src), f"{root}/out", f"{root}/ckpt",
                                   window_minutes=60, max_txns=5, trigger="availableNow").awaitTermination()
    got = sorted((r.transaction_id, r.window_count) for r in spark.read.parquet(f"{root}/out").collect())
    assert got == [("a12", 6), ("a20", 7), ("a21", 8), ("a22", 9)]
    assert spark.conf.get(LR.STATE_STORE) != LR.ROCKSDB  # the session's own setting is left alone


def test_history_expires_by_what_earlier_batches_held(spark):
    root = scratch_path(spark, "history")

    def kept():
        return sorted(n for n, *_ in list_folder(spark, root) if n.startswith("day="))

    def put(day, batch):
        LR._dynamic_overwrite(spark.createDataFrame([("u", 1, 1, day, batch)], LR.HISTORY_SCHEMA), root, "day", "batch_id")

    assert LR.expire_history(spark, root, 0, 10, 60) == []
    for day, batch in (("2024-01-01", 0), ("2024-01-08", 1), ("2024-01-09", 2), ("2024-01-20", 3)):
        put(day, batch)
    # a retry of batch 3 does not look at what batch 3 wrote itself
    assert LR.expire_history(spark, root, 3, 10, 60) == ["2024-01-01"]
    assert kept() == ["day=2024-01-08", "day=2024-01-09", "day=2024-01-20"]
    assert LR.expire_history(spark, root, 4, 10, 14 * 1440) == []
    assert LR.expire_history(spark, root, 4, 10, 60) == ["2024-01-08", "2024-01-09"]


def test_one_hour_batch_is_written_by_several_tasks(spark):
    rows = spark.range(400).select(F.lit(None).cast("string").alias("transaction_id"), F.col("id"),
                                   F.lit("2024-01-10").cast("date").alias("event_date"), F.lit(7).alias("event_hour"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so few rows would share a task
    try:
        tasks = M.clustered(rows, ("event_date", "event_hour")).select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert 1 < tasks <= M.WRITERS_PER_PARTITION


def test_alerts_and_flags_read_before_anything_was_flagged(spark):
    nowhere = scratch_path(spark, "nothing-yet")
    assert A.read_alerts(spark, nowhere).select(*A.ALERT_COLUMNS).count() == 0
    assert A.read_file_alerts(spark, nowhere).count() == 0
    assert LR.read_live_flags(spark, nowhere).select(*LR.LIVE_COLUMNS).count() == 0


def test_connector_streams_give_the_envelope(spark):
    import pytest
    root = scratch_path(spark, "connector")
    envelope = fx.raw_envelope(spark, SF_SMALL).limit(30)
    env.land_messages(envelope, f"{root}/json", files=3)
    envelope.select(F.col("data").cast("string").alias("value")).write.text(f"{root}/text")

    def drained(df, name):
        q = (df.writeStream.format("parquet").option("path", f"{root}/{name}-out")
             .option("checkpointLocation", f"{root}/{name}-ckpt").trigger(availableNow=True).start())
        q.awaitTermination()
        return spark.read.parquet(f"{root}/{name}-out"), q

    landed, q = drained(env.read_connector_stream(spark, "json", path=f"{root}/json", rate_limit=1), "json")
    assert _same(landed, env.read_messages(spark, f"{root}/json"))
    assert len([p for p in q.recentProgress if p.numInputRows]) == 3  # one file a batch
    text, _ = drained(env.read_connector_stream(spark, "text", path=f"{root}/text"), "text")
    assert _same(text.select("data"), landed.select("data")) and text.filter("approximateArrivalTimestamp IS NULL").count() == 0
    own = env.Connector("rate", "CAST(CAST(value AS STRING) AS BINARY)", "timestamp", "'r'", None, "rowsPerSecond")
    assert env.read_connector_stream(spark, own, rate_limit=5).columns == ["data", "approximateArrivalTimestamp", "shardId"]
    with pytest.raises(ValueError):
        env.read_connector_stream(spark, "text", path=root, start="latest")
