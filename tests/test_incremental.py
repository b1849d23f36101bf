"""Incremental profiles, window counts of hot users, sketches and compaction."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.operators import profile_state as PS, rules, sketches as SS, warehouse as WH
from riskweave.plans import registry as RG
from riskweave.schemas import BRONZE_LAYER_SCHEMA, BRONZE_PARTITIONS
from riskweave.session import list_folder, scratch_path
from riskweave.sources.tables import read_layer
from riskweave.streaming import compaction as CP
from tests.conftest import SF_SMALL

AS_OF = dt.datetime(2024, 1, 31)
LAYER = T.StructType([T.StructField("user_id", T.StringType()), T.StructField("amount", T.DoubleType()),
                      T.StructField("user_country", T.StringType()), T.StructField("event_date", T.DateType())])


def _land(spark, root, rows):
    (spark.createDataFrame([(u, a, c, d and dt.date(2024, 1, d)) for u, a, c, d in rows], LAYER).coalesce(1)
     .write.mode("append").partitionBy("event_date").parquet(f"{root}/layer"))


def _profiles(df):
    return sorted(map(tuple, df.select("user_id", "avg_transaction", "total_transactions", "total_spend", "first_seen",
                                       "last_seen", "home_country", "updated_at").collect()))


def _same_as_full(spark, root):
    layer = read_layer(spark, f"{root}/layer", LAYER)
    assert _profiles(PS.finished(PS.current(spark, f"{root}/state"), AS_OF)) == _profiles(WH.user_profiles(layer, AS_OF))


def _refresh(spark, root):
    return PS.refresh(spark, read_layer(spark, f"{root}/layer", LAYER), f"{root}/state")


def test_runs_read_only_new_and_changed_days(spark):
    root = scratch_path(spark, "incremental")
    _land(spark, root, [("A", 10.0, "US", 2), ("B", 5.0, "CA", 2), ("A", 0.1, "GB", 3), ("C", float("nan"), "US", 3), ("D", 1.0, None, None)])
    assert _refresh(spark, root) == {"new": ["2024-01-02", "2024-01-03", PS.NO_DAY], "changed": [], "gone": []}
    _same_as_full(spark, root)
    _land(spark, root, [("A", 7.0, "US", 4), ("E", 2.0, "US", 4)])
    assert _refresh(spark, root) == {"new": ["2024-01-04"], "changed": [], "gone": []}
    assert {r.user_id for r in PS.touched(spark, f"{root}/state").collect()} == {"A", "E"}
    _same_as_full(spark, root)
    _land(spark, root, [("B", 3.0, "ZZ", 2), ("F", 1.5, "US", 5)])  # late rows of a covered day, and a new day
    assert _refresh(spark, root) == {"new": ["2024-01-05"], "changed": ["2024-01-02"], "gone": []}
    assert {r.user_id for r in PS.touched(spark, f"{root}/state").collect()} == {"A", "B", "F"}
    _same_as_full(spark, root)
    assert _refresh(spark, root) == {"new": [], "changed": [], "gone": []}
    # a day's rows replaced by fewer: users that were only there must go
    (spark.createDataFrame([("A", 1.0, "US", dt.date(2024, 1, 4))], LAYER).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("event_date").parquet(f"{root}/layer"))
    assert _refresh(spark, root)["changed"] == ["2024-01-04"]
    _same_as_full(spark, root)
    assert "E" not in {r.user_id for r in PS.current(spark, f"{root}/state").collect()}
    assert len([n for n, *_ in list_folder(spark, f"{root}/state/runs")]) <= PS.KEPT_RUNS + 1


def test_a_dropped_day_and_an_empty_layer(spark):
    root = scratch_path(spark, "dropped")
    _land(spark, root, [("A", 1.0, "US", 2), ("B", 2.0, "US", 3)])
    _refresh(spark, root)
    layer = read_layer(spark, f"{root}/layer", LAYER)
    kept = spark.read.schema(LAYER).option("basePath", f"{root}/layer").parquet(f"{root}/layer/event_date=2024-01-02")
    assert PS.refresh(spark, kept, f"{root}/state") == {"new": [], "changed": [], "gone": ["2024-01-03"]}
    assert [r.user_id for r in PS.current(spark, f"{root}/state").collect()] == ["A"]
    assert PS.refresh(spark, layer, f"{root}/state")["new"] == ["2024-01-03"]  # it is back
    _same_as_full(spark, root)
    empty = scratch_path(spark, "empty")
    assert PS.current(spark, empty).count() == 0 and PS.touched(spark, empty).count() == 0


def test_a_run_that_broke_off_never_happened(spark, monkeypatch):
    root = scratch_path(spark, "broken")
    _land(spark, root, [("A", 1.0, "US", 2)])
    _refresh(spark, root)
    _land(spark, root, [("A", 2.0, "US", 3), ("A", 4.0, "GB", 2)])
    with monkeypatch.context() as m:
        m.setattr(PS, "merged", lambda parts: (_ for _ in ()).throw(RuntimeError("driver lost")))
        with pytest.raises(RuntimeError):
            _refresh(spark, root)
    assert PS.current(spark, f"{root}/state").first().rows == 1  # the completed run is what readers see
    assert _refresh(spark, root) == {"new": ["2024-01-03"], "changed": ["2024-01-02"], "gone": []}
    _same_as_full(spark, root)


def test_second_run_prunes_to_the_new_days(spark):
    root = scratch_path(spark, "pruned")
    _land(spark, root, [("A", 1.0, "US", d) for d in range(1, 9)])
    layer = read_layer(spark, f"{root}/layer", LAYER)
    plan = layer.filter(PS._in_days(["2024-01-08"]))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    assert len(layer.filter(PS._in_days(["2024-01-08"])).select(F.input_file_name()).distinct().collect()) == 1


# ------------------------------------------------------------- window counts
def _brute(rows, minutes):
    w = minutes * 60_000_000
    return {(u, t): sum(v == u and t - w <= x <= t for v, x in rows) for u, t in rows}


def test_window_counts_equal_brute_force_for_a_hot_user(spark):
    rng = random.Random(1)
    burst = [("hot", 1_704_844_800_000_000 + rng.choice([rng.randrange(3_000_000), rng.randrange(400_000_000), 60_000_000 * rng.randrange(5)]))
             for _ in range(900)]
    rows = burst + [(f"u{rng.randrange(9)}", 1_704_844_800_000_000 + rng.randrange(-90, 300) * 1_000_000) for _ in range(120)]
    rows += [("old", t) for t in (-1, 0, 1, -60_000_000, -60_000_001, 59_999_999)]  # about the epoch
    df = spark.createDataFrame(rows, "_u string, _t long").withColumn("event_timestamp", F.timestamp_micros("_t")).withColumnRenamed("_u", "user_id")
    for minutes in (1, 3):
        got = rules.velocity_counts(df, minutes)
        assert got.count() == len(rows)
        assert {(r.user_id, r.event_micros): r.window_count for r in got.collect()} == _brute(rows, minutes)


def test_a_hot_users_window_is_spread_over_tasks(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = spark.range(20_000).select(F.lit("hot").alias("user_id"), F.timestamp_micros(F.lit(1_704_844_800_000_000) + F.col("id") * 30_000)
                                          .alias("event_timestamp"))
        counts = rules.velocity_counts(rows, 10)
        parts = counts.groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert len(parts) >= 6 and max(r["count"] for r in parts) < 0.4 * 20_000
        assert counts.agg(F.max("window_count")).first()[0] == 20_000  # 600 s at 30 ms
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_events_and_asked_instants_may_differ(spark):
    events = spark.createDataFrame([("a", 0, 3), ("a", 30_000_000, 2), ("b", 5, 1)], "_u string, _t long, _n long")
    asked = spark.createDataFrame([("a", 60_000_000), ("a", 60_000_000), ("a", 60_000_001), ("c", 7), ("b", 4)], "_u string, _t long")
    got = {(r["_u"], r["_t"]): r.window_count for r in rules.window_counts(events, asked, 1).collect()}
    assert got == {("a", 60_000_000): 5, ("a", 60_000_001): 2, ("c", 7): 0, ("b", 4): 0}


# ------------------------------------------------------------------ sketches
def test_sketches_merge_over_days_within_their_error(spark):
    events = spark.range(60_000).select((F.col("id") % 20_000).cast("string").alias("user_id"),
                                        F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % 9).cast("int")).alias("event_date"))
    exact = {r.event_date: r.distinct_count for r in SS.trailing_distinct_exact(events, 7).collect()}
    for lg_k, errors in ((14, 3), (10, 3)):
        daily = SS.daily_sketches(events, lg_k=lg_k)
        assert daily.count() == 9
        got = {r.event_date: r.distinct_estimate for r in SS.trailing_distinct(daily, 7).collect()}
        assert got.keys() == exact.keys()
        assert all(abs(got[d] - n) <= errors * SS.standard_error(lg_k) * n for d, n in exact.items())
    nulls = spark.createDataFrame([(None, dt.date(2024, 1, 1)), ("a", dt.date(2024, 1, 3))], "user_id string, event_date date")
    assert [(r.event_date.day, r.distinct_estimate) for r in SS.trailing_distinct(SS.daily_sketches(nulls), 7).collect()] == [(3, 1)]


# ---------------------------------------------------------------- compaction
def test_compaction_packs_closed_days_and_can_be_repeated(spark):
    lake = RG._run(spark, SF_SMALL, "pack", ("bronze",))
    packed = f"{lake.root}/packed"
    args = (spark, lake.bronze, BRONZE_LAYER_SCHEMA, BRONZE_PARTITIONS, packed)
    closed = F.col("event_date") < F.lit(dt.date(2024, 1, 30))
    rows = read_layer(spark, lake.bronze, BRONZE_LAYER_SCHEMA)
    files = len(rows.inputFiles())

    def same():
        got = CP.read_compacted(*args)
        return got.exceptAll(rows).count() == 0 and rows.exceptAll(got).count() == 0

    assert same()  # nothing packed yet
    done = CP.compact(*args, closed, sort=["event_timestamp"])
    assert len(done) == 29 and same() and len(CP.read_compacted(*args).inputFiles()) <= files
    assert CP.compact(*args, closed) == []
    assert len(read_layer(spark, lake.bronze, BRONZE_LAYER_SCHEMA).inputFiles()) == files  # the stream's own are untouched
    # more files of a packed day: read from the layer until it is packed again
    RG.env.land_messages(RG.fx.raw_envelope(spark, SF_SMALL).limit(40), f"{lake.root}/landing", files=1)
    RG.M.start_bronze(spark, RG.env.read_message_stream(spark, f"{lake.root}/landing"), lake, "availableNow", 1).awaitTermination()
    rows = read_layer(spark, lake.bronze, BRONZE_LAYER_SCHEMA)
    assert same()
    again = CP.compact(*args, closed)
    assert 0 < len(again) <= 29 and same()
    assert CP.retire(spark, packed) in ([], ["run=1"]) and same()


def test_compaction_cuts_a_large_partition_by_bytes(spark):
    root = scratch_path(spark, "large")
    schema = T.StructType([T.StructField("v", T.StringType()), T.StructField("event_date", T.DateType())])
    rows = spark.range(4000).select(F.sha2(F.col("id").cast("string"), 256).alias("v"), F.lit(dt.date(2024, 1, 1)).alias("event_date"))
    rows.repartition(40).write.partitionBy("event_date").parquet(f"{root}/layer")
    size = sum(s for _, _, s, _ in list_folder(spark, f"{root}/layer/event_date=2024-01-01"))
    CP.compact(spark, f"{root}/layer", schema, ("event_date",), f"{root}/packed", F.lit(True), target_bytes=size // 3)
    got = CP.read_compacted(spark, f"{root}/layer", schema, ("event_date",), f"{root}/packed")
    assert 2 <= len(got.inputFiles()) <= 4 and got.distinct().count() == 4000
