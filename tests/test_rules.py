"""R1-R3, C4, R2c on literal frames, plus brute-force checks on the driver data."""

import datetime as dt
import itertools

import pytest
from pyspark.sql import functions as F

from riskweave.functions.expressions import fraud_reason
from riskweave.operators import rules
from riskweave.sources import fixtures as fx
from tests.conftest import SF_CHECK

T0 = dt.datetime(2024, 1, 10, 12, 0, 0)
EV_SCHEMA = ("transaction_id string, user_id string, event_timestamp timestamp, amount double, "
             "avg_spend double, user_country string, ip_country string")


def _events(spark, rows):
    full = []
    for i, r in enumerate(rows):
        user, t = r[0], r[1]
        amount = r[2] if len(r) > 2 else 10.0
        avg = r[3] if len(r) > 3 else 100.0
        full.append((f"t{i:03d}", user, t, amount, avg, "US", "US"))
    return spark.createDataFrame(full, EV_SCHEMA)


def _users(df, **kw):
    return sorted(r.user_id for r in rules.rule_velocity(df, **kw).collect())


def _sec(s, us=0):
    return T0 + dt.timedelta(seconds=s, microseconds=us)


def test_velocity_edges(spark):
    rows = ([("A", _sec(0))] + [("A", _sec(600 - i)) for i in range(5)]          # edge: in
            + [("B", _sec(0))] + [("B", _sec(600 - i, 1)) for i in range(5)]     # 1 us past: out
            + [("C", _sec(0))] * 6                                               # ties
            + [("D", _sec(3600 * 24 * i)) for i in range(6)])                    # far apart
    assert _users(_events(spark, rows)) == ["A", "C"]


def test_velocity_five_vs_six(spark):
    five = [("A", _sec(60 * i)) for i in range(5)]
    six = [("B", _sec(60 * i)) for i in range(6)]
    assert _users(_events(spark, five + six)) == ["B"]


def test_velocity_window_bounds_inclusive(spark):
    # 6th event exactly +10 min after the first: inside [t-10min, t]
    at_edge = [("A", _sec(0))] + [("A", _sec(600 - i)) for i in range(5)]
    # 6th event 1 microsecond later: the first falls out
    past_edge = [("B", _sec(0))] + [("B", _sec(600 - i, 1)) for i in range(5)]
    assert _users(_events(spark, at_edge + past_edge)) == ["A"]


def test_velocity_ties_counted(spark):
    tied = [("A", _sec(0))] * 6
    assert _users(_events(spark, tied)) == ["A"]


def test_velocity_crosses_bucket_boundary(spark):
    # bursts straddling a 10-minute bucket edge (buckets start at whole windows)
    start = dt.datetime(2024, 1, 10, 12, 7, 0)
    rows = [("A", start + dt.timedelta(minutes=i)) for i in range(6)]  # 12:07 .. 12:12
    assert _users(_events(spark, rows)) == ["A"]


def test_velocity_nulls_ignored(spark):
    rows = [(None, _sec(i)) for i in range(10)] + [("A", None)] * 10 + [("A", _sec(0))]
    assert _users(_events(spark, rows)) == []


def test_velocity_flags_all_rows_of_user(spark):
    early = [("A", _sec(-3600 * 5))]  # hours before the burst
    burst = [("A", _sec(30 * i)) for i in range(6)]
    other = [("B", _sec(0))]
    out = rules.apply_fraud_rules(_events(spark, early + burst + other))
    flags = {r.transaction_id: r.flag_velocity for r in out.collect()}
    assert flags["t000"] is True  # the earlier row of a flagged user
    assert sum(flags.values()) == 7 and flags["t007"] is False


def test_velocity_custom_params(spark):
    rows = [("A", _sec(3600 * i)) for i in range(9)]  # 9 events in 8 hours
    df = _events(spark, rows)
    assert _users(df, window_minutes=1440, max_txns=8) == ["A"]
    assert _users(df, window_minutes=1440, max_txns=9) == []


@pytest.mark.parametrize("minutes", [10, 1440])
def test_velocity_counts_equal_brute_force(spark, minutes):
    """Counts == self-join count on the driver events."""
    ev = fx.rule_events(spark, SF_CHECK).filter("user_id IS NOT NULL")
    got = {(r.user_id, r.event_micros): r.window_count
           for r in rules.velocity_counts(ev, minutes).collect()}
    a = ev.select("user_id", F.unix_micros("event_timestamp").alias("t"))
    b = a.select(F.col("user_id").alias("u2"), F.col("t").alias("t2"))
    w = minutes * 60_000_000
    brute = (a.join(b, (a.user_id == b.u2) & (b.t2 <= a.t) & (b.t2 >= a.t - w))
             .groupBy("user_id", "t").count().collect())
    assert len(got) == len(brute)
    assert all(got[(r.user_id, r.t)] == r["count"] for r in brute)


def test_spike_edges(spark):
    rows = [(30.0, 10.0), (30.01, 10.0), (5.0, 0.0), (0.0, 0.0), (5.0, None), (5.0, -1.0),
            (-10.0, -1.0), (None, 1.0), (float("nan"), 1.0), (5.0, float("nan"))]
    df = spark.createDataFrame(rows, "amount double, avg double")
    got = [r[0] for r in df.select(rules.spike_predicate(F.col("amount"), F.col("avg"))).collect()]
    # ratio 3 no; above yes; x/0 inf yes; 0/0 NaN no; null no; negative ratio no;
    # (-10)/(-1)=10 yes; null/NaN never
    assert got == [False, True, True, False, False, False, True, False, False, False]


def test_geography_nulls(spark):
    df = spark.createDataFrame([("t1", "US", "US"), ("t2", "US", "RU"), ("t3", None, "RU"),
                                ("t4", "US", None), ("t5", None, None)],
                               "transaction_id string, user_country string, ip_country string")
    assert sorted(r[0] for r in rules.rule_geography(df).collect()) == ["t2", "t3", "t4", "t5"]


def test_fraud_reason_all_combinations(spark):
    combos = list(itertools.product([False, True], repeat=3))
    df = spark.createDataFrame(combos, "flag_velocity boolean, flag_spike boolean, flag_geography boolean")
    got = [r[0] for r in df.select(fraud_reason()).collect()]
    names = ["velocity", "amount_spike", "foreign_ip"]
    want = [", ".join(n for n, f in zip(names, c) if f) or None for c in combos]
    assert got == want


def test_duplicate_ids_share_flags(spark):
    rows = [("dup", "A", T0, 500.0, 100.0, "US", "US"), ("dup", "A", T0, 5.0, 100.0, "US", "US"),
            ("one", "B", T0, 5.0, 100.0, "US", "US")]
    df = spark.createDataFrame(rows, EV_SCHEMA)
    per_row = {(r.transaction_id, r.amount): r.flag_spike
               for r in rules.apply_fraud_rules(df, unique_ids=True).collect()}
    shared = {(r.transaction_id, r.amount): r.flag_spike
              for r in rules.apply_fraud_rules(df).collect()}
    assert per_row[("dup", 5.0)] is False and shared[("dup", 5.0)] is True
    assert shared[("one", 5.0)] is False


def test_flagged_table_shape(spark):
    burst = [("A", _sec(30 * i), 5.0) for i in range(6)] + [("B", _sec(0), 5.0)]
    det = rules.apply_fraud_rules(_events(spark, burst))
    out = rules.flagged_transactions(det, as_of=dt.datetime(2024, 1, 11))
    assert out.columns == rules.FLAGGED_COLUMNS
    rows = out.collect()
    assert len(rows) == 6 and {r.fraud_reason for r in rows} == {"velocity"}
    assert {r.flagged_at for r in rows} == {dt.datetime(2024, 1, 11)}


def test_prior_average_equals_window(spark):
    """Chunked prefix sums == one whole-history window, with tiny chunks so a
    user spans many chunks."""
    from riskweave.plans.registry import silver_frame
    from pyspark.sql import Window as W
    silver = silver_frame(spark, SF_CHECK)
    got = {r.transaction_id: (r.prior_count, r.prior_sum)
           for r in rules.prior_average(silver, chunk_seconds=3600).collect()}
    w = (W.partitionBy("user_id").orderBy("event_timestamp", "transaction_id")
         .rowsBetween(W.unboundedPreceding, -1))
    ref = silver.select("transaction_id", F.count("amount").over(w).alias("n"),
                        F.sum(F.col("amount").cast("decimal(12,2)")).over(w).cast("double").alias("s"))
    rows = ref.collect()
    assert len(rows) == len(got)
    for r in rows:
        n, s = got[r.transaction_id]
        assert n == r.n and (s == r.s or (r.s is None and s == 0.0))


def test_rolling_spike_first_transaction_not_flagged(spark):
    rows = [("A", _sec(0), 1000.0), ("A", _sec(60), 10.0), ("A", _sec(120), 40.0), ("A", _sec(180), 76.0)]
    out = rules.rule_spike_vs_rolling_avg(_events(spark, rows)).orderBy("event_timestamp").collect()
    # priors: none, 1000, 505, 350 -> only none flagged? 1000 has no prior -> no
    assert [r.flag_spike_rolling for r in out] == [False, False, False, False]
    rows2 = [("B", _sec(0), 10.0), ("B", _sec(60), 31.0), ("B", _sec(120), 30.0)]
    out2 = rules.rule_spike_vs_rolling_avg(_events(spark, rows2)).orderBy("event_timestamp").collect()
    assert [r.flag_spike_rolling for r in out2] == [False, True, False]


def test_velocity_plan_shuffles_narrow_rows_only(spark):
    ev = fx.rule_events(spark, SF_CHECK)
    plan = rules.rule_velocity(ev, 10, 5)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_u" in plan  # exchange keyed by (user, bucket)


def _jobs(spark, build):
    """Spark jobs that `build` starts."""
    spark.sparkContext.setJobGroup("count-jobs", "jobs started while building a frame")
    try:
        build()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup("count-jobs"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_building_rules_runs_no_job(spark):
    ev = fx.rule_events(spark, SF_CHECK)
    assert _jobs(spark, lambda: rules.apply_fraud_rules(ev, 1440, 8)) == 0


def test_velocity_users_equal_brute_force_on_random_bursts(spark):
    import random
    rng = random.Random(5)
    rows = []
    for u in range(400):
        t = 0
        for _ in range(rng.randrange(1, 16)):
            t += rng.choice([0, 1, 20, 90, 300, 599, 600, 1200])
            rows.append((f"u{u}", _sec(t)))
    for limit in (1, 5):
        want = sorted({u for u, t in rows if sum(1 for v, s in rows if v == u and t - dt.timedelta(minutes=10) <= s <= t) > limit})
        assert _users(_events(spark, rows), max_txns=limit) == want


def test_velocity_windows_hold_few_rows_of_a_hot_user(spark):
    rows = [("hot", _sec(i % 300)) for i in range(4000)] + [("calm", _sec(60 * i)) for i in range(30)]
    df = _events(spark, rows)
    assert _users(df) == ["calm", "hot"]
    plan = rules.rule_velocity(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan and plan.index("Window") < plan.index("LeftSemi")


def test_rows_without_id_keep_their_flags(spark):
    ev = _events(spark, [("A", _sec(0), 500.0)]).withColumn("transaction_id", F.lit(None).cast("string"))
    assert rules.apply_fraud_rules(ev).first().flag_spike is True
