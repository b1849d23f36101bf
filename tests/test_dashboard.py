"""Dashboard queries Q1-Q7 on literal frames (FIXTURES §4 edge rows)."""

import datetime as dt

from pyspark.sql import functions as F

from riskweave.functions.expressions import half_up_ratio, minute_boundaries
from riskweave.plans import dashboard as Q

AS_OF = dt.datetime(2024, 1, 31, 0, 0, 0)
SILVER = ("transaction_id string, user_id string, amount double, event_timestamp timestamp, "
          "event_date date, event_hour int, is_fraud boolean, country_mismatch boolean, "
          "user_country string, ip_country string")
FLAGGED = ("transaction_id string, user_id string, amount double, merchant_name string, "
           "merchant_category string, user_country string, ip_country string, event_timestamp timestamp, "
           "event_date date, fraud_type string, fraud_reason string, flagged_at timestamp")


def _silver(spark, rows):
    out = []
    for i, (t, amount, fraud, *rest) in enumerate(rows):
        mm = rest[0] if rest else False
        uc, ic = (rest[1], rest[2]) if len(rest) > 2 else ("US", "US")
        out.append((f"t{i}", "u", amount, t, t.date(), t.hour, fraud, mm, uc, ic))
    return spark.createDataFrame(out, SILVER)


def test_half_up_rounding_ties(spark):
    # 1/8 = 12.5 % exactly -> stays; 1/200 = 0.5 % ; 1/3 -> 33.33 ; 2/3 -> 66.67 ; -1/8 -> -12.5
    df = spark.createDataFrame([(1, 8), (1, 200), (1, 3), (2, 3), (-1, 8), (1, 0), (1, 80000)],
                               "n long, d long")
    got = [r[0] for r in df.select(half_up_ratio(F.col("n"), F.col("d"))).collect()]
    assert got == [12.5, 0.5, 33.33, 66.67, -12.5, None, 0.0]
    df2 = spark.createDataFrame([(1, 160000)], "n long, d long")  # 0.000625 % -> 0.0; 1/16000 = .00625 -> .01
    assert df2.select(half_up_ratio(F.col("n"), F.col("d"))).first()[0] == 0.0
    df3 = spark.createDataFrame([(1, 16000)], "n long, d long")
    assert df3.select(half_up_ratio(F.col("n"), F.col("d"))).first()[0] == 0.01


def test_daily_summary_bounds_and_values(spark):
    rows = [(dt.datetime(2024, 1, 1, 5), 10.0, True), (dt.datetime(2024, 1, 1, 6), 30.0, False),
            (dt.datetime(2023, 12, 31, 23), 99.0, True), (dt.datetime(2023, 12, 1), 5.0, False)]
    out = Q.daily_fraud_summary(_silver(spark, rows), AS_OF).collect()
    assert [r.event_date for r in out] == [dt.date(2024, 1, 1)]  # as_of - 30 days = Jan 1
    r = out[0]
    assert (r.total_transactions, r.fraud_count, r.fraud_rate_pct) == (2, 1, 50.0)
    assert (r.total_volume, r.fraud_volume, r.avg_transaction) == (40.0, 10.0, 20.0)


def test_hourly_is_yesterday_only(spark):
    rows = [(dt.datetime(2024, 1, 30, 0, 1), 1.01, True), (dt.datetime(2024, 1, 30, 0, 2), 1.0, False),
            (dt.datetime(2024, 1, 29, 23, 59), 3.0, True), (dt.datetime(2024, 1, 31, 0, 0), 3.0, True)]
    out = Q.hourly_fraud_rate(_silver(spark, rows), AS_OF).collect()
    assert len(out) == 1 and out[0].event_hour == 0 and out[0].total_transactions == 2
    # exact cent average (1.01 + 1.00) / 2 = 1.005 rounds half up to 1.01
    assert out[0].avg_amount == 1.01 and out[0].fraud_rate_pct == 50.0


def test_country_mismatch_share_before_limit(spark):
    t = dt.datetime(2024, 1, 5)
    rows = ([(t, 10.0, False, True, "US", "RU")] * 3 + [(t, 10.0, False, True, "US", "CN")]
            + [(t, 10.0, False, False, "US", "US")] * 10)
    out = {r.ip_country: r for r in Q.country_mismatch_analysis(_silver(spark, rows), k=1).collect()}
    assert list(out) == ["RU"] and out["RU"].pct_of_user_country_txns == 75.0


def _flagged(spark, rows):
    out = []
    for i, (user, t, amount, ftype, flagged_at) in enumerate(rows):
        out.append((f"t{i:03d}", user, amount, "m", "retail", "US", "US", t, t.date(), ftype,
                    "velocity", flagged_at or t))
    return spark.createDataFrame(out, FLAGGED)


def test_high_risk_users(spark):
    t = dt.datetime(2024, 1, 10, 23, 59)
    rows = [("A", t, 10.0, "rapid_fire", None), ("A", t + dt.timedelta(minutes=2), 5.0, None, None),
            ("B", t, 1.0, "foreign_ip", None)]  # B has one flag -> dropped by HAVING
    rows += [(f"U{i:02d}", t, 1.0, "large_amount", None) for i in range(25) for _ in range(2)]
    profiles = spark.createDataFrame([("U00", 12.34, "US")],
                                     "user_id string, avg_transaction double, home_country string")
    out = Q.high_risk_users(_flagged(spark, rows), profiles).collect()
    assert len(out) == 20
    users = [r.user_id for r in out]
    assert users[0] == "A" and "B" not in users
    assert users[1:] == [f"U{i:02d}" for i in range(19)]  # ties broken by user_id
    a = out[0]
    assert a.fraud_flag_count == 2 and a.distinct_fraud_types == 1  # null type not counted
    assert a.days_active == 1 and a.normal_avg_spend is None  # crosses midnight; no profile
    assert out[1].normal_avg_spend == 12.34 and out[1].home_country == "US"


def test_recent_alerts_window_and_minutes(spark):
    now = dt.datetime(2024, 1, 30, 12, 0, 0)
    ago = [dt.timedelta(minutes=14, seconds=59), dt.timedelta(minutes=15), dt.timedelta(minutes=15, seconds=1),
           dt.timedelta(seconds=61), -dt.timedelta(minutes=5)]
    rows = [("A", now - d, 1.0, None, now - d) for d in ago]
    out = {r.transaction_id: r.minutes_ago for r in Q.recent_fraud_alerts(_flagged(spark, rows), now).collect()}
    assert sorted(out) == ["t000", "t001", "t003", "t004"]  # 15:01 old is out, future row is in
    assert out["t000"] == 15 and out["t001"] == 15 and out["t003"] == 2 and out["t004"] == -5


def test_minute_boundaries(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 59), dt.datetime(2024, 1, 1, 0, 1, 1))],
                               "a timestamp, b timestamp")
    assert df.select(minute_boundaries("a", "b")).first()[0] == 1


def test_weekly_trend_lag_and_nullif(spark):
    mon = dt.datetime(2024, 1, 1, 12)  # a Monday
    rows = ([(mon, 10.0, True)] * 2 + [(mon + dt.timedelta(days=7), 10.0, False)]
            + [(mon + dt.timedelta(days=21), 10.0, True)] * 3)  # week 3 missing
    out = Q.weekly_fraud_trend(_silver(spark, rows)).collect()
    by = {r.week_start: r for r in out}
    assert [r.week_start for r in out] == [dt.date(2024, 1, 22), dt.date(2024, 1, 8), dt.date(2024, 1, 1)]
    assert by[dt.date(2024, 1, 1)].prev_week_fraud is None and by[dt.date(2024, 1, 1)].wow_change_pct is None
    assert by[dt.date(2024, 1, 8)].prev_week_fraud == 2 and by[dt.date(2024, 1, 8)].wow_change_pct == -100.0
    assert by[dt.date(2024, 1, 22)].prev_week_fraud == 0 and by[dt.date(2024, 1, 22)].wow_change_pct is None


def test_category_window_prunes_partitions(spark, tmp_path):
    t = dt.datetime(2024, 1, 29)
    df = _flagged(spark, [("A", t, 1.0, "x", None), ("A", dt.datetime(2024, 1, 1), 1.0, "x", None)])
    path = str(tmp_path / "fraud")
    df.write.partitionBy("event_date").parquet(path)
    q = Q.fraud_by_category_type(spark.read.parquet(path), AS_OF)
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "event_date" in plan
    assert q.collect()[0].fraud_count == 1


def test_rates_and_averages_are_exact_at_scale(spark):
    from fractions import Fraction
    from riskweave.functions import expressions as E
    cases = [(2217708456216, 2766363069706), (1, 3), (999_999_999_999_999, 1_000_000_000_000_000), (5 * 10 ** 14, 7 * 10 ** 14),
             (0, 5), (-2217708456216, 2766363069706)]
    df = spark.createDataFrame(cases, "n long, d long")

    def half_up(x):
        return (1 if x >= 0 else -1) * float(int(abs(x) * 100 + Fraction(1, 2))) / 100

    got = df.select("n", "d", E.half_up_ratio(df.n, df.d).alias("r")).collect()
    assert [r.r for r in got] == [half_up(Fraction(r.n * 100, r.d)) for r in got]
    assert spark.createDataFrame([(1, 0)], "n long, d long").select(
        E.half_up_ratio(F.col("n"), F.col("d")).alias("r")).first().r is None


def test_poison_amounts_fail_no_aggregate(spark):
    from riskweave.functions import expressions as E
    df = spark.createDataFrame([(5.0,), (float("inf"),), (1e11,), (float("nan"),), (None,)], "amount double")
    r = df.select(E.money_sum().alias("s"), E.money_avg().alias("a"), E.round_avg_money().alias("m")).first()
    assert (r.s, r.a, r.m) == (5.0, 5.0, 5.0)
