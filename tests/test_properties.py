"""Property tests: velocity counts and users against a brute-force count
on random event sets (many ties, bursts, bucket and chunk edges)."""

import datetime as dt

from hypothesis import HealthCheck, given, settings, strategies as st

from riskweave.operators import rules

T0 = dt.datetime(2024, 1, 10, 0, 0, 0)

events = st.lists(st.tuples(st.sampled_from(["A", "B", "C"]),
                            st.integers(min_value=0, max_value=5400),
                            st.integers(min_value=0, max_value=2)),  # sub-second jitter: 0, 0.5 s, 1 us
                  min_size=1, max_size=60)


def _brute(rows, w_us):
    out = {}
    for i, (u, t) in enumerate(rows):
        out[i] = sum(1 for (u2, t2) in rows if u2 == u and t - w_us <= t2 <= t)
    return out


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(evs=events, minutes=st.sampled_from([1, 5, 10, 60]), limit=st.sampled_from([1, 2, 5]))
def test_velocity_matches_brute_force(spark, evs, minutes, limit):
    jitter = {0: 0, 1: 500_000, 2: 1}
    rows = [(u, int((s * 1_000_000) + jitter[j])) for u, s, j in evs]
    df = spark.createDataFrame(
        [(f"t{i}", u, T0 + dt.timedelta(microseconds=t)) for i, (u, t) in enumerate(rows)],
        "transaction_id string, user_id string, event_timestamp timestamp")
    want = _brute(rows, minutes * 60_000_000)
    got = {r.transaction_id: r.window_count for r in
           rules.velocity_counts(df, minutes, carry=("transaction_id",)).collect()}
    assert {int(k[1:]): v for k, v in got.items()} == want
    users = {r.user_id for r in rules.rule_velocity(df, minutes, limit).collect()}
    assert users == {rows[i][0] for i, n in want.items() if n > limit}


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(evs=st.lists(st.tuples(st.sampled_from(["A", "B"]), st.integers(min_value=0, max_value=20000),
                              st.integers(min_value=1, max_value=99999)), min_size=1, max_size=40),
       chunk=st.sampled_from([1, 60, 3600]))
def test_prior_average_matches_brute_force(spark, evs, chunk):
    rows = [(f"t{i:03d}", u, T0 + dt.timedelta(seconds=s), c / 100) for i, (u, s, c) in enumerate(evs)]
    df = spark.createDataFrame(rows, "transaction_id string, user_id string, event_timestamp timestamp, "
                                     "amount double")
    got = {r.transaction_id: (r.prior_count, r.prior_sum) for r in
           rules.prior_average(df, chunk_seconds=chunk).collect()}
    for tid, u, t, a in rows:
        before = [b for (tid2, u2, t2, b) in rows if u2 == u and (t2, tid2) < (t, tid)]
        cents = sum(round(b * 100) for b in before)
        assert got[tid][0] == len(before)
        assert round(got[tid][1] * 100) == cents
