"""C1-C3: parse, clean/enrich, label filter on literal frames (FIXTURES §4)."""

import datetime as dt
import json

from riskweave.functions.expressions import amount_bucket, country_mismatch
from riskweave.operators import layers
from riskweave.schemas import ENVELOPE_SCHEMA, PAYMENT_SCHEMA

ARRIVAL = dt.datetime(2024, 1, 5, 12, 0, 0)


def _envelope(spark, payloads):
    rows = [(p.encode() if isinstance(p, str) else p, ARRIVAL, "shardId-0") for p in payloads]
    return spark.createDataFrame(rows, ENVELOPE_SCHEMA)


def _valid(**over):
    d = {"transaction_id": "t1", "user_id": "USR-0001", "amount": 12.5, "currency": "USD",
         "merchant_name": "Uber", "merchant_category": "transport", "user_country": "US",
         "ip_country": "US", "device": "mobile", "timestamp": "2024-01-05T10:15:30.123456+00:00",
         "is_fraud": False, "fraud_type": None}
    d.update(over)
    return json.dumps(d)


def test_parse_to_bronze_edge_cases(spark):
    raw = _envelope(spark, [
        _valid(),
        "garbage text",
        _valid(transaction_id="t3", amount="x5"),
        _valid(transaction_id="t4", user_id=42),
        _valid(transaction_id="t5", extra_key="ignored"),
        _valid(transaction_id="t6", timestamp="not a time"),
    ])
    out = {r["transaction_id"]: r for r in layers.parse_to_bronze(raw).collect()}
    assert len(out) == 6  # garbage row kept with null id
    ok = out["t1"]
    assert ok["event_timestamp"] == dt.datetime(2024, 1, 5, 10, 15, 30, 123456)
    assert ok["event_date"] == dt.date(2024, 1, 5)
    assert ok["ingestion_layer"] == "bronze"
    assert ok["kinesis_arrival_time"] == ARRIVAL and ok["shard_id"] == "shardId-0"
    bad = out[None]
    assert all(bad[c] is None for c in [f.name for f in PAYMENT_SCHEMA.fields])
    assert bad["event_timestamp"] is None
    assert out["t3"]["amount"] is None and out["t3"]["user_id"] == "USR-0001"
    assert out["t4"]["user_id"] == "42"
    assert "extra_key" not in layers.parse_to_bronze(raw).columns
    assert out["t6"]["event_timestamp"] is None and out["t6"]["timestamp"] == "not a time"


BASE_SCHEMA = ("transaction_id string, user_id string, amount double, user_country string, "
               "ip_country string, timestamp string, is_fraud boolean, fraud_type string")


def _bronze(spark, rows):
    cols = [c.split()[0] for c in BASE_SCHEMA.split(", ")]
    df = spark.createDataFrame([tuple(r[c] for c in cols) for r in rows], BASE_SCHEMA)
    return layers.stamp_bronze(df)


BASE = dict(transaction_id="t", user_id="u", amount=5.0, user_country="US", ip_country="US",
            timestamp="2024-01-05T23:30:00+00:00", is_fraud=False, fraud_type=None)


def test_silver_drops_bad_keys_and_amounts(spark):
    rows = []
    for i, over in enumerate([{}, {"transaction_id": None}, {"user_id": None}, {"amount": None},
                              {"amount": 0.0}, {"amount": -1.0}, {"amount": float("nan")}]):
        r = dict(BASE, **over)
        if r["transaction_id"] is not None:
            r["transaction_id"] = f"t{i}"
        rows.append(r)
    silver = layers.transform_to_silver(_bronze(spark, rows))
    assert [r.transaction_id for r in silver.collect()] == ["t0"]
    r = silver.first()
    assert r.event_hour == 23 and r.event_date == dt.date(2024, 1, 5) and r.ingestion_layer == "silver"


def test_amount_bucket_edges(spark):
    amounts = [9.99, 10.0, 99.99, 100.0, 499.99, 500.0, 1999.99, 2000.0, 0.01]
    df = spark.createDataFrame([(a,) for a in amounts], "amount double")
    got = [r[0] for r in df.select(amount_bucket()).collect()]
    assert got == ["micro", "small", "small", "medium", "medium", "large", "large", "very_large", "micro"]


def test_country_mismatch_nulls(spark):
    df = spark.createDataFrame([("US", "US"), ("US", "RU"), (None, "RU"), ("US", None), (None, None)],
                               "user_country string, ip_country string")
    assert [r[0] for r in df.select(country_mismatch()).collect()] == [False, True, False, False, False]


def test_normalize_country_option(spark):
    rows = [dict(BASE, transaction_id="a", user_country=" us", ip_country="US")]
    plain = layers.transform_to_silver(_bronze(spark, rows)).first()
    norm = layers.transform_to_silver(_bronze(spark, rows), normalize_country=True).first()
    assert plain.country_mismatch is True and plain.user_country == " us"
    assert norm.country_mismatch is False and norm.user_country == "US"


def test_label_filter_drops_false_and_null(spark):
    rows = [dict(BASE, transaction_id="a", is_fraud=True, fraud_type="rapid_fire"),
            dict(BASE, transaction_id="b", is_fraud=False),
            dict(BASE, transaction_id="c", is_fraud=None)]
    fraud = layers.filter_fraud(layers.transform_to_silver(_bronze(spark, rows)))
    assert [r.transaction_id for r in fraud.collect()] == ["a"]


def test_plans_are_map_only(spark):
    from tests.conftest import SF_SMALL
    from riskweave.plans import registry
    plan = registry.q_silver_clean(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan  # cleaning is a pure projection/filter
