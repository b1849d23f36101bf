"""The payment fixture reproduces the totals FIXTURES.md documents at sf0.01."""

from pyspark.sql import functions as F

from riskweave.sources import fixtures as fx
from tests.conftest import SF_CHECK


def test_fixture_totals_sf001(spark):
    pe = fx.payment_events(spark, SF_CHECK)
    r = pe.agg(F.count(F.lit(1)).alias("n"),
               F.sum(F.col("amount").cast("decimal(12,2)")).alias("amount"),
               F.count("user_id").alias("users"), F.count("ip_country").alias("ips"),
               F.count_if("is_fraud").alias("labelled"),
               F.count_if(F.col("fraud_type") == "foreign_ip").alias("foreign_ip"),
               F.count_if(F.col("fraud_type") == "large_amount").alias("large_amount"),
               F.count_if(F.col("fraud_type") == "rapid_fire").alias("rapid_fire")).first()
    assert (r.n, str(r.amount), r.users, r.ips) == (10000, "480540.82", 9902, 9906)
    assert (r.labelled, r.foreign_ip, r.large_amount, r.rapid_fire) == (937, 494, 164, 279)
