"""The Spark SQL form of each dashboard equals its DataFrame plan."""

import pytest

from riskweave.plans import dashboard as Q
from riskweave.plans import registry as RG
from riskweave.plans import sql as S
from riskweave.operators import warehouse as WH
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def views(spark):
    silver = RG.silver_frame(spark, SF_SMALL)
    flagged = RG.flagged_frame(spark, SF_SMALL)
    profiles = WH.user_profiles(silver, RG.AS_OF)
    for name, df in (("v_silver", silver), ("v_flagged", flagged), ("v_profiles", profiles)):
        df.createOrReplaceTempView(name)
    return {"silver": "v_silver", "flagged": "v_flagged", "profiles": "v_profiles"}, silver, flagged, profiles


@pytest.mark.parametrize("name", S.NAMES)
def test_sql_equals_dataframe(spark, views, name):
    tables, silver, flagged, profiles = views
    as_of = RG.ALERT_AS_OF if name == "recent_fraud_alerts" else RG.AS_OF
    df = {
        "daily_fraud_summary": lambda: Q.daily_fraud_summary(silver, as_of),
        "fraud_by_category_type": lambda: Q.fraud_by_category_type(flagged, as_of),
        "high_risk_users": lambda: Q.high_risk_users(flagged, profiles),
        "hourly_fraud_rate": lambda: Q.hourly_fraud_rate(silver, as_of),
        "country_mismatch_analysis": lambda: Q.country_mismatch_analysis(silver),
        "recent_fraud_alerts": lambda: Q.recent_fraud_alerts(flagged, as_of),
        "weekly_fraud_trend": lambda: Q.weekly_fraud_trend(silver),
    }[name]()
    sq = S.run_dashboard(spark, name, as_of, tables)
    assert sq.columns == df.columns
    assert [tuple(r) for r in sq.collect()] == [tuple(r) for r in df.collect()]  # same order too
