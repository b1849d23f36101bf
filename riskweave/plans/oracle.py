"""Oracle SQL (DuckDB dialect) for the compared query keys.

Each statement re-derives the payment fixture from the driver's `events`
view with the same fixed mapping as `sources/fixtures.py`, then computes the
query with plain SQL. Money is summed as DECIMAL and reported as DOUBLE;
rounded rates use exact integer half-up arithmetic, as in the Spark plans.
"""

from __future__ import annotations

from riskweave.schemas import DEVICES, MERCHANTS, RISKY_COUNTRIES


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _case(key: str, values) -> str:
    whens = " ".join(f"WHEN {i} THEN {_q(v)}" for i, v in enumerate(values))
    return f"CASE {key} {whens} END"


_USER_COUNTRY = "CASE WHEN user_id % 6 = 4 THEN 'CA' WHEN user_id % 6 = 5 THEN 'GB' ELSE 'US' END"
_FRAUD_TYPE = ("CASE WHEN k < 5 THEN 'foreign_ip' WHEN value >= 200 THEN 'large_amount' "
               "WHEN k < 20 AND value < 10 THEN 'rapid_fire' END")

PAYMENTS = f"""
ev AS (
  SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k FROM events
),
payments AS (
  SELECT
    'TXN-' || lpad(CAST(event_id AS VARCHAR), 8, '0') AS transaction_id,
    CASE WHEN event_id % 103 = 0 THEN NULL
         ELSE 'USR-' || lpad(CAST(user_id AS VARCHAR), 4, '0') END AS user_id,
    CAST(CAST(CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 101 = 0 THEN -value
                   ELSE value END AS DECIMAL(12,2)) AS DOUBLE) AS amount,
    'USD' AS currency,
    {_case('event_id % 10', [m for m, _ in MERCHANTS])} AS merchant_name,
    {_case('event_id % 10', [c for _, c in MERCHANTS])} AS merchant_category,
    {_USER_COUNTRY} AS user_country,
    CASE WHEN event_id % 107 = 0 THEN NULL
         WHEN k < 5 THEN {_case('k', RISKY_COUNTRIES)}
         ELSE {_USER_COUNTRY} END AS ip_country,
    {_case('event_id % 3', DEVICES)} AS device,
    CAST(ts AS TIMESTAMP) AS event_timestamp,
    ({_FRAUD_TYPE}) IS NOT NULL AS is_fraud,
    {_FRAUD_TYPE} AS fraud_type,
    event_id, user_id AS source_user, value
  FROM ev
)"""

AVG_SPEND = """
avg_spend AS (
  SELECT user_id AS source_user,
         CAST(SUM(CAST(value AS DECIMAL(12,2))) AS DOUBLE) / CAST(COUNT(value) AS DOUBLE) AS avg_spend
  FROM events GROUP BY user_id
),
rule_events AS (
  SELECT p.transaction_id, p.user_id, p.amount, p.currency, p.merchant_name, p.merchant_category,
         p.user_country, p.ip_country, p.device, a.avg_spend, p.event_timestamp
  FROM payments p LEFT JOIN avg_spend a ON p.source_user = a.source_user
)"""

_BUCKET = ("CASE WHEN amount < 10 THEN 'micro' WHEN amount < 100 THEN 'small' "
           "WHEN amount < 500 THEN 'medium' WHEN amount < 2000 THEN 'large' "
           "WHEN amount IS NOT NULL THEN 'very_large' END")

SILVER = f"""
silver AS (
  SELECT transaction_id, user_id, amount, currency, merchant_name, merchant_category,
         user_country, ip_country, device, event_timestamp, is_fraud, fraud_type,
         'silver' AS ingestion_layer,
         CAST(event_timestamp AS DATE) AS event_date,
         COALESCE(user_country <> ip_country, FALSE) AS country_mismatch,
         {_BUCKET} AS amount_bucket,
         CAST(hour(event_timestamp) AS INTEGER) AS event_hour,
         source_user, event_id
  FROM payments
  WHERE transaction_id IS NOT NULL AND user_id IS NOT NULL AND amount IS NOT NULL
    AND NOT isnan(amount) AND amount > 0
)"""


def with_ctes(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n" + body


def half_up(num: str, den: str, factor: int = 100, digits: int = 2) -> str:
    """round(factor * num / den, digits), half away from zero, exact integer math."""
    p = 10 ** digits
    f2 = 2 * factor * p
    mag = f"((abs(CAST({num} AS BIGINT)) * {f2} + CAST({den} AS BIGINT)) // (2 * CAST({den} AS BIGINT)))"
    return (f"CASE WHEN CAST({den} AS BIGINT) > 0 THEN "
            f"CAST(CASE WHEN CAST({num} AS BIGINT) < 0 THEN -{mag} ELSE {mag} END AS DOUBLE) / {float(p)} END")


def spike(amount: str, avg: str, k: float = 3.0) -> str:
    """amount / avg > k with float-ratio semantics, without dividing."""
    return (f"COALESCE({amount} IS NOT NULL AND {avg} IS NOT NULL AND NOT isnan({amount}) "
            f"AND NOT isnan({avg}) AND CASE WHEN {avg} >= 0 THEN {amount} > {float(k)} * {avg} "
            f"ELSE {amount} < {float(k)} * {avg} END, FALSE)")


def reason(v: str = "flag_velocity", s: str = "flag_spike", g: str = "flag_geography") -> str:
    return (f"NULLIF(concat_ws(', ', CASE WHEN {v} THEN 'velocity' END, "
            f"CASE WHEN {s} THEN 'amount_spike' END, CASE WHEN {g} THEN 'foreign_ip' END), '')")


def round_avg_money(c: str = "amount") -> str:
    cents = f"CAST(SUM(CAST({c} AS DECIMAL(12,2))) * 100 AS BIGINT)"
    n = f"COUNT({c})"
    mag = f"((abs({cents}) * 2 + {n}) // (2 * {n}))"
    return (f"CASE WHEN {n} > 0 THEN CAST(CASE WHEN {cents} < 0 THEN -{mag} ELSE {mag} END AS DOUBLE)"
            f" / 100.0 END")


def money_sum(c: str = "amount") -> str:
    return f"CAST(SUM(CAST({c} AS DECIMAL(12,2))) AS DOUBLE)"


def money_avg(c: str = "amount") -> str:
    return f"CAST(SUM(CAST({c} AS DECIMAL(12,2))) AS DOUBLE) / CAST(COUNT({c}) AS DOUBLE)"
