"""Column expressions shared by operators and queries.

All are built-in Spark expressions (whole-stage codegen, no Python UDF).
Rounded rates use exact integer half-up arithmetic so that every engine that
evaluates the same integers gets the same double.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from riskweave.schemas import (AMOUNT_BUCKET_TOP, AMOUNT_BUCKETS, REASON_SEPARATOR,
                               REASON_TOKENS)


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def amount_bucket(amount="amount") -> Column:
    """micro < 10 <= small < 100 <= medium < 500 <= large < 2000 <= very_large."""
    a = col(amount)
    expr = None
    for upper, name in AMOUNT_BUCKETS:
        expr = F.when(a < upper, F.lit(name)) if expr is None else expr.when(a < upper, F.lit(name))
    return expr.when(a.isNotNull(), F.lit(AMOUNT_BUCKET_TOP))


def country_mismatch(user_country="user_country", ip_country="ip_country") -> Column:
    """Silver flag: countries differ; a missing side counts as *no* mismatch."""
    return F.coalesce(col(user_country) != col(ip_country), F.lit(False))


def geography_mismatch(user_country="user_country", ip_country="ip_country") -> Column:
    """Rule flag: countries differ; a missing side counts as a mismatch."""
    return F.coalesce(col(user_country) != col(ip_country), F.lit(True))


def fraud_reason(velocity="flag_velocity", spike="flag_spike", geography="flag_geography") -> Column:
    """Names of the triggered rules in fixed order joined by ', '; null if none."""
    parts = [F.when(col(c), F.lit(tok)) for c, tok in zip((velocity, spike, geography), REASON_TOKENS)]
    return F.nullif(F.concat_ws(REASON_SEPARATOR, *parts), F.lit(""))


def money(c="amount") -> Column:
    """Cent-exact decimal view of a money column (for exact sums); null where
    the amount is not finite or has more digits than DECIMAL(12,2) holds."""
    return col(c).try_cast("decimal(12,2)")


def money_sum(c="amount") -> Column:
    """Exact decimal sum of money, reported as one double."""
    return F.sum(money(c)).cast("double")


def money_avg(c="amount") -> Column:
    """Average of money: exact decimal sum divided once in double; the amounts
    counted are those summed."""
    return F.try_divide(F.sum(money(c)).cast("double"), F.count(money(c)).cast("double"))


def _idiv(a: Column, b: Column) -> Column:
    """Exact floor division of non-negative integers; null where b is 0.
    Decimals, because products of counts and scale exceed a long near 4.6e14."""
    return F.call_function("div", a.cast("decimal(38,0)"), F.nullif(b.cast("decimal(38,0)"), F.lit(0))).cast("long")


def half_up_ratio(num: Column, den: Column, scale_factor: int = 100, digits: int = 2) -> Column:
    """round(scale_factor * num / den, digits) with half away from zero, exact.

    num, den integral, den > 0. Null when den is 0 or null.
    """
    p = 10 ** digits
    n = num.cast("long")
    d = den.cast("long")
    wide = F.abs(n).cast("decimal(20,0)") * F.lit(2 * scale_factor * p).cast("decimal(10,0)")
    mag = _idiv(wide + d.cast("decimal(20,0)"), d.cast("decimal(20,0)") * 2)
    signed = F.when(n < 0, -mag).otherwise(mag)
    return F.when(d > 0, signed.cast("double") / F.lit(float(p)))


def rate_pct(cond: Column, total: Column | None = None) -> Column:
    """round(count_if(cond) / count(*) * 100, 2) as an aggregate expression."""
    total = F.count(F.lit(1)) if total is None else total
    return half_up_ratio(F.count_if(cond), total)


def round_avg_money(c="amount") -> Column:
    """round(avg(amount), 2), half away from zero, from the exact cent sum."""
    cents = (F.sum(money(c)) * 100).cast("long")
    return _round_cents_avg(cents, F.count(money(c)))


def _round_cents_avg(cents: Column, n: Column) -> Column:
    # avg in cents = cents / n; rounded to whole cents, half away from zero
    n = n.cast("long")
    q = _idiv(F.abs(cents) * 2 + n, n * 2)
    signed = F.when(cents < 0, -q).otherwise(q)
    return F.when(n > 0, signed.cast("double") / F.lit(100.0))


def minute_boundaries(start="flagged_at", end="as_of") -> Column:
    """Number of minute boundaries crossed from start to end (DATEDIFF(minute))."""
    return F.timestamp_diff("MINUTE", F.date_trunc("minute", col(start)), F.date_trunc("minute", col(end)))


def day_boundaries(start, end) -> Column:
    """Number of calendar-day boundaries crossed (DATEDIFF(day))."""
    return F.datediff(F.to_date(col(end)), F.to_date(col(start)))


def week_start(c="event_date") -> Column:
    """Monday of the week containing the date."""
    return F.date_trunc("week", col(c)).cast("date")
