"""Distinct counts at scale: mergeable sketches beside the exact counts.

An exact distinct count over a window of days must see every day's users again
for each window. A sketch a day (HyperLogLog) is made once and stored; a window
unites the sketches of its days, whatever the number of events. The relative
standard error is about 1.04 / sqrt(2 ** lg_k).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: log2 of a sketch's registers: 2^14 give a standard error of about 0.8 %.
LG_K = 14


def standard_error(lg_k: int = LG_K) -> float:
    return 1.04 / 2 ** (lg_k / 2)


def daily_sketches(events: DataFrame, value: str = "user_id", day: str = "event_date", by=(), lg_k: int = LG_K) -> DataFrame:
    """(day, *by, sketch): one sketch of the distinct values of each day, from
    partial sketches in each task. Null values do not count."""
    return (events.filter(F.col(value).isNotNull()).groupBy(day, *by)
            .agg(F.hll_sketch_agg(value, lg_k).alias("sketch")))


def distinct_estimate(sketch: str | Column = "sketch") -> Column:
    """Aggregate: the estimated distinct values of several sketches' days together."""
    return F.hll_sketch_estimate(F.hll_union_agg(sketch))


def trailing_distinct(sketches: DataFrame, days: int = 7, day: str = "event_date", by=()) -> DataFrame:
    """(day, *by, distinct_estimate) over [day - days + 1, day] for each day
    that has a sketch: each sketch is sent to the days whose window holds it."""
    ahead = F.explode(F.sequence(F.lit(0), F.lit(days - 1)))
    spread = sketches.withColumn("_ahead", ahead).select(F.date_add(day, F.col("_ahead")).alias(day), *by, "sketch",
                                                         (F.col("_ahead") == 0).alias("_own"))
    return (spread.groupBy(day, *by).agg(distinct_estimate("sketch").alias("distinct_estimate"), F.max("_own").alias("_own"))
            .filter("_own").drop("_own"))


def trailing_distinct_exact(events: DataFrame, days: int = 7, value: str = "user_id", day: str = "event_date") -> DataFrame:
    """(day, distinct_count) over the same windows, exact: each (value, day) is
    kept once before it is sent to the days whose window holds it."""
    seen = events.filter(F.col(value).isNotNull() & F.col(day).isNotNull()).select(value, day).distinct()
    spread = (seen.withColumn("_ahead", F.explode(F.sequence(F.lit(0), F.lit(days - 1))))
              .select(value, F.date_add(day, F.col("_ahead")).alias(day), (F.col("_ahead") == 0).alias("_own"))
              .groupBy(day, value).agg(F.max("_own").alias("_own")))
    return (spread.groupBy(day).agg(F.count(F.lit(1)).alias("distinct_count"), F.max("_own").alias("_own"))
            .filter("_own").drop("_own"))
