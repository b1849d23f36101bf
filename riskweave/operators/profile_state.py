"""Incremental user profiles: mergeable partial aggregates and what they cover.

Everything in a profile merges: counts and exact sums add, first and last days
and the country are a minimum and maxima. So the state keeps

  days/event_date=...   the partial aggregate of each user and day
  runs/run=N/users      the merged aggregate of each user after run N
  runs/run=N/touched    the users whose aggregate run N changed
  runs/run=N/marks      the silver files that run N covers, by day; written
                        last, so a run without it never happened

A run lists the silver layer and compares it with the marks. New days are read
and merged into the users. A day whose files changed (late rows, a reload) is
read again, and only the users that it holds or held are merged anew from their
days; the other days of silver are not read.
"""

from __future__ import annotations

import hashlib
import re
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskweave.functions.expressions import money
from riskweave.session import list_folder, path_exists, remove_path

NO_DAY = "__HIVE_DEFAULT_PARTITION__"
PARTS_SCHEMA = ("user_id string, rows long, valued long, spend decimal(38,2), first_seen date, last_seen date, "
                "home_country string")
#: Runs whose folders are kept for readers that began before the newest.
KEPT_RUNS = 2


def partials(silver: DataFrame, *keys: str) -> DataFrame:
    """The mergeable aggregate of each user (and of each further key)."""
    return silver.groupBy("user_id", *keys).agg(
        F.count(F.lit(1)).alias("rows"), F.count(money()).alias("valued"),
        F.sum(money()).cast("decimal(38,2)").alias("spend"), F.min("event_date").alias("first_seen"),
        F.max("event_date").alias("last_seen"), F.max("user_country").alias("home_country"))


def merged(parts: DataFrame) -> DataFrame:
    """One aggregate a user from any number of them, in any order."""
    return parts.groupBy("user_id").agg(
        F.sum("rows").alias("rows"), F.sum("valued").alias("valued"), F.sum("spend").cast("decimal(38,2)").alias("spend"),
        F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"),
        F.max("home_country").alias("home_country"))


def finished(state: DataFrame, as_of=None) -> DataFrame:
    """Aggregates -> the profiles that `warehouse.user_profiles` makes of all of silver."""
    from riskweave.plans.dashboard import ts_lit
    spend = F.col("spend").cast("double")
    return state.select("user_id", F.try_divide(spend, F.col("valued").cast("double")).alias("avg_transaction"),
                        F.col("rows").alias("total_transactions"), spend.alias("total_spend"), "first_seen", "last_seen",
                        "home_country", ts_lit(as_of).alias("updated_at"))


def coverage(silver: DataFrame) -> dict[str, str]:
    """What each day's folder of a silver scan holds: a digest of its files'
    names, which are new whenever a file is written. Nothing is read."""
    files: dict[str, list[str]] = {}
    for path in silver.inputFiles():
        day = re.search(r"event_date=([^/]+)", path)
        files.setdefault(unquote(day.group(1)) if day else NO_DAY, []).append(path.rsplit("event_date=", 1)[-1])
    return {day: hashlib.sha256("\n".join(sorted(names)).encode()).hexdigest() for day, names in files.items()}


def _in_days(days) -> Column:
    dated = [F.lit(d).cast("date") for d in days if d != NO_DAY]
    found = F.col("event_date").isin(dated) if dated else F.lit(False)
    return F.coalesce(found, F.lit(False)) | (F.col("event_date").isNull() if NO_DAY in days else F.lit(False))


def _runs(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the runs that were completed, rising."""
    numbers = sorted(int(n.split("=")[1]) for n, folder, _, _ in list_folder(spark, f"{root}/runs") if folder)
    return [n for n in numbers if path_exists(spark, f"{root}/runs/run={n}/marks/_SUCCESS")]


def _read(spark: SparkSession, path: str, schema: str = PARTS_SCHEMA) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def refresh(spark: SparkSession, silver: DataFrame, root: str) -> dict[str, list[str]]:
    """Bring the state in `root` up to the silver scan (a layer partitioned by
    event_date). Returns the days by what became of them: new, changed, gone.
    Nothing is written if all are covered. One run at a time."""
    root = root.rstrip("/")
    runs = _runs(spark, root)
    last = f"{root}/runs/run={runs[-1]}" if runs else None
    covered = {r.day: r.files for r in _read(spark, f"{last}/marks", "day string, files string").collect()} if last else {}
    now = coverage(silver)
    new = sorted(now.keys() - covered.keys())
    changed = sorted(d for d in now.keys() & covered.keys() if now[d] != covered[d])
    gone = sorted(covered.keys() - now.keys())
    done = {"new": new, "changed": changed, "gone": gone}
    if not (new or changed or gone) and runs:
        return done
    number = (runs[-1] if runs else 0) + 1
    run = f"{root}/runs/run={number}"
    days = f"{root}/days"
    day_schema = PARTS_SCHEMA + ", event_date date"

    def of_days(which) -> DataFrame:
        if not which or not path_exists(spark, days):
            return spark.createDataFrame([], day_schema)
        return _read(spark, days, day_schema).filter(_in_days(which))

    # who was in a day that changed or went, before it is overwritten
    of_days(changed + gone).select("user_id").distinct().write.mode("overwrite").parquet(f"{run}/held")
    held = _read(spark, f"{run}/held", "user_id string")
    if new or changed:
        (partials(silver.filter(_in_days(new + changed)), "event_date").repartition("event_date", F.pmod(F.xxhash64("user_id"), F.lit(8)))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("event_date").parquet(days))
    fresh = of_days(new).drop("event_date")
    before = _read(spark, f"{last}/users") if last else spark.createDataFrame([], PARTS_SCHEMA)
    if changed or gone:
        redone = held.unionByName(of_days(changed).select("user_id")).distinct()
        same = F.col("user_id").eqNullSafe(F.col("redone_id"))
        redone = redone.select(F.col("user_id").alias("redone_id"))
        rest = sorted(now.keys() - set(new))
        before = (before.join(redone, same, "left_anti")
                  .unionByName(of_days(rest).drop("event_date").join(redone, same, "left_semi")))
    merged(before.unionByName(fresh)).write.mode("overwrite").parquet(f"{run}/users")
    touched = held.unionByName(of_days(new + changed).select("user_id")).distinct()
    touched.write.mode("overwrite").parquet(f"{run}/touched")
    spark.createDataFrame(sorted(now.items()), "day string, files string").coalesce(1).write.mode("overwrite").parquet(f"{run}/marks")
    for old in [n for n in runs if n <= number - KEPT_RUNS]:
        remove_path(spark, f"{root}/runs/run={old}")
    return done


def current(spark: SparkSession, root: str) -> DataFrame:
    """Merged aggregates of the newest completed run; none before the first."""
    runs = _runs(spark, root.rstrip("/"))
    return _read(spark, f"{root.rstrip('/')}/runs/run={runs[-1]}/users") if runs else spark.createDataFrame([], PARTS_SCHEMA)


def touched(spark: SparkSession, root: str) -> DataFrame:
    """(user_id) whose aggregates the newest run changed or removed."""
    runs = _runs(spark, root.rstrip("/"))
    schema = "user_id string"
    return _read(spark, f"{root.rstrip('/')}/runs/run={runs[-1]}/touched", schema) if runs else spark.createDataFrame([], schema)
