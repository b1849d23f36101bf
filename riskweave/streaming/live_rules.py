"""Fraud rules on the live silver stream.

A stream cannot re-flag rows it has already emitted, so the live velocity
rule flags an event when the trailing window *ending at that event* holds
more than `max_txns` events (the batch rule additionally flags the user's
earlier rows; keep the batch job as the source of truth for that).

T8 `start_microbatch_rules`: `foreachBatch`. Spike (against the user profile)
    and geography are row predicates. Velocity counts each batch's events
    together with the recent history of earlier batches, which the job keeps
    as counts per (user, instant), partitioned by (event day, batch id).
    Only the days the window reaches are listed; a retried batch overwrites
    its own partitions and only reads earlier batches, so retries are
    idempotent. Days that no window of an event within the allowed lateness
    reaches any more are deleted when a batch begins, by what earlier batches
    held, so a retry sees the same history.
T9 `start_stateful_velocity`: `transformWithState` on the RocksDB state store,
    with an event-time watermark. Users are dealt to state shards by their hash, so
    that one state call handles many users. Map states hold a shard's events as
    counts by (user, instant), in slices as long as the window, back to one window
    behind the watermark, which is as far as the window of an event that may still
    arrive reaches; a timer drops them once the watermark is a window past the
    newest. A trigger reads and writes a slice once, whatever events it has. Events
    older than the watermark (a window behind the newest event by default) are
    dropped. Python holds `ROWS_AT_A_TIME` rows of a trigger and a shard's distinct
    (user, instant)s as arrays.
"""

from __future__ import annotations

import contextlib
import datetime as dt
import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from riskweave.functions.expressions import fraud_reason, geography_mismatch
from riskweave.operators.rules import MICROS_PER_MINUTE, spike_predicate, window_counts
from riskweave.schemas import SILVER_SCHEMA, SPIKE_MULTIPLIER, VELOCITY_MAX_TXNS, VELOCITY_WINDOW_MINUTES
from riskweave.session import list_folder, path_exists, remove_path

LIVE_COLUMNS = ["transaction_id", "user_id", "amount", "merchant_name", "merchant_category",
                "user_country", "ip_country", "device", "event_timestamp", "event_date",
                "country_mismatch", "amount_bucket", "fraud_type", "window_count",
                "flag_velocity", "flag_spike", "flag_geography", "fraud_reason", "flagged_at"]


def _dynamic_overwrite(df: DataFrame, path: str, *partitions: str) -> None:
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partitions).parquet(path))


LIVE_SCHEMA = T.StructType([
    *[f for c in LIVE_COLUMNS[:-6] for f in SILVER_SCHEMA.fields if f.name == c],
    T.StructField("window_count", T.LongType()), T.StructField("flag_velocity", T.BooleanType()),
    T.StructField("flag_spike", T.BooleanType()), T.StructField("flag_geography", T.BooleanType()),
    T.StructField("fraud_reason", T.StringType()), T.StructField("flagged_at", T.TimestampType()),
    T.StructField("batch_id", T.LongType())])


def read_live_flags(spark: SparkSession, path: str) -> DataFrame:
    """Flagged rows so far; empty, with the same columns, before any row was flagged."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], LIVE_SCHEMA)
    return spark.read.schema(LIVE_SCHEMA).parquet(path)


def _existing(spark: SparkSession, paths):
    """The subset of `paths` that exist."""
    return [p for p in paths if path_exists(spark, p)]


def _history(spark: SparkSession, path: str, batch_id: int, since_us: int, until_us: int):
    """Earlier batches' narrow rows with time in [since, until] (None if none).

    The history folder is partitioned by event day, then batch id; only the
    day folders the window can reach are listed, so a long-running stream
    never lists its whole history."""
    first = dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=since_us)
    last = dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=until_us)
    days = [(first.date() + dt.timedelta(days=i)).isoformat()
            for i in range((last.date() - first.date()).days + 1)]
    dirs = _existing(spark, [f"{path}/day={d}" for d in days])
    if not dirs:
        return None
    h = spark.read.schema(HISTORY_SCHEMA).option("basePath", path).parquet(*dirs)
    return h.filter((F.col("batch_id") < batch_id) & (F.col("_t") >= F.lit(since_us))).select("_u", "_t", "_n")


HISTORY_SCHEMA = T.StructType([T.StructField("_u", T.StringType()), T.StructField("_t", T.LongType()),
                               T.StructField("_n", T.LongType()), T.StructField("day", T.StringType()),
                               T.StructField("batch_id", T.LongType())])


def expire_history(spark: SparkSession, path: str, batch_id: int, window_minutes: int, late_minutes: int) -> list[str]:
    """Delete the days of the history that lie more than a window and the
    allowed lateness before the newest day of batches before `batch_id`.
    Returns the deleted days. An event later than that is counted against
    what is left."""
    days = sorted(name.split("=", 1)[1] for name, folder, _, _ in list_folder(spark, path) if folder and name.startswith("day=2"))
    old = []
    for newest in reversed(days):  # the newest day that an earlier batch wrote
        parts = [n.split("=", 1)[1] for n, folder, _, _ in list_folder(spark, f"{path}/day={newest}") if n.startswith("batch_id=")]
        if any(int(b) < batch_id for b in parts):
            reach = dt.date.fromisoformat(newest) - dt.timedelta(minutes=int(window_minutes) + int(late_minutes))
            old = [d for d in days if dt.date.fromisoformat(d) < reach - dt.timedelta(days=1)]
            break
    for d in old:
        remove_path(spark, f"{path}/day={d}")
    return old


#: How late an event may be for its whole window to be in the history, in minutes.
LATE_MINUTES = 24 * 60


def instants(batch: DataFrame) -> DataFrame:
    """(_u, _t, _n): how many events each user has at each instant."""
    return (batch.filter(F.col("user_id").isNotNull() & F.col("event_timestamp").isNotNull())
            .groupBy(F.col("user_id").alias("_u"), F.unix_micros("event_timestamp").alias("_t"))
            .agg(F.count(F.lit(1)).alias("_n")))


def score_batch(batch: DataFrame, history: DataFrame | None, profiles: DataFrame,
                window_minutes: int, max_txns: int, multiplier: float) -> DataFrame:
    """Flags for one micro-batch given the earlier batches' recent events."""
    cur = instants(batch)
    events = cur if history is None else cur.unionByName(history)
    counts = window_counts(events, cur, window_minutes).withColumnRenamed("_u", "user_id")
    p = profiles.select("user_id", F.col("avg_transaction").cast("double").alias("_avg"))
    keyed = batch.withColumn("_t", F.unix_micros("event_timestamp"))
    return (keyed.join(counts, ["user_id", "_t"], "left").drop("_t").join(p, "user_id", "left")
            .withColumn("flag_velocity", F.coalesce(F.col("window_count") > max_txns, F.lit(False)))
            .withColumn("flag_spike", spike_predicate(F.col("amount"), F.col("_avg"), multiplier))
            .withColumn("flag_geography", geography_mismatch())
            .withColumn("fraud_reason", fraud_reason())
            .drop("_avg"))


def start_microbatch_rules(silver_stream: DataFrame, profiles: DataFrame, out_path: str,
                           state_path: str, checkpoint: str,
                           window_minutes: int = VELOCITY_WINDOW_MINUTES,
                           max_txns: int = VELOCITY_MAX_TXNS,
                           multiplier: float = SPIKE_MULTIPLIER,
                           flagged_at: str | None = None, trigger=None,
                           late_minutes: int = LATE_MINUTES) -> StreamingQuery:
    """T8: rules per micro-batch; flagged rows go to `out_path` by batch id.
    The history in `state_path` reaches a window and `late_minutes` back."""
    w_us = int(window_minutes) * MICROS_PER_MINUTE

    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        try:
            lo, hi = batch.agg(F.min(F.unix_micros("event_timestamp")),
                               F.max(F.unix_micros("event_timestamp"))).first()
            if lo is None:
                return
            expire_history(spark, state_path, batch_id, window_minutes, late_minutes)
            hist = _history(spark, state_path, batch_id, lo - w_us, hi)
            scored = score_batch(batch, hist, profiles, window_minutes, max_txns, multiplier)
            stamp = F.col(flagged_at) if flagged_at else F.current_timestamp()
            flagged = (scored.filter(F.col("flag_velocity") | F.col("flag_spike") | F.col("flag_geography"))
                       .withColumn("flagged_at", stamp).select(*LIVE_COLUMNS)
                       .withColumn("batch_id", F.lit(batch_id).cast("long")))
            _dynamic_overwrite(flagged, out_path, "batch_id")
            narrow = (instants(batch).withColumn("day", F.date_format(F.timestamp_micros("_t"), "yyyy-MM-dd"))
                      .withColumn("batch_id", F.lit(batch_id).cast("long")))
            _dynamic_overwrite(narrow, state_path, "day", "batch_id")
        finally:
            batch.unpersist()

    w = (silver_stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
         .queryName("live_rules"))
    w = w.trigger(availableNow=True) if trigger == "availableNow" else \
        w.trigger(processingTime=trigger or "30 seconds")
    return w.start()


# ------------------------------------------------------------------ T9 state
STATEFUL_OUTPUT = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("transaction_id", T.StringType()),
    T.StructField("event_timestamp", T.TimestampType()),
    T.StructField("window_count", T.LongType()),
])
#: Rows of a shard that Python holds with their ids; more are laid in the state.
ROWS_AT_A_TIME = 50_000
#: Rows in one entry of the list state in which they are laid.
ROWS_LAID_TOGETHER = 20
#: Groups of users that share a state; a checkpoint keeps its number for life.
STATE_SHARDS = 1024


class VelocityProcessor(StatefulProcessor):
    """Events of a shard's users as counts by instant in map states, counted by ranks.

    The state is cut in slices of time. `seconds` has, by a slice's first second,
    the (user, instant)s in it as columns: the slice's users, and each row's place
    among them and microsecond. `instants` has the rows of a slice that stand for
    more than one event, with their number. Rows beyond `ROWS_AT_A_TIME` are laid
    in the list state `arrived` until the trigger's last row has been counted in,
    so that every row sees all of its trigger.
    """

    def __init__(self, window_minutes: int, max_txns: int):
        self.window, self.limit = int(window_minutes) * MICROS_PER_MINUTE, max_txns
        self.slice_s = max(1, int(window_minutes)) * 60

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seconds = handle.getMapState("seconds", "second long", "users array<string>, user binary, micros binary, several boolean")
        self.instants = handle.getMapState("instants", "second long", "row binary, events binary")
        self.arrived = handle.getListState("arrived", "users array<string>, transaction_ids array<string>, micros array<long>")

    def _slices(self, t: np.ndarray) -> np.ndarray:
        """First second of each instant's slice."""
        return t // (self.slice_s * 1_000_000) * self.slice_s

    def _load(self, users: dict) -> tuple[list, dict]:
        """The held (user code, instant, events), and slice -> whether it has a row of several events."""
        held, slices = [], {}
        for (first,), (names, user, micros, several) in list(self.seconds.iterator()):
            code = _codes(users, names)[np.frombuffer(user, dtype="int32")]
            events = np.ones(len(code), dtype="int64")
            if several:
                row, n = self.instants.getValue((first,))
                events[np.frombuffer(row, dtype="int32")] = np.frombuffer(n, dtype="int64")
            held.append((code, np.frombuffer(micros, dtype="int64"), events))
            slices[int(first)] = bool(several)
        return held, slices

    def _store(self, users: dict, held: tuple, touched: set, slices: dict) -> None:
        names = list(users)
        code, t, events = held
        first = self._slices(t)
        order = np.flatnonzero(np.isin(first, np.fromiter(touched, dtype="int64")))
        order = order[np.argsort(first[order], kind="stable")]
        for lo, hi in _runs(first[order]):
            rows = order[lo:hi]
            second, n = int(first[rows[0]]), events[rows]
            known, user = np.unique(code[rows], return_inverse=True)
            many = np.flatnonzero(n > 1)
            self.seconds.updateValue((second,), ([names[c] for c in known.tolist()], user.astype("int32").tobytes(),
                                                 t[rows].tobytes(), len(many) > 0))
            if len(many):
                self.instants.updateValue((second,), (many.astype("int32").tobytes(), n[many].tobytes()))
            slices[second] = len(many) > 0

    def _forget(self, slices: dict, watermark_us: int) -> None:
        """Drop the slices that no window of an admitted event reaches."""
        reach = (watermark_us - self.window) // 1_000_000
        for first in [s for s in slices if s + self.slice_s <= reach]:
            if slices.pop(first):
                self.instants.removeKey((first,))
            self.seconds.removeKey((first,))

    def _lay(self, names: np.ndarray, ids: np.ndarray, t: np.ndarray) -> None:
        cuts = range(0, len(t), ROWS_LAID_TOGETHER)
        self.arrived.appendList([tuple(x[i:i + ROWS_LAID_TOGETHER].tolist() for x in (names, ids, t)) for i in cuts])

    def _laid(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        part: tuple[list, list, list] = ([], [], [])
        for row in self.arrived.get():
            for column, values in zip(part, row):
                column.extend(values)
            if len(part[0]) >= ROWS_AT_A_TIME:
                yield _columns(*part)
                part = ([], [], [])
        if part[0]:
            yield _columns(*part)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        watermark_us = timerValues.getCurrentWatermarkInMs() * 1000
        users: dict = {}
        new, waiting, touched = [], [], set()
        held, slices, laid = None, {}, False
        for pdf in rows:
            t = _micros(pdf["event_timestamp"])
            on_time = t >= watermark_us if watermark_us > 0 else np.ones(len(t), dtype=bool)
            if not on_time.any():
                continue
            if held is None:
                stored, slices = self._load(users)
                held = _merged(stored)
            names, ids = (pdf[c].to_numpy(dtype=object)[on_time] for c in ("user_id", "transaction_id"))
            t = t[on_time]
            place, known = pd.factorize(names)
            new.append((_codes(users, known)[place], t, np.ones(len(t), dtype="int64")))
            touched.update(np.unique(self._slices(t)).tolist())
            if sum(len(x[1]) for x in new) > max(ROWS_AT_A_TIME, len(held[1])):
                held, new = _merged([held, *new]), []
            waiting.append((names, ids, t))
            if sum(len(x[2]) for x in waiting) > ROWS_AT_A_TIME:
                for some in waiting:
                    self._lay(*some)
                waiting, laid = [], True
        if held is None:
            return
        held = _merged([held, *new])
        self._store(users, held, touched, slices)
        count = _counter(held, self.window)
        for names, ids, t in itertools.chain(self._laid() if laid else (), waiting):
            counts = count(_codes(users, names), t)
            hit = counts > self.limit
            if hit.any():
                yield pd.DataFrame({"user_id": names[hit], "transaction_id": ids[hit],
                                    "event_timestamp": pd.to_datetime(t[hit], unit="us", utc=True), "window_count": counts[hit]})
        if laid:
            self.arrived.clear()
        if watermark_us > 0:
            self._forget(slices, watermark_us)
        # a window past the end of the newest slice nothing of it is reached any more
        last_ms = (max(slices) + self.slice_s) * 1000
        self.handle.registerTimer(max(last_ms + self.window // 1000 + 1, watermark_us // 1000 + 1))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        slices = {int(k[0]): bool(v[3]) for k, v in list(self.seconds.iterator())}
        self._forget(slices, timerValues.getCurrentWatermarkInMs() * 1000)
        return iter(())

    def close(self) -> None:
        pass


def _codes(users: dict, names) -> np.ndarray:
    """A number for each user, the next one for a new user."""
    return np.array([users.setdefault(u, len(users)) for u in names], dtype="int64")


def _columns(names: list, ids: list, t: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.array(names, dtype=object), np.array(ids, dtype=object), np.array(t, dtype="int64")


def _merged(parts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(user code, instant, events) with each (user, instant) once, rising."""
    if not parts:
        return tuple(np.zeros(0, dtype="int64") for _ in range(3))
    code, t, events = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((t, code))
    code, t, events = code[order], t[order], events[order]
    first = np.concatenate([[True], (np.diff(code) != 0) | (np.diff(t) != 0)])[:len(t)]
    at = np.flatnonzero(first)
    return code[at], t[at], np.add.reduceat(events, at) if len(at) else events


def _counter(held: tuple, window: int):
    """Function of users and instants: events of the user in [instant - window, instant]."""
    code, t, events = held
    times = np.unique(t)
    ranks = len(times) + 1
    place = code * ranks + np.searchsorted(times, t)
    upto = np.concatenate([[0], np.cumsum(events)])

    def count(user: np.ndarray, at: np.ndarray) -> np.ndarray:
        end, start = np.searchsorted(times, at, side="right"), np.searchsorted(times, at - window)
        return upto[np.searchsorted(place, user * ranks + end)] - upto[np.searchsorted(place, user * ranks + start)]
    return count


def _runs(x: np.ndarray) -> list[tuple[int, int]]:
    """(from, to) of each run of equal values."""
    edges = [0, *(np.flatnonzero(np.diff(x)) + 1).tolist(), len(x)]
    return list(zip(edges, edges[1:]))


def _micros(ts: pd.Series) -> np.ndarray:
    if getattr(ts.dt, "tz", None) is not None:
        ts = ts.dt.tz_convert("UTC").dt.tz_localize(None)
    return ts.astype("datetime64[us]").astype("int64").to_numpy()


def stateful_velocity(silver_stream: DataFrame, window_minutes: int = VELOCITY_WINDOW_MINUTES,
                      max_txns: int = VELOCITY_MAX_TXNS, late_delay: str | None = None,
                      shards: int = STATE_SHARDS) -> DataFrame:
    """T9: streaming DataFrame of events whose trailing window exceeds
    `max_txns`, with the count. Events later than the watermark are dropped.
    The session must use the RocksDB state store (`rocksdb_state`)."""
    delay = late_delay or f"{int(window_minutes)} minutes"
    src = (silver_stream.filter(F.col("user_id").isNotNull() & F.col("event_timestamp").isNotNull())
           .select("user_id", "transaction_id", "event_timestamp")
           .withWatermark("event_timestamp", delay))
    shard = F.pmod(F.xxhash64("user_id"), F.lit(int(shards))).alias("state_shard")
    return src.select("*", shard).groupBy("state_shard").transformWithStateInPandas(
        VelocityProcessor(window_minutes, max_txns), STATEFUL_OUTPUT, "append", "EventTime")


STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextlib.contextmanager
def rocksdb_state(spark: SparkSession):
    """Queries started inside keep their state in RocksDB, on the executors'
    disks and in the checkpoint, not on the JVM heap."""
    before = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(STATE_STORE, before) if before else spark.conf.unset(STATE_STORE)


def start_stateful_velocity(silver_stream: DataFrame, out_path: str, checkpoint: str,
                            window_minutes: int = VELOCITY_WINDOW_MINUTES,
                            max_txns: int = VELOCITY_MAX_TXNS, trigger=None,
                            shards: int = STATE_SHARDS) -> StreamingQuery:
    out = stateful_velocity(silver_stream, window_minutes, max_txns, shards=shards)
    w = (out.writeStream.format("parquet").option("path", out_path)
         .option("checkpointLocation", checkpoint).outputMode("append").queryName("stateful_velocity"))
    w = w.trigger(availableNow=True) if trigger == "availableNow" else \
        w.trigger(processingTime=trigger or "30 seconds")
    with rocksdb_state(silver_stream.sparkSession):
        return w.start()
