"""Behavioural fraud rules.

R1  velocity     users with more than `max_txns` events in any trailing window
                 [t - window, t] (both ends inclusive, ties counted); every row
                 of such a user is flagged, before and after the burst.
R2a amount spike amount / avg_spend > multiplier, on the event's avg_spend.
R2b              ... against the user's profile average.
R2c              ... against the average of the user's earlier transactions.
R3  geography    user_country <> ip_country, a missing side counts as different.

Scale notes
-----------
* The velocity rule needs the set of users, not every count. Rows are counted
  by (user, window-wide time slot) with a partial and a final aggregate; a slot
  with more than `max_txns` rows flags its user outright. Any trailing window
  lies in two neighbouring slots, so only slot pairs that together exceed
  `max_txns` are looked at row by row, and such a pair holds at most
  2 x `max_txns` rows, whatever the data. The join back is decided by AQE from
  the runtime size of the flagged-user set (broadcast when small, otherwise a
  sort-merge join with skew splitting).
* Window counts per event (live rules) are ranks: events up to the window's end
  less those before its start, each looked up in its own second, plus one total a
  second in between (`window_counts`).
* R2c needs a running average over a user's whole history. It is computed as
  a distributed prefix sum over seconds, hours and the whole history, the upper
  two from one row each, so no task holds a whole user or hour.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskweave.functions.expressions import fraud_reason, geography_mismatch, money
from riskweave.schemas import SPIKE_MULTIPLIER, VELOCITY_MAX_TXNS, VELOCITY_WINDOW_MINUTES

MICROS_PER_MINUTE = 60 * 1_000_000


def _floor_div(a: Column, b: int) -> Column:
    """Exact floor division by a positive integer."""
    return F.call_function("div", a - F.pmod(a, F.lit(b)), F.lit(b)).cast("long")


def _user_times(df: DataFrame, user_col: str, ts_col: str, carry=()) -> DataFrame:
    return (df.select(F.col(user_col).alias("_u"), F.unix_micros(F.col(ts_col)).alias("_t"), *carry)
            .filter(F.col("_u").isNotNull() & F.col("_t").isNotNull()))


def _in_slot_pairs(narrow: DataFrame, w: int) -> DataFrame:
    """Each row in its window-wide slot and in the next one (`_shift` 1), so
    that a trailing window lies in the one slot `_b` of its last event."""
    return (narrow.withColumn("_shift", F.explode(F.array(F.lit(0), F.lit(1))))
            .withColumn("_b", _floor_div(F.col("_t"), w) + F.col("_shift")))


#: Chunks of time that running counts are made in; a user's chunk holds at most a million different instants.
CHUNK_MICROS = 1_000_000


def window_counts(events: DataFrame, asked: DataFrame, window_minutes: int) -> DataFrame:
    """(_u, _t, window_count) for each (_u, _t) of `asked`, once: how many of
    the user's `events` (_u, _t, _n) lie in [_t - window, _t]. Exact.

    A window count is the events up to its end less those before its start.
    Events of one instant are one row. Each end is looked up among the user's events
    of its own second, as of its place there, and the seconds in between are
    added from one total each. So a burst of one user spreads over its seconds,
    and no task holds more than a second's instants or two windows' seconds of a
    user, however many events there are.
    """
    wide = int(window_minutes) * 60  # the window in chunks
    at = events.groupBy("_u", "_t").agg(F.sum("_n").alias("_n")).withColumn("_c", _floor_div(F.col("_t"), CHUNK_MICROS))
    ends = asked.select("_u", "_t").distinct().withColumn("_c", _floor_div(F.col("_t"), CHUNK_MICROS))
    # 0 a window's start, before the events of its instant; 1 events; 2 a window's end, after them
    none = F.lit(0).cast("long")
    places = (at.select("_u", "_t", "_c", F.lit(1).alias("_kind"), "_n")
              .unionByName(ends.withColumn("_end", F.explode(F.array(F.lit(0), F.lit(2)))).select(
                  "_u", "_t", F.when(F.col("_end") == 0, F.col("_c") - wide).otherwise(F.col("_c")).alias("_c"),
                  F.col("_end").alias("_kind"), none.alias("_n"))))
    chunk = Window.partitionBy("_u", "_c")
    upto = chunk.orderBy(F.pmod("_t", F.lit(CHUNK_MICROS)), "_kind").rowsBetween(Window.unboundedPreceding, 0)
    outer = (places.withColumn("_upto", F.sum("_n").over(upto)).withColumn("_all", F.sum("_n").over(chunk))
             .filter(F.col("_kind") != 1)
             .select("_u", "_t", F.when(F.col("_kind") == 2, F.col("_upto")).otherwise(F.col("_all") - F.col("_upto")).alias("_n")))
    # seconds that lie wholly inside the window, from one row a user and second
    seconds = (at.groupBy("_u", "_c").agg(F.sum("_n").alias("_n"))
               .unionByName(ends.select("_u", "_c", none.alias("_n")).distinct())
               .groupBy("_u", "_c").agg(F.sum("_n").alias("_n"), F.max((F.col("_n") == 0)).alias("_asked"))
               .withColumn("_shift", F.explode(F.array(F.lit(0), F.lit(1))))
               .withColumn("_b", _floor_div(F.col("_c"), wide) + F.col("_shift")))
    between = Window.partitionBy("_u", "_b").orderBy("_c").rangeBetween(-(wide - 1), -1)
    inner = (seconds.withColumn("_between", F.coalesce(F.sum("_n").over(between), none))
             .filter((F.col("_shift") == 0) & F.col("_asked")).select("_u", "_c", "_between"))
    return (ends.join(inner, ["_u", "_c"]).select("_u", "_t", F.col("_between").alias("_n"))
            .unionByName(outer).groupBy("_u", "_t").agg(F.sum("_n").alias("window_count")))


def velocity_counts(df: DataFrame, window_minutes: int = VELOCITY_WINDOW_MINUTES,
                    user_col: str = "user_id", ts_col: str = "event_timestamp", carry=()) -> DataFrame:
    """(user, event_micros, window_count, *carry): for each event with a user
    and a time, the number of the user's events in [t - window, t] (see
    `window_counts`), joined back to the rows by user and instant."""
    rows = _user_times(df, user_col, ts_col, carry)
    counts = window_counts(rows.select("_u", "_t", F.lit(1).cast("long").alias("_n")), rows, window_minutes)
    return rows.join(counts, ["_u", "_t"]).select(F.col("_u").alias(user_col), F.col("_t").alias("event_micros"),
                                                  "window_count", *carry)


def rule_velocity(df: DataFrame, window_minutes: int = VELOCITY_WINDOW_MINUTES,
                  max_txns: int = VELOCITY_MAX_TXNS, user_col: str = "user_id",
                  ts_col: str = "event_timestamp") -> DataFrame:
    """Users with more than `max_txns` events in some trailing window.

    Lazy: nothing runs while the frame is built. A slot is as wide as the
    window, so all its events lie in the window of its last one: a slot that
    exceeds the limit flags the user by its count alone.
    """
    w = int(window_minutes) * MICROS_PER_MINUTE
    narrow = _user_times(df, user_col, ts_col)
    slots = narrow.groupBy("_u", _floor_div(F.col("_t"), w).alias("_s")).agg(F.count(F.lit(1)).alias("_n"))
    outright = slots.filter(F.col("_n") > max_txns).select("_u")
    pairs = (slots.filter(F.col("_n") <= max_txns)
             .select("_u", F.explode(F.array(F.col("_s"), F.col("_s") + 1)).alias("_b"), "_n")
             .groupBy("_u", "_b").agg(F.sum("_n").alias("_n"), F.count(F.lit(1)).alias("_slots"))
             .filter((F.col("_n") > max_txns) & (F.col("_slots") == 2)).select("_u", "_b"))
    frame = Window.partitionBy("_u", "_b").orderBy("_t").rangeBetween(-w, 0)
    close = (_in_slot_pairs(narrow, w).join(pairs, ["_u", "_b"], "left_semi")
             .withColumn("_n", F.count(F.lit(1)).over(frame)).filter(F.col("_n") > max_txns).select("_u"))
    return outright.unionByName(close).distinct().select(F.col("_u").alias(user_col))


def spike_predicate(amount: Column, avg: Column, multiplier: float = SPIKE_MULTIPLIER) -> Column:
    """amount / avg > multiplier, without dividing (ANSI-safe) and with the
    float semantics of a ratio: avg 0 and amount > 0 is a spike (inf), 0/0 is
    not (NaN); a negative avg flips the inequality; null or NaN never flags."""
    k = F.lit(float(multiplier))
    a = amount.cast("double")
    m = avg.cast("double")
    valid = a.isNotNull() & m.isNotNull() & ~F.isnan(a) & ~F.isnan(m)
    pred = F.when(m >= 0, a > k * m).otherwise(a < k * m)
    return F.coalesce(valid & pred, F.lit(False))


def rule_amount_spike(df: DataFrame, spike_multiplier: float = SPIKE_MULTIPLIER,
                      avg_col: str = "avg_spend") -> DataFrame:
    """Transaction ids whose amount exceeds multiplier x the event's avg_spend."""
    return (df.filter(spike_predicate(F.col("amount"), F.col(avg_col), spike_multiplier))
            .select("transaction_id").distinct())


def rule_geography(df: DataFrame) -> DataFrame:
    """Transaction ids whose IP country differs from the user country."""
    return df.filter(geography_mismatch()).select("transaction_id").distinct()


def _share_by_id(df: DataFrame, flags) -> DataFrame:
    """Give every row of a transaction id the OR of its rows' flags (ids that
    occur more than once share them). Only rows with a raised flag are
    aggregated (partial aggregation collapses a hot id per task) and joined
    back; rows without an id keep their own flags; AQE picks broadcast or a skew-split sort-merge join at run time."""
    raised = F.lit(False)
    for f in flags:
        raised = raised | F.col(f)
    ids = (df.filter(raised & F.col("transaction_id").isNotNull())
           .groupBy("transaction_id").agg(*[F.max(f).alias(f"_id_{f}") for f in flags]))
    out = df.join(ids, "transaction_id", "left")
    for f in flags:
        out = out.withColumn(f, F.coalesce(F.col(f"_id_{f}"), F.col(f))).drop(f"_id_{f}")
    return out


def apply_fraud_rules(df: DataFrame, window_minutes: int = VELOCITY_WINDOW_MINUTES,
                      max_txns: int = VELOCITY_MAX_TXNS,
                      spike_multiplier: float = SPIKE_MULTIPLIER,
                      avg_col: str = "avg_spend", unique_ids: bool = False) -> DataFrame:
    """Input + flag_velocity, flag_spike, flag_geography, is_fraud_detected,
    fraud_reason. A row is detected when any rule fires.

    Rows that share a transaction id share the spike and geography flags: a
    row is flagged if its id is among the flagged ids. With `unique_ids=True`,
    where transaction_id is known to be a key, the flags are row predicates
    and the join on the id is saved.
    """
    users = (rule_velocity(df, window_minutes, max_txns)
             .select("user_id", F.lit(True).alias("_vel")))
    out = (df.join(users, "user_id", "left")
           .withColumns({
               "flag_velocity": F.coalesce(F.col("_vel"), F.lit(False)),
               "flag_spike": spike_predicate(F.col("amount"), F.col(avg_col), spike_multiplier),
               "flag_geography": geography_mismatch(),
           }).drop("_vel"))
    if not unique_ids:
        out = _share_by_id(out, ["flag_spike", "flag_geography"])
    return out.withColumns({
        "is_fraud_detected": F.col("flag_velocity") | F.col("flag_spike") | F.col("flag_geography"),
        "fraud_reason": fraud_reason(),
    })


FLAGGED_COLUMNS = ["transaction_id", "user_id", "amount", "merchant_name", "merchant_category",
                   "user_country", "ip_country", "device", "event_timestamp", "event_date",
                   "country_mismatch", "amount_bucket", "fraud_type", "flag_velocity", "flag_spike",
                   "flag_geography", "fraud_reason", "flagged_at"]


def flagged_transactions(detected: DataFrame, as_of=None, flagged_at: str | None = None) -> DataFrame:
    """Detected rows shaped to the fraud table. `flagged_at` is the name of a
    column holding the flag time (e.g. event time for on-arrival detection);
    by default every row is stamped with `as_of`."""
    from riskweave.plans.dashboard import ts_lit
    stamp = F.col(flagged_at).cast("timestamp") if flagged_at else ts_lit(as_of)
    from riskweave.schemas import WAREHOUSE
    df = detected.filter(F.col("is_fraud_detected")).withColumn("flagged_at", stamp)
    if "event_date" not in df.columns:
        df = df.withColumn("event_date", F.to_date(F.col("event_timestamp")))
    types = {n: t for n, t, _nl, _d in WAREHOUSE["fraud.flagged_transactions"]}
    for c in FLAGGED_COLUMNS:
        if c not in df.columns:  # optional columns the input does not carry
            df = df.withColumn(c, F.lit(None).cast(types[c]))
    return df.select(*FLAGGED_COLUMNS)


def rule_spike_vs_profile(df: DataFrame, profiles: DataFrame,
                          spike_multiplier: float = SPIKE_MULTIPLIER) -> DataFrame:
    """R2b: flag when amount > multiplier x the user's profile average.
    Left join on user_id; profiles hold one row per user."""
    p = profiles.select("user_id", F.col("avg_transaction").cast("double").alias("profile_avg"))
    return (df.join(p, "user_id", "left")
            .withColumn("flag_spike_profile",
                        spike_predicate(F.col("amount"), F.col("profile_avg"), spike_multiplier)))


def prior_average(df: DataFrame, user_col: str = "user_id", ts_col: str = "event_timestamp",
                  tie_col: str = "transaction_id", value_col: str = "amount",
                  chunk_seconds: int = 1, chunks_per_block: int = 3_600) -> DataFrame:
    """Adds prior_sum, prior_count, prior_avg: the user's transactions strictly
    before this one in (time, id) order. Exact decimal sums; rows without a
    user or time get nulls.

    Distributed prefix sum on three levels: running sums inside each (user,
    chunk), of the chunk totals inside each (user, block of chunks), and of the
    block totals of each user. Whole rows are sorted within a chunk only, a second
    by default, so a user's busy hour is spread over its seconds.
    """
    keyed = df.filter(F.col(user_col).isNotNull() & F.col(ts_col).isNotNull())
    rest = df.filter(F.col(user_col).isNull() | F.col(ts_col).isNull())
    chunk_us = int(chunk_seconds) * 1_000_000
    v = money(value_col)
    keyed = keyed.withColumn("_c", _floor_div(F.unix_micros(F.col(ts_col)), chunk_us))
    local = (Window.partitionBy(user_col, "_c").orderBy(ts_col, tie_col)
             .rowsBetween(Window.unboundedPreceding, -1))
    before = Window.unboundedPreceding, -1
    totals = (keyed.groupBy(user_col, "_c").agg(F.sum(v).alias("_cs"), F.count(v).alias("_cn"))
              .withColumn("_b", _floor_div(F.col("_c"), chunks_per_block)))
    blocks = totals.groupBy(user_col, "_b").agg(F.sum("_cs").alias("_bs"), F.sum("_cn").alias("_bn"))
    earlier_blocks = Window.partitionBy(user_col).orderBy("_b").rowsBetween(*before)
    blocks = blocks.select(user_col, "_b", F.sum("_bs").over(earlier_blocks).alias("_bs"),
                           F.sum("_bn").over(earlier_blocks).alias("_bn"))
    earlier_chunks = Window.partitionBy(user_col, "_b").orderBy("_c").rowsBetween(*before)
    nothing = F.lit(0).cast("decimal(38,2)")
    offsets = (totals.withColumn("_s", F.sum("_cs").over(earlier_chunks)).withColumn("_n", F.sum("_cn").over(earlier_chunks))
               .join(blocks, [user_col, "_b"])
               .select(user_col, "_c", (F.coalesce("_s", nothing) + F.coalesce("_bs", nothing)).alias("_os"),
                       (F.coalesce("_n", F.lit(0)) + F.coalesce("_bn", F.lit(0))).alias("_on")))
    keyed = (keyed.withColumn("_ls", F.sum(v).over(local))
             .withColumn("_ln", F.count(v).over(local)))
    zero = F.lit(0).cast("decimal(38,2)")
    out = (keyed.join(offsets, [user_col, "_c"], "left")
           .withColumn("prior_sum", (F.coalesce("_os", zero) + F.coalesce("_ls", zero)).cast("double"))
           .withColumn("prior_count", F.coalesce("_on", F.lit(0)) + F.coalesce("_ln", F.lit(0)))
           .withColumn("prior_avg", F.when(F.col("prior_count") > 0,
                                           F.col("prior_sum") / F.col("prior_count").cast("double")))
           .drop("_c", "_ls", "_ln", "_os", "_on"))
    rest = (rest.withColumn("prior_sum", F.lit(None).cast("double"))
            .withColumn("prior_count", F.lit(None).cast("long"))
            .withColumn("prior_avg", F.lit(None).cast("double")))
    return out.unionByName(rest)


def rule_spike_vs_rolling_avg(df: DataFrame, spike_multiplier: float = SPIKE_MULTIPLIER,
                              chunk_seconds: int = 1) -> DataFrame:
    """R2c: flag when amount > multiplier x the average of the user's earlier
    transactions (first transaction of a user: no average, no flag)."""
    out = prior_average(df, chunk_seconds=chunk_seconds)
    return out.withColumn("flag_spike_rolling",
                          spike_predicate(F.col("amount"), F.col("prior_avg"), spike_multiplier))
