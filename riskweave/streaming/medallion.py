"""Streaming medallion job: messages -> bronze -> silver -> labelled fraud.

The layer transforms are the batch ones (operators.layers): stateless
projections and filters, fused into one codegen stage per micro-batch.
Sinks are parquet folders with their own checkpoint, append mode and a
processing-time trigger (30 s; tests use availableNow).

Small files: a micro-batch whose rows span many partition values (a
backfill, a late burst) would otherwise write one file per (task, value).
Each layer is therefore clustered on its partition columns and a salt before
the sink, with one shuffle per micro-batch, so a partition value is written by
`writers_per_partition` tasks: a batch of one hour, or of malformed rows
without a date, is spread over as many. The salt is a hash of the whole row,
so rows without an id are spread too. Set it to about the write tasks that a
busy hour's batch needs; None writes without a shuffle.

Topology (T1): `chain=True` (default) reads the source once — the bronze
query lands parquet, silver reads bronze's committed files as a file stream,
fraud reads silver's. `chain=False` runs the three queries side by side from
the same source, each re-reading it, as in the original job.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from riskweave.operators import layers
from riskweave.schemas import (BRONZE_LAYER_SCHEMA, BRONZE_PARTITIONS, FRAUD_PARTITIONS,
                               SILVER_LAYER_SCHEMA, SILVER_PARTITIONS)

TRIGGER_INTERVAL = "30 seconds"
CONSOLE_INTERVAL = "10 seconds"


def _trigger(w, trigger):
    if trigger == "availableNow":
        return w.trigger(availableNow=True)
    if trigger == "once":
        return w.trigger(once=True)
    return w.trigger(processingTime=trigger or TRIGGER_INTERVAL)


#: Tasks that write one partition value of a micro-batch.
WRITERS_PER_PARTITION = 4


def clustered(df: DataFrame, partition_by, writers_per_partition: int = WRITERS_PER_PARTITION) -> DataFrame:
    """Rows dealt by the partition columns and a salt, so that each partition
    folder gets few, large files from several tasks."""
    if not partition_by:
        return df
    salt = F.pmod(F.xxhash64(*df.columns), F.lit(int(writers_per_partition)))
    return df.repartition(*[F.col(c) for c in partition_by], salt)


def write_layer(df: DataFrame, path: str, checkpoint: str, partition_by=(), trigger=None,
                name: str | None = None, writers_per_partition: int | None = WRITERS_PER_PARTITION
                ) -> StreamingQuery:
    """Parquet file sink: exactly-once via the sink's commit log.
    `writers_per_partition=None` skips the clustering shuffle."""
    if writers_per_partition:
        df = clustered(df, partition_by, writers_per_partition)
    w = (df.writeStream.format("parquet").option("path", path)
         .option("checkpointLocation", checkpoint).outputMode("append"))
    if partition_by:
        w = w.partitionBy(*partition_by)
    if name:
        w = w.queryName(name)
    return _trigger(w, trigger).start()


def write_bronze(bronze: DataFrame, path: str, checkpoint: str, trigger=None,
                 writers_per_partition: int | None = WRITERS_PER_PARTITION) -> StreamingQuery:
    return write_layer(bronze, path, checkpoint, BRONZE_PARTITIONS, trigger, "bronze", writers_per_partition)


def write_silver(silver: DataFrame, path: str, checkpoint: str, trigger=None,
                 writers_per_partition: int | None = WRITERS_PER_PARTITION) -> StreamingQuery:
    return write_layer(silver, path, checkpoint, SILVER_PARTITIONS, trigger, "silver", writers_per_partition)


def write_fraud(fraud: DataFrame, path: str, checkpoint: str, trigger=None,
                writers_per_partition: int | None = WRITERS_PER_PARTITION) -> StreamingQuery:
    return write_layer(fraud, path, checkpoint, FRAUD_PARTITIONS, trigger, "fraud", writers_per_partition)


def write_console(df: DataFrame, rows: int = 10, trigger=CONSOLE_INTERVAL) -> StreamingQuery:
    """Console sink for local inspection: `rows` rows, no truncation."""
    w = (df.writeStream.format("console").option("truncate", False)
         .option("numRows", rows).outputMode("append"))
    return _trigger(w, trigger).start()


@dataclass
class LakePaths:
    root: str

    @property
    def bronze(self):
        return f"{self.root}/bronze/payments"

    @property
    def silver(self):
        return f"{self.root}/silver/payments"

    @property
    def fraud(self):
        return f"{self.root}/silver/fraud"

    def checkpoint(self, name):
        return f"{self.root}/checkpoints/{name}"


def _layer_stream(spark: SparkSession, path: str, schema, max_files_per_trigger: int | None) -> DataFrame:
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return r.parquet(path)


def read_bronze_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    return _layer_stream(spark, path, BRONZE_LAYER_SCHEMA, max_files_per_trigger)


def read_silver_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    return _layer_stream(spark, path, SILVER_LAYER_SCHEMA, max_files_per_trigger)


def start_bronze(spark: SparkSession, raw: DataFrame, lake: LakePaths, trigger=None,
                 writers_per_partition: int | None = WRITERS_PER_PARTITION) -> StreamingQuery:
    """Bronze keeps the text of messages that could not be read (`raw_message`)."""
    return write_bronze(layers.parse_to_bronze(raw, keep_raw=True), lake.bronze, lake.checkpoint("bronze"), trigger,
                        writers_per_partition)


def start_silver(spark: SparkSession, lake: LakePaths, trigger=None, raw: DataFrame | None = None,
                 writers_per_partition: int | None = WRITERS_PER_PARTITION,
                 max_files_per_trigger: int | None = None) -> StreamingQuery:
    src = (read_bronze_stream(spark, lake.bronze, max_files_per_trigger) if raw is None
           else layers.parse_to_bronze(raw))
    return write_silver(layers.transform_to_silver(src), lake.silver, lake.checkpoint("silver"), trigger,
                        writers_per_partition)


def start_fraud(spark: SparkSession, lake: LakePaths, trigger=None, raw: DataFrame | None = None,
                writers_per_partition: int | None = WRITERS_PER_PARTITION,
                max_files_per_trigger: int | None = None) -> StreamingQuery:
    if raw is None:
        src = read_silver_stream(spark, lake.silver, max_files_per_trigger)
    else:
        src = layers.transform_to_silver(layers.parse_to_bronze(raw))
    return write_fraud(layers.filter_fraud(src), lake.fraud, lake.checkpoint("fraud"), trigger,
                       writers_per_partition)


def run_medallion(spark: SparkSession, raw: DataFrame, lake: LakePaths, trigger=None,
                 chain: bool = True, layers_to_run=("bronze", "silver", "fraud"),
                 writers_per_partition: int | None = WRITERS_PER_PARTITION,
                 max_files_per_trigger: int | None = None) -> list[StreamingQuery]:
    """Start the medallion queries. With a finite trigger (availableNow/once)
    and `chain`, each stage is drained before the next starts, so a single
    call processes everything available end to end. `max_files_per_trigger`
    limits what the chained stages read at a time; the raw stream has its own."""
    finite = trigger in ("availableNow", "once")
    queries = []
    own = None if chain else raw
    starters = {
        "bronze": lambda: start_bronze(spark, raw, lake, trigger, writers_per_partition),
        "silver": lambda: start_silver(spark, lake, trigger, own, writers_per_partition, max_files_per_trigger),
        "fraud": lambda: start_fraud(spark, lake, trigger, own, writers_per_partition, max_files_per_trigger),
    }
    sink_paths = {"bronze": lake.bronze, "silver": lake.silver, "fraud": lake.fraud}
    for name in layers_to_run:
        q = starters[name]()
        queries.append(q)
        if chain and finite:
            q.awaitTermination()
        elif chain:
            wait_for_sink_log(spark, sink_paths[name], q)
    return queries


def wait_for_sink_log(spark: SparkSession, path: str, query: StreamingQuery, timeout_s: float = 120.0) -> None:
    """Block until the file sink at `path` has created its commit log.

    A file-stream source decides once whether its folder is a sink output
    (then it reads only committed files through `_spark_metadata`) or a plain
    folder. A chained downstream query must therefore start only after the
    upstream sink has created that log, which it does when it initialises."""
    import time
    from riskweave.session import path_exists
    deadline = time.time() + timeout_s
    log = f"{path}/_spark_metadata"
    while not path_exists(spark, log):
        if query.exception() is not None:
            raise query.exception()
        if time.time() > deadline:
            raise TimeoutError(f"sink log not created at {log}")
        time.sleep(0.2)


def await_any(spark: SparkSession, timeout: float | None = None):
    """Block until any query ends (a failed query ends the job)."""
    return spark.streams.awaitAnyTermination(timeout) if timeout else spark.streams.awaitAnyTermination()


def drain_and_stop(queries) -> None:
    """Graceful stop: process what is available, then stop each query."""
    for q in queries:
        if q.isActive:
            q.processAllAvailable()
            q.stop()
