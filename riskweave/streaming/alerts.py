"""Alerts on new fraud-layer files.

The original deployment fires a notification per object created under the
fraud prefix. Here the fraud folder is read as a file stream (each new
committed file is processed exactly once) and every micro-batch is written by
`foreachBatch` as alert rows and as one alert per new file (path, rows,
event-time span). Each batch overwrites only its own `batch_id`
partition, so a retried batch replaces its output instead of duplicating it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from riskweave.functions.expressions import minute_boundaries
from riskweave.session import path_exists

ALERT_SCHEMA = T.StructType([
    T.StructField("transaction_id", T.StringType()), T.StructField("user_id", T.StringType()),
    T.StructField("amount", T.DoubleType()), T.StructField("merchant_name", T.StringType()),
    T.StructField("user_country", T.StringType()), T.StructField("ip_country", T.StringType()),
    T.StructField("fraud_reason", T.StringType()), T.StructField("event_timestamp", T.TimestampType()),
    T.StructField("event_date", T.DateType()), T.StructField("flagged_at", T.TimestampType()),
    T.StructField("minutes_ago", T.LongType()), T.StructField("batch_id", T.LongType())])
ALERT_COLUMNS = ALERT_SCHEMA.names[:-1]


def alert_rows(df: DataFrame, flagged_at: str | None = None, as_of=None) -> DataFrame:
    """Alert shape: the alert query's row columns. The reason is the rule
    reason when the layer carries one, else the label's fraud type. A row is
    flagged at its `flagged_at` column, else when the batch is written;
    minutes_ago counts minute boundaries from then to `as_of`, else to now."""
    reason = F.col("fraud_reason") if "fraud_reason" in df.columns else F.col("fraud_type")
    now = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    flagged = (F.col(flagged_at) if flagged_at else F.current_timestamp()).alias("flagged_at")
    return (df.select("transaction_id", "user_id", "amount", "merchant_name", "user_country",
                      "ip_country", reason.alias("fraud_reason"), "event_timestamp", "event_date", flagged)
            .withColumn("minutes_ago", minute_boundaries("flagged_at", now)))


def read_fraud_stream(spark: SparkSession, path: str, schema: T.StructType,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """New committed files of the fraud layer, with the file each row came from."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return r.parquet(path).withColumn("source_file", F.col("_metadata.file_path"))


def file_alerts(df: DataFrame) -> DataFrame:
    """One alert per new fraud file: its path, row count and event-time span."""
    return (df.groupBy("source_file")
            .agg(F.count(F.lit(1)).alias("rows"), F.min("event_timestamp").alias("first_event"),
                 F.max("event_timestamp").alias("last_event")))


def _overwrite_batch(df: DataFrame, path: str) -> None:
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch_id").parquet(path))


def _writer(out_path: str, flagged_at: str | None, as_of):
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        bid = F.lit(batch_id).cast("long")
        batch = batch.persist()  # read by both outputs
        try:
            _overwrite_batch(alert_rows(batch, flagged_at, as_of).withColumn("batch_id", bid), out_path)
            if "source_file" in batch.columns:
                _overwrite_batch(file_alerts(batch).withColumn("batch_id", bid), f"{out_path}_files")
        finally:
            batch.unpersist()
    return write_batch


def start_alerts(fraud_stream: DataFrame, out_path: str, checkpoint: str, trigger=None,
                 flagged_at: str | None = None, as_of=None) -> StreamingQuery:
    w = (fraud_stream.writeStream.foreachBatch(_writer(out_path, flagged_at, as_of))
         .option("checkpointLocation", checkpoint).queryName("fraud_alerts"))
    if trigger == "availableNow":
        w = w.trigger(availableNow=True)
    else:
        w = w.trigger(processingTime=trigger or "30 seconds")
    return w.start()


FILE_ALERT_SCHEMA = T.StructType([
    T.StructField("source_file", T.StringType()), T.StructField("rows", T.LongType()),
    T.StructField("first_event", T.TimestampType()), T.StructField("last_event", T.TimestampType()),
    T.StructField("batch_id", T.LongType())])


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A folder that has been written, else no rows with its columns."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def read_alerts(spark: SparkSession, out_path: str) -> DataFrame:
    return _read(spark, out_path, ALERT_SCHEMA)


def read_file_alerts(spark: SparkSession, out_path: str) -> DataFrame:
    return _read(spark, f"{out_path}_files", FILE_ALERT_SCHEMA)
