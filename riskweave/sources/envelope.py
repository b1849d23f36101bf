"""Raw message sources: the stream envelope and JSON-lines event files.

The managed stream connector of the original deployment is not bundled with
Spark, so the source is pluggable: `read_connector_stream` maps the columns of
any connector on the class path to the envelope. A message landing folder (one JSON line per
message: data, approximateArrivalTimestamp, shardId) is read with the file
stream source, which processes each new file exactly once and, started
fresh, reads everything already there (the "from the earliest record"
position). A folder of bare payload lines can be read too; its arrival time is
the file's modification time.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from riskweave.schemas import ENVELOPE_FILE_SCHEMA, PAYMENT_SCHEMA, RAW_MESSAGE, RULE_EVENT_SCHEMA


@dataclass(frozen=True)
class Connector:
    """How a streaming source gives the envelope: SQL expressions over its
    columns, and the options that set where to start and how much to read."""

    format: str
    data: str
    arrival: str
    shard: str
    start_option: str | None = None
    rate_option: str | None = None
    schema: T.StructType | None = None


#: Sources known by name; others are given as a Connector of their own.
CONNECTORS = {
    "kafka": Connector("kafka", "value", "timestamp", "CAST(partition AS STRING)", "startingOffsets", "maxOffsetsPerTrigger"),
    "json": Connector("json", "CAST(data AS BINARY)", "approximateArrivalTimestamp", "shardId", None, "maxFilesPerTrigger",
                      ENVELOPE_FILE_SCHEMA),
    "text": Connector("text", "CAST(value AS BINARY)", "_metadata.file_modification_time", "'0'", None, "maxFilesPerTrigger"),
}


def read_connector_stream(spark: SparkSession, source: str | Connector, options: dict[str, str] | None = None,
                          path: str | None = None, start: str | None = None, rate_limit: int | None = None) -> DataFrame:
    """Streaming read of any source as the envelope (data, approximateArrivalTimestamp, shardId).

    `start` and `rate_limit` are given by the source's own options; asking for
    one that the source lacks is an error. File sources read all files that
    are there, then each new one.
    """
    c = CONNECTORS[source] if isinstance(source, str) else source
    given = dict(options or {})
    for value, option, what in ((start, c.start_option, "start position"), (rate_limit, c.rate_option, "rate limit")):
        if value is not None:
            if option is None:
                raise ValueError(f"{c.format} has no {what}")
            given[option] = str(value)
    reader = spark.readStream.format(c.format).options(**given)
    if c.schema is not None:
        reader = reader.schema(c.schema).option("timestampFormat", TS_FORMAT)
    rows = reader.load(path) if path else reader.load()
    return rows.selectExpr(f"{c.data} AS data", f"{c.arrival} AS approximateArrivalTimestamp", f"{c.shard} AS shardId")


TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def _envelope(df: DataFrame) -> DataFrame:
    return df.select(F.col("data").cast("binary").alias("data"),
                     F.col("approximateArrivalTimestamp"), F.col("shardId"))


def land_messages(envelope: DataFrame, path: str, files: int | None = None) -> None:
    """Write envelope rows as JSON-lines message files (what a delivery agent
    drops into the landing folder). Appends, never overwrites."""
    out = envelope.select(F.col("data").cast("string").alias("data"),
                          "approximateArrivalTimestamp", "shardId")
    if files:
        out = out.repartition(files)
    out.write.mode("append").option("timestampFormat", TS_FORMAT).json(path)


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """Batch read of a landing folder as the envelope."""
    df = spark.read.schema(ENVELOPE_FILE_SCHEMA).option("timestampFormat", TS_FORMAT).json(path)
    return _envelope(df)


def replayed(rejects: DataFrame, mend=None) -> DataFrame:
    """Rejected bronze rows that still hold their message, as the envelope:
    the text, passed through `mend` (Column -> Column) if given, with its
    arrival time and shard. To be parsed again, or landed (`land_messages`)."""
    text = F.col(RAW_MESSAGE)
    return rejects.filter(text.isNotNull()).select(
        (mend(text) if mend else text).cast("binary").alias("data"),
        F.col("kinesis_arrival_time").alias("approximateArrivalTimestamp"), F.col("shard_id").alias("shardId"))


def read_message_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None
                        ) -> DataFrame:
    """Streaming read of a landing folder as the envelope (all existing files
    first, then each new file once)."""
    r = spark.readStream.schema(ENVELOPE_FILE_SCHEMA).option("timestampFormat", TS_FORMAT)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return _envelope(r.json(path))


def read_payload_text_stream(spark: SparkSession, path: str, shard: str = "0") -> DataFrame:
    """Streaming read of bare payload lines; arrival = file modification time."""
    df = spark.readStream.format("text").load(path)
    return df.select(F.col("value").cast("binary").alias("data"),
                     F.col("_metadata.file_modification_time").alias("approximateArrivalTimestamp"),
                     F.lit(shard).alias("shardId"))


def read_payment_json(spark: SparkSession, path: str) -> DataFrame:
    """JSON-lines payment events with the fixed payload schema (no inference)."""
    return spark.read.schema(PAYMENT_SCHEMA).json(path)


def read_rule_event_json(spark: SparkSession, path: str) -> DataFrame:
    """JSON-lines rule events (payload without labels, plus avg_spend), with
    event_timestamp parsed from the ISO text in UTC."""
    df = spark.read.schema(RULE_EVENT_SCHEMA).json(path)
    return df.withColumn("event_timestamp", F.try_to_timestamp(F.col("timestamp")))
