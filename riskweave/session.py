"""Session helpers: one place that knows how the engine expects Spark to be set up.

Nothing here changes query results except the session time zone: every event
time in the payment data model is an instant written with a UTC offset, and
`to_date` / `hour` must read it in UTC (see schemas.py).
"""

from __future__ import annotations

import atexit
import contextlib
import uuid

from pyspark.sql import SparkSession

UTC = "UTC"


def build_session(master: str | None = None, app: str = "riskweave",
                  shuffle_partitions: int | None = None, **conf) -> SparkSession:
    """Local/test session builder. On a cluster, pass master=None and let
    spark-submit supply master, memory and `spark.checkpoint.dir`."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    base = {
        "spark.sql.session.timeZone": UTC,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if shuffle_partitions:
        base["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    base.update({k: str(v) for k, v in conf.items()})
    for k, v in base.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_conf(input_bytes: int, executor_cores: int, executors: int,
                 target_partition_bytes: int = 256 * 1024 ** 2) -> dict[str, str]:
    """Shuffle and scan sizing for a given input size (for spark-submit).

    Initial shuffle partitions are set so that each is about
    `target_partition_bytes` of input (narrow shuffles are smaller than the
    input) and at least 3x the task slots; AQE then coalesces small ones and
    splits skewed ones. Scan splits stay at 256 MB.
    """
    slots = executor_cores * executors
    parts = max(3 * slots, -(-int(input_bytes) // int(target_partition_bytes)))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 ** 2),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.files.maxPartitionBytes": str(256 * 1024 ** 2),
        "spark.sql.session.timeZone": UTC,
    }


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the session zone to UTC (event times carry +00:00 offsets)."""
    if spark.conf.get("spark.sql.session.timeZone") != UTC:
        spark.conf.set("spark.sql.session.timeZone", UTC)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder for checkpoints, stream state and swap tables.

    Read from the session (`spark.checkpoint.dir`, else the context's
    checkpoint dir). A local-mode session without one gets a folder in its
    warehouse; a cluster session without one is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if d:
        return d.rstrip("/")
    master = spark.sparkContext.master or ""
    if not master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    d = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_riskweave"
    spark.sparkContext.setCheckpointDir(d)
    return d


#: Set to "true" to keep an application's scratch folder when its driver ends.
KEEP_SCRATCH = "spark.riskweave.keepScratch"
_scratch: set[str] = set()


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique path under the shared folder (never reused), in a folder
    of the application's own. What lies there backs the frames that were built
    on it, so it is removed when the driver ends, not before."""
    root = f"{shared_dir(spark)}/riskweave/{spark.sparkContext.applicationId}"
    if root not in _scratch:
        _scratch.add(root)
        if spark.conf.get(KEEP_SCRATCH, "false") != "true":
            fs, hp = _file_system(spark, root)
            atexit.register(_remove_quietly, fs, hp)
    name = "-".join(p for p in parts if p) or "run"
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def _remove_quietly(fs, hp) -> None:
    with contextlib.suppress(Exception):  # the JVM may be gone before Python ends
        fs.delete(hp, True)


def _file_system(spark: SparkSession, path: str):
    hp = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hp.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hp


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the session's Hadoop FileSystem (any scheme)."""
    fs, hp = _file_system(spark, path)
    return bool(fs.exists(hp))


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme, as the catalog writes it."""
    fs, hp = _file_system(spark, path)
    return str(fs.makeQualified(hp).toString()).rstrip("/")


def remove_path(spark: SparkSession, path: str) -> bool:
    """Delete a folder that the library itself wrote; False if there is none."""
    fs, hp = _file_system(spark, path)
    return bool(fs.delete(hp, True))


def read_small(spark: SparkSession, path: str) -> str:
    """The text of one small file, such as a stream's log of a batch, which
    Spark's own readers do not show."""
    fs, hp = _file_system(spark, path)
    stream = fs.open(hp)
    try:
        return str(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def list_folder(spark: SparkSession, path: str) -> list[tuple[str, bool, int, int]]:
    """(name, is folder, bytes, modified in ms) of what lies in a folder, by
    name; nothing if the folder does not exist."""
    fs, hp = _file_system(spark, path)
    if not fs.exists(hp):
        return []
    return sorted((str(s.getPath().getName()), bool(s.isDirectory()), int(s.getLen()), int(s.getModificationTime()))
                  for s in fs.listStatus(hp))
