"""Compaction of closed hours: many small stream files into few large ones.

The streams' folders are never touched: their commit logs name every file, and
queries that read them go on undisturbed. A closed partition (an hour of silver, a day of
bronze) is packed into a folder of its own beside the layer, by bytes, and a
reader takes packed partitions from there and all others from the layer
(`read_compacted`). A marker per partition, written last, holds the digest of
the files it was packed from: a partition whose files have changed since, or
whose packing broke off, counts as not packed, and running the job again packs
just these.
"""

from __future__ import annotations

import hashlib
import re
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from riskweave.session import list_folder, path_exists, remove_path
from riskweave.sources.tables import read_layer

TARGET_BYTES = 256 * 1024 ** 2
MARKS_SCHEMA = "partition string, files string, n_files long, packed_into string"


def partition_files(layer: DataFrame, partitions) -> dict[str, list[str]]:
    """Files of a layer scan by partition folder (`event_date=.../event_hour=...`)."""
    pattern = "/".join(f"{p}=[^/]+" for p in partitions)
    out: dict[str, list[str]] = {}
    for path in layer.inputFiles():
        found = re.search(pattern, path)
        if found:
            out.setdefault(unquote(found.group(0)), []).append(path)
    return out


def _digest(files: list[str]) -> str:
    return hashlib.sha256("\n".join(sorted(f.rsplit("/", 1)[-1] for f in files)).encode()).hexdigest()


def _is(partition: str) -> Column:
    """Rows of one partition folder."""
    parts = [p.split("=", 1) for p in partition.split("/")]
    return reduce(lambda a, b: a & b, [F.col(c).isNull() if v == "__HIVE_DEFAULT_PARTITION__" else F.col(c) == v for c, v in parts])


def _marks(spark: SparkSession, packed_root: str) -> dict[str, dict]:
    if not path_exists(spark, f"{packed_root}/marks"):
        return {}
    rows = spark.read.schema(MARKS_SCHEMA + ", run long").parquet(f"{packed_root}/marks").collect()  # one row a partition and run
    return {r["partition"]: r.asDict() for r in sorted(rows, key=lambda r: r["run"])}


def compact(spark: SparkSession, path: str, schema: T.StructType, partitions, packed_root: str, closed: Column,
            target_bytes: int = TARGET_BYTES, sort=()) -> list[str]:
    """Pack every partition that `closed` accepts and that is not packed as it
    is now. Returns the partitions packed by this run.

    A partition becomes bytes / `target_bytes` files, all in one job: rows are
    dealt by partition and a salt below that number, and sorted by `sort`.
    """
    files = partition_files(read_layer(spark, path, schema), partitions)
    marks = _marks(spark, packed_root)
    shut = _closed(spark, files, schema, partitions, closed)
    todo = {p: f for p, f in files.items() if p in shut and (p not in marks or marks[p]["files"] != _digest(f))}
    if not todo:
        return []
    run = 1 + max((m["run"] for m in marks.values()), default=0)
    while path_exists(spark, f"{packed_root}/data/run={run}"):  # what a broken run left is not reused
        run += 1
    sizes = _bytes(spark, path, todo)
    plan = spark.createDataFrame([(p, max(1, -(-sizes[p] // target_bytes))) for p in sorted(todo)], "_partition string, _files long")
    name = F.concat_ws("/", *(F.concat(F.lit(f"{p}="), F.coalesce(F.col(p).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__")))
                              for p in partitions))
    rows = (read_layer(spark, path, schema).filter(reduce(lambda a, b: a | b, map(_is, todo)))
            .withColumn("_partition", name).join(F.broadcast(plan), "_partition")
            .withColumn("_salt", F.pmod(F.xxhash64(*schema.names), F.col("_files"))))
    (rows.repartition(sum(r["_files"] for r in plan.collect()), "_partition", "_salt").sortWithinPartitions("_partition", *sort).drop("_partition", "_files", "_salt")
     .write.partitionBy(*partitions).parquet(f"{packed_root}/data/run={run}"))
    done = [(p, _digest(f), len(f), f"{packed_root}/data/run={run}/{p}") for p, f in sorted(todo.items())]
    (spark.createDataFrame(done, MARKS_SCHEMA).coalesce(1).withColumn("run", F.lit(run)).write.mode("append")
     .partitionBy("run").parquet(f"{packed_root}/marks"))
    return sorted(todo)


def _closed(spark: SparkSession, files, schema: T.StructType, partitions, closed: Column) -> set[str]:
    """Partition folders that the condition accepts, from their names alone."""
    named = [[p, *(None if v.endswith("=__HIVE_DEFAULT_PARTITION__") else v.split("=", 1)[1] for v in p.split("/"))] for p in sorted(files)]
    if not named:
        return set()
    names = spark.createDataFrame(named, "_folder string, " + ", ".join(f"{p} string" for p in partitions))
    kinds = {p: schema[p].dataType for p in partitions}
    return {r[0] for r in names.withColumns({p: F.col(p).cast(kinds[p]) for p in partitions}).filter(closed).select("_folder").collect()}


def _bytes(spark: SparkSession, path: str, todo: dict[str, list[str]]) -> dict[str, int]:
    out = {}
    for p, files in todo.items():
        own = {f.rsplit("/", 1)[-1] for f in files}
        out[p] = sum(size for name, folder, size, _ in list_folder(spark, f"{path.rstrip('/')}/{p}") if name in own and not folder)
    return out


def read_compacted(spark: SparkSession, path: str, schema: T.StructType, partitions, packed_root: str) -> DataFrame:
    """The layer's rows: partitions that are packed as they are now from the
    packed files, all others from the layer."""
    layer = read_layer(spark, path, schema)
    files, marks = partition_files(layer, partitions), _marks(spark, packed_root)
    packed = sorted(p for p, m in marks.items() if p in files and m["files"] == _digest(files[p]))
    if not packed:
        return layer
    rest = [f for p, fs in files.items() if p not in set(packed) for f in fs]
    runs: dict[str, list[str]] = {}
    for p in packed:
        runs.setdefault(marks[p]["packed_into"][:-len(p) - 1], []).append(marks[p]["packed_into"])
    parts = [spark.read.schema(schema).option("basePath", base).parquet(*folders) for base, folders in sorted(runs.items())]
    if rest:
        parts.append(spark.read.schema(schema).option("basePath", path).parquet(*rest))
    return reduce(DataFrame.unionByName, parts)


def retire(spark: SparkSession, packed_root: str) -> list[str]:
    """Remove packed folders that a later run has replaced. To be run when no
    reader that began before that run is left."""
    used = {m["packed_into"] for m in _marks(spark, packed_root).values()}
    gone = []
    for run, folder, _, _ in list_folder(spark, f"{packed_root}/data"):
        base = f"{packed_root}/data/{run}"
        if folder and not any(u.startswith(f"{base}/") for u in used):
            remove_path(spark, base)
            gone.append(run)
    return gone
