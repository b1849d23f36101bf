"""Batch sinks: CSV reports, layered table writes, append, keyed upsert.

* `write_csv`          header, no index column (run reports, flagged exports)
* `write_table`        physical layout of a warehouse table: hash distribution
                       on the key (co-locates later joins / aggregates / windows
                       by user), sort keys within partitions (min/max skipping),
                       partition folders; or round-robin for even tables
* `append_rows`        INSERT INTO ... SELECT (plain append)
* `replace_partitions` idempotent variant: dynamic overwrite of only the
                       partitions present in the new rows (re-running a day
                       replaces that day)
* `load_table`         bulk load: conform, replace or append, keep the rejects
* `upsert_table`       keyed upsert into a catalog table: the merged result is
                       written to a fresh folder and the table is pointed at it
                       (never overwrites the folder being read)
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql import types as T

from riskweave.schemas import LAYOUT, contract
from riskweave.session import list_folder, path_exists, remove_path, scratch_path
from riskweave.sources.tables import table_bytes, table_location, tagged


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("header", True).csv(path)


#: Tasks that write one partition folder, or the whole of an unpartitioned table per distribution key.
WRITERS = 8


def laid_out(df: DataFrame, table: str, num_partitions: int | None = None, writers: int = WRITERS) -> DataFrame:
    """Apply the table's distribution and sort keys to a DataFrame.

    Rows are dealt by partition folder and by the hashed distribution key
    modulo `writers`: a folder gets at most `writers` files, and one user's
    rows of a folder lie in one of them; a user who holds much of the table is
    spread over its folders."""
    lay = LAYOUT[contract(table)]
    parts = [F.col(c) for c in lay["partition"] if c in df.columns]
    key = lay.get("distribute")
    salt = F.pmod(F.xxhash64(key or F.struct(*df.columns)), F.lit(writers))
    if parts:
        keys = [*parts, salt]
        df = df.repartition(num_partitions, *keys) if num_partitions else df.repartition(*keys)
    elif key:
        df = df.repartition(num_partitions, key) if num_partitions else df.repartition(key)
    elif num_partitions:
        df = df.repartition(num_partitions)  # even (round-robin) distribution
    sort = [c for c in lay["sort"] if c in df.columns]
    return df.sortWithinPartitions(*lay["partition"], *[c for c in sort if c not in lay["partition"]]) if sort else df


def write_table(df: DataFrame, table: str, path: str, mode: str = "append",
                num_partitions: int | None = None) -> None:
    lay = LAYOUT[contract(table)]
    w = laid_out(df, table, num_partitions).write.mode(mode)
    parts = [c for c in lay["partition"] if c in df.columns]
    if parts:
        w = w.partitionBy(*parts)
    w.parquet(path)


def write_bucketed(df: DataFrame, table: str, name: str, buckets: int, path: str | None = None) -> None:
    """Bucketed catalog table on the distribution key, sorted by the sort keys,
    so joins/aggregations on the key read without a shuffle."""
    lay = LAYOUT[contract(table)]
    w = df.write.mode("overwrite").format("parquet").bucketBy(buckets, lay["distribute"])
    sort = [c for c in lay["sort"] if c in df.columns]
    if sort:
        w = w.sortBy(*sort)
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)


def _aligned(df: DataFrame, table_name: str) -> DataFrame:
    """Columns in the table's order (partition columns last), matched by name."""
    return df.select(*df.sparkSession.table(table_name).columns)


def append_rows(df: DataFrame, table_name: str) -> None:
    """INSERT INTO table SELECT ... (columns matched by name)."""
    _aligned(df, table_name).write.insertInto(table_name, overwrite=False)


def replace_partitions(df: DataFrame, table_name: str) -> None:
    """Idempotent append: overwrite only the partitions present in `df`, each
    written in the table's layout."""
    spark = df.sparkSession
    laid = laid_out(_aligned(df, table_name), table_name) if contract(table_name) in LAYOUT else _aligned(df, table_name)
    parts = [f.name for f in spark.catalog.listColumns(table_name) if f.isPartition]
    (laid.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*parts).parquet(table_location(spark, table_name)))
    spark.catalog.recoverPartitions(table_name)
    spark.catalog.refreshTable(table_name)


def replace_table(df: DataFrame, table_name: str) -> str:
    """Idempotent load of an unpartitioned table: a new copy in the table's
    layout, to which the table is then pointed. Returns the new location."""
    spark = df.sparkSession
    return upsert_table(spark, table_name, df,
                        lambda old, new: laid_out(new, table_name) if contract(table_name) in LAYOUT else new)


def load_table(df: DataFrame, table: str, as_of=None, mode: str = "replace", load: str | None = None) -> dict[str, int]:
    """Bulk load into a warehouse table: accepted rows replace the partitions
    they fall in, or all of an unpartitioned table (mode "replace"), or are
    added (mode "append"). Rejected rows go, with their reason, to the table's
    reject folder under `load`. Returns how many went where.

    The input is read and parsed once: every row is written, tagged, to a
    scratch folder, which counts both sides on the way; what goes to the table
    and to the rejects is read from there. A replacing load replaces the rejects of
    the same `load` ("all" if not named), so a rerun leaves accepted + rejected =
    input; an appending load adds a folder of rejects.
    """
    spark = df.sparkSession
    stage = scratch_path(spark, "load")
    both, seen = tagged(df, table, as_of), Observation()
    (both.observe(seen, F.count("accepted").alias("accepted"), F.count("rejected").alias("rejected"))
     .write.parquet(stage))
    rows = spark.read.schema(both.schema).parquet(stage)
    accepted = rows.filter("accepted IS NOT NULL").select("accepted.*")
    if mode == "append":
        append_rows(accepted, table)
    elif LAYOUT[contract(table)]["partition"]:
        replace_partitions(accepted, table)
    else:
        replace_table(accepted, table)
    if LAYOUT[contract(table)].get("replicate"):
        table_bytes(spark, table, analyze=True)  # readers decide by the statistics whether to broadcast it
    name = load or ("all" if mode == "replace" else uuid.uuid4().hex[:12])
    (rows.filter("rejected IS NOT NULL").select("rejected.*")
     .write.mode("overwrite").parquet(f"{reject_folder(spark, table)}/load={name}"))
    remove_path(spark, stage)
    return {k: int(seen.get[k]) for k in ("accepted", "rejected")}


def reject_folder(spark: SparkSession, table: str) -> str:
    return f"{table_location(spark, table).rsplit('/', 1)[0]}/{table.replace('.', '_')}_rejects"


def read_rejects(spark: SparkSession, table: str, schema, load: str | None = None) -> DataFrame:
    """Rejected rows of a table with their reason: of one load, or of all with
    the column `load`. `schema` is that of the loaded frame, without its
    partition folders' order; nothing loaded gives no rows."""
    more = ["reject_reason"] if load else ["reject_reason", "load"]
    fields = T.StructType([*schema.fields, *(T.StructField(c, T.StringType()) for c in more)])
    path = reject_folder(spark, table) + (f"/load={load}" if load else "")
    if not path_exists(spark, path):
        return spark.createDataFrame([], fields)
    return spark.read.schema(fields).parquet(path)


def upsert_table(spark: SparkSession, table_name: str, new: DataFrame, merge, root: str | None = None
                 ) -> str:
    """Merge `new` into catalog table `table_name` with `merge(existing, new)`
    and swap the table to the merged copy. Returns the new location. The copy
    that it replaces stays for readers until the next swap; older ones go."""
    current = spark.table(table_name)
    before = table_location(spark, table_name)
    merged = merge(current, new).select(*current.columns)
    base = root or table_location(spark, table_name).rsplit("/", 1)[0]
    target = f"{base.rstrip('/')}/{table_name.replace('.', '_')}-v{uuid.uuid4().hex[:12]}"
    merged.write.mode("errorifexists").parquet(target)
    spark.sql(f"ALTER TABLE {table_name} SET LOCATION '{target}'")
    spark.catalog.refreshTable(table_name)
    copies = f"{table_name.replace('.', '_')}-v"
    for name, folder, _, _ in list_folder(spark, base):
        if folder and name.startswith(copies) and name not in (target.rsplit("/", 1)[1], before.rstrip("/").rsplit("/", 1)[1]):
            remove_path(spark, f"{base.rstrip('/')}/{name}")
    return target


# ----------------------------------------------------- upsert of some buckets
#: Buckets of a keyed table; an upsert rewrites only those that its keys fall in.
KEY_BUCKETS = 64


def bucket_of(key: str, buckets: int):
    return F.pmod(F.xxhash64(key), F.lit(int(buckets))).cast("int")


def create_keyed_table(spark: SparkSession, table: str, root: str, databases: str | None = None) -> str:
    """The warehouse table with a further partition column `bucket`, a hash of
    its key, each bucket at a location of its own (`upsert_buckets`)."""
    from riskweave.sources.tables import _ddl
    db, _, name = table.rpartition(".")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}" + (f" LOCATION '{databases}/{db}'" if databases else ""))
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({_ddl(table)}, bucket INT) USING parquet PARTITIONED BY (bucket) "
              f"LOCATION '{root.rstrip('/')}/{db}/{name}'")
    return table


def bucket_locations(spark: SparkSession, table: str) -> dict[int, str]:
    """Where the catalog says each bucket lies."""
    out = {}
    for r in spark.sql(f"SHOW PARTITIONS {table}").collect():
        bucket = int(r[0].split("=")[1])
        told = spark.sql(f"DESCRIBE TABLE EXTENDED {table} PARTITION (bucket={bucket})").collect()
        out[bucket] = next(d[1] for d in told if d[0] == "Location")  # the table's own comes after it
    return out


def upsert_buckets(spark: SparkSession, table: str, new: DataFrame, merge, buckets: int = KEY_BUCKETS) -> dict[int, str]:
    """Merge `new` into a keyed table with `merge(existing, new)`, rewriting only
    the buckets that hold a key of `new`. Returns their new locations.

    The merged buckets are written beside the table first, all of them; then the
    catalog is pointed at them one by one. A crash before that leaves the table as it was;
    one in the middle leaves each bucket either old or new, and running the
    upsert again completes it. The copies that the swapped buckets replaced are kept
    until the next upsert of the same buckets, for readers that began before.
    """
    key = LAYOUT[contract(table)]["distribute"]
    columns = [c for c in spark.table(table).columns if c != "bucket"]
    base = table_location(spark, table)
    where = bucket_locations(spark, table)
    stage = scratch_path(spark, "upsert")
    new.withColumn("_bucket", bucket_of(key, buckets)).write.partitionBy("_bucket").parquet(stage)
    staged = spark.read.schema(T.StructType([*new.schema.fields, T.StructField("_bucket", T.IntegerType())])).parquet(stage)
    hit = sorted(r[0] for r in staged.select("_bucket").distinct().collect())  # as many as buckets at most
    old_paths = [where[b] for b in hit if b in where]
    shape = spark.table(table).drop("bucket").schema
    old = spark.read.schema(shape).parquet(*old_paths) if old_paths else spark.createDataFrame([], shape)
    version = f"{base}/v={uuid.uuid4().hex[:12]}"
    out = merge(old, staged.drop("_bucket")).select(*columns).withColumn("bucket", bucket_of(key, buckets))
    sort = [c for c in LAYOUT[contract(table)]["sort"] if c in columns]
    (out.repartition("bucket").sortWithinPartitions("bucket", *sort).write.partitionBy("bucket").parquet(version))
    written = {n for n, folder, _, _ in list_folder(spark, version) if folder}
    remove_path(spark, stage)
    return _point_at(spark, table, {b: f"{version}/bucket={b}" for b in hit if f"bucket={b}" in written}, hit, where)


def _point_at(spark: SparkSession, table: str, locations: dict[int, str], hit: list[int], before: dict[int, str]) -> dict[int, str]:
    """Swap the buckets to their new folders, and remove those folders of the
    same buckets that nothing pointed at even before the swap."""
    base, used = table_location(spark, table), {*before.values(), *locations.values()}
    folders = [f"{base}/{v}/bucket={b}" for v, folder, _, _ in list_folder(spark, base) if folder and v.startswith("v=") for b in hit]
    for bucket in hit:
        where = f"ALTER TABLE {table} %s PARTITION (bucket={bucket})"
        if bucket not in locations:
            spark.sql(where % "DROP IF EXISTS")  # the merge left no row of it
        elif bucket in before:
            spark.sql(f"{where % ''} SET LOCATION '{locations[bucket]}'")
        else:
            spark.sql(f"{where % 'ADD IF NOT EXISTS'} LOCATION '{locations[bucket]}'")
    spark.catalog.refreshTable(table)
    for path in folders:
        if path not in used:
            remove_path(spark, path)
    return locations
