"""Lake-layer scans, warehouse-shape conformance and catalog tables.

* `read_layer`   parquet scan of a lake layer with partition discovery; filters
                 on partition columns prune directories, others reach the
                 parquet reader as pushed filters.
* `conform`      bulk-load semantics: select the target table's columns by
                 name, cast to its types, fill absent columns with defaults,
                 and split off the rows that violate NOT NULL or a type.
* `create_tables` / `register_layer` / `refresh_partitions`: catalog DDL and
                 partition discovery for tables stored as parquet folders.
"""

from __future__ import annotations

import json
import re
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from riskweave.schemas import LAYOUT, NOW, WAREHOUSE, contract
from riskweave.session import list_folder, qualified, read_small


def read_layer(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Scan a parquet layer folder. With a schema, partition columns get the
    declared types (no inference)."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)


def _shape(df: DataFrame, table: str, as_of) -> tuple[list[Column], Column]:
    """The table's columns made of the frame's, and why a row does not fit ('' if it does)."""
    from riskweave.plans.dashboard import ts_lit
    cols, faults = [], []
    for name, typ, nullable, default in WAREHOUSE[contract(table)]:
        if name in df.columns:
            c = F.col(name).try_cast(typ)
            faults.append(F.when(F.col(name).isNotNull() & c.isNull(), F.lit(f"{name} does not fit")))
        elif default is NOW:
            c = ts_lit(as_of).cast(typ)
        elif default is not None:
            c = F.lit(default).cast(typ)
        else:
            c = F.lit(None).cast(typ)
        if not nullable:
            given = F.col(name) if name in df.columns else c
            faults.append(F.when(given.isNull(), F.lit(f"{name} is null")))
        cols.append(c.alias(name))
    return cols, F.concat_ws(", ", *faults)


def conform(df: DataFrame, table: str, as_of=None) -> tuple[DataFrame, DataFrame]:
    """Shape `df` to the warehouse table `table`: (accepted, rejected).

    present column -> cast to the table type; absent column -> its DEFAULT
    (NOW = the load time `as_of`) or null. A row is rejected if a NOT NULL
    column of it is null or a value that is there does not fit its type; the
    rejected frame has the input's columns as they came, and `reject_reason`.
    Every input row is in exactly one of the two.
    """
    cols, reason = _shape(df, table, as_of)
    return df.filter(reason == "").select(*cols), df.withColumn("reject_reason", reason).filter("reject_reason <> ''")


def tagged(df: DataFrame, table: str, as_of=None) -> DataFrame:
    """`conform` as one projection without a filter, so that one pass over the
    input serves both sides: `accepted`, the table's row or null, and
    `rejected`, the input's row with its reason or null."""
    cols, reason = _shape(df, table, as_of)
    given = [F.col(f"`{c}`") for c in df.columns]
    return (df.withColumn("_reason", reason)
            .select(F.when(F.col("_reason") == "", F.struct(*cols)).alias("accepted"),
                    F.when(F.col("_reason") != "", F.struct(*given, F.col("_reason").alias("reject_reason"))).alias("rejected")))


def _default_sql(typ: T.DataType, default) -> str:
    if default is NOW:
        return "current_timestamp()"
    value = f"'{default}'" if isinstance(default, str) else str(default).upper()
    return f"CAST({value} AS {typ.simpleString()})"


def _ddl(table: str) -> str:
    """Column list with the DEFAULTs. Spark does not check NOT NULL on files,
    so `conform` does, and keeps what it rejects."""
    return ", ".join(f"{n} {t.simpleString()}" + (f" DEFAULT {_default_sql(t, d)}" if d is not None else "")
                     for n, t, _nl, d in WAREHOUSE[contract(table)])


def table_location(spark: SparkSession, table_name: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table_name}").collect()
    for r in rows:
        if r[0] == "Location":
            return r[1]
    raise ValueError(f"no location for {table_name}")


def create_tables(spark: SparkSession, root: str, tables=None, prefix: str = "", databases: str | None = None) -> list[str]:
    """CREATE TABLE IF NOT EXISTS for the warehouse tables as parquet folders
    under `root`. Returns the table names.

    `prefix`, which ends in `__`, gives databases of their own beside those of
    the same catalog; `databases` is the folder for new databases (the
    warehouse folder if not given). A table that is there already must lie under
    `root`: one of another root is an error, not silently loaded into.
    """
    names = []
    for table in tables or WAREHOUSE:
        db, name = table.split(".")
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {prefix}{db}" + (f" LOCATION '{databases}/{prefix}{db}'" if databases else ""))
        parts = LAYOUT[table]["partition"]
        part_sql = f" PARTITIONED BY ({', '.join(parts)})" if parts else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {prefix}{table} ({_ddl(table)}) USING parquet"
                  f"{part_sql} LOCATION '{root.rstrip('/')}/{db}/{name}'")
        lies, wanted = table_location(spark, f"{prefix}{table}"), qualified(spark, root)
        if not f"{lies}/".startswith(f"{wanted}/"):
            raise ValueError(f"{prefix}{table} exists at {lies}, not under {wanted}")
        names.append(f"{prefix}{table}")
    return names


def register_layer(spark: SparkSession, table: str, path: str, schema: T.StructType,
                   partition_by=()) -> None:
    """Register an existing partitioned parquet folder as a catalog table."""
    db = table.split(".")[0] if "." in table else None
    if db:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    cols = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
    part_sql = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({cols}) USING parquet{part_sql} LOCATION '{path}'")


def refresh_partitions(spark: SparkSession, table: str) -> int:
    """Discover partition folders written since the last refresh (the hourly
    crawler of the original deployment); returns the partition count."""
    spark.catalog.recoverPartitions(table)
    spark.catalog.refreshTable(table)
    return spark.sql(f"SHOW PARTITIONS {table}").count()


def sink_commits(spark: SparkSession, path: str, after: int = -1) -> tuple[int, list[str]]:
    """(number of the newest batch, files) that a streaming file sink has
    committed after batch `after`, from its commit log alone. Every tenth batch
    the log is compacted; the compact file holds all earlier ones."""
    names = [n for n, folder, _, _ in list_folder(spark, f"{path.rstrip('/')}/_spark_metadata") if not folder]
    plain = {int(n): n for n in names if n.isdigit()}
    compact = {int(n.split(".")[0]): n for n in names if n.endswith(".compact")}
    newest = max([*plain, *compact], default=-1)
    if newest <= after:
        return newest, []
    # batches still there one by one suffice, unless one after `after` was folded into a compact file
    folded = max(compact, default=-1)
    wanted = [n for b, n in plain.items() if b > max(after, folded)] + ([compact[folded]] if folded > after else [])
    files = set()
    for n in wanted:
        for line in read_small(spark, f"{path.rstrip('/')}/_spark_metadata/{n}").splitlines()[1:]:  # the first is the version
            entry = json.loads(line)
            if entry["action"] == "add":
                files.add(entry["path"])
    return newest, sorted(files)


#: Table properties: the stream folder that a table follows, and how far.
FOLLOWED_PATH, FOLLOWED = "riskweave.followed_path", "riskweave.followed_batch"


def register_followed(spark: SparkSession, table: str, path: str, schema: T.StructType, partition_by, home: str) -> None:
    """A partitioned catalog table over the folder of a streaming sink.

    Spark takes a table that lies in such a folder to be unpartitioned and
    always reads it by the sink's log. For SHOW PARTITIONS, partition
    statistics and other readers of the catalog, this table lies in a folder of its own (`home`)
    and its partitions point into the sink's (`refresh_from_log`).
    """
    register_layer(spark, table, home, schema, partition_by)
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{FOLLOWED_PATH}' = '{qualified(spark, path)}')")


def refresh_from_log(spark: SparkSession, table: str) -> list[str]:
    """Add the partitions that a streaming sink has committed since the last
    refresh to its catalog table: the cost follows new batches, not the
    number of partitions. Files whose columns the table lacks, or has in another
    type, are an error, and nothing is added. Returns the added partitions."""
    props = {r[0]: r[1] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    path = props[FOLLOWED_PATH]
    newest, files = sink_commits(spark, path, int(props.get(FOLLOWED, -1)))
    if not files:
        return []
    parts = [f.name for f in spark.catalog.listColumns(table) if f.isPartition]
    declared = {f.name.lower(): f.dataType for f in spark.table(table).schema.fields}
    found = spark.read.parquet(files[-1]).schema
    odd = [f.name for f in found.fields if declared.get(f.name.lower()) != f.dataType]
    if odd:
        raise ValueError(f"{table}: columns that the table lacks or has in another type: {', '.join(odd)}")
    folders = sorted({tuple(re.findall("(?:^|/)" + p + "=([^/]+)", f)[-1] for p in parts) for f in files})
    for values in folders:
        spec = ", ".join(f"{p}='{unquote(v)}'" for p, v in zip(parts, values))
        where = "/".join(f"{p}={v}" for p, v in zip(parts, values))
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({spec}) LOCATION '{path}/{where}'")
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{FOLLOWED}' = '{newest}')")
    spark.catalog.refreshTable(table)
    return ["/".join(f"{p}={v}" for p, v in zip(parts, values)) for values in folders]


def table_bytes(spark: SparkSession, table: str, analyze: bool = False) -> int | None:
    """The table's size as the catalog's statistics have it; None if it was never analyzed."""
    if analyze:
        spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS NOSCAN")
    for name, value, _ in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect():
        if name == "Statistics":
            return int(value.split()[0])
    return None


#: The largest table, in bytes on disk, that is copied to every executor.
REPLICATE_BYTES = 32 * 1024 ** 2


def scan(spark: SparkSession, table: str, replicate_bytes: int = REPLICATE_BYTES) -> DataFrame:
    """Table scan by name (catalog table or temp view). A table that the layout
    replicates is broadcast in joins if the catalog's statistics prove it
    small enough; without statistics, or beyond, it is joined as any other."""
    df = spark.table(table)
    if LAYOUT.get(contract(table), {}).get("replicate"):
        size = table_bytes(spark, table)
        if size is not None and size <= replicate_bytes:
            return F.broadcast(df)
    return df
