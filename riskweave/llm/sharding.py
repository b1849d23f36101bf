"""Sharding along a Hilbert curve over document metadata.

Language, source and size are each quantised to 5 bits; a row's place on the
three-dimensional Hilbert curve, then its id, orders the whole table, and runs
of that order are the shards, so that a shard holds few languages, sources and
sizes and a filter on them skips whole shards. Counts differ by at most one.

Only DataFrame functions. Rows are range-partitioned and sorted; a row's rank is
its place in its partition plus the rows of the partitions before it, so no task
sees more than its range and equal metadata spread over many.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, stored

DIMS, BITS = 3, 5


# ---------------------------------------------------------- Hilbert curve
def _rotate(x: int, k: int) -> int:
    """The DIMS bits of x turned left by k."""
    k %= DIMS
    return (x << k | x >> DIMS - k) & (1 << DIMS) - 1


def curve_tables() -> tuple[list[int], list[int]]:
    """(digit, next): for state * 8 + octant, the octant's place along the
    curve in that state, and the state inside it. A state is the corner where
    the curve enters a cube and the direction in which it leaves: corner * DIMS
    + direction. Octants follow in Gray order, turned into the state's frame."""
    size = 1 << DIMS
    gray = [i ^ i >> 1 for i in range(size)]
    ones = [next(k for k in range(DIMS + 1) if not i >> k & 1) for i in range(size)]
    digit, following = [0] * size * DIMS * size, [0] * size * DIMS * size
    for corner in range(size):
        for direction in range(DIMS):
            for octant in range(size):
                w = gray.index(_rotate(octant ^ corner, -(direction + 1)))
                enter = 0 if w == 0 else gray[2 * ((w - 1) // 2)]
                turn = 0 if w == 0 else (ones[w - 1] if w % 2 == 0 else ones[w]) % DIMS
                at = (corner * DIMS + direction) * size + octant
                digit[at] = w
                following[at] = (corner ^ _rotate(enter, direction + 1)) * DIMS + (direction + turn + 1) % DIMS
    return digit, following


def hilbert(*dims: Column) -> Column:
    """Place on the curve of a cell given by DIMS numbers of BITS bits."""
    digit, following = (F.array(*map(F.lit, t)) for t in curve_tables())

    def step(acc: Column, i: Column) -> Column:
        octant = sum((F.call_function("getbit", d, i).cast("int") * (1 << k) for k, d in enumerate(dims)), F.lit(0))
        at = acc["state"] * (1 << DIMS) + octant + 1
        return F.struct(F.element_at(following, at).alias("state"),
                        (acc["place"] * (1 << DIMS) + F.element_at(digit, at)).alias("place"))

    walked = F.aggregate(F.array(*map(F.lit, range(BITS - 1, -1, -1))),
                         F.struct(F.lit(0).alias("state"), F.lit(0).alias("place")), step)
    return walked["place"]


# --------------------------------------------------------------- dimensions
def named(col: Column) -> Column:
    """A name as BITS bits of its crc32; null counts as empty."""
    return (F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % (1 << BITS)).cast("int")


def sized(col: Column) -> Column:
    """Half octaves of a size of 8 or more, up to the highest of BITS bits."""
    length = F.length(F.bin(col)).cast("int")
    second = F.call_function("getbit", col, length - 2).cast("int")
    return F.least(length * 2 + second - 8, F.lit((1 << BITS) - 1))


def shards(docs: DataFrame, n_shards: int = 24, id_col: str = "doc_id", text_col: str = "text",
           lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """One row for each row of `docs`: (doc_id, size, text_crc32, dim_lang,
    dim_source, dim_size, curve, shard, slot).

    size is the text's bytes plus 8; shards hold counts at most one apart;
    slot counts from 0 along the curve in each shard. Null texts have no bytes
    and null names the cell of the empty name; rows with one id on one curve
    place follow by size and text_crc32, and what is equal in all these is
    interchangeable. Fewer rows than shards leave shards empty; an empty table
    gives no rows; other columns are ignored.
    """
    return _located(docs, n_shards, id_col, text_col, lang_col, source_col, None).drop("row")


def _located(docs: DataFrame, n_shards: int, id_col: str, text_col: str, lang_col: str, source_col: str,
             row: Column | None) -> DataFrame:
    """`shards`, with `row` (null if None) carried along."""
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"), named(F.col(lang_col)).alias("dim_lang"),
                       named(F.col(source_col)).alias("dim_source"), (F.lit(None).cast("int") if row is None else row).alias("row"))
    rows = rows.withColumn("dim_size", sized(F.col("size")))
    rows = stored(rows.withColumn("curve", hilbert("dim_lang", "dim_source", "dim_size")), "curve")
    order = ["curve", "doc_id", "size", "text_crc32"]
    number = F.monotonically_increasing_id()  # the partition above bit 33, the row's place in it below
    placed = stored(rows.repartitionByRange(*order).sortWithinPartitions(*order)
                    .withColumn("part", F.shiftright(number, 33)).withColumn("at", number.bitwiseAND(F.lit((1 << 33) - 1))),
                    "curve-order")
    # a row for each partition: no more than the session's shuffle partitions
    counts = placed.groupBy("part").agg(F.count("*").alias("n"))
    before = counts.select("part", F.sum("n").over(Window.orderBy("part")).alias("upto"), "n",
                           F.sum("n").over(Window.partitionBy()).alias("total"))
    ranked = placed.join(F.broadcast(before), "part").withColumn("rank", F.expr("upto - n + at"))
    return (ranked.withColumn("shard", F.expr(f"(rank * {n_shards}) div total"))
            .withColumn("slot", F.expr(f"rank - (shard * total + {n_shards - 1}) div {n_shards}"))
            .select("doc_id", "size", "text_crc32", "dim_lang", "dim_source", "dim_size", "curve",
                    F.col("shard").cast("int").alias("shard"), "slot", "row"))


def shard_ranges(assigned: DataFrame) -> DataFrame:
    """Of each shard: rows, bytes, and the least and greatest cell in each
    dimension, by which a reader skips shards."""
    dims = ["dim_lang", "dim_source", "dim_size", "curve"]
    return assigned.groupBy("shard").agg(
        F.count("*").alias("n_rows"), F.sum("size").alias("n_bytes"),
        *[f(d).alias(f"{f.__name__}_{d}") for d in dims for f in (F.min, F.max)])


def write_shards(docs: DataFrame, path: str, n_shards: int = 24, id_col: str = "doc_id", text_col: str = "text",
                 lang_col: str = "lang", source_col: str = "source") -> str:
    """Writes the rows of `docs` as Parquet under `path`, a folder for each
    shard, files in curve order. Returns the name of the folders' column.

    Files hold the columns of `docs` and the cells `dim_lang`, `dim_source`,
    `dim_size`, whose ranges in the files' footers let a reader skip files. Every row is
    written once, whatever its copies. The name of a cell or of the folders'
    column that `docs` has already gets underscores.
    """
    placed = _located(docs, n_shards, id_col, text_col, lang_col, source_col, F.struct(*(F.col(f"`{c}`") for c in docs.columns)))
    cells = {d: fresh(d, docs) for d in ("dim_lang", "dim_source", "dim_size")}
    shard = fresh("shard", docs)
    (placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .select("row.*", *(F.col(d).alias(n) for d, n in cells.items()), F.col("shard").alias(shard))
     .write.partitionBy(shard).parquet(path))
    return shard
