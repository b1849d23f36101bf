"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.session import scratch_path

#: Bytes of rows that are handed to a Python worker at a time, unless the session says less.
BATCH_BYTES = 4 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Characters of a text that are looked at together.
PIECE = 1 << 18
WHITE = re.compile(r"\s")
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def stored(df: DataFrame, tag: str) -> DataFrame:
    """`df`, written once to the folder that `spark.checkpoint.dir` names and
    read again: cuts the lineage, and later readers do not compute it anew.
    Removed with the application's other scratch tables when its driver ends."""
    path = scratch_path(df.sparkSession, "llm", tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(col: Column) -> Column:
    """A-Z lower-cased, all other characters left alone."""
    return F.translate(col, UPPER, LOWER)


def let(value: Column, use) -> Column:
    """`use(value)`, with value computed once however often `use` names it:
    inside another higher-order function it would be computed for each element."""
    return F.element_at(F.transform(F.array(value), use), 1)


def doc_crc(col: Column) -> Column:
    """crc32 of an id's decimal text; null ids count as the empty text."""
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary"))


def fresh(name: str, *frames: DataFrame) -> str:
    """`name`, made longer until no column of the frames has it."""
    taken = {c.lower() for f in frames for c in f.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_fields(schema: T.StructType, **fields: T.DataType) -> T.StructType:
    return T.StructType([*(f for f in schema.fields if f.name not in fields),
                         *(T.StructField(k, v) for k, v in fields.items())])


def batches_with(batches: Iterator[pa.RecordBatch], **columns) -> Iterator[pa.RecordBatch]:
    """Each batch with more columns; a column is given as a function of the
    batch that returns an Arrow array."""
    for batch in batches:
        kept = [i for i, n in enumerate(batch.schema.names) if n not in columns]
        arrays = [batch.column(i) for i in kept] + [f(batch) for f in columns.values()]
        yield pa.RecordBatch.from_arrays(arrays, names=[batch.schema.names[i] for i in kept] + list(columns))


def each_text(batch: pa.RecordBatch, name: str) -> Iterator[str]:
    """The strings of a column one at a time, null as empty, so that a worker
    holds no second copy of a whole batch."""
    column = batch.column(batch.schema.get_field_index(name))
    for i in range(len(column)):
        yield column[i].as_py() or ""


def pieces(text: str, white: re.Pattern = WHITE, size: int = PIECE) -> Iterator[str]:
    """The whole text in pieces of about `size` characters, cut before white
    space; what holds none stays together. Splitting each piece gives the words of the whole."""
    at = 0
    while len(text) - at > size:
        found = white.search(text, at + size)
        end = found.start() if found else len(text)
        yield text[at:end]
        at = end
    if at < len(text):
        yield text[at:] if at else text


#: What a Python worker keeps between tasks, by (module, name): of one operator only.
_kept: dict[tuple[str, str], object] = {}


def kept(module: str, name: str, make):
    """What `make(name)` gives, made once in a worker and kept until it works
    for another operator."""
    if (module, name) not in _kept:
        _kept[module, name] = make(name)
    return _kept[module, name]


def _give_back() -> None:
    """Freed memory of the worker back to the system, where the C library can."""
    gc.collect()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def in_batches(df: DataFrame, run, schema) -> DataFrame:
    """`mapInArrow` with batches bounded by bytes, so that rows of long texts
    come a few at a time. A worker is reused by later tasks, so it forgets what
    it kept for other operators and gives freed memory back when a task ends."""
    conf = df.sparkSession.conf
    given = conf.get(BATCH_SETTING, None)
    if given is None or not given.isdigit() or int(given) > BATCH_BYTES:
        conf.set(BATCH_SETTING, str(BATCH_BYTES))

    def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.set_memory_pool(pa.system_memory_pool())
        for key in [k for k in _kept if k[0] != run.__module__]:
            del _kept[key]
        yield from run(batches)
        _give_back()

    return df.mapInArrow(bounded, schema)
