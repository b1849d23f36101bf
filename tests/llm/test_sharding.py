"""Hilbert-curve shards."""

import zlib
from itertools import product

import pytest
from pyspark.sql import functions as F

from riskweave.llm import queries, sharding
from riskweave.session import scratch_path
from tests.conftest import SF_SMALL


def test_curve_is_a_path_through_every_cell(spark):
    side = 1 << sharding.BITS
    cells = spark.createDataFrame(list(product(range(0, side), repeat=3)), "a int, b int, c int")
    path = [(r.a, r.b, r.c) for r in cells.select("a", "b", "c", sharding.hilbert("a", "b", "c").alias("h")).orderBy("h").collect()]
    places = [r.h for r in cells.select(sharding.hilbert("a", "b", "c").alias("h")).orderBy("h").collect()]
    assert places == list(range(side ** 3))
    assert all(sum(abs(x - y) for x, y in zip(p, q)) == 1 for p, q in zip(path, path[1:]))


@pytest.mark.parametrize("n", [0, 5, 24, 1000])
def test_counts_and_slots(spark, n):
    rows = [(i // 2 if i % 7 else None, None if i % 11 == 0 else "é" * (i % 90), "en" if i % 3 else None, "hot", 1) for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id int, text string, lang string, source string, shard int")
    got = sharding.shards(df).collect()
    assert len(got) == n
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
    counts = [len(slots.get(s, [])) for s in range(24)]
    assert max(counts) - min(counts) <= 1
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert sorted((r.size, r.text_crc32) for r in got) == sorted(
        (8 + len((t or "").encode()), zlib.crc32((t or "").encode())) for _, t, *_ in rows)
    ordered = sorted(got, key=lambda r: (r.shard, r.slot))
    assert [r.curve for r in ordered] == sorted(r.curve for r in got)


def test_written_shards_hold_every_row_once(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    path = scratch_path(spark, "shards")
    sharding.write_shards(docs, path, 6)
    back = spark.read.parquet(path)
    assert back.select("doc_id", "text").exceptAll(docs.select("doc_id", "text")).count() == 0 and back.count() == docs.count()
    sizes = [r["count"] for r in back.groupBy("shard").count().collect()]
    assert max(sizes) - min(sizes) <= 1
    ranges = sharding.shard_ranges(sharding.shards(docs, 6))
    assert ranges.count() == 6 and ranges.agg(F.sum("n_rows")).first()[0] == docs.count()


def test_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = queries.op4_sharding(spark, SF_SMALL).collect()
    assert {r.doc_id for r in got} == docs.keys() and len(got) == len(docs)
    assert all(r.size == len(docs[r.doc_id].encode()) + 8 and r.text_crc32 == zlib.crc32(docs[r.doc_id].encode()) for r in got)
    assert {r.law for r in got} == {"rows"} and {r.grown_shard for r in got} == {None}
    # neighbours on the curve share metadata: a shard holds few of the languages' and sources' cells
    per_shard = {}
    for r in got:
        per_shard.setdefault(r.shard, set()).add((r.dim_lang, r.dim_source))
    assert sum(map(len, per_shard.values())) / 24 < len(set().union(*per_shard.values())) / 4


def test_written_shards_with_copies_and_a_shard_column(spark):
    rows = [(1, "same text", "en", "s", 7)] * 40 + [(None, None, None, None, 8)] * 3 + [(i, f"t{i}", "fr", "q", 9) for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, lang string, source string, shard int")
    path = scratch_path(spark, "shards")
    assert sharding.write_shards(docs, path, 5) == "shard_"
    back = spark.read.parquet(path)
    assert sorted(map(repr, back.select(*docs.columns).collect())) == sorted(map(repr, docs.collect()))
    # the cells are in the files, so a filter on one is pushed into the scan
    cell = docs.limit(1).select(sharding.named(F.lit("fr"))).first()[0]
    plan = back.where(F.col("dim_lang") == cell)._jdf.queryExecution().executedPlan().toString()
    assert f"EqualTo(dim_lang,{cell})" in plan and back.where(F.col("dim_lang") == cell).count() >= 50


def slow_shards(rows, n):
    """(doc_id, crc, shard, slot) in the order of the curve, by walking it cell by cell."""
    digit, following = sharding.curve_tables()

    def place(dims):
        state = at = 0
        for bit in range(sharding.BITS - 1, -1, -1):
            octant = sum((d >> bit & 1) << k for k, d in enumerate(dims))
            at, state = at * 8 + digit[state * 8 + octant], following[state * 8 + octant]
        return at

    def cell(name):
        return zlib.crc32((name or "").encode()) % 32

    def size_cell(size):
        return min(2 * size.bit_length() + (size >> (size.bit_length() - 2) & 1) - 8, 31)

    keyed = []
    for i, text, lang, source in rows:
        raw = (text or "").encode()
        keyed.append((place((cell(lang), cell(source), size_cell(len(raw) + 8))), i, len(raw) + 8, zlib.crc32(raw)))
    out, counts = [], {}
    for rank, (_, i, size, crc) in enumerate(sorted(keyed)):
        shard = rank * n // len(keyed)
        out.append((i, crc, shard, counts.setdefault(shard, 0)))
        counts[shard] += 1
    return sorted(out)


def test_order_of_a_whole_table(spark):
    docs = [(r.doc_id, r.text, r.lang, r.source) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = sorted((r.doc_id, r.text_crc32, r.shard, r.slot) for r in queries.op4_sharding(spark, SF_SMALL).collect())
    assert got == slow_shards(docs, 24)
