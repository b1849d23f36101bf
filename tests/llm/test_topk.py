"""Exact top-k search against brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from riskweave.llm import queries, topk
from tests.conftest import SF_SMALL

SCHEMA = "vec_id long, embedding array<float>, label int, score long, v int"


def rows_of(vectors):
    return [(i, v, 0, 1, 2) for i, v in vectors]


def slow(vectors, k=5, every=3):
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v in vectors
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    copies, out = {}, []
    for i, q in sorted((i, q) for i, q in ok if i % every == 0):
        copy = copies[i] = copies.get(i, -1) + 1
        best = sorted((-sum(a * b for a, b in zip(q, x)), j) for j, x in ok if j != i and len(x) == len(q))[:k]
        out += [(i, copy, n + 1, j, -s) for n, (s, j) in enumerate(best)]
    return sorted(out)


def fast(spark, vectors, **kw):
    df = spark.createDataFrame(rows_of(vectors), SCHEMA)
    got = topk.top_k(df, F.col("vec_id") % 3 == 0, **kw)
    return sorted((r.query_id, r.copy, r["rank"], r.vec_id, r.score) for r in got.collect())


@pytest.mark.parametrize("block_rows", [16_384, 10])
def test_equals_brute_force_with_ties_and_faults(spark, block_rows):
    rng = random.Random(2)
    base = [[rng.randrange(-64, 64) / 64 for _ in range(6)] for _ in range(40)]
    vectors = [(i, base[min(rng.randrange(60), 39)]) for i in range(150)]  # many equal vectors
    vectors += [(200, None), (201, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (202, [math.nan] * 6), (203, [math.inf] * 6), (None, base[0])]
    vectors += [(3, base[1]), (3, base[2]), (4, base[3]), (4, base[3])]  # repeated ids and rows
    vectors += [(300, [1.0, 2.0]), (303, [2.0, 1.0]), (306, [])]  # other lengths
    assert fast(spark, vectors, block_rows=block_rows) == slow(vectors)


def test_few_rows_and_none(spark):
    assert fast(spark, [(0, [1.0]), (1, [2.0])]) == [(0, 0, 1, 1, 256 * 512)]
    assert fast(spark, [(0, [1.0])]) == []
    assert fast(spark, []) == []


def test_bounds_stop_the_search():
    """Most of a block is never evaluated where pivots tell vectors apart."""
    import numpy as np
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(c, 3, (200, 4)) for c in (-200, -100, 0, 100, 200)]).round()
    pivots = topk.pivots_of(x, 8)
    done = []

    class Counted(np.ndarray):
        def __getitem__(self, key):
            if isinstance(key, np.ndarray):
                done.append(len(key))
            return np.asarray(super().__getitem__(key))

    got = topk.best_of(x[900], topk.distances(x[900:901], pivots)[0], 900, float("-inf"), x.view(Counted), np.arange(len(x)),
                       topk.distances(x, pivots), (x * x).sum(axis=1), 5)
    s = x @ x[900]
    s[900] = -1e18
    want = sorted(zip(-s, range(len(x))))[:5]
    assert got == [(int(-a), b) for a, b in want]
    assert sum(done) < len(x) / 2


def test_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    got = sorted((r.query_id, 0, r["rank"], r.vec_id, r.score) for r in queries.op1_topk(spark, SF_SMALL).collect())
    assert got == slow(rows, every=50)


def test_scores_of_large_components_are_exact(spark):
    rng = random.Random(5)
    vectors = [(i, [rng.choice([-1, 1]) * (1600 + rng.randrange(1 << 12) / 256) for _ in range(64)]) for i in range(60)]
    vectors += [(100 + i, vectors[i][1][:-1] + [vectors[i][1][-1] + 1 / 256]) for i in range(30)]  # differ in the last unit
    assert fast(spark, vectors) == slow(vectors) and fast(spark, vectors, block_rows=7) == slow(vectors)
    huge = [(i, [float(i + 1) * 2.0 ** 52, 1.0]) for i in range(4)]
    assert [r[:4] + (None,) for r in slow(huge)] == fast(spark, huge)  # ranked by the true value


def test_blocks_are_dealt_evenly(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        blocks = spark.range(0, 4000).select((F.col("id") % 40).cast("int").alias("block")).repartitionByRange(40, "block")
        sizes = [r["count"] for r in blocks.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert max(sizes) <= 300
