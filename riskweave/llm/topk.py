"""Exact top-k search by pivot-table elimination.

Every vector's distances to a fixed number of pivots are computed once. For a
query q, a vector x and a pivot p the triangle inequality gives
|q - x| >= |d(q, p) - d(x, p)|; with both norms, the greatest of these lower
bounds over the pivots bounds the inner product from above:
q.x = (|q|^2 + |x|^2 - |q - x|^2) / 2. In each block of vectors, candidates are
evaluated in the order of their bounds until no bound left reaches the k-th
score found; equal scores are still evaluated, so ties come out right.
A query starts with the k-th score it has among a bounded sample of the rows.

Vectors are dealt to blocks of bounded size by a hash, every query meets every
block, and the blocks' best are merged; nothing else grows with the table.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

PIVOTS = 32
#: Rows with the smallest hashes from which pivots are chosen, and which give queries their first bound.
SAMPLE = 1024
#: Vectors of a block; a task holds one block and a batch of queries.
BLOCK = 16_384
#: Candidates that are evaluated at a time.
STEP = 64


def usable(vector: Column) -> Column:
    """Vectors that are not null and hold neither null nor non-finite components."""
    return vector.isNotNull() & ~F.exists(
        vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))


def quantised(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale))


def pivots_of(sample: np.ndarray, n: int) -> np.ndarray:
    """Farthest-first choice: each pivot is far from those before it."""
    if not len(sample):
        return sample
    chosen = [0]
    near = ((sample - sample[0]) ** 2).sum(axis=1)
    while len(chosen) < min(n, len(sample)) and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, ((sample - sample[chosen[-1]]) ** 2).sum(axis=1))
    return sample[chosen]


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Of each row to each pivot, in floating point; bounds made of them leave room for its rounding."""
    squares = (x * x).sum(axis=1)[:, None] + (pivots * pivots).sum(axis=1)[None] - 2 * (x @ pivots.T)
    return np.sqrt(np.maximum(squares, 0))


def exact_scores(x: np.ndarray, q: np.ndarray):
    """A function of row numbers that gives their inner products with q as
    exact integers: in 64 bits where no sum can exceed them, else in Python's."""
    most = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) * max(abs(int(q.max(initial=0))), abs(int(q.min(initial=0))))
    if most * max(1, len(q)) < 1 << 63:
        return lambda some: x[some] @ q
    wide = q.astype(object)
    return lambda some: np.array([int(sum(a * b for a, b in zip(map(int, row), wide))) for row in x[some]], dtype=object)


def best_of(q: np.ndarray, q_dist: np.ndarray, own: int, floor: float, x: np.ndarray, x_id: np.ndarray,
            x_dist: np.ndarray, x_norm: np.ndarray, k: int) -> list[tuple[int, int]]:
    """(score, id) of the k best rows of a block for one query, of which those
    below `floor` may be missing: higher scores first, then smaller ids."""
    own_norm = float((q.astype(np.float64) ** 2).sum())
    scale = own_norm + x_norm
    lower = np.abs(x_dist - q_dist).max(axis=1) if x_dist.shape[1] else np.zeros(len(x))
    lower = np.maximum(lower - 1e-6 * np.sqrt(scale), 0)
    upper = (scale - lower * lower) / 2 + 1e-9 * scale + 0.5  # scores are integers
    floor -= 1e-9 * own_norm + 0.5 if np.isfinite(floor) else 0
    exact = exact_scores(x, q)
    reach = np.flatnonzero((upper >= floor) & (x_id != own))
    order = reach[np.argsort(-upper[reach], kind="stable")]
    scores, ids = exact(order[:0]), np.zeros(0, dtype=np.int64)
    for at in range(0, len(order), STEP):
        if len(scores) == k and upper[order[at]] < scores[-1]:
            break
        some = order[at:at + STEP]
        scores, ids = np.concatenate([scores, exact(some)]), np.concatenate([ids, x_id[some]])
        keep = sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i]))[:k] if scores.dtype == object else np.lexsort((ids, -scores))[:k]
        scores, ids = scores[keep], ids[keep]
    return [(int(s), int(i)) for s, i in zip(scores, ids)]


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


ROW = "dims int, block int, kind int, vec_id long, copy int, floor double, v array<long>, dist array<double>"


def _search(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (dims, block, kind): a block's vectors, then its queries."""
    held: tuple | None = None
    parts: list[tuple] = []
    names = ["query_id", "copy", "vec_id", "score"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.decimal128(38, 0)]

    def close() -> tuple | None:
        if not parts:
            return None
        v, ids, dist = (np.concatenate(x) for x in zip(*parts))
        return v, ids, dist, (v.astype(np.float64) ** 2).sum(axis=1)

    at = None
    for batch in batches:
        block = batch.column(0).to_numpy().astype(np.int64) << 32 | batch.column(1).to_numpy()
        kind, ids = batch.column(2).to_numpy(), batch.column(3).to_numpy()
        edges = np.flatnonzero(np.diff(block) | np.diff(kind)) + 1
        out = []
        for lo, hi in zip([0, *edges], [*edges, len(block)]):
            rows = batch.slice(lo, hi - lo)
            if block[lo] != at:
                at, held, parts = block[lo], None, []
            v, dist = _matrix(rows.column(6)), _matrix(rows.column(7))
            if kind[lo] == 0:
                parts.append((v, ids[lo:hi], dist))
                continue
            held = held or close()
            if held is None:
                continue
            x, x_id, x_dist, x_norm = held
            parts = []
            copies, floors = rows.column(4).to_pylist(), rows.column(5).to_pylist()
            for i in range(hi - lo):
                own = int(ids[lo + i])
                out += [(own, copies[i], vec, s) for s, vec in
                        best_of(v[i], dist[i], own, floors[i], x, x_id, x_dist, x_norm, k)]
        columns = list(zip(*((*row[:3], Decimal(row[3])) for row in out))) if out else [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256, id_col: str = "vec_id",
          vector_col: str = "embedding", pivots: int = PIVOTS, block_rows: int = BLOCK) -> DataFrame:
    """(query_id, copy, rank, vec_id, score) of each query's k highest integer
    inner products with rows of other ids; ties go to the smaller id.

    Vectors that are null or hold null or non-finite components take no part,
    nor do rows without an id. Vectors meet those of as many components only.
    An id is a row's identity: rows that repeat a query's id are no candidates
    of it; a query id on several rows is searched for each, told apart by
    `copy` from 0; other repeated rows each take a rank. Fewer than k other
    rows give as many ranks. `vec_id`s are integers. Scores are exact; one
    that 64 bits do not hold is ranked by its value and returned as null.
    """
    spark = vectors.sparkSession
    rows = vectors.where(usable(F.col(vector_col)) & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("vec_id"), quantised(F.col(vector_col), scale).alias("v"),
        F.coalesce(is_query, F.lit(False)).alias("q")).withColumn("dims", F.size("v"))
    rows = stored(rows, "vectors")
    # at most SAMPLE rows come to the driver, whatever the table holds
    sample = rows.select("vec_id", "v", "dims").orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(SAMPLE).collect()
    by_dims: dict[int, tuple] = {}
    for d in {r.dims for r in sample}:
        own = [r for r in sample if r.dims == d]
        x = np.array([r.v for r in own], dtype=np.float64).reshape(len(own), d)
        by_dims[d] = (pivots_of(x, pivots), x, np.array([r.vec_id for r in own]))

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Adds distances to the pivots and, to queries, the k-th score among the sample."""
        for batch in batches:
            dist, floor = [None] * len(batch), [None] * len(batch)
            ids, dims, asks = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 3, 2))
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                x = _matrix(batch.column(1).take(pa.array(at))).astype(np.float64)
                chosen, some, some_id = by_dims.get(int(d), (np.zeros((0, d)), np.zeros((0, d)), np.zeros(0)))
                far = distances(x, chosen)
                for i, row in zip(at, far):
                    dist[i] = row
                for n in np.flatnonzero(asks[at]):
                    scores = np.sort((some @ x[n])[some_id != ids[at[n]]])
                    floor[at[n]] = float(scores[-k]) if len(scores) >= k else float("-inf")
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(dist, pa.list_(pa.float64())), pa.array(floor, pa.float64())],
                names=[*batch.schema.names, "dist", "floor"])

    table = stored(rows.mapInArrow(prepare, "vec_id long, v array<long>, q boolean, dims int, dist array<double>, floor double"),
                   "pivot-table")
    blocks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-table.count() // block_rows))
    found = table.select("dims", F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks)).cast("int").alias("block"),
                         F.lit(0).alias("kind"), "vec_id", F.lit(0).alias("copy"), "floor", "v", "dist")
    numbered = table.where("q").withColumn("copy", F.row_number().over(Window.partitionBy("vec_id").orderBy("v")) - 1)
    asked = numbered.select("dims", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(1).alias("kind"),
                            "vec_id", "copy", "floor", "v", "dist")
    # by range, since so few different numbers would hash unevenly
    grid = (found.unionByName(asked).repartitionByRange(blocks, "block").sortWithinPartitions("dims", "block", "kind"))
    best = grid.mapInArrow(lambda it: _search(it, k), "query_id long, copy int, vec_id long, score decimal(38,0)")
    order = Window.partitionBy("query_id", "copy").orderBy(F.desc("score"), "vec_id")
    return (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "copy", "rank", "vec_id", F.col("score").try_cast("long").alias("score")))


def oracle() -> str:
    """DuckDB SQL of the registered query: every query against every row."""
    return """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 256)) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5"""
