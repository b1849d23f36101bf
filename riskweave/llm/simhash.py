"""SimHash near-duplicates by a Gray-order hierarchical index.

Fingerprints are made in one pass over the texts; equal ones become one.
Two fingerprints that differ in at most d bits agree on all but d of any
blocks they are cut into, so each is filed once for every choice of
`blocks - d` blocks, under the bits of those blocks. Fingerprints are sorted by
(choice, bits, Gray rank) with range partitioning, so that even a key that
holds very many of them is spread evenly over tasks. Runs of one key are cut
into leaves of consecutive Gray ranks; a leaf, and each node above it, keeps the
bits that all its members share. A search goes down from the top: bits first
fixed at a node add their differences to those counted above, and a node whose
sum exceeds d is left out with all that is under it. Leaves of one key that lie
in different tasks, or exceed the leaf size, are compared in pairs, again only
where their shared bits allow it.

Links within one comparison are reduced to a spanning forest, which joins the
same fingerprints; components follow from the links.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import each_text, in_batches, pieces, stored
from .components import components

BITS = 64
SEED = 42
#: Shingles that are hashed at a time.
CHUNK = 1 << 13
ASCII_WHITE = re.compile("[\x20\x09-\x0d]")
#: Members of a leaf; nodes of a level under one node above.
LEAF, FANOUT = 1024, 16


# ------------------------------------------------------------- fingerprints
def fingerprint(text: str, ngram: int = 4) -> int:
    """Unsigned fingerprint of a whole text: bit i is set if it is set in over
    half of the shingles' hashes; zero if there are no words."""
    counts, n = np.zeros(BITS, dtype=np.int64), 0

    def count(shingles) -> int:
        h = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), dtype=np.uint64)
        if len(h):
            bits = np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
            counts[:] += bits.sum(axis=0, dtype=np.int64)
        return len(h)

    words: list[bytes] = []  # the last words of what was counted, then those of the next piece
    for piece in pieces(text, ASCII_WHITE):
        words += piece.encode("utf-8", "replace").lower().split()
        for at in range(0, len(words) - ngram + 1, CHUNK):
            part = words[at:at + CHUNK + ngram - 1]
            n += count(map(b" ".join, zip(*(part[i:] for i in range(ngram)))))
        words = words[max(0, len(words) - ngram + 1):]
    if not n and words:  # fewer words than a shingle has
        n = count([b" ".join(words)])
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ngram: int = 4) -> DataFrame:
    """(id, key, fp) of each row: key is a hash of the text, fp the
    fingerprint's 64 bits as a signed long. A null text counts as empty."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.array([fingerprint(t, ngram) for t in each_text(batch, "text")], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fp)], names=["id", "key", "fp"])

    text = F.coalesce(F.col(text_col), F.lit(""))
    return (docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("key"), text.alias("text"))
            .transform(in_batches, run, f"id {kind}, key long, fp long"))


# ------------------------------------------------------------------- index
def block_choices(max_distance: int, spare: int) -> list[int]:
    """Masks of the bits that a filing key keeps: `max_distance + spare` even
    blocks, every choice of `spare` of them."""
    cuts = np.linspace(0, BITS, max_distance + spare + 1).round().astype(int)
    blocks = [((1 << int(hi - lo)) - 1) << int(lo) for lo, hi in zip(cuts, cuts[1:])]
    return [sum(c) for c in combinations(blocks, spare)]


def signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def gray_rank(col: Column) -> Column:
    """Place of a code in reflected Gray order, as a long that sorts so."""
    for shift in (1, 2, 4, 8, 16, 32):
        col = col.bitwiseXOR(F.shiftrightunsigned(col, shift))
    return col.bitwiseXOR(F.lit(signed(1 << (BITS - 1))))


def shared_bits(codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each group of consecutive codes: the mask of the bits that all share, and those bits."""
    every, some = np.bitwise_and.reduceat(codes, starts), np.bitwise_or.reduceat(codes, starts)
    mask = ~(every ^ some)
    return mask, every & mask


class Tree:
    """Masked bit patterns over codes in Gray order; level 0 is the codes."""

    def __init__(self, codes: np.ndarray):
        self.levels = [(np.full(len(codes), ~np.uint64(0)), codes)]
        while len(self.levels[-1][0]) > 1:
            mask, value = self.levels[-1]
            starts = np.arange(0, len(mask), FANOUT)
            shared = np.bitwise_and.reduceat(mask, starts)
            m, v = shared_bits(value, starts)
            self.levels.append((m & shared, v & m & shared))

    def near(self, queries: np.ndarray, d: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, code) index pairs within d bits, every pair."""
        mask, value = self.levels[-1]
        q = np.arange(len(queries))
        node = np.zeros(len(queries), dtype=np.int64)
        sums = np.bitwise_count((queries ^ value[0]) & mask[0]).astype(np.int64)
        q, node, sums = (x[sums <= d] for x in (q, node, sums))
        for depth in range(len(self.levels) - 2, -1, -1):
            above, (mask, value) = self.levels[depth + 1][0], self.levels[depth]
            child = node[:, None] * FANOUT + np.arange(FANOUT)
            real = child < len(mask)
            up = np.broadcast_to(node[:, None], child.shape)[real]
            q, sums = (np.broadcast_to(x[:, None], child.shape)[real] for x in (q, sums))
            node = child[real]
            new = mask[node] & ~above[up]
            sums = sums + np.bitwise_count((queries[q] ^ value[node]) & new)
            keep = sums <= d
            q, node, sums = q[keep], node[keep], sums[keep]
        return q, node


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index that each of n nodes reaches over the links (a, b)."""
    root = np.arange(n)
    while True:
        new = root.copy()
        np.minimum.at(new, a, root[b])
        np.minimum.at(new, b, root[a])
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, root):
            return root
        root = new


def tree_links(codes: np.ndarray, others: np.ndarray | None, d: int) -> list[tuple[int, int]]:
    """Spanning links among `codes`, or between `codes` and `others`."""
    tree = Tree(codes)
    own = others is None
    queries = codes if own else others
    pairs = [(q + at, c) for at in range(0, len(queries), 256) for q, c in [tree.near(queries[at:at + 256], d)]]
    q, c = (np.concatenate(x) for x in zip(*pairs))
    every = codes if own else np.concatenate([codes, others])
    root = forest(len(every), c, q if own else q + len(codes))
    far = np.flatnonzero(root != np.arange(len(every)))
    return list(zip(every[far].view(np.int64).tolist(), every[root[far]].view(np.int64).tolist()))


ENTRY = "kind int, choice int, key long, first long, mask long, value long, codes binary, a long, b long"


def _entries(links: list[tuple[int, int]], leaves: list[tuple]) -> pa.RecordBatch:
    rows = [(0, None, None, None, None, None, None, a, b) for a, b in links] + [(1, *x, None, None) for x in leaves]
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]
    names = [x.split()[0] for x in ENTRY.split(", ")]
    columns = list(zip(*rows)) if rows else [[] for _ in kinds]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


#: Runs up to this length are compared at each lag at once, without a tree.
SHORT_RUN = 16


def _index_part(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[pa.RecordBatch]:
    """Rows of one task, sorted by (choice, key, rank): links within leaves
    (kind 0), and the leaves that may have partners elsewhere (kind 1)."""
    carry: list[tuple] = []
    seen_first = False

    def leaf(run: tuple) -> tuple:
        choice, key, rank, code = run
        u = code.view(np.uint64)
        mask, value = shared_bits(u, np.array([0]))
        return (int(choice[0]), int(key[0]), int(rank[0]), int(mask.view(np.int64)[0]), int(value.view(np.int64)[0]),
                u.astype("<u8").tobytes())

    def finish(part: tuple, last: bool) -> Iterator[pa.RecordBatch]:
        """Complete runs, the last one complete in this task at least."""
        nonlocal seen_first
        choice, key, rank, code = part
        if not len(code):
            return
        new = np.concatenate([[True], (choice[1:] != choice[:-1]) | (key[1:] != key[:-1])])
        starts = np.flatnonzero(new)
        sizes = np.diff(np.append(starts, len(code)))
        run = np.repeat(np.arange(len(starts)), sizes)
        u, links, leaves = code.view(np.uint64), [], []
        short = sizes <= SHORT_RUN
        for lag in range(1, SHORT_RUN):
            same = np.flatnonzero((run[lag:] == run[:-lag]) & short[run[lag:]])
            if not len(same):
                break
            near = same[np.bitwise_count(u[same] ^ u[same + lag]) <= d]
            links += zip(code[near].tolist(), code[near + lag].tolist())
        for i in np.flatnonzero(~short | (np.arange(len(starts)) == (0 if not seen_first else -1))
                                | (np.arange(len(starts)) == (len(starts) - 1 if last else -1))):
            for at in range(0, int(sizes[i]), LEAF):
                piece = slice(starts[i] + at, starts[i] + min(at + LEAF, int(sizes[i])))
                if not short[i]:
                    links += tree_links(u[piece], None, d)
                edge = (i == 0 and not seen_first) or (last and i == len(starts) - 1)
                if edge or sizes[i] > LEAF:
                    leaves.append(leaf(tuple(x[piece] for x in part)))
        seen_first = True
        yield _entries(links, leaves)

    for batch in batches:
        got = tuple(batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
        if not len(got[0]):
            continue
        part = tuple(np.concatenate(x) for x in zip(*carry, got)) if carry else got
        other = np.flatnonzero((part[0] != part[0][-1]) | (part[1] != part[1][-1]))
        cut = int(other[-1]) + 1 if len(other) else 0
        if cut:
            yield from finish(tuple(x[:cut] for x in part), False)
        carry = [tuple(x[cut:] for x in part)]
        while len(carry[0][0]) > 8 * LEAF:  # a long run: its leaves are closed as it goes on; over seven are left for finish()
            piece = tuple(x[:LEAF] for x in carry[0])
            yield _entries(tree_links(piece[3].view(np.uint64), None, d), [leaf(piece)])
            carry = [tuple(x[LEAF:] for x in carry[0])]
    if carry:
        yield from finish(carry[0], True)


def _cross_part(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            out += tree_links(np.frombuffer(x, dtype="<u8").astype(np.uint64),
                              np.frombuffer(y, dtype="<u8").astype(np.uint64), d)
        yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in out], pa.int64()), pa.array([b for _, b in out], pa.int64())],
                                         names=["a", "b"])


def near_links(codes: DataFrame, max_distance: int = 4, spare: int = 2) -> DataFrame:
    """(a, b): links that join exactly the codes joined by pairs of at most
    `max_distance` differing bits. `codes` has one column `fp` of distinct longs.

    `spare` blocks make a key: 15 keys of about 21 bits a code by default.
    More keys of more bits (`spare=3`: 35 of 27) suit more than some billions.
    """
    masks = block_choices(max_distance, spare)
    filed = codes.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("key"))
        for i, m in enumerate(masks)])).alias("k")).select("k.choice", "k.key", gray_rank(F.col("fp")).alias("rank"), "fp")
    ordered = filed.repartitionByRange("choice", "key", "rank").sortWithinPartitions("choice", "key", "rank")
    entries = stored(ordered.mapInArrow(lambda it: _index_part(it, max_distance), ENTRY), "gray-index")
    leaves = entries.where("kind = 1").select("choice", "key", "first", "mask", "value", "codes")
    x, y = leaves.alias("x"), leaves.alias("y")
    differ = F.bit_count(F.col("x.value").bitwiseXOR(F.col("y.value"))
                         .bitwiseAND(F.col("x.mask")).bitwiseAND(F.col("y.mask")))
    pairs = (x.join(y, F.expr("x.choice = y.choice AND x.key = y.key AND x.first < y.first") & (differ <= max_distance))
             .select(F.col("x.codes").alias("x"), F.col("y.codes").alias("y"), F.hash("x.first", "y.first").alias("h"))
             .repartition("h").select("x", "y"))
    crossed = pairs.mapInArrow(lambda it: _cross_part(it, max_distance), "a long, b long")
    return entries.where("kind = 0").select("a", "b").unionByName(crossed).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ngram: int = 4,
                    max_distance: int = 4, spare: int = 2) -> DataFrame:
    """(id, key, fp, group, component_id) for every row of `docs`.

    component_id is the smallest id that links of at most `max_distance` bits
    reach from the row, its own included; null only where no row reached has
    an id. group is the smallest fingerprint reached, so it tells apart groups
    that share ids or have none; key is a hash of the row's text. A null or
    wordless text has fingerprint zero and links like any other; repeated rows
    each have their row; other columns are ignored; an empty table gives no rows.
    """
    fps = stored(fingerprints(docs, id_col, text_col, ngram), "simhash")
    codes = stored(fps.groupBy("fp").agg(F.min("id").alias("least")), "simhash-codes")
    linked = components(near_links(codes.select("fp"), max_distance, spare))
    roots = linked.select("root").distinct().select(F.col("root").alias("fp"), "root")
    member = linked.select(F.col("node").alias("fp"), "root").unionByName(roots)
    with_least = stored(member.join(codes, "fp"), "simhash-members")
    of_root = with_least.groupBy("root").agg(F.min("least").alias("component"))
    joined = with_least.select("fp", "root").join(of_root, "root")
    # codes without a link stand for themselves; every code has one row
    alone = codes.select("fp", F.col("fp").alias("root"), F.col("least").alias("component"), F.lit(1).alias("own"))
    of_code = (alone.unionByName(joined.withColumn("own", F.lit(0))).groupBy("fp")
               .agg(F.min_by(F.struct("root", "component"), "own").alias("of")))
    # stored, so that the join below does not share the aggregate's exchange and a fingerprint of very many rows can be split
    of_code = stored(of_code, "simhash-components")
    return fps.join(of_code, "fp").select("id", "key", "fp", F.col("of.root").alias("group"),
                                          F.col("of.component").alias("component_id"))
