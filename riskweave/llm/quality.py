"""Quality by attention-based multiple-instance learning.

A document is a bag of passages of a fixed number of words. Each passage is
encoded: means over its words of how they are written, a hashed projection of
the words, and how much it repeats itself, through one trained layer. Gated
attention, learnt from document labels alone, weighs the passages; the weighted
passage representation is scored by a linear layer.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import labelled
from .common import PIECE, batches_with, doc_crc, each_text, in_batches, pieces, stored, with_fields

PASSAGE = 48
PROJECTION = 8
WRITING = 10
FEATURES = WRITING + PROJECTION + 3
HIDDEN, GATES = 16, 8
#: Rows of the fitting sample at most, and numbers in all their passages.
SAMPLE_ROWS, SAMPLE_NUMBERS = 8_000, 6_000_000
EPOCHS, BATCH, RATE = 12, 64, 0.01
#: Words that a worker remembers; then it forgets all.
CACHE = 100_000
#: Passages whose words are held together.
BLOCK = 512
PLAIN = set(".,;:'\"-?!()")


def writing(word: str) -> tuple[float, ...]:
    """How one word is written."""
    n, core = len(word), word.rstrip("!?.,;:")
    tail = n - len(core)
    if core.isalpha():  # most words: letters, then perhaps marks
        letters, digits, plain = len(core), 0, tail
        upper = 0 if core.islower() else letters if core.isupper() else sum(c.isupper() for c in core)
    else:
        letters, digits = sum(c.isalpha() for c in word), sum(c.isdigit() for c in word)
        upper, plain = sum(c.isupper() for c in word), sum(c in PLAIN for c in word)
    odd = n - letters - digits - plain
    return (upper / n, float(letters > 1 and upper == letters), float(word[0].isupper()), digits / n, odd / n,
            float(letters + digits == 0), min(n, 20) / 20, float(n <= 3), float(tail == 1), float(tail > 1))


class Words:
    """Number and features of each word, made when first seen."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.rows = np.zeros((1 << 12, WRITING + PROJECTION), dtype=np.float32)

    def numbers(self, words: list[str]) -> np.ndarray:
        if len(self.number) >= CACHE:
            self.clear()
        known = self.number
        new = [w for w in dict.fromkeys(words) if w not in known]
        if new:
            at, end = len(known), len(known) + len(new)
            if end > len(self.rows):
                more = np.zeros((max(end, 2 * len(self.rows)), WRITING + PROJECTION), dtype=np.float32)
                more[:at] = self.rows[:at]
                self.rows = more
            h = np.array([zlib.crc32(w.encode("utf-8", "replace")) for w in new])
            self.rows[at:end, :WRITING] = [writing(w) for w in new]
            self.rows[np.arange(at, end), WRITING + h % PROJECTION] = np.where(h >> 16 & 1, 1.0, -1.0)
            known.update(zip(new, range(at, end)))
        return np.fromiter(map(known.__getitem__, words), dtype=np.int64, count=len(words))


def _frequent(blocks: Iterator[list[str]]) -> set[str]:
    """The words that could make up more than a tenth of all: counts of at most
    ten words at a time, those of eleven different words cancel out."""
    held: Counter[str] = Counter()
    for words in blocks:
        held.update(words)
        if len(held) > 10:
            less = sorted(held.values(), reverse=True)[10]
            held = Counter({w: n - less for w, n in held.items() if n > less})
    return set(held)


def _blocks(text: str, block: int) -> Iterator[list[str]]:
    """The words of a whole text, `block` passages of them at a time."""
    words: list[str] = []
    for piece in pieces(text):
        words += piece.split()
        whole = len(words) // (block * PASSAGE) * (block * PASSAGE)
        for at in range(0, whole, block * PASSAGE):
            yield words[at:at + block * PASSAGE]
        words = words[whole:]
    if words:
        yield words


def passages(text: str, cache: Words, block: int = BLOCK) -> Iterator[np.ndarray]:
    """Encoder inputs of all passages of a whole text, a row each, `block` at a
    time; a text without words is one passage of zeros. The text is read up to
    three times, so that a long one's words are not held together."""
    first = next(iter(_blocks(text, block)), None)
    if first is None:
        yield np.zeros((1, FEATURES), dtype=np.float32)
    elif len(text) <= PIECE and len(first) < block * PASSAGE:  # most texts are one block
        yield _encoded(first, None, {w for w, n in Counter(first).items() if n * 10 > len(first)}, cache)
    else:
        del first
        total, counts = 0, dict.fromkeys(_frequent(_blocks(text, block)), 0)
        for words in _blocks(text, block):
            total += len(words)
            found = Counter(words)
            for w in counts:
                counts[w] += found[w]
        often, before = {w for w, n in counts.items() if n * 10 > total}, None
        for words in _blocks(text, block):
            yield _encoded(words, before, often, cache)
            before = words[-1]


def _encoded(words: list[str], before: str | None, often: set[str], cache: Words) -> np.ndarray:
    """Encoder inputs of consecutive passages, given the word before them and
    the words that make up more than a tenth of the whole text."""
    n = len(words)
    at = cache.numbers(words)
    starts = np.arange(0, n, PASSAGE)
    sizes = np.diff(np.append(starts, n)).astype(np.float32)
    sums = np.add.reduceat(cache.rows[at], starts, axis=0) / sizes[:, None]
    again = np.add.reduceat(np.concatenate([[float(words[0] == before)], (at[1:] == at[:-1])]), starts) / sizes
    bag = np.arange(n) // PASSAGE
    order = np.lexsort((at, bag))
    new = np.concatenate([[True], (at[order][1:] != at[order][:-1]) | (bag[order][1:] != bag[order][:-1])])
    different = np.add.reduceat(new.astype(np.float64), starts) / sizes
    # words of the passage that the whole text repeats very often
    marks = np.isin(at, [cache.number[w] for w in often if w in cache.number])
    repeated = np.add.reduceat(marks.astype(np.float64), starts) / sizes
    return np.concatenate([sums, np.stack([again, different, repeated], axis=1)], axis=1).astype(np.float32)


@dataclass
class Model:
    params: dict[str, np.ndarray]
    mean: np.ndarray
    scale: np.ndarray

    @staticmethod
    def start(seed: int, mean: np.ndarray, scale: np.ndarray) -> Model:
        rng = np.random.default_rng(seed)
        shapes = {"w": (FEATURES, HIDDEN), "v": (HIDDEN, GATES), "g": (HIDDEN, GATES), "a": (GATES,), "u": (HIDDEN,)}
        p = {k: rng.normal(0, 1 / np.sqrt(s[0]), s) for k, s in shapes.items()}
        return Model(p | {"b": np.zeros(HIDDEN), "c": np.zeros(1)}, mean, scale)

    def forward(self, x: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
        """Logits of bags that are given one after the other, and what led to them."""
        p, sizes = self.params, np.diff(np.append(starts, len(x)))
        x = np.clip((x - self.mean) / self.scale, -8, 8)
        h = np.tanh(x @ p["w"] + p["b"])
        t, s = np.tanh(h @ p["v"]), labelled.sigmoid(h @ p["g"])
        e = (t * s) @ p["a"]
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, starts), sizes))
        alpha = e / np.repeat(np.add.reduceat(e, starts), sizes)
        z = np.add.reduceat(alpha[:, None] * h, starts, axis=0)
        return {"x": x, "h": h, "t": t, "s": s, "alpha": alpha, "z": z, "sizes": sizes, "logit": z @ p["u"] + p["c"][0]}

    def backward(self, f: dict[str, np.ndarray], err: np.ndarray) -> dict[str, np.ndarray]:
        p = self.params
        dz = np.repeat(err[:, None] * p["u"], f["sizes"], axis=0)
        dalpha = (dz * f["h"]).sum(axis=1)
        mean = np.repeat((np.repeat(err[:, None], HIDDEN, 1) * p["u"] * f["z"]).sum(axis=1), f["sizes"])
        de = f["alpha"] * (dalpha - mean)
        dt, ds = de[:, None] * p["a"] * f["s"] * (1 - f["t"] ** 2), de[:, None] * p["a"] * f["t"] * f["s"] * (1 - f["s"])
        dh = dz * f["alpha"][:, None] + dt @ p["v"].T + ds @ p["g"].T
        dx = dh * (1 - f["h"] ** 2)
        return {"u": err @ f["z"], "c": np.array([err.sum()]), "a": de @ (f["t"] * f["s"]), "v": f["h"].T @ dt,
                "g": f["h"].T @ ds, "w": f["x"].T @ dx, "b": dx.sum(axis=0)}

    def score(self, blocks: Iterator[np.ndarray]) -> float:
        """Score of one bag whose passages come in blocks: the attention's
        softmax runs along, so no passage is kept."""
        p, top, weight, z = self.params, -np.inf, 0.0, np.zeros(HIDDEN)
        for x in blocks:
            h = np.tanh(np.clip((x.astype(np.float64) - self.mean) / self.scale, -8, 8) @ p["w"] + p["b"])
            e = (np.tanh(h @ p["v"]) * labelled.sigmoid(h @ p["g"])) @ p["a"]
            higher = max(top, float(e.max()))
            keep, new = np.exp(top - higher), np.exp(e - higher)
            weight, z, top = weight * keep + new.sum(), z * keep + new @ h, higher
        return float(labelled.sigmoid(z / weight @ p["u"] + p["c"][0]))


def fit(bags: list[np.ndarray], y: np.ndarray, seed: int = 7, epochs: int = EPOCHS) -> Model:
    """A model of labelled bags. With one class only, every score leans to it;
    without any row every score is 0.5 and nothing is rejected."""
    if not len(y):
        return Model({k: v * 0 for k, v in Model.start(seed, 0, 1).params.items()}, np.zeros(FEATURES), np.ones(FEATURES))
    every = np.concatenate(bags).astype(np.float64)
    model = Model.start(seed, every.mean(axis=0), every.std(axis=0) + 1e-3)
    adam, rng = labelled.Adam(model.params, RATE), np.random.default_rng(seed)
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(order), BATCH):
            some = order[at:at + BATCH]
            starts = np.cumsum([0, *(len(bags[i]) for i in some[:-1])])
            f = model.forward(np.concatenate([bags[i] for i in some]).astype(np.float64), starts)
            grads = model.backward(f, (labelled.sigmoid(f["logit"]) - y[some]) / len(some))
            adam.step({k: g + 1e-4 * model.params[k] for k, g in grads.items()})
    return model


def train(docs: DataFrame, labels: DataFrame, learn: Column | None = None, rows: int = SAMPLE_ROWS,
          numbers: int = SAMPLE_NUMBERS, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fits on at most `rows` labelled rows and `numbers` encoder inputs of them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = Words()
        yield from (b.drop_columns(["text"]) for b in batches_with(batches, features=lambda b: pa.array(
            [b"".join(x.astype("<f4").tobytes() for x in passages(t, cache)) for t in each_text(b, "text")], pa.binary())))

    some = labelled.sample(docs, labels, "quality", F.lit(True) if learn is None else learn, rows, id_col, text_col)
    # stored, since the features are read for their sizes and then for the fit
    features = stored(in_batches(some, run, "y int, turn long, features binary"), "quality-sample")
    return fit(*labelled.collected(features, FEATURES, "<f4", numbers))


def score(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """Adds `score_col` in 0 to 1: how likely the whole text has quality 1.

    A null text counts as empty: one passage of zeros. Rows and other columns
    stay as they are; a column named `score_col` is replaced. Memory beyond the
    text itself does not grow with its length.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = Words()
        yield from batches_with(batches, **{score_col: lambda b: pa.array(
            [model.score(passages(t, cache)) for t in each_text(b, text_col)], pa.float64())})

    return in_batches(docs, run, with_fields(docs.schema, **{score_col: T.DoubleType()}))


def learning_rows(id_col: str = "doc_id") -> Column:
    """Rows whose labels may be learnt; the others are held out."""
    return doc_crc(F.col(id_col)) % 3 != 1
