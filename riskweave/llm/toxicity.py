"""Toxicity by a convolutional text classifier in numpy.

A word is the pair of vectors at two independent hashes of it; filters of
several widths run over the words of the whole text, each gives its highest
value anywhere (max pooling), and a linear layer makes the logit. Two tables
keep one chance collision with a telling word from looking like that word.
The first component of a vector starts as how surely its bucket marks toxic
training documents; everything is then trained by Adam on the logistic loss.
Logits are shifted by a threshold calibrated for the language that the words
themselves suggest, so 0.5 is the threshold in every language; label tables'
lang is not read. The thresholds come from all labelled rows held back from the
fit: Spark scores them and counts by language, label and logit.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import labelled
from .common import batches_with, doc_crc, each_text, in_batches, pieces, stored, with_fields

BUCKET_BITS, DIM, FILTERS, WIDTHS = 17, 8, 12, (1, 2, 3)
#: One in so many labelled rows calibrates the thresholds and is not fitted on.
HELD_BACK = 5
BUCKETS = 1 << BUCKET_BITS
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
#: Rows of the fitting sample at most, and hashed words in all of them.
SAMPLE_ROWS, SAMPLE_WORDS = 12_000, 8_000_000
EPOCHS, BATCH, RATE = 3, 32, 0.01
CACHE = 100_000
#: Logits are counted in steps of 1 / STEPS from -LIMIT to LIMIT; rows by which all languages draw one; what a missed text costs.
STEPS, LIMIT, WEIGHT, MISSED = 8, 32, 20.0, 4.0
#: Words that are convolved at a time; blocks overlap by the widest filter.
BLOCK = 8192

#: Frequent function words that tell the languages apart.
FUNCTION_WORDS = {
    "en": "the of and to in a is that it for on was with as be are this by at from",
    "de": "der die und in den von zu das mit sich des auf ist im dem nicht ein eine als auch",
    "fr": "de la le et les des en un du une que est pour qui dans par sur au pas plus",
    "es": "de la que el en y a los se del las un por con no una su para es al",
}
LANGUAGES = list(FUNCTION_WORDS)


def _language_codes() -> dict[bytes, int]:
    """Bit set of the languages that a function word speaks for."""
    codes: dict[bytes, int] = {}
    for i, words in enumerate(FUNCTION_WORDS.values()):
        for w in words.split():
            codes[w.encode()] = codes.get(w.encode(), 0) | 1 << i
    return codes


class Words(dict):
    """word -> both hashes and its language bits in one integer."""

    codes = _language_codes()

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        h = xxhash.xxh64_intdigest(word)
        a, b = h % (BUCKETS - 1) + 1, (h >> 32) % (BUCKETS - 1) + 1  # bucket 0 is padding
        self[word] = found = a | b << BUCKET_BITS | self.codes.get(word, 0) << 2 * BUCKET_BITS
        return found


def words_of(text: str, cache: Words) -> np.ndarray:
    """One integer a word, for the whole text."""
    found = WORD.findall(text.lower().encode("utf-8", "replace"))
    return np.fromiter(map(cache.__getitem__, found), dtype=np.int64, count=len(found))


def votes(words: np.ndarray) -> np.ndarray:
    """How many function words of each language there are."""
    bits = words >> 2 * BUCKET_BITS
    return np.array([int((bits >> i & 1).sum()) for i in range(len(LANGUAGES))])


def most(counted: np.ndarray) -> int:
    """Index of the language with most function words; len(LANGUAGES) if none."""
    return int(np.argmax(counted)) if counted.max() else len(LANGUAGES)


def language(words: np.ndarray) -> int:
    return most(votes(words))


@dataclass
class Model:
    params: dict[str, np.ndarray]
    thresholds: np.ndarray  # by language, the last for texts of none

    @staticmethod
    def start(seed: int, words: list[np.ndarray], y: np.ndarray) -> Model:
        rng = np.random.default_rng(seed)
        p: dict[str, np.ndarray] = {}
        for table, shift in (("e0", 0), ("e1", BUCKET_BITS)):
            e = rng.normal(0, 0.05, (BUCKETS, DIM)).astype(np.float32)
            counts = np.full((2, BUCKETS), 0.5)
            for x, label in zip(words, y):
                counts[int(label), np.unique(x >> shift & BUCKETS - 1)] += 1
            odds = np.log(counts[1] / ((y == 1).sum() + 1)) - np.log(counts[0] / ((y == 0).sum() + 1))
            doubt = 1.5 * np.sqrt(1 / counts[0] + 1 / counts[1])
            e[:, 0] = np.clip(odds - doubt, 0, 5) / 5
            e[0] = 0
            p[table] = e
        for w in WIDTHS:
            f = rng.normal(0, 0.2, (w, 2 * DIM, FILTERS)).astype(np.float32)
            f[0, 0, :3] = f[0, DIM, :3] = 1
            p[f"f{w}"], p[f"b{w}"] = f, np.full(FILTERS, -0.1, dtype=np.float32)
        p["u"] = np.abs(rng.normal(0, 0.3, len(WIDTHS) * FILTERS)).astype(np.float32)
        p["c"] = np.array([-2.0], dtype=np.float32)
        return Model(p, np.zeros(len(LANGUAGES) + 1))

    def vectors(self, words: np.ndarray) -> np.ndarray:
        p, mask = self.params, BUCKETS - 1
        return np.concatenate([p["e0"][words & mask], p["e1"][words >> BUCKET_BITS & mask]], axis=1)

    def pooled(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(filter maxima, place of each) over all words; texts shorter than
        the widest filter are padded."""
        p, widest = self.params, max(WIDTHS)
        if len(words) < widest:
            words = np.concatenate([words, np.zeros(widest - len(words), dtype=np.int64)])
        flat = np.concatenate([p[f"f{w}"][j] for w in WIDTHS for j in range(w)], axis=1)
        best = np.full(len(WIDTHS) * FILTERS, -np.inf, dtype=np.float32)
        place = np.zeros(len(best), dtype=np.int64)
        for at in range(0, len(words) - widest + 1, BLOCK):
            x = self.vectors(words[at:at + BLOCK + widest - 1])
            y, n, col = x @ flat, len(x), 0
            for k, w in enumerate(WIDTHS):
                conv = y[:n - w + 1, col:col + FILTERS]
                for j in range(1, w):
                    conv = conv + y[j:n - w + 1 + j, col + j * FILTERS:col + (j + 1) * FILTERS]
                col += w * FILTERS
                arg = conv.argmax(axis=0)
                top = conv[arg, np.arange(FILTERS)]
                part = slice(k * FILTERS, (k + 1) * FILTERS)
                higher = top > best[part]
                place[part] = np.where(higher, at + arg, place[part])
                best[part] = np.maximum(top, best[part])
        return best, place

    def logit(self, words: np.ndarray) -> float:
        p = self.params
        best, _ = self.pooled(words)
        h = np.maximum(best + np.concatenate([p[f"b{w}"] for w in WIDTHS]), 0)
        return float(h @ p["u"] + p["c"][0])

    def score(self, words: np.ndarray) -> float:
        return float(labelled.sigmoid(np.float64(self.logit(words) - self.thresholds[language(words)])))

    def judge(self, text: str, cache: Words) -> tuple[float, int]:
        """(logit, language) of a whole text, whose words are convolved piece
        by piece; a piece begins with the last words of the one before."""
        p, lap = self.params, max(WIDTHS) - 1
        best, counted, rest = None, np.zeros(len(LANGUAGES), dtype=np.int64), np.zeros(0, dtype=np.int64)
        for piece in pieces(text):
            new = words_of(piece, cache)
            counted += votes(new)
            rest = np.concatenate([rest, new])
            if len(rest) > lap:
                top, _ = self.pooled(rest)
                best = top if best is None else np.maximum(best, top)
                rest = rest[len(rest) - lap:]
        if best is None:
            best, _ = self.pooled(rest)
        h = np.maximum(best + np.concatenate([p[f"b{w}"] for w in WIDTHS]), 0)
        return float(h @ p["u"] + p["c"][0]), most(counted)


def _fit(words: list[np.ndarray], y: np.ndarray, seed: int, epochs: int) -> Model:
    model = Model.start(seed, words, y)
    p, mask = model.params, BUCKETS - 1
    dense = labelled.Adam({k: v for k, v in p.items() if k not in ("e0", "e1")}, RATE)
    squares = {k: np.full(BUCKETS, 1e-3) for k in ("e0", "e1")}
    rng = np.random.default_rng(seed)
    weight = np.where(y == 1, min(10.0, max(1.0, (y == 0).sum() / max(1, (y == 1).sum()))), 1.0)
    for _ in range(epochs):
        order = rng.permutation(len(words))
        for at in range(0, len(order), BATCH):
            some = order[at:at + BATCH]
            grads = {k: np.zeros_like(v) for k, v in dense.params.items()}
            rows, steps = {"e0": [], "e1": []}, {"e0": [], "e1": []}
            for i in some:
                x = words[i]
                if len(x) < max(WIDTHS):
                    x = np.concatenate([x, np.zeros(max(WIDTHS) - len(x), dtype=np.int64)])
                best, place = model.pooled(x)
                h = np.maximum(best + np.concatenate([p[f"b{w}"] for w in WIDTHS]), 0)
                err = weight[i] * (labelled.sigmoid(np.float64(h @ p["u"] + p["c"][0])) - y[i]) / len(some)
                grads["u"] += err * h
                grads["c"] += err
                back = err * p["u"] * (h > 0)
                for k, w in enumerate(WIDTHS):
                    g = back[k * FILTERS:(k + 1) * FILTERS]
                    grads[f"b{w}"] += g
                    for j in range(w):
                        at_word = x[place[k * FILTERS:(k + 1) * FILTERS] + j]
                        grads[f"f{w}"][j] += model.vectors(at_word).T * g
                        de = p[f"f{w}"][j].T * g[:, None]
                        for name, shift, part in (("e0", 0, slice(0, DIM)), ("e1", BUCKET_BITS, slice(DIM, 2 * DIM))):
                            rows[name].append(at_word >> shift & mask)
                            steps[name].append(de[:, part])
            dense.step(grads)
            for name in rows:
                at_row, inverse = np.unique(np.concatenate(rows[name]), return_inverse=True)
                g = np.zeros((len(at_row), DIM), dtype=np.float32)
                np.add.at(g, inverse, np.concatenate(steps[name]))
                squares[name][at_row] += (g * g).sum(axis=1)
                p[name][at_row] -= (RATE * g / np.sqrt(squares[name][at_row])[:, None]).astype(np.float32)
                p[name][0] = 0
    return model


def fit(words: list[np.ndarray], y: np.ndarray, seed: int = 7, epochs: int = EPOCHS) -> Model:
    """A model of the sample, not yet calibrated. Without rows of both classes
    every score is below 0.5."""
    if not len(y) or y.min() == y.max():
        model = Model.start(seed, [], np.zeros(0))
        model.thresholds += 30.0
        return model
    return _fit(words, y, seed, epochs)


def train(docs: DataFrame, labels: DataFrame, learn: Column | None = None, rows: int = SAMPLE_ROWS,
          words: int = SAMPLE_WORDS, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Four of five labelled rows that meet `learn`, by a hash of the id, are
    for the fit, which takes at most `rows` of them and `words` of their words;
    every other one, whatever their number, calibrates the languages' thresholds."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = Words()
        yield from (b.drop_columns(["text"]) for b in batches_with(
            batches, features=lambda b: pa.array([b"".join(words_of(p, cache).tobytes() for p in pieces(t)) for t in each_text(b, "text")], pa.binary())))

    held_back = F.pmod(F.xxhash64(id_col), F.lit(HELD_BACK)) == HELD_BACK - 1
    may = F.lit(True) if learn is None else learn
    # stored, since the features are read for their sizes and then for the fit
    some = stored(in_batches(labelled.sample(docs, labels, "toxic", may & ~held_back, rows, id_col, text_col), run,
                             "y int, turn long, features binary"), "toxic-sample")
    features, y = labelled.collected(some, 1, "<i8", words)
    model = fit([x[:, 0] for x in features], y)
    if not len(y) or y.min() == y.max():
        return model
    marked = (labels.where(F.col(id_col).isNotNull() & F.col("toxic").isNotNull() & may & held_back)
              .groupBy(F.col(id_col).alias("id")).agg((F.avg("toxic") >= 0.5).alias("toxic")))
    rest = docs.where(F.col(id_col).isNotNull() & may & held_back).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    counts = (judged(rest, model).join(marked, "id").groupBy("spoken", "step", "toxic").agg(F.count("*").alias("n")).collect())
    n = np.zeros((len(LANGUAGES) + 1, 2, 2 * LIMIT * STEPS + 1))
    for r in counts:  # at most languages x steps x 2 rows
        n[r.spoken, int(r.toxic), r.step + LIMIT * STEPS] = r.n
    model.thresholds = thresholds(n)
    return model


def judged(docs: DataFrame, model: Model) -> DataFrame:
    """(id, spoken, step): language and logit, in steps of 1 / STEPS, of (id, text) rows."""
    kind = docs.schema["id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model.params)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, cache = Model(shared.value, np.zeros(0)), Words()
        for batch in batches:
            got = [m.judge(t, cache) for t in each_text(batch, "text")]
            steps = [int(np.floor(min(max(logit, -LIMIT), LIMIT) * STEPS)) for logit, _ in got]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([s for _, s in got], pa.int32()), pa.array(steps, pa.int32())],
                                             names=["id", "spoken", "step"])

    return in_batches(docs.select("id", "text"), run, f"id {kind}, spoken int, step int")


def thresholds(counts: np.ndarray, weight: float = WEIGHT) -> np.ndarray:
    """The logit from which each language's texts count as toxic, from counts
    by (language, label, step): the middle of the widest range in which wrong
    answers are fewest, a toxic text that is missed counting as `MISSED` clean
    ones that are rejected. A language's own threshold is drawn to that of all
    languages by as much as `weight` rows, against twice the rows of its rarer label."""
    def least_wrong(clean: np.ndarray, toxic: np.ndarray) -> float:
        # wrong answers if the threshold lies below step k: toxic rows under it, clean rows from it on
        wrong = MISSED * np.concatenate([[0], np.cumsum(toxic)]) + clean.sum() - np.concatenate([[0], np.cumsum(clean)])
        best = np.flatnonzero(wrong <= wrong.min() + 1e-9)
        widest = max(np.split(best, np.flatnonzero(np.diff(best) > 1) + 1), key=len)
        return ((widest[0] + widest[-1]) / 2 - LIMIT * STEPS) / STEPS

    if not counts.sum():
        return np.zeros(len(counts))
    common = least_wrong(*counts.sum(axis=0))
    n = 2 * counts.sum(axis=2).min(axis=1)
    own = np.array([least_wrong(*c) for c in counts])
    return (n * own + weight * common) / (n + weight)


def score(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """Adds `score_col` in 0 to 1: how likely the whole text is toxic.

    A null text counts as empty and has the score of a text without words. Rows
    and other columns stay as they are; a column named `score_col` is replaced.
    Memory beyond the text itself does not grow with its length.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.params, model.thresholds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, cache = Model(*shared.value), Words()

        def one(text: str) -> float:
            logit, spoken = m.judge(text, cache)
            return float(labelled.sigmoid(np.float64(logit - m.thresholds[spoken])))

        yield from batches_with(batches, **{score_col: lambda b: pa.array(
            [one(t) for t in each_text(b, text_col)], pa.float64())})

    return in_batches(docs, run, with_fields(docs.schema, **{score_col: T.DoubleType()}))


def learning_rows(id_col: str = "doc_id") -> Column:
    """Rows whose labels may be learnt; the others are held out."""
    return doc_crc(F.col(id_col)) % 5 != 0
