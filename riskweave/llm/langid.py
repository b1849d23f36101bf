"""Language by averaged hashed subword embeddings with a linear softmax.

Every run of letters is a word; its subwords are all pieces of 2 to 5 symbols
of the word with a boundary mark on either side. A subword's hash picks one of
a fixed number of embeddings, a text is the mean of the embeddings of all its
subwords, and a linear softmax gives a share to each learnt language. Both are
trained by stochastic gradient descent in numpy, on a bounded sample.

Rejection is calibrated on learning rows that the fit never saw, all of them:
Spark counts right and wrong answers by predicted language and confidence, and
a language's threshold is the least confidence from which the share of right
answers, drawn to that of all languages where rows are few, reaches a target.
"""

from __future__ import annotations

import functools
import sys
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import batches_with, doc_crc, each_text, fresh, in_batches, with_fields

BUCKET_BITS, DIM, SIZES = 15, 16, (2, 3, 4, 5)
BUCKETS = 1 << BUCKET_BITS
#: Characters that are looked at together; chunks overlap by the longest subword.
CHUNK = 1 << 16
#: The fitting sample: rows of a language and in all, numbers in all their subword counts, and characters of a text's
#: excerpts that make one training example each.
LANGUAGE_ROWS, SAMPLE_ROWS, SAMPLE_NUMBERS, EXCERPT = 600, 6_000, 6_000_000, 600
#: Parts by hash that a language's rows are taken from alike.
SALTS = 60
EPOCHS, RATE = 3, 4.0
UNDETERMINED = "und"
#: Share of right answers that accepted texts of a language should have, and how many rows' weight all languages have in it.
TARGET, WEIGHT = 0.99, 20.0
#: Confidence is counted by its log odds, in steps of 1 / STEPS from -LIMIT to LIMIT.
STEPS, LIMIT = 4, 16


@functools.cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), dtype=bool, count=sys.maxunicode + 1)


def subwords(text: str, chunk: int = CHUNK) -> Iterator[np.ndarray]:
    """Buckets of all subwords of a whole text, some at a time; none if it has no letter."""
    letters, wide = _letters(), max(SIZES)
    codes = np.zeros(1, dtype=np.uint64)
    for at in range(0, len(text), chunk):
        more = np.frombuffer(text[at:at + chunk].casefold().encode("utf-32-le", "surrogatepass"), dtype="<u4")
        more = np.where(letters[more], more, 0).astype(np.uint64)
        last = at + chunk >= len(text)
        codes = np.concatenate([codes, more, np.zeros(wide if last else 0, dtype=np.uint64)])
        starts = max(0, len(codes) - wide + 1)
        word = codes != 0
        hashes, inner = codes.copy(), np.ones(len(codes), dtype=bool)
        found = []
        for n in range(2, wide + 1):
            hashes = hashes[:-1] * np.uint64(1_099_511_628_211) + codes[n - 1:]
            inner = inner[:-1] & word[n - 2:len(word) - 1] if n > 2 else inner[:-1]
            if n in SIZES:
                # letters inside, and one at an end at least
                whole = inner & (word[:-n + 1] | word[n - 1:]) if n == 2 else inner
                use = hashes[:starts][whole[:starts]] + np.uint64(n)
                found.append((use * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64))
        codes = codes[starts:]
        got = np.concatenate(found)
        if len(got):
            yield got


@dataclass
class Model:
    languages: list[str]
    embeddings: np.ndarray
    softmax: np.ndarray
    thresholds: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def table(self) -> np.ndarray:
        """What a bucket adds to each language: mean and softmax are linear, so they can be joined."""
        return self.embeddings @ self.softmax.T


def guess(text: str, table: np.ndarray) -> tuple[int, float]:
    """(language, its share) of a whole text; language -1 if it has no letter or none was learnt."""
    total, n = np.zeros(table.shape[1]), 0
    for buckets in subwords(text):
        total += table[buckets].sum(axis=0)
        n += len(buckets)
    if not n or not len(total):
        return -1, 0.0
    e = np.exp(total / n - (total / n).max())
    best = int(e.argmax())
    return best, float(e[best] / e.sum())


def excerpts(text: str, size: int = EXCERPT) -> Iterator[np.ndarray]:
    """(bucket, count) pairs of each excerpt of a whole text."""
    for at in range(0, len(text), size):
        found = list(subwords(text[at:at + size]))
        if found:
            bucket, count = np.unique(np.concatenate(found), return_counts=True)
            yield np.stack([bucket, count], axis=1)


def fit(bags: list[np.ndarray], y: np.ndarray, languages: list[str], seed: int = 7, epochs: int = EPOCHS) -> Model:
    """SGD with a falling rate, one example after the other. Without examples nothing is learnt."""
    rng = np.random.default_rng(seed)
    e = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM))
    w = rng.normal(0, 0.1, (len(languages), DIM))
    weight = 1 / np.maximum(1, np.bincount(y, minlength=len(languages)))  # each language counts alike
    weight = weight / weight.max() if len(y) else weight
    weight = np.sqrt(weight)
    total, t = epochs * len(y), 0
    for _ in range(epochs):
        for i in rng.permutation(len(y)):
            bucket, share = bags[i][:, 0], bags[i][:, 1] / bags[i][:, 1].sum()
            h = share @ e[bucket]
            z = w @ h
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y[i]] -= 1
            rate = RATE * weight[y[i]] * (1 - t / total)
            step = p @ w
            w -= 0.05 * rate * np.outer(p, h)
            # the mean's gradient, not divided by the number of subwords a second time
            e[bucket] -= rate * np.outer(share / np.sqrt((share * share).sum()), step) * 0.1
            t += 1
    return Model(languages, e, w)


def train(docs: DataFrame, learn: Column | None = None, rows: int = SAMPLE_ROWS, language_rows: int = LANGUAGE_ROWS,
          numbers: int = SAMPLE_NUMBERS, target: float = TARGET, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang") -> Model:
    """A model of the rows that meet `learn` and have a language and an id.

    Three of four of them, by a hash of the id, are for the fit, which takes at
    most `language_rows` of each language and `rows` in all (rare languages
    first) and `numbers` numbers; all the others calibrate the thresholds.
    """
    learn = F.lit(True) if learn is None else learn
    usable = docs.where(learn & F.col(id_col).isNotNull() & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    usable = usable.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    to_fit = F.pmod(F.xxhash64("id"), F.lit(4)) != 0
    turn = F.xxhash64("id", "lang", F.lit(1))
    # the first rows of each language and salt, so that a frequent language is not sorted in one task
    salts = min(SALTS, language_rows)
    chosen = (usable.where(to_fit).select("id", "lang", turn.alias("turn"), F.pmod(turn, F.lit(salts)).alias("salt"))
              .withColumn("nth", F.row_number().over(Window.partitionBy("lang", "salt").orderBy("turn", "id")))
              .where(F.col("nth") <= language_rows // salts).orderBy("nth", "salt", "lang", "turn", "id").limit(rows)
              .select("id", "lang", "turn"))
    texts = (usable.join(F.broadcast(chosen.distinct()), ["id", "lang"]).groupBy("turn", "lang", "id")
             .agg(F.min("text").alias("text")).select("turn", "lang", "text"))

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            turns, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, text in enumerate(each_text(batch, "text")):
                found = list(excerpts(text))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([turns[i]] * len(found), pa.int64()), pa.array([langs[i]] * len(found), pa.string()),
                     pa.array(range(len(found)), pa.int32()),
                     pa.array([b.astype("<i4").tobytes() for b in found], pa.binary())],
                    names=["turn", "lang", "part", "features"])

    features = in_batches(texts, bags, "turn long, lang string, part int, features binary")
    # a hash of row and excerpt orders the examples, so what the bound leaves out is spread over texts
    ordered = features.select("lang", F.xxhash64("turn", "part").alias("turn"), "features")
    model = _fit_rows(ordered, numbers)
    model.thresholds = calibrated(identify(usable.where(~to_fit), model, "text"), model, target)
    return model


def _fit_rows(features: DataFrame, numbers: int) -> Model:
    """Fits on all examples, or on those with the smallest hashes if their
    numbers exceed the bound."""
    total = features.agg(F.sum(F.octet_length("features"))).first()[0] or 0
    if total > 4 * numbers:
        part = int(4 * numbers / total * 0.95 * (1 << 62))
        features = features.where(F.col("turn").bitwiseAND((1 << 62) - 1) < part)
    got = sorted(features.collect(), key=lambda r: (r.turn, r.lang, bytes(r.features)))
    languages = sorted({r.lang for r in got})
    at = {lang: i for i, lang in enumerate(languages)}
    return fit([np.frombuffer(r.features, dtype="<i4").reshape(-1, 2) for r in got],
               np.array([at[r.lang] for r in got], dtype=np.int64), languages)


def calibrated(guessed: DataFrame, model: Model, target: float = TARGET, weight: float = WEIGHT) -> np.ndarray:
    """The least share at which each language is accepted, from all rows of
    `guessed` (lang, lang_pred, score). Only counts by (language, confidence)
    come to the driver. Above 1 where no confidence reaches the target; 0 for
    all languages if there are no rows at all."""
    odds = F.log(F.col("score") / F.greatest(1 - F.col("score"), F.lit(1e-30)))
    step = F.floor(F.least(F.greatest(odds, F.lit(-LIMIT)), F.lit(LIMIT)) * STEPS).cast("int")
    counts = (guessed.where(F.col("lang_pred") != UNDETERMINED)
              .groupBy("lang_pred", step.alias("step")).agg(F.count("*").alias("n"), F.count_if(F.expr("lang = lang_pred")).alias("good"))
              .collect())
    steps = 2 * LIMIT * STEPS + 1
    n, good = np.zeros((2, len(model.languages), steps))
    for r in counts:
        at = model.languages.index(r.lang_pred), r.step + LIMIT * STEPS
        n[at], good[at] = r.n, r.good
    if not n.sum():
        return np.zeros(len(model.languages))
    n, good = (np.cumsum(a[:, ::-1], axis=1)[:, ::-1] for a in (n, good))  # from this confidence up
    every = good.sum(axis=0) / np.maximum(1, n.sum(axis=0))
    share = (good + weight * every) / (n + weight)
    ok = share >= target
    first = np.where(ok.any(axis=1), ok.argmax(axis=1), steps)
    edge = (first - LIMIT * STEPS) / STEPS
    return np.where(first == steps, 2.0, np.where(first == 0, 0.0, 1 / (1 + np.exp(-edge))))


def identify(docs: DataFrame, model: Model, text_col: str = "text", pred_col: str = "lang_pred", score_col: str = "score",
             accepted_col: str = "accepted") -> DataFrame:
    """Adds the learnt language with the highest share of the whole text, that
    share, and whether it reaches the language's calibrated threshold.

    A null text, or one without a letter, is `und` with score 0 and not
    accepted; so is every text if no language was learnt. Rows and other
    columns stay as they are; columns of the added names are replaced. Ties go
    to the language first in the alphabet. Memory does not grow with a text's
    length beyond the text itself.
    """
    table, languages, thresholds = model.table(), model.languages, model.thresholds
    shared = docs.sparkSession.sparkContext.broadcast(table)
    found, share = fresh("found", docs), fresh("share", docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [guess(t, shared.value) for t in each_text(batch, text_col)]
            yield from batches_with(iter([batch]), **{
                found: lambda _: pa.array([g[0] for g in got], pa.int32()), share: lambda _: pa.array([g[1] for g in got], pa.float64())})

    kept = [c for c in docs.columns if c.lower() not in {x.lower() for x in (pred_col, score_col, accepted_col)}]
    scored = in_batches(docs, run, with_fields(docs.schema, **{found: T.IntegerType(), share: T.DoubleType()}))
    names = F.array(*(F.lit(x) for x in languages)).cast("array<string>")
    limits = F.array(*(F.lit(float(x)) for x in (thresholds if len(thresholds) else np.zeros(len(languages))))).cast("array<double>")
    none = F.col(found) < 0
    return scored.select(*(F.col(f"`{c}`") for c in kept),
                         F.when(none, UNDETERMINED).otherwise(F.get(names, F.col(found))).alias(pred_col),
                         F.col(share).alias(score_col),
                         (~none & (F.col(share) >= F.coalesce(F.get(limits, F.col(found)), F.lit(0.0)))).alias(accepted_col))


def learning_rows(id_col: str = "doc_id") -> Column:
    """Rows that may be learnt from; the others are held out."""
    return doc_crc(F.col(id_col)) % 4 != 2
