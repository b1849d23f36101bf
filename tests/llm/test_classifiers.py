"""Toxicity and quality classifiers: held-out accuracy and odd rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave.llm import labelled, quality, queries, toxicity
from tests.conftest import SF_CHECK


def auc(rows):
    pos = [s for s, y in rows if y]
    neg = [s for s, y in rows if not y]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("name, label, mod, rest, least", [("op10_quality", "quality", 3, 1, 0.97), ("op5_toxicity", "toxic", 5, 0, 0.85)])
def test_held_out_rows(spark, name, label, mod, rest, least):
    import zlib
    got = queries.QUERIES[name](spark, SF_CHECK).collect()
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    assert len(got) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % mod == rest) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    y = {r.doc_id: r[label] for r in spark.read.parquet(f"{SF_CHECK}/labels.parquet").collect()}
    held = [(r.score, y[r.doc_id]) for r in got if r.held_out and r.doc_id in y]
    assert auc(held) >= least
    assert sum((s >= 0.5) == bool(v) for s, v in held) / len(held) >= 0.93


@pytest.mark.parametrize("module, label", [(toxicity, "toxic"), (quality, "quality")])
def test_odd_rows_and_labels(spark, module, label):
    good, bad = "calm words about a quiet day. " * 6, "SHOUT*** idiot&&& trash!!! " * 8
    docs = spark.createDataFrame([(i, bad if i % 4 == 0 else good, "x") for i in range(60)] + [(None, None, "x"), (61, "", "x"), (61, "", "x")],
                                 "doc_id int, text string, score string")
    flag = (lambda i: int(i % 4 == 0)) if label == "toxic" else (lambda i: int(i % 4 != 0))
    labels = spark.createDataFrame([(i, flag(i)) for i in range(60)] + [(None, 1), (3, None), (999, 1)], f"doc_id int, {label} int")
    scored = module.score(docs, module.train(docs, labels)).collect()
    assert len(scored) == 63 and all(0 <= r.score <= 1 for r in scored)
    assert all((r.score >= 0.5) == bool(flag(r.doc_id)) for r in scored if r.doc_id is not None and r.doc_id < 60)
    none = module.score(docs, module.train(docs, labels.limit(0))).collect()
    assert all(r.score < 0.5 for r in none) if module is toxicity else all(r.score == 0.5 for r in none)
    assert module.score(docs.limit(0), module.train(docs, labels)).count() == 0


def test_sample_is_bounded(spark):
    docs = spark.createDataFrame([(i, "a b c") for i in range(50)], "doc_id int, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)], "doc_id int, toxic int")
    some = labelled.sample(docs, labels, "toxic", F.col("doc_id") % 5 != 0, 10)
    assert some.count() == 10
    features = some.select("y", "turn", F.lit(bytearray(b"12345678")).alias("features"))
    assert len(labelled.collected(features, 1, "<i8", 7)[0]) == 7


def test_one_toxic_word_anywhere_in_a_long_text_counts():
    rng = random.Random(1)
    words = [f"w{i}" for i in range(300)]
    cache = toxicity.Words()
    texts = [[rng.choice(words) for _ in range(80)] for _ in range(400)]
    for t in texts[::4]:
        t[rng.randrange(80)] = rng.choice(["idiot", "moron"])
    y = np.array([float(i % 4 == 0) for i in range(400)])
    model = toxicity.fit([toxicity.words_of(" ".join(t), cache) for t in texts], y)
    long = [rng.choice(words) for _ in range(30_000)]
    assert model.score(toxicity.words_of(" ".join(long), cache)) < 0.5
    for at in (0, 8190, 8192, 29_999):
        assert model.score(toxicity.words_of(" ".join(long[:at] + ["idiot"] + long[at + 1:]), cache)) >= 0.5


def test_gradients_of_the_attention_model():
    rng = np.random.default_rng(0)
    model = quality.Model.start(1, np.zeros(quality.FEATURES), np.ones(quality.FEATURES))
    x, starts, y = rng.normal(size=(9, quality.FEATURES)), np.array([0, 2, 3]), np.array([1.0, 0.0, 1.0])

    def loss():
        p = labelled.sigmoid(model.forward(x, starts)["logit"])
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).sum()

    f = model.forward(x, starts)
    grads = model.backward(f, labelled.sigmoid(f["logit"]) - y)
    for k, v in model.params.items():
        at = tuple(rng.integers(0, s) for s in v.shape)
        v[at] += 1e-5
        up = loss()
        v[at] -= 2e-5
        down = loss()
        v[at] += 1e-5
        assert abs((up - down) / 2e-5 - grads[k][at]) < 1e-5, k


def test_a_giant_row_or_a_repeated_id_leaves_the_sample(spark):
    rows = spark.createDataFrame([(i % 2, i, bytearray(b"12345678" * (100 if i == 0 else 1))) for i in range(9)],
                                 "y int, turn long, features binary")
    assert [len(x) for x in labelled.collected(rows, 1, "<i8", 20)[0]] == [1] * 8
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(40)] + [(2, "other")], "doc_id int, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id int, toxic int")
    got = labelled.sample(docs, labels, "toxic", F.lit(True), 10).collect()
    assert sorted((r.text, r.y) for r in got) == [("other", 0), ("text 0", 1)]


def test_thresholds_by_language_shrink_smoothly():
    """A language with many rows has its own threshold, one with few leans on all, one with none takes theirs."""
    steps = 2 * toxicity.LIMIT * toxicity.STEPS + 1

    def at(logit):
        return int(np.floor(logit * toxicity.STEPS)) + toxicity.LIMIT * toxicity.STEPS

    counts = np.zeros((5, 2, steps))
    counts[0, 0, at(-4)], counts[0, 1, at(0)] = 10_000, 5_000  # en: toxic from 0 on
    counts[1, 0, at(1)], counts[1, 1, at(5)] = 3_000, 900  # de: clean up to 1
    counts[2, 0, at(1)], counts[2, 1, at(5)] = 3, 1
    t = toxicity.thresholds(counts)
    common = toxicity.thresholds(counts.sum(axis=0, keepdims=True))[0]
    assert -4 < t[0] <= 0.2 and 1 < t[1] <= 5.2
    assert t[3] == t[4] == common and common < t[2] < (common + t[1]) / 2
    assert (toxicity.thresholds(np.zeros((5, 2, steps))) == 0).all()
    many = counts.copy()
    many[2] *= 1000  # the same rows a thousand times: nearly its own
    assert abs(toxicity.thresholds(many)[2] - t[1]) < 0.1
