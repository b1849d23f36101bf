"""Memory of the text operators for texts of any length, and pieces of texts."""

import random
import tracemalloc

import numpy as np
import public_tokenizers
import pytest

from riskweave.llm import bpe, common, quality, simhash, toxicity

PATH = public_tokenizers.path("byte_bpe_50k.json")


def text_of(n, seed=0):
    rng = random.Random(seed)
    words = [f"w{rng.randrange(500)}" for _ in range(300)]
    return " ".join(words * (n // 900 + 1))[:n]


@pytest.mark.parametrize("text", ["", " ", "a", "a b", " a  b ", " x\x1fy\n", "abc" * 50, "ab cd\tef " * 40])
def test_pieces_are_the_whole_text(text):
    for size in (1, 5, 64, common.PIECE):
        got = list(common.pieces(text, size=size))
        assert "".join(got) == text and [w for p in got for w in p.split()] == text.split()


def whole_passages(text, cache):
    """The encoder inputs from all words at once."""
    words = text.split()
    n = len(words)
    often = {w for w in set(words) if words.count(w) * 10 > n}
    return quality._encoded(words, None, often, cache)


@pytest.mark.parametrize("n", [10, 5_000, 40_000])
def test_passages_in_blocks(n, monkeypatch):
    text = ("the " * 40 + text_of(300)) * (n // 460 + 1)
    cache = quality.Words()
    want = whole_passages(text, cache)
    for block, piece in ((1, 50), (3, 700), (512, common.PIECE)):
        monkeypatch.setattr(quality, "PIECE", piece)
        got = np.concatenate(list(quality.passages(text, cache, block)))
        assert np.allclose(got, want)


def test_frequent_words_are_never_missed():
    rng = random.Random(2)
    words = ["x"] * 120 + [f"r{i}" for i in range(980)]
    rng.shuffle(words)
    assert "x" in quality._frequent([words[i:i + 7] for i in range(0, len(words), 7)])


def test_running_softmax_equals_the_whole_one():
    rng = np.random.default_rng(0)
    model = quality.Model.start(1, np.zeros(quality.FEATURES), np.ones(quality.FEATURES))
    x = rng.normal(size=(57, quality.FEATURES)) * 3
    want = quality.labelled.sigmoid(model.forward(x, np.array([0]))["logit"])[0]
    assert abs(model.score(iter(np.split(x, [1, 9, 40]))) - want) < 1e-12


def test_toxicity_by_pieces(monkeypatch):
    cache = toxicity.Words()
    model = toxicity.Model.start(3, [], np.zeros(0))
    for text in ("", "a", "a b", text_of(3_000), "the der " * 900):
        words = toxicity.words_of(text, cache)
        for size in (3, 40, common.PIECE):
            monkeypatch.setattr(toxicity, "pieces", lambda t, s=size: common.pieces(t, size=s))
            logit, spoken = model.judge(text, cache)
            assert abs(logit - model.logit(words)) < 1e-5 and spoken == toxicity.language(words)


def test_simhash_by_pieces(monkeypatch):
    for text in ("", "a b", "a b c d", "a b c d e", text_of(4_000), "x\x0by\x1cz " * 50):
        monkeypatch.undo()
        want = simhash.fingerprint(text)
        for size, chunk in ((1, 1), (30, 7), (500, 64)):
            monkeypatch.setattr(simhash, "pieces", lambda t, w, s=size: common.pieces(t, w, s))
            monkeypatch.setattr(simhash, "CHUNK", chunk)
            assert simhash.fingerprint(text) == want


def test_bpe_by_blocks(monkeypatch):
    v = bpe.Vocabulary(PATH)
    text = text_of(3_000) + " déjà 你好  \n end"
    ids = v.encode(text)
    monkeypatch.setattr(bpe, "BLOCK", 16)
    assert v.encode(text) == ids and v.decode(ids).decode() == text


def added(run, n):
    text = text_of(n)
    tracemalloc.start()
    run(text)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return peak


def test_memory_beyond_the_text_does_not_grow():
    words, toxic = quality.Words(), toxicity.Words()
    q = quality.Model.start(1, np.zeros(quality.FEATURES), np.ones(quality.FEATURES))
    t = toxicity.Model.start(3, [], np.zeros(0))
    for run in (lambda x: q.score(quality.passages(x, words)), lambda x: t.judge(x, toxic), simhash.fingerprint):
        run(text_of(100_000))
        small, large = added(run, 400_000), added(run, 2_400_000)
        assert large < 1.3 * small + 2_000_000 and large < 60_000_000
    v = bpe.Vocabulary(PATH)
    v.encode(text_of(10_000))

    def round_trip(x):
        v.decode(v.encode(x))

    small, large = added(round_trip, 400_000), added(round_trip, 2_400_000)
    assert large - small < 6 * 2_000_000  # ids and decoded bytes, twice while they are joined
