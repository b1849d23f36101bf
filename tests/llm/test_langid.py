"""Language identification: held-out accuracy, subwords, calibration and odd rows."""

import zlib

import numpy as np
import pytest

from riskweave.llm import langid, queries
from tests.conftest import SF_CHECK

FR, EN = "le chat dort sur une chaise et le chien mange ", "the cat sleeps on a chair while the dog eats "


def plain(text):
    """Subwords with their boundary marks, by slicing."""
    words, word = [], ""
    for c in text.casefold():
        if c.isalpha():
            word += c
        else:
            words.append(word)
            word = ""
    out = []
    for w in [*words, word]:
        if w:
            marked = f"\0{w}\0"
            out += [marked[i:i + n] for n in langid.SIZES for i in range(len(marked) - n + 1)]
    return sorted(out)


def bucket(piece):
    h = 0
    for c in piece:
        h = (h * 1_099_511_628_211 + (ord(c) if c != "\0" else 0)) % 2 ** 64
    return ((h + len(piece)) * 0x9E3779B97F4A7C15 % 2 ** 64) >> (64 - langid.BUCKET_BITS)


@pytest.mark.parametrize("text", ["", "a", "12 ?!", "Ab cd", "Straße, ΣΟΦΟΣ x1y", "word " * 30 + "x" * 90, "日本語 テキスト é́"])
def test_subwords_of_a_whole_text_in_chunks(text):
    want = sorted(map(bucket, plain(text)))
    for chunk in (1, 3, 7, langid.CHUNK):
        assert sorted(np.concatenate([np.zeros(0, int), *langid.subwords(text, chunk)]).tolist()) == want


def test_memory_does_not_grow_with_the_text():
    import tracemalloc
    table = np.zeros((langid.BUCKETS, 2))
    langid.guess("warm up", table)
    peaks = []
    for size in (1 << 20, 1 << 23):
        text = "ab cd " * (size // 6)
        tracemalloc.start()
        langid.guess(text, table)
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert peaks[1] < 1.2 * peaks[0] < 60_000_000


def test_held_out_rows(spark):
    got = queries.op11_language(spark, SF_CHECK).collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF_CHECK}/documents.parquet").collect()}
    assert len(got) == 1000 and all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r.held_out and lang[r.doc_id] is not None]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) / len(held) >= 0.98


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, g, "x", 1) for i, t, g in rows], "doc_id int, text string, lang string, lang_pred string, found int")


def test_odd_rows(spark):
    rows = [(i, (FR if i % 3 else EN) * 4, "fr" if i % 3 else "en") for i in range(120)]
    odd = [(None, None, None), (500, None, "fr"), (501, "", "en"), (502, "12 345 !", "fr"), (503, FR, None), (503, FR, None), (None, EN, "en")]
    docs = docs_of(spark, rows + odd)
    model = langid.train(docs, langid.learning_rows())
    assert model.languages == ["en", "fr"]
    got = langid.identify(docs, model)
    assert got.columns == ["doc_id", "text", "lang", "found", "lang_pred", "score", "accepted"]
    got = got.collect()
    assert len(got) == len(rows) + len(odd)
    for r in got:
        if r.text is None or not any(c.isalpha() for c in r.text):
            assert (r.lang_pred, r.score, r.accepted) == ("und", 0.0, False)
        else:
            assert r.lang_pred == ("fr" if r.text.startswith("le") else "en") and r.accepted
    long = langid.identify(docs_of(spark, [(1, FR * 60_000, None)]), model).first()
    assert long.lang_pred == "fr"
    assert langid.identify(docs.limit(0), model).count() == 0
    none = langid.train(docs.limit(0))
    assert none.languages == [] and {r.lang_pred for r in langid.identify(docs, none).collect()} == {"und"}


def test_thresholds_from_all_rows_and_few_rows(spark):
    model = langid.Model(["aa", "bb", "cc"], np.zeros((1, 1)), np.zeros((3, 1)))

    def share(odds):
        return float(1 / (1 + np.exp(-odds)))

    # aa is right from log odds 2 on; bb always; cc has no rows
    rows = [("aa" if o >= 2 else "zz", "aa", share(o + 0.1)) for o in (0, 1, 2, 3) for _ in range(5000)]
    rows += [("bb", "bb", share(0.1))] * 5000 + [("bb", "und", 0.0)]
    t = langid.calibrated(spark.createDataFrame(rows, "lang string, lang_pred string, score double"), model, 0.99)
    assert share(1.2) < t[0] <= share(2.1) and t[1] == 0.0
    assert (langid.calibrated(spark.createDataFrame([], "lang string, lang_pred string, score double"), model) == 0).all()
    wrong = spark.createDataFrame([("bb", "aa", 0.9)] * 50, "lang string, lang_pred string, score double")
    assert langid.calibrated(wrong, model)[0] > 1


def test_sample_is_bounded(spark):
    rows = [(i, EN, "en") for i in range(300)] + [(1000 + i, FR, "fr") for i in range(300)]
    seen = []
    real = langid.fit
    try:
        langid.fit = lambda bags, y, languages, **kw: seen.append((len(bags), np.bincount(y).tolist())) or real(bags, y, languages)
        langid.train(docs_of(spark, rows), rows=30, language_rows=20)
        langid.train(docs_of(spark, rows), numbers=200)
    finally:
        langid.fit = real
    assert seen[0] == (30, [15, 15]) and 0 < seen[1][0] < 20
