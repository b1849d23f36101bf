"""The pipeline's stages on small tables."""

import os
import re

import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

import corpus_pipeline
from riskweave.llm import quality, stages, toxicity
from tests.conftest import SF_SMALL

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, score double, kept_id string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), 0.0, "x") for i, t in rows], COLUMNS)


def test_five_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "good_quality", "not_toxic", "near_duplicates", "clean_of_benchmark", "tokens"]


def test_near_duplicates_keeps_one_of_each_group(spark):
    a, b = "one two three four five six seven", "other words stand in this text here"
    got = stages.near_duplicates(spark, docs_of(spark, [
        (5, a), (3, a), (3, a), (9, b), (None, b), (3, b + " and more of them until it differs"), (None, "lone text of its own kind"),
        (8, None), (7, "")]), "")
    assert sorted((r.doc_id or -1, r.text) for r in got.collect()) == sorted([
        (3, a), (9, b), (3, b + " and more of them until it differs"), (-1, "lone text of its own kind"), (7, "")])
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "score", "kept_id"]


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES])
def test_stage_takes_empty_tables(spark, stage):
    assert stage(spark, docs_of(spark, []), SF_SMALL).count() == 0


def test_pipeline_end_to_end(spark):
    got = corpus_pipeline.run(spark, SF_SMALL)
    rows = got.collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    assert rows and all(r.round_trip for r in rows)
    assert len({r.doc_id for r in rows}) == len(rows) and {r.doc_id for r in rows} <= docs.keys()
    assert len({docs[r.doc_id].text for r in rows}) == len(rows)
    items = [r.text for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    assert not any(i in docs[r.doc_id].text for r in rows for i in items)


def test_stage_filters_equal_the_operators(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    good = quality.score(docs, quality.train(docs, labels, quality.learning_rows()), score_col="q").where("q >= 0.5")
    assert {r.doc_id for r in good.collect()} == {r.doc_id for r in stages.good_quality(spark, docs, SF_SMALL).collect()}
    mild = toxicity.score(docs, toxicity.train(docs, labels, toxicity.learning_rows()), score_col="t").where("t < 0.5")
    assert {r.doc_id for r in mild.collect()} == {r.doc_id for r in stages.not_toxic(spark, docs, SF_SMALL).collect()}


def test_importable_without_the_subpackage():
    """Only __spark_entry__.py knows of this subpackage."""
    root = os.path.dirname(corpus_pipeline.__file__)
    for folder, _, names in os.walk(os.path.join(root, "riskweave")):
        if "llm" in folder:
            continue
        for n in names:
            if n.endswith(".py"):
                with open(os.path.join(folder, n), encoding="utf-8") as f:
                    assert "llm" not in f.read(), n


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_equals_a_plain_version(spark):
    """Every stage by loops on the driver; the classifiers are trained on the same rows."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    model, cache = quality.train(docs, labels, quality.learning_rows()), quality.Words()
    rows = [(i, t) for i, t in rows if model.score(quality.passages(t, cache)) >= 0.5]
    model, cache = toxicity.train(spark.createDataFrame(rows, "doc_id long, text string"), labels, toxicity.learning_rows()), toxicity.Words()
    rows = [(i, t) for i, t in rows if model.score(toxicity.words_of(t, cache)) < 0.5]
    prints, root = {i: plain_fingerprint(t) for i, t in rows}, {i: i for i, _ in rows}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in prints:
        for j in prints:
            if i < j and (prints[i] ^ prints[j]).bit_count() <= 4:
                a, b = sorted((top(i), top(j)))
                root[b] = a
    rows = [(i, t) for i, t in rows if top(i) == i]
    items = [r.text for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    rows = [(i, t) for i, t in rows if not any(x in t for x in items)]
    theirs = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {i: theirs.encode(t, add_special_tokens=False).ids for i, t in rows}
    got = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in corpus_pipeline.run(spark, SF_SMALL).collect()}
    assert got == want and want


def test_stages_take_odd_rows(spark):
    """Nulls in every column, empty and very long texts, repeats and extra columns with clashing names."""
    good = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(60)
    odd = [(None, None, None, None, None), (1, None, None, "s", 0), (1, "", "en", None, 0), (1, "", "en", None, 0),
           (7, "word " * 200_000, "en", "s", 1_000_000), (None, "A plain line of text.", None, None, None)]
    docs = good.unionByName(spark.createDataFrame(odd, good.schema)).unionByName(good.limit(5))
    docs = docs.selectExpr("*", "0.5 AS quality_score", "'x' AS toxicity_score", "'y' AS leak_id", "1 AS kept_key", "'z' AS ids")
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, docs, SF_SMALL)
        if name != "tokens":
            assert got.columns == docs.columns, name
            assert got.exceptAll(docs).count() == 0, name
        else:
            assert got.count() == docs.count() and got.where("NOT round_trip").count() == 0
        if name in ("clean_of_benchmark", "near_duplicates"):  # of the texts without words the one with an id stays
            assert got.where("doc_id IS NULL").count() == (2 if name == "clean_of_benchmark" else 1), name
