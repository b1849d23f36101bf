"""The stages of `corpus_pipeline.py`: each takes (spark, docs, sf_dir) and
works on all rows of docs; all but the last return the columns of docs."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontamination, quality, simhash, toxicity
from .common import fresh, stored, table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is 0.5 or more. Without labels all stay.

    A null or empty text has the score of one passage without words; rows that
    repeat a text share its score, and all of them stay or go; a text of any length is
    scored whole in bounded memory; null ids and extra columns change nothing.
    """
    model = quality.train(docs, table(spark, sf_dir, "labels"), quality.learning_rows())
    score = fresh("quality_score", docs)
    return quality.score(docs, model, score_col=score).where(F.col(score) >= 0.5).drop(score)


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.5. Without labels all stay.

    A null or empty text has the score of a text without words; repeats, null
    ids, extra columns and very long texts are as in `good_quality`.
    """
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), toxicity.learning_rows())
    score = fresh("toxicity_score", docs)
    return toxicity.score(docs, model, score_col=score).where(F.col(score) < 0.5).drop(score)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest
    id, rows without an id last. Rows that repeat both its id and its text
    count as copies of it, and one of them stays."""
    found = stored(simhash.near_duplicates(docs, ngram=4, max_distance=4), "dedup")
    first = found.groupBy("group").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key")).alias("first"))
    of_first = found.groupBy("id", "key").agg(F.count("*").alias("n"))
    kept_id, kept_key = fresh("kept_id", docs), fresh("kept_key", docs)
    kept = stored(first.join(of_first, F.col("first.id").eqNullSafe(F.col("id")) & (F.col("first.key") == F.col("key")))
                  .select(F.col("id").alias(kept_id), F.col("key").alias(kept_key), "n"), "kept")
    key = F.xxhash64(F.coalesce("text", F.lit("")))

    def rows(chosen: DataFrame) -> DataFrame:
        return docs.join(chosen, F.col("doc_id").eqNullSafe(F.col(kept_id)) & (key == F.col(kept_key)), "left_semi")

    return rows(kept.where("n = 1")).unionByName(rows(kept.where("n > 1")).dropDuplicates(["doc_id", "text"]))


def clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, asked with other values or not."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, n_tokens, ids, round_trip): token ids as
    little-endian 32-bit integers, and whether they decode to the text.

    Every row has its row, repeated or without an id; a null or empty text has
    no tokens; a very long one is encoded whole, and its ids are its result.
    Extra columns are left out.
    """
    rows = docs.select("doc_id", "lang", "source", "text",
                       F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"))
    coded = bpe.round_trip(rows, public_tokenizers.path("byte_bpe_50k.json"))
    return coded.select("doc_id", "lang", "source", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids",
                        (F.crc32(F.col("decoded").cast("binary")) == F.col("text_crc32")).alias("round_trip"))


STAGES = [("good_quality", good_quality), ("not_toxic", not_toxic), ("near_duplicates", near_duplicates),
          ("clean_of_benchmark", clean_of_benchmark), ("tokens", tokens)]
