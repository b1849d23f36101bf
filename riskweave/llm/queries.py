"""The operators' registered queries, with production parameters over whole
tables, and DuckDB SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, conversations, decontamination, extraction, langid, licenses, quality, sharding, simhash, topk, toxicity,
               urls, whitening)
from .common import table


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)
    return found.select("query_id", "rank", "vec_id", "score")


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op3_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extraction.main_texts(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sharding.shards(table(spark, sf_dir, "documents"), 24)
    return found.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                        F.lit(None).cast("int").alias("grown_shard"), "dim_lang", "dim_source", "dim_size", "curve")


def _scored(scored: DataFrame, learning: Column) -> DataFrame:
    return scored.select("doc_id", (~learning).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    learning = toxicity.learning_rows()
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), learning)
    return _scored(toxicity.score(docs, model), learning)


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_windows", "n_matched", "share", "reparameterised")


def op7_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages").select("page_id", "url"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return coded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), ngram=4, max_distance=4)
    return found.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                        "component_id")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    learning = quality.learning_rows()
    model = quality.train(docs, table(spark, sf_dir, "labels"), learning)
    return _scored(quality.score(docs, model), learning)


def op11_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    learning = langid.learning_rows()
    model = langid.train(docs, learning)
    found = langid.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", (~learning).alias("held_out"), "lang_pred", "score", "accepted")


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return conversations.audit(conversations.damaged(rows), rows)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES = {"op1_topk": op1_topk, "op2_licenses": op2_licenses, "op3_extraction": op3_extraction,
           "op4_sharding": op4_sharding, "op5_toxicity": op5_toxicity, "op6_decontamination": op6_decontamination, "op7_urls": op7_urls,
           "op8_bpe": op8_bpe, "op9_simhash": op9_simhash,
           "op10_quality": op10_quality, "op11_language": op11_language, "op12_conversations": op12_conversations,
           "op13_whitening": op13_whitening}

ORACLE = {"op1_topk": topk.oracle(), "op2_licenses": licenses.oracle()}
