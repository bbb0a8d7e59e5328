"""One query per operator, with production parameters, over whole tables."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from topicloom.llm import (
    chat, common, language_id, lm, mixing, negatives, packing, quality, search, simhash, spelling, suffix_dedup, toxicity, warc,
)
from topicloom.llm.oracle import ORACLE  # noqa: F401
from topicloom.session import share_package

TOKENIZERS = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_simhash(spark, folder):
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", hexed.alias("fingerprint"), "component_id", "links")


def op2_chat(spark, folder):
    text = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(text).alias("text"),
    )
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").union(extra)
    return chat.read_back(chat.format_windows(turns, f"{TOKENIZERS}/byte_bpe_50k.json"))


def op3_suffix_dedup(spark, folder):
    found = suffix_dedup.dedup(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op4_toxicity(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels")
    fold = common.remainder(F.col("doc_id"), 5)
    model = toxicity.learn(documents, labels.filter(fold != 0).select("doc_id", "toxic"))
    scored = toxicity.score(documents, model)
    predicted = (F.col("score") >= 0.5).cast("int").alias("predicted")
    return scored.select("doc_id", (fold == 0).alias("held_out"), "score", predicted, "n_windows")


def op5_quality(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return quality.judge(documents, quality.learn(documents, table(spark, folder, "labels")))


def op6_search(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return search.top_k(documents.filter(F.col("doc_id") % 20 == 0), documents)


def op7_mixing(spark, folder):
    return mixing.mix_sizes(table(spark, folder, "documents"))


def op8_language_id(spark, folder):
    documents = table(spark, folder, "documents")
    fold = common.remainder(F.col("doc_id"), 4)
    model = language_id.learn(documents, fold != 2)
    found = language_id.identify(documents.select("doc_id", "text"), model)
    return found.select("doc_id", (fold == 2).alias("held_out"), "lang_pred", "score")


def op9_lm_scoring(spark, folder):
    return lm.score(table(spark, folder, "documents"), common.remainder(F.col("doc_id"), 5) == 1, order=3)


def op10_packing(spark, folder):
    return packing.pack(table(spark, folder, "documents"), f"{TOKENIZERS}/word_bpe_49k.json")


def op11_warc(spark, folder):
    found = warc.round_trip(table(spark, folder, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op12_spelling(spark, folder):
    return spelling.variants(table(spark, folder, "documents"))


def op13_negatives(spark, folder):
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = negatives.usable(table(spark, folder, "embeddings"), label=moved)
    return negatives.hard_negatives(rows, F.col("id") % 100 == 0)


def _ready(query: Callable) -> Callable:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        share_package(spark)
        return query(spark, folder)

    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: _ready(f)
    for f in (
        op1_simhash, op2_chat, op3_suffix_dedup, op4_toxicity, op5_quality, op6_search, op7_mixing, op8_language_id,
        op9_lm_scoring, op10_packing, op11_warc, op12_spelling, op13_negatives,
    )
}
