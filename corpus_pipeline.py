"""From raw documents to packed token sequences, in five stages.

Each stage is a function of the session, the documents its predecessor kept and the input
folder.  Its result is written as Parquet to the shared folder and read again as the
documents of the next one.

Null ids: in the near-duplicate stage a row without an id stays only if all of its group have none.
Rows with one id and different texts are documents of their own; of rows that agree in id and
text one stays.  An empty table passes all stages.  Extra columns of any
name pass all stages but the last.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from topicloom.llm import language_id, mixing, packing, simhash, suffix_dedup
from topicloom.llm.common import apart
from topicloom.llm.queries import TOKENIZERS, table
from topicloom.plans.bounds import materialize
from topicloom.session import share_package

#: A text in no learned language is rejected, and one whose best language has less than this score.
MIN_LANGUAGE_SCORE = 0.2


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language."""
    model = language_id.learn(docs, F.lit(True))
    if model is None:
        return docs
    own = apart(docs, "text")
    known = (F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= MIN_LANGUAGE_SCORE)
    return language_id.identify(own, model).filter(known).select(*own.columns).toDF(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first row, by id and then by a hash of id and text, of each group of SimHash near-duplicates.

    The operator runs with its own four words and four bits.  It gets a hash of id and text as the
    row's id, so that rows with one id and different texts are told apart; only hashes and ids meet its groups.
    """
    own = apart(docs, "doc_id", "text").withColumn("_key", F.xxhash64("doc_id", "text"))
    groups = simhash.near_duplicates(own.select(F.col("_key").alias("doc_id"), "text")).select(F.col("doc_id").alias("_key"), "component_id")
    ids = own.select("_key", F.struct(F.col("doc_id").isNull(), "doc_id", "_key").alias("place"))
    first = groups.distinct().join(ids.distinct(), "_key").groupBy("component_id").agg(F.min("place").alias("place"))
    kept = own.join(first.select("place._key"), "_key", "left_semi")
    once = kept.withColumn("_n", F.row_number().over(W.partitionBy("_key").orderBy("_key"))).filter("_n = 1")
    return once.drop("_key", "_n").toDF(*docs.columns)


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents rid of passages that occur earlier."""
    own = apart(docs, "doc_id", "text", "n_chars")
    out = suffix_dedup.dedup(own).select(*own.columns).toDF(*docs.columns)
    return out.withColumn("n_chars", F.char_length("text").cast(dict(docs.dtypes)["n_chars"])) if "n_chars" in docs.columns else out


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources in their target shares; a document is there once per pass."""
    return mixing.mix_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 2048 tokens."""
    return packing.pack(docs, f"{TOKENIZERS}/word_bpe_49k.json")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("near_dedup", near_dedup),
    ("passage_dedup", passage_dedup),
    ("mix", mix),
    ("pack", pack),
]

#: SQL can express neither fingerprints nor suffix arrays; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    share_package(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
