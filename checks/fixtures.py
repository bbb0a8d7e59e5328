"""Input views that both engines derive from the given tables in the same way."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from topicloom.functions import text as tx
from topicloom.sources.files import spread_if_few

FIRST_DAY = "2026-06-15"

CURATION_NAMES = [
    "Java Python C++", "Sql Row Errors", "Growth Budget", "Email Draft And", "error triage stacktrace",
    "memory_leak CPU", "Big Data Hadoop", "CI/CD jenkins Pipeline", "Human Resources", "Talent hr",
    "Project Management", "don't Know Of", "Amex card offers", "Data Analytics bigquery",
    "Script Execution Run", "Excel Chart plot", "Auth Risk Data Analytics", "Frontend Development Practices",
    "Quarterly Outlook", "Knowledge of the", "Cloud Infrastructure", "Budget Revenue Profit",
    "Code Changes Required", "Email Business Communications",
]
CURATION_CATEGORIES = [
    "Software Engineering & Development", "Banking & Finance Operations", "People & Culture",
    "Data & Analytics", "The Office of the Day", "Security and Risk", "Sales, Marketing", "Support",
]
RENAMES = {
    "Java Python C++": "Core Programming Languages",
    "Growth Budget": "Budget Planning",
    "Amex card offers": "Card Offers",
    "Talent hr": "Talent Services",
    "Big Data Hadoop": "Big Data Processing",
}
TERM_DICTIONARY = {
    "der": "the", "die": "the", "und": "and", "nicht": "not", "le": "the", "la": "the", "les": "the",
    "que": "that", "pour": "for", "dans": "in", "de": "of", "el": "the", "los": "the", "por": "for",
    "de la": "of the", "que la": "that the", "in die": "into the",
}


def tables(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    return [spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in names]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread_if_few(tables(spark, sf_dir, "documents")[0], "doc_id")


def prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of every document as one prompt, decorated so that all rules bite."""
    lines = (
        documents(spark, sf_dir)
        .select("doc_id", "lang", F.posexplode(F.split("text", "\n")).alias("pos", "v"))
        .select("doc_id", "lang", "pos", F.trim("v").alias("line"))
        .filter("line <> ''")
    )
    line, kind = F.col("line"), (F.col("doc_id") + F.col("pos")) % 8
    decorated = (
        F.when(kind == 0, F.concat(F.lit("Please advise "), line))
        .when(kind == 1, F.concat(line, F.lit(" thanks in advance")))
        .when(kind == 2, F.concat(line, F.lit(" costs $1,250.00 USD")))
        .when(kind == 3, F.concat(F.lit("sql error in table users "), line))
        .when(kind == 4, F.concat(line, F.lit(" 100 items ref 2024")))
        .when(kind == 5, F.concat(line, F.lit(" triggerdagrunoperator")))
        .when(kind == 6, F.concat(line, F.lit(" jersey bars")))
        .otherwise(line)
    )
    return lines.select(
        (F.col("doc_id") * 10000 + F.col("pos")).alias("prompt_id"),
        "lang",
        F.date_add(F.lit(FIRST_DAY).cast("date"), (F.col("doc_id") % 7).cast("int")).alias("date"),
        decorated.alias("raw_text"),
    )


def taxonomy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A two-level label table from the benchmark passages."""
    (benchmark,) = tables(spark, sf_dir, "benchmark")
    words = F.sort_array(F.array_distinct(tx.find_all(F.lower("text"), "[a-z]{4,}")))
    item, category = F.col("item_id").cast("int"), (F.col("item_id") % 8).cast("int")
    return benchmark.select(
        item.alias("tax_idx"),
        category.alias("category_id"),
        F.concat(F.lit("Category "), category).alias("category_name"),
        item.alias("subcategory_id"),
        F.concat(F.lit("Topic "), item).alias("subcategory_name"),
        F.array_join(words, " ").alias("keywords"),
    )


def curation_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A label table with one row per document, named so that the curation rules bite."""
    doc = F.col("doc_id")

    def pick(values: list[str]):
        return F.get(
            F.array(*[F.lit(v) for v in values]), (doc % len(values)).cast("int")
        )

    words = F.sort_array(F.array_distinct(tx.find_all(F.col("text"), "[A-Za-z]{3,}")))
    name = pick(CURATION_NAMES)
    return documents(spark, sf_dir).select(
        doc.cast("int").alias("tax_idx"),
        (doc % 8).cast("int").alias("category_id"),
        pick(CURATION_CATEGORIES).alias("category_name"),
        doc.cast("int").alias("subcategory_id"),
        F.when(doc % 3 == 0, name)
        .otherwise(F.concat(name, F.lit(" "), F.col("source")))
        .alias("subcategory_name"),
        F.when(doc % 5 != 0, F.array_join(words, " ")).alias("keywords"),
    )


def dated_inbox(rows: DataFrame, path: str) -> None:
    """One text file per day, with the date in its name as the collector writes it."""
    (
        rows.select(F.col("date").cast("string").alias("day"), "raw_text")
        .repartition("day")
        .write.partitionBy("day")
        .text(path)
    )
