"""Predicates that keep junk out of the router."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from topicloom.functions import fixed_values as fv, text as tx


def has_signature(text: Column) -> Column:
    """Any junk signature as a substring of the lower-case text."""
    return tx.contains_any(F.lower(text), fv.GARBAGE_SIGNATURES)


def has_mojibake(text: Column) -> Column:
    """Any listed character in the lower-case text (listed capitals never match there)."""
    return F.lower(text).rlike("[" + "".join(fv.MOJIBAKE_CHARS) + "]")


def has_garbage_word(text: Column) -> Column:
    """Any listed word between non-word characters: one scan, no list of the text's words."""
    words = "|".join(re.escape(w) for w in dict.fromkeys(fv.GARBAGE_WORDS))
    return F.lower(text).rlike(f"{tx.NOT_AFTER_WORD}(?:{words}){tx.NOT_BEFORE_WORD}")


def has_many_non_ascii(text: Column) -> Column:
    return tx.non_ascii_count(text) > fv.MAX_NON_ASCII


def drop_reason(text: Column) -> Column:
    """Name of the first rule a text breaks, null when it passes them all."""
    return (
        F.when(has_signature(text), "signature")
        .when(has_mojibake(text), "mojibake")
        .when(has_garbage_word(text), "garbage_word")
        .when(has_many_non_ascii(text), "non_ascii")
    )


def garbage_gate(prompts: DataFrame, text_col: str = "raw_text") -> DataFrame:
    return prompts.filter(drop_reason(F.col(text_col)).isNull())


def reason_counts(prompts: DataFrame, text_col: str = "raw_text") -> DataFrame:
    return (
        prompts.select(F.coalesce(drop_reason(F.col(text_col)), F.lit("kept")).alias("drop_reason"))
        .groupBy("drop_reason")
        .agg(F.count("*").alias("n"))
    )


def unicode_gate(text: Column) -> Column:
    """True for texts that are overwhelmingly in a non-Latin script."""
    return has_many_non_ascii(text) & (tx.non_ascii_ratio(text) > fv.MAX_NON_ASCII_RATIO)


def tech_rescue(text: Column, language: Column) -> Column:
    """Short texts with a technical word count as English, whatever was detected."""
    has_tech_word = F.arrays_overlap(
        tx.latin_word_set(text), F.array(*[F.lit(w) for w in fv.TECH_WORDS])
    )
    rescued = (
        (language != "en")
        & (language != fv.UNKNOWN_LANGUAGE)
        & (F.length(text) < fv.RESCUE_MAX_CHARS)
        & has_tech_word
    )
    return F.when(rescued, "en").otherwise(language)
