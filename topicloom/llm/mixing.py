"""Mixing sources to target weights: hash-random order, prefix sums, exact cuts.

Every row has a hash key; sorted by it, a source is in random order.  A source that
is to give ``e`` whole passes and ``rem`` words more takes, in the last pass, the rows
before the key at which the running sum of words reaches ``rem``, and a part of the
rows at that key.  The running sums are never taken over a whole source in one
place: sums per leading key bits say which range of keys holds the cut, the next
bits split that range, and only what is left is summed key by key.

Null and empty texts have size 0 and are taken 0 times; a null source is a source of
its own, ordered last; rows that agree in id and text have the same key and share a
cut evenly; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from topicloom.llm.common import WORD, apart
from topicloom.plans.bounds import materialize

KEY_BITS = 63
STEP_BITS = 12


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def order_key(doc_id: Column, text: Column, seed: int) -> Column:
    """A hash-random number from 0 to 2**63 - 1."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), doc_id, text), 1)


def source_key(source: Column) -> Column:
    """The source as a key that is never null, so that plain joins meet it."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit("null"))


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0
) -> DataFrame:
    """``(_s, source, source_size, target)`` from rows ``(_s, source, size)``.

    Weights repeat over the sources in code point order.  ``share`` of all words is
    dealt by weight; no source gets over ``most`` times its size, and what is cut off
    is dealt again.  With the sources ordered by limit over weight, a source is at its
    limit exactly if the level reached without it is no lower than that quotient.
    The windows run over one row per source.
    """
    per = sizes.groupBy("_s").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"))
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    table = F.array(*[F.lit(float(w)) for w in weights])
    per = per.withColumn("_w", table[(F.row_number().over(by_name) - 1) % len(weights)]).withColumn(
        "_cap", F.col("source_size") * F.lit(float(most))
    )
    everything = W.partitionBy()
    before = W.orderBy(F.col("_cap") / F.col("_w"), "_s").rowsBetween(W.unboundedPreceding, -1)
    per = per.withColumn("_total", F.sum("source_size").over(everything) * F.lit(float(share)))
    left = F.col("_total") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    weight_left = F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(before), F.lit(0.0))
    full = per.withColumn("_full", left * F.col("_w") >= F.col("_cap") * weight_left)
    level = (F.col("_total") - F.sum(F.when(F.col("_full"), F.col("_cap")).otherwise(0.0)).over(everything)) / F.nullif(
        F.sum(F.when(F.col("_full"), 0.0).otherwise(F.col("_w"))).over(everything), F.lit(0.0)
    )
    target = F.when(F.col("_full"), F.col("_cap")).otherwise(F.least(F.col("_cap"), F.col("_w") * level))
    return full.select("_s", "source", "source_size", target.alias("target"))


def _crossing(sums: DataFrame, by: str) -> DataFrame:
    """The row of each source at which the running sum over ``by`` reaches ``_rem``."""
    start = F.sum("_sum").over(W.partitionBy("_s").orderBy(by)) - F.col("_sum")
    return (
        sums.withColumn("_start", start)
        .filter((F.col("_start") < F.col("_rem")) & (F.col("_rem") <= F.col("_start") + F.col("_sum")))
        .select("_s", by, "_sum", "_start", (F.col("_rem") - F.col("_start")).alias("_rest"))
    )


def source_cuts(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """``(_s, source_size, target, _passes, _cut, _cut_sum, _cut_rest)``: what each source gives.

    ``sizes`` has ``(_s, _key, size)``.  Each step sums at most 2**12 ranges a source.
    """
    budget = F.round("target").cast("long")
    passes = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    plan = targets.withColumn("_passes", passes).withColumn(
        "_rem", budget - F.col("_passes") * F.col("source_size")
    )
    inside, rest = sizes, plan.filter("_rem > 0").select("_s", "_rem")
    for step in (1, 2):
        part = F.shiftright("_key", KEY_BITS - STEP_BITS * step)
        sums = inside.groupBy("_s", part.alias("_part")).agg(F.sum("size").alias("_sum"))
        found = _crossing(sums.join(rest, "_s"), "_part")
        inside = inside.withColumn("_part", part).join(found.select("_s", "_part"), ["_s", "_part"], "left_semi")
        rest = found.select("_s", F.col("_rest").alias("_rem"))
    last = inside.groupBy("_s", "_key").agg(F.sum("size").alias("_sum"))
    cut = _crossing(last.join(rest, "_s"), "_key").select(
        "_s", F.col("_key").alias("_cut"), F.col("_sum").alias("_cut_sum"), F.col("_rest").alias("_cut_rest")
    )
    return plan.select("_s", "source_size", "target", "_passes").join(cut, "_s", "left")


def words_taken() -> Column:
    """Words a row gives in all passes; needs ``size``, ``_key`` and the columns of its source's cut."""
    last = (
        F.when(F.col("_key") < F.col("_cut"), F.col("size"))
        .when(F.col("_key") == F.col("_cut"), F.floor(F.col("size") * F.col("_cut_rest") / F.col("_cut_sum")))
        .otherwise(0)
    )
    return (F.col("_passes") * F.col("size") + F.coalesce(last, F.lit(0))).cast("long")


def keyed(documents: DataFrame, seed: int = 7) -> DataFrame:
    """``(doc_id, source, _s, size, _key)`` of every row."""
    text = F.col("text")
    return documents.select(
        "doc_id",
        "source",
        source_key(F.col("source")).alias("_s"),
        word_count(text).alias("size"),
        order_key(F.col("doc_id"), text, seed).alias("_key"),
    )


def mix_sizes(documents: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0, seed: int = 7) -> DataFrame:
    """``(doc_id, size, source_size, target, taken)`` per row, from the numbers alone."""
    rows = materialize(keyed(documents, seed), "mix")
    cuts = source_cuts(rows, source_targets(rows, weights, share, most))
    return rows.join(cuts, "_s").select("doc_id", "size", "source_size", "target", words_taken().alias("taken"))


def mix_documents(documents: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0, seed: int = 7) -> DataFrame:
    """The mix itself, with the columns of ``documents``: a row per pass.

    The document at a source's cut gives its leading words only, so that the source
    meets its budget to the word.  ``n_chars`` is kept true where it exists; columns of
    any other name pass through as they are.
    """
    names = documents.columns
    documents = apart(documents, "doc_id", "text", "source", "n_chars")
    rows = materialize(keyed(documents, seed), "mix")
    cuts = materialize(source_cuts(rows, source_targets(rows, weights, share, most)), "mix-cuts")
    text = F.col("text")
    marked = (
        documents.withColumn("_s", source_key(F.col("source")))
        .withColumn("_key", order_key(F.col("doc_id"), text, seed))
        .join(cuts, "_s")
    )
    # Only the row at the cut needs its words counted and cut.
    at_cut = F.col("_key") == F.col("_cut")
    part = F.floor(word_count(text) * F.col("_cut_rest") / F.col("_cut_sum")).cast("int")
    lead = F.when(at_cut, part).when(F.col("_key") < F.col("_cut"), -1).otherwise(0)
    copies = F.col("_passes").cast("int") + F.when(F.coalesce(F.col("_lead"), F.lit(0)) != 0, 1).otherwise(0)
    pieces = F.split(text, r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
    is_part = (F.col("_copy") > F.col("_passes")) & (F.col("_lead") > 0)
    cut_text = F.array_join(F.slice(pieces, F.lit(1), F.col("_lead")), "")
    out = (
        marked.withColumn("_lead", lead)
        .withColumn("_copies", copies)
        .filter("_copies > 0")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
        .withColumn("text", F.when(is_part, cut_text).otherwise(text))
    )
    if "n_chars" in documents.columns:
        out = out.withColumn("n_chars", F.when(is_part, F.char_length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*documents.columns).toDF(*names)
