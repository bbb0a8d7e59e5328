"""From raw prompts to labelled prompts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window as W, functions as F

from topicloom.functions import fixed_values as fv, text as tx
from topicloom.operators import gates, language, quality, similarity as sim, terms
from topicloom.operators.similarity import LabelIndex
from topicloom.plans.bounds import broadcast_if_small, materialize

LABEL_COLUMNS = ["category_id", "category_name", "subcategory_id", "subcategory_name"]


def prepare(prompts: DataFrame, gate: bool = True) -> DataFrame:
    """Gate, cut to the first words and normalise."""
    kept = gates.garbage_gate(prompts) if gate else prompts
    return kept.withColumn("truncated_prompt", tx.truncate_words(F.col("raw_text"))).withColumn(
        "processed_text", tx.normalize(F.col("truncated_prompt"))
    )


def official_hits(
    prepared: DataFrame,
    index: LabelIndex,
    id_col: str = "prompt_id",
    threshold: float = fv.ROUTE_THRESHOLD,
    partitions: int | None = None,
    distinct_overlap: bool = False,
) -> DataFrame:
    """``(id, tax_idx, score)`` of the texts whose best label reaches the threshold."""
    pairs = sim.masked_similarity(
        prepared, index, id_col, partitions=partitions, distinct_overlap=distinct_overlap
    )
    return sim.best_label(pairs, id_col).filter(F.col("score") >= threshold)


def with_labels(hits: DataFrame, labels: DataFrame) -> DataFrame:
    """Look the label columns up by row index."""
    return hits.join(broadcast_if_small(labels.select("tax_idx", *LABEL_COLUMNS)), "tax_idx", "left")


def assign_other(labelled: DataFrame, labels: DataFrame) -> DataFrame:
    """Fill rows without a label with the Other label, one above the highest category id."""
    other_id = labels.agg((F.max("category_id") + 1).alias("id")).scalar()
    return (
        labelled.withColumn("category_id", F.coalesce("category_id", other_id))
        .withColumn("category_name", F.coalesce("category_name", F.lit(fv.OTHER_CATEGORY)))
        .withColumn("subcategory_id", F.coalesce("subcategory_id", F.lit(fv.OTHER_SUBCATEGORY_ID)))
        .withColumn(
            "subcategory_name", F.coalesce("subcategory_name", F.lit(fv.OTHER_SUBCATEGORY))
        )
    )


def route(
    prepared: DataFrame,
    index: LabelIndex,
    rescued: DataFrame | None = None,
    id_col: str = "prompt_id",
    hits: DataFrame | None = None,
    **options,
) -> DataFrame:
    """Every prepared prompt with its label, ``route`` and ``score``.

    ``rescued`` holds ``(id, tax_idx)`` that a model found for texts without a hit,
    ``hits`` the official hits where they are known already.
    """
    if hits is None:
        hits = official_hits(prepared, index, id_col, **options)
    hits = hits.withColumn("route", F.lit("official"))
    if rescued is not None:
        hits = hits.unionByName(
            rescued.select(id_col, "tax_idx", F.lit("rescued").alias("route")),
            allowMissingColumns=True,
        )
    labelled = with_labels(prepared.join(hits, id_col, "left"), index.labels)
    return assign_other(labelled, index.labels).withColumn(
        "route", F.coalesce("route", F.lit("other"))
    )


def route_english(
    prompts: DataFrame,
    profiles: DataFrame,
    index: LabelIndex,
    id_col: str = "prompt_id",
    rescue_rows: Callable[[DataFrame, DataFrame], DataFrame] | None = None,
    **options,
) -> DataFrame:
    """The whole run: language, gate, routing and, on request, rescue.

    The English prompts that pass the gate are written once between language and
    label routing, as several later steps read them; what follows from their text
    alone is cheaper to compute again than to store.  ``rescue_rows`` takes the
    prepared prompts and the hits and returns ``(id, tax_idx)`` for texts without a hit.
    """
    english, _ = language.split_english(language.route_languages(prompts, profiles, id_col))
    prepared = prepare(materialize(gates.garbage_gate(english), "english"), gate=False)
    hits = rescued = None
    if rescue_rows is not None:
        hits = materialize(official_hits(prepared, index, id_col, **options), "hits")
        rescued = rescue_rows(prepared, hits)
    return route(prepared, index, rescued, id_col, hits, **options)


def label_mapping(routed: DataFrame, labels: DataFrame) -> DataFrame:
    """The label table, plus the Other row when any prompt ended there."""
    other = (
        routed.filter(F.col("subcategory_id") == fv.OTHER_SUBCATEGORY_ID)
        .filter(F.col("category_name") == fv.OTHER_CATEGORY)
        .select(*LABEL_COLUMNS)
        .distinct()
    )
    return labels.select(*LABEL_COLUMNS).unionByName(other)


def route_summary(routed: DataFrame) -> DataFrame:
    """Counts and shares by route in one row."""
    hit = F.col("route") != "other"
    return routed.agg(
        F.count("*").alias("n_prompts"),
        F.count_if(hit).alias("n_routed"),
        F.count_if(~hit).alias("n_other"),
        F.round(F.avg(hit.cast("double")) * 100, 6).alias("pct_routed"),
        F.round(F.avg((~hit).cast("double")) * 100, 6).alias("pct_other"),
    )


def centroid_hits(
    prepared: DataFrame,
    index: LabelIndex,
    id_col: str = "prompt_id",
    confident: float = 0.15,
    max_terms: int = fv.RESCUE_FEATURES,
) -> DataFrame:
    """``(id, tax_idx, score)`` for texts without a hit, against the centroids of confident hits.

    A label's centroid is the mean of the word vectors of the texts that reached
    ``confident``.  Centroids have at most ``max_terms`` rows per label.
    """
    prepared = prepared.select(id_col, "processed_text")
    hits = materialize(official_hits(prepared, index, id_col), "hits")
    space = {"word": terms.Words(2, tuple(index.stopwords))}
    weights = terms.held_tfidf(prepared, id_col, "processed_text", space, True, max_terms).drop("space")
    sure = hits.filter(F.col("score") >= confident).select(id_col, "tax_idx")
    centroids = quality.centroids(weights, sure, "tax_idx", id_col)
    length = F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(W.partitionBy("tax_idx")))
    side = broadcast_if_small(centroids.select("tax_idx", "term", (F.col("weight") / length).alias("_c")))
    pairs = (
        weights.join(hits, id_col, "left_anti")
        .join(side, "term")
        .groupBy(id_col, "tax_idx")
        .agg(F.sum(F.col("weight") * F.col("_c")).alias("sim"))
    )
    return sim.best_label(pairs, id_col)
