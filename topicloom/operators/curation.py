"""Jobs that clean, rename, enrich and consolidate a label table.

Every job takes a label table and returns one; rules and mappings come as
parameters with the fixed values as defaults.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from topicloom.functions import fixed_values as fv, text as tx
from topicloom.operators import terms
from topicloom.plans.bounds import broadcast_if_small, materialize

Rules = list[tuple[list[str], str]]


def _lookup(table: dict[str, str], key: Column) -> Column:
    """A literal map for tables of a few dozen entries; longer ones are joined."""
    entries = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.try_element_at(entries, key)


def _keywords() -> Column:
    return F.coalesce("keywords", F.lit(""))


#: Chinese characters, Japanese syllables and Thai: written without blanks between words.
UNSPACED = re.compile("[\u0e00-\u0e7f\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff]")


def first_rule(name: Column, rules: Rules, default: str) -> Column:
    """Suffix of the first rule with a substring in the lower-case name."""
    lowered = F.lower(name)
    cases = [(tx.contains_any(lowered, words), suffix) for words, suffix in rules]
    return reduce(lambda w, c: w.when(c[0], c[1]), cases[1:], F.when(*cases[0])).otherwise(default)


# --- names ------------------------------------------------------------------


def rename_with_suffix(labels: DataFrame) -> DataFrame:
    """Append a telling suffix to names of fewer than five words."""
    name = tx.strip(F.col("subcategory_name"))
    suffix = first_rule(name, fv.LONG_SUFFIX_RULES, fv.LONG_SUFFIX_DEFAULT)
    short = F.size(tx.split_words(name)) < fv.LONG_SUFFIX_MIN_WORDS
    return labels.withColumn(
        "subcategory_name", F.when(short, F.concat_ws(" ", name, suffix)).otherwise(name)
    )


def smart_rename(labels: DataFrame) -> DataFrame:
    """The first three distinct words in title case and a short suffix."""
    name = tx.title_case(F.translate(tx.strip(F.col("subcategory_name")), "_", " "))
    core = F.array_join(F.slice(F.array_distinct(tx.split_words(name)), 1, 3), " ")
    suffix = first_rule(name, fv.SHORT_SUFFIX_RULES, fv.SHORT_SUFFIX_DEFAULT)
    return labels.withColumn("subcategory_name", tx.strip(F.concat_ws(" ", core, suffix)))


def cluster_name(words: Column) -> Column:
    """Name of a discovered cluster from its words, strongest first."""
    core = F.array_join(F.transform(F.slice(words, 1, 3), tx.title_case), " ")
    suffix = first_rule(F.array_join(words, " "), fv.CLUSTER_SUFFIX_RULES, fv.SHORT_SUFFIX_DEFAULT)
    return F.concat(F.lit(fv.CLUSTER_PREFIX), F.concat_ws(" ", core, suffix))


def strip_suffix(labels: DataFrame, suffixes: list[str] = fv.SHORT_SUFFIXES) -> DataFrame:
    """Take one known suffix off the end of a name."""
    pattern = f" (?:{'|'.join(suffixes)})$"
    return labels.withColumn(
        "subcategory_name", tx.strip(F.regexp_replace("subcategory_name", pattern, ""))
    )


def rename_by_map(labels: DataFrame, renames: DataFrame) -> DataFrame:
    """``renames`` holds ``(name, new_name)``; other names lose a trailing small word."""
    trailing = rf"(?iU)\s+(?:{'|'.join(fv.TRAILING_WORDS)})\s*$"
    cleaned = tx.title_case(F.regexp_replace("subcategory_name", trailing, ""))
    mapping = broadcast_if_small(
        renames.select(F.col("name").alias("subcategory_name"), F.col("new_name").alias("_new"))
    )
    return (
        labels.join(mapping, "subcategory_name", "left")
        .withColumn("subcategory_name", F.coalesce("_new", cleaned))
        .select(*labels.columns)
    )


def display_names(labels: DataFrame, is_core: Column) -> DataFrame:
    """Where labels come without keywords: the name becomes the keywords, core rows get short names."""
    short = F.array_join(F.slice(tx.split_words(F.col("subcategory_name")), 1, 3), " ")
    return labels.withColumn("keywords", F.col("subcategory_name")).withColumn(
        "subcategory_name", F.when(is_core, short).otherwise(F.col("subcategory_name"))
    )


# --- keywords -----------------------------------------------------------------


def patch_keywords(labels: DataFrame) -> DataFrame:
    """Append the words of the first rule whose substrings are all in the name."""
    lowered = F.lower("subcategory_name")
    cases = [
        (tx.contains_all(lowered, parts), F.concat(_keywords(), F.lit(" " + words)))
        for parts, words in fv.PATCH_RULES
    ]
    patched = reduce(lambda w, c: w.when(*c), cases[1:], F.when(*cases[0])).otherwise(_keywords())
    return labels.withColumn("keywords", patched)


def dedupe_keywords(labels: DataFrame) -> DataFrame:
    return labels.withColumn("keywords", tx.distinct_words(F.lower(_keywords())))


def rebuild_keywords(labels: DataFrame) -> DataFrame:
    """Keywords from the words of both names, the category's first."""

    def words(column: str) -> Column:
        return tx.without_words(tx.letter_words(F.col(column)), fv.NAME_STOPWORDS)

    both = F.concat(words("category_name"), words("subcategory_name"))
    return labels.withColumn("keywords", F.array_join(F.array_distinct(both), " "))


def _long_words(text: Column) -> Column:
    letters = F.regexp_replace(F.lower(text), r"(?U)[^a-z\s]", "")
    return F.filter(
        tx.without_words(tx.split_words(letters), fv.ENGLISH_STOPWORDS), lambda w: F.length(w) > 2
    )


def rebuild_keywords_from_names(
    labels: DataFrame,
    name_fixes: dict[str, str] = fv.NAME_FIXES,
    injections: dict[str, str] = fv.NAME_INJECTIONS,
) -> DataFrame:
    """Fix names, drop the category's words from the keywords, add the name's own.

    Injected words come last and are not made distinct.
    """
    name = tx.strip(F.col("subcategory_name"))
    fixed = labels.withColumn(
        "subcategory_name", F.coalesce(_lookup(name_fixes, name), tx.title_case(name))
    )
    own = tx.let(
        _long_words(F.col("category_name")),
        lambda parents: F.filter(
            tx.split_words(F.lower(_keywords())), lambda w: ~F.array_contains(parents, w)
        ),
    )
    rebuilt = F.array_join(
        F.array_distinct(F.concat(own, _long_words(F.col("subcategory_name")))), " "
    )
    injected = _lookup(injections, F.col("subcategory_name"))
    return fixed.withColumn(
        "keywords",
        F.when(injected.isNotNull(), F.concat(rebuilt, F.lit(" "), injected)).otherwise(rebuilt),
    )


def inject_keywords(
    labels: DataFrame, injections: dict[str, str] = fv.TECH_INJECTIONS
) -> DataFrame:
    """Add curated words by exact name, ordered distinct."""
    extra = _lookup(injections, F.col("subcategory_name"))
    merged = tx.distinct_words(F.concat_ws(" ", _keywords(), extra))
    return labels.withColumn(
        "keywords", F.when(extra.isNotNull(), merged).otherwise(_keywords())
    )


def merge_keywords(old: Column, new: Column) -> Column:
    """Sorted union of the words of two texts."""
    return F.array_join(F.sort_array(F.array_union(tx.split_words(old), tx.split_words(new))), " ")


def enrich_by_category(labels: DataFrame, enrichment: DataFrame) -> DataFrame:
    """``enrichment`` holds ``(category_id, words)``; known categories get their words appended."""
    return (
        labels.join(broadcast_if_small(enrichment), "category_id", "left")
        .withColumn("enriched_desc", F.concat_ws(" ", "processed_desc", "words"))
        .drop("words")
    )


def translate_terms(texts: DataFrame, dictionary: dict[str, str], text_col: str) -> DataFrame:
    """Add ``translated``: words and phrases found in a small dictionary in English.

    Longer phrases go first; a word is replaced only as a whole.  A key that is not one
    run of word characters (``d'entreprise``) counts as a phrase.  Scripts without blanks
    have no whole words: their keys are replaced wherever they stand.
    """
    one_word = re.compile(r"\w+")
    words = {k: v for k, v in dictionary.items() if one_word.fullmatch(k) and not UNSPACED.search(k)}
    phrases = sorted((p for p in dictionary if p and p not in words), key=lambda p: (-len(p), p))
    text = F.lower(text_col)
    for phrase in phrases:
        quoted = re.sub(r"([^\w\s])", r"\\\1", phrase)
        if not UNSPACED.search(phrase):
            quoted = rf"{tx.NOT_AFTER_WORD}{quoted}{tx.NOT_BEFORE_WORD}"
        text = F.regexp_replace(text, quoted, re.sub(r"([\\$])", r"\\\1", dictionary[phrase]))
    pieces = tx.find_all(text, rf"[{tx.WORD}]+|[^{tx.WORD}]+")
    # most words are in no dictionary, which one hash lookup tells
    translated = F.transform(
        pieces, lambda p: F.when(p.isin(list(words)), _lookup(words, p)).otherwise(p)
    )
    return texts.withColumn("translated", F.array_join(translated, ""))


# --- consolidation --------------------------------------------------------------


def label_weights(labels: DataFrame) -> DataFrame:
    """``(tax_idx, category_name, term, df, weight)``: plain TF-IDF fitted inside each category."""
    sizes = labels.groupBy("category_name").agg(F.count("*").alias("_n"))
    counts = labels.select(
        "tax_idx",
        "category_name",
        F.explode(
            tx.term_counts(terms.word_terms(F.coalesce("keywords", F.lit("")), 1))
        ).alias("_t"),
    ).select("tax_idx", "category_name", F.col("_t.term").alias("term"), F.col("_t.tf").alias("tf"))
    df = counts.groupBy("category_name", "term").agg(F.count("*").alias("df"))
    idf = F.log((1.0 + F.col("_n")) / (1.0 + F.col("df"))) + 1.0
    raw = (
        counts.join(df, ["category_name", "term"])
        .join(sizes, "category_name")
        .withColumn("_w", F.col("tf") * idf)
    )
    norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(W.partitionBy("tax_idx")))
    return raw.withColumn("weight", F.col("_w") / norm).select(
        "tax_idx", "category_name", "term", "df", "weight"
    )


def similar_labels(weights: DataFrame, threshold: float) -> DataFrame:
    """``(category_name, a, b, sim)`` with a < b and sim >= ``threshold`` > 0, inside each category.

    With the terms of a label ordered from rare to common, a pair at or above the
    threshold shares a term from where on either vector is still that long.  Only
    those leading terms are joined, so the terms all labels share make no pairs.
    """
    rest = W.partitionBy("tax_idx").orderBy(F.desc("df"), F.desc("term"))
    squared = F.sum(F.col("weight") * F.col("weight")).over(
        rest.rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    leading = weights.withColumn("_rest", squared).filter(
        F.col("_rest") >= (threshold - 1e-9) ** 2
    ).select("category_name", "term", "tax_idx")
    pairs = (
        leading.withColumnRenamed("tax_idx", "a")
        .join(leading.withColumnRenamed("tax_idx", "b"), ["category_name", "term"])
        .filter("a < b")
        .select("category_name", "a", "b")
        .distinct()
    )
    left = weights.select(F.col("tax_idx").alias("a"), "term", F.col("weight").alias("_wa"))
    right = weights.select(F.col("tax_idx").alias("b"), "term", F.col("weight").alias("_wb"))
    return (
        pairs.join(left, "a")
        .join(right, ["b", "term"])
        .groupBy("category_name", "a", "b")
        .agg(F.sum(F.col("_wa") * F.col("_wb")).alias("sim"))
        .filter(F.round("sim", 9) >= threshold)
    )


def _apply_merges(labels: DataFrame, merges: DataFrame) -> DataFrame:
    """``merges`` holds ``(gone, kept)``: the kept row gets the sorted union of all keywords."""
    target = labels.join(
        merges.withColumnRenamed("gone", "tax_idx"), "tax_idx", "left"
    ).withColumn("_kept", F.coalesce("kept", "tax_idx"))
    words = (
        target.select("_kept", F.explode(tx.split_words(_keywords())).alias("_w"))
        .distinct()
        .groupBy("_kept")
        .agg(F.array_join(F.array_sort(F.collect_list("_w")), " ").alias("_words"))
    )
    grown = merges.select(F.col("kept").alias("tax_idx")).distinct().withColumn("_grown", F.lit(True))
    return (
        target.filter(F.col("kept").isNull())
        .join(grown, "tax_idx", "left")
        .join(words.withColumnRenamed("_kept", "tax_idx"), "tax_idx", "left")
        .withColumn(
            "keywords",
            F.when(F.col("_grown"), F.coalesce("_words", F.lit(""))).otherwise(F.col("keywords")),
        )
        .select(*labels.columns)
    )


def next_merges(labels: DataFrame, pairs: DataFrame, limit: int | None, anchor: float) -> DataFrame:
    """``(category_name, gone, kept, name)``: the next merge of every category that has one.

    First comes the first core row, in table order, with a non-core row above ``anchor``, and the first such row.
    A category without one and with more than ``limit`` rows merges its most similar pair, the
    first in table order at ties, but never two core rows; where no allowed pair shares a word, its first pair.
    A core row keeps its name, of two others the name with fewer words stays.
    """
    row = F.struct("tax_idx", "is_core", "subcategory_name")
    a, b = (labels.select(F.col("tax_idx").alias(c), row.alias(f"_{c}")) for c in "ab")
    sim = F.round("sim", 9)
    sizes = labels.groupBy("category_name").agg(
        F.count("*").alias("_n"), F.sort_array(F.collect_list(row)).alias("_rows")
    )
    met = pairs.join(a, "a").join(b, "b").join(sizes.select("category_name", "_n"), "category_name")
    core = [F.col("_a.is_core"), F.col("_b.is_core")]
    # In order of kind, of falling similarity where that decides, and of the table.
    to_core = met.filter((core[0] != core[1]) & (sim > anchor)).select(
        "category_name", F.lit(0).alias("kind"), F.lit(0.0).alias("s"), F.when(core[0], F.col("_a")).otherwise(F.col("_b")).alias("x"),
        F.when(core[0], F.col("_b")).otherwise(F.col("_a")).alias("y"),
    )
    found = to_core
    if limit is not None:
        closest = met.filter(~(core[0] & core[1]) & (F.col("_n") > limit)).select(
            "category_name", F.lit(1).alias("kind"), (-sim).alias("s"), F.col("_a").alias("x"), F.col("_b").alias("y")
        )
        first, others = F.get("_rows", F.lit(0)), F.slice("_rows", 2, F.size("_rows"))
        partner = F.get(F.filter(others, lambda r: ~(first.is_core & r.is_core)), F.lit(0))
        has_words = categories_with_words(labels)
        strangers = sizes.filter((F.col("_n") > limit)).join(has_words, "category_name", "left_semi").select(
            "category_name", F.lit(2).alias("kind"), F.lit(0.0).alias("s"), first.alias("x"), partner.alias("y")
        ).filter("y is not null")
        found = to_core.unionByName(closest).unionByName(strangers)
    best = found.groupBy("category_name").agg(F.min(F.struct("kind", "s", "x", "y")).alias("_m")).select(
        "category_name", F.col("_m.x").alias("x"), F.col("_m.y").alias("y")
    )
    swap = F.col("y.is_core")
    words = [F.size(tx.split_words(F.col(f"{c}.subcategory_name"))) for c in "xy"]
    shorter = ~F.col("x.is_core") & (words[1] < words[0])
    return best.select(
        "category_name",
        F.when(swap, F.col("x.tax_idx")).otherwise(F.col("y.tax_idx")).alias("gone"),
        F.when(swap, F.col("y.tax_idx")).otherwise(F.col("x.tax_idx")).alias("kept"),
        F.when(swap | shorter, F.col("y.subcategory_name")).otherwise(F.col("x.subcategory_name")).alias("name"),
    )


def mergeable_pairs(labels: DataFrame, weights: DataFrame, limit: int) -> DataFrame:
    """``(category_name, a, b, sim)`` with a < b of the pairs that share a term and may merge.

    Those are core and other rows, and in categories above the limit also two others.
    """
    sizes = labels.groupBy("category_name").agg((F.count("*") > limit).alias("_crowded"))
    side = weights.join(labels.select("tax_idx", "is_core"), "tax_idx").join(sizes, "category_name")
    a, b = (
        side.select("category_name", "term", "_crowded", *[F.col(c).alias(f"{c}_{k}") for c in ("tax_idx", "is_core", "weight")])
        for k in "ab"
    )
    may = (F.col("is_core_a") != F.col("is_core_b")) | (F.col("_crowded") & ~F.col("is_core_a"))
    met = a.join(b.drop("_crowded"), ["category_name", "term"]).filter((F.col("tax_idx_a") < F.col("tax_idx_b")) & may)
    return met.groupBy("category_name", F.col("tax_idx_a").alias("a"), F.col("tax_idx_b").alias("b")).agg(
        F.sum(F.col("weight_a") * F.col("weight_b")).alias("sim")
    )


def categories_with_words(labels: DataFrame) -> DataFrame:
    """The categories with at least one term in their keywords; the others have nothing to compare by."""
    found = F.size(terms.word_terms(F.coalesce("keywords", F.lit("")), 1)) > 0
    return labels.filter(found).select("category_name").distinct()


def consolidate(
    labels: DataFrame,
    limit: int | None = fv.MAX_LABELS_PER_CATEGORY,
    anchor: float = fv.ANCHOR_SIMILARITY,
) -> DataFrame:
    """Merge labels until no non-core row is close to a core row and no category is above the limit.

    All categories take one merge a round, side by side, and weigh their terms anew after it, as each merge
    changes what is close.  Only categories that merged go into the next round.  Core rows never merge with
    each other, so a category keeps all of them even above the limit.  Without a ``limit`` rows merge into core rows only.
    """
    active, done = materialize(labels, "labels"), []
    while True:
        weights = materialize(label_weights(active), "label-weights")
        pairs = similar_labels(weights, anchor) if limit is None else mergeable_pairs(active, weights, limit)
        merges = materialize(next_merges(active, pairs, limit, anchor), "merges")
        rest = active.join(merges, "category_name", "left_anti").select(*labels.columns)
        done.append(rest)
        if merges.isEmpty():
            return reduce(DataFrame.unionByName, done)
        names = merges.select(F.col("kept").alias("tax_idx"), "name")
        named = (
            active.join(merges.select("category_name"), "category_name", "left_semi")
            .join(names, "tax_idx", "left")
            .withColumn("subcategory_name", F.coalesce("name", "subcategory_name"))
            .select(*labels.columns)
        )
        active = materialize(_apply_merges(named, merges.select("gone", "kept")), "labels")


def anchor_merge(labels: DataFrame, threshold: float = fv.ANCHOR_SIMILARITY) -> DataFrame:
    """Merging into core rows alone; ``labels`` carries ``is_core``."""
    return consolidate(labels, None, threshold)


def renumber(labels: DataFrame, *order: str | Column) -> DataFrame:
    """Set ``subcategory_id`` to the place of a row in the given order, from 0.

    Rows are range-partitioned by the order and written once; each part then
    counts from the number of rows in the parts before it.
    """
    parts = materialize(
        labels.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ordered"
    )
    sizes = parts.groupBy("_part").agg(F.count("*").alias("_size"))
    before = F.sum("_size").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1))
    offsets = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    place = F.row_number().over(W.partitionBy("_part").orderBy(*order))
    return (
        parts.join(F.broadcast(offsets), "_part")
        .withColumn("subcategory_id", (F.col("_before") + place - 1).cast("int"))
        .select(*labels.columns)
    )


def health(
    labels: DataFrame,
    limit: int = fv.MAX_LABELS_PER_CATEGORY,
    stopwords: list[str] = fv.ENGLISH_STOPWORDS,
) -> DataFrame:
    """Per category: size, repeated names, and labels left with no or one term."""
    n_terms = F.size(
        F.array_distinct(tx.without_words(tx.tokens(tx.normalize(F.col("keywords"))), stopwords))
    )
    by_name = (
        labels.withColumn("_t", n_terms)
        .groupBy("category_id", "subcategory_name")
        .agg(
            F.count("*").alias("_n"),
            F.count_if(F.col("_t") == 0).alias("_none"),
            F.count_if(F.col("_t") < 2).alias("_few"),
        )
        .withColumn("_same", F.sum("_n").over(W.partitionBy("subcategory_name")))
    )
    return by_name.groupBy("category_id").agg(
        F.sum("_n").alias("n_labels"),
        (F.sum("_n") > limit).alias("over_limit"),
        F.sum(F.when(F.col("_same") > 1, F.col("_n")).otherwise(0)).alias("n_repeated_names"),
        F.sum("_none").alias("n_without_terms"),
        F.sum("_few").alias("n_below_two_terms"),
    )
