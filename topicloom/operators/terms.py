"""Term statistics and TF-IDF in long form: one row per (text, term).

    tf' = 1 + ln(tf)              when sublinear
    idf = ln((1 + N) / (1 + df)) + 1
    w   = tf' * idf, scaled to unit length per text over the terms of the vocabulary

Counting the terms of a text happens inside its row, so ``term_freq`` moves no
data; document frequency shuffles one pre-summed row per distinct term.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F, types as T

from topicloom.functions import fixed_values as fv, text as tx
from topicloom.operators import lookup
from topicloom.plans.bounds import BROADCAST_ROWS, materialize
from topicloom.session import share_package


def word_terms(
    text: Column, high: int = 2, stopwords: list[str] | None = fv.ENGLISH_STOPWORDS, low: int = 1
) -> Column:
    """Stopwords go first, then n-grams run over the gaps they leave."""
    return tx.word_ngrams(tx.without_words(tx.tokens(text), stopwords or []), low, high)


def joined_char_ngrams(text: Column, between: str, low: int = 3, high: int = 5) -> Column:
    """The sorted and joined terms of :func:`topicloom.functions.text.char_ngrams`; a task takes every word apart once."""
    share_package(SparkSession.active())
    return lookup.sorted_windows(low, high, between)(F.lower(text))


@dataclass(frozen=True)
class Words:
    """The space of word 1- to ``high``-grams; called with a text it gives its terms."""

    high: int = 2
    stopwords: tuple[str, ...] = tuple(fv.ENGLISH_STOPWORDS)

    def __call__(self, text: Column) -> Column:
        return word_terms(text, self.high, list(self.stopwords))


Space = Callable[[Column], Column]


def source(found: Space, text: Column) -> tuple[Column, tuple]:
    """What a task needs of a text to make the terms of a space itself, and the kind of the space for ``lookup``.

    N-grams of words are made from the tokens, windows from the lower-case text; any other space sends its terms.
    """
    if isinstance(found, Words):
        return tx.without_words(tx.tokens(text), found.stopwords), ("words", found.high)
    if found is tx.char_ngrams:
        return F.lower(text), ("windows", 3, 5)
    return found(text), ("terms",)


def sources(spaces: dict[str, Space], text: Column) -> tuple[list[Column], dict[str, tuple]]:
    """A column per space and the kinds by name."""
    found = {name: source(space, text) for name, space in spaces.items()}
    return [c.alias(f"_{i}") for i, (c, _) in enumerate(found.values())], {name: kind for name, (_, kind) in found.items()}


#: Texts whose terms are counted together.
COUNTED = 4096


def corpus_stats(texts: DataFrame, text: Column, spaces: dict[str, Space]) -> DataFrame:
    """``(space, term, df, total_tf)`` of all terms, counted in the tasks that read the texts and pre-summed there."""
    share_package(texts.sparkSession)
    columns, kinds = sources(spaces, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stats = {name: lookup.all_stats(kind) for name, kind in kinds.items()}

        def named(name: str, found: pa.RecordBatch) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.repeat(name, found.num_rows), *found.columns], names=["space", "term", "df", "tf"])

        for piece in lookup.pieces(batches, COUNTED):
            for i, (name, own) in enumerate(stats.items()):
                yield from (named(name, found) for found in own.add(piece.column(i)))
        for name, own in stats.items():
            yield from (named(name, found) for found in own.rest())

    parts = texts.select(*columns).mapInArrow(run, "space string, term string, df bigint, tf bigint")
    return parts.groupBy("space", "term").agg(F.sum("df").alias("df"), F.sum("tf").alias("total_tf"))


def corpus_vocabulary(texts: DataFrame, text: Column, spaces: dict[str, Space], max_terms: int) -> DataFrame:
    """``(space, term, idf, feature)``: of each space the ``max_terms`` terms with the highest total count, ties to the smaller term.

    Each task ranks its own terms first, so at most ``max_terms`` rows of each task and space meet.  A written table.
    """
    order = W.partitionBy("space").orderBy(F.desc("total_tf"), "term")
    kept = corpus_stats(texts, text, spaces).withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= max_terms)
    idf = F.log((1.0 + row_count(texts)) / (1.0 + F.col("df"))) + 1.0
    feature = F.row_number().over(W.orderBy("space", "term")) - 1
    return materialize(kept.select("space", "term", idf.alias("idf"), feature.alias("feature")), "vocabulary")


def by_id(texts: DataFrame, id_col: str, columns: list[Column], *more: str) -> DataFrame:
    """``(id, columns, more)`` spread by id and ordered by it, made behind the one shuffle, which moves the texts."""
    return texts.repartition(id_col).sortWithinPartitions(id_col).select(id_col, *columns, *more)


def held_tfidf(
    texts: DataFrame, id_col: str, text_col: str, spaces: dict[str, Space], sublinear: bool, max_terms: int
) -> DataFrame:
    """``(id, space, term, weight)``, fitted on the given texts, with unit length per id and space.

    Every task holds the vocabulary and looks the terms of the texts it reads up.  Rows without an id count as rows of one id:
    these are weighed by joins.
    """
    spark = texts.sparkSession
    share_package(spark)
    # Written once: the texts are counted, then weighed.
    texts = materialize(texts.select(id_col, text_col), "texts")
    vocab = corpus_vocabulary(texts, F.col(text_col), spaces, max_terms)
    shared = spark.sparkContext.broadcast(vocab.toArrow())
    columns, kinds = sources(spaces, F.col(text_col))
    kind_of_id = texts.schema[id_col].dataType
    schema = T.StructType([
        T.StructField(id_col, kind_of_id), T.StructField("space", T.StringType()), T.StructField("term", T.StringType()), T.StructField("weight", T.DoubleType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = lookup.Vectors(shared.value, kinds, sublinear)
        order = shared.value.sort_by("feature").combine_chunks()
        space, term = (pa.concat_arrays(order[c].chunks) if order.num_rows else pa.array([], pa.string()) for c in ("space", "term"))
        for piece in lookup.whole_ids(batches, lookup.PIECE):
            _, _, row, feature, weight = found.of(piece)
            at = pa.array(feature, pa.int64())
            yield pa.RecordBatch.from_arrays([piece.column(0).take(pa.array(row, pa.int64())), space.take(at), term.take(at), pa.array(weight)], names=schema.names)

    known = by_id(texts.filter(F.col(id_col).isNotNull()), id_col, columns).mapInArrow(run, schema)
    unknown = texts.filter(F.col(id_col).isNull())
    for name, found in spaces.items():
        counts = term_freq(unknown, id_col, found(F.col(text_col)))
        own = vocab.filter(F.col("space") == name)
        known = known.unionByName(weights(counts, own, id_col, sublinear, max_terms).withColumn("space", F.lit(name)))
    return known


def term_freq(texts: DataFrame, id_col: str, terms: Column) -> DataFrame:
    """``(id, term, tf)`` without a shuffle."""
    return texts.select(id_col, F.explode(tx.term_counts(terms)).alias("_t")).select(
        id_col, F.col("_t.term").alias("term"), F.col("_t.tf").cast("long").alias("tf")
    )


def vocabulary(counts: DataFrame, n_texts: Column, max_terms: int | None = None) -> DataFrame:
    """``(term, df, total_tf, idf)``, cut to the terms with the highest total count.

    Ties go to the smaller term.  The cut is a top-k, so each task keeps at most
    ``max_terms`` rows and the result is bounded by it.
    """
    stats = counts.groupBy("term").agg(
        F.count("*").alias("df"), F.sum("tf").alias("total_tf")
    )
    if max_terms is not None:
        stats = stats.orderBy(F.desc("total_tf"), "term").limit(max_terms)
    return stats.withColumn("idf", F.log((1.0 + n_texts) / (1.0 + F.col("df"))) + 1.0)


def row_count(df: DataFrame) -> Column:
    """Number of rows as a scalar subquery of the plan it is used in."""
    return df.agg(F.count("*").alias("n")).scalar()


def weights(
    counts: DataFrame,
    vocab: DataFrame,
    id_col: str,
    sublinear: bool = True,
    max_terms: int | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """``(id, term, weight)`` with unit length per text.

    A vocabulary with a cap is broadcast, its size being known; without a cap Spark
    chooses the join.
    """
    tf = tx.sublinear(F.col("tf")) if sublinear else F.col("tf").cast("double")
    idf = vocab.select("term", "idf")
    if max_terms is not None and max_terms <= BROADCAST_ROWS:
        idf = F.broadcast(idf)
    raw = counts.join(idf, "term").withColumn("_w", tf * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(W.partitionBy(id_col)))
    return raw.withColumn("weight", F.col("_w") / norm).select(id_col, *keep, "term", "weight")


def tfidf(
    texts: DataFrame,
    id_col: str,
    terms: Column,
    sublinear: bool = True,
    max_terms: int | None = None,
) -> DataFrame:
    """Fit on the given texts and weigh them.

    Texts are spread by id before their terms are taken apart, so that the norm
    per text needs no shuffle of the much larger term rows.
    """
    counts = term_freq(texts.repartition(id_col), id_col, terms)
    vocab = vocabulary(counts, row_count(texts), max_terms)
    return weights(counts, vocab, id_col, sublinear, max_terms)


def feature_union(
    texts: DataFrame,
    id_col: str,
    text: Column,
    stopwords: list[str] | None = fv.ENGLISH_STOPWORDS,
    max_terms: int | None = fv.RESCUE_FEATURES,
) -> DataFrame:
    """Word and character spaces side by side, each with its own vocabulary and norm."""
    if max_terms is not None and max_terms <= BROADCAST_ROWS:
        spaces = {"word": Words(2, tuple(stopwords or ())), "char": tx.char_ngrams}
        return held_tfidf(texts.select(id_col, text.alias("_text")), id_col, "_text", spaces, True, max_terms)
    word = tfidf(texts, id_col, word_terms(text, 2, stopwords), True, max_terms)
    char = tfidf(texts, id_col, tx.char_ngrams(text), True, max_terms)
    return word.withColumn("space", F.lit("word")).unionByName(
        char.withColumn("space", F.lit("char"))
    )
