"""TF-IDF cosine similarity between texts and the rows of a label table.

An index holds one row per (term, label) with the idf of the term and the label's
weight.  Next to them every term has a row for the pseudo label ``NORM``; what a
text collects there is its own squared length, so one join and one sum give both
the dot products and the norm.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from topicloom.functions import fixed_values as fv, text as tx
from topicloom.operators import lookup, terms
from topicloom.plans.bounds import BROADCAST_ROWS, broadcast_if_small
from topicloom.session import share_package

NORM = -1
# A term every text has; it keeps texts and pairs alive that share nothing else.
ANY_TEXT = "\u0000"


def _with_any_text(counts: Column) -> Column:
    extra = F.array(F.struct(F.lit(ANY_TEXT).alias("term"), F.lit(1).alias("tf")))
    return F.concat(counts, extra)


def describe_labels(labels: DataFrame) -> DataFrame:
    """Add ``processed_desc``: the normalised keywords, or the name where there is no such column."""
    source = (
        F.coalesce("keywords", F.lit("")) if "keywords" in labels.columns else F.col("subcategory_name")
    )
    return labels.withColumn("processed_desc", tx.normalize(source))


def fit_space(counts: DataFrame, n_labels: Column, max_terms: int) -> DataFrame:
    """``(term, tax_idx, idf, weight)`` of one vector space, with its ``NORM`` rows."""
    counts = counts.persist()
    vocab = terms.vocabulary(counts, n_labels, max_terms).persist()
    weighed = terms.weights(counts, vocab, "tax_idx", True, max_terms)
    return (
        weighed.join(vocab.select("term", "idf"), "term")
        .select("term", "tax_idx", "idf", "weight")
        .unionByName(
            vocab.select(
                "term", F.lit(NORM).alias("tax_idx"), "idf", F.lit(0.0).alias("weight")
            )
        )
        .persist()
    )


@dataclass
class LabelIndex:
    """Everything the router needs to know about a label table.

    Fitted on the labels only, so prompts are never scanned for it.  Its frames have
    label-table size and stay cached, as each is used by several others.
    """

    labels: DataFrame
    stopwords: list[str]
    word_features: int = fv.WORD_FEATURES
    char_features: int = fv.CHAR_FEATURES

    @cached_property
    def described(self) -> DataFrame:
        return describe_labels(self.labels).persist()

    def _counts(self, found: Column) -> DataFrame:
        return terms.term_freq(self.described, "tax_idx", found)

    @cached_property
    def word(self) -> DataFrame:
        text = F.col("processed_desc")
        counts = self._counts(terms.word_terms(text, 2, self.stopwords))
        return fit_space(counts, terms.row_count(self.labels), self.word_features)

    @cached_property
    def char(self) -> DataFrame:
        counts = self._counts(tx.char_ngrams(F.col("processed_desc")))
        return fit_space(counts, terms.row_count(self.labels), self.char_features)

    @cached_property
    def unigrams(self) -> DataFrame:
        """``(term, tax_idx, label_tf)``: plain counts over single words of the vocabulary."""
        vocab = self.word.filter(F.col("tax_idx") == NORM).select("term")
        return (
            self._counts(tx.tokens(F.col("processed_desc")))
            .withColumnRenamed("tf", "label_tf")
            .join(vocab, "term", "left_semi")
            .persist()
        )

    @cached_property
    def required(self) -> DataFrame:
        """``(tax_idx, required)``: the overlap a label asks for, 0 where no term is left."""
        totals = self.unigrams.groupBy("tax_idx").agg(F.sum("label_tf").alias("_total"))
        return self.labels.join(totals, "tax_idx", "left").select(
            "tax_idx",
            F.least(F.lit(fv.MAX_OVERLAP), F.coalesce("_total", F.lit(0))).alias("required"),
        )

    @cached_property
    def word_side(self) -> DataFrame:
        """The word space with overlap counts and requirements, ready for the join.

        Labels that ask for nothing are tied to ``ANY_TEXT`` and so meet every text.
        """
        posted = (
            self.word.join(self.unigrams, ["term", "tax_idx"], "left")
            .join(self.required, "tax_idx", "left")
            .select(
                "term",
                "tax_idx",
                "idf",
                "weight",
                F.coalesce("label_tf", F.lit(0)).alias("label_tf"),
                F.coalesce("required", F.lit(0)).cast("long").alias("required"),
            )
        )
        free = self.required.filter("required = 0").select(
            F.lit(ANY_TEXT).alias("term"),
            "tax_idx",
            F.lit(0.0).alias("idf"),
            F.lit(0.0).alias("weight"),
            F.lit(0).cast("long").alias("label_tf"),
            F.lit(0).cast("long").alias("required"),
        )
        return broadcast_if_small(posted.unionByName(free))

    @cached_property
    def char_terms(self) -> DataFrame:
        """``(term, term_id, idf)``; at most ``char_features`` rows, numbered in one small sort."""
        vocab = self.char.filter(F.col("tax_idx") == NORM).select("term", "idf")
        numbered = vocab.withColumn("term_id", F.row_number().over(W.orderBy("term")))
        none = vocab.sparkSession.range(1).select(
            F.lit(ANY_TEXT).alias("term"), F.lit(0.0).alias("idf"), F.lit(0).alias("term_id")
        )
        return broadcast_if_small(numbered.unionByName(none))

    @cached_property
    def char_side(self) -> DataFrame:
        """``(term_id, tax_idx, weight)``; two integers make one packed join key."""
        posted = self.char.join(self.char_terms.select("term", "term_id"), "term").select(
            "term_id", "tax_idx", "weight"
        )
        every = self.labels.select(
            F.lit(0).alias("term_id"), "tax_idx", F.lit(0.0).alias("weight")
        )
        return broadcast_if_small(posted.unionByName(every))

    @cached_property
    def held(self):
        """The word space, its overlap side and the character space as a Spark broadcast; None when they have too many rows."""
        # Cached one after the other: otherwise each plan repeats those it is made of.
        if max(df.count() for df in (self.described, self.word, self.unigrams, self.char)) > BROADCAST_ROWS:
            return None
        sides = self.word, self.word_side, self.char
        if self.word_side.limit(BROADCAST_ROWS + 1).count() > BROADCAST_ROWS:
            return None
        share_package(self.labels.sparkSession)
        return self.labels.sparkSession.sparkContext.broadcast([df.toArrow() for df in sides])


class _Held:
    """What a task makes of ``LabelIndex.held`` to add up the texts it reads.

    The tables have the same rows as the joins, also where a label index has repeated rows.  ``kind`` is one of ``_scores``.
    """

    def __init__(self, word: pa.Table, word_side: pa.Table, char: pa.Table, kind: str):
        self.kind, self.masked = kind, kind in ("overlap", "masked")
        word = word_side if self.masked else word
        ids = pa.concat_arrays([*word["tax_idx"].chunks, *char["tax_idx"].chunks]).unique()
        self.labels = ids.filter(pa.array([i is not None and i != NORM for i in ids.to_pylist()], pa.bool_()))
        self.n = len(self.labels)
        if self.masked:
            label, free = self._places(word), np.array([t == ANY_TEXT for t in word["term"].to_pylist()], bool)
            self.required, self.any_text = np.zeros(self.n), np.zeros(self.n, bool)
            self.required[label[label >= 0]] = word["required"].to_numpy()[label >= 0]
            self.any_text[label[free & (label >= 0)]] = True
            word = word.filter(pa.array(~free))
        names, self.word = self._table(word, ["weight", "label_tf"] if self.masked else ["weight"])
        self.words = lookup.WordCounts(names)
        names, self.char = self._table(char, ["weight"])
        self.windows = lookup.WindowCounts(names, 3, 5)

    def _places(self, table: pa.Table) -> np.ndarray:
        places = {v: i for i, v in enumerate(self.labels.to_pylist())}
        return np.array([places.get(v, -1) for v in table["tax_idx"].to_pylist()], np.int64)

    def _table(self, table: pa.Table, values: list[str]) -> tuple[list[str], lookup.Table]:
        encoded = table["term"].combine_chunks().dictionary_encode()
        term, label = encoded.indices.to_numpy().astype(np.int64), self._places(table)
        idf = np.zeros(len(encoded.dictionary))
        idf[term] = table["idf"].to_numpy()
        norm = np.array([v == NORM for v in table["tax_idx"].to_pylist()], bool)
        norms = np.bincount(term[norm], minlength=len(idf))
        real = label >= 0
        columns = [table[v].to_numpy()[real].astype(float) for v in values]
        return encoded.dictionary.to_pylist(), lookup.Table(self.n, term[real], label[real], columns, idf, norms)

    def scores(self, batches: Iterator[pa.RecordBatch], distinct_overlap: bool = False) -> Iterator[pa.RecordBatch]:
        """``(id, label, overlap, word similarity, similarity)`` of batches ``(id, tokens, lower-case text)`` ordered by id."""
        n, kind, masked = self.n, self.kind, self.masked
        # A row of sums: word products, overlaps, window products, then both squared lengths.
        word, overlap, char = (slice(i * n, (i + 1) * n) for i in range(3))

        def passing(sums: np.ndarray) -> np.ndarray:
            met = (sums[:, word] > 0) | (sums[:, overlap] > 0) | self.any_text
            return met & (sums[:, overlap] >= self.required)

        def sums(piece: pa.RecordBatch, group: np.ndarray, n_groups: int) -> np.ndarray:
            found = np.zeros((n_groups, 3 * n + 2))
            if kind != "char":
                text, term, tf = self.words.of(piece.column(1))
                own = self.word.own(term, tf)
                shared = np.ones(len(tf)) if distinct_overlap else tf.astype(float)
                factors = [own, shared] if masked else [own]
                for place, part in zip((word, overlap), self.word.sums(group[text], term, factors, n_groups)):
                    found[:, place] = part
                found[:, -2] = self.word.squares(group[text], term, own, n_groups)
            rows = np.arange(piece.num_rows)
            if kind == "masked":
                # Only texts with a label left are taken apart; the first and last id may go on in other pieces.
                wanted = passing(found).any(1)
                wanted[[0, -1]] = True
                rows = np.flatnonzero(wanted[group])
            if kind not in ("overlap", "word"):
                text, term, tf = self.windows.of(piece.column(2).take(pa.array(rows)))
                own, of = self.char.own(term, tf), group[rows[text]]
                (found[:, char],) = self.char.sums(of, term, [own], n_groups)
                found[:, -1] = self.char.squares(of, term, own, n_groups)
            return found

        def done(ids: pa.Array, sums: np.ndarray) -> pa.RecordBatch:
            length = np.sqrt(np.where(sums[:, -2:] > 0, sums[:, -2:], np.inf))
            by_word, by_char = sums[:, word] / length[:, :1], sums[:, char] / length[:, 1:]
            both = {"word": by_word, "overlap": by_word, "char": by_char}.get(kind, (by_word + by_char) / 2.0)
            text, label = np.nonzero(passing(sums) if masked else (sums[:, word] > 0) | (sums[:, char] > 0))
            columns = [ids.take(pa.array(text)), self.labels.take(pa.array(label)), pa.array(sums[:, overlap][text, label].astype(np.int64))]
            columns += [pa.array(by_word[text, label]), pa.array(both[text, label])]
            return pa.RecordBatch.from_arrays(columns, names=["id", "tax_idx", "overlap", "word_sim", "sim"])

        return lookup.by_id(batches, lookup.PIECE, sums, done)


def _scores(
    prompts: DataFrame, index: LabelIndex, kind: str, id_col: str, text_col: str, partitions: int | None = None, distinct_overlap: bool = False
) -> DataFrame:
    """``(id, tax_idx, overlap, word_sim, sim)``, added up where the shuffled texts are read.

    ``kind`` names the pairs: ``word``, ``char`` and ``blend`` those that share a term of the space or spaces, ``overlap`` and
    ``masked`` those that pass the overlap mask.  Texts meet ordered by id, so that rows with one id count together.
    """
    shared = index.held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _Held(*shared.value, kind).scores(batches, distinct_overlap)

    text = F.col(text_col)
    tokens = F.lit(None).cast("array<string>") if kind == "char" else tx.without_words(tx.tokens(text), index.stopwords)
    lower = F.lit(None).cast("string") if kind in ("word", "overlap") else F.lower(text)
    texts = spread(prompts.filter(text.isNotNull()).select(id_col, text_col), id_col, partitions).sortWithinPartitions(id_col)
    schema = T.StructType([
        T.StructField(id_col, prompts.schema[id_col].dataType), T.StructField("tax_idx", index.labels.schema["tax_idx"].dataType),
        T.StructField("overlap", T.LongType()), T.StructField("word_sim", T.DoubleType()), T.StructField("sim", T.DoubleType()),
    ])
    return texts.select(id_col, tokens.alias("tokens"), lower.alias("lower")).mapInArrow(
        lambda batches: (pa.RecordBatch.from_arrays(b.columns, names=schema.names) for b in run(batches)), schema
    )


def spread(prompts: DataFrame, id_col: str, partitions: int | None = None) -> DataFrame:
    """Spread texts by id: the one shuffle of the router.

    Everything after it is grouped by text, so the n-gram rows, some hundred times
    the size of the text, never travel.  ``partitions`` sets how many texts a task
    takes apart at a time.
    """
    return prompts.repartition(partitions, id_col) if partitions else prompts.repartition(id_col)


def _contribution(tf: Column, idf: Column, weight: Column) -> Column:
    own = tx.sublinear(tf) * idf
    return F.when(F.col("tax_idx") == NORM, own * own).otherwise(own * weight)


def _scaled(total: str, id_col: str) -> Column:
    """Dot products over the text's length; a text without any known term scores 0."""
    squared = F.max(F.when(F.col("tax_idx") == NORM, F.col(total))).over(W.partitionBy(id_col))
    return F.when(squared > 0, F.col(total) / F.sqrt(squared)).otherwise(F.lit(0.0))


def cosine(
    prompts: DataFrame, space: DataFrame, found: Column, id_col: str = "prompt_id"
) -> DataFrame:
    """``(id, tax_idx, sim)`` for every pair that shares a term of the space."""
    return (
        terms.term_freq(spread(prompts, id_col), id_col, found)
        .join(broadcast_if_small(space), "term")
        .withColumn("_v", _contribution(F.col("tf"), F.col("idf"), F.col("weight")))
        .groupBy(id_col, "tax_idx")
        .agg(F.sum("_v").alias("_v"))
        .withColumn("sim", _scaled("_v", id_col))
        .filter(F.col("tax_idx") != NORM)
        .select(id_col, "tax_idx", "sim")
    )


def cosine_word(
    prompts: DataFrame, index: LabelIndex, id_col: str = "prompt_id", text_col: str = "processed_text"
) -> DataFrame:
    if index.held:
        return _scores(prompts, index, "word", id_col, text_col).select(id_col, "tax_idx", "sim")
    return cosine(prompts, index.word, terms.word_terms(F.col(text_col), 2, index.stopwords), id_col)


def cosine_char(
    prompts: DataFrame, index: LabelIndex, id_col: str = "prompt_id", text_col: str = "processed_text"
) -> DataFrame:
    if index.held:
        return _scores(prompts, index, "char", id_col, text_col).select(id_col, "tax_idx", "sim")
    return cosine(prompts, index.char, tx.char_ngrams(F.col(text_col)), id_col)


def cosine_blend(
    prompts: DataFrame, index: LabelIndex, id_col: str = "prompt_id", text_col: str = "processed_text"
) -> DataFrame:
    """Mean of both spaces for every pair.  ``masked_similarity`` avoids most of this work."""
    if index.held:
        return _scores(prompts, index, "blend", id_col, text_col).select(id_col, "tax_idx", "sim")
    both = cosine_word(prompts, index, id_col, text_col).unionByName(
        cosine_char(prompts, index, id_col, text_col)
    )
    return both.groupBy(id_col, "tax_idx").agg((F.sum("sim") / 2.0).alias("sim"))


def overlap_pairs(
    prompts: DataFrame,
    index: LabelIndex,
    id_col: str = "prompt_id",
    text_col: str = "processed_text",
    distinct_overlap: bool = False,
) -> DataFrame:
    """``(id, tax_idx, overlap, word_sim)`` of the pairs that share enough words.

    The overlap is the product sum of the plain counts, so one word used twice
    counts as two; ``distinct_overlap`` counts each shared word once.
    """
    if index.held:
        return _scores(prompts, index, "overlap", id_col, text_col, None, distinct_overlap).drop("sim")
    if distinct_overlap:
        shared = F.when(F.col("label_tf") > 0, 1).otherwise(0)
    else:
        shared = F.col("tf") * F.col("label_tf")
    found = _with_any_text(
        tx.term_counts(terms.word_terms(F.col(text_col), 2, index.stopwords))
    )
    return (
        prompts.select(id_col, F.explode(found).alias("_t"))
        .select(id_col, F.col("_t.term").alias("term"), F.col("_t.tf").alias("tf"))
        .join(index.word_side, "term")
        .groupBy(id_col, "tax_idx")
        .agg(
            F.sum(_contribution(F.col("tf"), F.col("idf"), F.col("weight"))).alias("_v"),
            F.sum(shared.cast("long")).alias("overlap"),
            F.max("required").alias("required"),
        )
        .withColumn("word_sim", _scaled("_v", id_col))
        .filter((F.col("tax_idx") != NORM) & (F.col("overlap") >= F.col("required")))
        .select(id_col, "tax_idx", "overlap", "word_sim")
    )


def masked_similarity(
    prompts: DataFrame,
    index: LabelIndex,
    id_col: str = "prompt_id",
    text_col: str = "processed_text",
    partitions: int | None = None,
    distinct_overlap: bool = False,
) -> DataFrame:
    """``(id, tax_idx, sim)`` of the pairs that pass the overlap mask.

    A masked pair scores 0 and can never win, so the mask comes first and only
    surviving texts are taken apart into character windows, each window looked up
    for the surviving labels alone.  A text's norm still covers all of its windows.
    Terms are looked up in a label index that every task holds; one too large for that is joined.
    """
    if index.held:
        # Texts without an id have no pairs.
        known = prompts.filter(F.col(id_col).isNotNull())
        return _scores(known, index, "masked", id_col, text_col, partitions, distinct_overlap).select(id_col, "tax_idx", "sim")
    texts = spread(prompts.select(id_col, text_col), id_col, partitions)
    survivors = (
        overlap_pairs(texts, index, id_col, text_col, distinct_overlap)
        .groupBy(id_col)
        .agg(F.collect_list(F.struct("tax_idx", "word_sim")).alias("_labels"))
    )
    norm_row = F.array(F.struct(F.lit(NORM).alias("tax_idx"), F.lit(0.0).alias("word_sim")))
    windows = (
        texts.join(survivors.hint("merge"), id_col)
        .select(
            id_col,
            F.concat("_labels", norm_row).alias("_labels"),
            F.explode(_with_any_text(tx.term_counts(tx.char_ngrams(F.col(text_col))))).alias("_t"),
        )
        .select(id_col, "_labels", F.col("_t.term").alias("term"), F.col("_t.tf").alias("tf"))
        .join(index.char_terms, "term")
        .select(id_col, "term_id", "idf", "tf", F.explode("_labels").alias("_l"))
        .select(id_col, "term_id", "idf", "tf", "_l.tax_idx", "_l.word_sim")
    )
    return (
        windows.join(index.char_side, ["term_id", "tax_idx"])
        .groupBy(id_col, "tax_idx")
        .agg(
            F.sum(_contribution(F.col("tf"), F.col("idf"), F.col("weight"))).alias("_v"),
            F.max("word_sim").alias("word_sim"),
        )
        .withColumn("sim", (F.col("word_sim") + _scaled("_v", id_col)) / 2.0)
        .filter(F.col("tax_idx") != NORM)
        .select(id_col, "tax_idx", "sim")
    )


def best_label(pairs: DataFrame, id_col: str = "prompt_id") -> DataFrame:
    """``(id, tax_idx, score)``: highest score at nine digits, ties to the lower row."""
    top = F.max(F.struct(F.round("sim", 9).alias("score"), (-F.col("tax_idx")).alias("_neg")))
    return (
        pairs.groupBy(id_col)
        .agg(top.alias("_top"))
        .select(id_col, (-F.col("_top._neg")).alias("tax_idx"), F.col("_top.score").alias("score"))
    )


def top_labels(pairs: DataFrame, k: int, id_col: str = "prompt_id") -> DataFrame:
    """The ``k`` best labels per text with their rank."""
    order = W.partitionBy(id_col).orderBy(F.desc("score"), "tax_idx")
    return (
        pairs.withColumn("score", F.round("sim", 9))
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select(id_col, "tax_idx", "score", "rank")
    )
