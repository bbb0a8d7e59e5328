"""TF-IDF vectors for Spark ML, made in the tasks that read the texts; the vocabulary is held by every task."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from topicloom.operators import lookup, terms
from topicloom.session import share_package

Spaces = dict[str, Callable[[Column], Column]]


@dataclass
class TextFeatures:
    """A fitted vocabulary over one or more term spaces.

    ``vocab`` holds ``(space, term, idf, feature)``; its caps bound its size.
    """

    vocab: DataFrame
    size: int
    spaces: Spaces
    sublinear: bool = True

    @staticmethod
    def fit(texts: DataFrame, text_col: str, spaces: Spaces, max_terms: int, sublinear: bool = True) -> "TextFeatures":
        """Fit each space with its own cap of ``max_terms`` terms."""
        vocab = terms.corpus_vocabulary(texts, F.col(text_col), spaces, max_terms)
        return TextFeatures(vocab, vocab.count(), spaces, sublinear)

    def _run(self, texts: DataFrame, id_col: str, text_col: str, rows: Callable, schema: T.StructType, *more: str) -> DataFrame:
        """``rows(vectors, pieces)`` in every task; a piece has whole ids, then the spaces' columns, then ``more``."""
        spark = texts.sparkSession
        share_package(spark)
        shared = spark.sparkContext.broadcast(self.vocab.select("space", "term", "idf", "feature").toArrow())
        columns, kinds = terms.sources(self.spaces, F.col(text_col))
        sublinear = self.sublinear

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            return rows(lookup.Vectors(shared.value, kinds, sublinear), lookup.whole_ids(batches, lookup.PIECE))

        return terms.by_id(texts.select(id_col, text_col, *more), id_col, columns, *more).mapInArrow(run, schema)

    def weights(self, texts: DataFrame, id_col: str, text_col: str) -> DataFrame:
        """``(id, space, feature, weight)`` with unit length per id and space; texts without an id have no rows."""
        schema = T.StructType([
            T.StructField(id_col, texts.schema[id_col].dataType),
            T.StructField("feature", T.ArrayType(T.IntegerType())), T.StructField("weight", T.ArrayType(T.DoubleType())),
        ])

        def rows(vectors: lookup.Vectors, pieces: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for piece in pieces:
                group, features, weights = vectors.lists(piece)
                first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]][: len(group)])
                yield pa.RecordBatch.from_arrays([piece.column(0).take(pa.array(first, pa.int64())), features, weights], names=schema.names)

        long = self._run(texts, id_col, text_col, rows, schema).select(id_col, F.explode(F.arrays_zip("feature", "weight")).alias("_e"))
        # Features are numbered by space.
        last = self.vocab.groupBy("space").agg(F.max("feature").alias("last")).orderBy("last").collect()
        space = reduce(lambda w, r: w.when(F.col("_e.feature") <= r.last, r.space), last, F.when(F.lit(False), F.lit("")))
        return long.select(id_col, space.alias("space"), "_e.feature", "_e.weight")

    def transform(self, texts: DataFrame, id_col: str, text_col: str) -> DataFrame:
        """``(id, features)`` for every text; one shuffle, by text."""
        schema, size = T.StructType([T.StructField(id_col, texts.schema[id_col].dataType), T.StructField("features", VectorUDT())]), self.size

        def rows(vectors: lookup.Vectors, pieces: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for piece in pieces:
                group, features, weights = vectors.lists(piece)
                at, n = pa.array(group, pa.int64()), piece.num_rows
                parts = [pa.array(np.zeros(n, np.int8)), pa.array(np.full(n, size, np.int32)), features.take(at), weights.take(at)]
                vector = pa.StructArray.from_arrays(parts, ["type", "size", "indices", "values"])
                yield pa.RecordBatch.from_arrays([piece.column(0), vector], names=schema.names)

        return self._run(texts, id_col, text_col, rows, schema)

    def label_sums(self, texts: DataFrame, id_col: str, text_col: str, label_col: str) -> DataFrame:
        """``(label, feature, s)``: the weights of every label's texts, added up in the tasks that read them."""
        kind, size = texts.schema[label_col].dataType, self.size
        schema = T.StructType([T.StructField(label_col, kind), T.StructField("feature", T.IntegerType()), T.StructField("s", T.DoubleType())])

        def rows(vectors: lookup.Vectors, pieces: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums, arrow = lookup.LabelSums(size), None

            def part(names: list, place: np.ndarray, feature: np.ndarray, total: np.ndarray) -> pa.RecordBatch:
                columns = [pa.array(names, arrow).take(pa.array(place)), pa.array(feature, pa.int32()), pa.array(total)]
                return pa.RecordBatch.from_arrays(columns, names=schema.names)

            for piece in pieces:
                labels = piece.column(piece.num_columns - 1)
                arrow = labels.type
                yield from (part(*p) for p in sums.add(labels, *vectors.per_row(piece)))
            yield from (part(*p) for p in sums.rest())

        parts = self._run(texts, id_col, text_col, rows, schema, label_col)
        return parts.groupBy(label_col, "feature").agg(F.sum("s").alias("s"))

    def save(self, path: str) -> None:
        self.vocab.write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str, spaces: Spaces) -> "TextFeatures":
        vocab = spark.read.parquet(path)
        return TextFeatures(vocab, vocab.count(), spaces)
