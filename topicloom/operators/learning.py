"""Models: rescue of texts without a hit, keyword mining, intent scoring, topic discovery."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import (
    LinearSVC,
    LogisticRegression,
    LogisticRegressionModel,
    OneVsRest,
    OneVsRestModel,
)
from pyspark.ml.clustering import KMeans
from pyspark.ml.common import _py2java
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseMatrix, DenseVector
from pyspark.ml.wrapper import JavaParams
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F, types as T

from topicloom.functions import fixed_values as fv, text as tx
from topicloom.operators import curation, fitting, lookup, reduction, terms
from topicloom.operators.features import Spaces, TextFeatures
from topicloom.plans.bounds import broadcast_if_small, materialize
from topicloom.session import share_package

ELASTIC_MIX = 0.15
REGULARISATION = 1e-4
#: A fit ends at the tolerance or after so many steps; pass a larger ``max_iter`` where time allows.
TOLERANCE = 1e-3
MAX_STEPS = 30
#: Rows that a step of Spark ML's own fit multiplies at once, in MB; ``fitting`` goes by Arrow batches.
BLOCK_MB = 32
#: Coefficients that every task may hold; a model with more is joined.
HELD_COEFFICIENTS = 5_000_000


def word_and_char(stopwords: list[str]) -> Spaces:
    return {"word": terms.Words(2, tuple(stopwords)), "char": tx.char_ngrams}


def words_only(high: int, stopwords: list[str] | None) -> Spaces:
    return {"word": terms.Words(high, tuple(stopwords or ()))}


def _log_loss(max_iter: int) -> LogisticRegression:
    """One multinomial fit for all labels instead of one fit per label."""
    return LogisticRegression(
        family="multinomial",
        elasticNetParam=ELASTIC_MIX,
        regParam=REGULARISATION,
        maxIter=max_iter,
        tol=TOLERANCE,
        standardization=False,
        aggregationDepth=3,
        # Every block adds a table of labels times vocabulary of its own: few large blocks.
        maxBlockSizeInMB=BLOCK_MB,
    )


def _java(spark: SparkSession, name: str, uid: str, *values):
    parts = [_py2java(spark.sparkContext, v) for v in values]
    return JavaParams._new_java_obj(f"org.apache.spark.ml.classification.{name}", uid, *parts)


def _spread(rows: DataFrame) -> DataFrame:
    """A part for every core, for tables that many passes read."""
    return rows.repartition(rows.sparkSession.sparkContext.defaultParallelism)


def _fit_log_loss(training: DataFrame, max_iter: int) -> LogisticRegressionModel:
    """The model that ``_log_loss(max_iter).fit`` gives, fitted by ``fitting``."""
    spark, plan = training.sparkSession, _log_loss(max_iter)
    coefficients, shifts = fitting.multinomial(training, plan.getRegParam(), plan.getElasticNetParam(), max_iter, plan.getTol())
    matrix = DenseMatrix(*coefficients.shape, coefficients.ravel(order="F"))
    made = _java(spark, "LogisticRegressionModel", plan.uid, matrix, DenseVector(shifts), len(shifts), True)
    return plan._copyValues(LogisticRegressionModel(made))


# --- rescue -------------------------------------------------------------------


@dataclass
class LinearModel:
    """One linear score per class, as tables.

    ``coefficients`` holds ``(feature, label, coef)`` without zeros, ``intercepts`` one row
    ``(label, intercept)`` for every class.  ``link`` turns scores into shares: ``sigmoid`` for
    classes fitted one against the rest, ``softmax`` for classes fitted together.
    """

    features: TextFeatures
    coefficients: DataFrame
    intercepts: DataFrame
    link: str = "sigmoid"

    def best(self, texts: DataFrame, id_col: str, text_col: str) -> DataFrame:
        """``(id, label, p)`` of every text: the class with the largest share, the lower label at ties.

        Terms are looked up in tables that every task holds and added up where the shuffled texts are read; a model with
        more than ``HELD_COEFFICIENTS`` is joined.
        """
        if self.coefficients.limit(HELD_COEFFICIENTS + 1).count() <= HELD_COEFFICIENTS:
            return self._best_held(texts, id_col, text_col)
        spread = texts.select(id_col, text_col).repartition(id_col)
        weights = self.features.weights(spread, id_col, text_col)
        return best_classes(weights, self.coefficients, self.intercepts, spread.select(id_col), id_col, self.link)

    def _best_held(self, texts: DataFrame, id_col: str, text_col: str) -> DataFrame:
        spark, link = texts.sparkSession, self.link
        share_package(spark)
        whole = F.col("feature").cast("int").alias("feature")
        shared = spark.sparkContext.broadcast([
            self.features.vocab.select("space", "term", "idf", whole).toArrow(),
            self.coefficients.select(whole, "label", F.col("coef").cast("double").alias("coef")).toArrow(),
            self.intercepts.select("label", F.col("intercept").cast("double").alias("intercept")).sort("label").toArrow(),
        ])
        columns, kinds = terms.sources(self.features.spaces, F.col(text_col))
        schema = T.StructType([
            T.StructField(id_col, texts.schema[id_col].dataType),
            T.StructField("label", self.intercepts.schema["label"].dataType),
            T.StructField("p", T.DoubleType()),
        ])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            return _HeldModel(*shared.value, kinds, link).best(batches, schema.names)

        spread = texts.select(id_col, text_col).repartition(id_col).sortWithinPartitions(id_col)
        return spread.select(id_col, *columns).mapInArrow(run, schema)

    def save(self, path: str) -> None:
        self.features.save(f"{path}/vocabulary")
        self.coefficients.write.mode("overwrite").parquet(f"{path}/coefficients")
        self.intercepts.withColumn("link", F.lit(self.link)).write.mode("overwrite").parquet(f"{path}/intercepts")

    @staticmethod
    def load(spark: SparkSession, path: str, spaces: Spaces) -> "LinearModel":
        features = TextFeatures.load(spark, f"{path}/vocabulary", spaces)
        intercepts = spark.read.parquet(f"{path}/intercepts")
        link = intercepts.select("link").first()[0]
        return LinearModel(features, spark.read.parquet(f"{path}/coefficients"), intercepts.drop("link"), link)


class _HeldModel:
    """What a task makes of a model's tables; the same answers as :func:`best_classes`."""

    def __init__(self, vocab: pa.Table, coefficients: pa.Table, intercepts: pa.Table, kinds: dict[str, tuple], link: str):
        self.value = {"sigmoid": lambda m: 1 / (1 + np.exp(-m)), "softmax": np.exp}[link]
        self.labels = pa.concat_arrays(intercepts["label"].chunks) if intercepts.num_rows else pa.array([], intercepts.schema.field("label").type)
        self.intercepts = intercepts["intercept"].to_numpy()
        place = pc.fill_null(pc.index_in(coefficients["label"], value_set=self.labels), -1).to_numpy()
        column, feature = place[place >= 0].astype(np.int64), coefficients["feature"].to_numpy()[place >= 0]
        coef, of = coefficients["coef"].to_numpy()[place >= 0], vocab["space"].to_pylist()
        self.spaces = []
        for name, kind in kinds.items():
            own = vocab.filter(pa.array([s == name for s in of], pa.bool_()))
            terms_, idf = own["term"].to_pylist(), own["idf"].to_numpy()
            # The last place is that of a feature of no or another space.
            number = np.full(max([-1, *vocab["feature"].to_pylist()]) + 2, -1)
            number[own["feature"].to_numpy()] = np.arange(len(terms_))
            term = number[np.minimum(feature, len(number) - 1)]
            known = term >= 0
            table = lookup.Table(len(self.labels), term[known], column[known], [coef[known]], idf, np.ones(len(idf)))
            self.spaces.append((lookup.known_counts(kind, terms_), table))

    def best(self, batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
        """``(id, label, p)`` for every row of ``(id, terms or lower-case text of each space)`` ordered by id."""
        n, k = len(self.labels), len(self.spaces)

        def sums(piece: pa.RecordBatch, group: np.ndarray, n_groups: int) -> np.ndarray:
            # A row: products of each space, their squared lengths, the number of rows.
            found = np.zeros((n_groups, k * n + k + 1))
            # Rows without an id or a text have no terms.
            there = np.flatnonzero([all(piece.column(i)[r].is_valid for i in range(k + 1)) for r in range(piece.num_rows)])
            for i, (counts, table) in enumerate(self.spaces):
                text, term, tf = counts.of(piece.column(i + 1).take(pa.array(there, pa.int64())))
                own, of = table.own(term, tf), group[there[text]]
                (found[:, i * n : (i + 1) * n],) = table.sums(of, term, [own], n_groups)
                found[:, k * n + i] = table.squares(of, term, own, n_groups)
            found[:, -1] = np.bincount(group, minlength=n_groups)
            return found

        def done(ids: pa.Array, sums: np.ndarray) -> pa.RecordBatch:
            rows = np.repeat(np.arange(len(ids)), sums[:, -1].astype(np.int64))
            own = ids.take(pa.array(rows, pa.int64()))
            if not n:
                return pa.RecordBatch.from_arrays([own, pa.nulls(len(rows), self.labels.type), pa.nulls(len(rows), pa.float64())], names=names)
            squares = sums[:, k * n : k * n + k]
            length = np.sqrt(np.where(squares > 0, squares, np.inf))
            value = self.value(sum(sums[:, i * n : (i + 1) * n] / length[:, i : i + 1] for i in range(k)) + self.intercepts)
            # Labels ascend, so that the lower one wins a tie.
            best = np.argmax(np.round(value, 9), axis=1)
            share = value[np.arange(len(best)), best] / value.sum(1)
            return pa.RecordBatch.from_arrays([own, self.labels.take(pa.array(best[rows], pa.int64())), pa.array(share[rows])], names=names)

        return lookup.by_id(batches, lookup.PIECE, sums, done)


def best_classes(
    weights: DataFrame, coefficients: DataFrame, intercepts: DataFrame, ids: DataFrame, id_col: str, link: str = "sigmoid"
) -> DataFrame:
    """``(id, label, p)``: the class with the largest share of each text's class values.

    A class value is the sigmoid (or, for ``softmax``, the exponential) of the sum of weight times
    coefficient and the intercept; shares are values over their sum.  Only classes that share a term with the text
    are summed row by row: all others stand at their intercepts, whose values and order are
    known beforehand.  Where ``weights`` and ``ids`` are spread by id nothing is shuffled.
    """
    value = {"sigmoid": lambda m: 1 / (1 + F.exp(-m)), "softmax": F.exp}[link]
    # In descending order of value: by a rounded key, so that ties go by label wherever sums were added up.
    key = lambda v, label: F.struct((-F.round(v, 9)).alias("k"), label.alias("label"), v.alias("v"))
    base = intercepts.select("label", "intercept", value(F.col("intercept")).alias("_v0"))
    scored = (
        weights.join(broadcast_if_small(coefficients), "feature")
        .groupBy(id_col, "label")
        .agg(F.sum(F.col("weight") * F.col("coef")).alias("_m"))
        .join(broadcast_if_small(base), "label")
        .withColumn("_v", value(F.col("_m") + F.col("intercept")))
    )
    met = scored.groupBy(id_col).agg(
        F.sum(F.col("_v") - F.col("_v0")).alias("_more"),
        F.min(key(F.col("_v"), F.col("label"))).alias("_met"),
        F.collect_list("label").alias("_seen"),
    )
    total = base.agg(F.sum("_v0").alias("v")).scalar()
    order = base.agg(F.sort_array(F.collect_list(key(F.col("_v0"), F.col("label")))).alias("o")).scalar()
    unmet = F.get(F.filter("_order", lambda x: ~F.array_contains(F.col("_seen"), x.label)), F.lit(0))
    best = F.when(F.col("_met").isNull(), F.get("_order", F.lit(0))).otherwise(F.least("_met", F.coalesce(unmet, "_met")))
    return (
        ids.join(met.hint("merge"), id_col, "left")
        .withColumns({"_order": order, "_total": total})
        .withColumn("_best", best)
        .select(id_col, "_best.label", (F.col("_best.v") / (F.col("_total") + F.coalesce("_more", F.lit(0.0)))).alias("p"))
    )


@dataclass
class RescueModel:
    linear: LinearModel
    classifier: LogisticRegressionModel
    #: ``(tax_idx, label)`` of the labels that have a hit; the classifier knows no others.
    classes: DataFrame

    @property
    def features(self) -> TextFeatures:
        return self.linear.features


def linear_tables(
    classifier: LogisticRegressionModel, features: TextFeatures, classes: DataFrame, class_col: str
) -> LinearModel:
    """A fitted classifier as tables, its labels named by ``class_col``.

    Its coefficients are on the driver, labels times vocabulary cap; those that are not zero go out as Arrow columns.
    """
    spark = classes.sparkSession
    matrix = classifier.coefficientMatrix.toArray()
    label, feature = np.nonzero(matrix)
    columns = {
        "place": pa.array(label, pa.int32()), "feature": pa.array(feature, pa.int32()), "coef": pa.array(matrix[label, feature], pa.float64()),
    }
    names = broadcast_if_small(classes.select(F.col("label").alias("place"), F.col(class_col).alias("label")))
    coefficients = materialize(spark.createDataFrame(pa.table(columns)).join(names, "place").drop("place"), "coefficients")
    shifts = [(i, float(b)) for i, b in enumerate(classifier.interceptVector.toArray())]
    intercepts = spark.createDataFrame(shifts, "place int, intercept double").join(names, "place").drop("place")
    return LinearModel(features, coefficients, materialize(intercepts, "intercepts"), "softmax")


def fit_rescue(
    prepared: DataFrame,
    hits: DataFrame,
    stopwords: list[str],
    id_col: str = "prompt_id",
    max_terms: int = fv.RESCUE_FEATURES,
    max_iter: int = MAX_STEPS,
) -> RescueModel | None:
    """Learn from the hits ``(id, tax_idx)``; the vocabulary covers all prepared texts.

    None when there is nothing to learn from: fewer than two labels among the hits.
    """
    classes = number_classes(hits, "tax_idx")
    if classes.limit(2).count() < 2:
        return None
    features = TextFeatures.fit(prepared, "processed_text", word_and_char(stopwords), max_terms)
    chosen = prepared.join(hits.select(id_col, "tax_idx"), id_col)
    vectors = features.transform(chosen, id_col, "processed_text")
    numbered = hits.join(broadcast_if_small(classes), "tax_idx").select(
        id_col, F.col("label").cast("double").alias("label")
    )
    training = materialize(_spread(vectors.join(numbered, id_col)), "rescue-training")
    classifier = _fit_log_loss(training, max_iter)
    return RescueModel(linear_tables(classifier, features, classes, "tax_idx"), classifier, classes)


def rescue(
    leftovers: DataFrame,
    model: LinearModel,
    id_col: str = "prompt_id",
    threshold: float = fv.RESCUE_THRESHOLD,
) -> DataFrame:
    """``(id, tax_idx, p)`` of the leftovers whose best label reaches the threshold; labels are ``tax_idx`` values."""
    found = model.best(leftovers, id_col, "processed_text").filter(F.col("p") >= threshold)
    return found.withColumnRenamed("label", "tax_idx")


def rescuer(stopwords: list[str], id_col: str = "prompt_id", **options):
    """The rescue step for ``plans.routing.route_english``: learn from the hits, label the rest."""

    def model_of(prepared: DataFrame, hits: DataFrame) -> LinearModel | None:
        fitted = fit_rescue(prepared, hits, stopwords, id_col, **options)
        return fitted and fitted.linear

    return rescuer_with(model_of, id_col)


def rescuer_with(model_of: Callable[[DataFrame, DataFrame], LinearModel | None], id_col: str = "prompt_id"):
    """The rescue step with the model that ``model_of(prepared, hits)`` gives, such as a stored one."""

    def rescue_rows(prepared: DataFrame, hits: DataFrame) -> DataFrame | None:
        model = model_of(prepared, hits)
        if model is None:
            return None
        leftovers = prepared.join(hits.select(id_col), id_col, "left_anti")
        return rescue(leftovers, model, id_col).select(id_col, "tax_idx")

    return rescue_rows


# --- keyword mining -------------------------------------------------------------


def rank_keywords(
    weights: DataFrame, labels: DataFrame, top: int = 20, keep: int = 15
) -> DataFrame:
    """Add the strongest terms of each label to its keywords, as a sorted word set.

    ``weights`` holds ``(subcategory_id, term, coef)``.  Of the ``top`` terms those of
    more than three letters or blanks count, at most ``keep`` of them.  Labels the
    table does not know are left out.
    """
    by_label = W.partitionBy("subcategory_id")
    order = by_label.orderBy(F.desc("coef"), "term")
    strongest = (
        weights.withColumn("_rank", F.row_number().over(order))
        .filter(F.col("_rank") <= top)
        .filter((F.length(F.trim("term")) > 3) & F.trim("term").rlike("^[a-z ]+$"))
        .withColumn("_place", F.row_number().over(by_label.orderBy("_rank")))
        .filter(F.col("_place") <= keep)
        .groupBy("subcategory_id")
        .agg(F.flatten(F.collect_list(tx.split_words(F.col("term")))).alias("_mined"))
    )
    old = tx.split_words(F.coalesce("keywords", F.lit("")))
    merged = F.array_join(F.sort_array(F.array_union(old, F.col("_mined"))), " ")
    return (
        labels.join(broadcast_if_small(strongest), "subcategory_id", "left")
        .withColumn(
            "keywords", F.when(F.col("_mined").isNotNull(), merged).otherwise(F.coalesce("keywords", F.lit("")))
        )
        .select(*labels.columns)
    )


def class_weights_of_model(
    model: LogisticRegressionModel, features: TextFeatures, classes: DataFrame, top: int = 20
) -> DataFrame:
    """``(subcategory_id, term, coef)``: the ``top`` coefficients of every class.

    The coefficients are on the driver already, labels times vocabulary cap; only
    the strongest of each row become rows again.
    """
    matrix = model.coefficientMatrix.toArray()
    strongest = np.argsort(-matrix, axis=1, kind="stable")[:, :top]
    rows = [
        (int(c), int(f), float(matrix[c, f])) for c in range(matrix.shape[0]) for f in strongest[c]
    ]
    spark = features.vocab.sparkSession
    top_rows = spark.createDataFrame(rows, "label int, feature int, coef double")
    return (
        top_rows.join(features.vocab.select("feature", "term"), "feature")
        .join(classes, "label")
        .select("subcategory_id", "term", "coef")
    )


def number_classes(labelled: DataFrame, class_col: str) -> DataFrame:
    """``(class, label)`` with labels from 0; one row per class."""
    distinct = labelled.select(class_col).na.drop().distinct()
    return materialize(
        distinct.withColumn("label", F.row_number().over(W.orderBy(class_col)) - 1), "classes"
    )


def mine_keywords(
    labelled: DataFrame,
    labels: DataFrame,
    id_col: str = "prompt_id",
    stopwords: list[str] = fv.ENGLISH_STOPWORDS,
    max_terms: int = fv.MINING_FEATURES,
    max_iter: int = MAX_STEPS,
) -> DataFrame:
    """Learn labels from raw texts and feed the telling terms back into the label table."""
    texts = labelled.withColumn("raw_text", F.coalesce("raw_text", F.lit("")))
    classes = number_classes(texts, "subcategory_id")
    features = TextFeatures.fit(texts, "raw_text", words_only(2, stopwords), max_terms)
    numbered = texts.join(broadcast_if_small(classes), "subcategory_id").select(
        id_col, F.col("label").cast("double").alias("label")
    )
    training = materialize(
        _spread(features.transform(texts, id_col, "raw_text").join(numbered, id_col)), "mining-training"
    )
    model = _fit_log_loss(training, max_iter)
    return rank_keywords(class_weights_of_model(model, features, classes), labels)


# --- intent model ---------------------------------------------------------------


def balanced_weights(labelled: DataFrame, class_col: str) -> DataFrame:
    """``(class, n, weight)`` with weight N / (k * n)."""
    sizes = labelled.groupBy(class_col).agg(F.count("*").alias("n"))
    total = sizes.agg(F.sum("n").alias("n")).scalar()
    k = sizes.agg(F.count("*").alias("k")).scalar()
    return sizes.withColumn("weight", total / (k * F.col("n")))


def calibrate(margins: DataFrame, folds: int, classes: int, steps: int = 30, tolerance: float = 1e-9) -> np.ndarray:
    """Slope and offset of a sigmoid for every fold and class: an array ``folds x classes x 2``.

    ``margins`` holds ``(fold, label, margins)`` of held-out rows, one margin per class.  Targets are smoothed by the
    class sizes of the fold.  All folds and classes take each Newton step together: it needs six sums of
    each, which are added up before anything moves, and only those come to the driver.  A step that does not
    lower a pair's loss is halved.  A class without rows in a fold keeps slope 0.
    """
    spark = margins.sparkSession
    long = margins.select("fold", "label", F.posexplode("margins").alias("c", "m")).withColumn("own", F.col("label") == F.col("c"))
    pos, neg = np.zeros((folds, classes)), np.zeros((folds, classes))
    for r in long.groupBy("fold", "c").agg(F.count_if("own").alias("pos"), F.count_if(~F.col("own")).alias("neg")).collect():
        pos[r.fold, r.c], neg[r.fold, r.c] = r.pos, r.neg
    high, low = (pos + 1) / (pos + 2), 1 / (neg + 2)
    value, shift = np.zeros((folds, classes, 2)), np.zeros((folds, classes, 2))
    value[..., 1] = np.log((pos + 1) / (neg + 1))
    best, at = np.full((folds, classes), np.inf), value.copy()
    for _ in range(steps + 1):
        rows = [
            (i, c, float(at[i, c, 0]), float(at[i, c, 1]), float(high[i, c]), float(low[i, c]))
            for i in range(folds) for c in range(classes)
        ]
        now = F.broadcast(spark.createDataFrame(rows, "fold int, c int, a double, b double, high double, low double"))
        z, target = F.col("a") * F.col("m") + F.col("b"), F.when(F.col("own"), F.col("high")).otherwise(F.col("low"))
        part = long.join(now, ["fold", "c"]).select("fold", "c", "m", z.alias("z"), target.alias("t"))
        share = 1 / (1 + F.exp(-F.col("z")))
        part = part.withColumns({"d": share - F.col("t"), "h": share * (1 - share)})
        # log(1 + e^z) - t z, safe for large z
        loss = F.greatest("z", F.lit(0.0)) + F.log1p(F.exp(-F.abs("z"))) - F.col("t") * F.col("z")
        m, d, h = F.col("m"), F.col("d"), F.col("h")
        sums = part.groupBy("fold", "c").agg(
            F.sum(loss).alias("loss"), F.sum(d * m).alias("ga"), F.sum(d).alias("gb"),
            F.sum(h * m * m).alias("haa"), F.sum(h * m).alias("hab"), F.sum(h).alias("hbb"),
        )
        moved = 0.0
        for r in sums.collect():
            i = r.fold, r.c
            if r.loss > best[i] + 1e-12 * abs(best[i]):
                shift[i] /= 2  # back to half of the last step
            else:
                best[i], value[i] = r.loss, at[i]
                hessian = np.array([[r.haa, r.hab], [r.hab, r.hbb]]) + 1e-12 * np.eye(2)
                shift[i] = -np.linalg.solve(hessian, [r.ga, r.gb])
            at[i] = value[i] + shift[i]
            moved = max(moved, float(np.abs(shift[i]).max()))
        if moved <= tolerance:
            break
    return value


@dataclass
class IntentModel:
    """Calibrated linear SVMs: one per class and fold, probabilities averaged over folds."""

    features: TextFeatures
    classes: DataFrame
    folds: list[tuple[OneVsRestModel, np.ndarray]]

    def score(self, texts: DataFrame, id_col: str, text_col: str) -> DataFrame:
        """``(id, class columns, p)``: the most probable class of every text."""
        prepared = texts.select(id_col, tx.normalize(F.col(text_col)).alias("_text"))
        scored = self.features.transform(prepared, id_col, "_text").withColumn("_p", F.array().cast("array<array<double>>"))
        for model, sigmoids in self.folds:
            raw = vector_to_array(F.col("rawPrediction"))
            slopes, offsets = (F.array(*[F.lit(float(x)) for x in s]) for s in sigmoids.T)
            share = F.transform(
                F.arrays_zip(raw.alias("m"), slopes.alias("a"), offsets.alias("b")),
                lambda z: 1 / (1 + F.exp(-(z["m"] * z["a"] + z["b"]))),
            )
            normal = tx.let(
                share,
                lambda s: tx.let(
                    F.aggregate(s, F.lit(0.0), lambda acc, x: acc + x),
                    lambda total: F.transform(s, lambda x: x / total),
                ),
            )
            scored = (
                model.transform(scored)
                .withColumn("_p", F.array_append("_p", normal))
                .select(id_col, "features", "_p")
            )
        k = len(self.folds[0][1])
        mean = F.transform(
            F.sequence(F.lit(0), F.lit(k - 1)),
            lambda c: F.aggregate(F.col("_p"), F.lit(0.0), lambda acc, p: acc + F.get(p, c)) / len(self.folds),
        )
        best = tx.let(
            mean,
            lambda p: F.struct(F.array_max(p).alias("p"), (F.array_position(p, F.array_max(p)) - 1).cast("int").alias("label")),
        )
        found = scored.select(id_col, best.alias("_b")).select(id_col, "_b.label", "_b.p")
        return found.join(broadcast_if_small(self.classes), "label").drop("label")

    def save(self, path: str) -> None:
        self.features.save(f"{path}/vocabulary")
        self.classes.write.mode("overwrite").parquet(f"{path}/classes")
        rows = [
            (i, c, float(a), float(b)) for i, (_, s) in enumerate(self.folds) for c, (a, b) in enumerate(s)
        ]
        spark = self.classes.sparkSession
        spark.createDataFrame(rows, "fold int, label int, slope double, offset double").write.mode(
            "overwrite"
        ).parquet(f"{path}/sigmoids")
        for i, (model, _) in enumerate(self.folds):
            model.write().overwrite().save(f"{path}/fold-{i}")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "IntentModel":
        features = TextFeatures.load(spark, f"{path}/vocabulary", words_only(3, None))
        sigmoids = spark.read.parquet(f"{path}/sigmoids").toPandas()
        folds = [
            (
                OneVsRestModel.load(f"{path}/fold-{i}"),
                part.sort_values("label")[["slope", "offset"]].to_numpy(),
            )
            for i, part in sigmoids.groupby("fold")
        ]
        return IntentModel(features, spark.read.parquet(f"{path}/classes"), folds)


def fit_intent(
    labelled: DataFrame,
    id_col: str,
    text_col: str,
    class_col: str,
    max_terms: int = fv.INTENT_FEATURES,
    c: float = 0.5,
    folds: int = 3,
    max_iter: int = MAX_STEPS,
    parallelism: int = 4,
) -> IntentModel:
    """Balanced linear SVMs over 1- to 3-grams with sigmoid calibration on held-out folds."""
    texts = materialize(
        labelled.select(id_col, class_col, tx.normalize(F.coalesce(text_col, F.lit(""))).alias("_text")), "intent-texts"
    )
    features = TextFeatures.fit(texts, "_text", words_only(3, None), max_terms)
    classes = number_classes(texts, class_col)
    weighed = classes.join(balanced_weights(texts, class_col).select(class_col, "weight"), class_col)
    training = materialize(
        features.transform(texts, id_col, "_text")
        .join(texts.select(id_col, class_col), id_col)
        .join(broadcast_if_small(weighed), class_col)
        .select(
            "features",
            F.col("label").cast("double").alias("label"),
            "weight",
            F.pmod(F.xxhash64(id_col), F.lit(folds)).alias("_fold"),
        ),
        "intent-training",
    )
    k, n = classes.count(), training.count()
    svm = LinearSVC(regParam=1.0 / (c * n), maxIter=max_iter, tol=TOLERANCE, standardization=False, weightCol="weight")
    models, held_out = [], []
    for fold in range(folds):
        model = OneVsRest(classifier=svm, weightCol="weight", parallelism=parallelism).fit(
            training.filter(F.col("_fold") != fold)
        )
        models.append(model)
        held_out.append(
            model.transform(training.filter(F.col("_fold") == fold)).select(
                F.lit(fold).alias("fold"), F.col("label").cast("int").alias("label"), vector_to_array("rawPrediction").alias("margins")
            )
        )
    sigmoids = calibrate(materialize(reduce(DataFrame.unionByName, held_out), "margins"), folds, k)
    return IntentModel(features, classes, list(zip(models, sigmoids)))


# --- topic discovery --------------------------------------------------------------


def discover_topics(
    texts: DataFrame,
    id_col: str = "prompt_id",
    text_col: str = "processed_text",
    clusters: int = 20,
    max_terms: int = 30_000,
    stopwords: list[str] = fv.ENGLISH_STOPWORDS,
    seed: int = 42,
    rank: int = 100,
) -> tuple[DataFrame, DataFrame]:
    """``(id, cluster)`` and ``(cluster, n, name)``: k-means over TF-IDF rows reduced to ``rank`` directions, named by terms.

    Reduced rows have length one; a text without a known term is a zero row.
    """
    features = TextFeatures.fit(texts, text_col, words_only(2, stopwords), max_terms)
    known = features.weights(texts.select(id_col, text_col).repartition(id_col), id_col, text_col)
    reduced, found = reduction.reduce_rows(known, id_col, features.size, min(rank, features.size), seed=seed)
    zeros = F.array_repeat(F.lit(0.0), found.directions.shape[1])
    vectors = materialize(
        texts.select(id_col).join(reduced, id_col, "left").select(id_col, array_to_vector(F.coalesce("reduced", zeros)).alias("features")),
        "topic-vectors",
    )
    assigned = materialize(
        KMeans(k=clusters, seed=seed, predictionCol="cluster")
        .fit(vectors)
        .transform(vectors)
        .select(id_col, "cluster"),
        "topics",
    )
    weights = (
        features.weights(texts.select(id_col, text_col).repartition(id_col), id_col, text_col)
        .join(assigned, id_col)
        .groupBy("cluster", "feature")
        .agg(F.sum("weight").alias("_s"))
    )
    strongest = W.partitionBy("cluster").orderBy(F.desc(F.round("_s", 9)), "feature")
    words = (
        weights.withColumn("_rank", F.row_number().over(strongest))
        .filter("_rank <= 3")
        .join(broadcast_if_small(features.vocab.select("feature", "term")), "feature")
        .groupBy("cluster")
        .agg(F.array_sort(F.collect_list(F.struct("_rank", "term"))).alias("_t"))
        .select("cluster", curation.cluster_name(F.col("_t.term")).alias("name"))
    )
    named = (
        assigned.groupBy("cluster")
        .agg(F.count("*").alias("n"))
        .join(words, "cluster", "left")
        .withColumn("name", F.coalesce("name", F.lit("empty_cluster")))
    )
    return assigned, named
