import math
import random

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from topicloom.operators import learning
from topicloom.operators.features import TextFeatures

TEXTS = ["sql join tables", "restart docker pod", "pivot chart in excel", "sql select rows", "docker cluster", "chart of sales"] * 5


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "prompt_id long, processed_text string")


@pytest.mark.parametrize("link", ["sigmoid", "softmax"])
def test_best_class_equals_the_dense_product(spark, link):
    r = random.Random(link)
    classes, features = 6, 15
    coef = {(f, c): r.uniform(-3, 3) for f in range(features) for c in range(classes) if r.random() < 0.3}
    shift = [r.uniform(-2, 2) for _ in range(classes - 1)]
    shift.append(shift[0])  # two classes tie wherever neither is met
    weights = {(i, f): r.random() for i in range(40) for f in r.sample(range(features + 5), 4)}
    ids = spark.createDataFrame([(i,) for i in range(45)], "id long")
    got = learning.best_classes(
        spark.createDataFrame([(i, f, w) for (i, f), w in weights.items()], "id long, feature int, weight double"),
        spark.createDataFrame([(f, 10 * c, v) for (f, c), v in coef.items()], "feature int, label int, coef double"),
        spark.createDataFrame([(10 * c, b) for c, b in enumerate(shift)], "label int, intercept double"),
        ids, "id", link,
    ).collect()
    assert len(got) == 45
    for row in got:
        m = [shift[c] + sum(w * coef.get((f, c), 0) for (i, f), w in weights.items() if i == row.id) for c in range(classes)]
        v = [1 / (1 + math.exp(-x)) if link == "sigmoid" else math.exp(x) for x in m]
        best = min(range(classes), key=lambda c: (-round(v[c], 9), c))
        assert row.label == 10 * best and row.p == pytest.approx(v[best] / sum(v), abs=1e-9)


def test_tables_of_a_fitted_model_score_as_it_does(spark, tmp_path):
    rows = frame(spark, [*TEXTS, "", "words nobody knows"])
    hits = rows.filter("prompt_id < 30").select("prompt_id", (F.col("prompt_id") % 3).cast("int").alias("tax_idx"))
    model = learning.fit_rescue(rows, hits.filter("prompt_id % 2 = 0"), ["the"], max_terms=200, max_iter=20)
    vectors = model.features.transform(rows, "prompt_id", "processed_text")
    scored = model.classifier.transform(vectors).select("prompt_id", vector_to_array("probability").alias("p"))
    names = {r.label: r.tax_idx for r in model.classes.collect()}
    want = {r.prompt_id: (names[int(np.argmax(r.p))], max(r.p)) for r in scored.collect()}
    model.linear.save(str(tmp_path / "m"))
    stored = learning.LinearModel.load(spark, str(tmp_path / "m"), learning.word_and_char(["the"]))
    for linear in (model.linear, stored):
        got = {r.prompt_id: (r.label, r.p) for r in linear.best(rows, "prompt_id", "processed_text").collect()}
        assert got.keys() == want.keys()
        for key, (label, p) in got.items():
            assert label == want[key][0] and p == pytest.approx(want[key][1], abs=1e-9)


def test_scoring_texts_moves_them_once(spark):
    rows = frame(spark, TEXTS)
    hits = rows.select("prompt_id", (F.col("prompt_id") % 3).cast("int").alias("tax_idx"))
    model = learning.fit_rescue(rows, hits, ["the"], max_terms=200, max_iter=5).linear
    plan = model.best(rows, "prompt_id", "processed_text")
    text = plan.sparkSession._jvm.PythonSQLUtils.explainString(plan._jdf.queryExecution(), "simple")
    own = [l for l in text.split("== Initial Plan")[0].splitlines() if "Exchange hashpartitioning(prompt_id" in l]
    assert own and all("REPARTITION_BY_COL" in l for l in own) and "from_json" not in text


def test_calibration_reaches_the_least_loss_of_every_fold_and_class(spark):
    r = np.random.default_rng(2)
    rows = []
    for fold in range(2):
        for label in r.integers(0, 4, 200):
            m = r.normal(0, 1, 4) + 2.0 * (np.arange(4) == label) - 1
            rows.append((fold, int(label), [float(x) for x in m]))
    # separable margins: plain Newton steps overshoot, smoothed targets keep the optimum finite
    rows += [(2, k % 3, [40.0 * (k % 3 == c) - 20 for c in range(4)]) for k in range(60)]
    found = learning.calibrate(spark.createDataFrame(rows, "fold int, label int, margins array<double>"), 3, 4)
    for fold in range(3):
        for c in range(4):
            own = [(m[c], label == c) for f, label, m in rows if f == fold]
            pos = sum(o for _, o in own)
            neg = len(own) - pos
            m = np.array([x for x, _ in own])
            t = np.array([(pos + 1) / (pos + 2) if o else 1 / (neg + 2) for _, o in own])
            a, b = found[fold, c]
            p = 1 / (1 + np.exp(-(a * m + b)))
            assert abs(((p - t) * m).sum()) < 1e-5 and abs((p - t).sum()) < 1e-5


def test_intent_model_of_four_classes(spark):
    words = ["sql join tables", "restart docker pod", "pivot chart excel", "send mail invite"]
    rows = [(i, f"{words[i % 4]} number{i % 7}", i % 4) for i in range(120)]
    df = spark.createDataFrame(rows, "prompt_id long, raw_text string, subcategory_id int")
    scored = learning.fit_intent(df, "prompt_id", "raw_text", "subcategory_id", max_iter=10, folds=2).score(df, "prompt_id", "raw_text")
    met = scored.withColumnRenamed("subcategory_id", "found").join(df, "prompt_id").collect()
    assert len(met) == 120 and all(r.found == r.subcategory_id and 0.25 < r.p <= 1 for r in met)


def test_held_coefficients_give_the_rows_of_the_joins(spark, monkeypatch):
    odd = [(1, "sql join tables sql"), (1, "docker cluster"), (None, "sql select"), (2, None), (3, ""), (None, "pivot chart"), (4, "Chart of  sales")]
    rows = frame(spark, TEXTS)
    features = TextFeatures.fit(rows, "processed_text", learning.word_and_char(["the"]), 60)
    coefficients = [(f, label, math.sin(f * label + label)) for f in range(features.size) for label in (3, 7, 8, 99) if (f + label) % 3]
    model = learning.LinearModel(
        features, spark.createDataFrame(coefficients, "feature int, label int, coef double"),
        spark.createDataFrame([(8, 0.1), (3, 0.1), (7, 0.2), (11, 0.2)], "label int, intercept double"),
    )
    texts = spark.createDataFrame(odd, "prompt_id long, processed_text string")

    def found():
        plan = model.best(texts, "prompt_id", "processed_text")
        text = plan.sparkSession._jvm.PythonSQLUtils.explainString(plan._jdf.queryExecution(), "simple")
        return sorted(((r.prompt_id, r.label, round(r.p, 9)) for r in plan.collect()), key=str), text

    held, plan = found()
    monkeypatch.setattr(learning, "HELD_COEFFICIENTS", 0)
    joined, other = found()
    assert len(held) == len(odd) and held == joined and "Generate" not in plan and "Generate" in other
