"""The multinomial fit against Spark ML's own."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors

from topicloom.operators import learning
from topicloom.plans.bounds import materialize

CLASSES = 4


def rows(spark, size):
    """Rows over few of many features, the last one constant; no row at all for one label."""
    r = np.random.default_rng(5)
    known = np.r_[np.sort(r.choice(size - 1, 40, replace=False)), size - 1]
    true, made = r.normal(0, 1, (CLASSES, 41)), []
    for _ in range(300):
        at, value = np.r_[np.sort(r.choice(40, 8, replace=False)), 40], np.r_[r.random(8), 0.25]
        label = [0, 1, 3, 4][int(np.argmax(true[:, at] @ value * 3 + r.normal(0, 0.3, CLASSES)))]
        made.append((float(label), Vectors.sparse(size, known[at].tolist(), value.tolist())))
    return materialize(spark.createDataFrame(made, ["label", "features"]), "rows")


@pytest.mark.parametrize(("size", "max_iter"), [(66_000, 1), (60, 30)])
def test_multinomial_fit_is_that_of_spark(spark, size, max_iter):
    training = rows(spark, size)
    want, got = learning._log_loss(max_iter).fit(training), learning._fit_log_loss(training, max_iter)
    assert np.allclose(want.coefficientMatrix.toArray(), got.coefficientMatrix.toArray(), atol=1e-9)
    assert np.allclose(want.interceptVector.toArray(), got.interceptVector.toArray(), atol=1e-9)


def test_one_label_alone_leaves_nothing_to_fit(spark):
    own = rows(spark, 60).filter("label = 1")
    want, got = learning._log_loss(5).fit(own), learning._fit_log_loss(own, 5)
    assert (want.coefficientMatrix.toArray() == got.coefficientMatrix.toArray()).all()
    assert (want.interceptVector.toArray() == got.interceptVector.toArray()).all()


def test_models_fitted_without_steps_of_spark(spark, monkeypatch):
    monkeypatch.setattr(LogisticRegression, "fit", lambda *a: pytest.fail("slow fit"))
    df = spark.createDataFrame([(i, ["sql join", "docker pod"][i % 2], i % 2) for i in range(20)], "prompt_id long, processed_text string, tax_idx int")
    model = learning.fit_rescue(df.drop("tax_idx"), df.drop("processed_text"), ["the"], max_terms=20, max_iter=3)
    assert model.classifier.coefficientMatrix.toArray().any()
