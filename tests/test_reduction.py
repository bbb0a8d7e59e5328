import numpy as np
import pytest

from topicloom.operators import learning, reduction
from topicloom.plans.bounds import materialize


def table(spark, dense):
    rows = [(i, j, float(x)) for i, row in enumerate(dense) for j, x in enumerate(row) if x]
    weights = spark.createDataFrame(rows, "id long, feature int, weight double").repartition(5)
    return materialize(reduction.sparse_rows(weights, "id"), "rows")


def matrix(n=300, size=40, seed=3):
    r = np.random.default_rng(seed)
    return np.where(r.random((n, size)) < 0.2, r.random((n, size)), 0) * np.linspace(3, 0.2, size)


def test_product_equals_the_dense_one(spark, monkeypatch):
    monkeypatch.setattr(reduction, "STRIPE", 7)
    monkeypatch.setattr(reduction, "ROWS", 13)
    dense = matrix()
    block = np.random.default_rng(1).random((40, 6))
    assert np.allclose(reduction.gram_product(table(spark, dense), block), dense.T @ (dense @ block))


def test_singular_values_agree_with_a_dense_decomposition(spark):
    dense = matrix()
    rows = table(spark, dense)
    found = reduction.truncated_svd(rows, 40, 5, passes=12)
    _, values, directions = np.linalg.svd(dense)
    assert np.allclose(found.singular, values[:5], rtol=1e-6)
    assert np.allclose(np.abs((found.directions * directions[:5].T).sum(axis=0)), 1, atol=1e-4)
    reduced = {r.id: r.reduced for r in found.transform(rows, "id", unit=False).collect()}
    assert all(np.allclose(reduced.get(i, np.zeros(5)), row @ found.directions) for i, row in enumerate(dense))
    unit = {r.id: np.linalg.norm(r.reduced) for r in found.transform(rows, "id").collect()}
    assert all(x == pytest.approx(1) for x in unit.values())


def test_blocks_are_bounded_and_small_tables_have_few_directions(spark, monkeypatch):
    rows = table(spark, [[1.0, 0, 2.0], [0, 1.0, 0]])
    assert np.allclose(reduction.truncated_svd(rows, 3, 9).singular, np.linalg.svd([[1.0, 0, 2.0], [0, 1.0, 0]])[1].tolist() + [0], atol=1e-6)
    monkeypatch.setattr(reduction, "BLOCK_BYTES", 100)
    with pytest.raises(ValueError):
        reduction.truncated_svd(rows, 1000, 9)


def test_topics_of_reduced_texts(spark):
    texts = ["docker pod restart", "docker pod cluster", "sql join table", "sql table rows"] * 6 + ["", "zzz"]
    df = spark.createDataFrame(list(enumerate(texts)), "prompt_id long, processed_text string")
    assigned, named = learning.discover_topics(df, clusters=3, max_terms=50, rank=4)
    cluster = {r.prompt_id: r.cluster for r in assigned.collect()}
    assert len(cluster) == len(texts) and len({cluster[i] for i in range(0, 24, 4)}) == 1 and cluster[0] != cluster[2]
    assert sum(r.n for r in named.collect()) == len(texts)
