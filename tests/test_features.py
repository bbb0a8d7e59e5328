import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from checks import fixtures as fx, queries
from topicloom.functions import text as tx
from topicloom.operators import learning, lookup, quality, terms
from topicloom.operators.features import TextFeatures
from topicloom.operators.similarity import LabelIndex

ROWS = [
    (1, "sql join tables sql"), (2, "Docker  pod in the cluster"), (None, "sql select rows"), (3, None), (4, ""), (None, "pivot chart"),
    (5, "sql\u3000join \u00dcber"), (2, "pod cluster chart"), (6, "\U0001d518a b sql join tables"),
]
SPACES = {"word": terms.Words(3, ("the", "in")), "char": tx.char_ngrams, "pairs": lambda t: terms.word_terms(t, 2, ["sql"], 2)}


def frame(spark, rows=ROWS):
    return spark.createDataFrame(rows, "prompt_id long, processed_text string")


def plan_of(df):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


def sorted_rows(df, *columns):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(*columns).collect()), key=str)


def test_stats_and_vocabulary_are_those_of_the_rows(spark, monkeypatch):
    df, text = frame(spark), F.col("processed_text")
    monkeypatch.setattr(terms, "COUNTED", 2)
    found = terms.corpus_stats(df, text, SPACES)
    kept = terms.corpus_vocabulary(df, text, SPACES, 5)
    assert "Generate" not in plan_of(found)
    for name, space in SPACES.items():
        rows = terms.term_freq(df, "prompt_id", space(text))
        counted = rows.groupBy("term").agg(F.count("*"), F.sum("tf"))
        assert sorted_rows(found.filter(F.col("space") == name), "term", "df", "total_tf") == sorted_rows(counted, "*")
        want = sorted_rows(terms.vocabulary(rows, terms.row_count(df), 5), "term", "idf")
        assert want and sorted_rows(kept.filter(F.col("space") == name), "term", "idf") == want


def test_vectors_are_made_without_a_row_per_term(spark):
    df = frame(spark)
    features = TextFeatures.fit(df, "processed_text", SPACES, 30)
    vectors = features.transform(df, "prompt_id", "processed_text")
    assert "Generate" not in plan_of(vectors) and "from_json" not in plan_of(vectors)
    got = vectors.select("prompt_id", vector_to_array("features").alias("v")).collect()
    assert len(got) == len(ROWS)
    want = {}
    for name, space in SPACES.items():
        rows = terms.term_freq(df, "prompt_id", space(F.col("processed_text")))
        own = features.vocab.filter(F.col("space") == name)
        joined = terms.weights(rows, own, "prompt_id").join(own.select("term", "feature"), "term")
        for r in joined.filter("prompt_id IS NOT NULL").collect():
            want[r.prompt_id, r.feature] = want.get((r.prompt_id, r.feature), 0) + r.weight
    for r in got:
        for feature, weight in enumerate(r.v):
            assert weight == pytest.approx(want.get((r.prompt_id, feature), 0), abs=1e-12)
    long = {(r.prompt_id, r.feature): (r.space, r.weight) for r in features.weights(df, "prompt_id", "processed_text").collect()}
    names = {r.feature: r.space for r in features.vocab.collect()}
    assert long == {k: (names[k[1]], pytest.approx(w, abs=1e-12)) for k, w in want.items()}


@pytest.mark.parametrize("cells", [1, 8_000_000])
def test_label_sums_are_those_of_the_rows(spark, monkeypatch, cells):
    monkeypatch.setattr(lookup, "DENSE_CELLS", cells)
    size = 7
    rng = np.random.default_rng(1)
    want, got, sums = {}, {}, lookup.LabelSums(size)

    def take(parts):
        for names, place, feature, total in parts:
            for p, f, t in zip(place, feature, total):
                got[names[p], f] = got.get((names[p], f), 0) + t

    for _ in range(5):
        labels = pa.array([["a", "b", None, "c"][i] for i in rng.integers(0, 4, 6)], pa.string())
        of, feature, weight = rng.integers(0, 6, 40), rng.integers(0, size, 40), rng.random(40)
        for o, f, w in zip(of, feature, weight):
            key = labels[int(o)].as_py(), f
            want[key] = want.get(key, 0) + w
        take(sums.add(labels, of, feature, weight))
    take(sums.rest())
    assert got == {k: pytest.approx(v) for k, v in want.items()}


def test_centroids_from_sums_equal_those_from_rows(spark):
    rows = spark.createDataFrame([(i, t, "ab"[k % 2]) for k, (i, t) in enumerate(ROWS)] + [(9, "sql join", None)],
                                 "prompt_id long, truncated_prompt string, subcategory_name string")
    sums, long = quality.purity_weights(rows, label_col="subcategory_name"), quality.purity_weights(rows)
    columns = ["subcategory_name", "term", "weight", "n"]
    found = sorted_rows(quality.centroids(sums, rows), *columns)
    assert found and found == sorted_rows(quality.centroids(long, rows), *columns) and "Generate" not in plan_of(sums)


@pytest.mark.parametrize("sublinear", [True, False])
def test_held_weights_equal_those_of_the_joins(spark, sublinear):
    df, text = frame(spark), F.col("processed_text")
    held = terms.held_tfidf(df, "prompt_id", "processed_text", SPACES, sublinear, 20)
    for name, space in SPACES.items():
        want = sorted_rows(terms.tfidf(df, "prompt_id", space(text), sublinear, 20), "prompt_id", "term", "weight")
        assert want and sorted_rows(held.filter(F.col("space") == name), "prompt_id", "term", "weight") == want


def test_three_word_terms_are_looked_up():
    counts = lookup.GramCounts(["a b c", "b", "c d", "b c d"], 3)
    text, term, tf = counts.of(pa.array([["a", "b", "c", "d"], None, [], ["a", "b"], ["c"], ["b", "c", "d", "b", "c", "d"]]))
    assert list(zip(text, term, tf)) == [(0, 0, 1), (0, 1, 1), (0, 2, 1), (0, 3, 1), (3, 1, 1), (5, 1, 2), (5, 2, 2), (5, 3, 2)]


def test_joined_char_ngrams(spark):
    df = frame(spark)
    new = df.select("prompt_id", terms.joined_char_ngrams(F.col("processed_text"), "|").alias("v"))
    old = df.select("prompt_id", F.array_join(F.sort_array(tx.char_ngrams(F.col("processed_text"))), "|").alias("v"))
    assert sorted_rows(new, "*") == sorted_rows(old, "*") and "regexp_extract_all" not in plan_of(new)


def test_routed_prompts_pass_the_gate_once(spark, monkeypatch):
    prompts = spark.createDataFrame([(1, "sql join tables"), (2, "jersey bars")], "prompt_id long, raw_text string")
    labels = spark.createDataFrame([(0, 0, "Data", 0, "Sql", "sql join")], "tax_idx int, category_id int, category_name string, subcategory_id int, subcategory_name string, keywords string")
    index = LabelIndex(labels, ["the"])
    monkeypatch.setattr(fx, "prompts", lambda *_: prompts)
    monkeypatch.setattr(queries, "_index", lambda *_: index)
    routed = queries._routed(spark, "none")
    assert "jersey" not in plan_of(routed) and [r.prompt_id for r in routed.collect()] == [1]


def test_a_fit_runs_over_large_blocks():
    assert learning._log_loss(1).getMaxBlockSizeInMB() == learning.BLOCK_MB > 1
