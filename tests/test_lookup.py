import pyarrow as pa
import pytest

from topicloom.operators import lookup, similarity as sim
from topicloom.operators.similarity import LabelIndex
from topicloom.plans import routing

LABELS = [
    (0, 0, "Data", 0, "Querying", "sql select join table"),
    (1, 0, "Data", 1, "Spreadsheets", "excel pivot chart table table"),
    (2, 1, "Cloud", 2, "Containers", "kubernetes docker container pod"),
    (3, 1, "Cloud", 3, "Only stopwords", "the of and"),
    (4, 1, "Cloud", 4, "Single", "terraform"),
    (4, 1, "Cloud", 4, "Twice", "terraform module state"),
    (None, 1, "Cloud", 5, "No row", "docker join"),
]
SCHEMA = (
    "tax_idx int, category_id int, category_name string, subcategory_id int, "
    "subcategory_name string, keywords string"
)
ROWS = [
    (1, "sql select join the table table"), (2, "docker pod in kubernetes cluster, docker"), (1, "excel select table"),
    (None, "terraform docker pod"), (3, ""), (4, None), (None, "sql join"), (5, "ÜBER the container"), (1, "sql　join"),
]


@pytest.fixture(scope="module")
def indexes(spark):
    labels = spark.createDataFrame(LABELS, SCHEMA)
    held, joined = LabelIndex(labels, ["the", "of", "and"]), LabelIndex(labels, ["the", "of", "and"])
    joined.__dict__["held"] = None
    return held, joined


def rows(df):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()), key=str)


@pytest.mark.parametrize("job", ["cosine_word", "cosine_char", "cosine_blend", "overlap_pairs", "masked_similarity"])
def test_held_index_gives_the_rows_of_the_joins(spark, indexes, job):
    prompts = routing.prepare(spark.createDataFrame(ROWS, "prompt_id long, raw_text string"))
    held, joined = (rows(getattr(sim, job)(prompts, index)) for index in indexes)
    assert held and held == joined


def test_distinct_overlap_of_a_held_index(spark, indexes):
    prompts = routing.prepare(spark.createDataFrame(ROWS, "prompt_id long, raw_text string"))
    held, joined = (rows(sim.masked_similarity(prompts, index, distinct_overlap=True)) for index in indexes)
    assert held == joined


@pytest.mark.parametrize("job", ["cosine_word", "cosine_char", "cosine_blend", "overlap_pairs", "masked_similarity"])
def test_terms_are_no_rows(texts, indexes, job):
    plan = getattr(sim, job)(routing.prepare(texts("sql join")), indexes[0])
    text = plan.sparkSession._jvm.PythonSQLUtils.explainString(plan._jdf.queryExecution(), "simple")
    assert "Generate" not in text and "Join" not in text


@pytest.mark.parametrize("kind", ["word", "char", "blend", "overlap", "masked"])
def test_pieces_do_not_change_the_sums(indexes, monkeypatch, kind):
    ids = [None, None, 1, 1, 1, 2, 3]
    tokens = [["sql", "join"], ["docker"], ["sql"], ["select", "join"], ["table"], None, ["terraform", "pod"]]
    text = [t and " ".join(t) for t in tokens]
    batch = pa.RecordBatch.from_arrays([pa.array(ids), pa.array(tokens), pa.array(text)], names=["id", "t", "l"])

    def run(size):
        monkeypatch.setattr(lookup, "PIECE", size)
        monkeypatch.setattr(lookup, "PRODUCTS", 3 * size)
        found = sim._Held(*indexes[0].held.value, kind).scores(iter([batch.slice(0, 4), batch.slice(4)]))
        out = [tuple(round(v, 9) if isinstance(v, float) else v for v in r.values()) for b in found for r in b.to_pylist()]
        return sorted(out, key=str)

    assert run(1) == run(2) == run(100)


def test_window_counts():
    counts = lookup.WindowCounts([" ab", "abc", "ab "], 3, 5)
    text, term, tf = counts.of(pa.array(["abc ab", None, "", "ab　ab"]))
    assert list(zip(text, term, tf)) == [(0, 0, 2), (0, 1, 1), (0, 2, 1), (3, 0, 2), (3, 2, 2)]


def test_word_counts():
    counts = lookup.WordCounts(["b a", "a", "c d"])
    text, term, tf = counts.of(pa.array([["b", "a", "b", "a"], None, [], ["a", "x", "c"], ["d"]]))
    assert list(zip(text, term, tf)) == [(0, 0, 2), (0, 1, 2), (3, 1, 1)]
