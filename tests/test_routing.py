import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from topicloom.operators import learning, report, similarity as sim, terms
from topicloom.operators.similarity import LabelIndex
from topicloom.plans import routing

LABELS = [
    (0, 0, "Data", 0, "Querying", "sql select join table"),
    (1, 0, "Data", 1, "Spreadsheets", "excel pivot chart"),
    (2, 1, "Cloud", 2, "Containers", "kubernetes docker container pod"),
    (3, 1, "Cloud", 3, "Only stopwords", "the of and"),
    (4, 1, "Cloud", 4, "Single", "terraform"),
]
SCHEMA = (
    "tax_idx int, category_id int, category_name string, subcategory_id int, "
    "subcategory_name string, keywords string"
)
STOP = ["the", "of", "and"]


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(LABELS, SCHEMA)


@pytest.fixture(scope="module")
def index(labels):
    return LabelIndex(labels, STOP)


def prepared(texts, *rows):
    return routing.prepare(texts(*rows))


def bag(text):
    words = [w for w in text.split() if len(w) > 1 and w not in STOP]
    return Counter(words + [f"{a} {b}" for a, b in zip(words, words[1:])])


def chars(text):
    out = []
    for w in text.split():
        p = f" {w} "
        out += [p[i : i + n] for n in (3, 4, 5) for i in range(len(p) - n + 1)]
    return Counter(out)


def brute(rows, counter):
    """Dense reference: every text against every label."""
    docs = [counter(l[5]) for l in LABELS]
    df = Counter(t for d in docs for t in d)
    idf = {t: math.log((1 + len(docs)) / (1 + n)) + 1 for t, n in df.items()}

    def vector(c):
        v = {t: (1 + math.log(n)) * idf[t] for t, n in c.items() if t in idf}
        length = math.sqrt(sum(x * x for x in v.values())) or 1
        return {t: x / length for t, x in v.items()}

    tax = [vector(d) for d in docs]
    return [[sum(x * t.get(k, 0) for k, x in vector(counter(r)).items()) for t in tax] for r in rows]


ROWS = [
    "sql select join the table",
    "sql sql",
    "docker pod in kubernetes cluster",
    "terraform",
    "excel chart of sales",
    "nothing in common qqq",
    "and",
]


def test_masked_similarity_equals_the_dense_product(texts, index):
    pairs = sim.masked_similarity(prepared(texts, *ROWS), index).collect()
    found = {(r.prompt_id, r.tax_idx): r.sim for r in pairs}
    word, char = brute(ROWS, bag), brute(ROWS, chars)
    expected = {}
    for i, row in enumerate(ROWS):
        counts = Counter(w for w in row.split() if len(w) > 1)
        for j, label in enumerate(LABELS):
            own = Counter(w for w in label[5].split() if w not in STOP)
            if sum(counts[w] * n for w, n in own.items()) >= min(2, sum(own.values())):
                expected[i, j] = (word[i][j] + char[i][j]) / 2
    assert found.keys() == expected.keys()
    assert all(abs(found[k] - expected[k]) < 1e-9 for k in found)
    assert all(-1e-9 <= s <= 1 + 1e-9 for s in found.values())


def test_overlap_rules(texts, index):
    def passing(**options):
        rows = sim.overlap_pairs(prepared(texts, "sql sql", "sql", "terraform"), index, **options).collect()
        return {(r.prompt_id, r.tax_idx) for r in rows if r.tax_idx != 3}

    assert passing() == {(0, 0), (2, 4)}
    assert passing(distinct_overlap=True) == {(2, 4)}


def test_label_without_terms_meets_every_text(texts, index):
    pairs = sim.overlap_pairs(prepared(texts, *ROWS), index).filter("tax_idx = 3")
    assert pairs.count() == len(ROWS)


def test_naive_blend_agrees_on_surviving_pairs(texts, index):
    rows = prepared(texts, *ROWS)
    blend = {(r.prompt_id, r.tax_idx): r.sim for r in sim.cosine_blend(rows, index).collect()}
    for r in sim.masked_similarity(rows, index).collect():
        assert abs(blend.get((r.prompt_id, r.tax_idx), 0.0) - r.sim) < 1e-9


def test_ties_go_to_the_lower_row(spark):
    pairs = spark.createDataFrame([(1, 7, 0.5), (1, 3, 0.5), (1, 9, 0.2)], "prompt_id long, tax_idx int, sim double")
    assert sim.best_label(pairs).collect()[0].tax_idx == 3
    assert [r.tax_idx for r in sim.top_labels(pairs, 2).orderBy("rank").collect()] == [3, 7]


def test_route_assigns_every_prompt_once(texts, index, labels):
    routed = routing.route(prepared(texts, *ROWS), index)
    rows = {r.prompt_id: r for r in routed.collect()}
    assert len(rows) == len(ROWS)
    assert rows[0].subcategory_name == "Querying" and rows[0].route == "official"
    assert rows[5].route == "other" and rows[5].category_id == 2 and rows[5].subcategory_id == 9999
    assert routing.label_mapping(routed, labels).count() == len(LABELS) + 1
    only_hits = routed.filter("route = 'official'")
    assert routing.label_mapping(only_hits, labels).count() == len(LABELS)


def test_threshold(texts, index):
    rows = prepared(texts, *ROWS)
    low = routing.official_hits(rows, index, threshold=0.0).count()
    high = routing.official_hits(rows, index, threshold=0.99).count()
    assert high < routing.official_hits(rows, index).count() <= low


def test_result_does_not_depend_on_partitions(texts, index):
    rows = prepared(texts, *ROWS)
    one, many = (
        {tuple(r) for r in routing.official_hits(rows, index, partitions=n).collect()} for n in (1, 7)
    )
    assert one == many


def test_one_text_shuffle_in_the_plan(texts, index):
    plan = sim.masked_similarity(prepared(texts, *ROWS), index)
    text = plan.sparkSession._jvm.PythonSQLUtils.explainString(plan._jdf.queryExecution(), "simple")
    own = [l for l in text.split("== Initial Plan")[0].splitlines() if "Exchange hashpartitioning(prompt_id" in l]
    assert own and all("REPARTITION_BY_COL" in l for l in own)


def test_centroid_hits_weigh_texts_in_the_tasks(spark, index, monkeypatch):
    words = ["sql join tables", "docker pod cluster", "pivot chart excel", "join select", "pod restart", "chart of sales", ""]
    rows = [(i if i % 9 else None, f"{words[i % 7]} {words[i % 5]}") for i in range(60)] + [(1, "sql again"), (2, None)]
    frame = spark.createDataFrame(rows, "prompt_id long, processed_text string")

    def found():
        return sorted(((r.prompt_id, r.tax_idx, round(r.score, 9)) for r in routing.centroid_hits(frame, index, confident=0.05).collect()), key=str)

    def joined(texts, id_col, text_col, spaces, sublinear, max_terms):
        own = terms.tfidf(texts, id_col, spaces["word"](F.col(text_col)), sublinear, max_terms)
        return own.withColumn("space", F.lit("word"))

    with monkeypatch.context() as m:
        m.setattr(terms, "held_tfidf", joined)
        want = found()
    monkeypatch.setattr(terms, "tfidf", lambda *a: pytest.fail("a row per term of every text before the vocabulary is known"))
    assert want and found() == want


def test_rescue_lowers_the_other_share(texts, index):
    hits = ["sql select join table now", "docker container pod kubernetes", "select sql table join rows",
            "kubernetes pod docker cluster", "excel pivot chart sales", "pivot chart excel month"] * 3
    rest = ["joined rows from tables", "dockerized cluster", "charts for sales month"]
    rows = prepared(texts, *hits, *rest)
    found = routing.official_hits(rows, index).filter("tax_idx <> 3")
    model = learning.fit_rescue(rows, found, STOP, max_terms=500, max_iter=10)
    left = rows.join(found, "prompt_id", "left_anti")
    rescued = learning.rescue(left, model.linear)
    routed = routing.route(rows, index, rescued)
    summary = routing.route_summary(routed).collect()[0]
    assert summary.n_other == 0 and summary.n_prompts == len(hits) + len(rest)
    labels_found = {r.prompt_id: r.tax_idx for r in rescued.collect()}
    assert labels_found[len(hits) + 1] == 2


def test_no_model_from_a_single_label(texts, index):
    rows = prepared(texts, "sql select join", "other words")
    hits = rows.select("prompt_id", F.lit(0).alias("tax_idx")).limit(1)
    assert learning.fit_rescue(rows, hits, STOP) is None


def test_counts(texts, index):
    routed = routing.route(prepared(texts, *ROWS), index)
    counts = report.category_counts(routed).collect()
    assert sum(r.Count for r in counts) == len(ROWS)
    assert [r.category_id for r in counts] == sorted(r.category_id for r in counts)
    totals = {r.category_id: r.n for r in report.category_totals(routed).collect()}
    assert all(r["Total count for category"] == totals[r.category_id] for r in counts)
