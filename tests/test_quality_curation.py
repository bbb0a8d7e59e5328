import pytest
from pyspark.sql import functions as F

from topicloom.functions import fixed_values as fv
from topicloom.operators import curation, learning, quality


def labels(spark, *rows):
    return spark.createDataFrame(
        [(i, *r) for i, r in enumerate(rows)],
        "tax_idx int, category_id int, category_name string, subcategory_id int, subcategory_name string, keywords string",
    )


def named(spark, *names, keywords=None):
    return labels(spark, *[(0, "Software Engineering & Development", i, n, keywords) for i, n in enumerate(names)])


def names_of(df):
    return [r.subcategory_name for r in df.orderBy("tax_idx").collect()]


def keywords_of(df):
    return [r.keywords for r in df.orderBy("tax_idx").collect()]


def test_sample_holds_all_small_groups_and_repeats(spark):
    rows = spark.range(1000).select(
        F.col("id").alias("prompt_id"),
        F.when(F.col("id") < 3, "small").otherwise("hot").alias("subcategory_name"),
        F.lit("C").alias("category_name"),
        F.lit("t").alias("truncated_prompt"),
    )
    draw = lambda n: {r.prompt_id for r in quality.stratified_sample(rows.repartition(n)).collect()}
    assert len(draw(3)) == 8 and {0, 1, 2} <= draw(3) and draw(3) == draw(11)
    plan = quality.stratified_sample(rows)
    text = spark._jvm.PythonSQLUtils.explainString(plan._jdf.queryExecution(), "simple")
    assert "WindowGroupLimit" in text and "Partial" in text
    golden = quality.golden_set(rows, cap=6)
    assert golden.count() == 6 and quality.golden_accuracy(golden).collect()[0].ungraded


def test_purity_equals_mean_distance(spark):
    weights = spark.createDataFrame(
        [(i, "a", 0.6) for i in range(5)] + [(i, "b", 0.8) for i in range(5)] + [(5, "c", 1.0)],
        "prompt_id long, term string, weight double",
    )
    rows = spark.createDataFrame([(i, "L") for i in range(7)] + [(7, "M")] * 1, "prompt_id long, subcategory_name string")
    found = {r.subcategory_name: r for r in quality.purity(weights, rows).collect()}
    assert set(found) == {"L"}
    c = (5 * 0.6 / 7, 5 * 0.8 / 7, 1 / 7)
    length = sum(x * x for x in c) ** 0.5
    near = (0.6 * c[0] + 0.8 * c[1]) / length
    expected = (5 * (1 - near) + (1 - c[2] / length) + 1) / 7
    assert abs(found["L"].distance - expected) < 1e-12 and found["L"].n == 7


def test_grading(spark):
    df = spark.createDataFrame([("Lounge access", "Error Codes"), ("refund", "Risk"), ("x", None)], "p string, s string")
    assert [r[0] for r in df.select(quality.auto_grade(F.col("p"), F.col("s"))).collect()] == [0, 1, 1]


def test_renames(spark):
    df = named(spark, "Growth Plan", "one two three four five", "memory_leak  cpu cpu extra", "Sql & Row")
    assert names_of(curation.rename_with_suffix(df)) == [
        "Growth Plan Database Querying and Analytics",
        "one two three four five",
        "memory_leak  cpu cpu extra Issue Troubleshooting and Debugging",
        "Sql & Row Database Querying and Analytics",
    ]
    assert names_of(curation.smart_rename(df))[2] == "Memory Leak Cpu Error Triage"
    stripped = curation.strip_suffix(named(spark, "Memory Leak Error Triage", "Error Triage", "Triage Notes"))
    assert names_of(stripped) == ["Memory Leak", "Error Triage", "Triage Notes"]
    renames = spark.createDataFrame([("Old Name", "New & Name")], "name string, new_name string")
    assert names_of(curation.rename_by_map(named(spark, "Old Name", "end of", "state OF the"), renames)) == [
        "New & Name", "End", "State Of",
    ]


def test_cluster_names(spark):
    df = spark.createDataFrame([(["docker", "pod", "env", "x"],), (["zzz"],)], "w array<string>")
    assert [r[0] for r in df.select(curation.cluster_name(F.col("w"))).collect()] == [
        "Auto Cluster: Docker Pod Env Cloud Infrastructure", "Auto Cluster: Zzz Strategic Planning",
    ]


def test_keyword_jobs(spark):
    patched = curation.patch_keywords(named(spark, "Stacktrace Error Triage", "Budget Financial Strategy", "None", keywords="k"))
    assert keywords_of(patched) == ["k badrequest conferma poid cdn fail issue", "k aml privileged fins stock", "k"]
    assert keywords_of(curation.dedupe_keywords(named(spark, "n", keywords="Sql sql JOIN join x"))) == ["sql join x"]
    assert keywords_of(curation.dedupe_keywords(named(spark, "n"))) == [""]
    assert keywords_of(curation.rebuild_keywords(named(spark, "Code & the CI/CD code"))) == [
        "software engineering development code ci cd"
    ]
    rebuilt = curation.rebuild_keywords_from_names(
        named(spark, "Code Changes Required", "plain name", keywords="Software sql sql")
    )
    assert names_of(rebuilt) == ["Code Review & Changes", "Plain Name"]
    assert keywords_of(rebuilt) == [
        "sql code review changes git commit push pull request merge conflict diff review", "sql plain name",
    ]
    injected = curation.inject_keywords(named(spark, "Git Version Control", "Other", keywords="git x"))
    assert keywords_of(injected) == ["git x commit push pull branch merge repository clone pr conflict", "git x"]


def with_core(df, *core):
    return df.withColumn("is_core", F.col("tax_idx").isin(list(core)))


def test_similar_labels_match_brute_force(spark):
    rows = [(0, "C", i, f"n{i}", " ".join(f"w{(i * k) % 7}" for k in range(1, 6))) for i in range(12)]
    weights = curation.label_weights(labels(spark, *rows)).persist()
    vectors = {}
    for r in weights.collect():
        vectors.setdefault(r.tax_idx, {})[r.term] = r.weight
    for limit in (0.1, 0.5, 0.9):
        expected = {
            (a, b)
            for a in vectors for b in vectors
            if a < b and round(sum(x * vectors[b].get(t, 0) for t, x in vectors[a].items()), 9) >= limit
        }
        assert {(r.a, r.b) for r in curation.similar_labels(weights, limit).collect()} == expected


def test_anchor_merge_and_limit(spark):
    rows = [
        (0, "C", 0, "core", "sql join table"), (0, "C", 1, "near", "sql join rows"),
        (0, "C", 2, "far", "docker pod"), (0, "C", 3, "core two", "sql join table"),
    ]
    df = with_core(labels(spark, *rows), 0, 3)
    merged = curation.anchor_merge(df)
    assert names_of(merged) == ["core", "far", "core two"]
    assert keywords_of(merged) == ["join rows sql table", "docker pod", "sql join table"]
    done = curation.consolidate(df, limit=2)
    assert names_of(done) == ["core", "core two"]
    assert names_of(curation.consolidate(df, limit=20)) == ["core", "far", "core two"]


def test_compression_prefers_short_names_and_reaches_the_limit(spark):
    rows = [(0, "C", i, "a longer name" if i == 0 else f"n{i}", f"w{i // 2} w{i // 2}x own{i}") for i in range(6)]
    done = curation.consolidate(with_core(labels(spark, *rows)), limit=3)
    assert done.count() == 3 and names_of(done)[0] == "n1"
    apart = [(0, "C", i, f"n{i}", f"only{i}") for i in range(5)]
    assert curation.consolidate(with_core(labels(spark, *apart)), limit=2).count() == 2


def test_renumber(spark):
    df = with_core(labels(spark, *[(i % 3, "C", 99, f"n{i}", "") for i in range(40)]), 7, 8)
    rows = curation.renumber(df, F.desc("is_core"), "category_id", "tax_idx").orderBy("subcategory_id").collect()
    assert [r.subcategory_id for r in rows] == list(range(40))
    assert [(not r.is_core, r.category_id, r.tax_idx) for r in rows] == sorted(
        (not r.is_core, r.category_id, r.tax_idx) for r in rows
    )


def test_keyword_ranking(spark):
    weights = spark.createDataFrame(
        [(0, "abc", 9.0), (0, "sql join", 8.0), (0, "k8s pod", 7.0), (5, "unknown label", 1.0)],
        "subcategory_id int, term string, coef double",
    )
    assert keywords_of(learning.rank_keywords(weights, named(spark, "n", "m", keywords="zeta join"))) == [
        "join sql zeta", "zeta join",
    ]


def test_translation(spark):
    df = spark.createDataFrame([("Mot de passe de la carte",)], "t string")
    done = curation.translate_terms(df, {"mot de passe": "password", "carte": "card"}, "t")
    assert done.collect()[0].translated == "password de la card"


def test_mining_and_intent_models(spark, tmp_path):
    rows = [(i, ["restart the docker pod", "join sql tables"][i % 2] + f" number{i % 5}", i % 2) for i in range(60)]
    df = spark.createDataFrame(rows, "prompt_id long, raw_text string, subcategory_id int")
    mined = learning.mine_keywords(df, named(spark, "pods", "queries", keywords="old"), max_iter=10)
    found = {r.subcategory_name: set(r.keywords.split()) for r in mined.collect()}
    assert {"docker", "restart", "old"} <= found["pods"] and {"join", "tables"} <= found["queries"]
    model = learning.fit_intent(df, "prompt_id", "raw_text", "subcategory_id", max_iter=10)
    model.save(str(tmp_path / "m"))
    scored = learning.IntentModel.load(spark, str(tmp_path / "m")).score(df, "prompt_id", "raw_text")
    right = scored.withColumnRenamed("subcategory_id", "found").join(df, "prompt_id")
    assert right.count() == 60 and right.filter("found <> subcategory_id").count() == 0
    assert right.filter("p < 0.5 OR p > 1").count() == 0
