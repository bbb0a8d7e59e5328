from pyspark.sql import functions as F

from topicloom.functions import fixed_values as fv, text as tx
from topicloom.operators import gates, language


def test_gate_reasons(texts):
    rows = [
        "call TriggerDagRunOperator now",
        "café budget",
        "Jersey, please",
        "δδδδδδ wide",
        "plain english text",
        "jerseys are fine",
    ]
    found = texts(*rows).select("prompt_id", gates.drop_reason(F.col("raw_text")).alias("r")).orderBy("prompt_id")
    assert [r.r for r in found.collect()] == [
        "signature", "mojibake", "garbage_word", "non_ascii", None, None,
    ]
    counts = {r.drop_reason: r.n for r in gates.reason_counts(texts(*rows)).collect()}
    assert sum(counts.values()) == len(rows) and counts["kept"] == 2


def test_unicode_gate_limits(apply):
    rows = ["é" * 5 + "a" * 15, "é" * 6 + "a" * 34, "é" * 6 + "a" * 35, "é" * 6 + "a" * 33]
    assert apply(gates.unicode_gate, *rows) == [False, False, False, True]


def test_tech_rescue(apply):
    short, long = "select * from server_logs", "select * from server_logs ".ljust(150, "x")
    assert apply(lambda t: gates.tech_rescue(t, F.lit("it")), short, long, "ciao") == ["en", "it", "it"]
    assert apply(lambda t: gates.tech_rescue(t, F.lit("unknown")), short) == ["unknown"]


def test_detection_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    profiles = language.learn_profiles(docs.filter("doc_id % 5 <> 0"))
    held_out = docs.filter("doc_id % 5 = 0")
    found = language.detect(held_out, profiles, "doc_id", "text").join(held_out, "doc_id")
    assert found.count() == held_out.count()
    assert found.filter("language = lang").count() / found.count() > 0.95


def test_memo_gives_the_same_answers_with_a_hot_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    profiles = language.learn_profiles(docs).persist()
    base = docs.select(F.col("doc_id").alias("prompt_id"), F.substring("text", 1, 200).alias("raw_text"))
    hot = spark.range(10_000, 14_000).select(
        F.col("id").alias("prompt_id"), F.lit("the same question again and again").alias("raw_text")
    )
    rows = base.unionByName(hot).unionByName(
        spark.createDataFrame([(20_000, "12 34")], "prompt_id long, raw_text string")
    )
    direct = {
        r.prompt_id: r.language for r in language.detect(rows, profiles).collect()
    }
    memo = {r.prompt_id: r.language for r in language.detect_distinct(rows, profiles).collect()}
    assert len(memo) == rows.count()
    assert all(memo[k] == direct.get(k, "unknown") for k in memo)


def test_router_takes_another_detector(texts):
    rows = texts("bonjour tout le monde", "sql error", "δδδδδδδδ")
    routed = language.route_languages(
        rows, detector=lambda df: df.select("prompt_id", F.lit("fr").alias("language"))
    )
    assert {r.prompt_id: r.language for r in routed.collect()} == {0: "fr", 1: "en", 2: "unknown"}


def test_noise_characters(texts):
    found = language.unicode_noise(texts("a–b é", "é→"))
    assert [r.ch for r in found.collect()] == ["é", "–", "→"]


def test_texts_are_moved_once_and_read_once(spark, texts):
    profiles = language.learn_profiles(spark.createDataFrame([("the cat and the dog", "en"), ("der hund und die katze", "de")], "text string, lang string"))
    rows = texts("the dog", "die katze", "", None, "123").withColumn("other", F.lit(1)).union(
        spark.createDataFrame([(None, "the cat", 2)], "prompt_id long, raw_text string, other int")
    )
    routed = language.route_languages(rows, profiles)
    found = [(r.raw_text, r.language) for r in routed.collect()]
    assert sorted(found, key=str) == sorted(
        [("the dog", "en"), ("die katze", "de"), ("", "unknown"), (None, "unknown"), ("123", "unknown"), ("the cat", "unknown")], key=str
    )
    plan = spark._jvm.PythonSQLUtils.explainString(routed._jdf.queryExecution(), "simple")
    final = plan.split("== Initial Plan")[0]
    assert final.count("Exchange hashpartitioning(_key") == 2 and final.count("ReusedExchange") >= 1


def test_sums_by_word_equal_the_join_with_all_windows(spark, monkeypatch):
    profiles = language.learn_profiles(spark.createDataFrame([("the cat and the dog", "en"), ("der hund und die katze", "de")], "text string, lang string"))
    rows = spark.createDataFrame(
        [(1, "The DOG and\tcat"), (2, ""), (3, None), (4, "  hund  "), (4, "die katze"), (None, "the"), (5, " x　y z")],
        "prompt_id long, raw_text string",
    )
    by_word = language.detect(rows, profiles)
    plan = spark._jvm.PythonSQLUtils.explainString(by_word._jdf.queryExecution(), "simple")
    assert "Generate" not in plan
    monkeypatch.setattr(language, "HELD_GRAMS", 0)
    joined = language.detect(rows, profiles)
    assert sorted(map(tuple, by_word.collect())) == sorted(map(tuple, joined.collect()))


def test_rules_by_scan_equal_rules_by_word(apply, spark):
    rows = ["zz", "zzz", "a-zz.", "INGLÉS", "xinglés", "zz_", "é zz1", "bars", "", None]
    word = lambda t: F.arrays_overlap(tx.word_set(t), F.array(*map(F.lit, dict.fromkeys(fv.GARBAGE_WORDS))))
    assert apply(gates.has_garbage_word, *rows) == apply(word, *rows)
    assert apply(tx.non_ascii_count, "é a€😀b", "", "abc", None) == [3, 0, 0, None]
    plan = spark._jvm.PythonSQLUtils.explainString(
        spark.range(1).select(gates.has_garbage_word(F.col("id").cast("string")))._jdf.queryExecution(), "simple"
    )
    assert "arrays_overlap" not in plan
