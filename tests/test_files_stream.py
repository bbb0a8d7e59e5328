import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from topicloom.operators import language, report
from topicloom.operators.similarity import LabelIndex
from topicloom.sources import files, sinks
from topicloom.streaming import daily_stream


def test_read_prompts_skips_only_a_header(spark, tmp_path):
    (tmp_path / "a.txt").write_text("\nprompt_text\n first \n\nprompt\n", encoding="utf-8")
    (tmp_path / "b.txt").write_text("no header here\nprompt\n", encoding="utf-8")
    rows = files.read_prompts(spark, str(tmp_path / "*.txt"))
    found = sorted((r.file_name, r.raw_text) for r in rows.collect())
    assert found == [("a.txt", "first"), ("a.txt", "prompt"), ("b.txt", "no header here"), ("b.txt", "prompt")]
    assert rows.select("prompt_id").distinct().count() == 4


def test_first_existing(spark, tmp_path):
    (tmp_path / "p.csv").write_text("x\n")
    assert files.first_existing(spark, str(tmp_path / "p.txt"), str(tmp_path / "p.csv")).endswith("p.csv")
    with pytest.raises(FileNotFoundError):
        files.first_existing(spark, str(tmp_path / "none.txt"))


def test_file_date(spark):
    names = spark.createDataFrame([("cleaned_prompts_2026-06-15.txt",)], "n string")
    assert names.select(files.file_date(F.col("n"))).collect()[0][0] == dt.date(2026, 6, 15)
    with pytest.raises(Exception, match="no YYYY-MM-DD date"):
        spark.createDataFrame([("x.txt",)], "n string").select(files.file_date(F.col("n"))).collect()


def test_required_columns(spark):
    with pytest.raises(ValueError, match="missing columns"):
        files.require_columns(spark.range(1), "truncated_prompt")


def test_csv_quotes_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([('say "hi", then', 'a\\b'), ("multi\nline", "x")], "a string, b string")
    sinks.write_csv(rows, str(tmp_path / "c"))
    back = files.read_csv(spark, str(tmp_path / "c"), rows.schema, multi_line=True)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))


def test_labels_and_dictionary_files(spark, tmp_path):
    path = tmp_path / "labels.csv"
    path.write_text("category_id,category_name,subcategory_id,subcategory_name,keywords\n0,A,5,B,x y\n1,C,6,D,\n")
    rows = files.read_labels(spark, str(path)).orderBy("tax_idx").collect()
    assert [(r.tax_idx, r.subcategory_name, r.keywords) for r in rows] == [(0, "B", "x y"), (1, "D", None)]
    (tmp_path / "d.json").write_text('{"passwort": "password", "mot de passe": "password"}', encoding="utf-8")
    terms = {r.term: r.english for r in files.read_dictionary(spark, str(tmp_path / "d.json")).collect()}
    assert terms == {"passwort": "password", "mot de passe": "password"}
    (tmp_path / "w.txt").write_text("kindly\n\nplease\n")
    assert files.read_word_list(spark, str(tmp_path / "w.txt")) == ["kindly", "please"]


def test_routed_line_files(spark, tmp_path):
    rows = spark.createDataFrame([("hi", "en"), ("salut", "fr")], "raw_text string, language string")
    sinks.write_routed_lines(rows, str(tmp_path / "en"), str(tmp_path / "other"))
    assert [r.value for r in spark.read.text(str(tmp_path / "en")).collect()] == ["hi"]
    assert [r.value for r in spark.read.text(str(tmp_path / "other")).collect()] == ["[fr] salut"]


def counts(spark, *rows):
    return spark.createDataFrame(
        [(dt.date.fromisoformat(d), c, s, n) for d, c, s, n in rows],
        "date date, category string, sub_category string, count long",
    )


def test_upsert_keeps_missing_and_replaces_changed(spark, tmp_path):
    store = str(tmp_path / "store")
    first = counts(spark, ("2026-06-15", "A", "x", 1), ("2026-06-15", "A", "y", 2), ("2026-06-16", "A", "x", 9))
    again = counts(spark, ("2026-06-15", "A", "x", 5), ("2026-06-15", "B", "z", 3))
    sinks.upsert_counts(first, store)
    for _ in range(2):
        sinks.upsert_counts(again, store)
        found = {(str(r.date), r.category, r.sub_category): r["count"] for r in sinks.read_counts(spark, store).collect()}
        assert found == {
            ("2026-06-15", "A", "x"): 5, ("2026-06-15", "A", "y"): 2,
            ("2026-06-15", "B", "z"): 3, ("2026-06-16", "A", "x"): 9,
        }


def test_upsert_is_a_set_operation(spark):
    merged = report.upsert(counts(spark, ("2026-06-15", "A", "x", 1)), counts(spark, ("2026-06-15", "A", "x", 0)))
    assert merged.collect()[0]["count"] == 0


def test_stream_equals_batch_and_takes_each_file_once(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    profiles = language.learn_profiles(docs)
    labels = spark.createDataFrame(
        [(0, 0, "C0", 0, "S0", "that with this from"), (1, 1, "C1", 1, "S1", "here there heed ering")],
        "tax_idx int, category_id int, category_name string, subcategory_id int, subcategory_name string, keywords string",
    )
    index = LabelIndex(labels, [])
    lines = [r.t for r in docs.filter("lang = 'en'").select(F.explode(F.split("text", "\n")).alias("t")).collect()]
    inbox, checkpoint = tmp_path / "inbox", str(tmp_path / "check")
    inbox.mkdir()
    stream, batch = str(tmp_path / "stream"), str(tmp_path / "batch")
    for day, part in (("2026-06-15", lines[:300]), ("2026-06-16", lines[300:500])):
        path = inbox / f"cleaned_prompts_{day}.txt"
        path.write_text("\n".join(part), encoding="utf-8")
        daily_stream.run(spark, str(inbox), stream, index, profiles, checkpoint)
        daily_stream.run_file(spark, str(path), batch, index, profiles)
    rows = lambda store: sorted(tuple(r) for r in sinks.read_counts(spark, store).select("date", "category", "sub_category", "count").collect())
    assert rows(stream) == rows(batch) and len(rows(stream)) >= 4
    assert daily_stream.daily_file("/in", dt.date(2026, 6, 15)) == "/in/cleaned_prompts_2026-06-15.txt"


def test_golden_set_is_built_once_and_grades_are_merged_by_rule(spark, tmp_path):
    from topicloom.functions import fixed_values as fv
    from topicloom.operators import quality

    path = str(tmp_path / "golden")
    schema = f"prompt_id long, prompt string, category_name string, `{fv.GRADE_COLUMN}` int"
    golden = spark.createDataFrame([(i, f"p{i}", "C", 1 if i == 5 else None) for i in range(6)], schema)
    with pytest.raises(ValueError):
        sinks.read_version(spark, path)
    # A build that broke off leaves files without the mark of a finished write.
    golden.limit(1).write.parquet(f"{path}/version-1")
    os.remove(f"{path}/version-1/_SUCCESS")
    assert sinks.build_once(golden, path) and not sinks.build_once(golden.limit(0), path)
    stored = sinks.read_version(spark, path)
    assert stored.count() == 6
    grades = [(0, 1, 1), (0, 2, 0), (1, 2, 1), (1, 2, 0), (2, 1, 1), (2, 3, None), (3, 1, 7), (99, 1, 0), (None, 1, 0)]
    merged = quality.merge_grades(stored, spark.createDataFrame(grades, "prompt_id long, graded_at int, grade int"))
    assert {r.prompt_id: r[fv.GRADE_COLUMN] for r in merged.collect()} == {0: 0, 1: 0, 2: 1, 3: None, 4: None, 5: 1}
    assert sinks.build_once(merged, path, 2)
    row = quality.golden_accuracy(sinks.read_version(spark, path)).first()
    assert (row.n_rows, row.n_graded, row.accuracy) == (6, 4, 0.5)
    assert sinks.read_version(spark, path, 1).filter(f"`{fv.GRADE_COLUMN}` is not null").count() == 1
