import pytest

from checks.compare import compare, duck
from checks.oracle import ORACLE
from checks.queries import QUERIES

SF = "/root/testdata/sf0.001"
ROWS_ONLY = {
    "rescue_model", "rescue_sweep", "keyword_mining", "intent_train", "intent_score", "intent_categories",
    "discover_topics",
}
QUICK = [
    "normalize", "truncate_50", "char_wb_ngrams", "title_case", "garbage_reason_counts", "tech_rescue",
    "lang_profile", "term_freq", "route_official", "upsert_daily_counts", "auto_grade", "smart_rename",
    "rebuild_keywords_v2", "translate_terms", "renumber", "taxonomy_health",
]


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", QUICK)
def test_query_agrees_with_its_sql(spark, con, name):
    agrees, detail = compare(spark, con, SF, name)
    assert agrees, detail


def test_every_query_has_sql_but_the_models():
    assert set(QUERIES) - set(ORACLE) == ROWS_ONLY
    assert set(ORACLE) <= set(QUERIES)
