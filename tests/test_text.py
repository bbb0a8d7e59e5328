import re

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from topicloom.functions import text as tx


def test_normalize_edge_rows(apply):
    cases = {
        "Please advise on refund of $1,250.00 USD, thanks": "on refund of <AMOUNT",
        "card 1234 help": "card <AMOUNT",
        "100 apples": "AMOUNT>apples",
        "v2 rollout 2024-06-15": "v<AMOUNT>rollout <AMOUNT>-<AMOUNT>-<AMOUNT",
        "URGENT!!!": "",
        "pls pls": "",
        "": "",
        "thanksgiving helpful": "thanksgiving helpful",
        "¿qué pasa?": "qué pasa",
        "two\t words": "two words",
    }
    assert apply(tx.normalize, *cases) == list(cases.values())
    assert apply(tx.normalize, None) == [""]


def test_card_mask_fires_only_when_first(apply):
    assert apply(tx.mask_cards, "card 1234 or 12345, 9999") == [
        "card <CARD_DIGITS> or 12345, <CARD_DIGITS>"
    ]
    assert apply(lambda t: tx.normalize(t, card_mask_first=True), "card 1234 x") == [
        "card <CARD_DIGITS> x"
    ]


def test_truncation_keeps_short_texts_as_they_are(apply):
    short, long = "a  b " + " ".join("w" * 48), "a  b " + " ".join("w" * 49)
    assert apply(tx.truncate_words, short, long) == [short, " ".join(long.split()[:50])]


def test_title_case(apply):
    cases = ["don't CI/CD c++", "memory_leak CPU", "3d API", "élan vital"]
    assert apply(tx.title_case, *cases) == [c.title() for c in cases]


def windows(text, low=3, high=5):
    out = []
    for word in text.lower().split():
        padded = f" {word} "
        for n in range(low, high + 1):
            out += [padded[i : i + n] for i in range(len(padded) - n + 1)]
    return sorted(out)


def test_char_ngrams_match_plain_python(apply):
    cases = ["x yy", "", "Hello  World", "a 😀b 😀😀 c", "naïve café\tß"]
    found = apply(tx.char_ngrams, *cases)
    assert [sorted(f) for f in found] == [windows(c) for c in cases]


def test_tokens_and_ngrams(apply):
    assert apply(tx.tokens, "Café x² a_b I/O 12") == [["café", "x²", "a_b", "12"]]
    grams = apply(lambda t: tx.word_ngrams(tx.tokens(t), 1, 3), "aa bb cc", "aa", "")
    assert grams == [["aa", "bb", "cc", "aa bb", "bb cc", "aa bb cc"], ["aa"], []]


def test_term_counts(apply):
    counts = apply(lambda t: tx.term_counts(tx.tokens(t)), "bb aa bb cc bb", "")
    assert [[(c.term, c.tf) for c in row] for row in counts] == [
        [("aa", 1), ("bb", 3), ("cc", 1)],
        [],
    ]


def test_stopwords_keep_repeats(apply):
    kept = apply(lambda t: tx.without_words(tx.tokens(t), ["the"]), "the cat the cat")
    assert kept == [["cat", "cat"]]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet=st.sampled_from("ab1 9.$,é-\tpls"), max_size=30), min_size=20, max_size=40))
def test_normalize_properties(spark, rows):
    df = spark.createDataFrame(list(enumerate(rows)), "i int, t string")
    for (value,) in df.select(tx.normalize(F.col("t"))).collect():
        assert value == value.strip()
        assert not re.search(r"\d", value)
        assert "  " not in value
