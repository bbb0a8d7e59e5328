"""Row-wise text functions: Column in, Column out, all JVM side.

Word characters are spelled out as letters, numbers and underscore, because the
``\\w`` of Java, RE2 and Python differ outside ASCII.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, functions as F

from topicloom.functions import fixed_values as fv

WORD = r"\p{L}\p{N}_"
NOT_AFTER_WORD = rf"(?<![{WORD}])"
NOT_BEFORE_WORD = rf"(?![{WORD}])"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times inside one expression."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def find_all(text: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def strip(text: Column) -> Column:
    """Cut all Unicode white space at both ends (``trim`` cuts blanks only)."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def split_words(text: Column) -> Column:
    """White-space separated words; an empty text has none."""
    return F.filter(F.split(text, r"(?U)\s+"), lambda w: w != "")


def truncate_words(text: Column, limit: int = fv.MAX_WORDS) -> Column:
    """The first ``limit`` words joined by blanks; shorter texts stay as they are."""
    return let(
        split_words(text),
        lambda words: F.when(
            F.size(words) > limit, F.array_join(F.slice(words, 1, limit), " ")
        ).otherwise(text),
    )


def strip_phrases(text: Column, phrases: Iterable[str] = fv.STOP_PHRASES) -> Column:
    """Remove whole-word phrases in any case.

    One alternation in list order gives the same text as one pass per phrase: a
    removed phrase leaves non-word characters on both sides, so it never joins
    its neighbours into another phrase.
    """
    alternatives = "|".join(phrases)
    return F.regexp_replace(
        text, f"(?iu){NOT_AFTER_WORD}(?:{alternatives}){NOT_BEFORE_WORD}", ""
    )


def mask_amounts(text: Column) -> Column:
    """Replace any number, with its currency sign and code, by the amount mask."""
    signs = "|".join("\\" + s if s == "$" else s for s in fv.CURRENCY_SIGNS)
    codes = "|".join(fv.CURRENCY_CODES)
    pattern = (
        rf"(?iu)(?:{signs})?\p{{Nd}}+(?:,\p{{Nd}}{{3}})*(?:\.\p{{Nd}}{{2}})?"
        rf"(?U:\s)?(?:{codes})?"
    )
    return F.regexp_replace(text, pattern, fv.AMOUNT_MASK)


def mask_cards(text: Column) -> Column:
    """Replace a free-standing group of exactly four digits by the card mask."""
    return F.regexp_replace(
        text, rf"{NOT_AFTER_WORD}\p{{Nd}}{{4}}{NOT_BEFORE_WORD}", fv.CARD_MASK
    )


def collapse_spaces(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def strip_edge_punctuation(text: Column) -> Column:
    return F.regexp_replace(text, rf"(?U)^[^{WORD}\s]+|[^{WORD}\s]+$", "")


def normalize(text: Column, card_mask_first: bool = False) -> Column:
    """Phrases, masks, white space, edge punctuation; a missing text becomes empty.

    The amount mask takes every digit run, so the card mask after it finds
    nothing.  ``card_mask_first`` runs it before the amounts instead.
    """
    masks = (mask_cards, mask_amounts) if card_mask_first else (mask_amounts, mask_cards)
    steps = (strip_phrases, *masks, collapse_spaces, strip_edge_punctuation, F.trim)
    return reduce(lambda t, step: step(t), steps, F.coalesce(text, F.lit("")))


def word_set(text: Column) -> Column:
    """Distinct lower-case words."""
    return F.array_distinct(find_all(F.lower(text), f"[{WORD}]+"))


def latin_word_set(text: Column) -> Column:
    return F.array_distinct(find_all(F.lower(text), fv.LATIN_WORD_PATTERN))


def non_ascii_count(text: Column) -> Column:
    return F.length(F.regexp_replace(text, r"[\x00-\x7F]+", ""))


def non_ascii_ratio(text: Column) -> Column:
    return F.when(F.length(text) > 0, non_ascii_count(text) / F.length(text)).otherwise(F.lit(0.0))


def tokens(text: Column) -> Column:
    """Lower-case words of two characters or more, repeats kept."""
    return find_all(F.lower(text), f"[{WORD}]{{2,}}")


def without_words(words: Column, stopwords: Iterable[str]) -> Column:
    """Drop listed words, keeping repeats; ``isin`` over literals is one hash lookup per word."""
    stop = list(stopwords)
    return F.filter(words, lambda w: ~w.isin(stop)) if stop else words


def word_ngrams(words: Column, low: int = 1, high: int = 2) -> Column:
    """Blank-joined runs of ``low`` to ``high`` neighbouring words."""

    def runs(ws: Column, n: int) -> Column:
        if n == 1:
            return ws
        return F.transform(
            F.slice(ws, F.lit(n), F.greatest(F.size(ws) - n + 1, F.lit(0))),
            lambda _, i: F.array_join(F.slice(ws, i + 1, F.lit(n)), " "),
        )

    return let(words, lambda ws: F.concat(*[runs(ws, n) for n in range(low, high + 1)]))


def char_ngrams(text: Column, low: int = 3, high: int = 5) -> Column:
    """Character windows inside blank-padded words.

    In a text padded and separated by single blanks these are the windows whose
    inner characters are no blanks, which one look-ahead per length finds in
    linear time.  The dot after it moves on by one whole code point.
    """
    padded = F.concat(
        F.lit(" "), F.trim(F.regexp_replace(F.lower(text), r"(?U)\s+", " ")), F.lit(" ")
    )
    return let(
        padded,
        lambda p: F.concat(
            *[find_all(p, f"(?s)(?=(.[^ ]{{{n - 2}}}.)).", 1) for n in range(low, high + 1)]
        ),
    )


def term_counts(terms: Column) -> Column:
    """``array<struct<term, tf>>`` of a bag of terms, in the row and so without a shuffle.

    Equal terms are neighbours once sorted, so each run's length is its count.
    """

    def runs(s: Column) -> Column:
        starts = F.filter(
            F.sequence(F.lit(0), F.size(s) - 1),
            lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)),
        )
        return let(
            starts,
            lambda st: F.transform(
                st,
                lambda start, k: F.struct(
                    F.get(s, start).alias("term"),
                    (F.coalesce(F.get(st, k + 1), F.size(s)) - start).alias("tf"),
                ),
            ),
        )

    return let(
        F.sort_array(terms),
        lambda s: F.when(F.size(s) > 0, runs(s)).otherwise(
            F.array().cast("array<struct<term:string,tf:int>>")
        ),
    )


def title_case(text: Column) -> Column:
    """Upper-case each letter that follows a non-letter, lower-case the other letters."""
    return F.array_join(F.transform(find_all(text, r"\p{L}+|[^\p{L}]+"), F.initcap), "")


def distinct_words(text: Column) -> Column:
    """Ordered distinct words, the first occurrence kept."""
    return F.array_join(F.array_distinct(split_words(text)), " ")


def letter_words(text: Column) -> Column:
    """Lower-case words after every character but ASCII letters became a blank."""
    return split_words(F.regexp_replace(F.lower(text), "[^a-z]", " "))


def non_ascii_chars(text: Column) -> Column:
    """Distinct non-ASCII characters of a text, white space left out."""
    return F.filter(
        F.array_distinct(find_all(text, r"[^\x00-\x7F]")), lambda c: strip(c) != ""
    )


def contains_any(text: Column, parts: Iterable[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(p)) for p in parts])


def contains_all(text: Column, parts: Iterable[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.contains(text, F.lit(p)) for p in parts])


def sublinear(tf: Column) -> Column:
    return 1.0 + F.log(tf.cast("double"))
