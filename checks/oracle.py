"""Independent SQL for the checks, written from the definitions, for DuckDB."""

from __future__ import annotations

from checks import fixtures as fx
from topicloom.functions import fixed_values as fv

ORACLE: dict[str, str] = {}

W = r"\pL\pN_"
S = r"\t-\r\x{85}\pZ"


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def arr(words) -> str:
    return "[" + ", ".join(lit(w) for w in words) + "]"


def sub(text: str, pattern: str, to: str, flags: str = "g") -> str:
    return f"regexp_replace({text}, {lit(pattern)}, {lit(to)}, {lit(flags)})"


def spaced(text: str) -> str:
    return f"trim({sub(text, f'[{S}]+', ' ')})"


def phrases_out(text: str) -> str:
    pattern = rf"(^|[^{W}])(?:{'|'.join(fv.STOP_PHRASES)})($|[^{W}])"
    return sub(sub(text, pattern, r"\1\2", "gi"), pattern, r"\1\2", "gi")


def amounts(text: str) -> str:
    return sub(
        text,
        rf"(\$|€|£|¥)?\p{{Nd}}+(,\p{{Nd}}{{3}})*(\.\p{{Nd}}{{2}})?[{S}]?(usd|eur|gbp|jpy|cny)?",
        "<AMOUNT>",
        "gi",
    )


def cards(text: str) -> str:
    pattern = rf"(^|[^{W}])\p{{Nd}}{{4}}($|[^{W}])"
    return sub(sub(text, pattern, r"\1<CARD_DIGITS>\2"), pattern, r"\1<CARD_DIGITS>\2")


def edges(text: str) -> str:
    return sub(sub(text, f"^[^{W}{S}]+", ""), f"[^{W}{S}]+$", "")


def normal(text: str) -> str:
    return f"trim({edges(spaced(amounts(phrases_out(text))))})"


def words_of(text: str) -> str:
    """White-space separated words as a list."""
    return f"list_filter(string_split({spaced(text)}, ' '), lambda w: w <> '')"


def truncated(text: str) -> str:
    return (
        f"CASE WHEN len({words_of(text)}) > 50 "
        f"THEN array_to_string(({words_of(text)})[1:50], ' ') ELSE {text} END"
    )


def found(text: str, pattern: str) -> str:
    return f"regexp_extract_all({text}, {lit(pattern)})"


def token_list(text: str) -> str:
    return found(f"lower({text})", f"[{W}]{{2,}}")


def kept_tokens(text: str) -> str:
    return f"list_filter({token_list(text)}, lambda w: NOT list_contains({arr(fv.ENGLISH_STOPWORDS)}, w))"


def non_ascii(text: str) -> str:
    return f"length({sub(text, r'[\x00-\x7F]', '')})"


def joined(words: str) -> str:
    return f"array_to_string({words}, '|')"


def grams(a: str, high: int) -> str:
    parts = [a]
    if high >= 2:
        parts.append(f"list_transform(range(1, len({a})), lambda i: {a}[i] || ' ' || {a}[i+1])")
    if high >= 3:
        parts.append(
            f"list_transform(range(1, len({a}) - 1), lambda i: {a}[i] || ' ' || {a}[i+1] || ' ' || {a}[i+2])"
        )
    out = parts[0]
    for p in parts[1:]:
        out = f"list_concat({out}, {p})"
    return out


def with_(*ctes: tuple[str, str]) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({body})" for name, body in ctes)


PROMPTS = (
    "prompts",
    f"""
SELECT doc_id * 10000 + pos AS prompt_id, lang,
       DATE '{fx.FIRST_DAY}' + CAST(doc_id % 7 AS INTEGER) AS date,
       CASE (doc_id + pos) % 8
         WHEN 0 THEN 'Please advise ' || line        WHEN 1 THEN line || ' thanks in advance'
         WHEN 2 THEN line || ' costs $1,250.00 USD'  WHEN 3 THEN 'sql error in table users ' || line
         WHEN 4 THEN line || ' 100 items ref 2024'   WHEN 5 THEN line || ' triggerdagrunoperator'
         WHEN 6 THEN line || ' jersey bars'          ELSE line END AS raw_text
FROM (SELECT doc_id, lang, pos, trim(a[pos + 1]) AS line
      FROM (SELECT doc_id, lang, a, unnest(range(len(a))) AS pos
            FROM (SELECT doc_id, lang, string_split(text, chr(10)) AS a FROM documents)))
WHERE line <> ''""",
)
TAXONOMY = (
    "taxonomy",
    """
SELECT CAST(item_id AS INTEGER) AS tax_idx, CAST(item_id % 8 AS INTEGER) AS category_id,
       'Category ' || (item_id % 8) AS category_name, CAST(item_id AS INTEGER) AS subcategory_id,
       'Topic ' || item_id AS subcategory_name,
       array_to_string(list_sort(list_distinct(regexp_extract_all(lower(text), '[a-z]{4,}'))), ' ')
         AS keywords
FROM benchmark""",
)


def text_oracle(name: str, expression: str) -> None:
    ORACLE[name] = f"{with_(PROMPTS)} SELECT prompt_id, {expression} AS value FROM prompts"


T = "raw_text"
text_oracle("truncate_50", truncated(T))
text_oracle("strip_phrases", phrases_out(T))
text_oracle("mask_amounts", amounts(T))
text_oracle("mask_card", cards(T))
text_oracle("normalize", normal(T))
text_oracle("word_set", joined(f"list_sort(list_distinct({found(f'lower({T})', f'[{W}]+')}))"))
text_oracle(
    "latin_word_set", joined(f"list_sort(list_distinct({found(f'lower({T})', '[a-záéíóúñäöüß]+')}))")
)
text_oracle("tokens", joined(token_list(T)))
text_oracle("remove_stopwords", joined(kept_tokens(T)))
ORACLE["word_ngrams"] = f"""{with_(PROMPTS, ("k", f"SELECT prompt_id, {kept_tokens(T)} AS a FROM prompts"))}
SELECT prompt_id, {joined(f"list_sort({grams('a', 3)})")} AS value FROM k"""
text_oracle(
    "title_case",
    "array_to_string(list_transform("
    + found(T, r"\pL+|[^\pL]+")
    + ", lambda p: (CASE WHEN p[1] = 'ß' THEN 'Ss' ELSE upper(p[1]) END) || lower(p[2:])), '')",
)
ORACLE["ordered_distinct_words"] = f"""{with_(PROMPTS, ("k", f"SELECT prompt_id, {words_of(T)} AS a FROM prompts"))}
SELECT prompt_id, array_to_string(list_filter(a, lambda x, i: list_position(a, x) = i), ' ') AS value FROM k"""

CHAR_WORDS = "SELECT {id}, ' ' || w || ' ' AS p FROM (SELECT {id}, unnest(string_split({spaced}, ' ')) AS w FROM {src}) WHERE w <> ''"


def char_rows(id_col: str, text: str, src: str, low: int = 3, high: int = 5) -> str:
    """One row per character window of every padded word."""
    lengths = ", ".join(f"({n})" for n in range(low, high + 1))
    padded = CHAR_WORDS.format(id=id_col, spaced=spaced(f"lower({text})"), src=src)
    return (
        f"SELECT {id_col}, substr(p, i, n) AS term FROM "
        f"(SELECT {id_col}, p, n, unnest(range(1, length(p) - n + 2)) AS i "
        f"FROM ({padded}) CROSS JOIN (VALUES {lengths}) AS v(n))"
    )


ORACLE["char_wb_ngrams"] = f"""{with_(PROMPTS)}
SELECT prompt_id, coalesce(value, '') AS value FROM prompts LEFT JOIN
  (SELECT prompt_id, string_agg(term, '|' ORDER BY term) AS value
   FROM ({char_rows('prompt_id', T, 'prompts')}) GROUP BY prompt_id) USING (prompt_id)"""

ORACLE["non_ascii_stats"] = f"""{with_(PROMPTS)}
SELECT prompt_id, CAST({non_ascii(T)} AS BIGINT) AS n_non_ascii,
       round({non_ascii(T)} / length(raw_text), 6) AS ratio FROM prompts"""

# --- gates ------------------------------------------------------------------

SIGNATURE = "(" + " OR ".join(f"contains(lower({T}), {lit(s)})" for s in fv.GARBAGE_SIGNATURES) + ")"
MOJIBAKE = "(" + " OR ".join(f"contains(lower({T}), {lit(s)})" for s in fv.MOJIBAKE_CHARS) + ")"
GARBAGE_WORD = f"list_has_any({found(f'lower({T})', f'[{W}]+')}, {arr(fv.GARBAGE_WORDS)})"
MANY = f"({non_ascii(T)} > 5)"
UNICODE = f"({non_ascii(T)} > 5 AND {non_ascii(T)} / length({T}) > 0.15)"

for _name, _broken in [
    ("drop_signatures", SIGNATURE),
    ("drop_mojibake", MOJIBAKE),
    ("drop_garbage_words", GARBAGE_WORD),
    ("drop_non_ascii", MANY),
    ("unicode_gate", UNICODE),
    ("garbage_gate", f"({SIGNATURE} OR {MOJIBAKE} OR {GARBAGE_WORD} OR {MANY})"),
]:
    ORACLE[_name] = f"{with_(PROMPTS)} SELECT prompt_id, raw_text FROM prompts WHERE NOT {_broken}"

ORACLE["garbage_reason_counts"] = f"""{with_(PROMPTS)}
SELECT CASE WHEN {SIGNATURE} THEN 'signature' WHEN {MOJIBAKE} THEN 'mojibake'
            WHEN {GARBAGE_WORD} THEN 'garbage_word' WHEN {MANY} THEN 'non_ascii' ELSE 'kept' END
         AS drop_reason, count(*) AS n
FROM prompts GROUP BY 1"""


def rescued(language: str) -> str:
    return (
        f"CASE WHEN {language} NOT IN ('en', 'unknown') AND length({T}) < 150 "
        f"AND list_has_any({found(f'lower({T})', '[a-záéíóúñäöüß]+')}, {arr(fv.TECH_WORDS)}) "
        f"THEN 'en' ELSE {language} END"
    )


ORACLE["tech_rescue"] = f"{with_(PROMPTS)} SELECT prompt_id, {rescued('lang')} AS language FROM prompts"

# --- language ---------------------------------------------------------------

PROFILE = [
    ("doc_grams", char_rows("doc_id", "text", "documents", 2, 3)),
    ("gram_n", "SELECT lang, term AS gram, count(*) AS n FROM doc_grams JOIN documents USING (doc_id) GROUP BY ALL"),
    ("gram_total", "SELECT lang, sum(n) AS total FROM gram_n GROUP BY lang"),
    (
        "profile",
        "SELECT lang, gram, n, ln(1 + n / total / 5e-5) AS logp FROM "
        "(SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, gram) AS r FROM gram_n) "
        "JOIN gram_total USING (lang)",
    ),
]
DETECT = [
    PROMPTS,
    *PROFILE,
    ("prompt_grams", char_rows("prompt_id", T, "prompts", 2, 3)),
    (
        "scores",
        "SELECT prompt_id, lang AS language, round(sum(logp), 6) AS score "
        "FROM prompt_grams JOIN profile ON term = gram GROUP BY ALL",
    ),
    (
        "detected",
        "SELECT prompt_id, language, score FROM scores "
        "QUALIFY row_number() OVER (PARTITION BY prompt_id ORDER BY score DESC, language DESC) = 1",
    ),
]
ORACLE["lang_profile"] = f"{with_(*PROFILE)} SELECT lang, gram, n, round(logp, 6) AS logp FROM profile"
ORACLE["lang_detect"] = f"{with_(*DETECT)} SELECT prompt_id, language, score FROM detected"
ORACLE["dedup_then_detect"] = f"""{with_(*DETECT)}
SELECT prompt_id, coalesce(language, 'unknown') AS language FROM prompts LEFT JOIN detected USING (prompt_id)"""
ROUTED_LANGUAGES = [
    *DETECT,
    (
        "routed",
        f"SELECT prompt_id, raw_text, date, {rescued('language')} AS language FROM "
        f"(SELECT prompt_id, raw_text, date, CASE WHEN {UNICODE} THEN 'unknown' "
        f"ELSE coalesce(language, 'unknown') END AS language "
        f"FROM prompts LEFT JOIN detected USING (prompt_id))",
    ),
]
_routed = with_(*ROUTED_LANGUAGES)
ORACLE["route_languages"] = f"{_routed} SELECT prompt_id, raw_text, language FROM routed"
ORACLE["lang_split"] = f"{_routed} SELECT prompt_id, language = 'en' AS is_english FROM routed"
ORACLE["english_prompts"] = f"{_routed} SELECT prompt_id, raw_text AS value FROM routed WHERE language = 'en'"
ORACLE["non_english_tagged"] = (
    f"{_routed} SELECT prompt_id, '[' || language || '] ' || raw_text AS value FROM routed WHERE language <> 'en'"
)
ORACLE["lang_counts"] = f"{_routed} SELECT language, count(*) AS n FROM routed GROUP BY 1"
ORACLE["unicode_noise"] = f"""{_routed}
SELECT DISTINCT ch FROM (SELECT unnest(string_split(raw_text, '')) AS ch FROM routed WHERE language = 'en')
WHERE unicode(ch) > 127 AND NOT regexp_matches(ch, '^[{S}]$')"""

# --- terms ------------------------------------------------------------------

PREPARED = (
    "prepared",
    f"SELECT prompt_id, raw_text, date, cut AS truncated_prompt, {normal('cut')} AS processed_text "
    f"FROM (SELECT *, {truncated(T)} AS cut FROM prompts "
    f"WHERE NOT ({SIGNATURE} OR {MOJIBAKE} OR {GARBAGE_WORD} OR {MANY}))",
)
DESCRIBED = ("described", f"SELECT *, {normal('keywords')} AS processed_desc FROM taxonomy")


def counted(id_col: str, text: str, src: str, high: int = 2, stop: bool = True) -> str:
    a = kept_tokens(text) if stop else token_list(text)
    return (
        f"SELECT {id_col}, term, count(*) AS tf FROM "
        f"(SELECT {id_col}, unnest({grams('a', high)}) AS term FROM (SELECT {id_col}, {a} AS a FROM {src})) "
        f"GROUP BY ALL"
    )


def char_counted(id_col: str, text: str, src: str) -> str:
    return f"SELECT {id_col}, term, count(*) AS tf FROM ({char_rows(id_col, text, src)}) GROUP BY ALL"


def vocab(counts: str, src: str, cap: int | None = None) -> str:
    cut = f"ORDER BY total_tf DESC, term LIMIT {cap}" if cap else ""
    return (
        f"SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS total_tf, "
        f"ln((1 + (SELECT count(*) FROM {src})) / (1 + count(*))) + 1 AS idf FROM {counts} GROUP BY term {cut}"
    )


def weighed(counts: str, voc: str, id_col: str, sublinear: bool = True) -> str:
    tf = "(1 + ln(tf))" if sublinear else "tf"
    return (
        f"SELECT {id_col}, term, w / sqrt(sum(w * w) OVER (PARTITION BY {id_col})) AS weight FROM "
        f"(SELECT {id_col}, term, {tf} * idf AS w FROM {counts} JOIN {voc} USING (term))"
    )


P_COUNTS = ("p_counts", counted("prompt_id", "processed_text", "prepared"))
P_VOCAB = ("p_vocab", vocab("p_counts", "prepared"))
L_COUNTS = ("l_counts", counted("tax_idx", "processed_desc", "described"))
L_VOCAB = ("l_vocab", vocab("l_counts", "described", 50000))

ORACLE["term_freq"] = f"{with_(PROMPTS, PREPARED, P_COUNTS)} SELECT prompt_id, term, tf FROM p_counts"
ORACLE["idf_taxonomy"] = (
    f"{with_(TAXONOMY, DESCRIBED, L_COUNTS, L_VOCAB)} SELECT term, df, round(idf, 6) AS idf FROM l_vocab"
)
ORACLE["idf_corpus"] = (
    f"{with_(PROMPTS, PREPARED, P_COUNTS, P_VOCAB)} SELECT term, df, round(idf, 6) AS idf FROM p_vocab"
)
ORACLE["vocab_top_n"] = f"""{with_(PROMPTS, PREPARED, P_COUNTS, ("v", vocab("p_counts", "prepared", 500)))}
SELECT term, df, total_tf FROM v"""
ORACLE["tfidf_weights"] = f"""{with_(PROMPTS, PREPARED, P_COUNTS, P_VOCAB,
    ("w", weighed("p_counts", "p_vocab", "prompt_id")))} SELECT prompt_id, term, round(weight, 6) AS weight FROM w"""
ORACLE["tfidf_plain"] = f"""{with_(PROMPTS, PREPARED, ("c", counted("prompt_id", "processed_text", "prepared", 1)),
    ("v", vocab("c", "prepared", 5000)), ("w", weighed("c", "v", "prompt_id", False)))}
SELECT prompt_id, term, round(weight, 6) AS weight FROM w"""
L_UNI = (
    "l_uni",
    "SELECT tax_idx, term, tf FROM ("
    + counted("tax_idx", "processed_desc", "described", 1, False)
    + ") WHERE term IN (SELECT term FROM l_vocab)",
)
P_UNI = ("p_uni", counted("prompt_id", "processed_text", "prepared", 1, False))
ORACLE["vocab_counts"] = f"""{with_(PROMPTS, PREPARED, TAXONOMY, DESCRIBED, L_COUNTS, L_VOCAB, L_UNI, P_UNI)}
SELECT prompt_id, term, tf FROM p_uni WHERE term IN (SELECT term FROM l_uni)"""
ORACLE["feature_union"] = f"""{with_(PROMPTS, PREPARED, P_COUNTS,
    ("wv", vocab("p_counts", "prepared", 10000)), ("ww", weighed("p_counts", "wv", "prompt_id")),
    ("cc", char_counted("prompt_id", "processed_text", "prepared")),
    ("cv", vocab("cc", "prepared", 10000)), ("cw", weighed("cc", "cv", "prompt_id")))}
SELECT prompt_id, 'word' AS space, term, round(weight, 6) AS weight FROM ww
UNION ALL SELECT prompt_id, 'char' AS space, term, round(weight, 6) AS weight FROM cw"""

# --- similarity and routing ---------------------------------------------------


def dotted(name: str, p_counts: str, l_counts: str, l_vocab: str) -> list[tuple[str, str]]:
    return [
        (f"{name}_l", weighed(l_counts, l_vocab, "tax_idx")),
        (f"{name}_p", weighed(p_counts, l_vocab, "prompt_id")),
        (
            name,
            f"SELECT prompt_id, tax_idx, sum(a.weight * b.weight) AS sim "
            f"FROM {name}_p a JOIN {name}_l b USING (term) GROUP BY ALL",
        ),
    ]


WORD_SIM = [PROMPTS, PREPARED, TAXONOMY, DESCRIBED, P_COUNTS, L_COUNTS, L_VOCAB,
            *dotted("sim_word", "p_counts", "l_counts", "l_vocab")]
CHAR_SIM = [
    ("pc_counts", char_counted("prompt_id", "processed_text", "prepared")),
    ("lc_counts", char_counted("tax_idx", "processed_desc", "described")),
    ("lc_vocab", vocab("lc_counts", "described", 40000)),
    *dotted("sim_char", "pc_counts", "lc_counts", "lc_vocab"),
]
BLEND = [
    *WORD_SIM,
    *CHAR_SIM,
    (
        "blend",
        "SELECT prompt_id, tax_idx, (coalesce(a.sim, 0) + coalesce(b.sim, 0)) / 2 AS sim "
        "FROM sim_word a FULL JOIN sim_char b USING (prompt_id, tax_idx)",
    ),
]
MASK = [
    L_UNI,
    P_UNI,
    ("need", "SELECT tax_idx, least(2, coalesce(t, 0)) AS required FROM taxonomy LEFT JOIN "
             "(SELECT tax_idx, sum(tf) AS t FROM l_uni GROUP BY 1) USING (tax_idx)"),
    ("shared", "SELECT prompt_id, tax_idx, CAST(sum(a.tf * b.tf) AS BIGINT) AS overlap "
               "FROM p_uni a JOIN l_uni b USING (term) GROUP BY ALL"),
    ("mask", "SELECT prompt_id, tax_idx, coalesce(overlap, 0) AS overlap FROM prepared CROSS JOIN need "
             "LEFT JOIN shared USING (prompt_id, tax_idx) WHERE coalesce(overlap, 0) >= required"),
]
MASKED = [
    *BLEND,
    *MASK,
    ("masked", "SELECT prompt_id, tax_idx, coalesce(sim, 0) AS sim FROM mask LEFT JOIN blend USING (prompt_id, tax_idx)"),
    ("ranked", "SELECT prompt_id, tax_idx, round(sim, 9) AS score, row_number() OVER "
               "(PARTITION BY prompt_id ORDER BY round(sim, 9) DESC, tax_idx) AS rank FROM masked"),
]
ROUTED = [
    *MASKED,
    ("hits", "SELECT prompt_id, tax_idx, score FROM ranked WHERE rank = 1 AND score >= 0.04"),
    (
        "labelled",
        "SELECT prompt_id, raw_text, truncated_prompt, date, "
        "coalesce(category_id, (SELECT max(category_id) + 1 FROM taxonomy)) AS category_id, "
        "coalesce(category_name, 'Other/Miscellaneous') AS category_name, "
        "coalesce(subcategory_id, 9999) AS subcategory_id, "
        "coalesce(subcategory_name, 'Uncategorized Garbage') AS subcategory_name, "
        "CASE WHEN score IS NULL THEN 'other' ELSE 'official' END AS route "
        "FROM prepared LEFT JOIN hits USING (prompt_id) LEFT JOIN taxonomy USING (tax_idx)",
    ),
]
PAIR = "SELECT prompt_id, tax_idx, round(sim, 6) AS sim"
ORACLE["cosine_word"] = f"{with_(*WORD_SIM)} {PAIR} FROM sim_word"
ORACLE["cosine_char"] = f"{with_(PROMPTS, PREPARED, TAXONOMY, DESCRIBED, *CHAR_SIM)} {PAIR} FROM sim_char"
ORACLE["cosine_blend"] = f"{with_(*BLEND)} {PAIR} FROM blend"
ORACLE["overlap_mask"] = f"""{with_(PROMPTS, PREPARED, TAXONOMY, DESCRIBED, L_COUNTS, L_VOCAB, *MASK)}
SELECT prompt_id, tax_idx, overlap FROM mask"""
ORACLE["masked_similarity"] = f"{with_(*MASKED)} {PAIR} FROM masked"
ORACLE["route_argmax"] = (
    f"{with_(*MASKED)} SELECT prompt_id, tax_idx, round(score, 6) AS score FROM ranked WHERE rank = 1"
)
ORACLE["route_top_k"] = (
    f"{with_(*MASKED)} SELECT prompt_id, tax_idx, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank "
    f"FROM ranked WHERE rank <= 3"
)
ORACLE["route_official"] = f"""{with_(*ROUTED)}
SELECT prompt_id, tax_idx, round(score, 6) AS score, category_id, category_name, subcategory_id, subcategory_name
FROM hits JOIN taxonomy USING (tax_idx)"""
LABELS = "category_id, category_name, subcategory_id, subcategory_name"
ORACLE["assign_other"] = f"{with_(*ROUTED)} SELECT prompt_id, {LABELS}, route FROM labelled"
ORACLE["taxonomy_mapping"] = f"""{with_(*ROUTED)} SELECT {LABELS} FROM taxonomy
UNION ALL SELECT DISTINCT {LABELS} FROM labelled WHERE route = 'other'"""
ORACLE["route_summary"] = f"""{with_(*ROUTED)}
SELECT count(*) AS n_prompts, count(*) FILTER (route <> 'other') AS n_routed,
       count(*) FILTER (route = 'other') AS n_other,
       round(avg(CASE WHEN route <> 'other' THEN 1.0 ELSE 0.0 END) * 100, 6) AS pct_routed,
       round(avg(CASE WHEN route = 'other' THEN 1.0 ELSE 0.0 END) * 100, 6) AS pct_other
FROM labelled"""

# --- reports and sinks --------------------------------------------------------

ORACLE["category_counts"] = f"""{with_(*ROUTED)}
SELECT {LABELS}, count(*) AS "Count",
       CAST(sum(count(*)) OVER (PARTITION BY category_id) AS BIGINT) AS "Total count for category"
FROM labelled GROUP BY {LABELS}"""
ORACLE["category_totals"] = f"{with_(*ROUTED)} SELECT category_id, count(*) AS n FROM labelled GROUP BY 1"
ORACLE["category_rollup"] = f"""{with_(*ROUTED)}
SELECT category_id, subcategory_id, count(*) AS n FROM labelled GROUP BY category_id, subcategory_id
UNION ALL SELECT category_id, NULL, count(*) FROM labelled GROUP BY category_id
UNION ALL SELECT NULL, NULL, count(*) FROM labelled"""

_GATED = f"NOT ({SIGNATURE} OR {MOJIBAKE} OR {GARBAGE_WORD} OR {MANY})"
_DAILY_PREPARED = (
    "prepared",
    f"SELECT prompt_id, raw_text, date, cut AS truncated_prompt, {normal('cut')} AS processed_text "
    f"FROM (SELECT *, {truncated(T)} AS cut FROM routed WHERE language = 'en' AND {_GATED})",
)
_DAILY = [*ROUTED_LANGUAGES, _DAILY_PREPARED, *[c for c in ROUTED if c[0] not in ("prompts", "prepared")]]
ORACLE["daily_counts"] = f"""{with_(*_DAILY)}
SELECT date, category_name AS category, subcategory_name AS sub_category, count(*) AS count
FROM labelled GROUP BY ALL"""
RESCUE = [
    ("wv", vocab("p_counts", "prepared", 10000)), ("ww", weighed("p_counts", "wv", "prompt_id")),
    ("cc", char_counted("prompt_id", "processed_text", "prepared")),
    ("cv", vocab("cc", "prepared", 10000)), ("cw", weighed("cc", "cv", "prompt_id")),
    ("fw", "SELECT prompt_id, 'w' || term AS f, weight FROM ww UNION ALL SELECT prompt_id, 'c' || term, weight FROM cw"),
    ("hn", "SELECT tax_idx, count(*) AS n FROM hits GROUP BY 1"),
    ("co", "SELECT tax_idx, f, 6 * sum(weight) / any_value(n) AS coef FROM fw JOIN hits USING (prompt_id) "
           "JOIN hn USING (tax_idx) GROUP BY tax_idx, f"),
    ("ic", "SELECT tax_idx, n / (SELECT sum(n) FROM hn) - 3 AS b FROM hn"),
    ("missed", "SELECT prompt_id FROM prepared WHERE prompt_id NOT IN (SELECT prompt_id FROM hits)"),
    ("dots", "SELECT prompt_id, tax_idx, sum(weight * coef) AS m FROM missed JOIN fw USING (prompt_id) JOIN co USING (f) GROUP BY ALL"),
    ("shares", "SELECT prompt_id, tax_idx, v, v / sum(v) OVER (PARTITION BY prompt_id) AS p FROM "
               "(SELECT prompt_id, tax_idx, 1 / (1 + exp(-(coalesce(m, 0) + b))) AS v FROM missed CROSS JOIN ic "
               "LEFT JOIN dots USING (prompt_id, tax_idx))"),
    ("rescued", "SELECT * FROM (SELECT prompt_id, tax_idx, p FROM shares QUALIFY "
                "row_number() OVER (PARTITION BY prompt_id ORDER BY round(v, 9) DESC, tax_idx) = 1) WHERE p >= 0.01"),
]
ORACLE["rescue_apply"] = f"""{with_(*ROUTED, *RESCUE)}
SELECT prompt_id, tax_idx, round(p, 6) AS p FROM rescued"""
ORACLE["daily_counts_rescued"] = f"""{with_(*_DAILY, *RESCUE)}
SELECT date, coalesce(l.category_name, 'Other/Miscellaneous') AS category,
       coalesce(l.subcategory_name, 'Uncategorized Garbage') AS sub_category, count(*) AS count
FROM prepared LEFT JOIN (SELECT prompt_id, tax_idx FROM hits UNION ALL SELECT prompt_id, tax_idx FROM rescued) f USING (prompt_id)
LEFT JOIN taxonomy l USING (tax_idx) GROUP BY ALL"""
ORACLE["daily_ingest"] = ORACLE["daily_counts_rescued"]
ORACLE["daily_totals_rescued"] = f"""{with_(*_DAILY)}
SELECT date, count(*) AS count FROM labelled GROUP BY date"""
ORACLE["dictionary_roundtrip"] = """
SELECT 'd''密码 "' || coalesce(source, 'none') || CAST(doc_id % 9 AS VARCHAR) AS term,
arg_max(coalesce(text, ''), doc_id) AS english FROM documents GROUP BY ALL"""
_REASON = (
    f"CASE WHEN {SIGNATURE} THEN 'signature' WHEN {MOJIBAKE} THEN 'mojibake' "
    f"WHEN {GARBAGE_WORD} THEN 'garbage_word' WHEN {MANY} THEN 'non_ascii' ELSE 'kept' END"
)
ORACLE["upsert_daily_counts"] = f"""{with_(PROMPTS,
    ("before", f"SELECT date, lang AS category, {_REASON} AS sub_category, count(*) AS n FROM prompts GROUP BY ALL"),
    ("kept", f"SELECT date, lang, count(*) * 2 AS n FROM prompts WHERE {_GATED} GROUP BY ALL"),
    ("after", "SELECT date, lang AS category, 'kept' AS sub_category, n FROM kept UNION ALL "
              "SELECT date, 'all', 'kept', sum(n) FROM kept GROUP BY date"))}
SELECT date, category, sub_category, CAST(n AS BIGINT) AS count FROM after
UNION ALL SELECT date, category, sub_category, n FROM before
WHERE (date, category, sub_category) NOT IN (SELECT (date, category, sub_category) FROM after)"""


def stripped(text: str) -> str:
    return sub(sub(text, f"^[{S}]+", ""), f"[{S}]+$", "")


_LINES = (
    "SELECT doc_id, CAST(pos AS INTEGER) AS pos, " + stripped("a[pos + 1]") + " AS raw_text FROM "
    "(SELECT doc_id, a, unnest(range(len(a))) AS pos FROM "
    "(SELECT doc_id, string_split(body, chr(10)) AS a FROM src))"
)
ORACLE["scan_prompts"] = f"""{with_(("src", "SELECT doc_id, text AS body FROM documents"),
    ("l", _LINES))} SELECT doc_id, pos, raw_text FROM l WHERE raw_text <> ''"""
ORACLE["skip_header"] = f"""{with_(
    ("src", "SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'Prompt_text' || chr(10) "
            "WHEN 1 THEN ' ' || chr(10) || 'prompt text' || chr(10) ELSE '' END || text AS body FROM documents"),
    ("l", _LINES))}
SELECT doc_id, pos, raw_text FROM
  (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS r FROM l WHERE raw_text <> '')
WHERE NOT (r = 1 AND contains(lower(raw_text), 'prompt') AND NOT contains(raw_text, ' '))"""
ORACLE["csv_roundtrip"] = f"""{with_(PROMPTS)}
SELECT prompt_id, 'say "' || raw_text || '", then' AS raw_text FROM prompts"""
ORACLE["date_from_filename"] = f"""
SELECT doc_id, DATE '{fx.FIRST_DAY}' + CAST(doc_id % 7 AS INTEGER) AS date FROM documents"""

# --- quality ------------------------------------------------------------------

_DRAW = "md5(prompt_id || ':42')"
HITS = ("hit_rows", "SELECT * FROM labelled WHERE route <> 'other'")
_STRATA = (
    "strata",
    f"SELECT *, {_DRAW} AS draw FROM hit_rows QUALIFY row_number() OVER "
    f"(PARTITION BY subcategory_name ORDER BY {_DRAW}, prompt_id) <= 5",
)
ORACLE["stratified_sample"] = f"""{with_(*ROUTED, HITS, _STRATA)}
SELECT prompt_id, subcategory_name, truncated_prompt FROM strata"""
ORACLE["golden_set"] = f"""{with_(*ROUTED, HITS, _STRATA)}
SELECT truncated_prompt AS prompt, category_name, subcategory_name, CAST(NULL AS INTEGER) AS "{fv.GRADE_COLUMN}"
FROM strata ORDER BY draw, prompt_id LIMIT 500"""
ORACLE["golden_set_capped"] = ORACLE["golden_set"].replace("LIMIT 500", "LIMIT 60")
ORACLE["math_sample"] = f"""{with_(PROMPTS, PREPARED)}
SELECT prompt_id, truncated_prompt FROM prepared ORDER BY {_DRAW}, prompt_id LIMIT 1000"""
_GRADED = (
    "graded",
    "SELECT prompt_id, lower(raw_text || "
    + arr([" " + a for a, _, _ in fv.GRADE_RULES] + [""])
    + "[prompt_id % 8 + 1]) AS p, lower(['Error Codes', 'Risk', 'Amex API'][prompt_id % 3 + 1]) AS s FROM prompts",
)
_GRADE = "CAST(CASE WHEN contains(p, 'lounge') AND contains(s, 'error') THEN 0 ELSE 1 END AS INTEGER)"
ORACLE["auto_grade"] = f"{with_(PROMPTS, _GRADED)} SELECT prompt_id, {_GRADE} AS grade FROM graded"
ORACLE["golden_flow"] = f"""{with_(*ROUTED, HITS, _STRATA,
    ("chosen", "SELECT *, lower(truncated_prompt) AS p, lower(subcategory_name) AS s FROM strata ORDER BY draw, prompt_id LIMIT 500"))}
SELECT category_name, count(*) AS n_rows, count(g) AS n_graded, round(avg(g), 6) AS accuracy, count(g) = 0 AS ungraded
FROM (SELECT category_name, CASE WHEN prompt_id % 3 = 0 THEN prompt_id % 2 WHEN prompt_id % 5 <> 0 THEN {_GRADE} END AS g FROM chosen)
GROUP BY category_name"""
ORACLE["golden_accuracy"] = f"""{with_(PROMPTS, _GRADED)}
SELECT count(*) AS n_rows, count(g) AS n_graded, round(avg(g), 6) AS accuracy, count(g) = 0 AS ungraded
FROM (SELECT CASE WHEN prompt_id % 5 <> 0 THEN {_GRADE} END AS g FROM graded)"""

PURITY = [
    *ROUTED,
    HITS,
    ("q_counts", counted("prompt_id", "truncated_prompt", "hit_rows", 1)),
    ("q_vocab", vocab("q_counts", "hit_rows", 5000)),
    ("q_weights", weighed("q_counts", "q_vocab", "prompt_id", False)),
    ("q_sizes", "SELECT subcategory_name, count(*) AS n FROM hit_rows GROUP BY 1"),
    (
        "q_centroids",
        "SELECT subcategory_name, term, sum(weight) / any_value(n) AS weight, any_value(n) AS n "
        "FROM q_weights JOIN hit_rows USING (prompt_id) JOIN q_sizes USING (subcategory_name) GROUP BY 1, 2",
    ),
    ("q_lengths", "SELECT subcategory_name, sqrt(sum(weight * weight)) AS len FROM q_centroids GROUP BY 1"),
    (
        "q_cosines",
        "SELECT prompt_id, subcategory_name, sum(w.weight * c.weight) / any_value(len) AS cosine FROM q_weights w "
        "JOIN hit_rows USING (prompt_id) JOIN q_centroids c USING (subcategory_name, term) "
        "JOIN q_lengths USING (subcategory_name) GROUP BY 1, 2",
    ),
    (
        "q_purity",
        "SELECT subcategory_name, round(avg(1 - coalesce(cosine, 0)), 6) AS distance, count(*) AS n "
        "FROM hit_rows LEFT JOIN q_cosines USING (prompt_id, subcategory_name) GROUP BY 1 HAVING count(*) >= 5",
    ),
]
ORACLE["class_centroids"] = f"""{with_(*PURITY)}
SELECT subcategory_name, term, round(weight, 6) AS weight, n FROM q_centroids"""
ORACLE["class_purity"] = f"{with_(*PURITY)} SELECT subcategory_name, distance, n FROM q_purity"
ORACLE["purity_top5"] = f"""{with_(*PURITY)}
SELECT subcategory_name, distance, n, distance > 0.85 AS drift FROM q_purity
ORDER BY distance DESC, subcategory_name LIMIT 5"""
ORACLE["top_terms_per_class"] = f"""{with_(*PURITY)}
SELECT subcategory_name, coalesce(terms, 'empty_cluster') AS terms FROM q_sizes LEFT JOIN
  (SELECT subcategory_name, string_agg(term, '_' ORDER BY r) AS terms FROM
     (SELECT *, row_number() OVER (PARTITION BY subcategory_name ORDER BY round(weight, 9) DESC, term) AS r
      FROM q_centroids) WHERE r <= 2 GROUP BY 1) USING (subcategory_name)"""
ORACLE["centroid_route"] = f"""{with_(*ROUTED,
    ("v", vocab("p_counts", "prepared", 10000)), ("w", weighed("p_counts", "v", "prompt_id")),
    ("sure", "SELECT prompt_id, tax_idx FROM hits WHERE score >= 0.15"),
    ("c", "SELECT tax_idx, term, sum(weight) AS s FROM w JOIN sure USING (prompt_id) GROUP BY ALL"),
    ("cn", "SELECT tax_idx, term, s / sqrt(sum(s * s) OVER (PARTITION BY tax_idx)) AS s FROM c"),
    ("sims", "SELECT prompt_id, tax_idx, round(sum(weight * s), 9) AS score FROM w JOIN cn USING (term) "
             "WHERE prompt_id NOT IN (SELECT prompt_id FROM hits) GROUP BY ALL"))}
SELECT prompt_id, tax_idx, round(score, 6) AS score FROM sims
QUALIFY row_number() OVER (PARTITION BY prompt_id ORDER BY score DESC, tax_idx) = 1"""

# --- curation -------------------------------------------------------------------

CURATION = (
    "labels_in",
    f"""
SELECT CAST(doc_id AS INTEGER) AS tax_idx, CAST(doc_id % 8 AS INTEGER) AS category_id,
       {arr(fx.CURATION_CATEGORIES)}[doc_id % 8 + 1] AS category_name,
       {arr(fx.CURATION_NAMES)}[doc_id % {len(fx.CURATION_NAMES)} + 1]
         || CASE WHEN doc_id % 3 = 0 THEN '' ELSE ' ' || source END AS subcategory_name,
       CASE WHEN doc_id % 5 <> 0 THEN
         array_to_string(list_sort(list_distinct(regexp_extract_all(text, '[A-Za-z]{{3,}}'))), ' ') END AS keywords
FROM documents""",
)
KW = "coalesce(keywords, '')"
NAME = "subcategory_name"


def titled(text: str) -> str:
    return (
        "array_to_string(list_transform("
        + found(text, r"\pL+|[^\pL]+")
        + ", lambda p: upper(p[1]) || lower(p[2:])), '')"
    )


def in_order(words: str) -> str:
    """Ordered distinct: positions of first occurrence."""
    return f"list_filter({words}, lambda x, i: list_position({words}, x) = i)"


def cases(rows, default: str) -> str:
    return "CASE " + " ".join(f"WHEN {c} THEN {v}" for c, v in rows) + f" ELSE {default} END"


def any_of(text: str, needles) -> str:
    return "(" + " OR ".join(f"contains({text}, {lit(n)})" for n in needles) + ")"


def all_of(text: str, needles) -> str:
    return "(" + " AND ".join(f"contains({text}, {lit(n)})" for n in needles) + ")"


def suffix(text: str, rules, default: str) -> str:
    return cases([(any_of(f"lower({text})", words), lit(s)) for words, s in rules], lit(default))


def mapped(table: dict[str, str], key: str, default: str) -> str:
    return cases([(f"{key} = {lit(k)}", lit(v)) for k, v in table.items()], default)


def curated(name: str, name_sql: str, keyword_sql: str, *ctes) -> None:
    src = ctes[-1][0] if ctes else "labels_in"
    ORACLE[name] = (
        f"{with_(CURATION, *ctes)} SELECT tax_idx, {name_sql} AS subcategory_name, {keyword_sql} AS keywords FROM {src}"
    )


curated(
    "patch_keywords",
    NAME,
    cases([(all_of(f"lower({NAME})", p), f"{KW} || {lit(' ' + w)}") for p, w in fv.PATCH_RULES], KW),
)
curated(
    "rename_suffix",
    f"CASE WHEN len({words_of(NAME)}) >= 5 THEN {NAME} ELSE {NAME} || ' ' || "
    f"{suffix(NAME, fv.LONG_SUFFIX_RULES, fv.LONG_SUFFIX_DEFAULT)} END",
    "keywords",
)
_SMART = (
    "smart",
    f"SELECT tax_idx, keywords, array_to_string(({in_order('ws')})[1:3], ' ') || ' ' || "
    f"{suffix('t', fv.SHORT_SUFFIX_RULES, fv.SHORT_SUFFIX_DEFAULT)} AS subcategory_name FROM "
    f"(SELECT *, string_split(t, ' ') AS ws FROM (SELECT *, {titled(f'replace({NAME}, {lit("_")}, {lit(" ")})')} AS t "
    f"FROM labels_in))",
)
curated("smart_rename", NAME, "keywords", _SMART)
curated("strip_suffix", f"trim({sub(NAME, ' (?:' + '|'.join(fv.SHORT_SUFFIXES) + ')$', '')})", "keywords", _SMART)
_LETTERS = (
    "letters",
    "SELECT *, list_concat(" + ", ".join(
        f"list_filter(string_split({sub(f'lower({c})', '[^a-z]', ' ')}, ' '), "
        f"lambda w: w <> '' AND NOT list_contains({arr(fv.NAME_STOPWORDS)}, w))"
        for c in ("category_name", NAME)
    ) + ") AS ws FROM labels_in",
)
curated("rebuild_keywords", NAME, f"array_to_string({in_order('ws')}, ' ')", _LETTERS)


def long_words(text: str) -> str:
    return (
        f"list_filter({words_of(sub(f'lower({text})', f'[^a-z{S}]', ''))}, lambda w: length(w) > 2 "
        f"AND NOT list_contains({arr(fv.ENGLISH_STOPWORDS)}, w))"
    )


_FIXED = ("fixed", f"SELECT * REPLACE ({mapped(fv.NAME_FIXES, NAME, titled(NAME))} AS {NAME}) FROM labels_in")
_REBUILT = (
    "rebuilt",
    f"SELECT *, list_concat(list_filter({words_of(f'lower({KW})')}, "
    f"lambda w: NOT list_contains(parents, w)), own) AS ws FROM "
    f"(SELECT *, {long_words('category_name')} AS parents, {long_words(NAME)} AS own FROM fixed)",
)
curated(
    "rebuild_keywords_v2",
    NAME,
    f"array_to_string({in_order('ws')}, ' ') || "
    + mapped({k: " " + v for k, v in fv.NAME_INJECTIONS.items()}, NAME, "''"),
    _FIXED,
    _REBUILT,
)
_INJECTED = (
    "injected",
    f"SELECT *, {words_of(KW + ' || ' + chr(39) + ' ' + chr(39) + ' || extra')} AS ws FROM "
    f"(SELECT *, {mapped(fv.TECH_INJECTIONS, NAME, 'NULL')} AS extra FROM labels_in)",
)
curated(
    "inject_keywords",
    NAME,
    f"CASE WHEN extra IS NULL THEN {KW} ELSE array_to_string({in_order('ws')}, ' ') END",
    _INJECTED,
)
_LOWERED = ("lowered", f"SELECT *, {words_of(f'lower({KW})')} AS ws FROM labels_in")
curated("dedupe_keywords", NAME, f"array_to_string({in_order('ws')}, ' ')", _LOWERED)
curated(
    "display_name",
    f"CASE WHEN tax_idx < 59 THEN array_to_string(({words_of(NAME)})[1:3], ' ') ELSE {NAME} END",
    NAME,
)
ORACLE["rename_map"] = f"""{with_(CURATION)} SELECT tax_idx, {mapped(
    fx.RENAMES, NAME, titled(sub(NAME, '(?i)[' + S + ']+(And|Or|For|To|Of|The|In|On)[' + S + ']*$', '')))}
AS subcategory_name FROM labels_in"""
ORACLE["taxonomy_desc"] = f"{with_(CURATION)} SELECT tax_idx, {normal(KW)} AS processed_desc FROM labels_in"
ORACLE["cluster_name"] = f"""{with_(CURATION,
    ("t", f"SELECT tax_idx, {token_list(NAME + ' || coalesce(' + chr(39) + ' ' + chr(39) + ' || keywords, ' + chr(39) * 2 + ')')} AS ws FROM labels_in"),
    ("j", "SELECT *, array_to_string(ws, ' ') AS whole FROM t"))}
SELECT tax_idx, 'Auto Cluster: ' || {titled("array_to_string(ws[1:3], ' ')")} || ' ' ||
       {suffix('whole', fv.CLUSTER_SUFFIX_RULES, fv.SHORT_SUFFIX_DEFAULT)} AS name FROM j"""
ORACLE["keyword_union"] = f"""{with_(CURATION)}
SELECT tax_idx, array_to_string(list_sort(list_distinct(list_concat({words_of(KW)}, {words_of(f'lower({NAME})')}))), ' ')
  AS keywords FROM labels_in"""
ORACLE["enrich_by_category"] = f"""{with_(CURATION)}
SELECT tax_idx, {normal(KW)} || CASE WHEN category_id < 6 THEN ' ' || lower(category_name) ELSE '' END
  AS enriched_desc FROM labels_in"""


def swapped_words(text: str) -> str:
    words = {k: v for k, v in fx.TERM_DICTIONARY.items() if " " not in k}
    table = "map([" + ", ".join(lit(k) for k in words) + "], [" + ", ".join(lit(v) for v in words.values()) + "])"
    return (
        f"array_to_string(list_transform({found(text, f'[{W}]+|[^{W}]+')}, "
        f"lambda p: coalesce({table}[p], p)), '')"
    )


def swapped_phrases(text: str) -> str:
    for phrase in sorted((p for p in fx.TERM_DICTIONARY if " " in p), key=lambda p: (-len(p), p)):
        pattern = f"(^|[^{W}]){phrase}($|[^{W}])"
        to = rf"\1{fx.TERM_DICTIONARY[phrase]}\2"
        text = sub(sub(text, pattern, to), pattern, to)
    return text


ORACLE["translate_terms"] = f"""{with_(PROMPTS, ("p", f"SELECT prompt_id, {swapped_phrases(f'lower({T})')} AS t FROM prompts"))}
SELECT prompt_id, {swapped_words('t')} AS translated FROM p"""
ORACLE["taxonomy_health"] = f"""{with_(CURATION,
    ("k", "SELECT * REPLACE (coalesce(keywords, 'the of') AS keywords) FROM labels_in"),
    ("t", f"SELECT *, len(list_distinct({kept_tokens(normal('keywords'))})) AS n_terms, "
          f"count(*) OVER (PARTITION BY {NAME}) AS same FROM k"))}
SELECT category_id, count(*) AS n_labels, count(*) > 20 AS over_limit,
       count(*) FILTER (same > 1) AS n_repeated_names, count(*) FILTER (n_terms = 0) AS n_without_terms,
       count(*) FILTER (n_terms < 2) AS n_below_two_terms
FROM t GROUP BY 1"""
ORACLE["renumber"] = f"""{with_(CURATION)}
SELECT tax_idx, tax_idx < 59 AS is_core, category_id,
       CAST(row_number() OVER (ORDER BY tax_idx < 59 DESC, category_id, tax_idx) - 1 AS INTEGER) AS subcategory_id
FROM labels_in"""

MERGE = [
    TAXONOMY,
    ("m", "SELECT tax_idx, subcategory_name, keywords, 'Half ' || (tax_idx % 2) AS category_name, "
          "tax_idx % 4 = 0 AS is_core FROM taxonomy"),
    ("mc", counted("tax_idx", "keywords", "m", 1)),
    ("mcc", "SELECT * FROM mc JOIN m USING (tax_idx)"),
    (
        "mw",
        "SELECT tax_idx, category_name, term, w / sqrt(sum(w * w) OVER (PARTITION BY tax_idx)) AS weight FROM "
        "(SELECT tax_idx, category_name, term, tf * (ln((1 + n) / (1 + count(*) OVER "
        "(PARTITION BY category_name, term))) + 1) AS w FROM mcc JOIN "
        "(SELECT category_name, count(*) AS n FROM m GROUP BY 1) USING (category_name))",
    ),
    (
        "ms",
        "SELECT x.category_name, x.tax_idx AS a, y.tax_idx AS b, sum(x.weight * y.weight) AS sim FROM mw x "
        "JOIN mw y ON x.category_name = y.category_name AND x.term = y.term AND x.tax_idx < y.tax_idx GROUP BY ALL",
    ),
]
ORACLE["taxonomy_self_similarity"] = f"""{with_(*MERGE)}
SELECT category_name, a, b, round(sim, 6) AS sim FROM ms WHERE round(sim, 9) >= 0.05"""


def consolidated(anchor: float, limit: int | None) -> str:
    """One merge per category and step, everything weighed anew in each."""
    crowded = f"n > {limit}" if limit is not None else "false"
    return f"""{with_(TAXONOMY, MERGE[1]).replace("WITH ", "WITH RECURSIVE ", 1)},
st AS (
  SELECT 0 AS k, tax_idx, category_name, is_core, subcategory_name, keywords FROM m
  UNION ALL
  (WITH c AS ({counted("tax_idx", "keywords", "st", 1)}),
  sizes AS (SELECT category_name, count(*) AS n FROM st GROUP BY 1),
  raw AS (
    SELECT tax_idx, category_name, term, tf * (ln((1 + n) / (1 + count(*) OVER (PARTITION BY category_name, term))) + 1) AS w
    FROM c JOIN st USING (tax_idx) JOIN sizes USING (category_name)),
  wt AS (SELECT tax_idx, category_name, term, w / sqrt(sum(w * w) OVER (PARTITION BY tax_idx)) AS weight FROM raw),
  dots AS (
    SELECT x.category_name, x.tax_idx AS a, y.tax_idx AS b, round(sum(x.weight * y.weight), 9) AS sim FROM wt x
    JOIN wt y ON x.category_name = y.category_name AND x.term = y.term AND x.tax_idx < y.tax_idx GROUP BY ALL),
  met AS (
    SELECT d.*, n, p.is_core AS ac, q.is_core AS bc, p.subcategory_name AS an, q.subcategory_name AS bn FROM dots d
    JOIN st p ON p.tax_idx = a JOIN st q ON q.tax_idx = b JOIN sizes s ON s.category_name = d.category_name),
  every AS (
    SELECT p.category_name, p.tax_idx AS a, q.tax_idx AS b, p.is_core AS ac, q.is_core AS bc, p.subcategory_name AS an,
           q.subcategory_name AS bn FROM st p JOIN st q ON p.category_name = q.category_name AND p.tax_idx < q.tax_idx
    JOIN sizes s ON s.category_name = p.category_name
    WHERE NOT (p.is_core AND q.is_core) AND {crowded} AND p.category_name IN (SELECT category_name FROM wt)),
  cand AS (
    SELECT category_name, 0 AS kind, 0.0::DOUBLE AS s, CASE WHEN ac THEN a ELSE b END AS x, CASE WHEN ac THEN b ELSE a END AS y, a, b, ac, bc, an, bn
    FROM met WHERE ac <> bc AND sim > {anchor}
    UNION ALL SELECT category_name, 1, -sim, a, b, a, b, ac, bc, an, bn FROM met WHERE NOT (ac AND bc) AND {crowded}
    UNION ALL SELECT category_name, 2, 0.0::DOUBLE, a, b, a, b, ac, bc, an, bn FROM every),
  pick AS (
    SELECT category_name, CASE WHEN bc THEN b ELSE a END AS kept, CASE WHEN bc THEN a ELSE b END AS gone,
      CASE WHEN bc THEN bn WHEN ac THEN an
           WHEN len(string_split(bn, ' ')) < len(string_split(an, ' ')) THEN bn ELSE an END AS name
    FROM cand QUALIFY row_number() OVER (PARTITION BY category_name ORDER BY kind, s, x, y) = 1)
  SELECT st.k + 1, st.tax_idx, st.category_name, st.is_core,
    CASE WHEN st.tax_idx = kept THEN name ELSE st.subcategory_name END,
    CASE WHEN st.tax_idx = kept THEN array_to_string(list_sort(list_distinct(list_concat(
      string_split(st.keywords, ' '), string_split(g.keywords, ' ')))), ' ') ELSE st.keywords END
  FROM st JOIN pick ON pick.category_name = st.category_name JOIN st g ON g.tax_idx = gone WHERE st.tax_idx <> gone)
), last AS (SELECT * FROM st QUALIFY k = max(k) OVER (PARTITION BY category_name))
"""


ORACLE["anchor_merge"] = f"{consolidated(0.08, None)} SELECT tax_idx, subcategory_name, keywords FROM last"
ORACLE["compress_to_n"] = f"{consolidated(0.2, 12)} SELECT tax_idx, category_name, subcategory_name, keywords FROM last"

# --- models -----------------------------------------------------------------------

ORACLE["class_weights"] = """
SELECT quality, count(*) AS n,
       round((SELECT count(*) FROM documents JOIN labels USING (doc_id))
             / ((SELECT count(DISTINCT quality) FROM documents JOIN labels USING (doc_id)) * count(*)), 6) AS weight
FROM documents JOIN labels USING (doc_id) GROUP BY quality"""
_NEWTON = [
    ("cal", "SELECT CAST(doc_id % 3 AS INTEGER) AS fold, c, lang = (['de', 'en', 'es', 'fr'])[c + 1] AS own, "
            "((doc_id * (7919 * (c + 3))) % 1000) / 500 - 1 + CASE WHEN lang = (['de', 'en', 'es', 'fr'])[c + 1] "
            "THEN 0.8::DOUBLE ELSE 0 END AS m FROM documents CROSS JOIN (SELECT unnest([0, 1, 2, 3]) AS c) "
            "WHERE lang IN ('de', 'en', 'es', 'fr')"),
    ("size", "SELECT fold, c, count(*) FILTER (own) AS pos, count(*) FILTER (NOT own) AS neg FROM cal GROUP BY ALL"),
    ("aim", "SELECT fold, c, m, CASE WHEN own THEN (pos + 1) / (pos + 2) ELSE 1 / (neg + 2) END AS t "
            "FROM cal JOIN size USING (fold, c)"),
    ("s0", "SELECT fold, c, 0::DOUBLE AS a, ln((pos + 1) / (neg + 1)) AS b FROM size"),
    *[
        (f"s{k + 1}", "SELECT fold, c, a - (hbb * ga - hab * gb) / (haa * hbb - hab * hab) AS a, "
         "b - (haa * gb - hab * ga) / (haa * hbb - hab * hab) AS b FROM (SELECT fold, c, any_value(a) AS a, any_value(b) AS b, "
         "sum((p - t) * m) AS ga, sum(p - t) AS gb, sum(p * (1 - p) * m * m) AS haa, sum(p * (1 - p) * m) AS hab, "
         f"sum(p * (1 - p)) AS hbb FROM (SELECT *, 1 / (1 + exp(-(a * m + b))) AS p FROM aim JOIN s{k} USING (fold, c)) GROUP BY fold, c)")
        for k in range(4)
    ],
]
ORACLE["intent_calibrate"] = f"""{with_(*_NEWTON)}
SELECT fold, CAST(c AS INTEGER) AS label, round(a, 6) AS slope, round(b, 6) AS offset FROM s4"""
ORACLE["keyword_rank"] = f"""{with_(*PURITY,
    ("r", "SELECT *, row_number() OVER (PARTITION BY subcategory_name ORDER BY round(weight, 9) DESC, term) AS place "
          "FROM q_centroids"),
    ("good", "SELECT subcategory_name, term, row_number() OVER (PARTITION BY subcategory_name ORDER BY place) AS p "
             "FROM r WHERE place <= 20 AND length(term) > 3 AND regexp_full_match(term, '[a-z ]+')"),
    ("mined", "SELECT subcategory_name, list(term) AS terms FROM good WHERE p <= 15 GROUP BY 1"))}
SELECT tax_idx, array_to_string(list_sort(list_distinct(list_concat(
         string_split(keywords, ' '), coalesce(terms, string_split(keywords, ' '))))), ' ') AS keywords
FROM taxonomy LEFT JOIN mined USING (subcategory_name)"""
