"""Language identification in two steps: the family first, then pairs of close languages.

Linear support vector machines over hashed n-grams of the whole text: one against the
rest for each family, and one for each pair of languages of a family.  The language
with most votes wins, margins break ties.  ``score`` is the softmax share of the family
times that of the language among its own.

A null text, and one without a letter, gets ``und`` and score 0, as does every text when
there is nothing to learn from.  Rows without a language are not learned from but
predicted like the others; repeated rows get equal results; an empty table gives an
empty table; a null id is never held out.  Columns of other names are not read; those
named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from topicloom.llm import linear
from topicloom.llm.common import binaries, class_sample, slices

UNKNOWN = "und"
#: Families of languages by ISO 639-1 code.  A language in none is its own family.
FAMILIES = {
    "germanic": ["af", "da", "de", "en", "fo", "fy", "is", "lb", "nb", "nl", "nn", "no", "sv", "yi"],
    "romance": ["an", "ast", "ca", "co", "es", "fr", "gl", "it", "la", "oc", "pt", "ro", "sc"],
    "slavic": ["be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"],
    "uralic": ["et", "fi", "hu", "se"],
    "baltic": ["lt", "lv"],
    "celtic": ["br", "cy", "ga", "gd"],
    "turkic": ["az", "kk", "ky", "tk", "tr", "tt", "ug", "uz"],
    "indic": ["bn", "gu", "hi", "mr", "ne", "or", "pa", "si", "ur"],
    "semitic": ["am", "ar", "he", "mt"],
}
SIZES = (1, 2, 3, 4)
BITS = 12
#: Documents learned from, over all languages; each also gives two of its windows.
SAMPLE_ROWS = 1600
WINDOWS = (3, 15)
_LETTER = regex.compile(r"\p{L}")


def _clean(text: bytes) -> bytes:
    return b" " + b" ".join(text.decode("utf-8", "replace").lower().encode().translate(linear.LETTERS_ONLY).split()) + b" "


def features(texts: list[bytes]) -> np.ndarray:
    return linear.scaled(linear.gram_counts([_clean(t) for t in texts], SIZES, BITS))


def _windows(text: bytes) -> list[bytes]:
    """The whole text, and a short and a longer run of its words from places that depend on the text."""
    words = text.split()
    out = [text]
    for n in WINDOWS:
        at = len(text) * 7919 % max(1, len(words) - n + 1)
        out.append(b" ".join(words[at : at + n]))
    return out


class LanguageModel:
    """Fitted machines: plain arrays that travel to the tasks."""

    def __init__(self, x: np.ndarray, langs: list[str]):
        own = {lang: name for name, members in FAMILIES.items() for lang in members}
        self.langs = sorted(set(langs))
        self.family_of = [own.get(lang, lang) for lang in self.langs]
        self.families = sorted(set(self.family_of))
        y = np.array([self.langs.index(lang) for lang in langs], int)
        f = np.array([self.families.index(self.family_of[i]) for i in y], int)
        self.family_w = [linear.fit_svm(x, np.where(f == k, 1, -1)) for k in range(len(self.families))] if len(self.families) > 1 else []
        self.pairs = {}
        for k in range(len(self.families)):
            members = self.members(k)
            for n, i in enumerate(members):
                for j in members[n + 1 :]:
                    rows = (y == i) | (y == j)
                    self.pairs[i, j] = linear.fit_svm(x[rows], np.where(y[rows] == i, 1, -1))

    def members(self, family: int) -> list[int]:
        return [i for i, name in enumerate(self.family_of) if name == self.families[family]]

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the language and score, for rows of features."""
        if self.family_w:
            margins = np.stack([x @ w + b for w, b in self.family_w], 1)
        else:
            margins = np.zeros((len(x), 1), np.float32)
        family, family_p = margins.argmax(1), _softmax(margins)
        lang, score = np.zeros(len(x), int), np.zeros(len(x))
        for k in range(len(self.families)):
            rows = np.flatnonzero(family == k)
            members = self.members(k)
            votes = np.zeros((len(rows), len(members)))
            margin = np.zeros_like(votes)
            for a, i in enumerate(members):
                for b in range(a + 1, len(members)):
                    w, c = self.pairs[i, members[b]]
                    m = x[rows] @ w + c
                    votes[:, a] += m > 0
                    votes[:, b] += m <= 0
                    margin[:, a] += m
                    margin[:, b] -= m
            best = (votes + 0.4 * np.tanh(margin / max(1, len(members)))).argmax(1)
            lang[rows] = np.array(members)[best]
            share = _softmax(margin / max(1, len(members) - 1))
            score[rows] = family_p[rows, k] * share[np.arange(len(rows)), best]
        return lang, np.clip(score, 0, 1)


def _softmax(margins: np.ndarray) -> np.ndarray:
    e = np.exp(3.0 * (margins - margins.max(1, keepdims=True)))
    return e / e.sum(1, keepdims=True)


def learn(documents: DataFrame, usable: Column, sample_rows: int = SAMPLE_ROWS) -> LanguageModel | None:
    """Fit on at most ``sample_rows`` documents for which ``usable`` holds, evenly over the languages.

    Their features are made in the tasks; vectors of a fixed width come to the driver.
    """
    known = documents.filter(usable & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sample = class_sample(known, "lang", sample_rows)
    chosen = known.select("doc_id", "lang", "text").join(F.broadcast(sample), ["doc_id", "lang"], "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            parts = [_windows(t) for t in binaries(batch, "text")]
            keep = [[p for p in own if _LETTER.search(p.decode())] for own in parts]
            flat = [p for own in keep for p in own]
            if not flat:
                continue
            langs = [x for x, own in zip(batch.column("lang").to_pylist(), keep) for _ in own]
            ids = [x for x, own in zip(batch.column("doc_id").to_pylist(), keep) for _ in own]
            rows = [r.tobytes() for r in features(flat).astype(np.float16)]
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(langs, pa.string()), pa.array(rows, pa.binary())], names=["doc_id", "lang", "x"])

    rows = sorted((r.doc_id, r.lang, bytes(r.x)) for r in chosen.mapInArrow(run, "doc_id long, lang string, x binary").collect())
    if not rows:
        return None
    x = np.frombuffer(b"".join(r[2] for r in rows), np.float16).reshape(len(rows), -1).astype(np.float32)
    return LanguageModel(x, [r[1] for r in rows])


def identify(documents: DataFrame, model: LanguageModel | None) -> DataFrame:
    """``documents`` with ``lang_pred`` and ``score`` behind its columns."""
    from pyspark.sql.types import DoubleType, StringType, StructField, StructType

    documents = documents.drop("lang_pred", "score")
    schema = StructType([*documents.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = binaries(batch, "text")
            has_letter = np.array([bool(_LETTER.search(t.decode())) for t in texts])
            langs, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            rows = np.flatnonzero(has_letter) if model else []
            if len(rows):
                lang, scores[rows] = model.predict(features([texts[i] for i in rows]))
                for i, k in zip(rows, lang):
                    langs[i] = model.langs[k]
            columns = [*batch.columns, pa.array(langs, pa.string()), pa.array(scores)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return documents.mapInArrow(run, schema)
