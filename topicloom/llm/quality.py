"""Quality rules: exact counts of a text, and a calibrated linear verdict.

The counts (words, characters in words, symbols, repeated lines, words in repeated
three-word windows) drive fixed base rules; a document that passes them is kept if the
calibrated probability of good quality reaches the threshold.  The model is a logistic
regression over hashed words, word pairs and character n-grams of the whole text, with
a sigmoid fitted on documents it was not trained on.

A null text is a text without words; it and every text below the word limit fails the
base rules.  Without labelled rows nothing but the base rules decides.  Repeated rows
get equal results; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from topicloom.llm import linear
from topicloom.llm.common import SPACE_BYTES, binaries, class_sample, slices

CHAR_SIZES, CHAR_BITS, WORD_BITS = (1, 2, 3), 11, 11
#: Labelled documents learned from; every fourth one is kept for the calibration.
SAMPLE_ROWS = 4000
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MIN_PROBABILITY = 0.5
_SYMBOLS = b"#*$%&|<>"
_CONTINUATION = bytes(range(0x80, 0xC0))

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def repeated_words(words: list[bytes]) -> int:
    """Words inside three-word windows that occur at least twice in the text."""
    if len(words) < 3:
        return 0
    ids = dict(zip(dict.fromkeys(words), range(len(words))))
    code = np.fromiter(map(ids.__getitem__, words), np.int64, len(words))
    n = len(ids)
    # Two steps keep the codes small however many words there are.
    _, pair = np.unique(code[:-1] * n + code[1:], return_inverse=True)
    triple = pair[:-1] * n + code[2:]
    _, inverse, times = np.unique(triple, return_inverse=True, return_counts=True)
    at = np.flatnonzero(times[inverse] > 1)
    inside = np.zeros(len(words), bool)
    for k in range(3):
        inside[at + k] = True
    return int(inside.sum())


def text_counts(text: bytes, words: list[bytes]) -> tuple[int, ...]:
    """The five counts of a text, in the order of ``COUNTS``."""
    lines, dup = set(), 0
    for line in text.split(b"\n"):
        if line.strip(SPACE_BYTES):
            dup += line in lines
            lines.add(line)
    chars = len(text.translate(None, SPACE_BYTES + _CONTINUATION))
    symbols = len(text) - len(text.translate(None, _SYMBOLS))
    return len(words), chars, symbols, dup, repeated_words(words)


def features(texts: list[bytes], words: list[list[bytes]]) -> np.ndarray:
    """Character and word part, each of length one."""
    return np.hstack([linear.scaled(linear.gram_counts(texts, CHAR_SIZES, CHAR_BITS)), linear.scaled(linear.word_counts(words, WORD_BITS))])


class QualityModel:
    def __init__(self, x: np.ndarray, y: np.ndarray):
        test = np.arange(len(y)) % 4 == 3
        if len(set(y[test])) < 2 or len(set(y[~test])) < 2:
            test = np.zeros(len(y), bool)
        self.w, self.b = linear.fit_logistic(x[~test], y[~test])
        check = test if test.any() else ~test
        self.slope, self.shift = linear.fit_sigmoid(x[check] @ self.w + self.b, y[check])

    def probability(self, x: np.ndarray) -> np.ndarray:
        return linear.sigmoid(self.slope * (x @ self.w + self.b).astype(np.float64) + self.shift)


def learn(documents: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> QualityModel | None:
    """Fit on at most ``sample_rows`` labelled documents, as many good as bad ones where there are.

    Fewer than two classes give no model.
    """
    sample = class_sample(labels, "quality", sample_rows)
    chosen = documents.select("doc_id", "text").join(F.broadcast(sample), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = binaries(batch, "text")
            x = features(texts, [t.split() for t in texts]).astype(np.float16)
            columns = [batch.column("doc_id"), batch.column("quality"), pa.array([r.tobytes() for r in x], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "quality", "x"])

    schema = f"doc_id long, quality {dict(labels.dtypes)['quality']}, x binary"
    rows = sorted((r.doc_id, r.quality, bytes(r.x)) for r in chosen.mapInArrow(run, schema).collect())
    y = np.array([r[1] for r in rows])
    if len(set(y.tolist())) < 2:
        return None
    x = np.frombuffer(b"".join(r[2] for r in rows), np.float16).reshape(len(rows), -1).astype(np.float32)
    order = np.random.default_rng(5).permutation(len(y))
    return QualityModel(x[order], y[order])


def judge(documents: DataFrame, model: QualityModel | None, min_probability: float = MIN_PROBABILITY) -> DataFrame:
    """``doc_id``, the counts, ``base_failed``, ``probability`` of good quality (null if not needed) and ``kept``."""
    names = ["doc_id", *COUNTS, "base_failed", "probability", "kept"]
    schema = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, probability double, kept boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = binaries(batch, "text")
            words = [t.split() for t in texts]
            counts = np.array([text_counts(t, w) for t, w in zip(texts, words)], np.int64)
            n, repeats = counts[:, 0], counts[:, 4]
            failed = (n < MIN_WORDS) | (100 * repeats > MAX_REPEAT_PERCENT * n)
            probability = np.ones(len(texts))
            rows = np.flatnonzero(~failed) if model else []
            if len(rows):
                probability[rows] = model.probability(features([texts[i] for i in rows], [words[i] for i in rows]))
            kept = ~failed & (probability >= min_probability)
            columns = [batch.column("doc_id"), *[pa.array(c) for c in counts.T]]
            columns += [pa.array(failed), pa.array(probability, mask=failed | (model is None)), pa.array(kept)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)
