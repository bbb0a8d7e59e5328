"""Toxicity by a bidirectional gated recurrent network with attention pooling.

A word's input is an embedding of the word next to the mean embedding of its character
n-grams, both hashed.  A gated recurrent unit reads a window of words in each direction,
attention pools the states, and a linear layer gives the window's logit.  A document's
score is the calibrated sigmoid of its highest window; windows overlap by half and cover
the whole text.

Only documents are labelled, so training chooses windows: all of them are scored after
each pass, and the highest of each document is what the label speaks of; clean documents
also give windows drawn at random.  Which windows to begin with comes from how much
oftener their character n-grams occur in toxic than in clean documents.

A null or empty text is one window of padding.  Repeated rows get equal scores.  Without
labels of both classes every score is 0.  An empty table gives an empty table.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from topicloom.llm import linear
from topicloom.llm.common import binaries, class_sample, slices

#: Labelled documents learned from, and the window length and step in words.
SAMPLE_ROWS = 2000
WINDOW, STEP = 24, 12
WORD_ROWS, GRAM_ROWS, WORD_DIM, GRAM_DIM, HIDDEN = 4096, 8192, 8, 16, 8
GRAM_SIZES = (3, 4, 5)
PASSES, BATCH, RATE = 7, 128, 0.01
#: Few documents are gone through oftener, until there were about so many steps.
LEAST_STEPS = 200
_F = np.float32


class Words:
    """Distinct words of some texts and the rows of their hashed n-grams."""

    def __init__(self, texts: list[bytes]):
        split = [t.lower().split() for t in texts]
        known = dict.fromkeys(chain.from_iterable(split))
        self.sizes = np.array([len(s) for s in split])
        place = dict(zip(known, range(1, len(known) + 1))).__getitem__
        # Word 0 is padding: no letters, the first embedding row of its own.
        self.ids = np.fromiter(map(place, chain.from_iterable(split)), np.int32, int(self.sizes.sum()))
        words = [b"", *known]
        self.word_rows = np.array([0, *(1 + zlib.crc32(w) % (WORD_ROWS - 1) for w in known)])
        marked = [b"^" + w + b"$" for w in words]
        size = np.array([len(w) for w in marked])
        a = np.frombuffer(b"".join(marked), np.uint8).astype(np.uint32)
        end = np.repeat(np.cumsum(size), size)
        owner = np.repeat(np.arange(len(words)), size)
        rows, owners, code = [], [], np.zeros(len(a), np.uint32)
        for n in range(1, max(GRAM_SIZES) + 1):
            if len(a) < n:
                break
            code = code[: len(a) - n + 1] * np.uint32(263) + a[n - 1 :]
            if n in GRAM_SIZES:
                fits = np.arange(len(code)) + n <= end[: len(code)]
                rows.append((code[fits] * np.uint32(0x9E3779B1) >> np.uint32(19)).astype(np.int64) % GRAM_ROWS)
                owners.append(owner[: len(code)][fits])
        owners, rows = np.concatenate(owners), np.concatenate(rows)
        order = np.argsort(owners, kind="stable")
        self.gram_rows, owners = rows[order], owners[order]
        counts = np.bincount(owners, minlength=len(words))
        self.gram_counts = counts
        self.gram_starts = np.cumsum(counts) - counts

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers of all windows, and the text of each; a short text is filled up with padding."""
        count = np.maximum(1, -(-(self.sizes - WINDOW) // STEP) + 1)
        text = np.repeat(np.arange(len(count)), count)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
        begin = np.minimum(nth * STEP, np.maximum(self.sizes[text] - WINDOW, 0))
        at = begin[:, None] + np.arange(WINDOW)
        inside = at < self.sizes[text][:, None]
        base = (np.cumsum(self.sizes) - self.sizes)[text][:, None]
        ids = np.append(self.ids, 0)
        return np.where(inside, ids[np.where(inside, base + at, len(self.ids))], 0), text

    def mean_of_grams(self, table: np.ndarray, words: np.ndarray | None = None) -> np.ndarray:
        """Mean row of ``table`` over each word's n-grams; padding, which has none, gets zeros."""
        rows, starts, counts = self.grams_of(words) if words is not None else (self.gram_rows, self.gram_starts, self.gram_counts)
        out = np.zeros((len(counts), table.shape[1]), table.dtype)
        some = counts > 0
        if some.any():
            at, n = starts[some], counts[some]
            sums = [
                np.add.reduceat(table[rows[at[a] : at[a + 4095] + n[a + 4095] if a + 4095 < len(at) else None]], at[a : a + 4096] - at[a])
                for a in range(0, len(at), 4096)
            ]
            out[some] = np.concatenate(sums) / n[:, None].astype(table.dtype)
        return out

    def grams_of(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        counts = self.gram_counts[words]
        starts = np.cumsum(counts) - counts
        at = np.arange(counts.sum()) - np.repeat(starts - self.gram_starts[words], counts)
        return self.gram_rows[at], starts, counts


def _sigmoid(x):
    return _F(0.5) * np.tanh(_F(0.5) * x) + _F(0.5)


class Network:
    """The parameters, forward and backward pass."""

    def __init__(self, seed: int = 1):
        r = np.random.default_rng(seed)
        d, h = WORD_DIM + GRAM_DIM, HIDDEN
        draw = lambda *shape, s=0.3: (r.standard_normal(shape) * s).astype(_F)
        self.p = {"word": draw(WORD_ROWS, WORD_DIM, s=0.1), "gram": draw(GRAM_ROWS, GRAM_DIM)}
        for side in "fb":
            self.p |= {f"x{side}": draw(d, 3 * h), f"h{side}": draw(h, 3 * h), f"c{side}": np.zeros(3 * h, _F)}
        self.p |= {"att": draw(2 * h), "out": draw(2 * h), "bias": np.zeros(1, _F)}

    def inputs(self, words: Words, which: np.ndarray | None = None) -> np.ndarray:
        rows = words.word_rows if which is None else words.word_rows[which]
        return np.hstack([self.p["word"][rows], words.mean_of_grams(self.p["gram"], which)])

    def projected(self, x: np.ndarray) -> dict[str, np.ndarray]:
        """What a word adds to the gates, once per distinct word."""
        return {side: x @ self.p[f"x{side}"] + self.p[f"c{side}"] for side in "fb"}

    def logits(self, ids: np.ndarray, projected: dict, keep: bool = False):
        """Logits of windows of word numbers; with ``keep`` also what the backward pass needs."""
        h, n = HIDDEN, len(ids)
        states, memory = [], {}
        for side in "fb":
            state, own, steps = np.zeros((n, h), _F), np.empty((WINDOW, n, h), _F), []
            u = self.p[f"h{side}"]
            for t in range(WINDOW) if side == "f" else range(WINDOW - 1, -1, -1):
                x, rec = projected[side][ids[:, t]], state @ u
                gates = _sigmoid(x[:, : 2 * h] + rec[:, : 2 * h])
                z, r = gates[:, :h], gates[:, h:]
                new = np.tanh(x[:, 2 * h :] + r * rec[:, 2 * h :])
                if keep:
                    steps.append((t, state, z, r, new, rec[:, 2 * h :]))
                state = new + z * (state - new)
                own[t] = state
            states.append(own)
            memory[side] = steps
        all_states = np.concatenate(states, axis=2)
        weight = all_states @ self.p["att"]
        weight = np.exp(weight - weight.max(0))
        weight /= weight.sum(0)
        pooled = (weight[:, :, None] * all_states).sum(0)
        logit = pooled @ self.p["out"] + self.p["bias"]
        return (logit, (memory, all_states, weight, pooled)) if keep else logit

    def gradients(self, ids: np.ndarray, y: np.ndarray, words: Words) -> dict[str, np.ndarray]:
        """Gradients of the mean log loss over windows of word numbers."""
        h, n = HIDDEN, len(ids)
        which, local = np.unique(ids, return_inverse=True)
        local = local.reshape(ids.shape)
        x = self.inputs(words, which)
        logit, (memory, states, weight, pooled) = self.logits(local, self.projected(x), keep=True)
        d_logit = ((_sigmoid(logit) - y) / n).astype(_F)
        g = {"out": pooled.T @ d_logit, "bias": d_logit.sum(keepdims=True)}
        d_pooled = d_logit[:, None] * self.p["out"]
        d_weight = (states * d_pooled).sum(2)
        d_score = weight * (d_weight - (weight * d_weight).sum(0))
        g["att"] = np.einsum("tn,tnh->h", d_score, states)
        d_states = weight[:, :, None] * d_pooled + d_score[:, :, None] * self.p["att"]
        d_x = np.zeros_like(x)
        for at, side in enumerate("fb"):
            u, d_next = self.p[f"h{side}"], np.zeros((n, h), _F)
            d_in = np.zeros((len(which), 3 * h), _F)
            d_u = np.zeros_like(u)
            for t, state, z, r, new, rec in reversed(memory[side]):
                d = d_states[t, :, at * h : at * h + h] + d_next
                d_new = d * (1 - z) * (1 - new * new)
                d_z = d * (state - new) * z * (1 - z)
                d_r = d_new * rec * r * (1 - r)
                d_rec = np.hstack([d_z, d_r, d_new * r])
                np.add.at(d_in, local[:, t], np.hstack([d_z, d_r, d_new]))
                d_u += state.T @ d_rec
                d_next = d * z + d_rec @ u.T
            g[f"h{side}"], g[f"c{side}"], g[f"x{side}"] = d_u, d_in.sum(0), x.T @ d_in
            d_x += d_in @ self.p[f"x{side}"].T
        g["word"] = np.zeros_like(self.p["word"])
        np.add.at(g["word"], words.word_rows[which], d_x[:, :WORD_DIM])
        rows, _, counts = words.grams_of(which)
        per = d_x[:, WORD_DIM:] / np.maximum(counts, 1)[:, None].astype(_F)
        g["gram"] = np.zeros_like(self.p["gram"])
        np.add.at(g["gram"], rows, np.repeat(per, counts, axis=0))
        return g


class _Adam:
    def __init__(self, p: dict):
        self.m, self.v = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))
        self.t = 0

    def step(self, p: dict, g: dict, rate: float) -> None:
        self.t += 1
        for k in p:
            self.m[k] += _F(0.1) * (g[k] - self.m[k])
            self.v[k] += _F(0.01) * (g[k] * g[k] - self.v[k])
            scale = rate / (1 - 0.9**self.t)
            p[k] -= _F(scale) * self.m[k] / (np.sqrt(self.v[k] / _F(1 - 0.99**self.t)) + _F(1e-6))


class ToxicityModel:
    """A trained network and its calibration."""

    def __init__(self, texts: list[bytes], y: np.ndarray):
        self.net = Network()
        words = Words(texts)
        ids, owner = words.windows()
        y = y.astype(_F)
        r = np.random.default_rng(2)
        best = self._first_guess(words, ids, owner, y)
        adam = _Adam(self.net.p)
        passes = max(PASSES, LEAST_STEPS * BATCH // (2 * len(texts)))
        for number in range(passes):
            top = _highest(best, owner)
            clean = np.flatnonzero(y[owner] == 0)
            drawn = r.choice(clean, min(len(clean), len(texts)), replace=False) if len(clean) else clean
            use = np.unique(np.r_[top, drawn])
            r.shuffle(use)
            for a in range(0, len(use), BATCH):
                part = use[a : a + BATCH]
                rate = RATE * (1 - 0.8 * number / passes)
                adam.step(self.net.p, self.net.gradients(ids[part], y[owner[part]], words), rate)
            best = self._window_logits(words, ids)
        self.slope, self.shift = linear.fit_sigmoid(np.maximum.reduceat(best, _starts(owner)), y)

    @staticmethod
    def _first_guess(words: Words, ids: np.ndarray, owner: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Per window the largest word value; a word's is the mean log odds of its n-grams by document."""
        toxic = np.repeat(y, words.sizes) > 0
        docs = np.repeat(np.arange(len(y)), words.sizes)
        odds = []
        for side in (toxic, ~toxic):
            pairs = np.unique(docs[side].astype(np.int64) * (len(words.word_rows) + 1) + words.ids[side])
            df = np.bincount(pairs % (len(words.word_rows) + 1), minlength=len(words.word_rows)).astype(_F)
            per_gram = np.bincount(words.gram_rows, np.repeat(df, words.gram_counts), GRAM_ROWS)
            odds.append((per_gram + 1) / (per_gram.sum() + GRAM_ROWS))
        value = words.mean_of_grams(np.log(odds[0] / odds[1]).astype(_F)[:, None])[:, 0]
        return value[ids].max(1)

    def _window_logits(self, words: Words, ids: np.ndarray) -> np.ndarray:
        projected = self.net.projected(self.net.inputs(words))
        parts = [self.net.logits(ids[a : a + 4096], projected) for a in range(0, len(ids), 4096)]
        return np.concatenate(parts)

    def scores(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Score and number of windows of each text."""
        words = Words(texts)
        ids, owner = words.windows()
        top = np.maximum.reduceat(self._window_logits(words, ids), _starts(owner)).astype(np.float64)
        return linear.sigmoid(self.slope * top + self.shift), np.bincount(owner, minlength=len(texts))


def _starts(owner: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])


def _highest(values: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """The index of each owner's highest window."""
    order = np.lexsort((values, owner))
    return order[np.r_[_starts(owner)[1:], len(owner)] - 1]


#: Words of a labelled document that go into the training: its windows are drawn from all of it.
DRAWN_WORDS = 3000


def _drawn(text: bytes, doc_id: int) -> bytes:
    """At most ``DRAWN_WORDS`` words of a training text, as runs from all over it; bounds what the driver holds."""
    words = text.split()
    if len(words) <= DRAWN_WORDS:
        return text
    runs = len(words) // 100
    chosen = np.sort(np.random.default_rng(abs(doc_id)).choice(runs, DRAWN_WORDS // 100, replace=False))
    return b" ".join(w for k in chosen for w in words[k * 100 : k * 100 + 100])


def learn(documents: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> ToxicityModel | None:
    """Fit on at most ``sample_rows`` labelled documents, evenly over both labels; None unless both occur.

    Toxic documents longer than ``DRAWN_WORDS`` are left out of the fit, as a draw could
    miss what they are labelled for; clean ones are drawn from.
    """
    sample = class_sample(labels, "toxic", sample_rows)
    chosen = documents.select("doc_id", "text").join(F.broadcast(sample), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows = [
                (i, y, _drawn(t, i))
                for i, y, t in zip(batch.column("doc_id").to_pylist(), batch.column("toxic").to_pylist(), binaries(batch, "text"))
                if not y or len(t.split()) <= DRAWN_WORDS
            ]
            columns = [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.int32(), pa.binary()))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "toxic", "text"])

    rows = sorted((r.doc_id, r.toxic, bytes(r.text)) for r in chosen.mapInArrow(run, "doc_id long, toxic int, text binary").collect())
    y = np.array([r[1] for r in rows])
    if len(set(y.tolist())) < 2:
        return None
    return ToxicityModel([r[2] for r in rows], y)


def score(documents: DataFrame, model: ToxicityModel | None) -> DataFrame:
    """``(doc_id, score, n_windows)`` of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 << 20):
            texts = binaries(batch, "text")
            scores, windows = model.scores(texts) if model else (np.zeros(len(texts)), np.zeros(len(texts), np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores), pa.array(windows.astype(np.int64))], names=["doc_id", "score", "n_windows"]
            )

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double, n_windows long")
