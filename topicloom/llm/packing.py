"""Order-preserving packing by dynamic programming.

The tokens of a partition's documents form one stream.  A sequence may end at the end
of a document, at the end of a sentence (a small penalty), or, where a sentence is too
long, at fixed steps inside it (a larger one).  With ``cost[j]`` the least cost of
everything before boundary ``j``,

    cost[j] = penalty[j] + min(cost[i] + padding(pos[j] - pos[i]))

over the boundaries ``i`` at most ``limit`` tokens back.  Padding falls by one for each
token more, so the minimum is that of ``cost[i] + pos[i]`` in a sliding window, kept in
a monotone queue; a power of two needs no padding, so a half, a quarter and an eighth of the limit
are looked up by position.  The stream is worked off in blocks, and the last sequence of a block is
opened again in the next one, so memory holds a block and a document.

Null and empty texts are documents of the end id alone.  Partitions of the input are
packed side by side, each leaves at most one short sequence.  Repeated rows and null
ids are packed like any other row; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from topicloom.llm.common import binaries, slices

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
#: Distinct words in each of the two generations a worker remembers the ids of.
REMEMBERED_WORDS = 400_000
#: Each sequence costs a little by itself, so that of two ways without padding the one with fewer is taken.
SEQUENCE_COST = 2.0


class WordTokens:
    """Ids of a text by a tokenizer file whose pieces never cross white space.

    The tokenizer sees each distinct word once while it is remembered; a text's ids are
    its words' ids joined.  Words go to the tokenizer many at a time.  A word of ASCII letters
    is one piece and ends with one end-of-word id, a word of such letters and closing marks
    with two, which tells the words of a line apart again; all other words, also those of
    other letters, which normalisation may split, are set apart by a special token.
    """

    BREAK = "<|startoftext|>"
    MARKS = ".,!?;:"

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        size = self.tokenizer.get_vocab_size()
        self.word_end, self.sentence_end = np.zeros(size, bool), np.zeros(size, bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.word_end[i] = token.endswith("</w>")
            self.sentence_end[i] = token.endswith((".</w>", "!</w>", "?</w>"))

    def _lines(self, words: list[bytes], glue: str, n: int = 500) -> list[np.ndarray]:
        texts = [glue.join([w.decode() for w in words[i : i + n]]) for i in range(0, len(words), n)]
        return [np.array(c.ids, "<u4") for c in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: list[bytes]) -> None:
        plain, marked, rest = [], [], []
        for w in words:
            text = w.decode()
            if not text.isascii():
                rest.append(w)
            elif text.isalpha():
                plain.append(w)
            elif text.rstrip(self.MARKS).isalpha():
                marked.append(w)
            else:
                rest.append(w)
        for group, ends in ((plain, 1), (marked, 2)):
            lines = self._lines(group, " ")
            ids = np.concatenate(lines) if lines else np.zeros(0, "<u4")
            last = (np.flatnonzero(self.word_end[ids])[ends - 1 :: ends] + 1) * 4
            self._keep(group, ids, np.r_[0, last[:-1]], last)
        special = self.tokenizer.token_to_id(self.BREAK)
        odd = [w for w in rest if self.BREAK.encode() in w]
        rest = [w for w in rest if self.BREAK.encode() not in w]
        one = np.array([special], "<u4")
        lines = [x for line in self._lines(rest, self.BREAK) for x in (line, one)]
        if lines:
            ids = np.concatenate(lines)
            last = np.flatnonzero(ids == special) * 4
            self._keep(rest, ids, np.r_[0, last[:-1] + 4], last)
        for w in odd:
            self.known[w] = np.array(self.tokenizer.encode(w.decode(), add_special_tokens=False).ids, "<u4").tobytes()

    def _keep(self, words: list[bytes], ids: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        if len(ends) != len(words):
            raise ValueError("the tokenizer joins or splits words otherwise than expected")
        data = ids.tobytes()
        self.known.update((w, data[a:b]) for w, a, b in zip(words, starts.tolist(), ends.tolist()))

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit numbers."""
        if len(self.known) > REMEMBERED_WORDS:
            self.older, self.known = self.known, {}
        # Lower case is the tokenizer's own first step; special tokens are told by case.
        words = [(t if b"<|" in t else t.lower()).split() for t in texts]
        new = set().union(*words).difference(self.known)
        if self.older:
            again = [w for w in new if w in self.older]
            self.known.update((w, self.older[w]) for w in again)
            new.difference_update(again)
        self._learn(list(new))
        look = self.known.__getitem__
        return [b"".join(map(look, w)) for w in words]


_tokens: dict[str, WordTokens] = {}


def tokens(path: str) -> WordTokens:
    """One tokenizer per worker process."""
    if path not in _tokens:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _tokens[path] = WordTokens(path)
    return _tokens[path]


def boundaries(sentence_end: np.ndarray, doc_ends: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Where documents laid end to end may be cut, and what kind each place is: 0 end, 1 sentence, 2 forced.

    Of the sentence ends within 16 tokens the last one counts.
    """
    kinds = np.zeros(len(sentence_end) + 1, np.int8)
    sentences = np.flatnonzero(sentence_end) + 1
    kinds[sentences[np.append(np.diff(sentences >> 4) > 0, True)[: len(sentences)]]] = 1
    kinds[doc_ends] = 3
    cuts = np.flatnonzero(kinds)
    gaps = np.diff(np.r_[0, cuts])
    step = limit // 4
    for at in np.flatnonzero(gaps > step):
        kinds[np.arange(cuts[at] - gaps[at] + step, cuts[at], step)] = 2
    cuts = np.flatnonzero(kinds)
    return cuts, kinds[cuts] % 3


def best_cuts(position: list[int], penalty: list[float], limit: int) -> list[int]:
    """Indexes of the chosen boundaries; ``position[0]`` is the start and the last boundary is always chosen.

    Gaps between neighbours must not exceed ``limit``.
    """
    free = [limit >> k for k in range(1, 4)]
    at = {position[0]: 0}
    cost, back = [0.0], [0]
    queue: deque[tuple[float, int, int]] = deque([(0.0 + position[0], position[0], 0)])
    for j in range(1, len(position)):
        p = position[j]
        while queue[0][1] < p - limit:
            queue.popleft()
        key, _, i = queue[0]
        best = key + limit - p
        for length in free:
            k = at.get(p - length)
            if k is not None and cost[k] < best:
                best, i = cost[k], k
        best += penalty[j] + SEQUENCE_COST
        cost.append(best)
        back.append(i)
        at[p] = j
        key = best + p
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, p, j))
    chosen = []
    j = len(position) - 1
    while j:
        chosen.append(j)
        j = back[j]
    return chosen[::-1]


def _pieces(docs: list, start: int, cuts: list[int], limit: int) -> tuple[list[np.ndarray], list]:
    """The pieces between ``start`` and the last cut, and the documents that go on behind it.

    ``docs``: (doc_id, position of its first token, ids), in stream order.
    """
    ends = np.array(cuts)
    first = np.array([d[1] for d in docs])
    bounds = np.union1d(np.r_[start, ends], first[(first > start) & (first < ends[-1])])
    a, b = bounds[:-1], bounds[1:]
    doc = np.searchsorted(first, a, "right") - 1
    sequence = np.searchsorted(ends, a, "right")
    opens = np.r_[start, ends][sequence]
    ids = [docs[d][2][x - docs[d][1] : y - docs[d][1]] for d, x, y in zip(doc, a, b)]
    columns = [
        [docs[d][0] for d in doc],
        a - first[doc],
        b - a,
        [zlib.crc32(x) for x in ids],
        [len(docs[d][2]) for d in doc],
        sequence,
        a - opens,
    ]
    rest = [d for d in docs if d[1] + len(d[2]) > ends[-1]]
    return columns, rest


def pack(
    documents: DataFrame,
    tokenizer: str,
    limit: int = 2048,
    end_id: int = 1,
    sentence_penalty: float = 4.0,
    forced_penalty: float = 64.0,
    block: int = 1 << 18,
) -> DataFrame:
    """One row per piece: ``(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset)``.

    The order of the rows in the input is kept.  ``sequence_id`` is built from the
    partition's number and a count in it, as a retried task builds it again.
    """
    penalties = np.array([0.0, sentence_penalty, forced_penalty])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = tokens(tokenizer)
        base = TaskContext.get().partitionId() << 33
        end = np.array([end_id], "<u4").tobytes()
        docs, position, penalty, committed, at, done = [], [0], [0.0], 0, 0, 0

        def flush(last: bool) -> pa.RecordBatch | None:
            nonlocal docs, position, penalty, committed, done
            chosen = best_cuts(position, penalty, limit)
            if not last:
                chosen = chosen[:-1]
            if not chosen:
                return None
            cuts = [position[j] for j in chosen]
            columns, docs = _pieces(docs, committed, cuts, limit)
            columns[5] = columns[5] + (base + done)
            done += len(cuts)
            committed = cuts[-1]
            position, penalty = position[chosen[-1] :], [0.0, *penalty[chosen[-1] + 1 :]]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], names=[f.split()[0] for f in SCHEMA.split(", ")]
            )

        for batch in slices(batches, "text"):
            parts = [x + end for x in words.encode(binaries(batch, "text"))]
            ids = np.frombuffer(b"".join(parts), "<u4")
            doc_ends = np.cumsum([len(x) // 4 for x in parts])
            cuts, kinds = boundaries(words.sentence_end[ids], doc_ends, limit)
            position.extend((cuts + at).tolist())
            penalty.extend(penalties[kinds].tolist())
            for doc_id, a, b in zip(batch.column("doc_id").to_pylist(), np.r_[0, doc_ends].tolist(), doc_ends.tolist()):
                docs.append((doc_id, at + a, ids[a:b]))
            at += len(ids)
            if at - committed >= block and (out := flush(False)) is not None:
                yield out
        if docs:
            yield flush(True)

    return documents.select("doc_id", "text").mapInArrow(run, SCHEMA)
