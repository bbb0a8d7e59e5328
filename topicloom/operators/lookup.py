"""Values of n-grams added up per text, in Arrow batches inside the tasks that hold the texts.

N-grams lie inside words and texts repeat words, so a task takes each word apart once and
remembers its n-grams.  Tables of values are label-index or profile sized and go out as broadcasts;
texts, shuffles and sums over rows stay with Spark.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from topicloom.session import share_package

#: Words a task remembers before it starts anew.
WORDS = 500_000
#: Texts that are added up together, and how many products of a term and a table row are held at a time.
PIECE, PRODUCTS = 512, 500_000
#: Cells of a table that may be kept dense.
DENSE_CELLS = 8_000_000
#: White space as Java's ``(?U)\s`` knows it, but for the blank.
OTHER_SPACE = re.compile("[\t-\r\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def lower_words(text: str) -> list[str]:
    """Words of a lower-case text as ``functions.text.char_ngrams`` sees them; an empty text is one empty word."""
    return [w for w in OTHER_SPACE.sub(" ", text).split(" ") if w] or [""]


class WordSums(dict):
    """Word to its place among ``sums``: the sums over its windows, and in the last column how many are known."""

    def __init__(self, names: list[str], values: np.ndarray, low: int, high: int):
        self.numbers = dict(zip(names, range(len(names))))
        self.values = np.column_stack([values, np.ones(len(names))])
        self.sizes = range(low, high + 1)
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.fresh, self.sums = [], np.zeros((0, self.values.shape[1]))

    def __missing__(self, word: str) -> int:
        self.fresh.append(word)
        self[word] = place = len(self)
        return place

    def add_fresh(self) -> None:
        """The sums of the words seen since the last call."""
        grams, sizes = [], []
        for word in self.fresh:
            p, before = f" {word} ", len(grams)
            for n in self.sizes:
                grams += [p[i : i + n] for i in range(len(p) - n + 1)]
            sizes.append(len(grams) - before)
        numbers = np.array([self.numbers.get(g, -1) for g in grams], np.int64)
        of = np.repeat(np.arange(len(sizes)), sizes)[numbers >= 0]
        numbers = numbers[numbers >= 0]
        fresh = [np.bincount(of, self.values[numbers, c], len(sizes)) for c in range(self.values.shape[1])]
        self.sums = np.concatenate([self.sums, np.column_stack(fresh)])
        self.fresh = []

    def of(self, texts: list[str | None]) -> np.ndarray:
        """A row of sums per text."""
        if len(self) > WORDS:
            self.forget()
        words = [() if t is None else lower_words(t) for t in texts]
        sizes = np.array([len(w) for w in words], np.int64)
        places = np.array([self[w] for w in chain.from_iterable(words)], np.int64)
        self.add_fresh()
        of = np.repeat(np.arange(len(texts)), sizes)
        return np.column_stack([np.bincount(of, self.sums[places, c], len(texts)) for c in range(self.values.shape[1])])


def profile_sums(wide: DataFrame, columns: list[str], low: int, high: int) -> Callable[[Column], Column]:
    """For a lower-case text the sums of ``columns`` over its windows, a struct that is null without a known window.

    ``wide`` has one row per ``gram`` and is small.  A word is taken apart once per task, unless many others came between.
    """
    spark = wide.sparkSession
    share_package(spark)
    table = wide.select("gram", *columns).toArrow()
    values = np.column_stack([table[c].to_numpy() for c in columns])
    shared = spark.sparkContext.broadcast((table["gram"].to_pylist(), values))

    @F.arrow_udf("struct<" + ",".join(f"{c}:double" for c in columns) + ">")
    def sums(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        words = WordSums(*shared.value, low, high)
        for texts in batches:
            found = words.of(texts.to_pylist())
            parts = [pa.array(np.ascontiguousarray(found[:, c])) for c in range(len(columns))]
            yield pa.StructArray.from_arrays(parts, columns, mask=pa.array(found[:, -1] == 0))

    return sums


def _ranges(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All places of the ranges that start at ``begin``, one range after the other."""
    return np.arange(size.sum()) - np.repeat(np.cumsum(size) - size - begin, size)


def _counted(texts: np.ndarray, terms: np.ndarray, n_terms: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(text, term, tf)`` of occurrences, ordered by text."""
    key = np.sort(texts * n_terms + terms)
    new = np.flatnonzero(np.r_[True, key[1:] != key[:-1]][: len(key)])
    text, term = np.divmod(key[new], max(1, n_terms))
    return text, term, np.diff(np.r_[new, len(key)])


class WindowCounts(dict):
    """Word to its place among the words seen; counts the known windows of lower-case texts."""

    def __init__(self, names: list[str], low: int, high: int):
        self.numbers, self.sizes = dict(zip(names, range(len(names)))), range(low, high + 1)
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.fresh, self.terms, self.begin = [], np.zeros(0, np.int64), np.zeros(1, np.int64)

    def __missing__(self, word: str) -> int:
        self.fresh.append(word)
        self[word] = place = len(self)
        return place

    def add_fresh(self) -> None:
        """Take the words apart that were seen since the last call."""
        found, sizes = [], []
        for word in self.fresh:
            p, before = f" {word} ", len(found)
            for n in self.sizes:
                found += [k for i in range(len(p) - n + 1) if (k := self.numbers.get(p[i : i + n])) is not None]
            sizes.append(len(found) - before)
        self.terms = np.concatenate([self.terms, np.array(found, np.int64)])
        self.begin = np.concatenate([self.begin, self.begin[-1] + np.cumsum(np.array(sizes, np.int64))])
        self.fresh = []

    def of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(text, term, tf)`` of the known windows; a null text has none."""
        if len(self) > WORDS:
            self.forget()
        words = [() if t is None else lower_words(t) for t in texts.to_pylist()]
        places = np.array([self[w] for w in chain.from_iterable(words)], np.int64)
        if self.fresh:
            self.add_fresh()
        text = np.repeat(np.arange(len(words)), np.array([len(w) for w in words], np.int64))
        size = self.begin[places + 1] - self.begin[places]
        return _counted(np.repeat(text, size), self.terms[_ranges(self.begin[places], size)], len(self.numbers))


class WordCounts:
    """Counts the known words and pairs of neighbouring words of token lists."""

    def __init__(self, names: list[str]):
        parts = [n.split(" ") for n in names]
        self.n_terms = len(names)
        self.words = {w: i for i, w in enumerate(dict.fromkeys(chain.from_iterable(parts)))}
        # The last place is that of an unknown word.
        self.single = np.full(len(self.words) + 1, -1)
        pairs = []
        for term, own in enumerate(parts):
            if len(own) == 1:
                self.single[self.words[own[0]]] = term
            elif len(own) == 2:
                pairs.append((self._pair(self.words[own[0]], self.words[own[1]]), term))
        self.pairs = np.array(sorted(pairs), np.int64).reshape(-1, 2)

    def _pair(self, first, second):
        return first * (len(self.words) + 1) + second

    def of(self, tokens: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(text, term, tf)``; a null list has no terms."""
        flat = tokens.flatten().dictionary_encode()
        known = np.array([self.words.get(w, len(self.words)) for w in flat.dictionary.to_pylist()], np.int64)
        word = known[flat.indices.to_numpy()] if len(flat) else np.zeros(0, np.int64)
        text = np.repeat(np.arange(len(tokens)), tokens.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
        single = self.single[word]
        one = single >= 0
        pair = self._pair(word[:-1], word[1:])
        at = np.searchsorted(self.pairs[:, 0], pair)
        two = (text[:-1] == text[1:]) & (at < len(self.pairs))
        two[two] = self.pairs[at[two], 0] == pair[two]
        return _counted(np.concatenate([text[one], text[:-1][two]]), np.concatenate([single[one], self.pairs[at[two], 1]]), self.n_terms)


class GramCounts:
    """Counts the known n-grams of up to ``high`` neighbouring words of token lists."""

    def __init__(self, names: list[str], high: int):
        parts = [n.split(" ") for n in names]
        self.n_terms = len(names)
        self.words = {w: i for i, w in enumerate(dict.fromkeys(chain.from_iterable(parts)))}
        # The last word is an unknown one.  A gram is a node below that of its first words; nodes of one word are the words.
        self.width, self.levels = len(self.words) + 1, []
        nodes = {(self.words[w],): self.words[w] for w in self.words}
        term = np.full(self.width, -1)
        for i, own in enumerate(parts):
            if len(own) == 1:
                term[self.words[own[0]]] = i
        self.single = term
        for n in range(2, high + 1):
            heads = dict.fromkeys(tuple(self.words[w] for w in own[:n]) for own in parts if len(own) >= n)
            keys = [nodes[h[:-1]] * self.width + h[-1] for h in heads]
            order = np.argsort(np.array(keys, np.int64), kind="stable")
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            nodes = dict(zip(heads, place.tolist()))
            term = np.full(len(order) + 1, -1)
            for i, own in enumerate(parts):
                if len(own) == n:
                    term[nodes[tuple(self.words[w] for w in own)]] = i
            self.levels.append((np.array(keys, np.int64)[order], term))

    def of(self, tokens: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(text, term, tf)``; a null list has no terms."""
        flat = tokens.flatten().dictionary_encode()
        known = np.array([self.words.get(w, self.width - 1) for w in flat.dictionary.to_pylist()], np.int64)
        word = known[flat.indices.to_numpy()] if len(flat) else np.zeros(0, np.int64)
        text = np.repeat(np.arange(len(tokens)), tokens.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
        at, node, term = np.arange(len(word)), word, self.single[word]
        texts, terms = [text[term >= 0]], [term[term >= 0]]
        for n, (keys, of) in enumerate(self.levels, 2):
            there = at + n - 1 < len(word)
            at, node = at[there], node[there]
            same = text[at] == text[at + n - 1]
            at, key = at[same], node[same] * self.width + word[at[same] + n - 1]
            node = np.searchsorted(keys, key)
            found = node < len(keys)
            found[found] = keys[node[found]] == key[found]
            at, node = at[found], node[found]
            term = of[node]
            texts.append(text[at[term >= 0]])
            terms.append(term[term >= 0])
        return _counted(np.concatenate(texts), np.concatenate(terms), self.n_terms)


class TermCounts:
    """Counts the known terms of term lists."""

    def __init__(self, names: list[str]):
        self.numbers = dict(zip(names, range(len(names))))

    def of(self, found: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(text, term, tf)``; a null list has no terms."""
        flat = found.flatten().dictionary_encode()
        known = np.array([self.numbers.get(t, -1) for t in flat.dictionary.to_pylist()], np.int64)
        term = known[flat.indices.to_numpy()] if len(flat) else np.zeros(0, np.int64)
        text = np.repeat(np.arange(len(found)), found.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
        return _counted(text[term >= 0], term[term >= 0], len(self.numbers))


class AllWindows(WindowCounts):
    """Numbers the windows of lower-case texts as they come; counts all of them."""

    def __init__(self, low: int, high: int):
        super().__init__([], low, high)

    def forget(self) -> None:
        super().forget()
        self.numbers, self.listed = {}, []

    def names(self) -> list[str]:
        self.listed += islice(self.numbers, len(self.listed), None)
        return self.listed

    def add_fresh(self) -> None:
        found, sizes, numbers = [], [], self.numbers
        for word in self.fresh:
            p, before = f" {word} ", len(found)
            for n in self.sizes:
                found += [numbers.setdefault(p[i : i + n], len(numbers)) for i in range(len(p) - n + 1)]
            sizes.append(len(found) - before)
        self.terms = np.concatenate([self.terms, np.array(found, np.int64)])
        self.begin = np.concatenate([self.begin, self.begin[-1] + np.cumsum(np.array(sizes, np.int64))])
        self.fresh = []


def _stats(terms: pa.Array, df: np.ndarray, tf: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([terms, pa.array(df.astype(np.int64)), pa.array(tf.astype(np.int64))], names=["term", "df", "tf"])


def _sorted_windows(windows: AllWindows, texts: pa.Array) -> pa.Array:
    """The windows of every text in code point order, repeats kept; null for a null text."""
    if len(windows) > WORDS:
        windows.forget()
    text, term, tf = windows.of(texts)
    met = np.zeros(len(windows.numbers), bool)
    met[term] = True
    numbers = np.flatnonzero(met)
    names = windows.names()
    own = pa.array([names[i] for i in numbers], pa.string())
    order = pc.sort_indices(own)
    rank = np.zeros(len(met), np.int64)
    rank[numbers[order.to_numpy()]] = np.arange(len(numbers))
    key = text * max(1, len(numbers)) + rank[term]
    at = np.argsort(key)
    text, term = np.divmod(np.repeat(key[at], tf[at]), max(1, len(numbers)))
    ends = pa.array(np.searchsorted(text, np.arange(len(texts) + 1)), pa.int32())
    return pa.ListArray.from_arrays(ends, own.take(order).take(pa.array(term)), mask=texts.is_null())


def sorted_windows(low: int, high: int, between: str) -> Callable[[Column], Column]:
    """For a lower-case text its windows inside words, sorted and joined; joined here, as a list of them costs Spark more than making them."""

    @F.arrow_udf("string")
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        windows = AllWindows(low, high)
        for texts in batches:
            parts = [pc.binary_join(_sorted_windows(windows, texts.slice(a, 4 * PIECE)), between) for a in range(0, len(texts), 4 * PIECE)]
            yield pa.concat_arrays(parts) if parts else pa.array([], pa.string())

    return found


class WindowStats:
    """``(term, df, tf)`` of all windows of lower-case texts, added up over a task unless it meets very many words."""

    def __init__(self, low: int, high: int):
        self.windows, self.df, self.tf = AllWindows(low, high), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, texts: pa.Array) -> Iterator[pa.RecordBatch]:
        if len(self.windows) > WORDS:
            yield from self.rest()
        _, term, tf = self.windows.of(texts)
        more = np.zeros(len(self.windows.numbers) - len(self.df), np.int64)
        n = len(self.windows.numbers)
        self.df = np.concatenate([self.df, more]) + np.bincount(term, minlength=n)
        self.tf = np.concatenate([self.tf, more]) + np.bincount(term, tf, n).astype(np.int64)

    def rest(self) -> Iterator[pa.RecordBatch]:
        if len(self.df):
            yield _stats(pa.array(list(self.windows.numbers), pa.string()), self.df, self.tf)
        self.windows.forget()
        self.df = self.tf = np.zeros(0, np.int64)


class GramStats:
    """``(term, df, tf)`` of all n-grams of up to ``high`` neighbours of token lists, batch by batch."""

    def __init__(self, high: int):
        self.high = high

    def add(self, tokens: pa.Array) -> Iterator[pa.RecordBatch]:
        flat = tokens.flatten().dictionary_encode()
        if not len(flat):
            return
        word = flat.indices.to_numpy().astype(np.int64)
        text = np.repeat(np.arange(len(tokens)), tokens.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
        width, names = len(flat.dictionary), flat.dictionary
        at, gram = np.arange(len(word)), word
        for n in range(1, self.high + 1):
            if n > 1:
                there = at + n - 1 < len(word)
                at, gram = at[there], gram[there]
                same = text[at] == text[at + n - 1]
                at, key = at[same], gram[same] * width + word[at[same] + n - 1]
                keys, gram = np.unique(key, return_inverse=True)
                head, last = np.divmod(keys, width)
                names = pc.binary_join_element_wise(names.take(pa.array(head)), flat.dictionary.take(pa.array(last)), " ")
            if not len(gram):
                return
            _, term, tf = _counted(text[at], gram, len(names))
            yield _stats(names, np.bincount(term, minlength=len(names)), np.bincount(term, tf, len(names)))

    def rest(self) -> Iterator[pa.RecordBatch]:
        return iter(())


def known_counts(kind: tuple, names: list[str]) -> WindowCounts | GramCounts | TermCounts:
    """What counts the known terms of a space of this kind."""
    return {"windows": lambda: WindowCounts(names, *kind[1:]), "words": lambda: GramCounts(names, *kind[1:]), "terms": lambda: TermCounts(names)}[kind[0]]()


def all_stats(kind: tuple) -> WindowStats | GramStats:
    return {"windows": lambda: WindowStats(*kind[1:]), "words": lambda: GramStats(*kind[1:]), "terms": lambda: GramStats(1)}[kind[0]]()


def whole_ids(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """About ``rows`` rows at a time of batches ordered by their first column, the id; rows of one id stay together, rows without one need not."""
    held: list[pa.RecordBatch] = []
    for piece in pieces(batches, rows):
        held.append(piece)
        if sum(b.num_rows for b in held) < rows:
            continue
        whole = pa.concat_batches(held)
        ids = whole.column(0)
        last = len(ids) if not ids[-1].is_valid else int(np.flatnonzero(run_starts(ids))[-1])
        if last:
            yield whole.slice(0, last)
        held = [whole.slice(last)] if last < len(ids) else []
    if held:
        yield pa.concat_batches(held)


class Table:
    """Rows ``(term, column, value, ...)`` ordered by term, for sums over the terms of a text.

    ``idf`` has a number per term, ``norms`` how often the square of a term's own weight counts for the text's length.
    """

    def __init__(self, n_columns: int, term: np.ndarray, column: np.ndarray, values: list[np.ndarray], idf: np.ndarray, norms: np.ndarray):
        order = np.argsort(term, kind="stable")
        self.n_columns, self.idf, self.norms = n_columns, idf, norms
        self.begin = np.searchsorted(term[order], np.arange(len(idf) + 1))
        self.column, self.values = column[order], [v[order] for v in values]
        # A well-filled table of one value is kept dense.
        self.dense, cells = None, len(idf) * n_columns
        if len(values) == 1 and cells <= DENSE_CELLS and len(term) * 8 >= cells > 0:
            self.dense = np.bincount(term * n_columns + column, values[0], cells).reshape(len(idf), n_columns)

    def own(self, term: np.ndarray, tf: np.ndarray) -> np.ndarray:
        return (1 + np.log(tf)) * self.idf[term]

    def squares(self, group: np.ndarray, term: np.ndarray, own: np.ndarray, n_groups: int) -> np.ndarray:
        return np.bincount(group, own * own * self.norms[term], n_groups)

    def sums(self, group: np.ndarray, term: np.ndarray, factors: list[np.ndarray], n_groups: int) -> list[np.ndarray]:
        """For each factor and value the sums of their products, ``n_groups`` times columns; ``group`` ascends."""
        if self.dense is not None:
            return [self._dense_sums(group, term, factors[0], n_groups)]
        out = [np.zeros(n_groups * self.n_columns) for _ in factors]
        size = self.begin[term + 1] - self.begin[term]
        cuts = np.flatnonzero(np.diff(np.cumsum(size) // PRODUCTS, prepend=0)) if len(term) else []
        for a, b in zip([0, *cuts], [*cuts, len(term)]):
            if a == b:
                continue
            at, low = _ranges(self.begin[term[a:b]], size[a:b]), group[a]
            cell = np.repeat((group[a:b] - low) * self.n_columns, size[a:b]) + self.column[at]
            cells = slice(low * self.n_columns, (group[b - 1] + 1) * self.n_columns)
            for total, factor, value in zip(out, factors, self.values):
                total[cells] += np.bincount(cell, np.repeat(factor[a:b], size[a:b]) * value[at], cells.stop - cells.start)
        return [total.reshape(n_groups, self.n_columns) for total in out]

    def _dense_sums(self, group: np.ndarray, term: np.ndarray, factor: np.ndarray, n_groups: int) -> np.ndarray:
        out, step = np.zeros((n_groups, self.n_columns)), max(1, PRODUCTS // self.n_columns)
        for a in range(0, len(term), step):
            own = group[a : a + step]
            begin = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            out[own[begin]] += np.add.reduceat(self.dense[term[a : a + step]] * factor[a : a + step, None], begin)
        return out


def run_starts(ids: pa.Array) -> np.ndarray:
    """True where an id differs from the one before; nulls are alike."""
    before, now = ids[:-1], ids[1:]
    differ = pc.fill_null(pc.not_equal(before, now), False).to_numpy(zero_copy_only=False)
    null = ids.is_null().to_numpy(zero_copy_only=False)
    return np.r_[True, differ | (null[1:] != null[:-1])][: len(ids)]


def pieces(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a in range(0, batch.num_rows, rows):
            yield batch.slice(a, rows)


def by_id(
    batches: Iterator[pa.RecordBatch],
    rows: int,
    sums: Callable[[pa.RecordBatch, np.ndarray, int], np.ndarray],
    done: Callable[[pa.Array, np.ndarray], pa.RecordBatch],
) -> Iterator[pa.RecordBatch]:
    """``done(ids, sums)`` of rows that come ordered by their first column, the id; rows of one id are added up.

    ``sums(piece, group, n)`` gives a row of sums per group.  The last id of a piece may go on in the next one, so its
    sums are kept until then.
    """
    held = None
    for piece in pieces(batches, rows):
        starts = run_starts(piece.column(0))
        ids, found = piece.column(0).filter(pa.array(starts)), sums(piece, np.cumsum(starts) - 1, int(starts.sum()))
        if held is not None:
            if run_starts(pa.concat_arrays([held[0], ids[:1]]))[1]:
                yield done(*held)
            else:
                found[0] += held[1][0]
        yield done(ids[:-1], found[:-1])
        held = ids[-1:], found[-1:].copy()
    if held is not None:
        yield done(*held)


class Vectors:
    """TF-IDF entries of texts, by a vocabulary ``(space, term, idf, feature)`` that a task holds.

    ``kinds`` names the kind of each space, in the order of the columns behind the id.
    """

    def __init__(self, vocab: pa.Table, kinds: dict[str, tuple], sublinear: bool = True):
        self.sublinear, self.size = sublinear, max([-1, *vocab["feature"].to_pylist()]) + 1
        self.spaces, of = [], vocab["space"].to_pylist()
        for name, kind in kinds.items():
            own = vocab.filter(pa.array([s == name for s in of], pa.bool_()))
            self.spaces.append((known_counts(kind, own["term"].to_pylist()), own["idf"].to_numpy(), own["feature"].to_numpy().astype(np.int64)))

    def of(self, piece: pa.RecordBatch) -> tuple[np.ndarray, int, np.ndarray, np.ndarray, np.ndarray]:
        """The group of every row, how many there are, and ``(row, feature, weight)`` of all entries.

        Rows of one id form a group, and a group's entries in one space have length one together.  Rows without an id have none.
        """
        group = np.cumsum(run_starts(piece.column(0))) - 1
        n, there = int(group[-1]) + 1 if len(group) else 0, np.flatnonzero(piece.column(0).is_valid().to_numpy(zero_copy_only=False))
        rows, features, weights = [], [], []
        for i, (counts, idf, feature) in enumerate(self.spaces, 1):
            text, term, tf = counts.of(piece.column(i).take(pa.array(there, pa.int64())))
            row, own = there[text], (1 + np.log(tf) if self.sublinear else tf) * idf[term]
            length = np.sqrt(np.bincount(group[row], own * own, n))
            rows.append(row)
            features.append(feature[term])
            weights.append(own / length[group[row]])
        return group, n, np.concatenate(rows), np.concatenate(features), np.concatenate(weights)

    def added(self, piece: pa.RecordBatch) -> tuple[np.ndarray, int, np.ndarray, np.ndarray, np.ndarray]:
        """Like :meth:`of`, with one ``(group, feature, weight)`` for entries that agree in both, in this order."""
        group, n, row, feature, weight = self.of(piece)
        key = group[row] * self.size + feature
        order = np.argsort(key, kind="stable")
        key, weight = key[order], weight[order]
        begin = np.flatnonzero(np.r_[True, key[1:] != key[:-1]][: len(key)])
        if len(begin) < len(key):
            key, weight = key[begin], np.add.reduceat(weight, begin)
        return group, n, *np.divmod(key, max(1, self.size)), weight

    def per_row(self, piece: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(row, feature, weight)``: every row of an id with all entries of the id."""
        group, n, row, feature, weight = self.of(piece)
        if n == len(group):
            return row, feature, weight
        of = group[row]
        order = np.argsort(of, kind="stable")
        begin = np.searchsorted(of[order], np.arange(n + 1))
        size = np.diff(begin)[group]
        at = order[_ranges(begin[group], size)]
        return np.repeat(np.arange(len(group)), size), feature[at], weight[at]

    def lists(self, piece: pa.RecordBatch) -> tuple[np.ndarray, pa.Array, pa.Array]:
        """The group of every row, and the features and weights of every group."""
        group, n, of, feature, weight = self.added(piece)
        ends = pa.array(np.searchsorted(of, np.arange(n + 1)), pa.int32())
        return group, pa.ListArray.from_arrays(ends, pa.array(feature, pa.int32())), pa.ListArray.from_arrays(ends, pa.array(weight))


class LabelSums:
    """Weights added up per label and feature over a task; a part goes out when the table has become large."""

    def __init__(self, size: int):
        self.size, self.places, self.total = size, {}, np.zeros((0, size))

    def add(self, labels: pa.Array, of: np.ndarray, feature: np.ndarray, weight: np.ndarray) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
        """Add entries ``(of, feature, weight)``, where ``of`` is a place in ``labels``."""
        code = labels.dictionary_encode()
        names, index = code.dictionary.to_pylist(), pc.fill_null(code.indices, len(code.dictionary)).to_numpy()
        # Some labels at a time, so that the table stays bounded.
        step = max(1, DENSE_CELLS // max(1, self.size))
        names.append(None)
        for a in range(0, len(names), step):
            part = names[a : a + step]
            if self.places and len(self.places.keys() | set(part)) > step:
                yield from self.rest()
            place = np.array([self.places.setdefault(v, len(self.places)) for v in part])
            if len(self.places) > len(self.total):
                self.total = np.concatenate([self.total, np.zeros((len(self.places) - len(self.total), self.size))])
            own = (index[of] >= a) & (index[of] < a + step)
            key = place[index[of[own]] - a] * self.size + feature[own]
            if len(key) * 4 > self.total.size:
                self.total += np.bincount(key, weight[own], self.total.size).reshape(self.total.shape)
            else:
                np.add.at(self.total.reshape(-1), key, weight[own])

    def rest(self) -> Iterator[tuple[list, np.ndarray, np.ndarray, np.ndarray]]:
        """``(labels, place of the label, feature, sum)``."""
        place, feature = np.nonzero(self.total)
        if len(place):
            yield list(self.places), place, feature, self.total[place, feature]
        self.places, self.total = {}, np.zeros((0, self.size))
