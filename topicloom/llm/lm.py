"""Language-model scores by deleted interpolation.

The probability of a token is a mix of maximum-likelihood estimates from its contexts,

    p_k(w | h) = mix_k(b) * c(h w) / c(h) + (1 - mix_k(b)) * p_{k-1}(w | shorter h)

where b is the bucket of the context's frequency c(h) and p_1 the unigram estimate with
half a count added.  ``mix_k`` is learned by expectation-maximisation on n-grams that were
held out of the training documents when their contexts were counted.

Documents are cut into chunks, written once, that hold their tokens as numbers into a
vocabulary of their own.  A chunk sends each distinct n-gram once, with how often it is
counted there; n-grams meet by a range of their hashes, are summed over all chunks, and
the sums go back to the chunks that asked.  No table of all n-grams, nor of all
words, stands in one place, and a very frequent n-gram arrives once per chunk.

A null text is empty: its only token is the end.  A null id is never held out;
repeated rows count as often as they occur; with an empty table there are no rows.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from topicloom.llm.common import binaries, slices
from topicloom.plans.bounds import materialize

#: Bytes of text in a chunk, and n-grams in a range, about.
CHUNK_BYTES = 12 << 20
RANGE_GRAMS = 1 << 20
#: Contexts seen up to 1, 2, 4, ... times have a bucket each; the last one is open.
BUCKETS = 12
#: Of the training documents, one in so many gives the held-out counts.
HELD_EVERY = 10
#: Held-out n-grams are summed by bucket and by the logarithm of how the two estimates
#: differ, in steps of a twentieth of a power of ten; that is all that a step of the
#: expectation-maximisation needs.
RATIO_STEP = 0.05
END = b"\n"
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
SCORED, COUNTED, HELD_BACK = 0, 1, 2
CHUNK_SCHEMA = "chunk long, kind int, doc_ids binary, lengths binary, tokens binary, vocabulary binary, n_tokens long, n_words long"


def packed(values: np.ndarray) -> bytes:
    """Numbers by byte planes, compressed: leading bytes of small numbers cost next to nothing."""
    planes = values.view(np.uint8).reshape(-1, values.itemsize).T
    return pa.compress(np.ascontiguousarray(planes).tobytes(), codec="zstd", asbytes=True)


def unpacked(data: bytes, dtype, n: int) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    planes = np.frombuffer(pa.decompress(data, n * size, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(size, n).T).view(dtype).ravel()


def packed_sorted(values: np.ndarray) -> bytes:
    """Sorted numbers, by their differences."""
    return packed(np.diff(values, prepend=values.dtype.type(0)))


def unpacked_sorted(data: bytes, dtype, n: int) -> np.ndarray:
    return np.cumsum(unpacked(data, dtype, n), dtype=dtype)


def _combined(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    x = (context ^ (context >> np.uint64(29))) * _M1 + word
    return (x ^ (x >> np.uint64(32))) * _M2


def chunked(documents: DataFrame, held_out: Column) -> DataFrame:
    """A written table with a row per chunk of whole documents of one kind.

    Kinds: scored only, counted, or held back from the counts until the mix is learned.
    A chunk's random name is given once, as only committed rows of the table are read.
    """
    back = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(HELD_EVERY)) == 0
    kind = F.when(held_out, SCORED).when(back, HELD_BACK).otherwise(COUNTED)
    rows = documents.select(F.col("doc_id").cast("long"), "text", kind.alias("kind"))

    def chunk(kind: int, ids: list, texts: list[bytes]) -> pa.RecordBatch:
        from xxhash import xxh64_intdigest

        words = [[*t.lower().split(), END] for t in texts]
        local = dict.fromkeys(w for own in words for w in own)
        hashes = np.fromiter(map(xxh64_intdigest, local), np.uint64, len(local))
        order = np.argsort(hashes)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        place = dict(zip(local, rank.tolist())).__getitem__
        tokens = np.concatenate([np.fromiter(map(place, own), np.int32, len(own)) for own in words])
        doc_ids = pa.array(ids, pa.int64())
        with pa.BufferOutputStream() as sink:
            with pa.ipc.new_stream(sink, pa.schema([("doc_id", pa.int64())])) as out:
                out.write_batch(pa.record_batch([doc_ids], names=["doc_id"]))
            packed_ids = sink.getvalue().to_pybytes()
        lengths = np.array([len(own) for own in words], np.int32)
        name = int.from_bytes(os.urandom(8), "big") >> 1
        blobs = [packed_ids, lengths.tobytes(), packed(tokens), packed_sorted(hashes[order])]
        columns = [pa.array([name]), pa.array([kind], pa.int32()), *[pa.array([x], pa.binary()) for x in blobs], pa.array([len(tokens)]), pa.array([len(local)])]
        return pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in CHUNK_SCHEMA.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_chunks = {k: ([], [], 0) for k in (SCORED, COUNTED, HELD_BACK)}
        for part in slices(batches, "text"):
            for doc_id, text, k in zip(part.column("doc_id").to_pylist(), binaries(part, "text"), part.column("kind").to_pylist()):
                ids, texts, size = open_chunks[k]
                ids.append(doc_id)
                texts.append(text)
                open_chunks[k] = ids, texts, size + len(text)
                if size + len(text) >= CHUNK_BYTES:
                    yield chunk(k, ids, texts)
                    open_chunks[k] = [], [], 0
        for k, (ids, texts, _) in open_chunks.items():
            if ids:
                yield chunk(k, ids, texts)

    return materialize(rows.mapInArrow(run, CHUNK_SCHEMA), "lm-chunks")


class Chunk:
    """A chunk's tokens and the hashes of its n-grams; -1 stands where a document has no such n-gram."""

    def __init__(self, row: dict, order: int):
        self.tokens = unpacked(row["tokens"], np.int32, row["n_tokens"])
        self.lengths = np.frombuffer(row["lengths"], np.int32)
        words = unpacked_sorted(row["vocabulary"], np.uint64, row["n_words"])
        self.keys, self.at = [words], [self.tokens]
        place = np.arange(len(self.tokens)) - np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths)
        code = words[self.tokens]
        own = code
        for k in range(2, order + 1):
            code = np.r_[code[:1], _combined(code[:-1], own[1:])]
            there = place >= k - 1
            keys, inverse = np.unique(code[there], return_inverse=True)
            at = np.full(len(code), -1, np.int64)
            at[there] = inverse
            self.keys.append(keys)
            self.at.append(at)

    def values(self, k: int, counts: np.ndarray) -> np.ndarray:
        """Per token, the count of the k-gram that ends there; 0 where there is none."""
        return np.append(counts, 0)[self.at[k - 1]]


def _asked(chunks: DataFrame, order: int, bits: int) -> DataFrame:
    """``(n, part, chunk, kind, size, keys, counts)``: the distinct n-grams of each chunk, by range of their hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                chunk = Chunk(row, order)
                for k in range(1, order + 1):
                    keys, at = chunk.keys[k - 1], chunk.at[k - 1]
                    counts = np.bincount(at[at >= 0], minlength=len(keys)).astype(np.uint32)
                    part = (keys >> np.uint64(64 - bits)).astype(np.int64)
                    starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]) if len(part) else np.zeros(0, int)
                    ends = np.r_[starts[1:], len(part)]
                    columns = [
                        pa.array(np.full(len(starts), k, np.int32)),
                        pa.array(part[starts]),
                        pa.array(np.full(len(starts), row["chunk"])),
                        pa.array(np.full(len(starts), row["kind"], np.int32)),
                        pa.array(ends - starts, pa.int64()),
                        pa.array([packed_sorted(keys[a:b]) for a, b in zip(starts, ends)], pa.binary()),
                        pa.array([packed(counts[a:b]) for a, b in zip(starts, ends)], pa.binary()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=["n", "part", "chunk", "kind", "size", "keys", "counts"])

    return chunks.mapInArrow(run, "n int, part long, chunk long, kind int, size long, keys binary, counts binary")


_TOTALS = -1


def _answered(asked: DataFrame) -> DataFrame:
    """``(chunk, n, part, size, counted, trained)``: for each asked slice the sums over all chunks.

    ``counted`` leaves out what is held back and goes to held-back chunks alone, ``trained``
    is the whole training count.  A row of chunk -1 has the sums over the range: distinct
    and all, for both.
    """

    def run(table: pa.Table) -> pa.Table:
        n, part = table["n"][0].as_py(), table["part"][0].as_py()
        sizes, kinds = table["size"].to_numpy(), table["kind"].to_numpy()
        asked = [unpacked_sorted(x, np.uint64, k) for x, k in zip(table["keys"].to_pylist(), sizes)]
        times = [unpacked(x, np.uint32, k) for x, k in zip(table["counts"].to_pylist(), sizes)]
        kind = np.repeat(kinds, sizes)
        keys, inverse = np.unique(np.concatenate(asked), return_inverse=True)
        times = np.concatenate(times).astype(np.float64)
        counted, trained = (
            np.bincount(inverse, times * which, len(keys)).astype(np.uint32)
            for which in (kind == COUNTED, kind != SCORED)
        )
        own = np.split(inverse, np.cumsum(sizes)[:-1])
        totals = [np.array([(s > 0).sum(), s.sum(dtype=np.int64)], np.int64).tobytes() for s in (counted, trained)]
        rows = len(own) + 1
        return pa.table({
            "chunk": pa.array([*table["chunk"].to_pylist(), _TOTALS], pa.int64()),
            "n": pa.array([n] * rows, pa.int32()),
            "part": pa.array([part] * rows, pa.int64()),
            "size": pa.array([*sizes.tolist(), 2], pa.int64()),
            "counted": pa.array([*(packed(counted[i]) if k == HELD_BACK else None for i, k in zip(own, kinds)), totals[0]], pa.binary()),
            "trained": pa.array([*(packed(trained[i]) for i in own), totals[1]], pa.binary()),
        })

    schema = "chunk long, n int, part long, size long, counted binary, trained binary"
    return materialize(asked.groupBy("n", "part").applyInArrow(run, schema), "lm-counts")


class Unigrams:
    """(c + 1/2) / (N + (V + 1) / 2)."""

    def __init__(self, distinct: int, total: int):
        self.distinct, self.total = distinct, total

    def __call__(self, counts: np.ndarray) -> np.ndarray:
        return (counts + 0.5) / (self.total + 0.5 * (self.distinct + 1))


def bucket(context: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else 1 + the bit length of its frequency less one, up to the last bucket."""
    seen = np.maximum(context, 1).astype(np.float64)
    return np.where(context > 0, np.minimum(1 + np.ceil(np.log2(seen)).astype(np.int64), BUCKETS), 0)


def mixed(chunk: Chunk, counts: list[np.ndarray], unigrams: Unigrams, mix: dict[int, np.ndarray]) -> tuple[np.ndarray, list]:
    """The probability of every token under the orders in ``mix``, and per-token counts of each n-gram."""
    values = [chunk.values(k, c).astype(np.float64) for k, c in enumerate(counts, 1)]
    p = unigrams(values[0])
    for k in sorted(mix):
        p = _interpolated(values, k, chunk, p, mix[k][bucket(_context(values, k, chunk))])
    return p, values


def _context(values: list[np.ndarray], k: int, chunk: Chunk) -> np.ndarray:
    """Frequency of the k-1 tokens before each token; 0 where the document does not reach so far back."""
    before = np.r_[0.0, values[k - 2][:-1]]
    return np.where(chunk.at[k - 1] >= 0, before, 0.0)


def _interpolated(values, k, chunk, lower, weight):
    context = _context(values, k, chunk)
    likelihood = values[k - 1] / np.maximum(context, 1.0)
    return np.where(context > 0, weight * likelihood + (1 - weight) * lower, lower)


def _grouped(left: pa.Table, right: pa.Table, order: int, column: str) -> tuple[Chunk, list[np.ndarray], dict]:
    row = left.to_pylist()[0]
    slices_of = sorted(zip(*(right[c].to_pylist() for c in ("n", "part", "size", column))))
    counts = [
        np.concatenate([np.zeros(0, np.uint32), *(unpacked(x, np.uint32, size) for n, _, size, x in slices_of if n == k)])
        for k in range(1, order + 1)
    ]
    return Chunk(row, order), counts, row


def _learn_mix(chunks: DataFrame, answers: DataFrame, unigrams: Unigrams, order: int) -> dict[int, np.ndarray]:
    """Weights per bucket for each order, the lower orders first."""
    held = chunks.filter(F.col("kind") == HELD_BACK)
    own = answers.filter(F.col("chunk") != _TOTALS).join(held.select("chunk"), "chunk", "left_semi")
    mix: dict[int, np.ndarray] = {}

    def cells_of(k: int, mix: dict[int, np.ndarray]):
        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            if not left.num_rows:
                return pa.table({c: pa.array([], pa.int64()) for c in ("b", "ratio", "n")})
            chunk, counts, _ = _grouped(left, right, order, "counted")
            lower, values = mixed(chunk, counts, unigrams, mix)
            context = _context(values, k, chunk)
            use = context > 0
            with np.errstate(divide="ignore"):
                ratio = np.log10(values[k - 1][use] / context[use] / lower[use])
            step = np.where(np.isfinite(ratio), np.round(ratio / RATIO_STEP), -9999).astype(np.int64)
            cells, n = np.unique(np.stack([bucket(context[use]), step]), axis=1, return_counts=True)
            return pa.table({"b": cells[0], "ratio": cells[1], "n": n})

        return run

    for k in range(2, order + 1):
        cells = held.groupBy("chunk").cogroup(own.groupBy("chunk")).applyInArrow(cells_of(k, dict(mix)), "b long, ratio long, n long")
        rows = cells.groupBy("b", "ratio").agg(F.sum("n").alias("n")).orderBy("b", "ratio").collect()
        mix[k] = expectation_maximisation([(r.b, r.ratio, r.n) for r in rows])
    return mix


def expectation_maximisation(cells: list[tuple[int, int, int]], rounds: int = 200) -> np.ndarray:
    """The weight of the higher order per bucket, from held-out n-grams ``(bucket, ratio step, how many)``."""
    weights = np.zeros(BUCKETS + 1)
    table = np.array(cells, np.float64).reshape(-1, 3)
    for b in range(1, BUCKETS + 1):
        own = table[table[:, 0] == b]
        if not len(own):
            # No held-out context of this frequency: as much as the next rarer one.
            weights[b] = weights[b - 1]
            continue
        ratio = np.where(own[:, 1] > -9999, 10.0 ** (own[:, 1] * RATIO_STEP), 0.0)
        w = 0.5
        for _ in range(rounds):
            new = float((own[:, 2] * w * ratio / (w * ratio + 1 - w)).sum() / own[:, 2].sum())
            if abs(new - w) < 1e-9:
                break
            w = min(new, 1 - 1e-6)
        weights[b] = w
    return weights


SCORE_SCHEMA = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score(documents: DataFrame, held_out: Column, order: int = 2) -> DataFrame:
    """A row per document: token counts, the base score and ``score``, the model's log10 probability.

    Learns from the documents that are not ``held_out`` and scores all.
    """
    chunks = chunked(documents, held_out)
    size = chunks.agg(F.sum("n_tokens")).first()[0] or 0
    bits = max(1, int(size // RANGE_GRAMS).bit_length())
    answers = _answered(_asked(chunks, order, bits))
    totals = {"counted": np.zeros(2, np.int64), "trained": np.zeros(2, np.int64)}
    for r in answers.filter((F.col("chunk") == _TOTALS) & (F.col("n") == 1)).toLocalIterator():
        for c in totals:
            totals[c] += np.frombuffer(bytes(r[c]), np.int64)
    mix = _learn_mix(chunks, answers, Unigrams(*totals["counted"].tolist()), order)
    unigrams = Unigrams(*totals["trained"].tolist())

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        names = [f.split()[0] for f in SCORE_SCHEMA.split(", ")]
        if not left.num_rows:
            return pa.table([pa.array([], t) for t in (pa.int64(), pa.bool_(), *[pa.int64()] * 3, *[pa.float64()] * 2)], names=names)
        chunk, counts, row = _grouped(left, right, order, "trained")
        p, values = mixed(chunk, counts, unigrams, mix)
        starts = np.cumsum(chunk.lengths) - chunk.lengths
        sums = [np.add.reduceat(x, starts) for x in ((values[0] > 0).astype(np.int64), np.log10(unigrams(values[0])), np.log10(p))]
        ids = pa.ipc.open_stream(row["doc_ids"]).read_all()["doc_id"].combine_chunks()
        n = len(ids)
        return pa.table([
            ids,
            pa.array(np.full(n, row["kind"] == SCORED)),
            pa.array(chunk.lengths.astype(np.int64)),
            pa.array(sums[0]),
            pa.array(np.full(n, unigrams.total, np.int64)),
            pa.array(sums[1]),
            pa.array(sums[2]),
        ], names=names)

    rows = answers.filter(F.col("chunk") != _TOTALS).select("chunk", "n", "part", "size", "trained")
    return chunks.groupBy("chunk").cogroup(rows.groupBy("chunk")).applyInArrow(run, SCORE_SCHEMA)
