"""Hard negatives by slots between the upper limits of an anchor's positives.

An anchor's positives are its best other rows of the same label.  For each of them the
hard negatives are the best rows of another label whose score lies between two shares of the
positive's score.  These windows overlap.  Their upper limits cut the scores into disjoint
slots; each task keeps the ``k`` best rows of every slot of every anchor, and so does the merge of the tasks'
results.  The slots of an anchor, put in descending order, answer all its windows: a window's rows
are the first ``k`` from its own slot on, as far as they reach its lower limit.

All rows are scored against the anchors in blocks: a block of at most
``BLOCK_BYTES`` of anchors goes to all tasks, one block after the other, and rows are never shuffled or
copied.  What leaves a task is bounded by anchors, slots and ``k``.

Rows with a null id, label or vector, or with a null or non-finite component take no part.
Rows that share an id are rows of their own, but none is compared with a row of its own id; equal
anchors are answered once.  Vectors of different lengths are compared as if the shorter one ended in zeros.
Ties go to the smaller id.  Scores are exact integers; beyond the range of a long they stand for its
ends.  An empty table, an anchor without a positive and a window without a row give no rows.  Other
columns are not read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from topicloom.plans.bounds import materialize
from topicloom.session import new_shared_path

SCALE = 256
BLOCK_BYTES = 8 << 20
#: Anchors and rows that are multiplied at a time.
ANCHORS_AT_ONCE, ROWS_AT_ONCE = 256, 2048
LEAST, MOST = -(1 << 63), (1 << 63) - 1
FOUND = "anchor long, slot int, score long, id long"
WINDOWS = "anchor long, anchor_id long, positive_id long, positive_score long, own int, least long"
ANSWER = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def usable(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: Column | str = "label") -> DataFrame:
    """``(id, label, vector)`` of the rows that take part."""
    label = F.col(label) if isinstance(label, str) else label
    own = rows.select(
        F.col(key).cast("long").alias("id"), label.cast("long").alias("label"), F.col(vector).cast("array<double>").alias("vector")
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return own.dropna().filter(finite)


def matrix(vectors: pa.Array, width: int, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) of every component as doubles, one row for each vector, zeros behind the shorter ones."""
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(vectors), width))
    flat = np.floor(vectors.flatten().to_numpy(zero_copy_only=False) * scale)
    row = np.repeat(np.arange(len(vectors)), lengths)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of all rows of ``a`` with all of ``b`` as longs."""
    most = max(1.0, np.abs(a).max(initial=0)) * max(1.0, np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if most < 1 << 53:
        return (a @ b.T).astype(np.int64)
    whole = np.frompyfunc(int, 1, 1)
    exact = whole(a).astype(object) @ whole(b).astype(object).T
    return np.clip(exact, LEAST, MOST).astype(np.int64)


def best(anchor: np.ndarray, slot: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` best of each anchor and slot; smaller ids first among equal scores."""
    order = np.lexsort((ids, ~score, slot, anchor))
    a, s = anchor[order], slot[order]
    new = np.r_[True, (a[1:] != a[:-1]) | (s[1:] != s[:-1])] if len(order) else np.zeros(0, bool)
    start = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0)) if len(order) else order
    return order[np.arange(len(order)) - start < k]


class Keeper:
    """The ``k`` best rows seen so far of each anchor and slot."""

    def __init__(self, anchors: int, slots: int, k: int):
        self.k, self.slots, self.held, self.waiting, self.n = k, slots, [], [], 0
        self.limit = max(1 << 18, 2 * anchors * slots * k)
        #: A score below this can no longer enter.
        self.floor = np.full((anchors, slots), LEAST, np.int64)

    def add(self, anchor, slot, score, ids):
        enters = score >= self.floor[anchor, slot]
        self.waiting.append([x[enters] for x in (anchor, slot, score, ids)])
        self.n += int(enters.sum())
        if self.n > self.limit:
            self.settle()

    def settle(self) -> list[np.ndarray]:
        if self.waiting:
            parts = [np.concatenate(x) for x in zip(*([self.held] if self.held else []), *self.waiting)]
            kept = best(*parts, self.k)
            self.held, self.waiting = [p[kept] for p in parts], []
            a, s, score, _ = self.held
            # Rows of an anchor and slot stand together, best first: a full one's last score is its floor.
            n = max(0, len(a) - self.k + 1)
            full = np.flatnonzero((a[self.k - 1 :] == a[:n]) & (s[self.k - 1 :] == s[:n])) + self.k - 1
            self.floor[a[full], s[full]] = score[full]
            self.n = 0
        return self.held


def _search(rows: DataFrame, block: dict, slots: int, k: int, choose) -> DataFrame:
    """The ``k`` best rows of each anchor of the block and slot, as a written table.

    ``choose(anchors, scores, same, a, b)`` tells the slot of each score of the anchors from ``a`` to ``b``, -1 for none.
    """
    sent = rows.sparkSession.sparkContext.broadcast(block)
    width, scale = block["vectors"].shape[1], block["scale"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = sent.value
        keeper = Keeper(len(anchors["id"]), slots, k)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                ids, labels = (part.column(c).to_numpy(zero_copy_only=False) for c in ("id", "label"))
                own = matrix(part.column("vector"), width, scale)
                for a in range(0, len(anchors["id"]), ANCHORS_AT_ONCE):
                    b = a + ANCHORS_AT_ONCE
                    scores = products(anchors["vectors"][a:b], own)
                    slot = choose(anchors, scores, anchors["label"][a:b, None] == labels, a, b)
                    slot[anchors["id"][a:b, None] == ids] = -1
                    x, y = np.nonzero(slot >= 0)
                    keeper.add(x + a, slot[x, y], scores[x, y], ids[y])
        held = keeper.settle()
        if held:
            columns = [pa.array(anchors["anchor"][held[0]]), *map(pa.array, held[1:])]
            for at in range(0, len(held[0]), 1 << 16):
                yield pa.RecordBatch.from_arrays([c.slice(at, 1 << 16) for c in columns], names=["anchor", "slot", "score", "id"])

    order = W.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id")
    found = rows.mapInArrow(run, FOUND).withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= k).drop("_n")
    written = materialize(found, "found")
    sent.destroy()
    return written


def _same_label(anchors, scores, same, a, b):
    return np.where(same, 0, -1).astype(np.int32)


def _slot_of(anchors, scores, same, a, b):
    """How many upper limits of its anchor a score does not exceed, less one; none above all limits or below all windows."""
    slot = np.full(scores.shape, -1, np.int32)
    for limit in anchors["upper"][a:b].T:
        slot += scores <= limit[:, None]
    slot[same | (scores < anchors["lower"][a:b, None])] = -1
    return slot


def _blocks(anchors: DataFrame, width: int, scale: int) -> Iterator[dict]:
    """The written anchors as blocks of arrays, each of about ``BLOCK_BYTES``, one after the other."""
    count = -(-anchors.count() * (8 * width + 100) // BLOCK_BYTES)
    for k in range(count):
        part = anchors.filter(F.pmod(F.xxhash64("anchor"), F.lit(count)) == k).toArrow().combine_chunks()
        block = {c: part.column(c).to_numpy() for c in ("anchor", "id", "label")}
        vectors = part.column("vector").combine_chunks()
        yield {**block, "vectors": matrix(vectors, width, scale), "scale": scale}


def _windows(block: dict, found: DataFrame, positives: int, lower: int, upper: int) -> list[tuple]:
    """A row ``(anchor, anchor_id, positive_id, positive_score, slot, least)`` for each positive that may have negatives.

    The limits are put into the block: upper ones in descending order, and the least lower one.
    """
    n = len(block["id"])
    place = {a: i for i, a in enumerate(block["anchor"].tolist())}
    block["upper"], block["lower"] = np.full((n, positives), LEAST), np.full(n, MOST)
    rows = found.select("anchor", "score", "id").orderBy("anchor", F.desc("score"), "id").toLocalIterator()
    out = []
    for anchor, group in itertools.groupby(rows, lambda r: r.anchor):
        i = place[anchor]
        # The window of a score below zero is empty.
        known = [(r.id, r.score, r.score * upper // 100, -(-r.score * lower // 100)) for r in group if r.score >= 0]
        highs = [high for _, _, high, _ in known]
        block["upper"][i, : len(known)] = highs
        block["lower"][i] = min([low for *_, low in known], default=MOST)
        out += [
            (anchor, int(block["id"][i]), other, score, sum(h >= high for h in highs) - 1, low)
            for other, score, high, low in known
        ]
    return out


def hard_negatives(
    rows: DataFrame, is_anchor: Column, positives: int = 5, k: int = 10, lower: int = 30, upper: int = 90, scale: int = SCALE
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)`` for the :func:`usable` rows.

    A negative's score times 100 lies between ``lower`` and ``upper`` times the positive's score.
    """
    spark = rows.sparkSession
    width = max(1, rows.agg(F.max(F.size("vector"))).first()[0] or 0)
    numbered = rows.filter(is_anchor).distinct().withColumn("anchor", F.monotonically_increasing_id())
    path = new_shared_path(spark, "negatives")
    spark.createDataFrame([], ANSWER).write.parquet(path)
    for block in _blocks(materialize(numbered, "anchors"), width, scale):
        windows = _windows(block, _search(rows, block, 1, positives, _same_label), positives, lower, upper)
        if not windows:
            continue
        slots = _search(rows, block, positives, k, _slot_of)
        ranked = slots.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("slot", F.bitwise_not("score").alias("down"), "id"))).alias("all"))
        from_slot = F.slice(F.filter("all", lambda x: x.slot >= F.col("own")), 1, k)
        met = spark.createDataFrame(windows, WINDOWS).join(ranked, "anchor").select(
            "*", F.posexplode(F.filter(from_slot, lambda x: F.bitwise_not(x.down) >= F.col("least"))).alias("at", "one")
        )
        met.select(
            "anchor_id", "positive_id", (F.col("at") + 1).alias("rank"), F.col("one.id").alias("negative_id"), "positive_score",
            F.bitwise_not(F.col("one.down")).alias("negative_score"),
        ).write.mode("append").parquet(path)
    return spark.read.schema(ANSWER).parquet(path)
