"""Truncated singular value decomposition of long sparse tables.

A table of n sparse rows over a capped vocabulary is reduced to its leading directions by
subspace iteration: a block Q of a few orthonormal columns goes to all tasks, each of which
adds up A'(AQ) over its rows, and the sums become the next block.  What moves is the block, vocabulary times
``rank`` plus a few numbers, never the rows.  Its size is checked before it is made.

Numpy works inside the tasks: as joins, every pass would explode each row's
entries with a dense vector beside every one of them and sort them by row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from topicloom.plans.bounds import materialize
from topicloom.session import share_package

#: The most bytes that a block may take on the driver and in every task.
BLOCK_BYTES = 64 << 20
#: Features whose sums travel together.
STRIPE = 256
#: Rows of a batch that are multiplied at a time.
ROWS = 1024


def sparse_rows(weights: DataFrame, id_col: str) -> DataFrame:
    """``(id, features, weights)`` from one row per ``(id, feature, weight)``; features ascend."""
    entries = weights.groupBy(id_col).agg(F.sort_array(F.collect_list(F.struct("feature", "weight"))).alias("_e"))
    return entries.select(id_col, F.col("_e.feature").alias("features"), F.col("_e.weight").alias("weights"))


def _batches(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For some rows at a time: how many, and the row, feature and weight of every entry."""
    for at in range(0, batch.num_rows, ROWS):
        part = batch.slice(at, ROWS)
        lengths = part.column("features").value_lengths().to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(part.num_rows), lengths)
        flat = [part.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("features", "weights")]
        yield part.num_rows, row, *flat


def _times(n: int, row: np.ndarray, feature: np.ndarray, weight: np.ndarray, block: np.ndarray) -> np.ndarray:
    """The rows times the block; the entries of a row stand together."""
    out = np.zeros((n, block.shape[1]))
    if len(row):
        starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        out[row[starts]] = np.add.reduceat(block[feature] * weight[:, None], starts)
    return out


def gram_product(rows: DataFrame, block: np.ndarray) -> np.ndarray:
    """A'(A block) for the sparse rows A."""
    size, width = block.shape
    share_package(rows.sparkSession)
    sent = rows.sparkSession.sparkContext.broadcast(block)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, width))
        for batch in batches:
            for n, row, feature, weight in _batches(batch):
                np.add.at(total, feature, _times(n, row, feature, weight, sent.value)[row] * weight[:, None])
        for at in range(0, size, STRIPE):
            part = total[at : at + STRIPE]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([part.tobytes()], pa.binary())], names=["at", "part"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, part in zip(batch.column("at").to_pylist(), batch.column("part").to_pylist()):
                sums[at] = sums.get(at, 0) + np.frombuffer(part)
        for at, part in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([part.tobytes()], pa.binary())], names=["at", "part"])

    kind = "at int, part binary"
    out = np.zeros((size, width))
    for at, part in rows.select("features", "weights").mapInArrow(add, kind).repartition("at").mapInArrow(merge, kind).collect():
        out[at : at + STRIPE] = np.frombuffer(part).reshape(-1, width)
    sent.destroy()
    return out


@dataclass
class Reduction:
    """The leading directions of a table: ``directions`` is vocabulary times rank, ``singular`` descends."""

    directions: np.ndarray
    singular: np.ndarray

    def transform(self, rows: DataFrame, id_col: str, unit: bool = True) -> DataFrame:
        """``(id, reduced)``: every sparse row in the new coordinates, of length one (or zero) with ``unit``."""
        share_package(rows.sparkSession)
        sent = rows.sparkSession.sparkContext.broadcast(self.directions)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at = 0
                for n, row, feature, weight in _batches(batch):
                    out = _times(n, row, feature, weight, sent.value)
                    if unit:
                        length = np.linalg.norm(out, axis=1, keepdims=True)
                        out = np.divide(out, length, out=np.zeros_like(out), where=length > 0)
                    flat, ends = pa.array(out.ravel()), pa.array(np.arange(n + 1) * out.shape[1], pa.int32())
                    yield pa.RecordBatch.from_arrays([batch.column(id_col).slice(at, n), pa.ListArray.from_arrays(ends, flat)], names=[id_col, "reduced"])
                    at += n

        kind = rows.schema[id_col].dataType.simpleString()
        return rows.select(id_col, "features", "weights").mapInArrow(run, f"`{id_col}` {kind}, reduced array<double>")


def truncated_svd(
    rows: DataFrame, size: int, rank: int, extra: int = 10, passes: int = 4, seed: int = 42
) -> Reduction:
    """The ``rank`` leading singular values and directions of the :func:`sparse_rows`, a written table.

    ``size`` is the number of features.  ``extra`` columns and more ``passes`` make the last directions more exact.
    Directions are signed so that their largest part is positive.
    """
    width = min(size, rank + extra)
    if size * width * 8 > BLOCK_BYTES:
        raise ValueError(f"a block of {size} x {width} numbers is above {BLOCK_BYTES} bytes; use a smaller vocabulary or rank")
    block = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, width)))[0]
    for k in range(passes + 1):
        product = gram_product(rows, block)
        if k < passes:
            block = np.linalg.qr(product)[0]
    values, turn = np.linalg.eigh(block.T @ product)
    order = np.argsort(-values)[:rank]
    directions = block @ turn[:, order]
    signs = np.sign(directions[np.abs(directions).argmax(axis=0), np.arange(len(order))])
    return Reduction(directions * np.where(signs == 0, 1, signs), np.sqrt(np.maximum(values[order], 0)))


def reduce_rows(weights: DataFrame, id_col: str, size: int, rank: int, **options) -> tuple[DataFrame, Reduction]:
    """``(id, reduced)`` of unit rows, written once, and the reduction they come from."""
    rows = materialize(sparse_rows(weights, id_col), "sparse-rows")
    found = truncated_svd(rows, size, rank, **options)
    return materialize(found.transform(rows, id_col), "reduced"), found
