"""Small pieces the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

#: A word: a run of anything but the six ASCII white-space characters.  On UTF-8
#: bytes this is what ``bytes.split()`` gives.
WORD = r"[^\x20\x09-\x0D]+"
SPACE_BYTES = b" \t\n\x0b\x0c\r"


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; -1 for a null id."""
    return F.coalesce(
        F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(modulus)), F.lit(-1)
    )


def apart(documents: DataFrame, *read: str) -> DataFrame:
    """``documents`` with all columns but those ``read`` named by position, so that no other name meets theirs."""
    return documents.toDF(*[c if c in read else f"column_{i}_" for i, c in enumerate(documents.columns)])


def class_sample(labelled: DataFrame, label: str, rows: int, key: str = "doc_id") -> DataFrame:
    """At most ``rows`` rows of ``(key, label)``, spread evenly over the labels by a hash of the key.

    The bound is strict: a threshold per label keeps about its share of ``rows`` and
    the ordered limit cuts what is left over.  Null keys and labels are left out.
    Only one count per label comes to the driver.
    """
    known = labelled.select(key, label).dropna()
    counts = {r[0]: r[1] for r in known.groupBy(label).count().toLocalIterator()}
    if not counts:
        return known.limit(0)
    share = rows / len(counts)
    draw = F.pmod(F.xxhash64(F.col(key), F.lit(11)), F.lit(1 << 30))
    keep = F.lit(False)
    for value, n in counts.items():
        keep = keep | ((F.col(label) == F.lit(value)) & (draw < F.lit(int(min(1.0, share / n) * (1 << 30)))))
    return known.filter(keep).orderBy(draw, key, label).limit(rows)


def binaries(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """The column's values as UTF-8 bytes; null becomes empty."""
    column = pc.fill_null(batch.column(name).cast(pa.large_binary()), b"")
    return column.to_pylist()


def slices(batches: Iterator[pa.RecordBatch], name: str, size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each part holds about ``size`` bytes of the text column, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(name).cast(pa.large_binary())), 0)
        part = np.cumsum(lengths.to_numpy(zero_copy_only=False)) // size
        starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
        for a, b in zip(starts, np.r_[starts[1:], batch.num_rows]):
            yield batch.slice(int(a), int(b - a))


def to_signed(values: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit values as the signed longs Spark keeps."""
    return values.astype(np.uint64, copy=False).view(np.int64)
