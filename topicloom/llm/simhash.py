"""SimHash near-duplicates by deletion-variant signatures.

A 64-bit fingerprint per text (a bit is set if it is set in over half of the hashes of
the text's word shingles) and links between fingerprints that differ in at most
``distance`` bits.  Cut into ``distance // 2 + 1`` segments, two linked fingerprints have a
segment with at most one differing bit.  Each fingerprint is indexed under every segment
with each of its bits in turn left open, so such a pair shares a key; keys are joined by
equality and the whole fingerprints compared in the join.

Equal fingerprints are folded before the index, so groups of copies cost one entry.
Links are pairs between different fingerprints; documents carry the least id reachable.

A null text and one without words have fingerprint 0 and are linked like any other;
rows with a null id belong to their fingerprint's group but never name it; repeated rows
share their group; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from topicloom.llm.common import binaries, slices, to_signed
from topicloom.llm.components import components
from topicloom.plans.bounds import materialize

BITS = 64
SEED = 42


def fingerprint(text: bytes, shingle: int = 4) -> int:
    """The fingerprint of one text, as an unsigned number."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.r_[0, ends[:-1]]
    n = max(1, len(words) - shingle + 1)
    last = ends[min(shingle, len(words)) - 1 :] - 1
    hashes = [xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), last.tolist())]
    half, total = n / 2, np.zeros(BITS, np.int64)
    packed = np.array(hashes, ">u8").view(np.uint8).reshape(n, 8)
    for at in range(0, n, 4096):
        total += np.unpackbits(packed[at : at + 4096], axis=1).sum(0, dtype=np.int32)
    return int.from_bytes(np.packbits(total > half).tobytes(), "big")


def fingerprints(documents: DataFrame, shingle: int = 4) -> DataFrame:
    """``(doc_id, fp)`` of every whole text; ``fp`` is the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            fps = np.array([fingerprint(t, shingle) for t in binaries(batch, "text")], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(to_signed(fps))], names=["doc_id", "fp"])

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fp long")


def variant_keys(fp: Column, distance: int) -> Column:
    """An array with a key for every segment and open bit."""
    count = distance // 2 + 1
    bounds = [BITS * k // count for k in range(count + 1)]
    keys = []
    for a, b in zip(bounds, bounds[1:]):
        segment = F.shiftrightunsigned(fp, a).bitwiseAND(F.lit((1 << (b - a)) - 1))
        for bit in range(b - a):
            # The place of the open bit goes above the segment, which is at most 32 bits long.
            tag = (a + bit) << 33
            keys.append(segment.bitwiseAND(F.lit(((1 << (b - a)) - 1) & ~(1 << bit))).bitwiseOR(F.lit(tag)))
    return F.array(*keys)


def _first_open_bit(x: Column, distance: int) -> Column:
    """The one key under which a pair with differing bits ``x`` is taken, as the place of its open bit.

    It lies in the first segment with at most one differing bit: that bit, or the
    segment's first one where none differs.
    """
    count = distance // 2 + 1
    bounds = [BITS * k // count for k in range(count + 1)]
    place = F.lit(-1)
    for a, b in reversed(list(zip(bounds, bounds[1:]))):
        part = F.shiftrightunsigned(x, a).bitwiseAND(F.lit((1 << (b - a)) - 1))
        bit = F.when(part == 0, a).otherwise(F.bit_count(part - 1) + a)
        place = F.when(F.bit_count(part) <= 1, bit).otherwise(place)
    return place


def links(distinct: DataFrame, distance: int = 4) -> DataFrame:
    """``(a, b)``, a < b: all pairs of the distinct ``fp`` that differ in at most ``distance`` bits.

    A pair may share many keys; it leaves the join under the first of them alone.  The index is never broadcast:
    Spark sizes it without the rows that the explode makes of each fingerprint.
    """
    if not 2 <= distance <= 62:
        raise ValueError("distance must be from 2 to 62")
    index = distinct.select("fp", F.explode(variant_keys(F.col("fp"), distance)).alias("key"))
    left, right = index.withColumnRenamed("fp", "a"), index.withColumnRenamed("fp", "b")
    x = F.col("a").bitwiseXOR(F.col("b"))
    near = (F.col("a") < F.col("b")) & (F.bit_count(x) <= distance)
    first = F.shiftrightunsigned("key", 33) == _first_open_bit(x, distance)
    right = right.withColumnRenamed("key", "_key").hint("merge")
    return left.join(right, (F.col("key") == F.col("_key")) & near & first).select("a", "b")


def near_duplicates(documents: DataFrame, distance: int = 4, shingle: int = 4) -> DataFrame:
    """``(doc_id, fp, component_id, links)`` per row of ``documents``.

    ``component_id`` is the least id of all documents reachable over links, and
    ``links`` the number of other fingerprints that the row's own is linked to.
    """
    rows = materialize(fingerprints(documents, shingle), "fingerprints")
    own = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    pairs = materialize(links(own.select("fp"), distance), "near")
    roots = components(pairs)
    degree = pairs.select(F.explode(F.array("a", "b")).alias("fp")).groupBy("fp").agg(F.count("*").alias("links"))
    named = own.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    by_root = named.groupBy("root").agg(F.min("least").alias("component_id"))
    groups = named.join(by_root, "root").join(degree, "fp", "left").select(
        "fp", "component_id", F.coalesce("links", F.lit(0)).alias("links")
    )
    return rows.join(groups, "fp").select("doc_id", "fp", "component_id", "links")
