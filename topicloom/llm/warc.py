"""Web archives (WARC 1.1) with a shared Zstandard dictionary, written and read by Spark tasks.

Each written part file is an archive of its own: first a skippable frame (magic
``0x184D2A5D``) that holds the dictionary, then a ``warcinfo`` record, then one Zstandard
frame for each record, so that any record can be read from its offset.  The dictionary is built from a bounded sample of
the records (``DICTIONARY_RECORDS`` records, ``SAMPLE_BYTES`` of each); every record is compressed with it.
Files are written by Spark's own text writer, whose line separator is an empty skippable
frame: readers of the format pass over it, and any store that Spark writes to will do.

Of records with equal payloads (SHA-1 and length) of at least ``min_bytes`` bytes, the one
with the largest id is a ``response``; the others are ``revisit`` records without payload
that refer to it.  This is settled on digests alone, without payloads, before anything is written.
Payloads are shuffled only if the digests that occur more than once are too many to broadcast.

Null payload: empty.  Null id: less than any other; read back as null.  Null URL: no URL in the
record; control characters and spaces of a URL are percent-encoded.  Repeated rows (equal id
and payload) that are the largest of their payload: one of them (the least URL) is the response, the
others revisit it.  A payload is held whole in one task, very long ones too.  An empty table
writes no record and gives an empty table.  Other columns are not read.  Contents that are not valid UTF-8 pass as they are.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from topicloom.llm.common import slices
from topicloom.plans.bounds import materialize
from topicloom.session import new_shared_path

DICTIONARY_RECORDS, SAMPLE_BYTES, DICTIONARY_BYTES = 512, 1 << 13, 1 << 15
LEVEL = 3
#: Digests that occur more than once are sent to all tasks up to this many (about 100 bytes each).
BROADCAST_DIGESTS = 200_000
#: Skippable frames: the dictionary's magic number, and an empty frame as text for the writer.
DICTIONARY_MAGIC = 0x184D2A5D
EMPTY_FRAME = "P*M\x18\0\0\0\0"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
READ = "page_id long, url string, record_type string, payload binary, payload_digest string, payload_bytes long, refers_to long"


def base32(digest: str) -> str:
    """A hexadecimal digest in upper-case base32."""
    return base64.b32encode(bytes.fromhex(digest)).decode()


def _uri(url: bytes | None) -> str | None:
    if url is None:
        return None
    return "".join(f"%{ord(c):02X}" if ord(c) <= 32 or ord(c) == 127 else c for c in url.decode("utf-8", "surrogateescape"))


def _head(version: str, fields: list[tuple[str, object]]) -> bytes:
    lines = [version] + [f"{name}: {value}" for name, value in fields if value is not None]
    return "\r\n".join([*lines, "", ""]).encode("utf-8", "surrogateescape")


def _response_id(digest: str, page_id: int | None) -> str:
    """The id of the one response of a payload; what revisits need to refer to it."""
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(f'{digest} {page_id}'.encode()).digest())}>"


def record(row: dict, date: str) -> bytes:
    """One record as it stands in the archive before compression.

    Revisits keep id and length of the payload they leave out in fields of their own.
    """
    digest, revisit = base32(row["digest"]), row["kind"] == "revisit"
    http = _head("HTTP/1.1 200 OK", [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", row["size"])])
    block = http if revisit else http + row["payload"]
    own = _response_id(digest, row["page_id"]) if row["kind"] == "response" else f"<urn:uuid:{uuid.uuid4()}>"
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", own),
        ("WARC-Date", date),
        ("WARC-Target-URI", _uri(row["url"])),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Profile", REVISIT_PROFILE if revisit else None),
        ("WARC-Refers-To", _response_id(digest, row["refers_to"]) if revisit else None),
        ("X-Page-Id", row["page_id"]),
        ("X-Refers-To-Page-Id", row["refers_to"] if revisit else None),
        ("X-Payload-Length", row["size"]),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", len(block)),
    ]
    return _head("WARC/1.1", fields) + block + b"\r\n\r\n"


def _info(date: str) -> bytes:
    block = b"software: topicloom\r\nformat: WARC File Format 1.1\r\n"
    fields = [
        ("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", date),
        ("Content-Type", "application/warc-fields"), ("Content-Length", len(block)),
    ]
    return _head("WARC/1.1", fields) + block + b"\r\n\r\n"


def prepare(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """``(page_id, url, payload, digest, size)`` of every row; the digest is hexadecimal."""
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).cast("string").cast("binary").alias("url"), body.alias("payload"))
    return rows.withColumns({"digest": F.sha1("payload"), "size": F.octet_length("payload").cast("long")})


def decide(rows: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Each prepared row with its ``kind`` (response, revisit or plain) and ``refers_to``.

    ``plain`` rows have no equal and are responses too.  Rows that tie for the response are first counted by URL
    without their payload; one of them takes the payload, the others need none.
    """
    large = F.col("size") >= min_bytes
    by_id = rows.filter(large).groupBy("digest", "size", "page_id").agg(F.count("*").alias("n"))
    groups = by_id.groupBy("digest", "size").agg(
        F.max(F.struct("page_id", "n")).alias("last"), F.sum("n").alias("rows")
    ).filter("rows > 1")
    shared = materialize(groups.select("digest", "size", F.col("last.page_id").alias("last"), F.col("last.n").alias("ties")), "digests")
    if shared.limit(BROADCAST_DIGESTS + 1).count() <= BROADCAST_DIGESTS:
        shared = F.broadcast(shared)
    met = rows.join(shared, ["digest", "size"], "left")
    is_last = F.col("page_id").eqNullSafe(F.col("last"))
    kind = (
        F.when(F.col("ties").isNull(), "plain").when(~is_last, "revisit").when(F.col("ties") == 1, "response").otherwise("tie")
    )
    met = met.withColumns({"kind": kind, "refers_to": F.when(kind == "revisit", F.col("last"))})
    columns = ["page_id", "url", "payload", "digest", "size", "refers_to", "kind"]
    one = met.filter("kind != 'tie'").withColumn("payload", F.when(F.col("kind") != "revisit", F.col("payload"))).select(*columns)
    if not shared.filter("ties > 1").limit(1).count():
        return one
    same = ["page_id", "digest", "size"]
    ties = met.filter("kind = 'tie'")
    first = ties.groupBy(*same).agg(F.min("url").alias("url"), F.first("payload").alias("payload"))
    response = first.withColumns({"refers_to": F.lit(None).cast("long"), "kind": F.lit("response")}).select(*columns)
    counted = ties.groupBy(*same, "url").agg(F.count("*").alias("n"))
    lead = first.select(*[F.col(c).alias(f"_{c}") for c in (*same, "url")])
    meets = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in (*same, "url")]
    left_over = F.col("n") - F.when(F.col("_digest").isNotNull(), 1).otherwise(0)
    others = (
        counted.join(lead, meets, "left").withColumn("n", left_over).filter("n > 0")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
        .withColumns({"payload": F.lit(None).cast("binary"), "refers_to": F.col("page_id"), "kind": F.lit("revisit")})
        .select(*columns)
    )
    return one.unionByName(response).unionByName(others)


def dictionary(rows: DataFrame, date: str) -> bytes:
    """A dictionary from an even sample of the records; empty where there is too little to learn from.

    The sample is drawn by a hash of id and URL and equal payloads count once; only it comes to the driver.
    """
    import zstandard

    total = rows.count()
    if not total:
        return b""
    draw = F.pmod(F.xxhash64("page_id", "url", F.lit(7)), F.lit(1 << 30))
    share = int(min(1.0, 2 * DICTIONARY_RECORDS / total) * (1 << 30))
    heads = rows.filter(draw < share).select("page_id", "url", F.substring("payload", 1, SAMPLE_BYTES).alias("payload"), "digest", "size")
    sample = heads.orderBy(draw, "page_id", "url").limit(DICTIONARY_RECORDS).collect()
    distinct = {r.digest: record({**r.asDict(), "payload": bytes(r.payload), "refers_to": None, "kind": "plain"}, date) for r in sample}
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, list(distinct.values())).as_bytes()
    except zstandard.ZstdError:
        return b""


def write(pages: DataFrame, path: str, min_bytes: int = 0, date: str = "2000-01-01T00:00:00Z", **columns: str) -> None:
    """Write one record for each row of ``pages`` as archives under ``path``, one file for each task with rows."""
    rows = prepare(pages, **columns)
    trained = dictionary(rows, date)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        known = zstandard.ZstdCompressionDict(trained) if trained else None
        if known:
            known.precompute_compress(level=LEVEL)
        packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_checksum=True, write_content_size=True)
        lead = [struct.pack("<II", DICTIONARY_MAGIC, len(trained)) + trained, packer.compress(_info(date))]
        for batch in slices(batches, "payload", 4 << 20):
            frames = [packer.compress(record(row, date)) for row in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(lead + frames, pa.binary())], names=["frame"])
            lead = []

    frames = decide(rows, min_bytes).mapInArrow(run, "frame binary")
    frames.select(F.col("frame").cast("string").alias("value")).write.options(lineSep=EMPTY_FRAME, maxRecordsPerFile=0).text(path)


def frames(data: memoryview) -> Iterator[bytes]:
    """The contents of an archive's Zstandard frames, by the dictionary in its leading skippable frame."""
    import zstandard

    unpacker, at, piece = zstandard.ZstdDecompressor(), 0, 1 << 16
    while at < len(data):
        magic, size = struct.unpack_from("<II", data, at) if len(data) - at >= 8 else (0, 0)
        if magic >> 4 == 0x184D2A5:
            if at == 0 and magic == DICTIONARY_MAGIC and size:
                unpacker = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(bytes(data[8 : 8 + size])))
            at += 8 + size
            continue
        stream, parts = unpacker.decompressobj(), []
        while not stream.eof:
            if at >= len(data):
                raise ValueError("the archive ends within a record")
            part = data[at : at + piece]
            parts.append(stream.decompress(part))
            at += len(part) - len(stream.unused_data)
        yield b"".join(parts)


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "surrogateescape").split("\r\n")
    return {name: value for name, _, value in (line.partition(": ") for line in lines[1:])}


def parse(content: bytes) -> dict | None:
    """What a record says, its payload checked against its digest; None for other kinds of records."""
    head, _, rest = content.partition(b"\r\n\r\n")
    fields = _fields(head)
    kind = fields["WARC-Type"]
    if kind not in ("response", "revisit"):
        return None
    block = rest[: int(fields["Content-Length"])]
    if len(block) != int(fields["Content-Length"]) or rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("the record is not as long as it says")
    digest, number = fields["WARC-Payload-Digest"].removeprefix("sha1:"), lambda name: int(fields[name]) if name in fields else None
    payload = block.partition(b"\r\n\r\n")[2] if kind == "response" else None
    if payload is not None and base32(hashlib.sha1(payload).hexdigest()) != digest:
        raise ValueError("the payload does not match its digest")
    return {
        "page_id": number("X-Page-Id"), "url": fields.get("WARC-Target-URI"), "record_type": kind, "payload": payload,
        "payload_digest": digest, "payload_bytes": number("X-Payload-Length") if payload is None else len(payload),
        "refers_to": number("X-Refers-To-Page-Id"),
    }


def read(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The response and revisit records of the archives under ``path``; a file is read whole by one task.

    Payloads are checked against their digests; without ``payloads`` they are then left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            ("page_id", pa.int64()), ("url", pa.binary()), ("record_type", pa.string()), ("payload", pa.binary()),
            ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("refers_to", pa.int64()),
        ])

        def batch(found: list[dict]) -> pa.RecordBatch:
            for row in found:
                row["url"] = row["url"] and row["url"].encode("utf-8", "surrogateescape")
            return pa.RecordBatch.from_pylist(found, schema)

        for files in batches:
            for content in files.column("content"):
                found, held = [], 0
                for one in frames(memoryview(content.as_buffer())):
                    row = parse(one)
                    if row is None:
                        continue
                    if not payloads:
                        row["payload"] = None
                    found.append(row)
                    held += len(row["payload"] or b"") + 100
                    if held > 4 << 20:
                        yield batch(found)
                        found, held = [], 0
                if found:
                    yield batch(found)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(run, READ.replace("url string", "url binary")).withColumn("url", F.col("url").cast("string"))


def round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write ``pages`` to the shared folder and give what the archives say."""
    path = new_shared_path(pages.sparkSession, "warc")
    write(pages, path, min_bytes)
    return read(pages.sparkSession, path, payloads=False)
