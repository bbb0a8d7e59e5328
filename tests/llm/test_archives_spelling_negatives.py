"""Archives, spelling variants and hard negatives against brute force on small tables."""

import base64
import collections
import hashlib
import random
import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from hypothesis import example, given, settings, strategies as st
from pyspark.sql import functions as F

from topicloom.llm import negatives, spelling, warc
from topicloom.session import new_shared_path, share_package

# --- archives -----------------------------------------------------------------

PAGES = "page_id long, url string, html string, size long, digest string, payload string, kind string, last long"


@pytest.fixture(scope="module")
def pages():
    body = "<html>" + "hot page " * 40 + "</html>"
    rows = [(i, f"http://a.org/{i}", body) for i in range(1, 60)]
    rows += [(i, f"http://b.org/{i}", f"<p>page {i}</p>" + "é中\r\n\r\n" * (i % 5)) for i in range(60, 90)]
    rows += [(100, None, None), (101, "", ""), (102, "http://c.org/a b\r\nWARC-Type: x", "x"), (None, "http://n.org", "null id")]
    rows += [(None, "http://n.org/2", "no id"), (None, "http://n.org/3", "no id"), (103, "http://d.org", "no id")]
    rows += [(104, "http://e.org/2", "tie"), (104, "http://e.org/1", "tie"), (104, "http://e.org/1", "tie"), (90, "http://e.org/0", "tie")]
    rows += [(105, "http://f.org", "long " * 300_000), (106, "http://g.org", "\0퟿")]
    return [(*r, 5, "own", "own", "own", 7) for r in rows]


def expected(pages, min_bytes=0):
    groups = collections.defaultdict(list)
    for r in pages:
        groups[(r[2] or "").encode()].append(r[0])
    want = collections.Counter()
    for body, ids in groups.items():
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        ids = sorted(ids, key=lambda i: (i is not None, i))
        first = [ids[-1]] if len(body) >= min_bytes else ids
        revisits = ids[:-1] if len(body) >= min_bytes else []
        want.update((i, len(body), digest, "response", None) for i in first)
        want.update((i, len(body), digest, "revisit", ids[-1]) for i in revisits)
    return want


def found(df):
    return collections.Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect())


@pytest.mark.parametrize("min_bytes, broadcast", [(0, True), (10, False), (10**9, True)])
def test_archives_hold_every_page_once(spark, pages, min_bytes, broadcast, monkeypatch):
    share_package(spark)
    if not broadcast:
        monkeypatch.setattr(warc, "BROADCAST_DIGESTS", 0)
    df = spark.createDataFrame(pages, PAGES).repartition(4)
    assert found(warc.round_trip(df, min_bytes)) == expected(pages, min_bytes)


def test_archives_are_plain_zstandard_with_a_leading_dictionary(spark, pages):
    share_package(spark)
    path = new_shared_path(spark, "archive")
    warc.write(spark.createDataFrame(pages, PAGES).repartition(3), path)
    payloads = collections.Counter()
    for file in spark.read.format("binaryFile").load(path).filter("length > 0").toLocalIterator():
        data = bytes(file.content)
        magic, size = struct.unpack_from("<II", data)
        assert magic == 0x184D2A5D and size > 0
        reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8 : 8 + size]))
        records = list(warc.frames(memoryview(data)))
        # A reader that knows nothing of the writer sees the records one after the other.
        assert reader.stream_reader(data[8 + size :], read_across_frames=True).read() == b"".join(records)
        assert b"WARC-Type: warcinfo" in records[0] and all(r.startswith(b"WARC/1.1\r\n") and r.endswith(b"\r\n\r\n") for r in records)
        payloads.update(r["payload"] for r in map(warc.parse, records[1:]) if r["record_type"] == "response")
    assert payloads == collections.Counter({(r[2] or "").encode() for r in pages})


def test_archive_records_say_what_they_refer_to_and_keep_urls_in_one_line(spark, pages):
    share_package(spark)
    path = new_shared_path(spark, "archive")
    warc.write(spark.createDataFrame(pages, PAGES), path)
    rows = warc.read(spark, path).collect()
    urls = {r.page_id: r.url for r in rows}
    assert urls[102] == "http://c.org/a%20b%0D%0AWARC-Type:%20x" and urls[100] is None and urls[101] == ""
    ties = [r for r in rows if r.page_id == 104]
    assert sorted(r.url for r in ties if r.record_type == "response") == ["http://e.org/1"]
    assert sorted(r.url for r in ties if r.record_type == "revisit") == ["http://e.org/1", "http://e.org/2"]
    revisit = warc.record({"page_id": 1, "url": b"u", "payload": None, "digest": "00" * 20, "size": 3, "refers_to": 9, "kind": "revisit"}, "d")
    response = warc.record({"page_id": 9, "url": b"u", "payload": b"abc", "digest": "00" * 20, "size": 3, "refers_to": None, "kind": "response"}, "d")
    assert warc._fields(revisit)["WARC-Refers-To"] == warc._fields(response)["WARC-Record-ID"]


def test_archives_of_no_pages_and_damaged_archives(spark, pages):
    share_package(spark)
    assert warc.round_trip(spark.createDataFrame([], PAGES)).count() == 0
    whole = warc.record({"page_id": 9, "url": b"u", "payload": b"abc", "digest": hashlib.sha1(b"abc").hexdigest(), "size": 3, "refers_to": None, "kind": "plain"}, "d")
    assert warc.parse(whole)["payload"] == b"abc"
    with pytest.raises(ValueError):
        warc.parse(whole.replace(b"abc", b"abd"))
    with pytest.raises(ValueError):
        list(warc.frames(memoryview(zstandard.ZstdCompressor().compress(whole)[:-4])))


# --- spelling variants ----------------------------------------------------------


def one_apart(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    if len(a) == len(b):
        return a != b and a[k + 1 :] == b[k + 1 :]
    return len(b) == len(a) + 1 and a[k:] == b[k + 1 :]


@settings(max_examples=4, deadline=None)
@example({"a", "ba"})
@given(st.sets(st.text("abé", min_size=1, max_size=7), max_size=60))
def test_trie_walk_finds_all_words_one_apart(spark, words):
    share_package(spark)
    table = spark.createDataFrame([(w, i) for i, w in enumerate(sorted(words))], "word string, n long")
    got = collections.Counter((r.word, r.near, r.near_n) for r in spelling.neighbours(table).collect())
    counts = {w: i for i, w in enumerate(sorted(words))}
    assert got == collections.Counter((a, b, counts[b]) for a in words for b in words if one_apart(a, b))


def brute_variants(rows):
    count = collections.Counter()
    for i, text in rows:
        run = ""
        for c in (text or "") + " ":
            if "A" <= c <= "Z" or "a" <= c <= "z" or "À" <= c <= "ÿ":
                run += c.lower() if c <= "Z" else c
                continue
            if run:
                h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
                if h % 31 == 0:
                    run = run[: h % len(run)] + run[h % len(run) + 1 :]
                if len(run) >= 7:
                    count[run] += 1
            run = ""
    words = {w: n for w, n in count.items() if n >= 2}
    near = {w: [v for v in words if one_apart(w, v)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        if best and words[best] >= 10 * words[w]:
            form[w] = best
    out = set()
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n, len(near[w]), words[form[w]] if w in form else None))
    return out


def test_spelling_variants_equal_brute_force(spark):
    share_package(spark)
    r = random.Random(4)
    base = ["".join(r.choice("abcdéÉ") for _ in range(r.randrange(7, 12))) for _ in range(12)]
    text = lambda n: r.choice([" ", ", ", "\n", "5"]).join(r.choice(base).title() for _ in range(n))
    rows = [(i, text(r.choice([1, 40, 200]))) for i in range(150)]
    # A chain of forms, ties, long runs with a long common beginning, repeated rows, nulls and empty texts.
    rows += [(1000 + i, "zzzzzzzz " * 300 + "zzzzzzzzy " * 20 + "zzzzzzzzyx " * 2) for i in range(2)]
    rows += [(2000, f"{'q' * 900}x {'q' * 900}x {'q' * 900}y {'q' * 900}y {'q' * 901} {'q' * 901}")]
    rows += [(3000, "tietieab tietieab tietieac tietieac tietieaa")] * 3 + [(None, text(30)), (None, None), (4000, ""), (4001, None), (4002, "a b")]
    docs = spark.createDataFrame([(*x, "own", 3, "own") for x in rows], "doc_id long, text string, word string, n long, node string").repartition(5)
    got = spelling.variants(docs).collect()
    want = brute_variants(rows)
    assert len(got) == len(want) and {tuple(x) for x in got} == want
    assert any(x[1] and x[2] != x[1] for x in want)
    assert spelling.variants(docs.limit(0)).count() == 0
    assert spelling.variants(docs.filter("doc_id = 4002")).count() == 0


# --- hard negatives ---------------------------------------------------------------


def brute_negatives(rows, is_anchor, positives=5, k=10):
    usable = [(i, l, [int(np.floor(x * 256)) for x in v]) for i, l, v in rows if i is not None and l is not None and v is not None
              and all(x is not None and np.isfinite(x) for x in v)]
    out = collections.Counter()
    for i, l, v in {(i, l, tuple(v)) for i, l, v in usable if is_anchor(i)}:
        scored = sorted((-sum(x * y for x, y in zip(v, w)), j, m) for j, m, w in usable if j != i)
        for p, j in [(-s, j) for s, j, m in scored if m == l][:positives]:
            good = [(-s, q) for s, q, m in scored if m != l and 30 * p <= -100 * s <= 90 * p][:k]
            out.update((i, j, n + 1, q, p, s) for n, (s, q) in enumerate(good))
    return out


@pytest.mark.parametrize("blocks", [1 << 20, 400])
def test_hard_negatives_equal_brute_force(spark, blocks, monkeypatch):
    share_package(spark)
    monkeypatch.setattr(negatives, "BLOCK_BYTES", blocks)
    monkeypatch.setattr(negatives, "ROWS_AT_ONCE", 7)
    r = np.random.default_rng(5)
    rows = [(i, int(r.integers(0, 4)), [float(x) for x in r.normal(0.3, 1, 6)]) for i in range(160)]
    rows += [(i, 1, [0.5] * 6) for i in range(200, 260)] + [(i, 2, [0.45] * 6) for i in range(300, 360)]
    rows += [(0, 3, [0.5] * 6), (20, 1, [0.5] * 6), (20, 1, [0.5] * 6), (400, 1, [0.25] * 4), (420, 2, []), (440, 0, [1.0] * 8)]
    rows += [(500, None, [1.0] * 6), (520, 1, None), (540, 1, [1.0, None] * 3), (560, 1, [float("nan")] * 6), (None, 1, [1.0] * 6)]
    rows += [(580, 1, [float("inf")] * 6), (600, 9, [1.0] * 6)]
    schema = "vec_id long, label int, embedding array<float>, id long, vector string, anchor string"
    table = spark.createDataFrame([(*x, 1, "own", "own") for x in rows], schema).repartition(4)
    got = negatives.hard_negatives(negatives.usable(table), F.col("id") % 20 == 0)
    exact = [(i, l, v and [x if x is None else float(np.float32(x)) for x in v]) for i, l, v in rows]
    want = brute_negatives(exact, lambda i: i % 20 == 0)
    assert collections.Counter(map(tuple, got.collect())) == want and len(want) > 100
    assert negatives.hard_negatives(negatives.usable(table.limit(0)), F.col("id") % 20 == 0).count() == 0


def test_products_are_exact_and_stay_within_a_long():
    a = np.array([[2.0**30, 2.0**30 + 1], [2.0**70, 0]])
    b = np.array([[2.0**30 + 1, 3.0], [-(2.0**60), 1]])
    want = [[max(-(2**63), min(2**63 - 1, sum(int(x) * int(y) for x, y in zip(p, q)))) for q in b] for p in a]
    assert negatives.products(a, b).tolist() == want


def test_keeper_keeps_the_best_of_each_slot():
    r = np.random.default_rng(1)
    keeper, seen = negatives.Keeper(3, 2, 4), collections.defaultdict(list)
    keeper.limit = 20
    for _ in range(30):
        a, s, score, ids = r.integers(0, 3, 9), r.integers(0, 2, 9), r.integers(0, 6, 9), r.integers(0, 1000, 9)
        keeper.add(a, s, score, ids)
        for row in zip(a.tolist(), s.tolist(), (-score).tolist(), ids.tolist()):
            seen[row[:2]].append(row[2:])
    got = collections.defaultdict(list)
    for a, s, score, i in zip(*(x.tolist() for x in keeper.settle())):
        got[a, s].append((-score, i))
    assert got == {key: sorted(rows)[:4] for key, rows in seen.items()}
    assert negatives.matrix(pa.array([[1.5, -0.001], [], [2.0]], pa.list_(pa.float64())), 3).tolist() == [[384, -1, 0], [0, 0, 0], [512, 0, 0]]
