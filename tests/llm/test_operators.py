"""Each operator against brute force on small tables with nulls, empties, ties, repeats and other columns."""

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from topicloom.llm import chat, common, language_id, lm, mixing, packing, quality, search, simhash, suffix_dedup, toxicity
from topicloom.llm.queries import TOKENIZERS
from topicloom.session import share_package

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, key string, s int, part int"


@pytest.fixture(scope="module")
def rows():
    r = random.Random(3)
    words = ["alpha", "Beta", "gamma,", "delta.", "eps", "zeta!", "ete", "thé", "iota", "kappa"]
    text = lambda n: " ".join(r.choice(words) for _ in range(n))
    shared = text(40)
    out = [(i, text(r.choice([1, 3, 30, 90])), "en" if i % 2 else "fr", f"s{i % 3}") for i in range(30)]
    out += [(30, shared + " x " + text(30), "en", "s0"), (31, text(20) + " " + shared, "en", None), (32, shared, None, "s1")]
    out += [(33, None, "en", "s0"), (34, "", "en", "s1"), (35, " \n ", None, None), (None, shared, "en", "s0"), (36, "1 2 3", "en", "s2")]
    out += [(37, out[0][1], "fr", "s0"), (1, out[1][1], "en", "s1"), (38, "word " * 9000, "en", "s1"), (39, "a" * 5000, "en", "s2")]
    return [(i, t, lang, s, None, 5, "k", 1, 2) for i, t, lang, s in out]


@pytest.fixture(scope="module")
def docs(spark, rows):
    share_package(spark)
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    share_package(spark)
    return spark.createDataFrame([], SCHEMA)


def test_simhash_links_equal_brute_force(docs, rows, empty):
    fps = [simhash.fingerprint((r[1] or "").encode()) for r in rows]
    group = list(range(len(rows)))
    for _ in rows:
        for a, x in enumerate(fps):
            for b, y in enumerate(fps):
                if (x ^ y).bit_count() <= 4:
                    group[a] = group[b] = min(group[a], group[b])
    least = {}
    for r, g in zip(rows, group):
        if r[0] is not None:
            least[g] = min(least.get(g, r[0]), r[0])
    want = collections.Counter((r[0], least.get(g)) for r, g in zip(rows, group))
    got = simhash.near_duplicates(docs).collect()
    assert collections.Counter((r.doc_id, r.component_id) for r in got) == want
    assert simhash.near_duplicates(empty).count() == 0


def test_simhash_finds_all_pairs_up_to_the_distance(spark):
    r = random.Random(1)
    base = [r.getrandbits(64) for _ in range(40)]
    near = [b ^ sum(1 << k for k in r.sample(range(64), n)) for b in base for n in (1, 2, 3, 4, 5)]
    fps = sorted({x - (1 << 64) if x >> 63 else x for x in base + near})
    found = {(p.a, p.b) for p in simhash.links(spark.createDataFrame([(x,) for x in fps], "fp long")).collect()}
    mask = (1 << 64) - 1
    assert found == {(a, b) for a in fps for b in fps if a < b and ((a ^ b) & mask).bit_count() <= 4}


def test_simhash_index_is_not_broadcast_however_small_spark_takes_it(spark):
    plan = simhash.links(spark.range(100).select(F.col("id").alias("fp")))
    text = spark._jvm.PythonSQLUtils.explainString(plan._jdf.queryExecution(), "simple")
    assert "SortMergeJoin" in text and "Broadcast" not in text


def test_suffix_dedup_equals_brute_force(docs, rows, empty, monkeypatch):
    want, seen = {}, set()
    distinct = sorted({(math.inf if r[0] is None else r[0], r[1] or "") for r in rows})
    for i, t in distinct:
        b = t.encode()
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - 99):
            if b[k : k + 100] in seen:
                gone[k : k + 100] = True
            seen.add(b[k : k + 100])
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        want[None if i == math.inf else i] = (len(b), int(gone.sum()), hashlib.sha256(kept).hexdigest())
    for hot in (suffix_dedup.HOT_SEGMENTS, 1):
        monkeypatch.setattr(suffix_dedup, "HOT_SEGMENTS", hot)
        got = suffix_dedup.dedup(docs).collect()
        assert len(got) == len(rows)
        assert all(want[r.doc_id] == (r.n_bytes, r.n_removed, r.kept_sha256) for r in got)
    assert suffix_dedup.dedup(empty).count() == 0


def test_previous_smaller():
    x = np.array([3, 1, 2, 5, 4, 0, 6])
    assert suffix_dedup.previous_smaller(x).tolist() == [-1, -1, 1, 2, 2, -1, 5]


@given(st.text(alphabet="<|end>turn/s[INST] \\\n", max_size=60))
def test_chat_escape_is_reversible(text):
    assert chat.unescape(chat.escape(text)) == text
    assert chat.read_turns(chat.write_turn("user", text)[0] + chat.write_turn("a\n%0A", text)[0]) == [("user", text), ("a\n%0A", text)]


@pytest.mark.parametrize("budget", [2048, 60])
def test_chat_round_trip(spark, budget):
    share_package(spark)
    data = [(1, k, ("system", "user", "assistant")[0 if k == 0 else 1 + k % 2], f"turn {k} </s> " + "x " * k) for k in range(40)]
    data += [(2, 0, None, None), (2, None, "user", "a"), (2, 0, "assistant", ""), (None, 1, "assistant", "<|end|>"), (-7, 0, "user", "</s>[INST] ok [/INST]")]
    turns = spark.createDataFrame(data, "conv_id long, turn long, role string, text string")
    windows = chat.format_windows(turns, f"{TOKENIZERS}/byte_bpe_50k.json", budget, 20)
    got = {r.conv_id: r for r in chat.read_back(windows).collect()}
    for conv in {d[0] for d in data}:
        own = sorted(((-1 if t is None else t, r or "", x or "") for c, t, r, x in data if c == conv))
        loss = "".join(x for _, r, x in own if r == "assistant")
        row = got[conv]
        assert row.n_turns == len(own) and row.loss_chars == len(loss)
        assert row.turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in own).encode()).hexdigest()
        assert row.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    if budget == 60:
        assert got[1].n_windows > 3
        assert all(w.text.startswith("<|turn|>system") for w in windows.filter("conv_id = 1").collect())


def test_quality_counts(docs, rows, empty, spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, quality int")
    got = collections.Counter(tuple(r)[:6] for r in quality.judge(docs, quality.learn(docs, labels)).collect())

    def counts(text):
        words = [w for w in text.encode().split()]
        grams = collections.Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
        inside = {k + j for k in range(len(words) - 2) if grams[tuple(words[k : k + 3])] > 1 for j in range(3)}
        lines = [x for x in text.split("\n") if x.encode().split()]
        dup = sum(x in lines[:k] for k, x in enumerate(lines))
        return len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text), dup, len(inside)

    assert got == collections.Counter((r[0], *counts(r[1] or "")) for r in rows)
    assert quality.judge(empty, None).count() == 0
    assert quality.text_counts(b"a\na\r\na\n\n", b"a a a".split())[3] == 1


def test_mixing_meets_budgets_to_the_word(docs, empty):
    got = mixing.mix_sizes(docs).collect()
    assert len(got) == docs.count()
    total = sum(r.size for r in got)
    by_target = collections.defaultdict(int)
    for r in got:
        assert 0 <= r.taken <= 2 * r.size and r.target <= 2 * r.source_size + 1e-6
        by_target[r.source_size, r.target] += r.taken
    assert all(abs(taken - target) <= 2 for (_, target), taken in by_target.items())
    assert abs(sum(t for _, t in by_target) - 1.5 * total) < 1e-6 * total
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mixing.mix_sizes(docs.repartition(5)).collect()), key=str)
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == docs.columns
    assert mixed.agg(F.sum(mixing.word_count(F.col("text")))).first()[0] == sum(r.taken for r in got)
    assert mixing.mix_sizes(empty).count() == 0 and mixing.mix_documents(empty).count() == 0


def test_packing_covers_every_id_once(docs, rows, empty):
    from tokenizers import Tokenizer

    path = f"{TOKENIZERS}/word_bpe_49k.json"
    reference = Tokenizer.from_file(path)
    ids = [np.array([*reference.encode(r[1] or "", add_special_tokens=False).ids, 1], "<u4") for r in rows]
    got = packing.pack(docs, path).collect()
    pieces, want = collections.defaultdict(list), collections.Counter(zlib.crc32(x.tobytes()) for x in ids)
    for r in got:
        pieces[r.sequence_id].append(r)
    for own in pieces.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == np.r_[0, np.cumsum([r.length for r in own])[:-1]].tolist()
        assert sum(r.length for r in own) <= 2048
    whole = [r for r in got if r.length == r.doc_tokens]
    assert not collections.Counter(r.ids_crc32 for r in whole) - want
    assert sum(r.length for r in got) == sum(map(len, ids))
    by_id = {r[0]: x for r, x in zip(rows, ids)}
    assert all(r.ids_crc32 == zlib.crc32(by_id[r.doc_id][r.start : r.start + r.length].tobytes()) for r in got if r.doc_id not in (None, 1))
    assert packing.pack(empty, path).count() == 0


@settings(deadline=None, max_examples=60)
@given(st.lists(st.sampled_from(["Thing.", "été,", "<|endoftext|>", "a<|startoftext|>B", "don't", "x1.", "…", "Ⅷ", "ΑΣ", "é", "!!", " ", "日本"]), max_size=12))
def test_word_tokens_equal_the_tokenizer(words):
    path = f"{TOKENIZERS}/word_bpe_49k.json"
    own = packing.tokens(path)
    text = " ".join(words)
    assert np.frombuffer(own.encode([text.encode()])[0], "<u4").tolist() == own.tokenizer.encode(text, add_special_tokens=False).ids


def test_best_cuts_equal_full_search():
    r = random.Random(4)
    position = [0, *np.cumsum([r.randint(1, 6) for _ in range(40)]).tolist()]
    penalty = [0.0, *[r.choice([0.0, 1.0, 3.0]) for _ in range(40)]]
    chosen, limit = packing.best_cuts(position, penalty, 16), 16

    def cost_of(cuts):
        total, start = 0, 0
        for j in cuts:
            n = position[j] - position[start]
            total += penalty[j] + packing.SEQUENCE_COST + (0 if n in (2, 4, 8, 16) else limit - n)
            start = j
        return total

    best = [0.0] + [math.inf] * 40
    for j in range(1, 41):
        for i in range(j):
            n = position[j] - position[i]
            if n <= limit:
                best[j] = min(best[j], best[i] + penalty[j] + packing.SEQUENCE_COST + (0 if n in (2, 4, 8, 16) else limit - n))
    assert chosen[-1] == 40 and cost_of(chosen) == best[40]


def test_language_id(docs, rows, empty):
    model = language_id.learn(docs, F.lit(True))
    got = language_id.identify(docs, model)
    assert got.columns == [*docs.columns, "lang_pred", "score"] and got.count() == len(rows)
    for r in got.collect():
        has_letter = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred in ("en", "fr")) if has_letter else (r.lang_pred, r.score) == ("und", 0.0)
        assert 0 <= r.score <= 1
    assert language_id.learn(empty, F.lit(True)) is None and language_id.identify(empty, None).count() == 0


def test_toxicity_learns_and_scores_every_row(docs, rows, empty, spark):
    r = random.Random(2)
    plain = [(i, " ".join(r.choice(["sun", "tree", "road", "green"]) for _ in range(60)) + (" vilest" if i % 2 else ""), i % 2) for i in range(80)]
    train = spark.createDataFrame(plain, "doc_id long, text string, toxic int")
    model = toxicity.learn(train.select("doc_id", "text"), train.select("doc_id", "toxic"))
    got = toxicity.score(train, model).join(train, "doc_id").collect()
    assert np.mean([(x.score >= 0.5) == x.toxic for x in got]) > 0.9
    scored = toxicity.score(docs, model).collect()
    assert len(scored) == len(rows) and all(0 <= x.score <= 1 and x.n_windows >= 1 for x in scored)
    assert toxicity.score(empty, model).count() == 0
    assert toxicity.learn(empty, empty.select("doc_id", F.lit(1).alias("toxic"))) is None


@pytest.mark.parametrize("order", [2, 3])
def test_lm_base_and_interpolation(docs, rows, empty, order):
    held = common.remainder(F.col("doc_id"), 5) == 1
    got = lm.score(docs, held, order).collect()
    assert len(got) == len(rows)
    split = [[*(r[1] or "").encode().lower().split(), b"\n"] for r in rows]
    out = [r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 1 for r in rows]
    counts = collections.Counter(w for s, o in zip(split, out) if not o for w in s)
    n, v = sum(counts.values()), len(counts)
    want = sorted(
        (o, len(s), sum(counts[w] > 0 for w in s), n, round(sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in s), 5))
        for s, o in zip(split, out)
    )
    assert sorted((r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in got) == want
    assert all(np.isfinite(r.score) for r in got)
    assert lm.score(empty, held).count() == 0


def test_em_finds_the_better_estimate():
    w = lm.expectation_maximisation([(1, 20, 100), (2, -9999, 100), (3, 20, 50), (3, -9999, 50)])
    assert w[1] > 0.99 and w[2] < 0.01 and 0.4 < w[3] < 0.6 and w[4] == w[3]


@pytest.mark.parametrize("seed", range(6))
def test_pruned_shards_equal_all_scores(seed, monkeypatch):
    monkeypatch.setattr(search, "BLOCK", 4)
    r, n, vocab, k = np.random.default_rng(seed), 150, 60, 3
    weights = 1 / np.arange(1, vocab + 1) ** 1.2
    queries = [(np.sort(r.choice(vocab, 8, replace=False)), r.random(8) + 0.1) for _ in range(30)]
    tops, found, every, scored = np.zeros((30, k)), [], [], 0
    for first in range(0, 3 * n, n):
        tf = r.poisson(weights / weights.sum() * r.integers(5, 60, n)[:, None])
        term, doc = np.nonzero(tf.T)
        row = {
            "doc_ids": np.arange(first, first + n), "no_id": np.zeros(n, bool), "terms": np.arange(vocab, dtype=np.uint64),
            "starts": np.searchsorted(term, np.arange(vocab + 1)), "owners": doc.astype(np.int32),
            "times": tf.T[term, doc].astype(np.int32), "lengths": tf.sum(1).astype(np.int32),
        }
        shard = search.Shard({c: x.tobytes() for c, x in row.items()}, 30.0)
        q, d, s = shard.search(queries, tops)
        scored += len(q)
        found += zip(q.tolist(), (-s).tolist(), (d + first).tolist())
        impact = tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * tf.sum(1)[:, None] / 30))
        for number, (t, w) in enumerate(queries):
            own = np.round(impact[:, t] @ w, 6)
            every += [(number, -own[x], x + first) for x in np.flatnonzero(own)]
    best = lambda rows: [[x[2] for x in sorted(rows) if x[0] == q][:k] for q in range(30)]
    assert best(found) == best(every) and scored < len(every) / 4


def test_search_equals_full_scan(docs, rows, empty, monkeypatch):
    # Many shards and query blocks.
    monkeypatch.setattr(search, "SHARD_BYTES", 4000)
    monkeypatch.setattr(search, "QUERY_BYTES", 8000)
    got = collections.defaultdict(list)
    for r in search.top_k(docs.filter("doc_id % 5 = 0"), docs, 4).collect():
        got[r.query_id].append((r.rank, r.doc_id, r.score))
    split = [collections.Counter((r[1] or "").encode().lower().split()) for r in rows]
    length = [sum(c.values()) for c in split]
    mean, df = sum(length) / len(rows), collections.Counter(w for c in split for w in c)
    for q, c in zip(rows, split):
        if q[0] is None or q[0] % 5:
            continue
        found = []
        for r, d, n in zip(rows, split, length):
            s = sum(
                k * math.log(1 + (len(rows) - df[w] + 0.5) / (df[w] + 0.5)) * d[w] * 2.2 / (d[w] + 1.2 * (0.25 + 0.75 * n / mean))
                for w, k in c.items() if w in d
            )
            if s > 0:
                found.append((-round(s, 6), math.inf if r[0] is None else r[0]))
        want = [None if i == math.inf else i for _, i in sorted(found)[:4]]
        assert [i for _, i, _ in sorted(got[q[0]], key=lambda x: x[0])] == want
    assert search.top_k(empty, empty).count() == 0


def test_pipeline_stages(spark, docs, rows, empty):
    import corpus_pipeline as p

    kept = p.language(spark, docs, "")
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r[0] for r in rows if any(c.isalpha() for c in r[1] or "")}
    first = p.near_dedup(spark, docs, "")
    ids = [r.doc_id for r in first.collect()]
    assert len([i for i in ids if i is not None]) == len(set(ids) - {None}) and 37 not in ids and 0 in ids
    assert p.passage_dedup(spark, docs, "").count() == len(rows)
    names = ["score", "lang_pred", "component_id", "fp", "n_bytes", "kept_sha256", "size", "target", "source_size", "_s", "_e", "_id", "_v", "_n", "_key", "_cut", "_passes"]
    clashing = docs.select("*", *[F.lit(f"own {n}").alias(n) for n in names])
    for _, stage in p.STAGES[:-1]:
        out = stage(spark, clashing, "")
        assert out.columns == clashing.columns
        assert out.count() > 0 and out.filter(" OR ".join(f"`{n}` <> 'own {n}'" for n in names)).count() == 0
    for _, stage in p.STAGES:
        assert stage(spark, empty, "").count() == 0


def test_near_dedup_keeps_the_first_of_each_group_of_near_duplicates(spark):
    import corpus_pipeline as p

    share_package(spark)
    r = random.Random(8)
    text = lambda n: [f"w{r.randrange(4000)}" for _ in range(n)]
    data = []
    for g in range(12):
        base = text(300)
        data.append((10 * g, " ".join(base)))
        for k in range(1, 7):
            own = list(base)
            for at in range(k):
                own[9 + at * 14] = f"new{g}.{k}.{at}"
            data.append((10 * g + k, " ".join(own)))
    # One id with a copy and with a text of its own; a repeated row; null ids; texts without words and of few words.
    data += [(500, data[0][1]), (500, " ".join(text(50))), (501, "one two"), (501, "one two"), (502, "One  two"), (503, None), (504, " ")]
    data += [(None, data[0][1]), (None, "x y z")]
    fps = [simhash.fingerprint((t or "").encode()) for _, t in data]
    group = list(range(len(data)))
    for _ in data:
        for a, x in enumerate(fps):
            for b, y in enumerate(fps):
                if (x ^ y).bit_count() <= 4:
                    group[a] = group[b] = min(group[a], group[b])
    members = collections.defaultdict(list)
    for (i, t), g in zip(data, group):
        members[g].append((math.inf if i is None else i, t or ""))
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(5)
    got = [(math.inf if x.doc_id is None else x.doc_id, x.text or "") for x in p.near_dedup(spark, docs, "").collect()]
    assert len(got) == len(members) < len(data) - 10
    for rows in members.values():
        kept = [x for x in got if x in rows]
        assert len(kept) == 1 and kept[0][0] == min(rows)[0]


def test_suffix_dedup_keeps_hot_passages_of_repeated_rows(spark, monkeypatch):
    share_package(spark)
    monkeypatch.setattr(suffix_dedup, "HOT_SEGMENTS", 1)
    r = random.Random(6)
    text = lambda n: "".join(r.choice("abcdefghij ") for _ in range(n))
    shared = text(90)
    data = [(i, text(150) + shared + text(150)) for i in range(4)]
    docs = spark.createDataFrame([*data, *data], "doc_id long, text string").coalesce(1)
    assert [x.n_removed for x in suffix_dedup.dedup(docs).collect()] == [0] * 8


def test_shard_puts_like_documents_side_by_side(spark):
    share_package(spark)
    r = np.random.default_rng(3)
    rows = [(i, " ".join(f"{'ab'[i % 2]}{x}" for x in r.integers(0, 60, r.integers(5, 90)))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    (unit,) = search.units(docs, 1 << 20, True).collect()
    ids = np.frombuffer(unit.doc_ids, np.int64)
    assert sorted(ids.tolist()) == list(range(400))
    assert np.frombuffer(unit.lengths, np.int32).tolist() == [len(rows[i][1].split()) for i in ids]
    # Blocks then have words of one kind, but for those in which a group ends.
    assert (ids[1:] % 2 != ids[:-1] % 2).sum() <= search.GROUPS


def test_search_ranks_each_query_row_by_itself(spark):
    share_package(spark)
    docs = spark.createDataFrame([(i, f"alpha {'x ' * i}" if i < 6 else f"beta {'y ' * i}") for i in range(12)], "doc_id long, text string")
    asked = [(0, "alpha"), (0, "alpha"), (0, "beta"), (1, "alpha")]
    got = search.top_k(spark.createDataFrame(asked, "doc_id long, text string").coalesce(1), docs, 4).collect()
    want = [(0, k + 1, k) for k in range(4)] * 2 + [(0, k + 1, 6 + k) for k in range(4)] + [(1, k + 1, k) for k in range(4)]
    assert sorted((x.query_id, x.rank, x.doc_id) for x in got) == sorted(want)


@pytest.mark.parametrize("word", ["İstanbul", "क़क", "İstanbul.", "éte", "ﬁn", "straße!"])
def test_word_tokens_take_letters_that_normalisation_splits(word):
    own = packing.WordTokens(f"{TOKENIZERS}/word_bpe_49k.json")
    text = f"one {word} two. {word}, été"
    assert np.frombuffer(own.encode([text.encode()])[0], "<u4").tolist() == own.tokenizer.encode(text, add_special_tokens=False).ids


def test_lm_scoring_runs_with_trigrams(monkeypatch):
    from topicloom.llm import queries

    orders = []
    monkeypatch.setattr(queries.lm, "score", lambda documents, held_out, order=2: orders.append(order))
    monkeypatch.setattr(queries, "table", lambda *_: None)
    monkeypatch.setattr(queries.common, "remainder", lambda *_: 1)
    monkeypatch.setattr(queries.F, "col", lambda name: name)
    queries.QUERIES["op9_lm_scoring"].__closure__[0].cell_contents(None, "")
    assert orders == [3]


def test_long_system_turn_is_not_repeated(spark):
    share_package(spark)
    rows = [(size, 0, "system", "rule " * size) for size in (20, 3000)]
    rows += [(size, t, ("assistant", "user")[t % 2], f"word{t} " * 30) for size in (20, 3000) for t in range(1, 60)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = chat.format_windows(turns, f"{TOKENIZERS}/byte_bpe_50k.json", 512, 100).collect()
    for size, repeated in ((20, True), (3000, False)):
        own = [x for x in got if x.conv_id == size]
        written = "".join(x.text[x.new_from :] for x in own)
        assert [t for _, t in chat.read_turns(written)] == [r[3] for r in rows if r[0] == size]
        assert [x.text.count(f"{chat.OPEN}system") for x in own] == [1] * len(own) if repeated else [1] + [0] * (len(own) - 1)
        assert all(x.n_tokens <= 512 for x in own[0 if repeated else 1 :])
        assert sum(len(x.text) for x in own) < 2 * len(written)
