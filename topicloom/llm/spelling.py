"""Spelling variants: words one code point apart, found by walking a trie that is a table.

The edge table of the trie and the walk over it are made level by level.  A level's edges
are the groups of words that go on alike from a node; an edge's label is what all words of its group share, so chains are one
edge and a word alone is one edge to its end.  The walk holds ``(word, rest, node, edits)`` states: states without
an edit meet all edges of their node and may make one edit within a label, states with an edit
follow the one edge that goes on as the word does.  A state whose rest is used up at the end of
a word has found a neighbour.

Words are walked forwards and, in a second trie of reversed words, backwards.  The forward walk makes
its edit in the second half of the word and the backward walk in the first, where each trie
has few branches; a neighbour found backwards counts only if the first halves differ, so each is found once.

Null and empty texts have no words.  A null id counts as an empty id in the hash.  Repeated
rows count each time.  Texts are taken whole; a very long run is one word.  An empty table
gives an empty table; other columns are not read.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from topicloom.plans.bounds import materialize

LETTERS = r"A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_LENGTH, MIN_COUNT, DAMAGE, FACTOR = 7, 2, 31, 10
STATES = "kind int, back boolean, word string, n long, depth int, rest string, node string, near_n long"
#: Kinds of rows of a level's table: states without and with an edit, and neighbours (in ``node``).
CLEAN, EDITED, FOUND = 0, 1, 2


def words(documents: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """``(word, n)``: runs of letters of all texts, lower-cased and partly damaged, that are long and frequent enough.

    A run loses a code point where the hash of id and run is a multiple of ``DAMAGE``.
    """
    run = F.col("run")
    # A run shorter than min_length can only get shorter.
    found = F.regexp_extract_all("text", F.lit(f"[{LETTERS}]{{{min_length},}}"), F.lit(0))
    runs = documents.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), F.explode(found).alias("run"))
    runs = runs.withColumn("run", F.when(run.rlike("[A-Z]"), F.translate(run, UPPER, LOWER)).otherwise(run))
    h = F.crc32(F.concat("doc", F.lit(":"), run).cast("binary"))
    at = F.pmod(h, F.char_length(run)).cast("int")
    damaged = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))
    made = runs.select(F.when(h % DAMAGE == 0, damaged).otherwise(run).alias("word"))
    counted = made.filter(F.char_length("word") >= min_length).groupBy("word").agg(F.count("*").alias("n"))
    return counted.filter(F.col("n") >= min_count)


def _shared(a: pd.Series, b: pd.Series) -> pd.Series:
    """How many code points two words share at the start."""
    return pd.Series([next((k for k, (x, y) in enumerate(zip(p, q)) if x != y), min(len(p), len(q))) for p, q in zip(a, b)])


def _after(text: Column, n: Column | int) -> Column:
    return F.substring(text, F.lit(n) + 1 if isinstance(n, int) else n + 1, F.lit(1 << 30))


def _marks(length: Column, text: Column) -> list[Column]:
    """Two one-bit marks of a length and the last two code points."""
    h = F.xxhash64(length, F.substring(text, -2, 2))
    return [F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(x, F.lit(64)).cast("int")) for x in (h, F.shiftright(h, 8))]


def _edges(clean: DataFrame) -> DataFrame:
    """The edges from the nodes of a level, ``(back, node, c, label, child, open, child_n, m0, m1)``, as a written table.

    ``clean`` has the words below each node.  ``child_n`` is the count of the word that the child is, if it is one;
    an open child has more words below it.  ``m0`` and ``m1`` unite the marks of all ends below the node that take the edge.
    """
    below = clean.filter("rest != ''").withColumn("c", F.substring("rest", 1, 1))
    marks = _marks(F.char_length("rest"), F.col("rest"))
    groups = below.groupBy("back", "node", "c").agg(
        F.count("*").alias("words"), F.min("rest").alias("lo"), F.max("rest").alias("hi"), F.min_by("n", "rest").alias("lo_n"),
        F.bit_or(marks[0]).alias("m0"), F.bit_or(marks[1]).alias("m1"),
    )
    label = F.when(F.col("words") == 1, F.col("lo")).otherwise(F.substring("lo", F.lit(1), F.col("shared")))
    edges = groups.withColumn("shared", F.pandas_udf(_shared, "int")("lo", "hi")).withColumn("label", label).select(
        "back", "node", "c", "label", F.concat("node", "label").alias("child"), (F.col("words") > 1).alias("open"),
        F.when(F.col("label") == F.col("lo"), F.col("lo_n")).alias("child_n"), "m0", "m1",
    )
    return materialize(edges, "edges")


def _step(states: DataFrame, edges: DataFrame) -> DataFrame:
    """The next level's states and this level's neighbours.

    Every state goes on along the edge that begins as its rest does.  A state without an edit also meets the other edges of its
    node, once it is in its own half: there the edit is the edge's first code point, replaced, inserted or left out.
    Marks keep back edges below which no word has the length and the end that the edit calls for.
    """
    on = edges.withColumnsRenamed({"back": "_back", "node": "_node"})
    same = (F.col("back") == F.col("_back")) & (F.col("node") == F.col("_node"))
    rest, label, k = F.col("rest"), F.col("label"), F.char_length("label")
    kept = ["back", "word", "n", (F.col("depth") + k).alias("depth"), "kind", "rest", "child", "open", "child_n"]

    first = F.substring(rest, 1, 1)
    followed = states.withColumn("first", first).join(on, same & (F.col("first") == F.col("c")) & rest.startswith(label)).withColumn(
        "rest", _after(rest, k)
    ).select(*kept)

    size = F.char_length("word")
    half = F.when(F.col("back"), size - F.floor(size / 2)).otherwise(F.floor(size / 2))
    own = states.filter((F.col("kind") == CLEAN) & (F.col("depth") >= half)).withColumns({"first": first, "more": _after(rest, 1)})
    left = F.char_length(rest)
    for name, change in (("replaced", 0), ("inserted", 1), ("left_out", -1)):
        marks = _marks(left + change, rest)
        own = own.withColumns({f"{name}{i}": F.when(left > 2, m).otherwise(F.lit(0).cast("long")) for i, m in enumerate(marks)})
    tail = _after(label, 1)

    def may(name: str, begins: Column) -> Column:
        marked = [F.col(f"m{i}").bitwiseAND(F.col(f"{name}{i}")) == F.col(f"{name}{i}") for i in (0, 1)]
        return marked[0] & marked[1] & begins

    moves = {
        "replaced": (may("replaced", (left > 0) & F.col("more").startswith(tail)), k),
        "inserted": (may("inserted", rest.startswith(tail)), k - 1),
        "left_out": (may("left_out", F.col("more").startswith(label)), k + 1),
    }
    some = moves["replaced"][0] | moves["inserted"][0] | moves["left_out"][0]
    ways = F.array(*[F.when(ok, _after(rest, used)) for ok, used in moves.values()])
    branched = own.join(on, same & (F.col("c") != F.col("first")) & some).withColumn(
        "rest", F.explode(ways)
    ).filter("rest is not null").withColumn("kind", F.lit(EDITED)).select(*kept)

    left = F.char_length("rest")
    # At the end of a word: with an edit nothing may be left, without one the last code point is the edit.
    ends = F.col("child_n").isNotNull() & (left + F.col("kind") == 1)
    goes_on = F.col("open") & ((F.col("kind") == CLEAN) | (left > 0))
    kinds = F.array(F.when(ends, FOUND), F.when(goes_on, F.col("kind")))
    out = followed.unionByName(branched).filter(ends | goes_on).withColumn("out", F.explode(kinds)).filter("out is not null")
    return out.select(
        F.col("out").alias("kind"), "back", "word", "n", "depth", "rest", F.col("child").alias("node"),
        F.when(F.col("out") == FOUND, F.col("child_n")).alias("near_n"),
    )


def neighbours(vocabulary: DataFrame, min_length: int = 1) -> DataFrame:
    """``(word, n, near, near_n)`` for all pairs of the distinct words that differ by one code point, both ways round.

    No word may be shorter than ``min_length``: the walk starts where the first edit may be.
    """
    back = F.col("back")
    # A start lies above all words, so that none of them is a first node.
    start = F.when(back, min(min_length - min_length // 2, min_length - 1)).otherwise(min_length // 2)
    both = vocabulary.select("n", F.col("word").alias("own"), F.explode(F.array(F.lit(False), F.lit(True))).alias("back"))
    turned = both.withColumn("word", F.when(back, F.reverse("own")).otherwise(F.col("own")))
    states = turned.select(
        F.lit(CLEAN).alias("kind"), "back", "word", "n", start.cast("int").alias("depth"), _after(F.col("word"), start).alias("rest"),
        F.substring("word", F.lit(1), start).alias("node"), F.lit(None).cast("long").alias("near_n"),
    )
    states, found = materialize(states, "states"), []
    while states.filter(F.col("kind") == CLEAN).limit(1).count():
        edges = _edges(states.filter(F.col("kind") == CLEAN))
        states = materialize(_step(states.filter(F.col("kind") != FOUND), edges), "states")
        found.append(states.filter(F.col("kind") == FOUND).select("back", "word", "n", F.col("node").alias("near"), "near_n"))
    pairs = found[0] if found else states.select("back", "word", "n", F.col("node").alias("near"), "near_n")
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    plain = [F.when(back, F.reverse(c)).otherwise(F.col(c)).alias(c) for c in ("word", "near")]
    half = F.floor(F.char_length("word") / 2).cast("int")
    heads = [F.substring(c, F.lit(1), half) for c in ("word", "near")]
    return pairs.select("back", plain[0], "n", plain[1], "near_n").filter(~back | (heads[0] != heads[1])).drop("back")


def _roots(forms: DataFrame) -> DataFrame:
    """``(word, root)``: forms followed to the last, by doubling; counts rise along a chain, so it ends."""
    to = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        next_to = to.select(F.col("word").alias("root"), F.col("root").alias("further"))
        to = materialize(
            to.join(next_to, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")),
            "roots",
        )
        moved = to.filter("moved").limit(1).count()
        to = to.select("word", "root")
        if not moved:
            return to


def variants(
    documents: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, factor: int = FACTOR
) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for every word of the texts.

    ``form`` is the most frequent near word (ties: the least), if it is at least ``factor`` times as frequent.
    """
    vocabulary = materialize(words(documents, min_length, min_count), "words")
    near = neighbours(vocabulary, min_length).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("down"), "near")).alias("best")
    )
    enough = -F.col("best.down") >= factor * F.col("n")
    named = materialize(
        vocabulary.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(enough, F.col("best.near")).alias("form"),
            F.when(enough, -F.col("best.down")).alias("form_n"),
        ),
        "forms",
    )
    roots = _roots(named.filter("form is not null"))
    return named.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
