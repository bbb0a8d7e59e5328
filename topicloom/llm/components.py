"""Connected components of a link table, by alternating star steps on written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from topicloom.plans.bounds import materialize


def _neighbours_to_least(links: DataFrame, both: bool) -> DataFrame:
    """Hang each node's neighbours (larger ones with ``both``, else smaller ones) and itself on the least of all of them.

    Minima are taken before rows meet and joined back, so that a node with very many
    links is an ordinary skewed join key.
    """
    turned = links.select(F.col("b").alias("a"), F.col("a").alias("b"))
    about = links.union(turned) if both else turned
    least = about.groupBy("a").agg(F.min("b").alias("_m")).withColumn("_m", F.least("a", "_m"))
    hung = about.join(least, "a")
    if both:
        hung = hung.filter(F.col("b") > F.col("a")).select(F.col("_m").alias("a"), "b")
    else:
        hung = hung.select(F.col("_m").alias("a"), "b").union(least.select(F.col("_m").alias("a"), F.col("a").alias("b")))
    return hung.filter(F.col("a") < F.col("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links(a, b)`` with a < b; the root is the least node reachable.

    Each round writes its links to the shared folder and reads them again; rounds grow
    with the logarithm of the longest chain.  The end is told by a count and two sums.
    """
    state = None
    links = materialize(links, "links")
    while True:
        links = materialize(_neighbours_to_least(_neighbours_to_least(links, True), False), "links")
        row = links.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b") % (1 << 40)), F.sum(F.xxhash64("b", "a") % (1 << 40))
        ).first()
        if tuple(row) == state:
            break
        state = tuple(row)
    roots = links.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return roots.union(links.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
