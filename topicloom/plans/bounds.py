"""Joins that stay safe when a side grows or one key holds much of the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from topicloom.session import new_shared_path

BROADCAST_ROWS = 2_000_000
HOT_SHARE = 1000


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only after counting the rows; otherwise return the frame as it is.

    For label-table sized sides: the frame is cached, so counting it also computes
    it for the join.  The count stops at the limit; beyond it Spark's own choice
    applies, a shuffle join whose skewed partitions adaptive execution splits.
    """
    cached = df.persist()
    if cached.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(cached)
    cached.unpersist()
    return df


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a frame once to the shared folder and go on from the written table."""
    spark = df.sparkSession
    path = new_shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def hot_keys(df: DataFrame, key: str, share: int = HOT_SHARE) -> DataFrame:
    """Keys that hold more than one part in ``share`` of all rows: fewer than ``share`` keys."""
    counts = df.groupBy(key).agg(F.count("*").alias("_n"))
    total = counts.agg(F.sum("_n").alias("_n"))
    return counts.filter(F.col("_n") * share > total.scalar()).select(key)


def skew_safe_lookup(
    rows: DataFrame, table: DataFrame, key: str, spread_by: Column, salts: int = 1024
) -> DataFrame:
    """Left-join ``table`` (one row per key) to ``rows`` whose keys may be badly skewed.

    The table rows of hot keys are fewer than ``HOT_SHARE`` and go out as a
    broadcast.  Their rows carry a salt that meets nothing in the second join, so
    the shuffle spreads them evenly; the other keys meet the table there.
    """
    values = [c for c in table.columns if c != key]
    hot = table.join(F.broadcast(hot_keys(rows, key)), key, "left_semi").select(
        key, F.struct(*values).alias("_hot"), F.lit(True).alias("_is_hot")
    )
    marked = rows.join(F.broadcast(hot), key, "left").withColumn(
        "_salt",
        F.when(F.col("_is_hot"), 1 + F.pmod(F.xxhash64(spread_by), F.lit(salts)))
        .otherwise(F.lit(0))
        .cast("long"),
    )
    tail = table.select(
        key, F.lit(0).cast("long").alias("_salt"), F.struct(*values).alias("_tail")
    )
    picked = F.when(F.col("_is_hot"), F.col("_hot")).otherwise(F.col("_tail"))
    return (
        marked.join(tail, [key, "_salt"], "left")
        .withColumn("_picked", picked)
        .select(*rows.columns, *[F.col("_picked")[v].alias(v) for v in values])
    )
