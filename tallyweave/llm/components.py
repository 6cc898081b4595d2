"""Connected components by alternating large and small stars, each round a few joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.llm.shared import stored


def _mark(pairs: DataFrame) -> tuple:
    row = pairs.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("hi", "lo")).alias("x"),
                    F.bit_xor(F.xxhash64("lo", "hi")).alias("y")).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the edges (a, b), root being the least node it is joined to.

    Each round links every node to the least node around it, which at least halves long chains, and
    goes on until nothing changes. The least neighbours are written before they are joined, so that a
    node with very many neighbours is split among tasks.
    """
    a, b = F.col("a"), F.col("b")
    pairs = stored(edges.where(a != b).select(
        F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct())
    seen = _mark(pairs)
    while True:
        both = pairs.select(F.inline(F.array(
            F.struct(F.col("hi").alias("u"), F.col("lo").alias("v")),
            F.struct(F.col("lo").alias("u"), F.col("hi").alias("v")))))
        least = stored(both.groupBy("u").agg(F.min("v").alias("m")).select(
            "u", F.least("u", "m").alias("m")))
        large = stored(both.where(F.col("v") > F.col("u")).join(least, "u").select(
            F.col("v").alias("hi"), F.col("m").alias("lo")).distinct())
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(stored(low), "hi").select(F.inline(F.array(
            F.struct(F.col("hi"), F.col("m").alias("lo")),
            F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")))))
        pairs = stored(small.where(F.col("hi") != F.col("lo")).distinct())
        now = _mark(pairs)
        if now == seen:
            break
        seen = now
    return pairs.select(F.inline(F.array(
        F.struct(F.col("hi").alias("node"), F.col("lo").alias("root")),
        F.struct(F.col("lo").alias("node"), F.col("lo").alias("root"))))).distinct()
