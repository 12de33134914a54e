"""Connected components by alternating star contraction on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from acctsentry.llm.common import forget, written
from acctsentry.operators.skew import join_spread


def connected_components(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` (least node reachable) for each node of ``edges`` (a, b),
    which are read once in each direction; a frame of ``written``.

    Each round sends every larger neighbour of a node to the least one, then
    every smaller neighbour: a star of any size takes one round, a path a
    logarithmic number. A hot centre is a key of a ``min`` with partial sums,
    and ``join_spread`` deals its edges over many tasks; rounds are written to
    the shared folder, and a round's files go when the next one is there.
    """
    first = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v")
    e, before = first, None
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count(F.lit(1)).alias("n")))
        large = written(join_spread(both.where("v > u"), least, ["u"], "n", F.col("v")).select(
            F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v"))
        lower = written(large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")))
        small = join_spread(large, lower, ["u"], "n", F.col("v"))
        # An edge (u, v) gives (v, m) and (u, m); the latter is the same for all edges of u.
        pairs = small.select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("p"))
        old, seen = e, Observation()
        e = written(pairs.select(F.col("p.v").alias("u"), F.col("p.m").alias("v")).where("u <> v").distinct().observe(
            seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")))
        forget(least, large, lower, *([old] if old is not first else []))
        now = (seen.get["n"], seen.get["h"])
        if now == before:
            break
        before = now
    out = written(e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()))
    forget(e)
    return out
