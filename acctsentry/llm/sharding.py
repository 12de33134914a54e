"""Sharding by sampled splitters: shards of near-equal bytes.

Draw size-weighted key samples, take their quantiles as range boundaries,
range-partition the records, subdivide ranges that turn out overfull, and cut
the exact running size into shards. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from acctsentry.llm.common import col, materialized

#: Expected number of drawn keys, and the ranges that their quantiles bound:
#: both fixed, so the drawn table and the boundary list have a proven bound.
N_SAMPLES = 16_384
N_RANGES = 256
#: Rows that one range holds at most before it is subdivided.
RANGE_ROWS = 500_000


def boundaries(records: DataFrame, total: int, n_samples: int = N_SAMPLES, n_ranges: int = N_RANGES) -> list[int]:
    """Quantiles of keys drawn with a chance in proportion to their size.

    ``records`` has ``k`` (long), ``id`` and ``size``. The draw compares a
    hash of the row with ``n_samples * size / total`` and so gives the same
    keys in each run; a record larger than ``total / n_samples`` is drawn
    always and weighs its whole size.
    """
    unit = F.pmod(F.xxhash64(F.lit("draw"), "k", "id"), F.lit(1 << 53)) / float(1 << 53)
    drawn = records.where(unit < F.col("size") * (n_samples / total)).select(
        "k", F.greatest(F.col("size").cast("double"), F.lit(total / n_samples)).alias("weight")
    )
    upto = F.sum("weight").over(W.partitionBy(F.lit(0)).orderBy("k").rangeBetween(W.unboundedPreceding, W.currentRow))
    whole = F.sum("weight").over(W.partitionBy(F.lit(0)))
    cut = drawn.groupBy("k").agg(F.sum("weight").alias("weight")).select("k", F.floor(upto / whole * n_ranges).alias("q"))
    return [r["k"] for r in cut.groupBy("q").agg(F.min("k").alias("k")).where("q > 0").orderBy("k").collect()]


def shard_by_size(
    records: DataFrame, group: Column, id_col: str = "doc_id", size_col: str = "size", n_shards: int = 8,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """Put records into shards 0 .. n_shards-1 of near-equal total size.

    ``group`` is what should stay together (equal texts): records lie in the
    order of its 64-bit hash, and a group goes to the shard in which it
    begins. A group in an overfull range (more than twice a range's share of
    the size, or more than ``range_rows`` records) is subdivided by id like
    everything else in that range, so a hot group spreads.

    Returns the input columns plus ``shard`` int and ``slot`` long, the
    record's gapless number in its shard from 0. The same rows give the same
    shards whatever the partitions. Defined cases: a NULL group is a group of
    its own; a NULL size counts 0; ids may repeat or be NULL (equal rows
    are numbered in any order); an empty table gives an empty table; with
    fewer records than shards some shards are empty. Columns named ``shard``
    or ``slot`` are replaced.

    Scale: one pass over the input writes the narrow key table to the shared
    folder. Boundaries, range statistics and shard offsets have a row per
    range and are the only things that meet in one place. No range holds more
    than ``range_rows`` records of expectation after the split, and each is
    numbered in a task of its own.
    """
    kept = [c for c in records.columns if c not in ("shard", "slot")]
    base = materialized(records.select(
        F.struct(*[col(c) for c in kept]).alias("row"),
        F.xxhash64(group).alias("k"),
        F.xxhash64(col(id_col)).alias("id"),
        F.greatest(F.coalesce(col(size_col).cast("long"), F.lit(0)), F.lit(0)).alias("size"),
    ))
    out = [F.col("row")[c].alias(c) for c in kept]
    totals = base.agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).first()
    total = max(1, totals["size"] or 0)
    bounds = boundaries(base.select("k", "id", "size"), total)
    edges = F.array(*[F.lit(b) for b in bounds]) if bounds else F.array().cast("array<bigint>")
    ranged = base.withColumn("range", F.size(F.filter(edges, lambda b: b <= F.col("k"))))

    per_range = ranged.groupBy("range").agg(F.sum("size").alias("range_size"), F.count(F.lit(1)).alias("range_n"))
    share = max(1, total // N_RANGES)
    parts = F.greatest(
        F.when(F.col("range_size") > 2 * share, F.ceil(F.col("range_size") / share)).otherwise(F.lit(1)),
        F.ceil(F.col("range_n") / range_rows),
    ).alias("parts")
    # One row per range, N_RANGES at most: the broadcast has a proven bound.
    split = F.broadcast(per_range.select("range", parts))
    units = ranged.join(split, "range").withColumn(
        "part", F.when(F.col("parts") == 1, F.lit(0)).otherwise(F.pmod(F.xxhash64(F.lit("part"), "id", "k"), "parts"))
    )
    unit_stats = units.groupBy("range", "part").agg(F.sum("size").alias("unit_size"))
    before = W.partitionBy(F.lit(0)).orderBy("range", "part").rowsBetween(W.unboundedPreceding, -1)
    starts = unit_stats.select("range", "part", F.coalesce(F.sum("unit_size").over(before), F.lit(0)).alias("start"))

    keys = units.select("row", "k", "id", "size", "range", "part").join(starts, ["range", "part"])
    by_unit = W.partitionBy("range", "part").orderBy("k", "id", "size")
    placed = keys.select(
        "row", "k", "range", "part",
        (F.col("start") + F.sum("size").over(by_unit.rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("size"))
        .alias("pos"),
        F.row_number().over(by_unit).alias("rn"),
    )
    in_group = W.partitionBy("range", "part", "k")
    cut = placed.withColumn(
        "shard",
        F.least(F.floor(F.min("pos").over(in_group) * n_shards / F.lit(total)), F.lit(n_shards - 1)).cast("int"),
    ).drop("pos")
    cut = materialized(cut)
    runs = cut.groupBy("shard", "range", "part").agg(F.count(F.lit(1)).alias("n"), F.min("rn").alias("first"))
    earlier = W.partitionBy("shard").orderBy("range", "part").rowsBetween(W.unboundedPreceding, -1)
    offsets = runs.select(
        "shard", "range", "part", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("shift")
    )
    return cut.join(offsets, ["shard", "range", "part"]).select(
        *out, "shard", (F.col("shift") + F.col("rn")).cast("long").alias("slot")
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, rows in slot order inside each file."""
    (sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))
