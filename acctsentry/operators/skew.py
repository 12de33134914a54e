"""Joins and numbering that no hot key can send to one task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acctsentry.session import checkpoint_root

#: A key is hot if it has more than this part of all rows; so fewer than
#: ``HOT_KEYS`` keys are, and the list of them that is broadcast has a bound.
HOT_KEYS = 1000
#: Rows that a key may have in one task in any case.
PART_ROWS = 1000


def join_spread(
    rows: DataFrame, table: DataFrame, on: list[str], weight: str, by: Column, how: str = "inner",
) -> DataFrame:
    """``rows`` joined with ``table``, which has one row per key ``on``.

    ``table`` is a written (checkpointed) frame whose column ``weight`` tells
    how many of ``rows`` its key has about. Keys with more than a thousandth of
    all rows are hot: their row of ``table`` is copied once per ``part`` rows
    of theirs, and ``by``, which should differ among the rows of a key, deals
    the rows over the copies. Rows whose key is NULL or not in ``table`` are
    kept by a left join, in as many parts. Both sides come straight from a
    shuffle, so that AQE can still split what the weights didn't foresee.
    """
    total = table.agg(F.sum(weight)).first()[0] or 0
    part = max(PART_ROWS, -(-int(total) // HOT_KEYS))
    parts = F.ceil(F.col(weight) / part).cast("int")
    hot = table.where(F.col(weight) > part).select(*on, parts.alias("_parts"))
    dealt = rows.join(F.broadcast(hot), on, "left").withColumn(
        "_part", F.when(F.col("_parts").isNotNull(), F.pmod(F.xxhash64(by), F.col("_parts")).cast("int")).otherwise(0)
    ).drop("_parts")
    copies = table.withColumn("_part", F.explode(F.sequence(F.lit(0), F.greatest(
        F.when(F.col(weight) > part, parts).otherwise(1), F.lit(1)) - 1)))
    return dealt.join(copies, [*on, "_part"], how).drop("_part")


def prefix_sums(df: DataFrame, order: list[str], value: str, name: str) -> DataFrame:
    """``df`` plus ``name``, the sum of ``value`` (long) over the rows before
    each, in the order of ``order`` (a total one).

    Rows are range-partitioned and sorted, summed inside each range, and the
    ranges' totals (one row per partition, the driver's only input) give each
    range its start; no window sees all rows. The rows are written once.
    """
    root = df.sparkSession
    checkpoint_root(root)
    work = df.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = T.StructType([*work.schema.fields, T.StructField("_pid", T.IntegerType()), T.StructField(name, T.LongType())])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid, so_far = TaskContext.get().partitionId(), 0
        for batch in batches:
            v = batch.column(value).to_numpy(zero_copy_only=False).astype(np.int64)
            upto = np.cumsum(v)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(v), pid), pa.int32()), pa.array(so_far + upto - v)],
                                             names=[f.name for f in schema.fields])
            so_far += int(v.sum())

    done = work.mapInArrow(add, schema).checkpoint(eager=True)
    starts, so_far = [], 0
    for r in done.groupBy("_pid").agg(F.sum(value).alias("v")).orderBy("_pid").collect():
        starts.append((r["_pid"], so_far))
        so_far += r["v"] or 0
    begin = root.createDataFrame(starts, "_pid int, _start long")
    return done.join(F.broadcast(begin), "_pid").withColumn(name, F.col(name) + F.col("_start")).drop("_pid", "_start")


def ranked(df: DataFrame, group: list[str], order: list[str], name: str = "rank") -> DataFrame:
    """``df`` plus each row's 1-based place (``name``, long) in its group, in
    ascending order (NULLs first), ties in any order.

    Rows are range-partitioned and sorted by group, order and a row number, so
    that a hot group, and even a hot run of equal rows, spreads over tasks; a
    task counts inside its range, and one row per partition (the driver's only
    input) says where a group goes on from the range before. The sorted rows
    are written to the shared folder once. NULL is a group like any other.
    """
    root = df.sparkSession
    checkpoint_root(root)
    work = df.withColumns({"_g": F.xxhash64(F.lit(0), *group), "_tie": F.monotonically_increasing_id()})
    keys = [*group, *order, "_tie"]
    work = work.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie")
    schema = T.StructType([*work.schema.fields, T.StructField("_pid", T.IntegerType()),
                           T.StructField("_at", T.LongType()), T.StructField(name, T.LongType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid, at, last, n = TaskContext.get().partitionId(), 0, None, 0
        for batch in batches:
            if not len(batch):
                continue
            g = batch.column("_g").to_numpy()
            new = np.ones(len(g), bool)
            new[1:] = g[1:] != g[:-1]
            new[0] = last is None or g[0] != last
            place = np.arange(len(g))
            start = np.maximum.accumulate(np.where(new, place, -1))
            rank = np.where(start < 0, n + place + 1, place - start + 1)
            last, n = g[-1], int(rank[-1])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(g), pid), pa.int32()), pa.array(at + place), pa.array(rank)],
                names=[f.name for f in schema.fields])
            at += len(g)

    done = work.mapInArrow(count, schema).checkpoint(eager=True)
    ends = done.groupBy("_pid").agg(
        F.min_by("_g", "_at").alias("first"), F.max_by("_g", "_at").alias("last"), F.max_by(name, "_at").alias("n"))
    offsets, group_now, so_far = [], None, 0
    for r in ends.orderBy("_pid").collect():
        carried = so_far if r["first"] == group_now else 0
        if carried:
            offsets.append((r["_pid"], r["first"], carried))
        so_far = r["n"] + (carried if r["last"] == r["first"] else 0)
        group_now = r["last"]
    if not offsets:
        return done.drop("_g", "_pid", "_at")
    more = root.createDataFrame(offsets, T.StructType([
        T.StructField("_pid", T.IntegerType()), T.StructField("_g", T.LongType()), T.StructField("_more", T.LongType())]))
    return (done.join(F.broadcast(more), ["_pid", "_g"], "left")
            .withColumn(name, F.col(name) + F.coalesce("_more", F.lit(0)))
            .drop("_g", "_pid", "_at", "_more"))
