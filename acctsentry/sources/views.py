"""Transfer views derived from the driver tables.

``txn_events`` turns the ``events`` stream table into dense transfers (many per
account per hour, so velocity rules fire).  ``txn_lineitem`` turns line items
into transfers with whole-day timestamps (months, years and many ties).

Both are plain DataFrame projections over the given parquet tables; the same
definitions, written in DuckDB SQL, live in :mod:`acctsentry.plans.oracle`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acctsentry import schema as S

# Fixed mapping of the views (event type / order priority -> transfer type).
EVENT_TYPE_TO_TRANSFER = {"purchase": "S", "signup": "Q", "click": "L", "view": "I", "error": "O"}
PRIORITY_TO_TRANSFER = {
    "1-URGENT": "S", "2-HIGH": "Q", "3-MEDIUM": "L", "4-NOT SPECIFIED": "I", "5-LOW": "O",
}
RETURNFLAG_TO_ACCOUNT = {"A": 0, "N": 1, "R": 2}
# Event clock compression: 2024-01-01 + (ts - 2024-01-01) / 240, to the second.
EVENT_EPOCH = "2024-01-01 00:00:00"
EVENT_TIME_DIVISOR = 240


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _as_ts(c: Column) -> Column:
    """timestamp_ntz (as parquet files carry it) -> session-zone timestamp."""
    return c.cast("timestamp")


def events_to_transfers(events: DataFrame) -> DataFrame:
    """Project rows of ``events`` onto the raw transfer schema (plus Status)."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    base_us = F.unix_micros(F.lit(EVENT_EPOCH).cast("timestamp"))
    secs = F.floor((F.unix_micros(_as_ts(F.col("ts"))) - base_us) / F.lit(EVENT_TIME_DIVISOR * 1_000_000))
    created = F.timestamp_seconds(F.floor(base_us / 1_000_000) + secs)
    return events.select(
        F.col("event_id").alias(S.SEQ),
        F.col("user_id").alias(S.CUSTOMER),
        (F.col("user_id") * 10 + F.col("event_id") % 2).alias(S.ACCOUNT),
        (k % 20).alias(S.BENEFICIARY),
        (F.col("value") * 100).alias(S.AMOUNT),
        S.map_literal(EVENT_TYPE_TO_TRANSFER)[F.col("event_type")].alias(S.TRANSFER_TYPE),
        F.concat(F.lit("C"), (F.col("event_id") % 4).cast("string")).alias(S.CHANNEL),
        F.concat(F.lit("B"), (k % 5).cast("string")).alias(S.COUNTRY),
        created.alias(S.CREATED),
        F.when(F.col("event_type") == "error", F.lit(S.STATUS_REJECTED))
        .otherwise(F.lit(S.STATUS_APPROVED))
        .alias("Status"),
    )


def txn_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_to_transfers(read_table(spark, sf_dir, "events"))


def txn_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events view as a raw file may hold it: amounts and dates as text,
    some of them bad; NULL keys, beneficiaries, types and channels; unknown and
    lower-case types; accounts with one row; forced approvals."""
    seq = F.col(S.SEQ)

    def every(n: int) -> Column:
        return seq % n == 0

    df = txn_events(spark, sf_dir)
    alone = every(61)
    return df.select(
        S.SEQ,
        F.when(alone, seq + 1_000_000).when(every(17), None).otherwise(F.col(S.CUSTOMER)).alias(S.CUSTOMER),
        F.when(alone, seq + 10_000_000).when(every(19), None).otherwise(F.col(S.ACCOUNT)).alias(S.ACCOUNT),
        F.when(every(23), None).otherwise(F.col(S.BENEFICIARY)).alias(S.BENEFICIARY),
        F.when(every(29), "abc").when(every(31), "NaN").when(every(37), None).otherwise(F.col(S.AMOUNT).cast("string"))
        .alias(S.AMOUNT),
        F.when(every(41), "x").when(every(43), "s").when(every(47), None).otherwise(F.col(S.TRANSFER_TYPE)).alias(S.TRANSFER_TYPE),
        F.when(every(13), None).otherwise(F.col(S.CHANNEL)).alias(S.CHANNEL),
        F.when(every(7), None).otherwise(F.col(S.COUNTRY)).alias(S.COUNTRY),
        F.when(every(11), "not a date").when(every(53), None)
        .otherwise(F.date_format(S.CREATED, "yyyy-MM-dd HH:mm:ss")).alias(S.CREATED),
        F.when(seq % 5 == 1, S.STATUS_FORCE_APPROVED).otherwise(F.col("Status")).alias("Status"),
    )


def txn_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as transfers; ``seq`` is the rank in a total order of the six
    columns that make a line item unique (computed distributed, see
    :func:`sequence_numbers`)."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice",
        "l_returnflag", "l_shipdate",
    )
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"
    )
    supplier = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    # supplier and nation are dimension tables; AQE broadcasts them after the
    # size check at runtime, no hint needed.
    joined = (
        li.join(orders, li.l_orderkey == orders.o_orderkey, "inner")
        .join(supplier, li.l_suppkey == supplier.s_suppkey, "left")
        .join(nation, F.col("s_nationkey") == nation.n_nationkey, "left")
    )
    order_cols = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"]
    numbered = sequence_numbers(joined, order_cols)
    return numbered.select(
        F.col(S.SEQ),
        F.col("o_custkey").alias(S.CUSTOMER),
        (F.col("o_custkey") * 10 + S.map_literal(RETURNFLAG_TO_ACCOUNT)[F.col("l_returnflag")]).alias(S.ACCOUNT),
        F.col("l_suppkey").alias(S.BENEFICIARY),
        F.col("l_extendedprice").alias(S.AMOUNT),
        S.map_literal(PRIORITY_TO_TRANSFER)[F.col("o_orderpriority")].alias(S.TRANSFER_TYPE),
        F.col("o_orderstatus").alias(S.CHANNEL),
        F.col("n_name").alias(S.COUNTRY),
        _as_ts(F.col("l_shipdate")).alias(S.CREATED),
    )


def sequence_numbers(df: DataFrame, order_cols: list[str], name: str = S.SEQ) -> DataFrame:
    """1-based row number over a total order, without a single-task window.

    The frame is range-partitioned and sorted on ``order_cols`` (Spark samples
    the keys, so partitions stay bounded), and ``monotonically_increasing_id``
    then numbers rows locally as ``partition << 33 | position``.  A table of
    per-partition row counts (one row per partition, a proven bound) gives each
    partition its offset, joined back by broadcast.

    The tagged frame is written (parquet, below ``spark.checkpoint.dir``)
    so that the count branch and the row branch see the same partitions; AQE
    may otherwise coalesce the two reads of the range shuffle differently. The
    files are compressed, and each of the passes that read the numbered rows
    later reads its own columns only.
    """
    from acctsentry.session import scratch_path

    spark, path = df.sparkSession, scratch_path(df.sparkSession, "numbered")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (
        df.repartitionByRange(parts, *order_cols)
        .sortWithinPartitions(*order_cols)
        .withColumn("_mid", F.monotonically_increasing_id())
        .write.parquet(path)
    )
    tagged = spark.read.parquet(path).withColumn("_pid", F.shiftright("_mid", 33))
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n")).checkpoint(eager=True)
    from pyspark.sql import Window

    offsets = counts.select(
        "_pid",
        F.coalesce(
            F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ).alias("_off"),
    )
    pos = F.col("_mid") - F.shiftleft(F.col("_pid"), 33)
    return (
        tagged.join(F.broadcast(offsets), "_pid")
        .withColumn(name, (F.col("_off") + pos + 1).cast("long"))
        .drop("_mid", "_pid", "_off")
    )
