"""Delimited text read by header name, and rows numbered in file order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acctsentry.operators.skew import prefix_sums


def read_csv_text(spark: SparkSession, path: str) -> DataFrame:
    """A CSV with header, all columns as text, named as the header names them.

    The header of the first file gives the names; a further file whose header
    differs makes the read fail, so that no column is taken for another one.
    """
    names = spark.read.option("header", True).option("inferSchema", False).csv(path).columns
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def numbered_in_file_order(df: DataFrame, name: str) -> DataFrame:
    """``df``, straight from files, with a row number from 1 in the order of
    (file, place in the file).

    Rows are numbered inside each file split; sums over the splits' row counts
    (one row per split) give the offsets. Their join is broadcast only if Spark
    finds the counts small enough; a split's rows are one key otherwise.
    """
    tagged = df.withColumns({
        "_file": F.col("_metadata.file_path"), "_block": F.col("_metadata.file_block_start"),
        "_mid": F.monotonically_increasing_id()})
    splits = tagged.groupBy("_file", "_block").agg(F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_n"))
    starts = prefix_sums(splits, ["_file", "_block"], "_n", "_before").select(
        "_file", "_block", (F.col("_before") - F.col("_first") + 1).alias("_shift"))
    return (
        tagged.join(starts, ["_file", "_block"])
        .withColumn(name, (F.col("_mid") + F.col("_shift")).cast("long"))
        .drop("_file", "_block", "_mid", "_shift")
    )
