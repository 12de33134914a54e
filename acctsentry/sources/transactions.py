"""Raw transaction and feature-table sources and sinks."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acctsentry import schema as S
from acctsentry.sources.commits import MISSING, current, replace_table
from acctsentry.sources.text import numbered_in_file_order, read_csv_text


def read_transactions(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    """Raw transfers from CSV (columns by header name) or parquet.

    Absent columns become typed NULLs, text is coerced (bad text: NULL), and
    a table without ``seq`` is numbered in file order.
    """
    fmt = fmt or ("csv" if path.endswith(".csv") else "parquet")
    df = read_csv_text(spark, path) if fmt == "csv" else spark.read.parquet(path)
    if S.SEQ not in df.columns:
        df = numbered_in_file_order(df, S.SEQ)
    return S.conform(df)


def read_feature_table(spark: SparkSession, *paths: str) -> DataFrame:
    """The first path that exists, typed as the feature table is (the
    latest version of one that ``write_feature_table`` wrote); none:
    AnalysisException. Any other failure of a read is raised as it is."""
    errors = []
    for path in paths:
        p = current(spark, path) or path
        if path.endswith(".csv") and p != path:
            return typed_features(read_csv_text(spark, p))
        try:
            return typed_features(read_csv_text(spark, p)) if p.endswith(".csv") else spark.read.parquet(p)
        except AnalysisException as e:
            if e.getCondition() not in MISSING:
                raise
            errors.append(str(e).splitlines()[0])
    raise AnalysisException(f"feature table not found in {list(paths)}: {errors}")


def typed_features(text: DataFrame) -> DataFrame:
    """A feature table that was read as text, in the types it was written with."""
    df = S.conform(text) if set(S.RAW_SCHEMA.names) <= set(text.columns) else text
    for c in df.columns:
        if c in S.COUNT_FEATURES or c == "num_accounts":
            df = df.withColumn(c, F.col(c).try_cast("long"))
        elif c in S.FLAG_FEATURES:
            df = df.withColumn(c, F.col(c).try_cast("int"))
        elif c in S.MODEL_FEATURES or c == "month_spending_before":
            df = df.withColumn(c, F.col(c).try_cast("double"))
        elif c == "last_txn_time":
            df = df.withColumn(c, F.try_to_timestamp(c))
    return df


def write_feature_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """S3: the table's next version. Readers see it when it is whole; a write
    that fails leaves the one before."""
    replace_table(df, path, fmt)
