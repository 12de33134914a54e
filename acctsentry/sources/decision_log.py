"""Decision log sink and source (S4, S5): append-only, partitioned by date so
month filters prune partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acctsentry import schema as S
from acctsentry.sources.text import read_csv_text

LOG_WITH_ACCOUNT = T.StructType([*S.LOG_SCHEMA.fields[:1], T.StructField("FromAccountNo", T.StringType()),
                                 *S.LOG_SCHEMA.fields[1:]])
LOG_DATE = T.StructField("log_date", T.DateType())


def write_log(log: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Append rows; the header/schema travels with the files."""
    (log.withColumn("log_date", F.to_date("Timestamp"))
        .write.mode("append").partitionBy("log_date").format(fmt)
        .option("header", True).save(path))


def as_log(text: DataFrame) -> DataFrame:
    """Log columns by name from text; absent ones (the published layout has no
    account) are NULL, and the date comes from the time where it is absent."""
    log = S.conform(text, LOG_WITH_ACCOUNT).select(*LOG_WITH_ACCOUNT.names, *(["log_date"] if "log_date" in text.columns else []))
    day = F.to_date("Timestamp")
    return log.withColumn("log_date", F.coalesce(F.col("log_date").try_cast("date"), day) if "log_date" in log.columns else day)


def read_log(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The log with its fixed schema and its date. CSV columns are taken by
    header name, whatever their order."""
    if fmt == "csv":
        return as_log(read_csv_text(spark, path))
    return spark.read.format(fmt).schema(T.StructType([*LOG_WITH_ACCOUNT.fields, LOG_DATE])).load(path)


def read_log_stream(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """S5 as a stream (new log files as they land). A CSV log must hold a file
    already, whose header names the columns of all that follow."""
    if fmt == "csv":
        names = read_csv_text(spark, path).columns
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
        return as_log(spark.readStream.schema(schema).option("header", True).option("enforceSchema", False).csv(path))
    return spark.readStream.format(fmt).schema(T.StructType([*LOG_WITH_ACCOUNT.fields, LOG_DATE])).load(path)
