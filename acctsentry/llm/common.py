"""Small helpers shared by the text operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acctsentry.session import checkpoint_root, scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
BLANKS = " \t\n\x0b\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def col(name: str) -> Column:
    """A column by its literal name (dots and spaces included)."""
    return F.col("`" + name.replace("`", "``") + "`")


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z; every other character stays."""
    return F.translate(c, UPPER, LOWER)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once.

    A lambda variable binds the value, so that Catalyst can't copy the
    expression into each place (or into each turn of an inner lambda) that
    uses it.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def materialized(df: DataFrame) -> DataFrame:
    """The frame written once to the cluster's shared checkpoint folder."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """The frame written once as Parquet below the shared checkpoint folder: its
    columns are read one by one, its plan begins anew, and ``forget`` can
    delete it when its successors are written."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "frame")
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def forget(*frames: DataFrame) -> None:
    """Delete frames of ``written`` that nothing will read any more."""
    for df in frames:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.written_to)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def others(df: DataFrame, *without: str) -> list[str]:
    """Columns but the named ones; as in Spark, case makes no other name."""
    low = {c.lower() for c in without}
    return [c for c in df.columns if c.lower() not in low]


def row_struct(df: DataFrame, *without: str) -> Column:
    """All columns but the named ones as one struct, so that no name of the
    caller's can clash with a working column; an empty rest holds a NULL."""
    kept = others(df, *without)
    return F.struct(*[col(c) for c in kept]) if kept else F.struct(F.lit(None).cast("int").alias("_none"))
