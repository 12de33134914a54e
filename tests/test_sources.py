"""Sources and sinks: feature-table fallback read, overwrite sink, decision
log append and read back, CSV text coercion."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from acctsentry.session import scratch_path
from acctsentry.sources.decision_log import read_log, write_log
from acctsentry.sources.transactions import read_feature_table, read_transactions, write_feature_table


def test_feature_table_fallback_and_overwrite(spark):
    good = scratch_path(spark, "ft")
    write_feature_table(spark.range(3).withColumnRenamed("id", "seq"), good)
    write_feature_table(spark.range(5).withColumnRenamed("id", "seq"), good)  # overwrite
    df = read_feature_table(spark, scratch_path(spark, "missing"), good)
    assert df.count() == 5
    with pytest.raises(AnalysisException):
        read_feature_table(spark, scratch_path(spark, "missing1"), scratch_path(spark, "missing2"))


def test_decision_log_append_and_prune(spark):
    path = scratch_path(spark, "log")
    rows = [(1, "10", 100.0, "O", "Approved", "2025-12-17 17:49:39"),
            (1, "10", 50.0, "S", "Rejected", "2025-12-18 09:00:00")]
    log = spark.createDataFrame(rows, "CustomerID long, FromAccountNo string, Amount double, Type string, "
                                      "Status string, Timestamp string") \
        .withColumn("Timestamp", F.to_timestamp("Timestamp"))
    write_log(log, path)
    write_log(log.limit(1), path)  # append
    back = read_log(spark, path)
    assert back.count() == 3
    one_day = back.where(F.col("log_date") == F.lit("2025-12-18").cast("date"))
    assert one_day.count() == 1
    assert "PartitionFilters: [isnotnull(log_date" in one_day._jdf.queryExecution().executedPlan().toString()


def test_csv_scan_coerces_text(spark):
    path = scratch_path(spark, "csv")
    spark.createDataFrame(
        [("1", "c", "a", "b", "12.5", "S", "X", "AE", "2024-01-07 10:00:00"),
         ("2", "c", "a", "b", "abc", "O", "X", "AE", "not a date")],
        "seq string, CustomerId string, FromAccountNo string, ReceipentAccount string, AmountInAed string, "
        "TransferType string, ChannelId string, BankCountry string, CreateDate string",
    ).write.option("header", True).csv(path)
    got = {r["seq"]: r for r in read_transactions(spark, path, fmt="csv").collect()}
    assert got[1]["AmountInAed"] == 12.5 and got[2]["AmountInAed"] is None
    assert got[1]["CreateDate"] is not None and got[2]["CreateDate"] is None


def test_csv_columns_are_taken_by_name_and_numbered_in_file_order(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        "CreateDate,CustomerId,FromAccountNo,AmountInAed,TransferType,ChannelId\n"
        "2024-01-07 10:00:00,c1,a1,12.5,S,web\n2024-01-07 11:00:00,c2,a2,NaN,O,app\n")
    rows = read_transactions(spark, str(tmp_path / "a.csv")).orderBy("seq").collect()
    assert [(r.seq, r.CustomerId, r.FromAccountNo, r.AmountInAed, r.TransferType, r.ChannelId) for r in rows][0] == (
        1, "c1", "a1", 12.5, "S", "web")
    assert [r.seq for r in rows] == [1, 2] and rows[0].CreateDate is not None and rows[0].BankCountry is None


def test_file_order_over_many_files(spark):
    path = scratch_path(spark, "many")
    (spark.range(1000).selectExpr("id as CustomerId", "id as FromAccountNo", "cast(id as double) as AmountInAed")
     .repartitionByRange(7, "CustomerId").sortWithinPartitions("CustomerId").write.option("header", True).csv(path))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700b")
    try:
        rows = read_transactions(spark, path, fmt="csv").select("seq", "CustomerId").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted((r.seq, int(r.CustomerId)) for r in rows) == [(i + 1, i) for i in range(1000)]


def test_a_header_that_differs_fails(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a.csv").write_text("CustomerId,AmountInAed\n1,2\n")
    (tmp_path / "d" / "b.csv").write_text("AmountInAed,CustomerId\n1,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_transactions(spark, str(tmp_path / "d"), fmt="csv").collect()


def test_published_log_layout(spark, tmp_path):
    (tmp_path / "log.csv").write_text(
        "CustomerID,Amount,Type,Status,Timestamp\n1000016,1000.0,O,Approved,2025-12-17 17:49:39.585311\n")
    (r,) = read_log(spark, str(tmp_path / "log.csv"), fmt="csv").collect()
    assert (r.CustomerID, r.FromAccountNo, r.Amount, r.Type, r.Status) == (1000016, None, 1000.0, "O", "Approved")
    assert str(r.Timestamp) == "2025-12-17 17:49:39.585311" and str(r.log_date) == "2025-12-17"


def test_amounts_that_are_no_numbers(spark):
    from acctsentry.operators.profile import account_profile

    df = spark.createDataFrame([("c", "a", "NaN"), ("c", "a", "abc"), ("c", "a", None), ("c", "a", "30")],
                               "CustomerId string, FromAccountNo string, AmountInAed string").withColumn("TransferType", F.lit("S"))
    assert account_profile(df).first()["user_avg_amount"] == 7.5
    both = df.withColumn("transaction_amount", F.lit(1.0))
    assert account_profile(both).first()["user_avg_amount"] == 1.0


def test_channel_codes_of_many_channels(spark):
    from acctsentry.operators.features import channel_codes

    n = 25_000
    df = spark.range(n * 2).selectExpr("id * 100 as seq", f"concat('c', (id * 7) % {n}) as ChannelId")
    want = {f"c{(i * 7) % n}": i for i in range(n)}
    assert {r[0]: r[1] for r in channel_codes(df).collect()} == want
