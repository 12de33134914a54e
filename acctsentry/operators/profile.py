"""Account profile, month-to-date spending, history totals, pick lists,
limits and rule decisions (A12-A14, A18, F1-F5, J10, R1-R6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acctsentry import schema as S
from acctsentry.functions import rules as R
from acctsentry.functions import scalar as X

K = list(S.ACCOUNT_KEY)
APPROVED_STATUSES = [S.STATUS_APPROVED, S.STATUS_FORCE_APPROVED]


def for_customer(df: DataFrame, customer_id: str) -> DataFrame:
    """rows of one customer, compared as text."""
    return df.where(F.col(S.CUSTOMER).cast("string") == F.lit(str(customer_id)))


def for_account(df: DataFrame, account_no: str) -> DataFrame:
    """rows of one account number, compared as text."""
    return df.where(F.col(S.ACCOUNT).cast("string") == F.lit(str(account_no)))


def in_month_of(ts: Column, as_of: Column) -> Column:
    """same calendar month and year as ``as_of``."""
    return F.date_trunc("month", ts) == F.date_trunc("month", as_of)


def account_profile(txn: DataFrame) -> DataFrame:
    """Per account mean, sample std, max, count and share of exact 'S'.

    ``user_std_display`` is 0 for a one-row account (shown limits);
    ``user_std_decision`` is 2000 for it (what the decision uses).
    """
    amt = X.amount_of(txn)
    prof = (
        txn.where(F.col(S.CUSTOMER).isNotNull() & F.col(S.ACCOUNT).isNotNull())
        .groupBy(*K)
        .agg(
            F.avg(amt).alias("user_avg_amount"),
            F.stddev_samp(amt).alias("_std"),
            F.max(amt).alias("user_max_amount"),
            F.count(F.lit(1)).alias("user_txn_frequency"),
            F.avg(F.coalesce(F.col(S.TRANSFER_TYPE) == "S", F.lit(False)).cast("double")).alias("user_international_ratio"),
        )
    )
    many = F.col("user_txn_frequency") > 1
    return prof.select(
        *K, "user_avg_amount", "user_max_amount", "user_txn_frequency", "user_international_ratio",
        F.when(many, F.col("_std")).otherwise(F.lit(0.0)).alias("user_std_display"),
        F.when(many, F.col("_std")).otherwise(F.lit(S.ONE_ROW_DECISION_STD)).alias("user_std_decision"),
    )


def with_profile(candidates: DataFrame, profile: DataFrame) -> DataFrame:
    """Candidates with their account profile; no history -> defaults."""
    avg0, std0, max0 = S.NO_HISTORY_PROFILE
    joined = candidates.join(profile, K, "left")
    return joined.withColumns(
        {
            "user_avg_amount": F.coalesce("user_avg_amount", F.lit(avg0)),
            "user_std_amount": F.coalesce("user_std_decision", F.lit(std0)),
            "user_max_amount": F.coalesce("user_max_amount", F.lit(max0)),
            "user_txn_frequency": F.coalesce("user_txn_frequency", F.lit(0).cast("long")),
            "user_international_ratio": F.coalesce("user_international_ratio", F.lit(0.0)),
        }
    ).drop("user_std_display", "user_std_decision")


def month_to_date(txn: DataFrame, as_of: Column) -> DataFrame:
    """Per account, sum of amounts in the calendar month of ``as_of``."""
    return (
        txn.where(F.col(S.CUSTOMER).isNotNull() & F.col(S.ACCOUNT).isNotNull())
        .groupBy(*K)
        .agg(
            F.coalesce(
                F.sum(F.when(in_month_of(F.col(S.CREATED), as_of), X.amount_of(txn))), F.lit(0.0)
            ).alias("month_to_date")
        )
    )


def month_totals(txn: DataFrame) -> DataFrame:
    """A13 for every month: (account key, month, stored_month)."""
    return (
        txn.where(F.col(S.CUSTOMER).isNotNull() & F.col(S.ACCOUNT).isNotNull() & F.col(S.CREATED).isNotNull())
        .groupBy(*K, F.date_trunc("month", S.CREATED).cast("date").alias("month"))
        .agg(F.sum(X.amount_of(txn)).alias("stored_month"))
    )


def decision_log_from(decisions: DataFrame) -> DataFrame:
    """S4 rows from decided transfers: status Approved or Rejected."""
    return decisions.select(
        F.col(S.CUSTOMER).cast("long").alias("CustomerID"),
        F.col(S.ACCOUNT).cast("string").alias("FromAccountNo"),
        F.col("transaction_amount").alias("Amount"),
        F.col(S.TRANSFER_TYPE).alias("Type"),
        F.when(F.col("is_fraud"), F.lit(S.STATUS_REJECTED)).otherwise(F.lit(S.STATUS_APPROVED)).alias("Status"),
        F.col(S.CREATED).alias("Timestamp"),
    )


def history_totals(history: DataFrame, log: DataFrame, as_of: Column) -> DataFrame:
    """Stored rows plus approved logged rows per account: total count
    and spending in the month of ``as_of``."""
    hist = history.select(
        F.col(S.CUSTOMER).cast("long").alias("CustomerID"),
        F.col(S.ACCOUNT).cast("string").alias("FromAccountNo"),
        X.amount_of(history).alias("Amount"),
        F.col(S.CREATED).alias("Timestamp"),
        F.lit(1).alias("_stored"),
    )
    sess = log.where(F.col("Status").isin(APPROVED_STATUSES)).select(
        "CustomerID", "FromAccountNo", "Amount", "Timestamp", F.lit(0).alias("_stored")
    )
    both = hist.unionByName(sess).where(F.col("CustomerID").isNotNull() & F.col("FromAccountNo").isNotNull())
    in_month = in_month_of(F.col("Timestamp"), as_of)
    return both.groupBy("CustomerID", "FromAccountNo").agg(
        F.sum("_stored").cast("long").alias("stored_count"),
        F.sum(1 - F.col("_stored")).cast("long").alias("session_count"),
        F.count(F.lit(1)).alias("total_txns"),
        F.coalesce(F.sum(F.when(in_month & (F.col("_stored") == 1), F.col("Amount"))), F.lit(0.0)).alias("stored_month"),
        F.coalesce(F.sum(F.when(in_month & (F.col("_stored") == 0), F.col("Amount"))), F.lit(0.0)).alias("session_month"),
    ).withColumn("total_month", F.col("stored_month") + F.col("session_month"))


def customer_list(txn: DataFrame) -> DataFrame:
    """Distinct customers as text, sorted."""
    return (
        txn.where(F.col(S.CUSTOMER).isNotNull())
        .select(F.col(S.CUSTOMER).cast("string").alias("customer"))
        .distinct()
        .orderBy("customer")
    )


def account_list(txn: DataFrame) -> DataFrame:
    """Distinct (customer, account) pairs as text, sorted."""
    return (
        txn.where(F.col(S.CUSTOMER).isNotNull() & F.col(S.ACCOUNT).isNotNull())
        .select(
            F.col(S.CUSTOMER).cast("string").alias("customer"),
            F.col(S.ACCOUNT).cast("string").alias("account"),
        )
        .distinct()
        .orderBy("customer", "account")
    )


def limits_by_type(profile: DataFrame) -> DataFrame:
    """R2: the five limits of every account, one row per type."""
    limits = R.all_limits(F.col("user_avg_amount"), F.col("user_std_display"))
    return profile.select(*K, F.inline(limits))


def rule_decisions(features: DataFrame) -> DataFrame:
    """R6 over feature rows: the batch velocity counts, the account profile of
    the feature table and the spending of the month before the row."""
    chk = R.rule_check(
        F.col("transaction_amount"),
        F.col("user_avg_amount"),
        # one row has no deviation: the decision then takes a fixed one
        F.when(F.col("user_txn_frequency") > 1, F.col("user_std_amount")).otherwise(F.lit(S.ONE_ROW_DECISION_STD)),
        F.col(S.TRANSFER_TYPE),
        F.col("txn_count_10min"),
        F.col("txn_count_1hour"),
        F.coalesce(F.col("month_spending_before"), F.lit(0.0)),
    )
    return features.withColumn("_rule", chk).select(
        "*",
        F.col("_rule.violated").alias("violated"),
        F.col("_rule.reasons").alias("reasons"),
        F.col("_rule.threshold").alias("threshold"),
    ).drop("_rule")
