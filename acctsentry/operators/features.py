"""The feature table: one row per transfer with the 43 model features.

Plan, and why it is shaped this way for very large inputs:

* Unordered statistics (account, customer, calendar buckets) are ``groupBy``
  aggregates: Spark aggregates map-side before the shuffle, so a hot account
  only ships one partial row per task.  They are joined to each other on the
  small aggregated side, producing one table keyed by (account, day).
* Ordered features (gaps, trailing counts, rolling std, beneficiary history)
  and calendar buckets are windows.  Accounts with up to ``HOT_ACCOUNT_ROWS``
  rows take one exchange of narrow rows, by account, in which all their windows
  sort; row-wise features are made after it (``account_pass``).
* A window partitioned by the account alone would put a hot account in one
  task, so those of hot accounts are partitioned by (account, time chunk):
  a day for the velocity windows, ``BENE_CHUNK_DAYS`` for the 30-day
  beneficiary window.  Each chunk also receives a narrow *halo*: the rows of
  the previous chunk that fall inside the longest look-back, so range frames
  stay exact.  Row-count frames (previous row, last five rows) take the rows
  before a chunk from a small per-chunk tail table.  A day on which an account
  has very many rows is cut into its hours, each of them a chunk.
* Their rows are shuffled twice: by (account, beneficiary, chunk) and by
  (account, chunk).  The (account, chunk) statistics are joined inside the second
  shuffle (same keys), so they add no exchange of the rows.  Channel codes are
  counted first and broadcast, or joined with hot channels spread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acctsentry import schema as S
from acctsentry.functions import scalar as X
from acctsentry.operators.skew import join_spread, prefix_sums
from acctsentry.session import checkpoint_root

SENTINEL_CHUNK = 2**31 - 1
BENE_CHUNK_DAYS = 180
BENE_CHUNK_US = BENE_CHUNK_DAYS * X.DAY_US
US_SORT_NULL = 2**62  # NULL times sort after every real time
HOUR_US = X.DAY_US // 24
#: Rows of an account from which a day is cut into hours, but for the part of all rows that
#: bounds the number of such days (their list is broadcast).
HOT_DAY_ROWS, HOT_DAYS = 20_000, 100_000
#: Rows from which an account is cut into chunks of time, but for the part of all rows that
#: bounds the number of such accounts (their list is broadcast).
HOT_ACCOUNT_ROWS, HOT_ACCOUNTS = 50_000, 100_000
#: Channels that are broadcast at most.
CODES_BROADCAST = 100_000

K = list(S.ACCOUNT_KEY)
KN = ["_k0", "_k1", "_k2", "_k3"]  # null-safe account key (value, is-null) x 2
BN = ["_b0", "_b1"]  # null-safe beneficiary


def _null_safe(df: DataFrame, src: str, value_name: str, null_name: str) -> DataFrame:
    dt = df.schema[src].dataType
    default = F.lit("") if isinstance(dt, T.StringType) else F.lit(0).cast(dt)
    return df.withColumn(value_name, F.coalesce(F.col(src), default)).withColumn(
        null_name, F.col(src).isNull()
    )


def _key_not_null() -> Column:
    return F.col(S.CUSTOMER).isNotNull() & F.col(S.ACCOUNT).isNotNull()


# ---------------------------------------------------------------------------
# Row features
# ---------------------------------------------------------------------------
#: File-order numbers that one task of the channel numbering covers.
CODE_SPAN = 1 << 20


def channel_codes(conformed: DataFrame) -> DataFrame:
    """(channel, code), the code being the order of first appearance by ``seq``.

    Channels are aggregated map-side and numbered inside spans of ``seq``; the
    spans' counts (one row per span) give each span its offset.
    """
    firsts = (
        conformed.where(F.col(S.CHANNEL).isNotNull())
        .groupBy(S.CHANNEL)
        .agg(F.min(S.SEQ).alias("_first"), F.count(F.lit(1)).alias("_rows"))
        .withColumn("_span", F.floor(F.col("_first") / F.lit(CODE_SPAN)))
    )
    spans = prefix_sums(firsts.groupBy("_span").agg(F.count(F.lit(1)).alias("_n")), ["_span"], "_n", "_before").select("_span", "_before")
    inside = F.row_number().over(Window.partitionBy("_span").orderBy("_first", S.CHANNEL))
    return firsts.join(spans, "_span").select(
        S.CHANNEL, (F.col("_before") + inside - 1).cast("int").alias("channel_encoded"), "_rows")


def with_channel_codes(df: DataFrame) -> DataFrame:
    """P8 on every row. The codes are written first: a few are broadcast; more
    than ``CODES_BROADCAST`` are joined with the rows of hot channels spread."""
    checkpoint_root(df.sparkSession)
    codes = channel_codes(df).checkpoint(eager=True)
    if codes.count() <= CODES_BROADCAST:
        coded = df.join(F.broadcast(codes.drop("_rows")), S.CHANNEL, "left")
    else:
        coded = join_spread(df, codes, [S.CHANNEL], "_rows", F.col(S.SEQ), "left").drop("_rows")
    return coded.withColumn("channel_encoded", F.coalesce("channel_encoded", F.lit(0)))


def prepare(raw: DataFrame) -> DataFrame:
    """Conform, then add the row-wise features P1-P13 and helper columns."""
    return with_helpers(with_row_features(prepare_narrow(raw)))


def prepare_narrow(raw: DataFrame) -> DataFrame:
    """Conformed rows with what needs other rows or text to be read: amount, time and channel code."""
    df = S.conform(raw).select("*", X.amount().alias("transaction_amount"), X.event_micros(F.col(S.CREATED)).alias("_us"))
    return with_channel_codes(df)


def with_row_features(df: DataFrame) -> DataFrame:
    """They follow from a row's raw columns, so they are made where they are needed, not moved."""
    ts, t = F.col(S.CREATED), F.col(S.TRANSFER_TYPE)
    hour, dow = X.hour_of_day(ts), X.day_of_week(ts)
    return df.select(
        "*",
        X.flag_amount(t).alias("flag_amount"),
        X.type_encoded(t).alias("transfer_type_encoded"),
        X.type_risk(t).alias("transfer_type_risk"),
        hour.alias("hour"),
        dow.alias("day_of_week"),
        X.is_weekend(dow).alias("is_weekend"),
        X.is_night(hour).alias("is_night"),
    )


def with_helpers(df: DataFrame) -> DataFrame:
    """The order and the null-safe keys of the passes in chunks."""
    df = df.withColumn("_us_sort", F.coalesce(F.col("_us"), F.lit(US_SORT_NULL)))
    df = _null_safe(df, S.CUSTOMER, "_k0", "_k1")
    df = _null_safe(df, S.ACCOUNT, "_k2", "_k3")
    return _null_safe(df, S.BENEFICIARY, "_b0", "_b1")


# ---------------------------------------------------------------------------
# Aggregated tables
# ---------------------------------------------------------------------------
def account_stats(p: DataFrame) -> DataFrame:
    """A1-A3, A6, P17 per account (NULL keys dropped, as group-bys do)."""
    keyed = p.where(_key_not_null())
    amt = F.col("transaction_amount")
    stats = keyed.groupBy(*K).agg(
        F.avg(amt).alias("user_avg_amount"),
        F.coalesce(F.stddev_samp(amt), F.lit(0.0)).alias("user_std_amount"),
        F.max(amt).alias("user_max_amount"),
        F.count(F.lit(1)).alias("user_txn_frequency"),
        F.avg("flag_amount").cast("double").alias("intl_ratio"),
        F.avg("transfer_type_risk").alias("user_high_risk_txn_ratio"),
    )
    countries = (
        keyed.where(F.col(S.COUNTRY).isNotNull())
        .select(*K, S.COUNTRY)
        .distinct()
        .groupBy(*K)
        .agg(F.count(F.lit(1)).alias("country_count"))
    )
    return stats.join(countries, K, "left").select(
        *K,
        "user_avg_amount", "user_std_amount", "user_max_amount", "user_txn_frequency",
        "intl_ratio", "user_high_risk_txn_ratio",
        F.coalesce((F.col("country_count") > 2).cast("int"), F.lit(0)).alias("geo_anomaly_flag"),
    )


def customer_stats(p: DataFrame) -> DataFrame:
    """A4, A5 per customer, from per-(customer, account) partial counts.

    ``num_accounts`` counts distinct non-NULL accounts.  The cross-account
    ratio is the share of the customer's rows whose account differs from the
    account of the customer's first row (file order); a NULL account always
    differs, and a one-row customer has ratio 0.
    """
    per_acct = (
        p.where(F.col(S.CUSTOMER).isNotNull())
        .groupBy(S.CUSTOMER, S.ACCOUNT)
        .agg(F.count(F.lit(1)).alias("_n"), F.min(S.SEQ).alias("_first_seq"))
    )
    per_cust = per_acct.groupBy(S.CUSTOMER).agg(
        F.count(S.ACCOUNT).alias("num_accounts"),
        F.min_by(S.ACCOUNT, "_first_seq").alias("_first_acct"),
        F.min_by("_n", "_first_seq").alias("_n_first"),
        F.sum("_n").alias("_n_c"),
        F.min("_first_seq").alias("_min_seq"),
    )
    ratio = (
        F.when(F.col("_n_c") <= 1, F.lit(0.0))
        .when(F.col("_first_acct").isNull(), F.lit(1.0))
        .otherwise((F.col("_n_c") - F.col("_n_first")) / F.col("_n_c"))
    )
    return per_cust.select(
        S.CUSTOMER,
        F.col("num_accounts").cast("long").alias("num_accounts"),
        ratio.alias("cross_account_transfer_ratio"), "_n_c",
    )


def calendar_tables(p: DataFrame) -> DataFrame:
    """A7-A10 and the month-to-date spending before each day, keyed by
    (account, day chunk).  Rows are aggregated once by (account, hour); day,
    week and month totals are rolled up from the hourly partials."""
    dated = p.where(_key_not_null() & F.col(S.CREATED).isNotNull())
    amt = F.col("transaction_amount")
    hourly = dated.groupBy(*K, F.date_trunc("hour", S.CREATED).alias("_hour")).agg(
        F.sum(amt).alias("_hs"), F.count(F.lit(1)).alias("_hc")
    )
    hourly = hourly.withColumn(
        "_t", F.floor(F.unix_micros("_hour") / F.lit(X.DAY_US)).cast("long")
    )
    daily = hourly.groupBy(*K, "_t").agg(
        F.sum("_hs").alias("daily_total"),
        F.sum("_hc").alias("daily_count"),
        F.map_from_entries(F.collect_list(F.struct("_hour", F.struct("_hs", "_hc")))).alias("_hours"),
        F.min("_hour").alias("_day_any"),
    )
    daily = daily.withColumn("_week", F.date_trunc("week", "_day_any")).withColumn(
        "_month", F.date_trunc("month", "_day_any")
    )
    weekly = hourly.groupBy(*K, F.date_trunc("week", "_hour").alias("_week")).agg(
        F.sum("_hs").alias("weekly_total"), F.sum("_hc").alias("weekly_txn_count")
    )
    monthly = hourly.groupBy(*K, F.date_trunc("month", "_hour").alias("_month")).agg(
        F.sum("_hs").alias("current_month_spending"), F.sum("_hc").alias("monthly_txn_count")
    )
    month_before = F.coalesce(
        F.sum("daily_total").over(
            Window.partitionBy(*K, "_month").orderBy("_t").rowsBetween(Window.unboundedPreceding, -1)
        ),
        F.lit(0.0),
    )
    daily = daily.withColumn("_month_before_day", month_before)
    return (
        daily.join(weekly, [*K, "_week"], "left")
        .join(monthly, [*K, "_month"], "left")
        .withColumn("weekly_avg_amount", F.col("weekly_total") / F.col("weekly_txn_count"))
        .withColumn("monthly_avg_amount", F.col("current_month_spending") / F.col("monthly_txn_count"))
        .drop("_week", "_month", "_day_any")
    )


def _chunk(us: Column, width_us: int) -> Column:
    return F.when(us.isNull(), F.lit(SENTINEL_CHUNK).cast("long")).otherwise(
        F.floor(us / F.lit(width_us)).cast("long")
    )


def with_chunks(keyed: DataFrame) -> DataFrame:
    """Adds ``_d``, the row's day, and ``_c``, its chunk: 24 times the day, plus
    the hour on days on which the account has very many rows."""
    day = _chunk(F.col("_us"), X.DAY_US)
    dated = keyed.where(F.col("_us").isNotNull())
    counts = dated.groupBy(*KN, day.alias("_d")).agg(F.count(F.lit(1)).alias("_n")).checkpoint(eager=True)
    total = counts.agg(F.sum("_n")).first()[0] or 0
    hot = counts.where(F.col("_n") > max(HOT_DAY_ROWS, total // HOT_DAYS)).select(*KN, "_d", F.lit(True).alias("_hot"))
    rows = keyed.withColumn("_d", day)
    if hot.isEmpty():
        rows = rows.withColumn("_hot", F.lit(False))
    else:  # fewer than HOT_DAYS rows
        rows = rows.join(F.broadcast(hot), [*KN, "_d"], "left").withColumn("_hot", F.coalesce("_hot", F.lit(False)))
    hour = F.floor((F.col("_us") - F.col("_d") * F.lit(X.DAY_US)) / F.lit(HOUR_US)).cast("long")
    return rows.withColumn("_c", F.col("_d") * 24 + F.when(F.col("_hot"), hour).otherwise(F.lit(0).cast("long")))


def chunk_tails(p: DataFrame) -> DataFrame:
    """One row per (account, chunk) with the rows just before the chunk: the
    last four amounts and the previous time, for the row-count frames, and the
    amounts of the day before it.

    Built from a narrow projection shuffled by (account, chunk): the first row
    and the last four rows of every chunk form a small table in which the four
    rows before a chunk's first row are the four rows before the chunk.  That
    table is windowed per account; it holds at most five rows per chunk, so even
    a hot account is small there.
    """
    narrow = p.select(*K, *KN, "_us", "_us_sort", S.SEQ, S.CREATED, "transaction_amount", "_d", F.col("_c").alias("_t"))
    part = Window.partitionBy(*KN, "_t")
    narrow = narrow.select(
        "*",
        F.row_number().over(part.orderBy("_us_sort", S.SEQ)).alias("_rn"),
        F.count(F.lit(1)).over(part).alias("_n"),
        F.sum("transaction_amount").over(part).alias("_chunk_amt"),
    )
    tail = narrow.where((F.col("_n") - F.col("_rn") < 4) | (F.col("_rn") == 1))
    by_key = Window.partitionBy(*KN).orderBy("_us_sort", S.SEQ)
    lag_amt = [F.lag("transaction_amount", i).over(by_key) for i in (4, 3, 2, 1)]
    earlier = Window.partitionBy(*KN, "_d").orderBy("_t").rowsBetween(Window.unboundedPreceding, -1)
    return tail.select(
        *K, *KN, "_d", "_t", "_rn", "_chunk_amt",
        F.array_compact(F.array(*lag_amt)).alias("_carry_amts"),
        F.lag("_us", 1).over(by_key).alias("_carry_us"),
        F.lag(S.CREATED, 1).over(by_key).alias("_carry_ts"),
    ).where(F.col("_rn") == 1).withColumn(
        "_carry_day", F.coalesce(F.sum("_chunk_amt").over(earlier), F.lit(0.0))).drop("_rn", "_chunk_amt")


def group_table(keyed: DataFrame, p: DataFrame, customers: DataFrame) -> DataFrame:
    """Every (account, chunk) of the keyed rows, with its carry and all group
    statistics; joined to the rows inside the velocity pass."""
    return (
        chunk_tails(keyed)
        .join(account_stats(p), K, "left")
        .join(customers.drop("_n_c"), S.CUSTOMER, "left")
        .join(calendar_tables(p).withColumnRenamed("_t", "_d"), [*K, "_d"], "left")
        .drop(*K, "_d")
    )


# ---------------------------------------------------------------------------
# Ordered passes
# ---------------------------------------------------------------------------
def _with_halo(rows: DataFrame, width_us: int, lookback_us: int, narrow: list[str]) -> DataFrame:
    """Rows tagged with their chunk ``_t`` plus halo copies (``_halo``) of the
    rows within ``lookback_us`` of the end of their chunk, sent to the next
    chunk.  Halo copies carry only ``narrow`` columns."""
    us = F.col("_us")
    owned = rows.withColumn("_t", _chunk(us, width_us)).withColumn("_halo", F.lit(False))
    halo = (
        owned.where(us.isNotNull() & (us >= (F.col("_t") + 1) * F.lit(width_us) - F.lit(lookback_us)))
        .select(*narrow, (F.col("_t") + 1).alias("_t"))
        .withColumn("_halo", F.lit(True))
    )
    return owned.unionByName(halo, allowMissingColumns=True)


def _orders(keys: list[str]):
    """Window specs over (keys) ordered by time (NULL last) then file order;
    every window of a pass shares this one sort."""
    by_time = Window.partitionBy(*keys).orderBy(F.col("_us").asc_nulls_last())
    by_row = Window.partitionBy(*keys).orderBy(F.col("_us").asc_nulls_last(), S.SEQ)
    return by_time, by_row


def _later_ties(keys: list[str]) -> Column:
    """Rows with the same time that come after this row in file order: a
    value frame takes them, the reference's positional loop does not."""
    by_time, by_row = _orders(keys)
    upto_time = F.count(F.lit(1)).over(by_time.rangeBetween(Window.unboundedPreceding, 0))
    upto_row = F.count(F.lit(1)).over(by_row.rowsBetween(Window.unboundedPreceding, 0))
    return upto_time - upto_row


def _in_range(keys: list[str], width_us: int) -> Column:
    by_time, _ = _orders(keys)
    return F.count(F.lit(1)).over(by_time.rangeBetween(-width_us, 0))


def beneficiary_pass(p: DataFrame) -> DataFrame:
    """W1, W2 on (account, beneficiary, 180-day chunk) partitions."""
    narrow = [*KN, *BN, "_us", S.SEQ]
    rows = _with_halo(p, BENE_CHUNK_US, S.WINDOW_30D * X.MICROS, narrow)
    # first chunk of each (account, beneficiary): from the small chunk table
    chunks = p.select(*KN, *BN, _chunk(F.col("_us"), BENE_CHUNK_US).alias("_t")).distinct()
    first = chunks.withColumn(
        "_first_chunk",
        F.row_number().over(Window.partitionBy(*KN, *BN).orderBy("_t")) == 1,
    )
    keys = [*KN, *BN, "_t"]
    _, by_row = _orders(keys)
    rows = rows.select(
        "*", (_in_range(keys, S.WINDOW_30D * X.MICROS) - _later_ties(keys)).alias("_bene_30d")
    ).where(~F.col("_halo"))
    # The join comes after the windows: it finds the rows dealt and sorted by its keys.
    rows = rows.withColumn("_first_in_chunk", F.row_number().over(by_row) == 1).join(first, keys, "left")
    key_null = ~_key_not_null()
    is_new = F.when(key_null, F.lit(None)).otherwise(
        (F.col("_first_in_chunk") & F.col("_first_chunk")).cast("int")
    )
    bene30 = (
        F.when(key_null, F.lit(None))
        .when(F.col(S.CREATED).isNull(), F.lit(1))
        .when(F.col(S.BENEFICIARY).isNull(), F.lit(0))
        .otherwise(F.col("_bene_30d"))
    )
    return rows.select(
        *[c for c in p.columns],
        is_new.cast("int").alias("is_new_beneficiary"),
        bene30.cast("long").alias("beneficiary_txn_count_30d"),
    )


def velocity_pass(p: DataFrame, groups: DataFrame) -> DataFrame:
    """W3-W8, P18, P21 and bucket/account statistics on (account, chunk)
    partitions (``with_chunks``); one exchange and one sort of the rows. The
    halo of a chunk is the hour before it."""
    narrow = [*KN, "_us", "_us_sort", S.SEQ]
    halo = p.where(F.col("_us").isNotNull() & (
        F.col("_hot") | (F.col("_us") >= (F.col("_d") + 1) * F.lit(X.DAY_US) - F.lit(HOUR_US)))).select(
        *narrow, F.when(F.col("_hot"), F.col("_c") + 1).otherwise((F.col("_d") + 1) * 24).alias("_t"), F.lit(True).alias("_halo"))
    rows = p.drop("_d", "_hot").withColumnRenamed("_c", "_t").withColumn("_halo", F.lit(False)).unionByName(halo, allowMissingColumns=True)
    keys = [*KN, "_t"]
    _, by_row = _orders(keys)
    ties = _later_ties(keys)
    rows = rows.select(
        "*",
        (_in_range(keys, S.WINDOW_30S * X.MICROS) - ties).alias("_c30s"),
        (_in_range(keys, S.WINDOW_10MIN * X.MICROS) - ties).alias("_c10m"),
        (_in_range(keys, S.WINDOW_1HOUR * X.MICROS) - ties).alias("_c1h"),
    ).where(~F.col("_halo"))
    # halo rows are gone: the frames below see the chunk's own rows only
    amt = F.col("transaction_amount")
    return rows.select(
        "*",
        F.row_number().over(by_row).alias("_rn"),
        F.lag("_us").over(by_row).alias("_prev_us_in"),
        F.lag(S.CREATED).over(by_row).alias("_prev_ts_in"),
        F.collect_list(amt).over(by_row.rowsBetween(-4, 0)).alias("_last5"),
        F.coalesce(
            F.sum(amt).over(by_row.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)
        ).alias("_day_before"),
    ).join(groups, keys, "left")


def account_pass(p: DataFrame, accounts: DataFrame) -> DataFrame:
    """All ordered and calendar features of accounts that a task can hold: one
    exchange of the rows, by account, and windows that sort inside its
    partitions. ``accounts`` (account and customer statistics) is joined where
    the rows lie."""
    us, amt = F.col("_us").asc_nulls_last(), F.col("transaction_amount")
    bene = [*K, S.BENEFICIARY]
    by_bene = Window.partitionBy(*bene).orderBy(us, S.SEQ)
    _, by_row = _orders(K)
    ties = _later_ties(K)
    # The windows by account come first: their exchange serves those of parts of an account, which only sort.
    rows = p.select(
        "*",
        *[F.when(F.col(S.CREATED).isNotNull(), F.date_trunc(w, S.CREATED)).alias(f"_{w}") for w in ("hour", "day", "week", "month")],
        (_in_range(K, S.WINDOW_30S * X.MICROS) - ties).alias("_c30s"),
        (_in_range(K, S.WINDOW_10MIN * X.MICROS) - ties).alias("_c10m"),
        (_in_range(K, S.WINDOW_1HOUR * X.MICROS) - ties).alias("_c1h"),
        F.lag("_us").over(by_row).alias("_prev_us"),
        F.lag(S.CREATED).over(by_row).alias("_prev_ts"),
        F.collect_list(amt).over(by_row.rowsBetween(-4, 0)).alias("_window5"))
    # Times, months, weeks, days and hours go up together, so each sort finds its rows nearly in order.
    month = Window.partitionBy(*K, "_month").orderBy(us, S.SEQ)
    rows = rows.select("*", F.coalesce(F.sum(amt).over(month.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)).alias("_month_before"))
    for unit, total, count in (("month", "current_month_spending", "monthly_txn_count"), ("week", "weekly_total", "weekly_txn_count"),
                               ("day", "daily_total", "daily_count"), ("hour", "hourly_total", "hourly_count")):
        same = Window.partitionBy(*K, f"_{unit}")
        dated = F.col("_us").isNotNull()
        rows = rows.select("*", F.when(dated, F.sum(amt).over(same)).alias(total), F.when(dated, F.count(F.lit(1)).over(same)).alias(count))
    rows = rows.select(
        "*", F.row_number().over(by_bene).alias("_bene_n"),
        (_in_range(bene, S.WINDOW_30D * X.MICROS) - _later_ties(bene)).alias("_bene_30d"))
    undated = F.col(S.CREATED).isNull()
    return rows.join(accounts, K, "left").withColumns({
        "is_new_beneficiary": (F.col("_bene_n") == 1).cast("int"),
        "beneficiary_txn_count_30d": F.when(undated, F.lit(1)).when(F.col(S.BENEFICIARY).isNull(), F.lit(0)).otherwise(F.col("_bene_30d")).cast("long"),
        "weekly_avg_amount": F.col("weekly_total") / F.col("weekly_txn_count"),
        "monthly_avg_amount": F.col("current_month_spending") / F.col("monthly_txn_count")})


def _from_chunks(v: DataFrame) -> DataFrame:
    """What ``account_pass`` gives, from the rows of a chunk and what lies before it."""
    key_null = ~_key_not_null()
    has_prev = F.col("_rn") > 1
    empty = F.array().cast("array<double>")
    window5 = F.concat(
        F.when(F.col("_rn") < 5, F.coalesce(F.col("_carry_amts"), empty)).otherwise(empty),
        F.col("_last5"),
    )
    hour_stats = F.col("_hours")[F.date_trunc("hour", S.CREATED)]
    return v.withColumns({
        "_prev_us": F.when(has_prev, F.col("_prev_us_in")).otherwise(F.col("_carry_us")),
        "_prev_ts": F.when(has_prev, F.col("_prev_ts_in")).otherwise(F.col("_carry_ts")),
        "_window5": F.when(~key_null, F.slice(window5, F.greatest(F.size(window5) - 4, F.lit(1)), 5)),
        "_month_before": F.col("_month_before_day") + F.col("_carry_day") + F.col("_day_before"),
        "hourly_total": hour_stats["_hs"],
        "hourly_count": hour_stats["_hc"],
    })


def _finish(v: DataFrame, out_cols: list[str]) -> DataFrame:
    key_null = ~_key_not_null()
    ts_null = F.col(S.CREATED).isNull()
    amt = F.col("transaction_amount")
    gap = F.when(key_null | ts_null | F.col("_prev_us").isNull(), F.lit(S.DEFAULT_GAP_SECONDS)).otherwise(
        (F.col("_us") - F.col("_prev_us")) / F.lit(1e6)
    )

    def count_or_one(c: str) -> Column:
        return F.when(key_null, F.lit(None)).when(ts_null, F.lit(1)).otherwise(F.col(c)).cast("long")

    feats = {
        "deviation_from_avg": F.abs(amt - F.col("user_avg_amount")),
        "amount_to_max_ratio": X.safe_ratio(amt, F.col("user_max_amount")),
        "user_multiple_accounts_flag": F.coalesce((F.col("num_accounts") > 1).cast("int"), F.lit(0)),
        "geo_anomaly_flag": F.coalesce(F.col("geo_anomaly_flag"), F.lit(0)),
        "rolling_std": F.when(key_null, F.lit(0.0)).otherwise(X.sample_std(F.col("_window5"))),
        "time_since_last": gap,
        "last_txn_time": F.when(key_null, F.lit(None)).otherwise(F.col("_prev_ts")),
        "transaction_velocity": F.when(key_null, F.lit(0.0)).otherwise(X.velocity(gap)),
        "recent_burst": (gap < S.BURST_SECONDS).cast("int"),
        "txn_count_30s": count_or_one("_c30s"),
        "txn_count_10min": count_or_one("_c10m"),
        "txn_count_1hour": count_or_one("_c1h"),
        "weekly_deviation": F.abs(amt - F.col("weekly_avg_amount")),
        "amount_vs_weekly_avg": X.safe_ratio(amt, F.col("weekly_avg_amount")),
        "monthly_deviation": F.abs(amt - F.col("monthly_avg_amount")),
        "amount_vs_monthly_avg": X.safe_ratio(amt, F.col("monthly_avg_amount")),
        "month_spending_before": F.when(key_null | ts_null, F.lit(None)).otherwise(F.col("_month_before")),
    }
    return with_row_features(v).withColumns(feats).select(*out_cols)


def feature_table(raw: DataFrame) -> DataFrame:
    """Raw columns + the 43 model features + ``num_accounts``,
    ``last_txn_time`` and ``month_spending_before`` (spending of the account
    in the row's calendar month before the row, for the monthly rule)."""
    present = set(raw.columns)
    p = prepare_narrow(raw)
    raw_cols = [f.name for f in S.RAW_SCHEMA.fields] + [
        c for c in p.columns if c in present and c not in {f.name for f in S.RAW_SCHEMA.fields}
    ]
    out_cols = raw_cols + S.MODEL_FEATURES + ["num_accounts", "last_txn_time", "month_spending_before"]
    if not (S.CUSTOMER in present and S.ACCOUNT in present):
        return _keyless_features(with_row_features(p), out_cols)
    # Rows without an account key have constants where others have an order; they don't
    # meet in one task, but pass by and take their customer's statistics.
    keyed = p.where(_key_not_null())
    customers = customer_stats(p).checkpoint(eager=True)
    accounts = account_stats(with_row_features(p)).join(customers.drop("_n_c"), S.CUSTOMER, "left").checkpoint(eager=True)
    total = accounts.agg(F.sum("user_txn_frequency")).first()[0] or 0
    hot = accounts.where(F.col("user_txn_frequency") > max(HOT_ACCOUNT_ROWS, total // HOT_ACCOUNTS)).select(*K)
    if hot.isEmpty():
        v = account_pass(keyed, accounts)
    else:  # fewer than HOT_ACCOUNTS accounts: their rows are dealt over chunks of time
        v = account_pass(keyed.join(F.broadcast(hot), K, "left_anti"), accounts)
        p_hot = with_helpers(with_row_features(keyed.join(F.broadcast(hot), K, "left_semi")))
        chunked = with_chunks(p_hot)
        by_chunk = _from_chunks(velocity_pass(beneficiary_pass(chunked), group_table(chunked, p_hot, customers)))
        v = v.unionByName(by_chunk.select(*[F.col(f.name) if f.name in by_chunk.columns else
                                            F.lit(None).cast(f.dataType).alias(f.name) for f in v.schema.fields]))
    loose = join_spread(p.where(~_key_not_null()), customers, [S.CUSTOMER], "_n_c", F.col(S.SEQ), "left").drop("_n_c")
    v = v.unionByName(loose.select(
        "*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in v.schema.fields if f.name not in loose.columns]))
    out = _finish(v, out_cols)
    # A date column without one usable date counts as none; a usable one ends the look at once.
    if S.CREATED not in present or p.where(F.col(S.CREATED).isNotNull()).isEmpty():
        out = _dateless_overrides(out).withColumns({
            "time_since_last": F.lit(S.DEFAULT_GAP_SECONDS), "recent_burst": F.lit(0), "last_txn_time": F.lit(None).cast("timestamp"),
            **{c: F.lit(1).cast("long") for c in ("txn_count_30s", "txn_count_10min", "txn_count_1hour")},
        })
    if S.BENEFICIARY not in present or S.CREATED not in present:
        out = out.withColumn("is_new_beneficiary", F.lit(0)).withColumn(
            "beneficiary_txn_count_30d", F.lit(1).cast("long")
        )
    return typed(out)


def _dateless_overrides(df: DataFrame) -> DataFrame:
    """Without dates, buckets are the row itself."""
    amt = F.col("transaction_amount")
    one = F.lit(1).cast("long")
    return df.withColumns(
        {
            "hourly_total": amt, "hourly_count": one, "daily_total": amt, "daily_count": one,
            "weekly_total": amt, "weekly_txn_count": one, "weekly_avg_amount": amt,
            "weekly_deviation": F.lit(0.0), "amount_vs_weekly_avg": F.lit(1.0),
            "current_month_spending": amt, "monthly_txn_count": one, "monthly_avg_amount": amt,
            "monthly_deviation": F.lit(0.0), "amount_vs_monthly_avg": F.lit(1.0),
        }
    )


def _keyless_features(p: DataFrame, out_cols: list[str]) -> DataFrame:
    """Without an account key, whole-table statistics (one row,
    collected as literals) and constants."""
    amt = F.col("transaction_amount")
    st = p.agg(
        F.avg(amt).alias("a"), F.stddev_samp(amt).alias("s"), F.max(amt).alias("m"),
        F.count(F.lit(1)).alias("n"),
    ).first()
    one = F.lit(1).cast("long")
    cols = {
        "user_avg_amount": F.lit(st["a"]).cast("double"),
        "user_std_amount": F.lit(st["s"]).cast("double"),
        "user_max_amount": F.lit(st["m"]).cast("double"),
        "user_txn_frequency": F.lit(st["n"]).cast("long"),
        "deviation_from_avg": F.lit(0.0), "amount_to_max_ratio": F.lit(0.0),
        "intl_ratio": F.lit(0.0), "user_high_risk_txn_ratio": F.lit(0.0),
        "user_multiple_accounts_flag": F.lit(0), "cross_account_transfer_ratio": F.lit(0.0),
        "geo_anomaly_flag": F.lit(0), "is_new_beneficiary": F.lit(0),
        "beneficiary_txn_count_30d": one, "time_since_last": F.lit(S.DEFAULT_GAP_SECONDS),
        "recent_burst": F.lit(0), "last_txn_time": F.lit(None).cast("timestamp"),
        "txn_count_30s": one, "txn_count_10min": one, "txn_count_1hour": one,
        "rolling_std": F.lit(0.0), "transaction_velocity": F.lit(0.0),
        "num_accounts": F.lit(None).cast("long"), "month_spending_before": F.lit(None).cast("double"),
    }
    out = _dateless_overrides(p.withColumns(cols))
    return typed(out.select(*out_cols))


def typed(df: DataFrame) -> DataFrame:
    """Counts bigint, flags and codes int, everything else double."""
    casts = {}
    for f in S.MODEL_FEATURES:
        if f in S.COUNT_FEATURES:
            casts[f] = F.col(f).cast("long")
        elif f in S.FLAG_FEATURES:
            casts[f] = F.col(f).cast("int")
        else:
            casts[f] = F.col(f).cast("double")
    return df.withColumns(casts)


def model_matrix(features: DataFrame) -> DataFrame:
    """The 43 model columns, NULL -> 0, as doubles (plus ``seq``)."""
    return features.select(
        S.SEQ, *[F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f) for f in S.MODEL_FEATURES]
    )
