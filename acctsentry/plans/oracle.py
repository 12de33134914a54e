"""DuckDB SQL for the correctness check.

Each statement recomputes a registered query from the driver tables with plain
SQL windows partitioned by the whole account, written independently of the
Spark plan (which chunks the windows by time).  Doubles that are sums or
averages are rounded to 6 places on both sides; counts are bigint and flags
int on both sides.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Transfer views
# ---------------------------------------------------------------------------
TXN_EVENTS = """
SELECT
  event_id AS seq,
  user_id AS CustomerId,
  user_id * 10 + event_id % 2 AS FromAccountNo,
  CAST(json_extract_string(props, '$.k') AS BIGINT) % 20 AS ReceipentAccount,
  value * 100 AS AmountInAed,
  CASE event_type WHEN 'purchase' THEN 'S' WHEN 'signup' THEN 'Q' WHEN 'click' THEN 'L'
                  WHEN 'view' THEN 'I' WHEN 'error' THEN 'O' END AS TransferType,
  'C' || CAST(event_id % 4 AS VARCHAR) AS ChannelId,
  'B' || CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) % 5 AS VARCHAR) AS BankCountry,
  TIMESTAMP '2024-01-01 00:00:00'
    + to_seconds(CAST(floor((epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01 00:00:00')) / 240000000) AS BIGINT))
    AS CreateDate,
  CASE WHEN event_type = 'error' THEN 'Rejected' ELSE 'Approved' END AS Status
FROM events
"""

TXN_LINEITEM = """
SELECT
  row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) AS seq,
  o_custkey AS CustomerId,
  o_custkey * 10 + CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 WHEN 'R' THEN 2 END AS FromAccountNo,
  l_suppkey AS ReceipentAccount,
  l_extendedprice AS AmountInAed,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'S' WHEN '2-HIGH' THEN 'Q' WHEN '3-MEDIUM' THEN 'L'
                       WHEN '4-NOT SPECIFIED' THEN 'I' WHEN '5-LOW' THEN 'O' END AS TransferType,
  o_orderstatus AS ChannelId,
  n_name AS BankCountry,
  l_shipdate AS CreateDate
FROM lineitem
JOIN orders ON l_orderkey = o_orderkey
LEFT JOIN supplier ON l_suppkey = s_suppkey
LEFT JOIN nation ON s_nationkey = n_nationkey
"""


TXN_DIRTY = """
SELECT seq,
  CASE WHEN seq % 61 = 0 THEN seq + 1000000 WHEN seq % 17 = 0 THEN NULL ELSE CustomerId END AS CustomerId,
  CASE WHEN seq % 61 = 0 THEN seq + 10000000 WHEN seq % 19 = 0 THEN NULL ELSE FromAccountNo END AS FromAccountNo,
  CASE WHEN seq % 23 = 0 THEN NULL ELSE ReceipentAccount END AS ReceipentAccount,
  CASE WHEN seq % 29 = 0 OR seq % 31 = 0 OR seq % 37 = 0 THEN NULL ELSE AmountInAed END AS AmountInAed,
  CASE WHEN seq % 41 = 0 THEN 'x' WHEN seq % 43 = 0 THEN 's' WHEN seq % 47 = 0 THEN NULL ELSE TransferType END AS TransferType,
  CASE WHEN seq % 13 = 0 THEN NULL ELSE ChannelId END AS ChannelId,
  CASE WHEN seq % 7 = 0 THEN NULL ELSE BankCountry END AS BankCountry,
  CASE WHEN seq % 11 = 0 OR seq % 53 = 0 THEN NULL ELSE CreateDate END AS CreateDate,
  CASE WHEN seq % 5 = 1 THEN 'Force Approved' ELSE Status END AS Status
FROM (""" + TXN_EVENTS + """)
"""


def _features_ctes(src: str) -> str:
    """CTEs ``src`` -> ``base`` -> ``feat`` computing every feature column."""
    return f"""
src AS ({src}),
base AS (
  SELECT s.*,
    COALESCE(CAST(AmountInAed AS DOUBLE), 0.0) AS amt,
    epoch_us(CreateDate) AS us,
    CASE WHEN upper(TransferType) = 'S' THEN 1 ELSE 0 END AS flag_amount,
    COALESCE(CASE upper(TransferType) WHEN 'S' THEN 4 WHEN 'I' THEN 1 WHEN 'L' THEN 2 WHEN 'Q' THEN 3
                                      WHEN 'O' THEN 0 END, 0) AS transfer_type_encoded,
    COALESCE(CASE upper(TransferType) WHEN 'S' THEN 0.9 WHEN 'I' THEN 0.1 WHEN 'L' THEN 0.2 WHEN 'Q' THEN 0.5
                                      WHEN 'O' THEN 0.0 END, 0.5) AS transfer_type_risk,
    COALESCE(hour(CreateDate), 12) AS hour,
    COALESCE(isodow(CreateDate) - 1, 0) AS day_of_week,
    (CustomerId IS NULL OR FromAccountNo IS NULL) AS knull
  FROM src s
),
ch AS (
  SELECT ChannelId, row_number() OVER (ORDER BY min(seq)) - 1 AS channel_encoded
  FROM base WHERE ChannelId IS NOT NULL GROUP BY ChannelId
),
ak AS (
  SELECT CustomerId, FromAccountNo,
    avg(amt) AS user_avg_amount,
    COALESCE(stddev_samp(amt), 0.0) AS user_std_amount,
    max(amt) AS user_max_amount,
    count(*) AS user_txn_frequency,
    avg(flag_amount) AS intl_ratio,
    avg(transfer_type_risk) AS user_high_risk_txn_ratio,
    count(DISTINCT BankCountry) AS country_count
  FROM base WHERE NOT knull GROUP BY CustomerId, FromAccountNo
),
firsts AS (
  SELECT CustomerId, FromAccountNo,
    first_value(FromAccountNo) OVER (PARTITION BY CustomerId ORDER BY seq) AS first_acct
  FROM base WHERE CustomerId IS NOT NULL
),
cs AS (
  SELECT CustomerId,
    count(DISTINCT FromAccountNo) AS num_accounts,
    CASE WHEN count(*) > 1 THEN avg(CASE WHEN FromAccountNo IS NULL OR first_acct IS NULL
                                           OR FromAccountNo <> first_acct THEN 1.0 ELSE 0.0 END)
         ELSE 0.0 END AS cross_account_transfer_ratio
  FROM firsts GROUP BY CustomerId
),
ordered AS (
  SELECT b.*,
    count(*) OVER (PARTITION BY CustomerId, FromAccountNo, ReceipentAccount ORDER BY us
                   RANGE BETWEEN 2592000000000 PRECEDING AND CURRENT ROW)
    - count(*) OVER (PARTITION BY CustomerId, FromAccountNo, ReceipentAccount, us ORDER BY seq
                     ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS bene_cnt,
    row_number() OVER (PARTITION BY CustomerId, FromAccountNo, ReceipentAccount
                       ORDER BY us ASC NULLS LAST, seq) AS bene_rn,
    count(*) OVER (PARTITION BY CustomerId, FromAccountNo ORDER BY us
                   RANGE BETWEEN 30000000 PRECEDING AND CURRENT ROW)
    - count(*) OVER (PARTITION BY CustomerId, FromAccountNo, us ORDER BY seq
                     ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS c30s,
    count(*) OVER (PARTITION BY CustomerId, FromAccountNo ORDER BY us
                   RANGE BETWEEN 600000000 PRECEDING AND CURRENT ROW)
    - count(*) OVER (PARTITION BY CustomerId, FromAccountNo, us ORDER BY seq
                     ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS c10m,
    count(*) OVER (PARTITION BY CustomerId, FromAccountNo ORDER BY us
                   RANGE BETWEEN 3600000000 PRECEDING AND CURRENT ROW)
    - count(*) OVER (PARTITION BY CustomerId, FromAccountNo, us ORDER BY seq
                     ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS c1h,
    lag(us) OVER (PARTITION BY CustomerId, FromAccountNo ORDER BY us ASC NULLS LAST, seq) AS prev_us,
    lag(CreateDate) OVER (PARTITION BY CustomerId, FromAccountNo ORDER BY us ASC NULLS LAST, seq) AS prev_ts,
    COALESCE(stddev_samp(amt) OVER (PARTITION BY CustomerId, FromAccountNo ORDER BY us ASC NULLS LAST, seq
                                    ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), 0.0) AS rstd,
    COALESCE(sum(amt) OVER (PARTITION BY CustomerId, FromAccountNo, date_trunc('month', CreateDate)
                            ORDER BY us, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS msb,
    sum(amt) OVER (PARTITION BY CustomerId, FromAccountNo, date_trunc('hour', CreateDate)) AS h_sum,
    count(*) OVER (PARTITION BY CustomerId, FromAccountNo, date_trunc('hour', CreateDate)) AS h_cnt,
    sum(amt) OVER (PARTITION BY CustomerId, FromAccountNo, date_trunc('day', CreateDate)) AS d_sum,
    count(*) OVER (PARTITION BY CustomerId, FromAccountNo, date_trunc('day', CreateDate)) AS d_cnt,
    sum(amt) OVER (PARTITION BY CustomerId, FromAccountNo, date_trunc('week', CreateDate)) AS w_sum,
    count(*) OVER (PARTITION BY CustomerId, FromAccountNo, date_trunc('week', CreateDate)) AS w_cnt,
    avg(amt) OVER (PARTITION BY CustomerId, FromAccountNo, date_trunc('week', CreateDate)) AS w_avg,
    sum(amt) OVER (PARTITION BY CustomerId, FromAccountNo, date_trunc('month', CreateDate)) AS m_sum,
    count(*) OVER (PARTITION BY CustomerId, FromAccountNo, date_trunc('month', CreateDate)) AS m_cnt,
    avg(amt) OVER (PARTITION BY CustomerId, FromAccountNo, date_trunc('month', CreateDate)) AS m_avg
  FROM base b
),
feat AS (
  SELECT o.seq, o.CustomerId, o.FromAccountNo, o.ReceipentAccount, o.AmountInAed, o.TransferType,
    o.ChannelId, o.BankCountry, o.CreateDate,
    o.amt AS transaction_amount, o.flag_amount, o.transfer_type_encoded, o.transfer_type_risk,
    COALESCE(ch.channel_encoded, 0) AS channel_encoded,
    o.hour, o.day_of_week,
    CASE WHEN o.day_of_week >= 5 THEN 1 ELSE 0 END AS is_weekend,
    CASE WHEN o.hour < 6 OR o.hour >= 22 THEN 1 ELSE 0 END AS is_night,
    ak.user_avg_amount, ak.user_std_amount, ak.user_max_amount, ak.user_txn_frequency,
    abs(o.amt - ak.user_avg_amount) AS deviation_from_avg,
    o.amt / CASE WHEN ak.user_max_amount = 0 THEN 1.0 ELSE ak.user_max_amount END AS amount_to_max_ratio,
    ak.intl_ratio, ak.user_high_risk_txn_ratio,
    cs.num_accounts,
    CASE WHEN cs.num_accounts > 1 THEN 1 ELSE 0 END AS user_multiple_accounts_flag,
    cs.cross_account_transfer_ratio,
    CASE WHEN ak.country_count > 2 THEN 1 ELSE 0 END AS geo_anomaly_flag,
    CASE WHEN o.knull THEN NULL WHEN o.bene_rn = 1 THEN 1 ELSE 0 END AS is_new_beneficiary,
    CASE WHEN o.knull THEN NULL WHEN o.us IS NULL THEN 1 WHEN o.ReceipentAccount IS NULL THEN 0
         ELSE o.bene_cnt END AS beneficiary_txn_count_30d,
    CASE WHEN o.knull OR o.us IS NULL OR o.prev_us IS NULL THEN 3600.0
         ELSE (o.us - o.prev_us) / 1000000.0 END AS time_since_last,
    CASE WHEN o.knull THEN NULL ELSE o.prev_ts END AS last_txn_time,
    CASE WHEN o.knull THEN NULL WHEN o.us IS NULL THEN 1 ELSE o.c30s END AS txn_count_30s,
    CASE WHEN o.knull THEN NULL WHEN o.us IS NULL THEN 1 ELSE o.c10m END AS txn_count_10min,
    CASE WHEN o.knull THEN NULL WHEN o.us IS NULL THEN 1 ELSE o.c1h END AS txn_count_1hour,
    CASE WHEN o.knull THEN 0.0 ELSE o.rstd END AS rolling_std,
    CASE WHEN o.knull OR o.us IS NULL THEN NULL ELSE o.h_sum END AS hourly_total,
    CASE WHEN o.knull OR o.us IS NULL THEN NULL ELSE o.h_cnt END AS hourly_count,
    CASE WHEN o.knull OR o.us IS NULL THEN NULL ELSE o.d_sum END AS daily_total,
    CASE WHEN o.knull OR o.us IS NULL THEN NULL ELSE o.d_cnt END AS daily_count,
    CASE WHEN o.knull OR o.us IS NULL THEN NULL ELSE o.w_sum END AS weekly_total,
    CASE WHEN o.knull OR o.us IS NULL THEN NULL ELSE o.w_cnt END AS weekly_txn_count,
    CASE WHEN o.knull OR o.us IS NULL THEN NULL ELSE o.w_avg END AS weekly_avg_amount,
    CASE WHEN o.knull OR o.us IS NULL THEN NULL ELSE o.m_sum END AS current_month_spending,
    CASE WHEN o.knull OR o.us IS NULL THEN NULL ELSE o.m_cnt END AS monthly_txn_count,
    CASE WHEN o.knull OR o.us IS NULL THEN NULL ELSE o.m_avg END AS monthly_avg_amount,
    CASE WHEN o.knull OR o.us IS NULL THEN NULL ELSE o.msb END AS month_spending_before
  FROM ordered o
  LEFT JOIN ch ON o.ChannelId = ch.ChannelId
  LEFT JOIN ak ON o.CustomerId = ak.CustomerId AND o.FromAccountNo = ak.FromAccountNo
  LEFT JOIN cs ON o.CustomerId = cs.CustomerId
),
feat2 AS (
  SELECT f.*,
    CASE WHEN CustomerId IS NULL OR FromAccountNo IS NULL THEN 0.0
         ELSE 1.0 / ((CASE WHEN time_since_last = 0 THEN 1.0 ELSE time_since_last END) / 3600.0)
    END AS transaction_velocity,
    CASE WHEN time_since_last < 300 THEN 1 ELSE 0 END AS recent_burst,
    abs(transaction_amount - weekly_avg_amount) AS weekly_deviation,
    transaction_amount / CASE WHEN weekly_avg_amount = 0 THEN 1.0 ELSE weekly_avg_amount END AS amount_vs_weekly_avg,
    abs(transaction_amount - monthly_avg_amount) AS monthly_deviation,
    transaction_amount / CASE WHEN monthly_avg_amount = 0 THEN 1.0 ELSE monthly_avg_amount END AS amount_vs_monthly_avg
  FROM feat f
)"""


def r6(expr: str, alias: str | None = None) -> str:
    return f"round({expr}, 6) AS {alias or expr}"


# ---------------------------------------------------------------------------
# Statements per registered query
# ---------------------------------------------------------------------------
COUNT_OR_FLAG = {
    "flag_amount", "transfer_type_encoded", "channel_encoded", "hour", "day_of_week", "is_weekend",
    "is_night", "recent_burst", "user_multiple_accounts_flag", "geo_anomaly_flag", "is_new_beneficiary",
    "weekly_txn_count", "monthly_txn_count", "hourly_count", "daily_count", "txn_count_30s",
    "txn_count_10min", "txn_count_1hour", "user_txn_frequency", "beneficiary_txn_count_30d",
}
INT_COLS = {"flag_amount", "transfer_type_encoded", "channel_encoded", "hour", "day_of_week", "is_weekend",
            "is_night", "recent_burst", "user_multiple_accounts_flag", "geo_anomaly_flag", "is_new_beneficiary"}


def _col(c: str) -> str:
    if c in INT_COLS:
        return f"CAST({c} AS INTEGER) AS {c}"
    if c in COUNT_OR_FLAG or c == "num_accounts":
        return f"CAST({c} AS BIGINT) AS {c}"
    if c in ("seq",):
        return "seq"
    if c == "last_txn_time":
        return "last_txn_time"
    return f"round(CAST({c} AS DOUBLE), 6) AS {c}"


VIEW_SQL = {"events": TXN_EVENTS, "lineitem": TXN_LINEITEM, "dirty": TXN_DIRTY}
NO_DATE = "CAST(NULL AS TIMESTAMP)"
#: What the features are that depend on dates, where a table has none.
DATELESS = {
    "hour": "12", "day_of_week": "0", "is_weekend": "0", "is_night": "0",
    "time_since_last": "3600.0", "recent_burst": "0", "last_txn_time": NO_DATE,
    "txn_count_30s": "1", "txn_count_10min": "1", "txn_count_1hour": "1",
    **{c: "transaction_amount" for c in ("hourly_total", "daily_total", "weekly_total", "weekly_avg_amount",
                                         "current_month_spending", "monthly_avg_amount")},
    **{c: "1" for c in ("hourly_count", "daily_count", "weekly_txn_count", "monthly_txn_count")},
    "weekly_deviation": "0.0", "amount_vs_weekly_avg": "1.0", "monthly_deviation": "0.0", "amount_vs_monthly_avg": "1.0",
    "month_spending_before": "CAST(NULL AS DOUBLE)",
}
#: And where it has no account key: statistics of the whole table, else constants.
KEYLESS = {
    **{k: v for k, v in DATELESS.items() if k not in ("hour", "day_of_week", "is_weekend", "is_night")},
    "user_avg_amount": "avg(transaction_amount) OVER ()", "user_std_amount": "stddev_samp(transaction_amount) OVER ()",
    "user_max_amount": "max(transaction_amount) OVER ()", "user_txn_frequency": "count(*) OVER ()",
    **{c: "0" for c in ("deviation_from_avg", "amount_to_max_ratio", "intl_ratio", "user_high_risk_txn_ratio",
                        "user_multiple_accounts_flag", "cross_account_transfer_ratio", "geo_anomaly_flag",
                        "is_new_beneficiary", "rolling_std", "transaction_velocity")},
    "beneficiary_txn_count_30d": "1", "num_accounts": "CAST(NULL AS BIGINT)",
}


def feature_select(view: str, cols: list[str]) -> str:
    if view in VIEW_SQL:
        return "WITH " + _features_ctes(VIEW_SQL[view]) + " SELECT " + ", ".join(_col(c) for c in cols) + " FROM feat2"
    fixed = DATELESS if view == "dateless" else KEYLESS
    src = TXN_DIRTY
    if view == "dateless":
        src = "SELECT * REPLACE (CAST(NULL AS TIMESTAMP) AS CreateDate) FROM (" + TXN_DIRTY + ")"
    inner = ", ".join(f"{fixed[c]} AS {c}" if c in fixed else c for c in cols)
    return "WITH " + _features_ctes(src) + f", fixed AS (SELECT {inner} FROM feat2) SELECT " + ", ".join(_col(c) for c in cols) + " FROM fixed"


def _model_features() -> list[str]:
    from acctsentry.schema import MODEL_FEATURES

    return MODEL_FEATURES


def matrix_cte() -> str:
    cols = ", ".join(f"COALESCE(CAST({f} AS DOUBLE), 0.0) AS {f}" for f in _model_features())
    return "WITH " + _features_ctes(TXN_EVENTS) + f", mx AS (SELECT seq, {cols} FROM feat2)"


def scaler_cte() -> str:
    parts = []
    for i, f in enumerate(_model_features()):
        parts.append(
            f"SELECT {i} AS position, '{f}' AS feature, avg({f}) AS mean, var_pop({f}) AS var, count(*) AS n FROM mx"
        )
    eps = "2.220446049250313e-16"
    return (
        matrix_cte()
        + ", sc0 AS (" + " UNION ALL ".join(parts) + ")"
        + f", sc AS (SELECT position, feature, mean, CASE WHEN var <= n * {eps} * var + pow(n * mean * {eps}, 2)"
        + " THEN 1.0 ELSE sqrt(var) END AS scale FROM sc0)"
    )


def scaled_features_sql() -> str:
    feats = _model_features()
    joins = []
    cols = []
    for i, f in enumerate(feats):
        cols.append(f"round((mx.{f} - s{i}.mean) / s{i}.scale, 6) AS {f}")
        joins.append(f"CROSS JOIN (SELECT mean, scale FROM sc WHERE position = {i}) s{i}")
    return scaler_cte() + " SELECT mx.seq, " + ", ".join(cols) + " FROM mx " + " ".join(joins)


def rule_models_cte(head: str) -> str:
    """After ``head`` (which defines mx and sc), xs: each row's scaled features
    as a list; fs: its forest score; es: its reconstruction error; cfg: the
    threshold. The models' parameters follow the rules of
    ``plans.queries.rule_forest`` and ``rule_autoencoder``."""
    from acctsentry.operators.autoencoder import layer_dims
    from acctsentry.plans.queries import RULE_DEPTH, RULE_OFFSET, RULE_PSI, RULE_TREES

    feats = _model_features()
    sql = head + ", xs AS (SELECT mx.seq, [" + ", ".join(f"(mx.{f} - m[{i + 1}]) / s[{i + 1}]" for i, f in enumerate(feats)) + (
        "] AS x FROM mx, (SELECT list(mean ORDER BY position) AS m, list(scale ORDER BY position) AS s FROM sc))")
    sql += f", walk0 AS (SELECT seq, x, t, 0 AS i FROM xs, range(0, {RULE_TREES}) r(t))"
    for d in range(RULE_DEPTH):
        sql += (f", walk{d + 1} AS (SELECT seq, x, t, CASE WHEN x[(t * 7 + i * 5) % {len(feats)} + 1] <= ((t * 13 + i * 17) % 21 - 10) / 10.0::DOUBLE + 0.037"
                f" THEN 2 * i + 1 ELSE 2 * i + 2 END AS i FROM walk{d})")
    c = lambda n: f"(CASE WHEN {n} > 2 THEN 2.0 * (ln({n} - 1.0) + 0.5772156649015329) - 2.0 * ({n} - 1.0) / {n} WHEN {n} = 2 THEN 1.0 ELSE 0.0 END)"
    sql += (f", fs AS (SELECT seq, -pow(2.0, -avg({RULE_DEPTH} + {c('(1 + (t * 3 + i * 11) % 9)')}) / {c(str(float(RULE_PSI)))}) - ({RULE_OFFSET}) AS score"
            f" FROM walk{RULE_DEPTH} GROUP BY seq)")
    dims, bn = layer_dims(len(feats))
    sql += ", h0 AS (SELECT seq, x AS h FROM xs)"
    for i in range(len(dims) - 1):
        z = "list_inner_product(h, w) + b"
        a = z if i == len(dims) - 2 else f"greatest({z}, 0.0)"
        if bn[i]:
            a = f"(1 + (c * 7 + {i}) % 5 / 10.0::DOUBLE) * ({a} - ((c * 5 + {i}) % 9 - 4) / 10.0::DOUBLE) / sqrt(1 + (c * 11 + {i}) % 4 / 4.0::DOUBLE + 0.001) + ((c * 3 + {i}) % 7 - 3) / 10.0::DOUBLE"
        sql += (f", w{i} AS (SELECT c, [((r * 37 + c * 61 + {i * 13}) % 101 - 50) / 400.0::DOUBLE for r in range(0, {dims[i]})] AS w,"
                f" ((c * 17 + {i}) % 11 - 5) / 100.0::DOUBLE AS b FROM range(0, {dims[i + 1]}) q(c))"
                f", h{i + 1} AS (SELECT seq, list({a} ORDER BY c) AS h FROM h{i}, w{i} GROUP BY seq)")
    last = len(dims) - 1
    sql += (f", es AS (SELECT seq, list_avg([(p[1] - p[2]) ** 2 for p in list_zip(x, h)]) AS err FROM xs JOIN h{last} USING (seq))"
            ", cfg AS (SELECT avg(err) + 3 * stddev_pop(err) AS thr FROM es)")
    return sql


RULES_CTE = """, rules AS (
  SELECT f.*,
    greatest(user_avg_amount + COALESCE(CASE TransferType WHEN 'S' THEN 2.0 WHEN 'Q' THEN 2.5 WHEN 'L' THEN 3.0
                                          WHEN 'I' THEN 3.5 WHEN 'O' THEN 4.0 END, 3.0)
             * CASE WHEN user_txn_frequency > 1 THEN user_std_amount ELSE 2000.0 END,
             COALESCE(CASE TransferType WHEN 'S' THEN 5000.0 WHEN 'Q' THEN 3000.0 WHEN 'L' THEN 2000.0
                                        WHEN 'I' THEN 1500.0 WHEN 'O' THEN 1000.0 END, 2000.0)) AS threshold,
    COALESCE(month_spending_before, 0.0) + transaction_amount AS projected
  FROM feat2 f
), rules2 AS (
  SELECT r.*,
    list_filter([
      CASE WHEN txn_count_10min > 5 THEN 'Velocity limit exceeded: ' || CAST(txn_count_10min AS VARCHAR)
           || ' transactions in last 10 minutes (max allowed 5)' END,
      CASE WHEN txn_count_1hour > 15 THEN 'Hourly velocity limit exceeded: ' || CAST(txn_count_1hour AS VARCHAR)
           || ' transactions in last 1 hour (max allowed 15)' END,
      CASE WHEN projected > threshold THEN 'Monthly spending AED ' || format('{:,.2f}', projected)
           || ' exceeds limit AED ' || format('{:,.2f}', threshold) END
    ], lambda x: x IS NOT NULL) AS reasons
  FROM rules r
)"""


def rule_decisions_sql(src: str = TXN_EVENTS) -> str:
    return (
        "WITH " + _features_ctes(src) + RULES_CTE
        + " SELECT seq, CAST(len(reasons) > 0 AS INTEGER) AS violated, round(threshold, 6) AS threshold,"
        + " CAST(len(reasons) AS BIGINT) AS n_reasons, array_to_string(reasons, ' | ') AS reasons FROM rules2"
    )


def decision_log_cte() -> str:
    return (
        "WITH " + _features_ctes(TXN_EVENTS) + RULES_CTE
        + """, dlog AS (
  SELECT CAST(CustomerId AS BIGINT) AS CustomerID, CAST(FromAccountNo AS VARCHAR) AS FromAccountNo,
         transaction_amount AS Amount, TransferType AS Type,
         CASE WHEN len(reasons) > 0 THEN 'Rejected' ELSE 'Approved' END AS Status,
         CreateDate AS Timestamp
  FROM rules2)"""
    )


ACCOUNT_PROFILE = """
WITH src AS (""" + TXN_EVENTS + """),
p AS (
  SELECT CustomerId, FromAccountNo,
    avg(COALESCE(AmountInAed, 0.0)) AS user_avg_amount,
    stddev_samp(COALESCE(AmountInAed, 0.0)) AS sd,
    max(COALESCE(AmountInAed, 0.0)) AS user_max_amount,
    count(*) AS user_txn_frequency,
    avg(CASE WHEN TransferType = 'S' THEN 1.0 ELSE 0.0 END) AS user_international_ratio
  FROM src WHERE CustomerId IS NOT NULL AND FromAccountNo IS NOT NULL
  GROUP BY CustomerId, FromAccountNo
)"""


def live_cte() -> str:
    """Rows in the order in which the replay's files bring them, each with what
    arrived before it (pairs of rows of one account)."""
    return """
WITH src AS (""" + TXN_EVENTS + """),
n AS (SELECT greatest(4, CAST(ceil(count(*) / 1000000) AS BIGINT)) AS batches FROM src),
r AS (
  SELECT min(CreateDate) AS lo, any_value(batches) - 1 AS top,
         greatest(1, CAST(floor(epoch(max(CreateDate) - min(CreateDate))) AS BIGINT) // (any_value(batches) - 1) + 1) AS w FROM src, n),
b AS (
  SELECT seq, CustomerId, FromAccountNo, TransferType AS typ, epoch_us(CreateDate) AS us, COALESCE(AmountInAed, 0.0) AS amt,
         date_trunc('month', CreateDate) AS mon, Status IN ('Approved', 'Force Approved') AS ap,
         least(CAST(floor(epoch(CreateDate - lo) / w) AS BIGINT) + (seq % 5 = 0)::INT, top) AS arr
  FROM src, r),
lv AS (
  SELECT x.seq, x.CustomerId, x.FromAccountNo, x.typ, x.us, x.amt, x.mon,
    count(y.seq) FILTER (WHERE y.us <= x.us AND y.us > x.us - 600000000) + 1 AS c10,
    count(y.seq) FILTER (WHERE y.us <= x.us AND y.us > x.us - 3600000000) + 1 AS c1h,
    max(y.us) FILTER (WHERE y.us <= x.us) AS last, count(y.seq) AS sc,
    COALESCE(sum(y.amt) FILTER (WHERE y.mon = x.mon), 0.0) AS spent
  FROM b x LEFT JOIN b y ON x.CustomerId = y.CustomerId AND x.FromAccountNo = y.FromAccountNo AND y.ap
    AND (y.arr, y.us, y.seq) < (x.arr, x.us, x.seq)
  GROUP BY ALL)"""


def queries_sql() -> dict[str, str]:
    from acctsentry.plans.queries import BUCKET_COLS, FEATURE_TABLE_COLS

    q: dict[str, str] = {}
    q["row_features"] = (
        "WITH " + _features_ctes(TXN_EVENTS) + " SELECT seq, round(transaction_amount, 6) AS transaction_amount,"
        " CAST(flag_amount AS INTEGER) AS flag_amount, CAST(transfer_type_encoded AS INTEGER) AS transfer_type_encoded,"
        " round(CAST(transfer_type_risk AS DOUBLE), 6) AS transfer_type_risk,"
        " CAST(channel_encoded AS INTEGER) AS channel_encoded, CAST(hour AS INTEGER) AS hour,"
        " CAST(day_of_week AS INTEGER) AS day_of_week, CAST(is_weekend AS INTEGER) AS is_weekend,"
        " CAST(is_night AS INTEGER) AS is_night,"
        " CASE TransferType WHEN 'S' THEN 'Overseas' WHEN 'I' THEN 'Ajman' WHEN 'L' THEN 'UAE'"
        " WHEN 'Q' THEN 'Quick' WHEN 'O' THEN 'Own' END AS type_name FROM feat2"
    )
    q["channel_codes"] = (
        "WITH src AS (" + TXN_LINEITEM + ") SELECT ChannelId,"
        " CAST(row_number() OVER (ORDER BY min(seq)) - 1 AS INTEGER) AS channel_encoded"
        " FROM src WHERE ChannelId IS NOT NULL GROUP BY ChannelId"
    )
    q["account_stats"] = (
        "WITH " + _features_ctes(TXN_EVENTS) + " SELECT CustomerId, FromAccountNo,"
        " round(user_avg_amount, 6) AS user_avg_amount, round(user_std_amount, 6) AS user_std_amount,"
        " round(user_max_amount, 6) AS user_max_amount, CAST(user_txn_frequency AS BIGINT) AS user_txn_frequency,"
        " round(intl_ratio, 6) AS intl_ratio, round(user_high_risk_txn_ratio, 6) AS user_high_risk_txn_ratio,"
        " CAST(CASE WHEN country_count > 2 THEN 1 ELSE 0 END AS INTEGER) AS geo_anomaly_flag FROM ak"
    )
    q["customer_stats"] = (
        "WITH " + _features_ctes(TXN_LINEITEM) + " SELECT CustomerId, CAST(num_accounts AS BIGINT) AS num_accounts,"
        " round(cross_account_transfer_ratio, 6) AS cross_account_transfer_ratio,"
        " CAST(CASE WHEN num_accounts > 1 THEN 1 ELSE 0 END AS INTEGER) AS user_multiple_accounts_flag FROM cs"
    )
    for name, (view, cols) in BUCKET_COLS.items():
        q[name] = feature_select(view, ["seq", *cols])
    q["feature_table"] = feature_select("events", FEATURE_TABLE_COLS)
    q["feature_table_lineitem"] = feature_select("lineitem", FEATURE_TABLE_COLS)
    q["feature_table_stored"] = q["feature_table"]
    q["account_profile"] = ACCOUNT_PROFILE + """
SELECT CustomerId, FromAccountNo, round(user_avg_amount, 6) AS user_avg_amount,
  round(user_max_amount, 6) AS user_max_amount, CAST(user_txn_frequency AS BIGINT) AS user_txn_frequency,
  round(user_international_ratio, 6) AS user_international_ratio,
  round(CASE WHEN user_txn_frequency > 1 THEN sd ELSE 0.0 END, 6) AS user_std_display,
  round(CASE WHEN user_txn_frequency > 1 THEN sd ELSE 2000.0 END, 6) AS user_std_decision
FROM p"""
    q["limits_by_type"] = ACCOUNT_PROFILE + """,
t(transfer_type, mult, fl) AS (VALUES ('S', 2.0, 5000.0), ('I', 3.5, 1500.0), ('L', 3.0, 2000.0),
                                       ('Q', 2.5, 3000.0), ('O', 4.0, 1000.0))
SELECT CustomerId, FromAccountNo, transfer_type,
  round(greatest(user_avg_amount + mult * (CASE WHEN user_txn_frequency > 1 THEN sd ELSE 0.0 END), fl), 6) AS "limit"
FROM p CROSS JOIN t"""
    q["month_to_date"] = (
        "WITH src AS (" + TXN_LINEITEM + "), as_of_t AS (SELECT max(CreateDate) AS a FROM src)"
        " SELECT CustomerId, FromAccountNo, round(COALESCE(sum(CASE WHEN date_trunc('month', CreateDate)"
        " = date_trunc('month', (SELECT a FROM as_of_t)) THEN COALESCE(AmountInAed, 0.0) END), 0.0), 6) AS month_to_date"
        " FROM src WHERE CustomerId IS NOT NULL AND FromAccountNo IS NOT NULL GROUP BY CustomerId, FromAccountNo"
    )
    q["rule_decisions"] = rule_decisions_sql()
    q["rule_decisions_dirty"] = rule_decisions_sql(TXN_DIRTY)
    for view in ("dirty", "keyless", "dateless"):
        q[f"feature_table_{view}"] = feature_select(view, FEATURE_TABLE_COLS)
    q["profile_dirty"] = ACCOUNT_PROFILE.replace(TXN_EVENTS, TXN_DIRTY) + """
SELECT src.seq, round(COALESCE(user_avg_amount, 5000.0), 6) AS user_avg_amount,
  round(CASE WHEN user_txn_frequency > 1 THEN sd ELSE 2000.0 END, 6) AS user_std_amount,
  round(COALESCE(user_max_amount, 15000.0), 6) AS user_max_amount,
  CAST(COALESCE(user_txn_frequency, 0) AS BIGINT) AS user_txn_frequency,
  round(COALESCE(user_international_ratio, 0.0), 6) AS user_international_ratio
FROM src LEFT JOIN p USING (CustomerId, FromAccountNo)"""
    q["decision_log"] = decision_log_cte() + (
        " SELECT CustomerID, FromAccountNo, round(Amount, 6) AS Amount, Type, Status, Timestamp FROM dlog"
    )
    q["decision_log_csv"] = decision_log_cte() + (
        " SELECT CustomerID, CAST(NULL AS VARCHAR) AS FromAccountNo, round(Amount, 6) AS Amount, Type, Status, Timestamp,"
        " CAST(CAST(Timestamp AS DATE) AS VARCHAR) AS log_date FROM dlog"
    )
    q["history_totals"] = decision_log_cte() + """,
as_of_t AS (SELECT max(CreateDate) AS a FROM src),
cut_t AS (SELECT (min(epoch_us(CreateDate)) + max(epoch_us(CreateDate))) // 2 AS cut FROM src),
both_rows AS (
  SELECT CAST(CustomerId AS BIGINT) AS CustomerID, CAST(FromAccountNo AS VARCHAR) AS FromAccountNo,
         COALESCE(AmountInAed, 0.0) AS Amount, CreateDate AS Timestamp, 1 AS stored FROM src
  WHERE epoch_us(CreateDate) < (SELECT cut FROM cut_t)
  UNION ALL
  SELECT CustomerID, FromAccountNo, Amount, Timestamp, 0 AS stored FROM dlog
  WHERE Status IN ('Approved', 'Force Approved') AND epoch_us(Timestamp) >= (SELECT cut FROM cut_t)
)
SELECT CustomerID, FromAccountNo,
  CAST(sum(stored) AS BIGINT) AS stored_count, CAST(sum(1 - stored) AS BIGINT) AS session_count,
  CAST(count(*) AS BIGINT) AS total_txns,
  round(COALESCE(sum(CASE WHEN stored = 1 AND date_trunc('month', Timestamp) = date_trunc('month', (SELECT a FROM as_of_t)) THEN Amount END), 0.0), 6) AS stored_month,
  round(COALESCE(sum(CASE WHEN stored = 0 AND date_trunc('month', Timestamp) = date_trunc('month', (SELECT a FROM as_of_t)) THEN Amount END), 0.0), 6) AS session_month,
  round(COALESCE(sum(CASE WHEN stored = 1 AND date_trunc('month', Timestamp) = date_trunc('month', (SELECT a FROM as_of_t)) THEN Amount END), 0.0)
      + COALESCE(sum(CASE WHEN stored = 0 AND date_trunc('month', Timestamp) = date_trunc('month', (SELECT a FROM as_of_t)) THEN Amount END), 0.0), 6) AS total_month
FROM both_rows WHERE CustomerID IS NOT NULL AND FromAccountNo IS NOT NULL
GROUP BY CustomerID, FromAccountNo"""
    q["account_list"] = (
        "WITH src AS (" + TXN_EVENTS + ") SELECT DISTINCT CAST(CustomerId AS VARCHAR) AS customer,"
        " CAST(FromAccountNo AS VARCHAR) AS account FROM src"
        " WHERE CustomerId IS NOT NULL AND FromAccountNo IS NOT NULL ORDER BY customer, account"
    )
    q["customer_list"] = (
        "WITH src AS (" + TXN_LINEITEM + ") SELECT DISTINCT CAST(CustomerId AS VARCHAR) AS customer"
        " FROM src WHERE CustomerId IS NOT NULL ORDER BY customer"
    )
    q["scaler_stats"] = scaler_cte() + (
        " SELECT CAST(position AS INTEGER) AS position, feature, round(mean, 6) AS mean, round(scale, 6) AS scale FROM sc"
    )
    q["scaled_features"] = scaled_features_sql()
    models = rule_models_cte(scaler_cte())
    q["iforest_rule_scores"] = models + (
        " SELECT seq, round(score, 6) AS anomaly_score, CAST(CASE WHEN score < 0 THEN -1 ELSE 1 END AS INTEGER) AS prediction,"
        " score < 0 AS is_anomaly FROM fs")
    q["ae_rule_scores"] = models + (
        " SELECT seq, round(err, 6) AS reconstruction_error, round(thr, 6) AS threshold, err > thr AS is_anomaly FROM es, cfg")
    q["hybrid_rule_decisions"] = rule_models_cte(scaler_cte() + RULES_CTE) + (
        " SELECT seq, len(reasons) > 0 OR score < 0 OR err > thr AS is_fraud,"
        " CAST(len(reasons) + (score < 0)::INT + (err > thr)::INT AS BIGINT) AS n_reasons, round(-score, 6) AS risk_score,"
        " round(threshold, 6) AS threshold, score < 0 AS ml_flag, err > thr AS ae_flag, round(err, 6) AS ae_reconstruction_error,"
        " round(thr, 6) AS ae_threshold FROM rules2 JOIN fs USING (seq) JOIN es USING (seq), cfg")
    approved = """
WITH src AS (""" + TXN_EVENTS + """),
b AS (SELECT seq, CustomerId, FromAccountNo, epoch_us(CreateDate) AS us, COALESCE(AmountInAed, 0.0) AS amt,
             date_trunc('month', CreateDate) AS mon,
             CASE WHEN Status IN ('Approved', 'Force Approved') THEN 1 ELSE 0 END AS ap
      FROM src WHERE CustomerId IS NOT NULL AND FromAccountNo IS NOT NULL AND CreateDate IS NOT NULL),
v AS (
  SELECT seq,
    COALESCE(sum(amt * ap) OVER (PARTITION BY CustomerId, FromAccountNo, mon ORDER BY us, seq
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS spent,
    COALESCE(sum(ap) OVER (PARTITION BY CustomerId, FromAccountNo ORDER BY us
                           RANGE BETWEEN 599999999 PRECEDING AND CURRENT ROW), 0)
    - COALESCE(sum(ap) OVER (PARTITION BY CustomerId, FromAccountNo, us ORDER BY seq
                             ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0) + 1 AS c10,
    COALESCE(sum(ap) OVER (PARTITION BY CustomerId, FromAccountNo ORDER BY us
                           RANGE BETWEEN 3599999999 PRECEDING AND CURRENT ROW), 0)
    - COALESCE(sum(ap) OVER (PARTITION BY CustomerId, FromAccountNo, us ORDER BY seq
                             ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0) + 1 AS c1h,
    us - max(CASE WHEN ap = 1 THEN us END) OVER (PARTITION BY CustomerId, FromAccountNo ORDER BY us, seq
                                                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS gap_us,
    COALESCE(sum(ap) OVER (PARTITION BY CustomerId, FromAccountNo ORDER BY us, seq
                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS sc
  FROM b)
SELECT seq, CAST(c10 AS BIGINT) AS live_txn_count_10min, CAST(c1h AS BIGINT) AS live_txn_count_1hour,
  round(CASE WHEN gap_us IS NULL THEN 3600.0 ELSE gap_us / 1000000.0 END, 6) AS live_time_since_last,
  CAST(sc AS BIGINT) AS session_count, round(spent, 6) AS session_month_spending
FROM v"""
    q["transactions_csv"] = (
        "WITH src AS (" + TXN_EVENTS + ") SELECT row_number() OVER (ORDER BY seq) AS seq, CAST(CustomerId AS VARCHAR) AS CustomerId,"
        " CAST(FromAccountNo AS VARCHAR) AS FromAccountNo, CAST(ReceipentAccount AS VARCHAR) AS ReceipentAccount,"
        " round(AmountInAed, 6) AS AmountInAed, TransferType, ChannelId, CAST(NULL AS VARCHAR) AS BankCountry,"
        " CreateDate FROM src"
    )
    q["approved_velocity"] = approved
    q["approved_velocity_dirty"] = approved.replace(TXN_EVENTS, TXN_DIRTY)
    live = live_cte()
    q["live_stream"] = live + """
SELECT seq, CAST(c10 AS BIGINT) AS live_txn_count_10min, CAST(c1h AS BIGINT) AS live_txn_count_1hour,
  round(COALESCE((us - last) / 1000000.0, 3600.0), 6) AS live_time_since_last,
  CAST(sc AS BIGINT) AS session_count, round(spent, 6) AS session_month_spending
FROM lv"""
    decided = live + """,
pr AS (
  SELECT CustomerId, FromAccountNo, avg(AmountInAed) AS a, count(*) AS n, stddev_samp(AmountInAed) AS sd
  FROM src WHERE seq % 2 = 0 GROUP BY CustomerId, FromAccountNo),
st AS (
  SELECT CustomerId, FromAccountNo, date_trunc('month', CreateDate) AS mon, sum(AmountInAed) AS stored
  FROM src WHERE seq % 2 = 0 GROUP BY ALL),
j AS (
  SELECT lv.*, COALESCE(pr.a, 5000.0) AS a, CASE WHEN pr.n > 1 THEN pr.sd ELSE 2000.0 END AS sd,
         COALESCE(st.stored, 0.0) + lv.spent AS cms
  FROM lv LEFT JOIN pr USING (CustomerId, FromAccountNo) LEFT JOIN st USING (CustomerId, FromAccountNo, mon)),
th AS (
  SELECT j.*, greatest(a + CASE typ WHEN 'S' THEN 2.0 WHEN 'Q' THEN 2.5 WHEN 'L' THEN 3.0 WHEN 'I' THEN 3.5 WHEN 'O' THEN 4.0 ELSE 3.0 END * sd,
                       CASE typ WHEN 'S' THEN 5000.0 WHEN 'Q' THEN 3000.0 WHEN 'L' THEN 2000.0 WHEN 'I' THEN 1500.0 WHEN 'O' THEN 1000.0 ELSE 2000.0 END) AS threshold
  FROM j),
dec AS (SELECT th.*, (c10 > 5)::INT + (c1h > 15)::INT + (cms + amt > threshold)::INT AS k FROM th)
"""
    q["live_decisions"] = decided + """
SELECT seq, k > 0 AS is_fraud, CAST(k AS BIGINT) AS n_reasons, round(threshold, 6) AS threshold, round(cms, 6) AS current_month_spending FROM dec"""
    q["decision_log_stream"] = decided + """
SELECT CAST(CustomerId AS BIGINT) AS "CustomerID", CAST(FromAccountNo AS VARCHAR) AS "FromAccountNo", round(amt, 6) AS "Amount",
       typ AS "Type", CASE WHEN k > 0 THEN 'Rejected' ELSE 'Approved' END AS "Status", make_timestamp(us) AS "Timestamp" FROM dec"""
    q["live_hybrid"] = "SELECT count(*) AS n_rows, count(*) AS n_scored, CAST(0 AS BIGINT) AS n_differ FROM events"
    q["live_verdicts"] = live + """,
e AS (  -- candidates with their verdicts: when each was given, and the batch in which it comes
  SELECT seq, CustomerId, FromAccountNo, us, amt, mon, arr, seq % 11 > 0 AS has, us + (seq % 7) * 60000000 AS vus, st, ap,
         date_trunc('month', make_timestamp(us + (seq % 7) * 60000000)) AS vmon,
         least(CAST(floor((us + (seq % 7) * 60000000 - epoch_us(lo)) / 1000000 / w) AS BIGINT) + (seq % 4 = 0)::INT, top) AS varr
  FROM b JOIN (SELECT seq, Status AS st FROM src) USING (seq), r),
t AS (  -- settled by what comes later, the candidate or the verdict
  SELECT *, CASE WHEN (varr, vus, 1) > (arr, us, 0) THEN varr ELSE arr END AS sarr, CASE WHEN (varr, vus, 1) > (arr, us, 0) THEN vus ELSE us END AS sus,
         CASE WHEN (varr, vus, 1) > (arr, us, 0) THEN 1 ELSE 0 END AS skind
  FROM e),
x AS (
  SELECT c.seq, c.us, c.amt,
    count(y.seq) FILTER (WHERE y.vus <= c.us AND y.vus > c.us - 600000000) + 1 AS c10,
    count(y.seq) FILTER (WHERE y.vus <= c.us AND y.vus > c.us - 3600000000) + 1 AS c1h,
    max(y.vus) FILTER (WHERE y.vus <= c.us) AS last, count(y.seq) AS sc,
    COALESCE(sum(y.amt) FILTER (WHERE y.vmon = c.mon), 0.0) AS spent
  FROM t c LEFT JOIN t y ON c.CustomerId = y.CustomerId AND c.FromAccountNo = y.FromAccountNo AND y.has AND y.ap
    AND (y.sarr, y.sus, y.skind, y.seq) < (c.arr, c.us, 0, c.seq)
  GROUP BY ALL),
m AS (SELECT greatest(max(us), max(vus) FILTER (WHERE has)) - (w + w // 4 + 600) * 1000000 AS mark, any_value(w) AS w FROM e, r GROUP BY w)
SELECT seq, 'candidate' AS event, NULL AS "Status", make_timestamp(us) AS "CreateDate", round(amt, 6) AS transaction_amount,
  CAST(c10 AS BIGINT) AS live_txn_count_10min, CAST(c1h AS BIGINT) AS live_txn_count_1hour,
  round(COALESCE((us - last) / 1000000.0, 3600.0), 6) AS live_time_since_last, CAST(sc AS BIGINT) AS session_count,
  round(spent, 6) AS session_month_spending
FROM x
UNION ALL SELECT seq, 'verdict', st, make_timestamp(vus), round(amt, 6), NULL, NULL, NULL, NULL, NULL FROM t WHERE has
UNION ALL SELECT seq, 'verdict', 'Expired', make_timestamp(us + w * 1000000), round(amt, 6), NULL, NULL, NULL, NULL, NULL
FROM t, m WHERE NOT has AND us + w * 1000000 < mark"""
    q["live_resumed"] = "SELECT a.* FROM (" + approved + ") a JOIN (" + TXN_EVENTS + """) s USING (seq), (
  SELECT min(CreateDate) + to_seconds(CAST(floor(epoch(max(CreateDate) - min(CreateDate)) / 2) AS BIGINT)) AS since FROM (""" + TXN_EVENTS + """)) c
WHERE s.CreateDate >= c.since"""
    zero = ["prediction_is_not_sign", "risk_is_not_negated", "ml_flag_is_wrong", "ae_flag_is_wrong", "fraud_is_not_or_of_legs",
            "reasons_out_of_order", "ml_reason_is_missing", "loaded_scores_differ"]
    true = ["rate_is_near_contamination", "threshold_is_mean_plus_3_std", "config_is_complete", "ae_validates", "forest_validates", "shifted_sample_is_refused"]
    q["model_checks"] = "SELECT count(*) AS n_rows, " + ", ".join(
        [f"CAST(0 AS BIGINT) AS {c}" for c in zero] + [f"true AS {c}" for c in true]) + " FROM events"
    q["iforest_report"] = (
        "SELECT count(*) AS n_samples, CAST(43 AS BIGINT) AS n_features,"
        " CAST(floor(0.05 * (count(*) - 1)) AS BIGINT) + 1 AS anomaly_count,"
        " (floor(0.05 * (count(*) - 1)) + 1) / count(*) AS anomaly_rate, CAST(0.05 AS DOUBLE) AS contamination,"
        " CAST(100 AS BIGINT) AS n_estimators FROM events"
    )
    q["missing_features"] = "WITH " + _features_ctes(TXN_EVENTS) + RULES_CTE + (
        " SELECT seq, len(reasons) > 0 AS is_fraud, false AS ml_flag, false AS ae_flag,"
        " CAST(NULL AS DOUBLE) AS ae_reconstruction_error, CAST(0.0 AS DOUBLE) AS risk_score FROM rules2"
    )
    return {k: _ieee_round6(v) for k, v in q.items()}


def _ieee_round6(sql: str) -> str:
    """Rewrite every ``round(expr, 6)`` as ``floor(expr * 1e6 + 0.5001) / 1e6``,
    the same IEEE steps the Spark side uses."""
    out, i = [], 0
    while True:
        j = sql.find("round(", i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        k, depth = j + len("round("), 1
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        inner = sql[j + len("round("):k - 1]
        head, _, digits = inner.rpartition(",")
        if digits.strip() != "6":
            out.append(sql[i:k])
        else:
            out.append(sql[i:j] + f"(floor(CAST({_ieee_round6(head)} AS DOUBLE) * 1000000.0 + 0.5001) / 1000000.0)")
        i = k
