"""Feature operators: hand-made boundary cases, the chunked windows against a
naive positional loop, and the whole table against the DuckDB statement."""

from __future__ import annotations

import datetime as dt
import random

import duckdb
import numpy as np
import pandas as pd
import pytest

from acctsentry import schema as S
from acctsentry.operators import features as FE
from tests.conftest import SF_SMALL
from tests.helpers import naive_ordered, rows_df


def feats(spark, rows):
    return FE.feature_table(rows_df(spark, rows)).toPandas().sort_values("seq").reset_index(drop=True)


def base(seq, **kw):
    r = {"seq": seq, "CustomerId": "c1", "FromAccountNo": "a1", "ReceipentAccount": "b1",
         "AmountInAed": "100", "TransferType": "O", "ChannelId": "X", "BankCountry": "AE",
         "CreateDate": "2024-01-02 10:00:00"}
    r.update(kw)
    return r


def test_type_codes_and_amount_coercion(spark):
    f = feats(spark, [
        base(1, TransferType=None, AmountInAed="abc"),
        base(2, TransferType="x", AmountInAed=None),
        base(3, TransferType="s", AmountInAed="12.5"),
    ])
    assert f["transfer_type_encoded"].tolist() == [0, 0, 4]
    assert f["transfer_type_risk"].tolist() == [0.5, 0.5, 0.9]
    assert f["flag_amount"].tolist() == [0, 0, 1]
    assert f["transaction_amount"].tolist() == [0.0, 0.0, 12.5]


def test_invalid_date_defaults(spark):
    f = feats(spark, [base(1, CreateDate="not a date"), base(2, CreateDate="2024-01-02 10:00:00")])
    r = f.iloc[0]
    assert (r["hour"], r["day_of_week"], r["txn_count_10min"], r["txn_count_1hour"]) == (12, 0, 1, 1)
    assert pd.isna(r["hourly_total"]) and pd.isna(r["weekly_total"]) and pd.isna(r["current_month_spending"])


def test_clock_fields(spark):
    f = feats(spark, [
        base(1, CreateDate="2024-01-07 05:00:00"), base(2, CreateDate="2024-01-07 06:00:00", FromAccountNo="a2"),
        base(3, CreateDate="2024-01-07 21:00:00", FromAccountNo="a3"),
        base(4, CreateDate="2024-01-07 22:00:00", FromAccountNo="a4"),
    ])
    assert f["day_of_week"].tolist() == [6, 6, 6, 6]
    assert f["is_weekend"].tolist() == [1, 1, 1, 1]
    assert f["is_night"].tolist() == [1, 0, 0, 1]


def test_one_row_account(spark):
    f = feats(spark, [base(1)])
    r = f.iloc[0]
    assert r["user_std_amount"] == 0 and r["rolling_std"] == 0
    assert r["time_since_last"] == 3600 and r["transaction_velocity"] == 1.0


def test_gaps_and_bursts(spark):
    f = feats(spark, [
        base(1, CreateDate="2024-01-02 10:00:00"), base(2, CreateDate="2024-01-02 10:00:00"),
        base(3, CreateDate="2024-01-02 10:04:59"), base(4, CreateDate="2024-01-02 10:09:59"),
    ])
    assert f["time_since_last"].tolist() == [3600.0, 0.0, 299.0, 300.0]
    assert f["recent_burst"].tolist() == [0, 1, 1, 0]
    assert f["transaction_velocity"].tolist()[1] == 3600.0


def test_closed_window_and_ties(spark):
    f = feats(spark, [
        base(1, CreateDate="2024-01-02 10:00:00"), base(2, CreateDate="2024-01-02 10:10:00"),
        base(3, CreateDate="2024-01-03 09:00:00"), base(4, CreateDate="2024-01-03 09:00:00"),
        base(5, CreateDate="2024-01-03 09:00:00"),
    ])
    assert f["txn_count_10min"].tolist()[:2] == [1, 2]
    assert f["txn_count_30s"].tolist()[2:] == [1, 2, 3]


def test_beneficiary_history(spark):
    f = feats(spark, [
        base(1, ReceipentAccount="A", CreateDate="2024-01-01 00:00:00"),
        base(2, ReceipentAccount="B", CreateDate="2024-01-02 00:00:00"),
        base(3, ReceipentAccount="A", CreateDate="2024-01-31 00:00:00"),
        base(4, ReceipentAccount="A", CreateDate="2024-02-01 00:00:00"),
    ])
    assert f["is_new_beneficiary"].tolist() == [1, 1, 0, 0]
    assert f["beneficiary_txn_count_30d"].tolist() == [1, 1, 2, 2]


def test_cross_account_and_geo(spark):
    f = feats(spark, [
        base(1, FromAccountNo="a", BankCountry="X"), base(2, FromAccountNo="b"),
        base(3, FromAccountNo="a", BankCountry="Y"), base(4, FromAccountNo="c"),
        base(5, FromAccountNo="a", BankCountry="Z"),
    ])
    assert f["num_accounts"].tolist() == [3] * 5
    assert f["user_multiple_accounts_flag"].tolist() == [1] * 5
    assert f["cross_account_transfer_ratio"].iloc[0] == pytest.approx(0.4)
    f2 = feats(spark, [base(1, FromAccountNo="a"), base(2, FromAccountNo="b"),
                       base(3, FromAccountNo="a"), base(4, FromAccountNo="c")])
    assert f2["cross_account_transfer_ratio"].iloc[0] == pytest.approx(0.5)
    # account a has 3 countries -> geo flag 1; two countries -> 0
    assert f.loc[f["FromAccountNo"] == "a", "geo_anomaly_flag"].tolist() == [1, 1, 1]
    g = feats(spark, [base(1, BankCountry="X"), base(2, BankCountry="Y")])
    assert g["geo_anomaly_flag"].tolist() == [0, 0]


def test_null_account_key(spark):
    f = feats(spark, [base(1, FromAccountNo=None), base(2)])
    r = f.iloc[0]
    assert pd.isna(r["user_avg_amount"]) and pd.isna(r["txn_count_10min"])
    assert r["time_since_last"] == 3600 and r["rolling_std"] == 0 and r["transaction_velocity"] == 0
    assert r["num_accounts"] == 1 and r["geo_anomaly_flag"] == 0


def _random_rows(seed: int, n: int):
    rng = random.Random(seed)
    start = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        acct = rng.choice(["a1", "a2", "a3"])
        # bursts near midnight and quiet gaps of days: chunk boundaries and carries
        day = rng.choice([0, 0, 1, 1, 2, 5, 9, 40])
        sec = rng.choice([86399, 86398, 86340, 0, 1, 30, 3599, 3600, rng.randrange(86400)])
        t = start + dt.timedelta(days=day, seconds=sec % 86400)
        rows.append(dict(seq=i, CustomerId="c", FromAccountNo=acct, ReceipentAccount=rng.choice(["A", "B", None]),
                         AmountInAed=str(rng.randrange(1, 500)), TransferType="S",
                         CreateDate=None if rng.random() < 0.03 else t.isoformat(sep=" ")))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_chunked_windows_match_positional_loop(spark, seed):
    rows = _random_rows(seed, 400)
    got = feats(spark, rows)
    pdf = pd.DataFrame(rows)
    pdf["CreateDate"] = pd.to_datetime(pdf["CreateDate"])
    pdf["amt"] = pdf["AmountInAed"].astype(float)
    want = naive_ordered(pdf).sort_values("seq").reset_index(drop=True)
    for c in ["txn_count_30s", "txn_count_10min", "txn_count_1hour", "time_since_last",
              "is_new_beneficiary", "beneficiary_txn_count_30d"]:
        assert got[c].astype(float).tolist() == want[c].astype(float).tolist(), c
    assert np.allclose(got["rolling_std"], want["rolling_std"], rtol=1e-9, atol=1e-9)


def test_feature_table_matches_oracle_sf0001(spark):
    from acctsentry.plans import oracle as O
    from acctsentry.plans.queries import FEATURE_TABLE_COLS, q_feature_table

    got = q_feature_table(spark, SF_SMALL).toPandas()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{SF_SMALL}/events.parquet'")
    want = con.execute(O.queries_sql()["feature_table"]).df()
    got = got.sort_values("seq").reset_index(drop=True)
    want = want.sort_values("seq").reset_index(drop=True)
    assert len(got) == len(want) > 0
    for c in FEATURE_TABLE_COLS:
        if c == "last_txn_time":
            assert (pd.to_datetime(got[c]).fillna(pd.Timestamp(0)) == pd.to_datetime(want[c]).fillna(pd.Timestamp(0))).all()
        else:
            assert np.allclose(got[c].astype(float), want[c].astype(float), equal_nan=True, rtol=0, atol=0), c
    assert list(got.columns) == FEATURE_TABLE_COLS


def test_model_matrix_has_43_features(spark):
    m = FE.model_matrix(FE.feature_table(rows_df(spark, [base(1), base(2)])))
    assert m.columns == ["seq", *S.MODEL_FEATURES] and len(S.MODEL_FEATURES) == 43


def test_hot_day_is_cut_into_hours(spark, monkeypatch):
    """An account with very many rows on one day spreads over tasks, and its
    rows come out as those of the positional loop do."""
    rng = np.random.default_rng(11)
    times = [pd.Timestamp("2024-03-04 23:30:00") + pd.Timedelta(seconds=int(s)) for s in np.sort(rng.integers(0, 26 * 3600, 900))]
    rows = [{"seq": str(i), "CustomerId": "1", "FromAccountNo": "10", "ReceipentAccount": f"b{i % 7}", "AmountInAed": str(i % 13 * 10.0),
             "TransferType": "S", "ChannelId": "C", "BankCountry": "B", "CreateDate": str(t)} for i, t in enumerate(times)]
    rows += [dict(r, seq=str(2000 + k), FromAccountNo="20", CreateDate=str(pd.Timestamp("2024-03-05") + pd.Timedelta(minutes=37 * k))) for k, r in enumerate(rows[:30])]
    df = rows_df(spark, [dict(r, seq=int(r["seq"])) for r in rows])
    plain = FE.feature_table(df).orderBy(S.SEQ).toPandas()
    monkeypatch.setattr(FE, "HOT_DAY_ROWS", 100)
    keyed = FE.with_chunks(FE.prepare(df)).checkpoint(eager=True)
    chunks = keyed.groupBy("FromAccountNo", "_c").count().collect()
    assert sum(r["FromAccountNo"] == "10" for r in chunks) >= 24 and max(r["count"] for r in chunks) < 120
    assert sum(r["FromAccountNo"] == "20" for r in chunks) == 1
    cut = FE.feature_table(df).orderBy(S.SEQ).toPandas()
    pd.testing.assert_frame_equal(plain, cut, check_exact=False, rtol=1e-12)
    pdf = pd.DataFrame({"seq": [int(r["seq"]) for r in rows], **{c: [r[c] for r in rows] for c in ("CustomerId", "FromAccountNo", "ReceipentAccount")},
                        "CreateDate": [pd.Timestamp(r["CreateDate"]) for r in rows], "amt": [float(r["AmountInAed"]) for r in rows]})
    want = naive_ordered(pdf).sort_values("seq").reset_index(drop=True)
    for c in ("txn_count_30s", "txn_count_10min", "txn_count_1hour", "time_since_last", "rolling_std"):
        assert np.allclose(cut[c].astype(float), want[c].astype(float)), c
    before = pdf.sort_values(["FromAccountNo", "CreateDate", "seq"]).groupby("FromAccountNo")["amt"].transform(lambda a: a.cumsum() - a)
    assert np.allclose(cut["month_spending_before"], before.loc[pdf.sort_values("seq").index])


def test_hot_accounts_in_chunks(spark, monkeypatch):
    """An account whose rows are dealt over chunks of time has the features of one that a task holds, next to it."""
    import random

    rnd, rows = random.Random(5), []
    for i in range(600):
        at = f"2024-0{rnd.randint(1, 9)}-{rnd.randint(1, 3):02d} {rnd.choice((0, 11, 23))}:{rnd.randint(0, 59):02d}:{rnd.choice((0, 30)):02d}"
        rows.append({"seq": i, "CustomerId": str(i % 3), "FromAccountNo": str(i % 3 * 10), "AmountInAed": str(rnd.randint(1, 99)),
                     "ReceipentAccount": rnd.choice((None, "1", "2", "3")), "TransferType": rnd.choice("SQLIO"), "BankCountry": f"B{i % 4}",
                     "CreateDate": None if i % 50 == 0 else at})
    rows += rows[:20]  # rows may come twice
    df = rows_df(spark, [r for r in rows if r["CustomerId"] != "2" or r["seq"] < 30])
    plain = FE.feature_table(df).orderBy(S.SEQ, "is_new_beneficiary", "time_since_last", "month_spending_before", "rolling_std").toPandas()
    monkeypatch.setattr(FE, "HOT_ACCOUNT_ROWS", 100)
    cut = FE.feature_table(df).orderBy(S.SEQ, "is_new_beneficiary", "time_since_last", "month_spending_before", "rolling_std").toPandas()
    import pandas as pd

    pd.testing.assert_frame_equal(plain, cut, rtol=1e-12, check_dtype=False)


def test_one_exchange_of_the_rows(spark):
    """The rows of accounts that a task can hold are shuffled once, and sorted where they lie."""
    rows = [{"seq": i, "CustomerId": "1", "FromAccountNo": "10", "AmountInAed": "5", "CreateDate": "2024-01-01 10:00:00"} for i in range(3)]
    p = FE.prepare_narrow(rows_df(spark, rows))
    accounts = FE.account_stats(FE.with_row_features(p)).join(FE.customer_stats(p).drop("_n_c"), S.CUSTOMER, "left").checkpoint(eager=True)
    had = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = FE.account_pass(p.checkpoint(), accounts)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", had)
    assert plan.count("Exchange hashpartitioning") == 2  # of the rows, and of the accounts that meet them
    assert "ObjectHashAggregate" not in plan
