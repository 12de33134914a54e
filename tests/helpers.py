"""Small hand-made transfer tables and a naive positional oracle."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd
from pyspark.sql import types as T

RAW_TEXT = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("CustomerId", T.StringType()),
    T.StructField("FromAccountNo", T.StringType()),
    T.StructField("ReceipentAccount", T.StringType()),
    T.StructField("AmountInAed", T.StringType()),
    T.StructField("TransferType", T.StringType()),
    T.StructField("ChannelId", T.StringType()),
    T.StructField("BankCountry", T.StringType()),
    T.StructField("CreateDate", T.StringType()),
])


def rows_df(spark, rows):
    """rows: dicts with any of the raw columns (text values)."""
    full = [tuple(r.get(f.name) for f in RAW_TEXT.fields) for r in rows]
    return spark.createDataFrame(full, RAW_TEXT)


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def naive_ordered(pdf: pd.DataFrame) -> pd.DataFrame:
    """Per account, rows in (time nulls last, seq) order, then the reference's
    positional loops: earlier rows within the window plus the row itself."""
    out = []
    for _, g in pdf.sort_values(["seq"]).groupby(["CustomerId", "FromAccountNo"], sort=False):
        g = g.assign(_nat=g["CreateDate"].isna()).sort_values(["_nat", "CreateDate", "seq"], kind="stable")
        times = g["CreateDate"].tolist()
        amts = g["amt"].tolist()
        benes = g["ReceipentAccount"].tolist()
        prev = None
        seen = set()
        for i, (seq, t) in enumerate(zip(g["seq"], times)):
            rec = {"seq": seq}
            for w, name in ((30, "txn_count_30s"), (600, "txn_count_10min"), (3600, "txn_count_1hour")):
                if pd.isna(t):
                    rec[name] = 1
                else:
                    start = t - pd.Timedelta(seconds=w)
                    rec[name] = sum(1 for u in times[:i] if not pd.isna(u) and start <= u <= t) + 1
            if i == 0 or pd.isna(t) or pd.isna(times[i - 1]):
                rec["time_since_last"] = 3600.0
            else:
                rec["time_since_last"] = (t - times[i - 1]).total_seconds()
            window = amts[max(0, i - 4): i + 1]
            rec["rolling_std"] = float(np.std(window, ddof=1)) if len(window) > 1 else 0.0
            b = benes[i]
            rec["is_new_beneficiary"] = int(b not in seen)
            seen.add(b)
            if pd.isna(t):
                rec["beneficiary_txn_count_30d"] = 1
            elif b is None:
                rec["beneficiary_txn_count_30d"] = 0
            else:
                start = t - pd.Timedelta(days=30)
                rec["beneficiary_txn_count_30d"] = sum(
                    1 for u, bb in zip(times[: i + 1], benes[: i + 1]) if not pd.isna(u) and u >= start and bb == b
                )
            out.append(rec)
    return pd.DataFrame(out)
