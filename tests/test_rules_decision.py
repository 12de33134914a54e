"""Limits, velocity and monthly rules, and the combined decision."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from acctsentry.functions import rules as R
from acctsentry.operators import decision as D


def one(spark, cols):
    return spark.range(1).select(*cols).first()


def test_limits(spark):
    r = one(spark, [R.type_limit(F.lit(5000.0), F.lit(2000.0), F.lit(t)).alias(t) for t in "SQLIOX"])
    assert [r[t] for t in "SQLIOX"] == [9000, 10000, 11000, 12000, 13000, 11000]
    r = one(spark, [R.type_limit(F.lit(0.0), F.lit(0.0), F.lit(t)).alias(t) for t in "SQLIOX"])
    assert [r[t] for t in "SQLIOX"] == [5000, 3000, 2000, 1500, 1000, 2000]
    m = one(spark, [R.all_limits(F.lit(5000.0), F.lit(2000.0)).alias("m")])["m"]
    assert [x["transfer_type"] for x in m] == ["S", "I", "L", "Q", "O"]
    assert [x["limit"] for x in m] == [9000, 12000, 11000, 10000, 13000]


def check(spark, c10, c1h, spend, amount=100.0, avg=0.0, std=0.0, t="O"):
    return one(spark, [R.rule_check(F.lit(amount), F.lit(avg), F.lit(std), F.lit(t), F.lit(c10), F.lit(c1h),
                                    F.lit(spend)).alias("r")])["r"]


def test_velocity_rules(spark):
    assert not check(spark, 5, 15, 0.0)["violated"]
    r = check(spark, 6, 15, 0.0)
    assert r["violated"] and r["reasons"] == [
        "Velocity limit exceeded: 6 transactions in last 10 minutes (max allowed 5)"]
    r = check(spark, 5, 16, 0.0)
    assert r["reasons"] == ["Hourly velocity limit exceeded: 16 transactions in last 1 hour (max allowed 15)"]


def test_monthly_rule_boundary_and_order(spark):
    assert not check(spark, 1, 1, 900.0, amount=100.0)["violated"]  # 1000 == limit of O
    r = check(spark, 6, 16, 1500000.0, amount=1234.5)
    assert len(r["reasons"]) == 3
    assert r["reasons"][2] == "Monthly spending AED 1,501,234.50 exceeds limit AED 1,000.00"
    assert r["reasons"][0].startswith("Velocity") and r["reasons"][1].startswith("Hourly")


def decide_row(spark, **kw):
    cols = D.combine(
        F.lit(kw.get("violated", False)), F.array(*[F.lit(x) for x in kw.get("reasons", ["r"])]),
        F.lit(1000.0),
        F.lit(kw["pred"]) if "pred" in kw else None, F.lit(kw.get("dec", 0.0)) if "pred" in kw else None,
        F.lit(kw["err"]) if "err" in kw else None, F.lit(3.4) if "err" in kw else None,
        F.lit(kw.get("ae_anom")) if "err" in kw else None, F.lit("AE reason") if "err" in kw else None,
    )
    return spark.range(1).select(*cols).first()


def test_decision_legs(spark):
    r = decide_row(spark, violated=False)
    assert not r["is_fraud"] and r["reasons"] == [] and r["ae_reconstruction_error"] is None and not r["ae_flag"]
    r = decide_row(spark, violated=True, reasons=["rule"], pred=-1, dec=-0.01234, err=5.0, ae_anom=True)
    assert r["is_fraud"] and r["ml_flag"] and r["ae_flag"]
    assert r["reasons"] == ["rule", "ML anomaly detected: abnormal behavior pattern (risk score 0.0123)", "AE reason"]
    assert r["risk_score"] == pytest.approx(0.01234)
    r = decide_row(spark, violated=False, pred=1, dec=0.2, err=1.0, ae_anom=False)
    assert not r["is_fraud"] and r["ae_reconstruction_error"] == 1.0 and r["ae_threshold"] == 3.4
    # AE leg absent: rules still apply
    r = decide_row(spark, violated=True, reasons=["rule"])
    assert r["is_fraud"] and r["ae_reconstruction_error"] is None and r["ae_threshold"] is None


def test_ae_scoring_edge_values(spark):
    from acctsentry.operators.autoencoder import score_autoencoder

    df = spark.createDataFrame([(1, float("nan")), (2, float("inf")), (3, 2.0), (4, 2.5), (5, None)],
                               "seq long, reconstruction_error double")
    out = {r["seq"]: r for r in score_autoencoder(df, 2.0).collect()}
    assert out[1]["reconstruction_error"] == 999.0 and out[1]["is_anomaly"]
    assert out[1]["reason"] == "Invalid reconstruction error"
    assert out[2]["reconstruction_error"] == 999.0 and out[2]["is_anomaly"]
    assert not out[3]["is_anomaly"] and out[3]["reason"] is None  # equal to threshold
    assert out[4]["is_anomaly"] and out[4]["reason"] == "Autoencoder anomaly: 2.5000 > 2.0000"
