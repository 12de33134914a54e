"""Scaler, isolation forest, autoencoder contracts, and the live stream."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from acctsentry import schema as S
from acctsentry.operators import autoencoder as AE
from acctsentry.operators import features as FE
from acctsentry.operators import iforest as IF
from acctsentry.operators.scaler import apply_scaler, fit_scaler
from acctsentry.session import scratch_path
from acctsentry.sources import views as V
from tests.conftest import SF_MID, SF_SMALL


@pytest.fixture(scope="module")
def scaled(spark):
    m = FE.model_matrix(FE.feature_table(V.txn_events(spark, SF_MID))).checkpoint(eager=True)
    return apply_scaler(m, fit_scaler(m)).checkpoint(eager=True)


def test_scaler_round_trip(spark, scaled):
    pdf = scaled.toPandas()
    X = pdf[S.MODEL_FEATURES].to_numpy()
    assert np.allclose(X.mean(axis=0), 0, atol=1e-9)
    stds = X.std(axis=0)
    assert np.all((np.abs(stds - 1) < 1e-9) | (stds < 1e-9))


def test_iforest_rate_repeatable_round_trip(spark, scaled):
    f1 = IF.train_iforest(scaled, n_estimators=20)
    f2 = IF.train_iforest(scaled, n_estimators=20)
    assert f1.nodes.sort_values(["tree", "node"]).equals(f2.nodes.sort_values(["tree", "node"]))
    scored = IF.score_iforest(scaled, f1, keep=[S.SEQ]).checkpoint(eager=True)
    rep = IF.iforest_report(scored, f1).first()
    assert abs(rep["anomaly_rate"] - 0.05) < 0.01
    path = scratch_path(spark, "forest")
    IF.save_forest(spark, f1, path)
    f3 = IF.load_forest(spark, path)
    a = scored.orderBy(S.SEQ).select("anomaly_score").toPandas()["anomaly_score"].to_numpy()
    b = IF.score_iforest(scaled, f3, keep=[S.SEQ]).orderBy(S.SEQ).select("anomaly_score").toPandas()[
        "anomaly_score"].to_numpy()
    assert np.allclose(a, b)
    assert IF.load_forest(spark, scratch_path(spark, "missing")) is None


def test_autoencoder_threshold_and_round_trip(spark, scaled):
    ae = AE.train_autoencoder(scaled, epochs=3)
    assert len(ae.history) >= 1
    errs = AE.score_errors(scaled, ae, keep=[S.SEQ]).checkpoint(eager=True)
    cfg = AE.compute_threshold(errs)
    e = errs.toPandas()["reconstruction_error"].to_numpy()
    assert cfg["threshold"] == pytest.approx(e.mean() + 3 * e.std(), rel=1e-9)
    path = scratch_path(spark, "ae")
    AE.save_autoencoder(spark, ae, path, cfg)
    back = AE.load_autoencoder(spark, path)
    assert back.threshold == pytest.approx(cfg["threshold"])
    first = errs.orderBy(S.SEQ).limit(1000).agg(F.avg("reconstruction_error")).first()[0]
    assert AE.validate_autoencoder(spark, path, scaled, first) <= 0.01
    assert AE.load_autoencoder(spark, scratch_path(spark, "missing")) is None


def test_autoencoder_gradients_match_finite_differences():
    rng = np.random.default_rng(0)
    p = AE.init_params(9, seed=1)
    X = rng.normal(size=(16, 9))

    def loss(params):
        out, _, _ = AE.forward(params, X, training=True)
        return np.mean((out - X) ** 2)

    out, cache, _ = AE.forward(p, X, training=True)
    grads = AE.backward(p, cache, 2.0 * (out - X) / X.size)
    for k in ["W0", "b2", "g1", "be4", "W5"]:
        idx = tuple(rng.integers(s) for s in p[k].shape)
        q = {n: a.copy() for n, a in p.items()}
        q[k][idx] += 1e-6
        r = {n: a.copy() for n, a in p.items()}
        r[k][idx] -= 1e-6
        num = (loss(q) - loss(r)) / 2e-6
        assert num == pytest.approx(grads[k][idx], rel=1e-4, abs=1e-8), k


LIVE_INPUT = ("seq long, CustomerId long, FromAccountNo long, CreateDate timestamp, AmountInAed double, "
              "TransferType string, Status string")


def _files(spark, path, *batches):
    """One file per batch, the later the younger."""
    for i, rows in enumerate(batches):
        df = spark.createDataFrame([(s, 1, 10, t, 100.0, "O", st) for s, t, st in rows],
                                   LIVE_INPUT.replace("CreateDate timestamp", "CreateDate string"))
        df.withColumn("CreateDate", F.to_timestamp("CreateDate")).coalesce(1).write.parquet(f"{path}/{spark.range(1).count()}-{i}-{rows[0][0]}")


def _replay(spark, root, watermark="2 hours"):
    from pyspark.sql.types import _parse_datatype_string

    from acctsentry.streaming import live as L

    stream = L.transfers_stream(spark, f"{root}/in", _parse_datatype_string(LIVE_INPUT))
    dropped = L.run_to_sink(L.live_state_stream(stream, watermark), f"{root}/out", f"{root}/ckpt")
    return dropped, {r.seq: r for r in spark.read.schema(L.LIVE_SCHEMA).parquet(f"{root}/out").collect()}


def test_stream_out_of_order_late_and_restart(spark):
    root = scratch_path(spark, "live-order")
    _files(spark, f"{root}/in", [(1, "2024-01-01 10:00:00", "Approved"), (2, "2024-01-01 10:30:00", "Approved")],
           [(3, "2024-01-01 10:20:00", "Approved"), (4, "2024-01-01 10:35:00", "Rejected")])
    dropped, out = _replay(spark, root)
    assert dropped == 0
    assert [(out[i].live_txn_count_10min, out[i].live_txn_count_1hour, out[i].live_time_since_last) for i in (1, 2, 3, 4)] == [
        (1, 1, 3600.0), (1, 2, 1800.0), (1, 2, 1200.0), (2, 4, 300.0)]
    assert [out[i].session_count for i in (1, 2, 3, 4)] == [0, 1, 2, 3]
    assert [out[i].session_month_spending for i in (1, 2, 3, 4)] == [0.0, 100.0, 200.0, 300.0]
    # a restart with new rows: state goes on; a row behind the watermark (20:00 - 2 h) is dropped and counted
    _files(spark, f"{root}/in", [(5, "2024-01-01 20:00:00", "Approved")])
    _files(spark, f"{root}/in", [(6, "2024-01-01 09:00:00", "Approved"), (7, "2024-01-01 19:30:00", "Approved")])
    dropped, out = _replay(spark, root)
    assert dropped + out[6].late == 1 and not any(r.late for i, r in out.items() if i != 6)
    assert out[6].session_count is None
    assert (out[5].session_count, out[5].live_txn_count_1hour) == (3, 1)
    assert out[5].live_time_since_last == 9.5 * 3600
    # 7 is earlier than 5: it sees neither 5's time nor anything younger than 10:30, but 5 in the session
    assert (out[7].session_count, out[7].live_txn_count_1hour, out[7].live_time_since_last) == (4, 1, 9 * 3600)


def test_early_drops_are_counted(spark):
    """More batches than Spark keeps the progress of, with a drop in an early one."""
    root, kept = scratch_path(spark, "live-drops"), "spark.sql.streaming.numRecentProgressUpdates"
    times = ["2024-01-01 10:00:00", "2024-01-01 20:00:00", "2024-01-01 20:01:00", "2024-01-01 09:00:00"]
    times += [f"2024-01-01 20:{i:02}:00" for i in range(2, 14)]
    _files(spark, f"{root}/in", *[[(i, t, "Approved")] for i, t in enumerate(times)])
    spark.conf.set(kept, "6")
    try:
        dropped, out = _replay(spark, root)
    finally:
        spark.conf.unset(kept)
    assert dropped == 1 and sorted(out) == [i for i in range(len(times)) if i != 3]


def test_stream_equals_batch_in_order(spark):
    from acctsentry.streaming import live as L

    root = scratch_path(spark, "live-test")
    L.run_to_sink(L.live_state_stream(L.events_stream(spark, SF_SMALL)), f"{root}/out", f"{root}/ckpt")
    cols = [S.SEQ, "live_txn_count_10min", "live_txn_count_1hour", "live_time_since_last", "session_count", "session_month_spending"]
    got = spark.read.schema(L.LIVE_SCHEMA).parquet(f"{root}/out").select(*cols).toPandas()
    want = L.approved_velocity(V.txn_events(spark, SF_SMALL)).select(*cols).toPandas()
    got = got.sort_values(S.SEQ).reset_index(drop=True)
    want = want.sort_values(S.SEQ).reset_index(drop=True)
    assert len(got) == len(want) > 0
    for c in cols:
        assert np.allclose(got[c].astype(float), want[c].astype(float)), c


def test_live_decisions_have_all_legs(spark, scaled):
    from acctsentry.operators import profile as PR
    from acctsentry.operators.decision import SERVING_FEATURES, serving_features
    from acctsentry.streaming import live as L

    root = scratch_path(spark, "live-legs")
    _files(spark, f"{root}/in", [(1, "2024-01-01 10:00:00", "Approved"), (2, "2024-01-02 10:00:00", "Approved")])
    _replay(spark, root)
    live = spark.read.schema(L.LIVE_SCHEMA).parquet(f"{root}/out")
    stored = spark.createDataFrame([(1, 10, "2024-01-01 08:00:00", 50.0, "S")], "CustomerId long, FromAccountNo long, "
                                   "CreateDate string, AmountInAed double, TransferType string") \
        .withColumn("CreateDate", F.to_timestamp("CreateDate"))
    m = FE.model_matrix(FE.feature_table(V.txn_events(spark, SF_SMALL))).checkpoint(eager=True)
    scaler = fit_scaler(m)
    forest = IF.train_iforest(apply_scaler(m, scaler), n_estimators=10)
    ae = AE.train_autoencoder(apply_scaler(m, scaler), epochs=2)
    ae.threshold = 0.0  # everything is an anomaly
    prof, months = PR.account_profile(stored), PR.month_totals(stored)
    out = {r.seq: r for r in L.live_decisions(live, prof, months, scaler, forest, ae).collect()}
    assert [out[i].current_month_spending for i in (1, 2)] == [50.0, 150.0]
    assert out[1].threshold == 50.0 + 4 * 2000 and out[1].ae_flag and out[1].is_fraud and out[1].risk_score != 0.0
    assert out[1].reasons[-1].startswith("Autoencoder anomaly")
    rules_only = {r.seq: r for r in L.live_decisions(live, prof, months).collect()}
    assert not rules_only[1].is_fraud and rules_only[1].ae_reconstruction_error is None
    served = serving_features(PR.with_profile(live, prof))
    assert len(SERVING_FEATURES) == 26 and set(SERVING_FEATURES) <= set(served.columns)
    log = L.log_rows(L.live_decisions(live, prof, months)).collect()
    assert {(r.CustomerID, r.FromAccountNo, r.Status) for r in log} == {(1, "10", "Approved")}


def test_one_row_account_is_decided_with_the_fixed_deviation(spark):
    from acctsentry.operators.profile import rule_decisions

    df = spark.createDataFrame([(1, "c", "a", "b", 5000.0, "S", "2024-01-01 10:00:00")],
                               "seq long, CustomerId string, FromAccountNo string, ReceipentAccount string, AmountInAed double, "
                               "TransferType string, CreateDate string")
    assert rule_decisions(FE.feature_table(df)).first()["threshold"] == 9000.0


def test_missing_feature_and_non_finite_error(spark, scaled):
    from acctsentry.operators.autoencoder import score_autoencoder

    forest = IF.train_iforest(scaled.limit(500), n_estimators=5)
    r = IF.score_iforest(scaled.drop("hour").limit(3), forest, keep=[S.SEQ]).collect()
    assert len(r) == 3 and all(x.anomaly_score is None and x.is_anomaly is None for x in r)
    errors = spark.createDataFrame([(1, float("inf")), (2, float("nan")), (3, None), (4, 2.0), (5, 1.0)],
                                   "seq long, reconstruction_error double")
    got = {x.seq: (x.reconstruction_error, x.is_anomaly) for x in score_autoencoder(errors, 1.0).collect()}
    assert got == {1: (999.0, True), 2: (999.0, True), 3: (None, None), 4: (2.0, True), 5: (1.0, False)}


def test_exact_order_statistics(spark):
    from acctsentry.operators import quantile as Q

    df = spark.range(300_000).selectExpr("(id * 7919) % 300007 as x")
    want = np.sort((np.arange(300_000) * 7919) % 300_007)
    for k in (0, 1, 14_999, 150_000, 299_999):
        assert Q.kth_value(df, "x", k) == want[k]
    assert Q.exact_quantile(df, "x", 0.05) == pytest.approx(np.percentile(want, 5))
    ties = spark.range(250_000).selectExpr("id % 2 as x")
    assert (Q.kth_value(ties, "x", 124_999), Q.kth_value(ties, "x", 125_000)) == (0, 1)


def test_training_does_not_depend_on_partitions(spark, scaled):
    some = scaled.where(F.col(S.SEQ) <= 1501).checkpoint(eager=True)  # 1 row is left over in a batch
    a = AE.train_autoencoder(some.repartition(3), epochs=2, workers=3)
    b = AE.train_autoencoder(some.repartition(7), epochs=2, workers=3)
    assert all(np.array_equal(a.params[k], b.params[k]) for k in a.params)


def test_saved_scaler(spark, scaled):
    from acctsentry.operators.scaler import load_scaler, save_scaler

    path = scratch_path(spark, "scaler")
    sc = fit_scaler(scaled)
    save_scaler(sc, path)
    assert sorted(load_scaler(spark, path).collect()) == sorted(sc.collect())
    assert load_scaler(spark, scratch_path(spark, "none")) is None


def test_rejected_rows_do_not_change_state(spark):
    from acctsentry.streaming import live as L

    rows = [(1, 1, 10, "2024-01-01 10:00:00", 5.0, "O", "Rejected"),
            (2, 1, 10, "2024-01-01 10:01:00", 5.0, "O", "Approved"),
            (3, 1, 10, "2024-01-01 10:02:00", 5.0, "O", "Force Approved"),
            (4, 1, 10, "2024-01-01 10:11:59", 5.0, "O", "Approved"),
            (5, 2, 20, "2024-01-01 10:00:00", 5.0, "O", "Approved"),
            (6, 2, 20, "2024-01-01 10:10:00", 5.0, "O", "Approved")]
    df = spark.createDataFrame(rows, "seq long, CustomerId long, FromAccountNo long, CreateDate string, "
                                     "AmountInAed double, TransferType string, Status string") \
        .withColumn("CreateDate", F.to_timestamp("CreateDate"))
    out = {r[S.SEQ]: r for r in L.approved_velocity(df).collect()}
    assert [out[i]["live_txn_count_10min"] for i in (1, 2, 3, 4)] == [1, 1, 2, 2]
    assert [out[i]["session_count"] for i in (1, 2, 3, 4)] == [0, 0, 1, 2]
    assert out[2]["live_time_since_last"] == 3600.0 and out[3]["live_time_since_last"] == 60.0
    # an approved row exactly 600 s before is outside the strict 10-minute window
    assert out[6]["live_txn_count_10min"] == 1 and out[6]["live_txn_count_1hour"] == 2


def test_many_workers_are_averaged_in_levels(spark, scaled, monkeypatch):
    """More workers than one task averages: the same weights up to the order of sums."""
    some = scaled.where(F.col(S.SEQ) <= 2000).checkpoint(eager=True)
    levels = AE.train_autoencoder(some, epochs=1, passes=1, workers=40)
    monkeypatch.setattr(AE, "FAN", 64)
    once = AE.train_autoencoder(some, epochs=1, passes=1, workers=40)
    assert all(np.allclose(levels.params[k], once.params[k], rtol=1e-9, atol=1e-12) for k in once.params)
    monkeypatch.setattr(AE, "WORKER_ROWS", 100)
    grown = AE.train_autoencoder(some, epochs=1, passes=1)
    assert len(grown.history) == 1 and all(np.isfinite(a).all() for a in grown.params.values())


def test_training_step_is_that_of_the_passes():
    """The fused step gives, to the bit, what forward, backward and Adam give one after the other."""
    from acctsentry.operators import autoencoder as AE

    X = np.random.default_rng(1).normal(size=(150, 43))
    got, want = AE.init_params(43, 3), AE.init_params(43, 3)
    zeros = [{k: np.zeros_like(a) for k, a in got.items() if AE._is_trainable(k)} for _ in range(4)]
    assert AE.train_epoch(got, zeros[0], zeros[1], 0, X, 64, np.random.default_rng(2)) == 3
    order, m, v, t = np.random.default_rng(2).permutation(len(X)), zeros[2], zeros[3], 0
    for start in range(0, len(X), 64):
        xb = X[order[start:start + 64]]
        out, cache, stats = AE.forward(want, xb, training=True)
        grads, t = AE.backward(want, cache, 2.0 * (out - xb) / xb.size), t + 1
        for k, g in grads.items():
            m[k] = 0.9 * m[k] + (1 - 0.9) * g
            v[k] = 0.999 * v[k] + (1 - 0.999) * g * g
            want[k] -= 1e-3 * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-7)
        for i, (mu, var) in stats.items():
            want[f"mm{i}"] = AE.BN_MOMENTUM * want[f"mm{i}"] + (1 - AE.BN_MOMENTUM) * mu
            want[f"mv{i}"] = AE.BN_MOMENTUM * want[f"mv{i}"] + (1 - AE.BN_MOMENTUM) * var
    assert got.keys() == want.keys() and all(np.array_equal(got[k], want[k]) for k in want)


def test_each_worker_has_a_partition(spark):
    """Workers are dealt one to a partition: a hash of their numbers gives some tasks several and others none."""
    from acctsentry.operators import autoencoder as AE

    rows = spark.range(400).select(F.col("id").alias("seq"), (F.col("id") % 16).cast("int").alias("_worker"))
    dealt = AE.dealt(rows, 16).select("_worker", F.spark_partition_id().alias("p")).distinct()
    assert dealt.count() == 16 and dealt.select("p").distinct().count() == 16


def test_path_lengths_of_a_walk():
    """The gathers end where a walk from the root ends."""
    from acctsentry.operators import iforest as IF
    from acctsentry.plans.queries import rule_forest

    forest, X = rule_forest(), np.random.default_rng(4).normal(size=(40, 43))
    X[0], X[1, :5] = np.inf, np.nan
    feat, split, left, right, size, depth = arrays = forest.arrays()
    for x, row in zip(X, IF._path_lengths(X, arrays)):
        for t, got in enumerate(row):
            node = 0
            while feat[t, node] >= 0:
                node = left[t, node] if x[feat[t, node]] <= split[t, node] else right[t, node]
            assert got == depth[t, node] + IF.avg_path_length(size[t, node:node + 1])[0]


def test_blocks_hold_each_workers_rows_in_order(spark):
    """What all rounds read: a worker's rows as bytes, in file order, with the validation rows marked."""
    rows = spark.range(300).select(
        F.col("id").alias("seq"), (F.col("id") * 0.5).alias("a"), (-F.col("id")).cast("double").alias("b"), (F.col("id") > 270).alias("_val"),
        (F.col("id") % 3).cast("int").alias("_worker"))
    found = AE.blocks(AE.dealt(rows.repartition(5), 3).drop("seq"), ["a", "b"]).collect()
    for worker in range(3):
        own = [r for r in found if r.worker == worker]
        X = np.concatenate([np.frombuffer(r.rows).reshape(-1, 2) for r in own])
        val = np.concatenate([np.frombuffer(r.val, bool) for r in own])
        ids = np.arange(worker, 300, 3)
        assert np.array_equal(X, np.column_stack([ids * 0.5, -1.0 * ids])) and np.array_equal(val, ids > 270)
    assert len(found) < 10  # not a row each


def test_scores_leave_kept_columns_as_they_are(spark):
    """NULLs, long numbers and lists that are kept beside a score; a feature that is NULL is no number."""
    import datetime as dt

    rows = spark.createDataFrame(
        [(2**53 + 1, None, ["a", None], dt.datetime(2024, 1, 1, 1, 2, 3), 1.0), (None, "x", None, None, None)],
        "id long, name string, list array<string>, at timestamp, f double")
    keep = ["id", "name", "list", "at"]
    schema = rows.select(*keep, F.col("f").alias("v"), F.col("f").alias("none")).schema
    out = IF.with_values(rows, keep, lambda batch: {"v": IF.as_matrix(batch, ["f"])[:, 0] + 1, "none": None}, schema).collect()
    out.sort(key=lambda r: r.id is None)
    assert tuple(out[0]) == (2**53 + 1, None, ["a", None], dt.datetime(2024, 1, 1, 1, 2, 3), 2.0, None)
    assert out[1][:4] == (None, "x", None, None) and np.isnan(out[1].v) and out[1].none is None
