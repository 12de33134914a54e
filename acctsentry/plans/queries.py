"""Registered queries: one per operator group, each reading the driver tables
at ``sf_dir`` (through the transfer views) and returning a DataFrame.

Doubles that come out of sums, averages or divisions are rounded to 6 places
here and in the matching DuckDB statement (:data:`ORACLE`), so engine-level
summation order does not decide the comparison.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acctsentry import schema as S
from acctsentry.operators import features as FE
from acctsentry.operators import profile as PR
from acctsentry.sources import views as V

K = list(S.ACCOUNT_KEY)


def r6(c: str | Column, name: str | None = None) -> Column:
    """Round to 6 places as floor(x * 1e6 + 0.5001) / 1e6: plain IEEE steps that
    give the same double in any engine (decimal-string rounding does not). The
    small excess over 0.5 takes decimal ties, as averages of two-place amounts
    over 16 or 32 rows are, up on both sides, whatever the last bit of the sum."""
    col = (F.col(c) if isinstance(c, str) else c).cast("double")
    out = F.floor(col * F.lit(1e6) + F.lit(0.5001)).cast("double") / F.lit(1e6)
    return out.alias(name or (c if isinstance(c, str) else None))


def _events(spark, sf) -> DataFrame:
    return V.txn_events(spark, sf)


def _lineitem(spark, sf) -> DataFrame:
    # a fixture view with a global numbering, which has written its rows once
    return V.txn_lineitem(spark, sf)


VIEWS = {
    "events": _events,
    "lineitem": _lineitem,
    "dirty": lambda spark, sf: V.txn_dirty(spark, sf),
    "keyless": lambda spark, sf: V.txn_dirty(spark, sf).drop(S.CUSTOMER, S.ACCOUNT),
    "dateless": lambda spark, sf: V.txn_dirty(spark, sf).withColumn(S.CREATED, F.concat(F.lit("no date "), S.SEQ)),
}


def _features(spark, sf, view="events") -> DataFrame:
    return FE.feature_table(VIEWS[view](spark, sf))


# ---------------------------------------------------------------------------
# Row features, groups, windows
# ---------------------------------------------------------------------------
def q_row_features(spark, sf):
    p = FE.prepare(_events(spark, sf))
    from acctsentry.functions.scalar import type_name

    return p.select(
        S.SEQ, r6("transaction_amount"), "flag_amount", "transfer_type_encoded",
        r6("transfer_type_risk"), "channel_encoded", "hour", "day_of_week", "is_weekend", "is_night",
        type_name(F.col(S.TRANSFER_TYPE)).alias("type_name"),
    )


def q_channel_codes(spark, sf):
    return FE.channel_codes(S.conform(_lineitem(spark, sf))).drop("_rows")


def q_account_stats(spark, sf):
    st = FE.account_stats(FE.prepare(_events(spark, sf)))
    return st.select(
        *K, r6("user_avg_amount"), r6("user_std_amount"), r6("user_max_amount"), "user_txn_frequency",
        r6("intl_ratio"), r6("user_high_risk_txn_ratio"), "geo_anomaly_flag",
    )


def q_customer_stats(spark, sf):
    cs = FE.customer_stats(FE.prepare(_lineitem(spark, sf)))
    return cs.select(
        S.CUSTOMER, "num_accounts", r6("cross_account_transfer_ratio"),
        (F.col("num_accounts") > 1).cast("int").alias("user_multiple_accounts_flag"),
    )


def _feature_cols(spark, sf, view, cols):
    return _rounded_features(_features(spark, sf, view), cols)


def _rounded_features(ft, cols):
    out = []
    for c in cols:
        if c in S.COUNT_FEATURES or c in S.FLAG_FEATURES or c in ("seq", "num_accounts", "last_txn_time"):
            out.append(F.col(c))
        else:
            out.append(r6(c))
    return ft.select(*out)


BUCKET_COLS = {
    "bucket_hourly": ("events", ["hourly_total", "hourly_count"]),
    "bucket_daily": ("lineitem", ["daily_total", "daily_count"]),
    "bucket_weekly": ("lineitem", ["weekly_total", "weekly_txn_count", "weekly_avg_amount",
                                   "weekly_deviation", "amount_vs_weekly_avg"]),
    "bucket_monthly": ("lineitem", ["current_month_spending", "monthly_txn_count", "monthly_avg_amount",
                                    "monthly_deviation", "amount_vs_monthly_avg"]),
    "account_ratios": ("events", ["deviation_from_avg", "amount_to_max_ratio", "intl_ratio",
                                  "user_high_risk_txn_ratio", "user_multiple_accounts_flag",
                                  "cross_account_transfer_ratio", "geo_anomaly_flag"]),
    "time_since_last": ("events", ["time_since_last", "last_txn_time", "recent_burst", "transaction_velocity"]),
    "velocity_counts": ("events", ["txn_count_30s", "txn_count_10min", "txn_count_1hour"]),
    "rolling_std": ("events", ["rolling_std"]),
    "new_beneficiary": ("lineitem", ["is_new_beneficiary"]),
    "beneficiary_30d": ("lineitem", ["beneficiary_txn_count_30d"]),
}

FEATURE_TABLE_COLS = ["seq", *S.MODEL_FEATURES, "num_accounts", "last_txn_time", "month_spending_before"]


def _make_feature_query(view, cols):
    return lambda spark, sf: _feature_cols(spark, sf, view, ["seq", *cols])


# ---------------------------------------------------------------------------
# Profile, lists, limits, rules
# ---------------------------------------------------------------------------
def q_account_profile(spark, sf):
    pr = PR.account_profile(_events(spark, sf))
    return pr.select(
        *K, r6("user_avg_amount"), r6("user_max_amount"), "user_txn_frequency",
        r6("user_international_ratio"), r6("user_std_display"), r6("user_std_decision"),
    )


def q_profile_dirty(spark, sf):
    """A12, F1/F2 keys and J10 on NULL keys, bad amounts and one-row accounts."""
    txn = V.txn_dirty(spark, sf)
    pr = PR.with_profile(txn.select(S.SEQ, *K), PR.account_profile(txn))
    return pr.select(S.SEQ, r6("user_avg_amount"), r6("user_std_amount"), r6("user_max_amount"), "user_txn_frequency",
                     r6("user_international_ratio"))


def q_approved_velocity_dirty(spark, sf):
    """T1-T5 with Force Approved rows, NULL keys and dates."""
    from acctsentry.streaming.live import approved_velocity

    txn = V.txn_dirty(spark, sf)
    return approved_velocity(txn.withColumn(S.CREATED, F.try_to_timestamp(S.CREATED))).select(
        S.SEQ, "live_txn_count_10min", "live_txn_count_1hour", r6("live_time_since_last"), "session_count",
        r6("session_month_spending"))


def _as_of(txn: DataFrame) -> Column:
    """The latest transfer time of the table, as a scalar subquery."""
    return txn.select(F.max(S.CREATED)).scalar()


def q_month_to_date(spark, sf):
    txn = _lineitem(spark, sf)
    mtd = PR.month_to_date(txn, _as_of(txn))
    return mtd.select(*K, r6("month_to_date"))


def _rule_rows(spark, sf, view="events") -> DataFrame:
    return PR.rule_decisions(_features(spark, sf, view))


def q_rule_decisions_dirty(spark, sf):
    return q_rule_decisions(spark, sf, "dirty")


def q_rule_decisions(spark, sf, view="events"):
    rd = _rule_rows(spark, sf, view)
    return rd.select(
        S.SEQ, F.col("violated").cast("int").alias("violated"), r6("threshold"),
        F.size("reasons").cast("long").alias("n_reasons"),
        F.array_join("reasons", " | ").alias("reasons"),
    )


def q_history_totals(spark, sf):
    txn = _events(spark, sf)
    decided = _rule_rows(spark, sf).withColumn("is_fraud", F.col("violated"))
    log = PR.decision_log_from(decided)
    # The file holds the transfers of the first half of the time, the session those of the second.
    us = F.unix_micros(S.CREATED)
    cut = txn.select(((F.min(us) + F.max(us)) / 2).cast("long")).scalar()
    ht = PR.history_totals(txn.where(us < cut), log.where(F.unix_micros("Timestamp") >= cut), _as_of(txn))
    return ht.select(
        "CustomerID", "FromAccountNo", "stored_count", "session_count", "total_txns",
        r6("stored_month"), r6("session_month"), r6("total_month"),
    )


def q_account_list(spark, sf):
    return PR.account_list(_events(spark, sf))


def q_customer_list(spark, sf):
    return PR.customer_list(_lineitem(spark, sf))


def q_limits_by_type(spark, sf):
    lim = PR.limits_by_type(PR.account_profile(_events(spark, sf)))
    return lim.select(*K, "transfer_type", r6("limit"))


# ---------------------------------------------------------------------------
# Scaler, models, decision, stream
# ---------------------------------------------------------------------------
def _matrix(spark, sf) -> DataFrame:
    return FE.model_matrix(_features(spark, sf, "events"))


def q_scaler_stats(spark, sf):
    from acctsentry.operators.scaler import fit_scaler

    sc = fit_scaler(_matrix(spark, sf))
    return sc.select(F.col("position").cast("int").alias("position"), "feature", r6("mean"), r6("scale"))


def q_scaled_features(spark, sf):
    from acctsentry.operators.scaler import apply_scaler, fit_scaler

    m = _matrix(spark, sf).checkpoint(eager=True)
    scaled = apply_scaler(m, fit_scaler(m))
    return scaled.select(S.SEQ, *[r6(f) for f in S.MODEL_FEATURES])


def _trained(spark, sf):
    from acctsentry.operators import iforest as IF
    from acctsentry.operators.scaler import apply_scaler, fit_scaler

    m = _matrix(spark, sf).checkpoint(eager=True)
    scaled = apply_scaler(m, fit_scaler(m)).checkpoint(eager=True)
    forest = IF.train_iforest(scaled)
    return scaled, forest


def q_iforest_scores(spark, sf):
    from acctsentry.operators import iforest as IF

    scaled, forest = _trained(spark, sf)
    return IF.score_iforest(scaled, forest, keep=[S.SEQ]).select(
        S.SEQ, r6("anomaly_score"), "prediction", "is_anomaly", "reason"
    )


def q_iforest_report(spark, sf):
    from acctsentry.operators import iforest as IF

    scaled, forest = _trained(spark, sf)
    return IF.iforest_report(IF.score_iforest(scaled, forest, keep=[S.SEQ]), forest)


def _ae(spark, sf):
    from acctsentry.operators import autoencoder as AE
    from acctsentry.operators.scaler import apply_scaler, fit_scaler

    m = _matrix(spark, sf).checkpoint(eager=True)
    scaled = apply_scaler(m, fit_scaler(m)).checkpoint(eager=True)
    ae = AE.train_autoencoder(scaled)
    errors = AE.score_errors(scaled, ae, keep=[S.SEQ]).checkpoint(eager=True)
    return scaled, ae, errors


def q_ae_scores(spark, sf):
    from acctsentry.operators import autoencoder as AE

    _, ae, errors = _ae(spark, sf)
    cfg = AE.compute_threshold(errors)
    return AE.score_autoencoder(errors, cfg["threshold"]).select(
        S.SEQ, r6("reconstruction_error"), r6("threshold"), "is_anomaly", "reason"
    )


def q_ae_threshold_report(spark, sf):
    from acctsentry.operators import autoencoder as AE

    _, _, errors = _ae(spark, sf)
    return AE.threshold_table(errors).drop("computed_at")


def _decided(spark, sf):
    """All rows decided by rules and both models, the feature table computed
    once; and what the models were."""
    from acctsentry.operators import autoencoder as AE
    from acctsentry.operators import iforest as IF
    from acctsentry.operators.decision import decide, score_models
    from acctsentry.operators.scaler import apply_scaler, fit_scaler
    from acctsentry.session import checkpoint_root

    checkpoint_root(spark)
    rules = _rule_rows(spark, sf).select(S.SEQ, *K, "violated", "reasons", "threshold", *S.MODEL_FEATURES).checkpoint(eager=True)
    matrix = FE.model_matrix(rules)
    scaler = fit_scaler(matrix).checkpoint(eager=True)
    scaled = apply_scaler(matrix, scaler).checkpoint(eager=True)
    forest, ae = IF.train_iforest(scaled), AE.train_autoencoder(scaled)
    ae.threshold_cfg = AE.compute_threshold(AE.score_errors(scaled, ae, keep=[S.SEQ]))
    ae.threshold = ae.threshold_cfg["threshold"]
    scored = score_models(rules, scaler, forest, ae).checkpoint(eager=True)
    return scored, decide(scored), scaler, scaled, forest, ae


#: Parameters of the fixed models: made by a rule, so that SQL can make them too.
RULE_TREES, RULE_DEPTH, RULE_PSI, RULE_OFFSET = 8, 4, 64, -0.57


def rule_forest():
    """A forest whose complete trees follow a rule (M3-M5 by value)."""
    import pandas as pd

    from acctsentry.operators import iforest as IF

    inner, rows = 2**RULE_DEPTH - 1, []
    for t in range(RULE_TREES):
        for i in range(2 * inner + 1):
            leaf = i >= inner
            rows.append((t, i, -1 if leaf else (t * 7 + i * 5) % len(S.MODEL_FEATURES), ((t * 13 + i * 17) % 21 - 10) / 10 + 0.037,
                         2 * i + 1, 2 * i + 2, 1 + (t * 3 + i * 11) % 9, (i + 1).bit_length() - 1))
    nodes = pd.DataFrame(rows, columns=IF.NODE_SCHEMA.names)
    return IF.Forest(nodes, list(S.MODEL_FEATURES), RULE_PSI, RULE_OFFSET, S.IFOREST_CONTAMINATION, RULE_TREES, 0)


def rule_autoencoder():
    """An autoencoder whose weights follow a rule (M7-M8 by value)."""
    import numpy as np

    from acctsentry.operators import autoencoder as AE

    dims, bn = AE.layer_dims(len(S.MODEL_FEATURES))
    p = {}
    for i in range(len(dims) - 1):
        r, c = np.arange(dims[i])[:, None], np.arange(dims[i + 1])
        p[f"W{i}"] = ((r * 37 + c * 61 + i * 13) % 101 - 50) / 400.0
        p[f"b{i}"] = ((c * 17 + i) % 11 - 5) / 100.0
        if bn[i]:
            p[f"g{i}"] = 1 + (c * 7 + i) % 5 / 10.0
            p[f"be{i}"] = ((c * 3 + i) % 7 - 3) / 10.0
            p[f"mm{i}"] = ((c * 5 + i) % 9 - 4) / 10.0
            p[f"mv{i}"] = 1 + (c * 11 + i) % 4 / 4.0
    return AE.Autoencoder(p, list(S.MODEL_FEATURES))


def q_iforest_rule_scores(spark, sf):
    """The scaled rows scored by a forest that SQL knows."""
    from acctsentry.operators import iforest as IF
    from acctsentry.operators.scaler import apply_scaler, fit_scaler

    m = _matrix(spark, sf).checkpoint(eager=True)
    scored = IF.score_iforest(apply_scaler(m, fit_scaler(m)), rule_forest(), keep=[S.SEQ])
    return scored.select(S.SEQ, r6("anomaly_score"), "prediction", "is_anomaly")


def q_ae_rule_scores(spark, sf):
    """Errors, threshold and flags of an autoencoder that SQL knows."""
    from acctsentry.operators import autoencoder as AE
    from acctsentry.operators.scaler import apply_scaler, fit_scaler

    m = _matrix(spark, sf).checkpoint(eager=True)
    errors = AE.score_errors(apply_scaler(m, fit_scaler(m)), rule_autoencoder(), keep=[S.SEQ]).checkpoint(eager=True)
    return AE.score_autoencoder(errors, AE.compute_threshold(errors)["threshold"]).select(
        S.SEQ, r6("reconstruction_error"), r6("threshold"), "is_anomaly")


def q_hybrid_rule_decisions(spark, sf):
    """H1-H6: rules and both models, whose parameters SQL knows, decide every row."""
    from acctsentry.operators import autoencoder as AE
    from acctsentry.operators.decision import decide, score_models
    from acctsentry.operators.scaler import apply_scaler, fit_scaler

    rules = _rule_rows(spark, sf).select(S.SEQ, "violated", "reasons", "threshold", *S.MODEL_FEATURES).checkpoint(eager=True)
    matrix = FE.model_matrix(rules)
    scaler, ae = fit_scaler(matrix).checkpoint(eager=True), rule_autoencoder()
    ae.threshold = AE.compute_threshold(AE.score_errors(apply_scaler(matrix, scaler), ae, keep=[S.SEQ]))["threshold"]
    out = decide(score_models(rules, scaler, rule_forest(), ae))
    return out.select(
        S.SEQ, "is_fraud", F.size("reasons").cast("long").alias("n_reasons"), r6("risk_score"), r6("threshold"), "ml_flag", "ae_flag",
        r6("ae_reconstruction_error"), r6("ae_threshold"))


def q_hybrid_decisions(spark, sf):
    out = _decided(spark, sf)[1]
    return out.select(
        S.SEQ, *K, "is_fraud", F.array_join("reasons", " | ").alias("reasons"), r6("risk_score"),
        r6("threshold"), "ml_flag", "ae_flag", r6("ae_reconstruction_error"), r6("ae_threshold"),
    )


def q_model_checks(spark, sf):
    """What the models' results must satisfy, as counts
    of rows that break it; artifacts saved, loaded and compared."""
    from acctsentry.operators import autoencoder as AE
    from acctsentry.operators import iforest as IF
    from acctsentry.operators.decision import score_models
    from acctsentry.operators.scaler import load_scaler, save_scaler
    from acctsentry.session import scratch_path

    scored, decided, scaler, scaled, forest, ae = _decided(spark, sf)
    path = scratch_path(spark, "models")
    save_scaler(scaler, f"{path}/scaler")
    IF.save_forest(spark, forest, f"{path}/forest")
    AE.save_autoencoder(spark, ae, f"{path}/ae", ae.threshold_cfg)
    again = score_models(
        scored.select(S.SEQ, *S.MODEL_FEATURES), load_scaler(spark, f"{path}/scaler"), IF.load_forest(spark, f"{path}/forest"),
        AE.load_autoencoder(spark, f"{path}/ae")).select(
        S.SEQ, F.col("anomaly_score").alias("a2"), F.col("reconstruction_error").alias("e2"))
    rows = decided.select(S.SEQ, "is_fraud", "reasons", "risk_score", "ml_flag", "ae_flag").join(scored.select(
        S.SEQ, "anomaly_score", "prediction", "violated", "reconstruction_error", F.col("reasons").alias("rule_reasons"),
        "ae_is_anomaly", "ae_reason"), S.SEQ).join(again, S.SEQ)
    errors = scored.agg(F.avg("reconstruction_error"), F.stddev_pop("reconstruction_error")).first()
    want_threshold = errors[0] + S.AE_K * errors[1]
    parts = F.concat(
        F.when(F.col("violated"), F.col("rule_reasons")).otherwise(F.array().cast("array<string>")),
        F.filter(F.col("reasons"), lambda r: r.startswith("ML anomaly detected")),
        F.when(F.col("ae_is_anomaly"), F.array("ae_reason")).otherwise(F.array().cast("array<string>")))
    broken = {
        "prediction_is_not_sign": F.col("prediction") != F.when(F.col("anomaly_score") < 0, -1).otherwise(1),
        "risk_is_not_negated": F.col("risk_score") != -F.col("anomaly_score"),
        "ml_flag_is_wrong": F.col("ml_flag") != (F.col("prediction") == -1),
        "ae_flag_is_wrong": F.col("ae_flag") != (F.col("reconstruction_error") > F.lit(ae.threshold)),
        "fraud_is_not_or_of_legs": F.col("is_fraud") != (F.col("violated") | F.col("ml_flag") | F.col("ae_flag")),
        "reasons_out_of_order": F.col("reasons") != parts,
        "ml_reason_is_missing": F.exists("reasons", lambda r: r.startswith("ML anomaly detected")) != F.col("ml_flag"),
        "loaded_scores_differ": (F.abs(F.col("a2") - F.col("anomaly_score")) > 1e-9) | (F.abs(F.col("e2") - F.col("reconstruction_error")) > 1e-9),
    }
    out = rows.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.sum(F.coalesce(c, F.lit(True)).cast("long")).alias(k) for k, c in broken.items()],
        (F.abs(F.avg((F.col("prediction") == -1).cast("double")) - S.IFOREST_CONTAMINATION) <= 0.02).alias("rate_is_near_contamination"))
    first = scored.orderBy(S.SEQ).limit(1000)
    mean = first.agg(F.avg("reconstruction_error")).first()[0]
    off = AE.validate_autoencoder(spark, f"{path}/ae", scaled, mean)
    rate = first.agg(F.avg((F.col("prediction") == -1).cast("double"))).first()[0]
    sample_rate = IF.validate_iforest(scored, rate)
    try:  # a sample that has shifted is refused
        IF.validate_iforest(scored.withColumn("prediction", F.when(F.col(S.SEQ) % 10 < 3, -1).otherwise(F.col("prediction"))), rate)
        shifted_is_refused = False
    except ValueError:
        shifted_is_refused = True
    return out.withColumns({
        "threshold_is_mean_plus_3_std": F.lit(abs(ae.threshold - want_threshold) <= 1e-9 * abs(want_threshold)),
        "config_is_complete": F.lit(set(ae.threshold_cfg) == {"threshold", "mean", "std", "k", "computed_at", "n_samples", "n_features"}),
        "ae_validates": F.lit(off <= 0.01),
        "forest_validates": F.lit(sample_rate == rate),
        "shifted_sample_is_refused": F.lit(shifted_is_refused),
    })


def q_missing_features(spark, sf):
    """M2: rows that lack a model feature get no score and no flag."""
    from acctsentry.operators.decision import decide, score_models

    scored, _, scaler, _, forest, ae = _decided(spark, sf)
    rows = scored.select(S.SEQ, "violated", "reasons", "threshold", *[f for f in S.MODEL_FEATURES if f != "hourly_count"])
    out = decide(score_models(rows, scaler, forest, ae))
    return out.select(S.SEQ, "is_fraud", "ml_flag", "ae_flag", r6("ae_reconstruction_error"), r6("risk_score"))


def q_approved_velocity(spark, sf):
    from acctsentry.streaming.live import approved_velocity

    return approved_velocity(_events(spark, sf)).select(
        S.SEQ, "live_txn_count_10min", "live_txn_count_1hour", r6("live_time_since_last"), "session_count",
        r6("session_month_spending"),
    )


#: Batches that the live replay comes in at least (a fifth of the rows comes one late), and rows of one.
LIVE_BATCHES, LIVE_BATCH_ROWS = 4, 1_000_000
#: Rows of the replay for one more state partition, and for one more shard of accounts.
LIVE_PARTITION_ROWS, LIVE_SHARD_ROWS = 10_000, 2_500


def _live_slices(txn: DataFrame):
    """The number of time slices, their width in seconds, the slice in which a row arrives, and the shards of the state."""
    early, late, n = txn.agg(F.min(S.CREATED), F.max(S.CREATED), F.count(F.lit(1))).first()
    batches, shards = max(LIVE_BATCHES, -(-n // LIVE_BATCH_ROWS)), max(1, n // LIVE_SHARD_ROWS)
    if early is None:
        return batches, 1, lambda at, late: F.lit(0), shards
    width = max(1, int((late - early).total_seconds()) // (batches - 1) + 1)

    def arrives(at: F.Column, late: F.Column) -> F.Column:
        own = F.floor((F.unix_seconds(at) - F.unix_seconds(F.lit(early))) / width)
        return F.least(own + late.cast("int"), F.lit(batches - 1))

    return batches, width, arrives, shards


def _replayed(spark, rows: DataFrame, batches: int, run) -> str:
    """``rows`` (column ``_batch``) written slice by slice, each in as many
    files as it has tasks; ``run(stream, root)`` takes what has come so far as
    one batch, and goes on from its checkpoint with the next. Rows dropped
    behind the watermark are an error."""
    from acctsentry.session import scratch_path
    from acctsentry.streaming import live as L

    root = scratch_path(spark, "live")
    rows.write.partitionBy("_batch").parquet(f"{root}/slices")  # a slice is read by itself, not out of all rows
    whole, plain = spark.read.schema(rows.schema).parquet(f"{root}/slices"), rows.drop("_batch")
    # A stream keeps the number of state partitions that it begins with: it follows from the rows.
    had, wanted = spark.conf.get("spark.sql.shuffle.partitions"), max(4, -(-whole.count() // LIVE_PARTITION_ROWS))
    spark.conf.set("spark.sql.shuffle.partitions", str(min(int(had), wanted)))
    try:
        for k in range(batches):
            whole.where(F.col("_batch") == k).drop("_batch").write.parquet(f"{root}/in/{k}")
            dropped = run(L.transfers_stream(spark, f"{root}/in", plain.schema, files=None), root)
            if dropped:
                raise ValueError(f"{dropped} rows came behind the watermark")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", had)
    return root


def _live_replay(spark, sf) -> DataFrame:
    """The events table replayed in slices that are out of order inside the watermark."""
    from acctsentry.streaming import live as L

    txn = _events(spark, sf)
    batches, width, arrives, shards = _live_slices(txn)
    rows = txn.withColumn("_batch", arrives(F.col(S.CREATED), F.col(S.SEQ) % 5 == 0))
    root = _replayed(spark, rows, batches, lambda stream, root: L.run_to_sink(
        L.live_state_stream(stream, f"{2 * width} seconds", shards=shards), f"{root}/out", f"{root}/ckpt"))
    return spark.read.schema(L.LIVE_SCHEMA).parquet(f"{root}/out")  # late ones included, flagged


def q_live_stream(spark, sf):
    from acctsentry.streaming.live import judged

    return judged(_live_replay(spark, sf)).select(
        S.SEQ, "live_txn_count_10min", "live_txn_count_1hour", r6("live_time_since_last"), "session_count",
        r6("session_month_spending"),
    )


def _decided_stream(spark, sf, models=(None, None, None)) -> DataFrame:
    """The replay decided inside the stream, with the profile and the
    months of the table's first half as versioned tables that each batch reads."""
    from acctsentry.session import scratch_path
    from acctsentry.sources.commits import read_table, replace_table
    from acctsentry.streaming import live as L

    txn = _events(spark, sf)
    stored = txn.where(F.col(S.SEQ) % 2 == 0)
    tables = scratch_path(spark, "live-tables")
    replace_table(PR.account_profile(stored), f"{tables}/profile")
    replace_table(PR.month_totals(stored), f"{tables}/months")
    batches, width, arrives, shards = _live_slices(txn)
    rows = txn.withColumn("_batch", arrives(F.col(S.CREATED), F.col(S.SEQ) % 5 == 0))
    root = _replayed(spark, rows, batches, lambda stream, root: L.decisions_to_log(
        L.live_state_stream(stream, f"{2 * width} seconds", shards=shards), f"{root}/log", f"{root}/ckpt",
        lambda: read_table(spark, f"{tables}/profile"), lambda: read_table(spark, f"{tables}/months"), lambda: models))
    return L.read_decided(spark, f"{root}/log")


def q_live_decisions(spark, sf):
    """Decisions made in the stream."""
    return _decided_stream(spark, sf).select(
        S.SEQ, "is_fraud", F.size("reasons").cast("long").alias("n_reasons"), r6("threshold"), r6("current_month_spending"))


def q_live_hybrid(spark, sf):
    """T6/H5 with all legs: what the stream has decided with both models, next
    to the batch decision of the same live rows. Counts of rows, of those
    that both models scored, and of those that differ."""
    from acctsentry.operators import autoencoder as AE
    from acctsentry.operators.scaler import apply_scaler, fit_scaler
    from acctsentry.streaming import live as L

    matrix = _matrix(spark, sf).checkpoint(eager=True)
    scaler, forest, ae = fit_scaler(matrix).checkpoint(eager=True), rule_forest(), rule_autoencoder()
    ae.threshold = AE.compute_threshold(AE.score_errors(apply_scaler(matrix, scaler), ae, keep=[S.SEQ]))["threshold"]
    streamed = _decided_stream(spark, sf, (scaler, forest, ae)).checkpoint(eager=True)
    stored = _events(spark, sf).where(F.col(S.SEQ) % 2 == 0)
    live = streamed.select(*[f.name for f in L.LIVE_COLUMNS if f.name != "late"], F.lit(False).alias("late"))
    batch = L.live_decisions(live, PR.account_profile(stored), PR.month_totals(stored), scaler, forest, ae)
    legs = ["is_fraud", "reasons", "risk_score", "threshold", "ml_flag", "ae_flag", "ae_reconstruction_error"]

    def near(c: str) -> F.Column:
        a, b = F.col(f"s.{c}"), F.col(f"b.{c}")
        return F.abs(a - b) <= 1e-9 * (1 + F.abs(b)) if dict(streamed.dtypes)[c] == "double" else a == b

    both = streamed.alias("s").join(batch.select(S.SEQ, *legs).alias("b"), S.SEQ)
    same = F.lit(True)
    for c in legs:
        same = same & near(c)
    return both.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(F.when(F.col("s.risk_score") != 0, F.col("s.ae_reconstruction_error"))).alias("n_scored"),
        F.count_if(~F.coalesce(same, F.lit(False))).alias("n_differ"))


def q_decision_log_stream(spark, sf):
    """The log that the stream has committed."""
    from acctsentry.streaming.live import log_rows

    return log_rows(_decided_stream(spark, sf)).select(
        "CustomerID", "FromAccountNo", r6("Amount"), "Type", "Status", F.col("Timestamp").cast("timestamp_ntz").alias("Timestamp"))


def q_live_verdicts(spark, sf):
    """T5: candidates and their verdicts as two streams. Verdicts come up to
    six minutes after their candidate, a quarter of them one slice late (the
    candidate may be late too, and then comes after its verdict), and every
    11th never; what waits a slice's width long is given up."""
    from acctsentry.streaming import live as L

    txn = _events(spark, sf)
    batches, width, arrives, shards = _live_slices(txn)
    given = F.expr(f"{S.CREATED} + make_interval(0, 0, 0, 0, 0, {S.SEQ} % 7, 0)")
    own = txn.withColumns({"event": F.lit("candidate"), "_batch": arrives(F.col(S.CREATED), F.col(S.SEQ) % 5 == 0)})
    verdicts = txn.where(F.col(S.SEQ) % 11 > 0).withColumns(
        {"event": F.lit("verdict"), S.CREATED: given, "_batch": arrives(given, F.col(S.SEQ) % 4 == 0)})

    def run(stream, root):
        return L.run_to_sink(L.verdict_stream(
            stream.where("event = 'candidate'"), stream.where("event = 'verdict'"), f"{width + width // 4 + 600} seconds", width,
            shards=shards),
            f"{root}/out", f"{root}/ckpt")

    root = _replayed(spark, own.unionByName(verdicts), batches, run)
    out = spark.read.schema(L.EVENT_SCHEMA).parquet(f"{root}/out").where("not late")
    return out.select(
        S.SEQ, "event", "Status", F.col(S.CREATED).cast("timestamp_ntz").alias(S.CREATED), r6("transaction_amount"),
        "live_txn_count_10min", "live_txn_count_1hour", r6("live_time_since_last"), "session_count", r6("session_month_spending"))


def q_live_resumed(spark, sf):
    """A stream over the later half of the time that begins with
    the state which the earlier half leaves; its rows are those of a stream
    over all."""
    from acctsentry.streaming import live as L

    txn = _events(spark, sf)
    early, late = txn.agg(F.min(S.CREATED), F.max(S.CREATED)).first()
    if early is None:
        return L.approved_velocity(txn).select(
            S.SEQ, "live_txn_count_10min", "live_txn_count_1hour", r6("live_time_since_last"), "session_count", r6("session_month_spending"))
    since = (early + (late - early) / 2).replace(microsecond=0)
    history = L.history_state(txn.where(F.col(S.CREATED) < F.lit(since)), str(since)).checkpoint(eager=True)
    later = txn.where(F.col(S.CREATED) >= F.lit(since)).withColumn("_batch", F.lit(0))
    root = _replayed(spark, later, 1, lambda stream, root: L.run_to_sink(
        L.live_state_stream(stream, "1 hour", history), f"{root}/out", f"{root}/ckpt"))
    return L.judged(spark.read.schema(L.LIVE_SCHEMA).parquet(f"{root}/out")).select(
        S.SEQ, "live_txn_count_10min", "live_txn_count_1hour", r6("live_time_since_last"), "session_count", r6("session_month_spending"))


def q_decision_log(spark, sf):
    """The decision log written (append, by date) and read back."""
    from acctsentry.session import scratch_path
    from acctsentry.sources.decision_log import read_log, write_log

    decided = _rule_rows(spark, sf).withColumn("is_fraud", F.col("violated"))
    path = scratch_path(spark, "decision-log")
    write_log(PR.decision_log_from(decided), path)
    log = read_log(spark, path)
    return log.select("CustomerID", "FromAccountNo", r6("Amount"), "Type", "Status",
                      F.col("Timestamp").cast("timestamp_ntz").alias("Timestamp"))


def q_transactions_csv(spark, sf):
    """Transfers written as CSV in another column order, without ``seq``
    and without the country, in file order; read back by header name, numbered
    and coerced by conform() (dates and amounts from text)."""
    from acctsentry.session import scratch_path
    from acctsentry.sources.transactions import read_transactions

    path = scratch_path(spark, "txn-csv")
    txn = _events(spark, sf).repartitionByRange(4, S.SEQ).sortWithinPartitions(S.SEQ).select(
        S.CREATED, S.CHANNEL, S.CUSTOMER, S.TRANSFER_TYPE, S.ACCOUNT, S.AMOUNT, S.BENEFICIARY)
    (txn.write.mode("overwrite").option("header", True)
        .option("timestampFormat", "yyyy-MM-dd HH:mm:ss").csv(path))
    back = read_transactions(spark, path, fmt="csv")
    return back.select(
        F.col(S.SEQ), S.CUSTOMER, S.ACCOUNT, S.BENEFICIARY, r6(S.AMOUNT), S.TRANSFER_TYPE, S.CHANNEL, S.COUNTRY,
        F.col(S.CREATED).cast("timestamp_ntz").alias(S.CREATED),
    )


def q_decision_log_csv(spark, sf):
    """A log in the published layout (no account), read by header name."""
    from acctsentry.session import scratch_path
    from acctsentry.sources.decision_log import read_log

    path = scratch_path(spark, "log-csv")
    log = PR.decision_log_from(_rule_rows(spark, sf).withColumn("is_fraud", F.col("violated")))
    (log.select("CustomerID", "Amount", "Type", "Status", "Timestamp").write.option("header", True)
        .option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(path))
    back = read_log(spark, path, fmt="csv")
    return back.select("CustomerID", "FromAccountNo", r6("Amount"), "Type", "Status",
                       F.col("Timestamp").cast("timestamp_ntz").alias("Timestamp"), F.col("log_date").cast("string").alias("log_date"))


def q_feature_table(spark, sf):
    return _feature_cols(spark, sf, "events", FEATURE_TABLE_COLS)


def q_feature_table_stored(spark, sf):
    """The feature table written in two versions, and read back past a path that isn't there."""
    from acctsentry.session import scratch_path
    from acctsentry.sources.transactions import read_feature_table, write_feature_table

    path = scratch_path(spark, "features")
    table = _features(spark, sf, "events").checkpoint(eager=True)
    write_feature_table(table.limit(10), path)
    write_feature_table(table, path)
    return _rounded_features(read_feature_table(spark, scratch_path(spark, "none"), path), FEATURE_TABLE_COLS)


def q_feature_table_lineitem(spark, sf):
    return _feature_cols(spark, sf, "lineitem", FEATURE_TABLE_COLS)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "row_features": q_row_features,
    "channel_codes": q_channel_codes,
    "account_stats": q_account_stats,
    "customer_stats": q_customer_stats,
    **{name: _make_feature_query(view, cols) for name, (view, cols) in BUCKET_COLS.items()},
    "transactions_csv": q_transactions_csv,
    "decision_log_csv": q_decision_log_csv,
    "feature_table": q_feature_table,
    "feature_table_lineitem": q_feature_table_lineitem,
    "feature_table_stored": q_feature_table_stored,
    **{f"feature_table_{view}": _make_feature_query(view, FEATURE_TABLE_COLS[1:]) for view in ("dirty", "keyless", "dateless")},
    "rule_decisions_dirty": q_rule_decisions_dirty,
    "profile_dirty": q_profile_dirty,
    "approved_velocity_dirty": q_approved_velocity_dirty,
    "account_profile": q_account_profile,
    "month_to_date": q_month_to_date,
    "history_totals": q_history_totals,
    "account_list": q_account_list,
    "customer_list": q_customer_list,
    "limits_by_type": q_limits_by_type,
    "rule_decisions": q_rule_decisions,
    "decision_log": q_decision_log,
    "scaler_stats": q_scaler_stats,
    "scaled_features": q_scaled_features,
    "approved_velocity": q_approved_velocity,
    "live_stream": q_live_stream,
    "iforest_scores": q_iforest_scores,
    "iforest_report": q_iforest_report,
    "ae_scores": q_ae_scores,
    "ae_threshold_report": q_ae_threshold_report,
    "hybrid_decisions": q_hybrid_decisions,
    "model_checks": q_model_checks,
    "missing_features": q_missing_features,
    "live_decisions": q_live_decisions,
    "iforest_rule_scores": q_iforest_rule_scores,
    "ae_rule_scores": q_ae_rule_scores,
    "hybrid_rule_decisions": q_hybrid_rule_decisions,
    "decision_log_stream": q_decision_log_stream,
    "live_hybrid": q_live_hybrid,
    "live_verdicts": q_live_verdicts,
    "live_resumed": q_live_resumed,
}
