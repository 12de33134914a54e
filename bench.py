"""Headline timings at $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS]; prints one JSON line.

Each query is forced with the ``noop`` sink (full evaluation, no collect).
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)
# Python workers take the package from here too, whatever folder this is started from.
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH")]))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from acctsentry.session import get_spark

    spark = get_spark(
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": str(max(8, 2 * int(cpus))),
            "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "8g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    from acctsentry import schema as S
    from acctsentry.operators import autoencoder as AE
    from acctsentry.operators import features as FE
    from acctsentry.operators import iforest as IF
    from acctsentry.operators import profile as PR
    from acctsentry.operators.decision import decide, score_models
    from acctsentry.operators.scaler import apply_scaler, fit_scaler
    from acctsentry.plans import queries as Q
    from acctsentry.sources import views as V
    from acctsentry.streaming import live as L

    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.time()
        out = fn()
        times[name] = round(time.time() - t0, 3)
        return out

    def run(df):
        df.write.format("noop").mode("overwrite").save()

    txn = V.txn_events(spark, sf_dir)
    n_rows = txn.count()
    feats = FE.feature_table(txn)
    timed("feature_table", lambda: run(feats))
    timed("rule_decisions", lambda: run(PR.rule_decisions(FE.feature_table(txn))))
    matrix = timed("model_matrix", lambda: FE.model_matrix(FE.feature_table(txn)).checkpoint(eager=True))
    scaler = fit_scaler(matrix)
    scaled = timed("scaler", lambda: apply_scaler(matrix, scaler).checkpoint(eager=True))
    forest = timed("iforest_train", lambda: IF.train_iforest(scaled))
    timed("iforest_score", lambda: run(IF.score_iforest(scaled, forest, keep=[S.SEQ])))
    ae = timed("ae_train", lambda: AE.train_autoencoder(scaled))
    errs = timed("ae_score", lambda: AE.score_errors(scaled, ae, keep=[S.SEQ]).checkpoint(eager=True))
    cfg = AE.compute_threshold(errs)
    timed("ae_decide", lambda: run(AE.score_autoencoder(errs, cfg["threshold"])))
    # The product: features, rules and both models decide every transfer (models trained above).
    ae.threshold = cfg["threshold"]
    timed("hybrid_decisions", lambda: run(decide(score_models(PR.rule_decisions(FE.feature_table(txn)), scaler, forest, ae))))
    timed("approved_velocity", lambda: run(L.approved_velocity(txn)))
    timed("live_stream", lambda: run(Q.q_live_stream(spark, sf_dir)))
    timed("feature_table_lineitem", lambda: run(Q.q_feature_table_lineitem(spark, sf_dir)))

    total = round(sum(times.values()), 3)
    print(json.dumps({
        "metric": "total_sec_headline_queries",
        "value": total,
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
        "rows": n_rows,
        "feature_rows_per_sec": round(n_rows / times["feature_table"], 1),
        "decided_per_sec": round(n_rows / times["hybrid_decisions"], 1),
        "live_ms_per_transfer": round(1000 * times["live_stream"] / n_rows, 3),
        "ae_rounds": len(ae.history),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
