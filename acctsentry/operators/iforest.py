"""Isolation forest (M3-M5, A17) on Spark.

Training: one pass draws a pool of rows by a hash, whose size the parameters
fix; each tree gets ``psi = min(256, n)`` of them without replacement, by the
rank of ``xxhash64(seq, tree, seed)``.  Every tree is grown in its own
``applyInPandas`` group (psi rows, bounded).  The node table (trees x at most
2 psi - 1 nodes, a bound fixed by the parameters) is small enough to ship to
every task, and scoring runs vectorised with ``mapInPandas``.

Scores follow the isolation forest paper (Liu, Ting, Zhou 2008): path length
plus c(leaf size), normalised by c(psi).  The decision value is
``score_samples - offset`` with the offset at the contamination quantile of
the training scores; negative means anomaly (prediction -1).
"""

from __future__ import annotations

import logging
import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acctsentry import schema as S
from acctsentry.operators.artifacts import if_there
from acctsentry.operators.quantile import exact_quantile
from acctsentry.session import checkpoint_root

logger = logging.getLogger(__name__)

NODE_SCHEMA = T.StructType(
    [
        T.StructField("tree", T.IntegerType()),
        T.StructField("node", T.IntegerType()),
        T.StructField("feature", T.IntegerType()),  # -1 for a leaf
        T.StructField("split", T.DoubleType()),
        T.StructField("left", T.IntegerType()),
        T.StructField("right", T.IntegerType()),
        T.StructField("size", T.LongType()),
        T.StructField("depth", T.IntegerType()),
    ]
)

EULER_GAMMA = 0.5772156649015329


def avg_path_length(n: np.ndarray | float) -> np.ndarray:
    """c(n): average path length of an unsuccessful BST search."""
    n = np.asarray(n, dtype=float)
    out = np.zeros_like(n)
    two = n == 2
    big = n > 2
    out[two] = 1.0
    nb = n[big]
    out[big] = 2.0 * (np.log(nb - 1.0) + EULER_GAMMA) - 2.0 * (nb - 1.0) / nb
    return out


@dataclass
class Forest:
    nodes: pd.DataFrame  # NODE_SCHEMA rows
    features: list[str]
    psi: int
    offset: float
    contamination: float
    n_estimators: int
    n_samples: int

    def arrays(self):
        """Padded (trees x nodes) arrays for vectorised traversal."""
        nd = self.nodes
        trees = int(nd["tree"].max()) + 1
        width = int(nd["node"].max()) + 1
        feat = np.full((trees, width), -1, dtype=np.int64)
        split = np.zeros((trees, width))
        left = np.zeros((trees, width), dtype=np.int64)
        right = np.zeros((trees, width), dtype=np.int64)
        size = np.zeros((trees, width))
        depth = np.zeros((trees, width))
        t, n = nd["tree"].to_numpy(), nd["node"].to_numpy()
        feat[t, n] = nd["feature"].to_numpy()
        split[t, n] = nd["split"].to_numpy()
        left[t, n] = nd["left"].to_numpy()
        right[t, n] = nd["right"].to_numpy()
        size[t, n] = nd["size"].to_numpy()
        depth[t, n] = nd["depth"].to_numpy()
        return feat, split, left, right, size, depth


    def scorer(self):
        """A function from a matrix of scaled rows to their scores."""
        arrays, denom = self.arrays(), float(avg_path_length(np.array([self.psi]))[0]) or 1.0

        def score(X: np.ndarray) -> np.ndarray:
            mean_path = _path_lengths(X, arrays).mean(axis=1) if len(X) else np.zeros(0)
            return -np.power(2.0, -mean_path / denom)

        return score


def missing_features(matrix: DataFrame, features: list[str], model: str) -> list[str]:
    """M2: features that the rows lack; a model gives such rows no score."""
    missing = [f for f in features if f not in matrix.columns]
    if missing:
        logger.warning("%s: no score, %d features are missing: %s", model, len(missing), missing[:5])
    return missing


def _grow(pdf: pd.DataFrame, features: list[str], psi: int, seed: int) -> pd.DataFrame:
    tree = int(pdf["tree"].iloc[0])
    X = pdf[features].to_numpy(dtype=float)
    rng = np.random.default_rng([seed, tree])
    max_depth = int(math.ceil(math.log2(max(psi, 2))))
    rows = []
    # (node id, row indices, depth); children get ids in creation order
    stack = [(0, np.arange(len(X)), 0)]
    next_id = 1
    while stack:
        node, idx, d = stack.pop()
        sub = X[idx]
        if d >= max_depth or len(idx) <= 1:
            rows.append((tree, node, -1, 0.0, -1, -1, len(idx), d))
            continue
        lo, hi = sub.min(axis=0), sub.max(axis=0)
        usable = np.flatnonzero(hi > lo)
        if usable.size == 0:
            rows.append((tree, node, -1, 0.0, -1, -1, len(idx), d))
            continue
        f = int(usable[rng.integers(usable.size)])
        split = float(rng.uniform(lo[f], hi[f]))
        go_left = sub[:, f] <= split
        lid, rid = next_id, next_id + 1
        next_id += 2
        rows.append((tree, node, f, split, lid, rid, len(idx), d))
        stack.append((rid, idx[~go_left], d + 1))
        stack.append((lid, idx[go_left], d + 1))
    return pd.DataFrame(rows, columns=[f.name for f in NODE_SCHEMA.fields])


#: Rows of the pool that trees draw from, as a multiple of a tree's rows.
POOL = 64


def sample_pool(matrix: DataFrame, n: int, psi: int, seed: int) -> DataFrame:
    """About ``POOL * psi`` rows of the table (all, if it has fewer), drawn by a
    hash of ``seq`` in one pass and kept: its size doesn't follow the table's."""
    unit = F.pmod(F.xxhash64(F.lit(seed), S.SEQ), F.lit(1 << 53)) / float(1 << 53)
    checkpoint_root(matrix.sparkSession)
    return matrix.where(unit < F.lit(POOL * psi / max(n, 1))).checkpoint(eager=True)


def tree_samples(pool: DataFrame, psi: int, n_trees: int, seed: int) -> DataFrame:
    """(tree, features...): for each tree ``psi`` rows of the pool, by rank of a hash."""
    drawn = pool.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(n_trees - 1)))).withColumn(
        "_h", F.xxhash64(S.SEQ, "tree", F.lit(seed)))
    rank = F.row_number().over(Window.partitionBy("tree").orderBy("_h", S.SEQ))
    return drawn.withColumn("_r", rank).where(F.col("_r") <= psi).drop("_r", "_h")


def train_iforest(
    matrix: DataFrame,
    features: list[str] = S.MODEL_FEATURES,
    n_estimators: int = S.IFOREST_TREES,
    contamination: float = S.IFOREST_CONTAMINATION,
    max_samples: int = S.IFOREST_MAX_SAMPLES,
    seed: int = S.IFOREST_SEED,
) -> Forest:
    """M3 on a scaled matrix with ``seq`` and the feature columns."""
    n = matrix.count()
    psi = min(max_samples, n)
    nodes = (
        tree_samples(sample_pool(matrix, n, psi, seed), psi, n_estimators, seed)
        .select("tree", *features)
        .groupBy("tree")
        .applyInPandas(lambda pdf: _grow(pdf, features, psi, seed), NODE_SCHEMA)
        .toPandas()  # bounded: n_estimators x (2 psi - 1) rows
    )
    forest = Forest(nodes, list(features), psi, 0.0, contamination, n_estimators, n)
    scored = score_samples(matrix, forest, keep=[]).checkpoint(eager=True)
    forest.offset = exact_quantile(scored, "score_sample", contamination)
    return forest


def _path_lengths(X: np.ndarray, arrays) -> np.ndarray:
    """Path length of each row in each tree. Nodes of all trees have one
    number, and a leaf is its own child, so each level is a few plain gathers."""
    feat, split, left, right, size, depth = arrays
    trees, width = feat.shape
    base = np.arange(trees)[:, None] * width
    own = base + np.arange(width)
    inner = feat >= 0
    f = np.where(inner, feat, 0).ravel()
    at = np.where(inner, split, np.inf).ravel()
    children = np.stack([np.where(inner, base + right, own).ravel(), np.where(inner, base + left, own).ravel()], axis=1).ravel()
    ends = (depth + avg_path_length(size)).ravel()
    start, columns = np.arange(len(X))[:, None] * X.shape[1], np.ascontiguousarray(X).ravel()
    node = np.broadcast_to(base.ravel(), (len(X), trees))
    for _ in range(int(depth.max())):  # a leaf's depth: the steps that lead to it
        go_left = columns.take(start + f.take(node)) <= at.take(node)
        node = children.take(2 * node + go_left)
    return ends.take(node)


def as_matrix(batch: pa.RecordBatch, features: list[str]) -> np.ndarray:
    """A batch's features as rows of doubles (NULL: no number)."""
    return np.column_stack([batch.column(f).to_numpy(zero_copy_only=False).astype(float, copy=False) for f in features])


def with_values(rows: DataFrame, keep: list[str], values: Callable[[pa.RecordBatch], dict[str, np.ndarray | None]], schema: T.StructType) -> DataFrame:
    """Columns ``keep`` of the rows, as they are, and the doubles that ``values``
    makes of each batch (None: NULL). What is kept never becomes Python objects."""
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                made = [pa.nulls(batch.num_rows, pa.float64()) if v is None else pa.array(v, pa.float64()) for v in values(batch).values()]
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], *made], names=schema.names)

    return rows.mapInArrow(run, schema)


def score_samples(matrix: DataFrame, forest: Forest, keep: list[str] | None = None) -> DataFrame:
    """``score_sample`` = -2^(-E[h(x)] / c(psi)) (higher is more normal)."""
    feats = forest.features
    keep = keep if keep is not None else [c for c in matrix.columns]
    if missing_features(matrix, feats, "isolation forest"):
        return matrix.select(*keep, F.lit(None).cast("double").alias("score_sample"))
    score = forest.scorer()
    out_schema = T.StructType([matrix.schema[c] for c in keep] + [T.StructField("score_sample", T.DoubleType())])

    return with_values(matrix.select(*dict.fromkeys([*keep, *feats])), keep, lambda batch: {"score_sample": score(as_matrix(batch, feats))}, out_schema)


def score_iforest(matrix: DataFrame, forest: Forest, keep: list[str] | None = None) -> DataFrame:
    """M4: decision value, prediction (-1 anomaly, 1 normal), flag, reason."""
    scored = score_samples(matrix, forest, keep)
    decision = F.col("score_sample") - F.lit(forest.offset)
    anomaly = decision < 0
    return scored.select(
        "*",
        decision.alias("anomaly_score"),
        F.when(anomaly, F.lit(-1)).otherwise(F.lit(1)).alias("prediction"),
        anomaly.alias("is_anomaly"),
        F.when(anomaly, F.concat(F.lit("Isolation Forest anomaly: score="),
                                 F.call_function("format_number", decision, F.lit("0.0000")))).alias("reason"),
    ).drop("score_sample")


def iforest_report(scored: DataFrame, forest: Forest) -> DataFrame:
    """One-row training report."""
    return scored.agg(
        F.count(F.lit(1)).alias("n_samples"),
        F.count_if(F.col("prediction") == -1).alias("anomaly_count"),
    ).select(
        "n_samples",
        F.lit(len(forest.features)).cast("long").alias("n_features"),
        "anomaly_count",
        (F.col("anomaly_count") / F.col("n_samples")).alias("anomaly_rate"),
        F.lit(forest.contamination).alias("contamination"),
        F.lit(forest.n_estimators).cast("long").alias("n_estimators"),
    )


def validate_iforest(scored: DataFrame, expected_rate: float, tolerance: float = 0.02) -> float:
    """M5: anomaly rate on the first min(1000, n) rows (file order) must be
    within ``tolerance`` of the training rate; returns the sample rate."""
    sample = scored.orderBy(S.SEQ).limit(1000)
    rate = sample.agg(F.avg((F.col("prediction") == -1).cast("double")).alias("r")).first()["r"]
    if rate is None or abs(rate - expected_rate) > tolerance:
        raise ValueError(f"the sample's share of anomalies is {rate}; the training's was {expected_rate}")
    return float(rate)


def save_forest(spark, forest: Forest, path: str) -> None:
    """Node table and one metadata row, as parquet."""
    spark.createDataFrame(forest.nodes, NODE_SCHEMA).write.mode("overwrite").parquet(f"{path}/nodes")
    meta = spark.createDataFrame(
        [(forest.features, forest.psi, forest.offset, forest.contamination, forest.n_estimators, forest.n_samples)],
        "features array<string>, psi int, offset double, contamination double, n_estimators int, n_samples long",
    ).withColumn("trained_at", F.current_timestamp())
    meta.write.mode("overwrite").parquet(f"{path}/meta")


def load_forest(spark, path: str) -> Forest | None:
    """S8 read; a missing artifact gives None (leg off)."""
    tables = if_there(lambda: (spark.read.parquet(f"{path}/meta"), spark.read.parquet(f"{path}/nodes")))
    if tables is None:
        return None
    m, nodes = tables[0].first(), tables[1].toPandas()
    return Forest(nodes, list(m["features"]), m["psi"], m["offset"], m["contamination"],
                  m["n_estimators"], m["n_samples"])
