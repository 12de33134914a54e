"""Whitening of embeddings by a bidiagonal qd solver.

Tasks reduce their centred rows to one triangular factor each by blockwise QR,
the factors are merged in a tree, and the last one, d x d, is bidiagonalised:
dqds gives its singular values, twisted factorisations the directions.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from acctsentry.llm.common import col, materialized, others
from acctsentry.llm.qd_svd import right_singular

SCALE, SHIFT = 1024, 100_000
#: An entry of this size or more has no whole number that doubles hold exactly; it counts as not finite.
LIMIT = float(1 << 42)
#: Partial results that one task of the merging tree takes.
FAN = 8
#: Bytes of rows that are worked on at once.
BLOCK_BYTES = 8 << 20
COMPONENTS = 8


@dataclass
class Whitening:
    """Directions (columns) with their eigenvalues, and what rows are centred by."""

    n: int
    sums: list[int]
    values: np.ndarray
    directions: np.ndarray
    explained: np.ndarray


def usable(vector: Column) -> Column:
    """Vectors without null, infinite or missing entries."""
    return vector.isNotNull() & ~F.coalesce(F.exists(
        vector.cast("array<double>"), lambda c: c.isNull() | ~((c > -LIMIT) & (c < LIMIT))), F.lit(False))


def blocks(batches: Iterator[pa.RecordBatch], vec: str, dim: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of the batches with their whole numbers x (rows x dim)."""
    step = max(1, BLOCK_BYTES // (8 * dim))
    for batch in batches:
        for i in range(0, len(batch), step):
            part = batch.slice(i, step)
            if len(part):
                c = part.column(vec).flatten().to_numpy(zero_copy_only=False).reshape(len(part), dim)
                yield part, np.floor(c * SCALE).astype(np.int64) + SHIFT


def deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exact: 64-bit numbers where they suffice, Python's otherwise."""
    if n * int(np.abs(x).max(initial=0)) + max(map(abs, sums)) < 1 << 62:
        return x * n - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def squared(dev: np.ndarray) -> list[int | None]:
    """Exact sums of squares; None where no 64-bit number holds one."""
    if dev.dtype != object and int(np.abs(dev).max(initial=0)) ** 2 * dev.shape[1] < 1 << 63:
        return (dev * dev).sum(1).tolist()
    return [s if (s := sum(int(v) ** 2 for v in row)) < 1 << 63 else None for row in dev]


def merged(parts: DataFrame, merge: Callable[[list[bytes]], bytes]) -> bytes | None:
    """One value out of the partial ones (``p`` int, ``v`` binary), merged
    ``FAN`` at a time in tasks."""
    parts = materialized(parts)
    top = parts.agg(F.max("p")).first()[0]
    if top is None:
        return None

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("p")
        return pd.DataFrame({"p": [int(pdf["p"].iloc[0]) // FAN], "v": [merge([bytes(v) for v in pdf["v"]])]})

    while True:
        parts = parts.groupBy(F.floor(F.col("p") / FAN).cast("int").alias("g")).applyInPandas(run, "p int, v binary")
        top //= FAN
        if not top:
            return bytes(parts.first()["v"])


def per_task(vectors: DataFrame, fn: Callable[[Iterator[np.ndarray]], bytes], dim: int) -> DataFrame:
    """``fn`` of each task's blocks of x, as rows (p, v)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = blocks(batches, "v", dim)
        first = next(own, None)
        if first is not None:
            def rest() -> Iterator[np.ndarray]:
                yield first[1]
                yield from (x for _, x in own)
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([fn(rest())], pa.binary())], names=["p", "v"])

    return vectors.mapInArrow(run, "p int, v binary")


def triangle(rows: np.ndarray, dim: int) -> np.ndarray:
    """The dim x dim triangular factor of the rows."""
    r = np.linalg.qr(rows, mode="r")
    return np.vstack([r, np.zeros((dim - len(r), dim))]) if len(r) < dim else r


def dimension(valid: DataFrame) -> int | None:
    """The most frequent length of the vectors (of two as frequent, the longer one)."""
    found = valid.groupBy(F.size("v").alias("d")).count().where("d > 0").orderBy(F.desc("count"), F.desc("d")).first()
    return found["d"] if found else None


def fit_whitening(df: DataFrame, vec_col: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """The leading eigenvectors of the vectors' covariance; None without vectors.

    Entries c count as floor(1024 c) + 100000. A direction whose singular
    value is nothing but rounding (rank deficiency) is left out, so there may
    be fewer than ``components``. Two passes: exact sums, then QR factors.
    """
    valid = df.select(col(vec_col).cast("array<double>").alias("v")).where(usable(F.col("v")))
    dim = dimension(valid)
    if dim is None:
        return None
    valid = valid.where(F.size("v") == dim)

    def add(xs: Iterator[np.ndarray]) -> bytes:
        total = np.zeros(2 * dim + 1, np.int64)  # count, then high and low halves of the sums
        for x in xs:
            total[0] += len(x)
            total[1 : dim + 1] += (x >> 32).sum(0)
            total[dim + 1 :] += (x & 0xFFFFFFFF).sum(0)
        return total.tobytes()

    got = np.frombuffer(merged(per_task(valid, add, dim), lambda vs: sum(np.frombuffer(v, np.int64) for v in vs).tobytes()), np.int64)
    n = int(got[0])
    sums = [(int(h) << 32) + int(lo) for h, lo in zip(got[1 : dim + 1], got[dim + 1 :])]

    def reduce(xs: Iterator[np.ndarray]) -> bytes:
        r = np.zeros((0, dim))
        for x in xs:
            r = triangle(np.vstack([r, deviations(x, n, sums).astype(float) / n]), dim)
        return r.tobytes()

    def merge(vs: list[bytes]) -> bytes:
        return triangle(np.vstack([np.frombuffer(v).reshape(dim, dim) for v in vs]), dim).tobytes()

    r = np.frombuffer(merged(per_task(valid, reduce, dim), merge)).reshape(dim, dim)
    squares, w = right_singular(r, min(components, dim))
    some = np.sqrt(squares[: w.shape[1]]) > max(n, dim) * np.finfo(float).eps * math.sqrt(squares[0])
    k = int(some.sum())
    return Whitening(n, sums, squares[:k] / n, w[:, :k], squares[:k] / max(squares.sum(), np.finfo(float).tiny))


def identity_error(df: DataFrame, model: Whitening, vec_col: str = "embedding") -> float | None:
    """The largest absolute entry of the whitened vectors' covariance minus the
    identity. Tasks centre their own rows before they multiply; the merge adds
    what their means differ by."""
    dim, k = len(model.sums), len(model.values)
    if not k:
        return None
    valid = df.select(col(vec_col).cast("array<double>").alias("v")).where(usable(F.col("v")) & (F.size("v") == dim))

    def pack(n: float, mean: np.ndarray, m2: np.ndarray) -> bytes:
        return np.concatenate([[n], mean, m2.reshape(-1)]).tobytes()

    def merge(vs: list[bytes]) -> bytes:
        n, mean, m2 = 0.0, np.zeros(k), np.zeros((k, k))
        for v in vs:
            a = np.frombuffer(v)
            apart, both = a[1 : k + 1] - mean, n + a[0]
            m2 = m2 + a[k + 1 :].reshape(k, k) + np.outer(apart, apart) * (n * a[0] / both)
            mean, n = mean + apart * (a[0] / both), both
        return pack(n, mean, m2)

    def moments(xs: Iterator[np.ndarray]) -> bytes:
        done = []
        for x in xs:
            y = whitened(deviations(x, model.n, model.sums), model)
            mean = y.mean(0)
            done = [merge([*done, pack(len(y), mean, (y - mean).T @ (y - mean))])]
        return done[0]

    a = np.frombuffer(merged(per_task(valid, moments, dim), merge))
    return float(np.abs(a[k + 1 :].reshape(k, k) / a[0] - np.eye(k)).max())


def whitened(dev: np.ndarray, model: Whitening) -> np.ndarray:
    return (dev.astype(float) / model.n) @ model.directions / np.sqrt(model.values)


def whiten(df: DataFrame, model: Whitening | None, vec_col: str = "embedding", keep: list[str] | None = None) -> DataFrame:
    """One row per usable vector and component.

    Returns the ``keep`` columns (all but the vector, if not given) plus
    ``component`` (from 1, by falling eigenvalue), ``n``, ``deviation`` (the
    exact sum of squares of n x - S; NULL beyond a long), ``whitened`` and
    ``explained``. Columns of these names are replaced, whatever their case.

    Defined cases: vectors that are NULL or empty, hold a NULL, NaN, infinite
    or 2**42 and larger entry, or have another length than most have no rows
    and no part in the fit; repeated rows count and come out as often as they
    are there; NULL ids are kept; a table without usable vectors, or whose
    vectors are all equal (no direction varies), gives no rows. Of directions
    with equal eigenvalues any orthonormal ones are given.

    Scale: every pass is a scan of one column; tasks hand on one d x d factor
    each, and the driver sees the last one alone. No shuffle of rows.
    """
    added = ["component", "n", "deviation", "whitened", "explained"]
    free = others(df, *added)
    keep = [c for c in free if c != vec_col] if keep is None else [c for c in keep if c in free]
    kinds = {f.name: f.dataType for f in df.schema.fields}
    schema = T.StructType([T.StructField(c, kinds[c]) for c in keep] + [
        T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()), T.StructField("deviation", T.LongType()),
        T.StructField("whitened", T.DoubleType()), T.StructField("explained", T.DoubleType())])
    if model is None or not len(model.values):
        return df.sparkSession.createDataFrame([], schema)
    arrow, dim, k = to_arrow_schema(schema), len(model.sums), len(model.values)
    src = df.select(*[col(c).alias(f"k{i}") for i, c in enumerate(keep)], col(vec_col).cast("array<double>").alias("v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in blocks(batches, "v", dim):
            dev = deviations(x, model.n, model.sums)
            rows = pa.array(np.repeat(np.arange(len(part)), k))
            yield pa.RecordBatch.from_arrays(
                [part.column(i).take(rows).cast(arrow.field(i).type) for i in range(len(keep))]
                + [pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(part))),
                   pa.array(np.full(len(rows), model.n)), pa.array(squared(dev), pa.int64()).take(rows),
                   pa.array(whitened(dev, model).reshape(-1)), pa.array(np.tile(model.explained, len(part)))], schema=arrow)

    return src.where(usable(F.col("v")) & (F.size("v") == dim)).mapInArrow(run, schema)
