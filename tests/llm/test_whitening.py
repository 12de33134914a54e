"""Whitening: against a plain eigensolver, and its solver on hard spectra."""

import math

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from acctsentry.llm.qd_svd import dqds, right_singular
from acctsentry.llm.queries import QUERIES
from acctsentry.llm.whitening import fit_whitening, identity_error, whiten
from tests.conftest import SF_MID


def plain(vectors, k=8):
    """n, exact deviations, whitened up to signs, explained."""
    x = [[math.floor(1024 * float(c)) + 100000 for c in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    dev = [sum((n * a - s) ** 2 for a, s in zip(row, sums)) for row in x]
    centred = np.array([[n * a - s for a, s in zip(row, sums)] for row in x], float) / n
    values, w = np.linalg.eigh(centred.T @ centred / n)
    values, w = values[::-1], w[:, ::-1]
    return n, dev, centred @ w[:, :k] / np.sqrt(values[:k]), values[:k] / values.sum()


def test_query(spark):
    rows = pq.read_table(f"{SF_MID}/embeddings.parquet").to_pylist()
    n, dev, white, explained = plain([r["embedding"] for r in rows])
    got = QUERIES["op13_whitening"](spark, SF_MID).toPandas()
    assert len(got) == 8 * len(rows) and set(got["n"]) == {n}
    assert got["identity_error"].nunique() == 1 and 0 <= got["identity_error"].iloc[0] < 1e-10
    at = {r["vec_id"]: i for i, r in enumerate(rows)}
    assert (got["deviation"] == got["vec_id"].map(lambda v: dev[at[v]])).all()
    table = got.assign(i=got["vec_id"].map(at)).pivot(index="i", columns="component", values="whitened").to_numpy()
    sign = np.sign((table * white).sum(0))
    assert np.abs(table * sign - white).max() < 1e-8
    assert np.allclose(got.drop_duplicates("component").sort_values("component")["explained"], explained, rtol=1e-10)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, [float(i % 5), i * 0.37, -i * i / 64]) for i in range(40)]
    bad = [(100, None), (101, [1.0, None, 2.0]), (102, [nan, 1.0, 1.0]), (103, [1.0, -inf, 1.0]), (104, []), (105, [1.0, 2.0]), (106, [1e300, 0.0, 0.0])]
    rows = good + bad + [(None, [1.0, 2.0, 3.0]), (7, good[7][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns(
        {"N": F.lit(1), "v": F.lit("v"), "Whitened": F.lit(2), "p": F.lit(3)})
    model = fit_whitening(df)
    out = whiten(df, model)
    assert out.columns == ["vec_id", "v", "p", "component", "n", "deviation", "whitened", "explained"]
    got = out.toPandas()
    used = [r[1] for r in rows if r not in bad]
    n, dev, white, explained = plain(used, 3)
    assert len(got) == 3 * n and (got["n"] == n).all() and got["vec_id"].isna().sum() == 3
    assert sorted(got.loc[got["component"] == 1, "deviation"]) == sorted(dev)
    for c in (1, 2, 3):
        assert np.allclose(sorted(got.loc[got["component"] == c, "whitened"].abs()), sorted(np.abs(white[:, c - 1])), atol=1e-7)
    assert identity_error(df, model) < 1e-9
    for none in (df.limit(0), df.where("vec_id >= 100"), df.where("vec_id = 7")):
        assert whiten(none.where("coalesce(size(embedding), 3) <> 2"), fit_whitening(none.where("coalesce(size(embedding), 3) <> 2"))).count() == 0


def test_large_entries_and_rank(spark):
    """Deviations stay exact beyond 64 bits' squares; constant and repeated dimensions give no direction."""
    rows = [(i, [1e9 * (i % 3), 5.0, 1e9 * (i % 3), float(i)]) for i in range(9)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    model = fit_whitening(df)
    assert len(model.values) == 2
    got = {r.vec_id: r.deviation for r in whiten(df, model).where("component = 1").collect()}
    _, dev, *_ = plain([r[1] for r in rows], 2)
    assert got == {i: d if d < 2**63 else None for (i, _), d in zip(rows, dev)}


def shaped(squares, seed):
    rng = np.random.default_rng(seed)
    d = len(squares)
    p, q = (np.linalg.qr(rng.normal(size=(d, d)))[0] for _ in range(2))
    return np.linalg.qr((p * np.sqrt(squares)) @ q, mode="r")


@pytest.mark.parametrize("squares", [
    np.ones(12), np.zeros(5), np.r_[np.ones(9) * 4, np.ones(9)], 10.0 ** -np.arange(24), 1 + np.arange(30) * 1e-10,
    np.r_[1 + np.arange(10) * 1e-6, 2 + np.arange(10) * 1e-13], np.r_[100, np.ones(40) + np.arange(40) * 1e-4], [3.0], [2.0, 2.0],
    np.r_[np.arange(1, 20), np.zeros(6)]], ids=str)
def test_solver(squares):
    r = shaped(np.asarray(squares, float), 5)
    got, w = right_singular(r, len(r))
    top = max(np.max(squares), 1e-300)
    assert np.abs(got - np.sort(squares)[::-1]).max() <= 1e-13 * top
    assert np.abs(w.T @ w - np.eye(len(r))).max() < 1e-11
    assert np.abs(r.T @ (r @ w) - w * got).max() <= 1e-13 * top


def test_small_values_keep_their_digits():
    """dqds on a graded bidiagonal: relative accuracy down to 1e-40."""
    from fractions import Fraction

    a, b = 10.0 ** -np.arange(0, 20, 2.0), 10.0 ** -np.arange(1, 19, 2.0) / 3
    got = dqds(a, b)

    def below(x):  # exact count of eigenvalues of B'B below x
        n, d = 0, Fraction(a[0]) ** 2 - x
        for i in range(1, len(a)):
            n += d < 0
            d = Fraction(a[i]) ** 2 + Fraction(b[i - 1]) ** 2 - x - (Fraction(a[i - 1]) * Fraction(b[i - 1])) ** 2 / d
        return n + (d < 0)

    for k, v in enumerate(got[::-1]):
        assert below(Fraction(v) * (1 - Fraction(1, 10**13))) <= k < below(Fraction(v) * (1 + Fraction(1, 10**13)))
