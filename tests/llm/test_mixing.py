"""Mixing: targets by a plain loop, sums against every subset, edge cases."""

import itertools
from fractions import Fraction

import numpy as np
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from acctsentry.llm.mixing import fit_counts, knapsack, mix_sources
from acctsentry.llm.queries import QUERIES
from tests.conftest import SF_MID
from tests.llm.brute import BLANK_WORD


def plain_targets(sizes):
    """sizes: source -> words; the targets, in exact fractions."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, stopped = Fraction(3, 2) * sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in stopped]
        rest = total - sum(2 * sizes[s] for s in stopped)
        part = {s: rest * weight[s] / sum(weight[f] for f in free) for s in free}
        above = {s for s in free if part[s] > 2 * sizes[s]}
        if not above:
            return part | {s: Fraction(2 * sizes[s]) for s in stopped}
        stopped |= above


def by_source(rows):
    out = {}
    for r in rows:
        out.setdefault(r["source"], []).append(r)
    return out


def check(rows):
    """Rows with source, size, source_size, target and taken keep to the contract."""
    groups = by_source(rows)
    sizes = {s: sum(r["size"] for r in g) for s, g in groups.items()}
    for s, want in plain_targets(sizes).items():
        g = groups[s]
        assert {r["source_size"] for r in g} == {sizes[s]}
        assert {r["target"] for r in g} == {float(want)}
        assert all(r["taken"] in (0, r["size"], 2 * r["size"]) for r in g)
        # takes are of one or two passes next to each other
        taken = sum(r["taken"] for r in g)
        longest = max(r["size"] for r in g)
        assert abs(taken - want) <= longest
        if len(g) <= 12:
            whole = int(want // sizes[s]) * sizes[s] if sizes[s] else 0
            best = min(abs(whole + sum(x) - want) for n in range(len(g) + 1)
                       for x in itertools.combinations([r["size"] for r in g], n))
            assert abs(taken - want) <= best + 1


def test_query(spark):
    docs = {d["doc_id"]: d for d in pq.read_table(f"{SF_MID}/documents.parquet").to_pylist()}
    got = [r.asDict() for r in QUERIES["op11_mixing"](spark, SF_MID).collect()]
    assert sorted(r["doc_id"] for r in got) == sorted(docs)
    for r in got:
        assert r["size"] == len(BLANK_WORD.findall(docs[r["doc_id"]]["text"] or ""))
        r["source"] = docs[r["doc_id"]]["source"]
    check(got)
    again = QUERIES["op11_mixing"](spark, SF_MID).collect()
    assert sorted(map(tuple, again)) == sorted(tuple(r[c] for c in again[0].asDict()) for r in got)


def test_edges(spark):
    rows = ([(i, "w " * (i % 7 + 1), "b", i) for i in range(10)] + [(100 + i, "x y z", None, i) for i in range(3)]
            + [(200, None, "a", 0), (201, "", "a", 0), (202, " \t\n", "a", 0), (None, "null id", "c", 1)]
            + [(300, "same row", "c", 1)] * 4 + [(301, "long " * 50_000, "c", 2), (302, "x", "", 3)])
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, Taken int")
    docs = docs.withColumns({"s": F.lit("s"), "rank": F.lit(1), "n": F.lit(2), "words": F.lit(None).cast("int")})
    out = mix_sources(docs)
    assert out.columns == ["doc_id", "text", "source", "s", "rank", "n", "words", "size", "source_size", "target", "taken"]
    got = [r.asDict() for r in out.collect()]
    assert sorted(str((r["doc_id"], r["text"], r["source"])) for r in got) == sorted(str(r[:3]) for r in rows)
    assert all(r["size"] == len(BLANK_WORD.findall(r["text"] or "")) for r in got)
    check(got)
    assert mix_sources(docs.limit(0)).count() == 0
    empty = mix_sources(docs.where("source = 'a'")).collect()
    assert [(r.size, r.source_size, r.target, r.taken) for r in empty] == [(0, 0, 0.0, 0)] * 3


def test_hot_length_spreads(spark):
    """A third of all rows of one source and length: exactly the planned number is taken."""
    docs = spark.range(30_000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "one two three").otherwise(F.repeat(F.lit("w "), (F.col("id") % 40).cast("int"))).alias("text"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 5).cast("string"))).alias("source"))
    check([r.asDict() for r in mix_sources(docs, ["source"]).collect()])


def test_knapsack_against_all_subsets():
    rng = np.random.default_rng(3)
    for _ in range(200):
        length = rng.choice(np.arange(1, 40), rng.integers(1, 5), replace=False)
        count = rng.integers(1, 4, len(length))
        budget = int(rng.integers(0, (length * count).sum() + 3))
        taken = knapsack(length, count, budget)
        assert (taken >= 0).all() and (taken <= count).all()
        sums = {0}
        for x, n in zip(length, count):
            sums = {s + k * int(x) for s in sums for k in range(n + 1)}
        assert abs(int((taken * length).sum()) - budget) == min(abs(s - budget) for s in sums)


def test_fit_counts_large():
    rng = np.random.default_rng(4)
    length = np.arange(1, 30_000)
    count = rng.integers(0, 2000, len(length))
    for part in (0.0001, 0.3, 0.77, 0.9999):
        budget = int((length * count).sum() * part)
        taken = fit_counts(length, count, budget)
        assert (taken >= 0).all() and (taken <= count).all() and int((taken * length).sum()) == budget
    assert (fit_counts(length, count, 10**15) == count).all()
