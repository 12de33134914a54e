"""The package without its optional subpackage, and joins and ranks that spread hot keys."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from acctsentry.operators.skew import PART_ROWS, join_spread, ranked

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("gone", [("acctsentry/llm", "tests/llm"), ("acctsentry/llm", "tests/llm", "corpus_pipeline.py")])
def test_entry_without_the_subpackage(tmp_path, gone):
    """What is left imports, and registers its own queries with their SQL; its tests are collected."""
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=lambda d, names: [
        n for n in names if n in (".git", "__pycache__", ".pytest_cache") or os.path.relpath(os.path.join(d, n), ROOT) in gone])
    code = ("import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); import acctsentry.plans.queries as p; "
            "assert set(p.QUERIES) <= set(q) and set(s) <= set(q); print(sorted(set(q) - set(p.QUERIES)))")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    said = subprocess.run([sys.executable, "-c", code], cwd=copy, env=env, capture_output=True, text=True, timeout=120)
    assert said.returncode == 0, said.stderr[-2000:]
    more = said.stdout.strip().splitlines()[-1]
    assert "pipeline" not in more and (more == "[]") == ("acctsentry/llm" in gone)
    found = subprocess.run([sys.executable, "-m", "pytest", "--collect-only", "-q", "tests"], cwd=copy, env=env, capture_output=True, text=True, timeout=120)
    assert found.returncode == 0, found.stdout[-2000:]


def by_task(df, on):
    return sorted(r[0] for r in df.groupBy(F.spark_partition_id()).count().select("count").collect())


def test_hot_key_spreads(spark):
    """A third of all rows in one key: the largest task has three times the median at most."""
    had = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = spark.range(120_000).select("id", F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 5000).alias("k"))
        table = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("top")).checkpoint(eager=True)
        out = join_spread(rows, table, ["k"], "n", F.col("id")).checkpoint(eager=True)
        sizes = by_task(out, "k")
        assert len(sizes) == 32 and sizes[-1] <= 3 * sizes[16]
        assert sorted(out.columns) == ["id", "k", "n", "top"]
        plain = rows.join(table, "k").groupBy().agg(F.count("*"), F.sum("top"), F.sum(F.hash("id", "k", "n")))
        assert out.groupBy().agg(F.count("*"), F.sum("top"), F.sum(F.hash("id", "k", "n"))).first() == plain.first()
    finally:
        for k, v in had.items():
            spark.conf.set(k, v)


def test_spread_join_keeps_rows_without_partner(spark):
    rows = spark.createDataFrame([(1, None), (2, 5), (3, 6)] + [(10 + i, 7) for i in range(3 * PART_ROWS)], "id long, k long")
    table = spark.createDataFrame([(5, 1, "a"), (7, 3 * PART_ROWS, "hot")], "k long, n long, v string").checkpoint(eager=True)
    out = join_spread(rows, table, ["k"], "n", F.col("id"), "left")
    assert out.count() == rows.count()
    assert {(r.id, r.v) for r in out.where("id < 10").collect()} == {(1, None), (2, "a"), (3, None)}
    assert out.where("v = 'hot'").count() == 3 * PART_ROWS
    assert join_spread(rows.limit(0), table, ["k"], "n", F.col("id")).count() == 0
    assert join_spread(rows, table.limit(0).checkpoint(eager=True), ["k"], "n", F.col("id")).count() == 0


def test_ranks_over_partitions(spark):
    """Ranks of a group that fills most ranges, of equal rows, and of NULL groups."""
    rows = [(1, i % 100) for i in range(3000)] + [(None, None)] * 50 + [(2, i) for i in range(20)] + [(3, None), (3, 1)]
    out = ranked(spark.createDataFrame(rows, "g long, v long").repartition(6), ["g"], ["v"]).collect()
    for g in (1, 2, 3, None):
        own = sorted((r.rank, (r.v is not None, r.v or 0)) for r in out if r.g == g)
        assert [k for k, _ in own] == list(range(1, len(own) + 1)) and [v for _, v in own] == sorted(v for _, v in own)
    assert sorted(r["rank"] for r in ranked(spark.range(500), [], ["id"]).collect()) == list(range(1, 501))
    assert ranked(spark.range(0), [], ["id"]).count() == 0
