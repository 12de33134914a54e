"""The prefix trie against a plain dictionary of prefixes."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from acctsentry.llm.prefix_trie import prefix_trie, rebuilt
from acctsentry.llm.ternary import medians, prefix_totals
from tests.llm.brute import BLANK_WORD

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(rows, lead=True):
    """rows: (conv, turn, role, text), no two of a conversation with one turn."""
    own = {}
    for c, n, r, t in sorted((x for x in rows if x[0] is not None), key=lambda x: (x[0], x[1] is not None, x[1] or 0)):
        own.setdefault(c, []).append((r or "", t or ""))
    seqs = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4 if lead else 0
        seqs[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    nodes = {}
    for c, seq in seqs.items():
        for d in range(len(seq) + 1):
            nodes.setdefault(tuple(seq[:d]), []).append(c)
    kids, saved, leaves = {}, {}, {}
    for p in nodes:
        if p:
            kids[p[:-1]] = kids.get(p[:-1], 0) + 1
    for p, members in nodes.items():
        save = (len(members) - 1) * len(BLANK_WORD.findall(p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            saved[p[:d]] = saved.get(p[:d], 0) + save
            leaves[p[:d]] = leaves.get(p[:d], 0) + (p not in kids)
    return sorted(
        (min(m), len(p), str(min(nodes[p[:-1]]) if p else None), len(m), kids.get(p, 0), leaves[p], saved[p],
         hashlib.sha256(",".join(str(c) for c in sorted(m) if len(seqs[c]) == len(p)).encode()).hexdigest())
        for p, m in nodes.items())


def got(df):
    return sorted((r[0], r[1], str(r[2]), *r[3:]) for r in df.select(*COLUMNS).collect())


def some(rng, n):
    rows = []
    for c in range(n):
        length = rng.choice([1, 2, 3, 5, 9])
        rows += [(c, t if t or c % 3 else None, rng.choice(["user", "bot", None]) if t > 2 else "user",
                  rng.choice(["a", "b b", None, "c c c"]) if t else rng.choice(["hello there", "hello there", "hi"])) for t in range(length)]
    return rows


@pytest.mark.parametrize("segment, batch", [(256, 2000), (3, 2000), (3, 3), (4, 7)])
def test_small_segments_and_blocks(spark, segment, batch):
    """Cuts of conversations and of blocks change nothing."""
    rng = random.Random(segment * 100 + batch)
    rows = some(rng, 120) + [(500, i, "user", f"t{i % 3}") for i in range(40)] + [(501, i, "user", f"t{i % 3}") for i in range(55)]
    rows += [(c, i, "u", f"same {i}") for c in range(600, 640) for i in range(5)]
    rows += [(700 + i, None, None, None) for i in range(3)] + [(-5, 1, "user", "below zero"), (-20, 1, "user", "hi"), (None, 1, "user", "none")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    had = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        # c % 20 of a negative number keeps its sign in SQL, not in Python
        want = plain([r for r in rows if r[0] is None or r[0] >= 0])
        assert got(prefix_trie(df.where("conv_id >= 0 or conv_id is null"), lead=rebuilt(), segment=segment)) == want
        assert got(prefix_trie(df, segment=segment)) == plain(rows, lead=False)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", had)


def test_edges(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert prefix_trie(empty, lead=rebuilt()).count() == 0
    rows = [(3, 1, "u", "x"), (3, 1, "u", "x"), (9, 1, "u", "x " * 60_000), (10, None, None, "")]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(c) for c in ("depth", "Conv", "a", "words", "n_convs")})
    out = {(r.conv_id, r.depth): r for r in prefix_trie(df).collect()}
    assert out[(3, 0)].n_convs == 3 and out[(3, 0)].n_children == 3 and out[(3, 2)].n_leaves == 1 and out[(9, 1)].words == 60_000
    # 9 is left without turns: its lead conversation 0 isn't there, and crc32 % 4 of "9" covers its only turn
    only = spark.createDataFrame([(c, 0, "u", "x") for c in (1, 2, 9, 15)], SCHEMA)
    assert got(prefix_trie(only, lead=rebuilt())) == plain([(c, 0, "u", "x") for c in (1, 2, 9, 15)])


def test_trees():
    assert sorted(medians(11)) == list(range(11)) and medians(11)[0] == 5
    rng = random.Random(2)
    for _ in range(30):
        seqs = sorted({tuple(rng.randrange(3) for _ in range(rng.randrange(1, 6))) for _ in range(25)})
        sums = [[rng.randrange(5)] for _ in seqs]
        import numpy as np

        out = prefix_totals([list(s) for s in seqs], np.array(sums), [(i, i) for i in range(len(seqs))])
        seen = [seqs[i][:k] for i, k in zip(out["of"], out["length"])]
        assert seen == sorted({s[:d] for s in seqs for d in range(1, len(s) + 1)})
        for p, total, children, edge in zip(seen, out["sums"], out["children"], out["edge"]):
            assert total[0] == sum(x[0] for s, x in zip(seqs, sums) if s[: len(p)] == p)
            assert children == len({s[: len(p) + 1] for s in seqs if s[: len(p)] == p and len(s) > len(p)})
            assert edge == (p in (seqs[0][: len(p)], seqs[-1][: len(p)]))
