"""Toxicity scores and shards against plain definitions, and replaced names in any case."""

import math
import re

import numpy as np
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from acctsentry.llm import arrays as A
from acctsentry.llm import toxicity as X
from acctsentry.llm.common import table
from acctsentry.llm.line_dedup import drop_shared_lines
from acctsentry.llm.mixing import mix_sources
from acctsentry.llm.near_dedup import near_duplicates
from acctsentry.llm.queries import QUERIES
from acctsentry.llm.secret_scan import find_secrets
from acctsentry.llm.sharding import shard_by_size
from acctsentry.llm.warc import train as train_dictionary
from tests.conftest import SF_MID, SF_SMALL
from tests.llm.brute import ITEM_WORD, LOWER


def bucket(gram: bytes) -> int:
    data = np.frombuffer(gram, np.uint8)
    return (int(A.span_hashes(data, np.array([0]), np.array([len(data)]))[0]) >> 40) % X.BUCKETS


def plain_score(text, weight, bias, seen={}):
    """A word is the mean weight of its n-grams, a window the mean of its words, a text its highest window."""
    words = [w for w in ITEM_WORD.findall((text or "").translate(LOWER))]
    words = [w for i, w in enumerate(words) if not i or w != words[i - 1]]
    values = []
    for w in words:
        if w not in seen:
            b = b"\x01" + w.encode() + b"\x01"
            grams = [b] + [b[i : i + n] for n in X.GRAMS for i in range(len(b) - n + 1)]
            seen[w] = [bucket(g) for g in grams]
        values.append(sum(float(weight[k]) for k in seen[w]) / len(seen[w]))
    best, i = bias, 0
    if values:
        best = -math.inf
        while True:
            part = values[i : i + X.WINDOW]
            best = max(best, sum(part) / max(len(part), X.WINDOW // 2) + bias)
            if i + X.WINDOW >= len(values):
                break
            i += X.STRIDE
    return 1 / (1 + math.exp(-best))


def test_toxicity_scores(spark):
    docs, labels = table(spark, SF_MID, "documents"), table(spark, SF_MID, "labels")
    model = X.train(docs, labels)
    texts = {d["doc_id"]: d["text"] for d in pq.read_table(f"{SF_SMALL}/documents.parquet").to_pylist()} | {-1: None, -2: "", -3: "!?", -4: "a", -5: "é é é x"}
    src = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.score for r in X.score_texts(src, model, ["doc_id"]).collect()}
    assert len(got) == len(texts) and len(set(got.values())) > 50
    for i, t in texts.items():
        assert abs(got[i] - plain_score(t, model.weight, model.bias)) < 1e-6, i


def test_repeated_ids_fit_alike(spark):
    """An id with several texts gives the fit the same one whatever the partitions."""
    rows = [(i % 50, f"text number {i} of {'bad' if i % 50 % 2 else 'good'} words {i * 7 % 13}") for i in range(400)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)], "doc_id long, toxic int")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    a, b = (X.train(docs.repartition(n), labels) for n in (1, 7))
    assert np.array_equal(a.weight, b.weight) and a.bias == b.bias


def test_shards_keep_equal_texts(spark):
    docs = pq.read_table(f"{SF_MID}/documents.parquet").to_pylist()
    text = {d["doc_id"]: d["text"] for d in docs}
    got = QUERIES["op9_sharding"](spark, SF_MID).collect()
    place = {r.doc_id: r.shard for r in got}
    assert len(got) == len(docs) and all(r.size == len((text[r.doc_id] or "").encode()) + 1 for r in got)
    groups = {}
    for i, t in text.items():
        groups.setdefault(t, []).append(i)
    assert any(len(g) > 1 for g in groups.values())
    share = sum(r.size for r in got) // 256
    for t, g in groups.items():
        if len(g) * (len((t or "").encode()) + 1) <= share:
            assert len({place[i] for i in g}) == 1
    # the same shards from the same rows in other partitions
    src = table(spark, SF_MID, "documents").select("doc_id", (F.octet_length("text") + 1).cast("long").alias("size"), F.xxhash64("text").alias("h"))
    again = {r.doc_id: (r.shard, r.slot) for r in shard_by_size(src.repartition(5), F.col("h")).collect()}
    assert again == {r.doc_id: (r.shard, r.slot) for r in got}


def test_replaced_names_in_any_case(spark):
    docs = spark.createDataFrame([(1, "a line of more than twenty characters\nb", "s")] * 3 + [(2, "x y z", "t")], "doc_id long, text string, source string")
    for fn, names in ((drop_shared_lines, ["N_Lines", "n_DROPPED"]), (near_duplicates, ["Kept", "COMPONENT_ID", "N_shingles"]),
                      (find_secrets, ["Secrets"]), (mix_sources, ["Size", "TAKEN", "Target"])):
        out = fn(docs.withColumns({n: F.lit("old") for n in names}))
        low = [c.lower() for c in out.columns]
        assert len(set(low)) == len(low) and set(n.lower() for n in names) <= set(low), fn
        assert out.count() == 4 and not any("old" in r for r in out.collect())


def test_dictionary_of_long_records():
    words = [f"word{i * 7919 % 977}" for i in range(5000)]
    page = " ".join(words[i % 5000] for i in range(200_000)).encode()
    assert len(train_dictionary([page])) > 1000 and len(train_dictionary([page[:40_000]] * 3)) > 500
    assert train_dictionary([b"x" * 50]) == b"" and train_dictionary([]) == b""
    assert re.match(rb"\x37\xa4\x30\xec", train_dictionary([page]))
