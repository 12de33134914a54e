"""NULLs, empty and long texts, repeated rows, empty tables and clashing
column names, operator by operator."""

import math
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from acctsentry.llm import near_dedup
from acctsentry.llm.decontamination import decontaminate
from acctsentry.llm.line_dedup import drop_shared_lines
from acctsentry.llm.near_dedup import near_duplicates
from acctsentry.llm.quality import LINE_SHARE, NGRAM_SHARES, quality_rules
from acctsentry.llm.secret_scan import RULES, find_secrets, trigram_query
from acctsentry.llm.sentence_pieces import decode, encode
from acctsentry.llm.sharding import shard_by_size
from acctsentry.llm.token_counts import count_tokens
from acctsentry.llm.toxicity import score_texts, train
from acctsentry.llm.warc import archive_pages
from tests.llm import brute

MODEL = public_tokenizers.path("piece_bpe_32k.model")
BPE = public_tokenizers.path("byte_bpe_50k.json")
LONG = " ".join(f"word{i % 977}x{i}" for i in range(40_000))
LINE = "a line that is shared by many"
ROWS = [
    (1, f"{LINE}\nown text of one", "x"), (2, f"  {LINE.upper()}\t\nb", None), (3, f"b\n{LINE}\n{LINE}", "x"),
    (4, None, "x"), (5, "", "x"), (6, LONG, "y"), (7, LONG + " tail", "y"), (8, "\n\n \n", "z"), (None, LINE, "n"),
    (9, "😀 é  ▁ \x00 x", "u"), (9, "😀 é  ▁ \x00 x", "u"), (9, "another text of nine", "u"), (10, "aaaa" * 3000, "l"),
]
SCHEMA = "doc_id long, text string, row string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def key(r):
    return str(r)


def test_line_dedup(docs, nothing):
    got = drop_shared_lines(docs.withColumn("n_lines", F.lit(-1)).withColumn("id", F.lit("i")).withColumn("lines", F.lit("l")))
    want = brute.line_dedup([(i, t) for i, t, _ in ROWS])
    rows = got.select("doc_id", "text", "n_lines", "n_dropped").collect()
    assert sorted(map(key, map(tuple, rows))) == sorted(map(key, want))
    assert set(got.columns) == {"doc_id", "text", "row", "id", "lines", "n_lines", "n_dropped"}
    assert sorted(str(r.row) for r in got.collect()) == sorted(str(x) for *_, x in ROWS)
    assert drop_shared_lines(nothing).count() == 0


def test_near_duplicates(spark, docs, nothing):
    got = near_duplicates(docs.withColumn("node", F.lit(1)).withColumn("kept", F.lit("old")), shingle=4)
    rows = {(r.doc_id, r.text): r for r in got.collect()}
    assert got.count() == len(ROWS) and "node" in got.columns
    assert rows[6, LONG].component_id == rows[7, LONG + " tail"].component_id == 6
    assert rows[6, LONG].kept and not rows[7, LONG + " tail"].kept
    assert rows[4, None].n_shingles == rows[5, ""].n_shingles == rows[8, "\n\n \n"].n_shingles == 0
    assert rows[4, None].kept and rows[5, ""].kept and rows[8, "\n\n \n"].kept
    assert rows[None, LINE].component_id is None and rows[None, LINE].kept and rows[None, LINE].n_shingles == 4
    assert near_duplicates(nothing).count() == 0


def test_near_chain_and_strays(spark):
    """Chains of near copies whose ends are no longer alike, and a hot group."""
    rng = random.Random(1)
    base = [f"w{k}" for k in range(120)]
    rows, text = [], list(base)
    for i in range(60):
        rows.append((i, " ".join(text)))
        text[rng.randrange(120)] = f"n{i}"
    for i in range(60, 160):
        t = list(base)
        for _ in range(rng.randrange(9)):
            t[rng.randrange(120)] = f"m{rng.randrange(10**6)}"
        rows.append((i, " ".join(t)))
    rows += [(i, " ".join(base)) for i in range(160, 200)]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=4).collect()
    want = brute.near_groups(rows, 4)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want


def test_near_copies_of_an_id_with_several_texts(spark):
    """Each text of a repeated id keeps its own near copies."""
    texts = [" ".join(f"{c}{k}" for k in range(100)) for c in "abc"]
    rows = [(5, t) for t in texts] + [(6 + i, f"{t} tail") for i, t in enumerate(texts)] + [(2, f"{texts[1]} head"), (9, "other words of nine")]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=4)
    want = {(5, texts[0]): 5, (5, texts[1]): 2, (5, texts[2]): 5, (6, rows[3][1]): 5, (7, rows[4][1]): 2, (8, rows[5][1]): 5,
            (2, rows[6][1]): 2, (9, rows[7][1]): 9}
    assert {(r.doc_id, r.text): r.component_id for r in got.collect()} == want


def test_decontamination(spark, docs, nothing):
    items = spark.createDataFrame(
        [(1, LINE), (2, "tail"), (2, "tail"), (3, None), (4, ""), (5, " ".join(LONG.split()[500:540])), (None, "own text"),
         (6, "absent words only here"), (7, "own text of one more")], "item_id long, text string")
    got = decontaminate(docs, items).collect()
    want = brute.contamination([(i, t) for i, t, _ in ROWS], [(1, LINE), (2, "tail"), (5, " ".join(LONG.split()[500:540])), (6, "absent words only here"), (7, "own text of one more"), ("", "own text")])
    assert sorted((str(r.doc_id), r.n_words, r.n_hit) for r in got) == sorted((str(i), n, h) for i, n, h, *_ in want)
    by = {(r.doc_id, r.n_words): r for r in got}
    assert by[6, 40_000]["items"] == ["5"] and by[6, 40_000].n_hit == 40
    assert by[7, 40_001]["items"] == ["2", "5"]
    assert by[1, 11]["items"] == ["1"] and by[1, 11].n_hit == 9
    assert decontaminate(nothing, items).count() == 0
    assert {r.n_hit for r in decontaminate(docs, items.limit(0)).collect()} == {0}


def test_secrets(spark, nothing):
    hot = " ".join("deadbeefdeadbeef" for _ in range(2000))
    rows = [(1, "Password = 'abcdefghijkl' x"), (1, "é😀 token:token:abcdefghijklmnop"), (2, "AKIA" + "A" * 13), (2, "AKIA" + "A" * 14),
            (3, None), (4, ""), (None, "api_key=short apikey=0123456789abcdef0"), (5, hot), (5, hot), (6, "secret   :    ")]
    got = find_secrets(spark.createDataFrame(rows, "doc_id long, text string").withColumn("rules", F.lit(0)))
    found = sorted((str(r.doc_id), r.text or "", [(RULES[s.kind].kind, s.start, s.end) for s in r.secrets]) for r in got.collect())
    by = {(i, t): s for i, t, s in found}
    assert len(found) == len(rows)
    assert by["1", rows[0][1]] == [("assign", 0, 24)]
    assert by["1", rows[1][1]] == [("assign", 3, len(rows[1][1]))] or by["1", rows[1][1]] == []
    assert by["2", rows[2][1]] == [] and by["2", rows[3][1]] == [("access", 0, 18)]
    assert by["None", rows[6][1]] == [("assign", 14, 38), ("hex", 21, 38)]
    assert by["5", hot] == [("hex", 17 * k, 17 * k + 16) for k in range(2000)]
    assert by["3", ""] == by["4", ""] == by["6", rows[9][1]] == []
    assert find_secrets(nothing).count() == 0


def test_trigram_queries():
    assert trigram_query(r"AKIA[A-Z0-9]{14,}") == [frozenset({"aki", "kia"})]
    assert trigram_query(r"[0-9a-f]{16,}") == [frozenset()]
    assert trigram_query(r"ab|x+") == [frozenset()]
    assert trigram_query(r"(abcd|xyz)?tail[0-9]*") == [frozenset({"tai", "ail"})]
    assert trigram_query(r"k(a|b)cd") == [frozenset({"kac", "acd"}), frozenset({"bcd", "kbc"})]


def test_counts_and_quality(docs, nothing):
    n = {(r.doc_id, r.n_bytes): r.n_tokens for r in count_tokens(docs, BPE).collect()}
    assert n[4, 0] == 0 and n[5, 0] == 0 and count_tokens(nothing, BPE).count() == 0
    got = quality_rules(docs.withColumn("kept", F.lit(1)))
    want = [(i, *brute.quality(t, NGRAM_SHARES, LINE_SHARE)) for i, t, _ in ROWS]
    cols = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    assert sorted(map(key, map(tuple, got.select(*cols).collect()))) == sorted(map(key, want))
    assert quality_rules(nothing).count() == 0


def test_special_strings_count_one(spark):
    texts = ["<|endoftext|>", "a <|endoftext|> b", "  <|endoftext|>\n\n", "<|endo", "ftext|>"]
    from tokenizers import Tokenizer
    model = Tokenizer.from_file(BPE)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = {r.doc_id: r.n_tokens for r in count_tokens(df, BPE).collect()}
    assert got == {i: len(model.encode(t, add_special_tokens=False).ids) for i, t in enumerate(texts)}


@pytest.mark.parametrize("chunk", [1 << 15, 7, 100])
def test_pieces(spark, docs, nothing, chunk):
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    some = docs.where("doc_id not in (6, 7) or doc_id is null") if chunk < 100 else docs
    got = decode(encode(some.withColumn("pieces", F.lit(0)).withColumn("th", F.lit(1)), MODEL, chunk=chunk), MODEL).collect()
    assert len(got) == some.count()
    for r in got:
        assert r.pieces == model.encode(r.text or "")
        assert r.decoded == (r.text or "").replace("▁", " ")
    assert encode(nothing, MODEL).count() == 0


def test_decode_odd_pieces(spark):
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    lists = [[], None, [1, 2], [3 + 0xC3], [3 + 0xC3, 3 + 0xA9], model.encode(" two  spaces")]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lists)], "doc_id long, pieces array<int>")
    got = {r.doc_id: r.decoded for r in decode(df, MODEL).collect()}
    assert got == {0: "", 1: None, 2: "", 3: "�", 4: "é", 5: " two  spaces"}


def test_shards(spark, docs, nothing):
    sized = docs.select("doc_id", F.octet_length("text").alias("size"), "text", F.lit(9).alias("slot"), F.lit("k").alias("k"))
    got = shard_by_size(sized, F.col("text"), n_shards=4).toPandas()
    assert len(got) == len(ROWS) and set(got.k) == {"k"}
    for _, part in got.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))
    assert shard_by_size(nothing.withColumn("size", F.lit(1)), F.col("text")).count() == 0


def test_hot_group_is_split(spark):
    df = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.lit(10).alias("size"), F.when(F.col("id") < 1500, "hot").otherwise(F.col("id").cast("string")).alias("g"))
    got = shard_by_size(df, F.col("g"), range_rows=100).toPandas()
    assert got.groupby("shard")["size"].sum().between(3500, 4000).all()
    cold = got[got.g != "hot"]
    assert got[got.g == "hot"].shard.nunique() > 1 and cold.groupby("g").shard.nunique().max() == 1
    for _, part in got.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))


def test_toxicity_edges(spark, docs, nothing):
    bad, good = "you utter idiot person", "you utter lovely person"
    rows = [(i, f"{bad if i % 2 else good} number {i}") for i in range(60)]
    known = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    model = train(known, labels)
    probe = spark.createDataFrame([(1, "that idiots"), (2, "that lovely"), (3, ""), (4, None)], "doc_id long, text string")
    got = {r.doc_id: r.score for r in score_texts(probe, model, ["doc_id"]).collect()}
    assert got[1] > 0.5 > got[2] and got[3] == got[4] and 0 <= got[3] <= 1
    assert score_texts(docs, model, ["doc_id", "text", "row"]).count() == len(ROWS)
    flat = train(known, labels.limit(0))
    assert len({r.score for r in score_texts(docs, flat, ["doc_id"]).collect()}) == 1
    assert score_texts(nothing, train(nothing, labels), ["doc_id"]).count() == 0


def test_warc(spark):
    big = "<p>" + "x" * 2000
    rows = [(1, "http://a/\r\nInjected: 1", big), (2, None, big), (3, "http://c", "small"), (4, "u", "small"), (5, "u", None),
            (None, "u", big), (7, "http://é", "é" * 700), (7, "http://é", "é" * 700), (6, "x", "é" * 700)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1))
    got = archive_pages(spark, df)
    found = sorted((str(r.page_id), r.record_type, r.refers_to, r.payload_bytes) for r in got.collect())
    assert found == sorted([
        ("1", "revisit", 2, 2003), ("2", "response", None, 2003), ("3", "response", None, 5), ("4", "response", None, 5), ("5", "response", None, 0),
        ("None", "revisit", 2, 2003), ("7", "response", None, 1400), ("7", "response", None, 1400), ("6", "revisit", 7, 1400)])
    assert archive_pages(spark, df.limit(0)).count() == 0


def test_warc_long_url(spark):
    long = "data:text/html," + "x" * 200_000
    rows = [(1, long, "small"), (2, "http://b", "other"), (3, long, "p" * 2000), (4, "\n" * 70_000, "p" * 2000)]
    got = archive_pages(spark, spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.page_id: (r.url, r.record_type, r.refers_to) for r in got} == {
        1: (long, "response", None), 2: ("http://b", "response", None), 3: (long, "revisit", 4), 4: ("%0A" * 70_000, "response", None)}


def test_sketch_misses():
    """Two sets of equal size and similarity 0.8: the exact binomial tails of what bands and likelihood filter miss."""
    def chance(equal):
        return math.comb(near_dedup.REGISTERS, equal) * 0.8**equal * 0.2 ** (near_dedup.REGISTERS - equal)

    def passes(equal):
        a = np.full((1, near_dedup.REGISTERS), 100, np.uint16)
        b = a.copy()
        b[0, equal:] = 99 + 2 * (np.arange(near_dedup.REGISTERS - equal) % 2)
        return near_dedup.likely(a, b, np.array([1000.0]), np.array([1000.0]), 0.8)[0]

    first = next(k for k in range(near_dedup.REGISTERS) if passes(k))
    assert sum(chance(k) for k in range(first)) <= near_dedup.MISS <= 1e-6
    assert sum(chance(k) for k in range(first + 1)) > near_dedup.MISS
    assert (1 - 0.8**near_dedup.BAND) ** near_dedup.BANDS < 1e-9
    assert near_dedup.BANDS * near_dedup.BAND <= near_dedup.REGISTERS
