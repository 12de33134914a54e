"""Each registered query on a whole small table: against its SQL, its library
or the plain definition."""

import hashlib

import duckdb
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import sentencepiece
from tokenizers import Tokenizer

from acctsentry.llm.quality import LINE_SHARE, NGRAM_SHARES
from acctsentry.llm.queries import ORACLE_SQL, QUERIES
from tests.conftest import SF_MID, SF_SMALL
from tests.llm import brute

TABLES = ("documents", "pages", "benchmark", "labels", "conversations")


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def documents():
    return pq.read_table(f"{SF_SMALL}/documents.parquet").to_pylist()


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    got = QUERIES[name](spark, SF_SMALL)
    cols = ", ".join(f'"{c}"' for c in got.columns)
    want = con.execute(f"SELECT {cols} FROM ({ORACLE_SQL[name]})").fetchall()
    assert sorted(map(str, rows_of(got))) == sorted(map(str, want))


def test_pieces_are_the_librarys(spark, documents):
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = {d["doc_id"]: model.encode(d["text"] or "") for d in documents}
    for r in QUERIES["op1_sentence_pieces"](spark, SF_SMALL).collect():
        ids = want.pop(r.doc_id)
        assert r.n_pieces == len(ids) and r.round_trip
        assert r.pieces_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert not want


def test_token_counts_are_the_librarys(spark, documents):
    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = sorted(
        (d["doc_id"], len(d["text"].encode()), n := len(model.encode(d["text"], add_special_tokens=False).ids), n > 512)
        for d in documents)
    assert rows_of(QUERIES["op4_token_counts"](spark, SF_SMALL)) == want


def test_quality(spark, documents):
    got = QUERIES["op6_quality"](spark, SF_SMALL).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    assert rows_of(got) == sorted((d["doc_id"], *brute.quality(d["text"], NGRAM_SHARES, LINE_SHARE)) for d in documents)


def test_near_groups(spark):
    docs = pq.read_table(f"{SF_MID}/documents.parquet").to_pylist()
    want = brute.near_groups([(d["doc_id"], d["text"]) for d in docs], 4)
    got = QUERIES["op10_near_dedup"](spark, SF_MID).collect()
    assert {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got} == {(i, n, c, c == i) for i, (n, c) in want.items()}
    assert any(not r.kept for r in got)


def test_shards(spark, documents):
    got = QUERIES["op9_sharding"](spark, SF_MID).toPandas()
    docs = pq.read_table(f"{SF_MID}/documents.parquet").to_pandas()
    assert sorted(got.doc_id) == sorted(docs.doc_id)
    assert got["size"].sum() == sum(len(t.encode()) + 1 for t in docs.text)
    for _, part in got.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))
    total = got.groupby("shard")["size"].sum()
    assert len(total) == 8 and total.max() - total.min() < 0.1 * total.mean()


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    got = QUERIES["op8_toxicity"](spark, sf).toPandas()
    labels = pq.read_table(f"{sf}/labels.parquet").to_pandas()
    test = got[got.held_out].merge(labels, on="doc_id")
    order = test.score.rank()
    pos = test.toxic == 1
    auc = (order[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())
    assert auc > 0.85
    assert (test.predicted[~pos] == 1).mean() < 0.03
    assert got.score.between(0, 1).all() and ((got.score >= 0.5) == (got.predicted == 1)).all()
