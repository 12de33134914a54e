"""The corpus pipeline, stage by stage, against plain definitions."""

import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline as P
from acctsentry.llm import arrays as A
from acctsentry.llm.toxicity import train
from acctsentry.session import scratch_path
from tests.conftest import SF_SMALL
from tests.llm import brute


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, kept = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    model = train(docs, labels.where(F.crc32(F.col("doc_id").cast("string")) % 5 != 0))
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]

    def toxic(text):
        data = A.np.frombuffer(text.encode(), A.np.uint8)
        return model.score(data, A.np.array([0, len(data)]))[0] >= P.TOXIC

    def expected(name, rows):
        pairs = sorted(rows.items())
        if name == "toxicity":
            return {i: t for i, t in pairs if not toxic(t)}
        if name == "line_dedup":
            return {i: t for i, t, *_ in brute.line_dedup(pairs)}
        if name == "near_dedup":
            groups = brute.near_groups(pairs, 5)
            return {i: t for i, t in pairs if groups[i][1] == i}
        if name == "decontamination":
            return {i: rows[i] for i, *_, hit in brute.contamination(pairs, items) if not hit}
        return rows

    assert [n for n, _ in P.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontamination", "sentence_pieces"]
    for name, stage in P.STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, SF_SMALL).write.parquet(path)
        docs = spark.read.parquet(path)
        kept = expected(name, kept)
        rows = docs.collect()
        assert {r.doc_id: r.text for r in rows} == kept and len(rows) == len(kept), name
        assert all(r.n_chars == len(r.text) for r in rows)
        if name != "sentence_pieces":
            assert docs.columns == columns
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    assert all(r.pieces == library.encode(r.text) and r.round_trip for r in docs.collect())


def test_empty_and_null_documents(spark):
    """A table of NULLs, and one without rows, goes through each stage."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    odd = docs.limit(2).select(*[F.lit(None).cast(t).alias(c) for c, t in docs.dtypes])
    for name, stage in P.STAGES:
        assert stage(spark, odd, SF_SMALL).count() == 2, name
        assert stage(spark, odd.limit(0), SF_SMALL).count() == 0, name


def test_columns_of_working_names(spark):
    """Columns of ``documents`` that are named like a stage's own come through, but for the last stage's results."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(20)
    extra = ["score", "Score_", "n_lines", "kept", "component_id", "decoded", "pieces", "round_trip"]
    docs = docs.select("*", *[F.concat(F.lit(f"{c} of "), F.col("doc_id").cast("string")).alias(c) for c in extra])
    for name, stage in P.STAGES:
        got = stage(spark, docs, SF_SMALL)
        last = name == "sentence_pieces"
        new = ["pieces", "n_pieces", "round_trip"] if last else []
        assert got.columns == [c for c in docs.columns if c not in new] + new, name
        rows = got.collect()
        assert rows and all(r[c] == f"{c} of {r.doc_id}" for r in rows for c in extra if c not in new), name
    assert all(r.round_trip and r.n_pieces == len(r.pieces) for r in rows)
