"""The corpus pipeline: toxicity, line dedup, near-dedup, decontamination,
SentencePiece.

Each stage takes the rows that the one before it kept, and all but the last
return the columns of ``documents``. ``run`` writes each stage's rows below
``spark.checkpoint.dir`` and reads them again for the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acctsentry.llm.common import col, table
from acctsentry.llm.decontamination import decontaminate
from acctsentry.llm.line_dedup import drop_shared_lines
from acctsentry.llm.near_dedup import near_duplicates
from acctsentry.llm.sentence_pieces import decode, encode
from acctsentry.llm.toxicity import score_texts, train
from acctsentry.session import apply_engine_conf, scratch_path

#: SQL can't express the classifier.
ORACLE_SQL = None

#: Score from which on a document is rejected as toxic.
TOXIC = 0.5


def set_aside(docs: DataFrame, *working: str) -> tuple[DataFrame, list[Column]]:
    """``docs`` with its columns of the working names renamed, and what selects
    the columns of ``docs`` from it again."""
    taken, names = {c.lower() for c in docs.columns}, {}
    for c in docs.columns:
        if c.lower() in working:
            names[c] = c
            while names[c].lower() in taken:
                names[c] += "_"
            taken.add(names[c].lower())
    return docs.withColumnsRenamed(names), [col(names.get(c, c)).alias(c) for c in docs.columns]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. It is fitted on labelled rows
    of the raw table, those kept for its evaluation (see op8) left out."""
    apply_engine_conf(spark)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    model = train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").where(~held_out))
    own, back = set_aside(docs, "score")
    return score_texts(own, model, own.columns).where(F.col("score") < TOXIC).select(*back)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shared lines stay in one document; ``n_chars`` follows the text."""
    apply_engine_conf(spark)
    own, back = set_aside(docs, "n_lines", "n_dropped")
    return drop_shared_lines(own).withColumn("n_chars", F.char_length("text").cast("long")).select(*back)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: five words, similarity 0.8."""
    apply_engine_conf(spark)
    own, back = set_aside(docs, "n_shingles", "component_id", "kept")
    return near_duplicates(own, shingle=5, share=0.8).where("kept").select(*back)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a ten-word window of a benchmark item go."""
    apply_engine_conf(spark)
    hit = decontaminate(docs, table(spark, sf_dir, "benchmark")).where("n_hit > 0").select(
        F.col("doc_id").alias("hit_id"), F.col("th").alias("hit_th")).distinct()
    return docs.join(
        hit, docs["doc_id"].eqNullSafe(hit["hit_id"]) & (F.xxhash64(docs["text"]) == hit["hit_th"]), "left_anti")


def sentence_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece numbers of each text, and whether they spell it again. Columns of
    the new names are replaced."""
    apply_engine_conf(spark)
    model = public_tokenizers.path("piece_bpe_32k.model")
    seen = F.translate(F.coalesce("text", F.lit("")), "▁", " ")
    kept = [col(c) for c in docs.columns if c.lower() not in ("pieces", "n_pieces", "round_trip")]
    own, back = set_aside(docs.select(*kept), "decoded")
    return decode(encode(own, model), model).select(
        *back, "pieces", F.size("pieces").cast("long").alias("n_pieces"), (F.col("decoded") == seen).alias("round_trip"))


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("sentence_pieces", sentence_pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
