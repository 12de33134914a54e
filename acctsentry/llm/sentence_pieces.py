"""SentencePiece encoding and decoding.

Encoding is a max-plus scan over the lattice of pieces (``piece_scan``). A
giant text is split into chunks that tasks turn into transfer matrices between
boundary states; the matrices are combined associatively by text, and each
chunk is then traced back for itself, knowing only its two boundary states.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from acctsentry.llm import arrays as A
from acctsentry.llm import piece_scan as S
from acctsentry.llm.common import col, materialized, others, row_struct
from acctsentry.llm.piece_table import pieces

#: Characters from which on a text is split, and those of a chunk.
CHUNK = 1 << 15
#: Chunks that are traced back together.
TOGETHER = 16
#: Pieces that are decoded at once.
DECODE = 1 << 18


@lru_cache(2)
def encoder(path: str) -> S.Encoder:
    return S.Encoder(pieces(path))


def marked_points(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts as the model sees them (space marks), and offsets."""
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    upto = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    begin = upto[off]
    some = np.flatnonzero(np.diff(begin))
    out = np.insert(points, begin[some], 0x20)
    out[out == 0x20] = S.SPACE
    return out, begin + np.concatenate([[0], np.cumsum(np.diff(begin) > 0)])


def int_lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    off = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(off), pa.array(values.astype(np.int32)))


def cut_chunks(texts: DataFrame, size: int) -> DataFrame:
    """Rows (id, th, chunk, left, closed, body) of marked texts of ``size`` characters a chunk."""
    schema = T.StructType([texts.schema["id"], texts.schema["th"], T.StructField("chunk", T.IntegerType()), T.StructField("left", T.IntegerType()),
                           T.StructField("closed", T.BooleanType()), T.StructField("body", T.StringType())])
    arrow = to_arrow_schema(schema)
    context = 64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                s = S.marked(batch.column("text")[row].as_py())
                starts = range(0, len(s), size)
                for k in range(0, len(starts), 64):
                    part = starts[k : k + 64]
                    ids = batch.column("id").take(pa.array([row] * len(part))).cast(arrow.field("id").type)
                    ths = batch.column("th").take(pa.array([row] * len(part)))
                    yield pa.RecordBatch.from_arrays([
                        ids, ths, pa.array([a // size for a in part], pa.int32()), pa.array([min(a, context) for a in part], pa.int32()),
                        pa.array([a + size >= len(s) or S.is_cut(s, a + size) for a in part]),
                        pa.array([s[a - min(a, context) : a + size] for a in part])], schema=arrow)

    return texts.mapInArrow(run, schema)


def encode_giants(texts: DataFrame, model: str, size: int) -> DataFrame:
    """(id, th, pieces) of distinct texts (id, th, text), chunk by chunk."""
    # Chunks of one text go to many tasks.
    chunks = materialized(cut_chunks(texts, size).repartition("id", "th", "chunk"))
    key = [chunks.schema[c] for c in ("id", "th", "chunk")]
    m_schema = T.StructType([*key, T.StructField("entries", T.BinaryType())])
    x_schema = T.StructType([*key, T.StructField("enter", T.ArrayType(T.IntegerType())), T.StructField("leave", T.ArrayType(T.IntegerType()))])
    p_schema = T.StructType([*key, T.StructField("pieces", T.ArrayType(T.IntegerType()))])

    def chunk(batch: pa.RecordBatch, i: int) -> S.Chunk:
        return S.Chunk(pieces(model), batch.column("body")[i].as_py(), batch.column("left")[i].as_py(), batch.column("closed")[i].as_py())

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(m_schema)
        for batch in batches:
            found = [np.array(chunk(batch, i).matrix(), np.int32).tobytes() for i in range(len(batch))]
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name).cast(arrow.field(f.name).type) for f in key), pa.array(found, pa.binary())], schema=arrow)

    def combine(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("chunk")
        at = S.crossings([[tuple(r) for r in np.frombuffer(m, np.int32).reshape(-1, 4).tolist()] for m in pdf["entries"]])
        return pdf[["id", "th", "chunk"]].assign(enter=[list(x) for x in at[:-1]], leave=[list(x) for x in at[1:]])

    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(p_schema)
        for batch in batches:
            for i in range(0, len(batch), TOGETHER):
                part = batch.slice(i, TOGETHER)
                some = [chunk(part, k) for k in range(len(part))]
                inner = encoder(model).encode_texts([c.inner() for c in some])
                ends = zip(part.column("enter").to_pylist(), part.column("leave").to_pylist(), strict=True)
                got = [c.trace(tuple(a), tuple(b), x) for c, (a, b), x in zip(some, ends, inner, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(f.name).cast(arrow.field(f.name).type) for f in key), pa.array(got, pa.list_(pa.int32()))], schema=arrow)
        A.give_back()

    states = chunks.mapInArrow(matrices, m_schema).groupBy("id", "th").applyInPandas(combine, x_schema)
    states = states.select(*[F.col(c).alias(f"x_{c}") for c in ("id", "th", "chunk")], "enter", "leave")
    both = chunks.join(states, F.col("id").eqNullSafe(F.col("x_id")) & (F.col("th") == F.col("x_th")) & (F.col("chunk") == F.col("x_chunk")))
    return (
        both.select("id", "th", "chunk", "left", "closed", "body", "enter", "leave").mapInArrow(trace, p_schema)
        .groupBy("id", "th").agg(F.array_sort(F.collect_list(F.struct("chunk", "pieces"))).alias("parts"))
        .select("id", "th", F.flatten(F.col("parts.pieces")).alias("pieces")))


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK) -> DataFrame:
    """The input's columns and ``pieces``, the piece numbers of each whole text.

    ``model`` is the path of a SentencePiece BPE model with byte fallback,
    readable on each executor. The numbers are those that the library gives,
    without begin and end marks. A column named ``pieces`` is replaced.

    Defined cases: a NULL or empty text has no pieces; ids may repeat or be
    NULL (chunks are told apart by id and text hash, and equal rows get equal
    results); an empty table gives an empty table; U+2581 in a text counts as
    a space, as in the library.

    Scale: texts up to ``chunk`` characters are encoded where they are read.
    Longer ones are dealt out by chunk, so one giant text keeps many tasks
    busy; what is gathered by text are its matrices (a few hundred bytes a
    chunk) and, in the end, its own pieces.
    """
    src = docs.select(*[col(c) for c in others(docs, "pieces")])
    result = T.StructType([T.StructField("pieces", T.ArrayType(T.IntegerType()))])
    length = F.coalesce(F.char_length(col(text_col)), F.lit(0))

    def run(data: np.ndarray, off: np.ndarray) -> dict:
        return {"pieces": int_lists(*encoder(model).encode(*marked_points(data, off)))}

    short = A.per_text(src.where(length <= chunk), src.columns, text_col, run, result)
    giants = src.where(length > chunk).select(
        row_struct(src).alias("row"), col(id_col).alias("id"), F.xxhash64(col(text_col)).alias("th"), col(text_col).alias("text"))
    done = encode_giants(giants.select("id", "th", "text").dropDuplicates(["id", "th"]), model, chunk)
    done = done.select(F.col("id").alias("d_id"), F.col("th").alias("d_th"), "pieces")
    long = giants.select("row", "id", "th").join(done, F.col("id").eqNullSafe(F.col("d_id")) & (F.col("th") == F.col("d_th")))
    return short.union(long.select(*[F.col("row")[c].alias(c) for c in src.columns], "pieces"))


def spell(table, ids: np.ndarray, counts: np.ndarray) -> list[str]:
    """Texts of lists of piece numbers, given end to end."""
    if len(ids) and (ids.min() < 0 or ids.max() >= table.n_pieces):
        raise ValueError("a number that the model doesn't have")
    length = table.out_len[ids]
    off = np.concatenate([[0], np.cumsum(length)])
    at = np.arange(off[-1]) - np.repeat(off[:-1], length) + np.repeat(table.out_at[ids], length)
    raw = table.out_bytes[at].tobytes()
    ends = off[np.concatenate([[0], np.cumsum(counts)])]
    first = np.cumsum(counts) - counts
    out = []
    for k, (a, b) in enumerate(zip(ends[:-1], ends[1:], strict=True)):
        if b > a and table.marks_space[ids[first[k]]]:
            a += 1  # the mark in front of the text
        out.append(raw[a:b].decode("utf-8", "replace"))
    return out


def decode(encoded: DataFrame, model: str, pieces_col: str = "pieces", to: str = "decoded") -> DataFrame:
    """The input's columns and ``to``, the text that the pieces spell.

    Defined cases: no pieces give the empty text, NULL gives NULL; byte pieces
    that are no UTF-8 become U+FFFD; begin and end marks vanish; a number
    outside the model raises ``ValueError`` in the task. No shuffle.
    """
    kept = others(encoded, to)
    src = encoded.select(*[col(c).alias(f"k{i}") for i, c in enumerate(kept)])
    schema = T.StructType([T.StructField(c, encoded.schema[c].dataType) for c in kept] + [T.StructField(to, T.StringType())])
    arrow, at = to_arrow_schema(schema), kept.index(pieces_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = batch.column(at).value_lengths().fill_null(0).to_numpy().astype(np.int64)
            upto = np.concatenate([[0], np.cumsum(counts)])
            i = 0
            while i < len(batch):
                j = max(i + 1, int(np.searchsorted(upto, upto[i] + DECODE, side="right")) - 1)
                part = batch.slice(i, j - i)
                lists = part.column(at)
                ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                texts = pa.array(spell(pieces(model), ids, counts[i:j]), pa.string())
                texts = pc.if_else(lists.is_valid(), texts, pa.scalar(None, pa.string()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(k).cast(arrow.field(k).type) for k in range(len(kept))] + [texts], schema=arrow)
                i = j
        A.give_back()

    return src.mapInArrow(run, schema)
