"""Benchmark decontamination: a prefix-filtered set join of word windows.

A document is hit where it holds one of an item's windows word for word. A
window can only be there if all its shingles are, so its rarest shingle is a
sufficient prefix: documents and windows are joined on that one alone, then
positions and lengths bound the match, and the words themselves decide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acctsentry.llm import arrays as A
from acctsentry.llm.common import col, materialized

WINDOW, SHINGLE = 10, 5
#: Bits of the filter that is sent to the tasks: its size is fixed, whatever the tables hold.
FILTER_BITS = 1 << 24

#: Bytes of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]` once A-Z are lower-cased.
IS_WORD = np.zeros(256, bool)
IS_WORD[48:58] = IS_WORD[97:123] = IS_WORD[128:] = True


def words_of(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, ...]:
    """Lower-cased bytes, word starts, ends, text numbers and hashes."""
    low = A.TO_LOWER[data]
    starts, ends, doc = A.runs(IS_WORD[low], off)
    return low, starts, ends, doc, A.span_hashes(low, starts, ends)


def strings(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The byte spans as an Arrow array of strings."""
    length = ends - starts
    off = np.concatenate([[0], np.cumsum(length)])
    at = np.arange(off[-1]) - np.repeat(off[:-1], length) + np.repeat(starts, length)
    return pa.Array.from_buffers(
        pa.large_string(), len(starts), [None, pa.py_buffer(off.astype(np.int64)), pa.py_buffer(low[at].tobytes())])


def lists(values: pa.Array, counts: np.ndarray) -> pa.Array:
    off = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int64())
    return pa.LargeListArray.from_arrays(off, values)


def grouped(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... inside each group of the given sizes."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def item_words(items: DataFrame, text_col: str, size: int) -> DataFrame:
    """Each item's words and shingle hashes (of ``size`` words, or of all that it has)."""

    def run(data: np.ndarray, off: np.ndarray) -> dict:
        low, starts, ends, doc, h = words_of(data, off)
        n = A.per_doc(doc, len(off) - 1)
        first = np.cumsum(n) - n
        k = np.minimum(n, size)
        made = [A.window_hashes(h, first[i] + np.arange(n[i] - k[i] + 1), int(k[i])) if n[i] else np.zeros(0, np.uint64)
                for i in range(len(n))]
        hashes = np.concatenate([np.zeros(0, np.uint64), *made]).view(np.int64)
        return {
            "words": lists(strings(low, starts, ends), n).cast(pa.list_(pa.string())),
            "hashes": lists(pa.array(hashes), np.array([len(x) for x in made], np.int64)).cast(pa.list_(pa.int64())),
        }

    return A.per_text(items, ["item", "th"], text_col, run, T.StructType([
        T.StructField("words", T.ArrayType(T.StringType())), T.StructField("hashes", T.ArrayType(T.LongType()))]))


def filter_bits(hashes: DataFrame) -> np.ndarray:
    """A Bloom filter of ``FILTER_BITS`` bits (two for each value of column ``h``)."""
    places = hashes.select(F.explode(F.array(
        F.col("h").bitwiseAND(FILTER_BITS - 1), F.shiftrightunsigned("h", 32).bitwiseAND(FILTER_BITS - 1))).alias("p"))
    rows = places.groupBy(F.shiftright("p", 6).cast("int").alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("b")).toPandas()
    bits = np.zeros(FILTER_BITS // 64, np.int64)
    bits[rows["w"].to_numpy()] = rows["b"].to_numpy()
    return bits.view(np.uint64)


def may_have(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    one, m = np.uint64(1), np.uint64(FILTER_BITS - 1)
    def bit(p: np.ndarray) -> np.ndarray:
        return (bits[(p >> np.uint64(6)).astype(np.int64)] >> (p & np.uint64(63))) & one
    found = np.flatnonzero(bit(h & m))
    out = np.zeros(len(h), bool)
    out[found] = bit((h[found] >> np.uint64(32)) & m) == one
    return out


def shingle_counts(docs: DataFrame, text_col: str, bits: np.ndarray, sizes: list[int]) -> DataFrame:
    """How often the documents hold each shingle that passes the filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in A.slices(batch, "t"):
                _, _, _, doc, h = words_of(*A.utf8(part.column("t")))
                found = [x[may_have(bits, x)] for k in sizes if len(x := A.window_hashes(h, A.window_starts(doc, k), k))]
                value, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *found]), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(n, pa.int64())], ["h", "n"])
        A.give_back()

    return docs.select(col(text_col).alias("t")).mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


def candidates(docs: DataFrame, text_col: str, bits: np.ndarray, sizes: list[int], window: int) -> DataFrame:
    """Per document its number of words and the places of shingles that pass
    the filter, each with the words a window away on both sides."""

    def run(data: np.ndarray, off: np.ndarray) -> dict:
        low, starts, ends, doc, h = words_of(data, off)
        n_docs = len(off) - 1
        at, hs = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
        for k in sizes:
            w = A.window_starts(doc, k)
            x = A.window_hashes(h, w, k)
            sel = may_have(bits, x)
            at.append(w[sel])
            hs.append(x[sel])
        at, hs = np.concatenate(at), np.concatenate(hs)
        order = np.argsort(at, kind="stable")
        at, hs = at[order], hs[order]
        n = A.per_doc(doc, n_docs)
        first = np.cumsum(n) - n
        d = doc[at]
        lo = np.maximum(at - (window - 1), first[d])
        hi = np.minimum(at + window, first[d] + n[d])
        words = np.repeat(lo, hi - lo) + grouped(hi - lo)
        found = pa.StructArray.from_arrays(
            [pa.array(hs.view(np.int64)), pa.array(at - first[d], pa.int64()), pa.array(at - lo, pa.int32()),
             lists(strings(low, starts[words], ends[words]), hi - lo).cast(pa.list_(pa.string()))],
            ["h", "p", "lead", "near"])
        return {"n_words": n, "found": lists(found, A.per_doc(d, n_docs)).cast(pa.list_(found.type))}

    found = T.StructType([T.StructField("h", T.LongType()), T.StructField("p", T.LongType()),
                          T.StructField("lead", T.IntegerType()), T.StructField("near", T.ArrayType(T.StringType()))])
    return A.per_text(docs, ["id", "th"], text_col, run, T.StructType([
        T.StructField("n_words", T.LongType()), T.StructField("found", T.ArrayType(found))]))


def agreeing(a: Column, b: Column) -> Column:
    """How many words two lists share from their beginnings on."""
    first_other = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), False)
    return F.when(first_other == 0, F.least(F.size(a), F.size(b))).otherwise(first_other - 1).cast("int")


def decontaminate(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", window: int = WINDOW, shingle: int = SHINGLE,
) -> DataFrame:
    """Which documents hold windows of benchmark items.

    Words are runs of digits, letters a-z (A-Z lower-cased) and all non-ASCII
    characters. A window is ``window`` consecutive words of an item; an item
    with fewer words, but not none, is one window. A document's word is hit if
    it lies in any occurrence of a window.

    Returns one row per document row: ``id_col``, ``th`` (hash of the text,
    with which equal ids can be told apart), ``n_words``, ``n_hit``,
    ``items`` (sorted list, as strings, of the items with occurring windows),
    ``spans`` (the hit word ranges, merged, end exclusive).

    Defined cases: NULL and empty texts have no words, no hits and, as items,
    no windows; rows with equal id and text get equal results, other rows of
    one id are told apart by their text; a NULL item id is left out of
    ``items`` though its windows hit; empty tables on either side are fine.

    Scale: documents are read twice in narrow passes. The first counts, for
    shingles that pass a filter of fixed size, how often documents hold them
    (summed per slice before the shuffle); the second gives the places of each
    window's rarest shingle with the words around. What is shuffled are these
    places only; AQE splits the places of a hot shingle. No table is broadcast
    but the fixed filter.
    """
    src = items.select(col(item_col).cast("string").alias("item"), F.xxhash64(col(item_text_col)).alias("th"),
                       col(item_text_col).alias("item_text")).distinct()
    parts = materialized(item_words(src, "item_text", shingle).where(F.size("words") > 0))
    sizes = sorted(r[0] for r in parts.select(F.least(F.size("words"), F.lit(shingle))).distinct().collect())
    rows = parts.select("item", "th", "words", F.posexplode("hashes").alias("q", "h"))

    text = docs.select(col(id_col).alias("id"), F.xxhash64(col(text_col)).alias("th"), col(text_col).alias("doc_text"))
    counts = shingle_counts(text, "doc_text", filter_bits(rows.select("h").distinct()), sizes)
    need = F.least(F.size("words"), F.lit(window))
    # Of each window (numbered by its first shingle) the rarest shingle; one that no document holds rules it out.
    frame = W.partitionBy("item", "th").orderBy("q").rangeBetween(0, window - shingle)
    prefix = materialized(
        rows.join(counts, "h", "left")
        .withColumn("n", F.coalesce("n", F.lit(0)))
        .withColumn("rare", F.min(F.struct("n", "h", "q")).over(frame))
        .where((F.col("q") + need <= F.size("words")) & (F.col("rare.n") > 0))
        .select("item", "words", need.alias("need"), F.col("rare.h").alias("h"), F.col("rare.q").alias("q"))
        .distinct()
    )
    places = materialized(candidates(text, "doc_text", filter_bits(prefix.select("h").distinct()), sizes, window))
    q, lead = F.col("q"), F.col("lead")
    lo = F.greatest(q - (window - 1), F.lit(0))
    sides = prefix.select(
        "h", "item", "need",
        F.reverse(F.slice("words", lo + 1, q - lo)).alias("item_left"),
        F.slice("words", q + 1, F.lit(window)).alias("item_right"))
    hits = (
        places.select("id", "th", F.explode("found").alias("f")).select("id", "th", "f.*")
        .select("id", "th", "h", "p", F.reverse(F.slice("near", F.lit(1), lead)).alias("left"),
                F.slice("near", lead + 1, F.lit(window)).alias("right"))
        .join(sides, "h")
        .select("id", "th", "p", "item", "need", agreeing(F.col("left"), F.col("item_left")).alias("before"),
                agreeing(F.col("right"), F.col("item_right")).alias("onward"))
        .where((F.col("onward") > 0) & (F.col("before") + F.col("onward") >= F.col("need")))
        .select("id", "th", "item", (F.col("p") - F.col("before")).alias("s"), (F.col("p") + F.col("onward")).alias("e"))
    )
    empty = F.array().cast("array<struct<s:bigint,e:bigint>>")
    # Ranges in order; one that begins inside the last one lengthens it.
    merged = F.aggregate(
        F.array_sort("ranges"), empty,
        lambda acc, x: F.when(
            (F.size(acc) > 0) & (x["s"] <= F.element_at(acc, -1)["e"]),
            F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(F.struct(
                F.element_at(acc, -1)["s"].alias("s"), F.greatest(F.element_at(acc, -1)["e"], x["e"]).alias("e")))),
        ).otherwise(F.concat(acc, F.array(x))))
    per_doc = (
        hits.groupBy(F.col("id").alias("hit_id"), F.col("th").alias("hit_th"))
        .agg(F.collect_set(F.struct("s", "e")).alias("ranges"), F.array_sort(F.collect_set("item")).alias("items"))
        .select("hit_id", "hit_th", "items", merged.alias("spans"))
    )
    return (
        places.select("id", "th", "n_words")
        .join(per_doc, F.col("id").eqNullSafe(F.col("hit_id")) & (F.col("th") == F.col("hit_th")), "left")
        .select(
            F.col("id").alias(id_col), "th", "n_words",
            F.coalesce(F.aggregate("spans", F.lit(0).cast("long"), lambda acc, x: acc + x["e"] - x["s"]), F.lit(0).cast("long")).alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
            F.coalesce("spans", empty).alias("spans"),
        )
    )
