"""Line dedup: lines that many documents share stay in one of them only.

Explode the normalised lines, hash them, count distinct documents per hash,
keep the hashes over the threshold, and reassemble each text from the
positions that stay. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctsentry.llm.common import BLANKS, ascii_lower, col, materialized, others, row_struct
from acctsentry.operators.skew import join_spread


def drop_shared_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20, min_docs: int = 3
) -> DataFrame:
    """Drop lines whose key is found in at least ``min_docs`` documents.

    A text is split at ``\\n``. A line's key is the line without blanks at
    both ends, A-Z lower-cased. A key of at least ``min_chars`` code points
    that ``min_docs`` documents or more hold loses all its lines except those
    of the largest ``id_col`` that holds it (repeats inside that document
    stay too).

    Returns the input columns, ``text_col`` replaced by the kept lines joined
    by ``\\n``, plus ``n_lines`` and ``n_dropped`` (columns of these names
    in the input, in any case, are replaced).

    Defined cases: a NULL or empty text is one empty line and comes back as
    the empty text; rows that share an id are one document when documents are
    counted, and each comes back as a row of its own; a NULL id is one more
    document, smaller than all others; a text that loses all lines becomes
    empty; an empty table gives an empty table.

    Scale: what is shuffled by line is two 64-bit hashes (together the line's
    key), id and position, never text. The distinct (hash, id) pairs are
    dealt by hash *and* id, and then counted with partial sums, so that a
    line of a third of all documents loads no single task. Where lines meet
    the keeper of their hash, ``join_spread`` deals a hot hash over many tasks.
    The texts move once, to meet the positions that they lose.
    """
    rest = others(docs, text_col, "n_lines", "n_dropped")
    base = docs.select(
        row_struct(docs, text_col, "n_lines", "n_dropped").alias("row"),
        col(id_col).alias("id"),
        F.xxhash64(col(text_col)).alias("th"),
        F.split(F.coalesce(col(text_col), F.lit("")), "\n", -1).alias("lines"),
    )
    keyed = (
        base.select("id", "th", F.posexplode("lines").alias("pos", "line"))
        .select("id", "th", "pos", ascii_lower(F.btrim("line", F.lit(BLANKS))).alias("key"))
        .where(F.char_length("key") >= min_chars)
        .select("id", "th", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))
    )
    shared = materialized(
        keyed.groupBy("h1", "h2", "id").agg(F.count(F.lit(1)).alias("lines"))
        .groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.sum("lines").alias("lines"), F.max("id").alias("keeper"))
        .where(F.col("n") >= min_docs)
        .select("h1", "h2", "lines", "keeper")
    )
    losses = (
        join_spread(keyed, shared, ["h1", "h2"], "lines", F.struct("id", "pos"))
        .where(~F.col("id").eqNullSafe(F.col("keeper")))
        .groupBy(F.col("id").alias("loser"), F.col("th").alias("loser_th"))
        .agg(F.collect_set("pos").alias("lost"))
    )
    joined = base.join(losses, F.col("id").eqNullSafe(F.col("loser")) & (F.col("th") == F.col("loser_th")), "left")
    every = F.sequence(F.lit(0), F.size("lines") - 1)
    stay = F.when(F.col("lost").isNull(), every).otherwise(F.array_except(every, F.col("lost")))
    text = F.array_join(F.transform(stay, lambda i: F.get(F.col("lines"), i)), "\n")
    order = [
        text.alias(c) if c == text_col else F.col("row")[c].alias(c)
        for c in docs.columns if c in rest or c == text_col
    ]
    return joined.select(
        *order,
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("lost"), F.lit(0)).cast("long").alias("n_dropped"),
    )
