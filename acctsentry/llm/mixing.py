"""Mixing sources to target weights: subset-sum budget fitting.

Documents are counted by exact length. What a source's target leaves after
whole passes over the source is filled by a bounded-knapsack dynamic program
over these counts, and a seeded order picks as many documents of each length.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acctsentry.llm.common import col, materialized, others, row_struct
from acctsentry.operators.skew import join_spread, ranked

WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2
#: Words that are left to the dynamic program; its arrays have a cell for each.
WINDOW = 1 << 16
WORD = r"[^\x20\x09-\x0D]+"


def seeded(values: np.ndarray, seed: int) -> np.ndarray:
    """A fixed pseudo-random number for each value."""
    h = values.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed * 2 + 1)
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def knapsack(length: np.ndarray, count: np.ndarray, budget: int) -> np.ndarray:
    """How many of each length make the sum nearest to ``budget`` (of two as
    near, the smaller one), each taken ``count`` times at most.

    Counts become bundles of 1, 2, 4, ... of a length. A cell of the array
    holds the bundle by which its sum was reached first; earlier bundles reach
    what remains, so that the way back is read from the cells.
    """
    taken = np.zeros(len(length), np.int64)
    if budget <= 0 or not len(length):
        return taken
    top = 2 * budget  # above that, nothing at all is nearer
    by = np.full(top + 1, -1, np.int64)
    by[0] = 0
    bundles: list[tuple[int, int]] = [(0, 0)]
    for i in range(len(length)):
        left, k, size = min(int(count[i]), top // int(length[i])), 1, int(length[i])
        while left > 0 and by[budget] < 0:
            n = min(k, left)
            step = n * size
            new = (by[:-step] >= 0) & (by[step:] < 0) if step <= top else np.zeros(0, bool)
            if new.any():
                by[step:][new] = len(bundles)
                bundles.append((i, n))
            left, k = left - n, k * 2
        if by[budget] >= 0:
            break
    reached = np.flatnonzero(by >= 0)
    at = int(reached[np.argmin(np.abs(reached - budget))])
    while at > 0:
        i, n = bundles[by[at]]
        taken[i] += n
        at -= n * int(length[i])
    return taken


def fit_counts(length: np.ndarray, count: np.ndarray, budget: int, seed: int = 0, window: int = WINDOW) -> np.ndarray:
    """How many documents of each length to take so that their sum comes near
    ``budget``.

    Each length first gives its share, rounded down. The rest is less than one
    document of each length: these are taken in seeded order until about
    ``window`` words are left, which the dynamic program fits.
    """
    total = int((length * count).sum())
    if budget <= 0 or not total:
        return np.zeros(len(length), np.int64)
    if budget >= total:
        return count.copy()
    taken = np.floor(count * (budget / total * (1 - 1e-12))).astype(np.int64)
    rest = budget - int((taken * length).sum())
    for i in np.argsort(seeded(length, seed), kind="stable"):
        if rest <= window:
            break
        if taken[i] < count[i] and length[i] <= rest - window // 2:
            taken[i] += 1
            rest -= int(length[i])
    for i in np.argsort(-length, kind="stable"):  # long documents only are left
        if rest <= 16 * window:
            break
        k = min(int(count[i] - taken[i]), rest // int(length[i]))
        taken[i] += k
        rest -= k * int(length[i])
    fits = np.flatnonzero((count > taken) & (length <= 2 * rest))
    fits = fits[np.argsort(seeded(length[fits], seed + 1), kind="stable")]
    taken[fits] += knapsack(length[fits], (count - taken)[fits], min(rest, 16 * window))
    return taken


def source_targets(sources: DataFrame, share: float = SHARE, most: int = MOST, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``sources`` (s, sn, source_size, docs) with ``target``, written.

    Sources in the order of their code points, NULL last, weigh ``weights``,
    repeating, and share ``share`` of all sizes. A source whose part would be
    above ``most`` times its size stops there, and the others share the rest
    by weight, until none is above. The driver sees two sums a round.
    """
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (F.col("place") - 1).cast("int") % len(weights) + 1)
    t = materialized(ranked(sources, [], ["sn", "s"], "place").withColumn("w", w))
    total = int(t.agg(F.sum("source_size")).first()[0] or 0)
    budget, capped, before = share * total, F.lit(False), -1
    while True:
        now = t.withColumn("capped", capped).agg(
            F.sum(F.col("capped").cast("int")).alias("n"), F.sum(F.when(~F.col("capped"), F.col("w"))).alias("w"),
            F.sum(F.when(F.col("capped"), F.col("source_size"))).alias("size")).first()
        free, free_w = budget - most * int(now["size"] or 0), int(now["w"] or 0)
        part = F.lit(free) * F.col("w") / F.lit(max(free_w, 1))
        cap = (F.col("source_size") * most).cast("double")
        if (now["n"] or 0) == before or not free_w:
            return t.withColumn("target", F.when(capped, cap).otherwise(part))
        before, capped = now["n"] or 0, F.lit(free) * F.col("w") > cap * free_w


def mix_sources(
    docs: DataFrame, keep: list[str] | None = None, id_col: str = "doc_id", text_col: str = "text",
    source_col: str = "source", share: float = SHARE, most: int = MOST, weights: tuple[int, ...] = WEIGHTS, seed: int = 0,
) -> DataFrame:
    """How often the mix takes each document.

    A document's size is its number of words (runs of other than blanks). A
    source's target comes from ``source_targets``. As many whole passes as fit
    take all its documents; of each length, the plan then takes so many more
    documents, those first in an order seeded by ``seed``. No document is
    taken more than ``most`` times.

    Returns the ``keep`` columns (all, if not given) plus ``size``,
    ``source_size`` long, ``target`` double and ``taken`` long, the words that
    the mix takes of the document, repeats counted. Columns of these names are
    replaced, whatever their case.

    Defined cases: a NULL or empty text, or one of blanks, has size 0 and is
    taken 0 words; NULL is a source of its own and the last; a NULL id is an
    id; rows of one id and text are documents of their own, taken in any
    order among themselves; a source without words has target 0; an empty
    table gives an empty table.

    Scale: one pass counts words and writes the kept columns, size and hash.
    Counts by source and length are combined map-side; a source has at most
    sqrt(2 * words) different lengths, and its plan is made in one task from
    these counts, not from rows. Documents are ranked inside (source, length) by a
    range sort that spreads a hot one, and meet the plan in a join that
    does so too. Nothing but sums reaches the driver.
    """
    free = others(docs, "size", "source_size", "target", "taken")
    keep = free if keep is None else [c for c in keep if c in free]
    base = materialized(docs.select(
        row_struct(docs, *[c for c in docs.columns if c not in keep]).alias("row"),
        F.coalesce(col(source_col).cast("string"), F.lit("")).alias("s"), col(source_col).isNull().alias("sn"),
        F.coalesce(F.regexp_count(col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("words"),
        F.xxhash64(F.lit(seed), col(id_col), col(text_col)).alias("h")))
    lengths = materialized(base.groupBy("s", "sn", "words").agg(F.count(F.lit(1)).alias("n")))
    targets = source_targets(
        lengths.groupBy("s", "sn").agg(F.sum(F.col("words") * F.col("n")).alias("source_size")), share, most, weights)
    counted = lengths.join(targets.select("s", "sn", "source_size", "target"), ["s", "sn"])

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("words", ignore_index=True)
        size, target = int(pdf["source_size"].iloc[0]), float(pdf["target"].iloc[0])
        passes = min(most, int(target // size)) if size else 0
        length, count = pdf["words"].to_numpy(np.int64), pdf["n"].to_numpy(np.int64)
        extra, some = np.zeros(len(pdf), np.int64), length > 0
        if passes < most:
            extra[some] = fit_counts(length[some], count[some], round(target - passes * size), seed)
        return pdf.assign(passes=passes, extra=extra)[["s", "sn", "words", "n", "source_size", "target", "passes", "extra"]]

    plan = materialized(counted.groupBy("s", "sn").applyInPandas(
        fit, "s string, sn boolean, words long, n long, source_size long, target double, passes long, extra long"))
    placed = ranked(base, ["s", "sn", "words"], ["h"])
    both = join_spread(placed, plan, ["s", "sn", "words"], "n", F.col("h"))
    times: Column = F.col("passes") + (F.col("rank") <= F.col("extra")).cast("long")
    return both.select(
        *[F.col("row")[c].alias(c) for c in keep], F.col("words").alias("size"), "source_size", "target",
        (F.col("words") * times).alias("taken"))
