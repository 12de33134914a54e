"""Near-duplicate groups with SetSketch registers.

Each text's set of word shingles becomes registers: the minima of 256 hashes,
truncated on an exponential scale. Bands of equal registers give candidates, a
joint likelihood over all registers drops the unlikely ones, and the full
shingle sets decide.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acctsentry.llm import arrays as A
from acctsentry.llm.common import col, forget, materialized, others, row_struct, written
from acctsentry.llm.components import connected_components
from acctsentry.llm.decontamination import filter_bits, may_have
from acctsentry.operators.skew import join_spread

#: Registers of a sketch; the first ``BANDS * BAND`` of them form the bands.
#: Two sets of similarity 0.8 share no band with probability (1 - 0.8**4)**40 < 1e-9.
REGISTERS, BANDS, BAND = 256, 40, 4
#: Base, rate and highest value of the registers.
BASE, RATE, TOP = 1.001, 20.0, 65534
#: Probability with which the likelihood filter may drop a pair that is just similar enough.
MISS = 1e-6
#: Members of a bucket that one task compares with as many others.
BLOCK = 1024
#: Pairs that a task compares (about): their number, not their bytes, is what takes time.
PAIRS = 1 << 18
#: Parts that the members of a smaller group are dealt in, if these have ``PART`` members.
PARTS, PART = 4, 256

_rng = np.random.Generator(np.random.PCG64(20240229))
_MUL = _rng.integers(0, 1 << 31, REGISTERS, np.uint32) * np.uint32(2) + np.uint32(1)
_ADD = _rng.integers(0, 1 << 32, REGISTERS, np.uint32)


def shingles(data: np.ndarray, off: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, sorted inside each text, and the text of each."""
    low = A.TO_LOWER[data]
    starts, ends, doc = A.runs(~A.IS_BLANK[low], off)
    h = A.span_hashes(low, starts, ends)
    w = A.window_starts(doc, n)
    found, texts = [A.window_hashes(h, w, n)], [doc[w]]
    words = A.per_doc(doc, len(off) - 1)
    for k in range(1, n):  # a text of fewer words is one shingle
        short = np.flatnonzero(words == k)
        found.append(A.window_hashes(h, np.searchsorted(doc, short), k))
        texts.append(short)
    found, texts = np.concatenate(found), np.concatenate(texts)
    order = np.lexsort((found, texts))
    found, texts = found[order], texts[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (texts[1:] != texts[:-1])
    return found[new], texts[new]


def sketch(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Registers (texts x REGISTERS) of the sets that begin at ``first`` in ``h``."""
    x = (A.mix(h) >> np.uint64(32)).astype(np.uint32)
    least = np.empty((REGISTERS, len(first)), np.uint32)
    for i in range(REGISTERS):
        least[i] = np.minimum.reduceat(x * _MUL[i] + _ADD[i], first)
    rate = -np.log1p(-(least.T.astype(np.float64) + 0.5) / 2.0**32) / RATE
    return np.clip(np.floor(1.0 - np.log(rate) / np.log(BASE)), 0, TOP + 1).astype(np.uint16)


SIGNATURE = T.StructType([
    T.StructField("n", T.LongType()), T.StructField("s1", T.LongType()), T.StructField("s2", T.LongType()),
    T.StructField("regs", T.BinaryType())])


def signatures(n: int):
    def run(data: np.ndarray, off: np.ndarray) -> dict:
        h, doc = shingles(data, off, n)
        count = A.per_doc(doc, len(off) - 1)
        full = np.flatnonzero(count)
        first = (np.cumsum(count) - count)[full]
        s1, s2 = np.zeros(len(count), np.uint64), np.zeros(len(count), np.uint64)
        regs = [b""] * len(count)
        if len(full):
            s1[full] = np.add.reduceat(A.mix(h), first)
            s2[full] = np.add.reduceat(A.mix(h * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(1)), first)
            for d, r in zip(full, sketch(h, first), strict=True):
                regs[d] = r.tobytes()
        return {"n": count, "s1": s1.view(np.int64), "s2": s2.view(np.int64), "regs": regs}

    return run


def in_bands(nodes: DataFrame) -> DataFrame:
    """(node, bucket): the hash of each band's registers and number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            r = np.frombuffer(b"".join(batch.column("regs").to_pylist()), np.uint16).reshape(len(batch), REGISTERS)
            parts = r[:, : BANDS * BAND].reshape(len(batch), BANDS, BAND).astype(np.uint64)
            key = np.repeat(np.arange(1, BANDS + 1, dtype=np.uint64)[None, :], len(batch), 0)
            for j in range(BAND):
                key = A.mix(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, j])
            node = batch.column("node").take(pa.array(np.repeat(np.arange(len(batch)), BANDS)))
            yield pa.RecordBatch.from_arrays([node, pa.array(key.reshape(-1).view(np.int64))], names=["node", "bucket"])
        A.give_back()

    return nodes.select("node", "regs").mapInArrow(run, T.StructType([nodes.schema["node"], T.StructField("bucket", T.LongType())]))


@functools.cache
def least_equal(registers: int, share: float) -> int:
    """Equal registers that two sets of equal size and similarity ``share`` have
    fewer of with probability ``MISS`` at most (exact binomial tail)."""
    k, tail = 0, (1 - share) ** registers
    while tail <= MISS:
        k += 1
        tail += math.comb(registers, k) * share**k * (1 - share) ** (registers - k)
    return k


def likely(ra: np.ndarray, rb: np.ndarray, na: np.ndarray, nb: np.ndarray, share: float) -> np.ndarray:
    """Whether the joint likelihood of two sketches allows a similarity of ``share``.

    The estimate of the similarity J maximises D+ log p(u - vJ) + D- log p(v - uJ)
    + D0 log(1 - both), where D+, D-, D0 count larger, smaller and equal registers,
    u and v are the sets' shares of the sizes' sum, and p(x) = -log_b(1 - x (b-1)/b).
    """
    up, down = (ra > rb).sum(-1), (ra < rb).sum(-1)
    same = ra.shape[-1] - up - down
    u = na / (na + nb)
    v = 1.0 - u
    lo, hi = np.zeros(len(u)), np.minimum(u / v, v / u)

    def p(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    def loss(j: np.ndarray) -> np.ndarray:
        a, b = p(u - v * j), p(v - u * j)
        tiny = 1e-12
        return -(up * np.log(np.maximum(a, tiny)) + down * np.log(np.maximum(b, tiny))
                 + same * np.log(np.maximum(1 - a - b, tiny)))

    top = hi.copy()
    for _ in range(24):  # the likelihood is concave: keep the better two thirds
        c, d = lo + (hi - lo) / 3, hi - (hi - lo) / 3
        left = loss(c) < loss(d)
        hi, lo = np.where(left, d, hi), np.where(left, lo, c)
    least = (least_equal(ra.shape[-1], share) - 0.5) / ra.shape[-1]
    return ((lo + hi) / 2 >= least) & (top >= share - 1e-9)


def likely_pairs(pairs: DataFrame, nodes: DataFrame, share: float) -> DataFrame:
    """Pairs (a, b) whose sketches may be of sets that similar."""
    side = lambda s: nodes.select(F.col("node").alias(s), F.col("n").alias(f"n{s}"), F.col("regs").alias(f"r{s}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    both = both.where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * F.lit(round(share * 100)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, len(batch), 4096):
                part = batch.slice(i, 4096)
                if not len(part):
                    continue
                ra, rb = (np.frombuffer(b"".join(part.column(c).to_pylist()), np.uint16).reshape(len(part), -1) for c in ("ra", "rb"))
                na, nb = (part.column(c).to_numpy().astype(float) for c in ("na", "nb"))
                yield part.select(["a", "b"]).filter(pa.array(likely(ra, rb, na, nb, share)))
        A.give_back()

    return both.select("a", "b", "na", "ra", "nb", "rb").mapInArrow(run, pairs.select("a", "b").schema)


def full_sets(wanted: DataFrame, nodes: DataFrame, texts: DataFrame, n: int) -> DataFrame:
    """(node, set): the sorted shingle hashes of the wanted nodes, from their texts."""

    def run(data: np.ndarray, off: np.ndarray) -> dict:
        h, doc = shingles(data, off, n)
        ends = np.concatenate([[0], np.cumsum(A.per_doc(doc, len(off) - 1))])
        return {"set": [h[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]}

    # The one text of each class that its node is named after. A filter of fixed
    # size keeps most other texts from being shuffled.
    chosen = materialized(
        nodes.join(wanted, "node", "left_semi").select("node", F.col("id").alias("want_id"), F.col("th").alias("want")))
    bits = filter_bits(chosen.select(F.col("want").alias("h")))

    def may_be_wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(may_have(bits, batch.column("th").to_numpy().view(np.uint64))))

    some = texts.where("text is not null").mapInArrow(may_be_wanted, texts.schema)
    rows = some.join(chosen, (some["id"] == chosen["want_id"]) & (some["th"] == chosen["want"])).select("node", "text")
    sets = A.per_text(rows, ["node"], "text", run, T.StructType([T.StructField("set", T.BinaryType())]))
    return written(sets.dropDuplicates(["node"]))


def verified(pairs: DataFrame, sets: DataFrame, share: float) -> DataFrame:
    """Pairs (a, b) whose full shingle sets are that similar."""
    both = (pairs.join(sets.select(F.col("node").alias("a"), F.col("set").alias("sa")), "a")
            .join(sets.select(F.col("node").alias("b"), F.col("set").alias("sb")), "b"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = round(share * 100)
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("sa"), batch.column("sb"), strict=True):
                x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (x, y))
                both_have = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both_have >= least * (len(x) + len(y) - both_have))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
        A.give_back()

    return both.select("a", "b", "sa", "sb").mapInArrow(check, pairs.select("a", "b").schema)


def dealt_out(members: DataFrame) -> tuple[DataFrame, int]:
    """Rows of groups in which members of different components must be compared.

    ``members``: group, node, comp. The members of a group's largest component
    need not be compared with one another, so only the others ("strays") are,
    with all. Both sides are dealt in blocks of ``BLOCK`` at most by a hash; a task
    gets blocks of members and strays (columns m and s), whatever the group's
    size. Also returns how many tasks the pairs are to be dealt to.
    """
    sizes = members.groupBy("group", "comp").agg(F.count(F.lit(1)).alias("c"))
    def blocks(n: Column) -> Column:
        return F.greatest(F.ceil(n / BLOCK), F.least(F.lit(PARTS), F.ceil(n / PART))).cast("int")

    groups = written(sizes.groupBy("group").agg(
        F.max(F.struct("c", "comp"))["comp"].alias("major"), F.sum("c").alias("members"), F.max("c").alias("most"),
    ).where("members > most").select(
        "group", "major", "members", blocks(F.col("members")).alias("mb"), blocks(F.col("members") - F.col("most")).alias("sb"),
        (F.col("members") * (F.col("members") - F.col("most"))).alias("pairs")))
    work = groups.agg(F.sum("pairs"), F.sum(F.col("mb") * F.col("sb").cast("long"))).first()
    tasks = max(1, min(-(-(work[0] or 0) // PAIRS), work[1] or 0))
    joined = join_spread(members, groups.drop("pairs"), ["group"], "members", F.col("node"))

    def places(k: str, stray: bool, at) -> Column:
        return F.transform(F.sequence(F.lit(0), F.col(k) - 1), lambda i: F.struct(F.lit(stray).alias("stray"), *at(i)))

    own = lambda k: F.pmod(F.xxhash64("node"), k).cast("int")
    as_member = places("sb", False, lambda i: (own("mb").alias("m"), i.alias("s")))
    as_stray = places("mb", True, lambda i: (i.alias("m"), own("sb").alias("s")))
    return joined.select(
        "group", "node", "comp",
        F.explode(F.when(F.col("comp") == F.col("major"), as_member).otherwise(F.concat(as_member, as_stray))).alias("at"),
    ).select("group", "node", "comp", "at.*"), tasks


def compared(members: DataFrame, values: DataFrame, compare: Callable[[pd.DataFrame], pd.DataFrame]) -> DataFrame:
    """Distinct pairs (a, b) that ``compare`` finds in each block of strays and
    members with their ``values``, tasks taking blocks by number of pairs."""
    node = dict(members.dtypes)["node"]
    rows, tasks = dealt_out(members)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = compare(pdf)
        if len(pdf) >= PART:  # what a large block took goes back before the worker waits for others
            A.give_back()
        return out

    return (rows.join(values, "node").repartition(tasks, "group", "m", "s").groupBy("group", "m", "s")
            .applyInPandas(run, f"a {node}, b {node}").distinct())


def links_inside(members: DataFrame, sets: DataFrame, share: float) -> DataFrame:
    """Linked pairs across the components of a group, from full sets.

    ``members``: group, node, comp; ``sets``: node, set. A task counts common shingles of its
    strays with all its members through an index of the members' shingles.
    """
    least = round(share * 100)

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        ids, comp, stray = pdf["node"].to_numpy(), pdf["comp"].to_numpy(), pdf["stray"].to_numpy(bool)
        sets = [np.frombuffer(s, np.uint64) for s in pdf["set"]]
        size = np.array([len(s) for s in sets])
        others = np.flatnonzero(~stray)
        out = [pd.DataFrame({"a": ids[:0], "b": ids[:0]})]
        if len(others):
            flat = np.concatenate([sets[i] for i in others])
            order = np.argsort(flat, kind="stable")
            flat, owner = flat[order], np.repeat(np.arange(len(others)), size[others])[order]
            for i in np.flatnonzero(stray):
                lo, hi = np.searchsorted(flat, sets[i]), np.searchsorted(flat, sets[i], side="right")
                k = hi - lo
                at = np.arange(k.sum()) + np.repeat(lo - np.cumsum(k) + k, k)
                common = np.bincount(owner[at], minlength=len(others))
                j = others[(100 * common >= least * (size[others] + size[i] - common)) & (comp[others] != comp[i])]
                if len(j):
                    out.append(pd.DataFrame({"a": np.maximum(ids[j], ids[i]), "b": np.minimum(ids[j], ids[i])}))
        return pd.concat(out)

    return compared(members, sets, compare)


def cross_pairs(members: DataFrame, sketches: DataFrame, share: float) -> DataFrame:
    """Likely pairs across the components of a group: ``members`` has group,
    node, comp, ``sketches`` node, n, regs. Pairs form inside a task as arrays and leave it only
    if the sketches allow the similarity."""

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        regs = np.frombuffer(b"".join(pdf["regs"]), np.uint16).reshape(len(pdf), -1)
        size, comp, ids = pdf["n"].to_numpy(float), pdf["comp"].to_numpy(), pdf["node"].to_numpy()
        stray = pdf["stray"].to_numpy(bool)
        others = np.flatnonzero(~stray)
        out = [pd.DataFrame({"a": ids[:0], "b": ids[:0]})]
        for i in np.flatnonzero(stray):
            j = others[comp[others] != comp[i]]
            j = j[np.minimum(size[j], size[i]) >= share * np.maximum(size[j], size[i]) - 1e-9]
            if len(j):
                j = j[likely(regs[i][None, :], regs[j], np.full(len(j), size[i]), size[j], share)]
                out.append(pd.DataFrame({"a": np.maximum(ids[j], ids[i]), "b": np.minimum(ids[j], ids[i])}))
        return pd.concat(out)

    return compared(members, sketches, compare)


def near_labels(edges: DataFrame) -> DataFrame:
    """(node, label): the least neighbour's least neighbour, two steps on.

    Nodes of one label are connected; connected nodes mostly, but not always,
    have one label, and where labels differ pairs are compared once more. A
    few joins do, where true components take many rounds.
    """
    both = edges.select(F.explode(F.array(
        F.struct(F.col("a").alias("node"), F.col("b").alias("other")), F.struct(F.col("b").alias("node"), F.col("a").alias("other")))).alias("e"))
    label = both.select("e.*").groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("label"))
    for _ in range(2):
        on = label.select(F.col("node").alias("label"), F.col("label").alias("next"))
        label = label.join(on, "label").select("node", F.col("next").alias("label"))
    return label


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, share: float = 0.8,
) -> DataFrame:
    """Groups of texts linked by the Jaccard similarity of their shingle sets.

    Words are runs of characters other than blanks, A-Z lower-cased; a text's
    set are its distinct ``shingle``-word shingles, or its whole sequence as
    one if it has fewer words. Texts with 100 * intersection >= 100 * share *
    union are linked.

    Returns the input columns plus ``n_shingles``, ``component_id`` (the
    smallest id reachable over links, its own included) and ``kept``
    (``component_id`` equals the id). Columns of these names, in any case, are
    replaced.

    Defined cases: NULL texts and texts without words have an empty set and
    are linked with nothing; a row with a NULL id links nothing, its
    ``component_id`` is NULL and it is kept; rows with the same id and text
    are one text and are all kept or all dropped; different texts of one id
    are compared each for itself; an empty table is fine. Sets
    are compared as sets of 64-bit shingle hashes.

    Scale: equal sets are one node, numbered when nodes are written, so copies
    are never paired. In a bucket
    every node is paired with the least one only; what that leaves apart is
    compared across components, in blocks of bounded size, with the full sets
    as the judge.
    Copies and near copies of one text therefore cost rows in proportion to
    their number. Sketches, links and component rounds are written to the
    shared folder; nothing but their counts reaches the driver.
    """
    added = ("n_shingles", "component_id", "kept")
    base = docs.select(row_struct(docs, *added).alias("row"), col(id_col).alias("id"), F.xxhash64(col(text_col)).alias("th"),
                       col(text_col).alias("text"))
    texts = base.select("id", "th", "text")
    signed = written(A.per_text(texts, ["id", "th"], "text", signatures(shingle), SIGNATURE))
    nodes = written(
        signed.where("n > 0 and id is not null").groupBy("s1", "s2")
        .agg(F.min(F.struct("id", "th")).alias("least"), F.first("n").alias("n"), F.first("regs").alias("regs"))
        .select(F.monotonically_increasing_id().alias("node"), "least.id", "least.th", "s1", "s2", "n", "regs"))
    banded = in_bands(nodes)
    shared = written(
        banded.groupBy("bucket").agg(F.min("node").alias("rep"), F.count(F.lit(1)).alias("size")).where("size > 1"))
    in_bucket = written(join_spread(banded, shared, ["bucket"], "size", F.col("node")))

    lean = nodes.select("node", "n", "regs")
    stars = in_bucket.where("node <> rep").select(F.col("node").alias("a"), F.col("rep").alias("b")).distinct()
    tested = written(likely_pairs(stars, lean, share))
    groups = connected_components(tested)
    # What stars leave apart: pairs of a bucket that lie in different groups of likely
    # pairs. (A bucket of two holds no other pair than the one that is tested.)
    left = written(in_bucket.where("size > 2 and node <> rep").select(F.col("bucket").alias("group"), "node").join(groups, "node", "left")
            .select("group", "node", F.coalesce("root", "node").alias("comp")))
    forget(in_bucket, shared)
    between = cross_pairs(left, lean, share).join(tested, ["a", "b"], "left_anti")
    pairs = written(tested.union(between))
    forget(left, tested)
    sets = full_sets(
        pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), nodes, texts, shingle)
    links = written(verified(pairs, sets, share))
    forget(pairs)
    # And pairs inside such a group: each node is in one, so its full set is there to decide.
    apart = written(groups.join(near_labels(links).withColumnRenamed("label", "own"), "node", "left").select(
        F.col("root").alias("group"), "node", F.coalesce("own", "node").alias("comp")))
    linked = written(links.union(links_inside(apart, sets, share)))
    forget(groups, apart, sets, links)
    roots = connected_components(linked)
    forget(linked)

    least = roots.join(nodes.select("node", "id"), "node").groupBy("root").agg(F.min("id").alias("least"))
    labels = nodes.join(roots.join(least, "root"), "node", "left").select(
        F.col("s1").alias("l1"), F.col("s2").alias("l2"), F.coalesce("least", nodes["id"]).alias("root"))
    result = (
        signed.select("id", "th", "n", "s1", "s2").distinct()
        .join(labels, (F.col("s1") == F.col("l1")) & (F.col("s2") == F.col("l2")) & (F.col("n") > 0), "left")
        .select(F.col("id").alias("i"), F.col("th").alias("t"), F.col("n").alias("n_shingles"),
                F.when(F.col("id").isNotNull(), F.coalesce("root", "id")).alias("component_id"))
    )
    kept = others(docs, *added)
    return (
        base.select("row", "id", "th")
        .join(result, F.col("id").eqNullSafe(F.col("i")) & (F.col("th") == F.col("t")), "left")
        .select(
            *[F.col("row")[c].alias(c) for c in kept],
            F.col("n_shingles"), "component_id",
            F.coalesce(F.col("component_id") == F.col("id"), F.lit(True)).alias("kept"))
    )
