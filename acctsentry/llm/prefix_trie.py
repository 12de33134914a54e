"""The trie of conversation prefixes, built in range shards.

Turns are encoded by a dictionary, conversations become sequences of its
numbers, and equal ones become one. Sorted ranges of them are made into
ternary search trees, block by block; their traversal adds up members, ends,
leaves and words. Prefixes at the edges of a block, which others may share,
are merged by key.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from acctsentry.llm.common import col, materialized
from acctsentry.llm.ternary import prefix_totals
from acctsentry.operators.skew import join_spread, ranked

WORD = r"[^\x20\x09-\x0D]+"
#: Turns of a conversation that one row holds; longer ones go on in rows that
#: begin at multiples of it and know the prefix before them by its key. No lead may be longer.
SEGMENT = 256
#: Ids that one piece of an end list holds.
PIECE = 4096
NONE = (1 << 63) - 1

#: A prefix (its key is depth, a, b; pa and pb belong to the one above it).
PARTS = T.StructType([
    T.StructField("depth", T.LongType()), T.StructField("a", T.LongType()), T.StructField("b", T.LongType()),
    T.StructField("pa", T.LongType()), T.StructField("pb", T.LongType()), T.StructField("above", T.LongType()),
    T.StructField("n", T.LongType()), T.StructField("ends", T.LongType()), T.StructField("reused", T.LongType()),
    T.StructField("leaves", T.LongType()), T.StructField("children", T.LongType()),
    T.StructField("conv", T.LongType()), T.StructField("own", T.LongType()),
    T.StructField("words", T.LongType()), T.StructField("before", T.LongType()), T.StructField("edge", T.BooleanType())])
KEY = ["depth", "a", "b"]


def encoded(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv, place, id, words): each turn's place in its conversation, its
    number in the dictionary of distinct turns and its text's words."""
    role, text = (F.coalesce(col(c), F.lit("")) for c in (role_col, text_col))
    rows = materialized(turns.where(col(conv_col).isNotNull()).select(
        col(conv_col).cast("long").alias("conv"), col(turn_col).alias("turn"),
        F.xxhash64(F.lit(1), role, text).alias("ra"), F.xxhash64(F.lit(2), text, role).alias("rb"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words")))
    dictionary = materialized(rows.groupBy("ra", "rb").agg(F.count(F.lit(1)).alias("uses")).select(
        "ra", "rb", "uses", F.monotonically_increasing_id().alias("id")))
    placed = ranked(rows, ["conv"], ["turn", "ra", "rb"], "place")
    return join_spread(placed, dictionary, ["ra", "rb"], "uses", F.struct("conv", "place")).select("conv", "place", "id", "words")


@dataclass
class Lead:
    """Turns that conversations begin with in place of their own: ``skip``
    tells from a conversation's id how many of its own these replace,
    ``first`` makes (conv, first: array of (id, words)) from (conv, place, id,
    words)."""

    skip: Callable[[Column], Column]
    first: Callable[[DataFrame], DataFrame]


STEPS = "array<struct<id:bigint,words:bigint>>"
#: Each conversation as it is.
PLAIN = Lead(lambda conv: F.lit(0), lambda turns: turns.groupBy("conv").agg(F.lit(1).alias("one")).select(
    "conv", F.array().cast(STEPS).alias("first")))


def segments(turns: DataFrame, heads: DataFrame, skip: Column, segment: int) -> DataFrame:
    """(conv, seg, steps): ``heads`` (conv, first) and then the conversation's
    own turns after its first ``skip``, cut at multiples of ``segment``."""
    step = F.struct("id", "words")
    own = (
        turns.withColumn("at", F.col("place") - skip - 1).where("at >= 0")
        .groupBy("conv", F.floor(F.col("at") / segment).cast("long").alias("seg"))
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("at", step.alias("s")))), lambda x: x["s"]).alias("steps"))
    )
    both = own.join(heads.where(F.size("first") > 0).select("conv", F.size("first").alias("k")), "conv", "left").withColumn(
        "k", F.coalesce("k", F.lit(0)))
    fits = F.lit(segment) - F.col("k")
    piece = lambda seg, order, steps: F.struct(seg.alias("seg"), F.lit(order).alias("o"), steps.alias("steps"))
    cut = both.select("conv", F.explode(F.array(
        piece(F.col("seg"), 1, F.slice("steps", F.lit(1), fits)),
        piece(F.col("seg") + 1, 0, F.slice("steps", fits + 1, F.lit(segment))))).alias("p")).select("conv", "p.*")
    begin = heads.select("conv", F.lit(0).cast("long").alias("seg"), F.lit(0).alias("o"), F.col("first").alias("steps"))
    return (
        cut.unionByName(begin).where(F.size("steps") > 0).groupBy("conv", "seg")
        .agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("o", "steps"))), lambda x: x["steps"])).alias("steps"))
    )


def hashes(ids: Column, seg: Column, kind: int, segment: int) -> Column:
    return F.transform(ids, lambda x, i: F.xxhash64(F.lit(kind), x, seg * segment + i))


def keyed(segs: DataFrame, segment: int) -> DataFrame:
    """Segments with the key of the prefix before them (a xor of hashes of
    (number, place), so that the segments of a long conversation add up), the
    words before them, and whether they are their conversation's last."""
    xor = lambda kind: F.aggregate(
        hashes(F.transform("steps", lambda s: s["id"]), F.col("seg"), kind, segment), F.lit(0).cast("long"), lambda x, y: x.bitwiseXOR(y))
    own = segs.withColumns({"xa": xor(1), "xb": xor(2), "own_words": F.aggregate("steps", F.lit(0).cast("long"), lambda x, s: x + s["words"])})
    by = W.partitionBy("conv").orderBy("seg")
    earlier = by.rowsBetween(W.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    return own.withColumns({
        "a": F.coalesce(F.bit_xor("xa").over(earlier), zero), "b": F.coalesce(F.bit_xor("xb").over(earlier), zero),
        "before": F.coalesce(F.sum("own_words").over(earlier), zero), "last": F.lead("seg").over(by).isNull()})


def prefixes(segs: DataFrame, segment: int) -> DataFrame:
    """Prefixes of all sequences, written; those with ``edge`` are partial.

    ``segs``: keyed segments with ``leaf`` and ``reused`` of their
    conversations. Equal sequences are counted before they are shuffled.
    """
    classes = segs.groupBy("seg", "a", "b", F.transform("steps", lambda s: s["id"]).alias("ids")).agg(
        F.first(F.transform("steps", lambda s: s["words"])).alias("ws"), F.first("before").alias("before"),
        F.count(F.lit(1)).alias("n"), F.sum(F.col("last").cast("long")).alias("ends"), F.sum("reused").alias("reused"),
        F.sum("leaf").alias("leaves"), F.min(F.struct("conv", "reused")).alias("least"))
    sort = ["seg", "a", "b", "ids"]
    ranges = classes.repartitionByRange(*sort).sortWithinPartitions(*sort).select(
        "seg", "a", "b", "ids", "ws", hashes(F.col("ids"), F.col("seg"), 1, segment).alias("ha"),
        hashes(F.col("ids"), F.col("seg"), 2, segment).alias("hb"), "before", "n", "ends", "reused", "leaves",
        F.col("least.conv").alias("conv"), F.col("least.reused").alias("own"))
    arrow = to_arrow_schema(PARTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, type=f.type) for v, f in zip(block_prefixes(batch, segment), arrow)], schema=arrow)

    return materialized(ranges.mapInArrow(run, PARTS))


def block_prefixes(batch: pa.RecordBatch, segment: int) -> list[np.ndarray]:
    """The columns of ``PARTS`` for one block of sorted sequences."""
    flat = {c: batch.column(c).to_numpy() for c in ("seg", "a", "b", "before", "n", "ends", "reused", "leaves", "conv", "own")}
    ids = batch.column("ids").to_pylist()
    ws, ha, hb = (batch.column(c).flatten().to_numpy() for c in ("ws", "ha", "hb"))
    off = np.concatenate([[0], np.cumsum([len(x) for x in ids])])
    sums = np.stack([flat[c] for c in ("n", "ends", "reused", "leaves")], 1)
    least = list(zip(flat["conv"].tolist(), flat["own"].tolist()))
    new = np.flatnonzero(np.r_[True, (np.diff(flat["seg"]) != 0) | (np.diff(flat["a"]) != 0) | (np.diff(flat["b"]) != 0)])
    runs = list(zip(new.tolist(), [*new[1:].tolist(), len(ids)]))
    # What a sequence's symbols add up to so far, told from sums over the whole block.
    along = {"a": np.concatenate([[0], np.bitwise_xor.accumulate(ha)]), "b": np.concatenate([[0], np.bitwise_xor.accumulate(hb)]),
             "before": np.concatenate([[0], np.cumsum(ws)])}

    def at(name: str, i: np.ndarray, length: np.ndarray) -> np.ndarray:
        sums = along[name]
        if name == "before":
            return flat[name][i] + sums[off[i] + length] - sums[off[i]]
        return flat[name][i] ^ sums[off[i] + length] ^ sums[off[i]]

    out: list[list[np.ndarray]] = []
    for lo, hi in runs:
        got = prefix_totals(ids[lo:hi], sums[lo:hi], least[lo:hi])
        m, of, length, parent = len(got["of"]), got["of"] + lo, got["length"], got["parent"]
        before = at("before", of, length - 1)
        start = int(flat["seg"][lo]) * segment
        outer = lo == 0 or hi == len(ids)  # other runs lie in this block alone
        edge = (got["edge"] & outer) | (length == segment)
        inner = np.flatnonzero(parent >= 0)
        above = np.full(m, -1, np.int64)  # row of a prefix above that is complete here
        above[inner] = np.where(edge[parent[inner]], -1, parent[inner])
        known = above >= 0
        # Children at edges are counted once all blocks are merged, but for a prefix that is complete.
        children = got["children"].copy()
        hidden = inner[edge[inner] & edge[parent[inner]]]
        np.subtract.at(children, parent[hidden], 1)
        top = np.flatnonzero(parent < 0)
        node = [start + length, *(at(c, of, k) for k in (length, length - 1) for c in ("a", "b")),
                np.where(known, got["least"][above, 0], NONE), *got["sums"].T, children,
                got["least"][:, 0], got["least"][:, 1], at("before", of, length) - before, before, edge]
        # The prefix before the run: it has its members from elsewhere, and children from here.
        root = [start, flat["a"][lo], flat["b"][lo], 0, 0, NONE, 0, 0, 0, 0, int((~edge[top]).sum()), NONE, 0, 0, 0, True]
        out.append([np.append(x, np.array([y], x.dtype)) for x, y in zip(node, root)])
    return [np.concatenate(x) for x in zip(*out)]


def merged(parts: DataFrame, root: DataFrame) -> DataFrame:
    """The edge prefixes of all blocks as whole ones. ``root`` has the members of the empty prefix."""
    whole = parts.where("edge").unionByName(root).groupBy(*KEY).agg(
        *[F.sum(c).alias(c) for c in ("n", "ends", "reused", "leaves", "children")],
        F.min(F.struct("conv", "own")).alias("least"), F.min("above").alias("above"),
        # A prefix's start row knows nothing of it but children, and has no members.
        *[F.max_by(c, F.struct("n", F.col("words"))).alias(c) for c in ("pa", "pb", "words", "before")],
    ).where(F.col("least.conv") < NONE)
    whole = materialized(whole.select(*KEY, "pa", "pb", "above", "n", "ends", "reused", "leaves", "children",
                                      F.col("least.conv").alias("conv"), F.col("least.own").alias("own"), "words", "before"))
    more = whole.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("pa").alias("a"), F.col("pb").alias("b")).agg(
        F.count(F.lit(1)).alias("more"))
    return materialized(whole.join(more, KEY, "left").withColumn("children", F.col("children") + F.coalesce("more", F.lit(0))).drop("more"))


def end_lists(ends: DataFrame) -> DataFrame:
    """KEY, ``sha``: SHA-256 of the conversations (``conv``) that end at a
    prefix, ascending, comma-joined.

    A list may be long: sorted ranges become pieces of text first, in as many
    tasks as there are ranges, and one task takes a list's pieces one by one.
    """
    sort = [*KEY, "conv"]
    whole = T.StructType([T.StructField(c, T.LongType()) for c in KEY])
    text, sha = (T.StructType([*whole.fields, *more]) for more in (
        [T.StructField("first", T.LongType()), T.StructField("ids", T.StringType())], [T.StructField("sha", T.StringType())]))

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k = np.stack([batch.column(c).to_numpy() for c in KEY])
            conv = batch.column("conv").to_numpy()
            new = np.flatnonzero(np.r_[True, (k[:, 1:] != k[:, :-1]).any(0)]) if len(conv) else np.zeros(0, np.int64)
            cut = [x for lo, hi in zip(new, [*new[1:], len(conv)]) for x in range(lo, hi, PIECE)]
            ids = [",".join(map(str, conv[lo:min(hi, lo + PIECE)])) for lo, hi in zip(cut, [*cut[1:], len(conv)])]
            at = np.array(cut, np.int64)
            yield pa.RecordBatch.from_arrays([*(pa.array(x[at]) for x in k), pa.array(conv[at]), pa.array(ids, pa.string())], names=text.names)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, h = None, hashlib.sha256()
        for batch in batches:
            done: list[tuple] = []
            for *key, ids in zip(*(batch.column(c).to_pylist() for c in KEY), batch.column("ids").to_pylist()):
                if key != now:
                    if now is not None:
                        done.append((*now, h.hexdigest()))
                    now, h = key, hashlib.sha256(ids.encode())
                else:
                    h.update(b"," + ids.encode())
            yield _rows(done, sha)
        if now is not None:
            yield _rows([(*now, h.hexdigest())], sha)

    made = ends.repartitionByRange(*sort).sortWithinPartitions(*sort).mapInArrow(pieces, text)
    return made.repartition(*KEY).sortWithinPartitions(*KEY, "first").mapInArrow(digests, sha)


def _rows(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    arrow = to_arrow_schema(schema)
    columns = list(zip(*rows)) if rows else [[] for _ in arrow]
    return pa.RecordBatch.from_arrays([pa.array(x, type=f.type) for x, f in zip(columns, arrow)], schema=arrow)


def rebuilt(block: int = 20, most: int = 4) -> Lead:
    """Conversation c begins with the first h turns of conversation c - c %
    block (all, if it has fewer, none, if there is no such one) in place of its
    own first h; h is crc32(c, in decimal) % most."""

    def skip(conv: Column) -> Column:
        return (F.crc32(conv.cast("string")) % most).cast("int")

    def first(turns: DataFrame) -> DataFrame:
        starts = turns.where((F.col("conv") % block == 0) & (F.col("place") < most)).groupBy(F.col("conv").alias("base")).agg(
            F.transform(F.array_sort(F.collect_list(F.struct("place", F.struct("id", "words").alias("s")))), lambda x: x["s"]).alias("all"))
        convs = turns.groupBy("conv").agg((F.first("conv") - F.first("conv") % block).alias("base"))
        return convs.join(starts, "base", "left").select(
            "conv", F.coalesce(F.slice("all", F.lit(1), skip(F.col("conv"))), F.array().cast(STEPS)).alias("first"))

    return Lead(skip, first)


def prefix_trie(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    lead: Lead = PLAIN, segment: int = SEGMENT,
) -> DataFrame:
    """One row per distinct prefix of the conversations' turn sequences.

    A turn is its role and text. ``lead`` (see ``rebuilt``) may give
    conversations other first turns. A conversation is a member of all its
    prefixes, the empty one (depth 0) included.

    Returns ``conv_id`` (the smallest member), ``depth``, ``parent_conv_id``
    (the same of the prefix one shorter), ``n_convs``, ``n_children``,
    ``n_leaves`` (prefixes without children in the subtree, itself included),
    ``saved_tokens`` (over the subtree, members less one times the last text's
    words), ``ends_sha256`` (of the members that end here, ascending,
    comma-joined) and ``words`` (of the last text).

    Defined cases: turns are ordered by number, NULL first, those of one
    number by a hash of role and text; a NULL role or text counts as empty;
    repeated rows are turns of their own; rows with a NULL conversation
    belong to none and are left out; a conversation that loses all turns to
    its lead ends at the empty prefix; an empty table gives no rows; other
    columns are ignored. Prefixes are told apart by 128-bit keys.

    Scale: texts are hashed in place and never move. Conversations are cut
    into segments of ``segment`` turns, so no row or task holds a whole long
    one; equal sequences are counted before the range shuffle. Savings and
    leaves need no walk up the trie: members' totals add up. With R(c) the
    words that c shares with a smaller member, a prefix with smallest member
    m and w words before its last turn saves the sum of R over its members,
    less R(m), less w for each other one. R and leaves come from a first pass
    over the same trees. Only the edges of blocks are merged by key.
    """
    coded = materialized(encoded(turns, conv_col, turn_col, role_col, text_col))
    heads = materialized(lead.first(coded))
    segs = materialized(keyed(segments(coded, heads, lead.skip(F.col("conv")), segment), segment))
    zero = F.lit(0).cast("long")

    def root(convs: DataFrame) -> DataFrame:
        return convs.groupBy().agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.col("turnless").cast("long")).alias("ends"), F.sum("reused").alias("reused"),
            F.sum("leaf").alias("leaves"), F.min(F.struct("conv", "reused")).alias("least"),
        ).where("n > 0").select(
            *[zero.alias(c) for c in ("depth", "a", "b", "pa", "pb")], F.lit(NONE).alias("above"), "n", "ends", "reused", "leaves",
            zero.alias("children"), F.col("least.conv").alias("conv"), F.col("least.reused").alias("own"), zero.alias("words"),
            zero.alias("before"), F.lit(True).alias("edge"))

    total = segs.groupBy("conv").agg(F.sum("own_words").alias("all_words"))
    convs = heads.select("conv").join(total, "conv", "left").select(
        "conv", F.coalesce("all_words", zero).alias("all_words"), F.col("all_words").isNull().alias("turnless"))
    bare = {"leaf": zero, "reused": zero}
    parts = prefixes(segs.withColumns(bare), segment)
    first = parts.where("not edge").select("conv", "words", "children").unionByName(
        merged(parts, root(convs.withColumns(bare))).select("conv", "words", "children"))
    owned = first.groupBy("conv").agg(F.sum("words").alias("owned"), F.sum((F.col("children") == 0).cast("long")).alias("leaf"))
    weighed = materialized(convs.join(owned, "conv", "left").select(
        "conv", "turnless", (F.col("all_words") - F.coalesce("owned", zero)).alias("reused"), F.coalesce("leaf", zero).alias("leaf")))

    parts = prefixes(segs.join(weighed.drop("turnless"), "conv"), segment)
    edges = merged(parts, root(weighed))
    nodes = parts.where("not edge").drop("edge").unionByName(edges)
    # Of a complete prefix above, the block has said the smallest member; the others are asked for.
    over = edges.select(F.col("depth").alias("od"), F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv").alias("over"), "children")
    asked = join_spread(
        nodes.where(f"above = {NONE} and depth > 0").withColumn("od", F.col("depth") - 1), over.withColumnRenamed("children", "kids"),
        ["od", "pa", "pb"], "kids", F.struct("a", "b")).drop("od", "kids")
    nodes = (nodes.where(f"above < {NONE}").withColumn("over", F.col("above"))
             .unionByName(asked).unionByName(nodes.where("depth = 0").withColumn("over", F.lit(None).cast("long"))))
    at_end = segs.where("last").select(
        (F.col("seg") * segment + F.size("steps")).cast("long").alias("depth"), F.col("a").bitwiseXOR(F.col("xa")).alias("a"),
        F.col("b").bitwiseXOR(F.col("xb")).alias("b"), "conv"
    ).unionByName(weighed.where("turnless").select(*[zero.alias(c) for c in KEY], "conv"))
    return nodes.join(end_lists(at_end), KEY, "left").select(
        F.col("conv").alias("conv_id"), "depth", F.col("over").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"),
        (F.col("reused") - F.col("own") - (F.col("n") - 1) * F.col("before")).alias("saved_tokens"),
        F.coalesce("sha", F.sha2(F.lit(""), 256)).alias("ends_sha256"), "words")
