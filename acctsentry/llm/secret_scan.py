"""Secret scans over a trigram inverted index. DataFrame functions only.

Each rule's regular expression gives a Boolean query over trigrams that any
match must hold. The queries are answered from postings, and only documents
that satisfy a rule's query are scanned with its expression; a rule without
mandatory trigrams scans all.
"""

from __future__ import annotations

import re._constants as sre
import re._parser as sre_parser
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acctsentry.llm.common import col, let, others, row_struct


@dataclass(frozen=True)
class Rule:
    """``pattern`` finds matches from the left; those whose ``group`` has fewer
    than ``least`` characters are dropped afterwards."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


#: `[0-9a-f]+` of 16 and more characters: runs are maximal either way, so the
#: bound may stand in the expression; likewise for access keys.
BASE_RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]{16,}"),
)
#: Published formats of further credentials.
MORE_RULES = (
    Rule("github", r"gh[opsur]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abeprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("key_block", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
RULES = BASE_RULES + MORE_RULES

#: Alternatives that a query may have before the rest of an expression is left out of it.
MOST_CLAUSES = 64
#: Matches whose positions are summed in one go.
STEP = 256


def literals(tree) -> list[str] | None:
    """The strings that a part of an expression stands for, if these are few; lower case."""
    out = [""]
    for op, arg in tree:
        if op is sre.LITERAL:
            more: list[str] | None = [chr(arg).lower()]
        elif op is sre.SUBPATTERN:
            more = literals(arg[3])
        elif op is sre.BRANCH:
            parts = [literals(x) for x in arg[1]]
            more = None if None in parts else [s for p in parts for s in p]
        elif op is sre.IN and len(arg) <= 8 and all(o is sre.LITERAL for o, _ in arg):
            more = [chr(c).lower() for _, c in arg]
        elif op is sre.MAX_REPEAT and arg[:2] == (0, 1):
            more = None if (x := literals(arg[2])) is None else ["", *x]
        else:
            return None
        if more is None or len(out) * len(more) > MOST_CLAUSES:
            return None
        out = sorted({a + b for a in out for b in more})
    return out


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """Sets of lower-case trigrams; a match holds all of at least one set.

    An empty set among them (then the only one) means that nothing is mandatory.
    """
    clauses: list[tuple[frozenset[str], str]] = [(frozenset(), "")]

    def grams(s: str) -> frozenset[str]:
        return frozenset(s[i : i + 3] for i in range(len(s) - 2))

    for item in sre_parser.parse(pattern):
        more = literals([item])
        if more is not None and len(clauses) * len(more) <= MOST_CLAUSES:
            clauses = [(have, run + s) for have, run in clauses for s in more]
        else:
            clauses = [(have | grams(run), "") for have, run in clauses]
    found = {have | grams(run) for have, run in clauses}
    return sorted((c for c in found if not any(other < c for other in found)), key=sorted)


def spans(text: Column, rule: Rule, kind: int) -> Column:
    """The rule's matches as structs (start, kind, end) in code points, from the left.

    The stretches between matches give the positions: their lengths and the
    matches' are summed step by step, in blocks of ``STEP``, so that the work
    stays near linear in the number of matches of one text.
    """
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    part = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else whole

    def placed(items: Column, begin: Column) -> Column:
        out = F.aggregate(
            items, F.struct(begin.alias("at"), none.alias("out")),
            lambda acc, x: F.struct(
                (acc["at"] + x["gap"] + x["len"]).alias("at"),
                F.when(x["ok"], F.concat(acc["out"], F.array(F.struct(
                    (acc["at"] + x["gap"]).alias("start"), F.lit(kind).alias("kind"),
                    (acc["at"] + x["gap"] + x["len"]).alias("end"))))).otherwise(acc["out"]).alias("out")))
        return out["out"]

    def in_blocks(blocks: Column) -> Column:
        zero = F.lit(0).cast("long")
        begins = F.aggregate(
            blocks, F.array(zero),
            lambda acc, b: F.concat(acc, F.array(
                F.element_at(acc, -1) + F.aggregate(b, zero, lambda t, x: t + x["gap"] + x["len"]))))
        return let(begins, lambda at: F.flatten(F.transform(blocks, lambda b, k: placed(b, F.get(at, k)))))

    def found(m: Column) -> Column:
        gaps = F.split(text, rule.pattern, -1)
        items = let(F.struct(gaps.alias("gaps"), part.alias("part")), lambda s: F.transform(m, lambda x, i: F.struct(
            F.char_length(F.get(s["gaps"], i)).cast("long").alias("gap"), F.char_length(x).cast("long").alias("len"),
            (F.char_length(F.get(s["part"], i)) >= rule.least).alias("ok"))))
        blocks = let(items, lambda x: F.transform(
            F.sequence(F.lit(0), F.size(x) - 1, F.lit(STEP)), lambda s: F.slice(x, s + 1, STEP)))
        return F.when(F.size(m) == 0, none).otherwise(let(blocks, in_blocks))

    return let(whole, found)


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The input's columns and ``secrets``: all matches as structs (start, kind,
    end), by start and then by the rule's place in ``rules``; start and end in
    code points, end exclusive; ``kind`` is the rule's number.

    Matches of one rule don't overlap and are found from the left; those of
    different rules may overlap, and all stay. A column named ``secrets`` is
    replaced. Defined cases: a NULL or empty text has no matches; ids may
    repeat or be NULL (rows are told apart by id and text; equal rows get
    equal results); an empty table gives an empty table.

    Scale: the index holds the trigrams that some rule asks for and no others.
    A posting is a trigram's number with id and text hash; a document has at
    most as many as there are such trigrams, and they are combined with
    partial aggregates by document, so no trigram's list is ever gathered.
    """
    queries = {i: trigram_query(r.pattern) for i, r in enumerate(rules)}
    scan_all = [i for i, q in queries.items() if q == [frozenset()]]
    names = sorted({g for q in queries.values() for c in q for g in c})
    spark = docs.sparkSession
    base = docs.select(
        row_struct(docs, "secrets").alias("row"), col(id_col).alias("id"), F.xxhash64(col(text_col)).alias("th"),
        F.coalesce(col(text_col), F.lit("")).alias("text"))
    if names:
        held = let(F.lower("text"), lambda low: F.filter(F.array(*map(F.lit, names)), lambda g: F.contains(low, g)))
        postings = base.select("id", "th", F.explode(held).alias("gram"))
        # One row per trigram of a query's clause: as many as the rules have, whatever the documents hold.
        clauses = [
            (i, j, g, 1 << k, (1 << len(c)) - 1)
            for i, q in queries.items() if i not in scan_all for j, c in enumerate(q) for k, g in enumerate(sorted(c))]
        asked = spark.createDataFrame(clauses, "rule int, clause int, gram string, bit long, full long")
        met = (
            postings.join(F.broadcast(asked), "gram")
            .groupBy("id", "th", "rule", "clause").agg(F.bit_or("bit").alias("have"), F.max("full").alias("full"))
            .where("have = full")
            .groupBy(F.col("id").alias("cid"), F.col("th").alias("cth")).agg(F.collect_set("rule").alias("rules")))
        base = base.join(met, F.col("id").eqNullSafe(F.col("cid")) & (F.col("th") == F.col("cth")), "left")
    else:
        base = base.withColumn("rules", F.array().cast("array<int>"))
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    parts = [
        spans(F.col("text"), r, i) if i in scan_all
        else F.when(F.array_contains("rules", i), spans(F.col("text"), r, i)).otherwise(none)
        for i, r in enumerate(rules)]
    kept = others(docs, "secrets")
    return base.select(*[F.col("row")[c].alias(c) for c in kept], F.array_sort(F.concat(*parts)).alias("secrets"))


def span_list(secrets: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """``kind:start:end`` of each match, comma-joined."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(
        F.transform(secrets, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
