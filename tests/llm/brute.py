"""Plain definitions of the operators' results, for small tables."""

import hashlib
import re
from collections import Counter, defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BLANK_WORD = re.compile(r"[^\x20\x09-\x0D]+")
ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(s: str) -> str:
    return hashlib.sha256(s.encode()).hexdigest()


def line_dedup(rows):
    """rows: (id, text) -> list of (id, kept text, lines, dropped)."""
    def key(line):
        return line.strip(" \t\n\x0b\f\r").translate(LOWER)

    holders = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            holders[key(line)].add(i)

    def low(i):
        return (i is not None, i)

    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        keep = [x for x in lines
                if len(k := key(x)) < 20 or len(holders[k]) < 3 or max(holders[k], key=low) == i]
        out.append((i, "\n".join(keep), len(lines), len(lines) - len(keep)))
    return out


def shingle_set(text, n):
    words = BLANK_WORD.findall((text or "").translate(LOWER))
    return {tuple(words[k : k + n]) for k in range(max(1, len(words) - n + 1))} if words else set()


def near_groups(rows, n, percent=80):
    """(id, text) with distinct ids -> {id: (set size, component)}."""
    sets = {i: shingle_set(t, n) for i, t in rows}
    holders = defaultdict(list)
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, s in sets.items():
        common = Counter(j for g in s for j in holders[g])
        for j, c in common.items():
            if 100 * c >= percent * (len(s) + len(sets[j]) - c):
                a, b = sorted((find(i), find(j)))
                root[b] = a
        for g in s:
            holders[g].append(i)
    return {i: (len(sets[i]), find(i)) for i in sets}


def contamination(rows, items):
    wins = defaultdict(set)
    for item, t in items:
        w = ITEM_WORD.findall((t or "").translate(LOWER))
        k = min(10, len(w))
        for a in range(len(w) - k + 1) if k else ():
            wins[tuple(w[a : a + k])].add(str(item))
    sizes = {len(w) for w in wins}
    out = []
    for i, t in rows:
        w = ITEM_WORD.findall((t or "").translate(LOWER))
        hit, found = set(), set()
        for k in sizes:
            for a in range(len(w) - k + 1):
                if (g := tuple(w[a : a + k])) in wins:
                    hit |= set(range(a, a + k))
                    found |= wins[g]
        out.append((i, len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return out


def quality(text, shares, line_share):
    t = text or ""
    words = BLANK_WORD.findall(t)
    n, chars = len(words), sum(map(len, words))
    threes = Counter(tuple(words[i : i + 3]) for i in range(n - 2))
    repeated = {i + j for i in range(n - 2) if threes[tuple(words[i : i + 3])] > 1 for j in range(3)}
    seen, dup, line_chars = set(), 0, 0
    for line in t.split("\n"):
        if w := BLANK_WORD.findall(line):
            if line in seen:
                dup += 1
                line_chars += sum(map(len, w))
            seen.add(line)
    failed = n < 50 or 100 * len(repeated) > 50 * n
    kept = not failed and line_chars <= line_share * chars
    for k, share in shares.items():
        seen_k, inside = set(), set()
        for i in range(n - k + 1):
            g = tuple(words[i : i + k])
            if g in seen_k:
                inside |= set(range(i, i + k))
            seen_k.add(g)
        kept = kept and sum(len(words[i]) for i in inside) <= share * chars
    return (n, chars, len(re.findall(r"[#*$%&|<>]", t)), dup, len(repeated), failed, kept)
