"""Token counts of a byte-level BPE vocabulary, by rank-synchronous merging.

The pre-tokens of a batch of texts are held as ragged numpy arrays. In each
round every sequence's lowest-rank pair is merged, in all sequences at once;
sequences without a pair leave with the count of their symbols.
"""

from __future__ import annotations

import json
import re
import unicodedata
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from acctsentry.llm import arrays as A

#: Distinct pre-tokens whose counts a worker remembers before it starts anew.
MEMORY = 1_000_000
#: Distinct pre-tokens merged at once.
ROUND = 200_000

_LETTER, _NUMBER, _SPACE, _OTHER = 1, 2, 3, 0
#: White space as the pre-token pattern's `\s` has it (fixed values).
_WHITE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


@lru_cache(1)
def classes() -> np.ndarray:
    """Letter, number, white space or other, by code point."""
    kind = {"L": _LETTER, "N": _NUMBER}
    out = np.fromiter((kind.get(unicodedata.category(chr(c))[0], _OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    out[_WHITE] = _SPACE
    return out


class Merges:
    """Merge table of a byte-level BPE file in the tokenizers JSON layout."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.size = max(vocab.values()) + 1
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], np.int64)
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        # Bytes that print stand for themselves, the others for 256, 257, ... (the file's alphabet).
        prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in prints]
        letter = {b: chr(b) for b in prints} | {b: chr(256 + i) for i, b in enumerate(rest)}
        self.byte_id = np.array([vocab[letter[b]] for b in range(256)], np.int64)
        special = [t["content"].encode() for t in spec.get("added_tokens", []) if t["content"]]
        special.sort(key=len, reverse=True)
        self.special = re.compile(b"|".join(map(re.escape, special))) if special else None

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair; the number of merges where there is none."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.order[at], len(self.keys))

    def count(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Symbols that are left of each byte span when no pair merges any more."""
        length = ends - starts
        seq = np.repeat(np.arange(len(starts)), length)
        at = np.arange(len(seq)) - np.repeat(np.cumsum(length) - length, length) + starts[seq]
        ids, none = self.byte_id[data[at]], len(self.keys)
        out = length.astype(np.int64)
        while len(seq):
            rank = np.full(len(seq), none, np.int64)
            inner = np.flatnonzero(seq[:-1] == seq[1:])
            rank[inner] = self.ranks(ids[inner], ids[inner + 1])
            head = np.flatnonzero(np.r_[True, seq[1:] != seq[:-1]])
            size = np.diff(np.r_[head, len(seq)])
            low = np.minimum.reduceat(rank, head)
            done = low == none
            out[seq[head[done]]] = size[done]
            hit = (rank == np.repeat(low, size)) & (rank < none)
            # Of a run of overlapping hits (a pair of equal symbols) every other one merges, from the left.
            spot = np.flatnonzero(hit)
            if len(spot):
                fresh = np.r_[True, np.diff(spot) > 1]
                begin = spot[np.maximum.accumulate(np.where(fresh, np.arange(len(spot)), 0))]
                spot = spot[(spot - begin) % 2 == 0]
            ids[spot] = self.merged[rank[spot]]
            stay = ~np.repeat(done, size)
            stay[spot + 1] = False
            ids, seq = ids[stay], seq[stay]
        return out


@lru_cache(4)
def merges(path: str) -> Merges:
    return Merges(path)


def pre_tokens(data: np.ndarray, off: np.ndarray, special: re.Pattern | None) -> tuple[np.ndarray, np.ndarray]:
    """Byte starts of the pre-tokens (the last item is the end), and which are
    special strings. Each text, and each stretch between special strings, is
    split for itself by the pattern
    `'(s|t|re|ve|m|ll|d)| ?L+| ?N+| ?[^ white L N]+|white+(?!not white)|white+`.
    """
    raw = data.tobytes()
    cuts, marks = [off], []
    if special is not None:
        for m in special.finditer(raw):
            if np.searchsorted(off, m.start(), "right") == np.searchsorted(off, m.end() - 1, "right"):
                marks.append(m.start())
                cuts.append(np.array([m.start(), m.end()]))
    segs = np.unique(np.concatenate(cuts))
    where = np.flatnonzero((data & 0xC0) != 0x80)
    points = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), np.uint32)
    n = len(points)
    if not n:
        return np.zeros(1, np.int64), np.zeros(0, bool)
    seg_at = np.searchsorted(where, segs[segs < len(data)])  # as code point numbers
    kind = classes()[points]
    first = np.zeros(n, bool)
    first[seg_at] = True
    begins = first.copy()
    begins[1:] |= kind[1:] != kind[:-1]
    run = np.flatnonzero(begins)
    last = np.r_[run[1:], n] - 1
    white = kind[run] == _SPACE
    # A white run before something else gives up its last character: a space goes to what follows.
    followed = white & (last + 1 < n)
    followed[followed] = ~first[last[followed] + 1]
    tail = last[followed]
    begins[tail] = True
    begins[tail[points[tail] == 32] + 1] = False
    # Contractions where an apostrophe begins a token.
    p = points
    def after(i: np.ndarray, k: int) -> np.ndarray:
        j = np.minimum(i + k, n - 1)
        return np.where(i + k < n, p[j], 0)
    i = np.flatnonzero((p == 39) & begins)
    a, b = after(i, 1), after(i, 2)
    crosses1 = np.where(i + 1 < n, first[np.minimum(i + 1, n - 1)], True)
    crosses2 = np.where(i + 2 < n, first[np.minimum(i + 2, n - 1)], True)
    one = np.isin(a, [ord(c) for c in "stmd"]) & ~crosses1
    two = (((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e")))
           | ((a == ord("l")) & (b == ord("l")))) & ~crosses1 & ~crosses2
    for sel, k in ((one, 2), (two & ~one, 3)):
        begins[i[sel] + 1] = False
        stop = i[sel] + k
        begins[stop[stop < n]] = True
    if marks:
        inside = np.zeros(n + 1, np.int64)
        spots = np.searchsorted(where, np.array(marks))
        inside[spots + 1] += 1
        inside[np.searchsorted(where, np.concatenate(cuts[1:])[1::2])] -= 1
        begins &= np.cumsum(inside[:-1]) == 0
    starts = where[begins]
    return np.r_[starts, len(data)], np.isin(starts, marks)


class Counter:
    """Token counts of slices of texts, with the counts of known pre-tokens kept."""

    def __init__(self, path: str):
        self.table = merges(path)
        self.hashes, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def known(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.hashes):
            return np.zeros(len(h), bool), np.zeros(len(h), np.int64)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return self.hashes[at] == h, self.counts[at]

    def tokens(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        cuts, special = pre_tokens(data, off, self.table.special)
        starts, ends = cuts[:-1], cuts[1:]
        h, at, back = np.unique(A.span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        have, count = self.known(h)
        new = np.flatnonzero(~have)
        for k in range(0, len(new), ROUND):
            part = new[k : k + ROUND]
            count[part] = self.table.count(data, starts[at[part]], ends[at[part]])
        if len(new):
            if len(self.hashes) + len(new) > MEMORY:
                self.hashes, self.counts = h, count
            else:
                both = np.concatenate([self.hashes, h[new]])
                order = np.argsort(both, kind="stable")
                self.hashes, self.counts = both[order], np.concatenate([self.counts, count[new]])[order]
        each = np.where(special, 1, count[back])
        return A.per_doc(np.searchsorted(off, starts, side="right") - 1, len(off) - 1, each)


@lru_cache(4)
def counter(path: str) -> Counter:
    return Counter(path)


def count_tokens(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """UTF-8 bytes and BPE tokens of each whole text.

    ``vocabulary`` is the path of a byte-level BPE file in the tokenizers JSON
    layout, readable on each executor. Special strings inside a text count one
    token, as the library has it; nothing is added at the ends.

    Returns ``id_col``, ``n_bytes``, ``n_tokens``, one row per input row.
    Defined cases: a NULL or empty text has 0 of both; ids play no part; an
    empty table gives an empty table. No shuffle; a worker holds one slice of
    texts and the counts of ``MEMORY`` pre-tokens at most.
    """
    result = T.StructType([T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])

    def count(data: np.ndarray, off: np.ndarray) -> dict:
        return {"n_bytes": np.diff(off), "n_tokens": counter(vocabulary).tokens(data, off)}

    return A.per_text(docs, [id_col], text_col, count, result)
