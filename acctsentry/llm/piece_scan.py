"""Max-plus scans over the lattice of pieces.

A node is a place in the text and the piece that ends there; an edge leads to
a next piece that may follow, with weight 0, and all else has minus infinity. A
chunk of a giant text maps the nodes near its beginning to those near its end:
a transfer matrix. Matrices are multiplied from the left and from the right,
which gives the one node on the best path at each boundary, and then each
chunk is traced back for itself.
"""

from __future__ import annotations

import re

import numpy as np

from acctsentry.llm import arrays as A
from acctsentry.llm.piece_table import SPACE, UNKNOWN, Pieces

#: Characters of the longest segment that goes through the array scan; longer ones are scanned one by one.
LANE = 48
#: Segments whose pieces a worker remembers before it starts anew.
MEMORY = 300_000

MARK = chr(SPACE)
CUT_BEFORE = re.compile(f"[^{MARK}]{MARK}")

#: What a node at a cut has for a piece, and the node in front of a text.
CUT = -2
START = (0, CUT)


def marked(text: str) -> str:
    """The model's view of a text: a space mark in front and for each space."""
    return MARK + text.replace(" ", MARK) if text else ""


def is_cut(s: str, i: int) -> bool:
    """Whether no piece can lie across place ``i``: a space mark follows another character."""
    return s[i] == MARK and s[i - 1] != MARK


def starting_at(table: Pieces, s: str, i: int, stop: int) -> list[tuple[int, int]]:
    """Pieces (end, id) that begin at ``i`` and don't go beyond ``stop``."""
    out = []
    for k in range(1, min(table.longest, stop - i) + 1):
        p = table.ids_by_length[k].get(s[i : i + k])
        if p is not None:
            out.append((i + k, p))
    if not out or out[0][0] != i + 1:
        if s[i] not in table.id_of:
            out.insert(0, (i + 1, UNKNOWN))
    return out


def ending_at(table: Pieces, s: str, i: int, least: int) -> list[int]:
    """Pieces that end at ``i`` and begin at ``least`` or later."""
    out = []
    for k in range(1, min(table.longest, i - least) + 1):
        p = table.ids_by_length[k].get(s[i - k : i])
        if p is not None:
            out.append(p)
    if i > least and s[i - 1] not in table.id_of:
        out.append(UNKNOWN)
    return out


def forward(table: Pieces, s: str, seeds: dict[tuple[int, int], int], begin: int, stop: int) -> dict[int, dict[int, int]]:
    """Nodes (place -> piece -> set of seeds, as bits) that the seeds reach.

    ``seeds`` are nodes at or before ``begin``; edges cross ``begin`` from
    them and go on to ``stop``. A node of no seed has weight minus infinity
    and isn't there; one that several reach has the highest, 0, of each.
    """
    nodes: dict[int, dict[int, int]] = {}
    for (place, piece), bits in seeds.items():
        nodes.setdefault(place, {})[piece] = nodes.get(place, {}).get(piece, 0) | bits
    for i in range(min(nodes, default=stop), stop):
        here = nodes.get(i)
        if not here:
            continue
        for end, piece in starting_at(table, s, i, stop):
            if end <= begin:
                continue
            bits = 0
            for before, b in here.items():
                if before == CUT or table.fast_pair(before, piece):
                    bits |= b
            if bits:
                to = nodes.setdefault(end, {})
                to[piece] = to.get(piece, 0) | bits
    return nodes


def traced(table: Pieces, nodes: dict[int, dict[int, int]], begin: int, node: tuple[int, int],
           first: tuple[int, int]) -> list[tuple[int, int]]:
    """The one path from node ``first``, at or before ``begin``, to ``node``, without ``first``."""
    out = []
    place, piece = node
    while (place, piece) != first:
        out.append((place, piece))
        at = place - (1 if piece == UNKNOWN else table.piece_len[piece])
        before = [p for p in nodes.get(at, {}) if (p == CUT or table.fast_pair(p, piece)) and (at > begin or (at, p) == first)]
        if len(before) != 1:
            raise ValueError(f"{len(before)} paths at {at}")
        place, piece = at, before[0]
    return out[::-1]


def spelled(table: Pieces, s: str, path: list[tuple[int, int]]) -> list[int]:
    """Piece numbers of a path; unknown characters become their bytes' pieces."""
    out: list[int] = []
    for place, piece in path:
        if piece == UNKNOWN:
            out += table.byte_id[list(s[place - 1].encode())].tolist()
        else:
            out.append(piece)
    return out


def scan_whole(table: Pieces, s: str) -> list[int]:
    """Pieces of a segment from its beginning."""
    nodes = forward(table, s, {START: 1}, 0, len(s))
    return spelled(table, s, traced(table, nodes, 0, _end(nodes, len(s)), START))


class Chunk:
    """A stretch of a marked text, with ``left`` characters of context in front.

    ``closed`` says that a cut or the text's end lies right behind it. A node
    at a cut is written as piece ``CUT``: whatever ends there, any piece may
    follow.
    """

    def __init__(self, table: Pieces, text: str, left: int, closed: bool):
        self.table, self.text, self.left, self.closed = table, text, left, closed
        first = CUT_BEFORE.search(text, max(left, 1) - 1)
        self.head = first.start() + 1 if first else None
        self.tail = self.head
        if first:
            at = text.rfind(MARK)
            while not is_cut(text, at):
                at = text.rfind(MARK, 0, at)
            self.tail = at

    def inner(self) -> str:
        """The stretch between the first and the last cut."""
        return "" if self.head is None else self.text[self.head : self.tail]

    def seeds(self) -> list[tuple[int, int]]:
        """Nodes at the chunk's beginning from which a path may come in."""
        out = []
        for place in range(self.left, max(-1, self.left - self.table.longest), -1):
            if place == 0 or place < len(self.text) and is_cut(self.text, place):
                return [*out, (place, CUT)]  # no piece lies across it
            out += [(place, p) for p in ending_at(self.table, self.text, place, 0)]
        return out

    def matrix(self) -> list[tuple[int, int, int, int]]:
        """Entries with weight 0 as (characters before the chunk, piece,
        characters before its end, piece)."""
        seeds, end = self.seeds(), len(self.text)
        stop = end if self.head is None else self.head
        nodes = forward(self.table, self.text, {s: 1 << k for k, s in enumerate(seeds)}, self.left, stop)
        if self.head is not None:
            reached = 0
            for bits in nodes.get(self.head, {}).values():
                reached |= bits
            nodes = forward(self.table, self.text, {(self.tail, CUT): reached}, self.tail, end)
        if self.closed:
            all_bits = 0
            for bits in nodes.get(end, {}).values():
                all_bits |= bits
            out = [(end, CUT, all_bits)]
        else:
            out = [(q, p, bits) for q in range(end - self.table.longest + 1, end + 1) for p, bits in nodes.get(q, {}).items()]
        return [(self.left - seeds[k][0], seeds[k][1], end - q, p)
                for q, p, bits in out for k in range(len(seeds)) if bits >> k & 1]

    def trace(self, enter: tuple[int, int], leave: tuple[int, int], inner: list[int]) -> list[int]:
        """Pieces between two nodes, given as in ``matrix``; ``inner`` are the
        pieces of the stretch between the first and the last cut."""
        table, text, end = self.table, self.text, len(self.text)
        first = (self.left - enter[0], enter[1])
        out: list[int] = []
        begin = self.left
        if self.head is not None:
            if first[0] < self.head:
                nodes = forward(table, text, {first: 1}, begin, self.head)
                out = spelled(table, text, traced(table, nodes, begin, _end(nodes, self.head), first))
            out += inner
            begin, first = self.tail, (self.tail, CUT)
        nodes = forward(table, text, {first: 1}, begin, end)
        last = _end(nodes, end) if self.closed and first[0] < end else (end - leave[0], leave[1])
        return out + spelled(table, text, traced(table, nodes, begin, last, first))


def _end(nodes: dict[int, dict[int, int]], place: int) -> tuple[int, int]:
    (piece,) = nodes[place]
    return place, piece


def crossings(matrices: list[list[tuple[int, int, int, int]]]) -> list[tuple[int, int]]:
    """The best path's node at each boundary, from the products of the chunks'
    matrices on its left and on its right."""
    steps: list[dict[tuple[int, int], list[tuple[int, int]]]] = []
    for m in matrices:
        step: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for a, p, b, q in m:
            step.setdefault((a, p), []).append((b, q))
        steps.append(step)
    ahead = [{START}]
    for step in steps:
        ahead.append({t for s in ahead[-1] for t in step.get(s, ())})
    back = ahead[-1]
    out = [_only(back)]
    for k in range(len(steps) - 1, -1, -1):
        back = {s for s, to in steps[k].items() if s in ahead[k] and not back.isdisjoint(to)}
        out.append(_only(back))
    return out[::-1]


def _only(nodes: set[tuple[int, int]]) -> tuple[int, int]:
    if len(nodes) != 1:
        raise ValueError(f"{len(nodes)} best paths")
    return next(iter(nodes))


class Encoder:
    """Pieces of texts, slice by slice: the segments between cuts are the
    lanes of one scan over all distinct ones at once."""

    def __init__(self, table: Pieces):
        self.table = table
        self.known_char = np.zeros(0x110000, bool)
        self.known_char[[ord(p) for p in table.id_of if len(p) == 1]] = True
        self.forget()

    def forget(self) -> None:
        self.hashes, self.at, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat, self.used = np.zeros(1 << 16, np.int32), 0

    def found(self, points: np.ndarray, room: np.ndarray) -> np.ndarray:
        """Row k-1: the piece of k characters that begins at each place, or -1;
        ``room`` characters are left there."""
        table = self.table
        out = np.full((table.longest, len(points)), -1, np.int32)
        at, node, code = np.arange(len(points)), np.zeros(len(points), np.int64), points.astype(np.int64)
        for k in range(table.longest):
            go = room[at] > k
            at, node = at[go], node[go]
            node = table.child.get((node << 21) + code[at + k], -1)
            go = node >= 0
            at, node = at[go], node[go]
            if not len(at):
                break
            out[k, at] = table.node_piece[node]
        single = out[0]
        single[(single < 0) & ~self.known_char[points]] = -1 - self.table.n_pieces  # unknown characters
        return out

    def lanes(self, points: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of all segments, concatenated, and how many each has.

        Column j of ``last`` is the piece that ends after j characters of each
        lane: the one node of that place that the beginning reaches.
        """
        table, n = self.table, len(lo)
        order = np.argsort(lo - hi, kind="stable")  # longest first: active lanes are a prefix
        length = (hi - lo)[order]
        width = int(length[0]) if n else 0
        # The lanes' characters one behind the other.
        upto = np.concatenate([[0], np.cumsum(length)])
        inner = np.arange(upto[-1]) - np.repeat(upto[:-1], length)
        points = points[np.repeat(lo[order], length) + inner]
        lo = upto[:-1]
        found = self.found(points, np.repeat(length, length) - inner)
        last = np.full((width + 1, n), -3, np.int32)
        step = np.zeros((width + 1, n), np.int8)
        for j in range(1, width + 1):
            open_ = np.arange(int(np.searchsorted(-length, -j, side="right")))
            for k in range(min(j, table.longest), 0, -1):
                piece = found[k - 1, lo[open_] + j - k]
                if k == 1:
                    piece = np.where(piece < -1, UNKNOWN, np.where(piece < 0, -9, piece))
                    sel = np.flatnonzero(piece > -9)
                else:
                    sel = np.flatnonzero(piece >= 0)
                if j > k and len(sel):
                    sel = sel[table.fast(last[j - k, open_[sel]], piece[sel])]
                if len(sel):
                    last[j, open_[sel]] = piece[sel]
                    step[j, open_[sel]] = k
                    left = np.ones(len(open_), bool)
                    left[sel] = False
                    open_ = open_[left]
            if len(open_):
                raise ValueError("a place that no path reaches")
        # Trace all lanes back at once.
        place, lane = length.copy(), np.arange(n)
        got: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(lane):
            p = last[place[lane], lane]
            got.append((lane, place[lane], p))
            place[lane] -= step[place[lane], lane]
            lane = lane[place[lane] > 0]
        lane, place, piece = (np.concatenate([g[i] for g in got]) if got else np.zeros(0, np.int64) for i in range(3))
        # Unknown characters become the pieces of their bytes.
        reps = np.ones(len(lane), np.int64)
        odd = np.flatnonzero(piece == UNKNOWN)
        char = points[lo[lane[odd]] + place[odd] - 1]
        reps[odd] = 1 + (char >= 0x80) + (char >= 0x800) + (char >= 0x10000)
        sort = np.lexsort((place, order[lane]))
        lane, piece, reps = order[lane][sort], piece[sort], reps[sort]
        ids = np.repeat(piece, reps).astype(np.int32)
        where = np.flatnonzero(np.repeat(piece == UNKNOWN, reps))
        if len(where):
            place_sorted = place[sort][piece == UNKNOWN]
            begin_of = np.empty(n, np.int64)
            begin_of[order] = lo
            raw = points[begin_of[lane[piece == UNKNOWN]] + place_sorted - 1].astype("<u4").tobytes().decode("utf-32-le")
            ids[where] = table.byte_id[np.frombuffer(raw.encode(), np.uint8)]
        return ids, np.bincount(lane, reps, n).astype(np.int64)

    def encode(self, points: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece numbers of marked texts (code points, offsets), and how many each text has."""
        n = len(points)
        if not n:
            return np.zeros(0, np.int32), np.zeros(len(off) - 1, np.int64)
        space = points == SPACE
        cut = space.copy()
        cut[1:] &= ~space[:-1]
        cut[off[:-1][off[:-1] < n]] = True
        lo = np.flatnonzero(cut)
        hi = np.r_[lo[1:], n]
        h, at, back = np.unique(A.span_hashes(points, lo, hi), return_index=True, return_inverse=True)
        if len(self.hashes) + len(h) > MEMORY:
            self.forget()
        new = self.missing(h)
        if len(new):
            self.learn(points, lo[at[new]], hi[at[new]], h[new])
        spot = np.searchsorted(self.hashes, h)[back]
        size, begin = self.size[spot], self.at[spot]
        inner = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        text = np.searchsorted(off, lo, side="right") - 1
        return self.flat[np.repeat(begin, size) + inner], np.bincount(text, size, len(off) - 1).astype(np.int64)

    def missing(self, h: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.arange(len(h))
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return np.flatnonzero(self.hashes[at] != h)

    def learn(self, points: np.ndarray, lo: np.ndarray, hi: np.ndarray, h: np.ndarray) -> None:
        short = hi - lo <= LANE
        ids, count = [], np.zeros(len(lo), np.int64)
        some = np.flatnonzero(short)
        got, count[some] = self.lanes(points, lo[some], hi[some])
        ids.append(got)
        rest = np.flatnonzero(~short)
        for i in rest:
            s = points[lo[i] : hi[i]].astype("<u4").tobytes().decode("utf-32-le")
            found = np.array(scan_whole(self.table, s), np.int32)
            count[i] = len(found)
            ids.append(found)
        flat, which = np.concatenate(ids), np.r_[some, rest]
        begin = np.empty(len(lo), np.int64)
        begin[which] = self.used + np.cumsum(count[which]) - count[which]
        while self.used + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(len(self.flat), np.int32)])
        self.flat[self.used : self.used + len(flat)] = flat
        self.used += len(flat)
        both = np.concatenate([self.hashes, h])
        order = np.argsort(both, kind="stable")
        self.hashes = both[order]
        self.at, self.size = np.concatenate([self.at, begin])[order], np.concatenate([self.size, count])[order]

    def encode_texts(self, marked_texts: list[str]) -> list[list[int]]:
        """Pieces of each marked text."""
        points = np.frombuffer("".join(marked_texts).encode("utf-32-le"), np.uint32)
        ids, counts = self.encode(points, np.concatenate([[0], np.cumsum([len(s) for s in marked_texts])]))
        return [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]
