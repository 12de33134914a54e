"""Vocabulary tables of a SentencePiece BPE model, as numpy arrays.

A segmentation is the model's own exactly if each two neighbouring pieces are
"fast": the merges of their joined string end in the same two pieces (a known
property of BPE). That turns encoding into a shortest-path problem with weights 0
and minus infinity on pairs of neighbours, which is what
``acctsentry.llm.piece_scan`` solves.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

from acctsentry.llm import arrays as A

SPACE = 0x2581
UNKNOWN = -1
#: A rank behind all others.
NEVER = np.iinfo(np.int64).max


class Pieces:
    def __init__(self, path: str):
        import sentencepiece  # only tasks need it

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = len(model)
        self.path, self.n_pieces = path, n
        text = [model.id_to_piece(i) for i in range(n)]
        normal = [i for i in range(n) if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i) or model.is_unused(i))]
        self.id_of = {text[i]: i for i in normal}
        self.text_of, self.piece_len = text, [len(t) for t in text]
        self.longest = max(map(len, self.id_of))
        for p in self.id_of:
            if any(ord(c) == SPACE for c in p.lstrip(chr(SPACE))):
                raise ValueError(f"piece {p!r} has a space mark inside: not a model of words")
        score = np.array([model.get_score(i) for i in range(n)])
        self.byte_id = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        # Equal scores are one rank: of equal ones the left merge goes first.
        rank = np.unique(-score, return_inverse=True)[1].astype(np.int64)
        self.rank = rank
        joins = {}
        for p, i in self.id_of.items():
            for k in range(1, len(p)):
                a, b = self.id_of.get(p[:k]), self.id_of.get(p[k:])
                if a is not None and b is not None:
                    joins[a, b] = i
        self.joins = joins
        self.join_rank = A.Lookup(
            np.array([a * n + b for a, b in joins], np.int64), rank[np.array(list(joins.values()), np.int64)])
        # Each piece's last merge; pieces that their own merges don't give back can't occur.
        self.left, self.right = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
        self.usable = np.zeros(n, bool)
        for p, i in self.id_of.items():
            whole, last = self.merge(p)
            self.usable[i] = whole == [i]
            if self.usable[i] and last is not None:
                self.left[i], self.right[i] = last
        self.formed = np.where(self.left >= 0, rank, -1)
        self.ids_by_length = {
            k: {p: i for p, i in self.id_of.items() if len(p) == k and self.usable[i]} for k in range(1, self.longest + 1)}
        # The pieces as a tree of characters: (node, character) -> node, node -> piece.
        edges: dict[tuple[int, int], int] = {}
        self.node_piece = [-1]
        for p, i in self.id_of.items():
            if self.usable[i]:
                node = 0
                for c in p:
                    node = edges.setdefault((node, ord(c)), len(self.node_piece))
                    if node == len(self.node_piece):
                        self.node_piece.append(-1)
                self.node_piece[node] = i
        self.node_piece = np.array(self.node_piece, np.int64)
        self.child = A.Lookup(
            np.array([(a << 21) + c for a, c in edges], np.int64), np.array(list(edges.values()), np.int64))
        out = [b"" for _ in range(n)]
        for p, i in self.id_of.items():
            out[i] = p.replace(chr(SPACE), " ").encode()
        for b in range(256):
            out[self.byte_id[b]] = bytes([b])
        out[model.unk_id()] = " \u2047 ".encode()
        self.marks_space = np.array([t.startswith(chr(SPACE)) for t in text])
        self.out_len = np.array([len(x) for x in out], np.int64)
        self.out_at = np.cumsum(self.out_len) - self.out_len
        self.out_bytes = np.frombuffer(b"".join(out), np.uint8)
        self._fast: dict[tuple[int, int], bool] = {}
        self._lists = tuple(x.tolist() for x in (rank, self.formed, self.left, self.right))

    def merge(self, s: str) -> tuple[list[int], tuple[int, int] | None]:
        """The pieces of a short string by plain merging, and the last merge."""
        ids = [self.id_of.get(c, UNKNOWN) for c in s]
        last = None
        while True:
            best = min(((self.rank[self.joins[a, b]], k) for k, (a, b) in enumerate(zip(ids, ids[1:]))
                        if (a, b) in self.joins), default=None)
            if best is None:
                return ids, last
            k = best[1]
            last = (ids[k], ids[k + 1])
            ids[k : k + 2] = [self.joins[last]]

    def join_ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the piece that two neighbours would merge into; very high where there is none."""
        return self.join_rank.get(a * self.n_pieces + b, NEVER)

    def fast(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the pieces ``a`` and ``b`` may stand side by side.

        The merges that made the two are undone from the last one back; at
        each step the two symbols at the seam must not have had a merge of
        their own that was due before the one just undone. Unknown characters
        merge with nothing.
        """
        a, b = a.astype(np.int64), b.astype(np.int64)
        ok = np.ones(len(a), bool)
        live = np.flatnonzero((a >= 0) & (b >= 0))
        x, y = a[live], b[live]
        due = np.full(len(live), NEVER)
        while len(live):
            bad = self.join_ranks(x, y) < due
            ok[live[bad]] = False
            fx, fy = self.formed[x], self.formed[y]
            more = ~bad & ((fx >= 0) | (fy >= 0))
            live, x, y, fx, fy = live[more], x[more], y[more], fx[more], fy[more]
            # The later merge is undone first; of equal ranks the right one is the later.
            undo_x = fx > fy
            due = np.where(undo_x, fx, fy + 1)
            x, y = np.where(undo_x, self.right[x], x), np.where(undo_x, y, self.left[y])
        return ok

    def fast_pair(self, a: int, b: int) -> bool:
        """``fast`` for one pair."""
        if a < 0 or b < 0:
            return True
        found = self._fast.get((a, b))
        if found is None:
            if len(self._fast) > 100_000:
                self._fast.clear()
            rank, formed, left, right = self._lists
            x, y, due, found = a, b, NEVER, True
            while True:
                joined = self.joins.get((x, y))
                if joined is not None and rank[joined] < due:
                    found = False
                    break
                fx, fy = formed[x], formed[y]
                if fx < 0 and fy < 0:
                    break
                x, y, due = (right[x], y, fx) if fx > fy else (x, left[y], fy + 1)
            self._fast[a, b] = found
        return found


@lru_cache(2)
def pieces(path: str) -> Pieces:
    return Pieces(path)
