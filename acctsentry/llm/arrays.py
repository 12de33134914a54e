"""Texts as numpy arrays inside tasks: UTF-8 bytes, word spans, word and
shingle hashes. Spark deals the rows; a task holds one slice of a batch."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from acctsentry.llm.common import col

#: Bytes of text that are worked on at once (one text may be larger).
SLICE_BYTES = 1 << 19

_P, _Q = np.uint64(0x9E3779B97F4A7C15 | 1), np.uint64(0xD6E8FEB86659FD93 | 1)
_PINV = np.uint64(pow(int(_P), -1, 1 << 64))
_powers: dict[int, np.ndarray] = {}

#: Bytes of `[\x20\x09-\x0D]`.
IS_BLANK = np.zeros(256, bool)
IS_BLANK[[9, 10, 11, 12, 13, 32]] = True
#: A-Z to a-z, every other byte as it is.
TO_LOWER = np.arange(256, dtype=np.uint8)
TO_LOWER[65:91] += 32


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts' bytes in one array, and where each begins; NULL is empty."""
    a = column.cast(pa.large_string()).fill_null("")
    off = np.frombuffer(a.buffers()[1], np.int64)[a.offset : a.offset + len(a) + 1] if len(a) else np.zeros(1, np.int64)
    buf = a.buffers()[2] if len(a) else None
    data = np.frombuffer(buf, np.uint8)[off[0] : off[-1]] if buf is not None else np.zeros(0, np.uint8)
    return data, off - off[0]


def slices(batch: pa.RecordBatch, text_col: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose texts have about ``limit`` bytes together."""
    off = utf8(batch.column(text_col))[1]
    i = 0
    while i < len(batch):
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, side="right")) - 1)
        yield batch.slice(i, j - i)
        i = j


def give_back() -> None:
    """Return freed memory to the system: Python workers live on after a task,
    and what they keep is missing to the executor's other tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def per_text(
    docs: DataFrame, keep: list[str], text_col: str, fn: Callable[[np.ndarray, np.ndarray], dict], result: T.StructType,
) -> DataFrame:
    """``keep`` columns plus what ``fn(bytes, offsets)`` gives for each text.

    The text itself is returned only if it is among ``keep``; no shuffle.
    """
    t = f"k{keep.index(text_col)}" if text_col in keep else "t"
    src = docs.select(*[col(c).alias(f"k{i}") for i, c in enumerate(keep)], *([col(text_col).alias("t")] if t == "t" else []))
    kinds = {f.name: f.dataType for f in docs.schema.fields}
    schema = T.StructType([T.StructField(c, kinds[c]) for c in keep] + result.fields)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, t):
                found = fn(*utf8(part.column(t)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(i).cast(arrow.field(i).type) for i in range(len(keep))]
                    + [x if isinstance(x := found[f.name], pa.Array) else pa.array(x, type=arrow.field(f.name).type)
                       for f in result.fields],
                    schema=arrow,
                )
        give_back()

    return src.mapInArrow(run, schema)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    have = _powers.get(int(base))
    if have is None or len(have) < n:
        have = np.full(max(n, SLICE_BYTES + 1), base, np.uint64)
        have[0] = 1
        have = _powers[int(base)] = np.cumprod(have, dtype=np.uint64)
    return have[:n]


def runs(mask: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and text numbers of the runs of true bytes; a run doesn't
    cross from one text to the next."""
    if not len(mask):
        z = np.zeros(0, np.int64)
        return z, z, z
    before, after = np.empty_like(mask), np.empty_like(mask)
    before[0], before[1:] = False, mask[:-1]
    after[-1], after[:-1] = False, mask[1:]
    before[off[:-1][off[:-1] < len(mask)]] = False
    after[off[1:][off[1:] > 0] - 1] = False
    starts, ends = np.flatnonzero(mask & ~before), np.flatnonzero(mask & ~after) + 1
    return starts, ends, np.searchsorted(off, starts, side="right") - 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's bytes: rolling polynomial, mixed with the length."""
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(_P, n + 1)[:n], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * powers(_PINV, n + 1)[starts] + (ends - starts).astype(np.uint64) * _Q)


def window_hashes(words: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the ``n`` words from each of ``starts`` (word numbers)."""
    out = np.full(len(starts), (n * int(_P)) % (1 << 64), np.uint64)
    for j in range(n):
        out = out * _Q + words[starts + j]
    return mix(out)


def window_starts(doc: np.ndarray, n: int) -> np.ndarray:
    """Word numbers from which ``n`` words lie in one text; ``doc`` is sorted."""
    if len(doc) < n:
        return np.zeros(0, np.int64)
    return np.flatnonzero(doc[: len(doc) - n + 1] == doc[n - 1 :])


def per_doc(doc: np.ndarray, n_docs: int, weights: np.ndarray | None = None) -> np.ndarray:
    """Count, or sum of whole-number weights, by text."""
    return np.bincount(doc, weights=weights, minlength=n_docs).astype(np.int64)


class Lookup:
    """A fixed map from non-negative 64-bit keys to numbers, asked for whole arrays."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, int(4 * len(keys)).bit_length())
        self.shift, self.last = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int64)
        keys, values = keys.astype(np.int64), values.astype(np.int64)
        slot = self.slot(keys)
        while len(keys):
            free = np.flatnonzero(self.keys[slot] < 0)
            _, one = np.unique(slot[free], return_index=True)
            put = free[one]
            self.keys[slot[put]], self.values[slot[put]] = keys[put], values[put]
            rest = np.ones(len(keys), bool)
            rest[put] = False
            keys, values, slot = keys[rest], values[rest], (slot[rest] + 1) & self.last

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * _P) >> self.shift).astype(np.int64)

    def get(self, keys: np.ndarray, other: int) -> np.ndarray:
        """The value of each key, ``other`` where there is none."""
        slot = self.slot(keys)
        there = self.keys[slot]
        out = np.where(there == keys, self.values[slot], other)
        todo = np.flatnonzero((there != keys) & (there >= 0))
        slot = slot[todo]
        while len(todo):
            slot = (slot + 1) & self.last
            there = self.keys[slot]
            hit = there == keys[todo]
            out[todo[hit]] = self.values[slot[hit]]
            on = ~hit & (there >= 0)
            todo, slot = todo[on], slot[on]
        return out
