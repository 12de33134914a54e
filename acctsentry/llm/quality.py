"""Quality rules: how much of a text lies inside repeated n-grams and lines.

Rolling hashes of several n-gram lengths in numpy, one slice of texts at a
time; no shuffle.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from acctsentry.llm import arrays as A

#: Highest share of a text's word characters inside n-grams that occurred
#: earlier in the text, by n (fixed values of the published repetition rules).
NGRAM_SHARES = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
#: Highest share of word characters inside lines that occurred earlier.
LINE_SHARE = 0.20
MIN_WORDS = 50

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"[#*$%&|<>]"[1:-1])] = True

RESULT = T.StructType(
    [T.StructField(c, T.LongType()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    + [T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType())]
    + [T.StructField("line_chars", T.LongType())]
    + [T.StructField(f"gram{n}_chars", T.LongType()) for n in NGRAM_SHARES]
)


def earlier(doc: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each item: does it repeat at all inside its text; was there an
    equal one before it."""
    key = A.mix(h + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    s = key[order]
    same = np.zeros(len(s) + 1, bool)
    same[1:-1] = s[1:] == s[:-1]
    again, any_ = np.zeros(len(s), bool), np.zeros(len(s), bool)
    again[order], any_[order] = same[:-1], same[:-1] | same[1:]
    return any_, again


def covered(starts: np.ndarray, n: int, n_words: int) -> np.ndarray:
    """Which words lie in one of the windows."""
    d = np.zeros(n_words + 1, np.int64)
    np.add.at(d, starts, 1)
    np.add.at(d, starts + n, -1)
    return np.cumsum(d[:-1]) > 0


def measure(data: np.ndarray, off: np.ndarray) -> dict:
    n_docs = len(off) - 1
    starts, ends, doc = A.runs(~A.IS_BLANK[data], off)
    words = A.span_hashes(data, starts, ends)
    points = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=points[1:])
    chars = points[ends] - points[starts]
    n_words, word_chars = A.per_doc(doc, n_docs), A.per_doc(doc, n_docs, chars)

    symbols = np.searchsorted(off, np.flatnonzero(_SYMBOL[data]), side="right") - 1

    # Lines with a word: the byte span between line feeds, exact blanks included.
    l_starts, l_ends, l_doc = A.runs(data != 10, off)
    first, last = np.searchsorted(starts, l_starts), np.searchsorted(starts, l_ends)
    worded = last > first
    l_starts, l_ends, l_doc, first, last = (x[worded] for x in (l_starts, l_ends, l_doc, first, last))
    _, l_again = earlier(l_doc, A.span_hashes(data, l_starts, l_ends))
    upto = np.concatenate([[0], np.cumsum(chars)])
    out = {
        "n_words": n_words,
        "word_chars": word_chars,
        "n_symbols": A.per_doc(symbols, n_docs),
        "n_dup_lines": A.per_doc(l_doc[l_again], n_docs),
        "line_chars": A.per_doc(l_doc[l_again], n_docs, (upto[last] - upto[first])[l_again]),
    }

    w = A.window_starts(doc, 3)
    any3, _ = earlier(doc[w], A.window_hashes(words, w, 3))
    out["n_repeat_words"] = A.per_doc(doc[covered(w[any3], 3, len(doc))], n_docs)
    out["base_failed"] = (n_words < MIN_WORDS) | (100 * out["n_repeat_words"] > 50 * n_words)
    good = ~out["base_failed"] & (out["line_chars"] <= LINE_SHARE * word_chars)
    for n, share in NGRAM_SHARES.items():
        w = A.window_starts(doc, n)
        _, again = earlier(doc[w], A.window_hashes(words, w, n))
        inside = covered(w[again], n, len(doc))
        out[f"gram{n}_chars"] = A.per_doc(doc[inside], n_docs, chars[inside])
        good &= out[f"gram{n}_chars"] <= share * word_chars
    return out | {"kept": good}


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts and verdict for each text.

    Words are runs of characters other than blanks (tab to carriage return,
    space). ``n_repeat_words`` counts the words inside three-word windows that
    the text holds twice or more; ``n_dup_lines`` the lines with a word that
    equal an earlier line. ``base_failed``: under 50 words, or over half of
    them repeated. ``gramN_chars`` are the word characters inside N-word
    windows that occurred earlier in the text, ``line_chars`` those inside
    such lines. ``kept`` is false if ``base_failed`` or if one of these
    exceeds its share of the text's word characters.

    Returns ``id_col`` and these columns, one row per input row. Defined
    cases: a NULL or empty text has no words and fails; ids play no part
    (NULL and repeated ones included); an empty table gives an empty table.
    Equality is that of 64-bit hashes inside one text.
    """
    return A.per_text(docs, [id_col], text_col, measure, RESULT)
