"""Toxicity: subword-bag embeddings averaged into a linear softmax.

A word is the bag of its character n-grams, a window the average of its words'
vectors, and a linear softmax over that average gives the window's score;
embeddings and softmax are trained jointly in numpy. Words that were never
seen share n-gram vectors with those that were. A text is as toxic as its most
toxic window, so length doesn't dilute it.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acctsentry.llm import arrays as A
from acctsentry.llm.common import col
from acctsentry.llm.decontamination import IS_WORD

BUCKETS, DIM = 1 << 17, 8
GRAMS = (3, 4, 5)
#: Words in a window; windows begin at every STRIDE-th word.
WINDOW, STRIDE = 12, 4
#: Labelled texts of each class that are fitted on at most, and the longest of them in bytes.
SAMPLE, SAMPLE_BYTES = 3000, 1 << 16
#: Texts, and distinct words, that the fit works on at once.
BLOCK, PART = 256, 1 << 14
EPOCHS, FIRST, RATE, SHRINK, SHARP, LEAST_SEEN, SEED = 60, 0.4, 0.3, 1e-6, (3.0, 10.0), 3, 7


def subwords(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of each word's n-grams (with word boundaries, the whole word
    included), and where each word's begin."""
    length = ends - starts + 2
    off = np.concatenate([[0], np.cumsum(length)])
    padded = np.full(off[-1], 1, np.uint8)  # a byte that no word holds stands at both ends
    inner = np.arange(off[-1]) - np.repeat(off[:-1], length)
    sel = (inner > 0) & (inner < np.repeat(length, length) - 1)
    padded[sel] = data[(inner - 1 + np.repeat(starts, length))[sel]]
    word = np.repeat(np.arange(len(starts)), length)
    at, who = [off[:-1]], [np.arange(len(starts))]
    stop = [off[1:]]
    for n in GRAMS:
        s = np.flatnonzero(inner + n <= np.repeat(length, length))
        at.append(s)
        stop.append(s + n)
        who.append(word[s])
    at, stop, who = np.concatenate(at), np.concatenate(stop), np.concatenate(who)
    bucket = (A.span_hashes(padded, at, stop) >> np.uint64(40)).astype(np.int64) % BUCKETS
    order = np.argsort(who, kind="stable")
    counts = np.bincount(who, minlength=len(starts))
    return bucket[order], np.concatenate([[0], np.cumsum(counts)])


@dataclass
class Words:
    """The distinct words of some texts, and the texts as word numbers."""

    hashes: np.ndarray
    tokens: np.ndarray
    doc: np.ndarray
    bucket: np.ndarray
    begin: np.ndarray

    @classmethod
    def of(cls, data: np.ndarray, off: np.ndarray) -> Words:
        low = A.TO_LOWER[data]
        starts, ends, doc = A.runs(IS_WORD[low], off)
        h = A.span_hashes(low, starts, ends)
        if len(h):  # a word said many times in a row counts once
            new = np.r_[True, (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])]
            starts, ends, doc, h = starts[new], ends[new], doc[new], h[new]
        distinct, at, tokens = np.unique(h, return_index=True, return_inverse=True)
        bucket, begin = subwords(low, starts[at], ends[at])
        return cls(distinct, tokens.astype(np.int32), doc.astype(np.int32), bucket.astype(np.int32), begin)

    def mean(self, g: np.ndarray) -> np.ndarray:
        """Average of ``g`` over each distinct word's n-grams."""
        return mean(g, self.bucket, self.begin)


def mean(g: np.ndarray, bucket: np.ndarray, begin: np.ndarray) -> np.ndarray:
    if len(begin) < 2:
        return np.zeros(0)
    return np.add.reduceat(g[bucket], begin[:-1]) / np.diff(begin)


class Sample:
    """Labelled texts for fitting: the distinct words of all, with ids in the
    order of their appearance, and each block's texts as such ids."""

    def __init__(self, blocks: Iterable[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        known, ids = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.blocks: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        buckets, sizes, n = [], [], 0
        for data, off, label in blocks:
            words = Words.of(data, off)
            at = np.searchsorted(known, words.hashes)
            new = at == len(known)
            new[~new] = known[at[~new]] != words.hashes[~new]
            number = np.empty(len(new), np.int32)
            number[~new] = ids[at[~new]]
            number[new] = np.arange(n, n + new.sum(), dtype=np.int32)
            n += int(new.sum())
            size = np.diff(words.begin)
            buckets.append(words.bucket[np.repeat(new, size)])
            sizes.append(size[new])
            known, ids = np.concatenate([known, words.hashes[new]]), np.concatenate([ids, number[new]])
            order = np.argsort(known, kind="stable")
            known, ids = known[order], ids[order]
            self.blocks.append((number[words.tokens], words.doc, label))
        self.n_words = n
        self.bucket = np.concatenate([np.zeros(0, np.int32), *buckets])
        self.begin = np.concatenate([[0], np.cumsum(np.concatenate([np.zeros(0, np.int64), *sizes]))])

    def parts(self) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
        """Runs of words with their buckets: what is worked on at once."""
        for i in range(0, self.n_words, PART):
            begin = self.begin[i : i + PART + 1]
            yield slice(i, i + len(begin) - 1), self.bucket[begin[0] : begin[-1]], begin - begin[0]

    def words_mean(self, g: np.ndarray) -> np.ndarray:
        return np.concatenate([np.zeros(0), *(mean(g, bucket, begin) for _, bucket, begin in self.parts())])

    def to_buckets(self, per_gram: np.ndarray) -> np.ndarray:
        """Sums by bucket of what each n-gram of a word gets."""
        out = np.zeros(BUCKETS)
        for where, bucket, begin in self.parts():
            out += np.bincount(bucket, np.repeat(per_gram[where], np.diff(begin)), BUCKETS)
        return out


def windows(doc: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last word (exclusive) of each window, and where each text's windows begin."""
    n = A.per_doc(doc, n_docs)
    first = np.cumsum(n) - n
    k = np.where(n > 0, np.maximum(0, -(-(n - WINDOW) // STRIDE)) + 1, 0)
    inner = np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
    lo = np.repeat(first, k) + inner * STRIDE
    return lo, np.minimum(lo + WINDOW, np.repeat(first + n, k)), np.concatenate([[0], np.cumsum(k)])


@dataclass
class Model:
    """What a linear softmax makes of each bucket's vector: one weight per
    bucket, and the bias. (The average of vectors and the softmax's weights
    commute, so scoring needs no vectors.)"""

    weight: np.ndarray
    bias: float

    def score(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """The highest window's probability; a text without words gets the bias's."""
        out = np.full(len(off) - 1, self.bias)
        words = Words.of(data, off)
        if len(words.tokens):
            lo, hi, begin = windows(words.doc, len(off) - 1)
            sums = np.concatenate([[0.0], np.cumsum(words.mean(self.weight)[words.tokens])])
            z = (sums[hi] - sums[lo]) / np.maximum(hi - lo, WINDOW // 2) + self.bias
            some = np.flatnonzero(np.diff(begin))
            out[some] = np.maximum.reduceat(z, begin[some])
        return 1.0 / (1.0 + np.exp(-np.clip(out, -500, 500)))


def fit(blocks: Iterable[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Model:
    """Embeddings and softmax, jointly, by Adagrad over all texts at once;
    ``blocks`` are texts (bytes, offsets) with their labels.

    At first each window answers for its text's label, so that what only toxic
    texts hold stands out; then a text answers by the soft maximum of its
    windows, which comes ever nearer to the highest. Both classes weigh alike.
    N-grams found in fewer than ``LEAST_SEEN`` words of texts stay out, so
    that no single text is learnt by heart; unseen ones weigh nothing.
    """
    sample = Sample(blocks)
    worded, in_texts, classes = [], np.zeros(sample.n_words, np.int64), np.zeros(2, np.int64)
    for tokens, doc, label in sample.blocks:
        lo, hi, begin = windows(doc, len(label))
        some = np.flatnonzero(np.diff(begin))
        classes += np.bincount(label[some], minlength=2)
        held = np.unique(doc.astype(np.int64) * max(1, sample.n_words) + tokens) % max(1, sample.n_words)
        in_texts += np.bincount(held, minlength=sample.n_words)
        worded.append((tokens, lo.astype(np.int32), hi.astype(np.int32), begin[some], np.diff(begin)[some], label[some].astype(float)))
    if not classes.all():
        share = float(np.clip(classes[1] / max(1, classes.sum()), 1e-6, 1 - 1e-6))
        return Model(np.zeros(BUCKETS, np.float32), float(np.log(share / (1 - share))))
    known = sample.to_buckets(in_texts.astype(float)) >= LEAST_SEEN
    per_word = np.diff(sample.begin)
    rng = np.random.default_rng(SEED)
    emb = rng.normal(0, 0.1, (BUCKETS, DIM)) * known[:, None]
    soft = rng.normal(0, 0.5, DIM)
    bias, base = 0.0, 1e-8
    emb_sq, soft_sq, bias_sq = np.full(BUCKETS, base), np.full(DIM, base), base
    for epoch in range(EPOCHS):
        g = emb @ soft
        word_score, on_word, on_bias = sample.words_mean(g), np.zeros(sample.n_words), 0.0
        for tokens, lo, hi, begin, k, y in worded:
            if not len(k):
                continue
            each = 0.5 / classes[y.astype(int)]
            owner = np.repeat(np.arange(len(k)), k)
            size = np.maximum(hi - lo, WINDOW // 2)
            sums = np.concatenate([[0.0], np.cumsum(word_score[tokens])])
            z = (sums[hi] - sums[lo]) / size + bias
            if epoch < EPOCHS * FIRST:
                err = (1.0 / (1.0 + np.exp(-z)) - y[owner]) * (each / k)[owner]
            else:
                sharp = SHARP[0] + (SHARP[1] - SHARP[0]) * epoch / EPOCHS
                top = np.maximum.reduceat(z, begin)
                part = np.exp(np.clip(sharp * (z - top[owner]), -50, 0))
                part /= np.bincount(owner, part)[owner]
                pooled = np.bincount(owner, part * z)
                err = ((1.0 / (1.0 + np.exp(-pooled)) - y) * each)[owner] * part
            back, n = err / size, len(tokens) + 1
            edge = np.bincount(lo, back, n) - np.bincount(hi, back, n)
            on_word += np.bincount(tokens, np.cumsum(edge)[:-1], sample.n_words)
            on_bias += err.sum()
        on_bucket = sample.to_buckets(on_word / per_word) * known + SHRINK * g
        grad_soft = emb.T @ on_bucket
        emb_sq += on_bucket**2 * (soft @ soft) / DIM
        emb -= (RATE * on_bucket / np.sqrt(emb_sq))[:, None] * soft[None, :]
        soft_sq += grad_soft**2
        soft -= 0.1 * RATE * grad_soft / np.sqrt(soft_sq)
        bias_sq += on_bias**2
        bias -= RATE * on_bias / np.sqrt(bias_sq)
    return Model((emb @ soft).astype(np.float32), float(bias))


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """About ``SAMPLE`` labelled texts of each class, drawn by a hash of the id.

    The draw's rate comes from the class's size, so what reaches the driver
    stays the same however many labels there are. Texts over ``SAMPLE_BYTES``
    are not fitted on. An id that is labelled twice counts as toxic if one
    label says so; one with several texts gives one of them, the same in each run.
    """
    known = (labels.select(col(id_col).alias("id"), col(label_col).cast("int").alias("y")).where("id is not null and y in (0, 1)")
             .groupBy("id").agg(F.max("y").alias("y")))
    sizes = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    rate = F.when(F.col("y") == 1, F.lit(SAMPLE / max(1, sizes.get(1, 0)))).otherwise(F.lit(SAMPLE / max(1, sizes.get(0, 0))))
    unit = F.pmod(F.xxhash64(F.lit("sample"), "id"), F.lit(1 << 30)) / float(1 << 30)
    drawn = known.where(unit < rate)
    texts = docs.select(col(id_col).alias("id"), col(text_col).alias("text")).where(F.octet_length("text") <= SAMPLE_BYTES)
    # Twice SAMPLE rows in expectation, whatever the table's size.
    # Of an id's texts the one with the least hash is taken, so that each run fits on the same.
    return texts.join(F.broadcast(drawn), "id").groupBy("id").agg(
        F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"), F.max("y").alias("y"))


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
) -> Model:
    """Fit on a bounded sample of labelled documents (see ``labelled_sample``).

    One task fits, on twice ``SAMPLE`` texts in expectation; the driver gets
    the weights. Without labels of both classes the model gives each text the
    same score.
    """

    def fit_sample(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("id")

        def blocks() -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
            for i in range(0, len(rows), BLOCK):
                part = rows.iloc[i : i + BLOCK]
                yield *A.utf8(pa.array(part["text"], pa.string())), part["y"].to_numpy().astype(np.int64)

        model = fit(blocks())
        A.give_back()
        return pd.DataFrame({"weight": [model.weight.tobytes()], "bias": [model.bias]})

    sample = labelled_sample(docs, labels, id_col, text_col, label_col)
    row = sample.groupBy().applyInPandas(fit_sample, "weight binary, bias double").first()
    if row is None:  # no labelled text at all
        return fit(iter(()))
    return Model(np.frombuffer(row["weight"], np.float32), row["bias"])


def score_texts(docs: DataFrame, model: Model, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` columns and ``score`` (0 to 1) of each whole text, one row per input row.

    A NULL or empty text, or one without words, gets the model's bias as its
    score; ids play no part; an empty table gives an empty table. No shuffle:
    the model has one weight per bucket and travels with the tasks.
    """
    result = T.StructType([T.StructField("score", T.DoubleType())])
    return A.per_text(docs, keep, text_col, lambda data, off: {"score": model.score(data, off)}, result)
