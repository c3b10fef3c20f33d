"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count
ratios.

Texts are lower-case letters with one boundary between words; n-grams of ``grams``
characters, boundaries included, are hashed to 2^bits features, present or absent. For
each feature r = log((p + a) / |p| / ((q + a) / |q|)) of the numbers p and q of toxic
and other learning documents that hold it. The classifier is a logistic regression on
x * r (the scaled presences), with L2 penalty. It keeps features
whose ratio the counts support: a log-likelihood ratio G of their 2 x 2 table of
``support`` or more, and of those the ``width`` largest. The rest say nothing sure about
the class, and without them a text is scored by one table look-up per n-gram.

Learning uses a bounded sample (``per_class`` rows of each class, chosen by a hash of
the id over all labels): documents' n-grams are counted where they lie, 2^bits pairs of
counts are summed, and the kept features of the sample rows (at most ``per_class * 2 *
width`` numbers, a few hundred each in practice) come to the driver, which fits the
weights. Scoring is one map over whole texts, without a shuffle; a long text's n-grams
are gathered stretch by stretch.

Null and empty texts, or texts without a kept n-gram, get the score of the bias. If only
one class has labels, the score is that class's; without labels it is 0. Repeated rows
get equal results; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import chunks, map_texts, prepare, text_buffer
from cadence.llm.letters import letter_sequence, symbol_stretches
from cadence.llm.linear import labelled, prior_shift, row_sums, scores_of, sigmoid

GRAMS = (4, 5)
BITS = 18
WIDTH = 1 << 14
PER_CLASS = 4000
#: Bytes of a long text whose n-grams are held at once.
STRETCH = 1 << 22
_MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Model:
    """Weight of each hashed feature (0: not kept), bias, and how n-grams are hashed."""
    weights: np.ndarray
    bias: float
    grams: Sequence[int]
    bits: int


def hashed_grams(flat: np.ndarray, first: np.ndarray, grams: Sequence[int], bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text, feature) of every n-gram, one n at a time. A text shorter than n has none;
    boundaries of neighbouring texts are never joined."""
    length = np.diff(first)
    sym = flat.astype(np.uint64) + np.uint64(1)
    doc = np.repeat(np.arange(len(length), dtype=np.int32), length)
    code, width = np.zeros(len(sym), np.uint64), 0
    for n in sorted(grams):
        while width < n:  # the code of n + 1 characters follows from that of n
            ahead = np.zeros(len(sym), np.uint64)
            ahead[:max(0, len(sym) - width)] = sym[width:]
            code = (code * np.uint64(0x100000001B3)) ^ ahead
            width += 1
        h = (((code ^ np.uint64(n)) * _MIX) >> np.uint64(64 - bits)).astype(np.int64)
        whole = np.zeros(len(sym), bool)
        if len(sym) >= n:
            whole[:len(sym) - n + 1] = doc[:len(sym) - n + 1] == doc[n - 1:]
        yield doc[whole], h[whole]


def present(data: np.ndarray, off: np.ndarray, grams: Sequence[int], bits: int, kept: np.ndarray | None = None):
    """(text, feature) pairs, each once, ascending; only features of the mask ``kept``.
    Of a text above ``STRETCH`` bytes that comes alone, stretch by stretch."""
    if len(off) == 2 and len(data) > STRETCH:
        held = np.zeros(1 << bits, bool)
        for sym in symbol_stretches(data, max(grams) - 1, STRETCH):
            for _, h in hashed_grams(sym, np.array([0, len(sym)]), grams, bits):
                held[h] = True
        f = np.flatnonzero(held if kept is None else held & kept)
        return np.zeros(len(f), np.int64), f
    flat, first = letter_sequence(data, off)
    keys = []
    for doc, h in hashed_grams(flat, first, grams, bits):
        if kept is not None:
            on = kept[h]
            doc, h = doc[on], h[on]
        keys.append((doc.astype(np.int64) << bits) | h)
    pairs = np.unique(np.concatenate(keys)) if keys else np.zeros(0, np.int64)
    return pairs >> bits, pairs & ((1 << bits) - 1)


def log_count_ratios(sample: DataFrame, text_col: str, grams: Sequence[int], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Document counts (p, q) of every feature in toxic and other rows of ``sample``."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, 1 << bits), np.int64)
        for batch in batches:
            y = batch.column(0).to_numpy(zero_copy_only=False)
            data, off = text_buffer(batch.column(1))
            for lo, hi in chunks(off):
                doc, f = present(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo], grams, bits)
                for c in (0, 1):
                    sums[c] += np.bincount(f[y[lo:hi][doc] == c], minlength=1 << bits)
        at = np.flatnonzero(sums.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[1][at]), pa.array(sums[0][at])], names=["f", "p", "q"])

    parts = sample.select("__y", text_col).mapInArrow(count, "f bigint, p bigint, q bigint")
    got = parts.groupBy("f").agg(F.sum("p").alias("p"), F.sum("q").alias("q")).toArrow()
    p, q = np.zeros(1 << bits), np.zeros(1 << bits)
    at = got["f"].to_numpy()
    p[at], q[at] = got["p"].to_numpy(), got["q"].to_numpy()
    return p, q


def support_of(p: np.ndarray, q: np.ndarray, n1: int, n0: int) -> np.ndarray:
    """Log-likelihood ratio G of each feature's presence against the class."""
    def part(seen: np.ndarray, expected: np.ndarray) -> np.ndarray:
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-12) / np.maximum(expected, 1e-12)), 0.0)

    held, n = p + q, n1 + n0
    return 2 * (part(p, held * n1 / n) + part(q, held * n0 / n)
                + part(n1 - p, (n - held) * n1 / n) + part(n0 - q, (n - held) * n0 / n))


def fit_logistic(first: np.ndarray, col: np.ndarray, value: np.ndarray, y: np.ndarray, width: int,
                 penalty: float, steps: int) -> tuple[np.ndarray, float]:
    """Logistic regression on sparse rows by Adam on the whole sample."""
    w, b = np.zeros(width), 0.0
    m1, m2, n1, n2 = np.zeros(width), np.zeros(width), 0.0, 0.0
    row = np.repeat(np.arange(len(y)), np.diff(first))
    for t in range(1, steps + 1):
        err = (sigmoid(row_sums(value * w[col], first) + b) - y) / max(1, len(y))
        g = np.bincount(col, value * err[row], width) + penalty * w
        gb = float(err.sum())
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.99 * m2 + 0.01 * g * g
        n1, n2 = 0.9 * n1 + 0.1 * gb, 0.99 * n2 + 0.01 * gb * gb
        c1, c2 = 1 - 0.9 ** t, 1 - 0.99 ** t
        w -= 0.05 * (m1 / c1) / (np.sqrt(m2 / c2) + 1e-8)
        b -= 0.05 * (n1 / c1) / (np.sqrt(n2 / c2) + 1e-8)
    return w, b


def learn(docs: DataFrame, labels: DataFrame, learn_on: Column, target: str = "toxic", id_col: str = "doc_id",
          text_col: str = "text", per_class: int = PER_CLASS, grams: Sequence[int] = GRAMS, bits: int = BITS,
          width: int = WIDTH, support: float = 8.0, smooth: float = 1.0, penalty: float = 1e-3, steps: int = 150) -> Model:
    prepare(docs.sparkSession)
    sample, sizes = labelled(docs.select(id_col, text_col), labels, target, learn_on, per_class, id_col)
    if len(sizes) < 2:
        return Model(np.zeros(1 << bits, np.float32), 30.0 if sizes.get(1) else -30.0, grams, bits)
    sampled = {int(r["__y"]): int(r["n"]) for r in sample.groupBy("__y").agg(F.count(F.lit(1)).alias("n")).collect()}
    p, q = log_count_ratios(sample, text_col, grams, bits)
    r = np.log((p + smooth) / (p.sum() + smooth * len(p))) - np.log((q + smooth) / (q.sum() + smooth * len(q)))
    g = support_of(p, q, *(int(sampled.get(c, 0)) for c in (1, 0)))
    chosen = np.sort(np.argsort(-g, kind="stable")[:width])
    chosen = chosen[g[chosen] >= support]
    kept = np.zeros(1 << bits, bool)
    kept[chosen] = True

    def extract():
        def run(data: np.ndarray, off: np.ndarray):
            doc, f = present(data, off, grams, bits, kept)
            return [np.split(f.astype(np.int32), np.searchsorted(doc, np.arange(1, len(off) - 1)))]
        return run

    got = map_texts(sample, text_col, extract, [("f", pa.list_(pa.int32()), "array<int>")], [id_col, "__y"]).toArrow()
    got = got.sort_by(id_col)
    lists = got["f"].combine_chunks()
    first = lists.offsets.to_numpy().astype(np.int64)
    feature = lists.values.to_numpy()[first[0]:first[-1]]
    y = got["__y"].to_numpy().astype(np.float64)
    w, b = fit_logistic(first - first[0], np.searchsorted(chosen, feature), r[feature], y, len(chosen), penalty, steps)
    weights = np.zeros(1 << bits, np.float32)
    weights[chosen] = w * r[chosen]
    return Model(weights, b + prior_shift(sizes, sampled), grams, bits)


def scorer(model: Model):
    def factory():
        kept = model.weights != 0

        def score(data: np.ndarray, off: np.ndarray):
            doc, f = present(data, off, model.grams, model.bits, kept)
            return [scores_of(np.bincount(doc, model.weights[f], len(off) - 1) + model.bias).tolist()]

        return score

    return factory


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and score (0 to 1) of every row."""
    prepare(docs.sparkSession)
    return map_texts(docs, text_col, scorer(model), [("score", pa.float64(), "double")], [id_col])
