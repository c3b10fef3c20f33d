"""Quality classifier: a factorisation machine.

Features of a text:
* its distinct words (runs of characters other than ASCII white space, A-Z lower-cased),
  hashed to 2^bits, each weighing 1 / sqrt(number of distinct words);
* structure statistics (shares of capitals, digits, symbols, pipes, white space and
  non-ASCII bytes, mean word length, share of distinct words and of distinct lines,
  lines and words in all, words that end in a symbol run), each put in one of ``BINS``
  bins;
* metadata: numeric columns of the row that the caller names, binned by powers of two
  (null: a bin of its own).

The score is sigmoid(b + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j), where the
interactions of all pairs take linear time by the identity
1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2).

Learning uses a bounded sample (``per_class`` rows of each class, chosen by a hash of
the id over all labels): features are made where the texts lie; those of the sample come
to the driver, which fits the machine by seeded AdaGrad, and its bias is moved to the
classes' shares among all labels. Scoring is one map over whole texts, without a
shuffle; the model (2^bits * (factors + 1) floats) is broadcast, a bound of its own.

Null and empty texts have no words: their score comes from structure and metadata. If
only one class has labels, the score is that class's; without labels it is 1 and
nothing is rejected. Repeated rows get equal results; other columns are ignored by
``score`` and handed through by ``keep``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import SPACE, Words, byte_table, chunks, prepare, text_buffer
from cadence.llm.linear import labelled, prior_shift, row_sums, scores_of, sigmoid

BITS = 15
BINS = 16
FACTORS = 8
PER_CLASS = 3000
THRESHOLD = 0.3
STATS = ("upper", "digit", "symbol", "pipe", "space", "wide", "word_length", "distinct_words", "distinct_lines",
         "lines", "words", "symbol_ends")
_MIX = np.uint64(0x9E3779B97F4A7C15)
_TABLE = byte_table(SPACE)
_CLASS = {
    "upper": np.isin(np.arange(256), np.arange(0x41, 0x5B)),
    "digit": np.isin(np.arange(256), np.arange(0x30, 0x3A)),
    "symbol": np.isin(np.arange(256), np.frombuffer(b"#$%&*+/<=>@\\^_`{}~!", np.uint8)),
    "pipe": np.arange(256) == 0x7C,
    "space": np.isin(np.arange(256), SPACE),
    "wide": np.arange(256) >= 0x80,
}


@dataclass
class Model:
    bias: float
    weights: np.ndarray
    factors: np.ndarray
    bits: int
    meta: tuple[str, ...]


def run_hashes(flat: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte run ``flat[begin:end]`` (runs in order, not overlapping)."""
    if not len(begin):
        return np.zeros(0, np.uint64)
    n = end - begin
    place = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    power = np.cumprod(np.full(512, 0x100000001B3, np.uint64))
    turn = np.uint64(1) + (place // 512).astype(np.uint64)
    part = (flat[np.repeat(begin, n) + place].astype(np.uint64) + np.uint64(1)) * power[place % 512] * turn
    h = row_sums_u64(part, np.concatenate(([0], np.cumsum(n))))
    h = (h ^ (h >> np.uint64(31))) * _MIX
    return h ^ (h >> np.uint64(29))


def row_sums_u64(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)))
    return total[first[1:]] - total[first[:-1]]


def _distinct(doc: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(doc, h) pairs, each once, in the order of docs."""
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    first = np.ones(len(doc), bool)
    first[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
    return doc[first], h[first]


def _lines(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number, distinct number) of each text's lines that aren't empty."""
    breaks = np.flatnonzero(data == 0x0A)
    edge = np.unique(np.concatenate((breaks, off[1:-1] - 1, [len(data) - 1]))) if len(data) else np.zeros(0, np.int64)
    edge = edge[edge >= 0]
    begin = np.concatenate(([0], edge[:-1] + 1)) if len(edge) else np.zeros(0, np.int64)
    end = edge + (data[edge] != 0x0A) if len(edge) else begin
    begin, end = begin[end > begin], end[end > begin]
    doc = np.searchsorted(off, begin, "right") - 1
    n = len(off) - 1
    one, _ = _distinct(doc, run_hashes(data, begin, end))
    return np.bincount(doc, minlength=n)[:n], np.bincount(one, minlength=n)[:n]


def features(data: np.ndarray, off: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, word features, structure features [texts, STATS]) of a few texts.

    Word features are in [0, 2^bits), structure features 0 to BINS - 1."""
    n = len(off) - 1
    off = off - off[0]
    w = Words(data, off, _TABLE)
    # between two spaces of one text lies a word
    inner = np.ones(len(w.spaces), bool)
    inner[w.first[1:] - 1] = False
    begin = w.spaces[inner] + 1
    end = w.spaces[np.flatnonzero(inner) + 1]
    doc = np.repeat(np.arange(n), w.counts)
    one, h = _distinct(doc, run_hashes(w.flat, begin, end))
    distinct = np.bincount(one, minlength=n)[:n]
    size = np.maximum(np.diff(off), 1)
    words = np.maximum(w.counts, 1)
    lines, own_lines = _lines(data, off)
    share = {k: np.diff(np.concatenate(([0], np.cumsum(m[data], dtype=np.int64)))[off]) / size for k, m in _CLASS.items()}
    symbols = _CLASS["symbol"][w.flat]
    ends = np.bincount(doc, symbols[end - 1], n)[:n] / words if len(end) else np.zeros(n)
    stats = {**share, "word_length": np.bincount(doc, (end - begin), n)[:n] / words / 32.0, "distinct_words": distinct / words,
             "distinct_lines": own_lines / np.maximum(lines, 1), "lines": np.log2(1 + lines) / BINS,
             "words": np.log2(1 + w.counts) / BINS, "symbol_ends": ends}
    bins = np.stack([np.clip(np.sqrt(stats[k]) * BINS, 0, BINS - 1).astype(np.int64) for k in STATS], 1)
    return np.concatenate(([0], np.cumsum(distinct))), (h & np.uint64((1 << bits) - 1)).astype(np.int64), bins


def _meta_bins(values: np.ndarray) -> np.ndarray:
    """Powers of two of a numeric column (nan: the last bin)."""
    with np.errstate(invalid="ignore", divide="ignore"):
        b = np.floor(np.log2(np.maximum(values, 0) + 1) / 2)
    return np.where(np.isnan(values), BINS - 1, np.clip(b, 0, BINS - 2)).astype(np.int64)


def _rows(data: np.ndarray, off: np.ndarray, meta: np.ndarray, bits: int):
    """Sparse rows: (first, feature, value) with words, structure and metadata."""
    first, word, bins = features(data, off, bits)
    n = len(off) - 1
    extra = np.concatenate((bins, _meta_bins(meta)), axis=1)
    extra = (1 << bits) + np.arange(extra.shape[1]) * BINS + extra
    k = extra.shape[1]
    count = np.diff(first)
    out_first = np.concatenate(([0], np.cumsum(count + k)))
    feature = np.empty(int(out_first[-1]), np.int64)
    value = np.empty(len(feature), np.float32)
    at = (out_first[1:] - k)[:, None] + np.arange(k)
    is_word = np.ones(len(feature), bool)
    is_word[at.ravel()] = False
    feature[is_word], feature[at] = word, extra
    value[is_word] = np.repeat(1 / np.sqrt(np.maximum(count, 1)), count)
    value[at.ravel()] = 1.0
    return out_first, feature, value


def machine(first: np.ndarray, feature: np.ndarray, value: np.ndarray, bias: float, weights: np.ndarray,
            factors: np.ndarray) -> np.ndarray:
    """The machine's sums, by the sum-of-squares identity."""
    vx = factors[feature] * value[:, None]
    pair = row_sums(vx, first) ** 2 - row_sums(vx * vx, first)
    return bias + row_sums(weights[feature] * value, first) + 0.5 * pair.sum(axis=1)


def fit(first: np.ndarray, feature: np.ndarray, value: np.ndarray, y: np.ndarray, size: int, factors: int = FACTORS,
        epochs: int = 8, batch: int = 256, rate: float = 0.1, penalty: float = 1e-3, seed: int = 42):
    """AdaGrad on shuffled batches of rows."""
    rng = np.random.default_rng(seed)
    w, v, b = np.zeros(size), rng.normal(0, 0.02, (size, factors)), 0.0
    gw, gv, gb = np.full(size, 1e-6), np.full((size, factors), 1e-6), 1e-6
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for lo in range(0, len(order), batch):
            rows = order[lo:lo + batch]
            n = first[rows + 1] - first[rows]
            f0 = np.concatenate(([0], np.cumsum(n)))
            at = np.repeat(first[rows], n) + np.arange(int(n.sum())) - np.repeat(f0[:-1], n)
            f, x = feature[at], value[at].astype(np.float64)
            vx = v[f] * x[:, None]
            s = row_sums(vx, f0)
            z = b + row_sums(w[f] * x, f0) + 0.5 * (s ** 2 - row_sums(vx * vx, f0)).sum(axis=1)
            err = sigmoid(z) - y[rows]
            e = np.repeat(err, n) / len(rows)
            names, where = np.unique(f, return_inverse=True)
            dw = np.bincount(where, e * x, len(names)) + penalty * w[names] / len(rows)
            grad = (e * x)[:, None] * (np.repeat(s, n, axis=0) - vx)
            dv = np.stack([np.bincount(where, grad[:, k], len(names)) for k in range(factors)], 1) + penalty * v[names] / len(rows)
            db = float(err.mean())
            gw[names] += dw ** 2
            gv[names] += dv ** 2
            gb += db ** 2
            w[names] -= rate * dw / np.sqrt(gw[names])
            v[names] -= rate * 0.5 * dv / np.sqrt(gv[names])
            b -= rate * db / np.sqrt(gb)
    return b, w, v


def _mapped(df: DataFrame, keep: Sequence[str], text_col: str, meta: Sequence[str], ddl: str, made) -> DataFrame:
    """``keep`` columns and what ``made()``'s function gives for (bytes, offsets, meta)."""
    n = len(keep)
    by_name = {f.name: f.dataType.simpleString() for f in df.schema}

    def run(batches):
        fn = made()
        for batch in batches:
            data, off = text_buffer(batch.column(n))
            numbers = [c.cast(pa.float64()).to_numpy(zero_copy_only=False) for c in batch.columns[n + 1:]]
            m = np.stack(numbers, 1) if numbers else np.zeros((batch.num_rows, 0))
            parts = [fn(data[off[a]:off[b]], off[a:b + 1] - off[a], m[a:b]) for a, b in chunks(off)]
            for at, (a, b) in enumerate(chunks(off)):
                names, arrays = parts[at]
                yield pa.RecordBatch.from_arrays([*(c.slice(a, b - a) for c in batch.columns[:n]), *arrays], names=[*keep, *names])

    out = ", ".join([f"`{c}` {by_name[c]}" for c in keep] + [ddl])
    meta_cols = [F.col(c).cast("double") for c in meta]
    return df.select(*keep, text_col, *[m.alias(f"__meta{i}") for i, m in enumerate(meta_cols)]).mapInArrow(run, out)


def learn(docs: DataFrame, labels: DataFrame, learn_on: Column, target: str = "quality", id_col: str = "doc_id",
          text_col: str = "text", meta: Sequence[str] = (), per_class: int = PER_CLASS, bits: int = BITS,
          **options) -> Model:
    prepare(docs.sparkSession)
    meta = tuple(meta)
    size = (1 << bits) + (len(STATS) + len(meta)) * BINS
    sample, sizes = labelled(docs.select(id_col, text_col, *meta), labels, target, learn_on, per_class, id_col)
    if len(sizes) < 2:
        only = -30.0 if sizes.get(0) else 30.0
        return Model(only, np.zeros(size, np.float32), np.zeros((size, FACTORS), np.float32), bits, meta)

    def extract():
        def run(data, off, m):
            first, feature, value = _rows(data, off, m, bits)
            o = pa.array(first, pa.int32())
            return ["f", "x"], [pa.ListArray.from_arrays(o, pa.array(feature, pa.int32())),
                                pa.ListArray.from_arrays(o, pa.array(value, pa.float32()))]
        return run

    got = _mapped(sample, [id_col, "__y"], text_col, meta, "f array<int>, x array<float>", extract).toArrow().sort_by(id_col)
    lists, values = got["f"].combine_chunks(), got["x"].combine_chunks()
    first = lists.offsets.to_numpy().astype(np.int64)
    feature = lists.values.to_numpy()[first[0]:first[-1]].astype(np.int64)
    y = got["__y"].to_numpy().astype(np.float64)
    b, w, v = fit(first - first[0], feature, values.values.to_numpy()[first[0]:first[-1]], y, size, **options)
    b += prior_shift(sizes, {0: int((y == 0).sum()), 1: int((y == 1).sum())})
    return Model(b, w.astype(np.float32), v.astype(np.float32), bits, meta)


def scorer(sc, model: Model):
    shared = sc.broadcast(model)

    def factory():
        m = shared.value

        def run(data: np.ndarray, off: np.ndarray, meta: np.ndarray) -> np.ndarray:
            first, feature, value = _rows(data, off, meta, m.bits)
            return scores_of(machine(first, feature, value, m.bias, m.weights, m.factors))

        return run

    return factory


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and score (0 to 1) of every row."""
    prepare(docs.sparkSession)
    factory = scorer(docs.sparkSession.sparkContext, model)

    def made():
        run = factory()
        return lambda data, off, meta: (["score"], [pa.array(run(data, off, meta), pa.float64())])

    return _mapped(docs, [id_col], text_col, model.meta, "score double", made)


def keep(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents with a score of ``threshold`` or more, with all columns."""
    prepare(docs.sparkSession)
    factory = scorer(docs.sparkSession.sparkContext, model)
    at = docs.columns.index(text_col)
    meta_at = [docs.columns.index(c) for c in model.meta]

    def run(batches):
        fn = factory()
        for batch in batches:
            data, off = text_buffer(batch.column(at))
            numbers = [batch.column(i).cast(pa.float64()).to_numpy(zero_copy_only=False) for i in meta_at]
            m = np.stack(numbers, 1) if numbers else np.zeros((batch.num_rows, 0))
            scores = [fn(data[off[a]:off[b]], off[a:b + 1] - off[a], m[a:b]) for a, b in chunks(off)]
            yield batch.filter(pa.array(np.concatenate(scores) >= threshold if scores else [], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
