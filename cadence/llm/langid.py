"""Language identification with hyperdimensional profiles.

Each letter (and the word boundary) has a random vector of +1 and -1, made from a
generator seeded with its code point. An n-gram's vector binds its letters: the product
of their vectors, each permuted (rotated) by its place. A document's vector bundles the
vectors of all its n-grams, repeats included. A language's prototype bundles the unit
vectors of its learning documents; a document gets the language whose prototype has the
largest cosine with its vector, and that cosine, held to 0 to 1, as its score. Ties go
to the language first in code point order.

Prototypes are learnt on a bounded sample of labelled rows (``per_lang`` of each
language, chosen by a hash of the id over all rows); their sums are taken in whole
numbers, so reruns agree. Learning and prediction are maps over the documents; only
one vector per language and task is shuffled, and one per language is sent to the tasks
(dims * 8 bytes per language).

A text that is null or has no letter gets ``und`` and score 0; so does every text if no
language could be learnt. Long texts are taken whole, in stretches. Repeated rows get equal results;
other columns are ignored by ``predict`` and handed through by ``keep``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import bounded_sample, chunks, filter_texts, map_texts, prepare, text_buffer
from cadence.llm.letters import letter_sequence, symbol_stretches

DIMS = 1024
GRAM = 3
PER_LANG = 4000
#: Bytes of a long text whose n-grams are held at once.
STRETCH = 1 << 22
UND = "und"
#: Cosine below which the pipeline takes a text to be in none of the languages.
MIN_SCORE = 0.05
_UNIT = float(1 << 24)


class Encoder:
    """Document vectors. Keeps the vectors of the n-grams seen so far (at most
    ``cache`` of them; the oldest table goes when it is full, results don't change)."""

    def __init__(self, dims: int = DIMS, gram: int = GRAM, cache: int = 1 << 14):
        self.dims, self.gram, self.cache = dims, gram, cache
        self.letters: dict[int, np.ndarray] = {}
        self.rows: dict[int, int] = {}
        self.table = np.zeros((0, dims), np.int8)
        self.symbol = np.full(0x20000, -1, np.int64)
        self.far: dict[int, int] = {}
        self.points: list[int] = []

    def letter(self, point: int) -> np.ndarray:
        if point not in self.letters:
            bits = np.random.Generator(np.random.Philox(key=point + 1)).integers(0, 2, self.dims, np.int8)
            self.letters[point] = 2 * bits - 1
        return self.letters[point]

    def gram_vector(self, points: list[int]) -> np.ndarray:
        out = np.ones(self.dims, np.int8)
        for place, point in enumerate(points):
            out = out * np.roll(self.letter(point), len(points) - 1 - place)
        return out

    def _symbols(self, flat: np.ndarray) -> np.ndarray:
        """Small numbers for code points, in order of appearance."""
        near = np.where(flat < len(self.symbol), flat, 0)
        new = np.unique(flat[(self.symbol[near] < 0) | (flat >= len(self.symbol))])
        for p in new.tolist():
            if p < len(self.symbol):
                self.symbol[p] = len(self.points)
                self.points.append(p)
            elif p not in self.far:
                self.far[p] = len(self.points)
                self.points.append(p)
        out = self.symbol[near]
        if self.far:
            for i in np.flatnonzero(flat >= len(self.symbol)).tolist():
                out[i] = self.far[int(flat[i])]
        return out

    def _vectors(self, codes: np.ndarray, width: int) -> np.ndarray:
        """Vectors of n-grams named by their symbols' numbers, ``width`` bits each."""
        points = []
        for g in range(self.gram - 1, -1, -1):
            points.append((codes >> (g * width)) & ((1 << width) - 1))
        named = [tuple(x) for x in np.stack(points, 1).tolist()]
        missing = [n for n in named if n not in self.rows]
        if missing:
            if len(self.rows) + len(missing) > max(self.cache, len(missing)):
                self.rows, self.table = {}, np.zeros((0, self.dims), np.int8)
                missing = list(named)
            made = np.stack([self.gram_vector([self.points[s] for s in n]) for n in missing])
            for n in missing:
                self.rows[n] = len(self.rows)
            self.table = np.concatenate((self.table, made))
        return self.table[[self.rows[n] for n in named]]

    def encode(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(vectors, number of n-grams) of a few texts; a text without letters has none.
        The vector of a text above ``STRETCH`` bytes is added up over its stretches."""
        if len(off) == 2 and len(data) > STRETCH:
            total, grams = np.zeros((1, self.dims)), np.zeros(1, np.int64)
            for sym in symbol_stretches(data, self.gram - 1, STRETCH):
                if len(sym) >= self.gram or not grams[0]:
                    vec, n = self.bundle(sym, np.array([0, len(sym)]))
                    total, grams = total + vec, grams + n
            return total, grams
        flat, first = letter_sequence(data, off)
        n = len(first) - 1
        return self.bundle(flat, first)

    def bundle(self, flat: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``encode`` of symbols."""
        n = len(first) - 1
        out = np.zeros((n, self.dims), np.float32)
        length = np.diff(first)
        grams = np.maximum(length - self.gram + 1, (length > 1).astype(np.int64))
        if not grams.any():
            return out, grams
        sym = self._symbols(np.concatenate((flat, np.zeros(self.gram, np.uint32))))
        width = max(1, int(len(self.points)).bit_length())
        if width * self.gram > 62:
            raise ValueError("alphabet too large for the n-gram length")
        code = np.zeros(len(flat), np.int64)
        for g in range(self.gram):
            code = (code << width) | sym[g:g + len(flat)]
        doc = np.repeat(np.arange(n), length)
        place = np.arange(len(flat)) - first[doc]
        on = place < grams[doc]
        code, doc = code[on], doc[on]
        names, at = (np.unique(code, return_inverse=True) if width * self.gram > 22 else _unique_small(code, 1 << (width * self.gram)))
        if n > 1 and n * len(names) > 1 << 22:  # many different n-grams: fewer texts at a time
            mid = n // 2
            halves = [self.bundle(flat[first[a]:first[b]], first[a:b + 1] - first[a]) for a, b in ((0, mid), (mid, n))]
            return np.concatenate([h[0] for h in halves]), grams
        step = 1 << 13  # n-grams whose vectors are held at once
        counts = np.bincount(doc * len(names) + at, minlength=n * len(names)).reshape(n, len(names)).astype(np.float32)
        for lo in range(0, len(names), step):
            out += counts[:, lo:lo + step] @ self._vectors(names[lo:lo + step], width).astype(np.float32)
        return out, grams


def _unique_small(code: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    seen = np.zeros(size, bool)
    seen[code] = True
    names = np.flatnonzero(seen)
    place = np.zeros(size, np.int32)
    place[names] = np.arange(len(names), dtype=np.int32)
    return names, place[code]


def _blocks(data: np.ndarray, off: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pieces of half a MB and at most 256 texts."""
    for lo, hi in chunks(off, 1 << 19):
        for a in range(lo, hi, 256):
            b = min(a + 256, hi)
            yield data[off[a]:off[b]], off[a:b + 1] - off[a]


def learn(docs: DataFrame, learn_on: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang", per_lang: int = PER_LANG, dims: int = DIMS, gram: int = GRAM) -> tuple[list[str], np.ndarray]:
    """Languages and their prototypes (unit length), from rows with a language that
    ``learn_on`` (a condition; none: all) allows."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.col(id_col).alias("id"),
                       (F.lit(True) if learn_on is None else learn_on).alias("on")).filter("on and lang is not null")
    sample = bounded_sample(rows, "lang", "id", per_lang).select("lang", "text")

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, sums = Encoder(dims, gram), {}
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            data, off = text_buffer(batch.column(1))
            at = 0
            for part, o in _blocks(data, off):
                vec, n = enc.encode(part, o)
                own = langs[at:at + len(n)]
                at += len(n)
                norm = np.linalg.norm(vec, axis=1, keepdims=True)
                unit = np.rint(np.divide(vec, norm, out=np.zeros_like(vec), where=norm > 0) * _UNIT).astype(np.int64)
                for lang in set(own[n > 0]):
                    sums[lang] = sums.get(lang, 0) + unit[(own == lang) & (n > 0)].sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()),
                                          pa.array([s.tolist() for s in sums.values()], pa.list_(pa.int64()))], names=["lang", "v"])

    parts = sample.mapInArrow(bundle, "lang string, v array<bigint>")
    total = parts.select("lang", F.posexplode("v").alias("i", "x")).groupBy("lang", "i").agg(F.sum("x").alias("x"))
    got = total.groupBy("lang").agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "x"))), lambda s: s["x"]).alias("v")).collect()
    langs = sorted(r["lang"] for r in got)
    if not langs:
        return [], np.zeros((0, dims))
    by = {r["lang"]: np.array(r["v"], np.float64) for r in got}
    protos = np.stack([by[x] for x in langs])
    norm = np.linalg.norm(protos, axis=1, keepdims=True)
    return langs, protos / np.where(norm > 0, norm, 1)


def predictor(model: tuple[list[str], np.ndarray], dims: int = DIMS, gram: int = GRAM):
    langs, protos = model

    def factory():
        enc = Encoder(dims, gram)

        def predict(data: np.ndarray, off: np.ndarray):
            names, scores = [], []
            for part, o in _blocks(data, off):
                vec, n = enc.encode(part, o)
                if not langs:
                    names += [UND] * len(n)
                    scores += [0.0] * len(n)
                    continue
                vec = vec.astype(np.float64)
                norm = np.linalg.norm(vec, axis=1)
                # rounded, so that a score doesn't depend on the texts that share its batch
                cos = np.round((vec @ protos.T) / np.where(norm > 0, norm, 1)[:, None], 6)
                best = cos.argmax(axis=1)
                top = np.clip(cos[np.arange(len(n)), best], 0, 1)
                names += [langs[b] if k else UND for b, k in zip(best.tolist(), n.tolist())]
                scores += np.where(n > 0, top, 0.0).tolist()
            return names, scores

        return predict

    return factory


def predict(docs: DataFrame, model, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """id, lang_pred, score of every row."""
    prepare(docs.sparkSession)
    return map_texts(docs, text_col, predictor(model, **options),
                     [("lang_pred", pa.string(), "string"), ("score", pa.float64(), "double")], [id_col])


def keep(docs: DataFrame, model, text_col: str = "text", min_score: float = MIN_SCORE, **options) -> DataFrame:
    """The documents in one of the model's languages, with all columns: texts without a
    letter and those whose best cosine is below ``min_score`` go. A model without
    languages rejects only texts without a letter."""
    prepare(docs.sparkSession)
    factory = predictor(model, **options)
    known = bool(model[0])

    def keeper():
        if not known:
            return lambda data, off: [(np.diff(letter_sequence(data, off)[1]) > 1).tolist()]
        run = factory()

        def decide(data, off):
            names, scores = run(data, off)
            return [[n != UND and s >= min_score for n, s in zip(names, scores)]]

        return decide

    return filter_texts(docs, text_col, keeper)
