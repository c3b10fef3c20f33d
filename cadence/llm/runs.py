"""Periodic runs of words: suffix-tree longest common extensions.

A run is a stretch of words with smallest period q (words q apart are equal), at least
``max(MIN_LENGTH, 2 q)`` long, that no neighbouring word extends. Each text is one row
and is treated in the task that reads it, without a shuffle:

1. Words become numbers by first appearance. A run of 12 words or more repeats every one
   of its 6-grams on at least one side of its period, so only words inside a 6-gram that
   occurs twice in the text can belong to one, and a run lies in one unbroken stretch of
   such words. Equal 6-grams have equal hashes, so the hash that finds them loses none.
   All other words are passed over: texts without repetition need no tree.
2. For each stretch and for its reversal Ukkonen's algorithm builds a suffix tree. An
   Euler tour of it with a sparse table of range minima answers the lowest common
   ancestor of two leaves in constant time; its depth is the longest common extension.
3. The tour's leaf order is the suffix order. The longest Lyndon word at i ends before the
   next smaller suffix; that word, under the order of words and under the reversed
   order, is the root of every run (the runs theorem). Each candidate root (i, j) is
   extended forward by the extension of i and j and backward by that of i - 1 and j - 1
   in the reversal's tree; it is a run if the whole is two periods long.

Memory: a repeating stretch takes about 1,000 bytes a word while its trees stand
(measured), about 5 microseconds a word and tree pair; texts are taken one at a time, so
a task is bounded by the longest repeating stretch of one text.

Defined cases: null and empty texts have no words and no runs; a null id is never planted
(``replant``); ties of the longest run go to the smallest start, then period; repeated
rows are treated alike, and an empty table gives no rows. Columns other than the id and
the text are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cadence.llm.common import prepare

MIN_LENGTH = 12
#: Words of the grams whose repetition every run of MIN_LENGTH words shows.
GRAM = MIN_LENGTH // 2
_MIX = np.uint64(0x9E3779B97F4A7C15)


class SuffixTree:
    """Ukkonen's suffix tree of a list of numbers >= 1, closed by a 0 of its own.

    ``edges`` maps (node, first word) to a child; an edge's label is
    ``text[start:end]``, where a leaf's end is the whole text's."""

    def __init__(self, text: Sequence[int]):
        self.text = text = [*text, 0]
        n = len(text)
        width = max(text) + 1
        start, end, link = [0], [0], [0]
        edges: dict[int, int] = {}
        parent = [0]
        node, first, length, left = 0, 0, 0, 0   # the active point and the suffixes still to add
        for pos, word in enumerate(text):
            left += 1
            fresh = 0                             # inner node of this phase without a suffix link yet
            while left:
                if not length:
                    first = pos
                key = node * width + text[first]
                child = edges.get(key)
                if child is None:
                    edges[key] = len(start)
                    start.append(pos), end.append(n), link.append(0), parent.append(node)
                    if fresh:
                        link[fresh], fresh = node, 0
                else:
                    size = (pos + 1 if end[child] == n else end[child]) - start[child]
                    if length >= size:            # walk down
                        node, first, length = child, first + size, length - size
                        continue
                    at = start[child]
                    if text[at + length] == word:
                        if fresh:
                            link[fresh] = node
                        length += 1
                        break
                    split = len(start)
                    start.append(at), end.append(at + length), link.append(0), parent.append(node)
                    edges[key] = split
                    edges[split * width + word] = split + 1
                    start.append(pos), end.append(n), link.append(0), parent.append(split)
                    start[child], parent[child] = at + length, split
                    edges[split * width + text[at + length]] = child
                    if fresh:
                        link[fresh] = split
                    fresh = split
                left -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    first = pos - left + 1
        self.n = n
        self.parent = np.array(parent, np.int64)
        self.start, self.end = np.array(start, np.int64), np.array(end, np.int64)
        self._tour()

    def _tour(self) -> None:
        """Euler tour with children by first word. Only what a query needs is kept of it:
        per suffix in tour order its leaf, and between neighbouring leaves the depth of
        the shallowest node that the tour passes, with a sparse table of its minima."""
        nodes = len(self.parent)
        size = self.end - self.start
        label = np.array(self.text, np.int64)[np.minimum(self.start, self.n - 1)]
        order = np.lexsort((label, self.parent))
        order = order[order != 0]
        firsts = np.searchsorted(self.parent[order], np.arange(nodes + 1)).tolist()
        kids, sizes = order.tolist(), size.tolist()
        leaves, low, depth = [], [], [0] * nodes
        shallow = 0
        stack = kids[firsts[0]:firsts[1]][::-1]
        parent = self.parent.tolist()
        while stack:
            at = stack.pop()
            over = depth[parent[at]]
            if over < shallow:
                shallow = over                    # the tour came up to the parent
            depth[at] = here = over + sizes[at]
            a, b = firsts[at], firsts[at + 1]
            if a == b:
                leaves.append(self.n - here)      # the suffix that ends in this leaf
                low.append(shallow)
                shallow = here
            else:
                stack += kids[a:b][::-1]
        self.suffixes = np.array(leaves, np.int64)
        self.rank = np.empty(self.n, np.int64)
        self.rank[self.suffixes] = np.arange(self.n)
        table = [np.array(low, np.int32)]
        step = 1
        while 2 * step <= self.n:
            last = table[-1]
            table.append(np.minimum(last[:-step], last[step:]))
            step *= 2
        self.table = table

    def lce(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Longest common extensions of the suffixes at ``a`` and ``b`` (a != b), by two
        lookups each."""
        ra, rb = self.rank[a], self.rank[b]
        lo, hi = np.minimum(ra, rb) + 1, np.maximum(ra, rb)
        level = np.frexp(hi - lo + 1)[1] - 1
        out = np.empty(len(a), np.int64)
        for k in np.unique(level).tolist():
            m = level == k
            row = self.table[k]
            out[m] = np.minimum(row[lo[m]], row[hi[m] - (1 << k) + 1])
        return out


def lyndon_ends(rank: list[int]) -> list[int]:
    """For each suffix the next one that is smaller: the end of its longest Lyndon word."""
    n = len(rank)
    out = [n] * n
    stack: list[int] = []
    for i in range(n):
        r = rank[i]
        while stack and rank[stack[-1]] > r:
            out[stack.pop()] = i
        stack.append(i)
    return out


def stretch_runs(words: Sequence[int], least: int = MIN_LENGTH) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of one list of numbers >= 1."""
    n = len(words)
    if n < least:
        return []
    tree, back = SuffixTree(words), SuffixTree(words[::-1])
    starts = np.arange(n, dtype=np.int64)
    found = []
    # Any end of text will do for the reversed order: the roots of runs that end before
    # it are told apart inside the text, and the others are roots of the first order.
    for rank in (tree.rank.tolist(), (n - tree.rank).tolist()):
        i, j = starts, np.array(lyndon_ends(rank)[:n], np.int64)
        period = j - i
        inner = j < n
        ahead = np.zeros(n, np.int64)
        ahead[inner] = tree.lce(i[inner], j[inner])
        behind = np.zeros(n, np.int64)
        prior = inner & (i > 0)
        behind[prior] = back.lce(n - i[prior], n - j[prior])
        length = period + ahead + behind
        good = inner & (length >= np.maximum(2 * period, least))
        found.append(np.stack([(i - behind)[good], length[good], period[good]], axis=1))
    return [tuple(r) for r in np.unique(np.concatenate(found), axis=0).tolist()]


def repeated_stretches(ids: np.ndarray) -> list[tuple[int, int]]:
    """Stretches [a, b) of words inside a GRAM that occurs more than once, of at least
    MIN_LENGTH words."""
    n = len(ids)
    m = n - GRAM + 1
    if n < MIN_LENGTH:
        return []
    mixed = (ids.astype(np.uint64) + np.uint64(1)) * _MIX
    mixed ^= mixed >> np.uint64(29)
    grams = np.zeros(m, np.uint64)
    for k in range(GRAM):
        grams = grams * np.uint64(0x100000001B3) + mixed[k:k + m]
    ordered = np.sort(grams)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return []
    at = np.searchsorted(twice, grams)
    at[at == len(twice)] = 0
    again = np.flatnonzero(twice[at] == grams)
    covered = np.zeros(n + 1, np.int32)
    np.add.at(covered, again, 1)
    np.add.at(covered, again + GRAM, -1)
    inside = np.concatenate(([False], np.cumsum(covered[:n]) > 0, [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return [(a, b) for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()) if b - a >= MIN_LENGTH]


def text_runs(words: Sequence[bytes]) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of a text's words, by start, then period."""
    if len(words) < MIN_LENGTH:
        return []
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    out = []
    for a, b in repeated_stretches(ids):
        _, small = np.unique(ids[a:b], return_inverse=True)
        out += [(a + s, length, period) for s, length, period in stretch_runs((small + 1).tolist())]
    return sorted(out, key=lambda r: (r[0], r[2]))


def kept_words(words: Sequence[bytes], runs: Sequence[tuple[int, int, int]]) -> Sequence[bytes]:
    """The words without those that a run holds after its first period."""
    if not runs:
        return words
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(gone[:-1]) == 0).tolist()]


def replant(words: list[bytes], key: str | None) -> list[bytes]:
    """The contract's planted repetition: where crc32 of the id's text ends in 0, the
    words from one place on repeat the first of them with one period."""
    h = zlib.crc32(key.encode()) if key is not None else 1
    n = len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    head = words[a:a + p]
    return words[:a] + (head * (-(-(n - a) // p)))[:n - a]


RESULT = [("n_runs", pa.int64(), "bigint"), ("start", pa.int64(), "bigint"), ("length", pa.int64(), "bigint"),
          ("period", pa.int64(), "bigint"), ("exponent_milli", pa.int64(), "bigint"),
          ("runs_sha256", pa.string(), "string"), ("collapsed_sha256", pa.string(), "string")]


def _summary(words: Sequence[bytes]) -> tuple:
    runs = text_runs(words)
    listed = hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()).hexdigest()
    kept = hashlib.sha256(b" ".join(kept_words(words, runs))).hexdigest()
    if not runs:
        return (0, None, None, None, None, listed, kept)
    s, length, q = min(runs, key=lambda r: (-r[1], r[0], r[2]))
    return (len(runs), s, length, q, 1000 * length // q, listed, kept)


def _per_text(df: DataFrame, id_col: str, text_col: str, fields, fn: Callable) -> DataFrame:
    """The id and the ``fields`` that ``fn(id as text, words)`` gives of each row."""
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [fn(k.as_py(), (t.as_py() or b"").split()) for k, t in zip(batch.column(1), batch.column(2))]
            made = list(zip(*rows)) if rows else [[] for _ in fields]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(v, t) for v, (_, t, _) in zip(made, fields))],
                                             names=[id_col, *(f[0] for f in fields)])

    prepare(df.sparkSession)
    ddl = ", ".join([f"`{id_col}` {kind}", *(f"{name} {sql}" for name, _, sql in fields)])
    return df.selectExpr(f"`{id_col}`", f"cast(`{id_col}` as string) __key", f"cast(`{text_col}` as binary) __text").mapInArrow(run, ddl)


def find(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and ``runs``, an array of (start, length, period), of every text."""
    item = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def fn(_key, words):
        return ([dict(zip(("start", "length", "period"), r)) for r in text_runs(words)],)
    return _per_text(df, id_col, text_col, [("runs", pa.list_(item), "array<struct<start:bigint,length:bigint,period:bigint>>")], fn)


def collapse(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and ``collapsed``: the text's words, joined by one space, with every run cut to
    its first period."""
    def fn(_key, words):
        return (b" ".join(kept_words(words, text_runs(words))).decode(errors="replace"),)
    return _per_text(df, id_col, text_col, [("collapsed", pa.string(), "string")], fn)


def digests(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", planted: bool = False) -> DataFrame:
    """id, number of runs, the longest run and digests of all runs and of the collapsed
    words; with ``planted`` of the texts after ``replant``."""
    return _per_text(df, id_col, text_col, RESULT, lambda key, words: _summary(replant(words, key) if planted else words))
