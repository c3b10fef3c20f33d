"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

A window is ``size`` consecutive words of a benchmark item (an item of fewer, but not
none, is one window). Texts and windows are written as words between single spaces, so
a window occurs in a text exactly if its bytes do. The search is Wu and Manber's: a
table over hashed blocks of ``block`` bytes says how far the search window may shift
(the distance of that block's last occurrence from the end of any test string's first
m bytes); blocks that end a test string there have shift 0 and lead to a bucket of
test strings with that suffix hash, whose first bytes are compared as the method's
prefix filter and then whole strings directly. Test strings are grouped by length
(powers of two), so that one short item doesn't shorten the shifts of all others.
NumPy runs many search windows abreast, each over its own stretch of a batch's texts.

Per document the result is exact. The windows are made, counted and dealt to blocks of
about ``block_bytes`` by Spark; only one block at a time passes through the driver, on
its way to the tasks, and a Python worker builds a block's tables once and keeps them
for its later tasks. A benchmark of one block is searched in one map over the documents,
without a shuffle. Of more, each block is one map whose hits alone are written, under
the SHA-256 of their text; they are merged by it and joined to the documents' ids, so
that the cost of a benchmark is that of its blocks. A block is as large as its windows
and the lists of items that hold them; one window held by very many items is one row.

Null and empty texts have no words and are never hit. Repeated rows get equal results;
``hits`` ignores columns other than the id and the text, whatever their names, and
``clean`` hands them through. An empty benchmark hits nothing.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import Words, byte_table, filter_texts, map_texts, prepare, written

#: All ASCII bytes but digits and letters part words; bytes of other code points don't.
SEPARATORS = [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
WINDOW = 10
#: Bytes of a search window's stretch of text.
LANE = 1024
_MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[bytes]:
    table = byte_table(SEPARATORS)
    return bytes(table[np.frombuffer((text or "").encode(), np.uint8)]).split()


def item_windows(text: str | None, size: int = WINDOW) -> Iterator[tuple[bytes, int]]:
    """(window string, its number of words) of every window of an item's text."""
    words = words_of(text)
    for i in range(max(1, len(words) - size + 1) if words else 0):
        part = words[i:i + size]
        yield b" " + b" ".join(part) + b" ", len(part)


def windows(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text", size: int = WINDOW) -> DataFrame:
    """One row per distinct window of the items: window (its bytes), words, and items
    (the ids that hold it as strings, sorted; a null id is the empty string)."""
    piece = 1 << 14  # windows sent to Spark at once, so that a long item is never held as windows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                made = item_windows(text, size)
                while part := [w for _, w in zip(range(piece), made)]:
                    yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in part], pa.binary()), pa.array([n for _, n in part], pa.int32()),
                                                      pa.array([item] * len(part), pa.string())], names=["window", "words", "item"])

    rows = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")), F.col(text_col))
    held = rows.mapInArrow(run, "window binary, words int, item string")
    return held.groupBy("window").agg(F.min("words").alias("words"), F.sort_array(F.collect_set("item")).alias("items"))


class WuManber:
    """Search tables of test strings of similar length."""

    def __init__(self, patterns: list[bytes], block: int = 8):
        self.m = min(map(len, patterns))
        self.block = min(block, self.m, 8)
        self.mask = np.uint64((1 << 8 * self.block) - 1)
        slots = len(patterns) * (self.m - self.block + 1)
        self.bits = np.uint64(min(22, max(10, int(slots).bit_length() + 3)))
        heads = np.frombuffer(b"".join(p[:self.m] for p in patterns), np.uint8).reshape(len(patterns), self.m)
        default = self.m - self.block + 1
        self.shift = np.full(1 << int(self.bits), default, np.int32)
        for j in range(default):
            h = self._hash(self._load(heads[:, j:j + self.block]))
            np.minimum.at(self.shift, h, default - 1 - j)
        suffix = self._hash(self._load(heads[:, self.m - self.block:]))
        order = np.argsort(suffix, kind="stable")
        self.suffix = suffix[order]
        self.patterns = [patterns[i] for i in order]
        self.prefix = self._load(heads[order, :self.block])

    @staticmethod
    def _load(rows: np.ndarray) -> np.ndarray:
        wide = np.zeros((len(rows), 8), np.uint8)
        wide[:, :rows.shape[1]] = rows
        return wide.view("<u8").ravel()

    def _hash(self, w: np.ndarray) -> np.ndarray:
        return ((w * _MIX) >> (np.uint64(64) - self.bits)).astype(np.int64)

    def search(self, text: np.ndarray) -> Iterator[tuple[int, bytes]]:
        """(start, test string) of every occurrence in a byte array."""
        last = len(text) - self.m + 1
        if last <= 0:
            return
        padded = np.concatenate((text, np.zeros(8, np.uint8)))
        word = np.ndarray((len(text) + 1,), "<u8", padded.data, strides=(1,))
        pos = np.arange(0, last, LANE)
        end = np.minimum(pos + LANE, last)
        tail, hits = self.m - self.block, []
        while len(pos):
            step = self.shift[self._hash(word[pos + tail] & self.mask)]
            stop = step == 0
            if stop.any():
                hits.append(pos[stop])
            pos = pos + np.maximum(step, 1)
            on = pos < end
            if not on.all():
                pos, end = pos[on], end[on]
        if not hits:
            return
        at = np.concatenate(hits)
        h = self._hash(word[at + tail] & self.mask)
        lo, hi = np.searchsorted(self.suffix, h, "left"), np.searchsorted(self.suffix, h, "right")
        raw = text.tobytes()
        piece = 1 << 20
        total = np.concatenate(([0], np.cumsum(hi - lo)))
        begin = 0
        while begin < len(at):  # candidates in pieces of bounded size
            stop_at = max(begin + 1, int(np.searchsorted(total, total[begin] + piece, "right")) - 1)
            n = (hi - lo)[begin:stop_at]
            p = np.repeat(at[begin:stop_at], n)
            k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo[begin:stop_at], n)
            same = (word[p] & self.mask) == self.prefix[k]
            for s, i in zip(p[same].tolist(), k[same].tolist()):
                if raw.startswith(self.patterns[i], s):
                    yield s, self.patterns[i]
            begin = stop_at


def _tables(patterns, block: int) -> list[WuManber]:
    by_length: dict[int, list[bytes]] = {}
    for p in sorted(patterns):
        by_length.setdefault(min(len(p).bit_length(), 6), []).append(p)
    return [WuManber(ps, block) for ps in by_length.values()]


#: A Python worker's tables: those of the block it searched last.
_BUILT: dict[str, tuple] = {}


class Blocks:
    """The windows of a benchmark, written in blocks of about ``block_bytes``."""

    def __init__(self, benchmark: DataFrame, item_col: str = "item_id", item_text_col: str = "text", size: int = WINDOW,
                 block: int = 8, block_bytes: int = 32 << 20):
        found = written(windows(benchmark, item_col, item_text_col, size), "windows")
        # a row's bytes in a task: its window twice, the list of items, and their objects
        cost = F.octet_length("window") + 100 + F.aggregate("items", F.lit(0), lambda a, i: a + F.octet_length(i) + 60)
        total = found.agg(F.sum(cost.cast("bigint")).alias("b"), F.count(F.lit(1)).alias("n")).first()
        self.count = max(1, min(total["n"], -(-(total["b"] or 0) // block_bytes)))
        self.block = block
        # blocks by hash: alike in size; read one at a time from files sorted by block
        self.rows = found.withColumn("block", F.pmod(F.xxhash64("window"), F.lit(self.count)))
        if self.count > 1:
            self.rows = written(self.rows.repartitionByRange("block").sortWithinPartitions("block"), "blocks")

    def broadcast(self, i: int):
        """Block i as a broadcast: window -> (number of words, items)."""
        rows = self.rows.filter(F.col("block") == i).select("window", "words", "items").collect()
        return self.rows.sparkSession.sparkContext.broadcast({bytes(r["window"]): (r["words"], r["items"]) for r in rows})


def searcher(shared, block: int = 8):
    """A factory for ``map_texts``: per text its number of words, hit word spans
    (``[start, end)``, merged) and the ids of the items with occurring windows, sorted
    as strings, of one broadcast block."""
    table, name = byte_table(SEPARATORS), uuid.uuid4().hex

    def factory():
        if name not in _BUILT:
            _BUILT.clear()
            _BUILT[name] = shared.value, _tables(shared.value, block)
        known, searches = _BUILT[name]

        def scan(data: np.ndarray, off: np.ndarray):
            w = Words(data, off, table)
            marks = np.zeros(len(w.spaces) + 1, np.int32)
            found: dict[int, set[str]] = {}
            for t in searches:
                for at, p in t.search(w.flat):
                    word = int(np.searchsorted(w.spaces, at))
                    count, ids = known[p]
                    marks[word] += 1
                    marks[word + count] -= 1
                    found.setdefault(int(np.searchsorted(w.first, word, "right")) - 1, set()).update(ids)
            inside = np.cumsum(marks) > 0
            edge = np.diff(np.concatenate(([0], inside.astype(np.int8), [0])))
            starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
            spans: list[list[list[int]]] = [[] for _ in w.counts]
            for d, s, e in zip((np.searchsorted(w.first, starts, "right") - 1).tolist(), starts.tolist(), ends.tolist()):
                spans[d].append([s - int(w.first[d]), e - int(w.first[d])])
            return w.counts.tolist(), spans, [sorted(found.get(d, ())) for d in range(len(spans))]

        return scan

    return factory


_FOUND = [("n_words", pa.int64(), "bigint"), ("spans", pa.list_(pa.list_(pa.int64())), "array<array<bigint>>"),
          ("items", pa.list_(pa.string()), "array<string>")]


def _merged(spans):
    """Sorted spans ``[start, end)``, those that overlap or touch made one."""
    def add(done, s):
        last = F.element_at(done, -1)
        joined = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.array(last[0], F.greatest(last[1], s[1]))))
        return F.when((F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))[1] >= s[0]), joined).otherwise(F.concat(done, F.array(s)))

    return F.aggregate(F.sort_array(spans), F.array().cast("array<array<bigint>>"), add)


def _by_text(docs: DataFrame, text_col: str, blocks: Blocks) -> DataFrame:
    """(key, spans, items) of the texts with a hit in any block; key: the text's SHA-256."""
    parts = []
    for i in range(blocks.count):
        shared = blocks.broadcast(i)
        rows = docs.select(F.sha2(F.col(text_col), 256).alias("key"), F.col(text_col).alias("text"))
        hit = map_texts(rows, "text", searcher(shared, blocks.block), _FOUND, ["key"]).filter(F.size("spans") > 0)
        # equal texts, maybe a third of all rows, become one row before the shuffle
        parts.append(written(hit.groupBy("key").agg(F.first("spans").alias("spans"), F.first("items").alias("items")), "hits"))
        shared.destroy()
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    found = found.groupBy("key").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("items"))
    return found.select("key", _merged(F.col("spans")).alias("spans"), F.array_sort(F.array_distinct("items")).alias("items"))


def hits(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per document: its id, n_words, spans and items as ``searcher`` has them."""
    prepare(docs.sparkSession)
    blocks = Blocks(benchmark, **options)
    if blocks.count == 1:
        return map_texts(docs, text_col, searcher(blocks.broadcast(0), blocks.block), _FOUND, [id_col])
    found = written(_by_text(docs, text_col, blocks), "hits")
    table = byte_table(SEPARATORS)
    keyed = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.sha2(F.col(text_col), 256).alias("key"))
    counted = map_texts(keyed, "text", lambda: lambda data, off: [Words(data, off, table).counts.tolist()], _FOUND[:1], ["id", "key"])
    return counted.join(found, "key", "left").select(
        F.col("id").alias(id_col), "n_words", F.coalesce("spans", F.array().cast("array<array<bigint>>")).alias("spans"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def summary(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts and digest of ``hits``."""
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s[1] - s[0])
    return found.select(id_col, "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
                        (F.size("spans") > 0).alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The documents without a hit, with all their columns."""
    prepare(docs.sparkSession)
    blocks = Blocks(benchmark, **options)
    if blocks.count > 1:
        gone = written(_by_text(docs, text_col, blocks).select(F.col("key").alias("__gone")), "gone")
        # grows with the documents: never broadcast
        return docs.join(gone.hint("merge"), F.sha2(docs[text_col], 256) == F.col("__gone"), "left_anti")
    factory = searcher(blocks.broadcast(0), blocks.block)

    def keeper():
        scan = factory()
        return lambda data, off: [[not s for s in scan(data, off)[1]]]

    return filter_texts(docs, text_col, keeper)
