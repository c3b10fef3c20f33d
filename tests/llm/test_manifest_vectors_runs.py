"""The Merkle manifest, the vector join and the periodic runs against brute force, and
their defined results for nulls, empty and long texts, ties, repeated rows, empty tables
and clashing columns."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cadence.llm import merkle, runs, vectors
from cadence.llm import queries as q
from cadence.plans.check import duckdb_conn
from tests.conftest import SF001
from tests.llm.test_operators import TEXTS

DDL = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(*t, len(t[1] or "")) for t in TEXTS] + [(100 + i, f"Text {i} ABC", "en", "a", 9) for i in range(40)]
    return spark.createDataFrame(rows, DDL).withColumns(
        {"g": F.lit(1), "pos": F.lit("x"), "hash": F.lit(0), "path": F.lit(None).cast("string"), "at": F.lit(3), "runs": F.lit(1)})


@pytest.mark.parametrize("name", ["op11_merkle_manifest", "op12_embedding_near_duplicates", "op13_periodic_runs"])
def test_queries_match_their_sql(spark, name):
    made = q.QUERIES[name](spark, SF001)
    cols = sorted(made.columns)
    wanted = duckdb_conn(SF001).execute(f"SELECT {', '.join(cols)} FROM ({q.ORACLES[name]})").fetchall()
    assert Counter(map(tuple, made.select(*cols).collect())) == Counter(wanted)


# ---------------------------------------------------------------- op11
def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def frame(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def lower(s):
    return None if s is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in s)


def levels(nodes, fan):
    out = [nodes]
    while len(out[-1]) > 1:
        last = out[-1]
        out.append([sha("".join(last[i:i + fan])) for i in range(0, len(last), fan)])
    return out


def siblings(tree, pos, fan):
    out = []
    for level in tree[:-1]:
        lo = pos // fan * fan
        out.append(("".join(level[lo:pos]), "".join(level[pos + 1:lo + fan])))
        pos //= fan
    return out


def manifest_of(rows, fan):
    def leaf(r, text):
        return sha("".join(map(frame, (r["doc_id"], r["source"], r["lang"], r["n_chars"], text))))
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"]), r))
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: levels([x[2] for x in sorted(groups[g], key=lambda x: x[:3])], fan) for g in langs}
    top = levels([trees[g][-1][0] for g in langs], fan)
    out = Counter()
    for k, g in enumerate(langs):
        for pos, (has, i, old, r) in enumerate(sorted(groups[g], key=lambda x: x[:3])):
            path = siblings(trees[g], pos, fan) + siblings(top, k, fan)
            h = leaf(r, lower(r["text"])) if has and zlib.crc32(str(i).encode()) % 3 == 0 else old
            for left, right in path:
                h = sha(left + h + right)
            out[r["doc_id"], old, trees[g][-1][0], top[-1][0], "".join(a + b for a, b in path), h] += 1
    return out


@pytest.mark.parametrize("fan,depth", [(8, 3), (2, 1), (2, 2), (3, 3)])
def test_manifest_against_a_plain_tree(odd, monkeypatch, fan, depth):
    monkeypatch.setattr(merkle, "FAN", fan)
    monkeypatch.setattr(merkle, "LEVELS", depth)
    when = F.col("doc_id").isNotNull() & (F.crc32(F.col("doc_id").cast("string")) % 3 == 0)
    made = merkle.manifest(odd, changed={"text": merkle.lowered(F.col("text"))}, when=when)
    got = Counter(tuple(r) for r in made.select("doc_id", "leaf", "subroot", "root", "proof", "folded_root").collect())
    rows = odd.select("doc_id", "source", "lang", "n_chars", "text").collect()
    assert got == manifest_of(rows, fan)


def test_manifest_of_no_rows_and_of_one(spark):
    assert merkle.manifest(spark.createDataFrame([], DDL)).collect() == []
    one = merkle.manifest(spark.createDataFrame([(None, None, None, None, None)], DDL)).first()
    assert one["leaf"] == one["subroot"] == one["root"] == one["folded_root"] == sha("-----") and one["proof"] == ""


def test_a_changed_copy_fails_its_proof(odd):
    made = merkle.manifest(odd, changed={"source": F.lit("other")})
    assert made.filter("folded_root = root").isEmpty()
    assert made.count() == odd.count()


# ---------------------------------------------------------------- op12
VDDL = "vec_id bigint, embedding array<float>, label int"


def joined(rows, threshold=vectors.THRESHOLD):
    """n_links and component of every row, pair by pair."""
    ok = [r[2] is not None and r[1] and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1]) for r in rows]
    near = [[] for _ in rows]
    for a, x in enumerate(rows):
        for b, y in enumerate(rows[:a]):
            if ok[a] and ok[b] and x[2] == y[2] and len(x[1]) == len(y[1]):
                u, v = np.array(x[1], np.float64), np.array(y[1], np.float64)
                if u @ v / (np.linalg.norm(u) * np.linalg.norm(v)) >= threshold:
                    near[a].append(b), near[b].append(a)
    names = [None] * len(rows)
    for a in range(len(rows)):
        seen, todo = {a}, [a]
        while todo:
            for b in near[todo.pop()]:
                if b not in seen:
                    seen.add(b), todo.append(b)
        names[a] = min((rows[b][0] for b in seen if rows[b][0] is not None), default=None)
    return Counter((r[0], len(near[a]), names[a], r[0] == names[a]) for a, r in enumerate(rows))


def clustered(size, seed, n=150):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, size))
    out = []
    for i in range(n):
        c = centres[rng.integers(6)]
        # spread so that many pairs lie near the threshold, on both sides
        v = c + rng.normal(size=size) * np.linalg.norm(c) / np.sqrt(size) * rng.choice([0.03, 0.1, 0.14, 0.2])
        out.append((i, [float(x) for x in np.float32(v * rng.choice([0.01, 1, 100]))], int(rng.integers(2))))
    chain = rng.normal(size=(2, size))
    for i in range(30):   # each links with its neighbours only: one long component
        v = np.cos(i * 0.15) * chain[0] / np.linalg.norm(chain[0]) + np.sin(i * 0.15) * chain[1] / np.linalg.norm(chain[1])
        out.append((1000 + i, [float(x) for x in np.float32(v)], 1))
    return out


@pytest.mark.parametrize("size,per_cell,tile", [(64, 1024, 1024), (20, 4, 8), (9, 1, 16), (2, 2, 5), (64, 1, 10)])
def test_vector_links_against_all_pairs(spark, size, per_cell, tile):
    rows = clustered(size, size)
    made = vectors.near_duplicates(spark.createDataFrame(rows, VDDL), per_cell=per_cell, tile=tile)
    assert Counter(map(tuple, made.collect())) == joined(rows)


def test_vectors_that_cannot_link_and_copies(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 1), (3, [1.0, 0.0], 1), (4, [1.0, 0.0], 2), (5, [1.0, 0.0], None),
            (6, None, 1), (7, [], 1), (8, [0.0, 0.0], 1), (9, [1.0, None], 1), (10, [nan, 1.0], 1), (11, [inf, 1.0], 1),
            (12, [1.0, 0.0, 0.0], 1), (None, [1.0, 0.01], 1), (None, [0.0, 1.0], 1), (13, [-0.0, 1.0], 3), (14, [0.0, 1.0], 3),
            (15, [1e-38, 1e-38], 4), (16, [1e38, 1e38], 4)]
    df = spark.createDataFrame(rows, VDDL).withColumns({"cls": F.lit(1), "id": F.lit("x"), "n": F.lit(0), "rot": F.lit(1)})
    got = Counter(map(tuple, vectors.near_duplicates(df).collect()))
    assert got == Counter({k if k[0] is not None or k[2] is not None else (None, 0, None, True): n for k, n in joined(rows).items()})
    assert vectors.near_duplicates(spark.createDataFrame([], VDDL)).collect() == []
    texts = spark.createDataFrame([("b", [1.0, 2.0], "x"), ("a", [1.0, 2.0], "x")], "vec_id string, embedding array<double>, label string")
    assert sorted(map(tuple, vectors.near_duplicates(texts).collect())) == [("a", 1, "a", True), ("b", 1, "a", False)]


def test_a_vector_is_dealt_once(spark, monkeypatch):
    """Pairs of tiles read the table of tiles: no vector is shuffled a time for each cell or pair."""
    monkeypatch.setattr(vectors, "COMPARED", 50)
    rows = clustered(64, 5)
    df = spark.createDataFrame(rows, VDDL).select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), "label")
    classes = vectors.classes_of(df.withColumn("key", vectors.vector_key("vector")))
    tiles = vectors._tiles(classes, 10)
    total = tiles.agg(F.sum(F.octet_length("vector")), F.sum(F.octet_length("cls")), F.max(F.octet_length("cls"))).first()
    assert tuple(total)[:2] == (len(rows) * 64 * 4, len(rows) * 8) and total[2] < 30 * 8
    found = vectors.links(classes, per_cell=1, tile=10)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "Exchange" not in plan
    sizes = {r["cls"]: r["rep"] for r in classes.select("cls", "rep").collect()}
    counts = Counter()
    for r in found.collect():
        counts[sizes[r["a"]]] += r["n"]
    assert {k: n for k, n in counts.items() if n} == {k[0]: k[1] for k in joined(rows) if k[1]}


def test_a_group_keeps_a_pair_in_its_first_block_alone():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 32))
    x[100:] = x[:100] + rng.normal(size=(100, 32)) * 0.1
    u = vectors.unit(x)
    side = {"cls": np.arange(200), "unit": u, "rot": (u @ vectors.rotation(32)).astype(np.float32)}
    seen = Counter()
    for b in range(4):
        i, j = vectors.group_links(side, side, b, 0.98)
        seen.update(zip(i.tolist(), j.tolist()))
    s = u @ u.T
    wanted = {(int(a), int(b)) for a, b in zip(*np.nonzero(s >= 0.98)) if a != b}
    assert set(seen) == wanted and set(seen.values()) <= {1} and wanted


# ---------------------------------------------------------------- op13
def plain_runs(w, least=runs.MIN_LENGTH):
    out = []
    for p in range(1, len(w) // 2 + 1):
        i = 0
        while i + p < len(w):
            s = i
            while i + p < len(w) and w[i] == w[i + p]:
                i += 1
            n = i - s + p
            if i > s and n >= max(least, 2 * p) and not any(all(w[k] == w[k + d] for k in range(s, s + n - d)) for d in range(1, p)):
                out.append((s, n, p))
            i += i == s
    return sorted(out, key=lambda r: (r[0], r[2]))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 3), max_size=50), st.integers(2, 12))
def test_stretch_runs_against_brute_force(w, least):
    assert sorted(runs.stretch_runs(w, least)) == sorted(plain_runs(w, least))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=9), st.integers(1, 9), st.lists(st.sampled_from([b"a", b"d", b"e"]), max_size=20))
def test_text_runs_among_other_words(root, times, rest):
    words = [b"%d" % i for i in range(8)] + root * times + rest + root * times + [b"z%d" % i for i in range(8)]
    assert runs.text_runs(words) == plain_runs(words)


def test_extensions_of_the_tree():
    text = [1, 2, 1, 2, 1, 3, 1, 2, 1]
    tree = runs.SuffixTree(text)
    for a in range(len(text)):
        for b in range(len(text)):
            if a != b:
                n = 0
                while max(a, b) + n < len(text) and text[a + n] == text[b + n]:
                    n += 1
                assert tree.lce(np.array([a]), np.array([b]))[0] == n
    ranked = sorted(range(len(text) + 1), key=lambda i: text[i:] + [0])
    assert tree.suffixes.tolist() == ranked


def digest_of(key, text, planted):
    words = (text or "").encode().split()
    if planted:
        words = runs.replant(words, key)
    found = plain_runs(words)
    drop = {i for s, n, p in found for i in range(s + p, s + n)}
    listed = "".join(f"{s},{n},{p}\n" for s, n, p in found)
    best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None,) * 3
    return (len(found), *best, 1000 * best[1] // best[2] if found else None, sha(listed),
            hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in drop)).hexdigest())


@pytest.mark.parametrize("planted", [False, True])
def test_digests_of_odd_texts(spark, planted):
    texts = [t for t in TEXTS if t[0] != 8] + [(20, "la " * 400 + "di da " * 300 + "end", "en", "a"), (0, "x y z " * 9, "en", "a"),
                                                (21, "tab\tnew\nline\x0bfeed\x0cback\rnbsp  " * 5, "en", "a")]
    df = spark.createDataFrame([(t[0], t[1]) for t in texts], "doc_id bigint, text string").withColumns({"runs": F.lit(1), "__key": F.lit("k"), "start": F.lit(2)})
    got = Counter(map(tuple, runs.digests(df, planted=planted).collect()))
    assert got == Counter((t[0], *digest_of(None if t[0] is None else str(t[0]), t[1], planted)) for t in texts)


def test_planted_repetition():
    words = [b"%d" % i for i in range(50)]
    for key in range(200):
        h = zlib.crc32(str(key).encode())
        got = runs.replant(words, str(key))
        if h % 10:
            assert got == words
        else:
            g = h // 10
            a = g % 50
            p = 1 + (50 - a) // (3 + g % 8)
            assert got == [words[i] if i < a else words[a + (i - a) % p] for i in range(50)]
    assert runs.replant(words, None) == words and runs.replant([], "0") == []


def test_long_text_runs_and_collapse(spark):
    text = " ".join(f"w{i}" for i in range(30000)) + " " + "one two three " * 20000 + "end"
    df = spark.createDataFrame([(1, text), (2, None), (3, "")], "doc_id bigint, text string")
    got = {r["doc_id"]: [tuple(x) for x in r["runs"]] for r in runs.find(df).collect()}
    assert got == {1: [(30000, 60000, 3)], 2: [], 3: []}
    kept = {r["doc_id"]: r["collapsed"] for r in runs.collapse(df).collect()}
    assert kept == {1: " ".join(f"w{i}" for i in range(30000)) + " one two three end", 2: "", 3: ""}
    assert runs.digests(df.limit(0)).collect() == []
