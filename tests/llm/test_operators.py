"""The operators against brute force, round trips and held-out accuracy, and their
defined results for nulls, empty and long texts, ties, repeated rows, empty tables and
clashing columns."""

import hashlib
import io
import json
import re
import struct
import zlib

import pytest
import xxhash
from pyspark.sql import functions as F

from cadence.llm import chat, decontam, langid, mixing, omh, quality, simhash, tokens, toxicity, warc
from cadence.llm import queries as q
from cadence.llm.common import bucket_of, written
from tests.conftest import SF001

M64 = (1 << 64) - 1
DDL = "doc_id bigint, text string, lang string, source string, n_chars bigint"
TEXTS = [
    (1, "The cat sat on the mat and the cat ran off to the hills again", "en", "a"),
    (2, "The cat sat on the mat and the cat ran off to the hills again", "en", "a"),
    (3, "Der Hund lief über die Straße und der Hund bellte", "de", "b"),
    (4, None, None, None),
    (5, "", "en", "a"),
    (6, "  \n\t ", "en", None),
    (7, "12 34 -- 56", "en", "b"),
    (8, "word " * 30000 + "\U0001F600 end", "en", "a"),
    (None, "no id here at all", "en", "b"),
    (9, "short", "en", "c"),
    (9, "short", "en", "c"),
    (10, "x" * 5000, "de", "c"),
]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty, long, repeated and extra, oddly named columns."""
    return spark.createDataFrame([(*t, len(t[1] or "")) for t in TEXTS], DDL).withColumns(
        {"size": F.lit(1), "n_words": F.lit("x"), "__bucket": F.lit(0), "score": F.lit(None).cast("string"), "rep": F.lit(3)})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DDL)


def rows_of(df):
    return [tuple(r) for r in df.collect()]


# ---------------------------------------------------------------- op1
def hash_long(x, seed):
    return xxhash.xxh64_intdigest(struct.pack("<Q", x & M64), seed)


def hash_int(i, seed):
    """XXH64 of a 4-byte integer."""
    return xxhash.xxh64_intdigest(struct.pack("<i", i), seed)


def signature(text):
    t = re.findall(r"[^ \t\n\x0b\f\r]{1,16}", text or "")
    if not t:
        return [0] * omh.SLOTS
    low, seen, u = (1 << 24) - 1, {}, []
    for i in range(max(1, len(t) - omh.K + 1)):
        h = 42
        for w in t[i:i + omh.K]:
            h = xxhash.xxh64_intdigest(w.encode(), h)
        a = h & ~low & M64
        seen[a] = seen.get(a, -1) + 1
        u.append((hash_int(seen[a], hash_long(a, 42)) & ~low & M64) | i)

    def signed(v):
        return v - (1 << 64) if v >> 63 else v

    u.sort(key=signed)
    out = []
    for j in range(omh.SLOTS):
        edge = (j - omh.SLOTS // 2) << 59
        at = sum(signed(v) < edge for v in u)
        h = 42
        for v in sorted((u[(at + x) % len(u)] for x in range(min(omh.LENGTH, len(u)))), key=lambda v: v & low):
            h = hash_long(v >> 24, h)
        out.append(h & 0xFFFFFFFF)
    return out


def expected_op1(rows):
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    sig = [signature(t) for _, t in rows]
    out = []
    for k, (i, t) in enumerate(rows):
        t, n = t or "", (k + 1) % len(rows)
        cut = len(t) // 4
        e = t[:len(t) - cut] + (rows[n][1] or "")[:cut]
        es = signature(e)
        near = [sum(a == b for a, b in zip(sig[k], s)) / omh.SLOTS for s in (es, sig[n])]
        out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), "".join(f"{v:08x}" for v in sig[k]),
                    "".join(f"{v:08x}" for v in es), *near))
    return out


def by_repr(rows):
    return sorted(map(repr, rows))


def test_order_minhash_against_brute_force(spark, odd):
    assert by_repr(rows_of(omh.fingerprints(odd))) == by_repr(expected_op1([t[:2] for t in TEXTS]))


def test_order_minhash_on_a_table(spark):
    docs = q.table(spark, SF001, "documents")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert by_repr(rows_of(q.QUERIES["op1_order_minhash"](spark, SF001))) == by_repr(expected_op1(rows))


def test_order_minhash_empty_single_and_native(spark, empty):
    assert rows_of(omh.fingerprints(empty)) == []
    one = omh.fingerprints(spark.createDataFrame([(1, "abcd efgh")], "doc_id bigint, text string"))
    assert rows_of(one)[0][1:3] == (9, hashlib.sha256(b"abcd efab").hexdigest())
    plan = one._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_order_minhash_is_the_same_on_both_sides_of_the_size_switch(spark, odd):
    docs = odd.select("doc_id", "text")
    want = [(t[0], signature(t[1])) for t in TEXTS]
    for packed in (1, 8, 1 << 24):
        assert by_repr((r[0], r[2]) for r in map(tuple, omh.signature(docs, "text", "sig", packed=packed).collect())) == by_repr(want)


# ---------------------------------------------------------------- op2
def test_violations():
    schema = {"type": "object", "required": ["a"], "additionalProperties": False,
              "properties": {"a": {"type": "integer", "minimum": 1}, "b": {"type": "array", "items": {"enum": ["x"]}, "maxItems": 1}}}
    assert chat.violations({"a": 1}, schema) == []
    assert chat.violations({"a": True}, schema) == ["$.a: not integer"]
    assert chat.violations({"a": 0, "b": ["x", "y"], "c": 1}, schema) == [
        "$.a: below minimum", "$.b: too long", "$.b[1]: not in enum", "$.c: unknown"]
    assert chat.check('{"a":1,"a":2}', "{}")[1] == ["arguments: not JSON"]
    assert chat.check("NaN", "{}")[1] == ["arguments: not JSON"]
    assert chat.check(None, "{}")[1] == ["arguments: not JSON"]
    assert chat.canonical({"b": "ü", "a": [1, None]}) == '{"a":[1,null],"b":"ü"}'


def test_bad_calls_and_schemas_are_errors_of_their_row(spark):
    bad = {'{"q":1e999}': "arguments: number out of range", '{"q":' + "9" * 400 + "}": "arguments: number out of range",
           '{"q":"\\ud800"}': "arguments: lone surrogate", '{"\\udfff":1}': "arguments: lone surrogate", "{": "arguments: not JSON",
           "[" * 100000: "arguments: not JSON", '{"q":NaN}': "arguments: not JSON", '{"q":' + "9" * 5000 + "}": "arguments: not JSON"}
    for text, error in bad.items():
        assert chat.check(text, "{}") == (text, [error])
    assert chat.check('{"a":1}', "true")[1] == [] and chat.check('{"a":1}', "false")[1] == ["$: nothing fits"]
    assert chat.check('{"a":1}', "{")[1] == ["tool: schema: not JSON"] and chat.check("{}", "7")[1] == ["tool: schema #: not an object"]
    assert chat.check('{"a":1}', '{"properties":{"a":{"pattern":"x"}},"anyOf":[]}')[1] == [
        "tool: schema #: anyOf is not supported", "tool: schema #/a: pattern is not supported"]
    for schema in ('{"type":7}', '{"required":5}', '{"properties":[]}', '{"minimum":"x"}', '{"enum":1}', '{"items":3}', '{"type":"text"}'):
        assert chat.check('{"a":1}', schema)[1]
    assert chat.check('{"a":1}', '{"title":"t","description":"d","properties":{"a":true}}')[1] == []
    one, yes = '{"properties":{"a":{"enum":[1]}}}', '{"properties":{"a":{"const":true}}}'
    assert chat.check('{"a":true}', one)[1] == ["$.a: not in enum"] and chat.check('{"a":1.0}', one)[1] == []
    assert chat.check('{"a":1}', yes)[1] == ["$.a: not const"] and chat.check('{"a":true}', yes)[1] == []
    forms = ["1", "1.0", "1e0", "10e-1"], ["1e25", "1" + "0" * 25], ["0", "-0.0", "0e5"], ["0.1", "1e-1", "0.10"]
    for same in forms:
        assert len({chat.canonical(json.loads(x)) for x in same}) == 1
    calls = [("c%d" % i, "t%d" % (i % 3), text, []) for i, text in enumerate(bad)]
    messages = spark.createDataFrame([(1, 1, "assistant", "", calls, None)],
                                     f"conv_id bigint, turn bigint, role string, content string, calls {chat.CALLS}, tool_call_id string")
    tools = spark.createDataFrame([("t0", "true"), ("t1", "no json"), ("t2", None)], "name string, schema string")
    got = {r["call_id"]: (r["valid"], r["errors"], json.loads(r["canonical"])["arguments"]) for r in chat.link(messages, tools).collect()}
    assert got == {"c%d" % i: (False, e, t) for i, (t, e) in enumerate(bad.items())}


def test_tool_calls_link_order_and_cycles(spark):
    def call(i, deps=(), args='{"q":1}', name="t"):
        return (i, name, args, list(deps))

    schema = f"conv_id bigint, turn bigint, role string, content string, calls {chat.CALLS}, tool_call_id string, extra int"
    messages = spark.createDataFrame([
        (1, 1, "assistant", "", [call("a", ["b"]), call("b")], None, 0),
        (1, 2, "tool", "second", None, "a", 0), (1, 3, "tool", "late", None, "a", 0),
        (1, 4, "assistant", "", [call("c", ["a", "gone"]), call("x", ["y"]), call("y", ["x"]), call("z", ["y"])], None, 0),
        (1, 5, "tool", "lost", None, "nobody", 0),
        (2, 1, "assistant", "", [call("a", args="[]"), call("a", name="other"), call(None)], None, 0),
        (2, 2, "tool", "r", None, "a", 0), (None, 3, "tool", None, None, "a", 0), (3, 1, "user", "hi", None, None, 0),
    ], schema)
    tools = spark.createDataFrame([("t", '{"type":"object"}')], "name string, schema string")
    got = {}
    for r in chat.link(messages, tools).collect():
        got.setdefault((r["conv_id"], r["call_id"]), []).append(r)
    one = {k[1]: (v[0]["level"], v[0]["position"], v[0]["status"], v[0]["n_results"], v[0]["errors"]) for k, v in got.items() if k[0] == 1}
    assert one == {"b": (0, 1, "unanswered", 0, ""), "a": (1, 2, "linked", 2, ""), "c": (2, 3, "unanswered", 0, "depends_on: unknown gone"),
                   "x": (None, 4, "unanswered", 0, "depends_on: cycle"), "y": (None, 5, "unanswered", 0, "depends_on: cycle"),
                   "z": (None, 6, "unanswered", 0, "depends_on: cycle"), "nobody": (None, None, "orphan", 1, "call: missing")}
    assert json.loads(got[1, "a"][0]["canonical"])["result"] == "second"
    twice = sorted((r["position"], r["status"], r["errors"]) for r in got[2, "a"])
    assert [t[1] for t in twice] == ["linked"] * 2 and {t[2] for t in twice} == {"arguments: not an object", "tool: unknown"}
    assert got[2, None][0]["status"] == "unanswered" and got[None, "a"][0]["status"] == "orphan"
    assert chat.link(messages.limit(0), tools).count() == 0


def test_levels_against_longest_chains(spark):
    import random
    rng = random.Random(7)
    nodes, edges = [], []
    for conv in range(30):
        n = rng.randint(1, 14)
        names = [f"n{i}" for i in range(n)]
        nodes += [(conv, x) for x in names]
        for i in range(n):   # mostly backwards, sometimes forwards, so that cycles come up
            for j in {rng.randrange(n) for _ in range(rng.choice([0, 1, 1, 2, 3]))}:
                if j < i or j > i and rng.random() < 0.1:
                    edges.append((conv, names[i], names[j]))
    for conv, n in ((100, 70), (101, 3), (102, 64), (103, 7)):   # chains, a loop of three, of seven, and one's own
        nodes += [(conv, f"n{i}") for i in range(n)]
        edges += [(conv, f"n{i}", f"n{i - 1}") for i in range(1, n)]
    edges += [(101, "n0", "n2"), (103, "n0", "n6"), (102, "n63", "n0"), (100, "n69", "n69")]
    below = {}
    for c, a, b in edges:
        below.setdefault((c, a), []).append((c, b))

    def depth(x, above=()):
        if x in above:
            return None
        got = [depth(y, (*above, x)) for y in below.get(x, ())]
        return None if None in got else 1 + max(got, default=-1)
    got = {(r["conv"], r["id"]): r["level"] for r in chat.levels(
        spark.createDataFrame(nodes, "conv int, id string"), spark.createDataFrame(edges, "conv int, id string, dep string")).collect()}
    assert got == {x: depth(x) for x in nodes}
    assert got[100, "n68"] == 68 and got[102, "n63"] == 63 and {got[101, "n1"], got[103, "n3"], got[100, "n69"]} == {None}


def test_tool_query_keeps_every_call(spark):
    conv = q.table(spark, SF001, "conversations")
    got = q.QUERIES["op2_tool_call_linking"](spark, SF001)
    assert got.filter("status <> 'orphan'").count() == conv.filter("role = 'assistant'").count()
    assert got.filter("level is null and status <> 'orphan'").count() == 0


def test_tool_query_arguments_hold_whole_texts(spark):
    conv = q.table(spark, SF001, "conversations")
    want = {(r["conv_id"], r["turn"]): r["text"] or "" for r in conv.filter("role = 'assistant'").collect()}
    rows = q.QUERIES["op2_tool_call_linking"](spark, SF001).filter("status <> 'orphan'").collect()
    assert {(r["conv_id"], r["turn"]): json.loads(r["canonical"])["arguments"]["query"] for r in rows} == want
    assert max(map(len, want.values())) > 1000
    for r in rows:  # the schema's bound is one of whole texts
        if r["name"] == "translate":
            assert ("$.query: too long" in r["errors"]) == (len(want[r["conv_id"], r["turn"]]) > 1000)
    odd = spark.createDataFrame([(1, 1, "assistant", None)], "conv_id bigint, turn bigint, role string, text string")
    call = q.tool_messages(odd).first()["calls"][0]
    assert call["name"] == "search" and json.loads(call["arguments"]) == {"query": "", "limit": 0}


# ---------------------------------------------------------------- op3
def round_trip(pages):
    return warc.read_archives(warc.write_archives(pages, warc.shared_folder(pages.sparkSession), archive_bytes=2000), True)


def test_warc_round_trip_and_revisits(spark):
    long = "é" * 200000
    pages = spark.createDataFrame([(3, "http://a b\n", "x" * 100), (1, None, "x" * 100), (2, "u", "x" * 99), (4, "u", "x" * 99),
                                   (5, "u", None), (6, "u", long), (7, "u", "a\r\n\r\nb"), (None, "u", "x" * 100), (8, "u", long),
                                   (8, "u", long)], "page_id int, url string, html string").withColumn("digest", F.lit("?"))
    got = sorted((r["page_id"] or "", r["record_type"], r["refers_to"], r["payload_bytes"],
                  r["payload"].decode() if r["record_type"] == "response" else None) for r in round_trip(pages).collect())
    assert got == sorted([("1", "response", None, 100, "x" * 100), ("3", "revisit", "1", 100, None), ("", "revisit", "1", 100, None),
                          ("2", "response", None, 99, "x" * 99), ("4", "response", None, 99, "x" * 99), ("5", "response", None, 0, ""),
                          ("6", "response", None, 400000, long), ("7", "response", None, 6, "a\r\n\r\nb"),
                          ("8", "revisit", "6", 400000, None), ("8", "revisit", "6", 400000, None)], key=lambda r: r)
    assert round_trip(pages.limit(0)).count() == 0


def test_warc_archives_are_plain_gzip_members(spark, tmp_path):
    pages = spark.createDataFrame([(f"a b/%{i}", "u", "x" * (90 + i // 2)) for i in range(40)] + [("é", None, "x" * 100), (None, "u", "")],
                                  "page_id string, url string, html string")
    manifest = warc.write_archives(pages, f"file://{tmp_path}/made", archive_bytes=3000)
    listed = manifest.collect()
    assert len(listed) > 3 and sum(r["records"] for r in listed) == 42
    for r in listed:
        with open(r["path"].removeprefix("file://"), "rb") as f:
            data = f.read()
        assert len(data) == r["bytes"]
        n = 0
        while data:   # every member is one whole record
            one = zlib.decompressobj(31)
            text = one.decompress(data) + one.flush()
            assert one.eof and text.startswith(b"WARC/1.1\r\n") and text.count(b"WARC-Type:") == 1 and text.endswith(b"\r\n\r\n")
            data, n = one.unused_data, n + 1
        assert n == r["records"]
    got = warc.read_archives(manifest).collect()
    assert sorted(r["page_id"] or "" for r in got) == sorted(r["page_id"] or "" for r in pages.collect())
    assert {r["refers_to"] for r in got if r["record_type"] == "revisit"} <= {r["page_id"] for r in got if r["record_type"] == "response"}
    # an archive cut at a member's end, and one whose responses are gone
    path = listed[0]["path"].removeprefix("file://")
    with open(path, "rb") as f:
        whole = f.read()
    one = zlib.decompressobj(31)
    one.decompress(whole)
    with open(path, "wb") as f:
        f.write(whole[:len(whole) - len(one.unused_data)])
    with pytest.raises(Exception, match="the manifest has"):
        warc.read_archives(manifest).count()
    lone = warc.member(warc.record("2", "u", b"x" * 100, hashlib.sha256(b"x" * 100).hexdigest(), "1"))
    with open(tmp_path / "lone.warc.gz", "wb") as f:
        f.write(lone)
    alone = spark.createDataFrame([(f"file://{tmp_path}/lone.warc.gz", 1, len(lone))], "path string, records bigint, bytes bigint")
    with pytest.raises(warc.WarcError, match="which a revisit names"):
        warc.read_archives(alone)


def test_warc_reader_finds_faults():
    digest = hashlib.sha256(b"payload").hexdigest()
    rec = warc.record("1", "u", b"payload", digest, None)
    good = warc.member(rec) + warc.member(warc.record("2", "u", b"payload", digest, "1"))
    for block in (1, 7, 1 << 16):
        got = list(warc.read_records(io.BytesIO(good), block=block))
        assert [(r["page_id"], r["record_type"], r["payload_bytes"]) for r in got] == [("1", "response", 7), ("2", "revisit", 7)]
    bad = [good[:-3], warc.member(rec[:-1]), warc.member(rec + b"x"), warc.member(rec + rec), warc.member(rec.replace(b"payload", b"PAYLOAD")),
           good + b"junk", warc.member(rec.replace(b"Content-Length: 7", b"Content-Length: 8"))]
    bad += [warc.member(rec.replace(b"WARC-Type: response", b"WARC-Kind: response")), warc.member(rec.replace(b"WARC-Date", b"WARC-\xffate")),
            warc.member(warc.record("2", "u", b"payload", digest, "1").replace(b"Payload-Length: 7", b"Payload-Length: x"))]
    for data in bad:
        with pytest.raises(warc.WarcError):
            list(warc.read_records(io.BytesIO(data), "archive"))
    assert zlib.decompressobj(31).decompress(good) == rec  # one member, one record


# ---------------------------------------------------------------- op4
def test_language_accuracy_and_null_texts(spark, odd, empty):
    got = q.QUERIES["op4_language_id"](spark, SF001).join(q.table(spark, SF001, "documents"), "doc_id").filter("held_out")
    assert got.filter("lang = lang_pred").count() >= 0.97 * got.count()
    model = langid.learn(odd)
    assert model[0] == ["de", "en"]
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.predict(odd, model).collect()}
    assert all(found[i] == ("und", 0.0) for i in (4, 5, 6, 7)) and found[1][0] == "en" and found[3][0] == "de"
    assert found == {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.predict(odd.repartition(5), model).collect()}
    kept = langid.keep(odd, model)
    assert kept.columns == odd.columns and {r["doc_id"] for r in kept.collect()} >= {1, 2, 3, 8, 9, None}
    none = langid.learn(empty)
    assert none[0] == [] and langid.predict(odd, none).filter("lang_pred <> 'und'").count() == 0
    assert langid.keep(odd, none).count() == 8 and langid.predict(empty, none).count() == 0


def test_language_vector_is_the_bundle_of_bound_letters():
    import numpy as np
    enc = langid.Encoder(dims=64)
    text = "Abc ab".encode()
    vec, n = enc.encode(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    seq = [0, *map(ord, "abc"), 0, *map(ord, "ab"), 0]
    brute = sum(np.roll(enc.letter(a), 2) * np.roll(enc.letter(b), 1) * enc.letter(c) for a, b, c in zip(seq, seq[1:], seq[2:]))
    assert n.tolist() == [6] and (vec[0] == brute).all()


# ---------------------------------------------------------------- op5, op9
def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


@pytest.fixture(scope="module")
def taught(spark):
    """Half of the texts insult; half are junk."""
    words = ["river", "stone", "green", "walk", "house", "light"]
    docs, labels = [], []
    for i in range(160):
        body = " ".join(words[(i * 7 + k * k) % 6] for k in range(20 + i % 9))
        bad, junk = i % 2, (i // 2) % 2
        docs.append((i, body + (" you blorgnak" if bad else " you friend") + (" ### $$$ %%%" * 20 if junk else "."), "en", "s", 10))
        labels.append((i, 1 - junk, bad))
    return spark.createDataFrame(docs, DDL), labels_of(spark, [*labels, *labels[:3], (999, 1, 1), (None, 0, 1), (5, None, None)])


def accuracy(scored, labels, target, threshold):
    rows = scored.join(labels, "doc_id").filter(F.col(target).isNotNull() & (F.col("doc_id") % 5 == 0)).collect()
    return sum((r["score"] >= threshold) == bool(r[target]) for r in rows) / len(rows)


def test_toxicity_learns_and_handles_odd_rows(spark, taught, odd, empty):
    docs, labels = taught
    model = toxicity.learn(docs, labels, F.col("doc_id") % 5 != 0)
    assert accuracy(toxicity.score(docs, model), labels, "toxic", 0.5) == 1.0
    scored = [tuple(r) for r in toxicity.score(odd, model).collect()]
    assert len(scored) == len(TEXTS) and all(0 <= s <= 1 for _, s in scored)
    assert toxicity.score(empty, model).count() == 0
    never = toxicity.learn(docs, labels.limit(0), F.lit(True))
    assert toxicity.score(docs, never).filter("score > 0.001").count() == 0


def test_toxicity_ngrams_stay_inside_their_text():
    import numpy as np
    texts = ["abc d", "", "é", "abcd"]
    enc = [t.encode() for t in texts]
    off = np.concatenate(([0], np.cumsum([len(e) for e in enc])))
    doc, f = toxicity.present(np.frombuffer(b"".join(enc), np.uint8), off, (4, 5), 18)
    got = {i: set(f[doc == i].tolist()) for i in range(4)}
    for i, t in enumerate(texts):
        alone = toxicity.present(np.frombuffer(enc[i], np.uint8), np.array([0, len(enc[i])]), (4, 5), 18)[1]
        assert got[i] == set(alone.tolist())
    assert [len(got[i]) for i in range(4)] == [4 + 3, 0, 0, 3 + 2]


def test_quality_learns_and_identity_holds(spark, taught, odd, empty):
    import numpy as np
    docs, labels = taught
    model = quality.learn(docs, labels, F.col("doc_id") % 5 != 0, meta=["n_chars"])
    assert accuracy(quality.score(docs, model), labels, "quality", 0.3) == 1.0
    kept = quality.keep(docs, model)
    assert kept.columns == docs.columns and 75 <= kept.count() <= 85
    scored = [tuple(r) for r in quality.score(odd, model).collect()]
    assert len(scored) == len(TEXTS) and all(0 <= s <= 1 for _, s in scored)
    assert quality.keep(odd, model).columns == odd.columns and quality.score(empty, model).count() == 0
    assert quality.keep(docs, quality.learn(docs, labels.limit(0), F.lit(True))).count() == docs.count()
    rng = np.random.default_rng(1)
    w, v, f, x = rng.normal(size=9), rng.normal(size=(9, 3)), np.array([1, 4, 7, 2]), rng.normal(size=4)
    brute = 0.5 + (w[f] * x).sum() + sum(v[f[a]] @ v[f[b]] * x[a] * x[b] for a in range(4) for b in range(a))
    assert quality.machine(np.array([0, 4]), f, x, 0.5, w, v)[0] == pytest.approx(brute)


# ---------------------------------------------------------------- op6
def test_token_counts_against_plain_viterbi(spark, odd, empty):
    scores = tokens.load_scores()
    byte = min(scores.values()) - tokens.BYTE_PENALTY

    def plain(word):
        word = tokens.MARK + word
        best = [(0.0, 0)]
        for e in range(1, len(word) + 1):
            found = [(best[b][0] + scores[word[b:e]], best[b][1] + 1) for b in range(max(0, e - 40), e) if word[b:e] in scores]
            if word[e - 1] not in scores:
                n = len(word[e - 1].encode())
                found.append((best[e - 1][0] + n * byte, best[e - 1][1] + n))
            best.append(min(found, key=lambda p: (-p[0], p[1])))
        return best[-1][1]

    def expected(text):
        own = (text or "").encode().split()
        memo = {w: plain(w.decode()) for w in set(own)}
        return len(own), sum(memo[w] for w in own)

    for nodes in (10, tokens.MAX_NODES):
        got = rows_of(tokens.count_tokens(odd, max_nodes=nodes))
        assert by_repr(got) == by_repr([(i, *expected(t)) for i, t, *_ in TEXTS])
    docs = q.table(spark, SF001, "documents").select("doc_id", "text")
    assert by_repr(rows_of(tokens.count_tokens(docs))) == by_repr([(r[0], *expected(r[1])) for r in docs.collect()])
    assert tokens.count_tokens(empty).count() == 0


def test_a_trie_never_outgrows_its_bound():
    scores = tokens.load_scores()
    free, tight = tokens.TrieCounts(scores), tokens.TrieCounts(scores, max_nodes=1000)
    words = [("naïveté" * 30000).encode(), "日本語の文章".encode() * 5000, b"ab" * 40000, b"short", b"just" * 130, *(b"w%d" % i for i in range(3000)), ("naïveté" * 30000 + "x").encode()]
    for w in words * 2:
        assert tight[w] == free[w]
        assert len(tight.score) <= 1001 and len(tight.child) <= 1001 and len(tight) <= 1001
    assert len(free.score) > 200000


# ---------------------------------------------------------------- op7
def test_targets_fill_to_the_cap(spark):
    sources = spark.createDataFrame([("a", 100), ("b", 10), ("c", 1000), (None, 0)], "source string, source_size bigint")
    got = {r["source"]: r["target"] for r in mixing.targets(sources).collect()}
    assert got["a"] == 200.0 and got["b"] == 20.0 and got["c"] == pytest.approx(1.5 * 1110 - 220) and got[None] == 0.0


def test_mix_of_odd_rows(spark, odd, empty):
    got = mixing.mix(odd).collect()
    assert len(got) == len(TEXTS) and all(r["taken"] <= 2 * r["size"] for r in got)
    emitted = mixing.emit(odd)
    assert emitted.columns == [*odd.columns, "copy"]
    assert emitted.count() == sum(r["copies"] for r in got)
    assert mixing.mix(empty).count() == 0 and mixing.emit(empty).count() == 0
    assert by_repr(rows_of(mixing.mix(odd.repartition(7)))) == by_repr(tuple(r) for r in got)


def test_taken_words_come_near_targets(spark):
    sf = SF001.replace("0.001", "0.01")
    got = q.QUERIES["op7_source_mixing"](spark, sf).join(q.table(spark, sf, "documents").select("doc_id", "source"), "doc_id")
    got = got.groupBy("source").agg(F.sum("taken").alias("t"), F.max("size").alias("longest"), F.first("target").alias("target"))
    for r in got.collect():
        assert abs(r["t"] - r["target"]) <= max(r["longest"], 0.1 * r["target"]), r


def test_buckets_ascend(spark):
    x = spark.range(-5, 30).withColumn("id", F.when(F.col("id") == -5, None).otherwise(F.col("id")))
    cuts = [0, 3, 7, 7.5, 20]
    for r in x.select("id", bucket_of(F.col("id"), cuts).alias("b")).collect():
        assert r["b"] == (6 if r["id"] is None else sum(c <= r["id"] for c in cuts))


# ---------------------------------------------------------------- op8
def test_decontamination_against_brute_force(spark, odd, empty):
    bench = spark.createDataFrame([(1, "The CAT sat, on the mat and the cat ran"), (2, "short"), (3, None), (4, "--"), (5, "word " * 12),
                                   (20, "Short!"), (6, "über die straße")], "item_id int, text string").withColumn("doc_id", F.lit(0))

    def words(t):
        fold = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", fold)

    def expected(text):
        w, hit, items = words(text), set(), set()
        for r in bench.collect():
            own = words(r["text"])
            for i in range(max(1, len(own) - 9) if own else 0):
                part = own[i:i + 10]
                for at in range(len(w) - len(part) + 1):
                    if w[at:at + len(part)] == part:
                        hit |= set(range(at, at + len(part)))
                        items.add(str(r["item_id"]))
        return len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit)

    want = by_repr((i, *expected(t)) for i, t, *_ in TEXTS)
    assert by_repr(rows_of(decontam.summary(decontam.hits(odd, bench)))) == want
    assert by_repr(rows_of(decontam.summary(decontam.hits(odd, bench, block_bytes=1)))) == want  # a block per item
    kept = decontam.clean(odd, bench)
    assert kept.columns == odd.columns and kept.count() == sum("True)" not in w for w in want)
    assert decontam.hits(empty, bench).count() == 0 and decontam.clean(odd, bench.limit(0)).count() == len(TEXTS)


# ---------------------------------------------------------------- op10
def expected_components(rows):
    prints, nodes = [], {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        h = [xxhash.xxh64_intdigest(" ".join(w[k:k + 3]).encode(), 42) for k in range(max(1, len(w) - 2))] if w else []
        fp = sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in h) > len(h))
        prints.append((i, fp))
        nodes[i] = i
    changed = True
    while changed:
        changed = False
        for a, fa in prints:
            for b, fb in prints:
                if a is not None and b is not None and (fa ^ fb).bit_count() <= 3 and nodes[a] > nodes[b]:
                    nodes[a], changed = nodes[b], True
    return [(i, f"{fp:016x}", nodes[i] if i is not None else None) for i, fp in prints]


def test_simhash_against_brute_force(spark, odd, empty):
    got = simhash.near_duplicates(odd).select("doc_id", simhash.hex16(F.col("fp")), "component_id")
    assert by_repr(rows_of(got)) == by_repr(expected_components([t[:2] for t in TEXTS]))
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns and sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 3, 4, 7, 8, 9, 10]
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_one(empty).count() == 0


def test_links_lose_no_pair(spark):
    import random
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(12)]
    prints = {b for x in base for b in [x, *(x ^ sum(1 << p for p in rng.sample(range(64), rng.randint(1, 6))) for _ in range(25))]}
    prints = sorted(prints)
    df = spark.createDataFrame([(i, p - (1 << 64) if p >> 63 else p) for i, p in enumerate(prints)], "rep bigint, fp bigint")
    for bits in (0, 1, 3, 5):
        want = {(a, b) for a in range(len(prints)) for b in range(a + 1, len(prints)) if (prints[a] ^ prints[b]).bit_count() <= bits}
        assert set(rows_of(simhash.links(df, bits))) == want
    with pytest.raises(ValueError):
        simhash.links(df, 6)


def test_links_and_components_are_never_broadcast(spark):
    """A class is 16 bytes but 36 rows of the join: Spark would size either side too low."""
    base = 0x0123456789ABCDEF
    classes = written(spark.createDataFrame([(i, base ^ (1 << i) ^ (i << 40)) for i in range(40)], "rep bigint, fp bigint"), "classes")
    found = simhash.links(classes, 3)
    want = {(a, b) for a in range(40) for b in range(a + 1, 40)
            if bin((base ^ (1 << a) ^ (a << 40)) ^ (base ^ (1 << b) ^ (b << 40))).count("1") <= 3}
    assert {tuple(r) for r in found.collect()} == want and want
    docs = spark.createDataFrame([(i, f"one two three four {i % 3}") for i in range(9)], "doc_id bigint, text string")
    near = simhash.near_duplicates(docs)
    near.collect()
    for df in (found, near):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_pipeline_near_dedup_is_never_broadcast(spark):
    docs = spark.createDataFrame([(i // 2, f"one two three four {i % 3}") for i in range(12)], "doc_id bigint, text string")
    import corpus_pipeline as cp
    kept = cp.near_dedup(spark, docs, SF001)
    assert sorted(r["doc_id"] for r in kept.collect()) == [0]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_components_of_long_chains(spark):
    pairs = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 90), (90, 80)], "a bigint, b bigint")
    got = dict(rows_of(simhash.components(pairs)))
    assert got == {**{i: 0 for i in range(1, 61)}, 90: 80, 100: 80}


# ---------------------------------------------------------------- pipeline
def test_pipeline_stages_against_their_operators(spark):
    import corpus_pipeline as cp
    docs = q.table(spark, SF001, "documents")
    names = [n for n, _ in cp.STAGES]
    assert names == ["language_id", "quality_filter", "near_dedup", "decontaminate", "mix_sources"]
    by = {}
    for name, stage in cp.STAGES:
        out = written(stage(spark, docs, SF001), "test")
        by[name] = (docs, out)
        assert out.columns == docs.columns + (["copy"] if name == "mix_sources" else [])
        docs = out
    before, after = by["near_dedup"]
    want = expected_components([(r["doc_id"], r["text"]) for r in before.collect()])
    assert {r["doc_id"] for r in after.collect()} == {c for _, _, c in want}
    before, after = by["decontaminate"]
    marked = decontam.summary(decontam.hits(before, q.table(spark, SF001, "benchmark")))
    assert {r["doc_id"] for r in after.collect()} == {r["doc_id"] for r in marked.filter("not contaminated").collect()}
    before, after = by["mix_sources"]
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(before).filter("copies > 0").collect()}
    assert {r["doc_id"]: r["n"] for r in after.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).collect()} == copies
    assert cp.run(spark, SF001).count() == after.count()


def test_pipeline_stages_against_plain_scores_and_sql(spark):
    import corpus_pipeline as cp
    import duckdb
    import numpy as np
    import pandas as pd
    docs, by = q.table(spark, SF001, "documents"), {}
    for name, stage in cp.STAGES:
        out = written(stage(spark, docs, SF001), "test")
        by[name] = (docs, out)
        docs = out

    def ids(df):
        return sorted(r["doc_id"] for r in df.select("doc_id").collect())

    # language: every text alone, its vector a plain sum over its n-grams
    before, after = by["language_id"]
    langs, protos = langid.learn(before, F.crc32(F.col("doc_id").cast("string")) % 3 != 1)
    enc, want = langid.Encoder(), []
    for r in before.select("doc_id", "text").collect():
        points = [int(x) for x in langid.letter_sequence(np.frombuffer((r["text"] or "").encode(), np.uint8),
                                                         np.array([0, len((r["text"] or "").encode())]))[0]]
        grams = [tuple(points[i:i + 3]) for i in range(len(points) - 2)] or ([tuple(points)] if len(points) > 1 else [])
        if not grams:
            continue
        if len(points) < 3:
            grams = [tuple(points + [0] * (3 - len(points)))]
        seen = {}
        for g in grams:
            seen[g] = seen.get(g, 0) + 1
        v = sum(n * enc.gram_vector(list(g)).astype(float) for g, n in seen.items())
        if max(protos @ v / np.linalg.norm(v)) >= langid.MIN_SCORE:
            want.append(r["doc_id"])
    assert ids(after) == sorted(want)

    # quality: every text alone, all pairs of its features multiplied out
    before, after = by["quality_filter"]
    m = quality.learn(before, q.table(spark, SF001, "labels"), F.crc32(F.col("doc_id").cast("string")) % 5 != 0, meta=["n_chars"])
    want = []
    for r in before.select("doc_id", "text", "n_chars").collect():
        data = np.frombuffer((r["text"] or "").encode(), np.uint8)
        _, f, x = quality._rows(data, np.array([0, len(data)]), np.array([[float(r["n_chars"])]]), m.bits)
        v = m.factors[f].astype(float) * x[:, None]
        z = m.bias + (m.weights[f].astype(float) * x).sum() + np.triu(v @ v.T, 1).sum()
        if 1 / (1 + np.exp(-z)) >= quality.THRESHOLD:
            want.append(r["doc_id"])
    assert ids(after) == sorted(want)

    # the last two: their SQL over their own input
    def run_sql(sql, docs):
        con = duckdb.connect()
        con.register("documents", docs.select("doc_id", "text", "source").toPandas())
        con.register("benchmark", pd.read_parquet(f"{SF001}/benchmark.parquet"))
        return con.execute(sql).df()

    before, after = by["decontaminate"]
    got = run_sql(q.OP8_SQL, before)
    assert ids(after) == sorted(got[~got.contaminated].doc_id)
    before, after = by["mix_sources"]
    got = run_sql(q.OP7_SQL, before)
    n = after.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).collect()
    copies = {int(i): int(t // s) for i, s, t in zip(got.doc_id, got["size"], got.taken) if s and t}
    sizes = {int(i) for i, s in zip(got.doc_id, got["size"]) if s}
    assert {r["doc_id"]: r["n"] for r in n if r["doc_id"] in sizes} == copies


# ---------------------------------------------------------------- long texts
LONG = ["the quick brown fox JUMPS\tover 12 dogs \U0001F600 über straße 中文字 " * 40, "中文字符" * 300, "x" * 900, "1 2 3 " * 200 + "a",
        "word " * 300 + "y" * 700 + " tail", " " * 800, "a" + " " * 800 + "b", "é1ß" * 250]


def test_stretches_of_a_long_text_give_the_whole_texts_result(monkeypatch):
    import numpy as np
    for text in LONG:
        data = np.frombuffer(text.encode(), np.uint8)
        off = np.array([0, len(data)])
        whole = langid.Encoder().encode(data, off)
        print_of = simhash.simhash(data, off)
        assert int(print_of[0]) == int(expected_components([(1, text)])[0][1], 16)
        for stretch in (1, 7, 64, 257):
            assert simhash.simhash(data, off, stretch=stretch) == print_of, (text[:20], stretch)
            monkeypatch.setattr(langid, "STRETCH", stretch)
            cut = langid.Encoder().encode(data, off)
            monkeypatch.undo()
            assert cut[1] == whole[1] and (cut[0] == whole[0]).all(), (text[:20], stretch)
        for gram in (1, 2, 5):
            whole = langid.Encoder(gram=gram).encode(data, off)
            monkeypatch.setattr(langid, "STRETCH", 50)
            cut = langid.Encoder(gram=gram).encode(data, off)
            monkeypatch.undo()
            assert cut[1] == whole[1] and (cut[0] == whole[0]).all(), (text[:20], gram)
        whole = toxicity.present(data, off, (4, 5), 18)
        for stretch in (1, 9, 300):
            monkeypatch.setattr(toxicity, "STRETCH", stretch)
            cut = toxicity.present(data, off, (4, 5), 18)
            monkeypatch.undo()
            assert [a.tolist() for a in cut] == [a.tolist() for a in whole], (text[:20], stretch)
