"""The registered queries: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_FOLD = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP8_SQL = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_FOLD.format("coalesce(text, '')")}, '{_WORD}') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_FOLD.format("coalesce(text, '')")}, '{_WORD}') AS w FROM benchmark),
pat AS (SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS p
        FROM (SELECT item, w, least(len(w), 10) AS n, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM pat),
win AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS p
        FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, sizes WHERE len(w) >= n)),
occ AS (SELECT doc_id, item, win.n AS n, i FROM win JOIN pat ON win.n = pat.n AND win.p = pat.p),
hit AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS k FROM occ) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS s FROM (SELECT DISTINCT doc_id, item FROM occ) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(s, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
"""


@query("op8_benchmark_decontamination", OP8_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hit words and items of every whole document, by Wu-Manber search."""
    from cadence.llm import decontam
    found = decontam.hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontam.summary(found)


@query("op10_simhash_near_duplicates")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every whole document."""
    from cadence.llm import simhash
    from pyspark.sql import functions as F
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex16(F.col("fp")).alias("fingerprint"), "component_id")


OP7_SQL = r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT source, source_size, source_size * 2.0::DOUBLE AS cap,
             [5.0, 2.0, 1.0][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)]::DOUBLE AS w FROM s),
b AS (SELECT *, sum(source_size) OVER () * 1.5::DOUBLE AS total, sum(w) OVER () AS ws,
             coalesce(sum(cap) OVER o, 0) AS cb, coalesce(sum(w) OVER o, 0) AS wb FROM w
      WINDOW o AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
c AS (SELECT *, (total - cb) / (ws - wb) * w >= cap AS capped FROM b),
l AS (SELECT *, (total - sum(CASE WHEN capped THEN cap ELSE 0 END) OVER ())
                / nullif(ws - sum(CASE WHEN capped THEN w ELSE 0 END) OVER (), 0) AS level FROM c),
t AS (SELECT source, source_size, CASE WHEN capped THEN cap ELSE least(cap, level * w) END AS target,
             CAST(CAST(('0x' || substr(md5('42:' || coalesce('s:' || source, 'null')), 1, 5)) AS BIGINT) AS DOUBLE) / 1048576 AS u FROM l),
r AS (SELECT d.doc_id, d.size, t.source_size, t.target, t.u, coalesce(t.target / nullif(t.source_size, 0), 0) AS e,
             row_number() OVER (PARTITION BY d.source ORDER BY d.size, d.doc_id NULLS LAST) AS i
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, size * least(CAST(floor(e * i + u) - floor(e * (i - 1) + u) AS BIGINT), 2) AS taken FROM r
"""


@query("op7_source_mixing", OP7_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document, by systematic sampling."""
    from cadence.llm import mixing
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


OP3_SQL = """
WITH p AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first_id FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first_id IS NULL OR page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM f
"""


@query("op3_warc_round_trip", OP3_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes a record per page, reads the archives back and reports every record."""
    from cadence.llm import warc
    from pyspark.sql import functions as F
    pages = table(spark, sf_dir, "pages")
    kind = pages.schema["page_id"].dataType
    manifest = warc.write_archives(pages, warc.shared_folder(spark))
    got = warc.read_archives(manifest)
    return got.select(F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                      F.col("refers_to").cast(kind).alias("refers_to"))


@query("op4_language_id")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole document; learnt on documents whose crc32(doc_id) mod 3
    is not 1."""
    from cadence.llm import langid
    from cadence.llm.common import id_hash
    from pyspark.sql import functions as F
    docs = table(spark, sf_dir, "documents")
    held_out = id_hash(F.col("doc_id")) % 3 == 1
    model = langid.learn(docs, ~held_out)
    got = langid.predict(docs.select("doc_id", "text"), model)
    return got.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query("op5_toxicity")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole document; learnt on labels whose crc32(doc_id) mod 5 is
    not 0."""
    from cadence.llm import toxicity
    from cadence.llm.common import id_hash
    from pyspark.sql import functions as F
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = id_hash(F.col("doc_id")) % 5 == 0
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"), ~held_out)
    got = toxicity.score(docs, model)
    return got.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op9_quality")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every whole document; learnt on labels whose crc32(doc_id) mod 5 is
    not 0."""
    from cadence.llm import quality
    from cadence.llm.common import id_hash
    from pyspark.sql import functions as F
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    held_out = id_hash(F.col("doc_id")) % 5 == 0
    model = quality.learn(docs, table(spark, sf_dir, "labels"), ~held_out, meta=["n_chars"])
    got = quality.score(docs, model)
    return got.select("doc_id", held_out.alias("held_out"), "score",
                      (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


@query("op1_order_minhash")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order MinHash fingerprints of every whole document and of its edited text."""
    from cadence.llm import omh
    return omh.fingerprints(table(spark, sf_dir, "documents"))


@query("op6_token_counts")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pre-tokens and unigram tokens of every whole document."""
    from cadence.llm import tokens
    return tokens.count_tokens(table(spark, sf_dir, "documents"))


def tool_messages(conversations: DataFrame) -> DataFrame:
    """Stand-in messages: an assistant turn becomes a call, the turn after it a tool
    result; arguments (the whole text, null: empty) and dependencies are made of the
    row's own columns: a call waits for the one two turns before it (a chain through the
    whole conversation) and for the one at half its turn."""
    from cadence.llm.chat import CALLS
    from pyspark.sql import functions as F
    text = F.coalesce(F.col("text"), F.lit(""))
    name = F.element_at(F.array(F.lit("search"), F.lit("translate"), F.lit("lookup")), F.length(text) % 3 + 1)
    call_id = F.concat(F.lit("call-"), F.col("turn").cast("string"))
    arguments = F.to_json(F.struct(text.alias("query"), (F.length(text) % 120).alias("limit")))
    before = [F.concat(F.lit("call-"), x.cast("string")) for x in (F.col("turn") - 2, F.floor(F.col("turn") / 2))]
    deps = F.when(F.col("turn") > 2, F.array(*before)).when(F.col("turn") > 1, F.array(before[1])).otherwise(F.array().cast("array<string>"))
    call = F.struct(call_id.alias("id"), name.alias("name"), arguments.alias("arguments"), deps.alias("depends_on"))
    is_call = F.col("role") == "assistant"
    return conversations.select(
        "conv_id", "turn", F.when(is_call, F.col("role")).otherwise("tool").alias("role"), F.col("text").alias("content"),
        F.when(is_call, F.array(call)).cast(CALLS).alias("calls"),
        F.when(~is_call, F.concat(F.lit("call-"), (F.col("turn") - 1).cast("string"))).alias("tool_call_id"))


TOOLS = [
    ("search", '{"type":"object","properties":{"query":{"type":"string","minLength":1},"limit":{"type":"integer","minimum":1,"maximum":100}},'
               '"required":["query","limit"],"additionalProperties":false}'),
    ("translate", '{"type":"object","properties":{"query":{"type":"string","maxLength":1000},"limit":{"type":"integer"}},"required":["query"]}'),
]


@query("op2_tool_call_linking")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls and results of all conversations: linked, ordered, validated, serialised."""
    from cadence.llm import chat
    messages = tool_messages(table(spark, sf_dir, "conversations"))
    return chat.link(messages, spark.createDataFrame(TOOLS, "name string, schema string"))


def crc32_sql(value: str) -> str:
    """crc32 of an integer's decimal text, bit by bit (a step of 0 or more also adds the
    next byte)."""
    step = "CASE WHEN xor(a, greatest(b, 0)) & 1 = 1 THEN xor(xor(a, greatest(b, 0)) >> 1, 3988292384) ELSE xor(a, greatest(b, 0)) >> 1 END"
    return (f"xor(list_reduce(flatten(list_transform(string_split(CAST({value} AS VARCHAR), ''), "
            "lambda c: list_concat([CAST(ascii(c) AS BIGINT)], [-1::BIGINT, -1, -1, -1, -1, -1, -1]))), "
            f"lambda a, b: {step}, 4294967295::BIGINT), 4294967295::BIGINT)")


_FRAME = "CASE WHEN {0} IS NULL THEN '-' ELSE concat(strlen(CAST({0} AS VARCHAR)), ':', CAST({0} AS VARCHAR)) END"


def _leaf_sql(text: str) -> str:
    return "sha256(concat(" + ", ".join(_FRAME.format(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + "))"


OP11_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, CASE WHEN lang IS NULL THEN '' ELSE '=' || lang END AS g, {_leaf_sql("text")} AS leaf,
    {_leaf_sql("low")} AS seen, {crc32_sql("doc_id")} % 3 = 0 AS changed FROM (SELECT *, {_FOLD.format("text")} AS low FROM documents)),
n AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n FROM d),
lang_level AS (
  SELECT 0 AS lvl, g, n, pos, leaf AS h FROM n
  UNION ALL
  SELECT lvl + 1, g, (n + 7) // 8, pos // 8, sha256(string_agg(h, '' ORDER BY pos)) FROM lang_level WHERE n > 1 GROUP BY lvl, g, n, pos // 8),
sub AS (SELECT g, h AS subroot, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS n, lvl FROM lang_level WHERE n = 1),
top_level AS (
  SELECT 0 AS lvl, n, pos, subroot AS h FROM sub
  UNION ALL
  SELECT lvl + 1, (n + 7) // 8, pos // 8, sha256(string_agg(h, '' ORDER BY pos)) FROM top_level WHERE n > 1 GROUP BY lvl, n, pos // 8),
root AS (SELECT h AS root FROM top_level WHERE n = 1),
lang_runs AS (SELECT lvl, g, pos // 8 AS run, list(h ORDER BY pos) AS hs FROM lang_level WHERE n > 1 GROUP BY ALL),
top_runs AS (SELECT lvl, pos // 8 AS run, list(h ORDER BY pos) AS hs FROM top_level WHERE n > 1 GROUP BY ALL),
steps AS (
  SELECT n.doc_id, n.leaf, n.g, n.pos, r.lvl AS k, r.hs, (n.pos // CAST(pow(8, r.lvl) AS BIGINT)) % 8 AS j
  FROM n JOIN lang_runs r ON r.g = n.g AND r.run = n.pos // CAST(pow(8, r.lvl + 1) AS BIGINT)
  UNION ALL
  SELECT n.doc_id, n.leaf, n.g, n.pos, 1000 + r.lvl, r.hs, (s.pos // CAST(pow(8, r.lvl) AS BIGINT)) % 8
  FROM n JOIN sub s ON s.g = n.g JOIN top_runs r ON r.run = s.pos // CAST(pow(8, r.lvl + 1) AS BIGINT)),
paths AS (SELECT g, pos, list([array_to_string(hs[1:j], ''), array_to_string(hs[j + 2:], '')] ORDER BY k) AS p FROM steps GROUP BY g, pos),
f AS (SELECT n.doc_id, n.leaf, s.subroot, root.root, coalesce(paths.p, []) AS p, CASE WHEN n.changed THEN n.seen ELSE n.leaf END AS start
      FROM n JOIN sub s ON s.g = n.g CROSS JOIN root LEFT JOIN paths ON paths.g = n.g AND paths.pos = n.pos),
o AS (SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(p, lambda x: concat(x[1], x[2])), '')) AS proof_sha256,
             list_reduce(list_concat([['', start, '']], list_transform(p, lambda x: [x[1], '', x[2]])),
                         lambda a, b: ['', sha256(concat(b[1], a[2], b[3])), ''])[2] AS folded_root FROM f)
SELECT *, folded_root = root AS verified FROM o
"""


@query("op11_merkle_manifest", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaves, roots and proofs of all documents, and every third proof folded again from
    a text in lower case."""
    from cadence.llm import merkle
    from cadence.llm.common import id_hash
    from pyspark.sql import functions as F
    docs = table(spark, sf_dir, "documents").select(*merkle.FIELDS)
    got = merkle.manifest(docs, changed={"text": merkle.lowered(F.col("text"))}, when=F.col("doc_id").isNotNull() & (id_hash(F.col("doc_id")) % 3 == 0))
    return got.select("doc_id", "leaf", "subroot", "root", merkle.sha(F.col("proof")).alias("proof_sha256"), "folded_root",
                      (F.col("folded_root") == F.col("root")).alias("verified"))


OP13_SQL = rf"""
WITH c AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, {crc32_sql("doc_id")} AS h FROM documents),
e AS (SELECT *, len(w) AS n, h // 10 AS g, (h // 10) % nullif(len(w), 0) AS a FROM c),
p AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM e),
t AS (SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN w[1:a] || flatten(list_transform(range(0, (n - a) // p), lambda k: w[a + 1:a + p]))
             || w[a + 1:a + (n - a) % p] ELSE w END AS w FROM p),
gr AS (SELECT doc_id, i, array_to_string(w[i + 1:i + 6], ' ') AS gram FROM (SELECT doc_id, w, unnest(range(0, n - 5)) AS i FROM t WHERE n >= 12)),
pairs AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM gr x JOIN gr y ON x.doc_id = y.doc_id AND x.gram = y.gram AND x.i < y.i),
isl AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS grp FROM pairs),
cand AS (SELECT doc_id, q, min(i) AS s, max(i) + 6 + q - min(i) AS len FROM isl GROUP BY doc_id, q, grp),
runs AS (SELECT doc_id, s, len, min(q) AS q FROM cand WHERE len >= greatest(12, 2 * q) GROUP BY doc_id, s, len),
lists AS (SELECT doc_id, count(*) AS n_runs, string_agg(concat(s, ',', len, ',', q, chr(10)), '' ORDER BY s, q) AS txt,
                 list([s, len, q] ORDER BY len DESC, s, q)[1] AS top FROM runs GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + len)) AS i FROM runs),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS txt FROM
         (SELECT doc_id, unnest(w) AS word, unnest(range(0, n)) AS i FROM t WHERE doc_id IN (SELECT doc_id FROM runs)) x
         ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT t.doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(top[1] AS BIGINT) AS start, CAST(top[2] AS BIGINT) AS length,
       CAST(top[3] AS BIGINT) AS period, CAST(1000 * top[2] // top[3] AS BIGINT) AS exponent_milli,
       sha256(coalesce(l.txt, '')) AS runs_sha256, sha256(CASE WHEN n_runs IS NULL THEN array_to_string(t.w, ' ') ELSE coalesce(kept.txt, '') END) AS collapsed_sha256
FROM t LEFT JOIN lists l USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


@query("op13_periodic_runs", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of every whole document, with the contract's planted
    repetition."""
    from cadence.llm import runs
    return runs.digests(table(spark, sf_dir, "documents"), planted=True)


OP12_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.e) = len(y.e)
         WHERE list_cosine_similarity(x.e, y.e) >= 0.98),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
comp AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
cnt AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT e.vec_id, CAST(coalesce(cnt.n, 0) AS BIGINT) AS n_links, comp.component_id, comp.component_id = e.vec_id AS kept
FROM embeddings e JOIN comp ON comp.a = e.vec_id LEFT JOIN cnt ON cnt.a = e.vec_id
"""


@query("op12_embedding_near_duplicates", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors, by the subspace pigeonhole join."""
    from cadence.llm import vectors
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))
