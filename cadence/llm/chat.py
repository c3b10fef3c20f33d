"""Chat formatting: links tool calls to results, orders them, validates arguments and
serialises canonical JSON.

Messages have conv_id, turn, role, content, calls (array of id, name, arguments,
depends_on) and tool_call_id (of role ``tool``). Results are first reduced to one row
per conversation and identifier (the earliest; how many there were stays known), so the
hash join of calls with results yields one row per call whatever a key repeats.

Order: a call comes after the calls it depends on; its level is the longest chain of
dependencies below it. Levels are found by rounds over all conversations at once. A round
takes away the dependencies that have a level (Kahn) and, for every dependency that waits
for one call itself, jumps over it to that call (pointer doubling), so a chain of calls
takes as many rounds as its length has binary digits; other graphs take at most a round
per call with several open dependencies on their longest path. Each round's two tables
are written to the shared checkpoint folder. What lies on or behind a cycle has no level:
it comes back to itself, its chain outgrows the longest conversation, or nothing moves. A call's position in its conversation is its place by (level, turn, place
in the message, identifier), calls without level last. Positions are counted in buckets
of (conversation, level, turn range), so one conversation with a third of all rows is
spread over tasks.

A call is valid if its tool is known and its arguments are a JSON object, without
repeated names, that fits the tool's schema: ``true``, ``false`` or an object of type,
enum, const, properties, required, additionalProperties, items, minimum, maximum,
minLength, maxLength, minItems, maxItems and annotations. A schema with another keyword
is not held to fit: the keyword is named as an error, as are schemas that are no JSON or
malformed, numbers beyond a double and lone surrogates; none of them stops the job. The
canonical JSON has sorted names, no blanks, no escapes but those that JSON demands, and
one form per number: digits for whole numbers below 10^21, else the shortest text of the
double. In enum and const 1, 1.0 and 1e0 are equal; 1 and true are not.

Status: linked, unanswered, or orphan for a result without call (one row per identifier,
without position). Null conversations or identifiers never link: such calls are
unanswered, such results orphans, each row its own. Dependencies on unknown calls are
listed as errors and don't hold a call back; repeated calls of one identifier share
level and result and keep a row each. Empty inputs give empty results. Other columns
are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from cadence.llm.common import bucket_of, ordered_bounds, prepare, written
from cadence.session import scratch_path

CALLS = "array<struct<id:string,name:string,arguments:string,depends_on:array<string>>>"
_TYPES = {"string": str, "object": dict, "array": list, "boolean": bool, "null": type(None)}


def _is(value, kind: str) -> bool:
    if kind in ("integer", "number"):
        whole = isinstance(value, int) or isinstance(value, float) and value.is_integer()
        return not isinstance(value, bool) and (whole if kind == "integer" else isinstance(value, (int, float)))
    return kind in _TYPES and isinstance(value, _TYPES[kind])


#: Keywords that state nothing about a value.
_NOTES = frozenset("$schema $id $comment title description default examples format deprecated readOnly writeOnly".split())
_BOUNDS = frozenset("minimum maximum minLength maxLength minItems maxItems".split())
_KNOWN = _NOTES | _BOUNDS | frozenset("type enum const properties required additionalProperties items".split())


def misuse(schema, at: str = "#") -> list[str]:
    """What of a schema can't be checked here: unknown keywords and malformed values."""
    if isinstance(schema, bool):
        return []
    if not isinstance(schema, dict):
        return [f"schema {at}: not an object"]
    found = [f"schema {at}: {k} is not supported" for k in schema if k not in _KNOWN]

    def need(name: str, ok: bool) -> None:
        if not ok:
            found.append(f"schema {at}: {name} is malformed")
    kinds = schema.get("type", [])
    kinds = [kinds] if isinstance(kinds, str) else kinds
    need("type", isinstance(kinds, list) and all(isinstance(k, str) and (k in _TYPES or k in ("integer", "number")) for k in kinds))
    need("enum", isinstance(schema.get("enum", []), list))
    required = schema.get("required", [])
    need("required", isinstance(required, list) and all(isinstance(k, str) for k in required))
    for k in _BOUNDS & schema.keys():
        need(k, _is(schema[k], "number"))
    inner = schema.get("properties", {})
    need("properties", isinstance(inner, dict))
    parts = list(inner.items()) if isinstance(inner, dict) else []
    parts += [(k, schema[k]) for k in ("items", "additionalProperties") if k in schema]
    for k, part in parts:
        found += misuse(part, f"{at}/{k}")
    return found


def same(a, b) -> bool:
    """Equality of JSON values: numbers by value, never equal to a boolean."""
    return canonical(a) == canonical(b)


def violations(value, schema, at: str = "$") -> list[str]:
    """What of a schema without ``misuse`` the value breaks."""
    if isinstance(schema, bool):
        return [] if schema else [f"{at}: nothing fits"]
    kinds = schema.get("type")
    if kinds is not None and not any(_is(value, k) for k in ([kinds] if isinstance(kinds, str) else kinds)):
        return [f"{at}: not {kinds}"]
    found = []
    if "enum" in schema and not any(same(value, x) for x in schema["enum"]):
        found.append(f"{at}: not in enum")
    if "const" in schema and not same(value, schema["const"]):
        found.append(f"{at}: not const")
    if _is(value, "number"):
        found += [f"{at}: below minimum"] * (value < schema.get("minimum", value))
        found += [f"{at}: above maximum"] * (value > schema.get("maximum", value))
    for kind, least, most in ((str, "minLength", "maxLength"), (list, "minItems", "maxItems")):
        if isinstance(value, kind):
            found += [f"{at}: too short"] * (len(value) < schema.get(least, 0))
            found += [f"{at}: too long"] * (len(value) > schema.get(most, len(value)))
    if isinstance(value, dict):
        known = schema.get("properties", {})
        found += [f"{at}.{k}: missing" for k in schema.get("required", []) if k not in value]
        more = schema.get("additionalProperties", True)
        for k, v in value.items():
            if k in known:
                found += violations(v, known[k], f"{at}.{k}")
            elif more is False:
                found.append(f"{at}.{k}: unknown")
            else:
                found += violations(v, more, f"{at}.{k}")
    if isinstance(value, list) and "items" in schema:
        for i, v in enumerate(value):
            found += violations(v, schema["items"], f"{at}[{i}]")
    return found


def _no_repeats(pairs: list) -> dict:
    made = dict(pairs)
    if len(made) != len(pairs):
        raise ValueError("repeated name")
    return made


def _no_constant(name: str):
    raise ValueError(f"{name} is no JSON number")


def _finite(text: str) -> float:
    value = float(text)
    if value in (float("inf"), float("-inf")):
        raise OverflowError(text[:40])
    return value


def _one_form(value):
    """Numbers as they are written: whole ones below 10^21 as integers, others as doubles."""
    if isinstance(value, dict):
        return {k: _one_form(v) for k, v in value.items()}
    if isinstance(value, list):
        return [_one_form(v) for v in value]
    if isinstance(value, bool) or not isinstance(value, (int, float)):
        return value
    if abs(value) >= 10 ** 21:
        return float(value)
    return int(value) if value == int(value) else value


def canonical(value) -> str:
    return json.dumps(_one_form(value), sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def _parsed(text: str | None):
    """The value of a JSON text; ValueError says why there is none."""
    try:
        value = json.loads(text or "", object_pairs_hook=_no_repeats, parse_constant=_no_constant, parse_float=_finite)
        canonical(value).encode()
    except OverflowError:
        raise ValueError("number out of range") from None
    except UnicodeEncodeError:
        raise ValueError("lone surrogate") from None
    except (ValueError, RecursionError):
        raise ValueError("not JSON") from None
    return value


def check(arguments: str | None, schema: str | None) -> tuple[object, list[str]]:
    """(parsed arguments or the text as it is, errors)."""
    try:
        value = _parsed(arguments)
    except ValueError as e:
        return arguments, [f"arguments: {e}"]
    if schema is None:
        return value, ["tool: unknown"]
    try:
        rules = _parsed(schema)
    except ValueError as e:
        return value, [f"tool: schema: {e}"]
    wrong = [f"tool: {x}" for x in misuse(rules)]
    if not isinstance(value, dict):
        return value, [*wrong, "arguments: not an object"]
    return value, wrong or violations(value, rules)


def levels(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(conv, id, level) of distinct nodes; edges (conv, id, dep) are distinct and
    between nodes. Nodes on or behind a cycle have null."""
    key = ["conv", "id"]

    def waits(edges: DataFrame) -> DataFrame:
        """Open edges of a node, and the one edge of those that have one."""
        return edges.groupBy(*key).agg(F.count(F.lit(1)).alias("k"), F.min("dep").alias("next"), F.min("w").alias("far"))

    spark = nodes.sparkSession
    longest = nodes.groupBy("conv").count().agg(F.max("count")).first()[0] or 0
    edges = written(edges.select("conv", "id", "dep", F.lit(1).cast("bigint").alias("w")), "edges")
    state = nodes.join(waits(edges), key, "left").select(
        *key, F.lit(0).cast("bigint").alias("floor"), F.lit(False).alias("lost"), F.coalesce("k", F.lit(0)).alias("k"), "next", "far")
    # a round's nodes: those still open after the one before, some of which it settled
    folder, rounds, before = scratch_path(spark, "levels"), 0, None
    schema = state.schema
    while True:
        state.write.parquet(f"{folder}/round={rounds}")
        state = spark.read.schema(schema).parquet(f"{folder}/round={rounds}")
        now = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("w").cast("decimal(38,0)")).alias("w")).first()
        if not now["n"] or now == before:
            settled = F.col("lost") | (F.col("k") == 0)
            return spark.read.schema(StructType([*schema, StructField("round", IntegerType())])).parquet(folder).filter(settled | (F.col("round") == rounds)).select(
                *key, F.when(settled & ~F.col("lost"), F.col("floor")).cast("int").alias("level"))
        before, rounds = now, rounds + 1
        dep = state.select("conv", F.col("id").alias("dep"), F.col("floor").alias("d_floor"), F.col("lost").alias("d_lost"),
                           F.col("k").alias("d_k"), "next", "far")
        # a call whose only dependency is settled is settled next, and not jumped over
        ready = state.filter("lost or k = 0").select("conv", F.col("id").alias("next"), F.lit(True).alias("ready"))
        met = edges.join(dep.join(ready, ["conv", "next"], "left"), ["conv", "dep"])
        known, jumps = F.col("d_lost") | (F.col("d_k") == 0), (F.col("d_k") == 1) & F.col("ready").isNull()
        to = F.when(jumps, F.col("next")).otherwise(F.col("dep"))
        w = F.when(jumps, F.col("w") + F.col("far")).otherwise(F.col("w"))
        moved = met.select(*key, to.alias("dep"), w.alias("w"), (~known).alias("open"),
                           F.when(known | jumps, F.col("d_floor") + F.col("w")).alias("floor"),
                           (F.col("d_lost") | ~known & ((to == F.col("id")) | (w > longest))).alias("lost"))
        moved = written(moved, "moved")
        news = moved.groupBy(*key).agg(F.max("floor").alias("n_floor"), F.max("lost").alias("n_lost"))
        gone = news.filter("n_lost").select(*key)
        edges = written(moved.filter("open").groupBy(*key, "dep").agg(F.max("w").alias("w")).join(gone, key, "left_anti").select(
            *key, "dep", "w"), "edges")
        state = state.filter("k > 0 and not lost").select(*key, "floor").join(news, key, "left").join(waits(edges), key, "left").select(
            *key, F.greatest("floor", F.coalesce("n_floor", F.lit(0))).alias("floor"), F.coalesce("n_lost", F.lit(False)).alias("lost"),
            F.coalesce("k", F.lit(0)).alias("k"), "next", "far")


def link(messages: DataFrame, tools: DataFrame) -> DataFrame:
    """One row per call and per orphan identifier: conv_id, call_id, turn, name, status,
    n_results, level, position, valid, errors, canonical. ``tools`` has name and schema
    (JSON text), one row a name (the smallest schema of a repeated name counts)."""
    spark = messages.sparkSession
    prepare(spark)
    calls = written(messages.select(F.col("conv_id").alias("conv"), "turn", F.posexplode("calls").alias("nth", "c")).select(
        "conv", "turn", "nth", F.col("c.id").alias("id"), F.col("c.name").alias("name"), F.col("c.arguments").alias("arguments"),
        F.array_distinct(F.coalesce("c.depends_on", F.array().cast("array<string>"))).alias("deps")), "calls")
    results = messages.filter("role = 'tool'").select(F.col("conv_id").alias("conv"), F.col("tool_call_id").alias("id"), "turn", "content")
    named = F.col("conv").isNotNull() & F.col("id").isNotNull()
    once = written(results.filter(named).groupBy("conv", "id").agg(
        F.min(F.struct("turn", "content")).alias("r"), F.count(F.lit(1)).alias("n_results")), "results")
    nodes = calls.filter(named).select("conv", "id").distinct()
    nodes = written(nodes, "nodes")
    wanted = calls.filter(named).select("conv", "id", F.explode("deps").alias("dep")).filter("dep is not null").distinct()
    known = nodes.select("conv", F.col("id").alias("dep"))
    unknown = wanted.join(known, ["conv", "dep"], "left_anti").groupBy("conv", "id").agg(
        F.sort_array(F.collect_list("dep")).alias("unknown"))
    facts = levels(nodes, wanted.join(known, ["conv", "dep"], "left_semi")).join(unknown, ["conv", "id"], "left")
    facts = facts.join(once, ["conv", "id"], "left")
    linked = calls.drop("deps").join(facts, ["conv", "id"], "left")
    one_schema = tools.groupBy("name").agg(F.min("schema").alias("schema"))
    linked = linked.join(one_schema, "name", "left")
    lonely = once.join(nodes, ["conv", "id"], "left_anti").select("conv", "id", "r", "n_results")
    lonely = lonely.unionByName(results.filter(~F.coalesce(named, F.lit(False))).select(
        "conv", "id", F.struct("turn", "content").alias("r"), F.lit(1).cast("bigint").alias("n_results")))

    # positions: counts per (conversation, level, range of turns), then places within
    at_level = F.coalesce(F.col("level"), F.lit(2**31 - 1))
    bounds = ordered_bounds(calls, F.col("turn"), 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    placed = written(linked.withColumns({"__l": at_level, "__b": bucket_of(F.col("turn"), bounds)}), "linked")
    cell = [F.coalesce(F.to_json(F.struct("conv")), F.lit("")).alias("__c"), "__l", "__b"]
    cells = placed.groupBy(*cell).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("__c").orderBy("__l", "__b").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    within = Window.partitionBy("__c", "__l", "__b").orderBy(F.col("turn").asc_nulls_last(), "nth", "id", "name", "arguments")
    placed = placed.withColumn("__c", cell[0]).withColumn("__k", F.row_number().over(within))
    placed = placed.join(cells, ["__c", "__l", "__b"])
    calls_out = placed.select("conv", "id", "turn", "name", "arguments", "schema", "level",
                              (F.col("__before") + F.col("__k")).cast("bigint").alias("position"),
                              F.coalesce("n_results", F.lit(0)).cast("bigint").alias("n_results"),
                              F.when(F.col("n_results").isNull(), "unanswered").otherwise("linked").alias("status"),
                              F.col("r.content").alias("result"), "unknown")
    nothing = {c: F.lit(None).cast(t) for c, t in calls_out.dtypes}
    orphans = lonely.select("conv", "id", F.col("r.turn").alias("turn"), *[nothing[c].alias(c) for c in ("name", "arguments", "schema", "level", "position")],
                            "n_results", F.lit("orphan").alias("status"), F.col("r.content").alias("result"), nothing["unknown"].alias("unknown"))
    return serialise(calls_out.unionByName(orphans))


def serialise(rows: DataFrame) -> DataFrame:
    """Validates arguments and writes each row's canonical JSON."""
    names = ["conv", "id", "turn", "name", "level", "position", "n_results", "status"]
    kinds = dict(rows.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            valid, errors, made = [], [], []
            for r in batch.to_pylist():
                record = {"call_id": r["id"], "conversation": r["conv"], "result": r["result"], "status": r["status"]}
                if r["status"] == "orphan":
                    wrong = ["call: missing"]
                else:
                    value, wrong = check(r["arguments"], r["schema"])
                    wrong += [f"depends_on: unknown {x}" for x in r["unknown"] or []]
                    if r["level"] is None and r["id"] is not None and r["conv"] is not None:
                        wrong.append("depends_on: cycle")
                    record |= {"arguments": value, "level": r["level"], "name": r["name"], "position": r["position"]}
                valid.append(not wrong)
                errors.append("; ".join(wrong))
                made.append(canonical(record))
            own = [batch.column(batch.schema.get_field_index(n)) for n in names]
            yield pa.RecordBatch.from_arrays([*own, pa.array(valid, pa.bool_()), pa.array(errors, pa.string()), pa.array(made, pa.string())],
                                             names=["conv_id", "call_id", *names[2:], "valid", "errors", "canonical"])

    ddl = (f"conv_id {kinds['conv']}, call_id string, turn {kinds['turn']}, name string, level int, position bigint, "
           "n_results bigint, status string, valid boolean, errors string, canonical string")
    return rows.mapInArrow(run, ddl)
