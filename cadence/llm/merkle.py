"""Merkle manifest of a table: concatenated-level strings.

Every row is a leaf, the SHA-256 of its length-framed columns. Leaves of a group ascend
by id; while several nodes remain, every ``FAN`` consecutive ones become the SHA-256 of
their hex texts (the last run may hold fewer, even one). What remains is the group's
subroot; subroots, by group (null first, bytewise), make the root in the same way.

Positions come from a range partition, so a hot group is cut over many tasks. An aligned
block of ``FAN ** 3`` nodes keeps its level as one hex string of 64 characters a node;
SQL substrings of ``64 * FAN`` characters are hashed to the parents' level, three levels
a block, and the blocks' roots are the nodes of the next round, 512 times fewer. Each
round is a table in the shared checkpoint folder. On the way down a block's path (the
text left and right of the node on every higher level) is joined to it once; the
flanking substrings of the node's own run complete it. A block is bounded, so no task
holds a group; the rounds are log512 of the rows.

Defined cases: a null column value is framed as ``-``, so it differs from an empty text;
rows with a null id come first in their group; rows of equal ids are ordered by their
leaves, rows equal in both are interchangeable. An empty table has no rows and no root.
A row with a null id is never tampered. Columns that the leaf does not name are not
read, whatever they are called.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import prepare, written
from cadence.operators.order import ordered_positions

FAN = 8
HEX = 64
#: Levels that one block holds; a block has FAN ** LEVELS nodes.
LEVELS = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def sha(value: Column) -> Column:
    return F.sha2(value.cast("binary"), 256)


def framed(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value as text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(fields: Sequence[Column]) -> Column:
    return sha(F.concat(*[framed(c) for c in fields]))


def lowered(text: Column) -> Column:
    """The text with A-Z in lower case and all else as it is."""
    return F.translate(text, UPPER, LOWER)


def group_key(group: Column) -> Column:
    """Text that is never null and sorts as the group does: null first, then bytewise."""
    text = group.cast("string")
    return F.when(text.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), text))


def _parents(level: str) -> Column:
    """A level's parents: every run of FAN nodes, cut by fixed width, becomes its hash."""
    run = HEX * FAN
    return F.expr(f"array_join(transform(sequence(0, cast((length({level}) - 1) div {run} as int)), "
                  f"i -> sha2(cast(substring({level}, i * {run} + 1, {run}) as binary), 256)), '')")


def _blocks(nodes: DataFrame, sizes: DataFrame, carry: Sequence[str]) -> DataFrame:
    """Blocks (g, block, at, l0..l3, depth, root) of nodes (g, pos, hash, carry...).

    A group of at most a block's nodes stops as soon as one remains; blocks of larger
    groups take all levels, because the whole group still has several nodes there."""
    size = FAN ** LEVELS
    row = F.struct("pos", "hash", *carry)
    got = nodes.groupBy("g", F.floor(F.col("pos") / size).cast("bigint").alias("block")).agg(
        F.array_sort(F.collect_list(row)).alias("at")).join(sizes, "g")
    n = F.col("n")
    depth = F.when(n <= 1, 0)
    for d in range(1, LEVELS):
        depth = depth.when(n <= FAN ** d, d)
    got = got.select("g", "block", F.transform("at", lambda x: x.dropFields("hash")).alias("at"),
                     F.array_join(F.transform("at", lambda x: x["hash"]), "").alias("l0"),
                     depth.otherwise(LEVELS).alias("depth"))
    for d in range(LEVELS):
        got = got.withColumn(f"l{d + 1}", F.when(F.col("depth") > d, _parents(f"l{d}")))
    root = F.coalesce(*[F.col(f"l{d}") for d in range(LEVELS, -1, -1)])
    return got.withColumn("root", root)


def _flanks(level: str, at: str) -> str:
    """SQL struct of the text left and right of node ``at`` in its run of ``level``."""
    run = f"(({at}) div {FAN}) * {FAN}"
    return (f"named_struct('l', substring({level}, cast({run} * {HEX} + 1 as int), cast((({at}) % {FAN}) * {HEX} as int)), "
            f"'r', substring({level}, cast((({at}) + 1) * {HEX} + 1 as int), cast(({FAN - 1} - ({at}) % {FAN}) * {HEX} as int)))")


def _open(blocks: DataFrame, carry: Sequence[str] = (), along: Sequence[str] = ()) -> DataFrame:
    """One row per node of the blocks, which hold ``path`` (that of the block's root) and
    the columns ``along``: g, pos, hash, carry..., along..., left and right (own run's
    text around the node; null where the group is this node alone), and up, the path
    above the run."""
    run = HEX * FAN
    runs = blocks.select("g", "at", "depth", "path", *along, *[f"l{d}" for d in range(1, LEVELS)], F.expr(
        f"posexplode(transform(sequence(0, cast((length(l0) - 1) div {run} as int)), "
        f"i -> substring(l0, i * {run} + 1, {run})))").alias("run", "nodes"))
    parts = [f"if(depth > {d}, array({_flanks(f'l{d}', f'run div {FAN ** (d - 1)}')}), slice(path, 1, 0))"
             for d in range(1, LEVELS)]
    runs = runs.select("g", "run", "nodes", "depth", *along, F.expr(f"concat({', '.join([*parts, 'path'])})").alias("up"),
                       F.slice("at", F.col("run") * FAN + 1, FAN).alias("at"))
    one = runs.select("g", "nodes", "depth", "up", *along, F.posexplode("at").alias("j", "x"))

    def cut(start: str, size: int) -> Column:
        return F.expr(f"if(depth > 0, substring(nodes, {start}, {size}), null)")
    return one.select("g", F.col("x.pos").alias("pos"), *[F.col(f"x.{c}").alias(c) for c in carry], *along,
                      F.expr(f"if(depth > 0, substring(nodes, 1, j * {HEX}), null)").alias("left"),
                      cut(f"(j + 1) * {HEX} + 1", run).alias("right"), "up",
                      F.expr(f"substring(nodes, j * {HEX} + 1, {HEX})").alias("hash"))


def _path() -> Column:
    """The path of an opened node: its own run's flanks, then those above."""
    own = F.when(F.col("left").isNotNull(), F.array(F.struct(F.col("left").alias("l"), F.col("right").alias("r"))))
    return F.concat(F.coalesce(own, F.slice("up", 1, 0)), F.col("up")).alias("path")


def _rounds(nodes: DataFrame, carry: Sequence[str]) -> tuple[list[DataFrame], DataFrame]:
    """Block tables from the leaves up, and each group's last node (g, hash)."""
    rounds = []
    while True:
        sizes = nodes.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
        blocks = written(_blocks(nodes, sizes, carry if not rounds else ()), "merkle")
        rounds.append(blocks)
        nodes = blocks.select("g", F.col("block").alias("pos"), F.col("root").alias("hash"))
        if blocks.filter("block > 0").isEmpty():
            return rounds, nodes.select("g", "hash")


def _down(rounds: list[DataFrame], tops: DataFrame, carry: Sequence[str], along: Sequence[str] = ()) -> DataFrame:
    """Opens the rounds from the last to the leaves; ``tops`` (g, path, along...) has the
    path of each group's last node."""
    blocks = rounds[-1].join(tops, "g")
    for lower in reversed(rounds[:-1]):
        paths = _open(blocks, (), along).select("g", F.col("pos").alias("block"), _path(), *along)
        blocks = lower.join(written(paths, "paths"), ["g", "block"])
    return _open(blocks, carry, along)


def _folded(start: Column) -> Column:
    """The hash of the run around ``start``, carried up the path to the root."""
    first = F.when(F.col("left").isNull(), start).otherwise(sha(F.concat("left", start, "right")))
    return F.aggregate("up", first, lambda h, s: sha(F.concat(s["l"], h, s["r"])))


def manifest(df: DataFrame, id_col: str = "doc_id", group_col: str = "lang", fields: Sequence[str] = FIELDS,
             changed: dict[str, Column] | None = None, when: Column | None = None) -> DataFrame:
    """id, leaf, subroot, root, proof (the siblings' text, level by level) and
    folded_root of every row: the root that the row's present content and the stored
    siblings give. Present content: the fields, with those of ``changed`` replaced in the
    rows where ``when`` holds (a check of a copy against the manifest)."""
    prepare(df.sparkSession)
    leaf = leaf_of([F.col(c) for c in fields])
    seen = F.lit(None).cast("string")
    if changed:
        now = leaf_of([changed.get(c, F.col(c)) for c in fields])
        seen = F.when(F.coalesce(F.lit(True) if when is None else when, F.lit(False)), now)
    rows = df.select(group_key(F.col(group_col)).alias("g"), F.col(id_col).alias("id"), leaf.alias("hash"), seen.alias("seen"))
    # a table of its own: texts are hashed once, and the number that orders rows equal in
    # id and leaf never changes
    rows = written(rows, "leaves").withColumn("tie", F.monotonically_increasing_id())
    nodes = ordered_positions(rows, ["id", "hash", "tie"], ["g"], "pos").select("g", "pos", "hash", "id", "seen")
    rounds, subroots = _rounds(nodes, ("id", "seen"))
    tops = ordered_positions(subroots, ["g"], (), "pos").select(F.lit("").alias("g"), "pos", "hash", F.col("g").alias("of"))
    upper, top = _rounds(tops, ("of",))
    root = top.first()
    none = F.expr("cast(array() as array<struct<l:string,r:string>>)").alias("path")
    over = _down(upper, top.select("g", none), ("of",))
    over = written(over.select(F.col("of").alias("g"), _path(), F.col("hash").alias("subroot")), "tops")
    leaves = _down(rounds, over, ("id", "seen"), ("subroot",))
    proof = F.concat(F.coalesce(F.concat("left", "right"), F.lit("")),
                     F.array_join(F.transform("up", lambda s: F.concat(s["l"], s["r"])), ""))
    return leaves.select(F.col("id").alias(id_col), F.col("hash").alias("leaf"), "subroot",
                         F.lit(root["hash"] if root else None).cast("string").alias("root"), proof.alias("proof"),
                         _folded(F.coalesce("seen", "hash")).alias("folded_root"))
