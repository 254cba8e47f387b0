"""A Merkle manifest of a table: a tree of digests per source, and one over the sources' subroots.

Slot pivot: the children of a parent are spread into `FANOUT` columns by conditional aggregates. The columns joined are
the parent's input; the same columns without a child's own are its siblings. `LEVELS` levels are built at once: rows are
dealt out by (tree, block of FANOUT ** LEVELS positions) once, and the pivots of these levels nest in that partitioning,
so a block is one bounded row. Digests of blocks are the nodes of the next round, and there are as many rounds as the
largest tree needs. Siblings come back the other way: a block is opened level by level, and every child gets its
parent's path with its own siblings before it. Nothing is joined but blocks with the paths of their tops.

A level groups every three consecutive nodes; the last run may be smaller, and a run of one is hashed like any other.
A tree of one leaf has that leaf as its root. An empty table gives no rows.

Leaves ascend by key within a source (nulls first). Rows with equal keys follow the order of their leaves, so that equal
rows are the only ones that may change places, which no result shows. Null fields count as `-`, so a null and an
empty text differ. Columns besides the named fields are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.llm.common import quoted, written
from tillwise.operators.ordering import broadcast_if_small, with_row_index

FANOUT = 3
#: Levels of one round; a block has FANOUT ** LEVELS leaves at most.
LEVELS = 5

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
NO_PATH = "CAST(array() AS array<struct<left: string, right: string>>)"


def field(value: Column) -> Column:
    """A value as the digest reads it: its bytes in UTF-8, a colon, the value; `-` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[field(x) for x in values]), 256)


def fold(digest: Column, path: Column) -> Column:
    """The root that a leaf and its siblings, level by level, lead to."""
    return F.aggregate(path, digest, lambda found, step: F.sha2(F.concat(step["left"], found, step["right"]), 256))


def proof(path: Column) -> Column:
    """The digest of all siblings on the way, from left to right and upwards."""
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), ""), 256)


def height(nodes: Column) -> Column:
    """Levels above so many leaves: the powers of `FANOUT` that are smaller."""
    powers = F.array(*[F.lit(FANOUT**i) for i in range(39)])
    return F.size(F.filter(powers, lambda x: x < nodes))


def climb(nodes: DataFrame, done: int, levels: int = LEVELS) -> DataFrame:
    """Blocks of `nodes` (`tree`, `position`, `height`, `node`: a struct that begins with its `digest`) in one row each.

    `done` levels lie below. A row is (`tree`, `position` of the block, `height`, `node`); a node above the leaves has its
    digest and the structs of its children.
    """
    block = F.col("position") - F.pmod("position", F.lit(FANOUT**levels))
    found = nodes.withColumn("block", block).repartition("tree", "block")
    for level in range(done + 1, done + levels + 1):
        slots = [F.any_value(F.when(F.pmod("position", F.lit(FANOUT)) == i, F.col("node")), F.lit(True)).alias(f"c{i}") for i in range(FANOUT)]
        spread = found.groupBy("tree", "block", "height", F.expr(f"position div {FANOUT}").alias("position")).agg(*slots)
        # a column that has no child adds nothing
        joined = F.sha2(F.concat(*[F.coalesce(F.col(f"c{i}.digest"), F.lit("")) for i in range(FANOUT)]), 256)
        digest = F.when(F.col("height") >= level, joined).otherwise(F.col("c0.digest")).alias("digest")
        found = spread.select("tree", F.expr(f"block div {FANOUT}").alias("block"), "height", "position", F.struct(digest, *[f"c{i}" for i in range(FANOUT)]).alias("node"))
    return found.select("tree", "position", "height", "node")


def descend(blocks: DataFrame, done: int, carried: Sequence[str], levels: int = LEVELS) -> DataFrame:
    """The nodes of `blocks`, which have a `path`, each with its own: a step of siblings, then those of its parent."""
    found = blocks
    for level in range(done + levels, done, -1):
        digests = [F.coalesce(F.col(f"node.c{i}.digest"), F.lit("")) for i in range(FANOUT)]
        children = []
        for i in range(FANOUT):
            step = F.struct(F.concat(F.lit(""), *digests[:i]).alias("left"), F.concat(F.lit(""), *digests[i + 1 :]).alias("right"))
            path = F.when(F.col("height") >= level, F.concat(F.array(step), F.col("path"))).otherwise(F.col("path"))
            child = F.struct((F.col("position") * FANOUT + i).alias("position"), F.col(f"node.c{i}").alias("node"), path.alias("path"))
            children.append(F.when(F.col(f"node.c{i}").isNotNull(), child))
        opened = found.select("tree", "height", *carried, F.explode(F.array_compact(F.array(*children))).alias("child"))
        found = opened.select("tree", "height", *carried, "child.*")
    return found


def trees(leaves: DataFrame, levels: int = LEVELS) -> tuple[list[DataFrame], DataFrame]:
    """The rounds of blocks above `leaves` (`tree`, `position`, `height`, `node`), lowest first, and the `root` of each tree."""
    most = leaves.agg(F.max("height")).first()[0] or 0
    rounds, nodes = [], leaves
    for done in range(0, max(most, 1), levels):
        blocks = written(climb(nodes, done, levels))
        rounds.append(blocks)
        nodes = blocks.select("tree", "position", "height", F.struct(F.col("node.digest").alias("digest")).alias("node"))
    return rounds, nodes.select("tree", F.col("node.digest").alias("root"))


def paths(rounds: list[DataFrame], tops: DataFrame, carried: Sequence[str], levels: int = LEVELS) -> DataFrame:
    """The leaves of all trees with their paths and the columns of `tops` (`tree`, `path` from there on and `carried`)."""
    found = None
    for number in range(len(rounds) - 1, -1, -1):
        blocks = rounds[number]
        if found is None:
            opened = blocks.join(broadcast_if_small(tops), "tree")  # the top blocks are one for each tree
        else:
            opened = blocks.join(found.select("tree", "position", "path", *carried), ["tree", "position"])
        found = descend(opened, number * levels, carried, levels)
    return found


def numbered(rows: DataFrame, tree: str, order: Sequence[str]) -> DataFrame:
    """Rows with `tree` (a number for each value of that column), `position` within it and the `height` of its tree.

    One global order, cut into slices; a tree's rows may lie in many of them, and equal rows may be split.
    """
    placed = with_row_index(rows, [tree, *order], "place")
    first = placed.groupBy(tree).agg(F.min("place").alias("first"), F.count("*").alias("nodes"))
    known = broadcast_if_small(written(first.select(F.col(tree).alias("value"), F.col("first"), height(F.col("nodes")).alias("height"))))
    return placed.join(known, F.col(tree).eqNullSafe(F.col("value"))).select(
        *rows.columns, F.col("first").alias("tree"), (F.col("place") - F.col("first")).alias("position"), "height"
    )


def manifest(
    docs: DataFrame, key: str = "doc_id", source: str = "source", fields: Sequence[str] = FIELDS, tampered: dict[str, Column] | None = None, levels: int = LEVELS
) -> DataFrame:
    """One row per document: the key, `leaf`, `subroot`, `root`, `path` (its siblings level by level), `proof_sha256`.

    `tampered` replaces fields by expressions over `docs`; `folded_root` is what the leaf of those values and the
    original siblings lead to, and `verified` whether that is the root.
    """
    changed = tampered or {}
    values = [F.col(quoted(x)) for x in fields]
    hashed = docs.select(
        F.col(quoted(key)).alias("key"),
        F.col(quoted(source)).alias("source"),
        leaf(values).alias("leaf"),
        leaf([changed.get(name, value) for name, value in zip(fields, values, strict=True)]).alias("now"),
        F.monotonically_increasing_id().alias("row"),  # splits runs of equal rows
    )
    ordered = numbered(written(hashed), "source", ["key", "leaf", "row"])
    node = F.struct(F.col("leaf").alias("digest"), F.when(F.col("now") != F.col("leaf"), F.col("now")).alias("now"), "key", "source")
    rounds, subroots = trees(ordered.select("tree", "position", "height", node.alias("node")), levels)

    named = subroots.withColumnRenamed("root", "subroot")  # trees are numbered in the order of their sources
    tops = written(numbered(named.select(F.lit(0).alias("one"), F.col("tree").alias("source"), "subroot"), "one", ["source"]))
    upper, roots = trees(tops.select("tree", "position", "height", F.struct(F.col("subroot").alias("digest"), F.col("source")).alias("node")), levels)
    start = roots.select("tree", "root", F.expr(NO_PATH).alias("path"))
    above = paths(upper, start, ["root"], levels).select(F.col("node.source").alias("tree"), F.col("node.digest").alias("subroot"), "root", "path")

    found = paths(rounds, written(above), ["subroot", "root"], levels)
    folded = found.withColumn("folded_root", fold(F.coalesce("node.now", "node.digest"), F.col("path")))
    return folded.select(
        F.col("node.key").alias(key),
        F.col("node.source").alias("source"),
        F.col("node.digest").alias("leaf"),
        "subroot",
        "root",
        "path",
        proof(F.col("path")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def without_line_breaks(key: str = "doc_id", text: str = "text") -> dict[str, Column]:
    """The tampering of the check: texts of documents whose key has an even CRC-32 lose their line breaks."""
    value = F.col(quoted(text)).cast("string")
    even = F.crc32(F.col(quoted(key)).cast("string").cast("binary")) % 2 == 0
    return {text: F.when(even, F.replace(value, F.lit("\n"), F.lit(""))).otherwise(value)}


