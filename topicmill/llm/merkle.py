"""Merkle manifest of a table: one tree per source, and one over the sources.

A leaf is the digest of a row's framed columns. Leaves are ranked within their
source, and the digits of the rank are columns: grouping one digit away nests up
to 16 child structs in their parent, whose digest is that of their digests. A
block is `ARITY ** DIGITS` consecutive leaves, one nested row; its digest is a
leaf of the next, 256 times smaller table, and so on up to the subroots, whose
tree is built the same way. Inside a block all proofs come from `transform` and
`inline` on the nested row, without a join; one join per block (not per leaf)
hands down what lies above it.

Ranks need no task that sees a whole source: leaves are written in ranges of
(source, key), and counts per range and source give the rank of each range's
first row. A source with a third of all rows is many ranges and many blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topicmill.llm.common import ascii_lower
from topicmill.session import stage

# Fixed value: children of a node.
ARITY = 16
# Levels of a block: 256 leaves a nested row.
DIGITS = 2
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")

_NO_PATH = "array<struct<before:string,after:string>>"


def digest(*parts: Column) -> Column:
    """Hex digest of the parts, concatenated."""
    return F.sha2(F.concat(*parts), 256)


def framed(value: Column) -> Column:
    """A value with its length in bytes before it; `-` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(columns: dict[str, Column] | None = None, names: tuple[str, ...] = LEAF_COLUMNS) -> Column:
    """Digest of a row's columns, in order; `columns` replaces some of them."""
    columns = columns or {}
    return digest(*[framed(columns.get(name, F.col(name))) for name in names])


def tampered_leaf() -> Column:
    """The leaf after tampering: where 5 divides the checksum of the id, the text
    is in lower case; null elsewhere."""
    hit = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    return F.when(hit, leaf_digest({"text": ascii_lower(F.col("text"))}))


def fold(leaf: Column, path: Column) -> Column:
    """Root that a leaf leads to with the siblings on its path."""
    return F.aggregate(path, leaf, lambda acc, step: digest(step["before"], acc, step["after"]))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings, level by level, left to right."""
    siblings = F.transform(path, lambda step: F.concat(step["before"], step["after"]))
    return F.sha2(F.array_join(siblings, ""), 256)


# --- ranks --------------------------------------------------------------------


def _ranked(nodes: DataFrame, order: list[str], name: str) -> DataFrame:
    """`nodes` (tree, ...) with `rank` from 0 and the number `n` within their tree.

    The ranged rows are written once, since the bounds of ranges are drawn anew
    each time they are asked for. Rows equal in `tree` and `order` are spread by
    `_row`, so that they need not share a task.
    """
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ranged = nodes.repartitionByRange("tree", *order, "_row").sortWithinPartitions("tree", *order, "_row")
    ranged = ranged.withColumns({"_task": F.spark_partition_id(), "_place": place})
    ranged = stage(ranged, f"{name}_ranged")
    runs = ranged.groupBy(F.col("tree").alias("_tree"), F.col("_task").alias("_run")).agg(
        F.min("_place").alias("_first"), F.count("*").alias("_rows")
    )
    # One row per range and tree in it: as many as tasks and trees together. Written,
    # so that the join knows its size and leaves the ranged rows where they are.
    by_tree = Window.partitionBy("_tree")
    before = by_tree.orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumns({"_before": F.coalesce(F.sum("_rows").over(before), F.lit(0)), "n": F.sum("_rows").over(by_tree)})
    runs = stage(runs, f"{name}_runs")
    joined = ranged.join(runs, (F.col("tree") == F.col("_tree")) & (F.col("_task") == F.col("_run")))
    rank = F.col("_place") - F.col("_first") + F.col("_before")
    return joined.withColumn("rank", rank).drop("_row", "_task", "_place", "_tree", "_run", "_first", "_rows", "_before")


# --- blocks ---------------------------------------------------------------------


def _children(kind: Column, place: str) -> Column:
    # By digit alone: a row may hold columns that have no order.
    return F.array_sort(F.collect_list(kind), lambda a, b: a["d"] - b["d"]).alias(place)


def _joined(children: Column) -> Column:
    return F.array_join(F.transform(children, lambda c: c["digest"]), "")


def _nested(nodes: DataFrame) -> DataFrame:
    """Blocks of nodes (tree, n, rank, digest, row): (tree, n, rank, digest, nodes).

    `n` is the number of nodes of the tree on the level that came in. A level
    hashes where the tree still has several nodes there; a single one passes.
    """
    digits = nodes.select(
        "tree",
        "n",
        F.floor(F.col("rank") / ARITY**DIGITS).alias("rank"),
        F.floor(F.col("rank") / ARITY % ARITY).cast("int").alias("d1"),
        F.struct((F.col("rank") % ARITY).cast("int").alias("d"), F.col("digest"), F.col("row")).alias("node"),
    )
    # Both groupings use the exchange of the outer one.
    digits = digits.repartition("tree", "n", "rank")
    inner = digits.groupBy("tree", "n", "rank", "d1").agg(_children(F.col("node"), "nodes"))
    hashed = F.when(F.col("n") > 1, F.sha2(_joined(F.col("nodes")), 256)).otherwise(F.col("nodes")[0]["digest"])
    inner = inner.select("tree", "n", "rank", F.struct(F.col("d1").alias("d"), hashed.alias("digest"), F.col("nodes")).alias("node"))
    outer = inner.groupBy("tree", "n", "rank").agg(_children(F.col("node"), "nodes"))
    hashed = F.when(F.col("n") > ARITY, F.sha2(_joined(F.col("nodes")), 256)).otherwise(F.col("nodes")[0]["digest"])
    return outer.select("tree", "n", "rank", hashed.alias("digest"), "nodes")


def _next_level(blocks: DataFrame) -> DataFrame:
    """Block digests as the nodes of the level above."""
    nodes = F.ceil(F.col("n") / ARITY**DIGITS).cast("long")
    return blocks.select("tree", nodes.alias("n"), "rank", "digest", F.col("rank").alias("row"))


def _step(children: Column, at: Column) -> Column:
    """Digests of the siblings before and after one child."""
    names = F.transform(children, lambda c: c["digest"])
    # A block has at most ARITY children, so the slices may be longer than the list.
    before = F.when(at > 0, F.array_join(F.slice(names, F.lit(1), F.greatest(at, F.lit(1))), "")).otherwise("")
    after = F.array_join(F.slice(names, at + 2, F.lit(ARITY)), "")
    return F.struct(before.alias("before"), after.alias("after"))


def _paths(blocks: DataFrame) -> DataFrame:
    """(tree, row, digest, path, top) for every child in blocks that carry `top`,
    with `top.path` the steps above the block."""

    def below(node: Column, i: Column) -> Column:
        upper = F.when(F.col("n") > ARITY, F.array(_step(F.col("nodes"), i))).otherwise(F.array().cast(_NO_PATH))

        def child(c: Column, j: Column) -> Column:
            lower = F.when(F.col("n") > 1, F.array(_step(node["nodes"], j))).otherwise(F.array().cast(_NO_PATH))
            return F.struct(c["row"].alias("row"), c["digest"].alias("digest"), F.concat(lower, upper, F.col("top.path")).alias("path"))

        return F.transform(node["nodes"], child)

    rows = F.flatten(F.transform("nodes", below))
    return blocks.select("tree", "top", F.inline(rows))


def _tree(nodes: DataFrame, name: str) -> list[DataFrame]:
    """Blocks of all levels, each written, from the leaves up to one block a tree."""
    levels: list[DataFrame] = []
    while True:
        blocks = stage(_nested(nodes), f"{name}_blocks")
        levels.append(blocks)
        if (blocks.agg(F.max("n")).first()[0] or 0) <= ARITY**DIGITS:
            return levels
        nodes = _next_level(blocks)


def _descend(levels: list[DataFrame], tops: DataFrame, name: str) -> DataFrame:
    """Hands the part above a tree, (tree, top), down to its leaves."""
    above = tops.select(F.col("tree").alias("_tree"), F.lit(0).cast("long").alias("_rank"), "top")
    for k, blocks in enumerate(reversed(levels)):
        # One row per block on either side.
        joined = blocks.join(above, (F.col("tree") == F.col("_tree")) & (F.col("rank") == F.col("_rank")))
        found = _paths(joined)
        if k < len(levels) - 1:
            top = F.struct(F.col("top.subroot").alias("subroot"), F.col("top.root").alias("root"), F.col("path").alias("path"))
            above = found.select(F.col("tree").alias("_tree"), F.col("row").alias("_rank"), top.alias("top"))
            above = stage(above, f"{name}_above")
    return found


def manifest(leaves: DataFrame, tree: str = "source", key: str = "doc_id", leaf: str = "leaf") -> DataFrame:
    """Rows of `leaves` with `subroot`, `root` and `path`.

    `leaves` has a digest per row in `leaf`; trees are the values of `tree` (null
    is one of its own and comes first, others by their bytes), their leaves
    ascend by `key`, equal keys by digest. Rows that repeat stay as often as they
    came. `path` has, per level from the leaf to the root, the joined digests of
    the siblings before and after it; a lone leaf in a lone tree has none. No rows
    give no rows. Columns of `leaves` pass through whatever their names, carried
    as one struct; those named like an output are replaced.
    """
    columns = [c for c in leaves.columns if c not in ("subroot", "root", "path")]
    value = F.col(f"`{tree}`").cast("string")
    named = F.coalesce(F.concat(F.lit("="), value), F.lit(""))
    rows = leaves.select(
        named.alias("tree"),
        F.col(f"`{key}`").alias("_key"),
        F.col(f"`{leaf}`").alias("digest"),
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"),
        F.monotonically_increasing_id().alias("_row"),
    )
    rows = stage(rows, "leaves")
    trees = _tree(_ranked(rows, ["_key", "digest"], "leaves").select("tree", "n", "rank", "digest", "row"), "leaves")
    # Each tree is one block on the last level; smaller ones came up as a single node.
    subroots = trees[-1].select("tree", "digest")
    over = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("_key"), "digest", F.col("tree").alias("row"), F.lit(0).alias("_row"))
    over = _tree(_ranked(over, ["_key"], "subroots").select("tree", "n", "rank", "digest", "row"), "subroots")
    root = over[-1].select(F.col("digest").alias("root"))
    start = root.select(
        F.lit("").alias("tree"),
        F.struct(F.lit("").alias("subroot"), "root", F.array().cast(_NO_PATH).alias("path")).alias("top"),
    )
    tops = _descend(over, start, "subroots")
    top = F.struct(F.col("digest").alias("subroot"), F.col("top.root").alias("root"), F.col("path").alias("path"))
    tops = stage(tops.select(F.col("row").alias("tree"), top.alias("top")), "tree_tops")
    found = _descend(trees, tops, "leaves")
    return found.select("row.*", F.col("top.subroot").alias("subroot"), F.col("top.root").alias("root"), "path")


def verify(found: DataFrame, claimed: str = "claimed", leaf: str = "leaf") -> DataFrame:
    """Adds the root that the claimed leaf (else the original) folds to, and
    whether it is the manifest's root."""
    folded = fold(F.coalesce(F.col(claimed), F.col(leaf)), F.col("path"))
    checked = found.withColumn("folded_root", folded)
    return checked.withColumn("verified", F.col("folded_root") == F.col("root"))
