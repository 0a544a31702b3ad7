"""Operator 12: a Merkle manifest of a dataset, kept as logs in postorder.

Rows are leaves. Each group of rows has a tree of runs of three, whose roots are the leaves of one
more tree. A tree is cut into aligned blocks of ``3 ** HEIGHT`` leaves; a builder reads one block
and appends its nodes to the block's log as they are completed, which is postorder. Where a node
stands then follows from the sizes of the subtrees completed before it, in closed form, so a proof
is read from the log by the addresses of the siblings. Block roots are the leaves of the next tier,
which is built in the same way; no task ever sees more than one block, however large a group is.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ledgerlark.llm.columns import quoted
from ledgerlark.sources.scratch import stored

ARITY = 3  # fixed value: nodes of a run
HEIGHT = 7  # levels of a builder: 2,187 leaves
DIGEST = 32

PATH = "array<struct<before:string,after:string>>"
LOG = "tree string, block bigint, n bigint, leaves int, first_position bigint, nodes binary, root string"


def leaf_digest(*values: Column) -> Column:
    """Digest of a row: each value as text behind its UTF-8 byte count, or ``-`` where it is null."""

    def part(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(part, values)), 256)


def tree_key(group: Column) -> Column:
    """A name for a group's tree that is never null; in byte order, null stands before all texts."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit("-"))


# --- one tree --------------------------------------------------------------------------------------


def joined_digest(parts: Sequence[str]) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def height_of(leaves: int) -> int:
    height = 0
    while ARITY**height < leaves:
        height += 1
    return height


def build(leaves: Sequence[str], height: int) -> list[str]:
    """All nodes in the order in which they are completed, up to one node at ``height``."""
    log: list[str] = []
    open_runs: list[list[str]] = [[] for _ in range(height + 1)]

    def append(node: str, level: int) -> None:
        log.append(node)
        open_runs[level].append(node)

    for leaf in leaves:
        append(leaf, 0)
        level = 0
        while level < height and len(open_runs[level]) == ARITY:
            run, open_runs[level] = open_runs[level], []
            level += 1
            append(joined_digest(run), level)
    for level in range(height):  # the last run of a level may be short
        if open_runs[level]:
            append(joined_digest(open_runs[level]), level + 1)
    return log


def position(level: int, index, leaves: int, height: int):
    """Where node ``index`` of ``level`` stands in the log of a tree: the nodes completed by the time
    its own last leaf is in, less those above it that this leaf completes only afterwards."""
    last = np.minimum((np.asarray(index, np.int64) + 1) * ARITY**level, leaves)
    below = sum(-(-last // ARITY**j) for j in range(level + 1))
    above = sum((last - 1) // ARITY**j for j in range(level + 1, height + 1))
    return below + above - 1


def first_position(leaves: int, height: int) -> int:
    """Nodes of a tree that are complete once ``leaves`` of its leaves, whole runs, are in."""
    return sum(leaves // ARITY**j for j in range(height + 1))


@cache
def addresses(leaves: int, height: int) -> list[np.ndarray]:
    """For each level, the positions of its nodes in the log of one block."""
    return [position(j, np.arange(-(-leaves // ARITY**j)), leaves, height) for j in range(height + 1)]


def paths(nodes: bytes, leaves: int, height: int) -> list[list[dict[str, str]]]:
    """For each leaf of a block its siblings level by level: the text before and after it in its run."""
    hexes = nodes.hex()
    steps: list[list[dict[str, str]]] = []
    for at in addresses(leaves, height)[:height]:
        level = [hexes[2 * DIGEST * p : 2 * DIGEST * (p + 1)] for p in at.tolist()]
        runs = [level[i : i + ARITY] for i in range(0, len(level), ARITY)]
        steps.append([{"before": "".join(r[:i]), "after": "".join(r[i + 1 :])} for r in runs for i in range(len(r))])
    return [[steps[j][leaf // ARITY**j] for j in range(height)] for leaf in range(leaves)]


# --- many trees ------------------------------------------------------------------------------------


def numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows (tree, ..., copies) with ``idx``, their place in their tree, from 0, and ``n``, its size.

    Rows are dealt by range of (tree, order), so a large tree is spread over many tasks; each part
    counts its rows, and the counts before it give its offset. ``copies`` equal rows take as many
    places, one output row each.
    """
    ranged = rows.repartitionByRange("tree", *order).withColumn("part", F.spark_partition_id())
    ranged = stored(ranged, "merkle-ranges")
    earlier = W.partitionBy("tree").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    sizes = ranged.groupBy("tree", "part").agg(F.sum("copies").alias("held"))
    offsets = sizes.select(
        "tree",
        "part",
        F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("offset"),
        F.sum("held").over(W.partitionBy("tree")).alias("n"),
    )
    before = W.partitionBy("tree", "part").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    within = ranged.withColumn("within", F.coalesce(F.sum("copies").over(before), F.lit(0)))
    placed = within.join(offsets, ["tree", "part"])
    start = F.col("offset") + F.col("within")
    return placed.withColumn("idx", F.explode(F.sequence(start, start + F.col("copies") - 1))).drop(
        "part", "within", "offset", "copies"
    )


def _height(n: int, height: int) -> int:
    """Levels of a block in a tree of ``n`` leaves: all of them where there are several blocks."""
    return min(height, height_of(n))


def _blocks(items: DataFrame, height: int) -> DataFrame:
    """The logs of all blocks of items (tree, idx, digest, n)."""

    def run(key, table):
        table = table.sort_by("idx")
        n, leaves = table["n"][0].as_py(), table["digest"].to_pylist()
        block = key[1].as_py()
        log = build(leaves, _height(n, height))
        row = {
            "tree": key[0].as_py(),
            "block": block,
            "n": n,
            "leaves": len(leaves),
            "first_position": first_position(block * ARITY**height, height_of(n)),
            "nodes": bytes.fromhex("".join(log)),
            "root": log[-1],
        }
        return pa.Table.from_pylist([row], schema=_LOG_SCHEMA)

    return _in_blocks(items, height).groupBy("tree", "block").applyInArrow(run, LOG)


_LOG_SCHEMA = pa.schema(
    [
        ("tree", pa.string()), ("block", pa.int64()), ("n", pa.int64()), ("leaves", pa.int32()),
        ("first_position", pa.int64()), ("nodes", pa.binary()), ("root", pa.string()),
    ]
)


def _in_blocks(items: DataFrame, height: int) -> DataFrame:
    return items.withColumn("block", F.call_function("div", F.col("idx"), F.lit(ARITY**height)))


def build_logs(items: DataFrame, height: int) -> list[DataFrame]:
    """The logs of every tier: that of the items, that of its block roots, and so on to the root of
    the largest tree. A tree ends in the tier where it has one block, whose root is its own."""
    block = ARITY**height
    largest = items.agg(F.max("n")).first()[0] or 0
    tiers = [stored(_blocks(items, height), "merkle-log")]
    while largest > block:
        largest = -(-largest // block)
        roots = tiers[-1].where(F.col("n") > block)
        above = roots.select(
            "tree", F.col("block").alias("idx"), F.col("root").alias("digest"), F.call_function("div", F.col("n") + (block - 1), F.lit(block)).alias("n")
        )
        tiers.append(stored(_blocks(above, height), "merkle-log"))
    return tiers


def tree_roots(tiers: list[DataFrame], height: int) -> DataFrame:
    """(tree, root) of every tree."""
    ends = [tier.where(F.col("n") <= ARITY**height).select("tree", "root") for tier in tiers]
    out = ends[0]
    for end in ends[1:]:
        out = out.unionByName(end)
    return out


def _with_above(tiers: list[DataFrame], top: DataFrame, height: int) -> DataFrame:
    """The logs of the first tier, each with ``above``: the path from its block's root to the end of
    ``top`` (tree, above), the path that follows each tree's own root."""
    block, above = ARITY**height, None
    for tier in reversed(tiers):
        ending = tier.where(F.col("n") <= block).join(top, "tree")
        if above is not None:
            ending = ending.unionByName(tier.where(F.col("n") > block).join(above, ["tree", "block"]))
        if tier is tiers[0]:
            return ending
        above = stored(_item_paths(ending, height), "merkle-paths").select("tree", F.col("idx").alias("block"), "above")


def _item_paths(logs: DataFrame, height: int) -> DataFrame:
    """(tree, idx, above) of every item of logs with ``above``: its own path and what follows."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                own = paths(row["nodes"], row["leaves"], _height(row["n"], height))
                start = row["block"] * ARITY**height
                yield pa.RecordBatch.from_pydict(
                    {
                        "tree": pa.array([row["tree"]] * len(own), pa.string()),
                        "idx": pa.array(range(start, start + len(own)), pa.int64()),
                        "above": pa.array([path + row["above"] for path in own], _PATH),
                    }
                )

    chosen = logs.select("tree", "block", "n", "leaves", "nodes", "above")
    return chosen.mapInArrow(run, f"tree string, idx bigint, above {PATH}")


_PATH = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings of a path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda run: F.concat(run["before"], run["after"])), ""), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and a path give."""
    return F.aggregate(path, leaf, lambda node, run: F.sha2(F.concat(run["before"], node, run["after"]), 256))


def manifest(rows: DataFrame, *, id: str, group: str, leaf: str, carry: Sequence[str] = (), height: int = HEIGHT) -> DataFrame:
    """One row for each row of ``rows``: ``id``, ``carry``, leaf, subroot, root, and ``path``, the
    siblings (before, after) of every level from the leaf to the root.

    Each group's leaves ascend by ``id``, then by leaf (and ``carry``), null ids first; groups ascend
    by UTF-8 bytes, the null group first. Equal rows each have a place and a row. An empty table
    gives an empty table. ``leaf`` must be lower-case hex of 32 bytes and not null; name none of the
    columns ``tree``, ``copies``, ``part``, ``held``, ``offset``, ``n``, ``within``, ``idx`` or
    ``block`` in ``id``, ``leaf`` or ``carry``. A builder takes ``3 ** height`` leaves.
    """
    own = [id, leaf, *carry]
    chosen = rows.select(tree_key(quoted(group)).alias("tree"), *map(quoted, own))
    counted = chosen.groupBy("tree", *map(quoted, own)).agg(F.count(F.lit(1)).alias("copies"))
    leaves = stored(numbered(counted, own), "merkle-leaves")
    tiers = build_logs(leaves.select("tree", "idx", quoted(leaf).alias("digest"), "n"), height)
    roots = tree_roots(tiers, height)
    forest = numbered(
        roots.select(F.lit("forest").alias("tree"), F.col("tree").alias("name"), "root", F.lit(1).cast("bigint").alias("copies")),
        ["name", "root"],
    )
    forest = stored(forest, "merkle-forest")
    upper = build_logs(forest.select("tree", "idx", F.col("root").alias("digest"), "n"), height)
    whole = tree_roots(upper, height).first()  # one digest
    none = F.array().cast(PATH)
    ends = _with_above(upper, tree_roots(upper, height).select("tree", none.alias("above")), height)
    ends = _item_paths(ends, height)
    top = forest.select("name", "root", "idx").join(ends.select("idx", "above"), "idx")
    top = stored(top.select(F.col("name").alias("tree"), F.col("root").alias("subroot"), "above"), "merkle-top")
    logs = _with_above(tiers, top.select("tree", "above"), height).join(top.select("tree", "subroot"), "tree")
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    ddl = ", ".join(f"`{c}` {kinds[c]}" for c in own) + f", subroot string, path {PATH}"

    def extract(table, logs):
        table, log = table.sort_by("idx"), logs.to_pylist()[0]
        own_paths = paths(log["nodes"], log["leaves"], _height(log["n"], height))
        columns = [table[c].combine_chunks() for c in own]
        columns.append(pa.array([log["subroot"]] * table.num_rows, pa.string()))
        columns.append(pa.array([path + log["above"] for path in own_paths], _PATH))
        return pa.Table.from_arrays(columns, names=[*own, "subroot", "path"])

    grouped = _in_blocks(leaves, height).select("tree", "block", "idx", *map(quoted, own)).groupBy("tree", "block")
    held = logs.select("tree", "block", "n", "leaves", "nodes", "above", "subroot").groupBy("tree", "block")
    proofs = grouped.cogroup(held).applyInArrow(extract, ddl)
    return proofs.withColumn("root", F.lit(whole["root"] if whole else None).cast("string"))
