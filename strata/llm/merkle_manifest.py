"""A Merkle manifest of a dataset, and the versions of it that tampered rows make.

Every row is a leaf.  Leaves of a group (a source) are in order of their key;
level by level, each ``WIDTH`` consecutive nodes become their hash, until one
is left, the group's subroot.  The subroots, in order of their group, are the
leaves of the tree above, whose last node is the root.

Both trees are built in aligned blocks of ``HEIGHT`` levels: a block is one
stretch of rows in a task, its root a row of the next stage.  Going back down,
each block gets the path above it, the neighbours on the left and on the right at each level up to the root.

Inside a block the tree is persistent: a node is its digest and its children.
A tampered leaf makes a version: the nodes above it in the block are copied,
everything else is shared with the tree that was there, and the path above
the block carries the version on to a root of its own.

The numbering of leaves comes from a range shuffle of (group, key), so that a
group of any size is spread over tasks, and a task holds one block at a time.

Defined results: null groups are a group, which is first; null keys come
first; rows that share a group and key are ordered by their leaf, and equal
ones are leaves of their own; a null column is ``-`` in its leaf, which an empty text is not; a row
whose condition of tampering is null is not tampered with; columns that a
leaf is not made of are ignored; an empty table has no rows, and no root.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from strata.llm.ranks import in_part, part_of, stage_in_order
from strata.operators.staging import stage

# Fixed value of the format: nodes that become one.
WIDTH = 16

#: Levels of a block, which thus has ``WIDTH ** HEIGHT`` rows.
HEIGHT = 3

#: A digest, and the nodes below it.
Node = tuple[str, tuple]

NODES = "name string, idx long, n long, digest string"
PATHS = "name string, idx long, digest string, path array<struct<left: string, right: string>>, subroot string, root string"
TEXTS = ["leaf", "subroot", "root", "proof_sha256", "folded_root"]


def digest_of(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def levels_above(n: int) -> int:
    """Levels from ``n`` nodes to a single one."""
    levels = 0
    while n > 1:
        n, levels = -(-n // WIDTH), levels + 1
    return levels


def build(digests: list[str], levels: int) -> Node:
    """The tree over the nodes of a block; with fewer levels than lead to one node there is no such tree."""
    nodes: list[Node] = [(digest, ()) for digest in digests]
    for _ in range(levels):
        runs = [tuple(nodes[i : i + WIDTH]) for i in range(0, len(nodes), WIDTH)]
        nodes = [(digest_of("".join(node[0] for node in run)), run) for run in runs]
    (root,) = nodes
    return root


def path_copy(node: Node, levels: int, place: int, digest: str) -> Node:
    """The version of the tree whose leaf at ``place`` is ``digest``: the nodes above it are new, all others are shared."""
    if not levels:
        return digest, ()
    below = WIDTH ** (levels - 1)
    i, children = place // below, node[1]
    changed = path_copy(children[i], levels - 1, place % below, digest)
    run = (*children[:i], changed, *children[i + 1 :])
    return digest_of("".join(child[0] for child in run)), run


def copied_nodes(node: Node, levels: int, place: int) -> list[str]:
    """Digests on the way to the leaf at ``place``, without it, lowest first."""
    found = []
    for level in range(levels - 1, -1, -1):
        found.append(node[0])
        node = node[1][place // WIDTH**level % WIDTH]
    return found[::-1]


def neighbours(node: Node, levels: int) -> Iterator[list[tuple[str, str]]]:
    """For each leaf, in order: the digests on its left and on its right at each level, lowest first."""
    if not levels:
        yield []
        return
    digests = [child[0] for child in node[1]]
    for i, child in enumerate(node[1]):
        here = ("".join(digests[:i]), "".join(digests[i + 1 :]))
        for lower in neighbours(child, levels - 1):
            yield [*lower, here]


def fold(digest: str, path: list[tuple[str, str]]) -> list[str]:
    """The nodes above a node by what stands beside them, lowest first."""
    found = []
    for left, right in path:
        digest = digest_of(left + digest + right)
        found.append(digest)
    return found


def leaf_digest(columns: list[Column]) -> Column:
    """Hash of a row: per column ``-`` if null, else its UTF-8 byte count, ``:`` and itself."""
    values = [c.cast("string") for c in columns]
    parts = [F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in values]
    return F.sha2(F.concat(*parts), 256)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Rows of one block after another; they come sorted."""
    rows = (row for batch in batches for row in batch.to_pylist())
    for _, block in itertools.groupby(rows, lambda row: (row["name"], row["block"])):
        yield list(block)


def _out(rows: Iterator[dict], schema: pa.Schema, size: int = 2048) -> Iterator[pa.RecordBatch]:
    while part := list(itertools.islice(rows, size)):
        yield pa.RecordBatch.from_pylist(part, schema=schema)


def _levels_of(block: list[dict]) -> int:
    return min(HEIGHT, levels_above(block[-1]["n"]))


def _by_block(rows: DataFrame) -> DataFrame:
    return rows.repartition("name", "block").sortWithinPartitions("name", "block", "idx")


def _block_number() -> Column:
    return F.floor(F.col("idx") / F.lit(WIDTH**HEIGHT)).cast("long").alias("block")


NODE_SCHEMA = pa.schema([("name", pa.string()), ("idx", pa.int64()), ("n", pa.int64()), ("digest", pa.string())])
PATH_TYPE = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
PATH_SCHEMA = pa.schema(
    [("name", pa.string()), ("idx", pa.int64()), ("digest", pa.string()), ("path", PATH_TYPE), ("subroot", pa.string()), ("root", pa.string())]
)


def climb(nodes: DataFrame, label: str) -> list[DataFrame]:
    """The stages of all trees over ``nodes(name, idx, n, digest)``: each a row per node, the last one with roots only.

    ``n`` counts a tree's nodes of the stage; trees that are at their root go no further.
    """

    def roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[dict]:
            for block in _blocks(batches):
                n = -(-block[0]["n"] // WIDTH**HEIGHT)
                digest, _ = build([row["digest"] for row in block], _levels_of(block))
                yield {"name": block[0]["name"], "idx": block[0]["block"], "n": n, "digest": digest}

        yield from _out(rows(), NODE_SCHEMA)

    stages = [nodes]
    largest = nodes.agg(F.max("n")).first()[0] or 0
    while len(stages) == 1 or largest > 1:
        unfinished = nodes if len(stages) == 1 else stages[-1].where("n > 1")
        blocks = _by_block(unfinished.select("name", "idx", "n", "digest", _block_number()))
        stages.append(stage(blocks.mapInArrow(roots, NODES), f"{label}-{len(stages)}"))
        largest = -(-largest // WIDTH**HEIGHT)
    return stages


def roots_of(stages: list[DataFrame]) -> DataFrame:
    """The root of each tree: ``name, digest``."""
    done = [upper.where("n = 1").select("name", "digest") for upper in stages[1:]]
    return functools.reduce(DataFrame.unionByName, done)


def _with_heads(nodes: DataFrame, above: DataFrame, extra: list[str]) -> DataFrame:
    """The rows of each block behind one with the path above the block."""
    rows = nodes.select("name", "idx", "n", "digest", *extra, _block_number())
    heads = above.select("name", F.lit(-1).cast("long").alias("idx"), F.col("idx").alias("block"), "path", "subroot", "root")
    return _by_block(rows.unionByName(heads, allowMissingColumns=True))


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, list[dict], Node, int, list[tuple[str, str]]]]:
    """Blocks with their head: the head, the rows, their tree and its levels, and the path above it."""
    for head, *block in _blocks(batches):
        levels = _levels_of(block)
        above = [(step["left"], step["right"]) for step in head["path"]]
        yield head, block, build([row["digest"] for row in block], levels), levels, above


def node_paths(nodes: DataFrame, above: DataFrame) -> DataFrame:
    """``name, idx, digest, path, subroot, root`` of each node by the paths ``above`` the blocks."""

    def paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[dict]:
            for head, block, tree, levels, upper in _unpacked(batches):
                for row, lower in zip(block, neighbours(tree, levels), strict=True):
                    path = [{"left": left, "right": right} for left, right in [*lower, *upper]]
                    found = {"name": row["name"], "idx": row["idx"], "digest": row["digest"], "path": path}
                    yield found | {"subroot": head["subroot"], "root": head["root"]}

        yield from _out(rows(), PATH_SCHEMA, 64)

    return _with_heads(nodes, above, []).mapInArrow(paths, PATHS)


def paths_above(stages: list[DataFrame], tops: DataFrame, label: str) -> DataFrame:
    """The paths above the blocks of the lowest stage, ``name, idx, path, subroot, root`` with the block's number as ``idx``.

    ``tops`` has the same for the root of each tree, ``idx`` being 0.
    """
    columns = ["name", "idx", "path", "subroot", "root"]
    above = None
    for k in range(len(stages) - 1, 0, -1):
        finished = stages[k].where("n = 1").select(F.col("name").alias("tree"))
        found = tops.join(finished, F.col("name").eqNullSafe(F.col("tree")), "left_semi").select(columns)
        if above is not None:
            lower = stage(node_paths(stages[k].where("n > 1"), above), f"{label}-paths")
            found = found.unionByName(lower.select(columns))
        above = found
    return above


def number_leaves(leaves: DataFrame, keep: list[str]) -> DataFrame:
    """``leaves(name, key, digest)`` with ``idx``, the place in their tree's order, and ``n``, the tree's leaves.

    Trees are stretches of one order; what is summed up is a row per tree and partition.
    """
    order = [F.col("name").asc_nulls_first(), F.col("key").asc_nulls_first(), F.col("digest").asc()]
    staged, _ = stage_in_order(leaves, order, "leaves", "place")
    spans = staged.groupBy(part_of("place").alias("part"), F.col("name").alias("tree"))
    spans = spans.agg(F.count("*").alias("here"), F.min(in_part("place")).alias("first"))
    whole = Window.partitionBy("tree")
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("here").over(before), F.lit(0)) - F.col("first")
    spans = spans.select("part", "tree", shift.alias("shift"), F.sum("here").over(whole).alias("n"))
    joined = staged.join(spans, (part_of("place") == F.col("part")) & F.col("name").eqNullSafe(F.col("tree")))
    return joined.select("name", "key", "digest", *keep, (F.col("shift") + in_part("place")).alias("idx"), "n")


def tree_of_trees(subroots: DataFrame) -> DataFrame:
    """The path above each subroot of ``subroots(name, digest)`` to the root of all: ``name, idx, path, subroot, root``."""
    leaves = subroots.select(F.lit(None).cast("string").alias("name"), F.col("name").alias("key"), "digest")
    numbered = stage(number_leaves(leaves, []), "subroots")
    stages = climb(numbered.select("name", "idx", "n", "digest"), "upper")
    nothing = F.array().cast("array<struct<left: string, right: string>>")
    top = roots_of(stages).select(
        "name", F.lit(0).cast("long").alias("idx"), nothing.alias("path"), F.col("digest").alias("subroot"), F.col("digest").alias("root")
    )
    paths = stage(node_paths(numbered, paths_above(stages, top, "upper")), "subroot-paths")
    named = paths.select("idx", "path", F.col("digest").alias("subroot"), "root").join(numbered.select("idx", "key"), "idx")
    return named.select(F.col("key").alias("name"), F.lit(0).cast("long").alias("idx"), "path", "subroot", "root")


def audit(
    docs: DataFrame, columns: list[str], changed: dict[str, Column], tampered: Column, key: str = "doc_id", group: str = "source"
) -> DataFrame:
    """The manifest's proof for each row, held against the row as it is now.

    A leaf is made of ``columns``.  Where ``tampered`` holds, the row is now the one with the
    columns that ``changed`` names replaced.  Per row: the key, ``leaf, subroot, root``,
    ``proof_sha256`` (hash of the nodes beside its way up), ``folded_root``
    (of the row as it is now and those nodes), ``verified`` (it is the
    root), and ``copied``: the nodes that the row's version of the trees does not share
    with the manifest, lowest first; null where the row was not tampered with.
    """
    leaves = docs.select(
        F.col(group).cast("string").alias("name"),
        F.col(key).cast("long").alias("key"),
        leaf_digest([F.col(c) for c in columns]).alias("digest"),
        F.when(tampered, leaf_digest([changed.get(c, F.col(c)) for c in columns])).alias("now"),
    )
    numbered = stage(number_leaves(leaves, ["now"]), "numbered")
    stages = climb(numbered.select("name", "idx", "n", "digest"), "manifest")
    above = paths_above(stages, tree_of_trees(roots_of(stages)), "manifest")

    def proofs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[dict]:
            for head, block, tree, levels, upper in _unpacked(batches):
                beside = "".join(left + right for left, right in upper)
                for place, (row, lower) in enumerate(zip(block, neighbours(tree, levels), strict=True)):
                    copied = None
                    if row["now"] is None:
                        folded = [row["digest"], *fold(row["digest"], [*lower, *upper])][-1]
                    else:
                        version = path_copy(tree, levels, place, row["now"])
                        copied = [*copied_nodes(version, levels, place), *fold(version[0], upper)]
                        folded = [row["now"], *copied][-1]
                    yield {
                        key: row["key"],
                        "leaf": row["digest"],
                        "subroot": head["subroot"],
                        "root": head["root"],
                        "proof_sha256": digest_of("".join(left + right for left, right in lower) + beside),
                        "folded_root": folded,
                        "verified": folded == head["root"],
                        "copied": copied,
                    }

        yield from _out(rows(), schema)

    schema = pa.schema([(key, pa.int64()), *((c, pa.string()) for c in TEXTS), ("verified", pa.bool_()), ("copied", pa.list_(pa.string()))])
    ddl = ", ".join([f"`{key}` long", *(f"{c} string" for c in TEXTS), "verified boolean, copied array<string>"])
    return _with_heads(numbered, above, ["key", "now"]).mapInArrow(proofs, ddl)
