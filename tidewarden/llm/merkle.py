"""Merkle manifest of a dataset as a persistent tree with copied paths.

Every document is a leaf digest. The leaves of a group lie in order; while several nodes remain, each
two consecutive ones become the digest of both, the last one alone if it has no partner. What remains
is the group's root, and the groups' roots, in the order of their names, make the dataset's root in
the same way.

The tree is stored in aligned blocks of ``2 ** BITS`` nodes, a row each, so no task holds a whole
level: blocks of leaves give the nodes of the next step, blocks of those the next, until each group
has one. On the way down each block gets the siblings of its ancestors (``path``). A changed leaf is a
version of its own: inside its block only its ancestors are copied, and every other node is shared with
the original; the version goes on above its block as a row with the block's path, so versions of one
block are spread like rows. ``verify`` gives each leaf its proof and the root of its version,
``copied_nodes`` the nodes that versions don't share.

Places of leaves come from ranges of (group, id, digest), whose counts are added up, so a group with
a third of all rows lies in many tasks. Nulls are ``-`` in a leaf; a null group comes before all others and
a null id before all other ids of its group. Rows with equal ids lie in the order of their digests
(then of their changed digests), repeated rows side by side; each is a leaf. Long texts are hashed
whole by Spark. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidewarden.llm.common import ship_package, written

BITS = 10
# What a document's digest covers, in this order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_NODE = "struct<place:bigint,id:bigint,digest:string,changed:string>"
_BLOCK = f"tree string, block bigint, nodes array<{_NODE}>, n bigint, top string"


def leaf_digest(*fields: Column) -> Column:
    """Digest of the fields' texts, each with its length in bytes before it; ``-`` for a null."""
    parts = [F.coalesce(F.concat(F.octet_length(f.cast("string")).cast("string"), F.lit(":"),
                                 f.cast("string")), F.lit("-")) for f in fields]
    return F.sha2(F.concat(*parts), 256)


def node(children: list[str]) -> str:
    return hashlib.sha256("".join(children).encode()).hexdigest()


def height(n: int) -> int:
    """Levels above n nodes."""
    return max(n - 1, 0).bit_length()


def levels_of(digests: list[str], rise: int) -> list[list[str]]:
    """The digests and the ``rise`` levels above them."""
    levels = [digests]
    for _ in range(rise):
        below = levels[-1]
        levels.append([node(below[i:i + 2]) for i in range(0, len(below), 2)])
    return levels


def siblings(levels: list[list[str]], at: int) -> list[str]:
    """For each level below the last the other digest of the pair, after ``<`` if it comes first and
    ``>`` if second; the empty text where there is none."""
    path = []
    for level in levels[:-1]:
        other = at ^ 1
        path.append(("<" if other < at else ">") + level[other] if other < len(level) else "")
        at >>= 1
    return path


def copy_path(digest: str, path: list[str]) -> list[str]:
    """The new ancestors of a node that became ``digest``, lowest first."""
    copied = []
    for sibling in path:
        other = sibling[1:]
        pair = [other, digest] if sibling.startswith("<") else [digest, other]
        digest = node(pair if other else [digest])
        copied.append(digest)
    return copied


def place(rows: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """The rows with their ``place`` in their tree (from 0) and its number of rows ``n``."""
    ranged = written(rows.repartitionByRange(tree, *order).sortWithinPartitions(tree, *order)
                     .withColumn("part", F.spark_partition_id())
                     .withColumn("row", F.monotonically_increasing_id()), "ranged")
    counts = ranged.groupBy("part", tree).agg(F.count("*").alias("rows"), F.min("row").alias("first"))
    # At most a row for each range and tree; of one tree, for each range.
    earlier = Window.partitionBy(tree).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = written(counts.select(
        "part", tree, (F.coalesce(F.sum("rows").over(earlier), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("rows").over(Window.partitionBy(tree)).alias("n")), "shifts")
    return ranged.join(shifts, ["part", tree]).select(
        "*", (F.col("row") + F.col("shift")).alias("place")).drop("part", "row", "shift")


def _mapped(rows: DataFrame, of: Callable[[dict], Iterator[dict]], schema: str) -> DataFrame:
    """The rows that ``of`` makes of each row."""
    types = T.StructType.fromDDL(schema)
    arrow = to_arrow_schema(types)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                made = list(of(batch.slice(i, 1).to_pylist()[0]))
                if made:
                    yield pa.RecordBatch.from_pylist(made, schema=arrow)

    ship_package(rows.sparkSession)
    return rows.mapInArrow(run, types)


def _levels(row: dict, bits: int) -> list[list[str]]:
    """A block's nodes and the levels above them, up to its own node."""
    return levels_of([n["digest"] for n in row["nodes"]], min(bits, height(row["n"])))


def _closed(bits: int, row: dict) -> Iterator[dict]:
    yield row | {"top": _levels(row, bits)[-1][0]}


def _child_paths(bits: int, row: dict) -> Iterator[dict]:
    levels = _levels(row, bits)
    for at, child in enumerate(row["nodes"]):
        yield {"tree": row["tree"], "block": child["place"], "path": siblings(levels, at) + row["path"],
               "root": row["root"]}


def block_paths(nodes: DataFrame, bits: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of nodes (tree, place, n, id, digest, changed): the blocks of them, for each of these the
    siblings above it up to its tree's root (``path``), and the trees' roots (tree, root)."""
    steps: list[DataFrame] = []
    while True:
        blocks = nodes.groupBy("tree", F.shiftright("place", bits).alias("block")).agg(
            F.sort_array(F.collect_list(F.struct("place", "id", "digest", "changed"))).alias("nodes"),
            F.max("n").alias("n"))
        steps.append(written(_mapped(blocks.withColumn("top", F.lit(None).cast("string")),
                                     functools.partial(_closed, bits), _BLOCK), "blocks"))
        most = steps[-1].agg(F.max("n")).first()[0] or 0
        if most <= 1 << bits:
            break
        # A tree that is done goes along as its only node.
        nodes = steps[-1].select(
            "tree", F.col("block").alias("place"), F.lit(None).cast("long").alias("id"),
            F.col("top").alias("digest"), F.lit(None).cast("string").alias("changed"),
            F.ceil(F.col("n") / (1 << bits)).alias("n"))
    roots = written(steps[-1].select("tree", F.col("top").alias("root")), "roots")
    paths = roots.select("tree", F.lit(0).cast("long").alias("block"),
                         F.array().cast("array<string>").alias("path"), "root")
    for blocks in reversed(steps[1:]):
        paths = written(_mapped(blocks.hint("merge").join(paths, ["tree", "block"]),
                                functools.partial(_child_paths, bits), "tree string, block bigint, path array<string>, root string"), "paths")
    return steps[0], paths, roots


def build(leaves: DataFrame, bits: int = BITS) -> DataFrame:
    """The blocks of leaves of (tree, id, digest, changed), with the siblings above each up to the
    dataset's root (``path``), its tree's root (``subroot``) and the ``root``."""
    leaves = written(leaves, "leaves")
    blocks, paths, subroots = block_paths(
        place(leaves, "tree", ["id", "digest", "changed"]), bits)
    names = place(subroots.select(F.lit("").alias("tree"), F.lit(None).cast("long").alias("id"),
                                  F.col("root").alias("digest"), F.col("tree").alias("changed")),
                  "tree", ["changed"])
    name_blocks, name_paths, _ = block_paths(names, bits)
    above = _mapped(name_blocks.join(name_paths, ["tree", "block"]),
                    functools.partial(_name_paths, bits), "tree string, above array<string>, whole string")
    # Paths grow with the leaves, the trees' names don't as a rule: Spark checks their size.
    return blocks.hint("merge").join(paths.withColumnRenamed("root", "subroot"), ["tree", "block"]).join(
        written(above, "names"), "tree").select(
            "tree", "block", "nodes", "n", "top", F.concat("path", "above").alias("path"),
            F.size("path").alias("inner"), "subroot", F.col("whole").alias("root"))


def _name_paths(bits: int, row: dict) -> Iterator[dict]:
    levels = _levels(row, bits)
    for at, child in enumerate(row["nodes"]):
        yield {"tree": child["changed"], "above": siblings(levels, at) + row["path"],
               "whole": row["root"]}


def _verified(bits: int, row: dict) -> Iterator[dict]:
    levels = _levels(row, bits)
    shared = copy_path(row["top"], row["path"])
    for at, leaf in enumerate(row["nodes"]):
        inside = siblings(levels, at)
        now = leaf["changed"] or leaf["digest"]
        copied = [now, *copy_path(now, inside)]
        # A version whose copies end up as the block's own digest shares the rest.
        upper = shared if copied[-1] == row["top"] else copy_path(copied[-1], row["path"])
        proof = [s[1:] for s in inside + row["path"]]
        folded = (copied + upper)[-1]
        yield {"id": leaf["id"], "leaf": leaf["digest"], "subroot": row["subroot"], "root": row["root"],
               "proof": [s for s in proof if s], "folded_root": folded,
               "verified": folded == row["root"]}


def verify(tree: DataFrame, bits: int = BITS) -> DataFrame:
    """Of ``build`` with the same ``bits``: for each leaf the siblings up to the root, lowest first, and
    the root of its version."""
    return _mapped(tree, functools.partial(_verified, bits), "id bigint, leaf string, subroot string, root string, "
                                    "proof array<string>, folded_root string, verified boolean")


def _copied(bits: int, row: dict) -> Iterator[dict]:
    levels = _levels(row, bits)
    for at, leaf in enumerate(row["nodes"]):
        if leaf["changed"] is not None and leaf["changed"] != leaf["digest"]:
            nodes = [leaf["changed"], *copy_path(leaf["changed"], siblings(levels, at) + row["path"])]
            for level, digest in enumerate(nodes):
                yield {"tree": row["tree"], "version": leaf["place"], "level": level, "digest": digest}


def copied_nodes(tree: DataFrame, bits: int = BITS) -> DataFrame:
    """Of ``build`` with the same ``bits``: the nodes that the version of each changed leaf (its place in its tree) doesn't
    share with the original, from the leaf (level 0) to the root. Levels go on through the tree of roots.
    """
    return _mapped(tree, functools.partial(_copied, bits), "tree string, version bigint, level int, digest string")


def document_leaves(docs: DataFrame, tampered: Column) -> DataFrame:
    """Leaves of documents, a tree for each language; ``tampered`` ones with 1 more in n_chars."""
    fields = [F.col(c) for c in FIELDS]
    more = [(f + 1).cast("long") if c == "n_chars" else f for c, f in zip(FIELDS, fields, strict=True)]
    return docs.select(
        F.coalesce(F.concat(F.lit("="), "lang"), F.lit("")).alias("tree"),
        F.col("doc_id").cast("long").alias("id"), leaf_digest(*fields).alias("digest"),
        F.when(tampered, leaf_digest(*more)).alias("changed"))
