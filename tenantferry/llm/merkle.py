"""Merkle manifest of a dataset as a persistent tree: a tampered leaf makes a version that copies only its ancestors.

A document's leaf hashes its five fields. Leaves of one language stand by id; ``FAN`` consecutive nodes become
their hash until one is left, the language's subroot, and the subroots, by language, form one more tree above. Nulls
come first in either order.

The trees are cut into aligned blocks of ``FAN ** DEEP`` nodes, so a block is a whole subtree and a bounded group. Tier by
tier the blocks' roots become the nodes of the next, dealt out again, until each tree has one node. Then paths come back
down: a block learns what stands beside its root up to the top, one row per block. In a block all versions share
the nodes that their leaf does not lie under; a version owns the path of its leaf, at most ``DEEP`` nodes,
and goes on above the block by hashing itself into the path's siblings. Leaves that are as they were share one path per block.

Positions come from a range partitioning by language and id, numbered by the sums of the parts before, so no
language lies in one task. Rows of equal id stand by their leaf. Other columns are left out, whatever their names;
an empty table has no leaves and no root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tenantferry.session import materialise

FAN, DEEP = 8, 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What stands beside a node at each level up: its place in the run, and the others' digests.
PATH = "array<struct<at: int, others: array<string>>>"


def digest(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(fields: list[Column]) -> Column:
    """The hash of a row's fields, each with its length in bytes before it."""
    def spelled(c: Column) -> Column:
        text = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(spelled, fields)).cast("binary"), 256)


def numbered(rows: DataFrame, tree: str, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """``rows`` dealt by ranges, sorted and written, and for each tree and task where its rows begin.

    ``place`` puts the two together. The second frame has ``tree_key, n`` (the tree's rows) and a row for each tree and task.
    """
    by = [F.col(c).asc_nulls_first() for c in (tree, *order)]
    dealt = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    written = materialise(
        dealt.select("*", F.spark_partition_id().alias("__part"), F.monotonically_increasing_id().alias("__row")), "ordered")
    parts = written.groupBy(F.col(tree).alias("tree_key"), "__part").agg(F.count("*").alias("__n"), F.min("__row").alias("__first"))
    every = Window.partitionBy("tree_key")
    before = every.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    return written, materialise(parts.select(
        "tree_key", F.col("__part").alias("__p"), (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first")).alias("__shift"),
        F.sum("__n").over(every).alias("n")), "starts")


def place(written: DataFrame, tree: str, starts: DataFrame) -> DataFrame:
    """The rows with ``pos``, their place from 0 in their tree, and the columns of ``starts``."""
    # the key holds the task, so a large tree's rows stay spread
    same = written[tree].eqNullSafe(starts["tree_key"]) & (written["__part"] == starts["__p"])
    return written.join(starts, same).withColumn("pos", F.col("__row") + F.col("__shift")).drop("__part", "__row", "__p", "__shift")


def heights(n: int, deep: int) -> int:
    """Levels that a block of a tree of n nodes has."""
    h = 0
    while n > 1 and h < deep:
        n, h = -(-n // FAN), h + 1
    return h


def grown(nodes: list[str], levels: int) -> list[list[str]]:
    """The nodes and all levels above them; a last run is hashed however short it is."""
    out = [nodes]
    for _ in range(levels):
        low = out[-1]
        out.append([digest(low[i:i + FAN]) for i in range(0, len(low), FAN)])
    return out


def beside(tree: list[list[str]], at: int) -> list[tuple[int, list[str]]]:
    """For each level below the top: the node's place in its run and the others there."""
    out = []
    for level in tree[:-1]:
        first = at // FAN * FAN
        run = level[first:first + FAN]
        out.append((at - first, run[:at - first] + run[at - first + 1:]))
        at //= FAN
    return out


def copied(node: str, path: list[tuple[int, list[str]]]) -> list[str]:
    """A version's own nodes above a changed one: at each level the hash of it among the others, which are shared."""
    out = []
    for at, others in path:
        node = digest([*others[:at], node, *others[at:]])
        out.append(node)
    return out


def _block_of(nodes: DataFrame, deep: int) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("pos") / FAN**deep).cast("long"))


def _roots(schema: pa.Schema, deep: int) -> Callable:
    def step(block: pa.Table) -> pa.Table:
        rows = sorted(block.select(["tree", "block", "pos", "n", "digest"]).to_pylist(), key=lambda r: r["pos"])
        r = rows[0]
        top = grown([x["digest"] for x in rows], heights(r["n"], deep))[-1][0]
        return pa.Table.from_pylist([{"tree": r["tree"], "pos": r["block"], "n": -(-r["n"] // FAN**deep), "digest": top}], schema)

    return step


def tiers(nodes: DataFrame, deep: int = DEEP) -> list[DataFrame]:
    """The nodes ``tree, pos, n, digest`` and, tier by tier, the roots of their blocks, until each tree has one node."""
    shape = T.StructType.fromDDL("tree long, pos long, n long, digest string")
    out = [nodes]
    while not out or out[-1].where("n > 1").limit(1).count():
        blocks = _block_of(out[-1], deep)
        up = blocks.groupBy("tree", "block").applyInArrow(_roots(to_arrow_schema(shape), deep), shape)
        out.append(materialise(up, "tier"))
    return out


def _paths(schema: pa.Schema, deep: int) -> Callable:
    """From the path of a block's root to those of its nodes."""
    def step(block: pa.Table, above: pa.Table) -> pa.Table:
        rows = sorted(block.to_pylist(), key=lambda r: r["pos"])
        up, subroot = [(p["at"], p["others"]) for p in above.column("path")[0].as_py()], above.column("subroot")[0].as_py()
        tree = grown([r["digest"] for r in rows], heights(rows[0]["n"], deep))
        out = []
        for i, r in enumerate(rows):
            path = beside(tree, i) + up
            out.append({"tree": r["tree"], "pos": r["pos"], "path": [{"at": a, "others": o} for a, o in path], "subroot": subroot})
        return pa.Table.from_pylist(out, schema)

    return step


def paths(levels: list[DataFrame], tops: DataFrame, deep: int = DEEP) -> DataFrame:
    """``tree, pos, path, subroot`` of the nodes of the lowest of ``levels``; ``tops`` has those of each tree's one node at the top."""
    shape = T.StructType.fromDDL(f"tree long, pos long, path {PATH}, subroot string")
    for nodes in reversed(levels[:-1]):
        above = tops.select("tree", F.col("pos").alias("block"), "path", "subroot")
        tops = materialise(
            _block_of(nodes, deep).select("tree", "pos", "n", "digest", "block").groupBy("tree", "block")
            .cogroup(above.groupBy("tree", "block")).applyInArrow(_paths(to_arrow_schema(shape), deep), shape), "paths")
    return tops


def _versions(schema: pa.Schema, deep: int) -> Callable:
    def step(block: pa.Table, above: pa.Table) -> pa.Table:
        rows = sorted(block.to_pylist(), key=lambda r: r["pos"])
        up, subroot = [(p["at"], p["others"]) for p in above.column("path")[0].as_py()], above.column("subroot")[0].as_py()
        tree = grown([r["digest"] for r in rows], heights(rows[0]["n"], deep))
        upper = "".join(o for _, others in up for o in others)
        shared = copied(tree[-1][0], up)
        root = [tree[-1][0], *shared][-1]
        out = []
        for i, r in enumerate(rows):
            inside = beside(tree, i)
            proof = hashlib.sha256("".join(o for _, others in inside for o in others).encode())
            proof.update(upper.encode())
            own: list[str] = []
            if r["changed"] is not None and r["changed"] != r["digest"]:
                own = [r["changed"], *copied(r["changed"], inside)]
                own += copied(own[-1], up)
            out.append({
                "doc_id": r["doc_id"], "leaf": r["digest"], "root": root, "proof_sha256": proof.hexdigest(),
                "copies": own, "folded_root": own[-1] if own else root, "subroot": subroot})
        return pa.Table.from_pylist(out, schema)

    return step


def versions(leaves: DataFrame, deep: int = DEEP) -> DataFrame:
    """Per leaf its proof and, if ``changed`` differs from it, the version with that leaf: its own nodes and its root.

    leaves: ``lang, doc_id, digest, changed``; ``changed`` is null for leaves that stay as they are.
    Result: ``doc_id, leaf, subroot, root, proof_sha256, copies, folded_root``; ``copies`` go from the new leaf to the new root,
    and are all that the version does not share.
    """
    ids = leaves.schema["doc_id"].dataType.simpleString()
    written, starts = numbered(leaves, "lang", ["doc_id", "digest"])
    langs = starts.groupBy(F.col("tree_key").alias("name")).agg(F.max("n").alias("leaves")).withColumn("all", F.lit(0))
    listed, at = numbered(langs, "all", ["name"])
    named = materialise(place(listed, "all", at).select("name", F.col("pos").alias("tree"), F.col("n").alias("n_trees")), "trees")
    here = starts.join(named.select("name", "tree"), starts["tree_key"].eqNullSafe(F.col("name"))).drop("name")
    nodes = materialise(place(written, "lang", here).select("tree", "pos", "n", "digest", "doc_id", "changed"), "leaves")

    low = tiers(nodes.select("tree", "pos", "n", "digest"), deep)
    subroots = low[-1].select("tree", F.col("digest").alias("subroot"))
    top = materialise(subroots.join(named, "tree").select(
        F.lit(0).cast("long").alias("tree"), F.col("tree").alias("pos"), F.col("n_trees").alias("n"), F.col("subroot").alias("digest")), "subroots")
    high = tiers(top, deep)
    over = paths(high, high[-1].select("tree", "pos", F.array().cast(PATH).alias("path"), F.lit(None).cast("string").alias("subroot")), deep)
    tops = over.select(F.col("pos").alias("tree"), F.lit(0).cast("long").alias("pos"), "path").join(subroots, "tree")
    # the leaves' own blocks are left to the last step, which makes no list of paths per leaf
    above = paths(low[1:], tops, deep) if len(low) > 1 else tops
    shape = T.StructType.fromDDL(f"doc_id {ids}, leaf string, subroot string, root string, proof_sha256 string, copies array<string>, folded_root string")
    blocks = _block_of(nodes, deep).groupBy("tree", "block")
    over_blocks = above.select("tree", F.col("pos").alias("block"), "path", "subroot").groupBy("tree", "block")
    return blocks.cogroup(over_blocks).applyInArrow(_versions(to_arrow_schema(shape), deep), shape)


def documents(docs: DataFrame) -> DataFrame:
    """Proofs of all documents, and the versions made by lower-casing A-Z in the texts whose id's CRC-32 is divisible by 3."""
    plain = [F.col(c) for c in FIELDS]
    lower = F.translate(F.col("text"), CAPITALS, SMALL)
    # a null id has no decimal digits, and is left as it is
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    leaves = docs.select("lang", "doc_id", leaf(plain).alias("digest"), F.when(hit, leaf([*plain[:4], lower])).alias("changed"))
    return versions(leaves).withColumn("verified", F.col("folded_root") == F.col("root"))
