"""Sharding: a k-d tree over metadata, split at weighted medians until the leaves reach the target bytes.

Each row is a point with integer coordinates. A node that is due m leaves is split along its widest
dimension (relative to the whole table's width) so that its parts weigh as m // 2 to the rest. The cut is found by rounds
of bounded histograms over all rows: each round adds up the weight in at most ``BINS`` bins of every
open node, and the next looks into the bin where the cut lies, until the bin weighs next to nothing or
holds a single value. Rows of a single value, such as a hot source, are cut by a hash of the row instead,
so that no value is too heavy to be shared out. All nodes of a level go through the rounds together, and what
the driver gets is a histogram for each of them, whatever the number of rows.

Null metadata sort first. Points equal in everything, tie included, share a leaf. An empty table has no rows in any shard.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenantferry.session import materialise

BINS = 1024
#: A cut may miss its place by this share of the node's weight.
SLACK = 0.0005
TIE_BITS = 60
#: A group of equal texts larger than this part of a shard is not kept together.
SHARED = 8
#: Rows of a shard that are numbered together.
NUMBERED = 100_000


def prefix(text: Column) -> Column:
    """A long that sorts as the text's first seven bytes do; null sorts first."""
    return F.when(text.isNull(), F.lit(-1)).otherwise(F.conv(F.hex(F.rpad(F.encode(text, "utf-8"), 7, F.lit(b"\0"))), 16, 10).cast("long"))


@dataclass
class Node:
    number: int
    leaves: int
    first: int  # number of its first leaf
    weight: int = 0
    #: The dimension, and the last coordinate and tie of the lower part.
    cut: tuple[int, int, int] | None = None
    low: Node | None = None
    high: Node | None = None


def _case(nodes: list, value) -> Column:
    """value(node) for the row's node, looked up in a constant map."""
    return F.element_at(F.create_map(*(F.lit(x) for n in nodes for x in (n.number, value(n)))), F.col("node"))


def _locate(rows: DataFrame, open_: list[Node], column: Column, within: Column, lo: dict[int, int], hi: dict[int, int], need: dict[int, float]) -> dict[int, int]:
    """For each node the least x so that the rows of ``within`` with column <= x weigh about ``need`` of it."""
    below = dict.fromkeys(lo, 0.0)
    found: dict[int, int] = {}
    while pending := [n for n in open_ if n.number in lo and n.number not in found]:
        width = {n.number: max(1, -(-(hi[n.number] - lo[n.number] + 1) // BINS)) for n in pending}
        base, step = _case(pending, lambda n: lo[n.number]), _case(pending, lambda n: width[n.number])
        top = _case(pending, lambda n: hi[n.number])
        here = rows.filter(F.col("node").isin([n.number for n in pending]) & within & (column >= base) & (column <= top))
        offset = column - base
        bins = here.groupBy("node", ((offset - F.pmod(offset, step)) / step).cast("long").alias("bin")).agg(F.sum("weight").alias("w"))
        sums: dict[int, list[tuple[int, int]]] = {}
        for r in bins.collect():  # BINS rows for each node at most
            sums.setdefault(r["node"], []).append((r["bin"], int(r["w"])))
        for n in pending:
            k, total = n.number, below[n.number]
            for b, w in sorted(sums.get(k, [])):
                if total + w >= need[k] or b == max(sums[k])[0]:
                    if width[k] == 1 or w <= SLACK * n.weight:
                        found[k] = lo[k] + (b + 1) * width[k] - 1
                        # the nearer edge of a light bin
                        if width[k] > 1 and need[k] - total < total + w - need[k]:
                            found[k] = lo[k] + b * width[k] - 1
                    else:
                        lo[k], hi[k], below[k] = lo[k] + b * width[k], min(hi[k], lo[k] + (b + 1) * width[k] - 1), total
                    break
                total += w
            else:
                found[k] = hi[k]
    return found


def _split(rows: DataFrame, open_: list[Node], dims: list[str], whole: list[tuple[int, int]]) -> None:
    """Give each open node a cut, or none if all its rows are equal."""
    stats = rows.filter(F.col("node").isin([n.number for n in open_])).groupBy("node").agg(
        F.sum("weight").alias("w"), *(x for i, d in enumerate(dims) for x in (F.min(d).alias(f"lo{i}"), F.max(d).alias(f"hi{i}"))))
    by = {r["node"]: r for r in stats.collect()}
    open_[:] = [n for n in open_ if n.number in by]
    axis, lo, hi, need = {}, {}, {}, {}
    for n in open_:
        r = by[n.number]
        n.weight = int(r["w"])
        spread = [(r[f"hi{i}"] - r[f"lo{i}"]) / max(1, b - a) for i, (a, b) in enumerate(whole)]
        axis[n.number] = max(range(len(dims)), key=lambda i: (spread[i], -i))
        lo[n.number], hi[n.number] = r[f"lo{axis[n.number]}"], r[f"hi{axis[n.number]}"]
        need[n.number] = n.weight * (n.leaves // 2) / n.leaves
    if not open_:
        return
    which = _case(open_, lambda n: axis[n.number])
    value = F.element_at(F.array(*dims), which + 1)
    cut = _locate(rows, open_, value, F.lit(True), dict(lo), dict(hi), need)
    # what weighs less than, and exactly, the cut's value
    at = _case(open_, lambda n: cut[n.number])
    sides = rows.filter(F.col("node").isin([n.number for n in open_])).groupBy("node").agg(
        F.sum(F.when(value < at, F.col("weight")).otherwise(0)).alias("less"), F.sum(F.when(value == at, F.col("weight")).otherwise(0)).alias("same"))
    weigh = {r["node"]: (int(r["less"]), int(r["same"])) for r in sides.collect()}
    tied = [n for n in open_ if weigh[n.number][1] > SLACK * n.weight]
    ties = {}
    if tied:
        limits = {n.number: need[n.number] - weigh[n.number][0] for n in tied}
        ties = _locate(rows, tied, F.col("tie"), value == at, {n.number: 0 for n in tied}, {n.number: (1 << TIE_BITS) - 1 for n in tied}, limits)
    for n in open_:
        n.cut = (axis[n.number], cut[n.number], ties.get(n.number, (1 << TIE_BITS) - 1))


def _descend(rows: DataFrame, split: list[Node], dims: list[str]) -> DataFrame:
    at = {n.number: n.cut for n in split}
    d, c, t = (_case(split, lambda n, i=i: at[n.number][i]) for i in range(3))
    value = F.element_at(F.array(*dims), d + 1)
    low = (value < c) | ((value == c) & (F.col("tie") <= t))
    child = F.when(low, _case(split, lambda n: n.low.number)).otherwise(_case(split, lambda n: n.high.number))
    return rows.withColumn("node", F.when(F.col("node").isin(list(at)), child).otherwise(F.col("node")))


def assign(points: DataFrame, dims: list[str], target: int | None = None, leaves: int | None = None) -> DataFrame:
    """``points`` with ``shard``: the leaf of each row.

    points: a materialised table with long columns ``dims``, ``weight`` and ``tie`` (from 0 to 2**TIE_BITS - 1).
    target: weight that a leaf should reach; or leaves: their number.
    """
    total = points.agg(F.sum("weight").alias("w"), *(x for d in dims for x in (F.min(d), F.max(d)))).first()
    if total["w"] is None:
        return points.withColumn("shard", F.lit(0))
    whole = [(total[1 + 2 * i], total[2 + 2 * i]) for i in range(len(dims))]
    m = leaves or max(1, math.ceil(int(total["w"]) / target))
    root = Node(0, m, 0)
    rows = points.withColumn("node", F.lit(0))
    level, ends, numbered = [root], [], 1
    while level:
        ends += [n for n in level if n.leaves == 1]
        open_ = [n for n in level if n.leaves > 1]
        _split(rows, open_, dims, whole)
        split = [n for n in open_ if n.cut]
        level = []
        for n in split:
            n.low = Node(numbered, n.leaves // 2, n.first)
            n.high = Node(numbered + 1, n.leaves - n.leaves // 2, n.first + n.leaves // 2)
            numbered += 2
            level += [n.low, n.high]
        if split:
            rows = materialise(_descend(rows, split, dims), "kd-level")
    return rows.withColumn("shard", _case(ends, lambda n: n.first)).drop("node")


def numbered(rows: DataFrame, shard: str, order: list[str], name: str = "slot", together: int = NUMBERED) -> DataFrame:
    """Number the rows of each shard from 0 without a gap, ``together`` or so of them in one task."""
    parts = max(1, rows.count() // together + 1)
    dealt = rows.withColumn("__part", F.pmod(F.xxhash64(*order), F.lit(parts)))
    sizes = dealt.groupBy(shard, "__part").agg(F.count("*").alias("__n"))
    earlier = Window.partitionBy(shard).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select(shard, "__part", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    inside = Window.partitionBy(shard, "__part").orderBy(*order)
    return dealt.join(before, [shard, "__part"]).select(*rows.columns, (F.col("__before") + F.row_number().over(inside) - 1).alias(name))


def _ordered_id(column: Column, kind: T.DataType) -> Column:
    number = column.cast("long") if isinstance(kind, T.NumericType) else prefix(column.cast("string"))
    return F.coalesce(number, F.lit(-1))


def documents(docs: DataFrame, leaves: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, size, text_crc32, shard, slot, by bytes of text over source, language, size and id.

    The size is that of the UTF-8 text and 1; a null text has no bytes. Documents of equal text are one group and share a
    shard, placed by their smallest id as one point of all their bytes. Only a group of over ``1 / SHARED`` of a shard,
    by bytes or by rows, is shared out row by row, as it would tip the balance; there are at most ``2 * SHARED * leaves``.
    Ids may be of any type; text ids stand by their first bytes.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    has = set(docs.columns)
    name = lambda c: prefix(F.col(c).cast("string")) if c in has else F.lit(0).cast("long")
    dims = ["d_source", "d_lang", "d_size", "d_id"]
    rows = materialise(docs.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(F.sha2(text.cast("binary"), 256)).alias("key"), F.monotonically_increasing_id().alias("row"),
        name("source").alias("d_source"), name("lang").alias("d_lang"), _ordered_id(F.col(id_col), docs.schema[id_col].dataType).alias("d_id"),
    ).withColumn("d_size", F.col("size")), "rows")
    groups = rows.groupBy("key").agg(
        F.sum("size").alias("weight"), F.count("*").alias("n"), F.min(F.struct("d_id", "d_source", "d_lang", "d_size")).alias("at"))
    groups = materialise(groups.select("key", "weight", "n", "at.*"), "groups")
    whole = groups.agg(F.sum("weight").alias("w"), F.sum("n").alias("n")).first()
    share = leaves * SHARED
    large = (F.col("weight") * share > (whole["w"] or 0)) | (F.col("n") * share > (whole["n"] or 0))
    out = F.broadcast(groups.where(large).where("n > 1").select("key"))
    single = rows.join(out, "key").select(F.col("row").alias("point"), F.lit(True).alias("alone"), F.col("size").alias("weight"), "doc_id", "key", *dims)
    joint = groups.join(out, "key", "left_anti").select(F.col("key").alias("point"), F.lit(False).alias("alone"), "weight", F.lit(None).cast(docs.schema[id_col].dataType).alias("doc_id"), "key", *dims)
    # rows repeated with id and text differ in the last bits alone
    tie = F.shiftleft(F.xxhash64("doc_id", "key").bitwiseAND(F.lit((1 << (TIE_BITS - 20)) - 1)), 20).bitwiseOR(F.xxhash64("point").bitwiseAND(F.lit((1 << 20) - 1)))
    points = materialise(single.unionByName(joint).withColumn("tie", tie).select("point", "alone", "weight", "tie", *dims), "points")
    placed = assign(points, dims, leaves=leaves).select("point", "alone", F.col("shard").alias("to"))
    split = rows.join(out, "key", "left_semi").withColumn("alone", F.lit(True)).withColumn("point", F.col("row"))
    kept = rows.join(out, "key", "left_anti").withColumn("alone", F.lit(False)).withColumn("point", F.col("key"))
    all_ = split.unionByName(kept).join(placed, ["alone", "point"]).select("doc_id", "size", "text_crc32", F.col("to").alias("shard"), "key", "row")
    return numbered(materialise(all_, "placed"), "shard", ["key", "row"]).drop("key", "row")
