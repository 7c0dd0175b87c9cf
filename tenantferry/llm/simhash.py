"""SimHash near-duplicates: fingerprints of word shingles, linked where few bits differ.

Linking works on distinct fingerprints. Two of them that differ in at most k bits agree in one of k + 1
parts of the bits, so equal parts decide which fingerprints meet: an equi-key, never a pair of everything.
A part that too many fingerprints share is split anew by the bits not yet fixed, exactly and at most a few
times, until every block is small. Inside a block the fingerprints are sorted by Gray rank, neighbours are
factored into nodes that hold the bits all members share (a node keeps only what its parent does not fix
already), and a search goes down with the differences added up so far, leaving out whole nodes beyond k.
A block returns a spanning forest of its links, not all pairs, so large groups of near copies stay linear.
Components are then found by alternating star contraction, each round written to the shared folder.

Null and empty texts have fingerprint zero and are linked like any other. Repeated rows each get a result.
A null id takes part in links; the smallest id is taken over those that are not null.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenantferry.llm.common import empty_like, utf8
from tenantferry.session import materialise

SHINGLE, SEED, MAX_BITS = 3, 42, 3
#: Fingerprints in a block at most, before it is split by further bits.
BLOCK = 4096
FANOUT = 8
#: Search states held at once.
FRONTIER = 1 << 20


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The unsigned 64-bit SimHash of a text's word shingles; 0 without words."""
    words = text.lower().split()  # of bytes: A-Z only, and white space as in ASCII
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.append(0, ends[:n - 1] + 1).tolist()
    ends = ends[-n:].tolist()
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, map(line.__getitem__, map(slice, starts, ends)), repeat(seed)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        bits = np.unpackbits(hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def _fingerprints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield pd.Series(np.array([fingerprint(x) for x in texts], np.uint64).view(np.int64))


def fingerprints(text: Column) -> Column:
    """The fingerprint as a signed long with the same bits."""
    return F.pandas_udf(_fingerprints, "long")(utf8(text))


def as_hex(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def gray_rank(x: np.ndarray) -> np.ndarray:
    """The place of each 64-bit word in the reflected Gray order."""
    for shift in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> np.uint64(shift))
    return x


class GrayIndex:
    """Nodes over fingerprints sorted by block and Gray rank; ``levels`` go from the leaves to a root for each block."""

    def __init__(self, block: np.ndarray, prints: np.ndarray) -> None:
        order = np.lexsort((gray_rank(prints), block))
        self.prints, block = prints[order], block[order]
        n = len(prints)
        every = np.uint64(0xFFFFFFFFFFFFFFFF)
        level = {"all": self.prints, "any": self.prints, "end": np.arange(1, n + 1), "block": block, "child": None}
        self.levels = [level]
        while (level["block"][1:] == level["block"][:-1]).any():
            owner = level["block"]
            at = np.arange(len(owner))
            first = np.ones(len(owner), bool)
            first[1:] = owner[1:] != owner[:-1]
            within = at - np.maximum.accumulate(np.where(first, at, 0))
            starts = np.flatnonzero(within % FANOUT == 0)
            level = {
                "all": np.bitwise_and.reduceat(level["all"], starts), "any": np.bitwise_or.reduceat(level["any"], starts),
                "end": level["end"][np.append(starts[1:], len(owner)) - 1], "block": owner[starts],
                "child": np.append(starts, len(owner)),
            }
            self.levels.append(level)
        for x in self.levels:
            x["shared"] = ~(x["all"] ^ x["any"])
        for child, parent in zip(self.levels, self.levels[1:]):
            fixed = np.repeat(parent["shared"], np.diff(parent["child"]))
            child["own"] = child["shared"] & ~fixed & every
        self.levels[-1]["own"] = self.levels[-1]["shared"]
        self.roots = np.searchsorted(self.levels[-1]["block"], block)

    def links(self, lo: int, hi: int, most: int) -> tuple[np.ndarray, np.ndarray]:
        """For the fingerprints lo to hi: (i, j) with i < j in one block and at most ``most`` differing bits."""
        query = np.arange(lo, hi)
        node = self.roots[lo:hi]
        top = self.levels[-1]
        gone = np.bitwise_count((self.prints[query] ^ top["all"][node]) & top["own"][node])
        for level in range(len(self.levels) - 1, 0, -1):
            parent, child = self.levels[level], self.levels[level - 1]
            fan = parent["child"][node + 1] - parent["child"][node]
            below = np.repeat(parent["child"][node] - np.cumsum(fan) + fan, fan) + np.arange(fan.sum())
            query, gone, node = np.repeat(query, fan), np.repeat(gone, fan), below
            later = child["end"][node] > query + 1
            query, gone, node = query[later], gone[later], node[later]
            gone = gone + np.bitwise_count((self.prints[query] ^ child["all"][node]) & child["own"][node])
            near = gone <= most
            query, gone, node = query[near], gone[near], node[near]
        pair = node > query
        return query[pair], node[pair]


def _merge(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest position reachable, after more links."""
    while True:
        a, b = label[i], label[j]
        open_ = a != b
        if not open_.any():
            return label
        i, j, a, b = i[open_], j[open_], a[open_], b[open_]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (jumped := label[label] != label).any():
            label[jumped] = label[label[jumped]]


def forest(block: np.ndarray, prints: np.ndarray, most: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Links (a, b) that join what is linked within the blocks, one for each member but the first of a group."""
    if not len(prints):
        return prints, prints
    index = GrayIndex(block, prints)
    label = np.arange(len(prints))
    sizes = np.bincount(index.roots)[index.roots]
    work = np.cumsum(np.minimum(sizes, BLOCK))
    lo = 0
    while lo < len(prints):
        hi = max(lo + 1, int(np.searchsorted(work, (work[lo - 1] if lo else 0) + FRONTIER)))
        label = _merge(label, *index.links(lo, min(hi, len(prints)), most))
        lo = hi
    joined = np.flatnonzero(label != np.arange(len(prints)))
    return index.prints[joined], index.prints[label[joined]]


def _block_links(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Links within the blocks of a partition that is sorted by block; a block may go on in the next batch."""
    held = np.empty((0, 3), np.int64)

    def out(rows: np.ndarray) -> pa.RecordBatch:
        change = np.ones(len(rows), bool)
        change[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
        a, b = forest(np.cumsum(change), rows[:, 2].astype(np.uint64), most)
        return pa.record_batch([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    for batch in batches:
        rows = np.stack([batch.column(k).to_numpy() for k in ("mask", "key", "fp")], axis=1)
        held = np.concatenate([held, rows])
        if len(held):
            last = np.flatnonzero((held[:, :2] != held[-1, :2]).any(axis=1))
            cut = int(last[-1]) + 1 if len(last) else 0
            if cut:
                yield out(held[:cut])
                held = held[cut:]
    if len(held):
        yield out(held)


def _parts(fixed: int, n: int) -> list[int]:
    """The bits not fixed, dealt in order to n masks of near equal size, each joined with the fixed ones."""
    free = [k for k in range(64) if not fixed >> k & 1]
    cuts = [round(i * len(free) / n) for i in range(n + 1)]
    return [fixed | sum(1 << k for k in free[a:b]) for a, b in zip(cuts, cuts[1:]) if b > a]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def blocks(prints: DataFrame, most: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """(mask, key, fp): the fingerprints by each part of their bits, with large blocks split by further bits."""
    done, level = [], [0]
    rows = prints.select("fp", F.lit(0).cast("long").alias("mask"))
    while True:
        finer = {m: _parts(m, most + 1) for m in level}
        pairs = [x for m, parts in finer.items() for x in (F.lit(_signed(m)), F.array(*(F.lit(_signed(p)) for p in parts)))]
        masks = F.element_at(F.create_map(*pairs), F.col("mask"))
        rows = rows.select("fp", F.explode(masks).alias("mask"))
        rows = rows.select(F.col("mask"), F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp")
        level = sorted({p for parts in finer.values() for p in parts})
        if all(64 - m.bit_count() <= block.bit_length() - 1 for m in level):  # too few free bits for a large block
            return _all(done + [rows])
        hot = materialise(rows.groupBy("mask", "key").count().filter(F.col("count") > block).select("mask", "key"), "hot-blocks")
        if hot.isEmpty():
            return _all(done + [rows])
        done.append(rows.join(hot, ["mask", "key"], "left_anti"))
        rows = rows.join(hot, ["mask", "key"], "left_semi").select("fp", "mask")


def _all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for x in frames[1:]:
        out = out.unionByName(x)
    return out


def links(prints: DataFrame, most: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """(a, b): links among distinct fingerprints ``fp`` that join exactly what is linked by ``most`` bits or fewer."""
    dealt = blocks(prints, most, block).repartition("mask", "key").sortWithinPartitions("mask", "key")
    return dealt.mapInArrow(lambda x: _block_links(x, most), "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(v, root): each linked vertex and the smallest one it is linked with, by alternating star contraction."""
    spark = edges.sparkSession
    state = None
    now = materialise(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "links")
    while True:
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == state or not seen[0]:
            break
        state = seen
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialise(large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
        now = materialise(small.select(F.col("e.v").alias("u"), F.col("e.m").alias("v")).filter("u <> v").distinct(), "small-star")
    if not state:
        return empty_like(spark, "v long, root long")
    return now.select(F.col("u").alias("v"), F.col("v").alias("root"))


def text_hash(text: Column) -> Column:
    return F.md5(utf8(text))


def _labelled(docs: DataFrame, most: int, id_col: str, text_col: str) -> DataFrame:
    """One row per document: doc_id, text_hash, fp, root (of its group, of its own for each group) and component_id."""
    columns = F.col(id_col).alias("doc_id"), text_hash(F.col(text_col)).alias("text_hash"), fingerprints(F.col(text_col)).alias("fp")
    prints = materialise(docs.select(*columns), "fingerprints")
    classes = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "classes")
    found = components(links(classes.select("fp"), most))
    rooted = classes.join(found, classes["fp"] == found["v"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return prints.join(rooted.join(least, "root").select("fp", "root", "component_id"), "fp")


def near_duplicates(docs: DataFrame, most: int = MAX_BITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, fingerprint, component_id (the smallest id that links reach)."""
    return _labelled(docs, most, id_col, text_col).select("doc_id", as_hex(F.col("fp")).alias("fingerprint"), "component_id")


def _one_of_each(docs: DataFrame, labelled: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The first document of each root, by id (none last), fingerprint and text; of repeated rows of it, one."""
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "fp", "text_hash")
    first = labelled.groupBy("root").agg(F.min(place).alias("m")).select(F.col("m.doc_id").alias("__id"), F.col("m.text_hash").alias("__hash"))
    marked = docs.withColumn("__text", text_hash(F.col(text_col)))
    same = (F.col("__text") == F.col("__hash")) & F.col(id_col).eqNullSafe(F.col("__id"))
    return marked.join(first, same, "left_semi").dropDuplicates([id_col, "__text"]).drop("__text")


def drop_near_duplicates(docs: DataFrame, most: int = MAX_BITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each group, the one with the smallest id, with its columns as they are.

    Different texts of one id are told apart. Of repeated rows of an id and text one stays; documents without an id
    stay only where their group has none with one.
    """
    return _one_of_each(docs, _labelled(docs, most, id_col, text_col), id_col, text_col)
