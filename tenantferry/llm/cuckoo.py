"""Exact dedup over a cuckoo-filter index that takes insertions and deletions of live digests.

A text's key is the SHA-256 of its UTF-8 bytes; null counts as empty. Documents are summed up per key before anything
is shuffled, so a group of copies is one row per task. Keys are dealt to parts by their first bytes. A part holds
its keys, with keeper and number of rows, and a cuckoo filter over them: four 16-bit fingerprints to a bucket, the
second bucket by xor with the fingerprint's hash. A key that the filter does not know is new; a hit is verified against
the part's own keys, so a false hit costs a look-up and changes nothing. Where an insertion finds no free
slot after ``KICKS`` moves, the filter is built anew, twice as large, from the stored keys. A key none of whose rows
are left has its fingerprint taken out.

An ``Index`` is two tables in the shared folder, replaced as a whole by each change: ``parts`` (keys and filters) and
``members`` (each live row), by which a deletion finds the next keeper. Parts are added as keys grow, so a part stays near
``PART_KEYS`` keys. The row with the largest id stays, and null ids come before all others; of rows repeated with text
and id one stays, the first that came. Other columns are left out, whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tenantferry.llm.common import utf8
from tenantferry.session import materialise

SLOTS, KICKS, FULL = 4, 500, 0.9
PART_KEYS = 20_000
#: A group with at least this part of all rows is joined by broadcast; there can be no more than ``1 / HOT`` of them.
HOT = 1 / 1024


class Filter:
    """A cuckoo filter over keys of 32 bytes."""

    def __init__(self, slots: bytes | None = None, expected: int = 0):
        if slots is None:
            n = 1
            while n * SLOTS * FULL < expected:
                n *= 2
            self.table = [0] * (n * SLOTS)
        else:
            self.table = np.frombuffer(slots, np.uint16).tolist()
        self.mask = len(self.table) // SLOTS - 1

    def __bytes__(self) -> bytes:
        return np.array(self.table, np.uint16).tobytes()

    def places(self, key: bytes) -> tuple[int, int, int]:
        """Fingerprint, never 0, and the two buckets it may lie in."""
        mark = int.from_bytes(key[8:10], "big") or 1
        first = int.from_bytes(key[10:16], "big") & self.mask
        return mark, first, self._other(first, mark)

    def _other(self, bucket: int, mark: int) -> int:
        return bucket ^ ((mark * 0x5BD1E995 >> 7) & self.mask)

    def __contains__(self, key: bytes) -> bool:
        mark, a, b = self.places(key)
        return mark in self.table[a * SLOTS:a * SLOTS + SLOTS] or mark in self.table[b * SLOTS:b * SLOTS + SLOTS]

    def _put(self, bucket: int, mark: int) -> bool:
        for at in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
            if not self.table[at]:
                self.table[at] = mark
                return True
        return False

    def add(self, key: bytes) -> bool:
        """False if no slot was found; one fingerprint is then homeless, and the filter must be built anew."""
        mark, a, b = self.places(key)
        if self._put(a, mark) or self._put(b, mark):
            return True
        bucket = b
        for kick in range(KICKS):
            at = bucket * SLOTS + (kick * 7 + mark) % SLOTS
            mark, self.table[at] = self.table[at], mark
            bucket = self._other(bucket, mark)
            if self._put(bucket, mark):
                return True
        return False

    def remove(self, key: bytes) -> None:
        """Takes out a key that is in."""
        mark, a, b = self.places(key)
        for bucket in (a, b):
            for at in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if self.table[at] == mark:
                    self.table[at] = 0
                    return
        raise KeyError(key.hex())


def built(keys: list[bytes], least: int = 0) -> Filter:
    """A filter that holds the keys, as large as it must be."""
    expected = max(len(keys), least)
    while True:
        found = Filter(expected=expected)
        if all(found.add(k) for k in keys):
            return found
        expected = len(found.table) * 2


class Part:
    """One part of the index: stored keys with their entries, and the filter before them."""

    def __init__(self, slots: bytes | None, stored: dict[bytes, dict]):
        self.stored = stored
        self.filter = Filter(slots) if slots is not None else built(list(stored))
        self.resized = 0

    def known(self, key: bytes) -> bool:
        return key in self.filter and key in self.stored

    def set(self, key: bytes, entry: dict) -> None:
        """Writes a key's entry; the filter follows when the key comes, or goes because no rows are left."""
        if self.known(key):
            if entry["group_size"] > 0:
                self.stored[key] = entry
            else:
                del self.stored[key]
                self.filter.remove(key)
        elif entry["group_size"] > 0:
            self.stored[key] = entry
            if not self.filter.add(key):
                self.filter = built(list(self.stored), least=len(self.filter.table) * 2)
                self.resized += 1


KEEPER = ("keep_id", "keep_batch", "keep_row")
ENTRY = (*KEEPER, "group_size")


def _rank(e: dict) -> tuple:
    """The largest id; of equal ids the first that came."""
    return (e["keep_id"] is not None, e["keep_id"], -e["keep_batch"], -e["keep_row"])


def _change(schema: pa.Schema) -> Callable:
    """Step of one part: what it holds, and per key what is to be added or, with ``put``, what holds from now on."""
    def step(held: pa.Table, changes: pa.Table) -> pa.Table:
        rows, new = held.to_pylist(), changes.to_pylist()
        slots = next((r["slots"] for r in rows if r["slots"] is not None), None)
        part = Part(slots, {r["key"]: {c: r[c] for c in ENTRY} for r in rows if r["key"] is not None})
        for c in new:
            entry = {x: c[x] for x in ENTRY}
            if not c["put"] and part.known(c["key"]):
                old = part.stored[c["key"]]
                entry = max(old, entry, key=_rank) | {"group_size": old["group_size"] + entry["group_size"]}
            part.set(c["key"], entry)
        number = (rows or new)[0]["part"]
        out = [{"part": number, "key": k, **e, "slots": None} for k, e in part.stored.items()]
        out.append({"part": number, "slots": bytes(part.filter)})
        return pa.Table.from_pylist(out, schema)

    return step


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, row, key`` of every row, written once; ``row`` tells repeated rows apart."""
    key = F.unhex(F.sha2(utf8(F.col(text_col)), 256))
    return materialise(docs.select(F.col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("row"), key.alias("key")), "digests")


def _part_of(parts: int) -> Column:
    # the key is a uniform hash already: its first bytes deal it out
    return F.pmod(F.conv(F.hex(F.substring("key", 1, 7)), 16, 10).cast("long"), F.lit(parts)).cast("int")


@dataclass(frozen=True)
class Index:
    """Live documents by key; each change gives a new index and leaves the old one as it was."""

    parts: DataFrame
    members: DataFrame
    n_parts: int = 1
    batches: int = 0

    @staticmethod
    def empty(like: DataFrame) -> Index:
        """An index for the ids of ``like``, which has the columns of ``digests``."""
        kind = like.schema["doc_id"].dataType.simpleString()
        spark = like.sparkSession
        return Index(
            spark.createDataFrame([], f"part int, key binary, keep_id {kind}, keep_batch int, keep_row long, group_size long, slots binary"),
            spark.createDataFrame([], f"key binary, doc_id {kind}, batch int, row long"))

    def groups(self) -> DataFrame:
        """Key, keeper and rows of every live text."""
        return self.parts.where("key is not null").select("key", *ENTRY)

    def _changed(self, changes: DataFrame, members: DataFrame, n_parts: int, batches: int) -> Index:
        held = self.parts
        if n_parts != self.n_parts:  # the keys are dealt anew, and their filters built from them
            held = held.where("key is not null").withColumn("slots", F.lit(None).cast("binary")).withColumn("part", _part_of(n_parts))
        dealt = changes.select(_part_of(n_parts).alias("part"), "key", *ENTRY, "put")
        shape = self.parts.schema
        done = held.groupBy("part").cogroup(dealt.groupBy("part")).applyInArrow(_change(to_arrow_schema(shape)), shape)
        return Index(materialise(done, "parts"), members, n_parts, batches)

    def insert(self, rows: DataFrame, part_keys: int = PART_KEYS, keep_members: bool = True) -> Index:
        """The index with ``digests`` added, as the batch number ``batches``. Rows added without members can't be deleted later."""
        batch = rows.withColumn("batch", F.lit(self.batches))
        changes = materialise(batch.groupBy("key").agg(*_best(), F.count("*").alias("group_size")), "changes")
        n_parts = max(self.n_parts, -(-(self.groups().count() + changes.count()) // part_keys))
        members = self.members
        if keep_members:
            members = materialise(members.unionByName(batch.select("key", "doc_id", "batch", "row")), "members")
        return self._changed(_named(changes).withColumn("put", F.lit(False)), members, n_parts, self.batches + 1)

    def delete(self, rows: DataFrame) -> Index:
        """The index without the documents ``doc_id, key``, with all rows of theirs; documents that are not live change nothing."""
        gone = rows.select(F.col("doc_id").alias("__id"), F.col("key").alias("__key")).distinct()
        m = self.members
        here = (m["key"] == gone["__key"]) & m["doc_id"].eqNullSafe(gone["__id"])
        left = materialise(m.join(gone, here, "left").withColumn("live", F.col("__key").isNull()).drop("__id", "__key"), "members")
        # partial sums per key: the members of a hot text stay spread over tasks up to here
        alive = left.groupBy("key").agg(*_best("live"), F.count_if("live").alias("group_size"), F.bool_or(~F.col("live")).alias("put"))
        return self._changed(_named(alive).where("put"), left.where("live").drop("live"), self.n_parts, self.batches)

    def decisions(self, rows: DataFrame, batch: int = 0) -> DataFrame:
        """Rows of a batch with keeper, rows of the group and whether they stay; texts that are not live have a null group."""
        groups = self.groups()
        total = groups.agg(F.sum("group_size")).first()[0] or 0
        hot = F.broadcast(groups.where(F.col("group_size") >= max(2, HOT * total)))
        common = rows.join(hot.select("key"), "key", "left_anti").join(groups, "key", "left")
        found = rows.join(hot, "key").unionByName(common)
        kept = F.col("keep_id").eqNullSafe(F.col("doc_id")) & (F.col("keep_batch") == batch) & (F.col("keep_row") == F.col("row"))
        return found.select("doc_id", "keep_id", "group_size", F.coalesce(kept, F.lit(False)).alias("kept"), F.lower(F.hex("key")).alias("text_sha256"))


def _best(live: str | None = None) -> list[Column]:
    ranked = F.struct(F.col("doc_id").alias("id"), (-F.col("batch")).alias("b"), (-F.col("row")).alias("r"))
    return [F.max(F.when(F.col(live), ranked) if live else ranked).alias("best")]


def _named(summed: DataFrame) -> DataFrame:
    return summed.select("*", F.col("best.id").alias("keep_id"), (-F.col("best.b")).alias("keep_batch"), (-F.col("best.r")).alias("keep_row")).drop("best")


def documents(docs: DataFrame, part_keys: int = PART_KEYS) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    rows = digests(docs)
    return Index.empty(rows).insert(rows, part_keys, keep_members=False).decisions(rows)
