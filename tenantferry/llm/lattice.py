"""SentencePiece encoding and decoding as relations.

A text is cut into units (white space with the word after it) at places that no piece of the vocabulary crosses, so
that units can be encoded one by one. Distinct units are exploded into their substrings of bounded length, an
equi-join with the piece table leaves the edges of each unit's lattice, the edges are grouped by unit, and a
higher-order ``aggregate`` folds them into a path: Viterbi over the piece scores for unigram models, and for BPE
models, whose scores are ranks and where the best-scoring path is not what encoding means, the merges
in the order of their scores. Characters without a piece become byte pieces.

For BPE the state of the fold is the set of borders between segments, as the bits of a number: an edge is merged if its
ends are borders and just one border lies between them. One walk over the edges by score, then place, makes the merges in
the order in which a queue would, unless a piece comes about only after a piece of worse score ("late", as the vocabulary
tells). Units that hold a late piece, and those of more than ``LONG`` characters, go through the same merges in
Python, with a heap.

Frequent units come from a bounded sample of documents; their dictionary is bounded and broadcast. Occurrences of
all other units are written apart, and meet the dictionary of their distinct units in an equi-join. Joins with broadcast
tables use a hash of the string as key, and then compare the strings.

Null and empty texts have no tokens. Repeated rows each get a result.
"""

from __future__ import annotations

import heapq
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenantferry.llm.common import settled
from tenantferry.session import materialise

SPACE = "▁"
#: Units in the broadcast dictionary at most, and documents they are taken from.
HOT_UNITS, HOT_DOCUMENTS = 150_000, 20_000
LONG = 60  # with its ends, a unit's borders fit the bits of a number
LAST = (1 << 32) - 1  # after the place of any score


@dataclass
class Vocabulary:
    pieces: list[str]
    scores: list[float]
    kinds: list[int]  # 1 normal, 2 unknown, 3 control, 4 user-defined, 6 byte, as the model file has them
    bpe: bool
    dummy_prefix: bool

    @property
    def longest(self) -> int:
        return max((len(p) for p, k in zip(self.pieces, self.kinds) if k in (1, 4)), default=1)

    def late(self) -> list[str]:
        """Pieces of a BPE model that are not made by merges in the order of score and place; no longer ones around them."""
        known = {p: s for p, s, k in zip(self.pieces, self.scores, self.kinds) if k in (1, 4)} if self.bpe else {}
        found: list[str] = []
        for p in sorted((p for p in known if len(p) > 1), key=len):
            if not any(x in p for x in found) and _out_of_order(p, known):
                found.append(p)
        return found

    def byte_ids(self) -> list[int]:
        place = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == 6}
        unknown = self.kinds.index(2)
        return [place.get(f"<0x{b:02X}>", unknown) for b in range(256)]

    def cuts(self) -> str:
        """Marks before which a text may be cut when a letter precedes them, as no piece goes on there."""
        inside = {b for p in self.pieces for a, b in zip(p, p[1:]) if unicodedata.category(a)[0] == "L"}
        return "".join(c for c in ",.!?;:%&*$#|)" if c not in inside)


def _out_of_order(piece: str, known: dict[str, float]) -> bool:
    """Whether the merges inside a piece go back to a better score, or further left at an equal one."""
    borders, last = list(range(len(piece) + 1)), (float("-inf"), 0)
    while len(borders) > 2:
        ways = [(-known[w], borders[i], i) for i in range(len(borders) - 2) if (w := piece[borders[i]:borders[i + 2]]) in known]
        if not ways:
            return False  # never made at all
        score, at, i = min(ways)
        if (score, at) <= last:
            return True
        last = (score, at)
        del borders[i + 1]
    return False


def load(path: str) -> Vocabulary:
    """Read a model file on the driver; its size bounds all that is broadcast from it."""
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    spec = model.normalizer_spec
    if len(spec.precompiled_charsmap) or spec.remove_extra_whitespaces or not spec.escape_whitespaces:
        raise ValueError("only models that leave texts as they are can be used")
    pieces = [p.piece for p in model.pieces]
    if any(SPACE in p.lstrip(SPACE) or ("\n" in p and len(p) > 1) for p in pieces):
        raise ValueError("a piece crosses white space")
    return Vocabulary(pieces, [p.score for p in model.pieces], [p.type for p in model.pieces], model.trainer_spec.model_type == 2, spec.add_dummy_prefix)


def piece_table(spark: SparkSession, v: Vocabulary) -> DataFrame:
    """(p, h, id, score, place) of what may stand in a text; h hashes p, place is the score's place from the best."""
    usable = [(p, i, float(s)) for i, (p, s, k) in enumerate(zip(v.pieces, v.scores, v.kinds)) if k in (1, 4)]
    place = {s: i for i, s in enumerate(sorted({-s for _, _, s in usable}))}
    rows = spark.createDataFrame([(*x, place[-x[2]]) for x in usable], "p string, id int, score double, place long")
    return materialise(rows.withColumn("h", F.xxhash64("p")).coalesce(1), "pieces")


def _same(a: str, b: str) -> Column:
    """Equality of strings that a join's planner does not take as a key beside the hash."""
    return F.col(a).startswith(F.col(b)) & F.col(b).startswith(F.col(a))


def units(text: Column, v: Vocabulary) -> Column:
    """The units of a text, in order; joined they are the text with white space escaped."""
    marks = v.cuts()
    before = "".join("\\" + c for c in marks)
    rest = rf"[^{SPACE}\n]"
    # a word is walked over once, whether it is cut before a mark or goes on to the next white space
    word = rf"{SPACE}*+[^\p{{L}}{SPACE}\n]*+\p{{L}}++(?:(?=[{before}])|{rest}*+)|" if marks else ""
    pattern = rf"\n|{word}{SPACE}*+{rest}++|{SPACE}++"
    text = F.coalesce(text, F.lit(""))
    escaped = F.concat(F.lit(SPACE if v.dummy_prefix else ""), F.replace(text, F.lit(" "), F.lit(SPACE)))
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.regexp_extract_all(escaped, F.lit(pattern), F.lit(0)))


# -- from units to ids --------------------------------------------------------------------------------------


def _edge(edges: Column, start: Column, length: Column) -> Column:
    """The edge at a place, or null."""
    return F.element_at(edges, start * 1000 + length)


def _bits() -> Column:
    """An edge as numbers: a key that sorts by score, then place; its ends as borders, and the borders between them, as bits.

    The key holds the place of the score, the start from 0 and, from 1, the id. Single characters come last,
    since nothing is merged into them; the id of one that has no piece is 0.
    """
    key = F.expr(f"(case when len = 1 then {LAST}L else place end << 30) | cast(start - 1 as long) << 24 | coalesce(id + 1, 0)").alias("key")
    ends = F.expr("(1L << (start - 1)) | (1L << (start + len - 1))").alias("ends")
    return F.struct(key, ends, F.expr("((1L << (len - 1)) - 1L) << start").alias("inner"))


def _merged(edges: Column, n: Column) -> Column:
    """The path that is left after the merges of the edges in their order, as starts and ids; borders are the bits of a number."""
    def step(borders: Column, x: Column) -> Column:
        inside = borders.bitwiseAND(x["inner"])
        merge = (F.bit_count(inside) == 1) & (borders.bitwiseAND(x["ends"]) == x["ends"])
        return F.when(merge, borders.bitwiseXOR(inside)).otherwise(borders)

    def path(borders: Column) -> Column:
        between = F.filter(edges, lambda x: (borders.bitwiseAND(x["inner"]) == 0) & (borders.bitwiseAND(x["ends"]) == x["ends"]))
        return F.sort_array(F.transform(between, lambda x: x["key"].bitwiseAND((1 << 30) - 1)))

    every = F.call_function("shiftleft", F.lit(1).cast("long"), n + 1) - F.lit(1).cast("long")
    # the characters take no part; the path is the fold's last step, since a column of borders might be computed for each edge
    return F.aggregate(F.slice(edges, F.lit(1), F.size(edges) - n), every, step, path)


def _bytes(u: Column, at: Column, v: Vocabulary) -> Column:
    """The byte pieces of one character of a unit."""
    number = F.split(F.lit(",".join(map(str, v.byte_ids()))), ",").cast("array<int>")
    digits = F.hex(F.encode(F.substring(u, at, F.lit(1)), "utf-8"))
    return F.transform(F.sequence(F.lit(0), (F.length(digits) / 2 - 1).cast("int")), lambda j: F.get(
        number, F.conv(F.substring(digits, 2 * j + 1, F.lit(2)), 16, 10).cast("int")))


def _merged_ids(u: Column, path: Column, v: Vocabulary) -> Column:
    """The ids of a path."""
    number = lambda x: (x.bitwiseAND((1 << 24) - 1) - 1).cast("int")
    spelt = F.flatten(F.transform(path, lambda x: F.when(number(x) >= 0, F.array(number(x))).otherwise(_bytes(u, (F.shiftright(x, 24) + 1).cast("int"), v))))
    return F.when(F.exists(path, lambda x: number(x) < 0), spelt).otherwise(F.transform(path, number))


def _viterbi(edges: Column, n: Column, longest: int, unknown: float) -> Column:
    """Borders of the path with the highest sum of scores; unknown: what a character without a piece costs."""
    lengths = F.sequence(F.lit(1), F.lit(longest))

    def step(states: Column, end: Column) -> Column:
        ways = F.transform(F.filter(lengths, lambda k: k <= end), lambda k: F.struct(
            (F.get(states, end - k)["score"] + F.coalesce(_edge(edges, end - k + 1, k)["score"], F.when(k == 1, F.lit(unknown)))).alias("score"), k.alias("back")))
        return F.concat(states, F.array(F.array_max(F.filter(ways, lambda w: w["score"].isNotNull()))))

    first = F.array(F.struct(F.lit(0.0).alias("score"), F.lit(0).alias("back")))
    states = F.aggregate(F.sequence(F.lit(1), n), first, step)

    def walk(path: Column, _: Column) -> Column:
        at = F.get(path, F.lit(0))
        return F.when(at <= 1, path).otherwise(F.concat(F.array(at - F.get(states, at - 1)["back"]), path))

    return F.aggregate(F.sequence(F.lit(1), n), F.array(n + 1), walk)


def _ids(u: Column, borders: Column, edges: Column, single: Column, v: Vocabulary) -> Column:
    """The ids of the segments between borders; characters without a piece as bytes."""
    def segment(a: Column, i: Column) -> Column:
        k = F.get(borders, i + 1) - a
        known = F.get(single, a - 1)
        return F.when(k > 1, F.array(_edge(edges, a, k)["id"])).when(known.isNotNull(), F.array(known)).otherwise(_bytes(u, a, v))

    return F.flatten(F.transform(F.slice(borders, F.lit(1), F.size(borders) - 1), segment))


def foldable(u: Column, v: Vocabulary) -> Column:
    """Whether a unit can be folded; the others go through ``LongUnits``."""
    late = v.late()
    short = F.length(u) <= LONG
    return short & ~u.rlike("|".join(map(re.escape, late))) if late else short


def dictionary(distinct: DataFrame, pieces: DataFrame, v: Vocabulary) -> DataFrame:
    """(u, ids) for distinct units u that can be folded.

    The explosion and the broadcast join leave the partitioning of ``distinct`` as it is, so grouping needs no
    exchange if it is dealt by u.
    """
    spread = distinct.select("u", F.explode(F.sequence(F.lit(1), F.length("u"))).alias("start"))
    sub = spread.select("u", "start", F.explode(F.sequence(F.lit(1), F.least(F.lit(v.longest), F.length("u") - F.col("start") + 1))).alias("len"))
    sub = sub.select("u", "start", "len", F.expr("substring(u, start, len)").alias("piece")).withColumn("hash", F.xxhash64("piece"))
    edges = sub.join(F.broadcast(pieces), (F.col("hash") == F.col("h")) & _same("piece", "p"), "left").filter("id is not null or len = 1")
    n = F.length("u")
    if v.bpe:
        grouped = edges.select("u", _bits().alias("e")).groupBy("u").agg(F.sort_array(F.collect_list("e")).alias("e"))
        paths = grouped.select("u", _merged(F.col("e"), n).alias("path"))
        return paths.select("u", _merged_ids(F.col("u"), F.col("path"), v).alias("ids"))
    edge = F.struct((F.col("start") * 1000 + F.col("len")).alias("key"), F.struct("score", "id").alias("value"))
    grouped = edges.groupBy("u").agg(F.collect_list(edge).alias("e"), F.collect_list(F.when(F.col("len") == 1, F.struct("start", "id"))).alias("one"))
    lattice = grouped.select("u", F.map_from_entries("e").alias("e"), F.transform(F.array_sort("one"), lambda x: x["id"]).alias("one"))
    borders = _viterbi(F.col("e"), n, v.longest, min(v.scores) - 10.0)
    return lattice.select("u", "e", "one", borders.alias("b")).select("u", _ids(F.col("u"), F.col("b"), F.col("e"), F.col("one"), v).alias("ids"))


class LongUnits:
    """Encodes units of any length in near-linear time."""

    def __init__(self, v: Vocabulary) -> None:
        self.known = {p: (s, i) for i, (p, s, k) in enumerate(zip(v.pieces, v.scores, v.kinds)) if k in (1, 4)}
        self.bytes, self.longest, self.bpe, self.unknown = v.byte_ids(), v.longest, v.bpe, min(v.scores) - 10.0

    def borders(self, u: str) -> list[int]:
        n = len(u)
        if not self.bpe:
            best, back = [0.0] + [float("-inf")] * n, [0] * (n + 1)
            for end in range(1, n + 1):
                for k in range(1, min(self.longest, end) + 1):
                    score = self.known.get(u[end - k:end], (self.unknown,))[0] if k == 1 else self.known.get(u[end - k:end], (float("-inf"),))[0]
                    if best[end - k] + score >= best[end]:
                        best[end], back[end] = best[end - k] + score, k
            path = [n]
            while path[-1]:
                path.append(path[-1] - back[path[-1]])
            return path[::-1]
        end = list(range(1, n + 1))  # of the segment that starts here
        before = list(range(-1, n))  # start of the one before
        live = [True] * n
        queue: list[tuple[float, int, int]] = []

        def offer(a: int) -> None:
            b = end[a]
            if b < n and end[b] - a <= self.longest and (x := self.known.get(u[a:end[b]])):
                heapq.heappush(queue, (-x[0], a, end[b]))

        for a in range(n):
            offer(a)
        while queue:
            _, a, to = heapq.heappop(queue)
            if not live[a] or end[a] == n or end[end[a]] != to:
                continue
            live[end[a]] = False
            end[a] = to
            if to < n:
                before[to] = a
            offer(a)
            if before[a] >= 0:
                offer(before[a])
        return [a for a in range(n) if live[a]] + [n]

    def ids(self, u: str) -> list[int]:
        out, b = [], self.borders(u)
        for x, y in zip(b, b[1:]):
            known = self.known.get(u[x:y])
            out += [known[1]] if known else [self.bytes[c] for c in u[x:y].encode()]
        return out

    def run(self, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = {u: self.ids(u) for u in set(batch["u"])}
            yield batch.assign(ids=batch["u"].map(found))


# -- from ids to texts --------------------------------------------------------------------------------------


def _joined(ids: Column, v: Vocabulary) -> Column:
    """The pieces of ids joined, byte pieces as bytes; white space still escaped."""
    numbers = [p[3:5].lower() if k == 6 else "" if k == 3 else p.encode().hex() for p, k in zip(v.pieces, v.kinds)]
    table = F.split(F.lit(",".join(numbers)), ",")  # folded to a constant
    return F.decode(F.unhex(F.array_join(F.transform(ids, lambda i: F.get(table, i)), "")), "utf-8")


def decoded(ids: Column, v: Vocabulary) -> Column:
    """The text of an array of ids; null for null. Exact for ids that encoding made."""
    text = F.translate(_joined(ids, v), SPACE, " ")
    return F.when(F.size(ids) == 0, "").otherwise(F.substring(text, F.lit(2 if v.dummy_prefix else 1), F.length(text)))


# -- documents ----------------------------------------------------------------------------------------------


def occurrences(docs: DataFrame, v: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, list[DataFrame]]:
    """(row, doc_id, pos, u, ids, ok) of every unit of every document, and frames (row, pos, u, ids, ok) of those without ids there.

    The first has the ids of frequent units only, and a row without a unit for a document that has none. The others
    hold the units that are not frequent.
    """
    pieces = piece_table(docs.sparkSession, v)
    docs = settled(docs.select(id_col, text_col), "texts")  # numbered more than once below
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), units(F.col(text_col), v).alias("us"))
    n_docs = docs.count()
    sample = rows.filter(F.pmod(F.xxhash64("row"), F.lit(max(1, n_docs // HOT_DOCUMENTS))) == 0).select(F.explode("us").alias("u"))
    often = sample.groupBy("u").count().filter("count > 1").filter(foldable(F.col("u"), v)).orderBy(F.desc("count"), "u").limit(HOT_UNITS).select("u")
    checked = lambda d: d.withColumn("ok", _joined(F.col("ids"), v) == F.col("u"))
    # many small parts, since a unit is few bytes but much work; a stated number is not joined up again
    parts = lambda n: max(48, n // 40_000)
    hot = dictionary(often.repartition(parts(HOT_UNITS), "u"), pieces, v)
    hot = materialise(checked(hot).select(F.col("u").alias("hu"), F.xxhash64("u").alias("h"), "ids", "ok"), "hot-units")
    each = rows.select("row", "doc_id", F.posexplode_outer("us").alias("pos", "u")).withColumn("hash", F.xxhash64("u"))
    is_hot = (F.col("hash") == F.col("h")) & _same("u", "hu")
    frequent = each.join(F.broadcast(hot), is_hot, "left")
    rare = materialise(each.filter("u is not null").join(F.broadcast(hot), is_hot, "left_anti").select("row", "pos", "u"), "rare-units")
    folds = foldable(F.col("u"), v)
    n = parts(rare.count())
    tail = dictionary(rare.filter(folds).select("u").repartition(n, "u").distinct(), pieces, v)
    columns = ["row", "pos", "u", "ids", "ok"]
    # a part's dictionary has few units, so that the occurrences need no sort
    folded = rare.filter(folds).select("row", "pos", "u").repartition(n, "u").join(checked(tail).hint("shuffle_hash"), "u").select(columns)
    other = rare.filter(~folds).select("row", "pos", "u").mapInPandas(LongUnits(v).run, "row long, pos int, u string, ids array<int>")
    return frequent.select("row", "doc_id", "pos", "u", "ids", "ok"), [folded, checked(other).select(columns)]


def counted(docs: DataFrame, v: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_units, n_tokens, ids_digest and round_trip.

    The digest joins a hash of each unit's place and ids by exclusive or, so that it can be summed up before rows move.
    round_trip: every unit's ids decode to the unit.
    """
    def part(x: DataFrame, doc_id: Column, n_units: Column) -> DataFrame:
        return x.groupBy("row").agg(
            doc_id.alias("doc_id"), n_units.alias("n_units"), F.coalesce(F.sum(F.size("ids")), F.lit(0)).alias("n_tokens"),
            F.bit_xor(F.when(F.col("ids").isNotNull(), F.xxhash64("pos", "ids")).otherwise(F.lit(0))).alias("digest"),
            F.min(F.coalesce("ok", F.lit(True))).alias("ok"))

    first, others = occurrences(docs, v, id_col, text_col)
    both = part(first, F.max("doc_id"), F.count("u"))
    for x in others:
        both = both.unionByName(part(x, F.lit(None).cast(first.schema["doc_id"].dataType), F.lit(0).cast("long")))
    both = both.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.sum("n_units").alias("n_units"), F.sum("n_tokens").alias("n_tokens"), F.bit_xor("digest").alias("digest"), F.min("ok").alias("round_trip"))
    return both.select("doc_id", "n_units", "n_tokens", F.lpad(F.lower(F.hex("digest")), 16, "0").alias("ids_digest"), "round_trip")


def encoded(docs: DataFrame, v: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, ids, n_tokens. Other columns are left out."""
    first, others = occurrences(docs, v, id_col, text_col)
    rows = first.filter("u is null or ids is not null or pos = 0").select("row", "doc_id", "pos", "ids")  # pos 0: each document once at least
    for x in others:
        rows = rows.unionByName(x.select("row", "pos", "ids"), allowMissingColumns=True)
    part = F.when(F.col("ids").isNotNull(), F.struct("pos", "ids"))
    ordered = rows.groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.collect_list(part).alias("parts"))
    ids = F.flatten(F.transform(F.array_sort("parts"), lambda x: x["ids"]))
    return ordered.select("doc_id", ids.alias("ids")).withColumn("n_tokens", F.size("ids").cast("long"))
