"""Edit-aware token counts: a segment tree over a document's pre-tokens, kept up to date through edits.

The leaves hold runs of pre-tokens with their lengths and token counts, the inner nodes the sums of characters
and tokens below. An edit is found by going down the character sums. Matching begins a few
characters before it, at the start of the pre-token there, since the pattern looks no further ahead than ``CONTEXT``
characters past a match; it ends as soon as a new pre-token ends, after the edit, where an old one ended. Only
the pre-tokens in between are encoded anew, and only the sums above their leaves change.

Trees are kept: ``trees`` makes a table of all documents' leaves, ``keep`` writes it, and ``after`` joins a table of edits
to it and gives the table that comes next. What is stored are the texts and the lengths and counts of their pre-tokens; a
tree's sums are added up from these, without matching or encoding. Rows without edits pass by as they are.

Null texts count as empty ones. Edits apply in order, each to the text as the one before left it. A position beyond
the text means its end, one below zero its start; a deletion ends at the text's end. An edit without a
position is left out; without a length or text it deletes or inserts nothing. Texts are taken whole. Edits of an id
that several rows have apply to each of them; edits of a null id to none. Edits of equal ``seq`` apply by position, length, text.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenantferry.session import scratch

LEAF = 64
#: Characters past a match that the pattern may look at: a contraction of three, one of which is matched.
CONTEXT = 4
MOST_KNOWN = 400_000
EDIT = "array<struct<pos:long,deleted:long,inserted:string>>"
#: Arrays of 32-bit whole numbers, as the bytes that numpy has for them: no part of a row for each pre-token.
LEAVES = "lens binary, counts binary"
#: Characters after which the rows that are done leave Python.
PIECE = 4_000_000
FIELDS = "tokens_before long, tokens_after long, n_pretokens long, n_encoded_anew long, n_edits long"


class Counter(dict):
    """Token counts of pre-tokens, encoded when first seen."""

    def __init__(self, ranks_path: str, pattern: str) -> None:
        import regex
        import tiktoken

        super().__init__()
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encode = tiktoken.Encoding("counts", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.pattern = regex.compile(pattern)

    def __missing__(self, word: str) -> int:
        if len(self) > MOST_KNOWN:
            self.clear()
        n = len(self.encode(word))
        self[word] = n
        return n


def matched(text: str, counter: Counter) -> tuple[list[int], list[int]]:
    """Lengths and counts of a text's pre-tokens."""
    words = counter.pattern.findall(text)
    return list(map(len, words)), list(map(counter.__getitem__, words))


def packed(numbers: Sequence[int]) -> bytes:
    return np.asarray(numbers, "<i4").tobytes()


def unpacked(data: bytes) -> list[int]:
    return np.frombuffer(data, "<i4").tolist()


def pieces(rows: Iterator[tuple], names: Sequence[str], text_at: int) -> Iterator[pd.DataFrame]:
    """Rows in frames that hold about ``PIECE`` characters of text."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[text_at])
        if size >= PIECE:
            yield pd.DataFrame(held, columns=names)
            held, size = [], 0
    if held:
        yield pd.DataFrame(held, columns=names)


class TokenTree:
    """The pre-tokens of one text as a segment tree; node i has the children 2i and 2i + 1."""

    def __init__(self, text: str, counter: Counter, leaves: tuple[list[int], list[int]] | None = None) -> None:
        self.text, self.counter, self.encoded = text, counter, 0
        if leaves is not None:
            self._build(*leaves)
            return
        self._build(*matched(text, counter))

    def _build(self, lens: list[int], counts: list[int]) -> None:
        self.lens = [lens[i:i + LEAF] for i in range(0, len(lens), LEAF)] or [[]]
        self.counts = [counts[i:i + LEAF] for i in range(0, len(counts), LEAF)] or [[]]
        self.width = 1 << (len(self.lens) - 1).bit_length()
        self.chars, self.tokens = [0] * (2 * self.width), [0] * (2 * self.width)
        for i, (a, b) in enumerate(zip(self.lens, self.counts)):
            self.chars[self.width + i], self.tokens[self.width + i] = sum(a), sum(b)
        for i in range(self.width - 1, 0, -1):
            self._sum(i)

    def _sum(self, i: int) -> None:
        self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
        self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    @property
    def leaves(self) -> tuple[bytes, bytes]:
        """Lengths and counts of the pre-tokens in order, packed, from which the tree can be made again."""
        return packed([x for part in self.lens for x in part]), packed([x for part in self.counts for x in part])

    @property
    def total(self) -> int:
        return self.tokens[1]

    def _find(self, pos: int) -> tuple[int, int, int]:
        """Leaf, place in it and start of the pre-token that holds the character at pos."""
        node, start = 1, 0
        while node < self.width:
            node *= 2
            if pos >= start + self.chars[node]:
                start += self.chars[node]
                node += 1
        leaf = node - self.width
        k = 0
        for k, n in enumerate(self.lens[leaf]):
            if pos < start + n:
                break
            start += n
        return leaf, k, start

    def edit(self, pos: int, deleted: int, inserted: str) -> None:
        old = self.text
        pos = min(max(pos, 0), len(old))
        end = min(pos + max(deleted, 0), len(old))
        self.text = new = old[:pos] + inserted + old[end:]
        leaf, k, start = self._find(max(0, min(pos - CONTEXT, len(old) - 1))) if old else (0, 0, 0)
        lens, counts = [], []
        last, j, border = leaf, k, start  # the old pre-token after ``border``, by leaf and place
        shift = len(new) - len(old)
        for m in self.counter.pattern.finditer(new, start):
            word = m[0]
            lens.append(len(word))
            counts.append(self.counter[word])
            at = m.end() - shift
            if m.end() < pos + len(inserted) or at < end:
                continue
            while border < at and last < len(self.lens):
                if j < len(self.lens[last]):
                    border += self.lens[last][j]
                    j += 1
                else:
                    last, j = last + 1, 0
            if border == at:
                break
        else:
            last, j = len(self.lens) - 1, len(self.lens[-1])  # no old border was met again
        self.encoded += len(lens)
        if last >= len(self.lens):
            last, j = len(self.lens) - 1, len(self.lens[-1])
        if last == leaf:
            self.lens[leaf][k:j], self.counts[leaf][k:j] = lens, counts
        else:
            self.lens[leaf][k:], self.counts[leaf][k:] = lens, counts
            self.lens[last][:j], self.counts[last][:j] = [], []
            for i in range(leaf + 1, last):
                self.lens[i], self.counts[i] = [], []
        if len(self.lens[leaf]) > 16 * LEAF:
            self._build([x for part in self.lens for x in part], [x for part in self.counts for x in part])
            return
        nodes = set()
        for i in range(leaf, last + 1):
            self.chars[self.width + i], self.tokens[self.width + i] = sum(self.lens[i]), sum(self.counts[i])
            nodes.add((self.width + i) // 2)
        while nodes and 0 not in nodes:
            for i in nodes:
                self._sum(i)
            nodes = {i // 2 for i in nodes}


def trees(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", more: Sequence[Column] = ()) -> DataFrame:
    """One row per document: doc_id, text, ``LEAVES`` and the columns in ``more``. Other columns are left out."""
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        counter = Counter(ranks_path, pattern)
        for texts in batches:
            yield from pieces(((*map(packed, matched(t, counter)), t) for t in texts), ["lens", "counts", "text"], 2)

    # the text comes back from Python, so that the rows that wait for it are small
    grown = docs.select(F.col(id_col).alias("doc_id"), F.pandas_udf(run, LEAVES + ", text string")(F.coalesce(F.col(text_col), F.lit(""))).alias("t"), *more)
    return grown.select("doc_id", "t.text", "t.lens", "t.counts", *grown.columns[2:])


def keep(made: DataFrame, path: str | None = None) -> DataFrame:
    """Writes trees as a table, into the shared folder if no path is given, and reads them back."""
    spark, path = made.sparkSession, path or scratch(made.sparkSession, "trees")
    made.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(made.schema).parquet(path)


def edited(kept: DataFrame, edits: Column, ranks_path: str, pattern: str, with_leaves: bool = True) -> DataFrame:
    """Kept trees after a column of edits (``EDIT``): doc_id, ``FIELDS``, text and, on request, ``LEAVES``."""
    def run(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        counter = Counter(ranks_path, pattern)
        for batch in batches:
            yield from pieces((row(counter, *x) for x in zip(*batch)), names, 5)

    def row(counter: Counter, text: str, lens: bytes, counts: bytes, many) -> tuple:
        tree = TokenTree(text, counter, (unpacked(lens), unpacked(counts)))
        before, done = tree.total, 0
        for e in many if many is not None else ():
            if e is not None and e["pos"] is not None:
                tree.edit(int(e["pos"]), int(e["deleted"] or 0), e["inserted"] or "")
                done += 1
        return before, tree.total, sum(map(len, tree.lens)), tree.encoded, done, tree.text, *(tree.leaves if with_leaves else ())

    schema = FIELDS + ", text string" + (f", {LEAVES}" if with_leaves else "")
    names = [f.split()[0] for f in schema.split(", ")]
    out = F.pandas_udf(run, schema)(F.col("text"), F.col("lens"), F.col("counts"), edits.cast(EDIT))
    return kept.select("doc_id", out.alias("c")).select("doc_id", "c.*")


def after(kept: DataFrame, log: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id") -> DataFrame:
    """The kept trees after a table of edits (id, seq, pos, deleted, inserted), to be kept in their turn.

    One row per document: doc_id, text, ``LEAVES`` and n_encoded_anew, the pre-tokens that these edits made it encode. Only
    documents with edits go through Python, and only regions around the edits are matched and encoded.
    """
    changes = gathered(log.filter(F.col(id_col).isNotNull()), id_col).select(F.col(id_col).alias("doc_id"), "edits")
    columns = ["doc_id", "text", "lens", "counts"]
    touched = edited(kept.select(columns).join(changes, "doc_id"), F.col("edits"), ranks_path, pattern)
    rest = kept.select(columns).join(changes, "doc_id", "left_anti").withColumn("n_encoded_anew", F.lit(0).cast("long"))
    return touched.select(*columns, "n_encoded_anew").unionByName(rest)


def counts(docs: DataFrame, edits: Column, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, ``FIELDS`` and ``text``, the edited text. Other columns are left out.

    The trees are kept as a table first; the edits, a column over ``docs``, are applied to what it holds.
    """
    kept = keep(trees(docs, ranks_path, pattern, id_col, text_col, [edits.cast(EDIT).alias("edits")]))
    return edited(kept, F.col("edits"), ranks_path, pattern, with_leaves=False)


def gathered(edits: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, edits) from a table (id, seq, pos, deleted, inserted): each document's edits in order of seq."""
    one = F.struct("seq", F.struct("pos", "deleted", "inserted").alias("e"))
    return edits.groupBy(id_col).agg(F.array_sort(F.collect_list(one)).alias("l")).select(id_col, F.transform("l", lambda x: x["e"]).cast(EDIT).alias("edits"))
