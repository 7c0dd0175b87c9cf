"""Quality rules: repeated passages inside a document, found with a suffix array over its words.

The words of a batch of documents form one sequence whose symbols are numbered per document, so that a
repeat never spans two documents. Prefix doubling gives the rank of every suffix, and only the newest ranks are
kept. Longest common prefixes are compared out where the word before differs from that of the neighbour in the suffix
array; everywhere else they are one less than those of the word before, so they take linear memory.
Where the depth of the LCP interval of a suffix does not carry on from the word before, a maximal repeated
substring begins; the union of those spans is what repeats.

Null texts count as empty ones. Documents without words have no repeats and fail the base rule on the
number of words. Texts of any length are taken whole; a batch ends after ``BATCH_WORDS`` words or one document, and
of a batch's texts one at a time is held as words.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenantferry.llm.common import utf8

WINDOW = 8
BATCH_WORDS = 100_000
#: Longer texts are split into words piece by piece.
PIECE = 1 << 20
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30
#: The method's limits: a repeat counts from so many words on; largest covered share; longest repeat as a share
#: of the document, applied from so many words on.
MIN_REPEAT, MAX_COVERED, MAX_LONGEST, LONGEST_FROM = 5, 0.4, 0.3, 20

FIELDS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, covered_words long, longest_repeat long"
SPACES = b"\t\n\x0b\x0c\r "
NOT_COUNTED = SPACES + bytes(range(0x80, 0xC0))  # white space, and all but the first byte of a character
SYMBOLS = b"#*$%&|<>"
BLANK = re.compile(rb"[\x20\t-\r]")


def _refine(rank: np.ndarray, ties: np.ndarray, ends: np.ndarray, h: int) -> np.ndarray:
    """Turns ranks by h words into ranks by 2h words, in place; returns the suffixes that are still equal to another."""
    n = len(rank)
    after = ties + np.int32(h)
    second = np.where(after < ends[ties], rank[np.minimum(after, n - 1)] + 1, 0)
    key = rank[ties].astype(np.int64) * (n + 1) + second
    del after, second
    order = np.argsort(key, kind="stable")
    key, ties = key[order], ties[order]
    del order
    at = np.arange(len(ties), dtype=np.int32)
    new_group = np.ones(len(ties), bool)
    new_group[1:] = key[1:] != key[:-1]
    old = (key // (n + 1)).astype(np.int32)
    del key
    old_group = np.ones(len(ties), bool)
    old_group[1:] = old[1:] != old[:-1]
    first = np.maximum.accumulate(np.where(new_group, at, 0))
    rank[ties] = old + first - np.maximum.accumulate(np.where(old_group, at, 0))
    alone = new_group & np.append(new_group[1:], True)
    return ties[~alone]


def _matching(symbols: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For how many words the suffixes at a and b agree; 0 where b is negative. ``symbols`` ends in one that occurs nowhere else."""
    n = len(symbols) - 1
    out = np.zeros(len(a), np.int32)
    live, step = np.flatnonzero(b >= 0), 0
    while live.size > 64:
        out[live] = step
        live = live[symbols[a[live] + step] == symbols[b[live] + step]]
        step += 1
    for k in live:
        i, j, width = int(a[k]) + step, int(b[k]) + step, 64
        while True:
            width = min(width, n + 1 - max(i, j))
            differ = symbols[i:i + width] != symbols[j:j + width]
            if differ.any():
                out[k] = i + int(differ.argmax()) - int(a[k])
                break
            i, j, width = i + width, j + width, 2 * width
    return out


def _depths(symbols: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """For each suffix the longest prefix it shares with a neighbour in the suffix array."""
    n = len(rank)
    suffixes = np.empty(n, np.int32)
    suffixes[rank] = np.arange(n, dtype=np.int32)
    before = np.full(n, -1, np.int32)
    before[suffixes[1:]] = suffixes[:-1]
    del suffixes
    ended = np.append(symbols, np.int32(-1))
    carried = np.zeros(n, bool)
    carried[1:] = (before[1:] > 0) & (symbols[:-1] == ended[before[1:] - 1])
    starts = np.flatnonzero(~carried).astype(np.int32)
    known = _matching(ended, starts, before[starts])
    run = np.cumsum(~carried, dtype=np.int32) - 1
    shared = known[run] + starts[run] - np.arange(n, dtype=np.int32)
    depth = shared.copy()
    has = before >= 0  # each suffix is the neighbour of one other
    depth[before[has]] = np.maximum(depth[before[has]], shared[has])
    return depth


def _covered(starts: np.ndarray, lengths: np.ndarray | int, n: int) -> np.ndarray:
    """Which of n words lie in any of the spans."""
    edge = np.bincount(starts, minlength=n + 1) - np.bincount(starts + lengths, minlength=n + 1)
    return np.cumsum(edge[:n]) > 0


def repeats(symbols: np.ndarray, owner: np.ndarray, ends: np.ndarray, n_docs: int, min_repeat: int = MIN_REPEAT) -> tuple[np.ndarray, ...]:
    """Per document: words in repeated windows of ``WINDOW`` words, words in maximal repeats, the longest repeat.

    symbols: a number for each word, different in different documents. owner: each word's document.
    ends: for each word, the position after its document's last word.
    """
    n = len(symbols)
    zero = np.zeros(n_docs, np.int64)
    if not n:
        return zero, zero, zero
    symbols, ends = symbols.astype(np.int32, copy=False), ends.astype(np.int32, copy=False)
    sizes = np.bincount(symbols)
    rank = (np.cumsum(sizes) - sizes).astype(np.int32)[symbols]
    ties = np.flatnonzero(sizes[symbols] > 1).astype(np.int32)
    h, windows = 1, np.empty(0, np.int32)
    while ties.size:
        ties = _refine(rank, ties, ends, h)
        h *= 2
        if h == WINDOW:
            windows = ties
    in_windows = np.bincount(owner[_covered(windows, WINDOW, n)], minlength=n_docs)
    del windows
    depth = _depths(symbols, rank)
    del rank

    begins = depth >= min_repeat
    begins[1:] &= ~((depth[:-1] == depth[1:] + 1) & (owner[:-1] == owner[1:]))
    starts = np.flatnonzero(begins)
    covered = np.bincount(owner[_covered(starts, depth[starts], n)], minlength=n_docs)
    longest = zero.copy()
    np.maximum.at(longest, owner, depth)
    return in_windows, covered, longest


def _dup_lines(text: bytes) -> int:
    if b"\n" not in text:
        return 0
    lines = [x for x in text.split(b"\n") if x.strip(SPACES)]
    return len(lines) - len(set(lines))


def _words(text: bytes) -> Iterator[bytes]:
    at = 0
    while len(text) - at > PIECE:
        gap = BLANK.search(text, at + PIECE)
        end = gap.start() if gap else len(text)
        yield from text[at:end].split()
        at = end
    yield from text[at:].split()


def measure(texts: Iterable[bytes]) -> pa.Table:
    """The columns of ``FIELDS`` for each text."""
    plain: list[tuple] = []
    counts, parts, size, held, done = [], [], 0, 0, []

    def close() -> None:
        nonlocal counts, parts, size, held
        if counts:
            here = np.array(counts, np.int32)
            owner = np.repeat(np.arange(len(here), dtype=np.int32), here)
            ends = np.repeat(np.cumsum(here, dtype=np.int32), here)
            done.append(np.array(repeats(np.concatenate(parts), owner, ends, len(here))))
        counts, parts, size, held = [], [], 0, 0

    for text in texts:
        number = defaultdict(count(size).__next__)
        parts.append(np.fromiter(map(number.__getitem__, _words(text)), np.int32))
        size += len(number)
        n = len(parts[-1])
        counts.append(n)
        plain.append((n, len(text.translate(None, NOT_COUNTED)), len(text) - len(text.translate(None, SYMBOLS)), _dup_lines(text)))
        del text, number
        held += n
        if held >= BATCH_WORDS:
            close()
    close()
    found = np.concatenate(done, axis=1) if done else np.zeros((3, 0), np.int64)
    columns = [*np.array(plain, np.int64).reshape(-1, 4).T, *found.astype(np.int64)]
    return pa.table([pa.array(c) for c in columns], names=[f.split()[0] for f in FIELDS.split(", ")])


def _measured(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        yield measure(x.as_py() for x in texts).to_struct_array().combine_chunks()


def measures(text: Column) -> Column:
    """A struct of ``FIELDS`` for a text column."""
    return F.arrow_udf(_measured, FIELDS)(utf8(text))


def base_failed(m: Column) -> Column:
    return (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"])


def too_repetitive(m: Column, max_covered: float = MAX_COVERED, max_longest: float = MAX_LONGEST) -> Column:
    """True if too much of the document lies in maximal repeats, or one repeat is too long for it."""
    return (m["covered_words"] > max_covered * m["n_words"]) | (
        (m["longest_repeat"] >= LONGEST_FROM) & (m["longest_repeat"] > max_longest * m["n_words"]))


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its measures, ``base_failed`` and ``kept``. Other columns are left out."""
    measured = docs.select(F.col(id_col).alias("doc_id"), measures(F.col(text_col)).alias("m"))
    failed = base_failed(F.col("m"))
    return measured.select(
        "doc_id", "m.*", failed.alias("base_failed"), (~failed & ~too_repetitive(F.col("m"))).alias("kept"))


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents that pass, with their columns as they are."""
    m = measures(F.col(text_col))
    marked = docs.withColumn("__measures", m)
    good = ~base_failed(F.col("__measures")) & ~too_repetitive(F.col("__measures"))
    return marked.filter(good).drop("__measures")
