"""Secret scans: fixed patterns, and two character Markov models compared by log-likelihood ratio.

Only column expressions are used. Where a pattern matches is told by the pieces between its matches: a match starts
where the pieces and matches before it end. Runs of letters, digits and ``+/=_-`` that are long enough and touch no
pattern's span are candidates of the models. The models are bigram chains over characters with a start
symbol, one of random strings and one of ordinary identifiers, trained on labelled samples; a candidate whose
log-likelihood ratio is above a threshold becomes a span of kind ``markov``.

Null texts count as empty ones. Offsets are code points, ends are exclusive. Texts are taken whole. A fold over a
text's matches copies its list of spans, so a text with very many matches costs their number squared in
small copies. Without samples of either class no span is added.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The kinds in their order, with patterns and the least length of a match or of group 2.
KINDS = ("assign", "access", "hex", "markov")
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 6, 20, 24

CANDIDATE = r"[A-Za-z0-9+/=_-]{16,}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/=_-"
START = 1  # code of the start symbol
#: Nats by which the random model must lead, whatever the length.
MARGIN = 8.0
SMOOTHING = 0.5
MASK = "[SECRET]"
#: Documents whose words make the ordinary samples, and random strings generated, for the registered query.
SAMPLE_DOCUMENTS, SAMPLE_STRINGS = 2000, 4000

_SPAN = "array<struct<start:int,kind:int,end:int>>"


def _positions(text: Column, pattern: str, gate: str, kind: int, keep) -> Column:
    """Spans of a pattern's matches that pass ``keep(match, group 2 or match)``."""
    lit = F.lit(pattern)
    groups = 2 if kind == 0 else 0
    parts = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, lit, F.lit(0)).alias("hit"), F.regexp_extract_all(text, lit, F.lit(groups)).alias("value"))
    none = F.array().cast(_SPAN)

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        end = start + F.coalesce(F.length(x["hit"]), F.lit(0))
        span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"))
        passed = x["hit"].isNotNull() & keep(x["hit"], x["value"])
        return F.struct(end.alias("at"), F.when(passed, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))

    spans = F.aggregate(parts, F.struct(F.lit(0).alias("at"), none.alias("spans")), step, lambda acc: acc["spans"])
    return F.when(text.rlike(gate), spans).otherwise(none)


def base_spans(text: Column) -> Column:
    """The patterns' spans by start, then kind."""
    return F.array_sort(F.concat(
        _positions(text, ASSIGN, ASSIGN, 0, lambda hit, value: F.length(value) >= MIN_ASSIGN),
        _positions(text, ACCESS, ACCESS, 1, lambda hit, value: F.length(hit) >= MIN_ACCESS),
        _positions(text, HEX, "[0-9a-f]{%d}" % MIN_HEX, 2, lambda hit, value: F.length(hit) >= MIN_HEX),
    ))


def _codes(text: Column) -> Column:
    """The characters' codes after a start symbol."""
    return F.concat(F.array(F.lit(START)), F.transform(F.split(text, ""), lambda c: F.ascii(c)))


def ratios(samples: DataFrame, text_col: str = "text", random_col: str = "is_random", smoothing: float = SMOOTHING) -> list[float] | None:
    """Log ratios of the two chains by 128 * first code + second code, from samples marked random or not.

    The counts are summed by Spark; the driver gets a number for each pair of characters and class.
    """
    known = samples.filter(F.col(text_col).rlike(f"^[{ALPHABET[:-1]}\\-]+$") & F.col(random_col).isNotNull())
    codes = known.select(F.col(random_col).alias("r"), _codes(F.col(text_col)).alias("c"))
    pairs = codes.select("r", F.explode(F.arrays_zip(F.slice("c", F.lit(1), F.size("c") - 1).alias("a"), F.slice("c", F.lit(2), F.size("c") - 1).alias("b"))).alias("p"))
    counts = {(bool(x["r"]), x["a"], x["b"]): x["n"] for x in pairs.groupBy("r", F.col("p.a").alias("a"), F.col("p.b").alias("b")).agg(F.count("*").alias("n")).collect()}
    if len({k[0] for k in counts}) < 2:
        return None
    letters = [ord(c) for c in ALPHABET]
    table = [0.0] * (128 * 128)
    for a in [START, *letters]:
        whole = [sum(counts.get((r, a, b), 0) for b in letters) + smoothing * len(letters) for r in (False, True)]
        for b in letters:
            p = [(counts.get((r, a, b), 0) + smoothing) / whole[r] for r in (False, True)]
            table[128 * a + b] = math.log(p[1] / p[0])
    return table


def log_ratio(text: Column, table: list[float]) -> Column:
    """The log-likelihood ratio of a string of the alphabet's characters, random over ordinary."""
    values = F.split(F.lit(",".join(f"{x:.6g}" for x in table)), ",").cast("array<double>")  # folded to a constant

    def step(acc: Column, c: Column) -> Column:
        return F.struct((acc["sum"] + F.get(values, 128 * acc["last"] + c)).alias("sum"), c.alias("last"))

    first = F.struct(F.lit(0.0).alias("sum"), F.lit(START).alias("last"))
    return F.aggregate(F.transform(F.split(text, ""), lambda c: F.ascii(c)), first, step, lambda acc: acc["sum"])


def markov_spans(text: Column, base: Column, table: list[float] | None, margin: float = MARGIN) -> Column:
    """Spans of candidates that look random and touch none of the given spans."""
    if table is None:
        return F.array().cast(_SPAN)
    found = _positions(text, CANDIDATE, CANDIDATE, 3, lambda hit, value: log_ratio(hit, table) > margin)
    return F.filter(found, lambda x: ~F.exists(base, lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"])))


def _names(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))))


def _count(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("long")


def with_spans(docs: DataFrame, table: list[float] | None, text_col: str = "text", margin: float = MARGIN) -> DataFrame:
    """``docs`` with ``__base`` and ``__spans``, both by start, then kind."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    based = docs.withColumn("__base", base_spans(text))
    return based.withColumn("__spans", F.array_sort(F.concat("__base", markov_spans(text, F.col("__base"), table, margin))))


def scan(docs: DataFrame, table: list[float] | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: counts of the patterns' spans, their digest and all spans as text. Other columns are left out."""
    found = with_spans(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), table)
    base, spans = F.col("__base"), F.col("__spans")
    return found.select(
        "doc_id", *(_count(base, k).alias(f"n_{KINDS[k]}") for k in range(3)), F.sha2(_names(base), 256).alias("base_sha256"),
        _names(spans).alias("spans"), (F.size(spans) - F.size(base)).cast("long").alias("n_markov"))


def mask(docs: DataFrame, table: list[float] | None, text_col: str = "text") -> DataFrame:
    """``docs`` with every span of its texts replaced by ``MASK``; spans that overlap are replaced together."""
    text = F.col(text_col)

    def step(acc: Column, x: Column) -> Column:
        fresh = F.concat(acc["out"], F.substring(text, acc["at"] + 1, x["start"] - acc["at"]), F.lit(MASK))
        return F.struct(F.greatest(acc["at"], x["end"]).alias("at"), F.when(x["start"] >= acc["at"], fresh).otherwise(acc["out"]).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    masked = F.aggregate("__spans", start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    return with_spans(docs, table, text_col).withColumn(text_col, F.when(F.size("__spans") > 0, masked).otherwise(text)).drop("__base", "__spans")


def random_strings(spark: SparkSession, n: int = SAMPLE_STRINGS) -> DataFrame:
    """Random strings of the usual alphabets, derived from a hash of their number, marked as random."""
    digest = F.sha2(F.col("id").cast("string"), 256)
    raw = F.base64(F.unhex(digest))
    plain = F.translate(raw, "+/=", "")
    kinds = F.array(F.substring(digest, 1, 40), raw, plain, F.upper(plain), F.lower(plain))
    return spark.range(n).select(F.get(kinds, (F.col("id") % 5).cast("int")).alias("text"), F.lit(True).alias("is_random"))


def ordinary_strings(docs: DataFrame, most: int = SAMPLE_DOCUMENTS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Identifiers of up to about ``most`` documents, chosen by a hash of their id, marked as ordinary.

    Words outside the patterns' matches, as they are, in capitals and joined, and numbers.
    """
    every = max(1, docs.count() // most)
    chosen = docs.filter(F.pmod(F.xxhash64(id_col), F.lit(every)) == 0)
    text = F.coalesce(F.col(text_col), F.lit(""))
    for pattern in (ASSIGN, ACCESS, "[0-9a-f]{%d,}" % MIN_HEX):
        text = F.regexp_replace(text, pattern, " ")
    words = chosen.select(F.array_distinct(F.regexp_extract_all(text, F.lit(r"[A-Za-z0-9]+(?:[_+/=-][A-Za-z0-9]+)*"), F.lit(0))).alias("w"))
    words = words.select(F.explode("w").alias("w")).groupBy("w").agg(F.xxhash64("w").alias("h"))
    number = F.rpad(F.translate(F.hex(F.abs("h")), "ABCDEF", "012345"), 16, "7")
    forms = F.array("w", F.upper("w"), F.concat_ws("_", F.lower("w"), F.lower("w")), F.concat(F.initcap("w"), F.initcap("w")), number)
    return words.select(F.explode(forms).alias("text"), F.lit(False).alias("is_random"))


def trained(docs: DataFrame) -> list[float] | None:
    """Models for a corpus: random strings against the identifiers of its own texts."""
    return ratios(random_strings(docs.sparkSession).unionByName(ordinary_strings(docs)))
