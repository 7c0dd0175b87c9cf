"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

An n-gram counts once for a text. Its feature value is the log ratio of its smoothed share in toxic and in
other texts; a logistic regression with a small L2 term is fitted on those values. The product of
ratio and weight is the n-gram's part of the score, and n-grams without a part are left out, so that
scoring a text costs a hash and a table look-up for each of its characters and n.

Fitting takes at most ``MAX_LABELLED`` labelled rows, chosen by a hash of their id, half of them toxic if there
are so many, and at most ``MAX_FIT_TOTAL`` characters of them. Scoring takes whole texts of any length; null and empty texts get the score of a text
without any n-gram, which is that of the bias. With one class only, or none, in the labels, the score is
that class's share (0 without labels). Labels that are null, or of ids that are null, are not used;
of several labels for an id the largest holds, of several texts the one whose hash is largest.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenantferry.session import materialise

#: Labelled rows that the fit may use, and characters of all of them: these bound the driver's memory.
MAX_LABELLED, MAX_FIT_TOTAL = 3000, 8_000_000
#: Characters of one text that the fit may use; longer labelled texts are passed over in the fit, never cut.
MAX_FIT_CHARS = 20_000
SIZES = (3, 4, 5, 6)
BITS = 20
MIN_TEXTS = 4
FEATURES = 60_000
STEPS, RATE, L2 = 100, 0.05, 1e-4
THRESHOLD = 0.7


@dataclass
class Model:
    part: np.ndarray  # of each n-gram's hash, float32
    bias: float


def grams(text: str) -> np.ndarray:
    """The hash of every n-gram of a lower-case text, a space put before and after it."""
    codes = np.frombuffer(f" {' '.join(text.split())} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    out, h = [], codes * np.uint32(0x9E3779B1)
    for n in range(2, SIZES[-1] + 1):
        if len(codes) < n:
            break
        h = (h[:-1] ^ (h[:-1] >> np.uint32(15))) * np.uint32(0x85EBCA6B) + codes[n - 1:] * np.uint32(0x9E3779B1)
        if n in SIZES:
            out.append((h * np.uint32(0xC2B2AE35)) >> np.uint32(32 - BITS))
    return np.concatenate(out) if out else np.empty(0, np.uint32)


def fit(texts: list[str], toxic: list[int]) -> Model:
    """Ratios and weights from a bounded list of labelled texts."""
    y = np.asarray(toxic, np.float32)
    part = np.zeros(1 << BITS, np.float32)
    if not len(y) or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.0
        return Model(part, float(np.clip(np.log(share + 1e-9) - np.log(1 - share + 1e-9), -20, 20)))
    sets = [np.unique(grams(x)) for x in texts]
    rows = np.repeat(np.arange(len(sets), dtype=np.int32), [len(x) for x in sets])
    columns = np.concatenate(sets)
    del sets
    pos = np.bincount(columns[y[rows] == 1], minlength=1 << BITS) + 1.0
    neg = np.bincount(columns[y[rows] == 0], minlength=1 << BITS) + 1.0
    ratio = np.log(pos / pos.sum()) - np.log(neg / neg.sum())
    seen = pos + neg - 2
    # n-grams whose ratio stands out of its own sampling error
    strength = np.where(seen >= MIN_TEXTS, np.abs(ratio) / np.sqrt(1 / pos + 1 / neg), 0)
    chosen = np.sort(np.argsort(-strength, kind="stable")[:FEATURES])
    chosen = chosen[strength[chosen] > 2]
    place = np.full(1 << BITS, -1, np.int32)
    place[chosen] = np.arange(len(chosen))
    used = place[columns] >= 0
    rows, columns = rows[used], place[columns[used]]
    scale = ratio[chosen]
    weight, bias = np.zeros(len(chosen)), 0.0
    m = np.zeros((2, len(chosen) + 1))
    share = y.mean()
    each = np.where(y == 1, 0.5 / share, 0.5 / (1 - share))  # both classes weigh the same
    for step in range(1, STEPS + 1):
        z = np.bincount(rows, weights=(weight * scale)[columns], minlength=len(y)) + bias
        error = each * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / len(y)
        grad = np.bincount(columns, weights=error[rows], minlength=len(chosen)) * scale + L2 * weight
        grad = np.append(grad, error.sum())
        m[0] = 0.9 * m[0] + 0.1 * grad
        m[1] = 0.99 * m[1] + 0.01 * grad * grad
        move = RATE * (m[0] / (1 - 0.9**step)) / (np.sqrt(m[1] / (1 - 0.99**step)) + 1e-8)
        weight -= move[:-1]
        bias -= move[-1]
    part[chosen] = weight * scale
    part[np.abs(part) < 1e-3] = 0
    return Model(part, float(bias))


def score(model: Model, texts: list[str]) -> np.ndarray:
    out = np.empty(len(texts))
    for i, text in enumerate(texts):
        found = grams(text)
        found = np.unique(found[model.part[found] != 0])
        out[i] = model.part[found].sum(dtype=np.float64) + model.bias
    return 1 / (1 + np.exp(-np.clip(out, -50, 50)))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          max_labelled: int = MAX_LABELLED, max_total: int = MAX_FIT_TOTAL) -> Model:
    """Fit on labelled documents. The rows are chosen among the ids first, so that only their texts move.

    Each class takes its rows in the order of their ids' hashes until half of either bound is reached.
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("y")).dropna().groupBy("id").agg(F.max("y").alias("y"))
    fits = docs.select(F.col(id_col).alias("id"), F.lower(F.coalesce(F.col(text_col), F.lit(""))).alias("text"))
    # a hash and a length stand for the text, so that no text is shuffled
    sizes = fits.filter(F.length("text") <= MAX_FIT_CHARS).select("id", F.struct(F.xxhash64("text").alias("h"), F.length("text").alias("n")).alias("t"))
    ids = sizes.join(known, "id").groupBy("id", "y").agg(F.max("t").alias("t")).select("id", "y", "t.*")
    order = [F.xxhash64("id"), F.col("id")]
    half = [ids.filter(p).orderBy(*order).limit(max_labelled // 2) for p in ("y > 0", "y <= 0")]
    drawn = materialise(half[0].unionByName(half[1]), "labelled")
    # no more than max_labelled rows
    so_far = F.sum("n").over(Window.partitionBy(F.col("y") > 0).orderBy(*order))
    chosen = drawn.withColumn("so_far", so_far).filter(F.col("so_far") <= max_total // 2).select("id", "h", "y")
    mine = fits.withColumn("h", F.xxhash64("text")).join(F.broadcast(chosen), ["id", "h"])
    rows = mine.dropDuplicates(["id"]).orderBy("id").select("text", (F.col("y") > 0).cast("int").alias("y")).collect()
    return fit([r.text for r in rows], [r.y for r in rows])


def scores(docs: DataFrame, model: Model, text: Column) -> Column:
    """A double from 0 to 1 for a text column."""
    shared = docs.sparkSession.sparkContext.broadcast((model.part, model.bias))

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        here = Model(*shared.value)
        for texts in batches:
            yield pd.Series(score(here, list(texts)))

    return F.pandas_udf(run, "double")(F.lower(F.coalesce(text, F.lit(""))))


def score_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, score, predicted. Other columns are left out."""
    return docs.select(F.col(id_col).alias("doc_id"), scores(docs, model, F.col(text_col)).alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int"))
