"""Exact top-k search by inner product: bounds from segment statistics, coarse to fine, then exact scores.

With segments of a vector, mean m and root of the summed squared deviations d in each, the distance of two
vectors is at least that of their (sqrt(length) * m, d) summed over segments; equally the inner product is at most
sum(length * m * m' + d * d'). Few wide segments give a cheap loose bound, many narrow ones a tight one. A
block of queries meets a block of vectors: whatever the bound of a resolution puts below the k-th best
score found so far is left out, the rest goes on to the next resolution, and what survives is scored exactly.

Queries and vectors are dealt into blocks of at most ``BLOCK`` rows and each pair of blocks is one group, so a
task holds two blocks however many rows there are; a block pair returns k rows for each query, and a window
ranks them. Vectors that are null or hold null or non-finite components take no part; vectors of
different lengths do not meet. A query leaves out its own row only: of a row given twice each finds the other, and both
are found, in the order of their numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenantferry.session import materialise

SEGMENTS = (1, 4, 16)
BLOCK = 20_000
TILE_QUERIES, TILE_VECTORS = 256, 4096
OUT = "query_row long, query_id long, vec_row long, vec_id long, score long"


def whole_numbers(vector: Column, scale: int = 256) -> Column:
    """Each component times ``scale``, rounded down; null for vectors that take no part."""
    usable = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(usable, F.transform(vector, lambda x: F.floor(x.cast("double") * scale)))


def statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """Rows whose inner products bound those of the rows of x."""
    bounds = np.linspace(0, x.shape[1], segments + 1).astype(int)
    out = []
    for a, b in zip(bounds, bounds[1:]):
        if b > a:
            part = x[:, a:b]
            mean = part.mean(axis=1)
            out += [np.sqrt(b - a) * mean, np.sqrt(((part - mean[:, None]) ** 2).sum(axis=1))]
    return np.stack(out, axis=1) if out else np.zeros((len(x), 1))


def _exact(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of whole-number rows, as longs."""
    big = (np.abs(q).max(initial=0).astype(object) * np.abs(x).max(initial=0) * max(1, q.shape[1])) >= 1 << 53
    return q @ x.T if big else (q.astype(np.float64) @ x.T.astype(np.float64)).astype(np.int64)


def best(query_rows: np.ndarray, queries: np.ndarray, rows: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """(query, vector, score) of the k best other rows for each query, as places in the inputs; ties to the smaller id, then row."""
    order = np.lexsort((rows, ids))
    rows, vectors = rows[order], vectors[order]
    stats = [(statistics(queries.astype(float), s), statistics(vectors.astype(float), s)) for s in SEGMENTS]
    top = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in query_rows]  # scores, places
    for v in range(0, len(rows), TILE_VECTORS):
        part = slice(v, v + TILE_VECTORS)
        for a in range(0, len(query_rows), TILE_QUERIES):
            tile = slice(a, min(a + TILE_QUERIES, len(query_rows)))
            least = np.array([top[i][0][-1] if len(top[i][0]) == k else -np.inf for i in range(tile.start, tile.stop)])
            alive = query_rows[tile, None] != rows[None, part]
            lines = np.arange(alive.shape[0])
            columns = np.arange(alive.shape[1])
            for qs, xs in stats:
                lines = lines[alive[lines].any(axis=1)]
                columns = columns[alive[np.ix_(lines, columns)].any(axis=0)] if len(lines) else columns[:0]
                if not len(columns):
                    break
                bound = qs[tile][lines] @ xs[part][columns].T
                bound += 1e-9 * np.abs(bound) + 1e-6
                alive[np.ix_(lines, columns)] &= bound >= least[lines, None]
            lines = np.flatnonzero(alive.any(axis=1))
            columns = np.flatnonzero(alive.any(axis=0))
            if not len(lines):
                continue
            scores = _exact(queries[tile][lines], vectors[part][columns])
            here = columns + v
            for r, i in enumerate(lines):
                ok = alive[i, columns] & (scores[r] >= least[i])
                s, d = np.append(top[a + i][0], scores[r][ok]), np.append(top[a + i][1], here[ok])
                keep = np.lexsort((d, -s))[:k]
                top[a + i] = s[keep], d[keep]
    lens = [len(s) for s, _ in top]
    none = np.empty(0, np.int64)
    return (np.repeat(np.arange(len(top)), lens), order[np.concatenate([d for _, d in top] or [none])], np.concatenate([s for s, _ in top] or [none]))


def _matrix(v: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(x, np.int64) for x in v]) if len(v) else np.zeros((0, 0), np.int64)


def search(vectors: DataFrame, is_query: Column, k: int, id_col: str = "vec_id", vector_col: str = "embedding", block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest integer inner products of each query, ties to the smaller id."""
    numbers = vectors.select(F.col(id_col).alias("vec_id"), whole_numbers(F.col(vector_col)).alias("v"), F.coalesce(is_query, F.lit(False)).alias("q"))
    usable = materialise(numbers.filter("vec_id is not null and v is not null and size(v) > 0").withColumn("row", F.monotonically_increasing_id()), "vectors")
    sizes = usable.agg(F.count("*").alias("n"), F.sum(F.col("q").cast("long")).alias("q")).first()
    n_blocks, q_blocks = -(-sizes["n"] // block) or 1, -(-(sizes["q"] or 0) // block) or 1
    spread = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    xs = usable.select(F.size("v").alias("dim"), spread(n_blocks).alias("xb"), every(q_blocks).alias("qb"), "row", "vec_id", "v")
    qs = usable.filter("q").select(F.size("v").alias("dim"), every(n_blocks).alias("xb"), spread(q_blocks).alias("qb"), "row", "vec_id", "v")

    def meet(q: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(x):
            return pd.DataFrame({c: [] for c in OUT.replace(" long", "").split(", ")}, dtype="int64")
        number = lambda f, c: f[c].to_numpy(np.int64)
        i, j, scores = best(number(q, "row"), _matrix(q["v"]), number(x, "row"), number(x, "vec_id"), _matrix(x["v"]), k)
        return pd.DataFrame({
            "query_row": number(q, "row")[i], "query_id": number(q, "vec_id")[i], "vec_row": number(x, "row")[j], "vec_id": number(x, "vec_id")[j], "score": scores})

    keys = ["dim", "xb", "qb"]
    near = qs.groupBy(*keys).cogroup(xs.groupBy(*keys)).applyInPandas(meet, OUT)
    ranked = F.row_number().over(Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "vec_row"))
    return near.withColumn("rank", ranked).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
