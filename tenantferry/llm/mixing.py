"""Mixing: token weights raked to marginal targets, then documents sampled by the calibrated probabilities.

Documents fall into cells, one for each combination of the dimensions' values. Values without a target count as
``OTHER``, so the number of cells is at most the product of the targets' sizes, which is checked; only the cells'
token sums reach the driver. Iterative proportional fitting scales them to each dimension's targets in turn
until all hold. The fitted shares are scaled to a budget, ``KEEP`` of all tokens unless another part is given, and
a cell's keep probability is its scaled share over its own. Cells that would need more than they hold are kept
whole, and what the budget leaves is raked anew over the others, until none needs more: so a rare cell falls
short of its own target and changes no more than that. A document stays if a hash of its id falls below its
cell's probability. The draw depends on the id alone, so it is the same in each run, on each cluster, and for repeated rows.

Where targets come from the shares there are, values with less than ``LEAST`` of the tokens count as ``OTHER`` too.

Null values count as ``OTHER``, null texts as no tokens; documents without tokens weigh nothing and are drawn
by their cell's probability all the same. Targets of values that do not occur are left out and the rest
scaled up. A null id is drawn as the empty text.
"""

from __future__ import annotations

from math import prod

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenantferry.session import materialise

OTHER = "(other)"
MAX_CELLS = 1_000_000
ROUNDS, CLOSE = 200, 1e-9
#: Part of the tokens to keep, and share of a value that has a target of its own.
KEEP, LEAST = 0.5, 0.001
WORD = r"[^\x20\x09-\x0D]+"


def tokens(text: Column) -> Column:
    """Words of a text, as its token weight."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def topic(text: Column) -> Column:
    """A coarse topic from a text's form: tables, marked-up text, notices, or prose by length."""
    text = F.coalesce(text, F.lit(""))
    letters = F.length(text)
    return (
        F.when(text.contains(" | "), "table")
        .when(20 * (letters - F.length(F.translate(text, "#*$%&<>!", ""))) > letters, "marked")
        .when(F.lower(text).contains("license"), "notice")
        .when(letters < 1000, "short prose")
        .otherwise("long prose")
    )


def draw(id_: Column) -> Column:
    """A number in [0, 1) from the id: the first 13 hexadecimal digits of its MD5."""
    head = F.substring(F.md5(F.coalesce(id_.cast("string"), F.lit("")).cast("binary")), 1, 13)
    return F.conv(head, 16, 10).cast("double") / float(1 << 52)


def rake(cells: dict[tuple[str, ...], float], targets: list[dict[str, float]], rounds: int = ROUNDS, close: float = CLOSE) -> dict[tuple[str, ...], float]:
    """Shares of the cells that fit every dimension's targets, as near to the given ones as can be."""
    whole = sum(cells.values())
    share = {c: w / whole for c, w in cells.items() if w > 0} if whole > 0 else {}
    goals = _goals(share, targets)
    for _ in range(rounds):
        off = 0.0
        for i, goal in enumerate(goals):
            sums = dict.fromkeys(goal, 0.0)
            for c, s in share.items():
                if c[i] in sums:
                    sums[c[i]] += s
            for c, s in share.items():
                if goal:
                    now = sums.get(c[i], 0.0)
                    share[c] = s * goal.get(c[i], 0.0) / now if now > 0 else 0.0
            off = max([off, *(abs(sums[v] - g) for v, g in goal.items())])
        if off < close:
            break
    return share


def _goals(cells: dict[tuple[str, ...], float], targets: list[dict[str, float]]) -> list[dict[str, float]]:
    """Each dimension's targets of the values that occur, as shares of one; none if no target is left."""
    out = []
    for i, goal in enumerate(targets):
        here = {c[i] for c, w in cells.items() if w > 0}
        kept = {v: max(0.0, g) for v, g in goal.items() if v in here}
        rest = sum(kept.values())
        out.append({v: g / rest for v, g in kept.items()} if rest > 0 else {})
    return out


def probabilities(cells: dict[tuple[str, ...], float], targets: list[dict[str, float]], keep: float = KEEP) -> dict[tuple[str, ...], float]:
    """Keep probability of each cell, such that ``keep`` of all tokens stay; one for cells without tokens."""
    if not 0 < keep <= 1:
        raise ValueError("the part to keep is above zero and at most one")
    goals = _goals(cells, targets)
    budget = keep * sum(cells.values())
    aimed = {c: w for c, w in cells.items() if w > 0 and all(not g or g.get(c[i], 0.0) > 0 for i, g in enumerate(goals))}
    free = dict(aimed)
    whole: dict[tuple[str, ...], float] = {}
    p: dict[tuple[str, ...], float] = {}
    while free:
        left = budget - sum(whole.values())
        wanted = []
        for i, goal in enumerate(goals):
            had = dict.fromkeys(goal, 0.0)
            for c, w in whole.items():
                if c[i] in had:
                    had[c[i]] += w
            open_ = {c[i] for c in free}
            short = budget - sum(n for v, n in had.items() if v not in open_)  # for the values that still have some to give
            part = short / (sum(goal[v] for v in open_ if v in goal) or 1.0)
            wanted.append({v: max(g * part - had[v], 0.01 * g * part) for v, g in goal.items() if v in open_})
        fitted = rake(free, wanted)
        p = {c: left * fitted.get(c, 0.0) / w for c, w in free.items()}
        over = [c for c in p if p[c] > 1 + CLOSE]
        if not over:
            break
        whole |= {c: free.pop(c) for c in over}
    return {c: 1.0 if c in whole or not w else min(1.0, p.get(c, 0.0)) if c in aimed else 0.0 for c, w in cells.items()}


def report(cells: dict[tuple[str, ...], float], targets: list[dict[str, float]], p: dict[tuple[str, ...], float]) -> tuple[float, list[dict[str, tuple[float, float]]]]:
    """The part of the tokens that ``p`` keeps; and for each dimension's values the target and the share among the kept."""
    kept = {c: w * p[c] for c, w in cells.items()}
    all_, held = sum(cells.values()), sum(kept.values())
    goals = _goals(cells, targets)
    shares = [{v: (g, sum(w for c, w in kept.items() if c[i] == v) / held if held else 0.0) for v, g in goal.items()} for i, goal in enumerate(goals)]
    return held / all_ if all_ else 0.0, shares


def pooled(cells: dict[tuple[str, ...], float], least: float = LEAST) -> dict[tuple[str, ...], tuple[str, ...]]:
    """Each cell's values with those of less than ``least`` of the tokens replaced by ``OTHER``."""
    all_ = sum(cells.values())
    sums: dict[tuple[int, str], float] = {}
    for c, w in cells.items():
        for i, v in enumerate(c):
            sums[i, v] = sums.get((i, v), 0.0) + w
    return {c: tuple(v if sums[i, v] >= least * all_ else OTHER for i, v in enumerate(c)) for c in cells}


def tempered(cells: dict[tuple[str, ...], float], dim: int, power: float) -> dict[str, float]:
    """A dimension's targets from its own token shares, flattened by a power below one."""
    sums: dict[str, float] = {}
    for c, w in cells.items():
        sums[c[dim]] = sums.get(c[dim], 0.0) + w
    return {v: w**power for v, w in sums.items() if w > 0}


def cell_sums(marked: DataFrame, dims: list[str]) -> dict[tuple[str, ...], float]:
    """Tokens of each cell of frames with the struct ``__mix``."""
    keys = (F.col(f"__mix.{d}").alias(f"d{i}") for i, d in enumerate(dims))
    rows = marked.groupBy(*keys).agg(F.sum("__mix.weight").alias("w")).limit(MAX_CELLS + 1).collect()
    if len(rows) > MAX_CELLS:
        raise ValueError(f"more than {MAX_CELLS} cells")
    return {tuple(r)[:-1]: float(r["w"] or 0) for r in rows}


def mix(docs: DataFrame, dims: dict[str, Column], targets: dict[str, dict[str, float]] | float, weight: Column, id_col: str = "doc_id", keep: float = KEEP) -> DataFrame:
    """``docs`` with a struct ``__mix``: the dimensions' values, weight, probability and kept.

    targets: shares for each dimension's values; or a power by which the shares there are become flatter. With a
    power, a dimension may have ``MAX_CELLS`` values in all cells together, and more are refused.
    keep: the part of all tokens that stay.
    """
    named = {d: F.coalesce(c.cast("string"), F.lit(OTHER)) for d, c in dims.items()}
    if isinstance(targets, dict):
        named = {d: F.when(c.isin(list(targets[d])), c).otherwise(OTHER) for d, c in named.items()}
        if prod(len(targets[d]) + 1 for d in dims) > MAX_CELLS:
            raise ValueError(f"more than {MAX_CELLS} cells")
    marked = docs.withColumn("__mix", F.struct(*(c.alias(d) for d, c in named.items()), weight.alias("weight")))
    raw = cell_sums(marked, list(dims))
    counted = pooled(raw) if isinstance(targets, float) else {c: c for c in raw}
    cells: dict[tuple[str, ...], float] = {}
    for c, w in raw.items():
        cells[counted[c]] = cells.get(counted[c], 0.0) + w
    goals = [tempered(cells, i, targets) if isinstance(targets, float) else targets[d] for i, d in enumerate(dims)]
    p = probabilities(cells, goals, keep)
    names, keys = [f"__d{i}" for i in range(len(dims))], [f"__k{i}" for i in range(len(dims))]
    schema = ", ".join(["__p double", *(f"{x} string" for x in [*keys, *names])])
    # as a table its true size decides whether it is broadcast
    table = materialise(docs.sparkSession.createDataFrame([(p[counted[c]], *c, *counted[c]) for c in raw], schema), "cells")
    same = [F.col(f"__mix.{d}") == F.col(k) for d, k in zip(dims, keys)]
    joined = marked.join(table, same).drop(*keys)
    kept = draw(F.col(id_col)) < F.col("__p")
    values = (F.col(x).alias(d) for x, d in zip(names, dims))
    marks = F.struct(*values, F.col("__mix.weight").alias("weight"), F.col("__p").alias("probability"), kept.alias("kept"))
    return joined.withColumn("__mix", marks).drop("__p", *names)


def by_source_language_topic(docs: DataFrame, targets: dict[str, dict[str, float]] | float, keep: float = KEEP) -> DataFrame:
    dims = {"source": F.col("source"), "lang": F.col("lang"), "topic": topic(F.col("text"))}
    return mix(docs, dims, targets, tokens(F.col("text")), keep=keep)


def sample(docs: DataFrame, targets: dict[str, dict[str, float]] | float, keep: float = KEEP) -> DataFrame:
    """The documents drawn, with their columns as they are."""
    return by_source_language_topic(docs, targets, keep).filter("__mix.kept").drop("__mix")
