"""The fold of merges: its edges are numbers that are put in order natively, and its ids those of a queue of merges."""

from __future__ import annotations

import random

from tenantferry.llm import lattice, queries


def test_edges_are_sorted_without_a_comparator(spark):
    v = lattice.load(queries.PIECES)
    plan = lattice.dictionary(spark.createDataFrame([("a",)], "u string"), lattice.piece_table(spark, v), v)._jdf.queryExecution().optimizedPlan().toString()
    assert "sort_array(" in plan and "array_sort(" not in plan


def test_fold_agrees_with_a_queue(spark):
    v = lattice.load(queries.PIECES)
    rng, long = random.Random(9), lattice.LongUnits(v)
    made = {"".join(rng.choice(["th", "e", "er", "ß", "é", "日", "😀", "\x01", "1", ",", "aa", "in"]) for _ in range(rng.randint(1, 30))) for _ in range(300)}
    odd = {"a", lattice.SPACE, "\n", "\x00", "😀" * lattice.LONG, "a" * lattice.LONG, lattice.SPACE + "ab" * 29, "日本語", "́e"}
    words = [w for w in made | {lattice.SPACE + w for w in made} | odd if len(w) <= lattice.LONG]
    got = lattice.dictionary(spark.createDataFrame([(w,) for w in words], "u string"), lattice.piece_table(spark, v), v).collect()
    assert {r.u: r.ids for r in got} == {w: long.ids(w) for w in words} and len(got) == len(words)
