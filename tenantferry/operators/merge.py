"""Keyed set operations: newest change per key, upsert, delete, replace, insert-if-absent.

In all of them the small side is broadcast when Spark knows it to be small, and otherwise both
sides are shuffled on the table's key, never on the tenant, so one large tenant stays spread out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(changes: DataFrame, keys: Sequence[str | Column], order: str = "_pos") -> DataFrame:
    """The change with the greatest position of each key.

    Applying full-row upserts and key deletes one after another leaves each key as its last change
    says. Spark turns the filter on the row number into a group limit on either side of the shuffle,
    so a key that holds much of the feed reaches its reducer as one row per input task.

    Name a number first in ``keys``: the sort then compares that and rarely looks further.
    """
    newest_first = Window.partitionBy(*keys).orderBy(F.col(order).desc())
    return changes.withColumn("_rank", F.row_number().over(newest_first)).where("_rank = 1").drop("_rank")


def upsert(target: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows replace those of equal key or are added. ``rows`` has unique keys."""
    kept = target.join(rows.select(*keys), list(keys), "left_anti").select(*target.columns)
    return kept.unionByName(rows.select(*target.columns))


# a replacing load differs from an upsert only in the engines that have triggers on delete
replace_rows = upsert


def delete_keys(target: DataFrame, keys_gone: DataFrame, keys: Sequence[str]) -> DataFrame:
    return target.join(keys_gone.select(*keys), list(keys), "left_anti").select(*target.columns)


def insert_ignore(target: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Adds rows whose key is not there yet; existing rows stay as they are."""
    fresh = rows.join(target.select(*keys), list(keys), "left_anti").select(*target.columns)
    return target.unionByName(fresh)


def apply_changes(target: DataFrame, latest: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target after the newest change per key (``_op`` and row columns)."""
    kept = delete_keys(target, latest, keys)
    return kept.unionByName(latest.where(F.col("_op") != "D").select(*target.columns))
