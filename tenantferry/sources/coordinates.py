"""Hand-off coordinates of all tenants in one scan, and where each stream starts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenantferry.functions.coordinates import coordinate, is_coordinate_line


def coordinate_scan(spark: SparkSession, path: str) -> DataFrame:
    """First valid coordinate line of every text file: ``file, log_file, log_pos``.

    A file without one gives no row. Lines are ordered by the block they lie in and by their
    order in it, so large dumps can be split between tasks.
    """
    lines = spark.read.text(path).where(is_coordinate_line(F.col("value"))).select(
        F.col("_metadata.file_path").alias("file"),
        F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("line"),
        coordinate(F.col("value")).alias("at"),
    )
    first = lines.where(F.col("at").isNotNull()).groupBy("file").agg(F.min_by("at", "line").alias("at"))
    return first.select("file", "at.log_file", "at.log_pos")


def start_positions(handoff: DataFrame, progress: DataFrame) -> DataFrame:
    """Per tenant the saved progress if there is one, else the hand-off coordinate.

    Both inputs have ``tenant, log_file, log_pos``. Tenants that have neither do not appear;
    see ``missing_positions``.
    """
    def at(df: DataFrame, name: str) -> DataFrame:
        return df.select("tenant", F.struct("log_file", "log_pos").alias(name))

    both = at(handoff, "handoff").join(at(progress, "saved"), "tenant", "full_outer")
    start = F.coalesce("saved", "handoff")
    return both.select(
        "tenant",
        start["log_file"].alias("log_file"),
        start["log_pos"].alias("log_pos"),
        F.when(F.col("saved").isNotNull(), "progress").otherwise("handoff").alias("origin"),
    )


def missing_positions(tenants: DataFrame, starts: DataFrame) -> DataFrame:
    """Requested tenants with no start position; replication must not begin for them."""
    return tenants.select("tenant").join(starts, "tenant", "left_anti")
