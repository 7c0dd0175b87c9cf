"""Helpers that several operators of this folder share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenantferry.session import materialise


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def utf8(text: Column) -> Column:
    """The text's UTF-8 bytes; no text counts as an empty one."""
    return F.coalesce(text, F.lit("")).cast("binary")


def empty_like(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)


def settled(df: DataFrame, label: str = "settled") -> DataFrame:
    """``df`` as a frame whose rows come in the same parts and order at each evaluation, so that numbers given to them stay.

    A choice of columns and rows of files is that already. Anything else, such as the outcome of a shuffle, is written
    first: its order may be another when it is computed again after a lost executor.
    """
    def reads_files(plan) -> bool:
        if plan.nodeName() in ("Project", "Filter"):
            return plan.deterministic() and reads_files(plan.children().apply(0))
        return plan.nodeName() == "LogicalRelation" and plan.relation().getClass().getSimpleName() == "HadoopFsRelation"

    return df if reads_files(df._jdf.queryExecution().optimizedPlan()) else materialise(df, label)
