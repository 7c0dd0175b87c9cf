"""Counts and key statistics per tenant slice and per chunk."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenantferry.functions import chunking
from tenantferry.specs import TableSpec


def union_all(frames) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def slice_stats(df: DataFrame, spec: TableSpec, *extra: Column) -> DataFrame:
    """Smallest and largest key and row count of every tenant; empty slices give no row."""
    pk = spec.chunk_key
    return (
        df.where(F.col(spec.tenant_col).isNotNull())
        .groupBy(spec.tenant.alias("tenant"))
        .agg(
            F.min(pk).alias("min_pk"), F.max(pk).alias("max_pk"),
            F.count("*").alias("total_rows"), *extra,
        )
        .select(F.lit(spec.name).alias("table_name"), F.lit(spec.chunk_key_name).alias("pk_col"), "*")
    )


def slice_counts(df: DataFrame, spec: TableSpec) -> DataFrame:
    return (
        df.groupBy(spec.tenant.alias("tenant"))
        .agg(F.count("*").alias("n"))
        .select(F.lit(spec.name).alias("table_name"), "*")
    )


def table_sizes(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Exact row count of each table."""
    return union_all(
        df.agg(F.count("*").alias("table_rows")).select(F.lit(name).alias("table_name"), "table_rows")
        for name, df in tables.items()
    )


def with_widths(stats: DataFrame, chunk_size: int) -> DataFrame:
    """Adds the chunk width and the number of chunks to slice statistics."""
    lo, hi = F.col("min_pk"), F.col("max_pk")
    return (
        stats.withColumn("step", chunking.step_width(lo, hi, F.col("total_rows"), chunk_size))
        .withColumn("wide", chunking.is_wide(lo, hi))
        .withColumn("chunk_count", chunking.chunk_count(lo, hi, F.col("step")))
    )
