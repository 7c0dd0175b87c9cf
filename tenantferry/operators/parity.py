"""Comparing two sides by count and checksum."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenantferry.functions.checksum import CHECKSUMS, no_rows
from tenantferry.operators.stats import union_all
from tenantferry.specs import TableSpec


def slice_metrics(df: DataFrame, spec: TableSpec, mode: str = "compat") -> DataFrame:
    """Count and checksum of every tenant's slice in one scan and one small shuffle."""
    return (
        df.where(F.col(spec.tenant_col).isNotNull())
        .groupBy(spec.tenant.alias("tenant"))
        .agg(F.count("*").alias("n"), CHECKSUMS[mode](spec).alias("checksum"))
        .select("tenant", F.lit(spec.name).alias("table_name"), "n", "checksum")
    )


def all_metrics(tables: Mapping[str, DataFrame], specs: Sequence[TableSpec], mode: str = "compat") -> DataFrame:
    # the source's column list is used for both sides
    return union_all(slice_metrics(tables[s.name], s, mode) for s in specs)


def compare_metrics(source: DataFrame, target: DataFrame, mode: str = "compat") -> DataFrame:
    """One row per tenant and table on either side, with the verdicts."""
    on = ["tenant", "table_name"]
    s = source.select(*on, F.col("n").alias("s_n"), F.col("checksum").alias("s_c"))
    t = target.select(*on, F.col("n").alias("t_n"), F.col("checksum").alias("t_c"))
    zero = F.lit(0).cast("bigint")
    both = s.join(t, on, "full_outer").select(
        *on,
        F.coalesce("s_n", zero).alias("src_count"),
        F.coalesce("t_n", zero).alias("tgt_count"),
        F.coalesce("s_c", no_rows(mode)).alias("src_checksum"),
        F.coalesce("t_c", no_rows(mode)).alias("tgt_checksum"),
    )
    return with_verdicts(both)


def with_verdicts(report: DataFrame) -> DataFrame:
    count_ok = F.col("src_count").eqNullSafe(F.col("tgt_count"))
    checksum_ok = F.col("src_checksum").eqNullSafe(F.col("tgt_checksum"))
    return report.select(
        "tenant", "table_name",
        "src_count", "tgt_count", count_ok.alias("count_ok"),
        "src_checksum", "tgt_checksum", checksum_ok.alias("checksum_ok"),
        (count_ok & checksum_ok).alias("ok"),
    )


def compare_chunks(source: DataFrame, target: DataFrame) -> DataFrame:
    """Counts of both sides per chunk; ``ok`` gates its completion."""
    on = ["tenant", "table_name", "start_pk"]
    s = source.select(*on, F.col("n").alias("s_n"))
    t = target.select(*on, F.col("n").alias("t_n"))
    zero = F.lit(0).cast("bigint")
    return s.join(t, on, "full_outer").select(
        *on,
        F.coalesce("s_n", zero).alias("src_count"),
        F.coalesce("t_n", zero).alias("tgt_count"),
        F.col("s_n").eqNullSafe(F.col("t_n")).alias("ok"),
    )


def verdict(report: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """True when every table is in order, also when there is none."""
    return report.groupBy(*by).agg(F.coalesce(F.bool_and("ok"), F.lit(True)).alias("ok"))


def foreign_rows(df: DataFrame, spec: TableSpec, tenant) -> DataFrame:
    """Rows of other tenants on a target that should hold one tenant only."""
    return (
        df.where(~spec.tenant.eqNullSafe(spec.tenant_of(F.lit(tenant))))
        .groupBy(F.col(spec.tenant_col).alias("tenant"))
        .agg(F.count("*").alias("n"))
        .select(F.lit(spec.name).alias("table_name"), "tenant", "n")
    )
