"""Parity of source and target over all tables and tenants."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenantferry.functions.checksum import no_rows
from tenantferry.operators import parity
from tenantferry.operators.stats import union_all
from tenantferry.plans.planning import grid
from tenantferry.sources.slices import of_tenants, tenant_frame
from tenantferry.specs import TableSpec, any_case

verdict = parity.verdict


class ParityError(RuntimeError):
    pass


def verify(
    source: Mapping[str, DataFrame], target: Mapping[str, DataFrame], specs: Iterable[TableSpec],
    tenants: Iterable[str] | DataFrame | None = None, skipped: Iterable[str] = (), mode: str = "compat",
) -> DataFrame:
    """Report per tenant and table: counts, checksums, and whether they agree.

    ``tenants`` restricts it to those listed, who then appear even without rows on either side. A list
    is filtered in the scans; a frame with a ``tenant`` column is joined to the results. ``skipped`` names tables the plan left out. Rows that only the target has show up as well.
    """
    leave_out = set(skipped)
    checked = [s for s in specs if s.has_tenant and s.table_type == "BASE TABLE" and s.name not in leave_out]
    sides = [
        parity.all_metrics({s.name: of_tenants(side[s.name], s, tenants) for s in checked}, checked, mode)
        for side in (source, target)
    ]
    report = parity.compare_metrics(*sides, mode)
    if tenants is None:
        return report
    asked = grid(tenant_frame(report.sparkSession, tenants, any_case(checked)), [s.name for s in checked])
    zero = F.lit(0).cast("bigint")
    filled = asked.join(report, ["tenant", "table_name"], "left").select(
        "tenant", "table_name",
        F.coalesce("src_count", zero).alias("src_count"), F.coalesce("tgt_count", zero).alias("tgt_count"),
        F.coalesce("src_checksum", no_rows(mode)).alias("src_checksum"),
        F.coalesce("tgt_checksum", no_rows(mode)).alias("tgt_checksum"),
    )
    return parity.with_verdicts(filled)


def require_ok(report: DataFrame) -> None:
    """Raises when a table differs."""
    if not parity.verdict(report).first().ok:
        raise ParityError("source and target differ; see the report")


def isolation_report(target: Mapping[str, DataFrame], specs: Iterable[TableSpec], tenant) -> DataFrame:
    """Rows of other tenants per table on a single-tenant target; empty if isolated."""
    return union_all(parity.foreign_rows(target[s.name], s, tenant) for s in specs if s.has_tenant)
