"""Bulk load of the pending chunks, with a parity check before a chunk counts as done."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenantferry.functions.chunking import key_kind
from tenantferry.operators import ledger as led
from tenantferry.operators.chunks import assign_chunks, chunk_counts
from tenantferry.operators.keyed_target import BEFORE_ALL, KeyedTarget
from tenantferry.operators.parity import compare_chunks
from tenantferry.operators.stats import union_all
from tenantferry.plans.planning import Plan
from tenantferry.session import materialise, metadata_rows, scratch
from tenantferry.sources.slices import jdbc_chunks, jdbc_waves

#: Most key ranges, and most tenants, by which the scan of a table is narrowed. A range more costs each row a comparison, so
#: neighbours become one where their gap is under this part of the span; all such gaps together are under a 64th of it.
RANGES, TENANTS = 64, 200
GAP = 4096


def pending_rows(source: DataFrame, spec, widths: DataFrame, pending: DataFrame | None, splits: DataFrame | None = None) -> DataFrame:
    """Source rows in the pending chunks; ``None`` stands for all chunks."""
    return assign_chunks(source, spec, widths, pending, splits).select(*spec.columns)


def pending_ranges(pending: DataFrame, most: int = RANGES) -> dict[str, list[tuple[int, int]]]:
    """The keys of each table's pending chunks, of all tenants together, as at most ``most`` ranges in order.

    The span of the chunks is cut into ``most`` cells; a cell's range goes from the first pending key in it to the last.
    Ranges with next to nothing between them are joined up. Two grouped aggregates, and at most ``most`` rows a table reach the driver.
    """
    wide = "decimal(38,0)"
    hull = pending.groupBy("table_name").agg(F.min("start_pk").cast(wide).alias("lo"), F.max("end_pk").cast(wide).alias("hi"))
    # whole-number division; a quotient's digits would be rounded
    sized = hull.withColumn("width", F.expr(f"cast((hi - lo) div {most} + 1 as {wide})"))
    start, end = F.col("start_pk").cast(wide), F.col("end_pk").cast(wide)
    cell = lambda key: F.expr(f"cast((cast({key} as {wide}) - lo) div width as int)")
    cells = pending.join(sized, "table_name").withColumn("cell", F.explode(F.sequence(cell("start_pk"), cell("end_pk"))))
    first = F.col("lo") + F.col("cell") * F.col("width")
    found = cells.groupBy("table_name", "cell").agg(
        F.min(F.greatest(start, first)).alias("a"), F.max(F.least(end, first + F.col("width") - 1)).alias("b"))
    out: dict[str, list[tuple[int, int]]] = {}
    for r in found.join(hull, "table_name").orderBy("table_name", "a").collect():
        ranges, a, b = out.setdefault(r.table_name, []), int(r.a), int(r.b)
        if ranges and a - ranges[-1][1] - 1 <= (int(r.hi) - int(r.lo)) // GAP:
            ranges[-1] = (ranges[-1][0], max(ranges[-1][1], b))
        else:
            ranges.append((a, b))
    return out


def pending_tenants(pending: DataFrame, most: int = TENANTS) -> dict[str, list[str] | None]:
    """The tenants of each table's pending chunks, or None where there are too many to list."""
    few = pending.select("table_name", "tenant").distinct().groupBy("table_name").agg(F.count("*").alias("n"))
    names = {r.table_name: r.n for r in few.collect()}
    short = [t for t, n in names.items() if n <= most]
    rows = pending.where(F.col("table_name").isin(short)).select("table_name", "tenant").distinct().collect() if short else []
    return {t: sorted(r.tenant for r in rows if r.table_name == t) if t in short else None for t in names}


def within(df: DataFrame, spec, ranges: list[tuple[int, int]], tenants: list[str] | None = None) -> DataFrame:
    """Rows in the ranges of the pending chunks: a filter in the scan, by which sources skip data."""
    if not spec.hashed:  # a hash is no column that a source could skip by
        df = df.where(reduce(Column.__or__, (F.col(spec.pk[0]).between(spec.key_bound(a), spec.key_bound(b)) for a, b in ranges)))
    # a plan holds tenants as text
    if tenants is not None and df.schema[spec.tenant_col].dataType == T.StringType():
        df = df.where(spec.is_one_of(F.col(spec.tenant_col), tenants))
    return df


def migrate(
    plan: Plan, source: Mapping[str, DataFrame], target: KeyedTarget, ledger_path: str,
    handoff: tuple | None = None,
) -> DataFrame:
    """Loads what the ledger does not list yet and returns the parity of the chunks it loaded.

    ``handoff`` is the log position taken before the first read, by default the one the plan has captured. The target
    records it in the same step in which the rows become visible; replication starts from ``target.handoff()``. A run
    cut short is simply repeated: scans are narrowed to the key ranges of the pending chunks, rows of
    chunks in the ledger are neither loaded nor counted again, and a load that was written but not
    recorded replaces itself.
    """
    spark = target.spark
    todo = materialise(led.pending(plan.chunks, led.read_ledger(spark, ledger_path, key_kind(plan.chunks, "start_pk"))), "pending")
    # if every chunk of the planned slices is to be loaded, rows need no look at the list
    whole = plan.splits is None and todo.count() == (plan.tables.agg(F.sum("chunk_count")).first()[0] or 0)
    ranges = pending_ranges(todo)
    names = sorted(ranges)
    if not names:
        return compare_chunks(*[_no_counts(spark)] * 2)

    counts = {"source": [], "target": []}
    only = None if whole else todo
    tenants = {} if whole else pending_tenants(todo)
    near = {n: within(source[n], target.specs[n], ranges[n], tenants.get(n)) for n in names}
    loaded = target.load({n: pending_rows(near[n], target.specs[n], plan.tables, only, plan.splits) for n in names}, handoff or plan.handoff or BEFORE_ALL)
    for name in names:
        spec = target.specs[name]
        # the source is read once: what the load read from it is what was written
        counts["source"].append(chunk_counts(target.loaded(name, loaded), spec, plan.tables, only, plan.splits))
        held = within(target.table(name), spec, ranges[name], tenants.get(name))
        counts["target"].append(chunk_counts(held, spec, plan.tables, only, plan.splits))
    both = compare_chunks(union_all(counts["source"]), union_all(counts["target"]))
    report = materialise(
        todo.join(both, ["tenant", "table_name", "start_pk"], "left").select(
            "tenant", "table_name", "start_pk", "end_pk",
            F.coalesce("src_count", F.lit(0).cast("bigint")).alias("src_count"),
            F.coalesce("tgt_count", F.lit(0).cast("bigint")).alias("tgt_count"),
            # a chunk that is empty on both sides is in order too
            F.coalesce("ok", F.lit(True)).alias("ok"),
        ),
        "parity",
    )
    led.record(report.where("ok").withColumn("n_rows", F.col("src_count")), ledger_path)
    return report


def _no_counts(spark):
    return metadata_rows(spark, [], "tenant string, table_name string, start_pk bigint, n bigint")


def migrate_jdbc(
    plan: Plan, url: str, target: KeyedTarget, ledger_path: str, handoff: tuple | None = None,
    wave: int = 10_000, properties: dict | None = None,
) -> int:
    """The same from a JDBC source, in waves of bounded chunk reads; returns the chunks not in order.

    Each chunk is one partition, and the database is read once. The waves of a table are written beside the ledger and
    loaded together, as one commit. The source sees as many reads at a time as the cluster has cores for the
    job, so size the cluster, or ``wave``, to what the database stands.
    """
    spark, failed = target.spark, 0
    todo = materialise(led.pending(plan.chunks, led.read_ledger(spark, ledger_path, key_kind(plan.chunks, "start_pk"))), "pending")
    names = sorted(r[0] for r in todo.select("table_name").distinct().collect())
    for name in names:
        chunks, staged = todo.where(F.col("table_name") == name), scratch(spark, f"staged-{name}")
        for bounds in jdbc_waves(chunks, wave):
            rows = jdbc_chunks(spark, url, target.specs[name], bounds, properties)
            rows.select(*target.specs[name].columns).write.mode("append").parquet(staged)
        read = spark.read.schema(target.specs[name].schema).parquet(staged)
        report = migrate(replace(plan, chunks=chunks), {name: read}, target, ledger_path, handoff)
        failed += report.where("not ok").count()
    return failed
