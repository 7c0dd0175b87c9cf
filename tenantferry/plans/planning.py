"""Planning for all tenants at once: discover tables, check keys, take statistics, cut chunks."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenantferry.files import exists, remove
from tenantferry.operators.chunks import BLOCK, even_chunks, even_splits, explode_chunks
from tenantferry.operators.stats import slice_stats, union_all, with_widths
from tenantferry.session import materialise, metadata_rows
from tenantferry.sources.catalog import catalog_of, key_check, primary_keys, tenant_tables
from tenantferry.sources.feed import LAST_ROW
from tenantferry.sources.slices import of_tenants, tenant_frame
from tenantferry.specs import TableSpec, any_case

DEFAULT_CHUNK_SIZE = 5000
PARTS = ("tables", "chunks", "skipped", "splits")
POSITION = "log_file string, log_pos bigint, row_idx int"
STATS = "table_name string, pk_col string, tenant string, min_pk bigint, max_pk bigint, total_rows bigint"


@dataclass(frozen=True)
class Plan:
    """``tables`` one row per tenant and table, ``chunks`` their ranges, ``skipped`` the rest.

    Without a list of tenants ``skipped`` names every tenant of ``tables``, as with a list of them. If no table
    has slices, no tenant is known: then it has a row for each table that cannot be cut, its tenant NULL.
    """

    tables: DataFrame
    chunks: DataFrame
    skipped: DataFrame
    #: Chunks that were cut anew because they held too many rows, if the plan was made ``even``.
    splits: DataFrame | None = None
    #: The log position taken before the first look at the source, if the plan was made with ``capture``.
    handoff: tuple | None = None

    def write(self, path: str) -> None:
        spark = self.tables.sparkSession
        at = None if self.handoff is None else metadata_rows(spark, [self.handoff], POSITION)
        for name, part in [*((n, getattr(self, n)) for n in PARTS), ("handoff", at)]:
            if part is None:  # an older plan may have had it
                remove(spark, f"{path}/{name}")
            else:
                part.write.mode("overwrite").parquet(f"{path}/{name}")

    @staticmethod
    def read(spark: SparkSession, path: str) -> Plan:
        parts = {n: spark.read.parquet(f"{path}/{n}") for n in (*PARTS, "handoff") if exists(spark, f"{path}/{n}")}
        if "handoff" in parts:
            parts["handoff"] = tuple(parts["handoff"].first())
        return Plan(**parts)


def grid(tenants: DataFrame, names: Iterable[str]) -> DataFrame:
    """Every requested tenant with every table name."""
    listed = F.array(*[F.lit(n) for n in names]) if names else F.array().cast("array<string>")
    return tenants.select(F.col("tenant"), F.explode(listed).alias("table_name"))


def skipped_slices(checked: DataFrame, wanted: DataFrame, stats: DataFrame, known: bool = True) -> DataFrame:
    """Slices of the wanted tenants left out, with the reason: the table's key, or no rows for the tenant.

    If it is not ``known`` whether there are any tenants, tables that cannot be cut are named without one, too.
    """
    found = stats.select("tenant", "table_name", F.lit(True).alias("found"))
    return (
        checked.join(wanted, "table_name", "inner" if known else "left")
        .join(found, ["tenant", "table_name"], "left")
        .where(~F.col("chunkable") | (F.col("tenant").isNotNull() & F.col("found").isNull()))
        .select("tenant", "table_name", F.coalesce("reason", F.lit("no rows for customer")).alias("reason"))
    )


def plan(
    tables: Mapping[str, DataFrame],
    specs: Iterable[TableSpec],
    database: str,
    tenant_col: str,
    tenants: Iterable[str] | DataFrame | None = None,
    chunk_size: int = DEFAULT_CHUNK_SIZE,
    include: Iterable[str] = (),
    exclude: Iterable[str] = (),
    even: bool = False,
    capture: Callable[[], tuple | None] | None = None,
) -> Plan:
    """Plan of the given tenants, or of all that have rows.

    A list of tenants is filtered in the scans; a frame with a ``tenant`` column, for very many, is
    joined to the statistics and not to the rows.

    Chunks are equally wide, so they hold ``chunk_size`` rows only if keys are spread evenly. With ``even`` those of
    over twice that are cut anew, at the cost of further passes over the keys: of all, then of the chunks that are too large.

    ``capture`` gives the log's present position, ``(log_file, log_pos)`` or with a row index. It is called before any row is
    read, since keys added after the statistics lie in no chunk: what happens from then on is the feed's to deliver.

    Each table is read once otherwise, its key and tenant columns only. The statistics are written to the
    shared folder, so that chunks, totals and skips come from one and the same scan.
    """
    at = capture() if capture else None
    at = None if at is None else (*at, LAST_ROW)[:3]
    specs = {s.name: s for s in specs}
    one_case = any_case(specs.values())
    spark = next(iter(tables.values())).sparkSession
    catalog = catalog_of(spark, specs.values())
    found = tenant_tables(catalog, database, tenant_col, include, exclude)
    checked = key_check(found, primary_keys(catalog, database))
    hashed = F.col("table_name").isin([s.name for s in specs.values() if s.hashed and s.pk])
    checked = checked.select("table_name", (F.col("chunkable") | hashed).alias("chunkable"), F.when(~hashed, F.col("reason")).alias("reason"))

    # the catalog has one row per table, so its names may come to the driver
    listed = checked.select("table_name", "chunkable").collect()
    names = [r.table_name for r in listed]
    chunkable = [specs[r.table_name] for r in listed if r.chunkable]
    if chunkable:
        stats = union_all(slice_stats(of_tenants(tables[s.name], s, tenants), s) for s in chunkable)
    else:
        stats = metadata_rows(spark, [], STATS)
    listed_tenants = tenants
    if tenants is not None:
        tenants = tenant_frame(spark, tenants, one_case)
        stats = stats.join(tenants, "tenant", "left_semi")
    widths = materialise(with_widths(stats, chunk_size), "widths")

    wanted = grid(widths.select("tenant").distinct() if tenants is None else tenants, names)
    skipped = skipped_slices(checked, wanted, widths, known=tenants is not None)
    if not (even and chunkable):
        return Plan(widths, explode_chunks(widths), skipped, handoff=at)
    splits = union_all(even_splits(of_tenants(tables[s.name], s, listed_tenants), s, widths, chunk_size) for s in chunkable)
    return Plan(widths, even_chunks(widths, splits), skipped, splits, at)


def ordered_chunks(chunks: DataFrame) -> DataFrame:
    """Chunks by table and start, each tenant's first one marked: it runs alone, before the rest."""
    head = chunks.groupBy("tenant").agg(F.min(F.struct("table_name", "start_pk")).alias("head"))
    marked = chunks.join(head, "tenant").withColumn(
        "is_first", F.struct("table_name", "start_pk") == F.col("head")
    )
    return marked.drop("head").orderBy("tenant", "table_name", "start_pk")


def plan_totals(plan: Plan) -> DataFrame:
    """Rows and chunks per table, and over all tables where ``table_name`` is NULL."""
    return plan.tables.rollup("table_name").agg(
        F.sum("total_rows").alias("total_rows"), F.sum("chunk_count").alias("chunks")
    )


def plan_json(plan: Plan, database: str, tenant_col: str, page: int = BLOCK) -> DataFrame:
    """The plan as JSON documents, to be written as text: one per slice, planned or skipped.

    A slice of more than ``page`` chunks gets several documents, numbered by ``page_no``, so that no
    chunk list grows without bound.
    """
    pages = plan.chunks.groupBy("tenant", "table_name", F.floor(F.col("chunk_no") / page).alias("page_no")).agg(
        F.sort_array(F.collect_list(
            F.struct(F.col("start_pk").alias("start"), F.col("end_pk").alias("end"))
        )).alias("chunks")
    )
    # fixed values: the names in the documents
    head = [
        F.col("tenant").alias("customer_id"), F.lit(tenant_col).alias("tenant_column"),
        F.lit(database).alias("source_database"), F.col("table_name").alias("table"),
    ]
    stats = ["pk_col", "min_pk", "max_pk", "total_rows", "chunk_count"]
    planned = plan.tables.join(pages, ["tenant", "table_name"]).select(
        "tenant", "table_name", "page_no", F.to_json(F.struct(*head, *stats, "chunks")).alias("plan")
    )
    left_out = plan.skipped.select(
        "tenant", "table_name", F.lit(0).cast("bigint").alias("page_no"),
        F.to_json(F.struct(*head, "reason")).alias("plan"),
    )
    return planned.unionByName(left_out)
