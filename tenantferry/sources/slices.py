"""Reading one tenant's rows, whole or by key range."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import islice

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenantferry.session import metadata_rows
from tenantferry.specs import TableSpec


def is_tenant(column: Column, tenant, collation: str | None = None) -> Column:
    """Exact match, or under a collation such as ``UNICODE_CI`` to ignore case."""
    wanted = F.lit(tenant)
    if collation:
        return F.collate(column, collation) == F.collate(wanted, collation)
    return column == wanted


def tenant_slice(df: DataFrame, spec: TableSpec, tenant, collation: str | None = None) -> DataFrame:
    """All columns of one tenant's rows; the exact match is pushed down to the source."""
    return df.where(is_tenant(spec.tenant, spec.tenant_of(F.lit(tenant)), collation)).select(*spec.columns)


def of_tenants(df: DataFrame, spec: TableSpec, tenants) -> DataFrame:
    """Rows of listed tenants, filtered in the scan; anything but a list leaves the rows as they are."""
    if tenants is None or isinstance(tenants, DataFrame):
        return df
    return df.where(spec.is_one_of(F.col(spec.tenant_col), tenants))


def tenant_frame(spark: SparkSession, tenants, any_case: bool = False) -> DataFrame:
    """Distinct tenants, from a list or from a frame with a ``tenant`` column."""
    if not isinstance(tenants, DataFrame):
        tenants = metadata_rows(spark, [(t,) for t in dict.fromkeys(tenants)], "tenant string")
        return lower_tenants(tenants).distinct() if any_case else tenants
    tenants = tenants.select("tenant")
    return (lower_tenants(tenants) if any_case else tenants).distinct()


def lower_tenants(df: DataFrame) -> DataFrame:
    return df.withColumn("tenant", F.lower("tenant"))


def key_range(df: DataFrame, spec: TableSpec, start: int, end: int) -> DataFrame:
    return df.where(F.col(spec.pk[0]).between(spec.key_bound(start), spec.key_bound(end)))


def backslash_escapes(url: str) -> bool:
    """Databases in whose text literals a backslash is an escape, whose names stand in backticks, and
    which compare text without regard to case."""
    return url.startswith(("jdbc:mysql:", "jdbc:mariadb:"))


def _name(name: str, url: str) -> str:
    mark = "`" if backslash_escapes(url) else '"'
    return mark + name.replace(mark, 2 * mark) + mark


def _quoted(value, url: str) -> str:
    if isinstance(value, (int, float)):
        return str(value)
    text = str(value).replace("'", "''")
    return "'" + (text.replace("\\", "\\\\") if backslash_escapes(url) else text) + "'"


def chunk_predicate(spec: TableSpec, tenant, start: int, end: int, url: str) -> str:
    """The rows of a chunk. The tenant matches exactly, or in lower case, so that no row is read under two predicates."""
    column, value = _name(spec.tenant_col, url), _quoted(tenant, url)
    exact = f"LOWER({column})" if spec.any_case else column
    same = f"{column if backslash_escapes(url) else exact} = {value}"
    if backslash_escapes(url) and isinstance(tenant, str):
        # the first lets an index find the rows, the second leaves those of other case or with blanks behind
        same += " AND " + " = ".join(f"CAST(CONVERT({x} USING utf8mb4) AS BINARY)" for x in (exact, value))
    return f"{same} AND {_name(spec.pk[0], url)} BETWEEN {int(start)} AND {int(end)}"


def jdbc_chunks(
    spark: SparkSession, url: str, spec: TableSpec, chunks: Iterable[tuple], properties: dict | None = None,
) -> DataFrame:
    """One partition per ``(tenant, start, end)``, each its own bounded read of the source."""
    predicates = [chunk_predicate(spec, t, s, e, url) for t, s, e in chunks]
    return spark.read.jdbc(url, _name(spec.name, url), predicates=predicates, properties=properties or {})


def jdbc_waves(chunks: DataFrame, wave: int = 10_000) -> Iterator[list[tuple]]:
    """Chunk bounds in bounded lists, in chunk order.

    A JDBC scan needs its predicates on the driver; taking them in waves keeps that small
    however long the plan is.
    """
    rows = chunks.select("tenant", "start_pk", "end_pk").orderBy("tenant", "start_pk").toLocalIterator()
    while batch := [tuple(r) for r in islice(rows, wave)]:
        yield batch
