"""Catalog relations and table discovery.

The three relations have the columns of ``INFORMATION_SCHEMA.{TABLES, COLUMNS, KEY_COLUMN_USAGE}``
that are needed here. They hold one row per table or column, never per data row.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenantferry.session import metadata_rows
from tenantferry.specs import UNSIGNED, TableSpec

# fixed values: key types that can be cut into ranges
INTEGER_TYPES = ("tinyint", "smallint", "mediumint", "int", "bigint", "bigint unsigned")

TABLES = "table_schema string, table_name string, table_type string"
COLUMNS = "table_schema string, table_name string, column_name string, data_type string, ordinal_position int"
KEYS = "table_schema string, table_name string, column_name string, ordinal_position int"


@dataclass(frozen=True)
class Catalog:
    tables: DataFrame
    columns: DataFrame
    keys: DataFrame


def _type_name(kind: T.DataType) -> str:
    if kind == UNSIGNED:
        return "bigint unsigned"
    return "varchar" if isinstance(kind, T.StringType) else kind.simpleString()


def catalog_of(spark: SparkSession, specs: Iterable[TableSpec]) -> Catalog:
    """Catalog of declared tables."""
    specs = list(specs)
    tables = [(s.database, s.name, s.table_type) for s in specs]
    columns = [
        (s.database, s.name, f.name, _type_name(f.dataType), i)
        for s in specs for i, f in enumerate(s.schema.fields, 1)
    ]
    keys = [(s.database, s.name, c, i) for s in specs for i, c in enumerate(s.pk, 1)]
    return Catalog(
        metadata_rows(spark, tables, TABLES),
        metadata_rows(spark, columns, COLUMNS),
        metadata_rows(spark, keys, KEYS),
    )


def catalog_of_session(spark: SparkSession, database: str, pks: dict[str, list[str]]) -> Catalog:
    """Catalog of the tables known to the session; keys are declared by the caller."""
    # views of the session belong to no database, so the name is filled in
    listed = spark.catalog.listTables(database)
    tables = [
        (database, t.name, "VIEW" if t.tableType == "VIEW" else "BASE TABLE") for t in listed
    ]
    columns = []
    for t in listed:
        name = t.name if t.isTemporary else f"{database}.{t.name}"
        columns += [
            (database, t.name, f.name, _type_name(f.dataType), i)
            for i, f in enumerate(spark.table(name).schema.fields, 1)
        ]
    keys = [(database, t, c, i) for t, pk in pks.items() for i, c in enumerate(pk, 1)]
    return Catalog(
        metadata_rows(spark, tables, TABLES),
        metadata_rows(spark, columns, COLUMNS),
        metadata_rows(spark, keys, KEYS),
    )


def catalog_of_jdbc(spark: SparkSession, url: str, properties: dict | None = None) -> Catalog:
    """Catalog of a database that has INFORMATION_SCHEMA views."""
    def relation(view: str, columns: list[str]) -> DataFrame:
        df = spark.read.jdbc(url, f"INFORMATION_SCHEMA.{view}", properties=properties or {})
        return df.select(*[F.col(c.upper()).alias(c) for c in columns])

    keys = spark.read.jdbc(url, "INFORMATION_SCHEMA.KEY_COLUMN_USAGE", properties=properties or {})
    named = ["table_schema", "table_name", "column_name", "ordinal_position"]
    return Catalog(
        relation("TABLES", ["table_schema", "table_name", "table_type"]),
        relation("COLUMNS", ["table_schema", "table_name", "column_name", "data_type", "ordinal_position"]),
        keys.where(F.col("CONSTRAINT_NAME") == "PRIMARY").select(*[F.col(c.upper()).alias(c) for c in named]),
    )


def filter_names(tables: DataFrame, include: Iterable[str] = (), exclude: Iterable[str] = ()) -> DataFrame:
    """Include list first, then exclude list; an empty list means no restriction."""
    include, exclude = list(include), list(exclude)
    if include:
        tables = tables.where(F.col("table_name").isin(include))
    if exclude:
        tables = tables.where(~F.col("table_name").isin(exclude))
    return tables


def tenant_tables(
    catalog: Catalog, database: str, tenant_col: str,
    include: Iterable[str] = (), exclude: Iterable[str] = (),
) -> DataFrame:
    """Base tables that carry the tenant column, one ``table_name`` each."""
    base = catalog.tables.where(
        (F.col("table_schema") == database) & (F.col("table_type") == "BASE TABLE")
    )
    carrying = catalog.columns.where(F.col("column_name") == tenant_col)
    found = carrying.join(base, ["table_schema", "table_name"]).select("table_name")
    return filter_names(found, include, exclude)


def primary_keys(catalog: Catalog, database: str) -> DataFrame:
    """Key width, first column and its type, and the ordered column names per table."""
    typed = catalog.keys.where(F.col("table_schema") == database).join(
        catalog.columns.select("table_schema", "table_name", "column_name", "data_type"),
        ["table_schema", "table_name", "column_name"],
    )
    in_order = F.sort_array(F.collect_list(F.struct("ordinal_position", "column_name")))
    return typed.groupBy("table_name").agg(
        F.count("*").alias("n_pk"),
        F.min_by("column_name", "ordinal_position").alias("pk_col"),
        F.min_by("data_type", "ordinal_position").alias("pk_type"),
        F.array_join(F.transform(in_order, lambda k: k["column_name"]), ", ").alias("pk_names"),
    )


def key_check(tables: DataFrame, keys: DataFrame) -> DataFrame:
    """Adds ``chunkable`` and, where it is false, the ``reason``; keyless tables stay."""
    n = F.coalesce("n_pk", F.lit(0))
    integer = F.lower("pk_type").isin(*INTEGER_TYPES)
    # fixed values: the texts of the reasons
    reason = (
        F.when(n == 0, F.lit("no primary key"))
        .when(n > 1, F.concat(F.lit("composite PK ("), F.col("pk_names"), F.lit(")")))
        .when(~integer, F.concat(F.lit("non-integer PK type="), F.col("pk_type")))
    )
    return tables.join(keys, "table_name", "left").select(
        "table_name",
        F.when(reason.isNull(), F.col("pk_col")).alias("pk_col"),
        reason.isNull().alias("chunkable"),
        reason.alias("reason"),
    )
