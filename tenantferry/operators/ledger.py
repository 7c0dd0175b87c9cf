"""The ledger of completed chunks. Its key includes the tenant."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenantferry.files import exists
from tenantferry.functions import chunking
from tenantferry.session import metadata_rows

KEY = ["tenant", "table_name", "start_pk", "end_pk"]
ROW = "tenant string, table_name string, start_pk {0}, end_pk {0}, n_rows bigint"
SCHEMA = ROW.format(chunking.KEY)


def read_ledger(spark: SparkSession, path: str, kind: str = chunking.KEY) -> DataFrame:
    """The ledger with keys of the plan's ``kind``; entries that this kind can't hold are of other plans and left out.

    Runs before and after a table got unsigned keys wrote keys of two types, so all are read as the wider one.
    """
    if not exists(spark, path):
        return metadata_rows(spark, [], ROW.format(kind))
    every = spark.read.schema(ROW.format(chunking.WIDE)).parquet(path)
    if kind == chunking.WIDE:
        return every
    keys = {c: F.col(c).try_cast(kind) for c in ("start_pk", "end_pk")}
    return every.withColumns(keys).where("start_pk is not null and end_pk is not null")


def record(done: DataFrame, path: str) -> None:
    """Appends chunks whose load is committed and whose counts agree."""
    done.select(*KEY, "n_rows").write.mode("append").parquet(path)


def pending(chunks: DataFrame, ledger: DataFrame) -> DataFrame:
    return chunks.join(ledger.select(*KEY), KEY, "left_anti")


def completed(chunks: DataFrame, ledger: DataFrame) -> DataFrame:
    return chunks.join(ledger.select(*KEY), KEY, "left_semi")


def completed_counts(ledger: DataFrame) -> DataFrame:
    """Completed chunks per slice; one recorded by two runs counts once."""
    return ledger.select(*KEY).distinct().groupBy("tenant", "table_name").agg(F.count("*").alias("n_done"))
