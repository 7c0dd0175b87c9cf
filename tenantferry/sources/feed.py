"""The change feed: row events in log order, as files or from Kafka."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenantferry.sources.slices import tenant_frame
from tenantferry.specs import TableSpec, any_case, union_schema

OPS = ("I", "U", "D")
POS = T.StructType([
    T.StructField("log_file", T.StringType()),
    T.StructField("log_pos", T.LongType()),
    T.StructField("row_idx", T.IntegerType()),
])


def feed_schema(row: T.StructType) -> T.StructType:
    """Schema of a feed whose row images have the given columns. It is never inferred."""
    return T.StructType([
        T.StructField("op", T.StringType()),
        T.StructField("schema_name", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("pos", POS),
        T.StructField("before", row),
        T.StructField("after", row),
    ])


def file_feed(spark: SparkSession, path: str, row: T.StructType, max_files: int | None = None) -> DataFrame:
    """Streaming feed from Parquet files; ``max_files`` bounds one micro-batch."""
    reader = spark.readStream.schema(feed_schema(row))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def decode_feed(messages: DataFrame, row: T.StructType) -> DataFrame:
    """Feed out of JSON messages in a ``value`` column."""
    event = F.from_json(F.col("value").cast("string"), feed_schema(row))
    return messages.select(event.alias("e")).select("e.*")


def kafka_feed(
    spark: SparkSession, servers: str, topic: str, row: T.StructType, max_offsets: int | None = None,
) -> DataFrame:
    """Streaming feed from a Kafka topic of JSON events; needs Spark's Kafka package."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return decode_feed(reader.load(), row)


LAST_ROW = 2**31 - 1


def position(log_file: str, log_pos: int, row_idx: int = LAST_ROW) -> Column:
    """A literal position.

    An event's position is where it ends, as in the log. A coordinate without a row index thus lies
    after every row of the event that ends there.
    """
    return F.struct(
        F.lit(log_file).alias("log_file"),
        F.lit(log_pos).cast("bigint").alias("log_pos"),
        F.lit(row_idx).cast("int").alias("row_idx"),
    )


def row_events(feed: DataFrame, database: str) -> DataFrame:
    """Row operations of one database; DDL and other databases are dropped."""
    return feed.where(F.col("op").isin(*OPS) & (F.col("schema_name") == database))


def newest_position(feed: DataFrame, database: str) -> tuple[str, int, int] | None:
    """The position of the newest row operation in a feed, or None: what a load may take as its hand-off."""
    newest = row_events(feed, database).agg(F.max("pos").alias("pos")).first().pos
    return tuple(newest) if newest else None


def _image(feed: DataFrame, side: str, row: T.StructType) -> Column:
    """The row image with exactly the catalog's columns: missing ones NULL, others dropped."""
    present = set(feed.schema[side].dataType.fieldNames())
    return F.struct(*[
        (F.col(side)[f.name] if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in row.fields
    ])


def tenant_changes(
    feed: DataFrame,
    specs: Mapping[str, TableSpec],
    database: str,
    tenants: Iterable | DataFrame | None = None,
    on_tenant_exit: str = "ignore",
    on_key_change: str = "ignore",
    tenant_in_key: bool = False,
) -> DataFrame:
    """Changes of the wanted tenants: ``table_name, _op, _pos`` and the row's columns.

    Inserts and updates carry the image after the change, deletes the deleted row, and the
    tenant is tested on that image by exact equality, or as ``any_case`` says, before any deduplication. ``tenants`` is a
    list, a DataFrame with a ``tenant`` column for long lists, or None for every tenant.

    An update that leaves the tenant is dropped and one that changes the key leaves the old key
    behind, unless the options are set to ``delete``: then the old row is deleted. Where the target
    keeps a copy per tenant (``tenant_in_key``), every change of the tenant leaves the old copy's
    tenant, also if the new one is wanted too.
    """
    specs = dict(specs)
    row = union_schema(specs.values())
    tenant_cols = {s.tenant_col for s in specs.values()}
    if len(tenant_cols) != 1:
        raise ValueError("the tables of one feed must share the tenant column")
    tenant_col, one_case = tenant_cols.pop(), any_case(specs.values())
    spec_of_all = next(iter(specs.values()))
    long_list = isinstance(tenants, DataFrame)
    if on_tenant_exit == "delete" and long_list and not tenant_in_key:
        raise ValueError("on_tenant_exit='delete' needs the tenants as a list")

    def wanted(image: Column) -> Column:
        if tenants is None or long_list:
            return image[tenant_col].isNotNull()
        return image[tenant_col].isNotNull() & spec_of_all.is_one_of(image[tenant_col], tenants)

    events = row_events(feed, database).where(F.col("table_name").isin(*specs)).select(
        "op", "table_name", "pos",
        _image(feed, "before", row).alias("before"),
        _image(feed, "after", row).alias("after"),
    )
    before, after = F.col("before"), F.col("after")
    image = F.when(F.col("op") == "D", before).otherwise(after)
    changes = [F.when(wanted(image), F.struct(F.col("op").alias("_op"), image.alias("row")))]

    # each event yields its change and, if asked for, the delete of the row it moved away from
    drop_old = F.lit(False)
    if on_tenant_exit == "delete":
        left = ~before[tenant_col].eqNullSafe(after[tenant_col]) if tenant_in_key else ~wanted(after)
        drop_old = drop_old | (wanted(before) & left)
    if on_key_change == "delete":
        moved = F.lit(False)
        for spec in specs.values():
            differs = ~F.struct(*[before[c] for c in spec.pk]).eqNullSafe(F.struct(*[after[c] for c in spec.pk]))
            moved = moved | ((F.col("table_name") == spec.name) & differs)
        drop_old = drop_old | (wanted(before) & moved)
    if "delete" in (on_tenant_exit, on_key_change):
        old = F.struct(F.lit("D").alias("_op"), before.alias("row"))
        changes.append(F.when((F.col("op") == "U") & drop_old, old))

    if len(changes) == 1:
        # spelled out per operation, so that the scan can skip row groups by tenant
        deleted = F.col("op") == "D"
        flat = events.where((deleted & wanted(before)) | (~deleted & wanted(after))).select(
            "table_name", F.col("op").alias("_op"), F.col("pos").alias("_pos"), image.alias("row")
        )
    else:
        flat = events.select(
            "table_name", F.col("pos").alias("_pos"), F.explode(F.array_compact(F.array(*changes))).alias("c")
        ).select("table_name", "c._op", "_pos", "c.row")
    flat = flat.select("table_name", "_op", "_pos", "row.*")
    if long_list:
        listed = tenant_frame(feed.sparkSession, tenants, one_case).select(F.col("tenant").alias("_wanted"))
        flat = flat.join(listed, spec_of_all.tenant == F.col("_wanted"), "left_semi")
    return flat.select("table_name", "_op", "_pos", *row.fieldNames())
