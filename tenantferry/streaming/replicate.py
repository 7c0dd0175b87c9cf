"""Applying the change feed to a keyed target with Structured Streaming."""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tenantferry import files
from tenantferry.operators.keyed_target import KeyedTarget
from tenantferry.sources.coordinates import missing_positions
from tenantferry.sources.feed import LAST_ROW, position, row_events, tenant_changes
from tenantferry.sources.slices import lower_tenants, tenant_frame
from tenantferry.specs import any_case


def after_position(changes: DataFrame, at: tuple) -> DataFrame:
    # the log file by itself is a filter that a scan can skip data by
    return changes.where((F.col("_pos.log_file") >= at[0]) & (F.col("_pos") > position(*at)))


def after_start(changes: DataFrame, tenant_col: str, start: tuple | DataFrame | None, one_case: bool = False) -> DataFrame:
    """Changes past the start position: one for all, or per tenant ``tenant, log_file, log_pos``.

    With a list, tenants that are not on it are not replicated.
    """
    if start is None:
        return changes
    if isinstance(start, tuple):
        return after_position(changes, start)
    tenant = F.lower if one_case else F.col
    at = start.select(
        tenant("tenant").alias("_tenant"),
        F.struct(
            F.col("log_file"), F.col("log_pos").cast("bigint").alias("log_pos"),
            F.lit(LAST_ROW).alias("row_idx"),
        ).alias("_start"),
    )
    # the coordinate is the end of the last event taken in, so every row of that event is past it
    return changes.join(at, tenant(tenant_col) == F.col("_tenant")).where(F.col("_pos") > F.col("_start")).select(*changes.columns)


def writer_of(spark: SparkSession, checkpoint: str) -> str:
    """The id of the query that owns a checkpoint folder; a new checkpoint at an old path has another."""
    return json.loads(files.read_text(spark, f"{checkpoint.rstrip('/')}/metadata"))["id"]


def wanted_changes(
    feed: DataFrame,
    target: KeyedTarget,
    database: str,
    tenants: Iterable | DataFrame | None = None,
    start: tuple | DataFrame | None = None,
    on_tenant_exit: str = "ignore",
    on_key_change: str = "ignore",
) -> DataFrame:
    """The changes that replication with these options applies."""
    tenant_col = next(iter(target.specs.values())).tenant_col
    changes = tenant_changes(
        feed, target.specs, database, tenants, on_tenant_exit, on_key_change, target.tenant_in_key
    )
    return after_start(changes, tenant_col, start, any_case(target.specs.values()))


def replicate(
    feed: DataFrame,
    target: KeyedTarget,
    database: str,
    checkpoint: str,
    tenants: Iterable | DataFrame | None = None,
    start: tuple | DataFrame | None = None,
    on_tenant_exit: str = "ignore",
    on_key_change: str = "ignore",
    interval: str | None = None,
) -> StreamingQuery:
    """Starts replication; with no ``interval`` it takes what is there and stops.

    Each micro-batch is one commit of the target. The id in the checkpoint folder names the writer, so
    a batch that Spark delivers again after a failure is recognised, and a new checkpoint at the same
    path starts anew instead. Batch size is set at the feed. Tenants asked for by name must have a
    start position if ``start`` is a list of them.

    A batch rewrites the key buckets it touches.
    """
    tenant_col = next(iter(target.specs.values())).tenant_col
    if isinstance(start, DataFrame) and tenants is not None:
        one_case = any_case(target.specs.values())
        known = lower_tenants(start) if one_case else start
        missing = missing_positions(tenant_frame(target.spark, tenants, one_case), known).limit(10).collect()
        if missing:
            raise ValueError(f"no start position for tenants such as {[r.tenant for r in missing]}")
    changes = wanted_changes(feed, target, database, tenants, start, on_tenant_exit, on_key_change)

    def apply_batch(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            # an empty batch leaves no commit
            if not kept.isEmpty():
                target.apply(kept, writer_of(target.spark, checkpoint), batch_id, tenant_col)
        finally:
            kept.unpersist()

    writer = changes.writeStream.foreachBatch(apply_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


def lag(
    feed: DataFrame, target: KeyedTarget, database: str, checkpoint: str | None = None, recent: bool = False, **options,
) -> DataFrame:
    """Per tenant the newest position in the feed, the newest applied one, and how many changes are pending.

    A tenant can be cut over when nothing is pending: no change lies past the newest applied one, and
    as many were applied as the feed holds, so that a file which comes late is not overlooked. The
    options (``tenants``, ``start`` and so on) must be those of ``replicate``. ``checkpoint`` tells whose
    changes count as applied; without it, those of the writer that applied most for a tenant. A tenant
    whose changes several writers share is then reported as pending, never as ready too soon.

    All that reads the feed's whole history. ``recent`` reads only what lies past the newest position the writer has
    applied, by a filter in the scan: right for a feed that is written in log order, where all before that
    position has been applied. It does not see files that come late, so ask once without it before the cut-over.
    """
    spec = next(iter(target.specs.values()))
    changes = wanted_changes(feed, target, database, **options).select(
        spec.tenant_of(F.col(spec.tenant_col).cast("string")).alias("tenant"), "_pos"
    )
    written = target.progress_of_writers()
    if checkpoint is not None:
        written = written.where(F.col("writer") == writer_of(target.spark, checkpoint))
    progress = written.groupBy("tenant").agg(F.max("applied").alias("applied"), F.max("n_changes").alias("n_changes"))
    if not recent:
        return lag_of(changes, progress)
    if checkpoint is None and len(target.state()["writers"]) > 1:
        raise ValueError("several writers have applied changes: name the checkpoint")
    newest = progress.agg(F.max("applied")).first()[0]
    return recent_lag_of(changes if newest is None else after_position(changes, tuple(newest)), progress)


def lag_of(changes: DataFrame, progress: DataFrame) -> DataFrame:
    applied = progress.select("tenant", "applied", F.col("n_changes").alias("n_applied"))
    newer = F.count_if(F.col("applied").isNull() | (F.col("_pos") > F.col("applied")))
    missing = F.count("*") - F.coalesce(F.max("n_applied"), F.lit(0))
    return (
        changes.join(applied, "tenant", "left").groupBy("tenant")
        .agg(
            F.max("_pos").alias("feed_pos"), F.max("applied").alias("applied_pos"),
            F.greatest(newer, missing).alias("pending"),
        )
        .withColumn("ready", F.col("pending") == 0)
    )


def recent_lag_of(newer: DataFrame, progress: DataFrame) -> DataFrame:
    """The same from the changes past the newest applied position only; tenants without any are ready."""
    found = newer.groupBy("tenant").agg(F.max("_pos").alias("newest"), F.count("*").alias("n"))
    both = found.join(progress.select("tenant", F.col("applied").alias("applied_pos")), "tenant", "full_outer")
    pending = F.coalesce("n", F.lit(0).cast("bigint"))
    return both.select("tenant", F.coalesce("newest", "applied_pos").alias("feed_pos"), "applied_pos", pending.alias("pending"), (pending == 0).alias("ready"))


def duplicate_positions(feed: DataFrame, database: str) -> DataFrame:
    """Positions that occur more than once with different content: an error in the feed."""
    same = row_events(feed, database).select("pos", F.xxhash64("op", "table_name", "before", "after").alias("h"))
    return same.distinct().groupBy("pos").agg(F.count("*").alias("n")).where("n > 1")
