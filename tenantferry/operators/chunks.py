"""Generating chunks and finding the chunk of a row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenantferry.functions import chunking
from tenantferry.operators.stats import with_widths
from tenantferry.session import materialise
from tenantferry.specs import TableSpec

# chunks made per generated array; a slice with more is spread over several tasks
BLOCK = 16_384


def explode_chunks(widths: DataFrame, block: int = BLOCK, keep: Sequence[str] = ()) -> DataFrame:
    """All ``(start_pk, end_pk)`` ranges of the slices: contiguous, the last one clipped.

    Done in two steps so that one huge slice neither builds one huge array nor stays in one task:
    first blocks of chunk numbers, spread over the cluster, then the numbers of each block.
    """
    spark, kind = widths.sparkSession, chunking.key_kind(widths)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = widths.withColumn(
        "block_no", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("chunk_count") - 1) / block)))
    ).repartition(tasks, "table_name", "tenant", "block_no")
    first = F.col("block_no") * block
    last = F.least(F.col("chunk_count"), first + F.lit(block)) - 1
    numbered = blocks.withColumn("i", F.explode(F.sequence(first, last)))
    started = numbered.withColumn(
        "start_pk", chunking.nth_start(F.col("min_pk"), F.col("step"), F.col("i"), F.col("wide"), kind)
    )
    end = chunking.end_of(F.col("start_pk"), F.col("max_pk"), F.col("step"), F.col("wide"), kind)
    return started.select(
        "tenant", "table_name", "pk_col", F.col("i").alias("chunk_no"), "start_pk", end.alias("end_pk"), *keep
    )


def _slices(spec: TableSpec, widths: DataFrame) -> tuple[DataFrame, str]:
    """The table's slices, and the kind of its own keys: signed ones stay whole numbers of 64 bits whatever the plan has."""
    own = chunking.WIDE if spec.unsigned else chunking.KEY
    bounds = [F.col(c).cast(own).alias(c) for c in ("min_pk", "max_pk")]
    return widths.where(F.col("table_name") == spec.name).select(F.col("tenant"), *bounds, "step", "wide"), own


def _numbered(df: DataFrame, spec: TableSpec, widths: DataFrame) -> DataFrame:
    """Rows inside a planned slice with the slice's columns, and the chunk's number in it as ``__number``."""
    mine, own = _slices(spec, widths)
    pk = spec.chunk_key
    joined = df.join(mine, spec.tenant == F.col("tenant")).where(pk.between(F.col("min_pk"), F.col("max_pk")))
    return joined.withColumn("__number", chunking.number_of(pk, F.col("min_pk"), F.col("step"), F.col("wide"), own))


def _start(spec: TableSpec, widths: DataFrame) -> Column:
    own = chunking.WIDE if spec.unsigned else chunking.KEY
    start = chunking.nth_start(F.col("min_pk"), F.col("step"), F.col("__number"), F.col("wide"), own)
    return start.cast(chunking.key_kind(widths))


def _marked(only: DataFrame, spec: TableSpec, widths: DataFrame) -> DataFrame:
    """Chunks as bits: a row for each 64 neighbouring numbers of a slice of which one is listed."""
    listed = only.where(F.col("table_name") == spec.name).select("tenant", F.col("start_pk").alias("__listed"))
    mine, own = _slices(spec, widths)
    key = F.col("__listed").cast(own)
    number = chunking.number_of(key, F.col("min_pk"), F.col("step"), F.col("wide"), own)
    found = listed.join(mine, "tenant").where(key.between(F.col("min_pk"), F.col("max_pk"))).withColumn("__number", number)
    found = found.where(_start(spec, widths) == F.col("__listed"))  # of another plan
    word = F.shiftright("__number", 6).alias("__word")
    bit = F.expr("shiftleft(1L, cast(__number & 63 as int))")
    return found.groupBy(F.col("tenant").alias("__tenant"), word).agg(F.bit_or(bit).alias("__bits"))


def assign_chunks(
    df: DataFrame, spec: TableSpec, widths: DataFrame, only: DataFrame | None = None, splits: DataFrame | None = None,
) -> DataFrame:
    """Adds ``tenant`` and ``start_pk`` to each row inside a planned slice, or inside the chunks in ``only``.

    An equi join on the tenant plus arithmetic, and one more on the chunk for each level of ``splits``. Rows outside
    the planned key span, such as those added after planning, belong to no chunk. Pass materialised
    widths: their size then decides whether they are broadcast; if not, AQE splits the partitions of a hot tenant.
    The chunks in ``only`` are written first as bits, 64 to a row, so that rows are seldom shuffled to look them up.
    """
    rows = _numbered(df, spec, widths)
    if only is not None and splits is None:
        marked = materialise(_marked(only, spec, widths), "marked")
        there = (F.col("tenant") == F.col("__tenant")) & (F.shiftright("__number", 6) == F.col("__word"))
        rows = rows.join(marked, there & F.expr("shiftright(__bits, cast(__number & 63 as int)) & 1 = 1"), "left_semi")
    rows = rows.withColumn("start_pk", _start(spec, widths)).drop("min_pk", "max_pk", "step", "wide", "__number")
    if splits is not None:
        of_table = splits.where(F.col("table_name") == spec.name)
        for level in range(1, (of_table.agg(F.max("level")).first()[0] or 0) + 1):
            rows = split_rows(rows, spec, of_table.where(F.col("level") == level))
        rows = _listed(rows, spec, only)
    return rows


def _listed(rows: DataFrame, spec: TableSpec, only: DataFrame | None) -> DataFrame:
    if only is None:
        return rows
    listed = only.where(F.col("table_name") == spec.name).select("tenant", "start_pk")
    return rows.join(listed, ["tenant", "start_pk"], "left_semi")


def split_rows(rows: DataFrame, spec: TableSpec, level: DataFrame) -> DataFrame:
    """Rows of the chunks that ``level`` splits go to the part they lie in; those between its parts to none."""
    at = [F.col(f"__{c}") for c in ("min_pk", "max_pk", "step", "wide")]
    parts = level.select("tenant", F.col("parent").alias("start_pk"), *(F.col(c).alias(f"__{c}") for c in ("min_pk", "max_pk", "step", "wide")))
    pk = spec.chunk_key
    part = F.when(pk.between(at[0], at[1]), chunking.start_of(pk, at[0], at[2], at[3], chunking.key_kind(level)))
    joined = rows.join(parts, ["tenant", "start_pk"], "left")
    placed = joined.withColumn("start_pk", F.when(at[0].isNull(), F.col("start_pk")).otherwise(part))
    return placed.where(F.col("start_pk").isNotNull()).drop("__min_pk", "__max_pk", "__step", "__wide")


def even_splits(df: DataFrame, spec: TableSpec, widths: DataFrame, chunk_size: int, most: float = 2.0) -> DataFrame:
    """Splits of the chunks that hold over ``most * chunk_size`` rows, and of theirs, until none does.

    ``widths`` assume that keys are spread evenly; where they are not, a chunk is cut anew over the keys that it
    holds, by its own density. Each level is one grouped pass over the rows of the chunks that are still too large, and
    a chunk cut has at least two parts with rows, so it ends. Rows that share one key stay together.
    """
    pk = spec.chunk_key.cast(chunking.key_kind(widths))
    rows = assign_chunks(df.select(*dict.fromkeys([spec.tenant_col, *spec.pk])), spec, widths)
    found, level = None, 0
    while True:
        sizes = rows.groupBy("tenant", "start_pk").agg(F.count("*").alias("total_rows"), F.min(pk).alias("min_pk"), F.max(pk).alias("max_pk"))
        level += 1
        large = sizes.where((F.col("total_rows") > most * chunk_size) & (F.col("max_pk") > F.col("min_pk"))).select(
            F.lit(spec.name).alias("table_name"), F.lit(spec.chunk_key_name).alias("pk_col"), "tenant", "min_pk", "max_pk", "total_rows",
            F.col("start_pk").alias("parent"), F.lit(level).alias("level"))
        large = materialise(with_widths(large, chunk_size), "splits")
        found = large if found is None else found.unionByName(large)
        if large.isEmpty():
            return found
        rows = split_rows(rows.join(large.select("tenant", F.col("parent").alias("start_pk")), ["tenant", "start_pk"], "left_semi"), spec, large)


def even_chunks(widths: DataFrame, splits: DataFrame) -> DataFrame:
    """The chunks of the slices and of the splits, without those that were split."""
    levels = [explode_chunks(widths).withColumn("level", F.lit(0))]
    # the start is not enough to tell a chunk from its first part
    levels.append(explode_chunks(splits.withColumnRenamed("level", "__level"), keep=("__level",)).withColumnRenamed("__level", "level"))
    gone = splits.select("tenant", "table_name", F.col("parent").alias("start_pk"), (F.col("level") - 1).alias("level"))
    return levels[0].unionByName(levels[1]).join(gone, ["tenant", "table_name", "start_pk", "level"], "left_anti").drop("level")


def chunk_counts(
    df: DataFrame, spec: TableSpec, widths: DataFrame, only: DataFrame | None = None, splits: DataFrame | None = None,
) -> DataFrame:
    """Rows per non-empty chunk. Counted by the chunk's number, then looked up: a list of chunks meets counts, not rows."""
    keys = df.select(*dict.fromkeys([spec.tenant_col, *spec.pk]))
    if splits is None:
        counts = _numbered(keys, spec, widths).groupBy("tenant", "__number").agg(F.count("*").alias("n"))
        counts = counts.join(_slices(spec, widths)[0], "tenant").withColumn("start_pk", _start(spec, widths))
    else:
        counts = assign_chunks(keys, spec, widths, None, splits).groupBy("tenant", "start_pk").agg(F.count("*").alias("n"))
    return _listed(counts, spec, only).select("tenant", F.lit(spec.name).alias("table_name"), "start_pk", "n")
