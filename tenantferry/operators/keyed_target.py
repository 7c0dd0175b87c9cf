"""A keyed target on plain Parquet, for catalogs that have no MERGE.

A table's rows lie in key buckets, one folder each. A batch of changes, or a bulk load, is merged with the buckets it
touches and these are written anew, by Spark's writer, as partitions of the next version; the others stay as they are. A
pointer published last says which version of each bucket counts, so a batch is seen whole or not at all, over all
its tables. A batch the pointer already names is skipped, and one cut short is written over by dynamic
partition overwrite when it comes again.

Rows keep ``_op`` and ``_pos``: a change that arrives late loses against a newer one, including
against a delete. There must be one writer at a time; a second one fails when it publishes.

A batch costs the buckets it touches: choose their number so that a bucket is a few hundred megabytes at most, and
batches so that each carries many changes.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenantferry import files
from tenantferry.operators.merge import latest_per_key
from tenantferry.sources.feed import LAST_ROW, POS, position
from tenantferry.specs import TableSpec

PROGRESS = T.StructType([
    T.StructField("tenant", T.StringType()),
    T.StructField("writer", T.StringType()),
    T.StructField("batch_id", T.LongType()),
    T.StructField("last_ts", T.TimestampType()),
    T.StructField("applied", POS),
    T.StructField("n_changes", T.LongType()),
])
BEFORE_ALL = ("", 0, -1)


class KeyedTarget:
    """``tenant_in_key`` keeps one copy per tenant of a row that moves between tenants."""

    def __init__(
        self, spark: SparkSession, root: str, specs: Mapping[str, TableSpec],
        buckets: int = 64, tenant_in_key: bool = False,
    ):
        self.spark, self.root, self.specs = spark, root.rstrip("/"), dict(specs)
        self.buckets, self.tenant_in_key = buckets, tenant_in_key
        self._meta = [
            T.StructField("_op", T.StringType()), T.StructField("_pos", POS),
        ]

    # -- pointer ----------------------------------------------------------------------------

    def state(self) -> dict:
        """Latest pointer. Keys: seq, tables {table: {bucket: version}}, progress (its version), writers {writer: batch}, handoff."""
        found = [n for n in files.names(self.spark, f"{self.root}/pointer") if n.endswith(".json")]
        if not found:
            return {"seq": 0, "tables": {}, "progress": None, "writers": {}, "buckets": self.buckets}
        state = json.loads(files.read_text(self.spark, f"{self.root}/pointer/{max(found)}"))
        if state["buckets"] != self.buckets:
            raise ValueError(f"target has {state['buckets']} buckets, not {self.buckets}")
        return state

    def _publish(self, state: dict) -> None:
        files.publish(self.spark, f"{self.root}/pointer/{state['seq']:012d}.json", json.dumps(state))

    # -- keys -------------------------------------------------------------------------------

    def keys(self, spec: TableSpec) -> list[str]:
        if not spec.pk:
            raise ValueError(f"{spec.name} has no primary key")
        lead = [spec.tenant_col] if self.tenant_in_key and spec.tenant_col not in spec.pk else []
        return lead + list(spec.pk)

    def bucket(self, spec: TableSpec) -> Column:
        return F.pmod(F.xxhash64(*self.keys(spec)), F.lit(self.buckets)).cast("int")

    # -- reading ----------------------------------------------------------------------------

    def _row_fields(self, spec: TableSpec) -> list[str]:
        return ["_op", "_pos", *spec.columns]

    def _rows(self, spec: TableSpec, versions: Mapping[str, int]) -> DataFrame:
        """Rows of the given versions of buckets, deletes still in place."""
        fields = self._meta + [T.StructField(f.name, f.dataType, True) for f in spec.schema.fields]
        layout = [T.StructField("_v", T.IntegerType()), T.StructField("_bucket", T.IntegerType())]
        schema, path = T.StructType(fields + layout), f"{self.root}/base/table_name={spec.name}"
        if not versions:
            return self.spark.createDataFrame([], schema).drop("_v")
        folders = [f"{path}/_v={v}/_bucket={b}" for b, v in versions.items()]
        return self.spark.read.schema(schema).option("basePath", path).parquet(*folders).drop("_v")

    def table(self, name: str, with_meta: bool = False) -> DataFrame:
        """Current rows of a table."""
        spec = self.specs[name]
        rows = self._rows(spec, self.state()["tables"].get(name, {})).where(F.col("_op") != "D")
        return rows.select(*(self._row_fields(spec) if with_meta else spec.columns))

    def tables(self) -> dict[str, DataFrame]:
        return {name: self.table(name) for name in self.specs}

    # -- writing ----------------------------------------------------------------------------

    def _write(self, spec: TableSpec, rows: DataFrame, version: int) -> None:
        placed = rows.select(*self._row_fields(spec), F.lit(version).alias("_v"), self.bucket(spec).alias("_bucket"))
        # AQE splits large buckets over several files and joins small ones; only partitions written here are replaced
        (
            placed.hint("rebalance", "_bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("_v", "_bucket").parquet(f"{self.root}/base/table_name={spec.name}")
        )

    def _touched(self, spec: TableSpec, rows: DataFrame) -> list[str]:
        # at most one row per bucket
        return [str(r[0]) for r in rows.select(self.bucket(spec).alias("b")).distinct().collect()]

    def _merge(self, spec: TableSpec, incoming: DataFrame, held: Mapping[str, int], touched: Iterable[str], version: int) -> dict[str, int]:
        """Writes the touched buckets anew with the newest row of each key; of equal positions the incoming one."""
        names, touched = self._row_fields(spec), list(touched)
        old = self._rows(spec, {b: held[b] for b in touched if b in held})
        both = incoming.select(*names, F.lit(1).alias("_new")).unionByName(old.select(*names, F.lit(0).alias("_new")))
        ranked = both.withColumn("_order", F.struct("_pos", "_new"))
        self._write(spec, latest_per_key(ranked, self.keys(spec), "_order"), version)
        return dict.fromkeys(touched, version)

    def _load(self, spec: TableSpec, rows: DataFrame, at: tuple, held: Mapping[str, int], version: int) -> dict[str, int]:
        """Writes the rows under ``version``, and buckets that had rows before, merged, under the next one.

        The rows are evaluated once, since a live source may give others the next time; what was written is read back.
        """
        self._write(spec, rows.select(F.lit("I").alias("_op"), position(*at).alias("_pos"), *spec.columns), version)
        folder = f"{self.root}/base/table_name={spec.name}/_v={version}"
        fresh = {n.removeprefix("_bucket="): version for n in files.names(self.spark, folder) if n.startswith("_bucket=")}
        both = [b for b in fresh if b in held]
        if both:
            # what was applied after ``at``, deletes included, wins over the rows
            fresh |= self._merge(spec, self._rows(spec, {b: version for b in both}), held, both, version + 1)
        return fresh

    def load(self, tables: Mapping[str, DataFrame], at: tuple = BEFORE_ALL, parallelism: int = 4) -> int:
        """Bulk load: rows replace those of equal key; no other row is removed.

        ``at`` is the log position taken before the rows were read; changes after it win over them.
        Only buckets that the rows fall into are rewritten. All tables become visible at
        once; up to ``parallelism`` of them are written side by side.
        """
        state = self.state()
        version = state["seq"] + 1
        for name in tables:  # what a load cut short has left under this number
            files.remove(self.spark, f"{self.root}/base/table_name={name}/_v={version}")
        with ThreadPoolExecutor(parallelism) as pool:
            writes = {
                name: pool.submit(self._load, self.specs[name], rows, at, state["tables"].get(name, {}), version)
                for name, rows in tables.items()
            }
        for name, write in writes.items():
            state["tables"][name] = state["tables"].get(name, {}) | write.result()
        state["seq"] = version + 1
        # the earliest of all loads: later ones win over the changes between by their rows' position
        state["handoff"] = min(filter(None, [[*at, LAST_ROW][:3], state.get("handoff")]))
        self._publish(state)
        return state["seq"]

    def handoff(self) -> tuple | None:
        """The position from which the feed completes what was loaded; None if nothing was, ``BEFORE_ALL`` if a load had none."""
        at = self.state().get("handoff")
        return tuple(at) if at else None

    def loaded(self, name: str, load: int) -> DataFrame:
        """The rows that a load, named by what ``load`` returned, has read from its source; until the next ``vacuum``."""
        spec, version = self.specs[name], load - 1
        folder = f"{self.root}/base/table_name={name}/_v={version}"
        wrote = {n.removeprefix("_bucket="): version for n in files.names(self.spark, folder) if n.startswith("_bucket=")}
        return self._rows(spec, wrote).select(*spec.columns)

    def apply(self, changes: DataFrame, writer: str, batch_id: int, tenant_col: str | None = None, parallelism: int = 4) -> bool:
        """Applies one batch of changes (``table_name, _op, _pos`` and row columns), once.

        Returns False when the pointer says that this writer's batch is in already. Pass a batch that Spark holds, as it is read once a table.
        """
        state = self.state()
        if state["writers"].get(writer, -1) >= batch_id:
            return False
        version = state["seq"] + 1

        def merge(spec: TableSpec) -> dict[str, int]:
            mine = changes.where(F.col("table_name") == spec.name)
            touched = self._touched(spec, mine)
            return self._merge(spec, mine, state["tables"].get(spec.name, {}), touched, version) if touched else {}

        with ThreadPoolExecutor(parallelism) as pool:
            done = dict(zip(self.specs, pool.map(merge, self.specs.values())))
        spec = next(iter(self.specs.values()))
        tenant = spec.tenant_of(F.col(tenant_col or spec.tenant_col).cast("string"))
        counted = changes.groupBy(tenant.alias("tenant")).agg(
            F.max("_pos").alias("applied"), F.count("*").alias("n_changes")
        )
        named = counted.select(
            "tenant", F.lit(writer).alias("writer"), F.lit(batch_id).cast("bigint").alias("batch_id"),
            F.current_timestamp().alias("last_ts"), "applied", "n_changes",
        )
        sums = named.unionByName(self._progress(state)).groupBy("tenant", "writer").agg(
            F.max("batch_id").alias("batch_id"), F.max("last_ts").alias("last_ts"),
            F.max("applied").alias("applied"), F.sum("n_changes").alias("n_changes"),
        )
        sums.write.mode("overwrite").parquet(f"{self.root}/progress/_v={version}")
        for name, versions in done.items():
            state["tables"][name] = state["tables"].get(name, {}) | versions
        state["seq"] = state["progress"] = version
        state["writers"][writer] = batch_id
        self._publish(state)
        return True

    def _progress(self, state: dict) -> DataFrame:
        if state["progress"] is None:
            return self.spark.createDataFrame([], PROGRESS)
        return self.spark.read.schema(PROGRESS).parquet(f"{self.root}/progress/_v={state['progress']}")

    def progress_of_writers(self) -> DataFrame:
        """Per tenant and writer the greatest applied position, the changes taken in, the last batch's number and its time."""
        return self._progress(self.state())

    def progress(self) -> DataFrame:
        """Per tenant the greatest applied position and the number of changes taken in."""
        return self.progress_of_writers().groupBy("tenant").agg(
            F.max("applied").alias("applied"), F.sum("n_changes").alias("n_changes")
        )

    def compact(self, replayed_up_to: tuple = BEFORE_ALL) -> int | None:
        """Forgets deletes at or below ``replayed_up_to``, a position nothing older than which can be delivered again.

        Deletes are remembered, since an older change may still arrive. Only buckets that hold such a delete are rewritten.
        """
        state = self.state()
        version, found = state["seq"] + 1, False
        past = (F.col("_op") == "D") & (F.col("_pos") <= position(*replayed_up_to))
        for name, held in state["tables"].items():
            spec = self.specs[name]
            hit = self._touched(spec, self._rows(spec, held).where(past))
            if hit:
                found = True
                rest = self._rows(spec, {b: held[b] for b in hit}).where(~past)
                left = self._touched(spec, rest)
                self._write(spec, rest, version)
                state["tables"][name] = {b: v for b, v in held.items() if b not in hit} | dict.fromkeys(left, version)
        if not found:
            return None
        state["seq"] = version
        self._publish(state)
        return version

    def vacuum(self) -> None:
        """Deletes folders and pointers that the latest pointer does not use; no reader may be active."""
        state = self.state()
        live = {f"progress/_v={state['progress']}"}
        for name, versions in state["tables"].items():
            live |= {f"base/table_name={name}/_v={v}/_bucket={b}" for b, v in versions.items()}
        for top in ["progress", *(f"base/table_name={name}" for name in self.specs)]:
            for v in self._folders(top):
                kept = [d for d in (v, *self._folders(v)) if d in live]
                for gone in [v] if not kept else [d for d in self._folders(v) if d not in live]:
                    files.remove(self.spark, f"{self.root}/{gone}")
        for n in files.names(self.spark, f"{self.root}/pointer"):
            if n.endswith(".json") and n < f"{state['seq']:012d}.json":
                files.remove(self.spark, f"{self.root}/pointer/{n}")

    def _folders(self, path: str) -> list[str]:
        return [f"{path}/{n}" for n in files.names(self.spark, f"{self.root}/{path}") if n.startswith(("_v=", "_bucket="))]
