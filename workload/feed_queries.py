"""Keyed merges, the change feed, and replication."""

from pyspark.sql import functions as F

from tenantferry import KeyedTarget, migrate, plan, replicate
from tenantferry.operators import merge
from tenantferry.session import scratch
from tenantferry.sources.coordinates import coordinate_scan, start_positions
from tenantferry.sources.feed import file_feed, newest_position, row_events, tenant_changes
from tenantferry.streaming.replicate import lag, lag_of
from workload import tables as w
from workload.registry import query

COLS = ", ".join(w.COLUMNS)
LIVE = f"select table_name, {COLS} from {{}} where op <> 'D'"
IMAGE = ", ".join(f"case when op = 'D' then b_{c} else {c} end as {c}" for c in w.COLUMNS)
# events of deletes carry the row in both images here, so plain columns serve for every op
POS = "log_file, log_pos, row_idx"


def _flat(df, pos="_pos"):
    return df.select("*", f"{pos}.log_file", f"{pos}.log_pos", f"{pos}.row_idx").drop(pos)


def _changes(spark, sf, tenants=None, **kw):
    return tenant_changes(w.feed(spark, sf), w.feed_specs(spark, sf), w.DB, tenants, **kw)


# -- keyed merges on whole tables ------------------------------------------------------------------

SRC, TGT = w.table_sql("activities"), w.drifted_sql("activities", "payload")
# what arrives: every source row of acc_1 and acc_3
ARRIVING = f"(select * from {SRC} where account_id in ('acc_1', 'acc_3'))"


def _merge_sides(spark, sf):
    source = w.table(spark, sf, "activities")
    arriving = source.where(F.col("account_id").isin("acc_1", "acc_3"))
    return w.drifted(source, "payload"), arriving


@query("jn7_upsert", f"select * from {TGT} where id not in (select id from {ARRIVING}) union all select * from {ARRIVING}")
def _(spark, sf):
    target, arriving = _merge_sides(spark, sf)
    return merge.upsert(target, arriving, ["id"])


@query("jn8_delete", f"select * from {TGT} where id not in (select id from {ARRIVING})")
def _(spark, sf):
    target, arriving = _merge_sides(spark, sf)
    return merge.delete_keys(target, arriving, ["id"])


@query("jn12_insert_if_absent", f"select * from {TGT} union all select * from {ARRIVING} where id not in (select id from {TGT})")
def _(spark, sf):
    target, arriving = _merge_sides(spark, sf)
    return merge.insert_ignore(target, arriving, ["id"])


@query("snk1_replacing_load", f"select * from {TGT} where id not in (select id from {ARRIVING}) union all select * from {ARRIVING}")
def _(spark, sf):
    held, arriving = _merge_sides(spark, sf)
    target = KeyedTarget(spark, scratch(spark, "target"), {"activities": w.spec(held, "activities")}, buckets=8)
    target.load({"activities": held})
    target.load({"activities": arriving})
    return target.table("activities")


# -- change events --------------------------------------------------------------------------------

@query("fil7_event_filter", f"select op, table_name, {POS} from {w.changes_sql()}")
def _(spark, sf):
    return _flat(row_events(w.feed(spark, sf), w.DB).select("op", "table_name", "pos"), "pos")


@query("fil2_tenant_changes", f"select table_name, op as _op, {POS}, {COLS} from {w.changes_sql()} where account_id = 'acc_1'")
def _(spark, sf):
    return _flat(_changes(spark, sf, ["acc_1"]))


@query("prj3_image_selection", f"select op as _op, id, account_id, {POS} from (select op, {IMAGE.replace('b_', '')}, {POS} from {w.changes_sql()})")
def _(spark, sf):
    return _flat(_changes(spark, sf).select("_op", "id", "account_id", "_pos"))


@query("prj4_schema_alignment", f"select table_name, op as _op, {POS}, id, account_id, score, null as region from {w.changes_sql()}")
def _(spark, sf):
    from pyspark.sql import types as T
    from tenantferry.specs import TableSpec
    feed = w.feed(spark, sf)
    row = feed.schema["after"].dataType
    # the catalog lacks two columns of the events and has one they do not carry
    known = T.StructType([row["id"], row["account_id"], row["score"], T.StructField("region", T.StringType())])
    specs = {n: TableSpec(n, known, ("id",), w.TENANT, w.DB) for n in ("activities", "leads")}
    return _flat(tenant_changes(feed, specs, w.DB))


@query("prj5_delete_keys", f"select table_name, id from {w.changes_sql()} where op = 'D'")
def _(spark, sf):
    return _changes(spark, sf).where(F.col("_op") == "D").select("table_name", "id")


@query("agg9_greatest_position", f"select account_id as tenant, max(struct_pack(f := log_file, p := log_pos, r := row_idx)).f as log_file, max(struct_pack(f := log_file, p := log_pos, r := row_idx)).p as log_pos, max(struct_pack(f := log_file, p := log_pos, r := row_idx)).r as row_idx from {w.changes_sql()} group by 1")
def _(spark, sf):
    top = _changes(spark, sf).groupBy(F.col("account_id").alias("tenant")).agg(F.max("_pos").alias("_pos"))
    return _flat(top)


@query("agg10_latest_change", f"select table_name, op as _op, {POS}, {COLS} from {w.latest_sql()}")
def _(spark, sf):
    return _flat(merge.latest_per_key(_changes(spark, sf), ["id", "table_name"]))


@query("agg10_latest_change_one_tenant", f"select table_name, op as _op, {POS}, {COLS} from {w.latest_sql(chr(39).join(['account_id = ', 'acc_2', '']))}")
def _(spark, sf):
    return _flat(merge.latest_per_key(_changes(spark, sf, ["acc_2"]), ["id", "table_name"]))


# -- start positions --------------------------------------------------------------------------------

DUMP = "event_id // 1000"


def _dump_line():
    """A dump says its coordinate in one of two ways; a line without a position is passed over."""
    kind, pos = F.col("event_id") % 50, F.col("event_id").cast("string")
    name = F.concat(F.lit("'bin."), F.col("user_id").cast("string"), F.lit("'"))
    old = F.concat(F.lit("-- CHANGE MASTER TO MASTER_LOG_FILE="), name)
    new = F.concat(F.lit("  CHANGE REPLICATION SOURCE TO SOURCE_LOG_FILE = "), name, F.lit(", SOURCE_LOG_POS = "), pos, F.lit(";"))
    return (
        F.when(kind == 7, F.concat(old, F.lit(";")))
        .when(kind == 9, F.concat(old, F.lit(", MASTER_LOG_POS="), pos, F.lit(";")))
        .when(kind == 12, new)
        .otherwise(F.concat(F.lit("INSERT INTO t VALUES ("), pos, F.lit(");")))
    )


@query("src5_coordinate_scan", f"select ({DUMP})::varchar as dump, 'bin.' || arg_min(user_id, event_id) as log_file, min(event_id)::bigint as log_pos from events where event_id % 50 = 9 group by 1")
def _(spark, sf):
    dumps = w.given(spark, sf, "events").select(
        F.expr("event_id div 1000").alias("dump"), "event_id", _dump_line().alias("value")
    )
    path = scratch(spark, "dumps")
    # one file per dump, its lines in order
    (
        dumps.repartition(F.col("dump")).sortWithinPartitions("dump", "event_id")
        .select("dump", "value").write.partitionBy("dump").text(path)
    )
    found = coordinate_scan(spark, f"{path}/*")
    return found.select(F.regexp_extract("file", r"dump=(\d+)", 1).alias("dump"), "log_file", "log_pos")


HANDOFF = "(select concat('u', user_id) as tenant, 'bin.000001' as log_file, min(event_id) as log_pos from events where user_id % 3 <> 0 group by 1)"
SAVED = "(select concat('u', user_id) as tenant, 'bin.000002' as log_file, max(event_id) as log_pos from events where user_id % 2 = 0 group by 1)"


@query("src6_start_position", f"select tenant, coalesce(s.log_file, h.log_file) as log_file, coalesce(s.log_pos, h.log_pos) as log_pos, case when s.tenant is not null then 'progress' else 'handoff' end as origin from {HANDOFF} h full join {SAVED} s using (tenant)")
def _(spark, sf):
    events = w.given(spark, sf, "events").select(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("tenant"), "user_id", "event_id")

    def at(rows, file, pos):
        return rows.groupBy("tenant").agg(pos.alias("log_pos")).withColumn("log_file", F.lit(file))

    handoff = at(events.where("user_id % 3 <> 0"), "bin.000001", F.min("event_id"))
    saved = at(events.where("user_id % 2 = 0"), "bin.000002", F.max("event_id"))
    return start_positions(handoff, saved)


# -- applying the feed ------------------------------------------------------------------------------

def merged_sql(where="true", keys="table_name, id"):
    """Snapshot of activities, then the feed: what the target must hold."""
    newest = w.latest_sql(where, keys)
    return (
        f"select table_name, {COLS} from {newest} where op <> 'D' union all "
        f"select 'activities', {COLS} from {w.SNAPSHOT_SQL} s where not exists "
        f"(select 1 from {newest} l where l.table_name = 'activities' and l.id = s.id)"
    )


def _target(spark, sf, with_snapshot=True, **kw):
    target = KeyedTarget(spark, scratch(spark, "target"), w.feed_specs(spark, sf), buckets=8, **kw)
    if with_snapshot:
        target.load({"activities": w.snapshot(spark, sf)})
    return target


def _rows(target):
    both = [df.withColumn("table_name", F.lit(n)) for n, df in target.tables().items()]
    return both[0].unionByName(both[1])


def _files(spark, sf):
    """The feed as files, in log order."""
    path = scratch(spark, "feed")
    w.feed(spark, sf).repartitionByRange(6, "pos").write.parquet(path)
    return path


def _stream(spark, sf, target, path, checkpoint, max_files=2, **kw):
    feed = file_feed(spark, path, w.feed(spark, sf).schema["after"].dataType, max_files)
    replicate(feed, target, w.DB, checkpoint, **kw).awaitTermination()


def _split(changes, at="bin.000003"):
    early = F.col("_pos.log_file") < at
    return changes.where(early), changes.where(~early)


@query("snk2_apply_changes", merged_sql())
def _(spark, sf):
    target = _target(spark, sf)
    for i, batch in enumerate(_split(_changes(spark, sf))):
        target.apply(batch, "batches", i)
    return _rows(target)


@query("snk2_apply_then_compact", merged_sql())
def _(spark, sf):
    target = _target(spark, sf)
    for i, batch in enumerate(_split(_changes(spark, sf))):
        target.apply(batch, "batches", i)
        target.compact()
    return _rows(target)


@query("snk5_progress", "select account_id as tenant, max(struct_pack(f := log_file, p := log_pos, r := row_idx)).f as log_file, max(struct_pack(f := log_file, p := log_pos, r := row_idx)).p as log_pos, max(struct_pack(f := log_file, p := log_pos, r := row_idx)).r as row_idx, count(*)::bigint as n_changes from " + w.changes_sql() + " group by 1")
def _(spark, sf):
    target = _target(spark, sf, with_snapshot=False)
    for i, batch in enumerate(_split(_changes(spark, sf))):
        target.apply(batch, "batches", i)
    return _flat(target.progress(), "applied")


@query("str1_tenant_stream", f"select table_name, {COLS} from {w.latest_sql(chr(39).join(['account_id = ', 'acc_3', '']))} where op <> 'D'")
def _(spark, sf):
    target = _target(spark, sf, with_snapshot=False)
    _stream(spark, sf, target, _files(spark, sf), scratch(spark, "cp"), tenants=["acc_3"])
    return _rows(target)


@query("src4_feed_from_position", f"select op, table_name, {POS} from {w.changes_sql()} where (log_file, log_pos, row_idx) > ('bin.000002', 300, 2)")
def _(spark, sf):
    feed = file_feed(spark, _files(spark, sf), w.feed(spark, sf).schema["after"].dataType)
    from tenantferry.sources.feed import position
    out, checkpoint = scratch(spark, "events"), scratch(spark, "cp")
    events = row_events(feed, w.DB).where(F.col("pos") > position("bin.000002", 300, 2))
    _flat(events.select("op", "table_name", "pos"), "pos").writeStream.option(
        "checkpointLocation", checkpoint
    ).trigger(availableNow=True).start(out, format="parquet").awaitTermination()
    return spark.read.parquet(out)


@query("str2_upserts", f"select table_name, {COLS} from {w.latest_sql()} where op <> 'D'")
def _(spark, sf):
    newest = merge.latest_per_key(_changes(spark, sf), ["id", "table_name"])
    return newest.where(F.col("_op") != "D").select("table_name", *w.COLUMNS)


@query("str3_deletes", f"select {COLS} from {w.SNAPSHOT_SQL} where id not in (select id from {w.latest_sql()} where op = 'D' and table_name = 'activities')")
def _(spark, sf):
    mine = _changes(spark, sf).where(F.col("table_name") == "activities")
    gone = merge.latest_per_key(mine, ["id"]).where(F.col("_op") == "D")
    return merge.delete_keys(w.snapshot(spark, sf), gone, ["id"])


@query("str4_small_batches", merged_sql())
def _(spark, sf):
    target = _target(spark, sf)
    _stream(spark, sf, target, _files(spark, sf), scratch(spark, "cp"), max_files=1)
    return _rows(target)


@query("str5_commits_per_table", "select table_name, count(*)::bigint as n_rows from (" + merged_sql() + ") group by 1")
def _(spark, sf):
    target = _target(spark, sf)
    target.apply(_changes(spark, sf), "batches", 0)
    return _rows(target).groupBy("table_name").agg(F.count("*").alias("n_rows"))


@query("str6_replay_changes_nothing", merged_sql())
def _(spark, sf):
    target = _target(spark, sf)
    changes = _changes(spark, sf)
    target.apply(changes, "batches", 0)
    target.apply(changes, "batches", 0)
    # the same events under another writer
    target.apply(_split(changes)[0], "again", 0)
    return _rows(target)


@query("str7_restart", merged_sql())
def _(spark, sf):
    path, checkpoint = scratch(spark, "feed"), scratch(spark, "cp")
    feed, target = w.feed(spark, sf), _target(spark, sf)
    early = F.col("pos.log_file") < "bin.000003"
    for part in (feed.where(early), feed.where(~early)):
        part.write.mode("append").parquet(path)
        _stream(spark, sf, target, path, checkpoint, max_files=8)
    return _rows(target)


@query("str8_handoff", f"select table_name, {COLS} from {w.latest_sql()} where op <> 'D'")
def _(spark, sf):
    # the bulk load sees the state after the first files, the hand-off lies before it
    early, _late = _split(_changes(spark, sf))
    target = _target(spark, sf, with_snapshot=False)
    seen = merge.latest_per_key(early, ["id", "table_name"]).where(F.col("_op") != "D")
    loads = {n: seen.where(F.col("table_name") == n).select(*w.COLUMNS) for n in target.specs}
    target.load(loads, ("bin.000001", 0, -1))
    _stream(spark, sf, target, _files(spark, sf), scratch(spark, "cp"), max_files=6, start=("bin.000001", 0, -1))
    return _rows(target)


@query("str8_captured_handoff", f"select table_name, {COLS} from {w.latest_sql()} where op <> 'D'")
def _(spark, sf):
    # nobody gives a position: the plan takes it from the log as it is, the load records it, replication asks the target
    early, _late = _split(_changes(spark, sf))
    target = _target(spark, sf, with_snapshot=False)
    seen = merge.latest_per_key(early, ["id", "table_name"]).where(F.col("_op") != "D")
    tables = {n: seen.where(F.col("table_name") == n).select(*w.COLUMNS) for n in target.specs}
    so_far = w.feed(spark, sf).where(F.col("pos.log_file") < "bin.000003")
    made = plan(tables, target.specs.values(), w.DB, "account_id", chunk_size=200, capture=lambda: newest_position(so_far, w.DB))
    migrate(made, tables, target, scratch(spark, "ledger"))
    _stream(spark, sf, target, _files(spark, sf), scratch(spark, "cp"), max_files=6, start=target.handoff())
    return _rows(target)


@query("str9_late_files", merged_sql())
def _(spark, sf):
    early, late = _split(_changes(spark, sf))
    target = _target(spark, sf)
    target.apply(late, "batches", 0)
    target.compact()
    target.apply(early, "batches", 1)
    return _rows(target)


LAG = """with c as (select account_id as tenant, struct_pack(log_file := log_file, log_pos := log_pos, row_idx := row_idx) as pos, log_file < 'bin.000003' as early from {}),
t as (select tenant, max(pos) as feed, max(case when early then pos end) as applied from c group by 1)
select tenant, feed.log_file || ':' || feed.log_pos || ':' || feed.row_idx as feed_pos, applied.log_file || ':' || applied.log_pos || ':' || applied.row_idx as applied_pos,
 (select count(*) from c where c.tenant = t.tenant and (applied is null or c.pos > applied))::bigint as pending, feed = applied as ready from t"""


def _lag(spark, sf, part, **kw):
    target = _target(spark, sf, with_snapshot=False)
    target.apply(_split(_changes(spark, sf))[part], "batches", 0)
    report = lag(w.feed(spark, sf), target, w.DB, **kw)

    def text(c):
        return F.concat(f"{c}.log_file", F.lit(":"), F.col(f"{c}.log_pos").cast("string"), F.lit(":"), F.col(f"{c}.row_idx").cast("string")).alias(c)

    return report.select("tenant", text("feed_pos"), text("applied_pos"), "pending", "ready")


@query("str10_lag", LAG.format(w.changes_sql()))
def _(spark, sf):
    return _lag(spark, sf, 0)


@query("str10_lag_past_the_applied", LAG.format(w.changes_sql()))
def _(spark, sf):
    return _lag(spark, sf, 0, recent=True)


LATE_LAG = """with c as (select account_id as tenant, struct_pack(log_file := log_file, log_pos := log_pos, row_idx := row_idx) as pos, log_file >= 'bin.000003' as late from {}),
t as (select tenant, max(pos) as feed, max(case when late then pos end) as applied, count(*) - count(*) filter (late) as n_missing from c group by 1),
p as (select *, greatest(n_missing, (select count(*) from c where c.tenant = t.tenant and (applied is null or c.pos > applied)))::bigint as pending from t)
select tenant, feed.log_file || ':' || feed.log_pos || ':' || feed.row_idx as feed_pos, applied.log_file || ':' || applied.log_pos || ':' || applied.row_idx as applied_pos,
 pending, pending = 0 as ready from p"""


@query("str10_lag_late_files", LATE_LAG.format(w.changes_sql()))
def _(spark, sf):
    # the later files came first; nothing is newer than what was applied, and still not all is there
    return _lag(spark, sf, 1)


@query("snk1_load_after_compact", merged_sql())
def _(spark, sf):
    target = _target(spark, sf)
    target.apply(_changes(spark, sf), "batches", 0)
    target.compact()
    target.load({"activities": w.snapshot(spark, sf)})
    return _rows(target)


# -- options --------------------------------------------------------------------------------------

EXIT = f"""(select table_name, op, {POS}, {COLS} from {w.changes_sql()} where account_id = 'acc_1' union all
 select table_name, 'D', {POS}, {', '.join('b_' + c for c in w.COLUMNS)} from {w.changes_sql()} where op = 'U' and b_account_id = 'acc_1' and account_id <> 'acc_1')"""
MOVE = f"""(select table_name, op, {POS}, {COLS} from {w.changes_sql()} where account_id = 'acc_1' union all
 select table_name, 'D', {POS}, {', '.join('b_' + c for c in w.COLUMNS)} from {w.changes_sql()} where op = 'U' and b_account_id = 'acc_1' and b_id <> id)"""


@query("str1_tenant_exit_deletes", f"select table_name, op as _op, {POS}, {COLS} from {EXIT}")
def _(spark, sf):
    return _flat(_changes(spark, sf, ["acc_1"], on_tenant_exit="delete"))


@query("str1_key_change_deletes", f"select table_name, op as _op, {POS}, {COLS} from {MOVE}")
def _(spark, sf):
    return _flat(_changes(spark, sf, ["acc_1"], on_key_change="delete"))


COPIES = f"""(select table_name, op, {POS}, {COLS} from {w.changes_sql()} where account_id is not null union all
 select table_name, 'D', {POS}, {', '.join('b_' + c for c in w.COLUMNS)} from {w.changes_sql()} where op = 'U' and b_account_id is not null and b_account_id is distinct from account_id)"""


@query("fil2_exit_per_copy", f"select table_name, {COLS} from (select * from {COPIES} qualify row_number() over (partition by table_name, account_id, id order by log_file desc, log_pos desc, row_idx desc) = 1) where op <> 'D'")
def _(spark, sf):
    target = _target(spark, sf, with_snapshot=False, tenant_in_key=True)
    _stream(spark, sf, target, _files(spark, sf), scratch(spark, "cp"), max_files=3, on_tenant_exit="delete")
    return _rows(target)


@query("e2e4_replicate", merged_sql())
def _(spark, sf):
    target = _target(spark, sf)
    _stream(spark, sf, target, _files(spark, sf), scratch(spark, "cp"))
    return _rows(target)


@query("e2e4_replicate_per_tenant", f"select table_name, {COLS} from {w.latest_sql(keys='table_name, account_id, id')} where op <> 'D'")
def _(spark, sf):
    target = _target(spark, sf, with_snapshot=False, tenant_in_key=True)
    _stream(spark, sf, target, _files(spark, sf), scratch(spark, "cp"), max_files=3)
    return _rows(target)
