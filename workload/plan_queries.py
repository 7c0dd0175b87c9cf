"""Slice scans, statistics, chunks, plans, ledger and set operations on table names."""

from dataclasses import replace

from pyspark.sql import functions as F

from tenantferry import KeyedTarget, migrate, plan, verify
from tenantferry.functions.chunking import key_kind
from tenantferry.operators import ledger as led
from tenantferry.operators.chunks import assign_chunks, chunk_counts, explode_chunks
from tenantferry.operators.parity import compare_chunks
from tenantferry.operators.stats import slice_counts, slice_stats, union_all, with_widths
from tenantferry.plans import planning
from tenantferry.plans.migrate import pending_ranges, within
from tenantferry.session import materialise, metadata_rows, scratch
from tenantferry.sources.catalog import catalog_of, tenant_tables
from tenantferry.sources.slices import is_tenant, key_range, tenant_slice
from tenantferry.sources import synth
from tenantferry.specs import TableSpec, duplicate_keys, ordered
from workload import tables as w
from workload.catalog_queries import CARRYING, KEYS, REASON
from workload.registry import query

SIZE = 500
ACT, LEADS = w.table_sql("activities"), w.table_sql("leads")
CHUNKS = w.chunks_sql(w.CHUNKED, SIZE)
STATS = w.stats_sql(w.CHUNKED, SIZE)


def _one(spark, sf, name):
    df = w.table(spark, sf, name)
    return df, w.spec(df, name)


def _widths(spark, sf, names, size=SIZE):
    frames, specs = w.tables(spark, sf, names)
    stats = union_all(slice_stats(frames[n], specs[n]) for n in names)
    return frames, specs, materialise(with_widths(stats, size), "widths")


def _plan(spark, sf, tenants=None, **kw):
    frames, specs = w.tables(spark, sf)
    return frames, specs, plan(frames, specs.values(), w.DB, w.TENANT, tenants, SIZE, **kw)


# -- scans and filters ------------------------------------------------------------------------------

@query("src1_tenant_slice", "select * from orders where o_orderpriority = '1-URGENT'")
def _(spark, sf):
    orders = w.given(spark, sf, "orders")
    spec = TableSpec.of(orders, "orders", ["o_orderkey"], tenant_col="o_orderpriority")
    return tenant_slice(orders, spec, "1-URGENT")


@query("src2_key_range_scan", f"select c.tenant, c.start_pk, c.end_pk, count(a.id)::bigint as n, min(a.id)::bigint as first_id, max(a.id)::bigint as last_id from {w.chunks_sql(['activities'], SIZE)} c left join {ACT} a on a.account_id = c.tenant and a.id between c.start_pk and c.end_pk group by 1, 2, 3")
def _(spark, sf):
    frames, specs, widths = _widths(spark, sf, ["activities"])
    rows = assign_chunks(frames["activities"], specs["activities"], widths)
    read = rows.groupBy("tenant", "start_pk").agg(
        F.count("*").alias("n"), F.min("id").alias("first_id"), F.max("id").alias("last_id")
    )
    every = explode_chunks(widths).select("tenant", "start_pk", "end_pk")
    return every.join(read, ["tenant", "start_pk"], "left").fillna(0, ["n"])


@query("fil1_tenant_any_case", "select lang, count(*)::bigint as n from documents where lower(lang) = lower('EN') group by lang")
def _(spark, sf):
    docs = w.given(spark, sf, "documents")
    kept = docs.where(is_tenant(F.col("lang"), "EN", "UNICODE_CI"))
    return kept.groupBy(F.collate("lang", "UTF8_BINARY").alias("lang")).agg(F.count("*").alias("n"))


@query("fil3_key_range", "select * from orders where o_orderkey between 1000 and 1000000")
def _(spark, sf):
    orders = w.given(spark, sf, "orders")
    return key_range(orders, TableSpec.of(orders, "orders", ["o_orderkey"]), 1000, 1_000_000)


@query("fil8_empty_slices", f"select tenant, table_name, 'no rows for customer' as reason from (select unnest(['acc_1','acc_4','acc_9']) as tenant) t, (select unnest(['activities','leads','contacts','articles','ratings']) as table_name) n where not exists (select 1 from {STATS} s where s.tenant = t.tenant and s.table_name = n.table_name)")
def _(spark, sf):
    asked = metadata_rows(spark, [("acc_1",), ("acc_4",), ("acc_9",)], "tenant string")
    _, _, p = _plan(spark, sf, asked)
    return p.skipped.where(F.col("reason") == "no rows for customer")


@query("fil9_filter_on_alias", "select seq, half from (select event_id as seq, event_id % 1000 * 2 as half from events) where half < seq")
def _(spark, sf):
    events = w.given(spark, sf, "events")
    return events.select(F.col("event_id").alias("seq"), (F.col("event_id") % 1000 * 2).alias("half")).where("half < seq")


@query("fil11_point_lookup", "select event_id, user_id, event_type, value from events where event_id = 77")
def _(spark, sf):
    return w.given(spark, sf, "events").where(F.col("event_id") == 77).select("event_id", "user_id", "event_type", "value")


@query("prj1_all_columns_in_order", f"select * from {ACT}")
def _(spark, sf):
    df, spec = _one(spark, sf, "activities")
    return ordered(df.select(*reversed(df.columns)), spec)


# -- statistics and chunks ------------------------------------------------------------------------

@query("agg1_slice_stats", f"select table_name, tenant, 'id' as pk_col, min_pk, max_pk, total_rows from {STATS}")
def _(spark, sf):
    frames, specs = w.tables(spark, sf, w.CHUNKED)
    return union_all(slice_stats(frames[n], specs[n]) for n in w.CHUNKED)


@query("agg2_slice_counts", " union all ".join(f"select '{n}' as table_name, account_id as tenant, count(*)::bigint as n from {w.table_sql(n)} group by 2" for n in ("leads", "email_preferences", "order_lines")))
def _(spark, sf):
    frames, specs = w.tables(spark, sf, ["leads", "email_preferences", "order_lines"])
    return union_all(slice_counts(frames[n], specs[n]) for n in frames)


@query("agg3_chunk_counts", " union all ".join(f"select tenant, table_name, start_pk, count(*)::bigint as n from {w.chunks_sql([n], SIZE)} c join {w.table_sql(n)} r on r.account_id = c.tenant and r.id between start_pk and end_pk group by 1, 2, 3" for n in ("leads", "ratings")))
def _(spark, sf):
    frames, specs, widths = _widths(spark, sf, ["leads", "ratings"])
    return union_all(chunk_counts(frames[n], specs[n], widths) for n in frames)


@query("fn6_chunk_width", f"select table_name, tenant, step from {w.stats_sql(w.CHUNKED, 37)}")
def _(spark, sf):
    frames, specs = w.tables(spark, sf, w.CHUNKED)
    stats = union_all(slice_stats(frames[n], specs[n]) for n in w.CHUNKED)
    return with_widths(stats, 37).select("table_name", "tenant", "step")


@query("fn7_clipped_ends", f"select tenant, table_name, max(end_pk)::bigint as last_end, min(end_pk - start_pk + 1)::bigint as narrowest from {CHUNKS} group by 1, 2")
def _(spark, sf):
    _, _, widths = _widths(spark, sf, w.CHUNKED)
    return explode_chunks(widths).groupBy("tenant", "table_name").agg(
        F.max("end_pk").alias("last_end"), F.min(F.col("end_pk") - F.col("start_pk") + 1).alias("narrowest")
    )


@query("gen1_chunks", f"select tenant, table_name, 'id' as pk_col, start_pk, end_pk from {CHUNKS}")
def _(spark, sf):
    _, _, widths = _widths(spark, sf, w.CHUNKED)
    return explode_chunks(widths).drop("chunk_no")


@query("gen2_chunk_of_each_row", f"select id, account_id, start_pk, end_pk from {LEADS} join {w.chunks_sql(['leads'], SIZE)} on account_id = tenant and id between start_pk and end_pk")
def _(spark, sf):
    from tenantferry.functions.chunking import end_of
    frames, specs, widths = _widths(spark, sf, ["leads"])
    rows = assign_chunks(frames["leads"].select("id", "account_id"), specs["leads"], widths)
    ends = rows.join(widths.select("tenant", "max_pk", "step", "wide"), "tenant")
    return ends.select("id", "account_id", "start_pk", end_of(F.col("start_pk"), F.col("max_pk"), F.col("step"), F.col("wide")).alias("end_pk"))


@query("jn11_rows_in_chunks", f"select table_name, tenant, start_pk, sum(id)::bigint as id_sum from {w.chunks_sql(['articles'], 20)} join {w.table_sql('articles')} on account_id = tenant and id between start_pk and end_pk group by 1, 2, 3")
def _(spark, sf):
    frames, specs, widths = _widths(spark, sf, ["articles"], 20)
    rows = assign_chunks(frames["articles"].select("id", "account_id"), specs["articles"], widths)
    return rows.groupBy(F.lit("articles").alias("table_name"), "tenant", "start_pk").agg(F.sum("id").alias("id_sum"))


# -- plans ----------------------------------------------------------------------------------------

# every tenant with slices and every table left out for it
SKIPS = (
    f"(select asked as tenant, table_name, coalesce(r, 'no rows for customer') as reason from "
    f"(select distinct tenant as asked from {STATS}), (select table_name, {REASON} as r from {CARRYING} left join {KEYS} using (table_name)) k "
    f"where r is not null or not exists (select 1 from {STATS} s where s.tenant = asked and s.table_name = k.table_name))"
)
# a reason for each table that cannot be cut, whatever tenants there are
UNCUT = (
    f"(select null::varchar as tenant, table_name, reason from "
    f"(select table_name, {REASON} as reason from {CARRYING} left join {KEYS} using (table_name)) where reason is not null)"
)


@query("e2e1_plan", f"select tenant, table_name, min_pk, max_pk, total_rows, ((max_pk - min_pk) // step + 1)::bigint as chunk_count, null as reason from {STATS} union all select tenant, table_name, null, null, null, null, reason from {SKIPS}")
def _(spark, sf):
    _, _, p = _plan(spark, sf)
    planned = p.tables.select("tenant", "table_name", "min_pk", "max_pk", "total_rows", "chunk_count", F.lit(None).cast("string").alias("reason"))
    return planned.unionByName(p.skipped, allowMissingColumns=True)


@query("agg8_plan_totals", f"select table_name, sum(total_rows)::bigint as total_rows, sum((max_pk - min_pk) // step + 1)::bigint as chunks from {STATS} group by rollup (table_name)")
def _(spark, sf):
    _, _, p = _plan(spark, sf)
    return planning.plan_totals(p)


@query("prj8_reasons_of_unchunkable_tables", f"select table_name, reason, tenant is null as of_all_tenants from {UNCUT} where table_name in ('email_preferences', 'vendors', 'order_lines')")
def _(spark, sf):
    # no table has slices, so no tenant is known
    frames, specs = w.tables(spark, sf, ["email_preferences", "vendors", "order_lines"])
    p = plan(frames, specs.values(), w.DB, w.TENANT, chunk_size=SIZE)
    return p.skipped.unionByName(p.tables.select("tenant", "table_name", F.lit("planned").alias("reason"))).select(
        "table_name", "reason", F.col("tenant").isNull().alias("of_all_tenants"))


# -- chunks of even size where keys are not spread evenly ---------------------------------------------

# a thousandth of the keys lies far out
SKEWED = "case when event_id % 1000 = 0 then event_id * 1000000000 else event_id end"


@query("gen1_even_chunks", f"""
select account_id as tenant, count(*)::bigint as n_rows, sum(id)::bigint as id_sum, true as bounded, true as listed
from (select {SKEWED} as id, 'acc_' || (user_id % 5) as account_id from events) group by 1""")
def _(spark, sf):
    account = F.concat(F.lit("acc_"), (F.col("user_id") % 5).cast("string"))
    df = w.given(spark, sf, "events").select(F.expr(SKEWED).alias("id"), account.alias("account_id"))
    spec = TableSpec.of(df, "skewed", ["id"])
    p = plan({"skewed": df}, [spec], w.DB, w.TENANT, chunk_size=50, even=True)
    rows = assign_chunks(df, spec, p.tables, None, p.splits).join(p.chunks.select("tenant", "start_pk", "end_pk"), ["tenant", "start_pk"], "left")
    per_chunk = rows.groupBy("tenant", "start_pk").agg(
        F.count("*").alias("n"), F.sum("id").alias("s"), F.bool_and(F.coalesce(F.col("id").between(F.col("start_pk"), F.col("end_pk")), F.lit(False))).alias("listed"))
    return per_chunk.groupBy("tenant").agg(
        F.sum("n").alias("n_rows"), F.sum("s").cast("bigint").alias("id_sum"), (F.max("n") <= 100).alias("bounded"), F.bool_and("listed").alias("listed"))


# -- tables with a composite or a text key, cut by the key's hash -------------------------------------

HASHED = {"email_preferences": ("account_id", "conv_id", "turn"), "vendors": ("name",)}


def _hash_sql(columns):
    sized = " || ".join(f"coalesce(length({c}::varchar) || ':' || {c}::varchar, '~')" for c in columns)
    return f"('0x' || substr(md5({sized}), 1, 10))::bigint"


HASHED_ROWS = "(" + " union all ".join(
    f"select '{n}' as table_name, 'hash({', '.join(pk)})' as pk_col, account_id as tenant, {_hash_sql(pk)} as h from {w.table_sql(n)}" for n, pk in HASHED.items()) + ")"
HASHED_STATS = (
    f"(select *, greatest(1, ceil({SIZE // 10}::double / (total_rows::double / (max_pk - min_pk + 1)::double)))::bigint as step from "
    f"(select table_name, pk_col, tenant, min(h) as min_pk, max(h) as max_pk, count(*) as total_rows from {HASHED_ROWS} group by all))"
)
HASHED_CHUNKS = (
    f"(select tenant, table_name, pk_col, start_pk, least(start_pk + step - 1, max_pk)::bigint as end_pk from "
    f"(select *, unnest(range(min_pk, max_pk + 1, step)) as start_pk from {HASHED_STATS}))"
)


def _hashed(spark, sf):
    frames, specs = w.tables(spark, sf, list(HASHED))
    specs = {n: replace(s, hashed=True) for n, s in specs.items()}
    return frames, specs, plan(frames, specs.values(), w.DB, w.TENANT, chunk_size=SIZE // 10)


@query("pipe1_chunks_of_hashed_keys", f"select * from {HASHED_CHUNKS}")
def _(spark, sf):
    return _hashed(spark, sf)[2].chunks.select("tenant", "table_name", "pk_col", "start_pk", "end_pk")


@query("agg3_chunk_counts_of_hashed_keys", f"select c.tenant, c.table_name, start_pk, count(*)::bigint as n from {HASHED_CHUNKS} c join {HASHED_ROWS} r on r.tenant = c.tenant and r.table_name = c.table_name and h between start_pk and end_pk group by 1, 2, 3")
def _(spark, sf):
    frames, specs, p = _hashed(spark, sf)
    return union_all(chunk_counts(frames[n], specs[n], p.tables) for n in HASHED)


@query("e2e3_resume_of_hashed_keys", f"""
select c.table_name, c.tenant, count(distinct start_pk)::bigint as chunks, count(h)::bigint as n_rows, true as ok
from {HASHED_CHUNKS} c left join {HASHED_ROWS} r on r.tenant = c.tenant and r.table_name = c.table_name and h between start_pk and end_pk group by 1, 2""")
def _(spark, sf):
    frames, specs, p = _hashed(spark, sf)
    root = scratch(spark, "target")
    target = KeyedTarget(spark, root, specs, buckets=8)
    migrate(planning.Plan(p.tables, p.chunks.where("chunk_no % 3 = 0"), p.skipped), frames, target, f"{root}/ledger")
    migrate(p, frames, target, f"{root}/ledger")
    done = led.completed_counts(led.read_ledger(spark, f"{root}/ledger"))
    report = verify(frames, target.tables(), specs.values())
    return report.join(done, ["tenant", "table_name"]).select(
        "table_name", "tenant", F.col("n_done").alias("chunks"), F.col("tgt_count").alias("n_rows"), "ok")


# -- unsigned 64-bit keys, on both sides of the largest signed one, beside a table of signed ones ------

UNSIGNED_ID = "cast(cast(o_orderkey as {}) * 1000003 + 9223372036354775808 as decimal(20,0))"
UNSIGNED_ROWS = (
    f"(select 'postings' as table_name, concat('acc_', o_custkey % 5) as tenant, {UNSIGNED_ID.format('hugeint')}::hugeint as id from orders"
    f" union all select 'leads', account_id, id::hugeint from {LEADS})"
)
UNSIGNED_STATS = (
    f"(select *, greatest(1, ceil({SIZE // 10}::double / (total_rows::double / (max_pk - min_pk + 1)::double)))::hugeint as step from "
    f"(select table_name, tenant, min(id) as min_pk, max(id) as max_pk, count(*) as total_rows from {UNSIGNED_ROWS} group by all))"
)
UNSIGNED_CHUNKS = (
    f"(select tenant, table_name, start_pk, least(start_pk + step - 1, max_pk) as end_pk from (select *, min_pk + i * step as start_pk from "
    f"(select *, unnest(range(0, ((max_pk - min_pk) // step + 1)::bigint)) as i from {UNSIGNED_STATS})))"
)


def _unsigned(spark, sf):
    columns = UNSIGNED_ID.format("decimal(20,0)"), "concat('acc_', o_custkey % 5)", "o_orderstatus"
    postings = w.given(spark, sf, "orders").select(*(F.expr(e).alias(c) for e, c in zip(columns, ("id", "account_id", "status"))))
    leads, spec = _one(spark, sf, "leads")
    frames = {"postings": postings, "leads": leads}
    specs = {"postings": TableSpec.of(postings, "postings", ["id"], tenant_col=w.TENANT, database=w.DB), "leads": spec}
    return frames, specs, plan(frames, specs.values(), w.DB, w.TENANT, chunk_size=SIZE // 10)


@query("gen1_unsigned_chunks", f"select tenant, table_name, start_pk::varchar as start_pk, end_pk::varchar as end_pk from {UNSIGNED_CHUNKS}")
def _(spark, sf):
    chunks = _unsigned(spark, sf)[2].chunks
    return chunks.select("tenant", "table_name", F.col("start_pk").cast("string").alias("start_pk"), F.col("end_pk").cast("string").alias("end_pk"))


@query("agg3_unsigned_chunk_counts", f"select c.tenant, c.table_name, start_pk::varchar as start_pk, count(*)::bigint as n from {UNSIGNED_CHUNKS} c join {UNSIGNED_ROWS} r on r.tenant = c.tenant and r.table_name = c.table_name and id between start_pk and end_pk group by all")
def _(spark, sf):
    frames, specs, p = _unsigned(spark, sf)
    counts = union_all(chunk_counts(frames[n], specs[n], p.tables) for n in frames)
    return counts.withColumn("start_pk", F.col("start_pk").cast("string"))


@query("e2e3_resume_of_unsigned_keys", f"""
select c.table_name, c.tenant, count(distinct start_pk)::bigint as chunks, count(id)::bigint as n_rows, true as ok
from {UNSIGNED_CHUNKS} c left join {UNSIGNED_ROWS} r on r.tenant = c.tenant and r.table_name = c.table_name and id between start_pk and end_pk group by 1, 2""")
def _(spark, sf):
    frames, specs, p = _unsigned(spark, sf)
    root = scratch(spark, "target")
    target = KeyedTarget(spark, root, specs, buckets=8)
    migrate(planning.Plan(p.tables, p.chunks.where("chunk_no % 3 = 0"), p.skipped), frames, target, f"{root}/ledger")
    migrate(p, frames, target, f"{root}/ledger")
    done = led.completed_counts(led.read_ledger(spark, f"{root}/ledger", key_kind(p.chunks, "start_pk")))
    report = verify(frames, target.tables(), specs.values())
    return report.join(done, ["tenant", "table_name"]).select(
        "table_name", "tenant", F.col("n_done").alias("chunks"), F.col("tgt_count").alias("n_rows"), "ok")


# -- tenants that differ in case only -----------------------------------------------------------------

MIXED = "concat(case when c_custkey % 3 = 0 then 'ACC_' else 'acc_' end, c_custkey % 4)"
MIXED_ROWS = f"(select c_custkey as id, lower({MIXED}) as tenant from customer)"
MIXED_STATS = (
    f"(select *, greatest(1, ceil({SIZE // 10}::double / (total_rows::double / (max_pk - min_pk + 1)::double)))::bigint as step from "
    f"(select tenant, min(id) as min_pk, max(id) as max_pk, count(*) as total_rows from {MIXED_ROWS} group by 1))"
)


@query("e2e5_tenants_in_any_case", f"select 'clients' as table_name, tenant, ((max_pk - min_pk) // step + 1)::bigint as chunks, total_rows::bigint as n_rows, true as ok from {MIXED_STATS}")
def _(spark, sf):
    columns = "c_custkey", MIXED, "c_name"
    df = w.given(spark, sf, "customer").select(*(F.expr(e).alias(c) for e, c in zip(columns, ("id", "account_id", "name"))))
    spec = TableSpec.of(df, "clients", ["id"], tenant_col=w.TENANT, database=w.DB, any_case=True)
    source, root = {"clients": df}, scratch(spark, "target")
    p = plan(source, [spec], w.DB, w.TENANT, chunk_size=SIZE // 10)
    target = KeyedTarget(spark, root, {"clients": spec}, buckets=8)
    migrate(planning.Plan(p.tables, p.chunks.where("chunk_no % 2 = 0"), p.skipped), source, target, f"{root}/ledger")
    migrate(p, source, target, f"{root}/ledger")
    done = led.completed_counts(led.read_ledger(spark, f"{root}/ledger"))
    report = verify(source, target.tables(), [spec], ["Acc_0", "acc_1", "ACC_2", "aCC_3"])
    return report.join(done, ["tenant", "table_name"]).select(
        "table_name", "tenant", F.col("n_done").alias("chunks"), F.col("tgt_count").alias("n_rows"), "ok")


# -- reading the pending ranges only ------------------------------------------------------------------

ENDS = f"(select *, start_pk = min(start_pk) over (partition by table_name) or end_pk = max(end_pk) over (partition by table_name) as pending from {w.chunks_sql(['activities', 'leads'], 50)})"


@query("e2e3_rows_in_pending_ranges", " union all ".join(
    f"select '{n}' as table_name, count(*)::bigint as n_rows, sum(id)::bigint as id_sum from {w.table_sql(n)} r "
    f"where exists (select 1 from {ENDS} c where c.pending and c.table_name = '{n}' and r.id between c.start_pk and c.end_pk)" for n in ("activities", "leads")))
def _(spark, sf):
    # what the scans of a resumed load read when chunks at both ends of the keys are pending
    frames, specs, widths = _widths(spark, sf, ["activities", "leads"], 50)
    chunks = materialise(explode_chunks(widths), "chunks")
    ends = chunks.groupBy("table_name").agg(F.min("start_pk").alias("lo"), F.max("end_pk").alias("hi"))
    pending = chunks.join(ends, "table_name").where("start_pk = lo or end_pk = hi").drop("lo", "hi")
    ranges = pending_ranges(pending)
    read = {n: within(frames[n], specs[n], ranges[n]) for n in ranges}
    return union_all(
        read[n].agg(F.lit(n).alias("table_name"), F.count("*").alias("n_rows"), F.sum("id").cast("bigint").alias("id_sum")) for n in ("activities", "leads"))


@query("ord4_chunk_order", f"select tenant, table_name, start_pk, end_pk, row_number() over (partition by tenant order by table_name, start_pk) = 1 as is_first from {CHUNKS} order by 1, 2, 3")
def _(spark, sf):
    _, _, p = _plan(spark, sf)
    return planning.ordered_chunks(p.chunks).select("tenant", "table_name", "start_pk", "end_pk", "is_first")


@query("set1_chunks_of_all_tables", " union all ".join(f"select tenant, table_name, start_pk, end_pk from {w.chunks_sql([n], SIZE)}" for n in w.CHUNKED))
def _(spark, sf):
    per_table = [explode_chunks(_widths(spark, sf, [n])[2]) for n in w.CHUNKED]
    return union_all(per_table).select("tenant", "table_name", "start_pk", "end_pk")


_HEAD = "'{\"customer_id\":\"' || tenant || '\",\"tenant_column\":\"account_id\",\"source_database\":\"src\",\"table\":\"' || table_name || '\"'"


@query("snk3_plan_documents", f"""
select tenant, table_name, 0::bigint as page_no, {_HEAD} || ',"pk_col":"id","min_pk":' || min_pk || ',"max_pk":' || max_pk
  || ',"total_rows":' || total_rows || ',"chunk_count":' || ((max_pk - min_pk) // step + 1) || ',"chunks":[' || list || ']}}' as plan
from {STATS} join (select tenant, table_name, string_agg('{{"start":' || start_pk || ',"end":' || end_pk || '}}', ',' order by start_pk) as list
  from {CHUNKS} group by 1, 2) using (tenant, table_name)
union all select tenant, table_name, 0, {_HEAD} || ',"reason":"' || reason || '"}}' from {SKIPS}""")
def _(spark, sf):
    _, _, p = _plan(spark, sf)
    path = scratch(spark, "plan")
    p.write(path)
    return planning.plan_json(planning.Plan.read(spark, path), w.DB, w.TENANT)


# -- names skipped and verified ---------------------------------------------------------------------

@query("set2_skipped_and_discovered", f"select distinct table_name from {UNCUT} where reason like '%PK%' intersect select table_name from {CARRYING}")
def _(spark, sf):
    frames, specs, p = _plan(spark, sf)
    discovered = tenant_tables(catalog_of(spark, specs.values()), w.DB, w.TENANT)
    return p.skipped.where(F.contains("reason", F.lit("PK"))).select("table_name").intersect(discovered)


@query("set3_discovered_minus_skipped", f"select table_name from {CARRYING} where table_name not in (select table_name from {SKIPS})")
def _(spark, sf):
    _, specs, p = _plan(spark, sf)
    discovered = tenant_tables(catalog_of(spark, specs.values()), w.DB, w.TENANT)
    return discovered.exceptAll(p.skipped.select("table_name").distinct())


@query("set4_skipped_names", f"select distinct table_name from {SKIPS}")
def _(spark, sf):
    _, _, p = _plan(spark, sf)
    return p.skipped.select("table_name").distinct()


@query("ord5_skipped_names_sorted", f"select tenant, string_agg(distinct table_name, ', ' order by table_name) as skipped from {SKIPS} group by tenant")
def _(spark, sf):
    _, _, p = _plan(spark, sf)
    # at most one name per table
    names = F.array_join(F.sort_array(F.collect_set("table_name")), ", ")
    return p.skipped.groupBy("tenant").agg(names.alias("skipped"))


@query("jn10_tables_to_verify", f"select tenant, table_name, total_rows from {STATS} where table_name not in (select table_name from {UNCUT})")
def _(spark, sf):
    _, _, p = _plan(spark, sf)
    gone = p.skipped.select("tenant", "table_name")
    return p.tables.select("tenant", "table_name", "total_rows").join(gone, ["tenant", "table_name"], "left_anti")


# -- ledger, bulk load, resume ----------------------------------------------------------------------

# chunks done so far: by parity of the chunk's number within its slice
DONE = f"(select * from {CHUNKS} join (select tenant, table_name, min_pk, step from {STATS}) using (tenant, table_name) where (start_pk - min_pk) // step % 2 = 0)"


def _half_done(p):
    return p.chunks.where("chunk_no % 2 = 0").withColumn("n_rows", F.lit(0).cast("bigint"))


@query("jn5_pending_chunks", f"select tenant, table_name, start_pk, end_pk from {CHUNKS} where (tenant, table_name, start_pk) not in (select (tenant, table_name, start_pk) from {DONE})")
def _(spark, sf):
    _, _, p = _plan(spark, sf)
    return led.pending(p.chunks, _half_done(p)).select("tenant", "table_name", "start_pk", "end_pk")


@query("jn6_completed_chunks", f"select table_name, count(*)::bigint as skipped_chunks from {DONE} group by 1")
def _(spark, sf):
    _, _, p = _plan(spark, sf)
    return led.completed(p.chunks, _half_done(p)).groupBy("table_name").agg(F.count("*").alias("skipped_chunks"))


@query("agg12_completed_counts", f"select tenant, table_name, count(*)::bigint as n_done from {DONE} group by 1, 2")
def _(spark, sf):
    _, _, p = _plan(spark, sf)
    path = scratch(spark, "ledger")
    led.record(_half_done(p), path)
    return led.completed_counts(led.read_ledger(spark, path))


@query("agg12_chunks_recorded_twice", f"select tenant, table_name, count(*)::bigint as n_done from {DONE} group by 1, 2")
def _(spark, sf):
    _, _, p = _plan(spark, sf)
    path = scratch(spark, "ledger")
    for _ in range(2):  # as two runs over the same chunks do
        led.record(_half_done(p), path)
    return led.completed_counts(led.read_ledger(spark, path))


@query("jn4_chunk_parity", f"""
with c as (select * from {w.chunks_sql(['activities'], SIZE)}),
s as (select tenant, start_pk, count(*)::bigint as n from c join {ACT} on account_id = tenant and id between start_pk and end_pk group by 1, 2),
t as (select tenant, start_pk, count(*)::bigint as n from c join {w.drifted_sql('activities', 'payload')} on account_id = tenant and id between start_pk and end_pk group by 1, 2)
select tenant, 'activities' as table_name, start_pk, coalesce(s.n, 0) as src_count, coalesce(t.n, 0) as tgt_count, s.n is not distinct from t.n as ok
from s full join t using (tenant, start_pk)""")
def _(spark, sf):
    frames, specs, widths = _widths(spark, sf, ["activities"])
    source, spec = frames["activities"], specs["activities"]
    return compare_chunks(
        chunk_counts(source, spec, widths), chunk_counts(w.drifted(source, "payload"), spec, widths)
    )


def _migrated(spark, sf, names, half_first=False):
    frames, specs = w.tables(spark, sf, names)
    p = plan(frames, specs.values(), w.DB, w.TENANT, chunk_size=SIZE)
    root = scratch(spark, "target")
    target = KeyedTarget(spark, root, specs, buckets=8)
    if half_first:
        migrate(planning.Plan(p.tables, p.chunks.where("chunk_no % 2 = 0"), p.skipped), frames, target, f"{root}/ledger")
    report = migrate(p, frames, target, f"{root}/ledger", ("bin.000001", 0))
    return target, report, f"{root}/ledger"


@query("snk4_ledger", f"select c.tenant, 'contacts' as table_name, start_pk, end_pk, count(id)::bigint as n_rows from {w.chunks_sql(['contacts'], SIZE)} c left join {w.table_sql('contacts')} on account_id = c.tenant and id between start_pk and end_pk group by 1, 3, 4")
def _(spark, sf):
    _, _, path = _migrated(spark, sf, ["contacts"])
    return led.read_ledger(spark, path)


@query("e2e2_migrate", f"select * from {LEADS} where account_id is not null")
def _(spark, sf):
    return _migrated(spark, sf, ["leads"])[0].table("leads")


@query("e2e3_resume", f"select * from {ACT} where account_id is not null")
def _(spark, sf):
    return _migrated(spark, sf, ["activities"], half_first=True)[0].table("activities")


@query("e2e3_resume_all_tables", " union all ".join(f"select '{n}' as table_name, count(*)::bigint as n_rows, sum(id)::bigint as id_sum from {w.table_sql(n)} where account_id is not null" for n in w.CHUNKED))
def _(spark, sf):
    target = _migrated(spark, sf, w.CHUNKED, half_first=True)[0]
    return union_all(
        target.table(n).agg(F.lit(n).alias("table_name"), F.count("*").alias("n_rows"), F.sum("id").cast("bigint").alias("id_sum")) for n in w.CHUNKED
    )


@query("key_uniqueness", "select l_orderkey as order_id, l_linenumber as line, count(*)::bigint as n from lineitem group by 1, 2 having count(*) > 1")
def _(spark, sf):
    df = w.table(spark, sf, "order_lines")
    return duplicate_keys(df, TableSpec.of(df, "order_lines", ["order_id", "line"]))


# -- fixture rows -----------------------------------------------------------------------------------

# as many leads and activities per tenant as it has events
FIRST = "cast(substr(account_id, 5) as bigint) * 1000000000000 + 1"
COUNTS = f"(select account_id, {FIRST} as first_id, count(*)::bigint as n from {ACT} group by account_id)"
NUMBERED = f"(select *, unnest(range(n)) as seq from {COUNTS})"


def _counts(spark, sf):
    df = w.table(spark, sf, "activities")
    return df.groupBy("account_id").agg(F.count("*").alias("n")).withColumn("first_id", F.expr(FIRST))


@query("src7_fixture_leads", f"select first_id + seq as id, account_id, 'lead_' || (seq + 1) || '@' || replace(account_id, '_', '') || '.example' as email, timestamp '2022-01-01' + to_minutes(seq * 10) as created_at from {NUMBERED}")
def _(spark, sf):
    return synth.leads(_counts(spark, sf))


@query("src7_fixture_activities", f"select first_id + seq as id, account_id, first_id + seq as lead_id, list_extract(['email_open','email_click','form_fill','web_visit'], (seq % 4 + 1)::bigint) as activity_type, '{{\"campaign\":\"camp_' || (seq % 20) || '\",\"score\":' || (seq % 100) || '}}' as payload, timestamp '2022-01-01' + to_minutes(seq * 11) as created_at from {NUMBERED}")
def _(spark, sf):
    return synth.activities(_counts(spark, sf))
