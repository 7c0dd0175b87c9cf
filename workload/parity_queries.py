"""Encoding, checksums, two-sided reports and isolation."""

from pyspark.sql import functions as F

from tenantferry import isolation_report, verdict, verify
from tenantferry.functions.checksum import xor_of_crc32
from tenantferry.functions.encode import row_text
from tenantferry.operators import parity
from tenantferry.operators.stats import union_all
from tenantferry.session import scratch
from tenantferry.specs import TableSpec
from workload import tables as w
from workload.registry import query

NAMES = list(w.DRIFT)
ACT = w.table_sql("activities")


def _sides(spark, sf):
    frames, specs = w.tables(spark, sf, NAMES)
    return frames, {n: w.drifted(df, w.DRIFT[n]) for n, df in frames.items()}, specs


def _side_sql(drifted: bool) -> str:
    relations = [(n, w.drifted_sql(n, w.DRIFT[n]) if drifted else w.table_sql(n)) for n in NAMES]
    return "(" + " union all ".join(f"select * from {w.metrics_sql(n, r)}" for n, r in relations) + ")"


REPORT = f"""with {w.CRC_TABLE}, r as (
select tenant, table_name, coalesce(s.n, 0) as src_count, coalesce(t.n, 0) as tgt_count,
  coalesce(s.n, 0) = coalesce(t.n, 0) as count_ok, coalesce(s.checksum, 0) as src_checksum,
  coalesce(t.checksum, 0) as tgt_checksum, coalesce(s.checksum, 0) = coalesce(t.checksum, 0) as checksum_ok
from {_side_sql(False)} s full join {_side_sql(True)} t using (tenant, table_name)),
report as (select *, count_ok and checksum_ok as ok from r) """


# -- checksums ----------------------------------------------------------------------------------------

@query("agg4_slice_checksum", f"with {w.CRC_TABLE} select * from {w.metrics_sql('leads', w.table_sql('leads'))}")
def _(spark, sf):
    df = w.table(spark, sf, "leads")
    return parity.slice_metrics(df, w.spec(df, "leads"))


@query("agg4_unicode_checksum", f"with {w.CRC_TABLE} select * from {w.metrics_sql('articles', w.table_sql('articles'))}")
def _(spark, sf):
    df = w.table(spark, sf, "articles")
    return parity.slice_metrics(df, w.spec(df, "articles"))


@query("agg4_strong_checksum", "select tenant, table_name, s.h is not distinct from t.h as ok from "
       + "(" + " union all ".join(f"select account_id as tenant, '{n}' as table_name, list_sort(list({w.row_text_sql(n)})) as h from {w.table_sql(n)} group by 1" for n in NAMES) + ") s full join ("
       + " union all ".join(f"select account_id as tenant, '{n}' as table_name, list_sort(list({w.row_text_sql(n)})) as h from {w.drifted_sql(n, w.DRIFT[n])} group by 1" for n in NAMES)
       + ") t using (tenant, table_name)")
def _(spark, sf):
    source, target, specs = _sides(spark, sf)
    report = verify(source, target, specs.values(), mode="strong")
    return report.select("tenant", "table_name", "ok")


@query("prj2_row_text", f"select id, {w.row_text_sql('activities')} as txt from {ACT}")
def _(spark, sf):
    df = w.table(spark, sf, "activities")
    return df.select("id", row_text(w.spec(df, "activities")).alias("txt"))


@query("prj6_binary_as_hex", "select doc_id, hex(encode(text)) as txt from documents")
def _(spark, sf):
    docs = w.given(spark, sf, "documents").select("doc_id", F.encode("text", "UTF-8").alias("body"))
    spec = TableSpec.of(docs.select("body"), "documents")
    return docs.select("doc_id", row_text(spec).alias("txt"))


@query("fn1_crc32", f"with {w.CRC_TABLE} select doc_id, {w.crc_sql('text')}::bigint as crc from documents, crc_table")
def _(spark, sf):
    return w.given(spark, sf, "documents").select("doc_id", F.crc32(F.encode("text", "UTF-8")).alias("crc"))


@query("fn2_concat_ws_skips_null", f"select id, concat_ws('|', activity_type, payload, account_id) as txt from {ACT}")
def _(spark, sf):
    df = w.table(spark, sf, "activities")
    return df.select("id", F.concat_ws("|", "activity_type", "payload", "account_id").alias("txt"))


@query("fn3_null_as_text", f"select coalesce(payload, 'NULL') as payload, count(*)::bigint as n from {ACT} group by 1")
def _(spark, sf):
    df = w.table(spark, sf, "activities")
    return df.groupBy(F.coalesce("payload", F.lit("NULL")).alias("payload")).agg(F.count("*").alias("n"))


@query("fn4_value_texts", "select o_orderkey, o_orderkey::varchar as int_text, o_totalprice::decimal(38,2)::varchar as decimal_text, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as datetime_text, (o_totalprice > 200000)::int::varchar as flag_text from orders")
def _(spark, sf):
    from tenantferry.functions.encode import column_text
    orders = w.given(spark, sf, "orders").withColumn("big", F.col("o_totalprice") > 200000)
    spec = TableSpec.of(orders, "orders", ["o_orderkey"], scales={"o_totalprice": 2}, datetime_digits=0)
    names = {"o_orderkey": "int_text", "o_totalprice": "decimal_text", "o_orderdate": "datetime_text", "big": "flag_text"}
    return orders.select("o_orderkey", *[column_text(spec, c).alias(a) for c, a in names.items()])


@query("fn5_checksum_is_unsigned", f"with {w.CRC_TABLE} select lang, min({w.crc_sql('source')})::bigint as lowest, bit_xor({w.crc_sql('source')})::bigint as folded from documents, crc_table group by lang")
def _(spark, sf):
    docs = w.given(spark, sf, "documents")
    return docs.groupBy("lang").agg(
        F.min(F.crc32(F.encode("source", "UTF-8"))).alias("lowest"), xor_of_crc32(F.col("source")).alias("folded")
    )


# the same documents as two servers write them: another order of keys, other spacing
DOCUMENT = "(select event_id as id, 'acc_' || (user_id % 5) as account_id, '{\"a\":\"' || event_type || '\",\"k\":' || event_id % 100 || '}' as doc from events)"


@query("prj2_canonical_json", f"with {w.CRC_TABLE} select account_id as tenant, count(*)::bigint as src_count, bit_xor({w.crc_sql('txt')})::bigint as src_checksum, bit_xor({w.crc_sql('txt')})::bigint as tgt_checksum, true as ok from (select account_id, concat_ws('|', id, account_id, doc) as txt from {DOCUMENT}), crc_table group by 1")
def _(spark, sf):
    events = w.given(spark, sf, "events")
    names = F.col("event_id").alias("id"), F.concat(F.lit("acc_"), (F.col("user_id") % 5).cast("string")).alias("account_id")
    kind, k = F.col("event_type"), (F.col("event_id") % 100).cast("string")
    source = events.select(*names, F.format_string('{"k": %s, "a": "%s"}', k, kind).alias("doc"))
    target = events.select(*names, F.format_string('{"a":"%s",  "k":%s}', kind, k).alias("doc"))
    spec = TableSpec.of(source, "documents", ["id"], json=("doc",))
    return verify({"documents": source}, {"documents": target}, [spec]).select("tenant", "src_count", "src_checksum", "tgt_checksum", "ok")


# -- reports ------------------------------------------------------------------------------------------

@query("jn3_side_by_side", REPORT + "select tenant, table_name, src_count, tgt_count, src_checksum, tgt_checksum from report")
def _(spark, sf):
    source, target, specs = _sides(spark, sf)
    specs = list(specs.values())
    both = parity.compare_metrics(parity.all_metrics(source, specs), parity.all_metrics(target, specs))
    return both.select("tenant", "table_name", "src_count", "tgt_count", "src_checksum", "tgt_checksum")


@query("prj7_verdict_columns", REPORT + "select tenant, table_name, count_ok, checksum_ok, ok from report")
def _(spark, sf):
    source, target, specs = _sides(spark, sf)
    return verify(source, target, specs.values()).select("tenant", "table_name", "count_ok", "checksum_ok", "ok")


@query("agg5_verdict", REPORT + "select tenant, bool_and(ok) as ok from report group by tenant")
def _(spark, sf):
    source, target, specs = _sides(spark, sf)
    return verdict(verify(source, target, specs.values()), ["tenant"])


@query("e2e5_verify", REPORT + "select * from report")
def _(spark, sf):
    source, target, specs = _sides(spark, sf)
    return verify(source, target, specs.values())


@query("e2e5_verify_listed_tenants", REPORT + "select tenant, table_name, coalesce(src_count, 0) as src_count, coalesce(tgt_count, 0) as tgt_count, coalesce(ok, true) as ok from (select unnest(['acc_0', 'acc_3', 'acc_9']) as tenant) left join (select 'leads' as table_name) on true left join report using (tenant, table_name)")
def _(spark, sf):
    source, target, specs = _sides(spark, sf)
    report = verify(source, target, specs.values(), ["acc_0", "acc_3", "acc_9"], skipped=["activities"])
    return report.select("tenant", "table_name", "src_count", "tgt_count", "ok")


@query("snk6_parity_report_json", REPORT + """select '{"tenant":"' || tenant || '","table_name":"' || table_name || '","src_count":' || src_count || ',"tgt_count":' || tgt_count
 || ',"count_ok":' || count_ok || ',"src_checksum":' || src_checksum || ',"tgt_checksum":' || tgt_checksum || ',"checksum_ok":' || checksum_ok || ',"ok":' || ok || '}' as value from report""")
def _(spark, sf):
    source, target, specs = _sides(spark, sf)
    path = scratch(spark, "report")
    verify(source, target, specs.values()).write.json(path)
    return spark.read.text(path)


@query("fil10_null_safe_mismatch", f"select id, s.payload as src, t.payload as tgt from {ACT} s join {w.drifted_sql('activities', 'payload')} t using (id) where s.payload is distinct from t.payload")
def _(spark, sf):
    source, target, _ = _sides(spark, sf)
    s = source["activities"].select("id", F.col("payload").alias("src"))
    t = target["activities"].select("id", F.col("payload").alias("tgt"))
    return s.join(t, "id").where(~F.col("src").eqNullSafe(F.col("tgt")))


# -- isolation ----------------------------------------------------------------------------------------

# the target of acc_2 got its own rows and, wrongly, acc_1's added ones
def _leaky(df):
    return df.where("account_id = 'acc_2'").unionByName(df.where(w.ADDED))


def _leak_sql(name):
    return f"(select * from {w.table_sql(name)} where account_id = 'acc_2' or {w.ADDED})"


FOREIGN = " union all ".join(
    f"select '{n}' as table_name, account_id as tenant, count(*)::bigint as n from {_leak_sql(n)} "
    f"where account_id is distinct from 'acc_2' group by 2" for n in ("leads", "activities", "contacts")
)


@query("agg11_foreign_rows", FOREIGN)
def _(spark, sf):
    frames, specs = w.tables(spark, sf, ["leads", "activities", "contacts"])
    return union_all(parity.foreign_rows(_leaky(frames[n]), specs[n], "acc_2") for n in frames)


@query("e2e6_isolation", f"select table_name, sum(n)::bigint as foreign_rows from ({FOREIGN}) group by 1")
def _(spark, sf):
    frames, specs = w.tables(spark, sf, ["leads", "activities", "contacts"])
    report = isolation_report({n: _leaky(df) for n, df in frames.items()}, specs.values(), "acc_2")
    return report.groupBy("table_name").agg(F.sum("n").alias("foreign_rows"))
