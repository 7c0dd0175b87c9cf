"""A multi-tenant database out of the given tables, in Spark and in SQL.

Five tenants ``acc_0`` to ``acc_4`` own rows in every table that carries ``account_id``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenantferry.specs import TableSpec

DB = "src"
TENANT = "account_id"
NAMES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# name, given table, key, columns as (name, expression in Spark SQL and in DuckDB)
ACCOUNT = "concat('acc_', {} % 5)"
_TABLES: dict[str, tuple[str, tuple[str, ...], dict[str, str], dict]] = {
    "activities": ("events", ("id",), {
        "id": "event_id", "account_id": ACCOUNT.format("user_id"), "lead_id": "user_id",
        "activity_type": "event_type", "score": "cast(value as decimal(18,2))",
        "payload": "nullif(props, '{\"k\": 69}')", "created_at": "ts",
    }, {}),
    "leads": ("orders", ("id",), {
        "id": "o_orderkey", "account_id": ACCOUNT.format("o_custkey"), "status": "nullif(o_orderstatus, 'P')",
        "total": "o_totalprice", "priority": "o_orderpriority", "created_at": "o_orderdate",
    }, {"scales": {"total": 2}, "datetime_digits": 0}),
    # no contact belongs to acc_4
    "contacts": ("customer", ("id",), {
        "id": "c_custkey", "account_id": "concat('acc_', c_custkey % 4)", "name": "c_name",
        "nation": "c_nationkey", "segment": "c_mktsegment",
    }, {}),
    "articles": ("documents", ("id",), {
        "id": "doc_id", "account_id": ACCOUNT.format("doc_id"), "text": "text", "lang": "lang",
    }, {}),
    "ratings": ("labels", ("id",), {
        "id": "doc_id", "account_id": ACCOUNT.format("doc_id"), "quality": "quality", "toxic": "toxic",
    }, {}),
    "email_preferences": ("conversations", ("account_id", "conv_id", "turn"), {
        "account_id": ACCOUNT.format("conv_id"), "conv_id": "conv_id", "turn": "turn", "value": "role",
    }, {}),
    "vendors": ("supplier", ("name",), {
        "name": "s_name", "account_id": ACCOUNT.format("s_suppkey"), "nation": "s_nationkey",
    }, {}),
    "order_lines": ("lineitem", (), {
        "order_id": "l_orderkey", "line": "l_linenumber", "account_id": ACCOUNT.format("l_suppkey"),
    }, {}),
    "part_view": ("part", ("id",), {
        "id": "p_partkey", "account_id": ACCOUNT.format("p_partkey"), "brand": "p_brand",
    }, {"table_type": "VIEW"}),
    "nations": ("nation", ("id",), {"id": "n_nationkey", "name": "n_name"}, {}),
}
CHUNKED = ["activities", "leads", "contacts", "articles", "ratings"]


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    base, _, columns, _ = _TABLES[name]
    return given(spark, sf_dir, base).select(*[F.expr(e).alias(c) for c, e in columns.items()])


def table_sql(name: str) -> str:
    base, _, columns, _ = _TABLES[name]
    return "(select " + ", ".join(f"{e} as {c}" for c, e in columns.items()) + f" from {base})"


def spec(df: DataFrame, name: str) -> TableSpec:
    _, pk, _, options = _TABLES[name]
    return TableSpec.of(df, name, pk, tenant_col=TENANT, database=DB, **options)


def tables(spark: SparkSession, sf_dir: str, names=None) -> tuple[dict[str, DataFrame], dict[str, TableSpec]]:
    frames = {n: table(spark, sf_dir, n) for n in (names or _TABLES)}
    return frames, {n: spec(df, n) for n, df in frames.items()}


def catalog_values() -> str:
    """The catalog as a SQL relation: table, type, column, its type, position, place in the key."""
    kinds = {
        "account_id": "varchar", "activity_type": "varchar", "payload": "varchar", "created_at": "timestamp_ntz",
        "score": "decimal(18,2)", "status": "varchar", "priority": "varchar", "total": "double", "name": "varchar",
        "nation": "int", "segment": "varchar", "text": "varchar", "lang": "varchar", "quality": "int", "toxic": "int",
        "value": "varchar", "line": "int", "brand": "varchar",
    }
    rows = []
    for name, (_, pk, columns, options) in _TABLES.items():
        for i, c in enumerate(columns, 1):
            kind = "int" if (name, c) == ("nations", "id") else kinds.get(c, "bigint")
            place = pk.index(c) + 1 if c in pk else "NULL"
            rows.append(f"('{name}','{options.get('table_type', 'BASE TABLE')}','{c}','{kind}',{i},{place})")
    return "(values " + ",".join(rows) + ") as cat(table_name, table_type, column_name, data_type, ordinal_position, key_position)"


def sizes_sql(names=None) -> str:
    """Row count of each table."""
    return "(" + " union all ".join(
        f"select '{n}' as table_name, count(*)::bigint as n_rows from {_TABLES[n][0]}" for n in (names or _TABLES)
    ) + ")"


def sizes(frames: dict[str, DataFrame]) -> DataFrame:
    from tenantferry.operators.stats import table_sizes
    return table_sizes(frames).withColumnRenamed("table_rows", "n_rows")


# -- a target that differs from its source in known places ----------------------------------------

# rows of acc_0 and acc_1 are lost, changed and added; the other tenants' are left alone
TOUCHED = "account_id in ('acc_0', 'acc_1')"
LOST = f"({TOUCHED} and id % 97 = 0)"
CHANGED = f"({TOUCHED} and id % 89 = 0)"
ADDED = "(account_id = 'acc_1' and id % 101 = 0)"
SHIFT = 10**9


def drifted(df: DataFrame, changed: str) -> DataFrame:
    """``changed`` is the column that differs in changed rows: it becomes NULL."""
    there = df.where(f"not {LOST}").withColumn(changed, F.when(~F.expr(CHANGED), F.col(changed)))
    added = df.where(ADDED).withColumn("id", F.col("id") + SHIFT)
    return there.unionByName(added)


def drifted_sql(name: str, changed: str) -> str:
    columns = _TABLES[name][2]
    there = ", ".join(f"case when not {CHANGED} then {c} end as {c}" if c == changed else c for c in columns)
    added = ", ".join(f"id + {SHIFT} as id" if c == "id" else c for c in columns)
    src = table_sql(name)
    return f"(select {there} from {src} where not {LOST} union all select {added} from {src} where {ADDED})"


DRIFT = {"activities": "payload", "leads": "priority"}


# -- text and checksum in SQL ---------------------------------------------------------------------

def _sql_text(name: str, column: str) -> str:
    if column == "created_at":
        digits = _TABLES[name][3].get("datetime_digits", 6)
        return f"strftime(created_at, '%Y-%m-%d %H:%M:%S{'.%f' if digits else ''}')"
    if column in _TABLES[name][3].get("scales", {}):
        return f"cast(cast({column} as decimal(18,2)) as varchar)"
    return f"cast({column} as varchar)"


def row_text_sql(name: str) -> str:
    parts = [f"coalesce({_sql_text(name, c)}, 'NULL')" for c in _TABLES[name][2]]
    return "concat_ws('|', " + ", ".join(parts) + ")"


# fixed value: the reversed CRC-32 polynomial
POLYNOMIAL = 3988292384
CRC_TABLE = (
    "crc_table as (select list_transform(range(256), lambda i: list_reduce(list_prepend(i::ubigint, "
    "list_transform(range(8), lambda k: k::ubigint)), lambda c, k: case when (c & 1) = 1 "
    f"then xor(c >> 1, {POLYNOMIAL}::ubigint) else c >> 1 end)) as t)"
)


def crc_sql(text: str) -> str:
    """CRC-32 of a text, where ``crc_table`` is in scope."""
    octets = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: ('0x' || x)::ubigint)"
    folded = (
        f"list_reduce(list_prepend(4294967295::ubigint, {octets}), "
        "lambda c, b: xor(c >> 8, t[(xor(c, b) & 255)::bigint + 1]))"
    )
    return f"xor({folded}, 4294967295::ubigint)"


def metrics_sql(name: str, relation: str) -> str:
    """Count and checksum per tenant; needs ``crc_table``."""
    return (
        f"(select account_id as tenant, '{name}' as table_name, count(*)::bigint as n, "
        f"bit_xor({crc_sql('txt')})::bigint as checksum "
        f"from (select account_id, {row_text_sql(name)} as txt from {relation}), crc_table group by account_id)"
    )


# -- plan in SQL -----------------------------------------------------------------------------------

def stats_sql(names, size: int) -> str:
    """Slice statistics with chunk widths."""
    per_table = " union all ".join(
        f"select '{n}' as table_name, account_id as tenant, min(id)::bigint as min_pk, max(id)::bigint as max_pk, "
        f"count(*)::bigint as total_rows from {table_sql(n)} group by account_id" for n in names
    )
    step = f"greatest(1, ceil({size}::double / (total_rows::double / (max_pk - min_pk + 1)::double)))::bigint"
    return f"(select *, {step} as step from ({per_table}))"


def chunks_sql(names, size: int) -> str:
    return (
        "(select tenant, table_name, start_pk, least(start_pk + step - 1, max_pk) as end_pk from "
        f"(select *, unnest(range(min_pk, max_pk + 1, step)) as start_pk from {stats_sql(names, size)}))"
    )


# -- change feed -----------------------------------------------------------------------------------

# row images of the feed; a key lives through many events and moves between tenants
FEED_ROW = {
    "id": "user_id * 10 + event_id % 7", "account_id": "concat('acc_', event_id % 5)",
    "score": "cast(value as decimal(18,2))", "kind": "event_type", "payload": "nullif(props, '{\"k\": 69}')",
}
# some updates change the key, some the tenant
FEED_BEFORE = FEED_ROW | {
    "id": "user_id * 10 + event_id % 7 + case when event_id % 17 = 0 then 1 else 0 end",
    "account_id": "concat('acc_', (event_id + case when event_id % 19 = 0 then 1 else 0 end) % 5)",
}
FEED_HEAD = {
    "op": "case when event_id % 97 = 0 then 'Q' when event_id % 11 = 0 then 'D' when event_id % 3 = 0 then 'U' else 'I' end",
    "schema_name": "case when event_id % 13 = 0 then 'other' else 'src' end",
    "table_name": "case when event_type = 'error' then 'leads' else 'activities' end",
}
# several rows share the position of one event
FILE_NO, LOG_POS, ROW_IDX = "2000", "(event_id % 2000)", "3"
COLUMNS = list(FEED_ROW)


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = given(spark, sf_dir, "events")
    deleted = "event_id % 11 = 0 and event_id % 97 <> 0"

    def image(columns: dict[str, str]) -> Column:
        return F.struct(*[F.expr(e).alias(c) for c, e in columns.items()])

    before = F.when(F.expr(deleted), image(FEED_ROW)).otherwise(image(FEED_BEFORE))
    pos = F.struct(
        F.format_string("bin.%06d", F.expr(f"event_id div {FILE_NO} + 1")).alias("log_file"),
        F.expr(f"{LOG_POS} div {ROW_IDX}").alias("log_pos"),
        F.expr(f"cast({LOG_POS} % {ROW_IDX} as int)").alias("row_idx"),
    )
    return events.select(
        *[F.expr(e).alias(c) for c, e in FEED_HEAD.items()], pos.alias("pos"),
        before.alias("before"), image(FEED_ROW).alias("after"),
    )


def feed_sql() -> str:
    """The feed, flat: row images as columns, those before the change as ``b_*``."""
    head = ", ".join(f"{e} as {c}" for c, e in FEED_HEAD.items())
    row = ", ".join(f"{e} as {c}" for c, e in FEED_ROW.items())
    old = ", ".join(f"{e} as b_{c}" for c, e in FEED_BEFORE.items())
    pos = (
        f"printf('bin.%06d', event_id // {FILE_NO} + 1) as log_file, {LOG_POS} // {ROW_IDX} as log_pos, "
        f"({LOG_POS} % {ROW_IDX})::int as row_idx"
    )
    return f"(select event_id as seq, {head}, {pos}, {row}, {old} from events)"


def changes_sql(where: str = "true") -> str:
    """Row events of the replicated database."""
    return f"(select * from {feed_sql()} where op in ('I','U','D') and schema_name = 'src' and {where})"


def latest_sql(where: str = "true", keys: str = "table_name, id") -> str:
    return (
        f"(select * from {changes_sql(where)} "
        f"qualify row_number() over (partition by {keys} order by log_file desc, log_pos desc, row_idx desc) = 1)"
    )


def feed_specs(spark: SparkSession, sf_dir: str) -> dict[str, TableSpec]:
    row = feed(spark, sf_dir).schema["after"].dataType
    return {n: TableSpec(n, row, ("id",), TENANT, DB) for n in ("activities", "leads")}


def snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows the target held before the feed: one per key, a few keys the feed never names."""
    events = given(spark, sf_dir, "events")
    return events.groupBy(F.expr("user_id * 10 + event_id % 9").alias("id")).agg(
        F.expr("concat('acc_', min(event_id) % 5)").alias("account_id"),
        F.expr("cast(max(value) as decimal(18,2))").alias("score"),
        F.expr("min(event_type)").alias("kind"), F.expr("max(props)").alias("payload"),
    )


SNAPSHOT_SQL = (
    "(select user_id * 10 + event_id % 9 as id, concat('acc_', min(event_id) % 5) as account_id, "
    "cast(max(value) as decimal(18,2)) as score, min(event_type) as kind, max(props) as payload "
    "from events group by 1)"
)
