"""Catalog scans, discovery and key checks, each with the row counts of the tables concerned."""

from pyspark.sql import functions as F

from tenantferry.sources import catalog as cat
from workload import tables as w
from workload.registry import query

CAT = w.catalog_values()
SIZES = w.sizes_sql()
CARRYING = f"(select table_name from {CAT} where table_type = 'BASE TABLE' and column_name = 'account_id')"
KEYS = (
    f"(select table_name, count(*)::bigint as n_pk, min_by(column_name, key_position) as pk_col, "
    f"min_by(data_type, key_position) as pk_type, string_agg(column_name, ', ' order by key_position) as pk_names "
    f"from {CAT} where key_position is not null group by table_name)"
)
REASON = (
    "case when coalesce(n_pk, 0) = 0 then 'no primary key' when n_pk > 1 then 'composite PK (' || pk_names || ')' "
    "when lower(pk_type) not in ('tinyint','smallint','mediumint','int','bigint') then 'non-integer PK type=' || pk_type end"
)


def _setup(spark, sf):
    frames, specs = w.tables(spark, sf)
    return frames, cat.catalog_of(spark, specs.values()), w.sizes(frames)


@query("src3_catalog_scan", f"select table_name, column_name, data_type, ordinal_position, n_rows from {CAT} join {SIZES} using (table_name)")
def _(spark, sf):
    _, c, sizes = _setup(spark, sf)
    return c.columns.drop("table_schema").join(sizes, "table_name")


@query("jn1_tables_with_tenant_column", f"select table_name, n_rows from {CARRYING} join {SIZES} using (table_name) order by 1")
def _(spark, sf):
    _, c, sizes = _setup(spark, sf)
    return cat.tenant_tables(c, w.DB, w.TENANT).join(sizes, "table_name").orderBy("table_name")


@query("jn2_primary_key_types", f"select table_name, n_pk, pk_col, pk_type, n_rows from {KEYS} join {SIZES} using (table_name)")
def _(spark, sf):
    _, c, sizes = _setup(spark, sf)
    return cat.primary_keys(c, w.DB).drop("pk_names").join(sizes, "table_name")


@query("fil4_include_exclude", f"select table_name, n_rows from {CARRYING} join {SIZES} using (table_name) where table_name in ('leads','activities','contacts') and table_name not in ('activities')")
def _(spark, sf):
    _, c, sizes = _setup(spark, sf)
    found = cat.tenant_tables(c, w.DB, w.TENANT, ["leads", "activities", "contacts"], ["activities"])
    return found.join(sizes, "table_name")


@query("fil5_base_tables", f"select distinct table_name, n_rows from {CAT} join {SIZES} using (table_name) where table_type = 'BASE TABLE'")
def _(spark, sf):
    _, c, sizes = _setup(spark, sf)
    return c.tables.where(F.col("table_type") == "BASE TABLE").select("table_name").join(sizes, "table_name")


@query("fil6_integer_keys", f"select table_name, pk_col, n_rows from {KEYS} join {SIZES} using (table_name) where n_pk = 1 and pk_type in ('int','bigint')")
def _(spark, sf):
    _, c, sizes = _setup(spark, sf)
    whole = F.lower("pk_type").isin(*cat.INTEGER_TYPES)
    return cat.primary_keys(c, w.DB).where((F.col("n_pk") == 1) & whole).select("table_name", "pk_col").join(sizes, "table_name")


@query("prj8_key_check", f"select table_name, case when r is null then pk_col end as pk_col, r is null as chunkable, r as reason, n_rows from (select table_name, pk_col, {REASON} as r from {CARRYING} left join {KEYS} using (table_name)) join {SIZES} using (table_name)")
def _(spark, sf):
    _, c, sizes = _setup(spark, sf)
    return cat.key_check(cat.tenant_tables(c, w.DB, w.TENANT), cat.primary_keys(c, w.DB)).join(sizes, "table_name")


@query("agg6_key_width", f"select table_name, coalesce(n_pk, 0)::bigint as n_pk, n_rows from {CARRYING} left join {KEYS} using (table_name) join {SIZES} using (table_name)")
def _(spark, sf):
    _, c, sizes = _setup(spark, sf)
    widths = cat.tenant_tables(c, w.DB, w.TENANT).join(cat.primary_keys(c, w.DB), "table_name", "left")
    return widths.select("table_name", F.coalesce("n_pk", F.lit(0)).alias("n_pk")).join(sizes, "table_name")


@query("agg7_composite_key_names", f"select table_name, pk_names, n_rows from {KEYS} join {SIZES} using (table_name) where n_pk > 1")
def _(spark, sf):
    _, c, sizes = _setup(spark, sf)
    return cat.primary_keys(c, w.DB).where("n_pk > 1").select("table_name", "pk_names").join(sizes, "table_name")


@query("agg13_table_sizes", f"select table_name, n_rows as table_rows from {SIZES} order by 1")
def _(spark, sf):
    from tenantferry.operators.stats import table_sizes
    return table_sizes(w.tables(spark, sf)[0]).orderBy("table_name")


@query("ord1_tables_by_name", f"select table_name, n_rows from {CARRYING} join {SIZES} using (table_name) order by table_name")
def _(spark, sf):
    _, c, sizes = _setup(spark, sf)
    return cat.tenant_tables(c, w.DB, w.TENANT).join(sizes, "table_name").orderBy("table_name")


@query("ord2_columns_by_position", f"select table_name, ordinal_position, column_name, n_rows from {CAT} join {SIZES} using (table_name) order by 1, 2")
def _(spark, sf):
    _, c, sizes = _setup(spark, sf)
    return (
        c.columns.select("table_name", "ordinal_position", "column_name")
        .join(sizes, "table_name").orderBy("table_name", "ordinal_position")
    )


@query("ord3_first_key_column", f"select table_name, pk_col, n_rows from {KEYS} join {SIZES} using (table_name)")
def _(spark, sf):
    _, c, sizes = _setup(spark, sf)
    return cat.primary_keys(c, w.DB).select("table_name", "pk_col").join(sizes, "table_name")
