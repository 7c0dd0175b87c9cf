import pytest
from pyspark.sql import DataFrameReader
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenantferry.plans.planning import Plan, ordered_chunks, plan, plan_json, plan_totals
from tenantferry.session import metadata_rows, scratch
from tenantferry.sources import catalog as cat
from tenantferry.sources import synth
from tenantferry.sources.slices import chunk_predicate, is_tenant, jdbc_chunks, jdbc_waves
from tenantferry.specs import TableSpec


def schema(**types):
    kinds = {"long": T.LongType(), "string": T.StringType()}
    return T.StructType([T.StructField(n, kinds[t]) for n, t in types.items()])


SPECS = {
    s.name: s for s in [
        TableSpec("leads", synth.LEADS, ("id",)),
        TableSpec("activities", synth.ACTIVITIES, ("id",)),
        TableSpec("email_preferences", synth.PREFERENCES, ("account_id", "email", "preference_type")),
        TableSpec("named", schema(name="string", account_id="string"), ("name",)),
        TableSpec("keyless", schema(x="long", account_id="string")),
        TableSpec("report", schema(id="long", account_id="string"), ("id",), table_type="VIEW"),
        TableSpec("country", schema(id="long"), ("id",)),
        TableSpec("elsewhere", schema(id="long", account_id="string"), ("id",), database="other"),
    ]
}


def found(spark, *lists):
    df = cat.tenant_tables(cat.catalog_of(spark, SPECS.values()), "src", "account_id", *lists)
    return sorted(r.table_name for r in df.collect())


def test_discovery(spark):
    assert found(spark) == ["activities", "email_preferences", "keyless", "leads", "named"]


def test_include_then_exclude(spark):
    assert found(spark, ["leads"]) == ["leads"]
    assert "leads" in found(spark, [], ["activities"]) and "activities" not in found(spark, [], ["activities"])
    assert found(spark, ["leads", "activities"], ["leads"]) == ["activities"]


def test_key_check(spark):
    c = cat.catalog_of(spark, SPECS.values())
    got = cat.key_check(cat.tenant_tables(c, "src", "account_id"), cat.primary_keys(c, "src"))
    rows = {r.table_name: (r.pk_col, r.chunkable, r.reason) for r in got.collect()}
    assert rows == {
        "leads": ("id", True, None), "activities": ("id", True, None),
        "email_preferences": (None, False, "composite PK (account_id, email, preference_type)"),
        "named": (None, False, "non-integer PK type=varchar"), "keyless": (None, False, "no primary key"),
    }


def test_catalog_of_the_session(spark):
    spark.range(3).withColumn("account_id", F.lit("a")).createOrReplaceTempView("visible")
    c = cat.catalog_of_session(spark, "default", {"visible": ["id"]})
    assert c.columns.where("table_name = 'visible'").orderBy("ordinal_position").collect()[1].column_name == "account_id"
    assert c.tables.where("table_name = 'visible'").count() == 1
    assert cat.primary_keys(c, "default").first().pk_type == "bigint"


def test_catalog_of_a_database(spark, monkeypatch):
    want = cat.catalog_of(spark, SPECS.values())
    relations = {
        "INFORMATION_SCHEMA.TABLES": want.tables, "INFORMATION_SCHEMA.COLUMNS": want.columns,
        "INFORMATION_SCHEMA.KEY_COLUMN_USAGE": want.keys.withColumn("constraint_name", F.lit("PRIMARY")).unionByName(
            metadata_rows(spark, [("src", "leads", "email", 1, "by_email")],
                          "table_schema string, table_name string, column_name string, ordinal_position int, constraint_name string")),
    }

    def jdbc(self, url, table, **kw):
        df = relations[table]
        return df.toDF(*[c.upper() for c in df.columns])

    monkeypatch.setattr(DataFrameReader, "jdbc", jdbc)
    got = cat.catalog_of_jdbc(spark, "jdbc:any:")
    for a, b in ((got.tables, want.tables), (got.columns, want.columns), (got.keys, want.keys)):
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_predicates_are_quoted():
    leads = SPECS["leads"]
    assert chunk_predicate(leads, "o'neill\\", 1, 5, "jdbc:any:") == "\"account_id\" = 'o''neill\\' AND \"id\" BETWEEN 1 AND 5"
    got = chunk_predicate(leads, "o'neill\\", 1, 5, "jdbc:mysql://db/src")
    assert got.startswith("`account_id` = 'o''neill\\\\' AND CAST(") and got.endswith("AND `id` BETWEEN 1 AND 5")
    odd = TableSpec("order", schema(**{"group": "long", "a`b": "string"}), ("group",), tenant_col="a`b")
    assert "`a``b` = 'x'" in chunk_predicate(odd, "x", 1, 5, "jdbc:mysql:") and "`group`" in chunk_predicate(odd, "x", 1, 5, "jdbc:mysql:")


def test_tenants_that_differ_in_case_are_read_apart():
    for tenant in ("Acc", "acc"):
        exact = chunk_predicate(SPECS["leads"], tenant, 1, 5, "jdbc:mariadb:").split(" AND ")[1]
        assert exact == f"CAST(CONVERT(`account_id` USING utf8mb4) AS BINARY) = CAST(CONVERT('{tenant}' USING utf8mb4) AS BINARY)"


def test_one_bounded_read_per_chunk(spark, monkeypatch):
    seen = {}

    def jdbc(self, url, table, predicates, properties):
        seen.update(table=table, predicates=predicates)
        return spark.range(1)

    monkeypatch.setattr(DataFrameReader, "jdbc", jdbc)
    jdbc_chunks(spark, "jdbc:any:", SPECS["leads"], [("a", 1, 5), ("a", 6, 9)])
    assert seen["table"] == '"leads"' and len(seen["predicates"]) == 2


def test_chunk_bounds_come_in_waves(spark):
    chunks = spark.range(25).select(F.lit("a").alias("tenant"), F.col("id").alias("start_pk"), F.col("id").alias("end_pk"))
    waves = list(jdbc_waves(chunks, 10))
    assert [len(x) for x in waves] == [10, 10, 5] and waves[0][0] == ("a", 0, 0)


def test_tenant_match_ignores_case_on_request(spark):
    df = metadata_rows(spark, [("acc_1",), ("ACC_1",)], "account_id string")
    assert df.where(is_tenant(F.col("account_id"), "acc_1")).count() == 1
    assert df.where(is_tenant(F.col("account_id"), "acc_1", "UNICODE_CI")).count() == 2


@pytest.fixture(scope="module")
def seeded(spark):
    counts = metadata_rows(spark, [("acc_12345", 1, 52000), ("acc_99999", 52001, 21000)], "account_id string, first_id bigint, n bigint")
    frames = {
        "leads": synth.leads(counts), "activities": synth.activities(counts),
        "email_preferences": spark.createDataFrame([], synth.PREFERENCES),
    }
    return frames, [SPECS[n] for n in frames]


@pytest.mark.parametrize("listed", [True, False])
def test_plan_of_one_tenant(spark, seeded, listed):
    frames, specs = seeded
    asked = ["acc_12345"] if listed else metadata_rows(spark, [("acc_12345",)], "tenant string")
    p = plan(frames, specs, "src", "account_id", asked)
    assert {(r.table_name, r.total_rows, r.chunk_count) for r in p.tables.collect()} == {("leads", 52000, 11), ("activities", 52000, 11)}
    assert [tuple(r) for r in p.skipped.collect()] == [("acc_12345", "email_preferences", "composite PK (account_id, email, preference_type)")]
    order = ordered_chunks(p.chunks).collect()
    assert (order[0].table_name, order[0].start_pk, order[0].is_first) == ("activities", 1, True)
    assert sum(r.is_first for r in order) == 1 and len(order) == 22
    totals = {r.table_name: (r.total_rows, r.chunks) for r in plan_totals(p).collect()}
    assert totals == {"leads": (52000, 11), "activities": (52000, 11), None: (104000, 22)}


def test_plan_of_a_tenant_without_rows(spark, seeded):
    frames, specs = seeded
    p = plan(frames, specs, "src", "account_id", metadata_rows(spark, [("nobody",)], "tenant string"))
    assert p.tables.isEmpty() and p.chunks.isEmpty()
    reasons = {r.table_name: r.reason for r in p.skipped.collect()}
    assert reasons["leads"] == "no rows for customer" and reasons["email_preferences"].startswith("composite PK")


def test_plan_of_all_tenants_says_what_each_is_left_out_of(spark, seeded):
    frames, specs = seeded
    frames = frames | {"leads": frames["leads"].where("account_id = 'acc_12345'")}
    composite = "composite PK (account_id, email, preference_type)"
    p = plan(frames, specs, "src", "account_id")
    want = {("acc_12345", "email_preferences", composite), ("acc_99999", "email_preferences", composite), ("acc_99999", "leads", "no rows for customer")}
    assert {tuple(r) for r in p.skipped.collect()} == want and p.skipped.count() == len(want)
    documents = plan_json(p, "src", "account_id").where("tenant = 'acc_99999' and table_name = 'leads'").collect()
    assert len(documents) == 1 and documents[0].plan.startswith('{"customer_id":"acc_99999",')
    # no tenant is known
    p = plan(frames, specs, "src", "account_id", include=["email_preferences"])
    assert [tuple(r) for r in p.skipped.collect()] == [(None, "email_preferences", composite)]


def test_plan_documents_are_paged(spark, seeded):
    frames, specs = seeded
    p = plan(frames, specs, "src", "account_id", include=["leads"])
    path = scratch(spark, "plan")
    p.write(path)
    documents = plan_json(Plan.read(spark, path), "src", "account_id", page=4)
    mine = documents.where("tenant = 'acc_12345' and table_name = 'leads'").orderBy("page_no").collect()
    assert [r.page_no for r in mine] == [0, 1, 2]
    assert '"chunks":[{"start":1,"end":5000}' in mine[0].plan


def test_fixture_rows(spark, seeded):
    frames, _ = seeded
    one = frames["activities"].where("id = 52001").first()
    assert (one.account_id, one.lead_id, one.activity_type, one.payload) == ("acc_99999", 52001, "email_open", '{"campaign":"camp_0","score":0}')
    lead = frames["leads"].where("id = 3").first()
    assert lead.email == "lead_3@acc12345.example" and str(lead.created_at) == "2022-01-01 00:20:00"
    assert frames["leads"].count() == 73000
