"""Tenants that differ in case only, from the plan to the cut-over."""

from dataclasses import replace

import pytest

from feeds import SPECS, event, frame
from tenantferry import KeyedTarget, TableSpec, isolation_report, migrate, plan, replicate, verify
from tenantferry.plans.planning import Plan
from tenantferry.sources.feed import file_feed, tenant_changes
from tenantferry.sources.slices import chunk_predicate, tenant_slice
from tenantferry.streaming.replicate import lag

ANY = {n: replace(s, any_case=True) for n, s in SPECS.items()}
ROWS = [(i, ("Acme", "ACME", "acme", "Zoo")[i % 4], "x") for i in range(400)]


def leads(spark):
    return spark.createDataFrame(ROWS, SPECS["leads"].schema)


@pytest.mark.parametrize("tenants", [None, ["aCME", "ZOO"], ["aCME"]])
def test_plan_load_resume_and_verify(spark, tmp_path, tenants):
    source, spec = {"leads": leads(spark)}, ANY["leads"]
    p = plan(source, [spec], "src", "account_id", tenants, 30)
    want = {"acme": 300, "zoo": 100} if tenants is None or len(tenants) > 1 else {"acme": 300}
    assert {r.tenant: r.total_rows for r in p.tables.collect()} == want and p.skipped.isEmpty()
    target, ledger = KeyedTarget(spark, str(tmp_path / "t"), {"leads": spec}, buckets=4), str(tmp_path / "l")
    migrate(Plan(p.tables, p.chunks.where("chunk_no % 2 = 1"), p.skipped), source, target, ledger)
    assert migrate(p, source, target, ledger).where("not ok").isEmpty()
    # rows keep their spelling
    assert sorted(tuple(r) for r in target.table("leads").collect()) == [r for r in ROWS if r[1].lower() in want]
    report = verify(source, target.tables(), [spec], tenants)
    assert {(r.tenant, r.src_count): r.ok for r in report.collect()} == {at: True for at in want.items()}
    others = isolation_report(target.tables(), [spec], "ACMe").collect()
    assert {(r.tenant, r.n) for r in others} == ({("Zoo", 100)} if "zoo" in want else set())
    assert tenant_slice(source["leads"], spec, "acMe").count() == 300


def test_without_it_they_are_apart(spark):
    p = plan({"leads": leads(spark)}, [SPECS["leads"]], "src", "account_id", chunk_size=30)
    assert {r.tenant: r.total_rows for r in p.tables.collect()} == {"Acme": 100, "ACME": 100, "acme": 100, "Zoo": 100}
    with pytest.raises(ValueError, match="any_case"):
        plan({"leads": leads(spark)}, [SPECS["leads"], ANY["activities"]], "src", "account_id")


def test_feed_start_and_lag(spark, tmp_path):
    events = [event("I", p, None, (p, ("Acme", "ACME", "Zoo")[p % 3], "x")) for p in range(1, 10)]
    some = tenant_changes(frame(spark, events), ANY, "src", ["acme"])
    assert some.count() == 6 == tenant_changes(frame(spark, events), ANY, "src", spark.createDataFrame([("aCMe",), ("Acme",)], "tenant string")).count()
    frame(spark, events).coalesce(1).write.parquet(str(tmp_path / "feed"))
    target = KeyedTarget(spark, str(tmp_path / "t"), ANY, buckets=4)
    starts = spark.createDataFrame([("aCME", "b.000001", 3)], "tenant string, log_file string, log_pos long")
    feed = file_feed(spark, str(tmp_path / "feed"), SPECS["leads"].schema)
    replicate(feed, target, "src", str(tmp_path / "cp"), tenants=["ACMe"], start=starts).awaitTermination()
    assert sorted(r.id for r in target.table("leads").collect()) == [4, 6, 7, 9]
    assert [(r.tenant, r.n_changes) for r in target.progress().collect()] == [("acme", 4)]
    (got,) = lag(frame(spark, events), target, "src", tenants=["acme"], start=starts).collect()
    assert got.tenant == "acme" and got.ready
    whole = {r.tenant: r.pending for r in lag(frame(spark, events), target, "src").collect()}
    assert whole == {"acme": 2, "zoo": 3}


def test_database_predicates():
    assert chunk_predicate(ANY["leads"], "acme", 1, 9, "jdbc:postgresql:x") == """LOWER("account_id") = 'acme' AND "id" BETWEEN 1 AND 9"""
    mysql = chunk_predicate(ANY["leads"], "acme", 1, 9, "jdbc:mysql:x")
    assert mysql.startswith("`account_id` = 'acme' AND CAST(CONVERT(LOWER(`account_id`) USING utf8mb4) AS BINARY) = ")
