from dataclasses import replace

import pytest
from pyspark.sql import DataFrameReader
from pyspark.sql import functions as F

from feeds import ROW, SPECS, applied, content, frame, random_events
from tenantferry import KeyedTarget, TableSpec, isolation_report, migrate, plan, replicate, verdict, verify
from tenantferry.operators import ledger as led
from tenantferry.plans.migrate import migrate_jdbc
from tenantferry.plans.planning import Plan
from tenantferry.plans.verification import ParityError, require_ok
from tenantferry.operators.keyed_target import BEFORE_ALL
from tenantferry.session import metadata_rows
from tenantferry.sources.feed import LAST_ROW, file_feed, newest_position


@pytest.fixture(scope="module")
def source(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("source"))
    # acc_0 owns a third of the rows and more; keys have holes
    account = F.when(F.col("id") % 3 == 0, "acc_0").otherwise(F.concat(F.lit("acc_"), (F.col("id") % 7).cast("string")))
    spark.range(0, 6000, 2).select("id", account.alias("account_id"), F.md5(F.col("id").cast("string")).alias("v")).write.parquet(f"{path}/leads")
    spark.range(900).select("id", account.alias("account_id"), (F.col("id") * 2).alias("n")).write.parquet(f"{path}/visits")
    return {n: spark.read.parquet(f"{path}/{n}") for n in ("leads", "visits")}


@pytest.fixture
def specs(source):
    return {n: TableSpec.of(df, n, ["id"]) for n, df in source.items()}


@pytest.fixture
def target(spark, specs, tmp_path):
    return KeyedTarget(spark, str(tmp_path / "target"), specs, buckets=4)


def make_plan(source, specs, **kw):
    return plan(source, specs.values(), "src", "account_id", chunk_size=200, **kw)


def same(source, target):
    return all(
        df.exceptAll(target.table(n)).isEmpty() and target.table(n).exceptAll(df).isEmpty() for n, df in source.items()
    )


def test_whole_migration(spark, source, specs, target, tmp_path):
    p, ledger = make_plan(source, specs), str(tmp_path / "ledger")
    report = migrate(p, source, target, ledger)
    assert report.where("not ok").isEmpty() and report.count() == p.chunks.count()
    assert same(source, target)
    done = led.read_ledger(spark, ledger)
    assert done.agg(F.sum("n_rows")).first()[0] == 3900
    assert {(r.tenant, r.table_name): r.n_done for r in led.completed_counts(done).collect()} == {
        (r.tenant, r.table_name): r.chunk_count for r in p.tables.collect()
    }


def test_run_again_does_nothing(source, specs, target, tmp_path):
    p, ledger = make_plan(source, specs), str(tmp_path / "ledger")
    migrate(p, source, target, ledger)
    before = target.state()["seq"]
    assert migrate(p, source, target, ledger).isEmpty()
    assert target.state()["seq"] == before


def test_resume(spark, source, specs, target, tmp_path):
    p, ledger = make_plan(source, specs), str(tmp_path / "ledger")
    some = p.chunks.where("chunk_no % 3 = 0")
    migrate(Plan(p.tables, some, p.skipped), source, target, ledger)
    assert led.completed(p.chunks, led.read_ledger(spark, ledger)).count() == some.count()
    # nothing but the rows of those chunks is there
    assert target.table("leads").count() + target.table("visits").count() == led.read_ledger(spark, ledger).agg(F.sum("n_rows")).first()[0]
    report = migrate(p, source, target, ledger)
    assert report.count() == p.chunks.count() - some.count() and report.where("not ok").isEmpty()
    assert same(source, target)


def test_killed_between_load_and_ledger(source, specs, target, tmp_path, monkeypatch):
    p, ledger = make_plan(source, specs), str(tmp_path / "ledger")
    with monkeypatch.context() as m:
        m.setattr(led, "record", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            migrate(p, source, target, ledger)
    assert migrate(p, source, target, ledger).where("not ok").isEmpty()
    assert same(source, target)


def test_a_chunk_with_extra_rows_is_not_done(spark, source, specs, target, tmp_path):
    p, ledger = make_plan(source, specs, include=["leads"]), str(tmp_path / "ledger")
    extra = spark.createDataFrame([(1, "acc_0", "stray")], source["leads"].schema)
    target.load({"leads": extra})
    bad = migrate(p, source, target, ledger).where("not ok").collect()
    assert [(r.tenant, r.tgt_count - r.src_count) for r in bad] == [("acc_0", 1)]
    pending = led.pending(p.chunks, led.read_ledger(spark, ledger)).collect()
    assert [(r.tenant, r.start_pk) for r in pending] == [("acc_0", bad[0].start_pk)]


def test_ledger_keeps_tenants_apart(spark):
    chunks = metadata_rows(spark, [("a", "t", 1, 5), ("b", "t", 1, 5)], "tenant string, table_name string, start_pk bigint, end_pk bigint")
    done = metadata_rows(spark, [("a", "t", 1, 5, 9)], led.SCHEMA)
    assert [r.tenant for r in led.pending(chunks, done).collect()] == ["b"]


def test_jdbc_source(spark, source, specs, target, tmp_path, monkeypatch):
    seen = []

    def jdbc(self, url, table, predicates=None, properties=None):
        seen.append(len(predicates))
        # Spark's names stand in backticks
        return source[table.strip('"')].where(" or ".join(f"({p})" for p in predicates).replace('"', "`"))

    monkeypatch.setattr(DataFrameReader, "jdbc", jdbc)
    p = make_plan(source, specs)
    assert migrate_jdbc(p, "jdbc:any:", target, str(tmp_path / "ledger"), wave=12) == 0
    assert max(seen) <= 12 and sum(seen) == p.chunks.count()
    assert same(source, target)


# -- hand-off ---

def test_position_captured_by_the_plan_completes_the_load(spark, tmp_path):
    """Changes before the capture are in the source, those after it come while chunks are planned, loaded and loaded again."""
    events = random_events(240, keys=60)
    cuts = [events[:120], events[120:160], events[160:200], events[200:]]
    feed, ledger = str(tmp_path / "feed"), str(tmp_path / "ledger")

    def happen(part):
        frame(spark, part).coalesce(1).write.mode("append").parquet(feed)

    def source(upto):
        """What the tables hold after some of the parts."""
        rows = applied([e for part in cuts[:upto] for e in part])
        return {n: spark.createDataFrame([r for (t, _), r in rows.items() if t == n], ROW) for n in SPECS}

    target = KeyedTarget(spark, str(tmp_path / "target"), SPECS, buckets=4)
    assert target.handoff() is None
    happen(cuts[0])
    order = []

    def capture():
        order.append(newest_position(spark.read.parquet(feed), "src"))
        happen(cuts[1])  # right after the capture, before the statistics
        return order[0]

    made = plan(source(2), SPECS.values(), "src", "account_id", chunk_size=5, capture=capture)
    made.write(str(tmp_path / "plan"))
    made = Plan.read(spark, str(tmp_path / "plan"))
    assert made.handoff == order[0] == tuple(events[119][3]) and len(order) == 1
    happen(cuts[2])
    migrate(replace(made, chunks=made.chunks.where("chunk_no % 2 = 0")), source(2), target, ledger)
    assert target.handoff() == order[0]
    migrate(made, source(3), target, ledger)  # resumed when the source has moved on
    happen(cuts[3])
    assert target.handoff() == order[0]
    live = file_feed(spark, feed, ROW)
    replicate(live, target, "src", str(tmp_path / "checkpoint"), start=target.handoff()).awaitTermination()
    assert content(target) == applied(events)


def test_handoff_is_published_with_the_rows(spark, source, specs, target, tmp_path, monkeypatch):
    p = make_plan(source, specs, capture=lambda: ("b.000007", 11))
    assert p.handoff == ("b.000007", 11, LAST_ROW)
    with monkeypatch.context() as m:
        m.setattr(target, "_publish", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            migrate(p, source, target, str(tmp_path / "ledger"))
    assert target.handoff() is None
    migrate(p, source, target, str(tmp_path / "ledger"))
    assert target.handoff() == p.handoff
    target.load({}, ("b.000009", 1))
    assert target.handoff() == p.handoff  # the earliest counts
    target.load({})
    assert target.handoff() == BEFORE_ALL  # unknown: the whole feed is needed


def test_a_plan_written_over_another_leaves_nothing_of_it(spark, source, specs, tmp_path):
    make_plan(source, specs, capture=lambda: ("b.000007", 11), even=True).write(str(tmp_path / "plan"))
    make_plan(source, specs).write(str(tmp_path / "plan"))
    again = Plan.read(spark, str(tmp_path / "plan"))
    assert again.handoff is None and again.splits is None
    assert newest_position(frame(spark, []), "src") is None


# -- verification -----------------------------------------------------------------------------------

def test_verify_finds_each_kind_of_difference(spark, source, specs):
    leads = source["leads"]
    changed = leads.withColumn("v", F.when(F.col("id") == 6, "changed").otherwise(F.col("v")))
    lost = leads.where("id <> 6")
    extra = leads.unionByName(spark.createDataFrame([(7, "acc_new", "x")], leads.schema))
    def bad(target):
        report = verify(source, {"leads": target, "visits": source["visits"]}, specs.values())
        return [(r.tenant, r.count_ok, r.checksum_ok) for r in report.where("not ok").collect()]
    assert bad(leads) == []
    assert bad(changed) == [("acc_0", True, False)]
    assert bad(lost) == [("acc_0", False, False)]
    assert bad(extra) == [("acc_new", False, False)]


def test_verdict_and_error(spark, source, specs):
    good = verify(source, source, specs.values())
    assert verdict(good).first().ok
    require_ok(good)
    require_ok(good.where("false"))
    bad = verify(source, source | {"visits": source["visits"].where("id > 5")}, specs.values())
    with pytest.raises(ParityError):
        require_ok(bad)
    assert {r.ok for r in verdict(bad, ["table_name"]).where("table_name = 'leads'").collect()} == {True}


def test_listed_tenants_and_skipped_tables(spark, source, specs):
    count = source["leads"].where("account_id = 'acc_0'").count()
    asked = metadata_rows(spark, [("acc_0",), ("nobody",)], "tenant string")
    report = verify(source, source, specs.values(), asked, skipped=["visits"]).collect()
    assert {(r.tenant, r.table_name, r.src_count, r.ok) for r in report} == {("acc_0", "leads", count, True), ("nobody", "leads", 0, True)}


def test_isolation(spark, source, specs):
    mine = {n: df.where("account_id = 'acc_0'") for n, df in source.items()}
    assert isolation_report(mine, specs.values(), "acc_0").isEmpty()
    leaky = mine | {"visits": source["visits"].where("account_id in ('acc_0', 'acc_2')")}
    got = isolation_report(leaky, specs.values(), "acc_0").collect()
    assert [(r.table_name, r.tenant) for r in got] == [("visits", "acc_2")]
