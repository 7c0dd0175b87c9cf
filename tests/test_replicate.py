import os
import time

import pytest
from pyspark.errors import StreamingQueryException

from feeds import ROW, SPECS, applied, changes_of, content, event, frame, random_events
from tenantferry import KeyedTarget, replicate
from tenantferry.sources.feed import file_feed
from tenantferry.streaming.replicate import duplicate_positions, lag, writer_of


@pytest.fixture
def site(spark, tmp_path):
    class Site:
        feed = str(tmp_path / "feed")
        checkpoint = str(tmp_path / "checkpoint")
        target = KeyedTarget(spark, str(tmp_path / "target"), SPECS, buckets=4)
        clock = time.time() - 10_000

        def add(self, events, older=0):
            """One more file, with a modification time of its own."""
            known = set(os.listdir(self.feed)) if os.path.isdir(self.feed) else set()
            frame(spark, events).coalesce(1).write.mode("append").parquet(self.feed)
            for n in set(os.listdir(self.feed)) - known:
                at = self.clock + len(known) - older
                os.utime(f"{self.feed}/{n}", (at, at))

        def run(self, max_files=1, **kw):
            feed = file_feed(spark, self.feed, ROW, max_files)
            replicate(feed, self.target, "src", self.checkpoint, **kw).awaitTermination()

    return Site()


def parts(events, n=4):
    size = len(events) // n
    return [events[i * size:(i + 1) * size if i < n - 1 else None] for i in range(n)]


def test_insert_update_delete(site):
    site.add([event("I", 1, None, (1, "a", "x")), event("I", 2, None, (2, "a", "x"))])
    site.add([event("U", 3, (1, "a", "x"), (1, "a", "y"))])
    site.add([event("D", 4, (2, "a", "x"))])
    site.run()
    assert content(site.target) == {("leads", 1): (1, "a", "y")}


def test_restart_takes_up_where_it_stopped(site):
    events = random_events(300)
    a, b = parts(events, 2)
    site.add(a)
    site.run()
    done = site.target.state()["seq"]
    site.run()
    assert site.target.state()["seq"] == done
    site.add(b)
    site.run()
    assert content(site.target) == applied(events)


def test_files_in_reversed_order(site):
    events = random_events(300, seed=5)
    for i, part in enumerate(parts(events)):
        site.add(part, older=100 * i)
    site.run()
    assert content(site.target) == applied(events)


@pytest.mark.parametrize("when", ["before", "after"])
def test_failure_around_the_commit(site, monkeypatch, when):
    events = random_events(200, seed=3)
    for part in parts(events, 2):
        site.add(part)
    publish, calls = KeyedTarget._publish, []

    def failing(self, state):
        calls.append(1)
        if len(calls) == 2:
            if when == "after":
                publish(self, state)
            raise RuntimeError("executor lost")
        publish(self, state)

    monkeypatch.setattr(KeyedTarget, "_publish", failing)
    with pytest.raises(StreamingQueryException):
        site.run()
    monkeypatch.undo()
    site.run()
    assert content(site.target) == applied(events)


def test_one_tenant(site):
    events = random_events(200, seed=4)
    site.add(events)
    site.run(tenants=["acc_1"])
    assert content(site.target) == applied(events, tenants={"acc_1"})


def test_batches_without_the_tenant_leave_no_commit(site):
    site.add([event("I", 1, None, (1, "a", "x"))])
    site.run(tenants=["nobody"])
    assert site.target.state()["seq"] == 0


def test_handoff_converges(spark, site):
    """Load of a later state, then replay from before it."""
    events = random_events(300, seed=6)
    seen = applied(events[:200])
    loads = {n: spark.createDataFrame([r for (t, _), r in seen.items() if t == n], ROW) for n in SPECS}
    start = events[100][3]
    site.target.load(loads, start)
    for part in parts(events):
        site.add(part)
    site.run(max_files=2, start=start)
    assert content(site.target) == applied(events)


def test_start_per_tenant(spark, site):
    site.add([event("I", p, None, (p * 10 + k, f"acc_{k}", "x"), row_idx=k) for p in range(1, 6) for k in range(3)])
    starts = spark.createDataFrame([("acc_0", "b.000001", 2), ("acc_1", "b.000001", 4)], "tenant string, log_file string, log_pos long")
    site.run(start=starts)
    assert sorted(i for _, i in content(site.target)) == [30, 40, 50, 51]


def test_lag(spark, site):
    events = [event("I", p, None, (p, f"acc_{p % 2}", "x")) for p in range(1, 9)]
    site.target.apply(changes_of(spark, events[:5]), "w", 0)
    got = {r.tenant: (r.feed_pos.log_pos, r.applied_pos.log_pos, r.pending, r.ready) for r in lag(frame(spark, events), site.target, "src").collect()}
    assert got == {"acc_0": (8, 4, 2, False), "acc_1": (7, 5, 1, False)}
    site.target.apply(changes_of(spark, events[5:]), "w", 1)
    assert all(r.ready for r in lag(frame(spark, events), site.target, "src").collect())


def test_lag_sees_what_comes_late(spark, site):
    events = [event("I", p, None, (p, "a", "x")) for p in (499, 500, 501)]
    start = ("b.000001", 499)
    site.target.apply(changes_of(spark, events[2:]), "w", 0)
    for kw, pending in (({}, 2), ({"start": start}, 1)):
        got = lag(frame(spark, events), site.target, "src", **kw).first()
        assert (got.applied_pos.log_pos, got.pending, got.ready) == (501, pending, False)
    site.target.apply(changes_of(spark, events[1:2]), "w", 1)
    assert lag(frame(spark, events), site.target, "src", start=start).first().ready
    # another writer's replay of the same changes does not make up for the missing one
    site.target.apply(changes_of(spark, events[1:]), "again", 0)
    assert not lag(frame(spark, events), site.target, "src").first().ready


def test_recent_lag_reads_past_the_applied_position(spark, site):
    events = random_events(400, seed=8)
    for part in parts(events):
        site.add(part)
    static = spark.read.schema(frame(spark, []).schema).parquet(site.feed)
    # nothing is applied yet: all is pending, by both ways
    assert sorted(lag(static, site.target, "src", recent=True).collect()) == sorted(lag(static, site.target, "src").collect())
    site.target.apply(changes_of(spark, events[:250]), "w", 0)
    report = lag(static, site.target, "src", recent=True)
    got = sorted(report.collect())
    assert got == sorted(lag(static, site.target, "src").collect()) and sum(r.pending for r in got) == 150
    # the scan skips by the position
    mode = spark.sparkContext._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    pushed = [line for line in report._jdf.queryExecution().explainString(mode).splitlines() if "PushedFilters" in line and "schema_name" in line]
    assert pushed and all("GreaterThanOrEqual(pos.log_file,b.000003)" in line for line in pushed)
    site.target.apply(changes_of(spark, events[250:]), "w", 1)
    done = lag(static, site.target, "src", recent=True).collect()
    assert len(done) == 3 and all(r.ready and r.pending == 0 and r.feed_pos == r.applied_pos for r in done)
    site.target.apply(changes_of(spark, events), "again", 0)
    with pytest.raises(ValueError, match="several writers"):
        lag(static, site.target, "src", recent=True)


def test_the_writer_is_named_by_the_id_in_its_checkpoint(spark, site):
    site.add([event("I", 1, None, (1, "a", "x"))])
    site.run()
    named = writer_of(spark, site.checkpoint)
    assert site.target.state()["writers"] == {named: 0} and site.checkpoint not in named
    got = site.target.progress_of_writers().first()
    assert (got.tenant, got.writer, got.batch_id, got.n_changes) == ("a", named, 0, 1) and got.last_ts is not None
    assert lag(frame(spark, [event("I", 1, None, (1, "a", "x"))]), site.target, "src", site.checkpoint).first().ready


def test_no_start_position_is_an_error(spark, site):
    site.add([event("I", 1, None, (1, "a", "x"))])
    starts = spark.createDataFrame([("a", "b.000001", 0)], "tenant string, log_file string, log_pos long")
    with pytest.raises(ValueError, match="'b'"):
        site.run(tenants=["a", "b"], start=starts)
    site.run(tenants=["a"], start=starts)
    assert len(content(site.target)) == 1


@pytest.mark.parametrize("tenants", [None, ["a", "b"]])
def test_a_copy_goes_with_its_tenant(spark, tmp_path, tenants):
    apart = KeyedTarget(spark, str(tmp_path / "apart"), SPECS, buckets=2, tenant_in_key=True)
    events = [event("I", 1, None, (1, "a", "x")), event("U", 2, (1, "a", "x"), (1, "b", "y")), event("U", 3, (1, "b", "y"), (1, "b", "z"))]
    path = str(tmp_path / "feed")
    frame(spark, events).write.parquet(path)
    replicate(file_feed(spark, path, ROW), apart, "src", str(tmp_path / "cp"), tenants, on_tenant_exit="delete").awaitTermination()
    assert [(r.account_id, r.v) for r in apart.table("leads").collect()] == [("b", "z")]
    assert all(r.ready for r in lag(frame(spark, events), apart, "src", tenants=tenants, on_tenant_exit="delete").collect())


def test_conflicting_positions_are_found(spark):
    events = [event("I", 1, None, (1, "a", "x")), event("I", 1, None, (1, "a", "x")), event("I", 2, None, (1, "a", "x")), event("I", 2, None, (2, "a", "x"))]
    assert [r.pos.log_pos for r in duplicate_positions(frame(spark, events), "src").collect()] == [2]
