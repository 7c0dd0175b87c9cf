import random

import pytest
from pyspark.sql import functions as F

from feeds import ROW, SPECS, applied, changes_of, content, event, frame, random_events
from tenantferry import KeyedTarget, files
from tenantferry.operators import merge
from tenantferry.sources.feed import decode_feed, tenant_changes
from tenantferry.specs import TableSpec


@pytest.fixture
def target(spark, tmp_path):
    return KeyedTarget(spark, str(tmp_path / "t"), SPECS, buckets=4)


def rows(spark, *data):
    return spark.createDataFrame(list(data), ROW)


def test_set_operations(spark):
    held = rows(spark, (1, "a", "old"), (2, "a", "old"), (3, "b", "old"))
    new = rows(spark, (2, "a", "new"), (9, "a", "new"))
    def values(df):
        return sorted((r.id, r.v) for r in df.collect())
    assert values(merge.upsert(held, new, ["id"])) == [(1, "old"), (2, "new"), (3, "old"), (9, "new")]
    assert values(merge.insert_ignore(held, new, ["id"])) == [(1, "old"), (2, "old"), (3, "old"), (9, "new")]
    assert values(merge.delete_keys(held, new, ["id"])) == [(1, "old"), (3, "old")]
    ops = new.withColumn("_op", F.when(F.col("id") == 2, "D").otherwise("U"))
    assert values(merge.apply_changes(held, ops, ["id"])) == [(1, "old"), (3, "old"), (9, "new")]


def test_latest_per_key_with_one_hot_key(spark):
    changes = changes_of(spark, [event("U", i, None, (1 if i % 3 == 0 else i, "a", f"v{i}")) for i in range(300)])
    newest = merge.latest_per_key(changes, ["id", "table_name"])
    assert newest.where("id = 1").first().v == "v297"
    assert newest.count() == 1 + 200 - 1


def test_empty_target(target):
    assert content(target) == {}


def test_empty_load_and_empty_batch(spark, target):
    target.load({"leads": spark.createDataFrame([], ROW)})
    assert content(target) == {}
    target.apply(changes_of(spark, [event("D", 1, (1, "a", "x"))]).where("false"), "w", 0)
    target.load({"leads": rows(spark, (1, "a", "x"))})
    assert content(target) == {("leads", 1): (1, "a", "x")}
    target.compact()
    assert content(target) == {("leads", 1): (1, "a", "x")}


def test_load_replaces_and_never_removes(spark, target):
    target.load({"leads": rows(spark, (1, "a", "x"), (2, "a", "x")), "activities": rows(spark, (1, "a", "y"))})
    target.load({"leads": rows(spark, (2, "a", "z"), (3, "b", "z"))})
    assert content(target) == {
        ("leads", 1): (1, "a", "x"), ("leads", 2): (2, "a", "z"), ("leads", 3): (3, "b", "z"),
        ("activities", 1): (1, "a", "y"),
    }


def test_only_touched_buckets_are_rewritten(spark, target):
    target.load({"leads": spark.range(50).select("id", F.lit("a").alias("account_id"), F.lit("x").alias("v"))})
    before = target.state()["tables"]["leads"]
    target.apply(changes_of(spark, [event("U", 9, (7, "a", "x"), (7, "a", "y"))]), "w", 0)
    target.load({"leads": rows(spark, (7, "a", "z"))}, at=("b.000001", 5))
    after = target.state()["tables"]["leads"]
    assert sum(before[b] != after[b] for b in before) == 1
    assert target.table("leads").count() == 50 and content(target)["leads", 7] == (7, "a", "y")


@pytest.mark.parametrize("seed", [1, 2])
def test_any_batches_give_the_same_rows(spark, target, seed):
    events, rnd = random_events(400, seed=seed), random.Random(seed)
    target.load({"leads": rows(spark, *[(i, "acc_0", "base") for i in range(60)])})
    start = {("leads", i): (i, "acc_0", "base") for i in range(60)}
    cuts = sorted(rnd.sample(range(1, 400), 3))
    parts = [events[a:b] for a, b in zip([0, *cuts], [*cuts, 400])]
    # batches out of order, one delivered again
    for i, k in enumerate(rnd.sample(range(4), 4)):
        target.apply(changes_of(spark, parts[k]), "w", i)
        if i == 2:
            target.compact()
            target.vacuum()
    target.apply(changes_of(spark, parts[0]), "other", 0)
    assert content(target) == applied(events, state=start)
    target.compact()
    assert content(target) == applied(events, state=start)


def test_a_batch_is_applied_once(spark, target):
    first = changes_of(spark, [event("I", 1, None, (1, "a", "x"))])
    assert target.apply(first, "w", 0)
    assert not target.apply(changes_of(spark, [event("I", 2, None, (2, "a", "x"))]), "w", 0)
    assert list(content(target)) == [("leads", 1)]


def test_insert_delete_insert_of_one_key(spark, target):
    events = [
        event("I", 5, None, (1, "a", "one"), row_idx=0), event("D", 5, (1, "a", "one"), row_idx=1),
        event("I", 5, None, (1, "a", "two"), row_idx=2),
    ]
    target.apply(changes_of(spark, events), "w", 0)
    assert content(target) == {("leads", 1): (1, "a", "two")}


def test_a_late_change_loses_against_a_delete(spark, target):
    target.apply(changes_of(spark, [event("D", 9, (1, "a", "x"))]), "w", 0)
    target.compact()
    target.apply(changes_of(spark, [event("I", 3, None, (1, "a", "x"))]), "w", 1)
    assert content(target) == {}
    target.compact()
    assert content(target) == {}


def test_deletes_that_cannot_be_overtaken_are_forgotten(spark, target):
    target.apply(changes_of(spark, [event("D", 9, (1, "a", "x")), event("D", 20, (2, "a", "x"))]), "w", 0)
    target.compact(("b.000001", 9))
    target.vacuum()
    base = spark.read.parquet(f"{target.root}/base/table_name=leads")
    assert [r.id for r in base.collect()] == [2]


def test_a_failed_write_stays_invisible(spark, target, monkeypatch):
    target.load({"leads": rows(spark, (1, "a", "x"))})
    before = content(target)
    monkeypatch.setattr(KeyedTarget, "_publish", lambda self, state: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        target.apply(changes_of(spark, [event("D", 9, (1, "a", "x"))]), "w", 0)
    with pytest.raises(RuntimeError):
        target.load({"leads": rows(spark, (1, "a", "half"))})
    monkeypatch.undo()
    assert content(target) == before
    assert target.apply(changes_of(spark, [event("U", 9, None, (1, "a", "y"))]), "w", 0)
    assert content(target) == {("leads", 1): (1, "a", "y")}


def test_what_a_lost_batch_wrote_is_written_over(spark, target, monkeypatch):
    target.load({"leads": rows(spark, *[(i, "a", "x") for i in range(20)])})
    with monkeypatch.context() as m:
        m.setattr(KeyedTarget, "_publish", lambda self, state: (_ for _ in ()).throw(RuntimeError("lost")))
        for broken in (lambda: target.apply(changes_of(spark, [event("D", 9 + i, (i, "a", "x")) for i in range(9)]), "w", 0),
                       lambda: target.load({"leads": rows(spark, (3, "a", "half"), (99, "a", "half"))})):
            with pytest.raises(RuntimeError):
                broken()
    # another batch takes the number of the lost one
    target.apply(changes_of(spark, [event("U", 30, None, (1, "a", "y"))]), "w", 0)
    target.load({"leads": rows(spark, (2, "a", "z"))}, at=("b.000001", 40))
    assert content(target) == {("leads", i): (i, "a", {1: "y", 2: "z"}.get(i, "x")) for i in range(20)}


def test_two_writers_do_not_both_publish(spark, target):
    stale = target.state()
    target.load({"leads": rows(spark, (1, "a", "x"))})
    stale["seq"] = target.state()["seq"]
    with pytest.raises(FileExistsError):
        target._publish(stale)


def test_vacuum_keeps_what_is_read(spark, target):
    for i in range(3):
        target.apply(changes_of(spark, random_events(50, seed=i)), f"w{i}", 0)
    target.compact()
    before = content(target)
    target.vacuum()
    assert content(target) == before
    assert len(files.names(spark, f"{target.root}/pointer")) == 1
    held = {(int(b), v) for versions in target.state()["tables"].values() for b, v in versions.items()}
    stored = {(r._bucket, r._v) for r in spark.read.parquet(f"{target.root}/base").select("_bucket", "_v").distinct().collect()}
    assert stored == held


def test_progress_per_tenant(spark, target):
    target.apply(changes_of(spark, [event("I", 1, None, (1, "a", "x")), event("I", 7, None, (2, "b", "x"))]), "w", 0)
    target.apply(changes_of(spark, [event("I", 9, None, (1, "a", "x"))]), "w", 1)
    want = {"a": (9, 2), "b": (7, 1)}
    assert {r.tenant: (r.applied.log_pos, r.n_changes) for r in target.progress().collect()} == want
    target.compact()
    assert {r.tenant: (r.applied.log_pos, r.n_changes) for r in target.progress().collect()} == want


def test_tenants_in_one_target_or_apart(spark, tmp_path):
    events = [event("I", 1, None, (1, "a", "x")), event("U", 2, (1, "a", "x"), (1, "b", "y"))]
    apart = KeyedTarget(spark, str(tmp_path / "apart"), SPECS, buckets=2, tenant_in_key=True)
    apart.apply(changes_of(spark, events), "w", 0)
    assert sorted((r.account_id, r.v) for r in apart.table("leads").collect()) == [("a", "x"), ("b", "y")]


def test_composite_keys_are_deleted_whole(spark, tmp_path):
    spec = {"leads": TableSpec("leads", ROW, ("account_id", "id")), "activities": SPECS["activities"]}
    target = KeyedTarget(spark, str(tmp_path / "c"), spec, buckets=2)
    events = [event("I", i, None, (i, "a", "x")) for i in range(3)] + [event("D", 5, (1, "a", "x"))]
    target.apply(tenant_changes(frame(spark, events), spec, "src"), "w", 0)
    assert sorted(r.id for r in target.table("leads").collect()) == [0, 2]


# -- changes ------------------------------------------------------------------------------------------

def test_filters_and_images(spark):
    events = [
        event("I", 1, None, (1, "a", "x")), event("U", 2, (1, "a", "x"), (1, "b", "x")),
        event("D", 3, (1, "b", "x")), event("Q", 4), event("I", 5, None, (1, "a", "x"), schema="other"),
        event("I", 6, None, (2, None, "x")), event("I", 7, None, (3, "A", "x")), event("I", 8, None, (4, "a", "x"), table="unknown"),
    ]
    got = changes_of(spark, events, tenants=["a"]).collect()
    assert [(r._op, r._pos.log_pos, r.id) for r in got] == [("I", 1, 1)]
    listed = spark.createDataFrame([("b",), ("b",)], "tenant string")
    got = changes_of(spark, events, tenants=listed).collect()
    assert sorted((r._op, r._pos.log_pos) for r in got) == [("D", 3), ("U", 2)]


def test_leaving_the_tenant_and_changing_the_key(spark):
    events = [event("U", 2, (1, "a", "x"), (1, "b", "x")), event("U", 3, (2, "a", "x"), (5, "a", "x"))]
    def got(**kw):
        return sorted((r._op, r.id, r.account_id) for r in changes_of(spark, events, tenants=["a"], **kw).collect())
    assert got() == [("U", 5, "a")]
    assert got(on_tenant_exit="delete") == [("D", 1, "a"), ("U", 5, "a")]
    assert got(on_key_change="delete") == [("D", 2, "a"), ("U", 5, "a")]


def test_json_messages(spark):
    events = random_events(30)
    feed = frame(spark, events)
    messages = feed.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))
    assert decode_feed(messages, ROW).exceptAll(feed).isEmpty()


@pytest.mark.parametrize("compacted", [False, True])
def test_a_load_loses_against_what_was_applied_after_its_position(spark, target, compacted):
    first = rows(spark, (1, "a", "old"), (2, "a", "old"), (3, "a", "old"))
    target.load({"leads": first}, at=("b.000001", 100))
    target.apply(changes_of(spark, [
        event("U", 500, (1, "a", "old"), (1, "a", "new")), event("D", 501, (2, "a", "old")),
    ]), "w", 0)
    if compacted:
        target.compact()
    target.load({"leads": rows(spark, (1, "a", "old"), (2, "a", "old"), (3, "a", "again"), (4, "a", "old"))}, at=("b.000001", 100))
    want = {("leads", 1): (1, "a", "new"), ("leads", 3): (3, "a", "again"), ("leads", 4): (4, "a", "old")}
    assert content(target) == want
    target.compact()
    assert content(target) == want
