"""Unsigned 64-bit keys from the plan to the resumed load, against plain arithmetic."""

import math
import random
from decimal import Decimal

import pytest

from tenantferry import KeyedTarget, TableSpec, migrate, plan
from tenantferry.functions.chunking import KEY, WIDE, key_kind
from tenantferry.operators import ledger as led
from tenantferry.operators.chunks import chunk_counts
from tenantferry.plans.migrate import pending_ranges, within
from tenantferry.plans.planning import Plan
from tenantferry.sources.slices import key_range

TOP = 2**64 - 1


def table(spark, keys, name="t"):
    df = spark.createDataFrame([(Decimal(k), f"acc_{k % 2}") for k in keys], "id decimal(20,0), account_id string")
    return df, TableSpec.of(df, name, ["id"])


def cut(keys, size):
    """Chunks by whole numbers; the step as the formula has it, in doubles."""
    lo, hi = min(keys), max(keys)
    step = min(2**63 - 1, max(1, math.ceil(float(size) / (float(len(keys)) / float(hi - lo + 1)))))
    return [(s, min(s + step - 1, hi)) for s in range(lo, hi + 1, step)]


@pytest.fixture(scope="module")
def keys():
    rnd = random.Random(3)
    return sorted({0, 1, 2**63 - 1, 2**63, TOP, *(rnd.randrange(TOP) for _ in range(900)), *range(2**63 - 40, 2**63 + 40)})


def test_chunks_equal_whole_number_arithmetic(spark, keys):
    df, spec = table(spark, keys)
    assert spec.unsigned and not TableSpec.of(df.selectExpr("cast(id as decimal(10,0)) as id", "account_id"), "t", ["id"]).unsigned
    p = plan({"t": df}, [spec], "src", "account_id", chunk_size=40)
    assert p.skipped.isEmpty() and key_kind(p.chunks, "start_pk") == WIDE
    got = [(r.tenant, int(r.start_pk), int(r.end_pk)) for r in p.chunks.collect()]
    want = [(f"acc_{t}", a, b) for t in (0, 1) for a, b in cut([k for k in keys if k % 2 == t], 40)]
    assert sorted(got) == sorted(want)
    counts = {(r.tenant, int(r.start_pk)): r.n for r in chunk_counts(df, spec, p.tables).collect()}
    held = {(t, a): sum(a <= k <= b and k % 2 == int(t[-1]) for k in keys) for t, a, b in want}
    assert counts == {at: n for at, n in held.items() if n}


@pytest.mark.parametrize("even", [False, True])
def test_migrate_resume_and_a_signed_table_beside_it(spark, tmp_path, keys, even):
    df, spec = table(spark, keys)
    signed = spark.createDataFrame([(k, f"acc_{k % 2}") for k in [*range(-50, 300), -(2**63), 2**63 - 1]], "id long, account_id string")
    source, specs = {"t": df, "s": signed}, {"t": spec, "s": TableSpec.of(signed, "s", ["id"])}
    p = plan(source, specs.values(), "src", "account_id", chunk_size=25, even=even)
    p.write(str(tmp_path / "plan"))
    p = Plan.read(spark, str(tmp_path / "plan"))
    target, ledger = KeyedTarget(spark, str(tmp_path / "target"), specs, buckets=4), str(tmp_path / "ledger")
    some = p.chunks.where("chunk_no % 2 = 0")
    migrate(Plan(p.tables, some, p.skipped, p.splits), source, target, ledger)
    report = migrate(p, source, target, ledger)
    assert report.where("not ok").isEmpty() and report.count() == p.chunks.count() - some.count()
    assert migrate(p, source, target, ledger).isEmpty()
    for name, rows in source.items():
        assert sorted(rows.collect()) == sorted(target.table(name).collect())
    # each key lies in one listed chunk of its tenant
    ends = [(r.tenant, r.table_name, int(r.start_pk), int(r.end_pk)) for r in p.chunks.collect()]
    for k in keys:
        assert sum(t == f"acc_{k % 2}" and n == "t" and a <= k <= b for t, n, a, b in ends) == 1


def test_pending_ranges_reach_the_scan(spark, tmp_path, keys):
    df, spec = table(spark, keys)
    df.write.parquet(str(tmp_path / "t"))
    read = spark.read.parquet(str(tmp_path / "t"))
    p = plan({"t": read}, [spec], "src", "account_id", chunk_size=25)
    ranges = pending_ranges(p.chunks.where("start_pk >= 9223372036854775808"))["t"]
    near = within(read, spec, ranges)
    plan_text = near._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(id,9" in plan_text or "GreaterThanOrEqual(id,1" in plan_text
    assert sorted(int(r.id) for r in near.collect()) == [k for k in keys if any(a <= k <= b for a, b in ranges)]
    assert [int(r.id) for r in key_range(read, spec, TOP, TOP).collect()] == [TOP]


def test_a_ledger_of_signed_keys_is_read_on(spark, tmp_path):
    path, row = str(tmp_path / "ledger"), "tenant string, table_name string, start_pk {0}, end_pk {0}, n_rows bigint"
    led.record(spark.createDataFrame([("a", "s", -5, 7, 3)], row.format(KEY)), path)
    led.record(spark.createDataFrame([("a", "t", Decimal(2**63), Decimal(TOP), 4)], row.format(WIDE)), path)
    assert {int(r.end_pk) for r in led.read_ledger(spark, path, WIDE).collect()} == {7, TOP}
    signed = led.read_ledger(spark, path)
    assert [tuple(r) for r in signed.collect()] == [("a", "s", -5, 7, 3)] and dict(signed.dtypes)["start_pk"] == KEY
    assert led.read_ledger(spark, str(tmp_path / "none"), WIDE).isEmpty()
