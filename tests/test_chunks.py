import math
import random

import pytest
from pyspark.sql import functions as F

from tenantferry import KeyedTarget, Plan, migrate, plan
from tenantferry.operators.chunks import assign_chunks, chunk_counts, explode_chunks
from tenantferry.operators.stats import slice_stats, with_widths
from tenantferry.session import metadata_rows
from tenantferry.specs import TableSpec

STATS = "table_name string, pk_col string, tenant string, min_pk bigint, max_pk bigint, total_rows bigint"


def expected(lo, hi, rows, size):
    step = max(1, math.ceil(size / (rows / (hi - lo + 1))))
    return [(s, min(s + step - 1, hi)) for s in range(lo, hi + 1, step)]


def chunks(spark, cases, size, **kw):
    stats = metadata_rows(spark, [("t", "id", str(i), *c) for i, c in enumerate(cases)], STATS)
    got = explode_chunks(with_widths(stats, size), **kw).orderBy("tenant", "start_pk").collect()
    return [[(r.start_pk, r.end_pk) for r in got if r.tenant == str(i)] for i in range(len(cases))]


def test_dense_slice(spark):
    (got,) = chunks(spark, [(1, 52000, 52000)], 5000)
    assert len(got) == 11 and got[0] == (1, 5000) and got[-1][1] == 52000


def test_cover_without_gaps(spark):
    (got,) = chunks(spark, [(1, 10000, 5000)], 1000)
    assert got[0][0] == 1 and got[-1][1] == 10000
    assert all(a[1] + 1 == b[0] for a, b in zip(got, got[1:]))


def test_sparse_slice_is_one_chunk(spark):
    assert chunks(spark, [(1, 10000, 1000)], 1000) == [[(1, 10000)]]


@pytest.mark.parametrize("size", [7, 500])
def test_random_slices(spark, size):
    rnd = random.Random(size)
    cases = []
    for _ in range(60):
        lo = rnd.randint(-1000, 10**9)
        span = rnd.randint(1, 3000)
        cases.append((lo, lo + span - 1, rnd.randint(max(1, span // 50), span)))
    assert chunks(spark, cases, size) == [expected(*c, size) for c in cases]


def test_blocks_do_not_change_the_chunks(spark):
    case = (5, 10_004, 10_000)
    assert chunks(spark, [case], 10, block=64) == [expected(*case, 10)]


@pytest.mark.parametrize("lo,hi", [(-(2**63), 2**63 - 1), (-(2**62), 2**62 + 5), (2**63 - 50, 2**63 - 1)])
def test_keys_at_the_edge_of_64_bits(spark, lo, hi):
    (got,) = chunks(spark, [(lo, hi, 50)], 7)
    assert got[0][0] == lo and got[-1][1] == hi
    assert all(a[1] + 1 == b[0] for a, b in zip(got, got[1:]))
    assert len(got) <= 9


def test_every_row_lies_in_one_chunk(spark):
    # one tenant holds a third of the rows, keys have holes
    df = spark.range(0, 9000, 3).select(
        "id", F.when(F.col("id") % 9 == 0, "big").otherwise(F.concat(F.lit("t"), (F.col("id") % 40).cast("string"))).alias("account_id")
    )
    spec = TableSpec.of(df, "t", ["id"])
    widths = with_widths(slice_stats(df, spec), 100)
    assigned = assign_chunks(df, spec, widths)
    assert assigned.count() == df.count()
    ranged = assigned.join(explode_chunks(widths), ["tenant", "start_pk"])
    assert ranged.where(F.col("id").between(F.col("start_pk"), F.col("end_pk"))).count() == df.count()
    assert chunk_counts(df, spec, widths).agg(F.sum("n")).first()[0] == df.count()


def test_rows_added_after_planning_are_in_no_chunk(spark):
    df = spark.range(100).withColumn("account_id", F.lit("a"))
    spec = TableSpec.of(df, "t", ["id"])
    widths = with_widths(slice_stats(df.where("id between 10 and 50"), spec), 10)
    got = [r.id for r in assign_chunks(df, spec, widths).collect()]
    assert sorted(got) == list(range(10, 51))


def test_unknown_tenant_has_no_stats(spark):
    df = spark.range(10).withColumn("account_id", F.lit("a"))
    assert slice_stats(df, TableSpec.of(df, "t", ["id"])).where("tenant = 'nobody'").isEmpty()


def test_wide_chunks_reach_the_last_key(spark):
    """A rest of one or two keys is a chunk of its own, however wide the chunks are."""
    sizes = [2_000_001, 4_000_000, 10**9, 2**40 + 1]
    for size in sizes:
        cases = [(1, n * size + rest, n * size + rest) for n in (1, 2, 3) for rest in (0, 1, 2)]
        for case, got in zip(cases, chunks(spark, cases, size)):
            assert got[0][0] == 1 and got[-1][1] == case[1]
            assert all(a[1] + 1 == b[0] for a, b in zip(got, got[1:]))
    (got,) = chunks(spark, [(-(2**62), 2**62, 2)], 1)
    assert got[0][0] == -(2**62) and got[-1][1] == 2**62


def test_even_chunks_of_skewed_keys(spark):
    # ten far keys, a dense run and a sparse tail, of two tenants
    keys = list(range(40_000)) + [10**12 + i * 10**11 for i in range(10)] + [10**7 + i * i for i in range(3000)]
    df = spark.createDataFrame([(k * 2 + t, f"acc_{t}") for k in keys for t in (0, 1)], "id long, account_id string").repartition(4)
    spec = TableSpec.of(df, "t", ["id"])
    plain, even = (plan({"t": df}, [spec], "src", "account_id", chunk_size=500, even=e) for e in (False, True))
    assert max(r.n for r in chunk_counts(df, spec, plain.tables).collect()) > 30_000
    counts = {(r.tenant, r.start_pk): r.n for r in chunk_counts(df, spec, even.tables, None, even.splits).collect()}
    assert max(counts.values()) <= 1000 and sum(counts.values()) == 2 * len(keys)
    chunks = [(r.tenant, r.start_pk, r.end_pk) for r in even.chunks.collect()]
    # a row's chunk is the listed one that holds its key, and chunks do not overlap
    for t in ("acc_0", "acc_1"):
        mine = sorted((a, b) for x, a, b in chunks if x == t)
        assert all(b < c for (_, b), (c, _) in zip(mine, mine[1:])) and len(mine) < 4 * len(keys) / 500
        mine_keys = sorted(k * 2 + int(t[-1]) for k in keys)
        import bisect

        for a, b in mine:
            n = bisect.bisect_right(mine_keys, b) - bisect.bisect_left(mine_keys, a)
            assert n == counts.get((t, a), 0)


def test_even_chunks_are_migrated_and_resumed(spark, tmp_path):
    keys = [*range(3000), *(10**9 + i for i in range(5)), 2**62]
    df = spark.createDataFrame([(k, f"acc_{k % 2}") for k in keys], "id long, account_id string")
    spec = TableSpec.of(df, "t", ["id"])
    p = plan({"t": df}, [spec], "src", "account_id", chunk_size=100, even=True)
    target, ledger = KeyedTarget(spark, str(tmp_path / "t"), {"t": spec}, buckets=4), str(tmp_path / "l")
    p.write(str(tmp_path / "plan"))
    p = Plan.read(spark, str(tmp_path / "plan"))
    some = p.chunks.where("start_pk % 3 = 0")
    migrate(Plan(p.tables, some, p.skipped, p.splits), {"t": df}, target, ledger)
    report = migrate(p, {"t": df}, target, ledger)
    assert report.where("not ok").isEmpty() and report.count() == p.chunks.count() - some.count()
    assert sorted(r.id for r in target.table("t").collect()) == keys


def test_keys_that_repeat_are_not_split_forever(spark):
    df = spark.createDataFrame([(7, "a")] * 50 + [(8, "a")] * 3, "id long, account_id string")
    spec = TableSpec.of(df, "t", ["id"])
    p = plan({"t": df}, [spec], "src", "account_id", chunk_size=5, even=True)
    assert sorted(r.n for r in chunk_counts(df, spec, p.tables, None, p.splits).collect()) == [3, 50]


def test_hashed_keys(spark):
    rows = [("a", f"k{i}", i if i % 9 else None) for i in range(400)]
    df = spark.createDataFrame(rows, "account_id string, code string, n long")
    spec = TableSpec.of(df, "t", ["code", "n"], hashed=True)
    import hashlib

    def number(code, n):
        text = f"{len(code)}:{code}" + ("~" if n is None else f"{len(str(n))}:{n}")
        return int(hashlib.md5(text.encode()).hexdigest()[:10], 16)

    got = {(r.code, r.n): r.h for r in df.select("code", "n", spec.chunk_key.alias("h")).collect()}
    assert got == {(c, n): number(c, n) for _, c, n in rows}
    p = plan({"t": df}, [spec], "src", "account_id", chunk_size=50)
    assert p.skipped.isEmpty() and p.tables.first().pk_col == "hash(code, n)"
    assert sum(r.n for r in chunk_counts(df, spec, p.tables).collect()) == 400
