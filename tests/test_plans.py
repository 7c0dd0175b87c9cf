"""What the physical plans look like: pushdown, pruning, and nothing that does not scale."""

import re

import pytest
from pyspark.sql import functions as F

from feeds import ROW, SPECS, frame, random_events
from tenantferry import verify
from tenantferry.operators.chunks import _marked, chunk_counts, explode_chunks
from tenantferry.operators.merge import latest_per_key
from tenantferry.operators.parity import slice_metrics
from tenantferry.operators.stats import slice_stats, with_widths
from tenantferry.plans.migrate import pending_ranges, pending_rows, pending_tenants, within
from tenantferry.session import materialise
from tenantferry.sources.feed import tenant_changes
from tenantferry.sources.slices import key_range, tenant_slice
from tenantferry.specs import TableSpec


def explained(df):
    return df._jdf.queryExecution().explainString(df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "t")
    spark.range(5000).select(
        "id", F.concat(F.lit("acc_"), (F.col("id") % 5).cast("string")).alias("account_id"),
        F.lit("x").alias("wide_text"),
    ).write.parquet(path)
    df = spark.read.parquet(path)
    return df, TableSpec.of(df, "t", ["id"])


def test_slice_and_range_reach_the_scan(table):
    df, spec = table
    text = explained(key_range(tenant_slice(df, spec, "acc_1"), spec, 10, 20))
    pushed = re.search(r"PushedFilters: (.*)", text).group(1)
    for part in ("EqualTo(account_id,acc_1)", "GreaterThanOrEqual(id,10)", "LessThanOrEqual(id,20)"):
        assert part in pushed


def test_statistics_read_two_columns_and_combine_before_the_shuffle(table):
    df, spec = table
    text = explained(slice_stats(df, spec))
    assert "wide_text" not in re.search(r"ReadSchema: (.*)", text).group(1)
    assert "partial_min" in text and text.count("Exchange") <= 3


def test_checksum_is_one_scan_and_one_small_shuffle(table):
    df, spec = table
    text = explained(slice_metrics(df, spec))
    assert len(re.findall(r"^\(\d+\) Exchange", text, re.M)) == 1
    assert len(re.findall(r"^\(\d+\) Scan", text, re.M)) == 1 and "partial_bit_xor" in text
    assert "Python" not in text


def test_rows_find_their_chunk_by_an_equi_join(table):
    df, spec = table
    widths = materialise(with_widths(slice_stats(df, spec), 100))
    text = explained(chunk_counts(df, spec, widths))
    assert "BroadcastHashJoin" in text and "NestedLoop" not in text
    assert "wide_text" not in text


def test_bounds_of_the_pending_chunks_reach_the_scan(table):
    df, spec = table
    widths = materialise(with_widths(slice_stats(df, spec), 100), "widths")
    todo = materialise(explode_chunks(widths).where("tenant between 'acc_1' and 'acc_2' and chunk_no = 3"), "todo")
    ranges, tenants = pending_ranges(todo)["t"], pending_tenants(todo)["t"]
    near = within(df, spec, ranges, tenants)
    rows = pending_rows(near, spec, widths, todo)
    text = explained(rows)
    pushed = " ".join(re.findall(r"PushedFilters: (.*)", text))
    for part in ("In(account_id, [acc_1,acc_2])", f"GreaterThanOrEqual(id,{ranges[0][0]})", f"LessThanOrEqual(id,{ranges[-1][1]})"):
        assert part in pushed
    assert len(re.findall(r"ReadSchema: .*wide_text", text)) == 1
    assert sorted(r.n for r in chunk_counts(near, spec, widths, todo).collect()) == [100, 100] and rows.count() == 200


def test_two_pending_chunks_at_both_ends_read_two_row_groups(spark, tmp_path):
    path = str(tmp_path / "many")
    spark.range(0, 200_000, 1, 1).select("id", F.lit("a").alias("account_id")).write.option("parquet.block.size", 64 * 1024).option(
        "parquet.page.row.count.limit", 2000).parquet(path)
    df = spark.read.parquet(path)
    spec = TableSpec.of(df, "many", ["id"])
    widths = materialise(with_widths(slice_stats(df, spec), 1000), "widths")
    todo = materialise(explode_chunks(widths).where("chunk_no in (0, 199)"), "todo")
    ranges = pending_ranges(todo)["many"]
    assert ranges == [(0, 999), (199_000, 199_999)]
    near = within(df, spec, ranges)
    near.write.format("noop").mode("overwrite").save()
    rows = near._jdf.queryExecution().executedPlan()
    near.collect()
    scans = [rows]
    read = None
    while scans:  # the rows that the scan gave, before the filter
        node = scans.pop()
        if node.nodeName().startswith("Scan"):
            read = node.metrics().apply("numOutputRows").value()
        children = node.children()
        scans += [children.apply(i) for i in range(children.size())]
    assert near.count() == 2000
    assert read is None or read < 100_000


def test_ranges_are_bounded_and_cover_what_is_pending(spark):
    import random

    r = random.Random(3)
    for span in (1000, 2**63 - 1):
        chunks = [(f"t{i % 7}", "x", a, a + r.randrange(5)) for i, a in enumerate(sorted(r.randrange(-span, span - 10) for _ in range(300)))]
        pending = spark.createDataFrame(chunks, "tenant string, table_name string, start_pk long, end_pk long")
        ranges = pending_ranges(pending)["x"]
        assert len(ranges) <= 64 and all(b < c for (_, b), (c, _) in zip(ranges, ranges[1:]))
        assert all(any(a <= s and e <= b for a, b in ranges) for _, _, s, e in chunks)
        assert (ranges[0][0], ranges[-1][1]) == (min(c[2] for c in chunks), max(c[3] for c in chunks))


def test_ranges_with_next_to_nothing_between_them_are_one(spark):
    chunks = spark.range(30_000).selectExpr("'a' as tenant", "'x' as table_name", "id * 10 as start_pk", "id * 10 + 9 as end_pk")
    assert pending_ranges(chunks.where("start_pk % 30 = 0"))["x"] == [(0, 299_979)]
    assert pending_ranges(chunks.where("start_pk < 1000 or start_pk >= 299000"))["x"] == [(0, 999), (299_000, 299_999)]


def test_listed_chunks_are_looked_up_as_bits(table, spark):
    df, spec = table
    widths = materialise(with_widths(slice_stats(df, spec), 2), "widths")
    every = materialise(explode_chunks(widths), "chunks")
    todo = every.where("chunk_no % 3 = 0").select("tenant", "table_name", "start_pk", "end_pk")
    off = todo.withColumn("start_pk", F.col("start_pk") + 1)  # no chunk of this plan starts there
    rows = pending_rows(df, spec, widths, todo.unionByName(off.where("end_pk > start_pk")))
    starts = {(r.tenant, r.start_pk, r.end_pk) for r in todo.collect()}
    want = sorted(r.id for r in df.select("id", "account_id").collect() if any(t == r.account_id and a <= r.id <= b for t, a, b in starts))
    assert sorted(r.id for r in rows.select("id").collect()) == want
    counts = {(r.tenant, r.start_pk): r.n for r in chunk_counts(df, spec, widths, todo).collect()}
    assert sum(counts.values()) == len(want) and set(counts) <= {(t, a) for t, a, _ in starts}
    # a row of the list stands for 64 chunks, so the list is broadcast where chunk by chunk it would not be
    marked = _marked(every, spec, widths)
    assert marked.count() <= every.count() / 64 + widths.count()


def test_newest_change_combines_before_the_shuffle(spark):
    changes = tenant_changes(frame(spark, random_events(50)), SPECS, "src")
    text = explained(latest_per_key(changes, ["id", "table_name"]))
    assert len(re.findall(r"^\(\d+\) WindowGroupLimit", text, re.M)) == 2
    assert len(re.findall(r"^\(\d+\) Exchange", text, re.M)) == 1


def test_feed_filters_reach_the_scan(spark, tmp_path):
    frame(spark, random_events(50)).write.parquet(str(tmp_path / "feed"))
    text = explained(tenant_changes(spark.read.parquet(str(tmp_path / "feed")), SPECS, "src", ["acc_1"]))
    pushed = re.search(r"PushedFilters: (.*)", text).group(1)
    assert "EqualTo(schema_name,src)" in pushed and "account_id,acc_1" in pushed


def test_listed_tenants_are_filtered_in_the_scan(table):
    df, spec = table
    text = explained(verify({"t": df}, {"t": df}, [spec], ["acc_1", "acc_2"]))
    assert re.search(r"PushedFilters: .*In\(account_id, \[acc_1,acc_2\]\)", text)
