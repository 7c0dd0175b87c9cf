import os

import pytest
from pyspark.sql import functions as F

from tenantferry.functions.coordinates import coordinate, is_coordinate_line
from tenantferry.session import metadata_rows
from tenantferry.sources.coordinates import coordinate_scan, missing_positions, start_positions


@pytest.mark.parametrize("line,want", [
    ("-- CHANGE MASTER TO MASTER_LOG_FILE='mysql-bin.000001', MASTER_LOG_POS=1234;", ("mysql-bin.000001", 1234)),
    ("  CHANGE REPLICATION SOURCE TO SOURCE_LOG_FILE = 'b.7' , SOURCE_LOG_POS = 9 ;", ("b.7", 9)),
    ("-- CHANGE MASTER TO MASTER_LOG_POS=4, MASTER_LOG_FILE='b.2';", ("b.2", 4)),
    ("-- CHANGE MASTER TO MASTER_LOG_FILE='b.2';", None),
    ("-- CHANGE MASTER TO MASTER_LOG_FILE='', MASTER_LOG_POS=4;", None),
    ("MASTER_LOG_FILE='b.2', MASTER_LOG_POS=4", None),
])
def test_lines(spark, line, want):
    df = metadata_rows(spark, [(line,)], "value string").where(is_coordinate_line(F.col("value")))
    got = [r[0] for r in df.select(coordinate(F.col("value"))).collect() if r[0]]
    assert (tuple(got[0]) if got else None) == want


def test_first_valid_line_of_each_file(spark, tmp_path):
    first = "-- CHANGE MASTER TO MASTER_LOG_FILE='b.1', MASTER_LOG_POS=10;\n"
    second = "-- CHANGE MASTER TO MASTER_LOG_FILE='b.0', MASTER_LOG_POS=5;\n"
    (tmp_path / "one").write_text("-- CHANGE MASTER TO MASTER_LOG_FILE='b.1';\n" + "x\n" * 1000 + first + second)
    (tmp_path / "two").write_text(second + first)
    (tmp_path / "none").write_text("INSERT\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    try:
        got = coordinate_scan(spark, f"{tmp_path}/*").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert {os.path.basename(r.file): (r.log_file, r.log_pos) for r in got} == {"one": ("b.1", 10), "two": ("b.0", 5)}


def test_progress_beats_handoff(spark):
    schema = "tenant string, log_file string, log_pos bigint"
    handoff = metadata_rows(spark, [("a", "b.1", 10), ("b", "b.1", 20)], schema)
    saved = metadata_rows(spark, [("a", "b.0", 99), ("c", "b.3", 1)], schema)
    starts = start_positions(handoff, saved)
    assert {tuple(r) for r in starts.collect()} == {
        ("a", "b.0", 99, "progress"), ("b", "b.1", 20, "handoff"), ("c", "b.3", 1, "progress")
    }
    asked = metadata_rows(spark, [("a",), ("d",)], "tenant string")
    assert [r.tenant for r in missing_positions(asked, starts).collect()] == ["d"]
