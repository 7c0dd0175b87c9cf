import zlib
from functools import reduce

import pytest
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenantferry.functions.encode import row_text, tagged_row_text
from tenantferry.operators.parity import slice_metrics
from tenantferry.specs import TableSpec

ROWS = [
    (1, "a", "plain", None), (2, "a", "", "x"), (3, "a", "NULL", "NULL"), (4, "a", "pipe|inside", "größe 漢字 🚀"),
    (5, "b", None, None),
]


@pytest.fixture
def rows(spark):
    return spark.createDataFrame(ROWS, "id long, account_id string, x string, y string")


def spec_of(df, **kw):
    return TableSpec.of(df, "t", ["id"], **kw)


def text(row):
    return "|".join("NULL" if v is None else str(v) for v in row)


def metric(df, tenant, mode="compat"):
    row = slice_metrics(df, spec_of(df), mode).where(F.col("tenant") == tenant).first()
    return row.n, row.checksum


def test_equals_crc_of_row_texts(rows):
    fold = reduce(lambda a, r: a ^ zlib.crc32(text(r).encode()), [r for r in ROWS if r[1] == "a"], 0)
    assert metric(rows, "a") == (4, fold)


def test_order_and_partitions_do_not_matter(rows):
    want = metric(rows, "a")
    assert metric(rows.repartition(7), "a") == want
    assert metric(rows.orderBy(F.desc("id")).coalesce(1), "a") == want


def test_compat_mode_cannot_tell_null_from_its_text(spark, rows):
    other = rows.withColumn("y", F.when(F.col("id") == 1, "NULL").otherwise(F.col("y")))
    assert metric(other, "a") == metric(rows, "a")
    assert metric(other, "a", "strong") != metric(rows, "a", "strong")


def test_strong_mode_sees_moved_separators_and_equal_pairs(spark):
    schema = "id long, account_id string, x string, y string"
    a = spark.createDataFrame([(1, "a", "p|q", "r")], schema)
    b = spark.createDataFrame([(1, "a", "p", "q|r")], schema)
    assert metric(a, "a") == metric(b, "a")
    assert metric(a, "a", "strong") != metric(b, "a", "strong")
    twice, other = a.union(a), b.union(b)
    assert metric(twice, "a") == metric(other, "a")
    assert metric(twice, "a", "strong") != metric(other, "a", "strong")


def test_strong_mode_by_hand(rows):
    def tagged(row):
        return ",".join("~" if v is None else f"{len(str(v))}:{v}" for v in row)

    signed = []
    for r in ROWS:
        if r[1] == "a":
            h = xxhash.xxh64_intdigest(tagged(r).encode(), seed=42)
            signed.append(h - 2**64 if h >= 2**63 else h)
    want = f"{reduce(lambda a, b: a ^ b, signed)}:{sum(signed)}"
    assert metric(rows, "a", "strong") == (4, want)


def test_tagged_text(rows):
    got = rows.where("id = 4").select(tagged_row_text(spec_of(rows))).first()[0]
    assert got == "1:4,1:a,11:pipe|inside,10:größe 漢字 🚀"


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
@pytest.mark.parametrize("digits,want", [
    (0, ["2024-03-10 02:30:00", "2024-03-10 02:30:00", "1969-12-31 23:59:59"]),
    (3, ["2024-03-10 02:30:00.000", "2024-03-10 02:30:00.170", "1969-12-31 23:59:59.999"]),
    (6, ["2024-03-10 02:30:00.000000", "2024-03-10 02:30:00.170000", "1969-12-31 23:59:59.999999"]),
])
def test_datetimes(spark, zone, digits, want):
    # half past two does not exist on that day in New York
    df = spark.createDataFrame([("2024-03-10 02:30:00",), ("2024-03-10 02:30:00.17",), ("1969-12-31 23:59:59.999999",)], "s string")
    df = df.select(F.col("s").cast("timestamp_ntz").alias("ts"))
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = [r[0] for r in df.select(row_text(TableSpec.of(df, "t", datetime_digits=digits))).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == want


def test_other_types(spark):
    df = spark.createDataFrame([(True, bytearray(b"\x00\xff"), 1e7, None)], "b boolean, bin binary, d double, n int")
    spec = TableSpec.of(df, "t", scales={"d": 2})
    assert df.select(row_text(spec)).first()[0] == "1|00FF|10000000.00|NULL"


def test_floats_need_a_scale():
    schema = T.StructType([T.StructField("d", T.DoubleType())])
    with pytest.raises(ValueError, match="scale"):
        row_text(TableSpec("t", schema))
