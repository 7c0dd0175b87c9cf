"""Fixture rows for the two chunkable tables, from row counts per tenant, and the schema of the composite-key one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values
ACTIVITY_TYPES = ("email_open", "email_click", "form_fill", "web_visit")

LEADS = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("account_id", T.StringType()),
    T.StructField("email", T.StringType()), T.StructField("created_at", T.TimestampNTZType()),
])
ACTIVITIES = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("account_id", T.StringType()),
    T.StructField("lead_id", T.LongType()), T.StructField("activity_type", T.StringType()),
    T.StructField("payload", T.StringType()), T.StructField("created_at", T.TimestampNTZType()),
])
PREFERENCES = T.StructType([
    T.StructField("account_id", T.StringType()), T.StructField("email", T.StringType()),
    T.StructField("preference_type", T.StringType()), T.StructField("value", T.StringType()),
    T.StructField("updated_at", T.TimestampNTZType()),
])

BLOCK = 16_384


def numbered_rows(counts: DataFrame) -> DataFrame:
    """``n`` rows per input row, numbered from 0 in ``seq``, in two steps as for chunks.

    Stands in for the cross join of digit tables that databases without a row generator need.
    """
    tasks = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [c for c in counts.columns if c != "n"]
    block = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("n") - 1) / BLOCK)))
    blocks = counts.where("n > 0").withColumn("block_no", block).repartition(tasks, *keys, "block_no")
    first = F.col("block_no") * BLOCK
    last = F.least(F.col("n"), first + F.lit(BLOCK)) - 1
    return blocks.withColumn("seq", F.explode(F.sequence(first, last))).drop("block_no")


def minutes_after(start: str, minutes: Column) -> Column:
    return F.timestamp_add("MINUTE", minutes, F.lit(start).cast("timestamp_ntz"))


def leads(counts: DataFrame, start: str = "2022-01-01 00:00:00") -> DataFrame:
    """Leads of each tenant in ``counts(account_id, first_id, n)``, ten minutes apart."""
    seq = F.col("seq")
    email = F.concat(F.lit("lead_"), (seq + 1).cast("string"), F.lit("@"), F.replace("account_id", F.lit("_"), F.lit("")), F.lit(".example"))
    return numbered_rows(counts).select(
        (F.col("first_id") + seq).alias("id"), "account_id", email.alias("email"),
        minutes_after(start, seq * 10).alias("created_at"),
    )


def activities(counts: DataFrame, campaigns: int = 20, start: str = "2022-01-01 00:00:00") -> DataFrame:
    """One activity per lead, its kind, campaign and score taken in turn, eleven minutes apart."""
    seq = F.col("seq")
    kind = F.elt((seq % 4 + 1).cast("int"), *[F.lit(k) for k in ACTIVITY_TYPES])
    payload = F.to_json(F.named_struct(
        F.lit("campaign"), F.concat(F.lit("camp_"), (seq % campaigns).cast("string")), F.lit("score"), seq % 100,
    ))
    return numbered_rows(counts).select(
        (F.col("first_id") + seq).alias("id"), "account_id", (F.col("first_id") + seq).alias("lead_id"),
        kind.alias("activity_type"), payload.alias("payload"),
        minutes_after(start, seq * 11).alias("created_at"),
    )
