"""Scalar functions over the given tables."""

from pyspark.sql import functions as F

from tenantferry.functions.coordinates import coordinate, is_coordinate_line
from workload import tables as w
from workload.registry import query


@query("fn8_lower", "select lower(o_orderpriority) as priority, count(*)::bigint as n from orders group by 1")
def _(spark, sf):
    return w.given(spark, sf, "orders").groupBy(F.lower("o_orderpriority").alias("priority")).agg(F.count("*").alias("n"))


@query("fn9_concat", "select c_custkey, c_name || '@' || lower(c_mktsegment) || '.example' as email from customer")
def _(spark, sf):
    return w.given(spark, sf, "customer").select(
        "c_custkey", F.concat("c_name", F.lit("@"), F.lower("c_mktsegment"), F.lit(".example")).alias("email")
    )


@query("fn10_add_minutes", "select o_orderkey, o_orderdate + to_minutes(o_custkey * 10) as later from orders")
def _(spark, sf):
    return w.given(spark, sf, "orders").select(
        "o_orderkey", F.timestamp_add("MINUTE", F.col("o_custkey") * 10, "o_orderdate").alias("later")
    )


@query("fn11_pick_by_index", "select event_id, list_extract(['open','click','fill','visit'], (event_id % 4 + 1)::bigint) as kind from events")
def _(spark, sf):
    kinds = [F.lit(k) for k in ("open", "click", "fill", "visit")]
    return w.given(spark, sf, "events").select("event_id", F.elt(F.expr("cast(event_id % 4 + 1 as int)"), *kinds).alias("kind"))


@query("fn12_modulo", "select event_id % 20 as rest, count(*)::bigint as n from events group by 1")
def _(spark, sf):
    return w.given(spark, sf, "events").groupBy((F.col("event_id") % 20).alias("rest")).agg(F.count("*").alias("n"))


@query("fn13_json_object", "select event_id, '{\"kind\":\"' || event_type || '\",\"user\":' || user_id || '}' as payload from events")
def _(spark, sf):
    return w.given(spark, sf, "events").select(
        "event_id", F.to_json(F.named_struct(F.lit("kind"), "event_type", F.lit("user"), "user_id")).alias("payload")
    )


@query("fn14_now", None)
def _(spark, sf):
    return w.given(spark, sf, "customer").select("c_custkey", F.current_timestamp().cast("timestamp_ntz").alias("updated_at"))


@query("fn15_coordinate_parts", "select event_id, 'bin.' || user_id as log_file, event_id as log_pos from events")
def _(spark, sf):
    line = F.concat(
        F.lit("-- CHANGE MASTER TO MASTER_LOG_FILE='bin."), F.col("user_id").cast("string"),
        F.lit("', MASTER_LOG_POS="), F.col("event_id").cast("string"), F.lit(";"),
    )
    lines = w.given(spark, sf, "events").select("event_id", line.alias("value")).where(is_coordinate_line(F.col("value")))
    return lines.select("event_id", coordinate(F.col("value")).alias("at")).select("event_id", "at.*")


@query("fn16_iso_timestamp", "select event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') as last_ts from events")
def _(spark, sf):
    return w.given(spark, sf, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("last_ts"))


@query("fn17_digit_arithmetic", "select event_id, event_id % 10 + event_id // 10 % 10 * 10 + event_id // 100 % 10 * 100 as low_digits from events")
def _(spark, sf):
    digits = "event_id % 10 + event_id div 10 % 10 * 10 + event_id div 100 % 10 * 100"
    return w.given(spark, sf, "events").select("event_id", F.expr(digits).alias("low_digits"))
