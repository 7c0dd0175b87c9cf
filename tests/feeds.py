"""Small feeds and what applying them one event after the other leaves."""

import random

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenantferry.sources.feed import feed_schema
from tenantferry.specs import TableSpec

ROW = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("account_id", T.StringType()), T.StructField("v", T.StringType()),
])
SPECS = {n: TableSpec(n, ROW, ("id",)) for n in ("leads", "activities")}


def event(op, i, before=None, after=None, table="leads", file="b.000001", row_idx=0, schema="src"):
    return (op, schema, table, (file, i, row_idx), before, after)


def random_events(n, keys=40, tenants=3, seed=1):
    """Events in log order; several rows may share an event, keys move between tenants."""
    rnd, out = random.Random(seed), []
    for i in range(n):
        row = (rnd.randrange(keys), f"acc_{rnd.randrange(tenants)}", rnd.choice([None, "x", f"v{i}"]))
        op = rnd.choice("IIUUD")
        table = rnd.choice(list(SPECS))
        pos = {"file": f"b.{i // 100 + 1:06d}", "row_idx": i % 100 % 3}
        out.append(event(op, (i % 100) // 3, row if op == "D" else None, None if op == "D" else row, table, **pos))
    return out


def frame(spark, events):
    return spark.createDataFrame(events, feed_schema(ROW))


def applied(events, start=None, tenants=None, state=None):
    """The events taken one by one: ``{(table, id): row}``."""
    state = dict(state or {})
    for op, schema, table, pos, before, after in events:
        row = before if op == "D" else after
        if schema != "src" or op not in "IUD" or table not in SPECS:
            continue
        if (start and pos <= start) or (tenants and row[1] not in tenants):
            continue
        if op == "D":
            state.pop((table, row[0]), None)
        else:
            state[(table, row[0])] = row
    return state


def content(target):
    out = {}
    for name, df in target.tables().items():
        for r in df.collect():
            assert (name, r.id) not in out, "key twice"
            out[(name, r.id)] = tuple(r)
    return out


def changes_of(spark, events, **kw):
    from tenantferry.sources.feed import tenant_changes
    return tenant_changes(frame(spark, events), SPECS, "src", **kw)
