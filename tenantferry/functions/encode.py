"""Row text for checksums: every column to a fixed text form, joined by a pipe."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenantferry.specs import TableSpec

NULL_TEXT = "NULL"
SEPARATOR = "|"


# fixed values: names of the time zone without gaps
UTC = ("UTC", "Etc/UTC", "GMT", "Z", "+00:00")


def _datetime_text(c: Column, digits: int) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` plus a fixed number of fraction digits (0 to 6)."""
    session = SparkSession.getActiveSession()
    if session and session.conf.get("spark.sql.session.timeZone") in UTC:
        return F.date_format(c, "yyyy-MM-dd HH:mm:ss" + ("." + "S" * digits if digits else ""))
    # date_format would shift zone-less times that the session's zone skips; this does not, but is
    # slower: the cast drops trailing zeros of the fraction, and its point if nothing is left of it
    text = c.cast("string")
    fixed = F.overlay(F.rpad(text, 26, "0"), F.lit("."), 20, 1)
    return F.substring(fixed, 1, 20 + digits if digits else 19)


def column_text(spec: TableSpec, name: str) -> Column:
    """Text of one column; NULL stays NULL."""
    kind = spec.schema[name].dataType
    c = F.col(name)
    if isinstance(kind, T.BooleanType):
        return c.cast("int").cast("string")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        if name not in spec.scales:
            raise ValueError(f"{spec.name}.{name} is a float: declare its scale in TableSpec.scales")
        return c.cast(T.DecimalType(38, spec.scales[name])).cast("string")
    if isinstance(kind, T.BinaryType):
        return F.hex(c)
    if isinstance(kind, (T.TimestampNTZType, T.TimestampType)):
        return _datetime_text(c, spec.datetime_digits)
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(c)
    if name in spec.json:
        # a variant keeps an object's keys in order; text that is no document stays as it is
        return F.coalesce(F.to_json(F.try_parse_json(c)), c)
    return c.cast("string")


def row_text(spec: TableSpec) -> Column:
    """Text of the whole row with NULL written as four letters."""
    return F.concat_ws(
        SEPARATOR, *[F.coalesce(column_text(spec, c), F.lit(NULL_TEXT)) for c in spec.columns]
    )


def tagged_row_text(spec: TableSpec) -> Column:
    """Unambiguous row text: each value carries its length, and NULL has a tag of its own."""
    parts = []
    for name in spec.columns:
        text = column_text(spec, name)
        sized = F.concat(F.length(text).cast("string"), F.lit(":"), text)
        parts.append(F.coalesce(sized, F.lit("~")))
    return F.concat_ws(",", *parts)
