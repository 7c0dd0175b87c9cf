"""Order-independent checksums of a set of rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tenantferry.functions.encode import row_text, tagged_row_text
from tenantferry.specs import TableSpec


def xor_of_crc32(text: Column) -> Column:
    """XOR fold of CRC32 over the UTF-8 bytes of row texts; 0 for no rows."""
    return F.coalesce(F.bit_xor(F.crc32(text.cast("binary"))), F.lit(0).cast("bigint"))


def compat_checksum(spec: TableSpec) -> Column:
    return xor_of_crc32(row_text(spec))


def strong_checksum(spec: TableSpec) -> Column:
    """64-bit hash folded by XOR and by sum, so that pairs of equal rows do not cancel.

    The sum is a decimal: it cannot overflow below 10^18 rows.
    """
    h = F.xxhash64(tagged_row_text(spec))
    xor = F.coalesce(F.bit_xor(h), F.lit(0).cast("bigint"))
    total = F.coalesce(F.sum(h.cast("decimal(20,0)")), F.lit(0).cast("decimal(30,0)"))
    return F.concat_ws(":", xor.cast("string"), total.cast("string"))


CHECKSUMS = {"compat": compat_checksum, "strong": strong_checksum}


def no_rows(mode: str) -> Column:
    """What the checksum of an empty slice is."""
    return F.lit(0).cast("bigint") if mode == "compat" else F.lit("0:0")
