"""Density-aware chunk arithmetic on primary keys.

A slice spans ``max - min + 1`` keys of which ``n`` exist. Chunks are equally wide key ranges
that hold about ``chunk_size`` rows if the density is even. Keys are 64-bit; the width of a slice
may need one bit more, and such ``wide`` slices use decimals. So do all slices of a plan that has unsigned
keys: its ``kind`` of key is then a decimal of 20 digits from end to end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INT64_MAX = 2**63 - 1
KEY = "bigint"
WIDE = "decimal(20,0)"


def key_range(min_pk: Column, max_pk: Column) -> Column:
    return max_pk.cast(WIDE) - min_pk.cast(WIDE) + F.lit(1)


def is_wide(min_pk: Column, max_pk: Column) -> Column:
    return key_range(min_pk, max_pk) > F.lit(INT64_MAX)


def step_width(min_pk: Column, max_pk: Column, rows: Column, chunk_size: int) -> Column:
    """Keys per chunk. The order of the two divisions matters for the last bit."""
    density = rows.cast("double") / key_range(min_pk, max_pk).cast("double")
    return F.greatest(F.lit(1).cast(KEY), F.ceil(F.lit(float(chunk_size)) / density).cast(KEY))


def chunk_count(min_pk: Column, max_pk: Column, step: Column) -> Column:
    """Chunks of a slice, in whole numbers: a quotient's digits are cut, so a short last chunk could be lost."""
    before_last, width = key_range(min_pk, max_pk) - F.lit(1), step.cast(WIDE)
    full = (before_last - F.pmod(before_last, width)) / width  # divides without a rest
    return (full + F.lit(1)).cast(KEY)


def key_kind(df: DataFrame, column: str = "min_pk") -> str:
    """The type of a plan's keys: ``KEY``, or ``WIDE`` if any of its tables has unsigned keys."""
    return KEY if df.schema[column].dataType.simpleString() == KEY else WIDE


def nth_start(min_pk: Column, step: Column, i: Column, wide: Column, kind: str = KEY) -> Column:
    wide_start = (min_pk.cast(WIDE) + i.cast(WIDE) * step.cast(WIDE)).cast(kind)
    return wide_start if kind == WIDE else F.when(wide, wide_start).otherwise(min_pk + i * step)


def end_of(start: Column, max_pk: Column, step: Column, wide: Column, kind: str = KEY) -> Column:
    """Last key of the chunk, clipped to the slice."""
    wide_end = F.least(start.cast(WIDE) + step.cast(WIDE) - F.lit(1), max_pk.cast(WIDE)).cast(kind)
    return wide_end if kind == WIDE else F.when(wide, wide_end).otherwise(start + F.least(step - F.lit(1), max_pk - start))


def number_of(pk: Column, min_pk: Column, step: Column, wide: Column, kind: str = KEY) -> Column:
    """Number of the chunk a key of the slice belongs to. Only a ``wide`` slice divides decimals, which costs several times as much."""
    far = F.call_function("div", pk.cast(WIDE) - min_pk.cast(WIDE), step.cast(WIDE)).cast(KEY)
    near = F.call_function("div", (pk - min_pk).cast(KEY) if kind == WIDE else pk - min_pk, step)
    return F.when(wide, far).otherwise(near)


def start_of(pk: Column, min_pk: Column, step: Column, wide: Column, kind: str = KEY) -> Column:
    """First key of the chunk a row belongs to; arithmetic, so no range join is needed."""
    offset = pk.cast(WIDE) - min_pk.cast(WIDE)
    wide_start = (pk.cast(WIDE) - F.pmod(offset, step.cast(WIDE))).cast(kind)
    return wide_start if kind == WIDE else F.when(wide, wide_start).otherwise(pk - F.pmod(pk - min_pk, step))
