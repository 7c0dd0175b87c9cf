"""Declared table metadata. Spark does not enforce keys, so they are declared here."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What readers make of an unsigned 64-bit column.
UNSIGNED = T.DecimalType(20, 0)


@dataclass(frozen=True)
class TableSpec:
    """One source table.

    ``scales`` gives the decimal scale under which float columns are compared and
    ``datetime_digits`` the number of fractional-second digits (MySQL DATETIME: 0). Text columns in ``json``
    are compared as documents, whatever the order of their keys and their spacing.

    ``hashed`` cuts the table by a hash of its whole key, so that tables with a composite or a text key
    have chunks too.

    ``any_case`` makes tenants that differ in case one: plans, ledgers, reports and progress name it in lower case, while
    rows keep what they hold. All tables of a plan or feed must agree in it. A source can't skip data by such a tenant.
    """

    name: str
    schema: T.StructType
    pk: tuple[str, ...] = ()
    tenant_col: str = "account_id"
    database: str = "src"
    table_type: str = "BASE TABLE"
    scales: Mapping[str, int] = field(default_factory=dict)
    datetime_digits: int = 6
    json: tuple[str, ...] = ()
    hashed: bool = False
    any_case: bool = False

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def has_tenant(self) -> bool:
        return self.tenant_col in self.columns

    def tenant_of(self, value: Column) -> Column:
        """The tenant that a value of the tenant column names."""
        return F.lower(value) if self.any_case else value

    @property
    def tenant(self) -> Column:
        return self.tenant_of(F.col(self.tenant_col))

    def is_one_of(self, value: Column, tenants: Iterable) -> Column:
        return self.tenant_of(value).isin([self.tenant_of(F.lit(t)) for t in tenants])

    @property
    def unsigned(self) -> bool:
        """Whether the key is one unsigned 64-bit column, which Spark holds as a decimal."""
        return not self.hashed and len(self.pk) == 1 and self.schema[self.pk[0]].dataType == UNSIGNED

    def key_bound(self, key: int) -> int | Decimal:
        """A key as a literal of the key column's type, so that scans can skip by it."""
        return Decimal(int(key)) if self.unsigned else int(key)

    @property
    def chunk_key(self) -> Column:
        """The whole number by which rows fall into chunks: the key's one column, or the hash of all."""
        if not self.hashed:
            return F.col(self.pk[0]).cast(UNSIGNED.simpleString() if self.unsigned else "bigint")
        texts = [F.col(c).cast("string") for c in self.pk]
        sized = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("~")) for t in texts]
        # ten hexadecimal digits: the same number wherever it is computed
        return F.conv(F.substring(F.md5(F.concat(*sized).cast("binary")), 1, 10), 16, 10).cast("bigint")

    @property
    def chunk_key_name(self) -> str:
        return f"hash({', '.join(self.pk)})" if self.hashed else self.pk[0]

    @classmethod
    def of(cls, df: DataFrame, name: str, pk: Iterable[str] = (), **kw) -> TableSpec:
        return cls(name=name, schema=df.schema, pk=tuple(pk), **kw)


def ordered(df: DataFrame, spec: TableSpec) -> DataFrame:
    """All columns of the table in ordinal order, whatever order the reader gave."""
    return df.select(*spec.columns)


def duplicate_keys(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Keys held by more than one row; empty for a table that honours its key."""
    return df.groupBy(*spec.pk).agg(F.count("*").alias("n")).where("n > 1")


def any_case(specs: Iterable[TableSpec]) -> bool:
    """Whether the tables take tenants in any case; they must agree."""
    found = {s.any_case for s in specs}
    if len(found) > 1:
        raise ValueError("the tables must agree on any_case")
    return found == {True}


def union_schema(specs: Iterable[TableSpec]) -> T.StructType:
    """Columns of all tables together, the row shape of a feed that carries several."""
    fields: dict[str, T.StructField] = {}
    for spec in specs:
        for f in spec.schema.fields:
            known = fields.setdefault(f.name, T.StructField(f.name, f.dataType, True))
            if known.dataType != f.dataType:
                raise ValueError(
                    f"column {f.name} has types {known.dataType} and {f.dataType} in one feed"
                )
    return T.StructType(list(fields.values()))
