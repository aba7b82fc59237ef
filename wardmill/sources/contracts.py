"""Schema contracts: what a table is declared to look like, how a frame differs from it, and frames made to fit.

A contract is a table's columns with their types, in order. Contracts live in one table beside the warehouse (table,
position, column, type), so a writer on any machine sees the same ones. A difference is of one of these classes:

  missing    a declared column that the frame does not have
  extra      a column that is not declared
  widening   another type whose every value the declared type holds
  narrowing  another type, some of whose values the declared type may not hold
  failing    a narrowing for which a value of this frame is lost: it becomes null or another value

The writer takes widening in its stride, adds missing columns as nulls or drops extra ones only where it is told to, and
looks at the values before it narrows.
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLE = "table string, position int, column string, type string"
#: Each type holds every value of those before it.
WHOLE = ("tinyint", "smallint", "int", "bigint")


class Drift(NamedTuple):
    kind: str
    column: str
    have: str | None
    want: str | None
    rows: int | None = None

    def __str__(self) -> str:
        told = {"missing": f"{self.column} {self.want} is missing", "extra": f"{self.column} {self.have} is unexpected"}
        lost = f" ({self.rows} rows)" if self.rows is not None else ""
        return told.get(self.kind, f"{self.column} is {self.have}, declared {self.want}: {self.kind}{lost}")


class ContractError(ValueError):
    def __init__(self, table: str, drifts: list[Drift]):
        super().__init__(f"{table}: " + "; ".join(map(str, drifts)))
        self.drifts = drifts


def _digits(t: T.DataType) -> tuple[int, int] | None:
    """Digits before and after the point that a whole or decimal type holds."""
    if isinstance(t, T.DecimalType):
        return t.precision - t.scale, t.scale
    return {"tinyint": (3, 0), "smallint": (5, 0), "int": (10, 0), "bigint": (19, 0)}.get(t.simpleString())


def holds(want: T.DataType, have: T.DataType) -> bool:
    """Whether ``want`` holds every value of ``have``."""
    w, h = want.simpleString(), have.simpleString()
    if w == h or h == "void":
        return True
    if w == "string":
        return isinstance(have, (T.AtomicType, T.NumericType)) and h != "binary"
    if h in WHOLE and w in WHOLE:
        return WHOLE.index(h) <= WHOLE.index(w)
    if isinstance(want, T.DecimalType) and _digits(have):
        return _digits(have)[0] <= _digits(want)[0] and _digits(have)[1] <= _digits(want)[1]
    if w == "double":
        return h == "float" or h in WHOLE[:3]
    if w == "float":
        return h in WHOLE[:2]
    return h == "date" and w in ("timestamp", "timestamp_ntz")


def drifts(df: DataFrame, contract: T.StructType) -> list[Drift]:
    """Differences that the schemas alone show."""
    have = {f.name: f.dataType for f in df.schema.fields}
    want = {f.name: f.dataType for f in contract.fields}
    out = [Drift("missing", c, None, t.simpleString()) for c, t in want.items() if c not in have]
    out += [Drift("extra", c, t.simpleString(), None) for c, t in have.items() if c not in want]
    for c, t in want.items():
        if c in have and have[c].simpleString() != t.simpleString():
            kind = "widening" if holds(t, have[c]) else "narrowing"
            out.append(Drift(kind, c, have[c].simpleString(), t.simpleString()))
    return out


def _lost(column: str, have: T.DataType, want: T.DataType) -> Column:
    """Whether a value does not come through the cast: gone, or not the same when cast back."""
    v = F.col(column)
    there = v.try_cast(want)
    back = there.try_cast(have)
    same = F.coalesce(back == v, F.lit(False))
    if isinstance(have, T.StringType):
        # text may be written in several ways; that it can be read is what counts
        same = there.isNotNull()
    return v.isNotNull() & ~same


def failing(df: DataFrame, contract: T.StructType, found: list[Drift] | None = None) -> list[Drift]:
    """The narrowings for which values of ``df`` are lost, with the number of rows: one aggregate over those columns."""
    narrow = [d for d in (drifts(df, contract) if found is None else found) if d.kind == "narrowing"]
    if not narrow:
        return []
    have, want = ({f.name: f.dataType for f in s.fields} for s in (df.schema, contract))
    row = df.agg(*[F.count(F.when(_lost(d.column, have[d.column], want[d.column]), 1)).alias(f"n{i}") for i, d in enumerate(narrow)]).first()
    return [d._replace(kind="failing", rows=row[f"n{i}"]) for i, d in enumerate(narrow) if row[f"n{i}"]]


def fitted(df: DataFrame, contract: T.StructType, table: str = "table", add_missing: bool = False, drop_extra: bool = False, narrow: bool = True) -> DataFrame:
    """``df`` in the contract's columns, order and types; a ContractError names what stands against it.

    ``add_missing``: declared columns that are not there become nulls. ``drop_extra``: others go. ``narrow``: a
    narrowing is taken if no value of ``df`` is lost by it, which reads the data once; else any narrowing is an error.
    """
    found = drifts(df, contract)
    allowed = {"widening"} | ({"missing"} if add_missing else set()) | ({"extra"} if drop_extra else set()) | ({"narrowing"} if narrow else set())
    wrong = [d for d in found if d.kind not in allowed]
    if not wrong and narrow:
        wrong = failing(df, contract, found)
    if wrong:
        raise ContractError(table, wrong)
    have = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in have else F.lit(None)).try_cast(f.dataType).alias(f.name) for f in contract.fields])


class Contracts:
    """The declared tables."""

    def __init__(self, schemas: dict[str, T.StructType] | None = None):
        self.schemas = dict(schemas or {})

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> Contracts:
        """From the table at ``path``; its size is that of the declared columns."""
        rows = spark.read.schema(TABLE).parquet(path).orderBy("table", "position").collect()
        out = cls()
        for r in rows:
            field = T.StructType.fromDDL(f"c {r['type']}").fields[0]
            out.schemas.setdefault(r["table"], T.StructType()).add(r["column"], field.dataType)
        return out

    def write(self, spark: SparkSession, path: str) -> None:
        rows = [(t, i, f.name, f.dataType.simpleString()) for t, s in sorted(self.schemas.items()) for i, f in enumerate(s.fields)]
        spark.createDataFrame(rows, TABLE).coalesce(1).write.mode("overwrite").parquet(path)

    def declare(self, table: str, schema: T.StructType | str) -> None:
        """``schema`` as a struct or in DDL, such as ``a int, b string``; declared again it must be the same."""
        new = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        new = T.StructType([T.StructField(f.name, f.dataType) for f in new.fields])
        if table in self.schemas and self.schemas[table] != new:
            raise ValueError(f"{table} is declared otherwise")
        self.schemas[table] = new

    def replace(self, table: str, schema: T.StructType | str) -> None:
        self.schemas.pop(table, None)
        self.declare(table, schema)

    def fitted(self, df: DataFrame, table: str, **options) -> DataFrame:
        if table not in self.schemas:
            raise KeyError(f"no contract for {table}")
        return fitted(df, self.schemas[table], table, **options)

    def report(self, frames: dict[str, DataFrame], tables: Iterable[str] | None = None) -> list[tuple[str, Drift]]:
        """Differences of many frames by table, without reading their data."""
        return [(t, d) for t in (tables or frames) for d in drifts(frames[t], self.schemas[t])]
