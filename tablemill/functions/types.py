"""Type mapping between source catalogs, column stores and Spark; value conversion and defaults."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Source type: column-store type. Fixed values.
COLUMN_STORE = {
    "smallint": "Int16", "integer": "Int32", "bigint": "Int64", "real": "Float32", "double precision": "Float64",
    "boolean": "UInt8", "character varying": "String", "varchar": "String", "character": "String", "char": "String", "text": "String",
    "bytea": "String", "date": "Date", "timestamp without time zone": "DateTime64(6)", "timestamp with time zone": "DateTime64(6, 'UTC')",
    "time without time zone": "String", "time with time zone": "String", "interval": "String", "json": "String", "jsonb": "String",
    "uuid": "UUID", "inet": "String", "cidr": "String", "macaddr": "String", "money": "Decimal(18, 4)",
}
#: Column-store type: Spark type.
SPARK = {
    "Int8": T.ByteType(), "UInt8": T.ShortType(), "Int16": T.ShortType(), "UInt16": T.IntegerType(), "Int32": T.IntegerType(), "UInt32": T.LongType(),
    "Int64": T.LongType(), "UInt64": T.DecimalType(20, 0), "Float32": T.FloatType(), "Float64": T.DoubleType(), "String": T.StringType(),
    "UUID": T.StringType(), "Date": T.DateType(), "Date32": T.DateType(), "DateTime": T.TimestampNTZType(), "Bool": T.BooleanType(),
}
#: Defaults of columns that take no nulls. Fixed values.
ZERO_UUID, EPOCH_DATE, EPOCH = "00000000-0000-0000-0000-000000000000", "1970-01-01", "1970-01-01 00:00:00"
#: Timestamp column types by kind of database. Fixed values.
STAMP = {"clickhouse": "DateTime64(3)", "mssql": "DATETIME2", "postgresql": "TIMESTAMP", "sqlite": "TIMESTAMP"}
#: Array types by element. Fixed values.
ARRAYS = {
    "_bool": "boolean[]", "_int2": "smallint[]", "_int4": "integer[]", "_int8": "bigint[]", "_float4": "real[]", "_float8": "double precision[]",
    "_numeric": "numeric[]", "_text": "text[]", "_varchar": "character varying[]", "_char": "character[]", "_uuid": "uuid[]", "_date": "date[]",
    "_timestamp": "timestamp without time zone[]", "_timestamptz": "timestamp with time zone[]", "_json": "json[]", "_jsonb": "jsonb[]", "_inet": "inet[]",
}


def column_store_type(source: str, *, nullable: bool = False, precision: int | None = None, scale: int | None = None) -> str:
    """FUN-4. A scale of 0 is kept (Q1)."""
    kind = source.lower()
    out = f"Decimal({18 if precision is None else precision}, {4 if scale is None else scale})" if kind == "numeric" else COLUMN_STORE.get(kind, "String")
    return f"Nullable({out})" if nullable else out


def unwrap(kind: str) -> str:
    """FUN-4: what stands inside Nullable and LowCardinality."""
    while m := re.fullmatch(r"(?:Nullable|LowCardinality)\((.*)\)", kind.strip()):
        kind = m[1]
    return kind.strip()


def source_type(col: dict) -> str:
    """FUN-5: a catalog row's type with its modifiers."""
    kind = col["pg_type"].lower()
    if kind in ("character varying", "character") and col.get("max_length"):
        return f"{kind}({col['max_length']})"
    if kind == "numeric" and col.get("precision") is not None:
        return f"numeric({col['precision']}" + (f",{col['scale']})" if col.get("scale") is not None else ")")
    if kind == "array":
        return ARRAYS.get(col.get("udt_name") or "", "text[]")
    return "text" if kind == "user-defined" else col["pg_type"]


def spark_type(kind: str) -> T.DataType:
    kind = unwrap(kind)
    if m := re.fullmatch(r"Decimal\((\d+)\s*,\s*(\d+)\)", kind):
        return T.DecimalType(int(m[1]), int(m[2]))
    if kind.startswith("DateTime64") or kind.startswith("DateTime("):
        return T.TimestampType() if "'" in kind else T.TimestampNTZType()
    return SPARK.get(kind, T.StringType())


def convert(c: Column, have: T.DataType, kind: str) -> Column:
    """FUN-6, FUN-7, UDF-3: a value for the target type. Text that is no number raises under ANSI rules, as a copy must."""
    want = spark_type(kind)
    if isinstance(want, T.StringType):
        if isinstance(have, T.BinaryType):
            return F.lower(F.hex(c))
        if isinstance(have, (T.StructType, T.ArrayType, T.MapType)):
            return F.to_json(c)
        return c.cast("string")
    if isinstance(have, (T.DoubleType, T.FloatType, T.DecimalType)) and isinstance(want, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return c.cast(want)  # toward zero
    return c.cast(want)


def default_of(kind: str) -> Column:
    """FUN-8."""
    kind, want = unwrap(kind), spark_type(kind)
    if kind == "UUID":
        return F.lit(ZERO_UUID)
    if isinstance(want, T.StringType):
        return F.lit("")
    if isinstance(want, T.DateType):
        return F.lit(EPOCH_DATE).cast("date")
    if isinstance(want, (T.TimestampType, T.TimestampNTZType)):
        return F.lit(EPOCH).cast(want)
    return F.lit(False) if isinstance(want, T.BooleanType) else F.lit(0).cast(want)


def coerce(c: Column, have: T.DataType, kind: str, *, nullable: bool) -> Column:
    """FUN-8: nulls become the default, after the conversion, where the target takes none."""
    out = convert(c, have, kind)
    return out if nullable or kind.strip().startswith("Nullable") else F.coalesce(out, default_of(kind))
