"""Table names, globs and target scopes."""

from __future__ import annotations

import fnmatch

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: System schemas that catalog scans leave out; fixed values.
SYSTEM_SCHEMAS = {
    "postgresql": ["pg_catalog", "information_schema"],
    "mssql": [
        "sys", "INFORMATION_SCHEMA", "guest", "db_owner", "db_accessadmin", "db_securityadmin", "db_ddladmin", "db_backupoperator",
        "db_datareader", "db_datawriter", "db_denydatareader", "db_denydatawriter",
    ],
    "sqlite": [],
    "clickhouse": ["system", "INFORMATION_SCHEMA", "information_schema"],
}


def split_name(name: str, default: str = "public") -> tuple[str, str]:
    """FUN-19, DM-1: cut at the first dot."""
    schema, dot, table = name.partition(".")
    return (schema, table) if dot else (default, name)


def schema_of(c: Column, default: str = "public") -> Column:
    return F.when(F.instr(c, ".") > 0, F.substring_index(c, ".", 1)).otherwise(default)


def table_of(c: Column) -> Column:
    return F.regexp_replace(c, r"^[^.]*\.", "")


def glob_match(c: Column, pattern: str) -> Column:
    """FUN-18: shell globs as regular expressions."""
    return c.rlike("^" + fnmatch.translate(pattern).replace("\\z", "$").replace("\\Z", "$").replace("(?>", "(?:"))


def any_glob(c: Column, patterns: list[str]) -> Column:
    out = F.lit(False)
    for p in patterns:
        out = out | glob_match(c, p)
    return out


def included(c: Column, include: list[str] | None = None, exclude: list[str] | None = None) -> Column:
    """FLT-5: the include list first, if there is one, then the exclude list."""
    return (any_glob(c, include) if include else F.lit(True)) & ~any_glob(c, exclude or [])


def scoped(tables: DataFrame, targets: DataFrame) -> DataFrame:
    """FLT-6. tables and targets have db and tbl; a target without tbl takes the whole db, even beside narrower ones;
    targets without db take nothing."""
    named = targets.where("db IS NOT NULL")
    whole = named.where("tbl IS NULL").select("db").distinct()
    wide = tables.join(whole, "db", "left_semi")
    narrow = tables.join(whole, "db", "left_anti").join(named.where("tbl IS NOT NULL").select("db", "tbl").distinct(), ["db", "tbl"], "left_semi")
    return wide.unionByName(narrow)


def user_schemas(df: DataFrame, kind: str, column: str = "schema") -> DataFrame:
    """FLT-7."""
    skip = SYSTEM_SCHEMAS.get(kind, [])
    return df.where(~F.col(column).isin(skip)) if skip else df
