"""Table creation and constraints: definitions by kind of database, NOT NULL and key checks, a declared catalog."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablemill.functions.types import STAMP
from tablemill.operators.sync import STRATEGIES, duplicates
from tablemill.plans.store import TableStore

#: What a write of a strategy is in each kind of database; a kind that is not named inserts.
UPSERT_AS = {"postgresql": "upsert", "sqlite": "replace"}


def dialect_strategy(kind: str, strategy: str) -> str:
    """SNK-6: column stores and others take an upsert as a plain insert."""
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy {strategy!r}")
    return UPSERT_AS.get(kind, "insert") if strategy == "upsert" else strategy


def definition(kind: str, table: str, columns: dict[str, str], *, required: list[str] = (), key: list[str] = (), order_by: list[str] = (), partition_by: str | None = None, engine: str = "MergeTree", stamp: str | None = None) -> str:
    """SNK-11, SNK-12, SNK-14: a statement that creates the table if it is absent. A stamp column takes the kind's type."""
    cols = columns | ({stamp: STAMP.get(kind, "TIMESTAMP")} if stamp else {})
    inside = [f'"{n}" {t}{" NOT NULL" if n in required else ""}' for n, t in cols.items()]
    if key and kind != "clickhouse":
        inside.append("UNIQUE (" + ", ".join(f'"{k}"' for k in key) + ")")
    body = f"{table} ({', '.join(inside)})"
    if kind == "mssql":  # it has no IF NOT EXISTS
        return f"IF OBJECT_ID('{table}') IS NULL CREATE TABLE {body}"
    tail = ""
    if kind == "clickhouse":
        tail = f" ENGINE = {engine} ORDER BY " + (f"({', '.join(order_by)})" if order_by else "tuple()") + (f" PARTITION BY {partition_by}" if partition_by else "")
    return f"CREATE TABLE IF NOT EXISTS {body}{tail}"


def ensure(store: TableStore, table: str, schema: str, partition_by: list[str] = ()) -> bool:
    """SNK-11, SNK-14 in the store: an empty table, if there is none. Whether it was made."""
    if store.manifest(table) is not None:
        return False
    store.commit(table, store.spark.createDataFrame([], schema), partition_by=partition_by)
    return True


def missing_values(df: DataFrame, required: list[str]) -> DataFrame:
    """SNK-12: a row a required column that holds nulls, with their number, from one scan."""
    one = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{k}") for k, c in enumerate(required)])
    return one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("col"), F.col(f"n{k}").alias("nulls")) for k, c in enumerate(required)])).alias("x")).select("x.*").where("nulls > 0")


def violations(tables: dict[tuple[str, str], DataFrame], declared: list[dict]) -> DataFrame:
    """SNK-12, SNK-13: each declared constraint (db, tbl, kind not_null or unique, cols) with the rows that break it: nulls,
    or keys that stand more than once. Null keys are apart, as in SQL."""
    out = []
    for c in declared:
        df, cols = tables[c["db"], c["tbl"]], c["cols"]
        if c["kind"] == "unique":
            bad = duplicates(df.dropna(subset=cols), cols).agg(F.count("*").alias("bad"))
        elif c["kind"] == "not_null":
            bad = df.where(reduce(lambda a, b: a | b, [F.col(f"`{x}`").isNull() for x in cols])).agg(F.count("*").alias("bad"))
        else:
            raise ValueError(f"unknown constraint {c['kind']!r}")
        out.append(bad.select(F.lit(c["db"]).alias("db"), F.lit(c["tbl"]).alias("tbl"), F.lit(c["kind"]).alias("kind"), F.lit(",".join(cols)).alias("cols"), "bad"))
    return reduce(DataFrame.unionByName, out)


def catalog(spark: SparkSession, declared: list[dict]) -> DataFrame:
    """SRC-11, SNK-13: declared keys, indexes and references as rows: db, tbl, kind (pk, index, fk), name, cols, and for
    fk the table and columns they refer to."""
    rows = [(c["db"], c["tbl"], c["kind"], c.get("name"), c["cols"], c.get("ref_tbl"), c.get("ref_cols")) for c in declared]
    return spark.createDataFrame(rows, "db string, tbl string, kind string, name string, cols array<string>, ref_tbl string, ref_cols array<string>")
