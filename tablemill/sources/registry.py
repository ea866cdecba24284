"""Database registry and readers (SRC-1 to SRC-9, SRC-21, SET-8, DM-12)."""

from __future__ import annotations

import base64
import json
import os
import re
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Default ports, fixed values.
PORTS = {"postgresql": 5432, "mssql": 1433, "clickhouse": 8123}
DRIVERS = {"postgresql": "org.postgresql.Driver", "mssql": "com.microsoft.sqlserver.jdbc.SQLServerDriver", "clickhouse": "com.clickhouse.jdbc.ClickHouseDriver", "sqlite": "org.sqlite.JDBC"}
REQUIRED = {"sqlite": ("id", "host")}


def expand_env(value: str) -> str:
    """SRC-21: ${VAR}; an unknown name stays as it is."""
    return re.sub(r"\$\{(\w+)\}", lambda m: os.environ.get(m[1], m[0]), value)


class Registry:
    """Databases by id, in a JSON file; passwords are stored in base64 under _enc."""

    def __init__(self, path: str | Path):
        self.path = Path(path)

    def load(self) -> list[dict]:
        if not self.path.exists():
            return []
        out = json.loads(self.path.read_text())
        for db in out:
            if db.get("_enc") == "b64":
                db["password"] = base64.b64decode(db.get("password", "")).decode()
                del db["_enc"]
        return out

    def get(self, db_id: str) -> dict | None:
        return next((d for d in self.load() if d["id"] == db_id), None)

    def save(self, dbs: list[dict]) -> None:
        hidden = [d | {"password": base64.b64encode(d["password"].encode()).decode(), "_enc": "b64"} if d.get("password") else d for d in dbs]
        fresh = self.path.with_suffix(".new")
        fresh.write_text(json.dumps(hidden, indent=2))
        fresh.replace(self.path)

    def add(self, db: dict) -> None:
        if db.get("type") == "sqlite" and not db.get("host") and db.get("dbname"):
            db = db | {"host": db["dbname"]}
        missing = [k for k in REQUIRED.get(db.get("type", ""), ("id", "host", "dbname")) if not db.get(k)]
        if missing:
            raise ValueError("missing: " + ", ".join(missing))
        dbs = self.load()
        if any(d["id"] == db["id"] for d in dbs):
            raise KeyError(f"{db['id']} exists")
        self.save([*dbs, {"port": PORTS.get(db.get("type", "postgresql"))} | db])

    def update(self, db_id: str, **change) -> None:
        dbs = self.load()
        if all(d["id"] != db_id for d in dbs):
            raise KeyError(db_id)
        self.save([d | change if d["id"] == db_id else d for d in dbs])

    def remove(self, db_id: str) -> None:
        self.save([d for d in self.load() if d["id"] != db_id])

    def reorder(self, ids: list[str]) -> None:
        at = {x: k for k, x in enumerate(ids)}
        self.save([d | ({"canvas_order": at[d["id"]]} if d["id"] in at else {}) for d in self.load()])


def url(db: dict) -> str:
    """SRC-3. An sqlite database's file is its host (or, in older entries, its dbname)."""
    kind = db["type"]
    if kind == "sqlite":
        return f"jdbc:sqlite:{db.get('host') or db['dbname']}"
    if kind not in PORTS:
        raise ValueError(f"unknown database type {kind!r}")
    at = f"{db.get('host', 'localhost')}:{db.get('port') or PORTS[kind]}"
    return f"jdbc:sqlserver://{at};databaseName={db['dbname']}" if kind == "mssql" else f"jdbc:{kind}://{at}/{db['dbname']}"


def read(spark: SparkSession, db: dict, table: str, *, key: str | None = None, bounds: tuple | None = None, parts: int = 64, fetch: int = 10_000) -> DataFrame:
    """SRC-4 to SRC-9: a table, split by a numeric key if bounds are given. `parquet` databases are folders of tables.

    Column pruning and filters on the result reach the database or the files.
    """
    if db["type"] == "parquet":
        return spark.read.parquet(f"{db['dbname']}/{table}.parquet")
    reader = spark.read.format("jdbc").options(url=url(db), driver=DRIVERS[db["type"]], dbtable=table, user=db.get("user", ""), password=db.get("password", ""), fetchsize=str(fetch))
    if key and bounds:
        reader = reader.options(partitionColumn=key, lowerBound=str(bounds[0]), upperBound=str(bounds[1]), numPartitions=str(parts))
    return reader.load()


def read_sql(spark: SparkSession, db: dict, sql: str, params: dict, *, order_by: str | None = None, fetch: int = 10_000) -> DataFrame:
    """SRC-9, SRT-1: a query with :name parameters. A `parquet` database's tables are named in db["tables"] and bound by
    Spark itself; of others the values are put in as literals. `order_by` sorts each partition: a total order costs an
    exchange and no merge needs it."""
    if db["type"] == "parquet":
        for t in db.get("tables", []):
            read(spark, db, t).createOrReplaceTempView(t)
        out = spark.sql(sql, args=params)
    else:
        text = re.sub(r"'(?:[^']|'')*'|(?<![:\w]):([A-Za-z_]\w*)", lambda m: m[0] if m[1] is None or m[1] not in params else literal(params[m[1]]), sql)
        out = spark.read.format("jdbc").options(url=url(db), driver=DRIVERS[db["type"]], query=text, user=db.get("user", ""), password=db.get("password", ""), fetchsize=str(fetch)).load()
    return out.sortWithinPartitions(order_by) if order_by else out


def literal(value) -> str:
    """A value as SQL text."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    return str(value) if isinstance(value, (int, float)) else "'" + str(value).replace("'", "''") + "'"


def probe(spark: SparkSession, dbs: list[dict], reader=read) -> list[dict]:
    """SRC-19: status, latency in ms with one decimal, errors cut to 200 characters."""
    out = []
    for db in dbs:
        began = time.perf_counter()
        try:
            reader(spark, db, db.get("probe", "(SELECT 1 AS x) t")).limit(1).collect()
            out.append({"id": db["id"], "status": "ok", "latency_ms": round((time.perf_counter() - began) * 1000, 1), "error": None})
        except Exception as e:  # noqa: BLE001  a probe reports any failure
            out.append({"id": db["id"], "status": "fail", "latency_ms": None, "error": str(e)[:200]})
    return out
