"""Catalog scans, snapshots, object listings and config files (SRC-10 to SRC-13, SRC-16 to SRC-18, SNK-18 to SNK-20)."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablemill.functions.naming import split_name, user_schemas

COLUMNS = "db string, tbl string, col string, type string, nullable boolean, ordinal bigint, pk string"


def columns(spark: SparkSession, tables: dict[tuple[str, str], DataFrame], keys: dict[tuple[str, str], list[str]] | None = None) -> DataFrame:
    """SRC-10, SRC-11, WIN-6: a row a column; primary keys come from declared constraints."""
    rows = [(db, t, f.name, f.dataType.simpleString(), f.nullable, k, ",".join((keys or {}).get((db, t), [])) or None) for (db, t), df in tables.items() for k, f in enumerate(df.schema, 1)]
    return spark.createDataFrame(rows, COLUMNS)


def column_details(spark: SparkSession, tables: dict[tuple[str, str], DataFrame]) -> DataFrame:
    """SRC-10, WIN-6: a row a column: type with its precision, scale, length and element type, from the DataFrame's schema."""
    rows = []
    for (db, t), df in tables.items():
        for k, f in enumerate(df.schema, 1):
            d, length = f.dataType, getattr(f.dataType, "length", None) or f.metadata.get("length")
            rows.append((db, t, f.name, k, d.typeName(), f.nullable, getattr(d, "precision", None), getattr(d, "scale", None), length, d.elementType.simpleString() if d.typeName() == "array" else None))
    return spark.createDataFrame(rows, "db string, tbl string, col string, ordinal bigint, type string, nullable boolean, precision bigint, scale bigint, max_length bigint, element string")


def scan_schemas(details: DataFrame, kind: str, constraints: DataFrame) -> DataFrame:
    """SRC-11, FLT-7: columns of the schemas that are no system's, each with its table's declared primary key, and how
    many indexes and references the table declares. details has schema, tbl, col; constraints is tables.catalog()'s."""
    per = constraints.groupBy(F.col("db").alias("schema"), "tbl").agg(
        F.max(F.when(F.col("kind") == "pk", F.array_join("cols", ","))).alias("pk"), F.count_if(F.col("kind") == "index").alias("indexes"), F.count_if(F.col("kind") == "fk").alias("fks"))
    out = user_schemas(details, kind).join(per, ["schema", "tbl"], "left")
    return out.fillna(0, ["indexes", "fks"])


def row_counts(tables: dict[tuple[str, str], DataFrame], at: str) -> DataFrame:
    """SRC-12, AGG-5, STR-6: a row a table; counting reads no columns."""
    out = None
    for (db, t), df in tables.items():
        one = df.agg(F.count("*").alias("row_count")).select(F.lit(at).alias("ts"), F.lit(db).alias("db"), F.lit(t).alias("tbl"), "row_count")
        out = one if out is None else out.unionByName(one)
    return out


def objects(spark: SparkSession, path: str) -> DataFrame:
    """SRC-13: a folder's objects with key, size and body."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return raw.select(F.col("path").alias("key"), F.col("length").alias("size"), F.col("content").alias("body"))


def config_edges(path: str | Path, default_schema: str = "public") -> list[dict]:
    """SRC-18, DM-11: edges of a sync config; none if the file is missing or broken."""
    try:
        cfg = json.loads(Path(path).read_text())
        out = []
        for t in cfg.get("tables", []):
            name = t.get("source_table") or t["table"]
            schema, table = split_name(name, t.get("source_schema", default_schema))
            to_schema, to_table = split_name(t.get("target_table") or t.get("table"), t.get("target_schema", default_schema))
            out.append({"from": f"{cfg['source']}:{schema}.{table}", "to": f"{cfg['target']}:{to_schema}.{to_table}", "label": cfg.get("label", "sync")})
        return out
    except (OSError, ValueError, KeyError, TypeError):
        return []


def json_documents(spark: SparkSession, path: str, schema: str, lines: bool = False) -> DataFrame:
    """SRC-16, SRC-17."""
    return spark.read.schema(schema).option("multiLine", str(not lines).lower()).json(path)


def append_json(df: DataFrame, path: str) -> None:
    """SNK-19."""
    df.write.mode("append").json(path)


def replace_json(df: DataFrame, path: str) -> None:
    """SNK-20."""
    df.write.mode("overwrite").json(path)


def snapshot(df: DataFrame, path: str, snapshot_id: str) -> None:
    """SNK-18: snapshots are appended by id; the last two are the current and the previous one."""
    df.withColumn("snapshot_id", F.lit(snapshot_id)).write.mode("append").partitionBy("snapshot_id").parquet(path)


def last_two(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    every = spark.read.parquet(path).withColumn("snapshot_id", F.col("snapshot_id").cast("string"))
    ids = [r.snapshot_id for r in every.select("snapshot_id").distinct().orderBy(F.desc("snapshot_id")).limit(2).collect()]
    pick = lambda k: every.where(F.col("snapshot_id") == (ids[k] if k < len(ids) else "")).drop("snapshot_id")
    return pick(0), pick(1)
