"""Lookups, response handling and children of enriched rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def lookup(df: DataFrame, other: DataFrame, on: dict[str, str], name: str, order: list[str]) -> DataFrame:
    """JOIN-4, one row: the first by the order, as a struct column; null if there is none (Q31)."""
    keys = list(on.values())
    cols = other.columns
    first = other.groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(F.min_by(F.struct(*cols), F.struct(*order)).alias(name))
    cond = [F.col(a) == F.col(f"__{b}") for a, b in on.items()]
    return df.join(first, cond, "left").drop(*[f"__{k}" for k in keys])


def lookup_many(df: DataFrame, other: DataFrame, on: dict[str, str], name: str, order: list[str]) -> DataFrame:
    """JOIN-4, all rows: a sorted list of structs, empty if there are none."""
    keys = list(on.values())
    rest = [c for c in other.columns if c not in order]
    every = other.groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(F.array_sort(F.collect_list(F.struct(*order, *rest))).alias(name))
    cond = [F.col(a) == F.col(f"__{b}") for a, b in on.items()]
    return df.join(every, cond, "left").withColumn(name, F.coalesce(F.col(name), F.array().cast(every.schema[name].dataType))).drop(*[f"__{k}" for k in keys])


def flatten(df: DataFrame, structs: list[str]) -> DataFrame:
    """FUN-13: lookups' columns beside the source's; later ones overwrite earlier names, lists stay apart."""
    out: dict[str, Column] = {c: F.col(c) for c in df.columns if c not in structs}
    for s in structs:
        for f in df.schema[s].dataType:
            out[f.name] = F.col(f"{s}.{f.name}")
    return df.select(*[c.alias(n) for n, c in out.items()])


def merge_arrays(df: DataFrame, arrays: dict[str, Column]) -> DataFrame:
    """JOIN-7, SRT-9: arrays side by side, up to the shortest; a missing array gives no rows."""
    sized = df.select("*", *[c.alias(f"__{n}") for n, c in arrays.items()])
    size = F.least(*[F.coalesce(F.size(f"__{n}"), F.lit(0)) for n in arrays]) if len(arrays) > 1 else F.coalesce(F.size(f"__{next(iter(arrays))}"), F.lit(0))
    zipped = F.slice(F.arrays_zip(*[F.col(f"__{n}") for n in arrays]), F.lit(1), F.greatest(size, F.lit(0)))
    out = sized.select(*df.columns, F.posexplode(zipped).alias("idx", "z"))
    return out.select(*df.columns, "idx", *[F.col(f"z.__{n}").alias(n) for n in arrays])


def children(df: DataFrame, key: str, foreign: str, items: Column, name: str = "item") -> DataFrame:
    """JOIN-8, DM-6: a row an item, carrying the source row's key (Q29)."""
    return df.select(F.col(key).alias(foreign), F.posexplode(items).alias("idx", name))


def match_by_id(rows: DataFrame, responses: DataFrame, key: str, response_key: str) -> DataFrame:
    """JOIN-5: of responses with one id the last one (by pos) wins; rows without one keep nulls."""
    rest = [c for c in responses.columns if c not in (response_key, "pos")]
    last = responses.groupBy(F.col(response_key).alias("__k")).agg(F.max_by(F.struct(*rest), F.col("pos")).alias("__r"))
    return rows.join(last, F.col(key) == F.col("__k"), "left").select(*rows.columns, *[F.col(f"__r.{c}").alias(c) for c in rest])


def match_by_position(rows: DataFrame, responses: DataFrame) -> DataFrame:
    """JOIN-6: both have batch and pos."""
    return rows.join(responses, ["batch", "pos"], "left")


def enriched(df: DataFrame, source: list[str], mapped: list[Column], stamp: str | None, as_of) -> DataFrame:
    """PRJ-4, PRJ-5: source columns, response columns, stamp; a watermark column that is not among them is dropped."""
    return df.select(*source, *mapped, *([F.lit(as_of).alias(stamp)] if stamp else []))


def object_groups(objects: DataFrame, groups: dict[str, str], most_bytes: int = 10 << 20, most: int = 50, by: Column | None = None) -> DataFrame:
    """SRC-13, FLT-10, WIN-5: objects have key, size and body; the first group whose text the key holds takes an object;
    large objects are left out, and a group takes its first `most` by key, in base64. The cap is the operator's feature.
    With `by`, groups are apart for each of its values, in a column under__."""
    from tablemill.functions.text import plain_base64

    group = None
    for name, part in groups.items():
        hit = F.col("key").contains(part)
        group = F.when(hit, name) if group is None else group.when(hit, name)
    own = objects.where(F.col("size") <= most_bytes).withColumn("grp", group).where("grp IS NOT NULL")
    under = [] if by is None else ["under__"]
    own = own if by is None else own.withColumn("under__", by)
    w = Window.partitionBy(*under, "grp").orderBy("key")
    return own.withColumn("pos", F.row_number().over(w).cast("bigint")).where(F.col("pos") <= most).select(*under, "grp", "pos", "key", plain_base64(F.col("body")).alias("content"))


def validate(table: dict, api: dict) -> None:
    """FLT-16."""
    if api.get("mode") == "batch":
        for feature in ("source_queries", "s3_objects", "child_targets"):
            if table.get(feature):
                raise ValueError(f"batch mode cannot use {feature}")
        if not api.get("batch_key"):
            raise ValueError("batch mode needs batch_key")
    if table.get("write_strategy", "insert") in ("upsert", "replace") and not table.get("upsert_key_columns"):
        raise ValueError("upsert and replace need upsert_key_columns")
    if table.get("sync_since") and not table.get("timestamp_column"):
        raise ValueError("sync_since needs timestamp_column")
