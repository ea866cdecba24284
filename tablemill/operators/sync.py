"""Delta extraction, projection, merges, retention and version dedup."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablemill.functions.types import coerce


def cutoff(watermark, overlap_minutes: int = 0, since=None):
    """FLT-3, FUN-21: the later of the floor and the watermark less the overlap; whole-number watermarks have no overlap."""
    if isinstance(watermark, datetime):
        watermark = watermark - timedelta(minutes=overlap_minutes)
    return watermark if since is None else since if watermark is None else max(watermark, since)


def delta(df: DataFrame, column: str, after=None, floor=None, floor_column: str | None = None) -> DataFrame:
    """FLT-1, FLT-2, STR-3: strictly after the cutoff, and not before the floor of the time column."""
    out = df if after is None else df.where(F.col(column) > F.lit(after))
    return out if floor is None else out.where(F.col(floor_column or column) >= F.lit(floor))


def delta_from_target(source: DataFrame, target: DataFrame, column: str, overlap_minutes: int = 30, first=None) -> DataFrame:
    """FLT-4, AGG-2: after the target's latest row less the overlap; from `first` on if the target is empty. That one
    value is read first, so that the comparison is a filter of the scan; no cutoff (null) leaves no rows."""
    latest = target.agg(F.max(column).alias("latest__"))
    start = latest.select(F.coalesce(F.expr(f"latest__ - interval {int(overlap_minutes)} minutes"), F.lit(first)).alias("after__"))
    value = start.select(F.col("after__").cast("string")).first()[0]
    return source.where(F.col(column) > F.lit(value).cast(start.schema["after__"].dataType))


def project(df: DataFrame, *, drop: list[str] = (), types: dict[str, str] | None = None, required: list[str] = ()) -> DataFrame:
    """PRJ-1, PRJ-2, FUN-6, FUN-8: the columns that stay, in their order, converted to their target types."""
    kinds = types or {}
    cols = [coerce(F.col(f.name), f.dataType, kinds[f.name], nullable=f.name not in required).alias(f.name) if f.name in kinds else F.col(f.name) for f in df.schema if f.name not in drop]
    return df.select(*cols)


def like(source: DataFrame, target: DataFrame) -> DataFrame:
    """PRJ-3: the target's columns, in its order."""
    return source.select(*target.columns)


def latest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """SNK-16, WIN-2: one row a key, the last by the order. Ties must be broken by the order."""
    # one aggregation with partial maxima: a hot key is reduced before it is exchanged
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("row__"))
    return best.select(*keys, *[F.col(f"row__.{c}").alias(c) for c in rest]).select(*df.columns)


def _match(keys: list[str]) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & (F.col(f"t.{k}") == F.col(f"s.{k}"))
    return out


def replace_merge(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """SNK-4, SNK-8, JOIN-3, SET-11: rows whose key comes in are removed, all incoming rows stay, copies and null keys too (Q4, Q5)."""
    return target.alias("t").join(source.select(*keys).distinct().alias("s"), _match(keys), "left_anti").unionByName(source)


def upsert(target: DataFrame, source: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """SNK-3, SNK-6, SNK-7: one row a key comes in, the last by the order."""
    return replace_merge(target, latest(source, keys, order), keys)


def insert_ignore(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """SNK-3 where all columns are keys: known keys stay as they are."""
    return target.unionByName(source.alias("t").join(target.select(*keys).distinct().alias("s"), _match(keys), "left_anti"))


def append(target: DataFrame, source: DataFrame) -> DataFrame:
    """SNK-1, SNK-2: no dedup, so an overlap repeats rows (Q3)."""
    return target.unionByName(source)


STRATEGIES = ("insert", "upsert", "replace")


def merge(target: DataFrame, source: DataFrame, strategy: str, keys: list[str] = (), order: list[Column] = ()) -> DataFrame:
    """SNK-5."""
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy {strategy!r}; known: {', '.join(STRATEGIES)}")
    if strategy == "insert":
        return append(target, source)
    if not keys:
        raise ValueError(f"{strategy} needs key columns")
    if strategy == "replace":
        return replace_merge(target, source, list(keys))
    if set(keys) == set(source.columns):
        return insert_ignore(target, source.distinct(), list(keys))
    return upsert(target, source, list(keys), list(order) or [F.col(c) for c in source.columns])


def kept(df: DataFrame, column: str, before) -> DataFrame:
    """SNK-17: what a purge of rows before the cutoff leaves; rows without a stamp stay."""
    return df.where((F.col(column) >= F.lit(before)) | F.col(column).isNull())


def purged(df: DataFrame, column: str, before) -> DataFrame:
    """FLT-8."""
    return df.where(F.col(column) < F.lit(before))


def excluded(source: DataFrame, target: DataFrame, key: str, target_key: str | None = None) -> DataFrame:
    """JOIN-2, FLT-9, AGG-7, STR-5: rows whose key the target does not hold; null keys stay (Q11)."""
    known = target.select(F.col(target_key or key).alias("known__")).where("known__ IS NOT NULL").distinct()
    return source.join(known, F.col(key) == F.col("known__"), "left_anti")


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """SNK-12, SNK-13: keys that are not unique, with their counts."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def watermarks(states: DataFrame) -> DataFrame:
    """SNK-15, DM-7, SRT-4: the last value of each config key and column."""
    return states.groupBy("config_key", "timestamp_column").agg(F.max_by("value", F.struct("updated_at", "value")).alias("value"), F.max("updated_at").alias("updated_at"))


def running_max(df: DataFrame, column: str, part: str, blocks: int = 64) -> DataFrame:
    """AGG-3 by part, a number or time: the mark after each micro-batch. Batches are dealt to `blocks` ranges by their
    approximate quantiles, which are read first; a range needs only the greatest mark of the ranges before it."""
    per = df.groupBy(part).agg(F.max(column).alias("batch_max"))
    bounds = df.agg(F.expr(f"percentile_approx({part}, array({', '.join(str(k / blocks) for k in range(1, blocks))}))").alias("b")).first().b or []
    cuts = F.array(*[F.lit(b).cast(df.schema[part].dataType) for b in dict.fromkeys(bounds)]) if bounds else F.array().cast("array<int>")
    per = per.withColumn("block__", F.when(F.col(part).isNull(), -1).otherwise(F.size(F.filter(cuts, lambda b: b < F.col(part)))) if bounds else F.lit(0))
    upto = Window.partitionBy("block__").orderBy(part).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.orderBy("block__").rowsBetween(Window.unboundedPreceding, -1)  # at most blocks + 1 rows
    ahead = per.groupBy("block__").agg(F.max("batch_max").alias("top__")).select("block__", F.max("top__").over(before).alias("ahead__"))
    out = per.withColumn("own__", F.max("batch_max").over(upto)).join(F.broadcast(ahead), "block__")
    return out.select(part, "batch_max", F.greatest("own__", "ahead__").alias("watermark"))


def merge_counts(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """AGG-6: candidates, those that replace a row of the target, and those that are new."""
    known = target.select(*[F.col(k).alias(f"t__{k}") for k in keys], F.lit(True).alias("known__")).distinct()
    on = [F.col(k) == F.col(f"t__{k}") for k in keys]
    return source.select(*keys).join(known, on, "left").agg(F.count("*").alias("candidates"), F.count("known__").alias("replaced"), F.count_if(F.col("known__").isNull()).alias("added"))


def ordered_scan(df: DataFrame, column: str) -> DataFrame:
    """SRT-1: rows by the watermark column within each partition, without an exchange."""
    return df.sortWithinPartitions(column)
