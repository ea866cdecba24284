"""One table's sync as a plan: scan, filter, project, merge, commit data and watermark at once (STR-1, STR-2)."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablemill.functions.timespec import resolve_since, validate_retention
from tablemill.operators.sync import cutoff, delta, kept, merge, project
from tablemill.plans.store import TableStore


@dataclass
class SyncPlan:
    source_table: str
    target_table: str
    timestamp_column: str | None = None
    watermark_column: str | None = None
    sync_since: str | None = None
    source_retention: str | None = None
    overlap_minutes: int = 0
    strategy: str = "insert"
    keys: list[str] = field(default_factory=list)
    drop_columns: list[str] = field(default_factory=list)
    types: dict[str, str] = field(default_factory=dict)
    required: list[str] = field(default_factory=list)
    partition_by: list[str] = field(default_factory=list)
    order_by: list[str] = field(default_factory=list)

    def __post_init__(self):
        if self.sync_since and not self.timestamp_column:
            raise ValueError(f"{self.source_table}: sync_since needs timestamp_column")
        if self.strategy == "upsert" and not self.keys:
            raise ValueError(f"{self.source_table}: upsert needs keys")
        if self.source_retention:
            validate_retention(self.source_table, self.source_retention, self.sync_since, self.timestamp_column)

    @property
    def mark(self) -> str | None:
        return self.watermark_column or self.timestamp_column


def parse(value: str | None):
    """A stored watermark: a whole number or a time (Q6: compared by type, never as text)."""
    if value is None:
        return None
    return int(value) if value.lstrip("-").isdigit() else datetime.fromisoformat(value)


def extract(source: DataFrame, plan: SyncPlan, watermark, now: datetime) -> DataFrame:
    since = parse(resolve_since(plan.sync_since, now)) if plan.sync_since else None
    if plan.mark is None:
        return source
    if plan.mark == plan.timestamp_column and watermark is not None:
        return delta(source, plan.mark, cutoff(watermark, plan.overlap_minutes, since))
    return delta(source, plan.mark, cutoff(watermark, plan.overlap_minutes) if watermark is not None else None, since, plan.timestamp_column)


def run(plan: SyncPlan, source: DataFrame, store: TableStore, now: datetime) -> int:
    """Rows that came in. The watermark is taken from the delta before columns are dropped (Q7)."""
    found = extract(source, plan, parse(store.watermark(plan.target_table)), now)
    # read once: count, watermark and rows come from the same written delta, so a row that arrives meanwhile waits for the next run
    found = store.staged(plan.target_table, found)
    fresh = project(found, drop=plan.drop_columns, types=plan.types, required=plan.required)
    row = found.agg(F.count("*").alias("n"), F.max(plan.mark).alias("m") if plan.mark else F.lit(None).alias("m")).first()
    target = store.read(plan.target_table)
    mark = None if row.m is None else row.m.isoformat() if isinstance(row.m, datetime) else str(row.m)
    if target is not None and plan.mark is None:
        target = target.limit(0)  # a full copy replaces what is there
    if target is not None and plan.strategy == "insert" and plan.mark:
        store.commit(plan.target_table, fresh, watermark=mark, append=True, partition_by=plan.partition_by, sort_by=plan.order_by)
    else:
        order = [F.col(plan.mark)] if plan.mark and plan.mark in fresh.columns else []
        base = fresh.limit(0) if target is None else target.select(*fresh.columns)
        store.commit(plan.target_table, merge(base, fresh, plan.strategy, plan.keys, [*order, *[F.col(c) for c in fresh.columns]]), watermark=mark, partition_by=plan.partition_by, sort_by=plan.order_by)
    store.unstage(plan.target_table)
    return row.n


def purge(plan: SyncPlan, store: TableStore, table: str, now: datetime) -> None:
    """SNK-17 on a table of the store."""
    df = store.read(table)
    if plan.source_retention and df is not None:
        store.commit(table, kept(df, plan.timestamp_column, parse(resolve_since(plan.source_retention, now))))
