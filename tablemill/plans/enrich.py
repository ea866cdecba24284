"""Row enrichment as one plan: lookups, objects, request, response arrays, mapping, projection, parent and children.

Each source row has one outcome: ok; skipped (no response); empty (the response's arrays give no rows; its children are
still written); failed (the request raised; the error is told). One row's failure leaves the others alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablemill.functions import text
from tablemill.operators.context import Context, run_queries, with_objects
from tablemill.operators.enrich import merge_arrays
from tablemill.operators.sync import excluded, merge
from tablemill.plans.store import TableStore
from tablemill.sources import http


@dataclass
class EnrichPlan:
    target_table: str
    source_columns: list[str]
    url: str
    mapping: list[dict]
    method: str = "GET"
    body: Any = None
    headers: dict[str, str] = field(default_factory=dict)
    timeout: float = 10
    workers: int = 1
    queries: list[dict] = field(default_factory=list)
    objects: dict | None = None
    merge: list[dict] | None = None
    stamp: str | None = None
    strategy: str = "insert"
    keys: list[str] = field(default_factory=list)
    exclusion: dict | None = None
    children: list[dict] = field(default_factory=list)


def ask(plan: EnrichPlan, source: DataFrame, dbs: dict[str, dict[str, DataFrame]], objects: DataFrame | None = None, transport: Callable = http.urllib_transport) -> DataFrame:
    """The source's columns with response and error. Requests run when this is read: write it once, read that."""
    ctx = run_queries(Context(source, source.columns), plan.queries, dbs)
    if plan.objects and objects is not None:
        o = plan.objects
        ctx = with_objects(ctx, objects, o["prefix_template"], o["group_by_substring"], o.get("max_object_size_bytes", 10 << 20), o.get("max_objects", 50))
    cols = ctx.columns()
    out = ctx.df.withColumn("url__", text.url(plan.url, cols))
    if plan.body is not None:
        out = out.withColumn("body__", F.to_json(text.body(plan.body, cols, {c: F.col(f"`{c}`") for c in ctx.collections}), {"ignoreNullFields": "false"}))
    got = http.fetch(out.select(*source.columns, "url__", *(["body__"] if plan.body is not None else [])), method=plan.method, url="url__", body="body__" if plan.body is not None else None, headers=plan.headers, timeout=plan.timeout, transport=transport, workers=plan.workers, error="error")
    return got.drop("url__", "body__")


def _items(plan: EnrichPlan) -> dict[str, Column]:
    return {m["prefix"]: F.from_json(text.json_path(F.col("response"), m["json_path"]), "array<string>") for m in plan.merge}


def with_outcome(plan: EnrichPlan, asked: DataFrame) -> DataFrame:
    """A status for each source row."""
    status = F.when(F.col("error").isNotNull(), "failed").when(F.col("response").isNull(), "skipped")
    if plan.merge:
        status = status.when(F.least(*[F.coalesce(F.size(c), F.lit(0)) for c in _items(plan).values()], F.lit(1 << 30)) < 1, "empty")
    return asked.withColumn("status", status.otherwise("ok"))


def outcomes(judged: DataFrame) -> DataFrame:
    """AGG-14: source rows by status."""
    return judged.groupBy("status").agg(F.count("*").alias("n"))


def _mapped(plan: EnrichPlan) -> list[Column]:
    """A merged row's paths begin with an array's prefix; the rest leads into its item."""
    out = []
    for m in plan.mapping:
        head, _, rest = m["json_path"].partition(".")
        item, kind = F.col(f"`{head}`") if any(x["prefix"] == head for x in plan.merge) else F.lit(None).cast("string"), m.get("type", "string")
        out.append((text.json_path(item, rest, kind) if rest else item.try_cast(kind)).alias(m["column"]))
    return out


def enriched(plan: EnrichPlan, judged: DataFrame, now: datetime) -> DataFrame:
    """JOIN-7, FUN-10, PRJ-4, PRJ-5: the rows to write, source columns first."""
    ok = judged.where("status = 'ok'")
    if plan.merge:
        own = ok.select(*[F.col(f"`{c}`") for c in plan.source_columns], F.struct(*[c.alias(n) for n, c in _items(plan).items()]).alias("items__"))
        out = merge_arrays(own, {m["prefix"]: F.col(f"items__.{m['prefix']}") for m in plan.merge})
        mapped = _mapped(plan)
    else:
        out, mapped = ok, text.mapped(F.col("response"), plan.mapping)
    return out.select(*[F.col(f"`{c}`") for c in plan.source_columns], *mapped, *([F.lit(now).alias(plan.stamp)] if plan.stamp else []))


def child_rows(child: dict, judged: DataFrame, stamp: str | None, now: datetime) -> DataFrame:
    """JOIN-8, Q29: a row an item of the response's array, with the source row's key. An item that is no object is the
    first mapped column's value."""
    found = judged.where("response IS NOT NULL").select(F.col(child["parent_key"]).alias(child["foreign_key"]), F.explode(F.from_json(text.json_path(F.col("response"), child["json_path"]), "array<string>")).alias("item"))
    cols = []
    for k, m in enumerate(child["mapping"]):
        kind, inside = m.get("type", "string"), text.json_path(F.col("item"), m["json_path"], m.get("type", "string"))
        cols.append((F.when(F.startswith("item", F.lit("{")), inside).otherwise(F.col("item").try_cast(kind)) if k == 0 else F.when(F.startswith("item", F.lit("{")), inside)).alias(m["column"]))
    return found.select(child["foreign_key"], *cols, *([F.lit(now).alias(stamp)] if stamp else []))


def put(store: TableStore, table: str, rows: DataFrame, strategy: str = "insert", keys: list[str] = ()) -> int:
    """Merges rows, written once, into a table. Returns how many came in."""
    fresh = store.staged(table, rows)
    n, target = fresh.count(), store.read(table)
    if target is None:
        store.commit(table, merge(fresh.limit(0), fresh, strategy, list(keys)))
    elif n and strategy == "insert":
        store.commit(table, fresh, append=True)
    elif n:
        store.commit(table, merge(target.select(*fresh.columns), fresh, strategy, list(keys)))
    store.unstage(table)
    return n


def write_with_children(plan: EnrichPlan, store: TableStore, judged: DataFrame, now: datetime) -> int:
    """SNK-9: the parent first, then each child in turn; all rows written. Each table is committed by itself."""
    total = put(store, plan.target_table, enriched(plan, judged, now), plan.strategy, plan.keys)
    for c in plan.children:
        total += put(store, c["target_table"], child_rows(c, judged, plan.stamp, now), c.get("write_strategy", "insert"), c.get("upsert_key_columns") or [])
    return total


def run(plan: EnrichPlan, source: DataFrame, dbs: dict[str, dict[str, DataFrame]], store: TableStore, now: datetime, objects: DataFrame | None = None, transport: Callable = http.urllib_transport) -> dict[str, int]:
    """The whole plan; rows written and source rows by status. No request is made twice for a committed answer."""
    if plan.exclusion and (target := store.read(plan.target_table)) is not None:
        source = excluded(source, target, plan.exclusion["key_column"], plan.exclusion.get("target_key_column"))
    asked = store.staged(f"{plan.target_table}__answers", ask(plan, source, dbs, objects, transport))
    judged = with_outcome(plan, asked)
    told = {r.status: r.n for r in outcomes(judged).collect()}
    rows = write_with_children(plan, store, judged, now)
    store.unstage(f"{plan.target_table}__answers")
    return {"rows": rows, **{k: told.get(k, 0) for k in ("ok", "skipped", "empty", "failed")}}


class SkipRow(Exception):
    """Raised by a row pipeline to leave a row out."""


def row_pipeline(df: DataFrame, fn: Callable[[dict], list[dict]], schema: str | T.StructType, workers: int = 4) -> DataFrame:
    """UDF-4: fn makes rows of the schema from each row, `workers` of a task at a time. Every row leaves at least one row,
    with status (ok, skipped, failed), error, and first (true once a source row). An empty list is skipped."""
    names = [f.name for f in (T._parse_datatype_string(schema) if isinstance(schema, str) else schema)]
    kinds = (T._parse_datatype_string(schema) if isinstance(schema, str) else schema).fields

    def one(row: dict) -> list[dict]:
        try:
            got = [dict(x, status="ok") for x in fn(row)]
        except SkipRow as e:
            got = [{"status": "skipped", "error": str(e)}]
        except Exception as e:  # noqa: BLE001  the others go on
            got = [{"status": "failed", "error": f"{type(e).__name__}: {e}"[:200]}]
        return [dict(x, first=k == 0) for k, x in enumerate(got or [{"status": "skipped"}])]

    def run_(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(workers) as pool:
            for p in parts:
                clean = p.astype(object).where(p.notna(), None)
                rows = [x for got in pool.map(one, clean.to_dict("records")) for x in got]
                yield pd.DataFrame({n: pd.Series([x.get(n) for x in rows], dtype=object) for n in [*names, "status", "error", "first"]})

    return df.mapInPandas(run_, T.StructType([*kinds, T.StructField("status", T.StringType()), T.StructField("error", T.StringType()), T.StructField("first", T.BooleanType())]))


def pipeline_counts(ran: DataFrame) -> DataFrame:
    """AGG-14: source rows by status, from a written row_pipeline()."""
    return ran.where("first").groupBy("status").agg(F.count("*").alias("n"))
