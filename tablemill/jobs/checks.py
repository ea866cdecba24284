"""Incremental replacement, drift, freshness, metadata snapshots and enrichment as jobs."""

from __future__ import annotations

import json
from datetime import datetime
from pathlib import Path

from pyspark.sql import functions as F

from tablemill.jobs.base import Job, JobResult, roll_up
from tablemill.operators.quality import drift, stale
from tablemill.operators.sync import delta_from_target, replace_merge
from tablemill.plans import enrich
from tablemill.plans.store import TableStore
from tablemill.sources import metadata
from tablemill.sources.registry import expand_env, read


def _config(path: str) -> dict:
    return json.loads(expand_env(Path(path).read_text()))


class IncrementalSync(Job):
    """Rows after the target's latest time less the overlap replace those of their keys: {source, store, overlap_minutes,
    tables[{table, keys, timestamp_column}]}."""

    name, scope = "incremental_sync", "pipeline"
    default_args = {"config": "incremental.json"}

    def run(self, *, config: str) -> JobResult:
        cfg, done, text = _config(config), {}, []
        store = TableStore(self.spark, cfg["store"])
        for t in cfg["tables"]:
            name = t["table"]
            try:
                source, target = read(self.spark, cfg["source"], name), store.read(name)
                found = source if target is None else delta_from_target(source, target, t["timestamp_column"], cfg.get("overlap_minutes", 30))
                fresh = store.staged(name, found)
                candidates = fresh.count()
                if target is None or candidates:  # AGG-6: all candidates are written
                    store.commit(name, fresh if target is None else replace_merge(target, fresh, t["keys"]))
                store.unstage(name)
                done[name] = candidates
                text.append(f"{name}: {candidates} candidates, {candidates} written")
            except Exception as e:  # noqa: BLE001
                done[name] = e
        out = roll_up(done)
        out.message = "; ".join([out.message, *text])
        return out


class MetadataSnapshot(Job):
    """SRC-11, STR-6: appends the columns of a database's tables and a log of their row counts: {source, out, tables,
    keys{table: columns}}."""

    name, scope = "metadata_snapshot", "all_dbs"
    default_args = {"config": "metadata.json", "now": None}

    def run(self, *, config: str, now: str | None) -> JobResult:
        cfg, at = _config(config), now or datetime.now().isoformat()
        db = cfg["source"].get("id", "main")
        tables = {(db, t): read(self.spark, cfg["source"], t) for t in cfg["tables"]}
        keys = {(db, t): k for t, k in cfg.get("keys", {}).items()}
        metadata.snapshot(metadata.columns(self.spark, tables, keys), f"{cfg['out']}/columns", at)
        metadata.append_json(metadata.row_counts(tables, at), f"{cfg['out']}/row_counts")
        return JobResult(True, f"{len(tables)} tables", len(tables))


class SchemaDrift(Job):
    """The last two snapshots of columns; success without a breaking change."""

    name, scope = "schema_drift", "all_dbs"
    default_args = {"snapshots": "snapshots"}

    def run(self, *, snapshots: str) -> JobResult:
        cur, prev = metadata.last_two(self.spark, f"{snapshots}/columns")
        if not prev.limit(1).count():
            return JobResult(True, "one snapshot, nothing to compare")
        found = drift(cur, prev).orderBy("db", "tbl", "kind", "detail").collect()
        bad = [r for r in found if r.breaking]
        shown = "".join(f"; {r.kind} {r.db}.{r.tbl or ''} {r.detail or ''}".rstrip() for r in found)
        return JobResult(not bad, f"{len(found)} changes, {len(bad)} breaking{shown}", len(found))


class FreshnessCheck(Job):
    """JOIN-10, FLT-14: tables with rows whose count did not move between the last two entries of the log."""

    name, scope = "freshness_check", "all_tables"
    default_args = {"snapshots": "snapshots"}

    def run(self, *, snapshots: str) -> JobResult:
        log = metadata.json_documents(self.spark, f"{snapshots}/row_counts", "ts string, db string, tbl string, row_count bigint", lines=True)
        last = [r.ts for r in log.select("ts").distinct().orderBy(F.desc("ts")).limit(2).collect()]
        if len(last) < 2:
            return JobResult(True, "one entry, nothing to compare")
        cur, prev = (log.where(F.col("ts") == x) for x in last)
        bad = stale(cur, prev).where("stale").orderBy("db", "tbl").collect()
        return JobResult(not bad, f"{len(bad)} stale" + "".join(f"; {r.db}.{r.tbl}" for r in bad), len(bad))


class ApiEnrich(Job):
    """Enrichment plans of a config: {source, dbs{id: {connection, tables}}, store, tables[plan with source_table]}."""

    name, scope = "api_enrich", "pipeline"
    default_args = {"config": "enrich.json", "now": None}
    transport = staticmethod(enrich.http.urllib_transport)

    def run(self, *, config: str, now: str | None) -> JobResult:
        cfg, done, skipped = _config(config), {}, {"skipped": 0, "empty": 0, "failed": 0}
        store, at = TableStore(self.spark, cfg["store"]), datetime.fromisoformat(now) if now else datetime.now()
        dbs = {k: {t: read(self.spark, d["connection"], t) for t in d["tables"]} for k, d in cfg.get("dbs", {}).items()}
        for t in cfg["tables"]:
            try:
                plan = enrich.EnrichPlan(**{k: v for k, v in t.items() if k != "source_table"})
                got = enrich.run(plan, read(self.spark, cfg["source"], t["source_table"]), dbs, store, at, transport=self.transport)
                done[plan.target_table] = got["rows"]
                skipped = {k: n + got[k] for k, n in skipped.items()}
            except Exception as e:  # noqa: BLE001
                done[t.get("target_table", "?")] = e
        out = roll_up(done)
        out.message += "; rows " + ", ".join(f"{k} {n}" for k, n in skipped.items())
        out.success = out.success and not skipped["failed"]
        return out
