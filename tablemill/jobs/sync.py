"""Table sync, quality checks and probes as jobs."""

from __future__ import annotations

import json
from datetime import datetime
from pathlib import Path

from tablemill.jobs.base import Job, JobResult, roll_up
from tablemill.operators.quality import orphan_count, profile
from tablemill.plans import sync
from tablemill.plans.store import TableStore
from tablemill.sources.registry import Registry, expand_env, probe, read


class TableSync(Job):
    """Tables of a config: {source, store, defaults{}, tables[...]}, each a sync plan."""

    name, scope = "table_sync", "pipeline"
    default_args = {"config": "sync.json", "registry": "databases.json", "now": None}

    def run(self, *, config: str, registry: str, now: str | None) -> JobResult:
        cfg = json.loads(expand_env(Path(config).read_text()))
        db = cfg["source"] if isinstance(cfg["source"], dict) else Registry(registry).get(cfg["source"])
        if db is None:
            raise ValueError(f"unknown database {cfg['source']!r}")
        store, at = TableStore(self.spark, cfg["store"]), datetime.fromisoformat(now) if now else datetime.now()
        done: dict[str, int | Exception] = {}
        for t in cfg["tables"]:
            try:
                plan = sync.SyncPlan(**{**cfg.get("defaults", {}), **t})
                done[plan.target_table] = sync.run(plan, read(self.spark, db, plan.source_table), store, at)
            except Exception as e:  # noqa: BLE001
                done[t.get("target_table", "?")] = e
        return roll_up(done)


class ForeignKeys(Job):
    """Orphans of declared keys: {db, keys[{child, columns, parent, ref_columns}]}."""

    name, scope = "fk_integrity", "all_tables"
    default_args = {"config": "constraints.json"}

    def run(self, *, config: str) -> JobResult:
        cfg = json.loads(Path(config).read_text())
        rows = []
        for k in cfg["keys"]:
            child, parent = read(self.spark, cfg["db"], k["child"]), read(self.spark, cfg["db"], k["parent"])
            rows += orphan_count(f"{k['child']}->{k['parent']}", child, k["columns"], parent, k["ref_columns"]).collect()
        bad = [r for r in rows if not r.ok]
        return JobResult(not bad, f"{len(rows)} checked, {len(bad)} violated" + "".join(f"; {r.edge}: {r.orphans}" for r in bad), sum(r.orphans for r in bad))


class Profiler(Job):
    """Column profiles of tables, kept as JSON."""

    name, scope = "table_profiler", "all_tables"
    default_args = {"config": "profile.json"}

    def run(self, *, config: str) -> JobResult:
        cfg = json.loads(Path(config).read_text())
        for t in cfg["tables"]:
            profile(read(self.spark, cfg["db"], t)).write.mode("overwrite").json(f"{cfg['out']}/{t}")
        return JobResult(True, f"{len(cfg['tables'])} tables", len(cfg["tables"]))


class ConnectionTest(Job):
    name, scope = "connection_test", "all_dbs"
    default_args = {"registry": "databases.json"}

    def run(self, *, registry: str) -> JobResult:
        out = probe(self.spark, Registry(registry).load())
        ok = sum(x["status"] == "ok" for x in out)
        return JobResult(ok == len(out), f"{ok} ok, {len(out) - ok} failed", len(out))
