"""Enrichment plans, table definitions, schedules, dependent jobs and the check jobs."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tablemill.jobs import registry
from tablemill.jobs.base import Job, JobResult
from tablemill.jobs.runner import Runner, allowed, next_run
from tablemill.operators import sync
from tablemill.operators.context import Context, bound, run_queries, with_objects
from tablemill.plans import enrich, tables
from tablemill.plans.store import TableStore
from tablemill.sources import metadata
from tablemill.sources.registry import literal, read_sql

NOW = datetime(2024, 2, 1)
D = "/root/testdata/sf0.001"


def echo(method, url, body, headers, timeout):
    key = int(url.rsplit("/", 1)[1])
    if key == 3:
        raise OSError("refused")
    return None if key == 4 else json.dumps({"v": key * 10, "items": [] if key == 5 else ["a", {"n": "b"}]})


def test_binds_and_table_names():
    assert bound("SELECT ':a', x::int, t.t FROM t WHERE k = :a AND m = :zz AND 't' <> ':a'", {"a": "s__.`a`"}, {"t": "q0__"}) == "SELECT ':a', x::int, t.t FROM q0__ WHERE k = s__.`a` AND m = NULL AND 't' <> ':a'"
    assert bound("SELECT * FROM s.t", {}, {"s.t": "q1__", "t": "q0__"}) == "SELECT * FROM q1__"


def test_queries_bind_from_earlier_ones_and_fail_alone(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (2, None), (None, "z")], "id int, n string")
    other = {"db": {"s.t": spark.createDataFrame([(1, 7, "b"), (1, 6, "a"), (2, None, "c")], "k int, m int, n string"), "u": spark.createDataFrame([(6, "six"), (7, "seven")], "m int, w string")}}
    queries = [
        {"name": "one", "db": "db", "sql": "SELECT m, n FROM s.t WHERE k = :id"},
        {"name": "every", "db": "db", "sql": "SELECT m AS mm FROM s.t WHERE k = :id AND m IS NOT NULL", "many": True},
        {"name": "word", "db": "db", "sql": "SELECT w FROM u WHERE m = :m", "bind_from": "one"},
        {"name": "last", "db": "db", "sql": "SELECT w AS ww FROM u WHERE m = :mm", "bind_from": "every"},
        {"name": "broken", "db": "db", "sql": "SELECT nothing FROM u"},
    ]
    ctx = run_queries(Context(df, df.columns), queries, other)
    got = ctx.df.select("id", ctx.get("n").alias("n"), ctx.get("one.m").alias("m"), F.size("every").alias("k"), ctx.get("w").alias("w"), ctx.get("ww").alias("ww"), ctx.get("every.mm").alias("no"), F.col("broken")).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, [(1, "a", 6, 2, "six", "six", None, None)] * 2 + [(2, "c", None, 0, None, None, None, None), (None, None, None, 0, None, None, None, None)]))
    assert run_queries(Context(df.limit(0), df.columns), queries[:2], other).df.count() == 0


def test_objects_meet_rows_by_prefix(spark):
    rows = spark.createDataFrame([("a",), ("b b",), (None,)], "sku string")
    objects = spark.createDataFrame([(f"p/{s}/photo_{k}.png", k, f"{k}".encode()) for s in ("a", "b%20b") for k in range(4)] + [("p/a/diagram_photo_", 1, b"d"), ("p/c/photo_1", 1, b"c")], "key string, size int, body binary")
    ctx = with_objects(Context(rows, ["sku"]), objects, "p/{sku}/", {"d": "diagram_", "p": "photo_"}, 2, 2)
    assert {r.sku: (r.d, r.p) for r in ctx.df.collect()} == {"a": (["ZA=="], ["MA==", "MQ=="]), "b b": ([], ["MA==", "MQ=="]), None: ([], [])}
    assert str(ctx.get("$collections.p")) == str(F.col("`p`"))
    with pytest.raises(ValueError):
        with_objects(Context(rows, ["sku"]), objects, "p/{sku}", {})


def test_a_plan_skips_rows_and_writes_children(spark, tmp_path):
    store = TableStore(spark, f"file://{tmp_path}/st")
    source = spark.createDataFrame([(k, None if k == 2 else "s") for k in range(1, 7)], "id int, name string")
    child = {"target_table": "kids", "json_path": "items", "parent_key": "id", "foreign_key": "pid", "mapping": [{"json_path": "n", "column": "n"}], "write_strategy": "upsert", "upsert_key_columns": ["pid", "n"]}
    plan = enrich.EnrichPlan("out", ["id", "name"], "mem://{name}/{id}", [{"json_path": "v", "column": "v", "type": "bigint"}], stamp="at", children=[child], exclusion={"key_column": "id"}, workers=3)
    assert enrich.run(plan, source, {}, store, NOW, transport=echo) == {"rows": 4 + 6, "ok": 4, "skipped": 1, "empty": 0, "failed": 1}
    assert sorted(tuple(r) for r in store.read("out").collect()) == [(1, "s", 10, NOW), (2, None, 20, NOW), (5, "s", 50, NOW), (6, "s", 60, NOW)]
    assert sorted((r.pid, r.n) for r in store.read("kids").collect()) == [(k, n) for k in (1, 2, 6) for n in "ab"]
    # a second run asks again only for what is not there
    assert enrich.run(plan, source, {}, store, NOW, transport=echo) == {"rows": 0, "ok": 0, "skipped": 1, "empty": 0, "failed": 1}
    merged = enrich.EnrichPlan("m", ["id"], "mem://{id}/{id}", [{"json_path": "i.n", "column": "n"}, {"json_path": "i", "column": "whole"}, {"json_path": "zz.n", "column": "no"}], merge=[{"json_path": "items", "prefix": "i"}])
    assert enrich.run(merged, source, {}, store, NOW, transport=echo) == {"rows": 6, "ok": 3, "skipped": 1, "empty": 1, "failed": 1}
    assert sorted((r.n or "", r.whole, r.no) for r in store.read("m").where("id = 1").collect()) == [("", "a", None), ("b", '{"n":"b"}', None)]
    assert enrich.run(merged, source.limit(0), {}, store, NOW, transport=echo)["rows"] == 0


def test_row_pipelines_tell_what_failed(spark):
    def fn(row):
        if row["k"] is None:
            raise enrich.SkipRow("no key")
        return [{"q": 6 // row["k"]}] * row["k"]

    got = enrich.row_pipeline(spark.createDataFrame([(0,), (2,), (None,), (3,)], "k int"), fn, "q int").collect()
    assert sorted((r.q or 0, r.status, r.error or "", r.first) for r in got) == sorted([(0, "failed", "ZeroDivisionError: integer division or modulo by zero", True), (0, "skipped", "no key", True), (3, "ok", "", True), (3, "ok", "", False), (2, "ok", "", True), (2, "ok", "", False), (2, "ok", "", False)])
    assert enrich.pipeline_counts(enrich.row_pipeline(spark.createDataFrame([], "k int"), fn, "q int")).count() == 0


def test_definitions_and_constraints(spark, tmp_path):
    cols = {"id": "Int64", "v": "String"}
    assert tables.definition("clickhouse", "d.t", cols, stamp="at") == 'CREATE TABLE IF NOT EXISTS d.t ("id" Int64, "v" String, "at" DateTime64(3)) ENGINE = MergeTree ORDER BY tuple()'
    assert tables.definition("clickhouse", "t", cols, order_by=["id"], partition_by="v", engine="Log").endswith("ENGINE = Log ORDER BY (id) PARTITION BY v")
    assert tables.definition("postgresql", "t", cols, required=["id"], key=["id"]) == 'CREATE TABLE IF NOT EXISTS t ("id" Int64 NOT NULL, "v" String, UNIQUE ("id"))'
    assert tables.definition("mssql", "s.t", cols, stamp="at").startswith("IF OBJECT_ID('s.t') IS NULL CREATE TABLE s.t") and "DATETIME2" in tables.definition("mssql", "t", cols, stamp="at")
    assert [tables.dialect_strategy(k, "upsert") for k in ("postgresql", "sqlite", "clickhouse", "other")] == ["upsert", "replace", "insert", "insert"]
    store = TableStore(spark, f"file://{tmp_path}/st")
    assert tables.ensure(store, "t", "id bigint") and not tables.ensure(store, "t", "id bigint") and store.read("t").columns == ["id"]
    df = spark.createDataFrame([(1, None), (1, "x"), (None, "y"), (None, "z")], "id int, v string")
    declared = [{"db": "d", "tbl": "t", "kind": k, "cols": c} for k, c in (("unique", ["id"]), ("not_null", ["id", "v"]), ("unique", ["id", "v"]))]
    assert [r.bad for r in tables.violations({("d", "t"): df}, declared).collect()] == [1, 3, 0]
    assert [tuple(r) for r in tables.missing_values(df, ["id", "v"]).orderBy("col").collect()] == [("id", 2), ("v", 1)]


def test_marks_by_ranges_equal_a_running_maximum(spark):
    values = [(k, (k * 37) % 101, k // 3) for k in range(500)] + [(1000, None, 200)]
    df = spark.createDataFrame(values, "k int, v int, b int")
    best, want = None, {}
    for b in sorted({b for *_, b in values}):
        best = max([x for _, x, y in values if y == b and x is not None] + ([] if best is None else [best]), default=None)
        want[b] = best
    for blocks in (2, 64):
        assert {r.b: r.watermark for r in sync.running_max(df, "v", "b", blocks).collect()} == want
    assert sync.running_max(df.limit(0), "v", "b").count() == 0


def test_bound_reads(spark):
    assert [literal(x) for x in (None, True, 3, 1.5, "a'b")] == ["NULL", "TRUE", "3", "1.5", "'a''b'"]
    db = {"type": "parquet", "dbname": D, "tables": ["nation"]}
    assert read_sql(spark, db, "SELECT * FROM nation WHERE n_name = :n", {"n": "' OR 1=1 --"}).count() == 0
    got = metadata.column_details(spark, {("d", "t"): spark.createDataFrame([], "a decimal(9,2), b array<int>, c string")}).orderBy("ordinal").collect()
    assert [(r.col, r.type, r.precision, r.scale, r.element) for r in got] == [("a", "decimal", 9, 2, None), ("b", "array", None, None, "int"), ("c", "string", None, None, None)]


def test_schedules():
    at = datetime(2024, 1, 1, 0, 7)  # a Monday
    for schedule, want in {"*/15 * * * *": (2024, 1, 1, 0, 15), "0 3 29 2 *": (2024, 2, 29, 3, 0), "30 2 * * 7": (2024, 1, 7, 2, 30), "0 0 15 * 3": (2024, 1, 3, 0, 0), "5,7 0-1 * * *": (2024, 1, 1, 1, 5), "7 0 1 1 *": (2025, 1, 1, 0, 7)}.items():
        assert next_run(schedule, at) == datetime(*want), schedule
    assert allowed("1-10/3", 0, 59) == {1, 4, 7, 10}
    for bad in ("* * * *", "61 * * * *", "5-1 * * * *", "*/0 * * * *", "0 0 31 2 *"):
        with pytest.raises(ValueError):
            next_run(bad, at)


def test_runner_retries_tells_and_starts_dependent_jobs(spark):
    tries, seen, called, slept = {"a": 0, "b": 0, "c": 0}, [], [], []

    class Flaky(Job):
        name = ""

        def __init__(self, label, good_after):
            self.label, self.good_after = label, good_after

        def run(self, **_):
            tries[self.label] += 1
            return JobResult(tries[self.label] > self.good_after, "x" * 900)

    runner = Runner({"a": Flaky("a", 1), "b": Flaky("b", 0), "c": Flaky("c", 9)}, depends_on={"b": "a", "c": "b", "a": "b"}, retries=2, webhook="mem://w", sleep=slept.append, transport=lambda *x: called.append(json.loads(x[2])))
    runner.listeners += [lambda e, d: 1 / 0, lambda e, d: seen.append((e, d["job"]))]
    assert runner.run("a").success and tries == {"a": 2, "b": 1, "c": 3} and slept == [5.0, 5.0, 10.0]
    assert len(called) == 1 and called[0]["job"] == "c" and len(called[0]["error"]) == 500 and called[0]["retries"] == 2
    assert [x for x in seen if x[1] == "b"] == [("job_start", "b"), ("job_complete", "b")]
    runner.running.add(("b", "{}"))
    assert not runner.run("b").success and tries["b"] == 1
    runner.running.clear()
    runner.serve("b", "* * * * *", now=lambda: NOW, times=2)
    assert tries["b"] == 3 and 60.0 in slept


def test_check_jobs(spark, tmp_path):
    jobs = registry()
    src, cfg = f"{tmp_path}/src", lambda name, body: (tmp_path / name).write_text(json.dumps(body)) and str(tmp_path / name)
    db = {"type": "parquet", "dbname": src, "id": "d"}
    rows = lambda *x: spark.createDataFrame(list(x), "id int, at timestamp_ntz, v string")
    rows((1, datetime(2024, 1, 1), "a"), (2, datetime(2024, 1, 2), "b")).write.parquet(f"{src}/t.parquet")
    inc = cfg("i.json", {"source": db, "store": f"file://{tmp_path}/st", "tables": [{"table": "t", "keys": ["id"], "timestamp_column": "at"}, {"table": "none", "keys": ["id"], "timestamp_column": "at"}]})
    assert "t: 2 candidates" in jobs["incremental_sync"](spark).execute(config=inc).message
    meta = cfg("m.json", {"source": db, "out": f"{tmp_path}/snap", "tables": ["t"], "keys": {"t": ["id"]}})
    assert jobs["metadata_snapshot"](spark).execute(config=meta, now="1").success
    assert jobs["schema_drift"](spark).execute(snapshots=f"{tmp_path}/snap").success and jobs["freshness_check"](spark).execute(snapshots=f"{tmp_path}/snap").success
    rows((1, datetime(2024, 1, 1), "never"), (2, datetime(2024, 1, 2), "c"), (3, datetime(2024, 1, 3), "d")).write.mode("overwrite").parquet(f"{src}/t.parquet")
    spark.catalog.clearCache()
    assert "t: 2 candidates" in jobs["incremental_sync"](spark).execute(config=inc).message
    assert sorted((r.id, r.v) for r in TableStore(spark, f"file://{tmp_path}/st").read("t").collect()) == [(1, "a"), (2, "c"), (3, "d")]
    assert jobs["metadata_snapshot"](spark).execute(config=meta, now="2").success
    assert jobs["freshness_check"](spark).execute(snapshots=f"{tmp_path}/snap").message == "0 stale"
    spark.createDataFrame([(1, 2.0), (2, 3.0), (3, 4.0)], "id int, v double").write.mode("overwrite").parquet(f"{src}/t.parquet")
    assert jobs["metadata_snapshot"](spark).execute(config=meta, now="3").success
    drift = jobs["schema_drift"](spark).execute(snapshots=f"{tmp_path}/snap")
    assert not drift.success and "2 breaking" in drift.message and "dropped_column d.t at" in drift.message
    assert jobs["freshness_check"](spark).execute(snapshots=f"{tmp_path}/snap").message == "1 stale; d.t"


def test_json_files_and_running_jobs(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    at = f"{tmp_path}/j"
    metadata.append_json(df, at)
    metadata.append_json(df, at)
    assert metadata.json_documents(spark, at, "k int, v string", lines=True).count() == 2
    metadata.replace_json(df, at)
    assert [tuple(r) for r in metadata.json_documents(spark, at, "k int, v string", lines=True).collect()] == [(1, "a")]


def test_api_enrich_job(spark, tmp_path):
    job = registry()["api_enrich"](spark)
    job.transport = echo
    cfg = {"source": {"type": "parquet", "dbname": D}, "dbs": {"r": {"connection": {"type": "parquet", "dbname": D}, "tables": ["region"]}}, "store": f"file://{tmp_path}/st", "tables": [{"source_table": "region", "target_table": "o", "source_columns": ["r_name"], "url": "mem://{r_name}/{r_regionkey}", "mapping": [{"json_path": "v", "column": "v"}], "queries": [{"name": "q", "db": "r", "sql": "SELECT r_name AS again FROM region WHERE r_regionkey = :r_regionkey"}]}, {"source_table": "nothing", "target_table": "n"}]}
    (tmp_path / "c.json").write_text(json.dumps(cfg))
    out = job.execute(config=str(tmp_path / "c.json"))
    assert not out.success and out.rows_affected == 3 and "skipped 1, empty 0, failed 1" in out.message and "n: " in out.message
