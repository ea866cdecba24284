"""Driver-side helpers, the table store, sync runs, sources and jobs."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tablemill.__main__ import main
from tablemill.functions import naming, text, timespec, types
from tablemill.jobs import registry
from tablemill.jobs.base import Job, JobResult, roll_up
from tablemill.operators import catalog, enrich, sync
from tablemill.plans import sync as plans
from tablemill.plans.store import TableStore
from tablemill.sources import http, metadata
from tablemill.sources.registry import Registry, expand_env, probe, url

NOW = datetime(2024, 2, 1)


def test_relative_times():
    assert timespec.parse_relative(" 30D ") == timedelta(days=30) and timespec.parse_relative("2024-01-01") is None
    assert timespec.resolve_since("12h", NOW) == "2024-01-31T12:00:00" and timespec.resolve_since("2024-01-01", NOW) == "2024-01-01"
    timespec.validate_retention("t", "30d", "7d", "ts")
    for keep, since, col in (("7d", "7d", "ts"), ("7d", "2024-01-01", "ts"), ("2024-01-02", "2024-01-01", "ts"), ("7d", None, None)):
        with pytest.raises(ValueError):
            timespec.validate_retention("t", keep, since, col)


def test_types():
    assert types.column_store_type("numeric", precision=10, scale=0) == "Decimal(10, 0)" and types.column_store_type("bigint", nullable=True) == "Nullable(Int64)"
    assert types.unwrap("LowCardinality(Nullable(String))") == "String" and types.column_store_type("what") == "String"
    assert types.source_type({"pg_type": "character varying", "max_length": 9}) == "character varying(9)" and types.source_type({"pg_type": "ARRAY", "udt_name": "_int4"}) == "integer[]"
    assert types.source_type({"pg_type": "USER-DEFINED"}) == "text" and types.source_type({"pg_type": "numeric", "precision": 5, "scale": 2}) == "numeric(5,2)"


def test_null_coercion_and_text_numbers(spark):
    df = spark.createDataFrame([(None, None, "-12"), (-12.7, b"\xab", "5")], "a double, b binary, c string")
    out = sync.project(df, types={"a": "Int32", "b": "String", "c": "Int64"}, required=["a", "b", "c"])
    assert [tuple(r) for r in out.collect()] == [(0, "", -12), (-12, "ab", 5)]


def test_names(spark):
    assert naming.split_name("a.b.c") == ("a", "b.c") and naming.split_name("t") == ("public", "t")
    df = spark.createDataFrame([("log1",), ("logx",), ("a.b",)], "n string")
    assert [r.n for r in df.where(naming.included(F.col("n"), None, ["log[0-9]"])).collect()] == ["logx", "a.b"]
    schemas = spark.createDataFrame([("sys",), ("dbo",)], "schema string")
    assert naming.user_schemas(schemas, "mssql").count() == 1


def test_merge_rules(spark):
    rows = lambda x: spark.createDataFrame(x, "k long, v string")
    got = lambda df: sorted(map(tuple, df.collect()), key=repr)
    old, new = rows([(1, "a"), (2, "b"), (None, "n")]), rows([(2, "x"), (2, "y"), (None, "m")])
    assert got(sync.merge(old, new, "replace", ["k"])) == got(rows([(1, "a"), (None, "n"), (2, "x"), (2, "y"), (None, "m")]))
    assert got(sync.merge(old, new, "upsert", ["k"], [F.col("v")])) == got(rows([(1, "a"), (None, "n"), (2, "y"), (None, "m")]))
    assert got(sync.merge(old, old.limit(0), "replace", ["k"])) == got(old)
    assert sync.merge(rows([(1, "a")]), rows([(1, "a"), (2, "b"), (2, "b")]), "upsert", ["k", "v"]).count() == 2
    for strategy, keys in (("what", ["k"]), ("upsert", [])):
        with pytest.raises(ValueError):
            sync.merge(old, new, strategy, keys)


def test_empty_target_takes_the_first_days(spark):
    df = spark.sql("SELECT id, timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, cast(id as int)) AS ts FROM range(10)")
    assert sync.delta_from_target(df, df.limit(0), "ts", 30, datetime(2024, 1, 5)).count() == 5


def test_sync_runs_and_replays(spark, tmp_path):
    store = TableStore(spark, f"file://{tmp_path}/store")
    rows = lambda a, b: spark.sql(f"SELECT id, timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, cast(id as int)) AS ts, 'x' AS gone, id * 1.5D AS v FROM range({a}, {b})")
    plan = plans.SyncPlan("s", "t", timestamp_column="ts", overlap_minutes=2 * 24 * 60, strategy="upsert", keys=["id"], drop_columns=["gone"], types={"v": "Int64"})
    assert plans.run(plan, rows(0, 10), store, NOW) == 10 and store.watermark("t") == "2024-01-10T00:00:00"
    assert plans.run(plan, rows(0, 12), store, NOW) == 4  # two days of overlap, then two new days; strictly after the cutoff
    assert sorted(tuple(r) for r in store.read("t").select("id", "v").collect()) == [(k, int(k * 1.5)) for k in range(12)]
    assert plans.run(plan, rows(0, 12), store, NOW) == 2 and store.read("t").count() == 12  # a replay changes nothing
    store.truncate("t")
    assert store.read("t").count() == 0 and store.watermark("t") == "2024-01-12T00:00:00"
    copy = plans.SyncPlan("s", "c")
    plans.run(copy, rows(0, 5), store, NOW)
    assert plans.run(copy, rows(0, 3), store, NOW) == 3 and store.read("c").count() == 3  # a full copy replaces
    for bad in ({"sync_since": "1d"}, {"strategy": "upsert"}):
        with pytest.raises(ValueError):
            plans.SyncPlan("s", "t", **bad)


def test_typed_cutoffs():
    assert plans.parse("77") == 77 and sync.cutoff(77, 30) == 77 and sync.cutoff(None, 5, NOW) == NOW and sync.cutoff(NOW, 60) == datetime(2024, 1, 31, 23)


def test_registry(tmp_path, monkeypatch):
    r = Registry(tmp_path / "db.json")
    assert r.load() == [] and r.get("x") is None
    r.add({"id": "a", "type": "postgresql", "host": "h", "dbname": "d", "password": "é"})
    assert r.get("a")["password"] == "é" and r.get("a")["port"] == 5432 and "é" not in (tmp_path / "db.json").read_text()
    with pytest.raises(KeyError):
        r.add({"id": "a", "type": "postgresql", "host": "h", "dbname": "d"})
    with pytest.raises(ValueError):
        r.add({"id": "b", "type": "postgresql"})
    r.reorder(["a"])
    r.update("a", host="g")
    assert (r.get("a")["canvas_order"], r.get("a")["host"]) == (0, "g")
    r.remove("a")
    assert r.load() == []
    monkeypatch.setenv("KNOWN", "v")
    assert expand_env("${KNOWN} ${NOT_KNOWN}") == "v ${NOT_KNOWN}"
    assert url({"type": "mssql", "host": "h", "dbname": "d"}) == "jdbc:sqlserver://h:1433;databaseName=d" and url({"type": "sqlite", "dbname": "/x.db"}) == "jdbc:sqlite:/x.db"
    with pytest.raises(ValueError):
        url({"type": "other", "dbname": "d"})


def test_probe(spark):
    def broken(*_):
        raise RuntimeError("e" * 500)

    assert [len(x["error"]) for x in probe(spark, [{"id": "a", "type": "sqlite", "dbname": "x"}], broken)] == [200]


def _answer(method, url, body, headers, timeout):
    if body is None:
        if url.endswith("3"):
            raise OSError
        return '{"u": "%s"}' % url
    return json.dumps({"results": [{"code": k, "status": k * 2} for k in reversed(json.loads(body)["ids"]) if k != 4]})


def test_fetch(spark):
    df = spark.range(6).select("id", F.concat(F.lit("/x/"), "id").alias("url"))
    got = {r.id: r.response for r in http.fetch(df, transport=_answer).collect()}
    assert got[3] is None and json.loads(got[2]) == {"u": "/x/2"}
    many = http.fetch_batches(df.select("id"), url="/b", key="id", batch_key="ids", array="results", id_field="code", size=2, transport=_answer)
    assert {r.id: r.response and json.loads(r.response)["status"] for r in many.collect()} == {0: 0, 1: 2, 2: 4, 3: 6, 4: None, 5: 10}


def test_json_paths_and_validation(spark):
    df = spark.createDataFrame([('{"a": {"b": [1, 2]}, "s": "x", "n": null}',)], "r string")
    pick = lambda p, k="string": df.select(text.json_path(F.col("r"), p, k)).first()[0]
    assert pick("a.b[1]", "int") == 2 and pick("a.b[9]") is None and pick("n") is None and pick("s", "int") is None and pick("a.x") is None
    enrich.validate({"write_strategy": "insert"}, {"mode": "per_row"})
    for t, a in (({"source_queries": [1]}, {"mode": "batch", "batch_key": "x"}), ({}, {"mode": "batch"}), ({"write_strategy": "upsert"}, {}), ({"sync_since": "1d"}, {})):
        with pytest.raises(ValueError):
            enrich.validate(t, a)


def test_topological_order():
    assert catalog.topological(["c", "b", "a"], [("a", "b"), ("b", "c"), ("a", "b")]) == ["a", "b", "c"]
    assert catalog.topological(["a", "b", "c"], [("a", "b"), ("b", "a")]) == ["c", "a", "b"]
    assert catalog.topological(["a", "b", "c", "d"], [("a", "b"), ("a", "c"), ("b", "d"), ("c", "d")]) == ["a", "b", "c", "d"]


def test_snapshots_and_edges(spark, tmp_path):
    at = f"{tmp_path}/snap"
    for k in (1, 2, 3):
        metadata.snapshot(spark.range(k), at, f"2024-01-0{k}")
    cur, prev = metadata.last_two(spark, at)
    assert (cur.count(), prev.count()) == (3, 2)
    path = tmp_path / "c.json"
    path.write_text(json.dumps({"source": "a", "target": "b", "tables": [{"source_table": "s.t", "target_table": "u"}]}))
    assert metadata.config_edges(path) == [{"from": "a:s.t", "to": "b:public.u", "label": "sync"}] and metadata.config_edges(tmp_path / "no") == []
    (tmp_path / "o").mkdir()
    (tmp_path / "o/x.bin").write_bytes(b"123")
    assert metadata.objects(spark, f"{tmp_path}/o").first().size == 3


def test_jobs(spark, tmp_path, capsys):
    assert {"table_sync", "fk_integrity", "table_profiler", "connection_test"} <= set(registry())

    class Broken(Job):
        name = ""

        def run(self, **_):
            raise RuntimeError("no")

    out = Broken(spark).execute()
    assert not out.success and out.message == "no" and out.to_dict()["finished_at"]
    assert roll_up({"a": 3, "b": ValueError("x")}).to_dict()["rows_affected"] == 3
    cfg = {"source": {"type": "parquet", "dbname": "/root/testdata/sf0.001"}, "store": f"file://{tmp_path}/st", "tables": [{"source_table": "orders", "target_table": "o", "timestamp_column": "o_orderdate"}, {"source_table": "nothing", "target_table": "n"}]}
    (tmp_path / "s.json").write_text(json.dumps(cfg))
    done = registry()["table_sync"](spark).execute(config=str(tmp_path / "s.json"))
    assert not done.success and done.rows_affected == 1500 and "1 of 2" in done.message
    assert main(["list"]) == 0 and "table_sync" in capsys.readouterr().out
    assert isinstance(done, JobResult)


def test_closure_has_no_cap_and_walks_no_path_twice(spark):
    chain = [(f"n{k}", f"n{k + 1}", "x") for k in range(25)]
    more = [("n1", "m", "x"), ("m", "n2", "x"), ("n3", "n0", "x"), ("n3", "n4", "y"), ("z", "n0", "x"), ("n2", None, "x"), ("n5", None, "x")]
    got = catalog.closure(spark, spark.createDataFrame(chain + more, "src string, dst string, label string"), "n0").collect()
    assert sorted((str(r.node), r.depth) for r in got) == sorted([*((f"n{k}", k) for k in range(26)), ("m", 2), ("None", 3)])


def test_array_types_and_system_schemas(spark):
    assert [types.source_type({"pg_type": "ARRAY", "udt_name": x}) for x in ("_inet", "_char", "_unknown")] == ["inet[]", "character[]", "text[]"]
    schemas = spark.createDataFrame([("db_owner",), ("dbo",), ("guest",)], "schema string")
    assert [r.schema for r in naming.user_schemas(schemas, "mssql").collect()] == ["dbo"]


def test_batches_of_scalars_and_repeated_ids(spark):
    from tablemill.sources.http import fetch_batches

    rows = spark.createDataFrame([(1,), (2,), (2,)], "id long").coalesce(1)
    scalars = fetch_batches(rows, url="u", key="id", batch_key="ids", id_field="id", transport=lambda *a: '[1, null, {"id": 2, "v": 3}]')
    assert sorted((r.id, r.response) for r in scalars.collect() if r.response) == [(2, '{"id": 2, "v": 3}')] * 2
    by_place = fetch_batches(rows, url="u", key="id", batch_key="ids", transport=lambda *a: "[10, 20, 30]")
    assert sorted((r.id, r.response) for r in by_place.collect()) == [(1, "10"), (2, "20"), (2, "30")]


def test_repeated_stream_batches_and_vacuum(spark, tmp_path):
    """A batch that was committed but not noted by the stream comes again; appended rows must not double."""
    from tablemill.plans.store import TableStore
    from tablemill.streaming.delta import merge_stream

    store, schema = TableStore(spark, f"file://{tmp_path}/store"), "id long, v long"

    def go():
        merge_stream(spark, f"{tmp_path}/in", schema, store, "t", f"{tmp_path}/state", keys=["id"], order=["v"], strategy="insert")

    for k in range(3):
        spark.createDataFrame([(k, k)], schema).write.mode("append").parquet(f"{tmp_path}/in")
        go()
    assert store.read("t").count() == 3
    for name in ("2", ".2.crc"):  # as if the run had ended between the table's commit and the stream's
        (tmp_path / "state" / "commits" / name).unlink(missing_ok=True)
    go()
    assert store.read("t").count() == 3
    assert store.vacuum("t", keep=1) == 2 and store.vacuum("t", keep=1) == 0 and sorted(r.id for r in store.read("t").collect()) == [0, 1, 2]
