"""Lineage, run history, schedules, search and ordering over the catalog."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

EDGE = ["src", "dst", "label"]


def referenced_by(fks: DataFrame) -> DataFrame:
    """JOIN-11: from (db, tbl, name, ref) the keys that point at each table of the same database."""
    return fks.groupBy("db", F.col("ref").alias("tbl")).agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_list(F.concat("tbl", F.lit("."), "name"))), ",").alias("referenced_by"))


def neighbours(edges: DataFrame, node: str) -> DataFrame:
    """JOIN-12: one step up and down of a table, with the edge's label."""
    up = edges.where(F.col("dst") == node).select(F.lit("upstream").alias("direction"), F.col("src").alias("node"), "label")
    return up.unionByName(edges.where(F.col("src") == node).select(F.lit("downstream").alias("direction"), F.col("dst").alias("node"), "label"))


def neighbourhood(edges: DataFrame, node: str) -> DataFrame:
    """JOIN-17: distinct tables one step away."""
    return neighbours(edges, node).select("node").distinct()


def closure(spark, edges: DataFrame, start: str) -> DataFrame:
    """An extension: everything downstream of a table and its least number of steps, breadth first without a cap on depth."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or "file://" + tempfile.mkdtemp(prefix="tablemill-"))
    edges = edges.select("src", "dst").distinct().checkpoint()
    seen = front = spark.range(1).select(F.lit(start).alias("node"), F.lit(0).alias("depth"))
    while not front.isEmpty():
        new = edges.join(front, edges["src"] == front["node"]).select(F.col("dst").alias("node"), (F.col("depth") + 1).alias("depth")).distinct()
        known = seen.select(F.col("node").alias("known"))
        front = new.join(known, F.col("node").eqNullSafe(F.col("known")), "left_anti").checkpoint()
        seen = seen.unionByName(front).checkpoint()
    return seen


def known_edges(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """JOIN-13: edges with both ends among the nodes."""
    return edges.join(nodes.select(F.col("node").alias("src")), "src", "left_semi").join(nodes.select(F.col("node").alias("dst")), "dst", "left_semi").select(*EDGE)


def table_order(tables: DataFrame, edges: DataFrame) -> DataFrame:
    """SRT-8: within a database, connected tables by their first edge, then the rest by their position."""
    ends = edges.select("pos", F.col("src").alias("node")).unionByName(edges.select("pos", F.col("dst").alias("node"))).groupBy("node").agg(F.min("pos").alias("first"))
    w = Window.partitionBy("db").orderBy(F.asc_nulls_last("first"), "pos")
    return tables.join(ends, "node", "left").withColumn("rank", F.row_number().over(w).cast("bigint")).select("db", "node", "rank")


def topological(nodes: list[str], edges: list[tuple[str, str]], roots: list[str] = ()) -> list[str]:
    """SRT-6: sources first, roots before others, what lies on a cycle last in input order; repeated edges count once."""
    pending = {n: set() for n in nodes}
    for a, b in edges:
        if a in pending and b in pending and a != b:
            pending[b].add(a)
    order = sorted(nodes, key=lambda n: n not in roots)
    out: list[str] = []
    while ready := next((n for n in order if n not in out and pending[n] <= set(out)), None):
        out.append(ready)
    return out + [n for n in nodes if n not in out]


def db_order(dbs: DataFrame) -> DataFrame:
    """SRT-7: a given order beats the topological one; 0 is an order, none comes last."""
    return dbs.withColumn("rank", F.row_number().over(Window.orderBy(F.asc_nulls_last("canvas_order"), "topo")).cast("bigint"))  # a row a database


def job_stats(runs: DataFrame) -> DataFrame:
    """AGG-8, WIN-1: last success, last failure and current run of failures; from aggregates alone, so a job with many
    runs is reduced before it is exchanged."""
    last = runs.groupBy("job").agg(F.max(F.when(F.col("success"), F.struct("finished_at", "run_id"))).alias("ok"), F.max(F.when(F.col("success"), F.col("finished_at"))).alias("last_success"), F.max(F.when(~F.col("success"), F.col("finished_at"))).alias("last_failure"))
    after = runs.join(last.select("job", "ok"), "job").where(~F.col("success") & (F.col("ok").isNull() | (F.struct("finished_at", "run_id") > F.col("ok"))))
    return last.drop("ok").join(after.groupBy("job").agg(F.count("*").alias("fail_streak")), "job", "left").withColumn("fail_streak", F.coalesce("fail_streak", F.lit(0)).cast("bigint"))


def last_run(runs: DataFrame) -> DataFrame:
    """AGG-11."""
    best = runs.groupBy("job").agg(F.max_by(F.struct("run_id", "success", "finished_at"), F.struct("finished_at", "run_id")).alias("r"))
    return best.select("job", "r.run_id", "r.success", "r.finished_at")


def pruned(runs: DataFrame, before) -> DataFrame:
    """FLT-17, as a plain filter (Q20)."""
    return runs.where(F.col("finished_at") >= F.lit(before))


def timeline(runs: DataFrame, drifts: DataFrame, most: int = 200, message: int = 100) -> DataFrame:
    """SET-3, SRT-2, FUN-23: runs and drift events, newest first."""
    a = runs.select(F.lit("run").alias("kind"), F.col("run_id").alias("id"), "finished_at", F.substring("message", 1, message).alias("text"))
    b = drifts.select(F.lit("drift").alias("kind"), "id", "finished_at", F.substring("text", 1, message).alias("text"))
    return a.unionByName(b).orderBy(F.desc("finished_at"), F.desc("id"), "kind").limit(most)


def tail(log: DataFrame, most: int = 500, db: str | None = None, tbl: str | None = None) -> DataFrame:
    """SRC-17, FLT-11, SRT-3: the last entries in time order."""
    for c, v in (("db", db), ("tbl", tbl)):
        log = log if v is None else log.where(F.col(c) == v)
    return log.orderBy(F.desc("ts"), F.desc("id")).limit(most).orderBy("ts", "id")


def search(tables: DataFrame, query: str) -> DataFrame:
    """FLT-12."""
    q = F.lower(F.lit(query))
    hit = F.lit(False)
    for c in ("label", "tbl", "db"):
        hit = hit | F.lower(F.col(c)).contains(q)
    return tables.where(F.coalesce(hit, F.lit(False)))


PRIORITY = {"running": 3, "failed": 2, "scheduled": 1}


def schedule_state(schedules: DataFrame, running: DataFrame, last: DataFrame) -> DataFrame:
    """JOIN-15, SET-9: running beats failed beats scheduled."""
    r = running.select("job", F.lit(True).alias("is_running")).distinct()
    out = schedules.join(r, "job", "left").join(last.select("job", F.col("success").alias("last_ok")), "job", "left")
    state = F.when(F.col("is_running"), "running").when(~F.col("last_ok"), "failed").otherwise("scheduled")
    return out.withColumn("state", state).drop("is_running")


def targets_of(schedules: DataFrame, tables: DataFrame) -> DataFrame:
    """SET-10, JOIN-18: explicit targets beat the scope; all_dbs takes databases, all_tables takes tables."""
    given = schedules.where("size(targets) > 0").select("schedule_id", F.explode("targets").alias("t")).select("schedule_id", "t.db", "t.tbl")
    free = schedules.where("coalesce(size(targets), 0) <= 0")
    dbs = free.where("scope = 'all_dbs'").select("schedule_id").join(tables.select("db").distinct()).select("schedule_id", "db", F.lit(None).cast("string").alias("tbl"))
    every = free.where("scope = 'all_tables'").select("schedule_id").join(tables.select("db", "tbl")).select("schedule_id", "db", "tbl")
    return given.unionByName(dbs).unionByName(every)


def worst(states: DataFrame) -> DataFrame:
    """AGG-12, AGG-13: jobs once, the worst state of each node."""
    rank = F.when(F.col("state") == "running", 3).when(F.col("state") == "failed", 2).otherwise(1)
    out = states.groupBy("node").agg(F.max(rank).alias("r"), F.count_distinct("job").alias("jobs"))
    return out.select("node", F.when(F.col("r") == 3, "running").when(F.col("r") == 2, "failed").otherwise("scheduled").alias("state"), "jobs")


def badges(columns: DataFrame, keys: DataFrame) -> DataFrame:
    """JOIN-16: whether a column is in the primary key or in a foreign key."""
    return columns.select("db", "tbl", "col").join(keys, ["db", "tbl"], "left").select("db", "tbl", "col", F.coalesce(F.array_contains("pk", F.col("col")), F.lit(False)).alias("is_pk"), F.coalesce(F.array_contains("fk", F.col("col")), F.lit(False)).alias("is_fk"))


def annotate(old: DataFrame, new: DataFrame, at: str) -> DataFrame:
    """SET-7: a shallow merge of (key, name, value) rows; a key that changes is stamped."""
    stamped = new.unionByName(new.select("key").distinct().select("key", F.lit("updatedAt").alias("name"), F.lit(at).alias("value")))
    return old.join(stamped.select("key", "name"), ["key", "name"], "left_anti").unionByName(stamped)


def merge_config(static: DataFrame, found: DataFrame) -> DataFrame:
    """SET-5, SET-6: given edges without the placeholders, and all that were discovered; copies stay."""
    return static.where("src <> 'auto' AND dst <> 'auto'").unionByName(found)


def is_running(running: DataFrame, job: str, args_json: str) -> bool:
    """FLT-18."""
    return running.where((F.col("job") == job) & (F.col("args") == args_json)).limit(1).count() > 0


def running(runs: DataFrame, asked: DataFrame) -> DataFrame:
    """FLT-18 for many: whether a run of each asked job goes on with equal arguments."""
    now = runs.select("job", "args").distinct().withColumn("running", F.lit(True))
    return asked.join(now, ["job", "args"], "left").withColumn("running", F.coalesce("running", F.lit(False)))
