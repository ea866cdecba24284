"""The registered queries of the table, quality, catalog and enrichment operators, each beside its SQL."""

from __future__ import annotations

import tempfile
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablemill.functions import naming, text, timespec
from tablemill.operators import catalog, enrich, quality, sync
from tablemill.operators.context import Context, run_queries, with_objects
from tablemill.plans import enrich as rows
from tablemill.plans import tables as made
from tablemill.sources import metadata, registry

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    def add(fn):
        QUERIES[name or fn.__name__] = fn
        if sql:
            SQL[name or fn.__name__] = sql
        return fn

    return add


def t(spark: SparkSession, d: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{table}.parquet")


def values(rows: list[tuple], cols: list[str]) -> str:
    """Rows as a SQL relation that Spark and DuckDB both read."""
    show = lambda v: "NULL" if v is None else str(v).upper() if isinstance(v, bool) else repr(v) if not isinstance(v, str) else "'" + v.replace("'", "''") + "'"
    return f"(SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(show, r)) + ')' for r in rows)}) AS v({', '.join(cols)}))"


def rel(spark: SparkSession, rows: list[tuple], cols: list[str]) -> DataFrame:
    return spark.sql(f"SELECT * FROM {values(rows, cols)} x")


# ---- delta extraction -------------------------------------------------------------------------------------------------

FROM, SINCE = datetime(2024, 1, 20), datetime(2024, 1, 25)


@query("SELECT event_id, ts, user_id FROM events WHERE ts > TIMESTAMP '2024-01-20'")
def delta_extract(spark, d):
    return sync.delta(t(spark, d, "events").select("event_id", "ts", "user_id"), "ts", FROM)


@query("SELECT event_id, ts FROM events WHERE ts > TIMESTAMP '2024-01-19 22:30:00'")
def delta_with_overlap(spark, d):
    return sync.delta(t(spark, d, "events").select("event_id", "ts"), "ts", sync.cutoff(FROM, 90))


@query("SELECT event_id, ts FROM events WHERE ts > TIMESTAMP '2024-01-25'")
def delta_since_floor(spark, d):
    return sync.delta(t(spark, d, "events").select("event_id", "ts"), "ts", sync.cutoff(FROM, 30, SINCE))


@query("SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate > (SELECT max(o_orderdate) - INTERVAL 30 MINUTE FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01')")
def delta_from_target_max(spark, d):
    orders = t(spark, d, "orders").select("o_orderkey", "o_orderdate")
    return sync.delta_from_target(orders, orders.where("o_orderdate < '2000-01-01'"), "o_orderdate", 30)


@query("SELECT event_id, ts FROM events WHERE event_id > 2000 AND ts >= TIMESTAMP '2024-01-20'")
def delta_split_watermark(spark, d):
    return sync.delta(t(spark, d, "events").select("event_id", "ts"), "event_id", 2000, FROM, "ts")


# ---- projection and types ----------------------------------------------------------------------------------------------


@query("SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders")
def full_copy_projection(spark, d):
    return sync.project(t(spark, d, "orders"), drop=["o_orderpriority"], types={"o_totalprice": "Decimal(18, 2)", "o_orderdate": "Date"})


@query("SELECT l_orderkey, CAST(trunc(l_extendedprice) AS BIGINT) AS price, CAST(l_discount AS DECIMAL(18,4)) AS discount, CAST(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS SMALLINT) AS returned, lower(hex(l_linestatus)) AS status FROM lineitem")
def type_mapping_cast(spark, d):
    rows = t(spark, d, "lineitem").select("l_orderkey", F.col("l_extendedprice").alias("price"), F.col("l_discount").alias("discount"), (F.col("l_returnflag") == "R").alias("returned"), F.col("l_linestatus").cast("binary").alias("status"))
    return sync.project(rows, types={"price": "Int64", "discount": "Decimal(18, 4)", "returned": "UInt8", "status": "String"})


@query("SELECT c_custkey, coalesce(o_orderkey, 0) AS o_orderkey, coalesce(o_orderstatus, '') AS o_orderstatus, coalesce(o_orderdate, TIMESTAMP '1970-01-01') AS o_orderdate FROM customer LEFT JOIN (SELECT * FROM orders WHERE o_orderkey % 2 = 0) o ON c_custkey = o_custkey")
def null_coerce_defaults(spark, d):
    both = t(spark, d, "customer").join(t(spark, d, "orders").where("o_orderkey % 2 = 0"), F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", "o_orderkey", "o_orderstatus", "o_orderdate")
    kinds = {"o_orderkey": "Int64", "o_orderstatus": "String", "o_orderdate": "DateTime64(6)"}
    return sync.project(both, types=kinds, required=list(kinds))


# ---- merges --------------------------------------------------------------------------------------------------------------


@query("SELECT * FROM orders WHERE o_orderkey % 3 = 0 AND o_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderdate > TIMESTAMP '1999-01-01') UNION ALL SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '1999-01-01'")
def delta_merge(spark, d):
    orders = t(spark, d, "orders")
    return sync.replace_merge(orders.where("o_orderkey % 3 = 0"), sync.delta(orders, "o_orderdate", datetime(1999, 1, 1)), ["o_orderkey"])


@query("WITH s AS (SELECT conv_id, turn, role, 'new ' || text AS text FROM conversations WHERE conv_id % 2 = 0) SELECT c.conv_id, c.turn, c.role, c.text FROM conversations c LEFT JOIN s USING (conv_id, turn) WHERE c.turn < 4 AND s.role IS NULL UNION ALL SELECT * FROM s")
def merge_upsert(spark, d):
    rows = t(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    new = rows.where("conv_id % 2 = 0").withColumn("text", F.concat(F.lit("new "), "text"))
    return sync.merge(rows.where("turn < 4"), new, "upsert", ["conv_id", "turn"], [F.col("role"), F.col("text")])


@query("WITH a AS (SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem), s AS (SELECT * FROM a WHERE l_orderkey % 5 = 0) SELECT a.* FROM a WHERE l_quantity > 25 AND NOT EXISTS (SELECT 1 FROM s WHERE s.l_orderkey = a.l_orderkey AND s.l_linenumber = a.l_linenumber) UNION ALL SELECT * FROM s")
def merge_replace(spark, d):
    rows = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return sync.merge(rows.where("l_quantity > 25"), rows.where("l_orderkey % 5 = 0"), "replace", ["l_orderkey", "l_linenumber"])


@query("SELECT p_partkey FROM part WHERE p_partkey % 2 = 0 UNION ALL SELECT p_partkey FROM part WHERE p_partkey % 3 = 0 AND p_partkey % 2 <> 0")
def merge_insert_ignore(spark, d):
    keys = t(spark, d, "part").select("p_partkey")
    return sync.insert_ignore(keys.where("p_partkey % 2 = 0"), keys.where("p_partkey % 3 = 0"), ["p_partkey"])


@query("SELECT event_id, ts FROM events WHERE ts <= TIMESTAMP '2024-01-20' UNION ALL SELECT event_id, ts FROM events WHERE ts > TIMESTAMP '2024-01-19'")
def append_overlap_dupes(spark, d):
    rows = t(spark, d, "events").select("event_id", "ts")
    return sync.append(rows.where(F.col("ts") <= F.lit(FROM)), sync.delta(rows, "ts", sync.cutoff(FROM, 24 * 60)))


@query("WITH o AS (SELECT o_custkey, o_orderkey, o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS k FROM orders) SELECT o_custkey, o_orderkey, o_totalprice FROM o WHERE k = 1")
def latest_version_per_key(spark, d):
    return sync.latest(t(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate"), ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")]).drop("o_orderdate")


@query("WITH a AS (SELECT CASE WHEN event_id % 4 <> 0 THEN event_id END AS k, ts FROM events), s AS (SELECT * FROM a WHERE ts > TIMESTAMP '2024-01-20') SELECT a.* FROM a WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.k = a.k) UNION ALL SELECT * FROM s")
def merge_null_keys(spark, d):
    rows = t(spark, d, "events").select(F.when(F.col("event_id") % 4 != 0, F.col("event_id")).alias("k"), "ts")
    return sync.replace_merge(rows, sync.delta(rows, "ts", FROM), ["k"])


# ---- watermarks and retention -----------------------------------------------------------------------------------------------

STATES = [("a.orders", "ts", "2024-01-01", 1), ("a.orders", "ts", "2024-01-05", 3), ("a.orders", "id", "77", 2), ("b.events", "ts", "2024-02-01", 9), ("b.events", "ts", "2024-01-31", 4)]


@query(f"SELECT config_key, timestamp_column, arg_max(value, updated_at) AS value, max(updated_at) AS updated_at FROM {values(STATES, ['config_key', 'timestamp_column', 'value', 'updated_at'])} GROUP BY 1, 2")
def watermark_latest(spark, d):
    return sync.watermarks(rel(spark, STATES, ["config_key", "timestamp_column", "value", "updated_at"]))


@query("WITH b AS (SELECT event_id // 1000 AS batch, max(ts) AS batch_max FROM events WHERE event_id % 7 <> 0 GROUP BY 1) SELECT batch, batch_max, max(batch_max) OVER (ORDER BY batch) AS watermark FROM b")
def watermark_advance(spark, d):
    return sync.running_max(t(spark, d, "events").where("event_id % 7 <> 0").withColumn("batch", F.expr("event_id div 1000")), "ts", "batch")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 11 <> 0 THEN o_orderdate END AS o_orderdate FROM orders WHERE o_orderkey % 11 = 0 OR o_orderdate >= TIMESTAMP '1998-01-01'")
def retention_keep(spark, d):
    rows = t(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 11 != 0, F.col("o_orderdate")).alias("o_orderdate"))
    return sync.kept(rows, "o_orderdate", datetime(1998, 1, 1))


@query("SELECT event_type, count(*) AS purged FROM events WHERE ts < TIMESTAMP '2024-01-11' GROUP BY 1")
def retention_purge_counts(spark, d):
    return sync.purged(t(spark, d, "events"), "ts", datetime(2024, 1, 11)).groupBy("event_type").agg(F.count("*").alias("purged"))


# ---- quality ---------------------------------------------------------------------------------------------------------------

#: Edges, with the part of the parent that is kept so that orphans exist.
FKS = {
    "lineitem_orders": ("lineitem", "l_orderkey", "orders", "o_orderkey", "o_orderkey % 10 <> 0"),
    "lineitem_part": ("lineitem", "l_partkey", "part", "p_partkey", "p_partkey % 10 <> 1"),
    "lineitem_supplier": ("lineitem", "l_suppkey", "supplier", "s_suppkey", "s_suppkey % 10 <> 2"),
    "orders_customer": ("orders", "o_custkey", "customer", "c_custkey", "c_custkey % 10 <> 3"),
    "customer_nation": ("customer", "c_nationkey", "nation", "n_nationkey", "n_nationkey % 10 <> 4"),
    "supplier_nation": ("supplier", "s_nationkey", "nation", "n_nationkey", "n_nationkey % 10 <> 5"),
    "nation_region": ("nation", "n_regionkey", "region", "r_regionkey", "r_regionkey <> 1"),
}


def _fk_sql(name: str, where: bool) -> str:
    c, fk, p, pk, part = FKS[name]
    return f"SELECT '{name}' AS edge, count(*) AS orphans, count(*) = 0 AS ok FROM {c} LEFT JOIN (SELECT {pk} FROM {p}{' WHERE ' + part if where else ''}) p ON {fk} = {pk} WHERE {fk} IS NOT NULL AND {pk} IS NULL"


def _fk(spark, d, name: str, where: bool) -> DataFrame:
    c, fk, p, pk, part = FKS[name]
    parent = t(spark, d, p).where(part) if where else t(spark, d, p)
    return quality.orphan_count(name, t(spark, d, c), [fk], parent, [pk])


for _n in FKS:
    query(_fk_sql(_n, True), f"fk_orphans_{_n}")(lambda spark, d, n=_n: _fk(spark, d, n, True))


@query(" UNION ALL ".join(_fk_sql(n, False) for n in FKS))
def fk_report(spark, d):
    out = None
    for n in FKS:
        out = _fk(spark, d, n, False) if out is None else out.unionByName(_fk(spark, d, n, False))
    return out


@query("SELECT count(*) AS orphans FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM lineitem p WHERE p.l_linenumber <> 3 AND p.l_orderkey = l.l_orderkey AND p.l_partkey = l.l_partkey)")
def fk_composite(spark, d):
    rows = t(spark, d, "lineitem")
    parent = rows.where("l_linenumber <> 3").select(F.col("l_orderkey").alias("a"), F.col("l_partkey").alias("b"))
    return quality.orphans(rows, ["l_orderkey", "l_partkey"], parent, ["a", "b"]).agg(F.count("*").alias("orphans"))


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def uniqueness_check(spark, d):
    return sync.duplicates(t(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


#: Tables and the columns that are profiled; the first one has nulls put in.
PROFILES = {
    "customer": ["c_mktsegment", "c_custkey", "c_nationkey"],
    "orders": ["o_orderstatus", "o_orderkey", "o_custkey", "o_orderpriority"],
    "lineitem": ["l_returnflag", "l_orderkey", "l_linenumber", "l_linestatus"],
    "events": ["event_type", "event_id", "user_id", "props"],
    "part": ["p_brand", "p_partkey", "p_type", "p_size"],
    "supplier": ["s_name", "s_suppkey", "s_nationkey"],
    "documents": ["lang", "doc_id", "source", "n_chars"],
    "pages": ["url", "page_id"],
    "conversations": ["role", "conv_id", "turn"],
    "labels": ["quality", "doc_id", "toxic"],
}


def _profile_sql(table: str) -> str:
    cols = PROFILES[table]
    one = lambda c, e: f"SELECT '{c}' AS column_name, count(*) AS total, count({e}) AS non_null, CASE WHEN count(*) > 0 THEN round((1 - count({e}) / count(*)) * 100, 1) ELSE 0 END AS null_pct, count(DISTINCT {e}) AS cardinality FROM {table}"
    return " UNION ALL ".join(one(c, f"CASE WHEN {cols[1]} % 5 <> 0 THEN {c} END" if k == 0 else c) for k, c in enumerate(cols))


def _profile(spark, d, table: str) -> DataFrame:
    cols = PROFILES[table]
    rows = t(spark, d, table).withColumn(cols[0], F.when(F.col(cols[1]) % 5 != 0, F.col(cols[0]))).select(*cols)
    return quality.profile(rows)


for _n in PROFILES:
    query(_profile_sql(_n), f"profile_{_n}")(lambda spark, d, n=_n: _profile(spark, d, n))

#: The first ten columns of each table, as its schema has them; the queries take them from the table itself.
SCHEMA = {
    "region": ["r_regionkey", "r_name"],
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "supplier": ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"],
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"],
    "events": ["event_id", "ts", "user_id", "event_type", "value", "props"],
    "documents": ["doc_id", "text", "lang", "source", "n_chars"],
    "embeddings": ["vec_id", "embedding", "label"],
    "pages": ["page_id", "url", "html"],
    "benchmark": ["item_id", "text"],
    "labels": ["doc_id", "quality", "toxic"],
    "conversations": ["conv_id", "turn", "role", "text"],
}


def _full_sql(table: str) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) AS total, count({c}) AS non_null, CASE WHEN count(*) > 0 THEN round((1 - count({c}) / count(*)) * 100, 1) ELSE 0 END AS null_pct, count(DISTINCT {c}) AS cardinality FROM {table}" for c in SCHEMA[table])


for _n in SCHEMA:
    query(_full_sql(_n), f"profile_full_{_n}" if _n in PROFILES else f"profile_{_n}")(lambda spark, d, n=_n: quality.profile(t(spark, d, n)))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


@query(" UNION ALL ".join(f"SELECT '2024-01-01' AS ts, 'main' AS db, '{n}' AS tbl, count(*) AS row_count FROM {n}" for n in TABLES))
def rowcount_snapshot(spark, d):
    return metadata.row_counts({("main", n): t(spark, d, n) for n in TABLES}, "2024-01-01")


COUNTS = "SELECT 'main' AS db, event_type AS tbl, CAST(ts AS DATE) AS ts, count(*) AS row_count FROM events GROUP BY 1, 2, 3"


def _counts(spark, d) -> DataFrame:
    return t(spark, d, "events").groupBy(F.lit("main").alias("db"), F.col("event_type").alias("tbl"), F.col("ts").cast("date").alias("ts")).agg(F.count("*").alias("row_count"))


@query(f"WITH c AS ({COUNTS}) SELECT a.db, a.tbl, a.row_count AS cur, b.row_count AS prev, a.row_count = b.row_count AND a.row_count > 0 AS stale FROM c a JOIN c b ON a.tbl = b.tbl WHERE a.ts = DATE '2024-01-10' AND b.ts = DATE '2024-01-09'")
def freshness_compare(spark, d):
    c = _counts(spark, d)
    return quality.stale(c.where("ts = date'2024-01-10'"), c.where("ts = date'2024-01-09'"))


@query(f"WITH c AS ({COUNTS}), w AS (SELECT *, lag(row_count) OVER (PARTITION BY db, tbl ORDER BY ts) AS before, row_number() OVER (PARTITION BY db, tbl ORDER BY ts DESC) AS back FROM c) SELECT * FROM w WHERE back <= 10")
def freshness_trend(spark, d):
    return quality.trend(_counts(spark, d))


@query("SELECT id, ts, tbl FROM (SELECT event_id AS id, ts, event_type AS tbl FROM events WHERE event_type = 'click' ORDER BY ts DESC, event_id DESC LIMIT 500)")
def freshness_tail(spark, d):
    return catalog.tail(t(spark, d, "events").select(F.col("event_id").alias("id"), "ts", F.col("event_type").alias("tbl")), 500, tbl="click")


CAT = ["db", "tbl", "col", "type", "nullable", "pk"]
PREV = [("a", "t1", "id", "int", False, "id"), ("a", "t1", "x", "text", True, "id"), ("a", "t1", "gone", "int", True, "id"), ("a", "t2", "id", "int", False, "id"), ("a", "t4", "id", "int", False, "id"), ("a", "t4", "v", "text", True, "id"), ("old", "t", "id", "int", False, None)]
CUR = [("a", "t1", "id", "bigint", False, "id"), ("a", "t1", "x", "text", False, "id"), ("a", "t1", "fresh", "date", True, "id"), ("a", "t3", "id", "int", False, "id"), ("a", "t4", "id", "int", False, "id,v"), ("a", "t4", "v", "text", True, "id,v"), ("new", "t", "id", "int", False, None)]


def _drift_sql(nullability: bool) -> str:
    return f"""WITH c AS {values(CUR, CAT)}, p AS {values(PREV, CAT)},
k AS (SELECT db FROM c INTERSECT SELECT db FROM p),
kt AS (SELECT db, tbl FROM c INTERSECT SELECT db, tbl FROM p),
cc AS (SELECT c.* FROM c JOIN kt USING (db, tbl)), pp AS (SELECT p.* FROM p JOIN kt USING (db, tbl))
SELECT DISTINCT db, NULL::VARCHAR AS tbl, 'new_db' AS kind, NULL::VARCHAR AS detail, false AS breaking FROM c WHERE db NOT IN (SELECT db FROM p)
UNION ALL SELECT DISTINCT db, NULL, 'dropped_db', NULL, true FROM p WHERE db NOT IN (SELECT db FROM c)
UNION ALL (SELECT DISTINCT db, tbl, 'new_table', NULL, false FROM c JOIN k USING (db) WHERE (db, tbl) NOT IN (SELECT (db, tbl) FROM kt))
UNION ALL (SELECT DISTINCT db, tbl, 'dropped_table', NULL, true FROM p JOIN k USING (db) WHERE (db, tbl) NOT IN (SELECT (db, tbl) FROM kt))
UNION ALL (SELECT DISTINCT cc.db, cc.tbl, 'pk_changed', coalesce(pp.pk, '') || ' -> ' || coalesce(cc.pk, ''), true FROM cc JOIN pp USING (db, tbl) WHERE cc.pk IS DISTINCT FROM pp.pk)
UNION ALL SELECT cc.db, cc.tbl, 'new_column', cc.col, false FROM cc LEFT JOIN pp USING (db, tbl, col) WHERE pp.type IS NULL
UNION ALL SELECT pp.db, pp.tbl, 'dropped_column', pp.col, true FROM pp LEFT JOIN cc USING (db, tbl, col) WHERE cc.type IS NULL
UNION ALL SELECT cc.db, cc.tbl, 'type_changed', cc.col || ': ' || pp.type || ' -> ' || cc.type, true FROM cc JOIN pp USING (db, tbl, col) WHERE cc.type <> pp.type
""" + ("UNION ALL SELECT cc.db, cc.tbl, 'nullable_changed', cc.col, NOT cc.nullable FROM cc JOIN pp USING (db, tbl, col) WHERE cc.nullable <> pp.nullable" if nullability else "")


@query(_drift_sql(False))
def schema_drift_job(spark, d):
    return quality.drift(rel(spark, CUR, CAT), rel(spark, PREV, CAT))


@query(_drift_sql(True))
def schema_drift_api(spark, d):
    return quality.drift(rel(spark, CUR, CAT), rel(spark, PREV, CAT), nullability=True)


@query(f"WITH d AS ({_drift_sql(True)}) SELECT count(*) AS changes, count(*) FILTER (breaking) AS breaking, count(*) FILTER (breaking) = 0 AS success FROM d")
def drift_totals(spark, d):
    return quality.drift(rel(spark, CUR, CAT), rel(spark, PREV, CAT), nullability=True).agg(F.count("*").alias("changes"), F.count_if("breaking").alias("breaking")).withColumn("success", F.col("breaking") == 0)


@query(f"""WITH c AS (SELECT db, tbl, col || ':' || type AS s FROM {values(CUR, CAT)}), p AS (SELECT db, tbl, col || ':' || type AS s FROM {values(PREV, CAT)}),
a AS (SELECT count(*) AS added FROM (SELECT * FROM c EXCEPT ALL SELECT * FROM p)), r AS (SELECT count(*) AS removed FROM (SELECT * FROM p WHERE (db, tbl) IN (SELECT (db, tbl) FROM c) EXCEPT ALL SELECT * FROM c))
SELECT added, removed, added + removed AS changes, removed AS breaking FROM a, r""")
def schema_drift_timeline(spark, d):
    return quality.drift_counts(rel(spark, CUR, CAT), rel(spark, PREV, CAT))


A, B = [("id", "int"), ("x", "text"), ("only", "date"), ("y", "int")], [("id", "int"), ("x", "varchar"), ("other", "int"), ("y", "int")]


@query(f"SELECT coalesce(a.name, b.name) AS name, a.type AS type_a, b.type AS type_b, CASE WHEN b.name IS NULL THEN 'only_a' WHEN a.name IS NULL THEN 'only_b' WHEN a.type = b.type THEN 'same' ELSE 'type_differs' END AS state FROM {values(A, ['name', 'type'])} a FULL JOIN {values(B, ['name', 'type'])} b ON a.name = b.name")
def table_compare(spark, d):
    return quality.compare_tables(rel(spark, A, ["name", "type"]), rel(spark, B, ["name", "type"]))


# ---- catalog ---------------------------------------------------------------------------------------------------------------

FK_ROWS = [("tpch", "lineitem", "l_orderkey", "orders"), ("tpch", "lineitem", "l_partkey", "part"), ("tpch", "lineitem", "l_suppkey", "supplier"), ("tpch", "orders", "o_custkey", "customer"), ("tpch", "customer", "c_nationkey", "nation"), ("tpch", "supplier", "s_nationkey", "nation"), ("tpch", "nation", "n_regionkey", "region")]
FK_COLS = ["db", "tbl", "name", "ref"]


@query(f"SELECT db, ref AS tbl, count(*) AS n, string_agg(tbl || '.' || name, ',' ORDER BY tbl || '.' || name) AS referenced_by FROM {values(FK_ROWS, FK_COLS)} GROUP BY 1, 2")
def referenced_by(spark, d):
    return catalog.referenced_by(rel(spark, FK_ROWS, FK_COLS))


NAMES = [(db, n) for db in ("a", "b", "c") for n in ("users", "user_roles", "tmp_users", "orders", "order_items", "log1", "log2", "logx")]


@query(f"SELECT db, tbl FROM {values(NAMES, ['db', 'tbl'])} WHERE (regexp_matches(tbl, '^user.*$') OR regexp_matches(tbl, '^.*orders$') OR regexp_matches(tbl, '^log[12]$')) AND NOT regexp_matches(tbl, '^.*_roles$')")
def table_filter_glob(spark, d):
    return rel(spark, NAMES, ["db", "tbl"]).where(naming.included(F.col("tbl"), ["user*", "*orders", "log[12]"], ["*_roles"]))


TARGETS = [("a", "users"), ("a", None), ("b", "orders"), ("b", "nothing"), (None, "logx")]


@query(f"WITH n AS {values(NAMES, ['db', 'tbl'])}, t AS {values(TARGETS, ['db', 'tbl'])} SELECT db, tbl FROM n WHERE db IN (SELECT db FROM t WHERE tbl IS NULL AND db IS NOT NULL) OR (db, tbl) IN (SELECT (db, tbl) FROM t WHERE db IS NOT NULL AND tbl IS NOT NULL)")
def target_scope(spark, d):
    return naming.scoped(rel(spark, NAMES, ["db", "tbl"]), rel(spark, TARGETS, ["db", "tbl"]))


EDGES = [(1, "app.users", "dw.users", "sync"), (2, "app.orders", "dw.orders", "sync"), (3, "dw.orders", "dw.sales", "model"), (4, "dw.users", "dw.sales", "model"), (5, "dw.sales", "bi.report", "export"), (6, "dw.orders", "bi.report", "export"), (7, "x.gone", "dw.users", "sync")]
ECOLS = ["pos", "src", "dst", "label"]
NODES = [("app", "app.users", 1), ("app", "app.orders", 2), ("app", "app.idle", 3), ("dw", "dw.idle", 1), ("dw", "dw.users", 2), ("dw", "dw.orders", 3), ("dw", "dw.sales", 4), ("bi", "bi.report", 1)]
NCOLS = ["db", "node", "pos"]


@query(f"SELECT 'upstream' AS direction, src AS node, label FROM {values(EDGES, ECOLS)} WHERE dst = 'dw.sales'")
def lineage_upstream(spark, d):
    return catalog.neighbours(rel(spark, EDGES, ECOLS), "dw.sales").where("direction = 'upstream'")


@query(f"SELECT 'downstream' AS direction, dst AS node, label FROM {values(EDGES, ECOLS)} WHERE src = 'dw.orders'")
def lineage_downstream(spark, d):
    return catalog.neighbours(rel(spark, EDGES, ECOLS), "dw.orders").where("direction = 'downstream'")


@query(f"SELECT DISTINCT CASE WHEN src = 'dw.sales' THEN dst ELSE src END AS node FROM {values(EDGES, ECOLS)} WHERE src = 'dw.sales' OR dst = 'dw.sales'")
def lineage_neighbourhood(spark, d):
    return catalog.neighbourhood(rel(spark, EDGES, ECOLS), "dw.sales")


@query(f"WITH RECURSIVE e AS {values(EDGES, ECOLS)}, r(node, depth) AS (SELECT 'app.orders', 0 UNION SELECT e.dst, r.depth + 1 FROM r JOIN e ON e.src = r.node WHERE r.depth < 20) SELECT node, CAST(min(depth) AS INTEGER) AS depth FROM r GROUP BY 1")
def lineage_closure(spark, d):
    return catalog.closure(spark, rel(spark, EDGES, ECOLS), "app.orders")


@query(f"WITH n AS {values(NODES, NCOLS)} SELECT src, dst, label FROM {values(EDGES, ECOLS)} WHERE src IN (SELECT node FROM n) AND dst IN (SELECT node FROM n)")
def connection_edges(spark, d):
    return catalog.known_edges(rel(spark, EDGES, ECOLS), rel(spark, NODES, NCOLS))


@query(f"WITH e AS {values(EDGES, ECOLS)}, f AS (SELECT node, min(pos) AS first FROM (SELECT pos, src AS node FROM e UNION ALL SELECT pos, dst FROM e) GROUP BY 1) SELECT n.db, n.node, row_number() OVER (PARTITION BY n.db ORDER BY first NULLS LAST, n.pos) AS rank FROM {values(NODES, NCOLS)} n LEFT JOIN f USING (node)")
def table_order(spark, d):
    return catalog.table_order(rel(spark, NODES, NCOLS), rel(spark, EDGES, ECOLS))


DBS = [("app", None), ("dw", 1), ("bi", 0), ("misc", None)]


@query("SELECT * FROM (VALUES ('bi', 1::BIGINT), ('dw', 2), ('app', 3), ('misc', 4)) AS v(db, rank)")
def db_order(spark, d):
    order = catalog.topological([n for n, _ in DBS], [(s.split(".")[0], e.split(".")[0]) for _, s, e, _ in EDGES])
    return catalog.db_order(rel(spark, [(n, c, order.index(n)) for n, c in DBS], ["db", "canvas_order", "topo"])).select("db", "rank")


STATIC, FOUND = [("a", "b", "x"), ("auto", "b", "x"), ("c", "auto", "y")], [("a", "b", "x"), ("d", "e", "z")]


@query(f"SELECT * FROM {values(STATIC, catalog.EDGE)} WHERE src <> 'auto' AND dst <> 'auto' UNION ALL SELECT * FROM {values(FOUND, catalog.EDGE)}")
def config_merge(spark, d):
    return catalog.merge_config(rel(spark, STATIC, catalog.EDGE), rel(spark, FOUND, catalog.EDGE))


RUNS = "SELECT event_id AS run_id, user_id AS job, event_type <> 'error' AS success, ts AS finished_at, event_type || ' ' || props AS message FROM events"


def _runs(spark, d) -> DataFrame:
    return t(spark, d, "events").select(F.col("event_id").alias("run_id"), F.col("user_id").alias("job"), (F.col("event_type") != "error").alias("success"), F.col("ts").alias("finished_at"), F.concat("event_type", F.lit(" "), "props").alias("message"))


STATS = f"WITH r AS ({RUNS}), w AS (SELECT *, sum(CASE WHEN success THEN 1 ELSE 0 END) OVER (PARTITION BY job ORDER BY finished_at DESC, run_id DESC) AS s FROM r) SELECT job, max(finished_at) FILTER (success) AS last_success, max(finished_at) FILTER (NOT success) AS last_failure, count(*) FILTER (s = 0) AS fail_streak FROM w GROUP BY 1"


@query(STATS)
def job_stats(spark, d):
    return catalog.job_stats(_runs(spark, d))


@query(f"SELECT job, fail_streak FROM ({STATS}) WHERE fail_streak > 0")
def fail_streak(spark, d):
    return catalog.job_stats(_runs(spark, d)).where("fail_streak > 0").select("job", "fail_streak")


@query(f"SELECT job, run_id, success, finished_at FROM (SELECT *, row_number() OVER (PARTITION BY job ORDER BY finished_at DESC, run_id DESC) AS k FROM ({RUNS})) WHERE k = 1")
def last_run(spark, d):
    return catalog.last_run(_runs(spark, d))


@query(f"SELECT run_id, finished_at FROM ({RUNS}) WHERE finished_at >= TIMESTAMP '2024-01-24'")
def history_prune(spark, d):
    return catalog.pruned(_runs(spark, d), datetime(2024, 1, 24)).select("run_id", "finished_at")


@query(f"SELECT 'run' AS kind, run_id AS id, finished_at, substring(message, 1, 100) AS text FROM ({RUNS}) UNION ALL SELECT 'drift', -1, TIMESTAMP '2024-01-30', '2 breaking' ORDER BY finished_at DESC, id DESC, kind LIMIT 200")
def timeline_top200(spark, d):
    drifts = spark.sql("SELECT -1L AS id, TIMESTAMP_NTZ'2024-01-30' AS finished_at, '2 breaking' AS text")
    return catalog.timeline(_runs(spark, d), drifts)


SCHEDULES = [("s1", 1, "all_tables"), ("s2", 2, "all_dbs"), ("s3", 3, "none"), ("s4", 4, "all_tables")]
GIVEN = [("s1", "dw", "dw.users"), ("s3", "bi", None)]
ACTIVE = [(2,)]


def _schedules(spark) -> DataFrame:
    given = rel(spark, GIVEN, ["schedule_id", "db", "tbl"]).groupBy("schedule_id").agg(F.collect_list(F.struct("db", "tbl")).alias("targets"))
    return rel(spark, SCHEDULES, ["schedule_id", "job", "scope"]).join(given, "schedule_id", "left")


@query(f"WITH l AS (SELECT job, arg_max(success, (finished_at, run_id)) AS ok FROM ({RUNS}) GROUP BY 1) SELECT schedule_id, s.job, scope, CASE WHEN s.job IN (SELECT job FROM {values(ACTIVE, ['job'])}) THEN 'running' WHEN NOT ok THEN 'failed' ELSE 'scheduled' END AS state FROM {values(SCHEDULES, ['schedule_id', 'job', 'scope'])} s LEFT JOIN l ON l.job = s.job")
def schedule_status(spark, d):
    return catalog.schedule_state(_schedules(spark), rel(spark, ACTIVE, ["job"]), catalog.last_run(_runs(spark, d))).select("schedule_id", "job", "scope", "state")


INDEX = f"WITH s AS {values(SCHEDULES, ['schedule_id', 'job', 'scope'])}, g AS {values(GIVEN, ['schedule_id', 'db', 'tbl'])}, n AS {values(NODES, NCOLS)} SELECT * FROM g UNION ALL SELECT DISTINCT schedule_id, db, NULL FROM s, n WHERE scope = 'all_dbs' AND schedule_id NOT IN (SELECT schedule_id FROM g) UNION ALL SELECT schedule_id, db, node FROM s, n WHERE scope = 'all_tables' AND schedule_id NOT IN (SELECT schedule_id FROM g)"


@query(INDEX)
def job_target_index(spark, d):
    return catalog.targets_of(_schedules(spark), rel(spark, NODES, NCOLS).withColumnRenamed("node", "tbl"))


STATES_OF = [("dw.users", 1, "running"), ("dw.users", 2, "failed"), ("dw.users", 1, "scheduled"), ("dw.sales", 2, "failed"), ("dw.sales", 3, "scheduled"), ("bi.report", 4, "scheduled")]


@query(f"SELECT node, CASE max(CASE state WHEN 'running' THEN 3 WHEN 'failed' THEN 2 ELSE 1 END) WHEN 3 THEN 'running' WHEN 2 THEN 'failed' ELSE 'scheduled' END AS state, count(DISTINCT job) AS jobs FROM {values(STATES_OF, ['node', 'job', 'state'])} GROUP BY 1")
def worst_state(spark, d):
    return catalog.worst(rel(spark, STATES_OF, ["node", "job", "state"]))


@query(f"SELECT db, tbl, col, coalesce(list_contains(string_split(pk, ','), col), false) AS is_pk, tbl = 't1' AND col = 'x' AS is_fk FROM {values(CUR, CAT)}")
def column_badges(spark, d):
    cols = rel(spark, CUR, CAT)
    keys = cols.select("db", "tbl", F.split("pk", ",").alias("pk"), F.when(F.col("tbl") == "t1", F.array(F.lit("x"))).alias("fk")).distinct()
    return catalog.badges(cols, keys)


@query(f"SELECT * FROM {values(NODES, NCOLS)} WHERE contains(lower(node), 'ord') OR contains(lower(db), 'ord')")
def catalog_search(spark, d):
    return catalog.search(rel(spark, NODES, NCOLS).withColumn("label", F.col("node")).withColumnRenamed("node", "tbl"), "ORD").select("db", F.col("tbl").alias("node"), "pos")


OLD_NOTES, NEW_NOTES = [("a.t", "owner", "x"), ("a.t", "notes", "old"), ("b.t", "owner", "y")], [("a.t", "notes", "new"), ("c.t", "owner", "z")]


@query(f"WITH o AS {values(OLD_NOTES, ['key', 'name', 'value'])}, n AS (SELECT * FROM {values(NEW_NOTES, ['key', 'name', 'value'])} UNION ALL SELECT DISTINCT key, 'updatedAt', '2024-01-01' FROM {values(NEW_NOTES, ['key', 'name', 'value'])}) SELECT o.* FROM o WHERE (key, name) NOT IN (SELECT (key, name) FROM n) UNION ALL SELECT * FROM n")
def annotations_upsert(spark, d):
    cols = ["key", "name", "value"]
    return catalog.annotate(rel(spark, OLD_NOTES, cols), rel(spark, NEW_NOTES, cols), "2024-01-01")


# ---- enrichment --------------------------------------------------------------------------------------------------------------


@query("SELECT doc_id, lang, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def exclude_processed(spark, d):
    return sync.excluded(t(spark, d, "documents").select("doc_id", "lang", "n_chars"), t(spark, d, "labels"), "doc_id")


@query("SELECT o_orderkey, c_name, c_mktsegment FROM orders LEFT JOIN customer ON o_custkey = c_custkey")
def lookup_single(spark, d):
    cust = t(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")
    out = enrich.lookup(t(spark, d, "orders").select("o_orderkey", "o_custkey"), cust, {"o_custkey": "c_custkey"}, "customer", ["c_custkey"])
    return out.select("o_orderkey", "customer.c_name", "customer.c_mktsegment")


@query("SELECT c_custkey, count(o_orderkey) AS n, coalesce(string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey), '') AS orders FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1")
def lookup_many(spark, d):
    out = enrich.lookup_many(t(spark, d, "customer").select("c_custkey"), t(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderstatus"), {"c_custkey": "o_custkey"}, "orders", ["o_orderkey"])
    return out.select("c_custkey", F.size("orders").cast("bigint").alias("n"), F.expr("array_join(transform(orders, x -> cast(x.o_orderkey as string)), ',')").alias("orders"))


@query("SELECT o_orderkey, o_custkey, c_custkey, c_nationkey, n_nationkey, n_name, n_regionkey, r_regionkey, r_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey")
def lookup_chain(spark, d):
    out = t(spark, d, "orders").select("o_orderkey", "o_custkey")
    for table, cols, on in (("customer", ["c_custkey", "c_nationkey"], "o_custkey"), ("nation", ["n_nationkey", "n_name", "n_regionkey"], "c_nationkey"), ("region", ["r_regionkey", "r_name"], "n_regionkey")):
        out = enrich.flatten(enrich.lookup(out, t(spark, d, table).select(*cols), {on: cols[0]}, table, [cols[0]]), [table])
    return out


@query("SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.missing.x') AS missing FROM events")
def json_path_extract(spark, d):
    return t(spark, d, "events").select("event_id", *text.mapped(F.col("props"), [{"json_path": "k", "column": "k", "type": "bigint"}, {"json_path": "missing.x", "column": "missing"}]))


@query("WITH e AS (SELECT vec_id, embedding[1:5] AS a, embedding[1:3] AS b FROM embeddings), z AS (SELECT vec_id, unnest(range(0, 3)) AS i, a, b FROM e) SELECT vec_id, CAST(i AS INTEGER) AS idx, a[i + 1] AS score, b[i + 1] AS label FROM z")
def response_merge_zip(spark, d):
    rows = t(spark, d, "embeddings").select("vec_id", "embedding")
    return enrich.merge_arrays(rows, {"score": F.slice("embedding", 1, 5), "label": F.slice("embedding", 1, 3)}).drop("embedding")


@query("SELECT vec_id AS parent_id, CAST(i AS INTEGER) AS idx, embedding[i + 1] AS item FROM (SELECT vec_id, embedding, unnest(range(0, len(embedding))) AS i FROM embeddings)")
def children_explode(spark, d):
    return enrich.children(t(spark, d, "embeddings"), "vec_id", "parent_id", F.col("embedding"))


@query("SELECT doc_id AS parent_id, CAST(i AS INTEGER) AS idx, w[i + 1] AS item FROM (SELECT doc_id, string_split(source, 'c') AS w, unnest(range(0, len(string_split(source, 'c')))) AS i FROM documents)")
def child_scalar_items(spark, d):
    return enrich.children(t(spark, d, "documents"), "doc_id", "parent_id", F.split("source", "c", -1))


@query("WITH r AS (SELECT c_custkey AS code, c_custkey % 4 AS pos, c_custkey * 10 AS status FROM customer WHERE c_custkey % 3 <> 0 UNION ALL SELECT c_custkey, 9, -1 FROM customer WHERE c_custkey % 6 = 1) SELECT c_custkey, CASE WHEN c_custkey % 6 = 1 THEN -1 WHEN c_custkey % 3 <> 0 THEN c_custkey * 10 END AS status FROM customer")
def batch_response_match(spark, d):
    rows = t(spark, d, "customer").select("c_custkey")
    first = rows.where("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("code"), (F.col("c_custkey") % 4).alias("pos"), (F.col("c_custkey") * 10).alias("status"))
    again = rows.where("c_custkey % 6 = 1").select(F.col("c_custkey").alias("code"), F.lit(9).cast("bigint").alias("pos"), F.lit(-1).cast("bigint").alias("status"))
    return enrich.match_by_id(rows, first.unionByName(again), "c_custkey", "code")


@query("SELECT c_custkey, CASE WHEN c_custkey % 500 < 400 THEN c_custkey * 2 END AS status FROM customer")
def batch_positional_match(spark, d):
    rows = t(spark, d, "customer").select("c_custkey", F.expr("c_custkey div 500").alias("batch"), (F.col("c_custkey") % 500).alias("pos"))
    answers = rows.where("pos < 400").select("batch", "pos", (F.col("c_custkey") * 2).alias("status"))
    return enrich.match_by_position(rows, answers).select("c_custkey", "status")


@query("SELECT p_partkey, '/parts/' || url_encode(p_name || ' ~*/') || '?b=' || url_encode(p_brand) || '&x=' AS url FROM part")
def request_url(spark, d):
    rows = t(spark, d, "part")
    return rows.select("p_partkey", text.url("/parts/{name}?b={brand}&x={nothing}", {"name": F.concat("p_name", F.lit(" ~*/")), "brand": F.col("p_brand")}).alias("url"))


@query("""SELECT c_custkey, '{"id":' || c_custkey || ',"label":"c-' || c_custkey || '/","none":null,"tags":["' || c_mktsegment || '"],"list":[]}' AS body FROM customer""")
def request_body(spark, d):
    rows = t(spark, d, "customer")
    made = text.body({"id": "{id}", "label": "c-{id}/{gone}", "none": "{gone}", "tags": ["{seg}"], "list": "$collections.empty"}, {"id": F.col("c_custkey"), "seg": F.col("c_mktsegment")})
    return rows.select("c_custkey", F.to_json(made, {"ignoreNullFields": "false"}).alias("body"))


@query("""WITH o AS (SELECT url AS key, html, CASE WHEN contains(url, '/en/') THEN 'english' WHEN contains(url, 'example') THEN 'other' END AS grp FROM pages WHERE strlen(html) <= 4000),
r AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY key) AS pos FROM o WHERE grp IS NOT NULL) SELECT grp, pos, key, base64(encode(html)) AS content FROM r WHERE pos <= 50""")
def object_groups_base64(spark, d):
    objects = t(spark, d, "pages").select(F.col("url").alias("key"), F.octet_length("html").alias("size"), F.col("html").cast("binary").alias("body"))
    return enrich.object_groups(objects, {"english": "/en/", "other": "example"}, most_bytes=4000)


@query("SELECT doc_id, 'x' || lang AS kind, n_chars, TIMESTAMP '2024-01-01' AS at FROM documents")
def response_projection(spark, d):
    return enrich.enriched(t(spark, d, "documents"), ["doc_id"], [F.concat(F.lit("x"), "lang").alias("kind"), F.col("n_chars")], "at", datetime(2024, 1, 1)).withColumn("at", F.lit("2024-01-01").cast("timestamp_ntz"))


# ---- functions ---------------------------------------------------------------------------------------------------------------


@query("WITH x AS (SELECT doc_id, n_chars * n_chars * n_chars AS n FROM documents) SELECT doc_id, CASE WHEN n < 1024 THEN printf('%.1f B', n / 1.0) WHEN n < 1048576 THEN printf('%.1f KB', n / 1024.0::DOUBLE) WHEN n < 1073741824 THEN printf('%.1f MB', n / 1048576.0::DOUBLE) WHEN n < 1099511627776 THEN printf('%.1f GB', n / 1073741824.0::DOUBLE) ELSE printf('%.1f TB', n / 1099511627776.0::DOUBLE) END AS size FROM x")
def fmt_bytes(spark, d):
    n = F.col("n_chars")
    return t(spark, d, "documents").select("doc_id", text.fmt_bytes(n * n * n).alias("size"))


@query("WITH x AS (SELECT doc_id, n_chars * n_chars * n_chars AS n FROM documents) SELECT doc_id, CASE WHEN n >= 1000000000 THEN printf('%.1fB', n / 1e9) WHEN n >= 1000000 THEN printf('%.1fM', n / 1e6) WHEN n >= 1000 THEN printf('%.1fK', n / 1e3) ELSE CAST(n AS VARCHAR) END AS size FROM x")
def fmt_count(spark, d):
    n = F.col("n_chars")
    return t(spark, d, "documents").select("doc_id", text.fmt_count(n * n * n).alias("size"))


@query("SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS iso, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS seconds FROM events")
def iso_format(spark, d):
    return t(spark, d, "events").select("event_id", text.iso(F.col("ts")).alias("iso"), text.iso(F.col("ts"), False).alias("seconds"))


@query("SELECT CAST(k AS BIGINT) AS attempt, CAST(least(5000 * pow(2, k), 60000) AS BIGINT) AS wait_ms FROM range(0, 8) AS r(k)")
def retry_backoff(spark, d):
    return spark.range(8).select(F.col("id").alias("attempt"), timespec.backoff_ms(F.col("id")).alias("wait_ms"))


SPANS = [("30d",), (" 12H ",), ("90m",), ("5 m",), ("2024-01-01",), ("",)]


@query(f"SELECT raw, TRY_CAST(regexp_extract(trim(raw), '(?i)^(\\d+)\\s*[dhm]$', 1) AS BIGINT) * CASE lower(right(trim(raw), 1)) WHEN 'd' THEN 86400 WHEN 'h' THEN 3600 WHEN 'm' THEN 60 END AS seconds FROM {values(SPANS, ['raw'])}")
def relative_time(spark, d):
    return rel(spark, SPANS, ["raw"]).select("raw", timespec.relative_seconds(F.col("raw")).alias("seconds"))


@query("SELECT l_linenumber AS n, repeat('█', CAST(floor(l_linenumber * 13 * 20 / 100) AS INTEGER)) || repeat('░', 20 - CAST(floor(l_linenumber * 13 * 20 / 100) AS INTEGER)) AS bar FROM (SELECT DISTINCT l_linenumber FROM lineitem)")
def progress_bar(spark, d):
    return t(spark, d, "lineitem").select(F.col("l_linenumber").alias("n")).distinct().withColumn("bar", text.progress_bar(F.col("n") * 13))


@query(f"SELECT src, split_part(src, '.', 1) AS schema, split_part(src, '.', 2) AS tbl, substring(label, 1, 3) AS cut FROM {values(EDGES, ECOLS)}")
def table_names(spark, d):
    return rel(spark, EDGES, ECOLS).select("src", naming.schema_of(F.col("src")).alias("schema"), naming.table_of(F.col("src")).alias("tbl"), text.shorten(F.col("label"), 3).alias("cut"))


# ---- rows enriched by one plan -------------------------------------------------------------------------------------------------


def answer(method, url, body, headers, timeout):
    """A transport that answers from the URL and the body alone: some requests fail, some have no answer or no items."""
    import json

    key = int(url.rsplit("=", 1)[1])
    if key % 11 == 0:
        raise OSError("refused")
    if key % 7 == 0:
        return None
    asked = json.loads(body)
    found = [] if key % 5 == 0 else [{"label": asked["segment"]}, {"label": asked["where"]["region"]}][: 1 + key % 2]
    return json.dumps({"found": {"items": found}, "scores": [key * 2, key * 3, key * 5], "tags": [f"t{key % 3}", {"name": "all"}]})


def _plan(**more):
    chain = [
        {"name": "nat", "db": "ref", "sql": "SELECT n_name, n_regionkey FROM nation WHERE n_nationkey = :c_nationkey"},
        {"name": "reg", "db": "ref", "sql": "SELECT r_name FROM region WHERE r_regionkey = :n_regionkey", "bind_from": "nat"},
    ]
    child = {"target_table": "tags", "json_path": "tags", "parent_key": "c_custkey", "foreign_key": "custkey", "mapping": [{"json_path": "name", "column": "tag"}]}
    given = dict(
        target_table="scored", source_columns=["c_custkey", "c_mktsegment"], url="mem://x?region={r_name}&key={c_custkey}", method="POST", queries=chain,
        body={"segment": "{c_mktsegment}", "where": {"region": "{r_name}"}}, merge=[{"json_path": "found.items", "prefix": "item"}, {"json_path": "scores", "prefix": "score"}],
        mapping=[{"json_path": "item.label", "column": "label"}, {"json_path": "score", "column": "score", "type": "bigint"}], stamp="at", children=[child],
    )
    return rows.EnrichPlan(**(given | more))


def _dbs(spark, d):
    return {"ref": {n: t(spark, d, n) for n in ("nation", "region", "orders")}}


def _answers(spark, d, plan) -> DataFrame:
    return rows.with_outcome(plan, rows.ask(plan, t(spark, d, "customer").select("c_custkey", "c_nationkey", "c_mktsegment"), _dbs(spark, d), transport=answer))


ANSWERS = """c AS (SELECT c_custkey, c_mktsegment, r_name, CASE WHEN c_custkey % 11 = 0 THEN 'failed' WHEN c_custkey % 7 = 0 THEN 'skipped' WHEN c_custkey % 5 = 0 THEN 'empty' ELSE 'ok' END AS status
FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey)"""
SCORED = "SELECT c_custkey, c_mktsegment, CASE i WHEN 0 THEN c_mktsegment ELSE r_name END AS label, c_custkey * CASE i WHEN 0 THEN 2 ELSE 3 END AS score FROM c, range(0, 2) AS r(i) WHERE status = 'ok' AND i <= c_custkey % 2"
TAGGED = "SELECT c_custkey AS custkey, CASE i WHEN 0 THEN 't' || (c_custkey % 3) ELSE 'all' END AS tag FROM c, range(0, 2) AS r(i) WHERE status IN ('ok', 'empty')"


@query(f"WITH {ANSWERS} {SCORED}")
def enrich_rows(spark, d):
    plan = _plan()
    return rows.enriched(plan, _answers(spark, d, plan), datetime(2024, 1, 1)).drop("at")


@query(f"WITH {ANSWERS} SELECT status, count(*) AS n FROM c GROUP BY 1")
def enrich_outcomes(spark, d):
    return rows.outcomes(_answers(spark, d, _plan()))


@query(f"WITH {ANSWERS} {TAGGED}")
def enrich_children(spark, d):
    plan = _plan()
    return rows.child_rows(plan.children[0], _answers(spark, d, plan), None, None)


@query(f"WITH {ANSWERS}, s AS ({SCORED}), g AS ({TAGGED}) SELECT 'scored' AS tbl, count(*) AS n, CAST(sum(score) AS BIGINT) AS total FROM s UNION ALL SELECT 'tags', count(*), CAST(sum(custkey) AS BIGINT) FROM g UNION ALL SELECT 'written', (SELECT count(*) FROM s) + (SELECT count(*) FROM g), NULL")
def enrich_parent_and_children(spark, d):
    from tablemill.plans.store import TableStore

    store = TableStore(spark, f"{_folder(spark)}/store")
    told = rows.run(_plan(), t(spark, d, "customer").select("c_custkey", "c_nationkey", "c_mktsegment"), _dbs(spark, d), store, datetime(2024, 1, 1), transport=answer)
    count = lambda name, c: store.read(name).agg(F.lit(name).alias("tbl"), F.count("*").alias("n"), F.sum(c).alias("total"))
    return count("scored", "score").unionByName(count("tags", "custkey")).unionByName(spark.sql(f"SELECT 'written' AS tbl, {told['rows']}L AS n, CAST(NULL AS BIGINT) AS total"))


@query("SELECT c_custkey, n_name, r_name, count(o_orderkey) AS n, CAST(coalesce(sum(o_orderkey), 0) AS BIGINT) AS total FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey LEFT JOIN orders ON o_custkey = c_custkey AND o_orderstatus <> ':c_custkey' GROUP BY 1, 2, 3")
def user_sql_binds(spark, d):
    ctx = Context(t(spark, d, "customer").select("c_custkey", "c_nationkey"), ["c_custkey", "c_nationkey"])
    many = {"name": "own", "db": "ref", "sql": "SELECT o_orderkey FROM orders WHERE o_custkey = :c_custkey AND o_orderstatus <> ':c_custkey'", "many": True}
    ctx = run_queries(ctx, [*_plan().queries, many], _dbs(spark, d))
    n = F.expr("aggregate(own, 0L, (a, x) -> a + x.o_orderkey)")
    return ctx.df.select("c_custkey", ctx.get("n_name").alias("n_name"), ctx.get("r_name").alias("r_name"), F.size("own").cast("bigint").alias("n"), n.alias("total"))


@query("SELECT c_custkey, n_name AS by_query, n_regionkey AS plain, CAST(NULL AS VARCHAR) AS from_list, CAST(NULL AS VARCHAR) AS unknown, CAST(0 AS BIGINT) AS n_unknown FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey")
def context_get(spark, d):
    ctx = Context(t(spark, d, "customer").select("c_custkey", "c_nationkey"), ["c_custkey", "c_nationkey"])
    ctx = run_queries(ctx, [_plan().queries[0], {"name": "none", "db": "gone", "sql": "SELECT 1", "many": True}], _dbs(spark, d))
    null = lambda key: ctx.get(key).cast("string")
    return ctx.df.select("c_custkey", ctx.get("nat.n_name").alias("by_query"), ctx.get("n_regionkey").alias("plain"), null("none.x").alias("from_list"), null("$collections.x").alias("unknown"), F.size("none").cast("bigint").alias("n_unknown"))


@query("""WITH o AS (SELECT source, lang, doc_id, octet_length(encode(text)) AS size, row_number() OVER (PARTITION BY source, CASE WHEN contains('/' || lang || '-', 'en') THEN 'en' WHEN contains('/' || lang || '-', '-') THEN 'rest' END ORDER BY source || '/' || lang || '-' || doc_id) AS pos, CASE WHEN contains('/' || lang || '-', 'en') THEN 'en' ELSE 'rest' END AS g, lang || '-' || doc_id AS k FROM documents WHERE text IS NOT NULL AND octet_length(encode(text)) <= 400)
SELECT s.source, coalesce(string_agg(base64(encode(k)), ',' ORDER BY pos) FILTER (g = 'en' AND pos <= 3), '') AS en, coalesce(string_agg(base64(encode(k)), ',' ORDER BY pos) FILTER (g = 'rest' AND pos <= 3), '') AS rest FROM (SELECT DISTINCT source FROM documents WHERE source IS NOT NULL) s LEFT JOIN o ON o.source = s.source GROUP BY 1""")
def objects_by_row(spark, d):
    docs = t(spark, d, "documents").where("text IS NOT NULL AND source IS NOT NULL AND lang IS NOT NULL")
    name = F.concat("lang", F.lit("-"), F.col("doc_id").cast("string"))
    objects = docs.select(F.concat("source", F.lit("/"), name).alias("key"), F.octet_length("text").alias("size"), name.cast("binary").alias("body"))
    ctx = with_objects(Context(t(spark, d, "documents").where("source IS NOT NULL").select("source").distinct(), ["source"]), objects, "{source}/", {"en": "en", "rest": "-"}, 400, 3)
    return ctx.df.select("source", F.array_join("en", ",").alias("en"), F.array_join("rest", ",").alias("rest"))


def _spread(row):
    """A row pipeline's function: a row a digit; some rows are left out, some fail."""
    if row["o_orderkey"] % 10 == 3:
        raise rows.SkipRow("three")
    return [{"key": row["o_orderkey"], "part": 12 // (row["o_orderkey"] % 10) + k} for k in range(row["o_orderkey"] % 4)]


SPREAD = "CASE WHEN o_orderkey % 10 = 3 THEN 'skipped' WHEN o_orderkey % 4 = 0 THEN 'skipped' WHEN o_orderkey % 10 = 0 THEN 'failed' ELSE 'ok' END"


@query(f"SELECT o_orderkey AS key, 12 // (o_orderkey % 10) + i AS part FROM orders, range(0, 3) AS r(i) WHERE {SPREAD} = 'ok' AND i < o_orderkey % 4")
def row_pipeline(spark, d):
    return rows.row_pipeline(t(spark, d, "orders").select("o_orderkey"), _spread, "key bigint, part bigint").where("status = 'ok'").select("key", "part")


@query(f"SELECT {SPREAD} AS status, count(*) AS n FROM orders GROUP BY 1")
def row_pipeline_counts(spark, d):
    return rows.pipeline_counts(rows.row_pipeline(t(spark, d, "orders").select("o_orderkey"), _spread, "key bigint, part bigint"))


# ---- tables, constraints and catalog scans -----------------------------------------------------------------------------------


@query("SELECT 'candidates' AS what, count(*) AS n FROM orders WHERE o_orderkey % 3 = 0 UNION ALL SELECT 'replaced', count(*) FROM orders WHERE o_orderkey % 6 = 0 UNION ALL SELECT 'added', count(*) FROM orders WHERE o_orderkey % 6 = 3")
def merge_counts(spark, d):
    orders = t(spark, d, "orders").select("o_orderkey")
    n = sync.merge_counts(orders.where("o_orderkey % 2 = 0"), orders.where("o_orderkey % 3 = 0"), ["o_orderkey"])
    return n.select(F.expr("stack(3, 'candidates', candidates, 'replaced', replaced, 'added', added) AS (what, n)"))


@query("SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderstatus = 'O'")
def bound_scan(spark, d):
    db = {"type": "parquet", "dbname": d, "tables": ["orders"]}
    return registry.read_sql(spark, db, "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= CAST(:since AS TIMESTAMP_NTZ) AND o_orderstatus = :status", {"since": "1995-01-01", "status": "O"}, order_by="o_orderdate")


@query("SELECT event_id, ts FROM events")
def ordered_scan(spark, d):
    return sync.ordered_scan(t(spark, d, "events").select("event_id", "ts"), "ts")


@query("SELECT c_custkey, c_name FROM customer")
def target_columns(spark, d):
    return sync.like(t(spark, d, "customer"), spark.createDataFrame([], "c_custkey bigint, c_name string"))


@query("SELECT * FROM (SELECT 'text' AS col, count_if(text IS NULL) AS nulls FROM documents UNION ALL SELECT 'odd', count_if(doc_id % 2 = 0) FROM documents UNION ALL SELECT 'doc_id', count_if(doc_id IS NULL) FROM documents) WHERE nulls > 0")
def required_columns(spark, d):
    return made.missing_values(t(spark, d, "documents").withColumn("odd", F.expr("if(doc_id % 2 = 0, NULL, 1)")), ["text", "odd", "doc_id"])


@query("SELECT 'main' AS db, 'orders' AS tbl, 'unique' AS kind, 'o_orderkey' AS cols, 0 AS bad UNION ALL SELECT 'main', 'orders', 'unique', 'o_custkey,o_orderstatus', (SELECT count(*) FROM (SELECT 1 FROM orders GROUP BY o_custkey, o_orderstatus HAVING count(*) > 1)) UNION ALL SELECT 'main', 'events', 'not_null', 'user_id,props', (SELECT count(*) FROM events WHERE user_id IS NULL OR props IS NULL)")
def declared_constraints(spark, d):
    given = [("orders", "unique", ["o_orderkey"]), ("orders", "unique", ["o_custkey", "o_orderstatus"]), ("events", "not_null", ["user_id", "props"])]
    return made.violations({("main", n): t(spark, d, n) for n in ("orders", "events")}, [{"db": "main", "tbl": n, "kind": k, "cols": c} for n, k, c in given])


@query(" UNION ALL ".join(f"SELECT '{n}' AS tbl, column_name AS col, row_number() OVER () AS ordinal, TRUE AS nullable FROM (DESCRIBE {n})" for n in ("customer", "nation", "orders")))
def column_ordinals(spark, d):
    found = metadata.columns(spark, {("main", n): t(spark, d, n) for n in ("customer", "nation", "orders")})
    return found.select("tbl", "col", "ordinal", "nullable")


@query("SELECT 'public' AS schema, 'nation' AS tbl, n_name AS col, 'n_nationkey' AS pk, CAST(1 AS BIGINT) AS indexes, CAST(2 AS BIGINT) AS fks FROM nation UNION ALL SELECT 'sales', 'region', r_name, NULL, 0, 0 FROM region")
def scanned_schemas(spark, d):
    one = t(spark, d, "nation").select(F.lit("public").alias("schema"), F.lit("nation").alias("tbl"), F.col("n_name").alias("col"))
    two = t(spark, d, "region").select(F.explode(F.array(F.lit("sales"), F.lit("pg_catalog"))).alias("schema"), F.lit("region").alias("tbl"), F.col("r_name").alias("col"))
    key = {"db": "public", "tbl": "nation"}
    known = made.catalog(spark, [key | {"kind": "pk", "cols": ["n_nationkey"]}, key | {"kind": "index", "cols": ["n_name"]}, key | {"kind": "fk", "cols": ["n_regionkey"], "ref_tbl": "region", "ref_cols": ["r_regionkey"]}, key | {"kind": "fk", "cols": ["n_name"]}])
    return metadata.scan_schemas(one.unionByName(two), "postgresql", known)


@query("SELECT user_id, event_type, count(*) > 0 AS running FROM events WHERE event_type = 'click' AND user_id IS NOT NULL GROUP BY 1, 2")
def duplicate_runs(spark, d):
    """FLT-18 for all jobs at once."""
    runs = t(spark, d, "events").where("user_id IS NOT NULL").select(F.col("user_id").alias("job"), F.col("event_type").alias("args"))
    asked = runs.select("job").distinct().withColumn("args", F.lit("click"))
    return catalog.running(runs, asked).where("running").select(F.col("job").alias("user_id"), F.col("args").alias("event_type"), "running")


# ---- streams -----------------------------------------------------------------------------------------------------------------


def _folder(spark: SparkSession) -> str:
    """A fresh folder that all executors share."""
    import uuid

    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="tablemill-")
    return f"{base.rstrip('/')}/tablemill/streams-{uuid.uuid4().hex}"


@query("SELECT event_id, ts, user_id, event_type FROM events")
def stream_delta_merge(spark, d):
    from tablemill.plans.store import TableStore
    from tablemill.streaming.delta import merge_stream

    at = _folder(spark)
    rows = t(spark, d, "events").select("event_id", "ts", "user_id", "event_type")
    rows.where("ts < '2024-01-20'").write.mode("append").parquet(f"{at}/in")
    store = TableStore(spark, f"{at}/store")
    for part in (None, rows.where("ts >= '2024-01-15'")):  # the second run reads late rows again and merges them
        if part is not None:
            part.write.mode("append").parquet(f"{at}/in")
        merge_stream(spark, f"{at}/in", rows.schema, store, "events", f"{at}/state", keys=["event_id"], order=["ts", "user_id", "event_type"])
    return store.read("events").select("event_id", "ts", "user_id", "event_type")


@query("SELECT event_id, ts FROM events")
def stream_dedup(spark, d):
    from tablemill.streaming.delta import dedup_stream

    at = _folder(spark)
    rows = t(spark, d, "events").select("event_id", "ts")
    rows.unionAll(rows.where("event_id % 3 = 0")).write.parquet(f"{at}/in")
    return dedup_stream(spark, f"{at}/in", rows.schema, f"{at}/out", f"{at}/state", keys=["event_id"], ts="ts")
