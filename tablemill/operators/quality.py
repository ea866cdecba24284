"""Column profiles, foreign keys, schema drift, freshness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def profile(df: DataFrame, columns: list[str] | None = None, most: int | None = 10) -> DataFrame:
    """AGG-1, FLT-15: a row a column: rows, nulls in percent and distinct values, from one scan.

    Every column is counted distinct by itself over (column, value) pairs, so each is pre-aggregated before the exchange.
    """
    cols = (columns or df.columns)[:most] if most else columns or df.columns
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v")) for c in cols])).alias("x")).select("x.*")
    per = long.groupBy("column_name", "v").agg(F.count("*").alias("n"))
    out = per.groupBy("column_name").agg(F.sum("n").alias("total"), F.coalesce(F.sum(F.when(F.col("v").isNotNull(), F.col("n"))), F.lit(0)).alias("non_null"), F.count("v").alias("cardinality"))
    pct = F.when(F.col("total") > 0, F.round((1 - F.col("non_null") / F.col("total")) * 100, 1)).otherwise(0.0)
    return out.select("column_name", "total", "non_null", pct.alias("null_pct"), "cardinality")


def orphans(child: DataFrame, fk: list[str], parent: DataFrame, pk: list[str]) -> DataFrame:
    """JOIN-1, FLT-13: child rows whose key is whole and has no parent. The first column alone is the plain mode (Q14)."""
    have = F.lit(True)
    for c in fk:
        have = have & F.col(c).isNotNull()
    keys = parent.select(*[F.col(p).alias(f"__p{k}") for k, p in enumerate(pk)]).distinct()
    on = [F.col(c) == F.col(f"__p{k}") for k, c in enumerate(fk)]
    return child.where(have).join(keys, on, "left_anti")


def orphan_count(name: str, child: DataFrame, fk: list[str], parent: DataFrame, pk: list[str]) -> DataFrame:
    """AGG-4, AGG-15."""
    return orphans(child, fk, parent, pk).agg(F.count("*").alias("orphans")).select(F.lit(name).alias("edge"), "orphans", (F.col("orphans") == 0).alias("ok"))


def _both(cur: DataFrame, prev: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    c = cur.select(*keys, *[F.col(v).alias(f"c_{v}") for v in values], F.lit(True).alias("in_c"))
    p = prev.select(*keys, *[F.col(v).alias(f"p_{v}") for v in values], F.lit(True).alias("in_p"))
    return c.join(p, keys, "full_outer")


CHANGE = ["db", "tbl", "kind", "detail", "breaking"]


def _change(df: DataFrame, kind: Column, detail: Column, breaking: Column, tbl: Column | None = None) -> DataFrame:
    return df.select("db", (F.col("tbl") if tbl is None else tbl).alias("tbl"), kind.alias("kind"), detail.alias("detail"), breaking.alias("breaking"))


def drift(cur: DataFrame, prev: DataFrame, *, nullability: bool = False) -> DataFrame:
    """SET-1, SET-2, JOIN-9, AGG-9: changes at three levels, full outer joins with null-safe comparison.

    Both have db, tbl, col, type, nullable and pk (its columns, joined). A database that is new or gone is one change;
    a table that is new or gone in a known database is one change. nullability adds changes of it (breaking if a column
    takes no nulls any more).
    """
    none = F.lit(None).cast("string")
    dbs = _both(cur.select("db").distinct(), prev.select("db").distinct(), ["db"], [])
    known = dbs.where("in_c AND in_p").select("db")
    a = _change(dbs.where("in_c IS NULL OR in_p IS NULL"), F.when(F.col("in_p").isNull(), "new_db").otherwise("dropped_db"), none, F.col("in_c").isNull(), none)
    table = lambda df: df.join(known, "db", "left_semi").select("db", "tbl", "pk").distinct()
    tables = _both(table(cur), table(prev), ["db", "tbl"], ["pk"])
    b = _change(tables.where("in_c IS NULL OR in_p IS NULL"), F.when(F.col("in_p").isNull(), "new_table").otherwise("dropped_table"), none, F.col("in_c").isNull())
    same = tables.where("in_c AND in_p")
    c = _change(same.where("NOT (c_pk <=> p_pk)"), F.lit("pk_changed"), F.concat(F.coalesce("p_pk", F.lit("")), F.lit(" -> "), F.coalesce("c_pk", F.lit(""))), F.lit(True))
    column = lambda df: df.join(same.select("db", "tbl"), ["db", "tbl"], "left_semi").select("db", "tbl", "col", "type", "nullable")
    cols = _both(column(cur), column(prev), ["db", "tbl", "col"], ["type", "nullable"])
    d = _change(cols.where("in_c IS NULL OR in_p IS NULL"), F.when(F.col("in_p").isNull(), "new_column").otherwise("dropped_column"), F.col("col"), F.col("in_c").isNull())
    both = cols.where("in_c AND in_p")
    e = _change(both.where("NOT (c_type <=> p_type)"), F.lit("type_changed"), F.concat("col", F.lit(": "), "p_type", F.lit(" -> "), "c_type"), F.lit(True))
    out = a.unionByName(b).unionByName(c).unionByName(d).unionByName(e)
    if nullability:
        out = out.unionByName(_change(both.where("NOT (c_nullable <=> p_nullable)"), F.lit("nullable_changed"), F.col("col"), ~F.col("c_nullable")))
    return out


def drift_counts(cur: DataFrame, prev: DataFrame) -> DataFrame:
    """AGG-10, SET-4, Q10: by name and type only, so a changed type counts twice, once as breaking; dropped tables do not count."""
    c, p = (df.select("db", "tbl", F.concat("col", F.lit(":"), "type").alias("sig")) for df in (cur, prev))
    tables = c.select("db", "tbl").distinct()
    added, removed = c.exceptAll(p), p.join(tables, ["db", "tbl"], "left_semi").exceptAll(c)
    return added.agg(F.count("*").alias("added")).join(removed.agg(F.count("*").alias("removed"))).select("added", "removed", (F.col("added") + F.col("removed")).alias("changes"), F.col("removed").alias("breaking"))


def stale(cur: DataFrame, prev: DataFrame) -> DataFrame:
    """JOIN-10, FLT-14: row counts of both snapshots, and whether a table with rows has not moved."""
    return cur.select("db", "tbl", F.col("row_count").alias("cur")).join(prev.select("db", "tbl", F.col("row_count").alias("prev")), ["db", "tbl"]).withColumn("stale", (F.col("cur") == F.col("prev")) & (F.col("cur") > 0))


def trend(log: DataFrame, last: int = 10) -> DataFrame:
    """WIN-3, WIN-4: the last entries of each table with the count before."""
    w = Window.partitionBy("db", "tbl").orderBy("ts")
    seen = log.withColumn("before", F.lag("row_count").over(w))
    back = F.row_number().over(Window.partitionBy("db", "tbl").orderBy(F.desc("ts"))).cast("bigint")
    return seen.withColumn("back", back).where(F.col("back") <= last)


def compare_tables(a: DataFrame, b: DataFrame) -> DataFrame:
    """JOIN-14: columns (name, type) of two tables."""
    both = _both(a, b, ["name"], ["type"])
    state = F.when(F.col("in_p").isNull(), "only_a").when(F.col("in_c").isNull(), "only_b").when(F.col("c_type").eqNullSafe(F.col("p_type")), "same").otherwise("type_differs")
    return both.select("name", F.col("c_type").alias("type_a"), F.col("p_type").alias("type_b"), state.alias("state"))
