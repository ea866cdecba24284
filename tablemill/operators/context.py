"""A row's context: its columns, the results of user SQL with named binds, and lists of objects (UDF-6, FUN-14)."""

from __future__ import annotations

import logging
import re
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Text in quotes, which stays as it is, or a name after a colon.
_BIND = re.compile(r"'(?:[^']|'')*'|(?<![:\w]):([A-Za-z_]\w*)")


@dataclass
class Context:
    """Rows with their source columns, and which further columns are queries' results or collections of objects."""

    df: DataFrame
    source: list[str]
    queries: dict[str, T.DataType | None] = field(default_factory=dict)
    collections: list[str] = field(default_factory=list)

    def _fields(self, name: str) -> list[str]:
        kind = self.queries.get(name)
        return kind.fieldNames() if isinstance(kind, T.StructType) else []

    def flat(self) -> dict[str, str]:
        """Each plain name's column as SQL: source columns, then the fields of one-row results, later ones over earlier."""
        out = {c: f"`{c}`" for c in self.source}
        for q in self.queries:
            out |= {f: f"`{q}`.`{f}`" for f in self._fields(q)}
        return out

    def get(self, key: str) -> Column:
        """FUN-14: a column, `query.column` or `$collections.name`; null where there is none, also in a list of rows."""
        if key.startswith("$collections."):
            name = key.removeprefix("$collections.")
            return F.col(f"`{name}`") if name in self.collections else F.lit(None)
        query, dot, column = key.partition(".")
        if dot:
            return F.col(f"`{query}`.`{column}`") if column in self._fields(query) else F.lit(None)
        flat = self.flat()
        return F.expr(flat[key]) if key in flat else F.lit(None)

    def columns(self) -> dict[str, Column]:
        return {k: F.expr(v) for k, v in self.flat().items()}

    def binds(self, origin: str) -> dict[str, str]:
        """A query's binds, as SQL over s__: the plain names, those of the row it binds from first; of a list that is its first row."""
        kind = self.queries.get(origin)
        if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
            own = {f: f"get(s__.`{origin}`, 0).`{f}`" for f in kind.elementType.fieldNames()}
        else:
            own = {c: f"s__.`{c}`" for c in self.source} if origin == "source" else {f: f"s__.`{origin}`.`{f}`" for f in self._fields(origin)}
        return {k: f"s__.{v}" for k, v in self.flat().items()} | own


def bound(sql: str, binds: dict[str, str], tables: dict[str, str]) -> str:
    """The SQL with each :name as the bound column (null if it is unknown) and each table's name as its view's."""

    def one(m: re.Match) -> str:
        return m[0] if m[1] is None else binds.get(m[1], "NULL")

    def place(m: re.Match) -> str:
        return m[0] if m[0].startswith("'") else tables[m[0]]

    out = _BIND.sub(one, sql)
    names = "|".join(re.escape(n) for n in sorted(tables, key=len, reverse=True))
    return re.sub(rf"'(?:[^']|'')*'|(?<![\w.`])(?:{names})(?![\w.`])", place, out) if tables else out


def run_queries(ctx: Context, queries: list[dict], dbs: dict[str, dict[str, DataFrame]]) -> Context:
    """UDF-6, JOIN-4: user SQL for all rows at once, a correlated subquery that Catalyst turns into a join.

    A query has name, db, sql, bind_from (source, or an earlier query) and many. Its result is one row as a struct, the
    smallest by its columns in their order, or with many a sorted list of structs (empty if there are none; a hot key's
    list is one row, so bound it in the SQL). Binds have to be compared by equality. A query whose database is unknown
    or whose SQL cannot be planned gives no rows; one that fails while it runs fails the job.
    """
    spark = ctx.df.sparkSession
    for q in queries:
        name, many = q["name"], q.get("many", False)
        tables = dbs.get(q.get("db", ""))
        out = None
        if tables is not None:
            views = {t: f"q{k}__" for k, t in enumerate(tables)}
            kind = "array_sort(collect_list(struct(r__.*)))" if many else "min(struct(r__.*))"
            inner = bound(q["sql"], ctx.binds(q.get("bind_from", "source")), views)
            for t, view in views.items():
                tables[t].createOrReplaceTempView(view)
            ctx.df.createOrReplaceTempView("s0__")
            try:
                out = spark.sql(f"SELECT s__.*, (SELECT {kind} FROM ({inner}) r__) AS `{name}` FROM s0__ s__")
            except AnalysisException as e:
                logging.getLogger(__name__).warning("query %s: %s", name, e)
        else:
            logging.getLogger(__name__).warning("query %s: unknown database %r", name, q.get("db"))
        if out is None:
            out = ctx.df.withColumn(name, F.array().cast("array<string>") if many else F.lit(None).cast("string"))
        if many:
            out = out.withColumn(name, F.coalesce(F.col(f"`{name}`"), F.array().cast(out.schema[name].dataType)))
        ctx = Context(out, ctx.source, ctx.queries | {name: out.schema[name].dataType}, ctx.collections)
    return ctx


def with_objects(ctx: Context, objects: DataFrame, prefix: str, groups: dict[str, str], most_bytes: int = 10 << 20, most: int = 50) -> Context:
    """SRC-13, AGG-17: for each row the objects under its prefix, as a list of base64 texts by group, sorted by key.

    The prefix is a template that ends with a slash; keys are cut at its depth, so rows and objects meet in an equi-join
    on it. The caps of size and number are the operator's feature. A row without objects has empty lists.
    """
    from tablemill.functions.text import plain_base64, url
    from tablemill.operators.enrich import object_groups

    if not prefix.endswith("/"):
        raise ValueError("an objects' prefix ends with a slash")
    cut = F.concat(F.substring_index("key", "/", prefix.count("/")), F.lit("/"))
    found = object_groups(objects, groups, most_bytes, most, by=cut).groupBy("under__").agg(*[F.array_sort(F.collect_list(F.when(F.col("grp") == g, F.struct("pos", "content")))).alias(f"{g}__") for g in groups])
    at = ctx.df.withColumn("prefix__", url(prefix, ctx.columns()))
    out = at.join(found, F.col("prefix__") == F.col("under__"), "left")
    lists = [F.coalesce(F.col(f"{g}__.content"), F.array().cast("array<string>")).alias(g) for g in groups]
    return Context(out.select(*[F.col(f"`{c}`") for c in ctx.df.columns], *lists), ctx.source, ctx.queries, [*ctx.collections, *groups])
