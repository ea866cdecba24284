"""Line dedup over windows of three lines.

Every run of `size` consecutive lines of a text is hashed to 128 bits. A window that stands in several places, in any
documents, is repeated; its first place (by document, then line) stays and the lines of all later places are covered.
Covered lines, whose windows overlap, are merged by position and taken out.

Only hashes and positions are exchanged, pre-aggregated by window; the texts move once, to meet the lines they lose.
Everything is DataFrame functions.

Edge cases: a null text stays null, an empty one stays empty; a text of fewer than `size` lines is one window of all its
lines, so exact copies of short texts are found, and blank windows (only white space) are never repeats; documents that
share an id are told apart by their text, and rows repeated whole count once as a place, so they are all kept or all
cut alike; a null id sorts first; further columns pass through, and helper names give way to theirs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablemill.llm.common import free_name, read

SIZE = 3
#: Part of the hashed value that tells the second half of a hash from the first.
SALT = 7


def _windows(lines: str, size: int) -> Column:
    """Hashes (two longs) of the windows of an array of lines."""
    own = ", ".join(f"h[i + {k}].a, h[i + {k}].b" for k in range(size))
    many = f"transform(sequence(0, size(h) - {size}), i -> named_struct('i', i, 'a', xxhash64({own}), 'b', xxhash64({SALT}, {own})))"
    one = f"array(named_struct('i', 0, 'a', xxhash64({lines}), 'b', xxhash64({SALT}, {lines})))"
    hashed = f"transform({lines}, x -> named_struct('a', xxhash64(x), 'b', xxhash64({SALT}, x)))"
    wide = f"transform(array({hashed}), h -> {many})[0]"
    return F.expr(f"CASE WHEN size({lines}) < {size} THEN {one} ELSE {wide} END")


def repeated_lines(docs: DataFrame, *, id: str = "doc_id", text: str = "text", size: int = SIZE) -> DataFrame:
    """did, key (of the text) and the sorted positions that the text loses, for texts that lose any."""
    base = docs.where(F.col(text).isNotNull()).select(F.col(id).alias("did"), F.xxhash64(text).alias("key"), F.split(text, "\n", -1).alias("lines"))
    places = (
        base.withColumn("n", F.size("lines"))
        .withColumn("blank", F.expr("transform(lines, x -> if(trim(translate(x, '\\t\\r', '  ')) = '', 1, 0))"))
        .withColumn("w", F.explode(_windows("lines", size)))
        .where(F.expr(f"aggregate(slice(blank, w.i + 1, {size}), 0, (s, x) -> s + x) < least(n, {size})"))
        .select("did", "key", "n", F.col("w.i").alias("i"), F.col("w.a").alias("a"), F.col("w.b").alias("b"))
    )
    place = F.struct("did", "key", "i")
    first = places.groupBy("a", "b").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first <> last OR (first.did IS NULL) <> (last.did IS NULL)")
    later = places.join(first.select("a", "b", "first"), ["a", "b"]).where(~place.eqNullSafe(F.col("first")))
    cover = F.expr(f"sequence(i, i + least(n, {size}) - 1)")
    return later.groupBy("did", "key").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set(cover)))).alias("covered"))


def dedup_lines(docs: DataFrame, *, id: str = "doc_id", text: str = "text", size: int = SIZE, n_removed: str | None = None, n_lines: str | None = None, drop_emptied: bool = False) -> DataFrame:
    """docs with the text cut; with the numbers of lines and of removed ones, if columns are named for them.

    drop_emptied leaves out rows that lose all their lines, which stand whole in earlier rows.
    """
    did, key, cov = (free_name(docs.columns, n) for n in ("did", "key", "covered"))
    lost = repeated_lines(docs, id=id, text=text, size=size).select(F.col("did").alias(did), F.col("key").alias(key), F.col("covered").alias(cov))
    keyed = docs.withColumn(key, F.xxhash64(text))
    both = keyed.alias("d").join(lost.alias("l"), F.col(f"d.`{id}`").eqNullSafe(F.col(f"l.{did}")) & (F.col(f"d.{key}") == F.col(f"l.{key}")), "left")
    t, c = F.col(f"d.`{text}`"), F.col(f"l.{cov}")
    lines = F.split(t, "\n", -1)
    kept = F.when(c.isNull(), t).otherwise(F.array_join(F.filter(lines, lambda x, i: ~F.array_contains(c, i)), "\n"))
    if drop_emptied:
        both = both.where(c.isNull() | (F.size(c) < F.size(lines)))
    out = [kept.alias(text) if x == text else F.col(f"d.`{x}`").alias(x) for x in docs.columns]
    if n_lines:
        out.append(F.coalesce(F.when(t.isNotNull(), F.size(lines)), F.lit(0)).cast("long").alias(n_lines))
    if n_removed:
        out.append(F.coalesce(F.size(c), F.lit(0)).cast("long").alias(n_removed))
    return both.select(*out)


def op2(spark, sf_dir: str) -> DataFrame:
    return dedup_lines(read(spark, sf_dir, "documents").select("doc_id", "text"), n_lines="n_lines", n_removed="n_removed")


SQL = r"""
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents),
w AS (SELECT doc_id, least(len(l), 3) AS n, unnest(range(0, greatest(len(l) - 3, 0) + 1)) AS i, l FROM d WHERE text IS NOT NULL),
p AS (SELECT doc_id, n, i, list_transform(l[i + 1:i + n], lambda x: chr(1) || x) AS win FROM w
      WHERE len(list_filter(l[i + 1:i + n], lambda x: trim(translate(x, chr(9) || chr(13), '  ')) <> '')) > 0),
r AS (SELECT *, row_number() OVER (PARTITION BY win ORDER BY doc_id, i) AS k FROM p),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS j FROM r WHERE k > 1),
g AS (SELECT doc_id, count(*) AS n_removed, list(j) AS js FROM c GROUP BY 1)
SELECT d.doc_id,
       CASE WHEN js IS NULL THEN text ELSE coalesce(array_to_string(list_transform(list_filter(range(0, len(l)), lambda j: NOT list_contains(js, j)), lambda j: l[j + 1]), chr(10)), '') END AS text,
       CAST(coalesce(len(l), 0) AS BIGINT) AS n_lines, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed
FROM d LEFT JOIN g USING (doc_id)
"""
