"""Benchmark decontamination: Wu-Manber multi-pattern search over words.

Patterns are the windows of `size` consecutive words of each benchmark item; an item of fewer words is one window.
Patterns of one length share a searcher: a block is two words (one word for one-word patterns), the shift table says how
far the window can move for the block under its end, and where the shift is zero a suffix bucket, split by the pattern's
first word, names the few windows that are then compared word by word.

The benchmark is read in blocks of bounded size, so a set of any size is searched in bounded memory: one pass a block,
the rows carried on from one pass to the next in the shared folder, which holds at most two passes. Documents are never shuffled.

Edge cases: null or wordless texts give zero counts and are not contaminated; items with a null text or no words have
no windows; items with a null id mark words as hit but are not counted or listed; repeated documents and items each
count for themselves (an item id listed twice in the benchmark counts once); an empty benchmark contaminates nothing;
further columns pass through, and result columns whose name is taken get a leading underscore.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablemill.llm.common import Scratch, append, free_name, read, words

WINDOW = 10
#: 2 MB of text make about 300 MB of tables in a Python worker.
BLOCK_BYTES = 2 << 20
FOUND = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("spans", T.ArrayType(T.LongType())),
    T.StructField("items", T.ArrayType(T.StringType())),
])
_ARROW = pa.struct([("n_words", pa.int64()), ("spans", pa.list_(pa.int64())), ("items", pa.list_(pa.string()))])


class WuManber:
    """Finds patterns of `n` words each; they map to the items that hold them."""

    def __init__(self, n: int, patterns: dict[tuple[bytes, ...], set[str]]):
        self.n, self.b, self.patterns = n, min(2, n), patterns
        self.far = n - self.b + 1
        self.shift: dict = {}
        self.bucket: dict = {}
        for p in patterns:
            for end in range(self.b - 1, n):
                block, move = self._block(p, end), n - 1 - end
                if move < self.shift.get(block, self.far):
                    self.shift[block] = move
            self.bucket.setdefault(self._block(p, n - 1), {}).setdefault(p[0], []).append(p)

    def _block(self, w, end: int):
        return w[end] if self.b == 1 else (w[end - 1], w[end])

    def scan(self, w: list[bytes]) -> Iterator[tuple[int, set[str]]]:
        """Start and items of each occurrence."""
        n, far, shift, size = self.n, self.far, self.shift.get, len(w)
        one, end = self.b == 1, self.n - 1
        while end < size:
            block = w[end] if one else (w[end - 1], w[end])
            move = shift(block, far)
            if move:
                end += move
                continue
            start = end - n + 1
            for p in self.bucket[block].get(w[start], ()):
                if all(x == y for x, y in zip(p, w[start : end + 1])):
                    yield start, self.patterns[p]
            end += 1


def searchers(items: Iterable[tuple[str | None, str | None]], size: int = WINDOW) -> list[WuManber]:
    by: dict[int, dict[tuple[bytes, ...], set[str]]] = {}
    for item, text in items:
        w = words(text)
        n = min(size, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            by.setdefault(n, {}).setdefault(tuple(w[i : i + n]), set()).update([] if item is None else [item])
    return [WuManber(n, p) for n, p in sorted(by.items())]


def covered(spans: list[int]) -> int:
    """Words inside spans, which are start and end by turns, in any order and overlapping."""
    total, at = 0, 0
    for start, end in sorted(zip(spans[::2], spans[1::2])):
        total += max(0, end - max(start, at))
        at = max(at, end)
    return total


def merged(spans: list[tuple[int, int]]) -> list[int]:
    out: list[int] = []
    for start, end in sorted(spans):
        if out and start <= out[-1]:
            out[-1] = max(out[-1], end)
        else:
            out += [start, end]
    return out


def search(text: str | None, tables: list[WuManber]) -> dict:
    w = words(text)
    spans, items = [], set()
    for t in tables:
        for start, found in t.scan(w):
            spans.append((start, start + t.n))
            items |= found
    return {"n_words": len(w), "spans": merged(spans), "items": sorted(items)}


_built: dict = {}


def _tables(block, size: int) -> list[WuManber]:
    """One block's searchers, built once in each Python worker; an older block's make room."""
    name, items = block.value
    if (name, size) not in _built:
        _built.clear()
        _built[name, size] = searchers(items, size)
    return _built[name, size]


def blocks(bench: DataFrame, item: str, text: str, most: int) -> Iterator[list[tuple[str | None, str | None]]]:
    """The benchmark in lists of at most `most` bytes of text (or one item); the driver holds one partition at a time."""
    out: list[tuple[str | None, str | None]] = []
    held = 0
    for row in bench.select(F.col(item).cast("string").alias("i"), F.col(text).alias("t")).where("t is not null").toLocalIterator():
        if out and held + len(row.t) > most:
            yield out
            out, held = [], 0
        out.append((row.i, row.t))
        held += len(row.t)
    yield out


def find(docs: DataFrame, bench: DataFrame, *, text: str = "text", item: str = "item_id", item_text: str = "text", size: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, str]:
    """docs with a struct column of n_words, spans (merged, as word positions) and items; and that column's name."""
    spark = docs.sparkSession
    scratch, name, out = Scratch(spark, "decontam"), free_name(docs.columns, "found"), None
    for k, block in enumerate(blocks(bench, item, item_text, block_bytes)):
        held = spark.sparkContext.broadcast((uuid.uuid4().hex, block))
        if out is None:
            out = append(docs, text, [T.StructField(name, FOUND)], lambda col, held=held: [pa.array([search(x, _tables(held, size)) for x in col.to_pylist()], _ARROW)])
            continue
        prior, extra = scratch.table(out, f"pass{k}"), free_name([*out.columns], "more")
        scratch.drop(f"pass{k - 1}")  # what pass k - 1 carried on is in pass k
        both = append(prior, text, [T.StructField(extra, FOUND)], lambda col, held=held: [pa.array([search(x, _tables(held, size)) for x in col.to_pylist()], _ARROW)])
        out = both.withColumn(name, F.struct(F.col(f"{name}.n_words").alias("n_words"), F.concat(f"{name}.spans", f"{extra}.spans").alias("spans"), F.array_union(f"{name}.items", f"{extra}.items").alias("items"))).drop(extra)
    return out, name


def decontaminate(docs: DataFrame, bench: DataFrame, **options) -> DataFrame:
    """The rows of docs that hold no window of any benchmark item, with the columns of docs."""
    out, name = find(docs, bench, **options)
    return out.where(F.size(F.col(f"{name}.spans")) == 0).select(*[F.col(f"`{c}`") for c in docs.columns])


def op4(spark, sf_dir: str) -> DataFrame:
    out, name = find(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "benchmark"))

    def digest(batches):
        for b in batches:
            rows = b.column("found").to_pylist()
            hit = [covered(r["spans"]) for r in rows]
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id"), pa.array([r["n_words"] for r in rows], pa.int64()), pa.array(hit, pa.int64()),
                pa.array([len(r["items"]) for r in rows], pa.int64()),
                pa.array([hashlib.sha256(",".join(sorted(r["items"])).encode()).hexdigest() for r in rows]),
                pa.array([h > 0 for h in hit]),
            ], names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])

    return out.select("doc_id", F.col(name).alias("found")).mapInArrow(digest, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")


SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
p AS (SELECT item_id, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i, w FROM b WHERE len(w) > 0),
pat AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS k FROM p),
lens AS (SELECT DISTINCT n FROM pat),
pos AS (SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i, w FROM d, lens WHERE len(w) >= n),
occ AS (SELECT doc_id, q.n, i, item_id FROM (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS k FROM pos) q JOIN pat ON pat.n = q.n AND pat.k = q.k),
hit AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM occ) GROUP BY 1),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM occ) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
"""
