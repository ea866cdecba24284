"""Sequence packing as a cutting-stock problem solved by column generation.

A document is tokenized, cut into full sequences and one remainder, and the remainders go to length classes of
`GRAIN` tokens. The histogram of classes, which has at most CAPACITY / GRAIN entries at any size of corpus, is all the
driver sees: a linear program over packing patterns starts from one pattern a class, an unbounded-knapsack dynamic
program prices the duals for the best new pattern, and Farley's bound ends the loop. Patterns are rounded down, what is
left is packed largest first, and every (pattern, class) pair takes a range of ranks, so that documents ranked within
their class find their sequence by binary search.

Ranks need no sort of a class in one place: each task numbers its own pieces, and the counts by task and class give
each task its first rank. The numbered pieces are written to the shared folder, so a repeated task sees the same ranks.

Edge cases: a null or empty text is the end token alone; repeated documents are packed each; an empty table gives no
rows; a null id passes through; further columns are ignored. A sequence whose fill is a power of two needs no padding.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablemill.llm.common import Scratch, read

CAPACITY, GRAIN, END = 4096, 16, 2
TOKENIZER = "word_bpe_49k.json"
CACHE = 400_000


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


#: Latin text, for which the tokenizer's normalizer is lower-casing and white space alone.
_PLAIN = re.compile(r"[\t\n\r -~\u00a0-\u00b1\u00b4-\u00b8\u00ba\u00bb\u00bf-\u012f\u0131-\u024f]*")
#: The tokenizer's own split into words, for such text in lower case.
_SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+")


class Words(dict):
    """A word's ids as bytes; a new word's come from the tokenizer's merges."""

    def __init__(self, model):
        self.model = model
        own = {*range(33, 127), *range(161, 173), *range(174, 256)}
        self.alphabet = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in own)}

    def __missing__(self, word: str) -> bytes:
        shown = word if word.isascii() else word.encode().decode("latin-1").translate(self.alphabet)
        out = self[word] = array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()
        return out


class Encoder:
    """Token ids of whole texts as little-endian unsigned 32-bit bytes.

    The tokenizer splits a text into words and merges each by itself, so a Latin text's ids are its words' ids put
    together, kept in a table of bounded size. Any other text, and one that could hold a special token, goes through
    the whole tokenizer.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.words = Words(self.tok.model)

    def encode(self, texts: list[str | None], end: int = END) -> list[bytes]:
        if len(self.words) > CACHE:
            self.words.clear()
        last, get, out = int(end).to_bytes(4, "little"), self.words.__getitem__, []
        for t in texts:
            if not t:
                out.append(last)
            elif "<|" not in t and _PLAIN.fullmatch(t):
                out.append(b"".join(map(get, _SPLIT.findall(t.lower()))) + last)
            else:
                out.append(array("I", self.tok.encode(t, add_special_tokens=False).ids).tobytes() + last)
        return out


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, cls int, part int, idx long"


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, grain: int = GRAIN) -> DataFrame:
    """docs has doc_id and text. A row a piece: numbered from 0 within its class and task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc, part, number = encoder(path), TaskContext.get().partitionId(), np.zeros(-(-capacity // grain) + 1, np.int64)
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "cls", "part", "idx"]
        types = [pa.int64()] * 5 + [pa.int32(), pa.int32(), pa.int64()]
        for b in batches:
            for at in range(0, b.num_rows, 256):
                rows = b.slice(at, 256)
                out: list[tuple] = []
                for doc, ids in zip(rows.column(0).to_pylist(), enc.encode(rows.column(1).to_pylist())):
                    n = len(ids) // 4
                    for s in range(0, n, capacity):
                        size = min(capacity, n - s)
                        cls = -(-size // grain)
                        out.append((doc, s, size, zlib.crc32(ids[4 * s : 4 * (s + size)]), n, cls, part, int(number[cls])))
                        number[cls] += 1
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    return docs.mapInArrow(run, PIECES)


def knapsack(value: np.ndarray, width: np.ndarray, capacity: int, most: int = 1) -> tuple[float, list[np.ndarray]]:
    """Best total value of any number of copies of each item within the capacity; and the best pattern, followed by the
    best ones that are made to hold one given item, for the `most` items where that is worth most."""
    worth = np.full(capacity + 1, -1.0)  # by width
    worth[width] = value
    at = np.full(capacity + 1, -1)
    at[width] = np.arange(len(width))
    best, pick = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    backward = np.zeros(capacity + 1)  # best, from the end
    for j in range(1, capacity + 1):
        got = backward[capacity + 1 - j :] + worth[1 : j + 1]
        i = int(got.argmax())
        best[j] = best[j - 1]
        if got[i] > best[j] + 1e-12:
            best[j], pick[j] = got[i], i + 1
        backward[capacity - j] = best[j]

    def pattern(j: int, first: int = 0) -> np.ndarray:
        copies = np.zeros(len(width), np.int64)
        if first:
            copies[at[first]] += 1
            j -= first
        while j > 0:
            if pick[j]:
                copies[at[pick[j]]] += 1
                j -= pick[j]
            else:
                j -= 1
        return copies

    with_item = value + best[capacity - width]
    return float(best[capacity]), [pattern(capacity), *(pattern(capacity, int(width[i])) for i in np.argsort(-with_item, kind="stable")[: most - 1])]


def relaxed(width: np.ndarray, demand: np.ndarray, capacity: int, gap: float = 1e-4, most: int = 5000, columns: int = 24) -> tuple[np.ndarray, np.ndarray]:
    """Columns (patterns) and amounts of the linear relaxation, by the revised simplex with generated columns."""
    m = len(width)
    basis = np.diag(capacity // width).astype(float)
    inverse, x, pivots = np.diag(1 / np.diag(basis)), demand / np.diag(basis), 0
    while pivots < most:
        value, found = knapsack(np.maximum(inverse.sum(axis=0), 0), width, capacity, columns)
        total = x.sum()
        if value <= 1 + 1e-9 or total - total / value <= max(gap * total, 1e-6):  # Farley: total / value is a lower bound
            break
        for column in found:
            if inverse.sum(axis=0) @ column <= 1 + 1e-9:
                continue
            move = inverse @ column
            with np.errstate(divide="ignore", invalid="ignore"):
                ratio = np.where(move > 1e-9, x / move, np.inf)
            r = int(ratio.argmin())
            theta = ratio[r]
            x -= theta * move
            x[r] = theta
            basis[:, r] = column
            pivot = inverse[r] / move[r]
            inverse -= np.outer(move, pivot)
            inverse[r] = pivot
            pivots += 1
            if pivots % 200 == 0:
                inverse = np.linalg.inv(basis)
                x = inverse @ demand
            x = np.maximum(x, 0)
    return basis.astype(np.int64), np.maximum(np.linalg.solve(basis, demand), 0) if m else x


def plan(classes: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Patterns (class: copies) and how often each is used; together they hold each class exactly as often as asked."""
    width = np.array(sorted(classes), np.int64)
    if not len(width):
        return []
    demand = np.array([classes[int(w)] for w in width], np.int64)
    columns, x = relaxed(width, demand.astype(float), capacity)
    out, left = [], demand.copy()
    for k in np.argsort(-x, kind="stable"):
        column = columns[:, k]
        used = column > 0
        times = int(min(np.floor(x[k] + 1e-6), (left[used] // column[used]).min())) if used.any() else 0
        if times > 0:
            out.append(({int(w): int(c) for w, c in zip(width[used], column[used])}, times))
            left -= times * column
    while left.any():
        room, pattern = capacity, {}
        for k in range(len(width) - 1, -1, -1):
            if n := int(min(left[k], room // width[k])):
                pattern[k] = n
                room -= n * int(width[k])
        times = min(int(left[k]) // n for k, n in pattern.items())
        out.append(({int(width[k]): n for k, n in pattern.items()}, times))
        for k, n in pattern.items():
            left[k] -= times * n
    return out


def ranges(patterns: list[tuple[dict[int, int], int]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By class: first ranks of the patterns that use it, its copies in each, and each one's first sequence."""
    sequence, by, taken = 0, {}, {}
    for pattern, times in patterns:
        for c, n in pattern.items():
            by.setdefault(c, []).append((taken.get(c, 0), n, sequence))
            taken[c] = taken.get(c, 0) + n * times
        sequence += times
    return {c: tuple(np.array(col, np.int64) for col in zip(*rows)) for c, rows in by.items()}


def pack(docs: DataFrame, *, id: str = "doc_id", text: str = "text", tokenizer: str = TOKENIZER, capacity: int = CAPACITY, grain: int = GRAIN) -> DataFrame:
    """A row a piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "packing")
    cut = scratch.table(pieces(docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text")), tokenizer_path(tokenizer), capacity, grain), "pieces")
    counts = cut.groupBy("cls", "part").agg(F.count("*").alias("n"))
    histogram = {r.cls: r.n for r in counts.groupBy("cls").agg(F.sum("n").alias("n")).collect()}  # at most capacity / grain rows
    at = ranges(plan(histogram, -(-capacity // grain)))
    before = counts.withColumn("first", F.coalesce(F.sum("n").over(Window.partitionBy("cls").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    ranked = cut.join(before.drop("n"), ["cls", "part"]).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "cls", (F.col("first") + F.col("idx")).alias("rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cls, rank = b.column("cls").to_numpy(zero_copy_only=False), b.column("rank").to_numpy(zero_copy_only=False)
            sequence = np.zeros(len(cls), np.int64)
            for c in np.unique(cls):
                own = cls == c
                first, copies, base = at[int(c)]
                k = np.searchsorted(first, rank[own], side="right") - 1
                sequence[own] = base[k] + (rank[own] - first[k]) // copies[k]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(sequence)], names=[*b.schema.names, "sequence_id"])

    placed = ranked.mapInArrow(place, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, cls int, rank long, sequence_id long")
    inside = Window.partitionBy("sequence_id").orderBy(F.desc("cls"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(inside), F.lit(0))).drop("cls", "rank")


def op6(spark, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"))
