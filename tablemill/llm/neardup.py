"""MinHash near-duplicates by a multi-index Hamming join over b-bit signatures.

A text's set holds its distinct shingles, as 64-bit hashes. Its signature has PLACES minimum hashes of 16 bits each.
Signatures are split into PLACES / CHUNK chunks. If two differ in at most DISTANCE places, then by the pigeonhole
principle some chunk differs in at most ERRORS places, so both texts emit the same key for the chunk with those places
left out: every text emits a key for each way to leave ERRORS places out of each chunk. All pairs within DISTANCE are
met; at a similarity of exactly 0.8, three pairs in a million are beyond it (of 48 places, 24 or more differ). Met pairs are
confirmed on the full sets. Before a pair leaves the task that met it, an upper bound of its intersection must allow the
similarity; the bound never rules a link out. A text carries a 16-bit print of every shingle, so of two sets up to SMALL
shingles a common shingle is always a common print; of larger ones the counts of prints in BINS bins are compared: the
sum of the smaller counts is the bound. Above BINS shingles the counts stand for the prints, so a row has a bounded size.

Groups of copies are never expanded into pairs. Equal sets become one representative first. Texts that share a key are
linked to the smallest of them, those links are confirmed and joined to components, and only then are further pairs of
a key compared: those whose texts are still in different components. So a group of n near copies costs n links, and
no link between components is lost. Keys above TILE texts are dealt in tiles: their texts of the key's largest component
are met by the others only, not by each other. So no comparing task holds a whole key.

Where those others are more than a tile, the key's texts are dealt anew, by shingles: two sets that reach the similarity
share one of the rarest shingles of either, among as many as the similarity lets them differ in, and one more (`rare`).
So no link is lost, and texts that share a key by a common passage only hardly meet. Texts that share such a shingle are
treated like those that share a key: a star among them is linked first, and then components meet, in tiles if need be.

Signatures, keys that several texts share, links and components are written to the shared folder. The driver sees none.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablemill.llm.common import Scratch, empty, maybe
from tablemill.llm.components import components

PLACES, CHUNK, ERRORS = 48, 4, 1
CHUNKS = PLACES // CHUNK
DISTANCE = CHUNKS * (ERRORS + 1) - 1
TILE = 2048
_rng = np.random.default_rng(20240101)
_MULTIPLY = _rng.integers(1, 2**63, PLACES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 2**63, PLACES, dtype=np.uint64)
_MASKS = [m for m in combinations(range(CHUNK), CHUNK - ERRORS)]
WORDS_KEPT = 200_000
SMALL, BINS = 256, 2048
STAR = 16
RANKS = 2**18

_hashes: dict[bytes, int] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (splitmix64's)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def ascii_words(text: str | None) -> list[bytes]:
    """What white space (space, tab, line breaks) leaves, A-Z in lower case; in UTF-8."""
    return text.encode().lower().split() if text else []


def shingles(words: list[bytes], size: int) -> np.ndarray:
    """Sorted distinct hashes of runs of `size` words; fewer words make one run."""
    if not words:
        return np.zeros(0, np.uint64)
    if len(_hashes) > WORDS_KEPT:
        _hashes.clear()
    get = _hashes.get
    h = np.array([get(w) or _hashes.setdefault(w, xxhash.xxh3_64_intdigest(w) or 1) for w in words], np.uint64)
    n = min(size, len(h))
    out = np.full(len(h) - n + 1, n, np.uint64)
    for k in range(n):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + h[k : len(h) - n + 1 + k])
    return np.unique(out)


def signature(s: np.ndarray) -> bytes:
    """PLACES minimum hashes, the upper 16 bits of each; empty for an empty set. Long sets go in slices."""
    if not len(s):
        return b""
    low = np.full(PLACES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(s), 4096):
        part = mix(s[at : at + 4096, None] * _MULTIPLY + _ADD)
        low = np.minimum(low, part.min(axis=0))
    return (mix(low) >> np.uint64(48)).astype("<u2").tobytes()


def prints(s: np.ndarray) -> bytes:
    """A print of 16 bits for each shingle or, above BINS shingles, the prints' count in each bin. Empty if a count needs
    more than 16 bits: such a set has no bound."""
    h = (mix(s ^ np.uint64(0x5851F42D4C957F2D)) & np.uint64(0xFFFF)).astype("<u2")
    if len(h) <= BINS:
        return h.tobytes()
    n = np.bincount(h % BINS, minlength=BINS)
    return b"" if n.max() > 0xFFFF else n.astype("<u2").tobytes()


class Prints:
    """The prints of a tile's texts, for bounds of one text's intersections with many."""

    def __init__(self, col: pa.Array, n: np.ndarray, percent: int):
        rows = [np.frombuffer(x, "<u2") for x in col.to_pylist()]
        self.n, self.percent = n.astype(np.int64), percent
        self.small, self.open = n <= SMALL, np.array([not len(r) for r in rows])
        self.of = np.full((len(rows), SMALL), 0x10000, np.int32)  # no text has this print
        for k in np.flatnonzero(self.small):
            self.of[k, : len(rows[k])] = rows[k]
        if not self.small.all():
            self.bins = np.stack([r if m > BINS and len(r) else np.bincount(r % BINS, minlength=BINS).astype("<u2") for r, m in zip(rows, n)])
        self.mark = np.zeros(0x10001, bool)

    def allow(self, at: int, others: np.ndarray) -> np.ndarray:
        """Those of the others whose similarity with text `at` can reach percent."""
        out = []
        for part in (others[k : k + 1024] for k in range(0, len(others), 1024)):
            common = np.minimum(self.n[part], self.n[at])
            known = ~(self.open[part] | self.open[at])
            few = known & self.small[part] & self.small[at]
            if few.any():
                mine = self.of[at, : self.n[at]]
                self.mark[mine] = True
                common[few] = self.mark[self.of[part[few]]].sum(axis=1)
                self.mark[mine] = False
            if (many := known & ~few).any():
                common[many] = np.minimum(self.bins[part[many]], self.bins[at]).sum(axis=1, dtype=np.int64)
            out.append(part[100 * common >= self.percent * (self.n[part] + self.n[at] - common)])
        return np.concatenate(out) if out else others[:0]


def keys(sig: np.ndarray) -> np.ndarray:
    """Of n signatures (n x PLACES), the keys (n x CHUNKS * masks) as signed 64-bit numbers."""
    out = []
    chunks = sig.reshape(len(sig), CHUNKS, CHUNK).astype(np.uint64)
    for k, m in enumerate(_MASKS):
        key = np.zeros(chunks.shape[:2], np.uint64)
        for place in m:
            key = (key << np.uint64(16)) | chunks[:, :, place]
        out.append(mix(key * np.uint64(0x9E3779B97F4A7C15) + (np.arange(CHUNKS, dtype=np.uint64) * np.uint64(len(_MASKS)) + np.uint64(k))))
    return np.concatenate(out, axis=1).view(np.int64)


def sets(docs: DataFrame, words: Callable, size: int) -> DataFrame:
    """docs has key and text; n, the set's hash, the signature and the prints."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 1024):
                part = b.slice(at, 1024)
                found = [shingles(words(t), size) for t in part.column(1).to_pylist()]
                whole = [xxhash.xxh3_128_digest(s.tobytes()) for s in found]
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array([len(s) for s in found], pa.int64()), pa.array(whole, pa.binary()), pa.array([signature(s) for s in found], pa.binary()), pa.array([prints(s) for s in found], pa.binary()),
                ], names=["doc", "n", "whole", "sig", "prints"])

    return docs.mapInArrow(run, "doc long, n long, whole binary, sig binary, prints binary")


def _signatures(col: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), "<u2").reshape(-1, PLACES)


def shared_keys(reps: DataFrame) -> DataFrame:
    """key, doc and the key's smallest doc and size, of the keys that several representatives share."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 1024):
                part = b.slice(at, 1024)
                k = keys(_signatures(part.column("sig")))
                yield pa.RecordBatch.from_arrays([pa.array(k.ravel()), pa.array(np.repeat(part.column("doc").to_numpy(), k.shape[1]))], names=["key", "doc"])

    return several(reps.where("length(sig) > 0").select("doc", "sig").mapInArrow(emit, "key long, doc long"))


def several(rows: DataFrame) -> DataFrame:
    """key, doc and the key's smallest doc as its center, of the keys with several of the rows (key, doc)."""

    def common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows are sorted by key and doc. A key's first row waits until a second one comes, perhaps in the next batch."""
        key = center = None
        waits = False
        for b in batches:
            k, d = b.column("key").to_numpy(), b.column("doc").to_numpy()
            if not len(k):
                continue
            first = np.concatenate([[key is None or k[0] != key], k[1:] != k[:-1]])
            start = np.maximum.accumulate(np.where(first, np.arange(len(k)), -1))
            centers = np.where(start < 0, 0 if center is None else center, d[start])
            keep = ~(first & np.concatenate([first[1:], [True]]))
            out = (k[keep], d[keep], centers[keep])
            if waits and not first[0]:
                out = tuple(np.concatenate([[x], y]) for x, y in zip((key, center, center), out))
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=["key", "doc", "center"])
            key, center, waits = k[-1], centers[-1], bool(first[-1])

    return rows.repartition(F.col("key")).sortWithinPartitions("key", "doc").mapInArrow(common, "key long, doc long, center long")


def rare(s: np.ndarray, counts: np.ndarray, percent: int) -> np.ndarray:
    """The rarest shingles of a set by the counts, as many as a set that reaches the similarity may lack, and one more.

    All sets are put in one order, so of two that reach the similarity, the common shingle that comes first is in both
    parts: at least percent of either set is common, and none of that comes before it."""
    order = np.lexsort((s, counts[s % np.uint64(RANKS)]))
    return s[order[: len(s) + 1 - -(-percent * len(s) // 100)]]


def rare_shingles(docs: DataFrame, wide: DataFrame, words: Callable, size: int, percent: int) -> DataFrame:
    """key (a shingle) and doc, of the rarest shingles of the docs named by wide, by counts in RANKS bins of shingles."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(RANKS, np.int64)
        for b in batches:
            for at in range(0, b.num_rows, 256):
                found = np.concatenate([shingles(words(t), size) for t in b.column(1).slice(at, 256).to_pylist()])
                n += np.bincount((found % np.uint64(RANKS)).astype(np.int64), minlength=RANKS)
        (bins,) = np.nonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(bins), pa.array(n[bins])], names=["bin", "n"])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                found = [rare(shingles(words(t), size), counts, percent).view(np.int64) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found)), pa.array(np.repeat(part.column(0).to_numpy(), [len(x) for x in found]))], names=["key", "doc"])

    named = maybe(docs.where("key IS NOT NULL"), wide)
    bins = named.mapInArrow(count, "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(RANKS, np.int64)
    counts[bins.column("bin").to_numpy()] = bins.column("n").to_numpy()
    return named.mapInArrow(emit, "key long, doc long")


def close(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return (x != y).sum(axis=-1) <= DISTANCE


def may_match(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of these sizes can reach the similarity at all."""
    return np.minimum(n, m) * 100 >= np.maximum(n, m) * percent


def within(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose signatures are within DISTANCE and whose sizes allow a match; with n of both."""
    x, y = (reps.select(F.col("doc").alias(c), F.col("n").alias(f"n{c}"), F.col("sig").alias(f"sig{c}")) for c in "ab")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = close(_signatures(b.column("siga")), _signatures(b.column("sigb"))) & may_match(b.column("na").to_numpy(), b.column("nb").to_numpy(), percent)
            yield pa.RecordBatch.from_arrays([pa.array(b.column(c).to_numpy()[ok]) for c in ("a", "b", "na", "nb")], names=["a", "b", "na", "nb"])

    return pairs.join(x, "a").join(y, "b").select("a", "b", "na", "nb", "siga", "sigb").mapInArrow(run, "a long, b long, na long, nb long")


def confirm(pairs: DataFrame, docs: DataFrame, words: Callable, size: int, percent: int) -> DataFrame:
    """The pairs with 100 * intersection >= percent * union, on the full sets of only the texts they name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                found = [shingles(words(t), size).view(np.int64) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.list_(pa.int64()))], names=["doc", "items"])

    named = pairs.select(F.col("a").alias("doc")).union(pairs.select("b")).distinct()
    items = maybe(docs, named).mapInArrow(run, "doc long, items array<long>")
    both = pairs.join(items.select(F.col("doc").alias("a"), F.col("items").alias("x")), "a").join(items.select(F.col("doc").alias("b"), F.col("items").alias("y")), "b")
    share = F.size(F.array_intersect("x", "y"))
    return both.withColumn("i", share).where(F.expr(f"100 * i >= {percent} * (na + nb - i)")).select("a", "b")


def mixed_keys(shared: DataFrame, labels: DataFrame, tile: int, keep: Callable = lambda df: df) -> tuple[DataFrame, DataFrame]:
    """The texts, with components, of the keys that hold several components; and of those keys with more than a tile of
    texts: main, the component of most texts, how many are in it and how many are not. keep may write the former, from
    which the latter are made."""
    at = lambda c, to: labels.select(F.col("node").alias(c), F.col("component").alias(to))
    known = shared.join(at("doc", "c"), "doc", "left").withColumn("c", F.coalesce("c", "doc"))
    known = known.join(at("center", "cc"), "center", "left").withColumn("cc", F.coalesce("cc", "center"))
    mixed = known.groupBy("key").agg(F.count("*").alias("size"), F.max((F.col("c") != F.col("cc")).cast("int")).alias("mixed")).where("mixed = 1").select("key", "size")
    rows = keep(known.select("key", "doc", "c").join(mixed, "key"))
    most = rows.where(F.col("size") > tile).groupBy("key", "c").agg(F.count("*").alias("n")).groupBy("key")
    large = most.agg(F.expr("max(struct(n, -c as c))").alias("top"), F.sum("n").alias("n")).select("key", (-F.col("top.c")).alias("main"), F.col("top.n").alias("inside"), (F.col("n") - F.col("top.n")).alias("others"))
    return rows, large


def second_stars(rows: DataFrame, large: DataFrame, tile: int) -> DataFrame:
    """Of large keys with more than a tile of texts outside main: the smallest such text (a) with each of the others (b)."""
    out = rows.join(large.where(F.col("others") > tile), "key").where("c <> main").select("key", "doc", "c")
    first = out.groupBy("key").agg(F.expr("min(struct(doc as a, c as ca))").alias("first"))
    return out.join(first, "key").where("c <> first.ca").select("first.a", F.col("doc").alias("b")).distinct()


def across(rows: DataFrame, large: DataFrame, reps: DataFrame, percent: int, tile: int = TILE, signature_keys: bool = True) -> DataFrame:
    """Pairs within DISTANCE that share a key but no component yet and whose bound allows a match, with n of both. A pair
    that shares several keys of signatures is met at the first of them only; other keys are no part of a signature.

    Keys up to a tile are one group. Of larger ones, tiles 0, 1, ... hold the texts outside main and the tiles behind them
    those of main; a group is two tiles, the first of which is one of the others'."""
    deal = F.expr(f"""CASE WHEN main IS NULL THEN named_struct('own', 0, 'all', 1)
        WHEN c = main THEN named_struct('own', cast(ceil(others / {tile}) + pmod(xxhash64(doc), ceil(inside / {tile})) as int), 'all', cast(ceil(others / {tile}) as int))
        ELSE named_struct('own', cast(pmod(xxhash64(doc), ceil(others / {tile})) as int), 'all', cast(ceil(others / {tile}) + ceil(inside / {tile}) as int)) END""")
    own = rows.join(large, "key", "left").withColumn("deal", deal).select("key", "doc", "c", F.col("deal.own").alias("own"), F.col("deal.all").alias("all"))
    own = own.join(reps.select("doc", "n", "sig", "prints"), "doc").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("all") - 1)))
    dealt = own.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "doc", "c", "n", "sig", "prints")
    together = dealt.repartition(F.col("key"), F.col("i"), F.col("j")).sortWithinPartitions("key", "i", "j", "doc")

    def compare(own, doc, c, n, sig, bound: Prints, group: tuple) -> Iterator[pa.RecordBatch]:
        slots = keys(sig) if signature_keys else None
        for at in range(len(doc) - 1):
            later = slice(at + 1, None)
            ok = (c[later] != c[at]) & may_match(n[later], n[at], percent)
            if group[1] != group[2]:
                ok &= own[later] != own[at]
            found = np.flatnonzero(ok) + at + 1
            found = found[close(sig[found], sig[at])]
            if signature_keys:
                found = found[slots[at][(slots[found] == slots[at]).argmax(axis=1)] == group[0]]
            found = bound.allow(at, found)
            if len(found):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), doc[at])), pa.array(doc[found]), pa.array(np.full(len(found), n[at])), pa.array(n[found])], names=["a", "b", "na", "nb"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        key = None

        def done():
            if held:
                t = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                n = t["n"].to_numpy()
                yield from compare(t["own"].to_numpy(), t["doc"].to_numpy(), t["c"].to_numpy(), n, _signatures(t["sig"]), Prints(t["prints"], n, percent), key)

        for b in batches:
            k = np.stack([b.column(x).to_numpy().astype(np.int64) for x in ("key", "i", "j")], axis=1)
            edges = [0, *(np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1), len(k)]
            for s, e in zip(edges, edges[1:]):
                if s < e:
                    if tuple(k[s]) != key:
                        yield from done()
                        held, key = [], tuple(k[s])
                    held.append(b.slice(s, e - s))
        yield from done()

    out = together.mapInArrow(run, "a long, b long, na long, nb long")
    return out if signature_keys else out.distinct()


def near_duplicates(docs: DataFrame, *, id: str = "doc_id", text: str = "text", shingle_words: int = 5, percent: int = 80, words: Callable = ascii_words, tile: int = TILE) -> DataFrame:
    """A row for each row of docs with an id: doc, n_shingles, component (smallest id reachable), kept.

    Edge cases: null and wordless texts have no shingles and are linked with nothing; a text of fewer words than a
    shingle is one shingle; rows that share an id are taken together: the first by text stands for them in links, and
    each row is returned with its own n_shingles; rows with a null id are returned as their own, kept, with a null
    component; an empty table gives no rows; further columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "neardup")
    own = docs.select(F.col(id).cast("long").alias("key"), F.col(text).alias("text"))
    every = scratch.table(sets(own, words, shingle_words), "sets")
    first = every.where("doc IS NOT NULL AND n > 0").groupBy("whole").agg(F.min("doc").alias("rep"), F.max("doc").alias("last"), F.min("n").alias("n"), F.min("sig").alias("sig"), F.min("prints").alias("prints"))
    reps = scratch.table(first, "reps")
    stand = reps.select(F.col("rep").alias("doc"), "n", "sig", "prints")
    shared = scratch.table(shared_keys(stand), "keys")
    stars = shared.where("doc <> center").select(F.col("center").alias("a"), F.col("doc").alias("b")).distinct()
    near = scratch.table(within(stars, stand, percent), "stars")
    links = scratch.table(confirm(near, own, words, shingle_words, percent), "star-links")
    labels = scratch.table(components(links, scratch, "first"), "labels")
    rows, large = mixed_keys(shared, labels, tile, lambda df: scratch.table(df, "mixed"))
    large = scratch.table(large, "large")
    wide = large.where(F.col("others") > tile)
    if empty(wide):
        rest = across(rows, large, stand, percent, tile)
    else:
        # a pair of a wide key is met by its shingles, so it may be passed over at the other keys it shares
        rest = across(rows.join(wide, "key", "left_anti"), large, stand, percent, tile)
        named = scratch.table(rows.join(wide, "key", "left_semi").select("doc").distinct(), "wide")
        shared = scratch.table(several(rare_shingles(own, named, words, shingle_words, percent)), "rare")
        rows, large = mixed_keys(shared, labels, min(tile, STAR), lambda df: scratch.table(df, "rare-mixed"))
        near = scratch.table(within(second_stars(rows, large, min(tile, STAR)), stand, percent), "rare-stars")
        if not empty(near):
            every_link = confirm(near, own, words, shingle_words, percent).unionByName(labels.select(F.col("component").alias("a"), F.col("node").alias("b")))
            labels = scratch.table(components(scratch.table(every_link, "rare-links"), scratch, "second"), "rare-labels")
        rows, large = mixed_keys(shared, labels, tile, lambda df: scratch.table(df, "rare-rest"))
        rest = rest.unionByName(across(rows, large, stand, percent, tile, signature_keys=False))
    rest = scratch.table(rest, "rest")
    more = confirm(rest, own, words, shingle_words, percent)
    # copies of one set meet at their representative
    copies = every.join(reps.where("rep <> last").select("whole", "rep"), "whole").where("doc <> rep").select(F.col("rep").alias("a"), F.col("doc").alias("b"))
    everything = labels.select(F.col("component").alias("a"), F.col("node").alias("b")).unionByName(more).unionByName(copies)
    final = scratch.table(components(everything, scratch, "final"), "final")
    out = every.select("doc", F.col("n").alias("n_shingles")).join(final, F.col("doc") == F.col("node"), "left")
    out = out.withColumn("component", F.coalesce("component", "doc"))
    return out.select("doc", "n_shingles", "component", F.coalesce(F.col("doc") == F.col("component"), F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, *, id: str = "doc_id", **options) -> DataFrame:
    """The rows of docs that stand for their group; rows with a null id stay."""
    gone = near_duplicates(docs, id=id, **options).where("NOT kept").select(F.col("doc").alias("doc__gone"))
    return docs.join(gone, F.col(f"`{id}`") == F.col("doc__gone"), "left_anti")


def op10(spark, sf_dir: str) -> DataFrame:
    out = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), shingle_words=2)
    return out.select(F.col("doc").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"), "kept")


SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 2 THEN w[1] ELSE w[i] || ' ' || w[i + 1] END AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * i >= 80 * (x.n + y.n - i)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT a AS node, a AS reach FROM e UNION SELECT r.node, e.b FROM r JOIN e ON r.reach = e.a),
c AS (SELECT node, min(reach) AS c FROM r GROUP BY 1)
SELECT w.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, coalesce(c, w.doc_id) AS component_id, coalesce(c, w.doc_id) = w.doc_id AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN c ON c.node = w.doc_id
"""
