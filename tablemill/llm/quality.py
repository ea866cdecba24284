"""Quality by perplexity: an interpolated modified Kneser-Ney n-gram model of characters, trained on trusted text.

Counts of the highest order come from all trusted texts, summed within tasks before they are exchanged; the lower
orders' continuation counts come from the same exchange, as each gram is sent along with its shorter endings. The
counts, which grow with the corpus far more slowly than its text, are one table.

Scoring joins documents with the model shard by shard: a shard holds languages, or a range of one language's contexts
(ordered by their last symbol, then the one before, and so on), of at most SHARD grams; a symbol with more is cut by the
symbols before it, and a whole context has at most 2 ** BITS grams. So what is broadcast at once has a bound at any size
of model (SHARD, and at each end of a range the grams of its shorter contexts, at most 2 ** BITS an order). All
that a gram's probability needs (its context, its shorter endings) is in its shard, so a shard's interpolated
probabilities and back-off weights come from its counts and its languages' discounts (by language and order, from the
counts of counts over all shards). A document's log probability is the sum over the shards. Documents are read once,
without a shuffle: a task holds a batch of them and one shard after the other.

No document is scored by a model that has seen it: texts are dealt to FOLDS folds by their hash, each fold has a model
of the trusted texts of the other folds, and every document, trusted or not, is scored by the model of its text's fold
(so are exact copies of trusted texts). The folds' models come from one count table with a count column a fold.

A document is rejected if its perplexity (per character) lies above the upper or below the lower quantile of its
language's trusted documents; `slack` widens that band by so much of its width on both sides (0: not at all).

Characters are 12-bit symbols, one to one: code points below WIDE are one symbol, others two, of a lead and a trail that
no other character has (as in UTF-16), so no two characters of any script are counted as one. The perplexity is per
character. Texts are padded in front, so that their first characters are predicted, too.

Edge cases: a null or empty text has a null perplexity and is kept; so is a text in a language without trusted text in
other folds (null languages are one language); repeated documents each count; labels of a document that disagree make it
untrusted; empty tables give no rows or keep all; further columns pass through in `keep_clean`.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablemill.llm.common import Scratch, append, free_name, maybe, read

ORDER, BITS = 5, 12
#: Symbols: 1 pads, 2 to WIDE + 1 are code points below WIDE, then the leads (a code point's bits above the tenth), and
#: from TRAIL its lowest ten bits.
WIDE, TRAIL = 1980, 3072
SHARD = 3_000_000
FOLDS = 5
#: Quantiles of trusted documents' log perplexity, and the part of their distance by which a document may lie outside.
LOWER, UPPER, SLACK = 0.01, 0.99, 0.0
UNIFORM = 1 / (1 << BITS)


def symbols(text: str, order: int = ORDER) -> np.ndarray:
    cp = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4").astype(np.int64)
    wide = cp >= WIDE
    out = np.repeat(np.where(wide, WIDE + 2 + (cp >> 10), cp + 2), wide + 1)
    trails = np.flatnonzero(wide) + np.arange(1, wide.sum() + 1)
    out[trails] = TRAIL + (cp[wide] & 1023)
    return np.concatenate([np.ones(order - 1, np.int64), out])


def grams(s: np.ndarray, order: int = ORDER) -> np.ndarray:
    """The n-gram that ends at each character, as one number; its last k symbols are the lowest k * BITS bits."""
    n = len(s) - order + 1
    out = np.zeros(n, np.int64)
    for k in range(order):
        out = (out << BITS) | s[k : n + k]
    return out


def _merge(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    keys, at = np.unique(np.concatenate([a[0], b[0]]), return_inverse=True)
    return keys, np.bincount(at, np.concatenate([a[1], b[1]]), len(keys)).astype(np.int64)


def fold_of(text: str, folds: int) -> Column:
    """The fold of a text column, by its hash: exact copies share it."""
    return F.pmod(F.xxhash64(F.lit(3), F.col(f"`{text}`")), F.lit(folds)).cast("int")


def counts(trusted: DataFrame, order: int = ORDER, held: int = 1_000_000, folds: int = 1) -> DataFrame:
    """trusted has lang and text; lang, k, g, n0 to the last fold's: the grams of the highest order with their counts by
    fold, and each ending of theirs of k symbols with some number above 0 for the folds that have it. A task sums what
    it can hold before it hands on."""
    names = [f"n{f}" for f in range(folds)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine: dict[tuple[str, int], tuple[np.ndarray, np.ndarray]] = {}

        def out():
            for lang in dict.fromkeys(x for x, _ in mine):
                own = {f: mine[lang, f] for f in range(folds) if (lang, f) in mine}
                g = np.unique(np.concatenate([x for x, _ in own.values()]))
                n = np.zeros((folds, len(g)), np.int64)
                for f, (x, c) in own.items():
                    n[f, np.searchsorted(g, x)] = c
                for k in range(order, 0, -1):
                    if k < order:
                        g, at = np.unique(g & ((1 << BITS * k) - 1), return_inverse=True)
                        n = np.stack([np.bincount(at, x > 0, len(g)) > 0 for x in n]).astype(np.int64)
                    for at in range(0, len(g), 50_000):
                        m = len(g[at : at + 50_000])
                        cols = [pa.repeat(pa.scalar(lang, pa.string()), m), pa.repeat(pa.scalar(k, pa.int32()), m), pa.array(g[at : at + m]), *(pa.array(x[at : at + m]) for x in n)]
                        yield pa.RecordBatch.from_arrays(cols, names=["lang", "k", "g", *names])
            mine.clear()

        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                by: dict[tuple[str, int], list[np.ndarray]] = {}
                for lang, text, fold in zip(*(part.column(x).to_pylist() for x in range(3))):
                    by.setdefault((lang, fold), []).append(grams(symbols(text, order), order))
                for key, gs in by.items():
                    new = np.unique(np.concatenate(gs), return_counts=True)
                    mine[key] = _merge(mine[key], new) if key in mine else new
                if sum(len(g) for g, _ in mine.values()) > held:
                    yield from out()
        yield from out()

    found = trusted.select("lang", "text", fold_of("text", folds)).mapInArrow(run, "lang string, k int, g long, " + ", ".join(f"{n} long" for n in names))
    return found.groupBy("lang", "k", "g").agg(*[F.sum(n).alias(n) for n in names])


def train(trusted: DataFrame, scratch: Scratch, order: int = ORDER, folds: int = 1) -> DataFrame:
    """lang, k, g and c, or with several folds c0 to the last fold's: the count of each gram of the highest order, and
    in how many longer grams each shorter one ends, in all texts or in those of the other folds."""
    names = [f"c{f}" for f in range(folds)] if folds > 1 else ["c"]
    total = "(" + " + ".join(f"n{f}" for f in range(folds)) + ")"
    here = [F.expr(f"{total} - n{f}") for f in range(folds)] if folds > 1 else [F.col("n0")]
    shorter = F.struct((F.col("k") - 1).alias("k"), F.col("g").bitwiseAND(F.expr(f"shiftleft(1L, {BITS} * (k - 1)) - 1")).alias("g"), *[(x > 0).cast("long").alias(c) for c, x in zip(names, here)])
    own = F.struct("k", "g", *[x.alias(c) for c, x in zip(names, here)])
    sent = F.when(F.col("k") < order, F.array(shorter)).when(F.col("k") > 1, F.array(own, shorter)).otherwise(F.array(own))
    each = counts(trusted, order, folds=folds).where(f"k > 1 OR k = {order}").select("lang", F.explode(sent).alias("x"))
    return scratch.table(each.groupBy("lang", F.col("x.k").alias("k"), F.col("x.g").alias("g")).agg(*[F.sum(f"x.{c}").alias(c) for c in names]), "counts")


def without(model: DataFrame, fold: int) -> DataFrame:
    """The count table of the other folds: a gram that only this fold has is not in it."""
    return model.where(f"c{fold} > 0").select("lang", "k", "g", F.col(f"c{fold}").alias("c"))


def discounts(n: np.ndarray) -> np.ndarray:
    """Of counts 1, 2 and from 3, by the numbers of grams with counts 1 to 4; 0.5, 1 and 1.5 where these are too few."""
    n1, n2 = int(n[0]), int(n[1])
    y = n1 / (n1 + 2 * n2) if n1 + 2 * n2 else None
    raw = [j / 2 if y is None or not n[j - 1] else j - (j + 1) * y * int(n[j]) / int(n[j - 1]) for j in (1, 2, 3)]
    return np.array([min(max(d, 0.01 * j), j - 0.01) for j, d in zip((1, 2, 3), raw)])


def context(order: int = ORDER, depth: int | None = None) -> str:
    """SQL: a gram's context as one number, its last symbol highest, so that contexts with one ending are a range; of
    the last `depth` symbols only. A context that is shorter than order - 1 is its range's first number."""
    if order == 1:
        return "0L"
    all_ = " + ".join(f"shiftleft(shiftright(g, {BITS * j}) & {(1 << BITS) - 1}L, {BITS * (order - 1 - j)})" for j in range(1, order))
    return f"shiftright({all_}, {BITS * (order - 1 - (depth or order - 1))})"


def contexts(g: np.ndarray, order: int = ORDER) -> np.ndarray:
    """As context(), of grams of the highest order."""
    out = np.zeros(len(g), np.int64)
    for j in range(1, order):
        out = (out << BITS) | ((g >> BITS * j) & ((1 << BITS) - 1))
    return out


def summary(model: DataFrame, order: int = ORDER, most: int = SHARD) -> tuple[list[tuple[str, int, int, int]], dict[str, np.ndarray]]:
    """(lang, first, last, grams longer than one symbol) by ranges of contexts, sorted, and each language's discounts by
    order. A range is a context's last symbol, or more symbols where it has more than `most` grams. At most 2 ** BITS
    rows a language, and a range that is cut, reach the driver."""
    few = [F.count_if((F.col("k") == k) & (F.col("c") == c)).alias(f"n{k}_{c}") for k in range(1, order + 1) for c in (1, 2, 3, 4)]
    rows = model.groupBy("lang", F.expr(context(order, 1)).alias("bin")).agg(F.count_if(F.col("k") > 1).alias("n"), *few).toArrow()
    langs, of = rows["lang"].to_pylist(), {}
    told = np.stack([rows[k].to_numpy() for k in rows.column_names[3:]], axis=1).reshape(-1, order, 4)
    for lang, n in zip(langs, told):
        of[lang] = of[lang] + n if lang in of else n
    found, out = [x for x in zip(langs, rows["bin"].to_pylist(), rows["n"].to_pylist()) if x[2]], []
    for depth in range(1, order):
        free = BITS * (order - 1 - depth)
        large = [x[:2] for x in found if x[2] > most and free]
        out += [(lang, p << free, ((p + 1) << free) - 1, n) for lang, p, n in found if n <= most or not free]
        if not large:
            break
        # at most the model's grams / most rows
        cut = F.broadcast(model.sparkSession.createDataFrame(large, "cut_lang string, cut long"))
        own = model.where(F.col("k") > depth + 1).join(cut, (F.col("lang") == F.col("cut_lang")) & (F.expr(context(order, depth)) == F.col("cut")))
        rows = own.groupBy("lang", F.expr(context(order, depth + 1)).alias("bin")).agg(F.count("*").alias("n")).toArrow()
        found = list(zip(*(rows[c].to_pylist() for c in ("lang", "bin", "n"))))
    return sorted(out), {k: np.stack([discounts(x) for x in n]) for k, n in of.items()}


def shards(sizes: list[tuple[str, int, int, int]], most: int = SHARD) -> Iterator[list[tuple]]:
    """Lists of (lang, first, last): ranges of contexts; each list has at most `most` grams, if one range has. Grams of
    contexts that a range only shares, shorter ones, are with all ranges that they reach into."""
    now, held, before = [], 0, None
    for lang, first, last, n in sizes:
        if now and held + n > most:
            yield now
            now, held, before = [], 0, None
        if before == lang:
            now[-1] = (lang, now[-1][1], last)
        else:
            now.append((lang, first, last))
        held, before = held + n, lang
    if now:
        yield now


def _bounds(lists: list[list[tuple]], order: int = ORDER) -> list[dict[str, tuple[int, int]]]:
    """Each shard's languages with the range of contexts they answer for: a language's ranges follow each other without gaps."""
    out, open_at = [], {}
    last_of = {lang: k for k, part in enumerate(lists) for lang, _, _ in part}
    for k, part in enumerate(lists):
        out.append({})
        for lang, _, end in part:
            stop = (1 << BITS * (order - 1)) - 1 if last_of[lang] == k else end
            out[-1][lang] = (open_at.get(lang, 0), stop)
            open_at[lang] = stop + 1
    return out


def tables(k: np.ndarray, g: np.ndarray, c: np.ndarray, d: np.ndarray, order: int = ORDER) -> dict:
    """One language's sorted keys and values by kind and order: False, the log probability of a gram; True, the log
    back-off weight of a context. g must hold every shorter ending, and all grams of each context, of its grams."""
    out, lower = {}, None
    for n in range(1, order + 1):
        own = np.flatnonzero(k == n)
        own = own[np.argsort(g[own])]
        gs, cs = g[own], c[own]
        starts = np.flatnonzero(np.diff(gs >> BITS, prepend=-1))
        less = d[n - 1][np.minimum(cs, 3) - 1]
        total = np.add.reduceat(cs, starts) if len(gs) else cs
        gamma = np.add.reduceat(less, starts) / total if len(gs) else less
        at = np.repeat(np.arange(len(starts)), np.diff(starts, append=len(gs)))
        q = UNIFORM if lower is None else lower[1][np.searchsorted(lower[0], gs & ((1 << BITS * (n - 1)) - 1))]
        lower = gs, (cs - less) / total[at] + gamma[at] * q
        out[False, n] = gs, np.log(lower[1]).astype(np.float32)
        out[True, n] = gs[starts] >> BITS, np.log(gamma).astype(np.float32)
    return out


def load(model: DataFrame, part: dict[str, tuple[int, int]], d: dict[str, np.ndarray], order: int = ORDER) -> dict:
    """One shard: its languages' ranges of contexts and tables."""
    top, at = (1 << BITS * (order - 1)) - 1, F.expr(context(order))
    mine = F.col("lang").isin([x for x, bins in part.items() if bins == (0, top)])
    for lang, (first, end) in part.items():
        if (first, end) != (0, top):
            mine = mine | ((F.col("lang") == lang) & (at <= end) & (at + F.expr(f"shiftleft(1L, {BITS} * ({order} - k)) - 1") >= first))
    rows = model.where(mine).select("lang", F.col("k").cast("byte").alias("k"), "g", "c").toArrow()
    lang = rows["lang"].combine_chunks().dictionary_encode()
    at, k, g, c = lang.indices.to_numpy(), rows["k"].to_numpy(), rows["g"].to_numpy(), rows["c"].to_numpy()
    out = {}
    for i, name in enumerate(lang.dictionary.to_pylist()):
        own = at == i
        out[name] = (*part[name], tables(k[own], g[own], c[own], d[name], order))
    return out


def publish(model: DataFrame, order: int = ORDER, shard: int = SHARD) -> list[Broadcast]:
    """The model's shards, made one after the other; the driver holds one at a time and keeps the rest in files."""
    sizes, d = summary(model, order, shard)
    return [model.sparkSession.sparkContext.broadcast(load(model, part, d, order)) for part in _bounds(list(shards(sizes, shard)), order)]


def _look(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    g, v = table
    at = np.minimum(np.searchsorted(g, keys), max(len(g) - 1, 0))
    return (g[at] == keys, v[at]) if len(g) else (np.zeros(len(keys), bool), np.zeros(len(keys), np.float32))


def log_probability(text: str, shard: tuple, order: int = ORDER, at_once: int = 1 << 20) -> float:
    """Sum of the log probabilities of the characters whose context lies in the shard's range."""
    first, end, tables = shard
    s, total = symbols(text, order), 0.0
    for at in range(0, len(s) - order + 1, at_once):
        g = np.sort(grams(s[at : at + at_once + order - 1], order))  # neighbours are looked up near each other
        if first > 0 or end < (1 << BITS * (order - 1)) - 1:
            at_context = contexts(g, order)
            g = g[(at_context >= first) & (at_context <= end)]
        found, v = _look(tables[False, order], g)
        total += float(v[found].sum(dtype=np.float64))
        g = g[~found]  # few: only these go down the orders
        if not len(g):
            continue
        lp = np.full(len(g), np.log(UNIFORM))
        for k in range(1, order + 1):
            low = g & ((1 << BITS * k) - 1)
            known, weight = _look(tables[True, k], low >> BITS)
            found, v = _look(tables[False, k], low)
            lp = np.where(found, v, lp + np.where(known, weight, 0.0))
        total += float(lp.sum())
    return total


def score(docs: DataFrame, model: DataFrame | list[Broadcast], *, text: str, lang: str, order: int = ORDER, shard: int = SHARD) -> tuple[DataFrame, str]:
    """docs with their log perplexity per character in a further column, whose name is returned, too."""
    name, total, both = (free_name(docs.columns, x) for x in ("log_perplexity", "total", "both"))
    parts = model if isinstance(model, list) else publish(model, order, shard)

    def add(col: pa.Array) -> list[pa.Array]:
        langs, texts = col.field("l").to_pylist(), col.field("t").to_pylist()
        sums: list[float | None] = [None] * len(texts)
        for held in parts:
            own = held.value
            for k, (x, t) in enumerate(zip(langs, texts)):
                if t and x in own:
                    sums[k] = (sums[k] or 0.0) + log_probability(t, own[x], order)
            if len(parts) > 1:
                del own, held._value  # a worker holds one shard at a time and reads the next one from its file
        return [pa.array(sums, pa.float64())]

    # mapInArrow sees the two columns it needs as one
    out = docs.withColumn(both, F.struct(F.coalesce(F.col(f"`{lang}`"), F.lit("")).alias("l"), F.col(f"`{text}`").alias("t")))
    out = append(out, both, [T.StructField(total, T.DoubleType())], add)
    return out.withColumn(name, -F.col(total) / F.length(F.col(f"`{text}`"))).drop(total, both), name


def score_out_of_fold(docs: DataFrame, models: list[list[Broadcast]], *, text: str, lang: str, order: int = ORDER) -> tuple[DataFrame, str]:
    """As score(), each fold's documents by its model. A fold's documents are read apart, so a task holds one shard."""
    parts = [score(docs.where(fold_of(text, len(models)) == f), m, text=text, lang=lang, order=order) for f, m in enumerate(models)]
    return reduce(DataFrame.unionAll, [x for x, _ in parts]), parts[0][1]


def trusted_ids(labels: DataFrame) -> DataFrame:
    return labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("q"), F.max(F.coalesce("toxic", F.lit(0))).alias("x")).where("q = 1 AND x = 0").select(F.col("doc_id").alias("trusted_id"))


def trusted_rows(docs: DataFrame, labels: DataFrame, *, id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """lang and text of the trusted documents that have text; only these texts are exchanged."""
    own = docs.select(F.col(f"`{id}`").alias("key"), F.coalesce(F.col(f"`{lang}`"), F.lit("")).alias("lang"), F.col(f"`{text}`").alias("text")).where("length(text) > 0")
    ids = trusted_ids(labels)  # unique; an inner join, as a semi join would be pushed below the bit map's
    # hashed, not sorted: no sort of texts
    return maybe(own, ids.withColumnRenamed("trusted_id", "doc")).join(ids.hint("shuffle_hash"), F.col("key") == F.col("trusted_id")).select("lang", "text")


def limits(scores: DataFrame, *, lower: float = LOWER, upper: float = UPPER, slack: float = SLACK) -> DataFrame:
    """scores has the trusted documents' lang and lp; l, least and most: a language's bounds of the log perplexity. A row a language."""
    q = scores.where("lp IS NOT NULL").groupBy("lang").agg(F.expr(f"percentile_approx(lp, array({lower}, {upper}), 10000)").alias("q"))
    return q.selectExpr("lang as l", f"q[0] - {slack} * (q[1] - q[0]) as least", f"q[1] + {slack} * (q[1] - q[0]) as most")


def judge(docs: DataFrame, labels: DataFrame, *, id: str = "doc_id", text: str = "text", lang: str = "lang", lower: float = LOWER, upper: float = UPPER, slack: float = SLACK, order: int = ORDER, folds: int = FOLDS) -> tuple[DataFrame, str, str]:
    """docs with log perplexity and whether to keep them, and the names of these two columns."""
    scratch = Scratch(docs.sparkSession, "quality")
    trusted = scratch.table(trusted_rows(docs, labels, id=id, text=text, lang=lang), "trusted")
    model = train(trusted, scratch, order, folds)
    models = [publish(without(model, f), order) for f in range(folds)]
    scratch.drop("counts")
    known, n = score_out_of_fold(trusted, models, text="text", lang="lang", order=order)
    bounds = scratch.table(limits(known.select("lang", F.col(n).alias("lp")), lower=lower, upper=upper, slack=slack), "limits")
    scratch.drop("trusted")
    scored, name = score_out_of_fold(docs, models, text=text, lang=lang, order=order)
    keep, (l, least, most) = free_name(scored.columns, "keep"), (free_name(scored.columns, x) for x in ("l", "least", "most"))
    named = bounds.select(F.col("l").alias(l), F.col("least").alias(least), F.col("most").alias(most))
    # a row a language
    both = scored.join(F.broadcast(named), F.coalesce(F.col(f"`{lang}`"), F.lit("")) == F.col(l), "left")
    return both.withColumn(keep, F.coalesce(F.col(name).between(F.col(least), F.col(most)), F.lit(True))).drop(l, least, most), name, keep


def keep_clean(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    out, _, keep = judge(docs, labels, **options)
    return out.where(F.col(keep)).select(*[F.col(f"`{c}`") for c in docs.columns])


def op3(spark, sf_dir: str) -> DataFrame:
    out, lp, keep = judge(read(spark, sf_dir, "documents").select("doc_id", "lang", "text"), read(spark, sf_dir, "labels"))
    return out.select("doc_id", "lang", F.exp(lp).alias("perplexity"), F.col(keep).alias("kept"))
