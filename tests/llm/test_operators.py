"""Each training-data operator against brute force and on odd inputs: nulls, empty and long texts, repeats, empty tables, clashing names."""

import datetime
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablemill.llm import chat, components, decontam, knn, licenses, linededup, neardup, packing, pii, quality, warc
from tablemill.llm.common import Scratch

DOCS = "doc_id long, text string, lang string, found string, did string"


def docs(spark, texts, lang="en"):
    """Rows with columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, x, lang, "f", "d") for i, x in texts], DOCS)


def same(got, want):
    assert sorted(got, key=repr) == sorted(want, key=repr)


def make(rng, n, vocabulary=60):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


# ---- op4


def test_wu_manber_equals_brute_force():
    rng = random.Random(1)
    items = [(str(k), make(rng, n, 4)) for k, n in enumerate([1, 2, 3, 9, 10, 11, 30, 0])] + [(None, "w1 w2 w3"), ("x", None)]
    tables = decontam.searchers(items)
    for n in (0, 1, 5, 10, 400):
        text = make(rng, n, 4)
        w, spans, found = text.split(), set(), set()
        for item, t in items:
            iw = (t or "").split()
            size = min(10, len(iw))
            for a in range(len(iw) - size + 1 if iw else 0):
                for i in range(len(w) - size + 1):
                    if w[i : i + size] == iw[a : a + size]:
                        spans |= set(range(i, i + size))
                        found |= {item} - {None}
        got = decontam.search(text, tables)
        assert decontam.covered(got["spans"]) == len(spans) and got["items"] == sorted(found) and got["n_words"] == len(w)


def test_decontam_in_blocks_and_odd_rows(spark):
    bench = spark.createDataFrame([(k, make(random.Random(k), 14)) for k in range(6)], "item_id long, text string")
    texts = {k: "x " + make(random.Random(k), 14) + " y" for k in range(3)} | {10: None, 11: "", 12: "clean words " * 5000}
    d = docs(spark, [*texts.items(), (0, texts[0])])
    one, n1 = decontam.find(d, bench)
    many, n2 = decontam.find(d, bench, block_bytes=40)
    assert n1 == "_found"
    key = lambda df, n: sorted((r.doc_id, decontam.covered(r[n]["spans"]), r[n]["items"]) for r in df.collect())
    assert key(one, n1) == key(many, n2)
    kept = decontam.decontaminate(d, bench)
    assert kept.columns == d.columns and sorted(r.doc_id for r in kept.collect()) == [10, 11, 12]
    assert decontam.decontaminate(d, bench.limit(0)).count() == 7 and decontam.decontaminate(d.limit(0), bench).count() == 0


# ---- op2


def brute_lines(rows):
    seen, out = {}, {}
    for i, text in rows:
        if text is None:
            continue
        lines = text.split("\n")
        n = min(3, len(lines))
        for a in range(len(lines) - n + 1):
            win = tuple(lines[a : a + n])
            if "".join(win).strip(" \t\r"):
                if win in seen:
                    out.setdefault(i, set()).update(range(a, a + n))
                seen.setdefault(win, (i, a))
    return {i: t if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in out.get(i, ())) for i, t in rows}


def test_line_dedup_equals_brute_force(spark):
    rng = random.Random(2)
    rows = [(k, "\n".join(rng.choice(["a", "b", "c", "", "long line"]) for _ in range(rng.randrange(1, 12)))) for k in range(60)]
    rows += [(100, None), (101, ""), (102, "one"), (103, "one"), (104, "a\nb"), (105, "\n\n\n"), (106, "\n\n\n"), (107, "z\n" * 3000)]
    got = {r.doc_id: r.text for r in linededup.dedup_lines(docs(spark, rows)).collect()}
    assert got == brute_lines(rows)
    kept = linededup.dedup_lines(docs(spark, rows), drop_emptied=True)
    assert 103 not in {r.doc_id for r in kept.collect()} and kept.columns == docs(spark, rows).columns
    assert linededup.dedup_lines(docs(spark, rows).limit(0)).count() == 0
    copies = linededup.dedup_lines(docs(spark, [(1, "p\nq\nr"), (1, "p\nq\nr")])).collect()
    assert [r.text for r in copies] == ["p\nq\nr"] * 2


# ---- op1


def luhn(s):
    return sum(d if k % 2 == 0 else d * 2 - 9 * (d > 4) for k, d in enumerate(map(int, reversed(s)))) % 10 == 0


def test_pseudonyms_keep_formats_and_link(spark):
    texts = [
        (1, "card 4111111111111111 2353820953013749 and 5500 0000 0000 0004, not 4111111111111112"), (2, "again 4111111111111111"), (3, "2001-02-28 30.02.2001 31/12/1999"),
        (4, "GB82WEST12345698765432 DE89 3704 0044 0532 0130 00"), (5, "10.20.30.40 999.1.1.1"), (6, "+1 (017) 555-7713 97.51.17.173"), (7, "joe.doe@mail.example.com"), (8, 'token = "ab12cd34"'),
        (9, None), (10, ""), (11, "plain words 12 and 1.5"), (12, "078-05-1120 000-12-3456"), (13, "x" * 100_000 + " 4111111111111111"),
    ]
    out = {r.doc_id: r.text for r in pii.pseudonymize(docs(spark, texts), "k").collect()}
    cards = re.findall(r"\d{16}", out[1])
    assert luhn(cards[0]) and cards[0] != "4111111111111111" and cards[1] == "2353820953013749" and cards[2] == "4111111111111112"
    assert cards[0] in out[2] and cards[0] in out[13] and re.search(r"\d{4} \d{4} \d{4} \d{4}", out[1])
    assert re.fullmatch(r"\d{4}-\d\d-\d\d 30\.02\.2001 \d\d/\d\d/\d{4}", out[3]) and "2001-02-28" not in out[3]
    for iban in (out[4].split(" ")[0], "".join(out[4].split(" ")[1:])):
        assert int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1
    assert "999.1.1.1" in out[5] and "10.20.30.40" not in out[5] and "555-7713" not in out[6] and "97.51.17.173" not in out[6]
    assert "joe" not in out[7] and out[7].endswith(".com") and "ab12cd34" not in out[8]
    assert out[9] is None and out[10] == "" and out[11] == texts[10][1] and "000-12-3456" in out[12] and "078-05-1120" not in out[12]
    assert {r.doc_id: r.text for r in pii.pseudonymize(docs(spark, texts[:1]), "other").collect()}[1] != out[1]


def test_feistel_is_a_permutation(spark):
    made = spark.range(1000).select(F.expr(pii.digits("k", "'t'", "lpad(cast(id as string), 3, '0')")).alias("y"))
    assert made.distinct().count() == 1000 and made.where("length(y) = 3").count() == 1000
    days = spark.range(pii.DAYS_A * 7).select(F.expr(pii.feistel("k", "'d'", "id div 7", "id % 7", str(pii.DAYS_A), "7")).alias("f"))
    assert days.distinct().count() == pii.DAYS_A * 7


def day_of(text):
    """The day a date string names, and its format; dd/mm/yyyy before mm/dd/yyyy."""
    for f in ("%Y-%m-%d", "%d.%m.%Y", "%d/%m/%Y", "%m/%d/%Y"):
        try:
            return datetime.datetime.strptime(text, f).date(), f
        except ValueError:
            continue
    return None


def test_pseudonyms_differ_for_every_day_and_format(spark):
    """Days of 1895 to 2105, and some of all other centuries, in four formats: all replaced one to one, format kept."""
    day = spark.range(0, 3652059).where("id between 692000 and 769000 or id % 97 = 0 or id < 800 or id > 3651000").select(F.expr("date_add(date'0001-01-01', cast(id as int))").alias("d"))
    text = day.select(F.explode(F.array(*[F.date_format("d", f) for f in ("yyyy-MM-dd", "dd.MM.yyyy", "dd/MM/yyyy", "MM/dd/yyyy")])).alias("was")).distinct()
    out = pii.pseudonymize(text.withColumn("text", F.col("was")), "k").toPandas()
    assert out.text.nunique() == len(out) > 300_000 and (out.text != out.was).mean() > 0.9999
    for was, new in zip(out.was[::53], out.text[::53]):
        assert day_of(was)[1] == day_of(new)[1], (was, new)
        near = [datetime.date(1900, 1, 1) <= day_of(x)[0] <= datetime.date(2101, 3, 27) for x in (was, new)]
        assert near[0] == near[1]


def test_addresses_and_account_numbers_are_permuted(spark):
    ips = [f"{a}.1.1.{b}" for a in ("10", "010", "0", "00", "000", "255") for b in ("1", "01", "001", "99", "099")]
    body = [f"WEST{k:014d}" for k in range(300)] + [f"ABCD{'Z' * k}{'7' * (14 - k)}" for k in range(15)]
    valid = [f"GB{98 - int(''.join(str(int(c, 36)) for c in b + 'GB00')) % 97:02d}{b}" for b in body]
    out = {r.doc_id: r.text for r in pii.pseudonymize(docs(spark, list(enumerate([*ips, *valid]))), "k").collect()}
    new = [out[k] for k in range(len(out))]
    assert len(set(new)) == len(new) and not set(new) & set(ips)
    for was, x in zip(ips, new):
        for a, b in zip(was.split("."), x.split(".")):
            padded = len(a) > 1 and a[0] == "0"
            assert int(b) < 256 and (len(b) == len(a) and b[0] == "0" if padded else str(int(b)) == b)
    for was, x in zip(valid, new[len(ips) :]):
        assert was != x and int("".join(str(int(c, 36)) for c in x[4:] + x[:4])) % 97 == 1 and [c.isdigit() for c in was] == [c.isdigit() for c in x]


def brute_permuted(key, tweak, x):
    """The string network from its definition, and its inverse."""

    def shift(half, other, r, sign):
        w, out = hashlib.sha256(other.encode()).hexdigest(), []
        for i, c in enumerate(half):
            s = sign * int(hashlib.sha256("|".join([key, tweak, str(r), w, str(i // 16)]).encode()).hexdigest()[i % 16 * 4 :][:4], 16)
            kind = next((k for k in ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ") if c in k), None)
            out.append(kind[(kind.index(c) + s) % len(kind)] if kind else c)
        return "".join(out)

    def network(x, sign):
        a, b = x[: len(x) // 2], x[len(x) // 2 :]
        for r in range(pii.ROUNDS)[::sign]:
            a, b = (shift(a, b, r, sign), b) if r % 2 == 0 else (a, shift(b, a, r, sign))
        return a + b

    made = network(x, 1)
    assert network(made, -1) == x
    return made


def test_string_network_equals_brute_force(spark):
    texts = ["a", "aB", "joe.doe@mail", "ABCD" * 20, "x9" * 700, "no-1_2.3=", "0"]
    rows = spark.createDataFrame([(x,) for x in texts], "x string").select("x", F.expr(pii.permuted("k", "'t'", "x")).alias("y")).collect()
    assert {r.x: r.y for r in rows} == {x: brute_permuted("k", "t", x) for x in texts}


def test_pseudonyms_of_odd_tables(spark):
    rows = spark.createDataFrame([(1, "on 2001-02-03", "p", "n", 5, [1])] * 2 + [(2, None, None, None, None, None)], "doc_id long, text string, parts string, new string, n_replaced int, found array<int>")
    out = pii.pseudonymize(rows, "k")
    got = sorted(map(tuple, out.collect()), key=lambda r: r[0])
    assert out.columns == rows.columns and got[0] == got[1] and got[0][1] != "on 2001-02-03" and got[0][2:] == ("p", "n", 5, [1]) and got[2] == (2, None, None, None, None, None)
    assert pii.pseudonymize(rows.limit(0), "k").count() == 0
    assert "k-that-is-secret" not in pii.pseudonymize(rows, "k-that-is-secret")._jdf.queryExecution().toString()


# ---- op10


def brute_groups(rows, size=2, percent=80):
    sets = {i: {tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if (w := (t or "").lower().split()) else set() for i, t in rows}
    parent = {i: i for i, _ in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return [(i, len(sets[i]), root(i), root(i) == i) for i in sets]


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(3)
    rows = []
    for family in range(12):
        base = make(rng, 120, 500).split()
        for _ in range(25):
            w = list(base)
            for _ in range(rng.choice([0, 1, 2, 4, 6, 9])):
                w[rng.randrange(len(w))] = f"n{rng.random()}"
            rows.append((len(rows), " ".join(w)))
    rows += [(1000, None), (1001, ""), (1002, "one"), (1003, "ONE"), (1004, "a b"), (1005, make(rng, 20000))]
    got = neardup.near_duplicates(docs(spark, rows), shingle_words=2)
    same([tuple(r) for r in got.select("doc", "n_shingles", "component", "kept").collect()], brute_groups(rows))
    kept = neardup.drop_near_duplicates(docs(spark, rows), shingle_words=2)
    assert kept.columns == docs(spark, rows).columns and kept.count() == sum(g[3] for g in brute_groups(rows))


def test_near_duplicates_of_long_texts_in_many_tiles(spark):
    """Texts of 300 to 2600 words around few bases, so that keys hold many times a tile, and components are several."""
    rng = random.Random(17)
    rows = []
    for words, copies in ((300, 150), (900, 40), (2600, 12)):
        base = [f"v{rng.randrange(5000)}" for _ in range(words)]
        for _ in range(copies):
            w = list(base)
            for _ in range(rng.randrange(words // 6)):
                w[rng.randrange(words)] = f"n{rng.random()}"
            rows.append((len(rows), " ".join(w)))
    want = brute_groups(rows)
    assert len({g[2] for g in want}) > 3
    for tile in (4, 32, neardup.TILE):
        got = neardup.near_duplicates(docs(spark, rows), shingle_words=2, tile=tile)
        same([tuple(r) for r in got.select("doc", "n_shingles", "component", "kept").collect()], want)


def test_second_stars_and_tiles_meet_every_pair(spark):
    """One key whose largest component is not its centre's: each pair of different components is met once."""
    base = [f"v{k}" for k in range(400)]
    s = [neardup.shingles([x.encode() for x in base[: 400 - k % 7]], 1) for k in range(60)]
    reps = spark.createDataFrame([(k, len(x), neardup.signature(s[0]), neardup.prints(x)) for k, x in enumerate(s)], "doc long, n long, sig binary, prints binary")
    key = int(neardup.keys(np.frombuffer(neardup.signature(s[0]), "<u2").reshape(1, -1))[0, 0])
    shared = spark.createDataFrame([(key, k, 0) for k in range(60)], "key long, doc long, center long")
    label = {k: 20 if k >= 20 else k // 2 for k in range(60)}
    labels = spark.createDataFrame(list(label.items()), "node long, component long")
    rows, large = neardup.mixed_keys(shared, labels, 8)
    assert [(r.main, r.inside, r.others) for r in large.collect()] == [(20, 40, 20)]
    same([(r.a, r.b) for r in neardup.second_stars(rows, large, 8).collect()], [(0, k) for k in range(2, 20)])
    assert neardup.second_stars(rows, large, 20).count() == 0
    want = [(a, b) for a in range(60) for b in range(a + 1, 60) if label[a] != label[b]]
    for tile in (1, 7, 8, 100):
        rows, large = neardup.mixed_keys(shared, labels, tile)
        same([(r.a, r.b) for r in neardup.across(rows, large, reps, 80, tile).collect()], want)


def test_rare_shingles_of_linked_sets_meet():
    rng = np.random.default_rng(9)
    counts = rng.integers(0, 50, neardup.RANKS)
    for n in (1, 2, 4, 5, 6, 9, 10, 33, 400):
        for _ in range(40):
            a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
            lost = rng.integers(0, n // 5 + 1)
            b = np.unique(np.concatenate([a[lost:], rng.integers(0, 2**63, rng.integers(0, n // 5 - lost + 1), dtype=np.uint64)]))
            common = len(np.intersect1d(a, b))
            if 100 * common >= 80 * (len(a) + len(b) - common):
                assert len(np.intersect1d(neardup.rare(a, counts, 80), neardup.rare(b, counts, 80)))
    assert len(neardup.rare(np.arange(100, dtype=np.uint64), counts, 80)) == 21


def test_texts_with_a_common_passage_are_dealt_by_rare_shingles(spark, monkeypatch):
    """Keys with many times a tile of texts that stay apart: no further rounds over all texts, and few of them in a group."""
    rng = random.Random(23)
    passage = " ".join(f"c{k}" for k in range(60))
    rows = [(k, f"{passage} {make(rng, 45, 10**6)}") for k in range(240)]
    for k in range(0, 60, 3):  # some near copies among them, which only rare shingles tell from the rest
        rows.append((1000 + k, f"{rows[k][1]} end{k}"))
    rounds, groups = [], []
    link, meet = neardup.components, neardup.across

    def linked(links, scratch, label):
        rounds.append(label)
        return link(links, scratch, label)

    def met(rows, *args, **options):
        groups.extend(r["count"] for r in rows.groupBy("key").count().collect())
        return meet(rows, *args, **options)

    monkeypatch.setattr(neardup, "components", linked)
    monkeypatch.setattr(neardup, "across", met)
    got = neardup.near_duplicates(docs(spark, rows), shingle_words=2, tile=16)
    same([tuple(r) for r in got.select("doc", "n_shingles", "component", "kept").collect()], brute_groups(rows))
    assert len(rounds) <= 3 and groups and max(groups) <= 16


def test_bound_of_prints_rules_no_link_out():
    rng = np.random.default_rng(4)
    sets = []
    for n in (1, 5, 200, 256, 257, 300, 2000, 2048, 2049, 2500, 60_000):
        base = rng.integers(0, 2**63, n, dtype=np.uint64)
        for part in (1.0, 0.97, 0.9, 0.88, 0.7):
            kept = base[: max(1, int(n * part))]
            sets.append(np.unique(np.concatenate([kept, rng.integers(0, 2**63, n - len(kept), dtype=np.uint64)])))
    n = np.array([len(s) for s in sets])
    bound = neardup.Prints(neardup.pa.array([neardup.prints(s) for s in sets], neardup.pa.binary()), n, 80)
    ruled_out = 0
    for a in range(len(sets)):
        others = np.arange(a + 1, len(sets))
        allowed = set(bound.allow(a, others).tolist())
        for b in others.tolist():
            i = len(np.intersect1d(sets[a], sets[b]))
            linked = 100 * i >= 80 * (n[a] + n[b] - i)
            assert b in allowed or not linked
            ruled_out += b not in allowed
    assert ruled_out > 0.8 * len(sets) ** 2 / 2


def test_near_duplicates_odd_rows(spark):
    rows = [(None, "a b c"), (None, "a b c"), (5, "a b c"), (5, "a b c"), (6, "x")]
    got = [tuple(r) for r in neardup.near_duplicates(docs(spark, rows), shingle_words=2).select("doc", "component", "kept").collect()]
    same(got, [(None, None, True)] * 2 + [(5, 5, True)] * 2 + [(6, 6, True)])
    assert neardup.near_duplicates(docs(spark, rows).limit(0)).count() == 0


def test_components_of_a_chain(spark):
    links = spark.range(400).selectExpr("id as a", "id + 1 as b")
    out = components.components(links, Scratch(spark, "test"), "chain")
    assert out.where("component <> 0").count() == 0 and out.count() == 401


# ---- op5


def test_very_long_vectors_do_not_harm_others():
    """Scores beyond a long are clipped to its ends."""
    rng = np.random.default_rng(6)
    clip = lambda s: min(max(s, -(2**63)), 2**63 - 1)
    for longest in (1e3, 1e9, 1e14, 1e90, 1e150, 1e300):
        x = np.floor(rng.normal(size=(300, 6)) * 1024)
        x[7, 2] = np.floor(longest)
        tree = knn.MTree(np.arange(300), x)
        for query in (7, 8, 9, 10):
            best = []
            tree.search(query, x[query], best, 10)
            scores = [(-clip(sum(int(a) * int(b) for a, b in zip(x[k], x[query]))), k) for k in range(300) if k != query]
            assert sorted((-s, -i) for s, i in best) == sorted(scores)[:10], (longest, query)


def test_overflow_after_scaling_takes_no_part():
    assert [x is None for x in knn.scaled([[1e306, 0.0], [1e300, 1.0], [float("inf")], [float("nan")], [None], [], None, [0.5]])] == [True, False, True, True, True, True, True, False]



def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(700, 8)).round(2)
    x[100:130] = x[99]
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)] + [(9000, None, 0), (9001, [1.0, None], 0), (9002, [float("nan")] * 8, 0), (9003, [1.0, 2.0], 0), (None, [0.5] * 8, 0), (9100, [], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int")
    got = knn.top_k(df, df.where("vec_id % 100 = 0"), 10, block=3).collect()
    whole = np.floor(1024 * x).astype(np.int64)
    want = []
    for q in range(0, 700, 100):
        s = whole @ whole[q]
        order = [i for i in np.lexsort((np.arange(700), -s)) if i != q][:10]
        want += [(q, k + 1, int(i), int(s[i])) for k, i in enumerate(order)]
    same([tuple(r) for r in got], want)
    assert knn.top_k(df.limit(0), df.limit(0)).count() == 0


# ---- op6


@pytest.mark.parametrize("capacity", [64, 4096])
def test_packing_is_exact_and_tight(spark, capacity):
    rng = random.Random(5)
    rows = [(k, make(rng, rng.randrange(0, 60), 999)) for k in range(300)] + [(900, None), (901, ""), (902, make(rng, 9000)), (903, "日本 <|endoftext|> É"), (903, "日本 <|endoftext|> É"), (None, "null id")]
    out = packing.pack(docs(spark, rows), capacity=capacity, grain=4).collect()
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.tokenizer_path(packing.TOKENIZER))
    want = []
    for i, t in rows:
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        want += [(i, s, len(ids[s : s + capacity]), zlib.crc32(ids[s : s + capacity].tobytes()), len(ids)) for s in range(0, len(ids), capacity)]
    same([(r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in out], want)
    by = {}
    for r in out:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in by.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    total = sum(r.length for r in out)
    assert len(by) * capacity < 1.25 * total + 2 * capacity
    assert packing.pack(docs(spark, rows).limit(0)).count() == 0


# ---- op7


def test_warc_round_trip_with_small_ranges(spark):
    rng = random.Random(6)
    rows = [(k, f"http://h/{k}", "<p>" + "".join(chr(rng.randrange(33, 900)) for _ in range(rng.randrange(0, 3000)))) for k in range(120)]
    rows += [(500, "u\nv", None), (501, None, ""), (502, "u", rows[5][2] * 2), (503, "u", rows[5][2] * 2), (504, "u", "short"), (505, "u", "short"), (None, "u", "null id " * 50), (506, "u", "A" * 17_000_000)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, digest string")
    path = Scratch(spark, "test").path("w")
    warc.write_warc(df.repartition(2), path)
    first = {}
    for i, _, h in rows:
        if i is not None and len((h or "").encode()) >= 100:
            first[h] = min(first.get(h, i), i)
    want = []
    for i, _, h in rows:
        body = (h or "").encode()
        again = h in first and i is not None and first[h] != i
        want.append((i, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", first[h] if again else None))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("7k", "128m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            same([tuple(r) for r in warc.digest(warc.read_warc(spark, path)).collect()], want)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    warc.write_warc(df.limit(0), path + "-empty")
    assert warc.read_warc(spark, path + "-empty").count() == 0


# ---- op8


def test_chat_round_trip():
    import public_tokenizers

    f = chat.formatter(public_tokenizers.path(chat.TOKENIZER))
    hard = ["", "<", "|>", "<|end|>", r"<\|end|>", r"<\\||", "\n\n x \n", "é日本😀", chat.PROBE, "<|turn|>assistant<|text|>"]
    rng = random.Random(7)
    for _ in range(200):
        turns = [(rng.choice(["user", "assistant", "sys<|text|>"]), "".join(rng.choice(hard) for _ in range(rng.randrange(4)))) for _ in range(rng.randrange(1, 6))]
        text, ids, on = f.format(turns)
        assert chat.parse(text) == turns
        assert "".join(f.trained(ids, on)) == "".join(t for r, t in turns if r == "assistant")


def test_chat_rows(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", None), (None, 0, "user", "n"), (2, 0, None, "x"), (2, 0, None, "x")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, ids int")
    got = {r.conv_id: (r.n_turns, r.loss_chars) for r in chat.read_back(chat.format_conversations(df)).collect()}
    assert got == {1: (2, 1), None: (1, 0), 2: (2, 0)}
    assert chat.format_conversations(df.limit(0)).count() == 0


# ---- op9


def test_licence_scan_equals_brute_force(spark):
    rng = random.Random(8)
    parts = ["gnu", "general", "public", "license", "apache", "cc", "by", "mit", "nc", "x"]
    a = licenses.automaton()
    for _ in range(300):
        w = [rng.choice(parts) for _ in range(rng.randrange(0, 40))]
        places = [(k, label) for p, label in licenses.BASE.items() for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]
        got = licenses.scan(" ".join(w).title(), a)
        at = [k for k, _ in places]
        assert (got["n_base"], got["first_word"], got["last_word"], got["n_words"]) == (len(at), min(at, default=None), max(at, default=None), len(w))
        assert got["base_labels"] == ",".join(sorted({x for _, x in places}))
    rows = [(1, None), (2, ""), (3, "// SPDX-License-Identifier: (MIT OR GPL-2.0-only WITH Classpath-exception-2.0) AND Apache-2.0\n"), (4, "SPDX-License-Identifier: MIT AND"), (5, "mit license " * 9000)]
    out = {r.doc_id: r for r in licenses.license_scan(docs(spark, rows)).collect()}
    assert out[1].labels == out[2].labels == "" and out[1].score == 0 and out[5].n_base == 9000
    assert "choice:mit" in out[3].labels and "exception:classpath-exception-2.0" in out[3].labels and out[3].score == 1
    assert "spdx-invalid" in out[4].labels


def brute_labels(text):
    """All labels and the score from the rules: phrases by lists of words, tags by lines, expressions by recursion."""
    w = re.findall(r"[0-9a-z\x80-\U0010ffff]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    phrases = {**licenses.BASE, **licenses.NOTICES}
    hits = [label for p, label in phrases.items() for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]
    labels, valid = set(hits), False

    def choose(a, b):
        return min(a, b, key=lambda s: (max(next((k for k, x in enumerate(licenses._ORDER) if one.startswith(x)), len(licenses._ORDER)) for one in s), sorted(s)))

    def parse(tok):
        """The licences chosen, and all labels on the way; by descent from OR to AND to WITH."""

        def level(name, below):
            got, seen = below()
            while tok and tok[0] == name:
                tok.pop(0)
                more, also = below()
                seen |= also
                if name == "or":
                    got = choose(got, more)
                    seen |= {"choice:" + x for x in got}
                else:
                    got = got | more
            return got, seen

        def one():
            if tok and tok[0] == "(":
                tok.pop(0)
                got = level("or", lambda: level("and", one))
                if not tok or tok.pop(0) != ")":
                    raise ValueError
            elif tok and licenses.is_licence(tok[0]):
                x = tok.pop(0)
                got = {x}, {"spdx:" + x}
            else:
                raise ValueError
            if tok and tok[0] == "with":
                tok.pop(0)
                if not tok or tok[0] not in licenses.EXCEPTIONS or len(got[0]) != 1:
                    raise ValueError
                got = got[0], got[1] | {"exception:" + tok.pop(0)}
            return got

        got, seen = level("or", lambda: level("and", one))
        if tok:
            raise ValueError
        return seen

    for line in (text or "").split("\n"):
        for m in re.finditer(r"(?i)spdx[^0-9a-z]+license[^0-9a-z]+identifier(?![0-9a-z])([ \t]*[:=])?(.*)", line):
            try:
                labels |= parse(re.findall(r"[()]|[^\s()]+", m[2].lower()))
                valid = True
            except ValueError:
                labels |= {"spdx-invalid"} if m[1] else set()
    return ",".join(sorted(labels)), 1.0 if valid else 1 - 0.5 ** len(hits)


def test_licence_labels_equal_brute_force(spark):
    rng = random.Random(18)
    tokens = ["MIT", "GPL-2.0+", "Apache-2.0", "ISC", "LicenseRef-own", "hello", "AND", "OR", "or", "WITH", "(", ")", "Classpath-exception-2.0", "LLVM-exception"]
    tags = ["SPDX-License-Identifier:", "spdx.license.identifier: ", "SPDX License Identifier =", "the SPDX-License-Identifier", "spdx license identifiers:"]
    texts = ["SPDX-License-Identifier: hello", "spdx.license.identifier: MIT", "A SPDX license identifier is documented there", "SPDX-License-Identifier MIT", "SPDX-License-Identifier: LLVM-exception", "SPDX-License-Identifier: (MIT OR ISC) AND GPL-3.0-only WITH GCC-exception-3.1"]
    for _ in range(1500):
        lines = [rng.choice([*licenses.BASE, *licenses.NOTICES, "x y", "é mit", ""]).title() for _ in range(rng.randrange(3))]
        mixed = [rng.choice(tokens) for _ in range(rng.randrange(6))]
        shaped = ["MIT", rng.choice(["AND", "OR"]), "(", "GPL-2.0-only", rng.choice(["WITH", "OR"]), rng.choice(["Classpath-exception-2.0", "ISC"]), ")"]
        lines.insert(rng.randrange(len(lines) + 1), f"{rng.choice(tags)} {' '.join(rng.choice([mixed, shaped]))}")
        texts.append("\n".join(lines))
    a = licenses.automaton()
    valid = 0
    for t in texts:
        got = licenses.scan(t, a)
        assert (got["labels"], got["score"]) == brute_labels(t), t
        valid += got["score"] == 1
    assert valid > 300 and licenses.scan(texts[0], a)["labels"] == "spdx-invalid" and licenses.scan(texts[2], a)["labels"] == ""
    twice = licenses.license_scan(docs(spark, [(1, texts[1])] * 2)).collect()
    assert twice[0] == twice[1] and twice[0].labels == "spdx:mit" and licenses.license_scan(docs(spark, [(1, "x")]).limit(0)).count() == 0


def test_shunting_yard():
    assert licenses.to_postfix("a OR b AND c WITH d") == ["a", "b", "c", "d", "with", "and", "or"]
    for bad in ("", "a b", "(a", "a)", "AND a", "a OR", "()"):
        assert licenses.to_postfix(bad) is None


def test_secrets_are_replaced_to_their_end(spark):
    rng = random.Random(3)
    part = lambda n: "".join(rng.choice("abcdefXYZ0123456789") for _ in range(n))
    long, jwt, dots = part(20_000), f"{part(30)}.{part(300)}.{part(43)}~{part(20)}==", "ab.cdefgh"
    rows = [(1, f"token: {long} end"), (2, f'secret = "{jwt}" end'), (3, f"api_key={dots}. Then"), (4, f"api_key={dots}"), (5, "token: yes..."), (6, "password: joe.doe@mail.example.com"), (7, "password: abcdef@123")]
    out = {r.doc_id: r.text for r in pii.pseudonymize(docs(spark, rows), "k").collect()}
    for k, value in ((1, long), (2, jwt)):
        new = out[k].split()[-2].strip('"')
        assert len(out[k]) == len(rows[k - 1][1]) and out[k].endswith(" end") and sum(a == b for a, b in zip(value, new)) < 0.15 * len(value) and [c.isalnum() for c in value] == [c.isalnum() for c in new]
    assert out[3] == out[4] + ". Then" and dots not in out[4] and out[5] == "token: yes..."
    assert out[6].endswith(".com") and "doe" not in out[6] and "example" not in out[6] and "abcdef" not in out[7]


# ---- op3


def brute_model(texts, order):
    """The same model from definitions, with dictionaries."""
    grams = {}
    for t in texts:
        for g in quality.grams(quality.symbols(t, order), order).tolist():
            grams[g] = grams.get(g, 0) + 1
    tables = {order: grams}
    for k in range(order - 1, 0, -1):
        low = {}
        for g in tables[k + 1]:
            low[g & ((1 << 12 * k) - 1)] = low.get(g & ((1 << 12 * k) - 1), 0) + 1
        tables[k] = low

    def discount(k):
        n = [sum(c == j for c in tables[k].values()) for j in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1]) if n[0] + 2 * n[1] else None
        raw = [j - (j + 1) * y * n[j] / n[j - 1] if y is not None and n[j - 1] else j / 2 for j in (1, 2, 3)]
        return [min(max(d, 0.01 * j), j - 0.01) for j, d in zip((1, 2, 3), raw)]

    ds = {k: discount(k) for k in tables}

    def p(g, k):
        if k == 0:
            return quality.UNIFORM
        g &= (1 << 12 * k) - 1
        same = {x: c for x, c in tables[k].items() if x >> 12 == g >> 12}
        if not same:
            return p(g, k - 1)
        total = sum(same.values())
        d = lambda c: ds[k][min(c, 3) - 1]
        own = (tables[k][g] - d(tables[k][g])) / total if g in tables[k] else 0
        return own + sum(map(d, same.values())) / total * p(g, k - 1)

    return p


@pytest.mark.parametrize("shard", [quality.SHARD, 40, 1])
def test_kneser_ney_equals_brute_force(spark, shard):
    texts = ["the cat sat on the mat", "the dog sat", "a cat and a dog", "mat the hat", "猫はマットの上に座った"]
    scratch = Scratch(spark, "test")
    model = scratch.table(quality.train(spark.createDataFrame([("en", t) for t in texts], "lang string, text string").repartition(3), scratch, 3), "model")
    tests = ["the cat", "zzz", "a", "hat dog é日", "犬はマットの上", "\U0001f600猫", None, ""]
    out, name = quality.score(docs(spark, list(enumerate(tests))), model, text="text", lang="lang", order=3, shard=shard)
    got = {r.doc_id: r[name] for r in out.collect()}
    p = brute_model(texts, 3)
    for k, t in enumerate(tests):
        if t:
            want = -sum(np.log(p(g, 3)) for g in quality.grams(quality.symbols(t, 3), 3).tolist()) / len(t)
            assert got[k] == pytest.approx(want, rel=1e-4)
        else:
            assert got[k] is None


def test_symbols_are_one_to_one():
    every = [tuple(quality.symbols(chr(c), 1)) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    assert len(set(every)) == len(every) and {x for s in every for x in s} <= set(range(2, 1 << quality.BITS))
    one, lead, trail = ({s[k] for s in every if len(s) == n} for n, k in ((1, 0), (2, 0), (2, 1)))
    assert not (one & lead or one & trail or lead & trail)  # so texts are one to one, too


def test_a_large_bin_is_cut_by_the_symbols_before(spark):
    scratch = Scratch(spark, "test")
    rng = random.Random(8)
    texts = [("en", "".join(rng.choice("abcdefgh") + rng.choice("abcdefgh") + "x" + rng.choice("abcdefgh") for _ in range(200)))]
    model = scratch.table(quality.train(spark.createDataFrame(texts, "lang string, text string"), scratch, 4), "model")
    sizes, d = quality.summary(model, 4, 60)
    parts = quality._bounds(list(quality.shards(sizes, 60)), 4)
    assert sum(n for *_, n in quality.summary(model, 4)[0]) > 600 and len(parts) > 5
    held = [sum(len(v[0]) for (kind, _), v in quality.load(model, p, d, 4)["en"][2].items() if not kind) for p in parts]
    assert max(held) <= 60 + 2 * 3 * 9 + 9  # and the shorter contexts at both ends, of at most 9 symbols each


def test_quality_keeps_clean_and_rejects_junk(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice(["ta", "ri", "mo", "sel"]) for _ in range(rng.randrange(1, 4)))
    clean = [(k, " ".join(word() for _ in range(80))) for k in range(200)]
    junk = [(k, " ".join(word().upper() + "!!" for _ in range(60))) for k in range(300, 320)]
    d = docs(spark, [*clean, *junk, (400, None), (401, "")])
    labels = spark.createDataFrame([(k, 1, 0) for k in range(0, 200, 2)], "doc_id long, quality int, toxic int")
    kept = quality.keep_clean(d, labels)
    ids = {r.doc_id for r in kept.collect()}
    assert kept.columns == d.columns and len(ids & set(range(200))) >= 196 and not ids & set(range(300, 320)) and {400, 401} <= ids
    assert quality.keep_clean(d, labels.limit(0)).count() == d.count() and quality.keep_clean(d.limit(0), labels).count() == 0


def test_quality_scores_by_other_folds_and_keeps_only_the_band(spark):
    rng = random.Random(4)
    texts = [" ".join(rng.choice(["tari", "mosel", "rita", "selmo", "mori"]) for _ in range(rng.randrange(3, 9))) for _ in range(40)]
    texts += texts[:3]  # an exact copy does not train its own model
    d = docs(spark, list(enumerate([*texts, *("tari mosel rita " * n + "x?" for n in range(1, 12))])))
    labels = spark.createDataFrame([(k, 1, 0) for k in range(len(texts))], "doc_id long, quality int, toxic int")
    out, name, keep = quality.judge(d, labels, order=3)
    got = {r.doc_id: r for r in out.withColumn("fold", quality.fold_of("text", quality.FOLDS)).collect()}
    models = {f: brute_model([t for k, t in enumerate(texts) if got[k].fold != f], 3) for f in range(quality.FOLDS)}
    lp = {k: -np.mean([np.log(models[r.fold](g, 3)) for g in quality.grams(quality.symbols(r.text, 3), 3).tolist()]) for k, r in got.items()}
    assert {k: r[name] for k, r in got.items()} == pytest.approx(lp, rel=1e-4)
    known = sorted(lp[k] for k in range(len(texts)))
    low, high = known[0], known[int(np.ceil(0.99 * len(known))) - 1]
    assert all(r[keep] == (low * (1 - 1e-4) <= lp[k] <= high * (1 + 1e-4)) for k, r in got.items())
    assert any(high < x < 2 * high - low for x in lp.values())  # junk that a band of three times the width would keep
