"""Periodic runs, ranked lexical search, decontamination."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from farelake.llm import decontaminate, item_blocks, periodic, ranked_search
from farelake.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def _lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


# ---------------------------------------------------------------- periodic runs
def brute_runs(w):
    """(start, end, period) of all runs, period by period."""
    out = []
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q) and not any(all(w[x] == w[x + p] for x in range(i, j + q - p)) for p in range(1, q)):
                out.append((i, j + q, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def _planted_words(rnd):
    k = rnd.choice([1, 2, 3, 5])
    w = [rnd.randrange(k) for _ in range(rnd.randint(0, 70))]
    for _ in range(rnd.randint(0, 3)):
        unit = [rnd.randrange(k + 2) for _ in range(rnd.randint(1, 14))]
        at = rnd.randint(0, len(w))
        w[at:at] = (unit * rnd.randint(1, 8))[: max(0, len(unit) * 8 - rnd.randint(0, 3))]
    return w


def test_catchers_find_all_runs():
    rnd = random.Random(5)
    hashes = np.random.default_rng(0).integers(-(2**62), 2**62, 20)
    for _ in range(400):
        docs = [_planted_words(rnd) for _ in range(rnd.randint(1, 5))]
        bounds = np.cumsum([0] + [len(d) for d in docs])
        got = periodic.catch(hashes[np.array(sum(docs, []), int)], bounds)
        assert sorted(got) == sorted((s + bounds[k], e + bounds[k], q) for k, d in enumerate(docs) for s, e, q in brute_runs(d))


def test_long_streams_of_few_words():
    n = 300_000
    fibonacci = [[0], [0, 1]]
    while len(fibonacci[-1]) < n:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    bounds = np.array([0, n])
    for words, want in (
        ([1] * n, [(0, n, 1)]), ([1, 2] * (n // 2), [(0, n, 2)]), (fibonacci[-1][:n], []),
        (list(range(1000)) * 300, [(0, n, 1000)]), ([x for i in range(n // 2) for x in (1, 9 + i)], []),
    ):
        assert periodic.catch(np.array(words, np.int64) * 1234567891011, bounds) == want


def test_runs_of_odd_rows(spark, docs, nothing):
    got = periodic.find_runs(docs).collect()
    assert sorted(r.doc_id for r in got) == sorted(r.doc_id for r in docs.collect())
    for r in got:
        text = {d.doc_id: d.text for d in docs.collect()}[r.doc_id]
        assert r.n_words == len(WORD.findall(text or "")) and r.runs == [] and r.collapsed == " ".join(WORD.findall(text or ""))
    assert periodic.find_runs(nothing).count() == 0
    long = "é\x0bB  " * 900_000
    odd = spark.createDataFrame([(None, "a " * 9, 1), (2, long, 1), (2, long, 1)], "doc_id long, text string, runs int")
    for r in periodic.find_runs(odd).collect():
        assert len(r.runs) == 1 and r.runs[0].asDict() == ({"start": 0, "length": 9, "period": 1} if r.doc_id is None else {"start": 0, "length": 1_800_000, "period": 2})
        assert r.collapsed == ("a" if r.doc_id is None else "é B ")


def test_op11_matches_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = {r.doc_id: r for r in QUERIES["op11_periodic_runs"](spark, SF).collect()}
    assert len(got) == len(rows)
    with_runs = 0
    for d in rows:
        w = WORD.findall(d.text or "")
        h, n = zlib.crc32(str(d.doc_id).encode()), len(w)
        if h % 10 == 0 and n:
            g = h // 10
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
        runs = brute_runs(w)
        gone = {i for s, e, q in runs for i in range(s + q, e)}
        best = min(runs, key=lambda r: (-(r[1] - r[0]) / r[2], r[0], r[2])) if runs else None
        want = (len(runs), *((best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2]) if best else [None] * 4),
                hashlib.sha256("".join(f"{s},{e - s},{q}\n" for s, e, q in runs).encode()).hexdigest(),
                hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest())
        r = got[d.doc_id]
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256) == want
        with_runs += bool(runs)
    assert with_runs > 5


# ---------------------------------------------------------------- ranked search
def brute_ranking(docs, items, k):
    """(item, rank, doc, score) rows by scoring every document."""
    bags = [(i, Counter(TERM.findall(_lower(t)))) for i, t in docs]
    n_docs, total = sum(1 for _, b in bags if b), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        terms = Counter(TERM.findall(_lower(text)))
        scored = []
        for i, b in bags:
            m = 75 + 25 * sum(b.values()) * n_docs // total if total else 0
            score = sum(c * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * b[t] // (1000 * b[t] + 12 * m)) for t, c in terms.items() if t in b)
            if score > 0 and i is not None:
                scored.append((-score, i))
        out += [(item, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def _corpus(seed, n):
    rnd = random.Random(seed)
    vocabulary = [f"t{int(rnd.paretovariate(0.6))}" for _ in range(300)]
    text = lambda most: " ".join(rnd.choices(vocabulary, k=rnd.randint(0, most)))
    docs = [(i, text(60)) for i in range(n)]
    docs += [(n, docs[1][1]), (n + 1, docs[1][1].upper()), (n + 2, None), (n + 3, ""), (n + 4, "t1, t1. T1"), (None, "t1 t2 t5")]
    items = [(j, text(12)) for j in range(30)] + [(50, "t1 t1 t2"), (51, ""), (52, None), (53, "unheard of"), (50, "t3")]
    return docs, items


@pytest.mark.parametrize("block_bytes", [1 << 20, 300])
def test_ranking_matches_brute_force(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(item_blocks, "BLOCK_BYTES", block_bytes)
    docs, items = _corpus(1, 250)
    d = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, rank int, terms string").repartition(3)
    q = spark.createDataFrame([(j, t, 0) for j, t in items], "item_id long, text string, doc_id int")
    got = sorted((r.item_id, r["rank"], r.doc_id, r.score) for r in ranked_search.rank_documents(d, q, 7).collect())
    assert got == brute_ranking(docs, items, 7)
    assert ranked_search.rank_documents(d.where("doc_id < 0"), q).count() == 0
    assert ranked_search.rank_documents(d, q.where("item_id < 0")).count() == 0


def test_skipping_keeps_the_best(monkeypatch):
    """Strides of few documents, short and long lists, many ties: the same as summing everything."""
    monkeypatch.setattr(ranked_search, "STRIDE", 16)
    rng = np.random.default_rng(2)
    for trial in range(30):
        size, known = 400, 40
        share = rng.random(known) ** 3
        owner, term = np.nonzero(rng.random((size, known)) < share)
        count = rng.integers(1, 4, len(owner))
        weight = np.floor(1000 * np.log((2 * size + 2) / (2 * np.bincount(term, minlength=known) + 1))).astype(np.int64)
        shard = ranked_search.Shard(12 * rng.integers(75, 80 + 40 * (trial % 2), size), owner, term, count, weight)
        for _ in range(10):
            item = [(int(t), int(rng.integers(1, 3))) for t in rng.permutation(known)[: rng.integers(1, 15)]]
            whole = np.zeros(size, np.int64)
            for t, n in item:
                at = slice(shard.starts[t], shard.starts[t + 1])
                whole[shard.docs[at]] += n * shard.shares[at]
            want = [d for d in np.lexsort((np.arange(size), -whole))[:9] if whole[d] > 0]
            docs, scores = shard.best(item, 9)
            assert docs.tolist() == want and scores.tolist() == whole[want].tolist()


def test_ranking_of_odd_documents(spark, docs):
    items = spark.createDataFrame([("x", "alpha w1x1 Éa")], "item_id string, text string")
    got = [(r.item_id, r.doc_id) for r in ranked_search.rank_documents(docs, items).orderBy("rank").collect()]
    want = brute_ranking([(r.doc_id, r.text) for r in docs.collect()], [("x", "alpha w1x1 Éa")], 20)
    assert got == [(i, d) for i, _, d, _ in want]


# ---------------------------------------------------------------- decontamination
def brute_matches(docs, items, width):
    """doc row -> (words, hit places, items) by looking every window up in every document."""
    windows = defaultdict(set)
    for item, text in items:
        w = TERM.findall(_lower(text))
        if item is not None and w:
            for i in range(max(1, len(w) - width + 1)):
                windows[tuple(w[i : i + width])].add(str(item))
    out = []
    for i, text in docs:
        w = TERM.findall(_lower(text))
        hit, found = set(), set()
        for n in {len(x) for x in windows}:
            for at in range(len(w) - n + 1):
                if tuple(w[at : at + n]) in windows:
                    hit |= set(range(at, at + n))
                    found |= windows[tuple(w[at : at + n])]
        out.append((i, len(w), sorted(hit), sorted(found)))
    return out


def _leaky(seed):
    rnd = random.Random(seed)
    word = lambda: rnd.choice(["a", "B", "c", "D1", "é", "zz"])
    items = [(j, " ".join(word() for _ in range(rnd.randint(1, 14)))) for j in range(25)]
    items += [(100, items[0][1]), (3, "zz zz unheard"), (101, ""), (102, None), (None, "a B c"), (103, "é")]
    docs = []
    for i in range(80):
        w = [rnd.choice([word(), "other", "x9"]) for _ in range(rnd.randint(0, 30))]
        for _ in range(rnd.randint(0, 2)):
            at = rnd.randint(0, len(w))
            w[at:at] = rnd.choice(items[:25])[1].upper().split()
        docs.append((i, " ,".join(w)))
    return docs + [(90, None), (91, ""), (92, "..."), (None, items[5][1]), (93, docs[0][1]), (93, docs[0][1])], items


@pytest.mark.parametrize("block_bytes", [1 << 20, 120])
def test_matches_of_windows(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(item_blocks, "BLOCK_BYTES", block_bytes)
    docs, items = _leaky(3)
    d = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, n_hit int, items string").repartition(4)
    q = spark.createDataFrame([(j, t, 0) for j, t in items], "item_id long, text string, doc_id int")
    for width in (4, 10):
        got = [(r.doc_id, r.n_words, [k for s in r.spans for k in range(s.start, s.end)], list(r["items"])) for r in decontaminate.find_matches(d, q, width).collect()]
        want = brute_matches(docs, items, width)
        assert sorted(got, key=repr) == sorted(want, key=repr)
        kept = decontaminate.remove_contaminated(d, q, width)
        assert kept.columns == d.columns
        assert sorted(map(repr, (r.doc_id for r in kept.collect()))) == sorted(repr(i) for i, _, hit, _ in want if not hit)
    assert decontaminate.find_matches(d.where("doc_id < 0"), q).count() == 0
    assert {r.n_hit for r in decontaminate.find_matches(d, q.where("item_id < 0")).collect()} == {0}


def test_longest_matches(spark):
    items = spark.createDataFrame([(1, " ".join(f"a{i}" for i in range(40))), (2, "b c d"), (3, "never seen words")], "item_id long, text string")
    docs = spark.createDataFrame([
        (7, "x " + " ".join(f"A{i}" for i in range(5, 30)) + " y"), (8, " ".join(f"a{i}" for i in range(12, 39))), (9, "z. b-c;d"), (10, "a0 a1 a2")], "doc_id long, text string")
    got = {r.item: (r.length, r.item_start, r.doc_id, r.doc_start) for r in decontaminate.longest_matches(docs, items).collect()}
    assert got == {"1": (27, 12, 8, 0), "2": (3, 0, 9, 1)}


def test_suffix_array_is_sorted():
    rng = np.random.default_rng(1)
    for bits, high in ((2, 4), (11, 1500), (40, 4)):
        codes = np.append(rng.integers(0, high, 3000), 0).astype(np.int32)
        codes[1000:1600] = codes[:600]
        array = decontaminate.SuffixArray(codes, bits, 50, 2)
        cut = [tuple(codes[p : p + min(50, array.room[p])].tolist()) for p in array.places]
        assert cut == sorted(cut) and len(cut) == int((array.room >= 2).sum())


def test_very_long_and_hot_texts(spark):
    """A passage in every document, and in one document many times."""
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, f"d{i} {passage} e{i}") for i in range(300)] + [(1000, (passage + " q ") * 20_000)]
    items = spark.createDataFrame([(1, passage), (2, passage)], "item_id long, text string")
    got = {r.doc_id: (r.n_hit, r.n_words, list(r["items"])) for r in decontaminate.find_matches(spark.createDataFrame(rows, "doc_id long, text string"), items).collect()}
    assert got == {**{i: (60, 62, ["1", "2"]) for i in range(300)}, 1000: (1_200_000, 1_220_000, ["1", "2"])}


@pytest.mark.parametrize("name", ["op12_ranked_search", "op13_decontaminate"])
def test_queries_match_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    frame = QUERIES[name](spark, SF)
    rel = con.sql(ORACLE_SQL[name])
    got = [tuple(r[c] for c in rel.columns) for r in frame.collect()]
    assert sorted(frame.columns) == sorted(rel.columns) and sorted(got) == sorted(rel.fetchall()) and got
