"""Classifier, near duplicates, packing, nearest neighbours, sharding, pipeline."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from farelake.llm import ann, components, line_dedup, minhash, packing, quality, sharding, shingles
from farelake.llm.queries import QUERIES, quality_network
from tests.llm.conftest import brute_components, brute_words
from tests.llm.test_llm_text_ops import BYTE, _library

SF = "/root/testdata/sf0.001"


# ---------------------------------------------------------------- classifier
def test_chunks_cover_every_byte():
    texts = [b"", b"a", bytes(range(1, 256)) * 9, b"x" * quality.CHUNK, b"y" * (quality.CHUNK + 1)]
    rows, owner = quality.chunk_bytes(texts)
    step = quality.CHUNK - quality.OVERLAP
    for i, t in enumerate(texts):
        mine = rows[owner == i]
        got = b"".join(bytes(r[:step]) for r in mine[:-1]) + bytes(mine[-1])
        assert got.rstrip(b"\0") == t


def test_gradients_by_differences():
    rng = np.random.default_rng(1)
    net = quality.fit([b"abc abc", b"!!! ###"], np.array([1, 0]))
    texts, y, w = [b"hello there", b"?? !! ?? " * 80], np.array([1.0, 0.0], np.float32), np.ones(2, np.float32)

    def loss():
        p = net.scores(texts)
        return float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean())

    for p, g in zip(net.parameters(), quality._gradients(net, texts, y, w)):
        flat, grad = p.reshape(-1), np.asarray(g).reshape(-1)
        for k in rng.permutation(np.flatnonzero(np.abs(grad) > 1e-4))[:4]:
            before = flat[k]
            flat[k] = before + 1e-3
            up = loss()
            flat[k] = before - 1e-3
            down = loss()
            flat[k] = before
            assert abs((up - down) / 2e-3 - grad[k]) < 0.05 * max(0.02, abs(grad[k])) + 2e-3


def test_scores_of_odd_rows_and_carried_columns(docs, nothing):
    net = quality.fit([b"good text. more", b"!!! $$$ %%%"] * 4, np.array([1, 0] * 4))
    out = quality.score(docs, net, carried=tuple(docs.columns))
    assert out.columns == ["doc_id", "text", "lang", "deleted", "n_chars", "score"]
    rows = out.collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    by_text = defaultdict(set)
    for r in rows:
        by_text[r.text or ""].add(r.score)
    assert all(max(s) - min(s) < 1e-5 for s in by_text.values())
    assert quality.score(nothing, net).count() == 0


def test_labels_that_are_missing_or_contradict(spark, docs):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (2, 1, 0), (3, None, 0), (99, 1, 0)], "doc_id long, quality int, toxic int")
    assert isinstance(quality.train(docs, labels), quality.Network)
    assert isinstance(quality.train(docs, labels.where("doc_id < 0")), quality.Network)


def test_training_reads_whole_texts(spark, monkeypatch):
    texts = {i: f"start {i} " + "middle " * 2000 + f"end {i}" for i in range(10)}
    seen = []
    monkeypatch.setattr(quality, "fit", lambda rows, *_: seen.extend(rows))
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    quality.train(df, spark.createDataFrame([(i, i % 2) for i in texts], "doc_id long, quality int"))
    used = df.where(~quality.held_out("doc_id")).collect()
    assert used and sorted(seen) == sorted(r.text.encode() for r in used)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    unseen = docs.where(quality.held_out("doc_id")).join(labels, "doc_id").select("doc_id", "text", "quality")
    rows = quality.score(unseen, quality_network(spark, sf), carried=("doc_id", "quality")).collect()
    good = [r.score for r in rows if r.quality == 1]
    bad = [r.score for r in rows if r.quality == 0]
    assert np.mean([s >= 0.3 for s in good]) > 0.98 and np.mean([s < 0.3 for s in bad]) > 0.9
    assert np.mean([g > b for g in good for b in bad]) > 0.99
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in rows)


def test_long_texts_are_scored_in_pieces(monkeypatch):
    net = quality.fit([b"good text. more", b"!!! $$$ %%%"] * 4, np.array([1, 0] * 4))
    rng = np.random.default_rng(1)
    texts = [rng.integers(32, 127, n, np.uint8).tobytes() for n in (5, 9_000, 9_001, 40_000, 448 * 20 + 64)]
    whole = net.scores(texts)
    monkeypatch.setattr(quality, "PIECE", 3)
    assert np.allclose(net.scores(texts), whole, atol=1e-6)


def test_training_texts_are_bounded_in_bytes(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(quality, "fit", lambda rows, *_: seen.extend(rows))
    monkeypatch.setattr(quality, "SAMPLE_BYTES", 2500)
    df = spark.range(60).selectExpr("id as doc_id", "repeat('x', if(id % 7 = 0, 5000, 400)) as text")
    quality.train(df, spark.range(60).selectExpr("id as doc_id", "cast(id % 2 as int) as quality"))
    assert len(seen) == 12 and {len(t) for t in seen} == {400}


# ---------------------------------------------------------------- near duplicates
def test_long_texts_have_the_same_sets_in_parts(monkeypatch):
    rnd = random.Random(4)
    texts = [" ".join(rnd.choice(["é", "B", "ccc", "dd\x0bd", "x" * 70]) for _ in range(n)).encode() for n in (900, 3, 4000, 1, 5)] + [b"y" * 3000, b" " * 3000]
    whole = list(shingles.shingle_sets(texts))
    monkeypatch.setattr(shingles, "BLOCK", 100)
    monkeypatch.setattr("farelake.llm.words.PART", 100)
    for a, b in zip(whole, shingles.shingle_sets(texts), strict=True):
        assert a.tolist() == b.tolist()


def test_shingle_sets_match_brute_force():
    rnd = random.Random(2)
    texts = ["", " ", "one", "Two words", "a b c d", "A b C d E", "x " * 50]
    texts += [" \t\n\x0b".join(rnd.choices(["é", "B", "b", "ccc", "D d"], k=rnd.randint(1, 40))) for _ in range(60)]
    for text, got in zip(texts, shingles.shingle_sets([t.encode() for t in texts])):
        w = brute_words(text)
        want = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
        assert len(got) == len(want)
    a, b = shingles.shingle_sets([b"q w e r t y", b"Q  W E R\tT Y"])
    assert (a == b).all()


def _noisy(rnd, words, share):
    return [w if rnd.random() > share else f"n{rnd.randint(0, 10**6)}" for w in words]


def _near_corpus(seed=4):
    """Groups with similarities all around the threshold, one of them large, and shared passages."""
    rnd = random.Random(seed)
    word = lambda: f"v{rnd.randint(0, 4000)}"
    rows, i = [], 0
    for size, share in ((60, 0.03), (40, 0.05), (12, 0.02), (5, 0.01), (30, 0.06)):
        base = [word() for _ in range(120)]
        for _ in range(size):
            rows.append((i, " ".join(_noisy(rnd, base, share))))
            i += 1
    passage = [word() for _ in range(60)]
    for _ in range(40):
        rows.append((i, " ".join([word() for _ in range(rnd.randint(5, 60))] + passage)))
        i += 1
    rows += [(i, rows[0][1]), (i + 1, rows[0][1].upper()), (i + 2, "few words"), (i + 3, "Few  words"), (i + 4, None), (i + 5, " ")]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("small, members", [(8, 1024), (2, 7)])
def test_near_duplicates_match_brute_force(spark, monkeypatch, small, members):
    monkeypatch.setattr(minhash, "SMALL", small)
    monkeypatch.setattr(minhash, "MEMBERS", members)
    rows = _near_corpus()
    df = spark.createDataFrame([(a, b, "x") for a, b in rows], "doc_id long, text string, component_id string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(df).collect()}
    assert got == brute_components(rows)


def test_near_duplicates_of_odd_rows(spark, docs, nothing):
    out = minhash.near_duplicates(docs).collect()
    want = brute_components([(r.doc_id, r.text) for r in docs.collect()])
    assert len(out) == docs.count()
    assert all((r.n_shingles, r.component_id) == want[r.doc_id] and r.kept == (r.doc_id == r.component_id) for r in out)
    assert minhash.near_duplicates(nothing).count() == 0
    lone = spark.createDataFrame([(None, "a b c d e f")], "doc_id long, text string")
    assert [(r.component_id, r.kept) for r in minhash.near_duplicates(lone).collect()] == [(None, True)]


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(7, 7), (200, 201), (201, 200)]
    got = dict(components.components(spark.createDataFrame(edges, "u long, v long")).collect())
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 130)}, 200: 200, 201: 200}
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


# ---------------------------------------------------------------- packing
def test_pieces_match_the_library(docs):
    library = _library(BYTE)
    capacity = 100
    got = defaultdict(list)
    for r in packing.token_pieces(docs.dropDuplicates(["doc_id"]), BYTE, public_tokenizers.PATTERN, capacity, with_ids=True).collect():
        got[r.doc_id].append(r)
    for d in docs.dropDuplicates(["doc_id"]).collect():
        ids = library.encode(d.text or "", add_special_tokens=False).ids + [0]
        pieces = sorted(got[d.doc_id], key=lambda r: r.piece)
        assert np.concatenate([np.frombuffer(bytes(r.ids), "<u4") for r in pieces]).tolist() == ids
        assert [r.start for r in pieces] == np.cumsum([0] + [r.length for r in pieces])[:-1].tolist()
        assert all(r.length == capacity for r in pieces[1:]) and pieces[0].length <= capacity
        assert all(r.ids_crc32 == zlib.crc32(bytes(r.ids)) and 4 * r.length == len(r.ids) for r in pieces)


def _check_packed(lengths, sequence, offset, capacity):
    by = defaultdict(list)
    for n, s, o in zip(lengths, sequence, offset):
        by[s].append((int(o), int(n)))
    for items in by.values():
        at = 0
        for o, n in sorted(items):
            assert o == at
            at += n
        assert at <= capacity
    return len(by)


@pytest.mark.parametrize("seed", range(4))
def test_packing_is_close_to_the_bound(seed):
    rng = np.random.default_rng(seed)
    lengths = np.minimum(2048, np.maximum(1, rng.lognormal(6 + seed / 3, 1, 3000))).astype(int)
    used = _check_packed(lengths, *packing.pack_lengths(lengths, 2048), 2048)
    assert used <= np.ceil(lengths.sum() / 2048) * 1.005 + 1


def test_search_looks_at_all_documents():
    """Pieces of few lengths: hundreds of equal candidates in fuller bins, and none is skipped for it."""
    rng = np.random.default_rng(0)
    lengths = rng.choice(rng.integers(300, 1200, 50), 4096)
    bins = packing._Bins(lengths, 2048)
    bins.best_fit()
    before = bins.used()
    bins.local_search()
    assert bins.used() <= 1463 < before
    # no move and no exchange of single documents is left
    order = sorted((k for k, x in enumerate(bins.items) if x), key=lambda k: (bins.gap[k], k))
    emptiest = {}
    for r, k in enumerate(order):
        for i in bins.items[k]:
            emptiest[int(lengths[i])] = r
    for r, k in enumerate(order):
        for n, far in emptiest.items():
            if far > r:
                assert n > bins.gap[k]
                assert not any(int(lengths[i]) < n <= lengths[i] + bins.gap[k] for i in bins.items[k])


def test_lengths_that_cannot_be_packed_raise(spark):
    for n in (None, 0, 101):
        with pytest.raises(Exception, match="a length is null"):
            packing.pack(spark.createDataFrame([(1, 5), (2, n)], "id long, length long"), 100)


def test_local_search_empties_bins():
    bins = packing._Bins(np.array([6, 4, 5, 5, 7, 3]), 10)
    bins.items, bins.gap = [[0, 5], [1], [2], [3], [4]], [1, 6, 5, 5, 3]
    bins.local_search()
    assert bins.used() == 3 and sorted(i for x in bins.items for i in x) == list(range(6))
    assert all(bins.gap[k] == 10 - sum([6, 4, 5, 5, 7, 3][i] for i in x) >= 0 for k, x in enumerate(bins.items))


def test_pack_frame_over_several_groups(spark, docs, nothing, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 50)
    df = spark.range(400).selectExpr("id", "1 + pmod(hash(id), 90) as length", "'x' as offset_", "id as n")
    rows = packing.pack(df, 100).collect()
    assert len(rows) == 400
    used = _check_packed([r.length for r in rows], [r.sequence_id for r in rows], [r.offset for r in rows], 100)
    assert used <= sum(r.length for r in rows) / 100 * 1.1 + 8
    pieces = packing.pack(packing.token_pieces(docs, BYTE))
    assert Counter(r.doc_id for r in pieces.collect() if r.piece == 0) == Counter(r.doc_id for r in docs.collect())
    assert packing.pack(packing.token_pieces(nothing, BYTE)).count() == 0


# ---------------------------------------------------------------- nearest neighbours
def _brute(vectors, queries, k):
    out = {}
    for q in queries:
        near = sorted((float(np.sqrt(((np.array(v) - np.array(vectors[q])) ** 2).sum())), i) for i, v in vectors.items() if i != q and len(v) == len(vectors[q]))
        out[q] = near[:k]
    return out


def test_nearest_recall_and_scores(spark):
    rng = np.random.default_rng(0)
    vectors = {i: v.tolist() for i, v in enumerate(rng.standard_normal((1500, 16)).astype(np.float32))}
    df = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<float>")
    queries = df.where("vec_id % 20 = 0")
    got = defaultdict(list)
    for r in ann.nearest(df, queries, shard_size=400).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.score, r.vec_id, r["rank"]))
    want = _brute(vectors, [i for i in vectors if i % 20 == 0], 10)
    hits = sum(len({i for _, i, _ in got[q]} & {i for _, i in want[q]}) for q in want)
    assert hits / (10 * len(want)) >= 0.95
    for q, found in got.items():
        assert [r for *_, r in found] == list(range(1, 11)) and found == sorted(found)
        assert all(abs(s - np.linalg.norm(np.array(vectors[q]) - np.array(vectors[i]))) < 1e-9 for s, i, _ in found)


def test_a_search_computes_few_distances_once():
    rng = np.random.default_rng(3)
    points = rng.standard_normal((6000, 24)).astype(np.float32)
    edges, entry = ann.build_graph(points)
    assert edges.max() < 6000 and ((edges >= 0).sum(1) > 0).all()
    counted = []
    found, near = ann.beam_search(points, edges, entry, points[:200], 64, counted)
    # with repeats it would be several times the shard; of a larger shard it is a smaller share
    assert sum(counted) < 0.25 * 6000 * 200
    assert (found[:, 0] == np.arange(200)).mean() > 0.98 and (np.diff(near, axis=1) >= 0).all()
    assert all(len(set(row[row >= 0])) == (row >= 0).sum() for row in found)


def test_nearest_with_copies_and_unusable_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 0.0]) for i in range(40)] + [(100, [0.0, 1.0]), (101, [0.0, 0.0]), (102, None), (103, [nan, 1.0]), (104, [inf, 1.0]),
                                                  (105, [None, 1.0]), (106, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (100, [0.0, 1.0]), (107, [])]
    df = spark.createDataFrame([r + (0,) for r in rows], "vec_id long, embedding array<float>, rank int")
    got = defaultdict(list)
    for r in ann.nearest(df, df).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    assert set(got) == {*range(40), 100}
    assert got[3] == [(i, 0.0) for i in range(11) if i != 3]
    assert got[39] == [(i, 0.0) for i in range(10)]
    assert [i for i, _ in got[100]] == list(range(10)) and got[100][0][1] == np.sqrt(2)
    few = ann.nearest(df.where("vec_id in (0, 100)"), df.where("vec_id = 0")).collect()
    assert [(r.query_id, r.vec_id, r["rank"]) for r in few] == [(0, 100, 1)]
    assert ann.nearest(df.where("vec_id < 0"), df).count() == 0


def test_query_recall_on_the_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()
    matrix, ids = np.array([r.embedding for r in rows], np.float64), np.array([r.vec_id for r in rows])
    got = defaultdict(set)
    for r in QUERIES["op9_ann"](spark, "/root/testdata/sf0.1").collect():
        got[r.query_id].add(r.vec_id)
    hits = 0
    for q in got:
        far = ((matrix - matrix[ids == q]) ** 2).sum(1)
        far[ids == q] = np.inf
        hits += len(got[q] & set(ids[np.argsort(far, kind="stable")[:10]].tolist()))
    assert set(got) == {i for i in ids.tolist() if i % 100 == 0} and hits >= 9 * len(got)


# ---------------------------------------------------------------- sharding
def test_difference_balances():
    rng = np.random.default_rng(3)
    sizes = rng.integers(1, 5000, 2000)
    sums = np.bincount(sharding.difference(sizes, 16), sizes, 16)
    assert np.ptp(sums) <= 2
    assert sorted(np.bincount(sharding.difference(np.array([8, 7, 6, 5, 4]), 2), [8, 7, 6, 5, 4]).tolist()) == [14, 16]
    assert sharding.difference(np.array([], int), 4).tolist() == []


def test_shards_do_not_depend_on_the_rows_order(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BUCKET", 60)
    rng = np.random.default_rng(5)
    rows = [(i, "x" * int(n) + str(i % 97)) for i, n in enumerate(rng.integers(1, 9, 400))]
    places = []
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2 + seed)
        places.append({r.doc_id: r.shard for r in sharding.shard_documents(df, 4).collect()})
    assert places[0] == places[1] == places[2]


def test_shards_over_several_levels(spark, docs, nothing, monkeypatch):
    monkeypatch.setattr(sharding, "BUCKET", 60)
    rng = np.random.default_rng(1)
    rows = [(i, "x" * int(n)) for i, n in enumerate(rng.integers(1, 400, 500))] + [(1000, "y" * 9000), (1001, None), (1002, ""), (1003, "é")]
    rows += [(2000 + i, "copy") for i in range(30)]
    df = spark.createDataFrame([r + ("s",) for r in rows], "doc_id long, text string, shard string")
    out = sharding.shard_documents(df, 4).collect()
    assert sorted(r.doc_id for r in out) == sorted(i for i, _ in rows)
    texts = dict(rows)
    by_text, slots, sums = defaultdict(set), defaultdict(list), Counter()
    for r in out:
        t = texts[r.doc_id] or ""
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(t.encode()) + 1, zlib.crc32(t.encode()), "bytes", None)
        by_text[t].add(r.shard)
        slots[r.shard].append(r.slot)
        sums[r.shard] += r.size
    assert all(len(s) == 1 for s in by_text.values()) and set(sums) == {0, 1, 2, 3}
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(sums.values()) - min(sums.values()) <= 0.02 * sum(sums.values()) / 4
    assert sharding.shard_documents(nothing).count() == 0
    odd = sharding.shard_documents(docs).collect()
    assert Counter(r.doc_id for r in odd) == Counter(r.doc_id for r in docs.collect())


# ---------------------------------------------------------------- pipeline
def test_pipeline_against_plain_python(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    network = quality_network(spark, SF)
    rows = [(r.doc_id, r.text or "") for r in docs.collect()]
    scores = network.scores([t.encode() for _, t in rows])
    kept = [(i, t) for (i, t), s in zip(rows, scores) if s >= 0.3]
    stage = corpus_pipeline.quality_stage(spark, docs, SF)
    assert stage.columns == docs.columns and sorted(r.doc_id for r in stage.collect()) == sorted(i for i, _ in kept)

    lines = corpus_pipeline.line_stage(spark, stage, SF)
    assert lines.columns == docs.columns
    cleaned = {r.doc_id: r for r in lines.collect()}
    gone = {r.doc_id: set(r.deleted_lines) for r in line_dedup.dedup_lines(stage).collect()}
    for i, t in kept:
        left = "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[i])
        assert (i in cleaned) == (not gone[i] or bool(left.strip()))
        if i in cleaned:
            assert cleaned[i].text == left and cleaned[i].n_chars == len(left)

    near = corpus_pipeline.near_duplicate_stage(spark, lines, SF)
    want = {i for i, (_, c) in brute_components([(i, r.text) for i, r in cleaned.items()]).items() if i == c}
    assert near.columns == docs.columns and {r.doc_id for r in near.collect()} == want

    packed = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in packed} == want
    _check_packed([r.length for r in packed], [r.sequence_id for r in packed], [r.offset for r in packed], 2048)
    library = _library(BYTE)
    for r in packed[:40]:
        ids = library.encode(cleaned[r.doc_id].text, add_special_tokens=False).ids + [0]
        assert zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes()) == r.ids_crc32


def test_stages_are_listed_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_classifier", "line_dedup", "minhash_near_dedup", "best_fit_packing"]
