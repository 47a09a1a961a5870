"""Exact dedup, tokens, extraction, line dedup, chat formatting."""

import hashlib
import json
import random

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from farelake.llm import bpe, chat_format, exact_dedup, html_extract, line_dedup, tokens
from farelake.llm.queries import ORACLE_SQL, PLANTED_TURN, QUERIES

WORD = public_tokenizers.path("word_bpe_49k.json")
BYTE = public_tokenizers.path("byte_bpe_50k.json")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


# ---------------------------------------------------------------- exact dedup
@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_exact_dedup_matches_brute_force(docs, keep):
    rows = docs.select("doc_id", "text").collect()
    groups = {}
    for r in rows:
        groups.setdefault(lowered(r.text), []).append(r.doc_id)
    out = exact_dedup.exact_dedup(docs, keep=keep).collect()
    assert len(out) == len(rows)
    by_id = {}
    for r in out:
        by_id.setdefault(r.doc_id, []).append(r)
    pick = min if keep == "smallest" else max
    for text, ids in groups.items():
        got = [r for i in set(ids) for r in by_id[i]]
        assert {r.keep_id for r in got} == {pick(ids)} and {r.group_size for r in got} == {len(ids)}
        assert {r.text_sha256 for r in got} == {hashlib.sha256(text.encode()).hexdigest()}
        assert sum(r.kept for r in got) == 1 and next(r for r in got if r.kept).doc_id == pick(ids)


def test_exact_dedup_of_a_hot_text_and_null_ids(spark, nothing):
    rows = [(i, "same") for i in range(300)] + [(i, f"t{i}") for i in range(300, 400)] + [(None, "same"), (None, "lone")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    out = exact_dedup.exact_dedup(df, keep="largest").collect()
    hot = [r for r in out if r.group_size > 1]
    assert len(hot) == 301 and {(r.keep_id, r.group_size) for r in hot} == {(299, 301)}
    assert [r.doc_id for r in hot if r.kept] == [299]
    lone = [r for r in out if r.doc_id is None and r.group_size == 1]
    assert len(lone) == 1 and lone[0].kept and lone[0].keep_id is None
    assert exact_dedup.exact_dedup(nothing).count() == 0


# ---------------------------------------------------------------- tokens
ALPHABET = [*"ab  '\n\t.1é́ΣςßǅÉ日  ​　\x85\x1c!"] + ["<|endoftext|>", "<|startoftext|>", "'s", "'T", " the", "  "]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(ALPHABET), max_size=14).map("".join))
def test_cached_encoders_match_the_library(text):
    for path, pattern in ((WORD, None), (BYTE, public_tokenizers.PATTERN)):
        vocabulary = tokens.vocabulary_text(path)
        library = _library(path)
        assert tokens.encoder_for(vocabulary, pattern).encode(text) == np.array(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


_LIBRARIES = {}


def _library(path):
    if path not in _LIBRARIES:
        _LIBRARIES[path] = tokens.library_tokenizer(tokens.vocabulary_text(path))
    return _LIBRARIES[path]


def test_encode_and_decode_match_the_library(docs, nothing):
    library = _library(WORD)
    encoded = bpe.encode(docs, WORD)
    got = sorted((r.doc_id, bytes(r.ids)) for r in encoded.collect())
    want = sorted((r.doc_id, np.array(library.encode(r.text or "", add_special_tokens=False).ids, "<u4").tobytes()) for r in docs.collect())
    assert got == want
    decoded = {r.doc_id: r.decoded for r in bpe.decode(encoded, WORD).collect()}
    for r in docs.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        assert decoded[r.doc_id] == library.decode(ids, skip_special_tokens=False)
    assert bpe.encode(nothing, WORD).count() == 0


def test_long_unsplit_words_by_the_tree(spark):
    rnd = random.Random(3)
    texts = [
        "a" * 20000, "".join(rnd.choice("etaoinshrdlu") for _ in range(30000)),
        "é" * 9000 + " end. <|endoftext|>" + "ab" * 7000, "the " + "".join(rnd.choice("thean") for _ in range(9001)) + " x " + "!" * 8500, "1" * 9000,
    ]
    df = spark.createDataFrame([(i % 3, t) for i, t in enumerate(texts)], "doc_id long, text string")
    library = _library(WORD)
    want = sorted((i % 3, np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes()) for i, t in enumerate(texts))
    assert sorted((r.doc_id, bytes(r.ids)) for r in bpe.encode(df, WORD).collect()) == want


@settings(max_examples=200, deadline=None)
@given(st.text("aeinrst", min_size=2, max_size=60), st.integers(1, 59))
def test_a_join_is_the_encoding_of_the_whole(word, cut):
    tree = bpe.tree_for(tokens.vocabulary_text(WORD))
    cut = min(cut, len(word) - 1)
    joined = tree.join(tree.encode(word[:cut], False), tree.encode(word[cut:], True), True)
    assert joined == tree.encode(word, True)


def test_byte_level_decoder(spark):
    library = _library(BYTE)
    text = "Grüße \U0001f600 <|endoftext|> ok"
    ids = library.encode(text, add_special_tokens=False).ids
    df = spark.createDataFrame([(1, bytearray(np.array(ids, "<u4").tobytes())), (2, None)], "doc_id long, ids binary")
    got = {r.doc_id: r.decoded for r in bpe.decode(df, BYTE).collect()}
    assert got == {1: text, 2: ""}


# ---------------------------------------------------------------- pages
PROSE = "A long sentence about the matter at hand, with commas; and more of it, to read. " * 3


def test_article_without_boilerplate():
    page = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head><body>
      <header><h1>Site</h1></header><nav><ul><li><a href="/x">Menu, one. Two, three.</a></li></ul></nav>
      <div class="cookie-notice">We use cookies, as you know, and more. {PROSE}</div><!-- <p>no</p> -->
      <article><header><h1>Title &amp; more</h1></header><p><b>Lead</b>ing &lt;text&gt;<br>{PROSE}<p>{PROSE}&nbsp;end
      <aside>Aside, {PROSE}</aside><ul><li>one<li>two</ul></article>
      <form><input value="x"><label>Mail</label></form><section id="comments"><p>Reader: {PROSE}</p></section>
      <div class="ad banner">Buy. {PROSE}</div><footer>&copy; someone</footer></body></html>"""
    prose = " ".join(PROSE.split())
    assert html_extract.main_text(page) == f"Title & more Leading <text> {prose} {prose} end one two"


def test_content_by_ratio_without_semantic_tags():
    links = "".join(f"<li><a href='/{i}'>Link {i}</a></li>" for i in range(20))
    page = f"<html><body><div><ul>{links}</ul></div><div><h2>Head</h2><p>{PROSE}</p><p>{PROSE}</p><p>Short.</p></div><div><span>tiny</span></div></body></html>"
    prose = " ".join(PROSE.split())
    assert html_extract.main_text(page) == f"Head {prose} {prose} Short."


@pytest.mark.parametrize("top", ["article", "main"])
@pytest.mark.parametrize("name", ["post-comments", "post-share", "sidebar-content", "newsletter-body", "articleComments"])
def test_boilerplate_inside_the_article(top, name):
    page = f'<{top}><h1>Head</h1><p>{PROSE}</p><div class="{name}"><p>Other text, to go. {PROSE}</p></div><ul><li>one</li></ul></{top}>'
    assert html_extract.main_text(page) == f"Head {' '.join(PROSE.split())} one"


def test_ratios_decide_inside_the_article(monkeypatch):
    links = "".join(f'<li><a href="/{i}">Next page {i}</a></li>' for i in range(9))
    page = f'<div class="content-with-sidebar"><article><h1>Head</h1><p>{PROSE}</p><ul>{links}</ul><p>{PROSE}</p><table><tr><td>cell</table><div>by me</div></article></div>'
    prose = " ".join(PROSE.split())
    assert html_extract.main_text(page) == f"Head {prose} {prose} cell"
    monkeypatch.setattr(html_extract, "THRESHOLD", 0.0)
    assert "Next page" in html_extract.main_text(page) and "by me" in html_extract.main_text(page)
    monkeypatch.setattr(html_extract, "THRESHOLD", 1e9)
    assert html_extract.main_text(page) == ""


def test_threshold_matters_on_the_table(spark, monkeypatch):
    pages = [r.html for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()]
    as_is = [html_extract.main_text(p) for p in pages]
    assert all(as_is)
    monkeypatch.setattr(html_extract, "THRESHOLD", 1e9)
    # a page of one path has no deviation to be judged by
    assert sum(not html_extract.main_text(p) for p in pages) > 0.8 * len(pages)


@pytest.mark.parametrize("page, text", [
    ("<div>t " * 100_000, "t" + " t" * 49_999), ("<article>" * 50_000 + "<p>hello there, you" + "<span><li><b>" * 50_000, "hello there, you"),
    ("<ul><li>" * 50_000 + PROSE, " ".join(PROSE.split())), ("<p>" + "<b>" * 100_000 + PROSE, " ".join(PROSE.split())),
])
def test_deep_pages_take_time_in_proportion(page, text):
    import time
    begin = time.process_time()
    assert html_extract.main_text(page) == text
    assert time.process_time() - begin < 5


@pytest.mark.parametrize("page", ["", " ", "<", "<p", "<p>", "</p></div>", "<a href='x", "<script>", "<!--", "<b><i></b></i>", "&", "<html></html>"])
def test_odd_pages_do_not_fail(page):
    assert isinstance(html_extract.main_text(page), str)


def test_extract_frame(spark):
    df = spark.createDataFrame([(1, "u", f"<article><p>{PROSE}</p></article>", "x"), (2, None, None, "x"), (3, "u", "", "x")], "page_id long, url string, html string, text string")
    got = {r.page_id: (r.text, r.n_chars) for r in html_extract.extract(df).collect()}
    text = " ".join(PROSE.split())
    assert got == {1: (text, len(text)), 2: ("", 0), 3: ("", 0)}
    assert html_extract.extract(df.where("page_id > 9")).count() == 0


# ---------------------------------------------------------------- line dedup
def test_patience_alignment():
    assert line_dedup.aligned([1, 2, 3, 9, 4], [7, 1, 2, 3, 8, 4]) == [(0, 1), (1, 2), (2, 3), (4, 5)]
    assert line_dedup.aligned([5, 5, 6, 6, 7], [6, 5, 5, 6, 6]) == [(0, 1), (1, 2), (2, 3), (3, 4)]
    assert line_dedup.aligned([], [1]) == [] and line_dedup.aligned([1], [2]) == []
    assert line_dedup.common_blocks([1, 2, 3], [9, 2, 3], [5, 5, 5], 10) == [1, 2]
    assert line_dedup.common_blocks([1, 2, 3], [9, 2, 3], [5, 5, 5], 11) == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 6), max_size=20), st.lists(st.integers(0, 6), max_size=20))
def test_alignment_is_a_common_subsequence(a, b):
    pairs = line_dedup.aligned(a, b)
    assert all(a[i] == b[j] for i, j in pairs)
    assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))


def test_line_dedup_takes_blocks_out_of_later_documents(spark, nothing):
    passage = "\n".join(" ".join(f"word{i}{j}" for j in range(15)) for i in range(4))
    note = "All rights reserved by the owner."
    rows = [
        (1, f"intro one\n{passage}\n{note}", 1), (2, f"other start here\n{passage}  \nown end of this text\n{note}", 1),
        (3, f"clean text of three\n{note}", 1), (4, f"intro one\n{passage}\n{note}", 1), (5, None, 1), (6, "", 1), (None, passage, 1),
        (3, f"clean text of three\n{note}", 1),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, deleted long")
    out = {(r.doc_id, r.text): r.deleted_lines for r in line_dedup.dedup_lines(df).collect()}
    assert out[(1, rows[0][1])] == []
    assert out[(2, f"other start here\nown end of this text\n{note}")] == [1, 2, 3, 4]
    assert out[(3, rows[2][1])] == [] and out[(4, "")] == [0, 1, 2, 3, 4, 5]
    assert out[(5, None)] == [] and out[(6, "")] == [] and out[(None, passage)] == []
    assert line_dedup.dedup_lines(df).columns == ["doc_id", "text", "deleted", "deleted_lines"]
    assert line_dedup.dedup_lines(nothing).count() == 0


def _shared_blocks(a, b, words, least):
    """Positions in b of consecutive lines with so many words that a holds as consecutive lines: every block looked up."""
    spans = [(x, y) for x in range(len(b)) for y in range(x + 1, len(b) + 1) if sum(words[x:y]) >= least]
    held = {tuple(a[x:y]) for x in range(len(a)) for y in range(x + 1, len(a) + 1)}
    return sorted({j for x, y in spans if tuple(b[x:y]) in held for j in range(x, y)})


def test_line_dedup_matches_brute_force_over_pairs(spark):
    rnd = random.Random(5)
    lines = [" ".join(rnd.choice("abcdefgh") + str(rnd.randint(0, 50)) for _ in range(rnd.randint(1, 25))) for _ in range(25)]
    rows = [(i, "\n".join(rnd.choices(lines, k=rnd.randint(1, 8)))) for i in range(40)]
    texts = [t.split("\n") for _, t in rows]
    want = {}
    for i, mine in enumerate(texts):
        words = [len(x.split()) for x in mine]
        want[i] = sorted({j for other in texts[:i] for j in _shared_blocks(other, mine, words, line_dedup.MIN_WORDS)})
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: list(r.deleted_lines) for r in line_dedup.dedup_lines(df).collect()} == want
    assert any(want.values())


def _pair(rnd):
    """Two documents of passages in any order, some repeated, some with a line changed, between own lines."""
    passages = [[rnd.randrange(10**6) for _ in range(rnd.randint(2, 5))] for _ in range(4)] + [[7, 7, 8], [8, 7, 7]]

    def document():
        out = []
        for _ in range(rnd.randint(1, 6)):
            part = list(rnd.choice(passages))
            if rnd.random() < 0.3:
                part[rnd.randrange(len(part))] = rnd.randrange(10**6)
            out += [rnd.randrange(10**6) for _ in range(rnd.randint(0, 3))] + part
        return out
    return document(), document()


def test_alignments_decide():
    """The alignments by themselves find nearly all blocks; the first finds some, and without them there are none."""
    rnd = random.Random(11)
    first = several = every = 0
    for _ in range(400):
        a, b = _pair(rnd)
        size = {x: rnd.choice((1, 5, 9, 14)) for x in {*a, *b}}
        words = [size[x] for x in b]
        want = _shared_blocks(a, b, words, 20)
        assert line_dedup.repeated(a, b, words, 20) == want
        assert line_dedup.repeated(a, b, words, 20, rounds=0) == []
        once, more = (set(line_dedup.repeated(a, b, words, 20, rounds=n)) for n in (1, line_dedup.ROUNDS - 1))
        assert once <= more <= set(want)
        first, several, every = first + len(once), several + len(more), every + len(want)
    assert every > 1000 and 0.5 * every < first < several and several > 0.97 * every


@pytest.mark.parametrize("make", [
    lambda n: ([0, 1, 2] * (n // 3), [2, 1, 0] * (n // 3)), lambda n: ([0, 1, 2] * (n // 3), [0, 1, 2, 2] * (n // 4)),
    lambda n: ([0, 1, 2] * (n // 3), random.Random(1).choices([0, 1, 2], k=n)), lambda n: (list(range(n)), list(range(n))[::-1]),
    lambda n: (random.Random(2).choices([0, 1, 2], k=n), random.Random(3).choices([0, 1, 2], k=n)),
])
def test_long_documents_of_few_lines(make):
    """Thousands of repeated lines take seconds at most, and lose what brute force says on a short piece."""
    import time
    for n, words in ((20_000, 7), (20_000, 25), (60, 7)):
        a, b = make(n)
        begin = time.process_time()
        got = line_dedup.repeated(a, b, [words] * len(b), 20)
        assert time.process_time() - begin < 2
    assert got == _shared_blocks(a, b, [7] * len(b), 20)


def test_line_dedup_finds_a_block_whose_lines_were_first_seen_apart(spark):
    block = [" ".join(f"part{i}of{j}" for j in range(6)) for i in range(4)] + ["so", "it ends"]
    rows = [(i, f"start of text {i}\n{x}\nend of text {i}") for i, x in enumerate(block)]
    rows += [(8, "eight\n" + "\n".join(block)), (9, "nine\n" + "\n".join(block) + "\nown end")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.deleted_lines for r in line_dedup.dedup_lines(df).collect() if r.deleted_lines}
    assert got == {9: [1, 2, 3, 4, 5, 6]}


def test_line_dedup_finds_blocks_in_another_order_or_more_often(spark):
    p, q = ("\n".join(" ".join(f"{name}{i}of{j}" for j in range(12)) for i in range(2)) for name in "pq")
    small = [f"small line {i}" for i in range(9)]
    rows = [
        (1, f"one\n{p}\n{q}"), (2, f"two\n{q}\n{p}\nend of two"), (3, f"{p}\nthree\n{p}"),
        (4, "\nnot five\n".join([*small, p])), (5, "\nown\n".join([p, *small])),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.deleted_lines for r in line_dedup.dedup_lines(df).collect()}
    assert got == {1: [], 2: [1, 2, 3, 4], 3: [0, 1, 3, 4], 4: [18, 19], 5: [0, 1]}


def test_line_dedup_matches_brute_force_over_all_blocks(spark):
    rnd = random.Random(8)
    lines = ["", "", *(" ".join(rnd.choice("abcdefgh") + str(rnd.randint(0, 50)) for _ in range(rnd.choice((1, 2, 4, 9, 14, 22)))) for _ in range(12))]
    rows = [(i, "\n".join(rnd.choices(lines, k=rnd.randint(1, 14)))) for i in range(80)]
    held, want = set(), {}
    for i, t in rows:
        mine = t.split("\n")
        blocks = [(a, b) for a in range(len(mine)) for b in range(a + 1, len(mine) + 1) if len(" ".join(mine[a:b]).split()) >= line_dedup.MIN_WORDS]
        want[i] = sorted({j for a, b in blocks if tuple(mine[a:b]) in held for j in range(a, b)})
        held |= {tuple(mine[a:b]) for a, b in blocks}
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: list(r.deleted_lines) for r in line_dedup.dedup_lines(df).collect()} == want
    assert any(want.values())


# ---------------------------------------------------------------- chats
@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.text(max_size=8), st.text(max_size=20) | st.sampled_from([PLANTED_TURN, "</turn>\n### x", "\\h\\"])), min_size=1, max_size=5))
def test_formatting_round_trip(pairs):
    pairs = [tuple(x.encode("utf-8", "replace").decode() for x in p) for p in pairs]
    roles, texts = (pa.array(x, pa.string()) for x in zip(*pairs))
    data, *_ = chat_format.assemble(roles, texts)
    text = data.tobytes().decode()
    assert chat_format.read_turns(text) == pairs
    assert text.count("</turn>") == len(pairs) and text.count("###") == len(pairs)


def test_format_chats_orders_masks_and_survives_nulls(spark):
    rows = [(1, 2, "assistant", "two"), (1, 0, "user", "a # b"), (1, 1, "assistant", "<é>"), (2, 0, None, None),
            (None, 0, "assistant", "n"), (3, 1, "user", "same"), (3, 1, "user", "same"), (4, None, "user", "x"), (4, 0, "assistant", "")]
    df = spark.createDataFrame([r + ("x",) for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    got = {r.conv_id: r for r in chat_format.format_chats(df).collect()}
    assert chat_format.read_turns(got[1].formatted) == [("user", "a # b"), ("assistant", "<é>"), ("assistant", "two")]
    assert chat_format.read_loss(got[1].formatted, got[1].loss_start, got[1].loss_end) == ["<é>", "two"]
    assert chat_format.read_turns(got[2].formatted) == [("", "")]
    assert chat_format.read_loss(got[None].formatted, got[None].loss_start, got[None].loss_end) == ["n"]
    assert len(chat_format.read_turns(got[3].formatted)) == 2
    assert chat_format.read_turns(got[4].formatted)[0] == ("user", "x")
    assert chat_format.format_chats(df.where("conv_id > 99")).count() == 0


# ---------------------------------------------------------------- SQL twins
@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_its_sql(spark, name):
    import duckdb

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "conversations", "pages", "embeddings", "labels", "benchmark"):
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    df = QUERIES[name](spark, sf)
    want = con.sql(ORACLE_SQL[name])
    assert sorted(df.columns) == sorted(want.columns)
    key = lambda rows: sorted(json.dumps(list(r), default=str) for r in rows)
    columns = sorted(df.columns)
    assert key(df.select(columns).collect()) == key(want.select(*columns).fetchall())
