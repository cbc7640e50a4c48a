"""Operators that judge rows on their own: quality rules, page text, URLs, token files."""

import re
import zlib

import numpy as np
import pytest

from gaugeworks.llm import extraction, quality, token_files, urls
from tests.llm.helpers import SF, table, words

DOCS = "doc_id long, text string, n_words string, codes int, source string, lang string"
CLEAN = " ".join(["the house of the river was found by all of them and it is for us"] + [f"word{i}" for i in range(20)])


def test_quality_measures(spark):
    run = "a b c d e f g h"
    rows = [
        (1, CLEAN), (2, None), (3, ""), (4, " \n\t "), (5, f"{run} {run} x y z w"), (6, "x " * 40), (None, CLEAN), (1, CLEAN),
        (7, "one two\n\none two\none three\n \n"), (8, "a|b <c> 100% é&ü"),
    ]
    docs = spark.createDataFrame([(d, t, "clash", 1, None, None) for d, t in rows], DOCS)
    got = quality.judge(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        text = next(t for d, t in rows if d == r.doc_id)
        w = words(text)
        assert r.n_words == len(w) and r.word_chars == sum(map(len, w))
        assert r.n_symbols == len(re.findall(r"[#*$%&|<>]", text or ""))
        lines = [x for x in (text or "").split("\n") if words(x)]
        assert r.n_dup_lines == len(lines) - len(set(lines))
        runs = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
        inside = {j for i, x in enumerate(runs) if runs.count(x) > 1 for j in range(i, i + 8)}
        assert r.n_repeat_words == len(inside)
        assert r.base_failed == (len(w) < 20 or 100 * len(inside) > 30 * len(w))
        assert not (r.base_failed and r.kept)
    assert sum(r.kept for r in got) == 3
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()].count(1) == 2
    assert quality.judge(docs.limit(0)).collect() == []


def test_quality_is_one_projection(spark):
    plan = quality.query(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Exchange|Python|Arrow|Join", plan)


def test_main_text_of_given_pages(spark):
    import html as H

    got = {r.page_id: r for r in extraction.query(spark, SF).collect()}
    for page, url, html in table("pages", "page_id, url, html"):
        inner = re.search(r"<article>(.*?)(</article>|$)", html, re.S)[1]
        want = " ".join(H.unescape(re.sub(r"<(/?)(p|h1|br|b)>", lambda m: " " if m[2] != "b" else "", inner)).split())
        assert got[page].text == want and got[page].n_chars == len(want) and got[page].url == url


def test_main_text_held_out_accuracy():
    model = extraction.trained()
    pages = extraction.labelled_pages(150, 4711)
    pairs = [(x, y) for _, blocks, labels in pages for x, y in zip(extraction.decode(model, blocks), labels)]
    assert len(pages) > 140 and sum(x == y for x, y in pairs) / len(pairs) > 0.98


def test_main_text_edges(spark):
    page = (
        "<html><head><title>T</title><body><header><a href=/>Home</a></header><article><h1>A &lt;b&gt;</h1><p>First  fine\n sentence, here.<br>And more."
        "<div class='ad'>Buy now!</div><p>Last &amp; final words of it.</p><section id=comments><h2>Comments</h2><p>Nice post, thanks.</p></section>"
        "<form><input>Your mail</form></article><aside>Other things</aside><footer>&copy; 2020</footer><scr"
    )
    rows = [(1, None, page), (2, "u", None), (3, "u", ""), (None, "u", "<nav><a href=x>Menu</a></nav>"), (3, "u", "")]
    pages = spark.createDataFrame([(p, u, h, "x") for p, u, h in rows], "page_id long, url string, html string, text string")
    got = extraction.extract(pages).collect()
    assert got[0].text == "A <b> First fine sentence, here. And more. Last & final words of it."
    assert [r.text for r in got[1:]] == [""] * 4 and got[1].n_chars == 0
    assert extraction.extract(pages.limit(0)).collect() == []


@pytest.mark.parametrize("blocks", [1, 2, 5])
def test_viterbi_is_the_best_path(blocks):
    from itertools import product

    model = extraction.trained()
    for _, found, _ in extraction.labelled_pages(20, 5):
        found = found[:blocks]
        score = [sum((model.weights.get(f, np.zeros(2)) for f in fs), np.zeros(2)) for fs in extraction.features(found)]

        def value(path):
            return model.start[path[0]] + sum(s[y] for s, y in zip(score, path)) + sum(model.change[a, b] for a, b in zip(path, path[1:]))

        best = max(product((0, 1), repeat=len(found)), key=value)
        assert value(extraction.decode(model, found)) == pytest.approx(value(best))


def test_url_rules_and_aliases(spark):
    link = '<html><head><link href="{}" rel=canonical></head>'
    rows = [
        (1, "https://a.example.org/es/1", None), (2, "http://EXAMPLE.org/en/17?x#y", None), (3, "http://example.org/en/2", None), (4, "http://x.com/de/1", None),
        (5, "http://x.com/fr/1", None), (6, "http://x.net/q", link.format("http://x.com/de/1")), (7, "http://y.net/q#top", link.format("/r?utm_source=f")),
        (8, "http://y.net/r", '<META http-equiv="Refresh" content="0; URL=http://x.net/q">'), (9, "http://z.net/", link.format("http://x.net/q")),
        (10, "http://z.net/", link.format("http://z.org/")), (11, None, link.format("http://x.com/de/1")), (12, "nothing", ""), (None, "http://x.com/de/1", None),
        (13, "http://other.net", None), (14, "http://notexample.org/es/1", None), (15, "http://w.net/a/b", link.format("c")), (16, "http://w.net/a/c", link.format("http://x.com/de/9")),
    ]
    pages = spark.createDataFrame([(p, u, h, "k") for p, u, h in rows], "page_id long, url string, html string, key string")
    got = {r.page_id: r for r in urls.judge(pages).collect()}
    assert (got[1].rule, got[1].verdict) == ("example.org/es/", "block") and got[1].host == "a.example.org"
    assert (got[2].rule, got[2].verdict, got[2].path) == ("example.org/en/1", "block", "/en/17")
    assert (got[3].rule, got[3].verdict) == ("org/", "allow")
    assert got[4].verdict == "block" and got[5].rule == "com/fr/"
    # 6, 7, 8, 9 and 10 are one group with a block and, by z.org, an explicit allow.
    assert [got[i].verdict for i in (6, 7, 8, 9, 10)] == ["allow"] * 5 and got[6].rule is None
    assert (got[11].host, got[11].path, got[11].rule, got[11].verdict) == ("", "", None, "allow")
    assert got[12].host == "" and got[13].verdict == "allow" and got[14].rule == "org/" and got[None].verdict == "block"
    assert got[15].verdict == got[16].verdict == "block"
    assert urls.judge(pages.limit(0)).collect() == []
    assert urls.judge(pages, spark.createDataFrame([], urls.RULE_SCHEMA)).filter("verdict = 'allow'").count() == len(rows)


def test_url_redirect_and_canonical_of_one_page(spark):
    html = '<meta http-equiv="refresh" content="0; url={}"><link rel="canonical" href="{}">'
    rows = [
        (1, "http://a.net/x", html.format("http://a.net/x", "http://example.org/es/1")),
        (2, "http://b.net/x", html.format("http://c.net/x", "http://example.org/es/2")),
        (3, "http://c.net/x", ""), (4, "http://d.net/x", html.format("", "")), (5, "http://e.net/x", None),
    ]
    got = {r.page_id: r.verdict for r in urls.judge(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {1: "block", 2: "block", 3: "block", 4: "allow", 5: "allow"}


def test_token_files_round_trip(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(token_files.default_tokenizer())
    odd = ["a  b\n\n c ", "q\r\n\tz  ", "the  x　y \n z", "it's\x1cwe'll 's\x00 \x00", "<|endoftext|> x", "ab\n", " lead", "  x \u0085y", "w " * 5000]
    rows = [(9, x) for x in odd] + [(None, "x"), (1, None), (1, "é  b"), (1, ""), (9, odd[0]), (-4, "neg")] + table("documents", "doc_id + 100, text")
    docs = spark.createDataFrame([(d, t, 5) for d, t in rows], "doc_id long, text string, pos long")
    got = token_files.write_and_index(docs).orderBy("start").collect()
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    start = 0
    for r, (d, text) in zip(got, rows, strict=True):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        assert (r.doc_id, r.n_tokens, r.ids_crc32) == (d, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())), text
        assert r.start == start
        start += len(ids)
    assert token_files.write_and_index(docs.limit(0)).collect() == []


def test_token_files_look_up(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"text number {i}") for i in range(500)], "doc_id long, text string")
    token_files.write_tokens(docs, str(tmp_path / "t"))
    rows = token_files.read_tokens(spark, str(tmp_path / "t"), [3, 499, 1000])
    assert sorted(r.doc_id for r in rows.collect()) == [3, 499]
    assert "PushedFilters: [In(doc_id" in rows._jdf.queryExecution().executedPlan().toString()
