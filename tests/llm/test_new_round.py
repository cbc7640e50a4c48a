"""Phrases, byte-pair encoding by last tokens, periodic runs, ties in the mix, and executors without the package."""

import hashlib
import os
import random
import re
import subprocess
import sys
import textwrap
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from gaugeworks.llm import extraction, jaccard, mixing, periodic, phrases, prefix_bpe, urls
from tests.llm.helpers import SF, plain, table, words

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


# --- phrases


def collocations(rows, least, most=3, top=2000, percent=50):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        totals[lang] += 0
        for piece in re.split("[.,;:!?\n-\r]", low):
            w = re.findall("[^ \t]+", piece)
            totals[lang] += len(w)
            counts.update((lang, tuple(w[i : i + k])) for k in range(1, most + 1) for i in range(len(w) - k + 1))
    cands = {p: n for p, n in counts.items() if len(p[1]) > 1 and n >= least}
    out = []
    for lang in totals:
        rows = []
        for (of, p), a in cands.items():
            if of != lang:
                continue
            score, _, l, r = min((10**6 * a * a // (counts[of, p[:k]] * counts[of, p[k:]]), k, counts[of, p[:k]], counts[of, p[k:]]) for k in range(1, len(p)))
            if any(o == of and len(q) > len(p) and 100 * n >= percent * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) for (o, q), n in cands.items()):
                continue
            rows.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (s, a, p, l, r) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, totals[lang], -s))
    return sorted(out, key=str)


EDGE_TEXTS = [
    ("en", "New York city, new york CITY! new york city"), ("en", None), (None, ""), (None, "a b a b a b\ta b"), ("en", "x\x0bnew york"), ("fr", "É é É é é"), ("fr", "new york new york"), ("xx", "  ... "),
    ("en", "new  york\tcity of new york. york city " * 3), (None, "A B c " * 4), ("en", "very" + "long" * 3000 + " word " + "very" + "long" * 3000 + " word"),
]


@pytest.mark.parametrize("least,most,block,buckets", [(2, 3, 250_000, None), (1, 4, 7, 8), (3, 2, 3, 64), (2, 3, 5, 1 << 20)])
def test_phrases_against_counting(spark, least, most, block, buckets):
    rng = random.Random(2)
    rows = EDGE_TEXTS + [(rng.choice(["en", "fr", None]), " ".join(rng.choices(["red", "Green", "blue.", "sky;", "a", "b", "é"], k=rng.randint(0, 30)))) for _ in range(40)]
    docs = spark.createDataFrame([(lang, text, "p", 1) for lang, text in rows], "lang string, text string, phrase string, `idx.f` int").repartition(3)
    got = phrases.collocations(docs, least=least, most=most, block=block, buckets=buckets)
    assert plain(got) == collocations(rows, least, most)
    top = phrases.collocations(docs, least=least, most=most, block=block, buckets=buckets, top=2)
    assert plain(top) == collocations(rows, least, most, top=2)


def test_phrases_of_nothing(spark):
    docs = spark.createDataFrame([("en", None), (None, "one two three")], "lang string, text string")
    assert phrases.collocations(docs).collect() == [] and phrases.collocations(docs.limit(0)).collect() == []


def test_trie_counts_like_a_dictionary():
    rng = np.random.default_rng(7)
    for trial in range(30):
        n_words = int(rng.choice([3, 40, 300, 70_000]))
        codes = np.sort(rng.choice(2**62, n_words, replace=False).astype(np.uint64))
        held = list({tuple(rng.integers(0, min(n_words, 50), rng.integers(1, 5)).tolist()) for _ in range(int(rng.integers(1, 400)))})
        held += [(i,) for i in range(50, n_words, max(1, n_words // 500))]
        trie = phrases.Trie.unpacked(phrases.Trie.of(np.concatenate([codes[list(p)] for p in held]), np.array([len(p) for p in held])).packed())
        text = rng.integers(0, min(n_words, 60), 3000)
        link = rng.random(3000) < 0.9
        link[-1] = False
        counts = np.zeros(len(held), np.int64)
        trie.count(np.concatenate([codes[text[:-5]], rng.choice(2**62, 5).astype(np.uint64)]), link, counts)
        want = Counter()
        for i in range(2995):
            for k in range(1, 5):
                if i + k <= 2995 and (k == 1 or link[i : i + k - 1].all()):
                    want[tuple(text[i : i + k].tolist())] += 1
        assert [want[p] for p in held] == counts.tolist()


# --- byte-pair encoding


@pytest.fixture(scope="module")
def tiktoken_encoding():
    import public_tokenizers
    import tiktoken

    ranks = prefix_bpe.read_ranks(prefix_bpe.default_tokenizer())
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return prefix_bpe.Encoder(prefix_bpe.read_ranks(prefix_bpe.default_tokenizer()), prefix_bpe.default_pattern())


def random_texts(n, seed=3):
    rng = random.Random(seed)
    letters = list("ab'slrevemdtZ  \n\t.,12é　\xa0\x85\x1c日本𝄞")
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def ids_of(encoder, texts):
    return [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)]


def test_encoding_is_the_library_s(encoder, tiktoken_encoding):
    texts = random_texts(3000) + [t or "" for (t,) in table("documents", "text")] + ["", " ", "x" * 5000, "<|endoftext|> it's we'll 's", "é" * 300 + " b"]
    assert ids_of(encoder, texts) == [tiktoken_encoding.encode_ordinary(t) for t in texts]


def test_encoding_with_little_memory(tiktoken_encoding, monkeypatch):
    monkeypatch.setattr(prefix_bpe, "HELD", 50)
    monkeypatch.setattr(prefix_bpe, "PAIRS", 300)
    monkeypatch.setattr(prefix_bpe, "TOGETHER", 5)
    small = prefix_bpe.Encoder(prefix_bpe.read_ranks(prefix_bpe.default_tokenizer()), prefix_bpe.default_pattern())
    texts = random_texts(300, 8) + [t or "" for (t,) in table("documents", "left(text, 300)")]
    got = [ids for i in range(0, len(texts), 7) for ids in ids_of(small, texts[i : i + 7])]
    assert got == [tiktoken_encoding.encode_ordinary(t) for t in texts]


def test_ranks_that_merge_out_of_order():
    """Tokens made in another order than their ranks say, and one that merging never makes."""
    import tiktoken

    rng = random.Random(4)
    for trial in range(40):
        tokens = [bytes([b]) for b in b"abc"] + list({bytes(rng.choices(b"abc", k=rng.randint(2, 5))) for _ in range(rng.randint(1, 14))})
        rest = [bytes([b]) for b in range(256) if bytes([b]) not in tokens]
        ranks = {t: i for i, t in enumerate([*tokens[:3], *rest, *rng.sample(tokens[3:], len(tokens) - 3)])}
        own = prefix_bpe.Encoder(ranks, r"\p{L}+|\P{L}+")
        library = tiktoken.Encoding("own", pat_str=r"\p{L}+|\P{L}+", mergeable_ranks=ranks, special_tokens={})
        texts = ["".join(rng.choices("abc", k=rng.randint(0, 30))) for _ in range(60)]
        assert ids_of(own, texts) == [library.encode_ordinary(t) for t in texts]


def test_appends_and_edits(encoder, tiktoken_encoding):
    rng = random.Random(6)
    texts, tails = random_texts(400, 1), random_texts(400, 2)
    for text, tail in zip(texts, tails):
        assert encoder.append_ids(text, tiktoken_encoding.encode_ordinary(text), tail) == tiktoken_encoding.encode_ordinary(text + tail)
    made = []
    for _ in range(300):
        x = bytes(rng.choices(b"abcdefghilmnorstu", k=rng.randint(0, 200)))
        i = rng.randint(0, len(x))
        j, y = rng.randint(i, min(len(x), i + 4)), bytes(rng.choices(b"abcxyz", k=rng.randint(0, 4)))
        p = prefix_bpe.Prefix(encoder.vocabulary, x)
        made.append((p.edit(i, j, y), len(p.data) - i))
        q = prefix_bpe.Prefix(encoder.vocabulary)
        q.append(x[:i])
        q.append(y + x[j:])
        assert p.data == q.data and p.last == q.last and p.ids() == encoder.vocabulary.merged(p.data)
    assert sum(m for m, _ in made) < sum(n for _, n in made)


def test_encode_append_decode_tables(spark, tiktoken_encoding):
    rows = [(1, "It's a test\n of  it", " and more"), (None, None, "x"), (1, "", None), (2, "é日", "本"), (1, "It's a test\n of  it", " and more")]
    docs = spark.createDataFrame([(d, t, s, 1) for d, t, s in rows], "doc_id long, text string, tail string, `a.b` int")
    coded = prefix_bpe.encode(docs)
    assert plain(coded) == sorted([(d, tiktoken_encoding.encode_ordinary(t or "")) for d, t, _ in rows], key=str)
    assert plain(prefix_bpe.decode(coded)) == sorted([(d, bytearray((t or "").encode())) for d, t, _ in rows], key=str)
    longer = spark.createDataFrame([(d, t, tiktoken_encoding.encode_ordinary(t or ""), s) for d, t, s in rows], "doc_id long, text string, ids array<int>, tail string")
    assert plain(prefix_bpe.append(longer)) == sorted([(d, tiktoken_encoding.encode_ordinary((t or "") + (s or ""))) for d, t, s in rows], key=str)
    assert prefix_bpe.encode(docs.limit(0)).collect() == [] and prefix_bpe.decode(coded.limit(0)).collect() == []


def test_ids_are_decoded_in_bounded_batches(monkeypatch):
    path, sizes = prefix_bpe.default_tokenizer(), [3, 0, 5, 2, 2, 9, 1]
    monkeypatch.setattr(prefix_bpe, "BATCH_IDS", 5)
    ids = pa.array([list(range(97, 97 + n)) for n in sizes] + [None], pa.list_(pa.int32()))
    batch = pa.RecordBatch.from_arrays([pa.array(range(8), pa.int64()), ids], ["doc_id", "ids"])
    got = list(prefix_bpe.decode_rows(path)(iter([batch])))
    assert [len(b) for b in got] == [2, 1, 2, 1, 2]
    tokens = {rank: token for token, rank in prefix_bpe.read_ranks(path).items()}
    want = [b"".join(map(tokens.__getitem__, row or [])) for row in ids.to_pylist()]
    assert [x for b in got for x in b.column("bytes").to_pylist()] == want
    digests = [r for b in prefix_bpe.digest_rows(path)(iter([batch.slice(0, 7)])) for r in b.to_pylist()]
    assert [r["n_tokens"] for r in digests] == sizes and [r["decoded_sha256"] for r in digests] == [hashlib.sha256(x).hexdigest() for x in want[:7]]
    assert [r["ids_sha256"] for r in digests] == [hashlib.sha256(",".join(map(str, row)).encode()).hexdigest() for row in ids.to_pylist()[:7]]


def test_one_worker_encodes_and_decodes(spark):
    plan = prefix_bpe.query(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall("MapInArrow", plan)) == 1


def test_prefix_bpe_query(spark, tiktoken_encoding):
    got = {r.doc_id: tuple(r)[1:] for r in prefix_bpe.query(spark, SF).collect()}
    want = {}
    for d, text in table("documents", "doc_id, text"):
        ids = tiktoken_encoding.encode_ordinary(text or "")
        want[d] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())
    assert got == want


# --- periodic runs


def runs_of(w, least=12):
    """All runs by comparing words at every distance; the smallest period of a stretch counts."""
    n, out = len(w), {}
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and w[j] == w[j + p]:
                j += 1
            if j + p - i >= max(least, 2 * p):
                out.setdefault((i, j + p), p)
            i = j + 1
    return sorted((s, e - s, p) for (s, e), p in out.items())


def dense(w):
    index = {}
    return np.array([index.setdefault(x, len(index)) for x in w], np.int64)


@pytest.mark.parametrize("least", [12, 2, 5])
def test_runs_against_every_distance(least):
    rng = random.Random(least)
    for trial in range(60):
        texts = []
        for _ in range(rng.randint(1, 6)):
            kind, n = rng.random(), rng.choice([0, 1, 5, 12, 30, 100, 300])
            if kind < 0.3:
                w = [rng.randint(0, rng.choice([0, 1, 2, 5, 50])) for _ in range(n)]
            elif kind < 0.6:
                passage = [rng.randint(0, 9) for _ in range(rng.randint(1, max(1, n // 3)))]
                w = (passage * (n // len(passage) + 1))[:n]
                for _ in range(rng.randint(0, 3) if n else 0):
                    w[rng.randrange(n)] = rng.randint(0, 9)
            elif kind < 0.8:
                a, w = [0], [0, 1]
                while len(w) < n:
                    a, w = w, w + a
                w = w[:n]
            else:
                w = [x for _ in range(n // 8) for x in [rng.randint(0, 3)] * rng.randint(1, 20)]
            texts.append(w)
        got = list(zip(*(x.tolist() for x in periodic.runs_of([dense(w) for w in texts], least))))
        assert got == [(i, *r) for i, w in enumerate(texts) for r in sorted(runs_of(w, least), key=lambda r: (r[0], r[2]))]


def test_transforms_are_exact():
    rng = np.random.default_rng(1)
    for p, generator in periodic.PRIMES:
        x = rng.integers(0, p, (3, 64)).astype(np.uint64)
        assert (periodic.untransform(periodic.transform(x, p, periodic.twiddles(p, generator, 64)), p, generator) == x).all()
    for most in (2, 1000, 10**8):  # one, two and three primes
        blocks, windows = rng.integers(0, most, (20, 5)).astype(np.uint64), rng.integers(0, most, (20, 13)).astype(np.uint64)
        windows[::2, 3:8] = blocks[::2]
        want = [[(windows[r, o : o + 5] == blocks[r]).all() for o in range(9)] for r in range(20)]
        assert periodic.zero_distances(blocks, windows, 5 * most * most).tolist() == want


def test_one_word_and_long_passages_in_linear_time():
    n = 30_000
    assert [x.tolist() for x in periodic.runs_of([np.zeros(n, np.int64)])] == [[0], [0], [n], [1]]
    assert [x.tolist() for x in periodic.runs_of([np.arange(n) % 7001])] == [[0], [0], [n], [7001]]


def collapsed(w, runs):
    keep = [True] * len(w)
    for s, n, p in runs:
        keep[s + p : s + n] = [False] * (n - p)
    return " ".join(x for x, k in zip(w, keep) if k)


def test_periodic_edges(spark):
    rows = [(1, "a b c " * 4), (None, None), (2, ""), (2, " \n"), (1, "a b c " * 4), (3, "x " * 13 + "é é " * 20), (None, "la " * 30), (4, "w")]
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, runs int")
    want = [(d, len(words(t)), [tuple(r) for r in runs_of(words(t))], collapsed(words(t), runs_of(words(t)))) for d, t in rows]
    got = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic.detect(docs).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert periodic.detect(docs.limit(0)).collect() == []


def test_periodic_query(spark):
    got = {r.doc_id: tuple(r) for r in periodic.query(spark, SF).collect()}
    planted = 0
    for d, text in table("documents", "doc_id, text"):
        w = words(text)
        h, n = zlib.crc32(str(d).encode()), len(w)
        g = h // 10
        if h % 10 == 0 and n:
            planted += 1
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        if n > 2500:
            continue
        runs = sorted(runs_of(w), key=lambda r: (r[0], r[2]))
        s, length, p = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
        lines = "".join(f"{x},{y},{z}\n" for x, y, z in runs)
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, collapsed(w, runs))]
        assert got[d] == (d, len(runs), s, length, p, 1000 * length // p if runs else None, *digests)
    assert planted > 5


# --- ties in the mix


def test_mix_cuts_between_rows_alike(spark):
    rows = [(None, "a", 10, 5)] * 1000 + [(i, "b", 10, i) for i in range(1000)] + [(7, None, 10, 1)] * 300
    sized = spark.createDataFrame(rows, "doc_id long, source string, size long, mark long").repartition(5)
    got = mixing.mix(sized).collect()
    assert len(got) == len(rows)
    for source in ("a", "b", None):
        own = [r for r in got if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 10 and all(r.taken <= 30 for r in own)
    assert plain(mixing.mix(sized.repartition(9))) == sorted(map(tuple, got), key=str)


def test_mixed_rows_alike_and_dotted_names(spark):
    rows = [(None, "one two three", "a", 1)] * 200 + [(i, f"one two {i}", "b", i) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, `a.b` int").repartition(4)
    got = mixing.mixed(docs)
    assert got.columns == docs.columns
    taken = Counter(r.source for r in got.collect())
    target = {r.source: r.target / 3 for r in mixing.mix(mixing.sizes(docs)).collect()}
    assert all(abs(taken[s] - target[s]) <= 1 for s in target)
    assert mixing.mixed(docs.limit(0)).collect() == []


# --- clashing names, and pages with layout names around the article


def test_one_of_each_with_clashing_names(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, text, "x", 1), (1, text, "x", 1), (None, text, "y", 2), (2, "other words here", "z", 3), (2, "other words here", "z", 3), (3, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept_id string, `a.b` int").withColumnsRenamed({}).selectExpr("*", "kept_id AS row", "`a.b` AS copies")
    got = jaccard.one_of_each(docs, ngram=5, percent=80)
    assert got.columns == docs.columns and sorted(str(r.doc_id) for r in got.collect()) == ["1", "2", "3"]


FIRST = "The river rose by two metres during the night and the town closed its old bridge. People were told to stay at home."
SECOND = "Nobody was hurt, the mayor said in the morning, but the school will stay closed until Monday."
NAV = "<nav><ul><li><a href=/>Home</a></li><li><a href=/a>About us</a></li></ul></nav>"
FOOT = "<footer>&copy; 2024 Town News. All rights reserved.</footer>"
BODY = f"<h1>Flood in town</h1><p>{FIRST}</p><p>{SECOND}</p>"


@pytest.mark.parametrize(
    "page",
    [
        f'<html><body><form id="aspnetForm" method="post"><input type=hidden>{NAV}<div class="content">{BODY}</div>{FOOT}</form></body></html>',
        f'<html><body><form method="post">{NAV}<article>{BODY}</article>{FOOT}</form></body></html>',
        f'<html><body class="has-sidebar no-comments">{NAV}<article>{BODY}</article>{FOOT}</body></html>',
        f'<html><body><div class="page-with-header-nav">{NAV}<main>{BODY}</main>{FOOT}</div></body></html>',
        f'<html><body><div class="layout sidebar-left"><div class="post-content">{BODY}</div><div class="sidebar"><h3>More</h3><p>Read our other news here.</p></div></div></body></html>',
    ],
)
def test_article_in_a_wrapper(page):
    assert extraction.main_text(extraction.trained(), page) == f"Flood in town {FIRST} {SECOND}"


def test_plain_elements_and_marks():
    model = extraction.trained()
    assert extraction.main_text(model, f"<html><body><div>{FIRST}</div><div>{SECOND}</div></body></html>") == f"{FIRST} {SECOND}"
    page = f"<html><body><div><a href=/>Home</a> <a href=/a>About</a></div><div><div>{FIRST}</div><div>{SECOND}</div></div><div>&copy; 2024 Town News</div></body></html>"
    assert extraction.main_text(model, page) == f"{FIRST} {SECOND}"
    marked = f"{FIRST} The sign reads © Town Hall 1931 and is still there. {SECOND}"
    assert extraction.main_text(model, f"<html><body><article><p>{marked}</p></article></body></html>") == marked
    comments = f'<section class="comments"><h2>Comments</h2><article><p>{SECOND} {FIRST} {SECOND}</p></article><article><p>{FIRST} {FIRST}</p></article></section>'
    assert extraction.main_text(model, f"<html><body><article>{BODY}</article>{comments}</body></html>") == f"Flood in town {FIRST} {SECOND}"


def test_links_as_a_browser_reads_them(spark):
    bad = "http://example.org/es/1"
    rows = [
        (1, "http://a.net/1", f'<link rel="alternate canonical" href="{bad}">'),
        (2, "http://a.net/2", f'<!-- <link rel="canonical" href="{bad}"> --><p>canonical</p>'),
        (3, "http://a.net/3", f"<script>var x = '<link rel=canonical href={bad}>'</script>"),
        (4, "http://a.net/4", '<base href="http://example.org/es/"><link href="2" rel=CANONICAL>'),
        (5, "http://a.net/5", '<link rel="canonical" href="http&#58;//example.org&#x2F;es/3">'),
        (6, "http://a.net/6", """<meta content="3 ; URL='http://example.org/es/4'" http-equiv=' refresh '>"""),
        (7, "http://a.net/7", f'<link rel="canonical-not" href="{bad}"><link rel="canonical"><link rel="canonical" href="http://example.org/es/5"><link rel=canonical href="http://ok.org/">'),
        (8, "http://a.net/8", '<meta http-equiv="refresh" content="30">'), (9, "http://a.net/9", None),
    ]
    got = {r.page_id: r.verdict for r in urls.judge(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {1: "block", 2: "allow", 3: "allow", 4: "block", 5: "block", 6: "block", 7: "block", 8: "allow", 9: "allow"}


# --- executors that lack the package


def test_workers_without_the_package(tmp_path):
    """A fresh session in another folder: only the driver's process knows where the package is."""
    script = tmp_path / "run.py"
    script.write_text(textwrap.dedent(f"""
        import sys
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").config("spark.sql.session.timeZone", "UTC").getOrCreate()
        spark.sparkContext.setLogLevel("OFF")
        sys.path.insert(0, {REPO!r})
        import __spark_entry__ as entry
        queries = entry.queries()
        for name, query in queries.items():
            if name in ("op4_ngram_jaccard", "op7_token_files", "op8_decontaminate", "op10_substring_dedup", "op11_phrase_collocations", "op12_prefix_bpe", "op13_periodic_runs", "pipeline"):
                print("RAN", name, query(spark, {SF!r}).count())
        """))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert out.stdout.count("RAN") == 8, out.stdout + out.stderr[-3000:]


def test_one_thousand_rows_of_arrow_lists_round_trip():
    coded = [np.arange(n, dtype="<u4").tobytes() for n in (0, 3, 0, 1)]
    assert prefix_bpe.id_arrays(coded).to_pylist() == [[], [0, 1, 2], [], [0]] and prefix_bpe.id_arrays([]).type == pa.list_(pa.int32())
