"""Fuzzy matching against a plain all-pairs computation on a small fixture."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from gaugeworks.operators import candidates as C
from gaugeworks.operators import matching as M


def grams(text):
    out = []
    for word in text.split():
        w = f" {word} "
        for n in (3, 4, 5):
            out += [w[i : i + n] for i in range(max(1, len(w) - n + 1))] if n == 3 or len(w) >= n else []
    return out


def words(text):
    found = re.findall(r"\w+", text)
    return found + [" ".join(p) for p in zip(found, found[1:])]


def lcs(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


def ratio(a, b):
    return 1.0 if not a and not b else 2 * lcs(a, b) / (len(a) + len(b))


def token_set(a, b):
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    shared = " ".join(sorted(x & y))
    left = " ".join(filter(None, [shared, " ".join(sorted(x - y))]))
    right = " ".join(filter(None, [shared, " ".join(sorted(y - x))]))
    if shared and (x <= y or y <= x):
        return 1.0
    best = 2 * (len(shared) + bool(shared) + lcs(" ".join(sorted(x - y)), " ".join(sorted(y - x)))) / (len(left) + len(right))
    return max(best, ratio(shared, left), ratio(shared, right)) if shared else best


def columns(text):
    found = {t.lower() for t in re.findall(r"[A-Za-z0-9_]+", text)}
    return {t for t in found if "_" in t or t.endswith("id") or t.endswith("code")}


def norm(text):
    return re.sub(r"\s+", " ", text.strip().lower())


def vectors(docs, split, query):
    counts = [Counter(split(norm(d))) for d in docs]
    df = Counter(t for c in counts for t in c)
    idf = {t: math.log((1 + len(docs)) / (1 + n)) + 1 for t, n in df.items()}

    def unit(c):
        v = {t: n * idf[t] for t, n in c.items() if t in idf}
        size = math.sqrt(sum(x * x for x in v.values())) or 1.0
        return {t: x / size for t, x in v.items()}

    q = unit(Counter(split(norm(query))))
    return [sum(x * u.get(t, 0.0) for t, x in q.items()) for u in map(unit, counts)]


def best(docs, query):
    docs = [d for d in docs if norm(d)]
    if not docs:
        return None, 0.0
    char, word = vectors(docs, grams, query), vectors(docs, words, query)
    overlap = [len(columns(query) & columns(d)) for d in docs]
    top = max(overlap) or 1
    scores = [0.35 * c + 0.35 * w + 0.2 * token_set(query, d) + 0.1 * o / top for c, w, d, o in zip(char, word, docs, overlap)]
    scores = [round(s, 9) for s in scores]
    at = scores.index(max(scores))
    return docs[at], scores[at]


@pytest.mark.parametrize("threshold", [0.72, 0.5])
def test_matches_equal_all_pairs(spark, threshold):
    rng = random.Random(7)
    parts = ["col_a", "col_b", "order_id", "zipcode", "Row Count", "id", "Über col_c", "x"]
    ends = ["NULL", "Invalid", "Row Count Dropped", "Row Count Increased", "Profile  Change", "Duplicates", "of of it"]

    def title():
        return f"{', '.join(rng.sample(parts, rng.choice([1, 1, 2, 3])))}: {rng.choice(ends)}"

    # One data set holds a third of all titles, with many copies of one of them.
    tickets = [("hot", title()) for _ in range(60)] + [("hot", "col_a: NULL")] * 40 + [(f"d{i % 12}", title()) for i in range(200)] + [("d1", "  ")]
    candidates = [("hot", title()) for _ in range(40)] + [(f"d{i % 14}", title()) for i in range(120)]
    ordered = [(d, t, i) for i, (d, t) in enumerate(tickets)]
    got = M.match_titles(
        spark.createDataFrame(candidates, "dataset string, title string"),
        spark.createDataFrame(ordered, "dataset string, title string, ord int"),
        threshold,
    ).collect()
    want = {}
    for d, t in set(candidates):
        match, score = best([x for k, x in tickets if k == d], t)
        if score >= threshold:
            want[d, t] = (match, score)
    assert len(want) > 20
    assert {(r.dataset, r.title) for r in got} == set(want)
    for r in got:
        match, score = want[r.dataset, r.title]
        assert r.score == pytest.approx(score, abs=1e-8)
        assert r.matched_title == match


def token_sets(spark, pairs):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    parts = M.token_parts(M.title_words(F.col("a")), M.title_words(F.col("b")))
    df = df.withColumn("p", parts).select("i", M.token_set_ratio(F.col("p")).alias("s"), "p.low", "p.high")
    return sorted(map(tuple, df.collect()))


def test_token_set_against_definition(spark):
    rng = random.Random(3)
    vocab = ["a", "bb", "ccc", "col_1:", "NULL", "Invalid", "é𝄞x"]
    pairs = [(" ".join(rng.choices(vocab, k=rng.randint(0, 4))), " ".join(rng.choices(vocab, k=rng.randint(0, 4)))) for _ in range(300)]
    pairs += [("a\u00a0b", "b a"), ("a\tb  ", "a"), ("", ""), ("x", "y")]
    for (_, got, low, high), (a, b) in zip(token_sets(spark, pairs), pairs, strict=True):
        assert got == pytest.approx(token_set(a, b)), (a, b)
        assert low - 1e-12 <= got <= high + 1e-12


def test_common_length_of_long_texts(spark):
    rng = random.Random(5)
    pairs = []
    for n in (1, 30, 61, 62, 63, 64, 123, 124, 125, 186, 187, 400):
        for m in (0, 40, 62, 130, 300):
            pairs.append(("".join(rng.choices("abc é", k=n)), "".join(rng.choices("abc é", k=m))))
    pairs += [("x" * 300, "x" * 200), ("ab" * 100, "ba" * 100)]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    got = sorted(map(tuple, df.select("i", M.common_length(F.col("a"), F.col("b"))).collect()))
    assert got == [(i, lcs(a, b)) for i, (a, b) in enumerate(pairs)]


def test_no_python_in_matching(spark):
    rows = spark.createDataFrame([("d", "col_a: NULL", 1), ("d", "col_b: Invalid", 2)], "dataset string, title string, ord int")
    plan = M.match_titles(rows.drop("ord"), rows)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "repartition(" not in plan.lower()


def test_titles_are_never_sent_whole(spark):
    rows = spark.createDataFrame([("d", "col_a: NULL", 1), ("d", "col_b: Invalid", 2)], "dataset string, title string, ord int")
    plain = rows.drop("ord")
    for df in (M.title_vectors(plain, rows, 0.6), M.match_titles(plain, rows), M.drop_matched(plain, rows, "title")):
        assert "BroadcastHashJoin" not in df._jdf.queryExecution().executedPlan().toString()


def test_terms_are_not_shuffled(spark):
    """Titles are dealt by dataset once, and cut into their many terms only there."""
    rows = spark.createDataFrame([("d", "col_a: NULL", 1), ("d", "col_b: Invalid", 2)], "dataset string, title string, ord int")
    plan = M.title_vectors(rows.drop("ord"), rows, 0.6)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_large_datasets_match_alike(spark, monkeypatch):
    """Datasets of more titles than a task takes give the same matches as small ones; null names and blank titles are there too."""
    rng = random.Random(11)

    def rows(n):
        names = ["hot"] * 3 + ["a", "b", None]
        return [(rng.choice(names), f"{rng.choice(['col_a', 'Ord id', 'ü x', ''])}: {rng.choice(['NULL', 'Invalid', 'of of it', ''])} {rng.randrange(6)}", i) for i in range(n)] + [("a", " ", n), ("a", None, n)]

    tickets = spark.createDataFrame(rows(150), "dataset string, title string, ord int")
    wanted = spark.createDataFrame(rows(120), "dataset string, title string, ord int").drop("ord")
    found = []
    for most in (20_000, 30, 1):
        monkeypatch.setattr(M, "TASK_TITLES", most)
        found.append(sorted(map(tuple, M.match_titles(wanted, tickets).collect())))
    assert found[0] == found[1] == found[2] and len(found[0]) > 20


def test_custom_rules_are_never_sent_whole(spark):
    rules = spark.createDataFrame([("d", "r", "if_a_is_bad", "Validity", "col_a")], "dataset string, runId string, ruleNm string, dimName string, columnName string")
    breaks = spark.createDataFrame([("d", "r", "if_a_is_bad", "BREAKING", 1.0, 2.0)], "dataset string, runId string, ruleNm string, breakMsg string, score double, perc double")
    tickets = spark.createDataFrame([("Sub-task", "Open", "d", "other", 1)], "issue_type string, status string, parent_summary string, title string, ord int")
    found = C.custom_candidates(rules, breaks, tickets)
    assert "BroadcastHashJoin" not in found._jdf.queryExecution().executedPlan().toString()
    assert [r.suggested_title for r in found.collect()] == ["col_a: Invalid"]


def test_custom_rules_are_joined_once(spark):
    """The failed rules are written and read again by the matching and the candidates, so their joins do not run twice."""
    rules = spark.createDataFrame([("d", "r", "if_a_is_bad", "Validity", "col_a")], "dataset string, runId string, ruleNm string, dimName string, columnName string")
    breaks = spark.createDataFrame([("d", "r", "if_a_is_bad", "BREAKING", 1.0, 2.0)], "dataset string, runId string, ruleNm string, breakMsg string, score double, perc double")
    tickets = spark.createDataFrame([("Sub-task", "Open", "d", "col_a: Invalid", 1)], "issue_type string, status string, parent_summary string, title string, ord int")
    found = C.custom_candidates(rules, breaks, tickets)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "LocalTableScan" not in plan and "ExistingRDD" not in plan and "failed-rules" in plan
    assert found.count() == 0
