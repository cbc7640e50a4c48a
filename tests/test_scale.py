"""Steps that must not repeat or sort the largest inputs more than needed."""

from pyspark.sql import functions as F

from gaugeworks.functions import coerce as K
from gaugeworks.operators import candidates as C
from gaugeworks.operators import evidence as E
from gaugeworks.operators.relational import text_parts


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_text_parts_of_usual_and_long_keys_agree(spark):
    """Keys are numbered in place, long ones over ranges; null keys count as one key."""
    lines = spark.range(60).select(F.when(F.col("id") % 7 > 0, F.col("id") % 3).alias("k"), F.format_string("%03d", 59 - F.col("id")).alias("line"))
    want = {}
    for k, line in sorted(map(tuple, lines.collect()), key=lambda r: r[1]):
        want.setdefault(k, []).append(line)
    parts = {(k, i // 4): "\n".join(ls[i : i + 4]) for k, ls in want.items() for i in range(0, len(ls), 4)}
    for long_key in (5, 17, 1000):
        got = text_parts(lines, ["k"], ["line"], "line", part_lines=4, long_key=long_key).collect()
        assert {(r["k"], r["part"]): r["text"] for r in got} == parts and len(got) == len(parts)


def test_text_parts_deals_usual_keys_once(spark):
    lines = spark.range(20).select((F.col("id") % 2).alias("k"), F.col("id").cast("string").alias("line"))
    text = plan(text_parts(lines, ["k"], ["line"], "line", part_lines=3))
    assert text.count("Exchange") == 1 and "Join" not in text


def test_odd_record_needs_no_join_of_its_own(spark):
    patterns = spark.createDataFrame([("d", "r", "p", "k1", 5), ("d", "r", "p", "k2", 6)], "dataset string, runId string, pattern string, obsKey string, owlRank int")
    rows = [("d", "r", "k1", "b", {"x": "2"}), ("d", "r", "k1", "a", {"x": "1"}), ("d", "r", "k1", None, {"x": "3"}), ("d", "r", "k2", None, {"x": "4"}), (None, "r", "k1", "c", {"x": "5"})]
    seen = spark.createDataFrame(rows, "dataset string, runId string, obsKey string, ord string, record map<string,string>")
    lines = C.pattern_lines(patterns, seen, ["obsKey"])
    assert lines._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1
    got = {(r["obsKey"], r["ord"]): r["line"] for r in lines.collect()}
    assert got == {
        ("k1", "a"): "| PatternCount | x |\n| 5 | 1 |", ("k1", "b"): "| Majority Pattern | 2 |",
        ("k1", None): "| Majority Pattern | 3 |", ("k2", None): "| Majority Pattern | 4 |",
    }


def test_heads_without_names_need_no_sort(spark):
    df = spark.createDataFrame([("d", 1.0, 1), ("d", 2.0, 2)], "dataset string, s double, ord int")
    heads = C._heads(df, ["dataset"], "s", ["ord"])
    assert "SortAggregate" not in plan(heads)
    row = heads.first()
    assert row["score"] == 3.0 and row["__first"].asDict() == {"db_nm": None, "table_nm": None, "Project": None}
    named = C._heads(df.withColumn("db_nm", F.concat(F.lit("b"), "ord")), ["dataset"], "s", ["ord"]).first()
    assert named["__first"].asDict() == {"db_nm": "b1", "table_nm": None, "Project": None}


def test_columns_of_duplicates_keep_their_first_place(spark):
    """The records of a run are read once; their columns follow from its few kinds of records."""
    rows = [("d", "r", "k1", "2", ["b", "occurs", "a"], ["1", "2", "3"]), ("d", "r", "k1", "1", ["c", "b"], ["1", "2"]), ("d", "r", "k2", "3", ["c", "b"], ["1", "2"]), ("d", "r", "no", "0", ["z"], ["1"])]
    seen = spark.createDataFrame(rows, "dataset string, runId string, obsKey string, ord string, names array<string>, cells array<string>")
    seen = seen.withColumn("record", F.map_from_arrays("names", "cells")).drop("names", "cells")
    dupes = spark.createDataFrame([("d", "r", "k1"), ("d", "r", "k1"), ("d", "r", "k2")], "dataset string, runId string, obsKey string")
    headers, lines = C.duplicate_lines(dupes, seen)
    assert headers.first()["names"] == ["c", "b", "a", "occurs"]
    assert sorted((r["ord"], r["line"]) for r in lines.collect()) == [("1", "| 1 | 2 | nan | nan |"), ("2", "| nan | 1 | 3 | 2 |")]
    assert "Generate" not in plan(headers) and "Join" not in plan(headers)


def test_evidence_text_reads_development_once_per_ticket(spark):
    """The date read per ticket is shown for every incident it is evidence of; without it the text is read."""
    cols = "incident bigint, rank int, key string, issue_type string, summary string, status string, created timestamp_ntz, updated timestamp_ntz, development string, body string, relevance double, description string, comments_text string"
    rows = [(i, 1, "T", "task", "s", "Open", None, None, "merged 2024-01-02", "b", 1.0, "d", "c") for i in (1, 2)]
    plain = spark.createDataFrame(rows, cols)
    read = E.ticket_texts(plain)
    got = {r["incident"]: r["evidence"] for r in E.evidence_text(read).collect()}
    assert got == {r["incident"]: r["evidence"] for r in E.evidence_text(plain).collect()}
    assert "Development Latest: 2024-01-02 00:00:00" in got[1]
    optimized = E.evidence_text(read)._jdf.queryExecution().optimizedPlan().toString()
    kept = E.evidence_text(plain.withColumn("development_at", F.lit(None).cast("timestamp_ntz")))._jdf.queryExecution().optimizedPlan().toString()
    assert "split" in optimized and "split" not in kept


def test_significant_digits_are_written_from_one_scientific_form(spark):
    df = spark.createDataFrame([(None, None), (0.0, "0"), (-1234.5, "-1,234.5"), (1234567.0, "1.23457e+06"), (0.00001234, "1.234e-05"), (0.0001, "0.0001"), (999999.5, "1e+06")], "x double, want string")
    shown = df.select("want", K.fmt_significant("x", 6, commas=True).alias("got"))
    assert [r["got"] for r in shown.collect()] == [r["want"] for r in df.collect()]
    assert shown._jdf.queryExecution().optimizedPlan().toString().count("format_number") == 2


def test_answers_are_stretches_of_their_lists(spark):
    """A window counts the ages beyond its bounds and cuts its list there; neither entries nor answers are computed one by one."""
    df = spark.createDataFrame([([10, 20, 20, 30],), ([],)], "ages array<bigint>")
    assert [tuple(r) for r in df.select(*[E._below(F.col("ages"), F.lit(b).cast("bigint")) for b in (9, 11, 19, 21, 31)]).collect()] == [(0, 1, 1, 3, 4), (0,) * 5]
    words = spark.sql("SELECT concat('T', id) AS key, timestamp_ntz'2024-01-01' + make_dt_interval(0, id) AS updated, 'alpha' AS text FROM range(40)")
    asked = spark.sql("SELECT id AS incident, timestamp_ntz'2024-01-01' AS run_at, timestamp_ntz'2024-01-02' AS end_at, array('alpha') AS terms FROM range(3)")
    found = E.search_evidence(asked, words, limit=7)
    top = found._jdf.queryExecution().optimizedPlan().toString().splitlines()[0]
    assert "hit" in top and ".at AS updated" in top and "1970" not in top
    assert sorted((r.incident, r.key) for r in found.collect()) == sorted((i, f"T{k}") for i in range(3) for k in range(18, 25))
