"""Literal rows: nulls, blanks, NaN, ties, empty inputs."""

import datetime as dt
import os
import math

import pytest
from pyspark.sql import functions as F

from gaugeworks.functions import coerce as K
from gaugeworks.functions import text as X
from gaugeworks.operators import candidates as C
from gaugeworks.operators import catalog
from gaugeworks.operators import definitions as D
from gaugeworks.operators import evidence as E
from gaugeworks.operators import history as H
from gaugeworks.operators import investigate as V
from gaugeworks.operators import keys as Y
from gaugeworks.operators import notify as N
from gaugeworks.operators import planning as P
from gaugeworks.operators import report as R
from gaugeworks.operators.relational import text_of_lines


def one(spark, values, kind, *columns):
    df = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    rows = df.select(*columns).collect()
    return [r[0] if len(columns) == 1 else tuple(r) for r in rows]


def test_unit_names(spark):
    df = spark.createDataFrame([(None,), ("",), ("JP",), ("JP - cde",), ("JP - A - B",)], "unit string")
    got = [(r.Market, r.Project, r.CDE) for r in catalog.parse_unit(df, "unit").collect()]
    assert got == [(None, None, "No"), (None, None, "No"), ("JP", None, "No"), ("JP", "cde", "Yes"), ("JP", "A - B", "No")]


def test_severity_guards(spark):
    assert one(spark, ["10", "1", "0.9", "x", "NaN", None], "string", K.severity_from_percent("v")) == [
        "Critical", "High", "Medium", "Medium", "Medium", "Medium"]
    assert one(spark, [math.nan, 20.0, 9.9], "double", K.severity_from_total("v")) == ["Medium", "Critical", "Medium"]


def test_all_null_sum_is_zero(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", 0.5)], "k string, v double")
    assert dict(df.groupBy("k").agg(K.exact_sum("v")).collect()) == {"a": 0.0, "b": 0.5}


def test_number_text(spark):
    values = [12345.678, 1234567.8, 0.00012345, 1.0, -3.5, math.inf, None, 0.0, 5e-10, 123.4567891, 1e-9]
    want = ["12,345.7", "1.23457e+06", "0.00012345", "1", "-3.5", "NA", "NA", "0", "0", "123.457", "1e-09"]
    assert one(spark, values, "double", K.fmt_num("v")) == want
    assert one(spark, [None, 2.0, math.nan], "double", K.fmt_pct("v")) == ["NA", "2.00%", "NA"]


def test_numbers_round_from_their_exact_value(spark):
    values = [5026.025, 0.125, 0.135, 1.005, 2.675, -0.125, -0.001, 8.345, 1234567.125, 33.585, 1e15, 0.0]
    assert one(spark, values, "double", K.fmt_pct("v")) == [f"{v:.2f}%" for v in values]
    assert one(spark, values, "double", K.break_summary(F.lit(3), F.col("v") / 100)) == [f"3 ({v / 100:.4f}%)" for v in values]
    values = [1.000005, 0.1234565, 2.5000005, 99999.95, 999999.5, 12345.65, 1.0000015e-7, 1e-05, 0.0001, -1.5e-120, 2.5e200]
    assert one(spark, values, "double", K.fmt_significant("v", commas=True)) == [f"{v:,.6g}" for v in values]


def test_break_keys(spark):
    item, metric = X.split_break_key("v")
    assert one(spark, ["a__B__C", "abc", None], "string", item, metric) == [("a", "B__C"), (None, None), (None, None)]


def test_emails(spark):
    values = ["a.b@Good.com", "a@bad.com", "no address", None, " a@good.com "]
    assert one(spark, values, "string", X.valid_email("v", ["good.com"])) == [True, False, False, False, True]
    assert one(spark, values, "string", X.valid_email("v")) == [True, True, False, False, True]


def test_domain_codes(spark):
    codes = {"EMP": "Employee", "FIN": " ", "TWO": "A, B"}
    assert one(spark, ["EMP, XX,FIN", "TWO", None, " ,"], "string", R.map_multi("v", codes)) == ["Employee,XX", "A,B", "", ""]


def test_labels(spark):
    values = ["['A', ' b ']", '["x"]', "a, B ,", "", None, "[]"]
    assert one(spark, values, "string", X.labels_to_array("v")) == [["a", "b"], ["x"], ["a", "b"], [], [], []]


def test_text_breaks(spark):
    text = "- *col  a* — *null  x*\n**b** – **Min**\n*c* - *no*"
    assert one(spark, [text, None], "string", X.raised_breaks("v")) == [["col a__NULL X", "b__MIN"], []]
    note = "[auto_invalidate] done\n\n[AUTO_INVALIDATE] invalidated: a__B, c__D\nplain"
    assert one(spark, [note, "x"], "string", X.noted_breaks("v", "[AUTO_INVALIDATE]")) == [["a__B", "c__D"], []]


def test_section_is_replaced_once(spark):
    block = F.lit("M\nnew")
    assert one(spark, ["old", "old \nM\nprevious", "", None], "string", X.merge_section("v", block, "M")) == [
        "old\n\nM\nnew", "old\n\nM\nnew", "M\nnew", "M\nnew"]


def test_select_lists(spark):
    values = [
        "SELECT a, f(b, ',') AS c, \"Q X\", g(1) z FROM t", "select distinct * from t", "update t", None, "select ')', x\nfrom t", "select a", "",
        "select cast(a as int) n, (select max(b) from u) m\n, `c` from t",
    ]
    assert one(spark, values, "string", D.select_columns("v")) == [
        ["a", "f(b, ',')", "q x", "g(1)"], None, None, None, ["')'", "x"], None, None, ["cast(a as int)", "(select max(b) from u)", "c"]]


def test_date_filters(spark):
    values = [
        "select a from t where x = 1 and to_date(load_d, 'y') >= current_date",
        "select a from t where load_dt > ${rd}",
        "select a from t where x = 1 and y > current_date",
        "select a from t where a = 1", None,
    ]
    assert one(spark, values, "string", *D.date_filter("v")) == [(True, "load_d"), (True, "load_dt"), (True, "y"), (False, None), (False, None)]


def test_source_tables(spark):
    df = spark.createDataFrame([('select 1 from a.b.c x',), ('select 1 from "d"."e" where 1',), ("select 1 from f",), ("none",)], "q string")
    got = [(r.db_nm, r.table_nm) for r in D.query_source_table(df, "q").collect()]
    assert got == [("b", "c"), ("d", "e"), (None, "f"), (None, None)]


def runs(spark, rows):
    made = [("a", i, None if day is None else dt.datetime(2024, 1, day), n) for i, (day, n) in enumerate(rows)]
    return spark.createDataFrame(made, "dataset string, run_id int, run_date timestamp_ntz, row_cnt bigint")


def test_padded_and_plain_change(spark):
    df = runs(spark, [(1, 1), (2, None), (3, 4)]).withColumns({"behaviorScore": F.lit(1), "DQScore": F.lit(2)})
    got = H.row_history(df, df.select("dataset", "run_date"), "dataset", "run_date", "run_id", "row_cnt", "run_date", "Asia/Singapore", "SGT")
    by_day = {r.run_date.day: r for r in got.collect()}
    assert [by_day[d].rows_pct_change_vs_prev for d in (1, 2, 3)] == [None, 0.0, 300.0]
    assert by_day[3].rows_prev is None and by_day[3].rows_current == 4
    plain = H.change_vs_previous(df, 4, "dataset", "run_date", "run_id", "row_cnt").collect()
    assert [r.row_pct_change for r in plain] == [None, None, None]


def test_history_rounds_from_the_exact_value(spark):
    rows = [("d", 1, dt.datetime(2001, 1, 1), 8000, 0, 0), ("d", 2, dt.datetime(2001, 1, 2), 410082, 0, 0)]
    runs = spark.createDataFrame(rows, "dataset string, run_id int, run_date timestamp_ntz, row_cnt bigint, behaviorScore int, DQScore int")
    wanted = runs.select("dataset", "run_id", "run_date").filter("run_id = 2")
    got = H.row_history(runs, wanted, "dataset", "run_date", "run_id", "row_cnt", "run_date", "UTC", "UTC").first()
    assert got.rows_pct_change_vs_prev == 5026.025
    assert "| 410082 | 5026.02% |" in got.history_text


def test_zero_predecessor_and_unknown_times(spark):
    df = runs(spark, [(1, 0), (2, 5), (None, 9)])
    plain = {r.run_id: r.row_pct_change for r in H.change_vs_previous(df, 4, "dataset", "run_date", "run_id", "row_cnt").collect()}
    assert plain[1] is None
    assert [r.run_id for r in H.last_n_runs(df, None, 1, "dataset", "run_date", "run_id").collect()] == [2]
    assert [r.run_id for r in H.newest_runs(df, 1, "dataset", "run_date", "run_id").collect()] == [1]


def test_nan_change_is_not_small(spark):
    df = spark.createDataFrame([(math.nan,), (19.9,), (-20.0,), (None,)], "row_pct_change double")
    df = df.withColumns({
        "has_row_count_break": F.lit(True), "is_row_count": F.lit(True), "break_type": F.lit("ROW_COUNT"),
        "perChange": F.lit(1.0), "persist_ok": F.lit(True),
    })
    assert [r.to_invalidate for r in V.heuristics(df).collect()] == [False, True, False, False]


def test_lines_over_the_limit_stay_in_the_table(spark):
    lines = spark.range(30).select(F.when(F.col("id") < 25, "big").otherwise("small").alias("k"), "id", F.col("id").cast("string").alias("line"))
    got = {r.k: r for r in text_of_lines(lines, ["k"], ["id"], "line", "text", ",", part_lines=10).collect()}
    assert got["big"].text.endswith(",9,(continued in further parts)")
    assert got["small"].text == "25,26,27,28,29"


def test_routes(spark):
    rules = [(("ONE", "TWO"), "both"), (("ONE",), "one")]
    values = ["JP - one_two", "JP - x one", "ONE", None, "JP - y"]
    assert one(spark, values, "string", P.route_by_words(F.col("v"), rules, "Other")) == ["both", "one", "one", "Other", "Other"]


def test_candidate_keys(spark):
    df = spark.createDataFrame([(1, "a", 1, None), (1, "b", 2, 1), (2, "a", 3, 2)], "x int, y string, z int, w int")
    assert {tuple(r) for r in Y.candidate_keys(df, 2).collect()} == {("z", 1), ("x,y", 2)}


def test_sets_are_refuted_in_a_slice(spark):
    df = spark.range(4000).selectExpr("id AS a", "id DIV 2 AS b", "CAST(id DIV 2 AS STRING) AS c", "id % 1999 AS d")
    sets = [("a",), ("b",), ("b", "c"), ("a", "d")]
    met = Y._met_in_slice(df, sets)
    assert set(met) == {("b",), ("b", "c")}
    assert Y._repeated(df, met) == set(met)
    assert Y._repeated(df, {("a",): df.select(Y._hash(("a",))).first()[0]}) == set()
    assert Y._exact(df, sets) == [("a",), ("a", "d")]


def test_reference_filter_keeps_null(spark):
    df = spark.createDataFrame([("a",), (None,)], "dataset string")
    ref = spark.createDataFrame([("a",)], "dataset string")
    assert [r.dataset for r in C.filter_reference(df, ref, "dataset", False).collect()] == [None]


@pytest.mark.parametrize("limit", [3, 500])
def test_search_equals_plain_search(spark, limit):
    base = dt.datetime(2024, 3, 1)
    # A common word on every ticket, a rare one on some, several updates in the same hour.
    tickets = [(f"T-{i:03d}", base + dt.timedelta(minutes=37 * i % 9000, hours=i % 40), "common tb_x" if i % 7 else "Rare.word common") for i in range(400)]
    incidents = [(i, base + dt.timedelta(hours=11 * i, minutes=13), None if i % 2 else base + dt.timedelta(hours=11 * i + 2), ["common"] if i % 3 else ["rare", "none"]) for i in range(12)]
    got = E.search_evidence(
        spark.createDataFrame(incidents, "incident int, run_at timestamp_ntz, end_at timestamp_ntz, terms array<string>"),
        spark.createDataFrame(tickets, "key string, updated timestamp_ntz, text string"), days=2, limit=limit,
    )
    want = set()
    for incident, run_at, end_at, terms in incidents:
        low = (run_at - dt.timedelta(days=2)).replace(second=0)
        high = (end_at or run_at + dt.timedelta(hours=24)).replace(second=0)
        hits = [(u, k) for k, u, text in tickets if low <= u <= high and any(w in text.lower().replace(".", " ").split() for w in terms)]
        want |= {(incident, k) for u, k in sorted(hits, key=lambda h: (-h[0].timestamp(), h[1]))[:limit]}
    assert {(r.incident, r.key) for r in got.collect()} == want


@pytest.mark.parametrize("limit", [4, 60])
def test_search_evidence_lists_are_shared(spark, limit):
    from gaugeworks.session import shared_root

    base = dt.datetime(2024, 3, 1)
    tickets = [(f"T-{i:03d}", base + dt.timedelta(minutes=53 * i % 14400), ["alpha beta", "beta", "alpha", "gamma alpha"][i % 4] + f" own{i % 50}") for i in range(500)]
    tickets += tickets[:30] + [(k, u + dt.timedelta(hours=1), x) for k, u, x in tickets[:5]]
    incidents = [(i, base + dt.timedelta(days=i % 12, hours=5), None if i % 3 else base + dt.timedelta(days=i % 12, hours=9), [["Alpha", "beta", f"own{i % 50}"], ["beta"], ["own7", "none"]][i % 3]) for i in range(90)]
    incidents += [(0, base + dt.timedelta(days=4), None, ["gamma"]), (1, base + dt.timedelta(days=2), base + dt.timedelta(days=1), ["alpha"])]
    before = set(os.listdir(f"{shared_root(spark)}/gaugeworks")) if os.path.isdir(f"{shared_root(spark)}/gaugeworks") else set()
    got = E.search_evidence(
        spark.createDataFrame(incidents, "incident int, run_at timestamp_ntz, end_at timestamp_ntz, terms array<string>"),
        spark.createDataFrame(tickets, "key string, updated timestamp_ntz, text string"), days=3, limit=limit,
    )
    hits = {}
    for incident, run_at, end_at, terms in incidents:
        low, high, words = run_at - dt.timedelta(days=3), end_at or run_at + dt.timedelta(hours=24), {t.lower() for t in terms}
        hits.setdefault(incident, set()).update((u, k) for k, u, text in tickets if low <= u <= high and words & set(text.split()))
    want = [(i, k, u) for i, found in hits.items() for u, k in sorted(found, key=lambda h: (-h[0].timestamp(), h[1]))[:limit]]
    assert sorted(map(tuple, got.collect())) == sorted(want)
    written = {name.rsplit("-", 1)[0]: name for name in set(os.listdir(f"{shared_root(spark)}/gaugeworks")) - before}
    # Windows that end on one day and have the same frequent terms share a list.
    assert spark.read.parquet(f"{shared_root(spark)}/gaugeworks/{written['lists']}").count() < len(incidents) / 2


def test_links_stop_at_late_tickets(spark):
    at = dt.datetime(2024, 1, 1)
    seeds = spark.createDataFrame([("i", "A", 1, at)], "incident string, key string, rank int, latest_at timestamp_ntz")
    edges = spark.createDataFrame([("A", 0, "B"), ("A", 1, "L"), ("B", 0, "C"), ("L", 0, "D"), ("C", 0, "E"), ("B", 1, "A")], "src string, position int, dst string")
    late = at + dt.timedelta(days=2)
    allowed = spark.createDataFrame([(k, late if k == "L" else at) for k in "ABCDEL"], "key string, event_at timestamp_ntz")
    got = {(r.key, r.depth, r.found_from) for r in E.expand_links(seeds, edges, allowed, cap=50, first=3).collect()}
    assert got == {("A", 0, None), ("B", 1, "A"), ("C", 2, "B")}


def test_sums_lose_nothing(spark):
    from gaugeworks.functions.coerce import exact_sum

    def total(values):
        return spark.createDataFrame([(v,) for v in values], "v double").agg(exact_sum("v")).first()[0]

    assert total([1e23, 1.0]) == 1e23 + 1.0 and total([1e30, 1e30]) == 2e30
    assert total([0.1] * 10) == 1.0 and total([1e-9] * 3) == 3e-9
    assert total([None, None]) == 0.0 and total([]) == 0.0
    assert total([9e25] * 3) == 2.7e26


def test_long_lists_lose_nothing(spark):
    from gaugeworks.operators.relational import CONTINUED, text_of_lines, text_parts

    lines = spark.range(1200).select(F.lit("k").alias("k"), F.format_string("%04d", "id").alias("line")).union(spark.createDataFrame([("s", "one"), (None, "two")], "k string, line string"))
    parts = text_parts(lines, ["k"], ["line"], "line").collect()
    whole = "\n".join(p.text for p in sorted((p for p in parts if p.k == "k"), key=lambda p: p.part))
    assert whole.split("\n") == [f"{i:04d}" for i in range(1200)]
    assert sorted((p.k or "", p.part, p.text) for p in parts if p.k != "k") == [("", 0, "two"), ("s", 0, "one")]
    first = {r.k: r.t for r in text_of_lines(lines, ["k"], ["line"], "line", "t").collect()}
    assert first["k"].split("\n")[998:] == ["0998", CONTINUED] and first["s"] == "one"

    runs = spark.range(1200).select(F.lit("d").alias("dataset"), F.col("id").alias("run"))
    found = V.persistence(spark.createDataFrame([("d", "b")], "dataset string, break_key string"), runs, runs.withColumn("key", F.lit("b")), "run", [F.col("run")]).first()
    assert found.persist_cnt == 1200 == len(found.persist_runs.split(", ")) == len(found.checked_runs.split(", "))

    tickets = spark.createDataFrame([("d", "r", 50.0, "title", "High")], "dataset string, runId string, score double, suggested_title string, suggested_priority string")
    breaks = spark.range(1200).select(F.lit("d").alias("dataset"), F.lit("r").alias("runId"), F.format_string("b%d__NULL", "id").alias("key"), F.lit("null").alias("type"))
    none = spark.createDataFrame([], "dataset string")
    alerts = V.high_score_alerts(tickets, breaks, none).withColumn("break_key", F.lit(None).cast("string")).withColumn("ord", F.lit(1))
    cells = {r.part: r.detected_breaks.split(" | ") for r in alerts.collect()}
    assert {p: len(c) for p, c in cells.items()} == {0: 999, 1: 201} and sorted(cells[0] + cells[1]) == sorted(f"b{i}__NULL" for i in range(1200))
    told = V.alert_breaks(tickets, breaks, none)
    assert told.count() == 1200
    for unpacked in (N.unpack_breaks(alerts, ["ord"], told), N.unpack_breaks(alerts, ["ord"])):
        assert unpacked.count() == 1200 and unpacked.filter("break_key = 'title'").count() == 0
    assert sum(len(p.text.split("\n")) for p in N.message_parts(unpacked).collect()) == 1200


def test_long_recipients_and_messages(spark):
    """1,200 recipients and tickets of one dataset, 1,200 breaks, and a dataset with one of each."""
    notes = spark.range(1200).select(
        F.lit("d").alias("dataset"), F.format_string("T-%04d", "id").alias("issue_key"), F.lit("high_score_ticket").alias("notification_type"), F.lit(False).alias("should_close"), "id"
    )
    notes = notes.union(spark.createDataFrame([("e", "T-1", "invalidated_break", True, 7)], notes.schema))
    by_ticket = notes.select("issue_key", F.concat(F.lower("issue_key"), F.lit("@example.com")).alias("email"))
    grouped = N.group_notifications(notes, by_ticket, [], ["example.com"], ["id"])
    rows = {(r.dataset, r.part): r for r in grouped.collect()}
    assert sorted(rows) == [("d", 0), ("d", 1), ("e", 0)]
    for column, name in (("recipients", "t-%04d@example.com"), ("issue_keys", "T-%04d")):
        assert (rows["d", 0][column] + ";" + rows["d", 1][column]).split(";") == [name % i for i in range(1200)]
    breaks = spark.range(2500).select(F.lit("d").alias("dataset"), F.format_string("c%04d__NULL", "id").alias("break_key"))
    sent = {(r.dataset, r.part): r for r in N.render_messages(grouped, breaks, N.issue_status(notes), "/x=").collect()}
    assert sorted(sent) == [("d", 0), ("d", 1), ("d", 2), ("e", 0)]
    text = "\n".join(sent["d", p].message for p in range(3)).split("\n")
    assert [x for x in text if x.startswith("- c")] == [f"- c{i:04d} (NULL)" for i in range(2500)]
    assert [x for x in text if x.startswith("- T-")] == [f"- T-{i:04d} (Updated)" for i in range(1200)]
    assert not any("further parts" in x for x in text) and text.count("- None further") == 1
    assert sent["d", 2].recipients is None and "- None\n" in sent["e", 0].message and sent["e", 0].recipients == "t-1@example.com"


def test_long_duplicates_keep_unseen_keys(spark):
    dupes = spark.range(1200).select(F.lit("d").alias("dataset"), F.lit("r").alias("runId"), F.format_string("k%04d", "id").alias("obsKey"), F.lit(1.0).alias("owlRank"), F.lit("true").alias("jobSchedule"))
    none = spark.createDataFrame([], "dataset string, runId string, obsKey string, ord int, record map<string,string>")
    parts = sorted(map(tuple, C.duplicate_parts(dupes, none, ["obsKey"]).select("kind", "part", "text").collect()))
    assert [p[:2] for p in parts] == [("unseen", 0), ("unseen", 1)]
    assert ", ".join(p[2] for p in parts).split(", ") == [f"k{i:04d}" for i in range(1200)]


def test_latest_date(spark):
    texts = [
        "merged 1990-01-01, again 2024-03-02", "at 2024-03-01 10:11:12 and 2024-03-01.", "2024-03-01T10:11:12.5Z", "(2024-03-01T10:11)", "2024-03-01, 23:00:00", "2024-13-01 2024-02-30", "x", "", None,
        "v2024-01-05-2 build 2023-12-31 23:59:59", "2024-1-5 20240105 12:00:00",
    ]
    d = dt.datetime
    want = [d(2024, 3, 2), d(2024, 3, 1, 10, 11, 12), d(2024, 3, 1, 10, 11, 12, 500000), d(2024, 3, 1), d(2024, 3, 1), None, None, None, None, d(2024, 1, 5), None]
    assert one(spark, texts, "string", E.latest_date(F.col("v"))) == want


def test_notification_queries_read_views_once(spark):
    """Notes, owners, high tickets and their breaks are written once: the last plan computes no view of the given tables again in a branch."""
    from gaugeworks.plans import load_all

    for name in ("j03_recipients", "j04_group_notifications", "h15_high_score_alerts"):
        files = load_all()[0][name](spark, "/root/testdata/sf0.001").inputFiles()
        assert files and all("/gaugeworks/" in f for f in files)


def test_definitions_are_dealt_over_all_tasks(spark):
    """A definition takes long and few bytes, so one small file must not be one task."""
    from gaugeworks.plans import load_all

    dealt = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for name in ("c18_definition_rows", "c24_query_date_filter"):
        assert load_all()[0][name](spark, "/root/testdata/sf0.001").rdd.getNumPartitions() == dealt > 1


def test_merged_partitions_stay_small(spark):
    """A task's memory follows the partitions that are merged for it, so their size is set and below Spark's 64 MB."""
    from gaugeworks.session import SETTINGS

    assert int(SETTINGS.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", 64 << 20)) <= 8 << 20


def _long_run(spark):
    """1,200 sample keys of one run with two records each."""
    found = spark.range(1200).select(
        F.lit("d").alias("dataset"), F.lit("r").alias("runId"), F.format_string("k%04d", "id").alias("obsKey"), F.lit("Title ~~ AB").alias("obs"),
        F.lit(1.0).alias("obsScore"), F.lit(1.0).alias("owlRank"), F.lit("true").alias("jobSchedule"),
    )
    pair = F.posexplode(F.array(F.create_map(F.lit("q"), F.concat("obsKey", F.lit("a"))), F.create_map(F.lit("q"), F.concat("obsKey", F.lit("b"))))).alias("ord", "record")
    records = found.select("dataset", "runId", "obsKey", pair).withColumn("ord", F.concat("obsKey", F.col("ord").cast("string")))
    return found, records


def _one_text(df):
    rows = df.collect()
    assert len(rows) == 1 and "further parts" not in rows[0].jira_description
    return rows[0].jira_description.split("\n")


def test_long_pattern_candidates_hold_every_line(spark):
    lines = _one_text(C.pattern_candidates(*_long_run(spark), ["obsKey"]))
    assert [x for x in lines if x.startswith("| 1.0 |")] == [f"| 1.0 | k{i:04d}a |" for i in range(1200)]
    assert [x for x in lines if x.startswith("| Maj")] == [f"| Majority Pattern | k{i:04d}b |" for i in range(1200)]


def test_whole_text_over_parts(spark):
    """Any number of lines a part gives the same cell, null lines and null keys included."""
    from gaugeworks.operators.relational import whole_text

    rows = [("a", i, None if i % 3 == 1 or 4 <= i < 9 else str(i)) for i in range(12)] + [(None, 1, "x"), (None, 0, "y"), ("n", 0, None)]
    lines = spark.createDataFrame(rows, "k string, i int, line string").repartition(3)
    for part in (1, 2, 5, 999):
        got = {r.k: r.t for r in whole_text(lines, ["k"], ["i"], "line", "t", ",", part).collect()}
        assert got == {"a": "0,2,3,9,11", None: "y,x", "n": ""}


def test_long_duplicate_candidates_hold_every_line(spark):
    found, records = _long_run(spark)
    keys = spark.createDataFrame([], "dataset string, columns array<string>")
    lines = _one_text(C.duplicate_candidates(found, records, keys, ["obsKey"]))
    assert [x for x in lines if x.startswith("| k")] == [f"| k{i:04d}{c} |" for i in range(1200) for c in "ab"]
    lines = _one_text(C.duplicate_candidates(found, records.limit(0), keys, ["obsKey"]))
    assert lines[-1].split(": ")[1].split(", ") == [f"k{i:04d}" for i in range(1200)]
